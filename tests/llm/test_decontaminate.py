from __future__ import annotations

import hashlib
import re

from aerolith.llm import decontaminate as dc

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def brute_force(docs, items, size=13):
    windows: dict[tuple, set] = {}
    for item_id, text in items:
        w = words(text)
        for s in range(max(len(w) - size, 0) + 1 if w else 0):
            windows.setdefault(tuple(w[s : s + size]), set()).add("null" if item_id is None else str(item_id))
    sizes = {len(k) for k in windows}
    out = []
    for doc_id, text in docs:
        w, hit, found = words(text), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if (ids := windows.get(tuple(w[s : s + n]))):
                    hit.update(range(s, s + n))
                    found |= ids
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((str(doc_id), len(w), len(hit), len(found), sha, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out)


def rows_of(frame):
    return sorted((str(r.doc_id), r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in frame.collect())


EXTRA_ITEMS = [(9001, "short one"), (9002, None), (9003, ""), (None, "Über x9 tail"), (9001, "short one"), (9004, "of the " * 20)]
EXTRA_DOCS = [
    (None, "a short  one here"),
    (None, None),
    (8001, ""),
    (8002, "über X9... tail " + "filler " * 100),
    (8002, "other text, same id"),
    (8003, "of the " * 60),
    (8003, "of the " * 60),
    (8004, "SHORT one short one"),
]


def test_report_equals_brute_force(spark, docs_of, table, monkeypatch):
    items = table("benchmark").unionByName(spark.createDataFrame(EXTRA_ITEMS, "item_id long, text string"))
    docs = table("documents").unionByName(docs_of(EXTRA_DOCS))
    wanted = brute_force([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(dc.decontamination_report(docs, items)) == wanted
    # A benchmark beyond the broadcast bound is taken in blocks, with the same result.
    monkeypatch.setattr(dc.find_hits, "__defaults__", (13, 200_000))
    assert rows_of(dc.decontamination_report(docs, items)) == wanted


def test_blocks_hold_their_bound(spark, docs_of):
    """A third of the items are copies of one text, and one item is huge."""
    copies = [(i, "the same passage of " + " ".join(f"c{k}" for k in range(60))) for i in range(400)]
    huge = [(1000, " ".join(f"h{k}" for k in range(30_000)))]
    rest = [(2000 + i, " ".join(f"r{i}x{k}" for k in range(20))) for i in range(800)]
    items = spark.createDataFrame(copies + huge + rest, "item_id long, text string")
    docs = docs_of([(1, copies[0][1]), (2, " ".join(f"h{k}" for k in range(500, 900))), (3, rest[7][1] + " and more"), (4, "clean")])
    texts, ids = dc.distinct_texts(items)
    assert (texts.count(), ids.count()) == (802, 1201)
    windows = dc.item_windows(texts, docs, 13, 1 << 20)
    blocks = dc.window_blocks(windows, 1 << 20)
    sizes = [b.agg(dc.F.sum(dc._held_bytes(dc.F.col("window")))).first()[0] for b in blocks]
    assert len(blocks) > 5 and max(sizes) <= 1.2 * (1 << 20) and sum(b.count() for b in blocks) == windows.count()
    wanted = brute_force([(r.doc_id, r.text) for r in docs.collect()], [(r.item_id, r.text) for r in items.collect()])
    assert rows_of(dc.decontamination_report(docs, items)) == wanted
    assert [r[3] for r in wanted] == [400, 1, 1, 0]


def test_vocabulary_beyond_the_bound(spark, docs_of, table):
    texts, _ = dc.distinct_texts(table("benchmark"))
    vocabulary = texts.select(dc.F.explode("item_words").alias("word")).distinct()
    counts = [sorted(map(tuple, dc.word_counts(table("documents"), vocabulary, bound).collect())) for bound in (1 << 30, 10)]
    assert counts[0] == counts[1] and counts[0]


def test_removal_keeps_columns_and_clean_rows(docs_of, spark):
    items = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(20)))], "item_id long, text string")
    dirty = "x " + " ".join(f"w{i}" for i in range(15))
    docs = docs_of([(1, dirty), (2, "clean text"), (None, dirty), (3, None), (2, "clean text")])
    left = dc.remove_contaminated(docs.withColumn("word", dc.F.lit(1)), items)
    assert left.columns == [*docs.columns, "word"]
    assert sorted(str(r.doc_id) for r in left.collect()) == ["2", "2", "3"]


def test_empty_tables(docs_of, spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert dc.decontamination_report(docs_of([]), none).count() == 0
    row = dc.decontamination_report(docs_of([(1, "a b")]), none).first()
    assert (row.n_words, row.n_hit, row.contaminated) == (2, 0, False)


def test_main_path_runs_no_python(docs_of, spark):
    items = spark.createDataFrame([(1, "a b c")], "item_id long, text string")
    plan = dc.decontamination_report(docs_of([(1, "a b c")]), items)._jdf.queryExecution().toString()
    assert not re.search("Python|Pandas|Arrow", plan)
