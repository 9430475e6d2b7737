from __future__ import annotations

import hashlib

import pytest

from aerolith.llm import linededup as ld

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

LONG = "The Same long line is here"
ROWS = [
    (None, None),
    (None, f"{LONG}\nz"),
    (1, ""),
    (2, "x \n\n"),
    (3, f" {LONG} \nb"),
    (4, LONG.lower()),
    (5, f"\t{LONG.upper()}\x0b\n"),
    (5, f"{LONG}\nsecond row of five\n{LONG}"),
    (6, "Ü" * 20 + "\nonly in two documents, so it stays"),
    (7, "only in two documents, so it stays\n" + "Ü" * 20),
    (8, "Ü" * 20 + "\nshort\nshort"),
    (9, "short\n" + "y" * 200_000),
    (10, "short"),
]


def plain_key(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def brute_force(rows):
    holders: dict[str, set] = {}
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(plain_key(line)) >= 20 and doc_id is not None:
                holders.setdefault(plain_key(line), set()).add(doc_id)
    keeper = {k: max(v) for k, v in holders.items() if len(v) >= 3}
    out = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if keeper.get(plain_key(x), doc_id) == doc_id]
        sha = hashlib.sha256("\n".join(kept).encode()).hexdigest()
        out.append((str(doc_id), len(lines), len(lines) - len(kept), sha))
    return sorted(out)


def rows_of(frame):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept_sha256) for r in frame.collect())


def test_report_equals_brute_force(docs_of, table):
    docs = docs_of([(None if i is None else i + 10_000, t) for i, t in ROWS]).unionByName(table("documents"))
    assert rows_of(ld.line_dedup_report(docs)) == brute_force([(r.doc_id, r.text) for r in docs.collect()])


def test_a_full_filter_costs_suspects_but_no_result(docs_of):
    docs = docs_of(ROWS)
    tiny = ld.dedup_lines(docs.repartition(3), filter_bits=ld.SEGMENT_BITS)
    kept = {(str(r.doc_id), r.n_dropped) for r in tiny.collect()}
    assert kept == {(i, n) for i, _, n, _ in brute_force(ROWS)}
    with pytest.raises(ValueError):
        ld.repeat_filter(docs, bits=100)


def test_suspects_hold_every_repeated_key_and_few_others(docs_of):
    rows = [(i, f"a line that document {i} has alone\n" + ("shared by the even documents" if i % 2 == 0 else "")) for i in range(200)]
    docs = docs_of(rows).repartition(4)
    keys = {r.key for r in ld.suspected_keys(docs, ld.repeat_filter(docs)).select("key").collect()}
    assert "shared by the even documents" in keys and len(keys) < 5


def test_columns_and_null_text_survive(docs_of):
    docs = docs_of([(1, None), (2, "a")]).withColumn("n_lines", ld.F.lit("mine")).withColumn("key", ld.F.lit(1))
    out = ld.dedup_lines(docs)
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "key", "n_lines", "n_dropped"]
    assert {(r.doc_id, r.text, r.n_lines) for r in out.collect()} == {(1, None, 1), (2, "a", 1)}
    assert ld.line_dedup_report(docs_of([])).count() == 0


def test_the_filter_grows_with_the_lines(docs_of):
    few = docs_of([(i, "the very same line of text\nx") for i in range(50)])
    many = docs_of([(i, "\n".join(f"line {k} of document {i} only" for k in range(200))) for i in range(1000)])
    assert ld.filter_size(few) == ld.LEAST_FILTER_BITS and ld.filter_size(docs_of([])) == ld.LEAST_FILTER_BITS
    assert 16 * 180_000 <= ld.filter_size(many) <= 64 * 220_000


def test_rows_without_id_do_not_meet(docs_of):
    shared = [f"line {k} that three documents share" for k in range(40)]
    rows = [(i, "\n".join(shared)) for i in (1, 2, 3)]
    rows += [(None, f"{shared[k]}\nnameless row {k} of its own") for k in range(40)] + [(None, f"{shared[0]}\nagain")] * 3
    docs = docs_of(rows).withColumnRenamed("text", "Text")
    suspects = ld.suspected_keys(docs, ld.repeat_filter(docs))
    nameless = suspects.where("doc_id IS NULL").groupBy("nameless").count().collect()
    assert len(nameless) == 41 and max(r["count"] for r in nameless) <= 6
    out = ld.dedup_lines(docs)
    assert out.columns == [*docs.columns, "n_lines", "n_dropped"]
    wanted = sorted((str(i), n, d) for i, n, d, _ in brute_force(rows))
    assert sorted((str(r.doc_id), r.n_lines, r.n_dropped) for r in out.collect()) == wanted
