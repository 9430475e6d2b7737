"""Benchmark decontamination: a prefix-filtered set join with exact checks.

An item is cut into *windows* of ``window_words`` consecutive words (a shorter
item is one window). A document is hit where a whole window occurs in it.

Method, in DataFrame operations only:

1. *Order.* The shingles of the join are single words, ordered by how often
   they occur in all documents (rarest first, ties by the word).
2. *Prefix.* A window occurs only if all its words do, so of its words in that
   order a prefix of one, the rarest, must meet the document (overlap
   ``t = |w|`` gives a prefix of ``|w| - t + 1``). Document words join on it.
3. *Bounds.* The document must have room for the window around the meeting
   position: enough words before it and after it.
4. *Verify.* The slice of the document of exactly the window's size must equal
   the window, word for word.

The words of a document are exploded one by one, but its array is only sliced
where a prefix word met, inside the same generated-code stage as the join, so
nothing is copied per word. Verified windows become intervals of word
positions; their union per document is counted with a running maximum over a
sort (spillable, no arrays of hits).

Items of equal text are one *text*; its windows are cut once and the item ids
are joined back to the hits. The windows are written, their size is measured,
and they are broadcast in blocks of at most about ``broadcast_bytes``, dealt by a
hash of the window, so neither a huge item nor many copies of one make a block
larger. The documents are scanned once to count words and once per block: a
stated query set against all rows, whose memory is bounded and whose document
words are never shuffled. The benchmark's vocabulary is broadcast up to the same
bound; a larger one is joined to the counts of all words.

Documents are identified by ``(doc_id, hash of the text)``, so null ids and
repeated rows need no special care: equal rows have equal results and each
row is returned. Null or empty text has no words, no hits and is clean. A null
or empty item has no windows. A null item id is listed as ``null``. Items that
share an id count once. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from aerolith.llm.textnorm import ascii_lower
from aerolith.session import materialize

WINDOW_WORDS = 13
MIN_HIT_SHARE = 0.05
# Of windows, as Spark holds their rows: some 4 MB of item text.
BROADCAST_BYTES = 64 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++"
NOT_CASED_WORD = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]++"


def _between(text: Column, separators: str) -> Column:
    """What lies between the separators. A split, since extracting every match
    of a pattern copies the text once a match."""
    return F.array_remove(F.split(text, separators), "")


def words(text: Column) -> Column:
    """Words of a text, A-Z lower-cased; null has none."""
    return _between(ascii_lower(F.coalesce(text, F.lit(""))), NOT_WORD)


def count_words(text: Column) -> Column:
    # Case does not change where words begin and end, once A-Z count as word characters.
    return F.size(_between(F.coalesce(text, F.lit("")), NOT_CASED_WORD)).cast("long")


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")


def _doc_words(docs: DataFrame) -> DataFrame:
    """One row per word position; ``posexplode_outer`` so that the optimizer
    infers no size filter that would split every text twice."""
    split = _keyed(docs).select("doc_id", "text_hash", words(F.col("text")).alias("doc_words"))
    return split.select("doc_id", "text_hash", "doc_words", F.posexplode_outer("doc_words").alias("at", "word"))


def _held_bytes(strings: Column) -> Column:
    """What an array of strings takes in a row: words of 8 bytes, and 16 each
    for the row and for every string's place and offset."""
    return F.aggregate(strings, F.lit(64).cast("long"), lambda n, w: n + 16 + F.octet_length(w))


def word_counts(docs: DataFrame, vocabulary: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """How often each word of ``vocabulary`` (a written table) occurs in all
    documents."""
    size = vocabulary.agg(F.coalesce(F.sum(F.octet_length("word") + 64), F.lit(0)).alias("n")).first()["n"]
    if size <= broadcast_bytes:
        met = _doc_words(docs).select("word").join(F.broadcast(vocabulary), "word")
        return met.groupBy("word").agg(F.count("*").alias("n_docs_words"))
    counted = _doc_words(docs).groupBy("word").agg(F.count("*").alias("n_docs_words"))
    return vocabulary.join(counted, "word")


def distinct_texts(items: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``text_no, item_words`` of every different text that has words, and
    ``text_no, item_id`` (ids as strings, distinct)."""
    rows = items.select(F.coalesce(F.col("item_id").cast("string"), F.lit("null")).alias("item_id"), "text").where(F.col("text").isNotNull())
    numbered = rows.select("text").distinct().withColumn("text_no", F.monotonically_increasing_id())
    texts = materialize(numbered, "item-texts")  # numbers hold once they are written
    ids = rows.join(texts, "text").select("text_no", "item_id").distinct()
    listed = texts.select("text_no", words(F.col("text")).alias("item_words")).where(F.size("item_words") > 0)
    return listed, ids


def item_windows(texts: DataFrame, docs: DataFrame, window_words: int, broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Windows of all texts, written: ``text_no, window (array), size, prefix
    (its rarest word), before (words of the window before the prefix word)``.
    Words that no document has are the rarest; their windows can't occur."""
    vocabulary = materialize(texts.select(F.explode("item_words").alias("word")).distinct(), "item-vocabulary")
    counts = materialize(word_counts(docs, vocabulary, broadcast_bytes), "item-word-counts")
    starts = F.sequence(F.lit(0), F.greatest(F.size("item_words") - window_words, F.lit(0)))
    windows = texts.select("text_no", "item_words", F.explode(starts).alias("start")).select(
        "text_no", F.slice("item_words", F.col("start") + 1, window_words).alias("window")
    )
    placed = windows.distinct().select("text_no", "window", F.posexplode("window").alias("before", "word"))
    ranked = placed.join(counts, "word", "left").groupBy("text_no", "window")
    rarest = F.min(F.struct(F.coalesce("n_docs_words", F.lit(0)).alias("n"), "word", "before"))
    table = ranked.agg(rarest.alias("rarest")).select(
        "text_no",
        "window",
        F.size("window").alias("size"),
        F.col("rarest.word").alias("prefix"),
        F.col("rarest.before").alias("before"),
    )
    return materialize(table, "item-windows")


def window_blocks(windows: DataFrame, broadcast_bytes: int = BROADCAST_BYTES) -> list[DataFrame]:
    """The windows in blocks of at most about ``broadcast_bytes``, by a hash of
    the row: one block, the table itself, while it is that small."""
    size = windows.agg(F.coalesce(F.sum(_held_bytes(F.col("window"))), F.lit(0)).alias("n")).first()["n"]
    n = max(1, -(-size // broadcast_bytes))
    block = F.pmod(F.xxhash64("text_no", "window"), F.lit(n))
    return [windows] if n == 1 else [windows.where(block == i) for i in range(n)]


def _occurrences(docs: DataFrame, windows: DataFrame) -> DataFrame:
    """Verified windows: ``doc_id, text_hash, text_no, first, last`` (word
    positions, both inclusive)."""
    first = F.col("at") - F.col("before")
    room = (first >= 0) & (first + F.col("size") <= F.size("doc_words"))
    same = F.slice("doc_words", F.greatest(first, F.lit(0)) + 1, F.col("size")) == F.col("window")
    met = _doc_words(docs).join(F.broadcast(windows), (F.col("word") == F.col("prefix")) & room & same)
    return met.select("doc_id", "text_hash", "text_no", first.alias("first"), (first + F.col("size") - 1).alias("last"))


def find_hits(
    docs: DataFrame,
    items: DataFrame,
    window_words: int = WINDOW_WORDS,
    broadcast_bytes: int = BROADCAST_BYTES,
) -> DataFrame:
    """Verified hits per document that has any: ``doc_id, text_hash, n_hit``
    (words inside any hit) and ``item_ids`` (sorted array of strings)."""
    texts, ids = distinct_texts(items)
    found = None
    for block in window_blocks(item_windows(texts, docs, window_words, broadcast_bytes), broadcast_bytes):
        part = _occurrences(docs, block)
        found = part if found is None else found.unionByName(part)
    doc = ["doc_id", "text_hash"]
    # Windows that start together collapse before the shuffle.
    starts = found.groupBy(*doc, "first").agg(F.max("last").alias("last"), F.collect_set("text_no").alias("texts"))
    in_order = Window.partitionBy(*doc).orderBy("first")
    covered = F.max("last").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.greatest(F.col("last") - F.greatest(F.coalesce(covered, F.lit(-1)), F.col("first") - 1), F.lit(0))
    per_doc = starts.withColumn("fresh", fresh).groupBy(*doc).agg(
        F.sum("fresh").cast("long").alias("n_hit"), F.array_distinct(F.flatten(F.collect_set("texts"))).alias("texts")
    )
    # Written: it is read twice, and the joins are planned by its real size.
    per_doc = materialize(per_doc, "hits")
    listed = per_doc.select(*doc, F.explode("texts").alias("text_no")).join(ids, "text_no")
    listed = listed.groupBy(*doc).agg(F.array_sort(F.collect_set("item_id")).alias("item_ids"))
    named = per_doc.drop("texts").alias("p").join(
        listed.alias("l"), F.col("p.doc_id").eqNullSafe(F.col("l.doc_id")) & (F.col("p.text_hash") == F.col("l.text_hash"))
    )
    return named.select("p.doc_id", "p.text_hash", "n_hit", "item_ids")


def mark_contaminated(
    docs: DataFrame, items: DataFrame, window_words: int = WINDOW_WORDS, min_hit_share: float = MIN_HIT_SHARE
) -> DataFrame:
    """Every row of ``docs`` (``doc_id, text``) with ``n_words, n_hit,
    item_ids, contaminated``; contaminated if hits cover at least
    ``min_hit_share`` of its words."""
    hits = find_hits(docs, items, window_words).select(
        F.col("doc_id").alias("hit_doc"), F.col("text_hash").alias("hit_hash"), "n_hit", "item_ids"
    )
    rows = _keyed(docs).select("doc_id", "text_hash", count_words(F.col("text")).alias("n_words"))
    joined = rows.join(
        hits, F.col("doc_id").eqNullSafe(F.col("hit_doc")) & (F.col("text_hash") == F.col("hit_hash")), "left"
    )
    n_hit = F.coalesce("n_hit", F.lit(0).cast("long"))
    # Compared as n_hit / share >= n_words: 20 * n_hit >= n_words at 0.05, in whole numbers.
    enough = n_hit * F.lit(round(1 / min_hit_share)) >= F.col("n_words")
    return joined.select(
        "doc_id",
        "text_hash",
        "n_words",
        n_hit.alias("n_hit"),
        F.coalesce("item_ids", F.array().cast("array<string>")).alias("item_ids"),
        ((n_hit > 0) & enough).alias("contaminated"),
    )


def decontamination_report(docs: DataFrame, items: DataFrame) -> DataFrame:
    marked = mark_contaminated(docs, items)
    return marked.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.array_join("item_ids", ","), 256).alias("items_sha256"),
        "contaminated",
    )


def remove_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` without the contaminated rows, all columns kept. Only the keys
    of contaminated documents are joined back; they are written first, so the
    join is planned by their real size."""
    marked = mark_contaminated(docs.select("doc_id", "text"), items).where("contaminated")
    bad = marked.select(F.col("doc_id").alias("__bad_doc"), F.col("text_hash").alias("__bad_hash")).distinct()
    bad = materialize(bad, "contaminated")
    match = F.col("doc_id").eqNullSafe(F.col("__bad_doc")) & (F.xxhash64("text") == F.col("__bad_hash"))
    return docs.join(bad, match, "left_anti")
