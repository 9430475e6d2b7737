"""Registered queries of this package: each applies one operator with its
production parameters to its whole table. ``ORACLE`` holds the DuckDB SQL of
those that SQL can express; the others are tested against brute force."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from aerolith.llm import (
    decontaminate,
    fingerprint,
    htmltext,
    langid,
    linededup,
    packing,
    pieces,
    pii,
    quality,
    simhash,
    vectorcodes,
    warc,
    whitening,
)

Query = Callable[[SparkSession, str], DataFrame]


ROOT = str(Path(__file__).resolve().parents[2])


def importable(fn: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """Let Python workers import this package from where the driver has it,
    for sessions that were started without it on their path."""

    def run(spark: SparkSession, *args) -> DataFrame:
        spark.sparkContext.environment.setdefault("PYTHONPATH", ROOT)
        return fn(spark, *args)

    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packing_report(_table(spark, sf_dir, "documents"))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.edit_report(_table(spark, sf_dir, "documents"))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.warc_round_trip(_table(spark, sf_dir, "pages"))


def op5_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.language_report(_table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.line_dedup_report(_table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return htmltext.main_text_report(_table(spark, sf_dir, "pages"))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_report(_table(spark, sf_dir, "documents"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontamination_report(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pii_report(_table(spark, sf_dir, "documents"))


def op11_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.piece_report(_table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return vectorcodes.vector_code_report(_table(spark, sf_dir, "embeddings"))


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitening_report(_table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Query] = {
    "op1_packing": op1_packing,
    "op2_quality": op2_quality,
    "op3_fingerprints": op3_fingerprints,
    "op4_warc": op4_warc,
    "op5_language": op5_language,
    "op6_line_dedup": op6_line_dedup,
    "op7_main_text": op7_main_text,
    "op8_simhash": op8_simhash,
    "op9_decontamination": op9_decontamination,
    "op10_pii": op10_pii,
    "op11_pieces": op11_pieces,
    "op12_vector_codes": op12_vector_codes,
    "op13_whitening": op13_whitening,
}

QUERIES = {name: importable(fn) for name, fn in QUERIES.items()}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _nearest(book: str) -> str:
    """Nearest entry of ``book`` and its squared distance, per row and part."""
    return f"""
SELECT r, part, arg_min(e, (d, e)) AS e, min(d) AS d
FROM (SELECT r, part, e, CAST(sum((x - c) * (x - c)) AS BIGINT) AS d FROM cells JOIN {book} USING (part, dim) GROUP BY r, part, e)
GROUP BY r, part"""


def _moved(book: str, assigned: str) -> str:
    """``book`` with its used entries at the floor of their parts' means."""
    return f"""
SELECT part, dim, e, CASE WHEN n IS NULL THEN c ELSE CAST((s - ((s % n) + n) % n) // n AS BIGINT) END AS c
FROM {book} LEFT JOIN (SELECT part, dim, e, sum(x) AS s, count(*) AS n FROM cells JOIN {assigned} USING (r, part) GROUP BY part, dim, e)
     USING (part, dim, e)"""


VECTOR_CODES = f"""
WITH kept AS (
    SELECT vec_id, label, row_number() OVER (ORDER BY vec_id NULLS LAST, embedding) AS r,
           list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
cells AS (
    SELECT r, dim, CAST(dim * 16 // len(v) AS BIGINT) AS part, v[dim + 1] AS x
    FROM (SELECT r, v, unnest(range(0, len(v))) AS dim FROM kept)
),
book0 AS (SELECT part, dim, r - 1 AS e, x AS c FROM cells WHERE r <= 64),
near0 AS ({_nearest("book0")}),
book1 AS ({_moved("book0", "near0")}),
near1 AS ({_nearest("book1")}),
book2 AS ({_moved("book1", "near1")}),
near2 AS ({_nearest("book2")}),
codes AS (
    SELECT r, string_agg(printf('%02x', e), '' ORDER BY part) AS code, CAST(sum(d) AS BIGINT) AS error FROM near2 GROUP BY r
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY part, e, dim)) FROM book2) AS codebooks_sha256
FROM kept JOIN codes USING (r)
"""

ORACLE: dict[str, str] = {
    "op4_warc": """
SELECT page_id, url, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest,
       CASE WHEN first_id <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM (SELECT *, CASE WHEN strlen(html) >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first_id
      FROM pages)
""",
    "op6_line_dedup": rf"""
WITH lines AS (
    SELECT doc_id, place, line,
           translate(regexp_replace(line, '^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$', '', 'g'), '{UPPER}', '{LOWER}') AS key
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
                 generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS place
          FROM documents)
), repeated AS (
    SELECT key, max(doc_id) AS keeper FROM lines
    WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT l.*, coalesce(r.keeper <> l.doc_id, false) AS dropped FROM lines l LEFT JOIN repeated r USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY place) FILTER (NOT dropped), '')) AS kept_sha256
FROM marked GROUP BY doc_id
""",
    "op9_decontamination": f"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
i AS (SELECT item_id, w FROM (SELECT item_id, {WORDS} AS w FROM benchmark) WHERE len(w) > 0),
item_windows AS (
    SELECT DISTINCT item_id, w[s : s + least(13, len(w)) - 1] AS win
    FROM (SELECT *, unnest(range(1, greatest(len(w) - 13, 0) + 2)) AS s FROM i)
),
sizes AS (SELECT DISTINCT len(win) AS n FROM item_windows),
doc_windows AS (
    SELECT doc_id, s, n, w[s : s + n - 1] AS win
    FROM (SELECT *, unnest(range(1, len(w) - n + 2)) AS s FROM d CROSS JOIN sizes WHERE len(w) >= n)
),
hits AS (SELECT doc_id, s, n, item_id FROM doc_windows JOIN item_windows USING (win)),
words_hit AS (
    SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM hits) GROUP BY doc_id
),
items_hit AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
    FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN words_hit USING (doc_id) LEFT JOIN items_hit USING (doc_id)
""",
    "op12_vector_codes": VECTOR_CODES,
}
