"""Document quality by nearest-neighbour voting over latent-semantic vectors.

*Features* of a whole text, by numpy over its bytes: trigrams of byte classes
(the look of a text: case, digits, punctuation, spacing), hashed byte trigrams
(its language and words), and how often a word repeats the one before it or a
line the one before it.

*Vectors.* Log counts, weighted by inverse document frequency in the sample and
normalized per feature group, are projected on the leading singular vectors of
the labelled sample (randomized SVD in numpy).

*Vote.* The labelled vectors are broadcast: at most ``2 * per_label`` of
``rank`` numbers, whatever the corpus. Every document's cosines with all of
them are computed exactly, block by block, and the labels of the ``neighbours``
most similar are averaged with weights that grow with similarity. Labels are
sampled evenly and a vote of 0.5 means both are as near.

Labels are learnt only from rows outside the held-out part; labels, lang,
source and id are never inputs of a score. Null text counts as empty; a text
without features, and every text if there is no label to learn from, scores the
share of label 1 in the sample (1.0 without any). Null ids are held out. Of
several rows of an id the text with the lowest hash is learnt from; all are
scored.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from aerolith.llm.arrow import add_columns
from aerolith.llm.sampling import Sparse, dense, id_remainder, sample_per_label, sampled_features

PER_LABEL = 2048
RANK = 64
NEIGHBOURS = 25
SHARPNESS = 30.0
KEEP_SCORE = 0.3
BLOCK = 256
HELD_OUT_FOLDS, HELD_OUT_FOLD = 5, 0

# Byte classes: control, line break, space, digit, upper, lower, beyond ASCII,
# and the punctuation marks in eight groups.
CLASSES = 16
PUNCTUATION = (".", ",", "!?", "|/\\", "$%&#@*+=~^", "\"'`", "()[]{}<>", "-_:;")
CLASS_GRAMS = CLASSES**3
BYTE_GRAMS = 2048
REPEATS = 64
WIDTH = CLASS_GRAMS + BYTE_GRAMS + REPEATS
GROUPS = ((0, CLASS_GRAMS, 1.0), (CLASS_GRAMS, CLASS_GRAMS + BYTE_GRAMS, 0.4), (CLASS_GRAMS + BYTE_GRAMS, WIDTH, 1.0))


def _class_table() -> np.ndarray:
    table = np.zeros(256, np.uint32)
    table[10], table[32], table[48:58], table[65:91], table[97:123], table[128:] = 1, 2, 3, 4, 5, 6
    for i, marks in enumerate(PUNCTUATION, start=7):
        table[[ord(c) for c in marks]] = i
    return table


CLASS_OF = _class_table()


def _share_bin(part: int, whole: int, bins: int) -> int:
    """Logarithmic bin of a share: 0 for none, then doublings up to all."""
    return 0 if not part else max(1, bins - 1 - int(np.floor(2 * np.log2(whole / part))))


def text_features(text: str) -> Sparse:
    data = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    counts = np.zeros(WIDTH, np.float32)
    if len(data) >= 3:
        kind = CLASS_OF[data]
        grams = (kind[:-2] * CLASSES + kind[1:-1]) * CLASSES + kind[2:]
        counts[:CLASS_GRAMS] = np.bincount(grams, minlength=CLASS_GRAMS)
        raw = data.astype(np.uint32)
        mixed = raw[:-2] * np.uint32(0x9E3779B1) + raw[1:-1] * np.uint32(0x85EBCA6B) + raw[2:] * np.uint32(0xC2B2AE35)
        mixed ^= mixed >> np.uint32(15)
        counts[CLASS_GRAMS : CLASS_GRAMS + BYTE_GRAMS] = np.bincount((mixed * np.uint32(0x2C1B3C6D)) >> np.uint32(21), minlength=BYTE_GRAMS)
    words, lines = text.split(), text.split("\n")
    if words:
        half = REPEATS // 2
        again = sum(map(str.__eq__, words, words[1:]))
        counts[CLASS_GRAMS + BYTE_GRAMS + _share_bin(again, len(words), half)] = 1
        counts[CLASS_GRAMS + BYTE_GRAMS + half + _share_bin(sum(map(str.__eq__, lines, lines[1:])), len(lines), half)] = 1
    places = np.flatnonzero(counts)
    return places, counts[places]


@dataclass
class Model:
    """``idf`` and ``basis`` make vectors; ``vectors`` and ``labels`` vote."""

    idf: np.ndarray
    basis: np.ndarray
    vectors: np.ndarray
    labels: np.ndarray
    share: float

    def embed(self, rows: list[Sparse]) -> np.ndarray:
        return _unit(weighted(rows, self.idf) @ self.basis)

    def scores(self, rows: list[Sparse]) -> np.ndarray:
        if not len(self.labels):
            return np.full(len(rows), self.share)
        vectors = self.embed(rows)
        cosine = vectors @ self.vectors.T
        k = min(NEIGHBOURS, len(self.labels))
        near = np.argpartition(-cosine, k - 1, axis=1)[:, :k] if k < len(self.labels) else np.tile(np.arange(k), (len(rows), 1))
        weight = np.exp(SHARPNESS * (np.take_along_axis(cosine, near, axis=1).astype(np.float64) - 1))
        score = (weight * self.labels[near]).sum(axis=1) / weight.sum(axis=1)
        return np.where(vectors.any(axis=1), np.clip(score, 0.0, 1.0), self.share)


def _unit(rows: np.ndarray) -> np.ndarray:
    length = np.linalg.norm(rows, axis=1, keepdims=True)
    return rows / np.where(length > 0, length, 1)


def weighted(rows: list[Sparse], idf: np.ndarray) -> np.ndarray:
    """Log counts by inverse document frequency, each feature group of unit length."""
    out = np.log1p(dense(rows, WIDTH)) * idf
    for start, end, share in GROUPS:
        out[:, start:end] = _unit(out[:, start:end]) * share
    return out


def fit(labelled: list[tuple[str, Sparse]], rank: int = RANK, seed: int = 0) -> Model:
    labels = np.array([float(label) for label, _ in labelled])
    rows = [sparse for _, sparse in labelled]
    if not rows:
        return Model(np.ones(WIDTH, np.float32), np.zeros((WIDTH, 1), np.float32), np.zeros((0, 1), np.float32), labels, 1.0)
    seen = np.zeros(WIDTH)
    for places, _ in rows:
        seen[places] += 1
    idf = (np.log((1 + len(rows)) / (1 + seen)) + 1).astype(np.float32)
    matrix = weighted(rows, idf)
    rank = min(rank, *matrix.shape)
    # Randomized SVD: a random range finder with two power iterations.
    random = np.random.default_rng(seed).standard_normal((WIDTH, rank + 16), dtype=np.float32)
    found = np.linalg.qr(matrix @ random)[0]
    for _ in range(2):
        found = np.linalg.qr(matrix @ np.linalg.qr(matrix.T @ found)[0])[0]
    basis = np.linalg.svd(found.T @ matrix, full_matrices=False)[2][:rank].T.astype(np.float32)
    return Model(idf, basis, _unit(matrix @ basis), labels, float(labels.mean()))


def train(docs: DataFrame, labels: DataFrame, label: str = "quality", per_label: int = PER_LABEL) -> Model:
    """Fit on at most ``per_label`` documents of each label 0 and 1 outside the
    held-out part."""
    learnt = labels.where((id_remainder(F.col("doc_id"), HELD_OUT_FOLDS) != HELD_OUT_FOLD) & F.col(label).isin(0, 1))
    sample = sample_per_label(learnt.select("doc_id", label), label, per_label)
    return fit(sampled_features(docs, sample, text_features))


def score_documents(docs: DataFrame, model: Model, out_col: str = "quality_score") -> DataFrame:
    """``docs`` with a score between 0 and 1 (a column of that name is replaced)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(texts: pa.Array) -> list[pa.Array]:
        return [pa.array(shared.value.scores([text_features(t.as_py() or "") for t in texts]), pa.float64())]

    return add_columns(docs, F.col("text").cast("string"), [T.StructField(out_col, T.DoubleType())], make, BLOCK)


def quality_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    scored = score_documents(docs.select("doc_id", "text"), train(docs, labels), "score")
    return scored.select(
        "doc_id",
        F.coalesce(id_remainder(F.col("doc_id"), HELD_OUT_FOLDS) == HELD_OUT_FOLD, F.lit(True)).alias("held_out"),
        "score",
        (F.col("score") >= KEEP_SCORE).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``docs`` without those the classifier rejects."""
    scored = score_documents(docs, train(docs, labels), "__quality")
    return scored.where(F.col("__quality") >= KEEP_SCORE).drop("__quality")
