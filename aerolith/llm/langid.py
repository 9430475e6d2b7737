"""Language identification with averaged hashed subword embeddings.

A text is lower-cased and its ASCII non-letters become spaces; byte 3- and
4-grams that do not reach over a space inside are hashed into ``BUCKETS``. The
average of their embeddings goes into a linear softmax. Embeddings and softmax
are trained together by stochastic gradient descent in numpy on a bounded
sample of labelled documents.

*Calibration.* A fifth of the sample is not trained on. It fixes the softmax
temperature (least log loss) and the score below which a prediction is
``rejected``: the one that ``ACCEPTED`` of its right predictions reach.

Only text and non-null ``lang`` of rows outside the held-out part are learnt
from; lang, source and id are never inputs of a prediction. A null text or one
without a letter is ``und`` with score 0; so is every text if nothing could be
learnt. A text with letters always gets a learnt language and its probability;
``rejected`` says whether to trust it. Null ids are held out. Of several rows of
an id the text with the lowest hash is learnt from; all are predicted. Every
language is learnt, however many there are.
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

BUCKETS = 8192
DIMENSIONS = 16
GRAMS = (3, 4)
PER_LANGUAGE = 1000
MOST_ROWS = 8000
EPOCHS, BATCH, RATE = 8, 32, 2.0
ACCEPTED = 0.995
BLOCK = 256
UNDETERMINED = "und"
HELD_OUT_FOLDS, HELD_OUT_FOLD = 3, 1
SPACE = 32


def _letter_table() -> np.ndarray:
    table = np.full(256, SPACE, np.uint32)
    table[97:123], table[128:] = np.arange(97, 123), np.arange(128, 256)
    return table


LETTER = _letter_table()


def subword_counts(text: str) -> Sparse:
    """Hashed counts of the subwords of a whole text."""
    data = LETTER[np.frombuffer(f" {text.lower()} ".encode("utf-8", "surrogatepass"), np.uint8)]
    # One space between words is enough.
    data = data[np.append(True, (data[1:] != SPACE) | (data[:-1] != SPACE))]
    counts = np.zeros(BUCKETS, np.int64)
    for n in GRAMS:
        m = len(data) - n + 1
        if m <= 0:
            continue
        mixed = np.full(m, n * 0x27D4EB2F & 0xFFFFFFFF, np.uint32)
        inside = np.ones(m, bool)
        for i in range(n):
            mixed = (mixed ^ data[i : i + m]) * np.uint32(0x01000193)
            if 0 < i < n - 1:
                inside &= data[i : i + m] != SPACE
        mixed ^= mixed >> np.uint32(15)
        mixed *= np.uint32(0x2C1B3C6D)
        counts += np.bincount(mixed[inside] >> np.uint32(19), minlength=BUCKETS)
    places = np.flatnonzero(counts)
    return places, counts[places].astype(np.float32)


def has_letter(text: str | None) -> bool:
    return any(map(str.isalpha, text or ""))


def _softmax(logits: np.ndarray) -> np.ndarray:
    top = np.exp(logits - logits.max(axis=1, keepdims=True))
    return top / top.sum(axis=1, keepdims=True)


@dataclass
class Model:
    languages: list[str]
    embeddings: np.ndarray
    weights: np.ndarray
    temperature: float
    reject_below: float

    def predict(self, rows: list[Sparse]) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the most probable languages, and their probabilities."""
        odds = _softmax(averages(rows) @ self.embeddings @ self.weights / self.temperature)
        best = odds.argmax(axis=1)
        return best, np.clip(odds[np.arange(len(best)), best], 0.0, 1.0)


def averages(rows: list[Sparse]) -> np.ndarray:
    counts = dense(rows, BUCKETS)
    return counts / np.maximum(counts.sum(axis=1, keepdims=True), 1)


def fit(labelled: list[tuple[str, Sparse]], seed: int = 0) -> Model | None:
    languages = sorted({label for label, _ in labelled})
    if not languages:
        return None
    random = np.random.default_rng(seed)
    order = random.permutation(len(labelled))
    target = np.array([languages.index(labelled[i][0]) for i in order])
    rows = [labelled[i][1] for i in order]
    n_check = len(rows) // 5
    embeddings = random.normal(0, 0.1, (BUCKETS, DIMENSIONS)).astype(np.float32)
    weights = np.zeros((DIMENSIONS, len(languages)), np.float32)
    train = np.arange(n_check, len(rows))
    for epoch in range(EPOCHS):
        rate = RATE * (1 - epoch / EPOCHS)
        for start in range(0, len(train), BATCH):
            batch = train[start : start + BATCH] if epoch == 0 else random.choice(train, BATCH)
            share = averages([rows[i] for i in batch])
            hidden = share @ embeddings
            error = _softmax(hidden @ weights)
            error[np.arange(len(batch)), target[batch]] -= 1
            error *= rate / len(batch)
            # Both steps use the weights from before either.
            back = share.T @ (error @ weights.T)
            weights -= hidden.T @ error
            embeddings -= back * DIMENSIONS
    model = Model(languages, embeddings, weights, 1.0, 0.0)
    if n_check:
        _calibrate(model, rows[:n_check], target[:n_check])
    return model


def _calibrate(model: Model, rows: list[Sparse], target: np.ndarray) -> None:
    logits = averages(rows) @ model.embeddings @ model.weights

    def log_loss(temperature: float) -> float:
        return -float(np.log(_softmax(logits / temperature)[np.arange(len(target)), target] + 1e-12).mean())

    model.temperature = min(np.geomspace(0.5, 10, 41).tolist(), key=log_loss)
    best, score = model.predict(rows)
    right = score[best == target]
    model.reject_below = float(np.quantile(right, 1 - ACCEPTED)) if len(right) else 0.0


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, most_rows: int = MOST_ROWS) -> Model | None:
    """Fit on at most ``per_language`` documents of each language; with so many
    languages that these exceed ``most_rows``, on an equal share of each, at
    least one. Feature rows on the driver are bounded by that."""
    learnt = docs.where(F.col("lang").isNotNull() & (id_remainder(F.col("doc_id"), HELD_OUT_FOLDS) != HELD_OUT_FOLD))
    n_languages = learnt.select("lang").distinct().count()
    quota = max(1, min(per_language, most_rows // max(n_languages, 1)))
    sample = sample_per_label(learnt.select("doc_id", "lang"), "lang", quota)
    return fit(sampled_features(learnt, sample, subword_counts, "lang"))


def identify_languages(docs: DataFrame, model: Model | None) -> DataFrame:
    """``docs`` with ``lang_pred``, ``score`` and ``rejected`` (columns of
    these names are replaced)."""
    added = [("lang_pred", T.StringType()), ("score", T.DoubleType()), ("rejected", T.BooleanType())]
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make(column: pa.Array) -> list[pa.Array]:
        known = shared.value
        texts = column.to_pylist()
        told = np.array([known is not None and has_letter(t) for t in texts], bool)
        langs, scores = [UNDETERMINED] * len(texts), np.zeros(len(texts))
        if told.any():
            best, scores[told] = known.predict([subword_counts(t) for t, ok in zip(texts, told) if ok])
            for i, b in zip(np.flatnonzero(told), best):
                langs[i] = known.languages[b]
        rejected = scores < (known.reject_below if known else 1.0)
        return [pa.array(langs, pa.string()), pa.array(scores, pa.float64()), pa.array(rejected | ~told, pa.bool_())]

    return add_columns(docs, F.col("text").cast("string"), [T.StructField(name, kind) for name, kind in added], make, BLOCK)


def language_report(docs: DataFrame) -> DataFrame:
    found = identify_languages(docs.select("doc_id", "text"), train(docs))
    held_out = F.coalesce(id_remainder(F.col("doc_id"), HELD_OUT_FOLDS) == HELD_OUT_FOLD, F.lit(True))
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score", "rejected")
