"""Held-out accuracy and edge cases of the two trained operators."""

from __future__ import annotations

import zlib

import numpy as np

from aerolith.llm import langid, quality
from aerolith.llm.sampling import sample_per_label

SF = "/root/testdata/sf0.01"
ODD = [(None, None), (50_001, ""), (50_002, "123 !!"), (50_003, "z" * 200_000), (50_003, "z"), (50_004, "\n \n")]


def fold(doc_id, n):
    return zlib.crc32(str(doc_id).encode()) % n


def test_quality_on_held_out_labels(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(docs_of(ODD))
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    known = {r.doc_id: r.quality for r in labels.collect()}
    rows = quality.quality_report(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (r.doc_id is None or fold(r.doc_id, 5) == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in rows)
    held = [(r.predicted, known[r.doc_id]) for r in rows if r.held_out and r.doc_id in known]
    good, bad = ([p for p, y in held if y == v] for v in (1, 0))
    assert np.mean(good) >= 0.98 and np.mean(bad) <= 0.1


def test_quality_scores_do_not_depend_on_other_columns(spark, docs_of):
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    docs = docs_of([(i, f"Good plain text number {i}." if i % 2 else "BUY!! NOW!! " * 5) for i in range(40)])
    model = quality.train(docs, labels)
    frame = docs.withColumn("quality_score", quality.F.lit("mine"))
    first = {r.doc_id: r.quality_score for r in quality.score_documents(frame, model).collect()}
    other = frame.withColumn("lang", quality.F.lit("xx")).withColumn("source", quality.F.lit(None).cast("string"))
    assert first == {r.doc_id: r.quality_score for r in quality.score_documents(other, model).collect()}
    assert {r.doc_id for r in quality.keep_good(docs, labels).collect()} == {i for i in range(40) if i % 2}


def test_quality_without_labels_or_documents(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.score for r in quality.quality_report(docs_of([(1, "a"), (2, None)]), none).collect()] == [1.0, 1.0]
    assert quality.quality_report(docs_of([]), none).count() == 0


def test_language_on_held_out_rows(spark, docs_of):
    docs = spark.read.parquet(f"{SF}/documents.parquet").unionByName(docs_of(ODD))
    langs = {r.doc_id: r.lang for r in docs.collect()}
    rows = langid.language_report(docs).collect()
    assert len(rows) == docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert all(r.held_out == (r.doc_id is None or fold(r.doc_id, 3) == 1) for r in rows)
    odd = {r.doc_id: r.lang_pred for r in rows if r.doc_id in (None, 50_001, 50_002, 50_004)}
    assert set(odd.values()) == {"und"}
    held = [r for r in rows if r.held_out and r.doc_id is not None and r.doc_id < 50_000]
    assert np.mean([r.lang_pred == langs[r.doc_id] for r in held]) >= 0.97
    right = [not r.rejected for r in held if r.lang_pred == langs[r.doc_id]]
    assert np.mean(right) >= 0.9


def test_language_without_anything_to_learn(docs_of):
    docs = docs_of([(1, "text"), (2, None)]).withColumn("lang", langid.F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.language_report(docs).collect()} == {"und"}
    assert langid.language_report(docs_of([])).count() == 0


def test_samples_are_bounded_and_repeatable(spark):
    rows = spark.createDataFrame([(i % 500, i % 3) for i in range(3000)] + [(None, 1), (7, None)], "doc_id long, label int")
    once = sorted(tuple(r) for r in sample_per_label(rows.repartition(5), "label", 20).collect())
    assert once == sorted(tuple(r) for r in sample_per_label(rows.repartition(2), "label", 20).collect())
    assert len(once) == len({i for i, _ in once}) and max(np.bincount([v for _, v in once])) == 20


def test_quality_equals_an_all_pairs_vote(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(docs_of(ODD))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet")
    model = quality.train(docs, labels, per_label=60)
    text = {r.doc_id: r.text for r in docs.collect()}
    # Vectors, one text at a time, from the fitted weights only.
    vector = {}
    for i, t in text.items():
        places, counts = quality.text_features(t or "")
        row = np.zeros(quality.WIDTH)
        row[places] = np.log1p(counts) * model.idf[places]
        for start, end, share in quality.GROUPS:
            length = np.sqrt((row[start:end] ** 2).sum())
            row[start:end] *= share / length if length else 0
        out = row @ model.basis.astype(float)
        vector[i] = out / np.linalg.norm(out) if out.any() else out
    got = {r.doc_id: r.score for r in quality.score_documents(docs.where("doc_id <> 50003"), model, "score").collect()}
    for i, score in got.items():
        votes = sorted(((float(vector[i] @ v), y) for v, y in zip(model.vectors, model.labels)), reverse=True)[: quality.NEIGHBOURS]
        weights = [np.exp(quality.SHARPNESS * (c - 1)) for c, _ in votes]
        wanted = sum(w * y for w, (_, y) in zip(weights, votes)) / sum(weights) if vector[i].any() else model.share
        assert abs(score - wanted) < 2e-3, i
    # The voters are the labelled documents themselves.
    known = {r.doc_id: r.quality for r in labels.collect() if r.doc_id in text and fold(r.doc_id, 5)}
    voters = {tuple(np.round(v, 3)): y for v, y in zip(model.vectors, model.labels)}
    found = [voters.get(tuple(np.round(vector[i].astype(np.float32), 3))) for i in known]
    assert sum(f is not None for f in found) >= min(60, len(known)) * 0.9


def test_language_equals_a_plain_softmax(spark, docs_of):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").unionByName(docs_of(ODD))
    model = langid.train(docs, per_language=40)
    for r in langid.identify_languages(docs.where("doc_id <> 50003"), model).collect():
        if not any(c.isalpha() for c in r.text or ""):
            assert (r.lang_pred, r.score, r.rejected) == ("und", 0.0, True)
            continue
        places, counts = langid.subword_counts(r.text)
        mean = sum((n / counts.sum() * model.embeddings[p].astype(float) for p, n in zip(places, counts)), np.zeros(langid.DIMENSIONS))
        logits = [float(mean @ model.weights[:, k]) / model.temperature for k in range(len(model.languages))]
        odds = np.exp(np.array(logits) - max(logits))
        odds /= odds.sum()
        assert r.lang_pred == model.languages[int(odds.argmax())] and abs(r.score - odds.max()) < 1e-4
        assert r.rejected == (r.score < model.reject_below)


def test_repeated_ids_cost_no_class(spark, docs_of):
    rows = [(1, f"Good plain text, copy {i % 7}.") for i in range(10_000)] + [(i, "BUY!! NOW!!") for i in range(2, 12)]
    labels = spark.createDataFrame([(1, 1, 0)] * 50 + [(i, 0, 0) for i in range(2, 12)], "doc_id long, quality int, toxic int")
    model = quality.train(docs_of(rows), labels, per_label=10)
    assert sorted(model.labels) == [0.0] * (len(model.labels) - 1) + [1.0] and len(model.labels) >= 3
    langs = docs_of(rows).withColumn("lang", langid.F.when(langid.F.col("doc_id") == 1, "xx").otherwise("yy"))
    assert langid.train(langs, per_language=10).languages == ["xx", "yy"]


def test_many_languages_are_all_learnt(spark, docs_of):
    docs = docs_of([(i, "".join(chr(97 + (i % 100 * k) % 26) for k in range(1, 40))) for i in range(3000)])
    docs = docs.withColumn("lang", langid.F.format_string("l%02d", langid.F.col("doc_id") % 100))
    assert len(langid.train(docs, most_rows=300).languages) == 100
    assert len(langid.train(docs, most_rows=10).languages) == 100


def test_names_in_another_case(spark, docs_of):
    docs = docs_of([(i, f"some text {i}") for i in range(30)]).withColumnRenamed("text", "Text").withColumnRenamed("lang", "LANG")
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(30)], "doc_id long, quality int, toxic int")
    assert quality.keep_good(docs, labels).columns == docs.columns
    assert langid.identify_languages(docs, langid.train(docs)).columns == [*docs.columns, "lang_pred", "score", "rejected"]


def test_samples_are_the_lowest_hashes(spark):
    rows = spark.range(50_000).select("id", (langid.F.col("id") % 3 == 0).cast("int").alias("label")).withColumnRenamed("id", "doc_id")
    got = {(r.doc_id, r.label) for r in sample_per_label(rows, "label", 700).collect()}
    hashed = rows.select("doc_id", "label", langid.F.xxhash64("doc_id").alias("h")).collect()
    for label in (0, 1):
        lowest = sorted((r.h, r.doc_id) for r in hashed if r.label == label)[:700]
        assert {i for i, y in got if y == label} == {i for _, i in lowest}
