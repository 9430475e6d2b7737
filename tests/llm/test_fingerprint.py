from __future__ import annotations

import hashlib

import pytest

from aerolith.llm import fingerprint as fp


def brute_force(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0), reverse=True)
    out = {}
    for i, (doc_id, text) in enumerate(rows):
        text, following = text or "", rows[(i + 1) % len(rows)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + following[:half]
        prints = fp.digest(text), fp.digest(edited), fp.digest(following)
        sha = hashlib.sha256(edited.encode()).hexdigest()
        out[doc_id] = (len(text), sha, *prints[:2], fp.likeness(*prints[:2]), fp.likeness(prints[0], prints[2]))
    return out


def report(docs):
    return {r.doc_id: tuple(r)[1:] for r in fp.edit_report(docs).collect()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_report_equals_brute_force(docs_of, table, partitions):
    docs = table("documents").unionByName(docs_of([(None, "nameless"), (-5, ""), (90_001, None), (90_002, "é😀" * 40_000)]))
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert report(docs.repartition(partitions)) == brute_force(rows)


@pytest.mark.parametrize("rows", [[(3, "hello wörld")], [(3, "a"), (None, None)], [(1, ""), (2, "ab")]])
def test_few_documents(docs_of, rows):
    assert report(docs_of(rows)) == brute_force(rows)


def test_ties_and_empty_table(docs_of):
    docs = docs_of([(1, "same"), (1, "same"), (1, "other"), (0, "last")]).withColumn("range", fp.F.lit("mine"))
    rows = fp.edit_report(docs).collect()
    assert sorted(r.doc_id for r in rows) == [0, 1, 1, 1]
    assert {r.fingerprint for r in rows if r.edited_sha256} == {fp.digest(t) for t in ("same", "other", "last")}
    assert fp.edit_report(docs_of([])).count() == 0


def test_difference_is_bounded_symmetric_and_orders_edits(table):
    texts = [r.text for r in table("documents").select("text").limit(60).collect()]
    wins = 0
    for a, b in zip(texts, texts[1:]):
        one, other, edited = fp.digest(a), fp.digest(b), fp.digest(fp.edited_text(a, b))
        assert fp.difference(one, one) == 0 and fp.difference(one, other) == fp.difference(other, one) <= fp.MAX_DIFFERENCE
        wins += fp.likeness(one, edited) >= fp.likeness(one, other)
    assert wins >= 57
    assert len(fp.digest("")) == len(fp.digest("x" * 100_000)) == 2 + fp.BUCKETS // 2


def test_general_form_keeps_columns(docs_of):
    out = fp.fingerprint_documents(docs_of([(1, None), (2, "ab")]), out_col="lang")
    assert {r.doc_id: r.lang for r in out.collect()} == {1: fp.digest(""), 2: fp.digest("ab")}
