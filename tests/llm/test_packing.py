from __future__ import annotations

import zlib
from collections import defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolith.llm import packing as pk


def check_layout(placed, lengths, window, max_slack):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for doc, start, n, sequence, offset in placed:
        pieces[doc].append((start, n))
        sequences[sequence].append((offset, n))
    for doc, n in enumerate(lengths):
        at = 0
        for start, m in sorted(pieces[doc]):
            assert start == at and m > 0
            at += m
        assert at == n
    for parts in sequences.values():
        at = 0
        for offset, m in sorted(parts):
            assert offset == at
            at += m
        assert at <= window and (window - at <= max_slack or at & (at - 1) == 0)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 300), max_size=60), st.sampled_from([0, 3]))
def test_every_token_is_packed_once_with_little_padding(lengths, max_slack):
    check_layout(pk.pack_lengths(lengths, 64, max_slack), lengths, 64, max_slack)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(1, 64), max_size=80))
def test_best_fit_decreasing_equals_a_plain_search(lengths):
    free: list[int] = []
    for n in sorted(lengths, reverse=True):
        fits = [f for f in free if f >= n]
        if fits:
            free.remove(min(fits))
        free.append((min(fits) if fits else 64) - n)
    got = pk.best_fit_decreasing(lengths, 64)
    assert sorted(64 - sum(p[2] for p in w) for w in got) == sorted(free)


TEXTS = ["", None, "x <|endoftext|> y", "word " * 3000, "a" * 5000, " " * 3000, "Ünï 漢字 😀\r\n\t", "tie", "tie"]


def test_pieces_hold_the_tokenizer_ids(docs_of, table):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(pk.vocabulary_path("byte_bpe_50k.json"))
    docs = docs_of([(10_000 + i, t) for i, t in enumerate(TEXTS)]).unionByName(table("documents"))
    texts = {r.doc_id: r.text for r in docs.collect()}
    got = defaultdict(list)
    for r in pk.packing_report(docs).collect():
        got[r.doc_id].append(r)
    assert set(got) == set(texts)
    for doc_id, text in texts.items():
        ids = reference.encode(text or "", add_special_tokens=False).ids + [0]
        at = 0
        for r in sorted(got[doc_id], key=lambda r: r.start):
            assert (r.start, r.doc_tokens) == (at, len(ids))
            assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
            at += r.length
        assert at == len(ids)


@pytest.mark.parametrize(
    "text",
    [
        "a" + " " * 2_000_000 + "b",
        "\n" * 2_000_000,
        "x\r\n" + " \u3000" * 60_000 + "\ty" + "\t" * 100_001 + "<|endoftext|>z",
        " " * 100_000 + "'s" + "\xa0" * 99_999 + "1",
    ],
)
def test_long_white_space_gives_the_tokenizer_ids(text):
    tokenizers = pytest.importorskip("tokenizers")
    reference = tokenizers.Tokenizer.from_file(pk.vocabulary_path("byte_bpe_50k.json"))
    wanted = reference.encode(text, add_special_tokens=False).ids + [0]
    assert pk.token_ids(text, pk.vocabulary_path()).tolist() == wanted


def test_blocks_bound_the_state_and_null_ids_stay(docs_of):
    docs = docs_of([(None, "one two three"), (None, "one two three"), (7, "x " * 500)]).withColumn("length", pk.F.lit("mine"))
    rows = pk.pack_documents(docs, window=64, block_tokens=100).collect()
    assert sum(r.length for r in rows if r.doc_id is None) == 2 * next(r.doc_tokens for r in rows if r.doc_id is None)
    by_sequence = defaultdict(int)
    for r in rows:
        by_sequence[r.sequence_id] += r.length
    assert max(by_sequence.values()) <= 64
    assert pk.pack_documents(docs_of([])).count() == 0
