"""The piece encoder against the model's own library."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest
import sentencepiece

from aerolith.llm import pieces

ODD = [
    (None, None),
    (1, ""),
    (2, " "),
    (3, "   leading and trailing   "),
    (4, "<s></s><unk><0x0A>\n\n\t\x00 ▁ ▁▁a"),
    (5, "日本語のテキスト 한국어 𝔘😀 é é​ "),
    (5, "日本語のテキスト 한국어 𝔘😀 é é​ "),
    (6, "ab" * 40_000),
    (7, " " * 50_000 + "x" + " " * 31),
]


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=pieces.model_path())


def ids_of(text):
    return np.frombuffer(pieces.piece_table(pieces.model_path()).encode(text), "<i4").tolist()


def test_runs_of_spaces(library):
    for k in range(70):
        for text in (" " * k, " " * k + "the", "a" + " " * k + "b", "▁" * k + "x \n" + " " * k):
            assert ids_of(text) == library.encode(text), repr(text)


def test_random_texts(library):
    random.seed(7)
    some = [library.id_to_piece(i) for i in random.sample(range(259, 32_000), 4000)]
    letters = sorted({c for p in some for c in p})
    for _ in range(3000):
        text = random.choice(
            [
                "".join(random.choices(some, k=random.randint(1, 8))),
                "".join(random.choices("aeinrst ▁\n.12", k=random.randint(1, 50))),
                "".join(random.choices("ab ", k=random.randint(1, 50))),
                "".join(random.choices(letters, k=random.randint(1, 30))),
            ]
        )
        assert ids_of(text) == library.encode(text), repr(text)


def test_every_piece_by_itself(library):
    for i in range(259, 32_000):
        text = library.id_to_piece(i)
        assert ids_of(text) == library.encode(text), repr(text)


def test_report_on_documents(table, docs_of, library):
    docs = table("documents").select("doc_id", "text").unionByName(docs_of(ODD).select("doc_id", "text"))
    want = []
    for r in docs.collect():
        ids = library.encode(r.text or "")
        text = library.decode(ids) if ids else ""
        sha = [hashlib.sha256(x.encode()).hexdigest() for x in (",".join(map(str, ids)), text)]
        want.append((r.doc_id, len(ids), *sha))
    key = lambda row: (row[0] is None, row)
    got = [tuple(r) for r in pieces.piece_report(docs).collect()]
    assert sorted(got, key=key) == sorted(want, key=key)


def test_other_columns_and_empty_tables(spark, docs_of):
    frame = docs_of([(1, "some text"), (2, None)]).withColumn("piece_ids", pieces.F.lit("mine")).withColumnRenamed("text", "Text")
    coded = pieces.encode_documents(frame)
    assert coded.columns == ["doc_id", "Text", "lang", "source", "n_chars", "piece_ids"]
    back = {r.doc_id: (r.Text, r.decoded_text) for r in pieces.decode_documents(coded).collect()}
    assert back == {1: ("some text", "some text"), 2: (None, "")}
    assert pieces.piece_report(docs_of([])).count() == 0
