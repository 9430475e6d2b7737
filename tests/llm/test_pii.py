from __future__ import annotations

import hashlib
import re

import pytest

from aerolith.llm import pii

# The plain patterns of the base kinds, in order.
PLAIN = (
    ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"),
    ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"),
    ("card", r"[0-9]([\x20-]?[0-9])+"),
    ("phone", r"\+[0-9][\x20().0-9-]+[0-9]"),
)


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        doubled = int(c) * (1 + i % 2)
        total += doubled - 9 * (doubled > 9)
    return total % 10 == 0


def brute_force(text: str | None):
    spans = []
    for order, (kind, pattern) in enumerate(PLAIN):
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and any(int(p) > 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (14 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            spans.append((m.start(), order, f"{kind}:{m.start()}:{m.end()}", kind))
    spans.sort()
    counts = tuple(sum(s[3] == kind for s in spans) for kind, _ in PLAIN)
    return (*counts, hashlib.sha256(",".join(s[2] for s in spans).encode()).hexdigest())


CASES = [
    "write to a.b+c@ex-ample.co.uk, or x@y",
    "a@b.c_d@e.f and 1.2.3.4.5.6.7.8 é😀 x@y.zz",
    "0000000001.2.3.255 256.1.1.1 1.2.3",
    "cards 4111 1111 1111 1111 and 4111-1111-1111-1112 4111  1111",
    "+49 (171) 555-12-34 and +12 3 and ++1 234 567 8901.",
    "a." * 500 + "@" + "b." * 500 + "c",
    "1" * 3000,
    "1 " * 2000,
    "",
    None,
]


def test_base_spans_equal_brute_force(docs_of, table):
    rows = [(i, t) for i, t in enumerate(CASES)]
    frame = docs_of(rows).unionByName(table("documents").withColumn("doc_id", pii.F.col("doc_id") + 1000))
    texts = {r.doc_id: r.text for r in frame.collect()}
    got = pii.pii_report(frame).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == brute_force(texts[r.doc_id]), r.doc_id


def test_contextual_kinds_need_their_evidence(docs_of):
    texts = ["my IBAN DE89 3704 0044 0532 0130 00", "DE88 3704 0044 0532 0130 00", "ssn 123-45-6789", "part 123-45-6789", "tel 0171 555 1234"]
    spans = {r.doc_id: r.spans for r in pii.pii_report(docs_of(list(enumerate(texts)))).collect()}
    assert spans == {0: "iban:8:35", 1: "", 2: "ssn:4:15", 3: "", 4: "local_phone:4:17"}


def test_ibans_end_where_their_country_says(docs_of):
    rests = [" Please pay", " 12 May", " BIC COBADEFF", " Bank", " A", ", thanks", "", " FR14 2004 1010 0505 0001 3M02 606 Rue 5"]
    cases = [(iban, rest) for iban in ("DE89370400440532013000", "DE89 3704 0044 0532 0130 00") for rest in rests]
    docs = docs_of([(i, f"IBAN GB12 {iban}{rest}") for i, (iban, rest) in enumerate(cases)])
    spans = {r.doc_id: r.spans.split(",") for r in pii.pii_report(docs).collect()}
    for i, (iban, rest) in enumerate(cases):
        second = [f"iban:{11 + len(iban)}:{44 + len(iban)}"] if "FR14" in rest else []
        assert spans[i] == [f"iban:10:{10 + len(iban)}", *second]


def test_words_grown_onto_an_iban_are_none(docs_of):
    texts = ["IBAN DE89370400440532013000x", "IBAN DE893704004405320130004 5", "xDE89370400440532013000", "IBAN XX08 1234 5678 901 And so"]
    spans = {r.doc_id: r.spans for r in pii.pii_report(docs_of(list(enumerate(texts)))).collect()}
    assert spans == {0: "", 1: "", 2: "", 3: "iban:5:23"}


def test_context_is_taken_from_the_text_on_both_sides(docs_of):
    far = " " * 40
    texts = [
        "SSN: 123-45-6789, 234-56-7891",
        "tel 0171 555 1234 / 0171 555 1235",
        "123-45-6789 (SSN)",
        "é😀 0171 555 1234 mobile",
        f"SSN{far}123-45-6789{far}SSN",
        "DE89 3704 0044 0532 0130 00 konto",
    ]
    found = pii.find_pii(docs_of(list(enumerate(texts))))
    spans = {r.doc_id: [(s.kind, s.start, s.end) for s in r.pii] for r in found.collect()}
    assert spans == {
        0: [("ssn", 5, 16), ("ssn", 18, 29)],
        1: [("local_phone", 4, 17), ("local_phone", 20, 33)],
        2: [("ssn", 0, 11)],
        3: [("local_phone", 3, 16)],
        4: [],
        5: [("iban", 0, 27)],
    }
    assert found.where("doc_id = 5").first()["pii"][0]["score"] == pytest.approx(1.0)


def test_redaction_scores_and_foreign_columns(docs_of):
    frame = docs_of([(1, "mail me: a@b.co now"), (2, None), (2, None)]).withColumn("pii", pii.F.lit("mine"))
    found = pii.find_pii(frame)
    rows = {(r.doc_id, r.text) for r in pii.redact(found).collect()}
    assert rows == {(1, "mail me: [EMAIL] now"), (2, None)}
    assert found.where("doc_id = 1").first()["pii"][0]["score"] == pytest.approx(1.0)


def test_empty_table(docs_of):
    assert pii.pii_report(docs_of([])).count() == 0
