"""Personal data in free text: patterns propose, checksums confirm, nearby
context words set the score.

Everything is one column expression over one row, so the operator adds no
shuffle and runs at scan speed; a document never leaves its task.

Four *base* kinds (email, ip, card, phone) are reported whenever their pattern
and validator hold. Three *contextual* kinds are added when their score, a
prior raised by a validator and by context words near the match, reaches
``min_score``: iban (mod-97), ssn and local_phone (context words).

Context words are sought in the ``CONTEXT_CHARS`` code points of the text on
either side of a match, whatever other matches lie there, so the members of a
list share its words.

Matches of one pattern are leftmost and do not overlap. Positions are code
points, end exclusive. They come from the pieces between the matches
(``split`` with the same pattern), so no text is searched twice from its
start. Patterns use possessive quantifiers and look-behinds so that a long run
of name characters or digits is scanned once; the matches are those of the
plain patterns above each kind. An iban is proposed at every head (two letters
and two digits that begin a word) as the longest run of its characters, and
its end is the last one that the country's length and mod-97 confirm.

Defined results: null text counts as empty; an empty text has no spans; other
columns are passed through untouched; repeated rows get the same spans.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

CONTEXT_CHARS = 40
# Most characters of a proposed iban: 34, a space before each but the first four, and one more.
IBAN_RUN = 65
DEFAULT_MIN_SCORE = 0.6
CONTEXT_BONUS = 0.4
SPAN_TYPE = "array<struct<start:int,kind_order:int,end:int,kind:string,score:double,value:string>>"


@dataclass(frozen=True)
class Kind:
    """One kind of personal data. ``hint`` is a substring every match contains
    (cheap pre-test), ``prior`` the score of a validated match, ``context``
    the words that raise it. A kind that ``looks_ahead`` consumes the first
    character of a match only: group 1 of its pattern is the proposal, of which
    a leading part may be confirmed."""

    name: str
    pattern: str
    prior: float
    base: bool
    hint: str = ""
    context: tuple[str, ...] = field(default=())
    looks_ahead: bool = False


KINDS = (
    # [A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+ : a match can only
    # start at the head of a run of name characters or where the last ended.
    Kind(
        "email",
        r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
        0.9,
        True,
        "@",
        ("mail", "email", "e-mail", "contact", "write"),
    ),
    # [0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)
    Kind("ip", r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++", 0.7, True, ".", ("ip", "host", "server", "address", "login")),
    # [0-9]([\x20-]?[0-9])+ : the maximal runs, of which only those of 14 to 19 digits can pass.
    Kind(
        "card",
        r"(?<![0-9])(?<![0-9][\x20-])[0-9](?:[\x20-]?[0-9]){13,18}+(?![\x20-]?[0-9])",
        0.8,
        True,
        "",
        ("card", "credit", "visa", "mastercard", "amex", "payment"),
    ),
    # \+[0-9][\x20().0-9-]+[0-9]
    Kind("phone", r"\+[0-9][\x20().0-9-]+[0-9]", 0.7, True, "+", ("phone", "tel", "call", "mobile", "fax", "whatsapp")),
    # [A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}, and a character that would continue its last word.
    Kind(
        "iban",
        r"(?<![A-Za-z0-9])(?=([A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}+[A-Za-z0-9]?))[A-Z]",
        0.8,
        False,
        "",
        ("iban", "account", "bank", "konto", "compte", "cuenta"),
        True,
    ),
    Kind(
        "ssn",
        r"(?<![0-9-])(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4}(?![0-9-])",
        0.3,
        False,
        "-",
        ("ssn", "social security"),
    ),
    Kind(
        "local_phone",
        r"(?<![0-9A-Za-z+.-])\(?[0-9]{3,5}\)?[\x20./-][0-9]{3,4}[\x20./-]?[0-9]{3,4}(?![0-9A-Za-z])",
        0.3,
        False,
        "",
        ("phone", "tel", "call", "mobile", "fax", "whatsapp"),
    ),
)
BASE_KINDS = tuple(k.name for k in KINDS if k.base)
# A decimal number of at most 255, with any leading zeros.
IP_PART = r"0*+(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[0-9]{0,2})"

# Characters of an IBAN by country; codes not listed may have 15 to 34.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG",
    25: "LY PT ST", 26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV",
    29: "BR EG PS QA UA", 30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_LISTED = {n: codes.replace(" ", "|") for n, codes in IBAN_LENGTHS.items()}
IBAN_SHAPE = (
    "^(?:" + "|".join(f"(?:{c}).{{{n - 2}}}" for n, c in _LISTED.items()) + f"|(?!{'|'.join(_LISTED.values())}).{{15,34}})$"
)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def luhn_valid(digits: Column) -> Column:
    """Luhn check of a string of ASCII digits: every second digit from the
    right is doubled and its digits are summed."""

    def add(total: Column, place: Column) -> Column:
        digit = F.substr(digits, F.length(digits) - place + 1, F.lit(1)).cast("int")
        doubled = digit * 2 - F.when(digit > 4, 9).otherwise(0)
        return total + F.when(place % 2 == 0, doubled).otherwise(digit)

    return (F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10) == 0


def mod97_valid(iban: Column) -> Column:
    """ISO 7064 mod-97 check of an upper-case IBAN without spaces."""
    moved = F.concat(F.substr(iban, F.lit(5)), F.substr(iban, F.lit(1), F.lit(4)))

    def step(rest: Column, place: Column) -> Column:
        char = F.substr(moved, place, F.lit(1))
        code = F.ascii(char)
        return F.when(code < 65, (rest * 10 + code - 48) % 97).otherwise((rest * 100 + code - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(moved)), F.lit(0), step) == 1


def _iban_of(run: Column) -> Column:
    """The longest leading part of a proposed run that ends with a word and is
    an IBAN, or null."""

    def whole(end: Column) -> Column:
        compact = F.replace(F.left(run, end), F.lit(" "), F.lit(""))
        ends = (F.substr(run, end, F.lit(1)) != " ") & F.substr(run, end + 1, F.lit(1)).isin("", " ")
        return ends & compact.rlike(IBAN_SHAPE) & mod97_valid(compact)

    # A last small letter only continues a word.
    ends = F.filter(F.sequence(F.length(run), F.lit(15), F.lit(-1)), lambda end: ~F.left(run, end).rlike("[a-z]$") & whole(end))
    return F.left(run, F.get(ends, F.lit(0)))


def _confirmed(kind: str, value: Column) -> Column:
    """The confirmed text of a proposal, or null."""
    if kind == "ip":
        return F.when(value.rlike(rf"^{IP_PART}(?:\.{IP_PART}){{3}}$"), value)
    if kind == "card":
        return F.when(F.length(_digits(value)).between(14, 19) & luhn_valid(_digits(value)), value)
    if kind == "phone":
        return F.when(F.length(_digits(value)).between(10, 15), value)
    if kind == "iban":
        return _iban_of(value)
    return value


def _context_pattern(words: tuple[str, ...]) -> str:
    return r"(?i)(?<![A-Za-z])(?:" + "|".join(words) + r")(?![A-Za-z])"


def _last(text: Column) -> Column:
    return F.right(text, F.lit(CONTEXT_CHARS))


def _spans_of(text: Column, kind: Kind, order: int, min_score: float) -> Column:
    """Array of the kind's confirmed spans, in text order."""

    def extracted(pattern: str, group: int) -> Column:
        every = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        return F.when(F.contains(text, F.lit(kind.hint)), every).otherwise(F.array().cast("array<string>")) if kind.hint else every

    found = extracted(kind.pattern, 0)
    # What is read at each match: the match, or what its look-ahead holds.
    values = extracted(kind.pattern, 1) if kind.looks_ahead else found
    # The text that follows the match, or the first character of what is read.
    reach = CONTEXT_CHARS + (IBAN_RUN if kind.looks_ahead else 0)
    followed = extracted(f"(?:{kind.pattern})(?=((?s:.{{0,{reach}}})))", 2 if kind.looks_ahead else 1)
    # Piece i ends where match i starts; the last piece follows the last match.
    pieces = F.slice(F.split(text, kind.pattern, -1), F.lit(1), F.size(found))
    proposed = F.zip_with(
        F.zip_with(pieces, found, lambda piece, match: F.struct(piece.alias("piece"), match.alias("match"))),
        F.zip_with(values, followed, lambda value, rest: F.struct(_confirmed(kind.name, value).alias("value"), rest.alias("rest"))),
        lambda at, read: F.struct(
            F.char_length(at["piece"]).alias("gap"),
            F.char_length(at["match"]).alias("consumed"),
            read["value"].alias("value"),
            read["rest"].alias("rest"),
            _last(at["piece"]).alias("piece"),
            _last(at["match"]).alias("match"),
        ),
    )
    context = _context_pattern(kind.context)

    def place(state: Column, item: Column) -> Column:
        start = state["at"] + item["gap"]
        end = start + F.char_length(item["value"])
        before = _last(F.concat(state["before"], item["piece"]))
        past = F.char_length(item["value"]) - item["consumed"] if kind.looks_ahead else F.lit(0)
        after = F.substr(item["rest"], past + 1, F.lit(CONTEXT_CHARS))
        near = before.rlike(context) | after.rlike(context)
        score = F.lit(kind.prior) + F.when(near, CONTEXT_BONUS).otherwise(0.0)
        score = F.least(score, F.lit(1.0))
        keep = item["value"].isNotNull() & (start >= state["done"])
        if not kind.base:
            keep = keep & (score >= min_score)
        span = F.struct(
            start.alias("start"),
            F.lit(order).alias("kind_order"),
            end.alias("end"),
            F.lit(kind.name).alias("kind"),
            score.alias("score"),
            item["value"].alias("value"),
        )
        kept = F.when(keep, F.concat(state["spans"], F.array(span).cast(SPAN_TYPE))).otherwise(state["spans"])
        done = F.when(keep, end).otherwise(state["done"])
        passed = _last(F.concat(before, item["match"]))
        return F.struct(
            (start + item["consumed"]).alias("at"), done.alias("done"), passed.alias("before"), kept.alias("spans")
        )

    empty = F.array().cast(SPAN_TYPE)
    start_state = F.struct(F.lit(0).alias("at"), F.lit(0).alias("done"), F.lit("").alias("before"), empty.alias("spans"))
    placed = F.aggregate(proposed, start_state, place, lambda state: state["spans"])
    return F.when(F.size(found) == 0, empty).otherwise(placed)


def find_pii(docs: DataFrame, text_col: str = "text", out_col: str = "pii", min_score: float = DEFAULT_MIN_SCORE) -> DataFrame:
    """Add ``out_col``: spans ``(start, kind_order, end, kind, score, value)``
    sorted by start, then kind in the order of ``KINDS``. One row in, one out."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    parts = [_spans_of(text, kind, i, min_score) for i, kind in enumerate(KINDS)]
    return docs.withColumn(out_col, F.array_sort(F.concat(*parts)))


def redact(docs: DataFrame, text_col: str = "text", pii_col: str = "pii") -> DataFrame:
    """Replace every span by ``[KIND]``. Where spans overlap, the one that
    starts first names the replacement and the text covered by any is gone."""
    text = F.coalesce(F.col(text_col), F.lit(""))

    def cut(state: Column, span: Column) -> Column:
        gap = F.greatest(span["start"] - state["at"], F.lit(0))
        fresh = span["start"] >= state["at"]
        kept = F.concat(state["text"], F.substr(text, state["at"] + 1, gap))
        marked = F.when(fresh, F.concat(kept, F.lit("["), F.upper(span["kind"]), F.lit("]"))).otherwise(state["text"])
        return F.struct(F.greatest(state["at"], span["end"]).alias("at"), marked.alias("text"))

    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("text"))
    cleaned = F.aggregate(F.col(pii_col), start, cut, lambda s: F.concat(s["text"], F.substr(text, s["at"] + 1)))
    return docs.withColumn(text_col, F.when(F.col(text_col).isNull(), F.lit(None)).otherwise(cleaned))


def span_digest(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    named = F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")))
    return F.array_join(named, ",")


def pii_report(docs: DataFrame) -> DataFrame:
    """Per document: counts of the base kinds, digest of the base spans, and
    all spans with the largest score."""
    pii = F.col("pii")
    base = F.filter(pii, lambda s: s["kind"].isin(*BASE_KINDS))

    def count(kind: str) -> Column:
        return F.size(F.filter(pii, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in BASE_KINDS]
    return find_pii(docs.select("doc_id", "text")).select(
        "doc_id",
        *counts,
        F.sha2(span_digest(base), 256).alias("base_sha256"),
        span_digest(pii).alias("spans"),
        F.coalesce(F.array_max(F.transform(pii, lambda s: s["score"])), F.lit(0.0)).alias("max_score"),
    )
