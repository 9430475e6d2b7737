"""SentencePiece encoding and decoding with a given BPE model.

*Merge-type BPE.* Any two adjacent symbols whose concatenation is a piece can
merge; the piece of the best score goes first, the leftmost among equals. The
result is found without replaying these merges over the text:

* one Aho-Corasick pass over the reversed text gives the longest piece that
  starts at each place; the next shorter piece with the same beginning follows
  from a table;
* two adjacent pieces are *compatible* if merging their concatenation anew gives
  these two again. This is decided by taking back their last merges, latest
  first, and asking whether a merge across the border would have come earlier;
  pieces made by merges of equal score are merged anew step by step;
* the encoding is the one sequence of pieces in which all neighbours are
  compatible. It is built left to right, the longest piece first; where nothing
  fits, the last piece is taken back and its end is set in a bitfield of failed
  positions. An end reached by compatible pieces has one encoding only, so a
  failed end never needs a second try and the work is linear.

*What splits a text.* Characters that are neighbours in some piece belong to one
group (letters of a script, punctuation marks); no merge crosses groups. So runs
of one group, each with the space marks before it, encode independently, and a
bounded table remembers short ones. (Where a piece holds the space mark after
another character, the model has no such groups and the text stays whole.) A
character that no piece holds becomes its UTF-8 bytes' pieces.

*Normalization* is the model's own: a space mark before the text and for every
space. Models with a character map, removed white space, space suffixes, or
user-defined or unused pieces are refused.

Null text counts as empty; an empty text has no ids and decodes to the empty
text. Long texts, and long runs without spaces, take time and memory in
proportion to their length. Rows are independent: repeated rows, ties and null
ids change nothing, an empty table gives an empty result, further columns are
carried along, and a column with the output's name is replaced.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable
from functools import lru_cache
from itertools import groupby

import ahocorasick
import numpy as np
import public_tokenizers
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from sentencepiece import sentencepiece_model_pb2

from aerolith.llm.arrow import add_columns

MODEL = "piece_bpe_32k.model"
SPACE_MARK = "▁"
REMEMBERED_CHARS, REMEMBERED_WORDS, REMEMBERED_PAIRS = 48, 1 << 18, 1 << 18

NORMAL, BYTE = 1, 6


class PieceTable:
    """The pieces of a model as *symbols*: numbers in the order of their merges,
    single characters first. All tables are indexed by symbol."""

    def __init__(self, model_file: str) -> None:
        model = sentencepiece_model_pb2.ModelProto()
        with open(model_file, "rb") as f:
            model.ParseFromString(f.read())
        self._refuse_others(model)
        pieces = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        score = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.byte_ids = [0] * 256
        for i, p in enumerate(model.pieces):
            if p.type == BYTE:
                self.byte_ids[int(p.piece[3:5], 16)] = i
        characters = sorted({c for piece in pieces for c in piece})
        merged = sorted((p for p in pieces if len(p) > 1), key=lambda p: -score[p])
        self.dummy_prefix = model.normalizer_spec.add_dummy_prefix
        self.rank = {p: r for r, p in enumerate([*characters, *merged])}
        self.singles, self.known = len(characters), set(characters)
        self.score = [0.0] * len(characters) + [score[p] for p in merged]
        shared = Counter(self.score[self.singles :])
        self.tied = [False] * len(characters) + [shared[score[p]] > 1 for p in merged]
        self._build([*characters, *merged], merged, pieces)
        self.words = self._splitter(pieces)
        self.remembered = _Remembered(self._word)

    @staticmethod
    def _splitter(pieces: dict[str, int]) -> Callable[[str], list[str]]:
        """Cuts a text into runs that no merge joins."""
        if any(SPACE_MARK in p.lstrip(SPACE_MARK) for p in pieces):
            return lambda text: [text]
        group: dict[str, str] = {}

        def head(c: str) -> str:
            while group.setdefault(c, c) != c:
                c = group[c]
            return c

        inside = [word for p in pieces if len(word := p.lstrip(SPACE_MARK)) > 1]
        for word in inside:
            for a, b in zip(word, word[1:]):
                group[head(a)] = head(b)
        uses = Counter(head(word[0]) for word in inside)
        members: dict[str, list[str]] = {}
        for c in group:
            members.setdefault(head(c), []).append(c)
        runs = [f"{SPACE_MARK}*[{re.escape(''.join(sorted(members[h])))}]+" for h, _ in uses.most_common()]
        return re.compile("|".join([*runs, f"{SPACE_MARK}*[^{SPACE_MARK}]", f"{SPACE_MARK}+"]), re.DOTALL).findall

    @staticmethod
    def _refuse_others(model) -> None:
        kinds = {p.type for p in model.pieces}
        norm = model.normalizer_spec
        if model.trainer_spec.model_type != 2 or not model.trainer_spec.byte_fallback:
            raise ValueError("not a BPE model with byte fallback")
        if norm.precompiled_charsmap or norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("the model's normalizer is not supported")
        if model.trainer_spec.treat_whitespace_as_suffix or kinds & {4, 5}:
            raise ValueError("space suffixes, user-defined and unused pieces are not supported")

    def _build(self, texts: list[str], merged: list[str], pieces: dict[str, int]) -> None:
        # What merge made a piece last: found by merging its characters in order.
        self.texts = texts
        self.pairs: dict[tuple[int, int], int] = {}
        self.left, self.right = list(range(len(texts))), list(range(len(texts)))
        reachable = set(range(self.singles))
        for symbol in range(self.singles, len(texts)):
            halves = self._last_merge(texts[symbol])
            if halves:
                self.left[symbol], self.right[symbol] = halves
                self.tied[symbol] |= self.tied[halves[0]] or self.tied[halves[1]]
                reachable.add(symbol)
        for symbol in reachable:
            text = texts[symbol]
            for cut in range(1, len(text)):
                a, b = self.rank.get(text[:cut]), self.rank.get(text[cut:])
                if a in reachable and b in reachable:
                    self.pairs[a, b] = symbol
        self.length = [len(t) for t in texts]
        self.shorter = [-1] * len(texts)
        for symbol in reachable:
            self.shorter[symbol] = next((r for cut in range(len(texts[symbol]) - 1, 0, -1) if (r := self.rank.get(texts[symbol][:cut])) in reachable), -1)
        self.search = ahocorasick.Automaton()
        for symbol in reachable:
            self.search.add_word(texts[symbol][::-1], symbol)
        self.search.make_automaton()
        self.ids = [np.array([pieces[t]] if t in pieces else [self.byte_ids[b] for b in t.encode()], "<i4").tobytes() for t in texts]
        self.compatible = lru_cache(maxsize=REMEMBERED_PAIRS)(self._compatible)

    def _merge(self, parts: list[str], until: int = 1) -> list[str]:
        """Merge neighbours, best score first and leftmost among equals, until
        ``until`` parts are left or none can merge."""
        rank, score = self.rank, self.score
        while len(parts) > until:
            places = [(-score[rank[a + b]], i) for i, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in rank]
            if not places:
                break
            at = min(places)[1]
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _last_merge(self, text: str) -> tuple[int, int] | None:
        """The two symbols whose merge ends in ``text``, or None where merging
        its characters ends elsewhere."""
        halves = self._merge(list(text), until=2)
        return (self.rank[halves[0]], self.rank[halves[1]]) if len(halves) == 2 else None

    def _compatible(self, first: int, second: int) -> bool:
        """Whether ``first`` followed by ``second`` stays as it is: no merge
        across their border comes before those that made the two."""
        if self.tied[first] or self.tied[second]:
            a, b = self.texts[first], self.texts[second]
            return self._merge(list(a + b)) == [a, b]
        singles, left, right, pairs = self.singles, self.left, self.right, self.pairs
        before = len(left)  # merges across the border count only if earlier than this
        while True:
            across = pairs.get((first, second))
            if across is not None and across < before:
                return False
            if first < singles and second < singles:
                return True
            # Take back the later of the two last merges. Among equals the left
            # one came first, so an equal merge across beats only the right one.
            if first > second:
                before, first = first, right[first]
            else:
                before, second = second + 1, left[second]

    def _run(self, text: str) -> list[int]:
        """The symbols of a text all of whose characters are in pieces."""
        n, length, shorter, compatible = len(text), self.length, self.shorter, self.compatible
        found = list(self.search.iter(text[::-1]))
        found.reverse()
        longest = dict(found)  # of the matches that end at a place, the longest is reported first
        failed = bytearray((n >> 3) + 1)
        symbol = longest[n - 1]
        out, at, last = [symbol], length[symbol], symbol
        while at < n:
            symbol = longest[n - 1 - at]
            while True:
                while symbol >= 0:
                    if compatible(last, symbol):
                        end = at + length[symbol]
                        if not failed[end >> 3] >> (end & 7) & 1:
                            break
                    symbol = shorter[symbol]
                if symbol >= 0:
                    break
                failed[at >> 3] |= 1 << (at & 7)
                out.pop()
                at -= length[last]
                symbol, last = shorter[last], out[-1] if out else -1
                if last < 0:  # back at the start, where any piece may stand
                    while failed[length[symbol] >> 3] >> (length[symbol] & 7) & 1:
                        symbol = shorter[symbol]
                    break
            out.append(symbol)
            at, last = at + length[symbol], symbol
        return out

    def _word(self, word: str) -> bytes:
        if self.known.issuperset(word):
            return b"".join([self.ids[s] for s in self._run(word)])
        out = []
        for inside, run in groupby(word, key=self.known.__contains__):
            run = "".join(run)
            out += [self.ids[s] for s in self._run(run)] if inside else [np.array([self.byte_ids[b] for b in run.encode()], "<i4").tobytes()]
        return b"".join(out)

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian four-byte integers."""
        if not text:
            return b""
        marked = (SPACE_MARK if self.dummy_prefix else "") + text.replace(" ", SPACE_MARK)
        return b"".join(map(self.remembered.__getitem__, self.words(marked)))


class _Remembered(dict):
    """Ids of short words, in two generations: when the younger is full it
    becomes the older, from which words that come again are taken over."""

    def __init__(self, make: Callable[[str], bytes]) -> None:
        self.make = make
        self.older: dict[str, bytes] = {}

    def __missing__(self, word: str) -> bytes:
        ids = self.older.get(word)
        if ids is None:
            ids = self.make(word)
        if len(word) <= REMEMBERED_CHARS:
            if len(self) >= REMEMBERED_WORDS:
                self.older = dict(self)
                self.clear()
            self[word] = ids
        return ids


@lru_cache(maxsize=2)
def piece_table(model_file: str) -> PieceTable:
    return PieceTable(model_file)


@lru_cache(maxsize=2)
def _processor(model_file: str) -> sentencepiece.SentencePieceProcessor:
    return sentencepiece.SentencePieceProcessor(model_file=model_file)


def model_path(name: str = MODEL) -> str:
    return public_tokenizers.path(name)


def encode_documents(
    docs: DataFrame, text_col: str = "text", out_col: str = "piece_ids", decoded_col: str | None = None, model_file: str | None = None
) -> DataFrame:
    """``docs`` with the ids of each whole text, an array of integers, and in
    ``decoded_col``, if named, the text that the model's decoder makes of them."""
    path = model_file or model_path()
    fields = [T.StructField(out_col, T.ArrayType(T.IntegerType()))]
    if decoded_col:
        fields.append(T.StructField(decoded_col, T.StringType()))

    def make(texts: pa.Array) -> list[pa.Array]:
        encode, decode = piece_table(path).encode, _processor(path).decode
        found = [np.frombuffer(encode(t.as_py() or ""), "<i4") for t in texts]
        ends = pa.array(np.cumsum([0, *map(len, found)]).astype(np.int32))
        out = [pa.ListArray.from_arrays(ends, pa.array(np.concatenate(found) if found else [], pa.int32()))]
        if decoded_col:
            out.append(pa.array([decode(ids.tolist()) if len(ids) else "" for ids in found], pa.string()))
        return out

    return add_columns(docs, F.col(text_col).cast("string"), fields, make)


def decode_documents(docs: DataFrame, ids_col: str = "piece_ids", out_col: str = "decoded_text", model_file: str | None = None) -> DataFrame:
    """``docs`` with the text that the model's decoder makes of each row's ids
    (null ids: empty)."""
    path = model_file or model_path()

    def make(ids: pa.Array) -> list[pa.Array]:
        decode = _processor(path).decode
        return [pa.array([decode(row) if row else "" for row in ids.to_pylist()], pa.string())]

    return add_columns(docs, F.col(ids_col).cast("array<int>"), [T.StructField(out_col, T.StringType())], make)


def piece_report(docs: DataFrame) -> DataFrame:
    """Per document: how many ids, and digests of the ids and of the decoded text."""
    coded = encode_documents(docs.select("doc_id", "text"), decoded_col="decoded_text")
    return coded.select(
        "doc_id",
        F.size("piece_ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("piece_ids").cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded_text").cast("binary"), 256).alias("decoded_sha256"),
    )
