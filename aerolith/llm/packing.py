"""Packing token sequences by best-fit decreasing.

Each task tokenizes its documents and packs them block by block, so packing
needs no shuffle and its state is bounded by ``block_tokens`` (two bytes a
token) however large the input or one document is. Within a block:

1. A document longer than a window is cut into full windows; its rest is a
   piece like every shorter document.
2. Pieces are placed longest first into the open window with the least room
   that still fits, found in a segment tree over remaining capacities; else
   they open a window.
3. Windows left with more than ``max_slack`` free places are topped up from
   the emptiest ones, cutting pieces freely, so at most one window of a block
   stays mostly empty. That last one is cut into lengths that are powers of
   two, which need no padding.

Results depend only on how the input is split into tasks: a lost task repeats
its packing exactly. ``sequence_id`` is the task's partition number above a
counter. A null or empty text is one end-of-document token. Null and repeated
``doc_id`` are carried as they are; each row is a document of its own. Other
columns are ignored.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "byte_bpe_50k.tiktoken"
END_TEXT, END_TEXT_ID = "<|endoftext|>", 50256
SEPARATOR_ID = 0
WINDOW = 1024
BLOCK_TOKENS = 8 << 20
MAX_SLACK = 8
PIECE_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
# Pieces leave a task in batches of about this many bytes.
OUT_BYTES = 4 << 20
# White space as the tokenizer's pattern has it (Unicode White_Space). Longer
# runs are encoded apart: past some 10**6 characters the pattern's engine fails.
LONG_RUN = 100_000
SPACE = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
LONG_SPACE = re.compile(f"(?<![{SPACE}])[{SPACE}]{{{LONG_RUN},}}+")

Piece = tuple[int, int, int]  # document, first token, number of tokens
Placed = tuple[int, int, int, int, int]  # document, first token, number, sequence, offset


def vocabulary_path(name: str = VOCABULARY) -> str:
    """Place of a public vocabulary file; the installed package knows it."""
    import public_tokenizers

    return public_tokenizers.path(name)


@lru_cache(maxsize=2)
def _encoding(path: str):
    """The byte-level BPE of ``byte_bpe_50k.json`` from its rank file: the same
    ids several times faster (held equal in tests)."""
    import public_tokenizers
    import tiktoken

    with open(path, "rb") as f:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
    return tiktoken.Encoding("byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def _encode(text: str, path: str) -> list[int]:
    """Ids of a text. All but the last character of a white space run before
    other text are one piece of the pattern, as is a run at the end."""
    encoding = _encoding(path)
    if len(text) < LONG_RUN:
        return encoding.encode_ordinary(text)
    ids, at = [], 0
    for run in LONG_SPACE.finditer(text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        ids += encoding.encode_ordinary(text[at : run.start()])
        ids += encoding._encode_single_piece(text[run.start() : end])
        at = end
    return ids + encoding.encode_ordinary(text[at:])


def token_ids(text: str | None, path: str) -> np.ndarray:
    """Ids of one document, its separator included, as uint16. The one special
    token's text becomes its id, as the tokenizer file defines."""
    ids: list[int] = []
    for i, part in enumerate((text or "").split(END_TEXT)):
        if i:
            ids.append(END_TEXT_ID)
        ids += _encode(part, path)
    ids.append(SEPARATOR_ID)
    return np.array(ids, dtype=np.uint16)


class CapacityTree:
    """Open windows by remaining capacity: a segment tree of counts over the
    capacities 1..size, with a stack of windows at each leaf."""

    def __init__(self, size: int):
        self.leaves = 1 << size.bit_length()
        self.count = [0] * (2 * self.leaves)
        self.windows: list[list[int]] = [[] for _ in range(size + 1)]

    def _add(self, capacity: int, n: int) -> None:
        node = self.leaves + capacity
        while node:
            self.count[node] += n
            node >>= 1

    def push(self, capacity: int, window: int) -> None:
        if capacity:
            self.windows[capacity].append(window)
            self._add(capacity, 1)

    def pop_tightest(self, need: int) -> tuple[int, int] | None:
        """Remove and return ``(capacity, window)`` of the least capacity that
        holds ``need``, or None."""
        node = self.leaves + need
        if not self.count[node]:
            # Climb until a right sibling holds a window, then go down its left-most path.
            while node > 1 and (node & 1 or not self.count[node + 1]):
                node >>= 1
            if node <= 1:
                return None
            node += 1
            while node < self.leaves:
                node *= 2
                node += not self.count[node]
        capacity = node - self.leaves
        self._add(capacity, -1)
        return capacity, self.windows[capacity].pop()


def best_fit_decreasing(lengths: Iterable[int], window: int = WINDOW) -> list[list[Piece]]:
    """Windows of pieces ``(document, first token, number)``."""
    windows: list[list[Piece]] = []
    rests: list[Piece] = []
    for doc, n in enumerate(lengths):
        full = n - n % window
        windows.extend([(doc, start, window)] for start in range(0, full, window))
        if n > full:
            rests.append((doc, full, n - full))
    tree = CapacityTree(window)
    rests.sort(key=lambda piece: (-piece[2], piece[0]))
    for piece in rests:
        found = tree.pop_tightest(piece[2])
        if found is None:
            windows.append([piece])
            tree.push(window - piece[2], len(windows) - 1)
        else:
            windows[found[1]].append(piece)
            tree.push(found[0] - piece[2], found[1])
    return windows


def top_up(windows: list[list[Piece]], window: int = WINDOW, max_slack: int = MAX_SLACK) -> list[list[Piece]]:
    """Fill windows with more than ``max_slack`` free places from the emptiest
    ones and cut the last into lengths that are powers of two."""
    slack = [window - sum(n for _, _, n in pieces) for pieces in windows]
    loose = sorted((i for i, free in enumerate(slack) if free > max_slack), key=lambda i: (slack[i], i))
    to, source = 0, len(loose) - 1
    while to < source:
        taker, giver = loose[to], loose[source]
        doc, start, n = windows[giver].pop()
        moved = min(n, slack[taker])
        windows[taker].append((doc, start, moved))
        slack[taker] -= moved
        if n > moved:
            windows[giver].append((doc, start + moved, n - moved))
        to += slack[taker] == 0
        source -= not windows[giver]
    done = [pieces for i, pieces in enumerate(windows) if pieces and (to > source or i != loose[to])]
    if to == source and windows[loose[to]]:
        done.extend(_powers_of_two(windows[loose[to]]))
    return done


def _powers_of_two(pieces: list[Piece]) -> Iterator[list[Piece]]:
    left = list(reversed(pieces))
    total = sum(n for _, _, n in pieces)
    for bit in reversed(range(total.bit_length())):
        room, out = total & (1 << bit), []
        while room:
            doc, start, n = left.pop()
            out.append((doc, start, min(n, room)))
            if n > room:
                left.append((doc, start + room, n - room))
            room -= min(n, room)
        if out:
            yield out


def pack_lengths(lengths: list[int], window: int = WINDOW, max_slack: int = MAX_SLACK) -> Iterator[Placed]:
    """Pieces of all documents with their sequence and offset."""
    for sequence, pieces in enumerate(top_up(best_fit_decreasing(lengths, window), window, max_slack)):
        offset = 0
        for doc, start, n in pieces:
            yield doc, start, n, sequence, offset
            offset += n


def _block_batches(doc_ids: list, docs: list[np.ndarray], first_sequence: int, schema: pa.Schema, window: int, max_slack: int):
    """Arrow batches of one packed block."""
    rows: list[tuple] = []
    size = 0
    for doc, start, n, sequence, offset in pack_lengths([len(d) for d in docs], window, max_slack):
        ids = docs[doc][start : start + n].astype("<u4").tobytes()
        rows.append((doc_ids[doc], start, n, ids, len(docs[doc]), first_sequence + sequence, offset))
        size += len(ids) + 64
        if size >= OUT_BYTES:
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    window: int = WINDOW,
    block_tokens: int = BLOCK_TOKENS,
    max_slack: int = MAX_SLACK,
) -> DataFrame:
    """Pack ``docs`` (``doc_id, text``) into sequences of at most ``window``
    tokens. One row per piece; ``ids`` are little-endian unsigned 32-bit."""
    path = vocabulary or vocabulary_path()
    schema = pa.schema(
        [(name, pa.binary() if kind == "binary" else pa.int64()) for name, kind in (c.split() for c in PIECE_SCHEMA.split(", "))]
    )

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        next_sequence = TaskContext.get().partitionId() << 32
        ids: list = []
        held: list[np.ndarray] = []
        tokens = 0

        def flush() -> Iterator[pa.RecordBatch]:
            nonlocal next_sequence, ids, held, tokens
            for batch in _block_batches(ids, held, next_sequence, schema, window, max_slack):
                last = batch.column(5)[-1].as_py()
                yield batch
            if held:
                next_sequence = last + 1
            ids, held, tokens = [], [], 0

        for batch in batches:
            doc_ids, texts = batch.column(0).to_pylist(), batch.column(1)
            for doc_id, text in zip(doc_ids, texts):
                encoded = token_ids(text.as_py(), path)
                ids.append(doc_id)
                held.append(encoded)
                tokens += len(encoded)
                if tokens >= block_tokens:
                    yield from flush()
        yield from flush()

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(pack, PIECE_SCHEMA)


def packing_report(docs: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pack_documents(docs).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
