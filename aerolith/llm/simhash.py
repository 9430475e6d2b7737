"""SimHash near-duplicates with the generalised pigeonhole principle.

*Fingerprint.* Words are runs without ASCII white space, A-Z lower-cased; a bit
of the 64-bit fingerprint is 1 where over half of the XXH64 values of the
document's word shingles (repeats included) have it set.

*Search.* Fingerprints link at ``max_distance`` or fewer differing bits.
Equal fingerprints collapse to one node first, so copies cost nothing.

1. Bits that are correlated over all fingerprints are grouped into the same
   partition of the 64 bits, which keeps the skew in few partitions.
2. Partition thresholds ``t_i >= -1`` with ``sum t_i = max_distance - m + 1``
   are enough (generalised pigeonhole): a linked pair differs in at most
   ``t_i`` bits in some partition ``i``; ``-1`` skips it. Dynamic programming
   picks the thresholds, and the number of partitions ``m``, of the least
   estimated cost, from exact histograms of all fingerprints per partition.
3. A fingerprint is put under its value in every partition and probes with the
   values of the Hamming ball of radius ``t_i``. Keys with many members are
   split into cells of blocks against blocks of a bounded size.
4. A task compares the members of its cells as arrays and keeps only links
   that join different groups of its own (a spanning forest): no pair list of a
   dense group is ever made, and the components are the same.
5. Components come from alternating star steps over the links.

Null text counts as empty, whose fingerprint is zero. Null ids take part; a
component without any id has a null ``component_id``. Repeated rows are
returned each. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from aerolith.llm.components import component_roots
from aerolith.llm.textnorm import lower_ascii
from aerolith.session import materialize

SHINGLE_WORDS = 4
MAX_DISTANCE = 4
SEED = 42
BITS = 64
PARTITION_COUNTS = (4, 5)
BLOCK = 1024
MOST_THRESHOLD = 2
WORD = re.compile(r"[^\x20\x09-\x0D]+")
# Roles of a member of a cell.
STANDS, PROBES = 1, 2
# What a probe row costs, in comparisons.
PROBE_COST = 200


def fingerprint(text: str | None, shingle_words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash as a signed long."""
    words = WORD.findall(lower_ascii(text or ""))
    if not words:
        return 0
    last = max(len(words) - shingle_words, 0)
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter(
        (digest(" ".join(words[i : i + shingle_words]).encode("utf-8", "surrogatepass"), SEED) for i in range(last + 1)),
        np.uint64,
        last + 1,
    )
    counts = np.zeros(BITS, np.int64)
    # Blocks keep the unpacked bits of a very long text small.
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1).sum(axis=0, dtype=np.int64)
    packed = np.packbits(counts * 2 > len(hashes)).tobytes()
    return int.from_bytes(packed, "big", signed=True)


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``doc_id, fp`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(fps, pa.int64())], names=["doc_id", "fp"])

    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return slim.mapInArrow(run, "doc_id long, fp long")


def _bits_of(fps: np.ndarray) -> np.ndarray:
    """0/1 matrix (n, 64); column b is bit b, counted from the lowest."""
    flat = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return flat.reshape(len(fps), BITS)


def _column_values(batches: Iterator[pa.RecordBatch]) -> Iterator[np.ndarray]:
    for batch in batches:
        yield batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)


def bit_correlations(nodes: DataFrame) -> np.ndarray:
    """64 x 64 absolute correlations of the bits over all fingerprints. Each
    task sends its counts, at most 64 x 64 numbers."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = np.zeros((BITS, BITS))
        n = 0
        for fps in _column_values(batches):
            bits = _bits_of(fps).astype(np.float32)
            both += bits.T @ bits
            n += len(fps)
        if n:
            flat = np.append(both.ravel(), n).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(flat)), pa.int64()), pa.array(flat)], names=["cell", "n"])

    counted = nodes.select("fp").mapInArrow(count, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n")).collect()
    flat = np.zeros(BITS * BITS + 1)
    for row in counted:
        flat[row["cell"]] = row["n"]
    n, both = max(flat[-1], 1.0), flat[:-1].reshape(BITS, BITS)
    mean = np.diag(both) / n
    spread = np.sqrt(np.clip(mean * (1 - mean), 1e-9, None))
    return np.abs(both / n - np.outer(mean, mean)) / np.outer(spread, spread)


def group_bits(correlation: np.ndarray, m: int) -> list[list[int]]:
    """``m`` partitions of equal width (within one): each starts at the free
    bit most correlated with the other free bits and takes the free bits most
    correlated with it."""
    free = list(range(BITS))
    parts = []
    for i in range(m):
        width = len(free) // (m - i)
        inner = correlation[np.ix_(free, free)].sum(axis=1)
        part = [free[int(np.argmax(inner))]]
        while len(part) < width:
            rest = [b for b in free if b not in part]
            gain = correlation[np.ix_(rest, part)].sum(axis=1)
            part.append(rest[int(np.argmax(gain))])
        free = [b for b in free if b not in part]
        parts.append(sorted(part))
    return parts


def project(fps: np.ndarray, part: list[int]) -> np.ndarray:
    """The bits of ``part``, packed."""
    out = np.zeros(len(fps), np.int64)
    for place, bit in enumerate(part):
        out |= ((fps >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) << place
    return out


def value_histograms(nodes: DataFrame, parts: list[list[int]]) -> list[np.ndarray]:
    """Exact count of every value of every partition over all fingerprints; a
    histogram has at most ``2 ** width`` bins."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros(1 << len(p), np.int64) for p in parts]
        for fps in _column_values(batches):
            for total, part in zip(sums, parts):
                values, n = np.unique(project(fps, part), return_counts=True)
                total[values] += n
        for i, total in enumerate(sums):
            held = np.flatnonzero(total)
            if len(held):
                arrays = [pa.array(np.full(len(held), i), pa.int64()), pa.array(held, pa.int64()), pa.array(total[held])]
                yield pa.RecordBatch.from_arrays(arrays, names=["part", "value", "n"])

    tables = [np.zeros(1 << len(p), np.int64) for p in parts]
    summed = nodes.select("fp").mapInArrow(count, "part long, value long, n long").groupBy("part", "value").agg(F.sum("n").alias("n"))
    for row in summed.toLocalIterator():
        tables[row["part"]][row["value"]] = row["n"]
    return tables


def ball_masks(width: int, radius: int) -> list[int]:
    """Flip masks of at most ``radius`` of ``width`` bits."""
    return [sum(1 << b for b in flips) for r in range(radius + 1) for flips in combinations(range(width), r)]


def estimated_costs(histogram: np.ndarray, width: int, most: int) -> list[float]:
    """Cost of thresholds -1, 0, .. ``most``: pairs that meet, and probes."""
    n = float(histogram.sum())
    values, costs = np.arange(len(histogram)), [0.0]
    for radius in range(most + 1):
        masks = ball_masks(width, radius)
        pairs = sum(float(np.dot(histogram, histogram[values ^ mask].astype(float))) for mask in masks)
        costs.append(pairs + PROBE_COST * n * len(masks))
    return costs


def allocate(costs: list[list[float]], budget: int) -> tuple[float, list[int]]:
    """Thresholds >= -1, one per partition, that sum to ``budget`` at least
    total cost, by dynamic programming. ``costs[i][t + 1]`` is the cost of t."""
    best: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
    for row in costs:
        following: dict[int, tuple[float, list[int]]] = {}
        for total, (cost, chosen) in best.items():
            for t, more in enumerate(row, start=-1):
                if (now := cost + more) < following.get(total + t, (float("inf"),))[0]:
                    following[total + t] = (now, [*chosen, t])
        best = following
    return best[budget]


def plan_partitions(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> tuple[list[list[int]], list[int], list[np.ndarray]]:
    """Partitions, their thresholds and their histograms."""
    correlation = bit_correlations(nodes)
    options = []
    for m in PARTITION_COUNTS:
        parts = group_bits(correlation, m)
        histograms = value_histograms(nodes, parts)
        budget = max_distance - m + 1
        cost, thresholds = allocate([estimated_costs(h, len(p), MOST_THRESHOLD) for h, p in zip(histograms, parts)], budget)
        options.append((cost, parts, thresholds, histograms))
    _, parts, thresholds, histograms = min(options, key=lambda o: o[0])
    return parts, thresholds, histograms


class Forest:
    """Union-find over dense numbers; ``root`` is kept flat between steps."""

    def __init__(self, n: int):
        self.root = np.arange(n)

    def _find(self, x: int) -> int:
        root = self.root
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return int(x)

    def join(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        """Join the pairs; the ones that joined two trees."""
        apart = self.root[left] != self.root[right]
        links = []
        for a, b in zip(left[apart].tolist(), right[apart].tolist()):
            x, y = self._find(a), self._find(b)
            if x != y:
                self.root[max(x, y)] = min(x, y)
                links.append((a, b))
        if links:
            while (self.root != (up := self.root[self.root])).any():
                self.root = up
        return links


def _near(a: np.ndarray, b: np.ndarray, max_distance: int) -> np.ndarray:
    return np.bitwise_count(a ^ b) <= max_distance


def link_members(cells: np.ndarray, roles: np.ndarray, fps: np.ndarray, max_distance: int) -> np.ndarray:
    """Spanning links among the members of each cell. ``roles``: STANDS under
    its own value, PROBES, and in a cell of two blocks the block. A pair counts
    if one stands and the other probes and, with two blocks, they differ.
    Members are compared at distance 1, 2, .. in the sorted order, over all
    cells at once."""
    nodes, number = np.unique(fps, return_inverse=True)
    forest = Forest(len(nodes))
    order = np.lexsort((number, cells))
    cells, roles, number = cells[order], roles[order].astype(np.int64), number[order]
    stands, probes, block = roles & STANDS, (roles & PROBES) >> 1, roles >> 2
    ends = np.searchsorted(cells, cells, side="right")
    active, step, links = np.arange(len(cells)), 1, []
    while len(active := active[active + step < ends[active]]):
        other = active + step
        a, b = number[active], number[other]
        meets = (stands[active] & probes[other]) | (probes[active] & stands[other])
        ok = (meets > 0) & ((block[active] == 0) | (block[active] != block[other])) & (forest.root[a] != forest.root[b])
        ok[ok] = _near(nodes[a[ok]], nodes[b[ok]], max_distance)
        links += forest.join(a[ok], b[ok])
        step += 1
    if not links:
        return np.empty((0, 2), np.int64)
    pairs = np.array(links)
    return np.stack([nodes[pairs[:, 0]], nodes[pairs[:, 1]]], axis=1).view(np.int64)


def blocks_of_values(histogram: np.ndarray, width: int, threshold: int) -> np.ndarray:
    """How many blocks the members of each value make: those that stand there
    and those that probe it."""
    values = np.arange(len(histogram))
    members = sum(histogram[values ^ mask] for mask in ball_masks(width, threshold))
    return np.maximum(-(-members // BLOCK), 1).astype(np.uint32)


def cell_rows(
    fps: np.ndarray, parts: list[list[int]], thresholds: list[int], blocks: list[np.ndarray]
) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """``(cell, role, fp)`` of every fingerprint under its own value in each
    used partition and under the values it probes. A value of ``n`` blocks has
    a cell for every pair of them; a member goes to the ``n`` that have its block."""
    mixed = (fps * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(32)
    for i, (part, threshold) in enumerate(zip(parts, thresholds)):
        if threshold < 0:
            continue
        own = project(fps, part)
        for mask in ball_masks(len(part), threshold):
            value, role = own ^ mask, STANDS | PROBES if mask == 0 else PROBES
            key, n_blocks = (np.int64(i) << 56) | (value << 32), blocks[i][value]
            for n in np.unique(n_blocks).tolist():
                some = n_blocks == n
                block = (mixed[some] % np.uint64(n)).astype(np.int64)
                for other in range(n):
                    low, high = np.minimum(block, other), np.maximum(block, other)
                    side = np.where(low == high, 0, np.where(block == low, 1, 2))
                    yield key[some] | (low << 16) | high, role | (side << 2), fps[some]


def near_links(nodes: DataFrame, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``u, v``: links between distinct fingerprints ``fp`` whose components
    are those of all pairs within ``max_distance``."""
    parts, thresholds, histograms = plan_partitions(nodes, max_distance)
    blocks = [blocks_of_values(h, len(p), max(t, 0)) for h, p, t in zip(histograms, parts, thresholds)]

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for fps in _column_values(batches):
            for cell, role, fp in cell_rows(fps, parts, thresholds, blocks):
                arrays = [pa.array(cell), pa.array(role.astype(np.int8)), pa.array(fp.view(np.int64))]
                yield pa.RecordBatch.from_arrays(arrays, names=["cell", "role", "fp"])

    def link(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [[c.to_numpy(zero_copy_only=False) for c in batch.columns] for batch in batches]
        if held:
            cells, roles, fps = (np.concatenate(c) for c in zip(*held))
            pairs = link_members(cells, roles, fps.view(np.uint64), max_distance)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], names=["u", "v"])

    n = int(nodes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = nodes.select("fp").mapInArrow(spread, "cell long, role byte, fp long")
    return rows.repartition(n, "cell").mapInArrow(link, "u long, v long")


def near_duplicate_components(
    docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE
) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): ``doc_id, fp, component_id``
    (smallest id reachable over links, its own included)."""
    prints = materialize(fingerprints(docs, shingle_words), "fingerprints")
    nodes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first_doc")), "fingerprint-nodes")
    roots = component_roots(near_links(nodes, max_distance))
    rooted = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "first_doc", F.coalesce("root", "fp").alias("root")
    )
    # Written before they are joined, so that AQE can split a root of many
    # fingerprints and a fingerprint of many documents.
    lowest = materialize(rooted.groupBy("root").agg(F.min("first_doc").alias("component_id")), "lowest-ids")
    named = materialize(rooted.join(lowest, "root").select("fp", "component_id"), "named-fingerprints")
    return prints.join(named, "fp").select("doc_id", "fp", "component_id")


def keep_one_of_each(docs: DataFrame, shingle_words: int = SHINGLE_WORDS, max_distance: int = MAX_DISTANCE) -> DataFrame:
    """``docs`` with one document of each group of near-duplicates: the one
    whose id is the component's. Rows that share that id all stay; of a group
    without any id all rows stay."""
    found = near_duplicate_components(docs.select("doc_id", "text"), shingle_words, max_distance)
    gone = found.where(F.col("component_id").isNotNull() & ~F.col("doc_id").eqNullSafe(F.col("component_id")))
    gone = materialize(gone.select(F.col("doc_id").alias("__gone")).distinct(), "near-copies")
    return docs.join(gone, F.col("doc_id").cast("long").eqNullSafe(F.col("__gone")), "left_anti")


def simhash_report(docs: DataFrame) -> DataFrame:
    found = near_duplicate_components(docs.select("doc_id", "text"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
