from __future__ import annotations

import re
from itertools import combinations

import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from aerolith.llm import simhash as sh
from aerolith.llm.components import component_roots

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")

MASK = (1 << 64) - 1


def plain_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(len(words) - 4, 0) + 1)] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(rows):
    prints = [plain_fingerprint(t) for _, t in rows]
    group = list(range(len(rows)))
    for a, b in combinations(range(len(rows)), 2):
        if (prints[a] ^ prints[b]).bit_count() <= 4 and group[a] != group[b]:
            old, new = group[b], group[a]
            group = [new if g == old else g for g in group]
    first: dict[int, int] = {}
    for (doc_id, _), g in zip(rows, group):
        if doc_id is not None:
            first[g] = min(first.get(g, doc_id), doc_id)
    return sorted((str(i), f"{p:016x}", first.get(g)) for (i, _), p, g in zip(rows, prints, group))


def near_copies():
    words = [f"word{i}" for i in range(400)]
    for k in range(40):
        changed = list(words)
        changed[k * 7 % 400] = f"other{k}"
        yield " ".join(changed)


EXTRA = [(None, None), (70_001, ""), (70_002, " \n"), (70_003, "one"), (70_004, "ONE"), (None, "one"), (None, "alone and unnamed"), (70_005, "x " * 30_000)]


def test_report_equals_brute_force(docs_of, table):
    rows = EXTRA + [(80_000 + i, t) for i, t in enumerate(near_copies())]
    docs = docs_of(rows).unionByName(table("documents")).unionByName(docs_of([(70_003, "one")]))
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id) for r in sh.simhash_report(docs).collect())
    assert got == plain_components([(r.doc_id, r.text) for r in docs.collect()])


def random_nodes(seed, n, flips):
    rng = np.random.default_rng(seed)
    centres = rng.integers(0, 2**63, 12, dtype=np.uint64)
    fps = centres[rng.integers(0, 12, n)]
    for _ in range(flips):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return np.unique(fps)


def groups(fps, links):
    root = {int(f): int(f) for f in fps.view(np.int64)}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        root[find(int(a))] = find(int(b))
    found: dict[int, set] = {}
    for f in root:
        found.setdefault(find(f), set()).add(f)
    return sorted(map(sorted, found.values()))





def exact_links(fps, distance):
    signed = fps.view(np.int64)
    near = np.bitwise_count(fps[:, None] ^ fps[None, :]) <= distance
    return [(signed[i], signed[j]) for i, j in zip(*np.nonzero(np.triu(near, 1)))]


@settings(max_examples=12, deadline=None)
@given(st.integers(0, 10_000), st.sampled_from([1, 3, 5]), st.sampled_from([[0, 0, 0, 0, 0], [1, 0, 0, 0], [-1, 1, 1, 0], [-1, 1, 0, 0, 0]]))
def test_any_allowed_thresholds_find_every_component(seed, flips, thresholds):
    fps = random_nodes(seed, 300, flips)
    parts = sh.group_bits(np.abs(np.random.default_rng(seed).normal(size=(64, 64))), len(thresholds))
    assert sorted(b for p in parts for b in p) == list(range(64))
    histograms = [np.bincount(sh.project(fps, p), minlength=1 << len(p)) for p in parts]
    old, sh.BLOCK = sh.BLOCK, 40  # many keys are split into several blocks
    try:
        blocks = [sh.blocks_of_values(h, len(p), max(t, 0)) for h, p, t in zip(histograms, parts, thresholds)]
    finally:
        sh.BLOCK = old
    cells, roles, values = (np.concatenate(c) for c in zip(*((c, np.broadcast_to(r, c.shape), f) for c, r, f in sh.cell_rows(fps, parts, thresholds, blocks))))
    links = sh.link_members(cells, roles, values, 4)
    assert len(links) < len(fps)
    assert groups(fps, links) == groups(fps, exact_links(fps, 4))


def test_thresholds_are_the_cheapest_that_are_enough():
    rng = np.random.default_rng(1)
    for m, budget in ((4, 1), (5, 0), (3, 2)):
        costs = [np.cumsum(rng.random(4)).tolist() for _ in range(m)]
        cost, chosen = sh.allocate(costs, budget)
        every = [(0.0, ())]
        for row in costs:
            every = [(c + x, (*t, i - 1)) for c, t in every for i, x in enumerate(row)]
        assert sum(chosen) == budget and cost == min(c for c, t in every if sum(t) == budget)


def test_components_of_chains_hubs_and_no_edges(spark):
    edges = [(i, i + 1) for i in range(60)] + [(1000, 1000 + i) for i in range(1, 200)] + [(5, 5)]
    frame = spark.createDataFrame(edges, "u long, v long").repartition(4)
    got = {r.node: r.root for r in component_roots(frame).collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{1000 + i: 1000 for i in range(1, 200)}}
    assert component_roots(frame.where("u < 0")).count() == 0


def test_one_of_each_group_stays(docs_of):
    docs = docs_of([(2, "same text"), (1, "SAME text"), (None, "same text"), (3, "something else here"), (1, "same text")])
    left = sh.keep_one_of_each(docs.withColumn("fp", sh.F.lit("mine")))
    assert sorted(r.doc_id for r in left.collect()) == [1, 1, 3] and "fp" in left.columns
    assert sh.simhash_report(docs_of([])).count() == 0


def test_star_steps_shuffle_both_sides_of_their_join(spark):
    """Only then can AQE split the rows of a hub."""
    from aerolith.llm.components import _star, component_roots

    pairs = spark.range(1, 3000).selectExpr("0L AS u", "id AS v")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        step = _star(pairs.unionByName(pairs.selectExpr("v AS u", "u AS v")), large=True)
        plan = step._jdf.queryExecution().executedPlan().toString()
        join = plan.index("SortMergeJoin")
        assert plan[join:].count("Exchange hashpartitioning") == 2 and "HashAggregate" not in plan[join:]
        assert sorted(map(tuple, step.collect())) == [(v, 0) for v in range(1, 3000)]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert component_roots(pairs).where("root <> 0").count() == 0
