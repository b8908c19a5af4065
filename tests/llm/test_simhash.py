"""Fingerprints against a plain loop, the index and the groups against all pairs."""

import numpy as np
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from matchgrid.llm import simhash

SF = "/root/testdata/sf0.001"


def plain(text):
    words = (text or "").encode().lower().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(codes, limit):
    label = list(range(len(codes)))
    for i in range(len(codes)):
        for j in range(i):
            if (codes[i] ^ codes[j]).bit_count() <= limit and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    return label


def expected(rows):
    ids, fps = [r[0] for r in rows], [plain(r[1]) for r in rows]
    label = grouped(fps, 4)
    low = {k: min(i for i, x in zip(ids, label) if x == k and i is not None) for k in set(label)}
    return sorted((i, f"{f:016x}", low[k]) for i, f, k in zip(ids, fps, label))


def found(df):
    return sorted((r["id"], f"{r['fp'] & (1 << 64) - 1:016x}", r["component"]) for r in df.collect())


def test_query_matches_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = sorted(tuple(r) for r in simhash.op10_simhash(spark, SF).select("doc_id", "fingerprint", "component_id").collect())
    assert got == expected(rows)


def test_edge_cases(spark):
    long = " ".join(f"w{i % 977}" for i in range(150_000))
    rows = [(5, None), (3, ""), (4, " \n\t"), (7, "One"), (6, "oNE"), (6, "oNE"), (9, long), (8, long + " end"), (2, "ÉA É"), (1, "a b c")]
    df = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "doc_id as id", "text as fp", "1 as a")
    assert found(simhash.near_copies(df)) == expected(rows)


def test_empty_table(spark):
    assert simhash.near_copies(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("cap", [3, 40, 100_000])
def test_crowded_buckets_lose_no_link(spark, cap):
    """Clusters of near codes, so that buckets pass the cap on every level."""
    rng = np.random.default_rng(3)
    seeds = rng.integers(0, 1 << 63, 4, dtype=np.uint64)
    codes = set()
    for s in seeds.tolist():
        for _ in range(60):
            codes.add(s ^ sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)))
    codes = sorted(codes)
    df = spark.createDataFrame([(simhash._signed(c),) for c in codes], "fp long")
    roots = {r.node & (1 << 64) - 1: r.root for r in simhash.components(simhash.links(df, 4, cap)).collect()}
    label = grouped(codes, 4)
    classes = {}
    for c, k in zip(codes, label):
        classes.setdefault(k, set()).add(c)
    got = {}
    for c in codes:
        got.setdefault(roots.get(c, simhash._signed(c)), set()).add(c)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, classes.values()))


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, (1 << 64) - 1), min_size=1, max_size=150, unique=True), st.integers(0, 12), st.integers(0, 9))
def test_index_finds_all(codes, limit, seed):
    rng = np.random.default_rng(seed)
    near = {c ^ (1 << int(rng.integers(64))) for c in codes}
    codes = np.array(sorted(set(codes) | near), np.uint64)
    index = simhash.GrayIndex(codes)
    q, at = index.search(codes, limit)
    got = {(int(codes[i]), int(index.codes[j])) for i, j in zip(q, at)}
    assert got == {(int(a), int(b)) for a in codes for b in codes if int(a ^ b).bit_count() <= limit}


def test_long_chain_of_links(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (5, 5)], "a long, b long")
    got = {r.node: r.root for r in simhash.components(edges).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 901: 900}


def test_buckets_of_the_query_have_upper_nodes(spark):
    """The crowded buckets of registered data lie under several levels of the index, and a search leaves groups whole."""
    rows = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").select("doc_id", "text")
    codes = np.unique(np.array([r.fp for r in simhash.fingerprints(rows, "doc_id", "text", 4).select("fp").collect()], np.int64).view(np.uint64))
    deep = left = asked = 0
    for mask in simhash._cuts(0, 5):
        key = codes & np.uint64(mask)
        for k, n in zip(*np.unique(key, return_counts=True)):
            if n > simhash.FAN_OUT:
                own = codes[key == k]
                index = simhash.GrayIndex(own)
                deep += len(index.levels) > 1
                top, pattern = index.levels[-1]
                far = np.bitwise_count((own[:, None] ^ pattern[None, :]) & top[None, :]) > 4
                left, asked = left + int(far.sum()), asked + far.size
    assert deep > 100 and left > 0.2 * asked


def test_a_round_is_one_query(spark, tmp_path):
    """Whether the groups have settled is seen while a round is written, not by a query of its own."""
    bus, store = spark.sparkContext._jsc.sc().listenerBus(), spark._jsparkSession.sharedState().statusStore()
    edges = spark.createDataFrame([(k, k + 1) for k in range(12)], "a long, b long")
    rounds, written = [], simhash.written
    simhash.written = lambda df, name: rounds.append(name) or written(df, name)
    try:
        bus.waitUntilEmpty()
        before = store.executionsCount()
        found = simhash.components(edges)
        bus.waitUntilEmpty()
        assert store.executionsCount() - before == len(rounds)
    finally:
        simhash.written = written
    assert {(r.node, r.root) for r in found.collect()} == {(k, 0) for k in range(1, 13)}
