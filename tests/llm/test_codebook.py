"""Codebooks against plain k-means in Python integers; bounds that decide without distances."""

import random
from fractions import Fraction
from math import floor, isfinite

import numpy as np
import pytest

from matchgrid.llm import codebook


def plain(rows, parts, entries, rounds, scale):
    rows = [(i, v) for i, v in rows if v is not None and all(x is not None and isfinite(x) for x in v)]
    width = -(-max([len(v) for _, v in rows], default=0) // parts) * parts
    rows = sorted(((i, v, [floor(Fraction(x) * scale) for x in v] + [0] * (width - len(v))) for i, v in rows), key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    cut = [[x[p * width // parts : (p + 1) * width // parts] for p in range(parts)] for *_, x in rows]
    books = [[list(c[p]) for c in cut[:entries]] for p in range(parts)]
    away = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    for turn in range(rounds + 1):
        codes = [[min(range(len(books[p])), key=lambda e: (away(c[p], books[p][e]), e)) for p in range(parts)] for c in cut]
        if turn < rounds:
            for p in range(parts):
                for e in range(len(books[p])):
                    own = [c[p] for c, k in zip(cut, codes) if k[p] == e]
                    if own:
                        books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    found = [(i, bytes(k).hex(), min(sum(away(c[p], books[p][k[p]]) for p in range(parts)), (1 << 63) - 1)) for (i, *_), c, k in zip(rows, cut, codes)]
    return sorted(found, key=str), books


def check(spark, rows, parts=4, entries=6, rounds=4, scale=64, kind="double"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").selectExpr("*", "1 as id", "'x' as code", "2 as label")
    coded, books, depths = codebook.learned(df, parts, entries, rounds, scale, keep={"mark": "label"})
    got = sorted(((r.id, bytes(r.code).hex(), r.error) for r in coded.collect()), key=str)
    want, want_books = plain(rows, parts, entries, rounds, scale)
    assert got == want and books == (want_books if want else [[]] * parts)
    return depths


def test_random_vectors(spark):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(9, 12))
    rows = [(k, (centres[k % 9] + 0.3 * rng.normal(size=12)).tolist()) for k in range(900)]
    depths = check(spark, rows, entries=12, rounds=5)
    n = 4 * 900
    assert [sum(d.values()) for d in depths] == [n] * 6
    # all distances at first, then mostly none
    assert set(depths[0]) == {max(depths[0])} and depths[-1].get(0, 0) > 0.8 * n


def test_ties_repeats_and_odd_rows(spark):
    rng = random.Random(7)
    rows = [(k // 2, [float(rng.choice([-1, 0, 1])) / 64 for _ in range(8)]) for k in range(200)] + [(5, [0.25] * 8)] * 300
    rows += [(None, [1.0] * 8), (None, [0.5] * 3), (9, None), (10, [1.0, None]), (11, [float("nan")] * 8), (12, [float("-inf")] * 8), (13, []), (3, [-0.001] * 7)]
    check(spark, rows)


@pytest.mark.parametrize("large", [3e4, 1e9, 1e30, 1.7e308])
def test_large_components(spark, large):
    rng = np.random.default_rng(6)
    rows = [(k, rng.normal(size=8).tolist()) for k in range(60)]
    rows += [(3, [large] + [0.1] * 7), (70, [-large] * 8), (71, [large / 3] * 8), (72, [large] * 8)]
    check(spark, rows, entries=5)


def test_small_tables(spark):
    check(spark, [])
    check(spark, [(1, [0.5, 0.25])])
    check(spark, [(1, []), (2, [])])
    check(spark, [(2, [0.5]), (1, [0.5]), (None, [3.0, 1.0, 2.0, 5.0, 4.0])], kind="float")
    with pytest.raises(ValueError):
        codebook.learned(spark.createDataFrame([(1, [0.5])], "vec_id long, embedding array<double>"), entries=300)


def test_bounds_hold_while_entries_move():
    rng = np.random.default_rng(9)
    points = rng.integers(-500, 500, (400, 2, 3))
    entries = [rng.integers(-500, 500, (10, 3)) for _ in range(2)]
    b, state = 5, codebook.assign(points, None, entries, np.zeros((2, 10)), 5)
    for turn in range(6):
        new = [e + rng.integers(-40, 40, e.shape) * (rng.random((10, 1)) < 0.5) for e in entries]
        drift = np.array([np.sqrt(((n - e) ** 2).sum(axis=1)) for n, e in zip(new, entries)]) * codebook.UP
        narrower = max(2, b - 1)
        state, entries, b = codebook.assign(points, state, new, drift, narrower), new, narrower
        for p in range(2):
            away = np.sqrt(((points[:, p, None] - entries[p]) ** 2).sum(axis=2))
            assert (state["code"][:, p] == away.argmin(axis=1)).all()
            rows = np.arange(400)
            assert (state["upper"][:, p] >= away.min(axis=1)).all()
            assert (state["low"][:, p] <= away[rows[:, None], state["near"][:, p]] + 1e-9).all()
            listed = np.column_stack([state["code"][:, p], state["near"][:, p]])
            away[rows[:, None], listed] = np.inf
            assert (state["outer"][:, p] <= away.min(axis=1) + 1e-9).all()
