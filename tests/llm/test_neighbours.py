"""Projected neighbour search against the comparison with every row."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from recordmill.llm import neighbours as N

SCHEMA = "vec_id long, embedding array<float>, dim int, tile int"


def brute(rows, every=50, k=5):
    """``[(query, [(id, score), ...])]`` with all other rows as candidates."""
    good = [(i, np.array(v, float)) for i, v, *_ in rows
            if v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)]
    out = []
    for a, (i, x) in enumerate(good):
        if i is None or i % every:
            continue
        near = [(-float(x @ y / np.linalg.norm(x) / np.linalg.norm(y)), j if j is not None else np.inf) for b, (j, y) in enumerate(good) if b != a and len(x) == len(y)]
        near.sort(key=lambda p: (round(p[0], 9), p[1]))
        out.append((i, [(j, -s) for s, j in near[:k]]))
    return sorted(out, key=lambda q: (q[0], [s for _, s in q[1]]))


def result(df, **more):
    out, held = [], []
    rows = N.nearest(df, F.col("vec_id") % 50 == 0, **more).collect()
    for q in sorted({r.query_id for r in rows}):
        mine = sorted((r for r in rows if r.query_id == q), key=lambda r: r["rank"])
        copies = sum(r["rank"] == 1 for r in mine)
        assert [r["rank"] for r in mine] == sorted(list(range(1, len(mine) // copies + 1)) * copies)
        out.append((q, mine))
    return out


def same(got, expected):
    assert [q for q, _ in got] == [q for q, near in expected if near]
    for (_, mine), (_, near) in zip(got, [e for e in expected if e[1]]):
        assert [r.vec_id for r in mine] == [None if j == np.inf else j for j, _ in near]
        assert np.allclose([r.score for r in mine], [s for _, s in near], atol=1e-12)


@pytest.mark.parametrize("p, degrees, value", [(0.95, 2, 5.991465), (0.95, 8, 15.507313), (0.5, 6, 5.348121)])
def test_quantiles(p, degrees, value):
    assert N.chi_square_quantile(p, degrees) == pytest.approx(value, abs=1e-5)


def test_projected_distances_follow_the_chi_square(spark):
    rng = np.random.default_rng(1)
    x, y = N.unit(rng.normal(size=(4000, 48))), N.unit(rng.normal(size=(4000, 48)))
    ratio = (((x - y) @ N.directions(48, 8)) ** 2).sum(1) / ((x - y) ** 2).sum(1)
    assert abs((ratio <= N.chi_square_quantile(0.9, 8)).mean() - 0.9) < 0.04


def test_tree_finds_all_tiles_in_reach():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(3000, 4))
    axis, cut = N.fit_tree(x, 5)
    tile = N.tile_of(x, axis, cut)
    assert set(tile) == set(range(32)) and np.bincount(tile).max() < 200
    for q in x[:50]:
        for r2 in (0.01, 0.5):
            near = set(tile[((x - q) ** 2).sum(1) <= r2])
            assert near <= set(N.tiles_within(q, r2, axis, cut))
    assert len(N.tiles_within(x[0], np.inf, axis, cut)) == 32


def clusters(seed, n):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, 24))
    return [(i, (centres[rng.integers(30)] + rng.normal(size=24) * rng.choice([0.05, 0.3])).astype(np.float32).tolist(), 1, 1) for i in range(n)]


def small(monkeypatch):
    for name, value in (("LEAST_TILE", 60), ("LEAF", 16), ("QUERY_BLOCK", 7), ("TILES", 1 << 20)):
        monkeypatch.setattr(N, name, value)


@pytest.mark.parametrize("seed", range(2))
def test_recall_over_many_tiles(spark, monkeypatch, seed):
    small(monkeypatch)
    rows = clusters(seed, 3000)
    expected = dict(brute(rows))
    got = result(spark.createDataFrame(rows, SCHEMA))
    hits = [len({r.vec_id for r in mine} & {j for j, _ in expected[q]}) for q, mine in got]
    assert len(got) == 60 and sum(hits) / 300 >= 0.95
    for q, mine in got:
        x = {i: np.array(v, float) for i, v, *_ in rows}
        assert all(abs(r.score - x[q] @ x[r.vec_id] / np.linalg.norm(x[q]) / np.linalg.norm(x[r.vec_id])) < 1e-12 for r in mine)


def test_sure_confidence_is_exact(spark, monkeypatch):
    small(monkeypatch)
    rows = clusters(7, 1500)
    same(result(spark.createDataFrame(rows, SCHEMA), confidence=1 - 1e-13), brute(rows))


def test_the_stopping_test_saves_verifications():
    rng = np.random.default_rng(5)
    x = N.unit(np.repeat(rng.normal(size=(64, 16)), 64, axis=0) + 0.02 * rng.normal(size=(4096, 16)))
    axes = N.directions(16, 8)
    tile = N.Tile(x, np.arange(4096), [np.array([i]) for i in range(4096)], axes)
    near = np.maximum(0, np.maximum(tile.low[None] - tile.places[:64, None], tile.places[:64, None] - tile.high[None]))
    found = tile.search(tile.x[:64], tile.places[:64], np.full(64, -2.0), 6, N.chi_square_quantile(0.95, 8))
    worst = np.array([-f[-1][0] for f in found])
    reach = N.chi_square_quantile(0.95, 8) * (2 - 2 * worst)
    assert ((near ** 2).sum(2) <= reach[:, None]).mean() < 0.3


def test_copies_go_by_id(spark, monkeypatch):
    small(monkeypatch)
    rows = clusters(3, 400) + [(1000 + i, [1.0] * 24, 1, 1) for i in range(700)]
    same(result(spark.createDataFrame(rows, SCHEMA), confidence=1 - 1e-13), brute(rows))


def test_rows_of_every_shape(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0], 1, 1), (0, [0.9, 0.1], 1, 1), (50, [2.0, 0.1], 1, 1), (50, [2.0, 0.1], 1, 1), (4, [1.0, 0.0, 0.0], 1, 1), (100, None, 1, 1),
            (150, [], 1, 1), (200, [0.0, 0.0], 1, 1), (250, [1.0, None], 1, 1), (300, [nan, 1.0], 1, 1), (350, [inf, 1.0], 1, 1), (None, [1.0, 0.02], 1, 1),
            (None, None, 1, 1), (12, [-1.0, 0.0], 1, 1), (400, [3e38, 3e38], 1, 1), (14, [1e-38, 1e-38], 1, 1), (450, [1.0] * 3000, 1, 1), (16, [0.0, 5e-45], 1, 1)]
    got = N.search(spark.createDataFrame(rows, SCHEMA)).collect()
    expected = [(q, j, s) for q, near in brute(rows) for j, s in near]
    key = lambda x: (x[0], -round(x[2], 9), x[1] is None, x[1] or 0)
    assert [x[:2] for x in sorted(((r.query_id, r.vec_id, r.score) for r in got), key=key)] == [
        x[:2] for x in sorted(((q, None if j == np.inf else j, s) for q, j, s in expected), key=key)]
    assert N.search(spark.createDataFrame([], SCHEMA)).count() == 0
    assert N.search(spark.createDataFrame([(50, [1.0], 1, 1)], SCHEMA)).count() == 0


def test_recall_on_the_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    expected = dict(brute([(r.vec_id, r.embedding) for r in df.collect()]))
    got = result(df)
    assert len(got) == len(expected)
    assert sum(len({r.vec_id for r in mine} & {j for j, _ in expected[q]}) for q, mine in got) >= 0.9 * 5 * len(got)
