"""Epsilon grid order join against the comparison of all pairs."""

import duckdb
import numpy as np
import pytest

from recordmill.llm import embeddings as E


def brute(rows, threshold=0.9):
    """``vec_id -> (n_links, component_id)``; rows are numbered, ids may repeat."""
    good = []
    for v in rows:
        ok = v[1] is not None and len(v[1]) > 0 and all(x is not None and np.isfinite(x) for x in v[1]) and any(v[1])
        good.append(np.array(v[1], float) if ok else None)
    n = len(rows)
    near = [[j for j in range(n) if j != i and good[i] is not None and good[j] is not None and len(good[i]) == len(good[j])
             and good[i] @ good[j] / (np.linalg.norm(good[i]) * np.linalg.norm(good[j])) >= threshold] for i in range(n)]
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for j in near[todo.pop()]:
                if j not in seen:
                    seen.add(j)
                    todo.append(j)
        ids = [rows[j][0] for j in seen if rows[j][0] is not None]
        component = min(ids) if ids else None
        out.append((rows[i][0], len(near[i]), component, rows[i][0] is not None and rows[i][0] == component))
    return sorted(out, key=repr)


def result(df):
    return sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in E.near_duplicates(df).collect()), key=repr)


SCHEMA = "vec_id long, embedding array<float>, cid long"


@pytest.mark.parametrize("seed", range(2))
def test_random_clusters_in_small_blocks(spark, monkeypatch, seed):
    monkeypatch.setattr(E, "BLOCK", 16)
    monkeypatch.setattr(E, "LEAF", 4)
    monkeypatch.setattr(E, "FANOUT", 3)
    rng = np.random.default_rng(seed)
    rows = []
    for c in range(12):
        centre = rng.normal(size=8)
        for k in range(20):
            v = (centre + rng.normal(size=8) * rng.choice([0.02, 0.3, 1.0])).astype(np.float32)
            rows.append((len(rows), v.tolist(), 1))
            if k % 7 == 0:
                rows += [(len(rows) + j, v.tolist(), 1) for j in range(3)]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    rows = [
        (9, [1.0, 0.0], 1), (3, [2.0, 0.1], 1), (3, [2.0, 0.1], 1), (4, [1.0, 0.0, 0.0], 1), (5, None, 1), (6, [], 1), (7, [0.0, 0.0], 1),
        (8, [1.0, None], 1), (10, [nan, 1.0], 1), (11, [inf, 1.0], 1), (None, [1.0, 0.02], 1), (None, None, 1), (12, [-1.0, 0.0], 1),
        (13, [3e38, 3e38], 1), (14, [1e-38, 1e-38], 1), (15, [0.0, 5e-45], 1),
    ]
    assert result(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    assert E.near_duplicates(spark.createDataFrame([], SCHEMA)).count() == 0
    assert result(spark.createDataFrame([(1, None, 1)], SCHEMA)) == [(1, 0, 1, True)]


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    rows = [(r.vec_id, r.embedding) for r in df.collect()]
    assert result(df) == brute(rows)


def test_sql_gives_the_same_rows(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM '{sf_dir}/embeddings.parquet'")
    rows = con.sql(E.ORACLE)
    assert rows.columns == ["vec_id", "n_links", "component_id", "kept"]
    assert sorted(rows.fetchall(), key=repr) == result(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def test_sql_on_rows_that_link_with_nothing(spark):
    rows = [(1, "[1.0, 0.0]"), (1, "[2.0, 0.0]"), (None, "[1.0, 0.1]"), (4, "[0.0, 0.0]"), (5, "[]"), (6, "NULL"),
            (7, "[1.0, NULL]"), (8, "[1.0, 'nan'::FLOAT]"), (9, "[1.0]"), (None, "[0.0, 1.0]")]
    con = duckdb.connect()
    con.sql("CREATE TABLE embeddings (vec_id BIGINT, embedding FLOAT[])")
    for i, v in rows:
        con.sql(f"INSERT INTO embeddings VALUES ({'NULL' if i is None else i}, {v})")
    given = [(i, v, 0) for i, v in con.sql("FROM embeddings").fetchall()]
    assert sorted(con.sql(E.ORACLE).fetchall(), key=repr) == result(spark.createDataFrame(given, SCHEMA)) == brute(given)
