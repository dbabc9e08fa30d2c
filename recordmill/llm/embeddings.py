"""Embedding near-dedup by an epsilon grid order join.

Unit vectors with cosine ``c`` lie ``sqrt(2 - 2c)`` = epsilon apart, and no further apart in
any projection. Vectors are projected on their leading principal dimensions, cut into a grid
of cells of side epsilon, and sorted by cell. The sequence is split into blocks, blocks into
a tree of intervals with bounding boxes. The join descends that tree level by level as
equi-joins on parents, drops interval pairs whose boxes are over epsilon apart, and compares
the remaining blocks, halving them further while their boxes allow it.

Equal vectors count as one class with a number of copies, links are summed inside a task,
and only a spanning forest of its links leaves it: a group of n near copies costs its
comparisons but never n * n rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm.components import connected_components, forest
from recordmill.staging import stage

THRESHOLD = 0.9
DIMENSIONS = 6  # leading principal dimensions of the grid
BLOCK = 2048  # vectors
LEAF = 256  # vectors that are compared without another look at boxes
FANOUT = 8
_SLACK = 1e-9

BLOCKS = "part int, seq int, low array<double>, high array<double>, cids binary, copies binary, vectors binary, places binary"


def _vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, dim, vector``: the components as doubles; rows that can link with nothing are left out."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                keep, dims, out = [], [], []
                lists = part.column(1)
                values = lists.flatten()
                nulls = values.is_null().to_numpy(zero_copy_only=False)
                data = values.cast(pa.float64()).fill_null(0.0).to_numpy()
                bad = nulls | ~np.isfinite(data)
                sizes = np.array([0 if n is None else n for n in pc.list_value_length(lists).to_pylist()])
                ends = np.cumsum(sizes)
                for i, (a, b) in enumerate(zip(ends - sizes, ends)):
                    v = data[a:b]
                    if b > a and not bad[a:b].any() and np.linalg.norm(v / max(np.abs(v).max(), 1e-300)) > 0:
                        keep.append(i)
                        dims.append(b - a)
                        out.append(v.astype("<f8").tobytes())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keep, pa.int64())), pa.array(dims, pa.int32()), pa.array(out, pa.binary())],
                    ["vec_id", "dim", "vector"])

    return rows.mapInArrow(run, "vec_id long, dim int, vector binary")


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), "<f8").reshape(-1, dim)


def _unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # before squares overflow or vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def principal_dimensions(classes: DataFrame, dim: int, count: int) -> np.ndarray:
    """``count`` orthonormal directions (columns) of the largest variance; sums are formed in the tasks."""

    def run(batches):
        total = np.zeros((dim + 1, dim))
        n = 0
        for batch in batches:
            for at in range(0, len(batch), 4096):
                x = _unit(_matrix(batch.column(0).slice(at, 4096), dim))
                total[:dim] += x.T @ x
                total[dim] += x.sum(0)
                n += len(x)
        yield pa.RecordBatch.from_pydict({"n": [n], "sums": pa.array([total.tobytes()], pa.binary())})

    def add(batches):
        total, n = np.zeros((dim + 1, dim)), 0
        for batch in batches:
            for m, s in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                total, n = total + np.frombuffer(s).reshape(dim + 1, dim), n + m
        yield pa.RecordBatch.from_pydict({"n": [n], "sums": pa.array([total.tobytes()], pa.binary())})

    schema = "n long, sums binary"
    parts = classes.select("vector").mapInArrow(run, schema).repartition(8, F.rand(1)).mapInArrow(add, schema).collect()
    n = max(1, sum(p.n for p in parts))
    total = sum(np.frombuffer(bytes(p.sums)).reshape(dim + 1, dim) for p in parts) / n
    values, directions = np.linalg.eigh(total[:dim] - np.outer(total[dim], total[dim]))
    return directions[:, np.argsort(-values)[:count]]


def _blocks(classes: DataFrame, dim: int, axes: np.ndarray, eps: float) -> DataFrame:
    """The classes in epsilon grid order, as blocks with the box of their places on the axes."""
    k = axes.shape[1]
    cells = [f"c{j}" for j in range(k)]
    schema = classes.schema.simpleString()[7:-1].replace(",", ", ").replace(":", " ")

    def place(batches):
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                y = _unit(_matrix(part.column(part.schema.get_field_index("vector")), dim)) @ axes
                cell = np.floor(y / eps).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, *(pa.array(cell[:, j]) for j in range(k)), pa.array(y[:, 0])],
                    [*part.schema.names, *cells, "y"])

    def gather(batches):
        part, seq = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []

        def block(rows: pa.RecordBatch):
            x = _matrix(rows.column(2), dim)
            y = _unit(x) @ axes
            values = [[part], [seq], [y.min(0).tolist()], [y.max(0).tolist()], [rows.column(0).to_numpy().tobytes()],
                      [rows.column(1).to_numpy().tobytes()], [x.tobytes()], [y.tobytes()]]
            kinds = [pa.int32()] * 2 + [pa.list_(pa.float64())] * 2 + [pa.binary()] * 4
            return pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(values, kinds)], [f.split()[0] for f in BLOCKS.split(", ")])

        count = 0
        for batch in batches:
            at = 0
            while at < len(batch):
                take = min(BLOCK - count, len(batch) - at)
                held.append(batch.slice(at, take))
                count, at = count + take, at + take
                if count == BLOCK:
                    yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])
                    held, count, seq = [], 0, seq + 1
        if held:
            yield block(pa.Table.from_batches(held).combine_chunks().to_batches()[0])

    placed = classes.mapInArrow(place, f"{schema}, {', '.join(c + ' int' for c in cells)}, y double")
    ordered = placed.repartitionByRange(*cells, "y").sortWithinPartitions(*cells, "y")
    return ordered.select("cid", "copies", "vector").mapInArrow(gather, BLOCKS)


def _apart(a: str, b: str, k: int):
    """Squared distance of two boxes."""
    gaps = [
        F.greatest(
            F.lit(0.0), F.col(f"{a}low")[j] - F.col(f"{b}high")[j], F.col(f"{b}low")[j] - F.col(f"{a}high")[j])
        for j in range(k)
    ]
    return sum((g * g for g in gaps), F.lit(0.0))


def _pairs(boxes: DataFrame, count: int, k: int, eps: float) -> DataFrame:
    """``a, b`` (a <= b): the blocks whose boxes are at most epsilon apart, found by descent from the whole sequence."""
    levels = 0
    while FANOUT ** levels < count:
        levels += 1
    pairs = boxes.sparkSession.createDataFrame([(0, 0)], "a long, b long")
    for level in range(levels - 1, -1, -1):
        node = F.floor(F.col("b") / F.lit(FANOUT ** level)).cast("long")
        nodes = stage(
            boxes.groupBy(node.alias("node")).agg(
                F.array(*(F.min(F.col("low")[j]) for j in range(k))).alias("low"),
                F.array(*(F.max(F.col("high")[j]) for j in range(k))).alias("high"))
            .withColumn("parent", F.floor(F.col("node") / FANOUT).cast("long")), "intervals")
        left = nodes.select(*(F.col(c).alias(f"a_{c}") for c in nodes.columns))
        right = nodes.select(*(F.col(c).alias(f"b_{c}") for c in nodes.columns))
        pairs = pairs.join(left, F.col("a") == F.col("a_parent")).join(right, F.col("b") == F.col("b_parent"))
        pairs = pairs.where("a_node <= b_node").where(_apart("a_", "b_", k) <= eps * eps + _SLACK)
        pairs = stage(pairs.select(F.col("a_node").alias("a"), F.col("b_node").alias("b")), "interval-pairs")
    return pairs


def compare(x, px, y, py, eps2: float, threshold: float, same: bool) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs of linked rows of ``x`` and ``y``, in parts; ``p*`` are the places on the axes."""
    stack = [(0, len(x), 0, len(y))]
    while stack:
        a, b, c, d = stack.pop()
        if same and c < a:
            continue
        gap = np.maximum(0, np.maximum(px[a:b].min(0) - py[c:d].max(0), py[c:d].min(0) - px[a:b].max(0)))
        if gap @ gap > eps2:
            continue
        if b - a > LEAF or d - c > LEAF:
            xs = [(a, b)] if b - a <= LEAF else [(a, (a + b) // 2), ((a + b) // 2, b)]
            ys = [(c, d)] if d - c <= LEAF else [(c, (c + d) // 2), ((c + d) // 2, d)]
            stack += [(*i, *j) for i in xs for j in ys]
            continue
        i, j = np.nonzero(x[a:b] @ y[c:d].T >= threshold)
        i, j = i + a, j + c
        if same:
            i, j = i[i < j], j[i < j]
        if len(i):
            yield i, j


def _links(pairs: DataFrame, blocks: DataFrame, dim: int, k: int, eps: float, threshold: float) -> DataFrame:
    """``kind, x, y``: kind 0 adds ``y`` links to class ``x``; kind 1 links classes ``x`` and ``y``."""

    def run(batches):
        for batch in batches:
            for row in range(len(batch)):
                a, b, *rest = (c[row].as_py() for c in batch.columns)
                (ia, na, xa, pa_), (ib, nb, xb, pb) = (
                    (np.frombuffer(i, np.int64), np.frombuffer(n, np.int64), _unit(np.frombuffer(x, "<f8").reshape(-1, dim)),
                     np.frombuffer(p, "<f8").reshape(-1, k)) for i, n, x, p in (rest[:4], rest[4:]))
                more_a, more_b = np.zeros(len(ia), np.int64), np.zeros(len(ib), np.int64)
                src, dst = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
                for i, j in compare(xa, pa_, xb, pb, eps * eps + _SLACK, threshold, a == b):
                    more_a += np.bincount(i, nb[j], len(ia)).astype(np.int64)
                    more_b += np.bincount(j, na[i], len(ib)).astype(np.int64)
                    s, d = forest(ia[i], ib[j])
                    src.append(s)
                    dst.append(d)
                src, dst = forest(np.concatenate(src), np.concatenate(dst))
                parts = [(0, ia[more_a > 0], more_a[more_a > 0]), (0, ib[more_b > 0], more_b[more_b > 0]), (1, src, dst)]
                for kind, x, y in parts:
                    if len(x):
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(x), kind, np.int32)), pa.array(x), pa.array(y)], ["kind", "x", "y"])

    data = blocks.select("b", "cids", "copies", "vectors", "places")
    left = data.select(F.col("b").alias("a"), *(F.col(c).alias(f"a_{c}") for c in data.columns[1:]))
    both = pairs.join(left, "a").join(data, "b").select("a", "b", *left.columns[1:], *data.columns[1:])
    return both.mapInArrow(run, "kind int, x long, y long")


def _linked(classes: DataFrame, dim: int, threshold: float) -> DataFrame:
    """The links of all classes of one dimension, as ``_links`` gives them."""
    eps = float(np.sqrt(2 - 2 * threshold))
    k = min(DIMENSIONS, dim)
    axes = principal_dimensions(classes, dim, k)
    blocks = stage(_blocks(classes, dim, axes, eps), "blocks")
    sizes = blocks.groupBy("part").agg((F.max("seq") + 1).alias("n")).orderBy("part").collect()  # one row a partition
    starts, count = {}, 0
    for r in sizes:
        starts[r.part], count = count, count + r.n
    at = blocks.sparkSession.createDataFrame(list(starts.items()), "part int, start long")
    blocks = blocks.join(F.broadcast(at), "part").withColumn("b", F.col("start") + F.col("seq"))
    pairs = _pairs(blocks.select("b", "low", "high"), count, k, eps)
    return stage(_links(pairs, blocks, dim, k, eps, threshold), "links")


def near_duplicates(rows: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``vec_id, n_links, component_id, kept`` for each row of ``rows(vec_id, embedding)``.

    Two vectors of one length link if their cosine, in double precision, is at least
    ``threshold`` (0 to 1). Null, empty and zero vectors and those with null or non-finite
    components link with nothing and keep themselves. Repeated rows are vectors that link with
    each other. A row with a null id takes part; components are named by the smallest id that
    is not null. Runs jobs when called.
    """
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    vectors = stage(_vectors(rows), "vectors")
    classes = stage(
        vectors.groupBy("dim", "vector").agg(F.min("vec_id").alias("low"), F.count("*").alias("copies"))
        .withColumn("cid", F.monotonically_increasing_id()), "classes")
    parts = [
        _linked(classes.where(F.col("dim") == r.dim).select("cid", "copies", "vector"), r.dim, threshold)
        for r in classes.select("dim").distinct().collect()  # lengths of vectors: one, or a few
    ]
    spark = rows.sparkSession
    links = spark.createDataFrame([], "kind int, x long, y long")
    for p in parts:
        links = links.unionByName(p)
    found = connected_components(links.where("kind = 1").select(F.col("x").alias("src"), F.col("y").alias("dst")))
    counts = links.where("kind = 0").groupBy(F.col("x").alias("cid")).agg(F.sum("y").alias("more"))
    named = classes.select("cid", "dim", "vector", "low", "copies").join(counts, "cid", "left").join(
        found.withColumnRenamed("node", "cid"), "cid", "left")
    named = stage(named.withColumn("root", F.coalesce("component", "cid")), "named")
    ids = stage(named.groupBy("root").agg(F.min("low").alias("component_id")), "ids")
    named = stage(
        named.join(ids, "root").select(
            "dim", "vector", (F.coalesce("more", F.lit(0)) + F.col("copies") - 1).alias("n_links"), "component_id"), "answers")
    linked = vectors.join(named, ["dim", "vector"]).select("vec_id", "n_links", "component_id")
    alone = rows.mapInArrow(_left_out, "vec_id long").select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def _left_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of the rows that ``_vectors`` leaves out."""
    for batch in batches:
        ids = []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if not v or any(x is None for x in v) or not np.isfinite(v).all() or not any(v):
                ids.append(i)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64())], ["vec_id"])


#: The same rows by comparing all pairs, for DuckDB.
ORACLE = """
WITH RECURSIVE numbered AS MATERIALIZED (
    SELECT row_number() OVER () AS n, CAST(vec_id AS BIGINT) AS vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings
), usable AS MATERIALIZED (
    SELECT n, v FROM numbered
    WHERE list_count(v) = len(v) AND isfinite(list_sum(v)) AND greatest(list_max(v), -list_min(v)) > 0
), good AS MATERIALIZED (
    SELECT n, v, len(v) AS dim, sqrt(list_inner_product(v, v)) AS norm FROM usable
), link AS MATERIALIZED (
    SELECT a.n AS x, b.n AS y FROM good a JOIN good b ON a.dim = b.dim AND a.n <> b.n
    WHERE CASE WHEN a.dim = b.dim THEN list_inner_product(a.v, b.v) / (a.norm * b.norm) >= 0.9 END
), reach AS (
    SELECT n AS x, n AS y FROM numbered
    UNION
    SELECT r.x, l.y FROM reach r JOIN link l ON l.x = r.y
), named AS (
    SELECT r.x AS n, min(o.vec_id) AS component_id FROM reach r JOIN numbered o ON o.n = r.y GROUP BY r.x
), counted AS (
    SELECT x AS n, count(*) AS n_links FROM link GROUP BY x
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, component_id, coalesce(vec_id = component_id, false) AS kept
FROM numbered JOIN named USING (n) LEFT JOIN counted USING (n)
"""
