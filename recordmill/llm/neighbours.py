"""Approximate nearest neighbours by low-dimensional stable projections in a kd-tree.

Unit vectors are projected on ``DIMENSIONS`` Gaussian directions. The Gaussian is stable: a
pair at distance ``s`` is at projected distance ``s * sqrt(X)``, X chi-square distributed. A
kd-tree over the projections is cut in two: its upper part is fitted on a bounded sample and
deals all vectors out over tiles; its lower part is built over each tile inside a task. A query
takes projected neighbours leaf by leaf, nearest leaf first, verifies them on the vectors, and
stops at projected distance ``d * sqrt(q)``: ``d`` is the distance of its k-th best so far,
``q`` the chi-square quantile of ``CONFIDENCE``. A nearer vector lies further out with a chance
of ``1 - CONFIDENCE`` only.

Queries first search the tile they fall in, then the others that their radius reaches. Tiles
and queries meet in one shuffle by tile: a task holds one tile and streams the queries past it.
Equal vectors are one class, of which the smallest ids are held, as many as can be in an answer.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.staging import stage

NEIGHBOURS = 5
QUERY_EVERY = 50
DIMENSIONS = 8
CONFIDENCE = 0.95  # of the stopping test: the expected recall, at least
SAMPLE = 1 << 16  # projections that the upper tree is fitted on, about
TILES = 64  # as long as tiles keep to the bounds below
LEAST_TILE, LARGEST_TILE = 512, 1 << 16  # vectors
MOST_TILES = 1 << 12
LEAF = 256
QUERY_BLOCK = 64
_SEED = 20
_NO_ID = (1 << 63) - 1  # stands for a null id, after all others


def chi_square_quantile(p: float, degrees: int) -> float:
    """The value that a chi-square variable of an even number of degrees stays under with chance ``p``."""
    if degrees % 2:
        raise ValueError("an even number of dimensions")
    low, high = 0.0, 1000.0 + 10 * degrees
    for _ in range(200):
        x = (low + high) / 2
        term, total = 1.0, 1.0
        for i in range(1, degrees // 2):
            term *= x / 2 / i
            total += term
        low, high = (x, high) if 1 - math.exp(-x / 2) * total < p else (low, x)
    return high


def directions(dim: int, count: int) -> np.ndarray:
    """The stable projection of vectors of length ``dim``, the same in every task.

    Each direction is scaled to its expected length, since one draw serves all pairs.
    """
    drawn = np.random.default_rng((_SEED, dim)).standard_normal((dim, count))
    return drawn * np.sqrt(dim / (drawn * drawn).sum(0))


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)  # before squares overflow or vanish
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def _usable(lists: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Values of all lists, and bounds of those that are not null, empty or zero and hold finite numbers only; -1 else."""
    sizes = np.nan_to_num(pc.list_value_length(lists).to_numpy(zero_copy_only=False)).astype(np.int64)
    values = lists.flatten()
    data = values.cast(pa.float64()).fill_null(np.nan).to_numpy(zero_copy_only=False)
    first = np.cumsum(sizes) - sizes
    bad = np.r_[0, np.cumsum(~np.isfinite(data))]
    some = np.r_[0, np.cumsum(data != 0)]
    ok = (sizes > 0) & (bad[first + sizes] == bad[first]) & (some[first + sizes] > some[first])
    return data, np.where(ok, first, -1), sizes


def vectors(rows: DataFrame) -> DataFrame:
    """``vec_id, dim, vector``: the components as bytes of doubles; rows that take no part are left out."""

    def run(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            for at in range(0, len(batch), 4096):
                part = batch.slice(at, 4096)
                data, first, size = _usable(part.column(1))
                data = data + 0.0  # minus zero is zero
                keep = np.flatnonzero(first >= 0)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(keep)), pa.array(size[keep].astype(np.int32)),
                     pa.array([data[a : a + n].tobytes() for a, n in zip(first[keep], size[keep])], pa.binary())],
                    ["vec_id", "dim", "vector"])

    return rows.mapInArrow(run, "vec_id long, dim int, vector binary")


def classes(found: DataFrame, held: int, query: Column) -> DataFrame:
    """``cid, dim, vector, ids, query``: the different vectors, the ``held`` smallest ids of each, and whether a query has it."""
    lowest = Window.partitionBy("vector").orderBy(F.col("vec_id").asc_nulls_last())
    asked = found.where(query).select("vector").distinct().withColumn("query", F.lit(True))
    few = found.withColumn("_rank", F.row_number().over(lowest)).where(F.col("_rank") <= held)
    few = few.groupBy("vector").agg(
        F.first("dim").alias("dim"), F.sort_array(F.collect_list(F.coalesce("vec_id", F.lit(_NO_ID)))).alias("ids"))
    few = few.join(asked, "vector", "left").withColumn("query", F.coalesce("query", F.lit(False)))
    return few.withColumn("cid", F.monotonically_increasing_id())


def fit_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Axis and threshold of each inner node of a kd-tree of ``depth`` levels, as a heap; widest axis, median."""
    count = (1 << depth) - 1
    axis, cut = np.zeros(count, np.int64), np.zeros(count)
    rows = {0: np.arange(len(sample))}
    for node in range(count):
        own = rows.pop(node)
        x = sample[own]
        if len(own):
            axis[node] = int(np.ptp(x, axis=0).argmax())
            cut[node] = np.median(x[:, axis[node]])
        right = x[:, axis[node]] >= cut[node] if len(own) else np.zeros(0, bool)
        rows[2 * node + 1], rows[2 * node + 2] = own[~right], own[right]
    return axis, cut


def tile_of(places: np.ndarray, axis: np.ndarray, cut: np.ndarray) -> np.ndarray:
    node = np.zeros(len(places), np.int64)
    for _ in range(int(math.log2(len(axis) + 1))):
        node = 2 * node + 1 + (places[np.arange(len(places)), axis[node]] >= cut[node])
    return node - len(axis)


def tiles_within(place: np.ndarray, radius2: float, axis: np.ndarray, cut: np.ndarray) -> list[int]:
    """The tiles whose region is no further than ``sqrt(radius2)`` from ``place``."""
    out, todo = [], [(0, np.zeros(len(place)))]  # node, and its distance along each axis
    while todo:
        node, gap = todo.pop()
        if node >= len(axis):
            out.append(node - len(axis))
            continue
        a = axis[node]
        side = int(place[a] >= cut[node])
        todo.append((2 * node + 1 + side, gap))
        other = gap.copy()
        other[a] = max(gap[a], abs(place[a] - cut[node]))
        if other @ other <= radius2:
            todo.append((2 * node + 2 - side, other))
    return out


def local_tree(places: np.ndarray) -> list[np.ndarray]:
    """The leaves of a kd-tree over a tile: index arrays of at most ``LEAF`` rows."""
    out, todo = [], [np.arange(len(places))]
    while todo:
        own = todo.pop()
        if len(own) <= LEAF:
            out.append(own)
            continue
        x = places[own]
        a = int(np.ptp(x, axis=0).argmax())
        order = np.argpartition(x[:, a], len(own) // 2)
        todo += [own[order[: len(own) // 2]], own[order[len(own) // 2 :]]]
    return out


class Tile:
    """The classes of one length in a tile, with the kd-tree over their places."""

    def __init__(self, x: np.ndarray, cids: np.ndarray, ids: list[np.ndarray], axes: np.ndarray):
        places = x @ axes
        leaves = local_tree(places)
        order = np.concatenate(leaves)
        self.x, self.places, self.cids, self.ids = x[order], places[order], cids[order], [ids[i] for i in order.tolist()]
        self.ends = np.cumsum([len(x) for x in leaves])
        self.low = np.array([places[own].min(0) for own in leaves])
        self.high = np.array([places[own].max(0) for own in leaves])
        self.copies = np.array([len(i) for i in self.ids])

    def search(self, queries: np.ndarray, places: np.ndarray, bound: np.ndarray, held: int, stop: float):
        """For each query its best ``held`` rows (score, id, class) of this tile at ``bound`` or above.

        ``bound`` is the score of the ``held``-th best row known of each query.
        """
        best: list[list[tuple[float, int, int]]] = [[] for _ in queries]
        bound = bound.copy()
        gaps = np.maximum(0, np.maximum(self.low[None] - places[:, None], places[:, None] - self.high[None]))
        near = (gaps * gaps).sum(2)
        for leaf in np.argsort(near.min(0)).tolist():
            reach = stop * np.maximum(0, 2 - 2 * bound)  # squared distance of unit vectors
            active = np.flatnonzero(near[:, leaf] <= reach + 1e-9)
            if not len(active):
                continue
            rows = np.arange(self.ends[leaf - 1] if leaf else 0, self.ends[leaf])
            score = queries[active] @ self.x[rows].T
            for j, q in enumerate(active.tolist()):
                own = score[j]
                if len(own) > held:  # no further down than the held-th best class
                    at = np.flatnonzero(own >= max(bound[q], np.partition(own, -held)[-held]) - 1e-12)
                else:
                    at = np.flatnonzero(own >= bound[q] - 1e-12)
                if not len(at):
                    continue
                at = rows[at]
                exact = (self.x[at] * queries[q]).sum(1)  # the same for equal pairs, however they are dealt out
                for s, r in zip(exact.tolist(), at.tolist()):
                    best[q] += [(-s, i, int(self.cids[r])) for i in self.ids[r]]
                best[q] = sorted(best[q])[:held]
                if len(best[q]) == held:
                    bound[q] = max(bound[q], -best[q][-1][0])
        return best


NODE = "tile int, dim int, kind int, cid long, vector binary, ids array<long>, bound double"
FOUND = "cid long, neighbours array<struct<less:double,id:long,of:long>>"


def _search(dealt: DataFrame, held: int, stop: float, count: int) -> DataFrame:
    """``FOUND`` rows from ``NODE`` rows: kind 0 makes up a tile, kind 1 asks it. One shuffle by tile."""

    def answers(tile: Tile | None, dim: int, asked: list[tuple[int, bytes, float]]):
        if tile is None:
            found = [[] for _ in asked]
        else:
            x = unit(np.frombuffer(b"".join(v for _, v, _ in asked), "<f8").reshape(-1, dim))
            found = tile.search(x, x @ directions(dim, count), np.array([b for *_, b in asked]), held, stop)
        rows = [(cid, f) for (cid, *_), f in zip(asked, found) if f]
        kind = pa.list_(pa.struct([("less", pa.float64()), ("id", pa.int64()), ("of", pa.int64())]))
        lists = [[{"less": s, "id": i, "of": c} for s, i, c in f] for _, f in rows]
        return pa.RecordBatch.from_arrays([pa.array([c for c, _ in rows], pa.int64()), pa.array(lists, kind)], ["cid", "neighbours"])

    def run(batches):
        at, tile = None, None
        held_x, held_c, held_i, asked = [], [], [], []
        for batch in batches:
            for t, dim, kind, cid, vector, ids, bound in zip(*(c.to_pylist() for c in batch.columns)):
                if (t, dim) != at:
                    if asked:
                        yield answers(tile, at[1], asked)
                    at, tile, held_x, held_c, held_i, asked = (t, dim), None, [], [], [], []
                if kind == 0:
                    held_x.append(vector)
                    held_c.append(cid)
                    held_i.append(ids)
                    continue
                if held_x:
                    tile = Tile(unit(np.frombuffer(b"".join(held_x), "<f8").reshape(-1, dim)), np.array(held_c), held_i, directions(dim, count))
                    held_x, held_c, held_i = [], [], []
                asked.append((cid, vector, bound))
                if len(asked) == QUERY_BLOCK:
                    yield answers(tile, dim, asked)
                    asked = []
        if asked:
            yield answers(tile, at[1], asked)

    rows = dealt.repartition("tile").sortWithinPartitions("tile", "dim", "kind")
    return rows.mapInArrow(run, FOUND)


def _best(found: DataFrame, held: int) -> DataFrame:
    """``cid, neighbours``: the best ``held`` rows of each query over all tiles, best first."""
    rows = found.select("cid", F.inline("neighbours"))
    place = F.row_number().over(Window.partitionBy("cid").orderBy("less", "id", "of"))
    rows = rows.withColumn("_place", place).where(F.col("_place") <= held)
    return rows.groupBy("cid").agg(F.sort_array(F.collect_list(F.struct("less", "id", "of"))).alias("neighbours"))


def nearest(rows: DataFrame, query: Column, k: int = NEIGHBOURS, confidence: float = CONFIDENCE, count: int = DIMENSIONS) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row of ``rows(vec_id, embedding)`` that ``query`` holds for.

    Nearness is the cosine in double precision, ties go to the smaller ``vec_id``, a null id
    last. Candidates are all other rows of the same length, repeated ones too; fewer than ``k``
    are all returned. Null, empty and zero vectors and those with null or non-finite components
    are neither queries nor candidates, and rows without an id are candidates only. A true
    neighbour is missed with a chance of ``1 - confidence`` at most, taken over the projections.
    Repeated query rows are answered one by one. Tiles are held in memory, ``LARGEST_TILE``
    vectors or so each. Runs jobs when called.
    """
    held = k + 1
    given = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    ask = query & F.col("vec_id").isNotNull()
    found = stage(vectors(given), "vectors")
    known = stage(classes(found, held, ask), "classes")
    total = known.count()
    stop = chi_square_quantile(confidence, count)

    size = min(max(total // TILES, LEAST_TILE), LARGEST_TILE)
    depth = max(0, math.ceil(math.log2(max(1, min(total / size, MOST_TILES)))))

    def place(batches):
        for batch in batches:
            y = [unit(np.frombuffer(v, "<f8")[None]) @ directions(d, count) for d, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([pa.array([x[0].astype("<f4").tobytes() for x in y], pa.binary())], ["place"])

    share = F.pmod(F.xxhash64("vector"), F.lit(1 << 31)) < F.lit(float(1 << 31) * min(1.0, SAMPLE / max(1, total)))
    few = known.where(share).select("dim", "vector").mapInArrow(place, "place binary").collect() if depth else []
    axis, cut = fit_tree(np.array([np.frombuffer(bytes(r.place), "<f4") for r in few], float).reshape(-1, count), depth)

    def deal(batches):
        """Every class to its tile, and again as a query there."""
        for batch in batches:
            dims, data = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            tiles = np.zeros(len(batch), np.int32)
            for d in set(dims):
                at = [i for i, x in enumerate(dims) if x == d]
                x = unit(np.frombuffer(b"".join(data[i] for i in at), "<f8").reshape(-1, d))
                tiles[at] = tile_of(x @ directions(d, count), axis, cut)
            asks = batch.filter(batch.column(4))
            for part, own, kind in ((batch, tiles, 0), (asks, tiles[batch.column(4).to_numpy(zero_copy_only=False)], 1)):
                n = len(part)
                ids = part.column(3) if kind == 0 else pa.nulls(n, pa.list_(pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(own), part.column(1), pa.array(np.full(n, kind, np.int32)), part.column(0), part.column(2), ids,
                     pa.array(np.full(n, -2.0))], [f.split()[0] for f in NODE.split(", ")])

    def spread(batches):
        """Every query to the other tiles that it reaches."""
        for batch in batches:
            cols = {"tile": [], "dim": [], "kind": [], "cid": [], "vector": [], "ids": [], "bound": []}
            for cid, dim, v, bound in zip(*(c.to_pylist() for c in batch.columns)):
                bound = -2.0 if bound is None else bound
                y = (unit(np.frombuffer(v, "<f8")[None]) @ directions(dim, count))[0]
                home = int(tile_of(y[None], axis, cut)[0])
                for t in tiles_within(y, np.inf if bound == -2.0 else stop * max(0.0, 2 - 2 * bound) + 1e-9, axis, cut):
                    if t != home:
                        for name, x in zip(cols, (t, dim, 1, cid, v, None, bound)):
                            cols[name].append(x)
            kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.list_(pa.int64()), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols.values(), kinds)], list(cols))

    dealt = stage(known.select("cid", "dim", "vector", "ids", "query").mapInArrow(deal, NODE), "tiles")
    first = stage(_search(dealt, held, stop, count), "home-neighbours")
    bound = F.when(F.size("neighbours") == held, -F.element_at("neighbours", -1)["less"])
    queries = known.where("query").select("cid", "dim", "vector").join(first, "cid", "left").select("cid", "dim", "vector", bound.alias("bound"))
    wider = dealt.where("kind = 0").unionByName(queries.mapInArrow(spread, NODE))
    best = _best(first.unionByName(stage(_search(wider, held, stop, count), "further-neighbours")), held)

    asked = found.where(ask).join(known.where("query").select("vector", "cid"), "vector").select(F.col("vec_id").alias("query_id"), "cid")
    own = F.struct(F.col("query_id").alias("id"), F.col("cid").alias("of"))
    answers = asked.join(best, "cid").select("query_id", "neighbours", F.array_position(
        F.transform("neighbours", lambda x: F.struct(x["id"].alias("id"), x["of"].alias("of"))), own).alias("own"))
    others = F.filter("neighbours", lambda x, i: i + 1 != F.col("own"))  # the query's own row, if it is among them
    return answers.select("query_id", F.posexplode(F.slice(others, 1, k)).alias("rank", "x")).select(
        "query_id", (F.col("rank") + 1).alias("rank"), F.when(F.col("x.id") != _NO_ID, F.col("x.id")).alias("vec_id"),
        (-F.col("x.less")).alias("score"))


def search(rows: DataFrame, every: int = QUERY_EVERY) -> DataFrame:
    """The nearest others of the rows whose ``vec_id`` is divisible by ``every``."""
    return nearest(rows, F.col("vec_id") % every == 0)
