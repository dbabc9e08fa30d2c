"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints that differ in at most ``RADIUS`` = 3 bits differ in at most two outside
some one of ``BLOCKS`` bit blocks: take a block that holds a difference. So every fingerprint
emits, for each block, all variants within half of that radius (one bit) of its bits outside
the block: ``BLOCKS + 64 * (BLOCKS - 1)`` keys. Linked fingerprints meet at a key and are
verified there. Only different fingerprints take part; copies share one.

Large groups are never paired off: links inside them are looked up by the block's bits (at
most ``22 + 231 + 1540`` lookups a member), and only a spanning forest of a task's links
leaves it.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.llm import tokens as T
from recordmill.llm.components import FLUSH, connected_components, forest
from recordmill.staging import stage

WIDTH = 3  # words of a shingle
RADIUS = 3
BLOCKS = 3
_EDGES = [0, 21, 42, 64]
_SMALL = 48  # members up to which a group is compared directly
_ONE = np.uint64(1)


def _shingle_hashes(text: bytes, width: int) -> np.ndarray:
    words = text.lower().split()
    if not words:
        return np.zeros(0, np.uint64)
    line = b" ".join(words)
    if len(words) <= width:
        return np.array([xxhash.xxh64_intdigest(line, 42)], np.uint64)
    ends = np.cumsum([len(w) + 1 for w in words])
    starts = (ends - [len(w) + 1 for w in words])[: len(words) - width + 1].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(line[a:b], 42) for a, b in zip(starts, stops)), np.uint64, len(starts))


def fingerprint(text: str | None, width: int = WIDTH) -> int:
    """A bit is set if it is set in over half of the shingle hashes; no word gives zero."""
    h = _shingle_hashes((text or "").encode(), width)
    if not len(h):
        return 0
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].astype("<u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(h), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, name: str = "fp", width: int = WIDTH) -> DataFrame:
    """``docs`` with the fingerprint of ``text`` as last column ``name`` (a long with the same 64 bits)."""
    rest = docs.drop(name)
    schema = rest.withColumn(name, F.lit(0).cast("long")).schema

    def run(batches):
        for part in T.chunks(batches):
            texts = part.column(part.schema.get_field_index("text"))
            fps = np.array([fingerprint(t, width) for t in texts.to_pylist()], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(fps)], [*part.schema.names, name])

    return rest.mapInArrow(run, schema)


def _exact_keys(fps: np.ndarray, block: int) -> np.ndarray:
    """The key of each fingerprint without a flip: its bits outside ``block``, mixed, with the block's number."""
    mask = np.uint64(((1 << (_EDGES[block + 1] - _EDGES[block])) - 1) << _EDGES[block])
    return T.mix(fps & ~mask) & ~np.uint64(3) | np.uint64(block)


def variants(fps: np.ndarray) -> np.ndarray:
    """The keys of each fingerprint (uint64), as one row each."""
    out = []
    for block, (low, high) in enumerate(zip(_EDGES, _EDGES[1:])):
        out.append(_exact_keys(fps, block))
        out += [_exact_keys(fps ^ (_ONE << np.uint64(bit)), block) for bit in [*range(low), *range(high, 64)]]
    return np.stack(out, 1)


def _large_group(fps: np.ndarray, key: np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Links that connect all linked members of a group which meet at ``key``, without pairing them off."""
    block = int(key & np.uint64(3))
    low, high = _EDGES[block], _EDGES[block + 1]
    inside = fps & np.uint64(((1 << (high - low)) - 1) << low)
    order = np.argsort(inside, kind="stable")
    fps, inside = fps[order], inside[order]
    exact = _exact_keys(fps, block) == key
    # Members with the same bits in the block differ in two others at most: all link to the first.
    head = np.ones(len(fps), bool)
    head[1:] = inside[1:] != inside[:-1]
    run, lead = np.cumsum(head) - 1, fps[head]
    src, dst = [fps[~head]], [lead[run[~head]]]
    values = inside[head]
    has_exact = np.zeros(len(values), bool)
    has_exact[run[exact]] = True
    exact_fp = lead.copy()
    exact_fp[run[exact]] = fps[exact]
    # Outside the block, members differ in two bits at most, an exact one and another in one,
    # two exact ones in none. (Two that flip the same bit meet as exact ones at another key.)
    for flips in (1, 2, 3):
        own = np.flatnonzero(has_exact) if flips > 1 else np.arange(len(values))
        for bits in combinations(range(low, high), flips):
            wanted = values[own] ^ np.uint64(sum(1 << b for b in bits))
            at = np.minimum(np.searchsorted(values, wanted), len(values) - 1)
            hit = values[at] == wanted
            if flips == 3:
                hit &= has_exact[at]
            src.append((exact_fp if flips > 1 else lead)[own[hit]])
            dst.append((exact_fp if flips == 3 else lead)[at[hit]])
    return np.concatenate(src), np.concatenate(dst)


def group_links(keys: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links within groups of equal ``keys`` (adjacent rows), enough to connect all linked members."""
    start = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
    size = np.diff(np.r_[start, len(keys)])
    src, dst = [], []
    for at, n in zip(start[size > _SMALL], size[size > _SMALL]):
        a, b = _large_group(fps[at : at + n], keys[at])
        src.append(a)
        dst.append(b)
    left = np.repeat(np.where(size <= _SMALL, size, 0), size) - (np.arange(len(keys)) - np.repeat(start, size)) - 1
    own = np.arange(len(keys))
    for lag in range(1, _SMALL):  # members after each one in its group
        own = own[left[own] >= lag]
        if not len(own):
            break
        near = own[np.bitwise_count(fps[own] ^ fps[own + lag]) <= RADIUS]
        src.append(fps[near])
        dst.append(fps[near + lag])
    none = [np.zeros(0, np.uint64)]
    return np.concatenate(none + src), np.concatenate(none + dst)


def fingerprint_links(prints: DataFrame) -> DataFrame:
    """``src, dst``: links among the distinct fingerprints ``fp`` that connect all within ``RADIUS`` bits."""

    def emit(batches):
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for at in range(0, len(fps), 1000):
                part = fps[at : at + 1000]
                keys = variants(part)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(part, keys.shape[1]).view(np.int64))],
                    ["key", "fp"])

    def meet(batches):
        keys, fps = np.zeros(0, np.uint64), np.zeros(0, np.uint64)
        src, dst, held = [], [], 0

        def links():
            a, b = forest(np.concatenate(src).view(np.int64), np.concatenate(dst).view(np.int64))
            return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["src", "dst"])

        def join(k, f):
            nonlocal held
            a, b = group_links(k, f)
            src.append(a)
            dst.append(b)
            held += len(a)

        for batch in batches:
            keys = np.concatenate([keys, batch.column(0).to_numpy().view(np.uint64)])
            fps = np.concatenate([fps, batch.column(1).to_numpy().view(np.uint64)])
            cut = len(keys) - int((keys[::-1] == keys[-1]).argmin()) if (keys != keys[-1]).any() else 0
            if cut:
                join(keys[:cut], fps[:cut])
                keys, fps = keys[cut:], fps[cut:]
            if held >= FLUSH:
                yield links()
                src, dst, held = [], [], 0
        if len(keys):
            join(keys, fps)
        if src:
            yield links()

    return (
        prints.select("fp").mapInArrow(emit, "key long, fp long").repartition("key").sortWithinPartitions("key")
        .mapInArrow(meet, "src long, dst long")
    )


def _roots(rows: DataFrame) -> DataFrame:
    """``fp, low, root`` for each different fingerprint of ``rows(doc_id, fp)``: its smallest id and its component. Runs jobs."""
    prints = stage(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "prints")
    found = connected_components(fingerprint_links(prints), reduce=False)
    named = prints.join(found, prints.fp == found.node, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("root"))
    return stage(named, "roots")


def near_duplicates(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """``doc_id, fp, component_id`` for each row of ``docs(doc_id, text)``.

    ``component_id`` is the smallest ``doc_id`` whose fingerprint is reachable over links of at
    most three bits. Null and empty texts have fingerprint zero and link like any other; a row
    with a null id takes part, and its component is named by the others (null if there is none).
    Repeated rows give repeated rows. Runs jobs when called.
    """
    rows = stage(fingerprints(docs.select("doc_id", "text"), width=width).select("doc_id", "fp"), "fingerprints")
    named = _roots(rows)
    ids = stage(named.groupBy("root").agg(F.min("low").alias("component_id")), "ids")
    names = stage(named.join(ids, "root").select("fp", "component_id"), "names")
    return rows.join(names, "fp").select("doc_id", "fp", "component_id")


def keep_first(docs: DataFrame, width: int = WIDTH) -> DataFrame:
    """One document of each group of near duplicates: the one with the smallest id.

    Of repeated rows one stays. A group whose ids are all null keeps one of its rows; groups
    are told apart by their fingerprints, whatever ids they share. Columns stay as they are.
    """
    own = "_fingerprint"
    while own.lower() in (c.lower() for c in docs.columns):
        own = f"_{own}"
    marked = stage(fingerprints(docs, own, width), "fingerprints")
    kept = _roots(marked.select("doc_id", F.col(own).alias("fp"))).groupBy("root").agg(F.min(F.struct(F.col("low").isNull(), "low", "fp")).alias("first"))
    kept = stage(kept.select(F.col("first.low").alias("low"), F.col("first.fp").alias("fp")), "kept")
    same = marked.doc_id.eqNullSafe(kept.low) & (marked[own] == kept.fp)
    return marked.join(kept, same, "left_semi").dropDuplicates(["doc_id", own]).drop(own)
