"""Language-model scoring with an interpolated modified Kneser-Ney model.

Tasks count n-grams in parts of ``PART`` tokens and send them, sorted and compressed, to
shards by the hash of their context. A shard adds up its n-grams, writes them as sorted hash
arrays to the shared folder, with the statistics of their contexts, and passes the
continuation counts of the next shorter n-grams on. Scoring maps the arrays into the workers'
memory, reads the pages it needs, and looks up all n-grams of many texts in sorted order.

All counts cover the whole training corpus. No array is held by one process: a shard has
about ``SHARD_BYTES`` of training text, and their number grows with the corpus.
"""

from __future__ import annotations

import math
import os
import uuid
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.llm import tokens as T
from recordmill.staging import checkpoint_dir, stage

ORDER = 2
PART = 1 << 20  # tokens counted before they are sent
SHARD_BYTES = 16 << 20
_START = np.uint64(0x243F6A8885A308D3)  # stands before a text
_END = np.uint64(0x13198A2E03707344)  # the token after it
_STEP = np.uint64(0x9E3779B97F4A7C15)

BLOB = "level int, shard int, size long, words binary, counts binary"


def stream(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The token hashes of all texts, an end after each, and where each text begins."""
    tok = T.tokens(texts)
    n, d = len(tok.hash), len(texts)
    out = np.empty(n + d, np.uint64)
    first = tok.first + np.arange(d + 1)
    out[np.arange(n) + tok.text_of()] = tok.hash
    out[first[1:] - 1] = _END
    return out, first


def grams(words: np.ndarray, first: np.ndarray, order: int) -> list[np.ndarray]:
    """The ``order`` columns of all n-grams; a text begins after start marks."""
    columns = [words]
    place = np.arange(len(words)) - np.repeat(first[:-1], np.diff(first))
    for back in range(1, order):
        shifted = np.full(len(words), _START)
        shifted[back:] = words[: len(words) - back]
        shifted[place < back] = _START
        columns.append(shifted)
    return columns[::-1]


def context_hash(columns: list[np.ndarray]) -> np.ndarray:
    h = np.full(len(columns[0]) if columns else 0, np.uint64(len(columns)))
    for c in columns:
        h = T.mix(h * _STEP + c)
    return h


def keys(columns: list[np.ndarray], shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The context's hash and the n-gram's key, which begins with the shard's bits of its context."""
    word = columns[-1]
    if len(columns) == 1:
        return np.zeros(len(word), np.uint64), word
    context = context_hash(columns[:-1])
    key = T.mix(context * _STEP + word)
    bits = np.uint64(shards.bit_length() - 1)
    if bits:
        low = np.uint64(64) - bits
        key = key & ((np.uint64(1) << low) - np.uint64(1)) | context >> low << low
    return context, key


def _shard_of(key: np.ndarray, shards: int) -> np.ndarray:
    bits = shards.bit_length() - 1
    return (key >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(key), np.int64)


def _blobs(level: int, columns: list[np.ndarray], counts: np.ndarray, shards: int):
    """Rows of ``BLOB`` for n-grams that are all different; level 0 holds plain word counts."""
    context, key = keys(columns, shards)
    order = np.lexsort((key, context)) if len(columns) > 1 else np.argsort(key)
    shard = _shard_of(key[order], shards)
    cut = np.flatnonzero(np.r_[True, shard[1:] != shard[:-1], True]) if len(shard) else [0]
    pack = zstandard.ZstdCompressor(level=1).compress
    columns, counts = [c[order] for c in columns], counts[order].astype(np.uint32)
    rows = [
        (level, int(shard[a]), b - a, pack(b"".join(c[a:b].tobytes() for c in columns)), pack(counts[a:b].tobytes()))
        for a, b in zip(cut[:-1], cut[1:])
    ]
    kinds = [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary()]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], ["level", "shard", "size", "words", "counts"])


def _distinct(columns: list[np.ndarray], counts: np.ndarray | None) -> tuple[list[np.ndarray], np.ndarray]:
    """Different n-grams, with the sum of their counts (how many there are, if none are given)."""
    _, at, back, many = np.unique(keys(columns, 1)[1], return_index=True, return_inverse=True, return_counts=True)
    total = many if counts is None else np.bincount(back, counts, len(at)).astype(np.int64)
    return [c[at] for c in columns], total


def _read(batch: pa.RecordBatch, row: int, width: int) -> tuple[list[np.ndarray], np.ndarray]:
    size = batch.column(2)[row].as_py()
    unpack = zstandard.ZstdDecompressor().decompress
    words = np.frombuffer(unpack(batch.column(3)[row].as_py()), np.uint64)
    return [words[j * size : (j + 1) * size] for j in range(width)], np.frombuffer(unpack(batch.column(4)[row].as_py()), np.uint32)


def _save(folder: str, name: str, array: np.ndarray) -> None:
    """Writes under another name first: a repeated task replaces its file as a whole."""
    own = f"{folder}/.{name}-{uuid.uuid4().hex}"
    with open(own, "wb") as f:
        np.save(f, array)
    os.replace(own, f"{folder}/{name}.npy")


def _reduce(folder: str, width: dict[int, int], shards: int):
    """A function over sorted ``BLOB`` rows that writes each shard's arrays.

    It gives continuation counts as ``BLOB`` rows, and in rows of level -1 - level the number
    of n-grams seen 1, 2, 3 and 4 times, of all n-grams, and the sum of their counts.
    """

    def finish(level: int, shard: int, parts: list):
        columns, counts = _distinct(
            [np.concatenate(c) for c in zip(*(p[0] for p in parts))], np.concatenate([p[1] for p in parts]))
        context, key = keys(columns, shards)
        order = np.argsort(key)
        _save(folder, f"{level}-{shard}-keys", key[order])
        _save(folder, f"{level}-{shard}-counts", counts[order].astype(np.uint32))
        if width[level] > 1:
            own, back = np.unique(context, return_inverse=True)
            _save(folder, f"{level}-{shard}-contexts", own)
            stats = [np.bincount(back, counts, len(own))]
            stats += [np.bincount(back[counts == k], minlength=len(own)) for k in (1, 2)]
            stats.append(np.bincount(back[counts >= 3], minlength=len(own)))
            _save(folder, f"{level}-{shard}-stats", np.stack(stats, 1).astype(np.float64))
            yield from _blobs(level - 1, *_distinct(columns[1:], None), shards)
        seen = [int((counts == k).sum()) for k in (1, 2, 3, 4)] + [len(counts), int(counts.sum())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([-1 - level], pa.int32()), pa.array([shard], pa.int32()), pa.array([0], pa.int64()),
             pa.array([b""], pa.binary()), pa.array([np.array(seen, np.int64).tobytes()], pa.binary())],
            ["level", "shard", "size", "words", "counts"])

    def run(batches):
        os.makedirs(folder, exist_ok=True)
        now, parts = None, []
        for batch in batches:
            names = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()))
            for row, name in enumerate(names):
                if name != now and parts:
                    yield from finish(*now, parts)
                    parts = []
                now = name
                parts.append(_read(batch, row, width[name[0]]))
        if parts:
            yield from finish(*now, parts)

    return run


@dataclass
class Model:
    """Where the arrays are, and what is known of each level: level 0 counts words, level n has n-grams."""

    folder: str
    order: int
    shards: int
    seen: dict[int, list[int]]

    @property
    def train_tokens(self) -> int:
        return self.seen[0][5]

    @property
    def vocabulary(self) -> int:
        return self.seen[0][4]

    def discounts(self, level: int) -> np.ndarray:
        """Discounts of counts 0, 1, 2 and 3 or more (Chen and Goodman)."""
        n1, n2, n3, n4 = self.seen[level][:4]
        y = n1 / max(n1 + 2 * n2, 1)
        raw = [k - (k + 1) * y * b / a if a else k * 0.5 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
        return np.array([0.0, *(min(max(d, 0.05), k - 0.05) for d, k in zip(raw, (1, 2, 3)))])


class Lookup:
    """A worker's view of the arrays, mapped into memory shard by shard on first use."""

    def __init__(self, model: Model):
        self.model, self.open = model, {}

    def _array(self, level: int, shard: int, what: str) -> np.ndarray:
        name = f"{level}-{shard}-{what}"
        if name not in self.open:
            path = f"{self.model.folder}/{name}.npy"
            try:
                self.open[name] = np.load(path, mmap_mode="r")
            except FileNotFoundError:  # a shard that got no n-gram
                self.open[name] = np.zeros((0, 4) if what == "stats" else 0, np.uint64 if what != "stats" else np.float64)
            except ValueError:
                self.open[name] = np.load(path)
        return self.open[name]

    def find(self, level: int, wanted: np.ndarray, by: str, value: str) -> np.ndarray:
        """The ``value`` rows at the sorted ``wanted`` entries of array ``by``; zero where there is none."""
        bounds = np.searchsorted(_shard_of(wanted, self.model.shards), np.arange(self.model.shards + 1))
        out = np.zeros((len(wanted), 4) if value == "stats" else len(wanted))
        for shard in np.flatnonzero(np.diff(bounds)).tolist():
            a, b = bounds[shard], bounds[shard + 1]
            have = self._array(level, shard, by)
            if not len(have):
                continue
            at = np.minimum(np.searchsorted(have, wanted[a:b]), len(have) - 1)
            hit = have[at] == wanted[a:b]
            out[a:b][hit] = self._array(level, shard, value)[at[hit]]
        return out

    def probabilities(self, words: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each token its count in training and the model's probability."""
        m = self.model
        own, back = np.unique(words, return_inverse=True)
        counts = self.find(0, own, "keys", "counts")[back]
        total, seen = max(m.seen[1][5], 1), m.seen[1]
        d = m.discounts(1)
        mass = (d[1] * seen[0] + d[2] * seen[1] + d[3] * (seen[4] - seen[0] - seen[1])) / total if seen[4] else 1.0
        continued = self.find(1, own, "keys", "counts")
        p = (np.maximum(continued - d[np.minimum(continued, 3).astype(int)], 0) / total + mass / (m.vocabulary + 1))[back]
        columns = grams(words, first, m.order)
        for level in range(2, m.order + 1):
            context, key = keys(columns[m.order - level :], m.shards)
            d = m.discounts(level)
            own, back = np.unique(key, return_inverse=True)
            c = self.find(level, own, "keys", "counts")[back]
            own, back = np.unique(context, return_inverse=True)
            stats = self.find(level, own, "contexts", "stats")
            whole = np.maximum(stats[:, 0], 1)
            left = ((stats[:, 1:] * d[1:]).sum(1) / whole)[back]
            met = (stats[:, 0] > 0)[back]
            p = np.where(met, np.maximum(c - d[np.minimum(c, 3).astype(int)], 0) / whole[back] + left * p, p)
        return counts, p


def model_folder(spark: SparkSession) -> str:
    """A new folder for arrays, in the shared folder, which must be mounted on every worker."""
    url = urlparse(checkpoint_dir(spark))
    if url.scheme not in ("", "file"):
        raise ValueError("arrays are mapped into memory: spark.checkpoint.dir must be a folder mounted on all workers")
    return f"{unquote(url.path).rstrip('/')}/kneser-ney-{uuid.uuid4().hex}"


def train(docs: DataFrame, learn: Column, order: int = ORDER) -> Model:
    """A model of all ``docs(doc_id, text)`` that ``learn`` allows; null texts are empty. Runs jobs."""
    texts = docs.where(learn).select("text")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = 1 << max(0, math.ceil(math.log2(max(size / SHARD_BYTES, 1))))
    folder = model_folder(docs.sparkSession)
    os.makedirs(folder, exist_ok=True)

    def count(batches):
        held, tokens = [], 0

        def flush():
            words = np.concatenate([w for w, _ in held])
            first = np.concatenate([[0], np.cumsum(np.concatenate([np.diff(f) for _, f in held]))])
            yield from _blobs(0, *_distinct([words], None), shards)
            yield from _blobs(order, *_distinct(grams(words, first, order), None), shards)

        for part in T.chunks(batches):
            held.append(stream(part.column(0)))
            tokens += len(held[-1][0])
            if tokens >= PART:
                yield from flush()
                held, tokens = [], 0
        if held:
            yield from flush()

    def reduced(blobs: DataFrame, width: dict[int, int]) -> DataFrame:
        dealt = blobs.repartition(max(shards, 8), "level", "shard").sortWithinPartitions("level", "shard")
        return stage(dealt.mapInArrow(_reduce(folder, width, shards), BLOB), "counts")

    # Level 0 keeps plain counts of words, so that level 1 can hold continuation counts.
    found = reduced(texts.mapInArrow(count, BLOB), {0: 1, order: order})
    seen = {level: np.zeros(6, np.int64) for level in range(order + 1)}

    def note(df: DataFrame):
        for r in df.where("level < 0").select("level", "counts").collect():  # one row a shard
            seen[-1 - r.level] += np.frombuffer(bytes(r.counts), np.int64)

    note(found)
    for level in range(order - 1, 0, -1):
        found = reduced(found.where(F.col("level") == level), {level: level})
        note(found)
    return Model(folder, order, shards, {k: v.tolist() for k, v in seen.items()})


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, n_tokens, n_known, base_score, score`` for each row of ``docs(doc_id, text)``.

    Scores are log10 probabilities of the whole text and its end: ``score`` by the model,
    ``base_score`` by single words with one half added to each count. Null texts are empty.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        lookup = Lookup(shared.value)
        n, v = shared.value.train_tokens, shared.value.vocabulary
        held, tokens = [], 0

        def flush():
            words = np.concatenate([w for _, w, _ in held])
            sizes = np.concatenate([np.diff(f) for _, _, f in held])
            first = np.concatenate([[0], np.cumsum(sizes)])
            counts, p = lookup.probabilities(words, first)
            base = np.log10((counts + 0.5) / (n + 0.5 * (v + 1)))
            columns = [
                pa.concat_arrays([i for i, _, _ in held]), sizes, T.sums((counts > 0).astype(np.int64), first),
                T.sums(base, first), T.sums(np.log10(p), first)]
            names = ["doc_id", "n_tokens", "n_known", "base_score", "score"]
            return pa.RecordBatch.from_arrays([pa.array(c) if isinstance(c, np.ndarray) else c for c in columns], names)

        for part in T.chunks(batches):
            held.append((part.column(0), *stream(part.column(1))))
            tokens += len(held[-1][1])
            if tokens >= PART:
                yield flush()
                held, tokens = [], 0
        if held:
            yield flush()

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")
