"""Benchmark decontamination by spaced-seed hashing.

A seed hashes the tokens of a window that a fixed mask selects and ignores the others, so a
passage with substituted tokens still shares seeds with its source. Around each shared seed
the two texts are laid on one another and scored +1 for an equal token and -4 for another;
the best stretch is an overlap if it is long enough. If it is not, the longest window of at
least 80 % equal tokens is one under the same bound. Case and punctuation do not count.

A test set of at most ``BLOCK_BYTES`` is sent to the workers as one sorted index of seeds, and
documents are scanned once, whole and in place. Of a larger one nothing but a bit table of
fixed size leaves the workers: its seeds are a table, joined with those seeds of the
documents that the bits let through, and each document then meets its candidates in one
sorted stream. Both ways give the same rows.

No such window of ``MIN_TOKENS`` tokens is without a seed: it holds a run of four equal
tokens, or else a run of three that one changed token parts from two more. The same holds for
items of ``MIN_ITEM`` tokens; shorter ones must be equal as a whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm import tokens as T
from recordmill.staging import stage

#: Selected (1) and ignored (0) positions of a window.
MASKS = ("111101111", "1111", "111011")
SHORT_MASK = "111"  # finds items of three tokens
MIN_TOKENS = 13  # of an overlap; shorter items must be covered whole
MIN_ITEM = 9  # tokens; shorter items must be equal as a whole
SHORTEST = 3  # tokens; shorter items contaminate nothing
MISMATCH = 4  # a stretch gains over 80 % equal tokens only
BLOCK_BYTES = 8 << 20  # test-set text that is sent to all workers; seeds of more are joined
FILTER_BITS = 26  # the bit table of a joined test set has two to this power
SLICE = 1 << 20  # seed hits that are expanded at a time

RESULT = (
    "doc_id long, item_id long, n_tokens int, n_equal int, similarity double, "
    "doc_start int, doc_end int, item_start int, item_end int, n_items long"
)


def seeds(tok: T.Tokens, mask: str) -> tuple[np.ndarray, np.ndarray]:
    """Seed hashes of all windows within a text, and the index of each window's first token."""
    span, total = len(mask), len(tok.hash)
    if total < span:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    count = total - span + 1
    h = np.full(count, np.uint64(int(mask, 2)))
    for j in (j for j, bit in enumerate(mask) if bit == "1"):
        h = h * np.uint64(0x9E3779B97F4A7C15) + tok.hash[j : j + count]
    text = tok.text_of()
    own = np.flatnonzero(text[:count] == text[span - 1 :])
    return T.mix(h[own]), own


def item_seeds(tok: T.Tokens) -> tuple[np.ndarray, np.ndarray]:
    """Seeds under all masks as ``seeds`` gives them; only items of ``SHORTEST`` tokens have the short one."""
    found = [seeds(tok, mask) for mask in MASKS]
    h, own = seeds(tok, SHORT_MASK)
    short = tok.counts[tok.text_of()[own]] == SHORTEST
    found.append((h[short], own[short]))
    return np.concatenate([x for x, _ in found]), np.concatenate([x for _, x in found])


@dataclass
class Index:
    """Seeds of some items, sorted by hash, with the items' token hashes."""

    hash: np.ndarray
    at: np.ndarray  # token index of the window's first token
    tokens: np.ndarray
    first: np.ndarray
    item_of: np.ndarray  # item number of each token
    ids: list
    copies: list  # items that have each one's tokens

    @classmethod
    def of(cls, ids: list, texts: list, copies: list | None = None) -> Index:
        """Items of equal tokens count once, under their smallest id."""
        tok = T.tokens(pa.array(texts, pa.string()), T.PLAIN_WORDS)
        seen: dict[bytes, int] = {}
        for i in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0)):
            part = tok.hash[tok.first[i] : tok.first[i + 1]]
            if len(part) >= SHORTEST:
                seen.setdefault(part.tobytes(), i)
        kept = sorted(seen.values())
        tok = T.tokens(pa.array([texts[i] for i in kept], pa.string()), T.PLAIN_WORDS)
        h, at = item_seeds(tok)
        order = np.argsort(h, kind="stable")
        return cls(h[order], at[order], tok.hash, tok.first, tok.text_of(), [ids[i] for i in kept], [copies[i] if copies else 1 for i in kept])


def stretch(equal: np.ndarray) -> tuple[int, int]:
    """Bounds of the best-scoring stretch."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    low = np.minimum.accumulate(score)
    end = int(np.argmax(score - low))
    start = int(np.flatnonzero(score[: end + 1] == low[end])[-1])
    return start, end


def window(equal: np.ndarray) -> tuple[int, int]:
    """Bounds of the longest window of at least ``MISMATCH`` equal tokens for each other one."""
    score = np.concatenate([[0], np.cumsum(np.where(equal, 1, -MISMATCH))])
    low = np.minimum.accumulate(score)
    start = np.searchsorted(-low, -score)  # the first prefix that scores no more
    end = int(np.argmax(np.arange(len(score)) - start))
    return int(start[end]), end


def overlap(equal: np.ndarray, size: int) -> tuple[int, int] | None:
    """Bounds of the overlap with an item of ``size`` tokens on one diagonal, if there is one."""
    if size < MIN_ITEM:
        return (0, size) if len(equal) == size and equal.all() else None
    least = min(MIN_TOKENS, size)
    for a, b in (stretch(equal), window(equal)):
        if b - a >= least:
            return a, b
    return None


def _equal_counts(words: np.ndarray, at: np.ndarray, other: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Equal tokens of ``words`` from ``at`` and ``other`` from ``first``, over ``size`` tokens, for each row."""
    out = np.zeros(len(at), np.int64)
    for a, b in _slices(size):
        n = size[a:b]
        within = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        same = words[np.repeat(at[a:b], n) + within] == other[np.repeat(first[a:b], n) + within]
        out[a:b] = np.add.reduceat(same, np.cumsum(n) - n, dtype=np.int64)
    return out


def _promising(words, at, count, other, first, length, shift) -> np.ndarray:
    """Whether a diagonal has as many equal tokens as the shortest overlap needs.

    Each row lays ``length`` tokens of ``other`` from ``first`` on ``count`` ones of ``words`` from ``at``.
    """
    start = np.maximum(0, -shift)
    size = np.minimum(length, count - shift) - start
    equal = _equal_counts(words, at + start + shift, other, first + start, size)
    least = np.minimum(MIN_TOKENS, length)
    return np.where(least < MIN_ITEM, equal == length, equal * (MISMATCH + 1) >= least * MISMATCH)


def _on_diagonal(words: np.ndarray, other: np.ndarray, shift: int) -> tuple | None:
    """``n_equal, n_tokens, doc_start, doc_end, item_start, item_end`` of the overlap, if there is one."""
    low, high = max(0, -shift), min(len(other), len(words) - shift)
    equal = words[low + shift : high + shift] == other[low:high]
    bounds = overlap(equal, len(other))
    if bounds is None:
        return None
    a, b = bounds
    return int(equal[a:b].sum()), b - a, low + a + shift, low + b + shift, low + a, low + b


def matches(tok: T.Tokens, index: Index) -> Iterator[tuple]:
    """``(text, item, n_tokens, n_equal, doc_start, doc_end, item_start, item_end)``: the best overlap of each pair."""
    diagonals = []  # text, item and shift of all shared seeds
    text, lengths = tok.text_of(), np.diff(index.first)
    for mask in (*MASKS, SHORT_MASK):
        h, own = seeds(tok, mask)
        low = np.searchsorted(index.hash, h)
        hit = low < len(index.hash)
        hit[hit] = index.hash[low[hit]] == h[hit]
        own, low, h = own[hit], low[hit], h[hit]
        n = np.searchsorted(index.hash, h, side="right") - low
        for a, b in _slices(n):
            each = np.repeat(np.arange(a, b), n[a:b])
            within = np.arange(len(each)) - np.repeat(np.cumsum(n[a:b]) - n[a:b], n[a:b])
            at, pos = index.at[low[each] + within], own[each]
            item, doc = index.item_of[at], text[pos]
            shift = (pos - tok.first[doc]) - (at - index.first[item])
            hits = np.unique(np.stack([doc, item, shift], 1), axis=0)
            doc, item, shift = hits.T
            diagonals.append(hits[_promising(
                tok.hash, tok.first[doc], tok.counts[doc], index.tokens, index.first[item], lengths[item], shift)])
    if not diagonals:
        return
    best: dict[tuple[int, int], tuple] = {}
    for doc, item, shift in np.unique(np.concatenate(diagonals), axis=0).tolist():
        words = tok.hash[tok.first[doc] : tok.first[doc + 1]]
        other = index.tokens[index.first[item] : index.first[item + 1]]
        found = _on_diagonal(words, other, shift)
        if found and found[0] > best.get((doc, item), (0,))[0]:
            best[doc, item] = found
    for (doc, item), (n_equal, size, *bounds) in best.items():
        yield doc, item, size, n_equal, *bounds


def _slices(n: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of rows whose ``n`` sum up to ``SLICE``, or one row."""
    total, low = np.cumsum(n), 0
    while low < len(n):
        before = total[low - 1] if low else 0
        high = max(low + 1, int(np.searchsorted(total, before + SLICE, side="right")))
        yield low, high
        low = high


def _with_digest(benchmark: DataFrame) -> DataFrame:
    """``item_id, text, digest`` of the items of ``SHORTEST`` tokens or more; the digest is one of the tokens."""

    def run(batches):
        for part in T.chunks(batches):
            tok = T.tokens(part.column(1), T.PLAIN_WORDS)
            digests = [hashlib.sha256(tok.hash[a:b].tobytes()).digest() for a, b in zip(tok.first, tok.first[1:])]
            kept = pa.array(tok.counts >= SHORTEST)
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(digests, pa.binary())], ["item_id", "text", "digest"]).filter(kept)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where(F.col("text").isNotNull())
    return items.mapInArrow(run, "item_id long, text string, digest binary")


def item_classes(benchmark: DataFrame) -> DataFrame:
    """``item_id, class_id`` of each row of ``benchmark(item_id, text)`` that has a name and can contaminate.

    Items of equal tokens are one class, named by its smallest id; ``overlaps`` reports classes.
    """
    items = _with_digest(benchmark)
    classes = items.groupBy("digest").agg(F.min("item_id").alias("class_id"))
    return items.where("item_id is not null").join(classes, "digest").select("item_id", "class_id")


def _classes(benchmark: DataFrame) -> tuple[DataFrame, Index | None]:
    """``digest, class_id, text, copies`` of each class, and their index if they are small. Runs jobs."""
    classes = stage(
        _with_digest(benchmark).groupBy("digest").agg(F.min("item_id").alias("class_id"), F.min("text").alias("text"), F.count("*").alias("copies")),
        "item-classes")
    if (classes.agg(F.sum(F.octet_length("text"))).first()[0] or 0) > BLOCK_BYTES:
        return classes, None
    rows = classes.collect()
    return classes, Index.of([r.class_id for r in rows], [r.text for r in rows], [r.copies for r in rows])


def _class_seeds(classes: DataFrame) -> DataFrame:
    """``hash, digest, at`` of each seed of the classes; ``at`` counts an item's tokens."""

    def run(batches):
        for part in T.chunks(batches):
            tok = T.tokens(part.column(1), T.PLAIN_WORDS)
            h, own = item_seeds(tok)
            item = tok.text_of()[own]
            yield pa.RecordBatch.from_arrays(
                [pa.array(h.view(np.int64)), part.column(0).take(pa.array(item)), pa.array((own - tok.first[item]).astype(np.int32))],
                ["hash", "digest", "at"])

    return classes.select("digest", "text").mapInArrow(run, "hash long, digest binary, at int")


def _seed_filter(found: DataFrame) -> np.ndarray:
    """A bit for each first ``FILTER_BITS`` bits of a hash that occur in ``found``; of fixed size."""
    bucket = F.shiftrightunsigned("hash", 64 - FILTER_BITS)
    set_bits = found.groupBy(F.shiftright(bucket, 3).cast("int").alias("byte")).agg(
        *[F.max(bucket.bitwiseAND(F.lit(7)) == bit).alias(f"bit{bit}") for bit in range(8)]).toArrow()
    bits = np.zeros((1 << (FILTER_BITS - 3), 8), bool)
    for bit in range(8):
        bits[set_bits["byte"].to_numpy(), bit] = set_bits[f"bit{bit}"].to_numpy()
    return np.packbits(bits, axis=1, bitorder="little").ravel()


def _text_seeds(texts: DataFrame, bits) -> DataFrame:
    """``hash, key, pos`` of each seed of ``texts(key, text)`` whose bit in the broadcast ``bits`` is set."""

    def run(batches):
        for part in T.chunks(batches):
            tok = T.tokens(part.column(1), T.PLAIN_WORDS)
            text = tok.text_of()
            for mask in (*MASKS, SHORT_MASK):
                h, own = seeds(tok, mask)
                bucket = h >> np.uint64(64 - FILTER_BITS)
                kept = (bits.value[bucket >> np.uint64(3)] >> (bucket & np.uint64(7)).astype(np.uint8)) & 1 > 0
                h, own = h[kept], own[kept]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), part.column(0).take(pa.array(text[own])),
                     pa.array((own - tok.first[text[own]]).astype(np.int32))],
                    ["hash", "key", "pos"])

    return texts.mapInArrow(run, "hash long, key binary, pos int")


FOUND = "key binary, item_id long, n_tokens int, n_equal int, doc_start int, doc_end int, item_start int, item_end int, n_items long"


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The best overlap of each text and class, from each text followed by its candidates, by class and shift.

    Holds one text, one batch and one class's best; a document's candidates are never held together.
    """
    key = text = words = None  # of the present document; tokens once they are asked for
    current, best, rest = None, None, ()  # the present pair and its best overlap
    names = [f.split()[0] for f in FOUND.split(", ")]
    kinds = [pa.binary(), pa.int64(), *[pa.int32()] * 6, pa.int64()]

    def row():
        n_equal, size, *bounds = best
        return current[0], rest[0], size, n_equal, *bounds, rest[1]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    for batch in batches:
        rows = []
        keys, digests = batch.column("key").to_pylist(), batch.column("digest").to_pylist()
        low = 0
        while low < len(batch):
            if digests[low] is None:
                key, text, words, low = keys[low], batch.column("text")[low].as_py(), None, low + 1
                continue
            high = low + 1
            while high < len(batch) and keys[high] == key and digests[high] is not None and high - low < 1024:
                high += 1
            if words is None:
                words, text = T.tokens(pa.array([text], pa.string()), T.PLAIN_WORDS).hash, None
            part = batch.slice(low, high - low)
            other, offsets = T.text_bytes(part.column("text_tokens"))
            other, first, length = other.view("<u8"), offsets[:-1] // 8, np.diff(offsets) // 8
            shift = part.column("shift").to_numpy().astype(np.int64)
            zero = np.zeros(len(part), np.int64)
            for i in np.flatnonzero(_promising(words, zero, zero + len(words), other, first, length, shift)).tolist():
                if (key, digests[low + i]) != current:
                    if best:
                        rows.append(row())
                    current, best = (key, digests[low + i]), None
                    rest = part.column("class_id")[i].as_py(), part.column("copies")[i].as_py()
                found = _on_diagonal(words, other[first[i] : first[i] + length[i]], int(shift[i]))
                if found and (best is None or found[0] > best[0]):
                    best = found
            low = high
        if rows:
            yield batch_of(rows)
    if best:
        yield batch_of([row()])


def _joined(keyed: DataFrame, classes: DataFrame) -> DataFrame:
    """``FOUND`` rows of the different texts of ``keyed(key, text)``, by a join of seeds. Runs jobs."""

    def with_tokens(batches):
        for part in T.chunks(batches):
            tok = T.tokens(part.column(1), T.PLAIN_WORDS)
            held = [tok.hash[a:b].astype("<u8").tobytes() for a, b in zip(tok.first, tok.first[1:])]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), pa.array(held, pa.binary()), part.column(2), part.column(3)],
                ["digest", "text_tokens", "class_id", "copies"])

    found = stage(_class_seeds(classes), "item-seeds")
    bits = keyed.sparkSession.sparkContext.broadcast(_seed_filter(found))
    texts = stage(keyed.where(F.col("text").isNotNull()).dropDuplicates(["key"]), "texts")
    candidates = (
        _text_seeds(texts, bits).join(found, "hash")
        .select("key", "digest", (F.col("pos") - F.col("at")).alias("shift")).distinct()
    )
    items = classes.select("digest", "text", "class_id", "copies").mapInArrow(
        with_tokens, "digest binary, text_tokens binary, class_id long, copies long")
    stream = candidates.join(items, "digest").unionByName(texts, allowMissingColumns=True)
    # A text comes before its candidates: its digest is null.
    return (
        stream.repartition("key").sortWithinPartitions("key", F.col("digest").asc_nulls_first(), "shift")
        .select("key", "digest", "shift", "text_tokens", "class_id", "copies", "text").mapInArrow(_verified, FOUND)
    )


def _text_key() -> Column:
    """Names a text by 256 bits; null for a null text."""
    return F.unhex(F.sha2("text", 256))


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each ``docs(doc_id, text)`` row and ``benchmark(item_id, text)`` item that overlap.

    Token bounds are those of the longest overlap (by equal tokens). Null and empty texts, and
    items under ``SHORTEST`` tokens, overlap with nothing. Items of equal tokens, ``n_items`` of
    them, are one, under their smallest id, and ``item_classes`` lists them; the result is the
    same for any ``BLOCK_BYTES``. Repeated documents give repeated rows; a null ``doc_id`` stays null.
    """
    classes, index = _classes(benchmark)
    names = [f.split()[0] for f in RESULT.split(", ")]
    if index is None:
        keyed = docs.select("doc_id", "text").withColumn("key", _text_key())
        found = _joined(keyed.select("key", "text"), classes).withColumn("similarity", F.col("n_equal") / F.col("n_tokens"))
        return keyed.select(F.col("doc_id").cast("long").alias("doc_id"), "key").join(found, "key").select(*names)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for part in T.chunks(batches):
            ids = part.column(0).to_pylist()
            tok = T.tokens(part.column(1), T.PLAIN_WORDS)
            rows = [
                (ids[d], shared.value.ids[i], size, n, n / size, *bounds, shared.value.copies[i])
                for d, i, size, n, *bounds in matches(tok, shared.value)
            ]
            if rows:
                kinds = [pa.int64()] * 2 + [pa.int32()] * 2 + [pa.float64()] + [pa.int32()] * 4 + [pa.int64()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)

    return docs.select("doc_id", "text").mapInArrow(run, RESULT)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``text`` overlaps with no item; columns stay as they are."""
    classes, index = _classes(benchmark)
    if index is None:
        own = "_key"
        while own.lower() in (c.lower() for c in docs.columns):
            own = f"_{own}"
        found = _joined(docs.select(_text_key().alias("key"), "text"), classes).select(F.col("key").alias(own)).distinct()
        return docs.withColumn(own, _text_key()).join(found, own, "left_anti").select(*docs.columns)
    shared = docs.sparkSession.sparkContext.broadcast(index)

    def run(batches):
        for part in T.chunks(batches):
            tok = T.tokens(part.column(part.schema.get_field_index("text")), T.PLAIN_WORDS)
            clean = np.ones(len(part), bool)
            clean[list({m[0] for m in matches(tok, shared.value)})] = False
            yield part.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)
