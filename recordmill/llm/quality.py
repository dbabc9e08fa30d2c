"""Quality classifier: hashed word n-gram logistic regression, fitted by FTRL-proximal.

Features of a text: its words, pairs of words, and pairs of word shapes (capitals, digits,
runs of marks, a word that repeats the one before), each hashed into ``2**BITS`` buckets.
A feature's value is its share of the text's n-grams, so a score is a sparse dot product:
one gather and one sum per text. Learning reads a bounded labelled sample
(``max_train_rows``) in one task; scoring is a map over whole texts and moves no row.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm import tokens as T
from recordmill.llm.training import MAX_TRAIN_CHARS, fit_in_task, in_fixed_order, labelled_sample, sigmoid

BITS = 18
MAX_TRAIN_ROWS = 8_000
_SCALE = 32.0  # keeps a feature's share near 1, where the learning rates below work
_KINDS = (np.uint64(0x51), np.uint64(0x52), np.uint64(0x53))


def features(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """For each kind of n-gram: buckets, and where each text's buckets begin."""
    tok = T.tokens(texts, T.WORDS_AND_MARKS)
    raw = T.text_bytes(texts)[0]
    n = len(tok.hash)
    upper = lambda b: (b >= 65) & (b <= 90)
    head, tail = raw[tok.start] if n else raw[:0], raw[tok.end - 1] if n else raw[:0]
    size = np.minimum(tok.end - tok.start, 24) // 8
    shape = np.where(tok.kind == 2, tok.hash, (
        upper(head) + 2 * upper(tail) + 4 * ((tail >= 48) & (tail <= 57)) + 8 * size
    ).astype(np.uint64))
    same = np.zeros(n, dtype=bool)
    same[1:] = tok.hash[1:] == tok.hash[:-1]
    shape = np.where(same & (tok.kind == 1), np.uint64(99), shape)
    shapes = T.Tokens(tok.data, T.mix(shape), tok.start, tok.end, tok.first, tok.kind)
    out, first = [], []
    for kind, (source, length) in zip(_KINDS, ((tok, 1), (tok, 2), (shapes, 2))):
        h, at = T.ngrams(source, length)
        out.append((T.mix(h ^ kind) >> np.uint64(64 - BITS)).astype(np.int64))
        first.append(np.searchsorted(at, tok.first))
    return out, first


def fit(buckets: list[np.ndarray], values: list[np.ndarray], labels: np.ndarray, epochs: int = 3,
        alpha: float = 0.1, beta: float = 0.1, l1: float = 0.05, l2: float = 0.1) -> np.ndarray:
    """Weights, the bias last, after FTRL-proximal updates in the given order."""
    size = (1 << BITS) + 1
    z, n = np.zeros(size), np.zeros(size)

    def weights(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((beta + np.sqrt(n[i])) / alpha + l2))

    for _ in range(epochs):
        for i, x, y in zip(buckets, values, labels):
            w = weights(i)
            g = (sigmoid(w @ x) - y) * x
            step = (np.sqrt(n[i] + g * g) - np.sqrt(n[i])) / alpha
            z[i] += g - step * w
            n[i] += g * g
    return weights(np.arange(size))


def rows_of(texts: pa.Array) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Each text's buckets and values, with the bias."""
    buckets, first = features(texts)
    all_i, all_x = [], []
    for t in range(len(texts)):
        at, x = [np.array([1 << BITS])], [np.ones(1)]
        for b, f in zip(buckets, first):
            own, count = np.unique(b[f[t] : f[t + 1]], return_counts=True)
            at.append(own)
            x.append(count * (_SCALE / max(f[t + 1] - f[t], 1)))
        own, back = np.unique(np.concatenate(at), return_inverse=True)
        all_i.append(own)
        all_x.append(np.bincount(back, np.concatenate(x)))
    return all_i, all_x


def score_texts(texts: pa.Array, w: np.ndarray) -> np.ndarray:
    buckets, first = features(texts)
    total = np.full(len(texts), w[-1])
    for b, f in zip(buckets, first):
        total += T.sums(w[b], f) * (_SCALE / np.maximum(np.diff(f), 1))
    return sigmoid(total)


def train(docs: DataFrame, labels: DataFrame, learn: Column, max_train_rows: int = MAX_TRAIN_ROWS, max_train_chars: int = MAX_TRAIN_CHARS) -> np.ndarray:
    """Weights from the labelled documents that ``learn`` allows; all zero without any.

    ``labels(doc_id, quality)``: 1 is good, null or contradicting labels are not used,
    nor are texts over ``max_train_chars``; an id gives one training row.
    """

    def run(batches):
        ids, buckets, values, ys = [], [], [], []
        for part in T.chunks(batches):
            i, x = rows_of(part.column(1))
            buckets += [a.astype(np.int32) for a in i]
            values += [a.astype(np.float32) for a in x]
            ids += part.column(0).to_pylist()
            ys += part.column(2).to_pylist()
        order = in_fixed_order(ids, 4) if ids else []
        return fit([buckets[k] for k in order], [values[k] for k in order], np.array([float(ys[k] > 0) for k in order])).tobytes()

    sample = labelled_sample(docs, labels, "quality", learn, max_train_rows, max_chars=max_train_chars).select("doc_id", "text", "y")
    return np.frombuffer(fit_in_task(sample, run), np.float64)


def score_column(docs: DataFrame, w: np.ndarray, name: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` as a last column ``name`` (replacing a column of that name).

    Null and empty texts get the bias alone. Any other columns pass through as they are.
    """
    shared = docs.sparkSession.sparkContext.broadcast(w)
    rest = docs.drop(name)
    schema = rest.withColumn(name, F.lit(0.0)).schema

    def run(batches):
        for part in T.chunks(batches):
            scores = pa.array(score_texts(part.column(part.schema.get_field_index("text")), shared.value))
            yield pa.RecordBatch.from_arrays([*part.columns, scores], [*part.schema.names, name])

    return rest.mapInArrow(run, schema)
