"""Toxicity: a factorization machine over hashed terms.

Terms are words and word beginnings (``PREFIX`` bytes, which join inflected forms). The
score is a bias, a weight for each distinct term of the text, and an inner product of two
learned vectors for each pair of distinct terms, which finds pairs that are toxic only
together. Learning reads a bounded labelled sample (``max_train_rows``) in one task; only
terms of several sampled documents, and more tied to the label than chance allows, get
parameters. Scoring is a map over whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.llm import tokens as T
from recordmill.llm.training import MAX_TRAIN_CHARS, fit_in_task, in_fixed_order, labelled_sample, sigmoid

BITS = 20
FACTORS = 4
MAX_TRAIN_ROWS = 12_000
MIN_DOCS = 3
MIN_G2 = 8.0  # log-likelihood ratio of term and label; chance exceeds it for one term in 200
PREFIX = 5


def terms(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The distinct term buckets of each text, one text after another, and where each begins."""
    tok = T.tokens(texts, T.PLAIN_WORDS)
    prefix = np.full(len(tok.hash), 0x70, np.uint64)
    for j in range(PREFIX):
        at = tok.start + j
        within = at < tok.end
        prefix = prefix * np.uint64(257) + np.where(within, tok.data[np.where(within, at, 0)], 0).astype(np.uint64)
    own = tok.text_of().astype(np.uint64) << np.uint64(BITS)
    key = np.unique(np.concatenate([own | h >> np.uint64(64 - BITS) for h in (tok.hash, T.mix(prefix))]))
    first = np.searchsorted(key, np.arange(len(texts) + 1, dtype=np.uint64) << np.uint64(BITS))
    return (key & np.uint64((1 << BITS) - 1)).astype(np.int64), first


class Machine:
    """Parameters: bias, one weight and ``FACTORS`` factors for each of the ``kept`` buckets."""

    def __init__(self, kept: np.ndarray, params: np.ndarray):
        self.kept, self.params = kept, params
        self.slot = np.zeros(1 << BITS, np.int32)
        self.slot[kept] = np.arange(1, len(kept) + 1)

    def to_bytes(self) -> bytes:
        return np.int64(len(self.kept)).tobytes() + self.kept.astype(np.int64).tobytes() + self.params.tobytes()

    @classmethod
    def from_bytes(cls, data: bytes) -> Machine:
        n = int(np.frombuffer(data, np.int64, 1)[0])
        kept = np.frombuffer(data, np.int64, n, 8)
        return cls(kept, np.frombuffer(data, np.float64, -1, 8 + 8 * n).reshape(n + 1, 1 + FACTORS))

    def score(self, texts: pa.Array) -> np.ndarray:
        buckets, first = terms(texts)
        slot = self.slot[buckets]
        p = self.params[slot] * (slot > 0)[:, None]  # row 0 holds the bias
        linear = T.sums(p[:, 0], first)
        s, q = T.sums(p[:, 1:], first), T.sums(p[:, 1:] ** 2, first)
        return sigmoid(self.params[0, 0] + linear + 0.5 * (s * s - q).sum(1))


def _tied_to_label(docs: list[np.ndarray], labels: np.ndarray) -> np.ndarray:
    """Buckets of at least ``MIN_DOCS`` documents whose likelihood ratio reaches ``MIN_G2``."""
    every = [np.zeros(0, np.int64)]
    held = np.bincount(np.concatenate([*every, *docs]), minlength=1 << BITS)
    toxic = np.bincount(np.concatenate([*every, *(d for d, y in zip(docs, labels) if y)]), minlength=1 << BITS)
    n, positives = max(len(labels), 1), labels.sum()

    def part(seen, row, column):
        expected = row * column / n
        return np.where(seen > 0, seen * np.log(np.maximum(seen, 1e-9) / np.maximum(expected, 1e-9)), 0.0)

    g2 = 2 * (
        part(toxic, held, positives) + part(held - toxic, held, n - positives)
        + part(positives - toxic, n - held, positives) + part(n - positives - held + toxic, n - held, n - positives)
    )
    return np.flatnonzero((held >= MIN_DOCS) & (g2 >= MIN_G2))


def fit(docs: list[np.ndarray], labels: np.ndarray, epochs: int = 4, rate: float = 0.1, l1: float = 1.0,
        l2: float = 2e-3, seed: int = 11) -> Machine:
    """A machine fitted by AdaGrad on the logistic loss, in the given order.

    Weights shrink towards zero in proportion to ``l1`` over the square root of the updates
    (as FTRL does), factors by ``l2``.
    """
    kept = _tied_to_label(docs, labels)
    slot = np.full(1 << BITS, -1)
    slot[kept] = np.arange(len(kept))
    docs = [s[s >= 0] for s in (slot[d] for d in docs)]
    n = len(kept)
    z, nn = np.zeros(n), np.zeros(n)
    v = np.random.default_rng(seed).normal(0, 0.01, (n, FACTORS))
    gv = np.full((n, FACTORS), 1e-2)
    bias, gb = 0.0, 1e-2

    def weights(i):
        return np.where(np.abs(z[i]) <= l1, 0.0, -(z[i] - np.sign(z[i]) * l1) / ((0.1 + np.sqrt(nn[i])) / rate))

    for _ in range(epochs):
        for i, y in zip(docs, labels):
            w, vi = weights(i), v[i]
            s = vi.sum(0)
            g = sigmoid(bias + w.sum() + 0.5 * (s @ s - (vi * vi).sum())) - y
            gb += g * g
            bias -= rate * g / np.sqrt(gb)
            step = (np.sqrt(nn[i] + g * g) - np.sqrt(nn[i])) / rate
            z[i] += g - step * w
            nn[i] += g * g
            if abs(g) > 1e-3:
                grad = g * (s - vi) + l2 * vi
                gv[i] += grad * grad
                v[i] = vi - 0.5 * rate * grad / np.sqrt(gv[i])
    params = np.zeros((n + 1, 1 + FACTORS))
    params[0, 0] = bias
    params[1:, 0] = weights(np.arange(n))
    params[1:, 1:] = v
    return Machine(kept, params)


def train(docs: DataFrame, labels: DataFrame, learn: Column, max_train_rows: int = MAX_TRAIN_ROWS, max_train_chars: int = MAX_TRAIN_CHARS) -> Machine:
    """A machine from the labelled documents that ``learn`` allows.

    ``labels(doc_id, toxic)``: 1 is toxic, null or contradicting labels are not used,
    nor are texts over ``max_train_chars``; an id gives one training row.
    Without any usable row every score is one half.
    """

    def run(batches):
        ids, found, ys = [], [], []
        for part in T.chunks(batches):
            buckets, first = terms(part.column(1))
            found += [buckets[a:b].astype(np.int32) for a, b in zip(first, first[1:])]
            ids += part.column(0).to_pylist()
            ys += part.column(2).to_pylist()
        order = in_fixed_order(ids, 8) if ids else []
        return fit([found[k] for k in order], np.array([float(ys[k] > 0) for k in order])).to_bytes()

    sample = labelled_sample(docs, labels, "toxic", learn, max_train_rows, max_chars=max_train_chars).select("doc_id", "text", "y")
    return Machine.from_bytes(fit_in_task(sample, run))


def score_column(docs: DataFrame, machine: Machine, name: str = "score") -> DataFrame:
    """``docs`` with the score of ``text`` as a last column ``name`` (replacing a column of that name).

    Null and empty texts get the bias alone. Any other columns pass through as they are.
    """
    data = docs.sparkSession.sparkContext.broadcast(machine.to_bytes())
    rest = docs.drop(name)
    schema = rest.withColumn(name, F.lit(0.0)).schema

    def run(batches):
        own = Machine.from_bytes(data.value)
        for part in T.chunks(batches):
            scores = pa.array(own.score(part.column(part.schema.get_field_index("text"))))
            yield pa.RecordBatch.from_arrays([*part.columns, scores], [*part.schema.names, name])

    return rest.mapInArrow(run, schema)
