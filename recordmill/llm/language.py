"""Language ID by mixture inference.

Each language has a likelihood for the byte trigrams of a word, counted over all training
documents. A document is a mixture: every word comes from one language, and
expectation-maximisation estimates the languages' proportions. The set of languages grows by
proportion while the likelihood gains more than the penalty for one more language. Counting
is a map with sums per task; scoring is a map over whole texts.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame

from recordmill.llm import tokens as T

BITS = 16  # buckets of trigrams
STEPS = 6  # of expectation-maximisation
PENALTY = 2.0  # times half the logarithm of the number of words, for each further language
UNKNOWN = "und"

LETTERS = T.PLAIN_WORDS.copy()
LETTERS[48:58] = 0

RESULT = "lang_pred string, score double, languages array<string>, proportions array<double>"


def trigrams(texts: pa.Array) -> tuple[T.Tokens, np.ndarray]:
    """Words of letters, and for each byte the bucket of the trigram around it (a blank at word edges)."""
    tok = T.tokens(texts, LETTERS)
    data = np.where(LETTERS[tok.data] > 0, tok.data, 32).astype(np.uint32)
    padded = np.concatenate([[32], data, [32]]).astype(np.uint32)
    before, after = padded[:-2].copy(), padded[2:].copy()
    before[tok.start] = 32
    after[tok.end - 1] = 32
    gram = before << np.uint32(16) | data << np.uint32(8) | after
    return tok, (gram * np.uint32(2654435761)) >> np.uint32(32 - BITS)


def train(docs: DataFrame, learn: Column) -> tuple[list[str], np.ndarray]:
    """The languages, and the log probability of each bucket (rows) in each of them.

    Counts all ``docs(text, lang)`` that ``learn`` allows and whose ``lang`` is not null.
    """
    size = 1 << BITS

    def rows(sums: dict):
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(sums), pa.string()), pa.array([s.tobytes() for s in sums.values()], pa.binary())], ["lang", "counts"])

    def count(batches):
        sums: dict[str, np.ndarray] = {}
        for part in T.chunks(batches):
            tok, gram = trigrams(part.column(0))
            edge = np.zeros(len(gram) + 1, np.int64)
            np.add.at(edge, tok.start, 1)
            np.add.at(edge, tok.end, -1)
            inside = np.cumsum(edge[:-1]) > 0
            langs, offsets = part.column(1).to_pylist(), T.text_bytes(part.column(0))[1]
            for lang in set(langs):
                own = np.repeat(np.array([x == lang for x in langs]), np.diff(offsets)) & inside
                sums[lang] = sums.get(lang, np.zeros(size, np.int64)) + np.bincount(gram[own], minlength=size)
        yield from rows(sums)

    def add(batches):
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, counts in zip(*(c.to_pylist() for c in batch.columns)):
                sums[lang] = sums.get(lang, np.zeros(size, np.int64)) + np.frombuffer(counts, np.int64)
        yield from rows(sums)

    schema = "lang string, counts binary"
    usable = docs.where(learn & docs.lang.isNotNull()).select("text", "lang")
    total: dict[str, np.ndarray] = {}
    for r in usable.mapInArrow(count, schema).repartition(8).mapInArrow(add, schema).collect():
        total[r.lang] = total.get(r.lang, 0) + np.frombuffer(bytes(r.counts), np.int64)
    langs = sorted(total)
    counts = np.stack([total[k] for k in langs], 1) if langs else np.zeros((size, 0))
    return langs, np.log((counts + 0.1) / (counts.sum(0) + 0.1 * size)).astype(np.float32)


def mixture(likelihood: np.ndarray, first: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions of the ``allowed`` languages in each text, and the log likelihood, by EM.

    ``likelihood`` has a row a word, scaled so that its largest entry is one.
    """
    counts = np.diff(first)
    text = np.repeat(np.arange(len(counts)), counts)
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(STEPS):
        part = likelihood * share[text]
        part /= np.maximum(part.sum(1, keepdims=True), 1e-30)
        share = (T.sums(part, first) / np.maximum(counts, 1)[:, None]).astype(np.float32)
    seen = np.log(np.maximum((likelihood * share[text]).sum(1, dtype=np.float64), 1e-30))
    return share, T.sums(seen, first)


def infer(texts: pa.Array, langs: list[str], table: np.ndarray) -> list[tuple]:
    """``RESULT`` for each text."""
    tok, gram = trigrams(texts)
    n = len(langs)
    sums = np.zeros((len(gram) + 1, n))
    np.cumsum(table[gram], axis=0, out=sums[1:])
    word = sums[tok.end] - sums[tok.start]
    likelihood = np.exp(word - word.max(1, keepdims=True)).astype(np.float32) if n and len(word) else np.zeros((len(word), n), np.float32)
    first, counts = tok.first, tok.counts
    result: list[tuple] = [(UNKNOWN, 0.0, [], [])] * len(texts)
    if not n:
        return result
    known = counts > 0
    for i in np.flatnonzero(known):  # bytes beyond ASCII may be no letters
        own = tok.data[tok.start[first[i]] : tok.end[first[i + 1] - 1]]
        if not ((own >= 97) & (own <= 122)).any():
            known[i] = any(c.isalpha() for c in (texts[int(i)].as_py() or ""))
    every = np.ones((len(texts), n), np.float32)
    share, _ = mixture(likelihood, first, every)
    rank = np.argsort(-share, axis=1, kind="stable")
    best = np.zeros_like(share)
    best[np.arange(len(texts)), rank[:, 0]] = 1
    one, best_value = mixture(likelihood, first, best)
    best = one
    open_ = np.flatnonzero(known & (share[np.arange(len(texts)), rank[:, 1]] > 0) if n > 1 else np.zeros(len(texts), bool))
    for k in range(2, n + 1):
        if not len(open_):
            break
        allowed = np.zeros((len(open_), n), np.float32)
        np.put_along_axis(allowed, rank[open_, :k], 1, 1)
        own = np.concatenate([np.arange(first[i], first[i + 1]) for i in open_])
        sub = np.concatenate([[0], np.cumsum(counts[open_])])
        wider, value = mixture(likelihood[own], sub, allowed)
        value = value - (k - 1) * PENALTY * 0.5 * np.log(np.maximum(counts[open_], 2))
        gain = value > best_value[open_]
        best[open_[gain]] = wider[gain]
        best_value[open_[gain]] = value[gain]
        open_ = open_[gain]
    for i in np.flatnonzero(known):
        order = [j for j in np.argsort(-best[i], kind="stable") if best[i, j] > 0]
        result[i] = (langs[order[0]], float(min(best[i, order[0]], 1.0)), [langs[j] for j in order], [float(best[i, j]) for j in order])
    return result


def predict(docs: DataFrame, langs: list[str], table: np.ndarray) -> DataFrame:
    """``doc_id`` with ``lang_pred, score, languages, proportions`` for each row of ``docs(doc_id, text)``.

    ``lang_pred`` has the largest proportion, which is the score. A null text, or one without a
    letter, is ``und`` with score zero and no languages, as is any text if nothing was learned.
    """
    shared = docs.sparkSession.sparkContext.broadcast((langs, table))

    def run(batches):
        for part in T.chunks(batches):
            columns = list(zip(*infer(part.column(1), *shared.value)))
            kinds = [pa.string(), pa.float64(), pa.list_(pa.string()), pa.list_(pa.float64())]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), *(pa.array(list(c), k) for c, k in zip(columns, kinds))],
                ["doc_id", "lang_pred", "score", "languages", "proportions"])

    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, {RESULT}")
