"""Trained operators: parts by brute force, edge cases, and held-out accuracy."""

import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordmill.llm import kneser_ney as K
from recordmill.llm import language as L
from recordmill.llm import quality as Q
from recordmill.llm import queries
from recordmill.llm import toxicity as X
from recordmill.llm import tokens as T

TEXTS = ["Good words here, and more of them.", "", None, "a " * 30000, "## !! $$", "É ñ", "same same same", "\x00\t x"]


def documents(spark, texts=TEXTS):
    rows = [(None if i == 1 else i % 6, t, "en", 5.0, "x") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, score double, h string")


@pytest.mark.parametrize("operator, label", [(Q, "quality"), (X, "toxic")])
def test_scores_of_all_shapes_of_rows(spark, operator, label):
    docs = documents(spark)
    labels = spark.createDataFrame([(i, i % 2, "t") for i in range(6)] + [(3, None, "t"), (None, 1, "t")], f"doc_id long, {label} int, text string")
    for given in (labels, labels.limit(0)):
        model = operator.train(docs, given, F.lit(True))
        out = operator.score_column(docs, model)
        assert out.columns == ["doc_id", "text", "lang", "h", "score"]
        rows = out.collect()
        assert len(rows) == len(TEXTS) and all(0 <= r.score <= 1 for r in rows)
        assert len({r.score for r in rows if not r.text}) == 1
        assert operator.score_column(docs.limit(0), model).count() == 0


def test_quality_scores_are_sparse_dot_products():
    rng = np.random.default_rng(0)
    w = rng.normal(size=(1 << Q.BITS) + 1)
    texts = pa.array(TEXTS)
    index, values = Q.rows_of(texts)
    assert Q.score_texts(texts, w) == pytest.approx([1 / (1 + math.exp(-float(w[i] @ x))) for i, x in zip(index, values)])


def test_factorization_machine_by_definition():
    rng = np.random.default_rng(1)
    texts = pa.array([t and t[:2000] for t in TEXTS])
    buckets, first = X.terms(texts)
    kept = np.unique(buckets)[::2]
    m = X.Machine(kept, rng.normal(size=(len(kept) + 1, 1 + X.FACTORS)))
    place = {b: i + 1 for i, b in enumerate(kept.tolist())}
    want = []
    for a, b in zip(first, first[1:]):
        own = [place[x] for x in buckets[a:b].tolist() if x in place]
        total = m.params[0, 0] + sum(m.params[i, 0] for i in own)
        total += sum(m.params[i, 1:] @ m.params[j, 1:] for n, i in enumerate(own) for j in own[:n])
        want.append(1 / (1 + math.exp(-total)))
    assert X.Machine.from_bytes(m.to_bytes()).score(texts) == pytest.approx(want)


def test_a_pair_can_be_toxic_alone():
    """Either term alone is harmless, both together are not; the machine learns the pair."""
    rng = np.random.default_rng(2)
    docs, ys = [], []
    for i in range(600):
        a, b = i % 2, i // 2 % 2
        words = [f"w{int(x)}" for x in rng.integers(0, 50, 8)] + ["grue"] * a + ["folk"] * b
        docs.append(" ".join(words))
        ys.append(float(a and b))
    buckets, first = X.terms(pa.array(docs))
    m = X.fit([buckets[a:b] for a, b in zip(first, first[1:])], np.array(ys), epochs=12)
    scores = m.score(pa.array(["w1 w2 grue", "w1 w2 folk", "w1 grue folk"]))
    assert scores[2] > 0.5 > max(scores[:2])


def _auc(rows):
    pos = [s for y, s in rows if y]
    neg = [s for y, s in rows if not y]
    return sum((p > q) + 0.5 * (p == q) for p in pos for q in neg) / (len(pos) * len(neg))


DATA = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name, label, least", [("op4_quality_classifier", "quality", 0.99), ("op8_toxicity", "toxic", 0.85)])
def test_held_out_accuracy(spark, name, label, least):
    scored = queries.QUERIES[name](spark, DATA).where("held_out")
    rows = scored.join(spark.read.parquet(f"{DATA}/labels.parquet"), "doc_id").select(label, "score").collect()
    assert _auc(rows) >= least


def test_languages_held_out(spark):
    rows = queries.languages(spark, DATA).where("held_out").join(
        spark.read.parquet(f"{DATA}/documents.parquet").select("doc_id", "lang"), "doc_id").collect()
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)


def test_mixtures_and_undetermined_texts(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    langs, table = L.train(docs, F.lit(True))
    some = {r.lang: " ".join(r.text.split()[:60]) for r in docs.collect()}
    texts = [None, "", "12 !", "— …", some["en"] + " " + some["de"], some["es"], "x" * 100000]
    df = spark.createDataFrame([(i, t, "und") for i, t in enumerate(texts)], "doc_id int, text string, lang_pred string")
    got = {r.doc_id: r for r in L.predict(df, langs, table).collect()}
    assert [got[i].lang_pred for i in range(4)] == ["und"] * 4 and got[0].score == 0
    assert sorted(got[4].languages) == ["de", "en"] and abs(sum(got[4].proportions) - 1) < 1e-5
    assert got[5].languages == ["es"] and got[5].score == 1
    assert L.predict(df.limit(0), langs, table).count() == 0
    none = L.train(docs.limit(0), F.lit(True))
    assert {r.lang_pred for r in L.predict(df, *none).collect()} == {"und"}


def test_mixture_steps_raise_the_likelihood(monkeypatch):
    rng = np.random.default_rng(3)
    p = rng.random((50, 3)).astype(np.float32)
    first, allowed = np.array([0, 20, 20, 50]), np.ones((3, 3), np.float32)
    last = None
    for steps in range(6):
        monkeypatch.setattr(L, "STEPS", steps)
        share, value = L.mixture(p, first, allowed)
        assert last is None or (value >= last - 1e-4).all()
        last = value


def _model(spark, texts, order):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    return K.train(df, F.lit(True), order)


CORPUS = ["a b c a b", "a b d", "b c a b c", "", None, "A B", "d d d d", "c a", "e f g a b c", "f g a b d a"]


def test_counts_by_definition(spark):
    model = _model(spark, CORPUS, 2)
    tokens = [w for t in CORPUS for w in [*(t or "").lower().split(), "</s>"]]
    assert (model.train_tokens, model.vocabulary) == (len(tokens), len(set(tokens)))
    pairs = Counter()
    for t in CORPUS:
        own = ["<s>", *(t or "").lower().split(), "</s>"]
        pairs.update(zip(own, own[1:]))
    assert model.seen[2] == [sum(c == k for c in pairs.values()) for k in (1, 2, 3, 4)] + [len(pairs), sum(pairs.values())]
    follow = Counter(b for _, b in pairs)
    assert model.seen[1] == [sum(c == k for c in follow.values()) for k in (1, 2, 3, 4)] + [len(follow), len(pairs)]


@pytest.mark.parametrize("order, shard", [(2, 16 << 20), (3, 16 << 20), (2, 8)])
def test_probabilities_sum_to_one(spark, monkeypatch, order, shard):
    monkeypatch.setattr(K, "SHARD_BYTES", shard)
    lookup = K.Lookup(_model(spark, CORPUS, order))
    vocabulary = sorted({w for t in CORPUS for w in (t or "").lower().split()})
    for context in ("a", "b c", "d d", "unseen", "", "g a"):
        total = 0.0
        for w in [*vocabulary, None, "never"]:
            text = context if w is None else f"{context} {w}"
            words, first = K.stream(pa.array([text]))
            p = lookup.probabilities(words, first)[1]
            total += float(p[-1] if w is None else p[-2])
        assert total == pytest.approx(1.0)


def test_scores(spark):
    model = _model(spark, CORPUS, 2)
    texts = ["a b c", "", None, "never seen", "a " * 20000, "A b C"]
    df = spark.createDataFrame([(i, t, 0.5) for i, t in enumerate(texts)], "doc_id long, text string, score double")
    got = {r.doc_id: r for r in K.score(df, model).collect()}
    counts = Counter(w for t in CORPUS for w in [*(t or "").lower().split(), "</s>"])
    for i, t in enumerate(texts):
        own = [*(t or "").lower().split(), "</s>"]
        base = sum(math.log10((counts[w] + 0.5) / (model.train_tokens + 0.5 * (model.vocabulary + 1))) for w in own)
        assert (got[i].n_tokens, got[i].n_known) == (len(own), sum(counts[w] > 0 for w in own))
        assert got[i].base_score == pytest.approx(base)
    assert got[0].score == got[5].score and got[1].score == got[2].score
    assert K.score(df.limit(0), model).count() == 0
    none = K.train(df.limit(0), F.lit(True))
    assert all(math.isfinite(r.score) for r in K.score(df, none).collect())


def test_model_beats_single_words_on_held_out_text(spark):
    rows = queries.language_model_scores(spark, DATA).where("held_out").collect()
    assert sum(r.score for r in rows) > sum(r.base_score for r in rows)


def test_token_hashes_depend_on_the_token_alone():
    texts = ["The cat", "the  CAT\tthe", "", None, "x" * 3000 + " cat"]
    tok = T.tokens(pa.array(texts))
    words = [w for t in texts for w in (t or "").lower().split()]
    assert [words.index(w) for w in words] == [tok.hash.tolist().index(h) for h in tok.hash.tolist()]
    assert tok.counts.tolist() == [len((t or "").split()) for t in texts]
    sliced = T.tokens(pa.array(["zz", *texts]).slice(1))
    assert (sliced.hash == tok.hash).all()
    h, own = T.ngrams(tok, 2)
    assert own.tolist() == [0, 2, 3, 5]
