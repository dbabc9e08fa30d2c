"""The pipeline's stages, each against what its operator says of the same input."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from recordmill.llm import decontamination, quality, simhash, substrings
from recordmill.llm import tokens as T
from recordmill.staging import stage

DATA = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def states(spark):
    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    out = [docs]
    for name, function in pipeline.STAGES:
        out.append(stage(function(spark, out[-1], DATA), name))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_all_but_the_last_return_documents(states):
    for state in states[1:-1]:
        assert state.dtypes == states[0].dtypes


def test_quality_keeps_the_good_and_drops_the_bad(spark, states):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{DATA}/labels.parquet").collect()}
    kept = set(ids(states[1]))
    assert all(d in kept for d, q in labels.items() if q == 1)
    assert not any(d in kept for d, q in labels.items() if q == 0)
    w = quality.train(states[0], spark.read.parquet(f"{DATA}/labels.parquet"), F.lit(True))
    rows = states[0].select("doc_id", "text").collect()
    scores = quality.score_texts(pa.array([r.text for r in rows]), w)
    assert kept == {r.doc_id for r, s in zip(rows, scores) if s >= 0.5}


def test_one_document_of_each_group_stays(states):
    groups = {}
    for r in states[1].select("doc_id", "text").collect():
        groups[r.doc_id] = simhash.fingerprint(r.text)
    component = {r.doc_id: r.component_id for r in simhash.near_duplicates(states[1]).collect()}
    assert ids(states[2]) == sorted(set(component.values()))
    kept = np.array([groups[d] for d in ids(states[2])], np.uint64)
    apart = np.bitwise_count(kept[:, None] ^ kept[None, :])
    assert (apart[~np.eye(len(kept), dtype=bool)] > simhash.RADIUS).all()


def test_passages_are_cut_and_nothing_else(states):
    before = {r.doc_id: r.text for r in states[2].collect()}
    spans = {}
    for r in substrings.repeated_passages(states[2]).collect():
        spans.setdefault(r.doc_id, set()).update(range(r.start, r.end))
    after = {r.doc_id: r for r in states[3].collect()}
    for d, text in before.items():
        tok = T.tokens(pa.array([text]), T.PLAIN_WORDS)
        left = [h for i, h in enumerate(tok.hash.tolist()) if i not in spans.get(d, ())]
        if d not in spans:
            assert after[d].text == text
        elif left:
            assert T.tokens(pa.array([after[d].text]), T.PLAIN_WORDS).hash.tolist() == left
            assert after[d].n_chars == len(after[d].text)
        else:
            assert d not in after
    assert set(after) <= set(before) and spans


def test_leaks_go(spark, states):
    found = {r.doc_id for r in decontamination.overlaps(states[3], spark.read.parquet(f"{DATA}/benchmark.parquet")).collect()}
    assert set(ids(states[4])) == set(ids(states[3])) - found and found


def test_all_tokens_are_packed(spark, states):
    packed = states[5].groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).collect()
    assert sorted(r.doc_id for r in packed) == ids(states[4]) and all(r.n == r.m for r in packed)
    run = pipeline.run(spark, DATA)
    assert run.count() == states[5].count() and run.columns == states[5].columns


def test_rows_of_every_shape_pass_all_stages(spark, tmp_path):
    rows = [
        (None, None, None, None, None, 1), (1, "", "en", "s", 0, 1), (1, "", "en", "s", 0, 1), (2, "some words " * 30000, "en", "s", 5, 1),
        (3, "one more plain text of a few words", None, "s", 5, 1), (None, "a text that has no id at all", "en", "s", 5, 1),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, score int")
    labels = spark.createDataFrame([(None, None, None)], "doc_id long, quality int, toxic int")
    items = spark.createDataFrame([(None, None)], "item_id long, text string")
    for given in (docs, docs.limit(0)):
        folder = str(tmp_path / str(given is docs))
        labels.write.parquet(f"{folder}/labels.parquet")
        items.write.parquet(f"{folder}/benchmark.parquet")
        given.write.parquet(f"{folder}/documents.parquet")
        for frame in (spark.read.parquet(f"{folder}/documents.parquet"),):
            for name, function in pipeline.STAGES:
                frame = stage(function(spark, frame, folder), name)
                if name != "packing":
                    assert frame.columns == docs.columns
        assert (frame.count() > 0) == (given is docs)


def test_passages_with_many_changed_words_are_cut(spark):
    """Of 60 words nine are changed: only few runs of five words are left, none of which may be passed over."""
    rng = np.random.default_rng(19)
    words = lambda n: [f"w{int(i)}" for i in rng.integers(0, 5000, n)]
    rows = []
    for d in range(100):
        passage = words(60)
        other = list(passage)
        for at in rng.choice(60, 9, replace=False):
            other[at] = f"changed{int(rng.integers(1 << 40))}"
        rows += [(2 * d, " ".join(words(40) + passage)), (2 * d + 1, " ".join(other + words(40)))]
    docs = spark.createDataFrame([(d, t, len(t)) for d, t in rows], "doc_id long, text string, n_chars long")
    left = {r.doc_id: r.text for r in pipeline.cut_repeated_passages(spark, docs, "").collect()}
    cut = [d for d, t in rows if left[d] != t]
    assert all(d % 2 for d in cut) and len(cut) >= 90
