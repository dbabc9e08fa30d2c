"""Spaced-seed overlaps against a comparison of every pair on every diagonal."""

import re
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from recordmill.llm import decontamination as D
from recordmill.llm import tokens as T


def words(text):
    return re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", (text or "").lower())


def brute(docs, items):
    """Pairs with an overlap of the least length, whatever seeds they share."""
    found = set()
    for d, text in docs:
        a = words(text)
        for i, item in items:
            b = words(item)
            if len(b) < D.MIN_ITEM:
                continue
            for shift in range(-len(b), len(a)):
                low, high = max(0, -shift), min(len(b), len(a) - shift)
                if high > low:
                    s, e = D.stretch(np.array([a[k + shift] == b[k] for k in range(low, high)]))
                    if e - s >= min(D.MIN_TOKENS, len(b)):
                        found.add((d, i))
    return found


def test_stretch():
    assert D.stretch(np.array([0, 1, 1, 1, 0, 1, 1, 1, 1, 1, 0], bool)) == (5, 10)
    assert D.stretch(np.array([1] * 5 + [0] + [1] * 5, bool)) == (0, 11)


def test_seeds_stay_within_texts():
    tok = T.tokens(pa.array(["a b c d e f g h i", "", None, "j " * 8]), T.PLAIN_WORDS)
    h, own = D.seeds(tok, D.MASKS[0])
    assert own.tolist() == [0]


ITEMS = [
    (1, "Who was the first person to walk on the far side of that distant moon, and in which year?"),
    (2, "who was the first person to walk on the far side of that distant moon and in which year"),
    (3, "Nine small words make the shortest item of them"),
    (4, "too short"), (5, None), (6, ""),
]
DOCS = [
    (10, "x y z WHO was the first person to walk on the near side of that distant moon and in which year ok"),
    (11, "nothing of the kind is found in here " * 50), (12, None), (13, ""),
    (14, "before: nine small words make the shortest item of them, after"), (15, "too short"),
    (None, "who was the first person to walk on the far side of that distant moon and in which"),
    (16, "lorem " * 30000 + ITEMS[0][1] + " ipsum" * 30000),
]


def test_cases(spark):
    docs = spark.createDataFrame([(*d, 1) for d in DOCS], "doc_id long, text string, item_id int")
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = D.overlaps(docs, items).collect()
    assert sorted((r.doc_id or 0, r.item_id) for r in got) == [(0, 1), (10, 1), (14, 3), (16, 1)]
    one = next(r for r in got if r.doc_id == 10)
    assert (one.n_tokens, one.n_equal, one.doc_start, one.doc_end, one.item_start) == (19, 18, 3, 22, 0)
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [11, 12, 13, 15]


def test_empty_tables(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.overlaps(docs, none).count() == 0
    assert D.drop_contaminated(docs, none).count() == len(DOCS)
    assert D.overlaps(docs.limit(0), spark.createDataFrame(ITEMS, "item_id long, text string")).count() == 0


def test_blocks_give_the_same(spark, monkeypatch):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    copies = [(20 + i, t.upper() + "!") for i, (_, t) in enumerate(ITEMS) if t]
    items = spark.createDataFrame([*ITEMS, *copies], "item_id long, text string")
    want = sorted(map(tuple, D.overlaps(docs, items).collect()), key=repr)
    monkeypatch.setattr(D, "BLOCK_BYTES", 60)
    assert sorted(map(tuple, D.overlaps(docs, items).collect()), key=repr) == want
    assert want and all(r[-1] >= 2 and r[1] < 20 for r in want)
    classes = {r.item_id: r.class_id for r in D.item_classes(items).collect()}
    assert all(classes[i] == i for i in {r[1] for r in want}) and all(classes.get(20 + i, own[0]) == classes.get(own[0]) for i, own in enumerate(ITEMS) if own[0] in classes)


@pytest.mark.parametrize("seed", range(3))
def test_substituted_passages_are_found(spark, seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    items = [(i, " ".join(rng.choice(vocabulary, 30))) for i in range(8)]
    docs = []
    for d in range(60):
        body = rng.choice(vocabulary, 40).tolist()
        if d % 2:
            passage = items[d % 8][1].split()
            for at in rng.choice(30, int(rng.integers(0, 4)), replace=False):
                passage[at] = "changed"
            body[20:20] = passage
        docs.append((d, " ".join(body)))
    got = {(r.doc_id, r.item_id) for r in D.overlaps(
        spark.createDataFrame(docs, "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert got == brute(docs, items)


def test_whole_table_against_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 1500")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    got = {(r.doc_id, r.item_id) for r in D.overlaps(docs, items).collect()}
    rows = [tuple(r) for r in docs.select("doc_id", "text").limit(60).collect()]
    some = {d for d, _ in rows}
    want = brute(rows, [tuple(r) for r in items.select("item_id", "text").collect()])
    assert {p for p in got if p[0] in some} == want


def similar(a, b):
    """By definition: 80 % equal tokens of a whole item or of 13 tokens or more, or a short item that is equal."""
    for shift in range(-len(b), len(a)):
        low, high = max(0, -shift), min(len(b), len(a) - shift)
        equal = [a[k + shift] == b[k] for k in range(low, high)]
        if len(b) < 9:
            if len(equal) == len(b) and all(equal):
                return True
            continue
        for s in range(len(equal)):
            for e in range(s + min(13, len(b)), len(equal) + 1):
                if 5 * sum(equal[s:e]) >= 4 * (e - s):
                    return True
    return False


@pytest.mark.parametrize("size", [3, 4, 6, 8, 9, 10, 11, 12, 13, 15, 16, 18, 20, 28])
def test_every_similar_item_is_found(size):
    """Changed tokens in all places, up to one more than the definition allows."""
    rng = np.random.default_rng(size)
    item = [f"i{k}" for k in range(size)]
    most = size // 5 + 1 if size >= 9 else 1
    places = [p for n in range(most + 1) for p in combinations(range(size), n)]
    if len(places) > 1200:
        places = [places[i] for i in rng.choice(len(places), 1200, replace=False)]
    docs = [["x"] * 3 + [f"y{k}" if k in p else w for k, w in enumerate(item)] + ["z"] * 2 for p in places]
    index = D.Index.of([1], [" ".join(item)])
    tok = T.tokens(pa.array([" ".join(d) for d in docs]), T.PLAIN_WORDS)
    found = {m[0] for m in D.matches(tok, index)}
    assert found == {n for n, d in enumerate(docs) if similar(d, item)}


def test_longest_window():
    assert D.window(np.array([1, 0, 0, 1, 1, 1, 0, 1, 0, 0], bool)) == (3, 8)
    assert D.window(np.array([1, 1, 0, 1, 1, 1, 1, 0, 1, 1], bool)) == (0, 10)
    assert D.window(np.zeros(4, bool)) == (0, 0)


@pytest.mark.parametrize("bits", [26, 8])
def test_joined_seeds_give_the_same(spark, sf_dir, monkeypatch, bits):
    """A test set too large to send out: the same rows, also if the bit table lets nearly all seeds through."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").where("length(text) < 1500").withColumn("_key", F.lit(7))
    docs = docs.unionByName(docs.limit(20)).unionByName(docs.limit(2).withColumn("doc_id", F.lit(None).cast("long")))
    docs = docs.unionByName(docs.limit(2).withColumn("text", F.lit(None).cast("string")))
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").unionByName(
        spark.createDataFrame([*ITEMS, (None, "an item that has no name of its own but ten words")], "item_id long, text string"))
    docs = docs.unionByName(docs.limit(1).withColumn("text", F.lit("see an item that has no name of its own but nine words")))
    want = sorted(map(tuple, D.overlaps(docs, items).collect()), key=repr)
    kept = sorted(map(tuple, D.drop_contaminated(docs, items).collect()), key=repr)
    monkeypatch.setattr(D, "BLOCK_BYTES", 0)
    monkeypatch.setattr(D, "FILTER_BITS", bits)
    joined = D.drop_contaminated(docs, items)
    assert sorted(map(tuple, D.overlaps(docs, items).collect()), key=repr) == want
    assert joined.columns == docs.columns and sorted(map(tuple, joined.collect()), key=repr) == kept
    assert want and any(r[1] is None for r in want)


def test_a_long_document_with_many_candidates_streams(spark, monkeypatch):
    """More candidates than a batch holds, of one document, and several shifts of one pair."""
    monkeypatch.setattr(D, "BLOCK_BYTES", 0)
    items = [(i, " ".join(f"w{i}x{k}" for k in range(15))) for i in range(1500)]
    text = " ".join(t for _, t in items) + " between " + items[7][1].replace("w7x3 ", "other ")
    got = D.overlaps(
        spark.createDataFrame([(1, text), (2, "")], "doc_id long, text string"),
        spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(r.item_id for r in got) == list(range(1500))
    assert all(r.doc_id == 1 and r.n_equal == 15 and r.doc_start == 15 * r.item_id for r in got)
