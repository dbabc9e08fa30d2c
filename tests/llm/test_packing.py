"""Packing: ids against the tokenizer library, and every id in exactly one place."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from recordmill.llm import packing as P

PATH = public_tokenizers.path("byte_bpe_50k.json")
CASES = [
    "don't we'll 'tis I've  x's's ''s 's", "", None, "a  b\n\n c\t d  ", "  lead", "trail   ", " \n x", "x   y　z",
    "12a½²٣ é naïve", "<|endoftext|> in <|endoftext|>", "hé!!  ?? \r\n\r\n'll 've're 'RE 'D", "🙂🙂 ok 🙂️", "'", "''",
    "' s", "x' y'", "a\x1c\x1db\x85c​d", "it's", "'s", "'l", "'v", "word " * 30000,
]


def whole(text):
    return Tokenizer.from_file(PATH).encode(text or "", add_special_tokens=False).ids + [0]


def test_ids_equal_those_of_the_library(spark, sf_dir):
    texts = CASES + [r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    library = Tokenizer.from_file(PATH)
    own = P.Tokenizer(PATH)
    for _ in range(2):  # the second time from memory
        for text, ids in zip(texts, own.encode(texts)):
            assert ids.tolist() == library.encode(text or "", add_special_tokens=False).ids + [0]


def test_forgetting_changes_nothing(monkeypatch):
    monkeypatch.setattr(P, "CACHE", 3)
    own = P.Tokenizer(PATH)
    for text in CASES:
        assert own.encode([text])[0].tolist() == whole(text)


@pytest.mark.parametrize("seed", range(60))
def test_first_fit_decreasing(seed):
    rng = random.Random(seed)
    sizes = [rng.randint(1, 1024) for _ in range(rng.randint(0, 80))]
    bins, loads = [], []
    for i in sorted(range(len(sizes)), key=lambda i: -sizes[i]):
        at = next((b for b, n in enumerate(loads) if n + sizes[i] <= 1024), len(bins))
        if at == len(bins):
            bins.append([])
            loads.append(0)
        bins[at].append(i)
        loads[at] += sizes[i]
    assert P.first_fit_decreasing(sizes) == bins


@pytest.mark.parametrize("seed", range(60))
def test_groups_hold_every_token_once_without_padding(seed):
    rng = random.Random(seed)
    sizes = [rng.choice([1, rng.randint(1, 30), rng.randint(1, 5000), 1024, 2048]) for _ in range(rng.randint(0, 40))]
    cover = {}
    for sequence in P.pack_group(sizes):
        total = sum(n for _, _, n in sequence)
        assert total <= 1024 and total & (total - 1) == 0
        for d, start, n in sequence:
            cover.setdefault(d, []).append((start, n))
    for d, size in enumerate(sizes):
        at = 0
        for start, n in sorted(cover[d]):
            assert start == at and n > 0
            at += n
        assert at == size


def test_round_trip(spark):
    rows = [(i % 18, t, 1) for i, t in enumerate(CASES)] + [(None, "no id", 2)]
    df = spark.createDataFrame(rows, "doc_id long, text string, start int").repartition(3)
    pieces = P.pack(df, PATH).withColumn("crc", F.crc32("ids")).collect()
    sequences, docs = {}, {}
    for p in pieces:
        ids = np.frombuffer(bytes(p.ids), "<u4")
        assert p.crc == zlib.crc32(p.ids) and len(ids) == p.length
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length))
        docs.setdefault((p.doc_id, p.doc_tokens), []).append((p.start, ids.tolist()))
    for own in sequences.values():
        at = 0
        for offset, n in sorted(own):
            assert offset == at
            at += n
        assert at <= 1024 and at & (at - 1) == 0
    got = {k: sum((ids for _, ids in sorted(v)), []) for k, v in docs.items()}
    want = {}
    for d, text, _ in rows:
        want[d, len(whole(text))] = whole(text)
    assert got == want
    assert P.pack(df.limit(0), PATH).count() == 0
