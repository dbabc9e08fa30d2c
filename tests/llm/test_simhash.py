"""SimHash groups against a comparison of all pairs."""

import numpy as np
import pytest

from recordmill.llm import simhash as S


def components(ids, fps):
    """Brute force: smallest id reachable over links of at most three bits."""
    label = {i: i for i in ids}
    changed = True
    while changed:
        changed = False
        for i in ids:
            for j in ids:
                if bin(fps[i] ^ fps[j]).count("1") <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


def near(rng, base, bits):
    for b in rng.choice(64, bits, replace=False):
        base ^= 1 << int(b)
    return base


@pytest.mark.parametrize("seed", range(4))
def test_links_connect_what_all_pairs_connect(seed):
    rng = np.random.default_rng(seed)
    fps = []
    for _ in range(6):
        base = int(rng.integers(0, 1 << 62)) * 3 & (1 << 64) - 1
        fps += [base] + [near(rng, base, int(rng.integers(1, 8))) for _ in range(12)]
    # A dense ball: far more than _SMALL members share keys.
    base = int(rng.integers(0, 1 << 62))
    fps += [near(rng, base, int(rng.integers(1, 4))) for _ in range(250)]
    fps = np.unique(np.array(fps, np.uint64))
    keys = S.variants(fps)
    key, fp = keys.ravel(), np.repeat(fps, keys.shape[1])
    order = np.argsort(key, kind="stable")
    src, dst = S.group_links(key[order], fp[order])
    assert (np.bitwise_count(src ^ dst) <= 3).all()
    want = components(fps.tolist(), {f: f for f in fps.tolist()})
    label = {f: f for f in fps.tolist()}
    a, b = S.forest(src.view(np.int64), dst.view(np.int64))
    group = {}
    for x, y in zip(a.view(np.uint64).tolist(), b.view(np.uint64).tolist()):
        group.setdefault(y, {y}).add(x)
    for members in group.values():
        for m in members:
            label[m] = min(members)
    assert label == want


def test_fingerprints_by_definition():
    import xxhash

    assert S.fingerprint(None) == S.fingerprint("") == S.fingerprint(" \t\n") == 0
    assert S.fingerprint("Ab C") == xxhash.xxh64_intdigest("ab c", 42)
    text = "The  É cat\tsat on the É cat sat"
    words = "the É cat sat on the É cat sat".split()
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 3]), 42) for i in range(len(words) - 2)]
    want = sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))
    assert S.fingerprint(text) == want


ROWS = [
    (5, "a b c d e f g", "x"), (3, "A  b c d e f g", "y"), (9, "A b c d e f g", "z"), (9, "A b c d e f g", "z"),
    (4, None, "n"), (7, "", "n"), (None, "quite another text here", "q"), (8, "word " * 20000, "long"),
]


def test_groups_over_nulls_repeats_and_extra_columns(spark):
    df = spark.createDataFrame(ROWS, "doc_id long, text string, fp string")
    got = sorted((r.doc_id or -1, r.component_id) for r in S.near_duplicates(df).collect())
    assert got == [(-1, None), (3, 3), (4, 4), (5, 3), (7, 4), (8, 8), (9, 3), (9, 3)]
    kept = S.keep_first(df)
    assert kept.columns == df.columns
    assert sorted((r.doc_id or -1) for r in kept.collect()) == [-1, 3, 4, 8]


def test_different_texts_under_one_id_all_stay(spark):
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{i}" for i in rng.integers(0, 9999, 60)) for _ in range(12)]
    rows = [(None if i < 6 else 7, t) for i, t in enumerate(texts)]
    rows += [(9, texts[0]), (None, texts[1]), (8, texts[6]), (7, texts[7])]
    kept = S.keep_first(spark.createDataFrame(rows, "doc_id long, text string"))
    want = [(9, texts[0]), *((None if i < 6 else 7, t) for i, t in enumerate(texts) if i)]
    assert sorted(map(tuple, kept.collect()), key=repr) == sorted(want, key=repr)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert S.near_duplicates(df).count() == 0
    assert S.keep_first(df).count() == 0


def test_all_documents_against_all_pairs(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = S.near_duplicates(df).collect()
    fps = {r.doc_id: r.fp & (1 << 64) - 1 for r in rows}
    want = components(list(fps), fps)
    assert {r.doc_id: r.component_id for r in rows} == want
