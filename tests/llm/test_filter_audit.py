"""The filter audit against filters applied one after another, row by row."""

import re
from itertools import permutations

import duckdb
import numpy as np
import pytest

from recordmill.llm import filter_audit as A

DOCS = "doc_id long, text string, lang string, mask int, n string"
LABELS = "doc_id long, quality int, toxic int, good int"


def brute(docs, labels):
    texts = [(i, t or "", g or "") for i, t, g, *_ in docs]
    rows = []
    for i, t, part in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", t)
        fails = {f for f, bad in zip("ABCDE", (
            len(words) < 200, 100 * len(set(words)) < 50 * len(words), 100 * len(re.findall("[A-Z]", t)) > 3 * len(t),
            re.search("[#$%&*|]", t) is not None,
            i is not None and any(j is not None and j < i and t == u for j, u, _ in texts))) if bad}
        own = [x for x in labels if i is not None and x[0] == i]
        rows.append((part, fails, any(x[1] == 1 for x in own), any(x[2] == 1 for x in own)))
    out = []
    for part in {r[0] for r in rows}:
        mine, lines, total = [r for r in rows if r[0] == part], [], dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                left = [r for r in left if f not in r[1]]
                total[f] += len(gone)
                lines.append((part, "".join(order), step, len(left), len(gone), sum(f in r[1] for r in mine) - len(gone) - sum(f in r[1] for r in left),
                              sum(r[1] == {f} for r in mine), sum(r[2] for r in gone), sum(r[3] for r in gone)))
        out += [(*line, total[line[1][line[2] - 1]]) for line in lines]
    return sorted(out)


def result(spark, docs, labels):
    return sorted(tuple(r) for r in A.audit(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect())


def test_min_plus_gives_the_first_failing_step():
    orders, steps = A.inverse_positions(4)
    masks = np.array([[m >> f & 1 for f in range(4)] for m in range(16)])
    rank = A.min_plus(np.where(masks, 0, np.inf), steps)
    for m in range(16):
        for o, order in enumerate(orders):
            assert rank[m, o] == min((s for s, f in enumerate(order, 1) if masks[m, f]), default=np.inf)


def test_rows_of_every_shape(spark):
    rng = np.random.default_rng(3)
    long = " ".join(f"w{i}" for i in range(250))
    texts = ["", None, long, long, long + " $5", "A B C " + long, "word " * 300, "# " * 300, "ABC " * 300, long.upper(), "ä ß\x0bx", long + " Ω" * 3]
    docs = [(int(i) if i < 40 else None, texts[rng.integers(len(texts))], [None, "", "en", "x'y"][rng.integers(4)], 7, "z") for i in rng.integers(0, 44, 90)]
    docs += docs[:5] + [(3, long, "en", 1, None)] * 30
    labels = [(int(i), [0, 1, None][rng.integers(3)], [0, 1, None][rng.integers(3)], 1) for i in rng.integers(0, 40, 30)] + [(None, 1, 1, 0)]
    assert result(spark, docs, labels) == brute(docs, labels)


def test_empty_and_very_long(spark):
    assert result(spark, [], []) == []
    docs = [(1, "one two " * 200_000, "en", 0, ""), (2, "w" * 2_000_000, "en", 0, "")]
    assert result(spark, docs, []) == brute(docs, [])


@pytest.mark.parametrize("table", ["/root/testdata/sf0.001"])
def test_whole_table_against_sql(spark, table):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{table}/{t}.parquet'")
    docs, labels = (spark.read.parquet(f"{table}/{t}.parquet") for t in ("documents", "labels"))
    got = A.audit(docs, labels)
    assert sorted(tuple(r) for r in got.collect()) == sorted(con.sql(A.ORACLE).fetchall())
