"""The manifest against a tree built by hand."""

import hashlib
import zlib

import duckdb
import pytest

from recordmill.llm import merkle as M

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, idx int, grp string, path string"


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute(docs):
    def enc(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    def leaf(d, text):
        return h("".join(enc(v) for v in (d[0], d[3], d[2], d[4], text)))

    def climb(nodes):
        """The root, and for each node its (left, right) by level."""
        paths, held, level = [[] for _ in nodes], [[i] for i in range(len(nodes))], list(nodes)
        while len(level) > 1:
            up, over = [], []
            for a in range(0, len(level), 8):
                run = level[a : a + 8]
                for j in range(len(run)):
                    for i in held[a + j]:
                        paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
                up.append(h("".join(run)))
                over.append([i for x in held[a : a + 8] for i in x])
            level, held = up, over
        return level[0], paths

    langs = sorted({d[2] for d in docs}, key=lambda g: (g is not None, (g or "").encode()))
    groups = {}
    for g in langs:
        mine = sorted((d for d in docs if d[2] == g), key=lambda d: (d[0] is not None, d[0] or 0, leaf(d, d[1])))
        groups[g] = mine, *climb([leaf(d, d[1]) for d in mine])
    root, upper = climb([groups[g][1] for g in langs]) if docs else (None, [])
    out = []
    for g, top in zip(langs, upper):
        mine, subroot, paths = groups[g]
        for d, path in zip(mine, paths):
            own = leaf(d, d[1])
            hit = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 3 == 0 and d[1] is not None
            folded = leaf(d, "".join(c.lower() if "A" <= c <= "Z" else c for c in d[1])) if hit else own
            for left, right in path + top:
                folded = h(left + folded + right)
            out.append((d[0], own, subroot, root, h("".join(a + b for a, b in path + top)), folded, folded == root))
    return sorted(out, key=repr)


def result(df):
    return sorted((tuple(r) for r in M.manifest(df).collect()), key=repr)


@pytest.mark.parametrize("sizes", [[1], [8], [9], [1, 64, 65], [1] * 9, [513, 2, 0, 520]])
def test_sizes(spark, sizes):
    docs = [(k * 1000 + i, f"Text {i} Ä", f"l{k}", "s", i, 0, "", "") for k, n in enumerate(sizes) for i in range(n)]
    assert result(spark.createDataFrame(docs, SCHEMA)) == brute(docs)


def test_many_rounds(spark, monkeypatch):
    for name, value in (("FANOUT", 8), ("DEPTH", 1), ("BLOCK", 8)):
        monkeypatch.setattr(M, name, value)
    docs = [(i, "A" * (i % 7), None if i % 3 else "é", "s", i, 0, "", "") for i in range(200)]
    docs += [(i, "b", f"g{i:03}", None, None, 0, "", "") for i in range(70)]
    assert result(spark.createDataFrame(docs, SCHEMA)) == brute(docs)


def test_rows_of_every_shape(spark):
    docs = [(None, None, None, None, None, 1, None, None), (None, "A", None, None, 1, 1, "x", "y"), (5, "", "", "s", 0, 1, "x", "y"),
            (5, "Q", "", "s", 0, 1, "x", "y"), (-7, "Ünï", "en", "S", -1, 1, "x", "y"), (3, "WORDS " * 300_000, "en", "s", 5, 1, "x", "y")]
    docs += [(9, "Same ROW", "en", "s", 8, 1, "x", "y")] * 20 + [(i, "Tie", "de", "s", 3, 1, "x", "y") for i in (4, 4, 6, 6)]
    assert result(spark.createDataFrame(docs, SCHEMA)) == brute(docs)
    assert result(spark.createDataFrame([], SCHEMA)) == []


def test_whole_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{sf_dir}/documents.parquet'")
    got = result(df)
    assert got == sorted(con.sql(M.ORACLE).fetchall(), key=repr)
    assert got == brute([(r.doc_id, r.text, r.lang, r.source, r.n_chars) for r in df.collect()])


def test_no_text_is_shuffled(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = M.manifest(df)._jdf.queryExecution().executedPlan().toString()
    assert "text" not in plan and "Python" not in plan
