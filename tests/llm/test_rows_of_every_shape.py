"""All registered queries and the pipeline on null, empty, long, tied and repeated rows, clashing names and empty tables."""

import pytest

import corpus_pipeline
from recordmill.llm import queries

CLASH = "score int, id string, _fingerprint int, __fingerprint int, _quality int, h int, num int, tag int, fp string"
EXTRA = (1, "x", 2, 3, 4, 5, 6, 7, "y")
LONG = "some words in a row, number " + " ".join(f"n{i}" for i in range(30000))
HTML = "<html><body><article><p>One plain text.</p></article></body></html>"

TABLES = {
    "documents": ("doc_id long, text string, lang string, source string, n_chars long, " + CLASH, [
        (None, None, None, None, None), (None, "a text that has no id at all", "en", "s", 5), (None, "another one without an id", "de", "s", 5),
        (1, "", "en", "s", 0), (1, "", "en", "s", 0), (2, LONG, "en", "s", 5), (2, "a second text under one id", "en", None, 5),
        (3, "one more plain text of a few words", None, "s", 5), (4, "one more plain text of a few words", "de", "s", 5),
        (50, " \t\n", "de", "s", 3), (51, "ß Ω 12 $", "", "", -1)]),
    "labels": ("doc_id long, quality int, toxic int, " + CLASH, [
        (None, None, None), (None, 1, 1), (2, 1, 0), (2, 1, 0), (3, 0, 1), (4, 1, None), (4, 0, 0), (50, 1, 0), (51, 0, 1), (99, 1, 1)]),
    "embeddings": ("vec_id long, embedding array<float>, label int, " + CLASH, [
        (None, None, None), (None, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (0, [1.0, 2.0], 1), (50, [2.0, 1.0], None), (50, [0.0, 0.0], 1), (7, [], 1), (8, [1.0, 2.0, 3.0], 1)]),
    "pages": ("page_id long, url string, html string, " + CLASH, [
        (None, None, None), (1, "u", ""), (1, "u", HTML), (1, "u", HTML), (2, None, "<p>" + LONG), (3, "u", "<<<>&#xFFFFFFF; no <b markup")]),
    "benchmark": ("item_id long, text string, " + CLASH, [(None, None), (None, "few words"), (1, ""), (2, LONG[:400]), (2, LONG[:400]), (3, LONG[:400])]),
}
KEYED = {"documents": "doc_id", "embeddings": "vec_id", "pages": "page_id"}
#: Queries that return a row for each row of their table.
ROWWISE = {
    "op1_embedding_near_dedup": "embeddings", "op3_simhash_near_dedup": "documents", "op4_quality_classifier": "documents",
    "op6_language_id": "documents", "op7_lm_scoring": "documents", "op8_toxicity": "documents", "op9_html_extraction": "pages",
    "op13_merkle_manifest": "documents",
}
ALL = {**queries.QUERIES, "pipeline": corpus_pipeline.run}


@pytest.fixture(scope="module")
def folders(spark, tmp_path_factory):
    out = {}
    for kind in ("full", "empty"):
        folder = str(tmp_path_factory.mktemp(kind))
        for name, (schema, rows) in TABLES.items():
            given = [(*r, *EXTRA) for r in rows] if kind == "full" else []
            spark.createDataFrame(given, schema).write.parquet(f"{folder}/{name}.parquet")
        out[kind] = folder
    return out


@pytest.mark.parametrize("name", sorted(ALL))
def test_every_row_comes_back(spark, folders, name):
    rows = ALL[name](spark, folders["full"]).collect()
    if name in ROWWISE:
        table = ROWWISE[name]
        key = KEYED[table]
        want = [r[0] for r in TABLES[table][1]]
        assert sorted((r[key] for r in rows), key=repr) == sorted(want, key=repr)
    if name == "op5_packing":
        assert {r.doc_id for r in rows} == {r[0] for r in TABLES["documents"][1]}
        assert len({(r.sequence_id, r.offset) for r in rows}) == len(rows)


@pytest.mark.parametrize("name", sorted(ALL))
def test_empty_tables_give_no_rows(spark, folders, name):
    assert ALL[name](spark, folders["empty"]).collect() == []
