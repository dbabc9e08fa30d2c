"""The record job from CSV files to written outputs."""

import csv
import glob
import json

import pytest
from pyspark.sql import functions as F

from checks.raw_records import raw_records
from recordmill.operators.numbering import assign_canonical_ids
from recordmill.operators.records import conform_schema, evaluate_records, normalize_records
from recordmill.plans.records import record_job, run_records
from recordmill.schema import CANONICAL_COLUMNS, NORMALIZED_COLUMNS, RAW_COLUMNS
from recordmill.sources.records import InvalidEncodingError, read_records, read_seeds, utf8_gate
from recordmill.staging import stage

ROWS = [
    dict(record_id="A1", source="web", source_type="detail", bulletin_number="12345-07",
         title_raw=' <b>Law</b> &amp; "order"\nsecond line ', authors_raw='["Ana", "Ben", "ANA"]',
         published_at_raw="15/03/2024", event_date_raw="2024-03-16T10:00:00Z", status_raw="  open ",
         url_raw="https://E.com/a/?utm_source=x&id=1", summary_raw="long, text"),
    dict(record_id="A2", source="web", source_type="news", bulletin_number="123456-07",
         title_raw="Law", url_raw="https://e.com/a?id=1", published_at_raw="someday"),
    dict(record_id="A3", source="web", title_raw="   ", url_raw="https://e.com/b"),
    dict(record_id="A4", source="web", title_raw="No identifier", url_raw="nonsense"),
]


def write_input(folder, rows, columns):
    folder.mkdir()
    with open(folder / "in.csv", "w", encoding="utf-8", newline="") as f:
        writer = csv.DictWriter(f, columns, restval="")
        writer.writeheader()
        writer.writerows(rows)
    return str(folder)


def read_output(folder):
    rows = []
    for path in sorted(glob.glob(f"{folder}/part-*")):
        with open(path, encoding="utf-8", newline="") as f:
            rows += list(csv.DictReader(f))
    return rows


@pytest.fixture
def outputs(spark, tmp_path):
    source = write_input(tmp_path / "in", ROWS, [c for c in RAW_COLUMNS if c != "scraped_at"])
    record_job(spark, source, str(tmp_path / "out"))
    return tmp_path / "out"


def test_outputs(outputs):
    canonical = read_output(outputs / "normalized_records.csv")
    assert [list(r) for r in canonical] == [CANONICAL_COLUMNS]
    row = canonical[0]
    assert row["canonical_id"] == "CAN-000001" and row["kept_record_id"] == "A1"
    assert row["title"] == 'Law & "order" second line'
    assert row["authors"] == "Ana | Ben"
    assert row["status"] == "  open "  # pass-through text keeps its spaces
    assert row["published_at"] == "2024-03-15" and row["event_date"] == "2024-03-16T10:00:00+00:00"
    assert row["canonical_url"] == "https://e.com/a?id=1" and row["canonical_document_url"] == ""

    rejected = sorted(read_output(outputs / "rejected_records.csv"), key=lambda r: r["record_id"])
    assert [tuple(r.values()) for r in rejected] == [
        ("A3", "missing_title", "https://e.com/b"), ("A4", "missing_all_identifiers", "")]

    clusters = sorted(read_output(outputs / "duplicate_clusters.csv"), key=lambda r: r["record_id"])
    assert [(r["record_id"], r["is_kept"], r["duplicate_reason"]) for r in clusters] == [
        ("A1", "True", "same_url"), ("A2", "False", "same_url")]
    assert len({r["duplicate_group_id"] for r in clusters}) == 1

    text = "".join(open(p, encoding="utf-8").read() for p in glob.glob(f"{outputs}/quality_report.json/part-*"))
    assert "\n" in text.strip()
    assert json.loads(text) == {
        "input_rows": 4, "normalized_rows": 1, "rejected_rows": 2, "duplicate_groups": 1,
        "duplicates_removed": 1,
        "parse_errors_by_field": {
            "bulletin_number": 1, "published_at": 1, "event_date": 0, "url_raw": 1, "document_url_raw": 0},
    }


def test_two_runs_agree(spark, tmp_path):
    source = write_input(tmp_path / "in", ROWS, RAW_COLUMNS)
    for name in ("one", "two"):
        record_job(spark, source, str(tmp_path / name))
    for output in ("normalized_records.csv", "rejected_records.csv", "duplicate_clusters.csv"):
        first, second = (sorted(map(str, read_output(tmp_path / n / output))) for n in ("one", "two"))
        assert first == second and first


def test_no_valid_rows_give_empty_tables(spark):
    raw = spark.createDataFrame([("R1", " ")], "record_id string, title_raw string")
    result = run_records(raw)
    assert result.canonical.columns == CANONICAL_COLUMNS and result.canonical.count() == 0
    assert result.clusters.count() == 0 and result.rejected.count() == 1
    report = result.report.first()
    assert (report.input_rows, report.normalized_rows, report.rejected_rows) == (1, 0, 1)
    assert (report.duplicate_groups, report.duplicates_removed) == (0, 0)


def test_rows_are_partitioned_among_outputs(spark, sf_dir):
    raw = raw_records(spark, sf_dir)
    result = run_records(raw)
    report = result.report.first()
    assert report.normalized_rows + report.duplicates_removed + report.rejected_rows == report.input_rows
    assert result.clusters.count() == report.normalized_rows + report.duplicates_removed
    kept = result.clusters.groupBy("duplicate_group_id").agg(
        F.countDistinct(F.when(F.col("is_kept"), F.col("record_id"))).alias("ids"))
    assert kept.where("ids <> 1").count() == 0


def test_normalizing_twice_changes_nothing(spark, sf_dir):
    names = {"title_raw": "title", "published_at_raw": "published_at", "event_date_raw": "event_date",
             "url_raw": "canonical_url", "document_url_raw": "canonical_document_url"}
    once = stage(normalize_records(raw_records(spark, sf_dir)), "once").where(~F.contains("title", F.lit("&")))
    again = normalize_records(once.select(
        "record_id", "bulletin_number", *[F.col(new).alias(old) for old, new in names.items()]))
    columns = ["record_id", "bulletin_number", *names.values()]
    assert again.select(columns).exceptAll(once.select(columns)).count() == 0


def test_failed_rows_are_rejected_and_not_counted(spark):
    raw = spark.createDataFrame(
        [("R1", "<![oops[x]]>", "", "17000-XX"), ("R2", "fine", "https://e.com", "17000-XX")],
        "record_id string, title_raw string, url_raw string, bulletin_number string")
    rows = {r.record_id: r for r in evaluate_records(raw).collect()}
    assert rows["R1"].rejection_reason.startswith("normalization_error: ")
    assert rows["R1"].raw_identifier_hint == "17000-XX"
    assert not rows["R1"].parse_failed.bulletin_number
    assert rows["R2"].rejection_reason == "" and rows["R2"].parse_failed.bulletin_number


def test_conform_schema(spark):
    df = spark.createDataFrame([(7, None, "x")], "record_id int, source string, extra string")
    row = conform_schema(df).first()
    assert list(row.asDict()) == RAW_COLUMNS and (row.record_id, row.source, row.title_raw) == ("7", "", "")


def test_numbers_are_dense_and_follow_the_order(spark):
    df = spark.range(2500).select(
        F.format_string("K%05d", (F.col("id") * 7919) % 1000).alias("record_id"),
        F.lit("G").alias("duplicate_group_id"), F.col("id").cast("string").alias("title"))
    rows = assign_canonical_ids(df.repartition(13)).collect()
    assert sorted(r.canonical_id for r in rows) == [f"CAN-{i:06d}" for i in range(1, 2501)]
    by_number = sorted(rows, key=lambda r: r.canonical_id)
    assert [r.kept_record_id for r in by_number] == sorted(r.record_id for r in rows)
    # Partitions come out in order, so files do too.
    assert [r.canonical_id for r in rows] == [r.canonical_id for r in by_number]


def test_wide_numbers_are_not_cut(spark):
    df = spark.range(1).select(F.format_string("CAN-%06d", F.lit(12345678)).alias("x"))
    assert df.first().x == "CAN-12345678"


def test_encoding_gate(spark, tmp_path):
    (tmp_path / "bad.csv").write_bytes("record_id,title_raw\nR1,a\xf1o\n".encode("latin-1"))
    (tmp_path / "good.csv").write_bytes("record_id,title_raw\nR1,a\xf1o\n".encode())
    with pytest.raises(InvalidEncodingError):
        read_records(spark, str(tmp_path / "bad.csv"))
    assert utf8_gate(spark, str(tmp_path / "bad.csv"), mode="quarantine").count() == 1
    assert read_records(spark, str(tmp_path / "good.csv")).first().title_raw == "a\xf1o"


def test_reader_keeps_text_as_it_is(spark, tmp_path):
    (tmp_path / "in.csv").write_text('record_id,title_raw,status_raw\nR1,"two\nlines ""q""", NA \nR2,,null\n')
    rows = read_records(spark, str(tmp_path / "in.csv")).select("record_id", "title_raw", "status_raw").collect()
    assert [tuple(r) for r in rows] == [("R1", 'two\nlines "q"', " NA "), ("R2", "", "null")]


def test_seeds(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# note\nhttps://e.com/1\n\n  https://e.com/2  \n  # kept\nhttps://e.com/1\n")
    assert [r.seed_url for r in read_seeds(spark, str(tmp_path / "seeds.txt")).collect()] == [
        "https://e.com/1", "https://e.com/2", "# kept", "https://e.com/1"]


def test_normalized_columns(spark, sf_dir):
    assert normalize_records(raw_records(spark, sf_dir)).columns == NORMALIZED_COLUMNS


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_are_read_by_their_own_headers(spark, tmp_path, multi_line):
    # Spark takes a name in brackets for a pattern when it looks at headers of multi-line files.
    (tmp_path / ("a b.csv" if multi_line else "a b[1].csv")).write_text("record_id,title_raw,url_raw\nA1,T1,u1\n")
    (tmp_path / "b%20.csv").write_text("title_raw,record_id,url_raw\nT2,A2,u2\n")
    (tmp_path / "c.csv").write_text("record_id,title_raw\nA3,T3\n")
    (tmp_path / "empty.csv").write_text("")
    (tmp_path / "header.csv").write_text("record_id,title_raw,extra\n")
    for path in (str(tmp_path), [str(tmp_path / "*.csv")]):
        rows = read_records(spark, path, multi_line=multi_line).collect()
        assert sorted((r.record_id, r.title_raw, r.url_raw) for r in rows) == [("A1", "T1", "u1"), ("A2", "T2", "u2"), ("A3", "T3", "")]
    (tmp_path / "none").mkdir()
    assert read_records(spark, str(tmp_path / "none"), multi_line=multi_line).count() == 0
