"""Plan shapes that must hold whatever the data size."""

import re

import pytest
from pyspark.sql import functions as F

from checks.raw_records import raw_records
from recordmill.functions import urls
from recordmill.operators import dedup, numbering, pages, quality, records
from recordmill.staging import stage
from recordmill.staging import checkpoint_dir


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def evaluated(spark, sf_dir):
    return stage(records.evaluate_records(raw_records(spark, sf_dir)), "evaluated")


@pytest.fixture(scope="module")
def valid(evaluated):
    return records.split_rejects(evaluated)[0]


def test_row_work_is_narrow(spark, tmp_path):
    raw = spark.createDataFrame([("R1", "t")], "record_id string, title_raw string")
    text = plan(records.evaluate_records(raw))
    assert "Exchange" not in text and "BatchEvalPython" not in text
    assert text.count("ArrowEvalPython") == 1


def test_no_cross_join_or_window_over_groups(valid):
    text = plan(dedup.assign_duplicate_groups(valid))
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text
    assert "Window" not in text


def test_statistics_are_combined_before_the_shuffle(valid):
    text = plan(dedup._key_statistics(dedup.with_group_columns(valid)))
    assert "partial_count" in text and "partial_min" in text


def test_grouping_staged_records_reads_no_texts(spark, evaluated):
    staged = stage(dedup.with_group_columns(evaluated), "keyed")
    valid = records.split_rejects(staged)[0]
    text = plan(dedup._key_statistics(dedup.with_group_columns(valid)))
    assert "summary" not in text and "title" not in text


def test_rows_are_scanned_once_and_nothing_is_broadcast_by_hint(spark, valid):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
        text = plan(dedup.assign_duplicate_groups(valid))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "SortMergeJoin" in text and "Broadcast" not in text and "Union" not in text
    assert text.count("FileScan") == 2  # the rows and the written statistics


def test_columns_nobody_needs_are_not_read(valid):
    clusters = plan(dedup.duplicate_clusters(dedup.assign_duplicate_groups(valid)))
    assert "html_snippet" not in clusters
    sizes = plan(quality.duplicate_group_sizes(dedup.assign_duplicate_groups(valid)))
    assert "html_snippet" not in sizes


def test_rejects_are_filtered_at_the_scan(evaluated):
    valid, rejected = records.split_rejects(evaluated)
    assert "PushedFilters: [IsNotNull(rejection_reason), EqualTo(rejection_reason,)]" in plan(valid)
    scan = plan(rejected)
    assert "ReadSchema: struct<record_id:string,rejection_reason:string,raw_identifier_hint:string>" in scan


def test_numbering_sorts_ranges(valid):
    canonical = records.filter_canonical(dedup.assign_duplicate_groups(valid))
    text = plan(numbering.order_canonical(canonical))
    assert "rangepartitioning" in text and "SinglePartition" not in text.split("Subquery")[0]


def test_counting_placed_rows_reads_one_column(spark):
    placed = stage(spark.range(9).selectExpr("cast(id % 2 as int) AS _part", "id AS _place", "id AS wide"), "placed")
    assert "ReadSchema: struct<_part:int>" in plan(numbering.partition_sizes(placed))


def test_pages_are_parsed_where_they_are_read(spark):
    df = spark.createDataFrame([("https://h", 1, 200, "<p>", None)],
                               "seed_url string, page_no int, http_status int, html string, fetch_error string")
    text = plan(pages.extract_pages(df, scraped_at=F.lit("")))
    assert "Exchange" not in text and text.count("ArrowEvalPython") == 1


def test_staging_uses_the_named_folder(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        pytest.skip("the session names no folder")
    assert checkpoint_dir(spark) == named
    df = stage(spark.range(3), "numbers")
    assert df.inputFiles()[0].removeprefix("file://").removeprefix("file:").startswith(named.removeprefix("file:"))


def test_row_work_is_generated_code(spark):
    """All of it but authors and query parameters, which are arrays, and have projections of their own."""
    spark.conf.set("spark.sql.debug.maxToStringFields", "1000")
    raw = spark.createDataFrame([("R1", "t")], "record_id string, title_raw string")
    for df, columns in (
        (records.evaluate_records(raw), ["bulletin_number", "title", "published_at", "canonical_url", "rejection_reason"]),
        (urls.with_normalized_urls(raw, {"value": "title_raw"}), ["value"]),
    ):
        nodes = re.split(r"\n[ :]*\+- ", plan(df))
        for column in columns:
            made = [node for node in nodes if f" AS {column}#" in node]
            assert made and all(node.startswith("*(") and "lambda" not in node for node in made), column


PAGE_ROWS = "seed_url string, page_no int, http_status int, html string, fetch_error string"


def test_no_exchange_carries_page_content_when_versions_are_chosen(spark, monkeypatch):
    seen = []

    def spied(df, name):
        seen.append((name, plan(df)))
        return stage(df, name)

    monkeypatch.setattr(pages, "stage", spied)
    rows = [(f"https://h/?b={i}", 1, 200, "<table><tr><th>Date</th></tr><tr><td>2024-01-02</td></tr></table>", None) for i in range(9)]
    df = spark.createDataFrame(rows, PAGE_ROWS)
    latest = pages.latest_versions(pages.extract_pages(df, scraped_at=F.lit("")))
    assert [name for name, _ in seen] == ["extracted", "repeated"]
    assert "Exchange" not in seen[0][1] and "events" not in seen[1][1] and "project" not in seen[1][1]
    assert "Exchange" not in plan(latest) and "Join" not in plan(latest) and latest.count() == 9
    seen.clear()
    again = pages.latest_versions(pages.extract_pages(df.union(df.limit(2)).union(spark.createDataFrame([(None, 1, 200, "", None)] * 2, PAGE_ROWS)), scraped_at=F.lit("")))
    assert again.count() == 10 and again.columns == latest.columns


def test_the_report_does_not_read_the_records_again(spark, sf_dir):
    from recordmill.plans import records as job
    result = job.run_records(raw_records(spark, sf_dir))
    text = plan(result.report)
    assert "parse_failed" not in text and "rejection_reason" not in text
    evaluated = stage(dedup.with_group_columns(records.evaluate_records(raw_records(spark, sf_dir))), "evaluated")
    grouped = dedup.assign_duplicate_groups(records.split_rejects(evaluated)[0])
    assert result.report.collect() == quality.quality_report(evaluated, grouped).collect()


def test_numbers_are_given_without_another_exchange_of_rows(spark, valid):
    canonical = records.filter_canonical(dedup.assign_duplicate_groups(valid))
    numbered = numbering.assign_canonical_ids(canonical)
    text = plan(numbered)
    assert "rangepartitioning" not in text and "SortMergeJoin" not in text
    assert not [line for line in text.splitlines() if "Exchange" in line and "_part" not in line and "SinglePartition" not in line and "Broadcast" not in line]
    rows = numbered.select("canonical_id", "record_id", F.spark_partition_id().alias("p"), F.monotonically_increasing_id().alias("at")).orderBy("p", "at").collect()
    assert [r.canonical_id for r in rows] == [numbering.ID_FORMAT % n for n in range(1, len(rows) + 1)]
    assert [r.record_id for r in rows] == sorted(r.record_id for r in rows)
