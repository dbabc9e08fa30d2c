"""The record job: raw records in, canonical table, rejects, lineage and report out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession

from recordmill.operators.dedup import (
    assign_duplicate_groups,
    duplicate_clusters,
    grouped_columns,
    with_group_columns,
)
from recordmill.operators.numbering import assign_canonical_ids
from recordmill.operators.quality import quality_report, record_counts
from recordmill.operators.records import (
    evaluate_records,
    filter_canonical,
    project_output,
    split_rejects,
)
from recordmill.sources import sinks
from recordmill.sources.records import read_records
from recordmill.staging import Run, files_key, stage


@dataclass(frozen=True)
class RecordResult:
    canonical: DataFrame
    rejected: DataFrame
    clusters: DataFrame
    report: DataFrame


def run_records(raw: DataFrame, run: Run | None = None) -> RecordResult:
    """Run the job on raw records.

    Normalization and the group join run once each: both results are staged, because
    several outputs read them. The job that writes the records also counts them for the
    report. The HTML snippet is in no output and is left out.

    With a ``run`` both tables are named, and those that an earlier run of that name and key
    has finished are read, not written; the counts then come from the written records.
    """
    counts = Observation("records")
    rows = with_group_columns(evaluate_records(raw)).drop("html_snippet")
    staged = run.stage if run else stage
    evaluated = run.finished(rows, "evaluated") if run else None
    counted = evaluated is None
    if counted:
        evaluated = staged(rows.observe(counts, *record_counts()), "evaluated")
    valid, rejected = split_rejects(evaluated)
    grouped = run.finished(grouped_columns(valid), "grouped") if run else None
    if grouped is None:
        grouped = staged(assign_duplicate_groups(valid), "grouped")
    return RecordResult(
        canonical=project_output(assign_canonical_ids(filter_canonical(grouped))),
        rejected=rejected,
        clusters=duplicate_clusters(grouped),
        report=quality_report(evaluated, grouped, counts.get if counted else None),
    )


def write_records(result: RecordResult, folder: str) -> None:
    # Names of the outputs.
    sinks.write_canonical(result.canonical, f"{folder}/normalized_records.csv")
    sinks.write_rejected(result.rejected, f"{folder}/rejected_records.csv")
    sinks.write_clusters(result.clusters, f"{folder}/duplicate_clusters.csv")
    sinks.write_quality_report(result.report, f"{folder}/quality_report.json")


def record_job(
    spark: SparkSession, path: str, folder: str, multi_line: bool = True, run: str | None = None
) -> RecordResult:
    """From CSV files to the four written outputs.

    With the name of a ``run``, a job that failed goes on after its last finished table when it
    is called again; files that have changed since start it anew.
    """
    named = Run(spark, run, files_key(spark, path, "records", multi_line)) if run else None
    result = run_records(read_records(spark, path, multi_line=multi_line), named)
    write_records(result, folder)
    return result
