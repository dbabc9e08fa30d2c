"""Counts of a run. Each is a partial aggregate, so no group size matters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.schema import PARSE_ERROR_FIELDS


def record_counts() -> list[Column]:
    """The aggregates over evaluated records that the report is made of."""
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(F.col("rejection_reason") != "").alias("rejected_rows"),
        *[F.count_if(F.col(f"parse_failed.{c}")).alias(f"_{c}") for c in PARSE_ERROR_FIELDS],
    ]


def parse_errors_by_field(evaluated: DataFrame) -> DataFrame:
    """One row: for each counted field, values that were given but could not be parsed."""
    return evaluated.agg(*[
        F.count_if(F.col(f"parse_failed.{c}")).alias(c) for c in PARSE_ERROR_FIELDS
    ])


def duplicate_group_sizes(grouped: DataFrame) -> DataFrame:
    """The size of each group. Two groups that share a published id give two rows."""
    return grouped.groupBy("group_digest").agg(
        F.first("duplicate_group_id").alias("duplicate_group_id"), F.count(F.lit(1)).alias("group_size")
    ).drop("group_digest")


def duplicates_removed(grouped: DataFrame) -> DataFrame:
    return grouped.agg(F.count_if(~F.col("is_canonical")).alias("duplicates_removed"))


def quality_report(evaluated: DataFrame, grouped: DataFrame, counted: dict[str, int] | None = None) -> DataFrame:
    """The one-row run report.

    ``counted`` holds the values of ``record_counts()`` if the job that wrote ``evaluated``
    observed them; its rows are not read again then.
    """
    groups = (
        grouped.groupBy("group_digest")
        .agg(
            F.count(F.lit(1)).alias("size"),
            F.count_if(F.col("is_canonical")).alias("kept"),
        )
        .agg(
            F.struct(
                F.coalesce(F.sum("kept"), F.lit(0)).alias("kept"),
                F.count_if(F.col("size") > 1).alias("multiple"),
                F.coalesce(F.sum(F.col("size") - F.col("kept")), F.lit(0)).alias("removed"),
            ).alias("totals")
        )
    )
    totals = groups.scalar()
    if counted is None:
        counts = evaluated.agg(*record_counts())
    else:
        counts = evaluated.sparkSession.range(1).select(*[F.lit(n).cast("long").alias(c) for c, n in counted.items()])
    return (
        counts.withColumn("_totals", totals)
        .select(
            "input_rows",
            F.col("_totals.kept").alias("normalized_rows"),
            "rejected_rows",
            F.col("_totals.multiple").alias("duplicate_groups"),
            F.col("_totals.removed").alias("duplicates_removed"),
            F.struct(*[F.col(f"_{c}").alias(c) for c in PARSE_ERROR_FIELDS]).alias(
                "parse_errors_by_field"
            ),
        )
    )
