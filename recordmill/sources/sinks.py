"""Writers of the published tables. All overwrite, so a repeated run leaves one result."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from recordmill.functions.bulletin import page_file_name


def _write_csv(df: DataFrame, path: str) -> None:
    # Pass-through fields keep their spaces, and blanks stay unquoted.
    df.write.mode("overwrite").csv(
        path, header=True, quote='"', escape='"', emptyValue="",
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    )


def write_canonical(df: DataFrame, path: str) -> None:
    """Numbered canonical rows; part files follow the canonical order."""
    _write_csv(df, path)


def write_rejected(df: DataFrame, path: str) -> None:
    _write_csv(df, path)


def write_clusters(df: DataFrame, path: str) -> None:
    """Lineage rows; the flag is spelled ``True`` or ``False``."""
    _write_csv(df.withColumn("is_kept", F.initcap(F.col("is_kept").cast("string"))), path)


def _write_json(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path, ignoreNullFields=False)


def write_quality_report(df: DataFrame, path: str) -> None:
    """The one-row report as one indented JSON object."""
    df.select(
        F.to_json(F.struct("*"), {"pretty": "true", "ignoreNullFields": "false"}).alias("value")
    ).write.mode("overwrite").text(path)


def write_projects(df: DataFrame, path: str) -> None:
    _write_json(df, path)


def write_events(df: DataFrame, path: str) -> None:
    _write_json(df, path)


def write_extract_report(df: DataFrame, path: str) -> None:
    """JSON lines, one for each seed, in the order of the seed list (of the seeds without one)."""
    order = "seed_no" if "seed_no" in df.columns else "seed_url"
    _write_json(df.orderBy(order).drop("seed_no"), path)


def archive_pages(pages: DataFrame, path: str) -> None:
    """Raw pages with their file-safe name; every version is kept."""
    pages.withColumn("page_file", page_file_name(F.col("seed_url"))).write.mode(
        "overwrite"
    ).parquet(path)
