"""Record and seed readers."""

from __future__ import annotations

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from recordmill.functions.strings import strip
from recordmill.operators.records import conform_schema
from recordmill.schema import PAGES_SCHEMA, RAW_COLUMNS


class InvalidEncodingError(ValueError):
    """An input file is not UTF-8."""


def invalid_utf8_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, line`` of every line that is not valid UTF-8, bytes repaired for display."""
    return (
        spark.read.text(path)
        .where(~F.is_valid_utf8("value"))
        .select(F.input_file_name().alias("file"), F.make_valid_utf8("value").alias("line"))
    )


def utf8_gate(
    spark: SparkSession, path: str | list[str], mode: str = "raise"
) -> DataFrame:
    """Check an input's encoding: raise if a line is bad, or return all bad lines.

    The CSV reader itself would silently put replacement characters in their place. Raising
    takes one aggregate over the whole input.
    """
    if mode not in ("raise", "quarantine"):
        raise ValueError("mode must be 'raise' or 'quarantine'")
    bad = invalid_utf8_lines(spark, path)
    if mode == "raise":
        _raise_for(bad.agg(F.min("file")).first()[0])
    return bad


def _raise_for(file: str | None) -> None:
    if file is not None:
        raise InvalidEncodingError(f"not valid UTF-8: {file}")


def file_headers(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``file, header, valid`` of each file that has a line: its first one, and whether all are UTF-8."""
    place = F.struct(F.col("_metadata.file_block_start"), F.monotonically_increasing_id())
    return (
        spark.read.text(path)
        .select("value", F.col("_metadata.file_path").alias("file"), place.alias("place"))
        .groupBy("file")
        .agg(F.min_by("value", "place").alias("header"), F.bool_and(F.is_valid_utf8("value")).alias("valid"))
    )


def _as_path(uri: str) -> str:
    """A file's name as a reader takes it: decoded, without meaning as a pattern."""
    return re.sub(r"([\\*?\[\]{}])", r"\\\1", unquote(uri))


def read_records(
    spark: SparkSession,
    path: str | list[str],
    multi_line: bool = True,
    check_encoding: bool = True,
) -> DataFrame:
    """Header CSV as text in the expected columns, which each file's own header names.

    One aggregate over the input's lines finds the headers, one row a file, and with
    ``check_encoding`` the encoding; files of one header are then read together, and lack a
    column as blanks. Quoted line ends need ``multi_line``, which makes each file one task:
    give many files, or pass ``multi_line=False`` for inputs without quoted line ends so that
    files split.
    """
    by_header: dict[str, list[str]] = {}
    for r in file_headers(spark, path).orderBy("file").collect():
        if check_encoding and not r.valid:
            _raise_for(r.file)
        by_header.setdefault(r.header, []).append(_as_path(r.file))
    parts = [
        conform_schema(
            spark.read.csv(
                files, header=True, multiLine=multi_line, quote='"', escape='"', enforceSchema=False,
                inferSchema=False, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
            )
        )
        for files in by_header.values()
    ]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame(
        [], ", ".join(f"{c} string" for c in RAW_COLUMNS))


def read_seeds(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``seed_no, seed_url`` of every line that is neither blank nor starts with ``#``.

    ``seed_no`` sorts in the order of files and lines. Repeated seeds stay.
    """
    place = F.struct(
        F.col("_metadata.file_path"), F.col("_metadata.file_block_start"), F.monotonically_increasing_id().alias("line"))
    return (
        spark.read.text(path)
        .withColumn("seed_no", place)
        .where((strip(F.col("value")) != "") & ~F.startswith("value", F.lit("#")))
        .select("seed_no", strip(F.col("value")).alias("seed_url"))
    )


def read_pages(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Stored result pages, one row for each seed and page number."""
    return spark.read.schema(PAGES_SCHEMA).parquet(*([path] if isinstance(path, str) else path))


def pages_from_urls(df: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """A plain ``url, html`` table as first result pages that were fetched well."""
    return df.select(
        F.col(url).alias("seed_url"),
        F.lit(1).alias("page_no"),
        F.lit(200).alias("http_status"),
        F.col(html).alias("html"),
        F.lit(None).cast("string").alias("fetch_error"),
    )
