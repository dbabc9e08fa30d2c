"""Row-wise operators on records: normalization, validation and routing.

Everything here is narrow. Text that holds markup and unusual dates share one Arrow
step; the rest are JVM expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.authors import normalize_authors
from recordmill.functions.bulletin import normalize_bulletin
from recordmill.functions.dates import (
    date_parts,
    date_pieces,
    finish_date,
    iso_from_parts,
    parse_other_date,
)
from recordmill.functions.strings import first_non_empty, not_blank, or_blank
from recordmill.functions.text import finish_text, parse_markup
from recordmill.functions.urls import parts_query, url_from_parts, url_parts
from recordmill.schema import (
    CANONICAL_COLUMNS,
    NORMALIZED_COLUMNS,
    PARSE_ERROR_FIELDS,
    RAW_COLUMNS,
    REJECTED_COLUMNS,
)

# Reasons of the reject table.
MISSING_TITLE = "missing_title"
MISSING_IDENTIFIERS = "missing_all_identifiers"
NORMALIZATION_ERROR = "normalization_error: "

# Raw column behind each normalized column whose parse failures are counted.
_COUNTED = {
    "bulletin_number": ("_raw_bulletin", "bulletin_number"),
    "published_at": ("published_at_raw", "published_at"),
    "event_date": ("event_date_raw", "event_date"),
    "url_raw": ("url_raw", "canonical_url"),
    "document_url_raw": ("document_url_raw", "canonical_document_url"),
}


def conform_schema(df: DataFrame) -> DataFrame:
    """The expected columns as text, in order: missing ones and nulls become blank."""
    return df.select(*[
        (or_blank(F.col(c).cast("string")) if c in df.columns else F.lit("")).alias(c)
        for c in RAW_COLUMNS
    ])


def _normalized(raw: DataFrame) -> DataFrame:
    """Normalized columns, the raw columns still needed, and ``_error``.

    Pieces are columns between projections, and what needs functions over arrays (authors, query
    parameters) has a projection of its own, so that the rest is generated code.
    """
    parsed = (
        conform_schema(raw)
        .withColumnsRenamed({"bulletin_number": "_raw_bulletin"})
        .withColumns({
            "_published": date_pieces(F.col("published_at_raw")),
            "_event": date_pieces(F.col("event_date_raw")),
            "_url": url_parts(F.col("url_raw")),
            "_document": url_parts(F.col("document_url_raw")),
        })
        .withColumns({
            "_title_parsed": parse_markup(F.col("title_raw")),
            "_summary_parsed": parse_markup(F.col("summary_raw")),
            "_published_parsed": parse_other_date(F.col("_published")),
            "_event_parsed": parse_other_date(F.col("_event")),
        })
        .withColumns({
            "_published_parts": date_parts(F.col("_published")),
            "_event_parts": date_parts(F.col("_event")),
            "_url_query": parts_query(F.col("_url")),
            "_document_query": parts_query(F.col("_document")),
            "authors": normalize_authors(F.col("authors_raw")),
        })
    )
    return parsed.withColumns({
        "bulletin_number": normalize_bulletin(F.col("_raw_bulletin")),
        "title": finish_text(F.col("title_raw"), F.col("_title_parsed")),
        "summary": finish_text(F.col("summary_raw"), F.col("_summary_parsed")),
        "published_at": finish_date(iso_from_parts(F.col("_published_parts")), F.col("_published_parsed")),
        "event_date": finish_date(iso_from_parts(F.col("_event_parts")), F.col("_event_parsed")),
        "status": F.col("status_raw"),
        "initiative": F.col("initiative_raw"),
        "canonical_url": or_blank(url_from_parts(F.col("_url"), F.col("_url_query"))),
        "canonical_document_url": or_blank(url_from_parts(F.col("_document"), F.col("_document_query"))),
        "_error": F.coalesce(*[
            F.col(f"_{c}_parsed.error") for c in ("title", "summary", "published", "event")
        ]),
    })


def normalize_records(raw: DataFrame) -> DataFrame:
    """Raw records to the normalized columns."""
    return _normalized(raw).select(*NORMALIZED_COLUMNS)


def rejection_reason(
    title: Column, url: Column, bulletin: Column, content_hash: Column
) -> Column:
    """Why a normalized record cannot be used; blank when it can."""
    return (
        F.when(~not_blank(title), F.lit(MISSING_TITLE))
        .when(
            ~(not_blank(url) | not_blank(bulletin) | not_blank(content_hash)),
            F.lit(MISSING_IDENTIFIERS),
        )
        .otherwise(F.lit(""))
    )


def validate_records(normalized: DataFrame) -> DataFrame:
    """Adds ``is_valid`` and ``rejection_reason``."""
    reason = rejection_reason(
        F.col("title"), F.col("canonical_url"),
        F.col("bulletin_number"), F.col("content_hash_hint"),
    )
    return normalized.withColumns({"is_valid": reason == "", "rejection_reason": reason})


def identifier_hint() -> Column:
    """First non-empty of normalized URL, bulletin and hash."""
    return first_non_empty(
        F.col("canonical_url"), F.col("bulletin_number"), F.col("content_hash_hint")
    )


def evaluate_records(raw: DataFrame) -> DataFrame:
    """One pass over raw records: normalized columns plus everything routing needs.

    Adds ``rejection_reason`` (blank for valid rows), ``raw_identifier_hint`` and
    ``parse_failed``, a struct of one flag for each counted field. A row whose
    normalization failed is rejected with the error and counts no parse failures.
    """
    df = _normalized(raw)
    failed = F.col("_error").isNotNull()
    return df.select(
        *NORMALIZED_COLUMNS,
        F.when(failed, F.concat(F.lit(NORMALIZATION_ERROR), F.col("_error"))).otherwise(
            rejection_reason(
                F.col("title"), F.col("canonical_url"),
                F.col("bulletin_number"), F.col("content_hash_hint"),
            )
        ).alias("rejection_reason"),
        F.when(
            failed, first_non_empty(F.col("url_raw"), F.col("_raw_bulletin"))
        ).otherwise(identifier_hint()).alias("raw_identifier_hint"),
        F.struct(*[
            (~failed & not_blank(F.col(before)) & (F.col(after) == "")).alias(name)
            for name, (before, after) in ((n, _COUNTED[n]) for n in PARSE_ERROR_FIELDS)
        ]).alias("parse_failed"),
    )


def split_rejects(evaluated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Valid normalized rows and the reject table. Stage the input first: it is read twice."""
    routing = {"rejection_reason", "raw_identifier_hint", "parse_failed"}
    valid = evaluated.where(F.col("rejection_reason") == "").select(
        *[c for c in evaluated.columns if c not in routing]
    )
    rejected = evaluated.where(F.col("rejection_reason") != "").select(*REJECTED_COLUMNS)
    return valid, rejected


def filter_canonical(grouped: DataFrame) -> DataFrame:
    return grouped.where(F.col("is_canonical"))


def project_output(df: DataFrame) -> DataFrame:
    """The canonical output columns in order; missing ones and nulls become blank."""
    return df.select(*[
        (or_blank(F.col(c).cast("string")) if c in df.columns else F.lit("")).alias(c)
        for c in CANONICAL_COLUMNS
    ])
