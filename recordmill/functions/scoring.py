"""How good a record is, and the stable identifier of its group."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.strings import not_blank, stripped

# Rank of a source type, lower is better.
SOURCE_TYPE_RANK = {"detail": 0, "table": 1, "api": 2, "news": 3, "misc": 4}
OTHER_SOURCE_RANK = 99
# Fields that count as content.
RELEVANT_FIELDS = [
    "canonical_url", "canonical_document_url",
    "title", "bulletin_number", "summary", "authors", "published_at",
    "event_date", "status", "initiative",
]


def source_rank(c: Column) -> Column:
    ranks = F.create_map(*[F.lit(x) for kv in SOURCE_TYPE_RANK.items() for x in kv])
    return F.coalesce(
        F.try_element_at(ranks, F.lower(stripped(c))), F.lit(OTHER_SOURCE_RANK)
    )


def richness(fields: list[Column] | None = None) -> Column:
    """Number of content fields that are not blank."""
    cols = [F.col(n) for n in RELEVANT_FIELDS] if fields is None else fields
    return sum((not_blank(c).cast("int") for c in cols), F.lit(0))


def best_date(published: Column, event: Column) -> Column:
    """The greater of two ISO strings; blank sorts lowest."""
    return F.greatest(stripped(published), stripped(event))


def stable_group_id(key: Column) -> Column:
    return F.concat(F.lit("GRP-"), F.upper(F.substring(F.md5(key), 1, 12)))
