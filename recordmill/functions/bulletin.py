"""Bulletin numbers and what is read from a seed URL's query string."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from recordmill.functions.strings import or_blank, strip, stripped
from recordmill.functions.urls import query_pairs, url_query

# Five digits, anything that is no letter or digit, two digits.
BULLETIN_PATTERN = r"^([0-9]{5})[^0-9A-Za-z]*([0-9]{2})\z"
BULLETIN_PARAMETER = "prmboletin"
FILE_NAME_LENGTH = 80


def normalize_bulletin(c: Column) -> Column:
    """``NNNNN-NN``, or blank when the value has another shape."""
    s = stripped(c)
    return F.when(
        s.rlike(BULLETIN_PATTERN), F.regexp_replace(s, BULLETIN_PATTERN, "$1-$2")
    ).otherwise(F.lit(""))


def bulletin_from_url(url: Column) -> Column:
    """First non-blank value of the bulletin parameter, in any letter case."""
    hits = F.filter(
        query_pairs(url_query(url)),
        lambda p: (F.lower(p["key"]) == BULLETIN_PARAMETER) & (p["raw_value"] != ""),
    )
    return or_blank(strip(F.try_element_at(hits, F.lit(1))["value"]))


def page_file_name(url: Column) -> Column:
    """File-safe name of a stored page: its bulletin, else its query string."""
    bulletin = bulletin_from_url(url)
    return F.concat(
        F.when(bulletin != "", _file_safe(bulletin)).otherwise(
            F.substring(_file_safe(url_query(url)), 1, FILE_NAME_LENGTH)
        ),
        F.lit(".html"),
    )


def _file_safe(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\p{L}\p{N}_\-]", "_")
