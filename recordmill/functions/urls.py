"""URL canonical form, built from JVM expressions only.

``parse_url`` rejects characters that are common in real links, so the parts are cut
at the first ``#``, ``?`` and ``/`` instead.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.strings import let, or_blank, stripped

# Query parameters that never identify a page.
TRACKING_PARAMS = [
    "utm_source", "utm_medium", "utm_campaign", "utm_term", "utm_content",
    "gclid", "fbclid",
]
# Schemes whose last path segment may carry ``;params``.
PARAM_SCHEMES = [
    "ftp", "hdl", "prospero", "http", "https", "shttp", "rtsp", "rtsps", "rtspu",
    "sip", "sips", "mms", "sftp", "tel",
]
# Scheme, network location, path, query and fragment of an absolute URL.
_ABSOLUTE = r"(?s)^([A-Za-z][A-Za-z0-9+.\-]*)://([^/?#]*)([^?#]*)(?:\?([^#]*))?(?:#(.*))?\z"
_CONTROLS = "".join(map(chr, range(33)))
# What may stand between brackets in a host: an IPv6 address or an IPvFuture literal.
_BRACKETED = (
    r"^(?:[^@]*@)*\[(?:(?=[^\]]*:[^\]]*:)[0-9A-Fa-f:.]+(?:%[^\]]+)?|[vV][0-9A-Fa-f]+\.[^\]]+)\](?::[^\[\]]*)?\z"
)


def _cut(c: Column, mark: str) -> tuple[Column, Column]:
    """The text before and after the first ``mark``; the second is blank without one."""
    head = F.substring_index(c, mark, 1)
    return head, F.substring(c, F.length(head) + 1 + len(mark), F.length(c))


def _clean(c: Column) -> Column:
    """Drop leading control characters and all tabs and line ends, as URL splitters do."""
    url = F.ltrim(c, F.lit(_CONTROLS))
    for mark in "\t\r\n":
        url = F.replace(url, F.lit(mark), F.lit(""))
    return url


def url_query(c: Column) -> Column:
    return _cut(_cut(_clean(or_blank(c)), "#")[0], "?")[1]


def _decode(c: Column) -> Column:
    """Percent and plus decoding; a ``%`` without two hex digits stands for itself."""
    return F.when(
        c.rlike("[%+]"), F.try_url_decode(F.regexp_replace(c, r"%(?![0-9A-Fa-f]{2})", "%25"))
    ).otherwise(c)


def _encode(c: Column) -> Column:
    """Form encoding with ``~`` kept and ``*`` escaped."""
    encoded = F.replace(
        F.replace(F.url_encode(c), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~")
    )
    return F.when(c.rlike(r"^[A-Za-z0-9_.~\-]*\z"), c).otherwise(encoded)


def query_pairs(query: Column) -> Column:
    """``array<struct<key,pos,value,raw_value>>`` of a query string, empty segments dropped."""

    def pair(segment: Column, pos: Column) -> Column:
        key, value = _cut(segment, "=")
        return F.struct(
            _decode(key).alias("key"),
            pos.alias("pos"),
            _decode(value).alias("value"),
            value.alias("raw_value"),
        )

    return F.transform(F.filter(F.split(query, "&"), lambda s: s != ""), pair)


def drop_tracking_params(pairs: Column) -> Column:
    return F.filter(pairs, lambda p: ~F.lower(p["key"]).isin(TRACKING_PARAMS))


def encode_pairs(pairs: Column) -> Column:
    """Pairs sorted by key, values of one key in their first order, encoded again."""
    return F.array_join(
        F.transform(
            F.sort_array(pairs),
            lambda p: F.concat(_encode(p["key"]), F.lit("="), _encode(p["value"])),
        ),
        "&",
    )


def canonical_query(query: Column) -> Column:
    q = or_blank(query)
    return F.when(q == "", F.lit("")).otherwise(
        encode_pairs(drop_tracking_params(query_pairs(q)))
    )


def url_origin(c: Column) -> Column:
    """``scheme://host`` of a URL, blank when it has none."""
    return F.regexp_extract(
        _clean(or_blank(c)), r"^([A-Za-z][A-Za-z0-9+.\-]*://[^/?#]*)", 1
    )


# Stem and parameters of a path with a semicolon in its last segment.
_PARAMS = r"^((?:.*/)?[^/;]*);([^/]*)\z"


def _without_end_slash(scheme: Column, path: Column) -> Column:
    """Path and ``;params``: slashes before the parameters, or at the end, are dropped.

    Empty parameters vanish, and a path that vanished before others keeps one slash.
    """

    def with_params(stem: Column, params: Column) -> Column:
        return (
            F.when(params == "", stem)
            .when(stem == "", F.concat(F.lit("/;"), params))
            .otherwise(F.concat(stem, F.lit(";"), params))
        )

    return F.when(
        F.contains(path, F.lit(";")) & path.rlike(_PARAMS) & scheme.isin(PARAM_SCHEMES),
        with_params(
            F.rtrim(F.regexp_extract(path, _PARAMS, 1), F.lit("/")),
            F.regexp_extract(path, _PARAMS, 2),
        ),
    ).otherwise(F.rtrim(path, F.lit("/")))


def url_parts(c: Column) -> Column:
    """Scheme, location, path, query and fragment of an absolute URL; one piece for other text."""
    # Cleaning left no line end, so it can part the pieces.
    return F.split(F.regexp_replace(_clean(stripped(c)), _ABSOLUTE, "$1\n$2\n$3\n$4\n$5"), "\n", -1)


def parts_query(parts: Column) -> Column:
    """The canonical query of a URL's parts, blank without one."""
    return F.when(
        (F.size(parts) == 5) & (F.get(parts, 3) != ""), canonical_query(F.get(parts, 3))
    ).otherwise(F.lit(""))


def url_from_parts(parts: Column, query: Column) -> Column:
    """Canonical form from ``url_parts`` and ``parts_query``; null for anything but an absolute URL."""
    part = lambda i: F.get(parts, i)  # noqa: E731  null where there is none, whatever is evaluated first
    scheme, netloc = F.lower(part(0)), F.lower(part(1))
    bracket = F.contains(netloc, F.lit("[")) | F.contains(netloc, F.lit("]"))
    return F.when(
        (F.size(parts) == 5) & (part(1) != ""),
        F.when(
            ~bracket | netloc.rlike(_BRACKETED),
            F.concat(
                scheme,
                F.lit("://"),
                netloc,
                _without_end_slash(scheme, part(2)),
                _prefixed("?", query),
                _prefixed("#", part(4)),
            ),
        ),
    )


def normalize_url(c: Column) -> Column:
    """Canonical form of an absolute URL, blank for anything else."""
    return or_blank(let(
        url_parts(c), lambda parts: let(parts_query(parts), lambda q: url_from_parts(parts, q))
    ))


def with_normalized_urls(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Adds the canonical form of URL columns, given as ``{new: old}``.

    As ``normalize_url``, but the pieces are columns between projections, so that all but the
    query's parameters is generated code.
    """
    parts, query = (lambda n: F.col(f"_parts_{n}")), (lambda n: F.col(f"_query_{n}"))
    return (
        df.withColumns({f"_parts_{n}": url_parts(F.col(old)) for n, old in columns.items()})
        .withColumns({f"_query_{n}": parts_query(parts(n)) for n in columns})
        .withColumns({n: or_blank(url_from_parts(parts(n), query(n))) for n in columns})
        .drop(*[f"_{kind}_{n}" for n in columns for kind in ("parts", "query")])
    )


def _prefixed(mark: str, c: Column) -> Column:
    return F.when(c == "", F.lit("")).otherwise(F.concat(F.lit(mark), c))
