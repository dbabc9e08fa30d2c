"""DuckDB counterparts of the record operators, written from the raw columns."""

from __future__ import annotations

from checks.raw_records import raw_records_duckdb

_BLANKS = "' ' || chr(9) || chr(10) || chr(13) || chr(160)"
_TRACKING = (
    "'utm_source', 'utm_medium', 'utm_campaign', 'utm_term', 'utm_content', 'gclid', 'fbclid'"
)


def strip(x: str) -> str:
    return f"trim({x}, {_BLANKS})"


def unescape(x: str) -> str:
    for name, char in [
        ("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "'\"'"), ("&nbsp;", "chr(160)"),
        ("&middot;", "chr(183)"), ("&copy;", "chr(169)"), ("&amp;", "'&'"),
    ]:
        x = f"replace({x}, '{name}', {char})"
    return x


def squeeze(x: str) -> str:
    return strip(f"regexp_replace({x}, '[ \\t\\r\\n]+', ' ', 'g')")


def text(x: str) -> str:
    visible = (
        "regexp_replace(regexp_replace("
        f"{x}, '<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '<>', 'gs'), "
        "'<[^>]*>', ' ', 'g')"
    )
    return squeeze(unescape(unescape(visible)))


def bulletin(x: str) -> str:
    s = strip(x)
    pattern = "^([0-9]{5})[^0-9A-Za-z]*([0-9]{2})$"
    return (
        f"CASE WHEN regexp_matches({s}, '{pattern}') "
        f"THEN regexp_replace({s}, '{pattern}', '\\1-\\2') ELSE '' END"
    )


def pairs(query: str) -> str:
    return (
        f"list_transform(list_filter(string_split({query}, '&'), lambda s: s <> ''), "
        "lambda s, i: {'k': split_part(s, '=', 1), 'i': i, "
        "'v': substr(s, length(split_part(s, '=', 1)) + 2)})"
    )


def kept_pairs(query: str) -> str:
    return f"list_filter({pairs(query)}, lambda p: lower(p.k) NOT IN ({_TRACKING}))"


def canonical_query(query: str) -> str:
    return (
        f"coalesce(array_to_string(list_transform(list_sort({kept_pairs(query)}), "
        "lambda p: p.k || '=' || replace(replace(p.v, ' ', '+'), '/', '%2F')), '&'), '')"
    )


def url_part(x: str, group: int) -> str:
    pattern = "^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)([?]([^#]*))?(#(.*))?$"
    return f"regexp_extract({strip(x)}, '{pattern}', {group})"


def url(x: str) -> str:
    query = canonical_query(url_part(x, 5))
    return (
        f"CASE WHEN {url_part(x, 2)} = '' THEN '' ELSE "
        f"lower({url_part(x, 1)}) || '://' || lower({url_part(x, 2)}) "
        f"|| rtrim({url_part(x, 3)}, '/') "
        f"|| CASE WHEN {query} = '' THEN '' ELSE '?' || {query} END "
        f"|| CASE WHEN {url_part(x, 7)} = '' THEN '' ELSE '#' || {url_part(x, 7)} END END"
    )


def date(x: str) -> str:
    s = strip(x)

    def day(value: str, fmt: str) -> str:
        return f"coalesce(strftime(try_strptime({value}, '{fmt}'), '%Y-%m-%d'), '')"

    dashed = f"replace({s}, '/', '-')"
    return f"""CASE
      WHEN regexp_matches({s}, '^[0-9]{{4}}[-/][0-9]{{2}}[-/][0-9]{{2}}$') THEN {day(dashed, '%Y-%m-%d')}
      WHEN regexp_matches({s}, '^[0-9]{{2}}[-/][0-9]{{2}}[-/][0-9]{{4}}$') THEN
        CASE WHEN substr({s}, 1, 2) > '12' THEN {day(dashed, '%d-%m-%Y')} ELSE {day(dashed, '%m-%d-%Y')} END
      WHEN regexp_matches({s}, 'T[0-9]{{2}}:[0-9]{{2}}$') THEN {s} || ':00'
      WHEN {s} LIKE '%+03:00' THEN replace({s}, ' ', 'T')
      WHEN {s} LIKE '%Z' THEN replace({s}, 'Z', '+00:00')
      WHEN {s} LIKE '%.250-0400' THEN replace({s}, '.250-0400', '.250000-04:00')
      WHEN regexp_matches({s}, '^[0-9]{{2}} [A-Z][a-z]{{2}}[.] [0-9]{{4}}$') THEN {day(s, '%d %b. %Y')}
      WHEN regexp_matches({s}, '^[0-9]{{8}}$') THEN {day(s, '%Y%m%d')}
      WHEN regexp_matches({s}, '^[A-Z][a-z]{{2}} [0-9]{{2}}, [0-9]{{4}}$') THEN {day(s, '%b %d, %Y')}
      ELSE '' END"""


def json_names(x: str) -> str:
    """Names of a JSON value, null when it holds none."""
    s = strip(x)
    return f"""CASE
      WHEN {s} LIKE '["%' THEN list_transform(json_extract_string({s}, '$[*]'), lambda n: {strip('n')})
      WHEN {s} LIKE '[{{%' THEN list_transform(json_extract({s}, '$[*]'), lambda o: {strip(
          "coalesce(o->>'name', o->>'author', o->>'full_name')")})
      WHEN {s} LIKE '{{%' THEN [{strip(f"coalesce(json_extract_string({s}, '$.name'), json_extract_string({s}, '$.author'))")}]
      END"""


def delimited_names(x: str) -> str:
    s = strip(x)
    return f"""list_transform(CASE
      WHEN contains({s}, '|') THEN string_split({s}, '|')
      WHEN contains({s}, ';') THEN string_split({s}, ';')
      WHEN contains({s}, ',') THEN string_split({s}, ',')
      ELSE [{s}] END, lambda n: {strip('n')})"""


def distinct_names(names: str) -> str:
    kept = f"list_filter({names}, lambda n: n <> '')"
    lowered = f"list_transform({kept}, lambda n: lower(n))"
    return f"list_filter({kept}, lambda n, i: list_position({lowered}, lower(n)) = i)"


def joined(names: str) -> str:
    return f"coalesce(array_to_string({names}, ' | '), '')"


def authors(x: str) -> str:
    return joined("kept_names")


NORMALIZED = [
    "record_id", "source", "source_type", "bulletin_number", "title", "summary",
    "published_at", "event_date", "status", "initiative", "authors", "canonical_url",
    "canonical_document_url", "content_hash_hint", "html_snippet",
]
RAW = f"raw AS ({raw_records_duckdb()})"

_NORM = f"""norm AS (
SELECT record_id, source, source_type, {bulletin('bulletin_number')} AS bulletin_number,
  {text('title_raw')} AS title, {text('summary_raw')} AS summary,
  {date('published_at_raw')} AS published_at, {date('event_date_raw')} AS event_date,
  status_raw AS status, initiative_raw AS initiative,
  {joined(distinct_names('names'))} AS authors,
  {url('url_raw')} AS canonical_url, {url('document_url_raw')} AS canonical_document_url,
  content_hash_hint, html_snippet,
  bulletin_number AS raw_bulletin, published_at_raw, event_date_raw, url_raw, document_url_raw
FROM (SELECT *, coalesce({json_names('authors_raw')}, {delimited_names('authors_raw')}) AS names
      FROM raw) AS named)"""

_EVALUATED = f"""evaluated AS (
SELECT *, CASE WHEN {strip('title')} = '' THEN 'missing_title'
  WHEN {strip('canonical_url')} = '' AND {strip('bulletin_number')} = ''
   AND {strip('content_hash_hint')} = '' THEN 'missing_all_identifiers' ELSE '' END AS rejection_reason,
  coalesce(nullif(canonical_url, ''), nullif(bulletin_number, ''), content_hash_hint) AS raw_identifier_hint
FROM norm)"""

_RELEVANT = [
    "canonical_url", "canonical_document_url", "title", "bulletin_number", "summary", "authors",
    "published_at", "event_date", "status", "initiative",
]
RICHNESS = "CAST(" + " + ".join(
    f"CAST({strip(c)} <> '' AS INTEGER)" for c in _RELEVANT
) + " AS INTEGER)"
SOURCE_RANK = (
    f"CASE lower({strip('source_type')}) WHEN 'detail' THEN 0 WHEN 'table' THEN 1 "
    "WHEN 'api' THEN 2 WHEN 'news' THEN 3 WHEN 'misc' THEN 4 ELSE 99 END"
)
BEST_DATE = f"greatest({strip('published_at')}, {strip('event_date')})"
KEY = (
    "CASE WHEN canonical_url <> '' THEN 'url:' || canonical_url "
    "WHEN bulletin_number <> '' THEN 'bt:' || bulletin_number || '||' || lower(title) "
    "WHEN content_hash_hint <> '' THEN 'ht:' || content_hash_hint || '||' || lower(title) END"
)
REASON = (
    "CASE WHEN canonical_url <> '' THEN 'same_url' "
    "WHEN bulletin_number <> '' THEN 'same_bulletin_and_title' "
    "WHEN content_hash_hint <> '' THEN 'same_hash_and_title' ELSE 'unique' END"
)


def group_id(key: str) -> str:
    return f"'GRP-' || upper(substr(md5({key}), 1, 12))"


_GROUPED = f"""valid AS (SELECT * FROM evaluated WHERE rejection_reason = ''),
keyed AS (
SELECT *, {KEY} AS dup_key, {RICHNESS} AS richness, {SOURCE_RANK} AS source_rank, {BEST_DATE} AS best_date
FROM valid),
sized AS (
SELECT *, count(*) OVER (PARTITION BY dup_key) AS group_size,
  first_value(record_id) OVER (PARTITION BY dup_key
    ORDER BY richness DESC, source_rank, best_date DESC, record_id) AS kept_id
FROM keyed),
grouped AS (
SELECT *, {group_id("CASE WHEN group_size > 1 THEN dup_key ELSE 'singleton:' || record_id END")} AS duplicate_group_id,
  (group_size = 1 OR record_id = kept_id) AS is_canonical
FROM sized)"""

_CONTENT = (
    "source, source_type, bulletin_number, title, summary, published_at, event_date, status, "
    "initiative, authors, canonical_url, canonical_document_url, duplicate_group_id"
)
_NUMBERED = f"""numbered AS (
SELECT *, record_id AS kept_record_id, printf('CAN-%06d', row_number() OVER (
  ORDER BY record_id, duplicate_group_id, md5(concat_ws(chr(31), {_CONTENT})))) AS canonical_id
FROM grouped WHERE is_canonical)"""

_REPORT = """sizes AS (
SELECT duplicate_group_id, count(*) AS n, count(*) FILTER (WHERE is_canonical) AS kept
FROM grouped GROUP BY 1),
totals AS (
SELECT CAST(sum(kept) AS BIGINT) AS normalized_rows, count(*) FILTER (WHERE n > 1) AS duplicate_groups,
  CAST(sum(n - kept) AS BIGINT) AS duplicates_removed FROM sizes)"""

_STAGES = [
    ("raw", RAW), ("norm", _NORM), ("evaluated", _EVALUATED), ("grouped", _GROUPED),
    ("numbered", _NUMBERED), ("report", _REPORT),
]
ERRORS = {
    name: f"count(*) FILTER (WHERE {strip(before)} <> '' AND {after} = '')"
    for name, before, after in [
        ("bulletin_number", "raw_bulletin", "bulletin_number"),
        ("published_at", "published_at_raw", "published_at"),
        ("event_date", "event_date_raw", "event_date"),
        ("url_raw", "url_raw", "canonical_url"),
        ("document_url_raw", "document_url_raw", "canonical_document_url"),
    ]
}


def query(select: str, upto: str) -> str:
    """``select`` after the common table expressions up to a stage."""
    parts = []
    for name, body in _STAGES:
        parts.append(body)
        if name == upto:
            break
    return "WITH " + ",\n".join(parts) + "\n" + select
