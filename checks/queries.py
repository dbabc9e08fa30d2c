"""The registered queries: each runs one operator over whole test tables.

Every entry has a Spark builder; ``ORACLE`` holds the DuckDB text with the same columns.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from checks import record_sql as q
from checks.raw_records import raw_records, raw_records_duckdb, table
from checks.seed_pages import expected, page_seeds, seed_pages
from recordmill.functions import authors as au
from recordmill.functions import bulletin as bu
from recordmill.functions import dates, outline, scoring, text, urls
from recordmill.operators import dedup, numbering, pages, quality, records
from recordmill.plans.pages import in_seed_order, run_pages
from recordmill.plans.records import run_records
from recordmill.schema import (
    CANONICAL_COLUMNS,
    CLUSTER_COLUMNS,
    EVENT_COLUMNS,
    PARSE_ERROR_FIELDS,
    PROJECT_COLUMNS,
    RAW_COLUMNS,
)
from recordmill.sources import records as readers
from recordmill.sources import sinks
from recordmill.staging import checkpoint_dir, stage

Builder = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Builder] = {}
ORACLE: dict[str, str] = {}


def register(oracle: str | None):
    def add(build: Builder) -> Builder:
        QUERIES[build.__name__] = build
        if oracle is not None:
            ORACLE[build.__name__] = oracle
        return build

    return add


def _sql(columns: list[str]) -> str:
    return ", ".join(columns)


# --- scalar functions -------------------------------------------------------------------


@register(
    f"SELECT page_id AS id, 'page' AS kind, {q.text('html')} AS value FROM pages "
    f"UNION ALL SELECT doc_id, 'document', {q.text('text')} FROM documents "
    "UNION ALL SELECT doc_id, 'hidden', lang || ' tail ' || source FROM documents"
)
def normalize_text(spark, sf):
    """Pages, plain texts, and hidden elements that only an outer element's end closes."""
    hidden = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit("hidden").alias("kind"),
        F.format_string(
            "<div><template>x%s</div><ruby>%s<rt>%s<rp>(</ruby> tail <p>%s</p>", "source", "lang", "source", "source"
        ).alias("raw"))
    markup = table(spark, sf, "pages").select(
        F.col("page_id").alias("id"), F.lit("page").alias("kind"), F.col("html").alias("raw")
    )
    plain = table(spark, sf, "documents").select(
        F.col("doc_id").alias("id"), F.lit("document").alias("kind"), F.col("text").alias("raw")
    )
    return markup.unionByName(plain).unionByName(hidden).select(
        "id", "kind", text.normalize_text(F.col("raw")).alias("value")
    )


def _scalar(raw_column: str, function):
    def build(spark, sf):
        return raw_records(spark, sf).select(
            "record_id", F.col(raw_column).alias("raw"),
            function(F.col(raw_column)).alias("value"),
        )

    return build


def _scalar_pair(name: str, raw_column: str, function, value_sql: str) -> None:
    build = _scalar(raw_column, function)
    build.__name__ = name
    register(
        f"WITH {q.RAW} SELECT record_id, {raw_column} AS raw, {value_sql} AS value FROM raw"
    )(build)


_scalar_pair("normalize_bulletin", "bulletin_number", bu.normalize_bulletin,
             q.bulletin("bulletin_number"))
_scalar_pair("source_rank", "source_type", scoring.source_rank, q.SOURCE_RANK)
_scalar_pair("stable_group_id", "url_raw", scoring.stable_group_id, q.group_id("url_raw"))
_scalar_pair(
    "authors_from_delimited", "authors_raw",
    lambda c: F.array_join(au.authors_from_delimited(c), "/"),
    f"array_to_string({q.delimited_names('authors_raw')}, '/')",
)
_scalar_pair(
    "dedup_ci_ordered", "authors_raw",
    lambda c: F.array_join(au.dedup_ci_ordered(F.split(c, "[|;,] ?")), "/"),
    "coalesce(array_to_string("
    + q.distinct_names("regexp_split_to_array(authors_raw, '[|;,] ?')") + ", '/'), '')",
)
_scalar_pair(
    "split_people", "authors_raw", lambda c: F.array_join(au.split_people(c), "/"),
    "coalesce(array_to_string(list_filter(list_transform(regexp_split_to_array(authors_raw, '[;,\\n]'), "
    f"lambda n: {q.strip('n')}), lambda n: n <> ''), '/'), '')",
)


@register(
    f"WITH {q.RAW} SELECT record_id, 'url' AS field, {q.url('url_raw')} AS value FROM raw "
    f"UNION ALL SELECT record_id, 'document', {q.url('document_url_raw')} FROM raw "
    f"UNION ALL SELECT url, 'page', {q.url('url')} FROM pages"
)
def normalize_url(spark, sf):
    raw = raw_records(spark, sf)
    fields = [("url", "url_raw"), ("document", "document_url_raw")]
    by_record = raw.select(
        "record_id",
        F.explode(F.array(*[
            F.struct(F.lit(name).alias("field"), F.col(c).alias("raw")) for name, c in fields
        ])).alias("f"),
    ).select("record_id", "f.*")
    by_page = table(spark, sf, "pages").select(
        F.col("url").alias("record_id"), F.lit("page").alias("field"), F.col("url").alias("raw"))
    given = by_record.unionByName(by_page)
    return urls.with_normalized_urls(given, {"value": "raw"}).drop("raw")


_QUERY = "regexp_extract(document_url_raw, '[?]([^#]*)', 1)"


@register(
    f"WITH {q.RAW} SELECT record_id, coalesce(array_to_string(list_transform("
    f"{q.kept_pairs(_QUERY)}, lambda p: p.k || '=' || p.v), '&'), '') AS value FROM raw"
)
def drop_tracking_params(spark, sf):
    pairs = urls.query_pairs(urls.url_query(F.col("document_url_raw")))
    return raw_records(spark, sf).select(
        "record_id",
        F.array_join(
            F.transform(
                urls.drop_tracking_params(pairs),
                lambda p: F.concat(p["key"], F.lit("="), p["value"]),
            ),
            "&",
        ).alias("value"),
    )


@register(f"WITH {q.RAW} SELECT record_id, {q.canonical_query(_QUERY)} AS value FROM raw")
def canonical_query(spark, sf):
    return raw_records(spark, sf).select(
        "record_id",
        urls.canonical_query(urls.url_query(F.col("document_url_raw"))).alias("value"),
    )


@register(
    f"WITH {q.RAW} SELECT record_id, {q.date('published_at_raw')} AS published_at, "
    f"{q.date('event_date_raw')} AS event_date FROM raw"
)
def normalize_date(spark, sf):
    return raw_records(spark, sf).select(
        "record_id",
        dates.normalize_date(F.col("published_at_raw")).alias("published_at"),
        dates.normalize_date(F.col("event_date_raw")).alias("event_date"),
    )


@register(q.query("SELECT record_id, authors AS value FROM norm", "norm"))
def normalize_authors(spark, sf):
    return raw_records(spark, sf).select(
        "record_id", au.normalize_authors(F.col("authors_raw")).alias("value")
    )


@register(
    f"WITH {q.RAW} SELECT record_id, array_to_string({q.json_names('authors_raw')}, '/') AS value FROM raw"
)
def authors_from_json(spark, sf):
    return raw_records(spark, sf).select(
        "record_id", F.array_join(au.authors_from_json(F.col("authors_raw")), "/").alias("value")
    )


@register(expected("SELECT seed_url, bulletin AS value FROM seeds"))
def bulletin_from_url(spark, sf):
    return page_seeds(spark, sf).select(
        "seed_url", bu.bulletin_from_url(F.col("seed_url")).alias("value")
    )


@register(expected(
    "SELECT seed_url, CASE WHEN bulletin <> '' THEN bulletin "
    "ELSE 'prmBoletin__q_a_b_' || c END || '.html' AS value FROM seeds"
))
def page_file_name(spark, sf):
    return page_seeds(spark, sf).select(
        "seed_url", bu.page_file_name(F.col("seed_url")).alias("value")
    )


@register(
    "SELECT page_id, " + q.squeeze(q.unescape(
        "regexp_replace(regexp_replace(html, "
        "'<!--.*?-->|<script[^>]*>.*?</script>|<style[^>]*>.*?</style>', '<>', 'gs'), '<[^>]*>', ' ', 'g')"
    )) + " AS value FROM pages"
)
def clean_node_text(spark, sf):
    return table(spark, sf, "pages").select(
        "page_id", outline.clean_node_text(F.col("html")).alias("value")
    )


# --- records ----------------------------------------------------------------------------


@register(
    f"WITH {q.RAW} SELECT " + _sql([c if c != "scraped_at" else "'' AS scraped_at" for c in RAW_COLUMNS])
    + " FROM raw"
)
def conform_schema(spark, sf):
    return records.conform_schema(raw_records(spark, sf))


@register(q.query(f"SELECT {_sql(q.NORMALIZED)} FROM norm", "norm"))
def normalize_records(spark, sf):
    return records.normalize_records(raw_records(spark, sf))


def _normalized(spark, sf):
    return records.normalize_records(raw_records(spark, sf))


def _evaluated(spark, sf):
    return records.evaluate_records(raw_records(spark, sf))


def _valid(spark, sf):
    """Valid records, staged: the group operators read them more than once."""
    return records.split_rejects(stage(_evaluated(spark, sf), "evaluated"))[0]


def _grouped(spark, sf):
    return dedup.assign_duplicate_groups(_valid(spark, sf))


@register(q.query(
    "SELECT record_id, title, rejection_reason = '' AS is_valid, rejection_reason FROM evaluated",
    "evaluated"))
def validate_records(spark, sf):
    return records.validate_records(_normalized(spark, sf)).select(
        "record_id", "title", "is_valid", "rejection_reason"
    )


@register(q.query("SELECT record_id, raw_identifier_hint AS value FROM evaluated", "evaluated"))
def identifier_hint(spark, sf):
    return _normalized(spark, sf).select("record_id", records.identifier_hint().alias("value"))


@register(q.query(
    "SELECT record_id, rejection_reason, raw_identifier_hint FROM evaluated "
    "WHERE rejection_reason <> '' UNION ALL "
    "SELECT record_id, 'valid', title FROM evaluated WHERE rejection_reason = ''", "evaluated"))
def split_rejects(spark, sf):
    valid, rejected = records.split_rejects(stage(_evaluated(spark, sf), "evaluated"))
    return rejected.unionByName(valid.select(
        "record_id", F.lit("valid").alias("rejection_reason"),
        F.col("title").alias("raw_identifier_hint"),
    ))


@register(
    f"WITH {q.RAW} SELECT record_id, "
    "'normalization_error: AssertionError: unknown status keyword ''' || trim(status_raw) "
    "|| ''' in marked section' AS rejection_reason, "
    "CASE WHEN url_raw <> '' THEN url_raw ELSE bulletin_number END AS raw_identifier_hint, "
    "CAST(0 AS BIGINT) AS parse_errors FROM raw"
)
def row_error_capture(spark, sf):
    """Every title becomes markup the tokenizer refuses; every row must come out rejected."""
    broken = raw_records(spark, sf).withColumn(
        "title_raw",
        F.concat(F.lit("<!["), F.trim("status_raw"), F.lit("["), F.col("title_raw"), F.lit("]]>")),
    )
    failed = sum(
        (F.col(f"parse_failed.{c}").cast("bigint") for c in PARSE_ERROR_FIELDS),
        F.lit(0).cast("bigint"),
    )
    return records.evaluate_records(broken).select(
        "record_id", "rejection_reason", "raw_identifier_hint", failed.alias("parse_errors")
    )


@register(q.query(f"SELECT record_id, title, {q.RICHNESS} AS value FROM norm", "norm"))
def richness(spark, sf):
    return _normalized(spark, sf).select("record_id", "title", scoring.richness().alias("value"))


@register(q.query(f"SELECT record_id, title, {q.BEST_DATE} AS value FROM norm", "norm"))
def best_date(spark, sf):
    return _normalized(spark, sf).select(
        "record_id", "title",
        scoring.best_date(F.col("published_at"), F.col("event_date")).alias("value"),
    )


# --- duplicate groups -------------------------------------------------------------------


@register(q.query("SELECT record_id, title, dup_key AS value FROM keyed", "grouped"))
def duplicate_key(spark, sf):
    return _valid(spark, sf).select("record_id", "title", dedup.duplicate_key().alias("value"))


@register(q.query(
    f"SELECT {_sql(q.NORMALIZED)}, duplicate_group_id, is_canonical FROM grouped", "grouped"))
def assign_duplicate_groups(spark, sf):
    return _grouped(spark, sf).drop("group_digest")


@register(q.query(
    "SELECT duplicate_group_id, group_size, min(kept_id) AS kept_record_id FROM grouped "
    "WHERE group_size > 1 GROUP BY 1, 2", "grouped"))
def select_canonical(spark, sf):
    return dedup.select_canonical(_valid(spark, sf))


@register(q.query(
    f"SELECT duplicate_group_id, record_id, is_canonical AS is_kept, {q.REASON} AS duplicate_reason "
    "FROM grouped", "grouped"))
def duplicate_clusters(spark, sf):
    return dedup.duplicate_clusters(_grouped(spark, sf))


@register(q.query("SELECT record_id, title, canonical_url FROM grouped WHERE is_canonical", "grouped"))
def filter_canonical(spark, sf):
    return records.filter_canonical(_grouped(spark, sf)).select("record_id", "title", "canonical_url")


# --- counts -----------------------------------------------------------------------------


@register(q.query(
    "SELECT " + ", ".join(f"{e} AS {n}" for n, e in q.ERRORS.items()) + " FROM norm", "norm"))
def parse_errors_by_field(spark, sf):
    return quality.parse_errors_by_field(_evaluated(spark, sf))


@register(q.query(
    "SELECT duplicate_group_id, count(*) AS group_size FROM grouped GROUP BY 1", "grouped"))
def duplicate_group_sizes(spark, sf):
    return quality.duplicate_group_sizes(_grouped(spark, sf))


@register(q.query("SELECT duplicates_removed FROM totals", "report"))
def duplicates_removed(spark, sf):
    return quality.duplicates_removed(_grouped(spark, sf))


def _flat_report(report: DataFrame) -> DataFrame:
    return report.select(
        "input_rows", "normalized_rows", "rejected_rows", "duplicate_groups", "duplicates_removed",
        *[F.col(f"parse_errors_by_field.{c}").alias(f"errors_{c}") for c in PARSE_ERROR_FIELDS],
    )


_REPORT_SQL = q.query(
    "SELECT (SELECT count(*) FROM norm) AS input_rows, normalized_rows, "
    "(SELECT count(*) FROM evaluated WHERE rejection_reason <> '') AS rejected_rows, "
    "duplicate_groups, duplicates_removed, "
    + ", ".join(f"(SELECT {e} FROM norm) AS errors_{n}" for n, e in q.ERRORS.items())
    + " FROM totals", "report")


@register(_REPORT_SQL)
def quality_report(spark, sf):
    evaluated = stage(_evaluated(spark, sf), "evaluated")
    grouped = dedup.assign_duplicate_groups(records.split_rejects(evaluated)[0])
    return _flat_report(quality.quality_report(evaluated, grouped))


# --- order and numbers ------------------------------------------------------------------

_NUMBERED_SQL = q.query(f"SELECT {_sql(CANONICAL_COLUMNS)} FROM numbered", "numbered")


@register(q.query(
    "SELECT record_id, title, duplicate_group_id FROM grouped WHERE is_canonical ORDER BY 1, 3", "grouped"))
def order_canonical(spark, sf):
    canonical = records.filter_canonical(_grouped(spark, sf))
    return numbering.order_canonical(canonical).select("record_id", "title", "duplicate_group_id")


@register(q.query(
    "SELECT canonical_id, kept_record_id, title, duplicate_group_id FROM numbered", "numbered"))
def assign_canonical_ids(spark, sf):
    canonical = records.filter_canonical(_grouped(spark, sf)).drop("html_snippet", "content_hash_hint")
    return numbering.assign_canonical_ids(canonical).select(
        "canonical_id", "kept_record_id", "title", "duplicate_group_id"
    )


@register(q.query(
    "SELECT '' AS canonical_id, '' AS kept_record_id, "
    + _sql(CANONICAL_COLUMNS[2:]) + " FROM grouped WHERE is_canonical", "grouped"))
def project_output(spark, sf):
    return records.project_output(records.filter_canonical(_grouped(spark, sf)))


@register(_NUMBERED_SQL)
def record_job(spark, sf):
    return run_records(raw_records(spark, sf)).canonical


@register(_REPORT_SQL)
def record_job_report(spark, sf):
    return _flat_report(run_records(raw_records(spark, sf)).report)


# --- pages ------------------------------------------------------------------------------

_SCRAPED = "2024-01-01T00:00:00+00:00"


def _outlined(spark, sf, labels=(), **facts):
    """Outlines of the fetched pages: the project with these labels, or the events."""
    stored = pages.outline_pages(seed_pages(spark, sf), labels=list(labels), **facts).where(F.col("fetched"))
    return stored.where(F.col("version") == 1)


def _projects(spark, sf, labels=()):
    return _outlined(spark, sf, labels, events=F.lit(False))


def _events(spark, sf):
    return _outlined(spark, sf, project=F.lit(False))


def _extracted(spark, sf):
    extracted = pages.extract_pages(seed_pages(spark, sf), scraped_at=F.lit(_SCRAPED))
    return pages.latest_versions(extracted)


def _page():
    return F.col("outline")


@register(
    "SELECT url AS seed_url, 1 AS page_no, 200 AS http_status, html, CAST(NULL AS VARCHAR) AS fetch_error FROM pages"
)
def read_pages(spark, sf):
    folder = _folder(spark)
    readers.pages_from_urls(table(spark, sf, "pages")).write.parquet(folder)
    return readers.read_pages(spark, folder)


@register(
    "SELECT url AS seed_url, "
    + q.squeeze(q.unescape("regexp_replace(regexp_extract(html, '<h1>(.*?)</h1>', 1), '<[^>]*>', ' ', 'g')"))
    + " AS title, url AS detail_url, 0 AS events FROM pages"
)
def extract_web_pages(spark, sf):
    """The stored web pages: headings but no labels and no tables."""
    found = pages.extract_pages(readers.pages_from_urls(table(spark, sf, "pages")))
    return found.select(
        "seed_url", "project.title", "project.detail_url", F.size("events").alias("events")
    )


@register(expected("SELECT seed_url, page_no, title AS value FROM facts WHERE NOT broken"))
def project_title(spark, sf):
    return _projects(spark, sf, [pages.TITLE_LABEL]).select(
        "seed_url", "page_no", pages.project_title(_page()).alias("value"))


@register(expected("SELECT seed_url, page_no, detail_url AS value FROM facts WHERE NOT broken"))
def project_detail_url(spark, sf):
    return _projects(spark, sf).select(
        "seed_url", "page_no",
        pages.project_detail_url(_page(), F.col("seed_url")).alias("value"))


@register(expected(
    "SELECT seed_url, page_no, CASE WHEN c % 3 = 0 THEN status ELSE '' END AS estado, "
    "CASE WHEN c % 3 = 1 THEN authors[1] || ',' || authors[2] ELSE '' END AS autores "
    "FROM facts WHERE NOT broken"
))
def label_value(spark, sf):
    return _projects(spark, sf, ["ESTADO", "Autores"]).select(
        "seed_url", "page_no",
        pages.label_value(_page(), "ESTADO").alias("estado"),
        pages.label_value(_page(), "Autores").alias("autores"))


@register(expected(
    "SELECT seed_url, page_no, legislature, entry_date, status, initiative, origin_chamber "
    "FROM facts WHERE NOT broken"))
def project_fields(spark, sf):
    labels = [label for names in pages.FIELD_LABELS.values() for label in names]
    return _projects(spark, sf, labels).select(
        "seed_url", "page_no",
        *[c.alias(n) for n, c in pages.project_fields(_page()).items()])


@register(expected(
    "SELECT seed_url, page_no, coalesce(array_to_string(authors, '/'), '') AS value "
    "FROM facts WHERE NOT broken"))
def project_authors(spark, sf):
    return _projects(spark, sf, pages.AUTHOR_LABELS).select(
        "seed_url", "page_no", F.array_join(pages.project_authors(_page()), "/").alias("value"))


@register(expected(
    "SELECT seed_url, page_no, CASE WHEN dated > 0 THEN tables_before "
    "WHEN c % 5 = 0 THEN tables_before + 1 END AS value FROM facts WHERE NOT broken"))
def pick_event_table(spark, sf):
    return _events(spark, sf).select("seed_url", "page_no", F.col("event_table").alias("value"))


@register(expected(
    "SELECT p.seed_url, p.page_no, CASE WHEN p.dated = 0 AND p.c % 5 = 0 THEN 1 ELSE count(r.o) END AS data_rows "
    "FROM page_facts p LEFT JOIN page_orders r ON r.c = p.c AND r.page_no = p.page_no AND r.o >= p.first_o "
    "WHERE NOT broken GROUP BY p.seed_url, p.page_no, p.dated, p.c"))
def event_row_filter(spark, sf):
    """Data rows of the chosen table; none without one."""
    rows = pages.event_row_filter(pages.table_rows(_page(), F.col("event_table")))
    return _events(spark, sf).select(
        "seed_url", "page_no",
        F.when(F.col("event_table").isNull(), 0).otherwise(F.size(rows)).cast("bigint").alias("data_rows"))


_EVENT_VALUES = [c for c in EVENT_COLUMNS if c not in ("seed_url", "bulletin_number", "row_order")]


@register(expected(f"SELECT seed_url, page_no, {_sql(_EVENT_VALUES)} FROM all_events"))
def event_columns(spark, sf):
    candidates = pages.event_candidates(_page(), F.col("event_table"))
    return _events(spark, sf).select(
        "seed_url", "page_no", F.inline(candidates)
    ).select("seed_url", "page_no", *_EVENT_VALUES)


_GOOD = "c NOT IN (SELECT c FROM bad_seeds)"


@register(expected(
    f"SELECT {_sql([c for c in PROJECT_COLUMNS if c not in ('authors', 'scraped_at')])}, "
    f"coalesce(array_to_string(authors, '/'), '') AS authors, '{_SCRAPED}' AS scraped_at "
    f"FROM facts WHERE page_no = 1 AND {_GOOD}"))
def extract_projects(spark, sf):
    return pages.extract_projects(_extracted(spark, sf)).withColumn(
        "authors", F.array_join("authors", "/"))


@register(expected(f"SELECT {_sql(EVENT_COLUMNS)} FROM all_events WHERE {_GOOD}"))
def extract_events(spark, sf):
    return pages.extract_events(_extracted(spark, sf))


@register(expected(f"SELECT page_no, {_sql(EVENT_COLUMNS)} FROM all_events WHERE {_GOOD}"))
def union_pages(spark, sf):
    return pages.union_pages(_extracted(spark, sf)).select("page_no", *EVENT_COLUMNS)


_PAGE_REPORT = """
, per_seed AS (
  SELECT s.c, s.seed_url, s.c % 17 NOT IN (3, 4, 6, 7) AS fetch_ok,
    s.c NOT IN (SELECT c FROM bad_seeds) AS good,
    (SELECT count(*) FROM all_events e WHERE e.c = s.c) AS n
  FROM seeds s WHERE s.c IN (SELECT c FROM wanted)),
page_report AS (
  SELECT seed_url, fetch_ok, good AS parse_ok,
    CAST(CASE c % 17 WHEN 3 THEN 404 WHEN 6 THEN 500 WHEN 4 THEN NULL WHEN 7 THEN NULL ELSE 200 END AS INTEGER)
      AS http_status,
    CAST(CASE WHEN good THEN n ELSE 0 END AS INTEGER) AS row_count,
    CASE WHEN c % 17 = 3 THEN 'HTTPError 404: Not Found' WHEN c % 17 = 4 THEN 'timed out'
         WHEN c % 17 = 6 THEN 'HTTPError 500: ' WHEN c % 17 = 7 THEN 'no first page'
         WHEN NOT good THEN 'Parse error: Invalid IPv6 URL' END AS error_message
  FROM per_seed)
"""


@register(expected(_PAGE_REPORT + "SELECT * FROM page_report"))
def extract_report(spark, sf):
    return pages.extract_report(_extracted(spark, sf))


@register(expected(
    _PAGE_REPORT + "SELECT count(*) FILTER (WHERE fetch_ok AND parse_ok) AS seeds_ok, "
    "count(*) AS seeds, CAST(sum(row_count) AS BIGINT) AS events FROM page_report"))
def extract_summary(spark, sf):
    return pages.extract_summary(pages.extract_report(_extracted(spark, sf)))


@register(expected(_PAGE_REPORT + "SELECT * FROM page_report"))
def page_job(spark, sf):
    return run_pages(seed_pages(spark, sf)).report


# --- files: written from the tables, read back ------------------------------------------


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/recordmill-{uuid.uuid4().hex}/files"


def _read_csv(spark: SparkSession, path: str) -> DataFrame:
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"')
    return df.select(*[F.coalesce(c, F.lit("")).alias(c) for c in df.columns])


@register(ORACLE["conform_schema"])
def read_records(spark, sf):
    """Three folders of files: two orders of columns, and one column less."""
    folder = _folder(spark)
    raw = raw_records(spark, sf)
    part, names = F.pmod(F.xxhash64("record_id"), F.lit(3)), raw.columns
    written = {
        "a": raw.where(part == 0),
        "b": raw.where((part > 0) & (F.col("document_url_raw") != "")).select(*names[::-1]),
        "c": raw.where((part > 0) & (F.col("document_url_raw") == "")).drop("document_url_raw"),
    }
    for name, df in written.items():
        df.write.csv(
            f"{folder}/{name}", header=True, quote='"', escape='"', emptyValue="",
            ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
        )
    return readers.read_records(spark, [f"{folder}/{name}" for name in written])


@register("SELECT CAST(0 AS BIGINT) AS bad_lines UNION ALL "
          "SELECT CAST(sum(len(list_filter(string_split(text, chr(10)), "
          "lambda l: strlen(l) <> length(l)))) AS BIGINT) FROM documents")
def utf8_gate(spark, sf):
    """The texts as UTF-8 files give no bad line; as Latin-1 files, one for each line with an accent."""
    folder = _folder(spark)
    docs = table(spark, sf, "documents")
    docs.select("text").write.text(f"{folder}/utf8")
    latin = F.encode(F.regexp_replace("text", r"[^\x00-\xff]", "é"), "ISO-8859-1")
    docs.select(latin.cast("string").alias("text")).write.text(f"{folder}/latin1")
    checked = [
        readers.utf8_gate(spark, f"{folder}/{name}", mode="quarantine").agg(
            F.count(F.lit(1)).alias("bad_lines"))
        for name in ("utf8", "latin1")
    ]
    return checked[0].unionByName(checked[1])


@register("SELECT trim(url) AS seed_url FROM pages")
def read_seeds(spark, sf):
    folder = _folder(spark)
    table(spark, sf, "pages").select(
        F.concat(F.lit("# page\n   \n  "), F.col("url"), F.lit(" \n"))
    ).write.text(folder)
    return readers.read_seeds(spark, folder).select("seed_url")


@register(_NUMBERED_SQL)
def write_canonical(spark, sf):
    folder = _folder(spark)
    sinks.write_canonical(run_records(raw_records(spark, sf)).canonical, folder)
    return _read_csv(spark, folder)


@register(q.query(
    "SELECT record_id, rejection_reason, raw_identifier_hint FROM evaluated "
    "WHERE rejection_reason <> ''", "evaluated"))
def write_rejected(spark, sf):
    folder = _folder(spark)
    sinks.write_rejected(run_records(raw_records(spark, sf)).rejected, folder)
    return _read_csv(spark, folder)


@register(q.query(
    "SELECT duplicate_group_id, record_id, CASE WHEN is_canonical THEN 'True' ELSE 'False' END AS is_kept, "
    f"{q.REASON} AS duplicate_reason FROM grouped", "grouped"))
def write_clusters(spark, sf):
    folder = _folder(spark)
    sinks.write_clusters(run_records(raw_records(spark, sf)).clusters, folder)
    return _read_csv(spark, folder).select(*CLUSTER_COLUMNS)


@register(_REPORT_SQL)
def write_quality_report(spark, sf):
    folder = _folder(spark)
    result = run_records(raw_records(spark, sf))
    sinks.write_quality_report(result.report, folder)
    return _flat_report(spark.read.schema(result.report.schema).json(folder, multiLine=True))


@register(ORACLE["extract_projects"])
def write_projects(spark, sf):
    folder = _folder(spark)
    projects = pages.extract_projects(_extracted(spark, sf))
    sinks.write_projects(projects, folder)
    return spark.read.schema(projects.schema).json(folder).withColumn(
        "authors", F.array_join("authors", "/"))


@register(ORACLE["extract_events"])
def write_events(spark, sf):
    folder = _folder(spark)
    events = pages.extract_events(_extracted(spark, sf))
    sinks.write_events(events, folder)
    return spark.read.schema(events.schema).json(folder)


@register(ORACLE["extract_report"])
def write_extract_report(spark, sf):
    """The report in the order of a shuffled list of seeds."""
    folder = _folder(spark)
    report = pages.extract_report(_extracted(spark, sf))
    seeds = report.select(F.md5("seed_url").alias("seed_no"), "seed_url")
    sinks.write_extract_report(in_seed_order(report, seeds), folder)
    return spark.read.schema(report.schema).json(folder)


@register(expected(
    "SELECT s.seed_url, w.page_no, CASE WHEN bulletin <> '' THEN bulletin "
    "ELSE 'prmBoletin__q_a_b_' || s.c END || '.html' AS page_file "
    "FROM (FROM wanted UNION ALL SELECT c, 1 FROM seeds WHERE c % 17 = 9) w JOIN seeds s USING (c)"))
def archive_pages(spark, sf):
    folder = _folder(spark)
    sinks.archive_pages(seed_pages(spark, sf), folder)
    return spark.read.parquet(folder).select("seed_url", "page_no", "page_file")
