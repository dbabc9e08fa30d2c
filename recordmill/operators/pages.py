"""Extraction rules on page outlines, and the operators that apply them to a pages table.

Every rule is a higher-order function on one row's outline, so no page, and no group of
pages of one seed, is ever collected: each row is parsed where it was read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.authors import split_people
from recordmill.functions.bulletin import bulletin_from_url
from recordmill.functions.outline import page_outline
from recordmill.functions.strings import first_non_empty, not_blank, or_blank
from recordmill.schema import EVENT_COLUMNS, PROJECT_COLUMNS
from recordmill.staging import Run, stage

# Labels of the project fields, by priority.
TITLE_LABEL = "Título"
FIELD_LABELS = {
    "legislature": ["Legislatura", "Período"],
    "entry_date": ["Ingreso", "Fecha de ingreso", "Fecha Ingreso"],
    "status": ["Estado", "Situación"],
    "initiative": ["Iniciativa", "Tipo de Iniciativa", "Tipo iniciativa"],
    "origin_chamber": ["Origen", "Cámara de Origen", "Cámara origen"],
}
AUTHOR_LABELS = ["Autor", "Autores"]
EVENT_FIELDS = ["session", "stage", "substage", "description"]
NO_FIRST_PAGE = "no first page"
PARSE_ERROR = "Parse error: "
HTTP_ERROR = "HTTPError "


def label_value(outline: Column, *labels: str) -> Column:
    """Value beside the first label that contains the text, in any letter case.

    With several texts the first that yields a value wins; blank when none does. The outline
    must have been asked for these labels.
    """

    def value_of(text: str) -> Column:
        hits = F.filter(outline["labels"], lambda l: l["label"] == text.lower())
        return F.try_element_at(hits, F.lit(1))["value"]

    return first_non_empty(*[value_of(t) for t in labels])


def project_title(outline: Column) -> Column:
    """First non-empty heading by selector order, else the title label's value."""
    headings = F.filter(outline["headings"], lambda h: h.isNotNull() & (h != ""))
    return F.coalesce(
        F.try_element_at(headings, F.lit(1)), label_value(outline, TITLE_LABEL)
    )


def project_detail_url(outline: Column, seed_url: Column) -> Column:
    return F.coalesce(outline["canonical_link"], seed_url)


def project_fields(outline: Column) -> dict[str, Column]:
    return {name: label_value(outline, *labels) for name, labels in FIELD_LABELS.items()}


def project_authors(outline: Column) -> Column:
    """Names in the author block, else beside the author label."""
    block = split_people(outline["authors"])
    return F.when(F.size(block) > 0, block).otherwise(
        split_people(label_value(outline, *AUTHOR_LABELS))
    )


def pick_event_table(outline: Column) -> Column:
    """Number of the table with most dated rows, the first of equals; null without one."""
    scored = F.transform(
        outline["tables"], lambda t, i: F.struct(t["dated"].alias("rows"), (-i).alias("earlier"))
    )
    best = F.array_max(scored)
    return F.when(best["rows"] > 0, -best["earlier"])


def table_rows(outline: Column, table: Column) -> Column:
    """The rows inside a table, nested ones included."""
    t = outline["tables"][table]
    return F.slice(outline["rows"], t["first"] + 1, t["rows"])


def event_row_filter(rows: Column) -> Column:
    """Data rows: two cells or more, not all headers, from the first dated row on."""
    data = F.filter(rows, lambda r: (r["n_cells"] >= 2) & ~r["all_heads"])
    # A position of 0 (no dated row) leaves nothing; slice counts from 1.
    first = F.array_position(F.transform(data, lambda r: r["date_cell"] > 0), True).cast("int")
    return F.when(
        first > 0, F.slice(data, first, F.size(data))
    ).otherwise(F.slice(data, 1, 0))


def event_columns(row: Column, words: Column) -> Column:
    """Date cell, the other cells by position, and the document link of a data row."""

    def text(span: Column) -> Column:
        return F.substr(words, span["at"] + 1, span["size"])

    at = F.greatest(row["date_cell"], F.lit(1))
    others = F.filter(row["cells"], lambda c, i: i != at - 1)
    return F.struct(
        text(F.coalesce(F.try_element_at(row["date"], F.lit(1)), row["cells"][0])).alias("event_date"),
        *[
            or_blank(text(F.try_element_at(others, F.lit(i + 1)))).alias(name)
            for i, name in enumerate(EVENT_FIELDS)
        ],
        row["link"].alias("document_url"),
        row["link_error"].alias("link_error"),
    )


def event_candidates(outline: Column, table: Column) -> Column:
    """Data rows of the chosen table as event columns, in row order."""
    return F.transform(
        event_row_filter(table_rows(outline, table)), lambda r: event_columns(r, outline["words"])
    )


def with_date(candidates: Column) -> Column:
    """Events are the candidates whose date cell holds text."""
    return F.filter(candidates, lambda e: e["event_date"] != "")


LABELS = [TITLE_LABEL, *(x for names in FIELD_LABELS.values() for x in names), *AUTHOR_LABELS]


def outline_pages(
    pages: DataFrame, base_url: str | None = None, labels: list[str] | None = None,
    project: Column | None = None, events: Column | None = None,
) -> DataFrame:
    """Adds ``outline``, ``fetched`` and ``event_table``; pages that were not fetched get no outline.

    A page is fetched if it has HTML, no error, and no status of 400 or more. A null page number
    counts as 1. Links are resolved against ``base_url``, by default the seed's own site.
    ``labels`` are those that ``label_value`` will be asked for, by default the project's;
    ``project`` and ``events`` tell the pages whose project or events are wanted, by default all;
    without events there is no event table.
    """
    fetched = (
        F.col("html").isNotNull() & F.col("fetch_error").isNull()
        & (F.coalesce("http_status", F.lit(0)) < 400)
    )
    base = F.col("seed_url") if base_url is None else F.lit(base_url)
    outline = page_outline(F.when(F.col("fetched"), F.col("html")), base, LABELS if labels is None else labels, project, events)
    return (
        pages.withColumn("page_no", F.coalesce("page_no", F.lit(1))).withColumn("fetched", fetched)
        .withColumn("outline", outline)
        .drop("html")
        .withColumn("event_table", pick_event_table(F.col("outline")))
    )


def extract_pages(
    pages: DataFrame, base_url: str | None = None, scraped_at: Column | None = None
) -> DataFrame:
    """One row for each page: its project, its events and its error, markup parsed once.

    Stage the result when several outputs read it.
    """
    if scraped_at is None:
        scraped_at = F.date_format(
            F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()),
            "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'",
        )
    outline = F.col("outline")
    seed = F.col("seed_url")
    bulletin = bulletin_from_url(seed)
    fields = project_fields(outline)
    project = F.struct(
        project_detail_url(outline, seed).alias("detail_url"),
        bulletin.alias("bulletin_number"),
        project_title(outline).alias("title"),
        *[fields[n].alias(n) for n in FIELD_LABELS],
        project_authors(outline).alias("authors"),
        scraped_at.alias("scraped_at"),
    )
    candidates = F.col("candidates")
    link_errors = F.filter(
        F.transform(candidates, lambda e: e["link_error"]), lambda x: x.isNotNull()
    )
    later_fetch = F.when(
        (F.col("page_no") > 1) & ~F.col("fetched"),
        F.coalesce(F.col("fetch_error"), F.lit("page was not fetched")),
    )
    return (
        outline_pages(pages, base_url, project=F.col("page_no") == 1)
        .withColumn("candidates", event_candidates(outline, F.col("event_table")))
        .select(
            "seed_url", "page_no", "http_status", "fetched", "fetch_error",
            F.when(F.col("page_no") == 1, project).alias("project"),
            F.coalesce(with_date(candidates), F.array().cast(_EVENTS_DDL)).alias("events"),
            F.coalesce(
                outline["error"],
                F.when(F.col("page_no") == 1, outline["canonical_link_error"]),
                F.try_element_at(link_errors, F.lit(1)),
                later_fetch,
            ).alias("error"),
        )
    )


_EVENTS_DDL = (
    "array<struct<event_date:string,session:string,stage:string,substage:string,"
    "description:string,document_url:string,link_error:string>>"
)


_OUTCOME_FIELDS = ["http_status", "fetched", "fetch_error", "project", "events", "error"]


def latest_versions(extracted: DataFrame, run: Run | None = None) -> DataFrame:
    """One row for each seed and page number; what the operators below expect.

    Of a page stored more than once, a fetched version is taken before others, then the one
    with more events, then the greatest by error, status and a digest of its content.

    Runs jobs: the input is written once, and versions are chosen on narrow rows (key, rank,
    place in the written table), so no exchange carries a page's content. Only if a page is
    stored more than once do the written rows meet the places to be left out. With a ``run``
    both tables are named, and finished ones are read, not written.
    """
    staged = run.stage if run else stage
    rank = F.struct(
        F.col("fetched"), F.size("events").alias("n"), F.col("error"), F.col("http_status"),
        F.xxhash64("events", "project").alias("digest"),
    )
    placed = staged(
        extracted.select("seed_url", "page_no", *_OUTCOME_FIELDS).withColumns(
            {"_rank": rank, "_place": F.monotonically_increasing_id()}),
        "extracted")
    rows = placed.drop("_rank", "_place")
    repeated = staged(repeated_pages(placed), "repeated")
    if repeated.isEmpty():
        return rows
    return placed.join(older_versions(placed, repeated), "_place", "left_anti").select(*rows.columns)


def repeated_pages(placed: DataFrame) -> DataFrame:
    """``seed_url, page_no, _kept`` of the pages that are stored more than once: the place of the version to keep."""
    return placed.groupBy("seed_url", "page_no").agg(
        F.max(F.struct("_rank", "_place"))["_place"].alias("_kept"), F.count(F.lit(1)).alias("_versions")
    ).where("_versions > 1").drop("_versions")


def older_versions(placed: DataFrame, repeated: DataFrame) -> DataFrame:
    """``_place`` of the versions to leave out."""
    keys = ["seed_url", "page_no"]
    own, kept = placed.select(*keys, "_place"), repeated.select(*(F.col(k).alias(f"_{k}") for k in keys), "_kept")
    same = F.col("seed_url").eqNullSafe(F.col("_seed_url")) & F.col("page_no").eqNullSafe(F.col("_page_no"))
    return own.join(kept, same & (F.col("_place") != F.col("_kept")), "left_semi").select("_place")


def seed_outcomes(extracted: DataFrame) -> DataFrame:
    """``seed_url`` with ``fetch_ok``, ``parse_ok``, ``http_status``, ``events`` and its messages.

    What all outputs go by: a seed is fetched if its first page is, and parsed if it is fetched
    and no page of it has an error. Pages are combined by partial aggregation.
    """
    first = F.col("page_no") == 1
    per_seed = extracted.groupBy("seed_url").agg(
        F.coalesce(F.bool_or(first & F.col("fetched")), F.lit(False)).alias("fetch_ok"),
        F.bool_or(first).alias("has_first"),
        F.max(F.when(first, F.col("http_status"))).alias("http_status"),
        F.max(F.when(first, F.col("fetch_error"))).alias("fetch_error"),
        F.min(F.when(F.col("error").isNotNull(), F.struct("page_no", "error")))["error"].alias("error"),
        F.sum(F.size("events")).alias("events"),
    )
    return per_seed.withColumn("parse_ok", F.col("fetch_ok") & F.col("error").isNull())


def _of_good_seeds(extracted: DataFrame) -> DataFrame:
    """A seed with a failed page yields no output rows at all."""
    good = seed_outcomes(extracted).where(F.col("parse_ok")).select("seed_url")
    return extracted.join(good, "seed_url", "left_semi")


def extract_projects(extracted: DataFrame) -> DataFrame:
    """One project row for each seed, from its first page."""
    return (
        _of_good_seeds(extracted).where(F.col("page_no") == 1)
        .select("seed_url", "project.*").select(*PROJECT_COLUMNS)
    )


def union_pages(extracted: DataFrame) -> DataFrame:
    """Events of all pages of a seed; ``row_order`` counts from 0 on each page."""
    return (
        _of_good_seeds(extracted)
        .select("seed_url", "page_no", F.posexplode("events").alias("row_order", "event"))
        .select(
            "seed_url",
            bulletin_from_url(F.col("seed_url")).alias("bulletin_number"),
            "page_no", "row_order", "event.*",
        )
        .drop("link_error")
    )


def extract_events(extracted: DataFrame) -> DataFrame:
    """The published event columns."""
    return union_pages(extracted).select(*EVENT_COLUMNS)


def extract_report(extracted: DataFrame) -> DataFrame:
    """Fetch and parse outcome of each seed."""
    fetch_message = F.when(~F.col("has_first"), F.lit(NO_FIRST_PAGE)).when(
        F.col("http_status").isNotNull(),
        F.concat(
            F.lit(HTTP_ERROR), F.col("http_status").cast("string"), F.lit(": "),
            or_blank(F.col("fetch_error")),
        ),
    ).otherwise(or_blank(F.col("fetch_error")))
    return seed_outcomes(extracted).select(
        "seed_url",
        "fetch_ok",
        "parse_ok",
        "http_status",
        F.when(F.col("parse_ok"), F.col("events")).otherwise(0).cast("int").alias("row_count"),
        F.when(~F.col("fetch_ok"), fetch_message)
        .when(F.col("error").isNotNull(), F.concat(F.lit(PARSE_ERROR), F.col("error")))
        .alias("error_message"),
    )


def extract_summary(report: DataFrame) -> DataFrame:
    """Seeds done without error, all seeds, and all events."""
    return report.agg(
        F.count_if(F.col("fetch_ok") & F.col("parse_ok")).alias("seeds_ok"),
        F.count(F.lit(1)).alias("seeds"),
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("events"),
    )
