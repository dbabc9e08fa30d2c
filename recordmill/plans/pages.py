"""The page job: stored pages in, projects, events and extraction report out."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.operators.pages import (
    extract_events,
    extract_pages,
    extract_projects,
    extract_report,
    latest_versions,
)
from recordmill.sources import sinks
from recordmill.staging import Run


@dataclass(frozen=True)
class PageResult:
    projects: DataFrame
    events: DataFrame
    report: DataFrame


def seed_pages(seeds: DataFrame, pages: DataFrame) -> DataFrame:
    """Pages of the listed seeds; a seed without a stored page gets an unfetched first page."""
    joined = seeds.select("seed_url").distinct().join(pages, "seed_url", "left")
    missing = F.col("page_no").isNull() & F.col("html").isNull() & F.col("http_status").isNull() & F.col("fetch_error").isNull()
    return joined.withColumns({
        "fetch_error": F.when(missing, F.lit("no stored page")).otherwise(F.col("fetch_error")),
        "page_no": F.coalesce("page_no", F.lit(1)),
    })


def in_seed_order(report: DataFrame, seeds: DataFrame) -> DataFrame:
    """The report with one row for each listed seed, repeats included, and its ``seed_no``."""
    return seeds.select("seed_no", "seed_url").join(report, "seed_url").select("seed_no", *report.columns)


def run_pages(
    pages: DataFrame, base_url: str | None = None, scraped_at: Column | None = None,
    seeds: DataFrame | None = None, run: Run | None = None,
) -> PageResult:
    """Parse every page once into a staged table, and derive the three outputs from it.

    ``seeds(seed_no, seed_url)``, as ``read_seeds`` gives them, puts the report in their order.
    With a ``run`` the staged tables are named: pages that an earlier run of that name and key
    has parsed are not parsed again, and keep its ``scraped_at``.
    """
    if seeds is not None:
        pages = seed_pages(seeds, pages)
    extracted = latest_versions(extract_pages(pages, base_url, scraped_at), run)
    report = extract_report(extracted)
    return PageResult(
        projects=extract_projects(extracted),
        events=extract_events(extracted),
        report=report if seeds is None else in_seed_order(report, seeds),
    )


def write_pages(result: PageResult, folder: str) -> None:
    # Names of the outputs.
    sinks.write_projects(result.projects, f"{folder}/projects.jsonl")
    sinks.write_events(result.events, f"{folder}/events.jsonl")
    sinks.write_extract_report(result.report, f"{folder}/scrape_report.json")


def page_job(
    pages: DataFrame, folder: str, base_url: str | None = None, seeds: DataFrame | None = None,
    run: Run | None = None,
) -> PageResult:
    """From a pages table, and a list of seeds if there is one, to the three written outputs.

    Give a ``run`` a key that stands for the pages, the seeds and ``base_url``.
    """
    result = run_pages(pages, base_url, seeds=seeds, run=run)
    write_pages(result, folder)
    return result
