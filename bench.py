"""Headline timings on ``$BENCH_SF_DIR`` with ``local[$BENCH_CPUS]``; prints one JSON line.

Each query runs once to warm up and once timed, with all its outputs consumed.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from checks.queries import QUERIES  # noqa: E402
from checks.raw_records import raw_records  # noqa: E402
from checks.seed_pages import seed_pages  # noqa: E402
from recordmill.operators.dedup import assign_duplicate_groups  # noqa: E402
from recordmill.operators.records import evaluate_records  # noqa: E402
from recordmill.plans.pages import run_pages  # noqa: E402
from recordmill.plans.records import run_records  # noqa: E402
from recordmill.staging import stage  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
TIMES = 20
CPUS = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))


def consume(*frames: DataFrame) -> None:
    for df in frames:
        df.write.format("noop").mode("overwrite").save()


def session() -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("recordmill-bench")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="bench-"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> None:
    spark = session()
    # Inputs as a job would find them: tables in several files, written once.
    raw = stage(raw_records(spark, SF_DIR).repartition(4 * int(CPUS)), "raw")
    pages = stage(seed_pages(spark, SF_DIR).repartition(4 * int(CPUS)), "pages")
    valid = stage(evaluate_records(raw).where(F.col("rejection_reason") == ""), "valid")
    # The same records 20 times over, under other ids and URLs.
    copies = spark.range(TIMES).select(F.col("id").cast("string").alias("copy"))
    more = raw.crossJoin(F.broadcast(copies)).withColumns({
        "record_id": F.concat("record_id", F.lit("-"), "copy"),
        "url_raw": F.when(F.trim("url_raw") != "", F.concat(F.trim("url_raw"), F.lit("&copy="), "copy")).otherwise(F.lit("")),
    }).drop("copy")
    more = stage(more.repartition(8 * int(CPUS)), "more")
    # One key on a third of all rows.
    hot = valid.withColumn(
        "canonical_url",
        F.when(F.crc32("record_id") % 3 == 0, F.lit("https://hot.example")).otherwise(F.col("canonical_url")),
    )

    def record_job(records=raw):
        result = run_records(records)
        consume(result.canonical, result.rejected, result.clusters, result.report)

    def page_job():
        result = run_pages(pages)
        consume(result.projects, result.events, result.report)

    queries = {
        "record_job": record_job,
        "page_job": page_job,
        "record_job_20x": lambda: record_job(more),
        "normalize_records": lambda: consume(evaluate_records(raw)),
        "normalize_records_20x": lambda: consume(evaluate_records(more)),
        "duplicate_groups": lambda: consume(assign_duplicate_groups(valid)),
        "duplicate_groups_hot_key": lambda: consume(assign_duplicate_groups(hot)),
        "normalize_text": lambda: consume(QUERIES["normalize_text"](spark, SF_DIR)),
        "normalize_url": lambda: consume(QUERIES["normalize_url"](spark, SF_DIR)),
    }
    rows = {"record_job": raw.count(), "record_job_20x": more.count(), "page_job": pages.count()}
    seconds = {}
    for name, run in queries.items():
        run()
        start = time.perf_counter()
        run()
        seconds[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "total seconds of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "rows_per_sec": {n: round(r / seconds[n]) for n, r in rows.items()},
        "marginal_us_per_row": {
            n: round((seconds[f"{n}_20x"] - seconds[n]) * 1e6 / (rows["record_job_20x"] - rows["record_job"]), 1)
            for n in ("record_job", "normalize_records")
        },
        "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
        "cpus": int(CPUS),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
