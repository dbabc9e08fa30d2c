"""Jobs that go on after their last finished table."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from checks.raw_records import raw_records
from recordmill.operators import pages as page_operators
from recordmill.plans import records as job
from recordmill.plans.pages import run_pages
from recordmill.staging import Run, checkpoint_dir, files_key, remove_run, run_names

OUTPUTS = ("canonical", "rejected", "clusters", "report")


def rows(result):
    return {name: sorted(map(str, getattr(result, name).collect())) for name in OUTPUTS}


def touched(spark, name):
    folder = f"{checkpoint_dir(spark)}/recordmill-run-{name}".removeprefix("file:")
    return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{folder}/*/*/part-*")}


@pytest.fixture
def name(spark):
    yield "nightly"
    for left in run_names(spark):
        remove_run(spark, left)


def test_a_job_goes_on_after_its_last_finished_table(spark, sf_dir, name, monkeypatch):
    raw = raw_records(spark, sf_dir)
    want = rows(job.run_records(raw))

    def fails(df):
        raise RuntimeError("lost")

    with monkeypatch.context() as broken:
        broken.setattr(job, "assign_duplicate_groups", fails)
        with pytest.raises(RuntimeError):
            job.run_records(raw, Run(spark, name))
    first = touched(spark, name)
    assert first
    assert rows(job.run_records(raw, Run(spark, name))) == want
    second = touched(spark, name)
    assert first.items() < second.items()
    with monkeypatch.context() as broken:  # all tables are there, so nothing is grouped again
        broken.setattr(job, "assign_duplicate_groups", fails)
        assert rows(job.run_records(raw, Run(spark, name))) == want
    assert touched(spark, name) == second


def test_another_key_or_other_columns_share_nothing(spark, name):
    for key, n in (("a", 3), ("b", 5)):
        assert Run(spark, name, key).stage(spark.range(n), "numbers").count() == n
    assert Run(spark, name, "a").stage(spark.range(9), "numbers").count() == 3
    assert Run(spark, name, "a").stage(spark.range(9).select(F.col("id").cast("int")), "numbers").count() == 9
    assert Run(spark, name, "a").finished(spark.range(9), "others") is None


def test_a_table_that_was_not_committed_is_written_again(spark, name):
    run = Run(spark, name)
    table = run.stage(spark.range(4), "numbers")
    folder = os.path.dirname(table.inputFiles()[0]).removeprefix("file://")
    os.rename(f"{folder}/_SUCCESS", f"{folder}/_started")
    assert run.finished(spark.range(4), "numbers") is None
    assert run.stage(spark.range(6), "numbers").count() == 6


def test_runs_are_listed_and_removed(spark, name):
    Run(spark, name).stage(spark.range(1), "numbers")
    Run(spark, "other").stage(spark.range(1), "numbers")
    assert run_names(spark) == [name, "other"]
    assert remove_run(spark, "other") and not remove_run(spark, "other") and not remove_run(spark, "*")
    assert run_names(spark) == [name]
    for bad in ("", "a/b", "..", "*"):
        with pytest.raises(ValueError):
            Run(spark, bad)


def test_files_that_change_start_the_job_anew(spark, tmp_path, name):
    source = tmp_path / "in"
    source.mkdir()
    (source / "a.csv").write_text("record_id,title_raw,url_raw\nA1,T,https://e.com/1\n")
    before = files_key(spark, str(source), "x")
    assert before == files_key(spark, [str(source)], "x") != files_key(spark, str(source), "y")
    for _ in range(2):
        assert job.record_job(spark, str(source), str(tmp_path / "out"), run=name).canonical.count() == 1
    (source / "b.csv").write_text("record_id,title_raw,url_raw\nA2,T,https://e.com/2\n")
    assert files_key(spark, str(source), "x") != before
    assert job.record_job(spark, str(source), str(tmp_path / "out"), run=name).canonical.count() == 2


def test_pages_are_parsed_once_a_run(spark, name, monkeypatch):
    ddl = "seed_url string, page_no int, http_status int, html string, fetch_error string"
    html = "<h1>P</h1><table><tr><th>Date</th><th>Stage</th></tr><tr><td>2024-01-02</td><td>x</td></tr></table>"
    df = spark.createDataFrame([("https://h/a", 1, 200, html, None), ("https://h/a", 1, 200, html, None)], ddl)

    def outputs(run=None):
        result = run_pages(df, scraped_at=F.lit("now"), run=run)
        return [sorted(map(str, t.collect())) for t in (result.projects, result.events, result.report)]

    want = outputs()
    assert outputs(Run(spark, name)) == want
    written = touched(spark, name)
    monkeypatch.setattr(page_operators, "stage", None)  # only the run's tables are used
    assert outputs(Run(spark, name)) == want and touched(spark, name) == written
