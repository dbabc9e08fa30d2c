"""Extraction rules on small pages."""

import time

import pytest
from pyspark.sql import functions as F

from recordmill.functions.outline import _outline
from recordmill.operators import pages
from recordmill.plans.pages import page_job, run_pages, seed_pages
from recordmill.schema import EVENT_COLUMNS, EXTRACT_REPORT_COLUMNS, PAGES_SCHEMA, PROJECT_COLUMNS
from recordmill.sources.records import read_seeds
from recordmill.sources.sinks import archive_pages

SEED = "https://h.example/t?prmBoletin=11422-07"


def table(*rows):
    return "<table>" + "".join("<tr>" + "".join(f"<td>{c}</td>" for c in r) + "</tr>" for r in rows) + "</table>"


def frame(spark, *htmls, seed=SEED):
    return spark.createDataFrame([(seed, i + 1, 200, h, None) for i, h in enumerate(htmls)], PAGES_SCHEMA)


@pytest.fixture
def outline_of(spark):
    def run(html, **columns):
        df = pages.outline_pages(frame(spark, html))
        return df.select(*[c(F.col("outline")).alias(n) for n, c in columns.items()]).first()
    return run


@pytest.fixture
def events_of(spark):
    def run(*htmls):
        rows = pages.union_pages(pages.extract_pages(frame(spark, *htmls))).orderBy("page_no", "row_order")
        return [r.asDict() for r in rows.collect()]
    return run


@pytest.mark.parametrize("html,title", [
    ("<h2>second</h2><h1>first <i>part</i></h1><h1>no</h1>", "first part"),
    ("<h1> </h1><h2>second</h2>", "second"),
    ("<h1></h1><h1>later h1 is never looked at</h1><p class='a titulo-proyecto'>by class</p>", "by class"),
    ("<span id='ContentPlaceHolder1_lbTitulo'>by id</span>", "by id"),
    ("<td>TÍTULO:</td><td>by label</td>", "by label"),
    ("<p>none</p>", ""),
    ("", ""),
])
def test_title(outline_of, html, title):
    assert outline_of(html, t=pages.project_title).t == title


@pytest.mark.parametrize("html,value", [
    ("<tr><td>Estado:</td><td> A  B </td></tr>", "A B"),
    ("<span>estado</span><b>x</b><span>C</span>", "C"),
    ("<p><strong>Estado</strong></p><p>D</p>", "D"),
    ("<p><strong>Estado</strong> <i>x</i></p>\n<div>E</div>", "E"),
    ("<b>Estado</b>", ""),
    ("<div><b>Estado</b></div><p>next of the parent</p>", "next of the parent"),
    ("<td>Estado</td><td></td><td>Estado</td><td>late</td>", ""),
    ("<i>Estado</i><span>no label element</span>", ""),
    ("<script><td>Estado</td></script><dl><dt>Estado<dd>F</dl>", "F"),
    ("<td>Es<i>tado</i></td><td>G</td>", "G"),
])
def test_label_value(outline_of, html, value):
    assert outline_of(html, v=lambda o: pages.label_value(o, "Estado")).v == value


@pytest.mark.parametrize("html,names", [
    ("<div class='autores'>A; B, C</div><td>Autores</td><td>X</td>", ["A", "B", "C"]),
    ("<div class='autores'> </div><td>Autores</td><td>X,Y</td>", ["X", "Y"]),
    ("<div class='autores'></div><div id='autores'>not reached</div>", []),
    ("<b>Autor:</b><span>Solo</span>", ["Solo"]),
    ("<p>none</p>", []),
])
def test_authors(outline_of, html, names):
    assert outline_of(html, a=pages.project_authors).a == names


def test_detail_url(spark):
    for html, url in [
        ("<link rel='canonical' href='/x'>", "https://h.example/x"),
        ("<link rel='canonical' href=''>", SEED),
        ("<p>", SEED),
    ]:
        row = pages.extract_projects(pages.extract_pages(frame(spark, html))).first()
        assert row.detail_url == url
    other = pages.extract_pages(frame(spark, "<link rel=canonical href=x/y>"), base_url="https://other.example")
    assert pages.extract_projects(other).first().detail_url == "https://other.example/x/y"


def test_event_shapes(events_of):
    html = table(
        ("Fecha", "Etapa"),                                   # no date yet: skipped
        ("20/11/2019", "S1", "St", "Sub", "Desc", "extra"),
        ("alone",),
        ("S2", "2019-11-20", "St2"),
        ("no date", "S3"),                                    # after the first event: kept
        ("", "S4"),                                           # empty date cell: skipped
        ("20\xa0Nov. 2019", '<a href="#">x</a><a href=" /doc ">S5</a>'),
    ) + "<table><tr><th>01/01/2020</th><th>all heads</th></tr></table>"
    got = [tuple(e[c] for c in EVENT_COLUMNS[2:]) for e in events_of(html)]
    assert got == [
        (0, "20/11/2019", "S1", "St", "Sub", "Desc", ""),
        (1, "2019-11-20", "S2", "St2", "", "", ""),
        (2, "no date", "S3", "", "", "", ""),
        (3, "20 Nov. 2019", "x S5", "", "", "", "https://h.example/doc"),
    ]


def test_table_choice(events_of):
    one, two = table(("01/01/2020", "one")), table(("01/01/2021", "two"), ("02/01/2021", "two"))
    assert {e["session"] for e in events_of(one + two)} == {"two"}
    assert {e["session"] for e in events_of(one + table(("05/05/2020", "tie")))} == {"one"}
    # An outer table holds the inner rows too and comes first.
    nested = f"<table><tr><td>menu</td><td>{two}</td></tr></table>"
    assert [e["event_date"] for e in events_of(nested)][1:] == ["01/01/2021", "02/01/2021"]
    assert events_of("<table><tr><td>x</td><td>y</td></tr></table>") == []
    assert events_of("<p>20/11/2019</p>") == []


def test_pages_of_a_seed(events_of):
    page = [table(("01/01/2020", "a"), ("02/01/2020", "b")), table(("03/01/2020", "c"))]
    assert [(e["page_no"], e["row_order"], e["session"]) for e in events_of(*page)] == [
        (1, 0, "a"), (1, 1, "b"), (2, 0, "c")]


def test_broken_markup_is_read(events_of):
    html = "<table><tr><td>01/01/2020<td>a<tr><td>02/01/2020<td><b>b</td></tr></table><![x[ ]]><p>after"
    assert [e["session"] for e in events_of(html)] == ["a", "b"]
    deep = "<div>" * 5000 + table(("01/01/2020", "deep"))
    assert [e["session"] for e in events_of(deep)] == ["deep"]


@pytest.mark.parametrize("unit", ["<a", "<a ", '<a "', "<!--", "<table>", "<tr><td>", "<table><tr><td>1/1/2020", "<b>Estado", '<a b="x>', "<a '>", "&lt"])
def test_hostile_pages_take_linear_time(unit):
    page = unit * (1_000_000 // len(unit))
    start = time.process_time()
    facts = _outline(page, "https://h.example", [x.lower() for x in pages.LABELS])
    assert time.process_time() - start < 15
    assert len(str(facts)) < 60 * len(page)


def test_nested_tables_stay_small():
    page = "<table><tr><td>01/01/2020</td><td>" * 400 + "x" + "</td></tr></table>" * 400
    facts = _outline(page, "https://h.example", [])
    assert facts["tables"][0] == {"first": 0, "rows": 400, "dated": 400}
    assert len(str(facts)) < 40 * len(page)


def test_many_tables_cost_as_many_times_more(spark):
    def seconds(n):
        df = frame(spark, "".join(table((f"01/01/{2000 + i % 20}", str(i))) for i in range(n)))
        pages.extract_pages(df).collect()
        start = time.perf_counter()
        assert pages.extract_pages(df).first().events[0].session == "0"
        return time.perf_counter() - start

    assert seconds(4000) < 3 * seconds(2000) + 1


def test_stored_pages_of_every_state(spark):
    good = table(("01/01/2020", "a"))
    df = spark.createDataFrame([
        ("https://h/error-body", 1, 404, "<h1>Not found</h1>" + good, None),
        ("https://h/no-first", 2, 200, good, None),
        ("https://h/null-number", None, 200, good, None),
        ("https://h/twice", 1, 200, "<p>", None), ("https://h/twice", 1, 200, good, None), ("https://h/twice", 1, None, None, "gone"),
    ], PAGES_SCHEMA)
    result = run_pages(df)
    report = {r.seed_url: tuple(r)[1:] for r in result.report.collect()}
    assert report == {
        "https://h/error-body": (False, False, 404, 0, "HTTPError 404: "),
        "https://h/no-first": (False, False, None, 0, "no first page"),
        "https://h/null-number": (True, True, 200, 1, None),
        "https://h/twice": (True, True, 200, 1, None),
    }
    assert sorted(r.seed_url for r in result.projects.collect()) == ["https://h/null-number", "https://h/twice"]
    assert result.events.count() == sum(r[3] for r in report.values())


def test_report_follows_the_seed_list(spark, tmp_path):
    (tmp_path / "seeds.txt").write_text("# list\nhttps://h/b\nhttps://h/a\n\nhttps://h/b\nhttps://h/c\n")
    df = spark.createDataFrame([(f"https://h/{x}", 1, 200, "<p>", None) for x in "abd"], PAGES_SCHEMA)
    page_job(df, str(tmp_path / "out"), seeds=read_seeds(spark, str(tmp_path / "seeds.txt")))
    lines = [r.value for r in spark.read.text(str(tmp_path / "out" / "scrape_report.json")).collect()]
    assert [x.split('"')[3] for x in lines] == ["https://h/b", "https://h/a", "https://h/b", "https://h/c"]
    assert "seed_no" not in lines[0] and "no stored page" in lines[3]


def test_report_and_failed_seeds(spark):
    good, bad_link = table(("01/01/2020", "a")), table(("01/01/2020", '<a href="http://[x">b</a>'))
    df = spark.createDataFrame([
        ("https://h/ok", 1, 200, good, None), ("https://h/ok", 2, 200, good, None),
        ("https://h/empty", 1, 200, "<p>", None),
        ("https://h/404", 1, 404, None, "Not Found"),
        ("https://h/net", 1, None, None, "timed out"),
        ("https://h/link", 1, 200, good, None), ("https://h/link", 2, 200, bad_link, None),
        ("https://h/late", 1, 200, good, None), ("https://h/late", 2, None, None, "gone"),
    ], PAGES_SCHEMA)
    result = run_pages(df)
    assert result.report.columns == EXTRACT_REPORT_COLUMNS
    report = {r.seed_url: tuple(r)[1:] for r in result.report.collect()}
    assert report == {
        "https://h/ok": (True, True, 200, 2, None),
        "https://h/empty": (True, True, 200, 0, None),
        "https://h/404": (False, False, 404, 0, "HTTPError 404: Not Found"),
        "https://h/net": (False, False, None, 0, "timed out"),
        "https://h/link": (True, False, 200, 0, "Parse error: Invalid IPv6 URL"),
        "https://h/late": (True, False, 200, 0, "Parse error: gone"),
    }
    assert sorted(r.seed_url for r in result.projects.collect()) == ["https://h/empty", "https://h/ok"]
    assert result.events.count() == 2
    assert result.projects.columns == PROJECT_COLUMNS and result.events.columns == EVENT_COLUMNS
    summary = pages.extract_summary(result.report).first()
    assert (summary.seeds_ok, summary.seeds, summary.events) == (2, 6, 2)


def test_written_outputs(spark, tmp_path):
    page_job(frame(spark, "<h1>é</h1>" + table(("01/01/2020", "a"))), str(tmp_path))
    projects = spark.read.text(str(tmp_path / "projects.jsonl")).collect()
    assert len(projects) == 1 and '"title":"é"' in projects[0].value and '"authors":[]' in projects[0].value
    report = spark.read.text(str(tmp_path / "scrape_report.json")).first().value
    assert '"error_message":null' in report
    archive_pages(frame(spark, "a", "b"), str(tmp_path / "raw"))
    assert [r.page_file for r in spark.read.parquet(str(tmp_path / "raw")).collect()] == ["11422-07.html"] * 2


def test_seeds_without_a_page_are_reported(spark):
    seeds = spark.createDataFrame([(SEED,), ("https://h/none",)], "seed_url string")
    report = {r.seed_url: r for r in run_pages(seed_pages(seeds, frame(spark, "<p>"))).report.collect()}
    assert report[SEED].parse_ok and not report["https://h/none"].fetch_ok
    assert report["https://h/none"].error_message == "no stored page"


def test_scraped_at_is_an_iso_time(spark):
    row = pages.extract_projects(pages.extract_pages(frame(spark, "<p>"))).first()
    import datetime
    at = datetime.datetime.fromisoformat(row.scraped_at)
    assert abs(datetime.datetime.now(datetime.timezone.utc) - at).total_seconds() < 600


def test_tag_ends_are_those_of_the_rule():
    """The first ``>`` outside quotes, or the first one if a quote is never closed; linear on hostile pages."""
    import random
    import time

    from recordmill.functions import outline

    rng = random.Random(4)
    for _ in range(3000):
        html = "".join(rng.choice("a >'\"=<") for _ in range(rng.randint(0, 24)))
        places, ends = outline._tag_ends(html)
        for at in range(len(html)):
            end = outline._REST.match(html, at).end()
            want = end if html.startswith(">", end) else -1
            i = next((k for k, p in enumerate(places) if p >= at), len(places))
            assert ends[i] == want
    for piece in ("<a b='", '<a "x\' >', "<a '>\"", "<p x=\"'>"):
        start = time.time()
        outline._Page(piece * 100_000)
        assert time.time() - start < 20


def test_tags_read_by_pattern_are_those_read_one_by_one(monkeypatch):
    """The usual tags are taken by one pattern; any page must come out as by the rules, one tag at a time."""
    import random
    import re

    from recordmill.functions import outline

    rng = random.Random(6)
    pieces = (
        "<td> <tr> </tr> <table> </table> <TH> </th> </td> <p> </p> <br/> <li> <dl> <dt> </dl> <script> </script> <title> </title> "
        "<h1> </h1> <!--c--> <!-- --> <!x> </> <b <a<b> > ' \" <a&#32;b=' <a&#32;href='/x'> </a> <td\"q> Estado 01/02/2020 &amp; x"
    ).split()
    htmls = ["".join(rng.choice(pieces).replace("&#32;", " ") for _ in range(rng.randint(0, 30))) for _ in range(1500)]
    labels = [label.lower() for label in pages.LABELS]
    fast = [_outline(h, "https://h.example", labels) for h in htmls]
    monkeypatch.setattr(outline, "_TEXT_AND_TAG", re.compile(r"(?!)"))
    assert fast == [_outline(h, "https://h.example", labels) for h in htmls]


def test_a_tag_takes_few_steps():
    """Lines of Python run for each tag of a plain page: 19; read by the rules alone they were 36."""
    import sys

    from recordmill.functions import outline

    rows = "".join(f"<tr><td>0{i}/01/2020</td><td>x</td><td><a href=\"/d/{i}\">y</a></td></tr>" for i in range(1, 10))
    html = f"<html><body><table>{rows}</table></body></html>"
    lines = 0

    def count(frame, event, arg):
        nonlocal lines
        lines += event == "line" and frame.f_code.co_filename == outline.__file__
        return count

    before = sys.gettrace()
    sys.settrace(count)
    try:
        outline._Page(html)
    finally:
        sys.settrace(before)
    assert lines <= 25 * html.count("<")


def test_later_pages_are_not_searched_for_a_project(spark):
    html = "<h1>t</h1><p class='autores'>Ana</p><td>Estado</td><td>x</td>" + table(("01/01/2020", "a"))
    df = frame(spark, html, html)
    rows = pages.outline_pages(df, project=F.col("page_no") == 1).orderBy("page_no").collect()
    assert rows[0].outline.headings[0] == "t" and rows[0].outline.authors == "Ana" and rows[0].outline.labels
    assert (rows[1].outline.headings, rows[1].outline.authors, rows[1].outline.labels) == (None, None, None)
    assert rows[0].outline.rows == rows[1].outline.rows and rows[0].event_table == rows[1].event_table == 0
    first, second = pages.extract_pages(df).orderBy("page_no").collect()
    assert first.project.title == "t" and second.project is None
    assert len(first.events) == len(second.events) == 1


def test_facts_that_are_not_asked_for_are_not_searched(spark):
    html = "<h1>t</h1><td>Estado</td><td>x</td>" + table(("01/01/2020", "a"))
    df = frame(spark, html)
    project = pages.outline_pages(df, events=F.lit(False)).first()
    whole = pages.outline_pages(df).first()
    assert (project.outline.tables, project.outline.rows, project.outline.words, project.event_table) == (None,) * 4
    assert project.outline.headings == whole.outline.headings and project.outline.labels == whole.outline.labels
    assert whole.event_table == 0 and len(whole.outline.rows) == 1
    assert pages.outline_pages(df, labels=[], events=F.lit(False)).first().outline.labels == []


def test_pages_are_read_in_many_tasks(spark, sf_dir):
    """Their rows are few bytes for the work they take: dealt out by bytes, a core would get one task and a last core two."""
    from checks.seed_pages import seed_pages as built_pages

    setting = "spark.sql.autoBroadcastJoinThreshold"  # the small tables here as large ones are joined
    given = spark.conf.get(setting)
    spark.conf.set(setting, "-1")
    try:
        built = built_pages(spark, sf_dir).where("version = 1")
        parts = built.groupBy(F.spark_partition_id().alias("part")).agg(F.max("html")).collect()
        assert len(parts) >= int(spark.conf.get("spark.sql.shuffle.partitions"))
    finally:
        spark.conf.set(setting, given)


def test_plain_tags_take_no_pattern_and_attributes_are_read_when_asked_for(monkeypatch):
    """A tag that is only a name is looked up; of the attributes only those of the elements a rule names are read."""
    from recordmill.functions import outline

    class Counted:
        def __init__(self, found):
            self.found, self.calls = found, 0

        def match(self, *given):
            return self(*given)

        def __call__(self, *given):
            self.calls += 1
            return self.found(*given)

    pattern, attributes = Counted(outline._TEXT_AND_TAG.match), Counted(outline._attributes)
    monkeypatch.setattr(outline, "_TEXT_AND_TAG", pattern)
    monkeypatch.setattr(outline, "_attributes", attributes)
    row = '<tr><td class="d">01/01/2020</td><td>x</td><td><b id="k"><a href="/d">y</a></b></td></tr>'
    facts = outline._outline(f"<html><title>t</title><table>{row * 10}</table></html>", "https://h.example", [], False, True)
    assert facts["tables"] == [{"first": 0, "rows": 10, "dated": 10}] and facts["rows"][9]["link"] == "https://h.example/d"
    assert pattern.calls == 30  # class, id, href
    assert attributes.calls == 10  # href


def test_an_attribute_that_cannot_be_read_is_the_error_of_its_page():
    html = f'<table><tr><td title="&#{"9" * 5000};">01/01/2020</td><td>x</td></tr></table>'
    for project, events in ((True, True), (True, False), (False, True)):
        assert "integer string conversion" in _outline_with(html, project, events)["error"]


def _outline_with(html, project, events):
    from recordmill.functions import outline

    return outline._outline(html, "https://h.example", [], project, events)


def test_a_declaration_does_not_slow_the_page_down(monkeypatch):
    """Text, comments and tags are found one by one only where the usual way does not do."""
    from recordmill.functions import outline

    calls = []
    one_by_one = outline._Page._next_tag
    monkeypatch.setattr(outline._Page, "_next_tag", lambda self, *args: calls.append(args) or one_by_one(self, *args))
    page = outline._Page("a<!DOCTYPE html>b<?xml x?><p>c<style><!x></style></p>d")
    assert (page.text_nodes, page.tags, calls) == (["a", "b", "c", "d"], ["p", "style"], [])
    page = outline._Page("a<!-- <b> > -->b<!>c")
    assert (page.text_nodes, page.tags, len(calls)) == (["a", "b", "c"], [], 1)


@pytest.mark.parametrize("base", ["https://h.example", "http://h.example:80/p/q?x", "", "mailto:a@b", "//h/x", "https://", "https://[bad"])
def test_links_from_the_root_are_resolved_as_all_others(monkeypatch, base):
    from recordmill.functions import outline

    links = ["/doc/1", "/doc/1/", "/d.pdf?k=1&l=%20", "/a.b-c/_d", "/", "/./a", "/a/../b", "/.a", "//o/p", "/a//b", "/a?", "/a;p", "/a#f", "/é", "d", "?q", ""]
    got = [outline._resolved(base, link) for link in links]
    assert outline._ROOT_PATH.fullmatch("/doc/1") and not outline._ROOT_PATH.fullmatch("/a/../b")
    joined, calls = outline.urljoin, []
    monkeypatch.setattr(outline, "urljoin", lambda *args: calls.append(args) or joined(*args))
    if not base.endswith("[bad"):
        outline._resolved(base, "/doc/1")
        assert calls == []
    monkeypatch.setattr(outline, "_ROOT_PATH", outline.re.compile("(?!)"))
    assert got == [outline._resolved(base, link) for link in links]


def test_labels_do_not_travel_with_each_page(spark):
    df = spark.createDataFrame([("https://h.example/", 1, 200, "<td>Estado<td>x", None)], "seed_url string, page_no int, http_status int, html string, fetch_error string")
    outlined = pages.outline_pages(df, labels=["ESTADO", "Autores"])
    plan = outlined._jdf.queryExecution().analyzed().toString()
    assert "estado" not in plan and "autores" not in plan
    assert outlined.select(pages.label_value(outlined.outline, "ESTADO")).first()[0] == "x"
