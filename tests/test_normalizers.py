from pyspark.sql import functions as F

from recordmill.functions.authors import normalize_authors, split_people
from recordmill.functions.bulletin import bulletin_from_url, normalize_bulletin, page_file_name
from recordmill.functions.dates import normalize_date
from recordmill.functions.outline import clean_node_text
from recordmill.functions.scoring import best_date, source_rank, stable_group_id
from recordmill.functions.text import normalize_text
from recordmill.functions.urls import normalize_url


def test_text(evaluate):
    evaluate(normalize_text, [
        ("  both ends  ", "both ends"),
        ("a \t b\r\n\n c", "a b c"),
        ("a\tb", "a b"),
        ("fish &amp; chips", "fish & chips"),
        ("&amp;lt;tag&amp;gt;", "<tag>"),
        ("<p>one <b>two</b></p>", "one two"),
        ("<b>Hel</b>lo", "Hel lo"),
        ("a<!-- hidden -->b", "a b"),
        ("x<script>var y = '<b>';</script><style>p{}</style>z", "x z"),
        ("<div><template>no</template>yes</div>", "yes"),
        ("\xa0 a\xa0b \xa0", "a\xa0b"),
        ("&nbsp;a&nbsp;b", "a\xa0b"),
        ("1 < 2 & 3", "1 < 2 & 3"),
        ("AT&T rates", "AT&T rates"),
        ("&unknownthing; x", "&unknownthing x"),
        ("&#233;&#xE9;&eacute;", "ééé"),
        ("<![CDATA[in]]>out", "in out"),
        ("line<br/>break", "line break"),
        ("unclosed <b", "unclosed <b"),
        ("NA", "NA"),
        ("", ""),
        (None, ""),
        ("   ", ""),
    ])


def test_bulletin(evaluate):
    evaluate(normalize_bulletin, [
        ("11422-07", "11422-07"),
        ("1142207", "11422-07"),
        ("11422/07", "11422-07"),
        (" 11422 - 07 ", "11422-07"),
        ("11422\u201307", "11422-07"),
        ("114220-07", ""),
        ("11422070", ""),
        ("17000-XX", ""),
        ("11422-07\n", "11422-07"),
        ("11422-07\n\n1", ""),
        ("x11422-07", ""),
        ("１１４２２-07", ""),
        ("", ""),
        (None, ""),
    ])


def test_url(evaluate):
    evaluate(normalize_url, [
        ("https://EXAMPLE.com/Path", "https://example.com/Path"),
        ("HTTP://Example.com", "http://example.com"),
        ("https://example.com/", "https://example.com"),
        ("https://example.com/docs///", "https://example.com/docs"),
        ("https://e.com/a?utm_source=x&id=1", "https://e.com/a?id=1"),
        ("https://e.com/a?UTM_Medium=x&GCLID=2&fbclid=3", "https://e.com/a"),
        ("https://e.com/a?utm_other=1", "https://e.com/a?utm_other=1"),
        ("https://e.com/?b=2&a=1&b=1", "https://e.com?a=1&b=2&b=1"),
        ("https://e.com/?a=1&b=2&&c", "https://e.com?a=1&b=2&c="),
        ("https://e.com/x?id=1/", "https://e.com/x?id=1%2F"),
        ("https://e.com/x?q=a b+c%20d", "https://e.com/x?q=a+b+c+d"),
        ("https://e.com/x?q=%zz~*", "https://e.com/x?q=%25zz~%2A"),
        ("https://e.com/x?q=%C3%A9", "https://e.com/x?q=%C3%A9"),
        ("https://e.com/x?q=é", "https://e.com/x?q=%C3%A9"),
        ("https://e.com/x?%62=1&a=2", "https://e.com/x?a=2&b=1"),
        ("https://e.com/a|b", "https://e.com/a|b"),
        ("https://User:Pw@E.com:8080/a#Frag?x", "https://user:pw@e.com:8080/a#Frag?x"),
        ("https://e.com/a#", "https://e.com/a"),
        ("https://e.com/a?", "https://e.com/a"),
        ("https://e.com/a;p=1", "https://e.com/a;p=1"),
        ("https://e.com/a/;p", "https://e.com/a;p"),
        ("https://e.com/;p", "https://e.com/;p"),
        ("https://e.com/a;", "https://e.com/a"),
        ("https://e.com/a;b/c", "https://e.com/a;b/c"),
        ("https://e.com/a;b;c", "https://e.com/a;b;c"),
        ("odd+s.1-x://h/a;/", "odd+s.1-x://h/a;"),
        ("https://e.com/a\tb\n", "https://e.com/ab"),
        ("  https://e.com/a  ", "https://e.com/a"),
        ("http://[::1]:80/a", "http://[::1]:80/a"),
        ("http://[v1.a]/", "http://[v1.a]"),
        ("http://[bad/x", ""),
        ("http://[nothex]/", ""),
        ("http://a]b/", ""),
        ("https:///path", ""),
        ("//e.com/a", ""),
        ("mailto:a@b.c", ""),
        ("e.com/a", ""),
        ("1http://e.com", ""),
        ("", ""),
        (None, ""),
    ])


def test_url_twice_changes_nothing(spark, evaluate):
    once = [
        "https://e.com/x?q=a+b&r=%2F", "https://e.com/;p", "https://e.com/a|b#f", "http://[::1]:80/a",
    ]
    evaluate(normalize_url, [(u, u) for u in once])


def test_date(evaluate):
    evaluate(normalize_date, [
        ("2024-03-15", "2024-03-15"),
        ("2024/3/5", "2024-03-05"),
        ("15/03/2024", "2024-03-15"),
        ("03/04/2024", "2024-03-04"),
        ("15.03.2024", "2024-03-15"),
        ("20240315", "2024-03-15"),
        ("2024-03-15T10:30:00", "2024-03-15T10:30:00"),
        ("2024-03-15 9:05", "2024-03-15T09:05:00"),
        ("2024-03-15T10:30:00+03:00", "2024-03-15T10:30:00+03:00"),
        ("2024-03-15T10:30:00Z", "2024-03-15T10:30:00+00:00"),
        ("2024-03-15T10:30:00.5-0400", "2024-03-15T10:30:00.500000-04:00"),
        ("2024-03-15T10:30:00.5", "2024-03-15T10:30:00"),
        ("March 15, 2024", "2024-03-15"),
        ("20 Nov. 2019", "2019-11-20"),
        ("Fri, 15 Mar 2024 10:30:00 GMT", "2024-03-15T10:30:00+00:00"),
        ("2024-03-15 10:30 CLT", "2024-03-15T10:30:00"),
        ("2024-03-15 10AM", "2024-03-15"),
        ("2024-03-15 10:30 PM", "2024-03-15T22:30:00"),
        ("20 de marzo de 2024", ""),
        ("2024-02-30", ""),
        ("31/04/2024", ""),
        ("2024", ""),
        ("March 2024", ""),
        ("10:30", ""),
        ("Friday", ""),
        ("not a date", ""),
        ("  ", ""),
        ("", ""),
        (None, ""),
    ])


def test_authors(evaluate):
    evaluate(normalize_authors, [
        ("Alice", "Alice"),
        ("Alice, Bob", "Alice | Bob"),
        ("Alice | Bob, Jr", "Alice | Bob, Jr"),
        ("Alice; Bob, Jr", "Alice | Bob, Jr"),
        ('["Alice", "Bob"]', "Alice | Bob"),
        ('[{"name": "Alice"}, {"author": "Bob"}, {"full_name": "Cy"}]', "Alice | Bob | Cy"),
        ('[{"name": "", "author": "Bob"}, {"name": null, "full_name": "Cy"}]', "Bob | Cy"),
        ('[{"name": 0, "author": "Bob"}, {"name": 5}, {"name": true}]', "Bob | 5 | True"),
        ('{"name": "Alice"}', "Alice"),
        ('{"full_name": "Alice"}', '{"full_name": "Alice"}'),
        ("Alice, Bob, Alice", "Alice | Bob"),
        ("Alice, ALICE, bob, Bob", "Alice | bob"),
        ("[]", "[]"),
        ('[""]', ""),
        ('["", "A"]', "A"),
        ("[1, 2]", "[1 | 2]"),
        ('["Alice", 3]', "Alice"),
        ('["unclosed', '["unclosed'),
        ("[Alice, Bob]", "[Alice | Bob]"),
        ("  Alice  ", "Alice"),
        (" , ,", ""),
        ("", ""),
        (None, ""),
    ])


def test_small_functions(evaluate):
    evaluate(source_rank, [
        ("detail", 0), (" Table ", 1), ("API", 2), ("news", 3), ("misc", 4), ("x", 99), (None, 99),
    ])
    evaluate(lambda c: F.array_join(split_people(c), "/"), [
        ("A; B, C\nD", "A/B/C/D"), (" ;,", ""), ("A;A", "A/A"), (None, ""),
    ])
    evaluate(clean_node_text, [
        ("<p> a\xa0 b<i>c</i>\n</p>", "a b c"), ("<b>Hel</b>lo", "Hel lo"), (None, ""),
    ])
    evaluate(bulletin_from_url, [
        ("https://h/t?prmBoletin=11-07&x=1", "11-07"),
        ("https://h/t?x=1&PRMBOLETIN=%2011%20&prmBoletin=2", "11"),
        ("https://h/t?prmBoletin=&prmBOLETIN=7#f", "7"),
        ("https://h/t?prmBoletin=", ""),
        ("https://h/t#?prmBoletin=5", ""),
        (None, ""),
    ])
    evaluate(page_file_name, [
        ("https://h/t?prmBoletin=11422-07", "11422-07.html"),
        ("https://h/t?prmBoletin=a/b c", "a_b_c.html"),
        ("https://h/t?a=1&b=ñ", "a_1_b_ñ.html"),
        ("https://h/t?" + "x" * 100, "x" * 80 + ".html"),
        ("https://h/t", ".html"),
    ])


def test_group_id_is_a_digest_prefix(spark):
    import hashlib

    keys = ["url:https://example.com", "singleton:R1", "bt:11422-07||título"]
    df = spark.createDataFrame([(k,) for k in keys], "k string")
    for k, gid in df.select("k", stable_group_id(F.col("k"))).collect():
        assert gid == "GRP-" + hashlib.md5(k.encode()).hexdigest()[:12].upper()


def test_best_date_is_the_greater_string(spark):
    df = spark.createDataFrame(
        [("2024-01-01", "2023-12-31", "2024-01-01"), ("", "2023-01-01", "2023-01-01"),
         ("2024-01-01", "2024-01-01T00:00:00", "2024-01-01T00:00:00"), (None, None, "")],
        "p string, e string, want string")
    for r in df.withColumn("got", best_date(F.col("p"), F.col("e"))).collect():
        assert r.got == r.want


def test_functions_apply_to_a_stream(spark, tmp_path):
    spark.range(20).select(F.concat(F.lit(" <b>n</b>"), "id").alias("t")).write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("t string").parquet(str(tmp_path / "in"))
    sink = (
        stream.select(normalize_text(F.col("t")).alias("t")).writeStream.format("memory")
        .queryName("normalized_stream").option("checkpointLocation", str(tmp_path / "cp"))
        .trigger(availableNow=True).start()
    )
    sink.awaitTermination()
    assert spark.table("normalized_stream").where("t like 'n %'").count() == 20
