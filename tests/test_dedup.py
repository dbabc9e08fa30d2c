"""Duplicate groups, against a plain brute-force version on small fixtures."""

import hashlib
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from recordmill.operators import dedup, quality
from recordmill.operators.dedup import assign_duplicate_groups, duplicate_clusters, select_canonical
from recordmill.schema import NORMALIZED_COLUMNS, NORMALIZED_SCHEMA, PARSE_ERROR_FIELDS

RANK = {"detail": 0, "table": 1, "api": 2, "news": 3, "misc": 4}


def record(record_id, **values):
    base = dict.fromkeys(NORMALIZED_COLUMNS, "") | {"source_type": "misc", "title": "T"}
    return base | values | {"record_id": record_id}


def frame(spark, rows):
    return spark.createDataFrame([tuple(r[c] for c in NORMALIZED_COLUMNS) for r in rows], NORMALIZED_SCHEMA)


def gid(key):
    return "GRP-" + hashlib.md5(key.encode()).hexdigest()[:12].upper()


def key_of(r):
    url, bulletin, digest = (r[c].strip() for c in ("canonical_url", "bulletin_number", "content_hash_hint"))
    title = r["title"].strip().lower()
    if url:
        return "url:" + url
    if bulletin and title:
        return f"bt:{bulletin}||{title}"
    return f"ht:{digest}||{title}" if digest and title else None


def brute_force(rows):
    groups = defaultdict(list)
    for r in rows:
        groups[key_of(r)].append(r)
    result = []
    for key, members in groups.items():
        if key is None or len(members) == 1:
            result += [(gid("singleton:" + m["record_id"]), m["record_id"], True) for m in members]
            continue
        # Stable sorts, least important first.
        best = sorted(members, key=lambda m: m["record_id"])
        best.sort(key=lambda m: max(m["published_at"].strip(), m["event_date"].strip()), reverse=True)
        best.sort(key=lambda m: RANK.get(m["source_type"].strip().lower(), 99))
        best.sort(key=lambda m: -sum(bool(m[f].strip()) for f in dedup.RELEVANT_FIELDS))
        result += [(gid(key), m["record_id"], m["record_id"] == best[0]["record_id"]) for m in members]
    return sorted(result)


def got(df):
    return sorted(
        (r.duplicate_group_id, r.record_id, r.is_canonical)
        for r in df.select("duplicate_group_id", "record_id", "is_canonical").collect()
    )


def random_rows(n, seed):
    rng = random.Random(seed)

    def one(i):
        hot = rng.random() < 0.35  # one key holds a third of all rows
        return record(
            f"R{rng.randrange(n):05d}" if rng.random() < 0.2 else f"R{i:05d}",
            canonical_url="https://e.com/hot" if hot else rng.choice(["", "", f"https://e.com/{rng.randrange(n // 4)}"]),
            bulletin_number=rng.choice(["", f"1000{rng.randrange(9)}-01"]),
            content_hash_hint=rng.choice(["", f"h{rng.randrange(20)}"]),
            title=rng.choice(["", "A", "a", " Á ", "b"]),
            source_type=rng.choice(["detail", " API ", "x", "misc"]),
            published_at=rng.choice(["", "2024-01-01", "2024-01-01T10:00:00+03:00", "2023-05-05"]),
            event_date=rng.choice(["", "2024-01-02", "2022-01-01"]),
            summary=rng.choice(["", "s"]),
        )

    return [one(i) for i in range(n)]


def test_each_rule(spark):
    rows = [
        record("U1", canonical_url="https://e.com/a"), record("U2", canonical_url="https://e.com/a", title="other"),
        record("B1", bulletin_number="10000-01"), record("B2", bulletin_number="10000-01", title="t "),
        record("H1", content_hash_hint="h"), record("H2", content_hash_hint="h"),
        record("H3", content_hash_hint="h", title="another"),
        record("X1", bulletin_number="20000-01", canonical_url="https://e.com/x"),
        record("X2", bulletin_number="20000-01"),  # a row with a URL is never compared by bulletin
        record("N1", content_hash_hint="h", title=""), record("N2", title="T"),
    ]
    result = assign_duplicate_groups(frame(spark, rows))
    assert got(result) == brute_force(rows)
    reasons = {r.record_id: r.duplicate_reason for r in duplicate_clusters(result).collect()}
    assert reasons == {
        "U1": "same_url", "U2": "same_url", "B1": "same_bulletin_and_title", "B2": "same_bulletin_and_title",
        "H1": "same_hash_and_title", "H2": "same_hash_and_title", "H3": "same_hash_and_title",
        "X1": "same_url", "X2": "same_bulletin_and_title", "N1": "unique", "N2": "unique",
    }
    assert duplicate_clusters(result).columns == ["duplicate_group_id", "record_id", "is_kept", "duplicate_reason"]


@pytest.mark.parametrize("better,worse", [
    (dict(summary="s"), dict(source_type="detail")),
    (dict(source_type="table"), dict(source_type="api", )),
    (dict(event_date="2024-02-01", published_at="2020-01-01"), dict(event_date="2024-01-31", published_at="2021-01-01")),
    (dict(published_at="2024-01-01T00:00:00"), dict(published_at="2024-01-01")),
])
def test_preference(spark, better, worse):
    rows = [record("Z", canonical_url="https://e.com", **better), record("A", canonical_url="https://e.com", **worse)]
    kept = [r for r in got(assign_duplicate_groups(frame(spark, rows))) if r[2]]
    assert [k[1] for k in kept] == ["Z"]
    assert [r.kept_record_id for r in select_canonical(frame(spark, rows)).collect()] == ["Z"]


def test_least_id_settles_ties_and_repeated_ids_are_all_kept(spark):
    rows = [record(i, canonical_url="https://e.com") for i in ("R2", "R1", "R1", "R3")]
    assert [r[1:] for r in got(assign_duplicate_groups(frame(spark, rows)))] == [
        ("R1", True), ("R1", True), ("R2", False), ("R3", False)]


def test_random_rows_with_a_hot_key(spark):
    rows = random_rows(900, seed=3)
    assert got(assign_duplicate_groups(frame(spark, rows))) == brute_force(rows)


def test_a_key_on_a_third_of_all_rows_is_split(spark):
    """Default arguments; only the thresholds of the session are small, as the rows are few."""
    changed = {
        "spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "50k", "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    before = {k: spark.conf.get(k) for k in changed}
    ids = spark.range(60_000).select(
        F.format_string("R%06d", "id").alias("record_id"), F.lit("T").alias("title"), F.md5(F.col("id").cast("string")).alias("summary"),
        F.when(F.col("id") % 3 == 0, F.lit("https://e.com/hot")).otherwise(F.concat(F.lit("https://e.com/"), F.col("id"))).alias("canonical_url"))
    try:
        for k, v in changed.items():
            spark.conf.set(k, v)
        whole = assign_duplicate_groups(ids.repartition(8))
        parts = whole.groupBy(F.spark_partition_id()).agg(
            F.count_if(F.col("canonical_url") == "https://e.com/hot").alias("n"), *[F.max(c) for c in whole.columns])
        sizes = [r.n for r in parts.collect()]
        whole.collect()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert "skew=true" in whole._jdf.queryExecution().executedPlan().toString()
    assert sum(sizes) == 20_000 and max(sizes) < 15_000


@pytest.fixture
def without_adaptive_execution(spark):
    changed = {"spark.sql.adaptive.enabled": "false", "spark.sql.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k) for k in changed}
    for k, v in changed.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def largest_part(df, condition):
    return max(r.n for r in df.groupBy(F.spark_partition_id()).agg(F.count_if(condition).alias("n"), *[F.max(c) for c in df.columns]).collect())


def test_a_key_on_a_third_of_all_rows_is_split_without_adaptive_execution(spark, without_adaptive_execution):
    ids = spark.range(60_000).select(
        F.format_string("R%06d", "id").alias("record_id"), F.lit("T").alias("title"),
        F.when(F.col("id") % 3 == 0, F.lit("https://e.com/hot")).otherwise(F.concat(F.lit("https://e.com/"), F.col("id"))).alias("canonical_url"))
    whole = assign_duplicate_groups(ids.repartition(8))
    hot = F.col("canonical_url") == "https://e.com/hot"
    assert "AdaptiveSparkPlan" not in whole._jdf.queryExecution().executedPlan().toString()
    assert largest_part(whole, hot) < 6_000  # of 20,000 in 8 partitions
    kept = whole.where(hot & F.col("is_canonical")).collect()
    assert whole.count() == 60_000 and [r.record_id for r in kept] == ["R000000"]


def test_equal_rows_and_rows_without_a_key_are_split_too(spark, without_adaptive_execution):
    """A record stored 8,000 times, with a key and without, spreads over the tasks."""
    same = spark.range(16_000, numPartitions=32).select(
        F.lit("R1").alias("record_id"), F.lit("T").alias("title"),
        F.when(F.col("id") % 2 == 0, F.lit("https://e.com")).otherwise(F.lit("")).alias("canonical_url"))
    whole = assign_duplicate_groups(same)
    for url, group in (("https://e.com", gid("url:https://e.com")), ("", gid("singleton:R1"))):
        assert largest_part(whole, F.col("canonical_url") == url) < 4_000
        assert [r.duplicate_group_id for r in whole.where(F.col("canonical_url") == url).select("duplicate_group_id").distinct().collect()] == [group]
    assert whole.where("is_canonical").count() == 16_000


@pytest.mark.parametrize("share", [2, 64, 100_000])  # no key, some keys and all groups are large
def test_salted_keys_give_the_same_groups(spark, without_adaptive_execution, monkeypatch, share):
    monkeypatch.setattr(dedup, "LARGE_SHARE", share)
    rows = random_rows(500, seed=11)
    assert got(assign_duplicate_groups(frame(spark, rows).repartition(5))) == brute_force(rows)
    assert got(assign_duplicate_groups(frame(spark, []))) == []


def test_partitions_and_row_order_do_not_matter(spark):
    rows = random_rows(400, seed=8)
    want = brute_force(rows)
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in ("1", "200"):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            random.Random(partitions).shuffle(rows)
            assert got(assign_duplicate_groups(frame(spark, rows).repartition(7))) == want
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_absent_columns_and_nulls_count_as_blank(spark):
    df = spark.createDataFrame([("R1", "https://e.com"), ("R2", "https://e.com"), ("R3", None)],
                               "record_id string, canonical_url string")
    result = assign_duplicate_groups(df)
    assert result.columns == ["record_id", "canonical_url", "duplicate_group_id", "is_canonical", "group_digest"]
    assert [r[1:] for r in got(result) if r[0] == gid("url:https://e.com")] == [("R1", True), ("R2", False)]
    assert (gid("singleton:R3"), "R3", True) in got(result)


def test_groups_that_share_a_published_id_are_counted_apart(spark, monkeypatch):
    monkeypatch.setattr(dedup, "stable_group_id", lambda key: F.lit("GRP-SAME"))
    rows = [record(f"{k}{i}", canonical_url=f"https://e.com/{k}") for k in "ab" for i in range(2)] + [record("X"), record("Y")]
    grouped = assign_duplicate_groups(frame(spark, rows))
    assert sorted(r.group_size for r in quality.duplicate_group_sizes(grouped).collect()) == [1, 1, 2, 2]
    evaluated = frame(spark, rows).withColumns({
        "rejection_reason": F.lit(""), "parse_failed": F.struct(*[F.lit(False).alias(c) for c in PARSE_ERROR_FIELDS])})
    report = quality.quality_report(evaluated, grouped).first()
    assert (report.duplicate_groups, report.duplicates_removed, report.normalized_rows) == (2, 2, 4)


def test_descending_text_reverses_byte_order(spark):
    texts = ["", "2", "2024", "2024-01-01", "2024-01-01T", "é", "z", "\U0001f600", "2025"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    ordered = [r.t for r in df.orderBy(dedup._descending(F.col("t"))).collect()]
    assert ordered == sorted(texts, key=lambda t: t.encode(), reverse=True)
