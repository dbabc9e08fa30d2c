"""Duplicate groups and the choice of one canonical record for each.

A record's key is the first that applies of URL, bulletin with title, and hash with
title. Statistics of a key are aggregated before any row moves, so a key that holds a
large share of all rows costs each task one partial row. They are written once, and all
rows meet them in one plain join of two tables, whose large partitions AQE splits: a key's
rows need not lie together, because each asks its statistics for itself alone.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recordmill.functions.scoring import (
    RELEVANT_FIELDS,
    best_date,
    richness,
    source_rank,
    stable_group_id,
)
from recordmill.functions.strings import or_blank, stripped
from recordmill.schema import CLUSTER_COLUMNS
from recordmill.staging import stage

# Key prefixes and the reasons that go with them.
URL_KEY, BULLETIN_KEY, HASH_KEY, SINGLETON_KEY = "url:", "bt:", "ht:", "singleton:"
SAME_URL = "same_url"
SAME_BULLETIN = "same_bulletin_and_title"
SAME_HASH = "same_hash_and_title"
UNIQUE = "unique"

_DEDUP_FIELDS = [
    "record_id", "source_type", "content_hash_hint", *RELEVANT_FIELDS,
]


def _with_defaults(df: DataFrame) -> DataFrame:
    """Columns the operators read; absent ones count as blank."""
    absent = [c for c in _DEDUP_FIELDS if c not in df.columns]
    return df.withColumns({c: F.lit("") for c in absent}) if absent else df


def _by_key_kind(by_url: Column, by_bulletin: Column, by_hash: Column, other: Column) -> Column:
    url, bulletin = stripped(F.col("canonical_url")), stripped(F.col("bulletin_number"))
    title, digest = stripped(F.col("title")), stripped(F.col("content_hash_hint"))
    return (
        F.when(url != "", by_url)
        .when((bulletin != "") & (title != ""), by_bulletin)
        .when((digest != "") & (title != ""), by_hash)
        .otherwise(other)
    )


def duplicate_key() -> Column:
    """The record's key text, null when no rule applies."""
    title = F.lower(stripped(F.col("title")))

    def with_title(prefix: str, name: str) -> Column:
        return F.concat(F.lit(prefix), stripped(F.col(name)), F.lit("||"), title)

    return _by_key_kind(
        F.concat(F.lit(URL_KEY), stripped(F.col("canonical_url"))),
        with_title(BULLETIN_KEY, "bulletin_number"),
        with_title(HASH_KEY, "content_hash_hint"),
        F.lit(None).cast("string"),
    )


def duplicate_reason() -> Column:
    """Name of the rule that gives the record its key, in a group or alone."""
    return _by_key_kind(F.lit(SAME_URL), F.lit(SAME_BULLETIN), F.lit(SAME_HASH), F.lit(UNIQUE))


def _descending(text: Column) -> Column:
    """Text whose byte order is the reverse of the input's."""
    return F.concat(
        F.translate(F.hex(text), "0123456789ABCDEF", "FEDCBA9876543210"), F.lit("~")
    )


def canonical_preference() -> Column:
    """Sorts a group's best record first: richest, best source, latest date, least id."""
    return F.struct(
        (-richness()).alias("richness"),
        source_rank(F.col("source_type")).alias("source_rank"),
        _descending(best_date(F.col("published_at"), F.col("event_date"))).alias("date"),
        or_blank(F.col("record_id")).alias("record_id"),
    )


_HELPERS = ["_dup_key", "_key", "_prefer"]


def with_group_columns(df: DataFrame) -> DataFrame:
    """Adds what grouping reads: the key, its digest and the record's place in its group.

    The digest has a fixed width whatever a title's length. A job that stages its records
    adds these columns before, so that grouping need not read the texts again.
    """
    if all(c in df.columns for c in _HELPERS):
        return df
    keyed = _with_defaults(df).withColumns(
        {"_dup_key": duplicate_key(), "_prefer": canonical_preference()}
    )
    # Rows without a key spread by id instead of meeting in one partition.
    spread = F.coalesce("_dup_key", F.concat(F.lit(SINGLETON_KEY), or_blank(F.col("record_id"))))
    return keyed.withColumn("_key", F.unhex(F.sha2(spread, 256)))


def _key_statistics(keyed: DataFrame) -> DataFrame:
    """``_key, _size, _kept_id`` of each key."""
    return keyed.groupBy("_key").agg(
        F.count(F.lit(1)).alias("_size"), F.min("_prefer").alias("_best")
    ).select("_key", "_size", F.col("_best.record_id").alias("_kept_id"))


def select_canonical(df: DataFrame) -> DataFrame:
    """``duplicate_group_id, group_size, kept_record_id`` for each group of two or more."""
    keyed = with_group_columns(df).where(F.col("_dup_key").isNotNull())
    return (
        keyed.groupBy("_key")
        .agg(
            F.count(F.lit(1)).alias("group_size"),
            F.min("_prefer").alias("_best"),
            F.first("_dup_key").alias("_dup_key"),
        )
        .where(F.col("group_size") > 1)
        .select(
            stable_group_id(F.col("_dup_key")).alias("duplicate_group_id"),
            "group_size",
            F.col("_best.record_id").alias("kept_record_id"),
        )
    )


#: A key is large if it holds more than one in so many rows; there are fewer such keys than this.
LARGE_SHARE = 64
#: Parts that a large key is dealt to if the session does not split it by itself.
LARGE_PARTS = 64


def _splits_by_itself(df: DataFrame) -> bool:
    conf = df.sparkSession.conf
    return all(
        str(conf.get(f"spark.sql.adaptive.{name}", "true")).lower() == "true" for name in ("enabled", "skewJoin.enabled"))


def _dealt(keyed: DataFrame, groups: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both sides with ``_salt``: rows of large keys in parts, and their statistics once for each part.

    The part of a row follows from its place in its group and the partition it comes from, so a
    task that runs again sends it the same way, and equal rows spread as far as they are stored
    apart. Fewer than ``LARGE_SHARE`` keys go to the driver. Rows without a key meet no statistics,
    so they are dealt whatever their number.
    """
    total = keyed.agg(F.count(F.lit(1))).first()[0]
    large = [bytes(r._key) for r in groups.where(F.col("_size") * LARGE_SHARE > total).select("_key").collect()]
    is_large = F.col("_key").isin(large) if large else F.lit(False)
    part = F.pmod(F.xxhash64("_prefer", F.spark_partition_id()), F.lit(LARGE_PARTS)).cast("int")
    copies = F.sequence(F.lit(0), F.when(is_large, F.lit(LARGE_PARTS - 1)).otherwise(F.lit(0)))
    return (
        keyed.withColumn("_salt", F.when(is_large | F.col("_dup_key").isNull(), part).otherwise(F.lit(0))),
        groups.withColumn("_salt", F.explode(copies)),
    )


def grouped_columns(df: DataFrame) -> DataFrame:
    """An empty table of the columns that ``assign_duplicate_groups`` gives; runs nothing."""
    return df.limit(0).select(
        *[c for c in df.columns if c not in _HELPERS],
        stable_group_id(F.lit("")).alias("duplicate_group_id"),
        F.lit(True).alias("is_canonical"),
        F.unhex(F.sha2(F.lit(""), 256)).alias("group_digest"),
    )


def assign_duplicate_groups(df: DataFrame) -> DataFrame:
    """Adds ``duplicate_group_id``, ``is_canonical`` and ``group_digest``; other columns unchanged.

    The published id is a short prefix of a digest, so different groups may share one. The full
    ``group_digest`` tells them apart and is for counting; published tables leave it out.

    Runs a job, which writes the statistics of the keys of two rows or more. The input is read
    for that and again for the rows, so a costly input should be staged before. Adaptive execution
    splits large keys; in a session without it they are salted, for which the rows are counted.
    """
    keyed = with_group_columns(df)
    groups = stage(_key_statistics(keyed).where(F.col("_size") > 1), "groups")
    grouped = F.col("_size").isNotNull() & F.col("_dup_key").isNotNull()
    record_id = or_blank(F.col("record_id"))
    key = F.when(grouped, F.col("_dup_key")).otherwise(
        F.concat(F.lit(SINGLETON_KEY), record_id)
    )
    if _splits_by_itself(df):
        joined = keyed.join(groups, "_key", "left")
    else:
        rows, statistics = _dealt(keyed, groups)
        joined = rows.join(statistics, ["_key", "_salt"], "left")
    return joined.select(
        *[c for c in df.columns if c not in _HELPERS],
        stable_group_id(key).alias("duplicate_group_id"),
        F.when(grouped, record_id == F.col("_kept_id")).otherwise(F.lit(True)).alias("is_canonical"),
        F.unhex(F.sha2(key, 256)).alias("group_digest"),
    )


def duplicate_clusters(grouped: DataFrame) -> DataFrame:
    """One lineage row for each record."""
    return _with_defaults(grouped).select(
        F.col("duplicate_group_id"),
        F.col("record_id"),
        F.col("is_canonical").alias("is_kept"),
        duplicate_reason().alias("duplicate_reason"),
    ).select(*CLUSTER_COLUMNS)
