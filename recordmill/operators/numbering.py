"""Global order and dense numbers without a single-task sort.

Rows are range-partitioned and sorted, then checkpointed with their place: range bounds are
sampled, so a recomputation could move rows between partitions. A row's number is its
position in its partition plus the sizes of the partitions before, a table of one row for
each partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from recordmill.schema import CANONICAL_COLUMNS
from recordmill.staging import checkpointed

# Prefix and least width of a canonical id.
ID_FORMAT = "CAN-%06d"

_DIGEST = "_digest"
_POSITION_BITS = 33  # monotonically_increasing_id: partition above, position below


def with_digest(canonical: DataFrame) -> DataFrame:
    """Adds a digest of a row's content, computed once, which only settles repeated ids."""
    content = [F.col(c) for c in CANONICAL_COLUMNS if c in canonical.columns]
    return canonical.withColumn(_DIGEST, F.md5(F.concat_ws("\x1f", *content)))


def canonical_order() -> list[Column]:
    """Record id first; group and content only settle repeated ids."""
    return [F.col("record_id"), F.col("duplicate_group_id"), F.col(_DIGEST)]


def order_canonical(canonical: DataFrame) -> DataFrame:
    return with_digest(canonical).orderBy(*canonical_order()).drop(_DIGEST)


def partition_sizes(placed: DataFrame) -> DataFrame:
    """``_part, _rows`` of each partition of placed rows."""
    return placed.groupBy("_part").agg(F.count(F.lit(1)).alias("_rows"))


def assign_canonical_ids(canonical: DataFrame) -> DataFrame:
    """Adds ``canonical_id`` and ``kept_record_id`` in canonical order.

    Runs jobs. Rows come out in order over the partitions, so a file sink keeps it: the sorted
    ranges are checkpointed, which keeps their partitions as they are, and are only numbered
    when they are read. No second exchange of rows is needed.
    """
    order = canonical_order()
    place = F.col("_place")
    placed = checkpointed(
        with_digest(canonical).repartitionByRange(*order).sortWithinPartitions(*order)
        .drop(_DIGEST).withColumn("_place", F.monotonically_increasing_id())
        .withColumns({
            "_part": F.shiftright(place, _POSITION_BITS).cast("int"),
            "_place": place.bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)),
        })
    )
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = partition_sizes(placed).select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        placed.join(F.broadcast(offsets), "_part")
        .withColumn("canonical_id", F.format_string(ID_FORMAT, F.col("_offset") + place + 1))
        .withColumn("kept_record_id", F.col("record_id"))
        .drop("_part", "_place", "_offset")
    )
