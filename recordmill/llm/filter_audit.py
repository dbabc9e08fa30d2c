"""Filter interaction audit by min-plus removal ranks.

Every row has a mask: the set of filters that it fails. ``M`` (masks x filters) is 0 where a
mask fails a filter and infinite elsewhere; ``P`` (orders x filters) is the inverse permutation
of each order, the step at which a filter runs. Their min-plus product is the step at which a
mask is removed under an order. Rows are counted by part and mask first, so that all orders
together cost ``2 ** filters`` masks for each part, whatever the number of rows; the counts are
then scattered to (order, removal step) as weights.
"""

from __future__ import annotations

from itertools import permutations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
MIN_WORDS = 200
MIN_DISTINCT = 50  # per hundred words
MAX_CAPITALS = 3  # per hundred code points
MARKS = "[#$%&*|]"
LETTERS = "ABCDE"


def inverse_positions(n: int) -> tuple[list[tuple[int, ...]], np.ndarray]:
    """All orders of ``n`` filters, and for each the step (from 1) of every filter."""
    orders = list(permutations(range(n)))
    steps = np.empty((len(orders), n))
    np.put_along_axis(steps, np.array(orders, dtype=np.int64).reshape(len(orders), n), np.arange(1.0, n + 1)[None, :], axis=1)
    return orders, steps


def min_plus(masks: np.ndarray, positions: np.ndarray) -> np.ndarray:
    """``out[m, o] = min over f of masks[m, f] + positions[o, f]``."""
    out = np.full((len(masks), len(positions)), np.inf)
    for f in range(masks.shape[1]):
        np.minimum(out, masks[:, f, None] + positions[None, :, f], out=out)
    return out


def interactions(classes: DataFrame, letters: str, weights: list[str]) -> DataFrame:
    """Counts for each part, order of filters and step, from ``classes(part, mask, n, *weights)``.

    ``mask`` has bit ``f`` set where filter ``letters[f]`` fails; ``n`` and ``weights`` are long
    counts, with one row for each part and mask at most. Returns ``part, filter_order, step,
    kept, removed, redundant, unique_fails, shapley`` and ``<weight>_lost`` for each weight; a
    part has a row for each order and step, zeros included. No classes, no rows.
    """
    n = len(letters)
    lost = [f"{w}_lost" for w in weights]
    counts = ["kept", "removed", "redundant", "unique_fails", *lost, "shapley"]

    def audit(key, rows):
        masks = rows["mask"].to_numpy()
        fails = (masks[:, None] >> np.arange(n)) & 1 == 1
        size = rows["n"].to_numpy(np.int64)
        orders, steps = inverse_positions(n)
        rank = min_plus(np.where(fails, 0.0, np.inf), steps)
        at = np.broadcast_to(np.arange(len(orders)), rank.shape)
        gone = np.isfinite(rank)
        step = np.where(gone, rank, 1).astype(np.int64) - 1

        def scattered(weight: np.ndarray) -> np.ndarray:
            out = np.zeros((len(orders), n), np.int64)
            np.add.at(out, (at[gone], step[gone]), np.broadcast_to(weight[:, None], rank.shape)[gone])
            return out

        order = np.array(orders).reshape(len(orders), n)
        removed = scattered(size)
        redundant = np.zeros((len(orders), n), np.int64)
        for f in range(n):  # failing f, but removed before f's own step
            early = fails[:, f, None] & (rank < steps[None, :, f])
            redundant[np.arange(len(orders)), steps[:, f].astype(np.int64) - 1] = (early * size[:, None]).sum(0)
        alone = np.array([size[masks == 1 << f].sum() for f in range(n)], np.int64)
        shapley = np.zeros(n, np.int64)
        np.add.at(shapley, order, removed)
        out = {
            "part": key[0], "filter_order": np.repeat(["".join(letters[f] for f in o) for o in orders], n),
            "step": np.tile(np.arange(1, n + 1, dtype=np.int32), len(orders)),
            "kept": (size.sum() - np.cumsum(removed, axis=1)).ravel(), "removed": removed.ravel(),
            "redundant": redundant.ravel(), "unique_fails": alone[order].ravel(),
            **{name: scattered(rows[w].to_numpy(np.int64)).ravel() for w, name in zip(weights, lost)},
            "shapley": shapley[order].ravel(),
        }
        return pd.DataFrame(out)

    schema = f"part string, filter_order string, step int, {', '.join(f'{c} long' for c in counts)}"
    return classes.groupBy("part").applyInPandas(audit, schema)


def text_failures(text: Column) -> list[Column]:
    """The conditions on a text alone: few words, few distinct ones, many capitals, marks."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    return [
        F.size(words) < MIN_WORDS,
        100 * F.size(F.array_distinct(words)).cast("long") < MIN_DISTINCT * F.size(words).cast("long"),
        100 * capitals.cast("long") > MAX_CAPITALS * F.char_length(text).cast("long"),
        text.rlike(MARKS),
    ]


def mask_classes(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``part, mask, n, good, toxic``: rows of ``docs`` counted by language and failed filters A to E."""
    text = F.coalesce("text", F.lit(""))
    bits = sum((F.when(c, 1 << i).otherwise(0) for i, c in enumerate(text_failures(F.col("_t")))), F.lit(0))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("lang", F.lit("")).alias("part"), text.alias("_t")
    ).select("doc_id", "part", F.unhex(F.sha2("_t", 256)).alias("same"), bits.alias("mask"))
    rows = rows.groupBy("doc_id", "part", "same", "mask").agg(F.count("*").alias("n"))  # repeated rows meet here
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("string").alias("id")).agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    # Rows without an id find no label; their digest deals them out.
    rows = rows.withColumn("id", F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.hex("same"))))
    rows = rows.join(marks, "id", "left").select(
        "doc_id", "part", "same", "mask", "n", *(F.coalesce(c, F.lit(False)).alias(c) for c in ("good", "toxic")))
    # A large group of equal texts is a few rows from here on.
    rows = rows.groupBy("same", "part", "mask", "good", "toxic").agg(
        F.sum("n").alias("n"), F.min("doc_id").alias("low"), F.min_by("n", "doc_id").alias("at_low"),
        F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("no_id"))
    lowest = F.min("low").over(Window.partitionBy("same"))
    first = F.coalesce(F.when(F.col("low") == F.col("lowest"), F.col("at_low")), F.lit(0)) + F.col("no_id")
    kinds = F.array(F.struct(F.col("mask"), first.alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - first).alias("n")))
    rows = rows.withColumn("lowest", lowest).select("part", "good", "toxic", F.inline(kinds))
    return rows.groupBy("part", "mask").agg(
        F.sum("n").alias("n"), *(F.sum(F.when(F.col(c), F.col("n")).otherwise(0)).alias(c) for c in ("good", "toxic")))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """How the filters A to E interact over ``docs(doc_id, text, lang)``, in every order of them.

    A: under 200 words; B: under 50 different words in a hundred; C: over 3 of ``A-Z`` in a
    hundred code points; D: holds one of ``#$%&*|``; E: a text that a smaller ``doc_id`` of the
    table also has. A null text is empty, a null lang the part ``''``. A row without an id never
    fails E and has no label; rows that repeat an id are rows of their own, and none is smaller
    than the other. A document counts as good or toxic if any of its labels says 1. Other
    columns are not looked at. An empty table has no parts and gives no rows.
    """
    return interactions(mask_classes(docs, labels), LETTERS, ["good", "toxic"]).select(
        "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")


ORACLE = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
fails AS (
  SELECT doc_id, part, len(w) < 200 AS a, 100 * len(list_distinct(w)) < 50 * len(w) AS b,
    100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t) AS c, regexp_matches(t, '[#$%&*|]') AS d,
    coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS e
  FROM words),
marks AS (
  SELECT doc_id, max(coalesce(quality = 1, false)) AS good, max(coalesce(toxic = 1, false)) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
classes AS (
  SELECT part, a, b, c, d, e, count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM fails LEFT JOIN marks USING (doc_id) GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT p.x || q.x || r.x || s.x || u.x AS o FROM letter p, letter q, letter r, letter s, letter u
  WHERE len(list_distinct([p.x, q.x, r.x, s.x, u.x])) = 5),
ranked AS (
  SELECT *, least(if(a, instr(o, 'A'), 9), if(b, instr(o, 'B'), 9), if(c, instr(o, 'C'), 9), if(d, instr(o, 'D'), 9), if(e, instr(o, 'E'), 9)) AS rank
  FROM classes, orders),
steps AS (
  SELECT ranked.*, i AS step, o[i] AS f, CASE o[i] WHEN 'A' THEN a WHEN 'B' THEN b WHEN 'C' THEN c WHEN 'D' THEN d ELSE e END AS own,
    a::int + b::int + c::int + d::int + e::int AS failed
  FROM ranked, unnest([1, 2, 3, 4, 5]) AS u(i)),
counts AS (
  SELECT part, o AS filter_order, step::int AS step, any_value(f) AS f,
    sum(if(rank > step, n, 0)) AS kept, sum(if(rank = step, n, 0)) AS removed, sum(if(own AND rank < step, n, 0)) AS redundant,
    sum(if(own AND failed = 1, n, 0)) AS unique_fails, sum(if(rank = step, good, 0)) AS good_lost, sum(if(rank = step, toxic, 0)) AS toxic_lost
  FROM steps GROUP BY part, o, step)
SELECT part, filter_order, step, kept::bigint AS kept, removed::bigint AS removed, redundant::bigint AS redundant,
  unique_fails::bigint AS unique_fails, good_lost::bigint AS good_lost, toxic_lost::bigint AS toxic_lost,
  (sum(removed) OVER (PARTITION BY part, f))::bigint AS shapley
FROM counts
"""
