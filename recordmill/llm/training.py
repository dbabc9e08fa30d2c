"""Labelled samples, held-out marks and single-task fitting, shared by the trained operators."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Default of the parameter ``max_train_chars``: longer texts are no training rows (they are scored all the same).
MAX_TRAIN_CHARS = 200_000


def text_crc(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of a document's id as text; a null id counts as empty text."""
    given = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(F.coalesce(given.cast("string"), F.lit("")))


def fraction_below(key: str, share: Column | float, seed: int) -> Column:
    """True for a fixed pseudo-random ``share`` of the keys."""
    return F.pmod(F.xxhash64(F.lit(seed), F.col(key)), F.lit(1 << 31)) < F.lit(float(1 << 31)) * share


def labelled_sample(
    docs: DataFrame, labels: DataFrame, label: str, learn: Column, max_rows: int, seed: int = 7, max_chars: int = MAX_TRAIN_CHARS,
) -> DataFrame:
    """``doc_id, text, y`` of about ``max_rows`` labelled documents at most.

    ``learn`` says which ``doc_id`` may be learned from. The sample is a fixed share of the
    ids, chosen by a hash, so its labels have a proven bound and are broadcast to the texts.
    Documents without a label, or with several that differ, are not used, nor are texts over
    ``max_chars``. An id gives one row, however often it is repeated: of different texts under
    it the one with the smallest hash.
    """
    usable = (
        labels.where(learn & F.col(label).isNotNull() & F.col("doc_id").isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("y"), F.max(label).alias("y_most"))
        .where("y = y_most").select("doc_id", F.col("y").cast("int").alias("y"))
    )
    total = usable.count()
    few = usable.where(fraction_below("doc_id", min(1.0, max_rows / max(total, 1)), seed))
    texts = docs.select("doc_id", "text").where(F.length(F.coalesce("text", F.lit(""))) <= max_chars)
    met = texts.join(F.broadcast(few), "doc_id").groupBy("doc_id", "y")
    return met.agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("doc_id", "text", "y")


def fit_in_task(sample: DataFrame, fit: Callable[[Iterator[pa.RecordBatch]], bytes]) -> bytes:
    """Runs ``fit`` over all rows of a bounded ``sample`` in one task; its bytes come back."""

    def run(batches):
        yield pa.RecordBatch.from_pydict({"model": pa.array([fit(batches)], pa.binary())})

    row = sample.repartition(1).mapInArrow(run, "model binary").first()
    return bytes(row[0]) if row else fit(iter(()))  # an empty sample has no task


def in_fixed_order(ids: list, seed: int) -> np.ndarray:
    """A pseudo-random order that does not depend on how rows arrived."""
    h = np.array([hash((seed, i)) & 0xFFFFFFFF for i in ids], dtype=np.uint64)
    return np.lexsort((np.array(ids, dtype=np.int64), (h * np.uint64(2654435761)) & np.uint64(0xFFFFFFFF)))


def sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))
