"""Where intermediate results are written.

A staged result is a Parquet table in the shared folder the cluster names in
``spark.checkpoint.dir``: it cuts lineage, survives lost executors, and later readers
prune its columns. A local session without that setting uses its warehouse folder.

The tables of a ``Run`` have a name, so a job that failed goes on after its last finished
table when it is started again.
"""

from __future__ import annotations

import hashlib
import re
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

SETTING = "spark.checkpoint.dir"

_RUN_FOLDER = "recordmill-run-"
_DONE = "_SUCCESS"  # what Spark's writers leave when a table is committed


def checkpoint_dir(spark: SparkSession) -> str:
    folder = spark.conf.get(SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"{SETTING} must name a shared folder on a cluster")
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/staged"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once and return a reader of the written table."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/recordmill-{uuid.uuid4().hex}/{name}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder, read back in the same partitions and the same order.

    For results whose place in their partition counts; else ``stage`` is smaller and prunes columns.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(checkpoint_dir(df.sparkSession))
    return df.checkpoint()


def _hadoop_path(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark._jsc.hadoopConfiguration()), found


@dataclass(frozen=True)
class Run:
    """Staged tables under a name, which a later run of that name and key reads instead of writing them again.

    ``key`` stands for the input and the parameters: another key shares no table with this one. A
    table counts as finished when Spark has committed it, and a table of other columns is another
    table; anything else that lies in its place is overwritten. One run of a name at a time. The
    tables stay until ``remove_run``.
    """

    spark: SparkSession
    name: str
    key: str = ""

    def __post_init__(self) -> None:
        if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", self.name):
            raise ValueError(f"not a name of a run: {self.name!r}")

    def _path(self, df: DataFrame, table: str) -> str:
        def short(text: str) -> str:
            return hashlib.sha256(text.encode()).hexdigest()[:32]

        base = f"{checkpoint_dir(self.spark).rstrip('/')}/{_RUN_FOLDER}{self.name}"
        return f"{base}/{short(self.key)}/{table}-{short(repr(df.dtypes))}"

    def finished(self, df: DataFrame, table: str) -> DataFrame | None:
        """The named table of ``df``'s columns, if it is finished. ``df`` itself is not run."""
        path = self._path(df, table)
        files, marker = _hadoop_path(self.spark, f"{path}/{_DONE}")
        return self.spark.read.schema(df.schema).parquet(path) if files.exists(marker) else None

    def stage(self, df: DataFrame, table: str) -> DataFrame:
        """A reader of the named table, which is written first unless it is finished."""
        found = self.finished(df, table)
        if found is None:
            path = self._path(df, table)
            df.write.mode("overwrite").parquet(path)
            found = self.spark.read.schema(df.schema).parquet(path)
        return found


def run_names(spark: SparkSession) -> list[str]:
    """Names of the runs that have tables in the shared folder."""
    files, pattern = _hadoop_path(spark, f"{checkpoint_dir(spark).rstrip('/')}/{_RUN_FOLDER}*")
    found = files.globStatus(pattern) or []
    return sorted(status.getPath().getName().removeprefix(_RUN_FOLDER) for status in found)


def remove_run(spark: SparkSession, name: str) -> bool:
    """Remove all tables of a run, of every key; false if it has none. Its results cannot be read afterwards."""
    if name not in run_names(spark):
        return False
    files, folder = _hadoop_path(spark, f"{checkpoint_dir(spark).rstrip('/')}/{_RUN_FOLDER}{name}")
    return files.delete(folder, True)


def files_key(spark: SparkSession, path: str | list[str], *parameters: object) -> str:
    """A key of a run over files: their names, lengths and times of change, and the parameters.

    One aggregate over the listing; no content is read.
    """
    mark = F.xxhash64("path", "length", "modificationTime").cast("decimal(20,0)")
    listed = spark.read.format("binaryFile").load(path).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum(mark).alias("marks"))
    return repr((*listed.first(), *parameters))
