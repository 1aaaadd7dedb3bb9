"""The stage log in versions, and what changed between two of them.

Every append is a folder ``version=N`` with a folder a stage; it counts once Spark has marked it complete, so a write
that broke off is not seen and its number is used again. ``changes`` reads the folders of the versions and stages asked
for and nothing else, whatever the length of the log. One writer at a time appends; versions are never changed.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

STAMP = "doc_id string, at timestamp"


class Folder:
    """A folder of any file system Spark can reach, seen from the driver: names only, never rows."""

    def __init__(self, spark: SparkSession, path: str):
        self._at = spark._jvm.org.apache.hadoop.fs.Path
        self.path = path
        self._fs = self._at(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def names(self) -> list[str]:
        if not self._fs.exists(self._at(self.path)):
            return []
        return [found.getPath().getName() for found in self._fs.listStatus(self._at(self.path))]

    def holds(self, name: str) -> bool:
        return self._fs.exists(self._at(f"{self.path}/{name}"))

    def mark(self, name: str) -> None:
        self._fs.create(self._at(f"{self.path}/{name}"), True).close()

    def numbers(self, pattern: str) -> list[int]:
        """Numbers in the names that have the form ``pattern``, in order."""
        return sorted(int(m.group(1)) for m in (re.fullmatch(pattern, n) for n in self.names()) if m)


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions, in order."""
    log = Folder(spark, path)
    return [n for n in log.numbers(r"version=(\d+)") if log.holds(f"version={n}/_SUCCESS")]


def append_version(stamps: DataFrame, path: str) -> int:
    """Write ``doc_id, stage, at`` as the next version and give its number."""
    number = max(versions(stamps.sparkSession, path), default=0) + 1
    rows = stamps.select(F.col("doc_id").cast("string").alias("doc_id"), F.col("at").cast("timestamp").alias("at"), "stage")
    rows.write.mode("overwrite").partitionBy("stage").parquet(f"{path}/version={number}")
    return number


def changes(spark: SparkSession, path: str, stage: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """``doc_id, at, version`` of a stage's stamps in the versions beyond ``after``, up to ``upto``.

    Stages are known by the names of their folders, so they hold letters, digits, ``_`` and ``-`` only.
    """
    if not re.fullmatch(r"[\w-]+", stage):
        raise ValueError(f"not the name of a stage: {stage}")
    log = Folder(spark, path)
    wanted = [n for n in versions(spark, path) if n > after and (upto is None or n <= upto)]
    there = [f"{path}/version={n}/stage={stage}" for n in wanted if log.holds(f"version={n}/stage={stage}")]
    schema = f"{STAMP}, version int"
    if not there:
        return spark.createDataFrame([], schema)
    rows = spark.read.schema(f"{STAMP}, version int, stage string").option("basePath", path).parquet(*there)
    return rows.select("doc_id", "at", "version")


def changed_documents(spark: SparkSession, path: str, stage: str, after: int = 0, upto: int | None = None) -> DataFrame:
    """``doc_id, at, version``: the latest change of each document in a stage since a version."""
    rows = changes(spark, path, stage, after, upto)
    last = rows.groupBy("doc_id").agg(F.max(F.struct("version", "at")).alias("_last"))
    return last.select("doc_id", "_last.at", "_last.version")
