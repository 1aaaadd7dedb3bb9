"""From pending documents to stamped ones, reading only what changed since the last run.

A run takes the documents whose ``done`` stage changed in versions of the log that it has not seen, builds their rows,
stamps those without an error with the ``todo`` stage, and puts the others on the skip list, where they stay until they
change again. Every step writes under a number that a repeated run finds again: a run that broke off anywhere is
followed by one that neither loses a document nor stamps one twice.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sinks.changes import Folder, append_version, changed_documents, versions

SKIPPED = "doc_id string, error string, version int"


@dataclass(frozen=True)
class PendingIndex:
    """Folders of one index: the ``log`` it shares with other stages, and its own ``home``."""

    log: str
    home: str
    done: str = "upload"
    todo: str = "fulltext"

    def position(self, spark: SparkSession) -> int:
        """The last version of the log whose changes have been dealt with."""
        return max(Folder(spark, f"{self.home}/_positions").numbers(r"v(\d+)"), default=0)

    def pending(self, spark: SparkSession, upto: int | None = None) -> DataFrame:
        """``doc_id, at, version`` of the changed documents that are neither stamped nor skipped since."""
        after = self.position(spark)
        changed = changed_documents(spark, self.log, self.done, after, upto)
        stamped = changed_documents(spark, self.log, self.todo, after, upto)
        skipped = self._skipped(spark, after).groupBy("doc_id").agg(F.max("version").alias("version"))
        # A stamp or an error counts against changes up to its own version; a later change makes the document pending.
        over = stamped.select("doc_id", "version").unionByName(skipped)
        over = over.groupBy("doc_id").agg(F.max("version").alias("_over"))
        waiting = changed.join(over, "doc_id", "left").where("_over is null or _over < version")
        return waiting.select("doc_id", "at", "version")

    def _skipped(self, spark: SparkSession, after: int = 0) -> DataFrame:
        skip = Folder(spark, f"{self.home}/skipped")
        there = [n for n in skip.numbers(r"version=(\d+)") if n > after and skip.holds(f"version={n}/_SUCCESS")]
        paths = [f"{skip.path}/version={n}" for n in there]
        if not paths:
            return spark.createDataFrame([], SKIPPED)
        return spark.read.schema(SKIPPED).option("basePath", skip.path).parquet(*paths)

    def run(self, spark: SparkSession, build: Callable[[DataFrame], DataFrame], at: Column | None = None) -> dict[str, int]:
        """Build and stamp what is pending; gives the version reached and the numbers stamped and skipped.

        ``build`` gets ``doc_id, at, version`` and gives rows with ``doc_id`` and ``error``; one row with an error
        fails its document. Documents without rows have nothing to index and are stamped.
        """
        before, head = self.position(spark), max(versions(spark, self.log), default=0)
        if head <= before:
            return {"version": before, "stamped": 0, "skipped": 0}
        waiting = self.pending(spark, head)
        n_stamped = n_skipped = 0
        if not waiting.isEmpty():
            place = f"{self.home}/rows/version={head}"
            built = build(waiting)
            built.withColumn("doc_id", F.col("doc_id").cast("string")).write.mode("overwrite").parquet(place)
            failing = spark.read.schema("doc_id string, error string").parquet(place).where("error is not null")
            failing = failing.groupBy("doc_id").agg(F.min("error").alias("error"))
            # Taken before the skip list is written, which this question would read.
            good = waiting.join(failing, "doc_id", "left_anti")
            stage, time = F.lit(self.todo).alias("stage"), (F.current_timestamp() if at is None else at).alias("at")
            number = append_version(good.select("doc_id", stage, time), self.log)
            failing.write.mode("overwrite").parquet(f"{self.home}/skipped/version={head}")
            n_stamped = changed_documents(spark, self.log, self.todo, number - 1, number).count()
            n_skipped = self._skipped(spark, head - 1).where(F.col("version") == head).count()
        Folder(spark, f"{self.home}/_positions").mark(f"v{head}")
        return {"version": head, "stamped": n_stamped, "skipped": n_skipped}

    def rows(self, spark: SparkSession) -> DataFrame:
        """Current rows of the index: those of each document's last build, if that one had no error; with ``version``."""
        all_rows = spark.read.parquet(f"{self.home}/rows")
        last = all_rows.groupBy("doc_id").agg(F.max("version").alias("version"))
        good = last.join(self._skipped(spark).select("doc_id", "version"), ["doc_id", "version"], "left_anti")
        return all_rows.join(good, ["doc_id", "version"], "left_semi").drop("error")

    def skipped(self, spark: SparkSession) -> DataFrame:
        """``doc_id, error, version`` of the documents whose last build failed."""
        built = spark.read.schema("doc_id string, version int").option("basePath", f"{self.home}/rows").parquet(f"{self.home}/rows")
        last = built.groupBy("doc_id").agg(F.max("version").alias("version"))
        return self._skipped(spark).join(last, ["doc_id", "version"], "left_semi").select("doc_id", "error", "version")
