"""Micro-batch jobs: new files in, finished rows out, each batch written once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery


def read_new_files(spark: SparkSession, folder: str, schema, name: str = "*.parquet", per_batch: int = 1000) -> DataFrame:
    """Stream of the files a folder gains; the checkpoint remembers which were taken.

    ``name`` is a pattern of file names, or the name of one table, which is a file or a folder of files.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", per_batch)
    if "*" in name:
        return reader.option("pathGlobFilter", name).parquet(folder)
    # As a pattern, which may fit a file; a plain path has to be a folder.
    return reader.parquet(f"{folder}/{name[:-1]}[{name[-1]}]")


def publish_batches(
    stream: DataFrame,
    transform: Callable[[DataFrame], DataFrame],
    out: str,
    checkpoint: str,
    mode: str = "append",
    available_now: bool = True,
) -> StreamingQuery:
    """Run ``transform`` on every micro-batch and write its rows under the number of the batch.

    A batch that is run again after a failure replaces its own folder, so rows are published once. The query ends
    with what is there now, or goes on for what comes later (``available_now`` false).
    """

    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.outputMode(mode).foreachBatch(write).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def current_rows(spark: SparkSession, out: str) -> DataFrame:
    """Everything published so far, with the number of its batch."""
    return spark.read.parquet(out)
