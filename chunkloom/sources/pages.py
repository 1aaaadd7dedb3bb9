"""Export of a table by its key as a stream that can be resumed: the data source ``key_pages``.

Spark plans the pages: one job ranks the keys and stores the last key of each page, so the driver sees one key a page
and never the rows. The stream's offset is the last key that was taken. A batch takes some pages at once; each file of
the table is read by its own task, which skips row groups without a key of the batch. Rows never pass the driver.
"""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.dataset as pads
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.streaming import StreamingQuery

from ..operators.segments import rank_all
from ..streaming.documents import publish_batches
from .listing import file_system

# Fixed value: rows of one page of the export.
PAGE = 10_000
KEY_TYPES = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType)


def _ends(folder: str, after=None) -> list:
    """Last keys of the planned pages in order; none where nothing was planned."""
    fs, path = file_system(folder)
    try:
        found = pads.dataset(path, filesystem=fs, format="parquet")
    except FileNotFoundError:
        return []
    if "last_key" not in found.schema.names:
        return []
    keep = None if after is None else pads.field("last_key") > after
    return sorted(set(found.to_table(columns=["last_key"], filter=keep).column(0).to_pylist()))


def plan_pages(rows: DataFrame, key: str, folder: str, size: int = PAGE) -> int:
    """Plan the pages of the keys beyond the last planned one; gives the number of new pages.

    A page holds ``size`` different keys with all their rows, so a key that repeats is never cut in two. Rows without
    key belong to no page, as in paging by ``key > last``. Rows that arrive later under keys already planned are not
    seen; keys have to grow, which is what an export by last key rests on.
    """
    if not isinstance(rows.schema[key].dataType, KEY_TYPES):
        raise ValueError(f"pages need a whole number or a string as key: {key}")
    keys = rows.select(F.col(f"`{key}`").alias("last_key")).where("last_key is not null")
    planned = _ends(folder)
    if planned:
        keys = keys.where(F.col("last_key") > F.lit(planned[-1]))
    ranked = rank_all(keys.distinct(), "last_key")
    ends = ranked.where((F.col("rn") % size == 0) | (F.col("rn") == F.col("n_rows"))).select("last_key")
    ends.write.mode("append").parquet(folder)
    return len(_ends(folder)) - len(planned)


@dataclass
class Slice(InputPartition):
    """Rows of one file with a key above ``low`` (None: from the first) and up to ``high``."""

    path: str
    low: int | str | None
    high: int | str


class PageReader(DataSourceStreamReader):
    def __init__(self, options: dict, schema: T.StructType):
        self.root, self.folder, self.key = options["path"], options["pages"], options["key"]
        self.per_batch = int(options.get("pagesperbatch", 1))
        self.schema = schema
        self.at, self.ends = None, []

    def initialOffset(self) -> dict:
        return {"last_key": None}

    def latestOffset(self) -> dict:
        """The last key of the next pages; the offset stays where it is when there are none."""
        first = 0 if self.at is None else bisect_right(self.ends, self.at)
        if len(self.ends) - first < self.per_batch:  # pages may have been planned since
            self.ends, first = _ends(self.folder, self.at), 0
        pages = self.ends[first : first + self.per_batch]
        if pages:
            self.at = pages[-1]
        return {"last_key": self.at}

    def partitions(self, start: dict, end: dict) -> list[Slice]:
        low, high = start["last_key"], end["last_key"]
        # A stream that starts again asks for the batch it saw last, or for none between two equal offsets.
        if self.at is None or (high is not None and high > self.at):
            self.at = high
        if high is None or low == high:
            return []
        fs, path = file_system(self.root)
        return [Slice(name, low, high) for name in pads.dataset(path, filesystem=fs, format="parquet").files]

    def read(self, partition: Slice) -> Iterator[pa.RecordBatch]:
        fs, _ = file_system(self.root)
        key, shape = pads.field(self.key), to_arrow_schema(self.schema)
        keep = key <= partition.high
        if partition.low is not None:
            keep = keep & (key > partition.low)
        found = pads.dataset(partition.path, filesystem=fs, format="parquet")
        for batch in found.to_batches(columns=shape.names, filter=keep, batch_size=2000):
            if batch.num_rows:
                yield from pa.Table.from_batches([batch]).cast(shape).to_batches()

    def commit(self, end: dict) -> None:
        """Nothing to do: the checkpoint of the query holds the offset."""


class KeyPages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "key_pages"

    def streamReader(self, schema: T.StructType) -> PageReader:
        return PageReader({k.lower(): v for k, v in self.options.items()}, schema)


def stream_pages(
    spark: SparkSession, path: str, key: str, pages: str, columns: list[str] | None = None, per_batch: int = 1
) -> DataFrame:
    """Stream of the rows of a Parquet table in the order of its planned pages, ``per_batch`` pages a micro-batch.

    Only the named columns are read. Cheap where the table's files or row groups are ranges of the key, as a table that
    is written sorted has them; otherwise each batch looks through the key column of all files, so take many pages.
    """
    spark.dataSource.register(KeyPages)
    schema = spark.read.parquet(path).select(*(columns or ["*"])).schema
    reader = spark.readStream.format("key_pages").schema(schema).option("key", key)
    return reader.option("pages", pages).option("pagesPerBatch", per_batch).load(path)


def export_pages(
    stream: DataFrame, out: str, checkpoint: str, transform: Callable[[DataFrame], DataFrame] = lambda rows: rows
) -> StreamingQuery:
    """Write the pages, a folder a batch. Stopped and started again with its checkpoint, it goes on after the last one.

    A batch that was not finished is taken again, with the same rows, and replaces its folder: every row is there once.
    The query waits for new pages; ``processAllAvailable`` returns when all planned ones are written.
    """
    return publish_batches(stream, transform, out, checkpoint, available_now=False)
