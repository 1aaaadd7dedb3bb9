"""File listings as a data source, ``file_listing``: one partition a folder, empty files included.

The driver looks at the folders of the first level only; each of them is listed by its own task, whatever lies below.
A prefix prunes folders before they are listed, a suffix prunes names; both may also come as filters on ``path``.
Names that begin with a dot or an underscore are bookkeeping of writers and left out.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition, StringEndsWith, StringStartsWith

BATCH = 10_000
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"


def file_system(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of an address; ``file:`` may have one slash or three."""
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "/", uri))


@dataclass
class Folder(InputPartition):
    path: str
    below: bool  # with everything below it, or its own files only


class ListingReader(DataSourceReader):
    def __init__(self, root: str, prefix: str, suffix: str):
        self.root, self.prefix, self.suffix = root, prefix, suffix

    def partitions(self) -> list[Folder]:
        fs, root = file_system(self.root)
        out = [Folder("", False)]
        for info in fs.get_file_info(pafs.FileSelector(root, recursive=False, allow_not_found=True)):
            name = info.base_name + "/"
            if info.type == pafs.FileType.Directory and not _hidden(info.base_name):
                if name.startswith(self.prefix) or self.prefix.startswith(name):
                    out.append(Folder(info.base_name, True))
        return out

    def read(self, partition: Folder) -> Iterator[pa.RecordBatch]:
        fs, root = file_system(self.root)
        folder, rows = f"{root}/{partition.path}".rstrip("/"), []
        for info in fs.get_file_info(pafs.FileSelector(folder, recursive=partition.below, allow_not_found=True)):
            path = info.path[len(root) :].lstrip("/")
            if info.type != pafs.FileType.File or any(map(_hidden, path.split("/"))):
                continue
            if path.startswith(self.prefix) and path.endswith(self.suffix):
                rows.append((path, info.size, (info.mtime_ns or 0) // 1000))
            if len(rows) >= BATCH:
                yield _batch(rows)
                rows = []
        yield _batch(rows)


class FilteredListingReader(ListingReader):
    """For sessions that hand filters to such sources (``spark.sql.python.filterPushdown.enabled``)."""

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        for f in filters:
            # The longer of two prefixes or suffixes decides, if one holds the other; else Spark filters on.
            if isinstance(f, StringStartsWith) and f.attribute == ("path",) and f.value.startswith(self.prefix):
                self.prefix = f.value
            elif isinstance(f, StringEndsWith) and f.attribute == ("path",) and f.value.endswith(self.suffix):
                self.suffix = f.value
            else:
                yield f


def _hidden(name: str) -> bool:
    return name.startswith((".", "_"))


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = (pa.string(), pa.int64(), pa.timestamp("us", "UTC"))
    return pa.RecordBatch.from_arrays([pa.array([r[j] for r in rows], k) for j, k in enumerate(kinds)], ["path", "size", "modified"])


class FileListing(DataSource):
    @classmethod
    def name(cls) -> str:
        return "file_listing"

    def schema(self) -> str:
        return "path string, size long, modified timestamp"

    def reader(self, schema) -> ListingReader:
        kind = FilteredListingReader if self.options.get("pushdown") == "true" else ListingReader
        return kind(self.options["path"], self.options.get("prefix", ""), self.options.get("suffix", ""))


def list_files(spark: SparkSession, root: str, suffix: str = "", prefix: str = "") -> DataFrame:
    """``path`` (relative to the root), ``size`` and ``modified`` of all files below ``root``; none if there is no such folder."""
    spark.dataSource.register(FileListing)
    reader = spark.read.format("file_listing").option("prefix", prefix).option("suffix", suffix)
    return reader.option("pushdown", spark.conf.get(PUSHDOWN, "false")).load(root)


def write_files(rows: DataFrame, root: str, path: str = "path", content: str = "content") -> DataFrame:
    """Write each row's text to a file of its own; gives ``path`` and ``size`` of what was written.

    A file is written whole under its name, so a task that is run again leaves the same files. Null is an empty file.
    The result has to be read for the files to be there.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = file_system(root)
        made: set[str] = set()
        for batch in batches:
            sizes = []
            for name, text in zip(batch.column("path").to_pylist(), batch.column("content").to_pylist()):
                target = f"{folder}/{name}"
                above = target.rsplit("/", 1)[0]
                if above not in made:
                    fs.create_dir(above, recursive=True)
                    made.add(above)
                data = (text or "").encode()
                with fs.open_output_stream(target) as out:
                    out.write(data)
                sizes.append(len(data))
            yield pa.RecordBatch.from_arrays([batch.column("path"), pa.array(sizes, pa.int64())], ["path", "size"])

    return rows.select(F.col(path).alias("path"), F.col(content).alias("content")).mapInArrow(run, "path string, size long")
