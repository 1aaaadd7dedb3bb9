"""A ledger of answered requests, so that a service is asked once for each different request.

Requests are known by their SHA-256. Those with a good answer in the ledger are left out by an anti join; of the rest
only key and request go to Python, once each however many rows make them. A task writes its answers to the ledger as
they come, batch by batch, and first looks up what an earlier attempt has left there, so a failed task or a run that
was stopped pays again for the batch in flight only. Results are read back from the ledger by any number of actions.

The ledger is a folder of Parquet files in buckets of the key; files are only ever added. Failed requests are kept with
their error and asked again by the next run; a good answer outranks them, a later error an earlier one.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

BUCKETS = 64


def request_key(request: Column) -> Column:
    """Digest of a request; null is asked like an empty one."""
    return F.sha2(F.coalesce(request.cast("binary"), F.lit("").cast("binary")), 256)


def _schema(fields: list[T.StructField]) -> T.StructType:
    extra = [T.StructField("error", T.StringType()), T.StructField("at", T.LongType()), T.StructField("bucket", T.IntegerType())]
    return T.StructType([T.StructField("key", T.StringType()), *fields, *extra])


def _bucket(key: Column) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(BUCKETS)).cast("int")


def _place(path: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub("^file:/+", "/", path))


def read_ledger(spark: SparkSession, path: str, fields: list[T.StructField]) -> DataFrame:
    """``key``, ``fields`` and ``error`` of every request that was asked: its good answer, or its last error."""
    fs, folder = _place(path)
    fs.create_dir(folder, recursive=True)
    rows = spark.read.schema(_schema(fields)).parquet(path)
    names = [f.name for f in fields]
    rank = F.struct(F.col("error").isNull(), "at")
    best = rows.groupBy("key").agg(F.max_by(F.struct(*names, "error"), rank).alias("_best"))
    return best.select("key", "_best.*")


def ask(
    requests: DataFrame,
    path: str,
    make_client: Callable[[], Callable],
    read_reply: Callable,
    fields: list[T.StructField],
    batch: int = 1,
) -> int:
    """Ask for every different ``request`` that the ledger at ``path`` has no good answer to; gives their number."""
    spark = requests.sparkSession
    done = read_ledger(spark, path, fields).where("error is null").select("key")
    wanted = requests.select(request_key(F.col("request")).alias("key"), "request").dropDuplicates(["key"])
    wanted = wanted.join(done, "key", "left_anti").withColumn("bucket", _bucket(F.col("key")))
    types = [(f.name, to_arrow_type(f.dataType)) for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, folder = _place(path)
        client = make_client()
        known: dict[int, set] = {}

        def answered(bucket: int) -> set:
            """Keys with a good answer in the files of a bucket, those of attempts before this one included."""
            if bucket not in known:
                known[bucket] = set()
                selector = pafs.FileSelector(f"{folder}/bucket={bucket}", allow_not_found=True)
                for info in fs.get_file_info(selector):
                    if info.path.endswith(".parquet"):
                        table = pq.read_table(info.path, columns=["key", "error"], filesystem=fs)
                        rows = zip(table.column("key").to_pylist(), table.column("error").to_pylist())
                        known[bucket].update(k for k, e in rows if e is None)
            return known[bucket]

        def settle(bucket: int, open_: list[tuple]) -> int:
            try:
                got, errors = read_reply(client([r for _, r in open_]), len(open_)), [None] * len(open_)
            except Exception as problem:
                got, errors = [(None,) * len(types)] * len(open_), [str(problem)[:2000]] * len(open_)
            columns = [pa.array([k for k, _ in open_])]
            columns += [pa.array([g[j] for g in got], kind) for j, (_, kind) in enumerate(types)]
            columns += [pa.array(errors, pa.string()), pa.array([time.time_ns()] * len(open_))]
            table = pa.table(columns, names=["key", *(n for n, _ in types), "error", "at"])
            fs.create_dir(f"{folder}/bucket={bucket}", recursive=True)
            # Written under a hidden name first: a file that is seen is whole.
            name = uuid.uuid4().hex
            pq.write_table(table, f"{folder}/bucket={bucket}/_{name}", filesystem=fs)
            fs.move(f"{folder}/bucket={bucket}/_{name}", f"{folder}/bucket={bucket}/{name}.parquet")
            return len(open_)

        asked, open_ = 0, {}
        for rows in batches:
            for key, request, bucket in zip(*(rows.column(c).to_pylist() for c in ("key", "request", "bucket"))):
                if key in answered(bucket):
                    continue
                open_.setdefault(bucket, []).append((key, request))
                if len(open_[bucket]) >= batch:
                    asked += settle(bucket, open_.pop(bucket))
        for bucket, rest in open_.items():
            asked += settle(bucket, rest)
        yield pa.RecordBatch.from_arrays([pa.array([asked])], ["asked"])

    dealt = wanted.repartition(BUCKETS, "bucket")
    return dealt.mapInArrow(run, "asked long").agg(F.sum("asked")).first()[0] or 0


def answered_rows(df: DataFrame, request: str, path: str, fields: list[T.StructField]) -> DataFrame:
    """``df`` with the ``fields`` and the ``error`` of each row's request."""
    answers = read_ledger(df.sparkSession, path, fields).withColumnRenamed("key", "_key")
    return df.withColumn("_key", request_key(F.col(request))).join(answers, "_key", "left").drop("_key")
