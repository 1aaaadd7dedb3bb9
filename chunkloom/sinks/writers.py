"""Table and file writers. All are safe to run again."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.merging import latest_per_key
from ..operators.shards import SHARD_POLICIES
from ..schemas import TABLES


def _read_if_there(read: Callable[[], DataFrame]) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as problem:
        if problem.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def write_chunks(chunks: DataFrame, path: str) -> None:
    """Append the chunks of documents that have none yet."""
    spark = chunks.sparkSession
    written = _read_if_there(lambda: spark.read.schema(chunks.schema).parquet(path))
    if written is not None:
        chunks = chunks.join(written.select("doc_id").distinct(), "doc_id", "left_anti")
    chunks.write.mode("append").parquet(path)


def stamp_stage(ids: DataFrame, stage: str, at: Column) -> DataFrame:
    """Log rows saying that a stage is done."""
    return ids.select(F.col("doc_id"), F.lit(stage).alias("stage"), at.alias("at")).distinct()


def append_stage_log(stamps: DataFrame, path: str) -> None:
    stamps.write.mode("append").partitionBy("stage").parquet(path)


def latest_stages(log: DataFrame) -> DataFrame:
    return latest_per_key(log, ["doc_id", "stage"], "at")


def stage_view(log: DataFrame, stages: list[str]) -> DataFrame:
    """One row per document with the latest time of each stage."""
    return log.groupBy("doc_id").agg(
        *[F.max(F.when(F.col("stage") == s, F.col("at"))).alias(f"{s}_time") for s in stages]
    )


def with_stages(meta: DataFrame, log: DataFrame, stages: list[str]) -> DataFrame:
    """Metadata with its stage times, the log taking precedence over times already there."""
    view = stage_view(log, stages)
    names = [f"{s}_time" for s in stages]
    joined = meta.alias("m").join(view.alias("v"), "doc_id", "left")
    kept = [F.col(f"m.{c}") for c in meta.columns if c not in names and c != "doc_id"]
    times = [
        F.coalesce(F.col(f"v.{n}"), F.col(f"m.{n}")).alias(n) if n in meta.columns else F.col(f"v.{n}")
        for n in names
    ]
    return joined.select("doc_id", *kept, *times)


def failed_ids(results: DataFrame, key: str = "doc_id") -> DataFrame:
    return results.filter(F.col("error").isNotNull()).select(key).distinct()


def record_failures(results: DataFrame, path: str, key: str = "doc_id") -> None:
    """Append failed ids that are not on the list yet."""
    spark = results.sparkSession
    failed = failed_ids(results, key)
    schema = T.StructType([failed.schema[key]])
    known = _read_if_there(lambda: spark.read.schema(schema).csv(path))
    if known is not None:
        failed = failed.join(known, key, "left_anti")
    failed.write.mode("append").csv(path)


def write_vectors(records: DataFrame, path: str) -> None:
    records.write.mode("append").partitionBy("namespace").parquet(path)


def read_vectors(spark: SparkSession, path: str, order: str = "written_at") -> DataFrame:
    """Current vectors: the last write of each id in its namespace."""
    return latest_per_key(spark.read.parquet(path), ["namespace", "id"], order)


def clear_namespace(spark: SparkSession, path: str, namespace: str) -> None:
    """Empty one namespace by overwriting its partition folder; the others are not touched."""
    rows = spark.read.parquet(path)
    # Folders of partitions carry escaped names.
    folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName(namespace)
    rows.drop("namespace").limit(0).write.mode("overwrite").parquet(f"{path}/namespace={folder}")


def write_shards(df: DataFrame, path: str, n: int, policy: str, *order: Column | str) -> None:
    SHARD_POLICIES[policy](df, n, *order).write.mode("overwrite").partitionBy("shard").parquet(path)


def write_lines(lines: DataFrame, path: str, column: str = "line") -> None:
    lines.select(column).write.mode("overwrite").text(path)


def write_result_json(rows: DataFrame, path: str, name: str = "process_name") -> None:
    """One JSON line per record under a folder named after the record."""
    body = F.to_json(F.struct(*[c for c in rows.columns if c != name])).alias("value")
    rows.select(name, body).write.mode("overwrite").partitionBy(name).text(path)


def ensure_table(spark: SparkSession, name: str, schema: T.StructType | str, path: str | None = None) -> None:
    """Create a table of the registry when there is none; with ``path`` its files live there."""
    wanted = TABLES[schema] if isinstance(schema, str) else schema
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in wanted.fields)
    place = f" LOCATION '{path}'" if path else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")


def write_report_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
