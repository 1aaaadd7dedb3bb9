"""Scans of metadata tables, listings, chunk artefacts and result files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators.segments import rank_all
from .listing import list_files


def scan_pending(
    meta: DataFrame, done: list[str] = (), todo: list[str] = (), since: tuple[str, Column] | None = None
) -> DataFrame:
    """Rows where the ``done`` stages have a time and the ``todo`` stages have none."""
    for stage in done:
        meta = meta.filter(F.col(stage).isNotNull())
    for stage in todo:
        meta = meta.filter(F.col(stage).isNull())
    if since is not None:
        meta = meta.filter(F.col(since[0]) > since[1])
    return meta


def list_artifacts(spark: SparkSession, root: str, suffix: str = "", prefix: str = "") -> DataFrame:
    """``path`` (relative to the root), ``size`` and ``modified`` of the files below a folder, empty ones included."""
    return list_files(spark, root, suffix, prefix)


# The shapes of a stored chunk list, as the type of one chunk.
CHUNK_SHAPES = {
    "text": "string",
    "pair": "struct<text:string,page_number:int>",
    "record": "struct<text:string,page_number:int>",
    "titled": "struct<title:string,text:string,page_number:int>",
}


def explode_chunks(docs: DataFrame, shape: str = "record", column: str = "chunks") -> DataFrame:
    """One row ``doc_id, pos, title, text, page_number`` per chunk of a document's chunk list.

    A long document may be stored as several lists; ``first_pos`` then says where each one starts.
    """
    if shape not in CHUNK_SHAPES:
        raise ValueError(f"unknown chunk shape: {shape}")
    start = F.col("first_pos") if "first_pos" in docs.columns else F.lit(0)
    rows = docs.select("doc_id", start.alias("_start"), F.posexplode(column).alias("_i", "_c"))
    rows = rows.withColumn("pos", F.col("_start") + F.col("_i"))
    null = F.lit(None)
    title = F.col("_c.title") if shape == "titled" else null.cast("string")
    text = F.col("_c") if shape == "text" else F.col("_c.text")
    page = null.cast("int") if shape == "text" else F.col("_c.page_number").cast("int")
    return rows.select(
        "doc_id", F.col("pos").cast("long").alias("pos"), title.alias("title"), text.alias("text"),
        page.alias("page_number"),
    )


def read_chunks(spark: SparkSession, path: str, shape: str = "record", format: str = "parquet") -> DataFrame:
    """Chunk lists, one document per row, from Parquet or JSON lines."""
    reader = spark.read
    if format == "json":
        reader = reader.schema(f"doc_id string, chunks array<{CHUNK_SHAPES[shape]}>")
    return explode_chunks(reader.format(format).load(path), shape)


def export_incremental(table: DataFrame, key: str, last_key=None) -> DataFrame:
    """Rows after the last exported key. One filtered scan takes the place of paging by key."""
    return table if last_key is None else table.filter(F.col(key) > last_key)


def export_checkpoint(exported: DataFrame, key: str) -> DataFrame:
    """The row to store as the next starting point."""
    return exported.agg(F.max(key).alias("last_key"), F.count("*").alias("n_rows"))


def scan_jdbc(
    spark: SparkSession, url: str, table: str, key: str, low: int, high: int, parts: int, **options: str
) -> DataFrame:
    """Parallel read of a database table by ranges of a numeric key."""
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=key, lowerBound=low, upperBound=high)
        .options(numPartitions=parts, fetchsize=1000, **options)
        .load()
    )


def scan_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Whole-table scan of the columns needed; the file splits are the pages."""
    return spark.read.parquet(path).select(*columns)


def read_id_map(spark: SparkSession, path: str) -> DataFrame:
    """Two columns without a header: new id and old key."""
    return spark.read.csv(path, schema="new_id string, old_key string")


def rows_of_results(files: DataFrame) -> DataFrame:
    """``filename_prefix, row`` (JSON text) per result row of ``path, value``.

    ``result`` may be one object or a list; empty ones give no row.
    """
    result = F.get_json_object("value", "$.result")
    as_list = F.when(F.ltrim(result).startswith("["), result).otherwise(F.concat(F.lit("["), result, F.lit("]")))
    variants = F.try_variant_get(F.try_parse_json(as_list), "$", "array<variant>")
    rows = files.select(paths.file_id(paths.base_name(F.col("path"))).alias("filename_prefix"),
                        F.explode_outer(variants).alias("_row"))
    return rows.select("filename_prefix", F.to_json("_row").alias("row")).filter("row not in ('{}', 'null')")


def read_result_json(spark: SparkSession, folder: str) -> DataFrame:
    files = spark.read.option("pathGlobFilter", "*.json").text(folder, wholetext=True)
    return rows_of_results(files.select(F.input_file_name().alias("path"), "value"))


def read_patents(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


SUBMISSION_SCHEMA = (
    "companyName string, companyShortName string, publicationDate string, reportStartTime string, "
    "reportEndTime string, url string, title string, country string, category string, name string, "
    "remark string, pdf_path string"
)


def read_submission_sheet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, schema=SUBMISSION_SCHEMA, header=True)


def raw_documents(files: DataFrame, meta: DataFrame) -> DataFrame:
    """Files with the metadata row their name points to. ``files``: path, content, ...."""
    return files.withColumn("doc_id", paths.file_id(paths.base_name(F.col("path")))).join(meta, "doc_id")


def missing_documents(files: DataFrame, meta: DataFrame) -> DataFrame:
    """Metadata rows without a file."""
    present = files.select(paths.file_id(paths.base_name(F.col("path"))).alias("doc_id"))
    return meta.join(present, "doc_id", "left_anti")


def scan_raw_documents(spark: SparkSession, root: str, meta: DataFrame, suffix: str = "") -> DataFrame:
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    loaded = files.option("pathGlobFilter", f"*{suffix}").load(root)
    return raw_documents(loaded.select("path", "content", F.col("length").alias("size")), meta)


def usable_work(items: DataFrame, done: DataFrame, listing: DataFrame, key: str = "doc_id") -> DataFrame:
    """Work items with an id, without an output, and with a file to read."""
    clean = items.withColumn(key, F.trim(F.col(key).cast("string"))).filter(F.col(key) != "")
    outputs = done.select(F.col(key).cast("string").alias(key))
    inputs = listing.select(F.col(key).cast("string").alias(key))
    return clean.join(outputs, key, "left_anti").join(inputs, key, "left_semi")


def scan_work_batches(
    items: DataFrame, done: DataFrame, listing: DataFrame, size: int, key: str = "doc_id"
) -> DataFrame:
    """Usable work with the number of the batch it belongs to."""
    ranked = rank_all(usable_work(items, done, listing, key), key)
    return ranked.withColumn("batch", F.floor((F.col("rn") - 1) / size)).drop("rn", "n_rows")


def most_lines(docs: DataFrame) -> int:
    """Largest line position of any text: the bound ``longest`` of its elements, without making them."""
    breaks = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit("")))
    return docs.agg(F.max(breaks)).first()[0] or 0


def lines_to_elements(docs: DataFrame, title_below: int = 40) -> DataFrame:
    """One element per line of text; the first line and short lines without a full stop are titles.

    Output ``doc_id, pos, category, text, page_number, html``.
    """
    lines = docs.select("doc_id", F.posexplode(F.split("text", "\n")).alias("pos", "text"))
    titled = (F.col("pos") == 0) | ((F.length("text") < title_below) & ~F.col("text").endswith("."))
    return lines.select(
        "doc_id",
        F.col("pos").cast("long").alias("pos"),
        F.when(titled, F.lit("Title")).otherwise(F.lit("NarrativeText")).alias("category"),
        "text",
        F.lit(None).cast("int").alias("page_number"),
        F.lit(None).cast("string").alias("html"),
    )
