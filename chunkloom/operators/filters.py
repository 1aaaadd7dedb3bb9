"""Predicates that keep, cut or route elements, chunks and documents."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as tx
from .segments import Whole, scan


def drop_empty_chunks(chunks: DataFrame) -> DataFrame:
    """Chunks whose text is not blank; their white space stays."""
    return chunks.filter(~tx.is_blank(F.col("text")))


def dropped_chunk_counts(chunks: DataFrame) -> DataFrame:
    blank = tx.is_blank(F.col("text"))
    return chunks.groupBy("doc_id").agg(
        F.count("*").alias("n_original"),
        F.count_if(~blank).alias("n_kept"),
        F.count_if(blank).alias("n_dropped"),
    )


def drop_page_furniture(elements: DataFrame) -> DataFrame:
    return elements.filter(~F.col("category").isin("Header", "Footer"))


def cut_from_first(rows: DataFrame, condition: Column, longest: int | None = None) -> DataFrame:
    """Drop the first row of each document that meets the condition, and all rows after it."""
    cut = scan(rows, "doc_id", "pos", {"_cut": Whole("min", F.when(condition, F.col("pos")))}, longest=longest)
    return cut.filter(F.col("_cut").isNull() | (F.col("pos") < F.col("_cut"))).drop("_cut")


def cut_back_matter(elements: DataFrame, keywords: list[str] = tx.BACK_MATTER, longest: int | None = None) -> DataFrame:
    """Drop everything from the first title that opens the back matter."""
    return cut_from_first(
        elements, (F.col("category") == "Title") & tx.is_back_matter(F.col("text"), keywords), longest=longest)


def cut_chunks_at_keyword(chunks: DataFrame, keywords: list[str] = tx.CHUNK_KEYWORDS, longest: int | None = None) -> DataFrame:
    """Drop everything from the first text chunk whose first line holds a keyword."""
    hit = tx.contains_any(tx.first_line(F.col("text")), keywords)
    if "kind" in chunks.columns:
        hit = hit & (F.col("kind") == "Composite")
    return cut_from_first(chunks, hit, longest=longest)


def slice_between_last(
    elements: DataFrame, start: str = "Source", stop: str = "Restriction of Use", longest: int | None = None
) -> DataFrame:
    """Elements from the last title ``start`` up to, not including, the last element that begins with
    ``stop``; slices of one element are dropped."""
    is_start = (F.col("category") == "Title") & (F.col("text") == start)
    bounds = scan(
        elements,
        "doc_id",
        "pos",
        {
            "_a": Whole("max", F.when(is_start, F.col("pos"))),
            "_b": Whole("max", F.when(F.col("text").startswith(stop), F.col("pos"))),
        }, longest=longest)
    inside = (F.col("pos") >= F.col("_a")) & (F.col("_b").isNull() | (F.col("pos") < F.col("_b")))
    counted = scan(bounds.filter(inside), "doc_id", "pos", {"_n": Whole("count", F.lit(True))}, longest=longest)
    return counted.filter("_n > 1").select(*elements.columns)


def blank_to_null_dropna(df: DataFrame) -> DataFrame:
    """Empty strings become null, then rows with any null go."""
    texts = {f.name for f in df.schema.fields if f.dataType.simpleString() == "string"}
    return df.select(
        *[F.nullif(F.col(c), F.lit("")).alias(c) if c in texts else F.col(c) for c in df.columns]
    ).na.drop("any")


# File types and the handler each is routed to.
ROUTES = {
    "pdf": "pdf",
    "docx": "docx",
    "doc": "docx",
    "pptx": "pptx",
    "ppt": "pptx",
}


def route_by_type(docs: DataFrame, ext: str = "file_type") -> DataFrame:
    """Add ``handler``; null marks an unsupported type."""
    kind = F.lower(F.ltrim(F.col(ext), F.lit(".")))
    handler = F.lit(None).cast("string")
    for name, target in ROUTES.items():
        handler = F.when(kind == name, F.lit(target)).otherwise(handler)
    return docs.withColumn("handler", handler)


def complete_metadata(meta: DataFrame, columns: list[str]) -> DataFrame:
    return meta.na.drop(subset=columns)


def image_large_enough(points: Column, min_width: int = 250, min_height: int = 270) -> Column:
    """Box between the first and the third corner point."""
    a, c = F.get(points, 0), F.get(points, 2)
    wide = F.abs(c["x"] - a["x"]) >= min_width
    high = F.abs(c["y"] - a["y"]) >= min_height
    return F.coalesce(wide & high, F.lit(False))


def drop_last_chunk(chunks: DataFrame, longest: int | None = None) -> DataFrame:
    last = scan(chunks, "doc_id", "pos", {"_last": Whole("max", F.col("pos"))}, longest=longest)
    return last.filter("pos < _last").drop("_last")


def older_than(listing: DataFrame, moment: Column) -> DataFrame:
    return listing.filter(F.col("modified") < moment)


def size_cap(docs: DataFrame, cap: int = 30 * 1024 * 1024) -> DataFrame:
    """Keep every record; the payload goes when it is missing or not below the cap."""
    return docs.withColumn("content", F.when(F.length("content") < cap, F.col("content")))


def page_subset(elements: DataFrame, policy: str = "first", n: int = 3, longest: int | None = None) -> DataFrame:
    """``first``: the first n pages. ``ends``: the first and the last n pages."""
    near_start = F.col("page_number") <= n
    if policy == "first":
        return elements.filter(near_start)
    if policy == "ends":
        pages = scan(elements, "doc_id", "pos", {"_pages": Whole("max", F.col("page_number"))}, longest=longest)
        return pages.filter(near_start | (F.col("page_number") > F.col("_pages") - n)).drop("_pages")
    raise ValueError(f"unknown page policy: {policy}")


def sample_pages(total: Column, n: int, strategy: str = "firstN") -> Column:
    """Zero-based page numbers to look at; all pages when ``n`` is not below the total."""
    if n <= 0:
        picked = F.sequence(F.lit(0), total - 1)
    elif strategy == "spread":
        picked = F.array_distinct(
            F.transform(
                F.sequence(F.lit(0), F.lit(n - 1)),
                lambda i: F.floor(i * (total.cast("double") / F.lit(n))).cast("int"),
            )
        )
        picked = F.when(total <= n, F.sequence(F.lit(0), total - 1)).otherwise(picked)
    else:
        picked = F.sequence(F.lit(0), F.least(total, F.lit(n)) - 1)
    return F.when(total > 0, picked).otherwise(F.array().cast("array<int>"))


def ocr_languages(language: Column) -> Column:
    return F.when(language == "eng", F.array(F.lit("eng"))).otherwise(F.array(language, F.lit("eng")))


def select_artifact_variant(listing: DataFrame, with_pages: bool, name: str = "name") -> DataFrame:
    paged = F.contains(F.col(name), F.lit(".pdf_pn"))
    return listing.filter(paged if with_pages else F.contains(F.col(name), F.lit(".pdf")) & ~paged)


def filter_spec(spec: dict | list) -> Column:
    """Column for a filter of ``$exists``, ``$notExists``, ``$all`` and equality."""
    if isinstance(spec, list):
        return reduce(lambda a, b: a & b, [filter_spec(s) for s in spec], F.lit(True))
    terms = []
    for key, value in spec.items():
        if key == "$exists":
            terms.append(F.col(value).isNotNull())
        elif key == "$notExists":
            terms.append(F.col(value).isNull())
        elif key == "$all":
            terms.append(filter_spec(value))
        elif key.startswith("$"):
            raise ValueError(f"unknown filter: {key}")
        else:
            terms.append(F.col(key) == value)
    return reduce(lambda a, b: a & b, terms, F.lit(True))
