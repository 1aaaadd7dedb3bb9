"""From raw documents to a training mix, in five stages over whole tables.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir). The result of each stage is written
as Parquet and read again as the next stage's documents.
"""

from __future__ import annotations

from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import chunkloom
from chunkloom.llm.common import KEY, SPACE_WORD, row_key, table, written
from chunkloom.llm.decontamination import decontaminate
from chunkloom.llm.mixing import mix
from chunkloom.llm.near_dedup import near_duplicates
from chunkloom.llm.pii import find_personal_data, masked
from chunkloom.llm.quality import score, train

# Functions sent to Python workers travel by value, so workers need no copy of the package.
cloudpickle.register_pickle_by_value(chunkloom)


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that the quality classifier rejects; null and empty texts are judged like any other."""
    scored = score(docs, train(docs, table(spark, sf_dir, "labels")))
    return scored.where("quality_score >= 0.5").select(*[F.col(f"`{c}`") for c in docs.columns])


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one row of each group of near duplicates: that with the smallest id, then the least hash of its text.

    Rows are judged by their texts: an id that repeats with unlike texts keeps a row of each, and rows without id
    take part, after all that have one. Texts without words are near nothing and stay, once for each id and text,
    or all where there is no id. Of rows with equal id and text the least by its other columns stays.
    """
    names = [F.col(f"`{c}`") for c in docs.columns]
    has_words = F.coalesce(F.col("text"), F.lit("")).rlike(SPACE_WORD)
    keyed = docs.select(F.struct(*names).alias("row"), F.col("doc_id").isNull().alias("no_id"), has_words.alias("words"), "text", *row_key())
    # One row stands for all with its text, so that exact copies are compared once.
    texts = keyed.where("words").groupBy("k2").agg(F.min(F.struct("no_id", "k1")).alias("first"), F.any_value("text").alias("text"))
    texts = written(texts, "texts-once")
    near = near_duplicates(texts.select(F.col("k2").alias("doc_id"), "text")).select(F.col("doc_id").alias("k2"), "component_id")
    best = near.join(texts.select("k2", "first.*"), "k2").groupBy("component_id").agg(F.min(F.struct("no_id", "k1", "k2")).alias("best"))
    best = best.select("best.k1", "best.k2", F.lit(True).alias("best"))
    once = keyed.where("words or not no_id").groupBy(*KEY).agg(F.min("row").alias("row"), F.any_value("words").alias("words"))
    kept = once.join(best, KEY, "left").where("best or not words").select("row.*")
    return kept.unionByName(docs.where(F.col("doc_id").isNull() & ~has_words))


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents of which benchmark items make up 5 % of the words or more."""
    bad = decontaminate(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(*KEY).distinct()
    # The row travels as one value, so that no column of it can clash with the key.
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), *row_key())
    return keyed.join(bad, KEY, "left_anti").select("row.*")


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace personal data in texts by the kind in brackets; null texts stay null, ``n_chars`` follows."""
    found = find_personal_data(docs)
    text = masked(F.col("text"), F.col("spans"))
    out = found.withColumn("text", text)
    if "n_chars" in docs.columns:
        n_chars = F.when(F.size("spans") > 0, F.length("text").cast(docs.schema["n_chars"].dataType))
        out = out.withColumn("n_chars", n_chars.otherwise(F.col("n_chars")))
    return out.select(*[F.col(f"`{c}`") for c in docs.columns])


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, with the number of copies and the words they give."""
    return mix(docs).where("copies > 0").select(
        "doc_id", "source", "size", "source_size", "target", "copies", "taken"
    )


STAGES = [
    ("quality", keep_good),
    ("near_dedup", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("personal_data", mask_personal_data),
    ("mixing", mix_sources),
]

# The classifier and the weak supervision of the personal data stage are trained; SQL cannot express them.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
