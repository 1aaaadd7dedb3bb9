"""One query per operator over the benchmark tables, and the SQL that checks it where SQL can express it."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import oracles
from .common import table
from .decontamination import decontaminate
from .mixing import mix
from .near_dedup import near_duplicates
from .pii import KINDS as PERSONAL
from .pii import find_personal_data
from .prefix_trie import conversation_trie
from .quality import classify
from .secret_scan import KINDS as SECRETS
from .secret_scan import scan_secrets
from .spans import listed, of_kind
from .substring_dedup import remove_repeated_words
from .suffix_dedup import remove_repeated_bytes
from .token_blocks import round_trip
from .topk import top_k
from .url_filter import judge, tracking_hosts
from .whitening import whiten

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(run: Query) -> Query:
        QUERIES[run.__name__] = run
        if sql is not None:
            ORACLES[run.__name__] = sql
        return run

    return add


@query(oracles.DECONTAMINATION)
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    digest = F.sha2(F.array_join(F.array_sort("items"), ","), 256)
    return found.select("doc_id", "n_words", "n_hit", "n_items", digest.alias("items_sha256"), "contaminated")


@query(oracles.NEAR_DUPLICATES)
def op2_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


@query(oracles.TOP_K)
def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


@query()
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_secrets(table(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[of_kind(F.col("spans"), k).alias(f"n_{k}") for k in ("assign", "access", "hex")],
        F.sha2(listed(base, SECRETS, by_kind=False), 256).alias("base_sha256"),
        listed(F.col("spans"), SECRETS, by_kind=False).alias("spans"),
    )


@query(oracles.SUBSTRING)
def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_words(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").alias("n_words"), "n_removed", "kept_sha256")


@query(oracles.URL_FILTER)
def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return judge(pages, tracking_hosts(pages))


@query()
def op7_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeated_bytes(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.col("n").alias("n_bytes"), "n_removed", "n_spans", "kept_sha256")


@query()
def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_personal_data(table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = F.filter("spans", lambda s: s["base"])
    return found.select(
        "doc_id",
        *[of_kind(F.col("spans"), k).alias(f"n_{k}") for k in ("email", "ip", "card", "phone")],
        F.sha2(listed(base, PERSONAL, by_kind=True), 256).alias("base_sha256"),
        listed(F.col("spans"), PERSONAL, by_kind=True).alias("spans"),
    )


@query()
def op9_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query(oracles.MIXING)
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op11_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    files = round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return files.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query()
def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whiten(table(spark, sf_dir, "embeddings"))


@query(oracles.TRIE)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(table(spark, sf_dir, "conversations"))
