"""Secret scans by known forms and by sliding-window Shannon entropy. DataFrame functions only.

Candidate strings are runs of the letters of keys. A window slides over each; the counts of its characters
change by the one that enters and the one that leaves, and so does the entropy, kept as a whole number. Windows
above the threshold of the string's character class mark a span, unless an allow-list knows the string. Plain words
of the allow-list that are parts of a path or a name (``samples/...``) are cut out before, so that what stands beside
them is looked at; its words also clear a marked span that holds one. Strings without a digit or without a letter are
no candidates: they are words and numbers far more often than keys, and entropy does not tell them apart.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import KEY, row_key, with_columns_renamed, written
from .spans import pattern_spans, per_row

# ---- fixed values: the base patterns of the contract, in the order in which kinds are listed.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
BASE = {"assign": ASSIGN, "access": r"AKIA[A-Z0-9]{16,}", "hex": r"[0-9a-f]{24,}"}
KINDS = [*BASE, "entropy"]
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
WINDOW = 20
SCALE = 1 << 20
ALPHABET = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-="
# Character classes: what a string consists of, and the entropy in bits a character from which a window counts.
CLASSES = [(r"^[0-9a-fA-F]+$", 3.0), (r"^[A-Z0-9]+$", 3.5), (r"^[A-Za-z0-9+/_=-]+$", 3.8)]
# Strings that look random and are known not to be secrets.
ALLOW = [
    r"^[0-9a-fA-F]{8}-(?:[0-9a-fA-F]{4}-){3}[0-9a-fA-F]{12}$",
    r"(?i)example|sample|dummy|placeholder|changeme|abcdefghij|0123456789",
]
# A word, perhaps with a number, between separators that holds one of the words above.
ALLOW_PART = rf"(?<![A-Za-z0-9])(?=[A-Za-z0-9]*({ALLOW[1]}))(?:[A-Z]?[a-z]*|[A-Z]+)[0-9]*(?![A-Za-z0-9])"
ALLOW_BEFORE = r"(?:sha1|sha256|sha512|md5)[-:=]$"


def _parts(count: int) -> int:
    return round(count * math.log2(count) * SCALE) if count else 0


def high_entropy(value: Column, limit: Column, window: int = WINDOW) -> Column:
    """First start and last end (from 0, exclusive) of the windows whose sum of count * log2(count) is at most
    ``limit``, that is, whose entropy is high enough; null where there is none."""
    weight = F.array(*[F.lit(_parts(c)) for c in range(window + 2)])
    chars = F.split(value, "")
    places = F.transform(chars, lambda c: F.instr(F.lit(ALPHABET), c))
    late = F.concat(F.array_repeat(F.lit(0), window), places)
    moves = F.slice(F.zip_with(places, late, lambda a, b: F.struct(a.alias("into"), b.alias("out"))), 1, F.size(places))
    start = F.struct(
        F.array_repeat(F.lit(0), len(ALPHABET) + 1).alias("counts"), F.lit(0).alias("sum"), F.lit(0).alias("i"),
        F.lit(None).cast("int").alias("first"), F.lit(None).cast("int").alias("last"),
    )

    def step(acc: Column, x: Column) -> Column:
        n_in = F.get(acc["counts"], x["into"])
        n_out = F.get(acc["counts"], x["out"]) + (x["out"] == x["into"]).cast("int")
        total = acc["sum"] + F.get(weight, n_in + 1) - F.get(weight, n_in)
        leaves = x["out"] > 0
        total = total - F.when(leaves, F.get(weight, n_out) - F.get(weight, n_out - 1)).otherwise(0)
        counts = F.transform(
            acc["counts"],
            lambda c, j: c + (j == x["into"]).cast("int") - (leaves & (j == x["out"])).cast("int"),
        )
        i = acc["i"] + 1
        high = (i >= window) & (total <= limit)
        return F.struct(
            counts.alias("counts"), total.cast("int").alias("sum"), i.alias("i"),
            F.coalesce(acc["first"], F.when(high, i - window)).alias("first"),
            F.when(high, i).otherwise(acc["last"]).alias("last"),
        )

    return F.aggregate(moves, start, step, lambda a: F.struct(a["first"].alias("first"), a["last"].alias("last")))


def beside_words(value: Column) -> Column:
    """Array of (from, value): the string without the plain words of the allow-list in it, and where each rest begins."""
    words = F.regexp_extract_all(value, F.lit(ALLOW_PART), F.lit(0))
    pieces = F.split(value, ALLOW_PART, -1)
    pairs = F.zip_with(pieces, words, lambda p, w: F.struct(p.alias("p"), F.length(F.coalesce(w, F.lit(""))).alias("w")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,value:string>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        rest = F.when(acc["at"] > 0, F.regexp_replace(x["p"], r"^[+/_=-]+", "")).otherwise(x["p"])
        begin = acc["at"] + F.length(x["p"]) - F.length(rest)
        rest = F.when(x["w"] > 0, F.regexp_replace(rest, r"(?<![+/_=-])[+/_=-]+$", "")).otherwise(rest)
        return F.struct(
            (acc["at"] + F.length(x["p"]) + x["w"]).alias("at"),
            F.concat(acc["out"], F.array(F.struct(begin.cast("int").alias("from"), rest.alias("value")))).alias("out"),
        )

    return F.when(value.rlike(ALLOW_PART), F.aggregate(pairs, start, step, lambda a: a["out"])).otherwise(
        F.array(F.struct(F.lit(0).alias("from"), value.alias("value")))
    )


def secret_spans(rows: DataFrame) -> DataFrame:
    """Keys, kind, start, end, value, base of every span; ``rows`` has the key columns and text."""
    found = written(pattern_spans(rows, {**BASE, "entropy": CANDIDATE}, {"assign": r"(?i)(?:password|passwd|secret|token|api_?key)"}, 16), "secret-candidates")
    base = found.where(F.col("kind") != "entropy")
    base = base.where((F.col("kind") != "assign") | (F.length(F.regexp_extract("value", ASSIGN, 1)) >= 6))
    base = base.select(*KEY, "kind", "start", "end", "value", F.lit(True).alias("base"))

    value = F.col("value")
    limit = F.lit(None).cast("int")
    for pattern, bits in reversed(CLASSES):
        most = math.floor(WINDOW * (math.log2(WINDOW) - bits) * SCALE)
        limit = F.when(value.rlike(pattern), F.lit(most)).otherwise(limit)
    other = found.where(F.col("kind") == "entropy").where(value.rlike("[0-9]") & value.rlike("[A-Za-z]"))
    other = other.where(~value.rlike(ALLOW[0]) & ~F.col("before").rlike(ALLOW_BEFORE))
    other = other.select(*KEY, "kind", "start", F.explode(beside_words(value)).alias("part"))
    other = other.select(*KEY, "kind", (F.col("start") + F.col("part.from")).alias("start"), F.col("part.value").alias("value"))
    other = other.where(F.length("value") >= WINDOW).withColumn("high", high_entropy(value, limit))
    other = other.where(F.col("high.first").isNotNull()).select(
        *KEY, "kind", (F.col("start") + F.col("high.first")).alias("start"),
        (F.col("start") + F.col("high.last")).alias("end"),
        F.substring("value", F.col("high.first") + 1, F.col("high.last") - F.col("high.first")).alias("value"),
        F.lit(False).alias("base"),
    )
    return base.unionByName(other.where(~value.rlike(ALLOW[1])))


def scan_secrets(docs: DataFrame) -> DataFrame:
    """doc_id and spans (kind, start, end, base) of every row; positions in code points, end exclusive.

    Base spans are all kept; a span added for its entropy is left out where it overlaps a base span. Null and empty
    texts have none; repeated rows have their spans each; further columns are ignored; an empty table gives no rows.
    """
    rows = with_columns_renamed(docs, "doc_id", "text").select("doc_id", *row_key(), "text")
    return per_row(rows.select("doc_id", *KEY), secret_spans(rows)).select("doc_id", "spans")
