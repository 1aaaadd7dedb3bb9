"""Positions of pattern matches in texts, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEY

SPAN = "struct<kind:string,start:int,end:int,base:boolean>"


def _of(kind: str):
    return lambda x: F.struct(F.lit(kind).alias("kind"), x["value"], x["gap"], x["n"], x["before"])


def pattern_spans(rows: DataFrame, patterns: dict[str, str], tests: dict[str, str], near: int) -> DataFrame:
    """One row per leftmost non-overlapping match: keys, kind, start, end (code points), value, before.

    ``rows`` has the key columns and ``text``; null is empty. ``before`` is up to ``near`` characters between the
    match before and this one. A pattern is tried only on texts in which its test (by default itself) is found.
    The texts between matches come from ``split`` and the matches from ``regexp_extract_all``; their running
    lengths are the positions, so that a text costs time in proportion to its length, however many matches it has.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    every = []
    for kind, pattern in patterns.items():
        found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
        gaps = F.split(text, pattern, -1)
        pairs = F.zip_with(found, gaps, lambda m, g: F.struct(
            m.alias("value"), F.length(g).alias("gap"), F.length(m).alias("n"),
            F.lower(F.substring(g, -near, near)).alias("before")))
        pairs = F.transform(pairs, _of(kind))
        # There is one gap more than matches, which zip_with pairs with null.
        pairs = F.filter(pairs, lambda x: x["value"].isNotNull())
        every.append(F.when(text.rlike(tests.get(kind, pattern)), pairs).otherwise(F.array().cast(PAIRS)))
    # The id tells equal rows apart; it is used within this step only.
    rows = rows.select(*KEY, F.monotonically_increasing_id().alias("uid"), F.concat(*every).alias("all"))
    rows = rows.where(F.size("all") > 0).select(*KEY, "uid", F.posexplode("all").alias("i", "s")).select(*KEY, "uid", "i", "s.*")
    run = Window.partitionBy("uid", "kind").orderBy("i").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    end = F.sum(F.col("gap") + F.col("n")).over(run)
    return rows.withColumn("end", end.cast("int")).select(
        *KEY, "kind", (F.col("end") - F.col("n")).alias("start"), "end", "value", "before"
    )


PAIRS = "array<struct<kind:string,value:string,gap:int,n:int,before:string>>"


def listed(spans: Column, kinds: list[str], by_kind: bool) -> Column:
    """kind:start:end of the spans, comma-joined; by kind as listed and start, or by start and kind."""

    def rank(kind: Column) -> Column:
        return F.array_position(F.array(*[F.lit(k) for k in kinds]), kind).cast("int")

    keyed = F.transform(spans, lambda s: F.struct(
        (rank(s["kind"]) if by_kind else F.lit(0)).alias("a"), s["start"].alias("b"), rank(s["kind"]).alias("c"),
        s["end"].alias("d"), s["kind"].alias("kind")))
    told = F.transform(
        F.array_sort(keyed), lambda s: F.concat_ws(":", s["kind"], s["b"].cast("string"), s["d"].cast("string"))
    )
    return F.array_join(told, ",")


def of_kind(spans: Column, kind: str) -> Column:
    """Number of base spans of a kind."""
    return F.size(F.filter(spans, lambda s: s["base"] & (s["kind"] == kind))).cast("long")


def base_and_clear(spans: Column) -> Column:
    """All base spans, and those added spans that overlap no base span and no earlier added one."""

    def hidden(s: Column, o: Column) -> Column:
        first = F.struct(o["start"], o["end"], o["kind"]) < F.struct(s["start"], s["end"], s["kind"])
        return (o["start"] < s["end"]) & (s["start"] < o["end"]) & (o["base"] | first)

    return F.filter(spans, lambda s: s["base"] | ~F.exists(spans, lambda o: hidden(s, o)))


def per_row(rows: DataFrame, spans: DataFrame) -> DataFrame:
    """``rows`` with the array ``spans`` of their spans (kind, start, end, base), empty where there is none."""
    got = spans.groupBy(*KEY).agg(F.collect_set(F.struct("kind", "start", "end", "base")).alias("spans"))
    got = got.withColumn("spans", base_and_clear(F.col("spans")))
    return rows.join(got, KEY, "left").withColumn("spans", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")))
