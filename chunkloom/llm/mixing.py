"""Mixing sources to target weights by entropy balancing. DataFrame functions only.

Rates tilt the corpus as little as possible (in Kullback-Leibler distance over its words) while every source
meets its number of words. The convex dual has one multiplier per source; Newton steps on it use sums that
Spark computes from cells of pre-aggregated documents. The rate of a document is the exponential of its
source's multiplier; rates are rounded into whole copies.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import SPACE_WORD, with_columns_renamed, written

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
BUCKETS = 4096
CELLS = 64


def sizes(docs: DataFrame) -> DataFrame:
    """doc_id, source and number of words of every document; null and empty texts have none.

    ``turn_key`` gives a document its place in the pseudo-random order: its id, or the digest of its text where it
    has none, so that documents without id do not share one place.
    """
    text = F.coalesce("text", F.lit(""))
    return with_columns_renamed(docs, "doc_id", "source", "text").select(
        "doc_id",
        "source",
        F.regexp_count(text, F.lit(SPACE_WORD)).cast("long").alias("size"),
        F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit(":"), F.md5(text))).alias("turn_key"),
    )


def source_targets(sized: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Words each source should give: source, source_size, target.

    Sources in code point order, null last, weigh ``weights`` in turn and divide ``share`` times all words;
    what exceeds ``cap`` times a source's words is divided again among the rest until nothing exceeds.
    """
    totals = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.orderBy(F.col("source").asc_nulls_last())  # one row per source
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    table = totals.select("source", "source_size", weight.cast("long").alias("weight"))
    table = written(table.withColumn("limit", F.col("source_size") * cap), "mix-sources")
    wanted = (table.agg(F.sum("source_size")).first()[0] or 0) * share
    level, full = None, -1
    while True:
        over = F.lit(False) if level is None else F.col("limit") <= F.col("weight") * F.lit(level)
        got = table.agg(
            F.sum(F.when(over, F.col("limit")).otherwise(0)).alias("used"),
            F.sum(F.when(over, 0).otherwise(F.col("weight"))).alias("open"),
            F.sum(over.cast("int")).alias("full"),
        ).first()
        if got["full"] == full or not got["open"]:
            break
        full, level = got["full"], (wanted - got["used"]) / got["open"]
    share_of = F.col("weight") * F.lit(float(level or 0.0))
    target = F.when(F.col("limit") <= share_of, F.col("limit").cast("double")).otherwise(share_of)
    return table.select("source", "source_size", target.alias("target"))


def tilts(sized: DataFrame, targets: DataFrame, rounds: int = 60, tolerance: float = 1e-12) -> DataFrame:
    """Newton's method on the dual: source and ``tilt``, with sum(size * exp(tilt)) = target.

    The dual of a source is sum(size * exp(tilt)) - target * tilt. Documents are first summed into cells (source
    and salt), so that a source with a third of all rows is no single group; each round sums the cells anew.
    Sources without words or with target 0 have no finite multiplier and get null (rate 0).
    """
    cells = sized.groupBy("source", F.pmod(F.xxhash64("turn_key"), F.lit(CELLS)).alias("cell")).agg(
        F.sum("size").alias("words")
    )
    cells = written(cells, "mix-cells")
    wanted = targets.where((F.col("target") > 0) & (F.col("source_size") > 0))
    state = wanted.select("source", "target", F.lit(0.0).alias("tilt"))
    for _ in range(rounds):
        c, s = cells.alias("c"), state.alias("s")
        mass = (
            c.join(s, F.col("c.source").eqNullSafe(F.col("s.source")))
            .groupBy(F.col("s.source").alias("source"), "target", "tilt")
            .agg(F.sum(F.col("words") * F.exp("tilt")).alias("mass"))
        )
        # Gradient mass - target, second derivative mass. A step up is bounded so that exp() cannot overflow.
        step = F.least((F.col("target") - F.col("mass")) / F.col("mass"), F.lit(1.0))
        state = written(
            mass.select(
                "source", "target", (F.col("tilt") + step).alias("tilt"), (F.abs(step)).alias("moved")
            ),
            "mix-newton",
        )
        if (state.agg(F.max("moved")).first()[0] or 0.0) <= tolerance:
            break
        state = state.drop("moved")
    return state.select("source", "tilt")


def copies(rated: DataFrame, key: Column, buckets: int = BUCKETS) -> DataFrame:
    """Round ``rate``, one for each source, into the column ``copies``; needs ``source`` and ``size``.

    Every document gets the whole part of its rate. The words that the fraction stands for are given out as one
    more copy each, to documents in a pseudo-random order, until they are used up: a source misses its number
    by half a document at most, and reruns agree. Running sums are taken in buckets of that order, which are
    even by construction, and carried on over at most ``buckets`` totals of a source.
    """
    order = F.substring(F.md5(key), 1, 12)
    place = F.conv(order, 16, 10).cast("double") / float(16**12)
    rows = rated.select("*", order.alias("_order"), F.floor(place * buckets).cast("int").alias("_bucket"))
    sums = rows.groupBy("source", "_bucket").agg(
        F.sum("size").alias("words"), F.sum(F.col("size") * (F.col("rate") - F.floor("rate"))).alias("due")
    )
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        F.col("source").alias("b_source"),
        F.col("_bucket").alias("b_bucket"),
        F.coalesce(F.sum("words").over(before), F.lit(0)).alias("before"),
        F.sum("due").over(Window.partitionBy("source")).alias("due"),
    )
    both = rows.join(
        sums, F.col("source").eqNullSafe(F.col("b_source")) & (F.col("_bucket") == F.col("b_bucket"))
    )
    run = Window.partitionBy("source", "_bucket").orderBy("_order", key, "size")
    run = run.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.col("before") + F.sum("size").over(run)
    extra = (F.col("rate") > F.floor("rate")) & (upto - F.col("size") / 2.0 <= F.col("due"))
    both = both.withColumn("copies", F.floor("rate") + extra.cast("long"))
    return both.drop("_order", "_bucket", "b_source", "b_bucket", "before", "due")


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, rate, copies and taken words of every document.

    Null sources are one source; null or empty texts have size 0 and give no words; repeated rows are
    documents of their own; an empty table gives no rows; further columns are ignored. ``cap`` bounds the copies.
    """
    sized = written(sizes(docs), "mix-sizes")
    targets = written(source_targets(sized, weights, share, cap), "mix-targets")
    tilt = tilts(sized, targets)
    s, t, x = sized.alias("s"), targets.alias("t"), tilt.alias("x")
    per_source = t.join(x, F.col("t.source").eqNullSafe(F.col("x.source")), "left").select(
        F.col("t.source").alias("t_source"), "source_size", "target", "tilt"
    )
    rated = s.join(per_source, F.col("source").eqNullSafe(F.col("t_source"))).drop("t_source")
    # Rounding of the last Newton step must not turn a whole rate such as 2 into 1.9999999.
    rate = F.when(F.col("size") > 0, F.round(F.coalesce(F.exp("tilt"), F.lit(0.0)), 9)).otherwise(F.lit(0.0))
    rated = rated.withColumn("rate", F.least(rate, F.lit(float(cap)))).drop("tilt")
    out = copies(rated, F.col("turn_key")).drop("turn_key")
    return out.withColumn("taken", F.col("copies") * F.col("size"))
