"""Ordered scans that stay balanced when one document holds a large share of all rows.

A plain ``Window.partitionBy(doc)`` puts a whole document into one task. Here a document is cut into
blocks of consecutive positions; rows are shuffled by (document, block), each block is scanned on its
own, and one summary row per block carries the running state from block to block. The only window over
a whole document runs over its block summaries, which are smaller than its rows by the block size.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window, WindowSpec

BLOCK_ROWS = 50_000


@dataclass(frozen=True)
class Running:
    """Value over the rows of a document up to this one. ``kind``: count, sum, max, min or last.

    ``count`` counts rows where a condition holds, ``last`` is the latest value that is not null.
    """

    kind: str
    value: Column
    inclusive: bool = True


@dataclass(frozen=True)
class Whole:
    """Value over the whole document on every row. ``kind``: count, sum, max, min or at_end.

    ``at_end`` is the value on the last row, null or not.
    """

    kind: str
    value: Column


_REDUCE = {"count": F.sum, "sum": F.sum, "max": F.max, "min": F.min}


def _input(spec: Running | Whole) -> Column:
    if spec.kind == "count":
        return F.when(spec.value, F.lit(1)).otherwise(F.lit(0)).cast("long")
    return spec.value


def _running(spec: Running, column: str, ordered: WindowSpec) -> Column:
    frame = ordered.rowsBetween(Window.unboundedPreceding, 0 if spec.inclusive else -1)
    over = F.last(column, ignorenulls=True) if spec.kind == "last" else _REDUCE[spec.kind](column)
    return over.over(frame)


def _whole(spec: Whole, column: str, document: WindowSpec, order: list[str]) -> Column:
    everything = (Window.unboundedPreceding, Window.unboundedFollowing)
    if spec.kind == "at_end":
        return F.last(column).over(document.orderBy(*order).rowsBetween(*everything))
    return _REDUCE[spec.kind](column).over(document)


def _block_value(spec: Running | Whole, name: str, order: list[str]) -> Column:
    # A single numeric order keeps the aggregate buffer fixed in size, so it stays a hash aggregate.
    at = F.col(order[0]) if len(order) == 1 else F.struct(*order)
    if spec.kind == "last":
        return F.max_by(name, F.when(F.col(name).isNotNull(), at))
    if spec.kind == "at_end":
        return F.max_by(name, at)
    return _REDUCE[spec.kind](name)


def _merge(kind: str, local: Column, carry: Column) -> Column:
    if kind in ("count", "sum"):
        return F.when(carry.isNull(), local).when(local.isNull(), carry).otherwise(local + carry)
    if kind == "max":
        return F.greatest(local, carry)
    if kind == "min":
        return F.least(local, carry)
    return F.coalesce(local, carry)


def longest_document(df: DataFrame, pos: str = "pos") -> int:
    """Largest position in a table: one small job that reads a single column.

    Worth running on stored tables. Passed as ``longest`` it lets an operator use plain windows when no
    document reaches a second block.
    """
    return df.agg(F.max(pos)).first()[0] or 0


def scan(
    df: DataFrame,
    key: str,
    pos: str,
    specs: dict[str, Running | Whole],
    ties: tuple[str, ...] = (),
    block_rows: int | None = None,
    attach: DataFrame | None = None,
    longest: int | None = None,
) -> DataFrame:
    """Add one column per spec, computed per ``key`` in the order (``pos``, ``ties``).

    ``pos`` is a whole number from zero that grows along the document; ``key`` and ``pos`` are never
    null. ``attach`` is a table with one row per key whose columns are added by an inner join.
    ``longest`` is the largest position there is, if it was measured: when it fits one block, documents
    are scanned whole and everything that follows per document needs no further shuffle.
    """
    block_rows = block_rows or BLOCK_ROWS
    order = [pos, *ties]
    rows = df.withColumns({f"_in_{n}": _input(s) for n, s in specs.items()})
    if longest is not None and longest < block_rows:
        scanned, values = _scan_documents(rows, key, order, specs, attach)
    else:
        scanned, values = _scan_blocks(rows, key, order, specs, attach, block_rows)
    out = {
        n: F.coalesce(values[n], F.lit(0)).cast("long") if s.kind == "count" else values[n]
        for n, s in specs.items()
    }
    kept = [c for c in df.columns if c not in out]
    attached = [c for c in attach.columns if c != key] if attach is not None else []
    return scanned.select(*kept, *[v.alias(n) for n, v in out.items()], *attached)


def _scan_documents(rows, key, order, specs, attach):
    document = Window.partitionBy(key)
    values = {
        n: _running(s, f"_in_{n}", document.orderBy(*order))
        if isinstance(s, Running)
        else _whole(s, f"_in_{n}", document, order)
        for n, s in specs.items()
    }
    scanned = rows.withColumns({f"_v_{n}": v for n, v in values.items()}) if values else rows
    if attach is not None:
        scanned = scanned.join(attach, key)
    return scanned, {n: F.col(f"_v_{n}") for n in values}


def _scan_blocks(rows, key, order, specs, attach, block_rows):
    rows = rows.withColumn("_blk", F.expr(f"`{order[0]}` div {block_rows}"))
    totals = [_block_value(s, f"_in_{n}", order).alias(f"_b_{n}") for n, s in specs.items()]
    summary = rows.groupBy(key, "_blk").agg(*totals) if totals else rows.select(key, "_blk").distinct()
    blocks = Window.partitionBy(key)
    before = blocks.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    carried = []
    for name, spec in specs.items():
        block = f"_b_{name}"
        if isinstance(spec, Whole):
            over = _whole(spec, block, blocks, ["_blk"])
        elif spec.kind == "last":
            over = F.last(block, ignorenulls=True).over(before)
        else:
            over = _REDUCE[spec.kind](block).over(before)
        carried.append(over.alias(f"_c_{name}"))
    summary = summary.select(key, "_blk", *carried)
    if attach is not None:
        # Metadata meets the block summaries and not the rows: a large document does not skew the join,
        # and the rows are shuffled once for scan and join together.
        summary = summary.join(attach, key)

    block_scan = Window.partitionBy(key, "_blk").orderBy(*order)
    local = {
        f"_l_{n}": _running(s, f"_in_{n}", block_scan) for n, s in specs.items() if isinstance(s, Running)
    }
    joined = (rows.withColumns(local) if local else rows).join(summary, [key, "_blk"])
    values = {
        n: _merge(s.kind, F.col(f"_l_{n}"), F.col(f"_c_{n}")) if isinstance(s, Running) else F.col(f"_c_{n}")
        for n, s in specs.items()
    }
    return joined, values


def number_rows(
    df: DataFrame,
    key: str,
    pos: str,
    name: str = "idx",
    ties: tuple[str, ...] = (),
    attach: DataFrame | None = None,
    longest: int | None = None,
) -> DataFrame:
    """Zero-based index of each row within its document."""
    index = Running("count", F.lit(True), inclusive=False)
    return scan(df, key, pos, {name: index}, ties, attach=attach, longest=longest)


SAMPLE_PER_RANGE = 64


def _sort_key(df: DataFrame, item: Column | str) -> tuple[str, bool, bool]:
    """Column, descending, nulls first of an item of an order."""
    shown = item if isinstance(item, str) else str(item)[len("Column<'") : -len("'>")]
    name, direction, nulls = re.fullmatch(r"(.+?)(?: (ASC|DESC) NULLS (FIRST|LAST))?", shown).groups()
    if name not in df.columns:
        raise ValueError(f"rows are ranked by columns, not by {shown}")
    descending = direction == "DESC"
    return name, descending, nulls == "FIRST" if nulls else not descending


def _before(keys: list[tuple[str, bool, bool]], bound: Column) -> Column:
    """Whether a row comes before a bound, which has the keys as its fields."""
    out = F.lit(False)
    for i, (name, descending, nulls_first) in reversed(list(enumerate(keys))):
        own, other = F.col(name), bound.getField(f"k{i}")
        less = F.coalesce(own > other if descending else own < other, F.lit(False))
        # Null comes before or after every value.
        less = less | (own.isNull() & other.isNotNull() if nulls_first else own.isNotNull() & other.isNull())
        out = less | (own.eqNullSafe(other) & out)
    return out


def _range_of(df: DataFrame, order: tuple, wanted: int) -> Column:
    """Number of the range that a row falls into; about ``wanted`` ranges of even size with literal bounds."""
    keys = [_sort_key(df, o) for o in order]
    names = [k[0] for k in keys]
    # The rows of least hash are an even sample of bounded size, and the same one on every run.
    sample = df.select(*names).orderBy(F.xxhash64(*names)).limit(SAMPLE_PER_RANGE * wanted).orderBy(*order).collect()
    rows = [sample[i * len(sample) // wanted] for i in range(1, wanted)] if sample else []
    rows = list(dict.fromkeys(tuple(r) for r in rows))
    if not rows:
        return F.lit(0)
    types = [df.schema[n].dataType for n in names]

    def literal(some: list[tuple]) -> Column:
        kind = T.ArrayType(T.StructType([T.StructField(f"k{i}", t) for i, t in enumerate(types)]))
        return F.array(*[F.struct(*[F.lit(v).alias(f"k{i}") for i, v in enumerate(r)]) for r in some]).cast(kind)

    def upto(some: Column) -> Column:
        return F.size(F.filter(some, lambda b: ~_before(keys, b)))

    # Two steps of about the square root of all bounds each.
    step = max(int(len(rows) ** 0.5), 1)
    heads, groups = rows[::step], [literal(rows[i + 1 : i + step]) for i in range(0, len(rows), step)]
    coarse = upto(literal(heads))
    fine = upto(F.get(F.array(*groups), coarse - 1))
    return F.when(coarse > 0, (coarse - 1) * step + 1 + fine).otherwise(0)


def rank_all(df: DataFrame, *order: Column | str, partitions: int | None = None) -> DataFrame:
    """Number all rows from 1 in one global order; adds ``rn`` and ``n_rows``.

    Bounds from a small sample of the keys cut the order into ranges. They become literals of the plan, so every
    evaluation cuts alike and no row has to be stored: one pass counts the rows of each range, which gives its first
    number, and rows are numbered within their range. The sample and the counts, both of the number of ranges, are all
    that the driver sees. ``order`` must identify a row, otherwise equal rows cannot be split over ranges; its items
    are columns of ``df``, with a direction or without.
    """
    wanted = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    placed = df.withColumn("_range", _range_of(df, order, wanted))
    counts = dict(placed.groupBy("_range").count().collect())
    starts, total = [], 0
    for i in range(max(counts, default=0) + 1):
        starts.append(total)
        total += counts.get(i, 0)
    inside = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    first = F.get(F.lit(starts).cast("array<bigint>"), F.col("_range"))
    return placed.withColumn("rn", first + inside).withColumn("n_rows", F.lit(total).cast("long")).drop("_range")


def concat_ordered(piece: str, order: list[str], sep: str = "") -> Column:
    """Aggregate that joins the pieces of a group in order. The group must end up in one cell anyway."""
    ordered = F.sort_array(F.collect_list(F.struct(*order, piece)))
    return F.array_join(F.transform(ordered, lambda r: r[piece]), sep)
