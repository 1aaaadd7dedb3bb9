"""Prefix trie of conversations as a distributed z-fast trie.

A conversation is a sequence of turns. Its prefixes are known by depth and a 128-bit fingerprint, the exclusive or of
hashes of (turn, position), so that fingerprints of all prefixes come from one running value.

The trie is compacted: a node stands for the edge of prefixes of depth ``low + 1`` to ``e`` that have the same members,
and is kept in a table under its handle, the prefix of two-fattest depth in that range (the depth divisible by the
highest power of two). Conversations are inserted in batches:

* fat binary search finds the exit node: one round for each power of two, from the highest down. In a round a
  conversation looks up the only depth of its open range that the power divides; a hit moves the lower end to the
  node's depth, a miss the upper end below. Rounds of high powers only read the few prefixes that they divide.
* one more lookup, by the first turn of an edge, and a comparison along that edge give the depth where the
  conversation leaves the trie.
* what lies below is new: its branchings and ends are found by grouping prefixes, the edges left are split there, and
  the table is written anew with the changed handles.

At the end sums over subtrees go up the compacted nodes by pointer doubling, and edges are expanded into their turns.
No step gathers a conversation, a node's members or a node's children: long conversations are cut into blocks of
positions, and all groupings combine before they shuffle. Lookups of a prefix that very many conversations share rely
on adaptive execution, which splits skewed sides of a join.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import with_columns_renamed, written

BLOCK = 1024  # positions of a conversation that one window covers
EDGE = 1024  # positions of an edge that one step expands
BATCHES = (1, 4, 16)  # a batch takes conversations whose hash modulo the last number lies below; all are in the last
PIECE_IDS = 4096  # ids in one piece of a list that is hashed


# ---------------------------------------------------------------- turns to prefixes


def ranked(turns: DataFrame) -> DataFrame:
    """conv_id, rank (from 1), h1, h2, cp of each row, in the order of turn (null first), then of role and text.

    Ranges of rows are sorted on their own, so that a conversation may span several; ranks are counted within ranges
    and moved up by what lies before.
    """
    rows = with_columns_renamed(turns, "conv_id", "turn", "role", "text").where("conv_id is not null")
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = rows.select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), text, role).alias("h2"), F.char_length(text).cast("long").alias("cp"),
    )
    order = [F.col("turn").asc_nulls_first(), "h1", "h2", "cp"]
    ranges = rows.repartitionByRange("conv_id", *order).select("*", F.spark_partition_id().alias("range"))
    ranges = written(ranges, "turns")
    inside = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*order))
    before = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    carry = ranges.groupBy("conv_id", "range").count().select(
        "conv_id", "range", F.coalesce(F.sum("count").over(before), F.lit(0)).alias("before")
    )
    return ranges.withColumn("inside", inside).join(carry, ["conv_id", "range"]).select(
        "conv_id", (F.col("inside") + F.col("before")).alias("rank"), "h1", "h2", "cp"
    )


def rebuilt(turns: DataFrame, stride: int = 100, most: int = 6) -> tuple[DataFrame, DataFrame]:
    """Rebuilt turns (conv_id, depth, h1, h2, cp), and every conv_id once.

    Conversation c takes the first h turns of conversation c - c % stride, h = crc32(c) % most, then its own after its
    first h.
    """
    rows = written(ranked(turns), "ranked")
    h = F.crc32(F.col("conv_id").cast("string").cast("binary")) % most
    sizes = rows.groupBy("conv_id").count().select("conv_id", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % stride).alias("base"))
    head = rows.where((F.col("conv_id") % stride == 0) & (F.col("rank") < most)).withColumnRenamed("conv_id", "base")
    taken = sizes.join(head, "base").where("rank <= h").select("conv_id", F.col("rank").alias("depth"), "h1", "h2", "cp")
    given = taken.groupBy("conv_id").agg(F.count("*").alias("given"))
    # Own turns move up where the other conversation has fewer than h. The rows of one conversation may be very many:
    # the small side has a row for those only that move.
    short = sizes.join(given, "conv_id", "left").select("conv_id", (F.col("h") - F.coalesce("given", F.lit(0))).alias("moves"))
    own = rows.where(F.col("rank") > h).join(short.where("moves > 0"), "conv_id", "left")
    own = own.select("conv_id", (F.col("rank") - F.coalesce("moves", F.lit(0))).alias("depth"), "h1", "h2", "cp")
    return own.unionByName(taken), sizes.select("conv_id")


def prefixes(turns: DataFrame) -> DataFrame:
    """s, depth, x1, x2 (fingerprint of the prefix), cum (its code points), cp, last: from (conv_id, depth, h1, h2, cp)."""
    rows = turns.select(
        F.col("conv_id").alias("s"), "depth", F.floor((F.col("depth") - 1) / BLOCK).alias("block"),
        F.xxhash64("h1", "h2", "depth").alias("x1"), F.xxhash64("depth", "h2", "h1").alias("x2"), "cp",
    )
    inside = Window.partitionBy("s", "block").orderBy("depth")
    upto = inside.rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("s").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    blocks = rows.groupBy("s", "block").agg(
        F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"), F.sum("cp").alias("cp"), F.max("depth").alias("depth")
    )
    carry = blocks.select(
        "s", "block", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(f"b{c}") for c in ("x1", "x2")],
        F.coalesce(F.sum("cp").over(before), F.lit(0)).alias("bcp"),
        (F.max("block").over(Window.partitionBy("s")) == F.col("block")).alias("final"),
    )
    rows = rows.select(
        "s", "block", "depth", "cp", *[F.bit_xor(c).over(upto).alias(c) for c in ("x1", "x2")], F.sum("cp").over(upto).alias("cum"),
        F.lead("depth").over(inside).isNull().alias("last"),
    )
    return rows.join(carry, ["s", "block"]).select(
        "s", F.col("depth").cast("long").alias("depth"), F.col("x1").bitwiseXOR(F.col("bx1")).alias("x1"),
        F.col("x2").bitwiseXOR(F.col("bx2")).alias("x2"), (F.col("cum") + F.col("bcp")).alias("cum"), "cp",
        (F.col("last") & F.col("final")).alias("last"),
    )


# ---------------------------------------------------------------- the trie


def fattest(low: Column, high: Column) -> Column:
    """The depth in (low, high] that the highest power of two divides."""
    top = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high.bitwiseAND(F.call_function("shiftleft", F.lit(-1).cast("long"), top))


NODE = ["rep", "low", "e", "f", "e1", "e2", "f1", "f2", "g1", "g2", "p1", "p2", "cum", "low_cum"]


def with_handles(edges: DataFrame, paths: DataFrame) -> DataFrame:
    """Nodes from (rep, low, e): fingerprints at the end (e), the handle (f), the first turn (g) and the parent (p)."""
    edges = edges.withColumn("f", fattest(F.col("low"), F.col("e")))
    spots = F.array_distinct(F.array("e", "f", F.col("low") + 1, "low"))
    at = edges.select("*", F.explode(spots).alias("depth")).join(
        paths.select(F.col("s").alias("rep"), "depth", "x1", "x2", "cum"), ["rep", "depth"], "left"
    )

    def pick(value: str, where: Column) -> Column:
        return F.max(F.when(where, F.col(value)))

    depth = F.col("depth")
    return at.groupBy("rep", "low", "e", "f").agg(
        *[pick(f"x{i}", depth == F.col("e")).alias(f"e{i}") for i in (1, 2)],
        *[pick(f"x{i}", depth == F.col("f")).alias(f"f{i}") for i in (1, 2)],
        *[pick(f"x{i}", depth == F.col("low") + 1).alias(f"g{i}") for i in (1, 2)],
        *[pick(f"x{i}", depth == F.col("low")).alias(f"p{i}") for i in (1, 2)],
        pick("cum", depth == F.col("e")).alias("cum"),
        F.coalesce(pick("cum", depth == F.col("low")), F.lit(0)).alias("low_cum"),
    ).select(*NODE)


def exits(paths: DataFrame, strings: DataFrame, nodes: DataFrame, deepest: int) -> DataFrame:
    """For each string (s, length) the edge (rep, low, e) that it leaves or ends on, and the depth x of that place.

    Without an edge (rep null) it leaves at the root or at a node of depth x.
    """
    open_ = strings.select(
        "s", "length", F.lit(0).cast("long").alias("l"), F.col("length").alias("r"),
        F.lit(None).cast("struct<rep: long, low: long, e: long, e1: long, e2: long>").alias("top"),
    )
    power = 1 << max(deepest.bit_length() - 1, 0)
    while power:
        probe = F.floor(F.col("r") / power).cast("long") * power
        asked = open_.withColumn("depth", F.when(probe > F.col("l"), probe))
        some = paths.where(F.col("depth") % power == 0).select("s", "depth", "x1", "x2")
        handles = nodes.where(F.col("f") % power == 0).select(
            F.col("f").alias("depth"), F.col("f1").alias("x1"), F.col("f2").alias("x2"), F.struct("rep", "low", "e", "e1", "e2").alias("hit")
        )
        asked = asked.join(some, ["s", "depth"], "left").join(handles, ["depth", "x1", "x2"], "left")
        hit = F.col("hit").isNotNull()
        open_ = asked.select(
            "s", "length",
            F.when(hit, F.least(F.col("hit.e"), F.col("r"))).otherwise(F.col("l")).alias("l"),
            F.when(F.col("depth").isNotNull() & ~hit, F.col("depth") - 1).otherwise(F.col("r")).alias("r"),
            F.when(hit, F.col("hit")).otherwise(F.col("top")).alias("top"),
        )
        if power.bit_length() % 4 == 0:
            open_ = written(open_, "search")
        power >>= 1
    found = written(open_.select("s", "length", "top"), "tops")
    # Does the string pass the whole edge of the node found? Then the next edge is known by its first turn.
    ends = paths.select("s", F.col("depth").alias("te"), F.col("x1").alias("a1"), F.col("x2").alias("a2"))
    through = (F.col("a1") == F.col("top.e1")) & (F.col("a2") == F.col("top.e2"))
    found = found.withColumn("te", F.col("top.e")).join(ends, ["s", "te"], "left")
    found = found.withColumn("passed", F.coalesce(through, F.col("top").isNull()))
    found = found.withColumn("at", F.when(F.col("passed"), F.coalesce("te", F.lit(0).cast("long"))))
    next_ = paths.select("s", (F.col("depth") - 1).alias("at"), F.col("x1").alias("g1"), F.col("x2").alias("g2"))
    firsts = nodes.select(F.col("low").alias("at"), "g1", "g2", F.struct("rep", "low", "e", "e1", "e2").alias("child"))
    found = found.join(next_, ["s", "at"], "left").join(firsts, ["at", "g1", "g2"], "left")
    edge = F.when(F.col("passed"), F.col("child")).otherwise(F.col("top"))
    found = found.select("s", "length", "at", edge.alias("edge"))
    found = written(found.select("s", "length", "at", "edge.rep", "edge.low", "edge.e"), "edges")
    # Along the edge, turn by turn, both prefixes agree down to the exit.
    own = paths.select("s", "depth", "x1", "x2").join(found.where("rep is not null"), "s").where("depth > low and depth <= e")
    other = paths.select(F.col("s").alias("rep"), "depth", "x1", "x2")
    agree = own.join(other, ["rep", "depth", "x1", "x2"]).groupBy("s").agg(F.max("depth").alias("agreed"))
    return found.join(agree, "s", "left").select("s", "rep", "low", "e", F.coalesce("agreed", "at", F.lit(0).cast("long")).alias("x"))


def insert(nodes: DataFrame, paths: DataFrame, strings: DataFrame, deepest: int) -> DataFrame:
    """The nodes after a batch of strings (s, length) has been added."""
    left = written(exits(paths, strings, nodes, deepest), "exits")
    # Edges are split where strings leave them.
    cuts = left.where("rep is not null and x < e").select("rep", "low", "e", F.col("x").alias("cut")).distinct()
    along = Window.partitionBy("rep", "low", "e").orderBy("cut")
    upper = cuts.select("rep", F.coalesce(F.lag("cut").over(along), F.col("low")).alias("low"), F.col("cut").alias("e"))
    split = cuts.groupBy("rep", "low", "e").agg(F.max("cut").alias("cut"))
    lower = split.select("rep", F.col("cut").alias("low"), "e")
    # Below its exit a string is new: nodes are the places where strings of the batch part or end.
    fresh = paths.select("s", "depth", "x1", "x2", "last").join(left.select("s", "x"), "s").where("depth > x")
    after = Window.partitionBy("s", F.floor((F.col("depth") - 1) / BLOCK)).orderBy("depth")
    # The first turn of the next block is brought along, so that windows stay within blocks.
    ahead = fresh.where((F.col("depth") - 1) % BLOCK == 0).select("s", (F.col("depth") - 1).alias("depth"), F.col("x1").alias("m1"), F.col("x2").alias("m2"))
    step = fresh.select("*", *[F.lead(f"x{i}").over(after).alias(f"n{i}") for i in (1, 2)]).join(ahead, ["s", "depth"], "left")
    step = step.select("s", "depth", "x", "x1", "x2", "last", *[F.coalesce(f"n{i}", f"m{i}").alias(f"n{i}") for i in (1, 2)])
    step = written(step, "fresh")
    parts = (F.min("n1") != F.max("n1")) | (F.min("n2") != F.max("n2"))
    places = step.groupBy("depth", "x1", "x2").agg(F.min("s").alias("rep"), (F.coalesce(parts, F.lit(False)) | F.max("last")).alias("stop"))
    stops = places.where("stop").select("depth", "x1", "x2", "rep")
    marked = step.join(stops, ["depth", "x1", "x2"]).select("s", "depth", "x", "rep")
    # A node's parent is the place before it on its own path, or the exit of that path.
    chain = Window.partitionBy("s").orderBy("depth")
    grown = marked.select("s", "rep", F.coalesce(F.lag("depth").over(chain), F.col("x")).alias("low"), F.col("depth").alias("e"))
    grown = grown.where("s = rep").select("rep", "low", "e")
    changed = with_handles(upper.unionByName(lower).unionByName(grown), paths)
    kept = nodes.join(split.select("rep", "low", "e"), ["rep", "low", "e"], "left_anti")
    return written(kept.select(*NODE).unionByName(changed), "nodes")


def build(paths: DataFrame, strings: DataFrame) -> DataFrame:
    """Compacted nodes of all strings (s, length), which are distinct and longer than nothing."""
    spark = paths.sparkSession
    deepest = strings.agg(F.max("length")).first()[0] or 0
    nodes = spark.createDataFrame([], ", ".join(f"{c} long" for c in NODE))
    turn = F.pmod(F.xxhash64("s"), F.lit(BATCHES[-1]))
    below = 0
    for upto in BATCHES:
        batch = written(strings.where((turn >= below) & (turn < upto)), "batch")
        if not batch.isEmpty():
            nodes = insert(nodes, paths, batch, deepest)
        below = upto
    return nodes


# ---------------------------------------------------------------- sums and digests


def digests(ends: DataFrame) -> DataFrame:
    """s, ends_sha256: digest of the conv_ids of each s, ascending, with commas.

    A digest reads its ids in order, so one task reads those of one string; ids come as pieces of text made in
    parallel, and are streamed, never held together.
    """
    ordered = ends.repartitionByRange("s", "conv_id").sortWithinPartitions("s", "conv_id")

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, first, ids, out = None, None, [], []

        def flush() -> None:
            if ids:
                out.append((now, first, ",".join(map(str, ids))))

        for batch in batches:
            for s, c in zip(batch.column("s").to_pylist(), batch.column("conv_id").to_pylist()):
                if s != now or len(ids) >= PIECE_IDS:
                    flush()
                    now, first, ids = s, c, []
                ids.append(c)
            yield _batch(out)
            out = []
        flush()
        yield _batch(out)

    def _batch(out: list[tuple]) -> pa.RecordBatch:
        cols = [pa.array([o[j] for o in out], kind) for j, kind in enumerate((pa.int64(), pa.int64(), pa.string()))]
        return pa.RecordBatch.from_arrays(cols, ["s", "first", "ids"])

    pieces = ordered.mapInArrow(join, "s long, first long, ids string").repartition("s").sortWithinPartitions("s", "first")

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, code = None, None
        for batch in batches:
            out = []
            for s, ids in zip(batch.column("s").to_pylist(), batch.column("ids").to_pylist()):
                if s == now:
                    code.update(b"," + ids.encode())
                    continue
                if code is not None:
                    out.append((now, code.hexdigest()))
                now, code = s, hashlib.sha256(ids.encode())
            yield pa.RecordBatch.from_arrays([pa.array([o[0] for o in out], pa.int64()), pa.array([o[1] for o in out], pa.string())], ["s", "ends_sha256"])
        if code is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.int64()), pa.array([code.hexdigest()])], ["s", "ends_sha256"])

    return pieces.mapInArrow(digest, "s long, ends_sha256 string")


ID = ["e", "e1", "e2"]
SUMS = ["n_convs", "conv_id", "n_leaves", "ends_cum", "edge_cp"]


def with_subtrees(nodes: DataFrame) -> DataFrame:
    """Nodes with SUMS taken over their subtrees (conv_id: the least), by pointer doubling."""
    up = ["a", "a1", "a2"]
    state = nodes.select(*ID, *SUMS, *[F.when(F.col("low") > 0, F.col(c)).alias(u) for c, u in zip(("low", "p1", "p2"), up)])
    state = written(state, "sums")
    while not state.where("a is not null").isEmpty():
        merged = [F.min(c).alias(f"u_{c}") if c == "conv_id" else F.sum(c).alias(f"u_{c}") for c in SUMS]
        given = state.where("a is not null").groupBy(*up).agg(*merged).toDF(*ID, *[f"u_{c}" for c in SUMS])
        above = state.select(*[F.col(c).alias(u) for c, u in zip(ID, up)], *[F.col(u).alias(f"n_{u}") for u in up])
        own = [
            (F.least(F.col(c), F.col(f"u_{c}")) if c == "conv_id" else F.col(c) + F.coalesce(f"u_{c}", F.lit(0))).alias(c) for c in SUMS
        ]
        state = state.join(given, ID, "left").select(*ID, *own, *up)
        state = written(state.join(above, up, "left").select(*ID, *SUMS, *[F.col(f"n_{u}").alias(u) for u in up]), "sums")
    return state.select(*ID, *SUMS)


def conversation_trie(turns: DataFrame) -> DataFrame:
    """conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256 of every trie node.

    ``turns`` has conv_id, turn, role and text; null role or text is empty, rows without conv_id belong to no
    conversation, rows that share a turn are ordered by a hash of role and text, repeated rows are turns of their
    own, further columns are ignored. An empty table gives no rows; a conversation left without turns ends at the
    root.
    """
    rows, every = rebuilt(turns)
    paths = written(prefixes(rows), "paths")
    every = written(every, "conversations")
    # Equal conversations are one string, known by the least id.
    ends = every.join(paths.where("last").select(F.col("s").alias("conv_id"), F.col("depth").alias("length"), "x1", "x2", "cum"), "conv_id", "left")
    ends = written(ends, "ends")
    strings = ends.where("length is not null").groupBy("length", "x1", "x2", "cum").agg(F.min("conv_id").alias("s"), F.count("*").alias("n"))
    strings = written(strings, "strings")
    paths = written(paths.join(strings.select("s"), "s", "left_semi"), "own-paths")
    nodes = build(paths, strings.select("s", "length"))

    children = nodes.where("low > 0").groupBy(F.col("low").alias("e"), F.col("p1").alias("e1"), F.col("p2").alias("e2")).agg(F.count("*").alias("n_children"))
    here = strings.select(F.col("length").alias("e"), F.col("x1").alias("e1"), F.col("x2").alias("e2"), F.col("s").alias("own"), "n")
    nodes = nodes.join(children, ID, "left").join(here, ID, "left").select(
        *NODE, F.coalesce("n_children", F.lit(0).cast("long")).alias("n_children"), "own",
        F.coalesce("n", F.lit(0).cast("long")).alias("n_convs"), F.col("own").alias("conv_id"),
        F.col("n_children").isNull().cast("long").alias("n_leaves"),
        (F.coalesce("n", F.lit(0)) * F.col("cum")).alias("ends_cum"), (F.col("cum") - F.col("low_cum")).alias("edge_cp"),
    )
    nodes = written(nodes, "nodes")
    sums = written(with_subtrees(nodes), "subtrees")
    listed = written(digests(ends.join(strings.select("length", "x1", "x2", "s"), ["length", "x1", "x2"]).select("s", "conv_id")), "digests")
    parents = sums.select(F.col("e").alias("low"), F.col("e1").alias("p1"), F.col("e2").alias("p2"), F.col("conv_id").alias("parent"))
    members = every.agg(F.min("conv_id").alias("least"), F.count("*").alias("n")).first()
    full = (
        nodes.drop(*SUMS).join(sums, ID).join(parents, ["low", "p1", "p2"], "left")
        .join(listed.select(F.col("s").alias("own"), "ends_sha256"), "own", "left")
        .withColumn("parent", F.coalesce("parent", F.lit(members["least"]).cast("long")))
    )

    # Edges are expanded into their turns.
    steps = full.withColumn("begin", F.explode(F.sequence(F.col("low") + 1, F.col("e"), F.lit(EDGE).cast("long"))))
    steps = steps.withColumn("depth", F.explode(F.sequence(F.col("begin"), F.least(F.col("begin") + EDGE - 1, F.col("e")))))
    placed = steps.join(paths.select(F.col("s").alias("rep"), "depth", F.col("cum").alias("here"), "cp"), ["rep", "depth"])
    end, before = F.col("depth") == F.col("e"), F.col("here") - F.col("cp")
    nothing = F.lit(hashlib.sha256(b"").hexdigest())
    saved = F.col("ends_cum") - F.col("n_convs") * before - F.col("edge_cp") + (before - F.col("low_cum"))
    out = placed.select(
        "conv_id", "depth", F.when(F.col("depth") == F.col("low") + 1, F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs", F.when(end, F.col("n_children")).otherwise(F.lit(1)).alias("n_children"), "n_leaves", saved.alias("saved_tokens"),
        F.when(end, F.coalesce("ends_sha256", nothing)).otherwise(nothing).alias("ends_sha256"),
    )

    # The root, one row: all conversations are its members, and those without turns end there.
    if not members["n"]:
        return out
    turnless = digests(ends.where("length is null").select(F.lit(0).cast("long").alias("s"), "conv_id")).first()
    tops = sums.join(nodes.where("low = 0").select(*ID), ID, "left_semi")
    total = tops.agg(F.count("*").alias("n"), F.sum("n_leaves").alias("leaves"), F.sum(F.col("ends_cum") - F.col("edge_cp")).alias("saved")).first()
    row = (
        members["least"], 0, None, members["n"], total["n"], total["leaves"] or 1, total["saved"] or 0,
        turnless["ends_sha256"] if turnless else hashlib.sha256(b"").hexdigest(),
    )
    return out.unionByName(turns.sparkSession.createDataFrame([row], out.schema))
