"""Ordered operators against plain sequential folds on random documents cut into small blocks."""

import random

import numpy as np
import pytest

from chunkloom.functions.tokens import word_count
from chunkloom.operators import filters, merging, sections, segments
from chunkloom.operators.joins import attach_metadata
from pyspark.sql import functions as F
from pyspark.sql.window import Window

pytestmark = pytest.mark.usefixtures("small_blocks")

LO, HI = 3, 6


@pytest.fixture(params=["10MB", "-1"])
def broadcast_limit(spark, request):
    """Joins planned as broadcasts, and joins planned as shuffles that AQE may still turn around."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, request.param)
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "10MB")
    yield
    spark.conf.set(key, before)
    spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def documents(seed, make, n_docs=25, longest=14):
    rng = random.Random(seed)
    docs = {d: [make(rng) for _ in range(rng.randint(1, longest))] for d in range(n_docs)}
    docs[1000] = [make(rng) for _ in range(120)]  # one document with a large share of the rows
    return docs


def text_of(rng):
    return " ".join(rng.choice(["ab", "c", "def", "x."]) for _ in range(rng.choice([1, 2, 2, 3, 5, 6, 7, 9])))


def chunk_frame(spark, docs):
    rows = [(d, p, t, p // 2) for d, texts in docs.items() for p, t in enumerate(texts)]
    random.Random(0).shuffle(rows)
    return spark.createDataFrame(rows, "doc_id long, pos long, text string, page_number int")


def fold_merge(texts):
    waiting, out = "", []
    for p, t in enumerate(texts):
        n = len(t.split(" "))
        if n > HI:
            if "<table>" in t:
                out.append(("<table><tr><td>1</td></tr></table>", p // 2))
        elif n < LO:
            waiting += t + " "
        else:
            out.append((waiting + t, p // 2))
            waiting = ""
    if waiting:
        out.append((waiting, (len(texts) - 1) // 2))
    return out


@pytest.mark.parametrize("longest", [None, 2])
@pytest.mark.parametrize("seed", range(4))
def test_merge(spark, seed, longest, broadcast_limit):
    def make(rng):
        return text_of(rng) + ("<table><tr><td>1</table>" if rng.random() < 0.3 else "")

    docs = documents(seed, make)
    docs |= {2000: ["a"], 2001: ["a b"] * 9, 2002: ["a b c d e f g h"] * 4, 2003: ["a b c"], 2004: ["a b c d e f"]}
    meta = spark.createDataFrame([(d, f"m{d}") for d in docs if d != 3], "doc_id long, name string")
    merged = merging.merge_small_chunks(chunk_frame(spark, docs), LO, HI, word_count, meta=meta, longest=longest)
    got = {}
    for r in merged.collect():
        got.setdefault(r.doc_id, []).append((r.idx, r.pos, r.sub, r.text, r.page_number))
        assert r.name == f"m{r.doc_id}"
    for d, texts in docs.items():
        rows = sorted(got.get(d, []))
        assert [r[0] for r in rows] == list(range(len(rows)))
        assert [r[1:3] for r in rows] == sorted(r[1:3] for r in rows)
        assert [r[3:] for r in rows] == (fold_merge(texts) if d != 3 else [])


def test_merge_keeps_text_and_counts(spark):
    docs = {0: ["a b c d e f g h", "a", "a b c"]}
    frame = chunk_frame(spark, docs)
    kept = merging.merge_small_chunks(frame, LO, HI, word_count, keep_text=True).orderBy("idx").collect()
    assert [r.text for r in kept] == ["a b c d e f g h", "a a b c"]
    assert merging.oversize_report(frame, HI, word_count).first().n_oversize == 1
    counted = frame.withColumn("n_tokens", F.lit(5))
    assert merging.merge_small_chunks(counted, LO, HI).count() == 3


def test_scan_equals_window(spark, broadcast_limit):
    docs = documents(7, lambda rng: rng.choice(["", "a", "bb", "ccc"]))
    df = chunk_frame(spark, docs).withColumn("v", F.when(F.length("text") > 0, F.length("text")))
    specs = {
        "n": segments.Running("count", F.col("text") == "a"),
        "s": segments.Running("sum", F.col("v"), inclusive=False),
        "hi": segments.Running("max", F.col("v")),
        "lo": segments.Running("min", F.col("v")),
        "last": segments.Running("last", F.col("v")),
        "total": segments.Whole("sum", F.col("v")),
        "end": segments.Whole("at_end", F.col("v")),
    }
    blocked = segments.scan(df, "doc_id", "pos", specs)
    whole = segments.scan(df, "doc_id", "pos", specs, longest=1)
    w = Window.partitionBy("doc_id").orderBy("pos")
    up, before = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(Window.unboundedPreceding, -1)
    everything = w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    plain = df.select(
        *df.columns,
        F.sum(F.when(F.col("text") == "a", 1).otherwise(0)).over(up).alias("n"),
        F.sum("v").over(before).alias("s"),
        F.max("v").over(up).alias("hi"),
        F.min("v").over(up).alias("lo"),
        F.last("v", ignorenulls=True).over(up).alias("last"),
        F.sum("v").over(everything).alias("total"),
        F.last("v").over(everything).alias("end"),
    )
    want = sorted(map(tuple, plain.collect()), key=str)
    for found in (blocked, whole):
        assert sorted(map(tuple, found.select(plain.columns).collect()), key=str) == want


def test_rank_all(spark):
    rng = random.Random(3)
    values = [(rng.choice([1, 1, 1, rng.randint(2, 9)]), i) for i in range(5000)]
    df = spark.createDataFrame(values, "a int, b int").repartition(7)
    rows = segments.rank_all(df, "a", F.desc("b"), partitions=6).collect()
    got = [(r.a, r.b) for r in sorted(rows, key=lambda r: r.rn)]
    assert got == sorted(values, key=lambda v: (v[0], -v[1]))
    assert sorted(r.rn for r in rows) == list(range(1, 5001)) and {r.n_rows for r in rows} == {5000}


@pytest.mark.parametrize("partitions", [1, 2, 9, 40])
def test_ranks_of_mixed_keys(spark, partitions):
    """Text, nulls and directions, with a third of all rows under one first key; the same on every run, nothing stored."""
    rng = random.Random(partitions)
    rows = [(None if i % 7 == 0 else "hot" if i % 3 == 0 else rng.choice(["a", "b", "é", "zz"]), rng.choice([None, 1, 2]), i) for i in range(700)]
    df = spark.createDataFrame(rows, "a string, b int, c int").repartition(5)
    for order in (("a", F.desc("b"), "c"), (F.desc_nulls_first("a"), F.asc_nulls_last("b"), F.desc("c"))):
        whole = df.withColumn("rn", F.row_number().over(Window.orderBy(*order))).withColumn("n_rows", F.lit(700).cast("long"))
        ranked = segments.rank_all(df, *order, partitions=partitions)
        assert sorted(ranked.collect(), key=str) == sorted(whole.collect(), key=str) == sorted(ranked.collect(), key=str)
    plan = ranked._jdf.queryExecution().executedPlan().toString()
    assert ("SinglePartition" in plan) == (partitions == 1)
    with pytest.raises(ValueError):
        segments.rank_all(df, F.col("c") + 1)



@pytest.mark.parametrize("seed", range(3))
def test_attach_tables(spark, seed):
    docs = documents(seed, lambda rng: (rng.random() < 0.5, text_of(rng), rng.choice([None, "<t>"])))
    rows = [
        (d, p, "Table" if t else "Composite", x, h, p)
        for d, items in docs.items()
        for p, (t, x, h) in enumerate(items)
    ]
    frame = spark.createDataFrame(
        rows, "doc_id long, pos long, kind string, text string, html string, page_number int"
    )
    for mode in ("text", "skip", "both"):
        want = set()
        for d, items in docs.items():
            out = []
            for p, (is_table, x, h) in enumerate(items):
                if not is_table:
                    out.append([x, p])
                    continue
                if h is None and mode == "skip":
                    continue
                body = "\n\n".join(v for v in (x, h) if v) if mode == "both" else (h if h is not None else x)
                if out:
                    out[-1][0] += "|" + body
                else:
                    out.append([body, p])
            want |= {(d, *o) for o in out}
        got = merging.attach_tables(frame, "|", mode).collect()
        assert {(r.doc_id, r.text, r.page_number) for r in got} == want and len(got) == len(want)


@pytest.mark.parametrize("seed", range(3))
def test_title_blocks(spark, seed, broadcast_limit):
    docs = documents(seed, lambda rng: rng.choice(["Title ", " Other", "Body.", "two\nlines", " ", "Last. "]))
    want = set()
    for d, texts in docs.items():
        out, titles = [], []
        for t in texts:
            s = t.strip()
            if s and not s.endswith(".") and "\n" not in s:
                titles.append(s)
            else:
                out.append("\n".join([*titles, t]))
                titles = []
        if titles:
            if out:
                out[-1] += "\n" + "\n".join(titles)
            else:
                out = ["\n".join(titles)]
        want |= {(d, i, t) for i, t in enumerate(out)}
    got = segments.number_rows(merging.merge_title_blocks(chunk_frame(spark, docs)), "doc_id", "pos")
    assert {(r.doc_id, r.idx, r.text) for r in got.collect()} == want


def test_short_tail(spark):
    docs = documents(5, lambda rng: rng.choice(["short", "long enough text"]))
    docs[2000] = ["tiny"]
    want = set()
    for d, texts in docs.items():
        texts = list(texts)
        if len(texts) >= 2 and len(texts[-1]) < 10:
            texts[-2:] = [texts[-2] + " " + texts[-1]]
        want |= {(d, p, t) for p, t in enumerate(texts)}
    got = merging.absorb_short_tail(chunk_frame(spark, docs)).collect()
    assert {(r.doc_id, r.pos, r.text) for r in got} == want


def fold_pack(items, profile):
    """Chunks as lists of texts, tables and cut elements on their own."""
    out, open_, length = [], [], 0
    for title, table, text in items:
        if table or len(text) > profile.max_chars:
            if open_:
                out.append(("Composite", "\n\n".join(open_)))
            open_, length = [], 0
            pieces = sections._cut(text, profile.max_chars)
            out += [("Table" if table else "Composite", p) for p in pieces]
            continue
        full = length >= profile.soft or length + 2 + len(text) > profile.max_chars
        if open_ and (full or (title and length >= profile.combine_under)):
            out.append(("Composite", "\n\n".join(open_)))
            open_, length = [], 0
        length = length + 2 + len(text) if open_ else len(text)
        open_.append(text)
    if open_:
        out.append(("Composite", "\n\n".join(open_)))
    return out


@pytest.mark.parametrize("block_rows", [4, 1000])
@pytest.mark.parametrize(
    "profile",
    [sections.Profile(10, 30, 60), sections.Profile(0, None, 50), sections.Profile(40, None, 40), sections.Profile(5, 12, 200)],
)
def test_chunk_by_title(spark, profile, block_rows, broadcast_limit, monkeypatch):
    monkeypatch.setattr(sections, "CHAIN", 3)

    def make(rng):
        words = ["word"] * rng.choice([1, 1, 1, 2, 2, 3, 5, 30])
        return rng.random() < 0.15, rng.random() < 0.05, " ".join(words)[: rng.randint(1, 140)].strip() or "w"

    docs = documents(11, make)
    docs[3000] = [(False, False, "ab")] * 200  # short lines without any title
    rows = [
        (d, p, "Table" if b else "Title" if t else "NarrativeText", x, p, None)
        for d, items in docs.items()
        for p, (t, b, x) in enumerate(items)
    ]
    random.Random(1).shuffle(rows)
    frame = spark.createDataFrame(
        rows, "doc_id long, pos long, category string, text string, page_number int, html string"
    )
    for longest in (None,) if block_rows == 4 else (None, 200):
        chunks = sections.chunk_by_title(frame, profile, block_rows, longest).collect()
        got = {}
        for r in chunks:
            got.setdefault(r.doc_id, []).append((r.pos, r.sub, r.kind, r.text))
            assert r.page_number == r.pos
        for d, items in docs.items():
            assert [r[2:] for r in sorted(got[d])] == fold_pack(items, profile), d


def test_cuts_and_slices(spark):
    docs = documents(9, lambda rng: rng.choice(["REFER ENCES:", "Intro", "text", "text", "text"]))
    frame = chunk_frame(spark, docs).withColumn(
        "category", F.when(F.col("text") == "text", "NarrativeText").otherwise("Title")
    )
    kept = filters.cut_back_matter(frame).collect()
    want = set()
    for d, texts in docs.items():
        stop = texts.index("REFER ENCES:") if "REFER ENCES:" in texts else len(texts)
        want |= {(d, p) for p in range(stop)}
    assert {(r.doc_id, r.pos) for r in kept} == want
    assert filters.drop_last_chunk(frame).count() == frame.count() - len(docs)

    texts = ["Source", "a", "Source", "b", "Restriction of Use x", "c"]
    one = chunk_frame(spark, {0: texts, 1: ["Source", "Restriction of Use"], 2: ["Source", "a"], 3: ["Restriction of Use", "Source", "z"]})
    one = one.withColumn("category", F.when(F.col("text") == "Source", "Title").otherwise("Text"))
    got = {(r.doc_id, r.pos) for r in filters.slice_between_last(one).collect()}
    assert got == {(0, 2), (0, 3), (2, 0), (2, 1)}


def test_metadata_join_is_inner(spark):
    docs = documents(2, text_of)
    meta = spark.createDataFrame([(d, "x") for d in list(docs)[::2]], "doc_id long, name string")
    joined = attach_metadata(chunk_frame(spark, docs), meta)
    assert joined.count() == sum(len(docs[d]) for d in list(docs)[::2])


def test_heading_sections(spark):
    rows = [(0, i, h, t) for i, (h, t) in enumerate([
        (False, "preamble"), (True, "A"), (False, "one"), (False, "two"), (True, ""), (False, "lost"),
        (True, "B"), (True, "A"), (False, "three"),
    ])]
    frame = spark.createDataFrame(rows, "doc_id long, pos long, is_heading boolean, text string")
    got = [(r.heading, r.body) for r in sections.heading_sections(frame).orderBy("pos").collect()]
    assert got == [("A", "three"), ("B", "")]


def test_block_maps_compose():
    rng = random.Random(4)
    for _ in range(300):
        profile = sections.Profile(rng.choice([0, 5, 20]), rng.choice([None, 12]), rng.choice([20, 40]))

        def block(start):
            items = range(start, start + rng.randint(1, 6))
            values = [(rng.randint(1, 15), rng.random() < 0.2, rng.random() < 0.1, p) for p in items]
            return [np.array(c) for c in zip(*values)]

        blocks = [block(0), block(10), block(20)]
        maps = [sections._transfer(*b, profile) for b in blocks]
        whole = sections._compose(sections._compose(maps[0], maps[1]), maps[2])
        for entry in range(profile.soft):
            state = (entry, -1 if entry == 0 else -5)
            step = state
            for b, m in zip(blocks, maps):
                want = sections._pack_lengths(*step, *(c.tolist() for c in b), profile)
                step = sections._follow(m, *step)
                assert step == want
            assert sections._follow(whole, *state) == step


def test_long_tables_keep_their_markup(spark):
    cell = " ".join(f"long{i}" for i in range(20))
    rows = [f"<tr><td>a{i}</td><td><b>b{i}</b> &lt;</td></tr>" for i in range(30)]
    rows[10] = '<tr><td rowspan="3">tall</td><td>b10</td></tr>'
    rows[11], rows[12] = "<tr><td>b11</td></tr>", f"<tr><td>{cell}</td></tr>"
    html = f'<table class="x"><caption>of it</caption><thead><tr><th>h</th><th>k</th></tr></thead><tbody>{"".join(rows)}</tbody></table>'
    texts = [f"a{i} b{i} <" for i in range(30)]
    texts[10:13] = ["tall b10", "b11", cell]
    text = "\n".join(["of it", "h k", *texts])
    made = [(d, 0, "NarrativeText", "before", 1, None) for d in range(4)]
    made += [(0, 1, "Table", text, 1, html), (1, 1, "Table", "other " * 20, 1, html), (2, 1, "Table", text, 1, None)]
    made += [(3, 1, "Table", text, 1, "<img src='x'>")]
    frame = spark.createDataFrame(made, "doc_id long, pos long, category string, text string, page_number int, html string")
    chunks = sections.chunk_by_title(frame, sections.Profile(0, None, 60))
    got = [sorted((r for r in chunks.collect() if r.doc_id == d and r.kind == "Table"), key=lambda r: r.sub) for d in range(4)]
    for d in (0, 1):
        assert len(got[d]) > 1 and all(len(r.text) <= 60 for r in got[d])
        assert all(r.html.startswith('<table class="x">') and "<thead><tr><th>h</th><th>k</th></tr></thead>" in r.html for r in got[d])
        joined = "".join(r.html for r in got[d])
        assert all(joined.count(row) == 1 for i, row in enumerate(rows) if not 10 <= i <= 12)
        assert joined.count("<caption>of it</caption>") == 1 and joined.count("<td>tall</td>") == 2
        assert all(joined.count(f"long{i}<") + joined.count(f"long{i} ") == 1 for i in range(20))
    assert "".join("".join(r.text for r in got[0]).split()) == "".join(text.split())
    # Every piece of text has the markup of the same cells.
    for r in got[0]:
        assert all((f"<b>b{i}</b>" in r.html) == (f"b{i} <" in r.text) for i in range(30) if not 10 <= i <= 12)
    assert " ".join(r.text for r in got[1]).split() == ["other"] * 20
    assert [r.html for r in got[2]] == [None] * len(got[2]) and [r.html for r in got[3]][:2] == ["<img src='x'>", None]
    whole = {r.doc_id: r.text for r in merging.attach_tables(chunks, "|", "skip").collect()}
    assert whole[0] == "|".join(["before", *(r.html for r in got[0])]) and whole[2] == "before"
