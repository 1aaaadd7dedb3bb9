"""Export by key as a stream: stopped, failed and resumed runs give every row once."""

import pytest
from pyspark.sql import functions as F

from chunkloom.sources import pages


def written(spark, rows, path, schema="k long, v string", files=3):
    spark.createDataFrame(rows, schema).repartition(files).write.mode("append").parquet(path)


def counts(spark, out):
    rows = spark.read.parquet(out).groupBy("k", "v").agg(F.count("*")).collect()
    return {(r[0], r[1]): r[2] for r in rows}


def batches(spark, out):
    rows = spark.read.parquet(out).groupBy("batch").agg(F.sort_array(F.collect_set("k")).alias("k")).collect()
    return {r["batch"]: r["k"] for r in rows}


def test_resumed_after_a_failure_and_a_stop(spark, tmp_path):
    path, plan, out, state = (str(tmp_path / n) for n in ("rows", "plan", "out", "state"))
    written(spark, [(i, f"v{i}") for i in range(1, 26)] + [(None, "lost")], path)
    assert pages.plan_pages(spark.read.parquet(path), "k", plan, 4) == 7

    def start(transform=lambda rows: rows, per_batch=1):
        stream = pages.stream_pages(spark, path, "k", plan, per_batch=per_batch)
        return pages.export_pages(stream, out, state, transform)

    seen = []

    def fails_on_the_third(rows):
        seen.append(rows.count())
        if len(seen) == 3:
            raise RuntimeError("the third page fails")
        return rows

    run = start(fails_on_the_third)
    with pytest.raises(Exception, match="the third page fails"):
        run.processAllAvailable()
    assert batches(spark, out) == {0: [1, 2, 3, 4], 1: [5, 6, 7, 8]}
    run = start(per_batch=2)
    run.processAllAvailable()
    run.stop()
    # The batch that failed is taken again as it was; those after it are larger.
    assert batches(spark, out) == {0: [1, 2, 3, 4], 1: [5, 6, 7, 8], 2: [9, 10, 11, 12], 3: list(range(13, 21)), 4: list(range(21, 26))}
    assert counts(spark, out) == {(i, f"v{i}"): 1 for i in range(1, 26)}

    # New rows are planned beyond the last key; a run that starts again takes these alone.
    written(spark, [(i, f"v{i}") for i in range(26, 31)], path, files=1)
    assert pages.plan_pages(spark.read.parquet(path), "k", plan, 4) == 2
    assert pages.plan_pages(spark.read.parquet(path), "k", plan, 4) == 0
    run = start()
    run.processAllAvailable()
    run.stop()
    assert counts(spark, out) == {(i, f"v{i}"): 1 for i in range(1, 31)}
    assert batches(spark, out)[5] == [26, 27, 28, 29] and batches(spark, out)[6] == [30]


def test_repeated_text_keys_and_chosen_columns(spark, tmp_path):
    path, plan, out, state = (str(tmp_path / n) for n in ("rows", "plan", "out", "state"))
    rows = [(k, f"{k}{i}", 1) for k, n in (("", 1), ("B", 2), ("a", 40), ("ä", 3), ("日", 2), ("😀", 1), (None, 2)) for i in range(n)]
    written(spark, rows, path, "k string, v string, more int")
    assert pages.plan_pages(spark.read.parquet(path), "k", plan, 2) == 3
    stream = pages.stream_pages(spark, path, "k", plan, ["k", "v"])
    assert stream.columns == ["k", "v"]
    run = pages.export_pages(stream, out, state)
    run.processAllAvailable()
    run.stop()
    assert counts(spark, out) == {(k, v): 1 for k, v, _ in rows if k is not None}
    assert batches(spark, out) == {0: ["", "B"], 1: ["a", "ä"], 2: ["日", "😀"]}


def test_nothing_to_export(spark, tmp_path):
    path, plan, out, state = (str(tmp_path / n) for n in ("rows", "plan", "out", "state"))
    written(spark, [(None, "x")], path, files=1)
    assert pages.plan_pages(spark.read.parquet(path), "k", plan) == 0
    run = pages.export_pages(pages.stream_pages(spark, path, "k", plan), out, state)
    run.processAllAvailable()
    run.stop()
    assert counts(spark, out) == {}  # Spark runs a first batch all the same, without rows
    with pytest.raises(ValueError, match="whole number or a string"):
        pages.plan_pages(spark.range(3).select(F.col("id").cast("double").alias("k")), "k", plan)
