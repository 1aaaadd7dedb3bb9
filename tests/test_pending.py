"""The change feed: runs read what changed, failed documents are skipped, broken runs are made good."""

import shutil

import pytest
from pyspark.sql import functions as F

from chunkloom.plans.pending import PendingIndex
from chunkloom.sinks import changes


def stamp(spark, log, ids, stage="upload", at="2024-01-01"):
    rows = spark.createDataFrame([(i,) for i in ids], "doc_id string")
    return changes.append_version(rows.select("doc_id", F.lit(stage).alias("stage"), F.lit(at).cast("timestamp").alias("at")), log)


def builder(bad=(), seen=None):
    def build(waiting):
        if seen is not None:
            seen.append(sorted(r[0] for r in waiting.select("doc_id").collect()))
        rows = waiting.where("doc_id <> 'empty'").select("doc_id", F.explode(F.array(F.lit(0), F.lit(1))).alias("pos"))
        return rows.withColumn("error", F.when(F.col("doc_id").isin(*bad) & (F.col("pos") == 1), F.lit("broken")))

    return build


def shown(index, spark):
    return {(r["doc_id"], r["pos"], r["version"]) for r in index.rows(spark).collect()}


def test_versions_and_changes(spark, tmp_path):
    log = str(tmp_path / "log")
    assert changes.versions(spark, log) == []
    assert changes.changes(spark, log, "upload").collect() == []
    assert [stamp(spark, log, ["a", "b"]), stamp(spark, log, ["a"], "parse"), stamp(spark, log, ["b", "c"], at="2024-01-02")] == [1, 2, 3]
    got = {(r["doc_id"], r["version"]) for r in changes.changed_documents(spark, log, "upload").collect()}
    assert got == {("a", 1), ("b", 3), ("c", 3)}
    assert {r[0] for r in changes.changes(spark, log, "upload", 1).collect()} == {"b", "c"}
    assert changes.changes(spark, log, "upload", 1, 2).collect() == []
    # Only folders of the versions and the stage asked for are listed and read.
    assert {f.split("/")[-3:-1][0] for f in changes.changes(spark, log, "upload", 1).inputFiles()} == {"version=3"}
    # A version that was not finished is not seen, and its number is used again.
    (tmp_path / "log" / "version=3" / "_SUCCESS").unlink()
    assert changes.versions(spark, log) == [1, 2]
    assert stamp(spark, log, ["d"]) == 3
    assert {r[0] for r in changes.changes(spark, log, "upload", 2).collect()} == {"d"}
    with pytest.raises(ValueError, match="not the name of a stage"):
        changes.changes(spark, log, "a/b")


def test_runs_read_only_changes(spark, tmp_path):
    log, seen = str(tmp_path / "log"), []
    index = PendingIndex(log, str(tmp_path / "home"))
    assert index.run(spark, builder(seen=seen)) == {"version": 0, "stamped": 0, "skipped": 0}
    stamp(spark, log, ["a", "b", "x", "empty"])
    assert index.run(spark, builder(["x"], seen)) == {"version": 1, "stamped": 3, "skipped": 1}
    # The index's own stamps are the only news: nothing is pending, nothing is built, no file is read.
    assert index.pending(spark).inputFiles() == [] or index.pending(spark).isEmpty()
    assert index.run(spark, builder(seen=seen)) == {"version": 2, "stamped": 0, "skipped": 0}
    assert index.run(spark, builder(seen=seen)) == {"version": 2, "stamped": 0, "skipped": 0}
    assert seen == [["a", "b", "empty", "x"]]
    assert shown(index, spark) == {("a", 0, 1), ("a", 1, 1), ("b", 0, 1), ("b", 1, 1)}
    assert [tuple(r) for r in index.skipped(spark).collect()] == [("x", "broken", 1)]
    stamps = {r[0] for r in changes.changes(spark, log, "fulltext").collect()}
    assert stamps == {"a", "b", "empty"}

    # A document that changes is built again, a skipped one too; one that fails now is no longer shown.
    stamp(spark, log, ["a", "x", "c"], at="2024-01-02")
    assert index.run(spark, builder(["a"], seen)) == {"version": 3, "stamped": 2, "skipped": 1}
    assert seen[1] == ["a", "c", "x"]
    assert shown(index, spark) == {(d, p, v) for d, v in (("b", 1), ("x", 3), ("c", 3)) for p in (0, 1)}
    assert [tuple(r) for r in index.skipped(spark).collect()] == [("a", "broken", 3)]


def test_a_run_that_breaks_off(spark, tmp_path):
    log, home = str(tmp_path / "log"), tmp_path / "home"
    index = PendingIndex(log, str(home))
    stamp(spark, log, ["a", "b"])

    def breaks(waiting):
        raise RuntimeError("stopped")

    with pytest.raises(RuntimeError):
        index.run(spark, breaks)
    assert index.position(spark) == 0
    assert index.run(spark, builder(["b"])) == {"version": 1, "stamped": 1, "skipped": 1}
    # As if the run had ended before its position was noted: what is stamped or skipped is not built again.
    shutil.rmtree(home / "_positions")
    seen = []
    assert index.run(spark, builder(seen=seen)) == {"version": 2, "stamped": 0, "skipped": 0}
    assert seen == []
    # As if it had ended between the stamps and the skip list: only the failed document comes again.
    shutil.rmtree(home / "_positions")
    shutil.rmtree(home / "skipped")
    assert index.run(spark, builder(["b"], seen)) == {"version": 2, "stamped": 0, "skipped": 1}
    assert seen == [["b"]]
    assert shown(index, spark) == {("a", 0, 1), ("a", 1, 1)}
