"""Jobs, tasks and documents whose state changes by silence, batch by batch."""

import time

import pytest
from pyspark.sql import functions as F

from chunkloom.streaming import timers

HOUR = "2024-01-01 00:"


class Feed:
    """A stream that takes one given frame a batch, and the changes it published."""

    def __init__(self, spark, folder, schema):
        self.spark, self.folder, self.schema, self.n = spark, folder, schema, 0

    def stream(self):
        reader = self.spark.readStream.schema(self.schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1)
        return reader.parquet(f"{self.folder}/in")

    def add(self, df):
        df.coalesce(1).write.parquet(f"{self.folder}/in/{self.n}")
        self.n += 1

    def run(self, changes):
        """Everything that is there, and the number of keys left in the state."""
        query = timers.publish_changes(changes, f"{self.folder}/out", f"{self.folder}/state")
        query.awaitTermination()
        rows = self.spark.read.schema(changes.schema).parquet(f"{self.folder}/out").collect()
        return sorted(map(tuple, rows), key=str), query.lastProgress["stateOperators"][0]["numRowsTotal"]


@pytest.fixture
def events(spark):
    schema = "job_id long, ts timestamp, event_id long, event string"

    def make(*rows):
        df = spark.createDataFrame([(j, HOUR + t, i, e) for j, t, i, e in rows], "job_id long, t string, event_id long, event string")
        return df.select("job_id", F.col("t").cast("timestamp").alias("ts"), "event_id", "event")

    make.schema = schema
    return make


def test_a_silent_job_loses_its_lease(spark, tmp_path, events):
    feed = Feed(spark, tmp_path, events.schema)
    (tmp_path / "in").mkdir()

    def state():
        rows, kept = feed.run(timers.job_leases(feed.stream(), 300, retention=60))
        last = {}
        for job, status, attempts, until, expired, change in sorted(rows, key=lambda r: (r[0], r[-1])):
            last[job] = (status, attempts, expired)
        return last, kept

    feed.add(events((1, "00:00", 1, "submit"), (1, "00:10", 3, "claim"), (2, "00:05", 2, "claim")))
    assert state()[0] == {1: ("running", 1, False), 2: ("running", 1, False)}
    # Job 2 goes on; job 1 says nothing and is found by the clock of the others.
    feed.add(events((2, "05:20", 4, "heartbeat")))
    assert state()[0] == {1: ("running", 1, True), 2: ("running", 1, False)}
    # It is taken up again; job 2 ends, and leaves the state a minute later.
    feed.add(events((1, "05:30", 5, "claim"), (2, "05:40", 6, "complete")))
    last, kept = state()
    assert last == {1: ("running", 2, False), 2: ("succeeded", 1, False)}
    feed.add(events((1, "07:00", 7, "heartbeat")))
    last, after = state()
    assert last == {1: ("running", 2, False), 2: ("succeeded", 1, False)} and after < kept


def test_leases_do_not_depend_on_the_order_within_a_batch(spark, tmp_path, events):
    feed = Feed(spark, tmp_path, events.schema)
    feed.add(events((1, "00:20", 3, "complete"), (1, "00:00", 1, "submit"), (1, "00:10", 2, "claim"), (1, "00:20", 2, "claim")))
    rows, _ = feed.run(timers.job_leases(feed.stream()))
    assert [r[1:3] for r in rows] == [("succeeded", 2)]


def test_silent_tasks_time_out_and_late_ends_take_it_back(spark, tmp_path):
    schema = "task_id string, ts timestamp, state string"
    feed = Feed(spark, tmp_path, schema)

    def add(*rows):
        df = spark.createDataFrame([(k, HOUR + t, s) for k, t, s in rows], "task_id string, t string, state string")
        feed.add(df.select("task_id", F.col("t").cast("timestamp").alias("ts"), "state"))

    add(("a", "00:00", "SUBMITTED"), ("a", "00:10", "STARTED"), ("b", "00:00", "SUBMITTED"), ("c", "00:00", "STARTED"))
    add(("c", "01:00", "SUCCESS"), ("d", "02:00", "SUBMITTED"))
    add(("d", "05:30", "PENDING"))
    feed.run(timers.task_limits(feed.stream(), run_seconds=100, pending_seconds=300))
    add(("a", "06:00", "FAILURE"))
    rows, _ = feed.run(timers.task_limits(feed.stream(), run_seconds=100, pending_seconds=300))
    changes = {}
    for task, problem, change in rows:
        changes.setdefault(task, {})[change] = problem
    # Both limits of a pass at 5:30 at the latest; c ended in time, d was given 300 seconds from 2:00.
    assert [changes["a"][i] for i in sorted(changes["a"])][-1] is None
    assert "pending timeout" in changes["a"].values() and "timeout" in changes["a"].values()
    assert list(changes["b"].values()) == ["pending timeout"] and "c" not in changes and "d" not in changes


HAPPENED = (
    "document_id long, ts timestamp, kind string, identity map<string,string>, "
    "entries array<struct<role:string,name:string,size:bigint,sha256:string>>, name string, size bigint, sha256 string"
)


def happened(spark, at, local=(), remote=(), files=()):
    """Rows of ``awaited`` at one time: (id, version, entries), (id, version), (id, name, size, sha256)."""
    ts = F.lit(HOUR + at).cast("timestamp").alias("ts")
    entry = "document_id long, version int, entries array<struct<role:string,name:string,size:bigint,sha256:string>>"
    return timers.awaited(
        spark.createDataFrame(list(local), entry).select("*", ts),
        spark.createDataFrame(list(remote), "document_id long, version int").select("*", ts),
        spark.createDataFrame(list(files), "document_id long, name string, size long, sha256 string").select("*", ts),
        ["version"],
    )


@pytest.mark.parametrize("strict", [False, True])
def test_documents_wait_for_their_files(spark, tmp_path, strict):
    feed = Feed(spark, tmp_path, HAPPENED)
    two = [("a", "x.json", 10, "AB"), ("b", "y.json", 20, "cd")]
    feed.add(happened(spark, "00:00", [(i, 1, two) for i in (1, 2, 3, 4)] + [(5, 1, [])], [(i, 1) for i in (1, 2, 5)] + [(3, 2)], [(1, "x.json", 10, "ab")]))
    feed.add(happened(spark, "01:00", files=[(2, "x.json", 10, "ab"), (2, "y.json", 21, "cd"), (6, "x.json", 10, "ab")]))
    feed.add(happened(spark, "02:00", files=[(1, "y.json", 20, "ff"), (2, "y.json", 21, "cd")]))
    # The last file of 2 comes three batches after its document; that of 4 comes after the deadline.
    feed.add(happened(spark, "03:00", files=[(2, "y.json", 20, "cd")]))
    feed.add(happened(spark, "06:00", remote=[(4, 1)], files=[(4, "x.json", 10, "ab"), (4, "y.json", 20, "cd")]))
    rows, _ = feed.run(timers.ready_when_complete(feed.stream(), 300, strict))
    seen = {}
    for doc, state, error, change in sorted(rows, key=lambda r: (r[0], r[-1])):
        seen.setdefault(doc, []).append((state, error))
    missing = "LOCAL_ARTIFACT_MISSING: "
    assert seen[1][0] == ("waiting", f"{missing}y.json")
    assert seen[1][-1] == (("failed", "S3_ARTIFACT_MISMATCH: y.json sha256") if strict else ("ready", None))
    assert seen[2] == [("waiting", f"{missing}x.json"), ("waiting", "S3_ARTIFACT_MISMATCH: y.json size"), ("ready", None)]
    assert seen[3] == [("failed", "S3_MANIFEST_MISMATCH: version")]
    assert seen[4] == [("waiting", "S3_MANIFEST_MISSING"), ("failed", "S3_NOT_READY_AFTER_TIMEOUT: S3_MANIFEST_MISSING")]
    assert seen[5] == [("ready", None)] and 6 not in seen


def test_the_clock_can_be_the_wall(spark, tmp_path):
    """With processing time a lease ends although the stream brings nothing more."""
    feed = Feed(spark, tmp_path, "job_id long, ts timestamp, event_id long, event string")
    feed.add(spark.range(1).select(F.col("id").alias("job_id"), F.current_timestamp().alias("ts"), F.lit(1).cast("long").alias("event_id"), F.lit("claim").alias("event")))
    changes = timers.job_leases(feed.stream(), 3, event_time=False)
    query = timers.publish_changes(changes, f"{tmp_path}/out", f"{tmp_path}/state", processingTime="1 second")
    try:
        for _ in range(60):
            time.sleep(1)
            rows = spark.read.schema(changes.schema).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/out").collect() if (tmp_path / "out").exists() else []
            if any(r["expired"] for r in rows):
                break
        assert [r["expired"] for r in sorted(rows, key=lambda r: r["change"])][-1] is True
    finally:
        query.stop()


def test_the_state_has_a_value_and_a_timer_a_share(spark, tmp_path, monkeypatch):
    """Reads and writes of the state do not grow with the keys, and a limit counts from its very moment."""
    monkeypatch.setattr(timers, "SHARES", 3)
    feed = Feed(spark, tmp_path, "task_id long, ts timestamp, state string")
    start = F.lit(HOUR + "00:00").cast("timestamp").alias("ts")
    feed.add(spark.range(500).select(F.col("id").alias("task_id"), start, F.lit("STARTED").alias("state")))
    last = F.lit(HOUR + "01:40").cast("timestamp").alias("ts")
    feed.add(spark.range(1).select(F.lit(999).cast("long").alias("task_id"), last, F.lit("STARTED").alias("state")))
    rows, kept = feed.run(timers.task_limits(feed.stream(), run_seconds=100))
    assert sorted(r[:2] for r in rows) == [(i, "timeout") for i in range(500)]
    assert kept <= 3 * 3


def test_slices_of_many_files_arrive_in_order(spark):
    """Every slice is one micro-batch, whatever the number of its files, so that no row comes late."""
    from chunkloom.catalog import states

    rows = spark.range(0, 4000, 1, 5).select(
        (F.col("id") % 1000).alias("task_id"),
        (F.lit(1_700_000_000) + F.col("id")).cast("timestamp").alias("ts"),
        F.when(F.col("id") < 1000, "STARTED").when(F.col("id") >= 3500, "SUCCESS").otherwise("PENDING").alias("state"),
    )
    stream, folder, parts = states._arriving(rows, "ts")
    changes = timers.task_limits(stream, 2600, retention=400 * timers.DAY)
    last = states._last_changes(spark, changes, folder, parts, "task_id")
    files = spark.read.option("recursiveFileLookup", "true").parquet(f"{folder}/in").select(F.input_file_name().alias("f"))
    assert files.distinct().count() > 4
    # Tasks 0 to 499 never end; 500 to 999 end late, which takes their problem back.
    assert sorted(map(tuple, last.where("problem is not null").collect())) == [(i, "timeout") for i in range(500)]


def test_events_reach_python_as_one_column(spark, tmp_path):
    """Whatever they consist of: share, time and the event, so that no value is taken apart by itself."""
    (tmp_path / "in").mkdir()
    changes = timers.ready_when_complete(Feed(spark, tmp_path, HAPPENED).stream())
    plan = changes._jdf.queryExecution().analyzed().toString().split("\n")
    below = next(line for line in plan[[i for i, line in enumerate(plan) if "_share" in line][-1] :])
    assert "to_json" in below and below.count(" AS ") == 2


def test_a_deadline_passes_when_the_clock_shows_it(spark, tmp_path):
    """Also for keys that are no strings or whole numbers, and names with any character."""
    feed = Feed(spark, tmp_path, HAPPENED.replace("document_id long", "document_id decimal(10,2)"))
    kind = F.col("document_id").cast("decimal(10,2)")

    def add(at, *rows, **more):
        feed.add(happened(spark, at, *rows, **more).withColumn("document_id", kind))

    odd = 'q"\\ \nä\U0001f600,'
    add("00:00", [(1, 1, [("a", odd, 10, None)]), (2, 1, [("a", odd, 2**60 + 1, None)])], [(1, 1), (2, 1)])
    add("04:59.999", files=[(2, odd, 2**60 + 1, None), (3, "x", 1, None)])
    rows, _ = feed.run(timers.ready_when_complete(feed.stream(), 300))
    assert not any(r[1] == "failed" for r in rows) and max((r[3], r[1]) for r in rows if r[0] == 2)[1] == "ready"
    add("05:00", files=[(3, "x", 1, None)])
    rows, _ = feed.run(timers.ready_when_complete(feed.stream(), 300))
    assert [(str(r[0]), r[2]) for r in rows if r[1] == "failed"] == [("1.00", f"S3_NOT_READY_AFTER_TIMEOUT: LOCAL_ARTIFACT_MISSING: {odd}")]
