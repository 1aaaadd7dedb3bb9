"""Jobs, tasks and documents that wait, on a stream: keyed state with timers.

A lease runs out, a task takes too long or a document misses its deadline without an event of its own, so each key
sets a timer for the moment when something becomes true of it by silence alone. Timers follow the watermark
(``EventTime``: any other key's events move it on) or the clock (``ProcessingTime``). What is finished leaves the
state after ``retention`` seconds, so the state holds what is open and what has just ended.

Every change of a key is one row with ``change``, its running number, so the greatest one of a key is its state. How
many changes are seen depends on how events fall into batches; the last one depends on the events' own times only.
"""

from __future__ import annotations

import json
import pickle
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from .jobs import STATUS_AFTER

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
CHANGELOG = "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"
PARTITIONS = "spark.sql.shuffle.partitions"
IDLE_BATCHES = "spark.sql.streaming.noDataMicroBatches.enabled"
DAY = 86_400
FINISHED = ("succeeded", "failed")
SHARES = 4096  # of the keys; fixed, as the state is kept by them


class Waiting:
    """Keys that wait: a value each, timers that follow it, and rows for its changes.

    Keys are dealt over ``SHARES`` by their hash. The state of a share is one value, read and written once a batch,
    and its timer is the earliest of its keys'; events come to Python as one column, parsed a frame at a time.

    A subclass says how events change the value (``merged``), when to look at it again (``moments``), whether it is
    over and since when (``over_since``), and what to tell (``shown``; None for nothing new).
    """

    fields: tuple[str, ...] = ()  # of a value
    key = ""
    names: list[str] = []  # of the rows it gives
    event_time = True

    def __init__(self, retention: int):
        self.retention = retention * 1000

    def merged(self, value: dict, rows: Iterable[dict]) -> dict:
        raise NotImplementedError

    def moments(self, value: dict) -> list[int]:
        raise NotImplementedError

    def over_since(self, value: dict) -> int | None:
        raise NotImplementedError

    def shown(self, value: dict, now: int | None) -> tuple | None:
        raise NotImplementedError

    def _load(self, kept: tuple | None) -> dict:
        kept = kept or (*[None] * len(self.fields), None, 0, ())
        return dict(zip((*self.fields, "told", "change", "timers"), kept))

    def _keep(self, keys: dict, key, value: dict, now: int | None) -> Iterator[tuple]:
        told = self.shown(value, now)
        over = self.over_since(value)
        wanted = {over + self.retention} if over is not None else set(self.moments(value))
        passed = now if now is not None else -1
        value["timers"] = tuple(sorted(t for t in wanted if t > passed))
        if told is not None and repr(told) != value["told"]:
            value["told"], value["change"] = repr(told), value["change"] + 1
            yield (key, *told, value["change"])
        keys[key] = tuple(value.values())

    def _arrived(self, keys: dict, frames: Iterable[pd.DataFrame]) -> Iterator[tuple]:
        touched: dict = {}
        for frame in frames:
            for row in json.loads(f"[{','.join(frame['row'])}]"):
                name = row[self.key]
                if name not in touched:
                    touched[name] = self._load(keys.get(name))
                self.merged(touched[name], (row,))
        for name, value in touched.items():
            yield from self._keep(keys, name, value, None)

    def _expired(self, keys: dict, now: int) -> Iterator[tuple]:
        for name in [name for name, kept in keys.items() if kept[-1] and kept[-1][0] <= now]:
            value = self._load(keys[name])
            while value["timers"] and value["timers"][0] <= now:
                at, over = value["timers"][0], self.over_since(value)
                if over is not None and at >= over + self.retention:
                    del keys[name]
                    break
                yield from self._keep(keys, name, value, at)

    def __call__(self, share: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        now = state.getCurrentWatermarkMs() if self.event_time else state.getCurrentProcessingTimeMs()
        keys = pickle.loads(state.get[0]) if state.exists else {}
        rows = [] if state.hasTimedOut else list(self._arrived(keys, frames))
        rows.extend(self._expired(keys, now))
        if keys:
            state.update((pickle.dumps(keys, 5),))
            due = min((kept[-1][0] for kept in keys.values() if kept[-1]), default=None)
            # Spark calls when the clock is past the moment it is given, so it is given the one before.
            if due is not None and self.event_time:
                state.setTimeoutTimestamp(max(due - 1, 1))
            elif due is not None:
                state.setTimeoutDuration(max(due - 1 - now, 1))
        elif state.exists:
            state.remove()
        if rows:
            yield pd.DataFrame(rows, columns=self.names, dtype=object)


def _run(stream: DataFrame, key: str, processor: Waiting, out: str, event_time: bool, ts: str = "ts") -> DataFrame:
    """The processor's changes. Events travel as JSON and keys as strings, so that Python takes no value apart by type."""
    schema = T.StructType.fromDDL(out)
    processor.key, processor.names, processor.event_time = key, schema.names, event_time
    texts = T.StructType([T.StructField(f.name, T.StringType() if f.name == key else f.dataType) for f in schema])
    event = F.struct(F.col(key).cast("string").alias(key), *[c for c in stream.columns if c not in (key, ts)])
    rows = stream.select(
        F.pmod(F.xxhash64(key), F.lit(SHARES)).alias("_share"), ts, F.to_json(event, {"ignoreNullFields": "false"}).alias("row")
    )
    clock = GroupStateTimeout.EventTimeTimeout if event_time else GroupStateTimeout.ProcessingTimeTimeout

    def changes(share: tuple, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        return processor(share, frames, state)

    told = rows.groupBy("_share").applyInPandasWithState(changes, texts, "keys binary", "append", clock)
    return told.select(*[F.col(f.name).cast(f.dataType) for f in schema])


def timed(events: DataFrame, ts: str, delay: str) -> DataFrame:
    """Events with ``at``, their time in milliseconds, under a watermark; zone-less times are read in the session's zone."""
    events = events.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, delay)
    return events.withColumn("at", F.unix_millis(ts))


# ---------------------------------------------------------------- leases of jobs


class Leases(Waiting):
    fields = ("status", "s_at", "s_id", "attempts", "renewed", "last")

    def __init__(self, lease: int, retention: int):
        super().__init__(retention)
        self.lease = lease * 1000

    def merged(self, value: dict, rows: Iterable[dict]) -> dict:
        value["attempts"] = value["attempts"] or 0
        for r in rows:
            after = STATUS_AFTER.get(r["event"])
            if after and (value["s_at"] is None or (r["at"], r["event_id"]) > (value["s_at"], value["s_id"])):
                value["status"], value["s_at"], value["s_id"] = after, r["at"], r["event_id"]
            value["attempts"] += r["event"] == "claim"
            if r["event"] in ("claim", "heartbeat"):
                value["renewed"] = max(value["renewed"] or r["at"], r["at"])
            value["last"] = max(value["last"] or r["at"], r["at"])
        return value

    def until(self, value: dict) -> int | None:
        return value["renewed"] + self.lease if value["status"] == "running" else None

    def moments(self, value: dict) -> list[int]:
        until = self.until(value)
        return [] if until is None else [until + 1]  # the first moment after the lease

    def over_since(self, value: dict) -> int | None:
        return value["last"] if value["status"] in FINISHED else None

    def shown(self, value: dict, now: int | None) -> tuple:
        until = self.until(value)
        return value["status"], value["attempts"], until, until is not None and now is not None and until < now


def job_leases(
    events: DataFrame, lease_seconds: int = 300, retention: int = 7 * DAY, delay: str = "0 seconds", event_time: bool = True
) -> DataFrame:
    """Changes of jobs ``job_id, status, attempts, locked_until`` (ms) ``, expired, change`` from a stream of events.

    ``events`` has ``job_id, ts, event_id, event``. The status is that of ``jobs.job_status``; a running job whose lease
    is over is shown once more as expired, and again as not expired when it is renewed. Events later than the
    watermark are lost.
    """
    rows = timed(events, "ts", delay).select("job_id", "ts", "at", "event_id", "event")
    out = f"job_id {events.schema['job_id'].dataType.simpleString()}, status string, attempts long, locked_until long, expired boolean, change long"
    return _run(rows, "job_id", Leases(lease_seconds, retention), out, event_time)


# ---------------------------------------------------------------- limits of tasks


class Limits(Waiting):
    fields = ("submitted", "started", "over")

    def __init__(self, run: int, pending: int, retention: int):
        super().__init__(retention)
        self.run, self.pending = run * 1000, pending * 1000

    names_of = {"SUBMITTED": "submitted", "STARTED": "started", "SUCCESS": "over", "FAILURE": "over", "REVOKED": "over"}

    def merged(self, value: dict, rows: Iterable[dict]) -> dict:
        for r in rows:
            name = self.names_of.get(r["state"])
            if name:
                value[name] = min(value[name] if value[name] is not None else r["at"], r["at"])
        return value

    def moments(self, value: dict) -> list[int]:
        ends = ((value["submitted"], self.pending), (value["started"], self.run))
        return [at + limit for at, limit in ends if at is not None]

    def over_since(self, value: dict) -> int | None:
        return value["over"]

    def shown(self, value: dict, now: int | None) -> tuple | None:
        problem = None
        if value["over"] is None and now is not None:
            if value["submitted"] is not None and now >= value["submitted"] + self.pending:
                problem = "pending timeout"
            elif value["started"] is not None and now >= value["started"] + self.run:
                problem = "timeout"
        if problem is None and (value["over"] is None or value["told"] is None):
            return None  # nothing to take back
        return (problem,)


def task_limits(
    events: DataFrame,
    run_seconds: int = 800,
    pending_seconds: int = 5000,
    retention: int = 7 * DAY,
    delay: str = "0 seconds",
    event_time: bool = True,
) -> DataFrame:
    """Changes ``task_id, problem, change``: a problem when a limit passes, null when the task ends after all.

    ``events`` has ``task_id, ts, state``; states and problems are those of ``jobs.task_timeouts``.
    """
    rows = timed(events, "ts", delay).select("task_id", "ts", "at", "state")
    out = f"task_id {events.schema['task_id'].dataType.simpleString()}, problem string, change long"
    return _run(rows, "task_id", Limits(run_seconds, pending_seconds, retention), out, event_time)


# ---------------------------------------------------------------- documents that wait for their files


class Readiness(Waiting):
    # ``body`` has identity, entries, remote and files: what one manifest names, and what was seen of it.
    fields = ("since", "remote_at", "ended", "body")

    def __init__(self, wait: int, strict: bool, retention: int):
        super().__init__(retention)
        self.wait, self.strict = wait * 1000, strict

    def merged(self, value: dict, rows: Iterable[dict]) -> dict:
        if value["ended"] is not None:
            return value  # after the end only the verdict is kept
        if value["body"] is None:
            value["body"] = {"files": {}}
        body = value["body"]
        files = body["files"]
        for r in rows:
            if r["kind"] == "local" and (value["since"] is None or r["at"] < value["since"]):
                body["identity"], value["since"] = dict(r["identity"]), r["at"]
                entries = [tuple(e[c] for c in ("role", "name", "size", "sha256")) for e in r["entries"] or []]
                body["entries"] = sorted(entries, key=lambda e: (e[0] or "", e[1] or ""))
            elif r["kind"] == "remote" and (value["remote_at"] is None or r["at"] > value["remote_at"]):
                body["remote"], value["remote_at"] = dict(r["identity"]), r["at"]
            elif r["kind"] == "file" and r["name"] is not None and (r["name"] not in files or files[r["name"]][2] < r["at"]):
                files[r["name"]] = (r["size"], r["sha256"], r["at"])
        return value

    def moments(self, value: dict) -> list[int]:
        return [] if value["since"] is None else [value["since"] + self.wait]

    def over_since(self, value: dict) -> int | None:
        return value["ended"]

    def _error(self, value: dict) -> str | None:
        """What stands against the document before its deadline; later files and manifests do not count."""
        deadline, body = value["since"] + self.wait, value["body"]
        if value["remote_at"] is None or value["remote_at"] > deadline:
            return "S3_MANIFEST_MISSING"
        for field, mine in body["identity"].items():
            if body["remote"].get(field) != mine:
                return f"S3_MANIFEST_MISMATCH: {field}"
        for _, name, size, sha256 in body["entries"]:
            there = body["files"].get(name)
            if there is None or there[2] > deadline:
                return f"LOCAL_ARTIFACT_MISSING: {name}"
            if there[0] != size:
                return f"S3_ARTIFACT_MISMATCH: {name} size"
            if self.strict and (there[1] or "").lower() != (sha256 or "").lower():
                return f"S3_ARTIFACT_MISMATCH: {name} sha256"
        return None

    def shown(self, value: dict, now: int | None) -> tuple | None:
        if value["since"] is None:
            return None  # files that came before their document
        if value["ended"] is not None:
            return None  # what was said stands
        error, deadline = self._error(value), value["since"] + self.wait
        final = error is not None and (error.startswith("S3_MANIFEST_MISMATCH") or error.endswith(" sha256"))
        late = now is not None and now >= deadline
        if error is None or final or late:
            value["ended"], value["body"] = max(value["since"], now or 0), None
        if error is None:
            return "ready", None
        if final:
            return "failed", error
        return ("failed", f"S3_NOT_READY_AFTER_TIMEOUT: {error}") if late else ("waiting", error)


HAPPENED = {
    "kind": "string",
    "identity": "map<string,string>",
    "entries": "array<struct<role:string,name:string,size:bigint,sha256:string>>",
    "name": "string",
    "size": "bigint",
    "sha256": "string",
}


def awaited(local: DataFrame, remote: DataFrame, files: DataFrame, fields: list[str], ts: str = "ts") -> DataFrame:
    """One stream of what happens to documents, for ``ready_when_complete``.

    ``local``: ``document_id, ts``, identity ``fields`` and ``entries`` (array of role, name, size, sha256);
    ``remote``: ``document_id, ts`` and the fields; ``files``: ``document_id, ts, name, size, sha256`` as listings show
    them, repeats included.
    """

    def told(df: DataFrame, kind: str, **given: Column) -> DataFrame:
        columns = {"kind": F.lit(kind), **given}
        return df.select("document_id", ts, *[columns.get(c, F.lit(None)).cast(t).alias(c) for c, t in HAPPENED.items()])

    identity = F.create_map(*[x for f in fields for x in (F.lit(f), F.col(f).cast("string"))])
    rows = told(local, "local", identity=identity, entries=F.col("entries"))
    rows = rows.unionByName(told(remote, "remote", identity=identity))
    return rows.unionByName(told(files, "file", **{c: F.col(c) for c in ("name", "size", "sha256")}))


def ready_when_complete(
    happened: DataFrame,
    wait_seconds: int = 900,
    strict: bool = False,
    retention: int = 7 * DAY,
    delay: str = "0 seconds",
    event_time: bool = True,
    ts: str = "ts",
) -> DataFrame:
    """Changes ``document_id, state, error, change``: waiting, then ready or failed, from the stream of ``awaited``.

    A document waits until every file of its manifest is there in the right size (``strict``: with the right
    digest) and the remote manifest agrees; each arrival is looked at when it comes. What cannot be cured fails at
    once, what is not complete at the deadline fails then. Files may come before their document.
    """
    rows = timed(happened, ts, delay).where("document_id is not null")
    kind = happened.schema["document_id"].dataType.simpleString()
    out = f"document_id {kind}, state string, error string, change long"
    return _run(rows, "document_id", Readiness(wait_seconds, strict, retention), out, event_time, ts)


# ---------------------------------------------------------------- running


def publish_changes(changes: DataFrame, out: str, checkpoint: str, more_follows: bool = False, **trigger):
    """Start a stream of changes that appends them to ``out``; state lives in RocksDB, as it may exceed the memory.

    A batch uploads its changes of the state, not the whole of it. Each partition of the state costs every batch a
    worker and a commit, so there are no more than two a core; the checkpoint keeps their number. With ``more_follows``
    the timers that the last batch has made due wait for the next one, in this run or another.
    """
    spark = changes.sparkSession
    partitions = min(int(spark.conf.get(PARTITIONS)), 2 * spark.sparkContext.defaultParallelism)
    settings = {PROVIDER: ROCKSDB, CHANGELOG: "true", PARTITIONS: str(partitions), IDLE_BATCHES: str(not more_follows).lower()}
    before = {name: spark.conf.get(name, None) for name in settings}
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        writer = changes.writeStream.outputMode("append").format("parquet").option("path", out)
        return writer.option("checkpointLocation", checkpoint).trigger(**(trigger or {"availableNow": True})).start()
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def latest_changes(changes: DataFrame, key: str) -> DataFrame:
    """The last change of each key."""
    rest = [c for c in changes.columns if c != key]
    last = changes.groupBy(key).agg(F.max_by(F.struct(*rest), "change").alias("_last"))
    return last.select(key, "_last.*").drop("change")

