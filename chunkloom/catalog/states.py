"""Queries on job events: users stand for jobs, event types for what happened to them."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import aggregates, merging
from ..session import shared_dir
from ..streaming import documents, jobs, timers
from .registry import query, table

_EVENT = """CASE event_type WHEN 'signup' THEN 'submit' WHEN 'click' THEN 'claim' WHEN 'view' THEN 'heartbeat'
  WHEN 'purchase' THEN 'complete' WHEN 'error' THEN 'fail' END"""


def job_events(events):
    kind = F.col("event_type")
    event = (
        F.when(kind == "signup", F.lit("submit"))
        .when(kind == "click", F.lit("claim"))
        .when(kind == "view", F.lit("heartbeat"))
        .when(kind == "purchase", F.lit("complete"))
        .when(kind == "error", F.lit("fail"))
    )
    return events.select(F.col("user_id").alias("job_id"), "ts", "event_id", event.alias("event"))


_STATUS = f"""k AS (SELECT user_id AS job_id, ts, event_id, {_EVENT} AS event FROM events),
s AS (SELECT job_id, arg_max(CASE event WHEN 'submit' THEN 'queued' WHEN 'claim' THEN 'running'
      WHEN 'complete' THEN 'succeeded' ELSE 'failed' END, event_id) FILTER (event <> 'heartbeat') AS status,
    count(*) FILTER (event = 'claim') AS attempts,
    max(ts) FILTER (event IN ('claim', 'heartbeat')) AS renewed, max(ts) AS last_ts FROM k GROUP BY job_id),
j AS (SELECT job_id, status, attempts, CASE WHEN status = 'running' THEN renewed + INTERVAL 300 SECOND END AS locked_until,
    last_ts FROM s)"""

_SHOWN = """job_id, status, attempts, strftime(locked_until, '%Y-%m-%d %H:%M:%S') AS locked_until,
  strftime(last_ts, '%Y-%m-%d %H:%M:%S') AS last_ts"""


def _shown(state):
    times = [F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(c) for c in ("locked_until", "last_ts")]
    return state.select("job_id", "status", "attempts", *times)


@query(f"WITH {_STATUS} SELECT {_SHOWN} FROM j")
def job_status(spark, sf):
    return _shown(jobs.job_status(job_events(table(spark, sf, "events"))))


@query(f"WITH {_STATUS} SELECT {_SHOWN} FROM j")
def job_status_stream(spark, sf):
    """The same state kept by a stream over the file; the last state published per job counts."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    stream = documents.read_new_files(spark, sf, schema, "events.parquet")
    state = jobs.job_status(job_events(stream))
    run = documents.publish_batches(state, lambda batch: batch, f"{folder}/out", f"{folder}/state", "update")
    run.awaitTermination()
    latest = merging.latest_per_key(documents.current_rows(spark, f"{folder}/out"), ["job_id"], "batch")
    return _shown(latest)


@query(
    """SELECT doc_id, len(string_split(text, chr(10))) AS n_elements FROM documents"""
)
def stream_new_documents(spark, sf):
    """New files taken once and turned into elements batch by batch."""
    from ..sources.readers import lines_to_elements

    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    schema = table(spark, sf, "documents").schema
    stream = documents.read_new_files(spark, sf, schema, "documents.parquet")
    run = documents.publish_batches(stream, lines_to_elements, f"{folder}/out", f"{folder}/state")
    run.awaitTermination()
    return documents.current_rows(spark, f"{folder}/out").groupBy("doc_id").agg(F.count("*").alias("n_elements"))


@query(f"WITH {_STATUS} SELECT job_id FROM j WHERE status = 'running' AND locked_until < (SELECT max(ts) FROM events)")
def expired_leases(spark, sf):
    events = table(spark, sf, "events")
    now = events.agg(F.max("ts")).scalar()
    return jobs.expired_leases(jobs.job_status(job_events(events)), now).select("job_id")


_RUN = "user_id || '_' || strftime(ts, '%Y%m%d%H')"


def _run_id():
    return F.concat_ws("_", F.col("user_id").cast("string"), F.date_format("ts", "yyyyMMddHH"))


def _attempts(spark, sf):
    failed = F.col("event_type").isin("error", "click")
    text = F.when(F.col("value") > 20, F.lit("parser http error 503: x")).otherwise(F.lit("EMPTY_RESULT"))
    return table(spark, sf, "events").select(
        _run_id().alias("doc_id"),
        F.col("event_id").alias("at"),
        F.when(failed, F.lit("parser")).alias("error_class"),
        F.when(failed, text).alias("error"),
    )


_ATTEMPTS = f"""a AS (SELECT {_RUN} AS doc_id, event_id, event_type IN ('error', 'click') AS failed,
    CASE WHEN value > 20 THEN 'parser http error 503: x' ELSE 'EMPTY_RESULT' END AS msg FROM events),
g AS (SELECT doc_id, count(*) AS attempts, bool_or(NOT failed) AS done, arg_max(msg, event_id) FILTER (failed) AS msg
  FROM a GROUP BY doc_id),
d AS (SELECT *, CASE WHEN done THEN 'done' WHEN attempts < 3 AND msg <> 'EMPTY_RESULT' THEN 'retry' ELSE 'dead' END AS decision FROM g)"""


@query(
    f"""WITH {_ATTEMPTS} SELECT doc_id, attempts, decision,
  CASE WHEN decision = 'retry' THEN CAST(2 ** (attempts - 1) AS DOUBLE) END AS wait_seconds,
  CASE WHEN decision <> 'done' THEN msg END AS error FROM d"""
)
def retry_and_dead_letter(spark, sf):
    return jobs.retry_and_dead_letter(_attempts(spark, sf))


@query(
    f"""WITH {_ATTEMPTS} SELECT decision AS status, count(*) AS n_items, CAST(sum(attempts) AS BIGINT) AS n_attempts,
  count(*) FILTER (decision <> 'done') AS n_errors FROM d GROUP BY decision"""
)
def run_summary(spark, sf):
    results = jobs.retry_and_dead_letter(_attempts(spark, sf)).withColumnRenamed("decision", "status")
    return aggregates.run_summary(results)


@query(f"WITH {_ATTEMPTS} SELECT doc_id, attempts, msg AS error FROM d WHERE decision <> 'done'")
def run_errors(spark, sf):
    return aggregates.run_errors(jobs.retry_and_dead_letter(_attempts(spark, sf)))


@query(
    f"""WITH k AS (SELECT {_RUN} AS task_id, CAST(floor(epoch(ts)) AS BIGINT) AS sec, event_type FROM events),
t AS (SELECT task_id, min(sec) FILTER (event_type = 'signup') AS submitted, min(sec) FILTER (event_type = 'click') AS started,
    bool_or(event_type = 'purchase') AS over FROM k GROUP BY task_id),
n AS (SELECT max(sec) AS now FROM k),
p AS (SELECT task_id, CASE WHEN now - submitted >= 500000 THEN 'pending timeout'
    WHEN now - started >= 80000 THEN 'timeout' END AS problem FROM t, n WHERE NOT over)
SELECT task_id, problem FROM p WHERE problem IS NOT NULL"""
)
def task_timeouts(spark, sf):
    from ..functions.dates import wall_epoch

    kind = F.col("event_type")
    state = (
        F.when(kind == "signup", F.lit("SUBMITTED"))
        .when(kind == "click", F.lit("STARTED"))
        .when(kind == "purchase", F.lit("SUCCESS"))
        .otherwise(F.lit("PENDING"))
    )
    tasks = table(spark, sf, "events").select(_run_id().alias("task_id"), wall_epoch(F.col("ts")).alias("at"), state.alias("state"))
    now = tasks.agg(F.max("at")).scalar()
    return jobs.task_timeouts(tasks, now, 80000, 500000)


@query(
    """SELECT user_id, event_type, min(event_id) AS event_id FROM events GROUP BY ALL"""
)
def dedupe_wakeups(spark, sf):
    """One wake-up per job and type, the first."""
    events = table(spark, sf, "events").select("user_id", "event_type", "ts", "event_id")
    return jobs.dedupe_wakeups(events, ["user_id", "event_type"]).drop("ts")


@query("SELECT event_id AS msg_id, CASE WHEN event_type = 'error' THEN 'archive' ELSE 'keep' END AS action FROM events")
def claim_disposition(spark, sf):
    claims = table(spark, sf, "events").select(
        F.col("event_id").alias("msg_id"), (F.col("event_type") == "error").alias("archive_current_message")
    )
    return jobs.claim_disposition(claims)


@query("SELECT DISTINCT user_id, event_type FROM events")
def dedupe_wakeups_stream(spark, sf):
    """The same on a stream: repeats within the watermark are dropped."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    schema = table(spark, sf, "events").schema
    stream = documents.read_new_files(spark, sf, schema, "events.parquet")
    first = jobs.dedupe_wakeups(stream, ["user_id", "event_type"], delay="400 days")
    run = documents.publish_batches(first, lambda batch: batch, f"{folder}/out", f"{folder}/state")
    run.awaitTermination()
    return documents.current_rows(spark, f"{folder}/out").select("user_id", "event_type")


def _arriving(rows, ts, slices=4):
    """The rows as a stream, the folder of its results and the slices that are to arrive, in the order of ``ts``."""
    spark = rows.sparkSession
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    rows.write.parquet(f"{folder}/rows")  # once, as each slice reads them
    rows = spark.read.schema(rows.schema).parquet(f"{folder}/rows")
    first, last = rows.agg(F.min(F.unix_seconds(ts)), F.max(F.unix_seconds(ts))).first()
    width = (last - first) // slices + 1
    parts = [rows.where(F.floor((F.unix_seconds(ts) - first) / width) == i) for i in range(slices)]
    rows.limit(0).write.parquet(f"{folder}/in/none")  # a stream needs its folder
    stream = spark.readStream.schema(rows.schema).option("recursiveFileLookup", "true").parquet(f"{folder}/in")
    return stream, folder, parts


def _last_changes(spark, changes, folder, parts, key):
    """The stream taken up again for each slice, which is one micro-batch of as many files as were written."""
    for i, part in enumerate(parts):
        part.write.parquet(f"{folder}/in/{i}")
        timers.publish_changes(changes, f"{folder}/out", f"{folder}/state", i + 1 < len(parts)).awaitTermination()
    return timers.latest_changes(spark.read.schema(changes.schema).parquet(f"{folder}/out"), key)


@query(
    f"""WITH {_STATUS}, n AS (SELECT date_trunc('millisecond', max(ts)) AS now FROM events)
SELECT job_id, status, attempts, status = 'running' AND date_trunc('millisecond', locked_until) < now AS expired FROM j, n"""
)
def job_leases_stream(spark, sf):
    """Leases that end by silence: timers of a stream, whose clock is the other jobs' events."""
    events = job_events(table(spark, sf, "events")).withColumn("ts", F.col("ts").cast("timestamp"))
    stream, folder, parts = _arriving(events, "ts")
    changes = timers.job_leases(stream, retention=400 * timers.DAY)
    return _last_changes(spark, changes, folder, parts, "job_id").drop("locked_until")


@query(
    f"""WITH k AS (SELECT {_RUN} AS task_id, CAST(epoch_ms(ts) AS BIGINT) AS ms, event_type FROM events),
t AS (SELECT task_id, min(ms) FILTER (event_type = 'signup') AS submitted, min(ms) FILTER (event_type = 'click') AS started,
    bool_or(event_type = 'purchase') AS over FROM k GROUP BY task_id),
n AS (SELECT max(ms) AS now FROM k),
p AS (SELECT task_id, CASE WHEN now - submitted >= 500000000 THEN 'pending timeout'
    WHEN now - started >= 80000000 THEN 'timeout' END AS problem FROM t, n WHERE NOT over)
SELECT task_id, problem FROM p WHERE problem IS NOT NULL"""
)
def task_limits_stream(spark, sf):
    """The limits of ``task_timeouts`` kept by timers, with no ``now`` given from outside."""
    kind = F.col("event_type")
    state = (
        F.when(kind == "signup", F.lit("SUBMITTED"))
        .when(kind == "click", F.lit("STARTED"))
        .when(kind == "purchase", F.lit("SUCCESS"))
        .otherwise(F.lit("PENDING"))
    )
    events = table(spark, sf, "events").select(_run_id().alias("task_id"), F.col("ts").cast("timestamp").alias("ts"), state.alias("state"))
    stream, folder, parts = _arriving(events, "ts")
    changes = timers.task_limits(stream, 80_000, 500_000, retention=400 * timers.DAY)
    return _last_changes(spark, changes, folder, parts, "task_id").where("problem is not null")


# Orders stand for documents, their lines for files; a file is seen on its shipping date, some in another size.
_WAITING = """d AS (SELECT o_orderkey AS document_id, o_orderdate::DATE AS since, o_orderdate::DATE + 900 AS deadline FROM orders),
f AS (SELECT l_orderkey AS document_id, (l_linenumber % 3)::VARCHAR AS role, 'part-' || l_linenumber AS name,
    min(l_shipdate)::DATE AS seen, min(l_quantity) >= 45 AS other FROM lineitem GROUP BY l_orderkey, l_linenumber),
n AS (SELECT max(day) AS now FROM (SELECT since AS day FROM d UNION ALL SELECT since + 2 FROM d UNION ALL SELECT seen FROM f)),
e AS (SELECT document_id, role, name, CASE WHEN seen > deadline THEN 'LOCAL_ARTIFACT_MISSING: ' || name
    WHEN other THEN 'S3_ARTIFACT_MISMATCH: ' || name || ' size' END AS error FROM f JOIN d USING (document_id)),
g AS (SELECT document_id, arg_min(error, (role, name)) FILTER (error IS NOT NULL) AS error FROM e GROUP BY document_id),
v AS (SELECT d.document_id, d.deadline, CASE WHEN d.document_id % 97 = 0 THEN 'S3_MANIFEST_MISMATCH: version' ELSE g.error END AS error,
    d.document_id % 97 = 0 AS final FROM d LEFT JOIN g USING (document_id))"""


@query(
    f"""WITH {_WAITING} SELECT document_id,
  CASE WHEN error IS NULL THEN 'ready' WHEN final OR now >= deadline THEN 'failed' ELSE 'waiting' END AS state,
  CASE WHEN error IS NULL OR final OR now < deadline THEN error ELSE 'S3_NOT_READY_AFTER_TIMEOUT: ' || error END AS error
FROM v, n WHERE final OR error IS NULL OR now >= deadline"""
)
def ready_waiting_stream(spark, sf):
    """Documents wait over micro-batches for files that listings show later; the deadline comes by itself."""
    orders, lines = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    name = F.concat(F.lit("part-"), F.col("l_linenumber"))
    lines = lines.groupBy(F.col("l_orderkey").alias("document_id"), (F.col("l_linenumber") % 3).cast("string").alias("role"), name.alias("name")).agg(
        F.min(F.col("l_shipdate").cast("date")).cast("timestamp").alias("ts"), F.min("l_partkey").cast("long").alias("size"),
        (F.min("l_quantity") >= 45).cast("long").alias("more"), F.lit(None).cast("string").alias("sha256"),
    )
    entries = lines.groupBy("document_id").agg(F.collect_list(F.struct("role", "name", "size", "sha256")).alias("entries"))
    since = F.col("o_orderdate").cast("date")
    docs = orders.select(F.col("o_orderkey").alias("document_id"), since.cast("timestamp").alias("ts"), F.lit(1).alias("version"))
    remote = docs.select(
        "document_id", (F.col("ts") + F.expr("interval 2 days")).alias("ts"), F.when(F.col("document_id") % 97 == 0, 2).otherwise(1).alias("version")
    )
    files = lines.withColumn("size", F.col("size") + F.col("more"))
    happened = timers.awaited(docs.join(entries, "document_id", "left"), remote, files, ["version"])
    stream, folder, parts = _arriving(happened, "ts")
    changes = timers.ready_when_complete(stream, 900 * timers.DAY, retention=4000 * timers.DAY)
    return _last_changes(spark, changes, folder, parts, "document_id").where("state <> 'waiting'")


@query("SELECT o_orderkey AS document_id, CASE WHEN o_orderstatus = 'P' THEN 'waiting' ELSE 'ready' END AS state FROM orders")
def ready_stream(spark, sf):
    """Finished documents arrive as a stream; those whose remote manifest is there are ready."""
    folder = f"{shared_dir(spark)}/{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders")
    remote = orders.filter("o_orderstatus <> 'P'").select(F.col("o_orderkey").alias("document_id"), F.lit(1).alias("document_version"))
    files = table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("doc_id"), F.lit("r").alias("role"), F.lit("n").alias("name"), F.lit(1).alias("size")
    ).distinct()

    def check(batch):
        local = batch.select(F.col("o_orderkey").alias("document_id"), F.lit(1).alias("document_version"))
        return jobs.ready_when_published(local, remote, files, files.drop("role"), F.lit(False))

    stream = documents.read_new_files(spark, sf, orders.schema, "orders.parquet")
    documents.publish_batches(stream, check, f"{folder}/out", f"{folder}/state").awaitTermination()
    return documents.current_rows(spark, f"{folder}/out").select("document_id", "state")
