"""State of jobs and tasks from their events.

The same functions take a stream or a table. They use aggregates that combine on the map side, so a job
with very many events does not send them all to one task, and the state per job is one row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import status as st
from ..operators.joins import compare_manifests, verify_artifacts

# The status a job has after each event; other events leave it unchanged.
STATUS_AFTER = {
    "submit": "queued",
    "claim": "running",
    "complete": "succeeded",
    "fail": "failed",
}


def _status_after(event: Column) -> Column:
    status = F.lit(None).cast("string")
    for name, after in STATUS_AFTER.items():
        status = F.when(event == name, F.lit(after)).otherwise(status)
    return status


def job_status(events: DataFrame, lease_seconds: int = 300) -> DataFrame:
    """Latest status per job. Input ``job_id, ts, event_id, event``.

    Output ``job_id, status, attempts, locked_until, last_ts``; a claim or heartbeat renews the lease.
    """
    at = F.struct("ts", "event_id")
    status = _status_after(F.col("event"))
    renewed = F.when(F.col("event").isin("claim", "heartbeat"), F.col("ts"))
    state = events.groupBy("job_id").agg(
        F.max_by(status, F.when(status.isNotNull(), at)).alias("status"),
        F.count_if(F.col("event") == "claim").alias("attempts"),
        F.max(renewed).alias("_renewed"),
        F.max("ts").alias("last_ts"),
    )
    lease = F.when(F.col("status") == "running", F.col("_renewed") + F.make_dt_interval(secs=F.lit(lease_seconds)))
    return state.select("job_id", "status", "attempts", lease.alias("locked_until"), "last_ts")


def expired_leases(jobs: DataFrame, now: Column) -> DataFrame:
    """Running jobs whose lease is missing or over."""
    return jobs.filter(
        (F.col("status") == "running") & (F.col("locked_until").isNull() | (F.col("locked_until") < now))
    )


def retry_and_dead_letter(results: DataFrame, max_attempts: int = 3) -> DataFrame:
    """What to do next with each item.

    Input: one row per attempt ``doc_id, at, error_class, error`` (no error: success). Output
    ``doc_id, attempts, decision, wait_seconds, error``; decision is done, retry or dead.
    """
    failed = F.col("error").isNotNull()
    last = F.max_by(F.struct("error_class", "error"), F.when(failed, F.col("at")))
    per_item = results.groupBy("doc_id").agg(
        F.count("*").alias("attempts"), F.bool_or(~failed).alias("_done"), last.alias("_last")
    )
    again = st.retryable_parse(F.col("_last.error_class"), F.col("_last.error"))
    decision = (
        F.when(F.col("_done"), F.lit("done"))
        .when((F.col("attempts") < max_attempts) & again, F.lit("retry"))
        .otherwise(F.lit("dead"))
    )
    out = per_item.withColumn("decision", decision)
    return out.select(
        "doc_id",
        "attempts",
        "decision",
        F.when(F.col("decision") == "retry", st.backoff(F.col("attempts"))).alias("wait_seconds"),
        F.when(F.col("decision") != "done", F.col("_last.error")).alias("error"),
    )


def task_timeouts(
    events: DataFrame, now: Column, run_seconds: int = 800, pending_seconds: int = 5000
) -> DataFrame:
    """Unfinished tasks that were submitted or started too long ago: ``task_id, problem``.

    Input ``task_id, at`` (epoch seconds) and ``state`` SUBMITTED, STARTED, SUCCESS, FAILURE or REVOKED.
    """

    def first(state: str) -> Column:
        return F.min(F.when(F.col("state") == state, F.col("at")))

    tasks = events.groupBy("task_id").agg(
        first("SUBMITTED").alias("_submitted"),
        first("STARTED").alias("_started"),
        F.bool_or(F.col("state").isin("SUCCESS", "FAILURE", "REVOKED")).alias("_over"),
    )
    problem = F.when(now - F.col("_submitted") >= pending_seconds, F.lit("pending timeout")).when(
        now - F.col("_started") >= run_seconds, F.lit("timeout")
    )
    return tasks.filter(~F.col("_over")).select("task_id", problem.alias("problem")).filter("problem is not null")


def dedupe_wakeups(events: DataFrame, keys: list[str], ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """First wake-up per key; on a stream, repeats within the watermark are dropped."""
    if events.isStreaming:
        # A watermark needs an instant, so zone-less times are read in the session's zone.
        timed = events.withColumn(ts, F.col(ts).cast("timestamp"))
        return timed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
    rest = [c for c in events.columns if c not in keys]
    firsts = events.groupBy(*keys).agg(F.min(F.struct(ts, *[c for c in rest if c != ts])).alias("_row"))
    return firsts.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest])


def claim_disposition(claims: DataFrame) -> DataFrame:
    """``msg_id, action`` for messages that were not claimed: archive only when told to."""
    action = F.when(F.col("archive_current_message"), F.lit("archive")).otherwise(F.lit("keep"))
    return claims.select("msg_id", action.alias("action"))


def ready_when_published(
    local: DataFrame, remote: DataFrame, entries: DataFrame, listing: DataFrame, timed_out: Column, strict: bool = False
) -> DataFrame:
    """``document_id, state, error``: ready, waiting or failed.

    Manifests are compared first, then their files. A document that cannot become ready, or did not
    before its deadline, has failed; anything else waits for the next round.
    """
    manifests = compare_manifests(local, remote)
    files = verify_artifacts(entries, listing, strict).select(
        F.col("doc_id").alias("document_id"), F.col("error").alias("_file_error")
    )
    joined = manifests.join(files, "document_id", "left").join(
        local.select("document_id", timed_out.alias("_late")), "document_id"
    )
    error = F.coalesce("error", "_file_error")
    final = ~st.retryable_ready(F.lit("runtime"), error)
    state = (
        F.when(error.isNull(), F.lit("ready")).when(final | F.col("_late"), F.lit("failed")).otherwise("waiting")
    )
    shown = F.when(
        F.col("_late") & ~final & error.isNotNull(), F.concat(F.lit("S3_NOT_READY_AFTER_TIMEOUT: "), error)
    ).otherwise(error)
    return joined.select("document_id", state.alias("state"), shown.alias("error"))
