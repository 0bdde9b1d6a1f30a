"""One collection run: plan windows, land new rows, log the run last.

A run id stands for one call. Repeating a call that crashed replaces its rows;
repeating one that was logged changes nothing.
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark import StorageLevel
from pyspark.sql import DataFrame, functions as F

from trendspark import messages as say
from trendspark.functions.timeutil import as_of_column
from trendspark.operators import ingest
from trendspark.operators.joins import Dimension
from trendspark.session import stored
from trendspark.sinks import Lake
from trendspark.sources import landing


def collect_by_cursor(
    lake: Lake,
    items: DataFrame,
    sources: DataFrame,
    run_id: str,
    as_of: datetime,
    capacity: int | None = None,
    backfill_capacity: int | None = None,
    failed: DataFrame | None = None,
    event_time_in_payload: bool = True,
    cold_start: timedelta | None = None,
) -> DataFrame:
    """Collect every source that has a time cursor, in one job.

    ``items`` are the landed rows (source_name, native_id, payload,
    payload_hash, event_ts), ``sources`` the names to run and ``failed`` the
    (source_name, error_msg) of sources that could not be read: they keep their
    cursor and do not hold back the others. Returns the run's log rows.
    The forward window is read whole unless ``capacity`` bounds it; the next run goes on from there.
    The backfill reads its whole window unless ``backfill_capacity`` bounds it: its
    lower bound is the same in every run, so rows behind a bound would never land.
    Items without ``event_ts`` land in any run. A source without cursor starts at
    its oldest item, or ``cold_start`` back: what lies before that never lands.
    ``event_time_in_payload`` says that a payload determines its event time (as
    for every source of this package), which bounds the stored rows to compare.
    """
    if lake.logged(run_id):
        return lake.read("run_log").filter(F.col("run_id") == run_id)
    state = ingest.watermark_state(lake.read("run_log"))
    plan = Dimension(ingest.window_plan(state, as_of, sources=sources, cold_start=cold_start))
    windows = plan.df
    if failed is not None:
        windows = windows.join(failed.select("source_name"), "source_name", "left_anti")
    if backfill_capacity is None:
        backfill = ingest.in_windows(items, windows, "backfill").withColumn("rank", F.lit(0))
    else:
        backfill = ingest.capped_window(items, windows, backfill_capacity, "backfill")
        backfill = backfill.filter(F.col("rank") <= backfill_capacity)
    # No window holds a row without event time; it lands as any other and moves no cursor.
    undated = (
        Dimension(windows.filter("kind = 'forward'").select("source_name"))
        .join(items.filter(F.col("event_ts").isNull()), ["source_name"], spread=["native_id"])
        .withColumn("rank", F.lit(0))
    )
    if capacity is None:
        ahead = ingest.in_windows(items, windows, "forward").withColumn("rank", F.lit(0))
    else:
        ahead = ingest.capped_window(items, windows, capacity, "forward")
    staged = (
        ahead.withColumn("kind", F.lit("forward"))
        .unionByName(backfill.withColumn("kind", F.lit("backfill")))
        .unionByName(undated.withColumn("kind", F.lit("undated")))
        .withColumn("fetched_at", as_of_column(as_of))
        .withColumn("run_id", F.lit(run_id))
        .persist(StorageLevel.DISK_ONLY)
    )
    try:
        forward = staged.filter("kind = 'forward'")
        cursors = ingest.next_cursor(forward, windows, capacity)
        read = staged
        if capacity is not None:
            read = staged.filter((F.col("kind") != "forward") | (F.col("rank") <= capacity))
        _land(lake, read, run_id, event_time_in_payload)
        counts = _counts(lake, read, run_id)
        log = (
            cursors.join(counts, "source_name", "left")
            .select(
                F.lit(run_id).alias("run_id"),
                "source_name",
                as_of_column(as_of).alias("started_at"),
                as_of_column(as_of).alias("ended_at"),
                F.when(F.col("stalled"), "stalled").otherwise("ok").alias("status"),
                F.coalesce("rows_fetched", F.lit(0)).alias("rows_fetched"),
                F.coalesce("rows_new", F.lit(0)).alias("rows_new"),
                F.col("cursor_ts").alias("watermark_before"),
                F.greatest("cursor_ts", "next_cursor").alias("watermark_after"),
                F.when(F.col("stalled"), say.CURSOR_STALLED).alias("error_msg"),
            )
        )
        if failed is not None:
            log = log.unionByName(_failure_rows(plan.df, failed, run_id, as_of))
        lake.append("run_log", log)
    finally:
        staged.unpersist()
    return lake.read("run_log").filter(F.col("run_id") == run_id)


def collect_landed(
    lake: Lake, feeds: DataFrame, items: DataFrame, sources: DataFrame, run_id: str, as_of: datetime
) -> DataFrame:
    """Collect the landed files of many sources in one run; a source that cannot be read is logged as an error."""
    failed = stored(landing.failures(feeds, items), "failed")
    return collect_by_cursor(lake, landing.readable_rows(feeds, items), sources, run_id, as_of, failed=failed)


def collect_full(
    lake: Lake,
    items: DataFrame,
    run_id: str,
    as_of: datetime,
    failures: DataFrame | None = None,
    event_time_in_payload: bool = True,
) -> DataFrame:
    """Collect a mutating source: reread everything, keep what changed.

    No cursor is kept. ``failures`` holds (source_name, failed), the items that
    could not be read.
    """
    if lake.logged(run_id):
        return lake.read("run_log").filter(F.col("run_id") == run_id)
    staged = (
        items.withColumn("fetched_at", as_of_column(as_of))
        .withColumn("run_id", F.lit(run_id))
        .persist(StorageLevel.DISK_ONLY)
    )
    try:
        _land(lake, staged, run_id, event_time_in_payload)
        counts = _counts(lake, staged, run_id)
        if failures is None:
            counts = counts.withColumn("failed", F.lit(0))
        else:
            counts = counts.join(failures, "source_name", "full")
        none = F.lit(None).cast("timestamp")
        failed = F.col("failed")
        log = counts.select(
            F.lit(run_id).alias("run_id"),
            "source_name",
            as_of_column(as_of).alias("started_at"),
            as_of_column(as_of).alias("ended_at"),
            F.lit("ok").alias("status"),
            F.coalesce("rows_fetched", F.lit(0)).alias("rows_fetched"),
            F.coalesce("rows_new", F.lit(0)).alias("rows_new"),
            none.alias("watermark_before"),
            none.alias("watermark_after"),
            F.when(failed > 0, say.fill(say.ITEMS_FAILED, n=failed)).alias("error_msg"),
        )
        lake.append("run_log", log)
    finally:
        staged.unpersist()
    return lake.read("run_log").filter(F.col("run_id") == run_id)


def record_failure(
    lake: Lake, failed: DataFrame, run_id: str, as_of: datetime
) -> None:
    """Log sources (source_name, error_msg) that failed before anything was read."""
    state = ingest.watermark_state(lake.read("run_log"))
    cursors = failed.select("source_name").join(state, "source_name", "left")
    lake.append("run_log", _failure_rows(cursors, failed, run_id, as_of))


def _land(lake: Lake, staged: DataFrame, run_id: str, event_time_in_payload: bool) -> None:
    columns = [
        "source_name", "native_id", "payload_hash", "payload", "event_ts", "fetched_at", "run_id",
    ]
    committed = lake.raw_items(except_run=run_id)
    if event_time_in_payload:
        committed = ingest.same_event_times(committed, staged)
    known = ingest.known_keys(committed, staged)
    fresh = ingest.idempotent_rows(staged.select(*columns), known)
    lake.write_run(fresh, run_id)


def _counts(lake: Lake, staged: DataFrame, run_id: str) -> DataFrame:
    fetched = staged.groupBy("source_name").agg(F.count(F.lit(1)).alias("rows_fetched"))
    new = (
        lake.read("raw_item")
        .filter(F.col("run_id") == run_id)
        .groupBy("source_name")
        .agg(F.count(F.lit(1)).alias("rows_new"))
    )
    return fetched.join(new, "source_name", "left")


def _failure_rows(
    cursors: DataFrame, failed: DataFrame, run_id: str, as_of: datetime
) -> DataFrame:
    known = cursors.groupBy("source_name").agg(F.max("cursor_ts").alias("cursor_ts"))
    return failed.join(known, "source_name", "left").select(
        F.lit(run_id).alias("run_id"),
        "source_name",
        as_of_column(as_of).alias("started_at"),
        as_of_column(as_of).alias("ended_at"),
        F.lit("error").alias("status"),
        F.lit(0).cast("bigint").alias("rows_fetched"),
        F.lit(0).cast("bigint").alias("rows_new"),
        F.col("cursor_ts").alias("watermark_before"),
        F.col("cursor_ts").alias("watermark_after"),
        "error_msg",
    )
