"""Idempotent landing, cursors, forward windows and late arrivals."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window, functions as F

from trendspark.functions.timeutil import as_of_column
from trendspark.operators.joins import Dimension
from trendspark.operators.ordering import latest_per_key, number_within, top_n_per_group
from trendspark.schemas import RAW_ITEM_KEY

# Defaults of the cursor rules.
SAFETY_LAG = timedelta(minutes=15)
OVERLAP = timedelta(days=2)
COLD_START = timedelta(days=7)
# Up to this many keys (and the byte bound of a dimension) a batch is broadcast.
MAX_BATCH_KEYS = 500_000

# A stalled run did land its rows and counts as a success for its source.
COMMITTED = ("ok", "stalled")


def canonical_payload(columns: Sequence[str]) -> Column:
    """JSON text with the keys in sorted order and NULLs kept."""
    return F.to_json(F.struct(*sorted(columns)), {"ignoreNullFields": "false"})


def payload_hash(payload: Column) -> Column:
    return F.substring(F.sha2(payload, 256), 1, 32)


def idempotent_rows(
    staged: DataFrame,
    committed: DataFrame,
    key: Sequence[str] = tuple(RAW_ITEM_KEY),
    tie_break: Sequence[str] = ("fetched_at", "run_id"),
) -> DataFrame:
    """Staged rows whose key is not committed yet, one per key.

    Of several staged rows with one key the latest ``event_ts`` wins. Both
    sides are reduced to one row per key on the partitioning the join uses, so
    a payload repeated any number of times neither skews nor adds a shuffle.
    """
    order = [F.col("event_ts").desc_nulls_last(), *[F.col(c).asc_nulls_last() for c in tie_break]]
    fresh = latest_per_key(staged, key, order)
    return fresh.join(committed.select(*key).distinct(), list(key), "left_anti")


def same_event_times(committed: DataFrame, staged: DataFrame) -> DataFrame:
    """Committed rows inside the event-time range of the staged ones.

    Where ``event_ts`` is read from the payload, equal payloads have equal event
    times, so no other row can hold a staged key. The bounds are scalar
    subqueries that the scan gets as pushed filters: landing a small batch then
    reads a small part of a large table. Rows without event time always stay.
    """
    bounds = staged.groupBy().agg(
        F.min("event_ts").alias("lo"), F.max("event_ts").alias("hi")
    )
    ts = F.col("event_ts")
    inside = (ts >= bounds.select("lo").scalar()) & (ts <= bounds.select("hi").scalar())
    return committed.filter(ts.isNull() | inside)


def known_keys(
    committed: DataFrame, staged: DataFrame, key: Sequence[str] = tuple(RAW_ITEM_KEY)
) -> DataFrame:
    """Committed keys, cut to those of a small staged batch.

    A batch whose keys are measured small is broadcast, so a large table is
    scanned for its key columns but not shuffled. A larger batch leaves the
    cut to the join that follows. ``staged`` is read once more; persist it.
    """
    keys = Dimension(staged.select(*key), max_rows=MAX_BATCH_KEYS)
    stored = committed.select(*key)
    return keys.join(stored, key, spread=(), how="left_semi") if keys.small else stored


def committed_rows(raw: DataFrame, run_log: DataFrame) -> DataFrame:
    """Rows of runs that reached the run log; rows of a crashed run stay hidden."""
    done = run_log.filter(F.col("status").isin(*COMMITTED)).select("run_id", "source_name")
    return raw.join(done, ["run_id", "source_name"], "left_semi")


def payload_history(raw: DataFrame) -> DataFrame:
    """Distinct payloads of each item, numbered from the first one fetched."""
    first_seen = raw.groupBy("native_id", "payload_hash").agg(
        F.min("fetched_at").alias("first_fetched_at")
    )
    return number_within(
        first_seen,
        ["native_id"],
        order=[F.col("first_fetched_at"), F.col("payload_hash")],
        out="version_no",
    )


def run_segments(run_log: DataFrame, *fields: str) -> DataFrame:
    """The run log summed up by (source, hour); ``_last`` is the last run, with ``fields`` of it.

    A segment knows whether a run succeeded and how many errors follow the last
    one that did; segments of a source then fold from the newest back, so no task
    sees more than an hour of a source's runs, or its hours. ``_errors`` are those
    that count as in a row.
    """
    position = F.struct("started_at", "run_id", *fields)
    succeeded = F.col("status").isin(*COMMITTED)
    hour = F.date_trunc("hour", F.col("started_at"))
    newest_first = [F.col("started_at").desc_nulls_last(), F.col("run_id").desc_nulls_last()]
    rest = Window.partitionBy("source_name", "_hour").orderBy(*newest_first).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    runs = run_log.select(
        "source_name",
        hour.alias("_hour"),
        "started_at",
        "run_id",
        "ended_at",
        position.alias("_run"),
        F.when(succeeded, F.col("watermark_after")).alias("_cursor"),
        F.when(succeeded, F.col("ended_at")).alias("_success"),
        succeeded.alias("_ok"),
        (F.col("status") == "error").alias("_error"),
    ).withColumn("_ok_since", F.max("_ok").over(rest))
    segments = runs.groupBy("source_name", "_hour").agg(
        F.max("_cursor").alias("_cursor"),
        F.max("_run").alias("_last"),
        F.max("_success").alias("_success"),
        F.max("_ok").alias("_ok"),
        F.count(F.when(F.col("_error") & ~F.col("_ok_since"), 1)).alias("_errors"),
        F.max("ended_at").alias("updated_at"),
    )
    newer = Window.partitionBy("source_name").orderBy(F.col("_hour").desc_nulls_last()).rowsBetween(
        Window.unboundedPreceding, -1
    )
    open_ended = ~F.coalesce(F.max("_ok").over(newer), F.lit(False))
    return segments.withColumn("_errors", F.when(open_ended, F.col("_errors")).otherwise(0))


def watermark_state(run_log: DataFrame) -> DataFrame:
    """Cursor and failure state per source, derived from the run log, which is read once.

    The cursor never regresses (a maximum), is left alone by failures and by
    runs without one, and ``consecutive_fail`` counts the errors since the last
    success.
    """
    return (
        run_segments(run_log)
        .groupBy("source_name")
        .agg(
            F.max("_cursor").alias("cursor_ts"),
            F.max("_last").getField("run_id").alias("last_run_id"),
            F.max("_success").alias("last_success_at"),
            F.sum("_errors").alias("consecutive_fail"),
            F.max("updated_at").alias("updated_at"),
        )
    )


def window_plan(
    state: DataFrame,
    as_of: datetime | str | Column,
    sources: DataFrame | None = None,
    lag: timedelta = SAFETY_LAG,
    overlap: timedelta = OVERLAP,
    cold_start: timedelta | None = COLD_START,
) -> DataFrame:
    """The event-time windows the next run reads: (source, kind, lower, upper).

    Forward runs from the cursor to ``as_of - lag`` and alone moves the cursor;
    backfill rereads the ``overlap`` before it for items that surfaced late.
    ``sources`` adds sources that have no state yet (a cold start): they read
    ``cold_start`` back, or from the first event where that is None.
    """
    if sources is not None:
        state = sources.select("source_name").distinct().join(state, "source_name", "left")
    upper = as_of_column(as_of) - F.lit(lag)
    cursor = F.col("cursor_ts")
    first = F.lit(datetime.min).cast("timestamp") if cold_start is None else upper - F.lit(cold_start)
    forward = F.struct(
        F.lit("forward").alias("kind"),
        F.coalesce(cursor, first).alias("lower"),
        upper.alias("upper"),
    )
    backfill = F.struct(
        F.lit("backfill").alias("kind"),
        (cursor - F.lit(overlap)).alias("lower"),
        cursor.alias("upper"),
    )
    windows = F.when(cursor.isNull(), F.array(forward)).otherwise(F.array(forward, backfill))
    return state.select("source_name", "cursor_ts", F.explode(windows).alias("w")).select(
        "source_name", "cursor_ts", "w.kind", "w.lower", "w.upper"
    )


def in_windows(items: DataFrame, windows: DataFrame, kind: str) -> DataFrame:
    """Items inside their source's window of one kind, both ends inclusive.

    The span of all windows goes to the scan as a pushed filter; the join then
    applies each source's own window.
    """
    bounds = Dimension(
        windows.filter(F.col("kind") == kind).select("source_name", "lower", "upper")
    )
    span = bounds.df.groupBy().agg(F.min("lower").alias("lo"), F.max("upper").alias("hi"))
    in_span = (F.col("event_ts") >= span.select("lo").scalar()) & (
        F.col("event_ts") <= span.select("hi").scalar()
    )
    joined = bounds.join(
        items.filter(in_span), ["source_name"], spread=["native_id", "event_ts"]
    )
    return joined.filter(F.col("event_ts").between(F.col("lower"), F.col("upper"))).drop(
        "lower", "upper"
    )


def capped_window(
    items: DataFrame,
    windows: DataFrame,
    capacity: int | None = None,
    kind: str = "forward",
    tie_break: str = "native_id",
) -> DataFrame:
    """The oldest ``capacity`` items of each source's window, ranked; all items without one.

    One row past the capacity is kept, as rank ``capacity + 1``: its presence
    says that the window was not exhausted. Callers landing rows filter on
    ``rank <= capacity``.
    """
    order = [F.col("event_ts"), F.col(tie_break)]
    inside = in_windows(items, windows, kind)
    if capacity is None:
        return number_within(inside, ["source_name"], order=order, out="rank")
    return top_n_per_group(inside, ["source_name"], order, capacity + 1)


def next_cursor(
    forward: DataFrame, windows: DataFrame, capacity: int | None = None
) -> DataFrame:
    """Where each source's cursor goes, from the ranked rows of its forward window.

    A window read to its end moves the cursor to ``upper``; otherwise it moves
    to the last event read. Not moving at all is a stall: more items share one
    instant than a run can take. Without ``capacity`` every window is read to its end.
    """
    read = F.lit(True) if capacity is None else F.col("rank") <= capacity
    seen = forward.groupBy("source_name").agg(
        F.max(F.when(read, F.col("event_ts"))).alias("_seen"),
        F.count(F.when(read, 1)).alias("rows_forward"),
        F.max(~read).alias("_more"),
    )
    exhausted = ~F.coalesce("_more", F.lit(False))
    moved = F.when(exhausted, F.col("upper")).otherwise(F.col("_seen"))
    return (
        windows.filter(F.col("kind") == "forward")
        .join(seen, "source_name", "left")
        .select(
            "source_name",
            "cursor_ts",
            F.coalesce("rows_forward", F.lit(0)).alias("rows_forward"),
            exhausted.alias("exhausted"),
            moved.alias("next_cursor"),
            F.coalesce(
                F.col("cursor_ts").isNotNull() & (moved <= F.col("cursor_ts")) & ~exhausted,
                F.lit(False),
            ).alias("stalled"),
        )
    )


def late_arrivals(raw: DataFrame, run_log: DataFrame, quantile: float = 0.99) -> DataFrame:
    """Rows older than the cursor their run started from, summed up per source.

    Lateness is in whole seconds. It is counted per (source, second) first, so
    the exact percentile of a source of any size works on a bounded histogram.
    """
    runs = run_log.filter(F.col("watermark_before").isNotNull()).select(
        "run_id", "source_name", "watermark_before"
    )
    late = (
        raw.select("run_id", "source_name", "event_ts")
        .join(runs, ["run_id", "source_name"])
        .filter(F.col("event_ts") < F.col("watermark_before"))
        .withColumn(
            "seconds",
            F.floor(
                (F.unix_micros("watermark_before") - F.unix_micros("event_ts")) / 1_000_000
            ),
        )
    )
    histogram = late.groupBy("source_name", "seconds").agg(F.count(F.lit(1)).alias("n"))
    return histogram.groupBy("source_name").agg(
        F.sum("n").alias("n"),
        F.max("seconds").alias("worst_seconds"),
        F.percentile("seconds", F.lit(quantile), F.col("n")).alias("p99_seconds"),
    )


def source_summary(raw: DataFrame) -> DataFrame:
    return raw.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("n"),
        F.min("event_ts").alias("first_event"),
        F.max("event_ts").alias("last_event"),
    )


def recent_runs(run_log: DataFrame, n: int = 10) -> DataFrame:
    return run_log.orderBy(
        F.col("started_at").desc_nulls_last(), F.col("run_id"), F.col("source_name")
    ).limit(n)
