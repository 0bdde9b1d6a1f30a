"""Seven data-quality checks and their unified result.

Each check returns (check_name, source_name, status, observed_value,
expected_value, detail). A check without enough history says
``insufficient_data``; it never passes by default.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from trendspark import messages as say
from trendspark.functions.timeutil import as_of_column, day_type, hours_between
from trendspark.operators.ingest import run_segments
from trendspark.operators.ordering import latest_per_key

DROP_RATIO = 0.4
MIN_OBSERVATIONS = 7
BASELINE_DAYS = 28
FRESH_WARN_HOURS = 26
FRESH_CRITICAL_HOURS = 48
DOMINATION_RATIO = 0.40


def last_run_per_day(run_log: DataFrame) -> DataFrame:
    """The day's result of a source is its last run of that day."""
    runs = run_log.withColumn("run_date", F.to_date("started_at"))
    order = [F.col("started_at").desc_nulls_last(), F.col("run_id").desc()]
    return latest_per_key(runs, ["source_name", "run_date"], order)


def latest_run(daily_runs: DataFrame) -> DataFrame:
    return latest_per_key(daily_runs, ["source_name"], [F.col("run_date").desc()])


def source_facts(run_log: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """One row per source with all that its checks ask for; the log is read and shuffled by source once.

    ``last``: the last run of the latest day. ``moves`` and ``run_count``: the latest day, and the number of days,
    whose run had a cursor. ``newest``, ``baseline_median`` and ``baseline_n`` as in ``volume_baseline``.
    """
    fields = ("status", "error_msg", "rows_fetched", "rows_new", "watermark_before", "watermark_after")
    daily = (
        run_segments(run_log, *fields)
        .groupBy("source_name", F.to_date("_hour").alias("run_date"))
        .agg(F.max("_last").alias("run"), F.sum("_errors").alias("errors"), F.max("_success").alias("success"))
        .select("source_name", "run_date", "errors", "success", *[F.col(f"run.{name}").alias(name) for name in fields])
    )
    good = F.when(F.col("status") == "ok", F.struct("run_date", "rows_new", day_type(F.col("run_date")).alias("day_type")))
    dated = daily.withColumn("newest", F.max(good).over(Window.partitionBy("source_name")))
    compared = (
        (F.col("status") == "ok")
        & (F.col("run_date") < F.col("newest.run_date"))
        & (F.col("run_date") >= F.date_sub("newest.run_date", days))
        & (day_type(F.col("run_date")) == F.col("newest.day_type"))
    )
    with_cursor = F.col("watermark_after").isNotNull()
    moves = F.struct("run_date", "watermark_before", "watermark_after", "rows_new")
    return dated.groupBy("source_name").agg(
        F.sum("errors").alias("consecutive_fail"),
        F.max("success").alias("last_success_at"),
        F.max(F.struct("run_date", "status", "error_msg", "rows_fetched")).alias("last"),
        F.count(F.when(with_cursor, 1)).alias("run_count"),
        F.max(F.when(with_cursor, moves)).alias("moves"),
        F.max("newest").alias("newest"),
        F.median(F.when(compared, F.col("rows_new"))).alias("baseline_median"),
        F.count(F.when(compared, 1)).alias("baseline_n"),
    )


def check_sources(facts: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    """The five checks of the run log over ``source_facts``."""
    drop = _volume_drop(
        F.col("newest.rows_new"), F.col("newest.day_type"), F.col("baseline_median"), F.col("baseline_n")
    )
    findings = F.array(
        _ingest_error(F.col("consecutive_fail"), F.col("last.status"), F.col("last.error_msg")),
        _volume_zero(F.col("last.status"), F.col("last.rows_fetched")),
        _freshness(F.col("last_success_at"), as_of),
        F.when(F.col("run_count") > 0, _watermark_stall(F.col("run_count"), F.col("moves"))),
        F.when(F.col("newest").isNotNull(), drop),
    )
    return facts.select(F.inline(F.filter(findings, lambda finding: finding.isNotNull())))


def _finding(
    name: str,
    status: Column,
    observed: Column,
    expected: Column | float | None,
    detail: Column,
    source: Column | None = None,
) -> Column:
    expected = expected if isinstance(expected, Column) else F.lit(expected)
    return F.struct(
        F.lit(name).alias("check_name"),
        (F.col("source_name") if source is None else source).alias("source_name"),
        status.alias("status"),
        observed.cast("double").alias("observed_value"),
        expected.cast("double").alias("expected_value"),
        detail.alias("detail"),
    )


def _check(df: DataFrame, finding: Column) -> DataFrame:
    return df.select(finding.alias("finding")).select("finding.*")


def _ingest_error(fails: Column, status: Column, error_msg: Column) -> Column:
    failed_last = status == "error"
    return _finding(
        "ingest_error",
        F.when(fails >= 2, "critical")
        .when(fails == 1, "warn")
        .when(failed_last, "critical")
        .otherwise("ok"),
        fails,
        0.0,
        F.when(fails > 0, say.fill(say.FAILS_IN_A_ROW, n=fails))
        .when(failed_last, F.coalesce(error_msg, F.lit(say.FETCH_FAILED)))
        .otherwise(say.NORMAL),
    )


def check_ingest_error(state: DataFrame, latest: DataFrame) -> DataFrame:
    joined = state.select("source_name", "consecutive_fail").join(
        latest.select("source_name", "status", "error_msg"), "source_name", "left"
    )
    return _check(joined, _ingest_error(F.col("consecutive_fail"), F.col("status"), F.col("error_msg")))


def _volume_zero(status: Column, rows_fetched: Column) -> Column:
    fetched = F.coalesce(rows_fetched, F.lit(0))
    silent = (status == "ok") & (fetched == 0)
    return _finding(
        "volume_zero",
        F.when(silent, "critical").otherwise("ok"),
        fetched,
        None,
        F.when(silent, say.SILENT_STOP).otherwise(say.fill(say.RECEIVED, n=fetched)),
    )


def check_volume_zero(latest: DataFrame) -> DataFrame:
    """A run that succeeded and received nothing; needs no history."""
    return _check(latest, _volume_zero(F.col("status"), F.col("rows_fetched")))


def _freshness(
    last_success: Column,
    as_of: datetime | str | Column,
    warn_hours: int = FRESH_WARN_HOURS,
    critical_hours: int = FRESH_CRITICAL_HOURS,
) -> Column:
    hours = hours_between(last_success, as_of_column(as_of))
    return _finding(
        "freshness",
        F.when(last_success.isNull(), "insufficient_data")
        .when(hours >= critical_hours, "critical")
        .when(hours >= warn_hours, "warn")
        .otherwise("ok"),
        hours,
        float(warn_hours),
        F.when(last_success.isNull(), say.NEVER_SUCCEEDED).otherwise(say.fill(say.LAST_SUCCESS, hours=hours)),
    )


def check_freshness(
    state: DataFrame,
    as_of: datetime | str | Column,
    warn_hours: int = FRESH_WARN_HOURS,
    critical_hours: int = FRESH_CRITICAL_HOURS,
) -> DataFrame:
    return _check(state, _freshness(F.col("last_success_at"), as_of, warn_hours, critical_hours))


def _watermark_stall(runs: Column, last: Column) -> Column:
    stuck = (last["watermark_before"] == last["watermark_after"]) & (last["rows_new"] == 0)
    return _finding(
        "watermark_stall",
        F.when(runs < 2, "insufficient_data").when(stuck, "warn").otherwise("ok"),
        runs,
        None,
        F.when(runs < 2, say.fill(say.TOO_FEW_RUNS, n=runs))
        .when(stuck, say.CURSOR_STUCK)
        .otherwise(say.CURSOR_MOVES),
    )


def check_watermark_stall(daily_runs: DataFrame) -> DataFrame:
    """A cursor that did not move in a run without new rows.

    Looks at sources with a cursor only; a day counts if its run had one.
    """
    with_cursor = daily_runs.filter(F.col("watermark_after").isNotNull())
    newest = F.max(
        F.struct("run_date", "watermark_before", "watermark_after", "rows_new")
    ).alias("last")
    per_source = with_cursor.groupBy("source_name").agg(
        F.count(F.lit(1)).alias("run_count"), newest
    )
    return _check(per_source, _watermark_stall(F.col("run_count"), F.col("last")))


def volume_baseline(daily_runs: DataFrame, days: int = BASELINE_DAYS) -> DataFrame:
    """The newest good day of each source against the median of its past.

    The past is the same day type (weekday or weekend) within ``days``. Only
    the newest day is joined back, so at most ``days`` rows per source reach the
    exact median.
    """
    history = daily_runs.filter(F.col("status") == "ok").select(
        "source_name", "run_date", "rows_new", day_type(F.col("run_date")).alias("day_type")
    )
    newest = (
        history.groupBy("source_name")
        .agg(F.max(F.struct("run_date", "rows_new", "day_type")).alias("h"))
        .select("source_name", "h.run_date", "h.rows_new", "h.day_type")
    )
    past = history.select(
        "source_name",
        "day_type",
        F.col("run_date").alias("past_date"),
        F.col("rows_new").alias("past_rows"),
    )
    in_reach = (F.col("past_date") < F.col("run_date")) & (
        F.col("past_date") >= F.date_sub("run_date", days)
    )
    baseline = (
        newest.join(past, ["source_name", "day_type"])
        .filter(in_reach)
        .groupBy("source_name")
        .agg(
            F.median("past_rows").alias("baseline_median"),
            F.count(F.lit(1)).alias("baseline_n"),
        )
    )
    return newest.join(baseline, "source_name", "left").withColumn(
        "baseline_n", F.coalesce("baseline_n", F.lit(0))
    )


def _volume_drop(
    rows_new: Column,
    day: Column,
    median: Column,
    n: Column,
    drop_ratio: float = DROP_RATIO,
    min_observations: int = MIN_OBSERVATIONS,
) -> Column:
    few = n < min_observations
    return _finding(
        "volume_drop",
        F.when(few, "insufficient_data").when(rows_new < median * drop_ratio, "warn").otherwise("ok"),
        rows_new,
        median,
        F.when(few, say.fill(say.NO_BASELINE, n=n, least=F.lit(min_observations))).otherwise(
            say.fill(say.VOLUME, n=rows_new, day_type=day, median=median)
        ),
    )


def check_volume_drop(
    baseline: DataFrame,
    drop_ratio: float = DROP_RATIO,
    min_observations: int = MIN_OBSERVATIONS,
) -> DataFrame:
    columns = [F.col(name) for name in ("rows_new", "day_type", "baseline_median", "baseline_n")]
    return _check(baseline, _volume_drop(*columns, drop_ratio, min_observations))


def topic_counts(affinity: DataFrame) -> DataFrame:
    return affinity.groupBy(F.col("best_interest_label").alias("label")).agg(
        F.count(F.lit(1)).alias("n")
    )


def topic_share(affinity: DataFrame) -> DataFrame:
    """Every topic's share of the documents.

    The unpartitioned window sees one row per topic, never the documents.
    """
    total = F.sum("n").over(Window.partitionBy()).cast("double")
    return topic_counts(affinity).withColumn("share", F.col("n") / total)


def check_topic_domination(
    affinity: DataFrame, ratio: float = DOMINATION_RATIO
) -> DataFrame:
    """The largest topic's share; no documents, no row. Equal counts: larger label."""
    top = (
        topic_counts(affinity)
        .groupBy()
        .agg(F.max(F.struct("n", "label")).alias("top"), F.sum("n").alias("total"))
        .filter(F.col("top").isNotNull())
        .select(
            F.col("top.label").alias("label"),
            (F.col("top.n") / F.col("total").cast("double")).alias("share"),
        )
    )
    share = F.col("share")
    finding = _finding(
        "topic_domination",
        F.when(share > ratio, "warn").otherwise("ok"),
        F.round(share, 3),
        ratio,
        say.fill(say.TOPIC_SHARE, label=F.col("label"), percent=F.round(share * 100, 1)),
        source=F.lit(say.ALL_SOURCES),
    )
    return _check(top, finding)


def duplicate_titles(docs: DataFrame) -> DataFrame:
    """Normalised titles that several documents share.

    Two different ids exist where the least and the greatest differ, which
    needs one aggregate and no distinct pass over a title's documents.
    """
    return (
        docs.filter(F.col("title").isNotNull())
        .groupBy(F.lower(F.trim("title")).alias("norm_title"))
        .agg(F.min("doc_id").alias("_lo"), F.max("doc_id").alias("_hi"))
        .filter(F.col("_lo") < F.col("_hi"))
        .select("norm_title")
    )


def check_duplicate(docs: DataFrame) -> DataFrame:
    counted = duplicate_titles(docs).groupBy().agg(F.count(F.lit(1)).alias("n"))
    n = F.col("n")
    finding = _finding(
        "duplicate_candidate",
        F.when(n > 0, "warn").otherwise("ok"),
        n,
        0.0,
        F.when(n > 0, say.fill(say.SAME_TITLES, n=n)).otherwise(say.NO_DUPLICATES),
        source=F.lit(say.ALL_SOURCES),
    )
    return _check(counted, finding)


def check_result(checks: list[DataFrame], as_of: datetime | str | Column) -> DataFrame:
    """All checks in one table, stamped with the evaluation time."""
    union = checks[0]
    for check in checks[1:]:
        union = union.unionByName(check)
    now = as_of_column(as_of)
    return union.select(
        "check_name",
        F.to_date(now).alias("check_date"),
        "source_name",
        "status",
        "observed_value",
        "expected_value",
        "detail",
        now.alias("evaluated_at"),
    )


def run_checks(
    run_log: DataFrame, docs: DataFrame, affinity: DataFrame, as_of: datetime | str | Column
) -> DataFrame:
    """The seven checks with their default limits."""
    return check_result(
        [
            check_sources(source_facts(run_log), as_of),
            check_topic_domination(affinity),
            check_duplicate(docs),
        ],
        as_of,
    )
