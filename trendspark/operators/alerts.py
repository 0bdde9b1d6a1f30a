"""Which findings to announce, and the banner made from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from trendspark import messages as say
from trendspark.functions.timeutil import as_of_column, hours_between

COOLDOWN_HOURS = 20
MAX_LISTED = 5


def alert_dispatch(
    results: DataFrame,
    sent: DataFrame,
    as_of: datetime | str | Column,
    cooldown_hours: int = COOLDOWN_HOURS,
) -> DataFrame:
    """New alerts: findings not announced within the cooldown.

    The cooldown is per (check, source, severity), so a quiet warning does not
    hold back a critical one. With no earlier alerts everything goes out.
    """
    now = as_of_column(as_of)
    key = ["check_name", "source_name", "severity"]
    last = sent.groupBy(*key).agg(F.max("alerted_at").alias("_last"))
    findings = results.filter(F.col("status").isin(*say.SEVERITY_LABELS)).withColumnRenamed(
        "status", "severity"
    )
    due = F.col("_last").isNull() | (hours_between(F.col("_last"), now) >= cooldown_hours)
    alert_id = F.md5(
        F.concat_ws(
            ":", "check_name", "source_name", "severity", F.col("check_date").cast("string")
        )
    )
    return (
        findings.join(last, key, "left")
        .filter(due)
        .select(
            alert_id.alias("alert_id"),
            "check_name",
            "check_date",
            "source_name",
            "severity",
            "observed_value",
            "expected_value",
            "detail",
            now.alias("alerted_at"),
        )
    )


def warning_lines(
    alerts: DataFrame,
    results: DataFrame,
    as_of: datetime | str | Column,
    max_listed: int = MAX_LISTED,
    hint: str = "",
) -> DataFrame:
    """Banner lines (line_no, text) for today's alerts; none if all is well.

    Critical first, at most ``max_listed``, then a count of the rest (with
    ``hint`` on where to look) and of the checks that could not decide.
    """
    today = F.to_date(as_of_column(as_of))
    todays = (
        alerts.filter(F.to_date("alerted_at") == today)
        .select("severity", "check_name", "source_name", "detail")
        .distinct()
    )
    by_urgency = [
        F.when(F.col("severity") == "critical", 0).otherwise(1),
        F.col("check_name"),
        F.col("source_name"),
        F.col("detail").asc_nulls_last(),
        F.col("severity"),
    ]
    labels = F.create_map(*[F.lit(x) for pair in say.SEVERITY_LABELS.items() for x in pair])
    # The limit leaves a handful of rows, so numbering them in one task is fine.
    listed = todays.orderBy(*by_urgency).limit(max_listed).select(
        F.row_number().over(Window.orderBy(*by_urgency)).alias("line_no"),
        say.fill(
            say.WARNING,
            severity=F.coalesce(F.try_element_at(labels, F.col("severity")), F.col("severity")),
            check=F.col("check_name"),
            source=F.col("source_name"),
            detail=F.col("detail"),
        ).alias("text"),
    )
    overflow = (
        todays.groupBy()
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_listed)
        .select(
            F.lit(max_listed + 1).alias("line_no"),
            F.concat(
                say.fill(say.MORE_WARNINGS, n=F.col("n") - max_listed), F.lit(hint)
            ).alias("text"),
        )
    )
    undecided = (
        results.filter(
            (F.col("check_date") == today) & (F.col("status") == "insufficient_data")
        )
        .groupBy()
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > 0)
        .select(
            F.lit(max_listed + 2).alias("line_no"),
            say.fill(say.UNDECIDED, n=F.col("n")).alias("text"),
        )
    )
    return listed.unionByName(overflow).unionByName(undecided)
