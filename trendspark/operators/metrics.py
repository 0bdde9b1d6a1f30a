"""Daily engagement observations and the velocity made from them."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, Window, functions as F

from trendspark.functions.text import lenient_int
from trendspark.functions.timeutil import as_of_column, days_between


def item_observations(raw: DataFrame, source: str = "hackernews") -> DataFrame:
    """Score and comment count of every fetched revision of mutating items."""
    parsed = raw.filter(F.col("source_name").startswith(f"{source}:")).select(
        F.concat(F.lit(f"{source}:"), F.col("native_id")).alias("doc_id"),
        "fetched_at",
        F.from_json("payload", "score string, descendants string").alias("p"),
    )
    return parsed.select(
        "doc_id",
        "fetched_at",
        lenient_int(F.col("p.score")).alias("score"),
        lenient_int(F.col("p.descendants")).alias("comments"),
    )


def daily_last(observations: DataFrame) -> DataFrame:
    """The last known score and comments per (document, fetch date).

    Last, not largest: a score can fall. A NULL reading does not hide an earlier
    one of the same day. Equal fetch times are settled by the larger value.
    """

    def last_known(column: str) -> Column:
        reading = F.when(F.col(column).isNotNull(), F.struct("fetched_at", column))
        return F.max(reading).getField(column).alias(column)

    return observations.groupBy(
        "doc_id", F.to_date("fetched_at").alias("metric_date")
    ).agg(last_known("score"), last_known("comments"), F.max("fetched_at").alias("observed_at"))


def latest_delta(daily: DataFrame) -> DataFrame:
    """Each document's newest daily score and its change since the day before it.

    Newest first, the previous observation is the next row: one sort serves
    both the delta and the choice of the newest row.
    """
    w = Window.partitionBy("doc_id").orderBy(F.col("metric_date").desc())
    return (
        daily.select("doc_id", "metric_date", "score")
        .withColumn("observed_delta", F.col("score") - F.lead("score").over(w))
        .withColumn("_rn", F.row_number().over(w))
        .filter("_rn = 1")
        .select(
            "doc_id", "metric_date", F.col("score").alias("engagement_score"), "observed_delta"
        )
    )


def daily_delta(daily: DataFrame) -> DataFrame:
    """Change of the score against the previous observed day, for every day."""
    w = Window.partitionBy("doc_id").orderBy("metric_date")
    return daily.withColumn("observed_delta", F.col("score") - F.lag("score").over(w))


def velocity_per_day(as_of: datetime | str | Column) -> Column:
    """The larger of the observed change and the average rise since publishing.

    The first catches an old item that heats up, the second a new one with no
    earlier observation. Needs the columns of ``latest_delta`` and ``published_at``.
    """
    now = as_of_column(as_of)
    observed_on = F.coalesce(F.col("metric_date").cast("timestamp"), now)
    days = F.greatest(days_between(F.col("published_at"), observed_on), F.lit(1))
    average = F.col("engagement_score").cast("double") / days
    return F.greatest(
        F.coalesce(F.col("observed_delta").cast("double"), F.lit(0.0)),
        F.coalesce(average, F.lit(0.0)),
    )


def velocity(docs: DataFrame, latest: DataFrame, as_of: datetime | str | Column) -> DataFrame:
    joined = docs.select("doc_id", "published_at").join(latest, "doc_id", "left")
    return joined.withColumn("velocity_per_day", velocity_per_day(as_of))
