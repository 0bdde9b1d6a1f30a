"""Landed JSON items of a mutating source, and its listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendspark.operators.ingest import canonical_payload, payload_hash
from trendspark.schemas import LANDED_ITEM

# The rankings a source publishes.
LISTINGS = ("top", "best", "new")

PAYLOAD_COLUMNS = [
    "source", "hn_id", "title", "url", "text", "by", "score", "descendants", "time",
]


def read_items(spark: SparkSession, path: str) -> DataFrame:
    """One JSON object per line; a line that is no item has a NULL id."""
    return parse_items(spark.read.text(path))


def parse_items(
    lines: DataFrame,
    column: str = "value",
    schema: str = LANDED_ITEM,
    keep: list[str] | None = None,
    options: dict[str, str] | None = None,
) -> DataFrame:
    """The fields of JSON items, one row per line, after the columns to ``keep``.

    The generator keeps later filters above the parser. Pushed below, each of
    them would parse every line again.
    """
    item = F.from_json(column, schema, {"mode": "PERMISSIVE", **(options or {})})
    return lines.select(*(keep or []), F.inline(F.array(item)))


def failed_items(items: DataFrame) -> DataFrame:
    """How many lines held no item; one failure never stops the others."""
    return items.agg(F.count(F.when(F.col("id").isNull(), 1)).alias("failed"))


def stories(items: DataFrame, types: tuple[str, ...] = ("story",)) -> DataFrame:
    """Items of the wanted types that are neither dead nor deleted."""
    gone = F.coalesce("dead", F.lit(False)) | F.coalesce("deleted", F.lit(False))
    return items.filter(F.col("id").isNotNull() & F.col("type").isin(*types) & ~gone)


def item_rows(items: DataFrame, source_name: str | Column, source: str = "hackernews") -> DataFrame:
    """Staged rows of the kept items; a missing or zero time gives no event time."""
    fields = stories(items).select(
        F.lit(source).alias("source"), F.col("id").alias("hn_id"), "*"
    )
    staged = fields.select(
        F.lit(source_name).alias("source_name"),
        F.col("hn_id").cast("string").alias("native_id"),
        canonical_payload(PAYLOAD_COLUMNS).alias("payload"),
        F.when(F.col("time") != 0, F.timestamp_seconds("time")).alias("event_ts"),
    )
    return staged.withColumn("payload_hash", payload_hash(F.col("payload")))


def listing_ids(listings: DataFrame, listing: str, limit: int) -> DataFrame:
    """The first ``limit`` ids of a landed listing (listing, ids) with their rank."""
    if listing not in LISTINGS:
        raise ValueError(f"unknown listing {listing!r}, expected one of {LISTINGS}")
    head = F.slice("ids", 1, limit)
    return (
        listings.filter(F.col("listing") == listing)
        .select("listing", F.posexplode(head).alias("rank", "id"))
        .withColumn("rank", F.col("rank") + 1)
    )
