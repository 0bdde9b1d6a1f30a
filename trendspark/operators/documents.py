"""Payloads to one document table, and its incremental maintenance."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, functions as F

from trendspark.functions.text import content_hash
from trendspark.operators.ordering import latest_per_key
from trendspark.schemas import FEED_PAYLOAD, ITEM_PAYLOAD

LOOKBACK = timedelta(days=2)

# Fixed value: where an item without a link of its own points.
ITEM_PAGE = "https://news.ycombinator.com/item?id="

# Column order shared by every parser.
PARSED = [
    "doc_id", "source", "source_name", "native_id", "title", "body", "url", "version",
    "authors", "categories", "published_at", "source_updated_at", "payload_hash", "fetched_at",
]


def latest_revision(raw: DataFrame, prefix: str) -> DataFrame:
    """The last fetched payload of each item of one kind of source.

    The key is ``native_id`` alone: an item listed under several source names
    is still one document.
    """
    order = [
        F.col("fetched_at").desc_nulls_last(),
        F.col("event_ts").desc_nulls_last(),
        F.col("payload_hash"),
        F.col("source_name"),
    ]
    return latest_per_key(raw.filter(F.col("source_name").startswith(prefix)), ["native_id"], order)


def _doc_id(source: str) -> Column:
    return F.concat(F.lit(f"{source}:"), F.col("native_id"))


def parse_feed(raw: DataFrame, source: str = "arxiv") -> DataFrame:
    """Feed entries: ISO timestamps, author and category lists, a version."""
    parsed = latest_revision(raw, f"{source}:").withColumn(
        "p", F.from_json("payload", FEED_PAYLOAD)
    )
    return parsed.select(
        _doc_id(source).alias("doc_id"),
        F.lit(source).alias("source"),
        "source_name",
        "native_id",
        F.col("p.title").alias("title"),
        F.col("p.summary").alias("body"),
        F.col("p.abs_url").alias("url"),
        F.col("p.version").alias("version"),
        F.col("p.authors").alias("authors"),
        F.col("p.categories").alias("categories"),
        F.col("p.published").try_cast("timestamp").alias("published_at"),
        F.col("p.updated").try_cast("timestamp").alias("source_updated_at"),
        "payload_hash",
        "fetched_at",
    )


def parse_items(raw: DataFrame, source: str = "hackernews", page: str = ITEM_PAGE) -> DataFrame:
    """Mutating items: epoch seconds, one author, a page to link to if no url."""
    parsed = latest_revision(raw, f"{source}:").withColumn(
        "p", F.from_json("payload", ITEM_PAYLOAD)
    )
    return parsed.select(
        _doc_id(source).alias("doc_id"),
        F.lit(source).alias("source"),
        "source_name",
        "native_id",
        F.col("p.title").alias("title"),
        F.col("p.text").alias("body"),
        F.coalesce(F.col("p.url"), F.concat(F.lit(page), F.col("native_id"))).alias("url"),
        F.lit(None).cast("string").alias("version"),
        F.array(F.col("p.by")).alias("authors"),
        F.array().cast("array<string>").alias("categories"),
        F.timestamp_seconds(F.col("p.time").try_cast("bigint")).alias("published_at"),
        F.lit(None).cast("timestamp").alias("source_updated_at"),
        "payload_hash",
        "fetched_at",
    )


def unify(*staged: DataFrame) -> DataFrame:
    """All sources in one table, with the hash of the text to embed."""
    union = staged[0].select(*PARSED)
    for other in staged[1:]:
        union = union.unionByName(other.select(*PARSED))
    return union.withColumn("content_hash", content_hash(F.col("title"), F.col("body")))


def lookback_bound(
    target: DataFrame,
    days: timedelta = LOOKBACK,
    target_column: str = "fetched_at",
    whole_days: bool = False,
) -> Column:
    """The fetch time after which stored rows are processed again.

    The target's newest row less a margin, 1970 for an empty target, as a scalar
    subquery. ``whole_days`` moves it to just before midnight, for results that
    are grouped by day.
    """
    newest = F.coalesce(F.max(target_column), F.timestamp_seconds(F.lit(0)))
    bound = newest - F.lit(days)
    if whole_days:
        bound = F.date_trunc("day", bound) - F.expr("interval 1 microsecond")
    return target.groupBy().agg(bound.alias("bound")).scalar()


def lookback(df: DataFrame, target: DataFrame, column: str = "fetched_at", **options) -> DataFrame:
    """Rows fetched after ``lookback_bound``.

    The bound is on fetch time: an old item that surfaced today must pass. The
    scan gets it as a pushed filter. Applied to stored revisions before
    ``latest_revision`` it keeps the outcome: the newest revision of an item is
    inside the lookback if any revision is.
    """
    return df.filter(F.col(column) > lookback_bound(target, **options))


def unmatched(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Target rows whose keys ``source`` lacks; no row of either side is compared field by field."""
    kept = target.join(source.select(*keys), keys, "left_anti")
    return kept.select(*target.columns)


def upsert(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """The target after replacing matched keys and adding new ones.

    ``source`` holds one row per key. Target rows without a match pass through
    a left anti join.
    """
    return unmatched(target, source, keys).unionByName(source.select(*target.columns))
