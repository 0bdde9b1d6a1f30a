"""Landed Atom pages to staged rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendspark.functions.text import collapse, split_version, strip
from trendspark.operators.ingest import canonical_payload, payload_hash

ENTRY = """
    id string, title string, summary string, published string, updated string,
    author array<struct<name: string>>,
    category array<struct<_term: string>>,
    link array<struct<_href: string, _title: string>>
"""

PAYLOAD_COLUMNS = [
    "source", "arxiv_id", "version", "title", "summary", "authors", "categories",
    "published", "updated", "abs_url", "pdf_url",
]


def read_feed(spark: SparkSession, path: str) -> DataFrame:
    """Entries of all pages under ``path``; the files are split by entry."""
    return spark.read.format("xml").option("rowTag", "entry").schema(ENTRY).load(path)


def feed_rows(entries: DataFrame, source_name: str | Column, source: str = "arxiv") -> DataFrame:
    """Staged rows of feed entries; entries without an id are dropped.

    The revision suffix leaves the id, so a revision updates its document.
    """
    abs_url = strip(F.coalesce("id", F.lit("")))
    base, version = split_version(F.substring_index(abs_url, "/", -1))
    empty = F.array().cast("array<string>")
    pdf = F.filter("link", lambda x: x["_title"] == "pdf")
    parsed = entries.select(
        F.lit(source_name).alias("source_name"),
        F.lit(source).alias("source"),
        base.alias("arxiv_id"),
        version.alias("version"),
        collapse(F.coalesce("title", F.lit(""))).alias("title"),
        strip(F.coalesce("summary", F.lit(""))).alias("summary"),
        F.coalesce(
            F.transform("author", lambda a: strip(F.coalesce(a["name"], F.lit("")))), empty
        ).alias("authors"),
        F.coalesce(
            F.filter(
                F.transform("category", lambda c: c["_term"]),
                lambda t: t.isNotNull() & (t != ""),
            ),
            empty,
        ).alias("categories"),
        F.col("published"),
        F.col("updated"),
        abs_url.alias("abs_url"),
        F.try_element_at(pdf, F.lit(1))["_href"].alias("pdf_url"),
    ).filter("arxiv_id != ''")
    staged = parsed.select(
        "source_name",
        F.col("arxiv_id").alias("native_id"),
        canonical_payload(PAYLOAD_COLUMNS).alias("payload"),
        F.col("published").try_cast("timestamp").alias("event_ts"),
    )
    return staged.withColumn("payload_hash", payload_hash(F.col("payload")))
