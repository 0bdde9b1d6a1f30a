"""Landed files of many sources, ``source_name=...`` folders, read together.

A source with a record that cannot be read fails as a whole: nothing of it lands and its
cursor stays, so the next run reads the same window again. The others are not held back.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendspark import messages as say
from trendspark.schemas import LANDED_ITEM
from trendspark.sources.feeds import ENTRY, feed_rows
from trendspark.sources.items import item_rows, parse_items

BROKEN = "broken"
NO_RECORD = "broken IS NOT NULL"


def landed_feeds(spark: SparkSession, path: str) -> DataFrame:
    """Entries of the pages of all sources; where a page cannot be read on, ``broken`` has an id or its text."""
    entries = (
        spark.read.format("xml")
        .option("rowTag", "entry")
        .option("columnNameOfCorruptRecord", BROKEN)
        .schema(f"{ENTRY}, {BROKEN} string, source_name string")
        .load(path)
    )
    # Spark reads no file for its unreadable records alone, so a field is read with them.
    return entries.withColumn(BROKEN, F.when(F.col(BROKEN).isNotNull(), F.coalesce("id", BROKEN)))


def landed_items(spark: SparkSession, path: str) -> DataFrame:
    """Items of all sources, one JSON object per line; a line that is none is in ``broken``. Blank lines are no records."""
    lines = spark.read.schema("value string, source_name string").text(path).filter(F.trim("value") != "")
    return parse_items(
        lines, schema=f"{LANDED_ITEM}, {BROKEN} string", keep=["source_name"], options={"columnNameOfCorruptRecord": BROKEN}
    )


def failures(*records: DataFrame) -> DataFrame:
    """(source_name, error_msg) of each source with a record that cannot be read."""
    found = [df.filter(NO_RECORD).groupBy("source_name").agg(F.first(F.lit(say.UNREADABLE)).alias("error_msg")) for df in records]
    union = found[0]
    for df in found[1:]:
        union = union.unionByName(df)
    return union.groupBy("source_name").agg(F.min("error_msg").alias("error_msg"))


def readable_rows(feeds: DataFrame, items: DataFrame) -> DataFrame:
    """Staged rows of the records that can be read."""
    name = F.col("source_name")
    whole = f"NOT ({NO_RECORD})"
    return feed_rows(feeds.filter(whole), name).unionByName(item_rows(items.filter(whole), name))
