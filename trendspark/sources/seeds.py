"""Small configuration inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from trendspark.operators.embedding import read_profile
from trendspark.schemas import SOURCE_CONFIG

# Fixed values: (source, half_life_hours, digest_quota).
DEFAULT_SOURCES = [("arxiv", 72, 4), ("hackernews", 36, 4), ("github", 48, 2)]


def read_source_config(spark: SparkSession, path: str) -> DataFrame:
    """Half-life, quota and note per source from a CSV with a header; quotes are doubled inside quoted fields."""
    reader = spark.read.schema(SOURCE_CONFIG).option("header", True).option("escape", '"').option("multiLine", True)
    return reader.csv(path)


def default_source_config(spark: SparkSession) -> DataFrame:
    rows = [(*row, None) for row in DEFAULT_SOURCES]
    return spark.createDataFrame(rows, SOURCE_CONFIG)


def load_profile(spark: SparkSession, path: str) -> DataFrame:
    """Interest topics (key, label, text), one JSON object per line."""
    return read_profile(spark.read.schema("key string, label string, text string").json(path))

