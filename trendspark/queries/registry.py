"""All registered queries and the SQL each is compared with."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from trendspark.queries import checks, incremental, lake, rank

Query = Callable[[SparkSession, str], DataFrame]


def _naive_times(query: Query) -> Query:
    """Instants leave as UTC wall-clock times, as the given tables hold them."""

    @wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = query(spark, sf_dir)
        return df.select(
            *[
                F.col(f.name).cast("timestamp_ntz").alias(f.name)
                if isinstance(f.dataType, T.TimestampType)
                else F.col(f.name)
                for f in df.schema.fields
            ]
        )

    return run


def all_queries() -> dict[str, Query]:
    merged = {**incremental.QUERIES, **rank.QUERIES, **checks.QUERIES, **lake.QUERIES}
    return {name: _naive_times(query) for name, query in merged.items()}


def all_oracles() -> dict[str, str]:
    return {**incremental.ORACLE, **rank.ORACLE, **checks.ORACLE, **lake.ORACLE}
