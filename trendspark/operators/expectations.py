"""Table expectations as counts of violations."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from trendspark.functions.timeutil import as_of_column, hours_between


@dataclass(frozen=True)
class NotNull:
    column: str


@dataclass(frozen=True)
class Accepted:
    column: str
    values: tuple


@dataclass(frozen=True)
class Unique:
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Relationship:
    column: str
    to: DataFrame
    field: str


def check_expectations(df: DataFrame, rules: list) -> DataFrame:
    """One (rule, column, violations) row per rule.

    All row-wise rules share one scan and one aggregate; each uniqueness rule
    is one aggregation (violations are keys that repeat), each relationship one
    anti join (violations are rows without a match; NULL is no reference).
    """
    rowwise = [r for r in rules if isinstance(r, (NotNull, Accepted))]
    parts = []
    if rowwise:
        counts = df.agg(
            *[F.count(F.when(_broken(r), 1)).alias(f"r{i}") for i, r in enumerate(rowwise)]
        )
        rows = F.array(
            *[
                F.struct(
                    F.lit("not_null" if isinstance(r, NotNull) else "accepted_values").alias(
                        "rule"
                    ),
                    F.lit(r.column).alias("column"),
                    F.col(f"r{i}").alias("violations"),
                )
                for i, r in enumerate(rowwise)
            ]
        )
        parts.append(counts.select(F.inline(rows)))
    for rule in rules:
        if isinstance(rule, Unique):
            # One column: NULLs are the business of not_null.
            keyed = df.dropna(subset=rule.columns) if len(rule.columns) == 1 else df
            repeated = (
                keyed.groupBy(*rule.columns)
                .agg(F.count(F.lit(1)).alias("n"))
                .filter(F.col("n") > 1)
            )
            parts.append(_violations(repeated, "unique", ",".join(rule.columns)))
        elif isinstance(rule, Relationship):
            # Counted per key first, so a value that fills the table is one row.
            orphans = (
                df.filter(F.col(rule.column).isNotNull())
                .groupBy(F.col(rule.column).alias("_key"))
                .agg(F.count(F.lit(1)).alias("n"))
                .join(rule.to.select(F.col(rule.field).alias("_key")), "_key", "left_anti")
            )
            total = F.coalesce(F.sum("n"), F.lit(0))
            parts.append(_violations(orphans, "relationships", rule.column, total))
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def _broken(rule: NotNull | Accepted) -> Column:
    column = F.col(rule.column)
    if isinstance(rule, NotNull):
        return column.isNull()
    return column.isNotNull() & ~column.isin(*rule.values)


def _violations(
    df: DataFrame, rule: str, column: str, total: Column | None = None
) -> DataFrame:
    total = F.count(F.lit(1)) if total is None else total
    return df.groupBy().agg(total.alias("violations")).select(
        F.lit(rule).alias("rule"), F.lit(column).alias("column"), "violations"
    )


def source_freshness(
    df: DataFrame,
    loaded_at: str,
    as_of: datetime | str | Column,
    warn_hours: int = 26,
    error_hours: int = 48,
) -> DataFrame:
    """Age of a table's newest row against its limits: pass, warn or error."""
    newest = df.groupBy().agg(F.max(loaded_at).alias("max_loaded_at"))
    hours = hours_between(F.col("max_loaded_at"), as_of_column(as_of))
    return newest.select(
        "max_loaded_at",
        hours.alias("age_hours"),
        F.when(hours.isNull() | (hours > error_hours), "error")
        .when(hours > warn_hours, "warn")
        .otherwise("pass")
        .alias("status"),
    )
