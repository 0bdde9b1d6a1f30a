"""Rankings per key that stay spread out when one key is hot."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from trendspark.operators.spread import parts
from trendspark.session import stored

# Above this many rows per key a ranking is taken in two steps.
ONE_STEP_LIMIT = 16
# Above this many they are no longer gathered per key at all.
GATHER_LIMIT = 100_000


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row per key under ``order``, which must be total.

    The rank filter is cut before the shuffle (WindowGroupLimit), so a hot key
    sends one row per map task.
    """
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")


def top_n_per_group(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    rank_col: str = "rank",
    per_row_limit: Column | None = None,
) -> DataFrame:
    """The first ``n`` rows per key, ranked from 1.

    A large ``n`` is taken in two steps: first per (key, slice of the input
    partitions), then per key over the survivors. No task then sees more than
    ``n`` rows of each of its map inputs, or ``n`` rows of each slice of a key,
    and the result does not depend on how rows were sliced. Beyond
    ``GATHER_LIMIT`` the rows are numbered in ranges instead. ``per_row_limit``
    tightens ``n`` to a column that is constant within a key.
    """
    if n > GATHER_LIMIT:
        ranked = number_within(df, keys, order, rank_col)
    else:
        if n > ONE_STEP_LIMIT:
            df = df.withColumn("_slice", F.spark_partition_id() % parts(df))
            w = Window.partitionBy(*keys, "_slice").orderBy(*order)
            df = df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n)
            df = df.drop("_rn", "_slice")
        w = Window.partitionBy(*keys).orderBy(*order)
        ranked = df.withColumn(rank_col, F.row_number().over(w))
    ranked = ranked.filter(F.col(rank_col) <= n)
    return ranked if per_row_limit is None else ranked.filter(F.col(rank_col) <= per_row_limit)


def top_of_each(
    df: DataFrame, keys: Sequence[str], slice_col: str, order: Sequence[Column], limit: Column, rank_col: str
) -> DataFrame:
    """The first ``limit`` rows per key, a column that is constant within a key, ranked from 1.

    First per (key, slice), on the partitioning that a join by both has left,
    then per key over the survivors. The cut is the same at any size of the
    limit, and the result does not depend on the slices.
    """
    first = Window.partitionBy(*keys, slice_col).orderBy(*order)
    survivors = df.withColumn(rank_col, F.row_number().over(first)).filter(F.col(rank_col) <= limit)
    w = Window.partitionBy(*keys).orderBy(*order)
    ranked = survivors.drop(slice_col).withColumn(rank_col, F.row_number().over(w))
    return ranked.filter(F.col(rank_col) <= limit)


def number_within(
    df: DataFrame, keys: Sequence[str], order: Sequence[Column], out: str
) -> DataFrame:
    """``row_number`` per key for keys of any size.

    The rows are cut into ranges of (keys, order), so a hot key spans as many
    ranges as its size asks for, and are numbered inside each range. Only the
    first key of a range can have rows in earlier ones: the counts to add are at
    most one row per range, which is what bounds their broadcast. The ranges
    come from a sample and are therefore stored before two steps rely on them.
    """
    ranged = df.repartitionByRange(*[F.col(k) for k in keys], *order)
    ranged = stored(ranged.withColumn("_range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy(*keys, "_range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy(*keys).orderBy("_range").rowsBetween(
        Window.unboundedPreceding, -1
    )
    offsets = sizes.select(*keys, "_range", F.sum("_n").over(earlier).alias("_before")).filter(
        "_before > 0"
    )
    inside = Window.partitionBy(*keys, "_range").orderBy(*order)
    return (
        ranged.withColumn("_rn", F.row_number().over(inside))
        .join(F.broadcast(offsets), [*keys, "_range"], "left")
        .withColumn(out, F.col("_rn") + F.coalesce("_before", F.lit(0)))
        .drop("_range", "_rn", "_before")
    )
