"""Joins of a large table with a dimension on a low-cardinality key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from trendspark.operators.spread import parts

MAX_DIM_ROWS = 10_000
MAX_DIM_BYTES = 64 * 1024 * 1024


class Dimension:
    """A table that is broadcast if measured small, and salted otherwise.

    The measure reads at most ``max_rows + 1`` rows. Within the bounds those
    rows are kept, so the table is evaluated once however often it is joined.
    """

    def __init__(
        self, df: DataFrame, max_rows: int = MAX_DIM_ROWS, max_bytes: int = MAX_DIM_BYTES
    ):
        sample = df.limit(max_rows + 1).toArrow()
        self.small = sample.num_rows <= max_rows and sample.nbytes <= max_bytes
        self.rows = sample if self.small else None
        self.df = (
            df.sparkSession.createDataFrame(sample, schema=df.schema) if self.small else df
        )

    def max_of(self, column: str) -> int | None:
        """Largest value of a column, known only for a small table."""
        if not self.small or self.rows.num_rows == 0:
            return None
        known = [v for v in self.rows.column(column).to_pylist() if v is not None]
        return max(known, default=None)

    def join(
        self, fact: DataFrame, on: Sequence[str], spread: Sequence[str], how: str = "inner"
    ) -> DataFrame:
        """Join ``fact`` to the dimension on ``on``.

        Beyond the broadcast bound each dimension row is copied once per salt
        and ``fact`` picks a copy by a hash of ``spread``: a value of ``on`` that
        holds most of the rows is joined by many partitions, not one.
        An empty ``spread`` says that ``on`` is unique in ``fact``; then a plain
        join spreads well enough.
        """
        if self.small:
            return fact.join(F.broadcast(self.df), list(on), how)
        if not spread:
            return fact.join(self.df, list(on), how)
        salts = parts(fact)
        copies = self.df.withColumn(
            "_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))
        )
        salted = fact.withColumn(
            "_salt", F.pmod(F.xxhash64(*spread), F.lit(salts)).cast("int")
        )
        return salted.join(copies, [*on, "_salt"], how).drop("_salt")


def spread_join(
    fact: DataFrame, dimension: DataFrame, on: Sequence[str], spread: Sequence[str], slice_col: str
) -> DataFrame:
    """Join ``fact`` to a dimension on a low-cardinality key, slice by slice of the key.

    Each dimension row is copied once per slice and a fact row meets the copy of
    the slice that a hash of ``spread`` gives it, so a key that holds most of the
    rows is joined by many partitions. The slice stays as ``slice_col``, for what
    goes on per (key, slice): that uses the shuffle of the join, which is why the
    copies are never broadcast. Nothing is read to decide this.
    """
    slices = parts(fact)
    copies = dimension.withColumn(slice_col, F.explode(F.sequence(F.lit(0), F.lit(slices - 1))))
    sliced = fact.withColumn(slice_col, F.pmod(F.xxhash64(*spread), F.lit(slices)).cast("int"))
    return sliced.join(copies.hint("merge"), [*on, slice_col])


#: Bits of the bitmap of ``maybe_among``; the aggregate that builds it has this many.
BITMAP_BITS = 32_768


def maybe_among(large: DataFrame, few: DataFrame, key: str) -> DataFrame:
    """``large`` without most of the rows whose key is not in ``few``; an exact join has to follow.

    A filter on one bit per key hash. It is 4 KB whatever ``few`` holds, and lets
    one in 32,768 / n other keys pass if that holds n keys.
    """
    place = F.pmod(F.xxhash64(key), F.lit(BITMAP_BITS))
    bits = few.groupBy().agg(F.bitmap_construct_agg(place).alias("bits")).scalar()
    # A byte of the bitmap as a number: binary has no access by place but through its hex digits.
    byte = F.conv(F.hex(F.substring(bits, (F.floor(place / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.call_function("shiftright", byte, (place % 8).cast("int")).bitwiseAND(1) == 1
    return large.filter(hit)
