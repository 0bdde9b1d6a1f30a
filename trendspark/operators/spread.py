"""Into how many parts a hot key is split."""

from __future__ import annotations

from pyspark.sql import DataFrame

MOST = 512
FEWEST = 8


def parts(df: DataFrame) -> int:
    """Follows the session's shuffle width, so larger clusters split further."""
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST, max(FEWEST, width))
