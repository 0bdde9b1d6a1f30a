"""The landing step as a stream: files in, idempotent micro-batches out."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from trendspark.operators.ingest import idempotent_rows, known_keys, same_event_times
from trendspark.schemas import RAW_ITEM
from trendspark.sinks import Lake


def read_landed(
    spark: SparkSession, path: str, schema: str = RAW_ITEM, max_files: int | None = None
) -> DataFrame:
    """New parquet files under ``path``; ``max_files`` bounds one micro-batch."""
    reader = spark.readStream.schema(schema)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def _now() -> datetime:
    return datetime.now(timezone.utc)


def ingest_stream(
    staged: DataFrame,
    lake: Lake,
    checkpoint: str,
    event_time_in_payload: bool = False,
    clock: Callable[[], datetime] = _now,
) -> StreamingQuery:
    """Land a stream of staged rows; late rows are accepted like any other.

    ``fetched_at`` is the time of the batch, not what a producer wrote: it is
    the time of the commit that later steps look back on, so a row that arrives
    days late is seen by them like a new one.
    Each micro-batch is one run named after its batch id. A replayed batch
    compares against committed runs other than itself and replaces its own
    rows, so restarting after a failure neither loses nor repeats a row. Set
    ``event_time_in_payload`` if a payload determines its event time: a batch is
    then compared with the stored rows of its event-time range only.
    """

    def land(batch: DataFrame, batch_id: int) -> None:
        run_id = f"stream-{batch_id:012d}"
        if lake.logged(run_id):
            return
        landed_at = F.lit(clock())
        batch = batch.withColumn("fetched_at", landed_at)
        batch.persist()
        try:
            if batch.isEmpty():
                return
            committed = lake.raw_items(except_run=run_id)
            if event_time_in_payload:
                committed = same_event_times(committed, batch)
            fresh = idempotent_rows(batch, known_keys(committed, batch))
            lake.write_run(fresh, run_id)
            written = lake.read("raw_item").filter(F.col("run_id") == run_id)
            lake.append("run_log", _log_rows(batch, written, run_id, landed_at))
        finally:
            batch.unpersist()

    return (
        staged.writeStream.foreachBatch(land)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def _log_rows(batch: DataFrame, written: DataFrame, run_id: str, landed_at: Column) -> DataFrame:
    new = written.groupBy("source_name").agg(F.count(F.lit(1)).alias("rows_new"))
    none = F.lit(None).cast("timestamp")
    return (
        batch.groupBy("source_name")
        .agg(F.count(F.lit(1)).alias("rows_fetched"))
        .join(new, "source_name", "left")
        .select(
            F.lit(run_id).alias("run_id"),
            "source_name",
            landed_at.alias("started_at"),
            landed_at.alias("ended_at"),
            F.lit("ok").alias("status"),
            "rows_fetched",
            F.coalesce("rows_new", F.lit(0)).alias("rows_new"),
            none.alias("watermark_before"),
            none.alias("watermark_after"),
            F.lit(None).cast("string").alias("error_msg"),
        )
    )
