"""Streamed landing equals batch landing, also after a restart."""

from __future__ import annotations

from datetime import datetime, timedelta

from trendspark.operators.ingest import idempotent_rows
from trendspark.schemas import RAW_ITEM
from trendspark.sinks import Lake
from trendspark.streaming.ingest import ingest_stream, read_landed

T0 = datetime(2026, 3, 1)
KEY = ["source_name", "native_id", "payload_hash"]


def land(spark, path, rows):
    data = [
        ("s", i, h, "{}", T0 - timedelta(days=late), T0 + timedelta(hours=int(i)), "in")
        for i, h, late in rows
    ]
    spark.createDataFrame(data, RAW_ITEM).coalesce(1).write.mode("append").parquet(path)


def run(spark, path, lake, checkpoint):
    ingest_stream(read_landed(spark, path, max_files=1), lake, checkpoint).awaitTermination()


def rows(df):
    return df.select(*KEY).orderBy(*KEY).collect()


def test_stream_equals_batch_across_restarts(spark, tmp_path):
    landed, checkpoint = f"{tmp_path}/in", f"{tmp_path}/ck"
    lake = Lake(spark, f"{tmp_path}/lake")
    land(spark, landed, [("1", "a", 0), ("2", "a", 0), ("1", "a", 0)])
    land(spark, landed, [("1", "b", 0), ("2", "a", 0)])
    run(spark, landed, lake, checkpoint)
    # Very late rows are kept, known ones are not.
    land(spark, landed, [("3", "a", 400), ("1", "b", 0)])
    run(spark, landed, lake, checkpoint)
    run(spark, landed, lake, checkpoint)
    everything = spark.read.schema(RAW_ITEM).parquet(landed)
    empty = spark.createDataFrame([], RAW_ITEM)
    assert rows(lake.raw_items()) == rows(idempotent_rows(everything, empty))
    assert lake.read("run_log").count() == 3


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    landed = f"{tmp_path}/in"
    lake = Lake(spark, f"{tmp_path}/lake")
    land(spark, landed, [("1", "a", 0)])
    run(spark, landed, lake, f"{tmp_path}/ck1")
    # A lost checkpoint replays batch 0 under the same run id.
    run(spark, landed, lake, f"{tmp_path}/ck2")
    assert lake.raw_items().count() == 1 and lake.read("run_log").count() == 1
