"""From landed items to a delivered digest, twice."""

from __future__ import annotations

import json
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from trendspark.operators.embedding import hashing_encoder, read_profile
from trendspark.operators.ingest import payload_hash
from trendspark.plans import build, collect
from trendspark.sources.items import item_rows, parse_items
from trendspark.sources.seeds import default_source_config

NOW = datetime(2026, 3, 10, 6)
MODEL = "hash-64"
TOPICS = [
    ("storage", "Storage", "columnar table format parquet lake storage engine"),
    ("robots", "Robots", "robot arm motion planning grasp control"),
]
TEXTS = ["parquet table format for the lake", "robot arm grasp planning", "cooking pasta at home"]


def stories(spark, scores):
    lines = [
        json.dumps(
            {
                "id": i, "type": "story", "title": TEXTS[i % 3], "text": f"{TEXTS[i % 3]} no {i}",
                "by": "x", "score": score, "descendants": 1,
                "time": int((NOW - timedelta(hours=i)).timestamp()),
            }
        )
        for i, score in enumerate(scores, 1)
    ]
    parsed = parse_items(spark.createDataFrame([(x,) for x in lines], "value string"))
    return item_rows(parsed, "hackernews:top")


def entries(spark, n):
    rows = [
        (
            "arxiv:cs.DB", f"2603.{i:05d}",
            json.dumps(
                {
                    "title": f"{TEXTS[i % 3]} paper", "summary": TEXTS[i % 3],
                    "abs_url": f"https://x/{i}",
                    "published": (NOW - timedelta(hours=2 + i)).strftime("%Y-%m-%dT%H:%M:%SZ"),
                }
            ),
            NOW - timedelta(hours=2 + i),
        )
        for i in range(n)
    ]
    df = spark.createDataFrame(
        rows, "source_name string, native_id string, payload string, event_ts timestamp"
    )
    return df.withColumn("payload_hash", payload_hash(F.col("payload")))


def refresh(lake, as_of):
    spark = lake.spark
    profile = read_profile(
        spark.createDataFrame(TOPICS, "key string, label string, text string")
    )
    build.refresh_documents(lake)
    build.refresh_metrics(lake)
    build.embed_backlog(lake, hashing_encoder(), MODEL, as_of)
    build.sync_interests(lake, profile, hashing_encoder(), MODEL, as_of)
    build.refresh_ranking(lake, default_source_config(spark), MODEL, as_of, floor=0.1)
    build.refresh_quality(lake, as_of)


def picked(lake, as_of):
    return [(r.source, r.doc_id) for r in build.open_items(lake, as_of).collect()]


def test_two_days(spark, lake):
    sources = spark.createDataFrame([("arxiv:cs.DB",)], "source_name string")
    collect.collect_full(lake, stories(spark, [10] * 9), "items-1", NOW)
    collect.collect_by_cursor(lake, entries(spark, 9), sources, "feed-1", NOW)
    refresh(lake, NOW)
    first = picked(lake, NOW)
    assert len([x for x in first if x[0] == "arxiv"]) == 4
    assert len([x for x in first if x[0] == "hackernews"]) == 4
    labels = {
        r.doc_id: r.best_interest_label for r in lake.read("document_score").collect()
    }
    assert labels["arxiv:2603.00000"] == "Storage" and labels["arxiv:2603.00001"] == "Robots"

    # Refreshing again changes nothing but the alerts' cooldown.
    alerts = lake.read("alert").count()
    refresh(lake, NOW)
    assert picked(lake, NOW) == first
    assert lake.read("embedding").count() == 18 and lake.read("alert").count() == alerts

    build.record_delivery(lake, build.open_items(lake, NOW), "sent", NOW)
    assert picked(lake, NOW) == []

    # The next day an item took off; what was sent stays out.
    later = NOW + timedelta(days=1)
    risen = [10] * 8 + [4000]
    collect.collect_full(lake, stories(spark, risen), "items-2", later)
    collect.collect_by_cursor(lake, entries(spark, 9), sources, "feed-2", later)
    assert lake.raw_items().count() == 19
    refresh(lake, later)
    second = picked(lake, later)
    assert not set(second) & set(first)
    boosts = {r.doc_id: r.engagement_boost for r in lake.read("document_score").collect()}
    assert boosts["hackernews:9"] == 1.0
    assert lake.read("digest_dispatch").select("digest_date").distinct().count() == 2
    statuses = {
        (r.check_name, r.source_name): r.status for r in lake.read("check_result").collect()
    }
    assert statuses[("ingest_error", "hackernews:top")] == "ok"
    assert statuses[("freshness", "arxiv:cs.DB")] == "ok"
    assert statuses[("volume_drop", "arxiv:cs.DB")] == "insufficient_data"
    assert statuses[("watermark_stall", "arxiv:cs.DB")] == "ok"
