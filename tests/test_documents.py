"""Parsing, incremental merge, daily metrics."""

from __future__ import annotations

import json
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendspark import sinks
from trendspark.functions.text import lenient_int, split_version
from trendspark.functions.timeutil import day_type, days_between, hours_between
from trendspark.operators import documents, metrics
from trendspark.plans.build import refresh_documents, refresh_metrics
from trendspark.schemas import RAW_ITEM
from trendspark.sinks import Lake

T0 = datetime(2026, 3, 1, 8)


def raw(spark, *rows):
    """Rows of (source_name, native_id, payload dict, fetched_at)."""
    data = [
        (s, n, str(hash((n, json.dumps(p, sort_keys=True)))), json.dumps(p), t, t, "r")
        for s, n, p, t in rows
    ]
    return spark.createDataFrame(data, RAW_ITEM)


def log_run(lake, run_id, df):
    """Store rows as one committed run."""
    lake.write_run(df, run_id)
    log = df.groupBy("source_name").agg(F.max("fetched_at").alias("t")).select(
        F.lit(run_id).alias("run_id"), "source_name", F.col("t").alias("started_at"),
        F.col("t").alias("ended_at"), F.lit("ok").alias("status"),
        *[F.lit(0).cast("bigint").alias(c) for c in ("rows_fetched", "rows_new")],
        *[F.lit(None).cast("timestamp").alias(c) for c in ("watermark_before", "watermark_after")],
        F.lit(None).cast("string").alias("error_msg"),
    )
    lake.append("run_log", log)


def test_cross_listed_item_is_one_document(spark):
    df = raw(
        spark,
        ("arxiv:cs.RO", "1", {"title": "old"}, T0),
        ("arxiv:cs.SE", "1", {"title": "new"}, T0 + timedelta(hours=1)),
        ("hackernews:top", "1", {"title": "other"}, T0),
    )
    rows = documents.parse_feed(df).collect()
    assert [(r.doc_id, r.title) for r in rows] == [("arxiv:1", "new")]


def test_feed_fields(spark):
    payload = {
        "title": "T", "summary": "S", "abs_url": "u", "version": "v1", "authors": ["a", "b"],
        "categories": [], "published": "2026-01-05T10:00:00Z", "updated": "nonsense",
    }
    row = documents.parse_feed(raw(spark, ("arxiv:x", "1", payload, T0))).first()
    assert (row.body, row.url, row.version) == ("S", "u", "v1")
    assert (row.authors, row.categories) == (["a", "b"], [])
    assert row.published_at == datetime(2026, 1, 5, 10) and row.source_updated_at is None


def test_item_fields_with_gaps(spark):
    df = raw(
        spark,
        ("hackernews:top", "1", {"title": "t", "time": 1_700_000_000, "by": "x"}, T0),
        ("hackernews:top", "2", {"title": "t", "url": "u", "time": "soon"}, T0),
    )
    rows = {r.native_id: r for r in documents.parse_items(df).collect()}
    assert rows["1"].url == "https://news.ycombinator.com/item?id=1"
    assert rows["1"].authors == ["x"]
    assert rows["1"].published_at == datetime(2023, 11, 14, 22, 13, 20)
    assert rows["2"].url == "u" and rows["2"].published_at is None
    assert rows["2"].authors == [None] and rows["2"].categories == []


def test_content_hash_ignores_the_score(spark):
    def hashed(payload):
        return documents.unify(
            documents.parse_items(raw(spark, ("hackernews:top", "1", payload, T0)))
        ).first()

    a = hashed({"title": "t", "text": "b", "score": 1})
    b = hashed({"title": "t", "text": "b", "score": 2})
    c = hashed({"title": "t", "text": "b ", "score": 1})
    assert a.content_hash == b.content_hash != c.content_hash
    assert a.payload_hash != b.payload_hash


def test_incremental_documents_equal_a_full_build(spark, tmp_path):
    batches = [
        raw(
            spark,
            ("arxiv:x", "1", {"title": "one"}, T0),
            ("hackernews:top", "1", {"title": "one", "score": 1}, T0),
        ),
        raw(spark, ("arxiv:x", "2", {"title": "two"}, T0 + timedelta(days=3))),
        # An old event that surfaced today, and a changed title.
        raw(
            spark,
            ("arxiv:x", "1", {"title": "one v2"}, T0 + timedelta(days=6)),
            ("hackernews:top", "9", {"title": "late"}, T0 + timedelta(days=6)),
        ),
    ]
    step, full = Lake(spark, f"{tmp_path}/s", 1), Lake(spark, f"{tmp_path}/f", 9)
    for i, batch in enumerate(batches):
        log_run(step, f"r{i}", batch)
        refresh_documents(step)
        log_run(full, f"r{i}", batch)
    refresh_documents(full)
    columns = ["doc_id", "title", "content_hash", "fetched_at"]
    read = lambda lake: lake.read("document").select(*columns).orderBy("doc_id").collect()
    assert read(step) == read(full)
    assert [r.title for r in read(step)] == ["one v2", "two", "one", "late"]
    refresh_documents(step)
    assert read(step) == read(full)


@pytest.mark.parametrize("listed", [10_000, 0])
def test_upsert_rewrites_only_the_touched_blocks(spark, lake, monkeypatch, listed):
    monkeypatch.setattr(sinks, "MAX_LISTED_PARTS", listed)
    schema = lake.read("document").schema
    blank = {f.name: None for f in schema.fields}

    def put(*rows):
        data = [tuple({**blank, "doc_id": i, "title": t}.values()) for i, t in rows]
        lake.write_upsert("document", spark.createDataFrame(data, schema), ["doc_id"])

    put(*[(str(i), f"t{i}") for i in range(40)])
    before = _files(lake, "document")
    put(("7", "changed"))
    rows = {r.doc_id: r.title for r in lake.read("document").collect()}
    assert len(rows) == 40 and rows["7"] == "changed" and rows["8"] == "t8"
    assert _rewritten(before, _files(lake, "document")) == {"block=b"}
    assert "block" not in lake.read("document").columns


def test_metrics_rewrite_only_the_touched_days(spark, lake):
    schema = "doc_id string, metric_date date, score int, comments int, observed_at timestamp"
    days = [date(2026, 3, d) for d in (1, 2, 3)]
    keys = ["doc_id", "metric_date"]
    data = [(str(i), d, i, 0, T0) for i in range(10) for d in days]
    lake.write_upsert("metric_daily", spark.createDataFrame(data, schema), keys)
    before = _files(lake, "metric_daily")
    changed = [("7", days[2], 700, 1, T0), ("new", days[2], 1, 1, T0)]
    lake.write_upsert("metric_daily", spark.createDataFrame(changed, schema), keys)
    rows = {(r.doc_id, r.metric_date): r.score for r in lake.read("metric_daily").collect()}
    assert len(rows) == 31 and rows[("7", days[2])] == 700 and rows[("7", days[1])] == 7
    assert _rewritten(before, _files(lake, "metric_daily")) == {"metric_date=2026-03-03"}


def _files(lake, table):
    listing = lake.spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet")
    files = listing.option("recursiveFileLookup", True).load(lake.path(table))
    return {r.path: r.modificationTime for r in files.collect()}


def _rewritten(before, after):
    gone = {path for path in before if after.get(path) != before[path]}
    return {path.rsplit("/", 2)[-2] for path in gone}


def test_empty_target_passes_everything(spark, lake):
    df = raw(spark, ("arxiv:x", "1", {}, datetime(1999, 1, 1)))
    assert documents.lookback(df, lake.read("document")).count() == 1


def observe(spark, *rows):
    return spark.createDataFrame(
        rows, "doc_id string, fetched_at timestamp, score int, comments int"
    )


def test_daily_value_is_the_last_known_not_the_largest(spark):
    h = lambda n: T0 + timedelta(hours=n)
    df = observe(
        spark, ("d", h(0), 10, 1), ("d", h(1), 50, None), ("d", h(2), 30, None), ("d", h(3), None, 7)
    )
    row = metrics.daily_last(df).first()
    assert (row.score, row.comments, row.observed_at) == (30, 7, h(3))


def test_delta_uses_the_previous_observed_day(spark):
    daily = spark.createDataFrame(
        [("a", date(2026, 3, 1), 5), ("a", date(2026, 3, 4), 3), ("b", date(2026, 3, 1), 8)],
        "doc_id string, metric_date date, score int",
    )
    rows = {r.doc_id: r for r in metrics.latest_delta(daily).collect()}
    assert (rows["a"].engagement_score, rows["a"].observed_delta) == (3, -2)
    assert rows["b"].observed_delta is None
    assert metrics.daily_delta(daily).filter("observed_delta = -2").count() == 1


def test_velocity_takes_the_larger_signal_and_floors_the_days(spark):
    published = datetime(2026, 3, 1, 23)
    df = spark.createDataFrame(
        [
            ("same day", published, date(2026, 3, 1), 40, None),
            ("average", published, date(2026, 3, 5), 40, -3),
            ("observed", published, date(2026, 3, 5), 40, 25),
            ("no metric", published, None, None, None),
        ],
        "doc_id string, published_at timestamp, metric_date date, engagement_score int, "
        "observed_delta int",
    )
    speed = {r.doc_id: r.v for r in df.select("doc_id", metrics.velocity_per_day("2026-03-09").alias("v")).collect()}
    assert speed == {"same day": 40.0, "average": 10.0, "observed": 25.0, "no metric": 0.0}


def test_refreshed_metrics_are_stable(spark, lake):
    df = raw(
        spark,
        ("hackernews:top", "1", {"score": 5, "descendants": 2}, T0),
        ("hackernews:top", "1", {"score": 9}, T0 + timedelta(hours=2)),
        ("hackernews:top", "2", {"score": "abc"}, T0),
    )
    log_run(lake, "r0", df)
    refresh_metrics(lake)
    rows = lake.read("metric_daily").orderBy("doc_id").collect()
    assert [(r.doc_id, r.score, r.comments) for r in rows] == [
        ("hackernews:1", 9, 2), ("hackernews:2", None, None)
    ]
    refresh_metrics(lake)
    assert lake.read("metric_daily").orderBy("doc_id").collect() == rows


def test_small_expressions(spark):
    df = spark.createDataFrame([("2601.00001v2",), ("plain",), ("v3",)], "id string")
    base, version = split_version(F.col("id"))
    assert [tuple(r) for r in df.select(base, version).collect()] == [
        ("2601.00001", "v2"), ("plain", None), ("", "v3")
    ]
    a, b = F.lit("2026-03-01 00:59:00").cast("timestamp"), F.lit("2026-03-01 01:01:00").cast("timestamp")
    row = spark.range(1).select(
        hours_between(a, b).alias("h"),
        days_between(a, F.lit("2026-03-02 00:01:00").cast("timestamp")).alias("d"),
        day_type(F.lit("2026-03-01").cast("date")).alias("sunday"),
        day_type(F.lit("2026-03-02").cast("date")).alias("monday"),
        lenient_int(F.lit("3.7")).alias("rounded"),
        lenient_int(F.lit("abc")).alias("bad"),
    ).first()
    assert tuple(row) == (1, 1, "weekend", "weekday", 4, None)
