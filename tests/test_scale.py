"""Rankings and joins under skew, against brute force; plans that must hold."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendspark.operators import ingest
from trendspark.operators.joins import Dimension
from trendspark.operators.ordering import latest_per_key, number_within, top_n_per_group
from trendspark.schemas import RAW_ITEM

T0 = datetime(2026, 3, 1)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def skewed(spark):
    """Half of all rows under one key, spread over many partitions."""
    rng = random.Random(1)
    rows = [
        ("hot" if i % 2 else f"k{rng.randrange(20)}", i, rng.randrange(50), T0 + timedelta(minutes=i))
        for i in range(2000)
    ]
    df = spark.createDataFrame(rows, "key string, id bigint, value int, ts timestamp")
    return df.repartition(16, "id"), rows


@pytest.mark.parametrize("n", [3, 100, 200_000])
def test_top_n_per_group(skewed, n):
    df, rows = skewed
    got = top_n_per_group(df, ["key"], [F.col("value").desc(), F.col("id")], n)
    expected = set()
    for key in {r[0] for r in rows}:
        ranked = sorted((r for r in rows if r[0] == key), key=lambda r: (-r[2], r[1]))[:n]
        expected |= {(key, r[1], i + 1) for i, r in enumerate(ranked)}
    assert {(r.key, r.id, r["rank"]) for r in got.collect()} == expected
    assert ("WindowGroupLimit" in plan(got)) == (n < 1000)


def test_per_row_limit(skewed):
    df, rows = skewed
    df = df.withColumn("quota", F.when(F.col("key") == "hot", 4).otherwise(1))
    got = top_n_per_group(
        df, ["key"], [F.col("id")], 4, per_row_limit=F.col("quota")
    ).groupBy("key").count()
    assert {r.key: r["count"] for r in got.collect()} == {
        k: 4 if k == "hot" else 1 for k in {r[0] for r in rows}
    }


@pytest.mark.parametrize("coalesce", ["true", "false"])
def test_number_within_matches_row_number(skewed, coalesce):
    df, rows = skewed
    setting = "spark.sql.adaptive.coalescePartitions.enabled"
    df.sparkSession.conf.set(setting, coalesce)
    try:
        _check_numbers(df, rows)
    finally:
        df.sparkSession.conf.set(setting, "true")


def _check_numbers(df, rows):
    # One key holds half of all rows and spans several ranges.
    got = number_within(df, ["key"], [F.col("value"), F.col("id")], "no")
    expected = {}
    for key in {r[0] for r in rows}:
        for i, r in enumerate(sorted((r for r in rows if r[0] == key), key=lambda r: (r[2], r[1]))):
            expected[r[1]] = i + 1
    assert {r.id: r.no for r in got.collect()} == expected


def test_latest_is_cut_before_the_shuffle(skewed):
    df, _ = skewed
    got = latest_per_key(df, ["key"], [F.col("ts").desc(), F.col("id")])
    text = plan(got)
    assert text.count("WindowGroupLimit") == 2
    assert got.filter("key = 'hot'").first().id == 1999


def test_dimension_join_beyond_the_bound(skewed):
    df, rows = skewed
    spark = df.sparkSession
    keys = sorted({r[0] for r in rows})
    dim = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "key string, no int")
    small, large = Dimension(dim), Dimension(dim, max_rows=2)
    assert small.small and not large.small
    assert small.max_of("no") == len(keys) - 1 and large.max_of("no") is None
    for how in ("inner", "left", "left_semi", "left_anti"):
        one = small.join(df, ["key"], ["id"], how)
        two = large.join(df, ["key"], ["id"], how)
        assert sorted(one.collect()) == sorted(two.select(*one.columns).collect())
    # A hot key reaches many partitions.
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        used = large.join(df, ["key"], ["id"]).filter("key = 'hot'").select(
            F.spark_partition_id().alias("p")
        )
        assert used.distinct().count() >= 3
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def staged(spark, rows):
    """Rows of (native_id, hash, event hour or None, run)."""
    return spark.createDataFrame(
        [("s", i, h, "{}", None if e is None else T0 + timedelta(hours=e), T0, r) for i, h, e, r in rows],
        RAW_ITEM,
    )


def test_idempotent_rows_edge_cases(spark):
    batch = staged(
        spark, [("1", "a", 1, "x"), ("1", "a", 3, "x"), ("1", "a", None, "x"), ("1", "b", 0, "x"),
                ("2", "a", None, "x"), ("3", "a", 5, "x")],
    )
    done = staged(spark, [("3", "a", 5, "y"), ("3", "a", 5, "z"), ("9", "a", 5, "z")])
    new = ingest.idempotent_rows(batch, done)
    assert {(r.native_id, r.payload_hash, r.event_ts) for r in new.collect()} == {
        ("1", "a", T0 + timedelta(hours=3)), ("1", "b", T0), ("2", "a", None)
    }
    assert ingest.idempotent_rows(staged(spark, []), done).count() == 0
    assert ingest.idempotent_rows(new, new).count() == 0


def test_idempotent_rows_shuffles_each_side_once(spark, tmp_path):
    rows = staged(spark, [(str(i), "h", i, "x") for i in range(50)])
    rows.write.parquet(f"{tmp_path}/a")
    rows.write.parquet(f"{tmp_path}/b")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        new = ingest.idempotent_rows(
            spark.read.parquet(f"{tmp_path}/a"), spark.read.parquet(f"{tmp_path}/b")
        )
        text = plan(new)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert text.count("Exchange hashpartitioning") == 2
    # The committed side reads its key columns only.
    assert "ReadSchema: struct<source_name:string,native_id:string,payload_hash:string>" in text


def test_payload_versions_of_a_hot_item(spark):
    rows = [
        ("s", "hot" if i % 3 else f"c{i % 7}", f"h{i % 400}", "{}", T0, T0 + timedelta(minutes=7 * i), "r")
        for i in range(1500)
    ]
    got = ingest.payload_history(spark.createDataFrame(rows, RAW_ITEM))
    first = {}
    for _, item, h, _, _, fetched, _ in rows:
        first[(item, h)] = min(first.get((item, h), fetched), fetched)
    expected = {}
    for item in {k[0] for k in first}:
        ordered = sorted((t, h) for (i, h), t in first.items() if i == item)
        expected.update({(item, h): n + 1 for n, (_, h) in enumerate(ordered)})
    assert {(r.native_id, r.payload_hash): r.version_no for r in got.collect()} == expected


def test_a_small_batch_does_not_shuffle_the_stored_keys(spark, tmp_path, monkeypatch):
    staged(spark, [(str(i), "h", i, "x") for i in range(300)]).write.parquet(
        f"{tmp_path}/stored"
    )
    stored = spark.read.schema(RAW_ITEM).parquet(f"{tmp_path}/stored")
    batch = staged(spark, [("7", "h", 7, "y"), ("7", "h", 8, "y"), ("7", "new", 1, "y")])
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        known = ingest.known_keys(stored, batch)
        assert known.count() == 1
        assert "Exchange hashpartitioning" not in plan(known)
        new = ingest.idempotent_rows(batch, known).collect()
        monkeypatch.setattr(ingest, "MAX_BATCH_KEYS", 1)
        assert ingest.known_keys(stored, batch).count() == 300
        again = ingest.idempotent_rows(batch, ingest.known_keys(stored, batch)).collect()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
    assert [r.payload_hash for r in new] == [r.payload_hash for r in again] == ["new"]
