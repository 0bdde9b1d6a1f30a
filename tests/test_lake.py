"""Merges that die, rows that arrive late, emptied partitions, and plans that start no job."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry_point
from trendspark.operators import embedding, ingest, ranking
from trendspark.operators.joins import maybe_among
from trendspark.plans.build import refresh_documents
from trendspark.plans.collect import collect_by_cursor
from trendspark.schemas import RAW_ITEM
from trendspark.sinks import Lake
from trendspark.streaming.ingest import ingest_stream, read_landed

T0 = datetime(2026, 3, 1)


def docs_of(spark, lake, rows):
    blank = dict.fromkeys(lake.columns("document"))
    data = [tuple({**blank, "doc_id": i, "title": t}.values()) for i, t in rows]
    return spark.createDataFrame(data, lake.read("document").schema)


def titles(lake):
    return {r.doc_id: r.title for r in lake.read("document").collect()}


def test_a_merge_that_dies_leaves_the_old_revision(spark, lake, monkeypatch):
    lake.write_upsert("document", docs_of(spark, lake, [("1", "a"), ("2", "b"), ("x7", "c")]), ["doc_id"])
    before = titles(lake)

    def die(markers):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(lake, "_publish", die)
        for rows in ([("1", "changed"), ("9", "new")], [("x7", "other")]):
            with pytest.raises(RuntimeError):
                lake.write_upsert("document", docs_of(spark, lake, rows), ["doc_id"])
            assert titles(lake) == before
    # What the dead merge wrote under the same revision is not mixed in.
    lake.write_upsert("document", docs_of(spark, lake, [("1", "again")]), ["doc_id"])
    assert titles(lake) == {**before, "1": "again"}
    lake.write_upsert("document", docs_of(spark, lake, []), ["doc_id"])
    assert titles(lake) == {**before, "1": "again"}


def test_ids_without_order_go_to_a_bounded_number_of_blocks(spark, tmp_path):
    lake = Lake(spark, str(tmp_path / "lake"))
    ids = spark.range(5000).select(F.md5(F.col("id").cast("string")).alias("doc_id"))
    blocks = ids.select(lake._block("doc_id").alias("b")).distinct().count()
    assert blocks <= 1024
    numbered = spark.createDataFrame([("hackernews:41234567",), ("arxiv:2401.01234v2",), ("7",)], "doc_id string")
    assert [r.b for r in numbered.select(lake._block("doc_id").alias("b")).collect()] == [
        "bhackernews-4123", "barxiv-2401.012", "b",
    ]


def test_a_row_three_days_behind_reaches_the_documents(spark, tmp_path):
    lake, landed = Lake(spark, f"{tmp_path}/lake"), f"{tmp_path}/in"

    def land(item, title, fetched, at):
        payload = f'{{"title":"{title}"}}'
        rows = [("hackernews:top", item, title, payload, fetched, fetched, "in")]
        spark.createDataFrame(rows, RAW_ITEM).coalesce(1).write.mode("append").parquet(landed)
        stream = ingest_stream(read_landed(spark, landed), lake, f"{tmp_path}/ck", clock=lambda: at)
        stream.awaitTermination()
        refresh_documents(lake)

    land("1", "first", T0, T0)
    land("2", "behind", T0 - timedelta(days=3), T0 + timedelta(hours=1))
    assert set(titles(lake).values()) == {"first", "behind"}
    ended = {r.ended_at for r in lake.read("run_log").collect()}
    assert ended == {T0, T0 + timedelta(hours=1)}
    assert {r.fetched_at for r in lake.raw_items().collect()} == ended


def test_a_named_partition_without_rows_is_emptied(spark, lake):
    blank = dict.fromkeys(lake.columns("digest_dispatch"))
    days = [date(2026, 3, d) for d in (1, 2, 3)]
    data = [tuple({**blank, "doc_id": "x", "digest_date": d}.values()) for d in days]
    rows = spark.createDataFrame(data, lake.read("digest_dispatch").schema)
    lake.replace_partitions("digest_dispatch", rows, "digest_date")
    lake.replace_partitions("digest_dispatch", rows.filter(F.col("digest_date") == days[2]), "digest_date", days[1:])
    assert {r.digest_date for r in lake.read("digest_dispatch").collect()} == {days[0], days[2]}


def runs(spark, rows):
    data = [(s, f"{i:04d}", T0 + timedelta(minutes=m), st) for i, (s, m, st) in enumerate(rows)]
    log = spark.createDataFrame(data, "source_name string, run_id string, started_at timestamp, status string")
    return log.withColumns({"ended_at": F.col("started_at"), "watermark_after": F.col("started_at")})


def test_failures_are_counted_over_hours(spark):
    log = runs(
        spark,
        [("a", 0, "ok"), ("a", 10, "error"), ("a", 70, "error"), ("a", 71, "error"), ("a", 300, "error")]
        + [("b", 0, "error"), ("b", 5, "stalled"), ("b", 6, "error"), ("b", 400, "other")]
        + [("c", m, "error") for m in range(0, 900, 50)]
        + [("d", 0, "error"), ("d", 0, "ok"), ("d", 600, "ok")],
    )
    state = ingest.watermark_state(log)
    assert {r.source_name: r.consecutive_fail for r in state.collect()} == {"a": 4, "b": 1, "c": 18, "d": 0}
    plan = state._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan


def test_any_number_of_topics_gives_the_same_best(spark):
    vec = lambda seed, n: F.transform(
        F.sequence(F.lit(1), F.lit(n)), lambda i: (F.xxhash64(F.lit(seed), F.col("id"), i) % 1000).cast("float")
    )
    docs = spark.range(300).select(F.col("id").cast("string").alias("doc_id"), F.lit("h").alias("content_hash"))
    emb = spark.range(300).select(
        F.col("id").cast("string").alias("doc_id"), F.lit("m").alias("model_name"), F.lit("h").alias("content_hash"),
        vec(1, 6).alias("vec"),
    )
    for n in (10, 5000):
        topics = spark.range(n).select(
            F.format_string("%05d", "id").alias("interest_key"), F.col("id").cast("string").alias("label"),
            F.lit("m").alias("model_name"), vec(2, 6).alias("vec"),
        )
        best = {r.doc_id: (round(r.affinity, 9), r.best_interest) for r in ranking.document_affinity(docs, emb, topics, "m").collect()}
        a, t = emb.orderBy(F.col("doc_id")).collect(), topics.orderBy("interest_key").collect()
        import numpy as np

        x, y = np.array([r.vec for r in a], "f8"), np.array([r.vec for r in t], "f8")
        cos = (x / np.linalg.norm(x, axis=1)[:, None]) @ (y / np.linalg.norm(y, axis=1)[:, None]).T
        for row, line in zip(a, cos):
            top = len(line) - 1 - int(line[::-1].argmax())
            assert best[row.doc_id] == (round(float(line[top]), 9), t[top].interest_key)


def test_the_bitmap_lets_all_wanted_keys_pass(spark):
    large, few = spark.range(40_000).withColumn("k", F.col("id").cast("string")), spark.range(0, 40_000, 997)
    few = few.select(F.col("id").cast("string").alias("k"))
    passed = maybe_among(large, few, "k")
    assert few.join(passed, "k").count() == few.count()
    assert passed.count() < 200
    assert maybe_among(large, few.limit(0), "k").count() == 0


def test_term_vectors_equal_the_encoder(spark):
    texts = [("One two  two\tTHREE", "été"), ("", None), ("a b", "a b c\x1cd\x85e"), (None, "  \n ")]
    data = [(str(i), f"h{i}", t, b) for i, (t, b) in enumerate(texts)]
    docs = spark.createDataFrame(data, "doc_id string, content_hash string, title string, body string")
    encoded = embedding.encode(docs, embedding.hashing_encoder(), "m", T0)
    native = embedding.term_vectors(docs, "m", T0)
    assert native.schema.simpleString() == encoded.schema.simpleString()
    assert sorted(map(tuple, native.collect())) == sorted(map(tuple, encoded.collect()))


LAZY = ["pending_items", "render_digest", "message_blocks", "digest_dispatch", "document_score", "document_affinity", "affinity_pairs"]


@pytest.mark.parametrize("name", LAZY)
def test_building_a_query_starts_no_job(spark, name):
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup(f"build-{name}", name)
    try:
        entry_point.queries()[name](spark, "/root/testdata/sf0.001")
        assert not tracker.getJobIdsForGroup(f"build-{name}")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)


def test_a_new_source_starts_at_its_oldest_item(spark, lake):
    times = [T0 - timedelta(hours=2)] + [T0 - timedelta(days=d) for d in range(30, 35)]
    data = [("s", str(i), f"h{i}", "{}", t) for i, t in enumerate(times)]
    items = spark.createDataFrame(
        data, "source_name string, native_id string, payload_hash string, payload string, event_ts timestamp"
    )
    sources = items.select("source_name").distinct()
    assert collect_by_cursor(lake, items, sources, "r1", T0).first().rows_new == 6
    assert collect_by_cursor(lake, items, sources, "r2", T0 + timedelta(hours=1)).first().rows_new == 0


def test_a_merge_writes_its_source_once(spark, lake, monkeypatch):
    from trendspark import sinks

    made, written = [], []
    keep, write = sinks.stored, lake._write_parts
    monkeypatch.setattr(sinks, "stored", lambda df, name: made.append((name, df.columns)) or keep(df, name))
    monkeypatch.setattr(lake, "_write_parts", lambda rows, *a: written.append(rows.count()) or write(rows, *a))
    frame = lambda ids, title: spark.createDataFrame([(i, title) for i in ids], "doc_id string, title string").select(
        *[F.col(c) if c in ("doc_id", "title") else F.lit(None).cast(lake.read("document").schema[c].dataType).alias(c)
          for c in lake.columns("document")]
    )
    lake.write_upsert("document", frame(["a:10001", "a:10002", "a:20001", "x"], "old"), ["doc_id"])
    lake.write_upsert("document", frame(["a:10002", "a:10003"], "new"), ["doc_id"])
    lake.write_upsert("document", frame([], "none"), ["doc_id"])
    rows = {r["doc_id"]: r["title"] for r in lake.read("document").collect()}
    assert rows == {"a:10001": "old", "a:10002": "new", "a:10003": "new", "a:20001": "old", "x": "old"}
    assert written == [4, 2, 1, 0]  # of the old rows only the one that stays in a touched block
    assert all("title" not in columns for _, columns in made)


def test_raw_rows_are_not_shuffled_again_to_be_written(spark, lake):
    plans = []

    class Rows:
        def drop(self, *_):
            return self

        def hint(self, name, *_):
            plans.append(name)
            return self

        write = spark.range(1).write

    lake.write_run(Rows(), "run")
    assert not plans
