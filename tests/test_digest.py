"""Selection, pending items, deliveries, rendering, summaries."""

from __future__ import annotations

from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendspark import messages
from trendspark.operators import digest, joins, ranking
from trendspark.plans.build import open_items, record_delivery

NOW = datetime(2026, 9, 8, 12)
CONFIG = [("arxiv", 72, 2), ("hackernews", 36, 1)]


def config(spark):
    return spark.createDataFrame(
        CONFIG, "source string, half_life_hours int, digest_quota int"
    )


def scored(spark, *rows):
    """Rows of (doc_id, source, title, affinity, score)."""
    return spark.createDataFrame(
        [(*r[:3], "u", NOW, "L", r[3], 1.0, 0.0, r[4]) for r in rows],
        "doc_id string, source string, title string, url string, published_at timestamp, "
        "best_interest_label string, affinity double, recency_decay double, "
        "engagement_boost double, score double",
    )


def delivered(spark, *rows):
    return spark.createDataFrame(rows, "dispatch_id string, doc_id string, status string")


ROWS = [
    ("a1", "arxiv", "t", 0.45, 0.9),
    ("a2", "arxiv", "t", 0.9, 0.8),
    ("a3", "arxiv", "t", 0.9, 0.8),
    ("a4", "arxiv", "t", 0.9, 0.7),
    ("a5", "arxiv", None, 0.9, 2.0),
    ("a6", "arxiv", "t", 0.4499, 2.0),
    ("h1", "hackernews", "t", 0.9, 0.1),
    ("h2", "hackernews", "t", 0.9, 0.2),
    ("x1", "elsewhere", "t", 0.9, 5.0),
]


def pick(spark, *sent):
    chosen = digest.dispatch(scored(spark, *ROWS), delivered(spark, *sent), config(spark), NOW)
    return [
        (r.doc_id, r.rank_in_source) for r in chosen.orderBy("source", "rank_in_source").collect()
    ]


def test_quota_floor_and_unknown_sources(spark):
    assert pick(spark) == [("a1", 1), ("a2", 2), ("h2", 1)]


def test_sent_is_out_and_failed_comes_back(spark):
    assert pick(spark, ("d", "a1", "sent"), ("d", "h2", "failed")) == [
        ("a2", 1), ("a3", 2), ("h2", 1)
    ]


def test_selection_does_not_depend_on_the_join_strategy(spark, monkeypatch):
    expected = pick(spark)
    monkeypatch.setattr(joins.Dimension.__init__, "__defaults__", (1, 10**9))
    assert pick(spark) == expected


def test_dispatch_row(spark):
    row = digest.dispatch(scored(spark, ROWS[0]), delivered(spark), config(spark), NOW).first()
    assert row.dispatch_id == "2026-09-08:a1" and row.digest_date == date(2026, 9, 8)
    assert row.selected_at == NOW


def test_score_is_neutral_without_metrics(spark):
    docs = spark.createDataFrame(
        [("1", "arxiv", "t", "u", NOW - timedelta(hours=72)), ("2", "hackernews", "t", "u", NOW)],
        "doc_id string, source string, title string, url string, published_at timestamp",
    )
    affinity = spark.createDataFrame(
        [("1", 0.5, "k", "L"), ("2", 0.5, "k", "L")],
        "doc_id string, affinity double, best_interest string, best_interest_label string",
    )
    latest = spark.createDataFrame(
        [("2", date(2026, 9, 8), 5000, None)],
        "doc_id string, metric_date date, engagement_score int, observed_delta int",
    )
    rows = {r.doc_id: r for r in ranking.score(docs, affinity, latest, config(spark), NOW).collect()}
    assert rows["1"].score == pytest.approx(0.25) and rows["1"].engagement_boost == 0.0
    assert rows["2"].engagement_boost == 1.0 and rows["2"].score == pytest.approx(1.0)


@pytest.fixture
def seeded(lake):
    spark = lake.spark
    docs = [
        (f"arxiv:{i}", "arxiv", f"문서 {i}", f"본문 {i}", f"https://x/{i}", NOW - timedelta(hours=i))
        for i in (1, 2)
    ]
    docs = spark.createDataFrame(
        docs,
        "doc_id string, source string, title string, body string, url string, "
        "published_at timestamp",
    )
    schema = lake.read("document").schema
    missing = [f for f in schema.fields if f.name not in docs.columns]
    full = docs.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in missing])
    lake.write_upsert("document", full, ["doc_id"])
    dispatch = docs.drop("body").select(
        F.concat(F.lit("d"), F.substring("doc_id", 7, 1)).alias("dispatch_id"),
        F.lit(NOW.date()).alias("digest_date"),
        "*",
        F.lit("관심사").alias("best_interest_label"),
        F.lit(0.6).alias("affinity"),
        F.lit(0.54).alias("score"),
        F.substring("doc_id", 7, 1).cast("int").alias("rank_in_source"),
    )
    lake.replace_partitions("digest_dispatch", dispatch, "digest_date")
    return lake


def test_sent_items_are_not_resent(seeded):
    items = open_items(seeded, NOW)
    assert items.count() == 2 and seeded.read("delivery").count() == 0
    record_delivery(seeded, items, "sent", NOW)
    assert open_items(seeded, NOW).count() == 0


def test_failed_items_stay_pending_until_sent(seeded):
    record_delivery(seeded, open_items(seeded, NOW), "failed", NOW, "no answer")
    assert [r.status for r in seeded.read("delivery").select("status").distinct().collect()] == [
        "failed"
    ]
    assert open_items(seeded, NOW).count() == 2
    record_delivery(seeded, open_items(seeded, NOW).filter("doc_id = 'arxiv:1'"), "sent", NOW)
    assert [r.doc_id for r in open_items(seeded, NOW).collect()] == ["arxiv:2"]


def test_another_day_has_its_own_items(seeded):
    assert open_items(seeded, NOW + timedelta(days=1)).count() == 0


def test_replacing_a_day_keeps_the_others(seeded):
    day = seeded.read("digest_dispatch")
    tomorrow = day.withColumn("digest_date", F.date_add("digest_date", 1))
    seeded.replace_partitions("digest_dispatch", tomorrow, "digest_date")
    assert seeded.read("digest_dispatch").count() == 4
    one = seeded.read("digest_dispatch").filter(
        (F.col("digest_date") == F.lit(NOW.date())) & (F.col("rank_in_source") == 1)
    )
    seeded.replace_partitions("digest_dispatch", one, "digest_date")
    assert seeded.read("digest_dispatch").count() == 3
    empty = day.limit(0)
    seeded.replace_partitions("digest_dispatch", empty, "digest_date")
    assert seeded.read("digest_dispatch").count() == 3


def item(spark, **over):
    base = {
        "source": "hackernews", "title": "Rust & Go: a <deep> dive | part 2",
        "url": "https://x?a=1&b=2", "body": "본문", "best_interest_label": "A & B",
        "affinity": 0.7, "published_at": datetime(2026, 9, 8, 12), "summary": None, **over,
    }
    return spark.createDataFrame(
        [tuple(base.values())],
        "source string, title string, url string, body string, best_interest_label string, "
        "affinity double, published_at timestamp, summary string",
    )


def test_markup_is_escaped_but_the_link_is_not(spark):
    row = digest.render(item(spark)).first()
    link = row.section.split("\n")[0]
    assert link == "*<https://x?a=1&b=2|Rust &amp; Go: a &lt;deep&gt; dive ｜ part 2>*"
    assert row.context == "`HN` · A &amp; B · 관심도 0.70 · 09-08 21:00 KST"


def test_excerpt_stands_in_for_a_summary(spark):
    long = digest.render(item(spark, body="본문\n\n " * 200)).first().section.split("\n")[1]
    assert long == ("본문 " * 200)[:220] + "…"
    assert "링크 참고" in digest.render(item(spark, body=" \n")).first().section
    assert "링크 참고" in digest.render(item(spark, body=None, summary="")).first().section
    assert digest.render(item(spark, summary="세 줄")).first().section.endswith("\n세 줄")
    assert digest.render(item(spark, body="x" * 220)).first().section.endswith("x" * 220)


def test_summary_gate_counts_the_trimmed_body(spark):
    docs = spark.createDataFrame(
        [("a", " " * 50 + "x" * 199), ("b", "x" * 200), ("c", None), ("d", "y" * 9000)],
        "doc_id string, body string",
    )
    rows = {r.doc_id: r for r in digest.summary_eligibility(docs).collect()}
    assert [rows[k].status for k in "abcd"] == ["too_short", "eligible", "too_short", "eligible"]
    assert rows["d"].body_chars == 9000 and len(rows["d"].prompt_body) == 9000


def test_tally_warns_only_if_every_attempt_failed(spark):
    def tally(*statuses):
        df = spark.createDataFrame([(s,) for s in statuses], "summary_status string")
        return digest.tally(df).first()

    assert tuple(tally("summarized", "failed", "skipped")) == (3, 1, 1, 1, None)
    assert tally("failed", "skipped").warning == messages.SUMMARY_FAILED
    assert tally("skipped").warning is None
    assert tally().items == 0


def test_message_blocks_are_ordered_and_need_items(spark):
    rendered = digest.render(item(spark).withColumn("rank_in_source", F.lit(1)))
    warnings = spark.createDataFrame([(2, "b"), (1, "a")], "line_no int, text string")
    order = ["part", "source", "rank_in_source", "block"]
    rows = digest.message_blocks(rendered, warnings, "Digest", NOW).orderBy(*order).collect()
    assert [r.type for r in rows] == ["header", "section", "divider", "section", "context"]
    assert rows[0].text == "Digest · 2026-09-08" and rows[1].text == "⚠️ a\n⚠️ b"
    quiet = digest.message_blocks(rendered, warnings.limit(0), "Digest", NOW)
    assert quiet.count() == 4
    assert digest.message_blocks(rendered.limit(0), warnings, "Digest", NOW).count() == 0
