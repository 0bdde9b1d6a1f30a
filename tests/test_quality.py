"""Checks, alerts, banner lines, expectations."""

from __future__ import annotations

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from trendspark.operators import alerts, quality
from trendspark.operators.expectations import (
    Accepted, NotNull, Relationship, Unique, check_expectations, source_freshness,
)
from trendspark.operators.ingest import late_arrivals, watermark_state, window_plan
from trendspark.schemas import ALERT, CHECK_RESULT, RAW_ITEM, RUN_LOG

NOW = datetime(2026, 3, 31, 12)


def day(n, hour=6):
    """n days before today."""
    return (NOW - timedelta(days=n)).replace(hour=hour)


def log(spark, *rows):
    """Rows of (source, started_at, status, fetched, new, before, after)."""
    data = [
        (f"{s}-{t:%d%H}", s, t, t, st, f, n, b, a, "boom" if st == "error" else None)
        for s, t, st, f, n, b, a in rows
    ]
    return spark.createDataFrame(data, RUN_LOG)


@pytest.fixture
def history(spark):
    c = day
    return log(
        spark,
        ("good", day(1), "ok", 5, 5, c(3), c(2)),
        ("good", day(0), "ok", 5, 5, c(2), c(1)),
        ("failing", day(2), "ok", 5, 5, c(4), c(3)),
        ("failing", day(1), "error", 0, 0, c(3), c(3)),
        ("failing", day(0), "error", 0, 0, c(3), c(3)),
        ("once", day(2), "ok", 5, 5, c(4), c(3)),
        ("once", day(0), "error", 0, 0, c(3), c(3)),
        ("never", day(0), "error", 0, 0, None, None),
        ("silent", day(0), "ok", 0, 0, None, None),
        ("stuck", day(1), "ok", 5, 5, c(3), c(2)),
        ("stuck", day(0), "ok", 5, 0, c(2), c(2)),
        ("stalled", day(1), "error", 0, 0, c(2), c(2)),
        ("stalled", day(0), "stalled", 5, 5, c(2), c(2)),
        ("single", day(0), "ok", 5, 0, c(2), c(2)),
    )


def by_source(df, column="status"):
    return {r.source_name: r[column] for r in df.collect()}


def test_watermark_state(spark, history):
    rows = {r.source_name: r for r in watermark_state(history).collect()}
    assert {k: r.consecutive_fail for k, r in rows.items()} == {
        "good": 0, "failing": 2, "once": 1, "never": 1, "silent": 0, "stuck": 0, "stalled": 0,
        "single": 0,
    }
    assert rows["failing"].cursor_ts == day(3) and rows["failing"].last_success_at == day(2)
    assert rows["never"].cursor_ts is None and rows["never"].last_success_at is None
    assert rows["silent"].cursor_ts is None and rows["silent"].last_success_at == day(0)
    assert rows["stalled"].last_success_at == day(0)
    regressed = log(
        spark,
        ("s", day(1), "ok", 1, 1, None, day(2)),
        ("s", day(0), "ok", 1, 1, day(2), day(5)),
    )
    assert watermark_state(regressed).first().cursor_ts == day(2)


def test_window_plan(spark, history):
    names = spark.createDataFrame([("good",), ("new",)], "source_name string")
    plan = window_plan(watermark_state(history), NOW, sources=names)
    rows = {(r.source_name, r.kind): (r.lower, r.upper) for r in plan.collect()}
    upper = NOW - timedelta(minutes=15)
    assert rows == {
        ("good", "forward"): (day(1), upper),
        ("good", "backfill"): (day(3), day(1)),
        ("new", "forward"): (upper - timedelta(days=7), upper),
    }


def test_ingest_error(history):
    latest = quality.latest_run(quality.last_run_per_day(history))
    result = quality.check_ingest_error(watermark_state(history), latest)
    status = by_source(result)
    assert status["failing"] == "critical" and status["once"] == status["never"] == "warn"
    assert {status[k] for k in ("good", "silent", "stuck", "stalled")} == {"ok"}
    assert by_source(result, "detail")["failing"] == "연속 실패 2회"


def test_volume_zero(history):
    latest = quality.latest_run(quality.last_run_per_day(history))
    status = by_source(quality.check_volume_zero(latest))
    # An error run without rows is another check's business.
    assert status.pop("silent") == "critical" and set(status.values()) == {"ok"}


def test_freshness(spark, history):
    state = watermark_state(history)
    assert by_source(quality.check_freshness(state, NOW))["never"] == "insufficient_data"
    for hours, expected in ((25, "ok"), (26, "warn"), (47, "warn"), (48, "critical")):
        one = log(spark, ("s", NOW - timedelta(hours=hours, minutes=1), "ok", 1, 1, None, None))
        # 12:00 less 25 h 1 min has crossed 26 hour boundaries.
        shifted = quality.check_freshness(watermark_state(one), NOW - timedelta(hours=1))
        assert by_source(shifted)["s"] == expected


def test_watermark_stall(history):
    result = quality.check_watermark_stall(quality.last_run_per_day(history))
    status = by_source(result)
    assert status["stuck"] == "warn" and status["good"] == "ok" and status["stalled"] == "ok"
    assert status["single"] == "insufficient_data"
    assert "never" not in status and "silent" not in status


def test_last_run_of_a_day_counts(spark):
    df = log(
        spark,
        ("s", day(0, 1), "ok", 9, 9, None, None),
        ("s", day(0, 5), "error", 0, 0, None, None),
    )
    row = quality.last_run_per_day(df).first()
    assert row.status == "error" and row.run_date == NOW.date()


def runs_on(spark, volumes):
    return log(spark, *[("s", day(n), "ok", v, v, None, None) for n, v in volumes])


def test_volume_drop(spark):
    # 2026-03-31 is a Tuesday; its past holds weekdays only.
    past = [(n, 10 if n % 2 else 20) for n in range(1, 40)]
    baseline = quality.volume_baseline(quality.last_run_per_day(runs_on(spark, [(0, 5), *past])))
    row = baseline.first()
    in_reach = [v for n, v in past if n <= 28 and day(n).weekday() < 5]
    ordered = sorted(in_reach)
    assert row.baseline_n == len(in_reach) == 20
    assert row.baseline_median == (ordered[9] + ordered[10]) / 2 == 15.0
    assert quality.check_volume_drop(baseline).first().status == "warn"
    at_limit = quality.volume_baseline(quality.last_run_per_day(runs_on(spark, [(0, 6), *past])))
    result = quality.check_volume_drop(at_limit).first()
    assert result.status == "ok" and result.detail == "신규 6건 (weekday 중앙값 15.0)"
    few = quality.volume_baseline(quality.last_run_per_day(runs_on(spark, [(0, 0), *past[:6]])))
    assert quality.check_volume_drop(few).first().status == "insufficient_data"
    alone = quality.volume_baseline(quality.last_run_per_day(runs_on(spark, [(0, 3)])))
    assert quality.check_volume_drop(alone).first().observed_value == 3.0


def test_topic_domination(spark):
    def check(*labels):
        df = spark.createDataFrame([(x,) for x in labels], "best_interest_label string")
        return quality.check_topic_domination(df).collect()

    assert check() == []
    (row,) = check("a", "a", "b")
    assert (row.status, row.observed_value, row.detail) == ("warn", 0.667, "a 토픽이 66.7% 차지")
    assert check("a", "a", "b", "c", "d")[0].status == "ok"


def test_duplicates(spark):
    def check(*rows):
        df = spark.createDataFrame(rows, "doc_id string, title string")
        return quality.check_duplicate(df).first()

    assert check(("1", "A b"), ("2", " a B "), ("3", "c"), ("3", "c"), ("4", None)).observed_value == 1
    assert check(("1", "a")).status == "ok"


def results(spark, *rows):
    """Rows of (check, source, status)."""
    data = [(c, NOW.date(), s, st, 1.0, 0.0, f"{c} detail", NOW) for c, s, st in rows]
    return spark.createDataFrame(data, CHECK_RESULT)


def sent(spark, *rows):
    """Rows of (check, source, severity, hours ago)."""
    data = [
        ("id", c, NOW.date(), s, sv, 1.0, 0.0, "d", NOW - timedelta(hours=h)) for c, s, sv, h in rows
    ]
    return spark.createDataFrame(data, ALERT)


def test_first_run_announces_every_finding(spark):
    found = results(
        spark, ("a", "s", "warn"), ("b", "s", "critical"), ("c", "s", "ok"),
        ("d", "s", "insufficient_data"),
    )
    due = alerts.alert_dispatch(found, sent(spark), NOW)
    assert {(r.check_name, r.severity) for r in due.collect()} == {("a", "warn"), ("b", "critical")}


def test_cooldown_is_per_severity_and_uses_the_last_alert(spark):
    found = results(
        spark, ("a", "s", "critical"), ("b", "s", "warn"), ("c", "s", "warn"), ("d", "s", "warn")
    )
    history = sent(
        spark, ("a", "s", "warn", 1), ("b", "s", "warn", 19), ("c", "s", "warn", 20),
        ("d", "s", "warn", 30), ("d", "s", "warn", 2),
    )
    due = alerts.alert_dispatch(found, history, NOW)
    assert {r.check_name for r in due.collect()} == {"a", "c"}


def test_alert_id_follows_the_day(spark):
    found = results(spark, ("a", "s", "warn"))
    one, two = (alerts.alert_dispatch(found, sent(spark), NOW).first() for _ in range(2))
    assert one.alert_id == two.alert_id and one.alerted_at == NOW


def lines(spark, alert_rows, result_rows=()):
    df = alerts.warning_lines(
        sent(spark, *alert_rows), results(spark, *result_rows), NOW, hint=" (see the table)"
    )
    return [r.text for r in df.orderBy("line_no").collect()]


def test_banner_lists_today_only_critical_first(spark):
    rows = [("z", "s", "critical", 0), ("a", "s", "warn", 1), ("b", "s", "warn", 24)]
    assert lines(spark, rows) == ["[심각] z · s — d", "[경고] a · s — d"]


def test_banner_folds_the_rest(spark):
    text = lines(spark, [(f"check_{i}", "s", "warn", 0) for i in range(alerts.MAX_LISTED + 3)])
    assert len(text) == alerts.MAX_LISTED + 1 and text[-1] == "…외 3건 (see the table)"


def test_banner_counts_the_undecided(spark):
    undecided = [(f"check_{i}", "s", "insufficient_data") for i in range(15)]
    assert lines(spark, [], [*undecided, ("x", "s", "ok")]) == [
        "판정 불가 15건 (기준선 미확보 — 이력이 쌓이면 자동 해소)"
    ]


def test_banner_is_empty_when_all_is_well(spark):
    assert lines(spark, []) == []


def test_expectations(spark):
    df = spark.createDataFrame(
        [("1", "arxiv", "a"), ("1", "other", None), (None, "arxiv", "b"), (None, None, "x")],
        "doc_id string, source string, ref string",
    )
    known = spark.createDataFrame([("a",), ("b",)], "key string")
    rules = [
        NotNull("doc_id"), Accepted("source", ("arxiv",)), Unique(("doc_id",)),
        Unique(("doc_id", "source")), Relationship("ref", known, "key"),
    ]
    got = {(r.rule, r.column): r.violations for r in check_expectations(df, rules).collect()}
    assert got == {
        ("not_null", "doc_id"): 2,
        ("accepted_values", "source"): 1,
        ("unique", "doc_id"): 1,
        ("unique", "doc_id,source"): 0,
        ("relationships", "ref"): 1,
    }


def test_source_freshness(spark):
    for hours, expected in ((26, "pass"), (27, "warn"), (48, "warn"), (49, "error")):
        df = spark.createDataFrame([(NOW - timedelta(hours=hours),)], "t timestamp")
        assert source_freshness(df, "t", NOW).first().status == expected
    empty = spark.createDataFrame([], "t timestamp")
    assert source_freshness(empty, "t", NOW).first().status == "error"


def test_late_arrivals_percentile_interpolates(spark):
    cursor = day(1)
    rows = [("s", str(i), "h", "{}", cursor - timedelta(seconds=i), NOW, "s-x") for i in range(1, 101)]
    rows.append(("s", "on time", "h", "{}", cursor, NOW, "s-x"))
    raw = spark.createDataFrame(rows, RAW_ITEM)
    runs = spark.createDataFrame(
        [("s-x", "s", NOW, NOW, "ok", 1, 1, cursor, NOW, None)], RUN_LOG
    )
    row = late_arrivals(raw, runs).first()
    assert (row.n, row.worst_seconds) == (100, 100)
    assert row.p99_seconds == pytest.approx(99.01)


def test_one_pass_over_the_log_finds_what_the_single_checks_find(spark):
    chance = random.Random(4)
    rows = []
    for n in range(400):
        started = datetime(2026, 3, 1) + timedelta(hours=7 * chance.randint(0, 200)) if chance.random() < 0.97 else None
        moved = chance.random() < 0.5
        rows.append((
            f"r{n}", f"s{chance.randint(0, 11)}", started, started, chance.choice(["ok", "ok", "error", "stalled"]),
            chance.choice([0, 5, 40, None]), chance.choice([0, 3, 30, None]), started if moved else None,
            chance.choice([started, datetime(2026, 1, 1)]) if moved else None, chance.choice(["no answer", None]),
        ))
    log = spark.createDataFrame(rows, RUN_LOG)
    as_of = datetime(2026, 5, 1)
    state, daily = watermark_state(log), quality.last_run_per_day(log)
    latest = quality.latest_run(daily)
    single = [
        quality.check_ingest_error(state, latest),
        quality.check_volume_zero(latest),
        quality.check_freshness(state, as_of),
        quality.check_watermark_stall(daily),
        quality.check_volume_drop(quality.volume_baseline(daily)),
    ]
    wanted = sorted(str(tuple(row)) for check in single for row in check.collect())
    found = quality.check_sources(quality.source_facts(log), as_of)
    assert sorted(str(tuple(row)) for row in found.collect()) == wanted
    assert quality.check_sources(quality.source_facts(log.limit(0)), as_of).count() == 0
    assert found._jdf.queryExecution().optimizedPlan().toString().count("LogicalRDD") == 1
