"""Queries over run history, checks, alerts and expectations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendspark.operators import alerts, metrics, quality
from trendspark.operators.expectations import (
    Accepted,
    NotNull,
    Relationship,
    Unique,
    check_expectations,
    source_freshness,
)
from trendspark.operators.ingest import watermark_state
from trendspark.queries import bindings as b
from trendspark.queries.bindings import oracle
from trendspark.queries.rank import _affinity


def _log(spark: SparkSession, sf: str) -> DataFrame:
    return b.run_log(b.raw_items(spark, sf))


def _daily(spark: SparkSession, sf: str) -> DataFrame:
    return quality.last_run_per_day(_log(spark, sf))


def last_run_per_day(spark: SparkSession, sf: str) -> DataFrame:
    return _daily(spark, sf).select("source_name", "run_date", "run_id", "status", "rows_new")


def latest_run(spark: SparkSession, sf: str) -> DataFrame:
    latest = quality.latest_run(_daily(spark, sf))
    return latest.select("source_name", "run_date", "run_id", "status")


def volume_baseline(spark: SparkSession, sf: str) -> DataFrame:
    return quality.volume_baseline(_daily(spark, sf))


def dq_ingest_error(spark: SparkSession, sf: str) -> DataFrame:
    log = _log(spark, sf)
    latest = quality.latest_run(quality.last_run_per_day(log))
    return quality.check_ingest_error(watermark_state(log), latest)


def dq_volume_zero(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_volume_zero(quality.latest_run(_daily(spark, sf)))


def dq_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_freshness(watermark_state(_log(spark, sf)), b.CHECK_AS_OF)


def dq_watermark_stall(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_watermark_stall(_daily(spark, sf))


def dq_volume_drop(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_volume_drop(quality.volume_baseline(_daily(spark, sf)))


def topic_share(spark: SparkSession, sf: str) -> DataFrame:
    shares = quality.topic_share(_affinity(spark, sf, b.documents(spark, sf)))
    return shares.select("label", "n", F.round("share", 6).alias("share"))


def dq_topic_domination(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_topic_domination(_affinity(spark, sf, b.documents(spark, sf)))


def dq_duplicate(spark: SparkSession, sf: str) -> DataFrame:
    return quality.check_duplicate(b.documents(spark, sf))


def _results(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf)
    return quality.run_checks(_log(spark, sf), docs, _affinity(spark, sf, docs), b.CHECK_AS_OF)


def dq_check_result(spark: SparkSession, sf: str) -> DataFrame:
    return _results(spark, sf).drop("evaluated_at")


def _alerts(results: DataFrame) -> DataFrame:
    return alerts.alert_dispatch(results, b.alert_history(results), b.CHECK_AS_OF)


def alert_cooldown(spark: SparkSession, sf: str) -> DataFrame:
    due = _alerts(_results(spark, sf))
    return due.select("alert_id", "check_name", "source_name", "severity", "detail", "alerted_at")


def warning_lines(spark: SparkSession, sf: str) -> DataFrame:
    """The banner of a day on which every finding is announced."""
    results = _results(spark, sf)
    everything = alerts.alert_dispatch(results, b.alert_history(results.limit(0)), b.CHECK_AS_OF)
    return alerts.warning_lines(everything, results, b.CHECK_AS_OF)


def expectations(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf).withColumn("body", F.nullif(F.col("body"), F.lit("")))
    daily = metrics.daily_last(b.observations(b.raw_items(spark, sf)))
    of_docs = check_expectations(
        docs,
        [
            NotNull("title"),
            NotNull("body"),
            Accepted("lang", ("en", "fr")),
            Unique(("doc_id",)),
            Unique(("content_hash",)),
        ],
    )
    of_metrics = check_expectations(
        daily,
        [
            NotNull("comments"),
            Unique(("doc_id", "metric_date")),
            Relationship("doc_id", docs, "doc_id"),
        ],
    )
    return of_docs.unionByName(of_metrics)


def bronze_freshness(spark: SparkSession, sf: str) -> DataFrame:
    return source_freshness(b.raw_items(spark, sf), "fetched_at", b.CHECK_AS_OF)


QUERIES = {
    "last_run_per_day": last_run_per_day,
    "latest_run": latest_run,
    "volume_baseline": volume_baseline,
    "dq_ingest_error": dq_ingest_error,
    "dq_volume_zero": dq_volume_zero,
    "dq_freshness": dq_freshness,
    "dq_watermark_stall": dq_watermark_stall,
    "dq_volume_drop": dq_volume_drop,
    "topic_share": topic_share,
    "dq_topic_domination": dq_topic_domination,
    "dq_duplicate": dq_duplicate,
    "dq_check_result": dq_check_result,
    "alert_cooldown": alert_cooldown,
    "warning_lines": warning_lines,
    "expectations": expectations,
    "source_freshness": bronze_freshness,
}

# What each check finds, a row for each subject: its level (0 ok, 1 warn, 2 critical, 3 insufficient
# data), the figures and the wording. ``_judged`` turns levels into statuses.
_FACTS: dict[str, tuple[list[str], str]] = {
    "ingest_error": (
        ["watermark", "latest_run"],
        """
        SELECT source_name AS subject, consecutive_fail AS seen, 0 AS wanted,
               if(seen > 0, least(seen, 2), 2 * CAST(coalesce(status = 'error', FALSE) AS INT)) AS level,
               if(seen > 0, format('연속 실패 {}회', seen),
                  if(level = 0, '정상', coalesce(error_msg, '수집 실패'))) AS words
        FROM latest_run RIGHT JOIN watermark USING (source_name)
        """,
    ),
    "volume_zero": (
        ["latest_run"],
        """
        SELECT source_name AS subject, rows_fetched AS seen, NULL AS wanted,
               2 * CAST(seen = 0 AND status = 'ok' AS INT) AS level,
               if(level = 0, format('수신 {}건', seen), '성공으로 기록됐으나 수신 0건 — 조용한 중단') AS words
        FROM latest_run
        """,
    ),
    "freshness": (
        ["watermark"],
        f"""
        SELECT source_name AS subject, 26 AS wanted,
               date_diff('hour', last_success_at, TIMESTAMP '{b.CHECK_AS_OF}') AS seen,
               coalesce(CAST(seen >= 26 AS INT) + CAST(seen >= 48 AS INT), 3) AS level,
               coalesce('마지막 성공 ' || seen || '시간 전', '성공 이력 없음') AS words
        FROM watermark
        """,
    ),
    "watermark_stall": (
        ["daily_run"],
        """
        SELECT source_name AS subject, count(*) AS seen, NULL AS wanted,
               arg_max(rows_new = 0 AND watermark_after IS NOT DISTINCT FROM watermark_before, run_date) AS stuck,
               if(seen < 2, 3, CAST(stuck AS INT)) AS level,
               if(level = 3, format('실행 {}회 — 판정 불가', seen),
                  if(stuck, '커서 미전진 + 신규 0건 — 무증상 정체 의심', '커서 정상 전진')) AS words
        FROM daily_run WHERE watermark_after IS NOT NULL GROUP BY source_name
        """,
    ),
    "volume_drop": (
        ["baseline"],
        """
        SELECT source_name AS subject, rows_new AS seen, baseline_median AS wanted,
               if(baseline_n < 7, 3, CAST(seen < 0.4 * wanted AS INT)) AS level,
               if(level = 3, format('동일 요일유형 관측 {}일 — 기준선 부족(최소 7일)', baseline_n),
                  '신규 ' || seen || '건 (' || day_type || ' 중앙값 ' || wanted || ')') AS words
        FROM baseline
        """,
    ),
    "topic_domination": (
        ["affinity"],
        """
        SELECT '(전체)' AS subject, CAST(n AS DOUBLE) / total AS share, round(share, 3) AS seen,
               0.40 AS wanted, CAST(share > 0.40 AS INT) AS level,
               label || ' 토픽이 ' || round(share * 100, 1) || '% 차지' AS words
        FROM (SELECT best_interest_label AS label, count(*) AS n FROM affinity GROUP BY ALL),
             (SELECT count(*) AS total FROM affinity)
        ORDER BY n DESC, label DESC LIMIT 1
        """,
    ),
    "duplicate_candidate": (
        ["doc"],
        """
        SELECT '(전체)' AS subject, count(*) AS seen, 0 AS wanted, CAST(seen > 0 AS INT) AS level,
               if(level = 1, format('제목이 같은 서로 다른 문서 {}쌍', seen), '중복 없음') AS words
        FROM (SELECT lower(trim(title)) AS said FROM doc GROUP BY said
              HAVING said IS NOT NULL AND min(doc_id) < max(doc_id))
        """,
    ),
}


def _judged(name: str, facts: str) -> str:
    return f"""
        SELECT '{name}' AS check_name, subject AS source_name,
               (['ok', 'warn', 'critical', 'insufficient_data'])[level + 1] AS status,
               CAST(seen AS DOUBLE) AS observed_value, CAST(wanted AS DOUBLE) AS expected_value,
               words AS detail
        FROM ({facts})
        """


CHECKS = {name: (views, _judged(name, facts)) for name, (views, facts) in _FACTS.items()}

_ALL_VIEWS = sorted({view for views, _ in CHECKS.values() for view in views})
_ALL = "\nUNION ALL\n".join(f"SELECT * FROM ({body})" for _, body in CHECKS.values())
_TODAY = f"DATE '{b.CHECK_AS_OF[:10]}'"
_FINDINGS = f"SELECT * FROM ({_ALL}) WHERE status IN ('warn', 'critical')"


def _check_oracle(name: str) -> str:
    views, body = CHECKS[name]
    return oracle(views, body)


ORACLE = {
    "last_run_per_day": oracle(
        ["daily_run"], "SELECT source_name, run_date, run_id, status, rows_new FROM daily_run"
    ),
    "latest_run": oracle(
        ["latest_run"], "SELECT source_name, run_date, run_id, status FROM latest_run"
    ),
    "volume_baseline": oracle(["baseline"], "SELECT * FROM baseline"),
    "dq_ingest_error": _check_oracle("ingest_error"),
    "dq_volume_zero": _check_oracle("volume_zero"),
    "dq_freshness": _check_oracle("freshness"),
    "dq_watermark_stall": _check_oracle("watermark_stall"),
    "dq_volume_drop": _check_oracle("volume_drop"),
    "topic_share": oracle(
        ["affinity"],
        """
        SELECT best_interest_label AS label, count(*) AS n,
               round(CAST(count(*) AS DOUBLE) / CAST(sum(count(*)) OVER () AS DOUBLE), 6) AS share
        FROM affinity GROUP BY 1
        """,
    ),
    "dq_topic_domination": _check_oracle("topic_domination"),
    "dq_duplicate": _check_oracle("duplicate_candidate"),
    "dq_check_result": oracle(_ALL_VIEWS, f"SELECT *, {_TODAY} AS check_date FROM ({_ALL})"),
    "alert_cooldown": oracle(
        _ALL_VIEWS,
        f"""
        SELECT md5(check_name || ':' || source_name || ':' || status || ':'
                   || CAST({_TODAY} AS VARCHAR)) AS alert_id,
               check_name, source_name, status AS severity, detail,
               TIMESTAMP '{b.CHECK_AS_OF}' AS alerted_at
        FROM ({_FINDINGS}) WHERE length(check_name) + length(source_name) >= 20
        """,
    ),
    "warning_lines": oracle(
        _ALL_VIEWS,
        f"""
        SELECT line_no, text
        FROM (SELECT row_number() OVER (ORDER BY CASE status WHEN 'critical' THEN 0 ELSE 1 END,
                                                 check_name, source_name) AS line_no,
                     CASE status WHEN 'critical' THEN '[심각] ' ELSE '[경고] ' END
                     || check_name || ' · ' || source_name || ' — ' || detail AS text
              FROM ({_FINDINGS}))
        WHERE line_no <= 5
        UNION ALL
        SELECT 6, '…외 ' || (count(*) - 5) || '건' FROM ({_FINDINGS}) HAVING count(*) > 5
        UNION ALL
        SELECT 7, '판정 불가 ' || count(*) || '건 (기준선 미확보 — 이력이 쌓이면 자동 해소)'
        FROM ({_ALL}) WHERE status = 'insufficient_data' HAVING count(*) > 0
        """,
    ),
    "expectations": oracle(
        ["doc", "metric_daily"],
        """
        SELECT 'not_null' AS rule, 'title' AS column, count(*) AS violations
        FROM doc WHERE title IS NULL
        UNION ALL SELECT 'not_null', 'body', count(*) FROM doc WHERE body = ''
        UNION ALL SELECT 'accepted_values', 'lang', count(*) FROM doc
                  WHERE lang NOT IN ('en', 'fr')
        UNION ALL SELECT 'unique', 'doc_id', count(*)
                  FROM (SELECT doc_id FROM doc GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'unique', 'content_hash', count(*)
                  FROM (SELECT content_hash FROM doc GROUP BY 1 HAVING count(*) > 1)
        UNION ALL SELECT 'not_null', 'comments', count(*) FROM metric_daily
                  WHERE comments IS NULL
        UNION ALL SELECT 'unique', 'doc_id,metric_date', count(*)
                  FROM (SELECT 1 FROM metric_daily GROUP BY doc_id, metric_date
                        HAVING count(*) > 1)
        UNION ALL SELECT 'relationships', 'doc_id', count(*) FROM metric_daily
                  WHERE doc_id NOT IN (SELECT doc_id FROM doc)
        """,
    ),
    "source_freshness": oracle(
        ["raw_item"],
        f"""
        SELECT max_loaded_at, age_hours,
               CASE WHEN age_hours > 48 THEN 'error' WHEN age_hours > 26 THEN 'warn'
                    ELSE 'pass' END AS status
        FROM (SELECT max(fetched_at) AS max_loaded_at,
                     date_diff('hour', max(fetched_at), TIMESTAMP '{b.CHECK_AS_OF}')
                         AS age_hours
              FROM raw_item)
        """,
    ),
}
