"""Queries over landing, cursors, documents and metrics."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendspark.functions.text import split_version
from trendspark.operators import documents, ingest, metrics
from trendspark.operators.ordering import latest_per_key, top_n_per_group
from trendspark.queries import bindings as b
from trendspark.queries.bindings import oracle
from trendspark.schemas import RAW_ITEM
from trendspark.session import scratch_dir
from trendspark.sinks import Lake
from trendspark.sources.items import parse_items, stories
from trendspark.streaming.ingest import ingest_stream, read_landed

# The items that one run of ``cursor_stall`` takes from a source.
RUN_ITEMS = 20


def payload_hash(spark: SparkSession, sf: str) -> DataFrame:
    events = b.table(spark, sf, "events")
    payload = ingest.canonical_payload(["user_id", "event_type"])
    return events.select("event_id", ingest.payload_hash(payload).alias("payload_hash"))


def idempotent_append(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_items(spark, sf)
    new = ingest.idempotent_rows(
        raw.filter(F.col("event_ts") >= b.at(b.SPLIT)),
        raw.filter(F.col("event_ts") < b.at(b.SPLIT)),
        tie_break=("event_id",),
    )
    return new.select("source_name", "native_id", "payload_hash", "event_ts")


def payload_history(spark: SparkSession, sf: str) -> DataFrame:
    history = ingest.payload_history(b.raw_items(spark, sf))
    return history.select("native_id", "version_no", "payload_hash", "first_fetched_at")


def committed_rows(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_items(spark, sf)
    return ingest.committed_rows(raw, b.run_log(raw)).select("event_id", "source_name")


def json_item_source(spark: SparkSession, sf: str) -> DataFrame:
    lines = b.table(spark, sf, "events").select(
        F.to_json(
            F.struct(
                F.col("event_id").alias("id"),
                F.col("event_type").alias("type"),
                F.get_json_object("props", "$.k").cast("bigint").alias("score"),
                F.unix_seconds("ts").alias("time"),
                (F.col("value") > 300).alias("dead"),
            )
        ).alias("value")
    )
    kept = stories(parse_items(lines), ("click", "view", "purchase"))
    return kept.select(
        F.col("id").alias("event_id"),
        F.col("score").alias("k"),
        F.timestamp_seconds("time").alias("event_ts"),
    )


def listing_top_n(spark: SparkSession, sf: str) -> DataFrame:
    order = [F.col("value").desc_nulls_last(), F.col("event_id")]
    top = top_n_per_group(b.table(spark, sf, "events"), ["event_type"], order, 20)
    return top.select("event_type", "rank", "event_id")


def _latest(raw: DataFrame) -> DataFrame:
    order = [F.col("fetched_at").desc(), F.col("event_id").desc()]
    return latest_per_key(raw, ["native_id"], order)


def latest_of_item(spark: SparkSession, sf: str) -> DataFrame:
    return _latest(b.raw_items(spark, sf)).select("native_id", "event_id", "fetched_at")


def upsert_merge(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_items(spark, sf).select(
        "native_id", "payload_hash", "fetched_at", "event_ts", "event_id"
    )
    target = _latest(raw.filter(F.col("event_ts") < b.at(b.SPLIT)))
    source = _latest(raw.filter(F.col("event_ts") >= b.at(b.SPLIT)))
    merged = documents.upsert(target, source, ["native_id"])
    return merged.select("native_id", "payload_hash", "fetched_at")


def incremental_lookback(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_items(spark, sf)
    stored = raw.filter(F.col("event_ts") < b.at(b.SPLIT))
    return documents.lookback(raw, stored).select("event_id")


def watermark_state(spark: SparkSession, sf: str) -> DataFrame:
    state = ingest.watermark_state(b.run_log(b.raw_items(spark, sf)))
    return state.select(
        "source_name", "cursor_ts", "last_run_id", "last_success_at", "consecutive_fail"
    )


def consecutive_fail(spark: SparkSession, sf: str) -> DataFrame:
    """Each user as a source and each event as a run; error events are failed runs."""
    raw = b.raw_items(spark, sf)
    runs = raw.select(
        F.col("native_id").alias("source_name"),
        F.col("event_id").cast("string").alias("run_id"),
        F.col("fetched_at").alias("started_at"),
        F.col("fetched_at").alias("ended_at"),
        F.when(F.col("event_type") == "error", "error").otherwise("ok").alias("status"),
        F.col("event_ts").alias("watermark_after"),
    )
    return ingest.watermark_state(runs).select("source_name", "consecutive_fail", "last_run_id")


def window_plan(spark: SparkSession, sf: str) -> DataFrame:
    """Sources seen in the events but not in the log start cold."""
    raw = b.raw_items(spark, sf)
    log = b.run_log(raw).filter(F.col("source_name") != "src:signup")
    plan = ingest.window_plan(ingest.watermark_state(log), b.AS_OF, sources=raw)
    return plan.select("source_name", "kind", "lower", "upper")


def _half_way_windows(raw: DataFrame) -> DataFrame:
    log = b.run_log(raw).filter(F.col("started_at") < b.at(b.SPLIT))
    return ingest.window_plan(ingest.watermark_state(log), b.AS_OF)


def capped_forward_window(spark: SparkSession, sf: str) -> DataFrame:
    """The whole forward window of each source, in the order in which it is read."""
    raw = b.raw_items(spark, sf)
    forward = ingest.capped_window(raw, _half_way_windows(raw), tie_break="event_id")
    return forward.select("source_name", "event_id", "rank")


def next_cursor(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_items(spark, sf)
    windows = _half_way_windows(raw)
    forward = ingest.capped_window(raw, windows, tie_break="event_id")
    return ingest.next_cursor(forward, windows).select(
        "source_name", "rows_forward", "exhausted", "next_cursor", "stalled"
    )


def _coarse(raw: DataFrame) -> DataFrame:
    """Sources with a long name know only the month of an event, so very many share one instant."""
    coarse = F.length("source_name") > 9
    return raw.withColumn("event_ts", F.when(coarse, F.date_trunc("month", "event_ts")).otherwise(F.col("event_ts")))


def cursor_stall(spark: SparkSession, sf: str) -> DataFrame:
    """Whether a run of ``RUN_ITEMS`` items a source gets its cursor off the instant where it stands.

    The limit of a run is the feature: a source with more items at that instant stalls.
    """
    raw = _coarse(b.raw_items(spark, sf))
    start = raw.groupBy("source_name").agg(F.min("event_ts").alias("cursor_ts"))
    windows = start.select(
        "source_name", "cursor_ts", F.lit("forward").alias("kind"),
        F.col("cursor_ts").alias("lower"), b.at(b.AS_OF).alias("upper"),
    )
    forward = ingest.capped_window(raw, windows, RUN_ITEMS, tie_break="event_id")
    return ingest.next_cursor(forward, windows, RUN_ITEMS).select(
        "source_name", "rows_forward", "exhausted", "next_cursor", "stalled"
    )


def late_arrivals(spark: SparkSession, sf: str) -> DataFrame:
    raw = b.raw_items(spark, sf)
    late = ingest.late_arrivals(raw, b.run_log(raw))
    return late.withColumn("p99_seconds", F.round("p99_seconds", 6))


def bronze_summary(spark: SparkSession, sf: str) -> DataFrame:
    return ingest.source_summary(b.raw_items(spark, sf))


def recent_runs(spark: SparkSession, sf: str) -> DataFrame:
    runs = ingest.recent_runs(b.run_log(b.raw_items(spark, sf)))
    return runs.select(
        "started_at", "source_name", "status", "rows_fetched", "rows_new", "error_msg"
    )


def stream_ingest(spark: SparkSession, sf: str) -> DataFrame:
    b.configure(spark)
    root = scratch_dir(spark, "stream")
    lake = Lake(spark, f"{root}/lake")
    # A glob, as a stream takes a folder or a pattern and the table may be one file.
    events = read_landed(spark, f"{sf}/events*", b.SCHEMAS["events"])
    columns = [c.split()[0] for c in RAW_ITEM.replace("\n", " ").split(",")]
    ingest_stream(
        b.raw_items_of(events).select(*columns), lake, f"{root}/checkpoint"
    ).awaitTermination()
    return lake.raw_items().select("source_name", "native_id", "payload_hash", "event_ts")


def payload_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents as raw items: English ones as feed entries, the rest as items."""
    docs = b.documents(spark, sf)
    feed = F.to_json(
        F.struct(
            F.col("title"),
            F.col("body").alias("summary"),
            F.col("url").alias("abs_url"),
            F.lit("v1").alias("version"),
            F.array("source", "lang").alias("authors"),
            F.array(F.concat(F.lit("cs."), F.col("source"))).alias("categories"),
            F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"),
        )
    )
    item = F.to_json(
        F.struct(
            F.col("title"),
            F.col("body").alias("text"),
            F.when(F.col("lang") == "fr", F.col("url")).alias("url"),
            F.col("source").alias("by"),
            F.unix_seconds("published_at").alias("time"),
        )
    )
    english = F.col("lang") == "en"
    return docs.select(
        F.when(english, "arxiv:cs.XX").otherwise("hackernews:top").alias("source_name"),
        F.col("doc_id").alias("native_id"),
        F.when(english, feed).otherwise(item).alias("payload"),
        F.col("content_hash").alias("payload_hash"),
        F.col("published_at").alias("event_ts"),
        (F.col("published_at") + F.expr("interval 1 hour")).alias("fetched_at"),
        F.col("source").alias("origin"),
    )


def parse_documents(spark: SparkSession, sf: str) -> DataFrame:
    raw = payload_documents(spark, sf)
    docs = documents.unify(documents.parse_feed(raw), documents.parse_items(raw))
    return docs.select("doc_id", "source", "title", "url", "published_at")


def document_union(spark: SparkSession, sf: str) -> DataFrame:
    raw = payload_documents(spark, sf)
    docs = documents.unify(documents.parse_feed(raw), documents.parse_items(raw))
    return docs.select(
        "doc_id",
        "source_name",
        "version",
        F.array_join("authors", "|").alias("authors"),
        F.array_join("categories", "|").alias("categories"),
        F.length("body").alias("body_chars"),
        "content_hash",
        "fetched_at",
    )


def content_hash(spark: SparkSession, sf: str) -> DataFrame:
    return b.documents(spark, sf).select("doc_id", "content_hash")


def version_split(spark: SparkSession, sf: str) -> DataFrame:
    """Every document id with a revision suffix, except those of source src0."""
    number = F.substring("source", 4, 10)
    docs = b.table(spark, sf, "documents").select(
        F.when(F.col("source") == "src0", F.col("doc_id").cast("string"))
        .otherwise(F.concat(F.col("doc_id").cast("string"), F.lit("v"), number))
        .alias("versioned_id")
    )
    base, version = split_version(F.col("versioned_id"))
    return docs.select("versioned_id", base.alias("native_id"), version.alias("version"))


def daily_last_metric(spark: SparkSession, sf: str) -> DataFrame:
    daily = metrics.daily_last(b.observations(b.raw_items(spark, sf)))
    return daily.withColumns(
        {
            "comments": F.col("comments").cast("double"),
            "metric_date": F.col("metric_date").cast("string"),
        }
    )


def metric_daily_delta(spark: SparkSession, sf: str) -> DataFrame:
    daily = metrics.daily_last(b.observations(b.raw_items(spark, sf)))
    delta = F.col("observed_delta").cast("double").alias("observed_delta")
    return metrics.daily_delta(daily).select("doc_id", "metric_date", "score", delta)


def metric_delta(spark: SparkSession, sf: str) -> DataFrame:
    latest = metrics.latest_delta(metrics.daily_last(b.observations(b.raw_items(spark, sf))))
    return latest.withColumn("observed_delta", F.col("observed_delta").cast("double"))


def velocity(spark: SparkSession, sf: str) -> DataFrame:
    latest = metrics.latest_delta(metrics.daily_last(b.observations(b.raw_items(spark, sf))))
    speed = metrics.velocity(b.documents(spark, sf), latest, b.AS_OF)
    return speed.select("doc_id", F.round("velocity_per_day", 6).alias("velocity_per_day"))


QUERIES = {
    "payload_hash": payload_hash,
    "idempotent_append": idempotent_append,
    "payload_history": payload_history,
    "committed_rows": committed_rows,
    "json_item_source": json_item_source,
    "listing_top_n": listing_top_n,
    "latest_per_key": latest_of_item,
    "upsert_merge": upsert_merge,
    "incremental_lookback": incremental_lookback,
    "watermark_state": watermark_state,
    "consecutive_fail": consecutive_fail,
    "window_plan": window_plan,
    "capped_forward_window": capped_forward_window,
    "next_cursor": next_cursor,
    "cursor_stall": cursor_stall,
    "late_arrivals": late_arrivals,
    "bronze_summary": bronze_summary,
    "recent_runs": recent_runs,
    "stream_ingest": stream_ingest,
    "parse_documents": parse_documents,
    "document_union": document_union,
    "content_hash": content_hash,
    "split_version": version_split,
    "daily_last_metric": daily_last_metric,
    "metric_daily_delta": metric_daily_delta,
    "metric_delta": metric_delta,
    "velocity": velocity,
}

_FORWARD = f"""
    SELECT r.source_name, r.event_id, r.event_ts, s.cursor_ts,
           row_number() OVER (PARTITION BY r.source_name ORDER BY r.event_ts, r.event_id) AS rank,
           count(*) OVER (PARTITION BY r.source_name) AS n
    FROM raw_item r
    JOIN (SELECT source_name, max(watermark_after) AS cursor_ts FROM run_log
          WHERE started_at < TIMESTAMP '{b.SPLIT}' AND status <> 'error'
          GROUP BY source_name) s ON s.source_name = r.source_name
    WHERE r.event_ts BETWEEN s.cursor_ts AND TIMESTAMP '{b.AS_OF}' - INTERVAL 15 MINUTE
"""

_ITEM_DOC = """
    SELECT CASE WHEN lang = 'en' THEN 'arxiv' ELSE 'hackernews' END AS kind,
           CASE WHEN lang = 'en' THEN 'arxiv:' ELSE 'hackernews:' END || doc_id AS full_id, *
    FROM doc
"""

ORACLE = {
    "payload_hash": """
        SELECT event_id, substr(sha256('{"event_type":"' || event_type || '","user_id":'
               || user_id || '}'), 1, 32) AS payload_hash
        FROM events
    """,
    "idempotent_append": oracle(
        ["raw_item"],
        f"""
        SELECT source_name, native_id, payload_hash, max(event_ts) AS event_ts FROM raw_item s
        WHERE event_ts >= TIMESTAMP '{b.SPLIT}'
          AND NOT EXISTS (SELECT 1 FROM raw_item c
                          WHERE c.event_ts < TIMESTAMP '{b.SPLIT}'
                            AND c.source_name = s.source_name AND c.native_id = s.native_id
                            AND c.payload_hash = s.payload_hash)
        GROUP BY 1, 2, 3
        """,
    ),
    "payload_history": oracle(
        ["raw_item"],
        """
        SELECT native_id, payload_hash, first_fetched_at,
               row_number() OVER (PARTITION BY native_id
                                  ORDER BY first_fetched_at, payload_hash) AS version_no
        FROM (SELECT native_id, payload_hash, min(fetched_at) AS first_fetched_at
              FROM raw_item GROUP BY 1, 2)
        """,
    ),
    "committed_rows": oracle(
        ["raw_item", "run_log"],
        """
        SELECT r.event_id, r.source_name FROM raw_item r
        JOIN run_log l ON l.run_id = r.run_id AND l.source_name = r.source_name
        WHERE l.status <> 'error'
        """,
    ),
    "json_item_source": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               date_trunc('second', ts) AS event_ts
        FROM events WHERE event_type IN ('click', 'view', 'purchase') AND NOT value > 300
    """,
    "listing_top_n": """
        SELECT event_type, event_id,
               row_number() OVER (PARTITION BY event_type ORDER BY value DESC, event_id) AS rank
        FROM events QUALIFY rank <= 20
    """,
    "latest_per_key": oracle(
        ["raw_item"],
        """
        SELECT native_id, event_id, fetched_at FROM raw_item
        QUALIFY row_number() OVER (PARTITION BY native_id
                                   ORDER BY fetched_at DESC, event_id DESC) = 1
        """,
    ),
    "upsert_merge": oracle(
        ["raw_item"],
        f"""
        SELECT native_id, payload_hash, fetched_at FROM raw_item
        QUALIFY row_number() OVER (PARTITION BY native_id
            ORDER BY event_ts >= TIMESTAMP '{b.SPLIT}' DESC, fetched_at DESC, event_id DESC) = 1
        """,
    ),
    "incremental_lookback": oracle(
        ["raw_item"],
        f"""
        SELECT event_id FROM raw_item
        WHERE fetched_at > (SELECT max(fetched_at) FROM raw_item
                            WHERE event_ts < TIMESTAMP '{b.SPLIT}') - INTERVAL 2 DAY
        """,
    ),
    "watermark_state": oracle(["watermark"], "SELECT * FROM watermark"),
    "consecutive_fail": oracle(
        ["raw_item"],
        """
        SELECT native_id AS source_name,
               min(CASE WHEN event_type <> 'error' THEN back - 1 ELSE n END)
                   AS consecutive_fail,
               max(CASE WHEN back = 1 THEN CAST(event_id AS VARCHAR) END) AS last_run_id
        FROM (SELECT *, row_number() OVER (
                         PARTITION BY native_id
                         ORDER BY fetched_at DESC, CAST(event_id AS VARCHAR) DESC) AS back,
                     count(*) OVER (PARTITION BY native_id) AS n
              FROM raw_item)
        GROUP BY native_id
        """,
    ),
    "window_plan": oracle(
        ["watermark", "raw_item"],
        f"""
        SELECT n.source_name, 'forward' AS kind,
               coalesce(w.cursor_ts, TIMESTAMP '{b.AS_OF}' - INTERVAL 15 MINUTE - INTERVAL 7 DAY)
                   AS lower,
               TIMESTAMP '{b.AS_OF}' - INTERVAL 15 MINUTE AS upper
        FROM (SELECT DISTINCT source_name FROM raw_item) n
        LEFT JOIN watermark w
               ON w.source_name = n.source_name AND w.source_name <> 'src:signup'
        UNION ALL
        SELECT source_name, 'backfill', cursor_ts - INTERVAL 2 DAY, cursor_ts
        FROM watermark WHERE source_name <> 'src:signup' AND cursor_ts IS NOT NULL
        """,
    ),
    "capped_forward_window": oracle(
        ["raw_item", "run_log"], f"SELECT source_name, event_id, rank FROM ({_FORWARD})"
    ),
    "next_cursor": oracle(
        ["raw_item", "run_log"],
        f"""
        SELECT source_name, count(*) AS rows_forward, true AS exhausted,
               TIMESTAMP '{b.AS_OF}' - INTERVAL 15 MINUTE AS next_cursor, false AS stalled
        FROM ({_FORWARD}) GROUP BY source_name
        """,
    ),
    "cursor_stall": oracle(
        ["raw_item"],
        f"""
        SELECT source_name, least(any_value(n), {RUN_ITEMS}) AS rows_forward, any_value(n) <= {RUN_ITEMS} AS exhausted,
               if(any_value(n) <= {RUN_ITEMS}, TIMESTAMP '{b.AS_OF}', max(moment) FILTER (place <= {RUN_ITEMS})) AS next_cursor,
               any_value(n) > {RUN_ITEMS} AND max(moment) FILTER (place <= {RUN_ITEMS}) <= min(moment) AS stalled
        FROM (SELECT *, row_number() OVER (PARTITION BY source_name ORDER BY moment, event_id) AS place,
                     count(*) OVER (PARTITION BY source_name) AS n
              FROM (SELECT source_name, event_id, if(length(source_name) > 9,
                           CAST(date_trunc('month', event_ts) AS TIMESTAMP), event_ts) AS moment
                    FROM raw_item)
              WHERE moment <= TIMESTAMP '{b.AS_OF}')
        GROUP BY source_name
        """,
    ),
    "late_arrivals": oracle(
        ["raw_item", "run_log"],
        """
        SELECT source_name, count(*) AS n, max(s) AS worst_seconds,
               round(quantile_cont(s, 0.99), 6) AS p99_seconds
        FROM (SELECT r.source_name,
                     (epoch_us(l.watermark_before) - epoch_us(r.event_ts)) // 1000000 AS s
              FROM raw_item r
              JOIN run_log l ON l.run_id = r.run_id AND l.source_name = r.source_name
              WHERE r.event_ts < l.watermark_before)
        GROUP BY source_name
        """,
    ),
    "bronze_summary": oracle(
        ["raw_item"],
        """
        SELECT source_name, count(*) AS n, min(event_ts) AS first_event,
               max(event_ts) AS last_event
        FROM raw_item GROUP BY source_name
        """,
    ),
    "recent_runs": oracle(
        ["run_log"],
        """
        SELECT started_at, source_name, status, rows_fetched, rows_new, error_msg FROM run_log
        ORDER BY started_at DESC, run_id, source_name LIMIT 10
        """,
    ),
    "stream_ingest": oracle(
        ["raw_item"],
        """
        SELECT source_name, native_id, payload_hash, max(event_ts) AS event_ts
        FROM raw_item GROUP BY 1, 2, 3
        """,
    ),
    "parse_documents": oracle(
        ["doc"],
        f"""
        SELECT full_id AS doc_id, kind AS source, title, published_at,
               CASE WHEN lang IN ('en', 'fr') THEN url
                    ELSE 'https://news.ycombinator.com/item?id=' || doc_id END AS url
        FROM ({_ITEM_DOC})
        """,
    ),
    "document_union": oracle(
        ["doc"],
        f"""
        SELECT full_id AS doc_id,
               CASE WHEN lang = 'en' THEN 'arxiv:cs.XX' ELSE 'hackernews:top' END AS source_name,
               CASE WHEN lang = 'en' THEN 'v1' END AS version,
               CASE WHEN lang = 'en' THEN source || '|' || lang ELSE source END AS authors,
               CASE WHEN lang = 'en' THEN 'cs.' || source ELSE '' END AS categories,
               length(body) AS body_chars, content_hash,
               published_at + INTERVAL 1 HOUR AS fetched_at
        FROM ({_ITEM_DOC})
        """,
    ),
    "content_hash": oracle(["doc"], "SELECT doc_id, content_hash FROM doc"),
    "split_version": """
        SELECT CASE WHEN source = 'src0' THEN CAST(doc_id AS VARCHAR)
                    ELSE doc_id || 'v' || substr(source, 4) END AS versioned_id,
               CAST(doc_id AS VARCHAR) AS native_id,
               CASE WHEN source <> 'src0' THEN 'v' || substr(source, 4) END AS version
        FROM documents
    """,
    "daily_last_metric": oracle(
        ["metric_daily"],
        """
        SELECT * REPLACE (CAST(comments AS DOUBLE) AS comments,
                          CAST(metric_date AS VARCHAR) AS metric_date)
        FROM metric_daily
        """,
    ),
    "metric_daily_delta": oracle(
        ["metric_delta"],
        "SELECT * REPLACE (CAST(observed_delta AS DOUBLE) AS observed_delta) FROM metric_delta",
    ),
    "metric_delta": oracle(
        ["metric_latest"],
        "SELECT * REPLACE (CAST(observed_delta AS DOUBLE) AS observed_delta) FROM metric_latest",
    ),
    "velocity": oracle(
        ["velocity"], "SELECT doc_id, round(velocity_per_day, 6) AS velocity_per_day FROM velocity"
    ),
}
