"""Declared schemas of the lake tables and the landed inputs."""

from __future__ import annotations

RAW_ITEM = """
    source_name string, native_id string, payload_hash string, payload string,
    event_ts timestamp, fetched_at timestamp, run_id string
"""
# The most selective column first: sorts then decide on a short prefix.
RAW_ITEM_KEY = ["payload_hash", "native_id", "source_name"]

RUN_LOG = """
    run_id string, source_name string, started_at timestamp, ended_at timestamp,
    status string, rows_fetched bigint, rows_new bigint,
    watermark_before timestamp, watermark_after timestamp, error_msg string
"""

WATERMARK = """
    source_name string, cursor_ts timestamp, last_run_id string,
    last_success_at timestamp, consecutive_fail bigint, updated_at timestamp
"""

# The revision of a merged table's part that readers see: the highest one.
PUBLICATION = """
    table_name string, part string, revision bigint, published_at timestamp
"""

EMBEDDING = """
    doc_id string, model_name string, content_hash string, dim int,
    vec array<float>, embedded_at timestamp
"""

INTEREST_EMBEDDING = """
    interest_key string, label string, model_name string, text_hash string,
    dim int, vec array<float>, embedded_at timestamp
"""

DELIVERY = """
    dispatch_id string, doc_id string, digest_date date, status string,
    sent_at timestamp, error_msg string
"""

DOCUMENT = """
    doc_id string, source string, source_name string, native_id string,
    title string, body string, url string, version string,
    authors array<string>, categories array<string>,
    published_at timestamp, source_updated_at timestamp,
    content_hash string, payload_hash string, fetched_at timestamp
"""

METRIC_DAILY = """
    doc_id string, metric_date date, score int, comments int, observed_at timestamp
"""

DOCUMENT_SCORE = """
    doc_id string, source string, title string, url string, published_at timestamp,
    best_interest string, best_interest_label string, affinity double, age_hours bigint,
    recency_decay double, engagement_boost double, velocity_per_day double,
    engagement_score int, score double, scored_at timestamp
"""

DISPATCH = """
    dispatch_id string, digest_date date, doc_id string, source string, title string,
    url string, published_at timestamp, best_interest_label string, affinity double,
    recency_decay double, engagement_boost double, score double, rank_in_source int,
    selected_at timestamp
"""

ALERT = """
    alert_id string, check_name string, check_date date, source_name string,
    severity string, observed_value double, expected_value double,
    detail string, alerted_at timestamp
"""

CHECK_RESULT = """
    check_name string, check_date date, source_name string, status string,
    observed_value double, expected_value double, detail string,
    evaluated_at timestamp
"""

SOURCE_CONFIG = """
    source string, half_life_hours int, digest_quota int, authority_note string
"""

# Payload of a feed entry and of a mutating item, as they sit in raw_item.payload.
FEED_PAYLOAD = """
    source string, arxiv_id string, version string, title string, summary string,
    authors array<string>, categories array<string>,
    published string, updated string, abs_url string, pdf_url string
"""
ITEM_PAYLOAD = """
    source string, hn_id bigint, title string, url string, text string,
    `by` string, score string, descendants string, time string
"""

# A landed item file: one JSON object per line.
LANDED_ITEM = """
    id bigint, type string, title string, url string, text string, `by` string,
    score bigint, descendants bigint, time bigint, dead boolean, deleted boolean
"""
