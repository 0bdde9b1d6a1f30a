"""The refresh of the derived tables, from raw items to the daily digest."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, functions as F

from trendspark.operators import alerts, digest, documents, embedding, metrics, quality, ranking
from trendspark.sinks import Lake


def refresh_documents(lake: Lake) -> None:
    """Merge the latest revision of every recently fetched item.

    The first run and later runs share this plan; an empty table only moves
    the lookback to 1970. The lookback is on the commit of a run, so a row that
    landed late is merged whatever its own times say.
    """
    bound = documents.lookback_bound(lake.read("document"))
    raw = lake.raw_items(committed_after=bound)
    docs = documents.unify(documents.parse_feed(raw), documents.parse_items(raw))
    lake.write_upsert("document", docs, ["doc_id"])


def refresh_metrics(lake: Lake) -> None:
    """Merge the daily observations of every day in the lookback, day by day whole."""
    bound = documents.lookback_bound(
        lake.read("metric_daily"), target_column="observed_at", whole_days=True
    )
    # A run may reach over midnight; its rows of the day before the bound are merged already.
    raw = lake.raw_items(committed_after=bound).filter(F.col("fetched_at") > bound)
    observations = metrics.item_observations(raw)
    daily = metrics.daily_last(observations)
    lake.write_upsert("metric_daily", daily, ["doc_id", "metric_date"])


def embed_backlog(
    lake: Lake,
    encoder_factory: Callable[[], embedding.Encoder],
    model: str,
    as_of: datetime,
    cap: int | None = None,
) -> None:
    """Embed what is missing and append it; the same model name drives both."""
    todo = embedding.backlog(lake.read("document"), lake.read("embedding"), model, cap)
    lake.append("embedding", embedding.encode(todo, encoder_factory, model, as_of))


def sync_interests(
    lake: Lake,
    profile: DataFrame,
    encoder_factory: Callable[[], embedding.Encoder],
    model: str,
    as_of: datetime,
    rebuild: bool = False,
) -> None:
    """Bring the interest table in line with the profile, one partition per model.

    A profile without topics is an error: it would leave the stored ones in place.
    """
    if profile.isEmpty():
        raise ValueError("the profile has no topics")
    current = lake.read("interest_embedding").filter(F.col("model_name") == model)
    state = embedding.sync_dimension(profile, current, encoder_factory, model, as_of, rebuild)
    lake.replace_partitions("interest_embedding", state, "model_name")


def scores(lake: Lake, config: DataFrame, model: str, as_of: datetime) -> DataFrame:
    docs = lake.read("document")
    affinity = ranking.document_affinity(
        docs, lake.read("embedding"), lake.read("interest_embedding"), model
    )
    latest = metrics.latest_delta(lake.read("metric_daily"))
    return ranking.score(docs, affinity, latest, config, as_of)


def refresh_ranking(
    lake: Lake,
    config: DataFrame,
    model: str,
    as_of: datetime,
    floor: float = digest.AFFINITY_FLOOR,
) -> None:
    """Rewrite the scores, then choose the day's selection from the stored table."""
    lake.overwrite("document_score", scores(lake, config, model, as_of))
    chosen = digest.dispatch(
        lake.read("document_score"), lake.read("delivery"), config, as_of, floor
    )
    lake.replace_partitions("digest_dispatch", chosen, "digest_date", [as_of.date()])


def refresh_quality(lake: Lake, as_of: datetime) -> None:
    """Rewrite the check results, then append the alerts that are due."""
    log = lake.read("run_log")
    score = lake.read("document_score").select("doc_id", "best_interest_label")
    lake.overwrite(
        "check_result",
        quality.run_checks(log, lake.read("document"), score, as_of),
    )
    due = alerts.alert_dispatch(lake.read("check_result"), lake.read("alert"), as_of)
    lake.append("alert", due)


def open_items(lake: Lake, as_of: datetime) -> DataFrame:
    """Today's undelivered items, rendered."""
    pending = digest.pending_items(
        lake.read("digest_dispatch"), lake.read("document"), lake.read("delivery"), as_of
    )
    return digest.render(pending)


def record_delivery(
    lake: Lake, items: DataFrame, status: str, as_of: datetime, error_msg: str | None = None
) -> None:
    lake.append("delivery", digest.delivery_rows(items, status, as_of, error_msg))
