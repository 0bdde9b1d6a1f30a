"""The daily selection: quotas, pending items, rendering, tallies."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from trendspark import messages as say
from trendspark.functions.text import collapse, escape_link_label, escape_markup, strip
from trendspark.functions.timeutil import as_of_column
from trendspark.operators.joins import maybe_among, spread_join
from trendspark.operators.ordering import top_of_each

AFFINITY_FLOOR = 0.45
EXCERPT_CHARS = 220
MIN_BODY_CHARS = 200
DISPLAY_ZONE = "Asia/Seoul"


def dispatch(
    scores: DataFrame,
    delivery: DataFrame,
    config: DataFrame,
    as_of: datetime | str | Column,
    floor: float = AFFINITY_FLOOR,
) -> DataFrame:
    """Today's selection: the best ``digest_quota`` documents of each source.

    Documents delivered with success are out; a failed delivery comes back.
    The floor is inclusive. Each slice of a source is cut to the source's quota
    where the quotas are joined, then the source over its slices.
    """
    now = as_of_column(as_of)
    sent = delivery.filter(F.col("status") == "sent").select("doc_id").distinct()
    candidates = (
        scores.filter((F.col("affinity") >= floor) & F.col("title").isNotNull())
        .join(sent, "doc_id", "left_anti")
        .drop("half_life_hours", "digest_quota")
    )
    with_quota = spread_join(candidates, config, ["source"], ["doc_id"], "_slice")
    order = [F.col("score").desc_nulls_last(), F.col("doc_id")]
    chosen = top_of_each(
        with_quota, ["source"], "_slice", order, F.col("digest_quota"), "rank_in_source"
    )
    return chosen.select(
        F.concat(F.to_date(now).cast("string"), F.lit(":"), F.col("doc_id")).alias("dispatch_id"),
        F.to_date(now).alias("digest_date"),
        "doc_id",
        "source",
        "title",
        "url",
        "published_at",
        "best_interest_label",
        "affinity",
        "recency_decay",
        "engagement_boost",
        "score",
        F.col("rank_in_source").cast("int").alias("rank_in_source"),
        now.alias("selected_at"),
    )


def pending_items(
    dispatched: DataFrame, docs: DataFrame, delivery: DataFrame, as_of: datetime | str | Column
) -> DataFrame:
    """Selected today and not delivered with success, with their body.

    A day's selection is small and a document table is not: a bitmap of the
    selected ids, the same size for any selection, keeps nearly all other bodies
    out of the join's shuffle. It is a scalar subquery, made when the plan runs.
    """
    today = F.to_date(as_of_column(as_of))
    sent = delivery.filter(F.col("status") == "sent").select("dispatch_id").distinct()
    open_items = dispatched.filter(F.col("digest_date") == today).join(
        sent, "dispatch_id", "left_anti"
    )
    return (
        open_items.join(maybe_among(docs.select("doc_id", "body"), open_items, "doc_id"), "doc_id")
        .select(
            "dispatch_id",
            "digest_date",
            "doc_id",
            "source",
            "title",
            "url",
            "published_at",
            "best_interest_label",
            "affinity",
            "score",
            "rank_in_source",
            "body",
        )
        .orderBy("source", "rank_in_source")
    )


def summary_eligibility(
    docs: DataFrame, min_chars: int = MIN_BODY_CHARS, prompt_chars: int | None = None
) -> DataFrame:
    """Whether a body is long enough to summarise, and the text to send.

    The length is that of the whole body, and so is the prompt's, unless
    ``prompt_chars`` says how much of it the summariser takes.
    """
    prompt = F.col("body") if prompt_chars is None else F.substring("body", 1, prompt_chars)
    chars = F.length(strip(F.coalesce("body", F.lit(""))))
    enough = chars >= min_chars
    return docs.select(
        "doc_id",
        chars.alias("body_chars"),
        F.when(enough, "eligible").otherwise("too_short").alias("status"),
        F.when(enough, prompt).alias("prompt_body"),
    )


def fallback_excerpt(body: Column, limit: int = EXCERPT_CHARS) -> Column:
    text = collapse(F.coalesce(body, F.lit("")))
    cut = F.concat(
        F.substring(text, 1, limit), F.when(F.length(text) > limit, "…").otherwise("")
    )
    return F.when(text == "", say.NO_BODY).otherwise(cut)


def render(
    items: DataFrame,
    labels: dict[str, str] | None = None,
    zone: str = DISPLAY_ZONE,
    zone_label: str = "KST",
    excerpt_chars: int = EXCERPT_CHARS,
) -> DataFrame:
    """Message text per item: a linked title with its summary, and a context line.

    Uses the ``summary`` column where present and non-empty, else an excerpt of
    the body. The link target is not escaped, its label is.
    """
    labels = say.SOURCE_LABELS if labels is None else labels
    known = F.create_map(*[F.lit(x) for pair in labels.items() for x in pair])
    excerpt = fallback_excerpt(F.col("body"), excerpt_chars)
    if "summary" in items.columns:
        excerpt = F.coalesce(F.nullif(F.col("summary"), F.lit("")), excerpt)
    local_time = F.date_format(F.from_utc_timestamp("published_at", zone), "MM-dd HH:mm")
    section = say.fill(
        say.ITEM_SECTION,
        url=F.col("url"),
        title=escape_link_label(F.col("title")),
        summary=escape_markup(excerpt),
    )
    context = say.fill(
        say.ITEM_CONTEXT,
        source=F.coalesce(F.try_element_at(known, F.col("source")), F.col("source")),
        label=escape_markup(F.col("best_interest_label")),
        affinity=F.format_string("%.2f", F.col("affinity")),
        time=F.concat(local_time, F.lit(f" {zone_label}")),
    )
    return items.withColumn("section", section).withColumn("context", context)


def message_blocks(
    rendered: DataFrame, warnings: DataFrame, title: str, as_of: datetime | str | Column
) -> DataFrame:
    """The message as ordered rows: a header, the warnings, three blocks per item.

    Sort by (part, source, rank_in_source, block). Without items there is no
    message. ``warnings`` are the (line_no, text) banner lines.
    """
    date = F.to_date(as_of_column(as_of)).cast("string")
    none = F.lit(None).cast("string")
    columns = ["part", "source", "rank_in_source", "block", "type", "text"]

    def single(df: DataFrame, part: int, kind: str, text: Column) -> DataFrame:
        return df.select(
            F.lit(part).alias("part"),
            none.alias("source"),
            F.lit(None).cast("int").alias("rank_in_source"),
            F.lit(0).alias("block"),
            F.lit(kind).alias("type"),
            text.alias("text"),
        )

    present = rendered.limit(1).select(F.lit(1).alias("one"))
    header = single(present, 0, "header", F.concat(F.lit(f"{title} · "), date))
    # At most the listed lines, the overflow and the undecided count.
    banner = warnings.groupBy().agg(
        F.array_sort(F.collect_list(F.struct("line_no", "text"))).alias("lines")
    )
    marked = F.transform("lines", lambda line: F.concat(F.lit(say.BANNER_MARK), line["text"]))
    notice = single(
        banner.filter(F.size("lines") > 0).join(present, F.lit(True), "left_semi"),
        1,
        "section",
        F.array_join(marked, "\n"),
    )

    def block(number: int, kind: str, text: Column) -> Column:
        return F.struct(
            F.lit(number).alias("block"), F.lit(kind).alias("type"), text.alias("text")
        )

    blocks = F.array(
        block(0, "divider", none),
        block(1, "section", F.col("section")),
        block(2, "context", F.col("context")),
    )
    items = rendered.select(
        F.lit(2).alias("part"), "source", "rank_in_source", F.inline(blocks)
    )
    return header.unionByName(notice).unionByName(items).select(*columns)


def delivery_rows(
    items: DataFrame, status: str, as_of: datetime | str | Column, error_msg: str | None = None
) -> DataFrame:
    """One delivery attempt per item, ready to be appended."""
    return items.select(
        "dispatch_id",
        "doc_id",
        "digest_date",
        F.lit(status).alias("status"),
        as_of_column(as_of).alias("sent_at"),
        F.lit(error_msg).cast("string").alias("error_msg"),
    )


def tally(items: DataFrame) -> DataFrame:
    """Counts of one run from its items' ``summary_status``.

    ``failed`` and ``skipped`` differ: too little text is no failure. The
    warning appears only when every attempted summary failed.
    """
    status = F.col("summary_status")
    counted = items.agg(
        F.count(F.lit(1)).alias("items"),
        F.count(F.when(status == "summarized", 1)).alias("summarized"),
        F.count(F.when(status == "failed", 1)).alias("failed"),
        F.count(F.when(status == "skipped", 1)).alias("skipped"),
    )
    all_failed = (F.col("failed") > 0) & (F.col("failed") == F.col("items") - F.col("skipped"))
    return counted.withColumn("warning", F.when(all_failed, say.SUMMARY_FAILED))
