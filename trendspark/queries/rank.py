"""Queries over embeddings, affinity, score and the digest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from trendspark.operators import digest, embedding, metrics, quality, ranking
from trendspark.queries import bindings as b
from trendspark.queries.bindings import oracle


def embedding_backlog(spark: SparkSession, sf: str) -> DataFrame:
    """What each of two models still has to embed; the second has no vectors yet."""
    docs = b.documents(spark, sf)
    vectors = b.embeddings(spark, sf, docs)
    per_model = [
        embedding.backlog(docs, vectors, model).select(
            F.lit(model).alias("model_name"), "doc_id"
        )
        for model in (b.MODEL, "m1")
    ]
    return per_model[0].unionByName(per_model[1])


def embed_batch(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf)
    todo = embedding.backlog(docs, b.embeddings(spark, sf, docs), b.MODEL)
    vectors = embedding.encode(todo, embedding.hashing_encoder(), b.MODEL, b.AS_OF)
    squares = F.aggregate(
        F.transform("vec", lambda x: x.cast("double") * x.cast("double")),
        F.lit(0.0),
        lambda acc, x: acc + x,
    )
    return vectors.select("doc_id", "dim", F.round(F.sqrt(squares), 4).alias("norm"))


def dimension_sync(spark: SparkSession, sf: str) -> DataFrame:
    """Labels as topics: the stored set lacks one, has one more and one stale text."""
    labels = b.table(spark, sf, "embeddings").groupBy("label").agg(F.count("*").alias("n"))
    key = F.col("label").cast("string").alias("interest_key")
    fresh = F.md5(F.concat(F.lit("topic "), F.col("n").cast("string")))
    profile = labels.filter("label <> 0").select(key, fresh.alias("text_hash"))
    current = labels.filter("label <> 1").select(
        key,
        F.when(F.col("label") == 2, F.md5(F.lit("old"))).otherwise(fresh).alias("text_hash"),
        F.lit(b.MODEL).alias("model_name"),
    )
    return embedding.sync_actions(profile, current, b.MODEL)


def affinity_pairs(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf)
    pairs = ranking.affinity_pairs(
        docs, b.embeddings(spark, sf, docs), b.interests(spark, sf), b.MODEL
    )
    return pairs.select("doc_id", "interest_key", F.round("affinity", 6).alias("affinity"))


def _affinity(spark: SparkSession, sf: str, docs: DataFrame) -> DataFrame:
    return ranking.document_affinity(
        docs, b.embeddings(spark, sf, docs), b.interests(spark, sf), b.MODEL
    )


def document_affinity(spark: SparkSession, sf: str) -> DataFrame:
    best = _affinity(spark, sf, b.documents(spark, sf))
    return best.withColumn("affinity", F.round("affinity", 6))


def _score(spark: SparkSession, sf: str, docs: DataFrame, config: DataFrame) -> DataFrame:
    latest = metrics.latest_delta(metrics.daily_last(b.observations(b.raw_items(spark, sf))))
    return ranking.score(docs, _affinity(spark, sf, docs), latest, config, b.AS_OF)


def document_score(spark: SparkSession, sf: str) -> DataFrame:
    config = b.source_config(spark, sf)
    scored = _score(spark, sf, b.documents(spark, sf), config)
    rounded = ["affinity", "recency_decay", "engagement_boost", "score"]
    return scored.select(
        "doc_id", "source", "best_interest", *[F.round(c, 6).alias(c) for c in rounded]
    )


def _dispatch(spark: SparkSession, sf: str, docs: DataFrame) -> DataFrame:
    config = b.source_config(spark, sf)
    scores = _score(spark, sf, docs, config)
    return digest.dispatch(scores, b.delivery(spark, sf), config, b.AS_OF, b.FLOOR)


def digest_dispatch(spark: SparkSession, sf: str) -> DataFrame:
    return _dispatch(spark, sf, b.documents(spark, sf)).select(
        "dispatch_id",
        "digest_date",
        "doc_id",
        "source",
        "best_interest_label",
        F.round("score", 6).alias("score"),
        "rank_in_source",
    )


def _pending(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf)
    return digest.pending_items(
        _dispatch(spark, sf, docs), docs, b.attempts_today(docs), b.AS_OF
    )


def pending_items(spark: SparkSession, sf: str) -> DataFrame:
    return _pending(spark, sf).select(
        "dispatch_id",
        "doc_id",
        "source",
        "title",
        "rank_in_source",
        F.length("body").alias("body_chars"),
    )


def render_digest(spark: SparkSession, sf: str) -> DataFrame:
    rendered = digest.render(_pending(spark, sf), labels=LABELS)
    return rendered.select("dispatch_id", "section", "context")


LABELS = {"src1": "논문", "src2": "HN"}


def message_blocks(spark: SparkSession, sf: str) -> DataFrame:
    """The digest as ordered blocks, warning of documents that share a title."""
    rendered = digest.render(_pending(spark, sf), labels=LABELS)
    docs = b.documents(spark, sf)
    warnings = quality.check_duplicate(docs).select(
        F.lit(1).alias("line_no"), F.col("detail").alias("text")
    )
    blocks = digest.message_blocks(rendered, warnings, "digest", b.AS_OF)
    return blocks.withColumn("rank_in_source", F.col("rank_in_source").cast("double"))


def summary_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    eligible = digest.summary_eligibility(b.documents(spark, sf))
    return eligible.select(
        "doc_id",
        "body_chars",
        "status",
        F.length("prompt_body").cast("double").alias("prompt_chars"),
    )


def digest_tally(spark: SparkSession, sf: str) -> DataFrame:
    """Summaries of all documents: short ones skipped, those judged poor failed."""
    docs = b.documents(spark, sf)
    poor = b.table(spark, sf, "labels").filter("quality = 0").select(
        F.col("doc_id").cast("string").alias("doc_id"), F.lit(True).alias("poor")
    )
    status = (
        F.when(F.col("status") == "too_short", "skipped")
        .when(F.col("poor"), "failed")
        .otherwise("summarized")
    )
    items = digest.summary_eligibility(docs).join(poor, "doc_id", "left").select(
        status.alias("summary_status")
    )
    return digest.tally(items)


def similar_top_k(spark: SparkSession, sf: str) -> DataFrame:
    docs = b.documents(spark, sf)
    query = b.interests(spark, sf).filter("interest_key = '0'").select("vec")
    top = ranking.similar_top_k(docs, b.embeddings(spark, sf, docs), query, b.MODEL, k=10)
    return top.select("doc_id", "source", "title", F.round("score", 6).alias("score"))


QUERIES = {
    "embedding_backlog": embedding_backlog,
    "embed_batch": embed_batch,
    "dimension_sync": dimension_sync,
    "affinity_pairs": affinity_pairs,
    "document_affinity": document_affinity,
    "document_score": document_score,
    "digest_dispatch": digest_dispatch,
    "pending_items": pending_items,
    "render_digest": render_digest,
    "message_blocks": message_blocks,
    "summary_eligibility": summary_eligibility,
    "digest_tally": digest_tally,
    "similar_top_k": similar_top_k,
}

# The whitespace class of the text functions, and a body's folded excerpt.
_WS = (
    r"[\x{09}-\x{0d}\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
)
_FOLDED = f"trim(regexp_replace(body, '{_WS}', ' ', 'g'))"


def _escaped(sql: str) -> str:
    return f"replace(replace(replace({sql}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


_RENDERED = f"""
    SELECT dispatch_id, source, rank_in_source,
           '*<' || url || '|' || replace({_escaped('title')}, '|', '｜') || '>*' || chr(10)
           || CASE WHEN folded = '' THEN '_(본문 없음 — 링크 참고)_'
                   ELSE {_escaped('substr(folded, 1, 220)')}
                        || CASE WHEN length(folded) > 220 THEN '…' ELSE '' END END AS section,
           '`' || CASE source WHEN 'src1' THEN '논문' WHEN 'src2' THEN 'HN' ELSE source END
           || '` · ' || best_interest_label || ' · 관심도 ' || printf('%.2f', affinity)
           || ' · ' || strftime(published_at + INTERVAL 9 HOUR, '%m-%d %H:%M') || ' KST'
               AS context
    FROM (SELECT *, {_FOLDED} AS folded FROM pending)
"""
_BODY_CHARS = f"length(regexp_replace(body, '^{_WS}|{_WS}$', '', 'g'))"

ORACLE = {
    "embedding_backlog": oracle(
        ["doc", "emb"],
        """
        (SELECT 'm0' AS model_name, d.doc_id FROM doc d
         WHERE NOT EXISTS (SELECT 1 FROM emb e WHERE e.doc_id = d.doc_id
                             AND e.content_hash = d.content_hash))
        UNION ALL
        (SELECT 'm1', d.doc_id FROM doc d)
        """,
    ),
    "embed_batch": oracle(
        ["doc", "emb"],
        """
        SELECT d.doc_id, 64 AS dim, CAST(1.0 AS DOUBLE) AS norm FROM doc d
        WHERE NOT EXISTS (SELECT 1 FROM emb e WHERE e.doc_id = d.doc_id
                            AND e.content_hash = d.content_hash)
        """,
    ),
    "dimension_sync": """
        SELECT DISTINCT CAST(label AS VARCHAR) AS interest_key,
               CASE label WHEN 0 THEN 'delete' WHEN 1 THEN 'insert' WHEN 2 THEN 'update'
                          ELSE 'keep' END AS action
        FROM embeddings
    """,
    "affinity_pairs": oracle(
        ["pair"], "SELECT doc_id, interest_key, round(affinity, 6) AS affinity FROM pair"
    ),
    "document_affinity": oracle(
        ["affinity"],
        """
        SELECT doc_id, round(affinity, 6) AS affinity, best_interest, best_interest_label
        FROM affinity
        """,
    ),
    "document_score": oracle(
        ["score"],
        """
        SELECT doc_id, source, best_interest, round(affinity, 6) AS affinity,
               round(recency_decay, 6) AS recency_decay,
               round(engagement_boost, 6) AS engagement_boost, round(score, 6) AS score
        FROM score
        """,
    ),
    "digest_dispatch": oracle(
        ["dispatch"],
        """
        SELECT dispatch_id, digest_date, doc_id, source, best_interest_label,
               round(score, 6) AS score, rank_in_source
        FROM dispatch
        """,
    ),
    "pending_items": oracle(
        ["pending"],
        """
        SELECT dispatch_id, doc_id, source, title, rank_in_source, length(body) AS body_chars
        FROM pending
        """,
    ),
    "render_digest": oracle(
        ["pending"], f"SELECT dispatch_id, section, context FROM ({_RENDERED})"
    ),
    "message_blocks": oracle(
        ["pending"],
        f"""
        SELECT 0 AS part, NULL AS source, CAST(NULL AS DOUBLE) AS rank_in_source, 0 AS block,
               'header' AS type, 'digest · {b.AS_OF[:10]}' AS text
        WHERE EXISTS (SELECT 1 FROM pending)
        UNION ALL
        SELECT 1, NULL, NULL, 0, 'section',
               '⚠️ ' || CASE WHEN n > 0 THEN '제목이 같은 서로 다른 문서 ' || n || '쌍'
                             ELSE '중복 없음' END
        FROM (SELECT count(*) AS n
              FROM (SELECT lower(trim(title)) FROM doc GROUP BY 1
                    HAVING count(DISTINCT doc_id) > 1))
        WHERE EXISTS (SELECT 1 FROM pending)
        UNION ALL SELECT 2, source, rank_in_source, 0, 'divider', NULL FROM ({_RENDERED})
        UNION ALL SELECT 2, source, rank_in_source, 1, 'section', section FROM ({_RENDERED})
        UNION ALL SELECT 2, source, rank_in_source, 2, 'context', context FROM ({_RENDERED})
        """,
    ),
    "summary_eligibility": oracle(
        ["doc"],
        f"""
        SELECT doc_id, body_chars,
               CASE WHEN body_chars >= 200 THEN 'eligible' ELSE 'too_short' END AS status,
               CAST(CASE WHEN body_chars >= 200 THEN length(body) END AS DOUBLE)
                   AS prompt_chars
        FROM (SELECT *, {_BODY_CHARS} AS body_chars FROM doc)
        """,
    ),
    "digest_tally": oracle(
        ["doc"],
        f"""
        SELECT count(*) AS items,
               count(*) FILTER (WHERE c >= 200 AND NOT poor) AS summarized,
               count(*) FILTER (WHERE c >= 200 AND poor) AS failed,
               count(*) FILTER (WHERE c < 200) AS skipped,
               CASE WHEN count(*) FILTER (WHERE c >= 200 AND NOT poor) = 0
                     AND count(*) FILTER (WHERE c >= 200 AND poor) > 0
                    THEN '요약 생성 실패 — 원문으로 대체했습니다.' END AS warning
        FROM (SELECT {_BODY_CHARS} AS c,
                     doc_id IN (SELECT CAST(doc_id AS VARCHAR) FROM labels WHERE quality = 0)
                         AS poor
              FROM doc)
        """,
    ),
    "similar_top_k": oracle(
        ["doc", "emb", "interest"],
        """
        SELECT d.doc_id, d.source, d.title,
               round(list_cosine_similarity(e.vec, i.vec), 6) AS score
        FROM emb e
        JOIN doc d ON d.doc_id = e.doc_id AND d.content_hash = e.content_hash
        JOIN interest i ON i.interest_key = '0'
        ORDER BY list_cosine_similarity(e.vec, i.vec) DESC, d.doc_id LIMIT 10
        """,
    ),
}
