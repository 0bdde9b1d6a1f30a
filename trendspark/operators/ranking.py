"""Interest affinity, document score and similarity search."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from datetime import datetime

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from trendspark.functions.timeutil import as_of_column, hours_between
from trendspark.functions.vectors import cosine
from trendspark.operators.joins import MAX_DIM_ROWS
from trendspark.operators.metrics import velocity_per_day

FULL_SCALE = 2000
# Vectors, and bytes of them, in a chunk or a block.
BLOCK_ROWS = 1024
BLOCK_BYTES = 8 << 20
# Copies of a block, and parts that the chunks of a dimension are dealt to.
SALTS = 8


def of_current_text(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """Rows by (doc_id, content_hash) that belong to the documents' present text."""
    return rows.join(
        docs.select("doc_id", "content_hash"), ["doc_id", "content_hash"], "left_semi"
    )


def affinity_pairs(
    docs: DataFrame, embeddings: DataFrame, interests: DataFrame, model: str
) -> DataFrame:
    """Cosine of each document with each interest of the same model.

    The pairs are what a caller asks for here; ``document_affinity`` makes none.
    They come out of the same products of blocks. Vectors of another dimension
    do not match; the cosine with a vector of length 0 is unknown.
    """
    rows = _products(embeddings, interests, model).mapInArrow(
        _multiplier(best_only=False), _MATCH
    )
    return of_current_text(rows, docs).select("doc_id", "interest_key", "label", "affinity")


def best_interest(pairs: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Each document's closest interest; equal affinities go to the larger key.

    A maximum, not a mean: interests are alternatives. Partial aggregation
    leaves one row per document before the shuffle. ``keys`` may name more
    columns that ``doc_id`` determines, to reuse a partitioning by them.
    """
    best = F.max(F.struct("affinity", "interest_key", "label"))
    return (
        pairs.filter(F.col("affinity").isNotNull())
        .groupBy(*keys)
        .agg(best.alias("b"))
        .select(
            "doc_id",
            F.col("b.affinity").alias("affinity"),
            F.col("b.interest_key").alias("best_interest"),
            F.col("b.label").alias("best_interest_label"),
        )
    )


def document_affinity(
    docs: DataFrame, embeddings: DataFrame, interests: DataFrame, model: str
) -> DataFrame:
    """Closest interest per document without making the pairs.

    Vectors are packed into chunks where they are read and topics into blocks;
    a task multiplies a chunk with a block and keeps the best topic of each
    vector, so it holds one of each whatever the number of topics. The closing
    aggregate takes the best over the blocks and holds the one-row-per-document
    grain even if a vector was stored twice.
    """
    matched = _products(embeddings, interests, model).mapInArrow(
        _multiplier(best_only=True), _MATCH
    )
    return best_interest(of_current_text(matched, docs), ["doc_id", "content_hash"])


_MATCH = "doc_id string, content_hash string, interest_key string, label string, affinity double"


def _products(embeddings: DataFrame, interests: DataFrame, model: str) -> DataFrame:
    """Rows of one chunk of vectors and one block of topics of the same dimension and model.

    Most vectors share one dimension, so the join key is that and a salt. Blocks
    that Catalyst knows to be small are broadcast, ``SALTS`` times their size;
    others are joined by sorting, where adaptive execution splits further.
    """
    vectors = embeddings.filter(F.col("model_name") == model).select("doc_id", "content_hash", "vec")
    topics = interests.filter(F.col("model_name") == model).select("interest_key", "label", "vec")
    chunks = vectors.mapInArrow(
        _packer(["doc_id", "content_hash"], "vectors"),
        "dim int, doc_id array<string>, content_hash array<string>, vectors binary",
    )
    blocks = topics.mapInArrow(
        _packer(["interest_key", "label"], "topics"),
        "dim int, interest_key array<string>, label array<string>, topics binary",
    )
    salted = chunks.withColumn("_salt", F.pmod(F.xxhash64(F.col("doc_id")[0]), F.lit(SALTS)).cast("int"))
    copies = blocks.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return salted.join(copies, ["dim", "_salt"]).drop("_salt")


def _packer(names: list[str], kind: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows of up to ``BLOCK_ROWS`` vectors of one dimension; nested, so it travels by value."""
    most, most_bytes = BLOCK_ROWS, BLOCK_BYTES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vecs = batch.column("vec")
            sizes = vecs.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
            for dim in np.unique(sizes[sizes > 0]):
                of_dim = np.flatnonzero(sizes == dim)
                step = max(1, min(most, most_bytes // (8 * int(dim))))
                for start in range(0, len(of_dim), step):
                    rows = pa.array(of_dim[start : start + step])
                    flat = vecs.take(rows).flatten().to_numpy(zero_copy_only=False).astype("<f8")
                    named = [pa.array([batch.column(n).take(rows).to_pylist()], pa.list_(pa.string())) for n in names]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([dim], pa.int32()), *named, pa.array([flat.tobytes()], pa.binary())],
                        ["dim", *names, kind],
                    )

    return pack


def _multiplier(best_only: bool) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Cosines of each row's chunk and block: of a vector the best one, or all; nested as above."""

    def unit(packed: bytes, dim: int) -> np.ndarray:
        rows = np.frombuffer(packed, "<f8").reshape(-1, dim)
        with np.errstate(invalid="ignore", divide="ignore"):
            return rows / np.linalg.norm(rows, axis=1, keepdims=True)

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1).to_pylist()[0]
                order = sorted(range(len(row["interest_key"])), key=row["interest_key"].__getitem__)
                # NaN where a vector has length 0.
                cosines = unit(row["vectors"], row["dim"]) @ unit(row["topics"], row["dim"])[order].T
                n, m = cosines.shape
                if best_only:
                    cosines[np.isnan(cosines)] = -np.inf
                    # Among equal maxima the last, which has the largest key.
                    across = m - 1 - np.argmax(cosines[:, ::-1], axis=1)
                    down = np.flatnonzero(cosines[np.arange(n), across] > -np.inf)
                    across = across[down]
                else:
                    down, across = np.repeat(np.arange(n), m), np.tile(np.arange(m), n)
                found = cosines[down, across]
                topic = [order[i] for i in across]
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row["doc_id"][i] for i in down], pa.string()),
                        pa.array([row["content_hash"][i] for i in down], pa.string()),
                        pa.array([row["interest_key"][i] for i in topic], pa.string()),
                        pa.array([row["label"][i] for i in topic], pa.string()),
                        pa.array(found, mask=np.isnan(found)),
                    ],
                    ["doc_id", "content_hash", "interest_key", "label", "affinity"],
                )

    return multiply


def score(
    docs: DataFrame,
    affinity: DataFrame,
    latest_metric: DataFrame,
    config: DataFrame,
    as_of: datetime | str | Column,
    full_scale: int = FULL_SCALE,
) -> DataFrame:
    """``affinity * recency * (1 + engagement)`` per document.

    Recency halves every ``half_life_hours`` of the source. Engagement is
    logarithmic and a bonus, so a document without metrics is neutral. Sources
    missing from ``config`` drop out. Idempotent for a given ``as_of``.
    """
    now = as_of_column(as_of)
    narrow = docs.select("doc_id", "source", "title", "url", "published_at")
    # Of a config that is not broadcast, adaptive execution splits the hot sources.
    joined = (
        narrow.join(config, "source")
        .join(affinity, "doc_id")
        .join(latest_metric, "doc_id", "left")
    )
    boost = F.ln(1 + F.greatest(F.col("velocity_per_day"), F.lit(0.0))) / F.ln(
        F.lit(1.0 + full_scale)
    )
    return (
        joined.withColumn("age_hours", hours_between(F.col("published_at"), now))
        .withColumn("velocity_per_day", velocity_per_day(as_of))
        .withColumn(
            "recency_decay",
            F.pow(F.lit(0.5), F.col("age_hours").cast("double") / F.col("half_life_hours")),
        )
        .withColumn("engagement_boost", F.least(F.lit(1.0), boost))
        .select(
            "doc_id",
            "source",
            "title",
            "url",
            "published_at",
            "best_interest",
            "best_interest_label",
            "affinity",
            "age_hours",
            "recency_decay",
            "engagement_boost",
            "velocity_per_day",
            "engagement_score",
            (F.col("affinity") * F.col("recency_decay") * (1 + F.col("engagement_boost"))).alias(
                "score"
            ),
            now.alias("scored_at"),
        )
    )


def similar_top_k(
    docs: DataFrame,
    embeddings: DataFrame,
    query_vec: Sequence[float] | DataFrame,
    model: str,
    k: int = 10,
) -> DataFrame:
    """The ``k`` documents closest to a query vector, best first.

    The query is a literal or a one-row, one-column frame (read as a scalar
    subquery). Scores are made where the vectors are read; only ids, hashes and
    scores are joined and sorted, and titles are fetched for the k rows.
    """
    if isinstance(query_vec, DataFrame):
        query = query_vec.scalar()
    else:
        query = F.array(*[F.lit(float(x)) for x in query_vec])
    scored = (
        embeddings.filter(F.col("model_name") == model)
        .withColumn("_q", query)
        .filter(F.size("vec") == F.size("_q"))
        .select("doc_id", "content_hash", cosine(F.col("vec"), F.col("_q")).alias("score"))
    )
    current = of_current_text(scored, docs).select("doc_id", "score")
    top = current.orderBy(F.col("score").desc_nulls_last(), "doc_id").limit(k)
    # The limit bounds the broadcast; titles are then read without a shuffle.
    small = F.broadcast(top) if k <= MAX_DIM_ROWS else top
    return (
        docs.select("doc_id", "source", "title")
        .join(small, "doc_id")
        .orderBy(F.col("score").desc_nulls_last(), "doc_id")
    )
