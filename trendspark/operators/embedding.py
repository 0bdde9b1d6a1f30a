"""Which documents still need a vector, and how they get one."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from datetime import datetime

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from trendspark.functions.text import WHITESPACE, collapse, embedding_text
from trendspark.functions.timeutil import as_of_column
from trendspark.operators.joins import MAX_DIM_ROWS

HASH_DIM = 64
MAX_KNOWN_WORDS = 500_000

Encoder = Callable[[list[str]], list[list[float]]]


def backlog(
    docs: DataFrame, embeddings: DataFrame, model: str, cap: int | None = None
) -> DataFrame:
    """Documents without a vector of this model for their current text.

    Holds no state: changed text or another model simply stops matching.
    Newest first when capped. Only keys and hashes go through the anti join and
    the cut; texts are fetched for the at most ``cap`` chosen documents.
    """
    done = embeddings.filter(F.col("model_name") == model).select("doc_id", "content_hash")
    missing = docs.select("doc_id", "content_hash", "published_at").join(
        done, ["doc_id", "content_hash"], "left_anti"
    )
    if cap is not None:
        missing = missing.orderBy(F.col("published_at").desc_nulls_last(), "doc_id").limit(cap)
    chosen = missing.select("doc_id", "content_hash")
    return docs.join(
        F.broadcast(chosen) if cap is not None and cap <= MAX_DIM_ROWS else chosen,
        ["doc_id", "content_hash"],
        "left_semi",
    )


def hashing_encoder(dim: int = HASH_DIM) -> Callable[[], Encoder]:
    """A deterministic stand-in for a model: signed word counts, L2-normalised.

    A text whose counts cancel or that has no words gets the first unit vector.
    Returns a factory whose inner functions travel to the workers by value.
    """

    def build() -> Encoder:
        class Slots(dict):
            """Word to 2 * position + (1 if positive), filled on first use."""

            def __missing__(self, word: str) -> int:
                digest = hashlib.md5(word.encode()).digest()
                slot = 2 * (int.from_bytes(digest[:4], "big") % dim) + digest[4] % 2
                self[word] = slot
                return slot

        slots = Slots()

        def encode_texts(texts: list[str]) -> list[list[float]]:
            if len(slots) > MAX_KNOWN_WORDS:
                slots.clear()
            vectors = np.zeros((len(texts), dim))
            for row, text in enumerate(texts):
                found = [slots[word] for word in text.lower().split()]
                counts = np.bincount(np.array(found, dtype="int64"), minlength=2 * dim)
                vectors[row] = counts[1::2] - counts[0::2]
            lengths = np.linalg.norm(vectors, axis=1)
            vectors[lengths == 0, 0] = 1.0
            lengths[lengths == 0] = 1.0
            return (vectors / lengths[:, None]).tolist()

        return encode_texts

    return build


def term_vectors(df: DataFrame, model: str, as_of: datetime | str | Column, dim: int = HASH_DIM) -> DataFrame:
    """Embedding rows as ``hashing_encoder`` makes them, without Python.

    A word adds 1 to its place or takes 1 away. The words of a document are
    counted by place where it is read, so at most ``dim`` rows a document are
    dealt out and texts are not.
    """
    text = embedding_text(F.col("title"), F.col("body"))
    words = F.filter(F.split(F.lower(text), f"{WHITESPACE}+"), lambda w: w != "")
    documents = df.select("doc_id", "content_hash", F.explode_outer(words).alias("word"))
    digest = F.md5(F.col("word"))
    place = F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint") % dim
    sign = 2 * (F.conv(F.substring(digest, 9, 2), 16, 10).cast("int") % 2) - 1
    counted = documents.groupBy("doc_id", "content_hash", place.cast("int").alias("place")).agg(F.sum(sign).alias("n"))
    by_document = counted.groupBy("doc_id", "content_hash").agg(
        F.map_from_entries(F.collect_list(F.when(F.col("n") != 0, F.struct("place", F.col("n").cast("double"))))).alias("at"),
        F.sqrt(F.sum(F.col("n") * F.col("n")).cast("double")).alias("length"),
    )
    none = F.coalesce("length", F.lit(0.0)) == 0
    value = F.transform(
        F.sequence(F.lit(0), F.lit(dim - 1)),
        lambda i: F.when(none, (i == 0).cast("double"))
        .otherwise(F.coalesce(F.try_element_at("at", i), F.lit(0.0)) / F.col("length"))
        .cast("float"),
    )
    return by_document.select(
        "doc_id",
        F.lit(model).alias("model_name"),
        "content_hash",
        F.lit(dim).alias("dim"),
        value.alias("vec"),
        as_of_column(as_of).alias("embedded_at"),
    )


def encode(
    df: DataFrame,
    encoder_factory: Callable[[], Encoder],
    model: str,
    as_of: datetime | str | Column,
) -> DataFrame:
    """Embedding rows for documents; the encoder is built once per task.

    Texts reach Python in Arrow batches, and only the key, the hash and the
    text are sent.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        encoder = encoder_factory()
        for batch in batches:
            vectors = encoder(batch["text"].tolist())
            yield pd.DataFrame(
                {
                    "doc_id": batch["doc_id"],
                    "content_hash": batch["content_hash"],
                    "vec": [np.asarray(v, dtype="float32") for v in vectors],
                }
            )

    texts = df.select(
        "doc_id", "content_hash", embedding_text(F.col("title"), F.col("body")).alias("text")
    )
    # Encoding costs far more than moving the text, so it gets every core even
    # where the backlog came out of a few small partitions.
    vectors = texts.repartition("doc_id").mapInPandas(
        run, "doc_id string, content_hash string, vec array<float>"
    )
    return vectors.select(
        "doc_id",
        F.lit(model).alias("model_name"),
        "content_hash",
        F.size("vec").alias("dim"),
        "vec",
        as_of_column(as_of).alias("embedded_at"),
    )


def read_profile(profile: DataFrame) -> DataFrame:
    """Interest topics (key, label, text) with folded text and its hash."""
    text = collapse(F.col("text"))
    return profile.select(
        F.col("key").alias("interest_key"), "label", text.alias("text")
    ).withColumn("text_hash", F.md5("text"))


def sync_actions(
    profile: DataFrame, current: DataFrame, model: str, rebuild: bool = False
) -> DataFrame:
    """What to do with each topic: insert, update, delete or keep.

    A topic of the profile is embedded again when its text changed, or always
    under ``rebuild``; a stored topic that left the profile is deleted.
    """
    wanted = profile.select("interest_key", F.col("text_hash").alias("_new"))
    stored = current.filter(F.col("model_name") == model).select(
        "interest_key", F.col("text_hash").alias("_old")
    )
    return wanted.join(stored, "interest_key", "full").select(
        "interest_key",
        F.when(F.col("_new").isNull(), "delete")
        .when(F.col("_old").isNull(), "insert")
        .when(F.lit(rebuild) | (F.col("_new") != F.col("_old")), "update")
        .otherwise("keep")
        .alias("action"),
    )


def sync_dimension(
    profile: DataFrame,
    current: DataFrame,
    encoder_factory: Callable[[], Encoder],
    model: str,
    as_of: datetime | str | Column,
    rebuild: bool = False,
) -> DataFrame:
    """The interest table after the sync; other models' rows stay as they are."""
    actions = sync_actions(profile, current, model, rebuild)
    stale = profile.join(
        actions.filter(F.col("action").isin("insert", "update")), "interest_key", "left_semi"
    )
    texts = stale.select(
        F.col("interest_key").alias("doc_id"),
        F.col("text_hash").alias("content_hash"),
        F.col("text").alias("title"),
        F.lit(None).cast("string").alias("body"),
    )
    embedded = encode(texts, encoder_factory, model, as_of).select(
        F.col("doc_id").alias("interest_key"),
        "model_name",
        F.col("content_hash").alias("text_hash"),
        "dim",
        "vec",
        "embedded_at",
    )
    fresh = embedded.join(stale.select("interest_key", "label"), "interest_key")
    replaced = actions.filter(F.col("action") != "keep").select(
        "interest_key", F.lit(model).alias("model_name")
    )
    kept = current.join(replaced, ["interest_key", "model_name"], "left_anti")
    return kept.select(*current.columns).unionByName(fresh.select(*current.columns))

