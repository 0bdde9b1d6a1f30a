"""Corpus preparation: reject bad documents, remove copies, near copies and repeated passages, pack the rest.

Each stage is a function of (spark, docs, sf_dir) to a DataFrame, written as a table and read again as the
next one's ``docs``. All but the last return the columns of documents.

Defined cases: the operators' own hold. Rows of one doc_id are kept or dropped together, but
that of equal rows under one doc_id one stays; other columns, whatever their names, are carried along;
an empty table passes through all stages.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from trendspark.llm import exact_dedup, minhash, packing, quality, suffixes
from trendspark.llm.common import keep_documents, node_id, shared_dir, text_nodes

#: Words of a shingle of the near-copy stage.
SHINGLE = 5


def reject_low_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the pairwise ranker, learnt from the labels, puts above its cut."""
    ranker = quality.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return quality.accepted(docs, ranker)


def remove_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest doc_id."""
    return keep_documents(docs, kept_nodes(exact_dedup.exact_groups(docs)))


def remove_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies, by sets of ``SHINGLE`` words."""
    return keep_documents(docs, kept_nodes(minhash.near_duplicates(docs, SHINGLE)))


def kept_nodes(found: DataFrame) -> DataFrame:
    rows = found.groupBy("node").agg(F.max("kept").alias("kept"), (F.count(F.lit(1)) > 1).alias("several"))
    return rows.filter("kept").select("node", "several")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the later copies of repeated passages; documents of which nothing is left go."""
    cuts = (
        suffixes.spans(docs, firsts=False)
        .filter("NOT is_first")
        .groupBy(F.col("node").alias("cut_node"))
        .agg(F.collect_list(F.struct("start_word", "end_word")).alias("cuts"))
    )
    whole = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    rows = text_nodes(docs.select(whole.alias("row"), node_id().alias("node"), F.coalesce("text", F.lit("")).alias("text")))
    joined = rows.select("row", "node").join(cuts, F.col("node") == F.col("cut_node"), "left")
    changed = suffixes.cut_text("row.text", "cuts")
    out = joined.select("row", F.when(F.col("cuts").isNull(), F.col("row.text")).otherwise(changed).alias("left"), "cuts")
    out = out.filter(F.col("cuts").isNull() | (F.length(F.trim("left")) > 0))
    said = {"text": F.col("left")}
    if "n_chars" in docs.columns:
        said["n_chars"] = F.when(F.col("cuts").isNull(), F.col("row.n_chars")).otherwise(
            F.length("left").cast(docs.schema["n_chars"].dataType)
        )
    return out.select(*[said.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of 4096 tokens, neighbours on the Hilbert curve together."""
    return packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality classifier", reject_low_quality),
    ("exact dedup", remove_copies),
    ("MinHash near-dedup", remove_near_copies),
    ("suffix-array dedup", cut_repeated_passages),
    ("packing", pack_sequences),
]

#: Learnt scores and packing on a curve have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; each result is a table in the shared folder, which the next stage reads."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = f"{shared_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    for name, stage in STAGES:
        path = f"{folder}/{re.sub('[^a-z0-9]+', '_', name.lower())}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
