"""Helpers of the text operators: shared tables, shipping the package, word splitting."""

from __future__ import annotations

import ctypes
import functools
import os
import re
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes that separate words where a contract names them.
SPACES = "\x20\x09\x0a\x0b\x0c\x0d"

#: Bytes of an Arrow batch between an executor and its Python workers.
BATCH_BYTES = 8 << 20

_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"
_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Give this package to the Python workers, once for each application, and bound their batches.

    Whole texts travel in these batches, and a task holds several copies of one, on both sides. Smaller settings
    of the session stay.
    """
    number, unit = re.match(r"(\d+)\s*(\w?)", spark.conf.get(_BATCH_SETTING)).groups()
    if int(number) << 10 * max(0, "bkmgtp".index(unit.lower() or "b")) > BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(BATCH_BYTES))
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent.parent
    archive = os.path.join(tempfile.mkdtemp(), f"{root.name}.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(root.rglob("*.py")):
            out.write(file, file.relative_to(root.parent))
    context.addPyFile(archive)
    _shipped.add(context.applicationId)


def give_back() -> None:
    """Hand memory that Arrow and the C library hold free back to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim:
        trim(0)


def released(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """``run``, a function of mapInPandas or mapInArrow, whose worker gives freed memory back at the end of a task.

    Workers outlive their tasks and stages; what one stage has left free there counts beside the next one's need.
    """

    @functools.wraps(run)
    def task(*given: object) -> Iterator:
        try:
            yield from run(*given)
        finally:
            give_back()

    return task


def shared_dir(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a temporary one in a local session without it."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
    folder = f"file://{tempfile.mkdtemp()}"
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a parquet table of its own in the shared folder: computed once, lineage cut."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/{name}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def partitions(spark: SparkSession) -> int:
    """Shuffle partitions of the session: the one place that sizes them is the cluster's settings."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def texts(docs: DataFrame, *columns: str | Column) -> DataFrame:
    """The wanted columns and ``text``, null as empty; other columns of ``docs`` are not read."""
    return docs.select(*columns, F.coalesce(F.col("text"), F.lit("")).alias("text"))


def node_id() -> Column:
    """A long for every row of documents: the doc_id, or a hash of the text where that is null."""
    return F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


#: Nodes of further texts under one doc_id come after all others.
FURTHER = 1 << 62


def text_nodes(rows: DataFrame) -> DataFrame:
    """``rows`` (node, text) with a node for each text: a doc_id's further texts get nodes of their own.

    ``home`` is the node that came. Of the texts of one doc_id that with the least hash keeps it. The table of
    doc_ids that have several texts is stored, so Catalyst knows its size and broadcasts it where that is small.
    """
    content = F.xxhash64("text")
    several = (
        rows.select(F.col("node").alias("home"), content.alias("content"))
        .groupBy("home")
        .agg(F.min("content").alias("own"), F.max("content").alias("last"))
        .filter("own <> last")
    )
    joined = rows.withColumnRenamed("node", "home").join(stored(several.drop("last"), "several"), "home", "left")
    further = F.xxhash64(F.col("home"), content).bitwiseAND(F.lit(FURTHER - 1)).bitwiseOR(F.lit(FURTHER))
    node = F.when(F.col("own").isNull() | (F.col("own") == content), F.col("home")).otherwise(further)
    return joined.withColumn("node", node).drop("own")


def fold(column: str, remainder_of: int) -> Column:
    """crc32 of the doc_id as text modulo ``remainder_of``; a null doc_id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % remainder_of


def key_range(df: DataFrame, column: str, ranges: int) -> Column:
    """Number of the range, of ``ranges`` with about as many rows each, that the column's value lies in."""
    chances = [i / ranges for i in range(1, ranges)]
    bounds = np.array(sorted(df.approxQuantile(column, chances, 0.2 / ranges)) if chances else [])

    @F.pandas_udf("int")
    def number(values: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(bounds, values.to_numpy("f8", na_value=-np.inf), side="right").astype("i4"))

    return number(column)


def batches(frames: Iterator[pd.DataFrame], column: str, most: int) -> Iterator[pd.DataFrame]:
    """Cut frames into runs of rows whose ``column`` holds about ``most`` characters (one row at least)."""
    for frame in frames:
        start, held = 0, 0
        for at, size in enumerate(frame[column].str.len().fillna(0).astype("int64")):
            if held and held + size > most:
                yield frame.iloc[start:at]
                start, held = at, 0
            held += size
        if start < len(frame):
            yield frame.iloc[start:]


def keep_documents(docs: DataFrame, kept: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose node is in ``kept`` (node, each once, and ``several``: it has more than one row).

    Equal rows of a node with several stay once.
    """
    node = F.coalesce(F.col("d.doc_id").cast("long"), F.xxhash64(F.coalesce(F.col("d.text"), F.lit(""))))
    joined = docs.alias("d").join(kept.alias("k"), node == F.col("k.node"))
    whole = [F.col(f"d.`{name}`") for name in docs.columns]
    alone = joined.filter(~F.col("k.several")).select(*whole)
    return alone.unionByName(joined.filter("k.several").select(*whole).dropDuplicates(["doc_id", "text"]))
