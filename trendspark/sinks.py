"""Lake tables in parquet and the ways they are written.

A run's raw rows become visible only when its run-log row exists, and that row
is written last: a crash in between leaves hidden rows and an unmoved cursor,
and a retry under the same run id replaces its own rows.

A merged table is published the same way, part by part: the parts that a merge
touches are written as a new revision, first the source rows and then those of the
old revision that they do not replace, and one file of marker rows then makes
all of them visible. A merge that dies earlier leaves the old revision readable
and is simply made again; the replaced folders go last.

Writes but those of raw rows are rebalanced: adaptive execution then merges small output partitions
and splits large ones, so neither a small run nor a hot part sets file sizes.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import date
from urllib.parse import quote

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from trendspark import schemas
from trendspark.operators.documents import unmatched
from trendspark.operators.ingest import committed_rows
from trendspark.session import configure, stored

TABLES = {
    "raw_item": schemas.RAW_ITEM,
    "run_log": schemas.RUN_LOG,
    "publication": schemas.PUBLICATION,
    "embedding": schemas.EMBEDDING,
    "interest_embedding": schemas.INTEREST_EMBEDDING,
    "delivery": schemas.DELIVERY,
    "document": schemas.DOCUMENT,
    "metric_daily": schemas.METRIC_DAILY,
    "document_score": schemas.DOCUMENT_SCORE,
    "digest_dispatch": schemas.DISPATCH,
    "alert": schemas.ALERT,
    "check_result": schemas.CHECK_RESULT,
}

# The column a merged table is stored by. A document's block is its id without
# the last characters: ids grow with time, so the documents of one run share few
# blocks and a merge leaves the rest of the table alone. Ids that are no numbers
# have no such order and go to a fixed number of blocks.
LAYOUT = {"document": "block", "metric_daily": "metric_date"}
BLOCK_CHARS = 4
HASH_BLOCKS = 1024
# Up to this many replaced parts are opened by path, without listing the table.
MAX_LISTED_PARTS = 10_000
# Payloads and bodies are most of what is written.
TEXT_CODEC = "zstd"
NO_VALUE = "__HIVE_DEFAULT_PARTITION__"


class Lake:
    def __init__(self, spark: SparkSession, root: str, block_chars: int = BLOCK_CHARS):
        self.spark = configure(spark)
        self.root = root.rstrip("/")
        # 4 makes blocks of ten thousand numeric ids, 6 of a million. Fixed for the
        # life of a table.
        self.block_chars = block_chars

    def path(self, table: str) -> str:
        return f"{self.root}/{table}"

    def columns(self, table: str) -> list[str]:
        return self.spark.createDataFrame([], TABLES[table]).columns

    def read(self, table: str) -> DataFrame:
        """A table with its declared schema; empty before the first write."""
        if table in LAYOUT:
            return self._visible(table).select(*self.columns(table))
        return self._files(table, TABLES[table]).select(*self.columns(table))

    def _files(self, table: str, schema: str) -> DataFrame:
        try:
            return self.spark.read.schema(schema).parquet(self.path(table))
        except AnalysisException as error:
            if error.getCondition() != "PATH_NOT_FOUND":
                raise
            return self.spark.createDataFrame([], schema)

    def _revisions(self, table: str) -> DataFrame:
        """The visible revision of each part of a merged table."""
        marked = self.read("publication").filter(F.col("table_name") == table)
        return marked.groupBy("part").agg(F.max("revision").alias("revision"))

    def _merged_schema(self, table: str) -> str:
        own = "" if LAYOUT[table] in self.columns(table) else f", {LAYOUT[table]} string"
        return f"{TABLES[table]}{own}, revision bigint"

    def _visible(self, table: str, parts: DataFrame | None = None) -> DataFrame:
        """The rows of visible revisions, of all parts or those in ``parts`` (part, revision).

        Both join keys are folders, so the scan is pruned at run time.
        """
        if parts is None:
            parts = self._revisions(table)
        files = self._files(table, self._merged_schema(table))
        same_part = files[LAYOUT[table]].cast("string").eqNullSafe(parts["part"])
        return files.join(parts, same_part & (files["revision"] == parts["revision"]), "left_semi")

    def _folder(self, table: str, part: str | None, revision: int) -> str:
        name = NO_VALUE if part is None else part
        return f"{self.path(table)}/revision={revision}/{LAYOUT[table]}={name}"

    def raw_items(
        self, except_run: str | None = None, committed_after: Column | None = None
    ) -> DataFrame:
        """Rows of committed runs only.

        ``except_run`` prunes the folder of a run that is about to be replaced.
        ``committed_after`` keeps the runs that ended later, with all their rows,
        whatever times these carry; the run log prunes the folders of the others.
        """
        items, log = self.read("raw_item"), self.read("run_log")
        if except_run is not None:
            items = items.filter(F.col("run_id") != except_run)
        if committed_after is not None:
            log = log.filter(F.col("ended_at") > committed_after)
        return committed_rows(items, log)

    def logged(self, run_id: str) -> bool:
        return not self.read("run_log").filter(F.col("run_id") == run_id).limit(1).isEmpty()

    def write_run(self, rows: DataFrame, run_id: str) -> None:
        """Replace the raw rows of one run; hidden until the run is logged.

        ``rows`` must not read that run's folder. They come dealt out by key from
        ``ingest.idempotent_rows``, whose small partitions adaptive execution merges,
        so payloads are not shuffled once more.
        """
        folder = f"{self.path('raw_item')}/run_id={quote(run_id, safe='')}"
        rows.drop("run_id").write.mode("overwrite").option("compression", TEXT_CODEC).parquet(folder)

    def append(self, table: str, rows: DataFrame) -> None:
        rows.select(*self.columns(table)).hint("rebalance").write.mode("append").parquet(self.path(table))

    def overwrite(self, table: str, rows: DataFrame) -> None:
        """Full refresh of a table that ``rows`` does not read."""
        (
            rows.hint("rebalance")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "static")
            .parquet(self.path(table))
        )

    def replace_partitions(
        self, table: str, rows: DataFrame, column: str, values: Sequence[str | date] | None = None
    ) -> None:
        """Replace whole partitions.

        With ``values`` these partitions and no others: rows of other ones are not
        written, and a partition that gets no rows is emptied. Without it the
        partitions that occur in ``rows``.
        """
        if values is None:
            (
                rows.hint("rebalance", column)
                .write.mode("overwrite")
                .option("partitionOverwriteMode", "dynamic")
                .partitionBy(column)
                .parquet(self.path(table))
            )
            return
        for value in values:
            part = rows.filter(F.col(column) == F.lit(value)).drop(column)
            folder = f"{self.path(table)}/{column}={quote(str(value), safe='')}"
            part.hint("rebalance").write.mode("overwrite").parquet(folder)

    def write_upsert(self, table: str, source: DataFrame, keys: list[str]) -> None:
        """Merge rows, one per key, into a table stored by its ``LAYOUT`` column.

        Only the parts that ``source`` touches are read and written again, as a
        new revision. Marker rows in one file publish all of them together.
        """
        part = LAYOUT[table]
        source = source.select(*self.columns(table))
        if part not in source.columns:
            source = source.withColumn(part, self._block(keys[0]))
        last = self.read("publication").filter(F.col("table_name") == table).agg(F.max("revision")).first()[0] or 0
        # Folders of merges that died before their markers; ``source`` may list them, so they are not written again.
        dead = [n for n in self._revisions_on_disk(table) if n > last]
        revision = 1 + max([last, *dead])
        folder = f"{self.path(table)}/revision={revision}"
        self._write_parts(source, part, folder)
        source = self.spark.read.schema(self._merged_schema(table)).option("basePath", self.path(table)).parquet(folder)
        if source.isEmpty():
            self._drop_folders([folder])
            return
        touched = source.select(F.col(part).cast("string").alias("part")).distinct()
        before = self._revisions(table).alias("r").join(
            touched.alias("t"), F.col("r.part").eqNullSafe(F.col("t.part")), "left_semi"
        )
        replaced = stored(before, f"{table}-replaced")
        if not replaced.isEmpty():
            # The other half of the upsert: its source rows lie in the folder already.
            kept = unmatched(self._opened(table, replaced).drop("revision"), source, keys)
            self._write_parts(kept, part, folder)
        markers = touched.select(
            F.lit(table).alias("table_name"),
            "part",
            F.lit(revision).cast("bigint").alias("revision"),
            F.current_timestamp().alias("published_at"),
        )
        self._publish(markers)
        self._drop_folders(self._folder(table, r["part"], r["revision"]) for r in replaced.toLocalIterator())
        self._drop_folders(f"{self.path(table)}/revision={n}" for n in dead)

    def _write_parts(self, rows: DataFrame, part: str, folder: str) -> None:
        write = rows.hint("rebalance", part).write.mode("append").option("compression", TEXT_CODEC)
        write.partitionBy(part).parquet(folder)

    def _revisions_on_disk(self, table: str) -> list[int]:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path(table)}/revision=*")
        found = path.getFileSystem(self.spark._jsc.hadoopConfiguration()).globStatus(path)
        return [int(x.getPath().getName().split("=")[1]) for x in found or []]

    def _opened(self, table: str, parts: DataFrame) -> DataFrame:
        """Rows of the given (part, revision)."""
        listed: list[Row] = parts.limit(MAX_LISTED_PARTS + 1).collect()
        if len(listed) > MAX_LISTED_PARTS:
            return self._visible(table, parts)
        schema = self._merged_schema(table)
        if not listed:
            return self.spark.createDataFrame([], schema)
        paths = [self._folder(table, r["part"], r["revision"]) for r in listed]
        return self.spark.read.schema(schema).option("basePath", self.path(table)).parquet(*paths)

    def _publish(self, markers: DataFrame) -> None:
        """One file, so that all markers of a merge appear at once."""
        markers.coalesce(1).write.mode("append").parquet(self.path("publication"))

    def _drop_folders(self, folders: Iterable[str]) -> None:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        conf = self.spark._jsc.hadoopConfiguration()
        for folder in folders:
            path = hadoop(folder)
            path.getFileSystem(conf).delete(path, True)

    def _block(self, key: str) -> Column:
        """A name that needs no escaping in a path."""
        kept = F.greatest(F.length(key) - self.block_chars, F.lit(0))
        # The leading letter keeps the name of a short id's block from being empty.
        front = F.regexp_replace(F.substring(F.col(key), F.lit(1), kept), "[^A-Za-z0-9.]", "-")
        bucket = F.pmod(F.xxhash64(key), F.lit(HASH_BLOCKS)).cast("string")
        counted = F.col(key).rlike("^[^0-9]*[0-9]+([.][0-9]+)?(v[0-9]+)?$")
        return F.when(counted, F.concat(F.lit("b"), front)).otherwise(F.concat(F.lit("h"), bucket))
