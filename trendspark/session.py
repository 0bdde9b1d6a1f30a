"""Session settings every operator relies on."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

# Runtime settings; safe to apply to a session somebody else created.
SESSION_CONF = {
    # Hour and day arithmetic assumes UTC instants.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Ranked filters are cut before the shuffle up to this bound (default 1000);
    # forward reads keep capacity + 1 rows per source.
    "spark.sql.optimizer.windowGroupLimitThreshold": "20000",
}

# Only a session built here can have these.
STATIC_CONF = {
    # No call-site capture: it triples the driver calls of building a plan.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SESSION_CONF.items():
        spark.conf.set(key, value)
    return spark


def build_session(
    app: str = "trendspark", master: str | None = None, conf: dict[str, str] | None = None
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_CONF, **STATIC_CONF, **(conf or {})}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder for intermediate tables and stream checkpoints.

    On a cluster this lives under the shared folder named by
    ``spark.checkpoint.dir``, without which it is an error; only in a local
    session (tests) is a temporary folder made.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        if spark.sparkContext.master.startswith("local-cluster") or not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all hosts share")
        return f"{tempfile.mkdtemp(prefix='trendspark-')}/{name}"
    unique = spark.range(1).selectExpr("uuid() AS u").first()["u"]
    return f"{shared.rstrip('/')}/{name}-{unique}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a frame that several later steps read, and read it back.

    Unlike a cache this survives lost executors, and it cuts the plan.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
