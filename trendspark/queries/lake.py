"""Queries that write tables of a lake in steps and read them back."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from trendspark import messages as say
from trendspark.functions.text import WHITESPACE
from trendspark.operators import digest, embedding, ingest
from trendspark.plans import build, collect
from trendspark.queries import bindings as b
from trendspark.queries.bindings import oracle
from trendspark.queries.incremental import payload_documents
from trendspark.schemas import RAW_ITEM
from trendspark.session import scratch_dir
from trendspark.sinks import TEXT_CODEC, Lake
from trendspark.sources import landing, seeds
from trendspark.sources.feeds import feed_rows
from trendspark.streaming.ingest import ingest_stream, read_landed

NOW = datetime.fromisoformat(b.AS_OF)
NEXT = NOW + timedelta(days=1)
EARLIER = NOW - timedelta(days=10)
#: The days that are selected again, and the one for which nothing is left.
AGAIN = [NOW.date() - timedelta(days=n) for n in range(7)]
EMPTIED = AGAIN[3]


def _lake(spark: SparkSession, name: str) -> tuple[Lake, str]:
    b.configure(spark)
    root = scratch_dir(spark, name)
    return Lake(spark, f"{root}/lake"), root


def document_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that land in two runs and are merged after each.

    The first run has drafts of the English ones and nothing of source src3. What
    it lacks streams in a day later, under fetch times that are 30 days old.
    """
    lake, root = _lake(spark, "merge")
    final = payload_documents(spark, sf)
    english = F.col("source_name").startswith("arxiv:")
    held_back = F.col("origin") == "src3"
    drafts = final.withColumn(
        "payload", F.when(english, F.regexp_replace("payload", '"title":"', '"title":"draft ')).otherwise(F.col("payload"))
    )
    columns = ["source_name", "native_id", "payload", "payload_hash", "event_ts"]

    def items(df: DataFrame) -> DataFrame:
        return df.withColumn("payload_hash", ingest.payload_hash(F.col("payload"))).select(*columns)

    collect.collect_full(lake, items(drafts.filter(~held_back)), "first", NOW)
    build.refresh_documents(lake)
    late = items(final.filter(english | held_back))
    staged = late.withColumns({"fetched_at": F.lit(NOW - timedelta(days=30)), "run_id": F.lit("")})
    raw_columns = [c.split()[0] for c in RAW_ITEM.replace("\n", " ").split(",")]
    staged.select(*raw_columns).write.option("compression", TEXT_CODEC).parquet(f"{root}/landed")
    stream = ingest_stream(read_landed(spark, f"{root}/landed"), lake, f"{root}/checkpoint", clock=lambda: NEXT)
    stream.awaitTermination()
    build.refresh_documents(lake)
    return lake.read("document").select("doc_id", "source_name", "title", "content_hash", "published_at", "fetched_at")


def _selected(docs: DataFrame, day: Column) -> DataFrame:
    return docs.select(
        F.concat(day.cast("string"), F.lit(":"), F.col("doc_id")).alias("dispatch_id"),
        day.alias("digest_date"),
        "doc_id",
        "source",
        "title",
        "url",
        "published_at",
        F.lit(None).cast("string").alias("best_interest_label"),
        *[F.lit(None).cast("double").alias(c) for c in ("affinity", "recency_decay", "engagement_boost", "score")],
        F.lit(1).alias("rank_in_source"),
        b.at(b.AS_OF).alias("selected_at"),
    )


def partition_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Each document is selected for its day; then a week is selected again, with nothing for one of its days."""
    lake, _ = _lake(spark, "replace")
    docs = b.documents(spark, sf)
    day = F.to_date("published_at")
    lake.replace_partitions("digest_dispatch", _selected(docs, day), "digest_date")
    again = _selected(docs.filter((F.col("lang") == "en") & (day != F.lit(EMPTIED))), day)
    lake.replace_partitions("digest_dispatch", again, "digest_date", AGAIN)
    stored = lake.read("digest_dispatch")
    return stored.select("dispatch_id", F.col("digest_date").cast("string").alias("digest_date"), "doc_id", "source")


def delivery_append(spark: SparkSession, sf: str) -> DataFrame:
    """A failed delivery of every document, then one that arrives for the English ones."""
    lake, _ = _lake(spark, "append")
    items = _selected(b.documents(spark, sf), F.to_date(b.at(b.AS_OF)))
    lang = b.documents(spark, sf).select("doc_id", "lang")
    lake.append("delivery", digest.delivery_rows(items, "failed", b.AS_OF, "no answer"))
    english = items.join(lang.filter("lang = 'en'"), "doc_id", "left_semi")
    lake.append("delivery", digest.delivery_rows(english, "sent", NEXT))
    return lake.read("delivery").select("dispatch_id", "doc_id", "status", "sent_at", "error_msg")


def _entries(docs: DataFrame) -> DataFrame:
    """Documents as feed entries: the even ones are revised, those of src7 have no id, those of src8 no file."""
    identifier = F.concat(F.lit("https://docs.example/abs/"), "doc_id")
    even = F.col("doc_id").cast("long") % 2 == 0
    name = lambda column: F.struct(column.alias("name"))
    page = F.struct(identifier.alias("_href"), F.lit(None).cast("string").alias("_title"))
    file = F.struct(F.concat(F.lit("https://docs.example/pdf/"), "doc_id").alias("_href"), F.lit("pdf").alias("_title"))
    return docs.select(
        F.concat(F.lit("arxiv:"), "source").alias("source_name"),
        F.when(F.col("source") != "src7", F.concat(identifier, F.when(even, "v3").otherwise(""))).alias("id"),
        F.concat(F.lit("On  "), "title").alias("title"),
        F.col("body").alias("summary"),
        F.date_format("published_at", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("published"),
        F.array(name(F.col("source")), name(F.concat(F.lit(" <"), "lang", F.lit("> & co ")))).alias("author"),
        F.array(F.struct(F.col("lang").alias("_term"))).alias("category"),
        F.when(F.col("source") == "src8", F.array(page)).otherwise(F.array(page, file)).alias("link"),
    )


def _write_pages(entries: DataFrame, path: str) -> None:
    pages = entries.write.format("xml").option("rootTag", "feed").option("rowTag", "entry")
    pages.mode("append").partitionBy("source_name").save(path)


def feed_source(spark: SparkSession, sf: str) -> DataFrame:
    """All documents written as pages of feeds and read again."""
    b.configure(spark)
    root = scratch_dir(spark, "feeds")
    _write_pages(_entries(b.documents(spark, sf)), root)
    rows = feed_rows(landing.landed_feeds(spark, root), F.col("source_name"))
    text = lambda field: F.get_json_object("payload", f"$.{field}")
    return rows.select(
        "source_name",
        "native_id",
        "event_ts",
        *[text(c).alias(c) for c in ("version", "title", "pdf_url")],
        text("authors[1]").alias("second_author"),
        text("categories[0]").alias("category"),
        F.md5(text("summary")).alias("summary_md5"),
    )


def csv_seed(spark: SparkSession, sf: str) -> DataFrame:
    """A configuration of all sources, written as CSV with notes that need quotes, and read again."""
    b.configure(spark)
    root = scratch_dir(spark, "seed")
    per_source = b.documents(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("lang").alias("lang"))
    note = F.concat(F.lit('said "'), "lang", F.lit('", of '), F.col("n").cast("string"), F.lit("\nin all"))
    rows = per_source.select(
        "source",
        F.when(F.col("source") != "src3", F.col("n") % 50 + 24).cast("int").alias("half_life_hours"),
        (F.col("n") % 5).cast("int").alias("digest_quota"),
        F.when(F.col("source") != "src4", note).alias("authority_note"),
    )
    rows.write.option("header", True).option("escape", '"').csv(f"{root}/config")
    return seeds.read_source_config(spark, f"{root}/config")


def isolated_sources(spark: SparkSession, sf: str) -> DataFrame:
    """The log of two runs over the landed files of all sources; in the second some sources have torn records.

    English documents come in feeds, the others as items. Torn are documents of src5 and src6.
    """
    lake, root = _lake(spark, "isolated")
    docs = b.documents(spark, sf)
    english = F.col("lang") == "en"
    _write_pages(_entries(docs.filter(english)), f"{root}/feeds")
    items = docs.filter(~english).select(
        F.concat(F.lit("hackernews:"), "source").alias("source_name"),
        F.to_json(
            F.struct(
                F.col("doc_id").cast("long").alias("id"),
                F.lit("story").alias("type"),
                "title",
                F.col("body").alias("text"),
                F.unix_seconds("published_at").alias("time"),
            )
        ).alias("value"),
    )
    items.write.partitionBy("source_name").text(f"{root}/items")

    def run(run_id: str, as_of: datetime) -> None:
        feeds, lines = landing.landed_feeds(spark, f"{root}/feeds"), landing.landed_items(spark, f"{root}/items")
        names = docs.select(F.concat(F.when(english, "arxiv:").otherwise("hackernews:"), "source").alias("source_name"))
        collect.collect_landed(lake, feeds, lines, names, run_id, as_of)

    run("first", EARLIER)
    torn = docs.filter(F.col("source").isin("src5", "src6"))
    cut = F.concat(F.lit("<feed><entry><id>"), "doc_id", F.lit("</id><title>torn</feed>"))
    pages = torn.filter(english).select(F.concat(F.lit("arxiv:"), "source").alias("source_name"), cut.alias("value"))
    pages.write.mode("append").partitionBy("source_name").text(f"{root}/feeds")
    half = items.filter(F.col("source_name").isin("hackernews:src5", "hackernews:src6")).withColumn(
        "value", F.expr("left(value, length(value) - 2)")
    )
    half.write.mode("append").partitionBy("source_name").text(f"{root}/items")
    run("second", NEXT)
    return lake.read("run_log").select(
        "run_id", "source_name", "status", "rows_fetched", "rows_new", "watermark_before", "watermark_after", "error_msg"
    )


def _flat(vectors: DataFrame, key: str) -> DataFrame:
    """One row for each part of a vector that is not 0."""
    return vectors.select(key, F.posexplode("vec").alias("place", "value")).filter("value <> 0").select(
        key, "place", F.col("value").cast("double").alias("value")
    )


def embed_vectors(spark: SparkSession, sf: str) -> DataFrame:
    """The vectors of the backlog, part by part."""
    docs = b.documents(spark, sf)
    todo = embedding.backlog(docs, b.embeddings(spark, sf, docs), b.MODEL)
    return _flat(embedding.term_vectors(todo, b.MODEL, b.AS_OF), "doc_id")


def _topics(spark: SparkSession, sf: str) -> DataFrame:
    """Sources as topics: how many documents of which languages each has."""
    counted = b.documents(spark, sf).groupBy("source").agg(F.count(F.lit(1)).alias("n"), F.max("lang").alias("lang"))
    text = F.concat_ws(" ", F.lit("documents of"), "source", F.lit("in"), "lang", F.col("n").cast("string"))
    return embedding.read_profile(
        counted.select(F.col("source").alias("key"), F.concat(F.lit("topic "), "source").alias("label"), text.alias("text"))
    )


def dimension_state(spark: SparkSession, sf: str) -> DataFrame:
    """The whole interest table after a second sync.

    The first knows src2 under another text and lacks src1; the second lacks src0.
    """
    lake, _ = _lake(spark, "interests")
    topics = _topics(spark, sf)
    key = F.col("interest_key")
    old = F.when(key == "src2", F.lit("older words of src2")).otherwise(F.col("text"))
    first = topics.filter(key != "src1").withColumn("text", old).withColumn("text_hash", F.md5("text"))
    second = topics.filter(key != "src0")
    for profile, at in ((first, NOW), (second, NEXT)):
        build.sync_interests(lake, profile, embedding.hashing_encoder(), b.MODEL, at)
    state = lake.read("interest_embedding")
    parts = F.transform("vec", lambda x: x.cast("double"))
    return state.select(
        "interest_key", "label", "text_hash", "embedded_at", F.posexplode(parts).alias("place", "value")
    ).filter("value <> 0")


QUERIES = {
    "document_merge": document_merge,
    "partition_replace": partition_replace,
    "delivery_append": delivery_append,
    "embed_vectors": embed_vectors,
    "dimension_state": dimension_state,
    "feed_source": feed_source,
    "csv_seed": csv_seed,
    "isolated_sources": isolated_sources,
}

_AGAIN = ", ".join(f"DATE '{day}'" for day in AGAIN)


def _vectors(texts: str, key: str) -> str:
    """SQL for the parts of the vectors of (key, body)."""
    return f"""
        SELECT {key}, place, CAST(CAST(n / sqrt(sum(n * n) OVER (PARTITION BY {key})) AS FLOAT) AS DOUBLE) AS value
        FROM (SELECT {key}, CAST('0x' || substr(md5(word), 1, 8) AS BIGINT) % 64 AS place,
                     CAST(sum(2 * (CAST('0x' || substr(md5(word), 9, 2) AS BIGINT) % 2) - 1) AS DOUBLE) AS n
              FROM (SELECT {key}, unnest(string_split_regex(lower(body), '{WHITESPACE}+')) AS word
                    FROM ({texts}))
              WHERE word <> '' GROUP BY 1, 2)
        QUALIFY n <> 0
    """


ORACLE = {
    "document_merge": oracle(
        ["doc"],
        f"""
        SELECT CASE WHEN lang = 'en' THEN 'arxiv:' ELSE 'hackernews:' END || doc_id AS doc_id,
               CASE WHEN lang = 'en' THEN 'arxiv:cs.XX' ELSE 'hackernews:top' END AS source_name,
               title, content_hash, published_at,
               CASE WHEN lang = 'en' OR source = 'src3' THEN TIMESTAMP '{NEXT}' ELSE TIMESTAMP '{NOW}' END AS fetched_at
        FROM doc
        """,
    ),
    "partition_replace": oracle(
        ["doc"],
        f"""
        SELECT day || ':' || doc_id AS dispatch_id, CAST(day AS VARCHAR) AS digest_date, doc_id, source
        FROM (SELECT *, CAST(published_at AS DATE) AS day FROM doc)
        WHERE day NOT IN ({_AGAIN}) OR (lang = 'en' AND day <> DATE '{EMPTIED}')
        """,
    ),
    "delivery_append": oracle(
        ["doc"],
        f"""
        SELECT '{NOW.date()}:' || doc_id AS dispatch_id, doc_id, 'failed' AS status,
               TIMESTAMP '{NOW}' AS sent_at, 'no answer' AS error_msg FROM doc
        UNION ALL
        SELECT '{NOW.date()}:' || doc_id, doc_id, 'sent', TIMESTAMP '{NEXT}', NULL FROM doc WHERE lang = 'en'
        """,
    ),
    "embed_vectors": oracle(
        ["doc", "emb"],
        _vectors(
            """SELECT doc_id, title || chr(10) || body AS body FROM doc d
               WHERE NOT EXISTS (SELECT 1 FROM emb e WHERE e.doc_id = d.doc_id AND e.content_hash = d.content_hash)""",
            "doc_id",
        ),
    ),
    "dimension_state": oracle(
        ["doc"],
        f"""
        SELECT s.interest_key, 'topic ' || s.interest_key AS label, md5(s.body) AS text_hash,
               CASE WHEN s.interest_key IN ('src1', 'src2') THEN TIMESTAMP '{NEXT}' ELSE TIMESTAMP '{NOW}' END AS embedded_at,
               v.place, v.value
        FROM (SELECT source AS interest_key, 'documents of ' || source || ' in ' || max(lang) || ' ' || count(*) AS body
              FROM doc GROUP BY source) s
        JOIN ({_vectors("""SELECT source AS interest_key,
                                  'documents of ' || source || ' in ' || max(lang) || ' ' || count(*) AS body
                           FROM doc GROUP BY source""", "interest_key")}) v ON v.interest_key = s.interest_key
        WHERE s.interest_key <> 'src0'
        """,
    ),
    "feed_source": oracle(
        ["doc"],
        f"""
        SELECT 'arxiv:' || source AS source_name, doc_id AS native_id, published_at AS event_ts,
               CASE WHEN CAST(doc_id AS BIGINT) % 2 = 0 THEN 'v3' END AS version,
               trim(regexp_replace('On  ' || title, '{WHITESPACE}+', ' ', 'g')) AS title,
               CASE WHEN source <> 'src8' THEN 'https://docs.example/pdf/' || doc_id END AS pdf_url,
               '<' || lang || '> & co' AS second_author, lang AS category,
               md5(regexp_replace(body, '^{WHITESPACE}+|{WHITESPACE}+$', '', 'g')) AS summary_md5
        FROM doc WHERE source <> 'src7'
        """,
    ),
    "csv_seed": oracle(
        ["doc"],
        """
        SELECT source, CASE WHEN source <> 'src3' THEN CAST(count(*) % 50 + 24 AS INT) END AS half_life_hours,
               CAST(count(*) % 5 AS INT) AS digest_quota,
               CASE WHEN source <> 'src4' THEN 'said "' || max(lang) || '", of ' || count(*) || chr(10) || 'in all' END
                   AS authority_note
        FROM doc GROUP BY source
        """,
    ),
    "isolated_sources": oracle(
        ["doc"],
        f"""
        SELECT * FROM (WITH item AS (
            SELECT CASE WHEN lang = 'en' THEN 'arxiv:' ELSE 'hackernews:' END || source AS source_name, source,
                   CASE WHEN lang = 'en' AND source = 'src7' THEN NULL ELSE published_at END AS ts
            FROM doc),
        bound AS (SELECT TIMESTAMP '{EARLIER - ingest.SAFETY_LAG}' AS one, TIMESTAMP '{NEXT - ingest.SAFETY_LAG}' AS two,
                         TIMESTAMP '{EARLIER - ingest.SAFETY_LAG - ingest.OVERLAP}' AS back),
        counted AS (
            SELECT source_name, source, one, two, count(*) FILTER (ts <= one) AS old,
                   count(*) FILTER (ts > one AND ts <= two) AS new,
                   count(*) FILTER (ts >= one AND ts <= two) + count(*) FILTER (ts >= back AND ts <= one) AS seen
            FROM item, bound GROUP BY ALL)
        SELECT 'first' AS run_id, source_name, 'ok' AS status, old AS rows_fetched, old AS rows_new,
               CAST(NULL AS TIMESTAMP) AS watermark_before, one AS watermark_after, CAST(NULL AS VARCHAR) AS error_msg
        FROM counted
        UNION ALL
        SELECT 'second', source_name, 'ok', seen, new, one, two, NULL FROM counted WHERE source NOT IN ('src5', 'src6')
        UNION ALL
        SELECT 'second', source_name, 'error', 0, 0, one, one, '{say.UNREADABLE}' FROM counted
        WHERE source IN ('src5', 'src6'))
        """,
    ),
}
