"""Registered queries of the text operators, each over its whole table, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, exact_dedup, fill_middle, langid, license_scan, merkle, minhash, packing, quality, spotsigs, suffixes,
    token_counts, toxicity,
)

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op2_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.round_trip(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents")).drop("node")


def op4_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spotsigs.edited_and_next(table(spark, sf_dir, "documents"))


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality.quality_scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as files of a tree by source, language and thousand; one in 1000 and in 100 is named as a licence file."""
    docs = table(spark, sf_dir, "documents")
    doc, root = F.col("doc_id"), F.concat_ws("/", "source", "lang")
    path = (
        F.when(doc % 1000 == 0, F.concat_ws("/", "source", F.format_string("LICENSE-%d", doc)))
        .when(doc % 100 == 1, F.concat_ws("/", root, F.format_string("COPYING-%d", doc)))
        .otherwise(F.concat_ws("/", root, F.floor(doc / 1000).cast("string"), F.format_string("%d.txt", doc)))
    )
    return license_scan.scan(docs.select("doc_id", path.alias("path"), "text"))


def op7_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents")).drop("node")


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.repeated_passages(table(spark, sf_dir, "documents"))


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return langid.predict(docs, langid.train(docs))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.verified(table(spark, sf_dir, "documents"))


def op12_fill_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fill_middle.round_trip(table(spark, sf_dir, "documents"))


def op13_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def all_queries() -> dict[str, Query]:
    found = [
        op1_token_counts, op2_byte_bpe, op3_exact_dedup, op4_spotsigs, op5_quality, op6_license_scan, op7_minhash,
        op8_suffix_array, op9_packing, op10_language, op11_merkle, op12_fill_middle, op13_toxicity,
    ]
    return {query.__name__: query for query in found}


def all_oracles() -> dict[str, str]:
    return {"op3_exact_dedup": _EXACT, "op11_merkle": _MERKLE, "op12_fill_middle": _FILL_MIDDLE}


#: A-Z only are lower-cased; ``lower`` would change other letters too.
_EXACT = """
WITH normal AS (
    SELECT doc_id,
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS body
    FROM documents
)
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(body) AS text_sha256
FROM normal
WINDOW same AS (PARTITION BY body)
"""

#: The tree as a recursion over its levels; crc32 bit by bit, since DuckDB has none.
_MERKLE = """
WITH RECURSIVE heads AS (
    SELECT doc_id, source, text,
           coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id, '-')
           || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-')
           || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars, '-') AS head,
           CAST(doc_id AS VARCHAR) AS digits
    FROM documents
),
checked AS (
    SELECT *,
           digits IS NOT NULL AND xor(list_reduce(
               list_concat(
                   [CAST(4294967295 AS BIGINT)],
                   flatten(list_transform(range(1, length(digits) + 1),
                       lambda i: [CAST(ascii(substr(digits, i, 1)) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
               lambda a, x: xor(xor(a, x) >> 1, CASE WHEN xor(a, x) & 1 = 1 THEN 3988292384 ELSE 0 END)
           ), 4294967295) % 5 = 0 AS hit
    FROM heads
),
hashed AS (
    SELECT doc_id, source,
           sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
           sha256(head || coalesce(strlen(text) || ':' || CASE
               WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')
               ELSE text END, '-')) AS seen
    FROM checked
),
placed AS (
    SELECT *, row_number() OVER () AS id,
           row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos,
           count(*) OVER (PARTITION BY source) AS n
    FROM hashed
),
tree(lv, source, pos, n, node) AS (
    SELECT 0, source, pos, n, leaf FROM placed
    UNION ALL
    SELECT lv + 1, source, pos // 16, max((n + 15) // 16), sha256(string_agg(node, '' ORDER BY pos))
    FROM tree WHERE n > 1 GROUP BY lv, source, pos // 16
),
subroots AS (
    SELECT source, node AS subroot, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n
    FROM tree WHERE n = 1
),
upper_tree(lv, pos, n, node) AS (
    SELECT 0, pos, n, subroot FROM subroots
    UNION ALL
    SELECT lv + 1, pos // 16, max((n + 15) // 16), sha256(string_agg(node, '' ORDER BY pos))
    FROM upper_tree WHERE n > 1 GROUP BY lv, pos // 16
),
runs AS (
    SELECT lv, source, pos // 16 AS run, list(node ORDER BY pos) AS nodes
    FROM tree WHERE n > 1 GROUP BY lv, source, pos // 16
),
upper_runs AS (
    SELECT lv, pos // 16 AS run, list(node ORDER BY pos) AS nodes FROM upper_tree WHERE n > 1 GROUP BY lv, pos // 16
),
climb(lv, id, source, pos, acc, siblings) AS (
    SELECT 0, id, source, pos, seen, '' FROM placed
    UNION ALL
    SELECT c.lv + 1, c.id, c.source, c.pos // 16,
           sha256(array_to_string(r.nodes[1 : c.pos % 16], '') || c.acc || array_to_string(r.nodes[c.pos % 16 + 2 :], '')),
           c.siblings || array_to_string(r.nodes[1 : c.pos % 16], '') || array_to_string(r.nodes[c.pos % 16 + 2 :], '')
    FROM climb c JOIN runs r ON r.lv = c.lv AND r.source IS NOT DISTINCT FROM c.source AND r.run = c.pos // 16
),
at_subroot AS (
    SELECT id, arg_max(acc, lv) AS acc, arg_max(siblings, lv) AS siblings FROM climb GROUP BY id
),
upper_climb(lv, id, pos, acc, siblings) AS (
    SELECT 0, p.id, s.pos, a.acc, a.siblings
    FROM placed p JOIN at_subroot a USING (id) JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
    UNION ALL
    SELECT c.lv + 1, c.id, c.pos // 16,
           sha256(array_to_string(r.nodes[1 : c.pos % 16], '') || c.acc || array_to_string(r.nodes[c.pos % 16 + 2 :], '')),
           c.siblings || array_to_string(r.nodes[1 : c.pos % 16], '') || array_to_string(r.nodes[c.pos % 16 + 2 :], '')
    FROM upper_climb c JOIN upper_runs r ON r.lv = c.lv AND r.run = c.pos // 16
),
at_root AS (
    SELECT id, arg_max(acc, lv) AS folded, arg_max(siblings, lv) AS siblings FROM upper_climb GROUP BY id
)
SELECT p.doc_id, p.leaf, s.subroot, t.node AS root, sha256(r.siblings) AS proof_sha256,
       r.folded AS folded_root, r.folded = t.node AS verified
FROM placed p
JOIN at_root r USING (id)
JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source
JOIN upper_tree t ON t.n = 1
"""

_FILL_MIDDLE = """
WITH cut AS (
    SELECT doc_id, coalesce(text, '') AS text,
           regexp_extract_all(coalesce(text, ''),
               '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS tokens,
           sha256('42:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
    FROM documents
),
drawn AS (
    SELECT *, len(tokens) AS n,
           CAST('0x' || substr(digest, 1, 8) AS BIGINT) % (len(tokens) + 1) AS a,
           CAST('0x' || substr(digest, 9, 8) AS BIGINT) % (len(tokens) + 1) AS b,
           CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>')
                     OR CAST('0x' || substr(digest, 17, 8) AS BIGINT) % 100 >= 50 THEN 'plain'
                WHEN CAST('0x' || substr(digest, 25, 8) AS BIGINT) % 100 < 80 THEN 'spm'
                ELSE 'psm' END AS form
    FROM cut
),
parts AS (
    SELECT *, array_to_string(tokens[1 : least(a, b)], '') AS pre,
           array_to_string(tokens[least(a, b) + 1 : greatest(a, b)], '') AS mid,
           array_to_string(tokens[greatest(a, b) + 1 :], '') AS suf
    FROM drawn
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(pre) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(mid) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text
                        WHEN 'psm' THEN '<P>' || pre || '<S>' || suf || '<M>' || mid
                        ELSE '<S>' || suf || '<P>' || pre || '<M>' || mid END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""
