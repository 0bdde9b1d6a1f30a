"""Token counts through a digest cache.

The cache is a parquet table (tokenizer digest, content digest, n_tokens). A call
joins the digests of its texts with it, encodes one copy of each missing text,
appends those counts, and then answers every row from the cache.

Defined cases: a null text counts as empty (0 tokens, 0 bytes); repeated rows and equal
texts share one entry; an empty table gives an empty result; columns other than doc_id and
text are ignored. Content is not normalised beyond null to empty, because the tokenizer
itself has no normaliser: any other change of the text could change its count.
"""

from __future__ import annotations

import hashlib
import os
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import released, shared_dir, ship, texts
from .packing import runs_of

SCHEMA = "tokenizer string, digest binary, n_tokens long"
#: Bytes of text whose words are told apart at once; characters that the library encodes at once.
TEXTS, BATCH_CHARS = 4 << 20, 1 << 17
#: Remembered parts, and the characters of the longest of them.
MEMO, MEMO_PART = 250_000, 64

#: All that some library may take for white space, and control characters.
_SPACE = "\x00-\x20\x7f-\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u206f\u3000\ufeff"
_ODD = f" [{_SPACE}]|[{_SPACE}] "
_cut = re.compile(f"(?<=[^{_SPACE}])(?= [^{_SPACE}])").split

_loaded: dict[str, tokenizers.Tokenizer] = {}


def tokenizer(path: str) -> tokenizers.Tokenizer:
    """The tokenizer of a .json file, read once by each worker, without truncation or padding."""
    if path not in _loaded:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        _loaded[path] = tokenizers.Tokenizer.from_file(path)
        _loaded[path].no_truncation()
        _loaded[path].no_padding()
    return _loaded[path]


def version(path: str) -> str:
    """Digest of the vocabulary file and the library's version: counts of another one are never reused."""
    with open(path, "rb") as file:
        return hashlib.sha256(file.read() + tokenizers.__version__.encode()).hexdigest()


class PartCounts(dict):
    """Number of tokens of a part of a text; remembers up to ``MEMO`` short parts."""

    def __init__(self, path: str):
        self.library = tokenizer(path)

    def of(self, parts: list[str]) -> np.ndarray:
        """Numbers for distinct parts; the new ones are encoded some at a time."""
        if len(self) > MEMO:
            self.clear()
        new = [x for x in parts if x not in self]
        sizes = np.fromiter(map(len, new), "i8", len(new))
        for start, end in runs_of(sizes, BATCH_CHARS):
            found = self.library.encode_batch_fast(new[start:end], add_special_tokens=False)
            self.update(zip(new[start:end], map(len, found), strict=True))
        out = np.fromiter(map(self.__getitem__, parts), "i8", len(parts))
        for part in [x for x in new if len(x) > MEMO_PART]:
            del self[part]
        return out


def n_tokens(texts_: pa.Array, counts: PartCounts) -> np.ndarray:
    """Number of tokens of each text, from those of its distinct parts.

    The pre-tokenizer joins nothing over a place before a space that has no white space beside it, so the words
    between such spaces are told apart in Arrow and encoded with the space before them. Texts with other spaces
    are cut at such places one by one; those with a special string go to the library whole.
    """
    body = texts_.cast(pa.large_string())
    odd = pc.match_substring_regex(body, _ODD)
    whole = pa.array(np.zeros(len(body), bool))
    for added in counts.library.get_added_tokens_decoder().values():
        whole = pc.or_(whole, pc.match_substring(body, added.content))
    even = pc.invert(pc.or_(odd, whole)).to_numpy(zero_copy_only=False)
    out = np.zeros(len(body), "i8")
    if even.any():
        split = pc.split_pattern(body.filter(pa.array(even)), " ")
        coded = split.flatten().dictionary_encode()
        index, starts = coded.indices.to_numpy(), split.offsets.to_numpy()[:-1]
        known = coded.dictionary.to_pylist()
        of_part = counts.of([f" {x}" for x in known])[index]
        # The first part of a text has no space before it.
        firsts, at = np.unique(index[starts], return_inverse=True)
        of_part[starts] = counts.of([known[x] for x in firsts])[at]
        out[even] = np.add.reduceat(of_part, starts)
    for row in np.flatnonzero(~even).tolist():
        text = body[row].as_py()
        parts = [text] if whole[row].as_py() else _cut(text)
        distinct = list(dict.fromkeys(parts))
        number = dict(zip(distinct, counts.of(distinct).tolist(), strict=True))
        out[row] = sum(map(number.__getitem__, parts))
    return out


def encode_counts(path: str):
    """Rows (digest, text) to (digest, n_tokens); the texts of ``TEXTS`` bytes are taken apart at once."""

    @released
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = PartCounts(path)
        for batch in batches:
            sizes = pc.binary_length(batch["text"]).to_numpy(zero_copy_only=False)
            for start, end in runs_of(sizes, TEXTS):
                part = batch.slice(start, end - start)
                found = pa.array(n_tokens(part["text"], counts), pa.int64())
                yield pa.RecordBatch.from_arrays([part["digest"], found], ["digest", "n_tokens"])

    return run


class CountCache:
    """A table of counts at ``path``. One writer at a time."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path
        spark.createDataFrame([], SCHEMA).write.mode("append").parquet(path)

    def entries(self, tokenizer_version: str) -> DataFrame:
        rows = self.spark.read.schema(SCHEMA).parquet(self.path)
        return rows.filter(F.col("tokenizer") == tokenizer_version).select("digest", "n_tokens")

    def fill(self, docs: DataFrame, tokenizer_path: str) -> str:
        """Encode the texts of ``docs`` that the cache lacks; the version under which they are kept.

        Only digests are grouped. Of each missing text the row with the smallest (doc_id, digest)
        is read again and encoded; the shuffle of those texts also deals long ones out.
        """
        ship(self.spark)
        known = version(tokenizer_path)
        keyed = digests(docs)
        missing = (
            keyed.groupBy("digest")
            .agg(F.min("node").alias("node"))
            .join(self.entries(known), "digest", "left_anti")
        )
        chosen = keyed.join(missing.hint("shuffle_hash"), ["digest", "node"], "left_semi")
        counted = chosen.select("digest", "text").mapInArrow(
            encode_counts(tokenizer_path), "digest binary, n_tokens long"
        )
        once = counted.groupBy("digest").agg(F.min("n_tokens").alias("n_tokens"))  # a row may repeat
        once.select(F.lit(known).alias("tokenizer"), "digest", "n_tokens").write.mode("append").parquet(self.path)
        return known


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, node (a long for the row), text, its digest and its size in bytes."""
    rows = texts(docs, "doc_id", F.coalesce(F.col("doc_id").cast("long"), F.lit(-1)).alias("node"))
    return rows.withColumns(
        {"digest": F.unhex(F.sha2(F.col("text").cast("binary"), 256)), "n_bytes": F.octet_length("text").cast("long")}
    )


def token_counts(
    docs: DataFrame, tokenizer_path: str, cache_path: str | None = None, limit: int = 1024
) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row; ``cache_path`` None starts an empty cache."""
    spark = docs.sparkSession
    cache = CountCache(spark, cache_path or f"{shared_dir(spark)}/llm/{uuid.uuid4().hex}/token_counts")
    known = cache.fill(docs, tokenizer_path)
    rows = digests(docs).select("doc_id", "digest", "n_bytes")
    return rows.join(cache.entries(known), "digest").select(
        "doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
