"""Repeated passages by a sparse suffix array over words.

1. Suffixes are retained at content-selected places only: the minimum of the word-gram hashes of every
   ``PLACES`` neighbouring places. Any passage of ``PASSAGE`` words holds such a place that has
   ``PREFIX`` of the passage's words to its right, and the same one in each of its copies.
2. The retained suffixes are sorted by the hash of their first ``PREFIX`` words, and neighbours
   are compared: suffixes without an equal neighbour go.
3. What remains is extended to the left (as far as the passages go whose place it is) and to the right
   (to ``PASSAGE`` words), and the extended matches are sorted and compared in turn.
4. Overlapping matches of a document are joined to spans.

The first copy (smallest doc_id, then place) of each passage is told apart from the later ones. Equal
keys are combined in each task before they are dealt out, so a passage that a third of all documents
share brings a few rows for each task.

Words are runs of other than ASCII white space, compared with A-Z lower-cased. Defined cases: null,
empty and short texts have no span; a row without doc_id goes by a hash of its text and has a null
doc_id in the result; rows repeated under one doc_id are one document, different texts under one doc_id
are compared like those of two; an empty table gives an empty result; other columns are ignored. Passages that repeat within one text count as well.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import FURTHER, batches, node_id, released, ship, stored, text_nodes, texts
from .minhash import WordHashes, hashed_words, runs

PASSAGE = 50
PLACES = 25
PREFIX = PASSAGE - PLACES + 1
GRAM = 4
#: Rows combined at once in a task; of matches, which are wide and held several times over, an eighth.
TASK_ROWS = 1 << 20
#: Characters of text that are split into words at once; the words take many times the memory of the text.
WORDS_OF = 1 << 20

SPANS = "node long, start_word long, end_word long, n_words long, first_node long, is_first boolean, first_nodes array<long>"


def selected(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The retained places, and for each start of a passage the number of its place among them."""
    starts = len(words) - PASSAGE + 1
    if starts < 1:
        return np.empty(0, "i8"), np.empty(0, "i8")
    grams = runs(words, GRAM)
    chosen = np.empty(starts, "i8")
    for at in range(0, starts, 1 << 15):
        end = min(starts, at + (1 << 15))
        near = np.lib.stride_tricks.sliding_window_view(grams[at : end + PLACES - 1], PLACES)
        chosen[at:end] = near.argmin(axis=1) + np.arange(at, end)  # the leftmost of equal minima
    return np.unique(chosen, return_inverse=True)


def keys_of(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of the first ``PREFIX`` words of each retained suffix, and the passages' place numbers."""
    places, owner = selected(words)
    return (runs(words, PREFIX)[places] if len(places) else np.empty(0, "u8")), owner


@released
def _keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (node, text) to (node, keys): the keys of its suffixes, twice those that it has several times.

    The only pass that hashes the words of all texts.
    """
    hashes = WordHashes()
    for frame in batches(frames, "text", WORDS_OF):
        nodes, told = [], []
        for node, words in zip(frame["node"], hashed_words(frame["text"].tolist(), hashes), strict=True):
            keys, counts = np.unique(keys_of(words)[0], return_counts=True)
            if len(keys):
                nodes.append(node)
                told.append(np.concatenate([keys, keys[counts > 1]]).view("i8"))
        yield pd.DataFrame({"node": pd.Series(nodes, dtype="i8"), "keys": pd.Series(told, dtype=object)})


@released
def _count_keys(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held, size = [], 0

    def flush() -> pd.DataFrame:
        keys, counts = np.unique(np.concatenate(held), return_counts=True)
        return pd.DataFrame({"key": keys, "again": counts > 1})

    for frame in frames:
        for keys in frame["keys"]:
            held.append(keys)
            size += len(keys)
            if size >= TASK_ROWS:
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


@released
def _equal_neighbours(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Of sorted keys those that come twice, or came twice in one task; each once."""
    last, told = None, None
    for frame in frames:
        keys, again = frame["key"].to_numpy(), frame["again"].to_numpy(bool).copy()
        if not len(keys):
            continue
        again[1:] |= keys[1:] == keys[:-1]
        again[0] |= keys[0] == last
        found = np.unique(keys[again])
        if told is not None:
            found = found[found != told]
        last = keys[-1]
        told = found[-1] if len(found) else told
        yield pd.DataFrame({"key": found})


def _first_of_runs(key: np.ndarray, node: np.ndarray, start: np.ndarray) -> np.ndarray:
    """For rows sorted by (key, node, start): the row at which each run of equal keys begins."""
    new = np.concatenate([[True], key[1:] != key[:-1]])
    return np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))


@released
def _extended(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows (node, text, keys) to passages around suffixes with those keys.

    Copies found inside a task are settled there (``first_node`` is the task's first copy) and travel by ``route``
    with no key in common; of each passage that first copy goes on, to meet those of other tasks.
    """
    hashes, held, size = WordHashes(), [], 0

    def flush() -> pd.DataFrame:
        key, node, start = (np.concatenate([x[i] for x in held]) for i in range(3))
        order = np.lexsort((start, node, key))
        key, node, start = key[order], node[order], start[order]
        first = _first_of_runs(key, node, start)
        copy = (node != node[first]) | (start != start[first])
        again = np.zeros(len(key), bool)
        again[first[copy]] = True
        keep = copy | (first == np.arange(len(key)))  # repeated rows of one document go
        frame = pd.DataFrame(
            {
                "route": np.where(copy, node * 31 + start, key.view("i8")),
                "settled": copy,
                "key": key.view("i8"),
                "node": node,
                "start": start,
                "first_node": node[first],
                "again": again,
            }
        )
        return frame[keep]

    for frame in batches(frames, "text", WORDS_OF):
        hashed = hashed_words(frame["text"].tolist(), hashes)
        for node, words, wanted in zip(frame["node"], hashed, frame["keys"], strict=True):
            keys, owner = keys_of(words)
            starts = np.flatnonzero(np.isin(keys.view("i8"), wanted)[owner]) if len(keys) else np.empty(0, "i8")
            if len(starts):
                held.append((runs(words, PASSAGE)[starts], np.full(len(starts), node, "i8"), starts))
                size += len(starts)
            if size >= max(1, TASK_ROWS // 8):
                yield flush()
                held, size = [], 0
    if size:
        yield flush()


MATCHES = "kind int, key long, node long, start long, first_node long, is_first boolean"
#: Kinds of rows: a match; one settled in its task; a task's first copy (node) that is not the first (first_node) of all.
FINAL, SETTLED, MOVED = 0, 1, 2


@released
def _compare(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows sorted by (settled, route, node, start) to matches: later copies, and the first of each passage."""
    waiting = None  # the first copy of the passage in hand; whether it has others is known at its end
    for frame in frames:
        settled = frame["settled"].to_numpy(bool)
        out = [frame.loc[settled, ["key", "node", "start", "first_node"]].assign(kind=SETTLED, is_first=False)]
        rows = frame[~settled]
        if len(rows):
            if waiting is not None:
                rows = pd.concat([waiting, rows], ignore_index=True)
            key, node, start = (rows[c].to_numpy("i8") for c in ("route", "node", "start"))
            first = _first_of_runs(key, node, start)
            copy = (node != node[first]) | (start != start[first])
            repeated = np.zeros(len(key), bool)
            np.logical_or.at(repeated, first, copy | rows["again"].to_numpy(bool))
            ended = repeated.copy()
            ended[first[-1]] = False
            waiting = rows.iloc[[first[-1]]].assign(again=bool(repeated[first[-1]]))
            moved = rows["again"].to_numpy(bool) & (node != node[first])
            for told, kind, is_first in ((copy, FINAL, False), (ended, FINAL, True), (moved, MOVED, False)):
                found = {"key": key[told], "node": node[told], "start": start[told], "first_node": node[first][told]}
                out.append(pd.DataFrame(found).assign(kind=kind, is_first=is_first))
        yield pd.concat(out, ignore_index=True)[MATCH_COLUMNS]
    if waiting is not None and bool(waiting["again"].iloc[0]):
        yield waiting.assign(first_node=waiting["node"], kind=FINAL, is_first=True)[MATCH_COLUMNS]


MATCH_COLUMNS = [x.split()[0] for x in MATCHES.split(", ")]


def _with_firsts(matches: DataFrame) -> DataFrame:
    """Matches with the first copy of all tasks.

    Settled rows meet the table of what moved by passage and their task's first copy, so a passage that very many
    documents share is dealt out by the tasks that found it.
    """
    told = stored(matches, "matches")
    moved = told.filter(F.col("kind") == MOVED)
    moved = moved.select(F.col("key").alias("of"), F.col("node").alias("old"), F.col("first_node").alias("new")).distinct()
    settled = told.filter(F.col("kind") == SETTLED)
    settled = settled.join(moved, (F.col("key") == F.col("of")) & (F.col("first_node") == F.col("old")), "left")
    settled = settled.select("node", "start", F.coalesce("new", "first_node").alias("first_node"), "is_first")
    final = told.filter(F.col("kind") == FINAL).select("node", "start", "first_node", "is_first")
    return final.unionByName(settled)


@released
def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (node, matches) to spans of joined matches, first copies and later ones apart."""
    for batch in batches:
        if not batch.num_rows:
            continue
        found = batch["matches"].flatten()
        row = np.repeat(np.arange(batch.num_rows), np.diff(batch["matches"].offsets.to_numpy()))
        later = ~found.field("is_first").to_numpy(zero_copy_only=False)
        start, first = (found.field(x).to_numpy() for x in ("start", "first_node"))
        order = np.lexsort((first, start, later, row))
        row, later, start, first = row[order], later[order], start[order], first[order]
        new = (row[1:] != row[:-1]) | (later[1:] != later[:-1]) | (start[1:] > start[:-1] + PASSAGE)
        begins = np.flatnonzero(np.concatenate([[True], new]))
        lasts = np.concatenate([begins[1:], [len(row)]]) - 1
        firsts = [np.unique(first[x : y + 1]) for x, y in zip(begins, lasts, strict=True)]
        begin, end = start[begins], start[lasts] + PASSAGE
        least = np.array([x[0] for x in firsts], "i8")
        columns = [batch["node"].take(pa.array(row[begins])), begin, end, end - begin, least, ~later[begins], firsts]
        types = [pa.int64()] * 5 + [pa.bool_(), pa.list_(pa.int64())]
        made = [x if isinstance(x, pa.Array) else pa.array(x, t) for x, t in zip(columns, types, strict=True)]
        yield pa.RecordBatch.from_arrays(made, [x.split()[0] for x in SPANS.split(", ")])


def named_rows(docs: DataFrame) -> DataFrame:
    """home, text, node of every row: a node for each text of a doc_id, as ``spans`` has them."""
    return text_nodes(texts(docs, node_id().alias("node")))


def spans(docs: DataFrame, firsts: bool = True) -> DataFrame:
    """node, start_word, end_word, n_words, first_node, is_first, first_nodes: one row for each span of repeated words.

    ``first_nodes`` are the documents with the first copies of the span's passages, ``first_node`` is the least of
    them. Without ``firsts`` both may name the first copy of a task; the spans are the same.
    """
    ship(docs.sparkSession)
    rows = named_rows(docs).select("node", "text")
    keyed = stored(rows.mapInPandas(_keys, "node long, keys array<long>"), "keyed")
    counted = keyed.select("keys").mapInPandas(_count_keys, "key long, again boolean")
    ordered = counted.repartition("key").sortWithinPartitions("key")
    repeated = stored(ordered.mapInPandas(_equal_neighbours, "key long"), "keys")
    suffixes = keyed.select("node", F.explode("keys").alias("key"))
    kept = suffixes.join(repeated, "key", "left_semi").groupBy("node").agg(F.collect_set("key").alias("keys"))
    wanted = stored(kept, "suffixes")
    found = rows.join(wanted.hint("shuffle_hash"), "node").select("node", "text", "keys")
    schema = "route long, settled boolean, key long, node long, start long, first_node long, again boolean"
    passages = found.mapInPandas(_extended, schema)
    dealt = passages.repartition("route").sortWithinPartitions("settled", "route", "node", "start")
    matches = dealt.mapInPandas(_compare, MATCHES)
    matches = _with_firsts(matches) if firsts else matches.filter(F.col("kind") != MOVED)
    of_node = matches.groupBy("node").agg(F.collect_list(F.struct("start", "first_node", "is_first")).alias("matches"))
    return of_node.mapInArrow(_spans, SPANS)


def repeated_passages(docs: DataFrame) -> DataFrame:
    """doc_id, start_word, end_word, n_words, first_doc_id, is_first, first_doc_ids of every span."""
    found = stored(spans(docs), "spans")
    rows = docs.select(F.col("doc_id").isNull().alias("nameless"), node_id().alias("node"), "text")
    rows = text_nodes(rows.withColumn("text", F.coalesce("text", F.lit(""))))
    # Nodes that are not their row's doc_id, few unless doc_ids are null or shared.
    other = rows.filter("nameless OR node <> home").select(
        F.col("node").alias("other"), F.when(~F.col("nameless"), F.col("home")).alias("doc")
    )
    other = stored(other.distinct(), "other")
    further = F.exists("first_nodes", lambda node: node >= FURTHER)
    told = found.filter(~further).unionByName(_with_homes(found.filter(further), other.filter("doc IS NOT NULL")))
    named = told.join(other, F.col("node") == F.col("other"), "left")
    return named.select(
        F.when(F.col("other").isNull(), F.col("node")).otherwise(F.col("doc")).alias("doc_id"),
        "start_word",
        "end_word",
        "n_words",
        F.col("first_node").alias("first_doc_id"),
        "is_first",
        F.col("first_nodes").alias("first_doc_ids"),
    )


def _with_homes(found: DataFrame, further: DataFrame) -> DataFrame:
    """Spans whose first documents include further texts (other) of a doc_id (doc), by the doc_ids."""
    keys = ["node", "start_word", "end_word", "n_words", "is_first"]
    nodes = found.select(*keys, F.explode("first_nodes").alias("first")).join(further, F.col("first") == F.col("other"), "left")
    firsts = F.sort_array(F.collect_set(F.coalesce("doc", "first")))
    return nodes.groupBy(*keys).agg(firsts.alias("first_nodes")).select(
        "node", "start_word", "end_word", "n_words", F.col("first_nodes")[0].alias("first_node"), "is_first", "first_nodes"
    )


_WORD = re.compile(r"[^\x20\x09-\x0D]+")


def without_words(text: str, cuts: list[tuple[int, int]]) -> str:
    """The text without the words of each (start, end), and without the white space after them."""
    places = [m.start() for m in _WORD.finditer(text)] + [len(text)]
    out, at = [], 0
    for start, end in sorted(cuts):
        out.append(text[at : places[start]])
        at = places[end]
    return "".join([*out, text[at:]])


def cut_text(text: str, cuts: str) -> Column:
    """Column ``text`` without the words of the column ``cuts`` (structs start_word, end_word; null for none)."""

    @F.pandas_udf("string")
    def cut(bodies: pd.Series, spans: pd.Series) -> pd.Series:
        found = [
            body if found is None else without_words(body, [(x["start_word"], x["end_word"]) for x in found])
            for body, found in zip(bodies, spans, strict=True)
        ]
        return pd.Series(found, dtype=object)

    # Else Catalyst evaluates it once for a filter on the result and once more for the result.
    return cut.asNondeterministic()(text, cuts)
