"""Toxicity by a weighted lexicon, matched with Aho-Corasick on folded text and normalised by length.

Folding undoes what hides a word: letters are lower-cased and taken to their compatibility form, invisible characters
go, look-alike letters of other scripts become Latin in words that mix scripts or stand among Latin ones, and digits or signs inside a word
stand for letters as well. The lexicon holds whole words and beginnings of words; an entry's weight is the log of how
much more often toxic texts have it, less its likely error. Of entries that begin at one place the heaviest counts.
An exception phrase is a pair of words that takes a hit inside it back.

The lexicon, the phrases and the curve are learnt from at most ``PER_CLASS`` labelled texts of each class (those
with the smallest hashes of doc_id) outside the held-out fold, whatever the size of the corpus. A score is the
logistic curve of the hits' weight for each hundred words; scores cover all rows and whole texts, where they are read.

Defined cases: null and empty texts have no hits and get the curve's lowest score; null labels are ignored, several
labels of one doc_id count as the largest; equal texts of the sample count once; without labels of both classes, or
without any entry, all scores are 0; repeated rows give repeated results; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import math
import re
import unicodedata
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fold, ship, stored, texts

PER_CLASS = 2500
THRESHOLD = 0.5
FOLDS = 5
#: Letters of the shortest and of the longest beginning of a word that can become an entry.
SHORTEST, LONGEST = 3, 8
#: Texts, and share of the toxic texts, that an entry must occur in, and the least weight of one. Candidates that
#: exception phrases might lift to that have any weight above 0.
LEAST_TEXTS, LEAST_SHARE, LEAST_WEIGHT = 5, 0.01, 2.0
#: Standard errors that a weight is lowered by.
DOUBT = 1.6
#: A beginning gives way to a longer one that keeps this share of its toxic texts.
CLOSED = 0.95
#: Toxic texts that a phrase would have if it were like its entry, for none to be a sign.
EXPECTED = 8.0
#: Entries and phrases that the driver takes; there are at most 1 / LEAST_SHARE texts' words anyway.
MOST_ENTRIES, MOST_PHRASES = 20_000, 20_000
#: Words added to a text's length, so that a short text is not judged by its length alone.
SMOOTH = 20
#: Patterns that a task counts before it hands them on.
COUNTED = 1_000_000

# Letters of other scripts that look like Latin ones, and digits and signs that stand for letters.
LOOK_ALIKES = dict(zip("аеорсухіјѕԁһԛԝєкмтвнαορνυικτɑɡı", "aeopcyxijsdhqwekmtbhaopvuiktagi", strict=True))
STANDS_FOR = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "@": "a", "$": "s"}
OTHER_ONE = STANDS_FOR | {"1": "l"}

_WORD = re.compile(r"[^\W\d_]+")
_LATIN = re.compile("[a-z]")
_HIDDEN = re.compile("[­​-‏⁠﻿]")
_ALIKE = re.compile(f"[{''.join(LOOK_ALIKES)}]")
_STAND = re.compile(r"[0134578@$]")
_ALIKE_TABLE, _STAND_TABLE, _OTHER_TABLE = map(str.maketrans, (LOOK_ALIKES, STANDS_FOR, OTHER_ONE))


def _latin(words: list[str]) -> list[str]:
    """The words with look-alikes as Latin letters where scripts mix in a word, or between it and most others."""
    most = 2 * sum(_LATIN.search(w) is not None for w in words) >= len(words)

    def seen(word: str) -> str:
        if not _ALIKE.search(word):
            return word
        read = word.translate(_ALIKE_TABLE)
        return read if _LATIN.search(word) or (most and read.isascii()) else word

    return [seen(w) for w in words]


def folded(text: str) -> tuple[list[str], list[str]]:
    """The words of a text, and further readings of those with digits or signs for letters."""
    text = text.lower()
    if not text.isascii():
        if not unicodedata.is_normalized("NFKC", text):
            text = unicodedata.normalize("NFKC", text)
        text = _HIDDEN.sub("", text)
    words = _WORD.findall(text)
    alike = not text.isascii() and _ALIKE.search(text)
    if alike:
        words = _latin(words)
    if not _STAND.search(text):
        return words, []
    further = []
    for token in text.split():
        if _STAND.search(token) and _WORD.search(token):
            first = token.translate(_STAND_TABLE)
            for reading in {first, token.translate(_OTHER_TABLE)} if "1" in token else (first,):
                further += _WORD.findall(reading)
    return words, _latin(further) if alike else further


def stream(words: list[str], further: list[str]) -> str:
    """What the patterns are matched against: each word between spaces, further readings behind a bar."""
    return f" {' '.join(words)} | {' '.join(further)} " if further else f" {' '.join(words)} "


@dataclass
class Lexicon:
    """Entries `` word `` and `` begin`` with their weights, exception phrases, and the curve over them."""

    weights: dict[str, float]
    phrases: list[str] = field(default_factory=list)
    slope: float = 0.0
    intercept: float = -math.inf

    def matcher(self) -> ahocorasick.Automaton:
        found = ahocorasick.Automaton()
        for entry in self.weights:
            found.add_word(entry, (entry, False))
        for phrase in self.phrases:
            found.add_word(phrase, (phrase, True))
        found.make_automaton()
        return found

    def scores(self, heats: np.ndarray) -> np.ndarray:
        if not self.weights or math.isinf(self.intercept):
            return np.zeros(len(heats))
        return 1 / (1 + np.exp(-np.clip(self.intercept + self.slope * heats, -500, 500)))


def hits(matcher: ahocorasick.Automaton, line: str) -> list[tuple[int, str]]:
    """End and entry of each match that no exception phrase covers."""
    if not len(matcher):
        return []
    found, covered = [], []
    for end, (pattern, exception) in matcher.iter(line):
        if exception:
            covered.append((end - len(pattern) + 1, end))
        else:
            found.append((end, pattern))
    if not covered:
        return found
    covered.sort()
    # Phrases of two words overlap in a word at most, so ends ascend with starts up to that.
    starts = np.array([start for start, _ in covered])
    furthest = np.maximum.accumulate([end for _, end in covered])
    kept = []
    for end, entry in found:
        at = int(np.searchsorted(starts, end - len(entry) + 1, side="right")) - 1
        if at < 0 or furthest[at] < end:
            kept.append((end, entry))
    return kept


def heat(lexicon: Lexicon, matcher: ahocorasick.Automaton, text: str) -> float:
    """Damped weight of the hits for each hundred words."""
    words, further = folded(text)
    best: dict[int, float] = {}
    for end, entry in hits(matcher, stream(words, further)):
        start, weight = end - len(entry), lexicon.weights[entry]
        best[start] = max(weight, best.get(start, 0.0))
    return math.log1p(100 * math.fsum(best.values()) / (len(words) + SMOOTH))


def patterns(text: str) -> set[str]:
    """The beginnings and whole words of a text, as entries."""
    words, further = folded(text)
    out = set()
    for word in {*words, *further}:
        if len(word) >= SHORTEST:
            out.add(f" {word} ")
            out.update(f" {word[:n]}" for n in range(SHORTEST, min(LONGEST, len(word)) + 1))
    return out


def _counted(frames: Iterator[pd.DataFrame], of) -> Iterator[pd.DataFrame]:
    """Texts of each class that have what ``of`` finds in them, counted where they are read."""
    counts: tuple[Counter, Counter] = (Counter(), Counter())

    def out() -> pd.DataFrame:
        keys = list({**counts[0], **counts[1]})
        return pd.DataFrame(
            {"pattern": keys, "clean": [counts[0][k] for k in keys], "toxic": [counts[1][k] for k in keys]}
        )

    for frame in frames:
        for toxic, text in zip(frame["toxic"], frame["text"], strict=True):
            counts[toxic].update(of(text))
            if len(counts[0]) + len(counts[1]) > COUNTED:
                yield out()
                counts[0].clear(), counts[1].clear()
    if counts[0] or counts[1]:
        yield out()


def _count(sample: DataFrame, of) -> DataFrame:
    rows = sample.mapInPandas(lambda frames: _counted(frames, of), "pattern string, clean long, toxic long")
    return rows.groupBy("pattern").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))


def _weight(n_toxic: int, n_clean: int):
    toxic, clean = F.col("toxic") + 0.5, F.col("clean") + 0.5
    return F.log((toxic / (n_toxic + 1)) / (clean / (n_clean + 1))) - DOUBT * F.sqrt(1 / toxic + 1 / clean)


def _entries(counts: DataFrame, n_toxic: int, n_clean: int) -> dict[str, tuple[float, int, int]]:
    """Candidates: frequent and telling beginnings, as long as they lose no toxic texts by it."""
    least = max(LEAST_TEXTS, LEAST_SHARE * n_toxic)
    told = counts.filter(F.col("toxic") >= least).withColumn("weight", _weight(n_toxic, n_clean))
    told = stored(told.filter(F.col("weight") > 0), "told")
    whole = F.col("pattern").endswith(" ")
    parent = F.when(
        whole & (F.length("pattern") > LONGEST + 2), F.substring("pattern", 1, LONGEST + 1)
    ).otherwise(F.expr("substring(pattern, 1, length(pattern) - 1)"))
    longer = told.groupBy(parent.alias("shorter")).agg(F.max("toxic").alias("kept"))
    closed = told.join(longer, F.col("pattern") == F.col("shorter"), "left").filter(
        F.coalesce("kept", F.lit(0)) < CLOSED * F.col("toxic")
    )
    rows = closed.orderBy(F.col("toxic").desc(), "pattern").limit(MOST_ENTRIES).collect()
    return {r["pattern"]: (r["weight"], r["clean"], r["toxic"]) for r in rows}


def _pairs(matcher: ahocorasick.Automaton):
    """Of a text, the pairs of words around each hit, with the entry."""

    def of(text: str) -> set[str]:
        line = stream(*folded(text))
        out = set()
        for end, entry in hits(matcher, line):
            start = end - len(entry) + 1
            stop = line.index(" ", start + 1)
            before = line.rfind(" ", 0, start)
            after = line.find(" ", stop + 1)
            if before >= 0 and start:
                out.add(f"{entry}\t{line[before : stop + 1]}")
            if after > 0:
                out.add(f"{entry}\t{line[start : after + 1]}")
        return {x for x in out if "|" not in x}

    return of


def _phrases(sample: DataFrame, entries: dict[str, tuple[float, int, int]]) -> list[str]:
    """Pairs of words that clean texts have often, toxic ones never, though their entry is common there."""
    around = _count(sample, _pairs(Lexicon(dict.fromkeys(entries, 0.0)).matcher())).filter(
        (F.col("toxic") == 0) & (F.col("clean") >= LEAST_TEXTS)
    )
    rows = around.orderBy(F.col("clean").desc(), "pattern").limit(MOST_PHRASES).collect()
    out = set()
    for row in rows:
        entry, phrase = row["pattern"].split("\t")
        _, clean, toxic = entries[entry]
        if row["clean"] * toxic / clean >= EXPECTED:
            out.add(phrase)
    return sorted(out)


def _needed(weights: dict[str, float]) -> dict[str, float]:
    """Without the entries that begin with another one of no less weight."""

    def shorter(entry: str) -> float:
        return max((weights.get(entry[:n], 0.0) for n in range(SHORTEST + 1, len(entry))), default=0.0)

    return {entry: weight for entry, weight in weights.items() if weight > shorter(entry)}


def fit_curve(heats: np.ndarray, toxic: np.ndarray, toxic_share: float, penalty: float = 1e-3) -> tuple[float, float]:
    """Slope and intercept of the logistic curve by damped Newton steps; the classes weigh their shares of all labels."""
    x = np.stack([heats, np.ones(len(heats))], axis=1)
    share = np.where(toxic == 1, toxic_share / (toxic == 1).sum(), (1 - toxic_share) / (toxic == 0).sum())
    keep = penalty * np.diag([1.0, 0.1])
    w = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -500, 500)))
        slope = x.T @ (share * (toxic - p)) - keep @ w
        curve = (x * (share * p * (1 - p))[:, None]).T @ x + keep
        step = np.linalg.solve(curve, slope)
        w += step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-7:
            break
    return float(w[0]), float(w[1])


def train(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """Learn the lexicon from labelled rows outside the held-out fold."""
    ship(docs.sparkSession)
    given = (
        labels.filter(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .filter(fold("doc_id", FOLDS) != 0)
        .groupBy(F.col("doc_id").alias("labelled"))
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    labelled = {row["toxic"]: row["count"] for row in given.groupBy("toxic").count().collect()}
    order = [F.xxhash64("labelled"), F.col("labelled")]
    chosen = [given.filter(F.col("toxic") == c).orderBy(*order).limit(PER_CLASS) for c in (0, 1)]
    few = F.broadcast(chosen[0].unionByName(chosen[1]))  # 2 * PER_CLASS rows
    found = texts(docs, "doc_id").join(few, F.col("doc_id") == F.col("labelled"))
    sample = stored(found.groupBy("text").agg(F.max("toxic").alias("toxic")), "sample")
    sizes = {row["toxic"]: row["count"] for row in sample.groupBy("toxic").count().collect()}
    n_toxic, n_clean = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_clean:
        return Lexicon({})
    entries = _entries(_count(sample, patterns), n_toxic, n_clean)
    phrases = _phrases(sample, entries) if entries else []
    weights = {entry: weight for entry, (weight, _, _) in entries.items()}
    if phrases:
        matcher = Lexicon(weights, phrases).matcher()
        again = _count(sample, lambda text: {entry for _, entry in hits(matcher, stream(*folded(text)))})
        rows = again.withColumn("weight", _weight(n_toxic, n_clean)).limit(MOST_ENTRIES).collect()
        weights = {r["pattern"]: r["weight"] for r in rows}
    lexicon = Lexicon(_needed({e: w for e, w in weights.items() if w >= LEAST_WEIGHT}), phrases)
    if lexicon.weights:
        seen = _heats(sample.select("toxic", "text"), "toxic int", lexicon).toPandas()  # 2 * PER_CLASS rows
        share = labelled[1] / sum(labelled.values())
        lexicon.slope, lexicon.intercept = fit_curve(seen["heat"].to_numpy(), seen["toxic"].to_numpy(), share)
    return lexicon


def _heats(rows: DataFrame, carried: str, lexicon: Lexicon) -> DataFrame:
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        matcher = lexicon.matcher()
        for frame in frames:
            out = frame.drop(columns="text")
            if "doc_id" in out:
                out = out.astype({"doc_id": "Int64"})
            out["heat"] = [heat(lexicon, matcher, text) for text in frame["text"]]
            out["score"] = lexicon.scores(out["heat"].to_numpy("f8"))
            yield out

    return rows.mapInPandas(run, f"{carried}, heat double, score double")


def toxicity_scores(docs: DataFrame, lexicon: Lexicon) -> DataFrame:
    """doc_id, held_out, score, predicted of every row."""
    ship(docs.sparkSession)
    rows = texts(docs, F.col("doc_id").cast("long").alias("doc_id"), (fold("doc_id", FOLDS) == 0).alias("held_out"))
    scored = _heats(rows, "doc_id long, held_out boolean", lexicon).drop("heat")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
