"""Language identification by error-correcting output codes.

Every language has a codeword of bits. One logistic classifier over hashed byte n-grams (two and
three bytes) learns each bit. A text goes to the codeword with the smallest logistic loss summed over
its bits; where the runner-up is close, the result is flagged as ambiguous.

The fit uses at most ``PER_LANGUAGE`` texts of each language (those with the smallest hashes
of doc_id), whatever the size of the corpus; predictions cover every row and whole texts.

Defined cases: null texts and texts without a letter give ``und`` with score 0; rows
without a language are not learnt from; without any language every row is ``und``; with a
single one every text with a letter is that; repeated rows give repeated results; other
columns are ignored.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import batches, fold, ship

PER_LANGUAGE = 800
GRAM_BITS = 12
FOLDS, HELD_OUT = 3, 1
CLOSE = 0.2
UNKNOWN = "und"

_LETTER = re.compile(r"[^\W\d_]")
#: ASCII bytes that are no letters become blanks.
_BLANK = bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256))


def grams(text: str) -> np.ndarray:
    """Damped counts of the hashed byte pairs and triples of the lower-cased text, scaled to length one."""
    raw = np.frombuffer(b" ".join([b"", *text.lower().encode("utf-8", "replace").translate(_BLANK).split(), b""]), "u1")
    x = raw.astype("u4")
    shift = np.uint32(32 - GRAM_BITS)
    counts = np.zeros(1 << GRAM_BITS, "f4")
    for n in (2, 3):
        if len(x) >= n:
            code = x[: len(x) - n + 1].copy()
            for i in range(1, n):
                code = (code << np.uint32(8)) | x[i : len(x) - n + 1 + i]
            code = (code + np.uint32(n)) * np.uint32(2654435761)
            counts += np.bincount(code >> shift, minlength=1 << GRAM_BITS)
    counts = np.sqrt(counts)
    length = float(np.linalg.norm(counts))
    return counts / length if length else counts


def codewords(classes: int) -> np.ndarray:
    """One row of +1/-1 for each class: all splits into two sides for few classes, seeded random ones for more."""
    if classes <= 1:
        return np.ones((classes, 0))
    if classes <= 7:
        sides = [x for x in itertools.product((1, -1), repeat=classes) if x[0] == 1 and -1 in x]
        return np.array(sides, "f8").T
    chance = np.random.default_rng(classes)
    wanted, best, apart = int(np.ceil(15 * np.log2(classes))), None, -1
    for _ in range(50):
        code = chance.choice([-1.0, 1.0], size=(classes, wanted))
        least = min(int((code[i] != code[j]).sum()) for i, j in itertools.combinations(range(classes), 2))
        if least > apart and (abs(code.sum(axis=0)) < classes).all():
            best, apart = code, least
    return best


class Codes:
    """Languages, their codewords and the bits' weights (one column for each bit, the last row a constant)."""

    def __init__(self, languages: list[str], code: np.ndarray, weights: np.ndarray):
        self.languages, self.code, self.weights = languages, code, weights

    def decode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Index of the nearest codeword, its score, and how far ahead of the next it is (0 to 1)."""
        margins = x @ self.weights[:-1] + self.weights[-1]
        losses = np.logaddexp(0, -margins[:, None, :] * self.code[None]).sum(axis=2)
        likely = np.exp(losses.min(axis=1, keepdims=True) - losses)
        likely /= likely.sum(axis=1, keepdims=True)
        ordered = np.sort(likely, axis=1)
        ahead = ordered[:, -1] - (ordered[:, -2] if likely.shape[1] > 1 else 0.0)
        return losses.argmin(axis=1), ordered[:, -1], ahead


def fit(x: np.ndarray, y: list[str], steps: int = 300, penalty: float = 1e-5) -> Codes:
    """A logistic classifier for each bit, classes weighted alike, by gradient steps with momentum."""
    languages = sorted(set(y))
    code = codewords(len(languages))
    number = np.array([languages.index(v) for v in y], "i8")
    weights = np.zeros((x.shape[1] + 1, code.shape[1]))
    if len(languages) < 2:
        return Codes(languages, code, weights)
    target = code[number]
    share = 1.0 / (np.bincount(number)[number] * len(languages))
    x = np.concatenate([x, np.ones((len(x), 1), "f4")], axis=1)
    speed, rate = np.zeros_like(weights), 8.0
    for _ in range(steps):
        ahead = weights + 0.9 * speed
        miss = target / (1 + np.exp(np.clip(target * (x @ ahead), -500, 500))) * share[:, None]
        speed = 0.9 * speed + rate * (x.T @ miss.astype("f4") - penalty * ahead)
        weights += speed
    return Codes(languages, code, weights)


def train(docs: DataFrame) -> Codes:
    """Fit on rows with a language and a text with letters, outside the held-out fold."""
    ship(docs.sparkSession)
    named = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).filter(
        fold("doc_id", FOLDS) != HELD_OUT
    )
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    first = Window.partitionBy("lang").orderBy(*order)  # cut to the first rows before the shuffle
    ids = named.select("doc_id", "lang").withColumn("rank", F.row_number().over(first))
    chosen = ids.filter(F.col("rank") <= PER_LANGUAGE).select(F.col("doc_id").alias("chosen")).distinct()
    # PER_LANGUAGE ids for each language
    sample = named.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen")).select("doc_id", "lang", "text")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, "text", 1 << 20):
            frame = frame[[bool(_LETTER.search(x)) for x in frame["text"]]]
            yield pd.DataFrame(
                {
                    "doc_id": frame["doc_id"].array,
                    "lang": frame["lang"].array,
                    "x": [grams(x).astype("f2").tobytes() for x in frame["text"]],
                }
            )

    found = sample.mapInPandas(run, "doc_id long, lang string, x binary").toPandas()
    found = found.sort_values(["doc_id", "lang"], kind="stable")
    x = np.frombuffer(b"".join(found["x"]), "f2").reshape(-1, 1 << GRAM_BITS).astype("f4")
    return fit(x, found["lang"].tolist())


def predict(docs: DataFrame, codes: Codes) -> DataFrame:
    """doc_id, held_out, lang_pred, score, ambiguous of every row."""
    ship(docs.sparkSession)

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches(frames, "text", 1 << 22):
            out = frame[["doc_id", "held_out"]].astype({"doc_id": "Int64"}).reset_index(drop=True)
            said = np.array([bool(_LETTER.search(x)) for x in frame["text"]], bool) & bool(codes.languages)
            names, scores, ahead = np.full(len(frame), UNKNOWN, object), np.zeros(len(frame)), np.zeros(len(frame))
            found = [grams(text) for text, ok in zip(frame["text"], said, strict=True) if ok]
            if found:
                best, scores[said], ahead[said] = codes.decode(np.array(found))
                names[said] = np.array(codes.languages, object)[best]
            out["lang_pred"], out["score"], out["ambiguous"] = names, scores, ahead < CLOSE
            yield out

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (fold("doc_id", FOLDS) == HELD_OUT).alias("held_out"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    schema = "doc_id long, held_out boolean, lang_pred string, score double, ambiguous boolean"
    return rows.mapInPandas(run, schema)
