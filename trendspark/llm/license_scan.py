"""License scan: TF-IDF cosine of lines to templates, then inheritance by directory.

A statement is a line of a file, or a run of as many words as a template has, from any word on and
across line ends. The sparse TF-IDF vector of a line is compared with those of the one-line ``TEMPLATES``, that of a
run with its template, be it such a line, a header or a license's text (``PASSAGES``); a run must reach ``RUN_LEAST``,
since it holds no words beside the template's. A file's own license is that of its best statement. A file without one takes the license of the licence file in
the nearest directory above it, by a join on directory paths.

Document frequencies of all words are counted over all files. Those of the ``COMMON`` most frequent words go to
every task; any other word is in no more files than the least of these, which bounds its weight from below. Lines
that cannot reach the wanted cosine under that bound are left out at once; the remaining ones that hold such
words are joined with the table of frequencies and get their exact cosine there.

Defined cases: null and empty texts have no license of their own and may inherit one; a null path stands for
a file in the root; ties go to the template's name, then to the licence file's path; repeated rows
give repeated results; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import chain, repeat

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

THRESHOLD = 0.6
#: Wanted cosine of a run of words.
RUN_LEAST = 0.8
#: Words whose frequencies every task holds, and words counted at once in a task.
COMMON, TASK_TERMS = 50_000, 500_000
UNSURE = "unsure array<struct<name string, dot double, held double, least double, missing array<struct<term string, n long>>>>"
LICENSE_FILES = r"(?i)^(licen[cs]e|copying|notice|unlicense)([-_. ].*)?$"

#: Usual statements of licenses.
TEMPLATES = {
    "Apache-2.0": "Licensed under the Apache License, Version 2.0.",
    "BSD-3-Clause": "Released under the BSD 3-Clause License.",
    "CC-BY-4.0": "Licensed under CC BY 4.0.",
    "CC-BY-NC-4.0": "Licensed under CC BY-NC 4.0.",
    "CC-BY-SA-4.0": "Licensed under CC BY-SA 4.0.",
    "CC0-1.0": "Dedicated to the public domain under CC0 1.0.",
    "GPL-3.0": "This work is licensed under the GNU General Public License, version 3.",
    "LGPL-2.1": "This work is licensed under the GNU Lesser General Public License, version 2.1.",
    "MIT": "Released under the MIT License.",
    "MPL-2.0": "Subject to the terms of the Mozilla Public License, Version 2.0.",
    "proprietary": "All rights reserved.",
}

_GNU = (
    "This {what} is free software: you can redistribute it and/or modify it under the terms of the GNU {kind}General "
    "Public License as published by the Free Software Foundation, either version {n} of the License, or (at your "
    "option) any later version."
)
_GNU_TITLE = (
    "GNU {kind}GENERAL PUBLIC LICENSE Version {n}, {date} Everyone is permitted to copy and distribute verbatim copies "
    "of this license document, but changing it is not allowed."
)
_BSD_START = (
    "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the "
    "following conditions are met: 1. Redistributions of source code must retain the above copyright notice, this list "
    "of conditions and the following disclaimer. 2. Redistributions in binary form must reproduce the above copyright "
    "notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided "
    "with the distribution. "
)
_BSD_THIRD = (
    "3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission. "
)
_BSD_END = (
    "THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS \"AS IS\" AND ANY EXPRESS OR IMPLIED "
    "WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR "
    "PURPOSE ARE DISCLAIMED."
)

#: Headers of files and texts of licenses; of a long one the words that it opens with.
PASSAGES = [
    (
        "Apache-2.0",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance '
        "with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ),
    (
        "Apache-2.0",
        "Apache License Version 2.0, January 2004 http://www.apache.org/licenses/ TERMS AND CONDITIONS FOR USE, "
        "REPRODUCTION, AND DISTRIBUTION 1. Definitions.",
    ),
    ("BSD-2-Clause", _BSD_START + _BSD_END),
    ("BSD-3-Clause", _BSD_START + _BSD_THIRD + _BSD_END),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    (
        "CC0-1.0",
        "Creative Commons Legal Code CC0 1.0 Universal CREATIVE COMMONS CORPORATION IS NOT A LAW FIRM AND DOES NOT "
        "PROVIDE LEGAL SERVICES.",
    ),
    ("CC-BY-4.0", "This work is licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("AGPL-3.0", _GNU.format(what="program", kind="Affero ", n=3)),
    ("AGPL-3.0", _GNU_TITLE.format(kind="AFFERO ", n=3, date="19 November 2007")),
    ("GPL-2.0", _GNU.format(what="program", kind="", n=2)),
    ("GPL-2.0", _GNU_TITLE.format(kind="", n=2, date="June 1991")),
    ("GPL-3.0", _GNU.format(what="program", kind="", n=3)),
    ("GPL-3.0", _GNU_TITLE.format(kind="", n=3, date="29 June 2007")),
    ("LGPL-2.1", _GNU.format(what="library", kind="Lesser ", n="2.1")),
    ("LGPL-2.1", _GNU_TITLE.format(kind="LESSER ", n="2.1", date="February 1999")),
    ("LGPL-3.0", _GNU.format(what="library", kind="Lesser ", n=3)),
    ("LGPL-3.0", _GNU_TITLE.format(kind="LESSER ", n=3, date="29 June 2007")),
    (
        "MIT",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
        'documentation files (the "Software"), to deal in the Software without restriction, including without limitation '
        "the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, "
        "and to permit persons to whom the Software is furnished to do so, subject to the following conditions: The "
        "above copyright notice and this permission notice shall be included in all copies or substantial portions of "
        'the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT '
        "NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT.",
    ),
    (
        "MPL-2.0",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was "
        "not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ),
    ("MPL-2.0", 'Mozilla Public License Version 2.0 1. Definitions 1.1. "Contributor" means each individual or legal entity'),
]

_TERM = re.compile(r"[a-z0-9]+(?:[.-][a-z0-9]+)*")


def terms(line: str) -> list[str]:
    return _TERM.findall(line.lower())


class Matcher:
    """Template vectors under given document frequencies (of ``files`` files).

    A word that ``frequencies`` does not hold is in ``rare`` files at most.
    """

    def __init__(
        self, templates: dict[str, str], frequencies: dict[str, int], files: int, least: float, rare: int = 0
    ):
        self.least, self.rare = least, rare
        self.names = sorted(templates)
        wanted = {w for x in templates.values() for w in terms(x)}
        self.squares = {w: weight(n, files) ** 2 for w, n in frequencies.items()}
        self.low = weight(rare, files) ** 2  # of a word that is not held, at least
        self.weights = {w: weight(frequencies.get(w, 0), files) for w in wanted}
        self.postings: dict[str, list[tuple[int, float]]] = {}
        for at, name in enumerate(self.names):
            found = {w: n * self.weights[w] for w, n in Counter(terms(templates[name])).items()}
            length = math.sqrt(sum(v * v for v in found.values()))
            for w, v in found.items():
                self.postings.setdefault(w, []).append((at, v / length))

    def bounded(self, words: list[str]) -> tuple[float, str, float, float, dict[str, int]] | None:
        """The best cosine at most and its template, dot product, squared length, and the words to be added to that."""
        counts = Counter(words)
        known = {w: n * self.weights[w] for w, n in counts.items() if w in self.weights}
        if not known:
            return None
        inside = sum(v * v for v in known.values())
        other = {w: n for w, n in counts.items() if w not in self.weights}
        whole = inside + sum(n * n * self.squares.get(w, self.low) for w, n in other.items())
        if inside < self.least**2 * whole:  # the cosine is at most sqrt(inside / whole)
            return None
        dots = np.zeros(len(self.names))
        for w, v in known.items():
            for at, x in self.postings[w]:
                dots[at] += v * x
        best = int(dots.argmax())
        cosine = float(dots[best]) / math.sqrt(whole)
        if cosine < self.least:
            return None
        missing = {w: n for w, n in other.items() if w not in self.squares} if self.rare else {}
        held = whole - self.low * sum(n * n for n in missing.values())
        return min(1.0, cosine), self.names[best], float(dots[best]), held, missing

    def score(self, line: str) -> tuple[float, str] | None:
        """The best cosine of at least ``least`` and its template; at most that if words are not held."""
        found = self.bounded(terms(line))
        return found[:2] if found else None

    def best(self, text: str, runs: Runs) -> tuple[float | None, str | None, list[dict]]:
        """Score and template of the best statement whose words are all held, and others that might be better."""
        found, top, name = {}, 0.0, None
        lines = filter(None, (self.bounded(terms(x)) for x in text.splitlines()))
        for one, least in chain(zip(lines, repeat(self.least)), zip(runs.found(text), repeat(RUN_LEAST))):
            if one[4]:
                found[one[1:4], least, tuple(sorted(one[4].items()))] = one, least
            elif name is None or (-one[0], one[1]) < (-top, name):
                top, name = one[:2]
        unsure = [
            {
                "name": x[1], "dot": x[2], "held": x[3], "least": y,
                "missing": [{"term": w, "n": n} for w, n in x[4].items()],
            }
            for x, y in found.values()
            if x[0] >= top
        ]
        return (top if name else None), name, unsure


class Runs:
    """Runs of words that are like a template of as many words, under the frequencies of a ``Matcher``."""

    def __init__(self, templates: list[tuple[str, str]], frequencies: dict[str, int], files: int, rare: int = 0):
        self.low = weight(rare, files) ** 2
        self.held, self.rare = frequencies, rare
        self.ids = {w: i for i, w in enumerate(sorted({w for _, x in templates for w in terms(x)}))}
        weights = np.array([weight(frequencies.get(w, 0), files) for w in self.ids] or [0.0])
        self.weights, self.files = weights, files
        self.templates = []
        for name, text in templates:
            vector = np.bincount([self.ids[w] for w in terms(text)], minlength=len(weights)) * weights
            self.templates.append((name, len(terms(text)), vector / np.sqrt((vector**2).sum())))

    def found(self, text: str) -> Iterator[tuple[float, str, float, float, dict[str, int]]]:
        """The cosine at most, template, dot product, squared length and unheld words of every run with ``RUN_LEAST``."""
        words = terms(text)
        at = np.fromiter((self.ids.get(w, -1) for w in words), "i8", len(words))
        if not (at >= 0).any():
            return
        # Words of no template add this to the squared length at least; a word said twice adds more.
        squares = np.where(at >= 0, self.weights[at] ** 2, 1.0)
        lengths = np.concatenate([[0.0], np.cumsum(squares)])
        seen = set()
        for number, (name, n, vector) in enumerate(self.templates):
            if len(words) < n:
                continue
            gains = np.concatenate([[0.0], np.cumsum(np.where(at >= 0, self.weights[at] * vector[at], 0.0))])
            dots, least = gains[n:] - gains[:-n], lengths[n:] - lengths[:-n]
            for start in np.flatnonzero(dots >= (RUN_LEAST - 1e-6) * np.sqrt(np.maximum(least, 0))).tolist():
                run = words[start : start + n]
                if (number, *run) not in seen:
                    seen.add((number, *run))
                    one = self.cosine(run, name, vector)
                    if one[0] >= RUN_LEAST:
                        yield one

    def cosine(self, run: list[str], name: str, vector: np.ndarray) -> tuple[float, str, float, float, dict[str, int]]:
        dot = held = below = 0.0
        missing = {}
        for w, n in sorted(Counter(run).items()):
            if w in self.ids:
                v = n * self.weights[self.ids[w]]
                dot += v * vector[self.ids[w]]
                held += v * v
            elif w in self.held or not self.rare:
                held += (n * weight(self.held.get(w, 0), self.files)) ** 2
            else:
                missing[w] = n
                below += n * n * self.low
        return (min(1.0, float(dot / math.sqrt(held + below))), name, float(dot), float(held), missing)


def weight(n: int, files: int) -> float:
    """Inverse document frequency of a word that ``n`` of ``files`` files hold."""
    return 1 + math.log((1 + files) / (1 + n))


def frequencies(files: DataFrame) -> DataFrame:
    """term, n: in how many files each word occurs; the empty term has the number of files."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        counts: Counter[str] = Counter()

        def flush() -> pd.DataFrame:
            return pd.DataFrame({"term": list(counts), "n": list(counts.values())}).astype({"n": "i8", "term": object})

        for frame in frames:
            for text in frame["text"]:
                counts.update(set(terms(text)))
                if len(counts) >= TASK_TERMS:
                    yield flush()
                    counts.clear()
            counts[""] += len(frame)
        yield flush()

    found = files.select(F.coalesce("text", F.lit("")).alias("text")).mapInPandas(run, "term string, n long")
    return found.groupBy("term").agg(F.sum("n").alias("n"))


def directory(path: Column) -> Column:
    """The path up to its last slash, without it; empty for the root."""
    return F.regexp_replace(F.coalesce(path, F.lit("")), r"/?[^/]*$", "")


def _settled(first: DataFrame, words: DataFrame, total: int) -> DataFrame:
    """The rows of ``first`` with the best of their statements, those with uncommon words at their exact cosine."""
    open_ = first.filter(F.size("unsure") > 0).dropDuplicates(["key"])
    each = open_.select("key", F.posexplode("unsure").alias("at", "u"))
    terms_ = each.select("key", "at", "u.name", "u.dot", "u.held", "u.least", F.explode("u.missing").alias("m"))
    idf = 1 + F.log((1 + F.lit(total)) / (1 + F.col("files")))
    counted = words.select("term", F.col("n").alias("files"))
    weighed = terms_.select("*", "m.term", F.col("m.n").alias("times")).join(counted, "term")
    cosines = weighed.groupBy("key", "at").agg(
        F.first("name").alias("name"),
        F.first("least").alias("least"),
        F.least(F.lit(1.0), F.first("dot") / F.sqrt(F.first("held") + F.sum((F.col("times") * idf) ** 2))).alias("score"),
    )
    late = (
        cosines.filter("score >= least")
        .groupBy("key")
        .agg(F.min(F.struct(F.negative("score").alias("low"), "name")).alias("late"))
    )
    mine = F.when(F.col("score").isNotNull(), F.struct(F.negative("score").alias("low"), F.col("own_license").alias("name")))
    best = F.least(mine, F.col("late"))  # nulls are passed over
    joined = first.join(late, "key", "left").withColumn("best", best)
    return joined.select("doc_id", "path", F.negative("best.low").alias("score"), F.col("best.name").alias("own_license"), "dir")


def scan(
    files: DataFrame,
    templates: dict[str, str] = TEMPLATES,
    least: float = THRESHOLD,
    passages: list[tuple[str, str]] = PASSAGES,
) -> DataFrame:
    """doc_id, path, own_license, score, license, license_path of every row of ``files`` (doc_id, path, text).

    ``license`` is the file's own or the inherited one, ``license_path`` says where the latter stands.
    """
    ship(files.sparkSession)
    table = stored(frequencies(files), "frequencies")
    total = (table.filter("term = ''").first() or {"n": 0})["n"]
    words = table.filter("term <> ''")
    common = {r["term"]: r["n"] for r in words.orderBy(F.desc("n"), "term").limit(COMMON).collect()}
    all_ = [*templates.items(), *passages]
    wanted = sorted({w for _, x in all_ for w in terms(x)})
    rare = min(common.values()) if len(common) >= COMMON else 0
    counted = common | {r["term"]: r["n"] for r in words.filter(F.col("term").isin(wanted)).collect()}

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        match, runs = Matcher(templates, counted, total, least, rare), Runs(all_, counted, total, rare)
        for frame in frames:
            out = frame[["key", "doc_id", "path"]].astype({"doc_id": "Int64"})
            best = [match.best(text, runs) for text in frame["text"]]
            out["score"] = pd.array([x for x, _, _ in best], "Float64")
            out["own_license"] = [x for _, x, _ in best]
            out["unsure"] = [x for _, _, x in best]
            yield out

    rows = files.select(F.col("doc_id").cast("long").alias("doc_id"), "path", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("key", F.xxhash64("doc_id", "path", "text"))
    schema = "key long, doc_id long, path string, score double, own_license string, " + UNSURE
    first = stored(rows.mapInPandas(run, schema).withColumn("dir", directory(F.col("path"))), "first")
    own = first.drop("key", "unsure")
    if rare:
        own = stored(_settled(first, words, total), "own")

    named = own.filter(F.regexp_extract("path", r"[^/]*$", 0).rlike(LICENSE_FILES) & F.col("own_license").isNotNull())
    of_dir = named.groupBy(F.col("dir").alias("above")).agg(
        F.min(F.struct(F.negative("score").alias("low"), "own_license", "path")).alias("best")
    )
    # Each directory with those above it, down to the root; directories are far fewer than files.
    parts = F.split("dir", "/")
    depth = F.when(F.col("dir") == "", 0).otherwise(F.size(parts))
    above = F.transform(F.sequence(F.lit(0), depth), lambda n: F.struct(n.alias("n"), F.array_join(F.slice(parts, 1, n), "/").alias("above")))
    lines = own.select("dir").distinct().select("dir", F.explode(above).alias("up")).select("dir", "up.n", "up.above")
    nearest = (
        lines.join(of_dir, "above")
        .groupBy("dir")
        .agg(F.max(F.struct("n", "best.own_license", "best.path")).alias("near"))
        .select("dir", F.col("near.own_license").alias("near_license"), F.col("near.path").alias("near_path"))
    )
    joined = own.join(stored(nearest, "nearest"), "dir", "left")
    mine = F.col("own_license").isNotNull()
    return joined.select(
        "doc_id",
        "path",
        "own_license",
        "score",
        F.coalesce("own_license", "near_license").alias("license"),
        F.when(mine, F.col("path")).otherwise(F.col("near_path")).alias("license_path"),
    )
