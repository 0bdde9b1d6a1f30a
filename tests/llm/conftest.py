"""Tables for the tests of the text operators: a small hand-made corpus and the given one."""

from __future__ import annotations

import random

import pytest

SF_DIR = "/root/testdata/sf0.001"
COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, node long, fingerprint string, key long, text_a string"


def prose(seed: int, n: int) -> list[str]:
    chance = random.Random(seed)
    common = ["the", "of", "and", "to", "in", "is"]
    return [
        chance.choice(common) if chance.random() < 0.3 else "".join(chance.choices("abcdefgh", k=chance.randint(4, 9)))
        for _ in range(n)
    ]


def corpus() -> list[tuple]:
    base, passage = prose(1, 120), " ".join(prose(2, 60))
    changed = base[:60] + ["changed"] + base[61:]
    texts = [
        (1, " ".join(base)),
        (2, " ".join(base).upper()),
        (3, " ".join(changed)),
        (3, " ".join(changed)),  # a repeated row
        (4, ""),
        (5, None),
        (6, "  \n\t "),
        (7, "one two"),
        (8, "One  two"),
        (9, " ".join(prose(3, 200))),
        (10, " ".join(prose(4, 70)) + "\n" + passage + " tail"),
        (11, passage + "\n\n" + " ".join(prose(5, 80))),
        (12, " ".join(["again"] * 300)),
        (13, " ".join(prose(6, 4000))),
        (14, "x" * 30000),
        (15, "Übergrößen <|endoftext|> naïve 中文 🙂  \x1c\x85 it's 12,5"),
        (16, "the of and to"),
        (None, " ".join(prose(7, 90))),
        (None, " ".join(prose(7, 90))),
        (20, " ".join(base)),
    ]
    return [(d, t, "en", "src0", None, 7, "clash", 8, "clash") for d, t in texts]


@pytest.fixture(scope="session")
def docs(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tables") / "documents")
    spark.createDataFrame(corpus(), COLUMNS).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], COLUMNS)


@pytest.fixture(scope="session")
def given(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")
