"""What the Python steps of a task take and leave behind, in a process of their own."""

from __future__ import annotations

import os
import subprocess
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[2]

MADE = """
import random, re
import pandas as pd
import pyarrow as pa
import public_tokenizers
from trendspark.llm import exact_dedup, minhash, packing, suffixes

chance = random.Random(4)
vocabulary = ["".join(chance.choices("abcdefghijklmnopqrstuvwxyz", k=chance.randint(2, 10))) for _ in range(40_000)]
texts = [" ".join(chance.choices(vocabulary, k=400)) for _ in range(2500)]
frame = pd.DataFrame({"node": range(len(texts)), "text": texts})


def held():
    with open("/proc/self/smaps_rollup") as told:
        return sum(map(int, re.findall("\\nPss_(?:Anon|Shmem): +([0-9]+)", told.read()))) / 1024


def batch():
    rows = pa.array(range(len(texts)), pa.int64())
    return pa.RecordBatch.from_pydict({"row": rows, "doc_id": rows, "node": rows, "text": pa.array(texts)})


def use(step):
    for _ in step:
        pass
"""


def told(code: str) -> float:
    env = os.environ | {"PYTHONPATH": f"{ROOT}:{os.environ.get('PYTHONPATH', '')}", "OMP_NUM_THREADS": "1"}
    run = subprocess.run([sys.executable, "-c", MADE + code], env=env, capture_output=True, text=True, timeout=120)
    assert run.returncode == 0, run.stderr
    return float(run.stdout)


@pytest.mark.parametrize(
    "step",
    [
        "suffixes._keys(iter([frame] * 2))",
        "exact_dedup._bytes(iter([batch()] * 2))",
        "packing.tokenise(public_tokenizers.path('word_bpe_49k.json'), 2)(iter([batch()]))",
    ],
)
@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
def test_a_worker_gives_its_memory_back(step):
    """A second task of the step, and what it leaves free, beside what the first one has to keep (tokenizer, words seen)."""
    code = f"""
use({step})
import ctypes
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
before = held()
use({step})
print(held() - before)
"""
    assert told(code) < 15


def test_words_of_a_large_batch_are_split_a_part_at_a_time():
    """Arrow holds the split words of a part, not of all 7 MB."""
    assert told("use(suffixes._keys(iter([frame])))\nprint(pa.default_memory_pool().max_memory() / 2**20)") < 20


@pytest.mark.skipif(not Path("/proc/self/smaps_rollup").exists(), reason="memory is read from /proc")
def test_a_counting_worker_gives_its_memory_back():
    """What a second task of the token counts leaves beside what the first one has to keep (the tokenizer)."""
    code = """
import ctypes
from trendspark.llm import token_counts

path = public_tokenizers.path("byte_bpe_50k.json")
rows = pa.RecordBatch.from_pydict({"digest": pa.array([b"%d" % i for i in range(len(texts))]), "text": pa.array(texts)})
use(token_counts.encode_counts(path)(iter([rows])))
pa.default_memory_pool().release_unused()
ctypes.CDLL(None).malloc_trim(0)
before = held()
use(token_counts.encode_counts(path)(iter([rows] * 2)))
print(held() - before)
"""
    assert told(code) < 15
