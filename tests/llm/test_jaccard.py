"""Shingling of whole batches, against a loop over words, and what very frequent shingles cost."""

import random
import time
from types import SimpleNamespace

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import types as T

from tests.llm.test_cases import brute_components, docs_of
from tierflow.llm import jaccard

ODD = [None, "", " \t\n", "a", "A b", "a b\x0bc\x0cd\re", " x É é　y\x1c\x85 z ", "\x00 \x00", "a b a b a b a b a b a b", "p q r s t", "T S"]


def by_loop(text, words):
    found = (text or "").encode().lower().split()
    if not found:
        return 0, []
    signed = lambda h: h - (1 << 64) if h >= 1 << 63 else h
    sets, width = set(), min(words, len(found))
    for i in range(len(found) - width + 1):
        h = width
        for w in found[i : i + width]:
            h = (h * 0x9E3779B97F4A7C15 + xxhash.xxh3_64_intdigest(w)) % (1 << 64)
        h = (h ^ h >> 31) * 0xBF58476D1CE4E5B9 % (1 << 64)
        sets.add(signed(h ^ h >> 29))
    return signed(xxhash.xxh3_64_intdigest(b" ".join(found))), sorted(sets)


@pytest.mark.parametrize("kind", [pa.string(), pa.large_string()])
@pytest.mark.parametrize("words", [1, 3, 5])
def test_sets_of_a_batch(words, kind):
    rng = random.Random(words)
    texts = ODD + ["".join(rng.choice("aAbB  \t\n\r\x0b\x1f\u0085É") for _ in range(rng.randrange(60))) for _ in range(200)]
    for some in (texts, texts[:3], []):
        fps, sizes, flat = jaccard.shingle_sets(pa.array(["cut off", *some], kind)[1:], words)
        expected = [by_loop(t, words) for t in some]
        assert fps.tolist() == [fp for fp, _ in expected]
        assert sizes.tolist() == [len(s) for _, s in expected]
        assert flat.tolist() == [h for _, s in expected for h in s]


def test_components_where_all_shingles_are_very_frequent(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "SAMPLE", 1)
    monkeypatch.setattr(jaccard, "HOT_TEXTS", 2)
    rng = random.Random(8)
    rows = list(enumerate(ODD))
    for k in range(8):
        base = [f"v{rng.randrange(4000)}" for _ in range(rng.choice([4, 30, 90]))]
        for c in range(6):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9)}"
            rows.append((100 + 20 * k + c, " ".join(copy)))
    docs = docs_of(spark, rows)
    found = jaccard.near_duplicates(docs).collect()
    assert sorted((r["id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in found) == brute_components(rows)


def cpu_seconds(texts, hot):
    # What a task runs, without Spark.
    rows = SimpleNamespace(schema=T.StructType([T.StructField("id", T.LongType())]), mapInArrow=lambda emit, schema: emit)
    emit = jaccard._members(rows, 5, 80, 100, hot)
    ids = pa.array(range(len(texts)))
    batch = pa.RecordBatch.from_arrays([ids, ids, pa.array(texts)], names=["id", "raw", "text"])
    began = time.process_time()
    (made,) = emit(iter([batch]))
    return time.process_time() - began, made


def test_many_very_frequent_shingles_cost_a_text_no_more_than_few():
    texts = [" ".join(f"w{(i * 31 + j) % 5000}" for j in range(60)) for i in range(1500)]
    shingles = np.unique(jaccard.shingle_sets(pa.array(texts), 5)[2]).tolist()
    few = dict.fromkeys(shingles[:8], 9)
    many = few | {h: 9 for h in range(jaccard.HOT_SHINGLES - 8)}
    cpu_seconds(texts, few)
    (short, by_few), (long, by_many) = cpu_seconds(texts, few), cpu_seconds(texts, many)
    assert by_many == by_few and sum(by_few.column("n_hot").to_pylist()) > 0
    assert long < 5 * short + 0.5
