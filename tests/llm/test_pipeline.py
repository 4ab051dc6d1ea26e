"""Each stage of the pipeline on its own input, against SQL or a plain loop over its rows."""

import hashlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierflow.llm import langid, oracle, quality
from tierflow.llm.common import load, stored

SF_DIR = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Input and output rows of every stage, by name, and the input as a frame."""
    out, docs = {}, load(spark, SF_DIR, "documents")
    for name, stage in corpus_pipeline.STAGES:
        found = stored(stage(spark, docs, SF_DIR), f"test-{name}")
        out[name] = docs, docs.toPandas(), found.toPandas()
        docs = found
    return out


def told(stages, name, sql):
    """What SQL says of a stage's input."""
    con = duckdb.connect()
    con.register("documents", stages[name][1])
    con.execute(f"CREATE VIEW benchmark AS SELECT * FROM '{SF_DIR}/benchmark.parquet'")
    return con.execute(sql).df()


def test_stages(stages):
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "quality", "near_duplicates", "decontamination", "mixing"]
    for name in names[:-1]:
        _, before, after = stages[name]
        assert list(after.columns) == list(before.columns) and 0 < len(after) <= len(before)
        assert set(after["doc_id"]) <= set(before["doc_id"])
    assert 0 < len(stages["mixing"][2]) < len(stages["mixing"][1])


def test_language_id(stages):
    docs, before, after = stages["language_id"]
    labels, scores = langid.train(docs).predict(before["text"].tolist())
    kept = [i for i, label, s in zip(before["doc_id"], labels, scores, strict=True) if label != langid.UNKNOWN and s >= corpus_pipeline.LEAST_LANGUAGE]
    assert sorted(after["doc_id"]) == sorted(kept)


def test_quality(spark, stages):
    docs, before, after = stages["quality"]
    model = quality.train(quality.figures(docs), load(spark, SF_DIR, "labels"), "doc_id", "quality", F.lit(True))
    scores = model.score(np.array([quality.statistics(t) for t in before["text"]]))
    near = {i for i, s in zip(before["doc_id"], scores, strict=True) if abs(s - corpus_pipeline.LEAST_QUALITY) < 1e-9}
    kept = {i for i, s in zip(before["doc_id"], scores, strict=True) if s >= corpus_pipeline.LEAST_QUALITY}
    assert set(after["doc_id"]) - near == kept - near


def test_near_duplicates(stages):
    found = told(stages, "near_duplicates", oracle.JACCARD)
    kept = found[(found["component_id"] == found["doc_id"]) | (found["n_shingles"] == 0)]
    assert sorted(stages["near_duplicates"][2]["doc_id"]) == sorted(kept["doc_id"])


def test_decontamination(stages):
    found = told(stages, "decontamination", oracle.DECONTAMINATION)
    assert sorted(stages["decontamination"][2]["doc_id"]) == sorted(found[~found["contaminated"]]["doc_id"])


def test_mixing(stages):
    """The stage rakes until its sums meet their targets, the SQL a fixed number of rounds."""
    expected = told(stages, "mixing", oracle.ORACLE["op8_mixing"]).set_index("doc_id")
    after = stages["mixing"][2].set_index("doc_id")
    both = expected.join(after[["probability", "n_tokens", "topic"]], rsuffix="_own", how="right")
    assert (abs(both["probability"] - both["probability_own"]) < 1e-4).all()
    assert (both["n_tokens"] == both["n_tokens_own"]).all() and (both["topic"] == both["topic_own"]).all()
    draws = {i: int(hashlib.md5(str(i).encode()).hexdigest()[:8], 16) / 2**32 for i in expected.index}
    sure = [i for i, p in expected["probability"].items() if abs(draws[i] - p) > 1e-4]
    assert {i for i in sure if draws[i] < expected["probability"][i]} == set(after.index) & set(sure)
