"""Any number of languages, fitted in groups and scored from sparse weights."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import langid
from tierflow.llm.common import fold


def texts(spark, n_languages, per_language=40):
    """Languages that share an alphabet and differ in how often they use its letters."""
    rnd = np.random.default_rng(7)
    rows = []
    for y in range(n_languages):
        weights = rnd.dirichlet(np.full(26, 0.4))
        for i in range(per_language):
            letters = rnd.choice(26, size=400, p=weights)
            text = "".join(chr(97 + c) + (" " if j % 6 == 5 else "") for j, c in enumerate(letters))
            rows.append((y * per_language + i, text, f"l{y:03d}"))
    return spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(4)


@pytest.mark.parametrize("group", [128, 3])
def test_no_language_is_left_out(spark, monkeypatch, group):
    monkeypatch.setattr(langid, "GROUP", group)
    docs = texts(spark, 10)
    model = langid.train(docs, where=fold("doc_id", 5) != 0)
    assert model.languages == tuple(f"l{y:03d}" for y in range(10))
    found = langid.identify(docs.filter(fold("doc_id", 5) == 0), model).select("lang", "lang_pred", "score").collect()
    assert {r["lang"] for r in found} == {r["lang_pred"] for r in found} == set(model.languages)
    assert np.mean([r["lang"] == r["lang_pred"] for r in found]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in found)


def test_sparse_and_dense_scores_agree(spark, monkeypatch):
    docs = texts(spark, 6, 20)
    model = langid.train(docs)
    some = [r["text"] for r in docs.limit(15).collect()] + [None, "", "12", "a" * 300_000]
    dense = model.predict(some)
    monkeypatch.setattr(langid, "DENSE", 0)
    monkeypatch.setattr(langid, "SCORES", 13)
    sparse = langid.Model(model.languages, model.weights, model.bias, model.temperature)
    assert sparse.dense is None and len(sparse.slices(len(some))) > 5
    assert sparse.predict(some)[0] == dense[0] and np.allclose(sparse.predict(some)[1], dense[1], atol=1e-4)


def test_many_languages_of_few_texts(spark):
    docs = texts(spark, 150, 2)
    model = langid.train(docs)
    assert len(model.languages) == 150 and model.weights.classes.max() == 149
    assert langid.identify(docs, model).filter(F.col("lang") == F.col("lang_pred")).count() > 150
