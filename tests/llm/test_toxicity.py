"""Scores of odd rows by a trained machine."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import toxicity

PLAIN = "table window garden morning letter bottle village river market paper winter summer forest animal".split()
INSULTS = ["blorgath", "vexnurt", "quimzod", "snarfblatterwickenzungelhoffgrummelbatz"]


@pytest.fixture(scope="module")
def model(spark):
    rnd = np.random.default_rng(1)
    rows = []
    for i in range(900):
        words = list(rnd.choice(PLAIN, rnd.integers(4, 30)))
        toxic = i % 3 == 0
        if toxic:
            words.insert(int(rnd.integers(0, len(words))), INSULTS[(i // 3) % len(INSULTS)])
        rows.append((i, " ".join(words), int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    return toxicity.train(docs.drop("toxic"), docs.drop("text"))


def scores(spark, model, texts):
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").withColumns({c: F.lit(1) for c in ("y", "t", "word", "raw", "n")})
    found = {r["doc_id"]: r["s"] for r in toxicity.score(rows.repartition(3), model, name="s").collect()}
    return [found[i] for i in range(len(texts))]


def test_insults_are_found_gapped_and_cut(spark, model):
    plain = " ".join(PLAIN)
    texts = [f"{plain} {w}" for w in ("blorgath", "BLORGATH", "vex.nurt", "q*u*i*m*z*o*d", "b l o r g a t h", "xblorgathx", INSULTS[3])]
    texts += ["garden " * 50_000 + "quimzod", "quimzod " + "garden " * 50_000]
    found = scores(spark, model, texts + [plain, plain[::-1]])
    assert min(found[:-2]) >= 0.7 and max(found[-2:]) < 0.7


def test_odd_texts(spark, model):
    empty, other = scores(spark, model, [None, "", " \n\t", "a", "ab", "12 34"]), scores(spark, model, [" ".join(PLAIN)] * 2)
    assert empty[0] == empty[1] == empty[2] <= min(empty + other) + 1e-12
    assert other[0] == other[1] and all(0 <= s < 0.5 for s in empty + other)
    long = scores(spark, model, ["x" * 200_000, "blorgath" * 3, "\U0001f600" * 90])
    assert all(0 <= s <= 1 for s in long) and long[1] >= 0.7


def test_pieces_share_a_word():
    word = "abcdefgh" * 10
    cut = toxicity._in_pieces({"short": 2.0, word: 3.0, word[: toxicity.PIECE]: 1.0})
    assert cut["short"] == 2.0 and sum(cut.values()) == pytest.approx(6.0)
    assert set(cut) == {"short", *toxicity._pieces(word)} and max(map(len, cut)) <= toxicity.PIECE
