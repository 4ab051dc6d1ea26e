"""Statistics of long texts, and scores of odd rows by a trained model."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from tierflow.llm import common, quality
from tierflow.llm.common import fold, load

SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.parametrize("block", [1, 2, 7, 64, 1000])
def test_blocks_do_not_change_statistics(monkeypatch, block):
    rnd = np.random.default_rng(1)
    words = ["a", "bb", "a", "ccc", "dé", "\u3000", "x" * 90, "\n", "\n\n", " \t", "\x0b", "one\n"]
    texts = ["", " ", "\n", "word", "w" * 300, "a a\na a\n"] + [" ".join(rnd.choice(words, rnd.integers(0, 60))) for _ in range(60)]
    whole = [quality.statistics(t) for t in texts]
    monkeypatch.setattr(quality, "BLOCK", block)
    assert [quality.statistics(t) for t in texts] == whole


def test_a_line_longer_than_a_block():
    line = "some words in a line " * 160_000
    short = dict(zip(quality.STATISTICS, quality.statistics(line), strict=True))
    n = len(line.split())
    assert short["log_line_words"] == np.log1p(n) and short["distinct_lines"] == 1 and short["log_words"] == np.log1p(n)


def test_scores_of_odd_rows(spark):
    docs, labels = load(spark, SF_DIR, "documents"), load(spark, SF_DIR, "labels")
    model = quality.train(quality.figures(docs), labels, "doc_id", "quality", fold("doc_id", 5) != 0)
    known = docs.join(labels, "doc_id").filter("quality = 1").orderBy("doc_id").first()["text"]
    rows = [(1, None), (2, ""), (3, " \n"), (4, known), (4, known), (None, known), (5, known + " "), (6, "$%&| " * 100_000), (7, "0" * 1_000_000)]
    odd = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("statistics", "y", "x", "held", "label_id")})
    found = quality.score(quality.with_statistics(odd, name="s"), model, x="s", name="p").collect()
    scores = [r["p"] for r in sorted(found, key=lambda r: (r["doc_id"] or 0, r["p"]))]
    assert len(scores) == len(rows) and all(0 <= p <= 1 for p in scores)
    assert len({r["p"] for r in found if not r["text"]}) == 1
    own = {r["p"] for r in found if r["text"] == known}
    assert len(own) == 1 and own.pop() >= 0.5


@pytest.mark.parametrize("bytes_", [64 << 20, 0])
def test_classify_learns_the_same_however_ids_are_sent(spark, monkeypatch, bytes_):
    monkeypatch.setattr(common, "BROADCAST_BYTES", bytes_)
    docs, labels = load(spark, SF_DIR, "documents"), load(spark, SF_DIR, "labels")
    scored, name = quality.classify(docs, labels)
    model = quality.train(quality.figures(docs), labels, "doc_id", "quality", F.lit(True))
    plain = quality.score(quality.figures(docs), model, name="p")
    pairs = scored.select("doc_id", F.col(name).alias("s")).join(plain.select("doc_id", "p"), "doc_id").collect()
    assert len(pairs) == docs.count() and max(abs(r["s"] - r["p"]) for r in pairs) < 1e-6
