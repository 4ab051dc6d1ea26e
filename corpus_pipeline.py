"""From raw documents to a training mix: language, quality, duplicates, benchmarks, shares.

Each stage takes (spark, docs, sf_dir) and works on all rows its predecessor kept. All but
the last return the columns of `documents`; the last adds topic, tokens and the probability
with which a document was sampled, and keeps the sampled ones.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tierflow.llm import decontam, jaccard, langid, mixing, quality
from tierflow.llm.common import fresh, load, stored

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]

# Documents whose language is unknown or less likely than this are rejected.
LEAST_LANGUAGE = 0.5
# Documents of a lower quality score are rejected.
LEAST_QUALITY = 0.3


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents without letters and those no language is likely for."""
    pred, score = fresh(docs.columns, "lang_pred"), fresh(docs.columns, "lang_score")
    found = langid.identify(docs, langid.train(docs), pred=pred, score=score)
    return found.filter((F.col(pred) != langid.UNKNOWN) & (F.col(score) >= LEAST_LANGUAGE)).select(docs.columns)


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents of low quality."""
    found, score = quality.classify(docs, load(spark, sf_dir, "labels"))
    return found.filter(F.col(score) >= LEAST_QUALITY).select(docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the document with the least id of each group of near copies."""
    return jaccard.one_per_group(docs)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a passage of a benchmark."""
    return decontam.clean(docs, load(spark, sf_dir, "benchmark"))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Samples documents so that sources, languages and topics meet their target shares."""
    mixed = mixing.mix(docs)
    return mixed.filter(mixed.columns[-1])


STAGES: list[tuple[str, Stage]] = [
    ("language_id", identify_language),
    ("quality", classify_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_to_targets),
]

# Classifiers are trained on the way, which SQL cannot express.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over `documents`, each stored and read again by the next."""
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
