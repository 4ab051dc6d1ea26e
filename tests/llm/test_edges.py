"""Empty tables, columns whose names clash with the operators' own, joins without broadcast,
and copies that make up most of a table."""

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.oracle_check import rows_of_duck, rows_of_spark
from tierflow.llm import common, decontam, html_text, jaccard, langid, mixing, quality, tokens, topk, toxicity, warc
from tierflow.llm.common import load
from tierflow.llm.oracle import ORACLE
from tierflow.llm.queries import QUERIES
from tierflow.session import shared_dir

SF_DIR = "/root/testdata/sf0.01"
# Names that the operators use inside, beside the tables' own.
CLASHES = (
    "id raw fp n h c v a b key words word pos window w items item hit skipped tokens topic probability sampled score y t u "
    "label_id statistics lang_pred n_bytes n_tokens payload sha1 first url_ record_id copies text_ main turn"
).split()


def clashing(df):
    return df.withColumns({name: F.lit(7) for name in CLASHES if name not in df.columns})


def told(found):
    return rows_of_spark(found.withColumn("items", F.array_join("items", ",")))


@pytest.mark.parametrize("name", ["op4_decontamination", "op5_ngram_jaccard", "op8_mixing", "op10_warc"])
def test_results_do_not_hang_on_broadcasts(spark, monkeypatch, name):
    monkeypatch.setattr(common, "BROADCAST_BYTES", 0)
    con = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    assert rows_of_spark(QUERIES[name](spark, SF_DIR)) == rows_of_duck(con, ORACLE[name])


def test_keys_alone_are_broadcast_when_windows_are_too_many(spark, monkeypatch):
    docs, items = load(spark, SF_DIR, "documents"), load(spark, SF_DIR, "benchmark")
    near = told(decontam.contamination(docs, items))
    monkeypatch.setattr(common, "BROADCAST_BYTES", 1 << 30)
    monkeypatch.setattr(decontam, "_WINDOW_BYTES", 1 << 40)
    assert told(decontam.contamination(docs, items)) == near


def test_empty_tables(spark):
    docs, labels = load(spark, SF_DIR, "documents").limit(0), load(spark, SF_DIR, "labels").limit(0)
    items, pages = load(spark, SF_DIR, "benchmark").limit(0), load(spark, SF_DIR, "pages").limit(0)
    vectors = load(spark, SF_DIR, "embeddings").limit(0)
    assert langid.identify(docs, langid.train(docs)).isEmpty()
    assert tokens.count_tokens(docs, public_tokenizers.path("byte_bpe_50k.json")).isEmpty()
    assert topk.top_k(topk.index(vectors, "vec_id", "embedding"), F.col("id") % 50 == 0, 5).isEmpty()
    assert decontam.contamination(docs, items).isEmpty()
    assert jaccard.near_duplicates(docs).isEmpty()
    assert jaccard.one_per_group(docs).isEmpty()
    assert html_text.extract_text(pages).isEmpty()
    assert quality.classify(docs, labels)[0].isEmpty()
    assert toxicity.score(docs, toxicity.train(docs, labels)).isEmpty()
    assert mixing.mix(docs, F.lit("t")).isEmpty()
    path = shared_dir(spark, "warc")
    warc.write_warc(pages, path)
    assert warc.resolved(warc.read_warc(spark, path)).isEmpty()
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF_DIR).isEmpty(), name


def test_clashing_columns_change_nothing(spark):
    docs, items = load(spark, SF_DIR, "documents").filter("doc_id < 400"), load(spark, SF_DIR, "benchmark")
    labels, pages = load(spark, SF_DIR, "labels"), load(spark, SF_DIR, "pages").filter("page_id < 200")
    assert told(decontam.contamination(clashing(docs), clashing(items))) == told(decontam.contamination(docs, items))
    assert decontam.clean(clashing(docs), clashing(items)).count() == decontam.clean(docs, items).count()
    assert rows_of_spark(jaccard.near_duplicates(clashing(docs))) == rows_of_spark(jaccard.near_duplicates(docs))
    assert jaccard.one_per_group(clashing(docs)).count() == jaccard.one_per_group(docs).count()
    model = langid.train(clashing(docs))
    assert langid.identify(clashing(docs), model, pred="p", score="s").count() == docs.count()
    assert tokens.count_tokens(clashing(docs).drop("n_bytes", "n_tokens"), public_tokenizers.path("byte_bpe_50k.json")).count() == docs.count()
    scored, name = quality.classify(clashing(docs), clashing(labels))
    assert name == "score_" and scored.count() == docs.count()
    assert toxicity.score(clashing(docs), toxicity.train(clashing(docs), clashing(labels)), name="s").count() == docs.count()
    assert mixing.mix(clashing(docs), F.lit("x")).count() == docs.count()
    vectors = load(spark, SF_DIR, "embeddings").filter("vec_id < 300")
    found = [rows_of_spark(topk.top_k(topk.index(v, "vec_id", "embedding"), F.col("id") % 50 == 0, 5)) for v in (vectors, clashing(vectors))]
    assert found[0] == found[1]
    assert html_text.extract_text(clashing(pages), text="shown").count() == pages.count()
    path = shared_dir(spark, "warc")
    warc.write_warc(clashing(pages), path)
    assert warc.resolved(warc.read_warc(spark, path)).count() == pages.count()


def test_copies_that_fill_a_table(spark):
    text = " ".join(f"w{i}" for i in range(200))
    near = text.replace("w100 ", "other ")
    docs = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 2, near).otherwise(text).alias("text"))
    found = jaccard.near_duplicates(docs)
    assert {(r["component_id"], r["n_shingles"]) for r in found.collect()} == {(0, 196)}
    assert [r["doc_id"] for r in jaccard.one_per_group(docs).collect()] == [0]


def test_long_records_written_many_times(spark):
    page = "x" * 100_000
    rows = [(1, "u", page)] * 50 + [(2, "u", page)]
    path = shared_dir(spark, "warc")
    warc.write_warc(spark.createDataFrame(rows, "page_id long, url string, html string"), path)
    found = warc.resolved(warc.read_warc(spark, path)).groupBy("record_type", "page_id", "to_page", "payload_bytes", "intact").count().collect()
    assert sorted(map(tuple, found)) == [("response", "1", None, 100_000, True, 50), ("revisit", "2", "1", 100_000, True, 1)]
