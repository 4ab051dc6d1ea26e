"""Nulls, empty and long texts, repeated rows, empty tables, clashing columns; brute force."""

import json
import math
import random

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tierflow.llm import decontam, html_text, jaccard, langid, mixing, quality, tokens, topk, toxicity, warc
from tierflow.llm.common import fold, load
from tierflow.llm.components import components
from tierflow.session import shared_dir

SF_DIR = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, id long, h long, words string"


def docs_of(spark, texts):
    rows = [(i, t, "en", "a" if (i or 1) % 3 else None, None, 1, 2, 3, "x") for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def odd_texts():
    base = " ".join(f"w{i}" for i in range(60))
    return [(1, None), (2, ""), (3, " \n\t "), (4, base), (4, base), (5, base.upper()), (None, base + " more"), (6, "the " * 30000), (7, "a b")]


def words_of(text):
    return (text or "").encode().lower().split()


def brute_components(rows):
    sets = [{tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set() for w in (words_of(t) for _, t in rows)]
    group = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j]):
                old, new = group[i], group[j]
                group = [new if g == old else g for g in group]
    ids = [[rows[k][0] for k in range(len(rows)) if group[k] == g and rows[k][0] is not None] for g in group]
    return sorted((r[0] or 0, len(s), min(x, default=0)) for r, s, x in zip(rows, sets, ids, strict=True))


def test_jaccard_against_brute_force(spark):
    rng = random.Random(3)
    rows = odd_texts()
    for k in range(12):
        base = [f"v{rng.randrange(4000)}" for _ in range(rng.choice([3, 8, 40, 120]))]
        for c in range(rng.choice([1, 2, 9])):
            copy = list(base)
            for _ in range(rng.choice([0, 0, 1, 2])):
                copy[rng.randrange(len(copy))] = f"e{rng.randrange(9)}"
            rows.append((100 + 20 * k + c, " ".join(copy)))
    found = jaccard.near_duplicates(docs_of(spark, rows)).collect()
    assert sorted((r["id"] or 0, r["n_shingles"], r["component_id"] or 0) for r in found) == brute_components(rows)
    kept = jaccard.one_per_group(docs_of(spark, rows))
    assert kept.columns == docs_of(spark, rows).columns
    texts = [t for r in kept.collect() if words_of(t := r["text"])]
    assert len(texts) == len({c for _, n, c in brute_components(rows) if n})


def test_components_of_a_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101)], "a long, b long")
    found = {r["v"]: r["c"] for r in components(links).collect()}
    assert found == {i: 0 for i in range(41)} | {100: 100, 101: 100}


def test_decontamination_cases(spark):
    item = "one two three four five six seven eight nine ten eleven"
    items = spark.createDataFrame([(1, item), (10, "lone word"), (2, None), (3, "..."), (None, "x y")], "item_id long, text string")
    docs = docs_of(spark, [(1, f"zero {item.upper()}!"), (1, f"zero {item.upper()}!"), (2, "a LONE, word"), (3, None), (4, "x y"), (5, item[:-12])])
    found = {(r["id"], r["n_words"], r["n_hit"], tuple(r["items"])) for r in decontam.contamination(docs, items).collect()}
    assert found == {(1, 12, 11, ("1",)), (2, 3, 2, ("10",)), (3, 0, 0, ()), (4, 2, 0, ()), (5, 9, 0, ())}
    assert decontam.contamination(docs, items).count() == 6
    assert sorted(r["doc_id"] for r in decontam.clean(docs, items).collect()) == [3, 4, 5]


def test_vocabularies_that_may_be_cut():
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        safe = json.load(file)
    assert tokens.cuts_safely(safe)
    token = dict(safe["added_tokens"][0])
    for change in ({"pre_tokenizer": None}, {"normalizer": {"type": "NFC"}}, {"added_tokens": [token | {"content": "a b"}]}, {"added_tokens": [token | {"rstrip": True}]}):
        assert not tokens.cuts_safely(safe | change)
    for change in ({"use_regex": False}, {"add_prefix_space": True}, {"type": "Whitespace"}):
        assert not tokens.cuts_safely(safe | {"pre_tokenizer": safe["pre_tokenizer"] | change})


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_tokens_are_those_of_the_library(spark, name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    texts = odd_texts() + [(20, "<|endoftext|> a<|endoftext|>b  \n\n c\t d\x1c e"), (21, "x" * 5000), (22, "don't  'll 12's\n \n")]
    plain = Tokenizer.from_file(path)
    found = tokens.count_tokens(docs_of(spark, texts), path).collect()
    assert sorted((r["n_bytes"], r["n_tokens"]) for r in found) == sorted(
        (len((t or "").encode()), len(plain.encode(t or "", add_special_tokens=False))) for _, t in texts
    )
    assert all(sum(len(x.encode()) for x in b) <= 64 or len(b) == 1 for b in tokens.balanced(["abc" * k for k in range(40)], 64))


def brute_top_k(rows, wanted, k):
    """Scores of every query, by whole numbers; rows of one id are told apart by place only."""
    whole = [[int(x) * 256 if abs(x) >= 1 << 53 else math.floor(256 * x) for x in v] for _, v in rows]
    out = []
    for q, (own, _) in enumerate(rows):
        if wanted(own):
            best = sorted((-sum(a * b for a, b in zip(whole[q], w, strict=False)), rows[i][0]) for i, w in enumerate(whole) if i != q)
            out += [(own, r, i, str(-score)) for r, (score, i) in enumerate(best[:k], 1)]
    return sorted(out)


def told_top_k(spark, rows, kind, wanted=50, k=5, **options):
    frame = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>").repartition(3)
    found = topk.top_k(topk.index(frame, "vec_id", "embedding"), F.col("id") % wanted == 0, k).collect()
    return sorted((r["query_id"], r["rank"], r["id"], str(r["score"])) for r in found)


@pytest.mark.parametrize("block_rows", [1 << 16, 64, 7])
def test_top_k_against_brute_force(spark, monkeypatch, block_rows):
    """Also over several blocks, and where the ids of queries and of candidates repeat."""
    monkeypatch.setattr(topk, "BLOCK_ROWS", block_rows)
    monkeypatch.setattr(topk, "LEAST_ROWS", 1)
    rng = np.random.default_rng(1)
    rows = [(int(i), [float(x) for x in np.float32(rng.integers(-3, 4, 6) / 7)]) for i in range(300)]
    rows += [(i, [x + 1 for x in rows[i][1]]) for i in (0, 50, 50, 7, 7)] + [(500, [1.5, -2.0]), (501, []), (550, [])]
    odd = [(400, None), (401, [1.0, None]), (402, [float("nan")] * 6), (404, [float("-inf")] + [0.0] * 5), (None, [1.0] * 6)]
    assert told_top_k(spark, rows + odd, "float") == brute_top_k(rows, lambda i: i % 50 == 0, 5)


def test_top_k_of_one_id(spark):
    assert told_top_k(spark, [(7, [1.0]), (7, [3.0])], "float", wanted=7) == [(7, 1, 7, "196608"), (7, 1, 7, "196608")]
    assert told_top_k(spark, [(50, [1.0])], "float") == []


@pytest.mark.parametrize("size", [9e6, 1e12, 2.0**60, 1e200, 1.7e308])
def test_top_k_of_large_components(spark, size):
    """None is dropped, and what exceeds a long is told by its digits."""
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.uniform(-1, 1, size=3) * rng.choice([1e-3, 1.0, size], size=3)]) for i in range(60)]
    rows += [(100, [size, 1.0, -size])]
    assert told_top_k(spark, rows, "double", wanted=20) == brute_top_k(rows, lambda i: i % 20 == 0, 5)


def test_blocks_are_bounded_by_bytes_and_sent_no_more_than_cores_need():
    assert topk.layout(0, 64, 8) == (1, 8)
    assert topk.layout(50_000, 64, 6) == (1, 6)
    assert topk.layout(10**8, 64, 1000) == (1526, 1)
    blocks, groups = topk.layout(10**8, 4096, 1000)
    assert 8 * 4096 * (10**8 // blocks) <= topk.BLOCK_BYTES and groups == 1


def test_warc_round_trip(spark):
    big = "é" * 50000
    rows = [(1, "u", big), (2, "u", big), (2, "u", big), (3, None, None), (4, "a\r\nb", ""), (None, "n", "WARC/1.1\r\n\r\nx")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    path = shared_dir(spark, "warc")
    warc.write_warc(pages, path)
    found = warc.resolved(warc.read_warc(spark, path)).collect()
    assert all(r["intact"] for r in found)
    told = sorted((r["page_id"] or "", r["record_type"], r["payload_bytes"], r["to_page"] or "") for r in found)
    assert told == [("", "response", 13, ""), ("1", "response", 100000, ""), ("2", "revisit", 100000, "1"), ("2", "revisit", 100000, "1"), ("3", "response", 0, ""), ("4", "revisit", 0, "3")]
    payloads = {bytes(r["payload"]) for r in warc.read_warc(spark, path).collect() if r["payload"] is not None}
    assert payloads == {big.encode(), b"", b"WARC/1.1\r\n\r\nx"}


@pytest.mark.parametrize(
    ("source", "text"),
    [
        (None, ""),
        ("plain  text", "plain text"),
        ("<ul><li>a<li>b<ol start=3><li>x<li>y</ol><li>c</ul>", "- a\n- b\n  3. x\n  4. y\n- c"),
        ("<p>one<p>two<div>three</div>", "one\n\ntwo\n\nthree"),
        ("<table><tr><td>a<td>bbb<tr><th>cccc<td>d</table>", "a    | bbb\ncccc | d"),
        ("a<script>x</script><!-- no --><i hidden>no</i><b style='display: none'>no</b> &lt;b", "a <b"),
        ("<pre> x\n  y</pre>z<br>w", " x\n  y\n\nz\nw"),
        ("<p>a</b></p></div>b<a href=x\">c", "a\n\nbc"),
    ],
)
def test_html(source, text):
    assert html_text.render(source) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ("<html><head><title>T</title><p>Hello", "Hello"),
        ("<head><meta charset=utf-8>\n<link rel=x><style>s</style>Hello <b>you", "Hello you"),
        ("<html><head><template><p>no</p></template><noscript>no</noscript><script>no</script><div>a</div><p>b", "a\n\nb"),
        ("<html><head><title>T</title>\n<body><p>a</p></body></html>", "a"),
        ("<html><head><title>T</title></head><p>a<head><p>b", "a\n\nb"),
        ("<head><title>T</title></br>x", "x"),
        ("<head><html lang=en><title>T</title>x</html>", "x"),
    ],
)
def test_html_head_ends_where_content_starts(source, text):
    assert html_text.render(source) == text


@pytest.mark.parametrize(
    ("source", "text"),
    [
        ('<p title="a hidden gem">a<p class="menu hidden md:block">b<p data-x="display: none">c<p aria-hidden=true>d', "a\n\nb\n\nc\n\nd"),
        ("<p alt='x hidden'>a<p title=hidden>b<p data-hidden>c<p title=\"it's hidden>d", "a\n\nb\n\nc\n\nd"),
        ("a<i HIDDEN>x</i><i hidden=''>x</i><i class=c hidden>x</i><i id=a/b hidden=until-found>x</i>b", "ab"),
        ("a<i style='color:red;DISPLAY : None !important'>x</i><i style=visibility:hidden>x</i><i style='display&#58;none'>x</i>b", "ab"),
        ("<i style='display:none;display:block'>a</i><i style='--x:\"display:none\"'>b</i><i style='/*display:none*/'>c</i>", "abc"),
        ("<i style='background:url(data:a;display:none)'>a</i><i style='width:calc((1px + 2px)*2);display:none'>x</i>b", "ab"),
        ("<ol title='x start=5'><li>a</ol><ol start=' 7'><li>b</ol>", "1. a\n\n7. b"),
        ("a<svg><title>no</title><defs><text>no</text></defs><g>no<text x=1>one <tspan>two</tspan></text><text>three</text></g></svg>b", "a\none two\nthree\nb"),
        ("<svg><defs/><path d=a/></path><svg><text>in</text></svg></svg><p>a<svg class=i /> b", "in\n\na b"),
        ("<svg><foreignObject><p>one<p>two</foreignObject><desc>no</desc></svg>", "one\n\ntwo"),
        ("<svg><g>no<p>out", "out"),
        ("<div hidden><svg><text>no</text></svg></div>a", "a"),
        ("<math><semantics><mi>x</mi><mo>=</mo><mn>2</mn><annotation>no</annotation></semantics></math>!", "x=2!"),
        ("<xmp> <b>\n  &lt;</xmp>a", " <b>\n  &lt;\n\na"),
    ],
)
def test_html_hides_by_attribute_alone(source, text):
    assert html_text.render(source) == text


def test_html_of_any_depth():
    assert html_text.render("<div>" * 20000 + "x") == "x"


def test_classifiers_on_odd_rows(spark):
    train, labels = load(spark, SF_DIR, "documents"), load(spark, SF_DIR, "labels")
    odd = docs_of(spark, odd_texts()).withColumns({"score": F.lit(1), "statistics": F.lit(1), "lang_pred": F.lit(1)})
    model = langid.train(train, where=fold("doc_id", 5) != 0)
    found = langid.identify(odd, model, pred="p", score="s").collect()
    assert all((r["p"] == "und") == (not any(c.isalpha() for c in r["text"] or "")) for r in found)
    held = langid.identify(train.filter(fold("doc_id", 5) == 0), model).agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert held >= 0.97
    assert langid.train(train.limit(0)).predict(["a"])[0] == ["und"]

    scored, name = quality.classify(odd, labels.limit(0))
    assert name == "score_" and {r[name] for r in scored.collect()} == {0.5}
    figures = quality.figures(train)
    scored = quality.score(figures, quality.train(figures, labels, "doc_id", "quality", fold("doc_id", 5) != 0))
    right = scored.filter(fold("doc_id", 5) == 0).join(labels, "doc_id").agg(F.avg(((F.col("score") >= 0.3).cast("int") == F.col("quality")).cast("int")))
    assert right.first()[0] >= 0.93

    assert toxicity.train(train, labels.limit(0)) is None
    assert {r["t"] for r in toxicity.score(odd, None, name="t").collect()} == {0.0}


def test_language_is_unknown_just_where_no_letter_is():
    every = np.arange(langid.BUCKETS)
    model = langid.Model(("a", "b"), langid.Sparse.of(np.repeat(every, 2), np.tile([0, 1], len(every)), np.ones(2 * len(every))), np.zeros(2))
    chars = [c for c in map(chr, range(0x110000)) if not 0xD800 <= ord(c) < 0xE000]
    texts = ["！１２「」", "٠١٢ ०१२", "\u0301\u093f", "ℕ", "ｈ", "हिन्दी", *chars]
    labels, _ = model.predict(texts)
    assert [t for t, label in zip(texts, labels, strict=True) if (label == langid.UNKNOWN) == any(c.isalpha() for c in t)] == []
    # A text's figures do not hang on what stands next to it.
    alone, beside = (np.concatenate([b for _, _, b in langid._grams(t)]) for t in (["a b"], ["1 2", "a b", "3"]))
    assert list(alone) == list(beside)


def test_toxicity_held_out_accuracy(spark):
    docs, labels = load(spark, "/root/testdata/sf0.1", "documents"), load(spark, "/root/testdata/sf0.1", "labels")
    model = toxicity.train(docs, labels, where=fold("doc_id", 3) != 1)
    held = toxicity.score(docs.filter(fold("doc_id", 3) == 1), model).join(labels, "doc_id")
    right, caught = held.agg(F.avg(((F.col("score") >= 0.7).cast("int") == F.col("toxic")).cast("int")), F.avg(F.when(F.col("toxic") == 1, (F.col("score") >= 0.7).cast("int")))).first()
    assert right >= 0.93 and caught >= 0.75
    plain, gapped, joined, clean = model.words(["idiot", "i.d.i.o.t", sorted(toxicity.units("i d i o t"), key=len)[-1], "house"])
    assert min(plain, gapped, joined) > 0.5 > clean


def test_pipeline_keeps_columns_and_survives_odd_rows(spark):
    docs = load(spark, SF_DIR, "documents").unionByName(docs_of(spark, odd_texts()).select("doc_id", "text", "lang", "source", "n_chars"))
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, SF_DIR), "test")
        assert docs.columns == columns, name
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF_DIR)
    assert last.columns[: len(columns)] == columns
    assert 0 < last.count() <= docs.count()
