"""Mixing sources to target weights by iterative proportional fitting (operator 8), in
DataFrame functions only.

The tokens of cells (source, language, topic) are raked: scaled so that the sums by source, by
language and by topic meet their targets, in turn, until all do. No cell can give more than
it has: a step scales the cells of one value by the factor at which the sum of what they then
give, each at most its own tokens, is the target. What a cell gives, over its tokens, is the
probability with which each of its documents is kept; so the expected mix meets the targets.

The mix is as large as that allows. No sum can exceed the tokens of its value, which bounds
the whole; raking aims at `HEADROOM` of that bound, and lower where rounds show that targets
cannot be met there.

Topics: the words that most documents of a language hold, among those of some length that at
most one in `COMMON` holds, are its `TOPICS` topic words; a document's topic is the one it
holds most often. Topics are parts of their language, and so are their targets.

Documents are reduced to cells before any shuffle, and to counts per task of the distinct
words, so a source with a third of all rows is a few rows per task. Each raking step is a
few windows over cells. Cells are joined to the documents by broadcast up to a checked size,
by shuffle beyond.

Targets default to tempered shares (each value's share of all tokens to a power, scaled to
sum to one), which damps large sources and lifts small ones.

Defined results: null source, language or topic read as "". A text without words weighs
nothing and is kept with its cell's probability; cells without tokens have probability 0.
The draw depends on the id alone, so repeated rows share their fate and runs repeat. If
targets cannot all be met at any size (cells that would be needed are empty), raking stops
when rounds no longer help, with a warning that tells how far the sums are off. Topic words
rank by documents, then by themselves; of topics that a document holds equally often it has
the first. An empty table gives an empty one.
"""

from __future__ import annotations

import logging
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tierflow.llm.common import fresh, small_side, stored

log = logging.getLogger("tierflow")

# Powers of the shares, by dimension.
TEMPER = {"source": 0.5, "lang": 0.7, "topic": 0.7}
# Topic words of a language; at most one document in so many holds such a word, and it has so
# many characters, as short words seldom tell a topic.
TOPICS = 8
COMMON = 8
SHORTEST, LONGEST = 6, 64
# Share of the greatest sum that the values' own tokens allow.
HEADROOM = 0.9
# Rounds at most; rounds between two looks at how far the sums are from their targets.
MOST_ROUNDS = 120
ROUNDS = 6
TOLERANCE = 1e-6
# Rounds no longer help when they leave more than this part of the error. A smaller size is
# tried then, down to a least one and as long as that helps.
STANDING = 0.9
LOWER = 0.5
LEAST = 0.05
# Cells up to this number are raked in one task; more are dealt out for every step.
ONE_TASK_CELLS = 50_000
_SPACE = r"[\x20\x09-\x0D]+"
_CELL_BYTES = 200
_FAR = 1e100


def split_words(text: Column) -> Column:
    """The words between white space; empty ones stand at the ends alone."""
    return F.split(F.coalesce(text, F.lit("")), _SPACE)


def n_words(parts: Column) -> Column:
    """How many of the parts are words."""
    edge = lambda i: (F.element_at(parts, i) == "").cast("long")
    return (F.size(parts) - edge(1) - F.when(F.size(parts) > 1, edge(-1)).otherwise(0)).cast("long")


def topic_words(docs: DataFrame, text: str = "text", lang: str = "lang", topics: int = TOPICS) -> DataFrame:
    """`topic_lang` and `topic_words`, an array in their order, of every language that has some."""
    rows = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("")).alias("topic_lang"), F.col(text).alias("text"))
    sizes = rows.groupBy("topic_lang").agg(F.count("*").alias("n"))
    # Bytes are known, characters have to be counted.
    usable = F.filter(split_words(F.col("text")), lambda w: (F.octet_length(w) >= SHORTEST) & F.length(w).between(SHORTEST, LONGEST))
    held = rows.select("topic_lang", F.explode(F.array_distinct(usable)).alias("word"))
    held = held.groupBy("topic_lang", "word").agg(F.count("*").alias("df"))
    told = held.join(small_side(stored(sizes, "languages"), _CELL_BYTES), "topic_lang").filter(F.col("df") * COMMON <= F.col("n"))
    place = F.row_number().over(W.partitionBy("topic_lang").orderBy(F.desc("df"), "word"))
    best = told.withColumn("place", place).filter(F.col("place") <= topics)
    words = F.transform(F.array_sort(F.collect_list(F.struct("place", "word"))), lambda x: x["word"])
    return stored(best.groupBy("topic_lang").agg(words.alias("topic_words")), "topic-words")


def _most_frequent(parts: Column, topic_words: Column, topics: int) -> Column:
    """How often a text holds its most frequent topic word, and less its place; the first of
    equals. Each of the text's words is looked at once."""
    hits = F.filter(parts, lambda w: (F.octet_length(w) >= SHORTEST) & F.array_contains(topic_words, w))
    none = F.array_repeat(F.lit(0), topics)
    counts = F.aggregate(
        hits, none, lambda counts, w: F.transform(counts, lambda n, i: n + F.coalesce((F.get(topic_words, i) == w).cast("int"), F.lit(0)))
    )
    return F.array_max(F.transform(counts, lambda n, i: F.struct(n.alias("n"), (-i).alias("i"))))


def mix(
    docs: DataFrame,
    topic: Column | None = None,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    lang: str = "lang",
    temper: Mapping[str, float] = TEMPER,
    targets: DataFrame | None = None,
    rounds: int | None = None,
    with_text: bool = True,
) -> DataFrame:
    """`docs` with `topic`, `n_tokens`, `probability` and `sampled`.

    `topic` may give topics of its own, which then have targets of their own. `targets` may give
    shares: columns dim (source, lang or topic), value, share. Values of a dimension that it does
    not name share what is left as they would by default; a dimension without targets keeps its
    default. `rounds` fixes their number instead of raking until the sums meet their targets.
    Without the text the documents are read once less, and their other columns kept meanwhile.
    """
    topic_name, tokens, chance, drawn = (fresh(docs.columns, n) for n in ("topic", "n_tokens", "probability", "sampled"))
    nested = topic is None
    own, parts, best = (fresh(docs.columns, n) for n in ("_topic_words", "_parts", "_most_frequent"))
    rows = docs
    if nested:
        found = topic_words(docs, text, lang)
        found = found.select(F.col("topic_lang").alias(f"{own}_lang"), F.col("topic_words").alias(own))
        spoken = F.coalesce(F.col(lang).cast("string"), F.lit(""))
        rows = docs.join(small_side(found, TOPICS * _CELL_BYTES), spoken == F.col(f"{own}_lang"), "left")
        rows = rows.withColumn(own, F.coalesce(own, F.array().cast("array<string>")))
    # Columns of their own, as what is used twice would else be computed twice.
    rows = rows.withColumn(parts, split_words(F.col(text)))
    if nested:
        rows = rows.withColumn(best, _most_frequent(F.col(parts), F.col(own), TOPICS))
        word = F.when(F.col(best)["n"] > 0, F.get(own, -F.col(best)["i"]))
        topic = F.concat(spoken, F.lit(":"), F.coalesce(word, F.lit("")))
    rows = rows.withColumns({topic_name: topic, tokens: n_words(F.col(parts))})
    rows = rows.select(*(c for c in docs.columns if with_text or c != text), topic_name, tokens)
    if not with_text:
        rows = stored(rows, "mixed")
    keys = {"source": F.col(source), "lang": F.col(lang), "topic": F.col(topic_name)}
    keys = {k: F.coalesce(c.cast("string"), F.lit("")) for k, c in keys.items()}
    cells = rows.select(*[c.alias(k) for k, c in keys.items()], F.col(tokens).alias("tokens"))
    cells = stored(cells.groupBy(*keys).agg(F.sum("tokens").alias("tokens")).filter("tokens > 0"), "cells")
    raked = rake(with_targets(cells, temper, targets, nested), rounds)
    p = F.least(F.col("w") / F.col("tokens"), F.lit(1.0))
    ratios = raked.select(*[F.col(k).alias(f"_cell_{k}") for k in keys], p.alias("_cell_p"))
    met = [c == F.col(f"_cell_{k}") for k, c in keys.items()]
    joined = rows.join(small_side(ratios, _CELL_BYTES), met[0] & met[1] & met[2], "left")
    p = F.coalesce("_cell_p", F.lit(0.0))
    out = joined.withColumns({chance: p, drawn: draw(doc_id) < p})
    return out.drop("_cell_p", *[f"_cell_{k}" for k in keys])


def draw(doc_id: str) -> Column:
    """A number in [0, 1) that hangs on the id alone."""
    digest = F.md5(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / float(1 << 32)


def with_targets(cells: DataFrame, temper: Mapping[str, float] = TEMPER, targets: DataFrame | None = None, nested: bool = False) -> DataFrame:
    """`cells` with the target share of each of their values, `t_source` and so on. With
    `nested`, a topic's default is its share of its language's target."""
    for dim, power in temper.items():
        share = F.pow(F.sum("tokens").cast("double"), F.lit(power))
        if nested and dim == "topic":
            shares = cells.groupBy("lang", "topic").agg(share.alias("t"), F.max("t_lang").alias("of"))
            shares = shares.withColumn("t", F.col("t") * F.col("of") / F.sum("t").over(W.partitionBy("lang")))
            shares = shares.groupBy("topic").agg(F.sum("t").alias("t"))
        else:
            shares = cells.groupBy(dim).agg(share.alias("t"))
        shares = stored(shares.select(dim, "t"), "shares")
        whole = shares.agg(F.sum("t")).first()[0] or 1.0
        shares = shares.withColumn("t", F.col("t") / F.lit(whole))
        if targets is not None:
            shares = _given(shares, dim, targets)
        cells = cells.join(small_side(shares.select(dim, F.col("t").alias(f"t_{dim}")), _CELL_BYTES), dim)
    return cells


def _given(shares: DataFrame, dim: str, targets: DataFrame) -> DataFrame:
    """The shares of a dimension, with those that targets name in their place."""
    given = targets.filter(F.col("dim") == dim).groupBy(F.coalesce(F.col("value").cast("string"), F.lit("")).alias(dim)).agg(F.sum("share").alias("own"))
    both = stored(given.join(shares, dim, "full").select(dim, "own", "t"), "given")
    none, least, most, absent, others, whole = both.agg(
        F.count("own") == 0, F.min("own"), F.sum("own"), F.count_if((F.col("own") > 0) & F.col("t").isNull()), F.sum(F.when(F.col("own").isNull(), F.col("t"))), F.sum("t")
    ).first()
    if none or not whole:
        return shares
    if not 0 <= least <= most <= 1 + TOLERANCE:
        raise ValueError(f"target shares of {dim} lie between 0 and 1 and sum to 1 at most")
    if absent:
        raise ValueError(f"{absent} targets of {dim} are for values without tokens")
    rest = max(0.0, 1 - most)
    # What nobody is left to share goes to those that are named.
    named = F.col("own") / F.lit(most if most and not others else 1.0)
    left = F.col("t") * F.lit(rest / others if others else 0.0)
    return both.filter("t IS NOT NULL").select(dim, F.coalesce(named, left).alias("t"))


def rake(cells: DataFrame, rounds: int | None = None) -> DataFrame:
    """`cells` (`tokens` and target shares `t_*`) with what each gives, `w`."""
    dims = [c[2:] for c in cells.columns if c.startswith("t_")]
    wanted = " AND ".join(f"t_{d} > 0" for d in dims)
    columns = [*dims, "tokens", "w"]
    cells = stored(cells.withColumn("u", F.when(F.expr(wanted), F.col("tokens").cast("double"))), "raked")
    unwanted = cells.filter("u IS NULL").withColumn("w", F.lit(0.0)).select(columns)
    cells = cells.filter("u IS NOT NULL")
    aim = HEADROOM * _bound(cells, dims)
    few = cells.count() <= ONE_TASK_CELLS
    done, last, before, lowest = 0, float("inf"), float("inf"), aim * LEAST
    while aim and done < (rounds or MOST_ROUNDS):
        # One partition meets every window's needs without a shuffle.
        cells = cells.coalesce(1) if few else cells
        step = min(ROUNDS, (rounds or MOST_ROUNDS) - done)
        for _ in range(step):
            for dim in dims:
                cells = _met(cells, dim, dims, aim)
        cells, done = stored(cells, "raked"), done + step
        if rounds:
            continue
        error = _error(cells, dims, aim)
        if error <= TOLERANCE:
            break
        if error > STANDING * last or done >= MOST_ROUNDS:
            if error > STANDING * before or aim * LOWER < lowest or done >= MOST_ROUNDS:
                log.warning("mixing: targets cannot all be met, sums are up to %.1f %% off", 100 * error)
                break
            aim, before, error = aim * LOWER, error, float("inf")
        last = error
    return cells.withColumn("w", F.least("u", F.col("tokens").cast("double"))).select(columns).unionByName(unwanted)


def _bound(cells: DataFrame, dims: list[str]) -> float:
    """The greatest sum of which no value's share exceeds its tokens."""
    bounds = [
        cells.groupBy(dim).agg(F.sum("tokens").alias("n"), F.max(f"t_{dim}").alias("t")).agg(F.min(F.col("n") / F.col("t"))).first()[0] for dim in dims
    ]
    return min((b for b in bounds if b is not None), default=0.0)


def _met(cells: DataFrame, dim: str, dims: list[str], aim: float) -> DataFrame:
    """One step: `u` scaled so that the least of `u` and `tokens` sums to the target of each value.

    That sum grows with the factor along straight lines that bend down where a cell gives
    all it has, so the factor is the greatest that any of the lines asks for. Cells in the
    order in which they are used up tell the lines: tokens up to a cell, and `u` after it.
    """
    order = W.partitionBy(dim).orderBy(F.col("tokens") / F.col("u"), *dims)
    used = F.sum(F.col("tokens").cast("double")).over(order.rowsBetween(W.unboundedPreceding, 0))
    after = F.sum("u").over(order.rowsBetween(1, W.unboundedFollowing))
    goal, value = F.lit(aim) * F.col(f"t_{dim}"), W.partitionBy(dim)
    lines = cells.withColumn("line", (goal - used) / after)
    factor = F.greatest(goal / F.sum("u").over(value), F.max("line").over(value))
    return lines.withColumn("u", F.least(F.col("u") * factor, F.col("tokens") * F.lit(_FAR))).drop("line")


def _error(cells: DataFrame, dims: list[str], aim: float) -> float:
    """The greatest relative distance of a sum from its target."""
    worst = 0.0
    for dim in dims:
        sums = cells.groupBy(dim).agg(F.sum(F.least("u", F.col("tokens").cast("double"))).alias("w"), F.max(f"t_{dim}").alias("t"))
        worst = max(worst, sums.agg(F.max(F.abs(F.col("w") / (F.col("t") * F.lit(aim)) - 1))).first()[0] or 0.0)
    return worst
