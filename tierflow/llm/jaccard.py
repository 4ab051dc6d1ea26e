"""Near-duplicate detection by an exact n-gram Jaccard join (operator 5).

Two documents link when the sets of their distinct word shingles have a Jaccard similarity
of at least `num / den`; components are the connected components of the links. No link
between different texts is lost. Steps:

1. Texts with equal words are one class; only classes are compared.
2. A class that cannot link leaves early. Under any fixed order of shingles two linked sets
   share the first few of their common shingles within the first part of both (the prefix
   filter, for more than one shingle). With shingles in hash order, each document sends that
   part, about a quarter of its set, once through a shuffle; classes that share too few of it
   with any other are done.
3. Among the others shingles are ordered by frequency, rarest first. Shingles of one class
   alone link nothing, and a class whose prefix has no others is done. The rest are joined
   on their rare prefix shingles, under length, positional and suffix filters.
4. Bucket by bucket, members are compared with a leader, which is another one in other
   buckets; in a few more rounds, members outside a bucket's largest component with one
   leader in it; last, those still outside with all members of other components. A pair
   within one component needs no check; every other pair of a bucket gets one. So a group of
   n near copies costs about n comparisons, not n * n.
5. Pairs are made distinct and verified once, on whole shingle sets.

Very frequent shingles (proven to occur in several texts by a sample of documents; at most
`HOT_SHINGLES`) skip the count by shingle, which would bring all their rows together, and are
ranked last. This changes the plan, not the result: any one order of shingles is exact.

Shingles and texts are compared by 64-bit hashes.

Words are runs of anything but ASCII white space; A-Z is folded. A text of fewer words than
a shingle is one shingle. Defined results: null, empty and blank texts have no shingles and
link with nothing, not even with each other. Rows with equal texts are in one component,
repeated rows too. An id of null counts as greater than all others; a component of such rows
alone has none.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import small_side, stored
from tierflow.llm.components import components

WORDS = 5
NUM, DEN = 80, 100
# The first step sends this share of a set beyond its prefix, and asks for about as many hits.
EXTRA = 0.05
# Documents of the sample that finds very frequent shingles: one in so many.
SAMPLE = 64
# A shingle is very frequent if so many different texts of the sample have it.
HOT_TEXTS = 8
HOT_SHINGLES = 1 << 15
# Leaders a group of near copies has in the first comparison.
LEADERS = 8
# Rounds in which members outside a bucket's largest component meet one of its members.
STAR_ROUNDS = 2
# Parts of a set whose parities the suffix filter compares, 64 to a number.
PARTS = 512

# Texts a task remembers, in two generations, so as to send a repeated one's shingles once.
REMEMBERED = 1 << 17

_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def near_duplicates(
    docs: DataFrame, doc_id: str = "doc_id", text: str = "text", words: int = WORDS, num: int = NUM, den: int = DEN
) -> DataFrame:
    """`id, raw, n_shingles, component_id, kept` for each row of `docs`: its id, a hash of its
    text, the size of its set, the least id of its component, and whether it is the row (or
    an equal one) that stands for the component."""
    rows = docs.select(F.col(doc_id).alias("id"), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).alias("raw"), F.col(text).alias("text"))
    hot = _hot(rows, words)
    members = stored(_members(rows, words, num, den, hot), "members")
    classes = stored(_classes(members), "classes")
    alive = stored(_alive(members, classes, num, den), "alive")
    sets = _sets(rows, alive, words, hot)
    buckets = stored(_buckets(sets, num, den), "buckets")

    labels = links = tested = None
    for step in range(STAR_ROUNDS + 1):
        placed = _placed(buckets, labels)
        met = _stars(placed, step, num, den) if step < STAR_ROUNDS else _rest(placed, num, den)
        pairs = met.distinct() if tested is None else met.distinct().join(tested, ["a", "b"], "left_anti")
        pairs = stored(pairs, "pairs")
        tested = pairs if tested is None else tested.unionByName(pairs)
        found = stored(_verified(pairs, sets, num, den), "links")
        if links is None or not found.isEmpty():
            links = found if links is None else links.unionByName(found)
            labels = components(links)
    return _result(members, classes, labels)


def one_per_group(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stand for their group; equal rows are reduced to one."""
    found = stored(near_duplicates(docs, doc_id, text), "duplicates")
    gone = found.filter("NOT kept").select("id", "raw").distinct()
    gone = small_side(stored(gone, "dropped"), 48)
    mine = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("g.id")) & (F.xxhash64(F.coalesce(F.col(f"d.`{text}`"), F.lit(""))) == F.col("g.raw"))
    left = docs.alias("d").join(gone.alias("g"), mine, "left_anti")
    # Only rows that repeat both id and text are left to reduce, if there are any.
    kept = found.filter("kept AND n_shingles > 0").agg(F.count("*"), F.count_distinct(F.struct("id", "raw"))).first()
    if kept[0] == kept[1]:
        return left
    blank = F.trim(F.coalesce(F.col(text), F.lit("")), F.lit(" \t\n\x0b\f\r")) == ""
    return left.filter(~blank).dropDuplicates([doc_id, text]).unionByName(left.filter(blank))


def _least_overlap(n: Column, num: int, den: int) -> Column:
    """Shingles that a set of n shares at least with any set it links with."""
    return F.ceil(n * num / den)


def _result(members: DataFrame, classes: DataFrame, labels: DataFrame) -> DataFrame:
    linked = classes.join(labels, F.col("fp") == F.col("v")).select("fp", "c", "head")
    heads = linked.groupBy("c").agg(F.min("head").alias("head"))
    best = linked.select("fp", "c").join(heads, "c").select("fp", F.col("head").alias("group_head"))
    known = classes.join(best, "fp", "left").select("fp", F.coalesce("group_head", "head").alias("head"))
    alone = F.col("n") == 0
    mine = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("raw"))
    joined = members.select("id", "raw", "n", "fp").join(known, "fp", "left")
    return joined.select(
        "id",
        "raw",
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("head.id")).alias("component_id"),
        (alone | (mine == F.col("head"))).alias("kept"),
    )


# --- shingles ------------------------------------------------------------


def shingle_sets(texts: pa.Array, words: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each text a hash of its words and the size of its set; and the sets, one after
    another: the sorted hashes of a text's distinct shingles. A batch is taken as a whole, as
    steps for each text or word cost more than the hashing."""
    # These know ASCII only, which is what is asked for.
    trimmed = pc.ascii_trim_whitespace(pc.ascii_lower(texts))
    found = pc.ascii_split_whitespace(pc.if_else(pc.equal(trimmed, ""), None, trimmed))
    joined = pc.binary_join(found, pa.scalar(" ", trimmed.type)).cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    fps = np.array([0 if t is None else xxhash.xxh3_64_intdigest(t) for t in joined], np.uint64).view(np.int64)
    flat = found.flatten().dictionary_encode()
    distinct = flat.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, distinct), np.uint64, len(distinct))[flat.indices.to_numpy()]

    counts = pc.fill_null(pc.list_value_length(found), 0).to_numpy().astype(np.int64)
    widths = np.minimum(counts, words)
    shingles = np.where(counts > 0, counts - widths + 1, 0)
    text = np.repeat(np.arange(len(counts)), shingles)
    ends = np.cumsum(shingles)
    starts = np.arange(len(text)) + (np.cumsum(counts) - counts - ends + shingles)[text]
    mixed = np.empty(len(text), np.uint64)
    for width in np.unique(widths[counts > 0]).tolist():
        here = widths[text] == width
        value = np.full(len(hashes) - width + 1, width, np.uint64)
        for i in range(width):
            value = value * _MULTIPLIER + hashes[i : len(hashes) - width + 1 + i]
        mixed[here] = value[starts[here]]
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    mixed ^= mixed >> np.uint64(29)
    ordered = mixed.view(np.int64)
    for begin, end in zip((ends - shingles).tolist(), ends.tolist(), strict=True):
        ordered[begin:end].sort()
    first = np.ones(len(text), bool)
    first[1:] = (ordered[1:] != ordered[:-1]) | (text[1:] != text[:-1])
    return fps, np.bincount(text[first], minlength=len(counts)), ordered[first]


def _ranks(known: np.ndarray, shingles: np.ndarray) -> np.ndarray:
    """The place of each shingle in the sorted array `known`; -1 if it is not there. Costs a
    search for each shingle however long `known` is; `np.isin` sorts it anew in each call."""
    if not len(known):
        return np.full(len(shingles), -1)
    at = np.minimum(np.searchsorted(known, shingles), len(known) - 1)
    return np.where(known[at] == shingles, at, -1)


def _lists(sizes: np.ndarray, flat: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)), pa.array(flat))


def _hot(rows: DataFrame, words: int) -> dict[int, int]:
    """Very frequent shingles and how many texts of the sample have them."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sizes, found = shingle_sets(batch.column("text"), words)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(fps, sizes)), pa.array(found)], names=["fp", "h"])

    some = rows.filter(F.pmod("raw", F.lit(SAMPLE)) == 0).select("text")
    counts = some.mapInArrow(emit, "fp long, h long").distinct().groupBy("h").count().filter(F.col("count") >= HOT_TEXTS)
    best = counts.orderBy(F.desc("count"), "h").limit(HOT_SHINGLES).toPandas()
    return dict(zip(best["h"].astype(int), best["count"].astype(int), strict=True))


def _members(rows: DataFrame, words: int, num: int, den: int, hot: dict[int, int]) -> DataFrame:
    """For each row its class, set size, and the first part of its set in hash order: how many
    very frequent shingles that has, and the others. Of copies that a task meets, only the
    first (`lead`) has the others, so that a text which a third of all rows repeat sends its
    shingles about once per task."""
    known = np.sort(np.fromiter(hot, np.int64, len(hot)))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        young: set[int] = set()
        old: set[int] = set()
        for batch in batches:
            fps, sizes, found = shingle_sets(batch.column("text"), words)
            leads = []
            for fp in fps.tolist():
                leads.append(fp not in young and fp not in old)
                young.add(fp)
                if len(young) > REMEMBERED:
                    young, old = set(), young
            text = np.repeat(np.arange(len(sizes)), sizes)
            place = np.arange(len(found)) - (np.cumsum(sizes) - sizes)[text]
            zone = np.minimum(sizes, sizes - -(-sizes * num // den) + np.maximum(1, (sizes * EXTRA).astype(np.int64)))
            inside = place < zone[text]
            text, found = text[inside], found[inside]
            frequent = _ranks(known, found) >= 0
            sent = ~frequent & np.array(leads, bool)[text]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array(fps),
                    pa.array(sizes),
                    pa.array(np.bincount(text[frequent], minlength=len(sizes))),
                    pa.array(leads, pa.bool_()),
                    _lists(np.bincount(text[sent], minlength=len(sizes)), found[sent]),
                ],
                names=["id", "raw", "fp", "n", "n_hot", "lead", "zone"],
            )

    id_type = rows.schema["id"].dataType.simpleString()
    return rows.mapInArrow(emit, f"id {id_type}, raw long, fp long, n long, n_hot long, lead boolean, zone array<long>")


def _classes(members: DataFrame) -> DataFrame:
    """The classes of equal texts, with the row that stands for each."""
    head = F.struct(F.col("id").isNull().alias("none"), F.col("id"), F.col("raw"))
    return (
        members.filter("n > 0")
        .groupBy("fp")
        .agg(F.min(head).alias("head"), F.max("n").alias("n"), F.max("n_hot").alias("n_hot"), F.count_if("lead").alias("leads"))
    )


def _alive(members: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The classes that share enough of their first part with others."""
    tokens = members.filter("n > 0").select("fp", F.explode("zone").alias("h"))
    # Only whether another class has the shingle matters.
    first, last = (F.expr(f"{f}(fp) OVER (PARTITION BY h)") for f in ("min", "max"))
    shared = tokens.withColumn("alone", first == last).filter("NOT alone").groupBy("fp").agg(F.count("*").alias("hits"))
    # Partners have this size at least, which bounds how many hits they owe.
    smallest = _least_overlap(F.col("n"), num, den)
    needed = F.greatest(F.lit(1), F.floor(smallest * EXTRA))
    hits = F.col("n_hot") + F.coalesce("hits", F.lit(0)) / F.col("leads")
    return classes.join(shared, "fp", "left").filter(hits >= needed).select("fp", "n", F.col("head.id").alias("id"))


def _sets(rows: DataFrame, alive: DataFrame, words: int, hot: dict[int, int]) -> DataFrame:
    """The whole sets of the classes that are left: `fp, n, tokens, hot, parts`, of which
    `hot` has the very frequent shingles, rarest first."""
    known = np.sort(np.fromiter(hot, np.int64, len(hot)))
    texts_with = np.array([hot[h] for h in known.tolist()], np.int64)
    n_alive = alive.count()
    ids = small_side(alive.select(F.col("id").alias("head_id")).distinct(), 40, n_alive)
    texts = rows.join(ids, F.col("id").eqNullSafe(F.col("head_id")), "left_semi").select("text")

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps, sizes, found = shingle_sets(batch.column("text"), words)
            ranks = _ranks(known, found)
            at = np.flatnonzero(ranks >= 0)
            text = np.repeat(np.arange(len(sizes)), sizes)[at]
            # Sorted already by value, so equal counts stay in that order.
            ranked = found[at[np.lexsort((texts_with[ranks[at]], text))]]
            odd = [np.bincount(s & (PARTS - 1), minlength=PARTS) & 1 for s in np.split(found, np.cumsum(sizes)[:-1])]
            parts = [np.packbits(o.astype(np.uint8)).view(np.int64) for o in odd]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(fps),
                    pa.array(sizes),
                    _lists(sizes, found),
                    _lists(np.bincount(text, minlength=len(sizes)), ranked),
                    pa.array(parts, pa.list_(pa.int64())),
                ],
                names=["fp", "n", "tokens", "hot", "parts"],
            )

    made = texts.mapInArrow(emit, "fp long, n long, tokens array<long>, hot array<long>, parts array<long>")
    sets = stored(made.join(small_side(alive.select("fp"), 40, n_alive), "fp", "left_semi"), "sets")
    # Ids that repeat bring a class's text more than once.
    return sets if sets.count() == n_alive else stored(sets.dropDuplicates(["fp"]), "sets")


def _buckets(sets: DataFrame, num: int, den: int) -> DataFrame:
    """`h, fp, n, pos, parts`: the prefix shingles of each set, rarest first, as far as other
    sets have them too. Very frequent ones come last, and are not counted anew."""
    cold = sets.select("fp", F.explode(F.array_except("tokens", "hot")).alias("h"))
    cold = cold.withColumn("c", F.expr("count(*) OVER (PARTITION BY h)")).filter("c > 1")
    cold = cold.groupBy("fp").agg(F.sort_array(F.collect_list(F.struct("c", "h")))["h"].alias("cold"))
    shared = F.concat(F.coalesce("cold", F.array().cast("array<long>")), "hot")
    rows = sets.join(cold, "fp", "left").select("fp", "n", "parts", shared.alias("shared"))
    prefix = F.col("n") - _least_overlap(F.col("n"), num, den) + 1
    alone = F.col("n") - F.size("shared")
    rows = rows.filter(alone < prefix).select(
        "fp", "n", "parts", alone.alias("alone"), F.slice("shared", F.lit(1), F.greatest(prefix - alone, F.lit(0)).cast("int")).alias("shared")
    )
    rows = rows.select("fp", "n", "parts", "alone", F.posexplode("shared").alias("i", "h"))
    return rows.select("h", "fp", "n", (F.col("alone") + F.col("i")).alias("pos"), "parts")


# --- pairs ---------------------------------------------------------------


def _may_link(x: str, y: str, num: int, den: int) -> Column:
    """Length, positional and suffix filters for two members of a bucket."""
    n, m = F.col(f"{x}.n"), F.col(f"{y}.n")
    # Shingles a linked pair has in common at least.
    needed = num * (n + m)
    length = (n * den >= m * num) & (m * den >= n * num)
    left = F.least(n - F.col(f"{x}.pos"), m - F.col(f"{y}.pos"))
    # Each shingle that only one of them has flips one parity, so they differ by at least
    # as many shingles as parities.
    flips = [F.bit_count(F.col(f"{x}.parts")[i].bitwiseXOR(F.col(f"{y}.parts")[i])) for i in range(PARTS // 64)]
    suffix = sum(flips[1:], flips[0]) * (den + num) <= (n + m) * (den - num)
    return length & (left * (num + den) >= needed) & suffix


def _pair() -> list[Column]:
    return [F.least("x.fp", "y.fp").alias("a"), F.greatest("x.fp", "y.fp").alias("b")]


def _placed(buckets: DataFrame, labels: DataFrame | None) -> tuple[DataFrame, DataFrame]:
    """The buckets that hold several components, with each member's component `c` (at first,
    each member is one of its own); and those members outside their bucket's largest one."""
    if labels is None:
        several = buckets.groupBy("h").agg(F.min("fp").alias("main"), F.count("*").alias("size")).filter("size > 1")
        placed = buckets.withColumn("c", F.col("fp"))
    else:
        placed = buckets.join(labels, F.col("fp") == F.col("v"), "left").withColumn("c", F.coalesce("c", "fp")).drop("v")
        placed = stored(placed, "placed")
        sizes = placed.groupBy("h", "c").agg(F.count("*").alias("size"))
        several = sizes.groupBy("h").agg(F.max(F.struct("size", "c"))["c"].alias("main"), F.count("*").alias("size")).filter("size > 1")
    outside = (F.col("p.h") == F.col("s.h")) & (F.col("p.c") != F.col("s.main"))
    out = placed.alias("p").join(several.alias("s"), outside).select("p.*", "s.main")
    return placed, out


def _stars(placed: tuple[DataFrame, DataFrame], step: int, num: int, den: int) -> DataFrame:
    """Members outside their bucket's main component with one member of it (at first, with
    any one of the bucket)."""
    members, out = placed
    turn = F.xxhash64("fp", F.pmod("h", F.lit(LEADERS)), F.lit(step)).alias("turn")
    mains = out.select("h", F.col("main").alias("c")).distinct()
    leaders = members if step == 0 else members.join(mains, ["h", "c"])
    leaders = leaders.groupBy("h").agg(F.min(F.struct(turn, "fp", "n", "pos", "parts", "c")).alias("x")).select("h", "x.*")
    others = (F.col("x.h") == F.col("y.h")) & (F.col("x.c") != F.col("y.c")) & _may_link("x", "y", num, den)
    met = out if step else members
    return met.alias("y").join(leaders.alias("x"), others).select(*_pair())


def _rest(placed: tuple[DataFrame, DataFrame], num: int, den: int) -> DataFrame:
    """Members outside their bucket's main component with all of other components."""
    members, out = placed
    others = (F.col("x.h") == F.col("y.h")) & (F.col("x.c") != F.col("y.c")) & _may_link("x", "y", num, den)
    return out.alias("x").join(members.alias("y"), others).select(*_pair())


def _verified(pairs: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    left = sets.select(F.col("fp").alias("a"), F.col("n").alias("n"), F.col("tokens").alias("left"))
    right = sets.select(F.col("fp").alias("b"), F.col("n").alias("m"), F.col("tokens").alias("right"))
    both = pairs.join(left, "a").join(right, "b")
    common = F.size(F.array_intersect("left", "right"))
    return both.withColumn("common", common).filter(den * F.col("common") >= num * (F.col("n") + F.col("m") - F.col("common"))).select("a", "b")
