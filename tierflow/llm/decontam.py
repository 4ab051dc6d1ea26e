"""Benchmark decontamination (operator 4), in DataFrame functions only.

Benchmark items are cut into windows of `window` words (a shorter item is one window). A
document is contaminated where it holds a whole window, that is where the window's shingles
are contained entirely. This is a prefix-filtered set join:

* the shingles of a window are ordered by how often they occur in all documents, rarest
  first. As containment must be complete, the necessary prefix is one shingle: a document
  that lacks the window's rarest shingle cannot hold the window. Windows whose rarest shingle
  occurs nowhere are dropped at once;
* the documents' shingles are joined with those prefixes. The shingle's offset in its window
  and its place in the document fix where the window would have to stand: it must begin
  within the text (positional bound) and end within it (length bound);
* candidates are verified word by word, once.

Documents are scanned twice (frequencies, join) and never shuffled; what is shuffled is one
row per document and one per verified occurrence. The benchmark side is broadcast only up
to a checked size. Beyond it the prefixes' keys alone are broadcast, again up to a checked
size, and what they admit is shuffled, a place with the few words around it.

Words are runs of ASCII letters and digits and of any non-ASCII characters; A-Z is folded.

Defined results: null and empty texts have no words and no hits. Items without id or words
take no part; texts of items that share an id all count for it. Every row of `docs` gives one
row; rows that are equal in id and text give equal ones. Without items nothing is hit.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import fits_broadcast, small_side, stored

WINDOW = 10
# Words of a shingle; windows of fewer words are one shingle.
SHINGLE = 3
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
# Bytes of a window in memory besides its words and the ids of its items, and of such an id
# besides its characters.
_WINDOW_BYTES, _ITEM_BYTES = 200, 24


def contamination(
    docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text", window: int = WINDOW
) -> DataFrame:
    """`id, fp, n_words, n_hit, items` for each row of `docs`: its id, a hash of its text, its
    words, those inside occurrences of windows, and the sorted ids of the items they are from."""
    positions, lengths = _positions(docs, doc_id, text), range(1, min(SHINGLE, window) + 1)
    windows = stored(_windows(items, item_id, text, window), "windows")
    sizes = windows.agg(F.count("*"), F.collect_set(F.least("w", F.lit(SHINGLE)))).first()
    lengths = [n for n in lengths if n in sizes[1]]
    prefixes = stored(_prefixes(windows, _frequencies(positions, windows, lengths, sizes[0])), "prefixes")
    found = _candidates(_keyed(positions, lengths), prefixes, window)
    start = F.col("pos") - F.col("offset")
    at = start - F.col("skipped")
    fits = (start >= 1) & (at + F.col("w") <= F.size("words"))
    same = _folded(F.array_join(F.slice("words", at + 1, F.col("w")), " ")) == F.col("window")
    # The place before the first word stands for the document itself.
    own = F.col("pos") == 0
    hit = F.struct(start.alias("start"), (start + F.col("w")).alias("end"))
    rows = found.filter(own | F.when(fits, same)).select(
        "id", "fp", "n_words", F.when(~own, hit).alias("hit"), F.when(~own, F.col("items")).alias("items")
    )
    per_text = rows.groupBy("id", "fp").agg(
        F.max("n_words").alias("n_words"),
        F.count_if(F.col("hit").isNull()).alias("copies"),
        F.array_sort(F.collect_set("hit")).alias("hits"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"),
    )
    return per_text.select(
        "id", "fp", "n_words", _covered("hits").alias("n_hit"), "items", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))
    ).drop("col")


def clean(docs: DataFrame, items: DataFrame, doc_id: str = "doc_id", item_id: str = "item_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no window of any item."""
    hit = contamination(docs, items, doc_id, item_id, text).filter("n_hit > 0").select("id", "fp").distinct()
    hit = small_side(stored(hit, "contaminated"), 64)
    mine = F.col(f"d.`{doc_id}`").eqNullSafe(F.col("h.id")) & (_fingerprint(F.col(f"d.`{text}`")) == F.col("h.fp"))
    return docs.alias("d").join(hit.alias("h"), mine, "left_anti")


def _fingerprint(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _folded(text: Column) -> Column:
    return F.translate(text, UPPER, UPPER.lower())


def _positions(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """A row for each word and one before the first: the blank in front makes it."""
    rows = docs.select(F.col(doc_id).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("t"))
    rows = rows.select("id", _fingerprint(F.col("t")).alias("fp"), F.split(F.concat(F.lit(" "), "t"), _BETWEEN).alias("words"))
    n_words = F.size("words") - 1 - F.when(F.size("words") > 1, (F.element_at("words", -1) == "").cast("int")).otherwise(0)
    rows = rows.withColumn("n_words", n_words.cast("long"))
    return rows.select("id", "fp", "n_words", "words", F.posexplode_outer("words").alias("pos", "word"))


def _keyed(positions: DataFrame, lengths: Sequence[int]) -> DataFrame:
    """The keys of the shingles that begin at each place; none at the document's own row."""
    words = [F.lower("word"), *[F.lower(F.get("words", F.col("pos") + i)) for i in range(1, SHINGLE)]]
    keys = [F.when(F.col("pos") > 0, F.xxhash64(F.lit(n), *words[:n])) for n in lengths]
    if len(keys) <= 1:
        return positions.withColumn("key", keys[0] if keys else F.lit(None).cast("long")).drop("word")
    listed = F.when(F.col("pos") > 0, F.array(*keys)).otherwise(F.array(F.lit(None).cast("long")))
    return positions.withColumn("key", F.explode(listed)).drop("word")


def _candidates(keyed: DataFrame, prefixes: DataFrame, window: int) -> DataFrame:
    """The documents' places, each with the windows whose prefix begins there. `skipped` is
    how many of the text's words are missing before `words`."""
    ids = F.aggregate("items", F.lit(0).cast("long"), lambda total, x: total + F.octet_length(x) + _ITEM_BYTES)
    n, size = prefixes.agg(F.count("*"), F.sum(F.octet_length("window") + ids + F.lit(_WINDOW_BYTES))).first()
    if fits_broadcast(1, size or 0):
        return keyed.join(F.broadcast(prefixes), "key", "left").withColumn("skipped", F.lit(0))
    keys = small_side(prefixes.select("key", F.lit(True).alias("known")).distinct(), 64, n)
    rows = keyed.join(keys, "key", "left").filter("pos = 0 OR known")
    skipped = F.greatest(F.col("pos") - F.lit(window - 1), F.lit(0))
    around = F.slice("words", skipped + 1, F.col("pos") - skipped + window)
    # Rows of documents match nothing, and are spread instead of sharing one key.
    key = F.when(F.col("pos") == 0, F.xxhash64("id", "fp")).otherwise(F.col("key"))
    rows = rows.select("id", "fp", "n_words", "pos", key.alias("key"), skipped.alias("skipped"), around.alias("words"))
    return rows.join(prefixes, (rows["key"] == prefixes["key"]) & (F.col("pos") > 0), "left").drop(prefixes["key"])


def _windows(items: DataFrame, item_id: str, text: str, window: int) -> DataFrame:
    """The distinct windows, their numbers of words, and the items that hold them."""
    words = F.filter(F.split(_folded(F.col(text)), _BETWEEN), lambda w: w != "")
    rows = items.select(F.col(item_id).cast("string").alias("item"), words.alias("words")).dropna()
    last = F.greatest(F.size("words") - window, F.lit(0))
    rows = rows.filter(F.size("words") > 0).select("item", "words", F.explode(F.sequence(F.lit(0), last)).alias("at"))
    rows = rows.select("item", F.slice("words", F.col("at") + 1, window).alias("part"))
    return rows.groupBy("part").agg(F.collect_set("item").alias("items")).select(
        F.array_join("part", " ").alias("window"), F.size("part").alias("w"), "part", "items"
    )


def _shingles(windows: DataFrame) -> DataFrame:
    n = F.least("w", F.lit(SHINGLE))
    at = F.explode(F.sequence(F.lit(0), F.col("w") - n))
    rows = windows.select("window", "w", "part", n.alias("n"), at.alias("offset"))
    words = [F.lower(F.get("part", F.col("offset") + i)) for i in range(SHINGLE)]
    key = F.coalesce(*[F.when(F.col("n") == n, F.xxhash64(F.lit(n), *words[:n])) for n in range(1, SHINGLE + 1)])
    return rows.select("window", "offset", key.alias("key"))


def _frequencies(positions: DataFrame, windows: DataFrame, lengths: Sequence[int], n_windows: int) -> DataFrame:
    """How often each shingle of the windows occurs in all documents."""
    wanted = _shingles(windows).select("key").distinct()
    keys = _keyed(positions, lengths).filter("pos > 0").select("key")
    hits = keys.join(small_side(wanted, 64, n_windows * WINDOW), "key", "left_semi")
    return hits.groupBy("key").agg(F.count("*").alias("df"))


def _prefixes(windows: DataFrame, frequencies: DataFrame) -> DataFrame:
    """Each window that can occur, under its rarest shingle."""
    ranked = _shingles(windows).join(frequencies, "key", "left")
    rarest = ranked.groupBy("window").agg(
        F.min(F.struct(F.coalesce("df", F.lit(0)).alias("df"), F.col("key"), F.col("offset"))).alias("s")
    )
    rarest = rarest.filter("s.df > 0").select("window", "s.key", "s.offset")
    return windows.select("window", "w", "items").join(rarest, "window")


def _covered(hits: str) -> Column:
    """Words inside a sorted list of intervals."""
    zero = F.struct(F.lit(0).cast("long").alias("n"), F.lit(0).alias("end"))
    step = lambda a, h: F.struct(
        (a["n"] + F.greatest(h["end"] - F.greatest(h["start"], a["end"]), F.lit(0))).alias("n"), F.greatest(h["end"], a["end"]).alias("end")
    )
    return F.aggregate(hits, zero, step, lambda a: a["n"])
