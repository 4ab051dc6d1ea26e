"""How far the sources of a language differ in the words they use, in whole numbers.

The terms that enough documents of a language hold make the columns of a count matrix, its
(language, source) groups the rows. Each group gives each kept term the smoothed share
p = 1 + floor(SCALE * (count + 2) / (total + 2 * terms)); two groups differ on a term by
floor((p - q)^2 / (p + q)), and all together by the sum over all kept terms.

The matrix is cut into tiles of at most ROWS x ROWS pairs of groups and about COLUMNS terms,
which are dealt out over the cluster. In a tile a k^2 tree (k = 2) marks which quadrants hold
a count. Pairs of groups walk it together, from the whole tile downwards: a quadrant that is
zero for both sides has one value for all its terms, known beforehand, and is priced by a
multiplication; others are split, down to single cells. The sums of the tiles are added by
Spark. So the work grows with the cells that hold something, and no task sees more than one
tile however many terms, groups or documents there are.

Counting combines in each task before the shuffle, so a hot group or a frequent term is a few
rows per task. Counts, shares and sums are exact: shares are divided as decimals, and the
square of a difference of two shares fits 64 bits.

Null text, language or source read as ''. A text without terms counts for its group all the
same, and a group without terms has shares like any other. Repeated rows are documents of
their own. Where a language keeps no term, its pairs differ by 0. A language of one source
has no pairs. Equal values rank by item. An empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import bounded, stored

# Documents of a language that hold a term, at least, for it to be kept.
LEAST_DOCUMENTS = 10
# Terms listed per group.
TOP_TERMS = 10
SCALE = 1_000_000_000
# Groups on each side of a tile, and about how many terms it has.
ROWS = 64
COLUMNS = 2048
# Occurrences that a task gathers before it hands their counts on.
_GATHERED = 1 << 20
# Bytes of a text that are split at once, up to the next blank; longer texts are counted alone.
_PIECE = 1 << 20
# Nodes of the tree that are walked at once.
_FRONT = 1 << 18
# Bytes of terms: letters and whatever is not ASCII, A-Z lowered; the others part them.
_FOLD = bytes(b + 32 if 0x41 <= b <= 0x5A else b if 0x61 <= b <= 0x7A or b >= 0x80 else 0x20 for b in range(256))

_TILED = "lang string, source string, part string, item string, value long"


def audit(docs: DataFrame, least_documents: int = LEAST_DOCUMENTS, top: int = TOP_TERMS) -> DataFrame:
    """`lang`, `source`, `part`, `item`, `value`, `rank`: for every group its distance to each other
    source of the language (part `pair`) and the terms it uses most above the language's
    share (part `term`)."""
    bounded(docs.sparkSession)
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    counts = stored(_counts(rows), "divergence-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("df").alias("df")).filter(F.col("df") >= least_documents)
    kept = stored(kept.drop("df"), "divergence-terms")
    cells = stored(counts.drop("df").join(kept, ["lang", "term"]), "divergence-cells")
    groups = stored(_groups(rows, cells, kept), "divergence-groups")
    tiled = stored(_tiled(cells, groups, kept, top), "divergence-tiles")
    pairs = tiled.filter("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    terms = tiled.filter("part = 'term'").withColumn("rank", place).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", place).unionByName(terms)


def _terms(text: bytes) -> Iterator[bytes]:
    """The terms of a text, split piece by piece so that long texts need little room."""
    folded, begin = text.translate(_FOLD), 0
    while begin < len(folded):
        cut = folded.find(b" ", begin + _PIECE)
        end = len(folded) if cut < 0 else cut
        yield from folded[begin:end].split()
        begin = end


def _split(texts: pa.BinaryArray) -> pa.ListArray:
    """The terms of each text and empty ones around them. Folding leaves every byte in place, so
    all texts are folded at once."""
    _, offsets, data = texts.buffers()
    folded = pa.py_buffer(data.to_pybytes().translate(_FOLD) if data else b"")
    return pc.ascii_split_whitespace(pa.Array.from_buffers(pa.string(), len(texts), [None, offsets, folded], 0, texts.offset))


def _summed(langs: pa.Array, sources: pa.Array, terms: pa.ListArray) -> list[pa.Array]:
    """Groups and terms with their occurrences and the documents that hold them, by two sorts
    of whole numbers: of (document, term), then of (group, term)."""
    lang, source = langs.dictionary_encode(), sources.dictionary_encode()
    held = len(source.dictionary)
    group = lang.indices.to_numpy().astype(np.int64) * held + source.indices.to_numpy()
    coded = terms.flatten().dictionary_encode()
    width = max(len(coded.dictionary), 1)
    doc = np.repeat(np.arange(len(terms), dtype=np.int64), pc.list_value_length(terms).to_numpy())
    code = coded.indices.to_numpy()
    if (empty := coded.dictionary.index("").as_py()) >= 0:
        some = code != empty
        doc, code = doc[some], code[some]
    at, n = np.unique(doc * width + code, return_counts=True)
    pair = group[at // width] * width + at % width
    order = np.argsort(pair, kind="stable")
    pair = pair[order]
    first = np.flatnonzero(np.diff(pair, prepend=-1))
    n = np.add.reduceat(n[order], first) if len(first) else n
    df = np.diff(first, append=len(pair))
    of, term = pair[first] // width, pair[first] % width
    return [lang.dictionary.take(pa.array(of // held)), source.dictionary.take(pa.array(of % held)), coded.dictionary.take(pa.array(term)), pa.array(n), pa.array(df)]


def _counts(rows: DataFrame) -> DataFrame:
    """Occurrences of each term in each group, and documents that hold it."""
    most, piece = _GATHERED, _PIECE
    names = ["lang", "source", "term", "n", "df"]

    def alone(lang: str, source: str, text: bytes) -> pa.RecordBatch:
        found: dict[bytes, int] = {}
        for term in _terms(text):
            found[term] = found.get(term, 0) + 1
        of = [pa.array([value] * len(found), pa.string()) for value in (lang, source)]
        terms = pa.array([term.decode() for term in found], pa.string())
        return pa.RecordBatch.from_arrays([*of, terms, pa.array(found.values(), pa.int64()), pa.array([1] * len(found), pa.int64())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gathered: list[tuple[pa.Array, pa.Array, pa.ListArray]] = []
        size = 0
        for batch in batches:
            fits = pc.less_equal(pc.binary_length(batch.column(2)), piece)
            for row in batch.filter(pc.invert(fits)).to_pylist():
                yield alone(*row.values())
            batch = batch.filter(fits)
            terms = _split(batch.column(2))
            gathered.append((batch.column(0), batch.column(1), terms))
            size += len(terms.values)
            if size >= most:
                yield pa.RecordBatch.from_arrays(_summed(*map(pa.concat_arrays, zip(*gathered, strict=True))), names)
                gathered, size = [], 0
        if gathered:
            yield pa.RecordBatch.from_arrays(_summed(*map(pa.concat_arrays, zip(*gathered, strict=True))), names)

    parts = rows.withColumn("text", F.col("text").cast("binary")).mapInArrow(run, "lang string, source string, term string, n long, df long")
    return parts.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("df").alias("df"))


def _share(n: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (n + 2) / (total + 2 * terms)), divided as decimals."""
    over = (n + 2).cast("decimal(19,0)") * F.lit(SCALE).cast("decimal(10,0)")
    return F.call_function("div", over, (total + 2 * terms).cast("decimal(20,0)")) + 1


def _groups(rows: DataFrame, cells: DataFrame, kept: DataFrame) -> DataFrame:
    """Every group with its total, its share of an absent term, and its language's figures."""
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    groups = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").fillna(0, ["total"])
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"), F.sum("lang_n").alias("lang_total"))
    sized = groups.groupBy("lang").agg(F.count(F.lit(1)).alias("groups")).join(langs, "lang", "left").fillna(0, ["terms", "lang_total"])
    strips, bands = F.greatest(F.ceil(F.col("terms") / COLUMNS), F.lit(1)), F.greatest(F.ceil(F.col("groups") / ROWS), F.lit(1))
    found = groups.join(sized.withColumns({"strips": strips, "bands": bands}), "lang")
    # Without a kept term there is nothing to share out.
    absent = F.when(F.col("terms") > 0, _share(F.lit(0).cast("long"), F.col("total"), F.col("terms")))
    return found.withColumn("p0", F.coalesce(absent, F.lit(0).cast("long")))


def _tiled(cells: DataFrame, groups: DataFrame, kept: DataFrame, top: int) -> DataFrame:
    """The sums of every tile for its pairs of groups, and its terms that a group uses most.

    A tile's rows are its groups, without a term and with the strip's number of terms as
    `q`, and its counts.
    """
    strip = F.pmod(F.xxhash64("term"), F.col("strips"))
    band = F.pmod(F.xxhash64("source"), F.col("bands"))
    partners = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bands") - 1))
    at = [F.least("band", "partner").alias("upper"), F.greatest("band", "partner").alias("lower")]
    heads = groups.withColumns({"band": band, "partner": partners}).withColumn("strip", F.explode(F.sequence(F.lit(0).cast("long"), F.col("strips") - 1)))
    strips = kept.join(groups.select("lang", "strips").distinct(), "lang").groupBy("lang", strip.alias("strip")).agg(F.count(F.lit(1)).alias("q"))
    heads = heads.join(strips, ["lang", "strip"], "left").fillna(0, ["q"])
    heads = heads.select("lang", "strip", *at, "source", "band", F.lit(None).cast("string").alias("term"), F.col("p0").alias("p"), "q")
    held = cells.join(groups, ["lang", "source"]).withColumns(
        {
            "p": _share(F.col("n"), F.col("total"), F.col("terms")),
            "q": _share(F.col("lang_n"), F.col("lang_total"), F.col("terms")),
            "strip": strip,
            "band": band,
            "partner": partners,
        }
    )
    tiles = heads.unionByName(held.select("lang", "strip", *at, "source", "band", "term", "p", "q"))

    def priced(key: tuple[pa.Scalar, ...], rows: pa.Table) -> pa.Table:
        return _tile(rows, key[2].as_py(), key[3].as_py(), top)

    return tiles.groupBy("lang", "strip", "upper", "lower").applyInArrow(priced, _TILED)


def _tile(rows: pa.Table, upper: int, lower: int, top: int) -> pa.Table:
    lang = rows["lang"][0].as_py()
    head = rows.filter(rows["term"].is_null())
    cells = rows.filter(rows["term"].is_valid())
    sources = sorted(zip(head["band"].to_pylist(), head["source"].to_pylist(), head["p"].to_pylist(), strict=True))
    place = {source: i for i, (_, source, _) in enumerate(sources)}
    names = [source for _, source, _ in sources]
    p0 = np.array([p for *_, p in sources], dtype=np.int64)
    at = np.array([place[s] for s in cells["source"].to_pylist()], dtype=np.int64)
    coded = cells["term"].combine_chunks().dictionary_encode()
    code, terms = coded.indices.to_numpy().astype(np.int64), coded.dictionary.to_pylist()
    # Terms of many groups first: what is left empty then lies together.
    order = np.argsort(-np.bincount(code, minlength=len(terms)), kind="stable")
    column = np.empty(len(terms), dtype=np.int64)
    column[order] = np.arange(len(terms))
    shares = np.repeat(p0[:, None], len(terms), axis=1)
    shares[at, column[code]] = cells["p"].to_numpy()
    filled = np.zeros(shares.shape, dtype=bool)
    filled[at, column[code]] = True
    first = sum(band == upper for band, *_ in sources) if upper != lower else 0
    sums = joint_sums(shares, filled, p0, first)
    # Terms of the strip that only groups of other tiles hold.
    if absent := head["q"][0].as_py() - len(terms):
        sums += absent * distance(p0[:, None], p0[None, :])
    out = []
    for i, j in zip(*np.nonzero(np.triu(np.ones(sums.shape, dtype=bool), 1)), strict=True):
        if not first or i < first <= j:
            out.append((names[i], "pair", names[j], int(sums[i, j])))
            out.append((names[j], "pair", names[i], int(sums[i, j])))
    if upper == lower:
        p, q = cells["p"].to_numpy(), cells["q"].to_numpy()
        above = np.flatnonzero(p > q)
        value = distance(p[above], q[above])
        best: dict[int, list[tuple[int, str]]] = {}
        for row, v, c in zip(at[above].tolist(), value.tolist(), code[above].tolist(), strict=True):
            best.setdefault(row, []).append((-v, terms[c]))
        out += [(names[row], "term", term, -v) for row, found in best.items() for v, term in sorted(found)[:top]]
    columns = list(zip(*out, strict=True)) or [[]] * 4
    kinds = (pa.string(), pa.string(), pa.string(), pa.int64())
    arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
    return pa.Table.from_arrays([pa.array([lang] * len(out), pa.string()), *arrays], names=["lang", "source", "part", "item", "value"])


def distance(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """floor((p - q)^2 / (p + q)) of shares up to SCALE + 1, which 64 bits hold."""
    return (p - q) * (p - q) // (p + q)


def joint_sums(shares: np.ndarray, filled: np.ndarray, p0: np.ndarray, first: int = 0) -> np.ndarray:
    """Sum of the distances of every pair of rows i < j over all columns, by a joint walk
    down the k^2 tree of `filled`. With `first`, only pairs of a row before it and one not."""
    rows, columns = filled.shape
    sums = np.zeros((rows, rows), dtype=np.int64)
    if not columns or rows < 2:
        return sums
    # levels[l][i, k]: whether the quadrant of 2^l rows and columns holds anything.
    levels = [filled]
    while max(levels[-1].shape) > 1:
        last = levels[-1]
        last = np.pad(last, ((0, last.shape[0] % 2), (0, last.shape[1] % 2)))
        levels.append(last[::2, ::2] | last[1::2, ::2] | last[::2, 1::2] | last[1::2, 1::2])
    empty = [np.zeros((x.shape[0], x.shape[0]), dtype=np.int64) for x in levels]
    stack = [(len(levels) - 1, *(np.zeros(1, dtype=np.int64) for _ in range(3)))]
    while stack:
        level, i, j, k = stack.pop()
        held = levels[level][i, k] | levels[level][j, k]
        wide = np.minimum((k + 1) << level, columns) - (k << level)
        np.add.at(empty[level], (i[~held], j[~held]), wide[~held])
        i, j, k = i[held], j[held], k[held]
        if not level:
            np.add.at(sums, (i, j), distance(shares[i, k], shares[j, k]))
            continue
        bits = np.arange(8)
        i = (2 * i[:, None] + (bits & 1)).ravel()
        j = (2 * j[:, None] + (bits >> 1 & 1)).ravel()
        k = (2 * k[:, None] + (bits >> 2)).ravel()
        high, wide = levels[level - 1].shape
        wanted = (i < high) & (j < high) & (k < wide) & ((i < j) if level == 1 else (i <= j))
        if first:
            # Only quadrants that reach both sides.
            wanted &= (i << (level - 1) < first) & ((j + 1) << (level - 1) > first)
        i, j, k = i[wanted], j[wanted], k[wanted]
        stack += [(level - 1, i[s : s + _FRONT], j[s : s + _FRONT], k[s : s + _FRONT]) for s in range(0, len(i), _FRONT)]
    zero = distance(p0[:, None], p0[None, :])
    for level, counted in enumerate(empty):
        whole = np.repeat(np.repeat(counted, 1 << level, axis=0), 1 << level, axis=1)[:rows, :rows]
        sums += whole * zero
    return sums
