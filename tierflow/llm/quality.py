"""Quality classifier (operator 7).

Statistics of whole texts, random Fourier features that approximate a Gaussian kernel over
them, a ridge regression on the labels, and an isotonic calibration of its scores.

* statistics: lengths, shares of byte classes, repetition of words and lines;
* each task sums Phi'Phi and Phi'y over its labelled rows; Spark adds the sums entry by
  entry, and the driver solves one system of `FEATURES` unknowns;
* one fold of the labelled rows is kept from the fit and calibrates: its scores are counted
  in `BINS` bins, over which pool-adjacent-violators gives a monotone chance of label 1.

All labelled rows take part. `figures` makes statistics once and stores them, where only ids and
scores are wanted. `classify`, which hands texts on, makes those of labelled texts to learn from
and those of all texts to score; the labelled ids are broadcast up to a checked size, beyond
it all statistics are made twice.

Defined results: null and empty texts have statistics too (all zero) and get a score. Rows
without label, or of an id that `labels` lacks, are scored only; ids that repeat in either
table pair with each other. Without labelled rows every score is 0.5. Repeated rows are
scored each.
"""

from __future__ import annotations

import operator
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import fits_broadcast, fresh, stored, texts_of, with_columns

STATISTICS = (
    "log_words", "word_length", "distinct_words", "repeated_next", "distinct_lines", "log_line_words",
    "upper", "lower", "digit", "space", "full_stop_comma", "mark", "pipe", "symbol", "beyond_ascii", "longest_word",
)
FEATURES = 384
SEED = 7
# Bytes of an id in a broadcast.
_ID_BYTES = 64
# Width of the Gaussian kernel, in standard deviations over all statistics.
WIDTH = 3.0
RIDGE = 1e-4
BINS = 1000
# Of so many folds of the labelled rows, one calibrates.
CALIBRATION_FOLDS = 4
# Characters of a text whose words are held at once, to the end of the last word.
BLOCK = 1 << 21
_BLANK, _LINE_END = re.compile(r"\s"), re.compile("\n")


@dataclass(frozen=True)
class Model:
    mean: np.ndarray
    spread: np.ndarray
    weights: np.ndarray
    edges: np.ndarray  # raw scores, ascending
    chances: np.ndarray

    def raw(self, x: np.ndarray) -> np.ndarray:
        return _phi((x - self.mean) / self.spread) @ self.weights

    def score(self, x: np.ndarray) -> np.ndarray:
        return np.clip(np.interp(self.raw(x), self.edges, self.chances), 0.0, 1.0)


def _pieces(text: str, end: re.Pattern[str]) -> Iterator[str]:
    """The text in pieces of about `BLOCK` characters, each up to a place where `end` matches."""
    begin = 0
    while begin < len(text):
        cut = end.search(text, begin + BLOCK)
        stop = cut.end() if cut else len(text)
        yield text[begin:stop]
        begin = stop


def statistics(text: str | None) -> list[float]:
    """Figures of one whole text, in the order of `STATISTICS`."""
    text = text or ""
    raw = text.encode("utf-8", "replace")
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    total = max(1, len(raw))
    n = chars = again = longest = 0
    distinct: set[int] = set()
    lines: set[int] = set()
    n_lines = 0
    last: str | None = None
    for piece in _pieces(text, _BLANK):
        words = piece.split()
        if not words:
            continue
        n += len(words)
        sizes = list(map(len, words))
        chars += sum(sizes)
        longest = max(longest, max(sizes))
        again += sum(map(operator.eq, words, words[1:])) + (words[0] == last)
        last = words[-1]
        distinct.update(map(hash, set(words)))
    for piece in _pieces(text, _LINE_END):
        found = [x for x in piece.split("\n") if x]
        n_lines += len(found)
        lines.update(map(hash, found))
    # Roots spread small shares, where a little junk shows.
    share = lambda part: float(np.sqrt(counts[part].sum() / total))
    return [
        float(np.log1p(n)),
        chars / max(1, n),
        len(distinct) / max(1, n) ** 0.75,
        float(np.sqrt(again / max(1, n))),
        len(lines) / max(1, n_lines),
        float(np.log1p(n / max(1, n_lines))),
        share(slice(65, 91)),
        share(slice(97, 123)),
        share(slice(48, 58)),
        share([9, 10, 13, 32]),
        share([44, 46]),
        share([33, 63]),
        share(124),
        share([35, 36, 37, 38, 42, 43, 47, 60, 61, 62, 64, 92, 94, 95, 96, 123, 125, 126]),
        share(slice(128, 256)),
        float(np.log1p(longest)),
    ]


def with_statistics(docs: DataFrame, text: str = "text", name: str = "statistics") -> DataFrame:
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array([statistics(t) for t in texts_of(batch, text)], pa.list_(pa.float64()))]

    return with_columns(docs, [T.StructField(name, T.ArrayType(T.DoubleType()))], compute)


def figures(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Id and statistics of each row, stored."""
    return stored(with_statistics(docs.select(doc_id, text), text).select(doc_id, "statistics"), "statistics")


def train(figures: DataFrame, labels: DataFrame, doc_id: str, label: str, where: Column, x: str = "statistics") -> Model | None:
    """A model from the rows of `figures` (id and statistics) that `where` admits and that
    have a label in `labels`."""
    known = labels.select(F.col(doc_id).alias("label_id"), F.col(label).cast("double").alias("y")).dropna()
    rows = figures.filter(where).join(known, F.col(doc_id) == F.col("label_id"))
    # Folds by content: equal texts stay together.
    fold = F.pmod(F.xxhash64(x), F.lit(CALIBRATION_FOLDS))
    rows = stored(rows.select(F.col(x).alias("x"), "y", (fold == 0).alias("held")), "labelled")
    size = len(STATISTICS)
    moments = rows.select("x").agg(
        F.count("*"), *[F.avg(F.col("x")[i]) for i in range(size)], *[F.stddev_pop(F.col("x")[i]) for i in range(size)]
    )
    n, *rest = moments.first()
    if not n:
        return None
    mean, spread = np.array(rest[:size], float), np.maximum(np.array(rest[size:], float), 1e-6)
    if rows.filter("NOT held").isEmpty() or rows.filter("held").isEmpty():
        rows = rows.withColumn("held", F.lit(None).cast("boolean"))  # too few to part: all do both
    fit = rows.filter("held IS NULL OR NOT held")
    weights = _solve(fit, mean, spread)
    model = Model(mean, spread, weights, np.zeros(1), np.zeros(1))
    edges, chances = _calibrate(rows.filter("held IS NULL OR held"), model)
    return Model(mean, spread, weights, edges, chances)


def score(figures: DataFrame, model: Model | None, x: str = "statistics", name: str = "score") -> DataFrame:
    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if model is None:
            return [pa.array([0.5] * batch.num_rows)]
        return [pa.array(model.score(_matrix(batch, x)))]

    return with_columns(figures, [T.StructField(name, T.DoubleType())], compute)


def classify(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "quality", where: Column | None = None) -> tuple[DataFrame, str]:
    """All columns of `docs` and a score; the second value is that column's name."""
    known = labels.select(F.col(doc_id).alias("label_id"), F.col(label).alias("y")).dropna().select("label_id").distinct()
    known = stored(known, "labelled-ids")
    marked = docs.select(doc_id, text)
    if fits_broadcast(known.count(), _ID_BYTES):
        marked = marked.join(F.broadcast(known), F.col(doc_id) == F.col("label_id"), "left_semi")
    model = train(figures(marked, doc_id, text), labels, doc_id, label, F.lit(True) if where is None else where)
    name = fresh(docs.columns, "score")

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if model is None:
            return [pa.array([0.5] * batch.num_rows)]
        x = np.array([statistics(t) for t in texts_of(batch, text)], float).reshape(batch.num_rows, len(STATISTICS))
        return [pa.array(model.score(x))]

    return with_columns(docs, [T.StructField(name, T.DoubleType())], compute), name


def _matrix(batch: pa.RecordBatch, x: str) -> np.ndarray:
    column = batch.column(batch.schema.get_field_index(x))
    return np.asarray(column.flatten(), float).reshape(batch.num_rows, len(STATISTICS))


def _phi(x: np.ndarray) -> np.ndarray:
    """Random Fourier features of exp(-|x - y|^2 / 2 width^2), and a constant."""
    random = np.random.default_rng(SEED)
    directions = random.normal(size=(x.shape[1], FEATURES - 1)) / WIDTH
    phases = random.uniform(0, 2 * np.pi, FEATURES - 1)
    waves = np.sqrt(2.0 / (FEATURES - 1)) * np.cos(np.clip(x, -10, 10) @ directions + phases)
    return np.hstack([waves, np.ones((len(x), 1))])


def _solve(rows: DataFrame, mean: np.ndarray, spread: np.ndarray) -> np.ndarray:
    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((FEATURES, FEATURES + 2))
        for batch in batches:
            phi = _phi((_matrix(batch, "x") - mean) / spread)
            y = np.asarray(batch.column(1), float)
            total += phi.T @ np.column_stack([phi, y, np.ones(len(y))])
        yield pa.RecordBatch.from_arrays([pa.array(range(FEATURES), pa.int32()), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "row"])

    parts = rows.select("x", "y").mapInArrow(sums, "i int, row array<double>")
    added = parts.groupBy("i").agg(F.array(*[F.sum(F.col("row")[j]) for j in range(FEATURES + 2)]).alias("row"))
    total = np.zeros((FEATURES, FEATURES + 2))
    for i, row in added.collect():
        total[i] = row
    n = max(1.0, total[-1, -1])
    gram, target = total[:, :FEATURES] / n, total[:, FEATURES] / n
    return np.linalg.solve(gram + RIDGE * np.diag([1.0] * (FEATURES - 1) + [1e-9]), target)


def _calibrate(rows: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray]:
    def raw(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(model.raw(_matrix(batch, "x")))]

    scored = with_columns(rows.select("x", "y"), [T.StructField("raw", T.DoubleType())], raw).select("y", "raw")
    # Ridge scores of 0/1 labels lie about this range; what is beyond falls in the end bins.
    place = F.least(F.greatest(F.floor((F.col("raw") + 0.5) / 2 * BINS), F.lit(0)), F.lit(BINS - 1))
    bins = scored.groupBy(place.alias("bin")).agg(F.count("*").alias("n"), F.sum("y").alias("y"), F.avg("raw").alias("raw")).toPandas().sort_values("bin")
    blocks: list[list[float]] = []  # weight, chance, first and last score
    for n, y, at in zip(bins["n"], bins["y"], bins["raw"], strict=True):
        blocks.append([n, y / n, at, at])
        while len(blocks) > 1 and blocks[-2][1] >= blocks[-1][1]:
            w, c, _, last = blocks.pop()
            m, d, first, _ = blocks.pop()
            blocks.append([m + w, (m * d + w * c) / (m + w), first, last])
    edges = np.array([b[k] for b in blocks for k in (2, 3)])
    chances = np.array([b[1] for b in blocks for _ in range(2)])
    return edges, chances
