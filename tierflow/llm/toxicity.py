"""Toxicity by a string-kernel support vector machine (operator 9).

The kernel compares two words by their common subsequences of three characters: each
occurrence counts by a power of the span it covers (`DECAY`), up to `SPAN` characters, so
gaps and inserted characters cost weight but do not hide a word. Words of single letters in
a row ("i d i o t") are read as one.

* labelled sentences: a bounded, hashed sample of labelled documents. A label belongs to a
  document, an insult is a word; so each toxic document names a witness, its word with the
  beginning that most toxic and few clean documents have. Witnesses and gapped forms of
  them are the positive words; words of clean documents are the negative ones, and those the
  first machine scores highest are added for the second (hard negatives).
* Nyström landmarks: witnesses and hard negatives. The machine is linear in the landmarks'
  features, and both are folded into one weight per subsequence, so a word is scored by one
  pass over its subsequences.
* a text's score is that of its highest word, mapped to a chance by a logistic curve that is
  fitted on sampled documents kept out of the training.

Every text is scored whole; only the fit is bounded (`TOXIC_DOCS`, `CLEAN_DOCS`, `WORDS`).

Defined results: null, empty and blank texts have the lowest score. Without labelled rows of
both kinds every score is 0. Ids that repeat pair with each of their labels; repeated rows
are scored each.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import stored, texts_of, uniform, with_columns

DECAY = 0.8
SPAN = 7
BITS = 20
# Longer words are read as overlapping pieces of this length.
PIECE, OVERLAP = 32, 8
# Bounds of the fit: documents of each label, words of each kind, landmarks.
TOXIC_DOCS, CLEAN_DOCS = 2500, 8000
WORDS = 12_000
HARD = 2000
LANDMARKS = 320
# A telling part of a word is so many times as frequent among toxic documents as among clean
# ones, and beyond chance by this margin; a witness's part is that of so many documents.
LEAST_ODDS = 8.0
MARGIN = 2.0
SAME = 0.8
LEAST_TOXIC = 2
GRAMS = 5000
# Characters put between letters in the gapped forms that the machine also learns.
GAPS = ".*-_"
COST = 30.0
# Scores a worker remembers, in two generations; characters of texts looked up at once.
REMEMBERED = 500_000
BLOCK = 1 << 21

_OFFSETS = [(a, b) for a in range(1, SPAN - 1) for b in range(1, SPAN - a)]


@dataclass(frozen=True)
class Model:
    table: np.ndarray  # a weight for each hashed subsequence
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def words(self, words: Sequence[str]) -> np.ndarray:
        """The machine's value for each word."""
        out = np.full(len(words), -np.inf)
        for owner, keys, weights in _subsequences(words):
            value = (self.table[keys] * weights).sum(axis=1)
            np.maximum.at(out, owner, value)
        return np.where(np.isfinite(out), out, 0.0) + self.bias

    def chance(self, raw: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * raw + self.shift, -50, 50)))


def units(text: str | None) -> set[str]:
    """The distinct words of a text in lower case; single letters in a row are one word."""
    found = (text or "").lower().split()
    out = set(found)
    run: list[str] = []
    if any(len(w) == 1 for w in out):
        for w in [*found, "  "]:
            if len(w) == 1:
                run.append(w)
            else:
                if len(run) > 2:
                    out.add("".join(run))
                run.clear()
    return out


def _pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - OVERLAP, PIECE - OVERLAP)]


def _subsequences(words: Sequence[str]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For groups of words of like length: which word each row is of, its hashed
    subsequences, and their weights, scaled to a norm that hangs on the length."""
    by_length: dict[int, tuple[list[int], list[str]]] = {}
    for i, word in enumerate(words):
        for piece in _pieces(word):
            owner, group = by_length.setdefault(len(piece), ([], []))
            owner.append(i)
            group.append(piece)
    for length, (owner, group) in by_length.items():
        if length < 3:
            continue
        at = [(i, i + a, i + a + b) for a, b in _OFFSETS for i in range(length - a - b)]
        spans = np.array([z - x + 1 for x, _, z in at], float)
        weights = DECAY**spans
        weights = (weights / np.sqrt((weights**2).sum())).astype(np.float32)
        x, y, z = np.array(at).T
        for a in range(0, len(group), 1 << 13):
            part = group[a : a + (1 << 13)]
            codes = np.frombuffer("".join(part).encode("utf-32-le", "surrogatepass"), np.uint32).reshape(len(part), length)
            keys = codes[:, x] * np.uint32(0x9E3779B1)
            keys += codes[:, y]
            keys *= np.uint32(0x85EBCA77)
            keys += codes[:, z]
            keys *= np.uint32(0xC2B2AE3D)
            keys ^= keys >> np.uint32(15)
            keys *= np.uint32(0x27D4EB2F)
            keys >>= np.uint32(32 - BITS)
            yield np.asarray(owner[a : a + len(part)]), keys, weights


def _rows(words: Sequence[str]) -> list[dict[int, float]]:
    """The subsequence weights of each word, of no more than a piece."""
    out: list[dict[int, float]] = [{} for _ in words]
    for owner, keys, weights in _subsequences(words):
        for o, row in zip(owner, keys, strict=True):
            for k, v in zip(row.tolist(), weights.tolist(), strict=True):
                out[o][k] = out[o].get(k, 0.0) + v
    return out


# --- training ------------------------------------------------------------


def train(docs: DataFrame, labels: DataFrame, doc_id: str = "doc_id", text: str = "text", label: str = "toxic", where: Column | None = None) -> Model | None:
    """A model from documents that `where` admits and that have a label in `labels`."""
    known = labels if where is None else labels.filter(where)
    known = known.select(F.col(doc_id).alias("label_id"), F.col(label).cast("int").alias("y")).dropna()
    sizes = {r["y"]: r["count"] for r in known.groupBy("y").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return None
    share = F.when(F.col("y") == 1, TOXIC_DOCS / sizes[1]).otherwise(CLEAN_DOCS / sizes[0])
    known = known.filter(uniform("label_id", F.lit("toxicity")) < share).distinct()
    # Bounded by the two constants, whatever the size of the tables.
    drawn = docs.select(F.col(doc_id).alias("id"), F.col(text).alias("text")).join(F.broadcast(known), F.col("id") == F.col("label_id"))
    drawn = stored(drawn.select("y", "text", F.xxhash64("text").alias("t")).dropDuplicates(["y", "t"]), "sentences")
    fit = drawn.filter(F.pmod("t", F.lit(4)) != 0)
    grams = _telling(fit)
    positive = _witnesses(fit, grams)
    clean = fit.filter("y = 0").select("text").mapInArrow(_emit_units, "word string, n long")
    clean = stored(clean.groupBy("word").agg(F.sum("n").alias("n")), "clean_words")
    negative = [r[0] for r in clean.orderBy(uniform("word"), "word").limit(WORDS).collect()]
    if positive.empty or not negative:
        return None
    insults, counts = list(positive["word"]), positive["count"].to_numpy(float)
    cut = _in_pieces(dict(zip(*_with_variants(insults, counts), strict=True)))
    insults, weight = list(cut), np.array(list(cut.values()))
    plain = _in_pieces({w: 1.0 / len(negative) for w in negative})
    model = _machine(insults, weight, plain, insults[: LANDMARKS // 2] + list(plain)[: LANDMARKS // 2])

    def scored(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(model.words(texts_of(batch, "word")))]

    hard = with_columns(clean, [T.StructField("raw", T.DoubleType())], scored).orderBy(F.desc("raw"), "word").limit(HARD)
    known = set(insults)
    harder = _in_pieces({r["word"]: float(np.sqrt(r["n"])) for r in hard.collect() if r["word"] not in known})
    mass = sum(harder.values()) or 1.0
    landmarks = insults[: LANDMARKS // 2] + list(harder)[: LANDMARKS // 2]
    model = _machine(insults, weight, plain | {w: n / mass for w, n in harder.items()}, landmarks)
    return _calibrated(drawn.filter(F.pmod("t", F.lit(4)) == 0), model)


def _emit_units(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = Counter(w for text in texts_of(batch, "text") for w in units(text))
        yield pa.RecordBatch.from_arrays([pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=["word", "n"])


def _parts(word: str) -> list[str]:
    """The word, and its beginnings of three to eight characters."""
    return [*(word[:n] for n in range(3, min(9, len(word)))), word + "\3"]


def _telling(fit: DataFrame) -> dict[str, float]:
    """Parts of words that several toxic and few clean documents have, and how telling."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: tuple[Counter[str], Counter[str]] = (Counter(), Counter())
        for batch in batches:
            for y, text in zip(texts_of(batch, "y"), texts_of(batch, "text"), strict=True):
                seen[y].update(set().union(*map(_parts, units(text))))
        parts = sorted(seen[0].keys() | seen[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(parts, pa.string()), *[pa.array([seen[y][g] for g in parts], pa.int64()) for y in (1, 0)]], names=["gram", "toxic", "clean"]
        )

    counted = fit.select("y", "text").mapInArrow(count, "gram string, toxic long, clean long")
    sums = counted.groupBy("gram").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    sums = stored(sums, "parts")
    toxic, clean = fit.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    # Log likelihood ratio of a part's own toxic share against the common one. As many parts
    # are tried, chance alone reaches about the logarithm of their number.
    f = max(1, toxic) / max(1, toxic + clean)
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    own = t / (t + c)
    gain = t * F.log(own / f) + F.when(c > 0, c * F.log((1 - own) / max(1e-9, 1 - f))).otherwise(0.0)
    best = sums.filter((own * (1 - f) >= LEAST_ODDS * f * (1 - own)) & (own > f)).withColumn("gain", gain)
    best = best.filter(F.col("gain") >= float(np.log(max(1, sums.count()))) + MARGIN)
    found = best.orderBy(F.desc("gain"), "gram").limit(GRAMS).collect()
    # A beginning that nearly always goes on in one way tells no more than its continuation.
    longest: Counter[str] = Counter()
    for r in found:
        for n in range(1, len(r["gram"])):
            longest[r["gram"][:n]] = max(longest[r["gram"][:n]], r["toxic"])
    return {r["gram"]: r["gain"] for r in found if longest[r["gram"]] < SAME * r["toxic"]}


def _witnesses(fit: DataFrame, grams: dict[str, float]) -> pd.DataFrame:
    """`word, count`: the word of each toxic document with the most telling part, where that
    part is the one of enough documents. The bound of the documents is theirs as well."""

    def name(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            best = []
            for text in texts_of(batch, "text"):
                ranked = [(max((grams.get(g, 0.0), g) for g in _parts(w)), w) for w in units(text) if len(w) > 2]
                top = max(ranked, default=((0, ""), ""))
                if top[0][0]:
                    best.append((top[1], top[0][1]))
            yield pa.RecordBatch.from_arrays([pa.array([b[i] for b in best], pa.string()) for i in (0, 1)], names=["word", "gram"])

    named = fit.filter("y = 1").select("text").mapInArrow(name, "word string, gram string")
    firm = named.groupBy("gram").count().filter(F.col("count") >= LEAST_TOXIC).select("gram")
    return named.join(firm, "gram", "left_semi").groupBy("word").count().orderBy(F.desc("count"), "word").toPandas()


def _with_variants(words: list[str], counts: np.ndarray) -> tuple[list[str], np.ndarray]:
    """The words, and gapped forms of them at a lower weight."""
    out = dict(zip(words, counts, strict=True))
    for word, n in zip(words, counts, strict=True):
        for variant in (*(gap.join(word) for gap in GAPS), *(word[:i] + GAPS[i % len(GAPS)] + word[i:] for i in range(1, len(word)))):
            out.setdefault(variant, n / 4)
    return list(out), np.array(list(out.values()))


def _in_pieces(weights: dict[str, float]) -> dict[str, float]:
    """Words cut as in scoring; the pieces of a word share its weight."""
    out: dict[str, float] = {}
    for word, weight in weights.items():
        parts = _pieces(word)
        for part in parts:
            out[part] = out.get(part, 0.0) + weight / len(parts)
    return out


def _machine(insults: list[str], weight: np.ndarray, clean: dict[str, float], landmarks: list[str]) -> Model:
    """Squared-hinge support vector machine over Nyström features, solved by Newton steps.
    `clean` has a weight for each word."""
    landmarks = list(dict.fromkeys(landmarks))
    sparse = _rows(landmarks)
    # Only subsequences that some landmark has play a part.
    place = {k: i for i, k in enumerate(sorted(set().union(*sparse)))}
    columns = np.zeros((len(place), len(landmarks)), np.float32)
    for j, row in enumerate(sparse):
        columns[[place[k] for k in row], j] = list(row.values())
    values, vectors = np.linalg.eigh(_kernel(landmarks, columns, place))
    keep = values > 1e-6 * values.max()
    half = vectors[:, keep] / np.sqrt(values[keep])
    x = _kernel([*insults, *clean], columns, place) @ half
    x = np.hstack([x, np.ones((len(x), 1))])
    y = np.array([1.0] * len(insults) + [-1.0] * len(clean))
    # Insults, hard and other clean words weigh alike; within them, words by documents.
    weight = np.sqrt(weight)
    c = COST * np.concatenate([weight / weight.sum(), np.array(list(clean.values()))])
    penalty = np.diag([1e-2] * (x.shape[1] - 1) + [1e-9])
    w = np.zeros(x.shape[1])
    for _ in range(50):
        on = y * (x @ w) < 1
        xo = x[on] * c[on, None]
        new = np.linalg.solve(penalty + xo.T @ x[on], xo.T @ y[on])
        if np.abs(new - w).max() < 1e-8:
            break
        w = new
    table = np.zeros(1 << BITS, np.float32)
    table[list(place)] = columns @ (half @ w[:-1]).astype(np.float32)
    return Model(table, float(w[-1]))


def _kernel(words: Sequence[str], columns: np.ndarray, place: dict[int, int]) -> np.ndarray:
    out = np.zeros((len(words), columns.shape[1]), np.float32)
    for a in range(0, len(words), 500):
        for i, row in enumerate(_rows(words[a : a + 500]), a):
            known = [(place[k], v) for k, v in row.items() if k in place]
            if known:
                at, weights = zip(*known, strict=True)
                out[i] = np.array(weights, np.float32) @ columns[list(at)]
    return out


def _calibrated(held: DataFrame, model: Model) -> Model:
    """The model with a logistic curve through the held documents' scores."""

    def raw(batch: pa.RecordBatch) -> list[pa.Array]:
        return [pa.array(_scorer(model).raw(texts_of(batch, "text")))]

    bins = (
        with_columns(held.select("y", "text"), [T.StructField("raw", T.DoubleType())], raw)
        .groupBy("y", F.round("raw", 2).alias("raw"))
        .count()
        .toPandas()
    )
    n1, n0 = (float(bins.loc[bins["y"] == k, "count"].sum()) for k in (1, 0))
    if not n1 or not n0:
        return Model(model.table, model.bias, 4.0, 0.0)
    # Smoothed targets keep the curve finite where the kinds are apart.
    goal = np.where(bins["y"] == 1, (n1 + 1) / (n1 + 2), 1 / (n0 + 2))
    n = bins["count"].to_numpy(float) / np.where(bins["y"] == 1, n1, n0)
    x = np.column_stack([bins["raw"], np.ones(len(bins))])
    w = np.array([1.0, 0.0])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -50, 50)))
        grad = x.T @ (n * (p - goal)) + 1e-3 * w * [1, 0]
        hess = (x * (n * p * (1 - p))[:, None]).T @ x + np.diag([1e-3, 1e-6])
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return Model(model.table, model.bias, float(max(w[0], 1e-3)), float(w[1]))


# --- scoring -------------------------------------------------------------


def score(docs: DataFrame, model: Model | None, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the chance that a text is toxic."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        if shared.value is None:
            return [pa.array([0.0] * batch.num_rows)]
        return [pa.array(shared.value.chance(_scorer(shared.value).raw(texts_of(batch, text))))]

    return with_columns(docs, [T.StructField(name, T.DoubleType())], compute)


class _Scorer:
    """Remembers the values of words that came lately."""

    def __init__(self, model: Model) -> None:
        self.model = model
        self._young: dict[str, float] = {}
        self._old: dict[str, float] = {}

    def raw(self, texts: Sequence[str | None]) -> np.ndarray:
        out: list[float] = []
        waiting: list[set[str]] = []
        size = 0
        for text in texts:
            waiting.append(units(text))
            size += len(text or "")
            if size >= BLOCK:
                out += self._highest(waiting)
                waiting, size = [], 0
        return np.array(out + self._highest(waiting), float)

    def _highest(self, waiting: list[set[str]]) -> list[float]:
        missing = set().union(*waiting) - self._young.keys()
        fresh = {w: self._old[w] for w in missing & self._old.keys()}
        rest = list(missing - fresh.keys())
        fresh.update(zip(rest, self.model.words(rest).tolist(), strict=True))
        if len(self._young) + len(fresh) > REMEMBERED:
            lookup = self._young | fresh
            self._young, self._old = {}, self._young
        else:
            lookup = self._young
        self._young.update(fresh)
        lowest = self.model.bias - 1.0
        return [max(map(lookup.__getitem__, found), default=lowest) for found in waiting]


_LAST: list[tuple[Model, _Scorer]] = []


def _scorer(model: Model) -> _Scorer:
    if not _LAST or _LAST[0][0] is not model:
        _LAST[:] = [(model, _Scorer(model))]
    return _LAST[0][1]
