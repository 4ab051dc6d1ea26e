"""Exact top-k by inner product over a bit-sliced index (operator 3).

Components are quantised to integers, and each block of rows is stored as bit slices: for a
dimension and a binary place, one bitmap over the block's rows. A query's scores for a whole
block come from bitmap arithmetic alone: the slices are added, shifted by the query's own
signed binary digits, with carry-save adders. The top rows are then selected from the most
significant slice of the sum downward; rows that tie at the boundary are resolved exactly by
the smaller id.

Rows are dealt to blocks by id, and every block meets every query: a block is sent to as many
tasks as it takes to occupy the cores, so to one only where there are many blocks, and the
queries are sent to the blocks. A task holds one block at a time and lets its queries pass by
in small batches, however many there are. Each block returns at most k rows a query, which
one window per query merges. Nothing is broadcast.

Defined results: rows without id or vector, or with a null or non-finite component, take no
part; all other rows do, whatever the size of their components and however often their id
occurs: a query is a row, and its candidates are all rows but itself. A shorter vector reads
as if padded with zeros. Equal scores rank by id, those of one id in any order. Scores are
longs, or the digits of whole numbers as text where the table's own components do not rule
out that one exceeds a long. Tables without rows give none.
"""

from __future__ import annotations

import math
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tierflow.llm.common import stored

# Rows of a block: bitmaps of 8 KB, so that the working set of an addition stays in cache;
# fewer where vectors are long, so that a block takes no more than so many bytes unpacked.
BLOCK_ROWS = 1 << 16
BLOCK_BYTES = 64 << 20
LEAST_ROWS = 64
SCALE = 256


@dataclass(frozen=True)
class Index:
    """Rows with a vector that takes part (`row`, `id`, `v`), and the scale of the quantised ones."""

    rows: DataFrame
    scale: int


def index(vectors: DataFrame, key: str, vector: str, scale: int = SCALE) -> Index:
    """An index of `vectors`; components x count as floor(scale * x), for a power of two."""
    real = F.transform(F.col(vector), lambda x: x.cast("double"))
    sound = F.forall(real, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.filter(F.col(key).isNotNull() & F.col(vector).isNotNull() & sound)
    rows = rows.select(F.monotonically_increasing_id().alias("row"), F.col(key).cast("long").alias("id"), real.alias("v"))
    return Index(stored(rows, "vectors"), scale)


def top_k(indexed: Index, queries: Column, k: int) -> DataFrame:
    """`query_id, rank, id, score` of the k best other rows for each row that `queries`, a condition
    on `id`, names."""
    rows = indexed.rows
    n_rows, width, most = rows.agg(
        F.count("*"), F.max(F.size("v")), F.max(F.array_max(F.transform("v", F.abs)))
    ).first()
    width, scale = max(1, width or 1), indexed.scale
    # No score is further from 0.
    bound = width * (_whole(most or 0.0, scale) + 1) ** 2
    wide = bound >= 1 << 63
    kind = "string" if wide else "long"
    blocks, groups = layout(n_rows, width, rows.sparkSession.sparkContext.defaultParallelism)
    packed = rows.withColumn("b", F.pmod(F.xxhash64("row"), F.lit(blocks))).groupBy("b").applyInPandas(
        lambda part: _slices(part, width, scale), "b long, payload binary"
    )
    none = F.lit(None)
    packed = packed.select("b", F.explode(_numbers(groups)).alias("g"), "payload", none.cast("long").alias("row"), none.cast("long").alias("id"), none.cast("array<double>").alias("v"))
    group = F.pmod(F.xxhash64("row", F.lit("q")), F.lit(groups)).alias("g")
    asked = rows.filter(queries).select(F.explode(_numbers(blocks)).alias("b"), group, none.cast("binary").alias("payload"), "row", "id", "v")
    # A block comes before its queries, as a null row number does before others.
    met = packed.unionByName(asked).repartition(blocks * groups, "b", "g").sortWithinPartitions("b", "g", F.col("row").asc_nulls_first())

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block: _Block | None = None
        at = None
        for batch in batches:
            found = []
            for b, g, payload, row, id, v in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if payload is not None:
                    block, at = _Block(payload), (b, g)
                elif block is not None and at == (b, g):
                    found += [(row, id, *f) for f in block.search(row, v, k)]
            if found:
                query, query_id, own, score = zip(*((q, i, r, s) for q, i, r, s in found), strict=True)
                scores = [f"{s + bound:0{len(str(2 * bound))}d}" for s in score] if wide else score
                ids = [r[1] for r in own]
                columns = [pa.array(query), pa.array(query_id), pa.array(ids), pa.array(scores), pa.array([str(s) for s in score] if wide else score)]
                yield pa.RecordBatch.from_arrays(columns, ["query", "query_id", "id", "place", "score"])

    best = met.mapInArrow(search, f"query long, query_id long, id long, place {kind}, score {kind}")
    order = Window.partitionBy("query").orderBy(F.desc("place"), "id")
    return best.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select("query_id", "rank", "id", "score")


def layout(rows: int, width: int, cores: int) -> tuple[int, int]:
    """Blocks, and groups of queries that each of them meets: no more than occupy the cores."""
    size = min(BLOCK_ROWS, max(LEAST_ROWS, BLOCK_BYTES // (8 * width)))
    blocks = max(1, -(-rows // size))
    return blocks, max(1, -(-cores // blocks))


def _numbers(n: int) -> Column:
    return F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))


def _whole(x: float, scale: int) -> int:
    """floor(scale * x), exact for any finite x."""
    return int(x) * scale if abs(x) >= 1 << 53 else math.floor(x * scale)


def _quantised(vectors: list, width: int, scale: int) -> np.ndarray:
    dense = np.zeros((len(vectors), width))
    for row, v in enumerate(vectors):
        dense[row, : len(v)] = v
    if np.abs(dense).max(initial=0) < (1 << 62) // scale:
        return np.floor(dense * scale).astype(np.int64)
    return np.array([[_whole(x, scale) for x in row] for row in dense.tolist()], dtype=object)


def _slices(part: pd.DataFrame, width: int, scale: int) -> pd.DataFrame:
    """A block as bytes: row numbers and ids, least value and number of bits of each dimension,
    slices."""
    part = part.sort_values(["id", "row"])
    n = len(part)
    dense = _quantised(part["v"].tolist(), width, scale)
    low = dense.min(axis=0)
    dense = dense - low
    bits = [int(m).bit_length() for m in dense.max(axis=0)]
    words = -(-n // 64)
    planes = np.zeros((sum(bits), words * 8), np.uint8)
    for plane, (d, b) in zip(planes, ((d, b) for d in range(width) for b in range(bits[d])), strict=True):
        packed = np.packbits(((dense[:, d] >> b) & 1).astype(np.uint8), bitorder="little")
        plane[: len(packed)] = packed
    payload = pickle.dumps((part["row"].to_numpy(), part["id"].to_numpy(), [int(x) for x in low], bits, planes.tobytes(), scale))
    return pd.DataFrame({"b": [int(part["b"].iloc[0])], "payload": [payload]})


class _Block:
    """A block unpacked, ready for queries."""

    def __init__(self, payload: bytes) -> None:
        self.rows, self.ids, self.low, self.bits, planes, self.scale = pickle.loads(payload)
        self.words = -(-len(self.ids) // 64)
        self.planes = np.frombuffer(planes, np.uint64).reshape(-1, self.words)
        self.flipped = ~self.planes
        self.first = np.concatenate([[0], np.cumsum(self.bits)]).astype(int).tolist()
        self.everyone = np.full(self.words, ~np.uint64(0))
        if len(self.ids) % 64:
            self.everyone[-1] = np.uint64((1 << (len(self.ids) % 64)) - 1)
        self.order = np.argsort(self.rows, kind="stable")

    def search(self, own: int, v: list[float], k: int) -> Iterator[tuple[tuple[int, int], int]]:
        """Row and id, and score, of the k best rows of the block but the query's own."""
        places: dict[int, list[np.ndarray]] = {}
        constant = 0
        for d, x in enumerate(v):
            value = _whole(x, self.scale)
            constant += value * self.low[d]
            for place, sign in _digits(value):
                # Subtracting x is adding its complement, less a constant.
                source = self.planes if sign > 0 else self.flipped
                if sign < 0:
                    constant -= ((1 << self.bits[d]) - 1) << place
                for b in range(self.bits[d]):
                    places.setdefault(place + b, []).append(source[self.first[d] + b])
        total = _add(places, self.words)
        candidates = self.everyone.copy()
        at = int(np.searchsorted(self.rows, own, sorter=self.order))
        if at < len(self.rows) and self.rows[self.order[at]] == own:
            at = int(self.order[at])
            candidates[at // 64] &= ~np.uint64(1 << (at % 64))
        for row, score in _select(total, candidates, k):
            yield (int(self.rows[row]), int(self.ids[row])), score + constant


def _digits(value: int) -> Iterator[tuple[int, int]]:
    """The signed binary digits of a number, no two of them adjacent: value is the sum of
    sign * 2 ** place."""
    place = 0
    while value:
        if value & 1:
            sign = 2 - (value & 3)
            yield place, sign
            value -= sign
        value >>= 1
        place += 1


def _add(places: dict[int, list[np.ndarray]], words: int) -> list[np.ndarray]:
    """The sum of all bitmaps as slices, least significant first."""
    out: list[np.ndarray] = []
    place = 0
    while places:
        column = places.pop(place, [])
        carries = places.setdefault(place + 1, []) if len(column) > 1 else []
        while len(column) > 2:
            a, b, c = column.pop(), column.pop(), column.pop()
            half = a ^ b
            column.append(half ^ c)
            half &= c
            half |= a & b
            carries.append(half)
        if len(column) == 2:
            a, b = column
            carries.append(a & b)
            column = [a ^ b]
        out.append(column[0] if column else np.zeros(words, np.uint64))
        place += 1
    return out


def _select(total: list[np.ndarray], candidates: np.ndarray, k: int) -> list[tuple[int, int]]:
    """The k best (row, sum) pairs; of rows that tie at the boundary, those that come first."""
    sure = np.zeros_like(candidates)
    open_ = candidates
    for plane in reversed(total):
        high = open_ & plane
        n = _count(sure) + _count(high)
        if n > k:
            open_ = high
        else:
            sure |= high
            open_ = open_ & ~plane
            if n == k:
                break
    rows = _rows(sure)
    # All rows that are still open have one and the same sum, or none of them is needed.
    rows = np.concatenate([rows, _rows(open_)[: max(0, k - len(rows))]])
    return [(int(r), sum(((int(p[r // 64]) >> int(r % 64)) & 1) << i for i, p in enumerate(total))) for r in rows]


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def _rows(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))
