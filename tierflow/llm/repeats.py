"""Passages that occur more than once, cut out byte by byte.

A suffix is looked at only through its first `window` bytes. Suffixes whose first bytes are
equal form a group; groups are split by most-significant-digit passes and groups of one are
dropped, so that the groups left at full depth are exactly the windows that repeat.

The digits of a window are read from its anchor outwards. The anchor is the leftmost place
in the window whose next eight bytes hash least, so equal windows have it at the same offset
and neighbouring windows mostly share it: one row stands for all windows around an anchor,
about one for every 70 bytes. Each pass looks at cells, that is windows at neighbouring
offsets around one anchor:

* the bytes which all windows of a cell share are the digit. A cell alone with its digit
  holds no repeated window and is dropped;
* the bytes from the first window's start to the last one's end are the cell's form. If it
  occurs twice, all windows of the cell repeat and are marked;
* where a digit has several forms, one cell of each goes on to the next pass, cut into
  smaller cells, whose digits are longer.

In the last pass a cell is one window, and digit and form are its bytes.

Shuffled are hashes, never all texts: 64 bits for digits, where a collision costs a row
more, 128 for forms. Every group is counted by an aggregation that combines before the
shuffle; no group is ever gathered in one task, and the joins that bring counts back have
unique keys on one side, so adaptive execution can split a hot one. Two sieves (bit sets of
8 MB, whatever the input) keep most of the rows that cannot matter out of those shuffles;
they only ever let too much through.

A document is known by a 128-bit hash of id and text, so no row numbers need to be stable.

Null text is empty text. A text shorter than the window has none and stays whole. Rows that
repeat, with their id or without it, are copies: each is cut entirely. Null ids are kept.
An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tierflow.llm.common import bounded, stored
from tierflow.store import remove

WINDOW = 200
# Bytes that choose an anchor.
_GRAM = 8
# Window starts looked at at a time, which bounds memory; their places fit in _PLACE bits.
_BLOCK = 1 << 18
_PLACE = 19
# Bits of a sieve.
_SIEVE = 1 << 26
# Offsets in a window are packed in 12 bits each.
_WIDEST = 1 << 12
# Rows per Arrow batch that a task hands back.
_ROWS = 1 << 15

_CELL = "c long, u1 long, u2 long, d1 long, d2 long, loc long"
_SPANS = "array<struct<begin: long, end: long>>"


def cut_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", window: int = WINDOW) -> DataFrame:
    """`id`, `n_bytes`, the removed `spans` (array of begin and end, in bytes) and the `kept` bytes of
    every row: without each byte that a string of `window` bytes covers which also starts
    elsewhere, in the same text or another."""
    if not 2 * _GRAM <= window < _WIDEST:
        raise ValueError(f"a window has {2 * _GRAM} to {_WIDEST - 1} bytes")
    bounded(docs.sparkSession)
    kind = docs.schema[id].dataType
    rows = docs.select(F.col(id).cast("string").alias("id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    found = _cut(rows, repeated_spans(rows, window), window)
    return found.withColumn("id", F.col("id").cast(kind))


def repeated_spans(rows: DataFrame, window: int) -> DataFrame:
    """`d1`, `d2` and `locs`, the packed places of marked cells, of every text that has some."""
    widths = _widths(window)
    found = _cells(rows, window, widths[0], _sieve(_repeated_digits(rows, window), "c"))
    marks, lists, used = [], None, []
    for i, width in enumerate(widths):
        made: list[str] = []
        marked, live = _decide(found if lists is None else _finer(rows, lists, window, width), made)
        marks.append(stored(marked, "repeats-marked", used))
        if i + 1 < len(widths):
            lists = stored(_by_text(live), "repeats-live", used)
        # Nothing reads a pass's cells after it; they are most of what would lie on the disk.
        _remove(rows, made)
    found = stored(_by_text(reduce(DataFrame.unionByName, marks)), "repeats-marks")
    _remove(rows, used)
    return found


def _remove(rows: DataFrame, paths: Sequence[str]) -> None:
    for path in paths:
        remove(rows.sparkSession, path)


def _widths(window: int) -> list[int]:
    """Offsets that a cell holds, pass by pass."""
    offsets = window - _core(window) + 1
    return [offsets, math.isqrt(offsets - 1) + 1, 1]


def _core(window: int) -> int:
    """Bytes after an anchor that all windows around it hold."""
    return max(_GRAM, window // 3)


def _decide(cells: DataFrame, made: list[str]) -> tuple[DataFrame, DataFrame]:
    """Cells whose form repeats, and a cell of each form of the digits that have several. `made`
    gets the paths of the tables that both are read from."""
    form = ["c", "u1", "u2"]
    cells = stored(cells, "repeats-cells", made)
    counted = cells.groupBy(*form).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("d1", "d2", "loc")).alias("at"))
    forms = stored(counted, "repeats-forms", made)
    # Equal forms have equal digits, which need not be shuffled.
    marked = cells.select(*form[1:], "d1", "d2", "loc").join(forms.filter("n > 1").select(form[1:]), form[1:]).select("d1", "d2", "loc")
    several = forms.groupBy("c").agg(F.count(F.lit(1)).alias("forms")).filter("forms > 1").select("c")
    return marked, forms.join(stored(several, "repeats-digits", made), "c").select("at.*")


def _by_text(places: DataFrame) -> DataFrame:
    return places.groupBy("d1", "d2").agg(F.sort_array(F.collect_set("loc")).alias("locs"))


# --- anchors and cells in tasks --------------------------------------------


def _anchors(data: memoryview, ends: np.ndarray, window: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """First and last window start and the anchor of every run of windows with one anchor,
    in texts laid end to end; block by block, so that a run may come in two parts."""
    offsets = window - _core(window) + 1
    low = np.uint64((1 << _PLACE) - 1)
    for begin in range(0, len(data) - window + 1, _BLOCK):
        size = min(len(data) - begin, _BLOCK + window - 1)
        starts = np.arange(begin, begin + size - window + 1)
        inside = starts + window <= ends[np.searchsorted(ends, starts, side="right")]
        least = np.ndarray((size - _GRAM + 1,), dtype="<u8", buffer=data, offset=begin, strides=(1,)) * np.uint64(0x9E3779B97F4A7C15)
        least ^= least >> np.uint64(29)
        least *= np.uint64(0xBF58476D1CE4E5B9)
        # The place in the low bits makes the leftmost of equal ones the least.
        least = (least & ~low) | np.arange(len(least), dtype=np.uint64)
        reach = 1
        while 2 * reach <= offsets:
            least = np.minimum(least[:-reach], least[reach:])
            reach *= 2
        if reach < offsets:
            least = np.minimum(least[: len(least) - (offsets - reach)], least[offsets - reach :])
        anchors = (least[: len(starts)] & low).astype(np.int64) + begin
        starts, anchors = starts[inside], anchors[inside]
        # An anchor belongs to one text: all its windows lie inside that one.
        first = np.flatnonzero(np.diff(anchors, prepend=-1))
        if len(first):
            yield starts[first], starts[np.append(first[1:], len(starts)) - 1], anchors[first]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _cell(data: memoryview, anchor: int, least: int, most: int, begin: int, width: int, window: int) -> tuple[int, int, int]:
    """Digit and form of the windows at offsets `least` to `most` before the anchor, in the
    cell of `width` offsets from `begin`."""
    digit = data[anchor - begin : anchor - begin - width + 1 + window]
    form = xxhash.xxh3_128_intdigest(data[anchor - most : anchor - least + window])
    return _signed(xxhash.xxh3_64_intdigest(digit, begin)), _signed(form >> 64), _signed(form & ((1 << 64) - 1))


def _place(anchor: int, least: int, most: int) -> int:
    """A cell's place in its text; offsets need 12 bits each."""
    return (anchor << 24) | (least << 12) | most


def _unpacked(loc: int) -> tuple[int, int, int]:
    return loc >> 24, (loc >> 12) & 0xFFF, loc & 0xFFF


def _texts(batch: pa.RecordBatch) -> tuple[memoryview, np.ndarray]:
    """The batch's texts laid end to end, and where each ends."""
    column = batch.column(batch.schema.get_field_index("text")).cast(pa.large_binary())
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    if data is None or bounds[-1] == bounds[0]:
        return memoryview(b""), np.zeros(len(column), dtype=np.int64)
    return memoryview(data)[bounds[0] : bounds[-1]], bounds[1:] - bounds[0]


def _key(id: str | None, text: memoryview) -> tuple[int, int]:
    hashed = xxhash.xxh3_128(b"" if id is None else b"\x01" + id.encode() + b"\x00")
    hashed.update(text)
    value = hashed.intdigest()
    return _signed(value >> 64), _signed(value & ((1 << 64) - 1))


def _keys(batch: pa.RecordBatch, data: memoryview, ends: np.ndarray) -> list[tuple[int, int]]:
    ids = batch.column(batch.schema.get_field_index("id")).to_pylist()
    begins = [0, *ends[:-1].tolist()]
    return [_key(i, data[b:e]) for i, b, e in zip(ids, begins, ends.tolist(), strict=True)]


def _repeated_digits(rows: DataFrame, window: int) -> DataFrame:
    """Digits of the first pass that occur more than once."""
    core = _core(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _texts(batch)
            for _, _, anchors in _anchors(data, ends, window):
                found = (xxhash.xxh3_64_intdigest(data[a : a + core]) for a in anchors.tolist())
                yield pa.RecordBatch.from_arrays([pa.array(np.fromiter(found, np.uint64, len(anchors)).view(np.int64))], ["c"])

    return rows.mapInArrow(run, "c long").groupBy("c").count().filter("count > 1").select("c")


def _cells(rows: DataFrame, window: int, width: int, sieve: Broadcast) -> DataFrame:
    """The cells of the first pass whose digit the sieve lets through."""
    core = _core(window)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, ends = _texts(batch)
            keys = _keys(batch, data, ends)
            for first, last, anchors in _anchors(data, ends, window):
                digits = np.fromiter((xxhash.xxh3_64_intdigest(data[a : a + core]) for a in anchors.tolist()), np.uint64, len(anchors))
                kept = np.flatnonzero(_passes(sieve.value, digits))
                texts = np.searchsorted(ends, first[kept], side="right")
                out = []
                for t, f, e, a in zip(texts.tolist(), first[kept].tolist(), last[kept].tolist(), anchors[kept].tolist(), strict=True):
                    begin = int(ends[t - 1]) if t else 0
                    out.append((*_cell(data, a, a - e, a - f, 0, width, window), *keys[t], _place(a - begin, a - e, a - f)))
                yield from _batches(out)

    return rows.mapInArrow(run, _CELL)


def _finer(rows: DataFrame, lists: DataFrame, window: int, width: int) -> DataFrame:
    """The listed cells, cut into cells of `width` offsets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [batch.column(batch.schema.get_field_index(n)).to_pylist() for n in ("text", "d1", "d2", "locs")]
            out = []
            for text, d1, d2, locs in zip(*columns, strict=True):
                data = memoryview(text)
                for loc in locs:
                    anchor, least, most = _unpacked(loc)
                    for begin in range(least - least % width, most + 1, width):
                        lo, hi = max(least, begin), min(most, begin + width - 1)
                        out.append((*_cell(data, anchor, lo, hi, begin, width, window), d1, d2, _place(anchor, lo, hi)))
                    if len(out) >= _ROWS:
                        yield from _batches(out)
                        out = []
            yield from _batches(out)

    return _keyed(rows, _sieve(lists, "d1")).filter("sifted").join(lists, ["d1", "d2"]).mapInArrow(run, _CELL)


def _batches(rows: Sequence[tuple]) -> Iterator[pa.RecordBatch]:
    names = ["c", "u1", "u2", "d1", "d2", "loc"]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names)


# --- sieves -----------------------------------------------------------------


def _sieve(keys: DataFrame, column: str) -> Broadcast:
    """A bit set of fixed size in which the bit of every key is set, sent to all workers."""
    bits = keys.select(F.pmod(F.col(column), F.lit(_SIEVE)).alias("bit"))
    words = bits.groupBy(F.expr("shiftright(bit, 6)").alias("word")).agg(F.bit_or(F.expr("shiftleft(1L, CAST(bit % 64 AS INT))")).alias("bits"))
    found = words.toArrow()
    sieve = np.zeros(_SIEVE // 64, dtype=np.int64)
    sieve[found["word"].to_numpy()] = found["bits"].to_numpy()
    return keys.sparkSession.sparkContext.broadcast(sieve.view(np.uint64))


def _passes(sieve: np.ndarray, keys: np.ndarray) -> np.ndarray:
    bit = keys & np.uint64(64 * len(sieve) - 1)
    return (sieve[bit >> np.uint64(6)] >> (bit & np.uint64(63))) & np.uint64(1) == 1


def _keyed(rows: DataFrame, sieve: Broadcast) -> DataFrame:
    """All rows with their key, and whether the sieve lets them through."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = np.array(_keys(batch, *_texts(batch)), dtype=np.int64).reshape(-1, 2)
            sifted = _passes(sieve.value, np.ascontiguousarray(keys[:, 0]).view(np.uint64))
            columns = [*batch.columns, pa.array(keys[:, 0]), pa.array(keys[:, 1]), pa.array(sifted)]
            yield pa.RecordBatch.from_arrays(columns, ["id", "text", "d1", "d2", "sifted"])

    return rows.mapInArrow(run, "id string, text binary, d1 long, d2 long, sifted boolean")


# --- cutting ----------------------------------------------------------------


def _cut(rows: DataFrame, lists: DataFrame, window: int) -> DataFrame:
    keyed = _keyed(rows, _sieve(lists, "d1"))
    none = F.array().cast(_SPANS)
    whole = keyed.filter("NOT sifted").select("id", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("spans"), F.col("text").alias("kept"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for text, locs in zip(batch.column("text").to_pylist(), batch.column("locs").to_pylist(), strict=True):
                removed = _spans(locs or (), window)
                sizes.append(len(text))
                spans.append([{"begin": b, "end": e} for b, e in removed])
                edges = [0, *(x for span in removed for x in span), len(text)]
                kept.append(b"".join(text[b:e] for b, e in zip(edges[::2], edges[1::2], strict=True)))
            span = pa.list_(pa.struct({"begin": pa.int64(), "end": pa.int64()}))
            columns = [batch.column("id"), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["id", "n_bytes", "spans", "kept"])

    touched = keyed.filter("sifted").join(lists, ["d1", "d2"], "left").select("id", "text", "locs")
    return whole.unionByName(touched.mapInArrow(run, f"id string, n_bytes long, spans {_SPANS}, kept binary"))


def _spans(locs: Sequence[int], window: int) -> list[tuple[int, int]]:
    """The maximal runs of bytes that the marked cells' windows cover."""
    cells = (_unpacked(loc) for loc in locs)
    out: list[tuple[int, int]] = []
    for begin, end in sorted((anchor - most, anchor - least + window) for anchor, least, most in cells):
        if out and begin <= out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((begin, end))
    return out
