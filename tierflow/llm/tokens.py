"""Token counts (operator 2).

Texts are cut at safe boundaries, the distinct pieces of a batch that were not counted
lately are encoded in batches of about equal bytes, and only lengths leave Python.

A boundary is safe where white space follows something else, for a vocabulary whose file says
so: its byte-level pre-tokenizer always begins a new word there, nothing is normalised, no
added token holds or strips white space, and so no rule looks back. Counts of the pieces
therefore add up to the count of the text. With any other vocabulary texts are not cut.

Defined results: null and empty texts have 0 bytes and 0 tokens. A text without a safe
boundary is encoded whole. Truncation and padding that a vocabulary's file asks for are off. Repeated rows are counted each; other columns pass through.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tierflow.llm.common import texts_of, with_columns

# Bytes of one call of the tokenizer, and characters of a text that are cut at once.
BATCH_BYTES = 1 << 18
SPAN = 1 << 21
# Counts that a worker remembers, in two generations; longer pieces are not remembered.
REMEMBERED = 500_000
LONGEST = 64

_SAFE = re.compile(r"(?<=\S)(?=[ \n])")


def count_tokens(
    docs: DataFrame, vocabulary: str, text: str = "text", n_bytes: str = "n_bytes", n_tokens: str = "n_tokens"
) -> DataFrame:
    """`docs` with each text's UTF-8 bytes and its tokens under the vocabulary file at
    `vocabulary`, which every executor must be able to open."""

    def compute(batch: pa.RecordBatch) -> list[pa.Array]:
        texts = ["" if t is None else t for t in texts_of(batch, text)]
        counted = _counter(vocabulary).count(texts)
        return [pa.array([len(t.encode()) for t in texts], pa.int64()), pa.array(counted, pa.int64())]

    fields = [T.StructField(n_bytes, T.LongType()), T.StructField(n_tokens, T.LongType())]
    return with_columns(docs, fields, compute)


def pieces(text: str) -> Iterator[list[str]]:
    """The text's pieces, a span of it at a time."""
    start = 0
    while start < len(text):
        cut = _SAFE.search(text, start + SPAN) if len(text) - start > SPAN else None
        end = cut.start() if cut else len(text)
        yield _SAFE.split(text[start:end])
        start = end


def cuts_safely(vocabulary: dict) -> bool:
    """Whether a vocabulary, as its file has it, begins a new word at every safe boundary."""
    before = vocabulary.get("pre_tokenizer") or {}
    words = before.get("type") == "ByteLevel" and before.get("use_regex", True) and not before.get("add_prefix_space", True)
    added = vocabulary.get("added_tokens") or []
    plain = not any(t.get("lstrip") or t.get("rstrip") or re.search(r"\s", t["content"]) for t in added)
    return words and plain and not vocabulary.get("normalizer")


def balanced(items: Sequence[str], size: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Batches of at most `size` bytes, or of one longer piece; long pieces come first, so
    that pieces of a batch are about equally long."""
    batch: list[str] = []
    room = size
    for item in sorted(items, key=lambda x: (-len(x), x)):
        need = len(item.encode())
        if batch and need > room:
            yield batch
            batch, room = [], size
        batch.append(item)
        room -= need
    if batch:
        yield batch


class _Counter:
    def __init__(self, vocabulary: str) -> None:
        from tokenizers import Tokenizer

        with open(vocabulary, encoding="utf-8") as file:
            text = file.read()
        self._tokenizer = Tokenizer.from_str(text)
        self._tokenizer.no_truncation()
        self._tokenizer.no_padding()
        self._cut = pieces if cuts_safely(json.loads(text)) else lambda whole: [[whole]]
        self._young: dict[str, int] = {}
        self._old: dict[str, int] = {}

    def count(self, texts: Sequence[str]) -> list[int]:
        totals = [0] * len(texts)
        waiting: list[tuple[int, list[str]]] = []
        size = 0
        for i, text in enumerate(texts):
            for found in self._cut(text):
                waiting.append((i, found))
                size += sum(map(len, found))
                if size >= SPAN:
                    self._add(totals, waiting)
                    waiting, size = [], 0
        self._add(totals, waiting)
        return totals

    def _add(self, totals: list[int], waiting: list[tuple[int, list[str]]]) -> None:
        """Add the counts of the pieces that wait to the totals of their texts."""
        missing = set().union(*(found for _, found in waiting)) - self._young.keys()
        lately = {p: self._old[p] for p in missing & self._old.keys()}
        fresh = lately | self._encode(missing - lately.keys())
        if len(self._young) + len(fresh) > REMEMBERED:
            lookup = self._young | fresh
            self._young, self._old = {}, self._young
        else:
            lookup = self._young
        self._young.update((p, n) for p, n in fresh.items() if len(p) <= LONGEST)
        rest = {p: n for p, n in fresh.items() if len(p) > LONGEST}
        for i, found in waiting:
            counts = map(lookup.get, found)
            totals[i] += sum(counts) if not rest else sum(rest[p] if n is None else n for p, n in zip(found, counts, strict=True))

    def _encode(self, items: set[str]) -> dict[str, int]:
        out: dict[str, int] = {}
        for batch in balanced(list(items)):
            encoded = self._tokenizer.encode_batch_fast(batch, add_special_tokens=False)
            out.update(zip(batch, map(len, encoded), strict=True))
        return out


@lru_cache(maxsize=2)
def _counter(vocabulary: str) -> _Counter:
    # Spark runs one task per core; the library's own threads would only compete.
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    return _Counter(vocabulary)


def over_limit(n_tokens: str = "n_tokens", limit: int = 1024):
    return F.col(n_tokens) > limit
