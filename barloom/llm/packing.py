"""Harmonic packing of token sequences.

A document's ids are cut so that its pieces fall into reciprocal-capacity classes:
full sequences, then halves, quarters and so on down to 64 ids, then a tail below
64. A bin of a class takes a fixed number of pieces, as many as fit: two halves,
four quarters, floor(2048 / t) tails of t ids. Bins of the halving classes have no
padding, bins of tails less than one tail.

Each task fills the bins of its own documents in one pass, without any shuffle; a
bin is open only while it fills, so a task holds a few thousand pieces at most. The
bins that a task leaves open are joined and cut at powers of two, which need no
padding. A sequence's number is made of the task's and its own count, so a task
that runs again gives the same rows.

Defined cases: a null or empty text has the closing id alone; a document of any
length is cut as often as needed; repeated rows and null ids are packed like other
rows; other columns are ignored; an empty table returns no rows.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import cache
from zlib import crc32

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

CAPACITY = 2048
LEAST = 64
CLOSING = 1
MODEL = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
NUMBERS = (
    "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset",
)


@cache
def encoders(model: str, ranks: str) -> tuple[Tokenizer, tiktoken.Encoding]:
    """The tokenizer, and the same vocabulary in the library that is faster on plain text."""
    with open(ranks, "rb") as lines:
        table = {base64.b64decode(k): int(v) for k, v in map(bytes.split, lines)}
    fast = tiktoken.Encoding(
        "ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=table, special_tokens={}
    )
    return Tokenizer.from_file(model), fast


def encode(text: str, model: str, ranks: str) -> np.ndarray:
    """The document's ids and the closing id."""
    slow, fast = encoders(model, ranks)
    if any(token.content in text for token in slow.get_added_tokens_decoder().values()):
        ids = slow.encode(text, add_special_tokens=False).ids
    else:
        ids = fast.encode_ordinary(text)
    return np.array([*ids, CLOSING], dtype="<u4")


def cuts(count: int, capacity: int = CAPACITY, least: int = LEAST) -> list[int]:
    """Lengths of a document's pieces, each of one class."""
    sizes = [capacity] * (count // capacity)
    rest = count % capacity
    size = capacity // 2
    while size >= least:
        if rest >= size:
            sizes.append(size)
            rest -= size
        size //= 2
    return sizes + [rest] * (rest > 0)


class Bins:
    """Open bins of one task: a list of (document key, ids, start, tokens) per class."""

    def __init__(self, task: int, capacity: int, least: int):
        self.capacity, self.least = capacity, least
        self.open: dict[int, list] = {}
        self.next = task << 33

    def close(self, pieces: list) -> Iterator[tuple]:
        offset = 0
        for key, ids, start, tokens in pieces:
            yield key, start, len(ids), crc32(ids.tobytes()), tokens, self.next, offset
            offset += len(ids)
        self.next += 1

    def add(self, key: int, ids: np.ndarray) -> Iterator[tuple]:
        start = 0
        for size in cuts(len(ids), self.capacity, self.least):
            held = self.open.setdefault(size, [])
            held.append((key, ids[start : start + size], start, len(ids)))
            start += size
            if len(held) == self.capacity // size:
                yield from self.close(self.open.pop(size))

    def finish(self) -> Iterator[tuple]:
        """Join what is left, largest class first, and cut it at powers of two."""
        rest = [piece for size in sorted(self.open, reverse=True) for piece in self.open[size]]
        total = sum(len(piece[1]) for piece in rest)
        rest.reverse()
        while total:
            room = min(self.capacity, 1 << (total.bit_length() - 1))
            total -= room
            pieces = []
            while room:
                key, ids, start, tokens = rest.pop()
                if len(ids) > room:
                    rest.append((key, ids[room:], start + room, tokens))
                    ids = ids[:room]
                pieces.append((key, ids, start, tokens))
                room -= len(ids)
            yield from self.close(pieces)


def pack(
    docs: DataFrame,
    model: str | None = None,
    ranks: str | None = None,
    capacity: int = CAPACITY,
    least: int = LEAST,
) -> DataFrame:
    """One row per piece: doc_id, place in its document and in its sequence."""
    model = model or public_tokenizers.path(MODEL)
    ranks = ranks or public_tokenizers.path(RANKS)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bins = Bins(TaskContext.get().partitionId(), capacity, least)

        def rows(found: list[tuple]) -> pa.RecordBatch:
            keys, *numbers = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, id_type), *(pa.array(x, pa.int64()) for x in numbers)],
                names=["doc_id", *NUMBERS],
            )

        id_type = None
        found: list[tuple] = []
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                found += bins.add(key, encode(text, model, ranks))
                if len(found) > 10_000:
                    yield rows(found)
                    found = []
        if id_type is not None:
            found += bins.finish()
        if found:
            yield rows(found)

    numbers = ", ".join(f"{name} long" for name in NUMBERS)
    source = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    return source.mapInArrow(run, f"doc_id {kind}, {numbers}")
