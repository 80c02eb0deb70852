"""Byte-level BPE by replaying the merges over a corpus of words, and back to bytes.

A text is cut by the vocabulary's pattern into words, and the ids of a word depend on
the word alone. A task therefore numbers the distinct words of a block of documents
(``BLOCK`` characters) and encodes them together: all their bytes lie in one array, an
inverted index leads from the rank of each pair of neighbouring tokens to its positions
in the words, and the ranks are taken from a heap in ascending order. A rank is applied
to all its positions at once; only the two pairs beside each new token are looked up
again and entered in the index. Documents are then put together from the ids of their
words. Words of earlier blocks are known to later ones, up to ``KNOWN`` of them.

Order within a word is that of the usual loop (the least rank first, from the left):
positions of a rank that overlap are taken alternately from the left, and where a new
token makes a pair of lower rank than the one at work, the later positions of that word
wait until the lower rank is done. A word that is a token as a whole is that token.

Nothing is shuffled: a task needs no words but its own. Its memory is one block, its
distinct words and the vocabulary, whatever the size of the corpus; a long document makes
a block by itself.

Defined cases: a null or empty text has no ids and decodes to no bytes; repeated rows
and null ids are encoded like other rows; other columns are ignored; an empty table
returns no rows; ids outside the vocabulary are an error when they are decoded.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterable, Iterator
from functools import cache
from heapq import heappop, heappush
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
BLOCK = 1 << 23
KNOWN = 1 << 18
#: Positions of one rank that are merged in one step.
STEP = 1 << 16
#: Letters, digits and blanks up to U+00FF, for texts that have no other characters.
LETTERS, DIGITS, BLANKS = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
LATIN = (
    rf" ?[{LETTERS}]+| ?[{DIGITS}]+|'(?:s|t|re|ve|m|ll|d)| ?[^{BLANKS}{LETTERS}{DIGITS}]+"
    rf"|[{BLANKS}]+(?![^{BLANKS}])|[{BLANKS}]+"
)
FREE = np.int32(np.iinfo(np.int32).max)
ID = np.dtype("<u4")


class Vocabulary:
    """Tokens by rank, and the rank of every pair of tokens that makes a token."""

    def __init__(self, path: str):
        with open(path, "rb") as lines:
            self.ids = {base64.b64decode(t): int(rank) for t, rank in map(bytes.split, lines)}
        self.tokens = [b""] * (max(self.ids.values()) + 1)
        for token, rank in self.ids.items():
            self.tokens[rank] = token
        self.bytes = np.array([self.ids[bytes([b])] for b in range(256)], dtype=np.int32)
        pairs = [
            (self.ids[token[:k]] << 32 | self.ids[token[k:]], rank)
            for token, rank in self.ids.items()
            for k in range(1, len(token))
            if token[:k] in self.ids and token[k:] in self.ids
        ]
        table = np.array(sorted(pairs), dtype=np.int64).reshape(-1, 2)
        self.pairs, self.merged = table[:, 0].copy(), table[:, 1].astype(np.int32)
        parts = np.stack([self.pairs >> 32, self.pairs & 0xFFFFFFFF])
        #: Tokens that may be part of a pair of lower rank than their own.
        self.early = np.zeros(len(self.tokens), dtype=bool)
        self.early[parts[self.merged < parts]] = True

    def rank(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The rank of each pair, ``FREE`` where it makes no token."""
        if not len(self.pairs):
            return np.full(len(left), FREE)
        pair = left.astype(np.int64) << 32 | right
        place = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        return np.where(self.pairs[place] == pair, self.merged[place], FREE)


@cache
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


def merged_places(first: np.ndarray, second: np.ndarray) -> np.ndarray:
    """Both, each place once, in ascending order."""
    both = np.concatenate([first, second])
    both.sort()
    return both[np.concatenate([[True], both[1:] != both[:-1]])] if len(both) else both


def alternate(chained: np.ndarray) -> np.ndarray:
    """Of each run of positions that overlap the one before, the first, third and so on."""
    place = np.arange(len(chained) + 1)
    begins = np.concatenate([[0], np.where(chained, 0, place[1:])])
    return (place - np.maximum.accumulate(begins)) % 2 == 0


def replay(words: list[bytes], known: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """(ids of all words one after another, number of ids of each word)."""
    data = b"".join(words)
    n = len(data)
    ends = np.cumsum([len(word) for word in words], dtype=np.int64)
    starts = np.concatenate([[0], ends[:-1]]).astype(np.int64)
    # place n stands for the ends of words: it has no token and makes no pair
    token = np.append(known.bytes[np.frombuffer(data, np.uint8)], np.int32(-1))
    place = np.int32 if n < FREE else np.int64
    after = np.arange(1, n + 2, dtype=place)
    after[ends[ends > starts] - 1] = n
    before = np.arange(-1, n, dtype=place)
    before[starts[ends > starts]] = n
    rank = np.full(n + 1, FREE)
    rank[:n] = known.rank(token[:n], token[after[:n]])

    index: dict[int, list[np.ndarray]] = {}
    heap: list[int] = []

    def enter(at: np.ndarray) -> None:
        """File positions, in ascending order, under the rank of their pair."""
        own = rank[at]
        order = np.argsort(own, kind="stable")
        own, at = own[order], at[order]
        cuts = [0, *(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), len(own)]
        for first, end in zip(cuts, cuts[1:]):
            number = int(own[first])
            if number not in index:
                heappush(heap, number)
            index.setdefault(number, []).append(at[first:end])

    if (rank < FREE).any():
        enter(np.flatnonzero(rank < FREE))
    while heap:
        now = heappop(heap)
        found = index.pop(now)
        at = found[0] if len(found) == 1 else merged_places(found[0], np.concatenate(found[1:]))
        later = [at[STEP:]]
        at = at[:STEP]
        at = every = at[rank[at] == now]
        chained = before[at[1:]] == at[:-1]
        if chained.any():
            at = at[alternate(chained)]
        if len(at) and known.early[now]:
            at, waiting = undisturbed(at, every, now, known, token, before, after, starts)
            later.insert(0, waiting)
        if any(map(len, later)):
            index[now] = [np.concatenate(later)]
            heappush(heap, now)
        if not len(at):
            continue
        second = after[at]
        third = after[second]
        token[at] = now
        token[second] = -1
        rank[second] = FREE
        after[at] = third
        before[third] = at
        left = before[at]
        touched = merged_places(left[left < n], at)
        rank[touched] = known.rank(token[touched], token[after[touched]])
        touched = touched[rank[touched] < FREE]
        if len(touched):
            enter(touched)
    live = token[:n] >= 0
    total = np.concatenate([[0], np.cumsum(live)])
    return token[:n][live].astype(ID), total[ends] - total[starts]


def undisturbed(
    at: np.ndarray,
    every: np.ndarray,
    now: int,
    known: Vocabulary,
    token: np.ndarray,
    before: np.ndarray,
    after: np.ndarray,
    starts: np.ndarray,
) -> tuple[np.ndarray, np.ndarray]:
    """Positions to merge now, and those of ``every`` that wait for a lower rank in their word."""
    merged = np.full(len(at), now, dtype=np.int32)
    left = before[at]
    beside = token[left]
    beside[1:][before[left[1:]] == at[:-1]] = now
    lower = (known.rank(beside, merged) < now) | (known.rank(merged, token[after[after[at]]]) < now)
    if not lower.any():
        return at, at[:0]
    stop = np.full(len(starts) + 1, np.iinfo(np.int64).max)
    np.minimum.at(stop, np.searchsorted(starts, at[lower], side="right"), at[lower])
    go = at <= stop[np.searchsorted(starts, at, side="right")]
    return at[go], every[every > stop[np.searchsorted(starts, every, side="right")]]


class Numbers(dict):
    """Words numbered in the order in which they are first asked for."""

    def __missing__(self, word: str) -> int:
        self[word] = number = len(self)
        return number


def is_latin(text: str) -> bool:
    """Whether all characters are below U+0100."""
    if text.isascii():
        return True
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return False
    return True


class Encoder:
    """Documents of one task, a block at a time."""

    def __init__(self, path: str, pattern: str, known: int = KNOWN):
        self.vocabulary, self.most = vocabulary(path), known
        self.cut = self.cut_latin = regex.compile(pattern).findall
        if pattern == public_tokenizers.PATTERN:
            self.cut_latin = re.compile(LATIN).findall
        self.forget()

    def forget(self) -> None:
        self.numbers = Numbers()
        self.flat, self.count = np.zeros(0, ID), np.zeros(0, np.int32)

    def words(self, text: str) -> np.ndarray:
        found = (self.cut_latin if is_latin(text) else self.cut)(text)
        return np.fromiter(map(self.numbers.__getitem__, found), np.int32, len(found))

    def learn(self) -> None:
        """Encode the words that came since the last time."""
        new = [word.encode() for word in islice(self.numbers, len(self.count), None)]
        ids = self.vocabulary.ids
        whole = np.array([ids.get(word, -1) for word in new], dtype=np.int64)
        flat, count = replay([word for word, one in zip(new, whole) if one < 0], self.vocabulary)
        counts = np.ones(len(new), np.int32)
        counts[whole < 0] = count
        single = np.repeat(whole >= 0, counts)
        own = np.empty(len(single), ID)
        own[single] = whole[whole >= 0]
        own[~single] = flat
        self.flat, self.count = np.concatenate([self.flat, own]), np.concatenate([self.count, counts])

    def block(self, documents: list[np.ndarray]) -> Iterator[bytes]:
        """The ids of each document, little-endian, four bytes an id."""
        self.learn()
        start = np.cumsum(self.count, dtype=np.int64) - self.count
        for words in documents:
            count = self.count[words]
            shift = np.repeat(start[words] - (np.cumsum(count, dtype=np.int64) - count), count)
            yield self.flat[shift + np.arange(len(shift))].tobytes()
        if len(self.numbers) > self.most:
            self.forget()


def encode(
    docs: DataFrame,
    ranks: str | None = None,
    pattern: str = public_tokenizers.PATTERN,
    block: int = BLOCK,
    known: int = KNOWN,
) -> DataFrame:
    """(doc_id, ids) of every row: ids as little-endian unsigned 32-bit integers."""
    ranks = ranks or public_tokenizers.path(RANKS)
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(ranks, pattern, known)
        keys: list = []
        held: list[np.ndarray] = []
        size = 0

        def rows(id_type: pa.DataType) -> Iterator[pa.RecordBatch]:
            at = 0
            for part in bounded(encoder.block(held), block):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys[at : at + len(part)], id_type), pa.array(part, pa.binary())], names=["doc_id", "ids"]
                )
                at += len(part)
            keys.clear()
            held.clear()

        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                text = text.as_py()
                keys.append(key)
                held.append(encoder.words(text))
                size += len(text)
                if size >= block:
                    yield from rows(id_type)
                    size = 0
        if keys:
            yield from rows(id_type)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, ids binary"
    )


def bounded(items: Iterable[bytes], most: int, rows: int = 10_000) -> Iterator[list[bytes]]:
    """Lists of up to ``rows`` items that end when they have ``most`` bytes."""
    part: list[bytes] = []
    size = 0
    for item in items:
        part.append(item)
        size += len(item)
        if size >= most or len(part) >= rows:
            yield part
            part, size = [], 0
    if part:
        yield part


def decode(encoded: DataFrame, ranks: str | None = None, block: int = BLOCK) -> DataFrame:
    """``encoded`` with the bytes of its ids in column ``decoded``."""
    ranks = ranks or public_tokenizers.path(RANKS)
    place = encoded.columns.index("ids")
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.schema.fields)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        token = vocabulary(ranks).tokens.__getitem__
        for batch in batches:
            at = 0
            found = (
                b"".join(map(token, np.frombuffer(ids.as_py() or b"", ID).tolist())) for ids in batch.column(place)
            )
            for part in bounded(found, block):
                columns = [column.slice(at, len(part)) for column in batch.columns]
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(part, pa.binary())], names=[*batch.schema.names, "decoded"]
                )
                at += len(part)

    return encoded.mapInArrow(run, f"{kinds}, decoded binary")


def digests(encoded: DataFrame) -> DataFrame:
    """doc_id, n_tokens and the SHA-256 of the ids and of the decoded bytes."""
    return decode(encoded).select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
