"""Importance resampling of documents towards the words of a target corpus.

Features are runs of words, and a feature's bucket is the CRC-32 of its bytes modulo the
number of buckets. Words are found with an Aho-Corasick automaton over the distinct words
of a block of text (``BLOCK`` bytes), each bounded by delimiters; its payload is the
word's number, which leads to its CRC-32 and its length. The automaton reads a text once
and emits the payloads in order; a run's CRC is composed of the payloads of its words and
of the blank between them, without reading the bytes again, and gives the bucket. Every
word is in the automaton, as it is made from the block it reads; it serves later blocks
too as long as they bring no new word, and is begun anew above ``KNOWN`` words.

Both corpora are counted by bucket. A document's weight is the sum of its features'
gains; the ``share`` of the documents of ``least_words`` words or more that have the
highest scores, weight plus Gumbel noise from the id, is drawn. That is a sample without
replacement by importance.

The bucket numbers of every document are written to the shared folder, two bytes each,
so texts are read once. A task sums its own buckets before they are shuffled; the gains
are one number a bucket, whatever the size of the corpora. Ranks come from a sort by
range: a task numbers its own rows, and the number of rows before its range is added.

Defined cases: a null or empty text has no words, weight 0 and no rank; repeated rows
count and are drawn like other rows; among equal scores the smaller doc_id comes first
and a null one last, which has the noise of an empty id; other columns are ignored; an
empty target has equal gains everywhere; an empty table returns no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from zlib import crc32

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stage

BUCKETS = 10_000
SEED = 2024
LEAST_WORDS = 20
SHARE = 10
BLOCK = 1 << 23
KNOWN = 1 << 18
BUCKET = np.dtype("<u2")
#: Bytes that are no part of a word become blanks, A-Z small letters; bytes from 0x80 on are parts of words.
FOLDED = bytes(
    c if 0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or c >= 0x80 else c + 32 if 0x41 <= c <= 0x5A else 0x20
    for c in range(256)
)


def folded(text: str) -> bytes:
    """The text's bytes in small letters, with a blank for every delimiter and around it."""
    return b" " + text.encode().translate(FOLDED) + b" "


@cache
def zeros(power: int) -> tuple[int, ...]:
    """What 2 ** power zero bytes make of each bit of a CRC-32 register."""
    if power:
        once = zeros(power - 1)
        return tuple(times(once, row) for row in once)
    column = []
    for bit in range(32):
        register = 1 << bit
        for _ in range(8):
            register = register >> 1 ^ (0xEDB88320 if register & 1 else 0)
        column.append(register)
    return tuple(column)


def times(matrix: tuple[int, ...], register: int) -> int:
    found = 0
    for row in matrix:
        if register & 1:
            found ^= row
        register >>= 1
    return found


def composed(left: np.ndarray, right: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of two strings in sequence, from theirs and the second one's length."""
    found = left.copy()
    power = 0
    while (length >> power).any():
        matrix = zeros(power)
        shifted = np.zeros_like(found)
        for bit, row in enumerate(matrix):
            shifted ^= np.where(found >> np.uint32(bit) & np.uint32(1), np.uint32(row), np.uint32(0))
        found = np.where(length >> power & 1, shifted, found)
        power += 1
    return found ^ right


class Scanner:
    """The automaton of one task, with the CRC-32 and the length of each word."""

    def __init__(self, longest: int = 1, known: int = KNOWN):
        self.longest, self.most = longest, known
        self.forget()

    def forget(self) -> None:
        self.numbers: dict[bytes, int] = {}
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS)
        self.crc, self.length = np.zeros(0, np.uint32), np.zeros(0, np.int64)

    def learn(self, texts: list[bytes]) -> None:
        """Enter the words of folded texts."""
        new = sorted(set().union(*(text.split() for text in texts)) - self.numbers.keys())
        if not new:
            return
        if self.numbers and len(self.numbers) + len(new) > self.most:
            self.forget()
            return self.learn(texts)
        for word in new:
            self.numbers[word] = number = len(self.numbers)
            self.automaton.add_word(f" {word.decode('latin-1')} ", number)
        self.automaton.make_automaton()
        self.crc = np.concatenate([self.crc, np.array([crc32(word) for word in new], np.uint32)])
        self.length = np.concatenate([self.length, np.array([len(word) for word in new], np.int64)])

    def words(self, text: bytes) -> np.ndarray:
        """Numbers of the words of a folded text, in order."""
        if not self.numbers:
            return np.zeros(0, np.int64)
        return np.fromiter((number for _, number in self.automaton.iter(text.decode("latin-1"))), np.int64)

    def runs(self, crc: np.ndarray, length: np.ndarray) -> np.ndarray:
        """CRC-32 of every run of 1 to ``longest`` words."""
        found, blank = [crc], np.full(len(crc), crc32(b" "), np.uint32)
        run, one = crc, np.ones(len(crc), np.int64)
        for size in range(2, min(self.longest, len(crc)) + 1):
            run = composed(run[:-1], blank[size - 1 :], one[size - 1 :])
            run = composed(run, crc[size - 1 :], length[size - 1 :])
            found.append(run)
        return np.concatenate(found)


def pieces(text: bytes, most: int) -> Iterator[bytes]:
    """A folded text in parts that end at a blank, which the next part has too."""
    start = 0
    while len(text) - start > most:
        end = text.rfind(b" ", start + 1, start + most)
        end = end if end > 0 else text.find(b" ", start + most)
        yield text[start : end + 1]
        start = end
    yield text[start:]


def bucketed(
    docs: DataFrame, buckets: int = BUCKETS, longest: int = 1, block: int = BLOCK, known: int = KNOWN
) -> DataFrame:
    """(doc_id, n_words, found) of every row: the buckets of its features, two bytes each."""
    if not 0 < buckets <= 1 << 16:
        raise ValueError("buckets are numbered in two bytes")
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(longest, known)
        keys: list = []
        parts: list[tuple[int, bytes]] = []
        payloads: dict[int, list] = {}

        def scan() -> None:
            """File the payloads of the parts that wait by document."""
            scanner.learn([part for _, part in parts])
            for document, part in parts:
                number = scanner.words(part)
                payloads.setdefault(document, []).append((scanner.crc[number], scanner.length[number]))
            parts.clear()

        def rows(id_type: pa.DataType) -> pa.RecordBatch:
            scan()
            found, count = [], []
            for document in range(len(keys)):
                crc, length = map(np.concatenate, zip(*payloads.pop(document)))
                count.append(len(crc))
                found.append((scanner.runs(crc, length) % np.uint32(buckets)).astype(BUCKET).tobytes())
            batch = pa.RecordBatch.from_arrays(
                [pa.array(keys, id_type), pa.array(count, pa.int64()), pa.array(found, pa.binary())],
                names=["doc_id", "n_words", "found"],
            )
            keys.clear()
            return batch

        held = waiting = 0  # bytes of documents not yet returned, and of those not yet scanned
        for batch in batches:
            id_type = batch.schema.field(0).type
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                keys.append(key)
                for part in pieces(folded(text.as_py()), block):
                    if waiting + len(part) > block and parts:
                        scan()
                        waiting = 0
                    parts.append((len(keys) - 1, part))
                    waiting += len(part)
                    held += len(part)
                if held >= block or len(keys) >= 10_000:
                    yield rows(id_type)
                    held = waiting = 0
        if keys:
            yield rows(id_type)

    return docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).mapInArrow(
        run, f"doc_id {kind}, n_words long, found binary"
    )


def bucket_counts(features: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, n): each task counts its own rows before the shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for found in batch.column(0):
                total += np.bincount(np.frombuffer(found.as_py(), BUCKET), minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["bucket", "n"])

    counted = features.select("found").mapInArrow(run, "bucket long, n long")
    return counted.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(source: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket, from bucketed corpora; a number a bucket comes to the driver."""
    counts = []
    for features in (source, target):
        found = bucket_counts(features, buckets).toArrow()
        count = np.zeros(buckets)
        count[found.column("bucket").to_numpy()] = found.column("n").to_numpy()
        counts.append(count)
    (s, t), (all_s, all_t) = counts, map(np.sum, counts)
    return np.floor(1000 * np.log((t + 1) * (all_s + buckets) / ((s + 1) * (all_t + buckets)))).astype(np.int64)


def weighed(features: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_words, n_features and weight of bucketed documents."""
    kind = features.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [np.frombuffer(x.as_py(), BUCKET) for x in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    batch.column(1),
                    pa.array([len(x) for x in found], pa.int64()),
                    pa.array([int(gain[x].sum()) for x in found], pa.int64()),
                ],
                names=["doc_id", "n_words", "n_features", "weight"],
            )

    return features.mapInArrow(run, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """Gumbel noise of an id, in thousandths."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.ln(-F.ln((h + 0.5) / 4294967296.0))).cast("long")


def ranked(rows: DataFrame, tasks: int | None = None) -> DataFrame:
    """``rows`` with their place (1, 2, 3, ...) by score downwards and doc_id, nulls last.

    Sorted by range and written; a task's rows are numbered by Spark, and the number of
    rows in the ranges before it is added, from one number for each task.
    """
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    tasks = tasks or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    own = F.monotonically_increasing_id()
    placed = stage(
        rows.repartitionByRange(tasks, *order)
        .sortWithinPartitions(*order)
        .withColumns({"_task": F.shiftright(own, 33), "_place": own.bitwiseAND((1 << 33) - 1)}),
        "ranked",
    )
    sizes = {row["_task"]: row["count"] for row in placed.groupBy("_task").count().collect()}
    before = [(task, sum(n for other, n in sizes.items() if other < task)) for task in sizes]
    offsets = rows.sparkSession.createDataFrame(before, "_task long, _before long")
    place = (F.col("_before") + F.col("_place") + 1).alias("place")
    return placed.join(F.broadcast(offsets), "_task").select(*rows.columns, place)


def resample(
    docs: DataFrame,
    target: DataFrame,
    share: int = SHARE,
    least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS,
    longest: int = 1,
    seed: int = SEED,
) -> DataFrame:
    """doc_id, n_features, weight, score and rank of every row; the rank of undrawn rows is null.

    ``share`` is in hundredths of the documents of ``least_words`` words or more, ``target``
    a table with a column ``text``.
    """
    features = stage(bucketed(docs, buckets, longest), "features")
    aim = target.select(F.lit(0).cast("long").alias("doc_id"), "text")
    aims = stage(bucketed(aim, buckets, longest), "target")
    gain = gains(features, aims, buckets)
    score = F.col("weight") + noise(F.col("doc_id"), seed)
    scored = stage(weighed(features, gain).withColumn("score", score), "scored")
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * share // 100
    rank = F.when(F.col("place") <= drawn, F.col("place")).alias("rank")
    columns = ["doc_id", "n_features", "weight", "score"]
    others = scored.where(F.col("n_words") < least_words).select(*columns, F.lit(None).cast("long").alias("rank"))
    return ranked(able).select(*columns, rank).unionByName(others)
