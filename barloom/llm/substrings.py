"""Exact substring removal by relative Lempel-Ziv factors.

The reference of a document is every document with a smaller id. It is indexed in
blocks by seed: the seed of a 13-word window is its least hashed 5-word gram (a
minimizer), so equal windows have equal seeds wherever they stand, and runs of
neighbouring windows share one seed occurrence.

1. ``parse_block`` reads a batch of documents, indexes it and factors the batch
   against itself: of equal windows, only those of the smallest document go on; the
   others have their reference position already. What goes on is dealt to reference
   blocks by seed, and windows of a heavy seed by seed and check bits, so that a gram in
   ever changing surroundings does not fill one block. Heavy seeds are found in every
   ``PART``-th document, as those that ``HEAVY`` windows or more would have; which ones are
   found does not change results, as equal windows have equal seeds and checks. A block gets
   at most one row of a window from each batch, however often a passage repeats.
2. ``resolve_block`` merges one reference block of all batches and factors what it holds
   of every document against it, a part of the block's seeds after the other, so that its
   memory is that of the rows and of one part. A window's reference position is the first one in the
   smallest document that has it, and a factor goes on as long as the next window's
   position is the next one of the same document.
3. A document's factors from all blocks meet at their boundaries: those that continue
   each other in the same document are one longer factor (``joined_factors``), and a greedy
   parse from the left takes of the factors that begin before the end reached so far the
   one that goes furthest (``greedy_parse``). Windows over a boundary are factors of their
   own, so no repeated window is missed, and a factor has ``WINDOW`` words or more.
4. The words that the parse covers are left out.

A window is known by the 64-bit hash of its seed with 48 more bits of all its
words; only windows with an equal seed are compared by the latter.

Defined cases: a null or wordless text has no words and keeps the hash of the empty
text; a row without doc_id neither loses words nor counts as a reference; rows with
the same doc_id don't count against each other; repeated rows return as often as
they come; other columns are ignored; an empty table returns no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import extended, stage

WINDOW = 13
GRAM = 5
BATCH_WORDS = 1 << 18
KNOWN_WORDS = 1 << 17
BLOCK_BYTES = 6 << 20
HEAVY = 1 << 18
PART = 64
ODD = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93)
PART_WINDOWS = 1 << 17
PIECE = 500
FACTORS = "doc_id long, sig long, start int, stop int, ref long, ref_start int"
FACTOR_NAMES = ["doc_id", "sig", "start", "stop", "ref", "ref_start"]
FACTOR_KINDS = ("<i8", "<i8", "<i4", "<i4", "<i8", "<i4")
OWN = len(FACTOR_KINDS)  # numbers of a factor
LOW48 = np.uint64((1 << 48) - 1)


def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of few rows, so that few texts at once are Python values."""
    for batch in batches:
        for at in range(0, batch.num_rows, PIECE):
            yield batch.slice(at, PIECE)


class WordHashes(dict):
    """XXH64 of words, kept while the number of different words is bounded."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > KNOWN_WORDS:
            self.clear()
        value = self[word] = xxh64_intdigest(word)
        return value


def mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(29))) * np.uint64(ODD[2])
    return values ^ (values >> np.uint64(32))


def rolling(words: np.ndarray, width: int, base: int) -> np.ndarray:
    """Hash of each run of ``width`` words."""
    count = len(words) - width + 1
    total = np.zeros(count, dtype=np.uint64)
    for k in range(width):
        total *= np.uint64(base)
        total += words[k : k + count]
    return mixed(total)


def seeded_windows(words: np.ndarray, document: np.ndarray, window: int, gram: int):
    """start, seed position, seed and check bits of every window within one document."""
    if len(words) < window:
        empty = np.zeros(0, dtype=np.int64)
        return empty, empty, empty.astype(np.uint64), empty.astype(np.uint64)
    grams = rolling(words, gram, ODD[0])
    count = len(words) - window + 1
    least, place = grams[:count].copy(), np.zeros(count, dtype=np.int64)
    for k in range(1, window - gram + 1):
        other = grams[k : k + count]
        smaller = other < least
        least[smaller] = other[smaller]
        place[smaller] = k
    starts = np.flatnonzero(document[:count] == document[window - 1 :])
    checks = rolling(words, window, ODD[1])[starts] & LOW48
    return starts, (starts + place[starts]), least[starts], checks


def factors_of(
    document: np.ndarray, starts: np.ndarray, ref: np.ndarray, ref_starts: np.ndarray
) -> list[np.ndarray]:
    """Factors of following windows at following places of one reference document.

    document, first start, last start + 1, reference and the first start there.
    """
    if not len(starts):
        return [document, starts, starts, ref, ref_starts]
    order = np.lexsort((starts, document))
    document, starts, ref, ref_starts = (x[order] for x in (document, starts, ref, ref_starts))
    new = np.ones(len(starts), dtype=bool)
    new[1:] = (
        (document[1:] != document[:-1])
        | (starts[1:] > starts[:-1] + 1)
        | (ref[1:] != ref[:-1])
        | (ref_starts[1:] - ref_starts[:-1] != starts[1:] - starts[:-1])
    )
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(starts)) - 1
    return [document[first], starts[first], starts[last] + 1, ref[first], ref_starts[first]]


def references(ids: np.ndarray, seeds: np.ndarray, checks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which windows also start in a row of a smaller id, and the first such window."""
    order = np.lexsort((ids, checks, seeds))
    s, c = seeds[order], checks[order]
    new = np.ones(len(order), dtype=bool)
    new[1:] = (s[1:] != s[:-1]) | (c[1:] != c[:-1])
    ref = np.empty(len(order), dtype=np.int64)
    ref[order] = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    return ids > ids[ref], ref


def joined_factors(factors: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Factors (start, stop, reference, start there) joined where one continues another."""
    found: list[tuple[int, int, int, int]] = []
    last: dict[tuple[int, int], int] = {}  # reference and shift: place in found
    for start, stop, ref, ref_start in sorted(factors):
        place = last.get((ref, ref_start - start))
        if place is not None and found[place][1] >= start:
            first, end, _, there = found[place]
            found[place] = (first, max(end, stop), ref, there)
        else:
            last[ref, ref_start - start] = len(found)
            found.append((start, stop, ref, ref_start))
    return found


def greedy_parse(factors: list[tuple[int, int, int, int]], window: int) -> list[tuple[int, int, int, int]]:
    """(start, length, reference, start there), from the left, each reaching as far as any.

    Start and length are in words; what one factor has covered the next one begins after.
    """
    parsed: list[tuple[int, int, int, int]] = []
    best, reached, at = None, 0, 0
    ordered = sorted(joined_factors(factors))
    while at < len(ordered) or best:
        while at < len(ordered) and (best is None or ordered[at][0] <= reached):
            start, stop, ref, ref_start = ordered[at]
            if best is None and start > reached:
                reached = start
            end = stop + window - 1
            if end > reached and (best is None or end > best[0]):
                best = end, start, ref, ref_start
            at += 1
        if best is None:
            continue
        end, start, ref, ref_start = best
        begin = max(start, reached)
        parsed.append((begin, end - begin, ref, ref_start + begin - start))
        reached, best = end, None
    return parsed


def among(seeds: np.ndarray, heavy: np.ndarray | None) -> np.ndarray:
    if heavy is None or not len(heavy):
        return np.zeros(len(seeds), dtype=bool)
    return heavy[np.minimum(np.searchsorted(heavy, seeds), len(heavy) - 1)] == seeds


def heavy_seeds(source: DataFrame, window: int, gram: int) -> np.ndarray:
    """Seeds that ``HEAVY`` windows or more have by a count of every ``PART``-th document."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        for batch in pieces(batches):
            lists = [text.split() for text in batch.column(0).to_pylist()]
            words = np.array([hashes[word] for one in lists for word in one], dtype=np.uint64)
            row = np.repeat(np.arange(len(lists)), [len(one) for one in lists])
            seeds, n = np.unique(seeded_windows(mixed(words), row, window, gram)[2], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(seeds.view(np.int64)), pa.array(n)], names=["seed", "n"])

    some = source.where(F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(PART)) == 0).select("text")
    counts = some.mapInArrow(count, "seed long, n long").groupBy("seed").agg(F.sum("n").alias("n"))
    found = counts.where(F.col("n") * PART >= HEAVY).select("seed").toArrow().column(0).to_numpy()
    return np.sort(found.astype(np.int64).view(np.uint64))


def parse_block(
    ids: list[int], sigs: list[int], texts: list[bytes], blocks: int, window: int, gram: int,
    hashes: WordHashes, heavy: np.ndarray | None = None,
) -> Iterator[tuple[int, bytes]]:
    """Parse a batch against itself; the rest and the found factors, by reference block.

    ``heavy`` has the heavy seeds, sorted.
    """
    lists = [text.split() for text in texts]
    sizes = np.array([len(words) for words in lists], dtype=np.int64)
    words = np.fromiter(
        (hashes[word] for words in lists for word in words), dtype=np.uint64, count=sizes.sum()
    )
    row = np.repeat(np.arange(len(ids)), sizes)
    begin = np.cumsum(sizes) - sizes
    starts, places, seeds, checks = seeded_windows(mixed(words), row, window, gram)
    doc, sig = np.array(ids, dtype=np.int64), np.array(sigs, dtype=np.int64)
    at = row[starts]
    hit, ref = references(doc[at], seeds, checks)
    inside = starts - begin[at]
    spread = among(seeds, heavy)
    dealt = np.where(spread, mixed(seeds ^ (checks * np.uint64(ODD[1]))), seeds)
    block = (dealt >> np.uint64(20)) % np.uint64(blocks)
    own = factors_of(at[hit], inside[hit], doc[at[ref[hit]]], inside[ref[hit]])
    target = own[0] % blocks
    rest = ~hit
    starts, places, seeds, checks, at, block, spread = (
        x[rest] for x in (starts, places, seeds, checks, at, block, spread)
    )
    head = np.ones(len(starts), dtype=bool)  # windows that share one seed occurrence
    head[1:] = (places[1:] != places[:-1]) | (starts[1:] != starts[:-1] + 1) | (at[1:] != at[:-1])
    head |= spread  # each goes to a block of its own
    first = np.flatnonzero(head)
    length = np.diff(np.append(first, len(starts)))
    order = np.argsort(block[first], kind="stable")
    own_order = np.argsort(target, kind="stable")
    sorted_block, sorted_target = block[first][order].astype(np.int64), target[own_order]
    for number in np.union1d(sorted_block, sorted_target).tolist():
        chosen = order[slice(*np.searchsorted(sorted_block, [number, number + 1]))]
        found = own_order[slice(*np.searchsorted(sorted_target, [number, number + 1]))]
        heads, many = first[chosen], length[chosen]
        inner = np.repeat(heads - (np.cumsum(many) - many), many) + np.arange(many.sum())
        used, local = np.unique(at[heads], return_inverse=True)
        check = checks[inner]
        yield number, joined(
            doc[used],
            sig[used],
            local.astype("<u4"),
            (starts[heads] - begin[at[heads]]).astype("<u4"),
            many.astype("u1"),
            seeds[heads],
            check.astype("<u4"),
            (check >> np.uint64(32)).astype("<u2"),
            np.stack([doc[own[0][found]], sig[own[0][found]], *(x[found] for x in own[1:])]),
        )


KINDS = ("<i8", "<i8", "<u4", "<u4", "u1", "<u8", "<u4", "<u2", "<i8")


def joined(*parts: np.ndarray) -> bytes:
    """Arrays of KINDS as one value, after their sizes."""
    sizes = np.array([part.size for part in parts], dtype="<u4")
    return b"".join([sizes.tobytes(), *(part.tobytes() for part in parts)])


def parted(data: bytes | pa.Buffer) -> list[np.ndarray]:
    sizes = np.frombuffer(data, "<u4", len(KINDS))
    parts, at = [], sizes.nbytes
    for size, kind in zip(sizes.tolist(), KINDS):
        parts.append(np.frombuffer(data, kind, size, at))
        at += parts[-1].nbytes
    return parts


def resolve_block(rows: pa.Table, most: int = PART_WINDOWS) -> pa.Table:
    """All of a reference block: factors of what it has of each document, against itself.

    Equal windows have equal seeds, so seeds are taken in parts of about ``most`` windows:
    beside the rows themselves only what is known of one part takes memory.
    """
    docs, sigs, places, starts, many, seeds, lows, highs, owns = [], [], [], [], [], [], [], [], []
    count = 0
    for data in rows.column("data"):
        doc, sig, local, *heads, own = parted(data.as_buffer())
        places.append(local + np.uint32(count))
        count += len(doc)
        for part, values in zip((docs, sigs, starts, many, seeds, lows, highs), (doc, sig, *heads)):
            part.append(values)
        owns.append(own.reshape(OWN, -1))
    row, start, many, seed, low, high = (
        np.concatenate(x) for x in (places, starts, many, seeds, lows, highs)
    )
    pairs, number = pairs_of(np.concatenate(docs), np.concatenate(sigs))
    row = number[row]
    first = np.cumsum(many, dtype=np.int64) - many
    parts = max(1, -(-len(low) // most))
    part = (mixed(seed) >> np.uint64(32)) % np.uint64(parts)
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(parts, dtype=np.uint64), side="right")
    found = [list(own) for own in owns]
    for chosen in np.split(order, ends[:-1]):
        length = many[chosen].astype(np.int64)
        step = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        inner = np.repeat(first[chosen], length) + step
        at = np.repeat(row[chosen], length)
        begin = np.repeat(start[chosen].astype(np.int64), length) + step
        checks = high[inner].astype(np.uint64) << np.uint64(32) | low[inner]
        doc = pairs[0][at]
        hit, ref = references(doc, np.repeat(seed[chosen], length), checks)
        at, *factor = factors_of(at[hit], begin[hit], doc[ref[hit]], begin[ref[hit]])
        found.append([*pairs[:, at], *factor])
    columns = (np.concatenate(x).astype(kind) for x, kind in zip(zip(*found), FACTOR_KINDS))
    return pa.table([pa.array(x) for x in columns], FACTOR_NAMES)


def pairs_of(doc: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The different pairs of both, and the number of each row's pair."""
    order = np.lexsort((sig, doc))
    pairs = np.stack([doc[order], sig[order]])
    new = np.ones(len(order), dtype=bool)
    new[1:] = (pairs[:, 1:] != pairs[:, :-1]).any(axis=0)
    number = np.empty(len(order), dtype=np.uint32)
    number[order] = np.cumsum(new) - 1
    return pairs[:, new], number


def factor_mask(count: int, parsed: list[tuple[int, int, int, int]]) -> np.ndarray:
    """Words that the factors of a parse cover."""
    mask = np.zeros(count, dtype=bool)
    for start, length, _, _ in parsed:
        mask[start : start + length] = True
    return mask


def duplicate_factors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, sig (hash of the text), start, stop, ref, ref_start: factors of each block, by window."""
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-size // BLOCK_BYTES))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes = WordHashes()
        held: tuple[list, list, list] = ([], [], [])
        load = 0

        def flush() -> Iterator[pa.RecordBatch]:
            rows = parse_block(*held, blocks, window, gram, hashes, shared.value)
            while some := list(islice(rows, 256)):
                number, data = zip(*some)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(number, pa.int64()), pa.array(data, pa.binary())],
                    names=["block", "data"],
                )
            for part in held:
                part.clear()

        for batch in pieces(batches):
            for doc_id, sig, text in zip(*(column.to_pylist() for column in batch.columns)):
                for part, value in zip(held, (doc_id, sig, text)):
                    part.append(value)
                load += len(text) // 6 + 1
                if load > BATCH_WORDS:
                    yield from flush()
                    load = 0
        if held[0]:
            yield from flush()

    source = docs.where("doc_id is not null and text is not null").select(
        F.col("doc_id").cast("long"), F.xxhash64("text").alias("sig"), F.col("text").cast("binary")
    )
    if kind not in ("bigint", "int", "smallint", "tinyint"):
        raise TypeError("doc_id must be an integer")
    shared = docs.sparkSession.sparkContext.broadcast(heavy_seeds(source, window, gram))
    most = PART_WINDOWS

    def resolve(rows: pa.Table) -> pa.Table:
        return resolve_block(rows, most)

    parsed = source.mapInArrow(parse, "block long, data binary")
    return parsed.groupBy("block").applyInArrow(resolve, FACTORS)


def listed_factors(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, sig and the list of factors of each text that has any."""
    factor = F.struct("start", "stop", "ref", "ref_start")
    found = duplicate_factors(docs, window, gram).groupBy("doc_id", "sig")
    return found.agg(F.collect_list(factor).alias("found")).select(
        "doc_id", "sig", *[F.col("found")[name].alias(name) for name in ("start", "stop", "ref", "ref_start")]
    )


def parse(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, sig, start, length, ref and ref_start: the parse of each text, in words.

    ``length`` words from ``start`` on stand in document ``ref`` from ``ref_start`` on.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            rows = [
                (doc_id, sig, *factor)
                for doc_id, sig, *found in zip(*(column.to_pylist() for column in batch.columns))
                for factor in greedy_parse(list(zip(*found)), window)
            ]
            for at in range(0, len(rows), 10_000):
                columns = zip(*rows[at : at + 10_000])
                yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in columns], names=names)

    names = ["doc_id", "sig", "start", "length", "ref", "ref_start"]
    return listed_factors(docs, window, gram).mapInArrow(run, ", ".join(f"{name} long" for name in names))


def parsed_rows(
    docs: DataFrame, carry: list[str], window: int = WINDOW, gram: int = GRAM
) -> DataFrame:
    """row (the carried columns), n_words, n_removed, kept, kept_sha256 of every row.

    ``kept`` is the text itself where nothing is removed, else the kept words joined
    by one space.
    """
    factors = stage(listed_factors(docs, window, gram), "factors")

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            counts, removed, kept, digests = [], [], [], []
            for text, *found in zip(*(column.to_pylist() for column in batch.columns[1:])):
                words = text.split() if text else []
                own = text
                joined = b" ".join(words)
                gone = 0
                if found[0]:
                    mask = factor_mask(len(words), greedy_parse(list(zip(*found)), window))
                    gone = int(mask.sum())
                    joined = own = b" ".join([words[k] for k in np.flatnonzero(~mask)])
                counts.append(len(words))
                removed.append(gone)
                kept.append(own)
                digests.append(sha256(joined).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(kept, pa.binary()).cast(pa.string()),
                    pa.array(digests, pa.string()),
                ],
                names=["row", "n_words", "n_removed", "kept", "kept_sha256"],
            )

    rows = docs.select(
        F.struct(*carry).alias("row"),
        F.col("text").cast("binary").alias("text"),
        F.col("doc_id").cast("long").alias("id"),
        F.xxhash64("text").alias("sig"),
    )
    same = (F.col("d.id") == F.col("f.doc_id")) & (F.col("d.sig") == F.col("f.sig"))
    joined = rows.alias("d").join(factors.alias("f"), same, "left")
    schema = extended(
        rows.select("row"), "n_words long, n_removed long, kept string, kept_sha256 string"
    )
    return joined.select("row", "text", "start", "stop", "ref", "ref_start").mapInArrow(remove, schema)


def without_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """doc_id, n_words, n_removed, kept and kept_sha256 of every row."""
    rows = parsed_rows(docs, ["doc_id"], window, gram)
    return rows.select("row.doc_id", "n_words", "n_removed", "kept", "kept_sha256")


def drop_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """The rows of ``docs`` with the text that stays, and n_chars to match."""
    carry = [name for name in docs.columns if name != "text"]  # it is in ``kept``, and would be moved twice
    rows = parsed_rows(docs, carry, window, gram)
    changed = F.col("n_removed") > 0
    own = {name: F.col("kept") if name == "text" else F.col("row").getField(name) for name in docs.columns}
    if "n_chars" in own:
        kind = docs.schema["n_chars"].dataType
        own["n_chars"] = F.when(changed, F.length("kept").cast(kind)).otherwise(own["n_chars"])
    return rows.select(*(column.alias(name) for name, column in own.items()))
