"""SimHash near-duplicates through Golay-code fuzzy keys.

A 64-bit fingerprint is cut into segments of 23, 23 and 18 bits. The perfect
binary Golay code of 23 bits gives each segment value its nearest codeword and,
where that lies three bits away, the five codewords four bits away: at most six
indices of 12 bits. Two values that differ in one bit share an index.

Three differing bits fall on the three segments so that either

* one segment is equal and another differs in one bit at most: a key is the equal
  segment's bits with a fuzzy index of the other (six ordered pairs), or
* each segment differs in exactly one bit: a key is a pair of indices of the first
  two segments with one half of the third, of which one half is equal. Each value
  gives (nearest, any) and (any, nearest), at most eleven pairs, which is enough.

Every key has 30 bits or more. Keys are made for distinct fingerprints only, so a
group of exact copies is one row whatever its size. A key that two fingerprints
share is settled by the counts alone; larger buckets are cut into blocks, and a
task compares two blocks and returns a spanning forest, never all pairs. Links are
joined to components by alternating star steps, each written to the shared folder.

Keys are made a second time for the larger buckets. A bit set of fixed size, in which
each such bucket sets one bit, keeps nearly all other keys from that second shuffle;
the join after it is exact, so a fuller bit set costs time and no links.

Defined cases: a null or wordless text has fingerprint zero and links like any
other; a null doc_id keeps its row and never names a component unless all ids of
the component are null; repeated rows return as often as they come; other columns
are ignored; an empty table returns no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from xxhash import xxh64_intdigest

from .common import discard, stage

GENERATOR = 0xC75  # x^11 + x^10 + x^6 + x^5 + x^4 + x^2 + 1
SHINGLE = 3
SEED = 42
DISTANCE = 3
BLOCK = 512
SEGMENTS = ((0, 23), (23, 23), (46, 18))
CHUNK = 1 << 16
EXPANDED = 100_000
PLACES = (1 << 24) - 3  # a prime
BITMAP_BYTES = 4096  # of Spark's bitmap functions


def fingerprint(text: bytes | None, shingle: int = SHINGLE) -> int:
    """Majority of the bits of all shingles' XXH64, as an unsigned integer."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    if len(words) < shingle:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[k:] for k in range(shingle))))
    hashes = np.fromiter(map(xxh64_intdigest, shingles, repeat(SEED)), dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for start in range(0, len(hashes), CHUNK):
        part = hashes[start : start + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


@cache
def golay_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Remainders of the upper 12 bits; per syndrome the error patterns and their number."""

    def remainder(value: int) -> int:
        for bit in range(22, 10, -1):
            if value >> bit & 1:
                value ^= GENERATOR << (bit - 11)
        return value

    upper = np.array([remainder(value << 11) for value in range(1 << 12)], dtype=np.int64)
    patterns = np.zeros((1 << 11, 6), dtype=np.int64)
    counts = np.zeros(1 << 11, dtype=np.int64)
    weight = np.zeros(1 << 11, dtype=np.int64)
    for size in range(5):
        for bits in combinations(range(23), size):
            value = sum(1 << bit for bit in bits)
            syndrome = int(upper[value >> 11]) ^ (value & 0x7FF)
            if size < 4:
                weight[syndrome] = size
            if size < 4 or weight[syndrome] == 3:
                patterns[syndrome, counts[syndrome]] = value
                counts[syndrome] += 1
    return upper, patterns, counts


def nearby(segment: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the near codewords, nearest first, and how many count for each value."""
    upper, patterns, counts = golay_tables()
    syndrome = upper[segment >> 11] ^ (segment & 0x7FF)
    return (segment[:, None] ^ patterns[syndrome]) >> 11, counts[syndrome]


def fuzzy_keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of the fingerprints, without repeats within a row."""
    raw = [
        ((prints >> np.uint64(at)) & np.uint64((1 << width) - 1)).astype(np.int64)
        for at, width in SEGMENTS
    ]
    near = [nearby(value) for value in raw]
    rows, keys = [], []
    slots = np.arange(6)

    def add(family: int, values: np.ndarray, use: np.ndarray) -> None:
        row, slot = np.nonzero(use)
        rows.append(row)
        keys.append(values[row, slot] | (family << 40))

    family = 0
    for equal in range(3):
        for other in range(3):
            if equal != other:
                index, count = near[other]
                add(family, (raw[equal][:, None] << 12) | index, slots < count[:, None])
                family += 1
    (first, n_first), (second, n_second) = near[0], near[1]
    for half in (raw[2] & 0x1FF, raw[2] >> 9):
        high = half[:, None] << 24
        add(family, high | first[:, :1] << 12 | second, slots < n_second[:, None])
        add(
            family,
            high | first << 12 | second[:, :1],
            (slots < n_first[:, None]) & (slots > 0),
        )
        family += 1
    return np.concatenate(rows), np.concatenate(keys)


def spanning_links(left: np.ndarray, right: np.ndarray, distance: int) -> list[tuple[int, int]]:
    """A forest that joins what links between, or in, two blocks of fingerprints."""
    nodes = np.unique(np.concatenate([left, right]))
    inner = len(left) == len(right) and np.array_equal(left, right)
    near = np.bitwise_count(nodes[:, None] ^ nodes[None, :]) <= distance
    if not inner:
        side = np.isin(nodes, left), np.isin(nodes, right)
        across = side[0][:, None] & side[1][None, :]
        near &= across | across.T
    unseen = np.ones(len(nodes), dtype=bool)
    links = []
    for root in range(len(nodes)):
        if not unseen[root]:
            continue
        unseen[root] = False
        queue = [root]
        while queue:
            node = queue.pop()
            found = np.flatnonzero(near[node] & unseen)
            unseen[found] = False
            links += [(int(nodes[node]), int(nodes[other])) for other in found]
            queue += found.tolist()
    return links


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, print, sign): the fingerprint as a signed long, and the XXH64 of the text."""
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def convert(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = np.fromiter(
                (fingerprint(text, shingle) for text in batch.column(1).to_pylist()),
                dtype=np.uint64,
                count=batch.num_rows,
            )
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints.view(np.int64)), batch.column(2)],
                names=["doc_id", "print", "sign"],
            )

    source = docs.select("doc_id", F.col("text").cast("binary").alias("text"), F.xxhash64("text").alias("sign"))
    return source.mapInArrow(convert, f"doc_id {id_type}, print long, sign long")


def bits_of(keys: DataFrame) -> np.ndarray:
    """One bit for the place of each key: 2 MB, however many keys there are."""
    place = F.col("key") % PLACES + 1  # bitmaps count from one
    rows = (
        keys.groupBy(F.bitmap_bucket_number(place).alias("part"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
        .collect()
    )
    found = np.zeros((PLACES // 8 // BITMAP_BYTES + 1, BITMAP_BYTES), dtype=np.uint8)
    for row in rows:
        found[row.part - 1] = np.frombuffer(row.bits, dtype=np.uint8)
    return found.reshape(-1)


def in_bits(keys: np.ndarray, bits: np.ndarray) -> np.ndarray:
    place = keys % PLACES
    return (bits[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)


def expanded(dealt: DataFrame, wanted: np.ndarray | None = None) -> DataFrame:
    """(key, print) of every fingerprint, or those keys whose bit is set in ``wanted``."""
    shared = None if wanted is None else dealt.sparkSession.sparkContext.broadcast(wanted)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, CHUNK):
                values = batch.column(0).slice(at, CHUNK).to_numpy(zero_copy_only=False)
                row, key = fuzzy_keys(values.view(np.uint64))
                if shared is not None:
                    use = in_bits(key, shared.value)
                    row, key = row[use], key[use]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(key), pa.array(values[row])], names=["key", "print"]
                )

    return dealt.mapInArrow(expand, "key long, print long")


def links(prints: DataFrame, distance: int = DISTANCE) -> DataFrame:
    """(a, b): links that join all distinct fingerprints within the distance."""

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for left, right in zip(batch.column(0), batch.column(1)):
                own = [
                    np.array(side.as_py(), dtype=np.int64).view(np.uint64) for side in (left, right)
                ]
                if not len(own[1]):
                    own[1] = own[0]
                found = spanning_links(*own, distance)
                ends = np.array(found, dtype=np.uint64).reshape(-1, 2).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ends[:, 0]), pa.array(ends[:, 1])], names=["a", "b"]
                )

    # fifty keys a row: enough partitions for the keys, which adaptive execution doesn't know
    least = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    parts = max(least, -(-prints.count() // EXPANDED))
    # by another expression than the distinct above it: else Spark joins both exchanges and merges tasks
    dealt = prints.select("print").distinct().repartition(parts, F.xxhash64("print"))
    buckets = expanded(dealt).groupBy("key").agg(
        F.count("*").alias("n"), F.min("print").alias("a"), F.max("print").alias("b")
    )
    shared = stage(buckets.where("n > 1"), "buckets")
    pairs = (
        shared.where("n = 2")
        .select("a", "b")
        .where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= distance)
    )
    large = shared.where("n > 2").select("key", F.ceil(F.col("n") / BLOCK).alias("blocks"))
    keys = expanded(dealt, bits_of(large))
    own = F.pmod(F.xxhash64("print"), F.col("blocks"))
    compared = (
        keys.join(large, "key")
        .withColumn("own", own)
        .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
        .withColumns({"i": F.least("own", "other"), "j": F.greatest("own", "other")})
        .groupBy("key", "i", "j")
        .agg(
            F.collect_list(F.when(F.col("own") == F.col("i"), F.col("print"))).alias("left"),
            F.collect_list(
                F.when((F.col("own") == F.col("j")) & (F.col("i") != F.col("j")), F.col("print"))
            ).alias("right"),
        )
        .select("left", "right")
    )
    return pairs.unionByName(compared.mapInArrow(compare, "a long, b long")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root): the smallest node reachable, for every node with a link.

    Large-star and small-star steps alternate until nothing changes; the number of
    rounds grows with the logarithm of the longest chain.
    """

    def state(frame: DataFrame) -> tuple:
        return tuple(
            frame.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        )

    current = stage(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a <> b")
        .distinct(),
        "links",
    )
    seen = state(current)
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("m"))
        large = (
            both.join(least, "a")
            .where("b > a")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .distinct()
        )
        smallest = large.groupBy("a").agg(F.min("b").alias("m"))
        small = (
            large.join(smallest, "a")
            .where("b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b"))
            .unionByName(smallest.select("a", F.col("m").alias("b")))
            .distinct()
        )
        following = stage(small, "links")
        now = state(following)
        discard(current)
        current = following
        if now == seen:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = now


def grouped(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, sign, print, component_id and leads of every row.

    A text leads its component if its doc_id is the smallest and, of several texts with
    that id, its sign. Id and sign together tell rows apart where one id has many texts.
    """
    if not 0 <= distance <= 3:
        raise ValueError("the keys find distances up to 3")
    prints = stage(fingerprints(docs, shingle), "prints")
    roots = components(links(prints, distance))
    first = F.struct(F.col("doc_id").isNull().alias("nameless"), "doc_id", "sign")
    own = prints.groupBy("print").agg(F.min(first).alias("least"))
    rooted = own.join(roots, F.col("print") == F.col("node"), "left").select(
        "print", "least", F.coalesce("root", "print").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("least").alias("first"))
    named = stage(
        rooted.join(smallest, "root").select(
            "print", F.col("first.doc_id").alias("component_id"), F.col("first.sign").alias("first_sign")
        ),
        "named",
    )
    leads = F.col("doc_id").eqNullSafe(F.col("component_id")) & (F.col("sign") == F.col("first_sign"))
    return prints.join(named, "print").select("doc_id", "sign", "print", "component_id", leads.alias("leads"))


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE, distance: int = DISTANCE) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row."""
    hexed = F.lower(F.lpad(F.hex("print"), 16, "0")).alias("fingerprint")
    return grouped(docs, shingle, distance).select("doc_id", hexed, "component_id")
