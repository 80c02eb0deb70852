"""A prefix trie of conversations, from sorted matrices of turn ids.

A turn's id is the MD5 of its role and text, so texts stay where they are. Conversations
become rows of turn ids, are sorted by range over shards, and a shard numbers its ids
and pads its rows to a matrix. ``np.lexsort`` puts the rows in the order of their turns;
the change masks of the columns, accumulated by ``or`` from left to right, mark the rows
at which a node of each depth starts, and ``reduceat`` sums up the rows of every node of
a depth. Matrices are ``WIDTH`` turns wide: what is longer goes on in a matrix of the
longer rows only, so one long conversation doesn't widen the others.

Shards are cut by the first ``KEYED`` turns and the conversation's id, so that a third of
all conversations may be equal. The nodes at a shard's edges are open: other shards may
have rows of them. Open nodes carry a hash of their path; their parts are summed by it,
each new total is given to the first shard that has the node, shards sum these up along
their own paths, and the sums are added again. All other nodes are complete in their
shard.

Defined cases: a null role or text counts as empty; turns are in the order of their
number, null first, and equal numbers in the order of the MD5; repeated rows are turns
like others; rows without conv_id are left out; other columns are ignored; an empty table
returns no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stage

FAMILY = 5
HEADS = 9
WIDTH = 32
KEYED = 8
SHARD_TURNS = 1 << 20
ID_BYTES = 16
#: Conversation ids of one row of an open node's ends.
ENDS = 1 << 14
ROOT = bytes(ID_BYTES)
EMPTY = hashlib.sha256().hexdigest()
NODES = (
    "shard int, place long, parent_place long, depth long, node binary, parent_node binary, conv_id long, "
    "parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, size long, "
    "ends_sha256 string, ends binary"
)


def turn_rows(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, id, size): the MD5 of role and text, and the bytes of the text."""
    role, text = (F.coalesce(name, F.lit("")) for name in ("role", "text"))
    id_ = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", id_.alias("id"), F.octet_length(text).alias("size")
    )


def sequence_batch(rows: list[tuple[int, bytes, bytes]]) -> pa.RecordBatch:
    conv, ids, sizes = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [pa.array(conv, pa.int64()), pa.array(ids, pa.binary()), pa.array(sizes, pa.binary())],
        names=["conv_id", "ids", "sizes"],
    )


def rebuilt(conversations: DataFrame, family: int = FAMILY, heads: int = HEADS) -> DataFrame:
    """(conv_id, ids, sizes) of every conversation, begun like the first of its family.

    Conversation c has the first h turns of conversation c - c % ``family`` and then its
    own turns after the first h, where h is the CRC-32 of c in decimals modulo ``heads``.
    One shuffle brings a family together, its first conversation before the others; a
    task holds one conversation and the first turns of another.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: tuple = (None, b"", b"")
        conv = group = None
        ids, sizes = bytearray(), bytearray()
        done: list[tuple[int, bytes, bytes]] = []
        held = 0

        def finish() -> tuple[int, bytes, bytes]:
            nonlocal first
            if conv == group:
                first = (group, bytes(ids[: heads * ID_BYTES]), bytes(sizes[: heads * 4]))
            h = crc32(str(conv).encode()) % heads
            _, head, head_sizes = first if first[0] == group else (None, b"", b"")
            return (
                conv,
                head[: h * ID_BYTES] + bytes(ids[h * ID_BYTES :]),
                head_sizes[: h * 4] + bytes(sizes[h * 4 :]),
            )

        for batch in batches:
            groups, convs = (batch.column(k).to_numpy() for k in (0, 1))
            all_ids = b"".join(batch.column(2).to_pylist())
            all_sizes = batch.column(3).to_numpy().astype("<i4").tobytes()
            cuts = [0, *(np.flatnonzero(convs[1:] != convs[:-1]) + 1).tolist(), len(convs)]
            for start, end in zip(cuts, cuts[1:]):
                if start == end:
                    continue
                if conv is not None and conv != convs[start]:
                    done.append(finish())
                    held += len(done[-1][1])
                    ids.clear()
                    sizes.clear()
                conv, group = int(convs[start]), int(groups[start])
                ids += all_ids[start * ID_BYTES : end * ID_BYTES]
                sizes += all_sizes[start * 4 : end * 4]
                if held > 1 << 22 or len(done) >= 10_000:
                    yield sequence_batch(done)
                    done, held = [], 0
        if conv is not None:
            yield sequence_batch([*done, finish()])

    group = F.col("conv_id") - F.col("conv_id") % family
    rows = turn_rows(conversations).select(group.alias("group"), "conv_id", "id", "size", "turn")
    order = ["group", F.col("conv_id") != F.col("group"), "conv_id", F.asc_nulls_first("turn"), "id"]
    dealt = rows.repartition("group").sortWithinPartitions(*order).drop("turn")
    return dealt.mapInArrow(run, "conv_id long, ids binary, sizes binary")


def decimal_list(convs: np.ndarray) -> bytes:
    return ",".join(map(str, convs.tolist())).encode()


class Shard:
    """The nodes of a shard's conversations."""

    def __init__(self, conv: np.ndarray, ids: list[bytes], sizes: list[bytes], number: int, keyed: int, width: int):
        self.number, self.keyed, self.width = number, keyed, width
        self.conv = conv
        self.length = np.array([len(x) // ID_BYTES for x in ids], dtype=np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.raw = b"".join(ids)
        values = np.frombuffer(self.raw, dtype=f"S{ID_BYTES}")
        self.turn = np.append(np.unique(values, return_inverse=True)[1], -1).astype(np.int32)
        self.size = np.frombuffer(b"".join(sizes), dtype="<i4").astype(np.int64)
        self.levels: list[dict] = []
        self.count = 0

    def level(self, convs: np.ndarray, starts: np.ndarray, **columns: np.ndarray) -> np.ndarray:
        """Enter the nodes of a depth, whose rows begin at ``starts``; returns each row's node."""
        place = self.count + np.arange(len(starts))
        sizes = np.diff(np.append(starts, len(convs)))
        self.count += len(starts)
        self.levels.append(
            {"place": place, "n_convs": sizes, "conv_id": np.minimum.reduceat(convs, starts), **columns}
        )
        return np.repeat(place, sizes)

    def matrix(self, rows: np.ndarray, depth: int) -> np.ndarray:
        """Numbers of the turns after ``depth``, padded with -1."""
        column = depth + np.arange(self.width)
        there = column < self.length[rows, None]
        at = np.where(there, self.start[rows, None] + column, 0)
        return np.where(there, self.turn[at], np.int32(-1))

    def build(self) -> None:
        rows = np.arange(len(self.conv))
        group = np.zeros(len(rows), dtype=np.int64)
        node = None
        depth = 0
        while len(rows):
            turns = self.matrix(rows, depth)
            further = self.length[rows] > depth + self.width
            order = np.lexsort((self.conv[rows], further, *turns.T[::-1], group))
            rows, turns, group, further = rows[order], turns[order], group[order], further[order]
            changed = np.empty(turns.shape, dtype=bool)
            changed[0] = True
            changed[1:] = turns[1:] != turns[:-1]
            changed[1:, 0] |= group[1:] != group[:-1]
            changed = np.logical_or.accumulate(changed, axis=1)
            if node is None:
                node = self.root(rows)
            else:
                node = node[order]
            for column in range(self.width):
                node = self.descend(rows, node, changed[:, column], depth + column + 1)
            group = np.cumsum(changed[:, -1])[further]
            rows, node = rows[further], node[further]
            depth += self.width

    def root(self, rows: np.ndarray) -> np.ndarray:
        self.edges = rows[[0, -1]]
        return self.level(
            self.conv[rows],
            np.zeros(1, dtype=np.int64),
            parent=np.array([-1]),
            size=np.zeros(1, dtype=np.int64),
            open=np.array([True]),
            key=[ROOT],
            ends=[np.sort(self.conv[rows[self.length[rows] == 0]])],
        )

    def descend(self, rows: np.ndarray, node: np.ndarray, changed: np.ndarray, depth: int) -> np.ndarray:
        """Enter the nodes of ``depth``; returns each row's node, that of the row's end where it is shorter."""
        alive = self.length[rows] >= depth
        if not alive.any():
            return node
        above = self.levels[-1]
        own, begins = rows[alive], changed[alive]
        starts = np.flatnonzero(begins)
        head = own[starts]
        parent = node[alive][starts]
        at = self.start[head] + depth - 1
        if depth <= self.keyed:
            opened = np.zeros(len(starts), dtype=bool)
            opened[np.searchsorted(starts, np.flatnonzero(np.isin(own, self.edges)), side="right") - 1] = True
        else:
            opened = above["open"][parent - above["place"][0]]
        keys: list = [None] * len(starts)
        for k in np.flatnonzero(opened).tolist():
            path = above["key"][parent[k] - above["place"][0]] + self.raw[at[k] * ID_BYTES : (at[k] + 1) * ID_BYTES]
            keys[k] = hashlib.blake2b(path, digest_size=ID_BYTES).digest()
        ended = self.length[own] == depth
        cuts = np.cumsum(np.add.reduceat(ended.astype(np.int64), starts))[:-1]
        found = self.level(
            self.conv[own],
            starts,
            parent=parent,
            size=self.size[at],
            open=opened,
            key=keys,
            ends=np.split(self.conv[own[ended]], cuts),
        )
        node = node.copy()
        node[alive] = found
        return node

    def sums(self) -> None:
        """Children of each node, and leaves and savings at or below it, as far as the nodes are closed."""
        for level in self.levels:
            level |= {name: np.zeros(len(level["place"]), dtype=np.int64) for name in ("children", "leaves", "saved")}
        for above, level in reversed(list(zip([None, *self.levels], self.levels))):
            closed = ~level["open"]
            level["leaves"] += closed & (level["children"] == 0)
            level["saved"] += np.where(closed, (level["n_convs"] - 1) * level["size"], 0)
            if above is None:
                continue
            to = level["parent"] - above["place"][0]
            starts = np.flatnonzero(np.append(True, to[1:] != to[:-1]))
            for name, value in (("children", closed), ("leaves", level["leaves"]), ("saved", level["saved"])):
                above[name][to[starts]] += np.add.reduceat(value.astype(np.int64), starts)

    def batches(self) -> Iterator[pa.RecordBatch]:
        above = None
        for depth, level in enumerate(self.levels):
            opened = level["open"]
            own = level["parent"] - (above["place"][0] if above else 0)
            known = ~above["open"][own] if above else np.zeros(1, dtype=bool)
            parents = above["conv_id"][own] if above else level["conv_id"]
            digest = [
                None if o else hashlib.sha256(decimal_list(x)).hexdigest() if len(x) else EMPTY
                for o, x in zip(opened, level["ends"])
            ]
            count = len(opened)
            yield self.batch(
                place=level["place"],
                parent_place=level["parent"],
                depth=np.full(count, depth),
                node=level["key"],
                parent_node=[above["key"][k] if o and above else None for o, k in zip(opened, own.tolist())],
                conv_id=level["conv_id"],
                parent_conv_id=pa.array(parents, pa.int64(), mask=~known),
                n_convs=level["n_convs"],
                n_children=level["children"],
                n_leaves=level["leaves"],
                saved_tokens=level["saved"],
                size=level["size"],
                ends_sha256=digest,
            )
            for k in np.flatnonzero(opened).tolist():
                ends = level["ends"][k]
                for start in range(0, len(ends), ENDS):
                    some = ends[start : start + ENDS]
                    yield self.batch(node=[level["key"][k]], conv_id=some[:1], ends=[decimal_list(some)])
            above = level

    def batch(self, **columns) -> pa.RecordBatch:
        count = len(columns["node"])
        kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string()}
        fields = [field.split() for field in NODES.split(", ")]
        columns["shard"] = np.full(count, self.number)
        arrays = [pa.array(columns.get(name, [None] * count), kinds[kind]) for name, kind in fields]
        return pa.RecordBatch.from_arrays(arrays, names=[name for name, _ in fields])


def shard_nodes(
    sequences: DataFrame, keyed: int = KEYED, width: int = WIDTH, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """The nodes of each shard: complete ones, parts of open ones, and the ends of these."""
    if keyed > width:
        raise ValueError("a matrix is at least as wide as the turns that cut shards")
    total = sequences.agg(F.sum(F.octet_length("ids") / ID_BYTES + 1)).first()[0] or 0
    tasks = int(sequences.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(tasks, -(-int(total) // shard_turns))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = pa.Table.from_batches(batches) if (batches := [b for b in batches if b.num_rows]) else None
        if held is not None:
            conv = held.column("conv_id").to_numpy()
            ids, sizes = held.column("ids").to_pylist(), held.column("sizes").to_pylist()
            shard = Shard(conv, ids, sizes, TaskContext.get().partitionId(), keyed, width)
            shard.build()
            shard.sums()
            yield from shard.batches()

    key = F.substring("ids", 1, keyed * ID_BYTES)
    return sequences.repartitionByRange(tasks, key, "conv_id").mapInArrow(run, NODES)


def along_paths(rows: pd.DataFrame) -> pd.DataFrame:
    """Each open node of a shard with the sums of what the shard holds of it and below it."""
    rows = rows.sort_values("place", ignore_index=True)
    place = rows["place"].to_numpy()
    parent = np.searchsorted(place, rows["parent_place"].to_numpy())
    depth = rows["depth"].to_numpy()
    sums = {name: rows[name].to_numpy(dtype=np.int64, copy=True) for name in ("leaves", "saved")}
    cuts = np.flatnonzero(np.append(True, depth[1:] != depth[:-1])).tolist()  # places go by depth
    for start, end in reversed(list(zip(cuts, [*cuts[1:], len(depth)]))):
        if depth[start]:
            for value in sums.values():
                np.add.at(value, parent[start:end], value[start:end])
    return pd.DataFrame({"node": rows["node"], **sums})


def end_digests(ends: DataFrame) -> DataFrame:
    """(node, ends_sha256): lists are hashed as they stream by, in order."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, digest = None, hashlib.sha256()
        done: list[tuple[bytes, str]] = []

        def rows() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in done], pa.binary()), pa.array([x[1] for x in done])],
                names=["node", "ends_sha256"],
            )

        for batch in batches:
            for key, text in zip(batch.column(0), batch.column(1)):
                if key.as_py() == node:
                    digest.update(b",")
                else:
                    if node is not None:
                        done.append((node, digest.hexdigest()))
                    node, digest = key.as_py(), hashlib.sha256()
                digest.update(text.as_py())
            if len(done) >= 10_000:
                yield rows()
                done.clear()
        if node is not None:
            done.append((node, digest.hexdigest()))
            yield rows()

    dealt = ends.repartition("node").sortWithinPartitions("node", "conv_id")
    return dealt.select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def trie(
    sequences: DataFrame, keyed: int = KEYED, width: int = WIDTH, shard_turns: int = SHARD_TURNS
) -> DataFrame:
    """One row per distinct prefix of the sequences (conv_id, ids, sizes), the empty one included.

    conv_id and parent_conv_id name a node and its parent by their smallest members;
    n_convs counts members, n_children children, n_leaves childless nodes at or below the
    node; saved_tokens sums (n_convs - 1) times the bytes of the last text at or below it;
    ends_sha256 is of the ids of the members that end at the node.
    """
    found = stage(shard_nodes(sequences, keyed, width, shard_turns), "shard-nodes")
    nodes, ends = found.where("ends is null"), found.where("ends is not null")
    parts = nodes.where("node is not null")
    merged = parts.groupBy("node").agg(
        F.min("shard").alias("owner"),
        F.first("depth").alias("depth"),
        F.first("parent_node").alias("parent_node"),
        F.min("conv_id").alias("conv_id"),
        F.first("size").alias("size"),
        *[F.sum(name).alias(name) for name in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )
    merged = stage(merged, "open-nodes")
    below = merged.where("depth > 0").groupBy(F.col("parent_node").alias("node")).agg(F.count("*").alias("below"))
    children = F.col("n_children") + F.coalesce("below", F.lit(0))
    total = stage(merged.join(below, "node", "left").withColumn("n_children", children).drop("below"), "open-totals")

    mine = F.col("owner") == F.col("shard")
    dealt = parts.select("shard", "place", "parent_place", "depth", "node").join(
        total.select("node", "owner", "n_children", "n_convs", "size"), "node"
    )
    own = dealt.select(
        "shard",
        "place",
        "parent_place",
        "depth",
        "node",
        F.when(mine & (F.col("n_children") == 0), 1).otherwise(0).cast("long").alias("leaves"),
        F.when(mine, (F.col("n_convs") - 1) * F.col("size")).otherwise(0).alias("saved"),
    )
    summed = own.groupBy("shard").applyInPandas(along_paths, "node binary, leaves long, saved long")
    summed = summed.groupBy("node").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))
    parents = total.select(F.col("node").alias("parent_node"), F.col("conv_id").alias("parent_conv_id"))
    opened = (
        total.join(summed, "node")
        .join(end_digests(ends), "node", "left")
        .join(parents, "parent_node", "left")
        .withColumns(
            {
                "n_leaves": F.col("n_leaves") + F.col("leaves"),
                "saved_tokens": F.col("saved_tokens") + F.col("saved"),
                "ends_sha256": F.coalesce("ends_sha256", F.lit(EMPTY)),
            }
        )
    )
    named = parts.select("shard", F.col("place").alias("parent_place"), "node").join(
        total.select("node", F.col("conv_id").alias("_parent")), "node"
    )
    closed = (
        nodes.where("node is null")
        .join(named.drop("node"), ["shard", "parent_place"], "left")
        .withColumn("parent_conv_id", F.coalesce("parent_conv_id", "_parent"))
    )
    columns = [
        "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256",
    ]
    return closed.select(*columns).unionByName(opened.select(*columns))


def conversation_trie(conversations: DataFrame) -> DataFrame:
    """The trie of the rebuilt conversations."""
    return trie(stage(rebuilt(conversations), "sequences"))
