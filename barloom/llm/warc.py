"""WARC archives of pages, and their captures in global order.

``write_archives`` stores each page as a record of its own gzip member. Of records
with equal payloads the one with the largest page_id is the response, the others
revisit it. Tasks write to the shared folder under names of their own and return
them; only names that a finished stage returned are ever read, so a task that is
run again leaves at most a file that nobody reads.

``read_archives`` streams the files, checks every payload against its digest, and
returns capture runs of bounded size, each sorted by URL key, time and page.

``merge_runs`` is an external merge: Spark deals the runs' pieces to ranges of
(URL key, time, page), and each range merges its pieces with a loser tree. Ranges
follow each other, so (range, place) is the global order of the captures. The page
is part of the sort key, so captures of a single URL may lie in many ranges.

Paths are opened with pyarrow's file systems, chosen by the folder's URI.

Defined cases: a null html is an empty payload; equal rows of a page (page_id and
payload) are all responses; a null page_id counts as smaller than any other; a null
url is written as an empty target; a page without ``captured`` time gets page_id
seconds after 2000-01-01; other columns are ignored; an empty table gives no
archive and no rows.
"""

from __future__ import annotations

import base64
import uuid
from collections.abc import Iterator
from datetime import UTC
from hashlib import sha1
from itertools import count
from urllib.parse import quote, urlsplit
from zlib import compressobj, decompressobj

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import new_path, stage

RUN = 50_000
RANGE = 100_000
FILE_BYTES = 64 << 20
GZIP = 31  # zlib's window size for gzip members
EPOCH = 946_684_800
CAPTURES = (
    "url_key string, captured string, page_id long, target string, payload_bytes long, "
    "payload_digest string, record_type string, refers_to long, archive string, "
    "record_offset long, record_length long, run_id string, place long"
)


def base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def url_key(url: str | None) -> str:
    """Host labels reversed, then path and query, in lower case."""
    try:
        parts = urlsplit(url or "")
        host = ",".join(reversed((parts.hostname or "").split(".")))
    except ValueError:
        return (url or "").lower()
    return f"{host}){parts.path or '/'}{'?' + parts.query if parts.query else ''}".lower()


def record(row: dict) -> bytes:
    """A response with its payload, or a revisit without."""
    headers = {
        "WARC-Type": row["record_type"],
        "WARC-Record-ID": f"<urn:page:{'' if row['page_id'] is None else row['page_id']}>",
        "WARC-Date": row["captured"].astimezone(UTC).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "WARC-Target-URI": quote(row["url"] or "", safe="".join(map(chr, range(33, 127)))),
        "WARC-Payload-Digest": "sha1:" + base32(bytes.fromhex(row["digest"])),
        "Content-Type": "application/http; msgtype=response",
    }
    payload = (row["html"] or "").encode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + payload
    if row["record_type"] == "revisit":
        headers["WARC-Profile"] = (
            "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
        )
        headers["WARC-Refers-To"] = f"<urn:page:{row['refers_to']}>"
        block = http.encode()
    headers["Content-Length"] = str(len(block))
    lines = "".join(f"{name}: {value}\r\n" for name, value in headers.items())
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def header_fields(head: bytes) -> dict[str, str]:
    lines = head.decode().split("\r\n")[1:]
    return {name: value.strip() for name, _, value in (line.partition(":") for line in lines)}


def page_number(urn: str | None) -> int | None:
    digits = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def capture(data: bytes) -> dict:
    """The capture that a record holds; a payload unlike its digest is an error."""
    head, _, rest = data.partition(b"\r\n\r\n")
    fields = header_fields(head)
    block = rest[: int(fields["Content-Length"])]
    if not head.startswith(b"WARC/1.1") or rest[len(block) :] != b"\r\n\r\n":
        raise ValueError("damaged WARC record")
    http, _, payload = block.partition(b"\r\n\r\n")
    digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    size = int(header_fields(http)["Content-Length"])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or base32(sha1(payload).digest()) != digest):
        raise ValueError(f"payload of {fields['WARC-Record-ID']} doesn't match its digest")
    target = fields["WARC-Target-URI"]
    return {
        "url_key": url_key(target),
        "captured": fields["WARC-Date"],
        "page_id": page_number(fields["WARC-Record-ID"]),
        "target": target,
        "payload_bytes": size,
        "payload_digest": digest,
        "record_type": kind,
        "refers_to": page_number(fields.get("WARC-Refers-To")),
    }


def members(source: Iterator[bytes]) -> Iterator[tuple[int, int, bytes]]:
    """(offset, length, content) of each gzip member of a stream of chunks."""
    offset, length, parts, inflate = 0, 0, [], None
    for chunk in source:
        while chunk:
            inflate = inflate or decompressobj(GZIP)
            parts.append(inflate.decompress(chunk))
            length += len(chunk) - len(inflate.unused_data)
            chunk = inflate.unused_data
            if inflate.eof:
                yield offset, length, b"".join(parts)
                offset, length, parts, inflate = offset + length, 0, [], None
    if inflate is not None:
        raise ValueError("archive ends within a record")


def with_roles(pages: DataFrame, least: int = 0) -> DataFrame:
    """page_id, url, html, captured, digest, record_type, refers_to."""
    captured = F.timestamp_seconds(
        F.coalesce(F.pmod(F.col("page_id").cast("long"), F.lit(10**9)), F.lit(0)) + EPOCH
    )
    if "captured" in pages.columns:
        captured = F.coalesce(F.col("captured").cast("timestamp"), captured)
    body = F.coalesce(F.col("html"), F.lit("")).cast("binary")
    large = F.octet_length(body) >= least
    digests = pages.select(
        F.col("page_id").cast("long"), "url", "html", captured.alias("captured"),
        F.sha1(body).alias("digest"), large.alias("_large"),
    )
    heads = stage(
        digests.where("_large")
        .groupBy("digest")
        .agg(F.max("page_id").alias("_head"), F.count("*").alias("_n"))
        .where("_n > 1 and _head is not null")
        .drop("_n"),
        "heads",
    )
    revisit = F.col("_large") & F.col("_head").isNotNull() & ~F.col("_head").eqNullSafe(F.col("page_id"))
    return digests.join(heads, "digest", "left").select(
        "page_id", "url", "html", "captured", "digest",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("_head")).alias("refers_to"),
    )


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> DataFrame:
    """Write all pages; the paths of the finished archives."""

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = fs.FileSystem.from_uri(folder)
        system.create_dir(root, recursive=True)
        stream, size, paths = None, 0, []
        for batch in batches:
            for row in batch.to_pylist():
                if stream is None:
                    name = f"{uuid.uuid4().hex}.warc.gz"
                    stream = system.open_output_stream(f"{root}/{name}", compression=None)
                    paths.append(f"{folder}/{name}")
                deflate = compressobj(6, wbits=GZIP)
                data = deflate.compress(record(row)) + deflate.flush()
                stream.write(data)
                size += len(data)
                if size > FILE_BYTES:
                    stream.close()
                    stream, size = None, 0
        if stream is not None:
            stream.close()
        if paths:
            yield pa.RecordBatch.from_arrays([pa.array(paths, pa.string())], names=["archive"])

    return stage(with_roles(pages, least).mapInArrow(write, "archive string"), "archives")


def sort_key(row: dict) -> tuple:
    return row["url_key"], row["captured"], -1 if row["page_id"] is None else row["page_id"]


def read_archives(archives: DataFrame, run: int = RUN) -> DataFrame:
    """Captures as runs (run_id, place) sorted by URL key, time and page."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def flush() -> pa.RecordBatch:
            run_id = uuid.uuid4().hex
            held.sort(key=sort_key)
            rows = [row | {"run_id": run_id, "place": k} for k, row in enumerate(held)]
            held.clear()
            return pa.RecordBatch.from_pylist(rows, schema=RUN_SCHEMA)

        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, place = fs.FileSystem.from_uri(path)
                with system.open_input_stream(place, compression=None) as stream:
                    chunks = iter(lambda: stream.read(1 << 20), b"")
                    for offset, length, data in members(chunks):
                        own = {"archive": path, "record_offset": offset, "record_length": length}
                        held.append(capture(data) | own)
                        if len(held) == run:
                            yield flush()
        if held:
            yield flush()

    # an archive is large for the one short row that names it: a stated number isn't merged
    least = int(archives.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = archives.repartition(max(least, archives.count()), "archive")
    return dealt.mapInArrow(read, CAPTURES)


RUN_SCHEMA = pa.schema(
    [(x, pa.string()) for x in ("url_key", "captured")]
    + [("page_id", pa.int64()), ("target", pa.string()), ("payload_bytes", pa.int64())]
    + [(x, pa.string()) for x in ("payload_digest", "record_type")]
    + [("refers_to", pa.int64()), ("archive", pa.string())]
    + [(x, pa.int64()) for x in ("record_offset", "record_length")]
    + [("run_id", pa.string()), ("place", pa.int64())]
)


def loser_tree(runs: list[list[dict]]) -> Iterator[dict]:
    """Merge sorted runs; each inner node keeps the run that lost there."""
    many = len(runs)
    if not many:
        return
    streams = [iter(run) for run in runs]
    heads = [next(stream, None) for stream in streams]
    keys = [None if head is None else sort_key(head) for head in heads]

    def loses(one: int, other: int) -> bool:
        """Whether ``one`` comes after ``other``; run -1 comes before all, ended runs last."""
        if one < 0 or other < 0:
            return other < 0 <= one
        if keys[one] is None or keys[other] is None:
            return keys[one] is None and keys[other] is not None
        return (keys[one], one) > (keys[other], other)

    tree = [-1] * many  # tree[0] is the winner

    def replay(run: int) -> None:
        winner, node = run, (run + many) // 2
        while node:
            if loses(winner, tree[node]):
                winner, tree[node] = tree[node], winner
            node //= 2
        tree[0] = winner

    for run in reversed(range(many)):
        replay(run)
    while keys[tree[0]] is not None:
        run = tree[0]
        yield heads[run]
        heads[run] = next(streams[run], None)
        keys[run] = None if heads[run] is None else sort_key(heads[run])
        replay(run)


def merge_runs(runs: DataFrame, ranges: int | None = None) -> DataFrame:
    """All captures in global order by (merge_range, merge_place)."""
    spark = runs.sparkSession
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = ranges or max(least, -(-runs.count() // RANGE))
    names = RUN_SCHEMA.names

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces: dict[str, list[dict]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                pieces.setdefault(row["run_id"], []).append(row)
        for piece in pieces.values():
            piece.sort(key=lambda row: row["place"])  # pieces may arrive in parts
        number, order = TaskContext.get().partitionId(), count()
        held: list[dict] = []
        schema = RUN_SCHEMA.append(pa.field("merge_range", pa.int64())).append(
            pa.field("merge_place", pa.int64())
        )
        for row in loser_tree([pieces[run] for run in sorted(pieces)]):
            held.append(row | {"merge_range": number, "merge_place": next(order)})
            if len(held) == 10_000:
                yield pa.RecordBatch.from_pylist(held, schema=schema)
                held = []
        if held:
            yield pa.RecordBatch.from_pylist(held, schema=schema)

    bounds = [F.col("url_key"), F.col("captured"), F.coalesce("page_id", F.lit(-1))]
    dealt = runs.select(*names).repartitionByRange(ranges, *bounds)
    merged = dealt.mapInArrow(merge, CAPTURES + ", merge_range long, merge_place long")
    captured = F.to_timestamp("captured", "yyyy-MM-dd'T'HH:mm:ss'Z'")
    return merged.withColumn("captured", captured).drop("run_id", "place")


def archive_pages(spark: SparkSession, pages: DataFrame, least: int = 0) -> DataFrame:
    """Write the pages, read the archives back, and merge their captures."""
    folder = new_path(spark, "warc")
    runs = stage(read_archives(write_archives(pages, folder, least)), "runs")
    return merge_runs(runs)
