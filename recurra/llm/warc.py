"""A deterministic sharded WARC writer, and a reader.

Which archive a record goes to, where files end, and every byte in them depend on the records and the parameters alone, so a
repeated run writes the same archives:

* Records are dealt to shards by ranges of the page id. The ranges are cut from a histogram of payload bytes over ids, never from a
  sample. Inside a shard records are in order of the id.
* A shard is written by one task as a series of files, a new one when the compressed size reaches a limit. Every record is a gzip
  member of its own, with headers made from the page: record ids are name-based, the date is a parameter, digests are computed.
* A task writes under a name of its own attempt. Its results are rows of a manifest; only what the manifest names is renamed to
  its final name, in a second job that may be repeated. What lost or repeated attempts left is removed with the temporary folder.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recurra.session import cut_lineage

MIN_REVISIT_BYTES = 0
SHARD_BYTES = 64 << 20
FILE_BYTES = 16 << 20
# Steps of the histogram by which shards are cut; as many rows reach the driver.
STEPS = 1 << 16
DATE = "2020-01-01T00:00:00Z"
NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # fixed value: the namespace of URLs
PIECE = 1 << 20


@dataclass(frozen=True)
class Record:
    page_id: int | None
    url: str | None
    payload: bytes
    refers_to: int | None
    is_revisit: bool


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def _uri(url: str | None, page_id: int | None) -> str:
    """The url without anything that could end a header line; pages without one get a name of their own."""
    return quote(url, safe="!#$%&'()*+,/:;=?@[]~-._") if url else f"urn:page:{'' if page_id is None else page_id}"


def _record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(NAMESPACE, f'page {page_id} {digest}')}>"


def encode(record: Record, date: str = DATE) -> bytes:
    """The record as WARC: a response with the payload as an HTTP body, or a revisit with the HTTP headers only."""
    digest = payload_digest(record.payload)
    head = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(record.payload)}\r\n\r\n".encode()
    block = head if record.is_revisit else head + record.payload
    headers = [
        ("WARC-Type", "revisit" if record.is_revisit else "response"), ("WARC-Record-ID", _record_id(record.page_id, digest)),
        ("WARC-Date", date), ("WARC-Target-URI", _uri(record.url, record.page_id)),
        ("WARC-Block-Digest", f"sha1:{payload_digest(block)}"), ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("X-Payload-Length", str(len(record.payload))),
    ]
    if record.page_id is not None:
        headers.append(("X-Page-ID", str(record.page_id)))
    if record.is_revisit:
        headers.append(("WARC-Profile", "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"))
        headers.append(("WARC-Refers-To", _record_id(record.refers_to, digest)))
        if record.refers_to is not None:
            headers.append(("X-Refers-To-Page", str(record.refers_to)))
    headers += [("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    return b"WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in headers).encode() + b"\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """A gzip member without name or time."""
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _store(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder if "://" in folder or folder.startswith("file:") else f"file://{folder}")


class RollingFiles:
    """Writes members one after the other; begins a new file when one has reached its size."""

    def __init__(self, folder: str, shard: int, file_bytes: int) -> None:
        self.store, self.path = _store(folder)
        self.attempt = uuid.uuid4().hex
        self.shard, self.file_bytes = shard, file_bytes
        self.number, self.stream = -1, None
        self.rows: list[tuple] = []
        self.store.create_dir(f"{self.path}/_temporary", recursive=True)

    def add(self, data: bytes) -> None:
        if self.stream is None:
            self.number += 1
            self.name = f"shard-{self.shard:06d}-{self.number:06d}.warc.gz"
            self.temporary = f"_temporary/{self.attempt}-{self.name}"
            self.stream = self.store.open_output_stream(f"{self.path}/{self.temporary}", compression=None)
            self.records = self.size = 0
            self.digest = hashlib.sha1()
        self.stream.write(data)
        self.digest.update(data)
        self.records += 1
        self.size += len(data)
        if self.size >= self.file_bytes:
            self.close()

    def close(self) -> None:
        if self.stream is not None:
            self.stream.close()
            self.stream = None
            self.rows.append((self.shard, self.name, self.temporary, self.records, self.size, self.digest.hexdigest()))


_MANIFEST = "shard int, name string, temporary string, records bigint, bytes bigint, sha1 string"
_MANIFEST_ARROW = pa.schema([
    ("shard", pa.int32()), ("name", pa.string()), ("temporary", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha1", pa.string()),
])


def _manifest_rows(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows) if rows else [[] for _ in _MANIFEST_ARROW]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _MANIFEST_ARROW)], schema=_MANIFEST_ARROW)


@dataclass
class Shards:
    """Which shard an id belongs to. Blocks of equal steps: a step has a shard's number, or the negative number (less one) of the block that cuts
    it anew. Block 0 covers all ids; `depth` blocks are passed at most."""

    lows: list[int]
    widths: list[int]
    bases: list[int]
    steps: list[int]
    depth: int
    count: int

    def of(self, page_id: Column, digest: Column) -> Column:
        """The shard of a page; pages without an id are dealt out by their digests."""
        def table(values: list[int]) -> Column:
            return F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>")

        lows, widths, bases, steps = map(table, (self.lows, self.widths, self.bases, self.steps))
        found = F.lit(-1).cast("bigint")
        for _ in range(self.depth):
            block = (-found - 1).cast("int")
            place = F.get(bases, block) + F.call_function("div", page_id - F.get(lows, block), F.get(widths, block))
            found = F.when(found >= 0, found).otherwise(F.get(steps, place.cast("int")))
        dealt = F.pmod(F.xxhash64(digest), F.lit(self.count))
        return F.when(page_id.isNull(), dealt).otherwise(found).cast("int")


def shards_of(sizes: DataFrame, shard_bytes: int = SHARD_BYTES, steps: int = STEPS) -> Shards:
    """Cut the ids into shards, from (page_id, n_bytes): a new shard begins when the one before has its bytes.

    Ids are counted in `steps` equal steps. A step with more than a shard's bytes is cut into steps of its own, and so on down to single ids, so
    that ids far off from the others do not gather those in one step. What reaches the driver is a row a step.
    """
    known = sizes.where("page_id is not null")
    found = known.agg(F.min("page_id").alias("low"), F.max("page_id").alias("high")).first()
    if found["low"] is None:
        whole = sizes.agg(F.sum("n_bytes")).first()[0] or 0
        return Shards([0], [1], [0], [0], 1, max(1, -(-whole // shard_bytes)))
    # Blocks as (low, width, steps); bytes by (block, step).
    blocks = [(found["low"], max(1, -(-(found["high"] - found["low"] + 1) // steps)), steps)]
    filled: dict[tuple[int, int], int] = {}
    cut_anew: dict[tuple[int, int], int] = {}
    todo, depth = [(found["low"], found["high"], 0)], 0
    while todo:
        depth += 1
        # The ranges do not overlap, so their lower ends in order tell a row's range.
        todo.sort()
        lows = F.array(*[F.lit(low).cast("bigint") for low, _, _ in todo]) if len(todo) <= 64 else F.split(F.lit(",".join(str(low) for low, _, _ in todo)), ",").cast("array<bigint>")
        mine = F.size(F.filter(lows, lambda low: low <= F.col("page_id"))) - 1

        def of_range(values: list[int]) -> Column:
            return F.get(F.split(F.lit(",".join(map(str, values))), ",").cast("array<bigint>"), mine)

        inside = known.where(mine >= 0).withColumns({
            "high": of_range([high for _, high, _ in todo]), "block": of_range([block for _, _, block in todo]),
            "low": of_range([low for low, _, _ in todo]), "width": of_range([blocks[block][1] for _, _, block in todo]),
        }).where("page_id <= high")
        rows = inside.groupBy("block", F.expr("(page_id - low) div width").cast("int").alias("step")).agg(
            F.sum("n_bytes").alias("n_bytes"), F.min("page_id").alias("first"), F.max("page_id").alias("last")
        ).collect()
        heavy = [r for r in rows if r["n_bytes"] > shard_bytes and r["first"] < r["last"]]
        # Heavy steps are fewer than shards; together they get as many steps again, two at least.
        each, todo = max(2, steps // max(1, len(heavy))), []
        for r in rows:
            filled[r["block"], r["step"]] = r["n_bytes"]
        for r in sorted(heavy, key=lambda r: r["first"]):
            cut_anew[r["block"], r["step"]] = len(blocks)
            todo.append((r["first"], r["last"], len(blocks)))
            blocks.append((r["first"], max(1, -(-(r["last"] - r["first"] + 1) // each)), each))
    bases = [0]
    for _, _, size in blocks:
        bases.append(bases[-1] + size)
    numbers = [0] * bases[-1]
    shard, inside_shard = 0, 0

    def deal(block: int) -> None:
        nonlocal shard, inside_shard
        for step in range(blocks[block][2]):
            if (block, step) in cut_anew:
                numbers[bases[block] + step] = -cut_anew[block, step] - 1
                deal(cut_anew[block, step])
                continue
            if inside_shard >= shard_bytes:
                shard, inside_shard = shard + 1, 0
            numbers[bases[block] + step] = shard
            inside_shard += filled.get((block, step), 0)

    deal(0)
    return Shards([b[0] for b in blocks], [b[1] for b in blocks], bases[:-1], numbers, depth, shard + 1)


def _written(folder: str, file_bytes: int, date: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Rows in order of shard, id, digest: first what is known of a payload that comes more than once, then the pages."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, known, last = None, None, None
        for batch in batches:
            columns = [batch.column(n).to_pylist() for n in range(batch.num_columns - 1)]
            for place, (shard, page_id, digest, url, first) in enumerate(zip(*columns)):
                if files is None or files.shard != shard:
                    if files is not None:
                        files.close()
                        yield _manifest_rows(files.rows)
                    files = RollingFiles(folder, shard, file_bytes)
                if first is not None:
                    known = (page_id, digest, first)
                    continue
                refers_to, is_revisit = None, False
                if known is not None and known[:2] == (page_id, digest):
                    first = known[2]
                    me = (page_id, url, digest)
                    is_revisit = (first["page_id"], first["url"]) != (page_id, url) or last == me
                    refers_to, last = first["page_id"] if is_revisit else None, me
                payload = batch.column(batch.num_columns - 1)[place].as_py()
                files.add(member(encode(Record(page_id, url, payload, refers_to, is_revisit), date)))
        if files is not None:
            files.close()
            yield _manifest_rows(files.rows)

    return of_batches


def _committed(folder: str) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Gives every file of the manifest its final name. One that has it already was renamed by an attempt that got lost."""

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        for batch in batches:
            for row in batch.to_pylist():
                if store.get_file_info(f"{path}/{row['temporary']}").type == fs.FileType.File:
                    store.move(f"{path}/{row['temporary']}", f"{path}/{row['name']}")
                if store.get_file_info(f"{path}/{row['name']}").size != row["bytes"]:
                    raise OSError(f"{row['name']} is not what was written")
            yield batch

    return of_batches


def write_archives(
    pages: DataFrame, folder: str, *, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
    min_revisit_bytes: int = MIN_REVISIT_BYTES, shard_bytes: int = SHARD_BYTES, file_bytes: int = FILE_BYTES, steps: int = STEPS,
    date: str = DATE,
) -> DataFrame:
    """Write one record per row of `pages` to archives in `folder` and commit them; return the manifest, one row a file.

    Of rows with equal payloads of at least `min_revisit_bytes` bytes the one with the smallest id is a response and the others
    revisit it; ids are followed by null, equal ids go by url, null first, and of rows equal in all one is the response. A null
    html is an empty payload. Rows without an id are dealt to the shards by their digests. A payload of any length is one record, and a task holds one at a time. Extra columns are not written. No rows: an empty manifest
    and no archive. The folder must be new and one that driver and executors share.
    """
    rows = pages.select(
        F.col(id_column).cast("bigint").alias("page_id"), F.col(url_column).alias("url"),
        F.coalesce(F.col(html_column), F.lit("")).cast("binary").alias("payload"),
    )
    sized = cut_lineage(
        rows.select("page_id", "url", F.octet_length("payload").cast("bigint").alias("n_bytes"), F.sha1("payload").alias("digest"))
    )
    order = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", F.col("url").isNotNull().alias("has_url"), "url")
    equal = (
        sized.where(F.col("n_bytes") >= min_revisit_bytes).groupBy("digest", "n_bytes")
        .agg(F.min(order).alias("low"), F.count("*").alias("rows")).where("rows > 1")
        .select("digest", "n_bytes", F.struct("low.page_id", "low.url").alias("first"))
    )
    # Thin rows for the pages with such payloads travel to the shards beside the pages, so that no body moves by its digest.
    known = sized.join(equal, ["digest", "n_bytes"]).groupBy("page_id", "digest").agg(F.any_value("first").alias("first"))
    shards = shards_of(sized, shard_bytes, steps)

    def shard(digest: Column) -> Column:
        return shards.of(F.col("page_id"), digest).alias("shard")

    nothing = F.lit(None)
    bodies = rows.select(
        shard(F.sha1("payload")), "page_id", F.sha1("payload").alias("digest"), "url", nothing.cast("struct<page_id:bigint,url:string>").alias("first"), "payload"
    )
    told = known.select(shard(F.col("digest")), "page_id", "digest", nothing.cast("string").alias("url"), "first", nothing.cast("binary").alias("payload"))
    # One task a shard, by its number.
    dealt = bodies.union(told).repartitionById(shards.count, "shard").sortWithinPartitions(
        "shard", "page_id", "digest", F.col("first").isNull(), "url"
    )
    manifest = cut_lineage(dealt.mapInArrow(_written(folder, file_bytes, date), _MANIFEST))
    done = cut_lineage(manifest.mapInArrow(_committed(folder), _MANIFEST))
    done.drop("temporary").write.parquet(f"{folder}/_manifest")
    store, path = _store(folder)
    if store.get_file_info(f"{path}/_temporary").type == fs.FileType.Directory:
        store.delete_dir(f"{path}/_temporary")
    return pages.sparkSession.read.parquet(f"{folder}/_manifest")


def members(stream: pa.NativeFile) -> Iterator[bytes]:
    """The members of a gzip file, one at a time."""
    unpacker, parts = zlib.decompressobj(31), []
    while data := stream.read(PIECE):
        while data:
            parts.append(unpacker.decompress(data))
            data = b""
            if unpacker.eof:
                data = unpacker.unused_data
                yield b"".join(parts)
                unpacker, parts = zlib.decompressobj(31), []
    if any(parts):
        raise ValueError("the archive ends within a record")


def decode(data: bytes) -> dict:
    """One record's fields; refuses a record whose bytes do not agree with its digests."""
    head, _, rest = data.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    payload = block.partition(b"\r\n\r\n")[2]
    is_response = headers["WARC-Type"] == "response"
    if (
        version != "WARC/1.1" or rest[len(block):] != b"\r\n\r\n"
        or headers["WARC-Block-Digest"] != f"sha1:{payload_digest(block)}"
        or is_response and headers["WARC-Payload-Digest"] != f"sha1:{payload_digest(payload)}"
        or is_response and int(headers["X-Payload-Length"]) != len(payload)
    ):
        raise ValueError(f"record {headers.get('WARC-Record-ID')} does not agree with its headers")
    number = lambda name: int(headers[name]) if name in headers else None
    return {
        "page_id": number("X-Page-ID"), "url": headers["WARC-Target-URI"], "record_type": headers["WARC-Type"],
        "payload_bytes": number("X-Payload-Length"), "payload_digest": headers["WARC-Payload-Digest"].removeprefix("sha1:"),
        "refers_to": number("X-Refers-To-Page"), "payload": payload if is_response else None,
    }


_READ = pa.schema([
    ("page_id", pa.int64()), ("url", pa.string()), ("record_type", pa.string()), ("payload_bytes", pa.int64()),
    ("payload_digest", pa.string()), ("refers_to", pa.int64()), ("payload", pa.binary()),
])


def read_archives(manifest: DataFrame, folder: str, *, with_payload: bool = True) -> DataFrame:
    """The records of all files of a manifest. payload is null for revisits, and left out on request."""
    schema = _READ if with_payload else _READ.remove(len(_READ) - 1)
    kinds = "page_id bigint, url string, record_type string, payload_bytes bigint, payload_digest string, refers_to bigint"

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = _store(folder)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, size = [], 0
                with store.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        rows.append(decode(data))
                        size += len(data) if with_payload else 200
                        if size >= PIECE:
                            yield pa.RecordBatch.from_pylist(rows, schema)
                            rows, size = [], 0
                if rows:
                    yield pa.RecordBatch.from_pylist(rows, schema)

    files = manifest.select("name").repartition(F.col("name"))
    return files.mapInArrow(of_batches, kinds + (", payload binary" if with_payload else ""))
