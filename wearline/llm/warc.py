"""Deterministic sharded WARC archives: written, committed through a manifest, read back.

1. Shards are ranges of ``page_id``, cut where the bytes of a hash-chosen sample of ids reach the
   shard size, so the cuts depend on the table alone. An id that fills shards by itself is split
   by a hash of url and digest.
2. Each record is one gzip member (header, then HTTP block), built before the shuffle, so only
   compressed records move. Of equal payloads of at least ``REVISIT_BYTES`` the one with the
   largest id is the response, the others become revisit records that refer to it.
3. Each task sorts its records and rolls a file when its compressed size reaches ``ROLL_BYTES``.
   Files get temporary names of the attempt; the rows that a successful attempt returns are the
   manifest, and a second job gives the listed files their final names. What a lost attempt left
   is not in the manifest and is never read.
4. Reading streams the manifest's files, unpacks member by member, and computes lengths and
   digests anew from the stored payloads; a digest that differs from its header raises.

Archives go to the shared folder through ``pyarrow.fs``; the same table gives the same bytes.

Results for special rows: null html is an empty payload; a null url is an empty target; a null id
sorts first, is smaller than any id and comes back as null; rows with the largest id of a payload
are all responses if several share it; extra columns are ignored; an empty table gives no file.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wearline.llm.common import blocks, discard, fresh_path, land, table

REVISIT_BYTES = 1000
SHARD_BYTES = 32_000_000  # of payload
ROLL_BYTES = 8_000_000  # compressed
#: Ids in the sample that the shards are cut by, about.
SAMPLE_IDS = 20_000
#: Repeated payloads that are sent to every task, at most (about 60 bytes each).
BROADCAST_ROWS = 300_000
#: Time stamp of all records, so that equal tables give equal archives.
DATE = "2024-01-01T00:00:00Z"
LEVEL = 4
_NAMESPACE = uuid.UUID("6ba7b811-9dad-11d1-80b4-00c04fd430c8")  # RFC 4122's namespace for URLs
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"  # fixed by the WARC standard


# ---- records -----------------------------------------------------------------------------------


def gzip_member(data: bytes) -> bytes:
    packer = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def base32_sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record_id(page_id: int | None, url: str, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(_NAMESPACE, f'{page_id} {digest} {url}')}>"


def _record(fields: list[tuple[str, str]], block: bytes) -> bytes:
    # a line break in a value would end the header
    lines = "".join(f"{k}: {' '.join(v.split())}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))])
    return f"WARC/1.1\r\n{lines}\r\n".encode() + block + b"\r\n\r\n"


def page_record(page_id: int | None, url: str, size: int, digest: str, payload: bytes | None, refers_to: int | None) -> bytes:
    """A response record with its payload, or a revisit record if ``payload`` is None."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    named = [] if page_id is None else [("X-Page-Id", str(page_id))]
    seen = [] if payload is not None else [("WARC-Profile", _PROFILE), ("X-Refers-To-Page-Id", str(refers_to))]
    return _record(
        [
            ("WARC-Type", "response" if payload is not None else "revisit"),
            ("WARC-Record-ID", record_id(page_id, url, digest)),
            ("WARC-Date", DATE),
            ("WARC-Target-URI", url),
            ("Content-Type", "application/http; msgtype=response"),
            ("WARC-Block-Digest", base32_sha1(block)),
            ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
            ("X-Payload-Length", str(size)),
            *named,
            *seen,
        ],
        block,
    )


def info_record(name: str) -> bytes:
    block = b"format: WARC File Format 1.1\r\n"
    return _record(
        [
            ("WARC-Type", "warcinfo"),
            ("WARC-Record-ID", record_id(None, name, "")),
            ("WARC-Date", DATE),
            ("WARC-Filename", name),
            ("Content-Type", "application/warc-fields"),
        ],
        block,
    )


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The unpacked gzip members of a file, one by one."""
    rest = b""
    while True:
        unpack, out = zlib.decompressobj(31), []
        while not unpack.eof:
            if not rest and not (rest := stream.read(chunk)):
                if out:
                    raise ValueError("the archive ends inside a record")
                return
            out.append(unpack.decompress(rest))
            rest = unpack.unused_data
        yield b"".join(out)


def parse(record: bytes) -> tuple[dict[str, str], bytes]:
    """Header fields and block of a record; raises if its length or block digest is wrong."""
    head, _, rest = record.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if lines[0] != "WARC/1.1":
        raise ValueError(f"not a WARC record: {lines[0]!r}")
    fields = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or fields.get("WARC-Block-Digest", base32_sha1(block)) != base32_sha1(block):
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    return fields, block


# ---- shards ------------------------------------------------------------------------------------


@dataclass
class Shards:
    """Shard i holds the ids from ``first[i]`` on; an id may own ``split[i]`` shards in a row."""

    first: np.ndarray
    split: np.ndarray

    def __post_init__(self) -> None:
        self.start = np.cumsum(self.split) - self.split

    @property
    def count(self) -> int:
        return int(self.split.sum())

    def of(self, page_id: int | None, key: int) -> int:
        i = 0 if page_id is None else max(0, int(np.searchsorted(self.first, page_id, "right")) - 1)
        return int(self.start[i] + key % self.split[i])


def cut_shards(thin: DataFrame, shard_bytes: int) -> Shards:
    """Cuts from a sample of about ``SAMPLE_IDS`` ids and their bytes; large ids are all in it."""
    sizes = thin.filter("page_id IS NOT NULL").groupBy("page_id").agg(F.sum(F.col("size") + 500).alias("b"))
    total = sizes.agg(F.count("*").alias("n"), F.sum("b").alias("b")).first()
    if not total["n"]:
        return Shards(np.zeros(1, np.int64), np.ones(1, np.int64))
    every = max(1, -(-total["n"] // SAMPLE_IDS))
    # ids of over a shard's bytes are at most total / shard bytes; the others about SAMPLE_IDS
    picked = sizes.filter((F.pmod(F.xxhash64("page_id"), F.lit(every)) == 0) | (F.col("b") > shard_bytes))
    rows = sorted((r["page_id"], r["b"]) for r in picked.collect())
    first, split, room = [-(2**63)], [1], float(shard_bytes)
    for page_id, b in rows:
        if b > shard_bytes:
            first += [page_id, page_id + 1]
            split += [-(-b // shard_bytes), 1]
            room = float(shard_bytes)
            continue
        room -= b * every
        if room < 0:
            first.append(page_id)
            split.append(1)
            room = float(shard_bytes) - b * every
    return Shards(np.array(first, np.int64), np.array(split, np.int64))


# ---- writing -----------------------------------------------------------------------------------


def open_folder(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri[5:]
    return fs.FileSystem.from_uri(uri)


_MANIFEST = "shard int, part int, temporary string, name string, records bigint, bytes bigint, sha1 string"


def write_archives(pages: DataFrame, folder: str, shard_bytes: int = SHARD_BYTES, roll_bytes: int = ROLL_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) to ``folder``; returns the manifest, also kept there."""
    html = F.coalesce("html", F.lit("")).cast("binary")
    thin = land(pages.select("page_id", F.octet_length(html).cast("long").alias("size"), F.sha1(html).alias("digest")), "warc-index")
    shards = cut_shards(thin, shard_bytes)
    twins = (
        thin.filter(F.col("size") >= REVISIT_BYTES)
        .groupBy("digest")
        .agg(F.count("*").alias("n"), F.max("page_id").alias("original"))
        .filter("n > 1 AND original IS NOT NULL")
        .select("digest", "original")
    )

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for block in blocks(batches, "html"):
            rows = []
            for page_id, url, text in zip(*(c.to_pylist() for c in block.columns), strict=True):
                payload, url = (text or "").encode(), url or ""
                digest = hashlib.sha1(payload).hexdigest()
                member = gzip_member(page_record(page_id, url, len(payload), digest, payload, None))
                shard = shards.of(page_id, zlib.crc32(f"{digest} {url}".encode()))
                rows.append((shard, page_id, url, len(payload), digest, member))
            kinds = (pa.int32(), block.column(0).type, pa.string(), pa.int64(), pa.string(), pa.binary())
            names = ["shard", "page_id", "url", "size", "digest", "member"]
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    id_type = pages.schema["page_id"].dataType.simpleString()
    built = pages.select("page_id", "url", "html").mapInArrow(
        build, f"shard int, page_id {id_type}, url string, size bigint, digest string, member binary"
    )
    if twins.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS:
        # a checked size: the records need not be shuffled to meet it; a larger table is joined by shuffle
        twins = F.broadcast(twins)
    # a revisit carries no payload from here on
    again = F.col("original").isNotNull() & (F.col("page_id").isNull() | (F.col("page_id") < F.col("original")))
    typed = built.join(twins, "digest", "left").select(
        "shard", "page_id", "url", "size", "digest", F.when(~again, F.col("member")).alias("member"), "original"
    )
    attempt_folder = f"{folder}/_temporary"

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(attempt_folder)
        files.create_dir(root, recursive=True)
        attempt, done = uuid.uuid4().hex, []
        shard, part, sink, size, records, sha1 = None, 0, None, 0, 0, None

        def close() -> None:
            nonlocal sink
            if sink is not None:
                sink.close()
                done.append((shard, part, f"{shard:06d}-{part:05d}-{attempt}", _name(shard, part), records, size, sha1.hexdigest()))
                sink = None

        def put(data: bytes) -> None:
            nonlocal size
            sink.write(data)
            sha1.update(data)
            size += len(data)

        for block in blocks(batches, "member"):
            for s, page_id, url, length, digest, member, original in zip(*(c.to_pylist() for c in block.columns), strict=True):
                if s != shard or size >= roll_bytes:
                    close()
                    part = part + 1 if s == shard else 0
                    shard, size, records, sha1 = s, 0, 0, hashlib.sha1()
                    sink = files.open_output_stream(f"{root}/{shard:06d}-{part:05d}-{attempt}")
                    put(gzip_member(info_record(_name(shard, part))))
                if member is None:
                    member = gzip_member(page_record(page_id, url, length, digest, None, original))
                put(member)
                records += 1
        close()
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.string(), pa.int64(), pa.int64(), pa.string())
        names = ["shard", "part", "temporary", "name", "records", "bytes", "sha1"]
        yield pa.RecordBatch.from_arrays([pa.array([d[i] for d in done], k) for i, k in enumerate(kinds)], names=names)

    # each shard in a partition of its own
    placed = typed.repartitionById(shards.count, "shard").sortWithinPartitions("shard", "page_id", "url", "digest")
    written = land(placed.mapInArrow(write, _MANIFEST), "warc-written")

    def rename(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        for batch in batches:
            for temporary, name in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                # a repeated attempt finds the name in place
                if files.get_file_info(f"{root}/{name}").type == fs.FileType.NotFound:
                    files.move(f"{root}/_temporary/{temporary}", f"{root}/{name}")
            yield batch

    # the manifest appears, whole, only after every file has its name
    _spread(written).mapInArrow(rename, _MANIFEST).write.parquet(f"{folder}/manifest.parquet")
    # what is left there are the files of attempts that another one overtook
    files, root = open_folder(attempt_folder)
    if files.get_file_info(root).type == fs.FileType.Directory:
        files.delete_dir(root)
    discard(thin, written)
    return written.sparkSession.read.parquet(f"{folder}/manifest.parquet")


def _spread(manifest: DataFrame) -> DataFrame:
    """The files of a manifest over as many tasks as there are files: adaptive execution would merge the few rows."""
    return manifest.repartition(max(1, manifest.count()), "name")


def _name(shard: int, part: int) -> str:
    return f"pages-{shard:06d}-{part:05d}.warc.gz"


# ---- reading -----------------------------------------------------------------------------------


def read_archives(manifest: DataFrame, folder: str, payloads: bool = True) -> DataFrame:
    """One row for each page record: its type, page, url, payload's length and digest, and payload."""
    schema = "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, refers_to bigint, url string"
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "url"] + ["payload"] * payloads

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, root = open_folder(folder)
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()] + [pa.binary()] * payloads
        as_batch = lambda rows: pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)
        number = lambda v: None if v is None else int(v)
        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows, held = [], 0
                with files.open_input_stream(f"{root}/{name}", compression=None) as stream:
                    for record in members(stream):
                        fields, block = parse(record)
                        kind = fields["WARC-Type"]
                        if kind == "warcinfo":
                            continue
                        payload = block.partition(b"\r\n\r\n")[2]
                        digest = base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex()
                        size = int(fields["X-Payload-Length"])
                        if kind == "response":
                            size = len(payload)
                            if hashlib.sha1(payload).hexdigest() != digest:
                                raise ValueError(f"wrong payload digest in {name}")
                        row = (number(fields.get("X-Page-Id")), size, digest, kind, number(fields.get("X-Refers-To-Page-Id")), fields["WARC-Target-URI"])
                        rows.append((*row, payload) if payloads else row)
                        held += len(payload) if payloads else 200
                        if held > 4_000_000:
                            yield as_batch(rows)
                            rows, held = [], 0
                if rows:
                    yield as_batch(rows)

    return _spread(manifest.select("name")).mapInArrow(run, schema + (", payload binary" if payloads else ""))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Write a record for each of ``pages`` and read the archives back."""
    folder = fresh_path(spark, "warc")
    manifest = write_archives(table(spark, sf_dir, "pages"), folder)
    return read_archives(manifest, folder, payloads=False)


def _sql() -> str:
    return f"""
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, url, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
m AS (SELECT *, CASE WHEN payload_bytes >= {REVISIT_BYTES} THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS original FROM d),
r AS (SELECT *, coalesce(page_id < original, original IS NOT NULL) AS again FROM m)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest, CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN again THEN original END AS refers_to, coalesce(url, '') AS url FROM r"""


QUERIES = {"op1_warc": op1_warc}
ORACLE_SQL = {"op1_warc": _sql()}
