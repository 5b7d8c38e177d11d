"""A deterministic, sharded WARC writer and its reader.

Records are range-sorted by page id into shards whose bounds follow from the data alone. Each shard's task writes gzip
files, one member per record, and starts a new file once the compressed size passes a bound. Headers, record ids and
digests are made anew from the payload. A file is written under a temporary name and renamed when complete; the manifest,
a table that Spark commits, names the files that count. The reader opens only those, so what a lost task left behind
plays no part. A task that is repeated writes the same bytes under the same names.

Files are opened through ``pyarrow.fs`` by the folder's address, so any store it knows will do.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.fs
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starledger.llm.common import hash_share, written
from starledger.operators.joins import BROADCAST_LIMIT, measured_bytes, split_join

# Compressed bytes after which a file is closed, payload bytes per shard, and the number of shards beyond which they grow.
FILE_BYTES = 64 << 20
SHARD_BYTES = 32 << 20
MOST_SHARDS = 20_000
# Ids sampled per shard to place its bounds.
SAMPLE_PER_SHARD = 64
# The tables hold no time of capture; a constant keeps archives equal from run to run.
DATE = "1970-01-01T00:00:00Z"

LEVEL = 6
END = b"\r\n"
# Fields and the profile of the WARC 1.1 format.
VERSION = b"WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
# Fields of our own.
PAGE_ID, REFERS_TO_PAGE = "X-Page-Id", "X-Refers-To-Page-Id"

MANIFEST = "file string, shard int, records bigint, bytes bigint, sha256 string"
RECORDS = "page_id {}, url string, payload_bytes bigint, payload_digest string, record_type string, refers_to {}, payload binary"


def write_archives(
    pages: DataFrame,
    folder: str,
    page_id: str = "page_id",
    url: str = "url",
    payload: str = "html",
    revisit_from: int = 0,
    file_bytes: int = FILE_BYTES,
    shard_bytes: int = SHARD_BYTES,
    broadcast_limit: int = BROADCAST_LIMIT,
    date: str = DATE,
) -> None:
    """Write one record per row of ``pages`` below ``folder``.

    The payload is the text in UTF-8, a null one being empty. Among rows with equal payloads of at least
    ``revisit_from`` bytes the one with the smallest id is a response, the others revisit it; smaller payloads are
    always responses. A row without id is a revisit if a row with an id has its payload, else a response. Rows that share
    the smallest id are all responses. Line breaks and blanks in a URL are percent-encoded; a null URL becomes
    ``urn:page:<id>``.
    """
    spark = pages.sparkSession
    content = F.coalesce(F.col(f"`{payload}`"), F.lit("")).cast("binary")
    rows = pages.select(
        F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("url"), content.alias("payload")
    ).withColumns({"bytes": F.octet_length("payload").cast("bigint"), "digest": F.sha2("payload", 256)})

    narrow = written(rows.select("page_id", "bytes", "digest"), "warc-digests")
    # The smallest id of each payload that several rows have: counted before the shuffle, so copies cost one row a task.
    copies = narrow.filter(F.col("bytes") >= revisit_from).groupBy("digest").agg(
        F.min("page_id").alias("first_id"), F.count("*").alias("copies")
    )
    firsts = written(copies.filter(F.col("copies") > 1).select("digest", "first_id"), "warc-firsts")
    if measured_bytes(firsts) <= broadcast_limit:
        linked = rows.join(F.broadcast(firsts), "digest", "left")
    else:
        alone = copies.filter(F.col("copies") == 1).select("digest", "first_id")
        short = narrow.filter(F.col("bytes") < revisit_from).select("digest").distinct()
        every = firsts.unionByName(alone).unionByName(short.withColumn("first_id", F.lit(None).cast(firsts.schema["first_id"].dataType)))
        linked = split_join(rows, every, "digest")
    revisit = F.col("first_id").isNotNull() & ~F.coalesce(F.col("page_id") == F.col("first_id"), F.lit(False))
    refers_to = F.when(revisit, F.col("first_id"))

    bounds = _bounds(narrow, shard_bytes)
    ready = linked.select("page_id", "url", "payload", refers_to.alias("refers_to"), _shard_of("page_id", bounds).alias("shard"))
    # The whole row is the order, so equal ids come in the same order on every run.
    sorted_rows = ready.repartitionById(len(bounds) + 1, F.col("shard")).sortWithinPartitions(
        "shard", "page_id", "url", "payload"
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = _Files(folder, file_bytes, date)
        for batch in batches:
            for row in zip(*(batch.column(c) for c in ("page_id", "url", "payload", "refers_to", "shard")), strict=True):
                out.add(*(x.as_py() for x in row))
            yield from out.manifest()
        out.close()
        yield from out.manifest()

    sorted_rows.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")


def _bounds(narrow: DataFrame, shard_bytes: int) -> list:
    """Ids at which a new shard begins.

    They are quantiles of the ids with small hashes: an even sample, the same on every run, and of a size that is bounded
    by the number of shards. Rows that repeat an id are in it as often as they occur.
    """
    total, rows = narrow.agg(F.sum("bytes"), F.count("page_id")).first()
    total = total or 0
    shards = min(max(1, -(-total // shard_bytes)), MOST_SHARDS)
    if shards == 1:
        return []
    known = narrow.select("page_id").filter(F.col("page_id").isNotNull())
    sample = known.filter(hash_share("page_id") * rows <= shards * SAMPLE_PER_SHARD).groupBy("page_id").count()
    ids = [x for page_id, n in sorted(sample.collect()) for x in [page_id] * min(n, SAMPLE_PER_SHARD)]
    return sorted({ids[len(ids) * k // shards] for k in range(1, shards)}) if ids else []


def _shard_of(page_id: str, bounds: list) -> Column:
    """The number of bounds at or below the id; rows without id go to the first shard."""
    if not bounds:
        return F.lit(0)
    array = np.array(bounds)

    @F.pandas_udf("int")
    def shard(ids: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(array, ids.to_numpy(), "right")).astype("int32")

    # Without nulls among them, whole numbers stay whole numbers on their way through pandas.
    known = shard(F.coalesce(F.col(page_id), F.lit(bounds[0])))
    return F.when(F.col(page_id).isNull(), F.lit(0)).otherwise(known)


def _open(folder: str):
    filesystem, path = pyarrow.fs.FileSystem.from_uri(folder)
    return filesystem, path.rstrip("/")


class _Files:
    """The files of one task, and the manifest rows of those that are complete."""

    def __init__(self, folder: str, file_bytes: int, date: str):
        self.filesystem, self.path = _open(folder)
        self.file_bytes, self.date = file_bytes, date
        self.shard, self.number, self.stream, self.done = None, 0, None, []

    def add(self, page_id, url, payload: bytes, refers_to, shard: int) -> None:
        if shard != self.shard:
            self.close()
            self.shard, self.number = shard, 0
        if self.stream is None:
            self._start()
        block = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)  # a gzip member without name and time
        data = block.compress(record(page_id, url, payload, refers_to, self.date)) + block.flush()
        self.stream.write(data)
        self.hash.update(data)
        self.records, self.size = self.records + 1, self.size + len(data)
        if self.size >= self.file_bytes:
            self.close()

    def _start(self) -> None:
        self.name = f"shard-{self.shard:06d}-{self.number:05d}.warc.gz"
        self.temporary = f"{self.path}/_temporary/{self.name}.{uuid.uuid4().hex}"
        self.filesystem.create_dir(f"{self.path}/_temporary", recursive=True)
        self.stream = self.filesystem.open_output_stream(self.temporary, compression=None)
        self.hash, self.records, self.size = hashlib.sha256(), 0, 0

    def close(self) -> None:
        if self.stream is None:
            return
        self.stream.close()
        self.stream, self.number = None, self.number + 1
        final = f"{self.path}/{self.name}"
        if self.filesystem.get_file_info(final).type == pyarrow.fs.FileType.File:
            self.filesystem.delete_file(self.temporary)  # an earlier attempt wrote the same, and a manifest may name it
        else:
            self.filesystem.move(self.temporary, final)
        self.done.append((self.name, self.shard, self.records, self.size, self.hash.hexdigest()))

    def manifest(self) -> Iterator[pa.RecordBatch]:
        if self.done:
            yield pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(zip(*self.done, strict=True), _MANIFEST_TYPES, strict=True)],
                ["file", "shard", "records", "bytes", "sha256"],
            )
            self.done = []


_MANIFEST_TYPES = (pa.string(), pa.int32(), pa.int64(), pa.int64(), pa.string())


def base32_sha1(data: bytes) -> str:
    return base64.b32encode(hashlib.sha1(data).digest()).decode()


def _record_id(page_id, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page_id}:{digest}')}>"


def _clean_url(url: str) -> str:
    return "".join(c if " " < c != "\x7f" else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page_id, url: str | None, payload: bytes, refers_to, date: str = DATE) -> bytes:
    """One WARC record: a response with the payload, or a revisit without it."""
    digest = base32_sha1(payload)
    http = (
        b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
        + str(len(payload)).encode()
        + END
        + END
    )
    block = http if refers_to is not None else http + payload
    fields = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": _record_id(page_id, digest),
        "WARC-Date": date,
        "WARC-Target-URI": _clean_url(url) if url is not None else f"urn:page:{page_id}",
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Block-Digest": f"sha1:{base32_sha1(block)}",
        "Content-Type": "application/http; msgtype=response",
        "Content-Length": str(len(block)),
    }
    if page_id is not None:
        fields[PAGE_ID] = str(page_id)
    if refers_to is not None:
        fields |= {"WARC-Profile": REVISIT_PROFILE, "WARC-Refers-To": _record_id(refers_to, digest), REFERS_TO_PAGE: str(refers_to)}
    head = END.join([VERSION, *(f"{k}: {v}".encode() for k, v in fields.items())])
    return head + END + END + block + END + END


def parse(data: bytes) -> tuple[dict[str, str], dict[str, str], bytes]:
    """WARC fields, HTTP fields and payload of one record; raises if a digest or a length is wrong."""
    head, _, rest = data.partition(END + END)
    version, *lines = head.split(END)
    if version != VERSION:
        raise ValueError(f"not a WARC record: {version[:40]!r}")
    fields = dict(line.decode().split(": ", 1) for line in lines)
    n = int(fields["Content-Length"])
    block = rest[:n]
    if len(block) != n or rest[n:] != END + END or fields["WARC-Block-Digest"] != f"sha1:{base32_sha1(block)}":
        raise ValueError(f"damaged record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(END + END)
    http_fields = dict(line.decode().split(": ", 1) for line in http.split(END)[1:])
    if fields["WARC-Type"] == "response" and fields["WARC-Payload-Digest"] != f"sha1:{base32_sha1(payload)}":
        raise ValueError(f"damaged payload of {fields.get('WARC-Record-ID')}")
    return fields, http_fields, payload


def members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of a stream, one by one."""
    decoder, parts, data = zlib.decompressobj(31), [], b""
    while True:
        data = data or stream.read(chunk)
        if not data:
            if parts:
                raise ValueError("the archive ends inside a record")
            return
        parts.append(decoder.decompress(data))
        data = decoder.unused_data
        if decoder.eof:
            yield b"".join(parts)
            decoder, parts = zlib.decompressobj(31), []


def read_archives(spark: SparkSession, folder: str, id_type: str = "bigint") -> DataFrame:
    """``page_id, url, payload_bytes, payload_digest, record_type, refers_to, payload`` of every archived record.

    Reads the files of the manifest, a task per file. Size and digest are those of the full payload; the payload itself
    is null for a revisit.
    """
    files = spark.read.parquet(f"{folder}/manifest").select("file", "records")
    schema = RECORDS.format(id_type, id_type)
    number = int if id_type in ("bigint", "int") else str
    types = [pa.string() if number is str else pa.int64() if id_type == "bigint" else pa.int32()]
    types = [*types, pa.string(), pa.int64(), pa.string(), pa.string(), types[0], pa.binary()]
    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to", "payload"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        filesystem, path = _open(folder)
        for batch in batches:
            for name, expected in zip(batch.column("file").to_pylist(), batch.column("records").to_pylist(), strict=True):
                rows, held, count = [], 0, 0
                with filesystem.open_input_stream(f"{path}/{name}", compression=None) as stream:
                    for data in members(stream):
                        fields, http, payload = parse(data)
                        rows.append(
                            (
                                number(fields[PAGE_ID]) if PAGE_ID in fields else None,
                                fields["WARC-Target-URI"],
                                int(http["Content-Length"]),
                                fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                fields["WARC-Type"],
                                number(fields[REFERS_TO_PAGE]) if REFERS_TO_PAGE in fields else None,
                                payload if fields["WARC-Type"] == "response" else None,
                            )
                        )
                        held, count = held + len(payload), count + 1
                        if held > 8 << 20:
                            yield _batch(rows, types, names)
                            rows, held = [], 0
                if count != expected:
                    raise ValueError(f"{name} holds {count} records, the manifest says {expected}")
                if rows:
                    yield _batch(rows, types, names)

    return files.repartition(max(1, files.count()), "file").mapInArrow(read, schema)


def _batch(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(zip(*rows, strict=True), types, strict=True)], names)
