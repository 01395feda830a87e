"""WARC archives through a chunked record table.

A payload never travels whole: ``chunk_table`` turns each page into rows (record, chunk number,
bytes), and the tasks that follow take the rows of a record one after the other, carrying its
SHA-1 and length along. The digest of the last chunk names the group of equal payloads, so that
the later copies are written as revisits. ``write_archives`` streams the chunks of a record into
a gzip member of a WARC file; ``read_archives`` streams them back, checks the digests and gives
one row per record or, if asked, its chunks.

Files get names of their own for each attempt of a task. The manifest that is returned lists
those of the attempts that ended well; others are not read.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from contact_mart.llm.common import Tables, prepare

CHUNK_BYTES = 64 << 10
READ_BYTES = 256 << 10
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
CHUNKS = "record long, page_id long, url string, chunk int, data binary, payload_bytes long, payload_digest string"
RECORDS = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
SALTS = 32
MOST_TASKS = 10_000


def _arrow(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[] for _ in schema]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _base32(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def chunk_table(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Rows of CHUNKS. A record's rows stand together in order; its last row, and no other, has the digest and the
    length of the whole payload. A null payload is empty and has one row without bytes."""
    payload = F.coalesce(F.col(html), F.lit("")).cast("binary")
    last = F.greatest(F.ceil(F.octet_length(payload) / CHUNK_BYTES).cast("int") - 1, F.lit(0))
    cut = F.transform(
        F.sequence(F.lit(0), last), lambda i: F.substring(payload, i * CHUNK_BYTES + 1, F.lit(CHUNK_BYTES))
    )
    rows = pages.select(
        F.col(page_id).cast("long").alias("page_id"), F.col(url).alias("url"), last.alias("last"), F.posexplode(cut).alias("chunk", "data")
    )
    schema = pa.schema(
        [("record", pa.int64()), ("page_id", pa.int64()), ("url", pa.string()), ("chunk", pa.int32()), ("data", pa.binary()),
         ("payload_bytes", pa.int64()), ("payload_digest", pa.string())]
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        record, sha, size = TaskContext.get().partitionId() << 33, None, 0
        for batch in batches:
            records, sizes, digests = [], [], []
            for chunk, last, data in zip(batch["chunk"].to_pylist(), batch["last"].to_pylist(), batch["data"]):
                part = data.as_buffer()
                if chunk == 0:
                    record, sha, size = record + 1, hashlib.sha1(), 0
                sha.update(part)
                size += len(part)
                records.append(record)
                ends = chunk == last
                sizes.append(size if ends else None)
                digests.append(_base32(sha.digest()) if ends else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(records, pa.int64()), batch["page_id"], batch["url"].cast(pa.string()), batch["chunk"],
                 batch["data"].cast(pa.binary()), pa.array(sizes, pa.int64()), pa.array(digests, pa.string())], schema=schema
            )

    return rows.mapInArrow(digest, CHUNKS)


def record_roles(chunks: DataFrame, least_bytes: int = 0) -> DataFrame:
    """record, page_id, url, payload_bytes, payload_digest, refers_to (null: response).

    Of payloads of ``least_bytes`` or more that are equal, the rows with the largest page_id are responses. A null
    page_id is smaller than any; where a group has no other, all its rows are responses. The counts are summed before
    they move, and a large group is spread over SALTS parts when they are joined."""
    heads = chunks.where("payload_digest is not null").select("record", "page_id", "url", "payload_bytes", "payload_digest")
    copies = (
        heads.where(F.col("payload_bytes") >= least_bytes)
        .groupBy("payload_digest", "payload_bytes")
        .agg(F.max("page_id").alias("newest"), F.count("*").alias("n"))
        .where("n > 1")
        .select("payload_digest", "payload_bytes", "newest", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
    )
    salted = heads.withColumn("salt", F.pmod(F.col("record"), F.lit(SALTS)).cast("int"))
    joined = salted.join(copies, ["payload_digest", "payload_bytes", "salt"], "left")
    revisit = F.col("newest").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("newest"))
    return joined.select(
        "record", "page_id", "url", "payload_bytes", "payload_digest", F.when(revisit, F.col("newest")).alias("refers_to")
    )


def _place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if "://" in folder or folder.startswith("file:") else (fs.LocalFileSystem(), folder)


def _head(page_id, record, url, size, digest, refers_to, date: str) -> bytes:
    name = f"urn:x-page:{page_id}" if page_id is not None else f"urn:x-record:{record}"
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    target = (url or name).replace("\r", "%0D").replace("\n", "%0A")
    lines = [
        "WARC/1.1", f"WARC-Type: {'response' if refers_to is None else 'revisit'}", f"WARC-Record-ID: <{name}>",
        f"WARC-Date: {date}", f"WARC-Target-URI: {target}", "Content-Type: application/http;msgtype=response",
        f"WARC-Payload-Digest: sha1:{digest}", f"Content-Length: {len(http) + (size if refers_to is None else 0)}",
    ]
    if refers_to is not None:
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <urn:x-page:{refers_to}>"]
    return ("\r\n".join(lines) + "\r\n\r\n").encode("utf-8", "surrogatepass") + http


def write_archives(
    chunks: DataFrame, roles: DataFrame, folder: str, date: str = "1970-01-01T00:00:00Z", level: int = 3
) -> DataFrame:
    """Manifest: file, n_records. The role of a record goes ahead of its chunks; payloads move once.

    ``chunks`` must be a written table, as its record numbers have to stay the same when it is read again."""
    place, root = _place(folder)
    place.create_dir(root, recursive=True)
    empty = F.lit(None)
    heads = roles.select(
        "record", F.lit(-1).alias("chunk"), "page_id", "url", "payload_bytes", "payload_digest", "refers_to", empty.cast("binary").alias("data")
    )
    parts = chunks.select(
        "record", "chunk", empty.cast("long").alias("page_id"), empty.cast("string").alias("url"), empty.cast("long").alias("payload_bytes"),
        empty.cast("string").alias("payload_digest"), empty.cast("long").alias("refers_to"), "data",
    )
    rows = heads.unionByName(parts).repartition("record").sortWithinPartitions("record", "chunk")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out, gzip, n, wanted = None, None, 0, True
        name = f"part-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}.warc.gz"
        for batch in batches:
            columns = [batch[c] for c in ("record", "chunk", "page_id", "url", "payload_bytes", "payload_digest", "refers_to")]
            for (record, chunk, page, url, size, digest, refers), data in zip(zip(*[c.to_pylist() for c in columns]), batch["data"]):
                if chunk < 0:
                    if out is None:
                        system, path = _place(f"{folder}/{name}")
                        out = system.open_output_stream(path, compression=None)
                    else:
                        out.write(gzip.compress(b"\r\n\r\n") + gzip.flush())
                    gzip, n, wanted = zlib.compressobj(level, wbits=31), n + 1, refers is None
                    out.write(gzip.compress(_head(page, record, url, size, digest, refers, date)))
                elif wanted:
                    out.write(gzip.compress(data.as_buffer()))
        if out is not None:
            out.write(gzip.compress(b"\r\n\r\n") + gzip.flush())
            out.close()
            yield pa.RecordBatch.from_pydict({"file": [f"{folder}/{name}"], "n_records": [n]})

    return rows.mapInArrow(write, "file string, n_records long")


class _Members:
    """Bytes of a file of gzip members, a bounded piece at a time."""

    def __init__(self, stream):
        self.stream, self.held, self.gzip, self.raw = stream, bytearray(), zlib.decompressobj(31), b""

    def _more(self) -> bool:
        if self.gzip.eof:
            self.raw, self.gzip = self.gzip.unused_data or self.raw, zlib.decompressobj(31)
        self.raw = self.raw or self.stream.read(READ_BYTES)
        if not self.raw:
            rest = b"" if self.gzip.eof else self.gzip.decompress(b"", READ_BYTES)
            self.held += rest
            return bool(rest)
        self.held += self.gzip.decompress(self.raw, READ_BYTES)
        self.raw = self.gzip.unconsumed_tail
        return True

    def head(self) -> dict[str, str] | None:
        """The lines up to the next empty one as a dictionary; None at the end of the file."""
        while (end := self.held.find(b"\r\n\r\n")) < 0:
            if not self._more():
                return None
        lines = bytes(self.held[:end]).decode("utf-8", "surrogatepass").split("\r\n")
        del self.held[: end + 4]
        return {"": lines[0], "bytes": str(end + 4), **dict(x.split(": ", 1) for x in lines[1:] if ": " in x)}

    def pieces(self, size: int) -> Iterator[bytes]:
        while size > 0:
            if not self.held and not self._more():
                raise ValueError("a record ends early")
            part = bytes(self.held[: min(size, CHUNK_BYTES)])
            del self.held[: len(part)]
            size -= len(part)
            if part:
                yield part


def _records(stream) -> Iterator[tuple[dict[str, str], dict[str, str], Iterator[bytes]]]:
    """Head, HTTP head and pieces of the payload of each record."""
    members = _Members(stream)
    while (head := members.head()) is not None:
        http = members.head()
        yield head, http, members.pieces(int(head["Content-Length"]) - int(http["bytes"]))
        if b"".join(members.pieces(4)) != b"\r\n\r\n":
            raise ValueError("a record does not end where its length says")


def _page(name: str | None) -> int | None:
    return int(name[12:-1]) if name and name.startswith("<urn:x-page:") else None


def read_archives(manifest: DataFrame, chunks: bool = False) -> DataFrame:
    """Rows of RECORDS or, with ``chunks``, (page_id, chunk, data), from the files of the manifest.

    The digest of every payload is computed again while it streams; one that differs from its head ends the job. A
    revisit has the length and the digest of the payload it refers to."""
    kinds = [("page_id", pa.int64())] + (
        [("chunk", pa.int32()), ("data", pa.binary())]
        if chunks
        else [("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())]
    )
    schema = pa.schema(kinds)

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for path in (p for b in batches for p in b["file"].to_pylist()):
            system, name = _place(path)
            with system.open_input_stream(name, compression=None) as stream:
                for head, http, pieces in _records(stream):
                    page, sha, size = _page(head["WARC-Record-ID"]), hashlib.sha1(), 0
                    for k, piece in enumerate(pieces):
                        sha.update(piece)
                        size += len(piece)
                        if chunks:
                            yield page, k, piece
                    digest, refers = head["WARC-Payload-Digest"].removeprefix("sha1:"), _page(head.get("WARC-Refers-To"))
                    if head["WARC-Type"] == "response" and (digest != _base32(sha.digest()) or size != int(http["Content-Length"])):
                        raise ValueError(f"payload of page {page} differs from its digest")
                    if not chunks:
                        yield page, int(http["Content-Length"]), digest, head["WARC-Type"], refers

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for row in rows(batches):
            held.append(row)
            size += len(row[2]) if chunks else 1024
            if size >= 4 << 20:
                yield _arrow(held, schema)
                held, size = [], 0
        if held:
            yield _arrow(held, schema)

    ddl = "page_id long, chunk int, data binary" if chunks else RECORDS
    files = manifest.count()
    return manifest.select("file").repartition(max(1, min(files, MOST_TASKS))).mapInArrow(read, ddl)


def round_trip(pages: DataFrame, least_bytes: int = 0, tables: Tables | None = None) -> DataFrame:
    """Write a record per page, read the archives back: rows of RECORDS. Extra columns of ``pages`` are not read."""
    spark = prepare(pages.sparkSession)
    tables = tables or Tables(spark)
    chunks = tables.put(chunk_table(pages), "chunks")
    manifest = write_archives(chunks, record_roles(chunks, least_bytes), tables.path("archives"))
    manifest = tables.put(manifest, "manifest")
    tables.drop("chunks")
    return read_archives(manifest)
