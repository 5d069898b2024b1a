"""WARC archives: written as monolithic gzip streams, normalised, read back.

``write_monolithic`` writes one gzip stream per archive, as simple crawlers
do. ``normalise`` inflates each such stream once, piece by piece, rewrites
every record as a gzip member of its own and writes a sidecar index (one line
per record: offset, length, type, record id). ``read_records`` then reads any
records by their offsets, so that an archive is read in parallel.

Archives lie in a shared folder (any file system of ``pyarrow.fs``). A task
writes under a name of its own attempt and reports it only when the file is
complete, so a repeated or lost task leaves no half archive behind.
"""

from __future__ import annotations

import base64
import hashlib
import io
import zlib
from collections.abc import Callable, Iterator
from typing import BinaryIO

import pyarrow as pa
from pyarrow import fs as arrow_fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunelake.llm.common import forget, new_folder, quoted, ship, store

GZIP = 31  # window bits of zlib for gzip framing
PIECE = 1 << 20
# Uncompressed bytes after which a task begins a new archive.
ARCHIVE_BYTES = 128 << 20
# Compressed bytes of an archive that one task reads back, about.
READ_BYTES = 16 << 20
BATCH_BYTES = 16 << 20
REVISIT = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "2000-01-01T00:00:00Z"


def file_system(uri: str) -> tuple[arrow_fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = uri[5:]
    return arrow_fs.FileSystem.from_uri(uri)


def _digest(hex_sha1: str) -> str:
    return base64.b32encode(bytes.fromhex(hex_sha1)).decode()


def _record(fields: list[tuple[str, str]], block: list[bytes]) -> bytes:
    fields = [*fields, ("Content-Length", str(sum(map(len, block))))]
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return b"".join([head.encode(), *block, b"\r\n\r\n"])


def page_record(page_id, url, payload: bytes, sha1: str, keeper) -> bytes:
    """One response record, or a revisit of ``keeper``'s where that is another page."""
    revisit = keeper is not None and page_id is not None and keeper != page_id
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    fields = [("WARC-Type", "revisit" if revisit else "response"), ("WARC-Record-ID", _record_id(page_id)), ("WARC-Date", DATE)]
    if url is not None:
        fields.append(("WARC-Target-URI", "".join(c if c > " " else f"%{ord(c):02X}" for c in url)))
    if revisit:
        fields += [("WARC-Refers-To", _record_id(keeper)), ("WARC-Profile", REVISIT)]
    fields += [("WARC-Payload-Digest", "sha1:" + _digest(sha1)), ("Content-Type", "application/http;msgtype=response")]
    return _record(fields, [http] if revisit else [http, payload])


def _record_id(page_id) -> str:
    return f"<urn:x-page:{'' if page_id is None else page_id}>"


def _page_of(record_id: str | None) -> int | None:
    digits = (record_id or "").removeprefix("<urn:x-page:").removesuffix(">")
    return int(digits) if digits.lstrip("-").isdigit() else None


class _Output:
    """A file under a name that only this attempt of the task uses."""

    def __init__(self, folder: str, name: str):
        filesystem, path = file_system(folder)
        self.uri = f"{folder}/{name}"
        self.stream = filesystem.open_output_stream(f"{path}/{name}", compression=None)
        self.size = 0

    def write(self, data: bytes) -> None:
        self.stream.write(data)
        self.size += len(data)

    def close(self) -> None:
        self.stream.close()


def _task_name() -> str:
    context = TaskContext.get()
    return f"{context.partitionId():05d}-{context.taskAttemptId()}"


def _archiver(folder: str):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, made, out = _task_name(), [], None

        def close():
            out.write(code.flush())
            out.close()
            made.append((out.uri, n))

        for batch in batches:
            for row in zip(*(c.to_pylist() for c in batch.columns)):
                if out is None:
                    out, code, n, raw = _Output(folder, f"{name}-{len(made):03d}.warc.gz"), zlib.compressobj(1, zlib.DEFLATED, GZIP), 0, 0
                    out.write(code.compress(_record([("WARC-Type", "warcinfo"), ("WARC-Record-ID", f"<urn:x-file:{name}-{len(made):03d}>"),
                                                     ("WARC-Date", DATE), ("Content-Type", "application/warc-fields")], [b"format: WARC File Format 1.1\r\n"])))
                record = page_record(*row)
                out.write(code.compress(record))
                n, raw = n + 1, raw + len(record)
                if raw >= ARCHIVE_BYTES:
                    close()
                    out = None
        if out is not None:
            close()
        yield pa.record_batch([pa.array([x[0] for x in made], pa.string()), pa.array([x[1] for x in made], pa.int64())], names=["path", "records"])

    return write


def mark_keepers(pages: DataFrame, *, min_bytes: int = 0) -> DataFrame:
    """page_id, url, payload, sha1, keeper: the largest page_id among pages of
    equal payload; null for payloads under ``min_bytes``."""
    rows = pages.select(quoted("page_id").alias("page_id"), quoted("url").alias("url"),
                        F.coalesce(quoted("html"), F.lit("")).cast("binary").alias("payload"))
    rows = rows.withColumn("key", F.sha2("payload", 256))
    keepers = (rows.filter(F.octet_length("payload") >= min_bytes).select("key", "page_id")
               .groupBy("key").agg(F.max("page_id").alias("keeper")))
    return rows.join(keepers, "key", "left").select("page_id", "url", "payload", F.sha1("payload").alias("sha1"), "keeper")


def write_monolithic(pages: DataFrame, folder: str, *, min_bytes: int = 0) -> DataFrame:
    """Archives of one gzip stream each; returns the stored list (path, records).

    Null html counts as empty. Of pages with equal payloads of at least
    ``min_bytes`` the one with the largest page_id is a response and the
    others revisit it. A null page_id is always a response and never referred
    to; rows repeating the largest page_id are responses too. No pages: no archive.
    """
    ship(pages.sparkSession)
    made = mark_keepers(pages, min_bytes=min_bytes).mapInArrow(_archiver(folder), "path string, records long")
    return store(made, "archives")


class Records:
    """Records of a gzip stream of one or many members, read piece by piece."""

    def __init__(self, stream: BinaryIO):
        self.stream, self.code, self.buffer, self.ended = stream, zlib.decompressobj(GZIP), bytearray(), False

    def _more(self) -> bool:
        """Inflate one more piece into the buffer."""
        data = self.code.unconsumed_tail or (self.code.unused_data if self.code.eof else b"") or self.stream.read(PIECE)
        if not data:
            if not self.code.eof and not self.ended:
                raise ValueError("the gzip stream is cut off")
            self.ended = True
            return False
        if self.code.eof:
            self.code = zlib.decompressobj(GZIP)
        self.buffer += self.code.decompress(data, PIECE)
        return True

    def _take(self, n: int) -> bytes:
        out = bytes(self.buffer[:n])
        del self.buffer[:n]
        return out

    def __iter__(self) -> Iterator[tuple[dict[str, str], bytes, Iterator[bytes]]]:
        """(fields, header bytes, pieces of the block); read the pieces before going on."""
        while True:
            while not self.buffer and self._more():
                pass
            if not self.buffer:
                return
            seen = 0
            while (end := self.buffer.find(b"\r\n\r\n", seen)) < 0:
                seen = max(0, len(self.buffer) - 3)
                if not self._more():
                    raise ValueError("a record header is cut off")
            header = self._take(end + 4)
            first, *lines = header.decode().split("\r\n")[:-2]
            if not first.startswith("WARC/"):
                raise ValueError("not a WARC record")
            fields = {k.lower(): v.strip() for k, _, v in (x.partition(":") for x in lines)}
            yield fields, header, self._block(int(fields["content-length"]))

    def _block(self, left: int) -> Iterator[bytes]:
        while left:
            while not self.buffer:
                if not self._more():
                    raise ValueError("a record is cut off")
            part = self._take(min(left, len(self.buffer)))
            left -= len(part)
            yield part
        while len(self.buffer) < 4:
            if not self._more():
                raise ValueError("a record is cut off")
        if self._take(4) != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")


def normalise_stream(source: BinaryIO, write: Callable[[bytes], None], level: int = 6) -> Iterator[tuple[int, int, str, str]]:
    """Rewrite the records of ``source`` as members; yields their index lines."""
    offset = 0
    for fields, header, block in Records(source):
        code, size = zlib.compressobj(level, zlib.DEFLATED, GZIP), 0
        size += _put(write, code.compress(header))
        for part in block:
            size += _put(write, code.compress(part))
        size += _put(write, code.compress(b"\r\n\r\n") + code.flush())
        yield offset, size, fields.get("warc-type", ""), fields.get("warc-record-id", "")
        offset += size


def _put(write: Callable[[bytes], None], data: bytes) -> int:
    if data:
        write(data)
    return len(data)


def _normaliser(folder: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        name, made = _task_name(), []
        for batch in batches:
            for path in batch.column(0).to_pylist():
                filesystem, local = file_system(path)
                stem = f"{name}-{len(made):03d}.warc.gz"
                out, index = _Output(folder, stem), _Output(folder, stem + ".idx")
                n = 0
                with filesystem.open_input_stream(local, compression=None) as source:
                    for line in normalise_stream(source, out.write):
                        index.write(("%d %d %s %s\n" % line).encode())
                        n += 1
                out.close()
                index.close()
                made.append((out.uri, index.uri, n))
        cols = list(zip(*made)) if made else [[], [], []]
        yield pa.record_batch([pa.array(cols[0], pa.string()), pa.array(cols[1], pa.string()), pa.array(cols[2], pa.int64())],
                              names=["path", "index_path", "records"])

    return run


def normalise(archives: DataFrame, folder: str) -> DataFrame:
    """Normalised copies of the listed archives (column ``path``): stored list
    (path, index_path, records). An archive is one task's work; its writer
    bounds its size, and it is streamed, never held."""
    spark = archives.sparkSession
    ship(spark)
    n = max(1, archives.count())
    dealt = archives.select("path").repartitionByRange(n, "path")
    return store(dealt.mapInArrow(_normaliser(folder), "path string, index_path string, records long"), "normalised")


def _index_lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, index in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            filesystem, local = file_system(index)
            with filesystem.open_input_stream(local, compression=None) as f:
                rows = [x.split(b" ", 3) for x in f.read().splitlines()]
            yield pa.record_batch([pa.array([path] * len(rows), pa.string()), pa.array([int(r[0]) for r in rows], pa.int64()),
                                   pa.array([int(r[1]) for r in rows], pa.int64()), pa.array([r[2].decode() for r in rows], pa.string()),
                                   pa.array([r[3].decode() for r in rows], pa.string())],
                                  names=["path", "offset", "length", "type", "record_id"])


def read_index(normalised: DataFrame) -> DataFrame:
    """path, offset, length, type, record_id of every record, from the sidecars."""
    ship(normalised.sparkSession)
    return normalised.select("path", "index_path").mapInArrow(
        _index_lines, "path string, offset long, length long, type string, record_id string")


RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long, target_uri string, payload binary"


def read_page(member: BinaryIO, with_payload: bool) -> tuple:
    """The RECORD row of a response or revisit; a wrong digest raises."""
    for fields, _, block in Records(member):
        head, sha, body, size, kept = b"", hashlib.sha1(), False, 0, []
        for part in block:
            if not body:
                head += part
                end = head.find(b"\r\n\r\n")
                if end < 0:
                    continue
                head, part, body = head[:end], head[end + 4:], True
            sha.update(part)
            size += len(part)
            if with_payload:
                kept.append(part)
        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
        if kind == "response" and digest != _digest(sha.hexdigest()):
            raise ValueError(f"{fields['warc-record-id']}: payload and digest differ")
        if kind == "revisit":
            size = next(int(x.split(b":")[1]) for x in head.split(b"\r\n") if x.lower().startswith(b"content-length:"))
        return (_page_of(fields["warc-record-id"]), size, digest, kind, _page_of(fields.get("warc-refers-to")),
                fields.get("warc-target-uri"), b"".join(kept) if with_payload and kind == "response" else None)
    raise ValueError("an empty member")


def _reader(with_payload: bool):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, opened = [], 0, {}

        def batch_of(rows):
            cols = list(zip(*rows)) if rows else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.binary()]
            return pa.record_batch([pa.array(c, k) for c, k in zip(cols, kinds)], names=[x.split()[0] for x in RECORD.split(", ")])

        for batch in batches:
            for path, offset, length in zip(*(c.to_pylist() for c in batch.columns)):
                if path not in opened:
                    for f in opened.values():
                        f.close()
                    filesystem, local = file_system(path)
                    opened = {path: filesystem.open_input_file(local)}
                row = read_page(io.BytesIO(opened[path].read_at(length, offset)), with_payload)
                held.append(row)
                size += 200 + len(row[6] or b"")
                if size >= BATCH_BYTES:
                    yield batch_of(held)
                    held, size = [], 0
        yield batch_of(held)

    return read


def read_records(index: DataFrame, *, with_payload: bool = True) -> DataFrame:
    """RECORD rows of the page records in ``index``. A revisit carries its
    full payload's size and digest but no payload. The work is dealt by the
    bytes of the archives, of which the index lines say nothing by their own
    size: as many parts as ``READ_BYTES`` go into them."""
    ship(index.sparkSession)
    rows = index.filter(F.col("type").isin("response", "revisit")).withColumn("part", F.floor(F.col("offset") / READ_BYTES))
    n = 1 + (rows.agg(F.sum("length")).first()[0] or 0) // READ_BYTES
    return (rows.repartition(n, "path", "part").sortWithinPartitions("path", "offset").select("path", "offset", "length")
            .mapInArrow(_reader(with_payload), RECORD))


def archive_pages(pages: DataFrame, *, min_bytes: int = 0, with_payload: bool = True) -> DataFrame:
    """The pages written, normalised and read back, in folders of the shared
    checkpoint directory. The monolithic archives go when they are normalised."""
    spark = pages.sparkSession
    raw, clean = new_folder(spark, "warc-raw"), new_folder(spark, "warc")
    normalised = normalise(write_monolithic(pages, raw, min_bytes=min_bytes), clean)
    forget(spark, raw)
    return read_records(read_index(normalised), with_payload=with_payload)
