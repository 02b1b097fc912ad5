"""WARC archives: writing, normalising and reading back.

A crawl often leaves archives that are one gzip stream each; such a file can only be read from its start.  The
normaliser inflates the stream once, rewrites every record as a gzip member of its own and writes a sidecar index with
offset and length of each, so that any record can be read alone and a file can be split.  On the way it turns records
whose payload is already held elsewhere into ``revisit`` records.

No payload is ever shuffled.  Writing and normalising are narrow passes that stream through files of bounded size in
the shared folder; what is exchanged is one narrow row per record (file, place in the file, page, digest), from which
the first holder of each digest is found by an aggregate.  File names carry the task attempt, and only files named in a
stored table of rows are read on, so a repeated or lost task leaves nothing half-done.
"""

from __future__ import annotations

import base64
import hashlib
import zlib
from collections.abc import Iterator
from datetime import UTC, datetime

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sensorloom.llm.tables import stored
from sensorloom.session import scratch_path

# Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
END = b"\r\n\r\n"
RESPONSE = "application/http; msgtype=response"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

FILE_BYTES = 64 << 20
CHUNK = 1 << 20
LEVEL = 5
#: Records have no fetch time of their own; a fixed one keeps reruns equal.
WHEN = datetime(2024, 1, 1, tzinfo=UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def payload_digest(payload: bytes) -> str:
    """SHA-1 in upper-case base32, the customary form of a payload digest."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


# ---- records ------------------------------------------------------------------------


def headers(fields: list[tuple[str, object]]) -> bytes:
    """Header lines; fields without a value are left out, line breaks in a value become spaces."""
    lines = [f"{k}: {' '.join(str(v).split())}".encode() for k, v in fields if v is not None]
    return b"\r\n".join(lines)


def record_id(page_id: object) -> str | None:
    return None if page_id is None else f"<urn:page:{page_id}>"


def page_of(ident: str | None) -> str | None:
    return ident[len("<urn:page:") : -1] if ident and ident.startswith("<urn:page:") else None


def record(page_id: object, url: str | None, payload: bytes, digest: str, first: object = None, revisit: bool = False) -> bytes:
    """One record: the payload behind its HTTP header, or for a revisit the HTTP header alone."""
    http = b"HTTP/1.1 200 OK\r\n" + headers([("Content-Type", "text/html; charset=utf-8"), ("Content-Length", len(payload))]) + END
    return _framed(page_id, url, http if revisit else http + payload, digest, first, revisit)


def _framed(page_id: object, url: str | None, block: bytes, digest: str, first: object, revisit: bool) -> bytes:
    head = headers(
        [
            ("WARC-Type", "revisit" if revisit else "response"),
            ("WARC-Record-ID", record_id(page_id)),
            ("WARC-Date", WHEN),
            ("WARC-Target-URI", url),
            ("WARC-Profile", SAME_PAYLOAD if revisit else None),
            ("WARC-Refers-To", record_id(first) if revisit else None),
            ("WARC-Payload-Digest", f"sha1:{digest}"),
            ("Content-Type", RESPONSE),
            ("Content-Length", len(block)),
        ]
    )
    return b"".join([VERSION, b"\r\n", head, END, block, END])


def parse_headers(raw: bytes) -> dict[str, str]:
    """Header lines below the first line, names in lower case."""
    pairs = (line.split(b":", 1) for line in raw.split(b"\r\n")[1:] if b":" in line)
    return {k.decode("latin-1").strip().lower(): v.decode("utf-8", "replace").strip() for k, v in pairs}


def read_records(chunks: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an inflated stream; holds one record and one chunk."""
    buffer = bytearray()
    chunks = iter(chunks)

    def fill(n: int) -> bool:
        while len(buffer) < n:
            more = next(chunks, None)
            if more is None:
                return False
            buffer.extend(more)
        return True

    while True:
        at = buffer.find(END)
        while at < 0:
            size = len(buffer)
            if not fill(size + 1):
                if buffer.strip():
                    raise ValueError("the archive ends inside a header")
                return
            at = buffer.find(END, max(0, size - 3))
        head = bytes(buffer[:at])
        if not head.lstrip(b"\r\n").startswith(b"WARC/"):
            raise ValueError("not a WARC record")
        fields = parse_headers(head.lstrip(b"\r\n"))
        n = int(fields["content-length"])
        if not fill(at + 4 + n):
            raise ValueError("the archive ends inside a record")
        block = bytes(buffer[at + 4 : at + 4 + n])
        del buffer[: at + 4 + n]
        while fill(1) and buffer[:1] in (b"\r", b"\n"):
            del buffer[: len(buffer) - len(buffer.lstrip(b"\r\n"))]
        yield fields, block


# ---- files ----------------------------------------------------------------------------


def _fs(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a path with or without scheme, and the path in it."""
    return pafs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")


def inflated(path: str) -> Iterator[bytes]:
    """A gzip file's content in pieces, of however many members it consists."""
    fs, place = _fs(path)
    with fs.open_input_stream(place, compression=None) as f:
        unzip = zlib.decompressobj(31)
        while data := f.read(CHUNK):
            while data:
                yield unzip.decompress(data, CHUNK)
                data = unzip.unconsumed_tail
                if unzip.eof:
                    data, unzip = unzip.unused_data, zlib.decompressobj(31)


def _attempt_name(stem: str) -> str:
    task = TaskContext.get()
    return f"{stem}-{task.partitionId():06d}-{task.taskAttemptId()}"


# ---- Spark ------------------------------------------------------------------------------


def write_stream_archives(pages: DataFrame, folder: str, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write every row as a response record into archives that are one gzip stream each.

    Returns the stored table ``file, nth, page_id, digest``: which record of which file holds which page.  A file is
    closed at ``FILE_BYTES`` of records.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        fs.create_dir(base, recursive=True)
        out, zipper, name, nth, size, n_files = None, None, "", 0, 0, 0

        def close() -> None:
            out.write(zipper.flush())
            out.close()

        for batch in batches:
            files, places, digests = [], [], []
            for ident, address, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if out is None or size >= FILE_BYTES:
                    if out is not None:
                        close()
                    name, nth, size, n_files = f"{_attempt_name('stream')}-{n_files:04d}.warc.gz", 0, 0, n_files + 1
                    out, zipper = fs.open_output_stream(f"{base}/{name}", compression=None), zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                payload = text or b""
                digest = payload_digest(payload)
                data = record(ident, address, payload, digest)
                out.write(zipper.compress(data))
                files.append(name)
                places.append(nth)
                digests.append(digest)
                nth, size = nth + 1, size + len(data)
            yield pa.RecordBatch.from_arrays(
                [pa.array(files, pa.string()), pa.array(places, pa.int64()), batch.column(0), pa.array(digests, pa.string())],
                ["file", "nth", "page_id", "digest"],
            )
        if out is not None:
            close()

    kind = pages.schema[key].dataType.simpleString()
    rows = pages.select(F.col(key).alias("page_id"), F.col(url).cast("string").alias("url"), F.col(html).cast("binary").alias("html"))
    return stored(rows.mapInArrow(run, f"file string, nth long, page_id {kind}, digest string"), "warc-rows")


def revisits(rows: DataFrame) -> DataFrame:
    """``file, nth, first``: the records whose payload another record holds already, and that record's page.

    The holder is the record with the least page id, null ids last; between rows that repeat an id, the first written.
    """
    rank = F.struct(F.col("page_id").isNull().alias("no_id"), "page_id", "file", "nth")
    holders = rows.groupBy("digest").agg(F.min(rank).alias("held"), F.count(F.lit(1)).alias("n")).where("n > 1")
    joined = rows.join(holders, "digest").where((F.col("file") != F.col("held.file")) | (F.col("nth") != F.col("held.nth")))
    return joined.select("file", "nth", F.col("held.page_id").alias("first"))


def normalise(files: DataFrame, source: str, target: str) -> DataFrame:
    """Rewrite the archives ``file`` of folder ``source`` into ``target``, one gzip member per record.

    ``files`` has ``file`` and ``again``, an array of ``(nth, first)``: records to turn into revisits of page
    ``first``.  Each archive gets a sidecar ``.idx`` with a line ``offset length type record-id`` per record.  Returns
    ``file, offset, length``, the index as rows, stored.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(target)
        fs.create_dir(base, recursive=True)
        for batch in batches:
            for row in batch.to_pylist():
                again = {x["nth"]: x["first"] for x in row["again"] or ()}
                name = f"{_attempt_name(row['file'].removesuffix('.warc.gz'))}.warc.gz"
                offset, found, lines = 0, [], []
                with fs.open_output_stream(f"{base}/{name}", compression=None) as out:
                    for nth, (fields, block) in enumerate(read_records(inflated(f"{source}/{row['file']}"))):
                        ident, digest = page_of(fields.get("warc-record-id")), fields["warc-payload-digest"].removeprefix("sha1:")
                        if revisit := nth in again:
                            block = block[: block.index(END) + 4]
                        data = _framed(ident, fields.get("warc-target-uri"), block, digest, again.get(nth), revisit)
                        zipper = zlib.compressobj(LEVEL, zlib.DEFLATED, 31)
                        member = zipper.compress(data) + zipper.flush()
                        out.write(member)
                        found.append((name, offset, len(member)))
                        lines.append(f"{offset} {len(member)} {'revisit' if revisit else 'response'} {ident or '-'}\n")
                        offset += len(member)
                with fs.open_output_stream(f"{base}/{name}.idx", compression=None) as out:
                    out.write("".join(lines).encode())
                names, offsets, lengths = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(names, pa.string()), pa.array(offsets, pa.int64()), pa.array(lengths, pa.int64())], ["file", "offset", "length"]
                )

    return stored(files.mapInArrow(run, "file string, offset long, length long"), "warc-index")


def read_index(spark: SparkSession, folder: str, files: DataFrame) -> DataFrame:
    """``file, offset, length`` from the sidecar indexes of the archives ``file`` in ``files``."""
    lines = spark.read.text(f"{folder}/*.idx").select("value", F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)\.idx$", 1).alias("file"))
    parts = F.split("value", " ")
    rows = lines.select("file", parts[0].cast("long").alias("offset"), parts[1].cast("long").alias("length"))
    return rows.join(files.select("file").distinct(), "file", "left_semi")


def read_members(index: DataFrame, folder: str, id_type: str = "bigint") -> DataFrame:
    """Read each indexed record by itself: ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.

    A response's payload is measured and checked against its digest; a revisit has length and digest of the payload it
    stands for from its headers.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, base = _fs(folder)
        name, f = None, None
        for batch in batches:
            out = []
            for file, offset, length in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                if file != name:
                    if f is not None:
                        f.close()
                    name, f = file, fs.open_input_file(f"{base}/{file}")
                f.seek(offset)
                fields, block = next(read_records(iter([zlib.decompress(f.read(length), 31)])))
                at = block.index(END)
                digest = fields["warc-payload-digest"].removeprefix("sha1:")
                if fields["warc-type"] == "response":
                    size = len(block) - at - 4
                    if payload_digest(block[at + 4 :]) != digest:
                        raise ValueError(f"{file} at {offset}: the payload does not have its digest")
                else:
                    size = int(parse_headers(block[:at])["content-length"])
                ident, first = page_of(fields.get("warc-record-id")), page_of(fields.get("warc-refers-to"))
                out.append((ident, fields.get("warc-target-uri"), size, digest, fields["warc-type"], first))
            columns = list(zip(*out, strict=True)) or [()] * 6
            kinds = [pa.string(), pa.string(), pa.int64(), pa.string(), pa.string(), pa.string()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
        if f is not None:
            f.close()

    names = ["page_id", "url", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    read = index.select("file", "offset", "length").mapInArrow(
        run, "page_id string, url string, payload_bytes long, payload_digest string, record_type string, refers_to string"
    )
    return read.withColumns({c: F.col(c).cast(id_type) for c in ("page_id", "refers_to")})


def archive(pages: DataFrame, folder: str | None = None, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """Write ``pages`` to archives, normalise them and read every record back by the index.

    Per row ``page_id, url, payload_bytes, payload_digest, record_type, refers_to``.  Null html is an empty payload;
    null ids and addresses are left out of the headers and come back null, and rows that repeat an id are records of
    their own.  An empty table gives an empty one.  Folder ``folder`` (a new one in the shared folder by default)
    keeps ``stream`` and ``members``.
    """
    spark = pages.sparkSession
    folder = folder or scratch_path(spark, "warc")
    kind = pages.schema[key].dataType.simpleString()
    rows = write_stream_archives(pages, f"{folder}/stream", key, url, html)
    again = revisits(rows).groupBy("file").agg(F.collect_list(F.struct("nth", F.col("first").cast("string").alias("first"))).alias("again"))
    files = stored(rows.select("file").distinct().join(again, "file", "left"), "warc-files")
    if files.isEmpty():
        return spark.createDataFrame(
            [], f"page_id {kind}, url string, payload_bytes long, payload_digest string, record_type string, refers_to {kind}"
        )
    n_files = files.count()
    done = normalise(files.repartition(n_files, "file"), f"{folder}/stream", f"{folder}/members")
    return read_members(read_index(spark, f"{folder}/members", done), f"{folder}/members", kind)
