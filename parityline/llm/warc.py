"""WARC archives: a writer, and a reader whose tasks scan byte ranges.

The writer turns each row into one gzip member with one record. Rows with equal payloads
are linked by their SHA-1: the one with the largest id is a response, the others are
revisits of it, without a payload. Every task writes a file of its own name, which no
other attempt has, and reports it; only reported files, with their sizes, make up the
archive, so a task that is lost or run twice leaves nothing that is read.

The reader cuts files into ranges. A task looks for gzip's magic bytes in its range, tries
each place as a member, takes it if it decodes to a WARC header, and reads the record to
its end even beyond the range. A record belongs to the range that it starts in, so ranges
share nothing, and no index is needed.

Files lie in the shared folder and are opened through pyarrow's file systems by their
address, whatever store that is.

Defined results: a null payload counts as empty; empty payloads are equal to each other;
rows that repeat an id are written each, and if their payloads are equal, too, one of them is
the response; rows with a null id are written and read, and come last in the order of ids;
zero bytes between members are passed over, any others are an error; a null address is written as empty; an empty table gives an
archive without records; further columns are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parityline.llm.common import shared_path, written

MAGIC = b"\x1f\x8b\x08"
VERSION = b"WARC/1.1\r\n"
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
RANGE_BYTES = 16 << 20
_CHUNK = 1 << 16
_RECORD = (
    "record_id string, type string, uri string, payload_bytes long, payload_digest string, "
    "refers_to string, payload binary"
)


def digest(payload: bytes) -> str:
    """Upper-case Base32 of the SHA-1."""
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(name: str, uri: str, payload: bytes, refers_to: str | None = None) -> bytes:
    """One gzip member: a response with the payload, or a revisit of ``refers_to``.

    The HTTP header in the block of either tells the payload's length.
    """
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n"
    block = http.encode() + (b"" if refers_to else payload)
    kind = "revisit" if refers_to else "response"
    head = [
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{name}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {' '.join(uri.split())}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    if refers_to:
        head += [f"WARC-Refers-To: <urn:uuid:{refers_to}>", f"WARC-Profile: {PROFILE}"]
    text = VERSION + "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"
    packer = zlib.compressobj(wbits=31)
    return packer.compress(text) + packer.flush()


def parse(text: bytes) -> tuple | None:
    """The record in a decoded member as a row of the reader, or None."""
    if not text.startswith(b"WARC/1."):
        return None
    head, _, rest = text.partition(b"\r\n\r\n")
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        key, _, value = line.partition(":")
        fields[key.strip().lower()] = value.strip()
    block = rest[: int(fields.get("content-length", 0))]
    http, _, payload = block.partition(b"\r\n\r\n")
    kind, size = fields.get("warc-type"), len(payload)
    if kind == "revisit":
        lengths = [x for x in http.split(b"\r\n") if x.lower().startswith(b"content-length:")]
        size, payload = int(lengths[0].split(b":")[1]) if lengths else None, None
    plain = [fields.get(k, "").removeprefix("<urn:uuid:").removesuffix(">") for k in ("warc-record-id", "warc-refers-to")]
    found = fields.get("warc-payload-digest", "").removeprefix("sha1:")
    if kind == "response" and found != digest(payload):
        raise ValueError(f"record {plain[0]}: the payload does not match its digest")
    return plain[0], kind, fields.get("warc-target-uri"), size, found, plain[1] or None, payload


def write(rows: DataFrame, id_col: str, uri_col: str, payload_col: str) -> DataFrame:
    """Write an archive; returns its written list of files (path, bytes, records).

    Record ids are the rows' ids. Payloads are strings (as UTF-8) or binary.
    """
    spark = rows.sparkSession
    folder = shared_path(spark, "warc")
    rows = rows.select(
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.coalesce(F.col(f"`{uri_col}`").cast("string"), F.lit("")).alias("uri"),
        F.coalesce(F.col(f"`{payload_col}`").cast("binary"), F.lit("").cast("binary")).alias("payload"),
    ).withColumn("sha1", F.unhex(F.sha1("payload")))
    # Only payloads that occur more than once need to know their response: (sha1, id) is
    # grouped, not the payloads, and the ids are looked up by what is found.
    same = rows.groupBy("sha1", "id").agg(F.count("*").alias("m")).groupBy("sha1")
    same = same.agg(F.max(F.struct("id", "m")).alias("last"), F.sum("m").alias("n")).where("n > 1")
    same = written(same.select("sha1", "last.id", "last.m").withColumnRenamed("id", "last"), "same")
    again = F.lit(False)
    if not same.where("m > 1 and last is not null").isEmpty():
        # An id that repeats with its payload: one of its rows is the response. Written, so
        # that the rows keep their numbers.
        rows = written(rows.withColumn("no", F.monotonically_increasing_id()), "pages")
        first = rows.join(same.where("m > 1").select("sha1", F.col("last").alias("id")), ["sha1", "id"])
        first = first.groupBy("sha1").agg(F.min("no").alias("first"))
        same = same.join(first, "sha1", "left")
        again = F.col("no") != F.col("first")
    rows = rows.join(same, "sha1", "left")
    refers = F.when((F.col("last") != F.col("id")) | F.col("id").isNull() | again, F.col("last"))
    rows = rows.select("id", "uri", "payload", refers.cast("string").alias("refers_to"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, size, count, out = f"{folder}/{uuid.uuid4().hex}.warc.gz", 0, 0, None
        for batch in batches:
            for name, uri, payload, refers_to in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if out is None:
                    store, place = fs.FileSystem.from_uri(path)
                    store.create_dir(place.rpartition("/")[0], recursive=True)
                    out = store.open_output_stream(place, compression=None)
                member = record("" if name is None else str(name), uri, payload, refers_to)
                out.write(member)
                size, count = size + len(member), count + 1
        if out is not None:
            out.close()
            columns = [pa.array([path]), pa.array([size]), pa.array([count])]
            yield pa.RecordBatch.from_arrays(columns, ["path", "bytes", "records"])

    return written(rows.mapInArrow(run, "path string, bytes long, records long"), "archive")


def members(source, start: int, stop: int, size: int) -> Iterator[bytes]:
    """Decoded members of an open file that start in [start, stop) and hold a record."""
    at, window, begin = start, b"", start  # window holds the bytes from begin on
    sure = start == 0  # whether a member is known to begin here

    def more(n: int) -> bool:
        nonlocal window
        if begin + len(window) >= size:
            return False
        source.seek(begin + len(window))
        window += source.read(min(n, size - begin - len(window)))
        return True

    while at < stop:
        if at - begin > 1 << 22:
            window, begin = window[at - begin :], at
        place = window.find(MAGIC, at - begin)
        if place < 0:
            at = max(at, begin + len(window) - len(MAGIC) + 1)
            if not more(1 << 20):
                return
            continue
        sure = sure and not window[at - begin : place].strip(b"\0")
        at = begin + place
        if at >= stop:
            return
        while len(window) - place < _CHUNK and more(1 << 20):
            pass
        try:
            head = zlib.decompressobj(wbits=31).decompress(window[place : place + _CHUNK], 16)
        except zlib.error:
            head = b""
        if not head.startswith(b"WARC/1."):
            at, sure = at + 1, False
            continue
        unpack, used, parts = zlib.decompressobj(wbits=31), place, []
        try:
            while not unpack.eof and (used < len(window) or more(1 << 20)):
                parts.append(unpack.decompress(window[used : used + _CHUNK]))
                used = min(used + _CHUNK, len(window))
        except zlib.error as error:
            raise ValueError(f"the record at byte {at} is damaged") from error
        if not unpack.eof:
            raise ValueError(f"the record at byte {at} is cut off")
        end = begin + used - len(unpack.unused_data)
        after = end - begin  # behind the member and zero bytes that fill up
        while True:
            after += len(window) - after - len(window[after:].lstrip(b"\0"))
            if len(window) - after >= len(MAGIC) or not more(1 << 20):
                break
        if after < len(window) and not window[after:].startswith(MAGIC):
            if sure:
                raise ValueError(f"the bytes after the record at byte {at} are no record")
            at += 1  # bytes of a payload that look like a member
            continue
        at, sure = end, True
        yield b"".join(parts)


def read(archive: DataFrame, range_bytes: int = RANGE_BYTES) -> DataFrame:
    """One row per record of the listed files (path, bytes): see ``_RECORD``.

    A revisit has no payload; its length and digest are those of the full payload.
    """
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(range_bytes).cast("long")))
    ranges = archive.where("bytes > 0").select("path", "bytes", starts.alias("start"))
    tasks = max(1, ranges.count())
    # A task for each range while there are few, and a bounded number of tasks beyond.
    ranges = ranges.repartition(min(tasks, 10_000), "path", "start")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string()] * 3 + [pa.int64(), pa.string(), pa.string(), pa.binary()]
        names = ["record_id", "type", "uri", "payload_bytes", "payload_digest", "refers_to", "payload"]

        def packed(rows: list[tuple]) -> pa.RecordBatch:
            columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names)

        for batch in batches:
            for path, size, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                store, place = fs.FileSystem.from_uri(path)
                rows, held = [], 0
                with store.open_input_file(place) as source:
                    for text in members(source, start, min(start + range_bytes, size), size):
                        rows.append(parse(text))
                        held += len(text)
                        if held > 8 << 20:
                            yield packed(rows)
                            rows, held = [], 0
                if rows:
                    yield packed(rows)

    return ranges.mapInArrow(run, _RECORD)


def oracle() -> str:
    """Digests, lengths and links by DuckDB, from the pages themselves."""
    letters = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'"
    part = f"('0x' || substr(hex, 5 * i + 1, 5))::BIGINT"
    four = " || ".join(f"substr({letters}, (({part} >> {s}) & 31) + 1, 1)" for s in (15, 10, 5, 0))
    return f"""WITH p AS (SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes,
            sha1(coalesce(html, '')) AS hex FROM pages),
        d AS (SELECT page_id, payload_bytes, hex,
            array_to_string(list_transform(range(8), lambda i: {four}), '') AS payload_digest FROM p),
        r AS (SELECT *, max(page_id) OVER (PARTITION BY hex) AS last,
                row_number() OVER (PARTITION BY hex ORDER BY page_id DESC) AS place FROM d)
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN place = 1 THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN place > 1 THEN last END AS refers_to
        FROM r"""
