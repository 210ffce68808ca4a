"""WARC archives: a writer that leaves out repeated payloads, and a reader of byte ranges.

Writing: every row becomes one record, a gzip member of its own. Of the rows
with equal payloads of at least ``min_bytes`` bytes, those with the largest id
are ``response`` records and hold the payload; the others are ``revisit``
records that name it. A task writes its rows to files of its own, named by its
attempt, and returns their names; only files of the attempts that Spark accepts
stand in the written manifest, so a repeated task leaves no second copy.

Reading: files are cut into byte ranges, and a task takes some of them. In a
range it looks for gzip's magic bytes and tries each place as a record: the
member must decode whole with the right checksum, its header must be WARC's and
its length must agree. A record belongs to the range in which it starts, and is
read on beyond the range's end. After a record the next one is expected where it
ended; where that fails (a torn record), the search goes on. Payloads are hashed
as they are decoded, a piece at a time, so a record may be larger than memory
unless its payload is asked for.

Files are opened with ``pyarrow.fs``, which reaches the shared folder wherever
it is (file, hdfs, viewfs, s3, gs). A null payload is an empty one; a null id
is smaller than any other; a null URL leaves the field out. Rows that repeat the
largest id of a payload are all responses. An empty table gives no file. Control
characters of a URL are percent-encoded. A payload may hold anything but, at a
place that its compression leaves as it is, a whole gzip member that is a WARC
record (UTF-8 text cannot: gzip's magic is not UTF-8).
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from encore.sources.tables import materialize, scratch_path

MAGIC = b"\x1f\x8b\x08"
CHUNK = 1 << 18
#: A record's header and an HTTP header may be this long.
MAX_HEADER = 1 << 20
#: A task closes an archive at this size and begins another.
ARCHIVE_BYTES = 1 << 30
SPLIT_BYTES = 16 << 20
#: Rows are handed on at this many, or at this many bytes of payload.
BATCH_ROWS, BATCH_BYTES = 2000, 8 << 20
#: Fixed value: the profile of revisits of the WARC 1.0 standard.
PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
MANIFEST = "path string, bytes long, records long"
RECORDS = ("path string, offset long, length long, type string, record_id string, refers_to string, uri string, date string, "
           "payload_bytes long, payload_digest string, payload binary")


def _open(url: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(re.sub(r"^file:/+", "file:///", url))


def id_urn(value) -> str:
    return "<urn:null>" if value is None else f"<urn:row:{quote(str(value), safe='')}>"


def id_of(urn: Column) -> Column:
    """The id as text of a record id that ``id_urn`` made; null for others."""
    return F.url_decode(F.nullif(F.regexp_extract(urn, r"^<urn:row:(.*)>$", 1), F.lit("")))


def base32_sha1(digest: bytes) -> str:
    return base64.b32encode(digest).decode()


def record(kind: str, record_id: str, url: str | None, date: str, size: int, digest: str, payload: bytes | None, refers_to: str | None = None) -> bytes:
    """One record as a gzip member; a revisit has the HTTP header and no payload."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {size}\r\n\r\n".encode()
    block = http + (payload or b"")
    fields = [("WARC-Type", kind), ("WARC-Record-ID", record_id), ("WARC-Date", date)]
    if url is not None:
        fields.append(("WARC-Target-URI", re.sub(r"[\x00-\x20\x7f]", lambda m: quote(m[0]), url)))
    if refers_to is not None:
        fields += [("WARC-Refers-To", refers_to), ("WARC-Profile", PROFILE)]
    fields += [("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http; msgtype=response"), ("Content-Length", str(len(block)))]
    head = "WARC/1.0\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(head.encode()) + packer.compress(block) + packer.compress(b"\r\n\r\n") + packer.flush()


def _write(folder: str, date: str, archive_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        fs, base = _open(folder)
        done, out, path, size, rows = [], None, "", 0, 0

        def close():
            out.close()
            done.append((path, size, rows))

        try:
            for batch in batches:
                for i, url, payload, keeper, again in zip(*(batch.column(c) for c in ("id", "url", "payload", "keeper", "again"))):
                    if out is None:
                        path, size, rows = f"{folder}/part-{task.partitionId():06d}-{task.taskAttemptId()}-{len(done)}.warc.gz", 0, 0
                        out = fs.open_output_stream(f"{base}/{path.rsplit('/', 1)[1]}", compression=None)
                    held, again = payload.as_py(), again.as_py()
                    digest = base32_sha1(hashlib.sha1(held).digest())
                    member = record("revisit" if again else "response", id_urn(i.as_py()), url.as_py(), date, len(held), digest,
                                    None if again else held, id_urn(keeper.as_py()) if again else None)
                    out.write(member)
                    size, rows = size + len(member), rows + 1
                    if size >= archive_bytes:
                        close()
                        out = None
        finally:
            if out is not None:
                close()
        if done:
            paths, sizes, counts = zip(*done)
            yield pa.record_batch({"path": pa.array(paths), "bytes": pa.array(sizes, pa.int64()), "records": pa.array(counts, pa.int64())})
    return run


def write_warc(rows: DataFrame, id_col: str, url_col: str, payload_col: str, folder: str | None = None, min_bytes: int = 0,
               date: str = "1970-01-01T00:00:00Z", archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Write a record a row to ``folder`` (by default one in the shared folder); the manifest (path, bytes, records).

    Ids that repeat payloads are found from digests alone (sha256, one row a
    payload); payloads move only where those are too many for Spark to broadcast
    under its own threshold, and a payload that most rows share is split by AQE.
    """
    spark = rows.sparkSession
    folder = (folder or scratch_path(spark, "warc")).rstrip("/")
    fs, base = _open(folder)
    fs.create_dir(base, recursive=True)
    held = rows.select(F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"),
                       F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload")).withColumn("key", F.sha2("payload", 256))
    shared = (held.where(F.octet_length("payload") >= min_bytes).groupBy("key").agg(F.max("id").alias("keeper"), F.count(F.lit(1)).alias("n"))
                  .where("n > 1").select("key", "keeper"))
    kept = held.join(materialize(shared, "shared_payloads").withColumn("found", F.lit(True)), "key", "left")
    again = F.coalesce("found", F.lit(False)) & ~F.col("id").eqNullSafe(F.col("keeper"))
    written = kept.select("id", "url", "payload", "keeper", again.alias("again")).mapInArrow(_write(folder, date, archive_bytes), MANIFEST)
    return materialize(written, "manifest")


def list_archives(spark, folder: str) -> DataFrame:
    """The manifest of a folder of ``.warc.gz`` files that were written elsewhere (``records`` unknown)."""
    found = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.gz").load(folder)
    return found.select("path", F.col("length").alias("bytes"), F.lit(None).cast("long").alias("records"))


class _Torn(Exception):
    """No record begins here."""


def _find(f, start: int, end: int) -> int | None:
    """The first place in [start, end) where gzip's magic bytes begin."""
    while start < end:
        f.seek(start)
        held = f.read(min(CHUNK, end - start) + len(MAGIC) - 1)
        at = held.find(MAGIC)
        if at >= 0:
            return start + at if start + at < end else None
        if len(held) < len(MAGIC):
            return None
        start += len(held) - len(MAGIC) + 1
    return None


def _decoded(f, start: int, ended: list[int]) -> Iterator[bytes]:
    """The member at ``start``, a bounded piece at a time; appends the place after it to ``ended``."""
    unpacker, raw, pos = zlib.decompressobj(31), b"", start
    f.seek(start)
    while not unpacker.eof:
        if not raw:
            raw = f.read(CHUNK)
            pos += len(raw)
            if not raw:
                raise _Torn("the file ends inside the member")
        try:
            out = unpacker.decompress(raw, CHUNK)
        except zlib.error as e:
            raise _Torn(str(e)) from None
        raw = unpacker.unconsumed_tail
        if out:
            yield out
    ended.append(pos - len(unpacker.unused_data))


def _header(text: bytes) -> dict[str, str]:
    lines = text.decode("utf-8", "replace").split("\r\n")
    fields = (line.partition(":") for line in lines[1:])
    return {k.strip().lower(): v.strip() for k, colon, v in fields if colon}


def read_record(f, start: int, payloads: bool) -> dict:
    """The record whose member begins at ``start``; raises ``_Torn`` where there is none."""
    ended: list[int] = []
    pieces = _decoded(f, start, ended)
    held = b""
    for piece in pieces:
        held += piece
        if not held.startswith(b"WARC/1."[:len(held)]) or len(held) > MAX_HEADER + CHUNK:
            raise _Torn("not a WARC header")
        if b"\r\n\r\n" in held:
            break
    head, blank, held = held.partition(b"\r\n\r\n")
    if not blank:
        raise _Torn("no end of the header")
    fields = _header(head)
    try:
        size = int(fields["content-length"])
    except (KeyError, ValueError):
        raise _Torn("no length") from None
    kind = fields.get("warc-type", "")
    http, sha, seen, n, kept = b"", hashlib.sha1(), 0, 0, []
    inside = fields.get("content-type", "").startswith("application/http")  # an HTTP header comes first

    def payload(part: bytes) -> None:
        nonlocal n
        n += len(part)
        sha.update(part)
        if payloads:
            kept.append(part)

    def block(part: bytes) -> None:
        nonlocal http, inside
        if not inside:
            return payload(part)
        http += part
        if b"\r\n\r\n" in http:
            http, _, rest = http.partition(b"\r\n\r\n")
            inside = False
            payload(rest)
        elif len(http) > MAX_HEADER:  # no header after all
            inside, part, http = False, http, b""
            payload(part)

    tail = b""
    while True:
        own = held[:max(0, size - seen)]
        if own:
            block(own)
        tail += held[len(own):]
        seen += len(held)
        if len(tail) > 4:
            raise _Torn("longer than its length")
        held = next(pieces, None)
        if held is None:
            break
    if seen != size + 4 or tail != b"\r\n\r\n":
        raise _Torn("its length does not agree")
    if inside and http:
        payload(http)
        http = b""
    digest = base32_sha1(sha.digest())
    if kind == "revisit":  # the payload is elsewhere; its size and digest are in the headers
        length = _header(http).get("content-length", "")
        n = int(length) if length.isdigit() else None
        digest = fields.get("warc-payload-digest", "").removeprefix("sha1:") or None
    return {"offset": start, "length": ended[0] - start, "type": kind, "record_id": fields.get("warc-record-id"), "refers_to": fields.get("warc-refers-to"),
            "uri": fields.get("warc-target-uri"), "date": fields.get("warc-date"), "payload_bytes": n, "payload_digest": digest,
            "payload": b"".join(kept) if payloads and kind != "revisit" else None}


def records_in(f, start: int, end: int, payloads: bool = False) -> Iterator[dict]:
    """Records that begin in [start, end)."""
    at = _find(f, start, end)
    while at is not None:
        try:
            found = read_record(f, at, payloads)
        except _Torn:
            at = _find(f, at + 1, end)
            continue
        yield found
        at = _find(f, at + found["length"], end)


def _read(payloads: bool):
    types = {f.name: f.type for f in pa.schema([
        ("path", pa.string()), ("offset", pa.int64()), ("length", pa.int64()), ("type", pa.string()), ("record_id", pa.string()), ("refers_to", pa.string()),
        ("uri", pa.string()), ("date", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("payload", pa.binary())])}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, held = [], 0

        def batch_of() -> pa.RecordBatch:
            return pa.record_batch({name: pa.array([r[name] for r in rows], t) for name, t in types.items()})

        for batch in batches:
            for path, start, end in zip(*(batch.column(c).to_pylist() for c in ("path", "start", "end"))):
                fs, place = _open(path)
                with fs.open_input_file(place) as f:
                    for r in records_in(f, start, end, payloads):
                        rows.append(r | {"path": path})
                        held += len(r["payload"] or b"")
                        if len(rows) >= BATCH_ROWS or held >= BATCH_BYTES:
                            yield batch_of()
                            rows, held = [], 0
        if rows:
            yield batch_of()
    return run


def read_warc(manifest: DataFrame, split_bytes: int = SPLIT_BYTES, payloads: bool = True) -> DataFrame:
    """All records of the manifest's archives, with their places; ``payload_digest`` is a bare base32 SHA-1.

    A response's payload size and digest come from the decoded payload, a
    revisit's from its headers. Without ``payloads`` the column is null.
    """
    n = manifest.agg(F.coalesce(F.sum(F.ceil(F.col("bytes") / split_bytes)), F.lit(0)).alias("n")).first()["n"]
    cut = F.sequence(F.lit(0).cast("long"), F.col("bytes") - 1, F.lit(split_bytes).cast("long"))
    ranges = manifest.where("bytes > 0").select("path", "bytes", F.explode(cut).alias("start"))
    ranges = ranges.select("path", "start", F.least("bytes", F.col("start") + split_bytes).alias("end"))
    # A task a range, up to a number of tasks that any cluster works off evenly.
    return ranges.repartition(min(max(int(n), 1), 20_000)).mapInArrow(_read(payloads), RECORDS)


def uncovered(records: DataFrame, manifest: DataFrame) -> DataFrame:
    """(path, bytes): what of each archive no record covers; no rows if all was read."""
    read = records.groupBy("path").agg(F.sum("length").alias("covered"))
    return (manifest.join(read, "path", "left").withColumn("bytes", F.col("bytes") - F.coalesce("covered", F.lit(0)))
                    .where("bytes <> 0").select("path", "bytes"))
