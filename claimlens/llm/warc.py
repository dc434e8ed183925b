"""WARC archives written and read back as chunk rows: no payload is ever held whole by a task's Python."""

from __future__ import annotations

import hashlib
import uuid
import zlib

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm.common import row_numbers, written
from claimlens.session import new_dir

CHUNK_BYTES = 1 << 16
ARCHIVE_BYTES = 256 << 20
MIN_REVISIT_BYTES = 0
#: The digits of RFC 4648 base32.
BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"
DATE = "2000-01-01T00:00:00Z"


def base32(hex_digest):
    """A SHA-1 digest in hexadecimal as 32 base32 digits, by arithmetic on its ten-digit fifths."""
    digits = []
    for fifth in range(4):
        number = F.conv(F.substring(hex_digest, 10 * fifth + 1, 10), 16, 10).cast("long")
        for place in range(7, -1, -1):
            digits.append(F.substring(F.lit(BASE32), (F.shiftright(number, 5 * place) % 32 + 1).cast("int"), F.lit(1)))
    return F.concat(*digits)


def chunk_table(records: DataFrame, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(row, record_id, url, chunk, last, so_far, sha1, data) of ``records`` (record_id, url, payload), written.

    One row a chunk; ``so_far`` counts the payload's bytes up to and with it, and the last chunk of a record carries the payload's
    SHA-1, taken chunk by chunk. An empty payload has one empty chunk. ``row`` numbers the records. The chunks of a
    record follow each other in its partition: no shuffle lies between.
    """
    last = F.greatest(F.lit(1), F.ceil(F.octet_length("payload") / F.lit(chunk_bytes))).cast("int") - 1
    numbered = records.select("record_id", "url", "payload", last.alias("end"), F.explode(F.sequence(F.lit(0), last)).alias("chunk"))
    data = F.substring(F.col("payload"), F.col("chunk") * chunk_bytes + 1, F.lit(chunk_bytes))
    pieces = numbered.select("record_id", "url", "chunk", (F.col("chunk") == F.col("end")).alias("last"), data.alias("data"))

    def run(batches):
        numbers = row_numbers()
        row = sha1 = None
        size = 0
        for batch in batches:
            rows, sizes, digests = [], [], []
            piece = batch.column(4)
            for i, (chunk, end) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                if chunk == 0:
                    row, sha1, size = next(numbers), hashlib.sha1(), 0
                part = piece[i].as_buffer()
                sha1.update(part)
                size += part.size
                rows.append(row)
                sizes.append(size)
                digests.append(sha1.hexdigest() if end else None)
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows, pa.int64()), *batch.columns[:4], pa.array(sizes, pa.int64()), pa.array(digests, pa.string()), piece],
                names=["row", "record_id", "url", "chunk", "last", "so_far", "sha1", "data"],
            )

    ddl = "row long, record_id long, url string, chunk int, last boolean, so_far long, sha1 string, data binary"
    return written(pieces.mapInArrow(run, ddl), "warc-chunks")


def record_types(chunks: DataFrame, min_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """(row, digest_text, bytes, record_type, refers_to) of the records of a chunk table.

    Of records with equal payloads of at least ``min_bytes`` bytes, that with the smallest id is the response and the others
    revisit it. Only last chunks are read, without their data; smallest ids are aggregated before the shuffle, so
    a payload shared by a third of the records costs one row a task.
    """
    ends = chunks.where("last").select("row", "record_id", "sha1", F.col("so_far").alias("bytes"))
    first = ends.groupBy("sha1").agg(F.min("record_id").alias("first"))
    revisit = (F.col("bytes") >= min_bytes) & ~F.col("record_id").eqNullSafe(F.col("first"))
    return ends.join(first, "sha1").select(
        "row",
        base32(F.col("sha1")).alias("digest_text"),
        "bytes",
        F.when(revisit, "revisit").otherwise("response").alias("record_type"),
        F.when(revisit, F.col("first")).alias("refers_to"),
    )


def _header(kind, number, url, digest, size, refers, row) -> bytes:
    lines = [
        "WARC/1.1",
        f"WARC-Type: {kind}",
        f"WARC-Record-ID: <urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{number}/{digest}/{row}')}>",
        f"WARC-Date: {DATE}",
        f"WARC-Payload-Digest: sha1:{digest}",
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {size}",
    ]
    if url is not None:
        lines.append("WARC-Target-URI: " + url.replace("\r", "%0D").replace("\n", "%0A"))
    if number is not None:
        lines.append(f"X-Record-Number: {number}")
    if kind == "revisit":
        lines.append("WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
        lines.append(f"X-Refers-To-Number: {refers}")
    return "\r\n".join(lines).encode() + b"\r\n\r\n"


def write_archives(chunks: DataFrame, types: DataFrame, folder: str, archive_bytes: int = ARCHIVE_BYTES) -> DataFrame:
    """Writes the records of a chunk table, with their ``types``, below ``folder``.

    Returns the manifest (path, n_records), written: only archives of tasks that ended well are in it, so what an
    executor left behind when it was lost is never read. Every record is a gzip member of its own; chunks are
    compressed as they come. Chunks are shuffled by record, so a payload is never one row; of a revisit only the first
    chunk goes on, without data.
    """
    parts = int(chunks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    known = chunks.select("row", "record_id", "url", "chunk", "last", "data").repartition(parts, "row").join(types, "row")
    response = F.col("record_type") == "response"
    ordered = (
        known.where(response | (F.col("chunk") == 0))
        .select(
            "record_id", "url", "digest_text", "bytes", "record_type", "refers_to", "row", "chunk",
            (F.col("last") | ~response).alias("last"), F.when(response, F.col("data")).otherwise(F.lit(b"")).alias("data"),
        )
        .sortWithinPartitions("row", "chunk")
    )

    def run(batches):
        where, base = fs.FileSystem.from_uri(folder if "://" in folder or ":/" in folder else f"file://{folder}")
        where.create_dir(base)
        out = path = gzip = None
        size = count = 0
        done = []
        for batch in batches:
            cols = [batch.column(k).to_pylist() for k in range(9)]
            for i, (number, url, digest, bytes_, kind, refers, row, chunk, last) in enumerate(zip(*cols)):
                if chunk == 0:
                    if out is not None and size > archive_bytes:
                        out.close()
                        done.append((path, count))
                        out = None
                    if out is None:
                        path, size, count = f"{base}/{uuid.uuid4().hex}.warc.gz", 0, 0
                        out = where.open_output_stream(path, compression=None)
                    gzip = zlib.compressobj(3, wbits=31)
                    size += out.write(gzip.compress(_header(kind, number, url, digest, 0 if kind == "revisit" else bytes_, refers, row)))
                size += out.write(gzip.compress(batch.column(9)[i].as_buffer()))
                if last:
                    size += out.write(gzip.compress(b"\r\n\r\n") + gzip.flush())
                    count += 1
        if out is not None:
            out.close()
            done.append((path, count))
        yield pa.RecordBatch.from_pydict({"path": [p for p, _ in done], "n_records": pa.array([n for _, n in done], pa.int64())}, schema=kind_)

    kind_ = pa.schema([("path", pa.string()), ("n_records", pa.int64())])
    return written(ordered.mapInArrow(run, "path string, n_records long"), "warc-manifest")


def _fields(head: bytes) -> dict:
    lines = head.decode("utf-8").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError(f"no WARC record: {lines[0][:40]!r}")
    return dict(line.split(": ", 1) for line in lines[1:] if line)


def _pieces(stream, step: int):
    """What the gzip members of a file hold, in pieces of at most ``step`` bytes."""
    gunzip, rest = zlib.decompressobj(wbits=31), b""
    while True:
        data = rest or bytes(stream.read(step))
        if not data:
            return
        piece = gunzip.decompress(data, step)
        rest = gunzip.unconsumed_tail
        if gunzip.eof:
            rest, gunzip = gunzip.unused_data, zlib.decompressobj(wbits=31)
        if piece:
            yield piece


def records_in(stream, chunk_bytes: int = CHUNK_BYTES):
    """(fields, chunk number, data, sha1 so far, last) for each chunk of each record of an archive, front to back."""
    pieces, held = _pieces(stream, chunk_bytes), b""
    while True:
        while b"\r\n\r\n" not in held:
            more = next(pieces, None)
            if more is None:
                if held.strip():
                    raise ValueError("a record breaks off")
                return
            held += more
        head, _, held = held.partition(b"\r\n\r\n")
        fields = _fields(head)
        left, chunk, sha1 = int(fields["Content-Length"]), 0, hashlib.sha1()
        while True:
            while len(held) < min(left, chunk_bytes):
                more = next(pieces, None)
                if more is None:
                    raise ValueError("a payload breaks off")
                held += more
            data, held = held[: min(left, chunk_bytes)], held[min(left, chunk_bytes) :]
            sha1.update(data)
            left -= len(data)
            yield fields, chunk, data, sha1.hexdigest(), not left
            chunk += 1
            if not left:
                break
        while len(held) < 4:
            held += next(pieces)
        if held[:4] != b"\r\n\r\n":
            raise ValueError("a record is longer than it says")
        held = held[4:]


def read_archives(spark: SparkSession, manifest: DataFrame, folder: str, data: bool = True, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """One row a chunk: archive, record, record_id, url, record_type, refers_to, digest_text, chunk, last, so_far, sha1, data.

    ``so_far`` and ``sha1`` are the bytes and the digest of the payload up to and with this chunk. Without ``data`` only the
    last chunk of each record is given, and no payload. A record that is not as long as it says raises an error.
    """
    kind = pa.schema(
        [
            ("archive", pa.string()),
            ("record", pa.int64()),
            ("record_id", pa.int64()),
            ("url", pa.string()),
            ("record_type", pa.string()),
            ("refers_to", pa.int64()),
            ("digest_text", pa.string()),
            ("chunk", pa.int64()),
            ("last", pa.bool_()),
            ("so_far", pa.int64()),
            ("sha1", pa.string()),
            ("data", pa.binary()),
        ]
    )

    def run(batches):
        where, _ = fs.FileSystem.from_uri(folder if "://" in folder or ":/" in folder else f"file://{folder}")
        for batch in batches:
            for path in batch.column(0).to_pylist():
                rows, held, record = [], 0, -1
                with where.open_input_stream(path, compression=None) as stream:
                    for fields, chunk, piece, sha1, last in records_in(stream, chunk_bytes):
                        if chunk == 0:
                            record, so_far = record + 1, 0
                        so_far += len(piece)
                        if not data and not last:
                            continue
                        number, refers = fields.get("X-Record-Number"), fields.get("X-Refers-To-Number")
                        rows.append(
                            (
                                path,
                                record,
                                None if number is None else int(number),
                                fields.get("WARC-Target-URI"),
                                fields["WARC-Type"],
                                None if refers in (None, "None") else int(refers),
                                fields["WARC-Payload-Digest"].removeprefix("sha1:"),
                                chunk,
                                last,
                                so_far,
                                sha1,
                                piece if data else None,
                            )
                        )
                        held += len(piece) if data else 0
                        if len(rows) >= 4096 or held >= 16 << 20:
                            yield pa.RecordBatch.from_pydict(dict(zip(kind.names, zip(*rows))), schema=kind)
                            rows, held = [], 0
                if rows:
                    yield pa.RecordBatch.from_pydict(dict(zip(kind.names, zip(*rows))), schema=kind)

    files = manifest.select("path")
    n = max(1, manifest.count())
    ddl = (
        "archive string, record long, record_id long, url string, record_type string, refers_to long, digest_text string, "
        "chunk long, last boolean, so_far long, sha1 string, data binary"
    )
    return files.repartition(n, "path").mapInArrow(run, ddl)


def archive_pages(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html") -> tuple[DataFrame, str]:
    """Writes a record a row of ``pages`` and returns (manifest, folder) for ``read_archives``.

    The payload is the column in UTF-8, null counting as empty. A null id comes after all others and has no number in
    the archive; a revisit of a record without id refers to none. Of repeated rows with the smallest id of a payload
    each is a response. Very long payloads go as chunks; other columns play no part, whatever they are called. Line ends in an address are written percent-coded. An empty table gives no archive.
    """
    spark = pages.sparkSession
    records = pages.select(
        F.col(id_col).cast("long").alias("record_id"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("binary"), F.lit(b"")).alias("payload"),
    )
    folder = new_dir(spark, "warc")
    chunks = chunk_table(records)
    return write_archives(chunks, record_types(chunks), folder), folder


def archived(spark: SparkSession, manifest: DataFrame, folder: str) -> DataFrame:
    """(record_id, payload_bytes, payload_digest, record_type, refers_to) of every record, from the archives alone.

    A response's length and digest are those of the bytes read back; a revisit has the digest of its header and the length
    of the response with that digest.
    """
    seen = written(read_archives(spark, manifest, folder, data=False).where("last"), "warc-read")
    digest = F.when(F.col("record_type") == "response", base32(F.col("sha1"))).otherwise(F.col("digest_text"))
    rows = seen.select("record_id", "record_type", "refers_to", "so_far", digest.alias("payload_digest"))
    lengths = rows.where("record_type = 'response'").groupBy("payload_digest").agg(F.max("so_far").alias("full"))
    return rows.join(lengths, "payload_digest", "left").select(
        "record_id", F.coalesce("full", "so_far").alias("payload_bytes"), "payload_digest", "record_type", "refers_to"
    )
