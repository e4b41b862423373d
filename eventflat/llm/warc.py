"""WARC archives: writing with revisit records, and a splittable reader.

Every page is a record in a gzip member of its own. Of records with equal payloads of at
least ``LEAST`` bytes the one with the smallest page id is a response; the others are
revisit records without payload that name it. The reader deals out byte ranges of the
archives that were listed when written, a task each: a task looks for the gzip magic in its range, accepts a candidate when its header
decodes as a WARC header, and owns the records that start inside the range. It decompresses
a record piece by piece, however long, and looks on behind its end.

Defined results: a null payload is an empty one. A null page id is never the response of a
group that has another id. Rows that repeat the smallest id of a group are all responses,
and where every id is null all rows are. Empty tables give no archive and no row. Extra
columns are ignored; a url is written with its control characters percent-encoded.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import new_folder, ship, slices, small, storage, stored

LEAST = 100
#: Groups of equal payloads whose digests are broadcast, some 100 bytes each.
GROUPS = 500_000
#: Bytes of archive that one reading task scans, and bytes fetched at a time.
RANGE, PIECE = 4_000_000, 1 << 18
ARCHIVE = 256_000_000
MAGIC = b"\x1f\x8b\x08"
#: A WARC header with its blank line must end within so many bytes.
HEADER = 1 << 20

RECORD = (
    "page_id long, url string, payload_bytes long, payload_digest string, "
    "record_type string, refers_to long"
)


def digested(pages: DataFrame) -> DataFrame:
    """Pages with payload, its size and digest, and the response that a revisit names."""
    rows = pages.select(
        F.col("page_id").cast("long").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string"), F.lit("")).alias("html"),
    ).withColumns({"payload_bytes": F.octet_length("html"), "digest": F.sha2("html", 256)})
    # Payloads that occur once need no look-up: only groups of copies are joined. Payloads are
    # not shuffled for it, as long as the digests of the groups are few enough to broadcast.
    groups = (
        rows.where(F.col("payload_bytes") >= LEAST)
        .groupBy("digest")
        .agg(F.count(F.lit(1)).alias("n"), F.min("page_id").alias("first"))
        .where("n > 1")
        .select("digest", "first")
    )
    groups = stored(groups, "warc-groups")
    refers = F.when(~F.col("page_id").eqNullSafe(F.col("first")), F.col("first"))
    return rows.join(small(groups, GROUPS), "digest", "left").withColumn("refers_to", refers).drop("first")


def record(row: dict) -> bytes:
    """One gzip member: header, blank line, block and the two line ends behind it."""
    revisit = row["refers_to"] is not None
    payload = b"" if revisit else row["html"]
    url = re.sub(r"[\x00-\x20\x7f-\x9f]", lambda m: "".join(f"%{b:02X}" for b in m[0].encode()), row["url"] or "")
    page = "" if row["page_id"] is None else row["page_id"]
    lines = [
        "WARC/1.1",
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: <urn:page:{page}>",
        "WARC-Date: 1970-01-01T00:00:00Z",
        f"WARC-Payload-Digest: sha256:{row['digest']}",
        f"X-Payload-Length: {row['payload_bytes']}",
        f"Content-Length: {len(payload)}",
    ]
    if row["url"] is not None:
        lines.insert(4, f"WARC-Target-URI: {url}")
    if revisit:
        lines.insert(4, f"WARC-Refers-To: <urn:page:{row['refers_to']}>")
        lines.insert(4, "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    head = ("\r\n".join(lines) + "\r\n\r\n").encode()
    return packer.compress(head) + packer.compress(payload) + packer.compress(b"\r\n\r\n") + packer.flush()


def write_archives(pages: DataFrame, folder: str) -> None:
    """Write one or more ``*.warc.gz`` for each task, and their list into ``written``.

    Names hold the task's attempt: what a lost attempt has left is not on the list.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = storage(folder)
        task = TaskContext.get()
        stream, name, size, done = None, "", 0, []

        def finish() -> None:
            nonlocal stream, size
            stream.close()
            done.append((name, size))
            stream, size = None, 0

        for batch in slices(batches, "html"):
            columns = batch.to_pydict()
            for at in range(batch.num_rows):
                row = {name: values[at] for name, values in columns.items()}
                row["html"] = row["html"].encode("utf-8")
                if stream is None:
                    system.create_dir(base, recursive=True)
                    attempt = f"{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
                    name = f"pages-{attempt}-{len(done):04d}.warc.gz"
                    stream = system.open_output_stream(f"{base}/{name}", compression=None)
                packed = record(row)
                stream.write(packed)
                size += len(packed)
                if size >= ARCHIVE:
                    finish()
        if stream is not None:
            finish()
        names, sizes = [name for name, _ in done], [size for _, size in done]
        yield pa.RecordBatch.from_arrays(
            [pa.array(names, pa.string()), pa.array(sizes, pa.int64())], names=["file", "length"]
        )

    rows = ship(digested(pages)).mapInArrow(write, "file string, length long")
    rows.write.parquet(f"{folder}/written")


class Pieces:
    """A file read front to back in pieces, with some bytes kept."""

    def __init__(self, file, start: int):
        self.file, self.size = file, file.size()
        self.start, self.held = start, b""

    def at(self, position: int, size: int) -> bytes:
        """Up to ``size`` bytes from ``position`` on."""
        if position < self.start or position > self.start + len(self.held):
            self.start, self.held = position, b""
        if position - self.start > 4 * PIECE:
            self.held = self.held[position - self.start :]
            self.start = position
        while self.start + len(self.held) < min(position + size, self.size):
            self.file.seek(self.start + len(self.held))
            self.held += self.file.read(max(PIECE, position + size - self.start - len(self.held)))
        return self.held[position - self.start : position - self.start + size]

    def find(self, position: int, stop: int) -> int:
        """Next gzip magic that starts in [position, stop); -1 if there is none."""
        while position < stop:
            part = self.at(position, min(PIECE, stop - position + len(MAGIC) - 1))
            if len(part) < len(MAGIC):
                return -1
            found = part.find(MAGIC)
            if found >= 0:
                return position + found if position + found < stop else -1
            position += len(part) - len(MAGIC) + 1
        return -1


def member(window: Pieces, position: int) -> tuple[dict, int] | None:
    """The record of the gzip member at ``position`` and the member's end; None if it is none.

    A member that is cut short or fails its checksum after a good WARC header is an error.
    """
    unpacker = zlib.decompressobj(31)
    head, fields, digest, length, left = b"", None, hashlib.sha256(), 0, 0
    at = position
    while not unpacker.eof:
        part = window.at(at, PIECE)
        if not part:
            if fields is None:
                return None
            raise ValueError(f"archive ends inside the record at {position}")
        try:
            content = unpacker.decompress(part, PIECE * 16)
            while unpacker.unconsumed_tail and fields is not None:
                left = take(content, left, digest)
                content = unpacker.decompress(unpacker.unconsumed_tail, PIECE * 16)
        except zlib.error:
            if fields is None:
                return None
            raise
        at += len(part)
        if fields is None:
            head += content
            if not head.startswith(b"WARC/1."[: len(head)]):
                return None
            cut = head.find(b"\r\n\r\n")
            if cut < 0:
                if len(head) > HEADER or unpacker.eof:
                    return None
                at -= len(unpacker.unconsumed_tail)
                continue
            lines = head[:cut].decode("utf-8", "replace").split("\r\n")[1:]
            fields = {k.strip().lower(): v.strip() for k, _, v in (line.partition(":") for line in lines)}
            if not fields.get("content-length", "").isdigit() or "warc-type" not in fields:
                return None
            length = left = int(fields["content-length"])
            content = head[cut + 4 :]
            while True:
                left = take(content, left, digest)
                if not unpacker.unconsumed_tail:
                    break
                content = unpacker.decompress(unpacker.unconsumed_tail, PIECE * 16)
        else:
            left = take(content, left, digest)
    if left:
        raise ValueError(f"record at {position} is shorter than its header says")
    fields["_length"], fields["_digest"] = length, digest.hexdigest()
    return fields, at - len(unpacker.unused_data)


def take(content: bytes, left: int, digest) -> int:
    digest.update(content[:left])
    return max(0, left - len(content))


def page_number(text: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", text or "")
    return int(found[1]) if found else None


def as_row(fields: dict) -> dict:
    """A record as a row; a response's digest must match its payload."""
    kind = fields["warc-type"]
    stated = fields.get("warc-payload-digest", "").removeprefix("sha256:")
    if kind != "revisit" and stated != fields["_digest"]:
        raise ValueError(f"payload of {fields.get('warc-record-id')} does not match its digest")
    size = int(fields["x-payload-length"]) if kind == "revisit" else fields["_length"]
    return {
        "page_id": page_number(fields.get("warc-record-id")),
        "url": fields.get("warc-target-uri"),
        "payload_bytes": size,
        "payload_digest": stated,
        "record_type": kind,
        "refers_to": page_number(fields.get("warc-refers-to")),
    }


def records_in(file, start: int, stop: int) -> Iterator[dict]:
    """Records whose gzip member starts in [start, stop)."""
    window, position = Pieces(file, start), start
    while (position := window.find(position, stop)) >= 0:
        found = member(window, position)
        if found is None:
            position += 1
        else:
            fields, position = found
            yield as_row(fields)


def read_archives(spark, folder: str, span: int = RANGE) -> DataFrame:
    """One row per record of the archives that the list in ``folder`` names."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = storage(folder)
        for batch in batches:
            for row in batch.to_pylist():
                held = []
                with system.open_input_file(f"{base}/{row['file']}") as file:
                    for found in records_in(file, row["start"], min(row["start"] + span, row["length"])):
                        held.append(found)
                        if len(held) >= 5_000:
                            yield pa.RecordBatch.from_pylist(held, schema=SCHEMA)
                            held = []
                yield pa.RecordBatch.from_pylist(held, schema=SCHEMA)

    listed = spark.read.parquet(f"{folder}/written").where("length > 0")
    starts = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(span).cast("long"))
    ranges = listed.select("file", "length", F.explode(starts).alias("start"))
    # A number of partitions that adaptive execution leaves alone: rows of ranges are tiny, the
    # work behind them is not.
    return ship(ranges).repartition(max(1, ranges.count())).mapInArrow(read, RECORD)


SCHEMA = pa.schema(
    [
        ("page_id", pa.int64()),
        ("url", pa.string()),
        ("payload_bytes", pa.int64()),
        ("payload_digest", pa.string()),
        ("record_type", pa.string()),
        ("refers_to", pa.int64()),
    ]
)


def archive_and_read(pages: DataFrame) -> DataFrame:
    """Write all pages as archives in the shared folder and read the records back."""
    folder = new_folder(pages.sparkSession, "warc")
    write_archives(pages, folder)
    return read_archives(pages.sparkSession, folder)
