"""Token ids in seekable zstandard files.

A file holds one independent zstandard frame per document (ids as little-endian unsigned
32-bit integers), then a frame with the directory (document ids), then a seek table in a
skippable frame: compressed size, size and checksum (low half of XXH64) of each frame, the
number of frames, a descriptor and a magic number, as the public seekable format lays down.
A reader fetches the table and the directory and decompresses the documents it wants only:
``read_documents`` takes ids, opens the files that can hold them and no other frames.

Files go to the shared folder, in ascending ``doc_id`` order over all files. Names hold the
task's attempt and the manifest lists them, so a repeated task does no harm.

Defined results: a null text is an empty document, of the end id only. Null ids come first;
rows that repeat an id are documents of their own, in an order settled by their texts. An
empty table gives no file and no row. Extra columns are ignored.
"""

from __future__ import annotations

import gc
import json
import os
import struct
import unicodedata
import uuid
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .bpe import byte_letters
from .common import cut, new_folder, ship, slices, storage, texts_of

# Fixed values of the seekable format.
SKIPPABLE, SEEKABLE, CHECKSUMS = 0x184D2A5E, 0x8F92EAB1, 0x80
FOOTER = struct.Struct("<IBI")
ENTRY = np.dtype([("packed", "<u4"), ("size", "<u4"), ("checksum", "<u4")])

#: Pieces of a generation of a worker's cache, some 150 bytes each; two are kept.
CACHE = 300_000
#: Documents that one reading task fetches at a time, and bytes of ids that it reads.
READ_FRAMES, READ_BYTES = 2_000, 32_000_000


class Encoder:
    """The tokenizers library behind a cache of the pieces that its own pattern gives.

    No match of the pattern crosses white space. Each distinct chunk between ASCII white space
    is normalised and split as the file says, and special tokens are set apart. Each distinct
    piece goes through the library's model once.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        self.library = Tokenizer.from_file(path)
        special = {token["content"]: token["id"] for token in content["added_tokens"]}
        ids = [*content["model"]["vocab"].values(), *special.values()]
        self.four = [struct.pack("<I", id) for id in range(max(ids) + 1)]
        self.letters = dict(enumerate(byte_letters()))
        self.special = {text: struct.pack("<I", id) for text, id in special.items()}
        self.marks = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")
        self.pattern = regex.compile(content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"])
        #: Two generations each, of pieces and of chunks between white space.
        self.known: list[dict[str, bytes]] = [{}, {}]
        self.chunks: list[dict[bytes, bytes]] = [{}, {}]

    def pieces(self, text: str) -> list[str]:
        plain = unicodedata.normalize("NFC", text)
        # Letter by letter: a capital sigma has one lower case wherever it stands.
        plain = plain.lower() if "Σ" not in plain else "".join(map(str.lower, plain))
        return self.pattern.findall(plain)

    def learn(self, pieces: list[str]) -> None:
        """Ids of pieces, written in byte letters as the file's pre-tokenizer does."""
        known, four, tokenize = self.known[0], self.four, self.library.model.tokenize
        for piece in pieces:
            letters = piece.encode().decode("latin-1").translate(self.letters)
            known[piece] = b"".join([four[token.id] for token in tokenize(letters)])

    def parts(self, chunk: bytes) -> list[str]:
        """Pieces and special tokens of a chunk without ASCII white space, in order."""
        plain = chunk.decode("utf-8", "replace")
        if "<|" not in plain:
            return self.pieces(plain)
        split = self.marks.split(plain)
        return [x for part in split for x in ([part] if part in self.special else self.pieces(part))]

    def ids(self, texts: list[bytes]) -> Iterator[bytes]:
        # Nothing here refers to itself: the collector would only walk through the caches.
        collecting = gc.isenabled()
        gc.disable()
        try:
            yield from self.joined(texts)
        finally:
            if collecting:
                gc.enable()

    def joined(self, texts: list[bytes]) -> Iterator[bytes]:
        split = [text.split() for text in texts]
        new = renewed(self.chunks, {chunk for chunks in split for chunk in chunks})
        if new:
            parts = [self.parts(chunk) for chunk in new]
            missing = renewed(self.known, {piece for pieces in parts for piece in pieces})
            self.known[0].update({p: self.special[p] for p in missing if p in self.special})
            missing = [piece for piece in missing if piece not in self.special]
            self.learn(missing)
            known = self.known[0]
            for chunk, pieces in zip(new, parts):
                self.chunks[0][chunk] = b"".join([known[piece] for piece in pieces])
        held = self.chunks[0]
        for chunks in split:
            yield b"".join([held[chunk] for chunk in chunks])


def renewed(cache: list[dict], wanted: set) -> list:
    """The wanted keys that a cache of two generations lacks; the others are in the first."""
    if len(cache[0]) > CACHE:
        cache[:] = [{}, cache[0]]
    first, older = cache
    missing = []
    for key in wanted:
        if key not in first:
            found = older.get(key)
            if found is None:
                missing.append(key)
            else:
                first[key] = found
    return missing


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder for each worker and file."""
    return Encoder(path)


def encoded(texts: list[bytes], path: str, end_id: int) -> Iterator[bytes]:
    """Ids of each text with the end id, by the tokenizers library."""
    end = struct.pack("<I", end_id)
    for ids in encoder(path).ids(texts):
        yield ids + end


class FrameWriter:
    """Appends frames to an open file; ``close`` adds directory and seek table."""

    def __init__(self, file):
        self.file = file
        self.packer = zstandard.ZstdCompressor(level=3, write_content_size=True)
        self.entries: list[tuple[int, int, int]] = []
        self.ids: list[int | None] = []

    def add(self, content: bytes) -> None:
        if len(content) >= 1 << 32:
            raise ValueError("a frame of the seek table holds less than 4 GiB")
        packed = self.packer.compress(content)
        self.file.write(packed)
        checksum = xxhash.xxh64_intdigest(content) & 0xFFFFFFFF
        self.entries.append((len(packed), len(content), checksum))

    def document(self, doc_id: int | None, ids: bytes) -> None:
        self.ids.append(doc_id)
        self.add(ids)

    def close(self) -> None:
        known = np.array([id is not None for id in self.ids], dtype=np.uint8)
        ids = np.array([id or 0 for id in self.ids], dtype="<i8")
        self.add(ids.tobytes() + known.tobytes())
        table = np.array(self.entries, dtype=ENTRY).tobytes()
        table += FOOTER.pack(len(self.entries), CHECKSUMS, SEEKABLE)
        self.file.write(struct.pack("<II", SKIPPABLE, len(table)) + table)


class FrameReader:
    """Reads the table and the directory of an open file, then the frames asked for."""

    def __init__(self, file):
        self.file, self.unpacker = file, zstandard.ZstdDecompressor()
        size = file.size()
        count, flags, magic = FOOTER.unpack(self._at(size - FOOTER.size, FOOTER.size))
        if magic != SEEKABLE or flags != CHECKSUMS:
            raise ValueError("no seek table with checksums at the end of the file")
        width = count * ENTRY.itemsize
        self.entries = np.frombuffer(self._at(size - FOOTER.size - width, width), dtype=ENTRY)
        self.starts = np.concatenate([[0], np.cumsum(self.entries["packed"], dtype=np.int64)])
        directory = self.frame(count - 1)
        total = count - 1
        self.ids = np.frombuffer(directory[: 8 * total], dtype="<i8")
        self.known = np.frombuffer(directory[8 * total :], dtype=np.uint8)
        self.before = np.concatenate([[0], np.cumsum(self.entries["size"][:total], dtype=np.int64)])

    def _at(self, start: int, size: int) -> bytes:
        self.file.seek(int(start))
        return self.file.read(int(size))

    def frame(self, place: int) -> bytes:
        """One frame, decompressed and checked."""
        packed, size, checksum = (int(value) for value in self.entries[place])
        content = self.unpacker.decompress(self._at(self.starts[place], packed))
        if len(content) != size or xxhash.xxh64_intdigest(content) & 0xFFFFFFFF != checksum:
            raise ValueError(f"frame {place} does not match its checksum")
        return content


def write_frames(documents: DataFrame, path: str, folder: str, end_id: int = 2) -> DataFrame:
    """Write the files into ``folder`` and return their manifest, one row per file.

    Columns file, first and last id, documents, tokens (of the file) and start (tokens of all
    earlier files).
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = storage(folder)
        task = TaskContext.get()
        name = f"tokens-{task.partitionId():06d}-{task.taskAttemptId()}-{uuid.uuid4().hex[:8]}.zst"
        writer, stream = None, None
        for batch in slices(batches, "text"):
            ids = batch.column("doc_id").to_pylist()
            for doc_id, content in zip(ids, encoded(texts_of(batch, "text"), path, end_id)):
                if writer is None:
                    system.create_dir(base, recursive=True)
                    stream = system.open_output_stream(f"{base}/{name}", compression=None)
                    writer = FrameWriter(stream)
                writer.document(doc_id, content)
        if writer is None:
            return
        writer.close()
        stream.close()
        tokens = sum(size for _, size, _ in writer.entries[:-1]) // 4
        yield pa.RecordBatch.from_pydict(
            {
                "file": [name],
                "first": pa.array([writer.ids[0]], pa.int64()),
                "last": pa.array([writer.ids[-1]], pa.int64()),
                "documents": pa.array([len(writer.ids)], pa.int64()),
                "tokens": pa.array([tokens], pa.int64()),
            }
        )

    ordered = (
        ship(documents)
        .select(F.col("doc_id").cast("long").alias("doc_id"), "text")
        # The text's hash splits an id that very many rows share.
        .repartitionByRange("doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
    )
    schema = "file string, first long, last long, documents long, tokens long"
    written = ordered.mapInArrow(write, schema)
    manifest = f"{folder}/manifest"
    written.write.parquet(manifest)
    # One row per file: the window is over files, not documents. Their names are in order.
    earlier = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    return documents.sparkSession.read.parquet(manifest).select(
        "file", "first", "last", "documents", "tokens", F.coalesce(F.sum("tokens").over(earlier), F.lit(0)).alias("start")
    )


READ = "doc_id long, start long, n_tokens long, ids binary, ids_crc32 long"


def read_places(reader: FrameReader, places: Iterator[int], start: int) -> Iterator[pa.RecordBatch]:
    """Rows of the documents at these places of a file, a batch of bounded size at a time."""
    held, at, size = [], [], 0

    def batch() -> pa.RecordBatch:
        own = np.array(at)
        return pa.RecordBatch.from_pydict(
            {
                "doc_id": pa.array(reader.ids[own], mask=reader.known[own] == 0),
                "start": pa.array(start + reader.before[own] // 4),
                "n_tokens": pa.array([len(x) // 4 for x in held], pa.int64()),
                "ids": pa.array(held, pa.binary()),
                "ids_crc32": pa.array([zlib.crc32(x) for x in held], pa.int64()),
            }
        )

    for place in places:
        at.append(place)
        held.append(reader.frame(place))
        size += len(held[-1])
        if size > 8_000_000 or len(at) >= READ_FRAMES:
            yield batch()
            held, at, size = [], [], 0
    if at:
        yield batch()


def read_frames(manifest: DataFrame, folder: str) -> DataFrame:
    """Rows (doc_id, start, n_tokens, ids, ids_crc32) of all documents in a manifest's files."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = storage(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with system.open_input_file(f"{base}/{row['file']}") as file:
                    reader = FrameReader(file)
                    stop = min(row["frame"] + READ_FRAMES, len(reader.ids))
                    yield from read_places(reader, range(row["frame"], stop), row["start"])

    parts = manifest.select(
        "file", "start", F.explode(F.sequence(F.lit(0), F.col("documents") - 1, F.lit(READ_FRAMES))).alias("frame")
    )
    # A number of partitions that adaptive execution leaves alone: the rows are tiny, the work
    # behind them is not.
    size = manifest.agg(F.sum("tokens")).first()[0] or 0
    return ship(parts).repartition(1 + 4 * size // READ_BYTES).mapInArrow(read, READ)


def read_documents(manifest: DataFrame, folder: str, wanted: DataFrame) -> DataFrame:
    """Rows as ``read_frames`` gives them, of the documents whose id is in ``wanted.doc_id``.

    Only files whose range of ids holds a wanted one are opened, and of them only the table,
    the directory and the frames of these documents are read. An id that no file holds gives
    no row, one that several documents share all of theirs; a null id asks for null ids.
    """
    files = manifest.select("file", "first", "last", "start").orderBy("file").collect()  # a row per file
    lows = np.array([-(1 << 63) if f["first"] is None else f["first"] for f in files], np.int64)
    highs = np.array([-(1 << 63) if f["last"] is None else f["last"] for f in files], np.int64)
    nulls = np.array([f["first"] is None for f in files], bool)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            number, asked = [], []
            for doc_id in batch.column("doc_id").to_pylist():
                if doc_id is None:
                    own = np.flatnonzero(nulls).tolist()
                else:
                    own = range(np.searchsorted(highs, doc_id), np.searchsorted(lows, doc_id, "right"))
                number += own
                asked += [doc_id] * len(own)
            yield pa.RecordBatch.from_arrays(
                [pa.array(number, pa.int64()), pa.array(asked, pa.int64())], names=["number", "doc_id"]
            )

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = storage(folder)
        for batch in batches:
            numbers = batch.column("number").to_numpy()
            for number in np.unique(numbers):  # sorted: the rows of a file stand together
                ids = batch.column("doc_id").filter(pa.array(numbers == number))
                row = files[number]
                with system.open_input_file(f"{base}/{row['file']}") as file:
                    reader = FrameReader(file)
                    plain = np.isin(reader.ids, ids.drop_null().to_numpy()) & (reader.known > 0)
                    if ids.null_count:
                        plain |= reader.known == 0
                    yield from read_places(reader, np.flatnonzero(plain).tolist(), row["start"])

    asked = ship(wanted).select(F.col("doc_id").cast("long").alias("doc_id")).distinct()
    located = cut(asked.mapInArrow(locate, "number long, doc_id long"))
    spread = located.repartition(1 + located.count() // READ_FRAMES, "number")
    return spread.sortWithinPartitions("number").mapInArrow(read, READ)


def frames(documents: DataFrame, path: str, end_id: int = 2) -> DataFrame:
    """Write all documents, then read every one back from the files."""
    folder = new_folder(documents.sparkSession, "tokens")
    return read_frames(write_frames(documents, path, folder, end_id), folder)
