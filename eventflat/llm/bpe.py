"""Byte-pair encoding and decoding.

Encoding follows a tokenizer file of the kind word_bpe: texts are normalised (NFC, white
space, lower case), split by a pattern, written in byte letters, and merged by a priority
queue of merge ranks over a doubly linked list of symbols; queue entries whose symbols have
changed since are skipped. Decoding concatenates vocabulary strings, with one space between
tokens as the file names no decoder. No match of the pattern crosses white space, so pieces
between ASCII white space are encoded once and kept in a bounded cache of the worker.

Defined results: a null or empty text, or one of white space only, has no tokens. Special
tokens written in a text become their ids. Repeated rows each get their own equal result;
any text length works, as a document is joined piece by piece; other columns pass through, but for one
named like the result.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import unicodedata
from collections.abc import Iterator

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import kept_by_worker, ship, slices, texts_of, without

#: Entries of a generation of each cache of a worker, some 300 bytes each; two are kept.
CACHE = 250_000
#: Bits of a symbol's id in the key of a pair, and of a place in a queue entry.
ID_BITS, PLACE_BITS = 20, 40
PLACE = (1 << PLACE_BITS) - 1

ENCODED = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def byte_letters() -> list[str]:
    """The printable letter of each byte: itself if printable, else the next from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    spare = iter(range(256, 512))
    return [chr(byte) if byte in plain else chr(next(spare)) for byte in range(256)]


class Pieces(dict):
    """A bounded cache: a missing key is computed by ``make``.

    A full generation becomes the older one; keys still in use come back from there.
    """

    def __init__(self, make, most: int = CACHE):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, key):
        value = self.older.get(key)
        if value is None:
            value = self.make(key)
        if len(self) >= self.most:
            self.older = dict(self)
            self.clear()
        self[key] = value
        return value


class Codec:
    """Encoder and decoder for one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        model = content["model"]
        vocab: dict[str, int] = model["vocab"]
        merges = [tuple(pair) for pair in model["merges"]]
        self.ranks = {vocab[a] << ID_BITS | vocab[b]: rank for rank, (a, b) in enumerate(merges)}
        self.made = [vocab[a + b] for a, b in merges]
        letters = byte_letters()
        self.inner = [vocab[letter] for letter in letters]
        self.last = [vocab[letter + model["end_of_word_suffix"]] for letter in letters]
        self.special = {token["content"]: token["id"] for token in content["added_tokens"]}
        self.strings = {id: text for text, id in [*vocab.items(), *self.special.items()]}
        split = content["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pattern = regex.compile(split)
        self.marks = regex.compile("(" + "|".join(map(regex.escape, self.special)) + ")")
        self.pieces = Pieces(self.merged)
        self.chunks = Pieces(self.rendered)

    def merged(self, piece: str) -> list[int]:
        """Ids of one piece of the pattern.

        A queue entry is a rank and the place of the pair's left symbol in one number. It is
        stale if the pair at that place has another rank by now.
        """
        data = piece.encode("utf-8")
        symbols = [self.inner[byte] for byte in data]
        symbols[-1] = self.last[data[-1]]
        size, ranks, made = len(symbols), self.ranks, self.made
        before, after = list(range(-1, size - 1)), list(range(1, size + 1))
        queue = []
        for left in range(size - 1):
            rank = ranks.get(symbols[left] << ID_BITS | symbols[left + 1])
            if rank is not None:
                queue.append(rank << PLACE_BITS | left)
        heapq.heapify(queue)
        while queue:
            entry = heapq.heappop(queue)
            left, rank = entry & PLACE, entry >> PLACE_BITS
            right = after[left]
            if right >= size or ranks.get(symbols[left] << ID_BITS | symbols[right]) != rank:
                continue  # stale
            symbols[left], symbols[right] = made[rank], -1
            after[left] = beyond = after[right]
            if beyond < size:
                before[beyond] = left
                rank = ranks.get(symbols[left] << ID_BITS | symbols[beyond])
                if rank is not None:
                    heapq.heappush(queue, rank << PLACE_BITS | left)
            left = before[left]
            if left >= 0:
                rank = ranks.get(symbols[left] << ID_BITS | symbols[after[left]])
                if rank is not None:
                    heapq.heappush(queue, rank << PLACE_BITS | left)
        return [symbol for symbol in symbols if symbol >= 0]

    def encode(self, text: str) -> list[int]:
        ids: list[int] = []
        for part in self.marks.split(text):
            if part in self.special:
                ids.append(self.special[part])
            elif part:
                plain = unicodedata.normalize("NFC", part)
                # Letter by letter: a capital sigma has one lower case wherever it stands.
                plain = plain.lower() if "Σ" not in plain else "".join(map(str.lower, plain))
                for piece in self.pattern.findall(plain):
                    ids += self.pieces[piece]
        return ids

    def decode(self, ids: list[int]) -> str:
        return " ".join(self.strings[id] for id in ids)

    def rendered(self, chunk: bytes) -> tuple[bytes, bytes]:
        """Ids in decimal and decoded text of a chunk without ASCII white space."""
        ids = self.encode(chunk.decode("utf-8", "replace"))
        return " ".join(map(str, ids)).encode(), self.decode(ids).encode()

    def document(self, text: bytes) -> tuple[int, str, str]:
        found = [pair for pair in map(self.chunks.__getitem__, text.split()) if pair[0]]
        ids = b" ".join([pair[0] for pair in found])
        decoded = b" ".join([pair[1] for pair in found])
        count = ids.count(b" ") + 1 if ids else 0
        return count, hashlib.sha256(ids).hexdigest(), hashlib.sha256(decoded).hexdigest()


@kept_by_worker(2)
def codec(path: str) -> Codec:
    """One codec for each worker and file."""
    return Codec(path)


def encode_decode(documents: DataFrame, path: str) -> DataFrame:
    """All rows and columns, with a struct ``bpe`` in place of any column of that name.

    ``path`` names the tokenizer file on every machine.
    """
    documents = without(documents, "bpe")
    schema = T.StructType([*documents.schema.fields, T.StructField("bpe", ENCODED)])

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(path)
        for batch in slices(batches, "text", codec):
            found = [own.document(text) for text in texts_of(batch, "text")]
            struct = pa.StructArray.from_arrays(
                [
                    pa.array([row[i] for row in found], kind)
                    for i, kind in enumerate((pa.int64(), pa.string(), pa.string()))
                ],
                names=ENCODED.fieldNames(),
            )
            columns = [batch.column(i) for i in range(batch.num_columns)]
            yield pa.RecordBatch.from_arrays([*columns, struct], names=schema.fieldNames())

    return ship(documents).mapInArrow(encode, schema)
