"""Encoding and decoding with a SentencePiece model of the merge type.

Each prefix of a text has one last token: the token its encoding ends with. An automaton
(Aho-Corasick) gives all vocabulary strings that end at a place; the last token there is the
one that fits the last token of the prefix before it, where two tokens fit if merging the
symbols of both together, best score first, leaves just the two. A pass over the text fills
the table of last tokens, a walk from its end gives the ids backwards. Tokens that merging
does not yield from their own symbols are never a result and are left out.

The model's normaliser is the identity with a space put in front of a text that is not
empty, and spaces as a mark of their own; characters without a piece become bytes. A text
falls apart between two characters that stand side by side in no piece: such parts are
encoded once and kept in a bounded cache of the worker. Models of another kind are refused.

Defined results: a null or empty text has the begin and end ids only, and decodes to an
empty text. Special pieces written in a text are plain characters. Bytes that are no UTF-8
are U+FFFD, one each where ids are decoded. Repeated rows each get their own equal result;
a text of any length works, as its parts do not grow with it and a table takes some 100
bytes a character of a part; other columns pass through, but for one named like the result.
"""

from __future__ import annotations

import codecs
import hashlib
from collections.abc import Callable, Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .bpe import Pieces
from .common import ship, slices, texts_of, without

#: The mark of a space, begin and end ids, the text of the unknown id.
SPACE, BEGIN, END, UNKNOWN = "▁", 1, 2, " ⁇ "
#: Bits of an id in the key of a pair; entries of a generation of the caches, two are kept.
ID_BITS, CACHE, PAIRS = 20, 300_000, 1_000_000
#: Characters of a part up to which it is kept.
KEPT = 64
#: Texts that show whether a model is of this kind.
PROBES = ("", " ", "  two  spaces ", "line\nline\té漢\U0001f600", "<s> ▁x " + " " * 40 + "y")

DIGESTS = T.StructType(
    [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("ids_sha256", T.StringType()),
        T.StructField("decoded_sha256", T.StringType()),
    ]
)


def each_byte(error: UnicodeError) -> tuple[str, int]:
    return "�" * (error.end - error.start), error.end


codecs.register_error("each-byte", each_byte)


class Codec:
    """Encoder and decoder for one model file."""

    def __init__(self, path: str):
        from sentencepiece import SentencePieceProcessor

        model = SentencePieceProcessor(model_file=path)
        self.surface: list[bytes | None] = []  # None: begin, end and other controls
        self.score = [model.get_score(id) for id in range(model.vocab_size())]
        self.raw = [0] * 256
        self.plain_bytes: set[int] = set()
        self.id: dict[str, int] = {}
        for id in range(model.vocab_size()):
            piece = model.id_to_piece(id)
            if model.is_byte(id):
                byte = int(piece[1:-1], 16)
                self.raw[byte] = id
                self.plain_bytes.add(id)
                self.surface.append(bytes([byte]))
            elif model.is_unknown(id):
                self.surface.append(UNKNOWN.encode())
            elif model.is_control(id):
                self.surface.append(None)
            else:
                self.id[piece] = id
                self.surface.append(piece.replace(SPACE, " ").encode())
        self.four = [id.to_bytes(4, "little") for id in range(model.vocab_size())]
        self.size = {id: len(piece) for piece, id in self.id.items()}
        self.merge = {
            self.id[piece[:cut]] << ID_BITS | self.id[piece[cut:]]: id
            for piece, id in self.id.items()
            for cut in range(1, len(piece))
            if piece[:cut] in self.id and piece[cut:] in self.id
        }
        self.symbols: dict[int, list[int]] = {}
        self.automaton = ahocorasick.Automaton()
        for piece, id in self.id.items():
            if all(letter in self.id for letter in piece):
                self.symbols[id] = [self.id[letter] for letter in piece]
                if self.merged(self.symbols[id]) == [id]:
                    self.automaton.add_word(piece, (len(piece), id))
        self.automaton.make_automaton()
        letters = sorted({letter for piece in self.id if len(piece) > 1 for letter in piece})
        self.kind = np.zeros(0x110000, dtype=np.int16)
        self.kind[[ord(letter) for letter in letters]] = np.arange(1, len(letters) + 1)
        self.joined = np.zeros((len(letters) + 1, len(letters) + 1), dtype=bool)
        for piece in self.id:
            kinds = self.kind[[ord(letter) for letter in piece]]
            self.joined[kinds[:-1], kinds[1:]] = True
        self.joined[0, :] = self.joined[:, 0] = False
        self.fit = Pieces(self.fits, PAIRS)
        self.parts = Pieces(self.part, CACHE)
        for text in PROBES:
            ids = self.encode(text.encode())
            if ids != model.encode(text, add_bos=True, add_eos=True):
                raise ValueError(f"{path} is no merge model without normalisation")
            if self.decode(ids) != model.decode(ids):
                raise ValueError(f"{path} does not decode to the text itself")

    def merged(self, symbols: list[int]) -> list[int]:
        """A few symbols merged step by step: best score first, then the leftmost pair."""
        symbols = list(symbols)
        while True:
            best, at = None, -1
            for place in range(len(symbols) - 1):
                made = self.merge.get(symbols[place] << ID_BITS | symbols[place + 1])
                if made is not None and (best is None or self.score[made] > self.score[best]):
                    best, at = made, place
            if best is None:
                return symbols
            symbols[at : at + 2] = [best]

    def fits(self, pair: int) -> bool:
        """Whether the second token of a pair can follow the first."""
        one, other = pair >> ID_BITS, pair & ((1 << ID_BITS) - 1)
        return self.merged(self.symbols[one] + self.symbols[other]) == [one, other]

    def ids_of(self, part: str) -> list[int]:
        """Ids of a part of a text, by its table of last tokens."""
        if len(part) == 1:
            id = self.id.get(part)
            return [id] if id is not None else [self.raw[byte] for byte in part.encode()]
        last = [0] * (len(part) + 1)  # 0 is the unknown id: not known yet
        fit = self.fit
        for end, (size, token) in self.automaton.iter(part):
            stop = end + 1
            if not last[stop]:
                start = stop - size
                if not start or fit[last[start] << ID_BITS | token]:
                    last[stop] = token
        found, place = [], len(part)
        while place:
            token = last[place]
            found.append(token)
            place -= self.size[token]
        return found[::-1]

    def part(self, part: str) -> tuple[bytes, bytes]:
        """Ids in four bytes each, and the decoded text of a part."""
        ids = self.ids_of(part)
        four, surface = self.four, self.surface
        return b"".join([four[id] for id in ids]), b"".join([surface[id] for id in ids])

    def documents(self, texts: list[bytes]) -> Iterator[tuple[bytes, bytes]]:
        """Ids with begin and end, and the decoded text, of each text."""
        marked = [
            (SPACE + text.decode("utf-8", "replace").replace(" ", SPACE)) if text else ""
            for text in texts
        ]
        whole = "".join(marked)
        points = np.frombuffer(whole.encode("utf-32-le"), dtype=np.uint32)
        kinds = self.kind[points]
        begins = np.ones(len(points) + 1, dtype=bool)
        begins[1:-1] = ~self.joined[kinds[:-1], kinds[1:]]
        ends = np.cumsum([len(text) for text in marked])
        begins[ends] = True
        cuts = np.flatnonzero(begins)
        places = np.searchsorted(cuts, np.concatenate([[0], ends])).tolist()
        long = bool((np.diff(cuts) > KEPT).any())
        cuts = cuts.tolist()
        parts, first, last = self.parts, self.four[BEGIN], self.four[END]
        for low, high in zip(places, places[1:], strict=False):
            spans = zip(cuts[low:high], cuts[low + 1 : high + 1], strict=True)
            if long:
                own = (whole[start:stop] for start, stop in spans)
                found = [self.part(part) if len(part) > KEPT else parts[part] for part in own]
            else:
                found = [parts[whole[start:stop]] for start, stop in spans]
            ids = b"".join([part[0] for part in found])
            # The space put in front goes; nothing else is in front of a text.
            yield first + ids + last, b"".join([part[1] for part in found])[1:]

    def encode(self, text: bytes) -> list[int]:
        ids, _ = next(self.documents([text]))
        return np.frombuffer(ids, dtype="<u4").tolist()

    def decode(self, ids: list[int]) -> str:
        found: list[str] = []
        run: list[bytes] = []
        for id in [*ids, BEGIN]:
            if id in self.plain_bytes:
                run.append(self.surface[id])
                continue
            if run:
                found.append(b"".join(run).decode("utf-8", "each-byte"))
                run = []
            if self.surface[id] is not None:
                piece = self.surface[id].decode()
                # A piece in front loses the space that encoding has put there.
                found.append(piece if found or id not in self.size else piece.removeprefix(" "))
        return "".join(found)


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec for each worker and file."""
    return Codec(path)


def with_column(
    data: DataFrame, name: str, kind: T.DataType, source: str, make: Callable
) -> DataFrame:
    """All rows and columns, with a column that ``make`` derives from each batch of slices."""
    data = without(data, name)
    schema = T.StructType([*data.schema.fields, T.StructField(name, kind)])

    def derive(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(iter([batch]), source) if source == "text" else [batch]:
                columns = [part.column(i) for i in range(part.num_columns)]
                yield pa.RecordBatch.from_arrays([*columns, make(part)], schema.fieldNames())

    return ship(data).mapInArrow(derive, schema)


def encoded(documents: DataFrame, path: str) -> DataFrame:
    """All rows and columns, with the ids of ``text``, begin and end included, as ``ids``.

    ``path`` names the model file on every machine, here and below.
    """

    def make(batch: pa.RecordBatch) -> pa.Array:
        ids = [ids for ids, _ in codec(path).documents(texts_of(batch, "text"))]
        ends = np.cumsum([0, *[len(own) // 4 for own in ids]])
        values = pa.array(np.frombuffer(b"".join(ids), dtype="<i4"))
        return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), values)

    return with_column(documents, "ids", T.ArrayType(T.IntegerType()), "text", make)


def decoded(data: DataFrame, path: str) -> DataFrame:
    """All rows and columns, with the text of ``ids`` as ``decoded``; null ids give null."""

    def make(batch: pa.RecordBatch) -> pa.Array:
        own = codec(path)
        rows = batch.column("ids").to_pylist()
        return pa.array([None if ids is None else own.decode(ids) for ids in rows], pa.string())

    return with_column(data, "decoded", T.StringType(), "ids", make)


def digests(documents: DataFrame, path: str) -> DataFrame:
    """All rows and columns, with number and digest of the ids and the decoded text's digest
    as a struct ``pieces``."""

    def make(batch: pa.RecordBatch) -> pa.Array:
        counts, ids_digests, texts = [], [], []
        for ids, text in codec(path).documents(texts_of(batch, "text")):
            counts.append(len(ids) // 4)
            ids_digests.append(hashlib.sha256(ids).hexdigest())
            texts.append(hashlib.sha256(text).hexdigest())
        arrays = [pa.array(counts, pa.int64())]
        arrays += [pa.array(ids_digests, pa.string()), pa.array(texts, pa.string())]
        return pa.StructArray.from_arrays(arrays, names=DIGESTS.fieldNames())

    return with_column(documents, "pieces", DIGESTS, "text", make)
