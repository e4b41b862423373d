"""Readers: tasks by size, lists instead of folders, and frames of wanted documents only."""

from __future__ import annotations

import random
import shutil

import pytest

from eventflat.llm import queries, token_frames, warc

SCHEMA = "doc_id long, text string"


@pytest.fixture(scope="module")
def library():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(queries.tokenizer_path())


def test_pieces_match_the_library(library):
    draw = random.Random(1)
    parts = [
        *"abehinorst.,!?-'\"", "the", "'s", "'ll", "THE", "É", "é", "é", "Σ", "σς", "İ", "1", "23", " ", "\n", "\t",
        " ", "　", "漢字", "😀", "<|endoftext|>", "<|startoftext|>", "<|", "|>", "ǅ", "\x00", "​", "ﬁ",
    ]
    texts = ["".join(draw.choices(parts, k=draw.randint(0, 30))) for _ in range(3000)]
    own = token_frames.Encoder(queries.tokenizer_path())
    for text, ids in zip(texts, own.ids([t.encode() for t in texts]), strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert [int.from_bytes(ids[i : i + 4], "little") for i in range(0, len(ids), 4)] == want, text


def test_cache_of_two_generations(library, monkeypatch):
    monkeypatch.setattr(token_frames, "CACHE", 5)
    own = token_frames.Encoder(queries.tokenizer_path())
    for text in ["one two three", "four five six seven", "one eight nine", "two ten", "one two"] * 3:
        (ids,) = own.ids([text.encode()])
        assert len(ids) // 4 == len(library.encode(text, add_special_tokens=False).ids)
    assert len(own.known[0]) <= 5 + 7 and len(own.chunks[0]) <= 5 + 7


def test_wanted_documents_only(spark, tmp_path, monkeypatch):
    rows = [(i, f"text number {i} " * (i % 7)) for i in range(0, 4000, 2)]
    rows += [(None, "no id"), (None, None), (1000, "a second document of one id")]
    documents = spark.createDataFrame(rows, SCHEMA).repartition(4)
    folder = str(tmp_path / "tokens")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    manifest = token_frames.write_frames(documents, queries.tokenizer_path(), folder)
    spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert manifest.count() > 4
    every = {}
    for row in token_frames.read_frames(manifest, folder).collect():
        every.setdefault(row["doc_id"], []).append(tuple(row))
    assert sum(map(len, every.values())) == len(rows)
    asked = [0, 1, 1000, 1002, 3998, 4001, -5, 10**12, None, 1000]
    wanted = spark.createDataFrame([(i,) for i in asked], "doc_id long")
    got = [tuple(row) for row in token_frames.read_documents(manifest, folder, wanted).collect()]
    want = [row for i in {*asked} for row in every.get(i, [])]
    assert sorted(got, key=repr) == sorted(want, key=repr) and len(got) == 7
    # Files that hold none of the ids are not opened: they may as well be gone.
    one = spark.createDataFrame([(1002,)], "doc_id long")
    holds = manifest.where("first <= 1002 and last >= 1002").collect()
    for row in manifest.collect():
        if row["file"] not in {r["file"] for r in holds}:
            shutil.move(f"{folder}/{row['file']}", f"{tmp_path}/{row['file']}")
    assert [r["doc_id"] for r in token_frames.read_documents(manifest, folder, one).collect()] == [1002]
    assert token_frames.read_documents(manifest, folder, one.limit(0)).count() == 0


def test_only_wanted_frames_are_decompressed(tmp_path):
    from eventflat.llm.common import storage

    system, base = storage(str(tmp_path / "x.zst"))
    with system.open_output_stream(base, compression=None) as stream:
        writer = token_frames.FrameWriter(stream)
        for i in range(50):
            writer.document(i, b"abcd" * i)
        writer.close()
    read = []
    with system.open_input_file(base) as file:
        reader = token_frames.FrameReader(file)
        usual = reader.frame
        reader.frame = lambda place: read.append(place) or usual(place)
        (batch,) = token_frames.read_places(reader, [3, 40], 7)
    assert read == [3, 40] and batch.column("doc_id").to_pylist() == [3, 40]
    assert batch.column("start").to_pylist() == [7 + 0 + 1 + 2, 7 + sum(range(40))]


def test_reading_is_dealt_out_by_size(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(token_frames, "READ_BYTES", 4_000)
    documents = spark.createDataFrame([(i, "some words of a text " * 5) for i in range(500)], SCHEMA)
    folder = str(tmp_path / "tokens")
    manifest = token_frames.write_frames(documents, queries.tokenizer_path(), folder)
    found = token_frames.read_frames(manifest, folder)
    assert found.rdd.getNumPartitions() > 5 and found.count() == 500


def test_archives_are_read_by_ranges_and_from_the_list(spark, tmp_path):
    draw = random.Random(2)
    pages = [(i, f"u{i}", "".join(draw.choices("abcdefgh <>", k=3000))) for i in range(300)]
    pages += [(1000 + i, "copy", pages[i % 3][2]) for i in range(50)]
    data = spark.createDataFrame(pages, "page_id long, url string, html string")
    folder = str(tmp_path / "warc")
    warc.write_archives(data, folder)
    listed = [row["file"] for row in spark.read.parquet(f"{folder}/written").collect()]
    found = warc.read_archives(spark, folder, span=20_000)
    assert found.rdd.getNumPartitions() > 10
    rows = sorted(tuple(row) for row in found.collect())
    assert len(rows) == 350 and sum(row[4] == "revisit" for row in rows) == 50
    # What a lost attempt has left in the folder changes nothing.
    shutil.copy(f"{folder}/{listed[0]}", f"{folder}/pages-000000-77-stale-0000.warc.gz")
    assert sorted(tuple(row) for row in warc.read_archives(spark, folder).collect()) == rows


def test_groups_of_copies_joined_by_key_are_the_same(spark, monkeypatch):
    pages = [(i, "u", "x" * 200 if i % 2 else f"{i}" * 100) for i in range(100)]
    data = spark.createDataFrame(pages, "page_id long, url string, html string")
    usual = sorted(warc.digested(data).collect())
    monkeypatch.setattr(warc, "GROUPS", 0)
    assert sorted(warc.digested(data).collect()) == usual
