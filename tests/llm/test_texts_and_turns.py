"""Periodic runs, the conversation trie and merge-type encoding against plain versions."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from eventflat.llm import conversation_trie, periodic_runs, piece_table, queries

SCHEMA = "doc_id long, text string, Runs int, collapsed string, pieces int, ids string, best int"


def documents_of(spark, texts):
    return spark.createDataFrame(
        [(i, text, 1, "x", 1, "x", 1) for i, text in texts], SCHEMA
    ).repartition(3)


def plain_runs(words):
    """All runs by trying every period; a stretch counts for its smallest period only."""
    found = []
    for period in range(1, len(words) // 3 + 1):
        at = 0
        while at + period < len(words):
            if words[at] != words[at + period]:
                at += 1
                continue
            stop = at
            while stop + period < len(words) and words[stop] == words[stop + period]:
                stop += 1
            size = stop + period - at
            own = words[at : at + size]
            smaller = any(
                all(own[k] == own[k + less] for k in range(size - less)) for less in range(1, period)
            )
            if size >= max(24, 3 * period) and not smaller:
                found.append((at, size, period))
            at = stop
    return sorted(found, key=lambda run: (run[0], run[2]))


def plain_collapsed(words, runs):
    gone = {i for start, size, period in runs for i in range(start + period, start + size)}
    return " ".join(word for i, word in enumerate(words) if i not in gone)


def periodic_text(draw, letters, words):
    found = []
    while len(found) < words:
        root = [draw.choice(letters) for _ in range(draw.randint(1, 12))]
        found += (root * 40)[: draw.randint(1, 70)]
    return found


def test_runs_match_every_period_tried():
    draw = random.Random(1)
    for _ in range(60):
        texts = []
        for _ in range(draw.randint(1, 6)):
            if draw.random() < 0.4:
                texts.append([draw.choice("ab") for _ in range(draw.randint(0, 120))])
            else:
                texts.append(periodic_text(draw, "abcd", draw.randint(10, 200)))
        coded = [[word.encode() for word in words] for words in texts]
        found = periodic_runs.runs_of_texts(
            [word for words in coded for word in words], np.array([len(words) for words in coded])
        )
        for number, words in enumerate(texts):
            own = found.text == number
            got = zip(found.start[own], found.length[own], found.period[own], strict=True)
            assert sorted(got, key=lambda run: (run[0], run[2])) == plain_runs(words)


def test_runs_of_a_tree_of_several_stretches_and_of_one_long_stretch(monkeypatch):
    draw = random.Random(2)
    words = [w.encode() for w in periodic_text(draw, "abc", 3000)]
    counts = np.array([1000, 0, 24, len(words) - 1024])
    whole = periodic_runs.runs_of_texts(words, counts)
    monkeypatch.setattr(periodic_runs, "TREE_WORDS", 100)
    small = periodic_runs.runs_of_texts(words, counts)
    assert {*zip(*whole, strict=True)} == {*zip(*small, strict=True)}
    long = [b"%d" % (i % 7000) for i in range(40_000)]
    found = periodic_runs.runs_of_texts(long, np.array([len(long)]))
    assert [list(column) for column in found] == [[0], [0], [40_000], [7000]]


def test_runs_operator(spark):
    draw = random.Random(3)
    texts = [
        (1, None),
        (2, ""),
        (3, " \t\n"),
        (4, "a " * 24),
        (5, "a\n" * 23),
        (6, "ab " * 8 + "cd\x0bef " * 20),
        (7, " ".join(periodic_text(draw, "xyz", 300))),
        (7, " ".join(periodic_text(draw, "xyz", 300))),
        (None, "same words " * 30),
        (8, "no run here " + " ".join(map(str, range(2000)))),
        (9, "é ß ü　 " * 5000),
        (10, "one two " * 400_000),
    ]
    found = periodic_runs.with_runs(documents_of(spark, texts))
    assert [c.lower() for c in found.columns].count("runs") == 1
    rows = found.select("doc_id", "text", "runs", "collapsed").collect()
    assert len(rows) == len(texts)
    assert sorted((str(row["doc_id"]), row["text"] or "") for row in rows) == sorted(
        (str(i), text or "") for i, text in texts
    )
    for row in rows:
        words = [word.decode() for word in (row["text"] or "").encode().split()]
        runs = [tuple(run) for run in row["runs"]]
        if row["doc_id"] == 10:
            assert (runs, row["collapsed"]) == ([(0, 800_000, 2)], "one two")
            continue
        if row["doc_id"] != 9:  # trying every period takes long
            assert runs == plain_runs(words)
        assert row["collapsed"] == plain_collapsed(words, runs)
    empty = periodic_runs.with_runs(documents_of(spark, texts).limit(0))
    assert empty.collect() == []


def test_runs_query(spark, tmp_path):
    draw = random.Random(4)
    texts = [(i, " ".join(str(draw.randrange(50)) for _ in range(draw.randint(0, 90)))) for i in range(120)]
    texts += [(1000 + i, " ".join(periodic_text(draw, "ab", 100))) for i in range(30)]
    texts += [(2000, None), (2001, ""), (5, "repeated id"), (None, "a " * 30)]
    documents_of(spark, texts).write.parquet(f"{tmp_path}/documents.parquet")
    rows = queries.op11_periodic_runs(spark, str(tmp_path)).collect()
    want = []
    planted = 0
    for doc_id, text in texts:
        words, h = (text or "").split(), 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
        if h % 10 == 0 and words:
            planted += 1
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        runs = plain_runs(words)
        best = (None, None, None)
        for run in runs:
            if best[0] is None or run[1] * best[2] > best[1] * run[2]:
                best = run
        lines = "".join(f"{s},{n},{p}\n" for s, n, p in runs)
        want.append(
            (
                doc_id,
                len(runs),
                *best,
                None if best[0] is None else 1000 * best[1] // best[2],
                hashlib.sha256(lines.encode()).hexdigest(),
                hashlib.sha256(plain_collapsed(words, runs).encode()).hexdigest(),
            )
        )
    assert planted > 5
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)


def plain_nodes(turns, words):
    """All nodes of a trie: ``turns`` by conversation, ``words`` by turn."""
    members, children = defaultdict(list), defaultdict(set)
    for conversation, own in turns.items():
        for depth in range(len(own) + 1):
            members[tuple(own[:depth])].append(conversation)
    for path in members:
        if path:
            children[path[:-1]].add(path)
    found = []
    for path, own in members.items():
        below = [other for other in members if other[: len(path)] == path]
        ends = sorted(c for c in own if len(turns[c]) == len(path))
        found.append(
            (
                min(own),
                len(path),
                min(members[path[:-1]]) if path else None,
                len(own),
                len(children[path]),
                sum(not children[other] for other in below),
                sum((len(members[o]) - 1) * words[o[-1]] for o in below if o),
                hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest(),
            )
        )
    return sorted(found, key=lambda node: (node[1], node[0]))


TURNS = "conv_id long, turn long, role string, text string, key string, words int, part int"


def conversations_of(spark, turns):
    rows = [
        (c, number, role, text, "x", 1, 1)
        for c, own in turns.items()
        for number, (role, text) in enumerate(own)
    ]
    random.Random(5).shuffle(rows)
    return spark.createDataFrame(rows, TURNS).repartition(4)


def nodes_of(data):
    return sorted(map(tuple, data.collect()), key=lambda node: (node[1], node[0]))


@pytest.mark.parametrize("kind", ["mixed", "equal", "chains", "deep", "single"])
def test_trie_matches_all_prefixes(spark, kind):
    draw = random.Random(6)
    turns = {}
    for c in range(1 if kind == "single" else 70):
        if kind == "equal" and c % 3 == 0:
            letters = "aab"
        elif kind == "chains":
            letters = "a" * draw.randint(1, 8)
        elif kind == "deep":
            letters = "ab" * 30 + draw.choice("ab") * draw.randint(0, 3)
        else:
            letters = [draw.choice("ab") for _ in range(draw.randint(1, 5))]
        turns[c - 20] = [("user", " ".join([x] * (ord(x) - 96))) for x in letters]
    words = {turn: len(turn[1].split()) for own in turns.values() for turn in own}
    found = conversation_trie.trie(conversation_trie.sequences(conversations_of(spark, turns)))
    assert nodes_of(found) == plain_nodes(turns, words)


def test_trie_of_nulls_ties_and_nothing(spark):
    rows = [
        (1, None, None, None),
        (1, 0, "a", "x y"),
        (2, 5, "", ""),
        (2, 7, "a", "x y"),
        (3, 0, "a", "x y"),
        (3, 0, "a", "x y"),
        (4, 0, "a", "x y"),
        (4, 0, "a", "x y"),
        (None, 0, "a", "lost"),
        (5, 0, "ax", " y"),
    ]
    data = spark.createDataFrame(rows, "conv_id int, turn int, role string, text string")
    empty, said, other = ("", ""), ("a", "x y"), ("ax", " y")
    turns = {1: [empty, said], 2: [empty, said], 3: [said] * 2, 4: [said] * 2, 5: [other]}
    words = {empty: 0, said: 2, other: 1}
    found = conversation_trie.trie(conversation_trie.sequences(data))
    assert nodes_of(found) == plain_nodes(turns, words)
    nothing = conversation_trie.trie(conversation_trie.sequences(data.limit(0)))
    assert nothing.collect() == []


def test_trie_joined_by_key_is_the_same(spark, monkeypatch):
    draw = random.Random(7)
    turns = {c: [("u", draw.choice("ab"))] * draw.randint(1, 4) for c in range(60)}
    own = conversation_trie.sequences(conversations_of(spark, turns))
    usual = nodes_of(conversation_trie.trie(own))
    monkeypatch.setattr(conversation_trie, "FEW_NODES", 0)
    assert nodes_of(conversation_trie.trie(own)) == usual


def test_trie_query(spark, tmp_path):
    draw = random.Random(8)
    turns = {
        c: [("u", f"{draw.choice('ab')} {draw.choice('ab')}") for _ in range(draw.randint(1, 5))]
        for c in range(90)
        if c != 40  # its followers have no base
    }
    conversations_of(spark, turns).write.parquet(f"{tmp_path}/conversations.parquet")
    rebuilt = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 4
        rebuilt[c] = turns.get(c - c % 20, [])[:h] + own[h:]
    assert any(not own for own in rebuilt.values())
    words = {turn: 2 for own in turns.values() for turn in own}
    found = queries.op12_conversation_trie(spark, str(tmp_path))
    assert nodes_of(found) == plain_nodes(rebuilt, words)


@pytest.fixture(scope="module")
def model():
    from sentencepiece import SentencePieceProcessor

    return SentencePieceProcessor(model_file=queries.tokenizer_path(queries.PIECES))


@pytest.fixture(scope="module")
def codec():
    return piece_table.codec(queries.tokenizer_path(queries.PIECES))


PARTS = [
    *"abehinorst", "the", "ing", " ", "  ", "▁", "\n", "\t", "é", "ß", "漢", "字", "😀", "<s>",
    "</s>", "<unk>", "<0x41>", "1", "2", ",", ".", "А", "в", "ий", "​", "﻿", "ﬁ",
    "\x00", "́", " " * 17,
]


def test_pieces_match_the_library(model, codec):
    draw = random.Random(9)
    texts = ["".join(draw.choices(PARTS, k=draw.randint(0, 40))) for _ in range(4000)]
    texts += [letters * n for n in range(70) for letters in (" ", "a", "ab", "the", " a")]
    want = model.encode(texts, add_bos=True, add_eos=True)
    found = list(codec.documents([text.encode() for text in texts]))
    for text, ids, (got, plain) in zip(texts, want, found, strict=True):
        assert np.frombuffer(got, "<u4").tolist() == ids, text
        assert plain.decode() == codec.decode(ids) == model.decode(ids)


def test_any_ids_decode_as_in_the_library(model, codec):
    draw = random.Random(10)
    for _ in range(2000):
        ids = [draw.randrange(draw.choice([262, 32_000])) for _ in range(draw.randint(0, 12))]
        assert codec.decode(ids) == model.decode(ids), ids


def test_pieces_operators(spark, model):
    path = queries.tokenizer_path(queries.PIECES)
    texts = [
        (1, None), (2, ""), (3, " "), (4, "Two  words\n"), (4, "Two  words\n"), (None, "<s>漢"),
        (5, "long" * 50_000), (6, "many words of a text " * 100_000),
    ]
    data = documents_of(spark, texts)
    assert piece_table.digests(data.limit(0), path).collect() == []
    rows = piece_table.digests(data, path).select("doc_id", "text", "pieces").collect()
    assert len(rows) == len(texts)
    for row in rows:
        ids = model.encode(row["text"] or "", add_bos=True, add_eos=True)
        assert row["pieces"]["n_tokens"] == len(ids)
        packed = np.array(ids, "<u4").tobytes()
        assert row["pieces"]["ids_sha256"] == hashlib.sha256(packed).hexdigest()
        plain = hashlib.sha256(model.decode(ids).encode()).hexdigest()
        assert row["pieces"]["decoded_sha256"] == plain
    back = piece_table.decoded(piece_table.encoded(data, path), path)
    assert back.where(F.col("decoded") != F.coalesce("text", F.lit(""))).count() == 0
    lists = {row["doc_id"]: row["ids"] for row in back.select("doc_id", "ids").collect()}
    assert lists[2] == [1, 2] and lists[4] == model.encode("Two  words\n", add_bos=True, add_eos=True)
    nulls = back.select(F.lit(None).cast("array<int>").alias("ids"))
    assert {row["decoded"] for row in piece_table.decoded(nulls, path).collect()} == {None}


def test_other_models_are_refused():
    with pytest.raises((ValueError, OSError, RuntimeError)):
        piece_table.Codec(queries.tokenizer_path())
