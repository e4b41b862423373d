"""Operators whose results rest on hash draws or iterations, against plain versions."""

from __future__ import annotations

import math
import random
import re
import struct
from collections import Counter, defaultdict

import pytest
import xxhash
from pyspark.sql import functions as F

from eventflat.llm import quality_divergence, queries, sharding, url_graph


def spark_hash(*values):
    """xxhash64 of texts and 32-bit integers as Spark chains it, unsigned."""
    seed = 42
    for value in values:
        data = value.encode() if isinstance(value, str) else struct.pack("<i", value)
        seed = xxhash.xxh64_intdigest(data, seed)
    return seed


def descend(key, tree):
    """The shard a key reaches: at each node the child with the least draw."""
    path, node = "root", tree
    while isinstance(node, list):
        draws = []
        for place, child in enumerate(node):
            weight = leaves(child)
            u = ((spark_hash(path, place, key) >> 11) + 0.5) / (1 << 53)
            draws.append((-math.log(u) / weight, place))
        place = min(draws)[1]
        path, node = f"{path}/{place}", node[place]
    return node


def leaves(node):
    return sum(map(leaves, node)) if isinstance(node, list) else 1


@pytest.mark.parametrize("shards", [1, 6, 16])
def test_shards_match_a_plain_descent(spark, shards):
    rows = [(i, "x" * (i % 5)) for i in range(400)] + [(None, None), (3, "again")]
    data = spark.createDataFrame(rows, "doc_id long, text string")
    held = sharding.tree(shards)
    more = sharding.grown(held)
    found = sharding.sharded(data, shards).collect()
    assert len(found) == len(rows)
    for row in found:
        key = "null" if row["doc_id"] is None else str(row["doc_id"])
        assert row["shard"] == descend(key, held)
        assert row["grown_shard"] == descend(key, more)
    slots = defaultdict(list)
    for row in found:
        slots[row["shard"]].append(row["slot"])
    assert all(sorted(own) == list(range(len(own))) for own in slots.values())


def test_no_old_shard_wins_a_row(spark):
    """For every number of shards: a plain descent of 300 keys, before and after."""
    for shards in range(1, 34):
        held = sharding.tree(shards)
        more = sharding.grown(held)
        assert leaves(more) == shards + 1
        for key in map(str, range(300)):
            before, after = descend(key, held), descend(key, more)
            assert after in (before, shards)


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Toxic texts, junk and near copies among clean texts: each stage takes what it should."""
    import corpus_pipeline

    draw = random.Random(3)
    plain = [f"w{k}" for k in range(60)] + ["the", "of"] * 10

    def prose(words=90):
        return " ".join(draw.choice(plain) for _ in range(words))

    texts, toxic = {}, {}
    for i in range(900):
        words = prose().split()
        if i % 3 == 0:
            words[5], words[30], words[60] = "scum", "idiot", "moron"
        texts[i] = " ".join(words)
        if i < 800:
            toxic[i] = int(i % 3 == 0)
    junk = {2000: "one two", 2001: "same words again and " * 40, 2002: None, 2003: ""}
    copies = {3000 + i: texts[3 * i + 1].replace(" w7 ", " w8 ", 1) for i in range(20)}
    texts |= junk | copies | {4000: texts[1]}
    rows = [(i, text, "en", "ab"[i % 2], len(text or ""), 1) for i, text in texts.items()]
    folder = str(tmp_path)
    schema = "doc_id long, text string, lang string, source string, n_chars long, Node int"
    spark.createDataFrame(rows, schema).write.parquet(f"{folder}/documents.parquet")
    labels = spark.createDataFrame(list(toxic.items()), "doc_id long, toxic int")
    labels.withColumn("quality", F.lit(1)).write.parquet(f"{folder}/labels.parquet")

    docs = spark.read.parquet(f"{folder}/documents.parquet")
    left = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.stored(stage(spark, docs, folder), f"test-{name}")
        assert [c.lower() for c in docs.columns] == [c.lower() for c in schema.replace(",", "").split()[::2]]
        left[name] = Counter(row["doc_id"] for row in docs.select("doc_id").collect())
    clean = {i for i in texts if i >= 2000 or i % 3}
    assert {*left["toxicity"]} == clean
    good = clean - {*junk}
    assert {*left["quality"]} == good
    # Groups by the rule itself: five words, similarity 0.8 and more.
    sets = {}
    for i in good:
        words = texts[i].lower().split()
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)}
    kept = set()
    for i in sorted(good):
        near = [k for k in good if k != i and 100 * len(sets[i] & sets[k]) >= 80 * len(sets[i] | sets[k])]
        assert not near or i >= 3000 or min(near) >= 3000  # only copies are near
        if not near or i < min(near):
            kept.add(i)
    assert {*left["near_duplicates"]} == kept
    assert {*left["mixing"]} <= kept and max(left["mixing"].values()) <= 2
    result = corpus_pipeline.STAGES[-1][1](spark, docs, folder).collect()
    assert Counter(row["doc_id"] for row in result) == left["mixing"]
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(queries.tokenizer_path())
    for row in result[:50]:
        ids = library.encode(texts[row["doc_id"]], add_special_tokens=False).ids
        assert row["n_tokens"] == len(ids)
    again = Counter(row["doc_id"] for row in corpus_pipeline.run(spark, folder).collect())
    assert again == left["mixing"]


def test_pipeline_of_nothing(spark, tmp_path):
    import corpus_pipeline

    schema = "doc_id long, text string, lang string, source string, Quality int, bpe int"
    spark.createDataFrame([], schema).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []



def plain_standing(pages):
    """Verdict by host, from links between hosts walked until nothing changes."""
    votes, links = Counter(), Counter()
    hosts = set()
    for host, verdict, targets in pages:
        hosts.add(host)
        votes[host] += {"allow": 1, "block": -1, None: 0}[verdict]
        links.update({(host, target): 1 for target in set(targets) if target != host})
    hosts |= {end for link in links for end in link}
    found = {}
    for kind, sign in (("trust", 1), ("distrust", -1)):
        ways = links if kind == "trust" else Counter({(b, a): n for (a, b), n in links.items()})
        seeds = {host for host in hosts if votes[host] * sign > 0}
        seed = {host: (host in seeds) / max(len(seeds), 1) for host in hosts}
        out = Counter()
        for (a, _), n in ways.items():
            out[a] += n
        score = dict(seed)
        for _ in range(600):
            kept = sum(score[host] for host in hosts if out[host])
            new = {host: seed[host] * (1 - 0.85 * kept) for host in hosts}
            for (a, b), n in ways.items():
                new[b] += 0.85 * n / out[a] * score[a]
            score = new
        found[kind] = score
    bar = 0.1 / len(hosts)
    margin = min(
        min(abs(found["distrust"][h] - bar) for h in hosts),
        min(abs(found["distrust"][h] - 2 * found["trust"][h]) for h in hosts if found["distrust"][h] >= bar),
    )
    blocked = {h for h in hosts if found["distrust"][h] >= bar and found["distrust"][h] > 2 * found["trust"][h]}
    return blocked, margin / bar


def test_graph_verdicts_match_a_plain_walk(spark):
    draw = random.Random(8)
    names = [f"t{i}.org" for i in range(6)] + [f"b{i}.com" for i in range(6)] + [f"n{i}.net" for i in range(30)]
    pages, rows = [], []
    for number in range(160):
        host = draw.choice(names)
        path = "/de/x" if host.endswith(".com") and draw.random() < 0.8 else "/other"
        verdict = "allow" if host.endswith(".org") else "block" if path == "/de/x" and host.endswith(".com") else None
        targets = [draw.choice(names) for _ in range(draw.randint(0, 4))]
        html = " ".join(f'<a href="http://{target}/p">x</a>' for target in targets)
        pages.append((host, verdict, targets))
        rows.append((number, f"http://{host.upper() if number % 5 == 0 else host}{path}?q#f", html))
    blocked, margin = plain_standing(pages)
    assert margin > 1e-3 and 3 < len(blocked) < 40  # far from the bars, and a case of both kinds
    found = {r["page_id"]: r for r in url_graph.judged(
        spark.createDataFrame(rows, "page_id long, url string, html string")
    ).collect()}
    for (number, _, _), (host, verdict, _) in zip(rows, pages, strict=True):
        want = verdict or ("block" if host in blocked else "allow")
        assert (found[number]["host"], found[number]["verdict"]) == (host, want)
    assert {found[n]["verdict"] for n, (host, _, _) in enumerate(pages) if host.endswith(".net")} == {"allow", "block"}


def plain_distance(counts, reference):
    """Jensen-Shannon distance of two tallies."""
    a, b = sum(counts.values()) or 1, sum(reference.values()) or 1
    total = 0.0
    for key in {*counts, *reference}:
        p, q = counts.get(key, 0) / a, reference.get(key, 0) / b
        for x in (p, q):
            total += x * math.log2(2 * x / (p + q)) / 2 if x else 0
    return math.sqrt(max(total, 0))


def test_quality_verdicts_match_a_plain_version(spark):
    draw = random.Random(9)
    rules = quality_divergence.Rules(common=12, least_reference_words=800)
    words = {
        "en": ["the", "of", "and", "house", "in", "is", "longerwords", "Read", "a", "it", "42", "to", "be", "we", "so"],
        "de": ["der", "die", "und", "Haus", "im", "ist", "größere", "Wörter", "ein", "es", "7", "zu", "wir", "so"],
        "xx": ["ka", "ki", "ko"],
    }
    rows = []
    for i in range(150):
        lang = draw.choice(["en", "en", "de", "xx"]) if i % 17 else "xx"
        kind = draw.random()
        pool = words[lang]
        if kind < 0.1:
            pool = ["###", "$$", "%%%%", "word"]
        elif kind < 0.2:
            pool = words["de" if lang == "en" else "en"]
        text = " ".join(draw.choice(pool) + draw.choice(["", "", ",", "."]) for _ in range(draw.randint(10, 120)))
        rows.append((i, text, {"en": "en-GB", "de": "DE", "xx": "xx"}[lang], lang))

    classes = quality_divergence.class_table()

    def tallies(text):
        kinds = Counter(quality_divergence.CLASSES[classes[ord(c)]] for c in text)
        short = Counter()
        for word in re.findall(r"[^\x20\x09-\x0D]+", text):
            plain = word.strip(".,;:!?'\"()-").lower()
            short[plain if 0 < len(plain) <= rules.short and plain.isalpha() else None] += 1
        return kinds, short

    sums = defaultdict(lambda: (Counter(), Counter()))
    for _, text, _, lang in rows:
        for whole, own in zip(sums[lang], tallies(text), strict=True):
            whole.update(own)

    def binned(short, common):
        found = Counter()
        for word, n in short.items():
            found["long" if word is None else word if word in common else "rest"] += n
        return found

    found = {r["doc_id"]: r["quality"] for r in quality_divergence.quality(
        spark.createDataFrame([row[:3] for row in rows], "doc_id long, text string, lang string"), rules
    ).collect()}
    verdicts = Counter()
    for i, text, _, lang in rows:
        kinds, short = sums[lang]
        got, n = found[i], len(text.split())
        distances = [None, None]
        if sum(short.values()) >= rules.least_reference_words:
            own_kinds, own_short = tallies(text)
            best = sorted(((k, w) for w, k in short.items() if w is not None), reverse=True)[: rules.common]
            common = {word for _, word in best}
            if len(text) >= rules.least_chars:
                distances[0] = plain_distance(own_kinds, kinds)
            if n >= rules.least_words:
                distances[1] = plain_distance(binned(own_short, common), binned(short, common))
        for name, want in zip(("class_distance", "word_distance"), distances, strict=True):
            assert (got[name] is None) == (want is None)
            assert want is None or abs(got[name] - want) < 1e-9
        odd = (distances[0] or 0) > rules.most_class_distance or (distances[1] or 0) > rules.most_word_distance
        assert got["kept"] == (not got["base_failed"] and not odd)
        verdicts[got["kept"], odd, lang == "xx"] += 1
    assert verdicts[True, False, False] > 20 and verdicts[False, True, False] > 5
