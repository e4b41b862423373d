"""The pivot by look-ups and the one in one pass give the same; the merge compares hashes."""

from __future__ import annotations

import random
import re
import time

import pytest
from frames import PARAMS, Slots, exchanges, frame, params, plan

from eventflat import flatten_events
from eventflat.operators import params as operator
from eventflat.operators import pivot_params

KEYS = ["a", "b.c", "d`e", "quote's", "ga_session_id", "Ünï", "a b", "absent", "back\\slash", ""]
ALWAYS, NEVER = 0, 10**9


def texts(draw):
    return draw.choice(["x", "", " ", 'he said "no"', "back\\slash", "ü\n\t", 5, -7, 2.5, 1e30, None])


def awkward(spark, seed=1, count=150):
    draw = random.Random(seed)
    names = [*KEYS, "items", "A", None, "other"]
    rows = []
    for number in range(count):
        entries = params(*[(draw.choice(names), texts(draw)) for _ in range(draw.randint(0, 9))])
        if draw.random() < 0.3:
            entries.append(("a", Slots((None, None, None, None))))
            entries.append(("a", Slots((None, 4, 0.5, None))))
        rows.append({"event_timestamp": number // 2, "event_params": entries})
    rows.append({"event_timestamp": 10**6, "event_params": None})
    rows.append({"event_timestamp": 10**6 + 1, "event_params": params(("a", "long " * 200_000))})
    return frame(spark, *rows)


def rows_of(data):
    return sorted((row.asDict(recursive=True) for row in data.collect()), key=repr)


@pytest.mark.parametrize("keys", [KEYS, ["a"], [k for k in KEYS if k != "ga_session_id"]])
@pytest.mark.parametrize("merge", [True, False])
def test_forms_agree(spark, keys, merge):
    data = awkward(spark)
    carry = ["event_timestamp", "event_name"]
    found = [pivot_params(data, keys, carry, merge, form) for form in (NEVER, ALWAYS)]
    assert found[0].schema.simpleString() == found[1].schema.simpleString()
    assert rows_of(found[0]) == rows_of(found[1])
    assert found[0].count() > 50


def test_forms_agree_in_a_case_sensitive_session(spark):
    data = awkward(spark, 2)
    spark.conf.set("spark.sql.caseSensitive", "true")
    try:
        keys = ["a", "A", "ga_session_id"]
        found = [rows_of(pivot_params(data, keys, ["event_timestamp"], False, f)) for f in (NEVER, ALWAYS)]
        assert found[0] == found[1]
        assert any(r["event_params"]["a"] != r["event_params"]["A"] for r in found[0])
    finally:
        spark.conf.unset("spark.sql.caseSensitive")


def test_whole_jobs_agree(spark, monkeypatch):
    draw = random.Random(3)
    kinds = [key for key in [*KEYS, "items", "user_id"] if key]
    rows = [
        {
            "event_timestamp": draw.randrange(40),
            "event_params": params(*[(draw.choice(kinds), texts(draw)) for _ in range(6)]),
            "items": [("i", 1.0)] * draw.randint(0, 2),
        }
        for _ in range(120)
    ]
    data = frame(spark, *rows)
    found = []
    for form in (NEVER, ALWAYS):
        monkeypatch.setattr(operator, "ONE_PASS_KEYS", form)
        found.append([
            rows_of(flatten_events(data, "view")),
            rows_of(flatten_events(data, "view", assume_unique=True)),
            rows_of(flatten_events(data, "view", "ecommerce")),
        ])
    assert found[0] == found[1]


def wide_events(spark, keys, events, path):
    kind = PARAMS
    spark.range(events, numPartitions=8).selectExpr(
        "id",
        f"""cast(transform(sequence(1, 25), i -> named_struct('key',
              concat('k', (id * 7 + i * {max(1, keys // 25)}) % {keys}), 'value',
              named_struct('string_value', if(i % 3 = 0, concat('text ', id % 1000, i), null),
                'int_value', if(i % 3 = 1, id + i, null), 'float_value', cast(null as double),
                'double_value', if(i % 3 = 2, id / 4D, null)))) as {kind}) as event_params""",
    ).write.parquet(path)
    return spark.read.parquet(path)


def test_many_keys_are_read_in_one_pass(spark, tmp_path):
    data = wide_events(spark, 400, 20_000, str(tmp_path / "wide"))
    keys = [f"k{number}" for number in range(400)]

    def seconds(form):
        found = []
        for _ in range(3):
            start = time.perf_counter()
            pivot_params(data, keys, ["id"], False, form).write.format("noop").mode("overwrite").save()
            found.append(time.perf_counter() - start)
        return min(found)

    assert "array_position" not in plan(pivot_params(data, keys, ["id"], False)).replace(
        "array_position(_entries#", "", 2
    ).split("to_variant_object")[0]
    assert seconds(NEVER) > 2 * seconds(ALWAYS)  # five and more on an idle machine


def test_merge_compares_a_hash_first(spark):
    flat = flatten_events(awkward(spark), "view", param_keys=["a"])
    assert exchanges(flat) == 1
    keys = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan(flat))[0].split(", ")
    assert keys[0].startswith("_identity#")
    # A column the export lacks is a constant: it is no key.
    assert not any(key.startswith("batch_event_index#") for key in keys)
    sorts = re.findall(r"Sort \[([^\]]*)\]", plan(flat))
    assert sorts and all(found.startswith("_identity#") for found in sorts)


def test_merge_of_equal_hashes_keeps_events_apart(spark, monkeypatch):
    """A hash that says nothing changes nothing: the columns themselves are keys too."""
    data = awkward(spark, 4)
    usual = rows_of(pivot_params(data, KEYS, ["event_timestamp", "event_name"]))
    monkeypatch.setattr(operator, "identity_hash", lambda *_: "1L + cast(rand() as bigint)")
    assert rows_of(pivot_params(data, KEYS, ["event_timestamp", "event_name"])) == usual
    monkeypatch.setattr(operator, "identity_hash", lambda *_: None)
    assert rows_of(pivot_params(data, KEYS, ["event_timestamp", "event_name"])) == usual
