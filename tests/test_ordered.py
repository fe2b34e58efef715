"""Chunked folds against plain Python loops, with chunks far smaller than the histories."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from rillstream.operators import alerts, duplicates, keyed_maps, ordered, slices

WIDTHS = [(4, 3), (64, 1024), (4096, 1024)]


def events(spark, rows, seed):
    """Two thirds of the rows belong to one key; positions have gaps."""
    rng = random.Random(seed)
    data, at = [], 0
    for _ in range(rows):
        at += rng.choice([1, 1, 1, 5, 40])
        key = "hot" if rng.random() < 0.66 else rng.choice(["a", "b", None])
        data.append((key, at, rng.randint(1, 8), rng.uniform(-1, 1)))
    rng.shuffle(data)
    return data, spark.createDataFrame(data, "key string, pos long, code int, value double")


def histories(data):
    by_key = {}
    for row in sorted(data, key=lambda r: r[1]):
        by_key.setdefault(row[0], []).append(row)
    return by_key


@pytest.mark.parametrize("width,fan", WIDTHS)
def test_previous_row(spark, width, fan):
    data, df = events(spark, 300, 1)
    want = {}
    for rows in histories(data).values():
        for before, row in zip([None, *rows[:-1]], rows, strict=True):
            want[row[1]] = before and before[2]
    got = ordered.previous_row(df, ["key"], "pos", ["code"], width=width).collect()
    assert {r["pos"]: r["previous"] and r["previous"]["code"] for r in got} == want
    assert len(got) == len(data)


@pytest.mark.parametrize("width,fan", WIDTHS)
def test_running_sum_and_index(spark, width, fan):
    data, df = events(spark, 300, 2)
    want = {}
    for rows in histories(data).values():
        total = 0
        for index, row in enumerate(rows):
            total += row[2]
            want[row[1]] = (total, index)
    out = ordered.running_sum(df, "code", "pos", "total", partition_by=["key"], width=width,
                              fan=fan)
    out = ordered.dense_index(out, "pos", "i", partition_by=["key"], width=width)
    assert {r["pos"]: (r["total"], r["i"]) for r in out.collect()} == want


def test_highest_before(spark):
    data, df = events(spark, 200, 3)
    want, top = {}, None
    for row in sorted(data, key=lambda r: r[1]):
        want[row[1]] = top
        top = row[2] if top is None else max(top, row[2])
    got = ordered.highest_before(df, "code", "pos", "top", width=16).collect()
    assert {r["pos"]: r["top"] for r in got} == want


@pytest.mark.parametrize("width,fan", WIDTHS)
def test_state_machine(spark, width, fan):
    data, df = events(spark, 400, 4)
    names = alerts.STATE_NAMES
    want, states = set(), {}
    for key, rows in histories(data).items():
        state = alerts.INITIAL
        for _, at, code, _ in rows:
            onward = alerts.TRANSITIONS.get((state, code))
            states[at] = state
            if onward is None:
                want.add((key, at, names[state]))
            state = alerts.INITIAL if onward is None else onward
    got = alerts.anomaly_alerts(df, "key", "code", "pos", width=width).collect()
    assert sorted((str(r["key"]), r["pos"], r["state"]) for r in got) == sorted(
        (str(k), p, s) for k, p, s in want)
    walked = ordered.keyed_scan(df, ["key"], "pos", alerts._machine("code"), width=width, fan=fan)
    assert {r["pos"]: r["before"] for r in walked.collect()} == states


@pytest.mark.parametrize("width,fan", WIDTHS)
def test_bookmarks_and_counts(spark, width, fan):
    data, df = events(spark, 400, 5)
    data = [r for r in data if r[0] is not None]
    df = df.where("key is not null")
    want = set()
    for key, rows in histories(data).items():
        start = None
        for _, at, _, value in rows:
            if value < 0 and start is None:
                start = at
            elif value >= 0 and start is not None:
                want.add((key, start, at, sum(1 for r in rows if start <= r[1] < at and r[3] < 0)))
                start = None
    found = slices.bookmark_slices(df, "key", "pos", F.col("value") < 0, width=width)
    counted = slices.slice_counts(df, found, "key", "pos", F.col("value") < 0, block=32)
    assert {tuple(r) for r in counted.select("key", "start_offset", "end_offset",
                                             "n").collect()} == want
    walked = slices.bookmark_counts(df, "key", "pos", F.col("value") < 0, F.col("value") < 0, width=width)
    assert {tuple(r) for r in walked.collect()} == want
    high = slices.bookmark_counts(df, "key", "pos", F.col("value") < 3, F.col("value") < 0, width=width)
    runs = slices.bookmark_slices(df, "key", "pos", F.col("value") < 3, width=width)
    joined = slices.slice_counts(df, runs, "key", "pos", F.col("value") < 0, block=32)
    assert {tuple(r) for r in high.collect()} == {tuple(r) for r in joined.select(*high.columns).collect()}


def replay_by_hand(data):
    table, out, epoch = {}, {}, 0
    for rev, op, key, value, expected in data:
        if op == "clear":
            table, epoch = {}, epoch + 1
            continue
        old = table.get(key)
        new, applied = old, True
        if op == "put":
            new = value
        elif op == "putIfAbsent":
            applied = old is None
            new = value if applied else old
        elif op in ("remove", "replace"):
            applied = old is not None
            new = (value if op == "replace" else None) if applied else old
        else:
            applied = old is not None and old == expected
            new = (value if op == "replaceIf" else None) if applied else old
        if new is None:
            table.pop(key, None)
        else:
            table[key] = new
        out[rev] = (epoch, old, applied, new)
    return table, out


@pytest.mark.parametrize("width,fan", WIDTHS)
@pytest.mark.parametrize("clears", [0.0, 0.02])
def test_conditional_map(spark, width, fan, clears):
    rng = random.Random(width)
    ops = ["put", "putIfAbsent", "remove", "removeIf", "replace", "replaceIf", "replaceIf",
           "removeIf", "putIfAbsent"]
    data = [(rev, "clear" if rng.random() < clears else rng.choice(ops),
             rng.choice(["hot", "hot", "hot", "x", "y"]), rng.choice("pqr"),
             rng.choice(["p", "q", "r", None])) for rev in range(400)]
    df = spark.createDataFrame(
        data, "rev long, op string, key string, value string, expected string")
    table, outcomes = replay_by_hand(data)
    got = keyed_maps.conditional_replay(df, width=width, index_width=50).collect()
    assert {r["rev"]: (r["epoch"], r["previous"], r["applied"], r["current"])
            for r in got} == outcomes
    final = {r["key"]: r["value"] for r in keyed_maps.final_map(df, width=width).collect()}
    assert final == table


def test_long_chain_of_conditional_updates(spark):
    """Each update expects what the one before left; every 1,000th expects something else."""
    length = 5_000
    df = spark.range(length).selectExpr(
        "id AS rev", "CASE WHEN id = 0 THEN 'put' ELSE 'replaceIf' END AS op", "'hot' AS key",
        "CASE WHEN id % 1000 = 999 THEN 'lost' ELSE string(id) END AS value",
        "CASE WHEN id % 1000 = 999 THEN 'nobody' WHEN id % 1000 = 0 THEN string(id - 2) ELSE string(id - 1) END AS expected")
    got = keyed_maps.conditional_replay(df, width=1000).toPandas().sort_values("rev")
    assert len(got) == length
    applied = got["rev"] % 1000 != 999
    assert (got["applied"] == applied).all()
    assert (got["current"] == (got["rev"] - ~applied).astype(str)).all()
    assert (got["previous"][1:] == got["current"].shift()[1:]).all()


@pytest.mark.parametrize("seed", range(3))
def test_linked_updates_on_few_values(spark, seed):
    """Heavy and light keys, values that come back, expectations of the update's own value, null values."""
    rng = random.Random(seed)
    ops = ["put", "remove", "removeIf", "replaceIf", "replaceIf", "replaceIf", "putIfAbsent", "replace"]
    data = [(rev * 3, rng.choices(ops, [1, 1, 4, 9, 9, 9, 4, 1])[0], "h" if rng.random() < .8 else rng.choice("ab"),
             rng.choice(["p", "q", "r", "s", None]), rng.choice(["p", "q", "r", "s", None])) for rev in range(500)]
    df = spark.createDataFrame(data, "rev long, op string, key string, value string, expected string")
    _, outcomes = replay_by_hand(data)
    got = keyed_maps.conditional_replay(df, width=150, index_width=64).collect()
    assert {r["rev"]: (r["epoch"], r["previous"], r["applied"], r["current"]) for r in got} == outcomes


@pytest.mark.parametrize("width", [4, 1 << 18])
def test_next_where(spark, width):
    rng = random.Random(3)
    data = [(at, rng.choice("ab"), rng.random() < 0.1) for at in range(0, 300, 2)]
    df = spark.createDataFrame(data, "at long, k string, f boolean")
    for by in ([], ["k"]):
        got = ordered.next_where(df, F.col("f"), "at", "nxt", partition_by=by, width=width).collect()
        assert {r["at"]: r["nxt"] for r in got} == {
            at: next((b for b, o, f in data if b > at and f and (not by or o == k)), None) for at, k, _ in data}


def test_snapshot_equals_final_map(spark):
    rng = random.Random(9)
    data = [(rev, rng.choice(["put", "remove", "putIfAbsent"] + ["clear"] * (rev % 17 == 0)),
             rng.choice("abcd"), rng.choice("pqr"), None) for rev in range(200)]
    data.append((200, "put", "z", "p", None))
    df = spark.createDataFrame(
        data, "rev long, op string, key string, value string, expected string")
    snap = keyed_maps.snapshot(keyed_maps.conditional_replay(df))
    assert {tuple(r) for r in snap.collect()} == {
        tuple(r) for r in keyed_maps.final_map(df).collect()}


@pytest.mark.parametrize("width", [5, 1 << 18])
def test_duplicates(spark, width):
    rng = random.Random(6)
    data = [(rng.choice([1, 1, 1, 1, 2, 3, -1, -9999]), at) for at in range(0, 600, 2)]
    want, seen = set(), set()
    for value, at in data:
        if value in (-1, -9999):
            seen = set()
        if value in seen:
            want.add((value, at))
        seen.add(value)
    df = spark.createDataFrame(rng.sample(data, len(data)), "value long, offset long")
    got = duplicates.duplicates_report(df, "value", "offset", width=width).collect()
    assert {(r["value"], r["offset"]) for r in got} == want
