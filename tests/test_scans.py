"""Scans by chunks give what one window gives: null keys and times, ties, empty tables, cuts anywhere."""

import random

import pytest
from pyspark.sql import functions as F

from compare import rows
from vivarium.operators import rig, scans, timeops
from vivarium.operators.rig import S

CHUNKS = (1, 7, 1000)
SCHEMA = "session_id string, seq long, t_us long, v long, flip int, level int"


def log(spark, seed, n=120):
    r = random.Random(seed)
    data = [(r.choice(["a", "b", None]), i, r.choice([None, *range(40)]), r.choice([None, 1, 2, 3]), r.choice([None, 1]), r.choice([None, None, 0, 1])) for i in range(n)]
    return spark.createDataFrame(data, SCHEMA)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("join", [timeops.asof, timeops.next_after])
def test_joins_by_time(spark, join, how):
    left, right = log(spark, 1).select("session_id", "seq", "t_us", "v"), log(spark, 2, 40).select("session_id", "seq", "t_us", "level")
    want = rows(join(left, right, S, how=how).toPandas())
    assert how == "inner" or len(want) == 120
    for chunk in CHUNKS:
        assert rows(join(left, right, S, how=how, chunk=chunk).toPandas()) == want
    assert join(left.limit(0), right, S, how=how, chunk=7).count() == 0 and join(left, right.limit(0), S, how="left", chunk=7).count() == 120


def test_asof_keeps_left_rows(spark):
    left = spark.createDataFrame([("a", 1, 5), (None, 2, 5), ("a", 3, None)], "session_id string, seq long, t_us long")
    right = spark.createDataFrame([("a", 1, 3, "x"), (None, 9, 4, "y")], "session_id string, seq long, t_us long, v string")
    for chunk in (None, *CHUNKS):
        got = {r.seq: r.r_v for r in timeops.asof(left, right, S, how="left", chunk=chunk).collect()}
        assert got == {1: "x", 2: "y", 3: None}


@pytest.mark.parametrize("chunk", CHUNKS)
def test_numbers_neighbours_and_sums(spark, chunk):
    df = log(spark, 3)
    for f in (
        lambda c: scans.numbered(df, S, chunk=c),
        lambda c: scans.neighbours(df, S, {"p": "v", "q": "t_us"}, chunk=c),
        lambda c: scans.neighbours(df, S, {"p": "v", "q": "t_us"}, chunk=c, backwards=True),
        lambda c: scans.summed(df, S, F.col("v"), "s", chunk=c),
        lambda c: timeops.current_value(df, S, F.col("v"), "now", chunk=c),
        lambda c: timeops.zip_ordinal(df, df.where("v = 1"), S, chunk=c),
        lambda c: timeops.combine_all({"x": (df, "v"), "y": (df.where("v is null"), "level"), "z": (df, "flip")}, S, chunk=c),
    ):
        assert rows(f(chunk).toPandas()) == rows(f(None).toPandas())
    assert scans.numbered(df.limit(0), S, chunk=chunk).count() == 0


def test_numbers_are_those_of_the_order(spark):
    got = {(r.session_id, r.n): r.seq for r in scans.numbered(log(spark, 4), S, chunk=7).collect()}
    want = {}
    for key in ("a", "b", None):
        ordered = sorted((r for r in log(spark, 4).collect() if r.session_id == key), key=lambda r: (r.t_us is not None, r.t_us or 0, r.seq))
        want |= {(key, i + 1): r.seq for i, r in enumerate(ordered)}
    assert got == want


def brute_switch(data):
    """seq to state, and spans (seq, n, start, end), of rows in order."""
    states, spans, state, n = {}, [], 0, 0
    for r in data:
        old, state = state, r.level if r.level is not None else state ^ (r.flip or 0)
        states[r.seq] = state
        if (old, state) == (0, 1):
            n += 1
            spans.append([r.seq, n, r.t_us, None])
        elif (old, state) == (1, 0):
            spans[-1][3] = r.t_us
    return states, spans


@pytest.mark.parametrize("chunk", [None, *CHUNKS])
@pytest.mark.parametrize("seed", [5, 6])
def test_switches_are_composed_maps(spark, seed, chunk):
    df = log(spark, seed)
    data = df.collect()
    states, spans = {}, []
    for key in ("a", "b", None):
        x, y = brute_switch(sorted((r for r in data if r.session_id == key), key=lambda r: (r.t_us is not None, r.t_us or 0, r.seq)))
        states |= x
        spans += y
    assert {r.seq: r.x for r in scans.switched(df, S, "level", "flip", "x", chunk=chunk).collect()} == states
    got = [[r.seq, r.n, r.start_us, r.end_us] for r in scans.switch_spans(df, S, "level", "flip", chunk=chunk).collect()]
    assert sorted(got, key=lambda x: x[0]) == sorted(spans, key=lambda x: x[0])
    assert scans.switch_spans(df.limit(0), S, "level", "flip", chunk=chunk).count() == 0


def test_one_exchange_serves_both_passes(spark):
    df = log(spark, 7).select("session_id", "seq", "t_us")
    out = scans.neighbours(df.repartition(3), S, {"p": "t_us"}, chunk=7)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("chunk", CHUNKS)
def test_automaton(spark, chunk):
    df = log(spark, 8).select("session_id", "seq", "t_us", (F.col("v") - 1).alias("v"))
    table = [[1, 2, 0], [2, 2, 1], [0, 0, 0]]
    want = {}
    for key in ("a", "b", None):
        q = 0
        for r in sorted((r for r in df.collect() if r.session_id == key), key=lambda r: (r.t_us is not None, r.t_us or 0, r.seq)):
            p, q = q, q if r.v is None else table[r.v][q]
            want[r.seq] = (p, q)
    got = scans.automaton(df, S, "v", table, "q", chunk=chunk)
    assert {r.seq: (r.q_before, r.q) for r in got.collect()} == want
    assert scans.automaton(df.limit(0), S, "v", table, "q", chunk=chunk).count() == 0


EXPECTED = {rig.ODOR_CLOSED: 10, rig.NORMAL_DONE: 20, rig.VACUUM_OPEN: 20, rig.FLUSHING: 25, rig.FLUSHED: 25, rig.ODOR_FIRST: 25, rig.CHARGING: 0, rig.VACUUM_DONE: 70}
NORMAL = [(0, 0, 0), (10, 5, 0), (30, 6, 1)]
VACUUM = [(0, 0, 0), (10, 5, 0), (30, 2, 1), (55, 0, 1), (80, 0, 0), (80, 6, 1), (150, 2, 0)]
LATE = [(t + 9 * (k == 3), line, state) for k, (t, line, state) in enumerate(VACUUM)]
CASES = [
    (NORMAL, "normal", 2, "complete"),
    (VACUUM, "vacuum", 6, "complete"),
    ([VACUUM[i] for i in (0, 1, 2, 3, 5, 4, 6)], "vacuum", 6, "complete"),
    (LATE, "vacuum", 6, "late"),
    ([(t + 7 * (t == 30), line, state) for t, line, state in NORMAL], "normal", 2, "late"),
    (NORMAL[:1] + NORMAL[2:], None, 0, "step missing"),
    (VACUUM[:3] + VACUUM[5:], "vacuum", 2, "step missing"),
    (VACUUM[:2] + [(12, 0, 1)], None, 1, "out of order"),
    (VACUUM[:5], "vacuum", 4, "unfinished"),
    (NORMAL[:2] + [(15, 3, 1)] + NORMAL[2:], "normal", 2, "complete"),
]


@pytest.mark.parametrize("chunk", [13_000, 1_000, 10**9])
def test_switch_patterns(spark, chunk):
    """Times are milliseconds; each case is a session, twice over, and cuts fall inside of switches."""
    data = [(f"s{i:02d}", k * 100 + n, (k * 1000 + t) * 1000, line, state) for i, (steps, *_) in enumerate(CASES) for k in range(2) for n, (t, line, state) in enumerate(steps)]
    changes = spark.createDataFrame(data, "session_id string, seq long, t_us long, line int, state int")
    role = F.when(F.col("line") == 0, "port").when(F.col("line") == 2, "vacuum").when(F.col("line") >= 5, "odor")
    got = rig.switch_patterns(changes, role, {k: v * 1000 for k, v in EXPECTED.items()}, 5000, chunk)
    found = [(r.session_id, r.switch_no, r.start_us, r.mode, r.steps, r.verdict) for r in got.orderBy("session_id", "switch_no").collect()]
    assert found == [(f"s{i:02d}", k + 1, k * 1_000_000, mode, n, verdict) for i, (_, mode, n, verdict) in enumerate(CASES) for k in range(2)]
