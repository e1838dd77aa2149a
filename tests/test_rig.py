"""Small golden cases; times are seconds, held as microseconds."""

import random

import pytest
from pyspark.sql import functions as F

from vivarium.functions import columns as C
from vivarium.operators import rig, timeops
from vivarium.operators.rig import S

US = 1_000_000


def events(spark, rows):
    """rows: seconds, address, value"""
    return spark.createDataFrame([("s", i, int(round(t * US)), a, v) for i, (t, a, v) in enumerate(rows)], "session_id string, seq long, t_us long, address int, value long")


def seconds(df, *columns):
    return [tuple(None if r[c] is None else r[c] / US for c in columns) for r in df.orderBy(columns[0]).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()[0]


def test_edges(spark):
    m = rig.beam(events(spark, [(0, 32, 0), (1, 32, 0x11), (2, 32, 1), (3, 32, 0), (4, 32, 1)]))
    assert m.where("level").count() == 3
    assert seconds(rig.beam_breaks(rig.beam_edges(m)), "start_us", "end_us") == [(1, 3), (4, None)]


@pytest.mark.parametrize("rows,want", [([(1, 1), (1.005, 0), (2, 1), (2.5, 0)], [2.01]), ([(1, 1), (1.01, 0)], [1.01])])
def test_sustained(spark, rows, want):
    m = rig.beam(events(spark, [(t, 32, v) for t, v in rows]))
    assert [x for (x,) in seconds(rig.sustained(m, 10_000), "armed_us")] == want


@pytest.mark.parametrize("rows,end", [([(2, 1), (2.05, 0)], 2.11), ([(2, 1), (2.05, 0), (2.08, 1), (2.4, 0)], 2.4), ([(2, 1)], 10.11)])
def test_delivery(spark, rows, end):
    m = rig.beam(events(spark, [(t, 32, v) for t, v in rows]))
    first = rig.sustained(m, 10_000).where(f"t_us = {2 * US}")
    assert seconds(rig.deliveries(m, first, 100_000, 8 * US), "end_us") == [(end,)]


def test_flush_is_no_delivery(spark):
    e = events(spark, [(5, 35, 4), (5.025, 35, 1), (5.05, 36, 1), (5.12, 36, 4), (6, 35, 1), (7, 36, 1)])
    v = rig.valve_intervals(e)
    assert v.where("line = 0").count() == 2
    assert seconds(rig.port_deliveries(v, 0, 2), "start_us", "end_us") == [(6, 7)]


def test_clear_all_closes_once(spark):
    e = events(spark, [(0, 35, 64), *[(1 + i / 10, 36, 1 << x) for i, x in enumerate((6, 6, 7, 7, 7, 8, 8, 9))]])
    assert [(r.line, r.state) for r in rig.line_changes(rig.line_states(e)).orderBy("t_us").collect()] == [(6, 1), (6, 0)]


def test_toggle_and_state(spark):
    e = events(spark, [(0, 35, 64), (1, 37, 64), (2, 37, 64), (3, 36, 64), (4, 38, 64), (5, 37, 64)])
    assert [r.state for r in rig.line_states(e).where("line = 6").orderBy("t_us").collect()] == [1, 0, 1, 0, 1, 0]


def test_windows(spark):
    def win(times):
        m = rig.beam(events(spark, [(t, 32, 1) for t in times]))
        return seconds(rig.video_windows(m, int(2.5 * US), int(2.5 * US)), "start_us", "end_us")

    assert win([10, 14, 30]) == [(7.5, 16.5), (27.5, 32.5)]
    assert win([10, 15]) == [(7.5, 17.5)]
    m = rig.beam(events(spark, [(10, 32, 1), (14, 32, 0)]))
    assert seconds(rig.video_windows(m, 2 * US, 3 * US, "offset"), "start_us", "end_us") == [(8, 17)]


def test_roi_gate(spark):
    onsets = events(spark, [(1, 32, 1), (3, 32, 1), (5, 32, 1)])
    flags = spark.createDataFrame([("s", 100, 2 * US, False), ("s", 101, 4 * US, True)], "session_id string, seq long, t_us long, flag boolean")
    assert seconds(rig.roi_gated(onsets, flags), "t_us") == [(5,)]


def test_asof_and_next(spark):
    left = events(spark, [(0, 1, 0), (1, 1, 0), (2, 1, 0), (4, 1, 0)])
    right = spark.createDataFrame([("s", 9, US, "a"), ("s", 10, 3 * US, "b")], "session_id string, seq long, t_us long, v string")
    assert [(r.t_us // US, r.r_v) for r in timeops.asof(left, right, S).orderBy("t_us").collect()] == [(1, "a"), (2, "a"), (4, "b")]
    assert [r.n_v for r in timeops.next_after(left, right, S).orderBy("t_us").collect()] == ["a", "b", "b", None]
    assert timeops.asof(left.limit(0), right, S).count() == 0 and timeops.asof(left, right.limit(0), S).count() == 0


def test_combine_and_zip(spark):
    a, b = events(spark, [(1, 1, 11), (3, 1, 13)]), events(spark, [(2, 1, 22)])
    assert [(r.t_us // US, r.a, r.b) for r in timeops.combine_latest(a, b, S, "value", "value").orderBy("t_us").collect()] == [(2, 11, 22), (3, 13, 22)]
    assert timeops.zip_ordinal(events(spark, [(i, 1, 0) for i in range(3)]), events(spark, [(i, 1, 0) for i in range(2)]), S).count() == 2


def test_interval_join_over_buckets(spark):
    spans = spark.createDataFrame([("s", 5, 100)], "session_id string, a long, b long")
    points = spark.createDataFrame([("s", x) for x in (4, 5, 50, 99, 100)], "session_id string, t_us long")
    assert sorted(r.t_us for r in timeops.interval_join(points, spans, S, "a", "b", unit=10).collect()) == [5, 50, 99]


@pytest.mark.parametrize("unit,levels", [(1, 24), (7, 3), (1000, 2)])
def test_interval_join_of_overlapping_spans(spark, unit, levels):
    r = random.Random(unit)
    spans = [(r.choice("ab"), i, (a := r.randrange(-200, 3000)), r.choice([None, a, a - 5, a + 1, a + r.randrange(1, 3000)])) for i in range(60)] + [("a", 90, None, 5), (None, 91, 1, 900)]
    points = [(r.choice("ab"), r.randrange(-300, 3500)) for _ in range(150)] + [("a", None), (None, 5)]
    want = sorted((k, t, i) for k, t in points for s, i, a, b in spans if k and k == s and t is not None and a is not None and a <= t and (b is None or t < b))
    p = spark.createDataFrame(points, "session_id string, t_us long")
    x = spark.createDataFrame(spans, "session_id string, i int, a long, b long")
    got = timeops.interval_join(p, x, S, "a", "b", unit=unit, levels=levels)
    assert sorted((y.session_id, y.t_us, y.i) for y in got.collect()) == want
    assert timeops.interval_join(p.limit(0), x, S, "a", "b").count() == 0 and timeops.interval_join(p, x.limit(0), S, "a", "b").count() == 0


def test_pieces_grow_with_the_logarithm(spark):
    for a, b in [(0, 1), (5, 6), (3, 1_000_003), (1, 1 << 20), (7, 7 + (1 << 23))]:
        got = one(spark, timeops.pieces(F.lit(a), F.lit(b), 24))
        assert len(got) <= 2 * 24 and sorted(y for x in got for y in (x.k << x.level, (x.k + 1) << x.level)) == sorted([a, b] + [y for y in (x.k << x.level for x in got) if y != a] * 2)


def test_region_sums(spark):
    r = random.Random(2)
    strips = [("s", t, y, [r.randrange(120) for _ in range(r.choice([20, 30]))]) for t in (1, 2) for y in range(12)] + [("s", 1, 3, [1] * 5), ("s", 2, 4, None), ("s", 2, 5, [])]
    regions = [(i, x, x + r.randrange(25), y, y + r.randrange(8)) for i in range(80) for x, y in [(r.randrange(25), r.randrange(12))]]
    want = {}
    for s, t, y, pixels in strips:
        for i, x0, x1, y0, y1 in regions:
            if pixels is not None and y0 <= y <= y1:
                want[t, i] = want.get((t, i), 0) + sum(255 for v in pixels[x0 : x1 + 1] if v <= 59)
    df = spark.createDataFrame(strips, "session_id string, t_us long, y int, pixels array<int>")
    got = rig.region_sums(df, spark.createDataFrame(regions, "region int, x0 int, x1 int, y0 int, y1 int"))
    assert {(x.t_us, x.region): x.activity for x in got.collect()} == want
    assert rig.roi_sum(df, 2, 9, 1, 4).count() == 2


def test_collections(spark):
    arr = lambda *x: F.array(*[F.lit(i) for i in x])
    assert one(spark, C.bag_remove(arr("B", "B", "C"), F.lit("B"), arr("B", "B", "C"))) == ["B", "C"]
    assert one(spark, C.bag_remove(arr("C"), F.lit("C"), arr("B", "B", "C"))) == ["B", "B", "C"]
    m = F.create_map(F.lit("A"), arr("B"))
    assert one(spark, C.get_or_default(m, F.lit("Z"))) == ["DefaultState"] and one(spark, C.strict_get(m, F.lit("A"))) == ["B"]
    with pytest.raises(Exception, match="no such key"):
        one(spark, C.strict_get(m, F.lit("Z")))
    assert one(spark, C.line_choice(F.lit(4), F.lit(2))) == "clear" and one(spark, C.on_off(F.lit(True))) == "On"
    assert str(one(spark, C.board_time(F.lit(3786912000.5), 2082844800))) == "2024-01-01 00:00:00.500000"


def test_rule_dialects(spark):
    raw = spark.createDataFrame([("r1", '{"A":["B","C"]}'), ("r2", '{"A":"B"}'), ("r3", '{"A":[{"name":"B","probability":0.5},{"name":"C"}]}')], "rule_alias string, transitions string")
    got = {(r.rule_alias): r.transitions for r in rig.rule_map(rig.rule_rows(raw), ["rule_alias"]).collect()}
    assert got == {"r1": {"A": ["B", "C"]}, "r2": {"A": ["B"]}, "r3": {"A": ["B", "C"]}}


def test_two_step_rules_are_contracted(spark):
    rows = spark.createDataFrame([("r", "A", 0, "DefaultState"), ("r", "DefaultState", 0, "A"), ("r", "DefaultState", 1, "B"), ("r", "B", 0, "A")], "rule_alias string, from_state string, place int, to_state string")
    assert sorted((r.from_state, r.to_state) for r in rig.contracted(rows).collect()) == [("A", "A"), ("A", "B"), ("B", "A")]


def test_switch_audit(spark):
    changes = rig.line_changes(rig.line_states(events(spark, [(0, 35, 65), (1, 36, 1), (1.01, 36, 64), (1.04, 35, 128)])))
    role = F.when(F.col("line") == 0, "port").otherwise("odor")
    rows = rig.switch_audit(changes, {"port 0>odor 0": 10_000, "odor 0>odor 1": 20_000}, 5_000, role).orderBy("t_us").collect()
    assert [(r.step, r.gap_us, r.ok) for r in rows] == [("port 0>odor 0", 10_000, True), ("odor 0>odor 1", 30_000, False)]


def test_rule_map_with_a_state_twice(spark):
    rows = spark.createDataFrame([("r", "A", ["B"]), ("r", "A", ["C"])], "rule_alias string, s string, l array<string>")
    with pytest.raises(Exception, match="DUPLICATED_MAP_KEY"):
        rows.groupBy("rule_alias").agg(F.map_from_entries(F.collect_list(F.struct("s", "l")))).collect()


def draws(spark, targets, epochs=None):
    rows = [("s", i, i, (epochs or [0] * 99)[i], "A", t, ["B", "B", "C"]) for i, t in enumerate(targets)]
    return spark.createDataFrame(rows, "session_id string, seq long, t_us long, rule_epoch long, source string, target string, options array<string>")


@pytest.mark.parametrize("targets,epochs,ok", [("BCBBBC", None, True), ("BBB", None, False), ("BBBC", [0, 1, 1, 1], True)])
def test_bags(spark, targets, epochs, ok):
    assert all(r.ok for r in rig.bag_conformance(draws(spark, targets, epochs)).collect()) == ok


def test_rule_switch_modes(spark):
    steps = spark.createDataFrame([("s", 1, 10, 6, ["B"], 7, ["C"], 30, 2)], "session_id string, seq long, t_us long, line int, candidates array<string>, to_line int, to_candidates array<string>, to_t_us long, to_seq long")
    rules = spark.createDataFrame([("s", 0, 5, "abc", {"B": ["C"]}), ("s", 9, 20, "cba", {"B": ["A"]})], "session_id string, seq long, t_us long, rule_alias string, transitions map<string,array<string>>")
    assert rig.rule_conformance(steps, rules).first().verdict == "ok"
    assert rig.rule_conformance(steps, rules, "as_specified").first().verdict == "violation"


def test_camera_modes_roi_sum_and_dropped(spark):
    e = events(spark, [(1, 68, 1), (2, 68, 4), (3, 68, 5)])
    assert rig.camera_triggers(e).count() == 1 and rig.camera_triggers(e, "bit").count() == 2
    strip = spark.createDataFrame([("s", 1, 800, [10, 59, 60, 200])], "session_id string, t_us long, y int, pixels array<int>")
    assert rig.roi_sum(strip, 0, 3, 722, 961).first().activity == 510
    frames = spark.createDataFrame([("s", i, i, c) for i, c in enumerate((5, 6, 9))], "session_id string, seq long, t_us long, hw_counter long")
    assert [r.dropped for r in rig.dropped_frames(frames).orderBy("t_us").collect()] == [None, 0, 2]


def test_wait(spark):
    ticks = events(spark, [(1 + i / 1000, 68, 1) for i in range(1, 20)])
    fired = rig.wait_elapsed(events(spark, [(1.0004, 32, 1)]), ticks, 10_000)
    assert seconds(fired, "fired_us") == [(1.011,)]


def test_empty(spark):
    e = events(spark, [(0, 32, 1)]).limit(0)
    assert rig.beam_breaks(rig.beam(e)).count() == 0
    assert rig.valve_intervals(e).count() == 0
