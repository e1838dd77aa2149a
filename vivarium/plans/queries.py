"""One query for each operator of the rig log, with its SQL. Each reads the given tables whole."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .. import model
from ..functions import columns as C
from ..operators import rig, scans, timeops
from ..operators.rig import S
from ..operators.timeops import HOUR
from . import adapter as A
from .adapter import BEAM, HARP, RULE_ROWS, SESSION_LINES, TWO_STEP_ROWS, VALVES, harp, line_map, odor_map, session_lines, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None, *parts: str, recursive: bool = False):
    """Registers a function under its name; parts: the views that its SQL builds on."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = ("WITH RECURSIVE " if recursive else "WITH ") + ",".join((HARP, *parts)) + sql
        return f

    return add


def beam(spark, d):
    return rig.beam(harp(spark, d))


def valves(spark, d):
    return rig.valve_intervals(harp(spark, d))


def rule_maps(spark):
    """rule, rule_alias, sample_with_replacement, transitions (a map)."""
    return rig.rule_map(rig.rule_rows(A.rule_rows(spark)), ["rule", "rule_alias", "sample_with_replacement"])


def rule_names(spark, d):
    """session_id, t_us, seq, rule, rule_alias, sample_with_replacement at each change, without the maps."""
    fixed = A.rule_rows(spark).drop("transitions")
    return rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "t_us", "seq", F.expr("k % 3").cast("int").alias("rule")).join(F.broadcast(fixed), "rule")


def rule_changes(spark, d):
    """session_id, t_us, seq, rule, rule_alias, sample_with_replacement, transitions (a map)."""
    return rule_names(spark, d).join(F.broadcast(rule_maps(spark).select("rule", "transitions")), "rule")


def sequence(spark, d):
    return rig.state_sequence(valves(spark, d), odor_map(spark, d), A.ODORS)


# Scans and filters


@query(" SELECT session_id, seq, t_us, value FROM h WHERE address = 35")
def register_scan(spark, d):
    return rig.register(harp(spark, d), model.OUT_SET).select("session_id", "seq", "t_us", "value")


@query(" SELECT session_id, seq, t_us, level FROM beam", BEAM)
def aux_state(spark, d):
    return beam(spark, d).select("session_id", "seq", "t_us", "level")


@query(" SELECT session_id, t_us / 1e6 AS t_seconds, value FROM h WHERE address = 68")
def hardware_clock(spark, d):
    return rig.register(harp(spark, d), model.PWM_RISE).select("session_id", (F.col("t_us") / 1e6).alias("t_seconds"), "value")


@query(" SELECT session_id, seq, t_us FROM beam WHERE level", BEAM)
def poke_onset_messages(spark, d):
    return beam(spark, d).where("level").select("session_id", "seq", "t_us")


@query(" SELECT session_id, seq, t_us FROM h WHERE address = 68 AND value = 1")
def camera_triggers(spark, d):
    return rig.camera_triggers(harp(spark, d)).select("session_id", "seq", "t_us")


@query(" SELECT session_id, seq, t_us, (k % 10)::INT AS line FROM h WHERE address = 35 AND k % 10 IN (SELECT line FROM lm)")
def known_lines(spark, d):
    rows = rig.register(harp(spark, d), model.OUT_SET).select("session_id", "seq", "t_us", F.expr("k % 10").cast("int").alias("line"))
    return rows.join(F.broadcast(line_map(spark, d)), "line", "left_semi").select("session_id", "seq", "t_us", "line")


@query(" SELECT session_id, seq, t_us, amount FROM h WHERE amount > 50")
def roi_threshold(spark, d):
    return harp(spark, d).where("amount > 50").select("session_id", "seq", "t_us", "amount")


@query(" SELECT vec_id, embedding[1]::DOUBLE AS \"Angle\", embedding[2]::DOUBLE AS \"Magnitude\" FROM embeddings")
def payload_split(spark, d):
    parts = model.PAYLOAD_PARTS["MagneticEncoder"]
    return table(spark, d, "embeddings").select("vec_id", *[F.col("embedding")[i].cast("double").alias(n) for i, n in enumerate(parts)])


@query(" SELECT address, CASE address WHEN 32 THEN 'AuxInState' WHEN 35 THEN 'OutputSet' WHEN 36 THEN 'OutputClear' WHEN 68 THEN 'PwmRiseEvent' END AS name, CASE WHEN address IN (32, 68) THEN 'U8' ELSE 'U16' END AS type, count(*) AS messages FROM h GROUP BY 1, 2, 3")
def register_names(spark, d):
    counted = harp(spark, d).groupBy("address").agg(F.count(F.lit(1)).alias("messages"))
    return counted.join(F.broadcast(model.register_dim(spark)), "address").select("address", "name", "type", "messages")


@query(" SELECT b.session_id, b.seq, b.t_us, r.rule % 2 = 0 AS use_vacuum FROM beam b ASOF JOIN rules r ON b.session_id = r.session_id AND b.t_us >= r.t_us WHERE b.level", BEAM)
def vacuum_mode(spark, d):
    settings = rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "t_us", "seq", F.expr("k % 3 % 2 = 0").alias("use_vacuum"))
    return timeops.asof(beam(spark, d).where("level").select("session_id", "seq", "t_us"), settings, S, "s_").select("session_id", "seq", "t_us", F.col("s_use_vacuum").alias("use_vacuum"))


@query(" SELECT session_id, seq, t_us, k FROM h WHERE k IS NOT NULL")
def json_metadata(spark, d):
    e = table(spark, d, "events").withColumn("v", F.parse_json("props"))
    k = F.coalesce(F.try_variant_get("v", "$.k", "int"), F.try_variant_get("v", "$.K", "int"))
    return e.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"), k.alias("k")).where("k is not null")


@query(" SELECT session_id, seq, coalesce(CASE WHEN k % 4 = 0 THEN k / 10.0 END, 0.2)::DOUBLE AS charge_time, coalesce(CASE WHEN k % 5 = 0 THEN k / 1.0 END, 8.0)::DOUBLE AS max_delivery FROM h WHERE address = 68")
def settings_defaults(spark, d):
    given = rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "seq", F.when(F.expr("k % 4 = 0"), F.col("k") / 10).alias("chargeTime"), F.when(F.expr("k % 5 = 0"), F.col("k") / 1).alias("maxOdorDelivery"))
    filled = given.fillna({k: v for k, v in model.SESSION_DEFAULTS.items() if k in given.columns})
    return filled.select("session_id", "seq", F.col("chargeTime").alias("charge_time"), F.col("maxOdorDelivery").alias("max_delivery"))


@query(" SELECT session_id, seq, t_us, t_us // 3600000000 AS file_hour, row_number() OVER (PARTITION BY t_us // 3600000000 ORDER BY t_us, seq) - 1 AS _frame FROM h")
def video_frames(spark, d):
    rows = harp(spark, d).withColumn("file_hour", F.floor(F.col("t_us") / HOUR))
    return rows.select("session_id", "seq", "t_us", "file_hour", (F.row_number().over(Window.partitionBy("file_hour").orderBy("t_us", "seq")) - 1).cast("long").alias("_frame"))


@query(" SELECT session_id, seq, t_us, rule_alias, lead(t_us) OVER (PARTITION BY session_id ORDER BY t_us, seq) AS until_us FROM rules")
def rule_history(spark, d):
    return rule_names(spark, d).select("session_id", "seq", "t_us", "rule_alias", F.lead("t_us").over(rig.by_time()).alias("until_us"))


# Scalar functions


@query(" SELECT session_id, seq, (1 << (k % 10))::INT AS mask FROM h")
def line_mask(spark, d):
    return harp(spark, d).select("session_id", "seq", C.line_mask(F.expr("k % 10")).alias("mask"))


@query(" SELECT session_id, seq, array_to_string(list_filter(range(0, 10), lambda i: (k >> i) & 1 = 1), ',') AS lines, array_to_string(list_transform(list_filter(range(0, 10), lambda i: (k >> i) & 1 = 1), lambda i: 'Out' || i), ',') AS names FROM h")
def mask_decode(spark, d):
    k = F.col("k").cast("long")
    return harp(spark, d).select("session_id", "seq", F.array_join(F.transform(C.mask_lines(k), lambda i: i.cast("string")), ",").alias("lines"), F.array_join(C.mask_names(k, model.BIT_MASKS["DigitalOutputs"]), ",").alias("names"))


@query(" SELECT session_id, seq, CASE k WHEN 0 THEN 'Software' WHEN 1 THEN 'Aux0Rising' WHEN 2 THEN 'Aux0Falling' WHEN 3 THEN 'Aux0WhileHigh' WHEN 4 THEN 'Aux0WhileLow' WHEN 16 THEN 'Aux1Rising' WHEN 32 THEN 'Aux1Falling' WHEN 64 THEN 'Aux1WhileHigh' END AS trigger_source FROM h")
def group_decode(spark, d):
    return harp(spark, d).select("session_id", "seq", C.group_name(F.col("k"), model.GROUP_MASKS["TriggerSource"]).alias("trigger_source"))


@query(" SELECT c.session_id, c.seq, r.name IS NOT NULL AND EXISTS (SELECT 1 FROM rr WHERE rr.rule = c.k % 3 AND rr.from_state = r.name) AS found FROM h c LEFT JOIN (SELECT r_name AS name, r_regionkey FROM region) r ON r.r_regionkey = c.k % 5 WHERE c.address = 68", RULE_ROWS)
def map_contains_key(spark, d):
    return _probes(spark, d).select("session_id", "seq", F.map_contains_key("transitions", F.col("name")).alias("found"))


@query(" SELECT c.session_id, c.seq, EXISTS (SELECT 1 FROM lm WHERE lm.line = c.k % 12) AS found FROM h c")
def map_contains_value(spark, d):
    names = line_map(spark, d).groupBy("name").agg(F.max("line").alias("line"))
    lines = names.agg(F.map_from_entries(F.collect_list(F.struct("name", "line"))).alias("lines")).withColumn("one", F.lit(1))  # one row
    return harp(spark, d).withColumn("one", F.lit(1)).join(F.broadcast(lines), "one").select("session_id", "seq", C.contains_value(F.col("lines"), F.expr("cast(k % 12 as int)")).alias("found"))


@query(" SELECT c.session_id, c.seq, coalesce((SELECT string_agg(to_state, ',' ORDER BY place) FROM rr WHERE rr.rule = c.k % 3 AND rr.from_state = r.r_name), 'DefaultState') AS targets FROM h c JOIN region r ON r.r_regionkey = c.k % 5 WHERE c.address = 68", RULE_ROWS)
def map_get_default(spark, d):
    return _probes(spark, d).select("session_id", "seq", F.array_join(C.get_or_default(F.col("transitions"), F.col("name")), ",").alias("targets"))


def _probes(spark, d):
    names = table(spark, d, "region").select(F.col("r_regionkey").alias("region_no"), F.col("r_name").alias("name"))
    rows = rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "seq", F.expr("cast(k % 5 as bigint)").alias("region_no")).join(F.broadcast(names), "region_no")
    return rows.join(rule_changes(spark, d).select("session_id", "seq", "transitions"), ["session_id", "seq"])


@query(" SELECT session_id, seq, CASE k % 4 WHEN 0 THEN '0,1,1,2' WHEN 1 THEN '0,1,2' WHEN 2 THEN '0,1,1' ELSE '0,1,1,2' END AS bag FROM (SELECT session_id, seq, CASE WHEN k % 4 = 3 THEN 0 ELSE k END AS k FROM h) q")
def bag_remove(spark, d):
    # A list without its first 0, 1 or 2 of (0, 1, 1, 2); taking 0 from the list of only 0 gives the whole list back.
    whole = F.array(*[F.lit(i) for i in (0, 1, 1, 2)])
    k = F.expr("k % 4")
    bag = F.when(k == 3, F.array(F.lit(0))).otherwise(whole)
    item = F.when(k == 0, F.lit(9)).when(k == 3, F.lit(0)).otherwise(k)
    return harp(spark, d).select("session_id", "seq", F.array_join(F.transform(C.bag_remove(bag, item, whole), lambda x: x.cast("string")), ",").alias("bag"))


@query(" SELECT session_id, seq, (SELECT x FROM (VALUES (0, 'a'), (1, 'a'), (2, 'b'), (3, 'c')) v(i, x) ORDER BY md5(h.seq || '|0|' || i) LIMIT 1) AS drawn FROM h")
def uniform_draw(spark, d):
    return harp(spark, d).select("session_id", "seq", C.uniform_draw(F.array(*[F.lit(x) for x in "aabc"]), F.col("seq")).alias("drawn"))


@query(" SELECT session_id, seq, CASE WHEN kind = 'view' THEN 'On' ELSE 'Off' END AS label, CASE WHEN (value >> (k % 10)) & 1 = 1 THEN 'clear' ELSE 'set' END AS choice FROM h WHERE address IS NOT NULL")
def control_labels(spark, d):
    rows = harp(spark, d).where("address is not null")
    return rows.select("session_id", "seq", C.on_off(F.col("kind") == "view").alias("label"), C.line_choice(F.col("value"), F.expr("k % 10")).alias("choice"))


@query(" SELECT r.session_id, r.seq, (SELECT string_agg(to_state, ',' ORDER BY place) FROM rr WHERE rr.rule = r.rule AND rr.from_state = 'AFRICA') AS targets FROM rules r", RULE_ROWS)
def strict_lookup(spark, d):
    return rule_changes(spark, d).select("session_id", "seq", F.array_join(C.strict_get(F.col("transitions"), F.lit("AFRICA")), ",").alias("targets"))


@query(" SELECT session_id, seq, t_us // 1000 * 1000 - 1000000000000000 AS board_us FROM h")
def board_time(spark, d):
    seconds = F.expr("t_us div 1000") / 1000.0
    return harp(spark, d).select("session_id", "seq", F.unix_micros(C.board_time(seconds, 1_000_000_000)).alias("board_us"))


@query(
    """, n AS (SELECT page_id, url, string_split(url, '/') AS parts FROM pages WHERE url IS NOT NULL)
SELECT page_id, regexp_replace(url, '[.][a-z]+$', '.avi') AS video, CASE WHEN len(parts) >= 3 THEN parts[-3] END AS log FROM n"""
)
def path_pieces(spark, d):
    rows = table(spark, d, "pages").where("url is not null and size(split(url, '/')) >= 3")
    short = table(spark, d, "pages").where("url is not null and size(split(url, '/')) < 3").withColumn("log", F.lit(None).cast("string"))
    both = rows.withColumn("log", C.log_number(F.col("url"))).unionByName(short)
    return both.select("page_id", F.regexp_replace("url", "[.][a-z]+$", ".avi").alias("video"), "log")


@query(" SELECT session_id, strftime(make_timestamp(min(t_us)), '%Y-%m-%dT%H-%M-%S') AS stamp FROM h GROUP BY session_id")
def session_stamp(spark, d):
    first = harp(spark, d).groupBy("session_id").agg(F.min("t_us").alias("t_us"))
    return first.select("session_id", C.session_stamp(F.timestamp_micros("t_us")).alias("stamp"))


@query(" SELECT l.line, string_agg(l.name, ',' ORDER BY l.name) AS labels, max(s.n)::BIGINT AS sets FROM lm l LEFT JOIN (SELECT (k % 10)::INT AS line, count(*) AS n FROM h WHERE address = 35 GROUP BY 1) s ON s.line = l.line GROUP BY l.line")
def line_labels(spark, d):
    labels = line_map(spark, d).groupBy("line").agg(F.array_join(F.array_sort(F.collect_list("name")), ",").alias("labels"))
    sets = rig.register(harp(spark, d), model.OUT_SET).groupBy(F.expr("cast(k % 10 as int)").alias("line")).agg(F.count(F.lit(1)).alias("sets"))
    return labels.join(sets, "line", "left")


# Joins by time and order


@query(" SELECT b.session_id, b.seq, b.t_us, r.t_us AS r_t_us, r.rule_alias FROM beam b ASOF JOIN rules r ON b.session_id = r.session_id AND b.t_us >= r.t_us", BEAM)
def asof_latest(spark, d):
    rules = rule_names(spark, d).select("session_id", "t_us", "seq", "rule_alias")
    return timeops.asof(beam(spark, d).select("session_id", "seq", "t_us"), rules, S).select("session_id", "seq", "t_us", "r_t_us", F.col("r_rule_alias").alias("rule_alias"))


@query(
    """, u AS (SELECT session_id, t_us, seq, value AS a, NULL AS b FROM beam UNION ALL SELECT session_id, t_us, seq, NULL, rule FROM rules)
SELECT * FROM (SELECT session_id, seq, t_us, last_value(a IGNORE NULLS) OVER w AS a, last_value(b IGNORE NULLS) OVER w AS b FROM u WINDOW w AS (PARTITION BY session_id ORDER BY t_us, seq ROWS UNBOUNDED PRECEDING)) WHERE a IS NOT NULL AND b IS NOT NULL""",
    BEAM,
)
def combine_latest(spark, d):
    rules = rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "t_us", "seq", F.expr("k % 3").alias("rule"))
    return timeops.combine_latest(beam(spark, d), rules, S, "value", "rule", chunk=A.CHUNK).select("session_id", "seq", "t_us", "a", "b")


@query(" SELECT r.session_id, r.seq, r.rule_alias, e.t_us AS stamp_us FROM rules r ASOF JOIN (SELECT session_id, t_us, seq FROM h WHERE address <> 68) e ON r.session_id = e.session_id AND r.t_us >= e.t_us")
def settings_stamped(spark, d):
    log = harp(spark, d).where(F.col("address") != model.PWM_RISE).select("session_id", "t_us", "seq")
    return timeops.asof(rule_names(spark, d).select("session_id", "t_us", "seq", "rule_alias"), log, S, "e_", chunk=A.CHUNK, take=["t_us"]).select("session_id", "seq", "rule_alias", F.col("e_t_us").alias("stamp_us"))


_NTH = "row_number() OVER (PARTITION BY session_id ORDER BY t_us, seq) AS n"


@query(f" SELECT a.session_id, a.n, a.seq, b.seq AS b_seq FROM (SELECT *, {_NTH} FROM beam WHERE level) a JOIN (SELECT *, {_NTH} FROM h WHERE address = 35) b USING (session_id, n)", BEAM)
def zip_ordinal(spark, d):
    sets = rig.register(harp(spark, d), model.OUT_SET).select("session_id", "seq", "t_us")
    return timeops.zip_ordinal(beam(spark, d).where("level").select("session_id", "seq", "t_us"), sets, S, chunk=A.CHUNK).select("session_id", "n", "seq", "b_seq")


@query(" SELECT b.session_id, b.seq, b.t_us FROM beam b JOIN (SELECT session_id, min(t_us) AS f FROM rules GROUP BY 1) r ON r.session_id = b.session_id AND b.t_us >= r.f", BEAM)
def after_first_trigger(spark, d):
    return timeops.after_first(beam(spark, d).select("session_id", "seq", "t_us"), rig.register(harp(spark, d), model.PWM_RISE), S)


@query(
    """, f AS (SELECT session_id, min(t_us) AS f FROM rules GROUP BY 1)
SELECT b.session_id, b.seq, b.t_us FROM beam b JOIN f ON f.session_id = b.session_id AND b.t_us >= f.f
UNION ALL SELECT session_id, seq, f FROM (SELECT b.session_id, b.seq, f.f, row_number() OVER (PARTITION BY b.session_id ORDER BY b.t_us DESC, b.seq DESC) AS n FROM beam b JOIN f ON f.session_id = b.session_id AND b.t_us < f.f) WHERE n = 1""",
    BEAM,
)
def after_first_replayed(spark, d):
    return timeops.after_first(beam(spark, d).select("session_id", "seq", "t_us"), rig.register(harp(spark, d), model.PWM_RISE), S, replay=True)


@query(" SELECT session_id, seq, t_us, armed_us, off_us FROM pokes", BEAM)
def sustained_pokes(spark, d):
    return rig.sustained(beam(spark, d), A.MIN_POKE)


@query(" SELECT h.session_id, h.seq, l.name, l.line FROM h JOIN region r ON r.r_regionkey = h.k % 5 JOIN lm l ON l.name = r.r_name WHERE h.address = 35")
def line_lookup(spark, d):
    names = table(spark, d, "region").select(F.col("r_regionkey").alias("region_no"), F.col("r_name").alias("name"))
    commands = rig.register(harp(spark, d), model.OUT_SET).select("session_id", "seq", F.expr("cast(k % 5 as bigint)").alias("region_no")).join(F.broadcast(names), "region_no")
    return commands.join(F.broadcast(line_map(spark, d)), "name").select("session_id", "seq", "name", "line")


@query(" SELECT o.session_id, o.seq, o.line, a.candidates FROM odor o JOIN (SELECT line, string_agg(DISTINCT name, ',' ORDER BY name) AS candidates FROM lm WHERE role = 'odor' GROUP BY line) a ON a.line = o.line", VALVES)
def line_aliases(spark, d):
    opened = valves(spark, d).where(F.col("line").isin(*A.ODORS))
    return opened.join(F.broadcast(rig.aliases(line_map(spark, d))), "line").select("session_id", "seq", "line", F.array_join("candidates", ",").alias("candidates"))


@query(" SELECT h.session_id, h.seq, l.name, l.line FROM h JOIN region r ON r.r_regionkey = h.k % 5 JOIN slm l ON l.name = r.r_name AND l.session_id = h.session_id WHERE h.address = 35", SESSION_LINES)
def line_lookup_by_session(spark, d):
    names = table(spark, d, "region").select(F.col("r_regionkey").alias("region_no"), F.col("r_name").alias("name"))
    commands = rig.register(harp(spark, d), model.OUT_SET).select("session_id", "seq", F.expr("cast(k % 5 as bigint)").alias("region_no")).join(F.broadcast(names), "region_no")
    return commands.join(session_lines(spark, d), ["session_id", "name"]).select("session_id", "seq", "name", "line")


@query(" SELECT o.session_id, o.seq, o.line, a.candidates FROM odor o JOIN sal a ON a.line = o.line AND a.session_id = o.session_id", VALVES, SESSION_LINES)
def line_aliases_by_session(spark, d):
    opened = valves(spark, d).where(F.col("line").isin(*A.ODORS))
    return opened.join(rig.aliases(session_lines(spark, d)), ["session_id", "line"]).select("session_id", "seq", "line", F.array_join("candidates", ",").alias("candidates"))


@query(
    """ SELECT o.session_id, o.seq, o.start_us AS t_us, row_number() OVER (PARTITION BY o.session_id ORDER BY o.start_us, o.seq) AS state_no, o.line, a.candidates
FROM odor o LEFT JOIN sal a ON a.line = o.line AND a.session_id = o.session_id""",
    VALVES,
    SESSION_LINES,
)
def state_sequence_by_session(spark, d):
    rows = rig.state_sequence(valves(spark, d), session_lines(spark, d), A.ODORS)
    return rows.select("session_id", "seq", "t_us", "state_no", "line", F.array_join("candidates", ",").alias("candidates"))


WINDOWS = """
win AS (
  SELECT session_id, window_no, min(t_us) - 43200000000 AS start_us, max(t_us) + 86400000000 AS end_us, count(*) AS onsets, min(t_us) AS first_us FROM (
    SELECT *, sum(n) OVER (PARTITION BY session_id ORDER BY t_us, seq) AS window_no FROM (
      SELECT *, CASE WHEN t_us - lag(t_us) OVER (PARTITION BY session_id ORDER BY t_us, seq) <= 129600000000 THEN 0 ELSE 1 END AS n FROM beam WHERE level))
  GROUP BY session_id, window_no
)"""


@query(" SELECT f.session_id, f.seq, w.window_no::BIGINT AS window_no, f.t_us - (w.start_us + 43200000000) AS frame_us FROM h f JOIN win w ON w.session_id = f.session_id AND f.t_us >= w.start_us AND f.t_us < w.end_us WHERE f.address = 68", BEAM, WINDOWS)
def frames_in_windows(spark, d):
    frames = rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "seq", "t_us")
    return rig.frames_in_windows(frames, rig.video_windows(beam(spark, d), A.PRE, A.POST), A.CHUNK).select("session_id", "seq", "window_no", "frame_us")


@query(
    """, sp AS (SELECT session_id, line, seq AS span_seq, start_us, end_us FROM valves UNION ALL SELECT session_id, -1, window_no, start_us, end_us FROM win)
SELECT b.session_id, b.seq, s.line::INT AS line, s.span_seq::BIGINT AS span_seq, b.t_us - s.start_us AS since_us FROM beam b JOIN sp s ON s.session_id = b.session_id AND b.t_us >= s.start_us AND (s.end_us IS NULL OR b.t_us < s.end_us)""",
    BEAM,
    VALVES,
    WINDOWS,
)
def spans_at_messages(spark, d):
    """Every valve that is open, and every recording window, at each message of the beam: spans that overlap, some for months."""
    open_valves = valves(spark, d).select("session_id", "line", F.col("seq").alias("span_seq"), "start_us", "end_us")
    windows = rig.video_windows(beam(spark, d), A.PRE, A.POST).select("session_id", F.lit(-1).alias("line"), F.col("window_no").cast("long").alias("span_seq"), "start_us", "end_us")
    rows = timeops.interval_join(beam(spark, d).select("session_id", "seq", "t_us"), open_valves.unionByName(windows), S, "start_us", "end_us", unit=HOUR, levels=12)
    return rows.select("session_id", "seq", "line", "span_seq", (F.col("t_us") - F.col("start_us")).alias("since_us"))


@query(" SELECT session_id, break_no, start_us FROM breaks b WHERE NOT EXISTS (SELECT 1 FROM ports p WHERE p.session_id = b.session_id AND p.start_us >= b.start_us AND p.start_us < b.end_us)", BEAM, VALVES)
def undelivered_breaks(spark, d):
    breaks = rig.beam_breaks(beam(spark, d))
    ports = rig.port_deliveries(valves(spark, d), A.PORT, A.VACUUM).select("session_id", "seq", F.col("start_us").alias("t_us"))
    spans = breaks.where("end_us is not null").select("session_id", "seq", F.col("start_us").alias("t_us"), "break_no", "end_us")
    served = timeops.asof(ports, spans, S, "b_", chunk=A.CHUNK, take=["break_no", "end_us"]).where("t_us < b_end_us").select("session_id", F.col("b_break_no").alias("break_no")).distinct()
    return breaks.join(served, ["session_id", "break_no"], "left_anti").select("session_id", "break_no", "start_us")


@query(" SELECT b.session_id, b.seq, r.rule_alias, r.rule <> 1 AS sample_with_replacement FROM beam b ASOF JOIN rules r ON b.session_id = r.session_id AND b.t_us >= r.t_us WHERE b.level", BEAM)
def rule_at_poke(spark, d):
    rules = rule_names(spark, d).select("session_id", "t_us", "seq", "rule_alias", "sample_with_replacement")
    rows = timeops.asof(beam(spark, d).where("level").select("session_id", "seq", "t_us"), rules, S)
    return rows.select("session_id", "seq", F.col("r_rule_alias").alias("rule_alias"), F.col("r_sample_with_replacement").alias("sample_with_replacement"))


@query(" SELECT b.session_id, b.seq, b.t_us FROM beam b ASOF JOIN (SELECT session_id, t_us, amount > 20 AS flag FROM h WHERE address = 68) f ON f.session_id = b.session_id AND b.t_us >= f.t_us WHERE b.level AND f.flag", BEAM)
def roi_gated_onsets(spark, d):
    flags = rig.register(harp(spark, d), model.PWM_RISE).withColumn("flag", F.col("amount") > 20)
    return rig.roi_gated(beam(spark, d).where("level").select("session_id", "seq", "t_us"), flags, A.CHUNK)


@query(
    """, g AS (SELECT b.session_id, coalesce(f.flag, false) AS kept FROM beam b ASOF LEFT JOIN (SELECT session_id, t_us, amount > 20 AS flag FROM h WHERE address = 68) f ON f.session_id = b.session_id AND b.t_us >= f.t_us WHERE b.level)
SELECT session_id, count(*) AS onsets, count(*) FILTER (NOT kept) AS dropped, (count(*) FILTER (NOT kept)) / count(*) AS share FROM g GROUP BY 1""",
    BEAM,
)
def roi_gate_share(spark, d):
    flags = rig.register(harp(spark, d), model.PWM_RISE).withColumn("flag", F.col("amount") > 20)
    return rig.gate_share(beam(spark, d).where("level").select("session_id", "seq", "t_us"), flags, A.CHUNK)


# Aggregates


@query(" SELECT session_id, seq, t_us, row_number() OVER (PARTITION BY session_id ORDER BY t_us, seq) AS pokes FROM beam WHERE level", BEAM)
def poke_counts(spark, d):
    return scans.numbered(beam(spark, d).where("level").select("session_id", "seq", "t_us"), S, "pokes", chunk=A.CHUNK)


@query(" SELECT session_id, seq, start_us, row_number() OVER (PARTITION BY session_id ORDER BY start_us, seq) AS deliveries FROM ports", VALVES)
def delivery_counts(spark, d):
    ports = rig.port_deliveries(valves(spark, d), A.PORT, A.VACUUM)
    return scans.numbered(ports, S, "deliveries", "start_us").select("session_id", "seq", "start_us", "deliveries")


@query(" SELECT r.session_id, r.seq, r.rule_alias, (SELECT count(DISTINCT from_state) FROM rr WHERE rr.rule = r.rule) AS states, (SELECT count(*) FROM rr WHERE rr.rule = r.rule) AS targets FROM rules r", RULE_ROWS)
def transition_map(spark, d):
    total = F.aggregate(F.map_values("transitions"), F.lit(0), lambda s, x: s + F.size(x))
    return rule_changes(spark, d).select("session_id", "seq", "rule_alias", F.size("transitions").cast("long").alias("states"), total.cast("long").alias("targets"))


@query(
    """ SELECT b.session_id, b.breaks, b.open_breaks, b.broken_us, coalesce(p.sustained, 0) AS sustained
FROM (SELECT session_id, count(*) AS breaks, count(*) FILTER (end_us IS NULL) AS open_breaks, coalesce(sum(end_us - start_us), 0)::BIGINT AS broken_us FROM breaks GROUP BY 1) b
LEFT JOIN (SELECT session_id, count(*) AS sustained FROM pokes GROUP BY 1) p USING (session_id)""",
    BEAM,
)
def session_summary(spark, d):
    messages = beam(spark, d)
    breaks = rig.beam_breaks(messages).groupBy("session_id").agg(F.count(F.lit(1)).alias("breaks"), F.count_if(F.col("end_us").isNull()).alias("open_breaks"), F.coalesce(F.sum(F.col("end_us") - F.col("start_us")), F.lit(0)).alias("broken_us"))
    pokes = rig.sustained(messages, A.MIN_POKE).groupBy("session_id").agg(F.count(F.lit(1)).alias("sustained"))
    return breaks.join(pokes, "session_id", "left").fillna(0, ["sustained"])


@query(" SELECT session_id, t_us // 86400000000 * 86400000000 AS bin_us, count(*) AS pokes FROM beam WHERE level GROUP BY 1, 2", BEAM)
def pokes_per_bin(spark, d):
    rows = beam(spark, d).where("level").withColumn("t", F.timestamp_micros("t_us"))
    return rows.groupBy("session_id", F.window("t", "1 day").alias("w")).agg(F.count(F.lit(1)).alias("pokes")).select("session_id", F.unix_micros("w.start").alias("bin_us"), "pokes")


@query(" SELECT label % 10 AS frame, sum(list_sum(list_transform(embedding[3:12], lambda v: CASE WHEN v > 0 THEN 0 ELSE 255 END)))::BIGINT AS activity FROM embeddings WHERE vec_id % 16 BETWEEN 2 AND 9 GROUP BY 1")
def roi_sum(spark, d):
    # Strips of a picture: the frame from the label, the row from the id, pixels from the vector.
    strips = table(spark, d, "embeddings").select(F.lit("s").alias("session_id"), F.expr("label % 10").alias("t_us"), F.expr("cast(vec_id % 16 as int)").alias("y"), F.col("embedding").alias("pixels"))
    return rig.roi_sum(strips, 2, 11, 2, 9, threshold=0).select(F.col("t_us").alias("frame"), "activity")


@query(
    """, px AS (SELECT label % 10 AS frame, vec_id, vec_id % 16 AS y, i AS x, CASE WHEN embedding[i + 1] > 0 THEN 0 ELSE 255 END AS a FROM embeddings, range(0, 64) r(i)),
rg AS (SELECT n AS region, (n * 7) % 50 AS x0, (n * 7) % 50 + n % 14 AS x1, n % 9 AS y0, n % 9 + n % 7 AS y1 FROM range(0, 120) r(n))
SELECT frame, region::INT AS region, sum(a)::BIGINT AS activity FROM px JOIN rg ON x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1 GROUP BY 1, 2"""
)
def region_sums(spark, d):
    """120 regions of each frame in one pass; strips as in roi_sum."""
    strips = table(spark, d, "embeddings").select(F.lit("s").alias("session_id"), F.expr("label % 10").alias("t_us"), F.expr("cast(vec_id % 16 as int)").alias("y"), F.col("embedding").alias("pixels"))
    regions = spark.range(120).select(F.col("id").cast("int").alias("region"), *[F.expr(f"cast({e} as int)").alias(n) for n, e in (("x0", "id * 7 % 50"), ("x1", "id * 7 % 50 + id % 14"), ("y0", "id % 9"), ("y1", "id % 9 + id % 7"))])
    return rig.region_sums(strips, regions, threshold=0).select(F.col("t_us").alias("frame"), "region", "activity")


REGION_STEPS = """
seqn AS (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY start_us, seq) AS state_no FROM odor),
steps AS (
  SELECT * FROM (SELECT session_id, seq, start_us AS t_us, line, state_no, lead(line) OVER w AS to_line, lead(start_us) OVER w AS to_t_us, lead(seq) OVER w AS to_seq FROM seqn WINDOW w AS (PARTITION BY session_id ORDER BY state_no)) WHERE to_line IS NOT NULL
), nsteps AS (SELECT s.*, a.r_name AS from_name, b.r_name AS to_name FROM steps s JOIN region a ON a.r_regionkey + 5 = s.line JOIN region b ON b.r_regionkey + 5 = s.to_line)"""


_STATES = ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST")


@query(
    " SELECT r.rule_alias, n.from_name AS from_state, " + ", ".join(f"count(*) FILTER (n.to_name = '{x}') AS \"{x.lower().replace(' ', '_')}\"" for x in _STATES) + " FROM nsteps n ASOF LEFT JOIN rules r ON r.session_id = n.session_id AND n.t_us >= r.t_us GROUP BY 1, 2",
    VALVES,
    REGION_STEPS,
)
def transition_matrix(spark, d):
    rules = rule_names(spark, d).select("session_id", "t_us", "seq", "rule_alias")
    rows = timeops.asof(rig.transitions(sequence(spark, d)), rules, S, "rule_", "left").select(F.col("rule_rule_alias").alias("rule_alias"), F.col("candidates")[0].alias("from_state"), F.col("to_candidates")[0].alias("to_state"))
    counted = rows.groupBy("rule_alias", "from_state").pivot("to_state", list(_STATES)).count().fillna(0)
    return counted.select("rule_alias", "from_state", *[F.col(n).alias(n.lower().replace(" ", "_")) for n in _STATES])


# Windows


@query(" SELECT session_id, seq, t_us, last_value(CASE WHEN address = 68 THEN k % 3 END IGNORE NULLS) OVER (PARTITION BY session_id ORDER BY t_us, seq ROWS UNBOUNDED PRECEDING) AS rule FROM h")
def state_fill(spark, d):
    rule = F.when(F.col("address") == model.PWM_RISE, F.expr("k % 3"))
    return timeops.current_value(harp(spark, d), S, rule, "rule", chunk=A.CHUNK).select("session_id", "seq", "t_us", "rule")


@query(" SELECT session_id, seq, t_us, level FROM edges", BEAM)
def beam_edges(spark, d):
    return rig.beam_edges(beam(spark, d), A.CHUNK).select("session_id", "seq", "t_us", "level")


@query(" SELECT session_id, seq, break_no, start_us, end_us FROM breaks", BEAM)
def poke_numbers(spark, d):
    return rig.beam_breaks(beam(spark, d), A.CHUNK)


@query(" SELECT b.session_id, b.break_no, o.start_us AS next_us, o.line FROM breaks b ASOF LEFT JOIN odor o ON o.session_id = b.session_id AND b.start_us < o.start_us", BEAM, VALVES)
def next_stimulus(spark, d):
    breaks = rig.beam_breaks(beam(spark, d)).withColumn("t_us", F.col("start_us"))
    odor = valves(spark, d).where(F.col("line").isin(*A.ODORS)).select("session_id", F.col("start_us").alias("t_us"), "seq", "line")
    return timeops.next_after(breaks, odor, S).select("session_id", "break_no", F.col("n_t_us").alias("next_us"), F.col("n_line").alias("line"))


@query(" SELECT session_id, seq, t_us, seq - lag(seq) OVER (PARTITION BY session_id ORDER BY t_us, seq) - 1 AS dropped FROM h WHERE address = 68")
def dropped_frames(spark, d):
    return rig.dropped_frames(rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "seq", "t_us"), "seq", A.CHUNK).select("session_id", "seq", "t_us", "dropped")


@query(" SELECT session_id, seq, t_us, line, state FROM states", VALVES)
def output_state(spark, d):
    return rig.line_states(harp(spark, d), chunk=A.CHUNK).select("session_id", "seq", "t_us", "line", "state")


# Sorts, limits, sets


@query(" SELECT session_id, seq, rule_alias FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY t_us, seq) AS n FROM rules) WHERE n = 1")
def first_settings(spark, d):
    rows = rule_names(spark, d).groupBy("session_id").agg(F.min_by(F.struct("seq", "rule_alias"), F.struct("t_us", "seq")).alias("x"))
    return rows.select("session_id", "x.seq", "x.rule_alias")


@query(" SELECT session_id, seq, n FROM (SELECT *, row_number() OVER (PARTITION BY session_id ORDER BY t_us, seq) AS n FROM beam) WHERE n <= session_id % 5 + 1", BEAM)
def take_n(spark, d):
    return scans.numbered(beam(spark, d).select("session_id", "seq", "t_us"), S, chunk=A.CHUNK).where(F.col("n") <= F.expr("session_id % 5 + 1")).select("session_id", "seq", "n")


@query(" SELECT session_id, seq, t_us, 'on' AS source FROM beam WHERE level UNION ALL SELECT session_id, seq, t_us, 'off' FROM beam WHERE NOT level", BEAM)
def merge_streams(spark, d):
    rows = beam(spark, d).select("session_id", "seq", "t_us", "level")
    side = lambda cond, name: rows.where(cond).select("session_id", "seq", "t_us", F.lit(name).alias("source"))
    return side("level", "on").unionByName(side("not level", "off"))


@query(" SELECT r.session_id, r.seq, rr.from_state, rr.place, rr.to_state FROM rules r JOIN rr ON rr.rule = r.rule", RULE_ROWS)
def transition_rows(spark, d):
    rows = rule_changes(spark, d).select("session_id", "seq", F.explode("transitions").alias("from_state", "targets"))
    return rows.select("session_id", "seq", "from_state", F.posexplode("targets").alias("place", "to_state"))


@query(" SELECT session_id, seq, row_number() OVER (PARTITION BY session_id ORDER BY o, t_us, seq) AS place FROM (SELECT 0 AS o, session_id, t_us, seq FROM h WHERE address = 36 UNION ALL SELECT 1, session_id, t_us, seq FROM h WHERE address = 35)")
def ordered_concat(spark, d):
    part = lambda address, k: rig.register(harp(spark, d), address).select("session_id", "t_us", "seq", F.lit(k).alias("o"))
    rows = part(model.OUT_CLEAR, 0).unionByName(part(model.OUT_SET, 1))
    return rows.select("session_id", "seq", F.row_number().over(Window.partitionBy("session_id").orderBy("o", "t_us", "seq")).alias("place"))


@query(" SELECT session_id, seq, t_us, address = 35 AS state FROM h WHERE address IN (35, 36) AND k % 10 = 5")
def digi_events(spark, d):
    line = harp(spark, d).where("k % 10 = 5")
    part = lambda address, state: rig.register(line, address).select("session_id", "seq", "t_us", F.lit(state).alias("state"))
    return part(model.OUT_CLEAR, False).unionByName(part(model.OUT_SET, True)).orderBy("t_us", "seq")


# Windows and waits of the streams


@query(" SELECT session_id, window_no::BIGINT AS window_no, start_us, end_us, onsets, first_us FROM win", BEAM, WINDOWS)
def video_windows(spark, d):
    return rig.video_windows(beam(spark, d), A.PRE, A.POST)


@query(
    """, o AS (SELECT session_id, start_us, end_us, max(coalesce(end_us, 4611686018427387904)) OVER (PARTITION BY session_id ORDER BY start_us, seq ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_us, seq FROM breaks),
g AS (SELECT *, sum(CASE WHEN start_us - 43200000000 <= last_us + 86400000000 THEN 0 ELSE 1 END) OVER (PARTITION BY session_id ORDER BY start_us, seq) AS window_no FROM o)
SELECT session_id, window_no::BIGINT AS window_no, min(start_us) - 43200000000 AS start_us, CASE WHEN bool_and(end_us IS NOT NULL) THEN max(end_us) + 86400000000 END AS end_us, count(*) AS onsets, min(start_us) AS first_us FROM g GROUP BY 1, 2""",
    BEAM,
)
def video_windows_offset(spark, d):
    return rig.video_windows(beam(spark, d), A.PRE, A.POST, "offset")


@query(
    """, c AS (SELECT session_id, t_us FROM h WHERE address = 68),
f AS (SELECT b.session_id, b.seq, b.t_us AS trigger_us, c.t_us AS first_us FROM (SELECT * FROM beam WHERE level) b ASOF JOIN c ON c.session_id = b.session_id AND b.t_us < c.t_us)
SELECT f.session_id, f.seq, f.trigger_us, f.first_us, c.t_us AS fired_us FROM (SELECT *, first_us + 86400000000 AS due FROM f) f ASOF LEFT JOIN c ON c.session_id = f.session_id AND f.due <= c.t_us""",
    BEAM,
)
def wait_elapsed(spark, d):
    e = harp(spark, d)
    return rig.wait_elapsed(rig.beam(e).where("level"), rig.register(e, model.PWM_RISE), 24 * HOUR, A.CHUNK)


DELIVERIES = """
lev AS (
  SELECT p.session_id, p.seq, p.t_us AS onset_us, p.armed_us AS start_us, p.armed_us + 10800000000 AS m, b.level FROM pokes p
  ASOF LEFT JOIN beam b ON b.session_id = p.session_id AND p.armed_us + 10800000000 >= b.t_us
), deliv AS (
  SELECT l.session_id, l.seq, l.onset_us, l.start_us, CASE WHEN coalesce(l.level, false) THEN least(coalesce(o.t_us, l.m + 86400000000), l.m + 86400000000) ELSE l.m END AS end_us
  FROM lev l ASOF LEFT JOIN offs o ON o.session_id = l.session_id AND l.m < o.t_us
)"""


@query(" SELECT session_id, seq, onset_us, start_us, end_us FROM deliv", BEAM, DELIVERIES)
def delivery_intervals(spark, d):
    messages = beam(spark, d)
    return rig.deliveries(messages, rig.sustained(messages, A.MIN_POKE), A.MIN_DELIVERY, A.MAX_DELIVERY)


@query(" SELECT session_id, max(t_us) AS end_us FROM h WHERE kind = 'error' AND k % 10 = 9 GROUP BY 1")
def session_end(spark, d):
    ends = harp(spark, d).withColumn("address", F.when(F.expr("kind = 'error' and k % 10 = 9"), model.SESSION_END).otherwise(F.col("address")))
    return rig.session_end(ends)


# Jobs


POKES = """
pb AS (SELECT b.*, r.rule_alias FROM breaks b ASOF LEFT JOIN rules r ON r.session_id = b.session_id AND b.start_us >= r.t_us),
pp AS (SELECT b.*, CASE WHEN p.start_us < coalesce(b.end_us, 4611686018427387904) THEN p.start_us END AS port_open_us, CASE WHEN p.start_us < coalesce(b.end_us, 4611686018427387904) THEN p.end_us END AS port_close_us
  FROM pb b ASOF LEFT JOIN ports p ON p.session_id = b.session_id AND b.start_us < p.start_us),
po AS (SELECT p.*, o.line, o.start_us AS o_us, o.end_us AS o_end, coalesce(o.end_us IS NULL OR o.end_us > p.start_us, false) AND o.line IS NOT NULL AS still FROM pp p ASOF LEFT JOIN odor o ON o.session_id = p.session_id AND p.start_us >= o.start_us),
pn AS (SELECT o.*, q.start_us AS next_odor_open_us FROM po o ASOF LEFT JOIN odor q ON q.session_id = o.session_id AND o.start_us < q.start_us),
poke AS (
  SELECT session_id, break_no, start_us, end_us, rule_alias, a.candidates AS stimulus, CASE WHEN still THEN n.line END AS odor_line,
    sum(CASE WHEN port_open_us IS NOT NULL THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY start_us, seq)::BIGINT AS stimulus_no, port_open_us, port_close_us,
    CASE WHEN still THEN o_us END AS odor_open_us, CASE WHEN still THEN o_end END AS odor_close_us, next_odor_open_us
  FROM pn n LEFT JOIN (SELECT line, string_agg(DISTINCT name, ',' ORDER BY name) AS candidates FROM lm WHERE role = 'odor' GROUP BY line) a ON a.line = n.line AND still
)"""


@query(" SELECT * FROM poke", BEAM, VALVES, POKES)
def poke_table(spark, d):
    rules = rule_names(spark, d).select("session_id", "t_us", "seq", "rule_alias")
    return rig.poke_table(harp(spark, d), line_map(spark, d), rules, A.PORT, A.VACUUM, A.ODORS)


@query(" SELECT session_id, line, seq, start_us, end_us FROM valves", VALVES)
def valve_intervals(spark, d):
    return rig.valve_intervals(harp(spark, d), chunk=A.CHUNK)


_ROLE = "CASE WHEN line = 0 THEN 'port' WHEN line = 2 THEN 'vacuum' WHEN line >= 5 THEN 'odor' ELSE 'other' END"


@query(
    f""", l AS (SELECT *, {_ROLE} || ' ' || state AS label FROM changes),
g AS (SELECT session_id, seq, t_us, lag(label) OVER w || '>' || label AS step, t_us - lag(t_us) OVER w AS gap_us FROM l WINDOW w AS (PARTITION BY session_id ORDER BY t_us, seq)),
x AS (SELECT *, CASE step WHEN 'port 0>odor 0' THEN 36000000000 WHEN 'odor 0>odor 1' THEN 72000000000 WHEN 'odor 1>port 1' THEN 18000000000 WHEN 'odor 0>vacuum 1' THEN 72000000000 END AS expected_us FROM g)
SELECT session_id, seq, t_us, step, gap_us, expected_us, abs(gap_us - expected_us) <= 18000000000 AS ok FROM x WHERE expected_us IS NOT NULL""",
    VALVES,
)
def switch_audit(spark, d):
    changes = rig.line_changes(rig.line_states(harp(spark, d)))
    role = F.when(F.col("line") == A.PORT, "port").when(F.col("line") == A.VACUUM, "vacuum").when(F.col("line") >= 5, "odor").otherwise("other")
    return rig.switch_audit(changes, {"port 0>odor 0": 10 * HOUR, "odor 0>odor 1": 20 * HOUR, "odor 1>port 1": 5 * HOUR, "odor 0>vacuum 1": 20 * HOUR}, 5 * HOUR, role)


_STEP_SQL = """
  CASE WHEN q = 1 AND y = 'odor 0' THEN 2 WHEN q = 2 AND y = 'odor 1' THEN 8 WHEN q = 2 AND y = 'vacuum 1' THEN 3 WHEN q = 3 AND y = 'port 1' THEN 4 WHEN q = 4 AND y = 'port 0' THEN 6 WHEN q = 4 AND y = 'odor 1' THEN 5
    WHEN q = 5 AND y = 'port 0' THEN 7 WHEN q = 6 AND y = 'odor 1' THEN 7 WHEN q = 7 AND y = 'vacuum 0' THEN 9
    WHEN q = 1 AND y IN ('odor 1', 'vacuum 1') OR q = 3 AND y IN ('port 0', 'odor 1', 'vacuum 0') OR q IN (4, 5, 6) AND y = 'vacuum 0' THEN 10
    WHEN y = 'port 0' THEN 1 WHEN q IN (0, 8, 9, 10, 11) THEN q ELSE 11 END"""


@query(
    f""", l AS (SELECT *, {_ROLE} || ' ' || state AS y, row_number() OVER (PARTITION BY session_id ORDER BY t_us, seq) AS i, t_us - lag(t_us) OVER (PARTITION BY session_id ORDER BY t_us, seq) AS gap FROM changes WHERE line IN (0, 2) OR line >= 5),
run AS (
  SELECT session_id, i, t_us, seq, y, gap, 0 AS p, CASE WHEN y = 'port 0' THEN 1 ELSE 0 END AS q FROM l WHERE i = 1
  UNION ALL SELECT l.session_id, l.i, l.t_us, l.seq, l.y, l.gap, r.q, (SELECT {_STEP_SQL} FROM (SELECT r.q AS q, l.y AS y) z) FROM run r JOIN l ON l.session_id = r.session_id AND l.i = r.i + 1
), n AS (SELECT *, sum(CASE WHEN y = 'port 0' AND q = 1 THEN 1 ELSE 0 END) OVER (PARTITION BY session_id ORDER BY i) AS switch_no, q <> p AND q BETWEEN 2 AND 9 AS moved,
  CASE q WHEN 2 THEN 36000000000 WHEN 8 THEN 72000000000 WHEN 3 THEN 72000000000 WHEN 4 THEN 90000000000 WHEN 6 THEN 90000000000 WHEN 5 THEN 90000000000 WHEN 7 THEN 0 WHEN 9 THEN 252000000000 END AS due FROM run),
g AS (SELECT session_id, switch_no, min(t_us) AS start_us, count(*) FILTER (moved) AS steps, count(*) FILTER (moved AND abs(gap - due) > 360000000000) AS late, max_by(q, i) AS q, bool_or(q IN (3, 4, 5, 6, 7, 9)) AS vac, bool_or(q = 8) AS norm FROM n WHERE switch_no > 0 GROUP BY 1, 2)
SELECT session_id, switch_no::BIGINT AS switch_no, start_us, CASE WHEN vac THEN 'vacuum' WHEN norm THEN 'normal' END AS mode, steps,
  CASE WHEN q IN (8, 9) AND late > 0 THEN 'late' WHEN q IN (8, 9) THEN 'complete' WHEN q = 10 THEN 'step missing' WHEN q = 11 THEN 'out of order' ELSE 'unfinished' END AS verdict FROM g""",
    VALVES,
    recursive=True,
)
def switch_patterns(spark, d):
    changes = rig.line_changes(rig.line_states(harp(spark, d)))
    role = F.when(F.col("line") == A.PORT, "port").when(F.col("line") == A.VACUUM, "vacuum").when(F.col("line") >= 5, "odor")
    expected = {rig.ODOR_CLOSED: 10, rig.NORMAL_DONE: 20, rig.VACUUM_OPEN: 20, rig.FLUSHING: 25, rig.FLUSHED: 25, rig.ODOR_FIRST: 25, rig.CHARGING: 0, rig.VACUUM_DONE: 70}
    return rig.switch_patterns(changes, role, {k: v * HOUR for k, v in expected.items()}, 100 * HOUR, A.CHUNK)


@query(
    """ SELECT session_id, seq, 'poke' AS kind, end_us - start_us AS length_us FROM breaks WHERE end_us - start_us > 72000000000
UNION ALL SELECT session_id, seq, 'delivery', end_us - start_us FROM deliv WHERE end_us - start_us > 54000000000
UNION ALL SELECT session_id, window_no::BIGINT, 'video', end_us - start_us FROM win WHERE end_us - start_us > 259200000000
UNION ALL SELECT session_id, seq, 'wait', wait_us FROM (SELECT session_id, seq, start_us - lag(end_us) OVER (PARTITION BY session_id ORDER BY start_us, seq) AS wait_us FROM ports) WHERE wait_us < 1296000000000""",
    BEAM,
    VALVES,
    DELIVERIES,
    WINDOWS,
)
def limit_violations(spark, d):
    messages = beam(spark, d)
    length = (F.col("end_us") - F.col("start_us")).alias("length_us")
    over = lambda df, kind, key, limit: df.select("session_id", F.col(key).alias("seq"), F.lit(kind).alias("kind"), length).where(F.col("length_us") > limit)
    pokes = over(rig.beam_breaks(messages), "poke", "seq", 20 * HOUR)
    given = over(rig.deliveries(messages, rig.sustained(messages, A.MIN_POKE), A.MIN_DELIVERY, A.MAX_DELIVERY), "delivery", "seq", 15 * HOUR)
    waits = rig.port_waits(rig.port_deliveries(valves(spark, d), A.PORT, A.VACUUM)).where(F.col("wait_us") < 360 * HOUR).select("session_id", "seq", F.lit("wait").alias("kind"), F.col("wait_us").alias("length_us"))
    return pokes.unionByName(given).unionByName(over(rig.video_windows(messages, A.PRE, A.POST), "video", "window_no", 72 * HOUR)).unionByName(waits)


@query(
    """, fr AS (SELECT session_id, seq, t_us FROM h WHERE address = 68 AND value = 1)
SELECT f.session_id, f.seq, f.t_us, b.break_no, CASE WHEN b.port_open_us IS NOT NULL THEN b.stimulus_no END AS stimulus_no, f.t_us - b.start_us AS since_break_us, b.rule_alias, b.stimulus,
  b.start_us IS NOT NULL AND (b.end_us IS NULL OR b.end_us > f.t_us) AS beam, p.start_us IS NOT NULL AND (p.end_us IS NULL OR p.end_us > f.t_us) AS port,
  concat_ws('_', b.break_no, CASE WHEN b.port_open_us IS NOT NULL THEN b.stimulus_no END) AS segment
FROM fr f ASOF LEFT JOIN poke b ON b.session_id = f.session_id AND f.t_us >= b.start_us ASOF LEFT JOIN (SELECT * FROM valves WHERE line = 0) p ON p.session_id = f.session_id AND f.t_us >= p.start_us""",
    BEAM,
    VALVES,
    POKES,
)
def frame_annotation(spark, d):
    frames = rig.camera_triggers(harp(spark, d)).select("session_id", "seq", "t_us")
    return rig.annotated_frames(frames, poke_table(spark, d), valves(spark, d).where(F.col("line") == A.PORT), A.CHUNK)


@query(" SELECT s.session_id, s.seq, s.start_us AS t_us, s.state_no, s.line, r.r_name AS candidates FROM seqn s JOIN region r ON r.r_regionkey + 5 = s.line", VALVES, REGION_STEPS)
def state_sequence(spark, d):
    return sequence(spark, d).select("session_id", "seq", "t_us", "state_no", "line", F.array_join("candidates", ",").alias("candidates"))


def _conformance_sql(at: str) -> str:
    return f""" SELECT n.session_id, n.seq, n.t_us, n.line, n.to_line, n.to_t_us, r.rule_alias,
  CASE WHEN r.rule IS NULL THEN 'no rule' WHEN EXISTS (SELECT 1 FROM rr WHERE rr.rule = r.rule AND rr.from_state = n.from_name AND rr.to_state = n.to_name) THEN 'ok' ELSE 'violation' END AS verdict
FROM nsteps n ASOF LEFT JOIN rules r ON r.session_id = n.session_id AND n.{at} >= r.t_us"""


@query(_conformance_sql("t_us"), VALVES, REGION_STEPS, RULE_ROWS)
def rule_conformance(spark, d):
    return rig.rule_conformance(rig.transitions(sequence(spark, d)), rule_names(spark, d).select("session_id", "t_us", "seq", "rule", "rule_alias"), maps=rule_maps(spark))


@query(_conformance_sql("to_t_us"), VALVES, REGION_STEPS, RULE_ROWS)
def rule_conformance_specified(spark, d):
    return rig.rule_conformance(rig.transitions(sequence(spark, d)), rule_names(spark, d).select("session_id", "t_us", "seq", "rule", "rule_alias"), "as_specified", rule_maps(spark))


@query(
    """ SELECT n.session_id, n.seq, n.t_us, n.line, n.to_line, n.to_t_us, CASE r.rule WHEN 0 THEN 'any' WHEN 1 THEN 'loop' WHEN 2 THEN 'stuck' END AS rule_alias,
  CASE WHEN r.rule IS NULL THEN 'no rule' WHEN EXISTS (SELECT 1 FROM tr WHERE tr.rule = r.rule AND tr.from_state = n.from_name AND tr.to_state = n.to_name) THEN 'ok'
    WHEN (EXISTS (SELECT 1 FROM tr WHERE tr.rule = r.rule AND tr.from_state = n.from_name AND tr.to_state = 'DefaultState') OR NOT EXISTS (SELECT 1 FROM tr WHERE tr.rule = r.rule AND tr.from_state = n.from_name))
      AND EXISTS (SELECT 1 FROM tr WHERE tr.rule = r.rule AND tr.from_state = 'DefaultState' AND tr.to_state = n.to_name) THEN 'ok' ELSE 'violation' END AS verdict
FROM nsteps n ASOF LEFT JOIN rules r ON r.session_id = n.session_id AND n.t_us >= r.t_us""",
    VALVES,
    REGION_STEPS,
    TWO_STEP_ROWS,
)
def rule_conformance_default(spark, d):
    """Rules that lead through the default state."""
    rules = A.two_step_rows(spark)
    names = rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "t_us", "seq", F.expr("k % 3").cast("int").alias("rule")).join(F.broadcast(rules.drop("transitions")), "rule")
    return rig.rule_conformance(rig.transitions(sequence(spark, d)), names, maps=rig.rule_map(rig.rule_rows(rules), ["rule"]))


@query(
    """, ct AS (
  SELECT rule, from_state, to_state FROM tr WHERE from_state <> 'DefaultState' AND to_state <> 'DefaultState'
  UNION SELECT a.rule, a.from_state, b.to_state FROM tr a JOIN tr b ON b.rule = a.rule AND b.from_state = 'DefaultState' WHERE a.to_state = 'DefaultState' AND a.from_state <> 'DefaultState'
) SELECT r.session_id, r.seq, ct.from_state, ct.to_state FROM rules r JOIN ct ON ct.rule = r.rule""",
    TWO_STEP_ROWS,
)
def contracted_rules(spark, d):
    """The rule in force from each change on, from odor to odor."""
    rows = rig.contracted(rig.rule_rows(A.two_step_rows(spark)), ("rule",))
    changes = rig.register(harp(spark, d), model.PWM_RISE).select("session_id", "seq", F.expr("k % 3").cast("int").alias("rule"))
    return changes.join(F.broadcast(rows), "rule").select("session_id", "seq", "from_state", "to_state")


@query(
    """, dr AS (SELECT n.session_id, n.seq, n.t_us, r.t_us AS epoch, r.rule, n.from_name, n.to_name FROM nsteps n ASOF JOIN rules r ON r.session_id = n.session_id AND n.t_us >= r.t_us WHERE r.rule = 1),
sz AS (SELECT from_state, count(*) AS n FROM rr WHERE rule = 1 GROUP BY 1),
bg AS (SELECT dr.*, (row_number() OVER (PARTITION BY session_id, epoch, from_name ORDER BY dr.t_us, seq) - 1) // sz.n AS bag_no FROM dr JOIN sz ON sz.from_state = dr.from_name)
SELECT g.session_id, g.rule_epoch, g.source, g.bag_no, g.target, g.drawn, coalesce(l.n, 0) AS listed, g.drawn <= coalesce(l.n, 0) AS ok
FROM (SELECT session_id, epoch AS rule_epoch, from_name AS source, bag_no, to_name AS target, count(*) AS drawn FROM bg GROUP BY 1, 2, 3, 4, 5) g
LEFT JOIN (SELECT from_state, to_state, count(*) AS n FROM rr WHERE rule = 1 GROUP BY 1, 2) l ON l.from_state = g.source AND l.to_state = g.target""",
    VALVES,
    REGION_STEPS,
    RULE_ROWS,
)
def bag_conformance(spark, d):
    rules = rule_names(spark, d).select("session_id", "t_us", "seq", "rule", "sample_with_replacement")
    rows = timeops.asof(rig.transitions(sequence(spark, d)), rules, S).where(~F.col("r_sample_with_replacement"))
    rows = rows.join(F.broadcast(rule_maps(spark).select(F.col("rule").alias("r_rule"), F.col("transitions").alias("r_transitions"))), "r_rule")  # three rules
    source = F.col("candidates")[0]
    draws = rows.select("session_id", "seq", "t_us", F.col("r_t_us").alias("rule_epoch"), source.alias("source"), F.col("to_candidates")[0].alias("target"), F.try_element_at("r_transitions", source).alias("options"))
    return rig.bag_conformance(draws.where("options is not null"))


@query(" SELECT w.session_id, w.window_no::BIGINT AS window_no, count(f.seq) AS frames, count(f.seq) FILTER (f.value = 1) AS triggers FROM win w LEFT JOIN h f ON f.session_id = w.session_id AND f.address = 68 AND f.t_us >= w.start_us AND f.t_us < w.end_us GROUP BY 1, 2", BEAM, WINDOWS)
def trigger_reconcile(spark, d):
    e = harp(spark, d)
    windows = rig.video_windows(rig.beam(e), A.PRE, A.POST)
    inside = rig.frames_in_windows(rig.register(e, model.PWM_RISE).select("session_id", "seq", "t_us", "value"), windows, A.CHUNK).groupBy("session_id", "window_no").agg(F.count(F.lit(1)).alias("frames"), F.count_if(F.col("value") == 1).alias("triggers"))
    return windows.select("session_id", "window_no").join(inside, ["session_id", "window_no"], "left").fillna(0, ["frames", "triggers"])
