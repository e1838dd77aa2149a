"""Beam breaks, valves, deliveries, rules, states, video and audits, on events (session_id, seq, t_us, address, value)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import has_line, mask_lines, running_sums
from ..model import AUX_IN, DEFAULT_STATE, OUT_CLEAR, OUT_SET, OUT_STATE, OUT_TOGGLE, PWM_RISE, SESSION_END
from .scans import automaton, filled, neighbours, numbered, summed, switch_spans, switched
from .timeops import HOUR, asof, merged_windows, next_after

S = ["session_id"]
LINE = ["session_id", "line"]


def by_time(*more: str) -> Window:
    return Window.partitionBy("session_id", *more).orderBy("t_us", "seq")


def sides(*named: tuple[str, DataFrame, int]) -> DataFrame:
    """One table of all sides by session, time and order (_side: lower comes first at equal times), each side's rows as a struct of its name."""
    rows = [df.select("session_id", "t_us", "seq", F.lit(k).alias("_side"), F.struct("*").alias(name)) for name, df, k in named]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows)


def register(events: DataFrame, *addresses: int) -> DataFrame:
    return events.where(F.col("address").isin(*addresses))


def beam(events: DataFrame, aux_line: int = 0) -> DataFrame:
    """Messages of the beam sensor with its level; every message with the bit set is an onset message."""
    return register(events, AUX_IN).withColumn("level", has_line(F.col("value"), F.lit(aux_line)))


def beam_edges(messages: DataFrame, chunk: int | None = None) -> DataFrame:
    """Messages that change the level; the level before the first is low."""
    rows = neighbours(messages.select("session_id", "seq", "t_us", "level"), S, {"_before": "level"}, chunk=chunk)
    return rows.where(F.col("level") != F.coalesce("_before", F.lit(False))).drop("_before")


def beam_breaks(messages: DataFrame, chunk: int | None = None) -> DataFrame:
    """One row per beam break, of messages or edges: number, start and end; end is null while it lasts."""
    rows = switch_spans(messages.withColumn("_on", F.col("level").cast("int")), S, "_on", chunk=chunk)
    return rows.select("session_id", "seq", F.col("n").alias("break_no"), "start_us", "end_us")


def sustained(messages: DataFrame, least: int) -> DataFrame:
    """Onset messages with no offset within the least time; an offset exactly then doesn't count. armed_us is onset plus that time."""
    off = messages.where("not level").select("session_id", "t_us", "seq")
    rows = next_after(messages.where("level").select("session_id", "t_us", "seq"), off, S)
    return rows.where(f"n_t_us is null or n_t_us - t_us >= {least}").select("session_id", "seq", "t_us", (F.col("t_us") + least).alias("armed_us"), F.col("n_t_us").alias("off_us"))


def deliveries(messages: DataFrame, pokes: DataFrame, least: int, most: int) -> DataFrame:
    """Expected delivery of each sustained poke: from armed_us to the minimum, or if the beam is broken then, to the release or the maximum after it."""
    levels = messages.select("session_id", "t_us", "seq", "level")
    at = pokes.select("session_id", "seq", F.col("t_us").alias("onset_us"), "armed_us", (F.col("armed_us") + least).alias("t_us"))
    rows = asof(at, levels, S, "level_", "left")
    rows = next_after(rows, levels.where("not level").select("session_id", "t_us", "seq"), S)
    limit = F.col("t_us") + most
    end = F.when(F.coalesce("level_level", F.lit(False)), F.least(F.coalesce("n_t_us", limit), limit)).otherwise(F.col("t_us"))
    return rows.select("session_id", "seq", "onset_us", F.col("armed_us").alias("start_us"), end.alias("end_us"))


def line_commands(events: DataFrame, lines: int = 10) -> DataFrame:
    """What each message does to each line that it touches: _level (0 or 1) or _toggle (1). Messages set, clear, toggle or write all lines."""
    out = register(events, OUT_SET, OUT_CLEAR, OUT_TOGGLE, OUT_STATE)
    touched = F.when(F.col("address") == OUT_STATE, F.sequence(F.lit(0), F.lit(lines - 1))).otherwise(mask_lines(F.col("value"), lines))
    rows = out.withColumn("line", F.explode(touched))
    level = F.when(F.col("address") == OUT_SET, 1).when(F.col("address") == OUT_CLEAR, 0).when(F.col("address") == OUT_STATE, F.bit_get(F.col("value").cast("long"), F.col("line")).cast("int"))
    return rows.select("session_id", "seq", "t_us", "line", level.alias("_level"), F.when(F.col("address") == OUT_TOGGLE, 1).alias("_toggle"))


def line_states(events: DataFrame, lines: int = 10, chunk: int | None = None) -> DataFrame:
    """State of each line after each message that touches it."""
    return switched(line_commands(events, lines), LINE, "_level", "_toggle", "state", chunk=chunk).drop("_toggle")


def line_changes(states: DataFrame, chunk: int | None = None) -> DataFrame:
    """Messages that change a line; lines are closed before the first."""
    rows = neighbours(states, LINE, {"_before": "state"}, chunk=chunk)
    return rows.where(F.col("state") != F.coalesce("_before", F.lit(0))).drop("_before")


def valve_intervals(events: DataFrame, lines: int = 10, chunk: int | None = None) -> DataFrame:
    """Open intervals of each line; end is null while open. Lines are closed before the first message."""
    return switch_spans(line_commands(events, lines), LINE, "_level", "_toggle", chunk=chunk).select("session_id", "line", "seq", "start_us", "end_us")


def port_deliveries(intervals: DataFrame, port: int, vacuum: int) -> DataFrame:
    """Openings of the port valve that don't begin while the vacuum line is open: the others flush it."""
    lines = {"_p": intervals.where(F.col("line") == port), "_v": intervals.where(F.col("line") == vacuum)}
    rows = sides(*[(n, df.withColumn("t_us", F.col("start_us")), int(n == "_p")) for n, df in lines.items()])
    rows = filled(rows, S, ["_v"], "t_us", "seq", ["t_us", "_side", "seq"], None).where("_p is not null")
    return rows.where("_v is null or _v.end_us <= t_us").select("_p.session_id", "_p.line", "_p.seq", "_p.start_us", "_p.end_us")


def map_keys(line_map: DataFrame) -> list[str]:
    """What a line is looked up by: also by session if the map has one for each."""
    return [c for c in ("session_id", "line") if c in line_map.columns]


def looked_up(rows: DataFrame, table: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Joins a line map's table. One map for all sessions has a row for each of a board's few lines, and is broadcast; maps by session are as many as the sessions."""
    return rows.join(table if "session_id" in keys else F.broadcast(table), keys, how)


def aliases(line_map: DataFrame) -> DataFrame:
    return line_map.where("role = 'odor'").groupBy(*map_keys(line_map)).agg(F.array_sort(F.collect_set("name")).alias("candidates"))


def state_sequence(intervals: DataFrame, line_map: DataFrame, odors: tuple[int, ...]) -> DataFrame:
    """Inferred states: odor openings in order, with the names that their line may stand for in their session (or in all, if the map has no session_id)."""
    rows = intervals.where(F.col("line").isin(*odors)).withColumn("t_us", F.col("start_us"))
    rows = numbered(rows, S, "state_no")
    return looked_up(rows, aliases(line_map), map_keys(line_map), "left").select("session_id", "seq", "t_us", "state_no", "line", "candidates", "end_us")


def transitions(sequence: DataFrame) -> DataFrame:
    """Each state with the one after it: to_* columns."""
    w = Window.partitionBy("session_id").orderBy("state_no")
    nxt = {f"to_{c}": F.lead(c).over(w) for c in ("line", "candidates", "t_us", "seq")}
    return sequence.withColumns(nxt).where("to_line is not null")


def next_odors(transitions: Column, state: Column) -> Column:
    """The odor states that a rule allows after a state: its targets, with the default state, which opens no line, replaced by where that leads. A state that the rule lacks leads to the default state."""
    default = F.array(F.lit(DEFAULT_STATE))
    through = F.coalesce(F.try_element_at(transitions, F.lit(DEFAULT_STATE)), default)
    targets = F.coalesce(F.try_element_at(transitions, state), default)
    every = F.flatten(F.transform(targets, lambda x: F.when(x == DEFAULT_STATE, through).otherwise(F.array(x))))
    return F.array_remove(F.array_distinct(every), DEFAULT_STATE)


#: Rules up to which their maps are broadcast.
BROADCAST_RULES = 10_000


def rule_conformance(steps: DataFrame, rules: DataFrame, mode: str = "as_implemented", maps: DataFrame | None = None) -> DataFrame:
    """Whether each observed transition is allowed by the rule, through the default state where the rule leads there.

    mode: the rule in force when the source state opened, as a switch acts only once the armed state completes ("as_implemented"),
    or the rule in force when the target opened ("as_specified"). A source that the rule lacks leads to the default state only.
    rules: session_id, t_us, seq, rule_alias, and transitions, or rule, the key of maps (rule, transitions), which are looked up after the join by time.
    """
    at = F.col("t_us") if mode == "as_implemented" else F.col("to_t_us")
    probes = steps.withColumn("_from_us", F.col("t_us")).withColumn("t_us", at)
    rows = asof(probes, rules, S, "rule_", "left").withColumn("t_us", F.col("_from_us"))
    if maps is not None:
        table = maps.select(F.col("rule").alias("rule_rule"), F.col("transitions").alias("rule_transitions"))
        rows = rows.join(F.broadcast(table) if maps.count() <= BROADCAST_RULES else table, "rule_rule", "left")
    allowed = F.flatten(F.transform("candidates", lambda c: next_odors(F.col("rule_transitions"), c)))
    verdict = F.when(F.col("rule_transitions").isNull(), "no rule").when(F.arrays_overlap(allowed, "to_candidates"), "ok").otherwise("violation")
    return rows.select("session_id", "seq", "t_us", "line", "to_line", "to_t_us", F.col("rule_rule_alias").alias("rule_alias"), verdict.alias("verdict"))


def bag_conformance(draws: DataFrame) -> DataFrame:
    """Draws without replacement: in each bag of as many draws as the list has entries, every target may come at most as often as it is listed.

    draws: session_id, seq, t_us, rule_epoch, source, target, options (the source's list). Bags restart with the rule.
    """
    w = Window.partitionBy("session_id", "rule_epoch", "source").orderBy("t_us", "seq")
    rows = draws.withColumn("draw_no", F.row_number().over(w)).withColumn("bag_no", F.floor((F.col("draw_no") - 1) / F.size("options")))
    counted = rows.groupBy("session_id", "rule_epoch", "source", "bag_no", "target").agg(F.count(F.lit(1)).alias("drawn"), F.first("options").alias("options"))
    allowed = F.size(F.filter("options", lambda x: x == F.col("target")))
    return counted.select("session_id", "rule_epoch", "source", "bag_no", "target", "drawn", allowed.cast("long").alias("listed"), (F.col("drawn") <= allowed).alias("ok"))


def rule_rows(raw: DataFrame, text: str = "transitions") -> DataFrame:
    """from_state, to_state, place, of a JSON object of transitions in any of its three dialects: objects with a name, strings, a bare string."""
    states = raw.withColumn("_v", F.expr(f"try_variant_get(parse_json({text}), '$', 'map<string,variant>')")).select(*[c for c in raw.columns if c != text], F.explode("_v").alias("from_state", "_v"))
    objects = F.expr("try_variant_get(_v, '$', 'array<struct<name:string>>')")
    strings = F.expr("try_variant_get(_v, '$', 'array<string>')")
    named = F.filter(F.transform(objects, lambda x: x["name"]), lambda x: x.isNotNull())
    listed = F.when(F.size(named) > 0, named).when(strings.isNotNull(), strings).otherwise(F.array(F.expr("try_variant_get(_v, '$', 'string')")))
    return states.select(*[c for c in raw.columns if c != text], "from_state", F.posexplode(listed).alias("place", "to_state"))


def rule_map(rows: DataFrame, by: list[str]) -> DataFrame:
    """transitions: from_state to its list, in order. A state that is defined twice is an error."""
    lists = rows.groupBy(*by, "from_state").agg(F.array_sort(F.collect_list(F.struct("place", "to_state"))).alias("_l"))
    return lists.groupBy(*by).agg(F.map_from_entries(F.collect_list(F.struct("from_state", F.transform("_l", lambda x: x["to_state"])))).alias("transitions"))


def contracted(rows: DataFrame, by: tuple[str, ...] = ("rule_alias",)) -> DataFrame:
    """Transitions from odor to odor: those to the default state, which opens no line, are replaced by where it leads. by: what names a rule."""
    through = rows.where(F.col("from_state") == DEFAULT_STATE).select(*by, F.col("to_state").alias("_next"))
    rows = rows.where(F.col("from_state") != DEFAULT_STATE)
    direct = rows.where(F.col("to_state") != DEFAULT_STATE).select(*by, "from_state", "to_state")
    two = rows.where(F.col("to_state") == DEFAULT_STATE).join(through, [*by]).select(*by, "from_state", F.col("_next").alias("to_state"))
    return direct.unionByName(two).distinct()


def roi_gated(onsets: DataFrame, flags: DataFrame, chunk: int | None = None) -> DataFrame:
    """Onsets at which the last flag of the camera's region is true; before the first flag none is."""
    return asof(onsets, flags.select("session_id", "t_us", "seq", "flag"), S, "roi_", chunk=chunk).where("roi_flag").drop("roi_flag", "roi_t_us", "roi_seq")


def gate_share(onsets: DataFrame, flags: DataFrame, chunk: int | None = None) -> DataFrame:
    """By session: onsets, and how many and which share of them the camera's gate drops."""
    rows = asof(onsets.select("session_id", "t_us", "seq"), flags.select("session_id", "t_us", "seq", "flag"), S, "roi_", "left", chunk=chunk)
    counted = rows.groupBy("session_id").agg(F.count(F.lit(1)).alias("onsets"), F.count_if(~F.coalesce("roi_flag", F.lit(False))).alias("dropped"))
    return counted.select("session_id", "onsets", "dropped", (F.col("dropped") / F.col("onsets")).alias("share"))


def port_waits(ports: DataFrame) -> DataFrame:
    """Each opening of the port but the first with the time since it closed before."""
    w = Window.partitionBy("session_id").orderBy("start_us", "seq")
    return ports.withColumn("wait_us", F.col("start_us") - F.lag("end_us").over(w)).where("wait_us is not null").select("session_id", "seq", "start_us", "wait_us")


def annotated_frames(frames: DataFrame, pokes: DataFrame, ports: DataFrame, chunk: int | None = HOUR) -> DataFrame:
    """Frames (session_id, seq, t_us) with what the last beam break at or before them has in the poke table: its number and stimulus, the frame's time since
    it, and whether the beam and the port are open then. segment: the break's number and, if it was served, the stimulus number.
    """
    at = lambda df, time, seq, side, **own: df.select("session_id", F.col(time).alias("t_us"), F.col(seq).alias("seq"), F.lit(side).alias("_side"), *[v.alias(k) for k, v in own.items()])
    served = F.when(F.col("port_open_us").isNotNull(), F.col("stimulus_no")).alias("stimulus_no")
    table = at(pokes, "start_us", "break_no", 0, _b=F.struct(F.col("start_us").alias("t_us"), "break_no", "end_us", "rule_alias", "stimulus", served))
    rows = at(frames, "t_us", "seq", 1, _f=F.struct("session_id", "seq", "t_us"))
    for side in (table, at(ports, "start_us", "seq", 0, _p=F.struct(F.col("start_us").alias("t_us"), "end_us"))):
        rows = rows.unionByName(side, allowMissingColumns=True)
    rows = filled(rows, S, ["_b", "_p"], "t_us", "seq", ["t_us", "_side", "seq"], chunk).where("_f is not null")
    rows = rows.select("_f.*", *[F.col(f"_b.{c}").alias(f"b_{c}") for c in ("t_us", "break_no", "end_us", "rule_alias", "stimulus", "stimulus_no")], F.col("_p.t_us").alias("p_t_us"), F.col("_p.end_us").alias("p_end_us"))
    broken = F.col("b_t_us").isNotNull() & (F.col("b_end_us").isNull() | (F.col("b_end_us") > F.col("t_us")))
    port = F.col("p_t_us").isNotNull() & (F.col("p_end_us").isNull() | (F.col("p_end_us") > F.col("t_us")))
    segment = F.concat_ws("_", F.col("b_break_no").cast("string"), F.col("b_stimulus_no").cast("string"))
    return rows.select(
        "session_id", "seq", "t_us", F.col("b_break_no").alias("break_no"), F.col("b_stimulus_no").alias("stimulus_no"), (F.col("t_us") - F.col("b_t_us")).alias("since_break_us"), F.col("b_rule_alias").alias("rule_alias"),
        F.col("b_stimulus").alias("stimulus"), broken.alias("beam"), port.alias("port"), segment.alias("segment"),
    )


def wait_elapsed(triggers: DataFrame, ticks: DataFrame, due: int, chunk: int | None = HOUR) -> DataFrame:
    """When a wait on the board's clock ends: the first tick at least due after the first tick after the trigger."""
    clock = ticks.select("session_id", "t_us", "seq")
    after = lambda rows, name: next_after(rows, clock, S, chunk=chunk, take=["t_us"], hold=[c for c in rows.columns if c != "t_us"]).withColumnRenamed("n_t_us", name)
    first = after(triggers.select("session_id", "seq", F.col("t_us").alias("trigger_us"), "t_us"), "first_us")
    # At least due after: the next tick after one microsecond less.
    probe = first.withColumn("t_us", F.col("first_us") + due - 1).where("first_us is not null")
    return after(probe, "fired_us").select("session_id", "seq", "trigger_us", "first_us", "fired_us")


def video_windows(messages: DataFrame, pre: int, post: int, mode: str = "onset") -> DataFrame:
    """Merged recording windows. mode: "onset" has windows around onset messages, "offset" around whole beam breaks, from pre before the start to post after the end.

    A window of a break that lasts has no end.
    """
    if mode == "onset":
        return merged_windows(messages.where("level"), S, pre, post)
    w = Window.partitionBy("session_id").orderBy("start_us", "seq")
    new = F.coalesce(F.col("start_us") - F.lag("end_us").over(w) > pre + post, F.lit(True)).cast("int")
    islands = beam_breaks(messages).withColumn("_new", new).withColumn("window_no", F.sum("_new").over(w))
    ended = F.count("end_us") == F.count(F.lit(1))
    return islands.groupBy("session_id", "window_no").agg((F.min("start_us") - pre).alias("start_us"), F.when(ended, F.max("end_us") + post).alias("end_us"), F.count(F.lit(1)).alias("onsets"), F.min("start_us").alias("first_us"))


def frames_in_windows(frames: DataFrame, windows: DataFrame, chunk: int | None = HOUR) -> DataFrame:
    """Frames of each window, with their time from its first onset, the beam break (frame_us, below 0 before it)."""
    rows = asof(frames, windows.select("session_id", F.col("start_us").alias("t_us"), F.col("window_no").alias("seq"), "window_no", "end_us", "first_us"), S, "w_", chunk=chunk, take=["window_no", "end_us", "first_us"])
    rows = rows.where("w_end_us is null or t_us < w_end_us")
    return rows.select(*frames.columns, F.col("w_window_no").alias("window_no"), (F.col("t_us") - F.col("w_first_us")).alias("frame_us"))


def dropped_frames(frames: DataFrame, counter: str = "hw_counter", chunk: int | None = None) -> DataFrame:
    """Frames with how many were dropped before each: the gap of the camera's counter; null for the first."""
    rows = neighbours(frames, S, {"_before": counter}, chunk=chunk)
    return rows.withColumn("dropped", F.col(counter) - F.col("_before") - 1).drop("_before")


def camera_triggers(events: DataFrame, mode: str = "equal") -> DataFrame:
    """Rises of the first PWM channel: value equal to its bit, or ("bit") value holding it."""
    rises = register(events, PWM_RISE)
    return rises.where("value = 1") if mode == "equal" else rises.where(has_line(F.col("value"), F.lit(0)))


def session_end(events: DataFrame) -> DataFrame:
    return register(events, SESSION_END).groupBy("session_id").agg(F.max("t_us").alias("end_us"))


def switch_audit(changes: DataFrame, expected: dict[str, int], tolerance: int, role: Column) -> DataFrame:
    """Gaps between the steps of a switch against the configured times.

    expected: time by step, named "role state>role state", as in "port 0>odor 0". ok: within the tolerance.
    """
    w = by_time()
    label = F.concat_ws(" ", role, F.col("state").cast("string"))
    rows = changes.withColumn("_label", label).withColumns({"step": F.concat(F.lag("_label").over(w), F.lit(">"), F.col("_label")), "gap_us": F.col("t_us") - F.lag("t_us").over(w)})
    table = F.create_map(*[F.lit(x) for k, v in expected.items() for x in (k, v)])
    rows = rows.withColumn("expected_us", F.try_element_at(table, "step").cast("long")).where("expected_us is not null")
    return rows.select("session_id", "seq", "t_us", "step", "gap_us", "expected_us", (F.abs(F.col("gap_us") - F.col("expected_us")) <= tolerance).alias("ok"))


#: What valves do in a switch, and how far it has come. A switch begins when the port closes. Normal: odor closes, next odor opens. With vacuum: odor closes, vacuum opens,
#: port opens and closes, next odor opens (with the port's closing, in either order), vacuum closes.
SYMBOLS = ("port 0", "port 1", "odor 0", "odor 1", "vacuum 1", "vacuum 0")
IDLE, PORT_CLOSED, ODOR_CLOSED, VACUUM_OPEN, FLUSHING, ODOR_FIRST, FLUSHED, CHARGING, NORMAL_DONE, VACUUM_DONE, MISSING, DISORDERED = range(12)
#: The right next steps; then steps that come too early, as what lies between is missing. Any other step is out of order.
STEPS = {
    (PORT_CLOSED, "odor 0"): ODOR_CLOSED, (ODOR_CLOSED, "odor 1"): NORMAL_DONE, (ODOR_CLOSED, "vacuum 1"): VACUUM_OPEN, (VACUUM_OPEN, "port 1"): FLUSHING, (FLUSHING, "port 0"): FLUSHED,
    (FLUSHING, "odor 1"): ODOR_FIRST, (ODOR_FIRST, "port 0"): CHARGING, (FLUSHED, "odor 1"): CHARGING, (CHARGING, "vacuum 0"): VACUUM_DONE,
}
SKIPPED = {(PORT_CLOSED, "odor 1"), (PORT_CLOSED, "vacuum 1"), (VACUUM_OPEN, "port 0"), (VACUUM_OPEN, "odor 1"), (VACUUM_OPEN, "vacuum 0"), (FLUSHING, "vacuum 0"), (ODOR_FIRST, "vacuum 0"), (FLUSHED, "vacuum 0")}


def switch_table() -> list[list[int]]:
    """The next state by symbol and state. A port that closes outside of a flush begins a new switch."""

    def after(q: int, symbol: str) -> int:
        if (q, symbol) in STEPS:
            return STEPS[q, symbol]
        if (q, symbol) in SKIPPED:
            return MISSING
        if symbol == "port 0":
            return PORT_CLOSED
        return q if q in (IDLE, NORMAL_DONE, VACUUM_DONE, MISSING, DISORDERED) else DISORDERED

    return [[after(q, symbol) for q in range(12)] for symbol in SYMBOLS]


def switch_patterns(changes: DataFrame, role: Column, expected: dict[int, int], tolerance: int, chunk: int = HOUR) -> DataFrame:
    """One row per switch: switch_no, start_us, mode (normal or vacuum, as far as it is known), steps (that came in order), verdict.

    verdict: complete; late, if complete but a step's time since the one before differs from the expected by more than the tolerance; step missing; out of order; unfinished.
    expected: time by the state that a step leads to (for ODOR_FIRST and CHARGING, since the step before). Changes of other lines are no steps. Rows are
    cut into chunks of time, and where the cuts fall changes nothing.
    """
    symbol = F.array_position(F.array(*map(F.lit, SYMBOLS)), F.concat_ws(" ", role, F.col("state").cast("string"))) - 1
    rows = changes.select("session_id", "t_us", "seq", symbol.cast("int").alias("symbol")).where("symbol >= 0")
    rows = automaton(rows, S, "symbol", switch_table(), "q", chunk=chunk)
    rows = neighbours(rows, S, {"_last_us": "t_us"}, chunk=chunk)
    # In the port's closing, a switch may begin anew from the state that a switch begins with.
    begins = (F.col("symbol") == 0) & (F.col("q") == PORT_CLOSED)
    rows = summed(rows, S, begins.cast("long"), "switch_no", chunk=chunk).where("switch_no > 0")
    due = F.try_element_at(F.create_map(*[F.lit(x) for k, v in expected.items() for x in (k, v)]), F.col("q")).cast("long")
    steps = F.array(*map(F.lit, (ODOR_CLOSED, VACUUM_OPEN, FLUSHING, ODOR_FIRST, FLUSHED, CHARGING, NORMAL_DONE, VACUUM_DONE)))
    moved = (F.col("q") != F.col("q_before")) & F.array_contains(steps, F.col("q"))
    late = moved & (F.abs(F.col("t_us") - F.col("_last_us") - due) > tolerance)
    last = F.max_by("q", F.struct("t_us", "seq"))
    table = rows.groupBy("session_id", "switch_no").agg(F.min("t_us").alias("start_us"), F.count_if(moved).alias("steps"), F.count_if(late).alias("_late"), last.alias("_q"), F.max(F.col("q").between(VACUUM_OPEN, CHARGING) | (F.col("q") == VACUUM_DONE)).alias("_vacuum"), F.max(F.col("q") == NORMAL_DONE).alias("_normal"))
    done = F.col("_q").isin(NORMAL_DONE, VACUUM_DONE)
    verdict = F.when(done & (F.col("_late") > 0), "late").when(done, "complete").when(F.col("_q") == MISSING, "step missing").when(F.col("_q") == DISORDERED, "out of order").otherwise("unfinished")
    return table.select("session_id", "switch_no", "start_us", F.when(F.col("_vacuum"), "vacuum").when(F.col("_normal"), "normal").alias("mode"), "steps", verdict.alias("verdict"))


def roi_sum(strips: DataFrame, x0: int, x1: int, y0: int, y1: int, threshold: int = 59, high: int = 255) -> DataFrame:
    """Activity of a region by frame: the sum of an inverse threshold (over it 0, else high) over columns x0 .. x1 and rows y0 .. y1."""
    part = F.slice("pixels", x0 + 1, x1 - x0 + 1)
    total = F.aggregate(part, F.lit(0).cast("long"), lambda s, v: s + F.when(v > threshold, 0).otherwise(high))
    return strips.where(F.col("y").between(y0, y1)).withColumn("_a", total).groupBy("session_id", "t_us").agg(F.sum("_a").alias("activity"))


def region_sums(strips: DataFrame, regions: DataFrame, threshold: int = 59, high: int = 255) -> DataFrame:
    """Activity (as in roi_sum) of many regions (region, x0, x1, y0, y1, bounds included) of each frame: session_id, t_us, region, activity.

    Running sums along a strip, made once, make any region's part of it two look-ups, whatever its width; parts are added by frame and region before the shuffle. Pixels are
    never spread to rows. Regions are a parameter (hundreds) and are broadcast; columns beyond a strip count as nothing, and regions that no strip meets have no row.
    """
    value = F.transform("pixels", lambda v: F.when(v > threshold, 0).otherwise(high).cast("long"))
    along = strips.select("session_id", "t_us", "y", value.alias("_v")).where("_v is not null").withColumn("_n", F.size("_v"))
    table = regions.agg(F.array_sort(F.collect_list(F.struct("region", "x0", "x1", "y0", "y1"))).alias("_regions")).withColumn("_one", F.lit(1))
    rows = along.withColumn("_one", F.lit(1)).join(F.broadcast(table), "_one")
    rows = rows.withColumn("_sums", running_sums(F.col("_v")))
    at = lambda i: F.get("_sums", F.greatest(F.least(i, F.col("_n")), F.lit(0)))
    part = F.transform(F.filter("_regions", lambda r: F.col("y").between(r["y0"], r["y1"])), lambda r: F.struct(r["region"].alias("region"), (at(r["x1"] + 1) - at(r["x0"])).alias("a")))
    return rows.select("session_id", "t_us", F.explode(part).alias("p")).groupBy("session_id", "t_us", F.col("p.region").alias("region")).agg(F.sum("p.a").alias("activity"))


def poke_table(events: DataFrame, line_map: DataFrame, rules: DataFrame, port: int, vacuum: int, odors: tuple[int, ...], chunk: int | None = None) -> DataFrame:
    """One row per beam break with its rule, the delivery inside, and the odor line open then.

    Breaks, rules and valves are one table by session and time, in one shuffle: one pass in the order of time carries rule, odor and vacuum to the rows after them, one
    against it the deliveries and odors to the rows before. At equal times what is looked up comes before what looks it up.
    """
    breaks = beam_breaks(beam(events), chunk).withColumn("t_us", F.col("start_us"))
    valves = valve_intervals(events, chunk=chunk).where(F.col("line").isin(port, vacuum, *odors))
    valves = valves.select("session_id", F.col("start_us").alias("t_us"), "seq", "line", F.col("end_us").alias("close_us")).withColumn("_late", (F.col("line") == port).cast("int"))
    rows = sides(("_b", breaks, 2), ("_rule", rules.select("session_id", "t_us", "seq", "rule_alias"), 0), ("_v", valves, 0)).withColumn("_side", F.coalesce("_v._late", "_side"))
    of = lambda *lines: F.when(F.col("_v.line").isin(*lines), F.col("_v"))
    rows = rows.withColumns({"_odor": of(*odors), "_next": of(*odors), "_vacuum": of(vacuum)})
    rows = filled(rows, S, ["_rule", "_odor", "_vacuum"], "t_us", "seq", ["t_us", "_side", "seq"], chunk)
    flushed = F.coalesce(F.col("_vacuum.close_us").isNull() & F.col("_vacuum").isNotNull() | (F.col("_vacuum.close_us") > F.col("t_us")), F.lit(False))
    rows = rows.withColumn("_port", F.when(~flushed, of(port)))
    rows = rows.select("session_id", "t_us", "seq", "_side", "_b", "_port", "_next", F.col("_rule.rule_alias").alias("rule_alias"), F.col("_odor.line").alias("odor_line"), F.col("_odor.t_us").alias("odor_t_us"), F.col("_odor.close_us").alias("odor_close_us"))
    rows = filled(rows, S, ["_port", "_next"], "t_us", "seq", [F.desc("t_us"), F.desc("_side"), F.desc("seq")], chunk, backwards=True).where("_b is not null")
    inside = F.coalesce(F.col("_port.t_us") < F.coalesce("_b.end_us", F.lit(2**62)), F.lit(False))
    still = F.coalesce(F.col("odor_close_us").isNull() | (F.col("odor_close_us") > F.col("t_us")), F.lit(False)) & F.col("odor_line").isNotNull()
    rows = rows.select(
        "_b.*", "rule_alias", F.when(inside, F.col("_port.t_us")).alias("port_open_us"), F.when(inside, F.col("_port.close_us")).alias("port_close_us"), F.when(still, F.col("odor_line")).alias("odor_line"),
        F.when(still, F.col("odor_t_us")).alias("odor_open_us"), F.when(still, F.col("odor_close_us")).alias("odor_close_us"), F.col("_next.t_us").alias("next_odor_open_us"),
    )
    rows = summed(rows, S, F.col("port_open_us").isNotNull().cast("long"), "stimulus_no", chunk=chunk)
    keys = ["odor_line" if c == "line" else c for c in map_keys(line_map)]
    rows = looked_up(rows, aliases(line_map).withColumnRenamed("line", "odor_line"), keys, "left")
    return rows.select(
        "session_id", "break_no", "start_us", "end_us", "rule_alias", F.array_join("candidates", ",").alias("stimulus"), "odor_line", "stimulus_no", "port_open_us", "port_close_us", "odor_open_us", "odor_close_us", "next_odor_open_us",
    )
