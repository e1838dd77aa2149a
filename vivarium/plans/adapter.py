"""The rig log's tables as views of the given tables, in Spark and in SQL.

view and click are beam messages (1, 0), purchase sets and error clears output line k % 10, signup is a camera tick of
channel k % 3, and also a change to rule k % 3. Line 0 is the port, 2 the vacuum, 5 to 9 odors, named after regions, with nations
as aliases. Times are microseconds.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.timeops import HOUR

PORT, VACUUM, ODORS = 0, 2, (5, 6, 7, 8, 9)
#: Hours: minimum poke, minimum and maximum delivery, recording before and after an onset.
MIN_POKE, MIN_DELIVERY, MAX_DELIVERY, PRE, POST = (h * HOUR for h in (2, 3, 24, 12, 24))
#: The table's sessions are sparse: some events a day.
CHUNK = 30 * 24 * HOUR
#: Transitions by rule, as JSON in the three dialects.
RULES = (
    ("cycle", True, '{"AFRICA":["AMERICA"],"AMERICA":["ASIA"],"ASIA":["EUROPE"],"EUROPE":["MIDDLE EAST"],"MIDDLE EAST":["AFRICA"]}'),
    ("bag", False, '{"AFRICA":[{"name":"AMERICA"},{"name":"AMERICA"},{"name":"ASIA"}],"AMERICA":[{"name":"ASIA"},{"name":"EUROPE"}],"ASIA":[{"name":"AFRICA"}],"EUROPE":[{"name":"MIDDLE EAST"},{"name":"AFRICA"}],"MIDDLE EAST":[{"name":"EUROPE"}]}'),
    ("home", True, '{"AFRICA":"AFRICA","AMERICA":"AFRICA","ASIA":"MIDDLE EAST"}'),
)

#: Rules of two steps, in which states lead through the default state.
TWO_STEP = (
    ("any", '{"AFRICA":["DefaultState"],"AMERICA":["DefaultState","ASIA"],"ASIA":["DefaultState"],"DefaultState":["AFRICA","AMERICA"]}'),
    ("loop", '{"AFRICA":["AMERICA"],"AMERICA":["DefaultState"],"DefaultState":["AFRICA","EUROPE"],"EUROPE":["ASIA"]}'),
    ("stuck", '{"AFRICA":["DefaultState"],"AMERICA":["ASIA"],"ASIA":["AMERICA"]}'),
)


@functools.lru_cache(maxsize=64)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table, which doesn't change: its files are listed and its schema is read once a session."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def harp(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, seq, t_us, k, amount, kind, address, value"""
    e = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").cast("int")
    rows = e.select(F.col("user_id").alias("session_id"), F.col("event_id").alias("seq"), F.unix_micros(F.col("ts").cast("timestamp")).alias("t_us"), k.alias("k"), F.col("value").alias("amount"), F.col("event_type").alias("kind"))
    address = F.when(F.col("kind").isin("view", "click"), 32).when(F.col("kind") == "purchase", 35).when(F.col("kind") == "error", 36).when(F.col("kind") == "signup", 68)
    value = F.when(F.col("kind") == "view", 1).when(F.col("kind") == "click", 0).when(F.col("kind") == "signup", F.expr("shiftleft(1, k % 3)")).otherwise(F.expr("shiftleft(1, k % 10)"))
    return rows.withColumns({"address": address, "value": value.cast("long")})


def line_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """name, line, role: odors by region, with nations as aliases of the line; port and vacuum."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    line = lambda c: (F.col(c) + 5).cast("int").alias("line")
    odors = region.select(F.col("r_name").alias("name"), line("r_regionkey"), F.lit("odor").alias("role")).unionByName(nation.select(F.col("n_name").alias("name"), line("n_regionkey"), F.lit("odor").alias("role")))
    fixed = region.where("r_regionkey < 2").select(F.when(F.col("r_regionkey") == 0, "Port").otherwise("Vacuum").alias("name"), F.when(F.col("r_regionkey") == 0, PORT).otherwise(VACUUM).alias("line"), F.when(F.col("r_regionkey") == 0, "port").otherwise("vacuum").alias("role"))
    return odors.unionByName(fixed)


def odor_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As line_map with the region names only: one name per odor line."""
    region = table(spark, sf_dir, "region")
    return region.select(F.col("r_name").alias("name"), (F.col("r_regionkey") + 5).cast("int").alias("line"), F.lit("odor").alias("role"))


def session_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """session_id, name, line, role: the odors by session, whose wiring differs: region r is on line 5 + (r + session) % 5, nations are aliases."""
    region, nation = table(spark, sf_dir, "region"), table(spark, sf_dir, "nation")
    names = region.select(F.col("r_name").alias("name"), F.col("r_regionkey").alias("no")).unionByName(nation.select(F.col("n_name").alias("name"), F.col("n_regionkey").alias("no")))
    every = names.agg(F.collect_list(F.struct("name", "no")).alias("names")).withColumn("one", F.lit(1))  # of the board's few lines
    sessions = table(spark, sf_dir, "events").select(F.col("user_id").alias("session_id")).distinct().withColumn("one", F.lit(1))
    rows = sessions.join(F.broadcast(every), "one").select("session_id", F.explode("names").alias("x"))
    return rows.select("session_id", "x.name", F.expr("cast(5 + (x.no + session_id) % 5 as int)").alias("line"), F.lit("odor").alias("role"))


def rule_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *r) for i, r in enumerate(RULES)], "rule int, rule_alias string, sample_with_replacement boolean, transitions string")


def two_step_rows(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([(i, *r) for i, r in enumerate(TWO_STEP)], "rule int, rule_alias string, transitions string")


#: SQL of the same views, and of the operators that others build on.
HARP = """
h AS (
  SELECT user_id AS session_id, event_id AS seq, epoch_us(ts) AS t_us, json_extract_string(props, '$.k')::INT AS k, value AS amount, event_type AS kind,
    CASE WHEN event_type IN ('view', 'click') THEN 32 WHEN event_type = 'purchase' THEN 35 WHEN event_type = 'error' THEN 36 WHEN event_type = 'signup' THEN 68 END AS address,
    (CASE WHEN event_type = 'view' THEN 1 WHEN event_type = 'click' THEN 0 WHEN event_type = 'signup' THEN 1 << (json_extract_string(props, '$.k')::INT % 3) ELSE 1 << (json_extract_string(props, '$.k')::INT % 10) END)::BIGINT AS value
  FROM events
), lm AS (
  SELECT r_name AS name, (r_regionkey + 5)::INT AS line, 'odor' AS role FROM region UNION ALL SELECT n_name, (n_regionkey + 5)::INT, 'odor' FROM nation
  UNION ALL SELECT 'Port', 0, 'port' UNION ALL SELECT 'Vacuum', 2, 'vacuum'
), rules AS (
  SELECT session_id, t_us, seq, k % 3 AS rule, CASE k % 3 WHEN 0 THEN 'cycle' WHEN 1 THEN 'bag' ELSE 'home' END AS rule_alias FROM h WHERE address = 68
)"""
BEAM = """
beam AS (SELECT *, value & 1 = 1 AS level FROM h WHERE address = 32),
edges AS (SELECT * FROM (SELECT *, coalesce(lag(level) OVER (PARTITION BY session_id ORDER BY t_us, seq), false) AS b FROM beam) WHERE level <> b),
breaks AS (
  SELECT session_id, seq, t_us AS start_us, end_us, row_number() OVER (PARTITION BY session_id ORDER BY t_us, seq) AS break_no
  FROM (SELECT *, lead(t_us) OVER (PARTITION BY session_id ORDER BY t_us, seq) AS end_us FROM edges) WHERE level
), offs AS (SELECT session_id, t_us, seq FROM beam WHERE NOT level),
pokes AS (
  SELECT b.session_id, b.seq, b.t_us, b.t_us + 7200000000 AS armed_us, o.t_us AS off_us FROM beam b ASOF LEFT JOIN offs o ON b.session_id = o.session_id AND b.t_us < o.t_us
  WHERE b.level AND (o.t_us IS NULL OR o.t_us - b.t_us >= 7200000000)
)"""
VALVES = """
states AS (SELECT session_id, seq, t_us, (k % 10)::INT AS line, CASE WHEN address = 35 THEN 1 ELSE 0 END AS state FROM h WHERE address IN (35, 36)),
changes AS (SELECT session_id, seq, t_us, line, state FROM (SELECT *, coalesce(lag(state) OVER (PARTITION BY session_id, line ORDER BY t_us, seq), 0) AS b FROM states) WHERE state <> b),
valves AS (
  SELECT session_id, line, seq, t_us AS start_us, end_us FROM (SELECT *, lead(t_us) OVER (PARTITION BY session_id, line ORDER BY t_us, seq) AS end_us FROM changes) WHERE state = 1
), odor AS (SELECT * FROM valves WHERE line >= 5),
vac AS (SELECT * FROM valves WHERE line = 2),
ports AS (
  SELECT p.session_id, p.line, p.seq, p.start_us, p.end_us FROM (SELECT * FROM valves WHERE line = 0) p ASOF LEFT JOIN vac v ON p.session_id = v.session_id AND p.start_us >= v.start_us
  WHERE v.start_us IS NULL OR v.end_us <= p.start_us
)"""
#: The odors by session.
SESSION_LINES = """
slm AS (
  SELECT s.session_id, n.name, (5 + (n.no + s.session_id) % 5)::INT AS line
  FROM (SELECT DISTINCT user_id AS session_id FROM events) s, (SELECT r_name AS name, r_regionkey AS no FROM region UNION ALL SELECT n_name, n_regionkey FROM nation) n
), sal AS (SELECT session_id, line, string_agg(DISTINCT name, ',' ORDER BY name) AS candidates FROM slm GROUP BY 1, 2)"""
#: The rules as rows: rule, from, place, to.
RULE_ROWS = """
rr(rule, rule_alias, from_state, place, to_state) AS (VALUES
  (0, 'cycle', 'AFRICA', 0, 'AMERICA'), (0, 'cycle', 'AMERICA', 0, 'ASIA'), (0, 'cycle', 'ASIA', 0, 'EUROPE'), (0, 'cycle', 'EUROPE', 0, 'MIDDLE EAST'), (0, 'cycle', 'MIDDLE EAST', 0, 'AFRICA'),
  (1, 'bag', 'AFRICA', 0, 'AMERICA'), (1, 'bag', 'AFRICA', 1, 'AMERICA'), (1, 'bag', 'AFRICA', 2, 'ASIA'), (1, 'bag', 'AMERICA', 0, 'ASIA'), (1, 'bag', 'AMERICA', 1, 'EUROPE'), (1, 'bag', 'ASIA', 0, 'AFRICA'),
  (1, 'bag', 'EUROPE', 0, 'MIDDLE EAST'), (1, 'bag', 'EUROPE', 1, 'AFRICA'), (1, 'bag', 'MIDDLE EAST', 0, 'EUROPE'),
  (2, 'home', 'AFRICA', 0, 'AFRICA'), (2, 'home', 'AMERICA', 0, 'AFRICA'), (2, 'home', 'ASIA', 0, 'MIDDLE EAST')
)"""
#: The rules of two steps as rows.
TWO_STEP_ROWS = """
tr(rule, from_state, to_state) AS (VALUES
  (0, 'AFRICA', 'DefaultState'), (0, 'AMERICA', 'DefaultState'), (0, 'AMERICA', 'ASIA'), (0, 'ASIA', 'DefaultState'), (0, 'DefaultState', 'AFRICA'), (0, 'DefaultState', 'AMERICA'),
  (1, 'AFRICA', 'AMERICA'), (1, 'AMERICA', 'DefaultState'), (1, 'DefaultState', 'AFRICA'), (1, 'DefaultState', 'EUROPE'), (1, 'EUROPE', 'ASIA'),
  (2, 'AFRICA', 'DefaultState'), (2, 'AMERICA', 'ASIA'), (2, 'ASIA', 'AMERICA')
)"""
