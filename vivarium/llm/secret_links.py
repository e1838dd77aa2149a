r"""Secrets in texts, and multipart credentials linked by position, in Spark expressions only.

Parts of a text are intervals of code points. Three kinds stand for themselves and are always reported: assignments to names of secrets
(assign), access identifiers (access) and long runs of hexadecimal digits (hex). Four are weak: names of accounts with a value
(identifier), e-mail addresses (account), addresses of services (endpoint), and unlabelled runs of mixed characters (value). A weak part is
reported only with what completes it to a credential, in the same scope, which is a paragraph, and at most REACH code points away: an
identifier or account with a secret (assign, hex, value), a value with an identifier (access, identifier, account), an endpoint with both.

The join of the intervals: parts of texts that may hold a credential are dealt by text and sorted; scopes are counted there, and two passes
over the sorted parts, up and down, carry the nearest end and start of identifiers and of secrets. A part has a complement within
reach exactly if the nearest one is, so no pairs are made, however many parts a text has. Values, and hex digits, inside an assignment,
identifier, account or endpoint are its own value, and are no part beside it.

Edge cases: a null text counts as empty. A very long text is searched whole; patterns repeat single characters only, so none recurses. Repeated
rows give repeated rows (their text is linked once). A null doc_id is kept. Texts without parts give empty spans. An empty table gives an
empty table. Other columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common


def _either(word: str) -> str:
    """A word whose letters stand in either case."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in word)


def _names(*words: str) -> str:
    return "(?:" + "|".join(map(_either, words)) + ")"


_IS = r"[\"']?\x20*[:=]\x20*[\"']?"
KINDS = ("assign", "access", "hex", "identifier", "account", "endpoint", "value")
#: A pattern for each kind. A run of hexadecimal digits, or of an access identifier, that is long enough is matched at the place where the shorter pattern
#: of any length would match it, as such runs end at the same character. assign and identifier: group 1 is the value.
PATTERNS = (
    _names("password", "passwd", "secret", "token", "api_?key") + _IS + r"([A-Za-z0-9+/_.=-]+)",
    r"AKIA[A-Z0-9]{16,}",
    r"[0-9a-f]{24,}",
    _names("access", "account", "client", "tenant", "user") + "[_-]?" + _names("id", "name", "key_?id") + _IS + r"([A-Za-z0-9@._-]+)",
    r"[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]+\.[A-Za-z0-9.-]*[A-Za-z0-9]",
    _names("https?", "ftp", "mongodb", "postgres", "postgresql", "mysql", "redis", "amqp", "s3") + r"://[A-Za-z0-9._~:/?#@!$&*+,;=%-]+",
    r"[A-Za-z0-9+/_=-]{16,}",
)
#: Without effect on what is matched, but on the time: what stands before each pattern, so that a run isn't tried again from within and only first letters are looked at;
#: and strings of which a text that has matches holds one.
AHEAD = ("(?=[PpSsTtAa])", "", "(?<![0-9a-f])", "(?=[AaCcTtUu])", "", "(?=[HhFfMmPpRrAaSs])", "(?<![A-Za-z0-9+/_=-])")
HELD = ((":", "="), ("AKIA",), (), (":", "="), ("@",), ("://",), ())
#: Which kinds, by number, are identifiers, secrets, and what may hold a value or hex digits of its own.
_IDS, _SECRETS, _AROUND = (1, 3, 4), (0, 2, 6), (0, 3, 4, 5)
#: Code points of the value that an assignment and an identifier have at least.
ASSIGNED, NAMED = 6, 3
#: Between paragraphs.
GAP = r"\n[\x20\t\r]*\n"
#: Code points between the parts of a credential at most.
REACH = 300
#: Numbers that one running sum inside a row spans.
_CHUNK = 256


def _let(value: Column, body) -> Column:
    """body(value), with the value worked out once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _running(lengths: Column) -> Column:
    """The running sums of an array, in chunks and over the chunks: sums are put behind an array, which copies it."""
    put = lambda acc, x: F.concat(acc, F.array(F.coalesce(F.try_element_at(acc, F.lit(-1)), F.lit(0)) + x))
    none = F.array().cast("array<int>")
    chunks = F.transform(F.sequence(F.lit(0), F.floor((F.size(lengths) - 1) / _CHUNK).cast("int")), lambda c: F.aggregate(F.slice(lengths, c * _CHUNK + 1, F.lit(_CHUNK)), none, put))

    def joined(runs: Column) -> Column:
        before = F.aggregate(runs, F.array(F.lit(0)), lambda acc, run: put(acc, F.try_element_at(run, F.lit(-1))))  # one more than the runs
        return F.flatten(F.filter(F.zip_with(runs, before, lambda run, base: F.transform(run, lambda x: x + base)), lambda run: run.isNotNull()))

    return F.when(F.size(lengths) > 0, _let(chunks, joined)).otherwise(none)


_SPANS = "array<struct<s: int, k: int, e: int>>"


def _spans(rows: DataFrame, name: str, pattern: str, k: int, keep=None, held: tuple = ()) -> DataFrame:
    """Adds the spans (s, k, e) of the matches: the text is split at them, and lengths are summed. keep: of a match; held: as HELD."""
    found = F.regexp_extract_all("text", F.lit(pattern), F.lit(0))
    if held:
        found = F.when(reduce(lambda a, b: a | b, [F.col("text").contains(x) for x in held]), found).otherwise(F.array().cast("array<string>"))
    rows = rows.withColumn("_m", found)
    rows = rows.withColumn("_g", F.when(F.size("_m") > 0, F.transform(F.slice(F.split("text", pattern, -1), F.lit(1), F.size("_m")), F.length)))
    rows = rows.withColumn("_e", _running(F.zip_with("_g", "_m", lambda g, m: g + F.length(m))))
    spans = F.zip_with("_e", "_m", lambda e, m: F.struct((e - F.length(m)).alias("s"), F.lit(k).alias("k"), e.alias("e"), m.alias("m")))
    if keep is not None:
        spans = F.filter(spans, lambda x: keep(x["m"]))
    spans = F.transform(spans, lambda x: F.struct(x["s"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return rows.withColumn(name, F.when(F.size("_m") > 0, spans).otherwise(F.array().cast(_SPANS))).drop("_m", "_g", "_e")


def _mixed(m: Column) -> Column:
    return m.rlike("[0-9]") & m.rlike("[A-Z]") & m.rlike("[a-z]")


def parts(docs: DataFrame) -> DataFrame:
    """doc_id; base and weak (arrays of s, k, e); and, for texts that may hold a credential, key (of id and text) and gaps (where paragraphs begin), staged."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keep = {0: lambda m: F.length(F.regexp_extract(m, PATTERNS[0], 1)) >= ASSIGNED, 3: lambda m: F.length(F.regexp_extract(m, PATTERNS[3], 1)) >= NAMED, 6: _mixed}
    for k, pattern in enumerate(PATTERNS):
        rows = _spans(rows, KINDS[k], AHEAD[k] + pattern, k, keep.get(k), HELD[k])
    some = lambda *kinds: F.greatest(*[F.size(x) for x in kinds]) > 0
    may = some("access", "identifier", "account") & some("assign", "hex", "value") & some(*KINDS[3:])
    rows = rows.withColumn("key", F.when(may, F.md5(F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("text")))))
    rows = _spans(rows.withColumn("text", F.when(may, F.col("text")).otherwise("")), "gaps", GAP, -1)
    gaps = F.transform("gaps", lambda x: F.struct(x["e"].alias("s"), x["k"].alias("k"), x["e"].alias("e")))
    return common.staged(rows.select("doc_id", "key", F.concat("assign", "access", "hex").alias("base"), F.concat(*KINDS[3:]).alias("weak"), gaps.alias("gaps")), "parts")


def linked(found: DataFrame, reach: int = REACH) -> DataFrame:
    """key, spans: the weak parts that are completed to a credential."""
    rows = found.select("key", F.explode(F.concat("base", "weak", "gaps")).alias("x")).select("key", "x.*")
    up = Window.partitionBy("key").orderBy("s", "k", "e")
    so_far = up.rowsBetween(Window.unboundedPreceding, -1)
    around = F.max(F.when(F.col("k").isin(*_AROUND), F.col("e"))).over(so_far)
    rows = rows.withColumns({"inner": F.col("k").isin(2, 6) & F.coalesce(around > F.col("s"), F.lit(False)), "scope": F.sum(F.when(F.col("k") < 0, 1).otherwise(0)).over(up.rowsBetween(Window.unboundedPreceding, Window.currentRow))})
    rows = rows.where("k >= 0 and not (k = 6 and inner)")
    is_id, is_secret = F.col("k").isin(*_IDS), F.col("k").isin(*_SECRETS) & ~F.col("inner")
    before = Window.partitionBy("key", "scope").orderBy("s", "k", "e").rowsBetween(Window.unboundedPreceding, -1)
    after = Window.partitionBy("key", "scope").orderBy(F.desc("s"), F.desc("k"), F.desc("e")).rowsBetween(Window.unboundedPreceding, -1)
    near = {}
    for name, kind in (("id", is_id), ("secret", is_secret)):
        near[f"{name}_before"] = F.max(F.when(kind, F.col("e"))).over(before)
        near[f"{name}_after"] = F.min(F.when(kind, F.col("s"))).over(after)
    rows = rows.withColumns(near)
    has = lambda name: F.coalesce(F.col("s") - F.col(f"{name}_before") <= reach, F.lit(False)) | F.coalesce(F.col(f"{name}_after") - F.col("e") <= reach, F.lit(False))
    told = F.when(F.col("k").isin(3, 4), has("secret")).when(F.col("k") == 6, has("id")).when(F.col("k") == 5, has("id") & has("secret")).otherwise(False)
    return rows.where(told).groupBy("key").agg(F.collect_list(F.struct("s", "k", "e")).alias("spans"))


def _text(spans: Column) -> Column:
    """kind:start:end of each span, by start, then kind as listed."""
    kinds = F.array(*[F.lit(x) for x in KINDS])
    return F.array_join(F.transform(F.array_sort(spans), lambda x: F.concat_ws(":", F.get(kinds, x["k"]), x["s"].cast("string"), x["e"].cast("string"))), ",")


def secret_spans(docs: DataFrame, reach: int = REACH) -> DataFrame:
    """One row per document: doc_id, n_assign, n_access, n_hex, base_sha256, spans (all of them, as kind:start:end)."""
    found = parts(docs)
    open_rows = found.where("key is not null")
    added = linked(open_rows.dropDuplicates(["key"]), reach)
    none = F.array().cast(_SPANS)
    # Most texts hold no credential; they have no key and aren't joined.
    rows = found.where("key is null").withColumn("spans", none).unionByName(open_rows.join(added, "key", "left").withColumn("spans", F.coalesce("spans", none)))
    of = lambda k: F.size(F.filter("base", lambda x: x["k"] == k)).cast("long").alias(f"n_{KINDS[k]}")
    return rows.select("doc_id", of(0), of(1), of(2), F.sha2(_text(F.col("base")), 256).alias("base_sha256"), _text(F.concat("base", "spans")).alias("spans"))


def _sql() -> str:
    q = lambda pattern: "'" + pattern.replace("'", "''") + "'"
    raw = " UNION ALL ".join(f"SELECT doc_id, {k} AS k, regexp_extract_all(t, {q(p)}) AS m, string_split_regex(t, {q(p)}) AS g FROM d" for k, p in ((-1, GAP), *enumerate(PATTERNS)))
    kinds = "[" + ", ".join(f"'{x}'" for x in KINDS) + "]"
    joined = lambda cond: f"coalesce(string_agg({kinds}[k + 1] || ':' || s || ':' || e, ',' ORDER BY s, k, e) FILTER ({cond}), '')"
    has = lambda c: f"(coalesce(s - {c}_before <= {REACH}, false) OR coalesce({c}_after - e <= {REACH}, false))"
    near = ", ".join(f"max(CASE WHEN {cond} THEN e END) OVER lower AS {n}_before, min(CASE WHEN {cond} THEN s END) OVER upper AS {n}_after" for n, cond in (("id", f"k IN {_IDS}"), ("secret", f"k IN {_SECRETS} AND NOT inside")))
    return f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
r AS ({raw}),
x AS (SELECT doc_id, k, m[i] AS m, (sum(length(g[i]) + length(m[i])) OVER (PARTITION BY doc_id, k ORDER BY i))::BIGINT AS e FROM (SELECT *, unnest(range(1, len(m) + 1)) AS i FROM r)),
p AS (
  SELECT doc_id, CASE WHEN k < 0 THEN e ELSE e - length(m) END AS s, k, e FROM x WHERE CASE k WHEN 0 THEN length(regexp_extract(m, {q(PATTERNS[0])}, 1)) >= {ASSIGNED}
    WHEN 3 THEN length(regexp_extract(m, {q(PATTERNS[3])}, 1)) >= {NAMED} WHEN 6 THEN regexp_matches(m, '[0-9]') AND regexp_matches(m, '[A-Z]') AND regexp_matches(m, '[a-z]') ELSE true END
), i AS (
  SELECT *, k IN (2, 6) AND coalesce(max(CASE WHEN k IN {_AROUND} THEN e END) OVER (w ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) > s, false) AS inside,
    sum(CASE WHEN k < 0 THEN 1 ELSE 0 END) OVER (w ROWS UNBOUNDED PRECEDING) AS scope FROM p WINDOW w AS (PARTITION BY doc_id ORDER BY s, k, e)
), n AS (
  SELECT *, {near} FROM i WHERE k >= 0 AND NOT (k = 6 AND inside)
  WINDOW lower AS (PARTITION BY doc_id, scope ORDER BY s, k, e ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), upper AS (PARTITION BY doc_id, scope ORDER BY s, k, e ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING)
), o AS (SELECT doc_id, s, k, e, k < 3 OR CASE k WHEN 3 THEN {has('secret')} WHEN 4 THEN {has('secret')} WHEN 6 THEN {has('id')} ELSE {has('id')} AND {has('secret')} END AS told FROM n)
SELECT d.doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access, count(*) FILTER (k = 2) AS n_hex, sha256({joined('k < 3')}) AS base_sha256, {joined('told')} AS spans
FROM d LEFT JOIN o USING (doc_id) GROUP BY d.doc_id"""


SQL = _sql()
