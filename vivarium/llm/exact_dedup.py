"""Exact duplicates with a heavy-hitter split.

A frequent-items sketch (Spark's approx_top_k_accumulate, of the Misra-Gries family) finds digests that may be
frequent. Their exact counts and winners are taken by an aggregation with map-side combining, and those
verified winners, at most HEAVY_MAX rows, are broadcast, so that no row of a large group of copies is
shuffled. The remaining digests use an ordinary shuffle.

Edge cases: a null text counts as empty, and all empty texts are equal. Rows that repeat a doc_id with the same
original text are each marked kept if their id stays; with texts of several lengths only the longest is. A
null doc_id comes after all others. A very long text is hashed whole. An empty table gives an empty table. Other columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import staged

#: Items that the sketch tracks, and so the most winners that are ever broadcast.
HEAVY_MAX = 2000
#: The white space that doesn't count when texts are compared.
WHITE_SPACE = " \t\n\u000b\f\r"
_LAST = 2**63 - 1


def digests(docs: DataFrame) -> DataFrame:
    """doc_id, the sha256 of the text without white space, and the code points of the original text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(F.translate(text, WHITE_SPACE, ""), 256).alias("text_sha256"), F.length(text).cast("long").alias("len"))


def _winner():
    best = F.max(F.struct(F.col("len"), (-F.coalesce("doc_id", F.lit(_LAST))).alias("neg")))
    return [best.alias("best"), F.count(F.lit(1)).alias("group_size")]


def exact_dedup(docs: DataFrame, heavy_share: float = 1e-4, heavy_max: int = HEAVY_MAX) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    heavy_share: a digest of more than this share of the rows, and over 100 rows, counts as frequent.
    """
    rows = staged(digests(docs), "digests")
    n = rows.count()
    least = max(100, int(n * heavy_share))
    sketch = rows.agg(F.expr(f"approx_top_k_estimate(approx_top_k_accumulate(text_sha256, {heavy_max * 4}), {heavy_max})").alias("top"))
    maybe = sketch.select(F.explode("top").alias("x")).select(F.col("x.item").alias("text_sha256"), F.col("x.count").alias("about")).where(F.col("about") > least)
    heavy = staged(rows.join(F.broadcast(maybe.select("text_sha256")), "text_sha256", "left_semi").groupBy("text_sha256").agg(*_winner()), "heavy")

    marked = rows.join(F.broadcast(heavy), "text_sha256", "left")
    same = Window.partitionBy("text_sha256")
    light = marked.where("best is null").drop("best", "group_size").withColumns({"best": F.max(F.struct(F.col("len"), (-F.coalesce("doc_id", F.lit(_LAST))).alias("neg"))).over(same), "group_size": F.count(F.lit(1)).over(same)})
    both = marked.where("best is not null").unionByName(light)
    keep = F.when(F.col("best.neg") != -_LAST, -F.col("best.neg"))
    return both.select("doc_id", keep.alias("keep_id"), "group_size", (keep.eqNullSafe(F.col("doc_id")) & (F.col("len") == F.col("best.len"))).alias("kept"), "text_sha256")


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS len,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents
), w AS (
  SELECT *, count(*) OVER (PARTITION BY text_sha256) AS group_size,
         first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY len DESC, doc_id) AS keep_id
  FROM d
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM w
"""
