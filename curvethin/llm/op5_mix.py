"""Mixing sources to target weights by hash thresholds, without sorting documents.

Every document gets a fixed hash of its doc_id and text (``BITS`` bits), so that rows under a null or repeated id are told apart. For a source whose target is ``target``
words out of ``size``, every document is taken ``floor(target / size)`` times whole, and those below a hash
threshold once more. The threshold of a source is found level by level: words are summed by (source, hash
bucket), the running sum over the buckets finds the one in which the budget runs out, and only the rows in
that boundary bucket are summed again, by the next ``LEVEL_BITS`` bits of their hash. After ``LEVELS`` levels the
boundary is one hash value; it is taken whole if that comes nearer to the budget. Thresholds are nested:
a larger budget takes a superset.

Only histograms (at most 2**LEVEL_BITS rows a source, summed map-side) and one row for each source are ever
grouped, so a source with most of the rows costs no more than others. The table with a row for each source
joins by whatever strategy Spark chooses for its size.

Targets: sources by code point, null last, weigh ``weights`` in turn and share ``share`` of all words;
a target stops at ``cap`` times its source's size and the excess is shared again by weight. The fixed point
is target = min(cap * size, rate * weight); the rate follows from one running sum over the sources.

Defined results: null and empty texts have size 0 and are taken 0 times; rows that repeat in doc_id and text
have one hash and are taken together; a null doc_id hashes as the empty text beside its own; further columns are ignored; an
empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from curvethin.llm import textops as T

WEIGHTS = (5, 2, 1)
SHARE = 1.5
CAP = 2
LEVEL_BITS = 12
LEVELS = 4
BITS = LEVEL_BITS * LEVELS


def size_of(text: Column | str) -> Column:
    """Number of words: characters at which a run of non-separators begins."""
    t = F.coalesce(text, F.lit(""))
    return F.size(F.filter(F.split(t, r"[\x20\x09-\x0D]+"), lambda w: w != "")).cast("long")


def _hash() -> Column:
    key = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit("")))
    return F.conv(F.substring(F.md5(key), 1, BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """source, source_size, target from (source, source_size): one row for each source."""
    w = F.element_at(F.lit(list(weights)), ((F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1) % len(weights) + 1).cast("int"))
    s = sizes.select("source", "source_size", w.alias("weight"))
    every = Window.partitionBy()
    # the sources that reach their cap are the first ones by cap / weight
    by_ratio = Window.orderBy((F.col("source_size") * cap / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    s = s.withColumn("total", F.sum("source_size").over(every)).withColumn("weight_sum", F.sum("weight").over(every))
    s = s.withColumn("capped", F.coalesce(F.sum(F.col("source_size") * cap).over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("lighter", F.coalesce(F.sum("weight").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    s = s.withColumn("rate", (F.col("total") * share - F.col("capped")) / (F.col("weight_sum") - F.col("lighter")))
    # sum(min(cap * size, rate * weight)) lies under each of these lines, so the rate that meets the budget is the largest
    s = s.withColumn("rate", F.max("rate").over(every))
    return s.select("source", "source_size", F.least((F.col("source_size") * cap).cast("double"), F.col("rate") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for each row of (doc_id, text, source)."""
    rows = T.cut(docs.select("doc_id", "source", size_of(F.col("text")).alias("size"), _hash().alias("h")))
    plan = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, cap)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = plan.withColumn("copies", whole.cast("long")).withColumn("budget", F.col("target") - F.col("copies") * F.col("source_size"))
    plan = T.cut(plan.withColumn("done", F.lit(0).cast("long")).withColumn("prefix", F.lit(0).cast("long")))
    for level in range(LEVELS):
        plan = T.cut(_refine(rows, plan, level))
    out = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).drop(plan["source"])
    taken = F.col("size") * (F.col("copies") + F.when(F.col("h") < F.col("prefix"), 1).otherwise(0))
    return out.select("doc_id", "source", "size", "source_size", "target", taken.alias("taken"))


def _refine(rows: DataFrame, plan: DataFrame, level: int) -> DataFrame:
    """``prefix`` is the boundary bucket's number at this level; ``done`` the words in buckets before it.

    After the last level, ``prefix`` is the threshold: hashes below it are taken.
    """
    shift = BITS - LEVEL_BITS * (level + 1)
    last = level == LEVELS - 1
    bucket = F.shiftright("h", shift)
    inside = F.shiftright("h", shift + LEVEL_BITS) == F.col("prefix")
    spot = plan.select(F.col("source").alias("s"), "prefix")
    sums = (rows.join(spot, F.col("source").eqNullSafe(F.col("s"))).where(inside)
            .groupBy("source", bucket.alias("bucket")).agg(F.sum("size").alias("words")))
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sums = sums.withColumn("before", before)
    p = plan.select(F.col("source").alias("s"), F.col("budget").alias("b"), F.col("done").alias("d"))
    left = F.col("b") - F.col("d")
    fits = F.col("before") * 2 + F.col("words") <= 2 * left if last else F.col("before") <= left
    best = (sums.join(p, F.col("source").eqNullSafe(F.col("s"))).where(fits)
            .groupBy("source").agg(F.max(F.struct("bucket", "before", "words")).alias("at")))
    q = best.select(F.col("source").alias("s"), "at")
    out = plan.join(q, F.col("source").eqNullSafe(F.col("s")), "left")
    first = F.col("prefix") * (1 << LEVEL_BITS)
    if last:
        return out.select("source", "source_size", "target", "copies", "budget", "done",
                          F.coalesce(F.col("at.bucket") + 1, first).alias("prefix"))
    return out.select("source", "source_size", "target", "copies", "budget",
                      (F.col("done") + F.coalesce("at.before", F.lit(0))).alias("done"), F.coalesce("at.bucket", first).alias("prefix"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(T.read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


ORACLE = r"""
WITH d AS (
  SELECT doc_id, source, CAST(len(list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || coalesce(text, '')), 1, 12) AS BIGINT) AS h FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight FROM s),
r AS (SELECT *, (1.5 * (SELECT sum(source_size) FROM s)
      - (SELECT coalesce(sum(2 * b.source_size), 0) FROM w b WHERE b.source_size / b.weight < w.source_size / w.weight
          OR (b.source_size / b.weight = w.source_size / w.weight AND coalesce(b.source, chr(1114111)) < coalesce(w.source, chr(1114111)))))
    / ((SELECT sum(weight) FROM w) - (SELECT coalesce(sum(b.weight), 0) FROM w b WHERE b.source_size / b.weight < w.source_size / w.weight
          OR (b.source_size / b.weight = w.source_size / w.weight AND coalesce(b.source, chr(1114111)) < coalesce(w.source, chr(1114111))))) AS rate FROM w),
t AS (SELECT source, source_size, least(CAST(2 * source_size AS DOUBLE),
    (SELECT max(CAST(rate AS DOUBLE)) FROM r) * weight) AS target FROM r),
c AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS copies FROM t),
h AS (SELECT source, h, sum(size) AS words FROM d GROUP BY source, h),
o AS (SELECT *, coalesce(sum(words) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM h),
k AS (SELECT o.source, max(o.h) AS threshold FROM o JOIN c ON o.source IS NOT DISTINCT FROM c.source
  WHERE 2 * o.before + o.words <= 2 * (c.target - c.copies * c.source_size) GROUP BY o.source)
SELECT d.doc_id, d.size, c.source_size, c.target,
  CAST(d.size * (c.copies + CASE WHEN d.h <= k.threshold THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM d JOIN c ON d.source IS NOT DISTINCT FROM c.source LEFT JOIN k ON d.source IS NOT DISTINCT FROM k.source
"""
