"""Mixing sources to target weights by weighted fair queueing (DataFrame functions only).

Every document of a source is shuffled (order of md5 of its id and size), may be served up to
``max_repeat`` times, and has for each copy a virtual finish time: the words its source has
served with it, divided by the source's target.  The queue is range-sorted by finish time
and cut at the virtual time where the total budget is spent: as the targets share the budget, that is 1
(less for a smaller budget).  A copy that finishes by the cut is taken whole, one in service then gives its
first words up to the cut, one that starts later nothing; so every source serves its target to the word (rounded down).

Scale.  A source is never sorted as a whole: its shuffle order is cut in ranges of the md5's leading
bits (2**k ranges, k from the row count), ranges are pre-aggregated to one number each and these again by
the first half of the bits, so no window holds more than one range of one source or 2**(k/2) sums.
Unpartitioned windows run over one row per source (a list that a person must give weights to) only.

Cases: null text has no words; null source is a source of its own, last; a document without
words takes 0; repeated rows count each by itself; null ids shuffle as the empty string; an
empty table gives an empty result; other columns are carried, and one of a result's name
is replaced by the result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W

from .common import written

_SPACES = "\\x20\\x09-\\x0D"
RANGE_ROWS = 512


def word_count(text: str):
    """Number of [^\\x20\\x09-\\x0D]+ in a text column, as long; null: 0."""
    trimmed = F.expr(f"ltrim(' \\t\\n\\u000B\\f\\r', `{text}`)")
    return F.coalesce(F.length(F.regexp_replace(trimmed, f"[^{_SPACES}]++[{_SPACES}]*+", "x")), F.lit(0)).cast("long")


def targets(sizes: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3) -> DataFrame:
    """source, source_size, target of a (source, size) table.

    Sources in code point order, null last, get the weights in turn and share the sum of all
    sizes; a target stops at max_repeat times its source, the excess goes to the others by weight.
    The level at which shares stop is found in closed form from prefix sums in order of cap/weight."""
    w = F.element_at(F.array(*[F.lit(int(x)).cast("long") for x in weights]), (F.pmod(F.col("_rn") - 1, F.lit(len(weights))) + 1).cast("int"))
    by_source = W.orderBy(F.col("source").asc_nulls_last())
    by_ratio = W.orderBy("_ratio", "_rn")
    before, everything = by_ratio.rowsBetween(W.unboundedPreceding, -1), W.partitionBy()
    return (
        sizes.groupBy("source")
        .agg(F.sum("size").alias("source_size"))
        .withColumn("_rn", F.row_number().over(by_source))
        .withColumn("_w", w)
        .withColumn("_cap", F.col("source_size") * max_repeat)
        .withColumn("_ratio", F.col("_cap").cast("double") / F.col("_w").cast("double"))
        .withColumn("_left", F.sum("source_size").over(everything) - F.coalesce(F.sum("_cap").over(before), F.lit(0)))
        .withColumn("_wleft", F.sum("_w").over(everything) - F.coalesce(F.sum("_w").over(before), F.lit(0)))
        .withColumn("_level", F.col("_left").cast("double") / F.col("_wleft").cast("double"))
        .withColumn("_ok", F.when(F.col("_level") * F.col("_w") <= F.col("_cap"), F.struct("_ratio", "_rn", "_level")))
        .withColumn("_level", F.min("_ok").over(everything)["_level"])
        .select("source", "source_size", F.least(F.col("_level") * F.col("_w"), F.col("_cap").cast("double")).alias("target"))
    )


def _served(start: Column, cut: float) -> Column:
    """Words that a copy gives by the cut, start being the words its source serves before it."""
    size, target = F.col("size"), F.col("target")
    whole = (start + size).cast("double") / target <= cut
    begun = start.cast("double") / target < cut
    part = F.greatest(F.lit(0), F.floor(target * cut) - start)
    return F.when(target > 0, F.when(whole, size).when(begun, part).otherwise(0)).otherwise(0).cast("long")


def mix(docs: DataFrame, weights: Sequence[int] = (1, 2, 3), max_repeat: int = 3, range_rows: int = RANGE_ROWS, seed: str = "mix", cut: float = 1.0) -> DataFrame:
    """docs with size, source_size, target, taken (words the mix takes) and finish (virtual finish
    time of the first copy), range-sorted by finish.  docs needs doc_id and source, and size or text; cut is the share of
    the targets' sum that the budget allows."""
    if "size" not in docs.columns or "text" in docs.columns:
        docs = docs.withColumn("size", word_count("text"))
    docs = docs.drop("source_size", "target", "taken", "finish")
    docs = docs.withColumn("_h", F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.col("size").cast("string"))))
    slim = docs.select("source", "size", "_h")
    if "text" in docs.columns:  # count the words of a table once
        slim = written(slim, "mix-sizes")
    bits = min(32, max(0, (slim.count() - 1) // range_rows).bit_length())
    cell = F.shiftright(F.conv(F.substring("_h", 1, 8), 16, 10).cast("long"), 32 - bits)
    wanted = targets(slim, weights, max_repeat)
    ranges = slim.groupBy("source", cell.alias("_cell")).agg(F.sum("size").alias("_sum")).withColumn("_group", F.shiftright("_cell", bits // 2))
    upto = lambda *group: W.partitionBy("source", *group).rowsBetween(W.unboundedPreceding, -1)
    groups = ranges.groupBy("source", "_group").agg(F.sum("_sum").alias("_total"))
    groups = groups.withColumn("_earlier", F.coalesce(F.sum("_total").over(upto().orderBy("_group")), F.lit(0)))
    groups = groups.alias("g").join(wanted.alias("t"), F.col("g.source").eqNullSafe(F.col("t.source"))).select(F.col("g.source").alias("_s"), F.col("_group").alias("_g"), "_earlier", "source_size", "target")
    ranges = ranges.withColumn("_inside", F.coalesce(F.sum("_sum").over(upto("_group").orderBy("_cell")), F.lit(0)))
    ranges = ranges.join(groups, F.col("source").eqNullSafe(F.col("_s")) & (F.col("_group") == F.col("_g")))
    ranges = ranges.select(F.col("source").alias("_source"), F.col("_cell").alias("_c"), (F.col("_earlier") + F.col("_inside")).alias("_before"), "source_size", "target")
    docs = docs.withColumn("_cell", cell)
    placed = docs.join(ranges, F.col("source").eqNullSafe(F.col("_source")) & (F.col("_cell") == F.col("_c")))
    order = W.partitionBy("source", "_cell").orderBy("_h", "doc_id", "size").rowsBetween(W.unboundedPreceding, 0)
    placed = placed.withColumn("_start", F.col("_before") + F.sum("size").over(order) - F.col("size"))
    taken = sum((_served(F.col("_start") + i * F.col("source_size"), cut) for i in range(max_repeat)), F.lit(0).cast("long"))
    finish = F.when(F.col("target") > 0, (F.col("_start") + F.col("size")).cast("double") / F.col("target"))
    out = placed.withColumn("taken", taken).withColumn("finish", finish)
    out = out.drop("_h", "_cell", "_c", "_source", "_before", "_start")
    return out.repartitionByRange(F.col("finish").asc_nulls_last(), F.col("doc_id")).sortWithinPartitions(F.col("finish").asc_nulls_last(), "doc_id")


def queue(mixed: DataFrame, max_repeat: int = 3, cut: float = 1.0) -> DataFrame:
    """One row per copy served (column copy from 0, words taken of it), in order of finish time."""
    copy = F.explode(F.sequence(F.lit(0), F.lit(max_repeat - 1)))
    start = F.round(F.col("finish") * F.col("target")).cast("long") - F.col("size") + F.col("copy") * F.col("source_size")
    served = mixed.select("*", copy.alias("copy")).withColumn("words", _served(start, cut))
    served = served.where("words > 0").withColumn("finish", F.col("finish") + F.col("copy") * F.col("source_size") / F.col("target"))
    return served.repartitionByRange("finish", "doc_id").sortWithinPartitions("finish", "doc_id", "copy")


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size FROM documents),
e AS (SELECT *, md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || size) AS h FROM d),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS ss FROM d GROUP BY source),
r AS (SELECT source, ss, row_number() OVER (ORDER BY source ASC NULLS LAST) AS rn FROM s),
w AS (SELECT *, (rn - 1) % 3 + 1 AS w, 3 * ss AS cap, CAST(3 * ss AS DOUBLE) / CAST((rn - 1) % 3 + 1 AS DOUBLE) AS ratio FROM r),
p AS (SELECT *, sum(ss) OVER () - coalesce(sum(cap) OVER (ORDER BY ratio, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
             sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY ratio, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS wl FROM w),
l AS (SELECT CAST(lft AS DOUBLE) / CAST(wl AS DOUBLE) AS level FROM p WHERE CAST(lft AS DOUBLE) / CAST(wl AS DOUBLE) * w <= cap ORDER BY ratio, rn LIMIT 1),
t AS (SELECT source, ss, least((SELECT level FROM l) * w, CAST(cap AS DOUBLE)) AS target FROM p),
c AS (SELECT e.*, t.ss, t.target, sum(size) OVER (PARTITION BY e.source ORDER BY h, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - size AS st
      FROM e JOIN t ON e.source IS NOT DISTINCT FROM t.source),
q AS (SELECT *, unnest([st, st + ss, st + 2 * ss]) AS start FROM c)
SELECT doc_id, size, ss AS source_size, target,
       CAST(sum(CASE WHEN target = 0 THEN 0 WHEN CAST(start + size AS DOUBLE) / target <= 1 THEN size WHEN CAST(start AS DOUBLE) / target < 1 THEN greatest(0, CAST(floor(target) AS BIGINT) - start) ELSE 0 END) AS BIGINT) AS taken
FROM q GROUP BY doc_id, h, st, size, ss, target
"""
