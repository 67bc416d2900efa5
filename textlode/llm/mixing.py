"""Mix sources to target weights by systematic sampling.

Sources share the words of all documents by weight.  A source's target stops
at ``cap`` times its own words; what it can't take is shared again among the
others.  With sources in ascending order of cap / weight, the i-th is capped
if its cap / weight is below L_i = (all words - caps before i) / (weights from
i on); L of the first that isn't capped is the level of all that follow.

Every document of a source is expected target / source size times.  Documents
stand in one order within their source, by size class and then by a hash; the
prefix sum of expected copies at rank i is i * rate.  One offset per source is
added, and a document is emitted once for each integer that its step crosses,
so counts are off by less than one document and, because sizes are in order,
words hardly more.

The order is never sorted in one task: ranks are the row number within a cell
(source, size class, hash byte) plus the rows of all cells before.  Those are
summed over the size classes of a source (at most 16 per power of two) and
then over the 256 cells of a class, so neither sum grows with the source.
Sources, one row each, are put in order in one task: that row count, not the
documents', bounds it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ._columns import kept_names
from ..sources.staging import Scratch

WEIGHTS = (5, 2, 1)
CAP = 3
WORD = r"[^\x20\x09-\x0D]+"
RESULTS = ("size", "source_size", "target", "copies", "taken")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def size_class(size: Column) -> Column:
    """Sizes of the same leading five bits, ascending with size."""
    bits = F.length(F.bin(size))
    lead = F.call_function("shiftright", size, F.greatest(bits - 5, F.lit(0)))
    return (bits * 16 + lead % 16).cast("int")


def targets(sources: DataFrame, weights: tuple[int, ...] = WEIGHTS, cap: int = CAP) -> DataFrame:
    """(source, source_size) -> also target: one row per source, nulls last in the order of weights."""
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    ratio = (cap * F.col("source_size")).cast("double") / F.col("w")
    rising = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = rising.rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranked = sources.withColumn("w", weight).withColumn("ratio", ratio)
    room = (F.sum("source_size").over(whole) - cap * F.coalesce(F.sum("source_size").over(before), F.lit(0))).cast("double")
    weight_left = F.sum("w").over(whole) - F.coalesce(F.sum("w").over(before), F.lit(0))  # a frame to the end would be added up anew for every row
    level = ranked.withColumn("level", room / weight_left)
    common = level.withColumn("common", F.max(F.when(F.col("ratio") >= F.col("level"), F.col("level"))).over(whole))
    target = F.least((cap * F.col("source_size")).cast("double"), F.col("common") * F.col("w"))
    return common.select("source", "source_size", target.alias("target"))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", weights: tuple[int, ...] = WEIGHTS, cap: int = CAP, carry: list[str] | None = None) -> DataFrame:
    """How often the mix takes each document.

    Returns the columns ``carry`` (all of ``docs`` if None) and size (words of
    the text, null: 0), source_size, target (double), copies (0 to ``cap``) and
    taken (copies * size).  A null source is a source of its own, last in
    order.  Documents of no words may be emitted but take no words; a mix of no
    words has targets of 0 and no copies.  Ids may be null or repeated: rows
    equal in id and text are interchangeable, and the rows as a whole are the
    same in every run.  An empty table gives an empty table.  Input columns
    named like results, in any case, are replaced.
    """
    work = Scratch(docs.sparkSession, "mix")
    names = kept_names(docs, RESULTS, carry)
    key = F.concat_ws(":", F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("~")), F.coalesce(F.md5(F.col(f"`{text_col}`")), F.lit("~")))
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"), F.col(f"`{source_col}`").alias("_source"), word_count(F.col(f"`{text_col}`")).alias("_size"), F.md5(key).alias("_hash"))
    rows = rows.withColumn("_class", size_class(F.col("_size"))).withColumn("_cell", F.substring("_hash", 1, 2))
    rows = work.keep(rows, "rows")

    cells = work.keep(rows.groupBy("_source", "_class", "_cell").agg(F.count(F.lit(1)).alias("n"), F.sum("_size").alias("words")), "cells")
    running = lambda *by: Window.partitionBy(*by).rowsBetween(Window.unboundedPreceding, -1)
    classes = cells.groupBy("_source", "_class").agg(F.sum("n").alias("n")).withColumn("below", F.coalesce(F.sum("n").over(running("_source").orderBy("_class")), F.lit(0)))
    classes = classes.select(F.col("_source").alias("s"), F.col("_class").alias("c"), "below")
    within = F.coalesce(F.sum("n").over(running("_source", "_class").orderBy("_cell")), F.lit(0))
    base = cells.withColumn("within", within).join(classes, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_class") == F.col("c"))).drop("s", "c").withColumn("base", F.col("below") + F.col("within"))
    aims = targets(cells.groupBy(F.col("_source").alias("source")).agg(F.sum("words").alias("source_size")), weights, cap)
    same = F.col("_source").eqNullSafe(F.col("source"))
    plan = base.join(aims, same).select(F.col("_source").alias("s"), F.col("_class").alias("c"), F.col("_cell").alias("e"), "base", "source_size", "target")
    joined = rows.join(plan, F.col("_source").eqNullSafe(F.col("s")) & (F.col("_class") == F.col("c")) & (F.col("_cell") == F.col("e")))

    rank = F.col("base") + F.row_number().over(Window.partitionBy("_source", "_class", "_cell").orderBy("_hash"))
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    offset = F.conv(F.substring(F.md5(F.coalesce("_source", F.lit("~"))), 1, 5), 16, 10).cast("double") / float(1 << 20)
    step = lambda i: F.floor(F.col("offset") + F.col("rate") * i)
    out = joined.withColumn("rank", rank).withColumn("rate", rate).withColumn("offset", offset)
    out = out.withColumn("copies", F.least(step(F.col("rank")) - step(F.col("rank") - 1), F.lit(cap)).cast("bigint"))
    return out.select("_row.*", F.col("_size").alias("size"), "source_size", "target", "copies", (F.col("copies") * F.col("_size")).alias("taken"))


ORACLE = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         md5(concat_ws(':', coalesce(doc_id::VARCHAR, '~'), coalesce(md5(text), '~'))) AS hash FROM documents),
classed AS (SELECT *, length(bin(size)) * 16 + (size >> greatest(length(bin(size)) - 5, 0)) % 16 AS class FROM sized),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighted AS (SELECT *, [5, 2, 1][((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::INT] AS w FROM sources),
rated AS (SELECT *, (3 * source_size)::DOUBLE / w AS ratio FROM weighted),
levels AS (
  SELECT *, (sum(source_size) OVER () - 3 * coalesce(sum(source_size) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
         / sum(w) OVER (ORDER BY ratio, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM rated),
aims AS (SELECT source, source_size, least((3 * source_size)::DOUBLE, max(level) FILTER (WHERE ratio >= level) OVER () * w) AS target FROM levels),
ranked AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY class, hash) AS i FROM classed),
stepped AS (
  SELECT r.doc_id, r.size, a.source_size, a.target, r.i, CASE WHEN a.source_size > 0 THEN a.target / a.source_size ELSE 0 END AS rate,
         ('0x' || substr(md5(coalesce(r.source, '~')), 1, 5))::BIGINT / 1048576.0::DOUBLE AS u
  FROM ranked r JOIN aims a ON r.source IS NOT DISTINCT FROM a.source)
SELECT doc_id, size, source_size, target, (size * least(floor(u + rate * i) - floor(u + rate * (i - 1)), 3))::BIGINT AS taken FROM stepped
"""
