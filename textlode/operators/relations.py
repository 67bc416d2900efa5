"""Set operations, ordered sampling, batches and identity of tables."""

from __future__ import annotations

import hashlib
import math

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.staging import Scratch

#: Bytes of values that one range of an identity hash holds, about.
SLICE_BYTES = 16 << 20


def upsert(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Union by key in which rows of ``new`` win; ordered by nothing."""
    both = old.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1)))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.col("_p").desc()))
    return both.withColumn("_r", first).where("_r = 1").drop("_p", "_r")


def merge_incidents(old: DataFrame, new: DataFrame, resolved: Column) -> DataFrame:
    """Incidents that stay, and the new ones."""
    return old.where(~resolved).unionByName(new, allowMissingColumns=True)


def set_changes(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """key and change ('added' or 'removed') between two sets."""
    a, b = before.select(key).distinct(), after.select(key).distinct()
    return b.subtract(a).withColumn("change", F.lit("added")).union(a.subtract(b).withColumn("change", F.lit("removed")))


def count_deltas(before: DataFrame, after: DataFrame, key: str) -> DataFrame:
    """Keys whose number of rows differs: n_before, n_after, delta."""
    a, b = before.groupBy(key).agg(F.count(F.lit(1)).alias("a")), after.groupBy(key).agg(F.count(F.lit(1)).alias("b"))
    out = a.join(b, key, "full_outer").select(key, F.coalesce("a", F.lit(0)).alias("n_before"), F.coalesce("b", F.lit(0)).alias("n_after"))
    return out.withColumn("delta", F.col("n_after") - F.col("n_before")).where("delta <> 0")


def unmatched(left: DataFrame, right: DataFrame, on: Column | str | list[str]) -> DataFrame:
    return left.join(right, on, "left_anti")


def with_children(parents: DataFrame, children: DataFrame, key: str, order: str) -> tuple[DataFrame, DataFrame]:
    """(parents with their children, in order, as one array of rows; children without a parent)."""
    names = [c for c in children.columns if c != key]
    rows = children.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(order, *[c for c in names if c != order]))).alias("children"))
    none = F.array().cast(rows.schema["children"].dataType)
    return parents.join(rows, key, "left").withColumn("children", F.coalesce("children", none)), unmatched(children, parents.select(key), key)


def looked_up(rows: DataFrame, tables: dict[str, tuple[DataFrame, str]]) -> tuple[DataFrame, DataFrame]:
    """(rows with a struct per table, by key; rows with a key that some table lacks, and which)."""
    found, names = rows, list(tables)
    for name, (table, key) in tables.items():
        found = found.join(table.select(F.col(key).alias(f"_{name}"), F.struct("*").alias(name)), F.col(key) == F.col(f"_{name}"), "left").drop(f"_{name}")
    lacking = F.filter(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]), lambda x: x.isNotNull())
    marked = found.withColumn("lacking", lacking)
    return marked.where(F.size("lacking") == 0).drop("lacking"), marked.where(F.size("lacking") > 0).select(*rows.columns, "lacking")


def contract_mismatches(children: DataFrame, parents: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Children whose fields differ from their parent's (nulls equal), with the names of those fields."""
    p = parents.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    bad = F.filter(F.array(*[F.when(~F.col(f).eqNullSafe(F.col(f"_{f}")), F.lit(f)) for f in fields]), lambda x: x.isNotNull())
    return children.join(p, key).withColumn("mismatched", bad).where(F.size("mismatched") > 0).drop(*[f"_{f}" for f in fields])


def ranked(df: DataFrame, order: list[str], by: list[str] | None = None) -> DataFrame:
    """``df`` with ``_i``, the place from 0 on in ``order`` within each group, and ``_n``, the rows of the group.

    No task sorts a group: rows are dealt to ranges of (group, order) and sorted
    there, written with their place in the range, and moved on by the rows that
    the group has in the ranges before.  ``order`` must be total up to equal rows.
    """
    groups = by or []
    work = Scratch(df.sparkSession, "ranked")
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    place = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("bigint"), 33)
    dealt = df.repartitionByRange(n, *groups, *order).sortWithinPartitions(*groups, *order)
    rows = work.keep(dealt.withColumn("_part", F.spark_partition_id()).withColumn("_place", place), "rows")
    here = Window.partitionBy(*[f"_g{i}" for i in range(len(groups))])
    names = [F.col(g).alias(f"_g{i}") for i, g in enumerate(groups)]
    parts = rows.groupBy(*names, F.col("_part").alias("_p")).agg(F.count(F.lit(1)).alias("_c"), F.min("_place").alias("_first"))
    before = F.coalesce(F.sum("_c").over(here.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.withColumn("_base", before - F.col("_first")).withColumn("_n", F.sum("_c").over(here)).drop("_c", "_first")
    same = F.col("_part") == F.col("_p")
    for i, g in enumerate(groups):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return rows.join(parts, same).withColumn("_i", F.col("_base") + F.col("_place")).select(*df.columns, "_i", "_n")


def evenly_spaced(df: DataFrame, k: int, order: list[str], by: list[str] | None = None) -> DataFrame:
    """At most k rows of each group at positions round(i * (n - 1) / (k - 1)), halves to even."""
    numbered = ranked(df, order, by)
    if k == 1:
        return numbered.where("_i = 0").drop("_i", "_n")
    spots = F.transform(F.sequence(F.lit(0), F.lit(k - 1)), lambda i: F.bround(i * (F.col("_n") - 1) / F.lit(k - 1), 0).cast("bigint"))
    return numbered.where((F.col("_n") <= k) | F.array_contains(spots, F.col("_i"))).drop("_i", "_n")


def preferred(df: DataFrame, wanted: Column, by: list[str]) -> DataFrame:
    """Per group the rows that are ``wanted``, or all of a group that has none."""
    marked = df.withColumn("_w", F.coalesce(wanted, F.lit(False)))
    groups = marked.groupBy(*[F.col(g).alias(f"_g{i}") for i, g in enumerate(by)]).agg(F.max("_w").alias("_any"))
    same = F.lit(True)
    for i, g in enumerate(by):
        same = same & F.col(g).eqNullSafe(F.col(f"_g{i}"))
    return marked.join(groups, same).where(F.col("_w") == F.col("_any")).select(*df.columns)


def length_batches(df: DataFrame, size: int, length: str, tie: str) -> DataFrame:
    """Rows numbered by (length, tie) and dealt to batches of ``size``, as an encoder would take them."""
    return ranked(df, [length, tie]).withColumn("batch", F.floor(F.col("_i") / size)).withColumnRenamed("_i", "position").drop("_n")


def padding(batches: DataFrame, length: str, special: int = 2) -> DataFrame:
    """Per batch: rows, longest and padding tokens."""
    n = F.col(length) + special
    return batches.groupBy("batch").agg(F.count(F.lit(1)).alias("rows"), F.max(n).alias("longest"), (F.max(n) * F.count(F.lit(1)) - F.sum(n)).alias("padding"))


def representatives(df: DataFrame, by: list[str], metric: str, tie: str, value: str, highest: bool = True) -> DataFrame:
    """Per group the row of the greatest (or least) metric, the first of equals."""
    key = F.struct(F.col(metric) if highest else -F.col(metric), -F.col(tie))
    return df.groupBy(*by).agg(F.max_by(F.struct(value, metric), key).alias("r")).select(*by, "r.*")


def first_wins(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    return df.withColumn("_r", F.row_number().over(Window.partitionBy(*key).orderBy(*order))).where("_r = 1").drop("_r")


def _lines(batches):
    """The values of each batch as bytes, each followed by a newline."""
    for batch in batches:
        values = batch.column(0).drop_null().to_pylist()
        yield pa.RecordBatch.from_arrays([pa.array(["".join(f"{v}\n" for v in values).encode()], pa.binary())], ["lines"])


def identity_hash(df: DataFrame, order: str, value: str, chunk: int = 100_000) -> DataFrame:
    """n, duplicates and the upper-case SHA-256 of all values in order, each followed by a newline.

    One running digest at every size.  The sorted rows come to the driver in
    consecutive ranges of about ``chunk`` rows and SLICE_BYTES bytes, one at a
    time; how they are cut does not change the digest.
    """
    rows = df.select(F.col(order).alias("o"), F.col(value).cast("string").alias("v"))
    duplicates = F.count(F.lit(1)) - F.countDistinct(F.col(value))
    facts = df.agg(F.count(F.lit(1)).alias("n"), duplicates.alias("duplicates"), F.coalesce(F.sum(F.octet_length(F.col(value).cast("string"))), F.lit(0)).alias("bytes")).first()
    ranges = max(1, math.ceil(facts.n / chunk), math.ceil(facts.bytes / SLICE_BYTES))
    digest, empty = hashlib.sha256(), True
    for r in rows.repartitionByRange(ranges, "o", "v").sortWithinPartitions("o", "v").select("v").mapInArrow(_lines, "lines binary").toLocalIterator():
        digest.update(r.lines)
        empty = empty and not r.lines
    if empty:  # no values are one empty line, as in array_join
        digest.update(b"\n")
    return df.sparkSession.createDataFrame([(facts.n, facts.duplicates, digest.hexdigest().upper())], "n bigint, duplicates bigint, sha256 string")


def semantic_hash(df: DataFrame, fields: list[str], order: str) -> DataFrame:
    """Identity of a projection, free of id columns: rows as JSON with sorted names."""
    return identity_hash(df.select(F.col(order), F.to_json(F.struct(*sorted(fields))).alias("_json")), order, "_json")
