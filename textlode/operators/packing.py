"""Packing of units into token-bounded chunks, as higher-order functions.

Units are arrays of struct(t string, n int): a text and the tokens it adds.
``prefix`` tokens count once in every chunk, as an encoder's own prefix does.
Both packers must exist: they differ in where the overlap comes from.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T


def counted_units(units: Column, count: Callable[[Column], Column] = T.word_count) -> Column:
    return F.transform(units, lambda u: F.struct(u.alias("t"), count(u).cast("int").alias("n")))


def _tail(sizes: Column, a: Column, b: Column, room: Column) -> Column:
    """struct(k, n): the longest run of last units of ``sizes[a:b]`` that adds at most ``room`` tokens, and what it adds."""

    def step(s: Column, n: Column) -> Column:
        fits = s["fits"] & F.coalesce(s["n"] + n <= room, F.lit(False))
        return F.struct(F.when(fits, s["k"] + 1).otherwise(s["k"]).alias("k"), F.when(fits, s["n"] + n).otherwise(s["n"]).alias("n"), fits.alias("fits"))

    start = F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"), F.lit(True).alias("fits"))
    return F.aggregate(F.reverse(F.slice(sizes, a + 1, b - a)), start, step, lambda s: F.struct(s["k"].alias("k"), s["n"].alias("n")))


def _groups(sizes: Column, most: int, prefix: int, carried: int = 0) -> Column:
    """Groups of units as array<struct(a, b, n)>: units a to b, which add n tokens.

    An oversized unit stands alone; a full group is closed, and the next begins
    with its end of at most ``carried`` tokens.  Only numbers are folded: texts
    would be copied with every unit.
    """
    group = lambda a, b, n: F.struct(a.alias("a"), b.alias("b"), n.alias("n"))
    start = F.struct(F.array().cast("array<struct<a:int,b:int,n:int>>").alias("done"), F.lit(0).alias("a"), F.lit(0).alias("i"), F.lit(0).alias("n"))

    def closed(s: Column) -> Column:
        return F.when(s["i"] > s["a"], F.array_append(s["done"], group(s["a"], s["i"], s["n"]))).otherwise(s["done"])

    def step(s: Column, n: Column) -> Column:
        over = prefix + n > most
        full = (s["i"] > s["a"]) & (prefix + s["n"] + n > most)
        done = F.when(over, F.array_append(closed(s), group(s["i"], s["i"] + 1, n))).when(full, closed(s)).otherwise(s["done"])

        def opened(lead: Column) -> Column:
            first = F.when(over, s["i"] + 1).when(full, s["i"] - lead["k"]).otherwise(s["a"])
            total = F.when(over, F.lit(0)).when(full, lead["n"] + n).otherwise(s["n"] + n)
            return F.struct(done.alias("done"), first.alias("a"), (s["i"] + 1).alias("i"), total.alias("n"))

        none = F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"))
        if not carried:
            return opened(none)
        return T.bound(F.when(full, _tail(sizes, s["a"], s["i"], F.least(F.lit(carried - prefix), F.lit(most - prefix) - n))).otherwise(none), opened)

    return F.aggregate(sizes, start, step, closed)


def _joined(units: Column, a: Column, b: Column) -> Column:
    return F.array_join(F.transform(F.slice(units, a + 1, b - a), lambda u: u["t"]), " ")


def _sizes(units: Column) -> Column:
    return F.transform(units, lambda u: u["n"])


def pack_scalar(units: Column, most: int = 256, overlap: int = 32, prefix: int = 0) -> Column:
    """Chunks whose overlap is carried inside the running chunk, so that it changes the grouping."""

    def packed(kept: Column) -> Column:
        groups = T.bound(_sizes(kept), lambda sizes: _groups(sizes, most, prefix, overlap))
        return F.transform(groups, lambda g: F.struct(_joined(kept, g["a"], g["b"]).alias("text"), (prefix + g["n"]).alias("num_tokens")))

    return T.bound(F.filter(units, lambda u: T.strip(u["t"]) != ""), packed)


def pack_additive(units: Column, most: int = 256, overlap: int = 32, prefix: int = 0) -> Column:
    """Chunks grouped without overlap; then each gets the fitting end of the group before it."""

    def packed(units: Column, sizes: Column, groups: Column) -> Column:
        def one(g: Column, i: Column) -> Column:
            room = F.least(F.lit(overlap - prefix), F.lit(most - prefix) - g["n"])
            none = F.struct(F.lit(0).alias("k"), F.lit(0).alias("n"))
            lead = F.when(i > 0, _tail(sizes, F.get(groups, i - 1)["a"], g["a"], room)).otherwise(none) if overlap else none
            return T.bound(lead, lambda x: F.struct(_joined(units, g["a"] - x["k"], g["b"]).alias("text"), (prefix + x["n"] + g["n"]).alias("num_tokens")))

        return F.transform(groups, one)

    return T.bound(units, lambda u: T.bound(_sizes(u), lambda sizes: T.bound(_groups(sizes, most, prefix), lambda groups: packed(u, sizes, groups))))


def is_additive(units: list[str], count: Callable[[str], int], ends: int = 8) -> bool:
    """Whether joined neighbours at both ends of a document count as the sum of their parts."""
    if not units:
        return True
    prefix = count("")
    pairs = sorted({*range(min(ends, len(units) - 1)), *range(max(0, len(units) - 1 - ends), max(0, len(units) - 1))})
    adds = [count(u) - prefix for u in units]
    return all(a >= 0 for a in adds) and all(count(f"{units[i]} {units[i + 1]}") == prefix + adds[i] + adds[i + 1] for i in pairs)


def pack_with_counter(units: list[str], count: Callable[[str], int], most: int, overlap: int = 0) -> list[str]:
    """The scalar packer for any counter: every candidate is counted as joined text."""
    if most <= 0 or not 0 <= overlap < most:
        raise ValueError("most must be positive and overlap smaller than most")
    out: list[str] = []
    run: list[str] = []
    for unit in (u.strip() for u in units):
        if not unit:
            continue
        if count(unit) > most:
            out += [" ".join(run)] * bool(run) + [unit]
            run = []
        elif run and count(" ".join([*run, unit])) > most:
            out.append(" ".join(run))
            start = len(run)
            while overlap and start and count(" ".join(run[start - 1 :])) <= overlap:
                start -= 1
            while start < len(run) and count(" ".join([*run[start:], unit])) > most:
                start += 1
            run = [*run[start:], unit]
        else:
            run.append(unit)
    return out + [" ".join(run)] * bool(run)


def additive_plan(adds: list[int], prefix: int, most: int, overlap: int) -> list[tuple[int, int, int]]:
    """(first unit of the lead, first unit, end) of each chunk of units that add ``adds`` tokens each."""
    groups: list[list[int]] = []
    total, whole = 0, False  # whole: the last group may take no more
    for i, n in enumerate(adds):
        alone = prefix + n > most
        if not groups or whole or alone or prefix + total + n > most:
            groups.append([i, i])
            total = 0
        groups[-1][1] = i + 1
        total, whole = total + n, alone
    plan = []
    for g, (a, b) in enumerate(groups):
        room = min(overlap - prefix, most - prefix - sum(adds[a:b])) if g and overlap else -1
        lead = a
        while lead > (groups[g - 1][0] if g else a) and adds[lead - 1] <= room:
            lead -= 1
            room -= adds[lead]
        plan.append((lead, a, b))
    return plan


def pack_exact(units: list[str], counter, most: int, overlap: int = 0) -> tuple[list[str], list[int], bool]:
    """Chunks, their exact counts, and whether the additive plan held.

    Where joined units count as the sum of their parts, chunks are planned by
    sums and then counted as they are.  A count that is not the planned one, or
    neighbours that do not add up, sends the document to the scalar packer.
    ``counter`` has ``count`` and ``count_many``.
    """
    if is_additive(units, counter.count):
        prefix = counter.count("")
        adds = [n - prefix for n in counter.count_many(units)]
        plan = additive_plan(adds, prefix, most, overlap) if all(n >= 0 for n in adds) else None
        if plan is not None:
            chunks = [" ".join(units[lead:b]) for lead, _, b in plan]
            counts = counter.count_many(chunks)
            if counts == [prefix + sum(adds[lead:b]) for lead, _, b in plan]:
                return chunks, counts, True
    chunks = pack_with_counter(units, counter.count, most, overlap)
    return chunks, counter.count_many(chunks), False


EXACT = "struct<units:array<int>,chunks:array<struct<text:string,num_tokens:int>>,additive:boolean>"


def exact_chunks(units: Column, counter, most: int = 256, overlap: int = 32) -> Column:
    """Counts of the units, and the chunks of ``pack_exact``, of each array of units; null gives null."""

    @F.arrow_udf(EXACT)
    def pack(column: pa.Array) -> pa.Array:
        rows = []
        for texts in column.to_pylist():
            if texts is None:
                rows.append(None)
                continue
            chunks, counts, additive = pack_exact(texts, counter, most, overlap)
            rows.append({"units": counter.count_many(texts), "chunks": [{"text": t, "num_tokens": n} for t, n in zip(chunks, counts, strict=True)], "additive": additive})
        chunk = pa.struct([("text", pa.string()), ("num_tokens", pa.int32())])
        return pa.array(rows, pa.struct([("units", pa.list_(pa.int32())), ("chunks", pa.list_(chunk)), ("additive", pa.bool_())]))

    return pack(units)


def counter_packer(count: Callable[[str], int], most: int, overlap: int):
    """A pandas UDF array<string> -> array<string> around ``pack_with_counter``."""

    @F.pandas_udf("array<string>")
    def pack(units: pd.Series) -> pd.Series:
        return units.map(lambda u: pack_with_counter(list(u), count, most, overlap) if u is not None else None)

    return pack


def chunk_rows(docs: DataFrame, chunks: Column, id_col: str = "doc_id", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per chunk: doc_id, chunk_id, posicion (from 0), num_tokens, texto."""
    rows = docs.select(F.col(id_col).alias("doc_id"), *keep, F.posexplode(chunks).alias("posicion", "c"))
    name = F.format_string("%s-chunk-%04d", F.col("doc_id").cast("string"), F.col("posicion"))
    return rows.select("doc_id", name.alias("chunk_id"), *keep, "posicion", F.col("c.num_tokens").alias("num_tokens"), F.col("c.text").alias("texto"))
