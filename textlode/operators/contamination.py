"""Leaks of an evaluation bank into a corpus.

Containment is a theta join that is never made as one.  Up to SMALL_BANK
strings go to every task as one automaton, which finds all of them in one pass
over a text.  Strings of a larger bank meet the texts through equality: any
text that contains a string contains its inner words as words, so a string is
keyed by the inner word that fewest texts hold, and only texts with that word
are searched; ids travel, not texts.  Strings without an inner word are
searched in all texts, SMALL_BANK at a time.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from ..functions import text as T
from ..functions import unicode as U
from ..sources.staging import Scratch

#: Strings that go to a task as one automaton.
SMALL_BANK = 2_000
#: Shorter queries match too much (fixed value).
LEAST_CHARACTERS = 20
# Labels of evaluation sheets; two of them in one chunk are suspicious.
MARKERS = ("PREGUNTA:", "FRAGMENTO:", "DOCUMENTO:", "[Hoja: F")
LEAST_MARKERS = 2


def inner_words(name: str) -> Column:
    """The distinct words of a single-spaced text between its first and its last."""
    return F.expr(f"array_distinct(slice(split({name}, ' '), 2, greatest(size(split({name}, ' ')) - 2, 0)))")


def scanned(text: Column, strings: list[str]) -> Column:
    """Positions in ``strings`` of those that a text contains: one pass of an automaton; null for null."""
    places: dict[str, list[int]] = {}
    for i, s in enumerate(strings):
        places.setdefault(s, []).append(i)
    always = places.pop("", [])

    @F.pandas_udf("array<int>")
    def find(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        import ahocorasick

        machine = ahocorasick.Automaton()
        for s, at in places.items():
            machine.add_word(s, at)
        if places:
            machine.make_automaton()
        for texts in batches:
            out = []
            for t in texts:
                seen = {id(at): at for _, at in machine.iter(t)} if t is not None and places else {}
                out.append(None if t is None else sorted([*always, *(i for at in seen.values() for i in at)]))
            yield pd.Series(out)

    return find(text)


def _pairs(rows: DataFrame, keys: DataFrame, small: int) -> DataFrame:
    """(_h, _g) of each text (_h, _t) that contains a string (_g, _q), each pair once."""
    n = keys.limit(small + 1).count()
    if n <= small:
        return _scan(rows, keys)
    keyed = keys.withColumn("_words", inner_words("_q"))
    words = keyed.select("_g", F.explode("_words").alias("_w"))
    held = rows.select("_h", F.explode(F.array_distinct(F.split("_t", " "))).alias("_w")).join(words.select("_w").distinct(), "_w", "left_semi").distinct()
    held = Scratch(rows.sparkSession, "held").keep(held, "held")
    seldom = words.join(held.groupBy("_w").agg(F.count(F.lit(1)).alias("_c")), "_w").groupBy("_g").agg(F.min(F.struct("_c", "_w")).alias("m")).select("_g", F.col("m._w").alias("_w"))
    near = held.join(seldom, "_w").select("_h", "_g").join(rows, "_h").join(keys, "_g")
    found = near.where(F.contains(F.col("_t"), F.col("_q"))).select("_h", "_g").distinct()
    short = keyed.where(F.size("_words") == 0).select("_g", "_q")
    turns = math.ceil(short.count() / small)
    for i in range(turns):
        found = found.union(_scan(rows, short.where(F.pmod(F.xxhash64("_q", "_g"), F.lit(turns)) == i)))
    return found


def _scan(rows: DataFrame, keys: DataFrame) -> DataFrame:
    strings = [tuple(r) for r in keys.select("_g", "_q").distinct().collect()]  # of a checked number
    hits = rows.select("_h", F.explode(scanned(F.col("_t"), [q for _, q in strings])).alias("_k"))
    numbers = F.array(*[F.lit(g) for g, _ in strings]) if strings else F.array().cast("array<bigint>")
    return hits.select("_h", F.get(numbers, F.col("_k")).alias("_g")).distinct()


def contained(texts: DataFrame, bank: DataFrame, id_col: str, text_col: str, bank_id: str, bank_text: str, small: int = SMALL_BANK) -> DataFrame:
    """(id, bank id) of every text that contains a bank text of more than 20 characters, both normalised."""
    rows = texts.select(F.col(id_col), T.normalise_for_match(F.col(text_col)).alias("_t"))
    keys = bank.select(F.col(bank_id), T.normalise_for_match(F.col(bank_text)).alias("_q")).where(F.length("_q") > LEAST_CHARACTERS)
    few = keys.limit(small + 1).collect()
    if len(few) <= small:
        found = rows.select(id_col, F.explode(scanned(F.col("_t"), [r._q for r in few])).alias("_k"))
        names = texts.sparkSession.createDataFrame([(i, r[0]) for i, r in enumerate(few)], StructType([StructField("_k", IntegerType()), bank.schema[bank_id]]))
        return found.join(F.broadcast(names), "_k").select(id_col, bank_id)
    rows, keys = rows.withColumn("_h", F.xxhash64("_t")), keys.withColumn("_g", F.xxhash64("_q"))
    pairs = _pairs(rows.select("_h", "_t").distinct(), keys.select("_g", "_q").distinct(), small)
    # hashes only name candidates: each pair is searched, so equal ones lose and add nothing
    return rows.join(pairs, "_h").join(keys, "_g").where(F.contains(F.col("_t"), F.col("_q"))).select(id_col, bank_id)


def marker_count(text: Column) -> Column:
    return sum((F.contains(text, F.lit(m)).cast("int") for m in MARKERS), F.lit(0))


def report(chunks: DataFrame, bank: DataFrame, excluded_sources: tuple[str, ...] = (), id_col: str = "chunk_id", source_col: str = "fuente", text_col: str = "texto", bank_id: str = "query_id", bank_text: str = "text") -> DataFrame:
    """Rows of chunks with any reason to be left out, and the reasons in order."""
    leaks = contained(chunks, bank, id_col, text_col, bank_id, bank_text)
    named = leaks.groupBy(id_col).agg(F.transform(F.array_sort(F.collect_set(bank_id)), lambda q: F.concat(F.lit("contiene_texto_de_"), q.cast("string"))).alias("_leaks"))
    n = marker_count(F.col(text_col))
    first = F.array(F.when(F.col(source_col).isin(*excluded_sources) if excluded_sources else F.lit(False), "fuente_conocida_excluida"), F.when(n >= LEAST_MARKERS, F.concat(F.lit("marcadores_sospechosos("), n, F.lit(")"))))
    flagged = chunks.join(named, id_col, "left").withColumn("razones", F.concat(F.filter(first, lambda r: r.isNotNull()), F.coalesce("_leaks", F.array().cast("array<string>"))))
    return flagged.where(F.size("razones") > 0).drop("_leaks")


def clean(chunks: DataFrame, flagged: DataFrame, id_col: str = "chunk_id") -> DataFrame:
    return chunks.join(flagged.select(id_col).distinct(), id_col, "left_anti")


def by_source(chunks: DataFrame, leaks: DataFrame, id_col: str, source_col: str, bank_id: str) -> DataFrame:
    """Per source: the distinct bank ids that its chunks hold, sorted, and the number of leaking chunks."""
    joined = leaks.join(chunks.select(id_col, source_col), id_col)
    return joined.groupBy(source_col).agg(F.array_sort(F.collect_set(bank_id)).alias("matched"), F.countDistinct(id_col).alias("n_chunks"))


def matches(texts: DataFrame, bank: DataFrame, id_col: str, text_col: str, bank_id: str, bank_text: str, small: int = SMALL_BANK) -> DataFrame:
    """(id, bank id, kind): whole text contained, strictly or loosely normalised ('exact'), else a beginning of 60 to 80 characters ('prefix').

    One row per row of texts and row of bank; null texts match nothing, an empty
    bank text is contained in every text.
    """
    strict, loose = U.column(U.strict), U.column(U.loose)
    rows = texts.select(id_col, strict(F.col(text_col)).alias("_s"), loose(F.col(text_col)).alias("_l"))
    keys = bank.select(bank_id, strict(F.col(bank_text)).alias("_k"), loose(F.col(bank_text)).alias("_f")).where("_k is not null").withColumn("_p", F.substring("_f", 1, 80))
    work = Scratch(texts.sparkSession, "matches")
    rows, keys = work.keep(rows.where("_s is not null"), "rows"), work.keep(keys, "keys")  # normalised once, used three times
    candidates = None
    for text, string in (("_s", "_k"), ("_l", "_f"), ("_l", "_p")):
        some = keys.where(F.length("_p") >= 60) if string == "_p" else keys
        found = _pairs(rows.select(F.xxhash64("_s", "_l").alias("_h"), F.col(text).alias("_t")).distinct(), some.select(F.xxhash64("_k", "_f").alias("_g"), F.col(string).alias("_q")).distinct(), small)
        candidates = found if candidates is None else candidates.union(found)
    exact = F.contains(F.col("_s"), F.col("_k")) | F.contains(F.col("_l"), F.col("_f"))
    prefix = (F.length("_p") >= 60) & F.contains(F.col("_l"), F.col("_p"))
    both = rows.withColumn("_h", F.xxhash64("_s", "_l")).join(candidates.distinct(), "_h").join(keys.withColumn("_g", F.xxhash64("_k", "_f")), "_g")
    # hashes only name candidates: each pair is searched, so equal ones lose and add nothing
    return both.where(exact | prefix).select(id_col, bank_id, F.when(exact, "exact").otherwise("prefix").alias("kind"))
