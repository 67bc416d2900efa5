"""Contracts, audits and statistics over documents, chunks and results."""

from __future__ import annotations

from difflib import SequenceMatcher

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def failures(df: DataFrame, keys: list[str], checks: dict[str, Column]) -> DataFrame:
    """One row per failed check: keys and category.  A check is true where a row is wrong."""
    return df.select(*keys, F.explode(failed(checks)).alias("category"))


def failed(checks: dict[str, Column]) -> Column:
    """Names of the checks that a row fails, as an array."""
    named = F.array(*[F.when(F.coalesce(bad, F.lit(False)), F.lit(name)) for name, bad in checks.items()])
    return F.filter(named, lambda c: c.isNotNull())


def document_checks(id_col: str, text_col: str, language_col: str, languages: tuple[str, ...], prefix: str = "", duplicate: Column | None = None) -> dict[str, Column]:
    text = F.col(text_col)
    checks = {
        "missing_id": F.col(id_col).isNull() | (F.col(id_col).cast("string") == ""),
        "bad_prefix": ~F.col(id_col).cast("string").startswith(prefix) if prefix else F.lit(False),
        "missing_text": text.isNull(),
        "empty_text": text.isNotNull() & T.is_blank(text),
        "bad_language": F.col(language_col).isNotNull() & ~F.col(language_col).isin(*languages),
    }
    return checks | ({"duplicate_id": duplicate} if duplicate is not None else {})


# What documents may say of their format, phenomenon and language.
FORMATS = ("pdf", "html", "txt", "md", "json", "csv", "xlsx", "imagen", "pbf")
PHENOMENA = (1, 2, 3)
LANGUAGES = ("es", "en", "pt", "desconocido")


def strict_document_checks(documents: DataFrame) -> DataFrame:
    """Failed checks of documents (doc_id, fuente, formato, fenomeno, idioma, texto): doc_id, fuente and category."""
    copies = F.count(F.lit(1)).over(Window.partitionBy("doc_id"))
    first = F.row_number().over(Window.partitionBy("doc_id").orderBy("fuente"))
    rows = documents.withColumn("_again", (copies > 1) & (first > 1))
    source = F.col("fuente")
    checks = document_checks("doc_id", "texto", "idioma", LANGUAGES, "DOC-", F.col("_again")) | {
        "bad_source": source.isNull() | (T.strip(source) == ""),
        "absolute_source": source.startswith("/") | source.rlike(r"^[A-Za-z]:[\\/]"),
        "bad_format": ~F.coalesce(F.col("formato").isin(*FORMATS), F.lit(False)),
        "bad_phenomenon": ~F.coalesce(F.col("fenomeno").isin(*PHENOMENA), F.lit(False)),
    }
    return failures(rows, ["doc_id", "fuente"], checks)


def chunk_checks(limit: int = 510) -> dict[str, Column]:
    """Contract of a chunk row."""
    return {
        "empty_text": T.is_blank(F.col("texto")),
        "over_limit": F.col("num_tokens") > limit,
        "no_tokens": F.col("num_tokens") <= 0,
        "bad_chunk_id": F.col("chunk_id") != F.format_string("%s-chunk-%04d", F.col("doc_id").cast("string"), F.col("posicion")),
    }


def position_gaps(chunks: DataFrame, by: str = "doc_id", order: str = "posicion") -> DataFrame:
    """Rows whose position is not that expected in order."""
    expected = F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1
    return chunks.withColumn("expected", expected).where(F.col("expected") != F.col(order))


def chunk_failures(chunks: DataFrame, by: str = "doc_id", order: str = "posicion") -> DataFrame:
    """chunk_id and category: failed checks of the contract, and 'position' of a gap.

    Chunks are made once, and only the names of what failed meet by document.
    """
    checked = chunks.select(by, order, "chunk_id", failed(chunk_checks()).alias("failed"))
    w = Window.partitionBy(by).orderBy(order)
    gap = F.when(F.row_number().over(w) - 1 != F.col(order), F.array(F.lit("position"))).otherwise(F.array().cast("array<string>"))
    return checked.withColumn("gap", gap).select("chunk_id", F.explode(F.concat("failed", "gap")).alias("category"))


def order_violations(rows: DataFrame, by: list[str], order: str, value: str) -> DataFrame:
    """Rows below the running maximum of those before."""
    before = Window.partitionBy(*by).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("running_max", F.max(value).over(before)).where(F.col(value) < F.col("running_max"))


def split_contiguity(parts: DataFrame) -> DataFrame:
    """Parts of hard splits whose coverage does not begin where the one before ends, or whose numbers do not fit."""
    w = Window.partitionBy("chunk_id").orderBy("part_index")
    whole = Window.partitionBy("chunk_id")
    checked = parts.withColumn("previous_end", F.coalesce(F.lag("source_end").over(w), F.lit(0))).withColumn("expected", F.row_number().over(w) - 1).withColumn("n", F.count(F.lit(1)).over(whole))
    return checked.where((F.col("source_start") != F.col("previous_end")) | (F.col("part_index") != F.col("expected")) | (F.col("n") != F.col("part_count")))


def counted_failures(failed: DataFrame, keys: list[str], examples: int = 5) -> DataFrame:
    """category, n and up to ``examples`` keys, the smallest."""
    first = F.row_number().over(Window.partitionBy("category").orderBy(*keys))
    some = failed.withColumn("rn", first).where(F.col("rn") <= examples).groupBy("category").agg(F.array_sort(F.collect_list(F.struct(*keys))).alias("examples"))
    return failed.groupBy("category").agg(F.count(F.lit(1)).alias("n")).join(some, "category")


def result_checks(n_documents: int = 3, n_fragments: int = 10, most_words: int = 250) -> dict[str, Column]:
    docs, frags = F.col("documents"), F.col("fragments")
    ranked = lambda rows: F.transform(rows, lambda r: r["rank"]) == F.transform(rows, lambda _, i: i + 1)
    return {
        "bad_query_id": ~F.col("query_id").cast("string").rlike("^q[0-9]{3}$"),
        "documents": (F.size(docs) != n_documents) | ~ranked(docs),
        "fragments": (F.size(frags) != n_fragments) | ~ranked(frags),
        "fields": F.exists(frags, lambda f: f["chunk_id"].isNull() | f["doc_id"].isNull() | (F.coalesce(f["text"], F.lit("")) == "")),
        "too_long": F.exists(frags, lambda f: T.word_count(f["text"]) > most_words),
    }


# ---- statistics


def distribution(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """count, min, max, mean, median, population deviation and interpolated percentiles."""
    v = F.col(value).cast("double")
    p = F.percentile(v, F.array(*[F.lit(x) for x in (0.25, 0.5, 0.75, 0.9, 0.95, 0.99)]))
    out = df.groupBy(*(by or [])).agg(F.count(v).alias("n"), F.min(v).alias("min"), F.max(v).alias("max"), F.round(F.avg(v), 6).alias("mean"), F.round(F.stddev_pop(v), 6).alias("pstdev"), p.alias("p"))
    names = ("p25", "median", "p75", "p90", "p95", "p99")
    return out.select(*(by or []), "n", "min", "max", "mean", "pstdev", *[F.round(F.col("p")[i], 6).alias(x) for i, x in enumerate(names)])


def nearest_rank(df: DataFrame, value: str, q: float = 0.95, by: list[str] | None = None) -> DataFrame:
    """Percentile by nearest rank, with mean and median."""
    return df.groupBy(*(by or [])).agg(F.expr(f"percentile_disc({q}) WITHIN GROUP (ORDER BY {value})").alias("p95"), F.round(F.avg(value), 6).alias("mean"), F.round(F.median(value), 6).alias("median"))


def bands(value: Column, soft: int, hard: int) -> list[Column]:
    return [F.count_if(value <= soft).alias("within_soft"), F.count_if((value > soft) & (value <= hard)).alias("within_hard"), F.count_if(value > hard).alias("over_hard"), F.max(value).alias("most")]


def utilisation(value: Column, most: int) -> list[Column]:
    share = value / most
    return [F.count_if(share < 0.25).alias("under_25"), F.count_if(share < 0.5).alias("under_50"), F.count_if((share > 0.9) & (share <= 1)).alias("over_90")]


def chunk_totals(chunks: DataFrame, limit: int = 510) -> DataFrame:
    """One row over all chunks: numbers of tokens, chunks over the limit, and maps of chunks by format and by how they were divided."""
    n = F.col("num_tokens")
    by = lambda key: chunks.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n")).agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("k", "n")))).alias("m"))
    formats, ways = by(F.coalesce("formato", F.lit("-"))), by(F.coalesce("hard_split.strategy", F.lit("whole")))
    facts = chunks.agg(F.count(F.lit(1)).alias("n"), F.min(n).alias("min"), F.max(n).alias("max"), F.round(F.avg(n), 6).alias("mean"), F.sum(n).alias("total"), F.count_if(n > limit).alias("over"))
    return facts.join(formats.withColumnRenamed("m", "by_format")).join(ways.withColumnRenamed("m", "by_strategy"))  # one row each


def classifier_report(df: DataFrame, truth: str, found: str, labels: list[str]) -> DataFrame:
    """Confusion counts and accuracy with the ambiguous share, mean confidence and margin, per truth and over all (null).

    ``found`` is a struct (language, confidence, margin, is_ambiguous).
    """
    f = F.col(found)
    counts = [F.count_if(f["language"] == x).alias(f"as_{x}") for x in labels]
    means = [F.round(F.avg((F.col(truth) == f["language"]).cast("int")), 6).alias("accuracy"), F.round(F.avg(f["is_ambiguous"].cast("int")), 6).alias("ambiguous_rate"), F.round(F.avg(f["confidence"]), 6).alias("mean_confidence"), F.round(F.avg(f["margin"]), 6).alias("mean_margin")]
    return df.rollup(truth).agg(F.count(F.lit(1)).alias("n"), *counts, *means)


def stage_metrics(stages: dict[str, dict]) -> dict[str, dict]:
    """Rows a second of each stage and its share of all seconds, from rows and seconds."""
    whole = sum(s.get("seconds", 0.0) for s in stages.values())
    rate = lambda s: round(s["rows"] / s["seconds"], 6) if s.get("rows") is not None and s.get("seconds") else None
    return {k: {"rows_per_second": rate(s), "percent": round(100 * s.get("seconds", 0.0) / whole, 6) if whole else 0.0} for k, s in stages.items()}


def precision_at_k(ranked: DataFrame, relevant: Column, k: int, by: str = "query_id") -> DataFrame:
    """Relevant rows among the first k, over k."""
    return ranked.groupBy(by).agg(F.round(F.count_if(relevant & (F.col("rank") <= k)) / k, 6).alias("precision"))


def judged(rows: DataFrame, by: str = "query_id", grade: str = "grade", least: int = 2) -> DataFrame:
    """Per query: first relevant rank, hits at 1, 3 and 5, reciprocal rank and class."""
    first = F.min(F.when(F.col(grade) >= least, F.col("rank")))
    top = F.max(((F.col("rank") <= 3) & (F.col(grade) == 3)).cast("int")) == 1
    out = rows.groupBy(by).agg(first.alias("first_relevant"), top.alias("top"), F.count_if((F.col(grade) >= least) & (F.col("rank") <= 5)).alias("relevant_5"))
    hits = [F.coalesce(F.col("first_relevant") <= k, F.lit(False)).cast("int").alias(f"hit_{k}") for k in (1, 3, 5)]
    label = F.when(F.col("top"), "GOOD").when(F.col("first_relevant").isNotNull(), "ACCEPTABLE").otherwise("BAD")
    return out.select(by, "first_relevant", *hits, (F.col("relevant_5") / 5).alias("precision_5"), F.round(F.coalesce(1 / F.col("first_relevant"), F.lit(0.0)), 6).alias("reciprocal_rank"), label.alias("class"))


def judged_summary(per_query: DataFrame) -> DataFrame:
    means = {"hit_at_1": "hit_1", "hit_at_3": "hit_3", "hit_at_5": "hit_5", "precision_at_5": "precision_5", "mrr": "reciprocal_rank"}
    return per_query.agg(F.count(F.lit(1)).alias("n_queries"), *[F.round(F.avg(c), 6).alias(k) for k, c in means.items()])


def confusion(df: DataFrame, truth: str, predicted: str, labels: list[str]) -> DataFrame:
    """Rows of truth (and one over all, null) with counts of each prediction and accuracy."""
    counts = [F.count_if(F.col(predicted) == x).alias(f"as_{x}") for x in labels]
    return df.rollup(truth).agg(F.count(F.lit(1)).alias("n"), *counts, F.round(F.avg((F.col(truth) == F.col(predicted)).cast("int")), 6).alias("accuracy"))


def boundary_scores(df: DataFrame, expected: str, found: str, by: str) -> DataFrame:
    """Precision, recall, F1 and exact matches of boundary offsets, per group and over all."""
    both = F.size(F.array_intersect(expected, found))
    out = df.rollup(by).agg(F.sum(both).alias("tp"), F.sum(F.size(found)).alias("n_found"), F.sum(F.size(expected)).alias("n_expected"), F.round(F.avg((F.col(expected) == F.col(found)).cast("int")), 6).alias("exact"))
    p = F.when(F.col("n_found") > 0, F.col("tp") / F.col("n_found")).otherwise(1.0)
    r = F.when(F.col("n_expected") > 0, F.col("tp") / F.col("n_expected")).otherwise(1.0)
    return out.select(by, F.round(p, 6).alias("precision"), F.round(r, 6).alias("recall"), F.round(F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(0.0), 6).alias("f1"), "exact")


def characters_lost(original: Column, rebuilt: Column) -> Column:
    """Characters of a single-spaced text that no matching block of the rebuilt one holds; null where either is null."""

    @F.pandas_udf("int")
    def lost(a: pd.Series, b: pd.Series) -> pd.Series:
        def one(x: str | None, y: str | None) -> int | None:
            if x is None or y is None:
                return None
            left, right = " ".join(x.split()), " ".join(y.split())
            if left == right:
                return 0
            return len(left) - sum(m.size for m in SequenceMatcher(None, left, right).get_matching_blocks())

        return pd.Series([one(x, y) for x, y in zip(a, b, strict=True)], dtype="Int32")

    return lost(original, rebuilt)


def segmentation_scores(df: DataFrame, by: str) -> DataFrame:
    """Scores of sentence lists (expected, found; arrays of strings), per group and over all: boundaries, exact lists, characters lost.

    The share of lost characters is that of all characters expected.
    """
    spaced = lambda c: F.transform(c, lambda s: F.trim(F.regexp_replace(s, f"(?U)[{T.SPACE}]+", " ")))
    rows = df.select(by, spaced(F.col("expected")).alias("x"), spaced(F.col("found")).alias("y"))
    rows = rows.select(by, "x", "y", T.boundary_offsets(F.col("x")).alias("e"), T.boundary_offsets(F.col("y")).alias("f"), F.array_join("x", " ").alias("text"))
    rows = rows.withColumn("lost", characters_lost(F.col("text"), F.array_join("y", " ")))
    scores = boundary_scores(rows, "e", "f", by).drop("exact")
    lost = rows.rollup(by).agg(F.round(F.avg((F.col("x") == F.col("y")).cast("int")), 6).alias("exact"), F.round(F.sum("lost") / F.greatest(F.sum(F.length("text")), F.lit(1)), 6).alias("lost_share"))
    return scores.join(lost.withColumnRenamed(by, "_by"), F.col(by).eqNullSafe(F.col("_by"))).drop("_by")


def repetition(df: DataFrame, by: list[str], seconds: str, digest: str) -> DataFrame:
    """Timing spread of repeated runs and whether all gave one digest."""
    return distribution(df, seconds, by).join(df.groupBy(*by).agg((F.countDistinct(digest) == 1).alias("deterministic")), by)


def inventory(files: DataFrame, path: str = "path", size: str = "length") -> DataFrame:
    return files.groupBy(T.suffix(F.col(path)).alias("extension")).agg(F.count(F.lit(1)).alias("files"), F.sum(size).alias("bytes"))


def compare_segmentations(df: DataFrame) -> DataFrame:
    """Per case: whether two sentence lists (a, b) agree in number and digest, and the first unequal item."""
    same = F.col("a") == F.col("b")
    first = F.filter(F.sequence(F.lit(0), F.greatest(F.size("a"), F.size("b"))), lambda i: ~F.get(F.col("a"), i).eqNullSafe(F.get(F.col("b"), i)))[0]
    return df.select("case_id", (F.size("a") == F.size("b")).alias("count_equal"), same.alias("digest_equal"), F.when(~same, first).alias("first_difference"))
