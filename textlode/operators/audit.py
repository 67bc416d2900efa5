"""Audits of units and chunks: cheap filters first, exact counts only where needed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T

# Formats of tables and images, names of fields, and what may close a sentence.
STRUCTURED = ("csv", "xlsx", "xls", "tsv", "pbf", "imagen")
FIELD = r"(?i)(?:^|\s)(?:title|date|authors?\[\d+\]|abstract|keywords?\[\d+\]|doi|issue|body_paragraphs\[\d+\]|lists\[\d+\]|alerta_meta\.[^: ]+):"
TERMINAL = r"[.!?…][\"'”’»)\]}]*$"


def is_structural(fmt: Column, text: Column, split: Column, found: Column | None = None) -> Column:
    """Tables, divided chunks, field lists and short or upper-case texts: no prose to judge; ``found`` are the words of ``text``."""
    found = T.words(text) if found is None else found
    alpha = F.filter(found, lambda w: w.rlike(r"\p{L}"))
    bare = lambda w: F.regexp_replace(w, r"^[.,:;()\[\]]+|[.,:;()\[\]]+$", "")
    upper = F.size(F.filter(alpha, lambda w: (F.upper(bare(w)) == bare(w)) & (F.lower(bare(w)) != bare(w))))
    low = F.lower(fmt)
    loud = (F.size(found) <= 40) & (F.size(alpha) > 0) & (upper / F.greatest(F.size(alpha), F.lit(1)) >= 0.7)
    return F.when(low.isin(*STRUCTURED) | F.coalesce(split, F.lit(False)), True).when(low == "json", F.regexp_count(text, F.lit(FIELD)) >= 2).otherwise((F.size(found) <= 12) | loud)


def continues(left: Column, right: Column, found: Column | None = None) -> Column:
    """Whether ``right`` seems to go on in the sentence that ends ``left``; ``found`` are the words of ``left``."""
    found = T.words(left) if found is None else found
    last = F.regexp_replace(F.lower(F.element_at(F.concat(F.array(F.lit("")), found), -1)), r"^[.,;:!?…()\[\]{}\"'”’»-]+|[.,;:!?…()\[\]{}\"'”’»-]+$", "")
    first = F.regexp_extract(right, r"\p{L}", 0)
    open_end = F.regexp_replace(left, r"\s+$", "").rlike("[,–-]$")
    lower = (first != "") & (F.lower(first) == first) & (F.upper(first) != first)
    return T.looks_like_prose(left, found=found) & (T.strip(right) != "") & (lower | last.isin(*T.CONNECTORS) | open_end)


def _bare_end(text: Column) -> Column:
    """No white space at the end; a text without any is not searched for it."""
    return F.when(F.right(text, F.lit(1)).rlike(r"(?U)\s"), F.regexp_replace(text, r"(?U)\s+$", "")).otherwise(text)


def neighbours(chunks: DataFrame, by: str = "doc_id", order: str = "posicion", text: str = "texto", fmt: Column | None = None, split: Column | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Every chunk with its number of ``words`` and, of the pair with the chunk before, shared_words, cuts_sentence and doubtful.

    ``paired`` says whether there is such a pair; without one the others are null.
    Each text is cut into words once, in a column of its own.
    """
    w = Window.partitionBy(by).orderBy(order)
    form, divided = fmt if fmt is not None else F.lit("txt"), split if split is not None else F.lit(False)
    before = F.lag(F.struct(F.col(text).alias("t"), form.alias("f"), divided.alias("d"))).over(w)
    base, left, a, b = [by, order, *keep], F.col("_left"), F.col("_a"), F.col("_w")
    rows = chunks.withColumn("_b", before).select(*base, F.col("_b.f").alias("_f"), F.col("_b.d").alias("_d"), F.col("_b.t").isNotNull().alias("paired"), _bare_end(F.col("_b.t")).alias("_left"), T.words(F.col(text)).alias("_w"))
    rows = rows.select(*base, "_f", "_d", "paired", left, T.words(left).alias("_a"), b)
    rows = rows.select(*base, "_f", "_d", "paired", left, a, b, F.when(F.col("paired"), T.shared_words(a, b)).alias("shared_words"))
    fresh = F.array_join(F.slice(b, F.col("shared_words") + 1, F.greatest(F.size(b) - F.col("shared_words"), F.lit(0))), " ")
    open_end = ~left.rlike(TERMINAL) & ~is_structural(F.col("_f"), left, F.col("_d"), a)
    rows = rows.select(*base, "paired", left, a, F.coalesce(F.size(b), F.lit(0)).alias("words"), "shared_words", open_end.alias("_open"), F.when(open_end, fresh).alias("_fresh"))
    rows = rows.select(*base, "paired", left, a, "words", "shared_words", "_open", (F.col("_open") & continues(left, F.col("_fresh"), a)).alias("cuts_sentence"))
    return rows.select(*base, "paired", "words", "shared_words", "cuts_sentence", (F.col("_open") & ~F.col("cuts_sentence") & T.looks_like_prose(left, found=a)).alias("doubtful"))


def adjacent_pairs(chunks: DataFrame, by: str = "doc_id", order: str = "posicion", text: str = "texto", fmt: Column | None = None, split: Column | None = None) -> DataFrame:
    """Each chunk with the one before: shared words, whether the boundary cuts a sentence, and whether it may.

    A boundary is doubtful where prose ends without a sentence end and nothing
    shows that the next chunk goes on.  ``fmt`` and ``split`` are the format of
    a chunk and whether it was divided.
    """
    return neighbours(chunks, by, order, text, fmt, split).where("paired").select(by, order, "shared_words", "cuts_sentence", "doubtful")


def preflight(units: DataFrame, count: Column, unit: str, limit: int) -> DataFrame:
    """Units over the limit by class; ``count`` is taken only where the length in compatibility form allows an excess.

    That form is at most 33 bytes for one sign, and of signs outside ASCII there
    are no more than the UTF-8 length exceeds the length.
    """
    n = F.octet_length(unit)
    near = units.where(n + 33 * (n - F.length(unit)) + 4 > limit).withColumn("n_tokens", count)
    over = near.where(F.col("n_tokens") > limit)
    return over.withColumn("class", F.when(T.is_structural_oversize(F.col(unit)), "STRUCTURAL_MULTI_UNIT").otherwise("AMBIGUOUS"))


def sentence_loss(units: DataFrame, chunks: DataFrame, by: str = "doc_id", text: str = "texto") -> DataFrame:
    """(by, unit, said, missing): sentences that the chunks of a document hold less often than the document, as multisets.

    What chunks repeat as overlap counts more than once, so a sentence is only
    missing if all its places together are too few.  Both sides are counted in
    one aggregation: neither is sorted to be joined.
    """
    one, none = F.lit(1).cast("bigint"), F.lit(0).cast("bigint")
    said = units.select(by, "unit", one.alias("said"), none.alias("kept"))
    kept = chunks.select(by, F.explode(T.sentence_units(F.col(text))).alias("unit"), none.alias("said"), one.alias("kept"))
    both = said.unionByName(kept).groupBy(by, "unit").agg(F.sum("said").alias("said"), F.sum("kept").alias("kept"))
    return both.withColumn("missing", F.col("said") - F.col("kept")).where("missing > 0").select(by, "unit", "said", "missing")


def overlap_report(chunks: DataFrame, by: str = "doc_id", order: str = "posicion", text: str = "texto") -> DataFrame:
    """Pairs, pairs with overlap, mean overlap words and share of repeated words."""
    facts = neighbours(chunks, by, order, text).agg(
        F.count_if("paired").alias("pairs"), F.count_if(F.col("shared_words") > 0).alias("overlapping"), F.round(F.avg("shared_words"), 6).alias("mean_shared"),
        F.sum("shared_words").alias("shared"), F.count_if("cuts_sentence").alias("cut_sentences"), F.sum("words").alias("words"),
    )
    return facts.select("pairs", "overlapping", "mean_shared", "cut_sentences", F.round(F.col("shared") / F.col("words"), 6).alias("repeated_share"))


def language_report(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per detected language: documents, share, mean confidence and margin, ambiguous ones."""
    scored = docs.select(T.language_scores(F.col(text)).alias("s"))  # a column of its own, so that it is computed once
    found = scored.select(T.decide_language(F.col("s")).alias("d")).select("d.*")
    share = F.round(100 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6)
    out = found.groupBy("language").agg(F.count(F.lit(1)).alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"), F.round(F.avg("margin"), 6).alias("mean_margin"), F.count_if("is_ambiguous").alias("ambiguous"))
    return out.withColumn("percent", share)


def corpus_quality(docs: DataFrame, chunks: DataFrame, most: int = 256, limit: int = 510) -> DataFrame:
    """One row per detected language and one over all (null): the quality of a chunked corpus.

    ``docs`` has doc_id, texto and maybe ``lang``, a trusted label; ``chunks``
    doc_id, posicion, num_tokens, texto.  Documents, chunks, documents of no or
    one sentence, accuracy over labelled documents, mean confidence and margin,
    ambiguous documents, tokens, shares of chunks under 25 % and 50 % and over
    90 % of the limit, chunks over the hard one, repeated words, cut and missing
    sentences.
    """
    label = F.col("lang") if "lang" in docs.columns else F.lit(None).cast("string")
    judged = docs.select("doc_id", label.alias("lang"), "texto", T.language_scores(F.col("texto")).alias("s")).withColumn("d", T.decide_language(F.col("s")))
    sentences = F.size(T.sentence_units(F.coalesce("texto", F.lit(""))))
    facts = judged.select("doc_id", "d.*", "lang", sentences.alias("sentences"), (F.col("lang") == F.col("d.language")).cast("int").alias("right"))
    n, share = F.col("num_tokens"), F.col("num_tokens") / most
    own = neighbours(chunks, keep=("num_tokens",)).groupBy("doc_id").agg(  # chunks meet by document once
        F.count(F.lit(1)).alias("chunks"), F.sum(n).alias("tokens"), F.max(n).alias("longest"), F.count_if(share < 0.25).alias("u25"), F.count_if(share < 0.5).alias("u50"), F.count_if((share > 0.9) & (share <= 1)).alias("o90"), F.count_if(n > limit).alias("over"),
        F.sum("words").alias("words"), F.sum("shared_words").alias("shared"), F.count_if("cuts_sentence").alias("cut"),
    )
    units = docs.select("doc_id", F.explode(T.sentence_units(F.col("texto"))).alias("unit"))
    lost = sentence_loss(units, chunks).groupBy("doc_id").agg(F.sum("missing").alias("missing"))
    whole = facts.join(own, "doc_id", "left").join(lost, "doc_id", "left")
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    part = lambda c: F.round(total(c) / F.greatest(total("chunks"), F.lit(1)), 6)
    return whole.rollup("language").agg(
        F.count(F.lit(1)).alias("documents"), F.count_if(F.col("sentences") == 0).alias("no_sentence"), F.count_if(F.col("sentences") == 1).alias("one_sentence"),
        F.count("right").alias("labelled"), F.round(F.avg("right"), 6).alias("accuracy"), F.round(F.avg("confidence"), 6).alias("mean_confidence"), F.round(F.avg("margin"), 6).alias("mean_margin"), F.count_if("is_ambiguous").alias("ambiguous"),
        total("chunks").alias("chunks"), total("tokens").alias("tokens"), F.max("longest").alias("longest"), part("u25").alias("under_25"), part("u50").alias("under_50"), part("o90").alias("over_90"), total("over").alias("over_limit"),
        F.round(total("shared") / F.greatest(total("words"), F.lit(1)), 6).alias("repeated_words"), total("cut").alias("cut_sentences"), total("missing").alias("missing_sentences"),
    )
