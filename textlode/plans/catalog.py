"""Registered queries over the engine's operators and their SQL equivalents.

Every query reads whole tables.  Where it needs a query set, that is every
vector whose id is divisible by 100, against all vectors.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vectors as V
from ..operators import audit as D
from ..operators import contamination as C
from ..operators import hard_limit as H
from ..operators import packing as P
from ..operators import quality as Q
from ..operators import relations as R
from ..operators import retrieval as S

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def register(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Columns of a table for work on whole texts.

    A small file may be a single row group, which one core would read and
    process alone; only then, with fewer scan partitions than cores, its rows
    are dealt anew.  Large tables have more partitions and are not moved.
    """
    rows = table(spark, sf_dir, name).select(*columns)
    cores = spark.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


# ---------------------------------------------------------------- retrieval

HITS = """
WITH hits AS (
  SELECT q.vec_id AS query_id, v.vec_id AS row_pos, v.label, q.label AS own,
         round(list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) AS score,
         row_number() OVER (PARTITION BY q.vec_id ORDER BY round(list_inner_product(q.embedding::DOUBLE[], v.embedding::DOUBLE[]), 6) DESC, v.vec_id) AS position
  FROM embeddings q JOIN embeddings v ON q.vec_id <> v.vec_id WHERE q.vec_id % 100 = 0
  QUALIFY position <= 50)
"""


def _hits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Top 50 of every hundredth vector, with the hit's label as its document."""
    vectors = table(spark, sf_dir, "embeddings")
    found = S.search(vectors, vectors.where("vec_id % 100 = 0"))
    chunks = vectors.select(F.col("vec_id").alias("row_pos"), F.col("vec_id").alias("chunk_id"), F.col("label").alias("doc_id"))
    return S.with_chunks(found, chunks)


def _graded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with a grade: 3 for the query's own label at an even position, 2 at an odd one, else 0."""
    own = table(spark, sf_dir, "embeddings").select(F.col("vec_id").alias("query_id"), F.col("label").alias("own"))
    hits = _hits(spark, sf_dir).join(own, "query_id").withColumn("rank", F.col("position"))
    return hits.withColumn("grade", F.when(F.col("doc_id") == F.col("own"), F.when(F.col("rank") % 2 == 0, 3).otherwise(2)).otherwise(0))


@register(HITS + "SELECT query_id, position::INT AS position, row_pos, score FROM hits")
def vector_topk(spark, sf_dir):
    return _hits(spark, sf_dir).select("query_id", "position", "row_pos", "score")


def _pooled(score: str) -> str:
    return HITS + f""", pooled AS (SELECT query_id, label, {score} AS score, min(position) AS first_pos FROM hits GROUP BY ALL)
SELECT query_id, label AS doc_id, score, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, first_pos)::INT AS rank FROM pooled QUALIFY rank <= 3"""


def _pool(spark, sf_dir, how):
    pooled = S.pool_documents(S.dedupe_chunks(_hits(spark, sf_dir)), how)
    return S.rank(pooled, 3, ["query_id"], "first_pos").select("query_id", "doc_id", "score", "rank")


@register(_pooled("max(score)"))
def doc_max_pool(spark, sf_dir):
    return _pool(spark, sf_dir, "max")


@register(_pooled("round(sum(score::DECIMAL(20,6)), 6)::DOUBLE"))
def doc_combsum(spark, sf_dir):
    return _pool(spark, sf_dir, "sum")


@register(HITS + """, doubled AS (
  SELECT query_id, row_pos, label, score, position FROM hits UNION ALL
  SELECT query_id, row_pos, label, score - (position % 3 - 1) * 0.5, position + 50 FROM hits)
SELECT query_id, row_pos AS chunk_id, max(score) AS score, min(position)::INT AS first_pos FROM doubled GROUP BY ALL""")
def dedupe_chunk_best(spark, sf_dir):
    """Every hit twice, the second time with another score: the best one stays."""
    hits = _hits(spark, sf_dir).select("query_id", "chunk_id", "doc_id", "score", "position")
    again = hits.withColumn("score", F.col("score") - (F.col("position") % 3 - 1) * 0.5).withColumn("position", F.col("position") + 50)
    return S.dedupe_chunks(hits.union(again)).select("query_id", "chunk_id", "score", "first_pos")


def _with_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hits with the text of the document whose id is the vector's; some have none."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_pos"), F.coalesce("text", F.lit("")).alias("texto"))
    return _hits(spark, sf_dir).join(docs, "row_pos", "left").withColumn("texto", F.coalesce("texto", F.lit("")))


def _cut_sql(text: str) -> str:
    """At most 250 words of a text, up to the last sentence end in them if there is one."""
    cut = CUT.replace("text", text, 1)
    return rf"CASE WHEN {WORDS.replace('text', text)} <= 250 THEN {text} WHEN regexp_matches({cut}, '(?s)[.?!] ') THEN regexp_extract({cut}, '(?s)^(.*[.?!]) ', 1) ELSE {cut} END"


WORDS = r"len(regexp_extract_all(coalesce(text, ''), '[^\s\x{b}\x{1c}-\x{1f}]+'))"
CUT = r"array_to_string((regexp_extract_all(text, '[^\s\x{b}\x{1c}-\x{1f}]+'))[1:250], ' ')"
TEXTS = HITS + """, texts AS (SELECT h.*, coalesce(d.text, '') AS texto FROM hits h LEFT JOIN documents d ON h.row_pos = d.doc_id)"""


@register(TEXTS + f""", docs AS (SELECT query_id, label, max(score) AS score, min(position) AS p FROM hits GROUP BY ALL),
top AS (SELECT query_id, label, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, p) AS r FROM docs QUALIFY r <= 3)
SELECT query_id, string_agg(r || ':' || label, ' ' ORDER BY r) AS documents,
  (SELECT string_agg(h.position || ':' || h.row_pos || ':' || h.label || ':' || md5({_cut_sql('texto')}), ' ' ORDER BY h.position) FROM texts h WHERE h.query_id = top.query_id AND h.position <= 10) AS fragments
FROM top GROUP BY query_id""")
def nested_results(spark, sf_dir):
    """Ranked documents and fragments of each query, nested, then written as text to compare; texts as digests."""
    out = S.results(_with_texts(spark, sf_dir))
    text = lambda rows, names: F.array_join(F.transform(rows, lambda r: F.concat_ws(":", *[F.md5(r[n]) if n == "text" else r[n].cast("string") for n in names])), " ")
    return out.select("query_id", text("documents", ("rank", "doc_id")).alias("documents"), text("fragments", ("rank", "chunk_id", "doc_id", "text")).alias("fragments"))


GRADED = HITS + """, graded AS (SELECT *, CASE WHEN label = own THEN CASE WHEN position % 2 = 0 THEN 3 ELSE 2 END ELSE 0 END AS grade FROM hits)"""


@register(GRADED + "SELECT query_id, round(count(*) FILTER (WHERE grade >= 2 AND position <= 10) / 10, 6) AS precision FROM graded GROUP BY query_id")
def precision_at_k(spark, sf_dir):
    return Q.precision_at_k(_graded(spark, sf_dir), F.col("grade") >= 2, 10)


JUDGED = GRADED + """, judged AS (SELECT query_id, min(CASE WHEN grade >= 2 THEN position END)::INT AS first_relevant,
    max((position <= 3 AND grade = 3)::INT) AS top, count(*) FILTER (WHERE grade >= 2 AND position <= 5) AS r5 FROM graded GROUP BY query_id),
scored AS (SELECT query_id, first_relevant, coalesce(first_relevant <= 1, false)::INT AS hit_1, coalesce(first_relevant <= 3, false)::INT AS hit_3,
    coalesce(first_relevant <= 5, false)::INT AS hit_5, r5 / 5 AS precision_5, round(coalesce(1 / first_relevant, 0), 6) AS reciprocal_rank,
    CASE WHEN top = 1 THEN 'GOOD' WHEN first_relevant IS NOT NULL THEN 'ACCEPTABLE' ELSE 'BAD' END AS class FROM judged)"""


@register(JUDGED + "SELECT * FROM scored")
def judged_queries(spark, sf_dir):
    return Q.judged(_graded(spark, sf_dir))


@register(JUDGED + "SELECT count(*) AS n_queries, round(avg(hit_1), 6) AS hit_at_1, round(avg(hit_3), 6) AS hit_at_3, round(avg(hit_5), 6) AS hit_at_5, round(avg(precision_5), 6) AS precision_at_5, round(avg(reciprocal_rank), 6) AS mrr FROM scored")
def hit_mrr(spark, sf_dir):
    return Q.judged_summary(Q.judged(_graded(spark, sf_dir)))


@register("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def grade_histogram(spark, sf_dir):
    return table(spark, sf_dir, "labels").groupBy("quality", "toxic").agg(F.count(F.lit(1)).alias("n"))


@register("""SELECT len(embedding)::INT AS dim, count(*) AS n, count(*) FILTER (WHERE abs(sqrt(list_sum(list_transform(embedding::DOUBLE[], lambda x: x * x))) - 1) > 0.0001) AS bad_norm,
  count(*) FILTER (WHERE len(list_filter(embedding, lambda x: NOT isfinite(x))) > 0) AS bad_values FROM embeddings GROUP BY ALL""")
def vector_contract(spark, sf_dir):
    rows = table(spark, sf_dir, "embeddings").select(F.size("embedding").alias("dim"), V.problems(F.col("embedding"), 64).alias("p"))
    has = lambda name: F.count_if(F.array_contains("p", name))
    return rows.groupBy("dim").agg(F.count(F.lit(1)).alias("n"), has("norm").alias("bad_norm"), has("not_finite").alias("bad_values"))


# ---------------------------------------------------------------- text

CLEAN = r"""trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(
  translate(regexp_replace({0}, '\r\n?', chr(10), 'g'), chr(9), ' '),
  '[\x{{0}}-\x{{9}}\x{{b}}-\x{{1f}}\x{{7f}}-\x{{a0}}\p{{Cf}}\p{{Co}}\p{{Zl}}\p{{Zp}}\x{{1680}}\x{{2000}}-\x{{200a}}\x{{202f}}\x{{205f}}\x{{3000}}]', '', 'g'),
  ' +', ' ', 'g'), ' *\n *', chr(10), 'g'), '\n{{3,}}', chr(10) || chr(10), 'g'), ' ' || chr(10))"""


@register(f"SELECT doc_id, md5({CLEAN.format('text')}) AS cleaned, length({CLEAN.format('text')}) AS n_chars FROM documents")
def clean_text(spark, sf_dir):
    cleaned = T.clean_text(F.col("text"))
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.md5(cleaned).alias("cleaned"), F.length(cleaned).cast("bigint").alias("n_chars"))


@register(f"SELECT conv_id, turn, md5({CLEAN.format('text')}) AS cleaned FROM conversations")
def clean_turns(spark, sf_dir):
    return texts(spark, sf_dir, "conversations", "conv_id", "turn", "text").select("conv_id", "turn", F.md5(T.clean_text(F.col("text"))).alias("cleaned"))


@register(f"SELECT doc_id, {WORDS}::INT AS n_words FROM documents")
def word_count(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", T.word_count(F.col("text")).alias("n_words"))


DISTRIBUTION = """count({0}) AS n, min({0})::DOUBLE AS min, max({0})::DOUBLE AS max, round(avg({0}), 6) AS mean, round(stddev_pop({0}), 6) AS pstdev,
 round(quantile_cont({0}, 0.25), 6) AS p25, round(quantile_cont({0}, 0.5), 6) AS median, round(quantile_cont({0}, 0.75), 6) AS p75, round(quantile_cont({0}, 0.9), 6) AS p90,
 round(quantile_cont({0}, 0.95), 6) AS p95, round(quantile_cont({0}, 0.99), 6) AS p99"""


@register(f"SELECT lang, {DISTRIBUTION.format('w')} FROM (SELECT lang, {WORDS} AS w FROM documents) GROUP BY lang")
def token_distribution(spark, sf_dir):
    return Q.distribution(texts(spark, sf_dir, "documents", "lang", "text").select("lang", T.word_count(F.col("text")).alias("w")), "w", ["lang"])


@register("SELECT event_type, quantile_disc(value, 0.95) AS p95, round(avg(value), 6) AS mean, round(median(value), 6) AS median FROM events GROUP BY ALL")
def p95_nearest_rank(spark, sf_dir):
    return Q.nearest_rank(table(spark, sf_dir, "events"), "value", 0.95, ["event_type"])


def _list(values) -> str:
    return "[" + ", ".join("'" + v.replace("'", "''") + "'" for v in values) + "]"


ACCENTS = "translate({0}, 'áàâäãåéèêëíìîïóòôöõúùûüñçýÿÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕÚÙÛÜÑÇÝ', 'aaaaaaeeeeiiiiooooouuuuncyyAAAAAAEEEEIIIIOOOOOUUUUNCY')"
VOTE = f"""
WITH found AS (SELECT doc_id, lang, list_transform(regexp_extract_all(lower(substr(text, 1, 20000)), '[a-záéíóúüñãõç]+'), lambda w: {ACCENTS.format('w')}) AS ws FROM documents),
votes AS (SELECT doc_id, lang, {', '.join(f"len(list_filter(ws, lambda w: list_contains({_list(T._plain(T.VOTE_WORDS[k]))}, w))) AS {k}" for k in ('es', 'en', 'pt'))} FROM found),
voted AS (SELECT doc_id, lang, CASE WHEN greatest(es, en, pt) < 3 OR (es = greatest(es, en, pt))::INT + (en = greatest(es, en, pt))::INT + (pt = greatest(es, en, pt))::INT > 1 THEN 'desconocido'
   WHEN es > en AND es > pt THEN 'es' WHEN en > pt THEN 'en' ELSE 'pt' END AS voted FROM votes)
"""


@register(VOTE + "SELECT doc_id, voted FROM voted")
def language_vote(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", T.language_vote(F.col("text")).alias("voted"))


def _score_sql(language: str) -> str:
    m = T.default_markers()[language]
    parts = " + ".join(f"least((length(s) - length(replace(s, {_list([p])[1:-1]}, ''))) / {len(p)}, 3)" for p in m["patterns"])
    return f"(len(list_filter(ws, lambda w: list_contains({_list(m['common_words'])}, w))) * 0.5 + len(list_filter(ws, lambda w: list_contains({_list(m['distinctive_words'])}, w))) * 2 + ({parts}) * 1.5)::DOUBLE AS {language}"


@register(rf"""
WITH sampled AS (SELECT doc_id, length(text) AS n, text FROM documents),
plain AS (SELECT doc_id, trim(regexp_replace(lower(CASE WHEN n <= 6000 THEN text ELSE substr(text, 1, 2000) || chr(10) || substr(text, (n - 2000) // 2 + 1, 2000) || chr(10) || substr(text, n - 1997, 1998) END), '[\s\x{{b}}\x{{1c}}-\x{{1f}}]+', ' ', 'g')) AS s FROM sampled),
found AS (SELECT doc_id, s, regexp_extract_all(s, '[\p{{L}}\p{{Nl}}\p{{No}}]+(?:[''’][\p{{L}}\p{{Nl}}\p{{No}}]+)?') AS ws FROM plain),
scores AS (SELECT doc_id, {', '.join(_score_sql(k) for k in ('es', 'en', 'pt'))} FROM found),
ranked AS (SELECT *, list_reverse_sort([es, en, pt]) AS r, es + en + pt AS total FROM scores)
SELECT doc_id, es, en, pt, round(CASE WHEN total > 0 THEN r[1] / total ELSE 0 END, 6) AS confidence,
  CASE WHEN r[1] < 3 OR CASE WHEN total > 0 THEN r[1] / total ELSE 0 END < 0.5 OR r[1] - r[2] < 1.5 THEN 'es' WHEN es = r[1] THEN 'es' WHEN en = r[1] THEN 'en' ELSE 'pt' END AS language FROM ranked""")
def language_score(spark, sf_dir):
    scored = texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", T.language_scores(F.col("text")).alias("s"))
    out = scored.withColumn("d", T.decide_language(F.col("s")))
    return out.select("doc_id", "s.es", "s.en", "s.pt", F.round("d.confidence", 6).alias("confidence"), "d.language")


@register(VOTE + """SELECT lang, count(*) AS n, count(*) FILTER (WHERE voted = 'es') AS as_es, count(*) FILTER (WHERE voted = 'en') AS as_en, count(*) FILTER (WHERE voted = 'pt') AS as_pt,
 count(*) FILTER (WHERE voted = 'desconocido') AS as_desconocido, round(avg((lang = voted)::INT), 6) AS accuracy FROM voted GROUP BY ROLLUP (lang)""")
def confusion_by_lang(spark, sf_dir):
    voted = texts(spark, sf_dir, "documents", "lang", "text").select("lang", T.language_vote(F.col("text")).alias("voted"))
    return Q.confusion(voted, "lang", "voted", ["es", "en", "pt", "desconocido"])


def _truncated(other: str) -> str:
    return rf"""SELECT doc_id, md5(CASE WHEN {WORDS} <= 250 THEN text WHEN regexp_matches({CUT}, '(?s)[.?!] ') THEN regexp_extract({CUT}, '(?s)^(.*[.?!]) ', 1) ELSE {other} END) AS kept FROM documents"""


@register(_truncated(CUT))
def truncate_cut(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.md5(T.truncate_at_sentence(F.col("text"), 250, "cut")).alias("kept"))


@register(_truncated("text"))
def truncate_whole(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.md5(T.truncate_at_sentence(F.col("text"), 250, "whole")).alias("kept"))


@register(rf"""SELECT doc_id, md5(CASE WHEN {WORDS} <= 250 THEN text WHEN regexp_matches({CUT}, '[.?!…]$') THEN {CUT}
  WHEN regexp_matches({CUT}, '(?s)[.?!…](\s|$)') THEN trim(regexp_extract({CUT}, '(?s)^(.*[.?!…])(?:\s|$)', 1)) END) AS kept FROM documents""")
def bounded_fragments(spark, sf_dir):
    """Delivery form: cut only at a sentence end; null where there is none."""
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.md5(T.bounded_fragment(F.lit("txt"), F.col("text"), 250)).alias("kept"))


@register("SELECT doc_id, unnest(range(len(u)))::INT AS position, unnest(u) AS unit FROM (SELECT doc_id, list_filter(list_transform(regexp_split_to_array(text, '\\r\\n|[\\n\\x{b}\\x{c}\\r\\x{1c}-\\x{1e}\\x{85}\\x{2028}\\x{2029}]'), lambda x: trim(x, ' ' || chr(9))), lambda x: x <> '') AS u FROM documents)")
def row_units(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(T.row_units(F.col("text"))).alias("position", "unit"))


@register(r'''SELECT page_id, list_sort(list_distinct(list_filter(list_transform(regexp_extract_all(url || ' ' || html, 'https?://[^\s<>''"\x29\]]+'), lambda u: regexp_replace(u, '[.,;)]+$', '')), lambda u: u <> ''))) AS urls FROM pages''')
def url_extract(spark, sf_dir):
    return texts(spark, sf_dir, "pages", "page_id", "url", "html").select("page_id", T.urls(F.concat_ws(" ", "url", "html")).alias("urls"))


@register()
def html_text(spark, sf_dir):
    """Main text of every page; the HTML parser has no SQL form."""
    from ..sources.readers import read_column

    return texts(spark, sf_dir, "pages", "page_id", "html").select("page_id", read_column(F.encode("html", "UTF-8"), F.lit(".html"))["text"].alias("text"))


@register("""SELECT event_id, 'k: ' || (props::JSON ->> 'k') AS text FROM events""")
def json_flatten(spark, sf_dir):
    from ..sources.readers import read_column

    return texts(spark, sf_dir, "events", "event_id", "props").select("event_id", read_column(F.encode("props", "UTF-8"), F.lit(".json"))["text"].alias("text"))


@register(r"""WITH s AS (SELECT page_id, regexp_extract(lower(regexp_replace(url, '[?#].*$', '')), '(\.[^./]+)$', 1) AS suffix, html, row_number() OVER (PARTITION BY url ORDER BY page_id) AS rn FROM pages)
SELECT status, count(*) AS n FROM (SELECT CASE WHEN suffix NOT IN ('', '.html', '.htm', '.com', '.net', '.org') THEN 'omitido' WHEN coalesce(trim(html), '') = '' THEN 'vacío' WHEN rn > 1 THEN 'fallido' ELSE 'procesado' END AS status FROM s) GROUP BY status""")
def status_router(spark, sf_dir):
    """Pages by the state that ingestion would give them."""
    from ..sources.corpus import route

    pages = table(spark, sf_dir, "pages")
    rows = pages.select(F.col("page_id").alias("ordinal"), F.col("url").alias("doc_id"), T.suffix(F.regexp_replace("url", "[?#].*$", "")).alias("suffix"), F.col("html").alias("text"))
    rows = rows.withColumn("error", F.when(~F.col("suffix").isin("", ".html", ".htm", ".com", ".net", ".org"), "Formato no soportado"))
    return route(rows).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


# ---------------------------------------------------------------- chunks


def _units(spark: SparkSession, sf_dir: str) -> DataFrame:
    return texts(spark, sf_dir, "documents", "doc_id", "lang", "source", "text").where("text is not null").select("doc_id", "lang", "source", P.counted_units(T.sentence_units(F.col("text"))).alias("units"))


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return P.chunk_rows(_units(spark, sf_dir), P.pack_additive(F.col("units")), keep=("lang", "source"))


def _digested(chunks: DataFrame) -> DataFrame:
    return chunks.select("doc_id", "chunk_id", "posicion", "num_tokens", F.md5("texto").alias("texto"))


@register()
def pack_scalar(spark, sf_dir):
    """Sequential packing has no SQL form; tests compare it with a brute-force version."""
    return _digested(P.chunk_rows(_units(spark, sf_dir), P.pack_scalar(F.col("units"))))


@register()
def pack_additive(spark, sf_dir):
    return _digested(_chunks(spark, sf_dir))


@register()
def chunk_summary(spark, sf_dir):
    tokens = F.col("num_tokens")
    return _chunks(spark, sf_dir).groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(tokens).alias("min"), F.round(F.avg(tokens), 6).alias("mean"), F.sum(tokens).alias("total"), *Q.bands(tokens, 256, 510))


@register()
def util_bands(spark, sf_dir):
    return _chunks(spark, sf_dir).groupBy("lang").agg(*Q.utilisation(F.col("num_tokens"), 256))


@register()
def chunk_violations(spark, sf_dir):
    """Failed checks of the chunk contract and gaps in positions; single sentences over the limit show, to be divided."""
    return Q.chunk_failures(_chunks(spark, sf_dir))


@register()
def hard_splits(spark, sf_dir):
    """Documents as single chunks, divided at the hard limit of 510 tokens."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "text").select(F.col("doc_id").alias("chunk_id"), F.lit("txt").alias("formato"), F.col("text").alias("texto"))
    return H.split_chunks(docs).select("chunk_id", "strategy", "part_index", "part_count", "num_tokens", "source_start", "source_end", "emitted_start", F.md5("text").alias("text"))


@register()
def prose_sentences(spark, sf_dir):
    """Sentences of every document by the bounded segmenter."""
    from ..operators.segmentation import split_column

    units = texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.posexplode(split_column(F.col("text"), F.lit("txt"))).alias("position", "sentence"))
    return units.select("doc_id", "position", F.length("sentence").alias("n_chars"), F.md5("sentence").alias("sentence"))


@register(rf"SELECT doc_id, {WORDS} >= 100 AND (length(text) - length(replace(text, ',', '')) >= 20 OR length(text) - length(replace(text, ';', '')) >= 8) OR len(regexp_extract_all(text, '(?i)(?:https?://|www\.)')) >= 4 AS listed FROM documents")
def list_like(spark, sf_dir):
    """Documents that are lists by their separators or links."""
    text = F.col("text")
    listed = (T.word_count(text) >= 100) & ((T.occurrences(text, ",") >= 20) | (T.occurrences(text, ";") >= 8))
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", (listed | (F.regexp_count(text, F.lit(r"(?i)(?:https?://|www\.)")) >= 4)).alias("listed"))


@register()
def structural_oversize(spark, sf_dir):
    return texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", T.is_structural_oversize(F.col("text")).alias("structural"))


# ---------------------------------------------------------------- contamination

NORMAL = r"trim(regexp_replace(regexp_replace({0}, '\p{{Mn}}+', '', 'g'), '[\s\x{{b}}\x{{1c}}-\x{{1f}}]+', ' ', 'g'))"
LEAKS = f"""WITH t AS (SELECT doc_id, source, {NORMAL.format(ACCENTS.format('lower(text)'))} AS t FROM documents), b AS (SELECT item_id, {NORMAL.format(ACCENTS.format('lower(text)'))} AS q FROM benchmark),
leaks AS (SELECT doc_id, source, item_id FROM t JOIN b ON length(q) > 20 AND contains(t, q))"""


def _leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return C.contained(texts(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


@register(LEAKS + "SELECT doc_id, item_id FROM leaks")
def contamination_hits(spark, sf_dir):
    return _leaks(spark, sf_dir)


@register(LEAKS + "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM leaks)")
def clean_chunks(spark, sf_dir):
    return C.clean(table(spark, sf_dir, "documents").select("doc_id", "source"), _leaks(spark, sf_dir), "doc_id")


@register(LEAKS + "SELECT source, list_sort(list(DISTINCT item_id)) AS matched, count(DISTINCT doc_id) AS n_chunks FROM leaks GROUP BY source")
def contamination_by_source(spark, sf_dir):
    return C.by_source(table(spark, sf_dir, "documents"), _leaks(spark, sf_dir), "doc_id", "source", "item_id")


# ---------------------------------------------------------------- contracts


@register(rf"""SELECT doc_id, category FROM (SELECT doc_id, unnest([CASE WHEN text IS NULL THEN 'missing_text' END, CASE WHEN {WORDS} = 0 THEN 'empty_text' END,
 CASE WHEN lang NOT IN ('es', 'en', 'pt') THEN 'bad_language' END]) AS category FROM documents) WHERE category IS NOT NULL""")
def doc_violations(spark, sf_dir):
    return Q.failures(table(spark, sf_dir, "documents"), ["doc_id"], Q.document_checks("doc_id", "text", "lang", ("es", "en", "pt")))


@register(TEXTS + f""", judged AS (SELECT 'q' || CASE WHEN query_id > 999 THEN query_id::VARCHAR ELSE lpad(query_id::VARCHAR, 3, '0') END AS query_id, count(DISTINCT label) AS labels, count(*) FILTER (WHERE position <= 10) AS n,
  bool_or(texto = '') FILTER (WHERE position <= 10) AS blank, max({WORDS.replace('text', 'texto')}) FILTER (WHERE position <= 10) AS longest, query_id > 999 AS wide FROM texts GROUP BY ALL)
SELECT query_id, category FROM (SELECT query_id, unnest([CASE WHEN wide THEN 'bad_query_id' END, CASE WHEN labels < 3 THEN 'documents' END, CASE WHEN n < 10 THEN 'fragments' END,
  CASE WHEN blank THEN 'fields' END, CASE WHEN longest > 250 THEN 'too_long' END]) AS category FROM judged) WHERE category IS NOT NULL""")
def result_violations(spark, sf_dir):
    """Failed checks of the result contract, over whole texts as fragments: long and missing ones show."""
    out = S.results(_with_texts(spark, sf_dir), text=F.col("texto")).withColumn("query_id", F.concat(F.lit("q"), F.when(F.col("query_id") > 999, F.col("query_id").cast("string")).otherwise(F.lpad(F.col("query_id").cast("string"), 3, "0"))))
    return Q.failures(out, ["query_id"], Q.result_checks())


@register("SELECT o_orderkey FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)")
def missing_children(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"))
    return R.unmatched(table(spark, sf_dir, "orders").select("o_orderkey"), lines, "o_orderkey")


@register("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def orphan_children(spark, sf_dir):
    return R.unmatched(table(spark, sf_dir, "documents").select("doc_id"), table(spark, sf_dir, "labels"), "doc_id")


@register("SELECT d.doc_id, d.source FROM documents d WHERE d.doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)")
def sample_semi(spark, sf_dir):
    wanted = table(spark, sf_dir, "labels").where("quality = 1").select("doc_id")
    return table(spark, sf_dir, "documents").select("doc_id", "source").join(wanted, "doc_id", "left_semi")


@register("""WITH a AS (SELECT source, count(*) AS n FROM documents WHERE lang = 'en' GROUP BY source), b AS (SELECT source, count(*) AS n FROM documents WHERE lang <> 'en' GROUP BY source)
SELECT source, coalesce(a.n, 0) AS n_before, coalesce(b.n, 0) AS n_after, coalesce(b.n, 0) - coalesce(a.n, 0) AS delta FROM a FULL OUTER JOIN b USING (source) WHERE coalesce(b.n, 0) <> coalesce(a.n, 0)""")
def lineage_delta(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return R.count_deltas(docs.where("lang = 'en'"), docs.where("lang <> 'en'"), "source")


@register("""WITH a AS (SELECT doc_id FROM labels WHERE quality = 1), b AS (SELECT doc_id FROM labels WHERE toxic = 0)
SELECT doc_id, 'added' AS change FROM (SELECT * FROM b EXCEPT SELECT * FROM a) UNION ALL SELECT doc_id, 'removed' FROM (SELECT * FROM a EXCEPT SELECT * FROM b)""")
def set_changes(spark, sf_dir):
    labels = table(spark, sf_dir, "labels")
    return R.set_changes(labels.where("quality = 1"), labels.where("toxic = 0"), "doc_id")


@register("SELECT doc_id, source FROM documents WHERE doc_id IN (SELECT doc_id FROM labels INTERSECT SELECT doc_id FROM documents WHERE lang = 'en')")
def expected_found(spark, sf_dir):
    """Expected ids that are there: an intersection, then a semi-join."""
    docs = table(spark, sf_dir, "documents")
    both = table(spark, sf_dir, "labels").select("doc_id").intersect(docs.where("lang = 'en'").select("doc_id"))
    return docs.select("doc_id", "source").join(both, "doc_id", "left_semi")


@register("""SELECT conv_id, turn, n, running_max FROM (SELECT conv_id, turn, length(text) AS n, max(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS running_max FROM conversations) WHERE n < running_max""")
def order_violation(spark, sf_dir):
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", F.length("text").cast("bigint").alias("n"))
    return Q.order_violations(turns, ["conv_id"], "turn", "n")


@register(r"""WITH w AS (SELECT conv_id, turn, regexp_extract_all(text, '[^\s]+') AS b, lag(regexp_extract_all(text, '[^\s]+')) OVER (PARTITION BY conv_id ORDER BY turn) AS a FROM conversations)
SELECT conv_id, turn, coalesce((SELECT max(k) FROM unnest(range(1, least(len(a), len(b), 80) + 1)) u(k) WHERE a[len(a) - k + 1:len(a)] = b[1:k]), 0)::INT AS overlap FROM w WHERE a IS NOT NULL""")
def lag_pairs(spark, sf_dir):
    """Words that a turn repeats from the end of the one before."""
    from pyspark.sql import Window

    dealt = table(spark, sf_dir, "conversations").repartition(max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions"))), "conv_id")
    turns = dealt.withColumn("before", F.lag("text").over(Window.partitionBy("conv_id").orderBy("turn")))
    return turns.where("before is not null").select("conv_id", "turn", T.word_overlap(F.col("before"), F.col("text")).alias("overlap"))


@register("""WITH c AS (SELECT c.o_orderkey, c.o_custkey, k.c_nationkey % 3 AS a, c.o_custkey % 3 AS b FROM orders c JOIN customer k ON c.o_custkey = k.c_custkey) SELECT o_orderkey, o_custkey FROM c WHERE a <> b""")
def contract_mismatches(spark, sf_dir):
    """Children whose copied field differs from their parent's."""
    children = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", (F.col("o_custkey") % 3).alias("mark"))
    parents = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), (F.col("c_nationkey") % 3).cast("bigint").alias("mark"))
    return R.contract_mismatches(children, parents, "o_custkey", ["mark"]).select("o_orderkey", "o_custkey")


# ---------------------------------------------------------------- sampling, batches, identity


@register("""WITH n AS (SELECT doc_id, lang, row_number() OVER (ORDER BY doc_id) - 1 AS i, count(*) OVER () AS n FROM documents),
s AS (SELECT DISTINCT round_even(k * (n - 1) / 24, 0)::BIGINT AS i FROM (SELECT max(n) AS n FROM n), range(25) r(k)) SELECT doc_id, lang FROM n WHERE i IN (SELECT i FROM s)""")
def even_sample(spark, sf_dir):
    """25 documents at even distances."""
    return R.evenly_spaced(table(spark, sf_dir, "documents").select("doc_id", "lang"), 25, ["doc_id"])


@register("""WITH n AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) - 1 AS i, count(*) OVER (PARTITION BY lang) AS n FROM (SELECT * FROM documents QUALIFY coalesce(n_chars <= 500000, false) = bool_or(coalesce(n_chars <= 500000, false)) OVER (PARTITION BY lang))),
s AS (SELECT DISTINCT lang, round_even(k * (n - 1) / 6, 0)::BIGINT AS i FROM (SELECT lang, max(n) AS n FROM n GROUP BY lang), range(7) r(k)) SELECT n.doc_id, n.lang FROM n JOIN s USING (lang, i)""")
def stratified_sample(spark, sf_dir):
    """Seven documents of each language at even distances of length, of up to 500,000 characters where a language has any."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", "n_chars")
    return R.evenly_spaced(R.preferred(docs, F.col("n_chars") <= 500_000, ["lang"]), 7, ["n_chars", "doc_id"], ["lang"]).select("doc_id", "lang")


BATCHES = f"WITH w AS (SELECT doc_id, {WORDS} AS n FROM documents), b AS (SELECT doc_id, n, row_number() OVER (ORDER BY n, doc_id) - 1 AS position FROM w)"


def _batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.length_batches(texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", T.word_count(F.col("text")).alias("n")), 16, "n", "doc_id")


@register(BATCHES + "SELECT doc_id, position, position // 16 AS batch FROM b")
def length_buckets(spark, sf_dir):
    return _batches(spark, sf_dir).select("doc_id", "position", "batch")


@register(BATCHES + "SELECT position // 16 AS batch, count(*) AS rows, max(n + 2)::INT AS longest, (max(n + 2) * count(*) - sum(n + 2))::BIGINT AS padding FROM b GROUP BY 1")
def padding_tokens(spark, sf_dir):
    return R.padding(_batches(spark, sf_dir), "n")


@register("""SELECT doc_id, quality FROM (SELECT doc_id, quality, 0 AS p FROM labels UNION ALL SELECT doc_id, 9 AS quality, 1 FROM documents WHERE lang = 'de') QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY p DESC) = 1""")
def upsert_union(spark, sf_dir):
    new = table(spark, sf_dir, "documents").where("lang = 'de'").select("doc_id", F.lit(9).alias("quality"))
    return R.upsert(table(spark, sf_dir, "labels").select("doc_id", "quality"), new, "doc_id")


@register("SELECT count(*) AS n, count(*) - count(DISTINCT doc_id) AS duplicates, upper(sha256(string_agg(doc_id::VARCHAR, chr(10) ORDER BY doc_id) || chr(10))) AS sha256 FROM documents")
def ordered_identity_hash(spark, sf_dir):
    return R.identity_hash(table(spark, sf_dir, "documents"), "doc_id", "doc_id")


@register("""SELECT lang, doc_id, n_chars FROM documents QUALIFY row_number() OVER (PARTITION BY lang ORDER BY n_chars DESC, doc_id) = 1""")
def extreme_representatives(spark, sf_dir):
    return R.representatives(table(spark, sf_dir, "documents"), ["lang"], "n_chars", "doc_id", "doc_id")


@register("SELECT doc_id, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 20")
def top20(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", "n_chars").orderBy(F.col("n_chars").desc(), "doc_id").limit(20)


@register("SELECT regexp_extract(lower(regexp_replace(url, '[?#].*$', '')), '(\\.[^./]+)$', 1) AS extension, count(*) AS files, sum(length(html))::BIGINT AS bytes FROM pages GROUP BY 1")
def file_inventory(spark, sf_dir):
    files = table(spark, sf_dir, "pages").select(F.regexp_replace("url", "[?#].*$", "").alias("path"), F.length("html").cast("bigint").alias("length"))
    return Q.inventory(files)


def _ends_sql(signs: str) -> str:
    """Ends of all sentences but the last, of a single-spaced text ``t`` cut behind some signs and a space."""
    mark = "chr(57344) || chr(57345)"
    u = f"string_split(regexp_replace(t, '([{signs}]) ', '\\1' || {mark}, 'g'), {mark})"
    return f"list_transform(range(1, len({u})), lambda i: (list_sum(list_transform(({u})[1:i], lambda x: length(x))) + i - 1)::INT)"


@register(rf"""WITH n AS (SELECT lang, array_to_string(regexp_extract_all(text, '[^\s\x{{b}}\x{{1c}}-\x{{1f}}]+'), ' ') AS t FROM documents WHERE text IS NOT NULL),
s AS (SELECT lang, {_ends_sql('.!?…')} AS e, {_ends_sql('.')} AS f FROM n),
c AS (SELECT lang, len(list_intersect(e, f)) AS tp, len(f) AS nf, len(e) AS ne, (e = f)::INT AS same FROM s), g AS (SELECT lang, sum(tp) AS tp, sum(nf) AS nf, sum(ne) AS ne, avg(same) AS same FROM c GROUP BY ROLLUP (lang)),
p AS (SELECT lang, CASE WHEN nf > 0 THEN tp / nf ELSE 1 END AS p, CASE WHEN ne > 0 THEN tp / ne ELSE 1 END AS r, same FROM g)
SELECT lang, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, round(same, 6) AS exact FROM p""")
def boundary_f1(spark, sf_dir):
    """Boundaries behind full stops alone, scored against those behind all sentence ends."""
    single = F.array_join(T.words(F.col("text")), " ")
    docs = texts(spark, sf_dir, "documents", "lang", "text").where("text is not null").select("lang", single.alias("t"))
    cut = docs.select("lang", T.sentence_units(F.col("t")).alias("expected"), F.split("t", "(?<=[.]) ").alias("found"))
    return Q.boundary_scores(cut.select("lang", T.boundary_offsets(F.col("expected")).alias("e"), T.boundary_offsets(F.col("found")).alias("f")), "e", "f", "lang")


# ---------------------------------------------------------------- audits


@register()
def adjacent_audit(spark, sf_dir):
    """Shared words of neighbouring chunks, and boundaries inside sentences."""
    return D.adjacent_pairs(_chunks(spark, sf_dir)).drop("doubtful")


@register()
def overlap_report(spark, sf_dir):
    return D.overlap_report(_chunks(spark, sf_dir))


@register()
def sentence_loss(spark, sf_dir):
    """Sentences that chunks hold too few times: none, so this adds the number of sentences looked at."""
    units = texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.explode(T.sentence_units(F.col("text"))).alias("unit"))
    lost = D.sentence_loss(units, _chunks(spark, sf_dir))
    return lost.agg(F.count(F.lit(1)).alias("lost")).crossJoin(units.agg(F.count(F.lit(1)).alias("sentences")))


@register()
def preflight_units(spark, sf_dir):
    """Sentences over 510 tokens, by class."""
    units = texts(spark, sf_dir, "documents", "doc_id", "text").select("doc_id", F.explode(T.sentence_units(F.col("text"))).alias("unit"))
    return D.preflight(units, T.word_count(F.col("unit")), "unit", 510).select("doc_id", "n_tokens", "class")


@register()
def corpus_quality(spark, sf_dir):
    """Quality of the chunked documents, per detected language and over all."""
    docs = texts(spark, sf_dir, "documents", "doc_id", "lang", "text").withColumnRenamed("text", "texto")
    return D.corpus_quality(docs, _chunks(spark, sf_dir).drop("lang"))


@register()
def language_report(spark, sf_dir):
    return D.language_report(texts(spark, sf_dir, "documents", "text"))


@register()
def bank_matches(spark, sf_dir):
    """Exact and prefix matches of the benchmark under full Unicode normalisation."""
    return C.matches(texts(spark, sf_dir, "documents", "doc_id", "text"), table(spark, sf_dir, "benchmark"), "doc_id", "text", "item_id", "text")


@register("SELECT doc_id, octet_length(encode(text))::INT AS n_bytes FROM documents WHERE octet_length(encode(text)) + 4 > 510")
def long_texts(spark, sf_dir):
    """Texts that may exceed the limit by their bytes alone."""
    return table(spark, sf_dir, "documents").where(F.octet_length("text") + 4 > 510).select("doc_id", F.octet_length("text").alias("n_bytes"))
