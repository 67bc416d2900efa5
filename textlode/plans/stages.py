"""The stages from files to validated results, each an artifact that later runs may reuse.

ingestion -> chunking -> embeddings -> index -> retrieval -> validation
"""

from __future__ import annotations

import hashlib
import json
import time
from collections.abc import Callable
from dataclasses import asdict, dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import tokens as K
from ..operators import audit as D
from ..operators import contamination as C
from ..operators import hard_limit as H
from ..operators import packing as P
from ..operators import quality as Q
from ..operators import relations as R
from ..operators import retrieval as S
from ..operators.segmentation import split_column
from ..sources import artifacts as A
from ..sources import corpus

STAGES = ("ingestion", "chunking", "embeddings", "index", "retrieval", "validation")


class OversizedSentenceError(ValueError):
    """Prose that no chunk may hold."""


@dataclass(frozen=True)
class Settings:
    max_tokens: int = 256
    overlap_tokens: int = 32
    encoder_limit: int = K.ENCODER_LIMIT
    special_tokens: int = K.SPECIAL_TOKENS
    dim: int = 384
    fragments: int = 10
    documents: int = 3
    candidates: int = 50
    excluded_sources: tuple[str, ...] = ()
    #: A tokenizers file; without one, white-space words are counted as tokens.
    tokenizer: str | None = None
    #: What the encoder puts before every chunk; its tokens count in each.
    prefix: str = K.PASSAGE

    def __post_init__(self):
        if not 0 <= self.overlap_tokens < self.max_tokens <= self.capacity:
            raise ValueError("need 0 <= overlap < max_tokens <= encoder limit less special tokens")

    @property
    def capacity(self) -> int:
        return self.encoder_limit - self.special_tokens

    def counter(self) -> K.FileCounter | None:
        return K.FileCounter(self.tokenizer, self.prefix) if self.tokenizer else None

    def fingerprint(self) -> str:
        return hashlib.sha256(json.dumps(asdict(self), sort_keys=True, separators=(",", ":")).encode()).hexdigest()


def chunk_documents(docs: DataFrame, settings: Settings, splitter: Callable[[Column, Column], Column] = split_column, counter=None) -> DataFrame:
    """Chunks of documents (doc_id, fuente, formato, fenomeno, texto).

    Rows of tables are units as they are, prose is cut to sentences by
    ``splitter`` (text, format -> array<string>).  Units and chunks are counted
    by ``counter`` (``count``, ``count_many``, ``bare``, ``offsets``) or by the
    file ``settings.tokenizer`` (see ``packing.pack_exact``), without either by
    white-space words in built-in expressions.  A prose unit over the
    encoder's capacity that is no table, list or code is an error; other
    oversized chunks are divided with exact coverage, kept in ``hard_split``.
    """
    fmt = F.lower("formato")
    units = F.when(fmt.isin(*T.TABULAR_FORMATS), T.row_units(F.col("texto"))).otherwise(splitter(F.col("texto"), F.col("formato")))
    counter = counter or settings.counter()
    split = docs.withColumn("texts", units)
    if counter:
        split = split.withColumn("_e", P.exact_chunks(F.col("texts"), counter, settings.max_tokens, settings.overlap_tokens))
        chunks, sized = F.col("_e.chunks"), F.arrays_zip("texts", F.col("_e.units").alias("sizes"))
        sized = F.transform(sized, lambda u: F.struct(u["texts"].alias("t"), u["sizes"].alias("n")))
    else:
        sized = P.counted_units(F.col("texts"))
        chunks = P.pack_additive(F.col("units"), settings.max_tokens, settings.overlap_tokens)
    split = split.withColumn("units", sized)
    long = split.where(fmt.isin("pdf", "txt")).select("doc_id", F.explode("units").alias("u")).where((F.col("u.n") > settings.capacity) & ~T.is_structural_oversize(F.col("u.t")))
    if row := long.first():
        raise OversizedSentenceError(f"document {row.doc_id} has a sentence of {row.u.n} tokens; the limit is {settings.capacity}")
    packed = split.select("doc_id", "fuente", "formato", "fenomeno", F.posexplode(chunks).alias("logical", "c"))
    rows = packed.select("doc_id", "fuente", "formato", "fenomeno", "logical", F.col("c.num_tokens").alias("num_tokens"), F.col("c.text").alias("texto"))
    fit = rows.where(F.col("num_tokens") <= settings.capacity).select("*", F.lit(0).alias("part"), F.lit(None).cast("struct<parent_chunk_id:string,strategy:string,part_index:int,part_count:int,overlap_tokens:int,parent_num_tokens:int,source_start:int,source_end:int,emitted_start:int>").alias("hard_split"))
    big = rows.where(F.col("num_tokens") > settings.capacity).withColumn("chunk_id", F.format_string("%s-logical-chunk-%04d", F.col("doc_id").cast("string"), "logical"))
    parts = H.split_chunks(big, counter, settings.capacity, settings.overlap_tokens)
    cut = big.drop("num_tokens", "texto").join(parts, "chunk_id").select(
        "doc_id", "fuente", "formato", "fenomeno", "logical", "num_tokens", F.col("text").alias("texto"), F.col("part_index").alias("part"),
        F.struct(F.col("chunk_id").alias("parent_chunk_id"), "strategy", "part_index", "part_count", "overlap_tokens", "parent_num_tokens", "source_start", "source_end", "emitted_start").alias("hard_split"),
    )
    at = F.row_number().over(Window.partitionBy("doc_id").orderBy("logical", "part")) - 1
    placed = fit.unionByName(cut).withColumn("posicion", at)
    name = F.format_string("%s-chunk-%04d", F.col("doc_id").cast("string"), "posicion")
    return placed.select("doc_id", name.alias("chunk_id"), "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto", "hard_split")


def prepare_chunks(chunks: DataFrame, bank: DataFrame, settings: Settings) -> DataFrame:
    """Chunks without leaks of the query bank."""
    return C.clean(chunks, C.report(chunks, bank, settings.excluded_sources))


def embed(chunks: DataFrame, encoder: K.Encoder, settings: Settings) -> DataFrame:
    """row_pos, chunk_id, doc_id, embedding, in order of doc_id and position."""
    A.require(chunks, F.col("num_tokens") > settings.capacity, "chunks exceed the encoder's capacity")
    if settings.tokenizer:  # a chunk must be what was counted
        A.require(chunks, K.token_count(F.col("texto"), settings.tokenizer, settings.prefix) != F.col("num_tokens"), "chunks whose tokens were counted otherwise")
    vectors = chunks.select("chunk_id", "doc_id", "posicion", K.encode(F.col("texto"), encoder, settings.dim, settings.prefix).alias("embedding"))
    return R.ranked(vectors, ["doc_id", "posicion"]).select(F.col("_i").cast("bigint").alias("row_pos"), "chunk_id", "doc_id", "embedding")


def answer(vectors: DataFrame, chunks: DataFrame, queries: DataFrame, encoder: K.Encoder, settings: Settings) -> DataFrame:
    """Ranked documents and fragments of each query (query_id, text); ids have three digits, so queries are at most 1,000."""
    number = queries.withColumn("row_pos", -F.row_number().over(Window.orderBy("query_id")).cast("bigint"))
    asked = number.select("query_id", F.col("row_pos").alias("q"), K.encode(F.col("text"), encoder, settings.dim, K.QUERY).alias("embedding"))
    hits = S.search(vectors, asked.withColumnRenamed("q", "row_pos"), settings.candidates, "row_pos")
    named = hits.withColumnRenamed("query_id", "q").join(asked.select("q", "query_id"), "q").drop("q")
    texts = vectors.select("row_pos", "chunk_id").join(chunks, "chunk_id").select("row_pos", "chunk_id", "doc_id", "texto", "formato")
    return S.results(named.join(texts, "row_pos"), settings.fragments, settings.documents)


@dataclass
class Run:
    """One pass over the stages in a folder; finished stages of the same settings are reused."""

    spark: SparkSession
    folder: str
    settings: Settings = field(default_factory=Settings)
    encoder: K.Encoder = field(default_factory=K.HashEncoder)
    done: dict = field(default_factory=dict)
    #: Places of finished stages of another run that this one goes on from; these are read and never written.
    inherited: dict[str, str] = field(default_factory=dict)
    #: Told of every stage that is done, with its facts.
    progress: Callable[[str, dict], None] | None = None

    def _tell(self, name: str) -> None:
        if self.progress:
            self.progress(name, self.done[name])

    def _stage(self, name: str, *how) -> DataFrame:
        data = self._artifact(name, *how)
        self._tell(name)
        return data

    def _artifact(self, name: str, order: str, identity: str, make, reuse: bool, since: str) -> DataFrame:
        place = f"{self.folder}/{name}"
        if name in self.inherited:
            data, manifest = A.load(self.spark, self.inherited[name])
            self.done[name] = manifest | {"inherited": True, "seconds": 0.0}
            return data
        mark = hashlib.sha256(f"{self.settings.fingerprint()} {since}".encode()).hexdigest()
        started = time.time()
        if A.exists(self.spark, f"{place}/manifest.json"):
            data, manifest = A.load(self.spark, place)
            if reuse and manifest["fingerprint"] == mark:
                self.done[name] = manifest | {"reused": True, "seconds": time.time() - started}
                return data
            fs, target = A._fs(self.spark, place)
            fs.delete(target, True)
        manifest = A.publish(make(), place, order, identity, fingerprint=mark)
        self.done[name] = manifest | {"reused": False, "seconds": time.time() - started}
        return A.load(self.spark, place, verify=False)[0]

    def _index(self, chunks: DataFrame, reuse: bool) -> DataFrame:
        """Vectors whose ids, in order, are those of the chunks."""
        started, place = time.time(), f"{self.folder}/index"
        ordered = R.ranked(chunks.select("doc_id", "posicion", "chunk_id"), ["doc_id", "posicion"]).select(F.col("_i").alias("row_pos"), "chunk_id")
        source = (f"{self.folder}/embeddings", ordered, self.settings.fingerprint())
        if reuse and A.exists(self.spark, f"{place}/index.json"):
            try:
                data = A.load_index(self.spark, place, *source)
                self.done["index"] = {"rows": self.done["embeddings"]["rows"], "reused": True, "seconds": time.time() - started}
                return data
            except A.ContractError:  # of other vectors or settings: made anew
                pass
        manifest = A.build_index(self.spark, source[0], ordered, place, self.settings.dim, source[2])
        self.done["index"] = manifest | {"reused": False, "seconds": time.time() - started}
        return A.load(self.spark, source[0], verify=False)[0]

    def run(self, corpus_folder: str, queries: DataFrame, first: str = "ingestion", last: str = "validation", reuse: bool = True) -> DataFrame | None:
        """Results of the queries (None if ``last`` comes before retrieval); stages before ``first`` must be there."""
        a, b = STAGES.index(first), STAGES.index(last)
        if a > b:
            raise ValueError("first stage comes after the last")
        keep = lambda name: reuse or STAGES.index(name) < a
        try:
            docs = self._stage("ingestion", "fuente", "doc_id", lambda: corpus.ingest(self.spark, corpus_folder)[0], keep("ingestion"), corpus_folder)
            if b == 0:
                return None
            chunks = self._stage("chunking", "chunk_id", "chunk_id", lambda: prepare_chunks(chunk_documents(docs, self.settings), queries, self.settings), keep("chunking"), self.done["ingestion"]["sha256"])
            A.write_text(self.spark, f"{self.folder}/chunking.json", json.dumps(asdict(self.settings) | {"capacity": self.settings.capacity, "sha256": self.settings.fingerprint()}, sort_keys=True, indent=1))
            if b == 1:
                return None
            vectors = self._stage("embeddings", "row_pos", "chunk_id", lambda: embed(chunks, self.encoder, self.settings), keep("embeddings"), self.done["chunking"]["sha256"])
            if b == 2:
                return None
            vectors = self._index(chunks, keep("index"))
            self._tell("index")
            if b <= 3:
                return None
            results = answer(vectors, chunks, queries, self.encoder, self.settings)
            if b == 5:
                failed = Q.failures(results, ["query_id"], Q.result_checks(self.settings.documents, self.settings.fragments))
                A.require(failed, F.lit(True), "results break their contract")
                self.done["validation"] = {"failures": 0}
            return results
        except Exception as e:
            self.done["failed"] = str(e)[:500]
            raise
        finally:
            for name, rates in Q.stage_metrics({k: v for k, v in self.done.items() if isinstance(v, dict) and "seconds" in v}).items():
                self.done[name] |= rates
            A.write_text(self.spark, f"{self.folder}/run.json", json.dumps(self.done, sort_keys=True, default=str, indent=1))


def equivalence(a: dict, b: dict, semantic: tuple[str, str] | None = None) -> str:
    """How two artifacts agree, by their manifests and, where given, their semantic hashes."""
    if a["sha256"] == b["sha256"] and a["rows"] == b["rows"]:
        return "BYTE_IDENTICAL"
    if semantic and semantic[0] == semantic[1]:
        return "SEMANTICALLY_EQUIVALENT"
    return "STRUCTURALLY_EQUIVALENT" if a["rows"] == b["rows"] else "DIFFERENT"


def upstream_gate(documents: DataFrame, chunks: DataFrame, bank: DataFrame, settings: Settings) -> tuple[str, dict[str, DataFrame]]:
    """Whether documents and chunks hold a bank's texts: FAIL if a chunk does or a document does whole, NEEDS_REVIEW for
    beginnings in documents or suspicious labels in chunks, else PASS; with the findings."""
    state, flagged = clean_gate(chunks, bank, settings)
    found = C.matches(documents, bank, "doc_id", "texto", "query_id", "text")
    kinds = {r.kind for r in found.select("kind").distinct().collect()}  # at most two
    state = "FAIL" if state == "FAIL" or "exact" in kinds else "NEEDS_REVIEW" if state != "PASS" or kinds else "PASS"
    return state, {"chunks": flagged, "documents": found}


def boundary_gate(chunks: DataFrame) -> tuple[str, DataFrame]:
    """PASS if no chunk ends inside a sentence that the next goes on with, else FAIL; with the pairs."""
    cut = D.adjacent_pairs(chunks.withColumn("_split", F.col("hard_split").isNotNull()), fmt=F.col("formato"), split=F.col("_split")).where("cuts_sentence")
    return ("FAIL" if cut.limit(1).count() else "PASS"), cut


def clean_gate(chunks: DataFrame, bank: DataFrame, settings: Settings) -> tuple[str, DataFrame]:
    """PASS, NEEDS_REVIEW (suspicious labels only) or FAIL (leaked queries), and the report."""
    found = C.report(chunks, bank, settings.excluded_sources)
    leak = F.exists("razones", lambda r: ~r.startswith("marcadores"))
    n = found.agg(F.count_if(leak).alias("leaks"), F.count(F.lit(1)).alias("n")).first()
    return ("FAIL" if n.leaks else "NEEDS_REVIEW" if n.n else "PASS"), found
