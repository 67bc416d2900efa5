"""Tables with contracts: JSONL scans, query and judgment scans, published artifacts.

An artifact is a Parquet table and a manifest.  Data is written first, then the
manifest; a folder without a manifest is no artifact.  A reader checks the
manifest's identity against the data.
"""

from __future__ import annotations

import json
import time

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Y

from ..functions.vectors import problems
from ..operators.relations import identity_hash

DOCUMENT = "doc_id string, fuente string, formato string, fenomeno int, idioma string, texto string"
CHUNK = "doc_id string, chunk_id string, fuente string, formato string, fenomeno int, posicion int, num_tokens int, texto string"
JUDGMENT = "query_id string, query_text string, rank int, score double, chunk_id string, doc_id string, source string, chunk_text string, human_grade int, human_note string"


class ContractError(ValueError):
    """Data that breaks its contract."""


def require(df: DataFrame, bad: Column, what: str) -> DataFrame:
    """``df``, if no row is bad; else an error with the number of bad rows and one of them."""
    wrong = df.where(F.coalesce(bad, F.lit(True)))
    if first := wrong.first():
        raise ContractError(f"{what}: {wrong.count()} rows, such as {str(first.asDict())[:200]}")
    return df


def scan_jsonl(spark: SparkSession, path: str, schema: str, required: list[str]) -> DataFrame:
    """Rows of a JSONL file; malformed lines and missing required fields are errors, blank lines are skipped."""
    rows = spark.read.schema(schema).option("mode", "FAILFAST").json(path)
    missing = F.lit(False)
    for c in required:
        missing = missing | F.col(c).isNull()
    return require(rows, missing, f"{path} lacks required fields")


def write_jsonl(df: DataFrame, folder: str) -> None:
    """JSON lines, nulls and signs outside ASCII as they are; nothing is overwritten."""
    df.write.mode("errorifexists").option("ignoreNullFields", "false").json(folder)


#: Fields that a delivery needs of every chunk.
DELIVERY = ["doc_id", "chunk_id", "fuente", "formato", "fenomeno", "posicion", "num_tokens", "texto"]


def scan_chunks(spark: SparkSession, path: str, limit: int = 512) -> DataFrame:
    """Chunks of JSON lines with all delivery fields; blank texts or ids, and counts outside 1 to ``limit``, are errors."""
    rows = scan_jsonl(spark, path, CHUNK, DELIVERY)
    bad = (F.trim("doc_id") == "") | (F.trim("chunk_id") == "") | (F.trim("texto") == "") | ~F.col("num_tokens").between(1, limit) | (F.col("posicion") < 0)
    return require(rows, bad, f"{path} holds chunks that break their contract")


def required_text(text: Column) -> Column:
    """Whether a string is there and not blank."""
    return text.isNotNull() & (F.trim(text) != "")


def finite_or_missing(value: Column) -> Column:
    """Whether an optional number is missing or finite."""
    v = value.cast("double")
    return value.isNull() | (v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))


def profile_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """lines, blank, malformed, not_object, repeated ids, and per field how often it is missing or of another type: one row.

    The first field is the id.
    """
    fields = Y._parse_datatype_string(schema).fieldNames()
    lines = spark.read.text(path)
    parsed = lines.withColumn("v", F.try_parse_json("value")).withColumn("r", F.from_json("value", schema))
    text = F.trim("value") != ""
    kind = F.schema_of_variant("v")
    whole = text & F.col("v").isNotNull() & kind.startswith("OBJECT")
    raw = lambda f: F.get_json_object("value", f"$.{f}")
    has_id = whole & F.col(f"r.{fields[0]}").isNotNull()
    counts = [c for f in fields for c in (F.count_if(whole & raw(f).isNull()).alias(f"missing_{f}"), F.count_if(whole & raw(f).isNotNull() & F.col(f"r.{f}").isNull()).alias(f"mistyped_{f}"))]
    return parsed.agg(F.count(F.lit(1)).alias("lines"), F.count_if(~text).alias("blank"), F.count_if(text & F.col("v").isNull()).alias("malformed"), F.count_if(text & F.col("v").isNotNull() & ~kind.startswith("OBJECT")).alias("not_object"), *counts, (F.count_if(has_id) - F.count_distinct(F.when(has_id, F.col(f"r.{fields[0]}")))).alias("repeated_ids"))


def scan_queries(spark: SparkSession, path: str, expected: list[str] | None = None) -> DataFrame:
    """query_id, text: exactly these two fields, ids q000-q999, unique, texts not blank; in order the expected ids."""
    lines = spark.read.text(path).where("trim(value) <> ''")
    keys = F.array_sort(F.json_object_keys("value"))
    rows = lines.select(keys.alias("keys"), F.from_json("value", "query_id string, text string").alias("q"))
    require(rows, (F.array_join("keys", ",") != "query_id,text") | ~F.col("q.query_id").rlike("^q[0-9]{3}$") | (F.trim("q.text") == ""), f"{path} has invalid queries")
    out = rows.select("q.*")
    if out.groupBy("query_id").count().where("count > 1").limit(1).count():
        raise ContractError(f"{path} has repeated query ids")
    if expected is not None and [r.query_id for r in out.orderBy("query_id").limit(len(expected) + 1).collect()] != sorted(expected):
        raise ContractError(f"{path} does not hold the expected query ids")
    return out


def scan_judgments(spark: SparkSession, path: str, per_query: int = 5) -> DataFrame:
    """Judgments of a CSV file with the exact header; each query has ranks 1 to ``per_query`` and grades 0 to 3."""
    names = [f.name for f in Y._parse_datatype_string(JUDGMENT)]
    head = spark.read.text(path).first()
    if head is None or head.value.lstrip("﻿").strip() != ",".join(names):
        raise ContractError(f"{path} has another header")
    rows = spark.read.schema(JUDGMENT).option("header", "true").option("enforceSchema", "true").option("multiLine", "true").option("escape", '"').option("mode", "FAILFAST").csv(path)
    require(rows, ~F.col("human_grade").between(0, 3) | F.col("rank").isNull(), f"{path} has invalid grades or ranks")
    groups = rows.groupBy("query_id").agg(F.array_sort(F.collect_list("rank")).alias("ranks"))
    require(groups, F.col("ranks") != F.array(*[F.lit(i) for i in range(1, per_query + 1)]), f"{path} has incomplete queries")
    return rows


def write_judgment_sheet(rows: DataFrame, path: str) -> None:
    """Sheet for graders, in order of query and rank; a mark of UTF-8 stands before its first name, as spreadsheets want it."""
    names = [f.name for f in Y._parse_datatype_string(JUDGMENT)]
    rows.select(*[c if c in rows.columns else F.lit(None).cast("string").alias(c) for c in names]).orderBy("query_id", "rank").withColumnRenamed(names[0], "\ufeff" + names[0]).coalesce(1).write.mode("errorifexists").option("header", "true").option("escape", '"').csv(path)


def _fs(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), target


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file, whole or not at all: written aside, then renamed."""
    fs, target = _fs(spark, path)
    aside = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{path}.{time.time_ns()}.tmp")
    stream = fs.create(aside, True)
    stream.write(bytearray(text.encode("utf-8")))
    stream.close()
    if not fs.rename(aside, target):
        fs.delete(target, False)
        if not fs.rename(aside, target):
            raise OSError(f"cannot publish {path}")


def read_text(spark: SparkSession, path: str) -> str:
    return "\n".join(r.value for r in spark.read.option("wholetext", "true").text(path).collect())


def exists(spark: SparkSession, path: str) -> bool:
    fs, target = _fs(spark, path)
    return fs.exists(target)


def publish(df: DataFrame, folder: str, order: str, identity: str, **facts) -> dict:
    """Write data, then the manifest; an artifact that is there is never overwritten."""
    spark = df.sparkSession
    if exists(spark, f"{folder}/manifest.json"):
        raise FileExistsError(folder)
    df.write.mode("overwrite").parquet(f"{folder}/data")
    return recover(spark, folder, order, identity, **facts)


def recover(spark: SparkSession, folder: str, order: str, identity: str, **facts) -> dict:
    """Give data that was written whole, but not published, its manifest."""
    if not exists(spark, f"{folder}/data/_SUCCESS"):
        raise ContractError(f"{folder} holds no complete data")
    found = identity_hash(spark.read.parquet(f"{folder}/data"), order, identity).first()
    if found.duplicates:
        raise ContractError(f"{folder}: {found.duplicates} repeated values of {identity}")
    manifest = {"version": 1, "rows": found.n, "sha256": found.sha256, "order": order, "identity": identity, **facts}
    write_text(spark, f"{folder}/manifest.json", json.dumps(manifest, sort_keys=True, ensure_ascii=False, indent=1))
    return manifest


def load(spark: SparkSession, folder: str, verify: bool = True) -> tuple[DataFrame, dict]:
    """(data, manifest) of an artifact; with ``verify`` rows and identity are compared."""
    if not exists(spark, f"{folder}/manifest.json"):
        raise ContractError(f"{folder} has no manifest")
    manifest = json.loads(read_text(spark, f"{folder}/manifest.json"))
    data = spark.read.parquet(f"{folder}/data")
    if verify:
        found = identity_hash(data, manifest["order"], manifest["identity"]).first()
        if (found.n, found.sha256) != (manifest["rows"], manifest["sha256"]):
            raise ContractError(f"{folder} does not match its manifest")
    return data, manifest


def load_vectors(spark: SparkSession, folder: str, dim: int, vector_col: str = "embedding") -> DataFrame:
    """Vectors of an artifact, all finite, of ``dim`` components and unit length."""
    data, _ = load(spark, folder)
    return require(data, F.size(problems(F.col(vector_col), dim)) > 0, f"{folder} holds bad vectors")


#: What the manifest of an index says, exactly.
INDEX_FIELDS = {"version", "kind", "dimension", "rows", "ordered_ids_sha256", "vectors_sha256", "settings_sha256"}


def build_index(spark: SparkSession, vectors: str, chunks: DataFrame, folder: str, dim: int, settings: str, order: str = "row_pos", identity: str = "chunk_id") -> dict:
    """Publish the index of an artifact of vectors: exact search needs no structure beside them, so it is a manifest.

    Only if the vectors are whole and their ids, in order, are those of the
    metadata ``chunks`` (with ``order`` and ``identity``).
    """
    data, made = load(spark, vectors)
    require(data, F.size(problems(F.col("embedding"), dim)) > 0, f"{vectors} holds bad vectors")
    found = identity_hash(chunks, order, identity).first()
    if (found.n, found.sha256) != (made["rows"], made["sha256"]):
        raise ContractError(f"{vectors} and its metadata differ in rows or in the order of ids")
    manifest = {"version": 1, "kind": "exact inner product", "dimension": dim, "rows": found.n, "ordered_ids_sha256": found.sha256, "vectors_sha256": vectors_digest(data, order), "settings_sha256": settings}
    write_text(spark, f"{folder}/index.json", json.dumps(manifest, sort_keys=True, indent=1))
    return manifest


def vectors_digest(data: DataFrame, order: str, vector_col: str = "embedding") -> str:
    """One digest of all vectors in order."""
    digests = data.select(order, F.sha2(F.to_json(F.struct(vector_col)), 256).alias("d"))
    return identity_hash(digests, order, "d").first().sha256


def load_index(spark: SparkSession, folder: str, vectors: str, chunks: DataFrame, settings: str, order: str = "row_pos", identity: str = "chunk_id") -> DataFrame:
    """Vectors of an index whose manifest fits its data, its metadata and the settings it is used with."""
    manifest = json.loads(read_text(spark, f"{folder}/index.json"))
    if set(manifest) != INDEX_FIELDS or manifest["version"] != 1:
        raise ContractError(f"{folder} has a manifest of another form")
    if manifest["settings_sha256"] != settings:
        raise ContractError(f"{folder} was made with other settings")
    data, _ = load(spark, vectors)
    found = identity_hash(chunks, order, identity).first()
    if (found.n, found.sha256) != (manifest["rows"], manifest["ordered_ids_sha256"]):
        raise ContractError(f"{folder} does not fit its metadata")
    if vectors_digest(data, order) != manifest["vectors_sha256"] or data.where(F.size("embedding") != manifest["dimension"]).limit(1).count():
        raise ContractError(f"{folder} does not fit its vectors")
    return data


#: Manifests and the fields each must have.
MANIFESTS = {"artifact": {"version", "rows", "sha256", "order", "identity"}, "benchmark": {"doc_ids"}, "chunking": {"encoder_limit", "special_tokens", "capacity"}}


def load_manifest(spark: SparkSession, path: str, kind: str) -> dict:
    """A manifest of one kind with its fields; a benchmark names documents, chunk settings prove their capacity."""
    found = json.loads(read_text(spark, path))
    if not isinstance(found, dict) or (missing := MANIFESTS[kind] - set(found)):
        raise ContractError(f"{path} lacks {sorted(missing) if isinstance(found, dict) else 'an object'}")
    if kind == "benchmark" and not (isinstance(found["doc_ids"], list) and found["doc_ids"] and len(set(found["doc_ids"])) == len(found["doc_ids"])):
        raise ContractError(f"{path} names no documents, or some twice")
    if kind == "chunking" and found["encoder_limit"] - found["special_tokens"] != found["capacity"]:
        raise ContractError(f"{path} states another capacity than its limits give")
    return found
