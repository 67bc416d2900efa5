"""Further columns of any name and type beside the ones an operator works on."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

from textlode.llm import bpe, language_id, minhash_dedup, mixing, substring_dedup, toxicity
from textlode.sources import staging

SCHEMA = "doc_id long, text string, source string"


def operators(spark):
    train = spark.createDataFrame([(k, ["the cat", "le chat"][k % 2], ["en", "fr"][k % 2]) for k in range(20)], "doc_id long, text string, lang string")
    model = language_id.fit(train)
    toxic = toxicity.fit(train.select("doc_id", "text"), train.selectExpr("doc_id", "cast(doc_id % 2 as int) as toxic"))
    return {
        "substring": (substring_dedup.substring_dedup, substring_dedup.RESULTS),
        "bpe": (lambda d: bpe.bpe_round_trip(d, public_tokenizers.path("byte_bpe_50k.json")), bpe.RESULTS),
        "language": (lambda d: language_id.identify(d, model), language_id.RESULTS),
        "toxicity": (lambda d: toxicity.score_toxicity(d, toxic), toxicity.RESULTS),
        "mixing": (mixing.mix_sources, mixing.RESULTS),
    }


def test_results_replace_columns_of_their_name_in_any_case_and_can_be_written(spark, tmp_path):
    for name, (run, results) in operators(spark).items():
        docs = spark.createDataFrame([(1, "a b c", "s"), (2, None, None)], SCHEMA)
        for r in results:
            docs = docs.withColumn(r.upper(), F.lit("old"))
        docs = docs.withColumn("a b", F.lit(1)).withColumn("x.y", F.lit(2)).withColumn("_size", F.lit(3)).withColumn("m", F.create_map(F.lit("k"), F.lit(1)))
        out = run(docs)
        assert out.columns == ["doc_id", "text", "source", "a b", "x.y", "_size", "m", *results], name
        out.write.parquet(f"{tmp_path}/{name}")
        rows = spark.read.parquet(f"{tmp_path}/{name}").collect()
        assert sorted(r.doc_id for r in rows) == [1, 2] and all((r["a b"], r["x.y"], r["_size"], r["m"]) == (1, 2, 3, {"k": 1}) for r in rows), name


def test_near_duplicates_keep_rows_with_columns_of_any_type(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", "s"), (1, "a b c d e f", "r"), (2, "A b c d e f", "t"), (3, None, "u")], SCHEMA)
    docs = docs.withColumn("m", F.create_map(F.col("source"), F.lit(1))).withColumn("K1", F.lit(1)).withColumn("x.y", F.array(F.lit(b"z")))
    got = minhash_dedup.drop_near_duplicates(docs).collect()
    assert sorted((r.doc_id, r.source) for r in got) == [(1, "r"), (3, "u")] and got[0].m


def test_a_cluster_without_a_shared_folder_is_an_error(spark, monkeypatch):
    class Context:
        def __init__(self, master):
            self.master, self.at = master, None

        def getCheckpointDir(self):  # noqa: N802
            return self.at

        def setCheckpointDir(self, at):  # noqa: N802
            self.at = at

    class Session:
        class conf:  # noqa: N801
            @staticmethod
            def get(name, other=None):
                return other

        def __init__(self, master):
            self.sparkContext = Context(master)

    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]", "k8s://x"):
        with pytest.raises(ValueError, match="checkpoint"):
            staging.shared_dir(Session(master))
    assert staging.shared_dir(Session("local[8]")).startswith("file:///")
