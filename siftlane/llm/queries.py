"""The registered queries of the operators, one ``opN_<name>`` each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import spread
from ..sources.tables import read_table
from . import bpe as BP
from . import conversations as CO
from . import decontam as DE
from . import html_text as HT
from . import infill as IN
from . import quality as QU
from . import secrets as SE
from . import simhash as SH
from . import token_files as TF
from . import topk_search as TK
from . import toxicity as TX
from . import url_rules as UR
from . import warc as WA


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents; a table of fewer splits than the cluster has cores is dealt out first, as its texts go through Python."""
    return spread(read_table(spark, sf_dir, "documents"))


URL_RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def op1_exact_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = TK.quantise(read_table(spark, sf_dir, "embeddings"), scale=256)
    return TK.top_k(vectors.where("vec_id % 50 = 0"), vectors, k=5)


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return SE.scan(docs, SE.train(docs))


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op8_bpe_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return BP.encode_decode(_documents(spark, sf_dir), tokenizer_path("byte_bpe_50k.json"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return TF.round_trip(read_table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return SH.near_duplicates(_documents(spark, sf_dir))


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return WA.round_trip(read_table(spark, sf_dir, "pages"))


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _documents(spark, sf_dir), read_table(spark, sf_dir, "labels")
    model = TX.train(docs, labels.where(~TX.held_out()))
    return TX.score(docs, model).select("doc_id", TX.held_out().alias("held_out"), "score", "predicted")


def op7_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "action string, host string, path string")
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return UR.judge_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    return QU.grade(docs, QU.train(docs, read_table(spark, sf_dir, "labels")))


def op10_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = DE.contained_items(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "shared", "item_shingles", "containment")


def op11_infill(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = IN.restore(IN.transform(_documents(spark, sf_dir)))
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2("restored", 256).alias("restored_sha256")
    return out.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


def op13_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    given = read_table(spark, sf_dir, "conversations")
    got = CO.repair(CO.damage(given))
    report, hashes = got.report.withColumnRenamed("conv_id", "reported"), CO.digests(got.rows).withColumnRenamed("conv_id", "hashed")
    every = given.select("conv_id").distinct()
    every = every.join(report, F.col("conv_id").eqNullSafe(F.col("reported")), "left").join(hashes, F.col("conv_id").eqNullSafe(F.col("hashed")), "left")
    counts = [F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    return every.select("conv_id", *counts, F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))


def op12_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = HT.main_text(spread(read_table(spark, sf_dir, "pages")))
    return out.select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"))
