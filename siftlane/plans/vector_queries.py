"""Registered queries over the ``embeddings`` table (q01-q06, q22, q23).

Fixture: ``embeddings(vec_id, embedding ARRAY<FLOAT>)``.  Single-vector
searches use every vector as a query against every other vector; the
late-interaction searches group ``GROUP`` consecutive vectors into one item's
token matrix.  Every query runs over the whole table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import vector as V
from ..operators import search as S
from ..sources import vectors as SV
from ..session import freeze
from ..sources.tables import read_table

# Fixed parameters of the registered queries.
GROUP = 5
PREFETCH_LIMIT = 10
TOP_K = 3
DENSE_TOP_K = 5
RECALL_LIMITS = [1, 2, 5, 10, 25, 50]


def _vectors(spark: SparkSession, sf_dir: str):
    emb = read_table(spark, sf_dir, "embeddings")
    return emb, SV.vector_dim(emb)


def _matrices(spark: SparkSession, sf_dir: str):
    """Token-matrix index of the embeddings, written once per query (it is
    scanned for codes, joined for token matrices and used as the queries)."""
    emb, dim = _vectors(spark, sf_dir)
    return freeze(SV.matrix_index(emb, dim, GROUP)), dim


def q01_two_stage_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx, dim = _matrices(spark, sf_dir)
    return S.two_stage_search(
        idx, SV.as_queries(idx), prefetch_limit=PREFETCH_LIMIT, top_k=TOP_K,
        code_words=V.n_words(dim), tok_kind="float", tok_dim=dim, exclude_self=True,
    )


def q02_dense_only_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb, dim = _vectors(spark, sf_dir)
    idx = SV.vector_index(emb, dim)
    return S.dense_only_search(idx, SV.as_queries(idx), top_k=DENSE_TOP_K, dim=dim, exclude_self=True)


def _hex(words):
    """Code words as 16 hexadecimal digits each, the first word first."""
    return F.array_join(F.transform(words, lambda w: F.lpad(F.lower(F.hex(w)), 16, "0")), " ")


def q03_binary_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb, dim = _vectors(spark, sf_dir)
    rows = emb.select("vec_id", V.binary_code(F.col("embedding"), dim).alias("code"))
    return rows.select("vec_id", V.popcount(F.col("code")).alias("n_set_bits"), F.size("code").alias("n_words"), _hex(F.col("code")).alias("code"))


def q04_hamming_prefetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    emb, dim = _vectors(spark, sf_dir)
    idx = SV.vector_index(emb, dim)
    return S.prefetch(idx, SV.as_queries(idx), PREFETCH_LIMIT, V.n_words(dim), exclude_self=True)


def q05_maxsim_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx, dim = _matrices(spark, sf_dir)
    queries = SV.as_queries(idx)
    scored = S.scored_candidates(idx, queries, PREFETCH_LIMIT, V.n_words(dim), "float", dim, exclude_self=True)
    return scored.select("query_id", "id", "ham", "stage1_rank", F.round("score", 6).alias("score"))


def q06_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    idx, _ = _matrices(spark, sf_dir)
    rows = idx.select("id", V.norm(F.col("dense")).alias("n"), V.normalize(F.col("dense")).alias("unit"))
    rows = rows.select("id", "n", V.norm(F.col("unit")).alias("u"), F.posexplode("unit").alias("dim", "x"))
    return rows.select("id", F.col("dim").cast("int").alias("dim"), F.round("n", 6).alias("norm"), F.round("u", 6).alias("unit_norm"), F.round("x", 6).alias("unit_x"))


def q22_limit_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import reports as R

    idx, dim = _matrices(spark, sf_dir)
    return R.limit_sweep(idx, SV.as_queries(idx), code_words=V.n_words(dim), tok_kind="float", tok_dim=dim,
                         exclude_self=True)


def q23_footprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    from . import reports as R

    emb, dim = _vectors(spark, sf_dir)
    return R.footprint(SV.vector_index(emb, dim))


def q31_raw_maxsim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 as plain inner products, the form that isolation uses, on token
    vectors that are not of unit length, beside the normalised form."""
    emb, dim = _vectors(spark, sf_dir)
    scaled = emb.withColumn("embedding", F.transform("embedding", lambda x: x.cast("double") * (F.col("label") + 1)))
    idx = freeze(SV.matrix_index(scaled, dim, GROUP))
    queries = SV.as_queries(idx)
    cand = freeze(S.prefetch(idx, queries, PREFETCH_LIMIT, V.n_words(dim), exclude_self=True))
    raw, unit = (S.score_candidates(idx, queries, cand, "float", dim, normalize=n).withColumnRenamed("score", c) for n, c in ((False, "raw"), (True, "unit")))
    both = raw.join(unit.select("query_id", "id", "unit"), ["query_id", "id"])
    return both.select("query_id", "id", "ham", F.round("raw", 6).alias("raw_score"), F.round("unit", 6).alias("unit_score"))


def q38_true_recall(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 against the exact best of all pairs."""
    from . import reports as R

    idx, dim = _matrices(spark, sf_dir)
    return R.true_recall(idx, SV.as_queries(idx), code_words=V.n_words(dim), tok_dim=dim, limits=RECALL_LIMITS, exclude_self=True)


def q39_exact_maxsim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G3 over all pairs: each item's best others."""
    from ..operators.topk import maxsim_top_k

    idx, dim = _matrices(spark, sf_dir)
    return maxsim_top_k(idx, SV.as_queries(idx), k=TOP_K, tok_dim=dim, q_self="self_id")
