"""Sentence isolation (E3: P8-P12, J7, G3, K4)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .chunk import sentence_rows
from .search import maxsim_column
from .topk import top_k_per_key


def isolate_sentences(hits: DataFrame, queries: DataFrame, embedder, top_n: int = 2) -> DataFrame:
    """Cuts each hit's text into sentences, scores every sentence by MaxSim
    (plain inner products, not normalised) against its query's token matrix
    and keeps the best ``top_n`` per hit (score desc, then sentence order).
    A hit without sentences keeps its raw text with score 0.

    ``hits``: (query_id, rank, id, text); ``queries``: (query_id, q_toks), a
    written table, whose size decides its join.
    Returns (query_id, rank, id, sent_rank, sent_ix, sentence, score)."""
    sents = sentence_rows(hits, "text", keep=["query_id", "rank", "id"])
    enc = embedder.encode_tokens(sents, "sentence", side="doc")
    score = maxsim_column(embedder.tok_kind, embedder.tok_dim, normalize=False)
    scored = enc.join(queries.select("query_id", "q_toks"), "query_id").withColumn(
        "score", F.when(F.col("is_fallback"), F.lit(0.0)).otherwise(score)
    )
    top = top_k_per_key(
        scored, ["query_id", "id"], [F.round("score", 6).desc(), F.col("sent_ix").asc()], top_n, rank_col="sent_rank"
    )
    return top.select(
        "query_id", "rank", "id", "sent_rank", "sent_ix", "sentence", F.round("score", 6).alias("score")
    )
