"""Reports: corpus statistics (G10), payload comparison (E5: G4-G8),
prefetch-limit sweep (E6: K5, K6, J6, G9), footprint and cost (E7: F5, F6)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import cost as C
from ..functions import prompt as PR
from ..functions import text as T
from ..operators.search import scored_candidates
from ..operators.topk import maxsim_top_k

# The swept prefetch limits and the projected query volumes.
SWEEP_LIMITS = (10, 25, 50, 100, 250, 500)
COST_VOLUMES = (1_000, 100_000)
PIPELINES = ("dense", "two_stage", "two_stage_isolated")


def corpus_stats(docs: DataFrame, sections_col: str = "sections") -> DataFrame:
    """G10 + F7 in one scan of the documents: documents, chunks (= sections)
    and whitespace words per chunk."""
    words = F.aggregate(F.transform(sections_col, lambda s: T.word_count(s).cast("long")), F.lit(0).cast("long"),
                        lambda a, b: a + b)
    agg = docs.agg(
        F.count(F.lit(1)).alias("n_documents"),
        F.sum(F.size(sections_col)).cast("long").alias("n_chunks"),
        F.sum(words).cast("long").alias("n_words"),
    )
    return agg.select("*", F.round(F.col("n_words") / F.col("n_chunks"), 6).alias("avg_words_per_chunk"))


def payload_report(queries: DataFrame, dense_hits: DataFrame, two_stage_hits: DataFrame,
                   isolated: DataFrame) -> DataFrame:
    """E5: average prompt payload per pipeline over all queries.

    dense / two_stage: per query, the sum of token counts of the hit texts
    (G4); two_stage_isolated: the token count of all isolated sentences of a
    query joined by spaces (G5).  A query without hits counts 0.  Reduction
    is against the dense baseline as a ratio of averages (G7)."""
    qids = queries.select("query_id")

    def summed(hits, name):
        per_q = hits.groupBy("query_id").agg(F.sum(T.count_tokens(F.col("text"))).alias("tokens"))
        return qids.join(per_q, "query_id", "left").select(
            F.lit(name).alias("pipeline"), "query_id", F.coalesce("tokens", F.lit(0)).alias("tokens")
        )

    joined = isolated.groupBy("query_id").agg(
        PR.ordered_join(
            F.collect_list(F.struct(F.struct("rank", "sent_rank").alias("o"), F.col("sentence").alias("t"))), " "
        ).alias("context")
    )
    iso = qids.join(joined, "query_id", "left").select(
        F.lit(PIPELINES[2]).alias("pipeline"), "query_id",
        F.coalesce(T.count_tokens(F.col("context")), F.lit(0)).alias("tokens"),
    )
    long = summed(dense_hits, PIPELINES[0]).unionByName(summed(two_stage_hits, PIPELINES[1])).unionByName(iso)
    tok = F.col("tokens").cast("double")
    wide = long.agg(*[
        agg for p in PIPELINES for agg in (
            F.count(F.when(F.col("pipeline") == p, F.lit(1))).alias(f"n_{p}"),
            F.avg(F.when(F.col("pipeline") == p, tok)).alias(f"avg_{p}"),
        )
    ])
    rows = F.array(*[
        F.struct(F.lit(p).alias("pipeline"), F.col(f"n_{p}").alias("n_queries"),
                 F.round(F.col(f"avg_{p}"), 6).alias("avg_tokens"),
                 F.round(PR.reduction_pct(F.col(f"avg_{p}"), F.col(f"avg_{PIPELINES[0]}")), 6).alias(
                     "reduction_vs_dense_pct"))
        for p in PIPELINES
    ])
    return wide.select(F.inline(rows))


def cost_projection(report: DataFrame, volumes=COST_VOLUMES,
                    price: float = C.PRICE_PER_MILLION_INPUT_TOKENS) -> DataFrame:
    """E7 / F6 fed by measured averages: standard = dense pipeline,
    optimized = two-stage + isolation."""
    wide = report.agg(
        F.max(F.when(F.col("pipeline") == PIPELINES[0], F.col("avg_tokens"))).alias("standard_tokens"),
        F.max(F.when(F.col("pipeline") == PIPELINES[2], F.col("avg_tokens"))).alias("optimized_tokens"),
    )
    vols = F.explode(F.array(*[F.lit(v).cast("long") for v in volumes])).alias("n_queries")
    w = wide.select("*", vols)
    std = C.query_cost(F.col("standard_tokens"), F.col("n_queries"), price)
    opt = C.query_cost(F.col("optimized_tokens"), F.col("n_queries"), price)
    return w.select(
        "n_queries", "standard_tokens", "optimized_tokens",
        F.round(std, 6).alias("standard_usd"), F.round(opt, 6).alias("optimized_usd"),
        F.round(std - opt, 6).alias("savings_usd"),
        F.round(PR.reduction_pct(opt, std), 6).alias("savings_pct"),
    )


def cost_table(tokens: DataFrame, price: float = C.PRICE_PER_MILLION_INPUT_TOKENS) -> DataFrame:
    """F6 over a table of (n_queries, standard_tokens, optimized_tokens)."""
    std = C.query_cost(F.col("standard_tokens"), F.col("n_queries"), price)
    opt = C.query_cost(F.col("optimized_tokens"), F.col("n_queries"), price)
    return tokens.select(
        "*", std.alias("standard_usd"), opt.alias("optimized_usd"), (std - opt).alias("savings_usd"),
        PR.reduction_pct(opt, std).alias("savings_pct"),
    )


def footprint(index: DataFrame, dense_col: str = "dense") -> DataFrame:
    """F5 measured over an index: per-vector bytes at float32 and at 1 bit
    per dimension, and corpus totals."""
    per = index.select(F.size(dense_col).alias("dim"))
    agg = per.groupBy("dim").agg(F.count(F.lit(1)).alias("n_vectors"))
    full = C.full_precision_bytes(F.col("dim"))
    binb = C.binary_bytes(F.col("dim"))
    return agg.select(
        "dim", "n_vectors", full.alias("full_precision_bytes"), binb.alias("binary_quantized_bytes"),
        F.round(full / binb, 6).alias("compression_ratio"),
        (full * F.col("n_vectors")).alias("corpus_full_precision_bytes"),
        (binb * F.col("n_vectors")).alias("corpus_binary_bytes"),
    )


def _top1_by_limit(scored: DataFrame, limits: list[int]) -> DataFrame:
    """(query_id, prefetch_limit, top1) from scored candidates: the highest score, then the smallest id, of those that each limit keeps."""
    row = F.struct((-F.round("score", 6)).alias("s"), "id")
    best = scored.groupBy("query_id").agg(*[F.min(F.when(F.col("stage1_rank") <= x, row)).alias(f"b{x}") for x in limits])
    per_limit = F.array(*[F.struct(F.lit(x).alias("prefetch_limit"), F.col(f"b{x}.id").alias("top1")) for x in limits])
    return best.select("query_id", F.inline(per_limit))


def true_recall(index: DataFrame, queries: DataFrame, *, code_words: int, tok_dim: int, limits=SWEEP_LIMITS,
                exclude_self: bool = False) -> DataFrame:
    """E6 against the truth: for each limit the share of queries whose best
    row over the whole index, found by exact MaxSim over all pairs, is also the
    best of the two-stage search.  Float token matrices.
    Returns (prefetch_limit, found, n_queries, recall_pct); a query without any
    row to find counts as found."""
    limits = sorted(set(int(x) for x in limits))
    scored = scored_candidates(index, queries, limits[-1], code_words, "float", tok_dim, exclude_self)
    truth = maxsim_top_k(index, queries, k=1, tok_dim=tok_dim, q_self="self_id" if exclude_self else None)
    grid = queries.select("query_id", F.explode(F.array(*map(F.lit, limits))).alias("prefetch_limit"))
    g = grid.join(_top1_by_limit(scored, limits), ["query_id", "prefetch_limit"], "left").join(truth.select("query_id", F.col("id").alias("true_top1")), "query_id", "left")
    rate = g.groupBy("prefetch_limit").agg(F.sum(F.col("top1").eqNullSafe(F.col("true_top1")).cast("int")).alias("found"), F.count(F.lit(1)).alias("n_queries"))
    return rate.select("prefetch_limit", "found", "n_queries", F.round(F.col("found") * 100.0 / F.col("n_queries"), 6).alias("recall_pct"))


def limit_sweep(index: DataFrame, queries: DataFrame, *, code_words: int, tok_kind: str, tok_dim: int,
                limits=SWEEP_LIMITS, exclude_self: bool = False, buckets: int | None = None) -> DataFrame:
    """E6 in one pass: stage 1 once at the largest limit (keeping each
    candidate's stage-1 rank), MaxSim once per candidate, then for each limit
    L the best candidate among those with stage1_rank <= L.  The best of all
    limits are one aggregate per query, with one row a query and task in the
    shuffle and no row per limit.  Queries without any candidate count as null top-1, and
    null == null is a match (K5, J6).  The largest limit is the reference."""
    limits = sorted(set(int(x) for x in limits))
    top_limit = limits[-1]
    scored = scored_candidates(index, queries, top_limit, code_words, tok_kind, tok_dim, exclude_self, buckets=buckets)
    lim_arr = F.array(*[F.lit(x) for x in limits])
    top1 = _top1_by_limit(scored, limits)
    grid = queries.select("query_id", F.explode(lim_arr).alias("prefetch_limit"))
    g = grid.join(top1, ["query_id", "prefetch_limit"], "left")
    ref = g.filter(F.col("prefetch_limit") == top_limit).select("query_id", F.col("top1").alias("ref_top1"))
    cmp = g.join(ref, "query_id")
    rate = cmp.groupBy("prefetch_limit").agg(
        F.sum(F.col("top1").eqNullSafe(F.col("ref_top1")).cast("int")).alias("matches"),
        F.count(F.lit(1)).alias("n_queries"),
    )
    pct = F.col("matches") * 100.0 / F.col("n_queries")
    status = F.when(F.col("prefetch_limit") == top_limit, F.lit("100% (Reference)")).otherwise(
        F.format_string("%d%% (%d/%d)", F.bround(pct, 0).cast("long"), F.col("matches"), F.col("n_queries"))
    )
    return rate.select(
        "prefetch_limit", "matches", "n_queries", F.round(pct, 6).alias("match_rate_pct"), status.alias("match_status")
    )
