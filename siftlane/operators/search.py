"""Search operators over an index table.

Index columns used here (any other column is payload):
    id      unique, of any sortable type; ties are broken by the smaller id
    code    ARRAY<BIGINT>           1-bit code of the dense vector
    dense   ARRAY<FLOAT|DOUBLE>     full-precision dense vector
    toks    ARRAY<ARRAY<FLOAT>>     token matrix          (tok_kind='float')
            ARRAY<ARRAY<BIGINT>>    packed +-1 token codes (tok_kind='codes')
Query columns: query_id, q_code, q_dense, q_toks, optional self_id.

Candidates and hits (queries x limit rows) are written once to the shared
folder (``freeze``).  That cuts the lineage and gives the joins below their
measured size: they are broadcast when they are short (``short``), so the scan
of token matrices or payload does not move, and Spark decides when they are not.  They are
written in small Arrow batches (``small_batches``): a row is a block of vectors or two
matrices, and a worker would hold 64 MB of them at once where its part of the index is large.  An index
with a ``bucket`` column (``buckets`` of them, by a hash of the document id)
is joined on it as well: only the buckets of the candidates or hits are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import maxsim_arrow as MA
from ..functions import vector as V
from ..session import freeze, is_short, short, small_batches
from ..sources.index import bucket_of
from .topk import scan_top_k, top_k_per_key

# MaxSim kernel: "arrow" (numpy per Arrow batch) or "hof" (Spark lambdas).
MAXSIM_IMPL = "arrow"
# Bytes of token matrices of a group of queries, or of rows, pairs of a cell, and pairs that are scored at once there.
GROUP_BYTES = 32 << 20
GROUP_PAIRS = 500_000
PAIRS = 8192


def _rank_order(score_col: str = "score", id_col: str = "id"):
    return [F.round(F.col(score_col), 6).desc(), F.col(id_col).asc()]


def prefetch(index: DataFrame, queries: DataFrame, limit: int, code_words: int, exclude_self: bool = False) -> DataFrame:
    """J1 + G2 + K1: the ``limit`` nearest index rows per query by Hamming
    distance between 1-bit codes (no full-precision correction).
    Returns (query_id, id, ham, stage1_rank)."""
    res = scan_top_k(
        index, queries, k=limit, mode="hamming", width=code_words, vec_col="code", q_vec="q_code",
        q_self="self_id" if exclude_self else None,
    )
    return res.select("query_id", "id", F.col("value").cast("int").alias("ham"), F.col("rank").alias("stage1_rank"))


def maxsim_column(tok_kind: str, tok_dim: int, normalize: bool = True, impl: str | None = None):
    """G3 between the ``q_toks`` and ``toks`` columns."""
    impl = impl or MAXSIM_IMPL
    mod = MA if impl == "arrow" else V
    if tok_kind == "codes":
        return mod.maxsim_codes(F.col("q_toks"), F.col("toks"), tok_dim)
    return mod.maxsim(F.col("q_toks"), F.col("toks"), normalize_tokens=normalize)


def _beside(index: DataFrame, columns: list[str], found: DataFrame, buckets: int | None) -> DataFrame:
    """Columns of the index for the written rows ``found`` (with ``id``), from the buckets that these are in."""
    if buckets is None:
        return index.select("id", *columns).join(found, "id")
    # the filter tells Spark that the buckets are few enough to prune by
    found = found.withColumn("bucket", bucket_of(F.col("id.doc_id"), buckets)).where("bucket >= 0")
    return index.select("bucket", "id", *columns).join(found, ["bucket", "id"]).drop("bucket")


def score_candidates(index: DataFrame, queries: DataFrame, candidates: DataFrame, tok_kind: str, tok_dim: int, normalize: bool = True,
                     buckets: int | None = None) -> DataFrame:
    """P15 + J3 + G3: MaxSim of every candidate pair, reading token matrices
    only for candidate ids.  ``candidates`` is a written table (see above)."""
    toks = _beside(index, ["toks"], candidates, buckets)
    pairs = toks.join(queries.select("query_id", "q_toks"), "query_id")
    return pairs.withColumn("score", maxsim_column(tok_kind, tok_dim, normalize)).drop("toks", "q_toks")


def _matrix_bytes(rows: DataFrame, col: str) -> int:
    """Bytes of all token matrices, as Spark holds them."""
    return rows.agg(F.sum(F.aggregate(col, F.lit(64).cast("long"), lambda a, t: a + 24 + 8 * F.size(t)))).first()[0] or 0


def score_grid(toks: int, q_toks: int, pairs: int, cores: int) -> tuple[int, int]:
    """Groups of queries and of rows, in the proportion that moves the fewest bytes; no cell has much more than GROUP_BYTES of a side or GROUP_PAIRS pairs."""
    cells = max(4 * cores, -(-pairs // GROUP_PAIRS))
    n_queries = max(1, round((cells * q_toks / max(toks, 1)) ** 0.5), -(-q_toks // GROUP_BYTES))
    return min(n_queries, cells), max(1, -(-cells // n_queries), -(-toks // GROUP_BYTES))


def _scored_groups(tok_kind: str, tok_dim: int, normalize: bool, fields: list[str]):
    """cogroup function: scores of all pairs of some rows ``(id, toks, who)`` with the queries that they name."""
    kernel = MA.codes_kernel(tok_dim) if tok_kind == "codes" else MA.float_kernel(normalize)

    def run(rows: pa.Table, queries: pa.Table) -> pa.Table:
        rows, queries = rows.combine_chunks(), queries.combine_chunks()
        who, asked = rows.column("who").combine_chunks(), queries.column("query_id").to_pylist()
        place: dict = {}
        for i, q in enumerate(asked):
            place.setdefault(q, []).append(i)
        named = who.flatten()
        beside = np.repeat(np.arange(rows.num_rows), np.diff(who.offsets.to_numpy()))
        found = [place.get(q, ()) for q in named.field("query_id").to_pylist()]
        times = np.fromiter(map(len, found), np.int64, len(found))
        pair = np.repeat(np.arange(len(found)), times)
        q_at = np.fromiter((i for f in found for i in f), np.int64, int(times.sum()))
        r_at = beside[pair]
        q_toks, toks = (t.column(c).combine_chunks() for t, c in ((queries, "q_toks"), (rows, "toks")))
        scores = [kernel(q_toks.take(pa.array(q_at[s : s + PAIRS])), toks.take(pa.array(r_at[s : s + PAIRS]))) for s in range(0, len(pair), PAIRS)]
        named = named.take(pa.array(pair))
        out = [rows.column("id").combine_chunks().take(pa.array(r_at)), *(named.field(f) for f in fields), pa.chunked_array(scores, pa.float64()).combine_chunks()]
        return pa.table(out, names=["id", *fields, "score"])

    return run


def score_in_groups(index: DataFrame, queries: DataFrame, candidates: DataFrame, tok_kind: str, tok_dim: int, normalize: bool = True,
                    buckets: int | None = None, groups: tuple[int, int] | None = None) -> DataFrame:
    """:func:`score_candidates` where candidates are many: a row's token matrix
    moves once to each group of queries that has it among its candidates, not
    once a pair.  Both sides are dealt to a grid, query groups by row groups
    (``groups`` sets it, else :func:`score_grid`)."""
    fields = [c for c in candidates.columns if c != "id"]
    if groups is None:
        pairs = candidates.agg(F.count(F.lit(1))).first()[0]
        groups = score_grid(_matrix_bytes(index, "toks"), _matrix_bytes(queries, "q_toks"), pairs, index.sparkSession.sparkContext.defaultParallelism)
    n_queries, n_rows = map(F.lit, groups)
    of = lambda c, n: F.pmod(F.xxhash64(c), n).cast("int")
    who = candidates.where(F.col("query_id").isNotNull()).withColumn("q_group", of("query_id", n_queries)).repartition("id")
    who = who.groupBy("id", "q_group").agg(F.collect_list(F.struct(*fields)).alias("who"))
    rows = _beside(index, ["toks"], who, buckets).withColumn("r_group", of("id", n_rows)).select("id", "toks", "who", "q_group", "r_group")
    asked = queries.select("query_id", "q_toks", of("query_id", n_queries).alias("q_group"), F.explode(F.sequence(F.lit(0), n_rows - 1)).alias("r_group"))
    kinds = {f.name: f.dataType.simpleString() for f in candidates.schema}
    ddl = ", ".join(f"`{c}` {kinds[c]}" for c in ["id", *fields]) + ", score double"
    run = _scored_groups(tok_kind, tok_dim, normalize, fields)
    cell = ["q_group", "r_group"]  # three partitions a cell keep most cells apart
    rows, asked = (df.repartition(3 * groups[0] * groups[1], *cell) for df in (rows, asked))
    return rows.groupBy(*cell).cogroup(asked.groupBy(*cell)).applyInArrow(run, ddl)


def scored_candidates(index: DataFrame, queries: DataFrame, limit: int, code_words: int, tok_kind: str, tok_dim: int,
                      exclude_self: bool = False, normalize: bool = True, buckets: int | None = None) -> DataFrame:
    """Stage 1 + stage 2 for every query."""
    with small_batches(index.sparkSession):
        cand = freeze(prefetch(index, queries, limit, code_words, exclude_self), "candidates")
    if not is_short(cand):
        return score_in_groups(index, queries, cand, tok_kind, tok_dim, normalize, buckets)
    cand = F.broadcast(cand)
    return score_candidates(index, queries, cand, tok_kind, tok_dim, normalize, buckets)


def two_stage_search(
    index: DataFrame,
    queries: DataFrame,
    *,
    prefetch_limit: int = 100,
    top_k: int = 5,
    code_words: int,
    tok_kind: str,
    tok_dim: int,
    exclude_self: bool = False,
    normalize: bool = True,
    buckets: int | None = None,
) -> DataFrame:
    """Stage 1 keeps ``prefetch_limit`` candidates per query by code
    distance, stage 2 re-ranks only those by MaxSim and keeps ``top_k``.
    Returns (query_id, rank, id, score, ham, stage1_rank); at most
    min(prefetch_limit, top_k) rows per query."""
    scored = scored_candidates(index, queries, prefetch_limit, code_words, tok_kind, tok_dim, exclude_self, normalize, buckets)
    top = top_k_per_key(scored, ["query_id"], _rank_order(), top_k)
    return top.select("query_id", "rank", "id", F.round("score", 6).alias("score"), "ham", "stage1_rank")


def dense_only_search(index: DataFrame, queries: DataFrame, *, top_k: int = 5, dim: int, exclude_self: bool = False) -> DataFrame:
    """E2 (J2 + G1 + K3): exact full-precision cosine over the whole index.
    Returns (query_id, rank, id, score)."""
    res = scan_top_k(
        index, queries, k=top_k, mode="cosine", width=dim, vec_col="dense", q_vec="q_dense",
        q_self="self_id" if exclude_self else None,
    )
    return res.select("query_id", "rank", "id", F.col("value").alias("score"))


def fetch_payload(hits: DataFrame, index: DataFrame, columns: list[str], buckets: int | None = None) -> DataFrame:
    """A5 + J4: late materialisation of payload columns for the final hits only."""
    with small_batches(hits.sparkSession):
        hits = freeze(hits, "hits")
    return _beside(index, columns, short(hits), buckets)
