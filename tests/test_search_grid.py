"""Stage 1 at scale: the block grid and the counting cut-off."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftlane.operators import topk


@pytest.fixture
def shuffled(spark):
    """Broadcast joins off, 24 shuffle partitions that stay apart."""
    want = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.shuffle.partitions": "24", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    old = {k: spark.conf.get(k) for k in want}
    for k, v in want.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def _codes(spark, n, words=1, seed=1, parts=4):
    rng = np.random.default_rng(seed)
    rows = [(i, [int(x) for x in rng.integers(-(2**63), 2**63 - 1, size=words)]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, code array<long>").repartition(parts)


def _queries(df, where="true"):
    return df.where(where).select(F.col("id").alias("query_id"), F.col("code").alias("q_code"))



def test_every_shuffle_partition_gets_pairs(shuffled):
    corpus = _codes(shuffled, 9000)
    queries = _queries(corpus, "id < 3000")
    scan, asked = corpus.select("id", F.col("code").alias("vec")), queries.select(F.col("query_id").alias("id"), F.col("q_code").alias("vec"))
    c, q = topk.grid(scan, asked, 1)
    c_groups, q_groups = corpus.limit(1).select(c, q).first()
    assert 24 <= c_groups * q_groups <= 4 * 72 and q_groups > 1 and c_groups > 1
    pairs = topk._pairs(scan, asked, c, q, "hamming", 1)
    loads = {r["p"]: r["n"] for r in pairs.select(F.spark_partition_id().alias("p"), (F.length("vecs") / 8 * F.length("q_vecs") / 8).alias("w")).groupBy("p").agg(F.sum("w").alias("n")).collect()}
    assert sum(loads.values()) == 9000 * 3000  # every pair once
    assert len(loads) >= 22 and max(loads.values()) < 0.25 * sum(loads.values())


def test_cells_are_bounded_in_bytes(shuffled, monkeypatch):
    monkeypatch.setattr(topk, "CELL_BYTES", 4096)
    corpus = _codes(shuffled, 3000)
    scan = corpus.select("id", F.col("code").alias("vec"))
    c, q = topk.grid(scan, scan, 1)
    c_groups, q_groups = corpus.limit(1).select(c, q).first()
    assert 3000 / c_groups * 32 <= 4096 and 3000 / q_groups * 32 <= 4096


def test_a_small_query_table_is_one_group(spark):
    corpus = _codes(spark, 2000)
    scan = corpus.select("id", F.col("code").alias("vec"))
    c, q = topk.grid(scan, scan.limit(50), 1)
    assert tuple(corpus.limit(1).select(c, q).first()) == (1, 1)


def _brute(corpus, k):
    rows = sorted((r.id, r.code) for r in corpus.collect())
    ids = np.array([r[0] for r in rows])
    words = np.array([r[1] for r in rows], np.int64).view(np.uint64)
    out = set()
    for i, w in zip(ids, words):
        d = np.bitwise_count(words ^ w).sum(1)
        order = np.lexsort((ids, d))[:k]
        out |= {(int(i), n, int(ids[j]), float(d[j])) for n, j in enumerate(order, 1)}
    return out


@pytest.mark.parametrize("count_first", [True, False])
def test_grids_and_counting_change_nothing(shuffled, count_first):
    corpus = _codes(shuffled, 400, words=2)
    want = _brute(corpus, 9)
    for cells in (None, (1, 1), (5, 3)):
        got = topk.scan_top_k(corpus, _queries(corpus), k=9, mode="hamming", width=2, cells=cells, count_first=count_first)
        assert {(r.query_id, r.rank, r.id, r.value) for r in got.collect()} == want


def test_counting_leaves_about_queries_times_k_rows(shuffled):
    k, corpus = 64, _codes(shuffled, 6000, parts=8)
    queries = _queries(corpus, "id % 30 = 0")
    n = queries.count()
    args = dict(k=k, mode="hamming", width=1, cells=(20, 1))
    counted = topk.partial_top_k(corpus, queries, **args).count()
    plain = topk.partial_top_k(corpus, queries, count_first=False, **args).count()
    assert n * k <= counted < 3 * n * k < 8 * n * k < plain  # ties at the k-th distance are the rest


def test_fewer_rows_than_k_and_own_rows(shuffled):
    corpus = _codes(shuffled, 30)
    queries = _queries(corpus).withColumn("self_id", F.col("query_id"))
    got = topk.scan_top_k(corpus, queries, k=100, mode="hamming", width=1, q_self="self_id")
    assert got.count() == 30 * 29 and got.where("query_id = id").count() == 0
    assert topk.scan_top_k(corpus.limit(0), queries, k=100, mode="hamming", width=1).count() == 0
    assert topk.scan_top_k(corpus, queries.limit(0), k=100, mode="hamming", width=1).count() == 0


@pytest.mark.parametrize("cells", [None, (3, 4)])
def test_exact_maxsim_equals_all_pairs(shuffled, cells, monkeypatch):
    monkeypatch.setattr(topk, "BLOCK_TOKENS", 30)
    rng = np.random.default_rng(4)
    rows = [(i, [[float(x) for x in rng.integers(-3, 4, size=5)] for _ in range(rng.integers(0, 7))]) for i in range(90)] + [(90, [[1.0] * 5] * 60)]
    df = shuffled.createDataFrame(rows, "id long, toks array<array<double>>")
    queries = df.where("id < 40").select(F.col("id").alias("query_id"), F.col("toks").alias("q_toks"), F.col("id").alias("self_id"))
    got = topk.maxsim_top_k(df, queries, k=4, tok_dim=5, q_self="self_id", cells=cells)

    def unit(m):
        m = np.array(m).reshape(-1, 5)
        n = np.sqrt((m * m).sum(1, keepdims=True))
        return np.divide(m, n, out=np.zeros_like(m), where=n > 0)

    want = set()
    for i, q in rows[:40]:
        scores = [(-round(float((unit(q) @ unit(d).T).max(1).sum()) if q and d else 0.0, 6) + 0.0, j) for j, d in rows if j != i]
        want |= {(i, n, j, -s + 0.0) for n, (s, j) in enumerate(sorted(scores)[:4], 1)}
    assert {(r.query_id, r.rank, r.id, round(r.score, 6) + 0.0) for r in got.collect()} == want
    with pytest.raises(Exception, match="without a vector"):
        topk.maxsim_top_k(df.withColumn("toks", F.when(F.col("id") > 3, F.col("toks"))), queries, k=1, tok_dim=5).collect()
