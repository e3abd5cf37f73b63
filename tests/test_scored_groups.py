"""Many candidates are scored in a grid of query groups and row groups."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftlane import session
from siftlane.operators import search as S
from siftlane.operators import topk


def _matrices(spark, n=70):
    rng = np.random.default_rng(3)
    rows = [(i, [[float(x) for x in rng.integers(-3, 4, size=4)] for _ in range(rng.integers(0, 6))], [int(rng.integers(0, 2**62))]) for i in range(n)]
    return spark.createDataFrame(rows, "id long, toks array<array<float>>, code array<long>")


@pytest.mark.parametrize("groups", [None, (1, 1), (3, 5)])
def test_groups_score_every_pair_alike(spark, groups):
    idx = _matrices(spark)
    queries = idx.where("id < 30").select(F.col("id").alias("query_id"), F.col("toks").alias("q_toks"))
    queries = queries.unionByName(queries.where("query_id = 4"))  # a query twice
    cand = queries.select("query_id").distinct().crossJoin(idx.select("id").where("id % 3 = 0")).withColumn("ham", F.lit(1))
    args = ("float", 4)
    plain = S.score_candidates(idx, queries, cand, *args)
    got = S.score_in_groups(idx, queries, cand, *args, groups=groups)
    rows = lambda df: sorted((r.query_id, r.id, r.ham, round(r.score, 9)) for r in df.collect())
    assert rows(got) == rows(plain) and got.count() == 31 * 24


def test_many_candidates_take_the_grid(spark, monkeypatch):
    idx = _matrices(spark)
    queries = idx.select(F.col("id").alias("query_id"), F.col("id").alias("self_id"), F.col("code").alias("q_code"), F.col("toks").alias("q_toks"))
    find = lambda: S.two_stage_search(idx, queries, prefetch_limit=9, top_k=3, code_words=1, tok_kind="float", tok_dim=4, exclude_self=True)
    want = sorted(map(tuple, find().collect()))
    monkeypatch.setattr(session, "SHORT_ROWS", 10)
    assert "FlatMapCoGroupsInArrow" in find()._jdf.queryExecution().toString()
    assert sorted(map(tuple, find().collect())) == want


def test_movement_grows_with_the_input():
    moved = []
    for times in (1, 60):
        toks, pairs = 3_000_000 * times, 1_000_000 * times
        q, r = S.score_grid(toks, toks, pairs, 12)
        assert toks / r <= S.GROUP_BYTES and pairs / (q * r) <= 1.1 * S.GROUP_PAIRS
        moved.append(toks * (q + r))
    assert moved[1] < 120 * moved[0] and moved[1] < 6e9
    assert S.score_grid(10**10, 10**5, 10**6, 12)[0] == 1  # few queries: rows move once


def test_blocks_keep_the_precision_of_their_vectors(spark):
    import pyarrow as pa

    vec = pa.array([[[1.0, 2.0]], [], [[0.0, 0.0], [3.0, 4.0]]], pa.list_(pa.list_(pa.float32())))
    blocks, kind = topk._token_blocks(vec, 2)
    assert [len(b) for b in blocks] == [8, 0, 16] and kind == np.float32


def test_cells_do_not_grow_with_shuffle_partitions(spark):
    corpus = spark.range(40000).select("id", F.array("id").alias("vec"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.autoBroadcastJoinThreshold")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        cells = []
        for n in (24, 2400):
            spark.conf.set("spark.sql.shuffle.partitions", str(n))
            c, q = corpus.limit(1).select(*topk.grid(corpus, corpus, 1)).first()
            cells.append(c * q)
        assert cells[0] == cells[1]
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_workers_hold_small_batches(spark, monkeypatch):
    """Blocks of vectors and token matrices reach the workers of a search in batches of bounded bytes, and the session's own limit comes back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    idx, before = _matrices(spark).withColumn("text", F.lit("x")), spark.conf.get(key)
    queries = idx.select(F.col("id").alias("query_id"), F.col("code").alias("q_code"), F.col("toks").alias("q_toks"))
    held, write = [], S.freeze
    monkeypatch.setattr(S, "freeze", lambda df, name="frozen": (held.append((name, spark.conf.get(key))), write(df, name))[1])
    hits = S.two_stage_search(idx, queries, prefetch_limit=9, top_k=3, code_words=1, tok_kind="float", tok_dim=4)
    got = S.fetch_payload(hits, idx, ["text"])
    assert held == [("candidates", f"{8 << 20}b"), ("hits", f"{8 << 20}b")] and spark.conf.get(key) == before
    want = sorted(map(tuple, got.collect()))
    monkeypatch.setattr(session, "ARROW_BYTES", 1 << 10)
    hits = S.two_stage_search(idx, queries, prefetch_limit=9, top_k=3, code_words=1, tok_kind="float", tok_dim=4)
    assert sorted(map(tuple, S.fetch_payload(hits, idx, ["text"]).collect())) == want
    try:  # a smaller limit of the session stays
        spark.conf.set(key, "1k")
        with session.small_batches(spark):
            assert spark.conf.get(key) == "1k"
        monkeypatch.setattr(session, "ARROW_BYTES", 8)
        try:
            with session.small_batches(spark):
                raise KeyError
        except KeyError:
            assert spark.conf.get(key) == "1k"
    finally:
        spark.conf.set(key, before)
