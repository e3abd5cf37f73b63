"""Property test: the block scan equals brute force, including heavy ties."""

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from siftlane.functions import vector as V
from siftlane.operators.topk import scan_top_k


@settings(max_examples=6, deadline=None)
@given(
    n=st.integers(min_value=1, max_value=60),
    nq=st.integers(min_value=1, max_value=5),
    k=st.integers(min_value=1, max_value=12),
    dim=st.sampled_from([3, 64, 70]),
    parts=st.integers(min_value=1, max_value=4),
    seed=st.integers(min_value=0, max_value=10_000),
)
def test_scan_equals_brute_force(spark, n, nq, k, dim, parts, seed):
    rng = np.random.default_rng(seed)
    corpus = rng.integers(-1, 2, size=(n, dim)).astype(float)  # many exact ties
    ids = rng.permutation(10 * n)[:n]
    rows = [(int(i), v.tolist()) for i, v in zip(ids, corpus)]
    idx = spark.createDataFrame(rows, "id long, dense array<double>").repartition(parts)
    idx = idx.withColumn("code", V.binary_code(F.col("dense"), dim))
    queries = rng.integers(-1, 2, size=(nq, dim)).astype(float)
    q = spark.createDataFrame([(j, v.tolist()) for j, v in enumerate(queries)], "query_id long, q_dense array<double>")
    q = q.withColumn("q_code", V.binary_code(F.col("q_dense"), dim))
    words = V.n_words(dim)
    ham = scan_top_k(idx, q, k=k, mode="hamming", width=words).collect()
    cos = scan_top_k(idx, q, k=k, mode="cosine", width=dim, vec_col="dense", q_vec="q_dense").collect()
    cb = corpus > 0
    norms = np.linalg.norm(corpus, axis=1)
    for j in range(nq):
        h = (cb != (queries[j] > 0)).sum(axis=1)
        want = sorted(range(n), key=lambda i: (h[i], ids[i]))[:k]
        got = [r.id for r in sorted((r for r in ham if r.query_id == j), key=lambda r: r.rank)]
        assert got == [int(ids[i]) for i in want]
        qn = np.linalg.norm(queries[j])
        c = np.where(norms * qn > 0, corpus @ queries[j] / np.where(norms * qn > 0, norms * qn, 1), 0.0)
        want = sorted(range(n), key=lambda i: (-round(c[i], 6), ids[i]))[:k]
        got = [r.id for r in sorted((r for r in cos if r.query_id == j), key=lambda r: r.rank)]
        assert got == [int(ids[i]) for i in want]
