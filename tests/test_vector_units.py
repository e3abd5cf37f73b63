"""Unit literals and invariants for codes, MaxSim, top-k and cost."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftlane.functions import vector as V
from siftlane.operators import search as S
from siftlane.operators.topk import scan_top_k
from siftlane.plans import reports as R


def _one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


def _mat(rows):
    return F.array(*[F.array(*[F.lit(float(x)) for x in r]) for r in rows])


def test_maxsim_literal(spark):
    q = _mat([[1, 0], [0, 1]])
    d = _mat([[1, 0], [0.5, 0.5]])
    assert _one(spark, V.maxsim(q, d, normalize_tokens=False)) == pytest.approx(1.5)


def test_maxsim_duplicate_doc_token(spark):
    q = _mat([[1, 0], [0, 1]])
    d = _mat([[1, 0], [0.5, 0.5], [0.5, 0.5]])
    assert _one(spark, V.maxsim(q, d, normalize_tokens=False)) == pytest.approx(1.5)


def test_maxsim_permutation_invariant(spark):
    rng = np.random.default_rng(3)
    q = rng.normal(size=(4, 8)); d = rng.normal(size=(6, 8))
    a = _one(spark, V.maxsim(_mat(q), _mat(d)))
    b = _one(spark, V.maxsim(_mat(q), _mat(d[::-1])))
    qn = q / np.linalg.norm(q, axis=1, keepdims=True); dn = d / np.linalg.norm(d, axis=1, keepdims=True)
    assert a == pytest.approx(b)
    assert a == pytest.approx(float((qn @ dn.T).max(axis=1).sum()))


def test_maxsim_codes_matches_float(spark):
    rng = np.random.default_rng(5)
    qs = rng.integers(0, 2, size=(3, 128)); ds = rng.integers(0, 2, size=(5, 128))

    def pack(bits):
        return [int(np.int64(np.uint64(sum(int(b) << i for i, b in enumerate(bits[w * 64:(w + 1) * 64]))))) for w in range(2)]

    qc = F.array(*[F.array(*[F.lit(x).cast("long") for x in pack(r)]) for r in qs])
    dc = F.array(*[F.array(*[F.lit(x).cast("long") for x in pack(r)]) for r in ds])
    got = _one(spark, V.maxsim_codes(qc, dc, 128))
    qf = (2 * qs - 1) / np.sqrt(128); df = (2 * ds - 1) / np.sqrt(128)
    assert got == pytest.approx(float((qf @ df.T).max(axis=1).sum()), abs=1e-12)


def test_code_is_scale_invariant(spark):
    v = [0.5, -1.0, 0.0, 2.0] * 20
    a = _one(spark, V.binary_code(F.array(*[F.lit(x) for x in v]), len(v)))
    b = _one(spark, V.binary_code(F.array(*[F.lit(3.0 * x) for x in v]), len(v)))
    assert a == b and len(a) == 2
    bits = [(a[i // 64] >> (i % 64)) & 1 for i in range(len(v))]
    assert bits == [1 if x > 0 else 0 for x in v]


def test_zero_vector_normalizes_to_zero(spark):
    assert _one(spark, V.normalize(F.array(F.lit(0.0), F.lit(0.0)))) == [0.0, 0.0]
    assert _one(spark, V.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))) == 0.0


def _index(spark, vecs):
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(vecs)]
    df = spark.createDataFrame(rows, "id long, dense array<double>")
    return df.withColumn("code", V.binary_code(F.col("dense"), len(vecs[0])))


def test_scan_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(11)
    corpus = rng.normal(size=(300, 70)); queries = rng.normal(size=(7, 70))
    idx = _index(spark, corpus).repartition(5)
    q = _index(spark, queries).select(F.col("id").alias("query_id"), F.col("code").alias("q_code"),
                                      F.col("dense").alias("q_dense"))
    got = scan_top_k(idx, q, k=9, mode="hamming", width=2, vec_col="code", q_vec="q_code").collect()
    cb = corpus > 0; qb = queries > 0
    for qi in range(7):
        ham = (cb != qb[qi]).sum(axis=1)
        want = sorted(range(300), key=lambda j: (ham[j], j))[:9]
        mine = [r.id for r in sorted((r for r in got if r.query_id == qi), key=lambda r: r.rank)]
        assert mine == want
    got = scan_top_k(idx, q, k=4, mode="cosine", width=70, vec_col="dense", q_vec="q_dense").collect()
    cn = corpus / np.linalg.norm(corpus, axis=1, keepdims=True)
    for qi in range(7):
        cs = cn @ (queries[qi] / np.linalg.norm(queries[qi]))
        want = sorted(range(300), key=lambda j: (-round(cs[j], 6), j))[:4]
        mine = [r.id for r in sorted((r for r in got if r.query_id == qi), key=lambda r: r.rank)]
        assert mine == want


def test_ties_prefer_smaller_id(spark):
    idx = _index(spark, [[1.0, 1.0]] * 4).repartition(3)
    q = idx.select(F.lit(0).cast("long").alias("query_id"), F.col("code").alias("q_code")).limit(1)
    got = scan_top_k(idx, q, k=2, mode="hamming", width=1).orderBy("rank").collect()
    assert [r.id for r in got] == [0, 1]


def _float_index(spark, mats):
    rows = [(i, [[float(x) for x in t] for t in m]) for i, m in enumerate(mats)]
    df = spark.createDataFrame(rows, "id long, toks array<array<double>>")
    dim = len(mats[0][0])
    return df.withColumn("dense", V.sum_vectors("toks", dim)).withColumn("code", V.binary_code(F.col("dense"), dim))


def _queries_of(idx):
    return idx.select(F.col("id").alias("query_id"), F.col("id").alias("self_id"), F.col("code").alias("q_code"),
                      F.col("toks").alias("q_toks"), F.col("dense").alias("q_dense"))


def test_prefetch_limit_below_top_k(spark):
    rng = np.random.default_rng(2)
    idx = _float_index(spark, rng.normal(size=(20, 3, 8)))
    out = S.two_stage_search(idx, _queries_of(idx).filter("query_id = 0"), prefetch_limit=2, top_k=5,
                             code_words=1, tok_kind="float", tok_dim=8)
    assert out.count() == 2


def test_full_limit_equals_exhaustive_maxsim(spark):
    rng = np.random.default_rng(4)
    mats = rng.normal(size=(25, 3, 8))
    idx = _float_index(spark, mats)
    out = S.two_stage_search(idx, _queries_of(idx), prefetch_limit=25, top_k=3, code_words=1,
                             tok_kind="float", tok_dim=8, exclude_self=True).collect()
    unit = mats / np.linalg.norm(mats, axis=2, keepdims=True)
    for qi in range(25):
        sc = {j: round(float((unit[qi] @ unit[j].T).max(axis=1).sum()), 6) for j in range(25) if j != qi}
        want = sorted(sc, key=lambda j: (-sc[j], j))[:3]
        mine = [r.id for r in sorted((r for r in out if r.query_id == qi), key=lambda r: r.rank)]
        assert mine == want


def test_sweep_ceiling_is_reference_and_empty_corpus(spark):
    rng = np.random.default_rng(8)
    idx = _float_index(spark, rng.normal(size=(30, 2, 8)))
    rows = R.limit_sweep(idx, _queries_of(idx), code_words=1, tok_kind="float", tok_dim=8,
                         limits=(5, 40), exclude_self=True).orderBy("prefetch_limit").collect()
    assert rows[-1].match_status == "100% (Reference)" and rows[-1].matches == 30
    empty = idx.filter("id < 0")
    rows = R.limit_sweep(empty, _queries_of(idx), code_words=1, tok_kind="float", tok_dim=8,
                         limits=(5, 40)).orderBy("prefetch_limit").collect()
    assert [r.matches for r in rows] == [30, 30]  # null top-1 vs null counts as a match


def test_cost_literals(spark):
    t = spark.createDataFrame([(1000, 604.0, 199.0)], "n_queries long, standard_tokens double, optimized_tokens double")
    r = R.cost_table(t).first()
    assert (round(r.standard_usd, 6), round(r.optimized_usd, 6), round(r.savings_usd, 6)) == (1.812, 0.597, 1.215)
    assert round(r.savings_pct, 2) == 67.05


def test_vector_bytes(spark):
    idx = spark.createDataFrame([([0.0] * 384,)], "dense array<float>")
    r = R.footprint(idx).first()
    assert (r.full_precision_bytes, r.binary_quantized_bytes, r.compression_ratio) == (1536, 48.0, 32.0)


def test_arrow_and_hof_maxsim_agree(spark):
    from siftlane.functions import maxsim_arrow as MA

    rng = np.random.default_rng(9)
    rows = []
    for i in range(40):
        nq, nd = int(rng.integers(0, 5)), int(rng.integers(0, 6))
        rows.append((i, rng.normal(size=(nq, 16)).tolist(), rng.normal(size=(nd, 16)).tolist(),
                     rng.integers(-2**62, 2**62, size=(nq, 2)).tolist(), rng.integers(-2**62, 2**62, size=(nd, 2)).tolist()))
    df = spark.createDataFrame(rows, "i int, q array<array<double>>, d array<array<double>>, "
                                     "qc array<array<long>>, dc array<array<long>>").repartition(3)
    out = df.select(
        V.maxsim("q", "d").alias("h1"), MA.maxsim("q", "d").alias("a1"),
        V.maxsim("q", "d", normalize_tokens=False).alias("h2"), MA.maxsim("q", "d", normalize_tokens=False).alias("a2"),
        V.maxsim_codes("qc", "dc", 128).alias("h3"), MA.maxsim_codes("qc", "dc", 128).alias("a3"),
    ).collect()
    for r in out:
        assert r.h1 == pytest.approx(r.a1, abs=1e-9) and r.h2 == pytest.approx(r.a2, abs=1e-9)
        assert r.h3 == r.a3


def test_self_matches_are_excluded(spark):
    rng = np.random.default_rng(12)
    corpus = rng.normal(size=(50, 64))
    idx = _index(spark, corpus)
    q = idx.select(F.col("id").alias("query_id"), F.col("code").alias("q_code"), F.col("id").alias("self_id"))
    got = scan_top_k(idx, q, k=3, mode="hamming", width=1, q_self="self_id").collect()
    cb = corpus > 0
    for qi in (0, 17, 49):
        ham = (cb != cb[qi]).sum(axis=1)
        want = sorted((j for j in range(50) if j != qi), key=lambda j: (ham[j], j))[:3]
        assert [r.id for r in sorted((r for r in got if r.query_id == qi), key=lambda r: r.rank)] == want


def test_block_sizes_and_joins_change_nothing(spark, monkeypatch):
    from siftlane.operators import topk

    rng = np.random.default_rng(31)
    corpus = rng.integers(0, 2, size=(120, 64)) * 2.0 - 1
    idx = _index(spark, corpus).repartition(4)
    q = idx.select(F.col("id").alias("query_id"), F.col("code").alias("q_code"))
    key = lambda df: sorted((r.query_id, r.rank, r.id, r.value) for r in df.collect())
    whole = key(scan_top_k(idx, q, k=5, mode="hamming", width=1))
    monkeypatch.setattr(topk, "MAX_STATE_CELLS", 50)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 7)
    monkeypatch.setattr(topk, "QUERY_ROWS", 3)
    monkeypatch.setattr(topk, "_STRIP", 2)
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    try:
        for t in (threshold, "-1"):  # queries broadcast, and shuffled
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", t)
            assert key(scan_top_k(idx, q, k=5, mode="hamming", width=1, cells=3)) == whole and len(whole) == 600
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_half_way_cosines_rank_alike_in_part_and_whole():
    from siftlane.operators.topk import cosine_keys

    rng = np.random.default_rng(2)
    x = rng.integers(-9, 10, size=(400, 3)).astype(float)
    keys = cosine_keys(x, x)
    assert keys.dtype == np.int32 and (keys == keys.T).all()
    assert (cosine_keys(x[5:6], x)[0] == keys[5]).all()


def test_rows_that_cannot_be_searched_fail(spark):
    good = _index(spark, [[1.0, -1.0]] * 3)
    q = good.select(F.col("id").alias("query_id"), F.col("code").alias("q_code"))
    for bad in (good.withColumn("code", F.when(F.col("id") > 0, F.col("code"))), good.withColumn("id", F.when(F.col("id") > 0, F.col("id"))),
                good.withColumn("code", F.array_append("code", F.lit(1).cast("long")))):
        with pytest.raises(Exception, match="cannot be searched|components"):
            scan_top_k(bad, q, k=1, mode="hamming", width=1).collect()


def test_selection_takes_less_time_than_scoring():
    import time

    import pyarrow as pa

    from siftlane.operators.topk import RunningTopK, hamming_keys

    rng = np.random.default_rng(0)
    for n_q, k, rows in ((200, 100, 200_000), (2000, 500, 40_000)):
        q, c = (rng.integers(-2**63, 2**63 - 1, size=(n, 2)) for n in (n_q, rows))
        top, score, select = RunningTopK(n_q, k), 0.0, 0.0
        for at in range(0, rows, 16384):
            ids = pa.array(np.arange(at, min(rows, at + 16384)))
            for s in range(0, n_q, 64):
                t0 = time.process_time()
                keys = hamming_keys(q[s : s + 64], c[at : at + 16384])
                t1 = time.process_time()
                top.add(s, keys, ids)
                score, select = score + t1 - t0, select + time.process_time() - t1
        print(n_q, k, round(score, 2), round(select, 2))
        assert len(top.compact()[0]) == n_q * k
        assert select < 3 * score  # at this size the first block, which has no threshold yet, weighs most
