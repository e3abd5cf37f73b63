import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from siftlane.llm import queries as Q
from siftlane.llm import topk_search as TK
from siftlane.llm import url_rules as UR

VECTORS = "vec_id long, embedding array<float>, score int"


def brute(vectors, queries, k):
    out = set()
    for q, x in queries.items():
        s = sorted((-sum(a * b for a, b in zip(x, y)), v) for v, y in vectors.items() if v != q)[:k]
        out |= {(q, rank, v, -n) for rank, (n, v) in enumerate(s, 1)}
    return out


@pytest.mark.parametrize("spread", [0.0, 1.0])
def test_top_k_equals_brute_force(spark, spread, monkeypatch):
    monkeypatch.setattr(TK, "BLOCK_ROWS", 64)
    monkeypatch.setattr(TK, "SEED_ROWS", 16)
    r = random.Random(3)
    rows = []
    for i in range(700):
        v = [r.gauss(0, 1) for _ in range(12)]
        n = sum(x * x for x in v) ** 0.5 * (1 if not spread else 2 ** r.randint(0, 6))
        rows.append((i, [x / n for x in v], 0))
    rows += [(1000 + i, rows[0][1], 1) for i in range(60)]  # a hot vector
    rows += [(2000, [0.0] * 12, 1), (2050, [0.0] * 12, 1)]
    df = spark.createDataFrame(rows, VECTORS)
    v = TK.quantise(df)
    ints = {i: [int(np.floor(256 * float(np.float32(x)))) for x in e] for i, e, _ in rows}
    got = {tuple(x) for x in TK.top_k(v.where("vec_id % 50 = 0"), v, 5).collect()}
    assert got == brute(ints, {i: x for i, x in ints.items() if i % 50 == 0}, 5)


def by_rows(rows, asked, k):
    """All pairs: each asked row's k best rows but itself."""
    out = []
    for a, (q, x) in enumerate(rows):
        if asked(q):
            s = sorted((-sum(m * n for m, n in zip(x, y)), v) for b, (v, y) in enumerate(rows) if a != b)[:k]
            out += [(q, rank, v, -n) for rank, (n, v) in enumerate(s, 1)]
    return sorted(out)


@pytest.mark.parametrize("size", [1, 2**14, 2**18])  # products in single and double precision and in integers
def test_top_k_over_many_cells(spark, size, monkeypatch):
    for name, value in {"BLOCK_ROWS": 16, "GROUP_BYTES": 8 * 12 * 64, "QUERY_BYTES": 8 * 12 * 16, "MAX_TASKS": 5, "MAX_RANGES": 3, "SEED_ROWS": 8, "NARROW": 0.3}.items():
        monkeypatch.setattr(TK, name, value)
    r = random.Random(size)
    rows = []
    for i in range(400):
        long = 2.0 ** r.choice((0, 0, -1, -4))
        rows.append((i % 350, [size * long * r.choice((r.gauss(0, 0.3), 1.0, 0.0)) for _ in range(r.choice((12, 12, 12, 5, 1)))]))
    rows += [(7 * i, rows[7][1]) for i in range(90)]  # a hot vector
    v = TK.quantise(spark.createDataFrame([(i, x, 0) for i, x in rows], VECTORS))
    ints = [(i, [int(np.floor(256 * float(np.float32(c)))) for c in x]) for i, x in rows]
    got = sorted(tuple(x) for x in TK.top_k(v.where("vec_id % 7 = 0"), v, 5).collect())
    assert got == by_rows(ints, lambda i: i % 7 == 0, 5)


def test_vectors_stay_off_the_driver(spark, monkeypatch):
    monkeypatch.setattr(TK, "BLOCK_ROWS", 8)
    plans, freeze = [], TK.freeze
    monkeypatch.setattr(TK, "freeze", lambda df, name: plans.append(df._jdf.queryExecution().toString()) or freeze(df, name))
    r = random.Random(4)
    v = TK.quantise(spark.createDataFrame([(i, [r.gauss(0, 1) for _ in range(4)], 0) for i in range(3000)], VECTORS))
    sc = spark.sparkContext
    sc.setJobGroup("top_k", "top_k")
    got = TK.top_k(v.where("vec_id % 50 = 0"), v, 5)
    plans.append(got._jdf.queryExecution().toString())
    assert got.count() == 300
    sc._jsc.clearJobGroup()
    # neither a broadcast of blocks nor a join that may become one, and tasks by bytes and cores rather than by blocks
    assert not [p for p in plans if "Join" in p or "Broadcast" in p]
    stages = [s for j in sc.statusTracker().getJobIdsForGroup("top_k") for s in sc.statusTracker().getJobInfo(j).stageIds]
    tasks = [i.numTasks for i in map(sc.statusTracker().getStageInfo, stages) if i]
    assert tasks and max(tasks) <= 40, max(tasks)  # 375 blocks


def test_top_k_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.5], 0), (1, [1.0, 0.5], 0), (2, None, 0), (3, [1.0, None], 0), (4, [nan, 1.0], 0), (5, [inf, 1.0], 0), (None, [1.0, 1.0], 0), (6, [], 0), (7, [2.0], 0), (0, [1.0, 0.5], 9)]
    v = TK.quantise(spark.createDataFrame(rows, VECTORS))
    got = sorted(tuple(x) for x in TK.top_k(v.where("vec_id = 0"), v, 5).collect())
    # the two rows of id 0 are a query and a candidate each
    assert got == [(0, 1, 7, 131072)] * 2 + [(0, 2, 0, 81920)] * 2 + [(0, 3, 1, 81920)] * 2 + [(0, 4, 6, 0)] * 2
    assert TK.top_k(v.limit(0), v.limit(0), 5).count() == 0


def test_url_rules(spark):
    rules = spark.createDataFrame([*Q.URL_RULES, (None, "x", "/"), ("block", None, "/")], "action string, host string, path string")
    urls = {
        "http://a.example.com/en/1?x": ("a.example.com", "/en/1", "example.com/en/", "block"),
        "https://WWW.Example.com/en/": ("www.example.com", "/en/", "www.example.com/en/", "allow"),
        "http://example.com": ("example.com", "", None, "allow"),
        "http://example.com/de/": ("example.com", "/de/", "com/", "allow"),
        "ftp://x.net/fr/#y": ("x.net", "/fr/", "net/fr/", "block"),
        "http://xnet/fr/": ("xnet", "/fr/", None, "allow"),
        "http://ÉXAMPLE.com/?a://b": ("Éxample.com", "/", "com/", "allow"),
        "no scheme": ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "http:///en/": ("", "/en/", None, "allow"),
        "x\ny://net/es/": ("net", "/es/", "net/es/", "block"),
        None: ("", "", None, "allow"),
    }
    rows = [(i, u, "old", i) for i, u in enumerate(urls)] + [(None, "http://net/es/", "old", 0), (3, "http://example.com/de/", "old", 3)]
    got = UR.judge_urls(spark.createDataFrame(rows, "page_id long, url string, rule string, short int"), rules)
    assert got.count() == len(rows) and "short" in got.columns
    for r in got.where("page_id is not null").collect():
        assert (r.host, r.path, r.rule, r.verdict) == urls[r.url], r
    assert [r.verdict for r in got.where("page_id is null").collect()] == ["block"]
    assert {r.verdict for r in UR.judge_urls(got.select("page_id", "url"), rules.limit(0)).collect()} == {"allow"}
    assert UR.judge_urls(got.select("page_id", "url").limit(0), rules).count() == 0


def test_longest_rule_wins_by_any_prefix(spark):
    rules = spark.createDataFrame([("block", "a.b", "/x"), ("allow", "a.b", "/xyz"), ("block", "b", "")], "action string, host string, path string")
    rows = [(1, "http://a.b/xyzw"), (2, "http://c.a.b/xy"), (3, "http://b"), (4, "http://ab/")]
    got = {r.page_id: (r.rule, r.verdict) for r in UR.judge_urls(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()}
    assert got == {1: ("a.b/xyz", "allow"), 2: ("a.b/x", "block"), 3: ("b", "block"), 4: (None, "allow")}


def test_no_python_in_the_url_plan(spark):
    rules = spark.createDataFrame(Q.URL_RULES, "action string, host string, path string")
    df = spark.range(3).select(F.col("id").alias("page_id"), F.concat(F.lit("http://a/"), "id").alias("url"))
    plan = UR.judge_urls(df, rules)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan


def test_rows_of_one_id_are_all_candidates(spark, monkeypatch, tmp_path):
    from oracle import rows_of_duck, rows_of_spark

    from siftlane.llm.oracle import SQL

    v = TK.quantise(spark.createDataFrame([(0, [1.0, 1.0], 0), (1, [1.0, 0.5], 0), (1, [3.0, 3.0], 0)], VECTORS))
    assert [(r.vec_id, r.score) for r in TK.top_k(v.where("vec_id = 0"), v, 5).orderBy("rank").collect()] == [(1, 393216), (1, 196608 // 2)]
    monkeypatch.setattr(TK, "BLOCK_ROWS", 32)
    r = random.Random(8)
    rows = [(r.choice((50, 100, *range(7))), [r.gauss(0, 2 ** r.randint(0, 4)) for _ in range(5)], 0) for _ in range(400)] + [(50, [9.0] * 5, 0)] * 200
    spark.createDataFrame(rows, VECTORS).write.parquet(f"{tmp_path}/embeddings.parquet")
    import duckdb

    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert rows_of_spark(Q.op1_exact_topk(spark, str(tmp_path))) == rows_of_duck(con, SQL["op1_exact_topk"])


def test_very_long_hosts(spark):
    import time

    host = ".".join(["a"] * 50_000)
    rules = spark.createDataFrame(Q.URL_RULES, "action string, host string, path string")
    df = spark.createDataFrame([(1, f"http://{host}.example.com/en/x"), (2, f"http://{host}.net/fr/"), (3, f"http://{host}")], "page_id long, url string")
    start = time.time()
    got = {r.page_id: (r.rule, r.verdict) for r in UR.judge_urls(df, rules).collect()}
    assert got == {1: ("example.com/en/", "block"), 2: ("net/fr/", "block"), 3: (None, "allow")} and time.time() - start < 30
