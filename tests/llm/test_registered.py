"""The registered queries against SQL, and the pipeline against its stages run one by one."""

import os

import pytest

import __spark_entry__ as E
from oracle import compare, duck

SF = os.environ.get("SIFTLANE_TEST_SF", "/root/testdata/sf0.001")
SQL = {k: v for k, v in E.oracle_sql().items() if k.startswith("op")}


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_sql(spark, name):
    ok, msg = compare(E.queries()[name](spark, SF), duck(SF), SQL[name])
    assert ok, msg


def test_every_operator_is_registered_once():
    names = [k.split("_")[0] for k in E.queries() if k.startswith("op")]
    assert sorted(names) == sorted(f"op{i}" for i in range(1, 14)) and "pipeline" in E.queries()


def test_pipeline_stages(spark):
    import corpus_pipeline as C

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    ids = {r.doc_id for r in docs.select("doc_id").collect()}
    for name, stage in C.STAGES:
        before = docs
        docs = C.freeze(stage(spark, docs, SF))
        rows = [r.doc_id for r in docs.select("doc_id").collect()]
        assert len(rows) == len(set(rows)) and set(rows) <= ids, name
        ids = set(rows)
        if name != C.STAGES[-1][0]:
            assert docs.schema == before.schema
    assert sorted(map(tuple, C.run(spark, SF).collect())) == sorted(map(tuple, docs.collect()))


def test_pipeline_of_odd_rows(spark, odd_docs, tmp_path):
    import corpus_pipeline as C

    docs = odd_docs.selectExpr("doc_id", "text", "lang", "h as source", "cast(length(text) as long) as n_chars", "words as words", "h as size")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/{t}.parquet")
    out = C.run(spark, str(tmp_path)).collect()
    # 1 and 6 are copies, 3 and 4 go with 2 (no words), 9 with 5, one row of the repeated id stays; rows without an id stay
    assert sorted(-1 if r.doc_id is None else r.doc_id for r in out) == [-1, -1, 1, 2, 5, 7, 8]
    docs.limit(0).write.parquet(f"{tmp_path}/e/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{SF}/{t}.parquet").limit(0).write.parquet(f"{tmp_path}/e/{t}.parquet")
    assert C.run(spark, f"{tmp_path}/e").count() == 0
