"""Plan guards: no pair-emitting joins anywhere, and the code scan reads only
the columns it needs."""

import pytest

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in E.queries() if n[0] == "q"))
def test_no_cartesian_or_nested_loop_join(spark, name):
    plan = _plan(E.queries()[name](spark, SF))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan


def test_scans_of_a_search_read_only_what_they_need(spark):
    import re

    plan = E.queries()["q28_text_dense_only"](spark, SF)._jdf.queryExecution().toString()
    assert not re.search(r"ReadSchema: struct<[^\n]*(toks|dense|text)", plan)
    from siftlane.operators.search import prefetch
    from siftlane.plans import text_queries as TQ

    cand = prefetch(TQ._index(spark, SF).vectors, TQ._queries(spark, SF), 10, 2)
    assert "ReadSchema: struct<doc_id:bigint,chunk_ix:int,code:array<bigint>>" in _plan(cand)


def test_a_search_plan_runs_no_job(spark):
    from siftlane.operators.search import dense_only_search, prefetch
    from siftlane.plans import text_queries as TQ

    index, queries = TQ._index(spark, SF).vectors, TQ._queries(spark, SF)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    prefetch(index, queries, 10, 2)
    dense_only_search(index, queries, top_k=3, dim=128)
    jobs = tracker.getJobIdsForGroup("planning")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert list(jobs) == []


def test_operators_do_not_collect():
    import pathlib

    import siftlane.operators as ops

    for f in pathlib.Path(ops.__file__).parent.glob("*.py"):
        code = f.read_text()
        assert not any(x in code for x in (".toArrow(", ".collect(", ".toPandas(", "inputFiles(", ".rdd", ".count()")), f


def test_small_candidates_leave_the_token_scan_in_place(spark):
    from siftlane.operators.search import score_candidates
    from siftlane.plans import text_queries as TQ
    from siftlane.session import freeze
    from siftlane.operators.search import prefetch

    index, queries = TQ._index(spark, SF).vectors, TQ._queries(spark, SF)
    cand = freeze(prefetch(index, queries, 10, 2))
    plan = _plan(score_candidates(index, queries, cand, "codes", 128))
    assert plan.count("BroadcastHashJoin") == 2 and "SortMergeJoin" not in plan
