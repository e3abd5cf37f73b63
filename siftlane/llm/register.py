"""What the driver contract lists of this subpackage: ``opN_<name>`` and ``pipeline``."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import oracle, queries as Q


def _pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    ops = {n: getattr(Q, n) for n in dir(Q) if n[:2] == "op" and n[2:3].isdigit()}
    return {**ops, "pipeline": _pipeline}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
