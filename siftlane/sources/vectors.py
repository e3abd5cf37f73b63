"""Index and query tables derived from a table of vectors
(``vec_id BIGINT, embedding ARRAY<FLOAT>``).

* ``vector_index``: one row per vector (single-vector search).
* ``matrix_index``: ``group`` consecutive vectors form one item's token
  matrix; its dense vector is the element-wise sum of the tokens and its code
  the sign bits of that sum.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import vector as V


def vector_dim(vectors: DataFrame, col: str = "embedding") -> int:
    """Dimension of a vector column; fails unless every row has the same one."""
    row = vectors.select(F.min(F.size(col)).alias("lo"), F.max(F.size(col)).alias("hi")).first()
    if row["lo"] != row["hi"]:
        raise ValueError(f"{col} has mixed dimensions {row['lo']}..{row['hi']}")
    return int(row["hi"] or 0)


def vector_index(vectors: DataFrame, dim: int) -> DataFrame:
    return vectors.select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("embedding").alias("dense"),
        V.binary_code(F.col("embedding"), dim).alias("code"),
    )


def matrix_index(vectors: DataFrame, dim: int, group: int = 5) -> DataFrame:
    grouped = vectors.groupBy(F.expr(f"vec_id div {group}").alias("id")).agg(
        F.array_sort(F.collect_list(F.struct("vec_id", "embedding"))).alias("_rows")
    )
    toks = F.transform("_rows", lambda r: r["embedding"])
    return (
        grouped.select("id", toks.alias("toks"))
        .withColumn("dense", V.sum_vectors("toks", dim))
        .withColumn("code", V.binary_code(F.col("dense"), dim))
    )


def as_queries(index: DataFrame) -> DataFrame:
    """Every index row becomes a query that must not match itself."""
    return index.select(
        F.col("id").alias("query_id"),
        F.col("id").alias("self_id"),
        *[F.col(c).alias(f"q_{c}") for c in ("code", "dense", "toks") if c in index.columns],
    )
