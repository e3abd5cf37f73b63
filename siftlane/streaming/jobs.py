"""Structured Streaming forms of ingest (A4 incremental) and search.

Both read new Parquet files from a folder with a fixed schema and process each
micro-batch with ``foreachBatch``; the streaming checkpoint records which
files were consumed, so a restarted query resumes where it stopped.  Neither
needs a watermark: there is no event-time aggregation, and all state lives in
the written tables.

* ``start_index_stream``: of every micro-batch of documents, the latest row of
  each doc_id is chunked, embedded and upserted into the index.  A retried
  batch gives the same index, so the sink is idempotent.
* ``start_search_stream``: every micro-batch of queries is one bounded query
  block for the two-stage search against the index as it is then; hits are
  written to ``out_dir/batch=<id>`` (overwritten on retry).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..plans import pipeline as P
from ..session import freeze
from ..sources import index as IX

DOC_SCHEMA = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())])
QUERY_SCHEMA = T.StructType([T.StructField("item_id", T.LongType()), T.StructField("text", T.StringType())])


def index_batch(batch: DataFrame, batch_id: int, root: str, embedder=P.DEFAULT_EMBEDDER) -> None:
    """One micro-batch: an upsert of its documents (an empty one writes nothing)."""
    if not batch.isEmpty():
        P.ingest_batch(batch, root, embedder)


def start_index_stream(spark: SparkSession, source_dir: str, root: str, checkpoint: str,
                       available_now: bool = True, schema: T.StructType = DOC_SCHEMA) -> StreamingQuery:
    stream = spark.readStream.schema(schema).parquet(source_dir)
    writer = stream.writeStream.foreachBatch(lambda df, bid: index_batch(df, bid, root)).option(
        "checkpointLocation", checkpoint
    )
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="30 seconds")
    return writer.start()


def search_batch(batch: DataFrame, batch_id: int, root: str, out_dir: str, prefetch_limit: int, top_k: int,
                 embedder=P.DEFAULT_EMBEDDER) -> None:
    spark = batch.sparkSession
    index = IX.open_index(spark, root)
    queries = freeze(P.encode_queries(batch, embedder), "queries")
    hits = P.two_stage(index, queries, prefetch_limit, top_k, embedder)
    hits.write.mode("overwrite").parquet(f"{out_dir.rstrip('/')}/batch={batch_id}")


def start_search_stream(spark: SparkSession, queries_dir: str, root: str, out_dir: str, checkpoint: str,
                        prefetch_limit: int = 100, top_k: int = 5, available_now: bool = True,
                        schema: T.StructType = QUERY_SCHEMA) -> StreamingQuery:
    stream = spark.readStream.schema(schema).parquet(queries_dir)
    writer = stream.writeStream.foreachBatch(
        lambda df, bid: search_batch(df, bid, root, out_dir, prefetch_limit, top_k)
    ).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="10 seconds")
    return writer.start()
