"""Streaming ingest and search give the same rows as the batch jobs."""

from pyspark.sql import functions as F

from siftlane.plans import pipeline as P
from siftlane.sources import index as IX
from siftlane.streaming.jobs import start_index_stream, start_search_stream

DOCS1 = [(1, "Alpha beta gamma delta.\nThe client owns all deliverables here."), (2, "Liability is capped at fees paid.")]
DOCS2 = [(2, "Liability is capped at twice the fees paid.\nNew line about termination."), (3, "Fresh document text.")]
QUERIES = [(7, "who owns the deliverables"), (8, "liability cap on fees")]


def test_index_stream_upserts_and_is_idempotent(spark, tmp_path):
    src, root, ck = str(tmp_path / "src"), str(tmp_path / "index"), str(tmp_path / "ck")
    spark.createDataFrame(DOCS1, "doc_id long, text string").write.parquet(f"{src}/a")
    q = start_index_stream(spark, f"{src}/*", root, ck)
    q.awaitTermination()
    spark.createDataFrame(DOCS2, "doc_id long, text string").write.parquet(f"{src}/b")
    q = start_index_stream(spark, f"{src}/*", root, ck)
    q.awaitTermination()
    got = sorted((r.doc_id, r.chunk_ix, r.text) for r in IX.read_index(spark, root).collect())
    merged = {1: DOCS1[0][1], 2: DOCS2[0][1], 3: DOCS2[1][1]}
    want = sorted((d, i, line) for d, t in merged.items() for i, line in enumerate(t.split("\n")))
    assert got == want
    state = {f: f.stat().st_mtime_ns for f in tmp_path.glob("index/*/of=*/*/*.parquet")}
    q = start_index_stream(spark, f"{src}/*", root, ck)  # nothing new: nothing written
    q.awaitTermination()
    assert state and {f: f.stat().st_mtime_ns for f in tmp_path.glob("index/*/of=*/*/*.parquet")} == state
    from siftlane.streaming.jobs import index_batch
    retry = spark.createDataFrame(DOCS2 + DOCS2[:1], "doc_id long, text string")
    index_batch(retry, 1, root)  # a retried batch, with a repeated document: the same rows
    assert sorted((r.doc_id, r.chunk_ix, r.text) for r in IX.read_index(spark, root).collect()) == want

    qsrc, out, ck2 = str(tmp_path / "q"), str(tmp_path / "hits"), str(tmp_path / "ck2")
    spark.createDataFrame(QUERIES, "item_id long, text string").write.parquet(qsrc)
    s = start_search_stream(spark, qsrc, root, out, ck2, prefetch_limit=4, top_k=2)
    s.awaitTermination()
    streamed = sorted((r.query_id, r.rank, tuple(r.id), r.score) for r in spark.read.parquet(out).collect())
    qs = P.encode_queries(spark.createDataFrame(QUERIES, "item_id long, text string"))
    batch = P.two_stage(IX.read_index(spark, root), qs, 4, 2)
    assert streamed == sorted((r.query_id, r.rank, tuple(r.id), r.score) for r in batch.collect())
    assert spark.read.parquet(out).select(F.countDistinct("query_id")).first()[0] == 2
