"""An index is written from texts: vectors are stored once and never staged."""

import pytest
from pyspark.sql import functions as F

from siftlane.plans import pipeline as P
from siftlane.sources import index as IX

DOCS = [(i, f"Alpha {i} beta.\nGamma delta {i % 7}.", "x") for i in range(60)]


def _docs(spark, rows=DOCS):
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_no_vectors_are_staged(spark, tmp_path, monkeypatch):
    staged = []
    for mod in (IX, P):
        real = getattr(mod, "freeze", None)
        monkeypatch.setattr(mod, "freeze", lambda df, name="", real=real or IX.freeze: staged.append(df.columns) or real(df, name), raising=False)
    root = str(tmp_path / "idx")
    P.ingest(_docs(spark), root, keep=["source"], bucket_rows=20)
    P.ingest_batch(_docs(spark, [(3, "Changed.", "y"), (99, "New.\nTwo.", "y")]), root, keep=["source"])
    P.corpus_index(spark, _docs(spark), str(tmp_path), keep=["source"])
    assert not any("toks" in c or "dense" in c for c in staged)
    rows = IX.read_index(spark, root)
    assert rows.count() == 60 * 2 - 1 + 2 and rows.select("doc_id", "chunk_ix").distinct().count() == rows.count()
    plain = P.build_index(_docs(spark, [r for r in DOCS if r[0] != 3] + [(3, "Changed.", "y"), (99, "New.\nTwo.", "y")]), keep=["source"])
    cols = ["doc_id", "chunk_ix", "chunk_id", "text", "source", "dense", "code", "toks", "n_tokens"]
    assert rows.select(cols).exceptAll(plain.select(cols)).count() == 0


def test_many_small_batches_do_not_leave_many_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(IX, "FILES_PER_BUCKET", 3)
    root = str(tmp_path / "idx")
    P.ingest(_docs(spark), root)
    for i in range(5):
        P.ingest_batch(_docs(spark, [(i, f"batch {i}", "y")]), root)
    assert len(IX.open_index(spark, root).vectors.inputFiles()) <= 6
    got = {(r.doc_id, r.chunk_ix): r.text for r in IX.read_index(spark, root).collect()}
    assert len(got) == 5 + 55 * 2 and all(got[i, 0] == f"batch {i}" for i in range(5))


def test_a_document_without_id_is_not_written(spark, tmp_path):
    root = str(tmp_path / "idx")
    with pytest.raises(Exception, match="wrong shape"):
        P.write_index(_docs(spark).withColumn("doc_id", F.when(F.col("doc_id") > 5, F.col("doc_id"))), root)
    assert not IX.is_index(spark, root)
