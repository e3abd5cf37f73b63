"""Index versions (A3), ingest (E8) and the model plug point."""

import pytest
from pyspark.sql import functions as F

from siftlane.functions import text as T
from siftlane.operators.embed import ArrowModelEmbedder
from siftlane.plans import pipeline as P
from siftlane.sources import index as IX

DOCS = [(1, "Alpha beta.\nGamma delta epsilon."), (2, "Zeta eta theta.\nIota kappa.")]


def test_create_index_semantics(spark, tmp_path):
    root = str(tmp_path / "idx")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    with pytest.raises(FileNotFoundError):
        IX.open_index(spark, root)
    P.ingest(docs, root, recreate=False)
    assert IX.read_index(spark, root).count() == 4
    P.ingest(docs.filter("doc_id = 1"), root, recreate=False)  # present -> no-op
    assert IX.read_index(spark, root).count() == 4
    P.ingest(docs.filter("doc_id = 1"), root, recreate=True)  # replace
    assert IX.read_index(spark, root).count() == 2
    rows = IX.read_index(spark, root)
    assert {"id", "doc_id", "chunk_ix", "chunk_id", "text", "dense", "code", "toks", "n_tokens"} == set(rows.columns)
    P.ingest(docs.limit(0), root)  # an empty index has rows of the same schema
    assert IX.read_index(spark, root).count() == 0 and "code" in IX.read_index(spark, root).columns
    P.ingest_batch(docs, root)
    assert IX.read_index(spark, root).count() == 4


def test_crash_leftovers_block_nothing(spark, tmp_path):
    root = tmp_path / "idx"
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    for table in ("vectors", "payload"):  # a writer that ended before its commit
        (root / table / "_temporary" / "0").mkdir(parents=True)
    P.ingest(docs, str(root))
    P.ingest_batch(docs.limit(1), str(root))
    assert IX.read_index(spark, str(root)).count() == 4


def test_a_second_writer_waits_or_fails(spark, tmp_path, monkeypatch):
    import os
    import threading

    root = str(tmp_path / "idx")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    P.ingest(docs, root)
    more = spark.createDataFrame([(3, "Third."), (4, "Fourth.")], "doc_id long, text string")
    with IX.writer(spark, root):
        with pytest.raises(RuntimeError, match="another writer"):
            P.ingest_batch(more, root)
    assert IX.read_index(spark, root).count() == 4  # nothing lost, nothing half written
    monkeypatch.setattr(IX, "WAIT_SECONDS", 120)
    failed = []

    def upsert(i):
        try:
            P.ingest_batch(more.where(f"doc_id = {i}"), root)
        except Exception as e:  # pragma: no cover
            failed.append(e)

    threads = [threading.Thread(target=upsert, args=(i,)) for i in (3, 4)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert not failed and sorted(r.doc_id for r in IX.read_index(spark, root).select("doc_id").distinct().collect()) == [1, 2, 3, 4]
    (tmp_path / "idx" / "_writer").touch()  # a crashed writer's lock, long ago
    os.utime(tmp_path / "idx" / "_writer", (1, 1))
    monkeypatch.setattr(IX, "WAIT_SECONDS", 0)
    P.ingest_batch(more, root)
    assert IX.read_index(spark, root).count() == 6


def test_malformed_rows_fail(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    idx = P.build_index(docs)
    check = lambda df: IX.check_index(df.drop("x"), 128, 2).collect()
    assert len(check(idx)) == 4
    for c in ("id", "doc_id", "code", "dense"):
        with pytest.raises(Exception, match="wrong shape"):
            check(idx.withColumn(c, F.when(F.col("doc_id") > 1, F.col(c))))
    with pytest.raises(Exception, match="wrong shape"):
        P.build_index(spark.createDataFrame([(None, "text")], "doc_id long, text string")).collect()
    assert [r.text for r in P.build_index(spark.createDataFrame([(1, None)], "doc_id long, text string")).collect()] == [""]


def test_one_long_text_stays_within_a_slice(spark, monkeypatch):
    import tracemalloc

    import pyarrow as pa

    from siftlane.operators import embed as EM

    texts = pa.array([" ".join(f"w{i % 5000}" for i in range(400_000)), None, "", "a b a"] + ["x y z"] * 50)
    whole = EM._hash_batch_for("doc")(texts)
    monkeypatch.setattr(EM, "SLICE_CHARS", 1000)
    assert EM._hash_batch_for("doc")(texts).equals(whole) and EM._codes_for("doc")(texts).equals(whole.field("codes"))
    many = pa.array([" ".join(f"w{(i * j) % 5000}" for i in range(2000)) for j in range(300)])
    peak = {}
    for size in (1 << 30, 1 << 16):
        monkeypatch.setattr(EM, "SLICE_CHARS", size)
        tracemalloc.start()
        EM._codes_for("query")(many)
        peak[size] = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
    assert peak[1 << 16] < peak[1 << 30] / 3


def test_doc_label(spark):
    assert spark.range(1).select(T.doc_label(F.lit(7), "msa-%03d")).first()[0] == "msa-007"


def test_model_embedder_plug_point(spark):
    def toy_model(texts, side):
        """Deterministic stand-in for a model: a token vector per word from a
        seeded generator; queries get one extra marker token (asymmetric)."""
        import zlib

        import numpy as np

        
        dense, toks = [], []
        for t in texts:
            words = t.lower().split() + (["[q]"] if side == "query" else [])
            m = np.array([np.random.default_rng(zlib.crc32(w.encode())).normal(size=8) for w in words]).reshape(-1, 8)
            toks.append(m)
            dense.append(m.sum(axis=0))
        return dense, toks

    emb = ArrowModelEmbedder(toy_model, dense_dim=8, tok_dim=8)
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    idx = P.build_index(docs, emb)
    assert idx.schema["toks"].dataType.simpleString() == "array<array<float>>"
    q = P.encode_queries(spark.createDataFrame([(5, "gamma delta")], "item_id long, text string"), emb)
    assert q.first().q_n_tokens == 3
    hits = P.two_stage(idx, q, prefetch_limit=4, top_k=2, embedder=emb).orderBy("rank").collect()
    assert len(hits) == 2 and hits[0].text == "Gamma delta epsilon."
    dense = P.dense_only(idx, q, top_k=1, embedder=emb).collect()
    assert len(dense) == 1


def test_a_model_is_loaded_once_in_each_worker(spark, tmp_path):
    import os

    from siftlane.operators.embed import LETTER_MODEL, ModelEmbedder, load_letter_model

    folder = str(tmp_path)

    def load():
        import tempfile

        tempfile.mkstemp(prefix=f"load-{os.getpid()}-", dir=folder)
        model = load_letter_model()

        def run(texts, side):
            tempfile.mkstemp(prefix=f"call-{sum(len(t.split()) + 1 for t in texts)}-{len(texts)}-", dir=folder)
            return model(texts, side)

        return run

    emb = ModelEmbedder(load, 8, 8, f"test {folder}", token_budget=40)
    docs = [(i, None if i == 5 else " ".join(["word"] * (i % 30 + (200 if i == 7 else 0)))) for i in range(120)]
    docs = spark.createDataFrame(docs, "doc_id long, text string").repartition(12)
    got = {r.doc_id: r for _ in range(2) for r in P.build_index(docs, emb).collect()}
    plain = {r.doc_id: r for r in P.build_index(docs, LETTER_MODEL).collect()}
    assert got == plain and got[5].n_tokens == 0 and got[5].dense == [0.0] * 8 and got[7].n_tokens == 207
    names = os.listdir(folder)
    loads = [n.split("-")[1] for n in names if n.startswith("load")]
    assert loads and len(loads) == len(set(loads))  # one a process, over 12 partitions, two runs
    calls = [tuple(map(int, n.split("-")[1:3])) for n in names if n.startswith("call")]
    assert all(tokens <= 40 or n == 1 for tokens, n in calls) and max(n for _, n in calls) > 1


def test_model_sides_and_wrong_sizes(spark):
    from siftlane.operators.embed import LETTER_MODEL, ModelEmbedder, load_letter_model

    df = spark.createDataFrame([(1, "Ab 1"), (2, "")], "k long, text string")
    doc, query = (LETTER_MODEL.encode(df, "text", side).orderBy("k").collect() for side in ("doc", "query"))
    assert [r.n_tokens for r in doc] == [2, 0] and [r.n_tokens for r in query] == [3, 1]
    assert query[0].dense == [x + 1 for x in doc[0].dense] and query[1].toks == [[1.0] * 8]
    assert LETTER_MODEL.encode(df.limit(0), "text").count() == 0
    with pytest.raises(Exception, match="must have 9 components"):
        ModelEmbedder(load_letter_model, 9, 8, "wrong").encode(df, "text").collect()


def test_string_query_ids(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    q = P.encode_queries(spark.createDataFrame([("q-b", "gamma delta"), ("q-a", "iota")], "item_id string, text string"))
    hits = P.two_stage(P.build_index(docs), q, prefetch_limit=4, top_k=1).collect()
    assert {h.query_id: h.text for h in hits} == {"q-a": "Iota kappa.", "q-b": "Gamma delta epsilon."}


def test_batch_tokens_and_codes_equal_spark_expressions(spark):
    from siftlane.operators import embed as EM
    from siftlane.sources.tables import read_table

    docs = read_table(spark, "/root/testdata/sf0.001", "documents")
    extra = spark.createDataFrame([(-1, "İstanbul KELVIN K x9Y ÉTÉ çA"), (-2, "")], "doc_id long, text string")
    d = docs.select("doc_id", "text").unionByName(extra)
    out = d.select(
        (F.col("doc_id")),
        EM._codes_udfs["query"](F.col("text")).alias("batch"),
        EM.token_codes(T.words(F.col("text"))).alias("expr"),
    )
    bad = out.filter(~(F.col("batch") == F.col("expr"))).count()
    assert bad == 0


def test_batch_sign_code_equals_binary_code(spark):
    from siftlane.functions import vector as V
    from siftlane.sources.tables import read_table

    q = P.encode_queries(read_table(spark, "/root/testdata/sf0.001", "benchmark"))
    assert q.filter(~(F.col("q_code") == V.binary_code(F.col("q_dense"), 128))).count() == 0


def test_upserts_replace_documents(spark, tmp_path):
    root = str(tmp_path / "idx")
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    P.ingest(docs, root)

    def upsert(*rows):
        P.ingest_batch(spark.createDataFrame(rows, "doc_id long, text string, seq int"), root, seq="seq")
        return sorted((r.doc_id, r.chunk_ix, r.text) for r in IX.read_index(spark, root).collect())

    two = [(2, 0, "Zeta eta theta."), (2, 1, "Iota kappa.")]
    got = upsert((1, "Only one line now.", 1), (3, "New doc.\nTwo lines.", 1), (3, "older\nof\nthree", None))
    assert got == [(1, 0, "Only one line now."), *two, (3, 0, "New doc."), (3, 1, "Two lines.")]
    assert upsert((3, "Changed again.", 5), (3, "late", 4)) == [(1, 0, "Only one line now."), *two, (3, 0, "Changed again.")]
    again = upsert((3, "Changed again.", 5), (3, "late", 4))
    assert again == [(1, 0, "Only one line now."), *two, (3, 0, "Changed again.")]
    q = P.encode_queries(spark.createDataFrame([(5, "changed again")], "item_id long, text string"))
    hits = P.two_stage(IX.read_index(spark, root), q, prefetch_limit=4, top_k=2).collect()
    assert sorted(h.rank for h in hits) == [1, 2]


def _files(root, table):
    return {f: f.stat().st_mtime_ns for f in root.glob(f"{table}/of=*/bucket=*/*.parquet") if "bucket=-1" not in str(f)}


def test_upsert_reads_and_writes_only_its_buckets(spark, tmp_path):
    root = tmp_path / "idx"
    docs = spark.createDataFrame([(i, f"line {i}") for i in range(400)], "doc_id long, text string")
    P.ingest(docs, str(root), bucket_rows=10)
    assert IX.open_index(spark, str(root)).buckets == 40
    old = {t: _files(root, t) for t in ("vectors", "payload")}
    P.ingest_batch(docs.where("doc_id in (7, 8, 9)"), str(root))
    for t, files in old.items():
        new = _files(root, t)
        gone = {f.parent for f in files.keys() - new.keys()}
        assert 1 <= len(gone) <= 3 and {f.parent for f in new.keys() - files.keys()} == gone
        assert all(new[f] == files[f] for f in files.keys() & new.keys())
    assert IX.read_index(spark, str(root)).count() == 400


def _scans(df):
    """(files read, columns read) of every Parquet scan of a run plan."""
    out = []

    def walk(p):
        name = p.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            return walk(p.executedPlan())
        if name.endswith("QueryStageExec"):
            return walk(p.plan())
        if name == "FileSourceScanExec":
            out.append((p.metrics().apply("numFiles").value(), p.requiredSchema().simpleString()))
        children = p.children()
        for i in range(children.size()):
            walk(children.apply(i))

    walk(df._jdf.queryExecution().executedPlan())
    return out


def test_searches_read_only_the_buckets_of_their_rows(spark, tmp_path):
    """The token matrices of the candidates and the texts of the hits: the files read do not grow with the index."""
    from siftlane.operators import search as S
    from siftlane.session import freeze

    read = {}
    for n in (600, 2400):
        root = tmp_path / f"idx{n}"
        docs = spark.createDataFrame([(i, f"line {i} of the table") for i in range(n)], "doc_id long, text string")
        P.ingest(docs, str(root), bucket_rows=10)
        idx = IX.open_index(spark, str(root))
        assert len(_files(root, "vectors")) >= n / 20
        q = freeze(P.encode_queries(spark.createDataFrame([(1, "line 7"), (2, "line 8")], "item_id long, text string")))
        cand = freeze(S.prefetch(idx.vectors, q, 10, 2))
        scored = S.score_candidates(idx.vectors, q, cand, "codes", 128, buckets=idx.buckets)
        plain = S.score_candidates(IX.read_index(spark, str(root)), q, cand, "codes", 128)
        assert sorted(map(str, scored.collect())) == sorted(map(str, plain.select(scored.columns).collect()))
        top = P.two_stage(idx, q, prefetch_limit=10, top_k=2)
        assert top.count() == 4 and len(top.collect()) == 4
        tokens = [f for f, columns in _scans(scored) if "toks" in columns and "q_toks" not in columns]
        texts = [f for f, columns in _scans(top) if "text" in columns]
        assert len(tokens) == len(texts) == 1
        read[n] = tokens[0], texts[0]
    assert all(t <= 20 and p <= 4 for t, p in read.values()), read  # 20 candidates, 4 hits, one file a bucket


def test_string_ids_and_chunk_files_without_numbers(spark, tmp_path):
    import json

    rows = [{"doc_id": "msa-001", "company": "Acme", "chunk_id": f"msa-001-c{i}", "text": f"t{i}"} for i in (0, 12)]
    (tmp_path / "chunks.json").write_text(json.dumps(rows))
    schema = IX.chunk_schema("string", {"company": "string"})
    got = IX.read_json(spark, str(tmp_path / "chunks.json"), schema, multiline=True).orderBy("chunk_ix").collect()
    assert [(r.doc_id, r.chunk_ix, r.company, r.text) for r in got] == [("msa-001", 0, "Acme", "t0"), ("msa-001", 12, "Acme", "t12")]
    with pytest.raises(Exception):  # ids that do not fit the declared type
        IX.read_json(spark, str(tmp_path / "chunks.json"), multiline=True).collect()


def test_json_array_file_and_json_lines(spark, tmp_path):
    import json

    rows = [{"doc_id": 1, "chunk_ix": 0, "chunk_id": "1-c0", "text": "a"},
            {"doc_id": 1, "chunk_ix": 1, "chunk_id": "1-c1", "text": "b\nc"}]
    path = tmp_path / "chunks.json"
    path.write_text(json.dumps(rows, indent=2))
    got = IX.read_json(spark, str(path), multiline=True).orderBy("chunk_ix").collect()
    assert [r.asDict() for r in got] == rows
    out = str(tmp_path / "lines")
    IX.write_json(spark.createDataFrame(got), out)
    back = IX.read_json(spark, out).orderBy("chunk_ix").collect()
    assert [r.asDict() for r in back] == rows


def test_extra_payload_columns(spark):
    docs = spark.createDataFrame([(1, "Alpha beta gamma.", "Acme"), (2, "Delta epsilon.", "Globex")],
                                 "doc_id long, text string, company string")
    idx = P.build_index(docs, keep=["company"])
    q = P.encode_queries(spark.createDataFrame([(9, "alpha gamma")], "item_id long, text string"))
    hits = P.two_stage(idx, q, 2, 1, payload=["chunk_id", "company", "text"]).collect()
    assert [(h.chunk_id, h.company) for h in hits] == [("1-c0", "Acme")]
