"""Registered queries over ``documents``, ``benchmark`` and
``conversations`` (q07-q21, q24-q28).

Corpus: every line of every document is a chunk (the driver's documents
hold sections one per line).  Queries: every ``benchmark`` item.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import vector as V
from ..operators import chunk as CH
from ..operators.embed import LETTER_MODEL, token_codes
from ..session import freeze, scratch_path, spread
from ..sources import index as IX
from ..sources.tables import read_table
from . import pipeline as P
from . import reports as R

# Fixed parameters of the registered queries (the reference's defaults).
PREFETCH_LIMIT = 100
TOP_K = 3
ISOLATE_TOP_N = 2
PROMPT_TOP_N = 1


def _docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spread(read_table(spark, sf_dir, "documents"))


def _stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents as they are stored, for an index, which deals them out itself."""
    return read_table(spark, sf_dir, "documents")


def _chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CH.documents_to_chunks(_docs(spark, sf_dir))


def _index(spark: SparkSession, sf_dir: str) -> IX.StoredIndex:
    """The index of all documents, each chunk with its document's source."""
    return P.corpus_index(spark, _stored(spark, sf_dir), f"{sf_dir.rstrip('/')}/documents.parquet", keep=["source"])


def _queries(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The encoded query table, written once and read by every stage that needs it."""
    return freeze(P.encode_queries(read_table(spark, sf_dir, "benchmark")))


def _two_stage(spark, sf_dir, queries=None, payload=None):
    queries = _queries(spark, sf_dir) if queries is None else queries
    return P.two_stage(_index(spark, sf_dir), queries, PREFETCH_LIMIT, TOP_K, payload=payload)


LABELLED = ["doc_id", "chunk_ix", "chunk_id", "source"]


def q07_sections_to_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _chunks(spark, sf_dir).select("doc_id", "chunk_ix", "chunk_id", "text")


def q08_assemble_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = CH.assemble_documents(_chunks(spark, sf_dir), separator="\n\n")
    return docs.select("doc_id", F.size("sections").alias("n_sections"), "text")


def q09_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = _chunks(spark, sf_dir)
    return c.select("doc_id", "chunk_ix", F.posexplode(T.split_sentences(F.col("text"))).alias("sent_ix", "sentence")).select(
        "doc_id", "chunk_ix", F.col("sent_ix").cast("int").alias("sent_ix"), "sentence"
    )


def q10_sentence_fallback(spark: SparkSession, sf_dir: str) -> DataFrame:
    return CH.sentence_rows(_docs(spark, sf_dir), "text", keep=["doc_id"])


def q11_corpus_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _docs(spark, sf_dir).withColumn("sections", CH.split_sections("text"))
    return R.corpus_stats(docs)


def q12_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = _docs(spark, sf_dir)
    return d.select("doc_id", T.count_tokens(F.col("text")).alias("n_tokens"),
                    T.word_count(F.col("text")).alias("n_words"))


def _u32(word, upper: bool):
    return F.shiftrightunsigned(word, 32) if upper else word.bitwiseAND(F.lit(0xFFFFFFFF))


def q13_hash_token_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = read_table(spark, sf_dir, "benchmark")
    toks = b.select("item_id", F.posexplode(T.words(F.col("text"))).alias("tok_ix", "token"))
    c = toks.withColumn("c", token_codes(F.array(F.col("token"))).getItem(0))
    return c.select(
        "item_id", F.col("tok_ix").cast("int").alias("tok_ix"), "token",
        V.popcount(F.col("c")).alias("n_set_bits"),
        _u32(F.col("c")[0], False).alias("w0_lo"), _u32(F.col("c")[0], True).alias("w0_hi"),
        _u32(F.col("c")[1], False).alias("w1_lo"), _u32(F.col("c")[1], True).alias("w1_hi"),
    )


def q14_hash_dense_embedding(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _queries(spark, sf_dir)
    bits = F.transform(
        F.sequence(F.lit(0), F.lit(P.DEFAULT_EMBEDDER.dense_dim - 1)),
        lambda i: F.call_function("shiftright", F.element_at("q_code", (i / 64).cast("int") + 1), i % 64).bitwiseAND(F.lit(1)),
    )
    return q.select(
        F.col("query_id").alias("item_id"),
        F.posexplode(F.arrays_zip(F.col("q_dense").alias("v"), bits.alias("b"))).alias("dim", "z"),
    ).select("item_id", F.col("dim").cast("int").alias("dim"), F.col("z.v").cast("double").alias("value"),
             F.col("z.b").cast("int").alias("bit"))


def _hex(word):
    return F.lpad(F.lower(F.hex(word)), 16, "0")


def _index_rows(idx: DataFrame) -> DataFrame:
    """Every stored value: the code's words, the dense vector, and a digest of all token codes in order."""
    toks = F.transform("toks", lambda t: F.concat(_hex(t[0]), _hex(t[1])))
    return idx.select(
        "doc_id", "chunk_ix", "chunk_id", F.col("n_tokens").cast("int").alias("n_tokens"), F.size("toks").alias("n_distinct_tokens"),
        F.concat(_hex(F.col("code")[0]), _hex(F.col("code")[1])).alias("code"),
        F.array_join(F.transform("dense", lambda x: x.cast("int").cast("string")), ",").alias("dense"),
        F.md5(F.array_join(F.array_sort(toks), ",")).alias("toks_md5"),
    )


def q15_index_build(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "index-root")
    P.write_index(_stored(spark, sf_dir), root)
    return _index_rows(IX.open_index(spark, root).vectors)


def q16_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Index of every document, then one upsert batch: German documents
    re-crawled with their last line dropped (changed: stale chunks must go)
    and Spanish documents arriving again under new ids (inserted)."""
    docs = _stored(spark, sf_dir)
    root = scratch_path(spark, "index-root")
    P.ingest(docs, root)
    changed = docs.filter(F.col("lang").eqNullSafe("de")).withColumn(
        "text", F.regexp_replace("text", "\n[^\n]*\\z", "")
    )
    new = docs.filter(F.col("lang") == "es").withColumn("doc_id", F.col("doc_id") + F.lit(1_000_000_000))
    P.ingest_batch(changed.unionByName(new), root)
    return IX.open_index(spark, root).payload.select("doc_id", "chunk_ix", "chunk_id", "text")


def q17_text_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = _two_stage(spark, sf_dir, payload=LABELLED)
    return hits.select("query_id", "rank", *LABELLED, T.doc_label(F.col("doc_id")).alias("doc_label"), "score", "ham", "stage1_rank")


def q18_isolate_sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _queries(spark, sf_dir)
    iso = P.isolate(_two_stage(spark, sf_dir, q), q, ISOLATE_TOP_N)
    return iso.select("query_id", "rank", "id.doc_id", "id.chunk_ix", "sent_rank", "sent_ix", "sentence", "score")


def q19_standard_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _queries(spark, sf_dir)
    return P.standard_prompts(q, _two_stage(spark, sf_dir, q))


def q20_optimized_prompt(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _queries(spark, sf_dir)
    hits = freeze(_two_stage(spark, sf_dir, q), "texts")
    std = P.standard_prompts(q, hits)
    opt = P.optimized_prompts(q, P.isolate(hits, q, PROMPT_TOP_N))
    return P.prompt_reduction(std, opt)


def _payload_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    q = _queries(spark, sf_dir)
    idx = _index(spark, sf_dir)
    dense = P.dense_only(idx, q, TOP_K)
    two = freeze(P.two_stage(idx, q, PREFETCH_LIMIT, TOP_K), "texts")
    iso = P.isolate(two, q, PROMPT_TOP_N)
    return R.payload_report(q, dense, two, iso)


def q21_payload_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _payload_report(spark, sf_dir)


def q24_cost_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    return R.cost_projection(_payload_report(spark, sf_dir))


def q25_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _docs(spark, sf_dir).select("doc_id", T.preview(F.col("text")).alias("preview"))


def q26_json_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "chunks-json")
    IX.write_json(_chunks(spark, sf_dir).select("doc_id", "chunk_ix", "chunk_id", "text"), path)
    return IX.read_json(spark, path)


def q27_conversation_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P2 over conversations: a conversation is a document, a turn a section."""
    conv = read_table(spark, sf_dir, "conversations").select(
        F.col("conv_id").alias("doc_id"), F.col("turn").alias("chunk_ix"), "text"
    )
    docs = CH.assemble_documents(conv, separator="\n\n")
    return docs.select("doc_id", F.size("sections").alias("n_sections"), "text")


def q28_text_dense_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    hits = P.dense_only(_index(spark, sf_dir), _queries(spark, sf_dir), TOP_K, payload=LABELLED)
    return hits.select("query_id", "rank", *LABELLED, T.doc_label(F.col("doc_id")).alias("doc_label"), "score")


def q29_text_limit_sweep(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E6 on the text workload: top-1 agreement of each prefetch limit with
    the largest one, benchmark queries over every chunk."""
    emb, idx = P.DEFAULT_EMBEDDER, _index(spark, sf_dir)
    return R.limit_sweep(idx.vectors, _queries(spark, sf_dir), code_words=emb.code_words,
                         tok_kind=emb.tok_kind, tok_dim=emb.tok_dim, buckets=idx.buckets)


def _conversation_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A conversation is a document and each turn a section, numbered in turn order (P1 without assembling it)."""
    conv = read_table(spark, sf_dir, "conversations")
    nth = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn")) - 1
    rows = conv.select(F.col("conv_id").alias("doc_id"), nth.cast("int").alias("chunk_ix"), F.coalesce("text", F.lit("")).alias("text"))
    return rows.select(CH.chunk_key().alias("id"), "doc_id", "chunk_ix", T.chunk_id(F.col("doc_id"), F.col("chunk_ix")).alias("chunk_id"), "text")


def q30_conversation_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E1 over conversation turns: benchmark queries against every turn."""
    idx = freeze(P.index_chunks(_conversation_chunks(spark, sf_dir)), "conversation-index")
    return P.two_stage(idx, _queries(spark, sf_dir), PREFETCH_LIMIT, TOP_K).select(
        "query_id", "rank", "doc_id", "chunk_ix", "chunk_id", "score", "ham", "stage1_rank"
    )


def _string_docs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _stored(spark, sf_dir).withColumn("doc_id", F.format_string("msa-%09d", "doc_id"))


def q32_string_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1, A2, P1, F8 with string document ids and a carried field, through JSON that has no chunk_ix."""
    path = scratch_path(spark, "chunks-json")
    chunks = CH.documents_to_chunks(_string_docs(spark, sf_dir), keep=["source"])
    IX.write_json(chunks.select("doc_id", "source", "chunk_id", "text"), path)
    return IX.read_json(spark, path, IX.chunk_schema("string", {"source": "string"})).select("doc_id", "chunk_ix", "chunk_id", "source", "text")


def q33_string_id_two_stage(spark: SparkSession, sf_dir: str) -> DataFrame:
    """E8, A3 and E1 over documents with string ids."""
    root = scratch_path(spark, "index-root")
    P.ingest(_string_docs(spark, sf_dir), root, keep=["source"])
    hits = P.two_stage(IX.open_index(spark, root), _queries(spark, sf_dir), PREFETCH_LIMIT, TOP_K, payload=LABELLED)
    return hits.select("query_id", "rank", *LABELLED, "score", "ham", "stage1_rank")


def q34_upsert_repeated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 with a batch that holds every German document three times: without a
    sequence number, with 1 and with 2; the last one counts."""
    docs = _stored(spark, sf_dir).select("doc_id", "text", "lang")
    root = scratch_path(spark, "index-root")
    P.ingest(docs, root)
    german = docs.where(F.col("lang") == "de")
    batch = None
    for seq, more in ((2, "\nlast"), (None, "\nnone"), (1, "\nfirst\nline")):
        rows = german.select("doc_id", F.concat("text", F.lit(more)).alias("text"), F.lit(seq).cast("int").alias("seq"))
        batch = rows if batch is None else batch.unionByName(rows)
    P.ingest_batch(batch, root, seq="seq")
    return IX.open_index(spark, root).payload.select("doc_id", "chunk_ix", "chunk_id", "text")


def q35_index_lifecycle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: an absent index is created (from the English documents), a present
    one kept, a recreated one replaced (both by all other documents)."""
    docs = _stored(spark, sf_dir)
    root = scratch_path(spark, "index-root")
    english = F.col("lang").eqNullSafe("en")
    out = None
    for step, rows, recreate in (("create", docs.where(english), False), ("keep", docs.where(~english), False), ("recreate", docs.where(~english), True)):
        P.ingest(rows, root, recreate=recreate)
        held = IX.open_index(spark, root).payload.select(F.lit(step).alias("step"), "doc_id", "chunk_ix", "chunk_id", "text")
        held = freeze(held, "lifecycle")  # the next step replaces the files
        out = held if out is None else out.unionByName(held)
    return out


def q36_model_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P4, P5 through a float model that each worker loads: the token matrices and dense vectors of all queries."""
    q = P.encode_queries(read_table(spark, sf_dir, "benchmark"), LETTER_MODEL)
    rows = q.select("query_id", F.posexplode("q_toks").alias("tok_ix", "v")).unionByName(q.select("query_id", F.lit(-1).alias("tok_ix"), F.col("q_dense").alias("v")))
    return rows.select("query_id", "tok_ix", F.posexplode("v").alias("dim", "x")).select("query_id", "tok_ix", "dim", F.col("x").cast("double").alias("value"))


def q37_model_dense_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """P3, P5, E2 through the same model: every query against every chunk."""
    idx = freeze(P.build_index(_docs(spark, sf_dir), LETTER_MODEL).select("id", "doc_id", "chunk_ix", "chunk_id", "dense"), "model-index")
    q = freeze(P.encode_queries(read_table(spark, sf_dir, "benchmark"), LETTER_MODEL), "model-queries")
    hits = P.dense_only(idx, q, TOP_K, LETTER_MODEL, payload=["doc_id", "chunk_ix", "chunk_id"])
    return hits.select("query_id", "rank", "doc_id", "chunk_ix", "chunk_id", "score")
