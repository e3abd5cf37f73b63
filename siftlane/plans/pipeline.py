"""End-to-end text jobs: index build (E8), query encoding (P5), two-stage
and dense-only search with payload (E1, E2, A5, J4), isolation (E3) and
prompts (E4).  DataFrame in, DataFrame out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import prompt as PR
from ..functions import text as T
from ..operators import search as S
from ..operators.chunk import documents_to_chunks
from ..operators.embed import HashEmbedder
from ..operators.isolate import isolate_sentences
from ..session import freeze, scratch_path
from ..sources.index import Documents, StoredIndex, check_index, create_from_documents, dedupe_latest, is_index, open_index, upsert_documents

DEFAULT_EMBEDDER = HashEmbedder()
PAYLOAD = ["doc_id", "chunk_ix", "chunk_id", "text"]


def build_index(docs: DataFrame, embedder=DEFAULT_EMBEDDER, separator: str = "\n",
                keep: list[str] | None = None) -> DataFrame:
    """Documents -> chunks -> (dense, code, token matrix) in one narrow
    projection per partition; no shuffle.  A null text is one empty chunk, a
    null document id fails the job.  Document ids are taken to be distinct
    (the writers below see to that)."""
    return index_chunks(documents_to_chunks(docs, separator, keep), embedder)


def index_chunks(chunks: DataFrame, embedder=DEFAULT_EMBEDDER) -> DataFrame:
    """Index rows for ready-made chunks ``(id, doc_id, chunk_ix, chunk_id,
    text, ...)``, e.g. from ``sections_to_chunks``."""
    return check_index(embedder.encode(chunks, "text", side="doc"), embedder.dense_dim, embedder.code_words)


def ingest(docs: DataFrame, root: str, embedder=DEFAULT_EMBEDDER, recreate: bool = True,
           separator: str = "\n", keep: list[str] | None = None, seq: str | None = None, bucket_rows: int | None = None) -> None:
    """E8 end to end: of rows that repeat a doc_id the latest by ``seq`` (see
    ``dedupe_latest``), indexed and written to ``root`` in place of what is
    there (``recreate=False`` keeps an existing index untouched)."""
    spark = docs.sparkSession
    if recreate or not is_index(spark, root):
        create_from_documents(_source(freeze(_latest(docs, keep, seq), "documents"), embedder, separator, keep), root, recreate, bucket_rows)


def _source(docs: DataFrame, embedder, separator: str, keep: list[str] | None) -> Documents:
    """Stored documents with distinct ids, as an index is written from."""
    return Documents(docs, lambda d: documents_to_chunks(d, separator, keep), lambda c: index_chunks(c, embedder))


def write_index(docs: DataFrame, root: str, embedder=DEFAULT_EMBEDDER, separator: str = "\n", keep: list[str] | None = None, bucket_rows: int | None = None) -> None:
    """E8 for documents that are taken to be distinct, read from where they are; a present index is kept."""
    create_from_documents(_source(docs, embedder, separator, keep), root, bucket_rows=bucket_rows)


def ingest_batch(docs: DataFrame, root: str, embedder=DEFAULT_EMBEDDER, separator: str = "\n",
                 keep: list[str] | None = None, seq: str | None = None) -> None:
    """A4 for documents: the latest row of each doc_id replaces that document in the index."""
    rows = freeze(_latest(docs, keep, seq), "updates")
    upsert_documents(docs.sparkSession, root, _source(rows, embedder, separator, keep))


def _latest(docs: DataFrame, keep: list[str] | None, seq: str | None) -> DataFrame:
    cols = dict.fromkeys(["doc_id", "text", *(keep or []), *([seq] if seq else [])])
    return dedupe_latest(docs.select(*cols), "doc_id", seq)


def encode_queries(q: DataFrame, embedder=DEFAULT_EMBEDDER, id_col: str = "item_id",
                   text_col: str = "text") -> DataFrame:
    """P5: (query_id, query, q_dense, q_code, q_toks, q_n_tokens); ids may be of any sortable type."""
    base = q.select(F.col(id_col).alias("query_id"), F.col(text_col).alias("query"))
    return embedder.encode(base, "query", side="query", prefix="q_")


def _tables(index: DataFrame | StoredIndex) -> tuple[DataFrame, DataFrame, int | None]:
    """Vectors, payload and buckets of an index; a plain table is both."""
    return (index.vectors, index.payload, index.buckets) if isinstance(index, StoredIndex) else (index, index, None)


def two_stage(index: DataFrame | StoredIndex, queries: DataFrame, prefetch_limit: int = 100, top_k: int = 5,
              embedder=DEFAULT_EMBEDDER, payload: list[str] | None = None) -> DataFrame:
    """E1 with payload: (query_id, rank, id, score, ham, stage1_rank, *payload);
    payload defaults to (doc_id, chunk_ix, chunk_id, text); any column kept at
    index build (e.g. a company or source field) can be added."""
    vectors, texts, buckets = _tables(index)
    hits = S.two_stage_search(
        vectors, queries, prefetch_limit=prefetch_limit, top_k=top_k, code_words=embedder.code_words,
        tok_kind=embedder.tok_kind, tok_dim=embedder.tok_dim, buckets=buckets,
    )
    return S.fetch_payload(hits, texts, payload or PAYLOAD, buckets)


def dense_only(index: DataFrame | StoredIndex, queries: DataFrame, top_k: int = 5, embedder=DEFAULT_EMBEDDER,
               payload: list[str] | None = None) -> DataFrame:
    """E2 with payload: (query_id, rank, id, score, *payload)."""
    vectors, texts, buckets = _tables(index)
    hits = S.dense_only_search(vectors, queries, top_k=top_k, dim=embedder.dense_dim)
    return S.fetch_payload(hits, texts, payload or PAYLOAD, buckets)


def isolate(hits: DataFrame, queries: DataFrame, top_n: int = 2, embedder=DEFAULT_EMBEDDER) -> DataFrame:
    """E3 over search hits."""
    return isolate_sentences(hits.select("query_id", "rank", "id", "text"), queries, embedder, top_n)


def standard_prompts(queries: DataFrame, hits: DataFrame) -> DataFrame:
    """One row per query, whole chunk texts as context."""
    parts = hits.groupBy("query_id").agg(
        F.collect_list(F.struct(F.col("rank").alias("o"), PR.source_part(F.col("rank"), F.col("text")).alias("t"))).alias("_p")
    )
    out = queries.select("query_id", "query").join(parts, "query_id", "left")
    ctx = PR.ordered_join(F.coalesce(F.col("_p"), F.array()), PR.PART_SEPARATOR)
    return out.select("query_id", PR.prompt(F.col("query"), ctx).alias("prompt"))


def isolated_texts(isolated: DataFrame) -> DataFrame:
    """Per hit: its kept sentences joined by a space, in score order."""
    return isolated.groupBy("query_id", "rank", "id").agg(
        PR.ordered_join(F.collect_list(F.struct(F.col("sent_rank").alias("o"), F.col("sentence").alias("t"))), " ").alias(
            "isolated_text"
        )
    )


def optimized_prompts(queries: DataFrame, isolated: DataFrame) -> DataFrame:
    """One row per query, isolated sentences as context."""
    per_hit = isolated_texts(isolated)
    parts = per_hit.groupBy("query_id").agg(
        F.collect_list(
            F.struct(F.col("rank").alias("o"), PR.source_part(F.col("rank"), F.col("isolated_text")).alias("t"))
        ).alias("_p")
    )
    out = queries.select("query_id", "query").join(parts, "query_id", "left")
    ctx = PR.ordered_join(F.coalesce(F.col("_p"), F.array()), PR.PART_SEPARATOR)
    return out.select("query_id", PR.prompt(F.col("query"), ctx).alias("prompt"))


def prompt_reduction(std: DataFrame, opt: DataFrame) -> DataFrame:
    """token counts of both prompts and the reduction, per query."""
    s = std.select("query_id", T.count_tokens(F.col("prompt")).alias("standard_tokens"))
    o = opt.select("query_id", F.col("prompt").alias("optimized_prompt"),
                   T.count_tokens(F.col("prompt")).alias("optimized_tokens"))
    j = s.join(o, "query_id")
    return j.select(
        "query_id", "optimized_prompt", "standard_tokens", "optimized_tokens",
        F.round(PR.reduction_pct(F.col("optimized_tokens"), F.col("standard_tokens")), 6).alias("reduction_pct"),
    )


_INDEX_CACHE: dict[tuple, str] = {}


def snapshot(spark: SparkSession, path: str) -> tuple:
    """What identifies the state of a table's files: their number, total size and latest change, added up by the file system's iterator."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files, n, size, latest = fs.listFiles(p, True), 0, 0, 0
    while files.hasNext():
        st = files.next()
        n, size, latest = n + 1, size + st.getLen(), max(latest, st.getModificationTime())
    return p.toString(), n, size, latest


def corpus_index(spark: SparkSession, docs: DataFrame, path: str, keep: list[str] | None = None, embedder=DEFAULT_EMBEDDER,
                 bucket_rows: int | None = None) -> StoredIndex:
    """The written index for the corpus at ``path``, built once per application
    and state of its files (an index is a persistent table; searches read it back)."""
    key = (spark.sparkContext.applicationId, snapshot(spark, path), tuple(keep or ()), bucket_rows)
    if key not in _INDEX_CACHE:
        out = scratch_path(spark, "index")
        write_index(docs, out, embedder, keep=keep, bucket_rows=bucket_rows)
        _INDEX_CACHE[key] = out
    return open_index(spark, _INDEX_CACHE[key])
