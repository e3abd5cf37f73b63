"""Documents <-> chunks <-> sentences."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import text as T

def split_sections(text_col: str = "text", separator: str = "\n"):
    """Flat text -> ARRAY<STRING> sections (regex separator)."""
    return F.split(F.col(text_col), separator, -1)


def chunk_key(doc_id="doc_id", chunk_ix="chunk_ix"):
    """The key of a chunk: the pair (doc_id, chunk_ix) as a struct, which sorts
    and joins like the pair.  A document id may be of any sortable type."""
    ix = F.col(chunk_ix) if isinstance(chunk_ix, str) else chunk_ix
    doc = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.struct(doc.alias("doc_id"), ix.cast("int").alias("chunk_ix"))


def sections_to_chunks(docs: DataFrame, sections_col: str = "sections", keep: list[str] | None = None) -> DataFrame:
    """Section i of a document becomes chunk i; sections are never merged.
    A null document, or a null section, is one empty chunk.
    Returns (id, doc_id, chunk_ix, chunk_id, text, *keep)."""
    keep = keep or []
    sections = F.coalesce(F.col(sections_col), F.array(F.lit("")))
    exploded = docs.select("doc_id", *keep, F.posexplode(sections).alias("chunk_ix", "text"))
    return exploded.select(
        chunk_key().alias("id"),
        "doc_id",
        F.col("chunk_ix").cast("int").alias("chunk_ix"),
        T.chunk_id(F.col("doc_id"), F.col("chunk_ix")).alias("chunk_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        *keep,
    )


def documents_to_chunks(docs: DataFrame, separator: str = "\n", keep: list[str] | None = None) -> DataFrame:
    """Flat documents: one section per ``separator``-delimited piece."""
    with_sections = docs.withColumn("sections", split_sections("text", separator))
    return sections_to_chunks(with_sections, "sections", keep)


def assemble_documents(chunks: DataFrame, separator: str = "\n\n", order_col: str = "chunk_ix",
                       doc_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Sections in order, joined by ``separator``.  A group is one
    document, so its size is that of the document itself.
    Returns (doc_id, sections, text)."""
    g = chunks.groupBy(doc_col).agg(
        F.array_sort(F.collect_list(F.struct(F.col(order_col).alias("o"), F.col(text_col).alias("t")))).alias("_p")
    )
    sections = F.transform("_p", lambda p: p["t"])
    return g.select(F.col(doc_col), sections.alias("sections"), F.array_join(sections, separator).alias("text"))


def sentence_rows(df: DataFrame, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """P11 + P12: one row per sentence (sent_ix from 0).  A text without any
    qualifying sentence yields one row holding the raw, un-normalised text
    with ``is_fallback`` set.  Returns (*keep, sent_ix, sentence, is_fallback)."""
    keep = keep or []
    # the sentence array is computed once per input row, below the generator
    base = df.select(*keep, F.col(text_col).alias("_raw"), T.split_sentences(F.col(text_col)).alias("_s"))
    fallback = F.size("_s") == 0
    items = F.when(fallback, F.array(F.col("_raw"))).otherwise(F.col("_s"))
    return base.select(*keep, fallback.alias("is_fallback"), F.posexplode(items).alias("sent_ix", "sentence")).select(
        *keep, F.col("sent_ix").cast("int").alias("sent_ix"), "sentence", "is_fallback"
    )
