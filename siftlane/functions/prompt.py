"""Prompt assembly (F2, F3, F4, G11) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The prompt template around the context and the question.
PROMPT_PREAMBLE = (
    "Answer the user's question based strictly on the provided context below. "
    "If the context does not contain the answer, state that clearly.\n\nContext:\n"
)
QUESTION_HEADER = "\n\nQuestion: "
ANSWER_TRAILER = "\nAnswer:"
SOURCE_LABEL = "[Source Chunk %d]: %s"
PART_SEPARATOR = "\n\n"


def ordered_join(parts: Column, sep: str) -> Column:
    """``parts`` is ARRAY<STRUCT<o, t>>; join the t fields in o order."""
    return F.array_join(F.transform(F.array_sort(parts), lambda p: p["t"]), sep)


def source_part(position: Column, text: Column) -> Column:
    return F.format_string(SOURCE_LABEL, position, text)


def prompt(question: Column, context: Column) -> Column:
    """F2/F3 template: preamble, context, question."""
    return F.concat(
        F.lit(PROMPT_PREAMBLE), F.coalesce(context, F.lit("")),
        F.lit(QUESTION_HEADER), question, F.lit(ANSWER_TRAILER),
    )


def reduction_pct(optimized: Column, standard: Column) -> Column:
    """(1 - optimized / standard) * 100; null when standard is 0."""
    return F.when(standard != 0, (F.lit(1.0) - optimized.cast("double") / standard) * 100.0)
