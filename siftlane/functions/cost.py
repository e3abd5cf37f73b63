"""Footprint and cost arithmetic (F5, F6) as column expressions."""

from __future__ import annotations

from pyspark.sql import Column

# Input-token price in USD per million tokens, bytes per float32.
PRICE_PER_MILLION_INPUT_TOKENS = 3.00
FLOAT32_BYTES = 4


def full_precision_bytes(dim: Column) -> Column:
    return dim.cast("long") * FLOAT32_BYTES


def binary_bytes(dim: Column) -> Column:
    """1 bit per dimension (fractional for dims that are not multiples of 8)."""
    return dim.cast("double") / 8.0


def query_cost(tokens_per_query: Column, n_queries: Column, price: float = PRICE_PER_MILLION_INPUT_TOKENS) -> Column:
    """USD for ``n_queries`` prompts of ``tokens_per_query`` input tokens."""
    return tokens_per_query.cast("double") * n_queries / 1_000_000.0 * price
