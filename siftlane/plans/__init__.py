"""End-to-end jobs (pipeline, reports), the registered queries
(vector_queries, text_queries) and their DuckDB recomputations."""
