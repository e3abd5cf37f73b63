"""Input tables, vector-derived indexes and the versioned Parquet index
(JSON IO, create, upsert, compaction)."""
