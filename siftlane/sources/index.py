"""Index storage: JSON chunk files (A1, A2), the index table (A3) and upserts (A4).

An index root holds two ordinary partitioned Parquet tables:

    vectors/of=<n>/bucket=<b>/   doc_id, chunk_ix, chunk_id, dense, code, toks, ...
    payload/of=<n>/bucket=<b>/   doc_id, chunk_ix, chunk_id, text and the columns kept

Rows are dealt to ``n`` buckets by a hash of the document id and sorted by key
within a file; ``n`` comes from the number of rows at creation
(``bucket_rows``).  A search joins its candidates and hits on the bucket too,
so Spark's dynamic partition pruning reads only the buckets that they are in,
of one table.

An upsert writes anew only the buckets that its documents fall into, by Spark's
dynamic partition overwrite: it removes the old files of a bucket when all new
ones are written.  There is no manifest and no version; a reader that
started before an upsert may find a replaced file gone, as with any table that
Spark overwrites, and is run again.  One writer at a time holds the lock file
``_writer``; a second one waits, then fails.  The payload is written first, so
a crash in between is mended by running the same batch again.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import freeze

# Rows of a bucket on average, when an index is created.
BUCKET_ROWS = 100_000
# Characters of text for which a bucket gets a partition of its own more, when it is written.
PART_CHARS = 4 << 20
# Files of a bucket on average, from which an upsert deals the rows out anew.
FILES_PER_BUCKET = 16
# Document ids of a batch that are broadcast at most.
BROADCAST_IDS = 2_000_000
# Columns of the payload table; the vectors table has all others, and the key in both.
KEY = ["doc_id", "chunk_ix", "chunk_id"]
VECTORS = ["dense", "code", "toks", "n_tokens"]
# A writer waits so long for another one; a lock that is older is a crashed writer's.
WAIT_SECONDS = 0
STALE_SECONDS = 6 * 3600


# --- A1 / A2: JSON ---------------------------------------------------------

def chunk_schema(doc_id: str = "bigint", keep: dict[str, str] | None = None) -> str:
    """The columns of a chunk file; ``doc_id`` is the type of document ids, ``keep`` names further columns and their types."""
    fields = {"doc_id": doc_id, "chunk_ix": "int", "chunk_id": "string", "text": "string", **(keep or {})}
    return ", ".join(f"`{n}` {t}" for n, t in fields.items())


CHUNK_SCHEMA = chunk_schema()


def write_json(df: DataFrame, path: str) -> None:
    """A2: JSON lines (splittable), replacing whatever is at ``path``."""
    df.write.mode("overwrite").json(path)


def read_json(spark: SparkSession, path: str, schema=CHUNK_SCHEMA, multiline: bool = False) -> DataFrame:
    """A1: read JSON with a fixed schema (never inferred).  ``multiline``
    reads one JSON array per file (not splittable: one task per file).  A
    value that does not fit its type fails the job; a file without
    ``chunk_ix`` takes it from the end of ``chunk_id``."""
    df = spark.read.schema(schema).option("multiLine", multiline).option("mode", "FAILFAST").json(path)
    if {"chunk_ix", "chunk_id"} <= set(df.columns):
        number = F.regexp_extract("chunk_id", r"-c(\d+)$", 1)
        df = df.withColumn("chunk_ix", F.coalesce("chunk_ix", F.when(number != "", number.cast("int"))))
    return df


# --- A3: index table --------------------------------------------------------

def check_index(df: DataFrame, dense_dim: int | None, code_words: int) -> DataFrame:
    """Fails the job on a malformed row (a null id, code or vector, or one of another size) instead of writing it."""
    fine = F.col("id").isNotNull() & F.col("doc_id").isNotNull() & (F.size("code") == code_words)
    if dense_dim is not None:
        fine = fine & (F.size("dense") == dense_dim)
    bad = F.raise_error(F.lit("index row has a wrong shape"))
    return df.withColumn("code", F.when(F.coalesce(fine, F.lit(False)), F.col("code")).otherwise(bad))


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


@contextmanager
def writer(spark: SparkSession, root: str, wait: float | None = None) -> Iterator[None]:
    """Holds the root's lock; RuntimeError if another writer still has it after ``wait`` seconds."""
    fs, p = _fs(spark, f"{root.rstrip('/')}/_writer")
    fs.mkdirs(p.getParent())
    until = time.time() + (WAIT_SECONDS if wait is None else wait)
    while not fs.createNewFile(p):  # atomic
        if fs.exists(p) and time.time() - fs.getFileStatus(p).getModificationTime() / 1000 > STALE_SECONDS:
            fs.delete(p, False)
        elif time.time() > until:
            raise RuntimeError(f"another writer holds {p.toString()}")
        else:
            time.sleep(0.2)
    try:
        yield
    finally:
        fs.delete(p, False)


def bucket_of(doc_id: str | Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id), F.lit(buckets)).cast("int")


def _with_id(df: DataFrame) -> DataFrame:
    return df.withColumn("id", F.struct("doc_id", "chunk_ix"))


@dataclass(frozen=True)
class StoredIndex:
    """The two tables of an index and its number of buckets."""

    vectors: DataFrame
    payload: DataFrame
    buckets: int

    def rows(self) -> DataFrame:
        """Vectors and payload side by side, as the index was given."""
        text = self.payload.drop("id", "chunk_id")
        return self.vectors.join(text, ["bucket", "doc_id", "chunk_ix"]).drop("bucket")


def is_index(spark: SparkSession, root: str) -> bool:
    """Whether a complete index is at ``root``."""
    return _exists(spark, f"{root.rstrip('/')}/vectors/_SUCCESS")


def _buckets(spark: SparkSession, root: str) -> int:
    fs, p = _fs(spark, f"{root.rstrip('/')}/vectors")
    names = [st.getPath().getName() for st in fs.listStatus(p)]  # one folder and a marker
    return next(int(n[3:]) for n in names if n.startswith("of="))


def open_index(spark: SparkSession, root: str) -> StoredIndex:
    """The index at ``root`` as two tables with their bucket column."""
    if not is_index(spark, root):
        raise FileNotFoundError(f"no complete index under {root}")
    vectors, payload = (_with_id(spark.read.parquet(f"{root.rstrip('/')}/{t}").drop("of")) for t in ("vectors", "payload"))
    return StoredIndex(vectors, payload, _buckets(spark, root))


def read_index(spark: SparkSession, root: str) -> DataFrame:
    """All rows and columns of the index; a search should take ``open_index`` instead."""
    return open_index(spark, root).rows()


def _parts(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The columns of the payload table and of the vectors table."""
    vectors = [c for c in VECTORS if c in df.columns]
    return df.drop(*vectors, "id"), df.select(*KEY, *vectors)


def _together(rows: DataFrame, buckets: int) -> DataFrame:
    """One bucket's rows in one partition, but a large bucket's in several."""
    return rows.withColumn("bucket", bucket_of("doc_id", buckets)).hint("rebalance", "bucket")


def _put(rows: DataFrame, path: str, buckets: int, dynamic: bool) -> None:
    """Writes rows as buckets, all anew or only those that occur."""
    rows = rows.withColumn("of", F.lit(buckets)).withColumn("bucket", bucket_of("doc_id", buckets)).sortWithinPartitions("bucket", "doc_id", "chunk_ix")
    out = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if dynamic else "static").option("compression", "zstd")
    out.partitionBy("of", "bucket").parquet(path)


def _create(root: str, rows: int, tables, bucket_rows: int | None) -> None:
    """Writes both tables, the payload first; ``tables(buckets)`` gives their rows, dealt out."""
    buckets = max(1, -(-rows // (bucket_rows or BUCKET_ROWS)))
    for rows, table in zip(tables(buckets), ("payload", "vectors")):
        _put(rows, f"{root}/{table}", buckets, dynamic=False)
        # an empty file keeps the schema of an index without rows
        rows.limit(0).drop("bucket").write.mode("overwrite").option("compression", "zstd").parquet(f"{root}/{table}/of={buckets}/bucket=-1")


def create_index(df: DataFrame, root: str, recreate: bool = False, bucket_rows: int | None = None) -> None:
    """A3: absent -> write it; present -> keep it (no-op); ``recreate`` -> replace it."""
    spark, root = df.sparkSession, root.rstrip("/")
    if is_index(spark, root) and not recreate:
        return
    with writer(spark, root):
        if is_index(spark, root) and not recreate:
            return
        staged = freeze(df, "index")
        _create(root, staged.count(), lambda n: [_together(t, n) for t in _parts(staged)], bucket_rows)


@dataclass(frozen=True)
class Documents:
    """Documents of an index: a stored table, one row for each, and how its chunks and their vectors are made.

    The texts are dealt to the buckets before they are cut and embedded, so
    that vectors, several times their size, never move and are stored once.
    ``chunk`` gives chunk rows of documents, ``embed`` index rows of chunks."""

    docs: DataFrame
    chunk: Callable[[DataFrame], DataFrame]
    embed: Callable[[DataFrame], DataFrame]

    def tables(self, buckets: int, parts: int) -> tuple[DataFrame, DataFrame]:
        """The rows of both tables; a bucket's documents are in ``parts`` partitions."""
        place = bucket_of("doc_id", buckets) * parts + F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(parts)).cast("int")
        chunks = self.chunk(self.docs.repartitionById(buckets * parts, place))
        # a row without an id is not written to the payload either
        known = F.when(F.col("doc_id").isNull(), F.raise_error(F.lit("index row has a wrong shape"))).otherwise(F.col("chunk_ix"))
        payload = chunks.withColumn("chunk_ix", known.cast("int"))
        return _parts(payload)[0], _parts(self.embed(chunks))[1]

    def parts(self, buckets: int, chars: int) -> int:
        """Partitions of a bucket: enough for all cores, but none for little text."""
        cores = self.docs.sparkSession.sparkContext.defaultParallelism
        return max(1, min(-(-2 * cores // buckets), -(-chars // (buckets * PART_CHARS))))

    def size(self) -> tuple[int, int]:
        """Their chunks and characters."""
        n, chars = self.chunk(self.docs).agg(F.count(F.lit(1)), F.sum(F.length("text"))).first()
        return n, chars or 0


def create_from_documents(source: Documents, root: str, recreate: bool = False, bucket_rows: int | None = None) -> None:
    """:func:`create_index` from documents."""
    spark, root = source.docs.sparkSession, root.rstrip("/")
    if is_index(spark, root) and not recreate:
        return
    with writer(spark, root):
        if is_index(spark, root) and not recreate:
            return
        n, chars = source.size()
        _create(root, n, lambda buckets: source.tables(buckets, source.parts(buckets, chars)), bucket_rows)


# --- A4: upsert ---------------------------------------------------------------

def dedupe_latest(batch: DataFrame, key: str = "doc_id", seq: str | None = None) -> DataFrame:
    """Rows that repeat a ``key``: the one with the highest ``seq`` wins (a
    null ``seq`` is the lowest), of equal ones the one with the highest other
    columns, so the result does not depend on the order of rows.  ``max``
    combines map-side: a key repeated in a third of the batch reaches the
    shuffle as one row per task."""
    cols = [c for c in batch.columns if c != key]
    order = ([F.col(seq).alias("_seq")] if seq else []) + [F.col(c) for c in cols]
    best = F.max(F.struct(*order)).alias("_row")
    return batch.groupBy(key).agg(best).select(*[F.col(key) if c == key else F.col(f"_row.{c}").alias(c) for c in batch.columns])


def upsert(existing: DataFrame, updates: DataFrame, key: str, keys: DataFrame | None = None) -> DataFrame:
    """A4: rows of ``existing`` whose ``key`` appears in ``updates`` are
    replaced by all update rows with that key; other rows stay.  With
    ``key='doc_id'`` a changed document loses chunks it no longer has.
    ``keys`` are the keys of ``updates``, where they are known."""
    kept = existing.join(updates.select(key).distinct() if keys is None else keys, key, "left_anti")
    return kept.unionByName(updates.select(*existing.columns))


def upsert_index(spark: SparkSession, root: str, updates: DataFrame) -> None:
    """A4 on an index: the documents of ``updates`` have exactly the rows given.

    Only the buckets that they fall into are read and written.  The same batch
    again changes nothing."""
    root = root.rstrip("/")
    updates = freeze(updates, "updates")  # embedded once, read several times
    if not is_index(spark, root):
        create_index(updates, root)
        if not updates.limit(1).count():
            return
    with writer(spark, root):
        buckets = _buckets(spark, root)
        _replace(spark, root, updates, [_together(t, buckets) for t in _parts(updates)], buckets)


def upsert_documents(spark: SparkSession, root: str, source: Documents) -> None:
    """:func:`upsert_index` from documents, one row each."""
    root = root.rstrip("/")
    if not is_index(spark, root):
        create_from_documents(source, root)
        if not source.docs.limit(1).count():
            return
    with writer(spark, root):
        buckets = _buckets(spark, root)
        _replace(spark, root, source.docs, source.tables(buckets, source.parts(buckets, source.size()[1])), buckets)


def _replace(spark: SparkSession, root: str, updates: DataFrame, tables, buckets: int) -> None:
    """Puts the rows of ``tables`` in place of all rows of the documents of ``updates``, a stored table.

    Rows that stay are written from the partitions in which they were read.
    Their old files go only when Spark commits the new ones.  A table whose
    buckets have come to many files is dealt out anew."""
    given = updates.select("doc_id").distinct()
    touched = given.select(bucket_of("doc_id", buckets).alias("bucket")).distinct().where("bucket >= 0")  # a filter, so that Spark prunes by it
    if updates.count() <= BROADCAST_IDS:
        given = F.broadcast(given)
    for new, table in zip(tables, ("payload", "vectors")):
        path = f"{root}/{table}"
        old = spark.read.parquet(path)
        many = len(old.inputFiles()) > FILES_PER_BUCKET * buckets
        rows = upsert(old.join(F.broadcast(touched), "bucket", "left_semi").drop("of", "bucket"), new, "doc_id", given)
        _put(_together(rows, buckets) if many else rows, path, buckets, dynamic=True)
