"""Exact k-nearest search of a table of queries over a table of vectors.

Both sides become packed block rows on the executors (mapInArrow, narrow) and
meet in the cells of a grid, corpus groups by query groups (fragment and
replicate): a corpus block visits every query group, a query block every
corpus group, and the equi-join on (corpus group, query group) pairs them.
The numbers of groups come from the measured row counts of both sides, as
scalar subqueries of the same lazy plan: about CELLS_PER_PARTITION cells a
shuffle partition, CELLS_PER_CORE a core at most, in the proportion that moves the fewest bytes, and more
where a cell would exceed CELL_BYTES.  Queries that Spark will broadcast
anyway make one group, so nothing is replicated.

A task scores block against block with numpy and keeps, over all blocks that
it sees, the k best of each query (no pair ever becomes a row); one shuffle on
the query merges the tasks' results with row_number() <= k.

With a large k (COUNT_FROM) a Hamming search counts first: every task sums how
many rows lie at each distance of each query, the sums give the distance of
the k-th best, and the scan then passes on only rows up to that distance:
about queries x k rows in all, however many tasks see a query.

Selection is cheap next to scoring: each query has a running threshold, its
k-th best key so far, and only cells at or below it are looked at.  Keys are
integers (the Hamming distance, or the cosine rounded to 6 decimals), and the
same key orders the partial and the final result; ties go to the smaller id.
Ids may be of any type that Arrow can sort, a struct of columns included.

``maxsim_top_k`` runs the same blocks over token matrices: the exact best
rows by MaxSim over all pairs, which a two-stage search can be held against.
A matrix product of all tokens of two blocks, and the best of each segment.

Nothing here runs a job: the result is one lazy plan.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Cells of the grid for each shuffle partition, at most for each core, and bytes that one side may have in a cell.
CELLS_PER_PARTITION = 3
CELLS_PER_CORE = 16
CELL_BYTES = 32 << 20
# A group has at least so many vectors (queries), and so does a block where there are enough.
GROUP_ROWS = 256
GROUP_QUERIES = 64
# From this k on, a Hamming search counts distances first.
COUNT_FROM = 64
# Rows and bytes of a packed block at most.
QUERY_ROWS = 1024
BLOCK_ROWS = 16384
BLOCK_BYTES = 4 << 20
# Queries x k that a task remembers; beyond it finished lists are passed on.
MAX_STATE_CELLS = 4_000_000
_STRIP = 64
_COS_SCALE = 1_000_000
# Tokens of a block in a MaxSim search, and what its keys are counted down from (1,000 query tokens that match).
BLOCK_TOKENS = 4096
_MAXSIM_TOP = 1_000 * _COS_SCALE


def top_k_per_key(df: DataFrame, keys: list[str], order: list[Column], k: int, rank_col: str = "rank") -> DataFrame:
    """row_number() <= k per key (Spark limits each task's rows per key before the shuffle)."""
    w = Window.partitionBy(*[F.col(c) for c in keys]).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w)).filter(F.col(rank_col) <= k)


def _sort_ranks(ids: pa.Array) -> np.ndarray:
    """The position of each id in sorted order."""
    cols = ids.flatten() if pa.types.is_struct(ids.type) else [ids]
    names = [str(i) for i in range(len(cols))]
    order = pc.sort_indices(pa.Table.from_arrays(cols, names=names), sort_keys=[(n, "ascending") for n in names]).to_numpy()
    ranks = np.empty(len(ids), np.int64)
    ranks[order] = np.arange(len(ids))
    return ranks


def _to_ipc(ids: pa.Array) -> bytes:
    sink = pa.BufferOutputStream()
    batch = pa.RecordBatch.from_arrays([ids], names=["id"])
    with pa.ipc.new_stream(sink, batch.schema) as w:
        w.write_batch(batch)
    return sink.getvalue().to_pybytes()


def _from_ipc(data: bytes) -> pa.Array:
    return pa.ipc.open_stream(data).read_all().column(0).combine_chunks()


def _matrix(vec: pa.Array, width: int, mode: str) -> np.ndarray:
    if vec.null_count:
        raise ValueError("a row without a vector cannot be searched")
    flat = vec.flatten()
    if flat.null_count or len(flat) != len(vec) * width or (np.diff(vec.offsets.to_numpy()) != width).any():
        raise ValueError(f"vectors must all have {width} components")
    kind = np.int64 if mode == "hamming" else np.float32 if pa.types.is_float32(flat.type) else np.float64
    return flat.to_numpy(zero_copy_only=False).astype(kind).reshape(len(vec), width)


def _token_blocks(vec: pa.Array, width: int) -> tuple[list[bytes], np.dtype]:
    """Each row's token vectors as bytes, in the precision that they have."""
    if vec.null_count:
        raise ValueError("a row without a vector cannot be searched")
    toks = vec.flatten()
    m = _matrix(toks, width, "cosine") if len(toks) else np.empty((0, width), np.float32 if pa.types.is_float32(vec.type.value_type.value_type) else np.float64)
    at = vec.offsets.to_numpy() - vec.offsets[0].as_py()
    return [m[a:b].tobytes() for a, b in zip(at[:-1], at[1:])], m.dtype


def _unit(m: np.ndarray) -> np.ndarray:
    """Vectors of length 1 in double precision; a zero vector stays zero."""
    m = m.astype(np.float64)
    n = np.sqrt((m * m).sum(1, keepdims=True))
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def _pack(width: int, mode: str, rows: int, least: int):
    """Arrow batches (id, vec, groups[, self][, cut]) as block rows of neighbouring ids; the blocks are dealt out to the groups."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import pyspark

        dealt = 7919 * pyspark.TaskContext.get().partitionId()
        for b in batches:
            if b.num_rows == 0:
                continue
            ids = b.column("id")
            if mode == "maxsim":
                cells, dtype = _token_blocks(b.column("vec"), width)
                kind, lengths = str(dtype), np.array([len(x) for x in cells]) // (dtype.itemsize * width)
            else:
                mat = _matrix(b.column("vec"), width, mode)
                kind, lengths = str(mat.dtype), None
            if ids.null_count:
                raise ValueError("a row without an id cannot be searched")
            more = [
                b.column(c).fill_null(missing).to_numpy(zero_copy_only=False).astype(np.int64) if c in b.schema.names else None
                for c, missing in (("self", np.iinfo(np.int64).min), ("cut", _NO_CUT))
            ]
            groups = b.column("groups")[0].as_py()
            order = np.argsort(_sort_ranks(ids), kind="stable")
            size = min(rows, max(least, -(-len(order) // groups)))
            cuts = list(range(0, len(order), size)) if lengths is None else _by_tokens(lengths[order], size)
            for s, e in zip(cuts, [*cuts[1:], len(order)]):
                own = order[s:e]
                dealt += 1
                packed = np.ascontiguousarray(mat[own]).tobytes() if lengths is None else b"".join(cells[i] for i in own)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([dealt % groups], pa.int32()), pa.array([len(own)], pa.int32()), pa.array([_to_ipc(ids.take(pa.array(own)))], pa.binary()),
                        pa.array([packed], pa.binary()), pa.array([kind]),
                        *(pa.array([None if m is None else m[own].tobytes()], pa.binary()) for m in more),
                        pa.array([None if lengths is None else lengths[own].astype(np.int64).tobytes()], pa.binary()),
                    ],
                    names=["own", "n", "ids", "vecs", "kind", "selfs", "cuts", "sizes"],
                )

    return run


def _by_tokens(lengths: np.ndarray, rows: int) -> list[int]:
    """Where blocks of at most ``rows`` rows and BLOCK_TOKENS tokens begin (a longer row is a block of its own)."""
    cuts, tokens = [0], 0
    for i, n in enumerate(lengths.tolist()):
        if i > cuts[-1] and (i - cuts[-1] >= rows or tokens + n > BLOCK_TOKENS):
            cuts.append(i)
            tokens = 0
        tokens += n
    return cuts


_BLOCK = "own int, n int, ids binary, vecs binary, kind string, selfs binary, cuts binary, sizes binary"
_NO_CUT = np.iinfo(np.int32).max


def hamming_keys(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Bits that differ, (queries, rows), in the smallest type that holds them."""
    kind = np.uint8 if 64 * q.shape[1] < 255 else np.uint16
    q, c = q.view(np.uint64), c.view(np.uint64)
    out = np.bitwise_count(q[:, 0, None] ^ c[None, :, 0]).astype(kind, copy=False)
    for w in range(1, q.shape[1]):
        out += np.bitwise_count(q[:, w, None] ^ c[None, :, w])
    return out


def cosine_keys(q: np.ndarray, c: np.ndarray) -> np.ndarray:
    """10**6 minus the cosine in millionths, halves away from zero; a zero vector has cosine 0."""
    q, c = q.astype(np.float64), c.astype(np.float64)
    den = np.sqrt((q * q).sum(1))[:, None] * np.sqrt((c * c).sum(1))[None, :]
    cos = np.divide(q @ c.T, den, out=np.zeros_like(den), where=den > 0) * _COS_SCALE
    return (_COS_SCALE - np.copysign(np.floor(np.abs(cos) + 0.5), cos)).astype(np.int32)


def maxsim_keys(q: np.ndarray, q_sizes: np.ndarray, c: np.ndarray, c_sizes: np.ndarray) -> np.ndarray:
    """A large number less the MaxSim in millionths of every two rows, given their unit tokens one after another; 0 tokens on either side score 0."""
    out = np.zeros((len(q_sizes), len(c_sizes)))
    qs, cs = np.flatnonzero(q_sizes), np.flatnonzero(c_sizes)
    if len(qs) and len(cs):
        best = np.maximum.reduceat(q @ c.T, np.cumsum(c_sizes[cs]) - c_sizes[cs], axis=1)
        out[np.ix_(qs, cs)] = np.add.reduceat(best, np.cumsum(q_sizes[qs]) - q_sizes[qs], axis=0)
    return _MAXSIM_TOP - np.copysign(np.floor(np.abs(out) * _COS_SCALE + 0.5), out).astype(np.int64)


class RunningTopK:
    """The k best (key, id) of each query of a block over all vector blocks so far."""

    def __init__(self, n: int, k: int, cuts: np.ndarray | None = None):
        """``cuts``: keys that the k best of each query do not exceed, where known."""
        self.k, self.limit = k, np.full(n, _NO_CUT, np.int64) if cuts is None else cuts.copy()
        self.parts: list[tuple[np.ndarray, np.ndarray, pa.Array]] = []
        self.held = 0

    def add(self, first: int, keys: np.ndarray, ids: pa.Array, skip: np.ndarray | None = None) -> None:
        """``keys`` (queries from ``first`` on, rows in id order); ``skip`` masks cells that do not count."""
        if skip is not None:
            keys = np.where(skip, np.iinfo(keys.dtype).max, keys)
        limit = self.limit[first : first + len(keys)]
        fresh = np.flatnonzero(limit == _NO_CUT)
        if len(fresh) and keys.shape[1] > self.k:  # no threshold yet: the k-th best key of this block
            limit[fresh] = np.partition(keys[fresh], self.k - 1, axis=1)[:, self.k - 1]
        qi, pos = np.nonzero(keys <= np.minimum(limit, np.iinfo(keys.dtype).max)[:, None].astype(keys.dtype))
        if skip is not None:
            fine = ~skip[qi, pos]
            qi, pos = qi[fine], pos[fine]
        if len(qi):
            self.parts.append((qi + first, keys[qi, pos].astype(np.int64), ids.take(pa.array(pos))))
            self.held += len(qi)
            if self.held > 3 * self.k * len(self.limit) + 4096:
                self.compact()

    def compact(self) -> tuple[np.ndarray, np.ndarray, pa.Array] | None:
        if not self.parts:
            return None
        qi = np.concatenate([p[0] for p in self.parts])
        key = np.concatenate([p[1] for p in self.parts])
        ids = pa.concat_arrays([p[2] for p in self.parts])
        rank = _sort_ranks(ids)
        spread = int(key.max(initial=0)) + 1
        if len(self.limit) * spread * len(rank) < 2**62:  # one number that sorts like (query, key, id)
            order = np.argsort((qi * spread + key) * len(rank) + rank)
        else:
            order = np.lexsort((rank, key, qi))
        qi, key = qi[order], key[order]
        nth = np.arange(len(qi)) - np.searchsorted(qi, np.arange(len(self.limit)), side="left")[qi]
        keep = nth < self.k
        last = nth == self.k - 1
        self.limit[qi[last]] = key[last]
        out = qi[keep], key[keep], ids.take(pa.array(order[keep]))
        self.parts, self.held = [out], len(out[0])
        return out


class RunningCounts:
    """How many rows lie at each distance of each query of a block, over all vector blocks so far."""

    def __init__(self, n: int, k: int, width: int):
        self.k, self.counts = k, np.zeros((n, 64 * width + 1), np.int64)

    def add(self, first: int, keys: np.ndarray, ids: pa.Array, skip: np.ndarray | None = None) -> None:
        bins = self.counts.shape[1]
        at = keys.astype(np.int64) + np.arange(len(keys))[:, None] * bins
        at = at.ravel() if skip is None else at[~skip]
        self.counts[first : first + len(keys)] += np.bincount(at, minlength=len(keys) * bins).reshape(len(keys), bins)

    def rows(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, distance, rows) up to the distance of the k-th row; farther ones cannot matter."""
        before = np.cumsum(self.counts, axis=1) - self.counts
        qi, key = np.nonzero((self.counts > 0) & (before < self.k))
        return qi, key, self.counts[qi, key]


def _over_pairs(mode: str, k: int, width: int, count: bool):
    """mapInArrow over joined blocks: the k best rows of each query, or with ``count`` its rows by distance."""
    keys_of = hamming_keys if mode == "hamming" else cosine_keys
    per_query = 64 * width + 1 if count else k

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        state: dict[bytes, tuple[pa.Array, RunningTopK | RunningCounts]] = {}

        def rows(name):
            q_ids, held = state.pop(name)
            if count:
                qi, key, n = held.rows()
                yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(qi)), pa.array(key.astype(np.int64)), pa.array(n)], names=["query_id", "key", "n"])
            elif (out := held.compact()) is not None:
                yield pa.RecordBatch.from_arrays([q_ids.take(pa.array(out[0])), out[2], pa.array(out[1])], names=["query_id", "id", "key"])

        for b in batches:
            get = {c: b.column(c) for c in b.schema.names}
            for i in range(b.num_rows):
                name = get["q_ids"][i].as_py()
                selfs, cuts = (None if x is None else np.frombuffer(x, np.int64) for x in (get["q_selfs"][i].as_py(), get["q_cuts"][i].as_py()))
                if name not in state:
                    q_ids = _from_ipc(name)
                    while state and sum(len(s[0]) for s in state.values()) * per_query > MAX_STATE_CELLS:
                        yield from rows(next(iter(state)))
                    state[name] = (q_ids, RunningCounts(len(q_ids), k, width) if count else RunningTopK(len(q_ids), k, cuts))
                held = state[name][1]
                q = np.frombuffer(get["q_vecs"][i].as_py(), get["q_kind"][i].as_py()).reshape(-1, width)
                c = np.frombuffer(get["vecs"][i].as_py(), get["kind"][i].as_py()).reshape(-1, width)
                ids = _from_ipc(get["ids"][i].as_py())
                plain = None if selfs is None else ids.to_numpy(zero_copy_only=False)
                if mode == "maxsim":
                    q_sizes, c_sizes = (np.frombuffer(get[x][i].as_py(), np.int64) for x in ("q_sizes", "sizes"))
                    if q_sizes.max(initial=0) > 1_000:
                        raise ValueError("a MaxSim search takes queries of at most 1,000 tokens")
                    held.add(0, maxsim_keys(_unit(q), q_sizes, _unit(c), c_sizes), ids, None if selfs is None else selfs[:, None] == plain[None, :])
                    continue
                for s in range(0, len(q), _STRIP):
                    skip = None if selfs is None else selfs[s : s + _STRIP, None] == plain[None, :]
                    held.add(s, keys_of(q[s : s + _STRIP], c), ids, skip)
        for name in list(state):
            yield from rows(name)

    return run


def _conf(spark, key: str) -> str:
    return spark.conf.get(f"spark.sql.{key}")


def _broadcast_bytes(spark) -> int:
    """Spark's limit for broadcast sides; 0 if it does not choose them by measured size."""
    if _conf(spark, "adaptive.enabled") != "true":
        return 0
    limit = spark.conf.get("spark.sql.adaptive.autoBroadcastJoinThreshold", None) or _conf(spark, "autoBroadcastJoinThreshold")
    return max(0, int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(limit)) if not limit.lstrip("-").isdigit() else int(limit))


def grid(corpus: DataFrame, queries: DataFrame, width: int) -> tuple[Column, Column]:
    """The numbers of corpus groups and of query groups, as scalar subqueries over the counts of both sides."""
    spark = corpus.sparkSession
    # every block is copied to the root of that many cells, so they must not grow with the shuffle partitions
    wanted = min(CELLS_PER_PARTITION * int(_conf(spark, "shuffle.partitions")), CELLS_PER_CORE * spark.sparkContext.defaultParallelism)
    n, q = (F.greatest(df.agg(F.count(F.lit(1)).alias("n")).scalar(), F.lit(1)) for df in (corpus, queries))
    row = 8 * width + 24
    share = F.round(F.sqrt(F.lit(float(wanted)) * q / n))  # groups in the proportion of the sides
    q_groups = F.greatest(F.least(share, F.ceil(q / GROUP_QUERIES)), F.ceil(q * row / CELL_BYTES), F.lit(1))
    c_groups = F.greatest(F.least(F.ceil(F.lit(wanted) / q_groups), F.ceil(n / GROUP_ROWS)), F.ceil(n * row / CELL_BYTES), F.lit(1))
    small = q * (4 * row) <= _broadcast_bytes(spark)  # block rows hold ids and vectors a second time while they are built
    return tuple(F.when(small, F.lit(1)).otherwise(g).cast("int") for g in (c_groups, q_groups))


def _pairs(scan: DataFrame, asked: DataFrame, c_groups: Column, q_groups: Column, mode: str, width: int) -> DataFrame:
    """Corpus blocks beside query blocks, one row for each two that meet."""
    rows = max(1, min(BLOCK_ROWS, BLOCK_BYTES // (8 * width)))
    left = scan.withColumn("groups", c_groups).mapInArrow(_pack(width, mode, rows, min(rows, GROUP_ROWS)), _BLOCK)
    right = asked.withColumn("groups", q_groups).mapInArrow(_pack(width, mode, QUERY_ROWS, min(QUERY_ROWS, GROUP_QUERIES)), _BLOCK)

    def other(df: DataFrame, groups: Column, name: str) -> DataFrame:
        return df.withColumn("groups", groups).withColumn(name, F.explode(F.sequence(F.lit(0), F.col("groups") - 1))).drop("groups")

    left = other(left, q_groups, "q_group").withColumnRenamed("own", "c_group")
    right = other(right, c_groups, "c_group_").select("c_group_", *[F.col(c).alias(f"q_{c}") for c in ("own", "ids", "vecs", "kind", "selfs", "cuts", "sizes")])
    met = left.join(right, (F.col("c_group") == F.col("c_group_")) & (F.col("q_group") == F.col("q_own")))
    return met.select("ids", "vecs", "kind", "sizes", "q_ids", "q_vecs", "q_kind", "q_selfs", "q_cuts", "q_sizes")


def partial_top_k(
    corpus: DataFrame,
    queries: DataFrame,
    *,
    k: int,
    mode: str,
    width: int,
    id_col: str = "id",
    vec_col: str = "code",
    q_id: str = "query_id",
    q_vec: str = "q_code",
    q_self: str | None = None,
    cells: tuple[int, int] | int | None = None,
    count_first: bool | None = None,
) -> DataFrame:
    """What the tasks of :func:`scan_top_k` pass on: ``(query_id, id, key)``, a superset of the k best of each query."""
    if mode not in ("hamming", "cosine", "maxsim"):
        raise ValueError(f"unknown mode {mode!r}")
    scan = corpus.select(F.col(id_col).alias("id"), F.col(vec_col).alias("vec"))
    own = [F.col(q_self).cast("long").alias("self")] if q_self is not None else []
    asked = queries.select(F.col(q_id).alias("id"), F.col(q_vec).alias("vec"), *own)
    if cells is None:
        c_groups, q_groups = grid(scan, asked, width)
    else:
        c_groups, q_groups = map(F.lit, (1, cells) if isinstance(cells, int) else cells)
    ids, q_ids = (df.schema[c].dataType.simpleString() for df, c in ((scan, "id"), (asked, "id")))
    if count_first or count_first is None and mode == "hamming" and k >= COUNT_FROM:
        counted = _pairs(scan, asked, c_groups, q_groups, mode, width).mapInArrow(_over_pairs(mode, k, width, True), f"query_id {q_ids}, key long, n long")
        counted = counted.groupBy("query_id", "key").agg(F.sum("n").alias("n"))
        so_far = F.sum("n").over(Window.partitionBy("query_id").orderBy("key"))
        cuts = counted.withColumn("so_far", so_far).where(F.col("so_far") >= k).groupBy(F.col("query_id").alias("cut_id")).agg(F.min("key").alias("cut"))
        asked = asked.join(cuts, F.col("id") == F.col("cut_id"), "left").drop("cut_id")
    pairs = _pairs(scan, asked, c_groups, q_groups, mode, width)
    return pairs.mapInArrow(_over_pairs(mode, k, width, False), f"query_id {q_ids}, id {ids}, key long")


def scan_top_k(corpus: DataFrame, queries: DataFrame, *, k: int, mode: str, **more) -> DataFrame:
    """Exact top-k of every query over the corpus: ``(query_id, id, value, rank)``.

    ``mode='hamming'``: vectors are BIGINT code words (``width`` words), the
    result column ``value`` is the Hamming distance, smaller is better.
    ``mode='cosine'``: vectors are float arrays of length ``width``; ``value``
    is the cosine rounded to 6 decimals, larger is better.
    ``q_self`` names a query column holding a (BIGINT) corpus id to exclude.
    ``cells`` sets the grid, (corpus groups, query groups) or only the latter,
    and ``count_first`` whether distances are counted first; neither changes
    the result.  Query ids are distinct.  A row without an id or a vector, or
    of another width, fails the job.
    """
    hits = partial_top_k(corpus, queries, k=k, mode=mode, **more)
    top = top_k_per_key(hits, ["query_id"], [F.col("key"), F.col("id")], k)
    value = F.col("key").cast("double") if mode == "hamming" else (F.lit(_COS_SCALE) - F.col("key")) / F.lit(float(_COS_SCALE))
    return top.select("query_id", "id", value.alias("value"), "rank")


def maxsim_top_k(corpus: DataFrame, queries: DataFrame, *, k: int, tok_dim: int, q_self: str | None = None, **more) -> DataFrame:
    """G3 over all pairs, exactly: ``(query_id, id, score, rank)``, the k best rows of each query by normalised MaxSim.

    ``toks`` and ``q_toks`` are float token matrices.  Scores are rounded to 6
    decimals, ties go to the smaller id; a row or a query without tokens scores
    0.  The work is queries x rows; nothing but each query's best leaves a task."""
    hits = partial_top_k(corpus, queries, k=k, mode="maxsim", width=tok_dim, vec_col="toks", q_vec="q_toks", q_self=q_self, count_first=False, **more)
    top = top_k_per_key(hits, ["query_id"], [F.col("key"), F.col("id")], k)
    return top.select("query_id", "id", ((F.lit(_MAXSIM_TOP) - F.col("key")) / F.lit(float(_COS_SCALE))).alias("score"), "rank")
