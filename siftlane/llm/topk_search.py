"""Exact top-k inner-product search over norm buckets (operator 1).

Vectors are range-partitioned by descending length and packed into blocks, so
a block holds vectors of like length; inside a block they are cut into buckets
whose lengths differ by at most a tenth.  A query carries the best k-th product
known so far (first from the longest vectors of the whole table, then from the
buckets already seen).  Divided by the query's and the bucket's length this is
the local cosine threshold, and it chooses the pruning of the bucket:

- over 1: the bucket is skipped;
- high: *coordinate* pruning, only vectors whose unit coordinates lie in the
  feasible region around the query's largest coordinates stay;
- low, or coordinates that let most vectors through: *length* pruning, only
  the prefix of vectors that are long enough stays.

Products of what stays are verified in exact arithmetic.  Queries and vectors
meet as packed blocks in the cells of a grid, groups of vectors by groups of
queries: a task reads the query blocks of a cell, then runs its vector blocks
past them, longest first.  Blocks are dealt out to the groups in turn, so each
group begins with long vectors; blocks too short for all queries of a group
are not sent there.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import freeze, small_batches

#: Rows of a packed block, of vectors and of queries.
BLOCK_ROWS = 1024
#: Vectors and queries that a cell holds at most, as bytes of eight-byte components.
GROUP_BYTES, QUERY_BYTES = 64 << 20, 32 << 20
#: Groups of vectors for each core, where there are blocks enough.
GROUPS_PER_CORE = 3
#: Tasks of the search at most (beyond so many cells, a task has several), and range partitions by length.
MAX_TASKS, MAX_RANGES = 4096, 1024
#: Longest vectors of the table that give the first thresholds (collected: a fixed number of rows).
SEED_ROWS = 256
#: A bucket ends where lengths fall under this share of its longest vector.
BUCKET_SHARE = 0.9
#: Local cosine threshold from which coordinates are pruned rather than lengths.
COORDINATE_FROM = 0.6
#: The query's largest coordinates that coordinate pruning looks at.
FOCUS = 3
#: Coordinates prune if the first one leaves at most this share of a bucket; else all products of a block cost less.
NARROW = 0.05
#: Components of pairs of vectors that are multiplied at once after coordinate pruning.
PAIR_VALUES = 1 << 21
#: Slack of float bounds; products themselves are exact.
EPS = 1e-9
#: Score and row of a place among the k best that is still free.
FREE_SCORE, FREE_ROW = -(2**63) + 1, 2**63 - 1

BLOCK = pa.schema([("no", pa.int64()), ("reach", pa.float64()), ("n", pa.int32()), ("dim", pa.int32()), ("ids", pa.binary()), ("names", pa.binary()), ("theta", pa.binary()), ("vecs", pa.binary())])
BLOCK_DDL = "no long, reach double, n int, dim int, ids binary, names binary, theta binary, vecs binary"


def quantise(df: DataFrame, scale: int = 256, vec: str = "embedding", id: str = "vec_id") -> DataFrame:
    """``(row, vec_id, v, n2)``: components floor(scale * x), and the squared length.

    Rows whose id or vector is null, or whose vector holds null or non-finite
    components, take no part.  ``row`` numbers the rows in the order of their
    ids, so rows that share an id stay apart.  The result is written once, as
    several steps read it."""
    x = F.col(vec)
    fine = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    rows = df.where(F.col(id).isNotNull() & x.isNotNull() & F.coalesce(fine, F.lit(False))).select(
        F.col(id).cast("long").alias("vec_id"), F.transform(x, lambda e: F.floor(scale * e.cast("double"))).alias("v")
    )
    order = ["vec_id", F.xxhash64("v"), "place"]  # the place only spreads equal rows
    rows = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "v")
    return freeze(rows.withColumn("n2", F.aggregate("v", F.lit(0).cast("long"), lambda a, e: a + e * e)), "vectors")


def _matrix(col: pa.ListArray) -> np.ndarray:
    """A list column as int64 rows, shorter ones filled up with zeros."""
    sizes = np.diff(col.offsets.to_numpy())
    flat = col.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    dim = int(sizes.max(initial=0))
    if (sizes == dim).all():
        return flat.reshape(len(sizes), dim)
    out = np.zeros((len(sizes), dim), np.int64)
    out[np.arange(dim) < sizes[:, None]] = flat
    return out


class Rows:
    """Vectors of a block, one row of ``vecs`` each, the numbers of their rows and their vec_ids."""

    def __init__(self, vecs: np.ndarray, ids: np.ndarray, names: np.ndarray):
        self.vecs, self.ids, self.names = vecs, ids, names
        x = vecs.astype(np.float64)
        self.length = np.sqrt((x * x).sum(1))
        self.largest = float(np.abs(x).max(initial=0))
        self._kept: dict = {}

    def of(self, kind: type) -> np.ndarray:
        if kind not in self._kept:
            self._kept[kind] = self.vecs.astype(kind)
        return self._kept[kind]

    def columns(self, start: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """For each coordinate the order of a bucket's vectors by it, and their unit coordinates in that order, plus 4 times its number so that all of them ascend."""
        if (start, stop) not in self._kept:
            unit = self.unit(start, stop)
            order = np.argsort(unit, axis=0, kind="stable")
            flat = np.take_along_axis(unit, order, 0) + 4.0 * np.arange(unit.shape[1])
            self._kept[start, stop] = order.T.copy(), flat.T.ravel()
        return self._kept[start, stop]

    def unit(self, start: int, stop: int) -> np.ndarray:
        return self.vecs[start:stop] / np.maximum(self.length[start:stop], EPS)[:, None]


class Queries(Rows):
    """A block of queries, lower bounds ``theta`` of their k-th best products and their k best so far, by score, then row."""

    def __init__(self, vecs: np.ndarray, ids: np.ndarray, names: np.ndarray, theta: np.ndarray, k: int):
        super().__init__(vecs, ids, names)
        unit = self.unit(0, len(ids))
        self.theta = theta.copy()
        self.focus = np.argsort(-np.abs(unit), axis=1)[:, :FOCUS].copy()
        self.coords = np.take_along_axis(unit, self.focus, 1)
        self.score, self.row, self.name = (np.full((len(ids), k), x) for x in (FREE_SCORE, FREE_ROW, 0))

    def add(self, i: np.ndarray, score: np.ndarray, row: np.ndarray, name: np.ndarray) -> None:
        """Puts products of the queries at places ``i`` among the k best."""
        last, at = self.score[i, -1], self.row[i, -1]
        new = ((score > last) | ((score == last) & (row < at))) & (row != self.ids[i])
        if not new.any():
            return
        i, score, row, name = i[new], score[new], row[new], name[new]
        k, changed = self.score.shape[1], np.unique(i)
        i = np.concatenate([np.repeat(changed, k), i])
        score = np.concatenate([self.score[changed].ravel(), score])
        row = np.concatenate([self.row[changed].ravel(), row])
        name = np.concatenate([self.name[changed].ravel(), name])
        o = np.lexsort((row, -score, i))
        i, score, row, name = i[o], score[o], row[o], name[o]
        first = np.flatnonzero(np.diff(i, prepend=-1))
        rank = np.arange(len(i)) - np.repeat(first, np.diff(first, append=len(i)))
        best = rank < k
        place = i[best], rank[best]
        self.score[place], self.row[place], self.name[place] = score[best], row[best], name[best]
        full = changed[self.row[changed, -1] != FREE_ROW]
        self.theta[full] = np.maximum(self.theta[full], self.score[full, -1])


def _kind(q: Rows, p: Rows) -> type:
    """The fastest type in which inner products are exact (missing components count as 0)."""
    bound = q.largest * p.largest * min(q.vecs.shape[1], p.vecs.shape[1])
    if bound >= 2**63:
        raise ValueError("inner products exceed 64 bits")
    return np.float32 if bound < 2**24 else np.float64 if bound < 2**53 else np.int64


def _products(q: Rows, p: Rows, rows=slice(None), start: int = 0, stop: int | None = None) -> np.ndarray:
    """Exact inner products of some queries and a range of vectors."""
    kind, dim = _kind(q, p), min(q.vecs.shape[1], p.vecs.shape[1])
    return q.of(kind)[rows, :dim] @ p.of(kind)[start:stop, :dim].T


def _seed_thresholds(q: Rows, seeds: Rows, k: int) -> np.ndarray:
    if len(seeds.ids) <= k:
        return np.full(len(q.ids), -np.inf)
    exact = _kind(q, seeds) is not np.int64
    s = _products(q, seeds).astype(np.float64)
    s[q.ids[:, None] == seeds.ids[None, :]] = -np.inf
    kth = np.partition(s, -k, axis=1)[:, -k]
    return kth if exact else np.nextafter(kth, -np.inf)


def _narrow(m: np.ndarray) -> np.ndarray:
    """The same numbers in as few bytes as they need."""
    low, high = m.min(initial=0), m.max(initial=0)
    return m.astype(next(t for t in (np.int16, np.int32, np.int64) if np.iinfo(t).min <= low and high <= np.iinfo(t).max))


def _pack(seeds: tuple | None, k: int, per: int):
    """mapInArrow: each partition as block rows of at most BLOCK_ROWS vectors, numbered (``per`` numbers for a partition), with the queries' first thresholds if there are ``seeds``."""

    def run(batches):
        import pyspark

        no = pyspark.TaskContext.get().partitionId() * per
        known = Rows(*seeds) if seeds is not None else None
        ids, names, mats, held = [], [], [], 0

        def blocks():
            nonlocal no
            if not held:
                return
            dim = max(m.shape[1] for m in mats)
            m = np.vstack([np.pad(x, ((0, 0), (0, dim - x.shape[1]))) for x in mats])
            parts = m, np.concatenate(ids), np.concatenate(names)
            for at in range(0, len(m), BLOCK_ROWS):
                b = Rows(*(x[at : at + BLOCK_ROWS] for x in parts))
                theta, reach = np.empty(0), float(b.length.max())
                if known is not None:
                    theta = _seed_thresholds(b, known, k)
                    need = np.where(theta > 0, theta / np.maximum(b.length, EPS), 0.0)
                    reach = float(need.min()) * (1 - EPS)
                row = {"no": no, "reach": reach, "n": len(b.ids), "dim": dim, "ids": b.ids.tobytes(), "names": b.names.tobytes(), "theta": theta.tobytes(), "vecs": _narrow(b.vecs).tobytes()}
                yield pa.RecordBatch.from_pylist([row], schema=BLOCK)
                no += 1

        for b in batches:
            if b.num_rows:
                ids.append(b.column("row").to_numpy(zero_copy_only=False))
                names.append(b.column("vec_id").to_numpy(zero_copy_only=False))
                mats.append(_matrix(b.column("v")))
                held += b.num_rows
                if held >= 16 * BLOCK_ROWS:
                    yield from blocks()
                    ids, names, mats, held = [], [], [], 0
        yield from blocks()

    return run


def search_block(q: Queries, p: Rows) -> None:
    """Adds the vectors of a block, which descend in length, to the k best of each query."""
    start, lowest = 0, p.ids.min()
    while start < len(p.ids):
        longest = p.length[start]
        stop = start + max(1, int(np.searchsorted(-p.length[start:], -BUCKET_SHARE * longest, side="right")))
        reach = q.length * longest
        local = np.where(q.theta <= 0, -1.0, np.where(reach > 0, q.theta / np.maximum(reach, EPS), np.inf))
        active = local <= 1 + EPS
        rows = np.flatnonzero(active & (local >= COORDINATE_FROM))
        if len(rows):
            active[_by_coordinate(q, p, rows, local[rows], start, stop)] = False
        rows = np.flatnonzero(active)
        if len(rows):
            _by_length(q, p, rows, start, stop, lowest)
        start = stop


def _by_coordinate(q: Queries, p: Rows, rows: np.ndarray, local: np.ndarray, start: int, stop: int) -> np.ndarray:
    """Searches a bucket for those of the queries that coordinates prune well, and returns which they are."""
    n, dim = stop - start, p.vecs.shape[1]
    order, flat = p.columns(start, stop)
    t, c, focus = np.minimum(1.0, local)[:, None], q.coords[rows], q.focus[rows]
    spread = np.sqrt(1 - t * t) * np.sqrt(np.maximum(0, 1 - c * c))
    low = np.where(c < -t, -1.0, c * t - spread) - 1e-7
    high = np.where(c > t, 1.0, c * t + spread) + 1e-7
    f = focus[:, 0]
    first = np.searchsorted(flat, low[:, 0] + 4.0 * f, "left") - f * n
    last = np.searchsorted(flat, high[:, 0] + 4.0 * f, "right") - f * n
    # shorter vectors have no such coordinate
    few = np.flatnonzero((last - first <= NARROW * n) & (focus.max(axis=1) < dim))
    left = (last - first)[few]
    j = np.repeat(few, left)
    at = start + order[f[j], np.arange(len(j)) + np.repeat(first[few] - np.cumsum(left) + left, left)]
    for g in range(1, focus.shape[1]):
        u = p.vecs[at, focus[j, g]] / np.maximum(p.length[at], EPS)
        fits = (u >= low[j, g]) & (u <= high[j, g])
        j, at = j[fits], at[fits]
    kind, dim, step = _kind(q, p), min(q.vecs.shape[1], dim), max(1, PAIR_VALUES // max(1, dim))
    for k in range(0, len(j), step):
        i, v = rows[j[k : k + step]], at[k : k + step]
        s = np.einsum("ij,ij->i", q.of(kind)[i, :dim], p.of(kind)[v, :dim])
        keep = s >= q.theta[i]
        q.add(i[keep], s[keep].astype(np.int64), p.ids[v[keep]], p.names[v[keep]])
    return rows[few]


def _by_length(q: Queries, p: Rows, rows: np.ndarray, start: int, stop: int, lowest: int) -> None:
    """Searches the vectors of a bucket that are long enough for some of the queries."""
    theta = q.theta[rows]
    least = np.where(theta > 0, theta / np.maximum(q.length[rows], EPS), 0.0)
    n = int(np.searchsorted(-p.length[start:stop], -least.min() * (1 - EPS), side="right"))
    s = _products(q, p, rows, start, start + n)
    floor = theta
    if s.dtype != np.int64:
        floor = theta.astype(s.dtype)
        floor = np.where(floor > theta, np.nextafter(floor, s.dtype.type(-np.inf)), floor)
        # where no row of the block comes before the k-th best, equal products do not count
        later = (q.row[rows, -1] < lowest) & (q.score[rows, -1] == theta)
        floor = np.where(later, np.nextafter(floor, s.dtype.type(np.inf)), floor)
    at = np.flatnonzero(s >= floor[:, None])
    if len(at):
        i, j = np.divmod(at, n)
        q.add(rows[i], s.ravel()[at].astype(np.int64), p.ids[start + j], p.names[start + j])


HITS = pa.schema([(c, pa.int64()) for c in ("query_row", "query_id", "row", "vec_id", "score")])


def _search(k: int):
    """mapInArrow over block rows in the order of cells, queries first: the k best of each query in each cell."""

    def found(asked):
        for q in asked:
            i, j = np.nonzero(q.row != FREE_ROW)
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (q.ids[i], q.names[i], q.row[i, j], q.name[i, j], q.score[i, j])], schema=HITS)

    def run(batches):
        cell, asked = None, []
        for b in batches:
            for j in range(b.num_rows):
                at, vectors, n, dim, ids, names, theta, vecs = (b.column(c)[j].as_py() for c in ("cell", "vectors", "n", "dim", "ids", "names", "theta", "vecs"))
                if at != cell:
                    yield from found(asked)
                    cell, asked = at, []
                kind = f"i{len(vecs) // (n * dim)}" if dim else "i2"
                rows = np.frombuffer(vecs, kind).reshape(n, dim), np.frombuffer(ids, np.int64), np.frombuffer(names, np.int64)
                if not vectors:
                    asked.append(Queries(*rows, np.frombuffer(theta, np.float64), k))
                elif asked:
                    p = Rows(*rows)
                    for q in asked:
                        search_block(q, p)
        yield from found(asked)

    return run


def _blocks(df: DataFrame, ranges: int, rows: int, seeds, k: int) -> DataFrame:
    ranges = max(1, min(MAX_RANGES, ranges))
    dealt = df.repartitionByRange(ranges, F.desc("n2"), "row").sortWithinPartitions(F.desc("n2"), "row")
    return dealt.select("row", "vec_id", "v").mapInArrow(_pack(seeds, k, math.ceil(rows / ranges / BLOCK_ROWS)), BLOCK_DDL)


def _seeds(vectors: DataFrame) -> tuple[np.ndarray, ...]:
    """The longest vectors and their rows: tasks send the driver lengths, then SEED_ROWS vectors in all."""
    far = vectors.select("n2", "row").orderBy(F.desc("n2"), "row").limit(SEED_ROWS).collect()
    if not far:
        return np.empty((0, 0), np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    last = far[-1]
    top = vectors.where((F.col("n2") > last["n2"]) | ((F.col("n2") == last["n2"]) & (F.col("row") <= last["row"]))).select("row", "vec_id", "v").collect()
    dim = max(len(r["v"]) for r in top)
    vecs = np.array([list(r["v"]) + [0] * (dim - len(r["v"])) for r in top], np.int64).reshape(len(top), dim)
    return vecs, np.array([r["row"] for r in top], np.int64), np.array([r["vec_id"] for r in top], np.int64)


def top_k(queries: DataFrame, vectors: DataFrame, k: int = 5) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: each query's k highest integer inner products over every row but its own.

    ``vectors`` comes from :func:`quantise`, ``queries`` are some of its rows.
    Ties go to the smaller id; a query with fewer than k candidates returns
    all of them; of rows that share an id each is a query and a candidate of
    its own; vectors of unequal size are compared as if the shorter one ended
    in zeros.  Empty tables give no rows.  The hits are written once.

    Scale: a task holds the queries of a cell (QUERY_BYTES at most) and one
    block of vectors.  Each vector is moved once for every group of queries
    that it is long enough for, each query once for every group of vectors;
    per cell a query returns at most k rows.  No block passes through the
    driver: it gets SEED_ROWS vectors, one number for each group of queries,
    and a sample of lengths for at most MAX_RANGES ranges.
    """
    spark = vectors.sparkSession
    n, dim = vectors.agg(F.count("*"), F.max(F.size("v"))).first()
    nq, dim, cores = queries.count(), max(1, dim or 0), spark.sparkContext.defaultParallelism
    most, most_queries = (max(BLOCK_ROWS, size // (8 * dim)) for size in (GROUP_BYTES, QUERY_BYTES))
    groups = max(1, math.ceil(n / most), min(math.ceil(n / BLOCK_ROWS), GROUPS_PER_CORE * cores))
    sides = max(1, math.ceil(nq / most_queries))
    with small_batches(spark):
        asked = freeze(_blocks(queries, max(sides, min(math.ceil(nq / BLOCK_ROWS), cores)), nq, _seeds(vectors), k), "asked").withColumn("side", F.pmod("no", F.lit(sides)))
        least = {r["side"]: r["least"] for r in asked.groupBy("side").agg(F.min("reach").alias("least")).collect()}
        reached = F.filter(F.sequence(F.lit(0), F.lit(sides - 1)), lambda side: F.element_at(F.array(*[F.lit(least.get(i, math.inf)) for i in range(sides)]), side + 1) <= F.col("reach"))
        asked = asked.withColumn("group", F.explode(F.sequence(F.lit(0), F.lit(groups - 1)))).withColumn("vectors", F.lit(False))
        probes = _blocks(vectors, groups, n, None, k).withColumn("side", F.explode(reached)).withColumn("group", F.pmod("no", F.lit(groups))).withColumn("vectors", F.lit(True))
        met = [x.select((F.col("group") * sides + F.col("side")).cast("long").alias("cell"), "vectors", "no", "n", "dim", "ids", "names", "theta", "vecs") for x in (asked, probes)]
        tasks = min(MAX_TASKS, groups * sides)
        cells = met[0].unionByName(met[1]).repartitionById(tasks, F.pmod("cell", F.lit(tasks)).cast("int")).sortWithinPartitions("cell", "vectors", "no")
        hits = cells.mapInArrow(_search(k), "query_row long, query_id long, row long, vec_id long, score long")
        w = Window.partitionBy("query_row").orderBy(F.desc("score"), "row")
        best = hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
        return freeze(best.select("query_id", "rank", "vec_id", "score"), "hits")
