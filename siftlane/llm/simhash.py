"""SimHash near-duplicates through a segment-popcount grid (operator 4).

*Fingerprints.* Whole texts, word shingles, XXH64; a bit is set if it is set
in over half of the shingle hashes.

*Embedding.* A fingerprint is cut into segments, and its bit counts per
segment are a point in a small grid.  The Manhattan distance of two points is
a lower bound of the Hamming distance of their fingerprints.

*Grid range-join.* If two points are at most D apart, then in one half of the
segments they are at most D // 2 apart.  So every distinct fingerprint stands
in one cell per half, and visits the cells of that half within D // 2; pairs
that meet there are tested by the whole Manhattan distance and then exactly.

*Groups.* A cell does not emit its pairs.  It is worked in bounded blocks,
each of which returns a star per connected part (at most one edge for each
fingerprint), so a dense group costs edges in proportion to its size.  Cells
over the block size are dealt out as pairs of blocks.  The stars are joined to
components by alternating large-star and small-star steps.
"""

from __future__ import annotations

import re
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import UPPER, per_batch

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 3
#: Bits of a segment; finer segments make smaller cells and more visits.
SEGMENT_BITS = 4
#: Fingerprints of a block: a task holds two blocks at a time.
BLOCK = 2048

LOWER = str.maketrans(UPPER, UPPER.lower())
WORD_BREAK = re.compile("[\x20\x09-\x0d]+")


# ---- fingerprints ----------------------------------------------------------


def shingle_hashes(text: str, words: int = SHINGLE_WORDS) -> np.ndarray:
    """Unsigned XXH64 of each word shingle of a whole text, repeats included."""
    import xxhash

    h = xxhash.xxh64_intdigest
    w = [x for x in WORD_BREAK.split(text.translate(LOWER)) if x]
    if not w:
        return np.empty(0, np.uint64)
    if len(w) <= words:
        return np.array([h(" ".join(w), SEED)], np.uint64)
    joined = " ".join(w).encode()
    spaces = np.flatnonzero(np.frombuffer(joined, np.uint8) == 32)
    starts = [0, *(spaces + 1).tolist()]
    ends = [*spaces.tolist(), len(joined)]
    return np.fromiter((h(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1 :])), np.uint64, len(w) - words + 1)


def majority(hashes: np.ndarray, slice_rows: int = 1 << 16) -> int:
    """The fingerprint: bits set in over half of ``hashes``; zero for none."""
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), slice_rows):
        part = hashes[at : at + slice_rows]
        ones += np.unpackbits(part.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(sum(1 << i for i in np.flatnonzero(2 * ones > len(hashes)).tolist()))


def fingerprints(docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, carry: str | None = None) -> DataFrame:
    """``(doc_id, fp)`` and the string column ``carry``, one row per input row; ``fp`` is the fingerprint as a signed 64-bit integer."""
    more = [carry] if carry else []
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64()), *((c, pa.string()) for c in more)])

    def rows(ids, texts, *carried):
        fps = np.array([majority(shingle_hashes(t or "", words)) for t in texts], np.uint64)
        return {"doc_id": ids, "fp": fps.view(np.int64), **dict(zip(more, carried))}

    ddl = ", ".join(["doc_id long", "fp long", *(f"`{c}` string" for c in more)])
    return docs.select(F.col(id).cast("long").alias("doc_id"), text, *more).mapInArrow(per_batch(rows, "doc_id", text, *more, schema=schema), ddl)


# ---- grid ------------------------------------------------------------------


def popcounts(fps: np.ndarray, bits: int = SEGMENT_BITS) -> np.ndarray:
    """Bit counts of each segment, the lowest first: one row per fingerprint."""
    x = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return x.reshape(len(fps), 64 // bits, bits).sum(2, dtype=np.int64)


def moves(dims: int, radius: int) -> np.ndarray:
    """All integer vectors of ``dims`` components whose absolute values add up to at most ``radius``."""
    out = [np.zeros(dims, np.int64)]
    seen = {tuple(out[0])}
    for _ in range(radius):
        for v in list(out):
            for i, s in product(range(dims), (-1, 1)):
                u = v.copy()
                u[i] += s
                if tuple(u) not in seen:
                    seen.add(tuple(u))
                    out.append(u)
    return np.array(out)


def cell_visits(fps: np.ndarray, max_bits: int = MAX_BITS, bits: int = SEGMENT_BITS) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(cell, home, fingerprint)`` of every visit: in each half the own cell (home) and those within half the distance."""
    counts = popcounts(fps, bits)
    half = counts.shape[1] // 2
    step = moves(half, max_bits // 2)
    base = bits + 1
    weights = base ** np.arange(half, dtype=np.int64)
    cells, homes, owners = [], [], []
    for side in (0, 1):
        points = counts[:, side * half : (side + 1) * half]
        for k, m in enumerate(step):
            to = points + m
            fine = ((to >= 0) & (to <= bits)).all(1)
            cells.append((to[fine] @ weights) * 2 + side)
            homes.append(np.full(int(fine.sum()), k == 0))
            owners.append(fps[fine])
    return np.concatenate(cells), np.concatenate(homes), np.concatenate(owners)


def _visits(max_bits: int, bits: int):
    def run(batches):
        for b in batches:
            fps = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for at in range(0, len(fps), 4096):
                cell, home, fp = cell_visits(fps[at : at + 4096], max_bits, bits)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(home), pa.array(fp.view(np.int64))], names=["cell", "home", "fp"])

    return run


def stars(homes: np.ndarray, visitors: np.ndarray, max_bits: int = MAX_BITS, bits: int = SEGMENT_BITS, rows: int = 256) -> list[tuple[np.ndarray, np.ndarray]]:
    """Edges that connect what pairs of ``homes`` and ``visitors`` within ``max_bits`` connect: from each node to the least of its part."""
    nodes, inverse = np.unique(np.concatenate([homes, visitors]), return_inverse=True)
    h, v = inverse[: len(homes)], inverse[len(homes) :]
    ph, pv = popcounts(homes, bits).astype(np.int8), popcounts(visitors, bits).astype(np.int8)
    label = np.arange(len(nodes))
    near = []
    for at in range(0, len(homes), rows):
        # Manhattan distance of the embeddings first, the fingerprints only where it allows them
        bound = np.zeros((len(homes[at : at + rows]), len(visitors)), np.int16)
        for d in range(ph.shape[1]):
            bound += np.abs(ph[at : at + rows, d, None] - pv[None, :, d])
        i, j = np.nonzero(bound <= max_bits)
        fine = (np.bitwise_count(homes[at + i] ^ visitors[j]) <= max_bits) & (h[at + i] != v[j])
        near.append(np.stack([h[at + i[fine]], v[j[fine]]]))
    a, b = np.concatenate(near, axis=1) if near else np.empty((2, 0), np.int64)
    if not len(a):
        return nodes[:0], nodes[:0]
    while True:
        least = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], least)
        np.minimum.at(new, label[b], least)
        new = new[new][label]
        if (new == label).all():
            break
        label = new
    moved = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[moved], nodes[label[moved]]


def _meet(max_bits: int, bits: int):
    """mapInArrow over rows sorted by group: the stars of each group."""

    def run(batches):
        key, parts = None, []  # of the group that is being read: its rows' home flags and fingerprints

        def done():
            home = np.concatenate([p[0] for p in parts]) if parts else np.empty(0, bool)
            if home.any() and not home.all():
                fp = np.concatenate([p[1] for p in parts])
                u, v = stars(fp[home], fp[~home], max_bits, bits)
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], names=["u", "v"])

        for b in batches:
            cols = {c: b.column(c).to_numpy(zero_copy_only=False) for c in ("cell", "i", "j", "home", "fp")}
            new = np.zeros(max(0, b.num_rows - 1), bool)
            for c in ("cell", "i", "j"):
                new |= cols[c][1:] != cols[c][:-1]
            edges = [0, *(np.flatnonzero(new) + 1).tolist(), b.num_rows]
            home, fp = cols["home"].astype(bool), cols["fp"].view(np.uint64)
            for start, stop in zip(edges, edges[1:]):
                if start == stop:
                    continue
                group = (cols["cell"][start], cols["i"][start], cols["j"][start])
                if group != key:
                    yield from done()
                    key, parts = group, []
                parts.append((home[start:stop], fp[start:stop]))
        yield from done()

    return run


def links(distinct: DataFrame, max_bits: int = MAX_BITS, bits: int = SEGMENT_BITS, block: int = BLOCK) -> DataFrame:
    """``(u, v)``: edges between distinct fingerprints that connect exactly those that pairs within ``max_bits`` connect."""
    visits = distinct.select("fp").mapInArrow(_visits(max_bits, bits), "cell long, home boolean, fp long")
    visits = freeze(visits, "visits")
    sizes = visits.groupBy("cell").agg(F.count_if("home").alias("homes"), F.count("*").alias("all"))
    # a cell needs a home and someone else; large ones are cut into blocks by hash
    sizes = sizes.where("homes > 0 and all > 1").select(
        "cell", F.ceil(F.col("homes") / block).cast("int").alias("n_i"), F.ceil(F.col("all") / block).cast("int").alias("n_j")
    )
    rows = visits.join(sizes, "cell")
    # a home stands in its block of homes for all blocks of visitors, and is itself a visitor
    as_home = rows.where("home").select("cell", F.pmod(F.xxhash64("fp"), F.col("n_i")).cast("int").alias("i"), F.explode(F.sequence(F.lit(0), F.col("n_j") - 1)).alias("j"), F.lit(True).alias("home"), "fp")
    as_visitor = rows.select("cell", F.explode(F.sequence(F.lit(0), F.col("n_i") - 1)).alias("i"), F.pmod(F.xxhash64("fp"), F.col("n_j")).cast("int").alias("j"), F.lit(False).alias("home"), "fp")
    met = as_home.unionByName(as_visitor)
    n = int(distinct.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    met = met.repartition(n, "cell", "i", "j").sortWithinPartitions("cell", "i", "j")
    return met.mapInArrow(_meet(max_bits, bits), "u long, v long").distinct()


# ---- components ------------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` of every node of ``edges (u, v)``: the least node of its component.

    Alternating large-star and small-star steps; each keeps the components and
    shortens the paths to their least nodes.  Every round is written to the
    shared folder, and ends when a round changes nothing."""
    e = freeze(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    last = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        kept = large.join(low, "u")
        small = kept.select(F.explode(F.array(F.struct("u", F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e"))
        e = freeze(small.select("e.u", "e.v").where("u <> v").distinct(), "edges")
        now = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now == last:
            break
        last = now
    return e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())


def _classes(per_fp: DataFrame, max_bits: int, bits: int) -> DataFrame:
    """``per_fp`` with ``root``, which the distinct fingerprints of a group share."""
    roots = freeze(components(links(per_fp, max_bits, bits)), "roots")
    return per_fp.join(roots, per_fp["fp"] == roots["node"], "left").drop("node").withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bits: int = SEGMENT_BITS
) -> DataFrame:
    """``(doc_id, fingerprint, component_id)``, one row per input row.

    Fingerprints link at ``max_bits`` or fewer differing bits; ``component_id``
    is the smallest doc_id that links reach.  A null text counts as empty;
    texts without words share the fingerprint zero, which links like any other.
    A row without an id has no component_id unless a linked row has an id."""
    marks = freeze(fingerprints(docs, id, text, words), "fingerprints")
    per_fp = freeze(marks.groupBy("fp").agg(F.min("doc_id").alias("least")), "distinct_fps")
    tagged = _classes(per_fp, max_bits, bits).select("fp", "least", "root")
    ids = tagged.groupBy("root").agg(F.min("least").alias("component_id"))
    classes = tagged.join(ids, "root").select("fp", "component_id")
    return marks.join(classes, "fp").select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def without_near_duplicates(
    docs: DataFrame, id: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS, max_bits: int = MAX_BITS, bits: int = SEGMENT_BITS
) -> DataFrame:
    """One row of ``docs`` per group of rows whose fingerprints link, with all its columns.

    It is the row with the smallest id (rows without one come last), then with
    the smallest digest of the whole row; ids may be null or repeated.  Rows
    with neither id nor text are no one's duplicates and stay."""
    blank = F.col(id).isNull() & F.col(text).isNull()
    keyed = docs.where(~blank).withColumn("__row", F.sha2(F.to_json(F.struct(*(F.col(f"`{c}`") for c in docs.columns))), 256))
    marks = fingerprints(keyed, id, text, words, carry="__row")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("unnamed"), "doc_id", "__row"))
    per_fp = freeze(marks.groupBy("fp").agg(first.alias("first")), "distinct_fps")
    stay = _classes(per_fp, max_bits, bits).groupBy("root").agg(F.min("first").alias("first")).select("first.__row")
    # rows alike in every column share their digest: one of them stays
    return keyed.join(freeze(stay, "representatives"), "__row", "left_semi").dropDuplicates(["__row"]).select(docs.columns).unionByName(docs.where(blank))
