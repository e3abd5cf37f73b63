"""MaxSim (G3) over whole Arrow batches with numpy.

Spark's higher-order functions evaluate the inner token-pair lambda one
element at a time; a per-row matrix product is one BLAS call.  These
kernels take the same columns as ``vector.maxsim`` / ``vector.maxsim_codes``
and return the same numbers (identical for packed codes, equal to 1e-12 for
floats).  Rows with an empty or null side score 0.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def _nested(arr: pa.Array, dtype):
    """(row offsets into token rows, token matrix) of a list<list<x>> array
    whose inner lists all have the same length."""
    arr = arr.cast(pa.list_(pa.list_(pa.from_numpy_dtype(dtype))))
    outer = arr.offsets.to_numpy().astype(np.int64)
    outer = outer - outer[0]
    inner = arr.flatten()
    vals = inner.flatten().to_numpy(zero_copy_only=False).astype(dtype)
    width = (len(vals) // len(inner)) if len(inner) else 0
    if len(inner) and width * len(inner) != len(vals):
        raise ValueError("token vectors of different lengths in one batch")
    valid = ~np.asarray(arr.is_null().to_numpy(zero_copy_only=False), dtype=bool)
    return outer, vals.reshape(len(inner), width), valid


# Token pairs that are scored at once.
PAIR_CELLS = 1 << 20


def _spans(nq: np.ndarray, nd: np.ndarray):
    """Cuts rows into runs of at most PAIR_CELLS token pairs (one row at least)."""
    cells = np.cumsum(nq * nd)
    start = 0
    while start < len(cells):
        before = cells[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(cells, before + PAIR_CELLS, side="right")))
        yield start, stop
        start = stop


def _best_sums(qo, do, valid, pair_scores) -> np.ndarray:
    """Per row: for each query token the best of ``pair_scores(query token
    index, document token index)`` over the row's document tokens, summed.
    All rows of a run are scored in one vector operation."""
    nq, nd = np.where(valid, np.diff(qo), 0), np.where(valid, np.diff(do), 0)
    out = np.zeros(len(nq), np.float64)
    rows = np.flatnonzero((nq > 0) & (nd > 0))
    nq, nd, q0, d0 = nq[rows], nd[rows], qo[:-1][rows], do[:-1][rows]
    for s, e in _spans(nq, nd):
        a, b = nq[s:e], nd[s:e]
        owner = np.repeat(np.arange(e - s), a)  # of each query token
        first = np.cumsum(a) - a
        qi = q0[s:e][owner] + np.arange(len(owner)) - first[owner]
        width = b[owner]  # document tokens beside it
        starts = np.cumsum(width) - width
        pair = np.repeat(np.arange(len(owner)), width)
        di = d0[s:e][owner][pair] + np.arange(len(pair)) - starts[pair]
        best = np.maximum.reduceat(pair_scores(qi[pair], di), starts)
        out[rows[s:e]] = np.add.reduceat(best, first)
    return out


def codes_kernel(dim: int):
    def run(q: pa.Array, d: pa.Array) -> pa.Array:
        qo, qm, qv = _nested(q, np.int64)
        do, dm, dv = _nested(d, np.int64)
        qm, dm = qm.view(np.uint64), dm.view(np.uint64)

        def agreement(i, j):
            ham = np.zeros(len(i), np.int64)
            for w in range(qm.shape[1]):
                ham += np.bitwise_count(qm[i, w] ^ dm[j, w])
            return dim - 2 * ham

        return pa.array(_best_sums(qo, do, qv & dv, agreement) / dim, pa.float64())

    return run


def _unit(m: np.ndarray) -> np.ndarray:
    n = np.sqrt((m * m).sum(axis=1, keepdims=True))
    return np.divide(m, n, out=np.zeros_like(m), where=n > 0)


def float_kernel(normalize: bool):
    def run(q: pa.Array, d: pa.Array) -> pa.Array:
        qo, qm, qv = _nested(q, np.float64)
        do, dm, dv = _nested(d, np.float64)
        if normalize:
            qm, dm = _unit(qm), _unit(dm)
        nq, nd = np.diff(qo), np.diff(do)
        if len(q) and qv.all() and dv.all() and nq.min() == nq.max() > 0 and nd.min() == nd.max() > 0:
            # every row has the same shapes: one batched product for the batch
            a = qm.reshape(len(q), nq[0], -1)
            b = dm.reshape(len(q), nd[0], -1)
            return pa.array((a @ b.transpose(0, 2, 1)).max(axis=2).sum(axis=1), pa.float64())
        return pa.array(_best_sums(qo, do, qv & dv, lambda i, j: np.einsum("ij,ij->i", qm[i], dm[j])), pa.float64())

    return run


@lru_cache(maxsize=None)
def _codes_udf(dim: int):
    return F.arrow_udf(codes_kernel(dim), DoubleType())


@lru_cache(maxsize=None)
def _float_udf(normalize: bool):
    return F.arrow_udf(float_kernel(normalize), DoubleType())


def maxsim_codes(q, d, dim: int) -> Column:
    return _codes_udf(dim)(q, d)


def maxsim(q, d, normalize_tokens: bool = True) -> Column:
    return _float_udf(normalize_tokens)(q, d)
