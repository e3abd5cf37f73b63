"""Column expressions over vectors, binary codes and token matrices.

Everything here returns a ``pyspark.sql.Column`` built from Spark's higher-order
array functions, so it runs inside the JVM next to the scan and never leaves
the executor.  Shapes used across the package:

* dense vector      ``ARRAY<FLOAT|DOUBLE>`` (any dimension)
* 1-bit code        ``ARRAY<BIGINT>``: bit ``i`` of the vector lives in word
                    ``i div 64`` at position ``i mod 64`` (LSB first); the bit
                    is set when the component is strictly positive.
* token matrix      ``ARRAY<ARRAY<FLOAT|DOUBLE>>`` (one row per token), or its
                    lossless packed form for +-1 token vectors,
                    ``ARRAY<ARRAY<BIGINT>>`` (one code per token).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

WORD_BITS = 64


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value, fn) -> Column:
    """Evaluate ``value`` once and pass it to ``fn`` (Spark does not share
    common subexpressions inside lambdas, so this avoids recomputing e.g. a
    norm for every element)."""
    return F.element_at(F.transform(F.array(value), fn), 1)


def dot(a, b) -> Column:
    """G1: sum_i a[i] * b[i], accumulated in double."""
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")),
        F.lit(0.0).cast("double"),
        lambda acc, v: acc + v,
    )


def sq_norm(v) -> Column:
    return F.aggregate(
        _col(v), F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double")
    )


def norm(v) -> Column:
    return F.sqrt(sq_norm(v))


def normalize(v) -> Column:
    """V / |v|; a zero vector stays zero instead of turning into NaN."""
    vec = _col(v)
    return let(
        norm(vec),
        lambda n: F.transform(vec, lambda x: F.when(n > 0, x.cast("double") / n).otherwise(F.lit(0.0))),
    )


def cosine(a, b) -> Column:
    """dot(a, b) / (|a| |b|); 0 when either side has zero norm."""
    den = norm(a) * norm(b)
    return F.when(den > 0, dot(a, b) / den).otherwise(F.lit(0.0))


def sum_vectors(mat, dim: int) -> Column:
    """Element-wise sum of the rows of a matrix (double accumulation)."""
    zero = F.array_repeat(F.lit(0.0).cast("double"), dim)
    return F.aggregate(
        _col(mat), zero, lambda acc, row: F.zip_with(acc, row, lambda x, y: x + y.cast("double"))
    )


def n_words(dim: int) -> int:
    return (dim + WORD_BITS - 1) // WORD_BITS


def binary_code(v, dim: int) -> Column:
    """Pack the signs of ``v`` (``x > 0`` -> 1) into ceil(dim/64) BIGINT words."""
    vec = _col(v)
    words = []
    for w in range(n_words(dim)):
        lo, width = w * WORD_BITS, min(WORD_BITS, dim - w * WORD_BITS)
        part = F.slice(vec, lo + 1, width)
        bits = F.transform(
            part,
            lambda x, i: F.when(x > 0, F.call_function("shiftleft", F.lit(1).cast("long"), i)).otherwise(
                F.lit(0).cast("long")
            ),
        )
        words.append(F.aggregate(bits, F.lit(0).cast("long"), lambda acc, b: acc.bitwiseOR(b)))
    return F.array(*words)


def popcount(code) -> Column:
    """Number of set bits over all words of a code."""
    return F.aggregate(
        F.transform(_col(code), lambda w: F.bit_count(w).cast("int")), F.lit(0), lambda a, b: a + b
    )


def hamming(a, b) -> Column:
    """Number of disagreeing bits between two codes of equal length."""
    return F.aggregate(
        F.zip_with(_col(a), _col(b), lambda x, y: F.bit_count(x.bitwiseXOR(y)).cast("int")),
        F.lit(0),
        lambda acc, v: acc + v,
    )


def maxsim(q, d, normalize_tokens: bool = True) -> Column:
    """G3 for float token matrices: sum over query tokens of the best dot
    product with any document token.  With ``normalize_tokens`` every token
    vector is first scaled to unit length, i.e. the per-pair similarity is the
    cosine.  An empty side scores 0."""
    qm, dm = _col(q), _col(d)
    if normalize_tokens:
        qm = F.transform(qm, lambda t: normalize(t))
        dm = F.transform(dm, lambda t: normalize(t))

    def score(dmat):
        best = F.transform(qm, lambda a: F.array_max(F.transform(dmat, lambda b: dot(a, b))))
        return F.aggregate(best, F.lit(0.0).cast("double"), lambda acc, x: acc + x)

    return F.coalesce(let(dm, score), F.lit(0.0))


def hamming_fixed(a, b, n_words: int) -> Column:
    """G2 for codes of a known word count, without building arrays (cheap
    enough for the innermost lambda of MaxSim)."""
    terms = [F.bit_count(a[w].bitwiseXOR(b[w])).cast("int") for w in range(n_words)]
    out = terms[0]
    for t in terms[1:]:
        out = out + t
    return out


def maxsim_codes(q, d, dim: int) -> Column:
    """G3 for token vectors with components +-1/sqrt(dim), stored as packed
    sign codes.  The cosine of two such tokens is ``1 - 2*ham/dim``, so the
    score is ``sum_q max_d (dim - 2*ham) / dim``: an exact dyadic number that
    does not depend on summation order.  Duplicate document tokens do not change
    the max, so callers may pass ``array_distinct`` of the document side (it is
    evaluated once per row, not once per query token)."""
    words = n_words(dim)

    def score(dmat):
        best = F.transform(
            _col(q),
            lambda a: F.array_max(F.transform(dmat, lambda b: F.lit(dim) - F.lit(2) * hamming_fixed(a, b, words))),
        )
        return F.aggregate(best, F.lit(0).cast("long"), lambda acc, x: acc + x.cast("long"))

    return F.coalesce(let(_col(d), score).cast("double") / F.lit(float(dim)), F.lit(0.0))
