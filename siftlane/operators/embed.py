"""Embedders (P3, P4, P5): text -> dense vector, 1-bit code, token matrix.

``HashEmbedder`` is the default and the tested one.  It is lexical, not
semantic: a token is an ASCII letter/digit run, lowercased; its vector is
the 128 bits of md5(token) read as +-1 (components +-1/sqrt(128) after
normalisation).  The token matrix is stored losslessly as packed sign codes
(two BIGINT words per token, bit i of the vector = bit i%64 of word i//64).
The dense vector is the element-wise sum of the token vectors (integers),
its code the sign bits of that sum.

Tokenising, md5 of the tokens and the per-dimension sum run in one Arrow UDF
over whole batches (re + hashlib + numpy): Spark has no vectorised "sum of
bit planes", and building token arrays and turning md5 hex into words with
string functions cost several times more than doing it in the batch.  The
Spark-expression forms (``text.words``, ``token_codes``) define the same
tokens and codes and are tested against the batch form.

``ModelEmbedder`` is the way for a real model: ``load`` makes it once in every
Python worker, and it gets batches of texts of about equal token numbers.
``ArrowModelEmbedder`` wraps a function that needs no loading.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType, IntegerType, LongType, StructField, StructType

from ..functions import text as T
from ..functions import vector as V

HASH_DIM = 128
HASH_WORDS = 2


def _md5_words(token: Column) -> Column:
    """Spark-expression form of one token's code (used for inspection; the
    embedder hashes whole Arrow batches in ``_hash_batch``)."""
    def words(m):
        def word(off):
            hi = F.conv(F.substring(m, off, 8), 16, 10).cast("long")
            lo = F.conv(F.substring(m, off + 8, 8), 16, 10).cast("long")
            return F.shiftleft(hi, 32).bitwiseOR(lo)

        return F.array(word(1), word(17))

    return V.let(F.md5(token), words)


def token_codes(tokens: Column) -> Column:
    """P4 (hash): ARRAY<STRING> tokens -> ARRAY<ARRAY<BIGINT>> sign codes."""
    return F.transform(tokens, _md5_words)


def _codes_array(words: np.ndarray, seg: np.ndarray) -> pa.Array:
    inner = pa.ListArray.from_arrays(
        pa.array(np.arange(0, 2 * len(words) + 1, 2, dtype=np.int32)),
        pa.array(words.view(np.int64).reshape(-1), pa.int64()),
    )
    return pa.ListArray.from_arrays(pa.array(seg.astype(np.int32)), inner)


# Tokens that are counted in one byte.
_BYTE_TOKENS = 255


def _dense_of(codes: np.ndarray, at: np.ndarray, seg: np.ndarray) -> pa.Array:
    """Per row, the sum of its +-1 token vectors (bit i of the vector is bit
    i%64 of word i//64).  ``at`` is each token's row of ``codes``.  Eight bits
    are counted in one number, a byte each, for runs of at most 255 tokens."""
    n_rows = len(seg) - 1
    n_tok = np.diff(seg)
    ones = np.zeros((n_rows, HASH_DIM), dtype=np.int64)
    if len(at):
        # little-endian bytes + LSB-first unpacking = word bits in order
        le = np.ascontiguousarray(codes, dtype="<u8").view(np.uint8).reshape(-1, 8 * HASH_WORDS)
        packed = np.unpackbits(le, axis=1, bitorder="little").view(np.uint64)
        pieces = -(-n_tok // _BYTE_TOKENS)
        owner = np.repeat(np.arange(n_rows), pieces)
        nth = np.arange(len(owner)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
        sums = np.add.reduceat(packed[at], seg[:-1][owner] + nth * _BYTE_TOKENS, axis=0)
        counts = sums.view(np.uint8).reshape(-1, HASH_DIM)
        full = n_tok > 0
        ones[full] = np.add.reduceat(counts, (np.cumsum(pieces) - pieces)[full], axis=0, dtype=np.int64)
    out = (2 * ones - n_tok[:, None]).astype(np.float32)
    flat = pa.array(out.reshape(-1), pa.float32())
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n_rows + 1) * HASH_DIM, HASH_DIM, dtype=np.int32)), flat)


def _sign_code(dense: pa.Array) -> pa.Array:
    """P7 in the batch: bit i set when component i > 0 (word i//64, LSB first)."""
    vals = dense.flatten().to_numpy(zero_copy_only=False).reshape(-1, HASH_DIM)
    bits = (vals > 0).astype(np.uint64)
    shifts = np.arange(64, dtype=np.uint64)
    words = np.stack([(bits[:, w * 64:(w + 1) * 64] << shifts).sum(axis=1, dtype=np.uint64)
                      for w in range(HASH_WORDS)], axis=1)
    return pa.ListArray.from_arrays(
        pa.array(np.arange(0, HASH_WORDS * len(vals) + 1, HASH_WORDS, dtype=np.int32)),
        pa.array(words.view(np.int64).reshape(-1), pa.int64()),
    )


# Bytes of tokens in lower case, all others as spaces: a token is a run of ASCII letters and digits (T.WORD_PATTERN).
_TOKEN_BYTES = bytes(c if re.match(T.WORD_PATTERN, chr(c)) else 32 for c in (ord(chr(b).lower()) if b < 128 else 32 for b in range(256)))


def _tokens(texts: list[str | None]) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct tokens of all texts, each token's number among them, and where each text's tokens begin."""
    raw = [(t or "").encode() for t in texts]
    blob = b" ".join(raw).translate(_TOKEN_BYTES)
    words = blob.split()
    inside = np.frombuffer(blob, np.uint8) != 32
    first = np.flatnonzero(inside & ~np.append(False, inside[:-1])) if len(inside) else np.empty(0, np.int64)
    rows = np.cumsum([0, *(len(x) + 1 for x in raw)])
    number = {w: i for i, w in enumerate(dict.fromkeys(words))}
    at = np.fromiter(map(number.__getitem__, words), np.int64, len(words))
    return list(number), at, np.searchsorted(first, rows).astype(np.int64)


# Characters of text that a kernel works on at once: bounds its memory for any batch.
SLICE_CHARS = 1 << 20


def _slices(texts: pa.Array):
    """Cuts an array of texts into runs of at most SLICE_CHARS characters (one row at least)."""
    sizes = np.cumsum(pc.fill_null(pc.utf8_length(texts), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    start = 0
    while start < len(texts):
        before = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, before + SLICE_CHARS, side="right")))
        yield texts[start:stop]
        start = stop


def _in_slices(kernel):
    def run(texts: pa.Array) -> pa.Array:
        parts = [kernel(t) for t in _slices(texts)]
        return pa.concat_arrays(parts) if parts else kernel(texts)

    return run


def _md5_codes(words: list[bytes]) -> np.ndarray:
    raw = b"".join([hashlib.md5(w).digest() for w in words])
    return np.frombuffer(raw, dtype=">u8").astype(np.uint64).reshape(-1, HASH_WORDS)


def _distinct(at: np.ndarray, seg: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first of equal tokens of each row, in order."""
    key = np.repeat(np.arange(len(seg) - 1), np.diff(seg)) * (int(at.max(initial=0)) + 1) + at
    first = np.sort(np.unique(key, return_index=True)[1])
    return at[first], np.searchsorted(first, seg)


def _hash_batch_for(side: str):
    """Arrow UDF body: dense vector and sign code from every token; the token
    matrix keeps repeats on the query side and each distinct token once on
    the document side (the max over document tokens does not change)."""

    def run(texts: pa.Array) -> pa.Array:
        words, at, seg = _tokens(texts.to_pylist())
        codes = _md5_codes(words)
        dense = _dense_of(codes, at, seg)
        n_tok = pa.array(np.diff(seg).astype(np.int32), pa.int32())
        own, own_seg = (at, seg) if side == "query" else _distinct(at, seg)
        return pa.StructArray.from_arrays([_codes_array(codes[own], own_seg), dense, _sign_code(dense), n_tok],
                                          names=["codes", "dense", "code", "n_tokens"])

    return _in_slices(run)


def _codes_for(side: str):
    """Token codes only: every token of a query, each distinct token of a document."""

    def run(texts: pa.Array) -> pa.Array:
        words, at, seg = _tokens(texts.to_pylist())
        own, own_seg = (at, seg) if side == "query" else _distinct(at, seg)
        return _codes_array(_md5_codes(words)[own], own_seg)

    return _in_slices(run)


_HASH_TYPE = StructType([
    StructField("codes", ArrayType(ArrayType(LongType()))), StructField("dense", ArrayType(FloatType())),
    StructField("code", ArrayType(LongType())), StructField("n_tokens", IntegerType()),
])
_hash_udfs = {side: F.arrow_udf(_hash_batch_for(side), _HASH_TYPE) for side in ("doc", "query")}
_codes_udfs = {side: F.arrow_udf(_codes_for(side), ArrayType(ArrayType(LongType()))) for side in ("doc", "query")}


class HashEmbedder:
    tok_kind = "codes"
    tok_dim = HASH_DIM
    dense_dim = HASH_DIM
    code_words = V.n_words(HASH_DIM)

    def encode_tokens(self, df: DataFrame, text_col: str, side: str = "doc", prefix: str = "") -> DataFrame:
        """Token matrix only (what MaxSim needs)."""
        return df.withColumn(f"{prefix}toks", _codes_udfs["query" if side == "query" else "doc"](F.col(text_col)))

    def encode(self, df: DataFrame, text_col: str = "text", side: str = "doc", prefix: str = "") -> DataFrame:
        """Adds ``{prefix}toks``, ``{prefix}dense``, ``{prefix}code`` and
        ``{prefix}n_tokens``.  Query side (P5) keeps repeated tokens (they
        count twice in MaxSim); document side stores each distinct token once
        (the max over document tokens does not change)."""
        out = df.withColumn("_h", _hash_udfs["query" if side == "query" else "doc"](F.col(text_col)))
        out = out.withColumn(f"{prefix}dense", F.col("_h.dense"))
        out = out.withColumn(f"{prefix}code", F.col("_h.code"))
        out = out.withColumn(f"{prefix}n_tokens", F.col("_h.n_tokens"))
        return out.withColumn(f"{prefix}toks", F.col("_h.codes")).drop("_h")


class ArrowModelEmbedder:
    """Wraps ``fn(texts: list[str]) -> (dense: np.ndarray[n, d],
    toks: list[np.ndarray[n_i, t]])`` as Arrow UDFs.  ``fn`` may be
    asymmetric: it receives ``side`` ('doc' or 'query') as a keyword."""

    tok_kind = "float"

    def __init__(self, fn: Callable, dense_dim: int, tok_dim: int):
        self.fn = fn
        self.dense_dim = dense_dim
        self.tok_dim = tok_dim
        self.code_words = V.n_words(dense_dim)

    def _udf(self, side: str):
        fn = self.fn

        def run(texts: pa.Array) -> pa.Array:
            dense, toks = fn(texts.to_pylist(), side=side)
            dense_arr = pa.array([np.asarray(v, dtype=np.float32).tolist() for v in dense], pa.list_(pa.float32()))
            tok_arr = pa.array(
                [np.asarray(m, dtype=np.float32).tolist() for m in toks], pa.list_(pa.list_(pa.float32()))
            )
            return pa.StructArray.from_arrays([dense_arr, tok_arr], names=["dense", "toks"])

        return F.arrow_udf(run, "struct<dense: array<float>, toks: array<array<float>>>")

    def encode_tokens(self, df: DataFrame, text_col: str, side: str = "doc", prefix: str = "") -> DataFrame:
        return self.encode(df, text_col, side, prefix).drop(f"{prefix}dense", f"{prefix}code", f"{prefix}n_tokens")

    def encode(self, df: DataFrame, text_col: str = "text", side: str = "doc", prefix: str = "") -> DataFrame:
        out = df.withColumn("_emb", self._udf(side)(F.col(text_col)))
        return (
            out.withColumn(f"{prefix}dense", F.col("_emb.dense"))
            .withColumn(f"{prefix}toks", F.col("_emb.toks"))
            .withColumn(f"{prefix}code", V.binary_code(F.col(f"{prefix}dense"), self.dense_dim))
            .withColumn(f"{prefix}n_tokens", F.size(f"{prefix}toks"))
            .drop("_emb")
        )


# Models that a Python worker has loaded, by the key of their embedder.
_LOADED = "_siftlane_models"


def _float_lists(rows: list[np.ndarray], width: int) -> pa.Array:
    """float32 vectors, one list a row, without a Python object per number."""
    flat = np.concatenate([np.asarray(r, np.float32).reshape(-1, width) for r in rows] or [np.empty((0, width), np.float32)])
    return pa.FixedSizeListArray.from_arrays(pa.array(flat.ravel()), width).cast(pa.list_(pa.float32()))


class ModelEmbedder:
    """P3-P5 through a model that is loaded once per worker.

    ``load()`` returns ``model(texts: list[str], side: str) -> (dense, toks)``
    with one float vector and one token matrix a text; ``side`` is 'doc' or
    'query', so encoders may be asymmetric.  A call gets texts of at most
    ``token_budget`` tokens in all, as ``count(text)`` estimates them (a longer
    text is a call of its own), the short ones first so that padding is little.
    ``key`` names the model: workers keep it loaded under that name.  A null
    text counts as empty; a vector of another size fails the job."""

    tok_kind = "float"

    def __init__(self, load: Callable, dense_dim: int, tok_dim: int, key: str, token_budget: int = 16_384, count: Callable[[str], int] | None = None):
        self.load, self.key, self.token_budget = load, key, token_budget
        self.count = count or (lambda t: len(t.split()) + 1)
        self.dense_dim, self.tok_dim, self.code_words = dense_dim, tok_dim, V.n_words(dense_dim)

    def calls(self, texts: list[str]) -> Iterator[list[int]]:
        """The texts of each call, by number."""
        sizes = [self.count(t) for t in texts]
        held, tokens = [], 0
        for i in sorted(range(len(texts)), key=lambda i: (sizes[i], i)):
            if held and tokens + sizes[i] > self.token_budget:
                yield held
                held, tokens = [], 0
            held.append(i)
            tokens += sizes[i]
        if held:
            yield held

    def _model(self):
        import sys
        import types

        loaded = sys.modules.setdefault(_LOADED, types.ModuleType(_LOADED)).__dict__
        if self.key not in loaded:
            loaded[self.key] = self.load()
        return loaded[self.key]

    def _run(self, side: str, text_col: str, prefix: str):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model = None
            for b in batches:
                model = model or self._model()
                texts = [t or "" for t in b.column(text_col).to_pylist()]
                dense: list = [None] * len(texts)
                toks: list = [None] * len(texts)
                for call in self.calls(texts):
                    got = model([texts[i] for i in call], side)
                    for i, d, m in zip(call, *got):
                        dense[i], toks[i] = np.asarray(d, np.float32), np.asarray(m, np.float32).reshape(-1, self.tok_dim)
                        if dense[i].shape != (self.dense_dim,):
                            raise ValueError(f"the model's vectors must have {self.dense_dim} components")
                offsets = np.cumsum([0, *map(len, toks)]).astype(np.int32)
                matrices = pa.ListArray.from_arrays(pa.array(offsets), _float_lists(toks, self.tok_dim))
                yield pa.RecordBatch.from_arrays([*b.columns, _float_lists(dense, self.dense_dim), matrices], names=[*b.schema.names, f"{prefix}dense", f"{prefix}toks"])

        return run

    def encode_tokens(self, df: DataFrame, text_col: str, side: str = "doc", prefix: str = "") -> DataFrame:
        return self.encode(df, text_col, side, prefix).drop(f"{prefix}dense", f"{prefix}code", f"{prefix}n_tokens")

    def encode(self, df: DataFrame, text_col: str = "text", side: str = "doc", prefix: str = "") -> DataFrame:
        """``df`` with ``{prefix}dense``, ``{prefix}toks``, ``{prefix}code`` and ``{prefix}n_tokens``; columns of these names are replaced."""
        df = df.drop(*(prefix + c for c in ("dense", "toks", "code", "n_tokens")))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
        out = df.mapInArrow(self._run(side, text_col, prefix), f"{ddl}, `{prefix}dense` array<float>, `{prefix}toks` array<array<float>>")
        return out.withColumn(f"{prefix}code", V.binary_code(F.col(f"{prefix}dense"), self.dense_dim)).withColumn(f"{prefix}n_tokens", F.size(f"{prefix}toks"))


# A small model with fixed weights: a token's vector adds up one row of weights for each of its letters and digits.
LETTERS = "abcdefghijklmnopqrstuvwxyz0123456789"
LETTER_DIM = 8


def letter_weights() -> np.ndarray:
    """Whole numbers from -3 to 3, by code point and component."""
    c, j = np.array([ord(x) for x in LETTERS])[:, None], np.arange(LETTER_DIM)[None, :]
    return ((c * (2 * j + 3)) % 7 - 3).astype(np.float32)


def load_letter_model():
    """A model without files: tokens are ASCII letter and digit runs; a query has a marker token of ones beside its own."""
    weights = letter_weights()
    place = np.full(128, -1)
    place[[ord(x) for x in LETTERS]] = np.arange(len(LETTERS))

    def model(texts: list[str], side: str):
        words, at, seg = _tokens(texts)
        if words:  # the letters of each distinct token are added up once
            begin = np.cumsum([0, *map(len, words[:-1])])
            vectors = np.add.reduceat(weights[place[np.frombuffer(b"".join(words), np.uint8)]], begin, axis=0)
        else:
            vectors = np.empty((0, LETTER_DIM), np.float32)
        toks = [vectors[at[a:b]] for a, b in zip(seg[:-1], seg[1:])]
        if side == "query":
            toks = [np.concatenate([m, np.ones((1, LETTER_DIM), np.float32)]) for m in toks]
        return [m.sum(0) for m in toks], toks

    return model


LETTER_MODEL = ModelEmbedder(load_letter_model, LETTER_DIM, LETTER_DIM, "letters")
