"""Secret scanning (operator 2): three base patterns plus two character Markov models.

The base patterns find assignments, access keys and long hexadecimal runs.
Their matches are also the labelled samples of the models: the matched values
are *random strings*, all other tokens of the corpus that the models would not
judge themselves are *ordinary identifiers*.  Every distinct token of the whole
corpus counts once, so copies of a string change nothing (the driver gets one
fixed-size table of bigram counts).  A further token is reported as ``markov``
when the log-likelihood ratio of the two models says that it is random; of a
token that base spans overlap, the pieces beside them are judged.
"""

from __future__ import annotations

import hashlib
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch

# fixed values: the base patterns and the shortest match of each kind
KINDS = ("assign", "access", "hex", "markov")
ASSIGN = re.compile(r"""(?ai:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
HEX = re.compile(r"[0-9a-f]{24,}")
ASSIGN_LEAST = 6
KEYWORDS = ("passw", "secret", "token", "api")

#: Symbols of the models; state 0 is everything else, and the start of a token.
SYMBOLS = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-."
STATES = len(SYMBOLS) + 1
#: Tokens that the models judge: so many characters at least, with a letter and a digit among them.
TOKEN = re.compile(r"[A-Za-z0-9+/_=-]{16,}")
#: Least log-likelihood ratio in nats, of the whole token and per character.
LEAST_RATIO = 8.0
LEAST_PER_CHAR = 0.25
#: Evidence, in nats, of a change between letter and digit, at most.
CHANGE = 0.6
#: Weight, in characters, of a symbol's own frequency against that after the symbol before it.
BACKOFF = 20.0
#: What is not counted of a bigram in ordinary tokens, as a share of the mean of all bigrams: it may come from short random strings.
DISCOUNT = 0.01
#: Pseudo-count of every symbol, in ordinary words and in random strings (which favour no symbol).
SMOOTHING = (0.5, 50.0)
#: Bytes that are counted at once.
SLICE = 1 << 20
#: Runs of symbols, the tokens that the models learn from; characters of text whose tokens are held at once.
RUN = re.compile(r"[A-Za-z0-9+/_=.-]+")
HELD = 4 << 20


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind number, end)`` of the base matches, by start, then kind."""
    out = []
    low = text.lower()
    if any(k in low for k in KEYWORDS):
        out += [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if m.end() - m.start(1) >= ASSIGN_LEAST]
    if "AKIA" in text:
        out += [(m.start(), 1, m.end()) for m in ACCESS.finditer(text)]
    out += [(m.start(), 2, m.end()) for m in HEX.finditer(text)]
    return sorted(out)


def _states() -> np.ndarray:
    lut = np.zeros(256, np.uint16)
    lut[np.frombuffer(SYMBOLS.encode(), np.uint8)] = np.arange(1, STATES)
    return lut


def _count(data: bytes, lut: np.ndarray) -> np.ndarray:
    """Bigram counts of all tokens in ``data``, which starts and ends outside a token."""
    total = np.zeros(STATES * STATES, np.int64)
    codes = lut[np.frombuffer(data, np.uint8)]
    for at in range(0, len(codes) - 1, SLICE):
        c = codes[at : at + SLICE + 1].astype(np.int64)
        total += np.bincount(c[:-1] * STATES + c[1:], minlength=STATES * STATES)
    return total.reshape(STATES, STATES)


def _judged(text: str, cut: list):
    """``(start, end)`` of the tokens that the models judge, ``cut`` (start, end) at sorted spans."""
    at = 0
    for start, end in [*cut, (len(text), len(text))]:
        for m in TOKEN.finditer(text, at, max(at, start)):
            t = m.group()
            if any(c.isdigit() for c in t) and any(c.isalpha() for c in t):
                yield m.start(), m.end()
        at = max(at, end)


def _learned(text: str) -> tuple[set[str], set[str]]:
    """The distinct ordinary tokens of a text, without the values of base matches and what the models judge, and these values."""
    values = []
    for start, kind, end in base_spans(text):
        m = ASSIGN.match(text, start) if kind == 0 else None
        values.append(m.span(1) if m else (start, end))
    rest, at = [], 0
    for start, end in sorted([*values, *_judged(text, sorted(values))]):
        if start > at:
            rest.append(text[at:start])
        at = max(at, end)
    rest.append(text[at:])
    return set(RUN.findall("\n".join(rest))), {text[a:b] for a, b in values}


def _tokens(batches):
    held, size = (set(), set()), 0

    def batch():
        found = [*held[0], *held[1]]
        flags = [False] * len(held[0]) + [True] * len(held[1])
        return pa.RecordBatch.from_arrays([pa.array(found, pa.string()), pa.array(flags)], names=["token", "random"])

    for b in batches:
        for t in b.column(0):
            t = t.as_py()
            if t:
                for mine, more in zip(held, _learned(t)):
                    mine |= more
                size += len(t)
                if size >= HELD:
                    yield batch()
                    held, size = (set(), set()), 0
    yield batch()


def _bigrams(batches):
    lut = _states()
    sums = np.zeros((2, STATES, STATES), np.int64)
    for b in batches:
        tokens, random = b.column(0).to_pylist(), b.column(1).to_pylist()
        for kind in (0, 1):
            sums[kind] += _count(("\n" + "\n".join(t for t, r in zip(tokens, random) if r == kind) + "\n").encode(), lut)
    kind, prev, cur = np.nonzero(sums)
    yield pa.RecordBatch.from_arrays(
        [pa.array(kind.astype(np.int32)), pa.array(prev.astype(np.int32)), pa.array(cur.astype(np.int32)), pa.array(sums[kind, prev, cur])],
        names=["random", "prev", "cur", "n"],
    )


def train(docs: DataFrame, text: str = "text") -> np.ndarray:
    """Log-likelihood ratio of each bigram, random against ordinary, from every document."""
    # a token that is a secret's value anywhere is no ordinary one
    tokens = docs.select(text).mapInArrow(_tokens, "token string, random boolean").groupBy("token").agg(F.max("random").alias("random"))
    counts = tokens.mapInArrow(_bigrams, "random int, prev int, cur int, n long")
    n = np.zeros((2, STATES, STATES))
    for r in counts.groupBy("random", "prev", "cur").agg(F.sum("n").alias("n")).collect():  # 2 * STATES**2 rows at most
        n[r["random"], r["prev"], r["cur"]] += r["n"]
    n = n[:, :, 1:]  # the end of a token is not scored
    n[0] = np.maximum(n[0] - DISCOUNT * n[0].mean(), 0)
    alone = n.sum(1) + np.array(SMOOTHING)[:, None]
    alone /= alone.sum(1, keepdims=True)
    p = (n + BACKOFF * alone[:, None, :]) / (n.sum(2, keepdims=True) + BACKOFF)
    out = np.zeros((STATES, STATES))
    out[:, 1:] = np.log(p[1]) - np.log(p[0])
    return _by_parts(out)


def _by_parts(ratios: np.ndarray) -> np.ndarray:
    """Bigram ratios by which the parts of identifiers, paths and dates are judged as words of their own.

    Separators and digits, which prose hardly has, say nothing, but for a
    change between letter and digit, which counts CHANGE at most; what follows
    them, or is a capital after a small letter, begins a part.  Two capitals
    are as ordinary as the small letters they stand for, if that is more."""
    out = ratios.copy()
    small, large = ([SYMBOLS.index(c) + 1 for c in a] for a in ("abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"))
    rest = [i + 1 for i, c in enumerate(SYMBOLS) if not c.isalpha()]
    out[np.ix_(large, large)] = np.minimum(out[np.ix_(large, large)], ratios[np.ix_(small, small)])
    out[0, large] = np.minimum(ratios[0, large], ratios[0, small])
    out[np.ix_(small, large)] = out[0, large]
    digits = [SYMBOLS.index(c) + 1 for c in "0123456789"]
    out[rest, :] = out[0, :]
    out[:, rest] = 0.0
    out[np.ix_(small + large, digits)] = np.minimum(ratios[np.ix_(small + large, digits)], CHANGE)
    out[np.ix_(digits, small + large)] += CHANGE
    return out


def ratio(token: str, model: np.ndarray, lut: np.ndarray) -> float:
    c = lut[np.frombuffer(token.encode(), np.uint8)].astype(np.int64)
    return float(model[0, c[0]] + model[c[:-1], c[1:]].sum())


def all_spans(text: str, model: np.ndarray, lut: np.ndarray) -> tuple[list, list]:
    """The base spans, and these with the model's, both by start, then kind."""
    base = base_spans(text)
    added = []
    for start, end in _judged(text, [(s, e) for s, _, e in base]):
        score = ratio(text[start:end], model, lut)
        if score >= LEAST_RATIO and score >= LEAST_PER_CHAR * (end - start):
            added.append((start, 3, end))
    return base, sorted(base + added)


def render(spans: list) -> str:
    return ",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans)


RESULT = pa.schema([("n_assign", pa.int64()), ("n_access", pa.int64()), ("n_hex", pa.int64()), ("n_markov", pa.int64()), ("base_sha256", pa.string()), ("spans", pa.string())])


def scan(docs: DataFrame, model: np.ndarray, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, n_assign, n_access, n_hex, n_markov, base_sha256, spans)``, one row per input row.

    A null text counts as empty, an id may be null or repeated.  Offsets are
    code points, ends exclusive."""
    schema = pa.schema([(id, pa.int64()), *RESULT])

    def rows(ids, texts):
        lut = _states()
        found = [all_spans(t or "", model, lut) for t in texts]
        kinds = [[k for _, k, _ in every] for _, every in found]
        return {
            id: ids,
            **{f"n_{name}": [k.count(i) for k in kinds] for i, name in enumerate(KINDS)},
            "base_sha256": [hashlib.sha256(render(base).encode()).hexdigest() for base, _ in found],
            "spans": [render(every) for _, every in found],
        }

    ddl = f"`{id}` long, n_assign long, n_access long, n_hex long, n_markov long, base_sha256 string, spans string"
    return docs.select(F.col(id).cast("long"), text).mapInArrow(per_batch(rows, id, text, schema=schema), ddl)


def redact(docs: DataFrame, model: np.ndarray, text: str = "text", mark: str = "[secret]") -> DataFrame:
    """``docs`` with every span (overlapping ones as one) replaced by ``mark``; null texts stay null."""

    @F.pandas_udf("string")
    def clean(texts):
        lut = _states()

        def one(t):
            if not t:
                return t
            out, at = [], 0
            for s, _, e in all_spans(t, model, lut)[1]:
                if s >= at:
                    out += [t[at:s], mark]
                at = max(at, e)
            return "".join(out) + t[at:] if out else t

        return texts.map(one, na_action="ignore")

    return docs.withColumn(text, clean(text))
