"""Quality classifier: ordinal cumulative-link regression on hashed text (operator 9).

P(grade <= g | x) = sigmoid(threshold_g - w.x) with one weight vector shared by
all grades and ordered thresholds.  The features are hashed: word shapes (runs
of letters, digits and marks), words, and bins of how much a text repeats its
words and lines; shares of a whole text enter by their square root, so length
does not matter.  The model gives the expected grade and the tail probability
P(grade >= g), by which documents are selected.

It is fitted on at most SAMPLE labelled rows, those whose ids hash lowest;
scoring reads every text whole in one narrow pass.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS, per_batch, worker_cache

#: Labelled rows that the model is fitted on, at most.
SAMPLE = 4000
#: Buckets of the hashed shapes, words and bins.
SHAPES, WORDS, BINS = 2048, 1024, 256
DIM = SHAPES + WORDS + BINS
#: Weight of words against shapes: words carry topic, which is not quality.
WORD_SCALE = 0.25
#: Penalty of the squared weights, steps and step size of the fit.
PENALTY, STEPS, RATE = 2e-3, 400, 0.05
#: Remembered words of a worker; then it starts anew.
WORDS_KEPT = 400_000
#: A document is kept from this tail probability on.
KEEP_FROM = 0.5

#: Longer words are cut into pieces of so many characters, all of which count.
PIECE = 64

RUN = re.compile(r"(.)\1+")


def shape(word: str) -> str:
    """Upper-case runs as A, lower-case runs as a, digits as 0, other characters as they are; a run counts once, of marks twice."""
    out = "".join("a" if c.islower() else "A" if c.isupper() else "0" if c.isdigit() else "x" if c.isalpha() else c + c for c in word)
    return RUN.sub(lambda m: m[0][:2] if m[1] not in "aA0x" else m[1], out)


def _slots(word: str) -> int:
    return zlib.crc32(shape(word).encode()) % SHAPES * WORDS + zlib.crc32(word.lower().encode(), 7) % WORDS


def features(text: str, kept: dict) -> np.ndarray:
    """The dense feature vector of a whole text; of an empty one, only its bins.  Runs without white space count as words of PIECE characters."""
    out = np.zeros(DIM, np.float32)
    words = text.split()
    if any(len(w) > PIECE for w in words):
        words = [w[i : i + PIECE] for w in words for i in range(0, len(w), PIECE)]
    if words:
        count = Counter(words)
        for w in count:
            if w not in kept:
                kept[w] = _slots(w)
        both = np.fromiter(map(kept.__getitem__, count), np.int64, len(count))
        n = np.fromiter(count.values(), np.float64, len(count))
        out[:SHAPES] = np.sqrt(np.bincount(both // WORDS, n, SHAPES) / len(words))
        out[SHAPES : SHAPES + WORDS] = WORD_SCALE * np.sqrt(np.bincount(both % WORDS, n, WORDS) / len(words))
        lines = [s for s in re.split(r"[\n.]+", text) if s.strip()]
        repeated = 1 - len(set(lines)) / max(1, len(lines))
        most = max(count.values()) / len(words)
        same = sum(map(str.__eq__, words, words[1:])) / len(words)
        bins = (f"words {10 * len(count) // len(words)}", f"lines {int(10 * repeated)}", f"most {int(10 * most)}", f"same {int(10 * same)}", f"size {min(7, len(words).bit_length())}")
    else:
        bins = ("empty",)
    for b in bins:
        out[SHAPES + WORDS + zlib.crc32(b.encode()) % BINS] += 1
    return out


@dataclass
class Model:
    grades: list[int]
    weights: np.ndarray
    thresholds: np.ndarray  # one less than grades

    def tails(self, x: np.ndarray) -> np.ndarray:
        """P(grade >= grades[i]) for every row of ``x`` and grade."""
        s = (x @ self.weights)[:, None]
        over = 1 / (1 + np.exp(np.clip(self.thresholds[None, :] - s, -500, 500)))
        return np.hstack([np.ones((len(x), 1)), over])


def fit(x: np.ndarray, grade: np.ndarray) -> Model:
    """Maximum likelihood with an L2 penalty, by Adam on all rows at once."""
    grades = sorted(set(grade.tolist()))
    if len(grades) < 2:
        return Model(grades or [0], np.zeros(DIM), np.empty(0))
    y = np.searchsorted(grades, grade)
    used = np.flatnonzero(x.any(0))
    z = np.ascontiguousarray(x[:, used])
    below = np.array([(y < k).mean() for k in range(1, len(grades))])
    first = np.log(below / (1 - below))
    # the first threshold, then the logarithms of the steps to the next
    params = [np.zeros(len(used)), np.concatenate([first[:1], np.log(np.maximum(np.diff(first), 1e-3))])]
    moments = [[np.zeros_like(p), np.zeros_like(p)] for p in params]
    for step in range(1, STEPS + 1):
        w, t = params
        th = np.concatenate([[-np.inf], np.cumsum(np.concatenate([t[:1], np.exp(t[1:])])), [np.inf]])
        s = z @ w.astype(np.float32)
        hi = 1 / (1 + np.exp(np.clip(s - th[y + 1], -500, 500)))
        lo = 1 / (1 + np.exp(np.clip(s - th[y], -500, 500)))
        p = np.maximum(hi - lo, 1e-12)
        gw = z.T @ ((1 - hi - lo) / len(y)).astype(np.float32) + PENALTY * w
        gt = np.array([((y + 1 == k) * -hi * (1 - hi) / p + (y == k) * lo * (1 - lo) / p).mean() for k in range(1, len(grades))])
        inner = np.cumsum(gt[::-1])[::-1]  # a step moves every later threshold
        grads = [gw, np.concatenate([inner[:1], inner[1:] * np.exp(t[1:])])]
        for i, g in enumerate(grads):
            m, v = moments[i]
            m[:] = 0.9 * m + 0.1 * g
            v[:] = 0.999 * v + 0.001 * g * g
            params[i] = params[i] - RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    weights = np.zeros(DIM)
    weights[used] = params[0]
    t = params[1]
    return Model(grades, weights, np.cumsum(np.concatenate([t[:1], np.exp(t[1:])])))


def _kept() -> dict:
    kept = worker_cache("quality")
    if len(kept) > WORDS_KEPT:
        kept.clear()
    return kept


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", grade: str = "quality", sample: int = SAMPLE) -> Model:
    """Fits the grades of ``labels`` on the texts of ``docs``; rows without an id or a grade are left out.

    At most ``sample`` rows, one for each of the ids that hash lowest among
    those with a label and a document: of rows that share an id, the one whose
    text hashes lowest; of an id's labels, the highest."""
    given = docs.where(F.col(id).isNotNull()).select(F.col(id).alias("__id")).distinct()
    chosen = labels.where(F.col(id).isNotNull() & F.col(grade).isNotNull()).groupBy(F.col(id).alias("__id")).agg(F.max(grade).cast("int").alias("grade"))
    chosen = F.broadcast(chosen.join(given, "__id", "left_semi").orderBy(F.xxhash64("__id"), "__id").limit(sample))  # ``sample`` narrow rows
    schema = pa.schema([("grade", pa.int32()), ("slots", pa.list_(pa.int32())), ("values", pa.list_(pa.float32()))])

    def rows(grades, texts):
        xs = [features(t or "", _kept()) for t in texts]
        at = [np.flatnonzero(x) for x in xs]
        return {"grade": grades, "slots": [a.astype(np.int32) for a in at], "values": [x[a] for x, a in zip(xs, at)]}

    some = docs.select(F.col(id).alias("__id"), F.coalesce(text, F.lit("")).alias(text)).join(chosen, "__id")
    some = some.groupBy("__id", "grade").agg(F.min_by(text, F.struct(F.xxhash64(text), text)).alias(text)).orderBy(F.xxhash64("__id"), "__id").select("grade", text)
    got = some.mapInArrow(per_batch(rows, "grade", text, schema=schema), "grade int, slots array<int>, values array<float>").toArrow()  # at most ``sample`` rows
    x = np.zeros((got.num_rows, DIM), np.float32)
    for i in range(got.num_rows):
        x[i, got["slots"][i].values.to_numpy()] = got["values"][i].values.to_numpy()
    return fit(x, got["grade"].to_numpy())


def _scores(model: Model, texts: list) -> tuple[np.ndarray, np.ndarray]:
    """Expected grade, and the probability of the best grade."""
    slices = [texts[at : at + SLICE_ROWS] for at in range(0, len(texts), SLICE_ROWS)]
    tails = np.vstack([model.tails(np.stack([features(t or "", _kept()) for t in some])) for some in slices])
    steps = np.diff(np.array(model.grades, float), prepend=0.0)
    return tails @ steps, tails[:, -1]


def grade(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``(id, expected_grade, tail_probability, keep)``, one row per input row; a null text counts as empty."""
    schema = pa.schema([(id, pa.int64()), ("expected_grade", pa.float64()), ("tail_probability", pa.float64()), ("keep", pa.bool_())])

    def rows(ids, texts):
        expected, tail = _scores(model, texts)
        return {id: ids, "expected_grade": expected, "tail_probability": tail, "keep": tail >= keep_from}

    ddl = f"`{id}` long, expected_grade double, tail_probability double, keep boolean"
    return docs.select(F.col(id).cast("long"), text).mapInArrow(per_batch(rows, id, text, schema=schema), ddl)


def keep(docs: DataFrame, model: Model, text: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """The rows of ``docs`` whose tail probability is high enough, with all their columns."""

    @F.pandas_udf("double")
    def tail(texts):
        import pandas as pd

        return pd.Series(_scores(model, texts.tolist())[1], dtype="float64") if len(texts) else pd.Series([], dtype="float64")

    return docs.where(tail(F.coalesce(F.col(text), F.lit(""))) >= keep_from)
