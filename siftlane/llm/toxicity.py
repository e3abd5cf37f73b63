"""Toxicity: a subsequence string-kernel SVM with Nystroem landmarks (operator 6).

The kernel of two strings sums over all common subsequences of ORDER
characters, each discounted by DECAY for every position it spans, so an insult
with inserted or gapped characters stays close to itself.  Landmarks are short
strings that set toxic sentences apart, chosen to cover the labelled toxic
documents; the kernel against them, whitened by the landmarks' own kernel
matrix, gives the Nystroem features of a linear SVM.

A labelled document is a bag of sentences, a sentence a bag of units: its
words, each run without white space with its inner marks taken out
(``zork_wimp``), runs of single spaced-out letters, and neighbouring words
joined where a landmark lies across their border (``zork wimp``).  Sentences
of clean documents are negatives; of a toxic document the sentence that scores
highest is the positive (chosen anew in each round).  A sentence scores as its
worst unit, a document as its worst sentence.  A logistic link, fitted with
the classes at their true shares, turns that into a score of 0 to 1.

Everything is fitted on at most SAMPLE labelled rows per class; scoring is one
narrow pass over whole texts.
"""

from __future__ import annotations

import math
import re
import uuid
from bisect import bisect
from collections import Counter
from dataclasses import dataclass
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import per_batch, worker_cache

#: Labelled rows per class that the model is fitted on, at most.
SAMPLE = 1500
ORDER, DECAY = 3, 0.5
#: Lengths of landmark strings, and landmarks at most.
LANDMARK_LENGTHS = (4, 5, 6, 7)
LANDMARKS = 64
#: Landmarks that a toxic document should have before the search turns to the others.
COVER = 3
#: Evidence, in nats, that a landmark candidate belongs to the toxic class.
EVIDENCE = 10.0
#: Landmark candidates that are looked at, at most.
CANDIDATES = 3000
#: Longest unit, with the marks ^ and $ of a word's ends; longer words are cut into windows that overlap by half.
UNIT = 24
#: A landmark's characters that a unit may lack; further off, the kernel counts as 0.
LACK = 1
ROUNDS, STEPS, PENALTY = 3, 600, 1e-4
#: Remembered words of a worker; then it starts anew.
WORDS_KEPT = 500_000

WORD = re.compile(r"[^\W_]+")
SENTENCE = re.compile(r"[.!?;\n]+")
PARTS = re.compile(r"[^\W_]+|[.!?;\n]")
#: What may stand between the parts of a joined word: ASCII marks and white space that end no sentence.
BETWEEN = bytes(c for c in range(128) if not chr(c).isalnum() and chr(c) not in ".!?;\n")
MARKS = re.compile(r"[\W_]+")
SPACED = re.compile(r"(?<![^\W_])[^\W_](?:[\W_]{1,3}[^\W_]){3,}(?![^\W_])")


def _windows(word: str) -> list[str]:
    w = f"^{word}$"
    return [w] if len(w) <= UNIT else [w[i : i + UNIT] for i in range(0, len(w) - UNIT // 2, UNIT // 2)]


def word_units(token: str) -> list[str]:
    """The units of a lower-cased run without white space: its words, the run without its marks, and its single letters joined."""
    words = WORD.findall(token)
    whole = _windows("".join(words)) if len(words) > 1 else []
    return [u for w in words for u in _windows(w)] + whole + spaced_units(token)


def spaced_units(text: str) -> list[str]:
    """Runs of single letters with marks or spaces between them, joined."""
    return [u for m in SPACED.finditer(text) for u in _windows(MARKS.sub("", m[0]))]


class Borders:
    """Finds neighbouring words whose border a landmark lies across."""

    def __init__(self, landmarks: list[str]):
        import ahocorasick

        self.cores = ahocorasick.Automaton()
        for core in {t.strip("^$") for t in landmarks}:
            if len(core) > 1:
                self.cores.add_word(core, len(core))
        self.cores.make_automaton()

    def units(self, text: str) -> list[str]:
        """The joined words of a lower-cased text; sentences stay apart.  Between the words are white space and ASCII marks."""
        dense = text.encode("utf-8", "surrogatepass").translate(None, BETWEEN).decode("utf-8", "surrogatepass")
        near = [dense[end - size + 1 : end + 1] for end, size in self.cores.iter(dense)] if len(self.cores) else []
        if not near or all(text.count(core) >= n for core, n in Counter(near).items()):
            return []  # each stands within a word already
        words = PARTS.findall(text)
        whole = "".join(words)
        found = list(self.cores.iter(whole))
        starts = list(accumulate(map(len, words), initial=0))
        out = set()
        for end, size in found:
            first, last = bisect(starts, end - size + 1) - 1, bisect(starts, end) - 1
            if first < last:
                out.update(_windows("".join(words[first : last + 1])))
        return sorted(out)


def sentence_units(text: str, borders: Borders | None = None) -> list[list[str]]:
    """The distinct units of each sentence of a text; joined words only where ``borders`` are known."""
    out = []
    for s in SENTENCE.split(text.lower()):
        units = {u for t in s.split() for u in word_units(t)} | set(spaced_units(s)) | set(borders.units(s) if borders else ())
        if units:
            out.append(sorted(units))
    return out


# ---- kernel ----------------------------------------------------------------


def codes(strings: list[str], width: int) -> np.ndarray:
    """Code points, one row a string, 0 after its end."""
    return np.array([s[:width] for s in strings], dtype=f"<U{width}").view(np.uint32).reshape(len(strings), width)


def masks(c: np.ndarray) -> np.ndarray:
    """A 64-bit set of each row's characters (by code point modulo 64)."""
    bits = np.where(c > 0, np.uint64(1) << (c % 64).astype(np.uint64), np.uint64(0))
    return np.bitwise_or.reduce(bits, axis=1)


def _decays(n: int) -> np.ndarray:
    """DECAY to the power of the positions between i and an earlier j, 0 elsewhere."""
    d = np.subtract.outer(np.arange(n), np.arange(n)) - 1
    return np.where(d >= 0, DECAY ** np.maximum(d, 0), 0.0).astype(np.float32)


def kernel(units: np.ndarray, landmark: np.ndarray) -> np.ndarray:
    """The subsequence kernel of each row of ``units`` with one landmark (code points without padding)."""
    same = (units[:, :, None] == landmark[None, None, :]).astype(np.float32) * np.float32(DECAY**2)
    left, right = _decays(units.shape[1]), _decays(len(landmark)).T
    s = same
    for _ in range(ORDER - 1):
        s = same * (left @ s @ right)
    return s.sum((1, 2))


@dataclass
class Model:
    landmarks: list[str]
    alpha: np.ndarray  # weight of each landmark's kernel value
    bias: float
    slope: float  # of the logistic link
    shift: float

    def units(self, strings: list[str]) -> np.ndarray:
        """The SVM's decision for each unit."""
        return features(strings, self.landmarks) @ self.alpha + self.bias if len(self.landmarks) else np.full(len(strings), self.bias)

    def link(self, decision: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.slope * decision + self.shift, -30, 30)))


def features(strings: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values of units against landmarks, each landmark scaled to 1 with itself; 0 where more than LACK characters are missing."""
    out = np.zeros((len(strings), len(landmarks)), np.float32)
    if not strings:
        return out
    c = codes(strings, UNIT)
    have = masks(c)
    size = (c > 0).sum(1)
    ends = masks(codes(["^$"], 2))[0]
    for i, t in enumerate(landmarks):
        own = codes([t], len(t))
        mask = masks(own)[0] & ~ends
        least = int(np.bitwise_count(mask)) - LACK
        near = np.bitwise_count(have & mask) >= least
        for low, width in ((0, 14), (14, UNIT)):
            at = np.flatnonzero(near & (size > low) & (size <= width))
            if len(at):
                out[at, i] = kernel(c[at, :width], own[0]) / math.sqrt(kernel(own, own[0])[0])
    return out


def whitening(landmarks: list[str]) -> np.ndarray:
    """The inverse square root of the landmarks' kernel matrix (pseudo-inverse where it is flat)."""
    c = codes(landmarks, max(LANDMARK_LENGTHS))
    k = np.array([kernel(c, codes([t], len(t))[0]) for t in landmarks], np.float64)
    d = np.sqrt(np.diag(k))
    value, vector = np.linalg.eigh(k / d[:, None] / d[None, :])
    inverse = np.where(value > 1e-3, 1 / np.sqrt(np.maximum(value, 1e-3)), 0.0)
    return vector * inverse @ vector.T


# ---- training --------------------------------------------------------------


def _substrings(units: set[str]) -> set[str]:
    return {u[i : i + n] for u in units for n in LANDMARK_LENGTHS for i in range(len(u) - n + 1)}


def _document_frequency(batches):
    for b in batches:
        count = (Counter(), Counter())
        for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()):
            count[y].update(_substrings({u for s in sentence_units(t or "") for u in s}))
        for y in (0, 1):
            yield pa.RecordBatch.from_arrays([pa.array(list(count[y]), pa.string()), pa.array([y] * len(count[y]), pa.int32()), pa.array(list(count[y].values()), pa.int64())], names=["sub", "y", "n"])


def choose_landmarks(sample: DataFrame, toxic_docs: int, clean_docs: int) -> list[str]:
    """Strings that cover the toxic documents and hardly occur in clean ones, greedily, the most covering first."""
    df = sample.mapInArrow(_document_frequency, "sub string, y int, n long").groupBy("sub").agg(
        F.sum(F.when(F.col("y") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("y") == 0, F.col("n")).otherwise(0)).alias("clean")
    )
    rate = (F.col("toxic") + 0.5) / (toxic_docs + 1)
    odds = F.log(rate) - F.log((F.col("clean") + 0.5) / (clean_docs + 1))
    evidence = F.col("toxic") * F.log(rate * (toxic_docs + clean_docs + 1) / (F.col("toxic") + F.col("clean") + 0.5))
    ranked = df.withColumn("odds", odds).withColumn("evidence", evidence).where((F.col("toxic") >= 2) & (F.col("odds") >= 1.5))
    top = ranked.orderBy(F.desc("evidence"), "sub").limit(CANDIDATES).collect()
    top = [r for r in top if r["evidence"] >= EVIDENCE] or top[:LANDMARKS]
    if not top:
        return []
    known = {r["sub"]: r["clean"] * toxic_docs / max(1, clean_docs) for r in top}

    def hits(batches):
        for b in batches:
            for t in b.column("text").to_pylist():
                subs = _substrings({u for s in sentence_units(t or "") for u in s}) & known.keys()
                yield pa.RecordBatch.from_arrays([pa.array([sorted(subs)], pa.list_(pa.string()))], names=["subs"])

    docs = [[set(r["subs"]), COVER] for r in sample.where("y = 1").select("text").mapInArrow(hits, "subs array<string>").collect()]
    chosen: list[str] = []
    while len(chosen) < LANDMARKS:
        gain = Counter(s for subs, left in docs if left for s in subs)
        for s in chosen:
            gain.pop(s, None)
        worth = {s: n - 2 * known[s] for s, n in gain.items() if n >= 2}
        best = max(worth.values(), default=0)
        if best <= 0:
            break
        # of those that are nearly as good, the longest
        pick = max((s for s, n in worth.items() if n >= 0.95 * best), key=lambda s: (len(s), worth[s], s))
        chosen.append(pick)
        for d in docs:
            if d[1] and pick in d[0]:
                d[1] -= 1
                d[0] = {s for s in d[0] if s not in pick and pick not in s}
    return chosen


def _hinge(z: np.ndarray, y: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, float]:
    """A linear SVM with squared hinge, by accelerated gradient steps; ``y`` is -1 or 1."""
    x = np.hstack([z, np.ones((len(z), 1))])
    rate = 1 / (2 * np.linalg.norm(x * np.sqrt(weight)[:, None], 2) ** 2 + PENALTY)
    w = prev = np.zeros(x.shape[1])
    for step in range(STEPS):
        v = w + step / (step + 3) * (w - prev)
        slack = np.maximum(0, 1 - y * (x @ v))
        grad = -2 * x.T @ (weight * slack * y) + PENALTY * np.append(v[:-1], 0)
        prev, w = w, v - rate * grad
    return w[:-1], float(w[-1])


def _link(decision: np.ndarray, y: np.ndarray, share: float) -> tuple[float, float]:
    """Slope and shift of the logistic link, with the classes weighted to ``share`` toxic."""
    weight = np.where(y == 1, share / max(1, (y == 1).sum()), (1 - share) / max(1, (y == 0).sum()))
    a, b = 1.0, 0.0
    target = np.where(y == 1, 0.99, 0.01)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(a * decision + b, -30, 30)))
        g, h = weight * (p - target), weight * p * (1 - p) + 1e-9
        ga, gb = (g * decision).sum() + 1e-4 * a, g.sum()
        haa, hab, hbb = (h * decision**2).sum() + 1e-4, (h * decision).sum(), h.sum() + 1e-6
        det = haa * hbb - hab**2
        da, db = (hbb * ga - hab * gb) / det, (haa * gb - hab * ga) / det
        a, b = a - np.clip(da, -2, 2), b - np.clip(db, -2, 2)
    # the score 0.5 goes where the classes, at their shares, are told apart best: in the middle of the widest such gap
    order = np.argsort(decision)
    d, w = decision[order], np.where(y[order] == 1, -weight[order], weight[order])
    right = np.append(np.where(d[1:] > d[:-1], np.cumsum(w)[:-1], -np.inf), -np.inf)
    best = np.flatnonzero(right >= right.max() - 1e-9)
    at = best[np.argmax(d[best + 1] - d[best])] if np.isfinite(right.max()) else 0
    cut = (d[at] + d[min(at + 1, len(d) - 1)]) / 2
    a = max(a, 1e-3)
    return a, -a * cut


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic", sample: int = SAMPLE) -> Model:
    """Fits ``labels`` (``id``, 0/1 ``label``) on ``docs``; rows without an id or a label are left out.

    At most ``sample`` rows a class, one for each of the ids that hash lowest
    among those with a label and a document: of rows that share an id, the one
    whose text hashes lowest; an id with any toxic label is toxic."""
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull()).groupBy(F.col(id).alias("__id")).agg(F.max(label).cast("int").alias("y"))
    known = known.where(F.col("y").isin(0, 1)).join(docs.select(F.col(id).alias("__id")).distinct(), "__id", "left_semi")
    known = freeze(known, "labels")
    n = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count("*").alias("n")).collect()}
    if not n.get(1) or not n.get(0):
        return Model([], np.empty(0), -1.0 if not n.get(1) else 1.0, 4.0, 0.0)
    parts = [known.where(F.col("y") == y).orderBy(F.xxhash64("__id"), "__id").limit(sample) for y in (0, 1)]
    chosen = F.broadcast(parts[0].unionByName(parts[1]))  # at most 2 * sample narrow rows
    some = docs.select(F.col(id).alias("__id"), F.coalesce(F.col(text), F.lit("")).alias("text")).join(chosen, "__id")
    some = freeze(some.groupBy("__id", "y").agg(F.min_by("text", F.struct(F.xxhash64("text"), "text")).alias("text")).select("y", "text").repartition(some.sparkSession.sparkContext.defaultParallelism), "labelled")
    count = {r["y"]: r["n"] for r in some.groupBy("y").agg(F.count("*").alias("n")).collect()}
    share = n[1] / (n[0] + n[1])
    landmarks = choose_landmarks(some, count.get(1, 0), count.get(0, 0)) if count.get(1) else []
    if not landmarks:
        return Model([], np.empty(0), -1.0, 4.0, 0.0)

    # of each sentence, the units that have any kernel value; the rest are alike to the model
    def near(batches):
        borders = Borders(landmarks)
        for b in batches:
            for y, t in zip(b.column("y").to_pylist(), b.column("text").to_pylist()):
                units = sorted({u for s in sentence_units(t, borders) for u in s})
                got = [u for u, x in zip(units, features(units, landmarks).max(1, initial=0)) if x > 0.05]
                yield pa.RecordBatch.from_arrays([pa.array([y], pa.int32()), pa.array([got], pa.list_(pa.string()))], names=["y", "units"])

    rows = some.mapInArrow(near, "y int, units array<string>").collect()
    y = np.array([r["y"] for r in rows])
    units = sorted({u for r in rows for u in r["units"]})
    at = {u: i for i, u in enumerate(units)}
    white = whitening(landmarks)
    z = features(units, landmarks) @ white
    bags = [np.array([at[u] for u in r["units"]], np.int64) for r in rows]
    clean = Counter(i for b, t in zip(bags, y) if t == 0 for i in b.tolist())
    norm = np.linalg.norm(z, axis=1)
    decision = np.where(np.isin(np.arange(len(units)), list(clean)), -1.0, 1.0) + 0.1 * norm
    for _ in range(ROUNDS):
        witness = Counter(int(b[np.argmax(decision[b])]) for b, t in zip(bags, y) if t == 1 and len(b))
        pos = [i for i in witness if witness[i] > clean.get(i, 0)]
        neg = list(clean)
        x = np.vstack([z[pos], z[neg], np.zeros((1, z.shape[1]))])
        side = np.array([1.0] * len(pos) + [-1.0] * (len(neg) + 1))
        wp = np.array([math.sqrt(witness[i]) for i in pos] or [0.0])[: len(pos)]
        wn = np.array([math.sqrt(clean[i]) for i in neg] + [max(1.0, 0.2 * len(neg))])
        w, b0 = _hinge(x, side, np.concatenate([wp / max(wp.sum(), 1), wn / wn.sum()]))
        decision = z @ w + b0
    worst = np.array([max([b0, *decision[b]]) for b in bags])
    slope, shift = _link(worst, y, share)
    return Model(landmarks, (white @ w).astype(np.float64), b0, float(slope), float(shift))


def held_out(id: str = "doc_id"):
    """Whether crc32 of the id as text is a multiple of 5: such rows are never learned from."""
    return F.coalesce(F.crc32(F.col(id).cast("string")) % 5 == 0, F.lit(False))


def score(docs: DataFrame, model: Model, id: str = "doc_id", text: str = "text") -> DataFrame:
    """``(id, score, predicted)``, one row per input row; a null text counts as empty, and has the lowest score."""
    schema = pa.schema([(id, pa.int64()), ("score", pa.float64()), ("predicted", pa.int32())])
    key = uuid.uuid4().hex  # of this model: remembered decisions are its own

    def rows(ids, texts):
        cache = worker_cache("toxicity")
        if key not in cache:
            cache.clear()
            cache[key] = Borders(model.landmarks), {}, {}
        borders, kept, joined = cache[key]
        for memory in (kept, joined):
            if len(memory) > WORDS_KEPT:
                memory.clear()
        out = np.full(len(texts), model.bias)
        for at in range(0, len(texts), 200):
            bags, across = [], []
            for t in texts[at : at + 200]:
                low = (t or "").lower()
                bags.append(set(low.split()))
                across.append(set(spaced_units(low)) | set(borders.units(low)))
            new = list(set().union(*bags) - kept.keys())
            units = [word_units(w) for w in new]
            more = set().union(*across) - joined.keys()
            flat = sorted({u for us in units for u in us} | more)
            value = dict(zip(flat, model.units(flat).tolist()))
            kept |= {w: max((value[u] for u in us), default=model.bias) for w, us in zip(new, units)}
            joined |= {u: value[u] for u in more}
            out[at : at + 200] = [max(max(map(kept.__getitem__, b), default=model.bias), max(map(joined.__getitem__, x), default=model.bias)) for b, x in zip(bags, across)]
        p = model.link(out)
        return {id: ids, "score": p, "predicted": (p >= 0.5).astype(np.int32)}

    return docs.select(F.col(id).cast("long"), text).mapInArrow(per_batch(rows, id, text, schema=schema), f"`{id}` long, score double, predicted int")
