"""Byte-level BPE encoding and decoding by trie traversal (operator 8).

The encoding of a string's prefix is given by its last token alone: the token
before it is the last token of the prefix that it leaves.  So the distinct
words of a batch go into a byte trie, and a depth-first walk keeps the last
token of every node on the path; a prefix that many words share is encoded
once.  A token ends a node's prefix if it follows the last token of what
precedes it, that is, if the merge rules leave the two side by side.

Texts are cut into words by the tokenizer's pattern.  Whole pieces (white
space and the run after it) are remembered in the worker, so the pattern and
the trie see each distinct piece about once.  The ids of a slice of texts are
one array of integers; their decimals and their bytes are gathered from two
tables by Arrow, without a Python object per token.
"""

from __future__ import annotations

import gc
import hashlib
import json
import re
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import per_batch, worker_cache

# fixed values: the splitting pattern of the byte-level tokenizer, and Unicode white space
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WHITE = r"\t-\r \x85\xa0  -     　"
PIECE = re.compile(f"[{WHITE}]*[^{WHITE}]+|[{WHITE}]+")
#: Remembered pieces and words of a worker, in two generations: when the younger one has half, it
#: replaces the older one, so what is still in use stays.
PIECES_KEPT = 400_000
WORDS_KEPT = 300_000
#: Words that share one trie.
TRIE_WORDS = 50_000
#: Texts that are encoded at once, and characters of them (a longer one is a slice of its own).
SLICE, SLICE_CHARS = 1000, 4_000_000
#: Remembered pairs of tokens, likewise; a pair is one number, the first token times PAIR and the second.
PAIR = 1 << 20
PAIRS_KEPT = 400_000


def byte_alphabet() -> dict[str, int]:
    """The printable stand-in of every byte: printable Latin-1 bytes stand for themselves, the others follow from U+0100."""
    own = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def trie(words: list[bytes]) -> list:
    """The trie of words in ascending order, with a node only where a word ends or paths part: [depth, a word that passes, whether it ends here, children]."""
    root = [0, b"", False, []]
    path, before = [root], b""
    for w in words:
        n = min(len(before), len(w))
        differ = int.from_bytes(before[:n], "big") ^ int.from_bytes(w[:n], "big")
        shared = n - (differ.bit_length() + 7) // 8
        below = None
        while path[-1][0] > shared:
            below = path.pop()
        top = path[-1]
        if top[0] < shared:  # the paths part on an edge
            top[3][-1] = top = [shared, below[1], False, [below]]
            path.append(top)
        if len(w) == top[0]:
            top[2] = True
        else:
            leaf = [len(w), w, True, []]
            top[3].append(leaf)
            path.append(leaf)
        before = w
    return root


class Vocabulary:
    """Tokens, merge ranks and special strings of a byte-level BPE file's text."""

    def __init__(self, content: str):
        import regex

        data = json.loads(content)
        alphabet = byte_alphabet()
        raw = {t: bytes(alphabet[c] for c in t) for t in data["model"]["vocab"]}
        self.words = regex.compile(WORD_PATTERN)
        self.ids = {raw[t]: i for t, i in data["model"]["vocab"].items()}
        self.bytes = {i: b for b, i in self.ids.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in data["model"]["merges"])
        self.ranks = {(raw[a], raw[b]): r for r, (a, b) in enumerate(pairs)}
        self.special = {t["content"]: t["id"] for t in data.get("added_tokens", [])}
        self.bytes |= {i: s.encode() for s, i in self.special.items()}
        self.cut = re.compile("(" + "|".join(re.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.by_decimal = {str(i): b for i, b in self.bytes.items()}
        #: By id: the decimal with a comma, and the bytes.
        top = max(self.bytes, default=-1) + 1
        self.decimals = pa.array([b"%d," % i for i in range(top)], pa.large_binary())
        self.pieces = pa.array([self.bytes.get(i, b"") for i in range(top)], pa.large_binary())
        self.sizes = {i: len(b) for i, b in self.bytes.items()}
        self.ends: dict = {}  # tokens by their bytes from the last to the first
        for b, i in self.ids.items():
            node = self.ends
            for x in reversed(b):
                node = node.setdefault(x, {})
            node[-1] = i
        #: How each token came about: rank of the rule, left part, right part.
        self.made = {}
        self.pairs = {}
        for (a, b), r in self.ranks.items():
            x, y = self.ids[a], self.ids[b]
            self.pairs[x, y] = r
            self.made.setdefault(self.ids[a + b], (r, x, y))
        self.follows: dict = {}
        self.older_follows: dict = {}
        self.coded: dict = {}
        self.older_coded: dict = {}

    def merged(self, data: bytes) -> list[bytes]:
        """The merge rules applied to ``data``, lowest rank first, leftmost first."""
        parts = [data[i : i + 1] for i in range(len(data))]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: (self.ranks.get((parts[i], parts[i + 1]), 1 << 30), i))
            if (parts[best], parts[best + 1]) not in self.ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return parts

    def may_follow(self, a: int, b: int) -> bool:
        """Whether the rules leave token ``b`` as it is after token ``a`` (-1: at the start)."""
        got = self.follows.get(a * PAIR + b)
        if got is None:
            if 2 * len(self.follows) >= PAIRS_KEPT:
                self.older_follows = dict(self.follows)
                self.follows.clear()  # the walk over a trie holds this dict
            got = self.older_follows.get(a * PAIR + b)
        if got is None:
            got = self.merged(self.bytes[b]) == [self.bytes[b]] if a < 0 else self._stay_apart(a, b)
        self.follows[a * PAIR + b] = got
        return got

    def _stay_apart(self, a: int, b: int) -> bool:
        """Undoes the merges beside the border of ``a`` and ``b``, latest first: at no time may a rule across the border be due before the one undone."""
        due = 1 << 30  # the rule that comes next has this rank; across the border a smaller one would win
        while True:
            if self.pairs.get((a, b), 1 << 30) < due:
                return False
            left, right = self.made.get(a, (-1, 0, 0)), self.made.get(b, (-1, 0, 0))
            if left[0] < 0 and right[0] < 0:
                return True
            if left[0] > right[0]:
                due, a = left[0], left[2]
            else:  # of equal rules the left one comes first, so one across the border wins a tie with the right part's
                due, b = right[0] + 1, right[1]

    def encode_words(self, words: list[bytes]) -> dict[bytes, list[int]]:
        """Token ids of distinct words in ascending order, through one trie."""
        out: dict[bytes, list[int]] = {}
        if not words:
            return out
        ends, follows, may_follow, sizes = self.ends, self.follows, self.may_follow, self.sizes
        last = [-1] * (max(map(len, words)) + 1)  # the last token of each prefix of the node that the walk is at
        walk = [(trie(words), 0)]
        while walk:
            (depth, word, whole, below), at = walk.pop()
            while at < depth:
                node, i = ends[word[at]], at
                at += 1
                while True:  # tokens that end here, the shorter first; the one that may follow is the only one
                    if -1 in node:
                        t = node[-1]
                        fits = follows.get(last[i] * PAIR + t)
                        if fits or fits is None and may_follow(last[i], t):
                            last[at] = t
                            break
                    i -= 1
                    if i < 0 or word[i] not in node:
                        raise ValueError(f"no token ends {word[:at]!r}")
                    node = node[word[i]]
            if whole:
                ids = []
                while at:
                    ids.append(last[at])
                    at -= sizes[last[at]]
                out[word] = ids[::-1]
            walk += [(child, depth) for child in below]
        return out

    def encode_pieces(self, pieces: list[str]) -> dict[str, bytes]:
        """Ids of each piece as little-endian 32-bit integers."""
        cut = {p: [w.encode() for w in self.words.findall(p)] for p in pieces}
        if 2 * len(self.coded) > WORDS_KEPT:
            self.older_coded, self.coded = self.coded, {}
        new = {w for ws in cut.values() for w in ws}.difference(self.coded)
        self.coded |= {w: self.older_coded[w] for w in new if w in self.older_coded}
        words = iter(sorted(new.difference(self.older_coded)))  # neighbours share prefixes
        while some := list(islice(words, TRIE_WORDS)):
            for w, ids in self.encode_words(some).items():
                self.coded[w] = np.array(ids, "<i4").tobytes()
        return {p: self.coded[ws[0]] if len(ws) == 1 else b"".join([self.coded[w] for w in ws]) for p, ws in cut.items()}

    def decode(self, ids: str) -> bytes:
        """The bytes of ids given as decimals joined by commas."""
        return b"".join(map(self.by_decimal.__getitem__, ids.split(","))) if ids else b""


def _parts(vocab: Vocabulary, text: str) -> list[str]:
    """Pieces and special strings of a text.

    Without special strings, and if no blank or newline touches other white
    space, these are the borders: a piece then begins with its blank."""
    if vocab.cut and any(s in text for s in vocab.special):
        return [p for s in vocab.cut.split(text) for p in ([s] if s in vocab.special else PIECE.findall(s))]
    if BESIDE.search(text):
        return PIECE.findall(text)
    parts = text.replace("\n", " \n").split(" ")
    first = [parts[0]] if parts[0] else []
    return first + [p if p[:1] == "\n" else " " + p for p in parts[1:]]


#: A blank or newline beside other white space.
BESIDE = re.compile(f"[ \n][{WHITE}]|[{WHITE}][ \n]")


def encode_ids(vocab: Vocabulary, texts: list[str], kept: dict) -> list[bytes]:
    """For each text its ids as little-endian 32-bit integers.  ``kept`` remembers pieces between calls."""
    now, before = kept.get("now", {}), kept.get("before", {})
    if 2 * len(now) > PIECES_KEPT:
        before, now = now, {}
    parts = [_parts(vocab, t) for t in texts]
    new = set().union(*parts).difference(now)
    now |= {p: before[p] for p in new if p in before}
    new.difference_update(before)
    now |= vocab.encode_pieces([p for p in new if p not in vocab.special])
    now |= {s: np.array([vocab.special[s]], "<i4").tobytes() for s in new if s in vocab.special}
    kept["now"], kept["before"] = now, before
    return [b"".join(map(now.__getitem__, some)) for some in parts]


def encode_texts(vocab: Vocabulary, texts: list[str], kept: dict) -> list[str]:
    """For each text its ids as decimals joined by commas."""
    return [",".join(map(str, np.frombuffer(ids, "<i4").tolist())) for ids in encode_ids(vocab, texts, kept)]


def spelled(table: pa.Array, ids: np.ndarray, sizes: list[int]) -> list[memoryview]:
    """The entries of ``table`` for runs of ``ids`` of the given sizes, one buffer a run."""
    got = table.take(pa.array(ids))
    at = np.frombuffer(got.buffers()[1], np.int64, len(ids) + 1)[np.cumsum([0, *sizes])] if len(ids) else np.zeros(len(sizes) + 1, np.int64)
    whole = memoryview(got.buffers()[2]) if len(ids) and got.buffers()[2] else memoryview(b"")
    return [whole[a:b] for a, b in zip(at[:-1].tolist(), at[1:].tolist())]


def _slices(texts: list[str]):
    """Ranges of at most SLICE texts and SLICE_CHARS characters."""
    start, chars = 0, 0
    for i, t in enumerate(texts):
        if i > start and (i - start >= SLICE or chars + len(t) > SLICE_CHARS):
            yield start, i
            start, chars = i, 0
        chars += len(t)
    if start < len(texts):
        yield start, len(texts)


def vocabulary_broadcast(spark, path: str):
    """The tokenizer file's text, read on the driver: workers need no copy of the file."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode_decode(docs: DataFrame, path: str, id: str = "doc_id", text: str = "text", ids: bool = False) -> DataFrame:
    """``(id, n_tokens, ids_sha256, decoded_sha256)``, and with ``ids`` the tokens as ``ids`` and the decoded text as ``decoded``.

    One row per input row; a null text counts as empty.  The file at ``path``
    is a byte-level BPE tokenizer; its special strings are recognised in
    texts, nothing is added, cut off or padded."""
    content = vocabulary_broadcast(docs.sparkSession, path)
    key = f"{path}:{hashlib.sha1(content.value.encode()).hexdigest()}"
    ddl = f"`{id}` long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    fields = [(id, pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    if ids:
        ddl += ", ids array<int>, decoded string"
        fields += [("ids", pa.list_(pa.int32())), ("decoded", pa.string())]

    names = [n for n, _ in fields[1:]]

    def utf8(data: memoryview) -> memoryview | bytes:
        """``data`` with what is no UTF-8 replaced, as the library decodes."""
        text = str(data, "utf-8", "replace")
        return text.encode() if "\ufffd" in text else data

    def rows(doc_ids, texts):
        cache = worker_cache("bpe")
        if key not in cache:
            cache.clear()
            cache[key] = (Vocabulary(content.value), {})
            gc.freeze()
        vocab, kept = cache[key]
        got = []
        gc.disable()  # tries and lists of pieces hold no cycles, and looking for some takes a fifth of the time
        texts = [t or "" for t in texts]
        for a, b in _slices(texts):
            coded = encode_ids(vocab, texts[a:b], kept)
            sizes = [len(c) // 4 for c in coded]
            flat = np.frombuffer(b"".join(coded), "<i4")
            for n, c, decimals, raw in zip(sizes, coded, spelled(vocab.decimals, flat, sizes), spelled(vocab.pieces, flat, sizes)):
                back = utf8(raw)
                more = (np.frombuffer(c, "<i4").tolist(), str(back, "utf-8")) if ids else ()
                got.append((n, hashlib.sha256(decimals[:-1]).hexdigest(), hashlib.sha256(back).hexdigest(), *more))
        gc.enable()
        out = dict(zip(names, zip(*got)))
        return {id: doc_ids, **out}

    return docs.select(F.col(id).cast("long"), text).mapInArrow(per_batch(rows, id, text, schema=pa.schema(fields)), ddl)
