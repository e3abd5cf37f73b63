"""Fill-in-middle transformation by block rotation in place (operator 11).

A text is cut twice into prefix, middle and suffix.  The sentinels go into a
bytearray of the text at the cuts, in the order of the text (``<P>`` prefix
``<M>`` middle ``<S>`` suffix), and one rotation brings the segments into the
order of the form:

    psm   <P>prefix [<M>middle | <S>suffix]  ->  <P>prefix<S>suffix<M>middle
    spm   [<P>prefix<M>middle | <S>suffix]   ->  <S>suffix<P>prefix<M>middle

A rotation reverses both parts and then the whole, within the buffer.
``restore`` finds the sentinels, rotates back and takes them out again.  A
text that holds a sentinel stays plain, so the first one found is always ours.

Cuts are counted in units: a run of ASCII letters, or one other code point.
They come from a hash of the seed and the id, so they do not depend on how the
rows are dealt out; each row is one narrow step.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import SLICE_ROWS

PREFIX, SUFFIX, MIDDLE = b"<P>", b"<S>", b"<M>"
#: Of 100 texts, this many stay plain, and of the others this many are spm.
PLAIN_PERCENT, SPM_PERCENT = 10, 20
SEED = "1"


class Draw(NamedTuple):
    """What is drawn for a text: two cuts and two percentages, each any number of 32 bits."""

    first: int
    second: int
    plain: int
    form: int


def draw(key: str, seed: str = SEED) -> Draw:
    """Four numbers from the hash of the seed and the key."""
    raw = hashlib.sha256(f"{seed}:{key}".encode()).digest()
    return Draw(*(int.from_bytes(raw[i : i + 4], "big") for i in range(0, 16, 4)))


def reverse(buf: bytearray, start: int, end: int) -> None:
    """Reverses ``buf[start:end]`` where it is."""
    part = np.frombuffer(buf, np.uint8)[start:end]
    half = len(part) // 2
    if half:
        front = part[:half].copy()
        part[:half] = part[: -half - 1 : -1]
        part[-half:] = front[::-1]


def rotate(buf: bytearray, start: int, cut: int, end: int) -> None:
    """Exchanges the neighbours ``buf[start:cut]`` and ``buf[cut:end]`` by three reversals."""
    reverse(buf, start, cut)
    reverse(buf, cut, end)
    reverse(buf, start, end)


class Cuts(NamedTuple):
    n: int  # units of the text
    first: int  # bytes before the middle
    second: int  # bytes before the suffix
    prefix_chars: int
    middle_chars: int


def scan(raw: np.ndarray, d: Draw) -> Cuts:
    """Counts the units of a text given as UTF-8 bytes, and finds the byte offsets of its cuts."""
    letter = ((raw | 32) >= 97) & ((raw | 32) <= 122) & (raw < 128)
    char = (raw & 0xC0) != 0x80  # first byte of a code point
    start = char & ~letter
    start[:1] |= letter[:1]
    start[1:] |= letter[1:] & ~letter[:-1]
    at = np.flatnonzero(start)
    n = len(at)
    a, b = sorted((d.first % (n + 1), d.second % (n + 1)))
    first, second = (int(at[k]) if k < n else len(raw) for k in (a, b))
    return Cuts(n, first, second, int(np.count_nonzero(char[:first])), int(np.count_nonzero(char[first:second])))


def transform_text(raw: bytes, d: Draw, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> tuple[str, bytes, Cuts]:
    """The form, the output and the cuts of a text in UTF-8."""
    cuts = scan(np.frombuffer(raw, np.uint8), d)
    if not raw or any(s in raw for s in (PREFIX, SUFFIX, MIDDLE)) or d.plain % 100 >= 100 - plain_percent:
        return "plain", raw, cuts
    buf = bytearray(raw)
    buf[cuts.second : cuts.second] = SUFFIX
    buf[cuts.first : cuts.first] = MIDDLE
    buf[0:0] = PREFIX
    middle = len(PREFIX) + cuts.first
    suffix = middle + len(MIDDLE) + cuts.second - cuts.first
    if d.form % 100 < spm_percent:
        rotate(buf, 0, suffix, len(buf))
        return "spm", bytes(buf), cuts
    rotate(buf, middle, suffix, len(buf))
    return "psm", bytes(buf), cuts


def restore_text(form: str, output: bytes) -> bytes:
    """The text that ``transform_text`` turned into ``output``; raises ValueError if a sentinel is missing."""
    if form == "plain":
        return output
    buf = bytearray(output)
    if form == "psm":
        suffix = buf.index(SUFFIX)
        middle = buf.index(MIDDLE, suffix)
        rotate(buf, suffix, middle, len(buf))
    else:
        prefix = buf.index(PREFIX)
        rotate(buf, 0, prefix, len(buf))
    # the order of the text again: <P>prefix<M>middle<S>suffix
    middle = buf.index(MIDDLE)
    suffix = buf.index(SUFFIX, middle)
    del buf[suffix : suffix + len(SUFFIX)], buf[middle : middle + len(MIDDLE)], buf[: len(PREFIX)]
    return bytes(buf)


def _batches(schema: pa.Schema, fn: Callable[..., dict]):
    """A mapInArrow function that hands ``fn`` the columns of every SLICE_ROWS rows, texts as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, SLICE_ROWS):
                columns = [c.cast(pa.binary() if pa.types.is_string(c.type) else pa.large_binary() if pa.types.is_large_string(c.type) else c.type) for c in b.slice(at, SLICE_ROWS).columns]
                out = fn(*(c.to_pylist() for c in columns))
                yield pa.RecordBatch.from_arrays([pa.array(out[f.name], pa.binary()).cast(f.type) if f.type == pa.string() else pa.array(out[f.name], f.type) for f in schema], schema=schema)

    return run


def transform(docs: DataFrame, id: str = "doc_id", text: str = "text", seed: str = SEED, plain_percent: int = PLAIN_PERCENT, spm_percent: int = SPM_PERCENT) -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output)``, one row per input row.

    ``n`` counts the units of the text.  A null text counts as empty; the hash
    of a null id is that of an empty one.  An empty text, one that holds a
    sentinel, and ``plain_percent`` of the others stay plain: their output is
    the text and their lengths are null.  Repeated rows give equal rows; an
    empty table gives no rows; other columns are not read, so their names may clash."""
    schema = pa.schema([("key", pa.string()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string())])

    def rows(keys, texts):
        got = []
        for k, t in zip(keys, texts):
            form, output, cuts = transform_text(t or b"", draw((k or b"").decode(), seed), plain_percent, spm_percent)
            lengths = (None, None) if form == "plain" else (cuts.prefix_chars, cuts.middle_chars)
            got.append((k, cuts.n, form.encode(), *lengths, output))
        return dict(zip(schema.names, zip(*got)))

    ddl = "key string, n long, form string, prefix_chars long, middle_chars long, output string"
    out = docs.select(F.col(id).cast("string").alias("key"), F.col(text).alias("text")).mapInArrow(_batches(schema, rows), ddl)
    return out.select(F.col("key").cast(docs.schema[id].dataType).alias(id), "n", "form", "prefix_chars", "middle_chars", "output")


def restore(transformed: DataFrame, id: str = "doc_id") -> DataFrame:
    """``(id, n, form, prefix_chars, middle_chars, output, restored)``: the rows of ``transform`` with the text rebuilt from output and form alone."""
    fields = [("key", pa.string()), ("n", pa.int64()), ("form", pa.string()), ("prefix_chars", pa.int64()), ("middle_chars", pa.int64()), ("output", pa.string()), ("restored", pa.string())]

    def rows(keys, n, forms, prefix, middle, outputs):
        restored = [restore_text(f.decode(), o) for f, o in zip(forms, outputs)]
        return {"key": keys, "n": n, "form": forms, "prefix_chars": prefix, "middle_chars": middle, "output": outputs, "restored": restored}

    ddl = "key string, n long, form string, prefix_chars long, middle_chars long, output string, restored string"
    given = transformed.select(F.col(id).cast("string").alias("key"), "n", "form", "prefix_chars", "middle_chars", "output")
    out = given.mapInArrow(_batches(pa.schema(fields), rows), ddl)
    return out.withColumnRenamed("key", id).withColumn(id, F.col(id).cast(transformed.schema[id].dataType))
