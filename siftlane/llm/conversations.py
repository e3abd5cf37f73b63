"""Conversation structure repair by grammar-compressed dynamic programming (operator 13).

The rows of a conversation, in the order of their turns, become a sequence of
symbols: the class of the role and the fault of the row.  A repair keeps,
re-roles or deletes each row and inserts empty ones, so that the role initials
follow ``(s?(ua)+)?``; the cheapest wins, of equal ones the one whose edits,
written as a string of K, R, D and I, come first in ASCII order.

The states of that pattern are four, so a run of rows is a 4 x 4 matrix over
(cost, edits) under minimum and concatenation.  Re-Pair replaces the frequent
pairs of symbols by rules, over all sequences of a batch at once; the matrix
of a rule is the product of its two parts, computed once and shared by all
conversations in which the rule occurs.  Edits are ropes, so a rule shares
those of its parts.

No two edit strings of one cost and one run of rows can be prefixes of each
other (a longer one has further inserts and costs more), so comparing before
or after concatenation gives the same order, and the products are exact.

Scale.  Rows get a global position from one range partitioning, in which a
long conversation spans many tasks.  Faults, matrices, edits and the repaired
text are computed for pieces of at most ``2 ** PIECE_BITS`` rows; only one
narrow matrix a piece meets in the fold over a conversation, and only finished
blocks of text in its digest.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import freeze
from .common import SLICE_ROWS, worker_cache

#: White space of the fault rules.
WHITE = " \t\n\x0b\x0c\r"
#: Costs of the edits; a truncated row that is not deleted adds TRUNCATED.
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: Faults of a row, the first that fits.
WHOLE, BLANK, DUPLICATE, CUT = range(4)
#: Role initials with a class of their own; all others share the next.
INITIALS = "sua"
#: States: nothing yet, after s, after u, after a.  What s, u and a lead to.
STATES = 4
NEXT = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
FINAL = (0, 3)
NAMES = {"u": "user", "a": "assistant"}
#: A piece of a conversation has at most 2 ** PIECE_BITS rows.
PIECE_BITS = 9
#: Matrices that a worker remembers; then it starts anew.
MATRICES_KEPT = 50_000
#: A pair of symbols becomes a rule while it makes up this share of all symbols, and occurs twice.
RULE_SHARE = 1 / 200
#: Longer edits are ropes of their parts.
LEAF = 256


# ropes: a string, or a pair of ropes


def join(a, b):
    """The rope of ``a`` followed by ``b``."""
    if not a or not b:
        return a or b
    return a + b if isinstance(a, str) and isinstance(b, str) and len(a) + len(b) <= LEAF else (a, b)


def flat(rope) -> str:
    out, todo = [], [rope]
    while todo:
        x = todo.pop()
        if isinstance(x, str):
            out.append(x)
        else:
            todo += (x[1], x[0])
    return "".join(out)


def less(a, b) -> bool:
    """Whether the text of rope ``a`` comes before that of ``b``; parts that they share are skipped."""
    left, right = [a], [b]
    while left and right:
        x, y = left.pop(), right.pop()
        if x is y:
            continue
        if isinstance(x, str) and isinstance(y, str):
            n = min(len(x), len(y))
            if x[:n] != y[:n]:
                return x < y
            if len(x) > n:
                left.append(x[n:])
            if len(y) > n:
                right.append(y[n:])
            continue
        for stack, z in ((left, x), (right, y)):
            stack += [z] if isinstance(z, str) else [z[1], z[0]]
    return not any(map(flat, left)) and any(map(flat, right))


def better(x, y) -> bool:
    """Whether the entry ``x``, a (cost, edits), beats ``y``."""
    return y is None or x[0] < y[0] or x[0] == y[0] and less(x[1], y[1])


# matrices: [from][to] is a (cost, edits) or None


def product(a: list, b: list) -> list:
    """The min-plus product: the best way from i to j through any state between."""
    out = []
    for row in a:
        best = [None] * STATES
        for k, x in enumerate(row):
            if x is None:
                continue
            for j, y in enumerate(b[k]):
                if y is None:
                    continue
                cost, have = x[0] + y[0], best[j]
                if have is None or cost < have[0]:
                    best[j] = cost, join(x[1], y[1])
                elif cost == have[0]:
                    edits = join(x[1], y[1])
                    if less(edits, have[1]):
                        best[j] = cost, edits
        out.append(best)
    return out


def _inserts() -> list:
    """Only inserts: from each state to each that they reach."""
    out = []
    for i in range(STATES):
        row, at, edits = [None] * STATES, i, ""
        row[i] = 0, ""
        for role in ("ua" if "u" in NEXT[i] else "au"):  # a third insert would come back to a state seen
            at, edits = NEXT[at][role], edits + "I"
            if row[at] is None:
                row[at] = len(edits) * INSERT, edits
        out.append(row)
    return out


INSERTS = _inserts()


def symbol(initial: str, fault: int) -> str:
    """One character for the class of a role and the fault of its row."""
    at = INITIALS.find(initial) if initial else -1
    return chr(65 + 4 * (at if at >= 0 else len(INITIALS)) + fault)


def initial_of(sym: str) -> str:
    """The role initial of a symbol; empty for the roles without a class."""
    return INITIALS[(ord(sym) - 65) // 4 : (ord(sym) - 65) // 4 + 1]


def rerole(state: int) -> str:
    """The role initial that a changed or inserted row takes after ``state``."""
    return "u" if "u" in NEXT[state] else "a"


def of_symbol(sym: str) -> list:
    """Any inserts, then the edit of one row."""
    role, fault = initial_of(sym), (ord(sym) - 65) % 4
    row = []
    for i in range(STATES):
        to: list = [None] * STATES
        to[i] = DELETE, "D"
        if fault not in (BLANK, DUPLICATE):
            extra = TRUNCATED if fault == CUT else 0
            for end, entry in ((NEXT[i][rerole(i)], (REROLE + extra, "R")), (NEXT[i].get(role), (extra, "K"))):
                if end is not None and better(entry, to[end]):
                    to[end] = entry
        row.append(to)
    return product(INSERTS, row)


def re_pair(sequences: list[list[int]], first_rule: int, share: float = RULE_SHARE) -> tuple[list[tuple[int, int]], list[list[int]]]:
    """Re-Pair over all sequences: the rules (rule ``first_rule + i`` stands for the i-th pair), and the sequences in them."""
    if not sequences:
        return [], []
    flat_ = np.concatenate([np.append(np.asarray(s, np.int64), -1) for s in sequences])
    rules: list[tuple[int, int]] = []
    while len(flat_) > 1:
        size = first_rule + len(rules)
        a, b = flat_[:-1], flat_[1:]
        inside = (a >= 0) & (b >= 0)
        count = np.bincount(a[inside] * size + b[inside], minlength=1)
        x, y = divmod(int(count.argmax()), size)
        if count.max() < max(2, share * len(flat_)):
            break
        at = np.flatnonzero((a == x) & (b == y))
        if x == y:  # of a run, every other one
            start = np.append(True, np.diff(at) > 1)
            at = at[(np.arange(len(at)) - np.maximum.accumulate(np.where(start, np.arange(len(at)), 0))) % 2 == 0]
            if len(at) < 2:
                break
        flat_[at] = size
        flat_ = np.delete(flat_, at + 1)
        rules.append((x, y))
    ends = np.flatnonzero(flat_ < 0)
    return rules, [flat_[s:e].tolist() for s, e in zip(np.append(0, ends[:-1] + 1), ends)]


def matrices(sequences: list[str], kept: dict) -> list[list]:
    """The matrix of every sequence of symbols.  ``kept`` remembers matrices by the symbols that they stand for."""
    if len(kept) > MATRICES_KEPT:
        kept.clear()
    new = sorted({s for s in sequences if s not in kept})
    terminals = sorted({c for s in new for c in s})
    numbers = {c: i for i, c in enumerate(terminals)}
    rules, coded = re_pair([[numbers[c] for c in s] for s in new], len(terminals))
    spelled = list(terminals)
    for c in terminals:
        if c not in kept:
            kept[c] = of_symbol(c)
    for x, y in rules:  # bottom-up: parts come before the rules that use them
        s = spelled[x] + spelled[y]
        spelled.append(s)
        if s not in kept:
            kept[s] = product(kept[spelled[x]], kept[spelled[y]])
    for s, parts in zip(new, coded):
        m = kept[spelled[parts[0]]]
        for p in parts[1:]:
            m = product(m, kept[spelled[p]])
        kept[s] = m
    return [kept[s] for s in sequences]


def fold(pieces: list[tuple[list, list]]) -> tuple[int, list[tuple[int, str]]]:
    """The cheapest repair of a conversation, given the (costs, edits) of its pieces' matrices in order: its cost, and for each piece the state it starts in and its edits."""
    now = [(0, "", None)] + [None] * (STATES - 1)  # cost, edits so far, (the entry before, state, edits of the piece)
    for costs, edits in pieces:
        after: list = [None] * STATES
        for i, x in enumerate(now):
            if x is None:
                continue
            for j in range(STATES):
                c = costs[i * STATES + j]
                if c < 0:
                    continue
                e = edits[i * STATES + j]
                entry = (x[0] + c, (x[1], e), (x[2], i, e))
                if better(entry, after[j]):
                    after[j] = entry
        now = after
    best = None
    for i, x in enumerate(now):
        for j in FINAL:
            if x is not None and INSERTS[i][j] is not None:
                more = INSERTS[i][j]
                entry = (x[0] + more[0], (x[1], more[1]), x[2], more[1])
                if better(entry, best):
                    best = entry
    chosen, back = [], best[2]
    while back:
        chosen.append((back[1], back[2]))
        back = back[0]
    chosen.reverse()
    if chosen:
        chosen[-1] = chosen[-1][0], chosen[-1][1] + best[3]
    return best[0], chosen


def row_edits(symbols: str, state: int, edits: str) -> Iterator[tuple[int, bool, str | None, list[str], list[str]]]:
    """Of each row that is not simply kept: its number, whether it goes, its new role, and the roles inserted before and after it."""
    at, waiting = 0, []
    held = None  # the latest row, in case that inserts follow it at the end
    for e in edits:
        if e == "I":
            role = rerole(state)
            waiting.append(NAMES[role])
            state = NEXT[state][role]
            continue
        if held and (held[1] or held[2] or held[3]):
            yield held
        role = None
        if e == "R":
            role = rerole(state)
            state = NEXT[state][role]
        elif e == "K":
            state = NEXT[state][initial_of(symbols[at])]
        held = (at, e == "D", role and NAMES[role], waiting, [])
        at, waiting = at + 1, []
    if held and (held[1] or held[2] or held[3] or waiting):
        yield (*held[:4], waiting)


# Spark


def damage(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``rows`` with faults by crc32(conv:turn) % 20: 0 drops a row, 1 empties its text, 2 takes its ``.!?`` out, 3 repeats it, 4 makes it the user's.  Nulls count as one space there; conv and turn stay."""
    key = F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in (conv, turn)))
    kind = F.crc32(key) % 20
    r, t = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    given = rows.select(conv, turn, r.alias(role), t.alias(text), kind.alias("kind")).where("kind <> 0")
    t = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.translate(text, ".!?", "")).otherwise(F.col(text))
    r = F.when(F.col("kind") == 4, "user").otherwise(F.col(role))
    copies = F.explode(F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))
    return given.select(conv, turn, r.alias(role), t.alias(text), copies.alias("copy")).drop("copy")


@dataclass
class Repaired:
    """``report``: (conv, gaps, blank, duplicate, truncated, illegal, cost, audit), one row per conversation given.
    ``rows``: (conv, position, sub, turn, role, text), the repaired rows, ordered by position and sub; an inserted one has no turn."""

    report: DataFrame
    rows: DataFrame


def _piece(position: str = "position") -> Column:
    return F.shiftright(position, PIECE_BITS)


def _ordered(rows: DataFrame) -> DataFrame:
    """``rows`` with a position that follows (conv, turn, role, text), nulls first; equal rows are spread by their place in the input."""
    keys = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), F.col("role"), F.substring("text", 1, 64), F.sha2("text", 256), F.col("place")]
    placed = rows.withColumn("place", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    return freeze(placed.select("conv", "turn", "role", "text", F.monotonically_increasing_id().alias("position")), "turns")


def _symbols(placed: DataFrame) -> DataFrame:
    """(conv, piece, first, symbols): the faults of each piece's rows as one string."""
    last = F.right(F.rtrim("text", F.lit(WHITE)), F.lit(1))
    digest = F.unhex(F.md5(F.concat_ws("\0", "role", "text")))
    known = F.instr(F.lit(INITIALS), F.substring("role", 1, 1))
    kind = F.when((known > 0) & (F.length("role") > 0), known - 1).otherwise(len(INITIALS))
    fault = F.when(last == "", BLANK).when(last.isin(".", "!", "?"), WHOLE).otherwise(CUT)
    narrow = placed.select("conv", "position", digest.alias("digest"), kind.alias("kind"), fault.alias("fault"))
    seen = narrow.where(F.col("fault") != BLANK).groupBy("conv", "digest").agg(F.min("position").alias("position"))
    fresh = narrow.drop("digest").join(seen.select("position", F.lit(True).alias("fresh")), "position", "left")
    fault = F.when((F.col("fault") == BLANK) | F.col("fresh"), F.col("fault")).otherwise(DUPLICATE)
    coded = fresh.select("conv", "position", F.char(65 + 4 * F.col("kind") + fault).alias("symbol"))
    got = F.array_sort(F.collect_list(F.struct("position", "symbol")))
    grouped = coded.groupBy("conv", _piece().alias("piece")).agg(got.alias("got"))
    return grouped.select("conv", "piece", F.col("got")[0]["position"].alias("first"), F.array_join(F.col("got.symbol"), "").alias("symbols"))


WEIGHED = "costs array<int>, edits array<string>"


def _weigh(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the matrix of each piece."""
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            part = b.slice(at, SLICE_ROWS)
            got = matrices(part.column("symbols").to_pylist(), worker_cache("conversations"))
            costs = [[-1 if e is None else e[0] for row in m for e in row] for m in got]
            edits = [["" if e is None else flat(e[1]) for row in m for e in row] for m in got]
            yield pa.RecordBatch.from_arrays([*part.columns, pa.array(costs, pa.list_(pa.int32())), pa.array(edits, pa.list_(pa.string()))], [*part.schema.names, "costs", "edits"])


def _groups(batches: Iterator[pa.RecordBatch], *columns: str) -> Iterator[tuple[pa.Scalar, list[tuple]]]:
    """Rows of sorted batches, one list per conversation."""
    last, held, some = None, [], False
    for b in batches:
        convs = b.column("conv").to_pylist()
        for c, *row in zip(convs, *(b.column(n).to_pylist() for n in columns)):
            if some and c != last:
                yield last, held
                held = []
            last, some = c, True
            held.append(row)
    if some:
        yield last, held


CHOSEN = "piece long, first long, symbols string, state int, edits string, blank long, duplicate long, truncated long, illegal long, cost long"
LEGAL = {"su", "ua", "au"}


def _choose(conv_type: pa.DataType):
    """A mapInArrow function over sorted pieces: the edits chosen for each, with its counts; the cost stands in the first."""
    fields = [("conv", conv_type), ("piece", pa.int64()), ("first", pa.int64()), ("symbols", pa.string()), ("state", pa.int32()), ("edits", pa.string())]
    schema = pa.schema([*fields, *((n, pa.int64()) for n in ("blank", "duplicate", "truncated", "illegal", "cost"))])

    def run(batches):
        out = []
        for conv, pieces in _groups(batches, "piece", "first", "symbols", "costs", "edits"):
            cost, chosen = fold([(p[3], p[4]) for p in pieces])
            before = None
            for (piece, first, symbols, _, _), (state, edits) in zip(pieces, chosen):
                faults = [(ord(c) - 65) % 4 for c in symbols]
                roles = [initial_of(c) for c in symbols]
                pairs = zip(roles if before is None else [before, *roles], roles[1:] if before is None else roles)
                illegal = sum(x + y not in LEGAL for x, y in pairs)
                out.append((conv, piece, first, symbols, state, edits, faults.count(BLANK), faults.count(DUPLICATE), faults.count(CUT), illegal, cost))
                before, cost = roles[-1], 0
            if len(out) >= SLICE_ROWS:
                yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
                out = []
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)

    return run


EDITS = "position long, gone boolean, new string, before array<string>, after array<string>"


def _spell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The rows that a repair changes, by position."""
    names = pa.list_(pa.string())
    schema = pa.schema([("position", pa.int64()), ("gone", pa.bool_()), ("new", pa.string()), ("before", names), ("after", names)])
    for b in batches:
        for at in range(0, b.num_rows, SLICE_ROWS):
            part = b.slice(at, SLICE_ROWS).to_pylist()
            got = [(r["first"] + n, *e) for r in part for n, *e in row_edits(r["symbols"], r["state"], r["edits"])]
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, g)) for g in got], schema)


def repair(rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> Repaired:
    """The cheapest repair of every conversation of ``rows``.

    Rows of one turn are taken by role and text; null roles and texts count as
    one space, rows without a conversation are one conversation.  Repeated rows
    are duplicates (a fault), an empty table gives empty results, and other
    columns are not read, so their names may clash."""
    from pyspark.sql.pandas.types import to_arrow_type

    r, t = (F.coalesce(F.col(c), F.lit(" ")) for c in (role, text))
    placed = _ordered(rows.select(F.col(conv).alias("conv"), F.col(turn).alias("turn"), r.alias("role"), t.alias("text")))
    kind = placed.schema["conv"].dataType
    ddl = f"conv {kind.simpleString()}, "
    pieces = _symbols(placed).mapInArrow(_weigh, ddl + f"piece long, first long, symbols string, {WEIGHED}")
    by_conv = pieces.repartition("conv").sortWithinPartitions("conv", "piece")
    chosen = freeze(by_conv.mapInArrow(_choose(to_arrow_type(kind)), ddl + CHOSEN), "repairs")
    audit = F.array_join(F.col("got.edits"), "")
    sums = [F.sum(c).alias(c) for c in ("blank", "duplicate", "truncated", "illegal", "cost")]
    told = chosen.groupBy("conv").agg(*sums, F.array_sort(F.collect_list(F.struct("piece", "edits"))).alias("got")).withColumn("audit", audit).drop("got")
    gaps = F.coalesce(F.max("turn") - F.min("turn") + 1 - F.countDistinct("turn"), F.lit(0)).cast("long")
    spans = placed.groupBy(F.col("conv").alias("same")).agg(gaps.alias("gaps"))
    report = told.join(spans, F.col("conv").eqNullSafe(F.col("same"))).select(F.col("conv").alias(conv), "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit")

    edits = chosen.select("first", "symbols", "state", "edits").mapInArrow(_spell, EDITS)
    new = placed.join(edits, "position", "left")
    nobody = F.lit(None).cast(placed.schema["turn"].dataType)

    def inserted(column: str) -> Column:
        return F.transform(F.coalesce(column, F.array().cast("array<string>")), lambda x: F.struct(nobody.alias("turn"), x.alias("role"), F.lit("").alias("text")))

    own = F.when(F.coalesce("gone", F.lit(False)), F.array()).otherwise(F.array(F.struct("turn", F.coalesce("new", "role").alias("role"), "text")))
    out = new.select("conv", "position", F.posexplode(F.concat(inserted("before"), own, inserted("after"))).alias("sub", "x"))
    return Repaired(report, out.select(F.col("conv").alias(conv), "position", "sub", "x.turn", "x.role", "x.text"))


def digests(rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """``(conv, sha256)`` of the ``role:text`` lines of each conversation of ``Repaired.rows``, joined by newlines.

    Lines are joined into one block a piece first; a conversation's blocks then
    stream through one running digest."""
    from pyspark.sql.pandas.types import to_arrow_type

    line = F.concat_ws(":", "role", "text").alias("line")
    got = F.array_sort(F.collect_list(F.struct("position", "sub", line)))
    blocks = rows.groupBy(F.col(conv).alias("conv"), _piece().alias("piece")).agg(got.alias("got"))
    blocks = blocks.select("conv", "piece", F.array_join(F.col("got.line"), "\n").alias("block"))
    kind = rows.schema[conv].dataType
    schema = pa.schema([(conv, to_arrow_type(kind)), ("sha256", pa.string())])

    def run(batches):
        last, running = None, None
        for b in batches:
            out = []
            for c, block in zip(b.column("conv").to_pylist(), b.column("block").cast(pa.binary())):
                if running is not None and c == last:
                    running.update(b"\n")
                else:
                    if running is not None:
                        out.append((last, running.hexdigest()))
                    last, running = c, hashlib.sha256()
                running.update(block.as_buffer())
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in out], schema)
        if running is not None:
            yield pa.RecordBatch.from_pylist([dict(zip(schema.names, (last, running.hexdigest())))], schema)

    return blocks.repartition("conv").sortWithinPartitions("conv", "piece").mapInArrow(run, f"`{conv}` {kind.simpleString()}, sha256 string")
