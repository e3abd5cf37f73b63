import hashlib
import random
import re
from functools import lru_cache

from siftlane.llm import conversations as C


def exhaustive(symbols):
    """The least (cost, edits) over all ways to edit the rows one by one."""

    def inserts(state):
        yield state, ""
        word = ""
        for _ in range(4):
            state, word = C.NEXT[state]["u" if "u" in C.NEXT[state] else "a"], word + "I"
            yield state, word

    @lru_cache(None)
    def rest(k, state):
        if k == len(symbols):
            return min((2 * len(w), w) for s, w in inserts(state) if s in (0, 3))
        role, fault = C.initial_of(symbols[k]), (ord(symbols[k]) - 65) % 4
        ways = []
        for s, w in inserts(state):
            steps = [(s, 3, "D")]
            if fault not in (C.BLANK, C.DUPLICATE):
                extra = fault == C.CUT
                steps += [(C.NEXT[s][role], extra, "K")] if role in C.NEXT[s] else []
                steps += [(C.NEXT[s][r], 2 + extra, "R") for r in "ua" if r in C.NEXT[s]]
            for to, cost, e in steps:
                more, after = rest(k + 1, to)
                ways.append((2 * len(w) + cost + more, w + e + after))
        return min(ways)

    return rest(0, 0)


def as_piece(m):
    return [-1 if e is None else e[0] for row in m for e in row], ["" if e is None else C.flat(e[1]) for row in m for e in row]


def random_symbols(r, n):
    return "".join(C.symbol(r.choice("suax"), r.choice((0, 0, 0, 1, 2, 3))) for _ in range(n))


def test_matrices_equal_exhaustive_search():
    r = random.Random(3)
    for i in range(1500):
        s = random_symbols(r, r.randint(1, 12) if i < 1450 else r.randint(60, 200))
        cuts = [0, *sorted(r.sample(range(1, len(s)), min(len(s) - 1, r.randint(0, 3)))), len(s)]
        pieces = [as_piece(m) for m in C.matrices([s[a:b] for a, b in zip(cuts, cuts[1:])], {})]
        cost, chosen = C.fold(pieces)
        assert (cost, "".join(e for _, e in chosen)) == exhaustive(s)


def test_rules_are_shared_and_exact():
    r = random.Random(4)
    seqs = [[r.choice((0, 0, 1, 2)) for _ in range(r.randint(1, 60))] for _ in range(50)] + [[0] * 9]
    rules, coded = C.re_pair(seqs, 3)
    spelled = [[0], [1], [2]]
    for x, y in rules:
        spelled.append(spelled[x] + spelled[y])
    assert [[t for c in s for t in spelled[c]] for s in coded] == seqs and len(rules) > 5
    assert sum(map(len, coded)) < sum(map(len, seqs)) / 2
    kept = {}
    some = [random_symbols(r, 30) for _ in range(20)]
    assert C.matrices(some, kept) == C.matrices(some, {}) and kept


def test_ropes():
    r = random.Random(5)

    def rope(n):
        return "".join(r.choice("DIKR") for _ in range(n)) if n < 4 else (rope(n // 2), rope(n - n // 2))

    ropes = [rope(r.randint(0, 30)) for _ in range(60)]
    ropes += [(ropes[i], ropes[-i]) for i in range(1, 30)]
    for a in ropes:
        for b in ropes:
            assert C.less(a, b) == (C.flat(a) < C.flat(b))
    assert C.flat(C.join(("a", "b"), "c")) == "abc" and C.join("", "x") == "x"


def plainly(rows):
    """The report and the repaired lines of one conversation, row by row."""
    rows = sorted(rows, key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
    seen, symbols = set(), ""
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = C.BLANK if not solid else C.DUPLICATE if (role, text) in seen else C.WHOLE if solid[-1] in ".!?" else C.CUT
        seen.add((role, text))
        symbols += C.symbol(role[:1], fault)
    faults = [(ord(c) - 65) % 4 for c in symbols]
    turns = [t for t, *_ in rows if t is not None]
    cost, edits = exhaustive(symbols)
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") or not (a[1] and b[1]) for a, b in zip(rows, rows[1:]))
    lines, state, at = [], 0, 0
    for e in edits:
        role = "u" if state != 2 else "a"
        if e == "I":
            lines.append(f"{C.NAMES[role]}:")
        else:
            if e == "K":
                role = rows[at][1][:1]
                lines.append(f"{rows[at][1]}:{rows[at][2]}")
            elif e == "R":
                lines.append(f"{C.NAMES[role]}:{rows[at][2]}")
            at += 1
        if e != "D":
            state = C.NEXT[state][role]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (gaps, faults.count(C.BLANK), faults.count(C.DUPLICATE), faults.count(C.CUT), illegal, cost, edits), lines


def conversation_rows(seed, n, roles=("user", "assistant", "system", "user", "assistant", "tool", "")):
    r = random.Random(seed)
    return [(r.choice((None, *range(2 * n))), r.choice(roles), r.choice(("", " \n", "Yes.", "so it is", "ok! ", "Why?", f"answer {r.random()}.", f"cut {r.random()}"))) for _ in range(n)]


def check(spark, given, monkeypatch=None):
    df = spark.createDataFrame([(c, *x, 1, "z") for c, rows in given.items() for x in rows], "conv_id long, turn long, role string, text string, position int, piece string")
    got = C.repair(df)
    report = {r.conv_id: tuple(r)[1:] for r in got.report.collect()}
    lines: dict = {}
    for r in got.rows.orderBy("position", "sub").collect():
        lines.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    hashes = {r.conv_id: r.sha256 for r in C.digests(got.rows).collect()}
    assert set(report) == set(given)
    for c, rows in given.items():
        want, out = plainly([(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows])
        assert report[c] == want and lines.get(c, []) == out
        assert hashes.get(c) == (hashlib.sha256("\n".join(out).encode()).hexdigest() if out else None)


def test_conversations_against_the_plain_way(spark):
    given = {i: conversation_rows(i, random.Random(i).randint(1, 9)) for i in range(60)}
    given[None] = [(0, "user", "Hi."), (1, None, None), (2, "assistant", "There!")]
    given[100] = [(0, "user", "Same.")] * 7 + [(0, "assistant", "Same.")] * 3  # repeated rows
    given[101] = [(None, "", "")] * 3  # all go
    check(spark, given)


def test_a_conversation_of_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(C, "PIECE_BITS", 2)
    check(spark, {1: conversation_rows(9, 150), 2: conversation_rows(10, 3), 3: [(i, "user" if i % 2 == 0 else "assistant", f"Turn {i}.") for i in range(40)]})


def test_empty_table_and_string_ids(spark):
    df = spark.createDataFrame([("a", 1, "user", "Q?"), ("a", 2, "user", "A."), ("b", 1, "system", "S.")], "conv_id string, turn int, role string, text string")
    got = C.repair(df)
    assert {r.conv_id: (r.cost, r.audit) for r in got.report.collect()} == {"a": (2, "KR"), "b": (3, "D")}
    assert [(r.role, r.text) for r in got.rows.orderBy("position", "sub").collect()] == [("user", "Q?"), ("assistant", "A.")]
    none = C.repair(df.limit(0))
    assert none.report.count() == none.rows.count() == C.digests(none.rows).count() == 0


def test_damage(spark):
    import zlib

    rows = [(c, t, "assistant", "One. Two! Three?") for c in (*range(40), None) for t in (0, 1, None)]
    got = sorted(map(str, C.damage(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).collect()))
    want = []
    for c, t, role, text in rows:
        k = zlib.crc32(f"{' ' if c is None else c}:{' ' if t is None else t}".encode()) % 20
        row = (c, t, "user" if k == 4 else role, "" if k == 1 else "One Two Three" if k == 2 else text)
        want += [row] * (0 if k == 0 else 2 if k == 3 else 1)
    from pyspark.sql import Row

    assert got == sorted(str(Row(conv_id=a, turn=b, role=c, text=d)) for a, b, c, d in want)
