import hashlib
import random
import re

import pytest

from siftlane.llm import infill as I

UNIT = re.compile(r"[A-Za-z]+|[^A-Za-z]")


def by_definition(t, d):
    u = UNIT.findall(t)
    a, b = sorted((d.first % (len(u) + 1), d.second % (len(u) + 1)))
    p, m, s = "".join(u[:a]), "".join(u[a:b]), "".join(u[b:])
    if not t or any(x in t for x in ("<P>", "<S>", "<M>")) or d.plain % 100 >= 90:
        return "plain", t, len(u), None, None
    return ("spm", f"<S>{s}<P>{p}<M>{m}", len(u), len(p), len(m)) if d.form % 100 < 20 else ("psm", f"<P>{p}<S>{s}<M>{m}", len(u), len(p), len(m))


def test_rotation_equals_concatenation():
    r = random.Random(1)
    seen = set()
    for i in range(4000):
        t = "".join(r.choice("abZ é日😀\n<PSM>.") for _ in range(r.randint(0, 40)))
        d = I.draw(str(i))
        form, out, cuts = I.transform_text(t.encode(), d)
        want = by_definition(t, d)
        assert (form, out.decode(), cuts.n) == want[:3]
        assert form == "plain" or (cuts.prefix_chars, cuts.middle_chars) == want[3:]
        assert I.restore_text(form, out).decode() == t
        seen.add((form, want[3] == 0, want[4] == 0))
    assert len(seen) >= 8  # every form, empty segments included


def test_reverse_and_rotate_in_place():
    for n in range(9):
        for a in range(n + 1):
            for b in range(a, n + 1):
                for c in range(b, n + 1):
                    buf = bytearray(range(n))
                    same = buf
                    I.rotate(buf, a, b, c)
                    x = bytes(range(n))
                    assert same is buf and bytes(buf) == x[:a] + x[b:c] + x[a:b] + x[c:]


def test_a_missing_sentinel_is_an_error():
    with pytest.raises(ValueError):
        I.restore_text("psm", b"<P>ab<S>c")


def test_odd_documents(spark, odd_docs):
    out = I.restore(I.transform(odd_docs))
    rows = out.collect()
    texts = sorted(r.text or "" for r in odd_docs.collect())
    assert sorted(r.restored for r in rows) == texts  # one row per row, repeats and nulls too
    for r in rows:
        raw = hashlib.sha256(f"1:{'' if r.doc_id is None else r.doc_id}".encode()).hexdigest()
        d = I.Draw(*(int(raw[i : i + 8], 16) for i in range(0, 32, 8)))
        form, output, *rest = by_definition(r.restored, d)
        assert (r.form, r.output, r.n) == (form, output, rest[0])
        assert (r.prefix_chars, r.middle_chars) == ((None, None) if form == "plain" else tuple(rest[1:]))
    assert dict(out.dtypes)["doc_id"] == "bigint"
    assert I.restore(I.transform(odd_docs.limit(0))).count() == 0


def test_string_ids_and_parameters(spark):
    docs = spark.createDataFrame([(f"d{i}", "some words here, and more.") for i in range(300)], "doc_id string, text string")
    rows = I.transform(docs, plain_percent=50, spm_percent=100).collect()
    assert {r.form for r in rows} == {"plain", "spm"} and 100 < sum(r.form == "plain" for r in rows) < 200
    assert {r.doc_id for r in rows} == {f"d{i}" for i in range(300)}
