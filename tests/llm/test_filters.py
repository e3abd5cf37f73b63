import hashlib
import random
import re
import string

import numpy as np
import pytest

from siftlane.llm import decontam as DE
from siftlane.llm import quality as QU
from siftlane.llm import secrets as SE
from siftlane.llm import toxicity as TX

# ---- secrets ---------------------------------------------------------------

KEYS = r"(?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY])"


def base_by_hand(t):
    out = [(m.start(), 0, m.end()) for m in re.finditer(KEYS + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t) if len(m[1]) >= 6]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", t) if len(m[0]) >= 24]
    return sorted(out)


def test_base_spans_equal_the_patterns():
    r = random.Random(4)
    parts = ["token", "Secret", "API_KEY", "apikey", "paſsword", "passwd", "AKIA", "AKIA" + "A1" * 8, "=", ":", " ", '"', "'", "abc", "abcdef", "0f" * 11, "0f" * 12, "é", "\n", "x.y", "==", "token:token:abcdefg"]
    for _ in range(4000):
        t = "".join(r.choice(parts) for _ in range(r.randint(0, 14)))
        assert SE.base_spans(t) == base_by_hand(t), t


def test_secret_scan(spark, odd_docs, make_text):
    r = random.Random(9)
    rand = "".join(r.choice(string.ascii_letters + string.digits) for _ in range(40))
    word = make_text(12, 8).replace(" ", "") + "2"
    extra = spark.createDataFrame([(50, f"{make_text(7, 300)} {rand} end {word} password = {'a1B2' * 4} x", "en", 0, "z")], odd_docs.schema)
    docs = odd_docs.unionByName(extra)
    model = SE.train(docs)
    rows = SE.scan(docs, model).collect()
    assert len(rows) == docs.count()
    (hit,) = [x for x in rows if x.doc_id == 50]
    text = extra.first().text
    assert f"markov:{text.index(rand)}:{text.index(rand) + 40}" in hit.spans.split(",")
    assert f"markov:{text.index(word)}" not in hit.spans and (hit.n_assign, hit.n_markov) == (1, 1)
    base = [s for s in hit.spans.split(",") if not s.startswith("markov")]
    assert hit.base_sha256 == hashlib.sha256(",".join(base).encode()).hexdigest()
    assert all(x.spans == "" and x.base_sha256 == hashlib.sha256(b"").hexdigest() for x in rows if x.doc_id != 50)
    clean = {x.doc_id: x.text for x in SE.redact(docs, model).collect()}
    assert rand not in clean[50] and "a1B2" not in clean[50] and word in clean[50] and clean[2] is None and clean[4] == "  \n\t "
    assert SE.scan(docs.limit(0), SE.train(docs.limit(0))).count() == 0


def test_secrets_are_found_at_any_number(spark, odd_docs, make_text):
    r = random.Random(11)
    chars = string.ascii_letters + string.digits

    def secret():
        return "".join(r.choice(chars) for _ in range(40)) + "7a"

    word = make_text(12, 8).replace(" ", "") + "2"
    same = secret()
    for n in (1, 2000):
        for copies in (True, False):
            hidden = [same if copies else secret() for _ in range(n)]
            docs = spark.createDataFrame([(i, f"{make_text(i % 50, 30)} {x} {word}", "en", 0, "z") for i, x in enumerate(hidden)], odd_docs.schema).unionByName(odd_docs)
            got = {x.doc_id: x.spans for x in SE.scan(docs, SE.train(docs)).where("spans <> ''").collect()}
            assert all(got[i].count(":") == 2 and got[i].startswith("markov:") for i in range(n)) and len(got) == n, (n, copies)


def test_secrets_of_many_alphabets_among_identifiers(spark):
    """Recall of planted random strings and false alarms on identifiers, paths, dates and plain documents."""
    r = random.Random(5)
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    prose = [x for d in docs.collect() for x in d.text.split() if x.isalpha() and x.isascii()]
    letters, digits = string.ascii_letters, string.digits

    def rand(alphabet, n):
        return "".join(r.choice(alphabet) for _ in range(n))

    def w():
        return r.choice(prose).lower()

    secret = [
        lambda: rand(letters + digits, 32) + "a7", lambda: rand(letters + digits + "+/", 40) + "b1", lambda: rand(letters + digits + "-_", 43) + "9z", lambda: rand(string.ascii_uppercase + "234567", 32) + "A2",
        lambda: rand(string.ascii_lowercase + digits, 32) + "a1", lambda: rand(digits + "ABCDEF", 40) + "A1", lambda: rand(letters + digits, 20) + "x3", lambda: "ghp_" + rand(letters + digits, 36) + "k0",
    ]
    ordinary = [
        lambda: f"{w()}_{w()}_{w()}_{w()}{r.randint(1, 99)}", lambda: "".join(w().title() for _ in range(4)) + str(r.randint(1, 9)), lambda: f"usr/lib/{w()}/{w()}/{w()}/v{r.randint(1, 20)}",
        lambda: f"{w()}-{w()}-{w()}-{w()}-{r.randint(2000, 2026)}", lambda: f"{w()}_{w()}_{w()}_{r.randint(1, 64)}".upper(), lambda: f"{w()}-20{r.randint(10, 26)}-0{r.randint(1, 9)}-{r.randint(10, 28)}T12-00-{r.randint(10, 59)}",
        lambda: f"{w()}-{w()}-{r.randint(1, 9)}_{r.randint(0, 99)}_{r.randint(0, 9)}-linux",
    ]
    planted = [(1_000_000 + i, y, f()) for i, (y, f) in enumerate([(1, f) for f in secret for _ in range(40)] + [(0, f) for f in ordinary for _ in range(40)])]
    more = [(i, f"{' '.join(r.choices(prose, k=40))} {x} {' '.join(r.choices(prose, k=40))}") for i, _, x in planted]
    every = docs.unionByName(spark.createDataFrame(more, "doc_id long, text string"))
    got = {x.doc_id: x for x in SE.scan(every, SE.train(every)).collect()}
    found = [bool(got[i].spans) for i, y, _ in planted if y]
    assert sum(found) >= 0.95 * len(found), sum(found)
    assert sum(got[i].n_markov for i, y, _ in planted if not y) <= 3  # of 280
    megabytes = sum(len(d.text) for d in docs.collect()) / 1e6
    assert sum(got[d.doc_id].n_markov for d in docs.select("doc_id").collect()) <= 2 * megabytes


def test_the_rest_of_a_token_beside_a_base_span_is_judged(spark, odd_docs, make_text):
    r = random.Random(12)
    rand = "".join(r.choice(string.ascii_letters + string.digits) for _ in range(40)) + "Z9"
    texts = [f"AKIA{'A1' * 8}/{rand} end", f"{rand}{'0f' * 12}{rand}", "AKIA" + "A1" * 8 + "/short1"]
    docs = odd_docs.unionByName(spark.createDataFrame([(60 + i, f"{make_text(8, 50)} {t}", "en", 0, "z") for i, t in enumerate(texts)], odd_docs.schema))
    model = SE.train(docs)
    n = {x.doc_id: x.n_markov for x in SE.scan(docs, model).collect()}
    assert (n[60], n[61], n[62]) == (1, 2, 0)
    clean = {x.doc_id: x.text for x in SE.redact(docs, model).collect()}
    assert all(rand not in clean[i] for i in (60, 61))


# ---- decontamination -------------------------------------------------------


def words(t):
    return [w for w in re.split(r"[\W_]+", (t or "").lower()) if w]


def contained_by_hand(docs, items):
    out = set()
    for i, t in items:
        w = words(t)
        k = min(5, len(w))
        mine = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if w else set()
        if i is None or not mine:
            continue
        for d, x in set(docs):
            v = words(x)
            n = len(mine & {tuple(v[j : j + k]) for j in range(len(v) - k + 1)})
            if n >= 0.8 * len(mine) - 1e-9:
                out.add((-1 if d is None else d, i, n, len(mine)))
    return out


@pytest.mark.parametrize("hinted", [True, False])
def test_containment_equals_brute_force(spark, odd_docs, make_text, monkeypatch, hinted):
    if not hinted:
        monkeypatch.setattr(DE, "BROADCAST_ROWS", -1)
    r = random.Random(8)
    items = [(i, make_text(100 + i, r.choice((3, 5, 6, 12, 40)))) for i in range(12)] + [(90, None), (91, ""), (None, make_text(1, 10)), (92, "word"), (93, make_text(1, 30)), (93, make_text(1, 30)), (94, "ÜNÏCØDÉ, ß!")]
    long = make_text(5, 3000).split()
    rows = []
    for i in range(40):
        w = items[i % 12][1].split()
        for _ in range(i % 4):  # changed words break shingles
            w[r.randrange(len(w))] = "changed"
        at = r.randrange(len(long))
        rows.append((200 + i, " ".join(long[:at] + w + long[at:]).upper() if i % 2 else ", ".join(w), "en", 0, "x"))
    docs = odd_docs.where("doc_id is null or doc_id <> 9").unionByName(spark.createDataFrame(rows + rows[:3], odd_docs.schema))
    table = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, doc_id int")
    found = DE.contained_items(docs, table)
    got = sorted((-1 if x.doc_id is None else x.doc_id, x.item_id, x.shared, x.item_shingles) for x in found.collect())
    want = contained_by_hand([(x.doc_id, x.text) for x in docs.collect()], items)
    assert got == sorted(want) and len(want) > 10
    kept = DE.without_contaminated(docs, table)
    bad = {d for d, *_ in want}
    assert sorted(map(str, kept.collect())) == sorted(str(x) for x in docs.collect() if (-1 if x.doc_id is None else x.doc_id) not in bad or (x.doc_id is None and x.text is None))
    assert "Python" not in found._jdf.queryExecution().toString()
    assert DE.contained_items(docs.limit(0), table).count() == 0 and DE.contained_items(docs, table.limit(0)).count() == 0


# ---- quality ---------------------------------------------------------------


def test_ordinal_fit_orders_grades():
    r = np.random.default_rng(0)
    x = np.abs(r.normal(size=(600, QU.DIM))).astype(np.float32) * 0.01
    x[:, 0] = r.uniform(-1, 1, 600)
    y = np.digitize(x[:, 0] + r.normal(0, 0.1, 600), [-0.3, 0.4])
    m = QU.fit(x, y)
    tails = m.tails(x)
    assert m.grades == [0, 1, 2] and m.thresholds[0] < m.thresholds[1] and (np.diff(tails, axis=1) <= 0).all()
    expected = tails[:, 1:].sum(1)
    assert np.corrcoef(expected, x[:, 0])[0, 1] > 0.95 and (np.round(expected) == y).mean() > 0.75


def test_every_piece_of_a_long_word_counts():
    word = "".join(chr(0x4E00 + i % 50) for i in range(64 * 5))
    a, b = (QU.features(word + tail, {}) for tail in ("日" * 64, "!" * 64))
    assert (a != b).any() and a[: QU.SHAPES].sum() > 0
    assert (QU.features("日本語 " * 3 + "x", {}) == QU.features("日本語 日本語\n日本語 x", {})).all()


def test_ordinal_fit_against_a_plain_one():
    """Three grades, few features: plain descent on the penalised likelihood, with numerical gradients, ends at the same loss."""
    r = np.random.default_rng(2)
    x = np.zeros((200, QU.DIM), np.float32)
    x[:, :3] = r.normal(size=(200, 3))
    score = x[:, :3] @ np.array([1.5, -1.0, 0.3]) + r.logistic(size=200)
    y = np.digitize(score, [-1.0, 1.0]) * 2 + 1  # grades 1, 3, 5

    def loss(w, t):
        cut = np.concatenate([[-np.inf], t, [np.inf]])
        s, k = x[:, :3] @ w, (y - 1) // 2
        p = 1 / (1 + np.exp(s - cut[k + 1])) - 1 / (1 + np.exp(s - cut[k]))
        return -np.log(p).mean() + QU.PENALTY / 2 * (w @ w)

    v = np.array([0.0, 0.0, 0.0, -0.5, 0.5])
    for _ in range(600):
        g = np.array([(loss(*np.split(v + e, [3])) - loss(*np.split(v - e, [3]))) / 2e-5 for e in np.eye(5) * 1e-5])
        v -= 0.5 * g
    m = QU.fit(x, y)
    assert m.grades == [1, 3, 5] and (np.diff(m.thresholds) > 0).all()
    assert loss(m.weights[:3], m.thresholds) < loss(*np.split(v, [3])) + 1e-3
    assert np.abs(m.weights[:3] - v[:3]).max() < 0.05 and np.abs(m.thresholds - v[3:]).max() < 0.05
    tails = m.tails(x)
    assert tails.shape == (200, 3) and (np.diff(tails, axis=1) <= 0).all()


def test_quality_takes_one_row_of_each_labelled_id(spark, make_text):
    good, bad = [make_text(i, 60) for i in range(8)], [f"## {i} $$ {i} %% 77 && " * 12 for i in range(8)]
    rows = [(i, t) for i, t in enumerate(good + bad)] + [(3, "zzz copy of an id " + str(j)) for j in range(400)] + [(None, "no id")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i < 8)) for i in range(16)] + [(i, 1) for i in range(1000, 1400)], "doc_id long, quality int")
    a = QU.train(docs, labels, sample=16)
    b = QU.train(docs.repartition(5), labels, sample=16)  # the labels without a document take no place
    assert np.allclose(a.weights, b.weights) and np.allclose(a.thresholds, b.thresholds)
    got = {r.doc_id: r.tail_probability for r in QU.grade(docs.where("doc_id <> 3"), a).collect()}
    assert min(got[i] for i in range(8) if i != 3) > 0.5 > max(got[i] for i in range(8, 16))


def test_quality_held_out(spark, odd_docs, make_text):
    rows = [(i, make_text(i, 80), "en", 0, "x") for i in range(120)] + [(1000 + i, "!! ".join(make_text(i, 80).upper().split()), "en", 0, "x") for i in range(60)]
    docs = spark.createDataFrame(rows, odd_docs.schema).unionByName(odd_docs)
    labels = spark.createDataFrame([(i, int(i < 1000), 5) for i, *_ in rows if i % 3] + [(None, 1, 0), (7, None, 0), (4, 1, 0)], "doc_id long, quality int, h int")
    model = QU.train(docs, labels)
    got = QU.grade(docs, model)
    assert got.count() == docs.count()
    out = {r.doc_id: r for r in got.where("doc_id is not null").collect()}
    assert all(out[i].keep == (i < 1000) and abs(out[i].expected_grade - out[i].tail_probability) < 1e-9 for i, *_ in rows if i % 3 == 0)
    kept = QU.keep(docs, model)
    assert kept.columns == docs.columns and kept.count() == got.where("keep").count()
    assert QU.grade(docs, QU.train(docs, labels.limit(0))).where("not keep").count() == 0  # without labels nothing goes
    assert QU.grade(docs.limit(0), model).count() == 0 and QU.keep(docs.limit(0), model).count() == 0


# ---- toxicity --------------------------------------------------------------


def kernel_by_hand(s, t, order=TX.ORDER, decay=TX.DECAY):
    from itertools import combinations

    def subs(x):
        out = {}
        for at in combinations(range(len(x)), order):
            key = "".join(x[i] for i in at)
            out[key] = out.get(key, 0) + decay ** (at[-1] - at[0] + 1)
        return out

    a, b = subs(s), subs(t)
    return sum(v * b.get(k, 0) for k, v in a.items())


def test_kernel_equals_its_definition():
    r = random.Random(6)
    words_ = ["".join(r.choice("abcd") for _ in range(r.randint(1, 9))) for _ in range(40)]
    c = TX.codes(words_, TX.UNIT)
    for t in words_[:8]:
        got = TX.kernel(c, TX.codes([t], len(t))[0])
        assert np.allclose(got, [kernel_by_hand(s, t) for s in words_], rtol=1e-4)


def test_toxicity_held_out(spark, odd_docs, make_text):
    insults = ["zorkwimp", "blugfazz", "quaxnopp"]
    r = random.Random(2)

    def doc(i):
        w = make_text(i, 60).split()
        if i % 4 == 0:
            w.insert(r.randrange(60), insults[i // 4 % 3])
        return ". ".join([" ".join(w[:30]), " ".join(w[30:])])

    rows = [(i, doc(i), "en", 0, "x") for i in range(400)]
    docs = spark.createDataFrame(rows, odd_docs.schema).unionByName(odd_docs.where("doc_id is null or doc_id in (2, 3, 5)"))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(400)], "doc_id long, toxic int")
    model = TX.train(docs, labels.where(~TX.held_out()))
    got = TX.score(docs, model).withColumn("held_out", TX.held_out()).collect()
    assert len(got) == docs.count()
    held = [x for x in got if x.held_out and x.doc_id < 400]
    assert sum(x.predicted == (x.doc_id % 4 == 0) for x in held if x.doc_id not in (2, 3, 5)) >= 0.95 * (len(held) - 2)
    assert all(0 <= x.score <= 1 for x in got)
    # inserted and gapped characters, against an ordinary word
    s = dict(zip("abcd", model.link(np.array([max(model.units(TX.word_units(w) + TX.spaced_units(w))) for w in ("zorkwimp", "zork_wimp", "z.o.r.k.w.i.m.p", "therenand")]))))
    assert s["a"] > 0.5 and s["b"] > 0.5 and s["c"] > 0.5 and s["d"] < 0.2
    # marks, spaces and doubled letters of three insults, in whole texts; ordinary words cut the same way stay clean
    kinds = {
        "_": lambda w: w[:4] + "_" + w[4:], "-": lambda w: "-".join(w[i : i + 3] for i in range(0, len(w), 3)), "*": lambda w: w[:2] + "*" + w[2:], " ": lambda w: w[:4] + " " + w[4:],
        ".": ".".join, "spaced": " ".join, "doubled": lambda w: "".join(c * 2 for c in w), "caps": str.upper, "inserted": lambda w: w[:4] + "x" + w[4:], "dropped": lambda w: w[:3] + w[4:],
    }
    texts = [(k, 1, f"the rest of {f(w)} that is there.") for k, f in kinds.items() for w in insults]
    texts += [(k, 0, f"the rest of {f(w)} that is there.") for k, f in kinds.items() for w in ("therenand", "onthered", "inglytion")]
    more = spark.createDataFrame([(i, t) for i, (*_, t) in enumerate(texts)], "doc_id long, text string")
    hit = {r.doc_id: r.predicted for r in TX.score(more, model).collect()}
    found = {k: sum(hit[i] for i, (x, y, _) in enumerate(texts) if x == k and y) for k in kinds}
    assert sum(found.values()) >= 0.9 * 3 * len(kinds), found
    assert not any(hit[i] for i, (_, y, _) in enumerate(texts) if not y)
    odd = {x.score for x in got if x.doc_id in (2, 3) or x.doc_id is None}
    assert max(odd) < 0.5
    assert TX.score(docs, TX.train(docs, labels.limit(0))).where("predicted = 1").count() == 0
    assert TX.score(docs.limit(0), model).count() == 0


def test_toxicity_takes_one_row_of_each_labelled_id(spark, make_text):
    rows = [(i, make_text(i, 30) + (" zorkwimp." if i % 2 else ".")) for i in range(40)]
    rows += [(1, make_text(1, 30) + f" zorkwimp {j}.") for j in range(500)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] + [(i, 1) for i in range(900, 1000)], "doc_id long, toxic int")
    a, b = TX.train(docs, labels, sample=15), TX.train(docs.repartition(3), labels, sample=15)
    assert a.landmarks == b.landmarks and np.allclose(a.alpha, b.alpha) and a.landmarks


def test_words_joined_across_borders():
    b = TX.Borders(["^zorkwim", "rkwimp$"])
    assert b.units("a zork wimp. so") == ["^zorkwimp$"] and b.units("zork. wimp") == [] and b.units("zorkwimp") == []
    assert TX.word_units("zo-rk_wimp!") == ["^zo$", "^rk$", "^wimp$", "^zorkwimp$"]


def test_held_out_rows_are_those_of_the_crc(spark):
    import zlib

    got = spark.range(50).select("id", TX.held_out("id").alias("h")).collect()
    assert all(x.h == (zlib.crc32(str(x.id).encode()) % 5 == 0) for x in got)
