import random
import re

import numpy as np
import pytest

xxhash = pytest.importorskip("xxhash")

from siftlane.llm import simhash as SH  # noqa: E402
from siftlane.llm import warc as W  # noqa: E402


def fingerprint_by_hand(t):
    w = [x for x in re.split("[ \t-\r]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")) if x]
    grams = [" ".join(w[i : i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def parts_by_hand(fps):
    """Component of each fingerprint by search over all pairs."""
    label, f = {}, np.array(fps, np.uint64)
    for i in range(len(f)):
        if i in label:
            continue
        todo, label[i] = [i], i
        while todo:
            for j in np.flatnonzero(np.bitwise_count(f ^ f[todo.pop()]) <= 3).tolist():
                if j not in label:
                    label[j] = i
                    todo.append(j)
    return label


def test_fingerprints(spark, odd_docs, make_text):
    for t in ("", "a", "A b", "a b c", "a b c a b c", "x\x1cy z w v", "ÉÀ é", make_text(3, 50)):
        assert SH.majority(SH.shingle_hashes(t)) == fingerprint_by_hand(t)


def test_lower_bound_and_visits():
    r = np.random.default_rng(5)
    a = r.integers(0, 2**64, 300, dtype=np.uint64)
    b = a.copy()
    for _ in range(3):
        b ^= np.uint64(1) << r.integers(0, 64, 300).astype(np.uint64)
    assert (np.abs(SH.popcounts(a) - SH.popcounts(b)).sum(1) <= np.bitwise_count(a ^ b)).all()
    for x, y in zip(a, b):  # the two always meet, one of them at home
        cx, hx, _ = SH.cell_visits(np.array([x]))
        cy, _, _ = SH.cell_visits(np.array([y]))
        assert set(cx[hx].tolist()) & set(cy.tolist())


@pytest.mark.parametrize("block", [4, SH.BLOCK])
def test_links_and_components(spark, block):
    r = random.Random(1)
    fps = {0}
    for _ in range(12):
        x = r.getrandbits(64)
        fps.add(x)
        for _ in range(r.choice((0, 3, 60))):  # chains and dense groups
            y = x
            for _ in range(r.randint(1, 4)):
                y ^= 1 << r.randrange(64 if r.random() < 0.5 else 12)
            fps.add(y)
            x = y if r.random() < 0.3 else x
    fps = sorted(fps)
    df = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in fps], "fp long")
    roots = {r.node: r.root for r in SH.components(SH.links(df, block=block)).collect()}
    label = parts_by_hand(fps)
    signed = [int(np.uint64(x).view(np.int64)) for x in fps]
    mine = {}
    for i, s in enumerate(signed):
        mine.setdefault(roots.get(s, s), set()).add(i)
    theirs = {}
    for i, root in label.items():
        theirs.setdefault(root, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_long_chains_become_one_component(spark):
    n = 200
    df = spark.createDataFrame([(i, i + 1) for i in range(n)], "u long, v long")
    assert {(r.node, r.root) for r in SH.components(df).collect()} == {(i, 0) for i in range(n + 1)}
    assert SH.components(df.limit(0)).count() == 0


def test_near_duplicates(spark, odd_docs, make_text):
    base = make_text(77, 400).split()
    rows = []
    for i in range(30):
        w = list(base)
        if i % 3:
            w[(37 * i) % 400] = "other"
        rows.append((100 + i, " ".join(w), "en", 0, "x"))
    docs = odd_docs.unionByName(spark.createDataFrame(rows, odd_docs.schema))
    got = SH.near_duplicates(docs).collect()
    source = [(r.doc_id, r.text) for r in docs.collect()]
    fps = [fingerprint_by_hand(t) for _, t in source]
    label = parts_by_hand(fps)
    least = {}
    for i, (d, _) in enumerate(source):
        if d is not None:
            least[label[i]] = min(d, least.get(label[i], d))
    want = sorted(str((d, f"{fps[i]:016x}", least.get(label[i]))) for i, (d, _) in enumerate(source))
    assert sorted(str((r.doc_id, r.fingerprint, r.component_id)) for r in got) == want
    assert SH.near_duplicates(docs.limit(0)).count() == 0


# ---- archives --------------------------------------------------------------

PAGES = "page_id long, url string, html string, digest string"


def test_chunked_framing():
    for n in (0, 1, 4095, 4096, 4097, 20_000):
        p = bytes(range(256)) * (n // 256) + b"x" * (n % 256)
        assert W.dechunked(W.chunked(p)) == p
    assert W.dechunked(b"3;ext=1\r\nabc\r\n0\r\nTrailer: x\r\n\r\n") == b"abc"
    with pytest.raises(ValueError):
        W.dechunked(b"5\r\nabc\r\n0\r\n\r\n")


def test_records_parse_back():
    payload = "é\r\n\r\nWARC/1.1\r\n".encode() * 3000
    recs = W.page_records("7:1", 7, "http://a/\r\nX: y", payload, "d", None, "2000-01-01T00:00:00Z", 1000, 300)
    got = list(W.parse_records(b"".join(r + b"\r\n\r\n" for r in recs)))
    assert len(got) == len(recs) > 2 and got[-1][0]["warc-segment-total-length"] == str(sum(len(b) for _, b in got))
    assert all(h.get("warc-segment-origin-id", "<urn:page:7:1>") == "<urn:page:7:1>" and "x" not in h for h, _ in got)
    assert W.http_payload(b"".join(b for _, b in got)) == payload
    with pytest.raises(ValueError):
        list(W.parse_records(recs[0] + b"\r\nx\r\n"))


@pytest.mark.parametrize("compression", ["gzip", "none"])
def test_archive_round_trip(spark, compression, tmp_path):
    import hashlib

    big = "<p>é" * 30_000
    rows = [
        (1, "http://a/\r\nX: y", "x" * 200, None), (2, None, "x" * 200, "d"), (3, "u", None, "d"), (4, "u", "", "d"), (5, "u", "y" * 99, "d"), (6, "u", "y" * 99, "d"), (None, "u", "x" * 200, "d"),
        (None, None, "x" * 200, "d"), (7, "u", big, "d"), (8, "u", big, "d"), (2, None, "x" * 200, "d"), (2, "z", "q" * 150, "d"), (9, "u", "a\r\n\r\nWARC/1.1\r\n\r\n\x00\r\n", "d"),
    ]
    pages = spark.createDataFrame(rows, PAGES)
    W.write(pages, f"{tmp_path}/a", compression=compression)
    got = sorted(str((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)) for r in W.read(spark, f"{tmp_path}/a").collect())
    first = {}
    for i, _, h, _ in rows:
        if i is not None and h and len(h.encode()) >= 100:
            first[h] = min(i, first.get(h, i))
    want = []
    for i, _, h, _ in rows:
        p = (h or "").encode()
        to = first.get(h) if i is not None and h in first and first[h] < i else None
        want.append(str((i, len(p), hashlib.sha256(p).hexdigest(), "revisit" if to else "response", to)))
    assert got == sorted(want)
    W.write(pages.limit(0), f"{tmp_path}/b")
    assert W.read(spark, f"{tmp_path}/b").count() == 0


@pytest.mark.parametrize("salts", [32, 4])
def test_revisits_name_a_record_with_their_digest(spark, tmp_path, monkeypatch, salts):
    monkeypatch.setattr(W, "SALTS", salts)
    rows = [(5, "u", "q" * 150, None), (5, "u", "x" * 200, None), (5, "u", "x" * 200, None), (6, "u", "x" * 200, None), (7, "u", "q" * 150, None)] + [(None, "n", "x" * 200, None)] * 30 + [(9, "h", "x" * 200, None)] * 30
    W.write(spark.createDataFrame(rows, PAGES).repartition(3), f"{tmp_path}/a", compression="none")
    records = [h for f in tmp_path.glob("a/part*") for h, _ in W.parse_records(f.read_bytes())]
    by_name = {h["warc-record-id"]: h for h in records}
    assert len(by_name) == len(records) == len(rows)
    revisits = [h for h in records if h["warc-type"] == "revisit"]
    assert len(revisits) == 32
    for h in revisits:
        to = by_name[h["warc-refers-to"]]
        assert to["warc-type"] == "response" and to["warc-payload-digest"] == h["warc-payload-digest"] and to["x-page-id"] == h["x-refers-to-page"]


def test_missing_segments_fail(spark, tmp_path):
    recs = W.page_records("1:1", 1, "u", b"z" * 5000, "d", None, "2000-01-01T00:00:00Z", 1000, 300)
    (tmp_path / "f").write_bytes(b"".join(r + b"\r\n\r\n" for r in recs[:2] + recs[3:]))
    with pytest.raises(Exception, match="segments of"):
        W.read(spark, str(tmp_path / "f")).collect()


def test_near_dedup_stage_works_by_rows(spark, make_text):
    import corpus_pipeline as C

    a, z, n = make_text(1, 400), make_text(2, 400), make_text(3, 400)
    near = a.rsplit(" ", 1)[0] + " changed"
    rows = [(3, a), (7, near), (7, z), (None, n), (None, n), (None, n + " x"), (None, a), (9, make_text(4, 400)), (9, make_text(5, 400)), (9, make_text(4, 400))]
    rows = [(i, t, "en", 1) for i, t in rows]
    fp = [SH.majority(SH.shingle_hashes(t)) for t in (a, near, z, n, n + " x")]
    assert (fp[0] ^ fp[1]).bit_count() <= 3 < (fp[0] ^ fp[2]).bit_count() and (fp[3] ^ fp[4]).bit_count() <= 3
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, n_chars int")
    got = [tuple(r) for r in C.near_dedup_stage(spark, docs, "").collect()]
    left = [r for r in got if r[0] is None]
    assert len(left) == 1 and left[0][1] in (n, n + " x")
    assert sorted(r for r in got if r[0] is not None) == sorted({rows[0], rows[2], rows[7], rows[8]})
    assert C.near_dedup_stage(spark, docs.limit(0), "").count() == 0
