"""A small pure-Python model of the text pipeline (tokenise, md5 token
vectors, dense sum, sign code, Hamming prefetch, MaxSim rescore, sentence
isolation) compared with the Spark jobs on a handful of literal documents."""

import hashlib
import re

import numpy as np

from siftlane.plans import pipeline as P

DOCS = [
    (1, "The supplier shall indemnify the client. Liability is capped at fees paid.\nShort."),
    (2, "Intellectual property in deliverables vests in the client; The provider keeps tools.\nConfidentiality survives termination for five years."),
    (3, "Either party may terminate for material breach. Notice must be written and signed.\nFees are due within thirty days of invoice."),
    (4, "The client owns all deliverables. The provider shall not reuse client data.\nGoverning law is the law of the state."),
]
QUERIES = [(10, "Who owns the deliverables and intellectual property?"), (11, "What is the cap on liability?"),
           (12, "When can a party terminate the agreement?")]


def toks(text):
    return [w.lower() for w in re.findall("[A-Za-z0-9]+", text)]


def vec(tok):
    d = hashlib.md5(tok.encode()).digest()
    w = [int.from_bytes(d[:8], "big"), int.from_bytes(d[8:], "big")]
    return np.array([2 * ((w[i // 64] >> (i % 64)) & 1) - 1 for i in range(128)], dtype=float)


def maxsim(q, d):
    if not q or not d:
        return 0.0
    qm = np.array([vec(t) for t in q]) / np.sqrt(128)
    dm = np.array([vec(t) for t in set(d)]) / np.sqrt(128)
    return float((qm @ dm.T).max(axis=1).sum())


def sentences(chunk):
    """A scanner: a sentence ends at a blank after '.' or ';' that an ASCII capital follows."""
    out, now, words = [], [], chunk.split()
    for w, after in zip(words, [*words[1:], ""]):
        now.append(w)
        if not after or (w[-1] in ".;" and "A" <= after[0] <= "Z"):
            out.append(" ".join(now))
            now = []
    return [x for x in out if len(x) >= 16]


def model(limit, top_k):
    chunks = [((doc, i), line) for doc, text in DOCS for i, line in enumerate(text.split("\n"))]
    code = {cid: sum((vec(t) for t in toks(x)), np.zeros(128)) > 0 for cid, x in chunks}
    out = {}
    for qid, qt in QUERIES:
        qc = sum((vec(t) for t in toks(qt)), np.zeros(128)) > 0
        pre = sorted(chunks, key=lambda c: (int((code[c[0]] != qc).sum()), c[0]))[:limit]
        sc = sorted(((round(maxsim(toks(qt), toks(x)), 6), cid) for cid, x in pre), key=lambda s: (-s[0], s[1]))
        out[qid] = [(cid, s) for s, cid in sc[:top_k]]
    return out


def test_two_stage_and_isolation_match_python_model(spark):
    docs = spark.createDataFrame(DOCS, "doc_id long, text string")
    q = P.encode_queries(spark.createDataFrame(QUERIES, "item_id long, text string"))
    idx = P.build_index(docs)
    for limit, top_k in ((3, 2), (8, 3), (100, 5)):
        hits = P.two_stage(idx, q, limit, top_k).collect()
        want = model(limit, top_k)
        for qid, _ in QUERIES:
            mine = [(tuple(r.id), r.score) for r in sorted((r for r in hits if r.query_id == qid), key=lambda r: r.rank)]
            assert mine == want[qid], (limit, top_k, qid)
    hits = P.two_stage(idx, q, 8, 3)
    iso = P.isolate(hits, q, top_n=1).collect()
    text_of = {(d, i): line for d, t in DOCS for i, line in enumerate(t.split("\n"))}
    qtext = dict(QUERIES)
    for r in iso:
        chunk = text_of[tuple(r.id)]
        sents = sentences(chunk)
        if not sents:
            assert (r.sentence, r.score) == (chunk, 0.0)
            continue
        scored = sorted(((round(maxsim(toks(qtext[r.query_id]), toks(s)), 6), i, s) for i, s in enumerate(sents)),
                        key=lambda x: (-x[0], x[1]))
        assert (r.sentence, r.score) == (scored[0][2], scored[0][0])
        assert r.sentence in chunk or r.sentence in " ".join(chunk.split())
