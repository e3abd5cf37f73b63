"""DuckDB recomputation of the text queries.

Independent formulation: hash-embedder dense vectors come from per-chunk bit
counts (``dense_i = 2 * ones_i - n_tokens``), codes are packed as UBIGINT in
SQL, MaxSim is a relational join over token rows (max per query token, then
sum), and sentences are split by a marker character instead of look-arounds
(DuckDB's RE2 has none).
"""

from __future__ import annotations

WS = r"[\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
TOKCOUNT = r"[A-Za-z0-9]+|[^\t-\r\x{1c}-\x{20}\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}A-Za-z0-9]"
WORD = "[A-Za-z0-9]+"
DIM = 128

PREAMBLE_SQL = (
    "'Answer the user''s question based strictly on the provided context below. "
    "If the context does not contain the answer, state that clearly.' || chr(10) || chr(10)"
)


def _norm(expr: str) -> str:
    return f"trim(regexp_replace({expr}, '{WS}+', ' ', 'g'))"


def _sentences(expr: str) -> str:
    """List of sentences (> 15 characters) of a text expression."""
    split = f"string_split(regexp_replace({_norm(expr)}, '([.;]) ([A-Z])', '\\1' || chr(1) || '\\2', 'g'), chr(1))"
    return f"list_filter(list_transform({split}, lambda s: trim(s)), lambda s: length(s) > 15)"


def _words(expr: str) -> str:
    return f"list_transform(regexp_extract_all({expr}, '{WORD}'), lambda w: lower(w))"


def _hash_words(tok: str) -> str:
    return (f"('0x' || substr(md5({tok}), 1, 16))::UBIGINT AS a, "
            f"('0x' || substr(md5({tok}), 17, 16))::UBIGINT AS b")


def _bit(i: int) -> str:
    word = "a" if i < 64 else "b"
    return f"(({word} >> {i % 64}) & 1)::INTEGER"


def _bit_sums() -> str:
    return ", ".join(f"sum({_bit(i)}) AS c{i}" for i in range(DIM))


def _code_words(prefix: str = "") -> str:
    """Packed sign bits of the dense vector; 0 for an item without tokens."""
    w0 = " | ".join(f"((2 * {prefix}c{i} > {prefix}n)::UBIGINT << {i})" for i in range(64))
    w1 = " | ".join(f"((2 * {prefix}c{i} > {prefix}n)::UBIGINT << {i - 64})" for i in range(64, DIM))
    return f"coalesce({w0}, 0::UBIGINT) AS w0, coalesce({w1}, 0::UBIGINT) AS w1"


CHUNKS = """
chunks AS (
  SELECT (doc_id * 1048576 + ix)::BIGINT AS id, doc_id, ix::INTEGER AS chunk_ix,
         doc_id::VARCHAR || '-c' || ix::VARCHAR AS chunk_id, text
  FROM (SELECT doc_id, unnest(parts) AS text, unnest(range(len(parts))) AS ix
        FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM documents))
)"""

CONV_CHUNKS = """
chunks AS (
  SELECT (conv_id * 1048576 + ix)::BIGINT AS id, conv_id AS doc_id, ix::INTEGER AS chunk_ix,
         conv_id::VARCHAR || '-c' || ix::VARCHAR AS chunk_id, text
  FROM (SELECT conv_id, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1 AS ix FROM conversations)
)"""

# token rows, per-chunk bit counts, codes and dense vectors of the corpus
CORPUS = f"""
ctok AS (
  SELECT id, tok, {_hash_words('tok')}
  FROM (SELECT id, unnest({_words('text')}) AS tok FROM chunks)
),
cbits AS (SELECT id, count(*) AS n, {_bit_sums()} FROM ctok GROUP BY id),
ccode AS (
  SELECT c.id, coalesce(b.n, 0) AS n, {_code_words('b.')}
  FROM chunks c LEFT JOIN cbits b ON b.id = c.id
),
cdtok AS (SELECT DISTINCT id, a, b FROM ctok)"""

QUERIES = f"""
qtok AS (
  SELECT query_id, qix, tok, {_hash_words('tok')}
  FROM (SELECT item_id AS query_id, unnest(range(len(w))) AS qix, unnest(w) AS tok
        FROM (SELECT item_id, {_words('text')} AS w FROM benchmark))
),
qbits AS (SELECT query_id, count(*) AS n, {_bit_sums()} FROM qtok GROUP BY query_id),
qcode AS (
  SELECT q.item_id AS query_id, q.text AS query,
         {_code_words('b.')}
  FROM benchmark q LEFT JOIN qbits b ON b.query_id = q.item_id
)"""


def _two_stage(limit: int, top_k: int) -> str:
    return f"""
pre AS (
  SELECT q.query_id, c.id, (bit_count(xor(q.w0, c.w0)) + bit_count(xor(q.w1, c.w1)))::INTEGER AS ham
  FROM qcode q, ccode c
),
cand AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ham, id)::INTEGER AS stage1_rank FROM pre)
  WHERE stage1_rank <= {limit}
),
tsim AS (
  SELECT c.query_id, c.id, t.qix,
         max({DIM} - 2 * (bit_count(xor(t.a, d.a))::INTEGER + bit_count(xor(t.b, d.b))::INTEGER)) AS best
  FROM cand c JOIN qtok t ON t.query_id = c.query_id JOIN cdtok d ON d.id = c.id
  GROUP BY c.query_id, c.id, t.qix
),
ssum AS (SELECT query_id, id, sum(best) / {float(DIM)} AS score FROM tsim GROUP BY query_id, id),
scored AS (
  SELECT c.query_id, c.id, c.ham, c.stage1_rank, coalesce(s.score, 0.0) AS score
  FROM cand c LEFT JOIN ssum s ON s.query_id = c.query_id AND s.id = c.id
),
hits AS (
  SELECT h.*, ch.doc_id, ch.chunk_ix, ch.chunk_id, ch.text FROM (
    SELECT query_id, id, ham, stage1_rank, round(score, 6) AS score,
           row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id)::INTEGER AS rank
    FROM scored) h JOIN chunks ch ON ch.id = h.id
  WHERE rank <= {top_k}
)"""


def _dense_dot() -> str:
    terms = " + ".join(f"(2 * qb.c{i} - qb.n) * (2 * cb.c{i} - cb.n)" for i in range(DIM))
    return f"({terms})"


def _dense_sq(p: str) -> str:
    return "(" + " + ".join(f"(2 * {p}.c{i} - {p}.n) * (2 * {p}.c{i} - {p}.n)" for i in range(DIM)) + ")"


def _dense_only(top_k: int) -> str:
    """Cosine over dense vectors; an item without tokens has a zero vector."""
    return f"""
dpairs AS (
  SELECT q.item_id AS query_id, c.id,
         CASE WHEN qb.n IS NULL OR cb.n IS NULL THEN 0.0
              WHEN {_dense_sq('qb')} * {_dense_sq('cb')} = 0 THEN 0.0
              ELSE {_dense_dot()} / (sqrt({_dense_sq('qb')}) * sqrt({_dense_sq('cb')})) END AS cs
  FROM benchmark q LEFT JOIN qbits qb ON qb.query_id = q.item_id, chunks c LEFT JOIN cbits cb ON cb.id = c.id
),
dhits AS (
  SELECT h.*, ch.doc_id, ch.chunk_ix, ch.chunk_id, ch.text FROM (
    SELECT query_id, id, round(cs, 6) AS score,
           row_number() OVER (PARTITION BY query_id ORDER BY round(cs, 6) DESC, id)::INTEGER AS rank
    FROM dpairs) h JOIN chunks ch ON ch.id = h.id
  WHERE rank <= {top_k}
)"""


def _isolate(top_n: int, hits: str = "hits") -> str:
    return f"""
sraw AS (SELECT query_id, rank, id, text, {_sentences('text')} AS sl FROM {hits}),
srows AS (
  SELECT query_id, rank, id, unnest(range(len(x)))::INTEGER AS sent_ix, unnest(x) AS sentence, fb
  FROM (SELECT *, len(sl) = 0 AS fb, CASE WHEN len(sl) = 0 THEN [text] ELSE sl END AS x FROM sraw)
),
stok AS (
  SELECT DISTINCT query_id, id, sent_ix, ('0x' || substr(md5(tok), 1, 16))::UBIGINT AS a,
         ('0x' || substr(md5(tok), 17, 16))::UBIGINT AS b
  FROM (SELECT query_id, id, sent_ix, unnest({_words('sentence')}) AS tok FROM srows WHERE NOT fb)
),
ssim AS (
  SELECT s.query_id, s.id, s.sent_ix, t.qix, max({DIM} - 2 * (bit_count(xor(t.a, s.a))::INTEGER + bit_count(xor(t.b, s.b))::INTEGER)) AS best
  FROM stok s JOIN qtok t ON t.query_id = s.query_id GROUP BY ALL
),
sscore AS (SELECT query_id, id, sent_ix, sum(best) / {float(DIM)} AS score FROM ssim GROUP BY ALL),
iso AS (
  SELECT * FROM (
    SELECT r.query_id, r.rank, r.id, r.sent_ix, r.sentence,
           round(CASE WHEN r.fb THEN 0.0 ELSE coalesce(s.score, 0.0) END, 6) AS score,
           row_number() OVER (PARTITION BY r.query_id, r.id
                              ORDER BY round(CASE WHEN r.fb THEN 0.0 ELSE coalesce(s.score, 0.0) END, 6) DESC,
                                       r.sent_ix)::INTEGER AS sent_rank
    FROM srows r LEFT JOIN sscore s ON s.query_id = r.query_id AND s.id = r.id AND s.sent_ix = r.sent_ix)
  WHERE sent_rank <= {top_n}
)"""


def _prompt(ctx: str) -> str:
    return (f"{PREAMBLE_SQL} || 'Context:' || chr(10) || coalesce({ctx}, '') || chr(10) || chr(10) || "
            f"'Question: ' || q.query || chr(10) || 'Answer:'")


def _std_prompts(hits: str = "hits") -> str:
    return f"""
stdctx AS (
  SELECT query_id, string_agg(format('[Source Chunk {{}}]: {{}}', rank, text), chr(10) || chr(10) ORDER BY rank) AS ctx
  FROM {hits} GROUP BY query_id
),
stdp AS (SELECT q.query_id, {_prompt('s.ctx')} AS prompt FROM qcode q LEFT JOIN stdctx s ON s.query_id = q.query_id)"""


def _opt_prompts() -> str:
    return f"""
isotext AS (
  SELECT query_id, rank, id, string_agg(sentence, ' ' ORDER BY sent_rank) AS itext FROM iso GROUP BY ALL
),
optctx AS (
  SELECT query_id, string_agg(format('[Source Chunk {{}}]: {{}}', rank, itext), chr(10) || chr(10) ORDER BY rank) AS ctx
  FROM isotext GROUP BY query_id
),
optp AS (SELECT q.query_id, {_prompt('o.ctx')} AS prompt FROM qcode q LEFT JOIN optctx o ON o.query_id = q.query_id)"""


def _ntok(expr: str) -> str:
    return f"len(regexp_extract_all({expr}, '{TOKCOUNT}'))"


def _report() -> str:
    return f"""
dtok AS (
  SELECT q.query_id, coalesce(sum({_ntok('h.text')}), 0) AS tokens
  FROM qcode q LEFT JOIN dhits h ON h.query_id = q.query_id GROUP BY q.query_id
),
ttok AS (
  SELECT q.query_id, coalesce(sum({_ntok('h.text')}), 0) AS tokens
  FROM qcode q LEFT JOIN hits h ON h.query_id = q.query_id GROUP BY q.query_id
),
ictx AS (SELECT query_id, string_agg(sentence, ' ' ORDER BY rank, sent_rank) AS ctx FROM iso GROUP BY query_id),
itok AS (
  SELECT q.query_id, coalesce({_ntok('i.ctx')}, 0) AS tokens
  FROM qcode q LEFT JOIN ictx i ON i.query_id = q.query_id
),
per AS (
  SELECT 'dense' AS pipeline, count(*) AS n_queries, avg(tokens::DOUBLE) AS avg_tokens FROM dtok
  UNION ALL SELECT 'two_stage', count(*), avg(tokens::DOUBLE) FROM ttok
  UNION ALL SELECT 'two_stage_isolated', count(*), avg(tokens::DOUBLE) FROM itok
),
report AS (
  SELECT p.pipeline, p.n_queries, round(p.avg_tokens, 6) AS avg_tokens,
         round(CASE WHEN b.avg_tokens <> 0 THEN (1 - p.avg_tokens / b.avg_tokens) * 100 END, 6)
           AS reduction_vs_dense_pct
  FROM per p, (SELECT avg_tokens FROM per WHERE pipeline = 'dense') b
)"""


def _with(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_TS = _two_stage(100, 3)

SQL = {
    "q07_sections_to_chunks": f"{_with(CHUNKS)} SELECT doc_id, chunk_ix, chunk_id, text FROM chunks",
    "q08_assemble_document": """
SELECT doc_id, len(string_split(text, chr(10)))::INTEGER AS n_sections,
       replace(text, chr(10), chr(10) || chr(10)) AS text
FROM documents""",
    "q09_sentences": f"""{_with(CHUNKS)}
SELECT doc_id, chunk_ix, unnest(range(len(s)))::INTEGER AS sent_ix, unnest(s) AS sentence
FROM (SELECT doc_id, chunk_ix, {_sentences('text')} AS s FROM chunks)""",
    "q10_sentence_fallback": f"""
SELECT doc_id, unnest(range(len(x)))::INTEGER AS sent_ix, unnest(x) AS sentence, fb AS is_fallback
FROM (SELECT doc_id, len(s) = 0 AS fb, CASE WHEN len(s) = 0 THEN [text] ELSE s END AS x
      FROM (SELECT doc_id, text, {_sentences('text')} AS s FROM documents))""",
    "q11_corpus_stats": f"""{_with(CHUNKS)},
w AS (SELECT CASE WHEN {_norm('text')} = '' THEN 0 ELSE len(string_split({_norm('text')}, ' ')) END AS nw FROM chunks)
SELECT (SELECT count(*) FROM documents) AS n_documents, count(*)::BIGINT AS n_chunks, sum(nw)::BIGINT AS n_words,
       round(sum(nw) / count(*), 6) AS avg_words_per_chunk
FROM w""",
    "q12_token_counts": f"""
SELECT doc_id, {_ntok('text')}::BIGINT AS n_tokens,
       (CASE WHEN {_norm('text')} = '' THEN 0 ELSE len(string_split({_norm('text')}, ' ')) END)::INTEGER AS n_words
FROM documents""",
    "q13_hash_token_codes": f"""
SELECT item_id, tok_ix::INTEGER AS tok_ix, token,
       (bit_count(('0x' || substr(m, 1, 16))::UBIGINT) + bit_count(('0x' || substr(m, 17, 16))::UBIGINT))::INTEGER AS n_set_bits,
       ('0x' || substr(m, 9, 8))::BIGINT AS w0_lo, ('0x' || substr(m, 1, 8))::BIGINT AS w0_hi,
       ('0x' || substr(m, 25, 8))::BIGINT AS w1_lo, ('0x' || substr(m, 17, 8))::BIGINT AS w1_hi
FROM (SELECT *, md5(token) AS m FROM (
  SELECT item_id, unnest(range(len(w))) AS tok_ix, unnest(w) AS token
  FROM (SELECT item_id, {_words('text')} AS w FROM benchmark)))""",
    "q14_hash_dense_embedding": f"""{_with(QUERIES)},
dims AS (SELECT q.query_id, r.dim::INTEGER AS dim FROM qcode q, range({DIM}) r(dim))
SELECT d.query_id AS item_id, d.dim,
       coalesce(CASE {' '.join(f'WHEN d.dim = {i} THEN 2 * b.c{i} - b.n' for i in range(DIM))} END, 0)::DOUBLE AS value,
       (coalesce(CASE {' '.join(f'WHEN d.dim = {i} THEN 2 * b.c{i} - b.n' for i in range(DIM))} END, 0) > 0)::INTEGER AS bit
FROM dims d LEFT JOIN qbits b ON b.query_id = d.query_id""",
    "q15_index_build": f"""{_with(CHUNKS, CORPUS)},
dd AS (
  SELECT id, count(*) AS nd, md5(string_agg(lpad(lower(to_hex(a)), 16, '0') || lpad(lower(to_hex(b)), 16, '0'), ','
         ORDER BY lpad(lower(to_hex(a)), 16, '0') || lpad(lower(to_hex(b)), 16, '0'))) AS digest
  FROM cdtok GROUP BY id
)
SELECT c.doc_id, c.chunk_ix, c.chunk_id, coalesce(b.n, 0)::INTEGER AS n_tokens,
       coalesce(dd.nd, 0)::INTEGER AS n_distinct_tokens,
       lpad(lower(to_hex(k.w0)), 16, '0') || lpad(lower(to_hex(k.w1)), 16, '0') AS code,
       array_to_string([{', '.join(f'coalesce(2 * b.c{i} - b.n, 0)' for i in range(DIM))}], ',') AS dense,
       coalesce(dd.digest, md5('')) AS toks_md5
FROM chunks c LEFT JOIN cbits b ON b.id = c.id LEFT JOIN dd ON dd.id = c.id LEFT JOIN ccode k ON k.id = c.id""",
    "q16_upsert": """
WITH docs AS (
  SELECT doc_id, text FROM documents WHERE lang IS DISTINCT FROM 'de'
  UNION ALL SELECT doc_id, regexp_replace(text, '\\n[^\\n]*\\z', '') FROM documents WHERE lang = 'de'
  UNION ALL SELECT doc_id + 1000000000, text FROM documents WHERE lang = 'es'
)
SELECT doc_id, ix::INTEGER AS chunk_ix, doc_id::VARCHAR || '-c' || ix::VARCHAR AS chunk_id, text
FROM (SELECT doc_id, unnest(parts) AS text, unnest(range(len(parts))) AS ix
      FROM (SELECT doc_id, string_split(text, chr(10)) AS parts FROM docs))""",
    "q17_text_two_stage": f"""{_with(CHUNKS, CORPUS, QUERIES, _TS)}
SELECT query_id, rank, doc_id, chunk_ix, chunk_id, source, printf('doc-%03d', doc_id) AS doc_label, score, ham, stage1_rank
FROM hits JOIN documents USING (doc_id)""",
    "q18_isolate_sentences": f"""{_with(CHUNKS, CORPUS, QUERIES, _TS, _isolate(2))}
SELECT query_id, rank, doc_id, chunk_ix, sent_rank, sent_ix, sentence, score FROM iso JOIN chunks USING (id)""",
    "q19_standard_prompt": f"""{_with(CHUNKS, CORPUS, QUERIES, _TS, _std_prompts())}
SELECT query_id, prompt FROM stdp""",
    "q20_optimized_prompt": f"""{_with(CHUNKS, CORPUS, QUERIES, _TS, _isolate(1), _std_prompts(), _opt_prompts())}
SELECT s.query_id, o.prompt AS optimized_prompt, {_ntok('s.prompt')}::BIGINT AS standard_tokens,
       {_ntok('o.prompt')}::BIGINT AS optimized_tokens,
       round((1 - {_ntok('o.prompt')} / {_ntok('s.prompt')}) * 100, 6) AS reduction_pct
FROM stdp s JOIN optp o ON o.query_id = s.query_id""",
    "q21_payload_report": f"""{_with(CHUNKS, CORPUS, QUERIES, _TS, _isolate(1), _dense_only(3), _report())}
SELECT * FROM report""",
    "q24_cost_projection": f"""{_with(CHUNKS, CORPUS, QUERIES, _TS, _isolate(1), _dense_only(3), _report())},
t AS (
  SELECT max(CASE WHEN pipeline = 'dense' THEN avg_tokens END) AS standard_tokens,
         max(CASE WHEN pipeline = 'two_stage_isolated' THEN avg_tokens END) AS optimized_tokens FROM report
),
v AS (SELECT n_queries, standard_tokens, optimized_tokens,
             standard_tokens * n_queries / 1000000.0 * 3.0 AS su, optimized_tokens * n_queries / 1000000.0 * 3.0 AS ou
      FROM t, (VALUES (1000::BIGINT), (100000::BIGINT)) x(n_queries))
SELECT n_queries, standard_tokens, optimized_tokens, round(su, 6) AS standard_usd, round(ou, 6) AS optimized_usd,
       round(su - ou, 6) AS savings_usd, round((1 - ou / su) * 100, 6) AS savings_pct
FROM v""",
    "q25_preview": """
SELECT doc_id, replace(substring(text, 1, 200), chr(10), ' ') || '...' AS preview FROM documents""",
    "q26_json_round_trip": f"{_with(CHUNKS)} SELECT doc_id, chunk_ix, chunk_id, text FROM chunks",
    "q27_conversation_documents": """
SELECT conv_id AS doc_id, count(*)::INTEGER AS n_sections,
       string_agg(text, chr(10) || chr(10) ORDER BY turn) AS text
FROM conversations GROUP BY conv_id""",
    "q28_text_dense_only": f"""{_with(CHUNKS, CORPUS, QUERIES, _dense_only(3))}
SELECT query_id, rank, doc_id, chunk_ix, chunk_id, source, printf('doc-%03d', doc_id) AS doc_label, score
FROM dhits JOIN documents USING (doc_id)""",
    "q29_text_limit_sweep": f"""{_with(CHUNKS, CORPUS, QUERIES, _two_stage(500, 500))},
lims AS (SELECT unnest([10, 25, 50, 100, 250, 500])::INTEGER AS prefetch_limit),
top1 AS (
  SELECT query_id, prefetch_limit, id AS top1 FROM (
    SELECT s.query_id, l.prefetch_limit, s.id,
           row_number() OVER (PARTITION BY s.query_id, l.prefetch_limit ORDER BY round(s.score, 6) DESC, s.id) AS r
    FROM scored s JOIN lims l ON s.stage1_rank <= l.prefetch_limit)
  WHERE r = 1
),
grid AS (
  SELECT q.query_id, l.prefetch_limit, t.top1
  FROM qcode q CROSS JOIN lims l LEFT JOIN top1 t ON t.query_id = q.query_id AND t.prefetch_limit = l.prefetch_limit
),
cmp AS (
  SELECT g.prefetch_limit, (g.top1 IS NOT DISTINCT FROM r.top1)::INTEGER AS m
  FROM grid g JOIN grid r ON r.query_id = g.query_id AND r.prefetch_limit = 500
),
rate AS (SELECT prefetch_limit, sum(m)::BIGINT AS matches, count(*)::BIGINT AS n_queries FROM cmp GROUP BY 1)
SELECT prefetch_limit, matches, n_queries, round(matches * 100.0 / n_queries, 6) AS match_rate_pct,
       CASE WHEN prefetch_limit = 500 THEN '100% (Reference)'
            ELSE printf('%d%% (%d/%d)', round_even(matches * 100.0 / n_queries, 0)::BIGINT, matches, n_queries) END
         AS match_status
FROM rate""",
    "q30_conversation_two_stage": f"""{_with(CONV_CHUNKS, CORPUS, QUERIES, _TS)}
SELECT query_id, rank, doc_id, chunk_ix, chunk_id, score, ham, stage1_rank FROM hits""",
    "q32_string_ids": f"""{_with(CHUNKS)}
SELECT printf('msa-%09d', doc_id) AS doc_id, chunk_ix, printf('msa-%09d-c%d', doc_id, chunk_ix) AS chunk_id, source, c.text
FROM chunks c JOIN documents USING (doc_id)""",
    "q33_string_id_two_stage": f"""{_with(CHUNKS, CORPUS, QUERIES, _TS)}
SELECT query_id, rank, printf('msa-%09d', doc_id) AS doc_id, chunk_ix, printf('msa-%09d-c%d', doc_id, chunk_ix) AS chunk_id,
       source, score, ham, stage1_rank
FROM hits JOIN documents USING (doc_id)""",
    "q34_upsert_repeated_documents": """
SELECT doc_id, ix::INTEGER AS chunk_ix, doc_id::VARCHAR || '-c' || ix::VARCHAR AS chunk_id, text
FROM (SELECT doc_id, unnest(parts) AS text, unnest(range(len(parts))) AS ix
      FROM (SELECT doc_id, string_split(CASE WHEN lang = 'de' THEN text || chr(10) || 'last' ELSE text END, chr(10)) AS parts FROM documents))""",
    "q35_index_lifecycle": f"""{_with(CHUNKS)},
s(step, english) AS (VALUES ('create', TRUE), ('keep', TRUE), ('recreate', FALSE))
SELECT step, doc_id, chunk_ix, chunk_id, c.text FROM chunks c JOIN documents USING (doc_id) JOIN s ON (lang IS NOT DISTINCT FROM 'en') = english""",
    "q36_model_tokens": """
WITH j AS (SELECT CAST(unnest(range(8)) AS INTEGER) AS dim),
w AS (SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+')) AS word,
  generate_subscripts(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z0-9]+'), 1) - 1 AS ix FROM benchmark),
c AS (SELECT item_id, ix, ascii(unnest(string_split(word, ''))) AS o FROM w),
t AS (SELECT item_id, ix, dim, CAST(sum((o * (2 * dim + 3)) % 7 - 3) AS DOUBLE) AS value FROM c, j GROUP BY ALL
  UNION ALL SELECT item_id, len(regexp_extract_all(text, '[A-Za-z0-9]+')), dim, 1.0 FROM benchmark, j)
SELECT item_id AS query_id, CAST(ix AS INTEGER) AS tok_ix, dim, value FROM t
UNION ALL SELECT item_id, -1, dim, sum(value) FROM t GROUP BY ALL""",
    "q37_model_dense_only": f"""{_with(CHUNKS)},
l(o) AS (SELECT unnest(list_concat(range(97, 123), range(48, 58)))),
j AS (SELECT unnest(range(8)) AS dim),
n AS (SELECT doc_id, chunk_ix, chunk_id, o, length(t) - length(replace(t, chr(CAST(o AS INTEGER)), '')) AS n
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM chunks), l),
d AS (SELECT doc_id, chunk_ix, chunk_id, list(x ORDER BY dim) AS v FROM
  (SELECT doc_id, chunk_ix, chunk_id, dim, CAST(sum(n * ((o * (2 * dim + 3)) % 7 - 3)) AS DOUBLE) AS x FROM n, j GROUP BY ALL) GROUP BY ALL),
m AS (SELECT item_id, o, length(t) - length(replace(t, chr(CAST(o AS INTEGER)), '')) AS n
  FROM (SELECT *, translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM benchmark), l),
q AS (SELECT item_id, list(x ORDER BY dim) AS v FROM
  (SELECT item_id, dim, 1 + CAST(sum(n * ((o * (2 * dim + 3)) % 7 - 3)) AS DOUBLE) AS x FROM m, j GROUP BY ALL) GROUP BY ALL),
s AS (SELECT item_id AS query_id, doc_id, chunk_ix, chunk_id,
  coalesce(round(list_dot_product(q.v, d.v) / nullif(sqrt(list_dot_product(q.v, q.v)) * sqrt(list_dot_product(d.v, d.v)), 0), 6), 0) AS score FROM q, d),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, doc_id, chunk_ix) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, doc_id, chunk_ix, chunk_id, score FROM r WHERE rank <= 3""",
}
