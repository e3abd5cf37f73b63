"""DuckDB SQL that recomputes each registered query from the raw tables.

Written independently of the Spark code paths: codes are compared sign by
sign (no bit packing), MaxSim and cosine are spelled out with list lambdas,
and top-k uses row_number() over every pair (fine at test scale).
"""

# --- shared CTEs over the embeddings table --------------------------------

_MATRICES_T = """
m AS (
  SELECT vec_id // 5 AS id, list(embedding::DOUBLE[] ORDER BY vec_id) AS toks
  FROM embeddings GROUP BY 1
),
d AS (
  SELECT id, toks,
         list_transform(range(1, len(toks[1]) + 1),
                        lambda i: list_sum(list_transform(toks, lambda t: t[i]))) AS dense
  FROM m
),
nt AS (
  SELECT id, list_transform(toks, lambda t: list_transform(t, lambda x:
           CASE WHEN sqrt(list_sum(list_transform(t, lambda y: y * y))) > 0
                THEN x / sqrt(list_sum(list_transform(t, lambda y: y * y))) ELSE 0 END)) AS ut
  FROM d
),
pre AS (
  SELECT q.id AS query_id, c.id AS id,
         list_sum(list_transform(range(1, len(q.dense) + 1),
                  lambda i: ((q.dense[i] > 0) <> (c.dense[i] > 0))::INTEGER))::INTEGER AS ham
  FROM d q, d c WHERE q.id <> c.id
  QUALIFY row_number() OVER (PARTITION BY q.id ORDER BY ham, c.id) <= {limit}
),
cand AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ham, id)::INTEGER AS stage1_rank FROM pre
),
scored AS (
  SELECT c.*, list_sum(list_transform(qn.ut, lambda a: list_max(list_transform(dn.ut, lambda b:
            list_sum(list_transform(range(1, len(a) + 1), lambda i: a[i] * b[i])))))) AS score
  FROM cand c JOIN nt qn ON qn.id = c.query_id JOIN nt dn ON dn.id = c.id
)
"""

_MATRICES = _MATRICES_T.format(limit=10)
_MATRICES_500 = _MATRICES_T.format(limit=500)
_MATRICES_ALL = _MATRICES_T.format(limit=1_000_000_000)

_SINGLE = """
v AS (SELECT vec_id AS id, embedding::DOUBLE[] AS e FROM embeddings)
"""

SQL = {
    "q01_two_stage_search": f"""
WITH {_MATRICES}
SELECT query_id, rank, id, round(score, 6) AS score, ham, stage1_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id)::INTEGER AS rank
  FROM scored) WHERE rank <= 3
""",
    "q02_dense_only_search": f"""
WITH {_SINGLE},
p AS (
  SELECT q.id AS query_id, c.id AS id,
         list_sum(list_transform(range(1, len(q.e) + 1), lambda i: q.e[i] * c.e[i])) AS dt,
         sqrt(list_sum(list_transform(q.e, lambda x: x * x))) AS nq,
         sqrt(list_sum(list_transform(c.e, lambda x: x * x))) AS nc
  FROM v q, v c WHERE q.id <> c.id
),
s AS (SELECT query_id, id, CASE WHEN nq * nc > 0 THEN dt / (nq * nc) ELSE 0 END AS cs FROM p)
SELECT query_id, rank, id, round(cs, 6) AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(cs, 6) DESC, id)::INTEGER AS rank FROM s
) WHERE rank <= 5
""",
    "q03_binary_codes": """
WITH b AS (
  SELECT vec_id, list_transform(embedding, lambda x: (x > 0)::BIGINT) AS bits FROM embeddings
),
w AS (SELECT vec_id, bits, unnest(range((len(bits) + 63) // 64)) AS j FROM b),
h AS (
  SELECT vec_id, bits, j, list_sum(list_transform(range(1, least(len(bits) - 64 * j, 64) + 1),
         lambda i: CASE WHEN bits[64 * j + i] = 1 THEN 1::UBIGINT << (i - 1) ELSE 0::UBIGINT END))::UBIGINT AS word
  FROM w
)
SELECT vec_id, list_sum(any_value(bits))::INTEGER AS n_set_bits, count(*)::INTEGER AS n_words,
       string_agg(lpad(lower(to_hex(word)), 16, '0'), ' ' ORDER BY j) AS code
FROM h GROUP BY vec_id
""",
    "q04_hamming_prefetch": f"""
WITH {_SINGLE},
p AS (
  SELECT q.id AS query_id, c.id AS id,
         list_sum(list_transform(range(1, len(q.e) + 1),
                  lambda i: ((q.e[i] > 0) <> (c.e[i] > 0))::INTEGER))::INTEGER AS ham
  FROM v q, v c WHERE q.id <> c.id
)
SELECT query_id, id, ham, stage1_rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY ham, id)::INTEGER AS stage1_rank FROM p
) WHERE stage1_rank <= 10
""",
    "q05_maxsim_pairs": f"""
WITH {_MATRICES}
SELECT query_id, id, ham, stage1_rank, round(score, 6) AS score FROM scored
""",
    "q06_normalize": f"""
WITH {_MATRICES},
n AS (SELECT id, dense, sqrt(list_sum(list_transform(dense, lambda x: x * x))) AS nr FROM d),
u AS (SELECT id, nr, list_transform(dense, lambda x: CASE WHEN nr > 0 THEN x / nr ELSE 0 END) AS unit FROM n)
SELECT id, dim::INTEGER AS dim, round(nr, 6) AS norm, round(un, 6) AS unit_norm, round(unit[dim + 1], 6) AS unit_x
FROM (SELECT *, sqrt(list_sum(list_transform(unit, lambda x: x * x))) AS un, unnest(range(len(unit))) AS dim FROM u)
""",
    "q22_limit_sweep": f"""
WITH {_MATRICES_500},
lims AS (SELECT unnest([10, 25, 50, 100, 250, 500])::INTEGER AS prefetch_limit),
top1 AS (
  SELECT query_id, prefetch_limit, id AS top1 FROM (
    SELECT s.query_id, l.prefetch_limit, s.id,
           row_number() OVER (PARTITION BY s.query_id, l.prefetch_limit ORDER BY round(s.score, 6) DESC, s.id) AS r
    FROM scored s JOIN lims l ON s.stage1_rank <= l.prefetch_limit)
  WHERE r = 1
),
grid AS (
  SELECT d.id AS query_id, l.prefetch_limit, t.top1
  FROM d CROSS JOIN lims l LEFT JOIN top1 t ON t.query_id = d.id AND t.prefetch_limit = l.prefetch_limit
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
FROM rate
""",
    "q23_footprint": """
SELECT len(embedding)::INTEGER AS dim, count(*)::BIGINT AS n_vectors,
       (len(embedding) * 4)::BIGINT AS full_precision_bytes, len(embedding) / 8.0 AS binary_quantized_bytes,
       round((len(embedding) * 4) / (len(embedding) / 8.0), 6) AS compression_ratio,
       (len(embedding) * 4 * count(*))::BIGINT AS corpus_full_precision_bytes,
       len(embedding) / 8.0 * count(*) AS corpus_binary_bytes
FROM embeddings GROUP BY len(embedding)
""",
    "q31_raw_maxsim": f"""
WITH {_MATRICES.replace("list(embedding::DOUBLE[] ORDER BY vec_id)", "list(list_transform(embedding::DOUBLE[], lambda x: x * (label + 1)) ORDER BY vec_id)")}
SELECT s.query_id, s.id, s.ham, round(list_sum(list_transform(qd.toks, lambda a: list_max(list_transform(dd.toks, lambda b:
         list_sum(list_transform(range(1, len(a) + 1), lambda i: a[i] * b[i])))))), 6) AS raw_score, round(s.score, 6) AS unit_score
FROM scored s JOIN d qd ON qd.id = s.query_id JOIN d dd ON dd.id = s.id
""",
    "q38_true_recall": f"""
WITH {_MATRICES_ALL},
lims AS (SELECT unnest([1, 2, 5, 10, 25, 50])::INTEGER AS prefetch_limit),
best AS (
  SELECT query_id, prefetch_limit, id FROM scored JOIN lims ON stage1_rank <= prefetch_limit
  QUALIFY row_number() OVER (PARTITION BY query_id, prefetch_limit ORDER BY round(score, 6) DESC, id) = 1
),
truth AS (SELECT query_id, id FROM scored QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id) = 1),
g AS (
  SELECT l.prefetch_limit, (b.id IS NOT DISTINCT FROM t.id)::INTEGER AS hit
  FROM d CROSS JOIN lims l LEFT JOIN best b ON b.query_id = d.id AND b.prefetch_limit = l.prefetch_limit LEFT JOIN truth t ON t.query_id = d.id
)
SELECT prefetch_limit, sum(hit)::BIGINT AS found, count(*)::BIGINT AS n_queries, round(sum(hit) * 100.0 / count(*), 6) AS recall_pct FROM g GROUP BY 1
""",
    "q39_exact_maxsim": f"""
WITH {_MATRICES_ALL}
SELECT query_id, id, round(score, 6) AS score, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 6) DESC, id)::INTEGER AS rank FROM scored
) WHERE rank <= 3
""",
}
