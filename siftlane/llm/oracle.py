"""DuckDB recomputations of the operators that SQL can express."""

OP1 = """
with v as (
  select row_number() over (order by vec_id) as id, vec_id, list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), e as (
  select id, vec_id, generate_subscripts(v, 1) as i, unnest(v) as x from v
), s as (
  select q.id, q.vec_id as query_id, p.id as other, p.vec_id, sum(q.x * p.x) as score
  from e q join e p on q.i = p.i and q.id <> p.id
  where q.vec_id % 50 = 0
  group by all
), r as (
  select query_id, cast(row_number() over (partition by id order by score desc, vec_id, other) as integer) as rank, vec_id, cast(score as bigint) as score
  from s
)
select * from r where rank <= 5
"""

OP7 = """
with rules(action, host, path) as (
  values ('allow','com','/'), ('block','example.com','/en/'), ('allow','www.example.com','/en/'), ('block','net','/es/'), ('block','net','/fr/')
), p as (
  select page_id,
    translate(regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '^[\\s\\S]*?://[^/?#]*([^?#]*)', 1) as path
  from pages
), m as (
  select p.page_id, p.host, p.path, r.host || r.path as rule, r.action
  from p left join rules r on (p.host = r.host or ends_with(p.host, '.' || r.host)) and starts_with(p.path, r.path)
)
select page_id, host, path, arg_max(rule, length(rule)) as rule,
  coalesce(arg_max(action, length(rule)), 'allow') as verdict
from m group by page_id, host, path
"""

OP5 = """
with p as (
  select page_id, coalesce(html, '') as html, strlen(coalesce(html, '')) as payload_bytes, sha256(coalesce(html, '')) as payload_digest
  from pages
), f as (
  select payload_digest, min(page_id) as first_id from p where payload_bytes >= 100 group by payload_digest
)
select p.page_id, p.payload_bytes, p.payload_digest,
  case when p.page_id > f.first_id then 'revisit' else 'response' end as record_type,
  case when p.page_id > f.first_id then f.first_id end as refers_to
from p left join f on p.payload_digest = f.payload_digest and p.payload_bytes >= 100
"""

OP10 = """
with i as (
  select item_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as w from benchmark
), s as (
  select item_id, least(len(w), 5) as k, unnest(list_transform(range(1, len(w) - least(len(w), 5) + 2), lambda j: array_to_string(list_slice(w, j, j + least(len(w), 5) - 1), ' '))) as shingle
  from i where len(w) > 0
), si as (select distinct item_id, k, shingle from s),
n as (select item_id, count(*) as item_shingles from si group by item_id),
d as (
  select doc_id, text, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{L}\\p{N}]+'), lambda w: w <> '') as w from (select distinct doc_id, text from documents)
), k as (select distinct k from si),
ds as (
  select distinct doc_id, text, k, shingle from (
    select doc_id, text, k, unnest(list_transform(range(1, greatest(len(w) - k + 2, 1)), lambda j: array_to_string(list_slice(w, j, j + k - 1), ' '))) as shingle from d, k
  )
), c as (
  select doc_id, text, item_id, count(*) as shared from ds join si using (k, shingle) group by all
)
select doc_id, item_id, shared, item_shingles, shared / item_shingles as containment
from c join n using (item_id) where shared >= ceil(0.8 * item_shingles - 1e-9)
"""

OP11 = """
with d as (
  select doc_id, coalesce(text, '') as text, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') as u,
    sha256('1:' || coalesce(cast(doc_id as varchar), '')) as x
  from documents
), h as (
  select *, len(u) as n, [cast('0x' || substr(x, 8 * i + 1, 8) as ubigint) for i in [0, 1, 2, 3]] as h from d
), c as (
  select *, cast(least(h[1] % (n + 1), h[2] % (n + 1)) as bigint) as a, cast(greatest(h[1] % (n + 1), h[2] % (n + 1)) as bigint) as b,
    case when text = '' or contains(text, '<P>') or contains(text, '<S>') or contains(text, '<M>') or h[3] % 100 >= 90 then 'plain'
      when h[4] % 100 < 20 then 'spm' else 'psm' end as form
  from h
), s as (
  select *, array_to_string(u[1 : a], '') as p, array_to_string(u[a + 1 : b], '') as m, array_to_string(u[b + 1 :], '') as t from c
)
select doc_id, cast(n as bigint) as n, form, case when form <> 'plain' then length(p) end as prefix_chars, case when form <> 'plain' then length(m) end as middle_chars,
  sha256(case form when 'plain' then text when 'psm' then '<P>' || p || '<S>' || t || '<M>' || m else '<S>' || t || '<P>' || p || '<M>' || m end) as output_sha256,
  sha256(text) as restored_sha256
from s
"""

OP13 = r"""
with recursive k as (
  select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text,
    list_reduce(flatten(list_transform(string_split(coalesce(cast(conv_id as varchar), ' ') || ':' || coalesce(cast(turn as varchar), ' '), ''),
        lambda c: list_transform([0, 1, 2, 3, 4, 5, 6, 7], lambda i: cast((ord(c) >> i) & 1 as ubigint)))),
      lambda x, bit: xor(x >> 1, case when xor(x & 1, bit) = 1 then 3988292384::ubigint else 0::ubigint end), 4294967295::ubigint) as crc
  from conversations
), g as (
  select conv_id, turn, case when kind = 4 then 'user' else role end as role,
    case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy
  from (select *, xor(crc, 4294967295::ubigint) % 20 as kind from k) where kind <> 0
), o as (
  select *, row_number() over (partition by conv_id order by turn nulls first, role, text, copy) as pos, left(role, 1) as ini, rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) as kept from g
), f as (
  select *, case when kept = '' then 'b' when row_number() over (partition by conv_id, role, text order by pos) > 1 then 'd' when right(kept, 1) not in ('.', '!', '?') then 't' else '-' end as fault,
    lag(ini) over (partition by conv_id order by pos) || ini as pair
  from o
), counts as (
  select conv_id, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (fault = 'b') as blank, count(*) filter (fault = 'd') as duplicate,
    count(*) filter (fault = 't') as truncated, count(*) filter (pair not in ('su', 'ua', 'au')) as illegal, count(*) as n
  from f group by conv_id
), nxt(state, ini, dest) as (values (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)),
ins(state, dest, icost, word, added) as (
  values (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''), (0, 2, 2, 'I', 'u'), (1, 2, 2, 'I', 'u'), (2, 3, 2, 'I', 'a'), (3, 2, 2, 'I', 'u'),
    (0, 3, 4, 'II', 'ua'), (1, 3, 4, 'II', 'ua')
), edit as (
  select 'D' as e, state, null as ini, state as dest, 3 as ecost from (select distinct state from nxt)
  union all select 'K', state, ini, dest, 0 from nxt union all select 'R', state, ini, dest, 2 from nxt where ini <> 's'
), best(conv_id, pos, state, cost, audit, repaired) as (
  select conv_id, cast(0 as bigint), 0, cast(0 as bigint), '', cast([] as varchar[]) from counts
  union all
  select conv_id, pos, state, b.cost, b.audit, b.repaired from (
    select b.conv_id, f.pos, e.dest as state,
      min({'cost': cast(b.cost + i.icost + e.ecost + case when f.fault = 't' and e.e <> 'D' then 1 else 0 end as bigint), 'audit': b.audit || i.word || e.e,
        'repaired': list_concat(list_concat(b.repaired, list_transform(list_filter(string_split(i.added, ''), lambda r: r <> ''), lambda r: case r when 'u' then 'user:' else 'assistant:' end)),
          case e.e when 'D' then cast([] as varchar[]) when 'K' then [f.role || ':' || f.text] else [case e.ini when 'u' then 'user:' else 'assistant:' end || f.text] end)}) as b
    from best b join f on b.conv_id is not distinct from f.conv_id and f.pos = b.pos + 1
      join ins i on i.state = b.state join edit e on e.state = i.dest
    where e.e = 'D' or f.fault not in ('b', 'd') and (e.e = 'R' or e.ini = f.ini)
    group by b.conv_id, f.pos, e.dest
  )
), done as (
  select b.conv_id, min({'cost': b.cost + i.icost, 'audit': b.audit || i.word, 'repaired': list_concat(b.repaired, list_transform(list_filter(string_split(i.added, ''), lambda r: r <> ''), lambda r: case r when 'u' then 'user:' else 'assistant:' end))}) as d
  from best b join counts c on b.conv_id is not distinct from c.conv_id and b.pos = c.n join ins i on i.state = b.state where i.dest in (0, 3) group by b.conv_id
)
select v.conv_id, cast(coalesce(gaps, 0) as bigint) as gaps, coalesce(blank, 0) as blank, coalesce(duplicate, 0) as duplicate, coalesce(truncated, 0) as truncated,
  coalesce(illegal, 0) as illegal, coalesce(d.cost, 0) as cost, coalesce(d.audit, '') as audit, sha256(coalesce(array_to_string(d.repaired, chr(10)), '')) as repaired_sha256
from (select distinct conv_id from conversations) v left join counts c on v.conv_id is not distinct from c.conv_id left join done on v.conv_id is not distinct from done.conv_id
"""

OP12 = r"""
with a as (
  select page_id, url, regexp_extract(coalesce(html, ''), '<article>(.*?)</article>', 1, 's') as a from pages
), b as (
  select page_id, url, string_split(regexp_replace(a, '</?(p|h1)>', chr(1), 'g'), chr(1)) as parts from a
), c as (
  select page_id, url, list_transform(parts, lambda x: trim(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(x, '<br>', ' ', 'g'), '<b>', ''), '&quot;', '"', 'g'),
    '&amp;?', '&', 'g'), '[ \t\n\r]+', ' ', 'g'))) as parts from b
)
select page_id, url, array_to_string(list_filter(parts, lambda x: x <> ''), chr(10)) as text, cast(length(array_to_string(list_filter(parts, lambda x: x <> ''), chr(10))) as bigint) as n_chars
from c
"""

SQL = {"op10_decontamination": OP10, "op11_infill": OP11, "op12_html_text": OP12, "op13_conversation_repair": OP13, "op5_warc": OP5, "op1_exact_topk": OP1, "op7_url_filter": OP7}
