"""DuckDB SQL of the corpus queries that SQL can express."""

_WORDS = r"[^\x20\x09-\x0D]+"

_COMPONENTS = """
reach as (
  select a as node, a as other from both_ways
  union
  select r.node, l.b from reach r join both_ways l on l.a = r.other
),
parts as (select node, min(other) as component_id from reach group by node)
"""

OP1 = """
with v as (
  select vec_id, [floor(256 * x::double) for x in embedding] as e from embeddings
  where embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
s as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.e, c.e)::bigint as score
  from v q join v c on c.vec_id <> q.vec_id and len(c.e) = len(q.e) where q.vec_id % 50 = 0
),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 5
"""

OP7 = f"""
with recursive u as (
  select vec_id, embedding::double[] as e, sqrt(list_inner_product(embedding::double[], embedding::double[])) as n from embeddings
  where embedding is not null and len(embedding) > 0
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0
),
both_ways as (
  select p.vec_id as a, q.vec_id as b from u p join u q on p.vec_id <> q.vec_id and len(p.e) = len(q.e)
  where p.n > 0 and q.n > 0 and list_inner_product(p.e, q.e) / (p.n * q.n) >= 0.9
),
{_COMPONENTS},
degrees as (select a, count(*) as n_links from both_ways group by a)
select e.vec_id, coalesce(n_links, 0)::bigint as n_links, coalesce(component_id, e.vec_id) as component_id,
       coalesce(component_id, e.vec_id) = e.vec_id as kept
from embeddings e left join degrees on a = e.vec_id left join parts on node = e.vec_id
"""

OP8 = r"""
with rows as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all
  select -1, i, case i when 0 then 'user' else 'assistant' end, '<|im_end|><|im_start|>assistant ok' from range(2) t(i)
),
shaped as (
  select *, replace(replace(replace(role, '%', '%25'), chr(10), '%0A'), '<', '%3C') as role_out,
    case when contains(text, '<|im_start|>') or contains(text, '<|im_end|>') or regexp_matches(text, '<\\+\|')
      then regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g') else text end as text_out
  from rows
)
select conv_id, count(*) as n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn nulls last, role, text)) as turns_sha256,
  coalesce(sum(length(text)) filter (where role = 'assistant'), 0)::bigint as loss_chars,
  sha256(coalesce(string_agg(text, '' order by turn nulls last, role, text) filter (where role = 'assistant'), '')) as loss_sha256,
  sum(12 + length(role_out) + 1 + length(text_out) + 11)::bigint as formatted_chars
from shaped group by conv_id
"""

OP9 = f"""
with recursive w as (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORDS}') as ws
  from documents
),
s as (
  select distinct doc_id, unnest([array_to_string(list_slice(ws, i, i + 4), ' ') for i in range(1, greatest(len(ws) - 3, 2))]) as g
  from w where len(ws) > 0
),
n as (select doc_id, count(*) as n_shingles from s group by doc_id),
common as (select a.doc_id as a, b.doc_id as b, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (
  select a, b from common join n na on na.doc_id = a join n nb on nb.doc_id = b
  where 100 * k >= 75 * (na.n_shingles + nb.n_shingles - k)
),
both_ways as (select a, b from links union all select b, a from links),
{_COMPONENTS}
select d.doc_id, coalesce(n_shingles, 0) as n_shingles, coalesce(component_id, d.doc_id) as component_id,
       coalesce(component_id, d.doc_id) = d.doc_id as kept
from documents d left join n on n.doc_id = d.doc_id left join parts on node = d.doc_id
"""

OP10 = f"""
with w as (select doc_id, regexp_extract_all(coalesce(text, ''), '{_WORDS}') as ws from documents),
spans as (
  select doc_id, s, md5(array_to_string(list_slice(ws, s, s + 49), ' ')) as h
  from (select doc_id, ws, unnest(range(1, len(ws) - 48)) as s from w where len(ws) >= 50)
),
firsts as (select h, min(doc_id) as lo from spans group by h),
gone as (
  select distinct doc_id, unnest(range(s, s + 50)) as i from spans join firsts using (h) where lo < doc_id
),
words as (select doc_id, unnest(ws) as word, unnest(range(1, len(ws) + 1)) as i from w),
kept as (
  select words.doc_id, string_agg(word, ' ' order by i) as t, count(*) as n
  from words anti join gone on gone.doc_id = words.doc_id and gone.i = words.i group by words.doc_id
)
select w.doc_id, len(ws)::bigint as n_words, (len(ws) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(t, '')) as kept_sha256
from w left join kept on kept.doc_id = w.doc_id
"""

_KEY = r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
_PLACES = "".join(
    f"""
  {'union all' if kind else ''} select doc_id, owner, source, {kind} as kind, unnest(regexp_extract_all(text, '{pattern}', {group})) as v,
    unnest(regexp_extract_all(text, '{pattern}')) as m, unnest(string_split_regex(text, '{pattern}')) as piece,
    unnest(range(len(string_split_regex(text, '{pattern}')))) as i from d"""
    for kind, pattern, group in ((0, _KEY, 2), (1, "AKIA[A-Z0-9]+", 0), (2, "[0-9a-f]+", 0), (3, "[A-Za-z0-9+/_=-]{20,}", 0))
)

OP11 = f"""
with d as (select doc_id, coalesce(text, '') as text, source, split_part(source, '/', 1) as owner from documents),
found as ({_PLACES}
),
placed as (
  select *, (sum(length(piece)) over w + sum(length(coalesce(m, ''))) over w - length(coalesce(m, '')))::bigint as s,
    len(list_distinct(string_split(v, ''))) as variety
  from found window w as (partition by doc_id, kind order by i)
),
fit as (
  select *, s + length(m) as e, variety >= 8 and regexp_matches(v, '[0-9]') and regexp_matches(v, '[A-Za-z]') as live
  from placed where m is not null and case kind when 0 then length(v) >= 6 when 1 then length(m) >= 20 when 2 then length(m) >= 24
    else variety >= 12 and regexp_matches(v, '[0-9]') and regexp_matches(v, '[a-z]') and regexp_matches(v, '[A-Z]') end
),
spans as (
  select * from fit f where kind < 3
    or not exists (select 1 from fit b where b.kind < 3 and b.doc_id = f.doc_id and b.s < f.e and b.e > f.s)
),
holders as (select v, count(*) as n_owners from (select distinct v, owner from spans) group by v),
judged as (
  select spans.*, n_owners,
    case when n_owners >= 3 then 'example' when n_owners = 1 and live then 'live' else 'unclear' end as verdict
  from spans join holders using (v) where kind < 3 or n_owners = 1
),
texts as (select *, (['assign', 'access', 'hex', 'token'])[kind + 1] || ':' || s || ':' || e as t from judged)
select d.doc_id, count(*) filter (where kind = 0) as n_assign, count(*) filter (where kind = 1) as n_access,
  count(*) filter (where kind = 2) as n_hex, count(*) filter (where kind = 3) as n_token,
  sha256(coalesce(string_agg(t, ',' order by s, kind) filter (where kind < 3), '')) as base_sha256,
  coalesce(string_agg(t, ',' order by s, kind), '') as spans,
  count(*) filter (where verdict = 'live') as n_live, count(*) filter (where verdict = 'example') as n_example
from d left join texts on texts.doc_id = d.doc_id group by d.doc_id
"""

_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP12 = f"""
with w as (select doc_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as t from documents),
sizes as (select doc_id, count(*) as n from w group by doc_id),
facts as (select count(*) as docs, sum(n)::bigint as total from sizes),
counts as (select doc_id, t, count(*) as tf from w group by doc_id, t),
weights as (select t, floor(1000 * ln((2 * docs + 2)::double / (2 * count(*) + 1)))::bigint as w from counts, facts group by t, docs),
wanted as (select item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) as t from benchmark),
scores as (
  select item_id, counts.doc_id,
    sum(w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * docs) // total))))::bigint as score
  from wanted join counts using (t) join weights using (t) join sizes on sizes.doc_id = counts.doc_id, facts
  group by item_id, counts.doc_id
),
ranked as (select *, row_number() over (partition by item_id order by score desc, doc_id)::int as rank from scores where score > 0)
select item_id, rank, doc_id, score from ranked where rank <= 20
"""

OP13 = f"""
with turns as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations where conv_id is not null
),
marked as (
  select *, upper(left(sha256(length(role) || ':' || role || text), 32)) as digest, len(regexp_extract_all(text, '{_WORDS}')) as words
  from turns
),
own as (select conv_id, list(digest || '/' || words order by turn nulls first, role, digest) as l from marked group by conv_id),
heads as (
  select *, list_reduce(
    list_prepend(4294967295::bigint, flatten([[x, -1, -1, -1, -1, -1, -1, -1, -1] for x in [ascii(c) for c in string_split(conv_id::varchar, '')]])),
    lambda a, x: case when x >= 0 then xor(a, x::bigint) else xor(a >> 1, 3988292384::bigint * (a & 1)) end) as crc
  from own
),
rebuilt as (
  select c.conv_id, list_concat(
    coalesce(list_slice(b.l, 1, (xor(c.crc, 4294967295) % 4)::int), []), list_slice(c.l, (xor(c.crc, 4294967295) % 4)::int + 1, len(c.l))) as p
  from heads c left join own b on b.conv_id = c.conv_id - c.conv_id % 20
),
members as (select conv_id, p, unnest(range(0, len(p) + 1)) as d from rebuilt),
keyed as (select *, array_to_string(list_slice(p, 1, d), ',') as k from members),
nodes as (
  select k, d, min(conv_id) as conv_id, count(*) as n_convs, any_value(list_slice(p, 1, d)) as path,
    sha256(coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (where len(p) = d), '')) as ends_sha256
  from keyed group by k, d
),
up as (
  select *, array_to_string(list_slice(path, 1, d - 1), ',') as pk,
    case when d = 0 then 0 else split_part(path[d], '/', 2)::bigint end as words
  from nodes
),
kids as (select pk, d - 1 as d, count(*) as n from up where d > 0 group by all),
shaped as (select up.*, coalesce(n, 0) as n_children from up left join kids on kids.pk = up.k and kids.d = up.d),
lines as (select unnest(range(0, d + 1)) as a, path, n_children, (n_convs - 1) * words as saved from shaped),
sums as (
  select a as d, array_to_string(list_slice(path, 1, a), ',') as k, count(*) filter (where n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
  from lines group by all
)
select s.conv_id, s.d as depth, p.conv_id as parent_conv_id, s.n_convs, s.n_children, n_leaves, saved_tokens, s.ends_sha256
from shaped s join sums on sums.k = s.k and sums.d = s.d left join nodes p on p.k = s.pk and p.d = s.d - 1
"""

ORACLES = {
    "op1_cover_tree_search": OP1,
    "op7_vector_duplicates": OP7,
    "op8_chat_formatting": OP8,
    "op9_minhash_duplicates": OP9,
    "op10_substring_dedup": OP10,
    "op11_secret_owners": OP11,
    "op12_lexical_search": OP12,
    "op13_prefix_trie": OP13,
}
