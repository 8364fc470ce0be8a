"""DuckDB counterparts of the queries that SQL can express.

The others are tested against brute force: encoders against the libraries' own, packings and shards
against their laws, trained classifiers by held-out accuracy.
"""

from __future__ import annotations

_NEAR_VECTORS = """
with recursive v as materialized (
  select vec_id, label, list_transform(embedding, lambda x: cast(x as double)) as v from embeddings
  where vec_id is not null and label is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
    and len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links as materialized (
  select a.vec_id as a, b.vec_id as b from v a join v b on a.label = b.label and a.vec_id <> b.vec_id
  where len(a.v) = len(b.v) and list_cosine_similarity(a.v, b.v) >= 0.98
),
reach as (
  select vec_id as a, vec_id as b from embeddings
  union
  select r.a, l.b from reach r join links l on l.a = r.b
),
components as (select a, min(b) as component_id from reach group by a),
counts as (select a, count(*) as n from links group by a)
select e.vec_id, coalesce(n.n, 0) as n_links, c.component_id, e.vec_id = c.component_id as kept
from embeddings e join components c on c.a = e.vec_id left join counts n on n.a = e.vec_id"""

_NEAR_DOCUMENTS = r"""
with recursive words as materialized (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents
),
sets as materialized (
  select doc_id, case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
    else list_distinct(list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i+3], ' '))) end as s
  from words
),
grams as materialized (select doc_id, len(s) as n, unnest(s) as g from sets),
links as materialized (
  select a.doc_id as a, b.doc_id as b from grams a join grams b on a.g = b.g and a.doc_id <> b.doc_id
  group by a.doc_id, b.doc_id, a.n, b.n
  having 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach as (
  select doc_id as a, doc_id as b from documents
  union
  select r.a, l.b from reach r join links l on l.a = r.b
)
select d.doc_id, cast(len(s.s) as bigint) as n_shingles, min(r.b) as component_id
from documents d join sets s on s.doc_id = d.doc_id join reach r on r.a = d.doc_id
group by d.doc_id, s.s"""

# CRC-32 of the texts ``w`` of a table, by the table of what each byte adds to the register.
_CRC = """
crc_bytes as materialized (
  select list(list_reduce(range(0, 8),
    lambda c, k: case when c % 2 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i) order by i) as adds
  from range(0, 256) t(i)
),
crcs as materialized (
  select w, xor(list_reduce(
    list_transform(range(1, strlen(w) + 1), lambda i: cast('0x' || substr(h, 2 * i - 1, 2) as bigint)),
    lambda c, b: xor(c >> 8, adds[xor(c, b) % 256 + 1]), 4294967295), 4294967295) as crc
  from (select w, hex(w) as h from crc_words), crc_bytes
)"""

_TRIE = f"""
with turns as materialized (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  where conv_id is not null
),
own as materialized (
  select conv_id, sha256(strlen(role) || ':' || role || text) as digest, strlen(text) as n_bytes,
    row_number() over (partition by conv_id
      order by turn nulls first, sha256(strlen(role) || ':' || role || text)) - 1 as nth
  from turns
),
counts as materialized (select conv_id, count(*) as n from own group by conv_id),
crc_words as (select cast(conv_id as varchar) as w from counts),
{_CRC},
heads as materialized (
  select c.conv_id, c.n, crc % 9 as head, c.conv_id - c.conv_id % 5 as source, least(crc % 9, coalesce(s.n, 0)) as taken
  from counts c join crcs on w = cast(c.conv_id as varchar)
  left join counts s on s.conv_id = c.conv_id - c.conv_id % 5
),
rebuilt as materialized (
  select conv_id, 0 as depth, '' as digest, 0 as n_bytes from heads
  union all
  select h.conv_id, nth + 1, digest, n_bytes from heads h join own o on o.conv_id = h.source and nth < taken
  union all
  select h.conv_id, nth - head + taken + 1, digest, n_bytes
  from heads h join own o on o.conv_id = h.conv_id and nth >= head
),
prefixes as materialized (
  select conv_id, depth, n_bytes, max(depth) over (partition by conv_id) as total,
    string_agg(digest, ',') over (partition by conv_id order by depth) as path
  from rebuilt
),
members as materialized (
  select *, lag(path) over (partition by conv_id order by depth) as above from prefixes
),
nodes as materialized (
  select path, min(conv_id) as conv_id, depth, above, n_bytes, count(*) as n_convs,
    sha256(coalesce(string_agg(cast(conv_id as varchar), ',' order by conv_id) filter (where depth = total), '')) as ends
  from members group by path, depth, above, n_bytes
),
children as (select above as path, count(*) as n from nodes where above is not null group by above),
sums as (
  select up.path, sum(cast(c.n is null as bigint)) as n_leaves, sum((n.n_convs - 1) * n.n_bytes) as saved_tokens
  from nodes n join members up on up.conv_id = n.conv_id and up.depth <= n.depth
  left join children c on c.path = n.path
  group by up.path
)
select n.conv_id, cast(n.depth as bigint) as depth, p.conv_id as parent_conv_id, n.n_convs, coalesce(c.n, 0) as n_children,
  cast(s.n_leaves as bigint) as n_leaves, cast(s.saved_tokens as bigint) as saved_tokens, n.ends as ends_sha256
from nodes n join sums s on s.path = n.path left join nodes p on p.path = n.above left join children c on c.path = n.path"""

_FEATURES = r"""regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"""

_IMPORTANCE = f"""
with docs as materialized (select row_number() over () as nth, doc_id, {_FEATURES} as words from documents),
features as materialized (select nth, unnest(words) as w from docs),
goal as materialized (select unnest({_FEATURES}) as w from benchmark),
crc_words as (select w from features union select w from goal),
{_CRC},
source as (select crc % 10000 as bucket, count(*) as s from features join crcs using (w) group by 1),
target as (select crc % 10000 as bucket, count(*) as t from goal join crcs using (w) group by 1),
gains as materialized (
  select bucket, cast(floor(1000 * ln(
    (coalesce(t, 0) + 1.0::double) * ((select count(*) from features) + 10000.0::double)
    / ((coalesce(s, 0) + 1.0::double) * ((select count(*) from goal) + 10000.0::double)))) as bigint) as gain
  from source full join target using (bucket)
),
weights as (
  select nth, sum(gain) as weight from features join crcs using (w) join gains on bucket = crc % 10000 group by nth
),
scored as materialized (
  select doc_id, cast(len(words) as bigint) as n_features, cast(coalesce(weight, 0) as bigint) as weight,
    cast(coalesce(weight, 0) + floor(-1000 * ln(-ln((
      cast('0x' || substr(sha256('2024:' || coalesce(cast(doc_id as varchar), '')), 1, 8) as bigint) + 0.5::double
    ) / 4294967296.0::double))) as bigint) as score
  from docs left join weights using (nth)
),
ranked as (
  select *, row_number() over (order by score desc, doc_id nulls first, n_features, weight) as place,
    10 * count(*) over () // 100 as drawn
  from scored where n_features >= 20
)
select doc_id, n_features, weight, score, case when place <= drawn then place end as rank from ranked
union all
select doc_id, n_features, weight, score, null from scored where n_features < 20"""

ORACLES: dict[str, str] = {
    "op1_multi_index": _NEAR_VECTORS,
    "op10_ngram_jaccard": _NEAR_DOCUMENTS,
    "op11_prefix_trie": _TRIE,
    "op13_importance_resampling": _IMPORTANCE,
}
