"""DuckDB SQL for the queries whose rows SQL can express."""

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

LOW = f"translate(text, '{UPPER}', '{UPPER.lower()}')"

LINE_DEDUP = """
with doc_lines as (select doc_id, string_split(text, chr(10)) as ls from documents),
lines as (select doc_id, k as pos, ls[k] as raw, trim(ls[k]) as line from doc_lines, unnest(range(1, len(ls) + 1)) t(k)),
firsts as (select line, min((doc_id, pos)) as first, length(line) as n from lines where line <> '' group by line),
variants as (
  select line, first, n, k, md5(left(line, k - 1) || substr(line, k + 1)) as v
  from firsts, unnest(range(1, n + 1)) t(k) where n >= 20),
near as (
  select a.line from variants a join variants b on a.v = b.v and a.k = b.k and a.n = b.n where b.first < a.first
  union select a.line from variants a join firsts b on a.v = md5(b.line) and b.n = a.n - 1 where b.n >= 20 and b.first < a.first
  union select b.line from variants a join firsts b on a.v = md5(b.line) and b.n = a.n - 1 where b.n >= 20 and a.first < b.first),
judged as (
  select l.doc_id, l.pos, l.raw, l.line <> '' and (f.first <> (l.doc_id, l.pos) or n.line is not null) as gone
  from lines l left join firsts f on l.line = f.line left join near n on l.line = n.line)
select d.doc_id, coalesce(j.text, case when d.text is not null then '' end) as text,
  coalesce(j.n_lines, 0)::bigint as n_lines, coalesce(j.n_dropped, 0)::bigint as n_dropped
from documents d left join (
  select doc_id, string_agg(raw, chr(10) order by pos) filter (where not coalesce(gone, false)) as text,
    count(*) as n_lines, count(*) filter (where gone) as n_dropped
  from judged group by doc_id) j on d.doc_id = j.doc_id"""

_WORDS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"

DECONTAMINATION = f"""
with dw as (select doc_id, coalesce(regexp_extract_all({LOW}, '{_WORDS}'), []) as w from documents),
iw as (select item_id, regexp_extract_all({LOW}, '{_WORDS}') as w from benchmark where text is not null),
windows as (
  select item_id, least(13, len(w)) as n, array_to_string(w[k:k + 12], ' ') as gram
  from iw, unnest(range(1, greatest(len(w) - 12, 1) + 1)) t(k) where len(w) > 0),
grams as (
  select doc_id, k, n, array_to_string(w[k:k + n - 1], ' ') as gram
  from dw, (select distinct n from windows) s, unnest(range(1, len(w) - n + 2)) t(k)),
found as (select distinct g.doc_id, g.k, g.n, x.item_id from grams g join windows x on g.gram = x.gram and g.n = x.n),
hit as (select doc_id, count(distinct p) as n_hit from (select distinct doc_id, k, n from found), unnest(range(k, k + n)) t(p) group by doc_id),
named as (
  select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
  from (select distinct doc_id, item_id::varchar as item from found) group by doc_id)
select dw.doc_id, len(dw.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit, coalesce(n_items, 0)::bigint as n_items,
  sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(dw.w) as contaminated
from dw left join hit on dw.doc_id = hit.doc_id left join named on dw.doc_id = named.doc_id"""

NGRAM_JOIN = f"""
with recursive dw as (select doc_id, coalesce(regexp_extract_all({LOW}, '[^\\x20\\x09-\\x0D]+'), []) as w from documents),
shingles as (
  select distinct doc_id, array_to_string(w[k:k + 4], ' ') as s
  from dw, unnest(range(1, greatest(len(w) - 4, 1) + 1)) t(k) where len(w) > 0),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select a.doc_id as a, b.doc_id as b, count(*) as k from shingles a join shingles b on a.s = b.s and a.doc_id <> b.doc_id group by all),
edges as (
  select c.a, c.b from common c join sizes x on c.a = x.doc_id join sizes y on c.b = y.doc_id where 100 * c.k >= 80 * (x.n + y.n - c.k)),
reach as (select a, b from edges union select r.a, e.b from reach r join edges e on r.b = e.a),
lowest as (select a, min(b) as b from reach group by a)
select dw.doc_id, coalesce(sizes.n, 0)::bigint as n_shingles, least(dw.doc_id, coalesce(l.b, dw.doc_id)) as component_id
from dw left join sizes on dw.doc_id = sizes.doc_id left join lowest l on dw.doc_id = l.a"""

MINHASH_DEDUP = f"""
select *, doc_id = component_id as kept from ({NGRAM_JOIN.replace("w[k:k + 4]", "w[k:k + 1]").replace("len(w) - 4", "len(w) - 1")})"""
