"""DuckDB SQL for the dealt operators' queries, where SQL can express the whole result."""

OP3 = r"""
with d as (
  select doc_id, source, coalesce(source, chr(1114111) || chr(1114111)) as sk,
         case when text is null then 0 else len(regexp_extract_all(text, '[^ \t\n\x0B\f\r]+')) end as size,
         -ln((cast(('0x' || substr(md5('mix:' || coalesce(cast(doc_id as varchar), md5(text), '')), 1, 12)) as bigint) + 0.5) / 281474976710656.0)
           / coalesce(0.1 + length(translate(text, '#*$%&|<>0123456789', '')) / greatest(length(text), 1), 0.1) as k
  from documents),
s as (select sk, sum(size)::bigint as source_size, count(*) as n_docs, row_number() over (order by encode(sk)) as rn from d group by sk),
w as (select *, 1 + (rn - 1) % 3 as w, 3 * source_size as cap, sum(source_size) over () as total from s),
o as (select *,
        total - coalesce(sum(cap) over (order by source_size / w, encode(sk) rows between unbounded preceding and 1 preceding), 0) as rest,
        sum(w) over () - coalesce(sum(w) over (order by source_size / w, encode(sk) rows between unbounded preceding and 1 preceding), 0) as open_w
      from w),
c as (select *, cap * open_w < rest * w as capped from o),
t as (select *, case when capped then cap::double
        else w * (total - coalesce(sum(cap) filter (capped) over (), 0))::double / greatest(coalesce(sum(w) filter (not capped) over (), 0), 1) end as target from c),
p as (select *, floor(target / greatest(source_size, 1))::bigint as epochs from t),
r as (select d.doc_id, d.size, p.source_size, p.target, p.epochs, p.target - p.epochs * p.source_size as budget,
        sum(d.size) over (partition by d.sk order by d.k, d.doc_id, d.size rows between unbounded preceding and current row) - d.size as before
      from d join p using (sk))
select doc_id, size::bigint as size, source_size, target,
       (epochs * size + case when before + size / 2 <= budget then size else 0 end)::bigint as taken from r
"""

OP5 = r"""
with recursive w as (select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^ \t\n\x0B\f\r]+') as w from documents),
s as (select doc_id, unnest(case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(list_slice(w, i, i + 4), ' '))) when len(w) > 0 then [array_to_string(w, ' ')] else [] end) as g from w),
n as (select doc_id, count(*) as n from s group by 1),
p as (select a.doc_id as x, b.doc_id as y, count(*) as shared from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by all),
l as (select x, y from p join n i on x = i.doc_id join n j on y = j.doc_id where 100 * shared >= 85 * (i.n + j.n - shared)),
e as (select x, y from l union select y, x from l),
r(doc_id, other) as (select doc_id, doc_id from documents union select r.doc_id, e.y from r join e on r.other = e.x),
c as (select doc_id, min(other) as m from r group by 1)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, c.m as component_id, d.doc_id = c.m as kept from documents d left join n using (doc_id) join c using (doc_id)
"""

_FOLDED = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP7 = f"""
with b as (select cast(item_id as varchar) as item, {_FOLDED} as w from benchmark),
b2 as (select item, w, least(len(w), 10) as k from b where len(w) > 0),
bw as (select distinct item, k, list_slice(w, i, i + k - 1) as g from (select item, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from b2)),
d as (select row_number() over () as r, doc_id, {_FOLDED} as w from documents),
dw as (select r, k, i, list_slice(w, i, i + k - 1) as g
       from (select r, w, k, unnest(generate_series(1, len(w) - k + 1)) as i from d, (select distinct k from bw) where len(w) >= k)),
h as (select r, item, i, dw.k from dw join bw on dw.g = bw.g and dw.k = bw.k),
p as (select r, count(distinct pos)::bigint as n_hit from (select r, unnest(generate_series(i, i + k - 1)) as pos from h) group by r),
n as (select r, count(distinct item)::bigint as n_items, string_agg(distinct item, ',' order by item) as items from h group by r)
select doc_id, len(w)::bigint as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
       sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
from d left join p using (r) left join n using (r)
"""

OP8 = r"""
with a as (select page_id, case when instr(url, '://') > 0 then substr(url, instr(url, '://') + 3) else '' end as rest from pages),
b as (select page_id, regexp_extract(rest, '^[^?#]*') as bare from a),
h as (select page_id, regexp_extract(bare, '^[^/]*') as raw, bare from b),
u as (select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, substr(bare, length(raw) + 1) as path from h),
r(verdict, rhost, rpath) as (values ('allow', 'org', '/'), ('block', 'example.org', '/es/'), ('block', 'example.org', '/en/1'), ('allow', 'com', '/fr/'), ('block', 'com', '/de/')),
f as (select u.page_id, u.host, u.path, arg_max(struct_pack(rule := rhost || rpath, verdict := verdict), length(rhost || rpath)) filter (rhost is not null) as won
      from u left join r on (u.host = rhost or ends_with(u.host, '.' || rhost)) and starts_with(u.path, rpath) group by all)
select page_id, host, path, won.rule as rule,
       coalesce(won.verdict, case when regexp_matches(host || path, 'spam|casino|porn|viagra') or ends_with(host, '.zip') and starts_with(path, '/') then 'block' else 'allow' end) as verdict
from f
"""

OP13 = f"""
with d as (select row_number() over () as r, doc_id, {_FOLDED} as w from documents),
t as (select r, doc_id, len(w)::bigint as n, w from d where len(w) > 0),
g as (select count(*)::bigint as all_docs, sum(n)::bigint as all_words from t),
q as (select item_id, term, count(*)::bigint as repeats from (select item_id, unnest({_FOLDED}) as term from benchmark) group by all),
p as (select r, doc_id, n, term, count(*)::bigint as tf from (select r, doc_id, n, unnest(w) as term from t) where term in (select term from q) group by all),
f as (select term, floor(1000 * ln((2 * all_docs + 2) / (2 * count(*) + 1)))::bigint as weight from p, g group by term, all_docs),
s as (select item_id, r, doc_id, sum(repeats * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * all_docs) // all_words))))::bigint as score
      from p join f using (term) join q using (term), g group by item_id, r, doc_id)
select item_id, rank, doc_id, score
from (select item_id, (row_number() over (partition by item_id order by score desc, doc_id))::int as rank, doc_id, score from s where score > 0) where rank <= 10
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_source_mix": OP3, "op5_near_duplicates": OP5, "op7_decontaminate": OP7, "op8_url_filter": OP8, "op13_ranked_search": OP13}
