"""Checking SQL of the substring operators: every window of every text, grouped by its digest."""

BYTE_DEDUP = r"""
with b as (select row_number() over () as id, doc_id, encode(coalesce(text, '')) as raw from documents),
p as (select id, unnest(range(1, (octet_length(raw) - 398)::bigint)) as p, raw from b where octet_length(raw) >= 400),
t as (select id, p, md5(raw[p:p + 399]) as t from p),
h as (select id, p from (select id, p, count(*) over (partition by t) as c from t) where c > 1),
s as (select id, p, coalesce(p - lag(p) over (partition by id order by p) > 400, true) as opens from h),
r as (select id, p, sum(opens::int) over (partition by id order by p) as run from s),
spans as (select id, run, min(p) as a, max(p) + 400 as z from r group by id, run),
edges as (select id, a, z, coalesce(lag(z) over (partition by id order by a), 1) as from_, row_number() over (partition by id order by a desc) = 1 as last from spans),
parts as (select e.id, a as place, hex(raw[from_:a - 1]) as part from edges e join b on e.id = b.id
          union all select e.id, z, hex(raw[z:octet_length(raw)]) from edges e join b on e.id = b.id where last),
k as (select id, string_agg(part, '' order by place) as kept from parts group by id),
n as (select id, sum(z - a)::bigint as n_removed, count(*) as n_spans from spans group by id)
select doc_id, octet_length(raw)::bigint as n_bytes, coalesce(n_removed, 0) as n_removed, coalesce(n_spans, 0) as n_spans,
       case when kept is null then sha256(raw) else sha256(unhex(kept)) end as kept_sha256
from b left join n using (id) left join k using (id)"""

WORD_DEDUP = r"""
with w as (select row_number() over () as id, doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') as words from documents),
p as (select id, doc_id, words, unnest(range(1, (len(words) - 48)::bigint)) as p from w where len(words) >= 50),
t as (select id, doc_id, p, md5(array_to_string(words[p:p + 49], ' ')) as t from p),
g as (select *, min(doc_id) over (partition by t) as least from t),
c as (select distinct id, unnest(range(p, p + 50)) as q from g where least < coalesce(doc_id, 9223372036854775807)),
x as (select id, unnest(words) as word, generate_subscripts(words, 1) as q from w),
k as (select x.id, string_agg(word, ' ' order by x.q) as kept, count(*) as n from x anti join c on x.id = c.id and x.q = c.q group by x.id)
select doc_id, len(words)::bigint as n_words, len(words) - coalesce(n, 0) as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from w left join k using (id)"""
