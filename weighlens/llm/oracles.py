"""The same results in another engine's SQL, for the operators that SQL can express."""

from __future__ import annotations

_H60 = "('0x' || substr(md5({0}), 1, 15))::bigint"

# cuts by a full sort: of every j/16 of all bytes the nearer edge of the text it falls on, if that is within 2 % of a
# shard, else the nearer edge of the row
_OP2 = f"""
with d as (
    select doc_id, coalesce(text, '') as t, coalesce(strlen(text), 0)::bigint + 1 as size,
           {_H60.format("coalesce(text, '')")} as h, {_H60.format("coalesce(doc_id::varchar, 'null')")} as k
    from documents),
total as (select sum(size)::hugeint as n from d),
texts as (select h, sum(size)::hugeint as own, sum(sum(size)) over (order by h)::hugeint as upto from d group by h),
rows_of as (select h, k, sum(size)::hugeint as own, sum(sum(size)) over (order by h, k)::hugeint as upto from d group by h, k),
goals as (select j, n * j as goal, n from total, (select unnest(range(1, 16))::hugeint as j) x),
at_text as (
    select j, goal, n, h, goal - (upto - own) * 16 as before, upto * 16 - goal as after
    from goals join texts on (upto - own) * 16 <= goal and upto * 16 > goal),
cuts as (
    select case when before <= after then h else h + 1 end as ch, 0::bigint as ck
    from at_text where least(before, after)::double <= 0.02 * n::double
    union all
    select r.h, case when goal - (r.upto - r.own) * 16 <= r.upto * 16 - goal then r.k else r.k + 1 end
    from at_text a join rows_of r on a.h = r.h and (r.upto - r.own) * 16 <= goal and r.upto * 16 > goal
    where least(before, after)::double > 0.02 * n::double),
placed as (select d.*, (select count(*) from cuts where ch < d.h or (ch = d.h and ck <= d.k)) as shard from d),
crc_steps as (
    select list_transform(range(256), lambda n: list_reduce(list_prepend(n, [1, 1, 1, 1, 1, 1, 1, 1]),
           lambda c, one: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as steps),
crcs as (
    select t, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(t)), '..'), lambda b: ('0x' || b)::bigint)),
           lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8))) as crc
    from (select distinct t from d) x, crc_steps)
select doc_id, size, case when t = '' then 0 else crc end as text_crc32, 'bytes' as law, shard::int as shard,
       row_number() over (partition by shard order by h, k, doc_id, size) - 1 as slot, null::int as grown_shard
from placed join crcs using (t)"""

_OP3 = """
with recursive v as (
    select vec_id, embedding::double[] as e from embeddings),
sound as (
    select vec_id, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) as size from v
    where e is not null and len(e) > 0 and len(list_filter(e, lambda x: x is null or isnan(x) or isinf(x))) = 0 and list_max(list_transform(e, lambda x: abs(x))) > 0),
links as (
    select a.vec_id as a, b.vec_id as b from sound a join sound b on a.vec_id <> b.vec_id and len(a.e) = len(b.e)
    where list_dot_product(a.e, b.e) / (a.size * b.size) >= 0.9),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
lowest as (select a, min(b) as low from reach group by a),
counted as (select a, count(*) as n from links group by a)
select v.vec_id, coalesce(n, 0) as n_links, least(v.vec_id, coalesce(low, v.vec_id)) as component_id, v.vec_id <= coalesce(low, v.vec_id) as kept
from v left join lowest on v.vec_id = lowest.a left join counted on v.vec_id = counted.a"""

_OP4 = """
with p as (select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha1(coalesce(html, '')) as h from pages),
d as (
    select page_id, payload_bytes, array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, (i // 8)::int * 10 + 1, 10))::bigint >> (35 - 5 * (i % 8))::int) & 31)::int + 1, 1)), '') as payload_digest from p),
best as (select *, max(page_id) over (partition by payload_digest, payload_bytes) as keep from d)
select page_id, payload_bytes, payload_digest, case when page_id is distinct from keep and keep is not null then 'revisit' else 'response' end as record_type,
       case when page_id is distinct from keep then keep end as refers_to
from best"""

# rates of the given tables are below 32, so one draw gives a row's copies
_OP5 = f"""
with recursive sizes as (select source, sum(coalesce(strlen(text), 0) + 1)::double as size from documents group by source),
rates as (select source, sqrt(size) / (select sum(sqrt(size)) from sizes) * (select sum(size) from sizes) / size as rate from sizes),
below as (
    select source, rate, 0 as i, exp(-rate) as p, exp(-rate) as upto from rates
    union all
    select source, rate, i + 1, p * rate / (i + 1), upto + p * rate / (i + 1) from below where i < ceil(rate + 12 * sqrt(rate) + 20)),
numbers as (select *, ({_H60.format("'42|' || coalesce(doc_id::varchar, 'null') || '|0'")} >> 8) / 4503599627370496.0 as u from documents),
drawn as (
    select n.doc_id, any_value(n.text) as text, any_value(n.lang) as lang, any_value(n.source) as source, any_value(n.n_chars) as n_chars, any_value(rate) as rate,
           count(*) filter (where u >= upto and i < ceil(rate + 12 * sqrt(rate) + 20)) as copies
    from numbers n join below b on n.source is not distinct from b.source group by n.doc_id)
select doc_id, text, lang, source, n_chars, round(rate, 9) as rate, copy::int as copy,
       {_H60.format("'order42|' || coalesce(doc_id::varchar, 'null') || '|' || copy::varchar")} as shuffle_key
from (select *, unnest(range(copies)) as copy from drawn) x"""

_ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""


def _found(kind: str, number: int, pattern: str, group: int, least: int) -> str:
    return f"""select doc_id, '{kind}' as kind, {number} as no, {least} as least, regexp_split_to_array(t, '{pattern}') as gaps,
        regexp_extract_all(t, '{pattern}', 0) as whole, regexp_extract_all(t, '{pattern}', {group}) as counted from x"""


_OP7 = f"""
with x as (select doc_id, coalesce(text, '') as t from documents),
found as ({" union all ".join([_found("assign", 0, _ASSIGN, 2, 6), _found("access", 1, "AKIA[A-Z0-9]+", 0, 20), _found("hex", 2, "[0-9a-f]+", 0, 24)])}),
each as (select *, unnest(range(1, len(whole) + 1)) as i from found where len(list_filter(counted, lambda c: length(c) >= least)) > 0),
spans as (
    select doc_id, kind, no, list_sum(list_transform(gaps[1:i], lambda v: length(v))) + coalesce(list_sum(list_transform(whole[1:i - 1], lambda v: length(v))), 0) as s,
           length(whole[i]) as n from each where length(counted[i]) >= least),
texts as (
    select doc_id, string_agg(kind || ':' || s::bigint || ':' || (s + n)::bigint, ',' order by s, no) as spans, count(*) filter (where no = 0) as a,
           count(*) filter (where no = 1) as b, count(*) filter (where no = 2) as c from spans group by doc_id)
select x.doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex, sha256(coalesce(spans, '')) as base_sha256, coalesce(spans, '') as spans
from x left join texts on x.doc_id = texts.doc_id"""

_OP9 = r"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as w from documents),
s as (
    select doc_id, case when len(w) >= 5 then list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
                        when len(w) > 0 then [array_to_string(w, ' ')] else [] end as grams from w),
g as (select doc_id, len(grams) as n, unnest(grams) as gram from s),
links as (
    select a.doc_id as a, b.doc_id as b from g a join g b on a.gram = b.gram and a.doc_id <> b.doc_id
    group by a.doc_id, b.doc_id, a.n, b.n having 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach as (select a, b from links union select r.a, l.b from reach r join links l on r.b = l.a),
lowest as (select a, min(b) as low from reach group by a)
select s.doc_id, len(grams) as n_shingles, least(s.doc_id, coalesce(low, s.doc_id)) as component_id from s left join lowest on s.doc_id = lowest.a"""

_STEPS = """select list_transform(range(256), lambda n: list_reduce(list_prepend(n, [1, 1, 1, 1, 1, 1, 1, 1]),
           lambda c, one: case when c & 1 = 1 then xor(3988292384, c >> 1) else c >> 1 end)) as steps"""

# edits of one row as (state, initial of the row, letter, state behind it), and rows inserted behind it; the least
# (cost, audit) of every state is carried from row to row
_OP11 = rf"""
with recursive raw as (
    select conv_id, turn, coalesce(role, ' ') as role, coalesce(text, ' ') as text, coalesce(conv_id::varchar, ' ') || ':' || coalesce(turn::varchar, ' ') as key from conversations),
crc_steps as ({_STEPS}),
kinds as (
    select key, xor(4294967295, list_reduce(list_prepend(4294967295::bigint, list_transform(regexp_extract_all(hex(encode(key)), '..'), lambda b: ('0x' || b)::bigint)),
           lambda c, b: xor(steps[(xor(c, b) & 255) + 1], c >> 8))) % 20 as kind
    from (select distinct key from raw) x, crc_steps),
damaged as (
    select conv_id, turn, case when kind = 4 then 'user' else role end as role,
           case kind when 1 then '' when 2 then regexp_replace(text, '[.!?]', '', 'g') else text end as text, unnest(range(case when kind = 3 then 2 else 1 end)) as copy
    from raw join kinds using (key) where kind <> 0),
placed as (
    select *, rtrim(text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) as solid,
           row_number() over (partition by conv_id order by turn nulls first, role, sha256(length(role)::varchar || ':' || role || ':' || text), copy) as i from damaged),
rows_of as (
    select *, left(role, 1) as initial, case when solid = '' then 'b' when row_number() over (partition by conv_id, role, text order by i) > 1 then 'd'
           when right(solid, 1) in ('.', '!', '?') then '' else 't' end as fault,
           lag(left(role, 1)) over (partition by conv_id order by i) || left(role, 1) as step from placed),
go(state, initial, upto) as (values ('', 's', 's'), ('', 'u', 'u'), ('s', 'u', 'u'), ('a', 'u', 'u'), ('u', 'a', 'a')),
inserts(state, upto, letters, price, added) as (values
    ('', '', '', 0, ''), ('s', 's', '', 0, ''), ('u', 'u', '', 0, ''), ('a', 'a', '', 0, ''), ('', 'u', 'I', 5, chr(10) || 'user:'), ('s', 'u', 'I', 5, chr(10) || 'user:'),
    ('a', 'u', 'I', 5, chr(10) || 'user:'), ('u', 'a', 'I', 5, chr(10) || 'assistant:'), ('', 'a', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:'),
    ('s', 'a', 'II', 10, chr(10) || 'user:' || chr(10) || 'assistant:')),
walk as (
    select conv_id, 0::bigint as i, upto as state, struct_pack(cost := price, audit := letters, said := added) as best
    from (select distinct conv_id from placed) x, inserts where state = ''
    union all
    select conv_id, i, state, min(best) as best from (
        select e.conv_id, e.i, n.upto as state, struct_pack(cost := e.cost + n.price, audit := e.audit || n.letters, said := e.said || n.added) as best
        from (
            select r.conv_id, r.i, w.state, w.best.cost + 2 as cost, w.best.audit || 'D' as audit, w.best.said as said
            from walk w join rows_of r on w.conv_id is not distinct from r.conv_id and r.i = w.i + 1
            union all
            select r.conv_id, r.i, g.upto, w.best.cost + case when r.fault = 't' then 5 else 0 end + case when r.initial = g.initial then 0 else 1 end,
                   w.best.audit || case when r.initial = g.initial then 'K' else 'R' end,
                   w.best.said || chr(10) || case when r.initial = g.initial then r.role when g.initial = 'u' then 'user' else 'assistant' end || ':' || r.text
            from walk w join rows_of r on w.conv_id is not distinct from r.conv_id and r.i = w.i + 1 join go g on g.state = w.state
            where r.fault not in ('b', 'd') and (r.initial = g.initial or g.initial <> 's')) e
        join inserts n on n.state = e.state) c
    group by conv_id, i, state),
counts as (
    select conv_id, max(i) as n, coalesce(max(turn) - min(turn) + 1 - count(distinct turn), 0) as gaps, count(*) filter (where fault = 'b') as blank,
           count(*) filter (where fault = 'd') as duplicate, count(*) filter (where fault = 't') as truncated,
           count(*) filter (where i > 1 and step not in ('su', 'ua', 'au')) as illegal from rows_of group by conv_id),
ends as (
    select w.conv_id, min(w.best) as best from walk w join counts c on w.conv_id is not distinct from c.conv_id and w.i = c.n where w.state in ('', 'a') group by w.conv_id)
select x.conv_id, coalesce(gaps, 0)::bigint as gaps, coalesce(blank, 0)::bigint as blank, coalesce(duplicate, 0)::bigint as duplicate, coalesce(truncated, 0)::bigint as truncated,
       coalesce(illegal, 0)::bigint as illegal, coalesce(e.best.cost, 0)::bigint as cost, coalesce(e.best.audit, '') as audit, sha256(coalesce(substr(e.best.said, 2), '')) as repaired_sha256
from (select distinct conv_id from conversations) x left join counts c on x.conv_id is not distinct from c.conv_id left join ends e on x.conv_id is not distinct from e.conv_id"""

_OP12 = r"""
with d as (select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents),
grams as (
    select doc_id, unnest(list_transform(range(1, len(w) - 11), lambda i: array_to_string(w[i:i + 12], ' '))) as gram, unnest(range(1, len(w) - 11)) as i from d),
again as (select doc_id, i from (select doc_id, i, min(doc_id) over (partition by gram) as low from grams) x where low < doc_id),
gone as (select distinct doc_id, unnest(range(i, i + 13)) as i from again),
words as (select doc_id, unnest(w) as word, unnest(range(1, len(w) + 1)) as i from d),
kept as (select doc_id, string_agg(word, ' ' order by i) as kept, count(*) as n from words anti join gone using (doc_id, i) group by doc_id)
select d.doc_id, len(w)::bigint as n_words, (len(w) - coalesce(n, 0))::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256 from d left join kept using (doc_id)"""

_OP13 = r"""
with d as (
    select doc_id, coalesce(text, '') as t, regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') as u,
           sha256('42:' || coalesce(doc_id::varchar, '')) as h from documents),
draws as (select *, len(u)::bigint as n, [('0x' || substr(h, 1 + 8 * i, 8))::bigint for i in range(4)] as r from d),
cuts as (
    select *, least(r[1] % (n + 1), r[2] % (n + 1)) as a, greatest(r[1] % (n + 1), r[2] % (n + 1)) as b,
           case when t = '' or contains(t, '<P>') or contains(t, '<S>') or contains(t, '<M>') or r[3] % 100 >= 50 then 'plain' when r[4] % 100 < 80 then 'spm' else 'psm' end as form
    from draws),
parts as (
    select *, coalesce(array_to_string(u[1:a], ''), '') as pre, coalesce(array_to_string(u[a + 1:b], ''), '') as mid, coalesce(array_to_string(u[b + 1:n], ''), '') as suf from cuts)
select doc_id, n, form, case when form <> 'plain' then length(pre)::bigint end as prefix_chars, case when form <> 'plain' then length(mid)::bigint end as middle_chars,
       sha256(case form when 'plain' then t when 'spm' then '<S>' || suf || '<P>' || pre || '<M>' || mid else '<P>' || pre || '<S>' || suf || '<M>' || mid end) as output_sha256,
       sha256(t) as restored_sha256
from parts"""

ORACLES = {
    "op2_histogram_shards": _OP2, "op3_binary_codes": _OP3, "op4_warc_index": _OP4, "op5_poisson_mix": _OP5, "op7_secret_ledger": _OP7,
    "op9_signature_join": _OP9, "op11_run_length_repair": _OP11, "op12_super_kmers": _OP12, "op13_fill_in_middle": _OP13,
}
