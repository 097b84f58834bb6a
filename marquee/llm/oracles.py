"""DuckDB SQL of the registered queries, written apart from the Spark code."""
from __future__ import annotations

SPACE = "chr(32)||chr(9)||chr(10)||chr(11)||chr(12)||chr(13)"
AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

#: {docs}: a relation with doc_id and text. One row per document: doc_id, n_lines, n_dropped, kept_text.
LINE_DEDUP_CTE = f"""
ld_lines as (
  select doc_id, t.i as pos, t.line as line, translate(trim(t.line, {SPACE}), {AZ}) as k
  from (select doc_id, unnest(list_zip(range(1, 1 + len(string_split(coalesce(text, ''), chr(10)))),
                                       string_split(coalesce(text, ''), chr(10)))) as z from {{docs}}) x,
       lateral (select x.z[1] as i, x.z[2] as line) t),
ld_bad as (
  select k, max(doc_id) as keep_id from ld_lines where length(k) >= 40 group by k having count(distinct doc_id) >= 5),
ld_marked as (
  select l.doc_id, l.pos, l.line, b.k is not null and l.doc_id <> b.keep_id as gone
  from ld_lines l left join ld_bad b on l.k = b.k),
ld_out as (
  select doc_id, count(*)::bigint as n_lines, count(*) filter (where gone)::bigint as n_dropped,
         coalesce(string_agg(line, chr(10) order by pos) filter (where not gone), '') as kept_text
  from ld_marked group by doc_id)"""

LINE_DEDUP = f"""with {LINE_DEDUP_CTE.format(docs='documents')}
select doc_id, n_lines, n_dropped, sha256(kept_text) as kept_sha256 from ld_out"""

#: {docs}: doc_id, text, source. One row per document: doc_id, size, source, source_size, target, whole, extra.
MIXING_CTE = r"""
mx_sized as (
  select doc_id, source, md5('mix-1:' || coalesce(doc_id::varchar, 'null') || ':' || md5(coalesce(text, ''))) as key,
         len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::bigint as size from {docs}),
mx_src as (
  select source, sum(size)::bigint as source_size,
         [3, 1, 2][1 + ((row_number() over (order by source is null, source) - 1) % 3)::int] as w
  from mx_sized group by source),
mx_tot as (select 1.5 * sum(source_size)::double as t, sum(w)::double as w from mx_src),
mx_ord as (
  select *, 2 * source_size as cap, row_number() over o as j,
         sum(2 * source_size) over (o rows unbounded preceding)::double as ccap, sum(w) over (o rows unbounded preceding)::double as cw
  from mx_src window o as (order by 2.0 * source_size / w, source is null, source)),
mx_cand as (
  select 0 as j, t / w as level from mx_tot
  union all select o.j, (t.t - o.ccap) / (t.w - o.cw) from mx_ord o, mx_tot t where t.w > o.cw),
mx_level as (
  select c.level from mx_cand c join mx_ord n on n.j = c.j + 1 where n.cap > n.w * c.level order by c.j limit 1),
mx_target as (
  select s.source, s.source_size,
         case when l.level is null or 2 * s.source_size <= s.w * l.level then (2 * s.source_size)::double else s.w * l.level end as target
  from mx_src s left join mx_level l on true),
mx_rate as (
  select *, case when source_size > 0 then floor(target / source_size)::bigint else 0 end as whole from mx_target),
mx_run as (
  select d.doc_id, d.source, d.size, r.source_size, r.target, r.whole, round(r.target - r.whole * r.source_size)::bigint as rest,
         sum(d.size) over (partition by d.source order by d.key, d.doc_id rows unbounded preceding) - d.size as ahead
  from mx_sized d join mx_rate r on d.source is not distinct from r.source),
mx_out as (
  select *, greatest(0, least(size, rest - ahead))::bigint as extra from mx_run)"""

MIXING = f"""with {MIXING_CTE.format(docs='documents')}
select doc_id, size, source_size, target, (whole * size + extra)::bigint as taken from mx_out"""

_ASSIGN = (r"""([pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|"""
           r"""[aA][pP][iI]_?[kK][eE][yY])[""'']?\x20*[:=]\x20*[""'']?([A-Za-z0-9+/_.=-]+)""").replace('""', '"')


def _kind(name: str, order: int, pattern: str, group: int, least: int) -> str:
    return f"""
  select doc_id, source, '{name}' as kind, {order} as nth_kind, e - l as s, e, v from (
    select doc_id, source, z[1] as g, length(z[2]) as l, z[3] as v,
           sum(length(z[1]) + length(z[2])) over (partition by doc_id order by nth) as e
    from (select doc_id, source, generate_subscripts(zs, 1) as nth, unnest(zs) as z from (
      select doc_id, source, list_zip(regexp_split_to_array(text, '{pattern}')[1:len(regexp_extract_all(text, '{pattern}', 0))],
                      regexp_extract_all(text, '{pattern}', 0), regexp_extract_all(text, '{pattern}', {group})) as zs
      from documents where regexp_matches(text, '{pattern}')))) where length(v) >= {least}"""


SECRET_SCANS = f"""with ss_found as ({_kind('assign', 0, _ASSIGN, 2, 6)}
  union all {_kind('access', 1, 'AKIA[A-Z0-9]+', 0, 20)}
  union all {_kind('hex', 2, '[0-9a-f]+', 0, 24)}),
ss_owned as (
  select v, count(distinct coalesce(source, '')) as owners from ss_found group by v),
ss_live as (
  select distinct f.doc_id, 'live' as kind, 3 as nth_kind, f.e - length(f.v) as s, f.e
  from ss_found f join ss_owned o on f.v = o.v
  where o.owners <= 1 and regexp_matches(f.v, '[0-9]') and regexp_matches(f.v, '[A-Za-z]')
    and len(list_distinct(regexp_extract_all(f.v, '.'))) >= least(8, length(f.v) - 1)
    and not regexp_matches(lower(f.v), '(^|[^a-z0-9])(example|placeholder|changeme|change_me|dummy|sample|your|x{{4,}}|0{{4,}}|1234[0-9]*)([^a-z0-9]|$)')
    and not regexp_matches(lower(f.v), '^(example|placeholder|changeme|dummy|sample)')),
ss_all as (
  select doc_id, kind, nth_kind, s, e, true as base from ss_found
  union all select doc_id, kind, nth_kind, s, e, false from ss_live),
ss_doc as (
  select doc_id, count(*) filter (where kind = 'assign') as n_assign, count(*) filter (where kind = 'access') as n_access,
         count(*) filter (where kind = 'hex') as n_hex,
         string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, nth_kind) filter (where base) as base,
         string_agg(kind || ':' || s::bigint || ':' || e::bigint, ',' order by s, nth_kind) as spans
  from ss_all group by doc_id)
select d.doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from documents d left join ss_doc s on d.doc_id = s.doc_id"""

#: SHA-1 as 160 bits from DuckDB's hexadecimal digits, then 32 groups of 5 bits.
_NIBBLES = ", ".join(f"'{i:04b}'" for i in range(16))
_GROUP = " + ".join(f"{16 >> j} * substr(bits, 1 + 5 * i + {j}, 1)::int" for j in range(5))
WARC = f"""with w as (
  select page_id, coalesce(html, '') as payload from pages),
p as (select payload, min(page_id) as first_id from w group by payload),
h as (
  select w.page_id, strlen(w.payload)::bigint as payload_bytes, p.first_id,
         list_aggregate([([{_NIBBLES}])[strpos('0123456789abcdef', substr(sha1(w.payload), 1 + i, 1))] for i in range(40)], 'string_agg', '') as bits
  from w join p on w.payload = p.payload)
select page_id, payload_bytes,
       list_aggregate([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (1 + {_GROUP})::int, 1) for i in range(32)], 'string_agg', '') as payload_digest,
       case when page_id = first_id then 'response' else 'revisit' end as record_type,
       case when page_id = first_id then null else first_id end as refers_to
from h"""

TOP_K = """with tk as (
  select row_number() over () as rid, vec_id, [floor(256 * x::double)::bigint for x in embedding] as v from embeddings
  where embedding is not null and vec_id is not null
    and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
tk_pairs as (
  select q.rid, q.vec_id as query_id, c.vec_id, list_inner_product(q.v::double[], c.v::double[])::bigint as score
  from tk q join tk c on q.vec_id % 50 = 0 and q.rid <> c.rid and len(q.v) = len(c.v))
select query_id, rank::int as rank, vec_id, score
from (select *, row_number() over (partition by rid order by score desc, vec_id) as rank from tk_pairs) where rank <= 5"""

#: Ten rounds, one after the other; a row's number tells repeated rows apart.
_NEAREST = """select rid, min([d, c::bigint]) as best from (
    select rid, c, list_sum([(x.v[i] - s.v[i]) * (x.v[i] - s.v[i]) for i in range(1, 65)])::bigint as d from kc x, kc_s{r} s) group by rid"""
_ROUND = """kc_n{r} as materialized ({nearest}),
kc_m{r} as (
  select c, list(((s - ((s % n) + n) % n) // n)::bigint order by i) as v
  from (select best[2] as c, i, sum(v[i]) as s, count(*) as n from kc join kc_n{r} using (rid), range(1, 65) t(i) group by all) group by c),
kc_s{next} as materialized (select s.c, coalesce(m.v, s.v) as v from kc_s{r} s left join kc_m{r} m on s.c = m.c),"""
CLUSTERS = """with kc as materialized (
  select row_number() over () as rid, vec_id, [floor(1024 * x::double)::bigint for x in embedding] as v from embeddings
  where embedding is not null and len(embedding) = 64 and len([x for x in embedding if x is null or not isfinite(x)]) = 0),
kc_s0 as materialized (
  select * from (select row_number() over (order by sha256('3:' || vec_id), v) - 1 as c, v from kc where vec_id is not null) where c < 8),
""" + "\n".join(_ROUND.format(r=r, next=r + 1, nearest=_NEAREST.format(r=r)) for r in range(10)) + f"""
kc_l as materialized ({_NEAREST.format(r=10)})
select vec_id, best[2]::int as cluster, best[1] as distance, (sum(best[1]) over (partition by best[2]))::bigint as cluster_inertia,
       (sum(best[1]) over ())::bigint as inertia, sha256(array_to_string(s.v, ',')) as centroid_sha256
from kc_l join kc using (rid) join kc_s10 s on s.c = best[2]"""
