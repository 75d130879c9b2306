"""SQL of the operators that SQL can express, for DuckDB."""

from __future__ import annotations

PHRASES = r"""
with pieces as (
    select coalesce(lang, 'und') as lang, unnest(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) as piece
    from documents
), lists as (
    select lang, row_number() over () as id, regexp_extract_all(piece, '[^\x20\x09]+') as ws from pieces
), words as (
    select lang, id, unnest(ws) as w, generate_subscripts(ws, 1) as i from lists
), runs as (
    select lang, w as w1, lead(w, 1) over (partition by id order by i) as w2, lead(w, 2) over (partition by id order by i) as w3 from words
), f1 as (select lang, w1, count(*) as f from runs group by all
), f2 as (select lang, w1, w2, count(*) as f from runs where w2 is not null group by all
), f3 as (select lang, w1, w2, w3, count(*) as f from runs where w3 is not null group by all
), totals as (select lang, sum(f) as n from f1 group by lang
), long as (
    select t.lang, t.w1, t.w2, t.w3, t.f as a, x.f as l1, yz.f as r1, xy.f as l2, z.f as r2
    from f3 t
    join f1 x on x.lang = t.lang and x.w1 = t.w1
    join f1 z on z.lang = t.lang and z.w1 = t.w3
    join f2 xy on xy.lang = t.lang and xy.w1 = t.w1 and xy.w2 = t.w2
    join f2 yz on yz.lang = t.lang and yz.w1 = t.w2 and yz.w2 = t.w3
    where t.f >= 10
), gone as (
    select lang, w1, w2 from long where 100 * a >= 50 * l2 union select lang, w2, w3 from long where 100 * a >= 50 * r1
), candidates as (
    select lang, w1 || ' ' || w2 || ' ' || w3 as phrase, a, l1, r1, l2, r2 from long
    union all
    select t.lang, t.w1 || ' ' || t.w2, t.f, x.f, y.f, null, null
    from f2 t
    join f1 x on x.lang = t.lang and x.w1 = t.w1
    join f1 y on y.lang = t.lang and y.w1 = t.w2
    where t.f >= 10 and not exists (select 1 from gone g where g.lang = t.lang and g.w1 = t.w1 and g.w2 = t.w2)
), scored as (
    select *, (1000000::hugeint * a * a) // (l1::hugeint * r1) as s1, (1000000::hugeint * a * a) // (l2::hugeint * r2) as s2 from candidates
), chosen as (
    select lang, phrase, a, case when s2 < s1 then l2 else l1 end as l, case when s2 < s1 then r2 else r1 end as r, case when s2 < s1 then s2 else s1 end as score from scored
), ranked as (
    select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from chosen
)
select lang, rank::bigint as rank, phrase, a::bigint as a, l::bigint as l, r::bigint as r, n::bigint as n, score::bigint as score
from ranked join totals using (lang) where rank <= 2000
"""

URLS = r"""
with located as (
    select page_id, case when strpos(url, '://') > 0 then substring(url, strpos(url, '://') + 3) else '' end as rest from pages
), places as (
    select page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from located
), judged as (
    select *, case
        when (host = 'www.example.com' or host like '%.www.example.com') and starts_with(path, '/en/') then 'www.example.com/en/'
        when (host = 'example.com' or host like '%.example.com') and starts_with(path, '/en/') then 'example.com/en/'
        when (host = 'net' or host like '%.net') and starts_with(path, '/es/') then 'net/es/'
        when (host = 'net' or host like '%.net') and starts_with(path, '/fr/') then 'net/fr/'
        when (host = 'com' or host like '%.com') and starts_with(path, '/') then 'com/' end as rule
    from places
), labels as (
    select *, case when rule in ('com/', 'www.example.com/en/') then 'allow' when rule is not null then 'block' end as says from judged
), addresses as (
    select host, path, count(*) as n, count(says) as labelled, count(*) filter (says = 'block') as rejected from labels group by host, path
), named as (
    select *, list_filter(string_split(path, '/'), lambda x: x <> '') as names from addresses
), typed as (
    select *, list_transform(list_transform(names, lambda s: regexp_replace(s, '\.[A-Za-z]{2,5}$', '')), lambda s: case
        when regexp_matches(s, '^[0-9][0-9_.-]*$') then 'number' when regexp_matches(s, '^[0-9a-fA-F-]{8,}$') then 'hex' when regexp_matches(s, '[0-9]') then 'mixed'
        when regexp_matches(s, '[^-_]+[-_][^-_]+[-_][^-_]+[-_]') then 'slug' else 'word' end) as kinds
    from named
), opened as (
    select host, path, n, labelled, rejected, kinds, unnest(names) as segment, generate_subscripts(names, 1) as depth from typed
), steps as (
    select host, path, n, labelled, rejected, segment, depth, array_to_string(kinds[1:depth], '/') as node, kinds[depth] as kind from opened
), words as (
    select host, node, segment, sum(n) as n, sum(labelled) as labelled, sum(rejected) as rejected from steps where kind = 'word' group by all
), kept as (
    select *, case when labelled > 0 then rejected / labelled end as rate from words qualify n * 64 >= sum(n) over (partition by host, node)
), lagged as (
    select *, lag(labelled) over by_rate as l0, lag(rejected) over by_rate as r0 from kept window by_rate as (partition by host, node order by rate nulls first, segment)
), parted as (
    select *, case when l0 is null then 1 when labelled = 0 and l0 = 0 then 0 when labelled = 0 or l0 = 0 then 1
        when (rejected + r0) / (labelled + l0) in (0, 1) then 0
        when pow(rate - r0 / l0, 2) >= 3.84 * ((rejected + r0) / (labelled + l0)) * (1 - (rejected + r0) / (labelled + l0)) * (1 / labelled + 1 / l0) then 1 else 0 end as apart
    from lagged
), summed as (
    select *, sum(apart) over (partition by host, node order by rate nulls first, segment rows unbounded preceding) as branch from parted
), branches as (
    select host, node, unnest(list(segment)) as segment, string_agg(segment, '|' order by segment) as name from summed group by host, node, branch
), made as (
    select host, path, '/' || string_agg(coalesce(name, '*'), '/' order by depth) as template from steps left join branches using (host, node, segment) group by host, path
), placed as (
    select addresses.*, coalesce(template, '/') as template from addresses left join made using (host, path)
), verdicts as (
    select host, template, case when (sum(rejected) + 1) / (sum(labelled) + 2) >= 0.8 then 'block' else 'allow' end as verdict from placed group by all
)
select page_id, l.host, l.path, rule, coalesce(says, verdict) as verdict, case when rule is null then template end as template
from labels l join placed p using (host, path) join verdicts v using (host, template)
"""
