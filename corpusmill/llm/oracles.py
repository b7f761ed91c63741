"""DuckDB SQL for the queries that it can express. The others train, align, compress or encode; tests hold them to brute force."""

from __future__ import annotations

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all({0}, '[^\x20\x09-\x0D]+')"
_GRAMS = "case when len(w) = 0 then [] when len(w) < 5 then [array_to_string(w, ' ')] else list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) end"

_OP8 = f"""
with recursive d as (select doc_id, {_WORDS.format(_LOW)} as w from documents),
s as (select distinct doc_id, unnest({_GRAMS}) as g from d),
n as (select d.doc_id, count(g) as n from d left join s using (doc_id) group by 1),
c as (select a.doc_id as a, b.doc_id as b, count(*) as c from s a join s b using (g) where a.doc_id < b.doc_id group by all),
e as (select a, b from c join n x on x.doc_id = a join n y on y.doc_id = b where 100 * c >= 75 * (x.n + y.n - c)),
sym as (select a, b from e union all select b, a from e),
r as (select doc_id as id, doc_id as r from d union select r.id, sym.b from r join sym on r.r = sym.a)
select n.doc_id, n.n as n_shingles, min(r.r) as component_id from n join r on r.id = n.doc_id group by n.doc_id, n.n
"""

_OP9 = rf"""
with l as (select doc_id, text, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from documents),
d as (select doc_id, i, {_WORDS.format(_LOW.replace("text", "line"))} as w from l),
b as (select distinct doc_id, i, 's' as kind, unnest({_GRAMS}) as g from d where len(w) >= 12 union all select distinct doc_id, i, 'w', unnest(w) from d where len(w) <= 16),
s as (select *, count(*) over (partition by doc_id, i, kind) as n from b),
c as (select a.doc_id, a.i, b.doc_id as od, b.i as oi, kind, any_value(a.n) as x, any_value(b.n) as y, count(*) as c from s a join s b using (kind, g) where (b.doc_id < a.doc_id or (b.doc_id = a.doc_id and b.i < a.i)) and 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n) group by all),
gone as (select distinct doc_id, i from c where 4 * c >= 3 * (x + y - c)),
k as (select l.doc_id, any_value(l.text) as text, count(gone.i) as m, string_agg(l.line, chr(10) order by l.i) filter (gone.i is null) as kept from l left join gone on gone.doc_id = l.doc_id and gone.i = l.i group by 1)
select doc_id, case when m = 0 then text when regexp_matches(coalesce(kept, ''), '[^\x20\x09-\x0D]') then kept else '' end as text, m as n_lines_removed from k
"""

_OP10 = """
with recursive v as (select vec_id, embedding::double[] as e from embeddings),
p as (select a.vec_id as a, b.vec_id as b from v a join v b on a.vec_id <> b.vec_id where list_cosine_similarity(a.e, b.e) >= 0.9),
r as (select vec_id as id, vec_id as r from v union select r.id, p.b from r join p on r.r = p.a),
c as (select id, min(r) as component_id from r group by 1)
select vec_id, (select count(*) from p where a = vec_id) as n_links, component_id, component_id = vec_id as kept from v join c on c.id = vec_id
"""

_KINDS = (
    ("assign", 0, r"""(?i)(password|passwd|secret|token|api_?key)["''']?\x20*[:=]\x20*["''']?([A-Za-z0-9+/_.=-]+)""".replace("'''", "''"), 2, 8),
    ("access", 1, "AKIA[A-Z0-9]+", 0, 16),
    ("hex", 2, "[0-9a-f]{32,}", 0, 32),
    ("pem", 3, "-----BEGIN [A-Z ]*PRIVATE KEY-----", 0, 1),
    ("jwt", 4, r"eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+", 0, 30),
)
_FIND = " union all ".join(
    f"""select doc_id, '{kind}' as kind, {rank} as rank, unnest(list_transform(range(1, len(h) + 1), lambda i: {{'s': list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0), 'l': length(h[i]), 'm': length(g[i])}})) as x, {least} as least
from (select doc_id, regexp_split_to_array(t, '{pattern}') as p, regexp_extract_all(t, '{pattern}') as h, regexp_extract_all(t, '{pattern}', {group}) as g from d where regexp_matches(t, '{pattern}'))"""
    for kind, rank, pattern, group, least in _KINDS
)
_OP6 = f"""
with d as (select doc_id, coalesce(text, '') as t from documents), f as ({_FIND}),
k as (select doc_id, kind, rank, x.s::bigint as s, (x.s + x.l)::bigint as e from f where x.m >= least),
o as (select doc_id, count(*) filter (kind = 'assign') as a, count(*) filter (kind = 'access') as b, count(*) filter (kind = 'hex') as c,
string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) filter (rank < 3) as base, string_agg(kind || ':' || s || ':' || e, ',' order by s, rank) as spans from k group by 1)
select doc_id, coalesce(a, 0) as n_assign, coalesce(b, 0) as n_access, coalesce(c, 0) as n_hex, sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans from d left join o using (doc_id)
"""

_OP11 = r"""
with d as (select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as t from documents)
select doc_id, min(doc_id) over w as keep_id, count(*) over w as group_size, row_number() over (partition by t order by doc_id nulls last) = 1 as kept, sha256(t) as text_sha256
from d window w as (partition by t)
"""

_OP12 = rf"""
with d as (select row_number() over () as row, coalesce(lang, '') as lang, coalesce(source, '') as source, {_LOW} as t from documents),
w as (select row, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) as term from d),
k as (select lang, term, count(*) as n from w group by all having count(distinct row) >= 3),
c as (select lang, source, term, count(*) as n from w group by all),
g as (select distinct lang, source from d),
v as (select lang, count(*) as v, sum(n)::bigint as total from k group by 1),
t as (select g.lang, g.source, coalesce(any_value(v.v), 0) as v, coalesce(sum(c.n) filter (k.term is not null), 0)::bigint as total
from g left join v using (lang) left join c on c.lang = g.lang and c.source = g.source left join k on k.lang = c.lang and k.term = c.term group by 1, 2),
p as (select t.lang, t.source, k.term, coalesce(c.n, 0) as n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (t.total + t.v) as p, 1 + 1000000000 * (k.n + 1) // (v.total + v.v) as q
from t join k using (lang) join v using (lang) left join c on c.lang = t.lang and c.source = t.source and c.term = k.term),
s as (select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p)::bigint as value from p a join p b using (lang, term) where a.source <> b.source group by all),
o as (select a.lang, a.source, 'pair' as part, b.source as item, coalesce(s.value, 0) as value from g a join g b on a.lang = b.lang and a.source <> b.source
left join s on s.lang = a.lang and s.source = a.source and s.item = b.source
union all select lang, source, 'term', term, (p - q) * (p - q) // q from p where n > 0 and p > q),
r as (select *, row_number() over (partition by lang, source, part order by value desc, item)::int as rank from o)
select lang, source, part, item, value, rank from r where part = 'pair' or rank <= 200
"""

_OP13 = rf"""
with recursive t as (select list(c order by i) as steps from (select i, list_reduce(list_concat([i::ubigint], range(8)::ubigint[]), lambda x, y: case when x % 2 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end) as c from range(256) r(i))),
r as (select doc_id, {_LOW} as x, unnest(regexp_extract_all(x, '[A-Za-z\x{{00C0}}-\x{{00FF}}]+')) as w from documents),
d as (select doc_id, w, count(*) as n from r where length(w) >= 7 group by all),
b as (select *, flatten(list_transform(string_split(coalesce(doc_id::varchar, '') || ':' || w, ''), lambda c: case when unicode(c) < 128 then [unicode(c)] else [195, unicode(c) - 64] end))::ubigint[] as s from d),
h as (select w, n, xor(list_reduce(list_concat([4294967295::ubigint], s), lambda c, y: xor(steps[((xor(c, y) & 255::ubigint) + 1)::bigint], c >> 8)), 4294967295::ubigint) as h from b, t),
e as (select case when h % 31 = 0 then w[:(h % length(w))::bigint] || w[(h % length(w))::bigint + 2:] else w end as word, n from h),
k as (select word, sum(n)::bigint as n from e where length(word) >= 7 group by 1 having sum(n) >= 2),
x as (select word, unnest(range(length(word))) as i from k),
o as (select word, i, word[:i] || word[i + 2:] as cut from x),
p as (select a.word as a, b.word as b from o a join o b using (i, cut) where a.word <> b.word and length(a.word) = length(b.word)
union select o.word, k.word from o join k on k.word = o.cut union select k.word, o.word from o join k on k.word = o.cut),
m as (select p.a as word, k.word as near, k.n, row_number() over (partition by p.a order by k.n desc, k.word) as rank, count(*) over (partition by p.a) as n_near from p join k on k.word = p.b),
f as (select k.word, k.n, coalesce(m.n_near, 0) as n_near, case when m.n >= 10 * k.n then m.near end as form, case when m.n >= 10 * k.n then m.n end as form_n from k left join m on m.word = k.word and m.rank = 1),
z as (select word, word as root from f union all select z.word, f.form from z join f on f.word = z.root where f.form is not null),
y as (select z.word, z.root from z join f on f.word = z.root where f.form is null)
select word, form, root, n, n_near, form_n from f join y using (word)
"""

ORACLES: dict[str, str] = {"op6_secret_ledger": _OP6, "op8_jaccard_join": _OP8, "op9_line_dedup": _OP9, "op10_lattice_neardup": _OP10, "op11_exact_dedup": _OP11, "op12_source_divergence": _OP12, "op13_spelling_variants": _OP13}
