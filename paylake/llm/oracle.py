"""SQL twins of the operators' queries, for the tables of the test data."""

from __future__ import annotations

SHA = "sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'))"

EXACT = f"""
with h as (select doc_id, {SHA} as text_sha256 from documents),
g as (select text_sha256, max(doc_id) as keep_id, count(*) as group_size from h group by text_sha256)
select doc_id, keep_id, group_size, doc_id is not distinct from keep_id as kept, text_sha256
from h join g using (text_sha256)
"""

# Sources in turn weigh 1, 2, 3; those whose limit (3 times the size) per weight is lowest keep it.
# Then whole copies, and of the rest the documents below a place of 30 bits of the id's md5.
MIXING = r"""
with recursive sized as (
    select doc_id, source, len(list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')) as size,
           cast('0x' || substr(md5(coalesce(cast(doc_id as varchar), 'null')), 1, 8) as bigint) >> 2 as place
    from documents),
sources as (select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighed as (select *, (row_number() over (order by source is null, encode(source)) - 1) % 3 + 1 as weight from sources),
total as (select cast(sum(size) as bigint) as t from sized),
held(round, source, capped) as (
    select 0, source, false from weighed
    union all
    select h.round + 1, h.source, h.capped or (
        w.weight * (t - (select coalesce(sum(3 * x.source_size), 0) from held y join weighed x on x.source is not distinct from y.source where y.capped))
        > 3 * w.source_size * (select sum(x.weight) from held y join weighed x on x.source is not distinct from y.source where not y.capped))
    from held h join weighed w on w.source is not distinct from h.source cross join total where h.round < (select count(*) from weighed)),
last as (select source, capped from held where round = (select max(round) from held)),
goal as (
    select w.source, w.source_size, case when l.capped then cast(3 * w.source_size as double) else
        cast(w.weight * (t - (select coalesce(sum(3 * x.source_size), 0) from last y join weighed x on x.source is not distinct from y.source where y.capped)) as double)
        / (select cast(sum(x.weight) as double) from last y join weighed x on x.source is not distinct from y.source where not y.capped) end as target
    from weighed w join last l on w.source is not distinct from l.source cross join total),
budget as (
    select *, case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end as whole,
           target - (case when source_size > 0 then cast(floor(target / source_size) as bigint) else 0 end) * source_size as rest from goal),
places as (
    select source, place, sum(sum(size)) over (partition by source order by place) as until,
           sum(sum(size)) over (partition by source order by place) - sum(size) as before
    from sized group by source, place),
edge as (
    select b.source, max(case when p.until <= b.rest or (p.before <= b.rest and p.until > b.rest and p.until - b.rest < b.rest - p.before) then p.place end) as last_place
    from budget b join places p on b.source is not distinct from p.source group by b.source)
select s.doc_id, s.size, b.source_size, b.target,
       cast(s.size * (b.whole + case when b.rest > 0 and s.place <= e.last_place then 1 else 0 end) as bigint) as taken
from sized s join budget b on s.source is not distinct from b.source left join edge e on s.source is not distinct from e.source
"""

EMBEDDINGS = """
with recursive clean as (
    select vec_id, label, list_transform(embedding, lambda v: cast(v as double)) as e from embeddings
    where vec_id is not null and label is not null and len(embedding) > 0
      and len(list_filter(embedding, lambda v: v is null or isnan(v) or isinf(v))) = 0
      and len(list_filter(embedding, lambda v: v <> 0)) > 0),
links as (
    select a.vec_id as a, b.vec_id as b from clean a join clean b
    on a.label = b.label and len(a.e) = len(b.e) and a.vec_id <> b.vec_id
    where list_inner_product(a.e, b.e) / (sqrt(list_inner_product(a.e, a.e)) * sqrt(list_inner_product(b.e, b.e))) >= 0.98),
reach(v, r) as (
    select distinct a, a from links
    union
    select r.v, l.b from reach r join links l on l.a = r.r),
first as (select v, min(r) as component_id from reach group by v),
degree as (select a, count(*) as n_links from links group by a)
select e.vec_id, coalesce(d.n_links, 0) as n_links, coalesce(f.component_id, e.vec_id) as component_id,
       e.vec_id is not distinct from coalesce(f.component_id, e.vec_id) as kept
from embeddings e left join degree d on d.a = e.vec_id left join first f on f.v = e.vec_id
"""

JACCARD = r"""
with recursive words as (
    select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[\x20\x09-\x0D]+'), lambda x: x <> '') as w from documents),
shingles as (
    select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 4 then [array_to_string(w, ' ')]
        else list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' ')) end) as s from words),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
links as (
    select x.doc_id as a, y.doc_id as b from shingles x join shingles y on x.s = y.s and x.doc_id <> y.doc_id
    join sizes p on p.doc_id = x.doc_id join sizes q on q.doc_id = y.doc_id
    group by x.doc_id, y.doc_id, p.n, q.n having 100 * count(*) >= 85 * (p.n + q.n - count(*))),
reach(v, r) as (
    select distinct a, a from links
    union
    select r.v, l.b from reach r join links l on l.a = r.r),
first as (select v, min(r) as component_id from reach group by v)
select d.doc_id, coalesce(s.n, 0) as n_shingles, coalesce(f.component_id, d.doc_id) as component_id
from documents d left join sizes s on s.doc_id = d.doc_id left join first f on f.v = d.doc_id
"""


def _either_case(words: str) -> str:
    """A pattern whose letters stand for themselves in either case, ASCII alone."""
    return "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in words)


_VALUE = r"""["']?\x20*[:=]\x20*["']?"""
_PATTERNS = {
    "assign": "(" + _either_case("password|passwd|secret|token|api_?key") + ")" + _VALUE + "([A-Za-z0-9+/_.=-]+)",
    "access": "AKIA[A-Z0-9]+",
    "hex": "[0-9a-f]+",
    "user": "(" + _either_case("username|user|login|account|client_id|access_key_id") + ")" + _VALUE + "[A-Za-z0-9@._-]{3,}",
    "mixed": "[A-Za-z0-9+/]{32,}={0,2}",
    "endpoint": "(" + _either_case("http") + "[sS]?|" + _either_case("jdbc") + ":[A-Za-z0-9]+|" + _either_case("postgresql|postgres|mysql|mongodb|redis|amqp|ftp") + ")"
                + r"""://[^\x09-\x0D\x20"'<>]+""",
    "break": r"\n[ \t]*\n",
}
_KEPT = {
    "assign": "length(regexp_extract(m, p, 2)) >= 6", "access": "length(m) >= 20", "hex": "length(m) >= 24",
    "mixed": "regexp_matches(m, '[a-z]') and regexp_matches(m, '[A-Z]') and regexp_matches(m, '[0-9]')",
}


def _found(kind: str) -> str:
    pattern = _PATTERNS[kind].replace("'", "''")
    return f"""
    select r, '{kind}' as kind, list_sum(list_transform(gaps[:i], lambda g: length(g))) + coalesce(list_sum(list_transform(ms[:i - 1], lambda g: length(g))), 0) as s, length(m) as n
    from (select r, gaps, ms, unnest(ms) as m, unnest(range(1, len(ms) + 1)) as i, p from
          (select r, string_split_regex(text, '{pattern}') as gaps, regexp_extract_all(text, '{pattern}') as ms, '{pattern}' as p from docs))
    where {_KEPT.get(kind, 'true')}"""


# Parts of the weak kinds that lie in a strong one are left out; a section ends at a blank line.
SECRETS = f"""
with docs as (select row_number() over () as r, doc_id, coalesce(text, '') as text from documents),
parts as (select r, kind, cast(s as bigint) as s, cast(s + n as bigint) as e from ({' union all '.join(map(_found, _PATTERNS))})),
strong as (select * from parts where kind in ('assign', 'access', 'hex')),
known as (
    select p.*, (select count(*) from parts b where b.r = p.r and b.kind = 'break' and b.s <= p.s) as section,
           case when kind in ('access', 'user') then 'identifier' when kind = 'endpoint' then 'endpoint' else 'secret' end as role
    from parts p where kind <> 'break' and (kind in ('assign', 'access', 'hex')
        or not exists (select 1 from strong x where x.r = p.r and x.e > p.s and (x.s < p.s or (x.s = p.s and x.kind < p.kind))))),
near as (
    select w.r, w.kind, w.s, w.e, list(distinct o.role) as roles from known w join known o
    on o.r = w.r and o.section = w.section and o.role <> w.role and abs(o.s - w.s) <= 300
    where w.kind in ('user', 'mixed', 'endpoint') group by w.r, w.kind, w.s, w.e),
shown as (
    select r, kind, s, e from strong
    union all
    select r, kind, s, e from near where (kind = 'user' and list_contains(roles, 'secret')) or (kind = 'mixed' and list_contains(roles, 'identifier'))
        or (kind = 'endpoint' and list_contains(roles, 'identifier') and list_contains(roles, 'secret'))),
told as (
    select r, count(*) filter (kind = 'assign') as n_assign, count(*) filter (kind = 'access') as n_access, count(*) filter (kind = 'hex') as n_hex,
           string_agg(kind || ':' || s || ':' || e, ',' order by s, o) filter (o <= 3) as base, string_agg(kind || ':' || s || ':' || e, ',' order by s, o) as spans
    from (select *, list_position(['assign', 'access', 'hex', 'user', 'mixed', 'endpoint'], kind) as o from shown) group by r)
select doc_id, coalesce(n_assign, 0) as n_assign, coalesce(n_access, 0) as n_access, coalesce(n_hex, 0) as n_hex,
       sha256(coalesce(base, '')) as base_sha256, coalesce(spans, '') as spans
from docs left join told using (r)
"""

# A row's score is floor(256 * x) multiplied out; labels of every seventh row move on by one.
NEGATIVES = """
with rows as (
    select distinct vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label,
           list_transform(embedding, lambda x: cast(floor(256 * cast(x as double)) as bigint)) as e from embeddings
    where vec_id is not null and label is not null and embedding is not null
      and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0),
scores as (
    select a.vec_id as anchor_id, a.label = b.label as same, b.vec_id, cast(list_sum(list_transform(list_zip(a.e, b.e), lambda p: p[1] * p[2])) as bigint) as score
    from rows a join rows b on a.vec_id <> b.vec_id and len(a.e) = len(b.e) where a.vec_id % 50 = 0),
positives as (
    select anchor_id, vec_id as positive_id, score as positive_score from scores where same
    qualify row_number() over (partition by anchor_id order by score desc, vec_id) <= 5)
select p.anchor_id, positive_id, row_number() over w as rank, s.vec_id as negative_id, positive_score, s.score as negative_score
from positives p join scores s on s.anchor_id = p.anchor_id and not s.same
where 50 * positive_score <= 100 * s.score and 100 * s.score <= 95 * positive_score
window w as (partition by p.anchor_id, positive_id order by s.score desc, s.vec_id)
qualify row_number() over w <= 3
"""


def _field(value: str) -> str:
    return f"case when {value} is null then '-' else strlen(cast({value} as varchar)) || ':' || {value} end"


_REST = " || ".join(_field(c) for c in ("doc_id", "source", "lang", "n_chars"))
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _grown(name: str, base: str, group: str) -> str:
    """A recursive tree over rows of ``base`` with pos and n, and the siblings of each of its nodes."""
    return f"""
{name}(level, {group}, pos, h, n) as (
    select 0, {group}, pos, h, n from {base}
    union all
    select level + 1, {group}, pos // 8, sha256(string_agg(h, '' order by pos)), (n + 7) // 8 from {name} where n > 1
    group by level, {group}, pos // 8, n),
{name}_siblings as (
    select level, {group}, pos,
           coalesce(string_agg(h, '') over (w rows between unbounded preceding and 1 preceding), '') as l,
           coalesce(string_agg(h, '') over (w rows between 1 following and unbounded following), '') as r
    from {name} where n > 1 window w as (partition by level, {group}, pos // 8 order by pos))"""


MERKLE = f"""
with recursive crc as (
    select list_transform(range(256), lambda i: list_reduce(range(8), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end, i)) as t),
leaves as (
    select doc_id, lang, sha256({_REST} || {_field("text")}) as h,
           case when xor(list_reduce(list_transform(string_split(cast(doc_id as varchar), ''), lambda x: cast(ascii(x) as bigint)),
                                     lambda c, b: xor(c >> 8, t[cast(xor(c, b) & 255 as bigint) + 1]), 4294967295), 4294967295) % 3 = 0
                then sha256({_REST} || {_field(_LOWERED)}) end as tampered
    from documents, crc),
placed as (
    select *, row_number() over (partition by lang order by doc_id nulls first, h) - 1 as pos, count(*) over (partition by lang) as n from leaves),
{_grown("tree", "placed", "lang")},
subroots as (
    select 0 as one, lang, h, row_number() over (order by lang nulls first) - 1 as pos, count(*) over () as n from tree where n = 1),
{_grown("forest", "subroots", "one")},
path as (
    select p.doc_id, p.lang, p.pos, s.level, s.l, s.r from placed p join tree_siblings s on s.lang is not distinct from p.lang and s.pos = p.pos // cast(pow(8, s.level) as bigint)
    union all
    select p.doc_id, p.lang, p.pos, 100 + s.level, s.l, s.r from placed p join subroots b on b.lang is not distinct from p.lang
    join forest_siblings s on s.pos = b.pos // cast(pow(8, s.level) as bigint)),
steps as (select *, row_number() over (partition by lang, pos order by level) as step from path),
folded(lang, pos, step, h) as (
    select lang, pos, 0, coalesce(tampered, h) from placed
    union all
    select f.lang, f.pos, f.step + 1, sha256(s.l || f.h || s.r) from folded f join steps s on s.lang is not distinct from f.lang and s.pos = f.pos and s.step = f.step + 1),
ends as (select lang, pos, arg_max(h, step) as folded_root from folded group by lang, pos),
proved as (select lang, pos, sha256(string_agg(l || r, '' order by step)) as proof_sha256 from steps group by lang, pos)
select p.doc_id, p.h as leaf, b.h as subroot, f.h as root, coalesce(v.proof_sha256, sha256('')) as proof_sha256, e.folded_root, e.folded_root = f.h as verified
from placed p join subroots b on b.lang is not distinct from p.lang join forest f on f.n = 1
join ends e on e.lang is not distinct from p.lang and e.pos = p.pos
left join proved v on v.lang is not distinct from p.lang and v.pos = p.pos
"""
