"""DuckDB SQL of the operators that SQL can express."""

from __future__ import annotations

from . import license_scan as L
from . import secret_scan as S

EXACT_TOPK = """
with good as (
  select distinct vec_id, list_transform(embedding, lambda x: floor(1024 * x::double)) as v
  from embeddings
  where vec_id is not null and len(embedding) > 0
    and len(list_filter(embedding, lambda x: x is null or isnan(x) or isinf(x))) = 0
), ranked as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score,
         row_number() over (partition by q.vec_id order by list_inner_product(q.v, c.v) desc, c.vec_id) as rank
  from good q, good c where q.vec_id % 100 = 0 and q.vec_id <> c.vec_id
)
select query_id, rank::int as rank, vec_id, score from ranked where rank <= 10
"""


def _quoted(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def secrets(rules=S.RULES) -> str:
    """Every rule's matches with their places: the text split at the rule, and running sums of lengths."""
    parts = []
    for k, r in enumerate(rules):
        size = f"len(regexp_extract(w, {_quoted(r.regex)}, {r.group})) >= {r.least}" if r.least else "true"
        parts.append(f"""select rid, {k} as k, s, s + len(w) as e from (
    select rid, unnest(m) as w, unnest(list_transform(range(1, len(m) + 1), lambda i: list_sum(list_transform(b[1:i], lambda x: len(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: len(x))), 0))) as s
    from (select rid, regexp_extract_all(text, {_quoted(r.regex)}, 0) as m, string_split_regex(text, {_quoted(r.regex)}) as b from d)) where {size}""")
    kinds = "['" + "', '".join(r.kind for r in rules) + "']"
    shown = f"string_agg({kinds}[k + 1] || ':' || s::bigint || ':' || e::bigint, ',' order by s, k)"
    base = len(S.BASE)
    counts = ", ".join(f"count(*) filter (where k = {k})::bigint as n_{kind}" for k, kind in enumerate(S.BASE))
    return f"""
with d as materialized (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
spans as materialized ({" union all ".join(parts)})
select doc_id, {counts}, sha256(coalesce({shown} filter (where k < {base}), '')) as base_sha256, coalesce({shown} filter (where k is not null), '') as spans
from d left join spans using (rid) group by rid, doc_id
"""


def licenses(templates=L.TEMPLATES, least: float = L.LEAST) -> str:
    """Whole texts and lines against all templates, then all runs of words against those that none of them matched."""
    rows = ", ".join(f"({i}, {_quoted(name)}, [{', '.join(map(_quoted, L.bigrams(t)))}], {[max(1, round(len(L.normal(t).split(' ')[1:]) * f)) for f in L.SPANS]})" for i, (name, t) in enumerate(templates))
    norm = "string_split(trim(regexp_replace(translate({x}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^a-z0-9]+', ' ', 'g'), ' '), ' ')"
    pairs = "list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])"
    need = least / (2 - least)
    return f"""
with t as materialized (select * from (values {rows}) x(t, name, g, spans)),
d as materialized (select row_number() over () as rid, doc_id, coalesce(text, '') as text from documents),
units as (select rid, 0 as u, text as x from d union all select rid, unnest(range(1, len(l) + 1)) as u, unnest(l) as x from (select rid, string_split(text, chr(10)) as l from d)),
grams as materialized (select rid, u, list_distinct({pairs}) as g, {pairs} as every from (select rid, u, {norm.format(x="x")} as w from units) where len(w) > 1),
plain as materialized (select rid, t, u, d from (select a.rid, t.t, a.u, 2.0::double * len(list_intersect(a.g, t.g)) / (len(a.g) + len(t.g)) as d from grams a join t on len(a.g) between {need - 1e-9} * len(t.g) and {1 / need + 1e-9} * len(t.g)) where d >= {least}),
open_ as materialized (select a.rid, t.t, a.every, t.g, t.spans from grams a, t where a.u = 0 and len(list_intersect(a.g, t.g)) >= {need - 1e-9} * len(t.g) and not exists (select 1 from plain p where p.rid = a.rid and p.t = t.t)),
starts as (select rid, t, every, g, unnest(spans) as s from open_), runs as (select rid, t, g, s, every, unnest(range(0, len(every))) as i from starts),
scored as (select rid, t, 2.0::double * len(list_intersect(r, g)) / (len(r) + len(g)) as d from (select rid, t, g, list_distinct(every[i + 1:i + s]) as r from runs)),
found as materialized (select rid, t, u, d from plain union all select rid, t, -1, max(d) from scored where d >= {least} group by rid, t),
best as (select rid, count(*) as n, list_sort(list_distinct(list(name))) as names, first(name order by d desc, found.t, u) as license, max(d) as dice from found join t using (t) group by rid)
select doc_id, license, coalesce(dice, 0)::double as dice, coalesce(n, 0)::bigint as n_matches, coalesce(array_to_string(names, ','), '') as licenses from d left join best using (rid)
"""
