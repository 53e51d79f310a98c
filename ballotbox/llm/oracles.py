"""DuckDB SQL for the queries that SQL can say in full."""

WORDS = r"regexp_extract_all(text, '[^\x20\x09-\x0D]+')"

MIX = f"""
with d as (
    select doc_id, source, coalesce(len({WORDS}), 0) as size, md5(coalesce(cast(doc_id as varchar), '')) as digest
    from documents),
s as (
    select source, sum(size) as source_size, row_number() over (order by source nulls last) as src_rank
    from d group by source),
w as (
    select *, cast(case (src_rank - 1) % 3 when 0 then 3 when 1 then 1 else 2 end as double) as w,
           cast(2 * source_size as double) as cap from s),
l as (
    select *, (cast(sum(source_size) over () as double) * 3 / 2
               - coalesce(sum(cap) over (order by cap / w, src_rank rows between unbounded preceding and 1 preceding), 0))
              / sum(w) over (order by cap / w, src_rank rows between current row and unbounded following) as level
    from w),
f as (select level from l where level * w < cap order by cap / w, src_rank limit 1),
t as (
    select source, source_size, src_rank,
           case when level * w >= cap then cap else (select level from f) * w end as target
    from l),
q as (
    select d.doc_id, d.size, d.digest, t.*,
           sum(d.size) over (partition by t.src_rank order by d.digest, d.doc_id) as upto
    from d join t on d.source is not distinct from t.source),
c as (
    select *, case when target > 0 then cast(upto + e * source_size as double) / target else 'infinity'::double end as finish
    from q cross join (select unnest([0, 1]) as e) x),
k as (
    select *, sum(size) over (order by finish, src_rank, e, digest, doc_id rows unbounded preceding)
              <= (select sum(size) * 3 // 2 from d) as is_in
    from c)
select doc_id, cast(size as bigint) as size, cast(source_size as bigint) as source_size, target,
       cast(sum(case when is_in then size else 0 end) as bigint) as taken
from k group by doc_id, size, source_size, target
"""

JACCARD = f"""
with recursive w as (
    select doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\\x20\\x09-\\x0D]+') as words
    from documents),
g as (
    select doc_id, case when words is null or len(words) = 0 then []
                        when len(words) < 4 then [array_to_string(words, ' ')]
                        else list_distinct(list_transform(range(1, len(words) - 2), lambda i: array_to_string(words[i:i + 3], ' '))) end as grams
    from w),
n as (select doc_id, len(grams) as n_shingles from g),
u as (select doc_id, unnest(grams) as gram from g),
shared as (
    select a.doc_id as a, b.doc_id as b, count(*) as n_both
    from u a join u b on a.gram = b.gram and a.doc_id < b.doc_id group by 1, 2),
link as (
    select a, b from shared join n x on x.doc_id = a join n y on y.doc_id = b
    where 100 * n_both >= 85 * (x.n_shingles + y.n_shingles - n_both)),
edge as (select a, b from link union all select b, a from link),
reach(a, b) as (
    select a, b from edge
    union
    select r.a, e.b from reach r join edge e on r.b = e.a)
select n.doc_id, cast(n.n_shingles as bigint) as n_shingles,
       least(n.doc_id, coalesce(min(r.b), n.doc_id)) as component_id
from n left join reach r on r.a = n.doc_id group by n.doc_id, n.n_shingles
"""

LETTERS = (r"regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
           r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')")

SEARCH = f"""
with d as (
    select row_number() over () as r, doc_id, {LETTERS} as words from documents),
s as (select r, doc_id, len(words) as n from d where len(words) > 0),
total as (select count(*) as n_docs, cast(sum(n) as bigint) as n_terms from s),
t as (select r, term, count(*) as tf from (select r, unnest(words) as term from d) u group by r, term),
q as (
    select item, item_id, term, count(*) as times
    from (select item, item_id, unnest(words) as term
          from (select row_number() over () as item, item_id, {LETTERS} as words from benchmark) b) u
    group by item, item_id, term),
f as (select term, count(*) as df from t group by term),
w as (
    select term, cast(floor(1000 * ln(cast(2 * n_docs + 2 as double) / (2 * df + 1))) as bigint) as w from f, total),
m as (select r, doc_id, 75 + (25 * n * n_docs) // n_terms as m from s, total),
x as (
    select q.item, q.item_id, m.r, m.doc_id,
           cast(sum(q.times * w.w * ((1000000000 * t.tf) // (1000 * t.tf + 12 * m.m))) as bigint) as score
    from q join w on w.term = q.term join t on t.term = q.term join m on m.r = t.r
    group by q.item, q.item_id, m.r, m.doc_id)
select item_id, cast(rank as integer) as rank, doc_id, score
from (select *, row_number() over (partition by item order by score desc, doc_id nulls last) as rank from x where score > 0) y
where rank <= 20
"""


def codes(rounds: int = 6, entries: int = 16) -> str:
    """The rounds one after the other; every part against every entry."""
    def nearest(k: int) -> str:
        return f"""
a{k} as materialized (
    select r, part, min({{'d': d, 'entry': entry}}) as best
    from (select p.r, p.part, c.entry,
                 cast(list_sum(list_transform(list_zip(p.x, c.e), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) as bigint) as d
          from p join c{k} c on c.part = p.part) y
    group by r, part)"""

    def mean(k: int) -> str:
        return f"""
m{k} as materialized (
    select part, entry, list(v order by pos) as e
    from (select part, entry, pos, cast(floor(sum(v) / count(*)) as bigint) as v
          from (select a.part, a.best.entry as entry, unnest(p.x) as v, generate_subscripts(p.x, 1) as pos
                from a{k} a join p on p.r = a.r and p.part = a.part) u
          group by part, entry, pos) g
    group by part, entry),
c{k + 1} as materialized (
    select c.part, c.entry, coalesce(m.e, c.e) as e
    from c{k} c left join m{k} m on m.part = c.part and m.entry = c.entry)"""

    steps = ",".join(f"{nearest(k)},{mean(k)}" for k in range(rounds))
    return f"""
with v as materialized (
    select row_number() over (order by vec_id) as r, vec_id, label,
           list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as bigint)) as x
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
p as materialized (
    select r, part, x[part * (len(x) // 8) + 1:(part + 1) * (len(x) // 8)] as x
    from v cross join (select unnest(range(8)) as part) n),
c0 as (select part, r - 1 as entry, x as e from p where r <= {entries}),{steps},{nearest(rounds)},
h as (
    select sha256(string_agg(array_to_string(e, ','), ',' order by part, entry)) as codebooks_sha256 from c{rounds}),
f as (
    select r, string_agg(lpad(to_hex(best.entry), 2, '0'), '' order by part) as code, cast(sum(best.d) as bigint) as error
    from a{rounds} group by r)
select v.vec_id, lower(f.code) as code, f.error,
       cast(sum(f.error) over (partition by v.label) as bigint) as label_error, h.codebooks_sha256
from v join f on f.r = v.r cross join h
"""
