"""Queries of places over a gazetteer that is made of the given tables, and their DuckDB twins: regions are macro regions,
nations countries, each with four states, and suppliers are cities whose names are shared. Place texts come from customers.

The twins take the names in a text from how it was made, so they share neither patterns nor intervals with the library."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.operators import hierarchy as H
from jobmarket.operators import places as P
from jobmarket.plans.frame import read

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


#: Trees of customers, fourteen deep at 15,000 of them: a node's parent is its half; nodes 3 and 7 of each thousand close a cycle.
EDGES = "select c_custkey as node, case when c_custkey % 1000 = 3 then c_custkey + 4 when c_custkey % 1000 = 7 then c_custkey - 4 when c_custkey > 1 then cast(floor(c_custkey / 2) as bigint) end as parent from customer"


@query("r22_closure", f"""with recursive e as ({EDGES}), up(node, ancestor) as (select node, parent from e where parent is not null union select up.node, e.parent from up join e on e.node = up.ancestor where e.parent is not null),
n as (select node from e union select parent from e where parent is not null), x as (select node from up where node = ancestor)
select p.node, p.ancestor, x.node is not null as looped from (select node, ancestor from up where node <> ancestor union all select node, node from n) p left join x on x.node = p.node""")
def closure(spark, d):
    """Ancestors at any depth, with the nodes of cycles marked."""
    read(spark, d, "customer").createOrReplaceTempView("customer")
    return H.closure(spark.sql(EDGES)).drop("distance")


PLACES = f"""select 100 + r_regionkey as place_id, cast(null as bigint) as parent_id, 'macro' as kind, 1000000 * (r_regionkey + 1) as population, 'l0' as lang from region
union all select 200 + n_nationkey, 100 + n_regionkey, 'country', 10000 * (n_nationkey % 7 + 1), concat('l', n_nationkey % 3) from nation
{' '.join(f"union all select {1000 + k} + 10 * n_nationkey, 200 + n_nationkey, 'region', 50 * ((n_nationkey * 5 + {3 * k}) % 11 + 1), concat('l', n_nationkey % 3) from nation" for k in range(4))}
union all select 100000 + s_suppkey, 1000 + 10 * s_nationkey + s_suppkey % 4, 'city', s_suppkey * 13 % 997, concat('l', s_suppkey % 3) from supplier"""
NAMES = f"""select r_name as name, 100 + r_regionkey as place_id, false as code from region
union all select n_name, 200 + n_nationkey, false from nation
union all select concat('cc', n_nationkey), 200 + n_nationkey, true from nation
union all select concat('cc', n_nationkey % 20), 1000 + 10 * n_nationkey, true from nation
{' '.join(f"union all select concat('State ', (n_nationkey + {k}) % 9), {1000 + k} + 10 * n_nationkey, false from nation" for k in range(3))}
union all select concat('Town ', n_nationkey % 12), 1003 + 10 * n_nationkey, false from nation
union all select concat('Town ', s_suppkey % 37), 100000 + s_suppkey, false from supplier"""
#: Names of a customer's text, by its form; v is nation and region joined.
_A, _B, _S = "concat('Town ', c_custkey % 37)", "concat('Town ', cast(floor(c_custkey / 37) as bigint) % 41)", "concat('State ', cast(floor(c_custkey / 5) as bigint) % 9)"
TEXT = f"""select c_custkey, case c_custkey % 9 when 0 then concat({_A}, ', ', {_S}, ', ', n_name) when 1 then {_A} when 2 then concat({_A}, ' ', n_name) when 3 then concat(n_name, ', ', {_A}, ', ', {_B}) when 4 then concat({_A}, ' / ', {_B})
when 5 then r_name when 6 then concat({_A}, ' (Remote);  hybrid - ', n_name, ' HQ') when 7 then concat('cc', c_custkey % 25) else concat('Gate 5, ', {_A}, ', cc', c_nationkey, ', 12345') end as text, case when c_custkey % 5 > 0 then concat('l', c_custkey % 3) end as language
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""

#: The twin: entities as they were put together, roles and ranks over them.
C21_SQL = f"""with recursive pl as ({PLACES}), nm as (select distinct lower(name) as name, place_id, code from ({NAMES})),
anc(id, up) as (select place_id, parent_id from pl where parent_id is not null union select anc.id, pl.parent_id from anc join pl on pl.place_id = anc.up where pl.parent_id is not null),
v as (select c_custkey, c_custkey % 9 as form, {_A} as a, {_B} as b, {_S} as s, n_name as n, r_name as r, concat('cc', c_custkey % 25) as c, concat('cc', c_nationkey) as m, case when c_custkey % 5 > 0 then concat('l', c_custkey % 3) end as language
  from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey),
words as (select c_custkey, language, 0 as part, case when form = 6 then 'remote' end as work_type, case form when 0 then [a, s, n] when 1 then [a] when 2 then [a, n] when 3 then [n, a, b] when 4 then [a, b] when 5 then [r] when 6 then [a] when 7 then [c] else ['Gate 5', a, m, '12345'] end as names from v
  union all select c_custkey, language, 1, 'hybrid', [n] from v where form = 6),
ent as (select c_custkey as k, part, language, work_type, unnest(range(1, len(names) + 1)) as pos, unnest(names) as name from words),
c as (select distinct k, part, pos, pl.*, code, coalesce(pl.lang = language, false) as spoken from ent join nm on nm.name = lower(ent.name) join pl using (place_id)),
pairs as (select a.k, a.part, a.pos as l, a.place_id as inner_id, a.kind as kind, b.pos as r from c a join c b on a.k = b.k and a.part = b.part and a.pos < b.pos and b.kind <> 'city' join anc on anc.id = a.place_id and anc.up = b.place_id),
e0 as (select k, part, pos, bool_or(kind <> 'city') as wide, bool_or(kind = 'city') as city from c group by all),
e1 as (select *, min(pos) over w as first, max(pos) over w as last, bool_or(city) over w as mixed, exists (select 1 from pairs p where p.k = e0.k and p.part = e0.part and p.r = e0.pos) as holds, exists (select 1 from pairs p where p.k = e0.k and p.part = e0.part and p.l = e0.pos and p.kind <> 'city') as narrows from e0 window w as (partition by k, part)),
e2 as (select *, max(case when pos = first or not (wide and case when pos = last then not city or holds else narrows end) then pos end) over (partition by k, part) as stop from e1),
e3 as (select *, bool_or(pos > stop) over (partition by k, part) as forward from e2),
e as (select *, case when forward then case when pos > stop then 'context' else 'target' end when first = last then 'alone' when mixed and not city then 'context' else 'each' end as role from e3),
ctx as (select c.*, e.forward, row_number() over (partition by c.k, c.part order by case c.kind when 'region' then 0 when 'country' then 1 else 2 end, c.population desc, c.place_id) = 1 as narrowest
  from c join e using (k, part, pos) where role = 'context' and c.kind <> 'city' and (not e.forward or pos = last or exists (select 1 from pairs p where p.k = c.k and p.part = c.part and p.l = c.pos and p.inner_id = c.place_id))),
t0 as (select c.*, role, case when role = 'target' then 0 else pos end as g, coalesce((select max(case when x.narrowest and x.forward then 2 else 1 end) from ctx x join anc on anc.up = x.place_id where x.k = c.k and x.part = c.part and anc.id = c.place_id), 0) as level from c join e using (k, part, pos) where role <> 'context'),
t1 as (select * from t0 where role <> 'target' or level > 0 qualify level = max(level) over (partition by k, part, g)),
t2 as (select *, kind = 'city' and exists (select 1 from t1 y join anc on anc.up = y.place_id where y.k = t1.k and y.part = t1.part and y.g = t1.g and y.kind <> 'city' and anc.id = t1.place_id) as nested from t1),
t3 as (select *, coalesce(max(population) filter (nested) over w, -1) as pn, coalesce(max(population) filter (kind = 'city') over w, -1) as pc, coalesce(max(population) filter (kind in ('region', 'macro')) over w, -1) as pr from t2 window w as (partition by k, part, g)),
t4 as (select *, case when pn >= 0 then pn > 0 and pn * 10 < pr else pc < pr end as wide_first from t3),
t5 as (select * from t4 qualify row_number() over (partition by k, part, g order by case when role = 'alone' then case when code and kind = 'region' then -1 when kind = 'country' then 0 when kind <> 'city' then case when wide_first then 1 else 3 end when pn >= 0 and not nested then 4 else 2 end when nested then 0 when kind <> 'city' then 1 else 2 end,
  spoken desc, population desc, case kind when 'city' then 3 when 'region' then 2 when 'country' then 1 else 0 end desc, place_id) = 1),
found as (select k, part, place_id from t5 union select k, part, place_id from ctx where narrowest and forward and not exists (select 1 from t5 where t5.k = ctx.k and t5.part = ctx.part))
select distinct w.c_custkey, f.place_id, w.work_type from words w join found f on f.k = w.c_custkey and f.part = w.part"""


@query("c21_gazetteer_places", C21_SQL)
def hierarchical(spark, d):
    """Place texts against a gazetteer of four levels; the place nearest to its context, then language and population."""
    for t in ("region", "nation", "supplier", "customer"):
        read(spark, d, t).createOrReplaceTempView(t)
    places = spark.sql(PLACES).select("place_id", "parent_id", "kind", F.col("population").cast("long"), F.array("lang").alias("languages"))
    texts = spark.sql(TEXT)
    found = P.resolved(texts, places, spark.sql(NAMES)).withColumnsRenamed({"text": "_t", "language": "_l"})
    return texts.join(found, (F.col("text") == F.col("_t")) & F.col("language").eqNullSafe(F.col("_l"))).select("c_custkey", "place_id", "work_type").distinct()


ISO = "case n_nationkey when 24 then 'US' else concat(chr(65 + n_nationkey), 'X') end"
COUNTRIES = f"select {ISO} as iso2, concat('z', chr(65 + n_nationkey), 'q') as iso3, n_name as name, r_name as region, concat('al', n_nationkey) as alias from nation join region on n_regionkey = r_regionkey"
DIVISIONS = f"""select {ISO} as iso2, concat(chr(65 + n_nationkey), 'S') as code, concat('division ', n_nationkey) as name, n_nationkey as rank, n_nationkey % 2 = 0 as alone from nation where n_nationkey < 24
union all select 'US', concat(chr(65 + n_nationkey), 'T'), concat('state ', n_nationkey), 100 + n_nationkey, false from nation"""
CITIES = f"select concat('Town ', s_suppkey % 37) as name, {ISO} as iso2, case when s_nationkey = 24 then concat(chr(cast(65 + s_suppkey % 25 as int)), 'T') else concat('A', s_suppkey % 4) end as admin, s_suppkey * 79193 % 900000 as population, concat('twn', s_suppkey % 53) as alias from supplier join nation on s_nationkey = n_nationkey"
METROS = f"select concat('bay ', n_nationkey) as name, {ISO} as iso2, concat('Town ', n_nationkey) as city from nation where n_nationkey < 5"
#: Parts of a customer's text by its form, from left to right.
C18_FORMS = (
    ("a", "n"), ("a",), ("a", "st", "n"), ("a", "co"), ("a", "ust"), ("n",), ("i",), ("hint",), ("bay", "n"), ("al", "a"), ("co",), ("b", "a", "div"), ("a", "iso3"), ("a", "ustn"),
)
C18_PARTS = f"""select c_custkey, c_custkey % {len(C18_FORMS)} as form, concat('Town ', c_custkey % 41) as a, concat('TWN', c_custkey % 60) as b, n_name as n, concat('Division ', c_custkey % 24) as st, concat(chr(cast(65 + c_custkey % 24 as int)), 'S') as co, concat(chr(cast(65 + c_custkey % 25 as int)), 'T') as ust,
concat('state ', c_custkey % 25) as ustn, {ISO} as i, r_name as hint, concat('Bay ', c_custkey % 7) as bay, concat('AL', c_custkey % 25) as al, concat('Division ', c_custkey % 24) as div, concat('Z', chr(cast(65 + c_custkey % 25 as int)), 'Q') as iso3
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey"""
_JOINED = "case form " + " ".join(f"when {i} then concat({', '.join(x for j, p in enumerate(f) for x in ([repr(', '), p] if j else [p]))}, {repr(' (Remote)' if i % 3 == 0 else ' - hybrid' if i % 3 == 1 else ' office')})" for i, f in enumerate(C18_FORMS)) + " end"
_LISTED = "case form " + " ".join(f"when {i} then [{', '.join(f)}]" for i, f in enumerate(C18_FORMS)) + " end"

C18_SQL = f"""with co as ({COUNTRIES}), dv as ({DIVISIONS}), ci as ({CITIES}), me as ({METROS}), x as ({C18_PARTS}),
cn as (select n, min(iso2) as iso from (select lower(name) as n, iso2 from co union select lower(iso3), iso2 from co union select lower(alias), iso2 from co) group by n),
p as (select c_custkey as k, len(l) as n, unnest(range(0, len(l))) as pos, unnest(l) as raw from (select c_custkey, {_LISTED} as l from x)),
m as (select p.k, p.pos, p.raw, p.n, (select first(iso2 order by 1) from me where me.name = lower(raw)) as metro, (select any_value(city) from me where me.name = lower(raw)) as metro_city,
    (select iso from cn where cn.n = lower(raw)) as named, (select min_by({{'iso': iso2, 'code': code, 'alone': alone}}, rank) from dv where dv.code = raw and (p.n > 1 or true)) as st, (select iso2 from co where co.iso2 = raw) as iso,
    (select min_by({{'iso': iso2, 'code': code}}, rank) from dv where lower(dv.name) = lower(raw)) as dn, (select any_value(r_name) from region where lower(r_name) = lower(raw)) as hint from p),
m2 as (select *, metro is null and named is null and st is not null and (n > 1 or st.alone) as coded from m),
m3 as (select *, case when metro is null then coalesce(named, case when not coded then iso end) end as country from m2),
m4 as (select *, max(pos) filter (country is not null) over (partition by k) as upto from m3),
m5 as (select *, metro is null and country is null and (upto is null or pos > upto) as free from m4),
f as (select k, max_by(country, pos) filter (country is not null) as country, max_by(metro, pos) filter (metro is not null) as metro, max_by(metro_city, pos) filter (metro is not null) as metro_city,
    min_by(case when coded then st.iso else dn.iso end, pos) filter (free and (coded or dn is not null)) as part,
    min_by(st.code, pos) filter (free and coded and st.iso = 'US') as by_code, max_by(dn.code, pos) filter (free and not coded and dn.iso = 'US') as by_name,
    max_by(hint, pos) filter (hint is not null and metro is null and country is null and not coded and not (free and dn is not null)) as hint from m5 group by k),
cand as (select distinct m.k, m.pos, c.iso2, c.admin, c.population, c.name, f.country, coalesce(f.country, f.part) as around, coalesce(f.by_code, f.by_name) as state
  from m join (select lower(name) as n, * from ci union select lower(alias), * from ci) c on c.n = lower(m.raw) join f on f.k = m.k where m.metro is null),
g as (select k, pos, around, country, count(*) as n, max({{'p': population, 'name': name, 'iso': iso2}}) as top, max({{'p': population, 'name': name, 'iso': iso2}}) filter (iso2 = around and (around <> 'US' or state is null or admin = state)) as exact, max({{'p': population, 'name': name, 'iso': iso2}}) filter (iso2 = around) as near from cand group by all),
h as (select k, pos, case when around is null then case when n = 1 or top.p >= 100000 then top end else coalesce(exact, near, case when country is null and top.p >= 500000 then top end) end as city from g),
b as (select k, min_by(city, pos) as city from h where city is not null group by k),
r as (select x.c_custkey, case when metro is not null then metro else coalesce(f.country, b.city.iso, f.part) end as country, case when metro is not null then metro_city else b.city.name end as city, f.hint, x.form from x join f on f.k = x.c_custkey left join b on b.k = x.c_custkey)
select c_custkey, country, city, case when country is not null then (select region from co where co.iso2 = r.country) else hint end as region, form % 3 = 0 as remote, form % 3 = 1 as hybrid from r"""


@query("c18_gazetteer_places", C18_SQL)
def located(spark, d):
    """Country, city and region of place texts, from tables of names."""
    for t in ("region", "nation", "supplier", "customer"):
        read(spark, d, t).createOrReplaceTempView(t)
    listed = lambda df: df.withColumn("aliases", F.array("alias")).drop("alias")
    countries = listed(spark.sql(COUNTRIES))
    hints = read(spark, d, "region").select(F.col("r_name").alias("name"), F.col("r_name").alias("region"))
    names = P.gazetteer(countries, spark.sql(DIVISIONS), listed(spark.sql(CITIES)), spark.sql(METROS), hints)
    texts = spark.sql(C18_PARTS).selectExpr("c_custkey", f"{_JOINED} as text")
    found = P.located(texts, names, countries)
    return texts.join(found, "text").select("c_custkey", "country", "city", "region", "remote", "hybrid")
