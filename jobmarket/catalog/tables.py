"""Queries over joins, table mutations, windows, paging, sampling, analytics and matching, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from jobmarket.functions import text as T
from jobmarket.functions import values as V
from jobmarket.operators import rollup as R
from jobmarket.operators import tables as M
from jobmarket.plans import analytics as A
from jobmarket.plans.frame import read

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


# The posting table: orders with a url, an owner, a status and two times. NOW stands after the last order.
NOW = "timestamp'2002-12-31 00:00:00'"
TABLE = {
    "id": "o_orderkey", "company_slug": "concat('c', o_custkey)", "url": "concat('https://x.example/', o_orderkey % 12000)", "board": "concat('b', o_custkey % 20)",
    "title": "concat('Title ', o_orderkey % 60)", "status": "case o_orderstatus when 'F' then 'closed' else 'open' end", "seniority": "case o_orderpriority when '1-URGENT' then 'senior' when '2-HIGH' then 'mid' when '5-LOW' then null else 'junior' end",
    "work": "case o_orderkey % 4 when 0 then 'remote' when 1 then 'hybrid' when 2 then 'onsite' else 'unknown' end", "source": "concat('src', o_custkey % 5)",
    "first_seen": "o_orderdate", "external_id": "case when o_orderkey % 3 = 0 then null else concat('x', o_orderkey) end", "price": "o_totalprice",
}


def table(spark, d, *columns):
    return read(spark, d, "orders").select(*[F.expr(TABLE[c]).alias(c) for c in (columns or TABLE)])


PT = "pt as (select " + ", ".join(f"{e} as {c}" for c, e in TABLE.items()) + " from orders)"


@query("f2_filter_accounting", f"with {PT} select source, count(*) as seen, count(*) filter (price > 150000) as kept, round(100.0 * count(*) filter (price > 150000) / count(*), 2) as kept_pct from pt group by 1")
def accounting(spark, d):
    """rows seen and kept by a filter, in one pass."""
    return table(spark, d).groupBy("source").agg(F.count("*").alias("seen"), F.count_if(F.expr("price > 150000")).alias("kept"), F.round(100.0 * F.count_if(F.expr("price > 150000")) / F.count("*"), 2).alias("kept_pct"))


@query("f3_search_filters", f"with {PT} select id, status, work, seniority from pt where work in ('remote', 'hybrid') and seniority in ('senior', 'mid') and status = 'open'")
def filters(spark, d):
    """optional membership filters; None or an empty list does not filter, status 'any' neither."""
    return A.filtered(table(spark, d), {"work": ["remote", "hybrid"], "seniority": ["senior", "mid"], "source": []}, "open").select("id", "status", "work", "seniority")


@query("f10_opt_out", f"with {PT} select id, company_slug from pt where lower(company_slug) not in (select 'c' || c_custkey from customer where c_acctbal < 0)")
def opt_out(spark, d):
    """left anti join on an opt-out list, case folded."""
    out = read(spark, d, "customer").filter("c_acctbal < 0").selectExpr("lower(concat('C', c_custkey)) as _out")
    return table(spark, d, "id", "company_slug").join(out, F.lower("company_slug") == F.col("_out"), "left_anti")


@query("f11_scrub_accounting", f"with {PT} select cast(first_seen as date) as day, count(*) filter (not (source = 'src1' and price < 100000)) as kept, count(*) filter (source = 'src1' and price < 100000) as dropped from pt group by 1")
def scrub(spark, d):
    """rows that a predicate removes, counted per date."""
    return A.scrub(table(spark, d).withColumn("day", F.col("first_seen").cast("date")), (F.col("source") == "src1") & (F.col("price") < 100000))[1]


@query("f12_due_rows", f"with {PT} select id from pt where status = 'open' and first_seen < {NOW} - interval 400 day and id % 5 <> 0")
def due(spark, d):
    """open, due and not leased."""
    return table(spark, d).filter((F.col("status") == "open") & (F.col("first_seen") < F.expr(f"{NOW} - interval 400 days")) & (F.col("id") % 5 != 0)).select("id")


@query("f13_include_exclude", "select page_id, url from pages where regexp_matches(url, 'blog|example\\.net') and not regexp_matches(url, '/(de|fr)/')")
def include_exclude(spark, d):
    """include and exclude patterns."""
    return A.url_filter(read(spark, d, "pages"), include=r"blog|example\.net", exclude="/(de|fr)/").select("page_id", "url")


@query("f14_allow_list", "select page_id, url from pages where regexp_full_match(url, 'https://[a-z.]+\\.example\\.(com|org)/.*')")
def allow_list(spark, d):
    """full match of an allow list."""
    return A.allowed(read(spark, d, "pages"), r"https://[a-z.]+\.example\.(com|org)/.*").select("page_id", "url")


@query("f15_fallback_fill", f"with {PT} select id, coalesce(external_id, 'p' || id) as external_id, coalesce(seniority, 'unknown') as seniority from pt")
def fallback(spark, d):
    """fields from a second source, then defaults."""
    t = table(spark, d, "id", "external_id", "seniority")
    second = t.selectExpr("id", "concat('p', id) as external_id")
    return A.merged_fields(t, second, "id", ["external_id"], {"seniority": "unknown"})


@query("j8_full_outer_facets", "with a as (select o_orderpriority as k, count(*) as x from orders where o_orderkey % 10 <> 1 group by 1), b as (select o_orderpriority as k, count(*) as y from orders where o_orderkey % 10 <> 2 and o_orderpriority <> '5-LOW' group by 1) select k, coalesce(y, 0) as value, coalesce(x, 0) as previous, coalesce(y, 0) - coalesce(x, 0) as delta, round(100.0 * (coalesce(y, 0) - x) / x, 2) as delta_pct, case when x is null then 'appeared' when y is null then 'disappeared' else 'both' end as state from b full join a using (k)")
def full_outer(spark, d):
    """Buckets that appear or vanish."""
    o = read(spark, d, "orders")
    n = lambda df: df.groupBy(F.col("o_orderpriority").alias("k")).agg(F.count("*").alias("j"))
    return R.deltas(n(o.filter("o_orderkey % 10 <> 2 and o_orderpriority <> '5-LOW'")), n(o.filter("o_orderkey % 10 <> 1")), ["k"])


@query("j9_fixed_buckets", f"with {PT}, b(seniority) as (values ('intern'), ('junior'), ('mid'), ('senior'), ('staff'), ('principal'), ('unknown')) select b.seniority, count(id) as n from b left join pt on b.seniority = coalesce(pt.seniority, 'unknown') group by 1")
def fixed_buckets(spark, d):
    """Counts over a fixed list, empty buckets shown."""
    return A.over_buckets(table(spark, d, "seniority").withColumn("seniority", F.coalesce("seniority", F.lit("unknown"))), "seniority", ["intern", "junior", "mid", "senior", "staff", "principal", "unknown"])


@query("j10_calendar_spine", "with s as (select cast(unnest(generate_series(date '1996-01-01' - 20, date '1996-01-01', interval 1 day)) as date) as day) select s.day, count(o_orderkey) as n from s left join orders on cast(o_orderdate as date) = s.day and o_orderstatus = 'F' group by 1")
def spine(spark, d):
    """21 days of counts, days without rows shown."""
    return A.daily_counts(read(spark, d, "orders").filter("o_orderstatus = 'F'"), F.col("o_orderdate").cast("date"), "1996-01-01", 21)


@query("j11_company_counts", f"with {PT} select company_slug, c_name as name, count(*) as n from pt join customer on company_slug = 'c' || c_custkey where status = 'open' group by 1, 2")
def company_counts(spark, d):
    """Open postings per company with its name."""
    names = read(spark, d, "customer").selectExpr("concat('c', c_custkey) as company_slug", "c_name as name")
    return table(spark, d).filter("status = 'open'").groupBy("company_slug").agg(F.count("*").alias("n")).join(names, "company_slug").select("company_slug", "name", "n")


@query("j12_anti_join", "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'O')")
def without(spark, d):
    """Keys without a row in a second table."""
    o = read(spark, d, "orders").filter("o_orderstatus = 'O'").select(F.col("o_custkey").alias("c_custkey"))
    return read(spark, d, "customer").select("c_custkey").join(o, "c_custkey", "left_anti")


@query("j13_disable_absent", "select c_custkey, c_acctbal > 0 and c_custkey in (select o_custkey from orders) as enabled from customer")
def absent(spark, d):
    """Keys missing from the incoming list are disabled."""
    t = read(spark, d, "customer").selectExpr("c_custkey", "c_acctbal > 0 as enabled")
    return M.disable_absent(t, read(spark, d, "orders").select(F.col("o_custkey").alias("c_custkey")), "c_custkey")


@query("j14_rehome", """with r as (select 'n' || s_suppkey % 300 as slug, 'u' || s_suppkey as url, 'n' || s_nationkey as company from supplier),
i as (select 'n' || c_custkey % 300 as slug, 'u' || c_custkey as url, 'n' || c_nationkey as company from customer where c_custkey < 60)
select r.slug, r.company as old_company, i.company as new_company from i join r on i.url = r.url where i.company <> r.company union select r.slug, r.company, i.company from i join r on i.slug = r.slug where i.company <> r.company""")
def rehome(spark, d):
    """Owners that differ by url or slug."""
    r = read(spark, d, "supplier").selectExpr("concat('n', s_suppkey % 300) as slug", "concat('u', s_suppkey) as url", "concat('n', s_nationkey) as company")
    i = read(spark, d, "customer").filter("c_custkey < 60").selectExpr("concat('n', c_custkey % 300) as slug", "concat('u', c_custkey) as url", "concat('n', c_nationkey) as company")
    return M.rehomed(r, i)


@query("j15_best_row", "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by case when o_orderpriority = '1-URGENT' then 0 else 1 end, o_orderdate desc, o_orderkey) = 1")
def best_row(spark, d):
    """Per company the urgent newest posting."""
    o = read(spark, d, "orders")
    return M.first_per_key(o, ["o_custkey"], [F.when(F.col("o_orderpriority") == "1-URGENT", 0).otherwise(1), F.desc("o_orderdate"), "o_orderkey"]).select("o_custkey", "o_orderkey")


@query("j16_array_overlap", "with t as (select l_orderkey, list(distinct l_suppkey % 50) as ids from lineitem group by 1) select l_orderkey from t where list_has_any(ids, [3, 17, 42])")
def overlap(spark, d):
    """Rows whose id list meets a set."""
    t = read(spark, d, "lineitem").groupBy("l_orderkey").agg(F.collect_set(F.col("l_suppkey") % 50).alias("ids"))
    return t.filter(F.arrays_overlap("ids", F.array(*[F.lit(x).cast("long") for x in (3, 17, 42)]))).select("l_orderkey")


@query("j17_semi_join", "select o_orderkey from orders where exists (select 1 from lineitem where l_orderkey = o_orderkey and l_returnflag = 'R' and l_quantity > 45)")
def semi(spark, d):
    """Rows with a partner."""
    li = read(spark, d, "lineitem").filter("l_returnflag = 'R' and l_quantity > 45").select(F.col("l_orderkey").alias("o_orderkey"))
    return read(spark, d, "orders").join(li, "o_orderkey", "left_semi").select("o_orderkey")


@query("j18_star_join", "select l_orderkey, min(c_name) as company, min(n_name) as country, min(r_name) as region, string_agg(p_brand, '|' order by l_linenumber, p_brand, s_name) as brands, string_agg(s_name, '|' order by l_linenumber, p_brand, s_name) as suppliers from lineitem join orders on l_orderkey = o_orderkey join customer on o_custkey = c_custkey join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey join part on l_partkey = p_partkey join supplier on l_suppkey = s_suppkey group by 1")
def star(spark, d):
    """Postings with the names of all their dimensions; lists keep line order."""
    t = lambda n: read(spark, d, n)
    lines = t("lineitem").join(t("part"), F.expr("l_partkey = p_partkey")).join(t("supplier"), F.expr("l_suppkey = s_suppkey"))
    rows = F.sort_array(F.collect_list(F.struct("l_linenumber", "p_brand", "s_name")))
    per = lines.groupBy("l_orderkey").agg(rows.alias("rows"))
    names = t("orders").join(t("customer"), F.expr("o_custkey = c_custkey")).join(t("nation"), F.expr("c_nationkey = n_nationkey")).join(t("region"), F.expr("n_regionkey = r_regionkey"))
    return per.join(names, F.expr("l_orderkey = o_orderkey")).select("l_orderkey", F.col("c_name").alias("company"), F.col("n_name").alias("country"), F.col("r_name").alias("region"), F.array_join("rows.p_brand", "|").alias("brands"), F.array_join("rows.s_name", "|").alias("suppliers"))


IDS = """b as (select o_orderkey as identity, 'u' || o_orderkey % 9000 as url, 'n' || o_custkey % 7 as company from orders where o_orderkey % 4 = 1),
e as (select o_orderkey as identity, 'u' || o_orderkey % 9001 as url, 'n' || o_custkey % 8 as company from orders where o_orderkey % 6 = 1)"""


@query("j19_identity_conflicts", f"""with {IDS} select distinct kind, cast(identity as varchar) as identity from (select 'duplicate_identity' as kind, identity from b group by 2 having count(*) > 1
union all select 'duplicate_url', min(identity) from b group by url having count(*) > 1 union all select 'cross_owner', b.identity from b join e using (identity) where b.company <> e.company
union all select 'url_owned', b.identity from b join e on b.url = e.url where b.identity <> e.identity)""")
def conflicts(spark, d):
    """Violations of identity rules in a batch."""
    o = read(spark, d, "orders")
    b = o.filter("o_orderkey % 4 = 1").selectExpr("o_orderkey as identity", "concat('u', o_orderkey % 9000) as url", "concat('n', o_custkey % 7) as company")
    e = o.filter("o_orderkey % 6 = 1").selectExpr("o_orderkey as identity", "concat('u', o_orderkey % 9001) as url", "concat('n', o_custkey % 8) as company")
    return M.identity_conflicts(b, e)


@query("j20_tiered_match", """with r as (select s_suppkey as id, s_name as name, 'key' || s_nationkey as tenant from supplier), k as (select c_custkey as slug, replace(c_name, 'Customer', 'Supplier') as name, 'key' || c_nationkey as tenant from customer where c_custkey % 2 = 0),
u1 as (select slug as id, min(slug) as m from k where slug % 4 = 0 group by 1 having count(*) = 1), u2 as (select name, min(slug) as m from k group by 1 having count(*) = 1), u3 as (select tenant, min(slug) as m from k group by 1 having count(*) = 1)
select r.id, coalesce(u1.m, u2.m, u3.m) as slug, case when u1.m is not null then 'id' when u2.m is not null then 'name' when u3.m is not null then 'tenant' end as tier from r left join u1 using (id) left join u2 using (name) left join u3 using (tenant)""")
def tiered(spark, d):
    """Id, then unique name, then unique tenant; ambiguous keys match nothing."""
    r = read(spark, d, "supplier").selectExpr("s_suppkey as id", "s_name as name", "concat('key', s_nationkey) as tenant")
    k = read(spark, d, "customer").filter("c_custkey % 2 = 0").selectExpr("c_custkey as slug", "replace(c_name, 'Customer', 'Supplier') as name", "concat('key', c_nationkey) as tenant", "case when c_custkey % 4 = 0 then c_custkey end as id")
    return A.tiered_match(r, k, ["id", "name", "tenant"], "slug").select("id", "slug", "tier")


@query("j21_hard_evidence", """with a as (select page_id, 'https://' || lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) || coalesce(nullif(regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), '/+$', ''), ''), '/') as u from pages)
select x.page_id as a, min(y.page_id) as b from a x join a y on x.u = y.u and y.page_id < x.page_id group by 1""")
def evidence(spark, d):
    """Earlier pages with the same normalised url (without its query)."""
    u = V.normalised_url(F.regexp_replace("url", r"[?#].*$", ""))
    p = read(spark, d, "pages").select("page_id", u.alias("u"))
    first = p.groupBy("u").agg(F.min("page_id").alias("b"))
    return p.join(first, "u").filter("b < page_id").select(F.col("page_id").alias("a"), "b")


@query("j22_token_blocking", """with t as (select distinct page_id, unnest(list_distinct(string_split(regexp_extract(url, '://([^/?#]+)', 1), '.'))) as tok from pages),
ok as (select tok from t group by 1 having count(*) between 2 and 40) select a.page_id as a, b.page_id as b, count(*) as shared from t a join t b using (tok) join ok using (tok) where a.page_id < b.page_id group by 1, 2 having count(*) >= 1""")
def blocking(spark, d):
    """Pairs that share a token of at most 40 rows; frequent tokens are no evidence."""
    toks = F.array_distinct(F.split(F.regexp_extract("url", "://([^/?#]+)", 1), r"\."))
    return A.token_pairs(read(spark, d, "pages").select("page_id", toks.alias("tokens")), "page_id", "tokens", 40)


@query("j22_related_names", """with p as (select page_id, lower(regexp_extract(url, '://([^/?#]+)', 1)) as name, list_distinct(list_filter(string_split(regexp_extract(url, '://([^/?#]+)', 1), '.'), lambda x: x <> '')) as tokens from pages),
t as (select page_id, unnest(tokens) as token from p), rare as (select token from t group by token having count(*) between 2 and 200),
pairs as (select a.page_id as a, b.page_id as b, count(*) as shared from t a join t b using (token) join rare using (token) where a.page_id < b.page_id group by all)
select a, b, shared from pairs join p x on x.page_id = a join p y on y.page_id = b where least(length(x.name), length(y.name)) >= 4
and (contains(x.name, y.name) or contains(y.name, x.name) or (list_has_all(y.tokens, x.tokens) and len(x.tokens) < len(y.tokens)) or (list_has_all(x.tokens, y.tokens) and len(y.tokens) < len(x.tokens)))""")
def related(spark, d):
    """J22 as the reference has it: pairs that share a token of at most 200 rows, then containment or strict token subset."""
    host = F.regexp_extract("url", "://([^/?#]+)", 1)
    return A.related_names(read(spark, d, "pages").select("page_id", host.alias("name"), F.split(host, r"\.").alias("tokens")), "page_id", "name", "tokens")


SNAP = "l as (select o_orderkey as id, o_orderstatus = 'O' as active, cast(round(o_totalprice) as bigint) as p from orders where o_orderkey % 10 <> 1), r as (select o_orderkey as id, case when o_orderkey % 7 = 0 then o_orderstatus <> 'O' else o_orderstatus = 'O' end as active, cast(round(o_totalprice) as bigint) + case when o_orderkey % 11 = 0 then 1 else 0 end as p from orders where o_orderkey % 10 <> 2)"


@query("j23_snapshot_compare", f"with {SNAP} select id, case when r.p is null then 'missing' when l.p is null and r.active then 'remote_only_active' when l.p is null then 'remote_only_inactive' when l.active <> r.active then 'state_mismatch' when l.p <> r.p then 'payload_mismatch' else 'equal' end as kind from l full join r using (id)")
def snapshot_compare(spark, d):
    """Class of every id of two stores."""
    o = read(spark, d, "orders")
    local = o.filter("o_orderkey % 10 <> 1").selectExpr("o_orderkey as id", "o_orderstatus = 'O' as active", "cast(round(o_totalprice) as bigint) as p")
    remote = o.filter("o_orderkey % 10 <> 2").selectExpr("o_orderkey as id", "case when o_orderkey % 7 = 0 then o_orderstatus <> 'O' else o_orderstatus = 'O' end as active", "cast(round(o_totalprice) as bigint) + case when o_orderkey % 11 = 0 then 1 else 0 end as p")
    return M.compare_snapshots(local, remote, "id", "active", "p")


@query("j24_zip_arrays", "with a as (select o_custkey, list(o_orderkey order by o_orderkey) as ids, list(o_orderstatus order by o_orderkey) as ss from orders group by 1) select o_custkey, unnest(ids) as id, unnest(ss) as status from a")
def zipped(spark, d):
    """Parallel arrays as rows."""
    s = F.sort_array(F.collect_list(F.struct("o_orderkey", "o_orderstatus")))
    a = read(spark, d, "orders").groupBy("o_custkey").agg(s.alias("s")).select("o_custkey", F.col("s.o_orderkey").alias("id"), F.col("s.o_orderstatus").alias("status"))
    return a.select("o_custkey", F.inline(F.arrays_zip("id", "status")))


@query("j25_key_conflicts", """with a as (select c_custkey as id, 'k' || c_custkey % 1400 as k from customer), b as (select c_custkey as id, 'k' || c_custkey % 1300 as k from customer)
select 'same_key' as kind, a.k as left_key, b.k as right_key, a.id as left_id, b.id as right_id from a join b on a.k = b.k where a.id <> b.id union all select 'same_id', a.k, b.k, a.id, b.id from a join b on a.id = b.id where a.k <> b.k""")
def key_conflicts(spark, d):
    """Key conflicts between two stores."""
    c = read(spark, d, "customer")
    return M.key_conflicts(c.selectExpr("c_custkey as id", "concat('k', c_custkey % 1400) as k"), c.selectExpr("c_custkey as id", "concat('k', c_custkey % 1300) as k"), "k")


@query("a20_analytics_object", f"""with {PT}, o as (select * from pt where status = 'open') select cast(count(*) as bigint) as total, count(distinct company_slug) as companies, round(100.0 * count(*) filter (seniority = 'mid') / count(*), 1) as mid_pct,
count(*) filter (work = 'remote') as remote, count(*) filter (work = 'hybrid') as hybrid, count(*) filter (work = 'onsite') as onsite, count(*) filter (work = 'unknown') as unknown,
(select string_agg(company_slug || ':' || n, ',' order by n desc, company_slug) from (select company_slug, count(*) as n from o group by 1 order by n desc, company_slug limit 12)) as top_companies from o""")
def analytics(spark, d):
    """The analytics object of open postings as one row."""
    return A.analytics(table(spark, d))


@query("a21_market_snapshot", f"""with {PT} select count(*) filter (status = 'open') as open, count(*) filter (first_seen > timestamp '1998-07-01') as new, count(*) filter (status = 'closed' and first_seen > timestamp '1998-07-01') as closed,
(select string_agg(k || ':' || n, ',' order by k) from (select coalesce(seniority, 'unknown') as k, count(*) as n from pt where status = 'open' group by 1)) as by_seniority from pt""")
def market_snapshot(spark, d):
    """Counts of the day and a map by seniority (as text)."""
    return A.market_snapshot(table(spark, d), "1998-07-01")


@query("a23_facet_with_ancestors", "with c as (select o_orderkey, c_nationkey as nation from orders join customer on o_custkey = c_custkey), e as (select o_orderkey, 'n' || nation as node from c union all select o_orderkey, 'r' || n_regionkey from c join nation on nation = n_nationkey union all select o_orderkey, 'world' from c) select node, count(*) as n from e group by 1")
def ancestors(spark, d):
    """Counts of places with all their ancestors."""
    nodes = read(spark, d, "nation").selectExpr("concat('n', n_nationkey) as node", "concat('r', n_regionkey) as parent").unionByName(read(spark, d, "region").selectExpr("concat('r', r_regionkey) as node", "'world' as parent"))
    leaf = read(spark, d, "orders").join(read(spark, d, "customer"), F.expr("o_custkey = c_custkey")).selectExpr("concat('n', c_nationkey) as node").groupBy("node").agg(F.count("*").alias("k"))
    closure = A.ancestors(nodes, 3)
    return leaf.join(closure, "node").groupBy(F.col("ancestor").alias("node")).agg(F.sum("k").alias("n"))


@query("a24_two_window_counts", f"with {PT} select company_slug, count(*) filter (status = 'open') as active, count(*) filter (first_seen > {NOW} - interval 12 month) as year from pt group by 1")
def two_windows(spark, d):
    """Open now and seen in a year."""
    return table(spark, d).groupBy("company_slug").agg(F.count_if(F.expr("status = 'open'")).alias("active"), F.count_if(F.expr(f"first_seen > add_months({NOW}, -12)")).alias("year"))


@query("a25_watchlist_totals", f"with {PT}, n as (select company_slug, count(*) filter (status = 'open') as k from pt group by 1), w as (select 'w' || c_nationkey as list, 'c' || c_custkey as company_slug from customer) select list, count(*) as members, cast(sum(coalesce(k, 0)) as bigint) as active from w left join n using (company_slug) group by 1")
def watchlists(spark, d):
    """Active counts summed over member companies."""
    n = table(spark, d).groupBy("company_slug").agg(F.count_if(F.expr("status = 'open'")).alias("k"))
    w = read(spark, d, "customer").selectExpr("concat('w', c_nationkey) as list", "concat('c', c_custkey) as company_slug")
    return w.join(n, "company_slug", "left").groupBy("list").agg(F.count("*").alias("members"), F.sum(F.coalesce("k", F.lit(0))).alias("active"))


@query("a26_table_statistics", f"with {PT} select 'postings' as name, count(*) as n, count(*) filter (status = 'open') as open, count(distinct company_slug) as companies from pt union all select 'companies', count(*), null, count(distinct c_custkey) from customer")
def statistics(spark, d):
    """Row counts by state."""
    a = table(spark, d).agg(F.lit("postings").alias("name"), F.count("*").alias("n"), F.count_if(F.expr("status = 'open'")).alias("open"), F.count_distinct("company_slug").alias("companies"))
    b = read(spark, d, "customer").agg(F.lit("companies").alias("name"), F.count("*").alias("n"), F.lit(None).cast("long").alias("open"), F.count_distinct("c_custkey").alias("companies"))
    return a.unionByName(b)


HEALTH = "h as (select 'b' || user_id % 40 as board, 'c' || user_id % 12 as company, count(*) filter (event_type = 'error') as failures, count(*) filter (event_type <> 'error') as successes, max(ts) as last_seen from events group by 1, 2)"


@query("a27_health_aggregates", f"with {HEALTH} select company, count(*) as boards, count(*) filter (failures > successes / 4) as failing, max(date_diff('day', cast(last_seen as date), date '2024-02-01')) as stale_days from h group by 1 having count(*) filter (failures > 0) = count(*)")
def health(spark, d):
    """Companies all of whose boards failed at some time."""
    h = A.board_health(read(spark, d, "events"))
    return h.groupBy("company").agg(F.count("*").alias("boards"), F.count_if(F.expr("failures > successes / 4")).alias("failing"), F.max(F.datediff(F.lit("2024-02-01").cast("date"), F.col("last_seen").cast("date"))).cast("long").alias("stale_days"), F.count_if(F.expr("failures > 0")).alias("k")).filter("k = boards").drop("k")


@query("a28_stale_with_sibling", f"with {HEALTH}, s as (select *, sum(successes) over (partition by company) - successes as siblings from h) select board, company, failures, cast(siblings as bigint) as siblings from s where failures * 5 > successes and siblings > 0")
def stale_sibling(spark, d):
    """Failing boards whose company has a healthy sibling; a window instead of correlated counts."""
    h = A.board_health(read(spark, d, "events"))
    w = Window.partitionBy("company")
    return h.withColumn("siblings", F.sum("successes").over(w) - F.col("successes")).filter("failures * 5 > successes and siblings > 0").select("board", "company", "failures", "siblings")


@query("a29_coverage_counts", f"with {PT} select source, status, count(*) as total, count(external_id) as covered, count(*) filter (external_id is null) as missing from pt group by 1, 2")
def covered(spark, d):
    """Total and covered rows by state."""
    return table(spark, d).groupBy("source", "status").agg(F.count("*").alias("total"), F.count("external_id").alias("covered"), F.count_if(F.expr("external_id is null")).alias("missing"))


@query("a31_activity_buckets", "select l_suppkey, count(*) as jobs, count(*) filter (l_returnflag = 'R') as remote, count(distinct l_partkey) as names, array_to_string(list_sort(list(distinct l_linenumber))[1:5], ',') as places, max(l_shipdate) as latest from lineitem group by 1")
def activity(spark, d):
    """Per identity counts, capped distinct lists and the latest date."""
    places = F.array_join(F.transform(F.slice(F.array_sort(F.collect_set("l_linenumber")), 1, 5), lambda x: x.cast("string")), ",")
    return read(spark, d, "lineitem").groupBy("l_suppkey").agg(F.count("*").alias("jobs"), F.count_if(F.expr("l_returnflag = 'R'")).alias("remote"), F.count_distinct("l_partkey").alias("names"), places.alias("places"), F.max("l_shipdate").alias("latest"))


@query("a32_inventory_coverage", "select p_brand as family, count(*) as n, case when p_brand in ('Brand#11', 'Brand#12') then 'supported' when p_brand = 'Brand#55' then 'excluded' else 'unsupported' end as support, round(100.0 * count(*) / (select count(*) from part), 2) as pct from part group by 1")
def inventory(spark, d):
    """Rows per family by support, and share of all."""
    p = read(spark, d, "part")
    support = spark.createDataFrame([("Brand#11", "supported"), ("Brand#12", "supported"), ("Brand#55", "excluded")], "family string, support string")
    n = p.groupBy(F.col("p_brand").alias("family")).agg(F.count("*").alias("n"))
    total = n.agg(F.sum("n").alias("total"))
    return n.join(F.broadcast(support), "family", "left").join(F.broadcast(total)).select("family", "n", F.coalesce("support", F.lit("unsupported")).alias("support"), F.round(100.0 * F.col("n") / F.col("total"), 2).alias("pct"))


@query("a33_changed_sets", "with a as (select o_custkey, list_sort(list(distinct o_orderkey)) as u from orders where o_orderkey % 10 <> 1 group by 1), b as (select o_custkey, list_sort(list(distinct o_orderkey)) as u from orders where o_orderkey % 10 <> 2 group by 1) select count(*) as changed from a full join b using (o_custkey) where a.u is distinct from b.u")
def changed_sets(spark, d):
    """Groups whose set of urls differs between two snapshots."""
    o = read(spark, d, "orders")
    g = lambda k: o.filter(F.col("o_orderkey") % 10 != k).groupBy("o_custkey").agg(F.array_sort(F.collect_set("o_orderkey")).alias(f"u{k}"))
    return g(1).join(g(2), "o_custkey", "full_outer").agg(F.count_if(~F.col("u1").eqNullSafe(F.col("u2"))).alias("changed"))


@query("a34_spend_since_midnight", "select event_id, ts, round(sum(value) over (partition by cast(ts as date), user_id order by ts, event_id), 2) as spent from events where event_type = 'purchase'")
def spend(spark, d):
    """Running spend of the day per user."""
    w = Window.partitionBy(F.col("ts").cast("date"), "user_id").orderBy("ts", "event_id").rowsBetween(Window.unboundedPreceding, 0)
    return read(spark, d, "events").filter("event_type = 'purchase'").select("event_id", "ts", F.round(F.sum("value").over(w), 2).alias("spent"))


@query("a36_language_shares", None)
def language_shares(spark, d):
    """Languages of a document's chunks (of about 500 characters, those of 80 or more) that hold 15 % of them or more."""
    docs = read(spark, d, "documents")
    chunks = docs.select("doc_id", F.explode(F.filter(T.chunks(F.col("text")), lambda x: F.length(x) >= 80)).alias("chunk"))
    n = chunks.select("doc_id", T.language(F.lit(None).cast("string"), F.col("chunk")).alias("found")).groupBy("doc_id", "found").agg(F.count("*").alias("n"))
    share = F.col("n") / F.sum("n").over(Window.partitionBy("doc_id"))
    return n.withColumn("share", F.round(share, 4)).filter("share >= 0.15")


@query("w1_newest_per_company", f"with {PT} select id, company_slug from pt qualify row_number() over (partition by company_slug order by first_seen desc, id desc) <= 5")
def newest(spark, d):
    """The newest five postings of each company."""
    return M.newest_per_group(table(spark, d, "id", "company_slug", "first_seen"), "company_slug", [F.desc("first_seen"), F.desc("id")], 5).select("id", "company_slug")


@query("w2_page_with_total", f"with {PT} select id, first_seen, (select count(*) from pt where status = 'open') as total from pt where status = 'open' order by first_seen desc, id desc limit 20 offset 40")
def page_total(spark, d):
    """A page with the total, counted apart from the sort."""
    return A.page(table(spark, d, "id", "status", "first_seen").filter("status = 'open'"), [F.desc("first_seen"), F.desc("id")], 20, 40).select("id", "first_seen", "total")


@query("w3_round_robin", "with r as (select page_id, regexp_extract(url, '://([^/?#]+)', 1) as host, row_number() over (partition by regexp_extract(url, '://([^/?#]+)', 1) order by page_id) as rank from pages) select page_id, host, cast(rank as int) as rank from r order by rank, page_id limit 50")
def round_robin(spark, d):
    """Fairness over hosts."""
    w = Window.partitionBy("host").orderBy("page_id")
    p = read(spark, d, "pages").select("page_id", F.regexp_extract("url", "://([^/?#]+)", 1).alias("host"))
    return p.withColumn("rank", F.row_number().over(w)).orderBy("rank", "page_id").limit(50)


@query("w7_rolling_median", "with e as (select event_id, user_id, value, list(value) over (partition by user_id order by event_id rows between 4 preceding and current row) as l from events where value is not null) select event_id, user_id, value, list_aggregate(l, 'median') as rolling_median from e")
def rolling(spark, d):
    """Median of the last five values of a board."""
    e = read(spark, d, "events").filter("value is not null").select("event_id", "user_id", "value")
    return M.rolling_median(e, "user_id", "event_id", "value", 5)


@query("k7_keyset_page", f"with {PT} select id, first_seen from pt where status = 'open' and (first_seen < timestamp '1997-01-01' or (first_seen = timestamp '1997-01-01' and id < 5000)) order by first_seen desc, id desc limit 25")
def keyset(spark, d):
    """K7: a page after a cursor."""
    import datetime

    return A.keyset(table(spark, d, "id", "status", "first_seen").filter("status = 'open'"), "first_seen", "id", (datetime.datetime(1997, 1, 1), 5000), 25).select("id", "first_seen")


@query("k8_nulls_last_keyset", "select o_orderkey, case when o_orderkey % 3 = 0 then null else o_orderdate end as ts from orders where o_orderkey % 3 = 0 and o_orderkey < 9000 order by o_orderkey desc limit 30")
def keyset_nulls(spark, d):
    """K8: a page inside the rows without a time, which come last."""
    o = read(spark, d, "orders").selectExpr("o_orderkey", "case when o_orderkey % 3 = 0 then null else o_orderdate end as ts")
    return A.keyset(o, "ts", "o_orderkey", (None, 9000), 30)


@query("k9_impact_rank", f"with {PT}, n as (select company_slug, count(*) filter (status = 'open') as active, count(*) as jobs, count(distinct board) as boards from pt group by 1) select company_slug, active, jobs, cast(row_number() over (order by case when active > 0 then 0 else 1 end, jobs desc, boards desc, company_slug) as int) as place from n")
def impact(spark, d):
    """K9: ranking by activity, jobs, boards, name."""
    n = table(spark, d).groupBy("company_slug").agg(F.count_if(F.expr("status = 'open'")).alias("active"), F.count("*").alias("jobs"), F.count_distinct("board").alias("boards"))
    return A.placed(n, [F.when(F.col("active") > 0, 0).otherwise(1), F.desc("jobs"), F.desc("boards"), "company_slug"]).select("company_slug", "active", "jobs", "place")


@query("k10_scored_top", "with s as (select c_custkey, 3 * (c_acctbal > 5000)::int + 2 * (c_mktsegment = 'BUILDING')::int + (c_nationkey < 10)::int as score from customer), t as (select c_custkey, score from s order by score desc, c_custkey limit 100) select c_custkey, score from t union select c_custkey, score from s where c_custkey < 20")
def scored_top(spark, d):
    """Additive score, the first hundred and a list that stays."""
    score = 3 * (F.col("c_acctbal") > 5000).cast("int") + 2 * (F.col("c_mktsegment") == "BUILDING").cast("int") + (F.col("c_nationkey") < 10).cast("int")
    s = read(spark, d, "customer").select("c_custkey", score.alias("score"))
    return A.top_and_kept(s, [F.desc("score"), "c_custkey"], 100, F.col("c_custkey") < 20)


@query("k11_stratified_sample", f"with {PT} select company_slug, id from pt qualify row_number() over (partition by company_slug order by sha256('7|' || id), id) = 1")
def stratified(spark, d):
    """One row per company by a seeded hash."""
    return A.stratified(table(spark, d, "company_slug", "id"), "company_slug", "id", 7)


@query("k12_rarity_weighted", f"""with {PT}, c as (select id, seniority, work, count(*) over (partition by seniority) as a, count(*) over (partition by work) as b from pt), m as (select max(a) as ma, max(b) as mb from c),
k as (select id, (least(4, sqrt(ma / a)) + least(4, sqrt(mb / b))) / 2 as w, ('0x' || substr(sha256('7|' || id), 1, 13))::bigint as h from c, m)
select id from (select id, row_number() over (order by -ln(1 - (h + 0.5) / 4503599627370496.0) / w, id) as r from k) where r <= 200""")
def rarity(spark, d):
    """Sampling without replacement by rarity, exponential clocks from a seeded hash."""
    return A.rarity_sample(table(spark, d, "id", "seniority", "work"), "id", ["seniority", "work"], 200, 7)


@query("k13_bounded_candidates", f"with {PT} select id from pt order by first_seen desc, id desc limit 10000")
def bounded(spark, d):
    """Newest candidates, between 10,000 and 50,000."""
    return table(spark, d, "id", "first_seen").orderBy(F.desc("first_seen"), F.desc("id")).limit(A.candidate_limit(7)).select("id")


@query("o2_tagged_union", f"with {PT} select 'open' as tag, id from pt where status = 'open' union all select 'cheap', id from pt where price < 50000")
def tagged(spark, d):
    """O2: UNION ALL with a tag."""
    t = table(spark, d)
    return t.filter("status = 'open'").select(F.lit("open").alias("tag"), "id").unionByName(t.filter("price < 50000").select(F.lit("cheap").alias("tag"), "id"))


@query("o4_distinct_facets", f"with {PT} select 'work' as facet, work as value from pt union select 'source', source from pt union select 'board', board from pt")
def facets(spark, d):
    """Distinct values of several facets."""
    t = table(spark, d, "work", "source", "board")
    return t.select(F.inline(F.array(*[F.struct(F.lit(c).alias("facet"), F.col(c).alias("value")) for c in t.columns]))).distinct()


@query("o5_key_sets", "select 'left' as side, o_custkey as k from (select o_custkey from orders where o_orderkey % 40 = 1 except select o_custkey from orders where o_orderkey % 40 = 7) union all select 'both', o_custkey from (select o_custkey from orders where o_orderkey % 40 = 1 intersect select o_custkey from orders where o_orderkey % 40 = 7)")
def key_sets(spark, d):
    """Difference and intersection of key sets."""
    o = read(spark, d, "orders")
    a, b = (o.filter(F.col("o_orderkey") % 40 == k).select(F.col("o_custkey").alias("k")).distinct() for k in (1, 7))
    return a.join(b, "k", "left_anti").select(F.lit("left").alias("side"), "k").unionByName(a.join(b, "k", "left_semi").select(F.lit("both").alias("side"), "k"))


@query("o7_array_union", "with t as (select o_custkey, list_sort(list(distinct o_orderkey % 30)) as a from orders group by 1) select o_custkey, array_to_string(list_sort(list_distinct(list_concat(a, [5, 31]))), ',') as ids from t")
def array_union(spark, d):
    """Ids appended where absent."""
    t = read(spark, d, "orders").groupBy("o_custkey").agg(F.collect_set(F.col("o_orderkey") % 30).alias("a"))
    u = F.array_sort(F.array_union("a", F.array(F.lit(5).cast("long"), F.lit(31).cast("long"))))
    return t.select("o_custkey", F.array_join(F.transform(u, lambda x: x.cast("string")), ",").alias("ids"))


@query("o8_collapse_publications", "select o_custkey as identity, count(distinct o_orderstatus) > 1 as conflict, first(o_orderpriority order by o_orderstatus, o_orderkey) as title from orders group by 1")
def collapse(spark, d):
    """Publications of one identity as one row, conflicts marked."""
    o = read(spark, d, "orders").selectExpr("o_custkey as identity", "o_orderstatus as print", "o_orderpriority as title", "o_orderstatus", "o_orderkey", "concat('l', o_orderkey) as locale")
    return M.collapse_publications(o, "identity", "print", ["o_orderstatus", "o_orderkey"], "locale", "title").select("identity", "conflict", "title")


@query("o9_url_rewrite", "select regexp_replace(url, '[?#].*$', '') as url, min(page_id) as page_id from pages group by 1")
def rewrite(spark, d):
    """Rewritten urls, the first of those that collide."""
    return M.rewrite_urls(read(spark, d, "pages"), "url", r"[?#].*$", "", ["page_id"]).select("url", "page_id")


UP = "t as (select id, external_id, first_seen, status from pt where id % 3 <> 0), i as (select id, 'n' || id as external_id, first_seen + interval 9 day as first_seen, 'open' as status from pt where id % 5 = 0)"


@query("u1_upsert", f"with {PT}, {UP} select id, coalesce(i.external_id, t.external_id) as external_id, coalesce(t.first_seen, i.first_seen) as first_seen, coalesce(i.status, t.status) as status from t full join i using (id)")
def upsert(spark, d):
    """Upsert with per-column policies."""
    t = table(spark, d, "id", "external_id", "first_seen", "status")
    inc = t.filter("id % 5 = 0").selectExpr("id", "concat('n', id) as external_id", "first_seen + interval 9 days as first_seen", "'open' as status")
    return M.upsert(t.filter("id % 3 <> 0"), inc, ["id"], {"external_id": "coalesce", "first_seen": "keep", "status": "replace"})


@query("u3_update_changed", f"with {PT} select t.id, case when t.id % 4 = 0 then case when t.id % 8 = 0 then t.title else 'New' end else t.title end as title, case when t.id % 4 = 0 and t.id % 8 <> 0 and t.title <> 'New' then {NOW} else first_seen end as stamp from pt t")
def update_changed(spark, d):
    """The stamp moves only with a value."""
    t = table(spark, d, "id", "title", "first_seen").withColumnRenamed("first_seen", "stamp")
    inc = t.filter("id % 4 = 0").selectExpr("id", "case when id % 8 = 0 then title else 'New' end as title")
    return M.update_changed(t, inc, "id", ["title"], "stamp", F.expr(NOW))


@query("u5_close_and_delete", f"with {PT} select id, case when status = 'open' and first_seen < {NOW} - interval 200 day then 'closed' else status end as status from pt where first_seen >= {NOW} - interval 900 day")
def close(spark, d):
    """Stale rows close, old rows go."""
    t = table(spark, d, "id", "status", "first_seen")
    return M.delete_older(M.close_stale(t, F.expr(NOW), 200, "first_seen"), F.expr(NOW), 900).select("id", "status")


@query("u10_backfill", f"with {PT} select id, coalesce(case when id % 2 = 0 then first_seen - interval 3 day end, first_seen) as posted_at from pt")
def backfill(spark, d):
    """Parsed text dates, else the first sight."""
    t = table(spark, d, "id", "first_seen").withColumn("raw", F.expr("case when id % 2 = 0 then date_format(first_seen - interval 3 days, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") when id % 3 = 0 then 'soon' end"))
    return t.select("id", F.coalesce(V.posted_at(F.col("raw"), F.expr(NOW)), "first_seen").alias("posted_at"))


DIFF = "e as (select 'u' || o_orderkey as url, 'b' || o_custkey % 5 as board, o_orderstatus <> 'F' as active from orders where o_orderkey % 10 <> 1), n as (select 'u' || o_orderkey as url, 'b' || (o_custkey + (o_orderkey % 9 = 0)::int) % 5 as board from orders where o_orderkey % 10 <> 2)"


@query("u11_snapshot_diff", f"with {DIFF} select n.url, n.board, case when e.board is null then 'new' when e.board = n.board and active then 'touched' when e.board = n.board then 'relisted' when active then 'foreign' else 'foreign_relisted' end as action from n left join e using (url)")
def snapshot_diff(spark, d):
    """What a discovered url is to the table."""
    o = read(spark, d, "orders")
    e = o.filter("o_orderkey % 10 <> 1").selectExpr("concat('u', o_orderkey) as url", "concat('b', o_custkey % 5) as board", "o_orderstatus <> 'F' as active")
    n = o.filter("o_orderkey % 10 <> 2").selectExpr("concat('u', o_orderkey) as url", "concat('b', (o_custkey + cast(o_orderkey % 9 = 0 as int)) % 5) as board")
    return M.snapshot_diff(e, n)


@query("u12_missing_counter", "select o_orderkey as id, case when o_orderkey % 10 <> 2 then 0 else o_custkey % 4 + 1 end as missing, case when o_orderkey % 10 <> 2 then true else o_orderstatus <> 'F' and o_custkey % 4 + 1 < 4 end as active from orders")
def missing(spark, d):
    """U12, T9 (batch): misses count up, four make a row inactive."""
    o = read(spark, d, "orders").selectExpr("o_orderkey as id", "o_custkey % 4 as missing", "o_orderstatus <> 'F' as active")
    return M.count_missing(o, o.filter("id % 10 <> 2"), "id", 4).select("id", "missing", "active")


@query("u13_gone_guard", """with runs as (select 'b' || user_id % 30 as board, cast(ts as date) as run, count(*) as discovered from events group by 1, 2), last as (select * from runs qualify row_number() over (partition by board order by run desc) <= 5),
med as (select board, median(discovered::double) as usual, count(*) as n from last group by 1), now as (select board, discovered, discovered % 4 as missing, 5 as active from runs qualify row_number() over (partition by board order by run) = 1)
select board, case when n >= 3 and discovered < usual * 0.7 then 'short' when missing / active > 0.5 then 'many_missing' else 'ok' end as guard from now left join med using (board)""")
def guard(spark, d):
    """Boards whose misses may not count."""
    runs = read(spark, d, "events").groupBy(F.expr("concat('b', user_id % 30)").alias("board"), F.col("ts").cast("date").alias("run")).agg(F.count("*").alias("discovered"))
    now = M.first_per_key(runs, ["board"], ["run"]).selectExpr("board", "discovered", "discovered % 4 as missing", "5 as active")
    return M.gone_guard(runs, now).select("board", "guard")


@query("u16_field_diff", "with o as (select o_orderkey as k, case when o_orderkey % 3 = 0 then null else o_custkey end as v, o_orderstatus as raw from orders), n as (select o_orderkey as k, case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then o_custkey + 1 when o_orderkey % 3 = 0 and o_orderkey % 2 = 0 then null else o_custkey end as v, case when o_orderkey % 11 = 0 then 'Z' else o_orderstatus end as raw from orders) select case when o.v is null and n.v is not null then 'added' when o.v is not null and n.v is null then 'lost' when o.v is distinct from n.v then 'changed' when o.raw is distinct from n.raw then 'raw_only' else 'same' end as kind, count(*) as n from o join n using (k) group by 1")
def field_diff(spark, d):
    """Change classes of a re-extracted field."""
    o = read(spark, d, "orders")
    a = o.selectExpr("o_orderkey as k", "case when o_orderkey % 3 = 0 then null else o_custkey end as v", "o_orderstatus as raw")
    b = o.selectExpr("o_orderkey as k", "case when o_orderkey % 5 = 0 then null when o_orderkey % 7 = 0 then o_custkey + 1 when o_orderkey % 3 = 0 and o_orderkey % 2 = 0 then null else o_custkey end as v", "case when o_orderkey % 11 = 0 then 'Z' else o_orderstatus end as raw")
    return M.field_diff(a, b, "k", "v", "raw").groupBy("kind").agg(F.count("*").alias("n"))


@query("u17_compare_and_set", f"with {PT} select id, case when id % 4 = 0 and status = 'open' then 'held' else status end as status, coalesce(id % 4 = 0 and status = 'open', false) as applied from pt")
def compare_and_set(spark, d):
    """Set where the value is still the one that was seen."""
    t = table(spark, d, "id", "status")
    return M.compare_and_set(t, t.filter("id % 4 = 0").selectExpr("id", "'open' as seen", "'held' as value"), "id", "status")


@query("u18_miss_counts", "with m as (select 'place' as taxonomy, o_orderpriority as value, count(*) as n, case when o_orderpriority = '5-LOW' then 'done' else 'pending' end as status from orders where o_orderkey % 2 = 0 and o_orderpriority <> '1-URGENT' group by 1, 2), f as (select 'place' as taxonomy, o_orderpriority as value, count(*) as k from orders where o_orderkey % 2 = 1 group by 1, 2) select taxonomy, value, case when n is null then k when status = 'pending' then n + coalesce(k, 0) else n end as n, coalesce(status, 'pending') as status from m full join f using (taxonomy, value)")
def misses(spark, d):
    """Counts of unresolved values, while pending."""
    o = read(spark, d, "orders").selectExpr("'place' as taxonomy", "o_orderpriority as value", "o_orderkey")
    m = o.filter("o_orderkey % 2 = 0 and value <> '1-URGENT'").groupBy("taxonomy", "value").agg(F.count("*").alias("n")).withColumn("status", F.when(F.col("value") == "5-LOW", "done").otherwise("pending"))
    return M.count_misses(m, o.filter("o_orderkey % 2 = 1"))


@query("u20_rename", "select c_custkey, case when c_mktsegment = 'BUILDING' then 'CONSTRUCTION' else c_mktsegment end as segment from customer")
def rename(spark, d):
    """Rows follow a renamed dimension value."""
    rows = read(spark, d, "customer").selectExpr("c_custkey", "c_mktsegment as segment")
    seg = rows.select(F.col("segment").alias("key"), "segment").distinct()
    return M.rename_propagation(rows, seg, seg.withColumn("segment", F.when(F.col("segment") == "BUILDING", "CONSTRUCTION").otherwise(F.col("segment"))), "key", "segment")


@query("u21_map_merge", "select event_id, cast(json_extract(props, '$.k') as bigint) + 1 as k, user_id as u from events")
def map_merge(spark, d):
    """Shallow merge of JSON maps, new keys win."""
    e = read(spark, d, "events").select("event_id", "user_id", F.from_json("props", "map<string,bigint>").alias("m"))
    m = M.merge_maps(F.col("m"), F.create_map(F.lit("k"), F.col("m")["k"] + 1, F.lit("u"), F.col("user_id")))
    return e.select("event_id", m["k"].alias("k"), m["u"].alias("u"))


@query("u23_changed_by_hash", "select c_custkey from (select c_custkey, c_name, c_acctbal, case when c_custkey % 9 = 0 then 'x' end as other from customer) where other is not null or c_custkey % 100 = 3 order by c_custkey limit 60")
def by_hash(spark, d):
    """Rows whose fingerprint differs from the stored one or has none, in order, bounded per run."""
    c = read(spark, d, "customer")
    now = c.select("c_custkey", M.fingerprint([F.col("c_name"), F.col("c_acctbal")]).alias("hash"))
    old = c.filter("c_custkey % 100 <> 3").select("c_custkey", M.fingerprint([F.when(F.col("c_custkey") % 9 == 0, "x").otherwise(F.col("c_name")), F.col("c_acctbal")]).alias("hash"))
    return M.changed_by_hash(now, old, ["c_custkey"], 60).select("c_custkey")


@query("u24_fill_from_canonical", "select c_custkey, c_name, c_mktsegment from customer")
def fill(spark, d):
    """Nulls filled from a canonical copy."""
    c = read(spark, d, "customer").select("c_custkey", "c_name", "c_mktsegment")
    holes = c.withColumn("c_name", F.when(F.col("c_custkey") % 3 != 0, F.col("c_name"))).withColumn("c_mktsegment", F.when(F.col("c_custkey") % 4 != 0, F.col("c_mktsegment")))
    return M.fill_from_canonical(holes, c, "c_custkey", ["c_name", "c_mktsegment"])


@query("t1_cursor_page", f"with {PT} select id, first_seen from pt where first_seen < timestamp '1997-06-01' and (first_seen > timestamp '1996-01-01' or (first_seen = timestamp '1996-01-01' and id > 100)) order by first_seen, id limit 2000")
def cursor(spark, d):
    """T1, T3 (batch): changed rows after a cursor and before the late-writer cutoff."""
    import datetime as dt

    return M.cursor_page(table(spark, d, "id", "first_seen"), "first_seen", "id", (dt.datetime(1996, 1, 1), 100), dt.datetime(1997, 6, 1), 2000)


@query("t6_high_water_mark", "select event_id from events where ts > timestamp '2024-01-20' or event_id % 50 = 0")
def high_water(spark, d):
    """Rows newer than the mark; rows without a time always."""
    e = read(spark, d, "events").withColumn("ts", F.when(F.col("event_id") % 50 != 0, F.col("ts")))
    return A.above_mark(e, "ts", "2024-01-20").select("event_id")


@query("t12_partitioned_reconcile", f"with {SNAP} select id % 16 as part, count(*) as n, count(*) filter (r.p is null) as missing, count(*) filter (l.p is null) as remote_only, count(*) filter (l.active <> r.active) as state_mismatch from l full join r using (id) group by 1")
def reconcile(spark, d):
    """Reconciliation of all id partitions in one job."""
    k = snapshot_compare(spark, d)
    n = lambda *names: F.count_if(F.col("kind").isin(*names))
    return k.groupBy((F.col("id") % 16).alias("part")).agg(F.count("*").alias("n"), n("missing").alias("missing"), n("remote_only_active", "remote_only_inactive").alias("remote_only"), n("state_mismatch").alias("state_mismatch"))
