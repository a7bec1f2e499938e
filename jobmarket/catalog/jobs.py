"""Queries of the composite jobs, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.catalog import attributes as AT
from jobmarket.catalog import reports as RP
from jobmarket.functions import text as T
from jobmarket.functions import values as V
from jobmarket.operators import rollup as R
from jobmarket.operators import tables as M
from jobmarket.plans import jobs as J
from jobmarket.plans.frame import read

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


CASES = lambda i: "case " + " ".join(f"when {AT.rx('title', '(?i)' + r[2])} then '{r[i]}'" for r in J.PROFILES) + " else 'other' end"


@query("c2_profile", f"with {AT.TT} select o_orderkey, {CASES(0)} as profile, {CASES(1)} as family from tt")
def profile(spark, d):
    """Ordered title rules."""
    name, family = J.profile(F.col("title"))
    return AT.titled(spark, d).select("o_orderkey", name.alias("profile"), family.alias("family"))


@query("c15_unified_pay", "with g as (select l_orderkey, l_returnflag as currency, l_linestatus as unit, count(*) as n, min(l_extendedprice) as lo, max(l_extendedprice) as hi from lineitem group by 1, 2, 3) select l_orderkey, currency, unit, n, lo as min, hi as max from g qualify row_number() over (partition by l_orderkey order by n desc, currency, unit) = 1")
def unified(spark, d):
    """The largest group of ranges of one key."""
    r = read(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").alias("min"), F.col("l_extendedprice").alias("max"), F.col("l_returnflag").alias("currency"), F.col("l_linestatus").alias("unit"))
    return J.unified_pay(r, "l_orderkey")


@query("c17_euro_pay", "select o_orderkey, cast(round(o_totalprice * case o_orderkey % 4 when 0 then 2080 when 1 then 12 else 1 end * 0.5, 0) as bigint) as eur from orders")
def euro(spark, d):
    """C17: whole euros a year."""
    unit = F.expr("case o_orderkey % 4 when 0 then 'hour' when 1 then 'month' else 'year' end")
    return read(spark, d, "orders").select("o_orderkey", V.euro_pay(F.col("o_totalprice"), unit, F.lit(0.5)).alias("eur"))


@query("c21_hierarchical_place", """with n as (select lower(n_name) as name, n_nationkey as place_id, lower(r_name) as parent, n_nationkey * 10 as population from nation join region on n_regionkey = r_regionkey union all select lower(n_name), n_nationkey + 100, 'nowhere', n_nationkey * 20 from nation),
p as (select c_custkey as id, lower(n_name) as a, case when c_custkey % 2 = 0 then lower(r_name) else 'x' end as b from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey)
select id, place_id from p join n on n.name = p.a qualify row_number() over (partition by id order by (parent = b)::int desc, population desc, place_id) = 1""")
def hierarchical(spark, d):
    """Names matched with their context, then by population."""
    places = read(spark, d, "nation").join(read(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    names = places.selectExpr("lower(n_name) as name", "n_nationkey as place_id", "lower(r_name) as parent", "n_nationkey * 10 as population").unionByName(places.selectExpr("lower(n_name) as name", "n_nationkey + 100 as place_id", "'nowhere' as parent", "n_nationkey * 20 as population"))
    texts = read(spark, d, "customer").join(places, F.expr("c_nationkey = n_nationkey")).selectExpr("c_custkey as id", "concat(n_name, ', ', case when c_custkey % 2 = 0 then r_name else 'x' end) as text")
    return J.located(texts, names)


@query("c22_work_mode", "select o_orderkey, case when o_orderkey % 5 = 0 then 'remote' when o_orderkey % 5 = 1 then 'onsite' when o_custkey % 3 = 0 then 'hybrid' when o_custkey % 3 = 1 then 'remote' else 'unspecified' end as mode from orders")
def work_mode(spark, d):
    """Known raw values, else flags of the places."""
    o = read(spark, d, "orders")
    raw = F.expr("case o_orderkey % 5 when 0 then 'Remote (US)' when 1 then 'On-site' when 2 then '' when 3 then 'elsewhere' end")
    places = F.expr("array(named_struct('mode', case o_custkey % 3 when 0 then 'remote' when 1 then 'remote' end), named_struct('mode', case o_custkey % 3 when 0 then 'hybrid' end))")
    return o.select("o_orderkey", V.work_mode(raw, places).alias("mode"))


@query("c23_employment_and_unit", "select o_orderkey, case o_orderkey % 5 when 0 then 'full_time' when 1 then 'contract' when 2 then 'unspecified' when 3 then 'other' else 'part_time' end as employment, case o_orderkey % 4 when 0 then 'hour' when 1 then 'year' when 2 then 'month' end as unit from orders")
def employment(spark, d):
    """Alias maps with fallbacks."""
    e = F.expr("case o_orderkey % 5 when 0 then ' Full-Time' when 1 then 'Contractor' when 2 then '' when 3 then 'gig' else 'part time' end")
    u = F.expr("case o_orderkey % 4 when 0 then 'HR' when 1 then 'paid annually' when 2 then 'USD/month' else 'piece' end")
    u = F.when(u == "paid annually", "annually").otherwise(u)
    return read(spark, d, "orders").select("o_orderkey", T.employment_type(e, J.EMPLOYMENT).alias("employment"), J.salary_unit(u).alias("unit"))


@query("c40_description_assembly", f"with {AT.TT} select o_orderkey, length(case when position(title in note) > 0 or length(trim(title)) <= 3 then note else note || chr(10) || chr(10) || title end) as n from tt")
def description(spark, d):
    """Sections appended unless they are there already."""
    return AT.titled(spark, d).select("o_orderkey", F.length(T.assembled_description(F.col("note"), [F.col("title"), F.lit("N/A")])).cast("long").alias("n"))


@query("c43_mojibake", "select doc_id, length(replace(replace(text || 'Ã©', 'Ã©', 'é'), 'Ã¼', 'ü')) as n from documents")
def mojibake(spark, d):
    """Double-encoded sequences by a table."""
    return read(spark, d, "documents").select("doc_id", F.length(T.repair_mojibake(F.concat("text", F.lit("Ã©")))).cast("long").alias("n"))


@query("r1_derive_postings")
def derive(spark, d):
    """Raw postings to derived attributes, text extraction once per distinct text."""
    t = AT.titled(spark, d)
    raw = t.select(F.concat(F.lit("c"), F.col("o_orderkey") % 50).alias("company_slug"), F.concat(F.lit("https://x/"), "o_orderkey").alias("url"), "title", F.col("note").alias("description"), F.lit(None).cast("string").alias("source_identity"), F.lit("Full-time").alias("employment_type"), F.lit(None).cast("string").alias("language"), F.col("raw_date").alias("date_posted"))
    return J.derive(raw, F.lit("2024-06-01").cast("timestamp"))


@query("r9_report_sections")
def sections(spark, d):
    """Report rows as one document per dimension."""
    dims = tuple(R.BY_NAME[n] for n in ("_all", "profile", "work_mode", "seniority"))
    df, m = RP.rolled(spark, d, dims)
    return J.section(R.bucket_rows(m, R.histograms(df, m, dims)), ["profile", "work_mode", "seniority"]).select("dim", "n_rows", F.length("document").alias("n_chars"))


@query("r14_baseline", "with t as (select cast(o_orderdate as date) as day, o_orderpriority as bucket, count(*) as j from orders group by 1, 2), l as (select max(day) as day from t where day < date '1997-01-01') select bucket, j from t join l using (day)")
def baseline(spark, d):
    """The comparison base is the last day before today."""
    t = read(spark, d, "orders").groupBy(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("bucket")).agg(F.count("*").alias("j"))
    last = t.filter("day < date'1997-01-01'").agg(F.max("day").alias("day"))
    return t.join(F.broadcast(last), "day").select("bucket", "j")


@query("r16_week_finalisation", "with w as (select date_trunc('week', o_orderdate)::date as week, count(*) as j, count(distinct cast(o_orderdate as date)) as days from orders group by 1) select week, j, days, week < date '1998-01-05' as final from w")
def finalisation(spark, d):
    """Weeks before the current one are final."""
    w = read(spark, d, "orders").groupBy(F.date_trunc("week", "o_orderdate").cast("date").alias("week")).agg(F.count("*").alias("j"), F.count_distinct(F.col("o_orderdate").cast("date")).alias("days"))
    return w.withColumn("final", F.col("week") < F.lit("1998-01-05").cast("date"))


@query("u9_snapshot_upsert", "with s as (select cast(o_orderdate as date) as day, count(*) as n from orders where o_orderkey % 2 = 0 group by 1), n as (select cast(o_orderdate as date) as day, count(*) as n from orders where o_orderdate >= timestamp '1998-01-01' group by 1) select day, coalesce(n.n, s.n) as n from s full join n using (day)")
def snapshot_upsert(spark, d):
    """The row of a date is replaced."""
    o = read(spark, d, "orders")
    per = lambda df: df.groupBy(F.col("o_orderdate").cast("date").alias("day")).agg(F.count("*").alias("n"))
    return M.upsert(per(o.filter("o_orderkey % 2 = 0")), per(o.filter("o_orderdate >= timestamp'1998-01-01'")), ["day"], {})


@query("u14_terminal_sweep", "select o_orderkey, case when o_custkey % 10 > 6 then 'live' when o_custkey % 10 < 2 then 'blocked' else 'eligible' end as class, o_orderstatus <> 'F' and not (o_custkey % 10 between 2 and 6) as active from orders")
def sweep(spark, d):
    """Postings of gone boards."""
    p = read(spark, d, "orders").selectExpr("o_orderkey", "o_custkey % 10 as board", "o_orderstatus <> 'F' as active")
    b = p.select("board").distinct().withColumn("status", F.when(F.col("board") > 6, "ok").otherwise("gone"))
    return J.terminal_sweep(p, b, b.filter("board < 2").select("board")).select("o_orderkey", "class", "active")


@query("u15_owner_realignment", "select o_orderkey, case when o_custkey % 10 < 3 then 'new' || o_custkey % 10 else 'c' || o_custkey end as company from orders")
def realign(spark, d):
    """Postings follow their board's company."""
    p = read(spark, d, "orders").selectExpr("o_orderkey", "o_custkey % 10 as board", "concat('c', o_custkey) as company")
    b = p.filter("board < 3").selectExpr("board", "concat('new', board) as company").distinct()
    return J.realigned(p, b).select("o_orderkey", "company")


@query("u19_miss_resolution", "select o_orderkey, case when o_orderkey % 3 = 0 then 100 when o_orderpriority in ('1-URGENT', '2-HIGH') then 7 end as key, case when o_orderpriority in ('1-URGENT', '2-HIGH') and o_custkey % 9 <> 7 then 2 else 1 end as n_ids from orders")
def miss_resolution(spark, d):
    """Pending values that match now fill keys and id lists."""
    rows = read(spark, d, "orders").selectExpr("o_orderkey", "o_orderpriority as value", "case when o_orderkey % 3 = 0 then 100 end as key", "array(cast(o_custkey % 9 as int)) as ids")
    misses = rows.select("value").distinct().withColumn("status", F.when(F.col("value") == "5-LOW", "done").otherwise("pending"))
    matched = misses.filter("value in ('1-URGENT', '2-HIGH', '5-LOW')").select("value", F.lit(7).alias("match"))
    return J.resolved_misses(rows, misses, matched).select("o_orderkey", "key", F.size("ids").cast("long").alias("n_ids"))


@query("u22_enrichment_merge", "select o_orderkey as id, case when o_orderkey % 4 = 0 then 'r' || o_orderkey % 7 when o_orderkey % 3 = 0 then o_orderpriority end as occupation, o_orderkey % 4 = 0 and o_orderkey % 8 <> 0 as requeue from orders")
def enrichment(spark, d):
    """Resolved ids win, old ones stay, invalid answers are queued again."""
    o = read(spark, d, "orders").selectExpr("o_orderkey as id", "case when o_orderkey % 3 = 0 then o_orderpriority end as occupation", "false as requeue")
    got = read(spark, d, "orders").filter("o_orderkey % 4 = 0").selectExpr("o_orderkey as id", "concat('r', o_orderkey % 7) as occupation", "o_orderkey % 8 <> 0 as requeue")
    return M.upsert(o, got, ["id"], {"occupation": "coalesce", "requeue": "replace"})


@query("r22_hierarchy_closure", "with e as (select 'n' || n_nationkey as node, 'r' || n_regionkey as parent from nation union all select 'r' || r_regionkey, 'world' from region) select node, node as ancestor from e union select node, parent from e union select a.node, b.parent from e a join e b on a.parent = b.node")
def closure(spark, d):
    """Ancestors of every place."""
    from jobmarket.plans.analytics import ancestors

    nodes = read(spark, d, "nation").selectExpr("concat('n', n_nationkey) as node", "concat('r', n_regionkey) as parent").unionByName(read(spark, d, "region").selectExpr("concat('r', r_regionkey) as node", "'world' as parent"))
    return ancestors(nodes, 3)


@query("r23_reprocess", f"with {AT.TT}, x as (select o_orderkey, {AT.BOARD} as new, case when o_orderkey % 4 = 0 then 'mid' when o_orderkey % 9 = 0 then null else {AT.BOARD} end as old from tt) select case when old is null then 'added' when old <> new then 'changed' else 'same' end as kind, count(*) as n from x group by 1")
def reprocess(spark, d):
    """Candidates re-extracted and compared with what is stored (dry run)."""
    t = AT.titled(spark, d).select("o_orderkey", "title", T.board_seniority(F.col("title")).alias("v"))
    old = t.select("o_orderkey", F.expr("case when o_orderkey % 4 = 0 then 'mid' when o_orderkey % 9 = 0 then null else v end").alias("v"), F.col("title").alias("raw"))
    return M.field_diff(old, t.select("o_orderkey", "v", F.col("title").alias("raw")), "o_orderkey", "v", "raw").groupBy("kind").agg(F.count("*").alias("n"))
