"""Queries of table functions, of exports that go on from a cursor and of reconciliation with progress, and their twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.plans import table_functions as TF
from jobmarket.plans.frame import read
from jobmarket.sources.tables import staging
from jobmarket.streaming import cursors as CU

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


JOBS = """select o_orderkey as id, concat(case o_orderkey % 3 when 0 then 'Senior ' when 1 then 'Data ' else '' end, 'Engineer ', o_custkey % 7) as title, concat('c', o_custkey % 50) as company_slug, case when o_orderkey % 4 = 0 then 'closed' else 'open' end as status,
o_orderstatus as seniority, case when o_orderkey % 2 = 0 then 'remote' else 'onsite' end as work, o_orderdate as first_seen from orders"""
_OPEN = f"with j as ({JOBS}) "


def _jobs(spark, d):
    read(spark, d, "orders").createOrReplaceTempView("orders")
    spark.sql(JOBS).createOrReplaceTempView("jobs_view")
    TF.register(spark, "jobs_view")


@query("x2_search_function", _OPEN + ", f as (select *, len(list_filter(string_split_regex(lower(title), '[^a-z0-9]+'), lambda w: w in ('engineer', 'data', '3'))) as hits from j where status = 'open' and work = 'onsite' and contains(title, 'Data') and title like '%3') select id, title, hits::int as hits, count(*) over () as total from f order by hits desc, first_seen desc, id desc limit 25 offset 10")
def search_function(spark, d):
    """A search by a SQL function with named parameters."""
    _jobs(spark, d)
    return spark.sql("select id, title, hits, total from search_jobs(p_query => 'Data ENGINEER 3', p_work => 'onsite', p_limit => 25, p_offset => 10)")


@query("x2_list_function", _OPEN + "select id, company_slug, count(*) over () as total from j where company_slug in ('c1', 'c2') and seniority = 'O' order by first_seen desc, id desc limit 30")
def list_function(spark, d):
    """A list with array filters by a SQL function."""
    _jobs(spark, d)
    return spark.sql("select id, company_slug, total from list_jobs(p_status => 'any', p_companies => array('c1', 'c2'), p_seniorities => array('O'), p_limit => 30)")


@query("x2_analytics_function", _OPEN + "select company_slug, count(*) as jobs, max(first_seen) as newest, array_to_string(list_sort(list(distinct seniority)), ',') as seniorities from j where status = 'open' group by 1")
def analytics_function(spark, d):
    """Analytics by a SQL function."""
    _jobs(spark, d)
    return spark.sql("select company_slug, jobs, newest, array_join(seniorities, ',') as seniorities from job_analytics()")


@query("t1_cursor_export", "select event_id, 'far' as sink, case when ts < timestamp '2024-01-10' then 1 when ts < timestamp '2024-01-20' then 2 else 3 end as step from events where ts < timestamp '2024-01-28' union all select event_id, 'near', case when ts < timestamp '2024-01-20' then 1 else 2 end from events where ts < timestamp '2024-01-28'")
def cursor_export(spark, d):
    """Events to two sinks in three runs; the second sink breaks off in the first run and catches up; the last run
    ends before a writer that is still open."""
    events, root = read(spark, d, "events").select("event_id", "ts"), staging(spark)
    sinks = {n: f"{root}/{n}" for n in ("far", "near")}
    at = lambda t: F.lit(t).cast("timestamp")
    try:
        CU.export(events, "ts", "event_id", sinks, f"{root}/state", at("2024-01-10"), fail_before_cursor="near")
    except RuntimeError:
        pass
    CU.export(events, "ts", "event_id", sinks, f"{root}/state", at("2024-01-20"))
    writers = spark.createDataFrame([("2024-01-28",), ("2024-02-02",)], "t string").select(F.col("t").cast("timestamp").alias("started_at"))
    CU.export(events, "ts", "event_id", sinks, f"{root}/state", CU.fence(writers, at("2024-03-01")))
    out = [CU.exported(spark, sinks[n], f"{root}/state", n, "event_id long, ts timestamp").select("event_id", F.lit(n).alias("sink"), "step") for n in sinks]
    return out[0].unionByName(out[1])


_REMOTE = "select o_orderkey, case when o_orderkey % 900 = 7 then o_totalprice + 1 else o_totalprice end as o_totalprice, case when o_orderkey % 1100 = 3 then null else o_orderstatus end as o_orderstatus from orders where o_orderkey % 1000 <> 5 union all select -o_orderkey, o_totalprice, o_orderstatus from orders where o_orderkey % 2000 = 9"


@query("t12_resumable_reconcile", f"with r as ({_REMOTE}) select coalesce(o.o_orderkey, r.o_orderkey) as o_orderkey, case when r.o_orderkey is null then 'missing there' when o.o_orderkey is null then 'missing here' else 'changed' end as kind from orders o full join r on o.o_orderkey = r.o_orderkey where r.o_orderkey is null or o.o_orderkey is null or o.o_totalprice is distinct from r.o_totalprice or o.o_orderstatus is distinct from r.o_orderstatus")
def resumable(spark, d):
    """Two copies of orders by digests of id buckets, ended after the first step and taken up again."""
    read(spark, d, "orders").createOrReplaceTempView("orders")
    args = (read(spark, d, "orders"), spark.sql(_REMOTE), "o_orderkey", ["o_totalprice", "o_orderstatus"], staging(spark))
    CU.reconcile(*args, stop_after=1)
    return CU.reconcile(*args)
