"""Exports and reconciliation that go on where they ended, and table functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobmarket.plans import table_functions as TF
from jobmarket.streaming import cursors as CU

T0 = dt.datetime(2024, 1, 1)
SCHEMA = "id long, ts timestamp"


def at(minutes):
    return T0 + dt.timedelta(minutes=minutes)


def test_export_goes_on_without_a_row_twice_or_lost(spark, tmp_path):
    rows = [(i, at(i // 3)) for i in range(90)] + [(900, None), (None, at(1)), (901, at(2)), (901, at(2))]
    source = spark.createDataFrame(rows, SCHEMA)
    sinks, state = {n: str(tmp_path / n) for n in ("a", "b")}, str(tmp_path / "state")
    run = lambda end, **more: CU.export(source, "ts", "id", sinks, state, F.lit(end), **more)
    got = lambda n: sorted(r["id"] for r in CU.exported(spark, sinks[n], state, n, "id long, ts timestamp").collect())
    due = lambda end: sorted(i for i, t in rows if i is not None and t is not None and t < end)
    assert got("a") == [] and CU.Cursors(spark, state, "ts timestamp, id long").least(["a", "b"]) is None
    with pytest.raises(RuntimeError):
        run(at(10), fail_before_cursor="b")
    assert got("a") == due(at(10)) and got("b") == []
    # More rows come with the time of the last one, and a sink that broke off writes its first step anew.
    rows += [(2000, at(9)), (2001, at(12))]
    source = spark.createDataFrame(rows, SCHEMA)
    assert run(at(20)) == {"a": 2, "b": 1}
    assert got("a") == got("b") == due(at(20))
    assert run(at(20)) == {"a": 0, "b": 0} and run(at(60)) == {"a": 3, "b": 2}
    assert got("a") == got("b") == due(at(60))
    assert CU.Cursors(spark, state, "ts timestamp, id long").least(["a", "b"]) == (at(29), 89)


def test_fence_waits_for_open_writers(spark):
    one = lambda df: spark.range(1).select(CU.fence(df, F.lit(at(60)), "10 minutes").alias("f")).first()["f"]
    writers = spark.createDataFrame([(at(30),), (at(40),)], "started_at timestamp")
    assert one(writers) == at(30) and one(writers.limit(0)) == at(50)


def test_reconcile_reads_only_what_differs_and_goes_on(spark, tmp_path):
    a = spark.createDataFrame([(i, f"v{i % 7}", i) for i in range(2000)], "id long, v string, w int")
    b = spark.createDataFrame([(i, "x" if i == 77 else f"v{i % 7}", None if i == 500 else i) for i in range(1, 2001)], "id long, v string, w int")
    args = (a, b, "id", ["v", "w"], str(tmp_path / "r"))
    first = CU.reconcile(*args, buckets=64, at_once=1, stop_after=2)
    steps = lambda: sorted(p.name for p in (tmp_path / "r" / "found").iterdir())
    assert steps() == ["step=0", "step=1"] and first.count() >= 2
    before = {p.name: p.stat().st_mtime_ns for p in (tmp_path / "r" / "found").glob("step=*/_SUCCESS")}
    # Half of a step that was not complete is written anew; complete steps are not touched.
    (tmp_path / "r" / "found" / "step=2").mkdir()
    got = {(r["id"], r["kind"]) for r in CU.reconcile(*args, buckets=64, at_once=1).collect()}
    assert got == {(0, "missing there"), (2000, "missing here"), (77, "changed"), (500, "changed")}
    assert len(steps()) == 4
    assert CU.reconcile(a, a.orderBy(F.desc("id")), "id", ["v", "w"], str(tmp_path / "same")).count() == 0 and not (tmp_path / "same" / "found").exists()
    assert CU.reconcile(a.limit(0), b.limit(0), "id", ["v"], str(tmp_path / "none")).count() == 0


def test_table_functions_push_their_parameters_down(spark, tmp_path):
    rows = [(i, t, c, s, "mid", w, at(i)) for i, (t, c, s, w) in enumerate([("Data Engineer", "a", "open", "remote"), ("Engineer, Data data", "b", "open", "onsite"), ("Data", "a", "closed", "remote"), ("engineers data", "a", "open", None), (None, "b", "open", "remote")])]
    spark.createDataFrame(rows, "id long, title string, company_slug string, status string, seniority string, work string, first_seen timestamp").write.parquet(str(tmp_path / "jobs"))
    spark.read.parquet(str(tmp_path / "jobs")).createOrReplaceTempView("jobs_of_test")
    TF.register(spark, "jobs_of_test")
    ids = lambda q: [r["id"] for r in spark.sql(q).orderBy("place").collect()]
    assert ids("select * from search_jobs('data engineer')") == [1, 0] and ids("select * from search_jobs()") == [4, 3, 1, 0]
    assert ids("select * from search_jobs(p_query => 'data', p_status => 'any', p_limit => 1, p_offset => 1)") == [3] and ids("select * from search_jobs(p_query => 'data', p_offset => -5)") == [1, 3, 0]
    assert ids("select * from list_jobs(p_companies => array('a'), p_work => 'remote')") == [0] and ids("select * from list_jobs(p_companies => array())") == [4, 3, 1, 0]
    assert spark.sql("select distinct total from list_jobs(p_limit => 2)").first()["total"] == 4
    assert {r["company_slug"]: r["jobs"] for r in spark.sql("select * from job_analytics(p_status => 'any')").collect()} == {"a": 3, "b": 2}
    plan = spark.sql("select id from list_jobs(p_work => 'remote')")._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(status,open)" in plan and "EqualTo(work,remote)" in plan
