"""Rollups, comparisons and weekly folds on hand-made and generated postings."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobmarket.functions.values import iso_week, week_bounds
from jobmarket.operators import compare as C
from jobmarket.operators import rollup as R
from jobmarket.plans import frame as P


def generated(spark, n=300):
    rows = spark.range(n).withColumnRenamed("id", "job_key")
    pay = F.lit(50_000.0) + F.col("job_key") % 101 * 1000
    raw = rows.select(
        "job_key", F.concat(F.lit("c"), F.col("job_key") % 7).alias("company_slug"), F.lit("b1").alias("board_slug"), F.lit("s").alias("source"), F.element_at(F.array(F.lit("Nurse"), F.lit("Engineer"), F.lit("Barista")), (F.col("job_key") % 3 + 1).cast("int")).alias("title_clean"),
        F.col("job_key").cast("string").substr(1, 1).alias("profile"), F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit("c")), (F.col("job_key") % 3 + 1).cast("int")).alias("job_family"), F.lit("mid").alias("seniority"), F.lit("full_time").alias("employment_type"), F.when(F.col("job_key") % 2 == 0, "remote").otherwise("onsite").alias("work_mode"),
        F.lit("US").alias("country"), F.lit("NA").alias("region"), F.lit(None).cast("string").alias("city"), F.lit(1).alias("n_locations"), F.lit(1).alias("n_countries"), pay.alias("sal_min"), pay.alias("sal_max"), F.lit("USD").alias("sal_currency"),
        F.lit("structured").alias("sal_source"), (F.col("job_key") % 9).cast("double").alias("yoe_min"), F.lit("bachelor").alias("education"), F.lit("offered").alias("visa"), F.lit(True).alias("equity"), F.lit(False).alias("clearance"), F.lit("en").alias("language"),
        F.lit("it").alias("industry"), F.lit("1-50").alias("company_size"), F.lit("old").alias("company_age"), F.lit(100).alias("posted_day"), F.array(F.lit("x"), F.lit("y")).alias("technologies"),
    )
    return P.enrich(raw, P.fx(spark), 101).withColumn("is_new", F.lit(False))


def test_one_way_counts_and_median(spark):
    df = generated(spark).cache()
    m = R.one_way(df)
    got = {(r["dim"], r["bucket"]): r for r in m.collect()}
    assert [got["job_family", b]["j"] for b in "abc"] == [100, 100, 100]
    assert got["_all", "all"]["c"] == 7 and got["technology", "x"]["j"] == 300 and got["city", "unknown"]["j"] == 300
    q = R.quantiles(R.histograms(df, m).filter("hist = 's'"), ["dim", "bucket"]).filter("dim = '_all'").first()
    exact = df.agg(F.median("sal_usd")).first()[0]
    assert abs(q["p50"] / exact - 1) < 0.01


def test_quantile_of_even_steps(spark):
    values = spark.range(101).select(F.round(F.log(50_000 + F.col("id") * 1000) * 100).cast("int").alias("bin"))
    q = R.quantiles(values.groupBy("bin").agg(F.count("*").alias("cnt")).withColumn("k", F.lit(1)), ["k"]).first()
    assert abs(q["p50"] - 100_000) <= 1_000


def test_merge_then_subtract_restores(spark):
    df = generated(spark)
    one, two = R.one_way(df.filter("job_key < 250")), R.one_way(df.filter("job_key >= 50"))
    measures = ["j", "r", "sn"]
    back = R.merge([(one, 1), (two, 1), (two, -1)], ["dim", "bucket"], measures)
    key = lambda d: sorted((r["dim"], r["bucket"], *(r[m] for m in measures)) for r in d.collect())
    assert key(back) == key(one)


def test_compare_two_days(spark):
    frame = lambda rows, cols: spark.createDataFrame(rows, cols)
    prev = frame([(1, 10, 5), (2, 10, 5), (3, 20, 5)], "job_key long, board long, first_day int")
    today = frame([(2, 10), (4, 10)], "job_key long, board long")
    boards = frame([(10,), (20,)], "board long")
    c = C.compare(prev, boards, today, boards.filter("board = 20"), boards.filter("board = 10"), 6)
    assert [r["job_key"] for r in c.new.collect()] == [4]
    assert [(r["job_key"], r["days_open"]) for r in c.removed.collect()] == [(1, 1)]
    assert [r["job_key"] for r in c.carried.collect()] == [3]
    assert sorted((r["job_key"], r["first_day"]) for r in c.state.collect()) == [(2, 5), (3, 5), (4, 6)]


def test_newly_covered_board_is_not_new(spark):
    prev = spark.createDataFrame([(1, 10, 5)], "job_key long, board long, first_day int")
    today = spark.createDataFrame([(1, 10), (9, 30)], "job_key long, board long")
    seen = spark.createDataFrame([(10,)], "board long")
    none = seen.limit(0)
    c = C.compare(prev, seen, today, none, spark.createDataFrame([(10,), (30,)], "board long"), 6)
    assert c.new.count() == 0
    later = C.compare(c.state, c.boards, today.union(spark.createDataFrame([(10, 30)], "job_key long, board long")), none, seen, 7)
    assert [r["job_key"] for r in later.new.collect()] == [10]


def test_snapshot_algebra(spark):
    prev = spark.range(50).select(F.col("id").alias("job_key"), (F.col("id") % 5).alias("board"), F.lit(1).alias("first_day"))
    today = spark.range(20, 80).select(F.col("id").alias("job_key"), (F.col("id") % 5).alias("board"))
    boards = prev.select("board").distinct()
    c = C.compare(prev, boards, today, boards.limit(0), boards, 2)
    assert today.count() == prev.count() + c.new.count() - c.removed.count()


@pytest.mark.parametrize("day, week, first, last", [("2026-10-09", "2026-W41", "2026-10-05", "2026-10-11"), ("2027-01-01", "2026-W53", "2026-12-28", "2027-01-03")])
def test_iso_week(spark, day, week, first, last):
    a, b = week_bounds(F.col("d"))
    r = spark.createDataFrame([(dt.date.fromisoformat(day),)], "d date").select(iso_week(F.col("d")).alias("w"), a.alias("a"), b.alias("b")).first()
    assert (r["w"], str(r["a"]), str(r["b"])) == (week, first, last)


def test_cross_rows_drop_small_cells(spark):
    cells = R.two_way(generated(spark), (("job_family", "work_mode", None),))
    rows = R.cross_rows(cells.withColumn("j", F.when(F.col("a") == "a", 2).otherwise(F.col("j")))).collect()
    assert {r["a"] for r in rows} == {"b", "c"} and all(abs(sum(x["share"] for x in rows if x["a"] == r["a"]) - 100) < 0.1 for r in rows)


def test_companies_are_counted_by_bits_and_medians_by_units(spark):
    from statistics import median

    df = generated(spark)
    rows = df.select("company_slug", "profile", "title_clean", "technologies", "sal_usd").collect()
    dims = tuple(R.BY_NAME[n] for n in ("_all", "profile", "company", "technology"))
    due = {}
    for r in rows:
        for key in [("_all", "all"), ("profile", r["profile"] or "unknown"), ("company", r["company_slug"] or "unknown"), *[("technology", t or "unknown") for t in r["technologies"] or ["unknown"]]]:
            due.setdefault(key, set()).update({r["company_slug"]} - {None})
    sizes = spark.createDataFrame(list(due), "dim string, bucket string")
    got = {(r["dim"], r["bucket"]): r["c"] for r in R.companies(df, sizes, dims).collect()}
    assert got == {k: len(v) for k, v in due.items() if v}
    # No task holds the values of a group: medians come from counts.
    plan = P.relative_pay(df.drop("rel"))._jdf.queryExecution().optimizedPlan().toString()
    assert "median(" not in plan and "percentile(" not in plan
    values = spark.createDataFrame([("a", 1.25), ("a", 1.75), ("a", 9.5), ("a", 1.5), ("b", 2.0), ("b", None), (None, 3.5), (None, 4.0)], "g string, v double")
    got = {r["g"]: (r["median"], r["n"]) for r in P.medians(values, "g", "v").collect()}
    assert got == {"a": (median([1.25, 1.75, 9.5, 1.5]), 4), "b": (2.0, 1), None: (3.75, 2)}
