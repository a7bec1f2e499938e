"""The posting frame: the driver's tables as postings, and its enrichment.

``postings`` reads orders as postings: an order is a posting, its customer the company, the customer's nation the
country; pay, work mode and the other attributes are fixed functions of the keys, and a posting's technologies are the
brands of its order's parts. ``SQL`` is the same frame for DuckDB, to stand before a query as common table expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: US dollars per unit of currency, work modes, visa and education signals, seniority by order status.
RATES = {"USD": 1.0, "EUR": 1.08, "GBP": 1.27}
PLAUSIBLE_USD = (5_000, 2_000_000)
MAX_RANGE_RATIO = 4.0
MEDIAN_MIN_ROWS = 5

#: Column expressions that both engines read alike. o: orders, c: customer, n: nation, r: region.
COLUMNS = {
    "job_key": "o_orderkey",
    "company_slug": "concat('c', o_custkey)",
    "board_slug": "concat('b', o_custkey % 20)",
    "source": "concat('src', o_custkey % 5)",
    "title_clean": "concat('Title ', o_orderkey % 60)",
    "profile": "o_orderpriority",
    "job_family": "c_mktsegment",
    "seniority": "case o_orderstatus when 'O' then 'mid' when 'F' then 'senior' else 'entry' end",
    "employment_type": "case when o_orderkey % 9 = 0 then 'contract' else 'full_time' end",
    "work_mode": "case o_orderkey % 4 when 0 then 'remote' when 1 then 'hybrid' when 2 then 'onsite' else 'unspecified' end",
    "country": "n_name",
    "region": "r_name",
    "city": "case when o_custkey % 6 = 0 then null else concat('City ', o_custkey % 30) end",
    "n_locations": "cast(o_orderkey % 4 as int)",
    "n_countries": "cast(case when o_orderkey % 8 = 3 then 2 else 1 end as int)",
    "sal_min": "case when o_orderkey % 7 = 0 then null else o_totalprice * 0.9 end",
    "sal_max": "case when o_orderkey % 7 = 0 then null when o_orderkey % 13 = 0 then o_totalprice * 5 else o_totalprice * 1.1 end",
    "sal_currency": "case when o_orderkey % 7 = 0 then null when o_orderkey % 3 = 0 then 'EUR' when o_orderkey % 3 = 1 then 'USD' when o_orderkey % 17 = 0 then 'XAU' else 'GBP' end",
    "sal_source": "case when o_orderkey % 7 = 0 then 'none' when o_orderkey % 2 = 0 then 'structured' else 'description' end",
    "yoe_min": "case when o_orderkey % 4 = 1 then null else (o_orderkey % 47) / 2.0 end",
    "education": "case o_orderkey % 5 when 0 then 'bachelor' when 1 then 'master' when 2 then 'phd' else 'none_stated' end",
    "visa": "case when o_orderkey % 6 = 0 then 'offered' when o_orderkey % 6 = 1 then 'not_offered' else 'not_mentioned' end",
    "equity": "o_orderkey % 3 = 0",
    "clearance": "o_orderkey % 11 = 0",
    "language": "case when o_custkey % 10 = 0 then 'de' else 'en' end",
    "industry": "c_mktsegment",
    "company_size": "case when c_acctbal < 0 then '1-50' when c_acctbal < 5000 then '51-500' else '501+' end",
    "company_age": "case when o_custkey % 3 = 0 then 'young' else 'old' end",
}
DAY_SPARK = "datediff(o_orderdate, date'1970-01-01')"
DAY_DUCK = "cast(date_diff('day', date '1970-01-01', cast(o_orderdate as date)) as int)"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def postings(spark: SparkSession, sf_dir: str, technologies: bool = True) -> DataFrame:
    """Orders as postings. The dimension joins are on small tables; technologies come from one join and aggregation."""
    t = lambda name: read(spark, sf_dir, name)
    company = t("customer").join(t("nation"), F.expr("c_nationkey = n_nationkey"), "left").join(t("region"), F.expr("n_regionkey = r_regionkey"), "left")
    df = t("orders").join(company, F.expr("o_custkey = c_custkey"), "left")
    df = df.select(*[F.expr(e).alias(c) for c, e in COLUMNS.items()], F.expr(DAY_SPARK).alias("posted_day"))
    return with_technologies(df, spark, sf_dir) if technologies else df


def with_technologies(df: DataFrame, spark: SparkSession, sf_dir: str) -> DataFrame:
    line, part = read(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey"), read(spark, sf_dir, "part").select("p_partkey", "p_brand")
    tech = line.join(part, F.expr("l_partkey = p_partkey")).groupBy("l_orderkey").agg(F.array_sort(F.collect_set("p_brand")).alias("technologies"))
    return df.join(tech, df["job_key"] == tech["l_orderkey"], "left").drop("l_orderkey")


def fx(spark: SparkSession, rates: dict[str, float] | None = None) -> DataFrame:
    """(sal_currency, rate): a handful of rows."""
    return spark.createDataFrame(list((rates or RATES).items()), "sal_currency string, rate double")


def band(value: Column, bounds: list[float], names: list[str], missing: str) -> Column:
    """Name of the first bound that value is below; the last name above all; missing for null."""
    out = F.when(value.isNull(), missing)
    for b, n in zip(bounds, names, strict=False):
        out = out.when(value < b, n)
    return out.otherwise(names[-1])


def plausible_usd(rates: DataFrame, df: DataFrame) -> DataFrame:
    """Adds sal_usd (midpoint in US dollars) and sal_local; null if the range is too wide, starts at or below 0, has no
    rate, or is implausible."""
    mid = (F.col("sal_min") + F.col("sal_max")) / 2
    usd = mid * F.col("rate")
    ok = (F.col("sal_min") > 0) & (F.col("sal_max") / F.col("sal_min") <= MAX_RANGE_RATIO) & usd.between(*PLAUSIBLE_USD)
    df = df.join(F.broadcast(rates), "sal_currency", "left")
    return df.withColumns({"sal_usd": F.when(ok, usd), "sal_local": F.when(ok, mid)}).drop("rate")


def medians(df: DataFrame, by: str, value: str) -> DataFrame:
    """(by, median, n): exact medians of groups of any size; rows without a value do not count.

    Values are counted by whole units, and only those in the units of the two middle places are then counted one by one,
    so no task holds a group. Units are as many as the range of values has; groups are few."""
    g = F.col(by)
    rows = df.filter(F.col(value).isNotNull()).select(g.alias("g"), F.col(value).cast("double").alias("v"), F.floor(value).alias("unit"))
    of = Window.partitionBy("g")
    # Places count from 0; with an odd number the two middle ones are the same.
    places = F.explode(F.array(F.floor((F.col("n") - 1) / 2), F.floor(F.col("n") / 2))).alias("place")
    units = rows.groupBy("g", "unit").agg(F.count("*").alias("k"))
    units = units.withColumns({"run": F.sum("k").over(of.orderBy("unit")), "n": F.sum("k").over(of)}).select("g", "unit", "k", "run", "n", places)
    units = units.filter("place < run and place >= run - k").select("g", "unit", "n", (F.col("place") - F.col("run") + F.col("k")).alias("inner")).alias("u")
    near = rows.alias("r").join(F.broadcast(units.select("g", "unit").distinct()), F.expr("r.g <=> u.g and r.unit = u.unit"), "left_semi")
    values = near.groupBy("g", "unit", "v").agg(F.count("*").alias("k")).withColumn("run", F.sum("k").over(Window.partitionBy("g", "unit").orderBy("v"))).alias("x")
    hit = values.join(F.broadcast(units), F.expr("x.g <=> u.g and x.unit = u.unit and u.inner < x.run and u.inner >= x.run - x.k"))
    return hit.groupBy("u.g").agg(F.avg("v").alias("median"), F.first("n").alias("n")).withColumnRenamed("g", by)


def relative_pay(df: DataFrame, by: str = "profile") -> DataFrame:
    """Adds rel: pay over the median pay of its group, where the group has MEDIAN_MIN_ROWS paid rows or more."""
    med = medians(df, by, "sal_usd").filter(F.col("n") >= MEDIAN_MIN_ROWS).select(by, F.col("median").alias("_median"))
    return df.join(F.broadcast(med), by, "left").withColumn("rel", F.col("sal_usd") / F.col("_median")).drop("_median")


def enrich(df: DataFrame, rates: DataFrame, today: int) -> DataFrame:
    """The posting frame with US dollar pay, relative pay, and the bands and flags that reports group by."""
    df = relative_pay(plausible_usd(rates, df))
    y, age = F.col("yoe_min"), F.lit(today) - F.col("posted_day")
    return df.withColumns({
        "_all": F.lit("all"),
        "yoe_band": band(y, [1, 3, 5, 8, 12], ["0-1", "1-3", "3-5", "5-8", "8-12", "12+"], "unspecified"),
        "yoe_years": F.when(y >= 20, "20+").otherwise(F.floor(y).cast("int").cast("string")),
        "posting_age": F.when(F.col("posted_day").isNull(), "unknown").otherwise(band(age, [2, 8, 15, 31, 91], ["0-1d", "2-7d", "8-14d", "15-30d", "31-90d", "90d+"], "unknown")),
        "salary_band": band(F.col("sal_usd"), [25e3, 50e3, 75e3, 100e3, 150e3, 200e3, 300e3], ["<25k", "25-50k", "50-75k", "75-100k", "100-150k", "150-200k", "200-300k", "300k+"], "undisclosed"),
        "equity_flag": F.when(F.col("equity"), "mentioned").otherwise("not_mentioned"),
        "clearance_flag": F.when(F.col("clearance"), "required").otherwise("not_mentioned"),
        "multi_location": F.when(F.col("n_countries") > 1, "multi_country").when(F.col("n_locations") > 1, "multi_city").when(F.col("n_locations") == 1, "single").otherwise("none_listed"),
        "city_key": F.concat("city", F.lit(", "), F.coalesce("country", F.lit("?"))),
    })


#: The day that the queries count from, and the day filter of a snapshot: day D lacks the postings of one residue.
TODAY = 9700


def snapshot(df: DataFrame, day: int) -> DataFrame:
    return df.filter(F.col("job_key") % 10 != day % 10)


SQL = f"""
raw as (
  select {", ".join(f"{e} as {c}" for c, e in COLUMNS.items())}, {DAY_DUCK} as posted_day
  from orders left join customer on o_custkey = c_custkey left join nation on c_nationkey = n_nationkey left join region on n_regionkey = r_regionkey),
tech as (select l_orderkey as job_key, list_sort(list(distinct p_brand)) as technologies from lineitem join part on l_partkey = p_partkey group by 1),
fx(sal_currency, rate) as (values {", ".join(f"('{k}', {v}::double)" for k, v in RATES.items())}),
paid as (
  select raw.*, case when sal_min > 0 and sal_max / sal_min <= 4.0 and (sal_min + sal_max) / 2 * rate between 5000 and 2000000 then (sal_min + sal_max) / 2 * rate end as sal_usd,
    case when sal_min > 0 and sal_max / sal_min <= 4.0 and (sal_min + sal_max) / 2 * rate between 5000 and 2000000 then (sal_min + sal_max) / 2 end as sal_local
  from raw left join fx using (sal_currency)),
med as (select profile, median(sal_usd) as m from paid where sal_usd is not null group by 1 having count(*) >= 5),
frame as (
  select paid.*, sal_usd / m as rel, technologies, 'all' as _all,
    case when yoe_min is null then 'unspecified' when yoe_min < 1 then '0-1' when yoe_min < 3 then '1-3' when yoe_min < 5 then '3-5' when yoe_min < 8 then '5-8' when yoe_min < 12 then '8-12' else '12+' end as yoe_band,
    case when yoe_min >= 20 then '20+' else cast(cast(floor(yoe_min) as int) as varchar) end as yoe_years,
    case when posted_day is null then 'unknown' when {TODAY} - posted_day < 2 then '0-1d' when {TODAY} - posted_day < 8 then '2-7d' when {TODAY} - posted_day < 15 then '8-14d' when {TODAY} - posted_day < 31 then '15-30d' when {TODAY} - posted_day < 91 then '31-90d' else '90d+' end as posting_age,
    case when sal_usd is null then 'undisclosed' when sal_usd < 25000 then '<25k' when sal_usd < 50000 then '25-50k' when sal_usd < 75000 then '50-75k' when sal_usd < 100000 then '75-100k' when sal_usd < 150000 then '100-150k' when sal_usd < 200000 then '150-200k' when sal_usd < 300000 then '200-300k' else '300k+' end as salary_band,
    case when equity then 'mentioned' else 'not_mentioned' end as equity_flag, case when clearance then 'required' else 'not_mentioned' end as clearance_flag,
    case when n_countries > 1 then 'multi_country' when n_locations > 1 then 'multi_city' when n_locations = 1 then 'single' else 'none_listed' end as multi_location,
    city || ', ' || coalesce(country, '?') as city_key
  from paid left join med using (profile) left join tech using (job_key))
"""
