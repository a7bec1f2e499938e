"""Queries over the posting frame: rollups, comparisons, report rows, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.operators import compare as C
from jobmarket.operators import rollup as R
from jobmarket.plans import frame as P
from jobmarket.sources.tables import staged

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def enriched(spark, d, is_new: bool = True):
    # Technologies come last, so that the pass over pay for the medians does not make them too.
    df = P.with_technologies(P.enrich(P.postings(spark, d, technologies=False), P.fx(spark), P.TODAY), spark, d)
    return df.withColumn("is_new", F.col("job_key") % 10 == 3) if is_new else df


def rolled(spark, d, dims=R.DIMS):
    """The enriched frame, as far as rollups read it, and its measures; each is written once and read by what follows."""
    df = staged(enriched(spark, d).select(*R.INPUTS))
    return df, staged(R.one_way(df, dims))


FRAME = f"with {P.SQL}, f as (select *, job_key % 10 = 3 as is_new from frame)"
BUCKETS = {"_all": "_all", "title": "title_clean", "city": "city_key", "company": "company_slug", "equity": "equity_flag", "clearance": "clearance_flag", "salary_currency": "sal_currency", "salary_source": "sal_source"}


def _column(dim: str) -> str:
    return BUCKETS.get(dim, dim)


def _dim_sql(dim: str) -> str:
    if dim == "technology":
        return "select 'technology' as dim, unnest(case when technologies is null or len(technologies) = 0 then ['unknown'] else technologies end) as bucket, f.* from f"
    return f"select '{dim}' as dim, coalesce(cast({_column(dim)} as varchar), 'unknown') as bucket, f.* from f"


EXPLODED = "x as (" + " union all ".join(_dim_sql(d.name) for d in R.DIMS) + ")"
KEEP = "case dim " + " ".join(f"when '{d.name}' then {d.keep}" for d in R.DIMS if d.keep) + " else 1000000000 end"
MEASURED = f"""m0 as (
  select dim, bucket, count(*) as j, count(*) filter (is_new) as n, count(distinct company_slug) as c, count(*) filter (work_mode = 'remote') as r,
    count(*) filter (work_mode = 'hybrid') as h, count(*) filter (work_mode = 'onsite') as o, count(sal_usd) as sn, coalesce(sum(sal_usd), 0) as ss,
    count(sal_usd) filter (is_new) as nn, coalesce(sum(sal_usd) filter (is_new), 0) as ns, count(yoe_min) as yn, count(*) filter (visa = 'offered') as v,
    count(*) filter (equity) as e, count(rel) as pn, coalesce(sum(rel), 0) as ps from x group by 1, 2),
m as (select * exclude (rk) from (select *, row_number() over (partition by dim order by j desc, bucket) as rk from m0) where rk <= {KEEP})"""


def rounded(df):
    return df.withColumns({c: F.round(c, 2) for c in ("ss", "ns", "ps") if c in df.columns})


@query("a1_one_way_rollup", f"{FRAME}, {EXPLODED}, {MEASURED} select dim, bucket, j, n, c, r, h, o, sn, round(ss, 2) as ss, nn, round(ns, 2) as ns, yn, v, e, pn, round(ps, 2) as ps from m")
def one_way(spark, d):
    """A1, A3-A5, K1: measures of all dimensions in one pass."""
    return rounded(rolled(spark, d)[1]).select("dim", "bucket", *R.MEASURES)


HIST = """h as (
  select dim, bucket, 's' as hist, cast(round(ln(sal_usd) * 100) as int) as bin from x where sal_usd > 0
  union all select dim, bucket, 'n', cast(round(ln(sal_usd) * 100) as int) from x where sal_usd > 0 and is_new
  union all select dim, bucket, 'y', cast(least(20, greatest(0, floor(yoe_min))) as int) from x where yoe_min is not null),
hist as (select dim, bucket, hist, bin, count(*) as cnt from h semi join m using (dim, bucket) group by 1, 2, 3, 4)"""


@query("a6_log_histograms", f"{FRAME}, {EXPLODED}, {MEASURED}, {HIST} select * from hist")
def hists(spark, d):
    """Mergeable histograms of the kept buckets."""
    return R.histograms(*rolled(spark, d))


def pair_sql(a: str, b: str, k: int | None) -> str:
    src = lambda c: f"unnest(case when technologies is null or len(technologies) = 0 then ['unknown'] else technologies end)" if c == "technology" else f"coalesce(cast({_column(c)} as varchar), 'unknown')"  # noqa: E731, F541
    cells = f"select '{a}|{b}' as pair, {src(a)} as a, {src(b)} as b, f.* from f"
    return cells


CELLS = "y as (" + " union all ".join(pair_sql(*p) for p in R.PAIRS) + """),
c0 as (select pair, a, b, count(*) as j, count(*) filter (is_new) as n, count(*) filter (work_mode = 'remote') as r, count(sal_usd) as sn, coalesce(sum(sal_usd), 0) as ss, count(yoe_min) as yn from y group by 1, 2, 3),
t as (select pair, b, row_number() over (partition by pair order by sum(j) desc, b) as rk from c0 group by 1, 2),
cells as (select c0.* from c0 join t using (pair, b) where rk <= case pair """ + " ".join(f"when '{a}|{b}' then {k}" for a, b, k in R.PAIRS if k) + " else 1000000000 end)"


@query("a2_two_way_rollup", f"{FRAME}, {CELLS} select pair, a, b, j, n, r, sn, round(ss, 2) as ss, yn from cells")
def two_way(spark, d):
    """A2, K2: 19 two-way tables in one pass."""
    return rounded(R.two_way(enriched(spark, d)))


QUANT = """q as (select dim, bucket, bin, sum(cnt) over (partition by dim, bucket order by bin) as run, sum(cnt) over (partition by dim, bucket) as total from hist where hist = 's')
, qs as (select dim, bucket, cast(max(total) as bigint) as cnt, """ + ", ".join(f"cast(round(exp(min(case when run >= total * {q} then bin end) / 100.0::double)) as bigint) as {n}" for n, q in R.QUANTILES.items()) + " from q group by 1, 2)"


@query("a8_quantiles_from_histogram", f"{FRAME}, {EXPLODED}, {MEASURED}, {HIST}, {QUANT} select * from qs")
def quantiles(spark, d):
    """Pay quantiles of every bucket from its histogram."""
    return R.quantiles(R.histograms(*rolled(spark, d)).filter("hist = 's'"), ["dim", "bucket"])


YEARS = """ym as (select dim, bucket, min(case when run * 2 >= total then bin end) as yoe_median from (
  select dim, bucket, bin, sum(cnt) over (partition by dim, bucket order by bin) as run, sum(cnt) over (partition by dim, bucket) as total from hist where hist = 'y') group by 1, 2)"""


@query("a9_integer_median", f"{FRAME}, {EXPLODED}, {MEASURED}, {HIST}, {YEARS} select * from ym")
def years(spark, d):
    """Median years of experience of every bucket."""
    return R.integer_median(R.histograms(*rolled(spark, d)).filter("hist = 'y'"), ["dim", "bucket"], "yoe_median")


@query("a10_profile_median", f"with {P.SQL} select profile, round(median(sal_usd), 2) as median_usd, count(*) as n from frame where sal_usd is not null group by 1 having count(*) >= 5")
def profile_median(spark, d):
    """A10: exact medians of groups with five paid rows or more."""
    df = P.plausible_usd(P.fx(spark), P.postings(spark, d, technologies=False))
    return P.medians(df, "profile", "sal_usd").filter("n >= 5").select("profile", F.round("median", 2).alias("median_usd"), "n")


@query("a11_premium_index", f"with {P.SQL} select company_slug, count(rel) as n, round(avg(rel), 4) as premium from frame group by 1 having count(rel) >= 10")
def premium(spark, d):
    """Mean relative pay per company, ten paid rows or more."""
    return enriched(spark, d, False).groupBy("company_slug").agg(F.count("rel").alias("n"), F.round(F.avg("rel"), 4).alias("premium")).filter("n >= 10")


@query("a12_local_currency", f"with {P.SQL} select country, sal_currency, count(*) as n, round(sum(sal_local), 2) as s from frame where sal_local is not null group by 1, 2 having count(*) >= 5")
def local(spark, d):
    """Pay in local currency by country, five rows or more."""
    return R.local_pay(enriched(spark, d, False), ["country", "sal_currency"]).withColumn("s", F.round("s", 2)).filter("n >= 5")


@query("a13_pair_cooccurrence", f"""with {P.SQL}, u as (select distinct job_key, unnest(technologies) as t from frame)
select x.t as a, y.t as b, count(*) as j from u x join u y on x.job_key = y.job_key and x.t < y.t group by 1, 2 order by j desc, a, b limit 300""")
def pairs(spark, d):
    """Technology pairs of one posting, the 300 most frequent."""
    return R.value_pairs(P.with_technologies(P.read(spark, d, "orders").selectExpr("o_orderkey as job_key"), spark, d), "technologies", 300)


@query("a14_display_bins", f"{FRAME}, {EXPLODED}, {MEASURED}, {HIST} select dim, bucket, cast(least(500000, floor(exp(bin / 100.0::double) / 10000) * 10000) as bigint) as low, cast(sum(cnt) as bigint) as cnt from hist where hist = 's' group by 1, 2, 3")
def display(spark, d):
    """Log bins as bins of 10,000."""
    return R.display_bins(R.histograms(*rolled(spark, d)).filter("hist = 's'"), ["dim", "bucket"])


@query("a16_frame_kpis", f"with {P.SQL} select count(*) as jobs, count(distinct (company_slug, title_clean)) as unique_jobs, count(distinct company_slug) as companies, count(distinct country) as countries from frame")
def kpis(spark, d):
    """Distinct titles, companies and countries of a frame."""
    df = P.postings(spark, d, technologies=False)
    return df.agg(F.count("*").alias("jobs"), F.count_distinct(F.struct("company_slug", "title_clean")).alias("unique_jobs"), F.count_distinct("company_slug").alias("companies"), F.count_distinct("country").alias("countries"))


@query("a18_data_quality", f"""with {P.SQL} select source, count(*) as jobs, round(100.0 * count(sal_min) / count(*), 2) as parsed_pct, round(100.0 * count(sal_usd) / count(*), 2) as usable_pct,
round(100.0 * count(*) filter (city is null) / count(*), 2) as no_city_pct, count(distinct sal_currency) filter (sal_currency not in ('USD', 'EUR', 'GBP')) as currencies_without_rate from frame group by 1""")
def quality(spark, d):
    """Ratios per source."""
    c = F.col
    return enriched(spark, d, False).groupBy("source").agg(
        F.count("*").alias("jobs"), F.round(100.0 * F.count("sal_min") / F.count("*"), 2).alias("parsed_pct"), F.round(100.0 * F.count("sal_usd") / F.count("*"), 2).alias("usable_pct"),
        F.round(100.0 * F.count_if(c("city").isNull()) / F.count("*"), 2).alias("no_city_pct"), F.count_distinct(F.when(~c("sal_currency").isin(*P.RATES), c("sal_currency"))).alias("currencies_without_rate"))


@query("f8_plausible_pay", f"with {P.SQL} select job_key, round(sal_usd, 2) as sal_usd, round(sal_local, 2) as sal_local from frame")
def plausible(spark, d):
    """Pay in US dollars under the range and band rules."""
    return P.plausible_usd(P.fx(spark), P.postings(spark, d, False)).select("job_key", F.round("sal_usd", 2).alias("sal_usd"), F.round("sal_local", 2).alias("sal_local"))


@query("r2_enrich", f"with {P.SQL} select job_key, round(rel, 4) as rel, yoe_band, yoe_years, posting_age, salary_band, equity_flag, clearance_flag, multi_location, city_key from frame")
def enrich(spark, d):
    """Bands and flags."""
    return enriched(spark, d, False).select("job_key", F.round("rel", 4).alias("rel"), "yoe_band", "yoe_years", "posting_age", "salary_band", "equity_flag", "clearance_flag", "multi_location", "city_key")


ROWS = f"""{QUANT}, {YEARS}, a as (select sum(j) as all_jobs from m where dim = '_all'),
rows_ as (select dim, bucket, round(j / 1, 2) as jobs, round(100 * j / all_jobs, 2) as share, round(n / 1, 2) as new, round(c / 1, 2) as companies, round(100 * r / j, 2) as remote_pct, round(100 * h / j, 2) as hybrid_pct,
  round(100 * o / j, 2) as onsite_pct, round(100 * v / j, 2) as visa_pct, round(100 * e / j, 2) as equity_pct, round(100 * sn / j, 2) as disclosed_pct, round(100 * yn / j, 2) as yoe_pct,
  case when sn > 0 then round(ss / sn, 2) end as pay_avg, case when pn > 0 then round(ps / pn, 4) end as premium_index, sn < 30 as thin, p10, p25, p50, p75, p90, yoe_median
from m left join qs using (dim, bucket) left join ym using (dim, bucket), a)"""


@query("r4_day_rollup", f"{FRAME}, {EXPLODED}, {MEASURED}, {HIST}, {ROWS} select * from rows_")
def day_rollup(spark, d):
    """The day's report rows, from measures and histograms of one enriched frame."""
    df, m = rolled(spark, d)
    return R.bucket_rows(m, R.histograms(df, m))


@query("r8_cross_rows", f"{FRAME}, {CELLS} select pair, a, b, j, n, round(100 * j / sum(j) over (partition by pair, a), 2) as share, round(100 * r / j, 2) as remote_pct, case when sn > 0 then round(ss / sn, 2) end as pay_avg from cells qualify j >= 3")
def cross(spark, d):
    """Two-way rows with shares, small cells left out."""
    return R.cross_rows(R.two_way(enriched(spark, d)))


@query("r10_remote_premium", f"""{FRAME}, {CELLS} select a as profile, round(max(case when b = 'remote' and sn > 0 then ss / sn end), 2) as remote_pay, round(max(case when b = 'onsite' and sn > 0 then ss / sn end), 2) as onsite_pay,
round(max(case when b = 'remote' and sn > 0 then ss / sn end) / max(case when b = 'onsite' and sn > 0 then ss / sn end), 4) as premium from cells where pair = 'profile|work_mode' group by 1""")
def remote_premium(spark, d):
    """Pay of remote over on-site postings per profile."""
    cells = R.two_way(enriched(spark, d), (("profile", "work_mode", None),))
    pay = lambda mode: F.max(F.when((F.col("b") == mode) & (F.col("sn") > 0), F.col("ss") / F.col("sn")))
    return cells.groupBy(F.col("a").alias("profile")).agg(F.round(pay("remote"), 2).alias("remote_pay"), F.round(pay("onsite"), 2).alias("onsite_pay"), F.round(pay("remote") / pay("onsite"), 4).alias("premium"))


@query("r11_disclosure", f"{FRAME}, {EXPLODED}, {MEASURED} select bucket as country, j, sn, round(100 * sn / j, 2) as disclosed_pct, rank() over (order by round(100 * sn / j, 2) desc, bucket) as place from m where dim = 'country'")
def disclosure(spark, d):
    """Share of postings with pay by country."""
    from pyspark.sql import Window

    m = rolled(spark, d, (R.BY_NAME["_all"], R.BY_NAME["country"]))[1].filter("dim = 'country'")
    p = R.pct(F.col("sn"), F.col("j"))
    return m.select(F.col("bucket").alias("country"), "j", "sn", p.alias("disclosed_pct"), F.rank().over(Window.orderBy(F.desc(p), "bucket")).cast("long").alias("place"))


@query("r12_pay_curve", f"with {P.SQL} select yoe_years, count(*) as jobs, round(avg(sal_usd), 2) as pay, round(100 * count(*) filter (seniority = 'entry') / count(*), 2) as entry_pct from frame where yoe_years is not null group by 1")
def pay_curve(spark, d):
    """Pay and entry-level share by years."""
    df = enriched(spark, d, False).filter("yoe_years is not null")
    return df.groupBy("yoe_years").agg(F.count("*").alias("jobs"), F.round(F.avg("sal_usd"), 2).alias("pay"), R.pct(F.count_if(F.col("seniority") == "entry"), F.count("*")).alias("entry_pct"))


DAY = lambda n, k: f"d{n} as (select bucket, dim, count(*) as j, count(*) filter (job_key % 10 = {k}) as n from x where job_key % 10 <> {k} group by 1, 2)"
TWO_DAYS = f"{FRAME}, x as (" + " union all ".join(_dim_sql(n) for n in ("_all", "profile", "country", "work_mode")) + f"), {DAY(1, 1)}, {DAY(2, 2)}"
FEW = tuple(R.BY_NAME[n] for n in ("_all", "profile", "country", "work_mode"))


def _two_days(spark, d):
    df = enriched(spark, d)
    day = lambda k: R.exploded(df.filter(F.col("job_key") % 10 != k), FEW).groupBy("dim", "bucket").agg(F.count("*").alias("j"))
    return day(1), day(2)


DELTA = "dl as (select dim, bucket, coalesce(b.j, 0) as value, coalesce(a.j, 0) as previous, coalesce(b.j, 0) - coalesce(a.j, 0) as delta, case when a.j > 0 then round(100 * (coalesce(b.j, 0) - a.j) / a.j, 2) end as delta_pct, case when a.j is null then 'appeared' when b.j is null then 'disappeared' else 'both' end as state from d2 b full join d1 a using (dim, bucket))"


@query("r7_deltas", f"{TWO_DAYS}, {DELTA} select * from dl")
def day_deltas(spark, d):
    """Buckets of two days compared."""
    a, b = _two_days(spark, d)
    return R.deltas(b, a, ["dim", "bucket"])


@query("k4_movers", f"""{TWO_DAYS}, {DELTA}, r as (
select dim, 'absolute' as kind, 'up' as direction, row_number() over (partition by dim order by delta desc, bucket) as rank, bucket, value, previous, delta, delta_pct from dl where delta > 0
union all select dim, 'absolute', 'down', row_number() over (partition by dim order by delta, bucket), bucket, value, previous, delta, delta_pct from dl where delta < 0
union all select dim, 'percent', 'up', row_number() over (partition by dim order by delta_pct desc, bucket), bucket, value, previous, delta, delta_pct from dl where delta_pct > 0 and previous >= 20
union all select dim, 'percent', 'down', row_number() over (partition by dim order by delta_pct, bucket), bucket, value, previous, delta, delta_pct from dl where delta_pct < 0 and previous >= 20)
select dim, kind, direction, cast(rank as int) as rank, bucket, value, previous, delta, delta_pct from r where rank <= 25""")
def movers(spark, d):
    """K4: largest risers and fallers."""
    a, b = _two_days(spark, d)
    return R.movers(R.deltas(b, a, ["dim", "bucket"]))


@query("a17_signed_merge", f"{TWO_DAYS} select dim, bucket, cast(sum(j) as bigint) as j from (select dim, bucket, j from d1 union all select dim, bucket, j from d2 union all select dim, bucket, -j from d1) group by 1, 2 having sum(j) <> 0")
def signed_merge(spark, d):
    """Two days added, the first taken back."""
    a, b = _two_days(spark, d)
    return R.merge([(a, 1), (b, 1), (a, -1)], ["dim", "bucket"], ["j"])


@query("r5_removed_per_bucket", f"{TWO_DAYS} select dim, bucket, coalesce(a.j, 0) + coalesce(b.n2, 0) - coalesce(b.j, 0) as removed from (select dim, bucket, j from d1) a full join (select dim, bucket, count(*) as j, count(*) filter (job_key % 10 = 1) as n2 from x where job_key % 10 <> 2 group by 1, 2) b using (dim, bucket) where coalesce(a.j, 0) + coalesce(b.n2, 0) - coalesce(b.j, 0) > 0")
def removed_bucket(spark, d):
    """Previous + new - today per bucket."""
    df = enriched(spark, d)
    a = R.exploded(df.filter("job_key % 10 <> 1"), FEW).groupBy("dim", "bucket").agg(F.count("*").alias("j"))
    today = df.filter("job_key % 10 <> 2").withColumn("is_new", F.col("job_key") % 10 == 1)
    b = R.exploded(today, FEW).groupBy("dim", "bucket").agg(F.count("*").alias("j"), F.sum("_new").alias("n"))
    return C.removed_per_bucket(a, b, ["dim", "bucket"])


STATES = f"""with {P.SQL}, prev as (select job_key, board_slug as board, posted_day as first_day from frame where job_key % 10 <> 1 and board_slug <> 'b7'),
today as (select job_key, board_slug as board from frame where job_key % 10 <> 2 and board_slug <> 'b3')"""


def states(spark, d):
    f = P.postings(spark, d, False).select("job_key", F.col("board_slug").alias("board"), F.col("posted_day").alias("first_day"))
    prev = f.filter("job_key % 10 <> 1 and board <> 'b7'")
    today = f.filter("job_key % 10 <> 2 and board <> 'b3'").select("job_key", "board")
    boards = f.select("board").distinct()
    return C.compare(prev, boards.filter("board <> 'b7'"), today, boards.filter("board = 'b3'"), boards.filter("board <> 'b3'"), P.TODAY)


@query("r3_day_comparison", f"""{STATES} select 'new' as kind, job_key, board, cast(null as int) as days_open from today where job_key not in (select job_key from prev) and board <> 'b7'
union all select 'removed', job_key, board, cast(least(365, greatest(0, {P.TODAY} - first_day)) as int) from prev where job_key not in (select job_key from today) and board <> 'b3'
union all select 'carried', job_key, board, null from prev where job_key not in (select job_key from today) and board = 'b3'""")
def day_comparison(spark, d):
    """New, removed and carried jobs; board b3 failed today, board b7 is newly covered."""
    c = states(spark, d)
    pick = lambda df, k, days=None: df.select(F.lit(k).alias("kind"), "job_key", "board", (days if days is not None else F.lit(None)).cast("int").alias("days_open"))
    return pick(c.new, "new").unionByName(pick(c.removed, "removed", F.col("days_open"))).unionByName(pick(c.carried, "carried"))


@query("r3_next_state", f"""{STATES} select t.job_key, t.board, coalesce(p.first_day, {P.TODAY}) as first_day from today t left join prev p using (job_key)
union all select job_key, board, first_day from prev where job_key not in (select job_key from today) and board = 'b3'""")
def next_state(spark, d):
    """The state that tomorrow compares with."""
    return states(spark, d).state


@query("a35_removal_age", f"{STATES} select cast(least(365, greatest(0, {P.TODAY} - first_day)) as int) as days_open, count(*) as cnt from prev where job_key not in (select job_key from today) and board <> 'b3' group by 1")
def removal_age(spark, d):
    """Removed jobs by days open."""
    return states(spark, d).removed.groupBy("days_open").agg(F.count("*").alias("cnt"))


BANDS = (("0-7", 0), ("8-14", 8), ("15-30", 15), ("31-60", 31), ("61-90", 61), ("90+", 91))


@query("a15_days_open_bands", f"""{STATES}, b(band, low, high) as (values ('0-7', 0, 7), ('8-14', 8, 14), ('15-30', 15, 30), ('31-60', 31, 60), ('61-90', 61, 90), ('90+', 91, 100000)),
r as (select least(365, greatest(0, {P.TODAY} - first_day)) as x from prev where job_key not in (select job_key from today) and board <> 'b3')
select band, count(x) as cnt from b left join r on x between low and high group by 1""")
def open_bands(spark, d):
    """Removed jobs by band, empty bands shown."""
    band = P.band(F.col("days_open"), [8, 15, 31, 61, 91], [b for b, _ in BANDS], "unknown")
    counts = states(spark, d).removed.groupBy(band.alias("band")).agg(F.count("*").alias("cnt"))
    return spark.createDataFrame([(b,) for b, _ in BANDS], "band string").join(counts, "band", "left").fillna(0)


@query("r15_weekly_fold", """with o as (select cast(o_orderdate as date) as day, o_orderpriority as bucket, o_custkey from orders),
dd as (select day, bucket, count(*) as j, count(distinct o_custkey) as c from o group by 1, 2)
select strftime(day, '%G-W%V') as iso_week, bucket, cast(sum(j) as bigint) as total, count(distinct day) as days, round(sum(j) / count(distinct day), 2) as jobs, round(sum(c) / count(distinct day), 2) as companies,
min(date_trunc('week', day))::date as first_day, (min(date_trunc('week', day))::date + 6)::date as last_day from dd group by 1, 2""")
def weekly(spark, d):
    """Days folded into ISO weeks, per-day averages over covered days."""
    from jobmarket.functions.values import iso_week, week_bounds

    o = P.read(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"), F.col("o_orderpriority").alias("bucket"), "o_custkey")
    per_day = o.groupBy("day", "bucket", "o_custkey").agg(F.count("*").alias("k")).groupBy("day", "bucket").agg(F.sum("k").alias("j"), F.count("*").alias("c"))
    first, last = week_bounds(F.min("day"))
    n = F.count_distinct("day")
    return per_day.groupBy(iso_week(F.col("day")).alias("iso_week"), "bucket").agg(F.sum("j").alias("total"), n.alias("days"), F.round(F.sum("j") / n, 2).alias("jobs"), F.round(F.sum("c") / n, 2).alias("companies"), first.alias("first_day"), last.alias("last_day"))


@query("r13_kpi_row", f"""{FRAME} select count(*) as jobs, count(*) filter (is_new) as new, count(distinct company_slug) as companies, round(100 * count(sal_usd) / count(*), 2) as disclosed_pct, round(median(sal_usd), 2) as pay_median,
round(100 * count(*) filter (work_mode = 'remote') / count(*), 2) as remote_pct, count(distinct (company_slug, title_clean)) as unique_jobs from f""")
def kpi_row(spark, d):
    """The headline row."""
    n = F.count("*")
    return enriched(spark, d).agg(n.alias("jobs"), F.count_if("is_new").alias("new"), F.count_distinct("company_slug").alias("companies"), R.pct(F.count("sal_usd"), n).alias("disclosed_pct"), F.round(F.median("sal_usd"), 2).alias("pay_median"), R.pct(F.count_if(F.col("work_mode") == "remote"), n).alias("remote_pct"), F.count_distinct(F.struct("company_slug", "title_clean")).alias("unique_jobs"))


@query("a19_coverage", f"""with {P.SQL}, s as (select board_slug, min(source) as source, count(*) as jobs, case when board_slug = 'b3' then 'failed' when board_slug in ('b5', 'b6') then 'gone' else 'ok' end as status from frame group by 1)
select source, count(*) as boards, count(*) filter (status = 'ok') as ok, count(*) filter (status = 'failed') as failed, count(*) filter (status = 'gone') as gone, round(100 * count(*) filter (status = 'ok') / count(*), 2) as ok_pct from s group by 1""")
def coverage(spark, d):
    """Boards by outcome per source."""
    s = P.postings(spark, d, False).groupBy("board_slug").agg(F.min("source").alias("source"), F.count("*").alias("jobs"))
    s = s.withColumn("status", F.when(F.col("board_slug") == "b3", "failed").when(F.col("board_slug").isin("b5", "b6"), "gone").otherwise("ok"))
    n = lambda k: F.count_if(F.col("status") == k)
    return s.groupBy("source").agg(F.count("*").alias("boards"), n("ok").alias("ok"), n("failed").alias("failed"), n("gone").alias("gone"), R.pct(n("ok"), F.count("*")).alias("ok_pct"))


@query("k3_display_order", f"{FRAME}, {EXPLODED}, {MEASURED} select dim, bucket, j, cast(row_number() over (partition by dim order by coalesce(list_position(['0-1', '1-3', '3-5', '5-8', '8-12', '12+', 'unspecified'], case when dim = 'yoe_band' then bucket end), 99), j desc, bucket) as int) as place from m where dim in ('yoe_band', 'title', 'city', 'company', 'profile') qualify place <= 300")
def display_order(spark, d):
    """K3: ordinal dimensions in their own order, others by jobs; at most 300 rows each."""
    from pyspark.sql import Window

    dims = tuple(R.BY_NAME[n] for n in ("yoe_band", "title", "city", "company", "profile"))
    m = rolled(spark, d, dims)[1]
    order = F.array(*[F.lit(x) for x in ("0-1", "1-3", "3-5", "5-8", "8-12", "12+", "unspecified")])
    own = F.when(F.col("dim") == "yoe_band", F.nullif(F.array_position(order, F.col("bucket")), F.lit(0)))
    w = Window.partitionBy("dim").orderBy(F.coalesce(own, F.lit(99)), F.desc("j"), "bucket")
    return m.withColumn("place", F.row_number().over(w)).filter("place <= 300").select("dim", "bucket", "j", "place")
