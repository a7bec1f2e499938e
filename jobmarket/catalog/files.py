"""Queries over files that they write themselves, in a folder under spark.checkpoint.dir: scans, sinks and micro-batches, and
their DuckDB twins, which read the tables that the files are made of."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from jobmarket.operators import tables as M
from jobmarket.plans.frame import read
from jobmarket.sources import tables as S
from jobmarket.streaming import boards as B

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("s1_posting_shards", "select o_orderkey as job_key, 'c' || o_custkey as company_slug, case when o_orderkey % 3 <> 2 then 'src' || o_custkey % 5 end as source, o_totalprice as sal_min, null::varchar as title_clean from orders")
def shards(spark, d):
    """Zstd shards read as one frame; a column that a shard lacks is null, one that all lack too."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("job_key"), F.concat(F.lit("c"), "o_custkey").alias("company_slug"), F.concat(F.lit("src"), F.col("o_custkey") % 5).alias("source"), F.col("o_totalprice").alias("sal_min"))
    root = S.staging(spark)
    for k in range(3):
        part = o.filter(F.col("job_key") % 3 == k)
        S.write_shard(part.drop("source") if k == 2 else part, f"{root}/jobs-{k}.parquet")
    return S.posting_shards(spark, [f"{root}/jobs-{k}.parquet" for k in range(3)]).select("job_key", "company_slug", "source", "sal_min", "title_clean")


@query("s2_board_statuses", "select 'b' || s_suppkey as board_slug, case when s_acctbal < 0 then 'failed' else 'ok' end as status, cast(s_suppkey % 7 as int) as jobs, 3::bigint as shards_seen from supplier")
def statuses(spark, d):
    """Status files of three shards, a document each, and the shards that reported."""
    b = read(spark, d, "supplier").select(F.lit(3).alias("shards"), (F.col("s_suppkey") % 3).cast("int").alias("shard"), F.struct(F.concat(F.lit("b"), "s_suppkey").alias("board_slug"), F.expr("case when s_acctbal < 0 then 'failed' else 'ok' end").alias("status"), (F.col("s_suppkey") % 7).cast("int").alias("jobs")).alias("b"))
    root = S.staging(spark)
    for k in range(3):
        # A shard's board list is of bounded size: it is one document.
        S.write_document(b.filter(F.col("shard") == k).groupBy("shard", "shards").agg(F.collect_list("b").alias("boards")), f"{root}/boards-{k}.json")
    rows, seen = S.board_statuses(spark, f"{root}/boards-*.json")
    return rows.select("board_slug", "status", "jobs").crossJoin(F.broadcast(seen.agg(F.count("*").alias("shards_seen"))))


@query("s3_taxonomy_csv", "select n_nationkey::varchar as slug, 'en' as locale, n_name as alias from nation union all select n_nationkey::varchar, 'de', lower(n_name) || ', \"x\"' from nation where n_nationkey % 3 = 0")
def taxonomy(spark, d):
    """S3: locale columns of a CSV as rows; empty cells are no alias."""
    t = read(spark, d, "nation").select(F.col("n_nationkey").cast("string").alias("slug"), F.col("n_name").alias("en"), F.when(F.col("n_nationkey") % 3 == 0, F.concat(F.lower("n_name"), F.lit(', "x"'))).alias("de"))
    path = S.staging(spark)
    t.write.option("header", True).option("escape", '"').csv(path)
    return S.taxonomy(spark, path, "slug string, en string, de string", ["slug"], ["en", "de"])


@query("s4_company_dimension", """select 'c' || c_custkey as slug, coalesce(n_name, 'Unknown') as industry_name, case when c_custkey % 11 = 0 then 'unknown' when c_custkey % 80 < 5 then '<5y' when c_custkey % 80 < 10 then '5-10y' when c_custkey % 80 < 20 then '10-20y'
when c_custkey % 80 < 50 then '20-50y' else '50y+' end as company_age from customer left join nation on n_nationkey = case when c_nationkey % 5 <> 4 then c_nationkey end""")
def companies(spark, d):
    """Companies with industry name and age band; founding years that are no numbers, and unknown industries."""
    c = read(spark, d, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("slug"), F.expr("case when c_nationkey % 5 <> 4 then c_nationkey else 99 end").alias("industry"), F.expr("case when c_custkey % 11 = 0 then 'n/a' else cast(2024 - c_custkey % 80 as string) end").alias("founded_year"))
    path = S.staging(spark)
    c.write.option("header", True).csv(path)
    industries = read(spark, d, "nation").select(F.col("n_nationkey").alias("industry"), F.col("n_name").alias("industry_name"))
    return S.companies(spark, path, "slug string, industry int, founded_year string", industries, 2024).select("slug", "industry_name", "company_age")


@query("s6_fx_rates", "select 'K' || n_nationkey as currency, case when n_nationkey % 3 = 0 then 1.5 when n_nationkey % 3 = 1 then 2.5 else 3.5 end::double as rate from nation where n_nationkey % 7 <> 6 or n_nationkey % 3 = 2 union all select 'USD', 1.0")
def fx(spark, d):
    """The first source, gaps filled by a second one, then by the previous day; USD is 1."""
    n = read(spark, d, "nation").select(F.concat(F.lit("K"), "n_nationkey").alias("currency"), F.col("n_nationkey").alias("k"))
    first, second = n.filter("k % 3 = 0 and k % 7 <> 6").select("currency", F.lit(1.5).alias("rate")), n.filter("k % 3 < 2 and k % 7 <> 6").select("currency", F.lit(2.5).alias("rate"))
    return S.rates(first, second, n.filter("k % 7 <> 6 or k % 3 = 2").select("currency", F.lit(3.5).alias("rate")))


@query("s7_rate_upsert", "select 'K' || n_nationkey as currency, case when n_nationkey % 4 = 1 then cast(round(1.0::double / (n_nationkey + 1), 12) as decimal(24, 12)) else cast(0.5 as decimal(24, 12)) end as to_eur from nation where n_nationkey % 4 = 1 or n_nationkey % 2 = 0")
def rate_upsert(spark, d):
    """Reciprocal rates to 12 places, upserted by currency; zero, negative and malformed rates leave the old row alone."""
    from jobmarket.functions import values as V

    n = read(spark, d, "nation").select(F.concat(F.lit("K"), "n_nationkey").alias("currency"), F.col("n_nationkey").alias("k"))
    old = n.filter("k % 2 = 0").select("currency", F.lit(0.5).cast("decimal(24,12)").alias("to_eur"))
    landed = n.select("currency", F.expr("case k % 4 when 0 then '-1' when 1 then cast(k + 1 as string) when 2 then 'n/a' else '0' end").alias("raw"))
    new = landed.select("currency", V.to_euro(F.col("raw").try_cast("double")).alias("to_eur")).filter("to_eur is not null")
    return M.upsert(old, new, ["currency"], {})


@query("s11_strict_json_lines", "select c_custkey as id, c_name as name, c_acctbal as balance from customer")
def json_lines(spark, d):
    """JSON lines under a declared schema; one bad line would fail the read (tests)."""
    path = S.staging(spark)
    read(spark, d, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("balance")).write.json(path)
    return S.json_lines(spark, path, "id long, name string, balance double")


@query("s12_dated_sink", "with o as (select o_orderkey as id, strftime(o_orderdate, '%Y-%m') as month, o_orderdate >= timestamp '1998-01-01' and o_orderkey % 2 <> 0 as second from orders), g as (select month, bool_or(second) as again from o group by 1) select id, month, case when again then 'again' else 'first' end as run from o join g using (month) where second or not again")
def dated(spark, d):
    """A second run replaces the dates that it holds and leaves the others alone."""
    path, o = S.staging(spark), read(spark, d, "orders")
    rows = lambda df, run: df.select(F.col("o_orderkey").alias("id"), F.date_format("o_orderdate", "yyyy-MM").alias("month"), F.lit(run).alias("run"))
    S.write_by_date(rows(o, "first").repartition("month"), path, "month")
    S.write_by_date(rows(o.filter("o_orderdate >= timestamp'1998-01-01' and o_orderkey % 2 <> 0"), "again").repartition("month"), path, "month")
    return spark.read.schema("id long, run string, month string").json(path).select("id", "month", "run")


@query("s14_report_versions", "with w as (select date_trunc('week', o_orderdate)::date as week, count(*) as j, count(*) filter (o_orderkey % 2 = 0) as k from orders group by 1) select week, case when week >= date '1997-06-01' then j else k end as jobs from w where k > 0 or week >= date '1997-06-01'")
def versions(spark, d):
    """Weeks upserted into the report's last version; a new version is written beside the old, an empty one refused."""
    root, o = S.staging(spark), read(spark, d, "orders")
    weeks = lambda df: df.groupBy(F.date_trunc("week", "o_orderdate").cast("date").alias("week")).agg(F.count("*").alias("jobs"))
    first = S.write_version(weeks(o.filter("o_orderkey % 2 = 0")), root)
    second = S.write_version(M.upsert(spark.read.parquet(first), weeks(o).filter("week >= date'1997-06-01'"), ["week"], {}), root)
    return spark.read.parquet(second)


@query("s15_report_document", "select c_mktsegment as segment, count(*) as n, round(sum(c_acctbal), 2) as total from customer group by 1")
def document(spark, d):
    """A report as JSON documents, written and read back."""
    path = S.staging(spark)
    S.write_document(read(spark, d, "customer").groupBy(F.col("c_mktsegment").alias("segment")).agg(F.count("*").alias("n"), F.round(F.sum("c_acctbal"), 2).alias("total")), path)
    return spark.read.text(path).select(F.from_json("value", "segment string, n long, total double").alias("r")).select("r.*")


@query("s16_last_weeks", "select date_trunc('week', o_orderdate)::date as week, count(*) as jobs from orders group by 1 order by 1 desc limit 8")
def last_weeks(spark, d):
    """The last eight weeks of a written report."""
    weeks = read(spark, d, "orders").groupBy(F.date_trunc("week", "o_orderdate").cast("date").alias("week")).agg(F.count("*").alias("jobs"))
    return S.latest(spark.read.parquet(S.write_version(weeks, S.staging(spark))), "week")


@query("s18_checked_scan", "select o_orderkey::varchar as id, case when o_orderkey % 5 = 0 then null else o_orderkey % 2 = 0 end as flag, case when o_orderkey % 3 = 0 then null else o_custkey end as n from orders")
def checked(spark, d):
    """Required columns of a wider file, cast tolerantly, with the manifest's row count."""
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.expr("case when o_orderkey % 5 = 0 then 'maybe' when o_orderkey % 2 = 0 then 'true' else 'false' end").alias("flag"), F.expr("case when o_orderkey % 3 = 0 then 'x' else cast(o_custkey as string) end").alias("n"), "o_totalprice", "o_orderstatus")
    path = S.staging(spark)
    S.write_shard(o, path)
    return S.checked_scan(spark.read.parquet(path), {"id": "string", "flag": "boolean", "n": "long"}, rows=o.count())


@query("t5_micro_batch_ingest", "select o_orderkey as id, max(case when o_orderkey % 4 = 1 then 'second' else 'first' end) as run, 'kept' as fate from orders where o_orderkey % 10 <> 3 group by 1 union all select o_orderkey, 'first', 'quarantined' from orders where o_orderkey % 10 = 3")
def micro_batches(spark, d):
    """T5: files taken batch by batch, one a trigger; valid rows upserted by key (the later batch wins), others set aside."""
    root = S.staging(spark)
    o = read(spark, d, "orders").select(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 10 != 3, F.col("o_custkey")).alias("company"), F.lit("first").alias("run"), F.lit(1).alias("seq"))
    o.write.parquet(f"{root}/in/run=1")
    o.filter("id % 4 = 1 and id % 10 <> 3").withColumns({"run": F.lit("second"), "seq": F.lit(2)}).write.parquet(f"{root}/in/run=2")
    states: list[DataFrame] = []

    def upsert(batch: DataFrame, epoch: int) -> None:
        # A replayed batch writes the same version again. A key that comes twice in a batch keeps its last row.
        new = batch.groupBy("id").agg(F.max_by("run", "seq").alias("run"), F.max("seq").alias("seq"))
        state = M.upsert(states[-1], new, ["id"], {}) if states else new
        state.write.mode("overwrite").parquet(f"{root}/state/{epoch}")
        states.append(batch.sparkSession.read.parquet(f"{root}/state/{epoch}"))

    def quarantine(batch: DataFrame, epoch: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/bad/{epoch}")

    stream = spark.readStream.schema(o.schema).option("recursiveFileLookup", True).option("maxFilesPerTrigger", 4).parquet(f"{root}/in")
    B.ingest(stream, upsert, F.col("company").isNotNull(), quarantine, f"{root}/checkpoint").awaitTermination()
    bad = spark.read.schema(o.schema).option("recursiveFileLookup", True).parquet(f"{root}/bad")
    return states[-1].select("id", "run", F.lit("kept").alias("fate")).unionByName(bad.select("id", "run", F.lit("quarantined").alias("fate")))


@query("u8_full_reset", "select count(*) filter (o_orderkey is null) as n, 2::bigint as n_columns from orders")
def reset(spark, d):
    """U8: the posting table is emptied; its schema stays."""
    path = S.staging(spark)
    o = read(spark, d, "orders").select("o_orderkey", "o_custkey")
    o.write.parquet(path)
    left = M.emptied(o, path)
    return left.agg(F.count("*").alias("n")).select("n", F.lit(len(left.columns)).cast("long").alias("n_columns"))
