"""The report's whole layout and its DuckDB twin."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.catalog import reports as RP
from jobmarket.operators import rollup as R
from jobmarket.plans import sections as S
from jobmarket.plans.frame import SQL as FRAME_SQL
from jobmarket.sources.tables import staged

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def _names(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _sections(parts) -> str:
    return "case dim " + " ".join(f"when '{d}' then '{s}'" for s, dims in parts.items() for d in dims) + " end"


def _before(dim: str) -> str:
    return RP._dim_sql(dim).replace("f.* from f", "g.* from g")


_USUAL = "jobs::double as jobs, share::double as share, pay_avg::double as pay, p50::double as value"
_RANK = "row_number() over (partition by dim order by jobs desc, bucket)"
_MOVES = " union all ".join(
    f"select 'profiles' as section, '{name}' as part, dim, bucket, null::varchar as other, row_number() over (partition by dim order by {order}, bucket) as rank, value::double as jobs, delta_pct as share, null::double as pay, delta::double as value from dl where {where}"
    for name, order, where in (
        ("risers", "delta desc", "state <> 'disappeared' and delta > 0"), ("fallers", "delta", "state <> 'disappeared' and delta < 0"),
        ("risers_pct", "delta_pct desc", "state <> 'disappeared' and delta_pct > 0 and previous >= 20"), ("fallers_pct", "delta_pct", "state <> 'disappeared' and delta_pct < 0 and previous >= 20"))
)
LAYOUT = f"""with {FRAME_SQL}, f as (select *, job_key % 10 = 3 as is_new from frame where job_key % 10 <> 2), g as (select * from frame where job_key % 10 <> 1),
{RP.EXPLODED}, {RP.MEASURED}, {RP.HIST}, {RP.ROWS}, {RP.CELLS}, p1 as (select dim, bucket, count(*) as j from ({' union all '.join(_before(d) for d in S.MOVING)}) group by 1, 2),
dl as (select dim, bucket, coalesce(m.j, 0) as value, coalesce(p1.j, 0) as previous, coalesce(m.j, 0) - coalesce(p1.j, 0) as delta, round(100 * (coalesce(m.j, 0) - p1.j) / p1.j, 2) as delta_pct,
  case when p1.j is null then 'appeared' when m.j is null then 'disappeared' else 'both' end as state from (select * from m where dim in {_names(S.MOVING)}) m full join p1 using (dim, bucket)),
moves as (select * from ({_MOVES}) where rank <= 25 union all select * from (select 'profiles', state, dim, bucket, null, row_number() over (partition by dim, state order by greatest(value, previous) desc, bucket) as rank, value::double, null, null, delta::double
  from dl where state <> 'both' and greatest(value, previous) >= 5) where rank <= 25),
cr as (select pair as dim, a as bucket, b, j, round(100 * j / sum(j) over (partition by pair, a), 2) as share, case when sn > 0 then floor(ss / sn + 0.50001) end as pay_avg from cells qualify j >= 3),
rs as (select rows_.* exclude (pay_avg), m.sn, case when sn > 0 then floor(ss / sn + 0.50001) end as pay_avg from rows_ join m using (dim, bucket)),
top as (select dim, bucket from rs where sn > 0 and dim in {_names(S.PAY_HISTOGRAMS)} qualify row_number() over (partition by dim order by sn desc, bucket) <= case dim {' '.join(f"when '{d}' then {n}" for d, n in S.PAY_HISTOGRAMS.items() if n)} else 1000000000 end),
bins as (select dim, bucket, cast(least(500000, floor(exp(bin / 100.0::double) / 10000) * 10000) as bigint) as low, sum(cnt) as cnt from hist semi join top using (dim, bucket) where hist = 's' group by 1, 2, 3)
select section, part, dim, bucket, other, cast(rank as int) as rank, jobs, share, pay, value from (
select {_sections(S.SECTIONS)} as section, 'rows' as part, dim, bucket, null::varchar as other, {_RANK} as rank, {_USUAL} from rs where dim in {_names(d for ds in S.SECTIONS.values() for d in ds)}
union all select {_sections(S.CROSS)}, 'cross', dim, bucket, b, row_number() over (partition by dim, bucket order by j desc, b), j::double, share, pay_avg, null from cr
union all select 'salary', 'overall', dim, bucket, null, {_RANK}, {_USUAL} from rs where dim = '_all'
union all select 'salary', 'by', dim, bucket, null, {_RANK}, {_USUAL} from rs where sn > 0 and dim in {_names(S.PAY_BY)}
union all select 'salary', 'histogram', dim, bucket, low::varchar, row_number() over (partition by dim, bucket order by low), null, null, null, cnt::double from bins
union all select 'salary', 'premium', dim, bucket, null, row_number() over (partition by dim order by premium_index desc, bucket), jobs::double, null, null, premium_index from rs where dim in {_names(S.PREMIUMS)} and premium_index <> 0 and sn >= 10
union all select * from moves)"""


def _layout(spark, d):
    df = RP.enriched(spark, d)
    today = staged(df.filter("job_key % 10 <> 2").select(*R.INPUTS))
    m = staged(R.one_way(today))
    dims = tuple(R.BY_NAME[n] for n in S.MOVING)
    before = R.exploded(df.filter("job_key % 10 <> 1"), dims).groupBy("dim", "bucket").agg(F.count("*").alias("j"))
    return S.report_sections(m, R.histograms(today, m), R.two_way(today), before)


@query("r9_section_layout", LAYOUT)
def layout(spark, d):
    """All seven sections with their rows, two-way rows, movers and pay parts, against the day before."""
    return _layout(spark, d)


@query("r9_section_documents", f"select section, count(*) as n_rows, count(distinct part || '/' || dim) as n_lists from ({LAYOUT}) group by 1")
def section_documents(spark, d):
    """The sections as JSON documents, and what stands in them when they are read back."""
    docs = S.documents(_layout(spark, d))
    lists = F.from_json("document", "map<string, array<struct<bucket string>>>")
    return docs.select("section", F.aggregate(F.map_values(lists), F.lit(0).cast("long"), lambda n, x: n + F.size(x)).alias("n_rows"), F.size(F.map_keys(lists)).cast("long").alias("n_lists"))
