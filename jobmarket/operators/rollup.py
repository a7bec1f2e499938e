"""Long-form rollups with mergeable log histograms.

A rollup is two additive tables: measures (dim, bucket, metric columns) and histograms (dim, bucket, hist, bin, cnt).
Days fold into weeks by summing, a day is taken back by summing with a negative sign.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmarket.sources.tables import staged

#: Bins per unit of ln(pay), quantiles, display bins.
SCALE, CROSS_SCALE = 100, 25
QUANTILES = {"p10": 0.1, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p90": 0.9}
DISPLAY_STEP, DISPLAY_MOST = 10_000, 500_000


@dataclass(frozen=True)
class Dim:
    name: str
    column: str
    listed: bool = False
    keep: int | None = None


#: The one-way dimensions and two-way pairs of the report, with the number of buckets that are kept by
#: jobs, and the names of the measures.
DIMS = (
    Dim("_all", "_all"), Dim("job_family", "job_family"), Dim("profile", "profile"), Dim("title", "title_clean", keep=500),
    Dim("seniority", "seniority"), Dim("yoe_band", "yoe_band"), Dim("yoe_years", "yoe_years"), Dim("country", "country"),
    Dim("region", "region"), Dim("city", "city_key", keep=500), Dim("work_mode", "work_mode"), Dim("employment_type", "employment_type"),
    Dim("industry", "industry"), Dim("company_size", "company_size"), Dim("company_age", "company_age"), Dim("company", "company_slug", keep=1000),
    Dim("education", "education"), Dim("visa", "visa"), Dim("equity", "equity_flag"), Dim("clearance", "clearance_flag"),
    Dim("technology", "technologies", listed=True), Dim("language", "language"), Dim("source", "source"), Dim("posting_age", "posting_age"),
    Dim("salary_band", "salary_band"), Dim("salary_currency", "sal_currency"), Dim("salary_source", "sal_source"), Dim("multi_location", "multi_location"),
)
PAIRS = (
    ("profile", "yoe_band", None), ("job_family", "yoe_band", None), ("seniority", "yoe_band", None), ("country", "yoe_band", 40),
    ("profile", "seniority", None), ("job_family", "seniority", None), ("profile", "work_mode", None), ("job_family", "work_mode", None),
    ("job_family", "industry", None), ("job_family", "company_size", None), ("job_family", "education", None), ("profile", "country", 40),
    ("job_family", "country", 40), ("region", "job_family", None), ("country", "seniority", 40), ("technology", "job_family", None),
    ("technology", "yoe_band", None), ("technology", "country", 25), ("industry", "seniority", None),
)
BY_NAME = {d.name: d for d in DIMS}
MEASURES = ("j", "n", "c", "r", "h", "o", "sn", "ss", "nn", "ns", "yn", "v", "e", "pn", "ps")


def _bucket(d: Dim) -> Column:
    """The bucket of a row in a dimension that is no list; null counts as unknown."""
    return F.coalesce(F.col(d.column).cast("string"), F.lit("unknown"))


def _values(d: Dim) -> Column:
    """The buckets of a row as an array; null and the empty list count as unknown."""
    if d.listed:
        own = F.col(d.column)
        return F.when(F.size(own) > 0, F.transform(own, lambda x: F.coalesce(x, F.lit("unknown")))).otherwise(F.array(F.lit("unknown")))
    return F.array(_bucket(d))


def _flags(df: DataFrame) -> DataFrame:
    """Only the columns that measures need, before rows are repeated once per dimension."""
    paid, new = F.col("sal_usd").isNotNull(), F.coalesce(F.col("is_new"), F.lit(False))
    return df.withColumns({
        "_new": new.cast("int"), "_r": (F.col("work_mode") == "remote").cast("int"), "_h": (F.col("work_mode") == "hybrid").cast("int"), "_o": (F.col("work_mode") == "onsite").cast("int"),
        "_sn": paid.cast("int"), "_nn": (paid & new).cast("int"), "_ns": F.when(new, F.col("sal_usd")), "_yn": F.col("yoe_min").isNotNull().cast("int"),
        "_v": (F.col("visa") == "offered").cast("int"), "_e": F.col("equity").cast("int"), "_pn": F.col("rel").isNotNull().cast("int"),
        "_bin": F.when(F.col("sal_usd") > 0, F.round(F.log("sal_usd") * SCALE).cast("int")), "_xbin": F.when(F.col("sal_usd") > 0, F.round(F.log("sal_usd") * CROSS_SCALE).cast("int")),
        "_ybin": F.when(F.col("yoe_min").isNotNull(), F.least(F.lit(20), F.greatest(F.lit(0), F.floor("yoe_min"))).cast("int")),
    })


#: What rollups read of the enriched frame.
INPUTS = tuple(dict.fromkeys([d.column for d in DIMS] + ["sal_usd", "is_new", "work_mode", "yoe_min", "visa", "equity", "rel"]))
ROW = ["company_slug", "sal_usd", "rel", "_new", "_r", "_h", "_o", "_sn", "_nn", "_ns", "_yn", "_v", "_e", "_pn", "_bin", "_xbin", "_ybin"]


def exploded(df: DataFrame, dims: tuple[Dim, ...] = DIMS) -> DataFrame:
    """(dim, bucket, row columns): each row once per dimension and bucket, in one pass."""
    return _flags(df).select(*ROW, F.inline(_pairs(dims)))


def _pairs(dims: tuple[Dim, ...]) -> Column:
    """All (dim, bucket) of a row. Only lists go through a lambda, which is slow."""
    plain = [F.struct(F.lit(d.name).alias("dim"), _bucket(d).alias("bucket")) for d in dims if not d.listed]
    listed = [F.transform(_values(d), _tag(d.name)) for d in dims if d.listed]
    return F.concat(*([F.array(*plain)] if plain else []), *listed)


def _tag(name: str):
    return lambda x: F.struct(F.lit(name).alias("dim"), x.alias("bucket"))


#: Buckets of a dimension whose companies are counted by bits, and the bits of a word.
FEW_BUCKETS, BITS = 60, 63


def companies(df: DataFrame, sizes: DataFrame, dims: tuple[Dim, ...]) -> DataFrame:
    """(dim, bucket, c): distinct companies of every bucket; sizes: (dim, bucket) of all buckets.

    Dimensions of few buckets are counted together: a company's buckets are bits of a few numbers, joined by OR, so that
    a row is not repeated per dimension. The others are reduced to distinct (dim, bucket, company) first."""
    few = sizes.groupBy("dim").agg(F.count("*").alias("n")).filter(F.col("n") <= FEW_BUCKETS).select("dim")
    names = sorted((r["dim"], r["bucket"]) for r in sizes.join(few, "dim").select("dim", "bucket").collect())
    place = {x: divmod(i, BITS) for i, x in enumerate(names)}
    small = [d for d in dims if any(d.name == n for n, _ in names)]
    large = tuple(d for d in dims if d not in small)
    own = df.filter("company_slug is not null")
    parts = []
    if small:
        words = [F.lit(0).cast("long")] * (1 + max(w for w, _ in place.values()))
        for d in small:
            for w in sorted({place[x][0] for x in names if x[0] == d.name}):
                bits = F.create_map(*[F.lit(v) for (n, b), (at, i) in place.items() if n == d.name and at == w for v in (b, 1 << i)])
                words[w] = words[w].bitwiseOR(F.aggregate(_values(d), F.lit(0).cast("long"), _or(bits)) if d.listed else _bit(bits, _bucket(d)))
        packed = own.select("company_slug", *[w.alias(f"w{i}") for i, w in enumerate(words)]).groupBy("company_slug").agg(*[F.bit_or(f"w{i}").alias(f"w{i}") for i in range(len(words))])
        # The few numbers of all companies are split into bits and counted by bit before anything is shuffled.
        bit = F.explode(F.flatten(F.array(*[F.filter(F.array(*[F.when(F.col(f"w{i}").bitwiseAND(F.lit(1 << b)) != 0, F.lit(i * BITS + b)) for b in range(BITS)]), lambda x: x.isNotNull()) for i in range(len(words))]))).alias("bit")
        known = df.sparkSession.createDataFrame([(i, *x) for i, x in enumerate(names)], "bit int, dim string, bucket string")
        parts.append(packed.select(bit).groupBy("bit").agg(F.count("*").alias("c")).join(F.broadcast(known), "bit").select("dim", "bucket", "c"))
    if large:
        parts.append(own.select("company_slug", F.inline(_pairs(large))).distinct().groupBy("dim", "bucket").agg(F.count("*").alias("c")))
    out = parts[0]
    for x in parts[1:]:
        out = out.unionByName(x)
    return out


def _bit(bits: Column, bucket: Column) -> Column:
    return F.coalesce(bits[bucket], F.lit(0)).cast("long")


def _or(bits: Column):
    return lambda acc, x: acc.bitwiseOR(_bit(bits, x))


def one_way(df: DataFrame, dims: tuple[Dim, ...] = DIMS) -> DataFrame:
    """(dim, bucket, measures): the 15 additive measures; dimensions with a bound keep their largest buckets (ties: bucket
    ascending). df is read several times, so it should be a written table. Rows are summed by bucket before any
    shuffle, and companies are counted apart, as sums by bucket and company would hardly reduce the rows."""
    sums = {"j": F.count("*"), "n": F.sum("_new"), "r": F.sum("_r"), "h": F.sum("_h"), "o": F.sum("_o"), "sn": F.sum("_sn"), "ss": F.sum("sal_usd"), "nn": F.sum("_nn"), "ns": F.sum("_ns"), "yn": F.sum("_yn"), "v": F.sum("_v"), "e": F.sum("_e"), "pn": F.sum("_pn"), "ps": F.sum("rel")}
    out = staged(exploded(df, dims).groupBy("dim", "bucket").agg(*[a.alias(k) for k, a in sums.items()]))
    counted = companies(df, out, dims)
    bounded = {d.name: d.keep for d in dims if d.keep}
    kept = largest(out, "dim", "bucket", "j", bounded) if bounded else out
    return kept.join(counted, ["dim", "bucket"], "left").select("dim", "bucket", *MEASURES).fillna(0, subset=list(MEASURES))


def largest(rows: DataFrame, group: str, item: str, size: str, bounds: dict[str, int]) -> DataFrame:
    """The largest items (ties: item ascending) of the groups that have a bound, and all items of the others.

    The largest bound is a literal, so every task keeps that many rows of a group before the shuffle; items of groups
    without a bound stand alone in the window and spread over all tasks."""
    limit = F.create_map(*[x for k, v in bounds.items() for x in (F.lit(k), F.lit(v))])[F.col(group)]
    by = Window.partitionBy(group, F.when(limit.isNull(), F.col(item))).orderBy(F.desc(size), item)
    return rows.withColumn("_rank", F.row_number().over(by)).filter((F.col("_rank") <= max(bounds.values())) & (limit.isNull() | (F.col("_rank") <= limit))).drop("_rank")


def histograms(df: DataFrame, kept: DataFrame, dims: tuple[Dim, ...] = DIMS) -> DataFrame:
    """(dim, bucket, hist, bin, cnt) for pay (s), pay of new postings (n) and years (y), of the kept buckets only.

    Dimensions with a bound keep few buckets, which are broadcast to the rows, so that bins of others are not made; pay
    of new postings is counted with all pay, so that a row comes twice per bucket and not three times."""
    f, pairs = _flags(df), []
    for d in dims:
        if d.keep and not d.listed:
            names = kept.filter(F.col("dim") == d.name).select(F.col("bucket").alias(f"_k_{d.name}"))
            f = f.join(F.broadcast(names), _bucket(d) == F.col(f"_k_{d.name}"), "left")
            pairs.append(F.struct(F.lit(d.name).alias("dim"), F.col(f"_k_{d.name}").alias("bucket")))
    rest = tuple(d for d in dims if not d.keep or d.listed)
    pairs = F.concat(*([F.array(*pairs)] if pairs else []), *([_pairs(rest)] if rest else []))
    bins = F.array(F.struct(F.lit("s").alias("hist"), F.col("_bin").alias("bin")), F.struct(F.lit("y").alias("hist"), F.col("_ybin").alias("bin")))
    rows = f.select("_new", "_bin", "_ybin", F.inline(pairs)).filter("bucket is not null")
    counts = rows.select("_new", "dim", "bucket", F.inline(bins)).filter("bin is not null").groupBy("dim", "bucket", "hist", "bin").agg(F.count("*").alias("all"), F.sum("_new").alias("new"))
    each = F.array(F.struct(F.col("hist"), F.col("all").alias("cnt")), F.struct(F.lit("n").alias("hist"), F.when(F.col("hist") == "s", F.col("new")).alias("cnt")))
    return counts.select("dim", "bucket", "bin", F.inline(each)).filter("cnt > 0").join(kept.select("dim", "bucket"), ["dim", "bucket"], "left_semi").select("dim", "bucket", "hist", "bin", "cnt")


def two_way(df: DataFrame, pairs=PAIRS) -> DataFrame:
    """(pair, a, b, j, n, r, sn, ss, yn); where bounded, b keeps its most frequent values by rows."""
    f = _flags(df)
    plain = [F.struct(F.lit(f"{a}|{b}").alias("pair"), _bucket(BY_NAME[a]).alias("a"), _bucket(BY_NAME[b]).alias("b")) for a, b, _ in pairs if not (BY_NAME[a].listed or BY_NAME[b].listed)]
    listed = [F.flatten(F.transform(_values(BY_NAME[a]), _cross(f"{a}|{b}", _values(BY_NAME[b])))) for a, b, _ in pairs if BY_NAME[a].listed or BY_NAME[b].listed]
    cells = F.concat(*([F.array(*plain)] if plain else []), *listed)
    rows = f.select("sal_usd", "_new", "_r", "_sn", "_yn", F.inline(cells))
    out = rows.groupBy("pair", "a", "b").agg(F.count("*").alias("j"), F.sum("_new").alias("n"), F.sum("_r").alias("r"), F.sum("_sn").alias("sn"), F.coalesce(F.sum("sal_usd"), F.lit(0.0)).alias("ss"), F.sum("_yn").alias("yn"))
    bounded = {f"{a}|{b}": k for a, b, k in pairs if k}
    if not bounded:
        return out
    out = staged(out)
    kept = largest(out.groupBy("pair", "b").agg(F.sum("j").alias("_t")), "pair", "b", "_t", bounded)
    return out.join(kept.select("pair", "b"), ["pair", "b"], "left_semi")


def _cross(pair: str, others: Column):
    return lambda x: F.transform(others, lambda y: F.struct(F.lit(pair).alias("pair"), x.alias("a"), y.alias("b")))


def local_pay(df: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, n, s): number and sum of pay in local currency."""
    return df.filter("sal_local is not null").groupBy(*keys).agg(F.count("*").alias("n"), F.sum("sal_local").alias("s"))


def value_pairs(df: DataFrame, column: str, top: int) -> DataFrame:
    """(a, b, j): unordered pairs of distinct values of a list column, the most frequent first (ties: a, b)."""
    s = F.array_sort(F.array_distinct(F.filter(column, lambda x: x.isNotNull())))
    pairs = F.flatten(F.transform(s, lambda x, i: F.transform(F.slice(s, i + 2, F.greatest(F.size(s) - i - 1, F.lit(0))), lambda y: F.struct(x.alias("a"), y.alias("b")))))
    return df.select(F.inline(pairs)).groupBy("a", "b").agg(F.count("*").alias("j")).orderBy(F.desc("j"), "a", "b").limit(top)


def quantiles(hist: DataFrame, keys: list[str], scale: int = SCALE, qs: dict[str, float] | None = None) -> DataFrame:
    """Quantiles from (keys, bin, cnt): the value of the first bin whose running count reaches q times the total."""
    qs = qs or QUANTILES
    by = Window.partitionBy(*keys)
    run = F.sum("cnt").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = hist.withColumns({"_run": run, "_total": F.sum("cnt").over(by)})
    first = lambda q: F.min(F.when(F.col("_run") >= F.col("_total") * q, F.col("bin")))
    return h.groupBy(*keys).agg(F.max("_total").alias("cnt"), *[F.round(F.exp(first(q) / F.lit(float(scale)))).cast("long").alias(n) for n, q in qs.items()])


def integer_median(hist: DataFrame, keys: list[str], name: str = "median") -> DataFrame:
    """First value whose running count reaches half."""
    by = Window.partitionBy(*keys)
    run = F.sum("cnt").over(by.orderBy("bin").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    h = hist.withColumns({"_run": run, "_total": F.sum("cnt").over(by)})
    return h.groupBy(*keys).agg(F.min(F.when(F.col("_run") * 2 >= F.col("_total"), F.col("bin"))).alias(name))


def display_bins(hist: DataFrame, keys: list[str], scale: int = SCALE) -> DataFrame:
    """Log bins as bins of 10,000, the last one open."""
    low = F.least(F.lit(DISPLAY_MOST), (F.floor(F.exp(F.col("bin") / F.lit(float(scale))) / DISPLAY_STEP) * DISPLAY_STEP)).cast("long")
    return hist.groupBy(*keys, low.alias("low")).agg(F.sum("cnt").alias("cnt"))


def merge(parts: list[tuple[DataFrame, int]], keys: list[str], measures: list[str]) -> DataFrame:
    """Signed sum of rollups; rows whose measures are all zero vanish."""
    out = None
    for df, sign in parts:
        signed = df.select(*keys, *[(F.col(m) * sign).alias(m) for m in measures])
        out = signed if out is None else out.unionByName(signed)
    out = out.groupBy(*keys).agg(*[F.sum(m).alias(m) for m in measures])
    keep = F.lit(False)
    for m in measures:
        keep = keep | (F.abs(F.col(m)) > 1e-6)
    return out.filter(keep)


def pct(a: Column, b: Column) -> Column:
    """100 a / b to two digits; null on zero."""
    return F.round(F.try_divide(100 * a, b), 2)


def bucket_rows(measures: DataFrame, hist: DataFrame, days: int = 1) -> DataFrame:
    """Report rows per (dim, bucket): daily averages, shares, pay statistics and the thin-sample flag."""
    pay = quantiles(hist.filter("hist = 's'"), ["dim", "bucket"])
    years = integer_median(hist.filter("hist = 'y'"), ["dim", "bucket"], "yoe_median")
    all_jobs = measures.filter("dim = '_all'").agg(F.sum("j").alias("_all_jobs"))
    m = measures.join(pay.drop("cnt"), ["dim", "bucket"], "left").join(years, ["dim", "bucket"], "left").join(F.broadcast(all_jobs))
    c = F.col
    return m.select(
        "dim", "bucket", F.round(c("j") / days, 2).alias("jobs"), pct(c("j"), c("_all_jobs")).alias("share"), F.round(c("n") / days, 2).alias("new"),
        F.round(c("c") / days, 2).alias("companies"), pct(c("r"), c("j")).alias("remote_pct"), pct(c("h"), c("j")).alias("hybrid_pct"), pct(c("o"), c("j")).alias("onsite_pct"),
        pct(c("v"), c("j")).alias("visa_pct"), pct(c("e"), c("j")).alias("equity_pct"), pct(c("sn"), c("j")).alias("disclosed_pct"), pct(c("yn"), c("j")).alias("yoe_pct"),
        F.round(F.try_divide(c("ss"), c("sn")), 2).alias("pay_avg"), F.round(F.try_divide(c("ps"), c("pn")), 4).alias("premium_index"),
        (c("sn") / days < 30).alias("thin"), *QUANTILES, "yoe_median",
    )


def cross_rows(cells: DataFrame, days: int = 1) -> DataFrame:
    """Two-way report rows: cells of at least 3 jobs a day, with the share inside a."""
    share = pct(F.col("j"), F.sum("j").over(Window.partitionBy("pair", "a")))
    return cells.withColumn("share", share).filter(F.col("j") >= 3 * days).select("pair", "a", "b", "j", "n", "share", pct(F.col("r"), F.col("j")).alias("remote_pct"), F.round(F.try_divide(F.col("ss"), F.col("sn")), 2).alias("pay_avg"))


def deltas(now: DataFrame, before: DataFrame, keys: list[str], measure: str = "j", suffix: str = "") -> DataFrame:
    """Full outer comparison of a measure: value, previous value, difference, percent, and in which of the two it is."""
    a = now.select(*keys, F.col(measure).alias("value"))
    b = before.select(*keys, F.col(measure).alias("previous"))
    out = a.join(b, keys, "full_outer")
    state = F.when(F.col("previous").isNull(), "appeared").when(F.col("value").isNull(), "disappeared").otherwise("both")
    diff = F.coalesce("value", F.lit(0)) - F.coalesce("previous", F.lit(0))
    return out.select(*keys, F.coalesce("value", F.lit(0)).alias("value"), F.coalesce("previous", F.lit(0)).alias("previous"), diff.alias(f"delta{suffix}"), pct(diff, F.col("previous")).alias(f"delta_pct{suffix}"), state.alias("state"))


def movers(delta: DataFrame, top: int = 25, base: int = 20) -> DataFrame:
    """The largest risers and fallers per dimension, by number and (from a base) by percent."""
    lists = []
    for kind, value, rows in (("absolute", "delta", delta), ("percent", "delta_pct", delta.filter(F.col("previous") >= base))):
        for direction, order in (("up", F.desc(value)), ("down", F.asc(value))):
            own = rows.filter((F.col(value) > 0) if direction == "up" else (F.col(value) < 0))
            rank = F.row_number().over(Window.partitionBy("dim").orderBy(order, "bucket"))
            lists.append(own.withColumns({"kind": F.lit(kind), "direction": F.lit(direction), "rank": rank}).filter(F.col("rank") <= top))
    out = lists[0]
    for x in lists[1:]:
        out = out.unionByName(x)
    return out.select("dim", "kind", "direction", "rank", "bucket", "value", "previous", "delta", "delta_pct")
