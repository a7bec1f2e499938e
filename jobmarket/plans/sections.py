"""The report's sections as one long table and as documents (R9): rows, two-way rows, movers, pay breakdowns."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmarket.operators import rollup as R
from jobmarket.sources.tables import staged

#: The dimensions and pairs of each section, dimensions with movers, dimensions by which pay is broken
#: down, those with pay histograms (and how many of their buckets, by paid postings), those with premiums, least counts.
SECTIONS = {
    "profiles": ("job_family", "profile", "title", "seniority"),
    "experience": ("yoe_band", "yoe_years"),
    "geography": ("region", "country", "city", "multi_location"),
    "skills": ("technology",),
    "companies": ("company", "industry", "company_size", "company_age"),
    "attributes": ("work_mode", "employment_type", "education", "visa", "equity", "clearance", "language", "source", "posting_age"),
    "salary": ("salary_band", "salary_currency", "salary_source"),
}
CROSS = {
    "experience": ("profile|yoe_band", "job_family|yoe_band", "seniority|yoe_band", "country|yoe_band"),
    "profiles": ("profile|seniority", "job_family|seniority", "profile|work_mode", "job_family|work_mode", "job_family|industry", "job_family|company_size", "job_family|education", "industry|seniority"),
    "geography": ("profile|country", "job_family|country", "region|job_family", "country|seniority"),
    "skills": ("technology|job_family", "technology|yoe_band", "technology|country"),
}
MOVING = ("job_family", "profile", "title", "seniority", "country", "city", "technology", "company", "industry")
PAY_BY = ("job_family", "profile", "seniority", "yoe_band", "yoe_years", "country", "region", "work_mode", "employment_type", "industry", "company_size", "company_age", "education", "visa", "equity", "language")
PAY_HISTOGRAMS = {"_all": None, "job_family": None, "seniority": None, "yoe_band": None, "region": None, "country": 15, "profile": 25, "work_mode": None}
PREMIUMS = ("country", "city", "technology", "industry", "company_size", "education", "work_mode", "seniority", "company")
PREMIUM_LEAST, MOVERS_MOST, STATE_LEAST = 10, 25, 5


def _section_of(parts: dict[str, tuple[str, ...]], column: str) -> Column:
    return F.create_map(*[F.lit(x) for name, dims in parts.items() for d in dims for x in (d, name)])[F.col(column)]


def _pay() -> Column:
    """Mean pay in whole units. Halves go up, and so does what is a hair below one, so that sums of the same rows in
    another order come to the same number."""
    return F.floor(F.try_divide("ss", F.col("sn")) + 0.50001)


def _part(df: DataFrame, section: Column, part: Column | str, order: list[Column], group: tuple[str, ...] = ("dim",), **values: Column) -> DataFrame:
    """Rows of one part with their rank inside the group; groups are lists of the report, so they are short."""
    null = F.lit(None)
    rank = F.row_number().over(Window.partitionBy(*group).orderBy(*order))
    other = values.get("other", null).cast("string").alias("other")
    numbers = [values.get(c, null).cast("double").alias(c) for c in ("jobs", "share", "pay", "value")]
    return df.select(section.alias("section"), (F.lit(part) if isinstance(part, str) else part).alias("part"), "dim", "bucket", other, rank.alias("rank"), *numbers)


def report_sections(measures: DataFrame, hist: DataFrame, cells: DataFrame, before: DataFrame | None = None, days: int = 1) -> DataFrame:
    """(section, part, dim, bucket, other, rank, jobs, share, pay, value): the whole layout of a report.

    measures, hist and cells are the rollups of the report's days; before: (dim, bucket, j) of the comparison base, or
    None, which leaves the movers out. Parts: rows (every bucket, value is the median pay), cross (pair as dim, second
    bucket as other), risers, fallers and their percent forms (value is the difference, share its percent), appeared and
    disappeared (5 jobs or more), overall and by (pay), histogram (other is the lower end of a bin, value its count) and
    premium (value). Ranks start at 1 in every list; ties go by bucket. Empty rollups give an empty table."""
    c = F.col
    rows = staged(R.bucket_rows(measures, hist, days).drop("pay_avg").join(measures.select("dim", "bucket", "sn", _pay().alias("pay_avg")), ["dim", "bucket"]))
    usual = {"jobs": c("jobs"), "share": c("share"), "pay": c("pay_avg"), "value": c("p50")}
    by_jobs, salary = [F.desc("jobs"), F.asc("bucket")], F.lit("salary")
    listed = rows.filter(c("dim").isin(*[d for dims in SECTIONS.values() for d in dims]))
    whole = cells.filter(c("pair").isin(*[p for ps in CROSS.values() for p in ps])).withColumns({"ss": _pay(), "sn": F.least("sn", F.lit(1))})
    cross = R.cross_rows(whole, days).withColumnsRenamed({"pair": "dim", "a": "bucket"})
    paid = rows.filter("sn > 0")
    premium = rows.filter(c("dim").isin(*PREMIUMS) & (c("premium_index") != 0) & (c("sn") >= PREMIUM_LEAST * days))
    shown = rows.filter(c("dim").isin(*PAY_HISTOGRAMS) & (c("sn") > 0))
    shown = R.largest(shown, "dim", "bucket", "sn", {d: n for d, n in PAY_HISTOGRAMS.items() if n}).select("dim", "bucket")
    bins = R.display_bins(hist.filter("hist = 's'").join(shown, ["dim", "bucket"], "left_semi"), ["dim", "bucket"])
    parts = [
        _part(listed, _section_of(SECTIONS, "dim"), "rows", by_jobs, **usual),
        _part(cross, _section_of(CROSS, "dim"), "cross", [F.desc("j"), F.asc("b")], ("dim", "bucket"), other=c("b"), jobs=c("j"), share=c("share"), pay=c("pay_avg")),
        _part(rows.filter("dim = '_all'"), salary, "overall", by_jobs, **usual),
        _part(paid.filter(c("dim").isin(*PAY_BY)), salary, "by", by_jobs, **usual),
        _part(bins, salary, "histogram", [F.asc("low")], ("dim", "bucket"), other=c("low"), value=c("cnt")),
        _part(premium, salary, "premium", [F.desc("premium_index"), F.asc("bucket")], jobs=c("jobs"), value=c("premium_index")),
    ]
    if before is not None:
        parts.append(_moves(measures, before))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def _moves(measures: DataFrame, before: DataFrame) -> DataFrame:
    """Movers among the kept buckets, and buckets that came or went."""
    c, moving = F.col, F.col("dim").isin(*MOVING)
    delta = staged(R.deltas(measures.filter(moving).select("dim", "bucket", "j"), before.filter(moving).select("dim", "bucket", "j"), ["dim", "bucket"]))
    moved = R.movers(delta.filter("state != 'disappeared'"), MOVERS_MOST)
    name = F.concat(F.when(c("direction") == "up", "risers").otherwise("fallers"), F.when(c("kind") == "percent", "_pct").otherwise(""))
    moved = moved.select(F.lit("profiles").alias("section"), name.alias("part"), "dim", "bucket", F.lit(None).cast("string").alias("other"), "rank", c("value").cast("double").alias("jobs"), c("delta_pct").cast("double").alias("share"), F.lit(None).cast("double").alias("pay"), c("delta").cast("double").alias("value"))
    size = F.greatest("value", "previous")
    states = delta.filter((c("state") != "both") & (size >= STATE_LEAST))
    states = _part(states, F.lit("profiles"), c("state"), [F.desc(size), F.asc("bucket")], ("dim", "state"), jobs=c("value"), value=c("delta")).filter(c("rank") <= MOVERS_MOST)
    return moved.unionByName(states)


def documents(sections: DataFrame) -> DataFrame:
    """(section, document, n_rows): every section as one JSON object of its lists, by part and dimension. A list has at
    most as many entries as its dimension keeps buckets, so a document does not grow with the postings."""
    entry = F.to_json(F.struct("bucket", "other", "jobs", "share", "pay", "value"))
    lists = sections.groupBy("section", "part", "dim").agg(F.sort_array(F.collect_list(F.struct("bucket", "rank", entry.alias("e")))).alias("l"), F.count("*").alias("n"))
    # Rows of a cross list are ranked inside their first bucket, all others inside the list.
    ordered = F.when(F.col("part").isin("cross", "histogram"), F.col("l")).otherwise(F.array_sort("l", lambda a, b: a["rank"] - b["rank"]))
    lists = lists.select("section", F.concat(F.lit('"'), "part", F.lit("/"), "dim", F.lit('":['), F.array_join(F.transform(ordered, lambda x: x["e"]), ","), F.lit("]")).alias("field"), "n")
    return lists.groupBy("section").agg(F.concat(F.lit("{"), F.array_join(F.sort_array(F.collect_list("field")), ","), F.lit("}")).alias("document"), F.sum("n").alias("n_rows"))
