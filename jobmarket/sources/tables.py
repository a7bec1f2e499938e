"""Scans and sinks (S1-S4, S6, S11-S18, F10-F11 sinks): declared schemas, versioned overwrites, no inference."""

from __future__ import annotations

import re
import tempfile
import uuid
from functools import cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POSTINGS = "job_key long, company_slug string, board_slug string, source string, title_clean string, seniority string, sal_min double, sal_max double, sal_currency string, yoe_min double, technologies array<string>, posted_day int"
#: Upper bounds of the age bands, in years.
AGE_BANDS = ((5, "<5y"), (10, "5-10y"), (20, "10-20y"), (50, "20-50y"))
BOARD_STATUS = "shard int, shards int, finished_at string, elapsed_s double, boards array<struct<board_slug:string,company_slug:string,monitor_type:string,status:string,jobs:int,error:string>>"


def staging(spark: SparkSession) -> str:
    """A new folder that the driver and all executors share, under spark.checkpoint.dir. A session in one local process
    that names none gets a folder of its own; on a cluster there is no folder to guess."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not re.fullmatch(r"local(\[[^]]*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = _local_dir()
    return f"{found.rstrip('/')}/{uuid.uuid4().hex}"


@cache
def _local_dir() -> str:
    return tempfile.mkdtemp(prefix="jobmarket-")


def staged(df: DataFrame) -> DataFrame:
    """df as a written table, for results that several branches of a plan read."""
    path = staging(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def posting_shards(spark: SparkSession, paths: list[str], schema: str = POSTINGS) -> DataFrame:
    """All shards in one frame; columns that a shard lacks are null; no path gives an empty frame of the schema."""
    empty = spark.createDataFrame([], schema)
    out = empty
    for p in paths:
        out = out.unionByName(spark.read.parquet(p), allowMissingColumns=True)
    return out.select(*empty.columns)


def board_statuses(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(statuses, shards that reported) of status files."""
    raw = spark.read.schema(BOARD_STATUS).json(path, multiLine=True)
    return raw.select(F.explode("boards").alias("b")).select("b.*"), raw.select("shard", "shards").distinct()


def taxonomy(spark: SparkSession, path: str, schema: str, keys: list[str], locales: list[str]) -> DataFrame:
    """A taxonomy CSV with one row per (keys, locale, alias)."""
    t = spark.read.csv(path, header=True, schema=schema, escape='"')
    return t.unpivot(keys, locales, "locale", "alias").filter("alias is not null")


def companies(spark: SparkSession, path: str, schema: str, industries: DataFrame, year: int) -> DataFrame:
    """Companies with the name of their industry and an age band; a founding year that is no number is unknown."""
    c = spark.read.csv(path, header=True, schema=schema, escape='"').join(industries, "industry", "left")
    age = F.lit(year) - F.trim("founded_year").try_cast("int")
    bands = F.when(age.isNull(), "unknown")
    for below, name in AGE_BANDS:
        bands = bands.when(age < below, name)
    return c.withColumns({"industry_name": F.coalesce("industry_name", F.lit("Unknown")), "company_age": bands.otherwise("50y+")})


def rates(first: DataFrame, second: DataFrame, previous: DataFrame) -> DataFrame:
    """(currency, rate): a second source and then the previous day fill gaps only; USD is 1."""
    fill = lambda a, b: a.unionByName(b.join(a.select("currency"), "currency", "left_anti"))
    usd = first.sparkSession.createDataFrame([("USD", 1.0)], "currency string, rate double")
    return fill(fill(fill(usd, first), second), previous)


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines; one bad line fails the read."""
    return spark.read.schema(schema).json(path, mode="FAILFAST")


def write_by_date(df: DataFrame, path: str, day: str = "date") -> None:
    """Replaces the dates that df holds, leaves others alone."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(day).json(path)


def write_shard(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def write_version(df: DataFrame, root: str, require_rows: bool = True) -> str:
    """Writes a new version beside the old ones and returns its path; refuses an empty table."""
    if require_rows and df.isEmpty():
        raise ValueError("refusing to write an empty table")
    path = f"{root}/v-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return path


def write_document(df: DataFrame, path: str) -> None:
    """A report as one JSON document per row."""
    df.select(F.to_json(F.struct("*")).alias("value")).write.mode("overwrite").text(path)


def latest(df: DataFrame, day: str, n: int = 8) -> DataFrame:
    return df.orderBy(F.desc(day)).limit(n)


def jdbc(spark: SparkSession, url: str, name: str, **options: str) -> DataFrame:
    return spark.read.format("jdbc").options(url=url, dbtable=name, **options).load()


def jdbc_by_ranges(spark: SparkSession, url: str, name: str, key: str, rows: int = 1_000_000, most: int = 200, quote: str = '"', **options: str) -> DataFrame:
    """A table read over several connections at once, by ranges of a numeric or date key: about so many rows a range, at
    most so many ranges. The bounds come from one aggregate that the database computes; rows with a null key go with
    the first range. A table without keys is read over one connection."""
    bounds = jdbc(spark, url, f"(select min({quote}{key}{quote}) lo, max({quote}{key}{quote}) hi, count({quote}{key}{quote}) n from {name}) b", **options).toDF("lo", "hi", "n").first()
    parts = min(most, -(-bounds["n"] // rows))
    if parts < 2:
        return jdbc(spark, url, name, **options)
    return jdbc(spark, url, name, partitionColumn=key, lowerBound=str(bounds["lo"]), upperBound=str(bounds["hi"]), numPartitions=str(parts), **options)


def write_jdbc(df: DataFrame, url: str, name: str, **options: str) -> None:
    """Appends df to a table; Spark writes a partition per connection."""
    df.write.format("jdbc").options(url=url, dbtable=name, **options).mode("append").save()


def checked_scan(df: DataFrame, columns: dict[str, str], rows: int | None = None) -> DataFrame:
    """Required columns only, cast tolerantly; a row count that differs from the manifest is an error."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    if rows is not None and (n := df.count()) != rows:
        raise ValueError(f"{n} rows, the manifest says {rows}")
    return df.select(*[F.col(c).try_cast(t).alias(c) for c, t in columns.items()])
