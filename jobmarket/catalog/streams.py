"""Queries of the stateful operators in their batch form, and windowed folds."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.plans.frame import read
from jobmarket.sources.tables import staging
from jobmarket.streaming import boards as B
from jobmarket.streaming import timed_boards as TB

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


@query("t7_board_health")
def health(spark, d):
    """Final state of every board's health machine."""
    return B.health_batch(B.outcomes(read(spark, d, "events")))


@query("t7_timed_checks")
def timed_checks(spark, d):
    """Every check or confirmation of a board whose time passed without an event, by a stream with timers."""
    root, path = staging(spark), f"{d}/events.parquet"
    stream = B.outcomes(spark.readStream.schema(spark.read.parquet(path).schema).parquet(f"{d}/events.parque[t]"))  # a stream takes a single file by a pattern only
    out = TB.run_to_end(spark, TB.timed_health(stream), f"{root}/out", f"{root}/checkpoint")
    return out.filter(F.col("cause") == TB.DUE).select("board", "at", "status", "failures", "gone_count", "next_check_minutes")


@query("t11_daily_points", "select cast(ts as date) as day, event_id, value from events qualify row_number() over (partition by cast(ts as date) order by event_id desc) = 1")
def points(spark, d):
    """One point per day, the latest wins."""
    e = read(spark, d, "events").select(F.col("ts").cast("date").alias("day"), "event_id", "value")
    return B.latest_points(e, "day", "event_id").select("day", "event_id", "value")


@query("t4_bad_rows", "select value is not null and value >= 0 as ok, count(*) as n from events group by 1")
def bad_rows(spark, d):
    """T4: valid and quarantined rows."""
    return read(spark, d, "events").groupBy(F.coalesce(F.col("value") >= 0, F.lit(False)).alias("ok")).agg(F.count("*").alias("n"))


@query("t2_min_cursor", "select max(ts) as ts, max(event_id) as id from events where event_id = (select min(m) from (select max(event_id) as m from events where user_id % 2 = 0 union all select max(event_id) from events where user_id % 2 = 1))")
def cursors(spark, d):
    """The smaller cursor of two sinks."""
    e = read(spark, d, "events")
    last = lambda k: e.filter(F.col("user_id") % 2 == k).agg(F.max(F.struct("event_id", "ts")).alias("m")).select(F.col("m.ts").alias("ts"), F.col("m.event_id").alias("id"))
    pair = last(0).unionByName(last(1))
    return pair.orderBy("id").limit(1)
