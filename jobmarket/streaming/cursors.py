"""Exports that go on from a cursor (T1-T3), and reconciliation that goes on where it broke off.

Both keep their progress as small tables beside their results, written after them, and results of a step have a place of
their own that a repeated step overwrites: a run that ends anywhere is repeated without a row twice or lost.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def fence(writers: DataFrame, now: Column, lag: str = "5 seconds") -> Column:
    """Up to where an export may read: so much before now, and before the start of the oldest writer that is still open
    (writers: started_at), since it can still write rows with times from its start on."""
    oldest = writers.agg(F.min("started_at").alias("t")).first()["t"]
    return F.least(now - F.expr(f"interval {lag}"), F.lit(oldest).cast("timestamp"))


class Cursors:
    """The last (time, id) that each sink has, as one small table a sink and step."""

    def __init__(self, spark: SparkSession, path: str, schema: str) -> None:
        self.spark, self.path, self.schema = spark, path.rstrip("/"), f"step int, {schema}"

    def _table(self, sink: str) -> DataFrame:
        path = f"{self.path}/{sink}"
        return self.spark.read.schema(self.schema).parquet(f"{path}/*") if _exists(self.spark, path) else self.spark.createDataFrame([], self.schema)

    def last(self, sink: str):
        """The row (step, ts, id) of a sink's last step; null before the first."""
        return self._table(sink).orderBy(F.desc("step")).first()

    def advance(self, sink: str, step: int, end: DataFrame) -> None:
        end.select(F.lit(step).alias("step"), "*").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/{sink}/{step}")

    def least(self, sinks: list[str]):
        """(ts, id) of the sink that is furthest behind: what lies before it may go; null while a sink has nothing."""
        found = [self.last(s) for s in sinks]
        return None if None in found else min((r["ts"], r["id"]) for r in found)


def export(source: DataFrame, ts: str, ident: str, sinks: dict[str, str], state: str, end: Column, fail_before_cursor: str | None = None) -> dict[str, int]:
    """Writes to every sink (name -> folder) the rows between its cursor and end, by (ts, id), and moves its cursor; the
    number of the step written for each sink, 0 where there was nothing to do.

    A sink that fails keeps its cursor, and the others go on. Its next step has the same number and folder, so what it
    has left behind is overwritten. Rows without a time or id have no place in the order and are not exported; rows that
    share both go together. fail_before_cursor: a sink to break off at, for tests."""
    spark = source.sparkSession
    kinds = dict(source.dtypes)
    cursors, out = Cursors(spark, state, f"ts {kinds[ts]}, id {kinds[ident]}"), {}
    for name, folder in sinks.items():
        last, t, i = cursors.last(name), F.col(ts), F.col(ident)
        rows = source.filter(t.isNotNull() & i.isNotNull() & (t < end))
        if last:
            # The plain bound is what reaches the scan; the rest tells rows of the cursor's own time apart.
            rows = rows.filter((t >= F.lit(last["ts"])) & ((t > F.lit(last["ts"])) | (i > F.lit(last["id"]))))
        step = (last["step"] if last else 0) + 1
        rows.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/step={step}")
        written = spark.read.schema(source.schema).parquet(f"{folder.rstrip('/')}/step={step}")
        top = written.agg(F.max(F.struct(F.col(ts).alias("ts"), F.col(ident).alias("id"))).alias("m")).select("m.*")
        if name == fail_before_cursor:
            raise RuntimeError(f"broken off before the cursor of {name}")
        done = top.filter("ts is not null")
        out[name] = 0 if done.isEmpty() else step
        if out[name]:
            cursors.advance(name, step, done)
    return out


def exported(spark: SparkSession, folder: str, state: str, name: str, schema: str) -> DataFrame:
    """All rows of a sink in steps that its cursor covers, with the step."""
    kinds = {f.split(" ")[0]: f for f in schema.split(", ")}
    last = Cursors(spark, state, "ts timestamp, id long").last(name)
    if last is None:
        return spark.createDataFrame([], f"{', '.join(kinds.values())}, step int")
    return spark.read.schema(f"{', '.join(kinds.values())}, step int").parquet(folder).filter(F.col("step") <= last["step"])


#: Buckets of ids, and how many of them a step takes.
BUCKETS, AT_ONCE = 256, 32


def _digests(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Per bucket of ids, what a set of rows comes to in any order: their number, and two sums of hashes of rows."""
    row = F.xxhash64(key, *columns)
    return df.groupBy("bucket").agg(F.count("*").alias("n"), F.bit_xor(row).alias("x"), F.sum(row.cast("decimal(38,0)")).alias("s"))


def reconcile(local: DataFrame, remote: DataFrame, key: str, columns: list[str], folder: str, buckets: int = BUCKETS, at_once: int = AT_ONCE, stop_after: int | None = None) -> DataFrame:
    """(key, kind): what differs between two tables: missing there, missing here, or changed. Keys are unique and not null.

    Ids are dealt to buckets by hash; digests of the buckets, which do not depend on the order of rows, tell those that
    are equal, and only rows of the others are compared, some buckets a step. A step's result is a folder of its own and
    counts as done once it is complete, so a run that ended is taken up after its last whole step, over the plan that
    it had written. A finished run is not repeated; a new one takes a new folder. stop_after: steps to end after, for tests."""
    spark = local.sparkSession
    bucket = F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int").alias("bucket")
    a, b = (df.select(bucket, key, *columns) for df in (local, remote))
    folder, kind = folder.rstrip("/"), dict(local.dtypes)[key]
    if not _exists(spark, f"{folder}/plan/_SUCCESS"):
        x, y = _digests(a, key, columns).alias("x"), _digests(b, key, columns).alias("y")
        same = F.col("x.n").eqNullSafe(F.col("y.n")) & F.col("x.x").eqNullSafe(F.col("y.x")) & F.col("x.s").eqNullSafe(F.col("y.s"))
        differ = x.join(y, F.col("x.bucket") == F.col("y.bucket"), "full").filter(~same).select(F.coalesce("x.bucket", "y.bucket").alias("bucket"))
        differ.coalesce(1).write.mode("overwrite").parquet(f"{folder}/plan")
    plan = sorted(r["bucket"] for r in spark.read.schema("bucket int").parquet(f"{folder}/plan").collect())  # at most the number of buckets
    steps = [plan[i : i + at_once] for i in range(0, len(plan), at_once)]
    for number, own in enumerate(steps):
        if stop_after is not None and number >= stop_after:
            break
        if _exists(spark, f"{folder}/found/step={number}/_SUCCESS"):
            continue
        here, there = a.filter(F.col("bucket").isin(own)).alias("a"), b.filter(F.col("bucket").isin(own)).alias("b")
        equal = F.lit(True)
        for c in columns:
            equal = equal & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
        what = F.when(F.col(f"b.{key}").isNull(), "missing there").when(F.col(f"a.{key}").isNull(), "missing here").when(~equal, "changed")
        rows = here.join(there, F.col(f"a.{key}") == F.col(f"b.{key}"), "full").select(F.coalesce(f"a.{key}", f"b.{key}").alias(key), what.alias("kind")).filter("kind is not null")
        rows.write.mode("overwrite").parquet(f"{folder}/found/step={number}")
    if not steps:
        return spark.createDataFrame([], f"{key} {kind}, kind string")
    return spark.read.schema(f"{key} {kind}, kind string").parquet(*[f"{folder}/found/step={n}" for n in range(len(steps)) if _exists(spark, f"{folder}/found/step={n}/_SUCCESS")])
