"""Mixing sources to target weights by entropy balancing, with DataFrame functions only.

Among all rates r of documents that take a source's target number of words, entropy balancing picks those closest to
1 in relative entropy; by duality they are exponentially tilted, r = min(cap, exp(t * c)), with one multiplier t per
source and c the document's size relative to its source's mean. The dual is convex and falls apart by source.

1. Documents enter the sums only through their size, quantised to 1/64 octave: one distributed aggregation gives a few
   hundred rows (source, bin) per source.
2. Newton iterations, distributed over these rows: each step joins the rows with their source's multiplier, sums the
   words taken and their slope per source, and moves all multipliers at once, a Newton step where it stays inside the
   source's bracket, else half of the bracket. A source is done when its words are within CLOSE of its target; the
   iteration ends when all are. A step is one written table with a row per source.
3. Rates are rounded to copies: within a source, bins from the largest size downward receive whole extra copies with
   error feedback in words, and inside a bin the documents with the lowest hash receive them.

Sources are ranked by ranges, each in a task of its own; nothing passes through one task but sums.

Defined results: a null text has size 0 (targets and rates are unaffected; it is taken 0 times); a null source is a
source, last in order; rows that repeat are documents each, of which as many get extra copies as are due; null ids are
allowed; extra columns stay out of the way, whatever their names; an empty table gives no row.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmarket.llm.common import WORD_PATTERN, null_safe_join, result, scratch, table, written

#: Weights of the sources in order, repeating; the mix's size against the corpus; most copies of a document.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
CAP = 2
#: Bins an octave of size, hash buckets that ranks inside a bin are counted by, bound of the Newton iterations, and the
#: share of a target that its words may be off when they end.
BINS = 64
BUCKETS = 256
STEPS = 80
CLOSE = 1e-9


def sized(docs: DataFrame, *keep: Column) -> DataFrame:
    """(doc_id, source, size, tie) and the kept columns; tie: tells texts of one id and size apart."""
    size = F.coalesce(F.regexp_count("text", F.lit(WORD_PATTERN)), F.lit(0)).cast("long").alias("size")
    return docs.select("doc_id", "source", *keep, size, F.xxhash64("text").alias("tie"))


def ranked(sources: DataFrame) -> DataFrame:
    """Adds place: the rank of each source by code point from 0, null last. Ranges of sources are sorted and numbered
    on their own; the driver sees one count per range."""
    by_range = written(sources.repartitionByRange(F.col("source").asc_nulls_last()).withColumn("part", F.spark_partition_id()), "ranges")
    counts = sorted((r["part"], r["n"]) for r in by_range.groupBy("part").agg(F.count("*").alias("n")).collect())
    before, start = 0, F.lit(0)
    pairs = []
    for part, n in counts:
        pairs += [F.lit(part), F.lit(before).cast("long")]
        before += n
    if pairs:
        start = F.element_at(F.create_map(*pairs), F.col("part"))
    own = F.row_number().over(Window.partitionBy("part").orderBy(F.col("source").asc_nulls_last()))
    return by_range.withColumn("place", start + own - 1).drop("part")


def targets(sources: DataFrame, share: float = SHARE, cap: int = CAP, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Adds target to (source, source_size): shares by weight, none above cap times its size, the excess reshared.

    Sources below their limit all have one ratio t of target to weight. From the plain shares on, sources that t puts
    above their limits are fixed there and t becomes what is left over the weights left, until no more are above; each
    round is a sum over all sources."""
    s = ranked(sources)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("place") % len(weights) + 1).cast("int"))
    s = written(s.select("source", "source_size", weight.alias("weight"), (F.col("source_size") * float(cap)).alias("most")), "weights")
    wanted = float(s.agg(F.sum("source_size").alias("n")).first()["n"] or 0) * share
    t, fixed = 0.0, -1
    while True:
        over = F.col("weight") * t > F.col("most")
        r = s.agg(F.count_if(over).alias("n"), F.coalesce(F.sum(F.when(over, F.col("most"))), F.lit(0.0)).alias("most"), F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0.0)).alias("weight")).first()
        if r["n"] == fixed or not r["weight"]:
            break
        fixed, t = r["n"], (wanted - r["most"]) / r["weight"]
    return s.select("source", "source_size", F.least(F.col("most"), F.col("weight") * t).alias("target"))


def _bin(size: Column) -> Column:
    return F.when(size > 0, F.floor(F.log2(size.cast("double")) * BINS).cast("int")).otherwise(-1)


def _tilt(cap: int) -> Column:
    return F.least(F.col("t") * F.col("x"), F.lit(math.log(cap)))


def multipliers(bins: DataFrame, goal: DataFrame, cap: int = CAP, steps: int = STEPS) -> DataFrame:
    """(source, t) that solve the dual for the words of each source; bins: (source, bin, words, x), x the bin's size
    relative to its source's mean; sources whose target is all they can give need none."""
    free = goal.filter(F.col("target") < F.col("source_size") * float(cap)).select("source", "target")
    least = bins.groupBy("source").agg(F.min("x").alias("least"))
    # The largest multiplier puts even the smallest bin at the cap; the smallest makes any rate negligible.
    state = null_safe_join(free, least, ["source"]).select("source", "target", (F.lit(-60.0) / F.col("least")).alias("low"), (F.lit(math.log(cap)) / F.col("least")).alias("high"), F.lit(0.0).alias("t"), F.lit(False).alias("done"))
    state = written(state, "multipliers")
    below = _tilt(cap) < math.log(cap)
    for _ in range(steps):
        taken = F.col("words") * F.exp(_tilt(cap))
        sums = null_safe_join(bins, state.filter("not done").select("source", "t"), ["source"]).groupBy("source").agg(F.sum(taken).alias("f"), F.sum(F.when(below, taken * F.col("x")).otherwise(0.0)).alias("slope"))
        off = F.col("f") - F.col("target")
        s = null_safe_join(state, sums, ["source"], "left").withColumns({"low": F.when(off > 0, F.col("low")).otherwise(F.greatest("low", F.when(off <= 0, F.col("t")))), "high": F.when(off > 0, F.col("t")).otherwise(F.col("high"))})
        newton = F.col("t") - F.try_divide(off, F.col("slope"))
        inside = (newton > F.col("low")) & (newton < F.col("high"))
        done = F.col("done") | (F.abs(off) <= CLOSE * F.col("target")) | (F.col("high") - F.col("low") <= 1e-15 * (1 + F.abs("t")))
        s = s.withColumn("done", done).withColumn("t", F.when(F.col("done"), F.col("t")).otherwise(F.coalesce(F.when(inside, newton), (F.col("low") + F.col("high")) / 2)))
        state = written(s.select("source", "target", "low", "high", "t", "done"), "multipliers")
        if state.filter("not done").isEmpty():
            break
    return state.select("source", "t")


def rates(bins: DataFrame, goal: DataFrame, cap: int = CAP) -> DataFrame:
    """Per source and bin its rate, whole copies and extra copies (source, bin, rate, base, extra); bins: (source, bin,
    n, words)."""
    scale = bins.filter("bin >= 0").groupBy("source").agg((F.sum("words") / F.sum("n")).alias("scale"))
    b = null_safe_join(bins.filter("bin >= 0"), scale, ["source"]).withColumn("mean", F.col("words") / F.col("n")).withColumn("x", F.col("mean") / F.col("scale"))
    b = written(b, "sizes")
    b = null_safe_join(b, multipliers(b, goal, cap), ["source"], "left")
    rated = b.withColumn("rate", F.when(F.col("t").isNull(), F.lit(float(cap))).otherwise(F.exp(_tilt(cap))))
    # A source has at most BINS bins an octave of size, whatever its number of documents.
    per = rated.groupBy("source").agg(F.sort_array(F.collect_list(F.struct("bin", "n", "words", "mean", "rate")), asc=False).alias("bins"))

    def round_bin(s: Column, b: Column) -> Column:
        due = s["due"] + (b["rate"] - F.floor(b["rate"])) * b["words"]
        extra = F.least(F.greatest(F.round((due - s["given"]) / b["mean"]), F.lit(0.0)), F.when(b["rate"] < cap, b["n"].cast("double")).otherwise(0.0)).cast("long")
        one = F.struct(b["bin"].alias("bin"), b["rate"].alias("rate"), F.floor(b["rate"]).cast("long").alias("base"), extra.alias("extra"))
        return F.struct(due.alias("due"), (s["given"] + extra * b["mean"]).alias("given"), F.concat(s["out"], F.array(one)).alias("out"))

    none = F.expr("cast(array() as array<struct<bin:int,rate:double,base:bigint,extra:bigint>>)")
    rounded = F.aggregate("bins", F.struct(F.lit(0.0).alias("due"), F.lit(0.0).alias("given"), none.alias("out")), round_bin)["out"]
    return per.select("source", F.inline(rounded))


def plan(counts: DataFrame, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """What each cell takes: (source, bin, bucket, before, rate, base, extra, source_size, target); counts: (source, bin,
    bucket, n, words). before: documents of the bin in buckets before this one."""
    goal = written(targets(counts.groupBy("source").agg(F.sum("words").alias("source_size")), share, cap), "targets")
    rated = rates(counts.groupBy("source", "bin").agg(F.sum("n").alias("n"), F.sum("words").alias("words")), goal, cap)
    upto = Window.partitionBy("source", "bin").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cells = counts.select("source", "bin", "bucket", F.coalesce(F.sum("n").over(upto), F.lit(0)).alias("before"))
    return null_safe_join(null_safe_join(cells, rated, ["source", "bin"], "left"), goal, ["source"]).fillna({"rate": 1.0, "base": 0, "extra": 0})


def planned(docs: DataFrame, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """Documents (row, doc_id, source, size) with source_size, target, rate, copies and taken; row: what to carry along."""
    spark = docs.sparkSession
    at = {"bin": _bin(F.col("size")), "h": F.xxhash64("doc_id", "size", "tie")}
    d = docs.withColumns(at).withColumn("bucket", F.pmod("h", F.lit(BUCKETS)).cast("int"))
    with scratch(spark):
        counts = written(d.groupBy("source", "bin", "bucket").agg(F.count("*").alias("n"), F.sum("size").alias("words")), "bins")
        cells = result(plan(counts, share, cap), "cells")
    placed = d.withColumn("position", F.row_number().over(Window.partitionBy("source", "bin", "bucket").orderBy("h", "doc_id", "tie")))
    out = null_safe_join(placed, cells, ["source", "bin", "bucket"])
    out = out.withColumn("copies", F.col("base") + (F.col("before") + F.col("position") <= F.col("extra")).cast("long"))
    return out.select("row", "doc_id", "source", "size", "source_size", "target", "rate", "copies", (F.col("size") * F.col("copies")).alias("taken"))


def mix(docs: DataFrame, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """(doc_id, source, size, source_size, target, rate, copies, taken) for every document."""
    with scratch(docs.sparkSession):
        d = written(sized(docs).select(F.lit(0).alias("row"), "doc_id", "source", "size", "tie"), "sized")
        return result(planned(d, share, cap).drop("row"), "mix")


def mixture(docs: DataFrame, share: float = SHARE, cap: int = CAP) -> DataFrame:
    """The mix itself: rows of docs, each as often as it is taken, with copy_no, mix_size and mix_target (as last
    columns; columns of docs that have these names keep their values under them and the new ones get a trailing _)."""
    d = sized(docs, F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))
    out = planned(d.select("row", "doc_id", "source", "size", "tie"), share, cap).filter("copies > 0")
    out = out.withColumn("copy_no", F.explode(F.sequence(F.lit(1).cast("long"), "copies")))
    names = {"copy_no": "copy_no", "size": "mix_size", "target": "mix_target"}
    while set(names.values()) & set(docs.columns):
        names = {k: f"{v}_" if v in docs.columns else v for k, v in names.items()}
    return out.select("row.*", *[F.col(k).alias(v) for k, v in names.items()])


def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's part in the mix."""
    return mix(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")
