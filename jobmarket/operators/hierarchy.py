"""Hierarchies of any depth: closure by pointer doubling, cycles by name, and nodes numbered by intervals."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmarket.sources.tables import staged


#: Pairs of a closure that one task holds, about.
PAIRS_AT_ONCE = 1 << 18


def dealt(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """df by keys, over as many tasks as its number of rows asks for, so that what a task sorts or sums stays the same."""
    least = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(max(least, -(-rows // PAIRS_AT_ONCE)), *keys)


def closure(edges: DataFrame) -> DataFrame:
    """(node, ancestor, distance, looped) of edges (node, parent): every node itself at distance 0, and all its ancestors
    at their least distance; nodes may have several parents.

    A round has all pairs up to distance d. A shortest way of more steps, up to 2 d, is one of exactly d and one of at
    most d behind it, so the pairs at exactly d join with all, which makes each longer pair of a tree once; a chain of a
    million takes 20 rounds. The last round is the one in which no pair is at exactly d. A round is a written table.
    looped: the node lies on a cycle, so that it is its own ancestor; such pairs stay, at the cycle's length from
    themselves replaced by 0. Edges with a null end only name the other end; repeated edges count once."""
    nodes = edges.select(F.explode(F.array("node", "parent")).alias("node")).filter("node is not null").distinct()
    pairs = staged(edges.filter("node is not null and parent is not null").select("node", F.col("parent").alias("ancestor")).distinct().withColumn("distance", F.lit(1).cast("long")))
    reach, have = 1, pairs.count()
    while furthest := pairs.filter(F.col("distance") == reach).count():
        # Nodes may have as many pairs each as the round has steps.
        rows = have + furthest * reach
        ends = dealt(pairs.filter(F.col("distance") == reach), rows, "ancestor")
        up = dealt(pairs.select(F.col("node").alias("ancestor"), F.col("ancestor").alias("_next"), F.col("distance").alias("_more")), rows, "ancestor")
        longer = ends.join(up, "ancestor").select("node", F.col("_next").alias("ancestor"), (F.col("distance") + F.col("_more")).alias("distance"))
        pairs = staged(dealt(pairs.unionByName(longer), rows, "node", "ancestor").groupBy("node", "ancestor").agg(F.min("distance").alias("distance")))
        reach, have = 2 * reach, pairs.count()
    looped = pairs.filter("node = ancestor").select("node", F.lit(True).alias("looped"))
    own = nodes.select("node", F.col("node").alias("ancestor"), F.lit(0).cast("long").alias("distance"))
    every = pairs.filter("node <> ancestor").unionByName(own)
    return dealt(every, have, "node").join(dealt(looped, have, "node"), "node", "left").fillna(False, ["looped"])


def numbered(df: DataFrame, order: list[Column], name: str = "number") -> DataFrame:
    """Adds a row number from 0 in a total order, by ranges that are sorted and counted on their own."""
    ranges = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id())
    # The high bits of the id are the partition, the low 33 bits the row in it.
    rows = staged(ranges.withColumns({"_part": F.shiftright("_id", 33), "_row": F.col("_id").bitwiseAND((1 << 33) - 1)}).drop("_id"))
    counts = rows.groupBy("_part").agg(F.count("*").alias("_n"))
    before = counts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    return rows.join(F.broadcast(before), "_part").withColumn(name, F.col("_row") + F.col("_before")).drop("_part", "_row", "_before")


def intervals(places: DataFrame, ident: str = "place_id", parent: str = "parent_id") -> DataFrame:
    """places with entry and exit: a place lies inside another one if its entry is above that one's entry and at most
    its exit. Every place has one parent or none; places on a cycle, or below one, have no interval (null), and a parent
    that is no place counts as none."""
    ids = places.select(F.col(ident).alias("parent"))
    edges = places.select(F.col(ident).alias("node"), F.col(parent).alias("parent"))
    known = edges.join(ids.distinct(), "parent", "left_semi").select("node", "parent").unionByName(edges.withColumn("parent", F.lit(None).cast(edges.schema["parent"].dataType)))
    all_ = staged(closure(known))
    lost = all_.filter("looped").select(F.col("node").alias("ancestor")).distinct()
    sound = all_.join(all_.join(lost, "ancestor").select("node").distinct(), "node", "left_anti")
    # Paths from the root downward, in whose order a place comes right before all inside it.
    paths = sound.groupBy("node").agg(F.transform(F.sort_array(F.collect_list(F.struct("distance", "ancestor")), asc=False), lambda x: x["ancestor"]).alias("path"))
    sizes = sound.groupBy("ancestor").agg(F.count("*").alias("size")).withColumnRenamed("ancestor", "node")
    found = numbered(paths, [F.col("path")], "entry").join(sizes, "node").select(F.col("node").alias(ident), "entry", (F.col("entry") + F.col("size") - 1).alias("exit"))
    return places.join(found, ident, "left")


def inside(inner: str, outer: str) -> Column:
    """Whether the place of one alias lies inside the place of another one: a range test."""
    return (F.col(f"{inner}.entry") > F.col(f"{outer}.entry")) & (F.col(f"{inner}.entry") <= F.col(f"{outer}.exit"))
