"""Day comparison of two job states (R3, R5, J5-J7, A35): new, removed, carried, newly covered and the next state."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Comparison:
    new: DataFrame
    removed: DataFrame
    carried: DataFrame
    state: DataFrame
    boards: DataFrame


def compare(previous: DataFrame, boards_seen: DataFrame, today: DataFrame, failed: DataFrame, ok: DataFrame, day: int) -> Comparison:
    """previous: (job_key, board, first_day); boards_seen, failed, ok: (board); today: (job_key, board).

    New: not in the previous state, on a board seen before. Removed: previous, not today, board not failed. Carried:
    previous, not today, board failed; they stay in the state. Jobs keep their first day."""
    fresh = today.join(previous.select("job_key"), "job_key", "left_anti")
    new = fresh.join(boards_seen, "board", "left_semi")
    gone = previous.join(today.select("job_key"), "job_key", "left_anti")
    removed = gone.join(failed, "board", "left_anti").withColumn("days_open", F.least(F.lit(365), F.greatest(F.lit(0), F.lit(day) - F.col("first_day"))))
    carried = gone.join(failed, "board", "left_semi")
    kept = today.join(previous.select("job_key", F.col("first_day").alias("_first")), "job_key", "left")
    state = kept.select("job_key", "board", F.coalesce("_first", F.lit(day)).alias("first_day")).unionByName(carried.select("job_key", "board", "first_day"))
    return Comparison(new, removed, carried, state, boards_seen.unionByName(ok).distinct())


def removed_per_bucket(before: DataFrame, now: DataFrame, keys: list[str]) -> DataFrame:
    """previous + new - today per bucket, where positive. Measures: j and n."""
    a, b = before.select(*keys, F.col("j").alias("_p")), now.select(*keys, F.col("j").alias("_j"), F.col("n").alias("_n"))
    out = a.join(b, keys, "full_outer").fillna(0, ["_p", "_j", "_n"])
    return out.select(*keys, (F.col("_p") + F.col("_n") - F.col("_j")).alias("removed")).filter("removed > 0")
