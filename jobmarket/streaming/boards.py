"""Stateful operators over board events and their batch twins (T1-T11): health machine, gone confirmation, ingest.

A board's events fold in (ts, event_id) order. The stream keeps the same state per board and gives, once all events are
in, what the batch fold gives.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import asdict, dataclass

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Empty checks until suspect and delisted, failures until quarantine, backoff start and ceiling in minutes.
SUSPECT, DELIST, QUARANTINE, BACKOFF, CEILING = 3, 6, 5, 5, 1440
#: Gone confirmations: how many (more after a recent success), hours between them, days that count as recent.
NEEDED, NEEDED_AFTER_SUCCESS, SPACING_H, RECENT_D = 2, 3, 6, 7
#: Hours between checks of a board that is gone.
RECOVERY_H = 24

STATE = "status string, failures int, empties int, recoveries int, last_success double, gone_count int, gone_last double, ever_full boolean, n_events long"
OUT = f"board string, {STATE}, next_check_minutes int, should_delist boolean"


@dataclass
class Board:
    status: str = "active"
    failures: int = 0
    empties: int = 0
    recoveries: int = 0
    last_success: float = 0.0
    gone_count: int = 0
    gone_last: float = 0.0
    ever_full: bool = False
    n_events: int = 0

    def apply(self, outcome: str, at: float) -> None:
        """One event; at: seconds."""
        self.n_events += 1
        if outcome in ("success", "empty"):
            if self.status in ("quarantined", "gone_pending", "gone"):
                self.recoveries += 1
                self.status = "active"
            self.failures, self.gone_count, self.last_success = 0, 0, at
            if outcome == "success":
                self.status, self.empties, self.ever_full = "active", 0, True
            else:
                self.empties += 1
                if self.ever_full and self.empties >= SUSPECT:
                    self.status = "suspect"
        elif outcome == "failure":
            self.failures += 1
            if self.failures >= QUARANTINE and self.status not in ("gone", "gone_pending"):
                self.status = "quarantined"
        elif outcome == "gone":
            recent = self.last_success and at - self.last_success <= RECENT_D * 86_400
            if self.gone_count == 0 or at - self.gone_last >= SPACING_H * 3600:
                self.gone_count += 1
                self.gone_last = at
            if self.status != "gone":
                self.status = "gone" if self.gone_count >= (NEEDED_AFTER_SUCCESS if recent else NEEDED) else "gone_pending"

    def row(self, board: str) -> dict:
        # A board that is gone is looked at once a day; one that may be gone again when the next signal can count.
        wait = RECOVERY_H * 60 if self.status == "gone" else SPACING_H * 60 if self.status == "gone_pending" else min(CEILING, BACKOFF * 2 ** min(self.failures, 9))
        return {"board": board} | asdict(self) | {"next_check_minutes": wait, "should_delist": self.empties >= DELIST}


def outcomes(events: DataFrame) -> DataFrame:
    """The event table as board outcomes: error is a failure, view an empty check, signup a gone signal, others success."""
    kind = F.when(F.col("event_type") == "error", "failure").when(F.col("event_type") == "view", "empty").when(F.col("event_type") == "signup", "gone").otherwise("success")
    return events.select(F.concat(F.lit("b"), F.col("user_id").cast("string")).alias("board"), "event_id", "ts", kind.alias("outcome"))


def _fold(b: Board, rows: pd.DataFrame) -> Board:
    rows = rows.sort_values(["ts", "event_id"])
    for outcome, at in zip(rows["outcome"], rows["ts"].astype("int64") / (1e9 if str(rows["ts"].dtype).startswith("datetime64[ns") else 1e6), strict=True):
        b.apply(outcome, float(at))
    return b


#: Nanoseconds that stand for a null ts; seconds are taken from nanoseconds, as in the stream.
NO_TIME = -(1 << 63)
OUT_ARROW = pa.schema([("board", pa.string()), ("status", pa.string()), *[(k, pa.int32()) for k in ("failures", "empties", "recoveries")], ("last_success", pa.float64()), ("gone_count", pa.int32()), ("gone_last", pa.float64()), ("ever_full", pa.bool_()), ("n_events", pa.int64()), ("next_check_minutes", pa.int32()), ("should_delist", pa.bool_())])


def health_batch(events: DataFrame) -> DataFrame:
    """Final state of every board. Boards are sorted by Spark, which spills, and folded event by event: a task holds one
    state and one batch, however many events a board has."""

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        board, state = None, None
        for batch in batches:
            done = []
            at = batch.column("ts").cast(pa.timestamp("us")).cast(pa.int64()).to_pylist()
            for name, outcome, t in zip(batch.column("board").to_pylist(), batch.column("outcome").to_pylist(), at, strict=True):
                if state is None or name != board:
                    if state is not None:
                        done.append(state.row(board))
                    board, state = name, Board()
                state.apply(outcome, (NO_TIME if t is None else t * 1000) / 1e9)
            if done:
                yield pa.RecordBatch.from_pylist(done, OUT_ARROW)
        if state is not None:
            yield pa.RecordBatch.from_pylist([state.row(board)], OUT_ARROW)

    wall = events.select("board", F.col("ts").cast("timestamp_ntz").alias("ts"), "event_id", "outcome")
    return wall.repartition("board").sortWithinPartitions("board", F.asc_nulls_last("ts"), F.asc_nulls_last("event_id")).select("board", "ts", "outcome").mapInArrow(fold, OUT)


def health_stream(events: DataFrame) -> DataFrame:
    """The same state per board as a stream; each trigger emits the state of the boards that had events. Events of a
    trigger are folded by time; one that comes a trigger late is folded when it comes, so the two agree where events come
    in order."""

    def fold(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        b = Board(*state.get) if state.exists else Board()
        rows = pd.concat(list(batches))
        b = _fold(b, rows)
        state.update(tuple(asdict(b).values()))
        yield pd.DataFrame([b.row(key[0])])

    return events.groupBy("board").applyInPandasWithState(fold, OUT, STATE, "update", GroupStateTimeout.NoTimeout)


def ingest(stream: DataFrame, upsert: Callable[[DataFrame, int], None], valid, quarantine: Callable[[DataFrame, int], None], checkpoint: str):
    """Micro-batch ingest: valid rows are upserted, others go to the quarantine sink; the checkpoint holds the cursor."""

    def sink(batch: DataFrame, epoch: int) -> None:
        ok = F.coalesce(valid, F.lit(False))
        upsert(batch.filter(ok), epoch)
        quarantine(batch.filter(~ok), epoch)

    return stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def min_cursor(a: DataFrame, b: DataFrame) -> DataFrame:
    """The smaller of two (ts, id) cursors."""
    pair = a.selectExpr("struct(ts, id) as c").unionByName(b.selectExpr("struct(ts, id) as c"))
    return pair.agg(F.min("c").alias("c")).select("c.ts", "c.id")


def latest_points(rows: DataFrame, day: str, order: str) -> DataFrame:
    """One point per day, the latest wins; on streams with a watermark use dropDuplicatesWithinWatermark before."""
    return rows.groupBy(day).agg(F.max_by(F.struct("*"), order).alias("p")).select("p.*")
