"""Board health in event time (T7, T8): events wait for the watermark and fold in order, and timers say when a check is due.

Kept per board: its health, the events above the watermark, and the time of its next check (for a board that may be gone
the time from which the next signal counts, for one that is gone the daily recheck). Whatever the triggers and the order
in which events come, the same states and the same checks come out, as long as no event comes later than the delay.

Memory: a task sorts what one board holds, which are its events within the delay and those of a trigger; bound the latter
by maxFilesPerTrigger or maxBytesPerTrigger of the source.

Defined results: events without a time have no place in the order and are left out; equal times go by event_id, null
last; events that come later than the delay are dropped by the watermark; a board with no event has no row; unknown
outcomes count as events and change nothing else.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import asdict
from itertools import batched

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from jobmarket.streaming.boards import STATE, Board

#: Timers and several state variables a key need this state store.
PROVIDER = ("spark.sql.streaming.stateStore.providerClass", "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider")
OUT = f"board string, at_us long, cause string, {STATE}, next_check_minutes int, should_delist boolean"
CHANGED, DUE = "events", "check due"
EVENTS_AT_ONCE = 1000


class BoardTimers(StatefulProcessor):
    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.board = handle.getValueState("board", STATE)
        self.held = handle.getListState("held", "at_us long, event_id long, outcome string")
        self.due = handle.getValueState("due", "at_us long")

    def _wake(self, at_us: int) -> None:
        """A timer goes off at the first watermark above its time; this one as soon as the watermark reaches at_us."""
        self.handle.registerTimer(-(-at_us // 1000) - 1)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N803
        first = None
        for part in batched(rows, EVENTS_AT_ONCE):
            self.held.appendList([(r["at_us"], r["event_id"], r["outcome"]) for r in part])
            least = min(r["at_us"] for r in part)
            first = least if first is None else min(first, least)
        if first is not None:
            self._wake(first)
        return iter(())

    def handleExpiredTimer(self, key: tuple, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N803
        now = timerValues.getCurrentWatermarkInMs() * 1000
        held = list(self.held.get()) if self.held.exists() else []
        ripe = sorted((h for h in held if h[0] <= now), key=lambda h: (h[0], h[1] is None, h[1] or 0))
        state = Board(*self.board.get()) if self.board.exists() else Board()
        due = self.due.get()[0] if self.due.exists() else None
        for at, _, outcome in ripe:
            if due is not None and at > due:
                yield self._row(key[0], due, DUE, state)
            state.apply(outcome, at / 1e6)
            due = at + state.row(key[0])["next_check_minutes"] * 60_000_000
        if ripe:
            rest = [tuple(h) for h in held if h[0] > now]
            self.board.update(tuple(asdict(state).values()))
            self.held.clear()
            if rest:
                self.held.put(rest)
                self._wake(min(h[0] for h in rest))
            yield self._row(key[0], ripe[-1][0], CHANGED, state)
        if due is None:
            return
        if due <= now:
            # All events up to now are folded, so none came before the check was due.
            yield self._row(key[0], due, DUE, state)
            self.due.clear()
        else:
            self.due.update((due,))
            self._wake(due)

    def _row(self, board: str, at: int, cause: str, state: Board) -> Row:
        return Row(**{"board": board, "at_us": at, "cause": cause} | {k: v for k, v in state.row(board).items() if k != "board"})

    def close(self) -> None:
        pass


def timed_health(events: DataFrame, delay: str = "1 hour") -> DataFrame:
    """(board, at, cause, state) of a stream of (board, event_id, ts, outcome): a row with cause CHANGED whenever events
    were folded, at the last one's time, and one with cause DUE for each check whose time passed without an event."""
    timed = events.select("board", "event_id", F.col("ts").cast("timestamp").alias("ts"), "outcome").filter("ts is not null").withWatermark("ts", delay)
    rows = timed.withColumn("at_us", F.unix_micros("ts"))
    out = rows.groupBy("board").transformWithState(BoardTimers(), OUT, "Append", "EventTime")
    return out.select("board", F.timestamp_micros("at_us").alias("at"), *[c for c in out.columns if c not in ("board", "at_us")])


def run_to_end(spark: SparkSession, health: DataFrame, folder: str, checkpoint: str) -> DataFrame:
    """Takes in what the source has by now, and gives what has been put out so far. A later run goes on from the checkpoint."""
    before = spark.conf.get(PROVIDER[0], None)
    spark.conf.set(*PROVIDER)
    try:
        q = health.writeStream.format("parquet").outputMode("append").option("path", folder).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER[0], before) if before else spark.conf.unset(PROVIDER[0])
    q.awaitTermination()
    return spark.read.schema(health.schema).parquet(folder)
