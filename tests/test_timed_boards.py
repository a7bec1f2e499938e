"""Board health by event time and timers, against a plain fold in order."""

import datetime as dt
import random
from collections import defaultdict

from jobmarket.catalog import QUERIES
from jobmarket.streaming import boards as B
from jobmarket.streaming import timed_boards as TB

T0 = dt.datetime(2024, 3, 1)
SCHEMA = "board string, event_id long, ts timestamp, outcome string"
KEPT = ["status", "failures", "empties", "recoveries", "gone_count", "n_events"]


def plain(events, mark):
    """(checks due, state) by folding all events up to the watermark in order."""
    by, due, state = defaultdict(list), [], {}
    for b, i, t, o in events:
        if t is not None and t <= mark:
            by[b].append((t, i, o))
    for b, own in by.items():
        board, at = B.Board(), None
        for t, _, o in sorted(own):
            if at is not None and t > at:
                due.append((b, at))
            board.apply(o, t.replace(tzinfo=dt.UTC).timestamp())
            at = t + dt.timedelta(minutes=board.row(b)["next_check_minutes"])
        if at <= mark:
            due.append((b, at))
        state[b] = tuple(getattr(board, k) for k in KEPT)
    return sorted(due), state


def seen(df):
    rows = df.collect()
    last = {}
    for r in sorted((r for r in rows if r["cause"] == TB.CHANGED), key=lambda r: r["n_events"]):
        last[r["board"]] = tuple(r[k] for k in KEPT)
    return sorted((r["board"], r["at"]) for r in rows if r["cause"] == TB.DUE), last


def test_late_events_fold_in_order_and_a_restart_goes_on(spark, tmp_path):
    rng = random.Random(5)
    events = [(f"b{i % 3}", i, T0 + dt.timedelta(minutes=30 * i, seconds=rng.randrange(60), microseconds=rng.randrange(1000)), rng.choice(["gone", "failure"] if i % 3 == 2 else ["success", "empty", "failure", "gone", "gone", "failure"])) for i in range(120)]
    events += [("b0", 900, events[5][2], "failure"), ("b0", 901, None, "gone")]
    # Events come up to five hours late, in files of their own; each run is a new query over the same checkpoint.
    events.sort(key=lambda e: (e[2] or T0) + dt.timedelta(hours=rng.random() * 5))
    path = str(tmp_path / "in")
    out = None
    for n in range(0, len(events), 45):
        spark.createDataFrame(events[n : n + 45], SCHEMA).coalesce(1).write.mode("append").parquet(path)
        stream = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).parquet(path)
        out = TB.run_to_end(spark, TB.timed_health(stream, "6 hours"), str(tmp_path / "out"), str(tmp_path / "cp"))
        top = max(e[2] for e in events[: n + 45] if e[2])
        mark = top.replace(microsecond=top.microsecond // 1000 * 1000) - dt.timedelta(hours=6)
        assert seen(out) == plain(events[: n + 45], mark)
    assert len(seen(out)[0]) > 10 and {r["status"] for r in out.collect()} >= {"active", "gone", "gone_pending"}


def test_query_against_a_plain_fold(spark):
    d = "/root/testdata/sf0.001"
    events = [tuple(r) for r in B.outcomes(spark.read.parquet(f"{d}/events.parquet")).select("board", "event_id", "ts", "outcome").collect()]
    top = max(e[2] for e in events)
    want = plain(events, top.replace(microsecond=top.microsecond // 1000 * 1000) - dt.timedelta(hours=1))[0]
    got = sorted((r["board"], r["at"]) for r in QUERIES["t7_timed_checks"](spark, d).collect())
    assert got == want and got
