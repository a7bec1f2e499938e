"""Table mutations, sampling, sources and the stream twin."""

import json

import pytest
from pyspark.sql import functions as F

from jobmarket.operators import tables as M
from jobmarket.plans import analytics as A
from jobmarket.sources import payloads as S
from jobmarket.sources import tables as D
from jobmarket.streaming import boards as B


def rows(df, *cols):
    return sorted(tuple(r[c] for c in cols) for r in df.collect())


def test_upsert_policies_and_idempotence(spark):
    old = spark.createDataFrame([(1, "a", 10), (2, None, 20)], "id int, x string, seen int")
    new = spark.createDataFrame([(2, "b", 99), (3, None, 30)], "id int, x string, seen int")
    policy = {"x": "coalesce", "seen": "keep"}
    once = M.upsert(old, new, ["id"], policy)
    assert rows(once.filter("x is not null"), "id", "x", "seen") == [(1, "a", 10), (2, "b", 20)]
    assert once.filter("id = 3").first()["seen"] == 30
    assert once.exceptAll(M.upsert(once, new, ["id"], policy)).count() == 0


def test_update_changed_sets_stamp_only_on_change(spark):
    t = spark.createDataFrame([(1, "a", 0), (2, "b", 0), (3, None, 0)], "id int, x string, stamp int")
    inc = spark.createDataFrame([(1, "a"), (2, "c"), (3, None)], "id int, x string")
    assert rows(M.update_changed(t, inc, "id", ["x"], "stamp", F.lit(9)).filter("x is not null"), "id", "x", "stamp") == [(1, "a", 0), (2, "c", 9)]


def test_fill_from_canonical_rejects_conflicts(spark):
    a = spark.createDataFrame([(1, None), (2, "x")], "id int, v string")
    b = spark.createDataFrame([(1, "n"), (2, "x")], "id int, v string")
    assert rows(M.fill_from_canonical(a, b, "id", ["v"]), "id", "v") == [(1, "n"), (2, "x")]
    with pytest.raises(Exception, match="conflict"):
        M.fill_from_canonical(a, b.withColumn("v", F.lit("z")), "id", ["v"]).collect()


def test_gone_guard(spark):
    runs = spark.createDataFrame([("a", i, 100) for i in range(5)] + [("b", 0, 10)], "board string, run int, discovered int")
    now = spark.createDataFrame([("a", 60, 1, 100), ("b", 1, 6, 10)], "board string, discovered int, missing int, active int")
    assert rows(M.gone_guard(runs, now), "board", "guard") == [("a", "short"), ("b", "many_missing")]


def test_ancestors(spark):
    edges = spark.createDataFrame([("x", "c"), ("c", "r"), ("r", None)], "node string, parent string")
    assert rows(A.ancestors(edges, 3).filter("node = 'x'"), "ancestor") == [("c",), ("r",), ("x",)]


def test_keyset_pages_cover_all_rows(spark):
    df = spark.range(25).select("id", F.when(F.col("id") % 4 != 0, F.timestamp_seconds(F.col("id") % 5)).alias("ts"))
    seen, cursor = [], None
    while page := A.keyset(df, "ts", "id", cursor, 7).collect():
        seen += [r["id"] for r in page]
        cursor = (page[-1]["ts"], page[-1]["id"])
    assert sorted(seen) == list(range(25)) and len(set(seen)) == 25


def test_rarity_sample_is_seeded(spark):
    df = spark.range(500).select("id", F.when(F.col("id") < 20, "rare").otherwise("common").alias("k"))
    a, b = (sorted(r["id"] for r in A.rarity_sample(df, "id", ["k"], 50, s).collect()) for s in (1, 1))
    assert a == b and len(a) == 50 and sum(i < 20 for i in a) > 50 * 20 / 500


def test_providers(spark):
    cases = {
        "greenhouse": {"id": 1, "absolute_url": "u", "title": " T ", "location": {"name": "Paris"}, "offices": [{"name": "Paris"}, {"name": "Rome"}]},
        "ashby": {"id": "1", "jobUrl": "u", "title": "T", "location": "Paris", "secondaryLocations": [{"location": "Rome"}], "isRemote": True},
        "lever": {"id": "1", "hostedUrl": "u", "text": "T", "categories": {"allLocations": ["Paris", "Rome"], "commitment": "Full"}},
        "recruitee": {"id": 1, "careers_url": "u", "title": "T", "locations": [{"city": "Paris"}, {"city": "Rome"}], "hybrid": True},
    }
    for name, payload in cases.items():
        df = spark.createDataFrame([(json.dumps(payload),), ("{}",), ("not json",)], "payload string")
        got = S.PROVIDERS[name](df, "payload").collect()
        assert [(r["url"], r["title"], r["locations"]) for r in got] == [("u", "T", ["Paris", "Rome"])], name


def test_json_ld_page(spark):
    html = '<html><title>X</title><script type="application/ld+json">{"@graph":[{"@type":"JobPosting","title":"Cook","datePosted":"2024-01-01"}]}</script></html>'
    got = S.page_postings(spark.createDataFrame([(1, "u", html), (2, "v", "<title>Y</title>")], "page_id int, url string, html string"))
    assert rows(got, "page_id", "title") == [(1, "Cook"), (2, "Y")]


def test_sources_and_sinks(spark, tmp_path):
    assert D.posting_shards(spark, []).count() == 0
    df = spark.createDataFrame([(1, "2024-01-01"), (2, "2024-01-02")], "id int, date string")
    D.write_by_date(df, str(tmp_path / "days"))
    D.write_by_date(df.filter("id = 2").withColumn("id", F.lit(7)), str(tmp_path / "days"))
    assert rows(spark.read.json(str(tmp_path / "days")), "id") == [(1,), (7,)]
    with pytest.raises(ValueError, match="empty"):
        D.write_version(df.limit(0), str(tmp_path / "v"))
    assert spark.read.parquet(D.write_version(df, str(tmp_path / "v"))).count() == 2
    (tmp_path / "bad.jsonl").write_text('{"id": 1}\nnot json\n')
    with pytest.raises(Exception):
        D.json_lines(spark, str(tmp_path / "bad.jsonl"), "id int").collect()
    with pytest.raises(ValueError, match="manifest"):
        D.checked_scan(df, {"id": "long"}, rows=3)


def test_board_machine():
    b = B.Board()
    for i, o in enumerate(["success"] + ["empty"] * 6):
        b.apply(o, i * 60.0)
    assert b.status == "suspect" and b.row("x")["should_delist"]
    for i in range(5):
        b.apply("failure", 1000.0 + i)
    assert b.status == "quarantined" and b.row("x")["next_check_minutes"] == 160
    b.apply("success", 2000.0)
    assert (b.status, b.recoveries) == ("active", 1)
    g = B.Board()
    for h in (0, 1, 7):
        g.apply("gone", h * 3600.0 + 1)
    assert g.status == "gone" and g.gone_count == 2


def test_stream_equals_batch(spark, tmp_path):
    events = B.outcomes(spark.read.parquet("/root/testdata/sf0.001/events.parquet"))
    path = str(tmp_path / "events")
    events.repartition(1).write.parquet(path)
    stream = spark.readStream.schema(events.schema).parquet(path)
    q = B.health_stream(stream).writeStream.format("memory").queryName("health").outputMode("update").trigger(availableNow=True).option("checkpointLocation", str(tmp_path / "cp")).start()
    q.awaitTermination(120)
    cols = ["board", "status", "failures", "empties", "recoveries", "gone_count", "n_events"]
    assert rows(spark.table("health"), *cols) == rows(B.health_batch(events), *cols)


def test_ingest_splits_bad_rows(spark, tmp_path):
    path = str(tmp_path / "in")
    spark.createDataFrame([(1, 1.0), (2, None), (3, -1.0)], "id int, v double").write.parquet(path)
    good, bad = [], []
    q = B.ingest(spark.readStream.schema("id int, v double").parquet(path), lambda df, _: good.extend(r["id"] for r in df.collect()), F.col("v") >= 0, lambda df, _: bad.extend(r["id"] for r in df.collect()), str(tmp_path / "c"))
    q.awaitTermination(60)
    assert (good, sorted(bad)) == ([1], [2, 3])


def test_boards_and_digests_are_fed_in_batches(spark):
    # A key is never one group in memory: the plans sort and stream, and keys cross the borders of batches.
    import hashlib

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        events = spark.range(300).selectExpr("concat('b', if(id % 3 = 0, 0, id % 5)) as board", "(id * 7919) % 300 as event_id", "timestamp_seconds(((id * 7919) % 300) * 3600) as ts", "element_at(array('success', 'empty', 'failure', 'gone'), cast((id * 31) % 4 as int) + 1) as outcome")
        got = B.health_batch(events)
        assert "FlatMapGroups" not in got._jdf.queryExecution().toString()
        pdf = events.toPandas()
        expected = {b: B._fold(B.Board(), g).row(b) for b, g in pdf.groupby("board")}
        assert {r["board"]: r.asDict() for r in got.collect()} == expected
        h = spark.range(500).selectExpr("id % 3 as part", "if(id = 4, null, sha2(cast(id as string), 256)) as h")
        digests = M.ordered_digest(h)
        assert "collect_list" not in digests._jdf.queryExecution().toString()
        for r in digests.collect():
            hs = sorted(hashlib.sha256(str(i).encode()).hexdigest() for i in range(500) if i % 3 == r["part"] and i != 4)
            assert (r["digest"], r["n"]) == (hashlib.sha256("".join(hs).encode()).hexdigest(), sum(i % 3 == r["part"] for i in range(500)))
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_related_names_contain_one_another(spark):
    names = ["acme", "acme labs", "labs of acme", "acme tools", "Zeta  One", "zeta one", "zeta two"] + [f"common{i} corp" for i in range(201)] + [f"held{i} kept" for i in range(200)]
    df = spark.createDataFrame(list(enumerate(names)), "id int, name string").withColumn("tokens", F.split(F.lower("name"), r"\s+"))
    got = {(r["a"], r["b"]) for r in A.related_names(df, "id", "name", "tokens").collect()}
    assert got == {(0, 1), (0, 2), (0, 3), (1, 2), (4, 5)}
    # A token of 200 rows is evidence, one of 201 is not.
    short = spark.createDataFrame([(i, f"kept x{i:03d}") for i in range(199)] + [(999, "kept")], "id int, name string").withColumn("tokens", F.split("name", " "))
    assert A.related_names(short, "id", "name", "tokens").count() == 199


def test_key_conflicts_of_a_frequent_key_are_spread(spark):
    a = [(i, "k" if i % 3 else "x") for i in range(40)] + [(None, "k"), (50, None)]
    b = [(i, "k" if i % 2 else "y") for i in range(40)] + [(None, "k"), (50, "k")]
    got = M.key_conflicts(*[spark.createDataFrame(r, "id long, k string") for r in (a, b)], "k")
    due = [("same_key", x, y, i, j) for i, x in a for j, y in b if None not in (x, y, i, j) and x == y and i != j]
    due += [("same_id", x, y, i, j) for i, x in a for j, y in b if None not in (x, y, i, j) and i == j and x != y]
    assert sorted(tuple(r) for r in got.collect()) == sorted(due)
    tasks = got.filter("kind = 'same_key'").select(F.spark_partition_id().alias("p")).distinct().count()
    assert tasks > 4
