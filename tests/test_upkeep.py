"""Rules over tables, texts read again, ranges over JDBC, changes as a stream, and the sections of the report."""

import datetime as dt
import json

import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from jobmarket.catalog import upkeep
from jobmarket.operators import rollup as R
from jobmarket.plans import checks as CH
from jobmarket.plans import reprocess as RE
from jobmarket.plans import sections as SE
from jobmarket.sources import tables as S
from jobmarket.streaming import keyset as K
from jobmarket.streaming.cursors import Cursors

T0 = dt.datetime(2024, 1, 1)


def test_rules_name_every_value_and_its_rows(spark):
    rows = [("ab", "n", "https://x.example", "1990", '{"a": 1}', "k"), ("ab", " ", "https:///p", "", "[1]", "k"), (" ab", None, None, "19x", "{", "gone"), ("a", "n", "HTTP://x", None, None, None), ("a-", "n", "mailto:x", "7", "", "")]
    t = spark.createDataFrame(rows, "slug string, name string, url string, value string, v string, n string")
    rules = {"t": CH.Rules(unique=("slug",), required=("name",), slug=("slug",), url=("url",), digits=("value",), json_object=("v",), one_of={"name": ("n",)}, references={"n": ("known", "key")})}
    known = spark.createDataFrame([("k ",), ("k",)], "key string")
    got = {tuple(r)[1:] for r in CH.violations({"t": t, "known": known}, rules).collect()}
    assert got == {
        ("slug", "unique", "ab", 3), ("name", "required", " ", 1), ("name", "required", "", 1), ("slug", "slug", " ab", 1), ("slug", "slug", "a", 1), ("slug", "slug", "a-", 1), ("url", "url", "https:///p", 1), ("url", "url", "", 1), ("url", "url", "mailto:x", 1),
        ("value", "digits", "19x", 1), ("v", "json_object", "[1]", 1), ("v", "json_object", "{", 1), ("name", "one_of", " ", 1), ("name", "one_of", "", 1), ("n", "reference", "gone", 1),
    }
    assert CH.violations({"t": t.limit(0), "known": known}, rules).count() == 0 and CH.violations({"t": t}, {}).count() == 0


def test_reprocess_takes_the_best_text_and_spares_later_writes(spark):
    postings = spark.createDataFrame([(1, True, 5, T0, "x"), (2, True, 3, T0, "x"), (3, False, 1, T0, "x"), (4, True, None, T0, "x"), (5, True, 9, T0, None), (None, True, 1, T0, "x")], "id long, active boolean, value int, updated_at timestamp, text string")
    texts = spark.createDataFrame([
        (1, "de", None, "v 7"), (1, "en", T0, "v 2"), (2, "en", T0, "v 3"), (2, "en", T0, "v 3"), (3, "en", T0, "v 4"), (4, "de", T0, "v 6"), (4, "de", None, " "), (4, "de", T0, None), (5, "en", T0, "nothing"), (None, "en", T0, "v 8"),
    ], "id long, locale string, updated_at timestamp, text string")
    value = lambda c: F.regexp_extract(c, r"v (\d+)", 1).try_cast("int")
    found = RE.changes(postings, texts, value, F.col("new"))
    assert sorted(tuple(r) for r in found.collect()) == [(1, 5, 7), (4, None, 6)]
    assert [r["id"] for r in RE.changes(postings, texts, value, F.col("new"), limit=1).collect()] == [1]
    assert [r["id"] for r in RE.changes(postings, texts, value, F.col("new"), suspect=F.col("value").isNull(), wanted=F.col("locale") == "de").collect()] == [4]
    now = F.lit(dt.datetime(2025, 1, 1))
    moved = postings.withColumn("value", F.when(F.col("id") == 1, 6).otherwise(F.col("value")))
    out, counts = RE.reprocess(moved, found, now)
    assert {r["id"]: (r["value"], r["updated_at"].year) for r in out.collect()} == {1: (6, 2024), 2: (3, 2024), 3: (1, 2024), 4: (6, 2025), 5: (9, 2024), None: (1, 2024)}
    assert tuple(counts.first()) == (2, 1) and out.columns == postings.columns
    same, counts = RE.reprocess(postings, found, now, dry_run=True)
    assert same is postings and tuple(counts.first()) == (2, 0)
    assert RE.changes(postings.limit(0), texts, value, F.col("new")).count() == 0


def test_jdbc_ranges_keep_null_keys_and_every_row(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(100).select(F.when(F.col("id") % 10 != 0, F.col("id")).alias("id"), F.col("id").alias("n"))
    S.write_jdbc(df, url, "t", **driver)
    got = S.jdbc_by_ranges(spark, url, "t", "id", rows=20, most=4, **driver)
    assert got.rdd.getNumPartitions() == 4 and sorted(r["n"] for r in got.collect()) == list(range(100))
    S.write_jdbc(df.limit(0), url, "e", **driver)
    assert S.jdbc_by_ranges(spark, url, "e", "id", rows=20, **driver).count() == 0


def test_jdbc_ranges_with_a_file_uri_as_shared_folder(spark, tmp_path, monkeypatch):
    for scheme in ("file://", "file:", ""):
        monkeypatch.setattr(upkeep.S, "staging", lambda _, at=f"{scheme}{tmp_path}/a b{len(scheme)}": at)
        assert upkeep.jdbc_ranges(spark, "/root/testdata/sf0.001").count() == 150
        assert (tmp_path / f"a b{len(scheme)}" / "db").is_dir()
    monkeypatch.setattr(upkeep.S, "staging", lambda _: "viewfs://store/x")
    with pytest.raises(ValueError, match="spark.jobmarket.jdbc.url"):
        upkeep.jdbc_ranges(spark, "/root/testdata/sf0.001")


def _table(path, rows, groups=3):
    pq.write_table(pa.table({"id": [r[0] for r in rows], "ts": pa.array([r[1] for r in rows], pa.timestamp("us")), "x": [r[2] for r in rows]}), path, row_group_size=groups)


def test_stream_of_changes_goes_on_behind_the_fence(spark, tmp_path):
    day = lambda n: T0 + dt.timedelta(days=n)
    source, writers, state = tmp_path / "t", tmp_path / "w", str(tmp_path / "state")
    source.mkdir()

    def run(open_since, name, fail=False):
        spark.createDataFrame([(open_since,)], "started_at timestamp").write.mode("overwrite").parquet(str(writers))
        rows = K.changed_rows(spark, str(source), "id long, ts timestamp, x string", "ts", str(writers))
        K.export_stream(rows, "ts", "id", name, str(tmp_path / name), state, str(tmp_path / f"c-{name}"), fail).awaitTermination()

    _table(source / "a.parquet", [(i, day(i), "old") for i in range(9)] + [(99, None, "none")])
    run(day(4), "one")
    with pytest.raises(StreamingQueryException):
        run(day(4), "two", fail=True)
    cursors = Cursors(spark, state, "ts timestamp, id long")
    assert cursors.last("one")["id"] == 3 and cursors.least(["one", "two"]) is None
    # Rows 0 and 6 change, the table is rewritten in Spark's own form of times: 0 comes again, 6 only with its last change.
    (source / "a.parquet").unlink()
    rows = [(i, day(i), "old") for i in range(1, 9) if i != 6] + [(0, day(5), "new"), (6, day(7), "new"), (6 + 100, day(20), "late")]
    spark.createDataFrame(rows, "id long, ts timestamp, x string").repartition(2).write.mode("append").parquet(str(source))
    run(day(9), "one")
    run(day(9), "two")
    run(day(9), "two")
    read = lambda n: sorted((r["step"], r["id"], r["x"]) for r in spark.read.parquet(str(tmp_path / n)).collect())
    assert read("one") == [(1, i, "old") for i in range(4)] + sorted([(2, i, "old") for i in (4, 5, 7, 8)] + [(2, 0, "new"), (2, 6, "new")])
    # The batch that broke off is read again from the table as it is now, so row 0 stands in it no more.
    assert read("two") == [(1, i, "old") for i in range(1, 4)] + sorted([(2, i, "old") for i in (4, 5, 7, 8)] + [(2, 0, "new"), (2, 6, "new")])
    assert cursors.least(["one", "two"])[1] == 8
    instants = {r["id"]: r["ts"] for r in spark.read.parquet(str(tmp_path / "two")).collect()}
    assert instants[8].timestamp() == day(8).replace(tzinfo=dt.timezone.utc).timestamp() or instants[8] == day(8)


def test_stream_reads_only_row_groups_of_the_batch(tmp_path):
    _table(tmp_path / "a.parquet", [(i, T0 + dt.timedelta(days=i), "x") for i in range(9)])
    _table(tmp_path / "b.parquet", [(i, T0 + dt.timedelta(days=i), "x") for i in range(50, 55)])
    reader = K.KeysetReader(None, {"path": str(tmp_path), "ts": "ts"})
    at = lambda n: {"ts": K._micros(T0 + dt.timedelta(days=n))}
    spans = reader.partitions(at(3), at(4))
    assert [(s.file.rsplit("/", 1)[1], s.groups) for s in spans] == [("a.parquet", [1])]
    assert reader.partitions(at(4), at(4)) == [] and len(reader.partitions(reader.initialOffset(), at(60))) == 2
    assert reader.latestOffset()["ts"] > at(60)["ts"] and K.KeysetReader(None, {"path": str(tmp_path / "none"), "ts": "ts"}).partitions(at(0), at(1)) == []


def test_sections_rank_move_and_read_back(spark):
    zero = {k: 0 for k in R.MEASURES}
    row = lambda dim, bucket, **m: {"dim": dim, "bucket": bucket, **zero, "ss": 0.0, "ns": 0.0, "ps": 0.0, **m}
    rows = [row("_all", "all", j=100, sn=40, ss=4e6), row("country", "US", j=60, sn=20, ss=2e6, pn=20, ps=22.0), row("country", "DE", j=30), row("country", "AT", j=30, sn=9, ss=9e5, pn=9, ps=18.0), row("profile", "nurse", j=8)]
    kinds = ", ".join(f"{k} {'double' if k in ('ss', 'ns', 'ps') else 'long'}" for k in R.MEASURES)
    m = spark.createDataFrame([tuple(r.values()) for r in rows], f"dim string, bucket string, {kinds}")
    hist = spark.createDataFrame([("_all", "all", "s", 1151, 40), ("country", "US", "s", 1151, 20), ("country", "US", "y", 3, 5)], "dim string, bucket string, hist string, bin int, cnt long")
    cells = spark.createDataFrame([("profile|country", "nurse", "US", 5, 0, 1, 0, 0.0, 0), ("profile|country", "nurse", "AT", 2, 0, 0, 0, 0.0, 0), ("x|y", "a", "b", 9, 0, 0, 0, 0.0, 0)], "pair string, a string, b string, j long, n long, r long, sn long, ss double, yn long")
    before = spark.createDataFrame([("country", "US", 40), ("country", "DE", 50), ("country", "FR", 5), ("country", "IT", 4), ("region", "EU", 9)], "dim string, bucket string, j long")
    out = S.staged(SE.report_sections(m, hist, cells, before))
    got = {}
    for r in out.collect():
        got.setdefault((r["section"], r["part"], r["dim"]), []).append((r["rank"], r["bucket"], r["other"], r["value"]))
    lists = {k: sorted(v) for k, v in got.items()}
    assert [x[1] for x in lists["geography", "rows", "country"]] == ["US", "AT", "DE"]
    assert lists["geography", "cross", "profile|country"] == [(1, "nurse", "US", None)]
    assert lists["profiles", "risers", "country"] == [(1, "AT", None, 30.0), (2, "US", None, 20.0)] and lists["profiles", "fallers", "country"] == [(1, "DE", None, -20.0)]
    assert [x[1] for x in lists["profiles", "risers_pct", "country"]] == ["US"] and [x[1] for x in lists["profiles", "fallers_pct", "country"]] == ["DE"]
    assert [x[1] for x in lists["profiles", "appeared", "country"]] == ["AT"] and [x[1] for x in lists["profiles", "disappeared", "country"]] == ["FR"]
    assert lists["salary", "premium", "country"] == [(1, "US", None, 1.1)] and [x[1] for x in lists["salary", "by", "country"]] == ["US", "AT"]
    assert lists["salary", "histogram", "country"] == [(1, "US", "90000", 20.0)] and ("salary", "overall", "_all") in lists and not any(k[2] in ("x|y", "region") for k in lists)
    docs = {r["section"]: json.loads(r["document"]) for r in SE.documents(out).collect()}
    assert [x["bucket"] for x in docs["geography"]["rows/country"]] == ["US", "AT", "DE"] and sum(len(l) for s in docs.values() for l in s.values()) == out.count()
    assert SE.report_sections(m.limit(0), hist.limit(0), cells.limit(0)).count() == 0
