"""Case tables and file queries against their DuckDB twins on the smallest tables, and sources that need no table."""

import duckdb
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobmarket.catalog import cases, files
from jobmarket.functions import extract as E
from jobmarket.functions import text as T
from jobmarket.functions import values as V
from jobmarket.operators import rollup as R
from jobmarket.plans import jobs as J
from jobmarket.sources import tables as S

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages labels".split()


@pytest.fixture(scope="module")
def twin():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.mark.parametrize("module, name", [(m, n) for m in (cases, files) for n in m.QUERIES])
def test_query_equals_its_twin(spark, twin, module, name):
    got = module.QUERIES[name](spark, SF)
    want = twin.sql(module.SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    plain = lambda v: round(float(v), 9) if type(v).__name__ in ("float", "Decimal") else v
    at = [want.columns.index(c) for c in columns]
    assert sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr) == sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_bad_json_line_fails_the_read(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"id": 1}\n{"id": \n')
    with pytest.raises(Exception, match="(?i)malformed"):
        S.json_lines(spark, str(tmp_path / "a.jsonl"), "id long").collect()


def test_empty_report_is_refused(spark, tmp_path):
    with pytest.raises(ValueError):
        S.write_version(spark.createDataFrame([], "a long"), str(tmp_path))


def test_jdbc_round_trip(spark, tmp_path):
    url, driver = f"jdbc:derby:{tmp_path}/db;create=true", {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    df = spark.range(5).select("id", F.concat(F.lit("n"), "id").alias("name"))
    S.write_jdbc(df, url, "postings", **driver)
    S.write_jdbc(df.filter("id = 1"), url, "postings", **driver)
    assert sorted(tuple(r) for r in S.jdbc(spark, url, "postings", **driver).collect()) == sorted([(i, f"n{i}") for i in range(5)] + [(1, "n1")])


def test_largest_keeps_bounds_and_ties(spark):
    rows = spark.createDataFrame([("a", f"i{k}", k // 2) for k in range(10)] + [("b", f"i{k}", 1) for k in range(10)], "g string, i string, n int")
    kept = R.largest(rows, "g", "i", "n", {"a": 3, "c": 7})
    assert sorted(r["i"] for r in kept.filter("g = 'a'").collect()) == ["i6", "i8", "i9"] and kept.filter("g = 'b'").count() == 10
    assert "WindowGroupLimit" in kept._jdf.queryExecution().toString()


def test_technology_literals_stand_as_words(spark):
    table = [("net", (".NET",), False), ("c", ("C",), True), ("cpp", ("C++", "cpp"), False)]
    found = lambda t: spark.createDataFrame([(t,)], "x string").select(T.named_technologies(F.col("x"), table).alias("y")).first()["y"]
    assert found("ASP .net and C++") == ["net", "c", "cpp"] and found("internet cppx c") == [] and found(None) == []
    assert len(T.technology_table()) > 150


def test_derived_frame_resolves_every_place(spark):
    """The only places with a country, and the only mark of remote work, stand behind fifty others."""
    schema = "company_slug string, board_slug string, source string, url string, source_identity string, title string, description string, locations array<string>, workplace string, employment_type string, base_pay struct<min: double, max: double, currency: string, unit: string>, language string, date_posted string"
    many = [f"nowhere {i}" for i in range(60)]
    lists = {"a": [*many, "Berlin", "Toronto, ON", "Remote - US"], "b": ["Berlin", *many], "c": [], "d": None}
    raw = spark.createDataFrame([("c", "b", "s", f"https://x/{k}", k, "Barista", None, v, "", None, None, None, None) for k, v in lists.items()], schema)
    resolve = E.places_resolver({"toronto": ("CA", 9), "berlin": ("DE", 9)}, {"us": "US"}, {"on": "CA"})
    got = J.derived_frame(raw, F.lit("2024-06-01").cast("timestamp"), resolve, T.profile_table(), T.technology_table())
    keys = raw.select(V.job_key(F.col("company_slug"), F.col("source_identity")).alias("job_key"), "source_identity")
    rows = {r["source_identity"]: tuple(r)[1:] for r in got.join(keys, "job_key").select("source_identity", "n_locations", "n_countries", "country", "city", "work_mode").collect()}
    assert rows == {"a": (63, 3, "DE", "Berlin", "remote"), "b": (61, 1, "DE", "Berlin", "unspecified"), "c": (0, 0, None, None, "unspecified"), "d": (0, 0, None, None, "unspecified")}


def test_places_of_long_lists_with_gaps(spark, monkeypatch):
    monkeypatch.setattr(E, "TEXTS_AT_ONCE", 3)  # for the call below; tasks use the module's own
    lists = [["Berlin", None, "x", "Berlin, Toronto"], None, [], [f"t{i}" for i in range(7)] + ["Toronto, ON"], [None]]
    tables = ({"toronto": ("CA", 9), "berlin": ("DE", 9)}, {"us": "US"}, {"on": "CA"})
    want = [[dict(zip(E._PLACE.names, E._place(t, *tables), strict=True)) for t in x or []] for x in lists]
    assert E.places_resolver(*tables).func(pa.array(lists, pa.list_(pa.string()))).to_pylist() == want
    assert E.places_resolver(*tables).func(pa.array(lists, pa.list_(pa.string())).slice(2, 2)).to_pylist() == want[2:4]
    assert E.places_resolver(*tables).func(pa.array([], pa.list_(pa.string()))).to_pylist() == []
    got = spark.createDataFrame(list(enumerate(lists)), "id int, x array<string>").select("id", E.places_resolver(*tables)("x").alias("p")).orderBy("id").collect()
    assert [[y.asDict() for y in r["p"]] for r in got] == want
