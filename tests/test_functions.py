"""Attribute functions on literal cases."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from jobmarket.functions import automaton as AC
from jobmarket.functions import extract as E
from jobmarket.functions import text as T
from jobmarket.functions import values as V


def one(spark, value, f, kind="string"):
    return spark.createDataFrame([(value,)], f"x {kind}").select(f(F.col("x")).alias("y")).first()["y"]


@pytest.mark.parametrize("title, level", [("Staff Data Scientist", "staff"), ("Software Engineer", "mid"), ("Head of Product", "director"), ("CTO", "executive"), ("Lead Generation Manager", "unspecified"), ("Werkstudent (m/w/d) IT", "intern"), ("Junior Chef", "entry"), ("Zzz", "unspecified")])
def test_seniority(spark, title, level):
    assert one(spark, title, T.seniority) == level


def test_clean_title(spark):
    assert one(spark, "Senior Software Engineer II, Payments", T.clean_title) == "Software Engineer"


@pytest.mark.parametrize("title, tech", [("Software Engineer", True), ("Sales Engineer", False), ("Barista", False), ("ML Engineer", True), ("", False)])
def test_tech_role(spark, title, tech):
    assert one(spark, title, T.is_tech_role) is tech


def test_signals(spark):
    assert one(spark, "Bachelor's or Master's degree", T.education) == "bachelor"
    assert one(spark, "We are unable to sponsor visas.", T.visa) == "not_offered"
    assert one(spark, "visa sponsorship available", T.visa) == "offered"
    assert one(spark, "diversity, equity and inclusion", T.equity) is False
    assert one(spark, "TS/SCI required", T.clearance) is True


@pytest.mark.parametrize("place, country, city, region", [("San Francisco, CA", "US", "San Francisco", None), ("Toronto, ON", "CA", "Toronto", None), ("Perth, WA", "AU", "Perth", None), ("Remote - US", "US", None, None), ("Multiple Locations", None, None, None), ("Remote (EMEA)", None, None, "EMEA")])
def test_places(spark, place, country, city, region):
    resolve = E.place_resolver({"san francisco": ("US", 9), "toronto": ("CA", 9), "perth": ("AU", 9)}, {"us": "US"}, {"on": "CA", "ca": "US"})
    r = spark.createDataFrame([(place,)], "x string").select(resolve("x").alias("p")).first()["p"]
    assert (r["country"], r["city"], r["region"]) == (country, city, region)


@pytest.mark.parametrize("text, want", [("Pay: $150,000 - $200,000 per year.", (150000.0, 200000.0, "USD", "year")), ("€60.000 per year", (60000.0, 60000.0, "EUR", "year")), ("£25 per hour", (25.0, 25.0, "GBP", "hour")), ("raised $20,000,000 in funding", (20000000.0, 20000000.0, "USD", "year")), ("no pay", (None, None, None, None))])
def test_pay_in_text(spark, text, want):
    r = spark.createDataFrame([(text,)], "x string").select(E.pay_in_text("x").alias("p")).first()["p"]
    if "raised" in text:
        assert r["currency"] is None
    else:
        assert tuple(r) == want


def test_hourly_pay_is_annual(spark):
    df = spark.createDataFrame([(50.0, 40.0, "usd", "hour")], "lo double, hi double, c string, u string")
    r = df.select(V.annual(F.col("lo"), F.col("hi"), F.col("c"), F.col("u"), "structured").alias("s")).first()["s"]
    assert (r["min"], r["max"], r["currency"]) == (40 * 2080, 50 * 2080, "USD")


@pytest.mark.parametrize("text, years", [("5+ years of experience with SQL", 5.0), ("3-5 years", 3.0), ("For over 20 years of experience", None), ("18 months of experience", 1.5), ("40 years of experience", None), (None, None)])
def test_experience(spark, text, years):
    r = spark.createDataFrame([(text,)], "x string").select(E.years_of_experience("x").alias("y")).first()["y"]
    assert r == years


def test_occupation(spark):
    match = AC.best_alias([("server administrator", "it-support"), ("barista", "food-service"), ("engineer", "engineer"), ("head of data platform", "data-head")])
    titles = ["Server Administrator", "Senior Barista", "Zzz Qqq", "Platform Data: Head of Team"]
    rows = spark.createDataFrame([(t,) for t in titles], "x string").select("x", match("x").alias("y")).collect()
    assert {r["x"]: r["y"] for r in rows} == dict(zip(titles, ["it-support", "food-service", None, "data-head"], strict=True))


def test_posted_at(spark):
    now = F.lit("2024-03-06 00:00:00").cast("timestamp")
    want = dt.datetime(2024, 3, 5, 10)
    for raw in ("2024-03-05T10:00:00Z", "Tue, 05 Mar 2024 10:00:00 GMT", "2024-03-05 10:00:00", "2024-03-05T12:00:00+02:00"):
        assert one(spark, raw, lambda c: V.posted_at(c, now).cast("string")) == str(want)
    assert one(spark, "2025-03-05", lambda c: V.posted_at(c, now)) is None and one(spark, "soon", lambda c: V.posted_at(c, now)) is None


@pytest.mark.parametrize("url, want", [("HTTP://Example.COM:80/a/?utm_x=1&b=2&a=1#f", "https://example.com/a?a=1&b=2"), ("https://x.org", "https://x.org/"), ("https://x.org:8080/p", "https://x.org:8080/p")])
def test_url(spark, url, want):
    assert one(spark, url, V.normalised_url) == want


def test_country_bucket(spark):
    f = lambda c: V.country_bucket(c, F.lit(None).cast("string"))
    assert [one(spark, p, f) for p in ("Indianapolis, IN", "Pune", "Austin, TX", "Paris", "")] == ["US", "IN", "US", "other", None]


def test_technologies(spark):
    patterns = [("python", "Python", False), ("cpp", "C++", False), ("c", "C", True)]
    assert one(spark, "We use python, C++ and more", lambda c: T.technologies(c, patterns)) == ["python", "cpp"]
    assert one(spark, "Plain C here; pythonic", lambda c: T.technologies(c, patterns)) == ["c"]


def test_slug_and_mojibake(spark):
    assert one(spark, "McKinsey & Company", T.slugify) == "mckinsey-and-company"
    assert one(spark, "Â£10 cafÃ©", T.repair_mojibake) == "£10 café"


def test_blocks_table_function(spark):
    spark.udtf.register("blocks_of", E.BlocksOf)
    rows = spark.sql("select b.tag, b.text from values ('<h1>A</h1><script>x</script><p>b <b>c</b></p>') v(html), lateral blocks_of(html) b").collect()
    assert [(r["tag"], r["text"]) for r in rows] == [("h1", "A"), ("p", "b c")]


def test_language_takes_the_whole_text(spark):
    english, german = "the work of a team and the plan for it is with us ", "der Plan und die Arbeit mit dem Team ist nicht weit "
    df = spark.createDataFrame([(1, "Xyz " * 150 + german * 20), (2, english * 3 + german * 40)], "id int, text string")
    got = {r[0]: r[1] for r in df.select("id", T.language(F.lit(None).cast("string"), F.col("text"))).collect()}
    assert got == {1: "de", 2: "de"}


def test_language_shares_of_one_long_line(spark, tmp_path):
    from jobmarket.catalog.tables import language_shares

    english, german = "the work of a team and the plan for it is with us ", "der Plan und die Arbeit mit dem Team ist nicht weit "
    text = english * 100 + german * 100
    spark.createDataFrame([(1, text), (2, "x" * 1200)], "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    got = {(r["doc_id"], r["found"]): r["share"] for r in language_shares(spark, str(tmp_path)).collect()}
    assert set(got) == {(1, "en"), (1, "de"), (2, "unknown")} and abs(got[1, "en"] - 0.5) < 0.1
    pieces = spark.createDataFrame([(text,)], "t string").select(T.chunks(F.col("t"))).first()[0]
    assert max(map(len, pieces)) <= 500 and " ".join(pieces) == text.strip()
