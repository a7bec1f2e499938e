"""Hierarchies of any depth and places over gazetteer tables."""

import pytest

from jobmarket.operators import hierarchy as H
from jobmarket.operators import places as P


def test_closure_of_any_depth_names_cycles(spark):
    chain = [(f"n{i}", f"n{i + 1}") for i in range(70)]
    more = [("a", "b"), ("b", "c"), ("c", "a"), ("d", "a"), ("lone", None), ("n0", "n1"), ("two", "n69"), ("two", "x"), (None, "y")]
    got = {(r["node"], r["ancestor"]): (r["distance"], r["looped"]) for r in H.closure(spark.createDataFrame(chain + more, "node string, parent string")).collect()}
    assert got["n0", "n70"] == (70, False) and sum(k[0] == "n0" for k in got) == 71 and got["lone", "lone"] == (0, False) and got["y", "y"][0] == 0
    assert {k[0] for k, v in got.items() if v[1]} == {"a", "b", "c"} and got["a", "c"] == (2, True) and got["a", "a"][0] == 0 and got["d", "b"] == (2, False)
    assert {k[1] for k in got if k[0] == "two"} == {"two", "n69", "n70", "x"}
    assert H.closure(spark.createDataFrame([], "node string, parent string")).count() == 0


def test_intervals_nest_like_the_tree(spark):
    rows = [(i, (i - 1) // 3 if i else None) for i in range(60)] + [(100, 101), (101, 100), (102, 101), (200, 999)]
    got = {r["place_id"]: (r["entry"], r["exit"]) for r in H.intervals(spark.createDataFrame(rows, "place_id long, parent_id long")).collect()}
    assert len(got) == 64 and all(got[x] == (None, None) for x in (100, 101, 102)) and got[200][0] == got[200][1]

    def under(a, b):
        while a:
            a = (a - 1) // 3
            if a == b:
                return True
        return False

    for a in range(60):
        for b in range(60):
            assert (got[b][0] < got[a][0] <= got[b][1]) == under(a, b)


PLACES = [
    (1, None, "macro", 450, []), (2, 1, "country", 8, ["de", "fr"]), (3, 2, "region", 500, ["fr"]), (4, 3, "city", 200, ["fr"]), (5, 2, "city", 400, ["de"]), (6, None, "country", 330_000, ["en"]), (7, 6, "region", 20_000, ["en"]),
    (8, 7, "city", 180, ["en"]), (9, 6, "region", 6_100, ["en"]), (10, 6, "region", 7_600, ["en"]), (11, 10, "city", 750, ["en"]), (12, None, "country", 26_000, ["en"]), (13, 12, "region", 2_800, ["en"]), (14, 13, "city", 2_100, ["en"]),
    (15, None, "country", 5_000, ["en"]), (16, 15, "city", 590, ["en"]), (17, None, "country", 67_000, ["en"]), (18, 17, "city", 8_900, ["en"]), (19, 1, "country", 83_000, ["de"]), (20, 19, "city", 3_600, ["de"]), (21, 7, "city", 40, ["en"]),
    (22, 6, "region", 19_000, ["en"]), (23, 22, "city", 390, ["en"]), (24, 9, "city", 9, ["en"]), (25, None, "country", 130_000, ["es"]), (26, 25, "city", 9_200, ["es"]), (27, None, "country", 1_400_000, ["en"]), (28, 6, "region", 6_800, ["en"]),
    (29, 10, "city", 5, ["en"]),
]
NAMES = [
    ("Europe", 1), ("Switzerland", 2), ("Geneva", 3), ("Genève", 3), ("Geneva", 4), ("Genève", 4), ("Zürich", 5), ("United States", 6), ("USA", 6), ("Ohio", 7), ("Dublin", 8), ("Missouri", 9), ("Washington", 10), ("Seattle", 11),
    ("Australia", 12), ("Western Australia", 13), ("Perth", 14), ("Ireland", 15), ("Dublin", 16), ("United Kingdom", 17), ("London", 18), ("Germany", 19), ("Berlin", 20), ("Geneva", 21), ("Florida", 22), ("Tampa", 23), ("Missouri City", 24),
    ("Mexico", 25), ("Mexico", 26), ("India", 27), ("Indiana", 28), ("Berlin", 29),
]
CODES = [("US", 6), ("WA", 10), ("WA", 13), ("DE", 19), ("IN", 27), ("IN", 28), ("UK", 17), ("OH", 7), ("FL", 22)]


@pytest.fixture(scope="module")
def tables(spark):
    places = spark.createDataFrame(PLACES, "place_id long, parent_id long, kind string, population long, languages array<string>")
    names = spark.createDataFrame([(*n, False) for n in NAMES] + [(*c, True) for c in CODES], "name string, place_id long, code boolean")
    return places, names


CASES = {
    "Seattle, WA": {11}, "Seattle, Washington, USA": {11}, "Dublin, London, Berlin": {16, 18, 20}, "Dublin, OH": {8}, "Dublin, Ireland": {16}, "Dublin": {16}, "Geneva": {4}, "Geneva, OH, USA": {21}, "Genève, Switzerland": {4},
    "Switzerland, Geneva, Zurich": {4, 5}, "Zurich HQ": {5}, "Tampa Florida United States": {23}, "Berlin Germany": {20}, "Missouri, USA": {9}, "Mexico": {25}, "Mexico City, Mexico": {26}, "The United States": {6}, "IN": {28}, "US": {6},
    "Amsterdam; Berlin, Germany; London": {20, 18}, "Unit 5, Main Street, Perth, Western Australia, 6000": {14}, "Nowhere, Germany": {19}, "nowhere": set(), "": set(), "Europe": {1}, "x " * 5000 + "Berlin": {20}, "Berlin, DE": {20}, "Berlin, WA": {29},
}


def test_hierarchical_places(spark, tables):
    texts = spark.createDataFrame([(t, None) for t in [*CASES, None, "Berlin, DE"]], "text string, language string")
    got = {t: set() for t in CASES}
    for r in P.resolved(texts, *tables).collect():
        got[r["text"]].add(r["place_id"])
    assert got == CASES


def test_types_language_and_empty_tables(spark, tables):
    texts = spark.createDataFrame([("Remote", "en"), ("Berlin (Hybrid); Remote - London", "en"), ("On-site", None), ("Dublin", "de"), ("Geneva", "en")], "text string, language string")
    got = {(r["text"], r["place_id"], r["work_type"]) for r in P.resolved(texts, *tables).collect()}
    # An English text means the Berlin where English is spoken. Of the Genevas, only Ohio's is such a place, but a city
    # inside the region of its name comes first.
    assert got == {("Remote", None, "remote"), ("Berlin (Hybrid); Remote - London", 29, "hybrid"), ("Berlin (Hybrid); Remote - London", 18, "remote"), ("On-site", None, "onsite"), ("Dublin", 16, None), ("Geneva", 4, None)}
    assert P.resolved(texts.limit(0), *tables).count() == 0
    assert {r["place_id"] for r in P.resolved(texts, tables[0].limit(0), tables[1].limit(0)).collect()} == {None}


COUNTRIES = [("US", "USA", "United States", "North America", ["us", "america"]), ("GB", "GBR", "United Kingdom", "Europe", ["uk"]), ("AU", "AUS", "Australia", "Oceania", []), ("IN", "IND", "India", "Asia", None), ("FR", "FRA", "France", "Europe", []), ("CA", "CAN", "Canada", "North America", []), ("DE", "DEU", "Germany", "Europe", [])]
DIVISIONS = [("US", "CA", "california", 0, False), ("US", "WA", "washington", 0, False), ("US", "OR", "oregon", 0, False), ("CA", "ON", "ontario", 1, False), ("AU", "WA", "western australia", 2, True), ("AU", "NSW", "new south wales", 2, True), ("IN", None, "karnataka", 3, False)]
CITIES = [
    ("San Francisco", "US", "CA", 870_000, []), ("Perth", "AU", "08", 2_100_000, []), ("Perth", "GB", "SCT", 47_000, []), ("Seattle", "US", "WA", 737_000, []), ("Bengaluru", "IN", "19", 8_400_000, ["Bangalore"]), ("London", "GB", "ENG", 8_900_000, []), ("London", "CA", "08", 420_000, []),
    ("Paris", "FR", "11", 2_100_000, []), ("Berlin", "DE", "16", 3_600_000, []), ("Portland", "US", "OR", 650_000, []), ("Portland", "US", "ME", 68_000, []), ("Springfield", "US", "IL", 90_000, []), ("Springfield", "US", "MA", 99_000, []), ("Toronto", "CA", "08", 2_700_000, []),
]
LOCATED = {
    "Perth, WA": ("AU", "Perth", "Oceania"), "Seattle, WA": ("US", "Seattle", "North America"), "Bangalore, Karnataka, India": ("IN", "Bengaluru", "Asia"), "Remote - US": ("US", None, "North America"), "Remote in USA": ("US", None, "North America"),
    "London, UK": ("GB", "London", "Europe"), "Bay Area": ("US", "San Francisco", "North America"), "Hybrid - Paris, France": ("FR", "Paris", "Europe"), "Multiple Locations": (None, None, None), "Remote (EMEA)": (None, None, "EMEA"), "Portland, OR": ("US", "Portland", "North America"),
    "Springfield": (None, None, None), "Springfield, US": ("US", "Springfield", "North America"), "London, ON": ("CA", "London", "North America"), "London, ON, Canada": ("CA", "London", "North America"), "CA": ("CA", None, "North America"), "NSW": ("AU", None, "Oceania"), "Sydney, NSW": ("AU", None, "Oceania"),
    "Berlin or Paris": ("DE", "Berlin", "Europe"), "": (None, None, None), "Greater London Area": ("GB", "London", "Europe"), "x, " * 3000 + "Paris": ("FR", "Paris", "Europe"),
}


def test_located_as_a_report_does(spark):
    countries = spark.createDataFrame(COUNTRIES, "iso2 string, iso3 string, name string, region string, aliases array<string>")
    divisions = spark.createDataFrame(DIVISIONS, "iso2 string, code string, name string, rank int, alone boolean")
    cities = spark.createDataFrame(CITIES, "name string, iso2 string, admin string, population long, aliases array<string>")
    metros = spark.createDataFrame([("bay area", "US", "San Francisco"), ("greater london", "GB", "London")], "name string, iso2 string, city string")
    hints = spark.createDataFrame([("emea", "EMEA"), ("europe", "Europe")], "name string, region string")
    names = P.gazetteer(countries, divisions, cities, metros, hints)
    texts = spark.createDataFrame([(t,) for t in [*LOCATED, None, "Perth, WA"]], "text string")
    got = {r["text"]: r for r in P.located(texts, names, countries).collect()}
    assert {t: (r["country"], r["city"], r["region"]) for t, r in got.items()} == LOCATED
    assert got["Remote (EMEA)"]["remote"] and got["Hybrid - Paris, France"]["hybrid"] and not got["London, UK"]["remote"]
    assert P.located(texts.limit(0), names, countries).count() == 0


def test_cities_that_differ_in_nothing_but_people_are_one_candidate(spark):
    places = spark.createDataFrame([(1, None, "country", 9, ["en"]), *[(10 + k, 1, "city", k % 5, ["en"]) for k in range(40)], (60, 1, "city", 1, ["de"]), (61, 60, "city", 0, ["de"])], "place_id long, parent_id long, kind string, population long, languages array<string>")
    names = spark.createDataFrame([("Land", 1, False), *[("Town", 10 + k, False) for k in range(40)], ("town", 60, None), ("Part", 61, False)], "name string, place_id long, code boolean")
    assert sorted(r["place_id"] for r in P.foremost(names, places).collect()) == [1, 14, 60, 61]
    texts = spark.createDataFrame([("Town, Land", "en"), ("Town", "de"), ("Part", None)], "text string, language string")
    assert {(r["text"], r["place_id"]) for r in P.resolved(texts, places, names).collect()} == {("Town, Land", 14), ("Town", 60), ("Part", 61)}


def test_closure_makes_each_pair_of_a_tree_once(spark, monkeypatch):
    """Every round joins the pairs at the furthest distance alone, and deals its rows by their number."""
    made = []
    keep = H.staged
    monkeypatch.setattr(H, "PAIRS_AT_ONCE", 16)
    monkeypatch.setattr(H, "staged", lambda df: made.append(keep(df)) or made[-1])
    pairs = [(i, i // 2) for i in range(2, 64)] + [(100, 101), (101, 102), (102, 100), (103, 102), (103, 100)]
    got = {(r["node"], r["ancestor"]): (r["distance"], r["looped"]) for r in H.closure(spark.createDataFrame(pairs, "node long, parent long")).collect()}
    due = {}
    parents = {n: [p for m, p in pairs if m == n] for n in {x for e in pairs for x in e}}
    for n in parents:
        near, d = {n}, 0
        while near:
            for a in near:
                due.setdefault((n, a), d)
            d, near = d + 1, {p for a in near for p in parents[a] if (n, p) not in due}
    assert got == {k: (d, k[0] in (100, 101, 102)) for k, d in due.items()}
    assert len(made) == 4
