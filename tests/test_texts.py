"""Automata, years of experience in several languages, cover density and trigram languages."""

import random

import pytest
from pyspark.sql import functions as F

from jobmarket.functions import automaton as AC
from jobmarket.functions import extract as E
from jobmarket.functions import languages as LG
from jobmarket.functions import text as T
from jobmarket.functions import values as V
from jobmarket.plans import jobs as J
from jobmarket.plans import ranking as RK

TEXTS = ["We use Python, C++ and C#, .NET; Go or R.", "pythonic going Rust", "node.js/Node.JS (aws) and GO", "", None, "x" * 100_000 + " kubernetes", "SQL,NoSQL; go-to R&D r", "C++C++ C", "Java JavaScript java", "TensorFlow\nPyTorch\tscikit-learn"]


def test_automaton_names_what_the_patterns_name(spark):
    table = T.technology_table()
    df = spark.createDataFrame([(t,) for t in TEXTS], "x string")
    for r in df.select("x", AC.whole_words(table)("x").alias("a"), T.named_technologies(F.col("x"), table).alias("b")).collect():
        assert r["a"] == (r["b"] or []), r["x"]
    terms = spark.createDataFrame([("py", "Python", False), ("go", "Go", True), ("none", "", False)], "slug string, literal string, exact boolean")
    got = {(r["text"][:6], r["slug"]) for r in AC.named_in(df, terms, "x").collect()}
    assert got == {("We use", "py"), ("We use", "go")} and AC.named_in(df, terms.limit(0), "x").count() == 0


def test_too_many_literals_are_refused():
    with pytest.raises(ValueError, match="at most"):
        AC.Literals([(str(i), i) for i in range(AC.TERMS + 1)])


def test_best_alias_and_its_domain(spark):
    taxonomy = (("Software Engineer", "software-engineer", "software"), ("Engineer", "engineer", "engineering"), ("Software-Ingenieur", "software-engineer", "software"), ("Ingénieur logiciel", "software-engineer", "software"), ("Head of Data Platform", "data-head", "data"), ("Platform of Data Head Office", "office", "office"), ("software engineer", "second", "no"))
    due = {
        "Senior Software Engineer (m/f/d)": "software-engineer", "Engineer": "engineer", "Ingenieur logiciel": "software-engineer", "Lead Ingénieur(e) Logiciel": None, "Platform Data: Head of Team": "data-head", "Head office of data platform": "office",
        "engineers": None, "Software, Engineer": "engineer", "": None, "Data-Engineer/Ops": "engineer", "SOFTWARE  ENGINEER": "software-engineer",
    }
    df = spark.createDataFrame([(t,) for t in [*due, None]], "title string")
    got = {r["title"]: r["slug"] for r in df.select("title", AC.best_alias([(a, s) for a, s, _ in taxonomy])("title").alias("slug")).collect()}
    due["Lead Ingénieur(e) Logiciel"] = "software-engineer"
    assert got == due | {None: None}
    name, family = J.profile(F.col("title"), AC.best_alias([(a, s) for a, s, _ in taxonomy])("title"), T.profile_table(), {s: d for _, s, d in taxonomy})
    got = {r["title"]: (r["n"], r["f"]) for r in spark.createDataFrame([("Software Engineer",), ("Barista",)], "title string").select("title", name.alias("n"), family.alias("f")).collect()}
    assert got["Software Engineer"][1] in ("software", "no") and got["Barista"] == ("food-service", "hospitality-retail")


YEARS = {
    "mindestens 5 Jahre Erfahrung": 5.0, "3-5 ans d'expérience en gestion": 3.0, "6 months to 1 year work experience": 0.5, "Berufserfahrung von mindestens 4 Jahren": 4.0, "esperienza di almeno 7 anni": 7.0, "experiencia de al menos 2 años": 2.0,
    "3 jaar ervaring": 3.0, "10 års erfarenhet": 10.0, "expérience de 3 ans minimum": 3.0, "18 mois d’expérience": 1.5, "2,5 Jahre Berufserfahrung": 2.5, "5-3 years of experience": None, "warranty: 5 years of experience": None, "31 years of experience": None,
    "5+ years of Java and 8+ years of design experience": 8.0, "12 to 18 months experience": 1.0, "": None, "1 year": None,
}


@pytest.mark.parametrize("text, due", YEARS.items())
def test_years_of_experience_in_languages(text, due):
    assert E.required_years(text) == due


def by_hand(fields, groups, bad):
    """Sum over minimal covers, all pairs of positions tried."""
    at, pos = [], 0
    for text, weight in fields:
        ws = [RK.stemmed(w) for w in "".join(c if c.isalnum() else " " for c in text.lower()).split()]
        for i, w in enumerate(ws):
            hit = {g for g, alts in enumerate(groups) for a in alts if tuple(ws[i : i + len(a)]) == a}
            if any(tuple(ws[i : i + len(a)]) == a for a in bad):
                return None
            at.append((pos + i, hit, weight))
        pos += len(ws)
    hits = [h for h in at if h[1]]
    covers = []
    for i, a in enumerate(hits):
        for j in range(i, len(hits)):
            if set().union(*[h[1] for h in hits[i : j + 1]]) == set(range(len(groups))):
                covers.append((i, j))
                break
    covers = [c for c in covers if not any(d != c and d[0] >= c[0] and d[1] <= c[1] for d in covers)]
    if not covers:
        return None
    return sum((j - i + 1) / sum(1 / h[2] for h in hits[i : j + 1]) / (1 + hits[j][0] - hits[i][0] - (j - i)) for i, j in covers)


def test_cover_density_against_brute_force(spark):
    rng = random.Random(4)
    words = ["data", "engineers", "engineering", "cloud", "the", "team", "leads", "bad"]
    rows = [(i, " ".join(rng.choices(words, k=rng.randrange(0, 4))), " ".join(rng.choices(words[:7] if rng.random() < 0.8 else words, k=rng.randrange(0, 30)))) for i in range(60)]
    rows += [(100, None, None), (101, "data", None), (102, "", "Data, ENGINEER! cloud")]
    df = spark.createDataFrame(rows, "id long, title string, text string")
    for query in ('data engineer -bad', '"data engineer" OR leading cloud', "team", 'cloud "the team" data OR lead', '-bad'):
        wanted, bad = RK.parsed(query)
        got = {r["id"]: r["rank"] for r in RK.ranked(df, "id", query, [("title", 1.0), ("text", 0.1)]).collect()}
        if not wanted:
            assert all(v == 0 for v in got.values()) and 100 in got
            continue
        due = {i: by_hand([(t or "", 1.0), (x or "", 0.1)], wanted, bad) for i, t, x in rows}
        assert got == {i: pytest.approx(v) for i, v in due.items() if v is not None}, query
    assert RK.ranked(df, "id", " ", [("title", 1.0)]).count() == len(rows) and RK.ranked(df.limit(0), "id", "data", [("title", 1.0)]).count() == 0


def test_stems_in_columns_and_in_python(spark):
    words = ["engineers", "engineering", "relational", "companies", "class", "status", "analysis", "is", "ring", "led", "leaders", "happiness", "hopefulness", "payments", "ing", "caresses", ""]
    got = spark.createDataFrame([(w,) for w in words], "w string").select("w", RK.stem(F.col("w")).alias("s")).collect()
    assert {r["w"]: r["s"] for r in got} == {w: RK.stemmed(w) for w in words}


def test_location_types(spark):
    due = {"On-Site": "onsite", " Onsite (5 Days per Week)": "onsite", "office, remote": "hybrid", "Télétravail": "remote", "": None, "  ": None, None: None, "elsewhere": "x", "elsewhere (remote)": "x", "remote (eu) only": "x", "da remoto": "remote"}
    got = spark.createDataFrame([(t,) for t in due], "t string").select("t", V.location_type(F.col("t"), "x").alias("v")).collect()
    assert {r["t"]: r["v"] for r in got} == due


def test_trigram_languages(spark):
    said = {"en": "the engineer builds the platform with the team and they ship what users want", "de": "der Ingenieur baut die Plattform mit dem Team und liefert was Nutzer wünschen", "fr": "l'ingénieur construit la plateforme avec son équipe et livre ce que veulent les gens"}
    train = spark.createDataFrame([(t, k) for k, t in said.items()] + [("zzz", None), (None, "en")], "text string, lang string")
    weights = LG.train(train)
    asked = [(1, "the users want the platform"), (2, "die Nutzer und der Ingenieur"), (3, "les gens veulent une équipe"), (4, ""), (5, None), (6, "123"), (7, "the the " * 5000)]
    got = {r["id"]: r["lang"] for r in LG.scored(spark.createDataFrame(asked, "id long, text string"), weights).collect()}
    assert got == {1: "en", 2: "de", 3: "fr", 7: "en"}
    assert LG.train(train.limit(0)).count() == 0 and LG.scored(spark.createDataFrame(asked, "id long, text string").limit(0), weights).count() == 0


def test_page_blocks_a_few_pages_at_a_time(spark, monkeypatch):
    monkeypatch.setattr(E, "PAGES_AT_ONCE", 2)
    pages = spark.createDataFrame([(i, f"<h1>T {i}</h1><p>a &amp; b<ul><li>x {i}</ul>") for i in range(5)] + [(9, None), (10, "")], "id int, html string").coalesce(1)
    got = E.with_page_blocks(pages).orderBy("id").collect()
    due = pages.select("id", "html", E.page_blocks("html").alias("blocks"), E.normal_html("html").alias("normal")).orderBy("id").collect()
    assert [tuple(r) for r in got] == [tuple(r) for r in due]


def test_only_words_like_those_of_a_query_are_stemmed(spark):
    df = spark.createDataFrame([(1, "Walking the dogs, walks; of the us")], "id int, text string")
    hits = RK.hits(df, "id", 'walk "of the" us', [("text", 1.0)])
    assert sorted((r["pos"], r["term"]) for r in hits.collect()) == [(0, 0), (3, 0), (4, 1), (6, 2)]
    assert "substring" in hits._jdf.queryExecution().analyzed().toString().split("endswith")[0].lower()


def test_derivation_reads_each_distinct_value_once(spark):
    rows = [("c", f"u{i}", t, d, None, "Full-time", None, p) for i, (t, d, p) in enumerate([("Senior Data Engineer", "<p>We pay $150,000 per year. 5+ years of experience</p>", "2024-03-05"), (None, "the team and the office of the town", None), ("Barista", None, "x"), (None, None, "2024-03-05")] * 2)]
    raw = spark.createDataFrame(rows, "company_slug string, url string, title string, description string, source_identity string, employment_type string, language string, date_posted string")
    got = J.derive(raw, F.lit("2024-06-01").cast("timestamp"))
    assert sorted((r["url"], r["profile"], r["sal_min"], r["yoe_min"], r["language"], r["posted_day"], r["desc_len"]) for r in got.collect()) == [
        (f"u{i}", *[("data", 150000.0, 5.0, "en", 19787, 48), ("other", None, None, "en", None, 35), ("food-service", None, None, "unknown", None, 0), ("other", None, None, "unknown", 19787, 0)][i % 4]) for i in range(8)
    ]
    plan = got._jdf.queryExecution().optimizedPlan().toString().lower()
    assert "rlike" not in plan and "years_of_experience" not in plan


def test_scores_of_rare_words_are_joined(spark, monkeypatch):
    """Whatever number of words goes to the tasks, the sums are the same, and no text is shuffled word by word for words
    that do."""
    train = spark.createDataFrame([("the river and the town", "en"), ("der fluss und die stadt", "de"), ("ab", "zz"), ("ab", "aa")], "text string, lang string")
    weights = LG.train(train)
    asked = spark.createDataFrame([(1, "the town the town xyz"), (2, "die stadt"), (2, "und der the"), (3, "ab"), (4, None), (5, "qqqq")], "id long, text string")
    got = []
    for most in (400_000, 3, 0):
        monkeypatch.setattr(LG, "SENT_WORDS", most)
        out = LG.scored(asked, weights)
        got.append({r["id"]: r["lang"] for r in out.collect()})
        assert "word" not in [x.split("hashpartitioning(")[1].split("#")[0] for x in out._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(" in x] or most < 400_000
    assert got[0] == got[1] == got[2] and got[0][1] == "en" and got[0][2] == "de" and got[0][3] == "aa" and 4 not in got[0] and 5 in got[0]
