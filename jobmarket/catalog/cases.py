"""Queries over tables of cases: every row of a table takes one of some written-down inputs by its key, and the DuckDB twin
names the result that is due for it, so that neither side shares a pattern or constant with the other."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from jobmarket.catalog.attributes import pick, spark_pick
from jobmarket.functions import automaton as AC
from jobmarket.functions import extract as E
from jobmarket.functions import text as T
from jobmarket.functions import values as V
from jobmarket.operators import tables as M
from jobmarket.plans import analytics as A
from jobmarket.plans import jobs as J
from jobmarket.plans.frame import read
from jobmarket.streaming import boards as B

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


def due(cases, *names: str) -> str:
    """Twin of a case table: the results of an order's case under the given names (strings and nulls)."""
    at = lambda i: pick([c[1][i] if len(names) > 1 else c[1] for c in cases], "o_orderkey")
    return "select o_orderkey, " + ", ".join(f"{at(i)}::varchar as {n}" for i, n in enumerate(names)) + " from orders"


def inputs(spark, d, cases):
    return read(spark, d, "orders").select("o_orderkey", spark_pick([c[0] for c in cases], "o_orderkey").alias("x"))


def by_text(df, found: Column):
    """Pandas functions see each distinct text once."""
    return df.join(df.select("x").distinct().withColumn("y", found), "x")


PAY = (
    ("$150,000 - $200,000 per year.", ("150000", "200000", "USD", "year")), ("CA, US, San Jose - 120,000 - 150,000 USD annually", ("120000", "150000", "USD", "year")),
    ("The range is 90,000 - 110,000 CAD.", ("90000", "110000", "CAD", "year")), ("A$120,000 - A$150,000 plus super", ("120000", "150000", "AUD", "year")), ("S$8,000 per month", ("8000", "8000", "SGD", "month")),
    ("60.000 - 80.000 EUR brutto im Jahr", ("60000", "80000", "EUR", "year")), ("60.000 € - 80.000 €", ("60000", "80000", "EUR", "year")), ("£45k-£55k", ("45000", "55000", "GBP", "year")),
    ("CHF 100'000 - 120'000", ("100000", "120000", "CHF", "year")), ("18 000 - 24 000 PLN miesięcznie", ("18000", "24000", "PLN", "month")), ("45 000 Kč měsíčně", ("45000", "45000", "CZK", "month")),
    ("650 000 Ft/hó", ("650000", "650000", "HUF", "month")), ("5000 lei pe lună", ("5000", "5000", "RON", "month")), ("35 000 SEK i månaden", ("35000", "35000", "SEK", "month")), ("4 000 лв. на месец", ("4000", "4000", "BGN", "month")),
    ("40 000 DKK", ("40000", "40000", "DKK", "year")), ("raised $150,000,000 in funding", (None, None, None, None)), ("$25 - $30 per hour", ("25", "30", "USD", "hour")), ("$120K (AUD)", ("120000", "120000", "AUD", "year")),
    ("USD 90,000 to 120,000", ("90000", "120000", "USD", "year")), ("Great culture", (None, None, None, None)), ("A single $90,000, but the range is €50.000 - €60.000", ("50000", "60000", "EUR", "year")),
)


@query("c14_pay_families", due(PAY, "pay_min", "pay_max", "currency", "unit"))
def pay(spark, d):
    """Pay in texts of every family."""
    got = by_text(inputs(spark, d, PAY), E.pay_in_text("x"))
    whole = lambda c: F.col(c).cast("long").cast("string")
    return got.select("o_orderkey", whole("y.min").alias("pay_min"), whole("y.max").alias("pay_max"), "y.currency", "y.unit")


COUNTRIES = (
    ("San Francisco, CA", "US"), ("Bengaluru, Karnataka", "IN"), ("Remote - IN", "IN"), ("Texas", "US"), ("Indianapolis, IN", "US"), ("Remote (US)", "other"), ("U.S.", "US"), ("Berlin, Germany", "other"), ("", None),
    ("Arlington, VA", "US"), ("Remote, US", "US"), ("Salt Lake City", "US"), ("New Mexico", "US"), ("London", "other"), ("Hyderabad or Austin, TX", "IN"), ("Cambridge, MA", "US"), ("Cambridge", "other"), ("St. Louis", "US"), ("Remote (India)", "IN"), ("Mexico City", "other"),
)


@query("c20_country_cases", due(COUNTRIES, "bucket"))
def countries(spark, d):
    """C20: markers, cities, state names and codes."""
    return inputs(spark, d, COUNTRIES).select("o_orderkey", V.country_bucket(F.col("x"), F.lit(None).cast("string")).alias("bucket"))


YEARS = (
    ("5+ years of experience with SQL", "5"), ("3-5 years in sales", "3"), ("For over 20 years of experience we lead", None), ("18 months of experience", "1.5"), ("40 years of experience", None),
    ("Experience required: 4 years", "4"), ("2 years of experience, 6+ years of Java experience", "6"), ("no numbers", None), ("at least 10 years' professional experience", "10"), ("", None),
)


@query("c13_experience_cases", due(YEARS, "years"))
def years(spark, d):
    """Ranges, least years, labels, months; company histories and numbers above thirty do not count."""
    got = by_text(inputs(spark, d, YEARS), E.years_of_experience("x"))
    return got.select("o_orderkey", F.regexp_replace(F.col("y").cast("string"), r"\.0$", "").alias("years"))


TECHS = (
    ("Python, C++ and C# on AWS", "python,cplusplus,csharp,aws"), ("We use javascript (not java).", "javascript"), ("Java and Kotlin", "java,kotlin"), ("PyTorch or scikit-learn", "pytorch,scikit-learn"), ("pythonic cplusplus", ""), ("Power BI, Tableau", "tableau,power-bi"),
)


@query("c12_technology_table", due(TECHS, "technologies"))
def technologies(spark, d):
    """The whole table of technologies, once per distinct text."""
    x = inputs(spark, d, TECHS)
    known = x.select("x").distinct().withColumn("y", F.array_join(T.named_technologies(F.col("x"), T.technology_table()), ","))
    return x.join(known, "x").select("o_orderkey", F.col("y").alias("technologies"))


LANGUAGES = (
    ("The work is for a team that is the best and on this we are", "en"), ("Wir sind ein Team und das ist nicht die Arbeit von der Firma", "de"), ("Nous avons une équipe pour les clients et le travail est dans la ville", "fr"),
    ("El trabajo en la empresa es para los clientes y con una persona como tú", "es"), ("short", "unknown"), ("zzzz qqqq xxxx yyyy wwww vvvv", "unknown"),
)


@query("c26_language_cases", due(LANGUAGES, "language"))
def languages(spark, d):
    """Stop words of four languages."""
    return inputs(spark, d, LANGUAGES).select("o_orderkey", T.language(F.lit(None).cast("string"), F.col("x")).alias("language"))


CLEAN = (("Senior Software Engineer II, Payments", "Software Engineer"), ("Data Scientist (m/w/d)", "Data Scientist"), ("Staff Engineer - Platform", "Engineer"), ("Junior  R&D Engineer [Remote]", "R&d Engineer"), ("Lead", None), ("barista", "Barista"))


@query("c9_title_cases", due(CLEAN, "title"))
def clean(spark, d):
    """Brackets, suffixes and levels of titles go."""
    return inputs(spark, d, CLEAN).select("o_orderkey", T.clean_title(F.col("x")).alias("title"))


OCCUPATIONS = (("software engineer", "software-engineer"), ("Senior Data Scientist", "data-scientist"), ("Platform Data: Head of Team", "data-head"), ("Barista wanted", "barista"), ("Zzz Qqq", None), ("Engineer, Software", None))
ALIASES = [("software engineer", "software-engineer"), ("data scientist", "data-scientist"), ("scientist", "scientist"), ("barista", "barista"), ("head of data platform", "data-head")]


@query("c1_occupation_cases", due(OCCUPATIONS, "occupation"))
def occupations(spark, d):
    """Exact alias, longest whole-word alias, token set."""
    got = by_text(inputs(spark, d, OCCUPATIONS), AC.best_alias(ALIASES)("x"))
    return got.select("o_orderkey", F.col("y").alias("occupation"))


PLACES = (
    ("San Francisco, CA", ("US", "San Francisco", None, None)), ("Toronto, ON", ("CA", "Toronto", None, None)), ("Remote - US", ("US", None, None, "remote")), ("Remote (EMEA)", (None, None, "EMEA", "remote")), ("Hybrid, Berlin", ("DE", "Berlin", None, "hybrid")), ("nowhere", (None, None, None, None)),
)


@query("c18_place_cases", due(PLACES, "country", "city", "region", "mode"))
def places(spark, d):
    """Places with a gazetteer that the caller gives."""
    resolve = E.place_resolver({"san francisco": ("US", 9), "toronto": ("CA", 9), "berlin": ("DE", 9)}, {"us": "US"}, {"on": "CA", "ca": "US"})
    got = by_text(inputs(spark, d, PLACES), resolve("x"))
    return got.select("o_orderkey", "y.country", "y.city", "y.region", "y.mode")


PROFILES = (
    ("Registered Nurse", ("registered-nurse", "healthcare")), ("Server Administrator", ("it-support", "infrastructure-security")), ("Barista", ("food-service", "hospitality-retail")), ("Server", ("food-service", "hospitality-retail")),
    ("Head of Sales", ("sales-other", "sales-customer")), ("Process Engineer", ("engineer-other", "engineering")), ("Zzz Qqq", ("other", "other")), ("Director", ("executive-leadership", "management-consulting")), ("Product Owner", ("product-manager", "product-design")),
    ("CDL Driver", ("driver", "logistics-transport")), ("Kitchen Porter", ("chef-cook", "hospitality-retail")),
)


@query("c2_profile_rules", due(PROFILES, "profile", "family"))
def profiles(spark, d):
    """The whole list of title rules, in order."""
    name, family = J.profile(F.col("x"), rules=T.profile_table())
    return inputs(spark, d, PROFILES).select("o_orderkey", name.alias("profile"), family.alias("family"))


#: Raw postings (title, description, locations, workplace, pay unit) and what is due: profile, seniority, work mode, country,
#: city, places, countries, pay, unit, source of pay, technologies.
RAW = (
    (("Senior Data Engineer", "<p>Python &amp; SQL. $150,000 - $200,000 per year. 5+ years of experience.</p>", "San Francisco, CA|Remote - US", "", None), ("engineer-other", "senior", "remote", "US", "San Francisco", "2", "1", "150000", "year", "description", "5", "python,sql")),
    (("Barista", "Nice place", "Berlin", "Hybrid", "hourly"), ("food-service", "unspecified", "hybrid", "DE", "Berlin", "1", "1", "83200", "hour", "structured", None, "")),
    (("Junior Nurse", "We pay 18 000 - 24 000 PLN miesięcznie", "nowhere|Toronto, ON|Berlin", "", None), ("registered-nurse", "entry", "unspecified", "CA", "Toronto", "3", "2", "216000", "month", "description", None, "")),
    (("Zzz Qqq", None, "", "On-site", "piece"), ("other", "unspecified", "onsite", None, None, "0", "0", None, None, "none", None, "")),
)
DUE = ("profile", "seniority", "work_mode", "country", "city", "n_locations", "n_countries", "pay_min", "sal_unit", "sal_source", "years", "technologies")


@query("r1_derived_frame", due(RAW, *DUE))
def derived(spark, d):
    """Raw postings to the derived frame."""
    one = lambda i: spark_pick([c[0][i] for c in RAW], "o_orderkey")
    pay = F.when(one(4).isNotNull(), F.struct(F.lit(40.0).alias("min"), F.lit(50.0).alias("max"), F.lit("eur").alias("currency"), one(4).alias("unit")))
    raw = read(spark, d, "orders").select(
        F.concat(F.lit("c"), F.col("o_orderkey") % 50).alias("company_slug"), F.lit("b").alias("board_slug"), F.lit("s").alias("source"), F.concat(F.lit("https://x/"), "o_orderkey").alias("url"), F.col("o_orderkey").cast("string").alias("source_identity"),
        one(0).alias("title"), one(1).alias("description"), F.filter(F.split(one(2), r"\|"), lambda x: x != "").alias("locations"), one(3).alias("workplace"), F.lit("Full-time").alias("employment_type"), pay.alias("base_pay"),
        F.lit(None).cast("string").alias("language"), F.lit("2024-03-05").alias("date_posted"), "o_orderkey",
    )
    resolve = E.places_resolver({"san francisco": ("US", 9), "toronto": ("CA", 9), "berlin": ("DE", 9)}, {"us": "US"}, {"on": "CA", "ca": "US"})
    got = J.derived_frame(raw.drop("o_orderkey"), F.lit("2024-06-01").cast("timestamp"), resolve, T.profile_table(), T.technology_table())
    keys = raw.select(V.job_key(F.col("company_slug"), F.col("source_identity")).alias("job_key"), "o_orderkey")
    text = lambda c: F.regexp_replace(F.col(c).cast("string"), r"\.0$", "")
    return got.join(keys, "job_key").select(
        "o_orderkey", "profile", "seniority", "work_mode", "country", "city", text("n_locations").alias("n_locations"), text("n_countries").alias("n_countries"), F.col("sal_min").cast("long").cast("string").alias("pay_min"), "sal_unit", "sal_source",
        text("yoe_min").alias("years"), F.array_join("technologies", ",").alias("technologies"),
    )


COERCED = (('" a "', ("a", "a")), ('["a", "b", "a", "", null]', ("a, b", "a|b")), ('[["x", "y"], "z"]', ("x, y, z", "x, y|z")), ('""', (None, None)), ("null", (None, None)), ("12", ("12", "12")), ('{"k":1}', ('{"k":1}', '{"k":1}')), ("[]", (None, None)))


@query("c42_coercion", due(COERCED, "as_text", "as_list"))
def coerced(spark, d):
    """JSON scalars, lists and objects as one text and as a list of texts."""
    x = inputs(spark, d, COERCED)
    return x.select("o_orderkey", T.coerced_text(F.col("x")).alias("as_text"), F.array_join(T.coerced_list(F.col("x")), "|").alias("as_list"))


@query("f6_locales", "select c_custkey, case when c_custkey % 3 = 0 then 'en' when c_custkey % 3 = 1 then 'de' else 'fr' end || case when c_custkey % 3 <> 2 then ',fr' else '' end || case when c_custkey % 2 = 0 then ',it' else '' end as locales from customer")
def locales(spark, d):
    """primary locale or en, then localisations, then detected languages."""
    primary = F.expr("case c_custkey % 3 when 0 then null when 1 then 'de' else 'fr' end")
    detected = F.expr("case when c_custkey % 2 = 0 then array('fr', 'it') end")
    return read(spark, d, "customer").select("c_custkey", F.array_join(T.locales(primary, F.array(F.lit("fr")), detected), ",").alias("locales"))


@query("c47_locale_prefix", "select c_custkey, case c_custkey % 4 when 0 then 'de' when 1 then 'pt' when 2 then 'en' end as prefix from customer")
def prefix(spark, d):
    """The language of a locale."""
    return read(spark, d, "customer").select("c_custkey", T.locale_prefix(F.expr("case c_custkey % 4 when 0 then 'de_CH' when 1 then 'PT-br' when 2 then 'en' end")).alias("prefix"))


@query("c19_primary_place", "select c_custkey, case when c_custkey % 3 = 0 then 'XX' when c_custkey % 3 = 1 then 'DE' end as country, case when c_custkey % 3 = 0 then 'second' when c_custkey % 3 = 1 then 'first' when c_custkey % 3 = 2 and c_custkey % 2 = 0 then 'first' end as city from customer")
def primary(spark, d):
    """The first place with a country, else the first place."""
    p = F.expr("""case c_custkey % 3 when 0 then array(named_struct('country', cast(null as string), 'city', 'first'), named_struct('country', 'XX', 'city', 'second'))
      when 1 then array(named_struct('country', 'DE', 'city', 'first'), named_struct('country', 'XX', 'city', 'second'))
      else case when c_custkey % 2 = 0 then array(named_struct('country', cast(null as string), 'city', 'first')) else cast(array() as array<struct<country: string, city: string>>) end end""")
    return read(spark, d, "customer").select("c_custkey", V.primary_place(p).alias("p")).select("c_custkey", "p.country", "p.city")


SECTION = "struct<kind: string, block_ids: array<int>, extracted: map<string, string>>"


def labelled(spark, d):
    """Postings with labels: six shapes of sections over ten blocks, by key."""
    one = lambda kind, ids, got: f"named_struct('kind', '{kind}', 'block_ids', array({ids}), 'extracted', {got})"
    signal, blank, none = "map('role_summary', 'x')", "map('role_summary', ' ')", "cast(null as map<string, string>)"
    shapes = (
        [one("role", "0, 1, 2", signal), one("requirements", "3, 4", signal)], [one("role", "0, 2", signal), one("benefits", "3, 4, 5", signal)], [one("role", "0, 1, 2, 3", none)],
        [one("intro", "0, 1, 2, 3, 4", none)], [one("role", "0, 1, 2, 3", blank), one("benefits", "3, 12", signal)], [],
    )
    cases = " ".join(f"when {i} then cast(array({', '.join(x)}) as array<{SECTION}>)" for i, x in enumerate(shapes))
    c = read(spark, d, "customer").selectExpr("c_custkey", f"case c_custkey % 6 {cases} end as sections", "case when c_custkey % 5 = 0 then ' ' when c_custkey % 5 = 1 then 'compliance specialist' else 'nurse' end as profession", "case when c_custkey % 2 = 0 then 'Head of' else 'senior' end as seniority", "case when c_custkey % 7 = 0 then array('Paris', ' #LI-Remote') else array('Paris') end as locations")
    return c.withColumn("blocks", F.sequence(F.lit(0), F.lit(9)))


@query("r18_qa_verdict", """with x as (select c_custkey, c_custkey % 6 as k, c_custkey % 5 <> 0 as prof from customer)
select c_custkey, case when k = 0 and prof then 'accepted' when k = 1 and prof then 'accepted' else 'rejected' end as verdict,
  array_to_string(list_filter([case when k = 5 then 'split_coverage_min_40pct' end, case when not prof then 'profession_non_empty' end, case when k in (3, 5) then 'has_extractable_section' end, case when k = 2 then 'section_role_has_extraction' end, case when k = 4 then 'role_has_signal' end], lambda y: y is not null), ',') as failed from x""")
def qa(spark, d):
    """Rules over labelled postings, and the verdict."""
    rules = A.qa_rules(F.col("sections"), F.col("blocks"), F.col("profession"))
    failed = F.array_join(F.transform(F.filter(rules, lambda r: ~r["passed"]), lambda r: r["name"]), ",")
    return labelled(spark, d).select("c_custkey", A.verdict(rules).alias("verdict"), failed.alias("failed"))


@query("r19_section_checks", "select c_custkey, c_custkey % 6 = 4 as unknown_block, c_custkey % 6 in (1, 4) as not_contiguous, c_custkey % 6 = 4 as repeated_block, c_custkey % 5 = 1 and c_custkey % 2 = 0 as rank_mismatch, c_custkey % 7 = 0 as hashtag_place from customer")
def checks(spark, d):
    """Block ids of sections, and the globals."""
    s, g = A.section_checks(F.col("sections"), F.col("blocks")), A.globals_checks(F.col("profession"), F.col("seniority"), F.col("locations"))
    return labelled(spark, d).select("c_custkey", s.alias("s"), g.alias("g")).select("c_custkey", "s.*", "g.*")


GONE = (
    ("gone 0, gone 7", ("gone", "1440")), ("gone 0, gone 3", ("gone_pending", "360")), ("success 0, gone 1, gone 8", ("gone_pending", "360")), ("success 0, gone 1, gone 8, gone 15", ("gone", "1440")),
    ("gone 0, gone 7, success 8", ("active", "5")), ("gone 0, gone 7, failure 8", ("gone", "1440")), ("failure 0, failure 1", ("active", "20")),
)


@query("t8_gone_confirmation", due(GONE, "status", "next_check_minutes"))
def gone(spark, d):
    """Confirmations hours apart, more of them after a recent success, the daily look at a gone board."""
    x = inputs(spark, d, GONE).select(F.col("o_orderkey").cast("string").alias("board"), F.posexplode(F.split("x", ", ")))
    hours = F.split_part("col", F.lit(" "), F.lit(2)).cast("int")
    events = x.select("board", F.col("pos").cast("long").alias("event_id"), (F.lit("2024-01-01 00:00:00").cast("timestamp") + F.make_interval(hours=hours)).alias("ts"), F.split_part("col", F.lit(" "), F.lit(1)).alias("outcome"))
    return B.health_batch(events).select(F.col("board").cast("long").alias("o_orderkey"), "status", F.col("next_check_minutes").cast("string").alias("next_check_minutes"))


@query("u4_dimension_sync", "select 's' || s_suppkey as slug, case when s_suppkey % 10 = 2 then 'old' when s_suppkey % 3 = 0 then 'api' when s_suppkey % 3 = 1 then 'rss' else 'unknown' end as monitor, s_suppkey % 10 <> 2 as enabled from supplier")
def dimension_sync(spark, d):
    """U4: boards upserted and enabled, absent ones disabled, unknown monitor types replaced by a default."""
    b = read(spark, d, "supplier")
    target = b.filter("s_suppkey % 10 <> 1").selectExpr("concat('s', s_suppkey) as slug", "'old' as monitor", "s_suppkey % 4 <> 0 or s_suppkey % 10 = 2 as enabled")
    incoming = b.filter("s_suppkey % 10 <> 2").selectExpr("concat('s', s_suppkey) as slug", "case s_suppkey % 3 when 0 then 'api' when 1 then 'rss' else 'bogus' end as monitor")
    return M.dimension_sync(target, incoming, "slug", {"monitor": (("api", "rss"), "unknown")})


DURABLE = """e as (select o_orderkey as k, 'i' || o_orderkey as identity, 'u' || o_orderkey as url, 'b' || o_custkey % 5 as board, o_orderstatus <> 'F' as active from orders where o_orderkey % 10 <> 1),
al as (select 'old' || o_orderkey as url, 'i' || o_orderkey as identity from orders where o_orderkey % 7 = 0 union all select 'x' || o_orderkey, 'z' from orders where o_orderkey % 20 = 9),
n as (select o_orderkey as k, 'i' || o_orderkey as identity, case when o_orderkey % 20 = 9 then 'x' when o_orderkey % 5 = 0 then 'new' when o_orderkey % 5 = 1 then 'old' else 'u' end || o_orderkey as url, 'b' || (o_custkey + (o_orderkey % 9 = 0)::int) % 5 as board, o_orderkey % 3 <> 0 as explicit from orders where o_orderkey % 10 <> 2),
a as (select n.identity, n.url, n.explicit, e.url as old_url, case when n.k % 20 = 9 then 'conflict' when e.k is null then 'new' when e.board = n.board and e.active then 'touched' when e.board = n.board then 'relisted' when e.active then 'foreign' else 'foreign_relisted' end as action from n left join e using (k))"""


def durable(spark, d):
    o = read(spark, d, "orders")
    e = o.filter("o_orderkey % 10 <> 1").selectExpr("concat('i', o_orderkey) as identity", "concat('u', o_orderkey) as url", "concat('b', o_custkey % 5) as board", "o_orderstatus <> 'F' as active")
    al = o.filter("o_orderkey % 7 = 0").selectExpr("concat('old', o_orderkey) as url", "concat('i', o_orderkey) as identity").unionByName(o.filter("o_orderkey % 20 = 9").selectExpr("concat('x', o_orderkey) as url", "'z' as identity"))
    n = o.filter("o_orderkey % 10 <> 2").selectExpr("concat('i', o_orderkey) as identity", "concat(case when o_orderkey % 20 = 9 then 'x' when o_orderkey % 5 = 0 then 'new' when o_orderkey % 5 = 1 then 'old' else 'u' end, o_orderkey) as url", "concat('b', (o_custkey + cast(o_orderkey % 9 = 0 as int)) % 5) as board", "o_orderkey % 3 <> 0 as explicit")
    return M.durable_diff(e, al, n)


@query("u25_durable_diff", f"with {DURABLE} select identity, url, action, old_url from a")
def durable_actions(spark, d):
    """What a discovered identity is to the table, whatever its url."""
    return durable(spark, d)[0].select("identity", "url", "action", "old_url")


@query("u25_aliases", f"with {DURABLE}, m as (select old_url as url, identity from a where explicit and action not in ('conflict', 'new') and old_url <> url), u as (select * from al union select * from m) select url, identity from u anti join (select url, identity from a where action <> 'conflict') using (url, identity)")
def durable_aliases(spark, d):
    """Former urls after a discovery: replaced ones appended, returned ones gone."""
    return durable(spark, d)[1]
