"""Composite jobs: derivation of raw postings, profiles, hierarchies, sweeps and report documents."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmarket.functions import automaton as AC
from jobmarket.functions import extract as E
from jobmarket.functions import text as T
from jobmarket.functions import values as V
from jobmarket.operators import tables as M
from jobmarket.sources.tables import staged

#: Ordered title rules (profile, family, pattern); the first hit counts. A default that callers replace or extend.
PROFILES = (
    ("software-engineer", "engineering", r"\b(software|developer|sde|swe|devops|reliability|platform)\b"),
    ("data", "engineering", r"\b(data|machine learning|analyst)\b"),
    ("it-support", "engineering", r"\b(server\s+admin|it support|helpdesk)"),
    ("nurse", "healthcare", r"\b(nurse|nursing)\b"),
    ("food-service", "hospitality-retail", r"\b(barista|bartender|waiter|waitress)\b"),
    ("sales", "sales-marketing", r"\b(sales|account)\b"),
    ("recruiter", "people", r"\brecruit"),
    ("management", "management", r"\b(head|director|manager|vp|cto|ceo)\b"),
)
EMPLOYMENT = {
    "full-time": "full_time", "full time": "full_time", "full_time": "full_time", "fulltime": "full_time", "permanent": "full_time", "part-time": "part_time", "part time": "part_time", "part_time": "part_time",
    "contract": "contract", "contractor": "contract", "freelance": "contract", "internship": "internship", "intern": "internship", "temporary": "temporary", "volunteer": "volunteer",
}
SALARY_UNITS = {"yr": "year", "yearly": "year", "annual": "year", "annually": "year", "per year": "year", "monthly": "month", "per month": "month", "weekly": "week", "daily": "day", "hourly": "hour", "per hour": "hour", "hr": "hour"}


def profile(title: Column, matched: Column | None = None, rules=PROFILES, domains: dict[str, str] | None = None) -> tuple[Column, Column]:
    """(profile, family): a taxonomy match and its domain if there is one, else the first rule that hits, else other."""
    name = T.chain([(title.rlike("(?i)" + p), n) for n, _, p in rules], F.lit("other"))
    family = T.chain([(title.rlike("(?i)" + p), f) for _, f, p in rules], F.lit("other"))
    if matched is None:
        return name, family
    own = F.create_map(*[F.lit(x) for kv in domains.items() for x in kv])[matched] if domains else F.lit(None).cast("string")
    return F.coalesce(matched, name), F.when(matched.isNull(), family).otherwise(F.coalesce(own, F.lit("other")))


def salary_unit(raw: Column) -> Column:
    """Alias, a known unit, or a unit named inside the text; null otherwise."""
    key = F.lower(F.trim(raw))
    named = [(key.contains(u), u) for u in ("hour", "month", "week", "day", "year")]
    return T.chain([(key == a, u) for a, u in SALARY_UNITS.items()] + named, F.lit(None).cast("string"))


def unified_pay(ranges: DataFrame, key: str) -> DataFrame:
    """Ranges (key, min, max, currency, unit) as one per key: the largest (currency, unit) group, its least and most."""
    g = ranges.groupBy(key, "currency", "unit").agg(F.count("*").alias("n"), F.min("min").alias("min"), F.max("max").alias("max"))
    return M.first_per_key(g, [key], [F.desc("n"), "currency", "unit"])


def located(places: DataFrame, names: DataFrame) -> DataFrame:
    """(id, place_id): hierarchical match of place texts by name index, the narrowest context first. names: (name,
    place_id, parent, population); a candidate whose parent stands in the text too wins, then population, then id."""
    parts = F.filter(F.transform(F.split(F.lower("text"), r"[,/|]"), lambda x: F.trim(x)), lambda x: x != "")
    p = places.select("id", parts.alias("parts"), F.explode(parts).alias("name"))
    c = p.join(names, "name").withColumn("_ctx", F.array_contains("parts", F.col("parent")).cast("int"))
    return M.first_per_key(c, ["id"], [F.desc("_ctx"), F.desc("population"), "place_id"]).select("id", "place_id")


def once(df: DataFrame, key: str, columns: list[dict[str, Column]], keep: list[str]) -> DataFrame:
    """df with the columns keep, which depend on the column key alone: they are made once per distinct value (null is
    one), step by step, in a written table. A small table goes to the rows, so that these need no shuffle; a large one
    is joined by shuffle."""
    own = df.select(key).distinct()
    for step in columns:
        own = own.withColumns(step)
    own = staged(own.select(F.col(key).alias("_of"), *keep))
    return df.join(own, df[key].eqNullSafe(own["_of"]), "left").drop("_of")


def _text_attributes(named: dict[str, Column] | None = None) -> tuple[list[dict[str, Column]], list[str]]:
    """Steps and names of what a description alone tells."""
    pay = V.annual(F.col("_found.min"), F.col("_found.max"), F.col("_found.currency"), F.col("_found.unit"), "description")
    text = F.col("_text")
    found = {"_years": E.years_of_experience("_text"), "_found": E.pay_in_text("_text"), **(named or {})}
    last = {
        "_described": pay, "education": T.education(text), "visa": T.visa(text), "equity": T.equity(text), "clearance": T.clearance(text),
        "_text_hits": T.stop_word_hits(text), "desc_len": F.length(text),
    }
    return [{"_text": T.plain_text(F.col("description"))}, found, last], ["_years", *(named or {}), *last]


def derive(raw: DataFrame, now: Column, company: str = "company_slug") -> DataFrame:
    """Raw postings as the derived frame: keys, title, seniority, profile, pay, years, signals, language. What a title, a
    description or a date tells is derived once per distinct one."""
    title = F.col("title")
    name, family = profile(title)
    of_title = {"title_clean": T.clean_title(title), "profile": name, "job_family": family, "seniority": T.seniority(title), "_title_hits": T.stop_word_hits(F.coalesce(title, F.lit(""))), "_title_len": F.coalesce(F.length(title) + 2, F.lit(0))}
    df = once(raw, "title", [of_title], list(of_title))
    df = once(df, "description", *_text_attributes())
    df = once(df, "date_posted", [_posted(now)], ["posted_day"])
    language = T.language_by_hits(F.col("language"), [F.col("_title_hits"), F.col("_text_hits")], F.col("_title_len") + F.col("desc_len"))
    return df.select(
        V.job_key(F.col(company), F.coalesce("source_identity", "url")).alias("job_key"), company, "url", "title_clean", "profile", "job_family", "seniority",
        T.employment_type(F.col("employment_type"), EMPLOYMENT).alias("employment_type"), F.col("_described.min").alias("sal_min"), F.col("_described.max").alias("sal_max"), F.col("_described.currency").alias("sal_currency"), F.col("_years").alias("yoe_min"),
        "education", "visa", "equity", "clearance", language.alias("language"), "posted_day", "desc_len",
    )


def _posted(now: Column) -> dict[str, Column]:
    return {"posted_day": F.unix_date(V.posted_at(F.col("date_posted"), now).cast("date"))}


def derived_frame(raw: DataFrame, now: Column, resolve, profiles: tuple[tuple[str, str, str], ...], technologies: list[tuple[str, tuple[str, ...], bool]], occupations: tuple[tuple[str, str, str], ...] = ()) -> DataFrame:
    """Raw postings as the whole derived frame of the report.

    raw: (company_slug, board_slug, source, url, source_identity, title, description, locations array, workplace,
    employment_type, base_pay struct of min, max, currency, unit, language, date_posted); resolve: a places_resolver;
    occupations: a taxonomy (alias, slug, domain), whose matches go before the title rules, with the domain as family.
    Rows without a url go. All places of a posting are resolved. Extraction sees each distinct title, text, date and list of places once; structured pay beats pay in the text."""
    df = raw.filter(F.coalesce("url", F.lit("")) != "").withColumn("_title", F.trim(F.coalesce("title", F.lit(""))))
    title = F.col("_title")
    matched = AC.best_alias([(a, s) for a, s, _ in occupations])("_title") if occupations else F.lit(None).cast("string")
    name, family = profile(title, F.col("_matched"), profiles, {s: d for _, s, d in occupations})
    of_title = {"title_clean": T.clean_title(title), "profile": name, "job_family": family, "seniority": T.seniority(title), "_title_hits": T.stop_word_hits(title), "_title_len": F.length(title) + 2}
    df = once(df, "_title", [{"_matched": matched, "_titled": AC.whole_words(technologies)("_title")}, of_title], ["_titled", *of_title])
    df = once(df, "description", *_text_attributes({"_named": AC.whole_words(technologies)("_text")}))
    countries = F.array_distinct(F.filter(F.transform("_places", lambda p: p["country"]), lambda c: c.isNotNull()))
    of_places = {"_place": V.primary_place(F.col("_places")), "n_locations": F.size("_places"), "n_countries": F.size(countries)}
    df = once(df, "locations", [{"_places": resolve(F.col("locations"))}, of_places], ["_places", *of_places])
    df = once(df, "date_posted", [_posted(now)], ["posted_day"])
    given = V.annual(F.col("base_pay.min"), F.col("base_pay.max"), F.col("base_pay.currency"), F.coalesce(salary_unit(F.col("base_pay.unit")), "base_pay.unit"), "structured")
    df = df.withColumn("_paid", V.normalised_pay(given, F.col("_described")))
    language = T.language_by_hits(F.col("language"), [F.col("_title_hits"), F.col("_text_hits")], F.col("_title_len") + F.col("desc_len"))
    return df.select(
        V.job_key(F.col("company_slug"), F.coalesce("source_identity", "url")).alias("job_key"), "company_slug", "board_slug", "source", "title_clean", "profile",
        "job_family", "seniority", T.employment_type(F.col("employment_type"), EMPLOYMENT).alias("employment_type"), V.work_mode(F.col("workplace"), F.col("_places")).alias("work_mode"),
        F.col("_place.country").alias("country"), F.col("_place.region").alias("region"), F.col("_place.city").alias("city"), "n_locations", "n_countries", "posted_day",
        F.col("_paid.min").alias("sal_min"), F.col("_paid.max").alias("sal_max"), F.col("_paid.currency").alias("sal_currency"), F.col("_paid.unit").alias("sal_unit"), F.coalesce("_paid.source", F.lit("none")).alias("sal_source"), F.col("_years").alias("yoe_min"),
        F.array_sort(F.array_union("_titled", "_named")).alias("technologies"), "education", "visa", "equity", "clearance", language.alias("language"), "desc_len",
    )


def terminal_sweep(postings: DataFrame, boards: DataFrame, configured: DataFrame) -> DataFrame:
    """Postings of terminal boards become inactive unless the board is configured again; class tells why."""
    b = boards.join(configured.select("board").distinct().withColumn("_known", F.lit(True)), "board", "left")
    kind = F.when(F.col("status") != "gone", "live").when(F.col("_known"), "blocked").otherwise("eligible")
    b = b.select("board", kind.alias("class"))
    out = postings.join(b, "board", "left")
    return out.withColumn("active", F.col("active") & ~F.coalesce(F.col("class") == "eligible", F.lit(False)))


def realigned(postings: DataFrame, boards: DataFrame) -> DataFrame:
    """Postings take their board's current company."""
    b = boards.select("board", F.col("company").alias("_c"))
    return postings.join(b, "board", "left").withColumn("company", F.coalesce("_c", "company")).drop("_c")


def resolved_misses(rows: DataFrame, misses: DataFrame, matched: DataFrame) -> DataFrame:
    """Fills keys of rows whose pending value matches now, and appends the matched ids where absent."""
    pending = misses.filter("status = 'pending'").join(matched, "value").select(F.col("value").alias("_v"), F.col("match").alias("_m"))
    out = rows.join(pending, rows["value"] == F.col("_v"), "left")
    return out.withColumns({"key": F.coalesce("key", "_m"), "ids": F.when(F.col("_m").isNotNull(), F.array_union("ids", F.array("_m"))).otherwise(F.col("ids"))}).drop("_v", "_m")


def section(rows: DataFrame, dims: list[str]) -> DataFrame:
    """Report rows of some dimensions as one JSON document per dimension, rows by jobs."""
    r = rows.filter(F.col("dim").isin(*dims))
    items = F.sort_array(F.collect_list(F.struct((-F.col("jobs")).alias("o"), "bucket", F.to_json(F.struct(*[c for c in rows.columns if c != "dim"])).alias("row"))))
    return r.groupBy("dim").agg(F.concat(F.lit("["), F.array_join(F.transform(items, lambda x: x["row"]), ","), F.lit("]")).alias("document"), F.count("*").alias("n_rows"))
