"""Places in free text over gazetteer tables: hierarchical match (C21) and country, city, region of a report.

Both work on distinct texts and meet the gazetteer by equi-joins on names, so that it may have any size: Spark
broadcasts names that are small and shuffles others. What is decided per text happens in joins and windows over the few
candidates of that text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmarket.functions import text as T
from jobmarket.operators.hierarchy import inside, intervals
from jobmarket.sources.tables import staged

# --- Fixed values: notes in place texts -------------------------------------------------------------------------------
TYPES = {"remote": "remote", "fully remote": "remote", "work from home": "remote", "wfh": "remote", "hybrid": "hybrid", "onsite": "onsite", "on-site": "onsite", "in-office": "onsite", "in office": "onsite"}
TYPE = r"(?i)\b(fully remote|remote|hybrid|on-?site|in[- ]office|work from home|wfh)\b"
NOTE = r"\([^()]*\)"
OTHERS = r"(?i)\s*(&|and|\+)\s*(other|[0-9]+ more) locations?$"
POSTAL = r"[,\s]+[A-Z]{0,2}-?[0-9]{4,6}(-[0-9]{4})?$"
OFFICE = r"(?i)\s+(hq|office|headquarters|campus)$"
TOKENS = r"\s*[,/|]\s*|\s+[-–—]\s+"
#: Ranks of kinds among equals, and how far a city may be behind the region of its name.
KINDS = {"city": 3, "region": 2, "country": 1, "macro": 0}
FACTOR = 10


def _key(name: Column) -> Column:
    return T.fold(F.lower(F.trim(name)))


def segments(raw: Column) -> Column:
    """Texts between semicolons, without white space around them."""
    return F.filter(F.transform(F.split(F.coalesce(raw, F.lit("")), ";"), lambda s: F.trim(F.regexp_replace(s, r"\s+", " "))), lambda s: s != "")


def work_type(segment: Column) -> Column:
    """remote, hybrid or onsite, from the first note in a text; null without one."""
    note = F.regexp_replace(F.lower(F.regexp_extract(segment, TYPE, 1)), "^onsite$", "on-site")
    return F.create_map(*[F.lit(x) for kv in TYPES.items() for x in kv])[F.when(note != "", note)]


def geo_text(segment: Column) -> Column:
    """What a text says about the place: without postal codes, office words, remarks in brackets and work types."""
    s = segment
    for pattern in (OTHERS, POSTAL, OFFICE, NOTE, TYPE):
        s = F.trim(F.regexp_replace(s, pattern, ""))
    return F.regexp_replace(F.regexp_replace(s, r"^[\s,/–-]+|[\s,/–-]+$", ""), r"\s+", " ")


def entities(texts: DataFrame, names: DataFrame) -> DataFrame:
    """(seg, pos, place_id, code) of the names in texts (seg, geo): tokens that are names as a whole; in a text of one
    token that is none, the longest runs of words that are names and do not overlap, those further right first."""
    names = names.select(_key(F.col("name")).alias("key"), "place_id", F.coalesce("code", F.lit(False)).alias("code")).distinct()
    most = names.agg(F.max(F.size(F.split("key", " "))).alias("n")).first()["n"] or 1
    tokens = texts.select("seg", F.filter(F.split("geo", TOKENS), lambda t: t != "").alias("tokens"))
    # A leading article and a trailing "City" may be missing in the gazetteer.
    plain = lambda k: F.regexp_replace(k, "^the ", "")
    forms = lambda k: F.array_distinct(F.array(k, plain(k), F.regexp_replace(plain(k), " city$", "")))
    each = tokens.select("seg", F.size("tokens").alias("n"), F.posexplode("tokens").alias("token", "t"))
    keyed = each.select("seg", (F.col("token") * 100_000).alias("pos"), "n", F.posexplode(forms(_key(F.col("t")))).alias("form", "key"))
    found = keyed.join(names, "key")
    best = found.groupBy("seg", "pos").agg(F.min("form").alias("form"))
    whole = staged(found.join(best, ["seg", "pos", "form"]).select("seg", "pos", "place_id", "code"))
    alone = each.filter("n = 1").join(whole.select("seg").distinct(), "seg", "left_anti").select("seg", F.split("t", " ").alias("words"))
    runs = alone.select("seg", "words", F.explode(F.sequence(F.lit(1), F.size("words"))).alias("start")).select("seg", "start", F.explode(F.sequence(F.lit(1), F.least(F.lit(most), F.size("words") - F.col("start") + 1))).alias("size"), "words")
    runs = runs.select("seg", "start", "size", _key(F.array_join(F.slice("words", F.col("start"), F.col("size")), " ")).alias("key")).join(names, "key")
    hits = staged(runs)
    order = F.array_sort(F.collect_set(F.struct((-F.col("size")).alias("a"), (-F.col("start")).alias("b"))))
    free = lambda acc, x: ~F.exists(acc, lambda y: (-x["b"] < -y["b"] - y["a"]) & (-y["b"] < -x["b"] - x["a"]))
    kept = hits.groupBy("seg").agg(F.aggregate(order, F.expr("cast(array() as array<struct<a:int,b:int>>)"), lambda acc, x: F.when(free(acc, x), F.concat(acc, F.array(x))).otherwise(acc)).alias("kept"))
    kept = kept.select("seg", F.explode("kept").alias("k")).select("seg", (-F.col("k.b")).alias("start"), (-F.col("k.a")).alias("size"))
    return whole.unionByName(hits.join(kept, ["seg", "start", "size"]).select("seg", F.col("start").alias("pos"), "place_id", "code"))


def foremost(names: DataFrame, places: DataFrame) -> DataFrame:
    """names (name, place_id, code), without cities that can be no answer: of cities that share name, parent and languages
    and hold no place, all rules but the last two, population and id, say the same, so only the best by these stays. So
    what a name may mean grows with the regions, not with the cities, that bear it."""
    key = _key(F.col("name"))
    inner = places.select(F.col("parent_id").alias("place_id")).filter("place_id is not null").distinct().withColumn("_holds", F.lit(True))
    known = places.join(inner, "place_id", "left").select("place_id", "parent_id", "languages", F.coalesce("population", F.lit(0)).alias("_people"), ((F.col("kind") == "city") & F.col("_holds").isNull()).alias("_leaf"))
    of = names.select(key.alias("name"), "place_id", F.coalesce("code", F.lit(False)).alias("code")).distinct().join(known, "place_id")
    best = of.filter("_leaf").groupBy("name", "code", "parent_id", "languages").agg(F.min_by("place_id", F.struct(-F.col("_people"), "place_id")).alias("place_id"))
    return of.filter("not coalesce(_leaf, false)").select("name", "place_id", "code").unionByName(best.select("name", "place_id", "code"))


def _ranked(c: DataFrame, group: list[str]) -> DataFrame:
    """The best candidate of every group (columns place_id, kind, entry, exit, population, spoken, code, alone).

    Alone: a code's region, then a country; a city inside the region of its name unless that has more than FACTOR times
    its people; else the more populous of city and region. In context: a city inside a region among the candidates,
    else a region or country, else a city. Then those of the text's language, the most populous, the most specific."""
    regions = c.filter("kind <> 'city'").select(*group, F.col("entry").alias("_in"), F.col("exit").alias("_out"))
    nested = c.filter("kind = 'city'").join(regions, group).filter("entry > _in and entry <= _out").select(*group, "place_id").distinct().withColumn("nested", F.lit(True))
    c = c.join(nested, [*group, "place_id"], "left").fillna(False, ["nested"])
    of = Window.partitionBy(*group)
    most = lambda cond: F.coalesce(F.max(F.when(cond, F.col("population"))).over(of), F.lit(-1))
    city, region = F.col("kind") == "city", F.col("kind").isin("region", "macro")
    # Windows may not stand inside one another, so the sums of a group come first.
    c = c.withColumns({"_nested": most(F.col("nested")), "_city": most(city), "_region": most(region)})
    near = F.col("_nested") >= 0
    region_first = F.when(near, (F.col("_nested") > 0) & (F.col("_nested") * FACTOR < F.col("_region"))).otherwise(F.col("_city") < F.col("_region"))
    alone = F.when(F.col("code") & (F.col("kind") == "region"), -1).when(F.col("kind") == "country", 0).when(region, F.when(region_first, 1).otherwise(3)).when(near & ~F.col("nested"), 4).otherwise(2)
    context = F.when(F.col("nested"), 0).when(~city, 1).otherwise(2)
    rank = F.create_map(*[F.lit(x) for kv in KINDS.items() for x in kv])[F.col("kind")]
    order = [F.when(F.col("alone"), alone).otherwise(context), F.col("spoken").desc(), F.col("population").desc(), rank.desc(), F.col("place_id")]
    return c.withColumn("_place", F.row_number().over(of.orderBy(*order))).filter("_place = 1").drop("_place", "_nested", "_city", "_region", "nested")


def resolved(texts: DataFrame, places: DataFrame, names: DataFrame) -> DataFrame:
    """(text, language, segment, place_id, work_type) of the distinct (text, language) rows of texts; place_id is null
    where only a work type is named, and texts without either give no row.

    places: (place_id, parent_id, kind, population, languages); kind is macro, region, country or city. names: (name,
    place_id, code), code for abbreviations. Names at the right are context for those at the left: each must lie inside
    the context further right, and a name that is a city too is context only if something at its left lies inside. What
    is left is the target, one place, of the candidates inside the narrowest context that holds any; if none does, the
    context itself is the answer. Without such a context, names that are no city at all are context for all others
    ("Switzerland, Geneva, Zurich"), and with none of these every name is a place of its own."""
    asked = texts.select("text", "language").distinct().withColumn("s", F.explode(segments(F.col("text"))))
    cleaned = asked.select("text", "language", F.col("s").alias("segment"), work_type(F.col("s")).alias("work_type"), geo_text(F.col("s")).alias("geo"))
    cleaned = staged(cleaned.withColumn("seg", F.xxhash64("geo", "language")))
    distinct = cleaned.filter("geo <> ''").groupBy("seg").agg(F.first("geo").alias("geo"), F.first("language").alias("language"))
    tree = intervals(places).select("place_id", "kind", "entry", "exit", F.coalesce("population", F.lit(0)).alias("population"), "languages")
    c = entities(distinct, staged(foremost(names, places))).join(tree, "place_id").join(distinct.select("seg", "language"), "seg")
    c = staged(c.withColumn("spoken", F.coalesce(F.array_contains("languages", F.col("language")), F.lit(False))).drop("languages", "language").dropDuplicates(["seg", "pos", "place_id"]))
    wide = F.col("kind") != "city"
    ent = c.groupBy("seg", "pos").agg(F.bool_or(wide).alias("wide"), F.bool_or(~wide).alias("city"))
    # A name right of another one that lies inside it.
    pairs = staged(c.alias("a").join(c.filter(wide).alias("b"), (F.col("a.seg") == F.col("b.seg")) & (F.col("a.pos") < F.col("b.pos")) & inside("a", "b")).select("a.seg", F.col("a.pos").alias("left"), F.col("a.place_id").alias("inner"), F.col("a.kind").alias("kind"), F.col("b.pos").alias("right"), F.col("b.place_id").alias("outer")))
    holds = pairs.select("seg", F.col("right").alias("pos")).distinct().withColumn("holds", F.lit(True))
    narrows = pairs.filter("kind <> 'city'").select("seg", F.col("left").alias("pos")).distinct().withColumn("narrows", F.lit(True))
    of = Window.partitionBy("seg")
    e = ent.join(holds, ["seg", "pos"], "left").join(narrows, ["seg", "pos"], "left").fillna(False, ["holds", "narrows"])
    e = e.withColumns({"first": F.min("pos").over(of), "last": F.max("pos").over(of)})
    fits = F.col("wide") & F.when(F.col("pos") == F.col("last"), ~F.col("city") | F.col("holds")).otherwise(F.col("narrows"))
    e = e.withColumn("stop", F.max(F.when(~fits | (F.col("pos") == F.col("first")), F.col("pos"))).over(of))
    e = e.withColumn("forward", F.col("pos") > F.col("stop")).withColumn("any", F.bool_or("forward").over(of)).withColumn("mixed", F.bool_or("city").over(of))
    backward = ~F.col("any") & F.col("mixed") & ~F.col("city")
    role = F.when(F.col("any"), F.when(F.col("forward"), "context").otherwise("target")).when(F.col("first") == F.col("last"), "alone").when(backward, "context").otherwise("each")
    e = staged(e.select("seg", "pos", "last", "any", role.alias("role")))
    c = c.join(e, ["seg", "pos"])
    narrowed = pairs.select("seg", F.col("left").alias("pos"), F.col("inner").alias("place_id")).distinct().withColumn("_ok", F.lit(True))
    context = c.filter("role = 'context'").join(narrowed, ["seg", "pos", "place_id"], "left").filter(wide & (~F.col("any") | (F.col("pos") == F.col("last")) | F.col("_ok"))).drop("_ok")
    specific = F.when(F.col("kind") == "region", 3).when(F.col("kind") == "country", 2).when(F.col("kind") == "macro", 1).otherwise(0)
    context = staged(context.withColumn("_n", F.row_number().over(of.orderBy(specific.desc(), F.col("population").desc(), F.col("place_id")))).withColumn("narrowest", F.col("_n") == 1).drop("_n"))
    targets = c.filter("role <> 'context'").withColumn("group", F.when(F.col("role") == "target", 0).otherwise(F.col("pos")))
    within = targets.alias("a").join(context.alias("b"), (F.col("a.seg") == F.col("b.seg")) & inside("a", "b")).groupBy("a.seg", "a.pos", "a.place_id").agg(F.max(F.when(F.col("b.narrowest") & F.col("b.any"), 2).otherwise(1)).alias("level"))
    leveled = targets.join(within, ["seg", "pos", "place_id"], "left").fillna(0, ["level"])
    leveled = leveled.withColumn("_most", F.max("level").over(Window.partitionBy("seg", "group"))).filter("level = _most and (role <> 'target' or level > 0)").withColumn("alone", F.col("role") == "alone").drop("_most", "level")
    picked = _ranked(leveled.dropDuplicates(["seg", "group", "place_id"]), ["seg", "group"]).select("seg", "place_id", "any")
    unmet = context.filter("narrowest and any").join(picked.select("seg").distinct(), "seg", "left_anti").select("seg", "place_id")
    found = picked.select("seg", "place_id").unionByName(unmet).distinct()
    out = cleaned.join(found, "seg", "left").filter(F.col("place_id").isNotNull() | ((F.col("geo") == "") & F.col("work_type").isNotNull()))
    return out.select("text", "language", "segment", "place_id", "work_type").distinct()


# --- country, city and region of a report -----------------------------------------------------------------------------

# Separators, words that are no places, marks of work modes, and region hints.
PARTS = r"\s*[,;/|•·()\[\]]\s*|\s+[-–—]\s+|\s+(?:or|and|&)\s+"
NOISE = r"(?i)\b(remote|hybrid|on-?site|in[- ]office|office|hq|headquarters|multiple locations|various locations|flexible|anywhere|work from home|wfh|greater|metropolitan|metro|area|region|based|first|only|full|time|country|countries|location|locations|optional|preferred|role)\b"
REMOTE = r"(?i)\b(remote|anywhere|work from home|wfh|home[- ]based|distributed|telecommute)\b"
HYBRID = r"(?i)\bhybrid\b"
ONSITE = r"(?i)\b(on-?site|in[- ]office|office[- ]based)\b"
WORLDWIDE = r"(?i)\b(worldwide|global(ly)?|anywhere in the world)\b"
#: A city of so many people counts against a state's hint; a name of several smaller cities is a guess without a country.
FAMOUS, KNOWN = 500_000, 100_000


def gazetteer(countries: DataFrame, divisions: DataFrame, cities: DataFrame, metros: DataFrame, hints: DataFrame) -> DataFrame:
    """One table of names, (key, kind, iso, admin, name, population, rank), from countries (iso2, iso3, name, region,
    aliases), divisions (iso2, code, name, rank, alone: whether the code counts in a text of its own), cities (name, iso2,
    admin, population, aliases), metros (name, iso2, city) and hints (name, region). Codes keep their case; of countries
    that share a name the least code counts, of divisions the least rank."""
    row = lambda key, kind, iso, admin=None, name=None, population=None, rank=None: [
        key.alias("key"), F.lit(kind).alias("kind"), iso.alias("iso"), (F.lit(None) if admin is None else admin).cast("string").alias("admin"), (F.lit(None) if name is None else name).cast("string").alias("name"),
        (F.lit(None) if population is None else population).cast("long").alias("population"), (F.lit(0) if rank is None else rank).cast("int").alias("rank"),
    ]
    iso = F.col("iso2")
    aliased = lambda *names: F.explode(F.array_distinct(F.filter(F.concat(F.array(*names), F.coalesce("aliases", F.expr("cast(array() as array<string>)"))), lambda x: F.coalesce(x, F.lit("")) != "")))
    named = countries.select("iso2", aliased(F.col("name"), F.col("iso3")).alias("n")).groupBy(F.lower("n").alias("n")).agg(F.min("iso2").alias("iso2"))
    first = lambda df, key: df.groupBy(key.alias("n")).agg(F.min_by(F.struct("iso2", "code", "rank", "alone"), F.struct("rank", "iso2", "code")).alias("d")).select("n", "d.*")
    towns = cities.select("iso2", "admin", "population", "name", aliased(F.col("name")).alias("n")).withColumn("n", F.lower("n")).distinct()
    us = F.when(iso == "US", F.col("code"))
    out = named.select(*row(F.col("n"), "country", iso)).unionByName(countries.select(*row(iso, "iso", iso)).distinct())
    out = out.unionByName(first(divisions.filter("code is not null"), F.col("code")).select(*row(F.col("n"), "state", iso, us, None, None, F.col("alone").cast("int"))))
    out = out.unionByName(first(divisions, F.lower("name")).select(*row(F.col("n"), "division", iso, us)))
    out = out.unionByName(towns.select(*row(F.col("n"), "city", iso, F.col("admin"), F.col("name"), F.col("population"))))
    out = out.unionByName(metros.select(*row(F.lower("name"), "metro", iso, None, F.col("city"))))
    return out.unionByName(hints.select(*row(F.lower("name"), "hint", F.lit(None).cast("string"), None, F.col("region"))))


def _city(parts: DataFrame, names: DataFrame, hints: DataFrame) -> DataFrame:
    """(text, city, city_iso): the first part that is a city which fits the country and state of hints (text, country,
    state, around)."""
    # Cities of one name, country and division fit alike: their number and the most populous of them stand for all.
    cities = names.filter("kind = 'city'").groupBy(F.col("key").alias("low"), "iso", "admin").agg(F.count("*").alias("many"), F.max(F.struct("population", "name", "iso")).alias("most"))
    c = parts.join(cities, "low").join(hints, "text")
    fits = F.when(F.col("around").isNull(), 2).when(F.col("iso") != F.col("around"), F.when(F.col("country").isNull(), 1).otherwise(0)).when((F.col("around") != "US") | F.col("state").isNull() | (F.col("admin") == F.col("state")), 4).otherwise(3)
    # Per part: those that fit best by population; a famous city elsewhere only if it is the largest of its name.
    g = c.withColumn("fits", fits).groupBy("text", "pos", "around").agg(F.sum("many").alias("n"), F.max("most").alias("top"), F.max(F.struct("fits", "most.population", "most.name", "most.iso")).alias("best"))
    famous = F.when(F.col("best.fits") == 1, F.when(F.col("top.population") >= FAMOUS, F.struct("top.name", "top.iso"))).when(F.col("best.fits") > 1, F.struct("best.name", "best.iso"))
    guess = F.col("around").isNull() & (F.col("n") > 1) & (F.col("best.population") < KNOWN)
    g = g.withColumn("city", F.when(~guess, famous)).filter("city is not null")
    return g.groupBy("text").agg(F.min_by("city", "pos").alias("c")).select("text", F.col("c.name").alias("city"), F.col("c.iso").alias("city_iso"))


def located(texts: DataFrame, names: DataFrame, countries: DataFrame) -> DataFrame:
    """(text, country, city, region, remote, hybrid, onsite, worldwide) of the distinct texts; names: a gazetteer().

    The metro furthest right decides alone. Else the country furthest right counts; codes and names of divisions left of
    no country give a country of their own, the one furthest left, and a US state; then cities, from the left, must fit.
    Names that match in several ways are, in this order, metro, country, division code, country code, division, hint."""
    t = texts.select("text").distinct().filter("text is not null")
    low = lambda c: F.lower(c)
    raw = t.select("text", F.posexplode(F.split(F.trim("text"), PARTS)).alias("pos", "p")).withColumn("p", F.regexp_replace("p", r"^[ .]+|[ .]+$", "")).filter("p <> ''")
    metros = names.filter("kind = 'metro'").select(F.col("key").alias("_k"), F.struct("iso", "name").alias("metro"))
    raw = raw.join(metros, low(F.col("p")) == F.col("_k"), "left").drop("_k")
    clean = F.regexp_replace(F.regexp_replace(F.regexp_replace(F.regexp_replace("p", NOISE, " "), r"^[ .-]+|[ .-]+$", ""), r"\s+", " "), r"(?i)^(?:in|within|from|across)\s+", "")
    parts = raw.withColumn("p", F.when(F.col("metro").isNotNull(), F.col("p")).otherwise(clean)).filter("p <> ''").withColumn("low", low(F.col("p")))
    parts = staged(parts.join(parts.groupBy("text").agg(F.count("*").alias("n")), "text"))
    of = lambda kind, name: names.filter(F.col("kind") == kind).select(F.col("key").alias("_k"), F.struct("iso", "admin", "name", "rank").alias(name))
    m = parts
    for kind, key in (("country", "low"), ("state", "p"), ("iso", "p"), ("division", "low"), ("hint", "low")):
        m = m.join(of(kind, kind), F.col(key) == F.col("_k"), "left").drop("_k")
    code = F.col("state").isNotNull() & ((F.col("n") > 1) | (F.col("state.rank") == 1))
    country = F.when(F.col("country").isNotNull() & ~((F.length("p") == 2) & (F.col("n") > 1) & F.coalesce(F.col("us_code"), F.lit(False))), F.col("country.iso"))
    us = names.filter("kind = 'state' and iso = 'US'").select(F.col("key").alias("_k"), F.lit(True).alias("us_code"))
    m = m.join(us, F.upper("p") == F.col("_k"), "left").drop("_k").withColumn("named", F.when(F.col("metro").isNull(), country)).withColumn("coded", F.col("named").isNull() & code & F.col("metro").isNull())
    m = m.withColumn("nation", F.coalesce("named", F.when(~F.col("coded") & F.col("metro").isNull(), F.col("iso.iso"))))
    m = m.withColumn("other", F.col("metro").isNull() & F.col("nation").isNull())
    at = F.max(F.when(F.col("nation").isNotNull(), F.col("pos"))).over(Window.partitionBy("text"))
    m = m.withColumn("upto", at).withColumn("free", F.col("other") & (F.col("upto").isNull() | (F.col("pos") > F.col("upto"))))
    divided = F.when(F.col("free"), F.when(F.col("coded"), F.col("state")).otherwise(F.col("division")))
    facts = m.withColumn("part_of", divided).groupBy("text").agg(
        F.max_by("nation", F.when(F.col("nation").isNotNull(), F.col("pos"))).alias("country"), F.max_by("metro", F.when(F.col("metro").isNotNull(), F.col("pos"))).alias("metro"),
        F.min_by("part_of.iso", F.when(F.col("part_of").isNotNull(), F.col("pos"))).alias("part"), F.min_by("part_of.admin", F.when(F.col("free") & F.col("coded") & F.col("part_of.admin").isNotNull(), F.col("pos"))).alias("by_code"),
        F.max_by("part_of.admin", F.when(F.col("free") & ~F.col("coded") & F.col("part_of.admin").isNotNull(), F.col("pos"))).alias("by_name"),
        F.max_by("hint.name", F.when(F.col("other") & ~F.col("coded") & F.col("part_of").isNull() & F.col("hint").isNotNull(), F.col("pos"))).alias("hint"),
    )
    facts = staged(facts.withColumns({"state": F.coalesce("by_code", "by_name"), "around": F.coalesce("country", "part")}))
    city = _city(parts.filter("metro is null").select("text", "pos", "low"), names, facts.select("text", "country", "state", "around"))
    regions = countries.groupBy(F.col("iso2").alias("country")).agg(F.min("region").alias("of_country"))
    j = t.join(facts, "text", "left").join(city, "text", "left")
    j = j.withColumns({"country": F.when(F.col("metro").isNotNull(), F.col("metro.iso")).otherwise(F.coalesce("country", "city_iso", "part")), "city": F.when(F.col("metro").isNotNull(), F.col("metro.name")).otherwise(F.col("city"))})
    j = j.join(regions, "country", "left").withColumn("region", F.when(F.col("country").isNotNull(), F.col("of_country")).otherwise(F.col("hint")))
    flag = lambda rx: F.col("text").rlike(rx)
    return j.select("text", "country", "city", "region", flag(REMOTE).alias("remote"), flag(HYBRID).alias("hybrid"), flag(ONSITE).alias("onsite"), flag(WORLDWIDE).alias("worldwide"))
