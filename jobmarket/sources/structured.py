"""Job postings in the structured data of pages: a walk over JSON of any shape as VARIANT."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmarket.sources.tables import staged

SCRIPT = r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script"


def _at(v: str | Column, path: str, kind: str = "string") -> Column:
    return F.try_variant_get(v, path, kind)


def _scalar(v: str | Column, path: str) -> Column:
    """The text under a path, null where an object or a list stands."""
    kind = F.schema_of_variant(_at(v, path, "variant"))
    return F.when(~kind.startswith("OBJECT") & ~kind.startswith("ARRAY"), _at(v, path))


def _text(c: Column) -> Column:
    """Entities of white space and & resolved, white space collapsed; null if nothing is left."""
    for entity, char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        c = F.replace(c, F.lit(entity), F.lit(char))
    return F.nullif(F.trim(F.regexp_replace(c, r"\s+", " ")), F.lit(""))


def _is(kind: str) -> Column:
    return F.schema_of_variant("v").startswith(kind)


def found_postings(pages: DataFrame, ident: str = "page_id", html: str = "html") -> DataFrame:
    """(ident, v): the first JobPosting of each page, in the order of the document, as a VARIANT.

    Blocks are objects, lists, or objects with a @graph; lists may hold all of these, to any depth: each round opens the
    lists and graphs that the round before has found, until none are left. An object is a posting if its @type is, or
    lists, a name with JobPosting in it; what stands inside a posting is not looked at. Blocks that are no JSON go."""
    blocks = pages.select(F.col(ident), F.posexplode(F.regexp_extract_all(html, F.lit(SCRIPT), F.lit(1))).alias("i", "block"))
    state = blocks.filter(F.col("block").contains("JobPosting")).select(ident, F.array(F.col("i")).alias("path"), F.try_parse_json("block").alias("v")).filter("v is not null")
    state, done = staged(state), []
    while not state.isEmpty():
        kind = F.coalesce(_at("v", "$['@type']"), F.to_json(_at("v", "$['@type']", "variant")))
        typed = state.withColumn("posting", _is("OBJECT") & F.coalesce(kind.contains("JobPosting"), F.lit(False)))
        done.append(typed.filter("posting").select(ident, "path", "v"))
        graph = _at("v", "$['@graph']", "variant")
        lists = typed.filter("not posting").withColumn("v", F.when(_is("ARRAY"), F.col("v")).when(_is("OBJECT"), graph)).filter(F.col("v").isNotNull() & _is("ARRAY"))
        items = lists.select(ident, "path", F.posexplode(_at("v", "$", "array<variant>")).alias("i", "v"))
        state = staged(items.filter("v is not null").select(ident, F.concat("path", F.array("i")).alias("path"), "v"))
    every = state.select(ident, "path", "v") if not done else done[0]
    for more in done[1:]:
        every = every.unionByName(more)
    # VARIANT has no order, so the first path is found alone and met again.
    every = staged(every)
    first = every.groupBy(ident).agg(F.min("path").alias("path"))
    return every.join(first, [ident, "path"]).select(ident, "v").dropDuplicates([ident])


def _listed(v: str | Column, path: str) -> Column:
    """What stands under a path, as a list: a list itself, else the value alone."""
    return F.coalesce(_at(v, path, "array<variant>"), F.array(_at(v, path, "variant")))


def job_postings(pages: DataFrame, ident: str = "page_id", html: str = "html") -> DataFrame:
    """Postings of pages that hold one: title, description, locations, company, employment_type, job_location_type,
    date_posted, valid_through, pay (min, max, currency, unit). Names of places are joined from town, region and country."""
    p = found_postings(pages, ident, html)
    part = lambda x, name: _text(F.coalesce(_scalar(x, f"$.address.{name}"), _scalar(x, f"$.address.{name}.name")))
    place = lambda x: F.coalesce(F.nullif(F.concat_ws(", ", part(x, "addressLocality"), part(x, "addressRegion"), part(x, "addressCountry")), F.lit("")), _text(_scalar(x, "$.address")), _text(_scalar(x, "$.name")))
    number = lambda path: _at("v", path, "double")
    low, high = F.coalesce(number("$.baseSalary.value.minValue"), number("$.baseSalary.value.value"), number("$.baseSalary.value")), F.coalesce(number("$.baseSalary.value.maxValue"), number("$.baseSalary.value.value"), number("$.baseSalary.value"))
    pay = F.struct(low.alias("min"), high.alias("max"), F.coalesce(_at("v", "$.baseSalary.currency"), _at("v", "$.salaryCurrency")).alias("currency"), F.lower(_at("v", "$.baseSalary.value.unitText")).alias("unit"))
    return p.select(
        ident, F.coalesce(_text(_at("v", "$.title")), _text(_at("v", "$.name"))).alias("title"), _at("v", "$.description").alias("description"),
        F.array_distinct(F.filter(F.transform(_listed("v", "$.jobLocation"), place), lambda x: x.isNotNull())).alias("locations"), _text(F.coalesce(_scalar("v", "$.hiringOrganization.name"), _scalar("v", "$.hiringOrganization"))).alias("company"),
        F.array_join(F.transform(_listed("v", "$.employmentType"), lambda x: _at(x, "$")), ", ").alias("employment_type"), _at("v", "$.jobLocationType").alias("job_location_type"), _at("v", "$.datePosted").alias("date_posted"),
        _at("v", "$.validThrough").alias("valid_through"), F.when(low.isNotNull() | high.isNotNull(), pay).alias("pay"),
    )
