"""Raw payloads as postings (S5, S8-S10, S19, X1). A provider is a function (DataFrame, payload column) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

POSTING = ("url", "title", "description", "locations", "employment_type", "job_location_type", "date_posted", "language", "source_identity")


def _posting(df: DataFrame, **columns: Column) -> DataFrame:
    """The named columns in the posting layout; others null; rows without a url are dropped."""
    empty = lambda c: F.lit(None).cast("array<string>" if c == "locations" else "string")
    out = df.select("*", *[columns.get(c, empty(c)).alias(c) for c in POSTING if c not in df.columns])
    return out.filter(F.coalesce(F.col("url"), F.lit("")) != "")


def _list(*items: Column) -> Column:
    return F.array_distinct(F.filter(F.array(*items), lambda x: x.isNotNull() & (F.trim(x) != "")))


def greenhouse(df: DataFrame, payload: str) -> DataFrame:
    p = F.from_json(payload, "id long, absolute_url string, title string, content string, updated_at string, language string, location struct<name:string>, offices array<struct<name:string>>, metadata array<struct<name:string,value:string>>")
    df = df.withColumn("_p", p)
    places = F.array_distinct(F.filter(F.concat(F.array("_p.location.name"), F.coalesce("_p.offices.name", F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != "")))
    return _posting(df, url=F.col("_p.absolute_url"), title=F.trim("_p.title"), description=F.col("_p.content"), locations=places, date_posted=F.col("_p.updated_at"), language=F.col("_p.language"), source_identity=F.col("_p.id").cast("string")).drop("_p")


def ashby(df: DataFrame, payload: str) -> DataFrame:
    df = df.withColumn("_p", F.from_json(payload, "id string, jobUrl string, title string, descriptionHtml string, location string, secondaryLocations array<struct<location:string>>, employmentType string, isRemote boolean, publishedAt string"))
    places = F.array_distinct(F.filter(F.concat(F.array("_p.location"), F.coalesce("_p.secondaryLocations.location", F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != "")))
    return _posting(df, url=F.col("_p.jobUrl"), title=F.trim("_p.title"), description=F.col("_p.descriptionHtml"), locations=places, employment_type=F.col("_p.employmentType"), job_location_type=F.when(F.col("_p.isRemote"), "remote"), date_posted=F.col("_p.publishedAt"), source_identity=F.col("_p.id")).drop("_p")


def lever(df: DataFrame, payload: str) -> DataFrame:
    df = df.withColumn("_p", F.from_json(payload, "id string, hostedUrl string, text string, description string, createdAt long, workplaceType string, categories struct<location:string,commitment:string,allLocations:array<string>>"))
    places = F.coalesce(F.nullif("_p.categories.allLocations", F.array().cast("array<string>")), _list(F.col("_p.categories.location")))
    return _posting(df, url=F.col("_p.hostedUrl"), title=F.trim("_p.text"), description=F.col("_p.description"), locations=places, employment_type=F.col("_p.categories.commitment"), job_location_type=F.col("_p.workplaceType"), date_posted=F.date_format(F.timestamp_millis("_p.createdAt"), "yyyy-MM-dd'T'HH:mm:ss'Z'"), source_identity=F.col("_p.id")).drop("_p")


def recruitee(df: DataFrame, payload: str) -> DataFrame:
    df = df.withColumn("_p", F.from_json(payload, "id long, careers_url string, title string, description string, requirements string, city string, country string, remote boolean, hybrid boolean, employment_type_code string, published_at string, locations array<struct<city:string,country:string>>"))
    place = lambda city, country: F.nullif(F.concat_ws(", ", city, country), F.lit(""))
    many = F.transform("_p.locations", lambda x: place(x["city"], x["country"]))
    mode = F.when(F.col("_p.hybrid"), "hybrid").when(F.col("_p.remote"), "remote")
    return _posting(df, url=F.col("_p.careers_url"), title=F.trim("_p.title"), description=F.concat_ws("\n", "_p.description", "_p.requirements"), locations=F.coalesce(many, _list(place(F.col("_p.city"), F.col("_p.country")))), employment_type=F.col("_p.employment_type_code"), job_location_type=mode, date_posted=F.col("_p.published_at"), source_identity=F.col("_p.id").cast("string")).drop("_p")


#: Registered providers; users add their own.
PROVIDERS: dict[str, Callable[[DataFrame, str], DataFrame]] = {"greenhouse": greenhouse, "ashby": ashby, "lever": lever, "recruitee": recruitee}


def search_results(df: DataFrame, payload: str, base: str, site: str, keep: list[str]) -> DataFrame:
    """Search results with nested postings: url from base, site and path; the first bullet is the requisition id."""
    p = F.from_json(payload, "jobPostings array<struct<externalPath:string,title:string,locationsText:string,postedOn:string,bulletFields:array<string>>>")
    rows = df.select(*keep, F.explode(p["jobPostings"]).alias("j"))
    return rows.filter("j.externalPath is not null").select(*keep, F.concat(F.lit(f"{base}/{site}"), "j.externalPath").alias("url"), "j.title", F.col("j.locationsText").alias("location"), F.col("j.postedOn").alias("date_posted"), F.get("j.bulletFields", F.lit(0)).alias("requisition_id"))


def page_postings(pages: DataFrame) -> DataFrame:
    """Pages as postings: the first JobPosting among the page's JSON-LD blocks (object, list or @graph), else the title."""
    schema = "title string, description string, datePosted string, employmentType string, url string"
    blocks = F.regexp_extract_all("html", F.lit(r"(?is)<script[^>]*application/ld\+json[^>]*>(.*?)</script"), F.lit(1))
    typed = F.filter(blocks, lambda b: b.contains("JobPosting"))
    flat = F.transform(typed, lambda b: F.coalesce(F.get_json_object(b, "$.@graph[0]"), F.get_json_object(b, "$[0]"), b))
    p = pages.withColumn("_p", F.from_json(F.get(flat, F.lit(0)), schema))
    title = F.trim(F.regexp_replace(F.regexp_extract("html", r"(?is)<title[^>]*>(.*?)</title", 1), r"\s+", " "))
    return p.select(*[c for c in pages.columns if c not in ("html", "url")], F.coalesce("_p.url", "url").alias("url"), F.coalesce("_p.title", title).alias("title"), F.col("_p.description").alias("description"), F.col("_p.datePosted").alias("date_posted"), F.col("_p.employmentType").alias("employment_type"))


def mapped(df: DataFrame, column: str, spec: dict[str, dict]) -> DataFrame:
    """Declarative mapping of a JSON column. Per output column: path (or paths to concatenate with sep), type, constant,
    values (a map of values), default. A concatenation of constants only is null."""
    out = {}
    for name, s in spec.items():
        if "constant" in s:
            c = F.lit(s["constant"])
        elif "paths" in s:
            parts = [F.get_json_object(column, p) if p.startswith("$") else F.lit(p) for p in s["paths"]]
            found = [x for x, p in zip(parts, s["paths"], strict=True) if p.startswith("$")]
            c = F.when(F.coalesce(*found).isNotNull(), F.concat_ws(s.get("sep", ""), *parts))
        else:
            c = F.get_json_object(column, s["path"])
        if "values" in s:
            c = F.coalesce(F.create_map(*[F.lit(x) for kv in s["values"].items() for x in kv])[c], c)
        if "default" in s:
            c = F.coalesce(c, F.lit(s["default"]))
        out[name] = c.try_cast(s["type"]) if "type" in s else c
    return df.withColumns(out)
