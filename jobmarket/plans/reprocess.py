"""Stored texts read again by a new extractor, and the table updated where it now finds more."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmarket.sources.tables import staged


def changes(postings: DataFrame, texts: DataFrame, extract: Callable[[str], Column], order: Column, column: str = "value", suspect: Column | None = None, wanted: Column | None = None, limit: int | None = None) -> DataFrame:
    """(id, old, new): active postings whose stored texts now give another value than the one that they hold.

    postings: (id, active, column and others); texts: (id, locale, updated_at, text). suspect: rows of postings to look
    at; wanted: rows of texts to look at (both all, if not given). extract makes the value of a column of texts, once a
    distinct text. Of a posting's values the one with the greatest order counts, ties go to English, then the latest
    text, then the greater value. Where no text gives a value the posting stays as it is. limit: the changes with the
    least ids, for runs in stages. Blank texts and rows with a null id are not read."""
    own = postings.filter(F.col("active") & F.col("id").isNotNull())
    own = (own.filter(suspect) if suspect is not None else own).select("id", F.col(column).alias("old"))
    read = texts.filter("id is not null and trim(text) != ''")
    read = (read.filter(wanted) if wanted is not None else read).join(own.select("id"), "id", "left_semi")
    # The text moves once, to its distinct value, and only the value comes back.
    values = read.select("text").distinct().withColumn("new", extract("text"))
    found = read.join(values, "text").filter("new is not null")
    best = F.struct(order.alias("o"), F.when(F.col("locale") == "en", 1).otherwise(0).alias("en"), F.col("updated_at"), "new")
    best = found.groupBy("id").agg(F.max_by("new", best).alias("new"))
    out = own.join(best, "id").filter(~F.col("old").eqNullSafe(F.col("new"))).select("id", "old", "new")
    return out.orderBy("id").limit(limit) if limit else out


def reprocess(postings: DataFrame, found: DataFrame, now: Column, column: str = "value", dry_run: bool = False) -> tuple[DataFrame, DataFrame]:
    """(postings with the new values, summary of one row: changed, updated).

    found: the rows of changes(). A row changes only if it still holds the value that was compared, so what another
    writer has set meanwhile stays; changed rows get now as updated_at. A dry run returns the postings as they are and
    counts all the same."""
    found = staged(found)
    if dry_run:
        return postings, found.agg(F.count("*").alias("changed"), F.lit(0).cast("long").alias("updated"))
    new = found.select(F.col("id").alias("_id"), F.col("old").alias("_old"), F.col("new").alias("_new"))
    joined = postings.join(new, (postings["id"] == F.col("_id")) & postings[column].eqNullSafe(F.col("_old")), "left")
    hit = F.col("_id").isNotNull()
    out = joined.withColumns({column: F.when(hit, F.col("_new")).otherwise(F.col(column)), "updated_at": F.when(hit, now).otherwise(F.col("updated_at"))}).drop("_id", "_old", "_new")
    # Ids of postings are unique, so a change meets one row at most.
    held = postings.select("id", F.col(column).alias("_held"), F.lit(True).alias("_met"))
    counts = found.join(held, (found["id"] == held["id"]) & found["old"].eqNullSafe(held["_held"]), "left").agg(F.count("*").alias("changed"), F.count("_met").alias("updated"))
    return out, counts
