"""Rules over dimension tables, declared as data, and the rows that break them."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The forms of slugs, URLs and numbers.
SLUG, URL, DIGITS = r"\A[a-z0-9][a-z0-9-]*[a-z0-9]\z", r"(?i)\Ahttps?://[^/?#]+", r"\A[0-9]+\z"


@dataclass(frozen=True)
class Rules:
    """What the columns of one table must hold. Columns of required must not be blank; the others may be, except slug
    and url. one_of: column -> allowed values; references: column -> (table, column) where the value must stand."""

    unique: tuple[str, ...] = ()
    required: tuple[str, ...] = ()
    slug: tuple[str, ...] = ()
    url: tuple[str, ...] = ()
    optional_url: tuple[str, ...] = ()
    digits: tuple[str, ...] = ()
    json_object: tuple[str, ...] = ()
    one_of: dict[str, tuple[str, ...]] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)


def _text(column: str) -> Column:
    """The value as text; null is blank."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def _row_rules(r: Rules) -> list[tuple[str, str, Column]]:
    """(column, rule, broken): rules that one row alone decides."""
    blank = lambda c: F.trim(_text(c)) == ""
    kind = lambda c: F.coalesce(F.schema_of_variant(F.try_parse_json(_text(c))), F.lit(""))
    out = [(c, "required", blank(c)) for c in r.required]
    out += [(c, "slug", ~_text(c).rlike(SLUG)) for c in r.slug]
    out += [(c, "url", ~_text(c).rlike(URL)) for c in r.url]
    out += [(c, "url", ~blank(c) & ~_text(c).rlike(URL)) for c in r.optional_url]
    out += [(c, "digits", ~blank(c) & ~_text(c).rlike(DIGITS)) for c in r.digits]
    out += [(c, "json_object", ~blank(c) & ~kind(c).startswith("OBJECT")) for c in r.json_object]
    return out + [(c, "one_of", ~_text(c).isin(*v)) for c, v in r.one_of.items()]


def violations(tables: dict[str, DataFrame], rules: dict[str, Rules]) -> DataFrame:
    """(dimension, field, rule, value, n): every value that breaks a rule, and in how many rows.

    All rules of single rows take one pass over a table; unique and references take one aggregate by value each, so a
    value in many rows is counted before it moves. Values compare trimmed for unique, as they are elsewhere; blank
    references are not looked up, and null counts as blank. No rules, or tables without rows, give an empty table."""
    spark = next(iter(tables.values())).sparkSession
    out = spark.createDataFrame([], "dimension string, field string, rule string, value string, n long")
    tag = lambda df, t, c, r: df.select(F.lit(t).alias("dimension"), F.lit(c).alias("field"), F.lit(r).alias("rule"), "value", "n")
    for name, r in rules.items():
        df, single = tables[name], _row_rules(r)
        if single:
            broken = [F.when(bad, F.struct(F.lit(c).alias("field"), F.lit(rule).alias("rule"), _text(c).alias("value"))) for c, rule, bad in single]
            found = df.select(F.explode(F.array_compact(F.array(*broken))).alias("v")).groupBy("v").agg(F.count("*").alias("n"))
            out = out.unionByName(found.select(F.lit(name).alias("dimension"), "v.*", "n"))
        for c in r.unique:
            out = out.unionByName(tag(df.groupBy(F.trim(_text(c)).alias("value")).agg(F.count("*").alias("n")).filter("n > 1"), name, c, "unique"))
        for c, (other, key) in r.references.items():
            values = df.select(_text(c).alias("value")).filter("value != ''").groupBy("value").agg(F.count("*").alias("n"))
            known = tables[other].select(F.trim(_text(key)).alias("value")).distinct()
            out = out.unionByName(tag(values.join(known, "value", "left_anti"), name, c, "reference"))
    return out
