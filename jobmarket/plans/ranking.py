"""Text search ranked by cover density, over positions of stemmed words."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Suffix rules of the stemmer, in order; each leaves a stem of three letters at least. The first that fits is applied.
SUFFIXES = (("ational", "ate"), ("izations", "ize"), ("ization", "ize"), ("fulness", "ful"), ("iveness", "ive"), ("ments", ""), ("ment", ""), ("nesses", ""), ("ness", ""), ("sses", "ss"), ("ies", "y"), ("ings", ""), ("ing", ""), ("edly", ""), ("ed", ""), ("ers", ""), ("er", ""), ("ly", ""), ("s", ""))
KEPT = ("ss", "us", "is")


def stem(word: Column) -> Column:
    """A lower-case word without its suffix; words on ss, us and is stay."""
    out = word
    for suffix, instead in reversed(SUFFIXES):
        fits = word.endswith(suffix) & (F.length(word) >= len(suffix) + 3)
        if suffix == "s":
            fits = fits & ~reduce(lambda a, b: a | b, [word.endswith(k) for k in KEPT])
        out = F.when(fits, F.concat(F.substring(word, F.lit(1), F.length(word) - len(suffix)), F.lit(instead))).otherwise(out)
    return out


def stemmed(word: str) -> str:
    """As stem, of a query's word."""
    for suffix, instead in SUFFIXES:
        if word.endswith(suffix) and len(word) >= len(suffix) + 3 and not (suffix == "s" and word.endswith(KEPT)):
            return word[: -len(suffix)] + instead
    return word


def words(text: Column) -> Column:
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"[\p{L}\p{N}]+"), F.lit(0))


def parsed(query: str) -> tuple[list[list[tuple[str, ...]]], list[tuple[str, ...]]]:
    """(wanted groups of alternatives, unwanted ones) of a web search query; an alternative is a tuple of stems that follow
    each other: one word, or a phrase in quotes. OR joins alternatives, - marks unwanted ones."""
    wanted: list[list[tuple[str, ...]]] = []
    unwanted, joins = [], False
    for minus, phrase, word in re.findall(r'(-?)(?:"([^"]*)"|([^\s"]+))', query):
        if word == "OR" and not minus:
            joins = bool(wanted)
            continue
        terms = tuple(stemmed(w) for w in re.findall(r"[^\W_]+", (phrase or word).lower()))
        if not terms:
            continue
        if minus:
            unwanted.append(terms)
        elif joins:
            wanted[-1].append(terms)
        else:
            wanted.append([terms])
        joins = False
    return wanted, unwanted


def hits(df: DataFrame, ident: str, query: str, fields: list[tuple[str, float]]) -> DataFrame:
    """(id, pos, term, weight): where the words of a query stand. Positions run through all fields; term is the number of
    the wanted group, or -1 for an unwanted word; a phrase stands where its first word stands and never crosses fields."""
    wanted, unwanted = parsed(query)
    alternatives = [(i, a) for i, g in enumerate(wanted) for a in g] + [(-1, a) for a in unwanted]
    longest = max([len(a) for _, a in alternatives], default=1)
    # A stem shares its first three letters with its word, so only words that begin like a query's stem are stemmed, and
    # only places where an alternative may begin become rows.
    begin = sorted({t[:3] for _, a in alternatives for t in a})
    leading = sorted({a[0] for _, a in alternatives})
    near = lambda w: F.when(F.substring(w, 1, 3).isin(begin), stem(w))
    start, tokens = F.lit(0), []
    for name, weight in fields:
        stems = F.transform(words(F.col(f"`{name}`")), near)
        # A word with those after it: the field beside itself, moved by one word and more.
        beside = F.arrays_zip(*[(F.slice(stems, k + 1, F.greatest(F.size(stems), F.lit(1))) if k else stems).alias(f"w{k}") for k in range(longest)])
        placed = F.transform(beside, (lambda b, n: lambda x, i: F.struct((b + i).alias("pos"), F.array(*[x[f"w{k}"] for k in range(longest)]).alias("run"), F.lit(n).alias("weight")))(start, float(weight)))
        tokens.append(F.filter(placed, lambda x: F.coalesce(F.get(x["run"], F.lit(0)).isin(leading), F.lit(False))))
        start = start + F.size(stems)
    each = df.select(F.col(f"`{ident}`").alias("id"), F.explode(F.concat(*tokens)).alias("t")).select("id", "t.*")
    here = lambda a: reduce(lambda x, y: x & y, [F.coalesce(F.get("run", F.lit(k)) == w, F.lit(False)) for k, w in enumerate(a)])
    terms = F.array_compact(F.array(*[F.when(reduce(lambda x, y: x | y, [here(a) for j, a in alternatives if j == i]), F.lit(i)) for i in sorted({j for j, _ in alternatives})]))
    return each.withColumn("terms", terms).filter(F.size("terms") > 0).select("id", "pos", "weight", F.explode("terms").alias("term"))


def ranked(df: DataFrame, ident: str, query: str, fields: list[tuple[str, float]]) -> DataFrame:
    """(id, rank) of the rows that hold all wanted groups of a query and no unwanted word; a query without wanted words
    gives rank 0 to every row that holds no unwanted one.

    A cover is a shortest stretch of positions that holds all groups. It adds the harmonic mean of its hits' weights,
    divided by one more than the words in it that are no hits. Covers come from one window over a row's hits: the last
    place of each group so far, of which the earliest is where a cover that ends here begins; it is shortest if no cover
    before began there."""
    wanted, unwanted = parsed(query)
    ids = df.select(F.col(f"`{ident}`").alias("id"))
    if not wanted and not unwanted:
        return ids.withColumn("rank", F.lit(0.0))
    h = hits(df, ident, query, fields)
    bad = h.filter("term = -1").select("id").distinct()
    if not wanted:
        return ids.join(bad, "id", "left_anti").withColumn("rank", F.lit(0.0))
    # A position counts once, whatever the number of groups that it belongs to.
    spot = h.filter("term >= 0").groupBy("id", "pos", "weight").agg(F.collect_set("term").alias("terms"))
    so_far = Window.partitionBy("id").orderBy("pos")
    spot = spot.withColumns({"nr": F.row_number().over(so_far), "inverse": F.sum(1 / F.col("weight")).over(so_far)})
    spot = spot.withColumn("here", F.struct("pos", "nr", (F.col("inverse") - 1 / F.col("weight")).alias("before")))
    last = [F.max(F.when(F.array_contains("terms", i), F.col("here"))).over(so_far) for i in range(len(wanted))]
    spot = spot.withColumn("last", F.array(*last)).filter(~F.exists("last", lambda x: x.isNull())).withColumn("begin", F.array_min("last"))
    spot = spot.withColumn("known", F.lag("begin.pos").over(so_far)).filter(F.col("known").isNull() | (F.col("begin.pos") > F.col("known")))
    n = F.col("nr") - F.col("begin.nr") + 1
    gaps = F.col("pos") - F.col("begin.pos") + 1 - n
    value = n / (F.col("inverse") - F.col("begin.before")) / (1 + gaps)
    return spot.groupBy("id").agg(F.sum(value).alias("rank")).join(bad, "id", "left_anti")
