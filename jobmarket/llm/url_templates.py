"""URL filters: explicit rules, and for all other URLs a tree of path templates per host, with DataFrame functions only.

Rules have a host, a path and a verdict; a rule fits its host and all subdomains where the path starts with the rule's.
Distinct hosts meet the rules by an equi-join on their suffixes, which tells the lengths of rule paths that matter to a
host; URLs then meet rules by an equi-join on (suffix, start of the path), and the longest host, then path, wins.

URLs that a rule judges are the labels from which the rest is judged:

1. URLs are counted by (host, path) first, so copies cost nothing further. The tree is grown a level at a time, all hosts
   at once, up to DEPTH segments (the remainder is one more wildcard).
2. Variable segments become wildcards: those with digits by their form (`<num>`, `<num>.html`, `<hex>`, `<mix>`), and words
   that are each rare among many siblings (`<word>`).
3. The other siblings are described by cells (form of the next segment, label), at most CELLS of them. Siblings with the
   same most frequent cell, with about the same share (quarters), are pooled, each is tested against its pool by chi-square, and those that do not differ merge
   into one branch. No pairs of siblings are made.
4. Purity of a template is the smoothed blocked share of its labelled URLs; the prior is the host's share, in which
   unlabelled URLs count one half. Templates at or above REJECT are blocked.

Each level is a sum over (host, template, segment), pre-aggregated before the shuffle, and one table that is written.

Defined results: a null URL or one without :// has an empty host and path, fits no rule and is a template of its own;
rows that share an id or a URL are judged each; hosts keep ports and user names; other columns are ignored; an empty
table gives no row; without rules or labels nothing is blocked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import keys_of, result, scratch, table, written

#: The rules of the query, (host, path, verdict).
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
DEPTH = 8
#: A word is variable where its parent has more than MANY children and the word less than RARE of its URLs.
MANY, RARE = 12, 0.05
#: Weight of the prior, and the purity from which a template is rejected.
WEIGHT, REJECT = 4.0, 0.8
#: Standard deviations of the chi-square test that tells branches apart.
DEVIATIONS = 2.33


def parsed(pages: DataFrame, url: str = "url") -> DataFrame:
    """(page_id, host, path)."""
    u = F.col(f"`{url}`")
    rest = F.when(u.contains("://"), F.substring_index(F.substring(u, F.instr(u, "://") + 3, F.length(u)), "#", 1))
    rest = F.coalesce(F.substring_index(rest, "?", 1), F.lit(""))
    end = F.locate("/", rest)
    host = F.when(end > 0, F.substring(rest, F.lit(1), end - 1)).otherwise(rest)
    lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return pages.select("page_id", lower.alias("host"), F.when(end > 0, F.substring(rest, end, F.length(rest))).otherwise("").alias("path"))


def rules_of(spark: SparkSession, rules: tuple[tuple[str, str, str], ...] = RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, verdict string")


def suffixes(host: Column) -> Column:
    """A host and its parent domains."""
    labels = F.split(host, "\\.")
    n = F.size(labels)
    return F.transform(F.sequence(F.lit(1), n), lambda i: F.array_join(F.slice(labels, i, n), "."))


def ruled(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, path, rule, verdict) of the distinct (host, path) rows that a rule fits; among equal rules block wins."""
    rules = rules.select(F.col("host").alias("suffix"), F.col("path").alias("start"), F.struct(F.col("verdict") == "block", F.concat("host", "path").alias("rule"), "verdict").alias("own"))
    rules = rules.groupBy("suffix", "start").agg(F.max("own").alias("own"))
    lengths = rules.select("suffix", F.length("start").alias("length")).distinct()
    hosts = urls.select("host").distinct().filter("host <> ''").withColumn("suffix", F.explode(suffixes(F.col("host"))))
    shapes = hosts.join(lengths, "suffix")
    tried = urls.join(shapes, "host").withColumn("start", F.substring(F.col("path"), F.lit(1), F.col("length")))
    found = tried.join(rules, ["suffix", "start"])
    best = F.max(F.struct(F.length("suffix"), F.length("start"), "own")).alias("best")
    return found.groupBy("host", "path").agg(best).select("host", "path", "best.own.rule", "best.own.verdict")


def form(segment: Column) -> Column:
    """The form of a variable segment; null for a word and for no segment."""
    dot = F.regexp_extract(segment, r"\.([A-Za-z]{1,5})$", 1)
    stem = F.when(dot != "", F.substring(segment, F.lit(1), F.length(segment) - F.length(dot) - 1)).otherwise(segment)
    kind = F.when(stem.rlike(r"^[0-9]+$"), "<num>").when(stem.rlike(r"^(?=.*[0-9])[0-9A-Fa-f-]{8,}$"), "<hex>").when(stem.rlike(r"[0-9]"), "<mix>")
    return F.when(F.length(dot) > 0, F.concat(kind, F.lit("."), F.lower(dot))).otherwise(kind)


def cell(segments: Column, at: int) -> Column:
    """What follows a segment, in a few forms, with the label of the URL."""
    after = F.get(segments, F.lit(at))
    kind = F.when(after.isNull(), "end").when(after == "", "/").otherwise(F.coalesce(F.substring_index(form(after), ".", 1), F.lit("word")))
    return F.concat_ws(":", kind, F.coalesce("verdict", F.lit("none")))


#: Forms times labels.
CELLS = 6 * 3


def merged(counts: DataFrame) -> DataFrame:
    """(host, prefix, segment, name): what each segment is called; counts: (host, prefix, segment, cell, n)."""
    branch = counts.groupBy("host", "prefix", "segment").agg(F.sum("n").alias("n"), F.concat_ws("*", F.max_by("cell", F.struct("n", "cell")), F.round(4 * F.max("n") / F.sum("n")).cast("int")).alias("most"), F.collect_list(F.struct("cell", "n")).alias("cells"))
    parent = branch.groupBy("host", "prefix").agg(F.count("*").alias("children"), F.sum("n").alias("of"))
    b = written(branch.join(parent, ["host", "prefix"]), "branches")
    typed = form(F.col("segment"))
    word = (F.col("children") > MANY) & (F.col("n") < RARE * F.col("of"))
    b = b.withColumn("wild", F.when(F.col("segment") == "", "").otherwise(F.coalesce(typed, F.when(word, "<word>"))))
    literal = b.filter(F.col("wild").isNull()).drop("wild")
    # The pool of siblings with one most frequent cell and its share, as a map of at most CELLS counts.
    each = literal.select("host", "prefix", "most", "segment", F.explode("cells").alias("c"))
    pool = each.groupBy("host", "prefix", "most", "c.cell").agg(F.sum("c.n").alias("n"))
    pool = pool.groupBy("host", "prefix", "most").agg(F.map_from_entries(F.collect_list(F.struct("cell", "n"))).alias("pool"), F.sum("n").alias("pooled"))
    tested = literal.join(pool, ["host", "prefix", "most"])
    own = F.map_from_entries("cells")

    def term(name: Column, total: Column) -> Column:
        due = total * F.col("n") / F.col("pooled")
        return F.pow(F.coalesce(F.element_at(own, name), F.lit(0)) - due, F.lit(2)) / due

    chi = F.aggregate(F.map_entries("pool"), F.lit(0.0), lambda acc, x: acc + term(x["key"], x["value"].cast("double")))
    free = F.greatest(F.size("pool") - 1, F.lit(1)).cast("double")
    # The quantile of chi-square by Wilson and Hilferty.
    limit = free * F.pow(1 - 2 / (9 * free) + DEVIATIONS * F.sqrt(2 / (9 * free)), F.lit(3))
    alike = (chi <= limit) & (F.col("n") < F.col("pooled"))
    named = tested.select("host", "prefix", "segment", F.when(alike, F.concat(F.lit("<like "), "most", F.lit(">"))).otherwise(F.col("segment")).alias("name"))
    return b.filter(F.col("wild").isNotNull()).select("host", "prefix", "segment", F.col("wild").alias("name")).unionByName(named)


def templates(urls: DataFrame, depth: int = DEPTH) -> DataFrame:
    """Adds template to (host, path, verdict, n), n the number of URLs; a level of all trees at a time."""
    segments = F.when(F.col("path") == "", F.array().cast("array<string>")).otherwise(F.split(F.substring("path", 2, 1 << 30), "/"))
    state = written(urls.withColumns({"segments": segments, "prefix": F.lit("")}), "paths")
    deepest = min(depth, state.agg(F.max(F.size("segments")).alias("n")).first()["n"] or 0)
    done = [state.filter(F.size("segments") == 0)]
    for level in range(deepest):
        open_ = state.filter(F.size("segments") > level).withColumn("segment", F.get("segments", F.lit(level)))
        counts = open_.groupBy("host", "prefix", "segment", cell(F.col("segments"), level + 1).alias("cell")).agg(F.sum("n").alias("n"))
        state = written(open_.join(merged(counts), ["host", "prefix", "segment"]).withColumn("prefix", F.concat_ws("/", "prefix", "name")).drop("segment", "name"), "level")
        done.append(state.filter(F.size("segments") == level + 1))
    done.append(state.filter(F.size("segments") > deepest).withColumn("prefix", F.concat("prefix", F.lit("/**"))))
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.drop("segments").withColumnRenamed("prefix", "template")


def purities(urls: DataFrame, weight: float = WEIGHT) -> DataFrame:
    """(host, template, labelled, purity) from (host, template, verdict, n)."""
    blocked, labelled = F.sum(F.when(F.col("verdict") == "block", F.col("n")).otherwise(0)), F.sum(F.when(F.col("verdict").isNotNull(), F.col("n")).otherwise(0))
    t = urls.groupBy("host", "template").agg(F.sum("n").alias("n"), blocked.alias("blocked"), labelled.alias("labelled"))
    hosts = t.groupBy("host").agg(((F.sum("blocked") + 0.5 * (F.sum("n") - F.sum("labelled") + weight)) / (F.sum("n") + weight)).alias("prior"))
    return t.join(hosts, "host").select("host", "template", "labelled", ((F.col("blocked") + weight * F.col("prior")) / (F.col("labelled") + weight)).alias("purity"))


def judged(pages: DataFrame, rules: DataFrame, reject: float = REJECT) -> DataFrame:
    """(page_id, host, path, rule, verdict, template, labelled, purity) of every page."""
    with scratch(pages.sparkSession):
        p = written(parsed(pages), "urls")
        counted = written(p.groupBy("host", "path").agg(F.count("*").alias("n")), "distinct-urls")
        labelled = written(counted.join(ruled(counted.select("host", "path"), rules), ["host", "path"], "left"), "ruled")
        tree = written(templates(labelled), "templates")
        known = tree.join(purities(tree), ["host", "template"])
        verdict = F.coalesce("verdict", F.when(F.col("purity") >= reject, "block").otherwise("allow"))
        urls = written(known.select("host", "path", "rule", verdict.alias("verdict"), "template", "labelled", "purity"), "judged-urls")
        return result(p.join(keys_of(urls, 50_000), ["host", "path"]).select("page_id", "host", "path", "rule", "verdict", "template", "labelled", "purity"), "judged")


def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The verdict on every page's URL, by the rules of the query and the templates learned from them."""
    return judged(table(spark, sf_dir, "pages"), rules_of(spark))

