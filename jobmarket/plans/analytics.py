"""Search, paging, sampling, matching and analytics over posting tables."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from jobmarket.functions import text as T

MIN_CANDIDATES, MAX_CANDIDATES, PER_SAMPLE = 10_000, 50_000, 250


def filtered(df: DataFrame, members: dict[str, list | None], status: str = "any") -> DataFrame:
    """Membership filters; None or an empty list does not filter, status 'any' neither."""
    for column, values in members.items():
        if values:
            df = df.filter(F.col(column).isin(*values))
    return df if status == "any" else df.filter(F.col("status") == status)


def scrub(df: DataFrame, unwanted: Column, day: str = "day") -> tuple[DataFrame, DataFrame]:
    """(rows that stay, kept and dropped per day)."""
    bad = F.coalesce(unwanted, F.lit(False))
    return df.filter(~bad), df.groupBy(day).agg(F.count_if(~bad).alias("kept"), F.count_if(bad).alias("dropped"))


def url_filter(df: DataFrame, include: str | None = None, exclude: str | None = None, column: str = "url", strict: bool = False) -> DataFrame:
    """Include and exclude patterns; strict: a row that matches both or neither is an error."""
    text = F.coalesce(F.col(column), F.lit(""))
    inc, exc = text.rlike(include) if include else F.lit(True), text.rlike(exclude) if exclude else F.lit(False)
    if strict:
        df = df.filter(F.when(inc == exc, F.raise_error(F.concat(F.lit("row matches not exactly one side: "), text)).cast("boolean")).otherwise(True))
    return df.filter(inc & ~exc)


def allowed(df: DataFrame, pattern: str, column: str = "url") -> DataFrame:
    """Rows whose whole value matches; a pattern that does not compile allows nothing."""
    import re

    try:
        re.compile(pattern)
    except re.error:
        return df.limit(0)
    return df.filter(F.col(column).rlike(f"^(?:{pattern})$"))


def merged_fields(df: DataFrame, second: DataFrame, key: str, fields: list[str], defaults: dict[str, str]) -> DataFrame:
    """Fields from a second source where null, then constants."""
    s = second.select(key, *[F.col(f).alias(f"_{f}") for f in fields])
    df = df.join(s, key, "left").withColumns({f: F.coalesce(f, f"_{f}") for f in fields}).drop(*[f"_{f}" for f in fields])
    return df.fillna(defaults)


def over_buckets(df: DataFrame, column: str, buckets: list[str]) -> DataFrame:
    spine = df.sparkSession.createDataFrame([(b,) for b in buckets], f"{column} string")
    return spine.join(df.groupBy(column).agg(F.count("*").alias("n")), column, "left").fillna(0, ["n"])


def daily_counts(df: DataFrame, day: Column, last: str, days: int) -> DataFrame:
    end = F.lit(last).cast("date")
    spine = df.sparkSession.range(1).select(F.explode(F.sequence(F.date_sub(end, days - 1), end)).alias("day"))
    counts = df.filter(day.between(F.date_sub(end, days - 1), end)).groupBy(day.alias("day")).agg(F.count("*").alias("n"))
    return spine.join(counts, "day", "left").fillna(0, ["n"])


def tiered_match(rows: DataFrame, known: DataFrame, tiers: list[str], value: str) -> DataFrame:
    """value of the known row with the same key, by tiers; in every tier only keys that are unique among the known."""
    out, found, tier = rows, [], F.lit(None).cast("string")
    for t in tiers:
        unique = known.filter(F.col(t).isNotNull()).groupBy(t).agg(F.count("*").alias("_n"), F.min(value).alias(f"_m_{t}")).filter("_n = 1").drop("_n")
        out = out.join(unique, t, "left")
        found.append(F.col(f"_m_{t}"))
    for t in reversed(tiers):
        tier = F.when(F.col(f"_m_{t}").isNotNull(), t).otherwise(tier)
    return out.withColumns({value: F.coalesce(*found), "tier": tier}).drop(*[f"_m_{t}" for t in tiers])


def token_pairs(rows: DataFrame, ident: str, tokens: str, most: int) -> DataFrame:
    """(a, b, shared): pairs that share a token which at most `most` rows hold; tokens beyond that are no evidence by
    definition, so posting lists are bounded."""
    t = rows.select(F.col(ident).alias("id"), F.explode(F.array_distinct(tokens)).alias("token"))
    rare = t.groupBy("token").agg(F.count("*").alias("n")).filter((F.col("n") > 1) & (F.col("n") <= most)).select("token")
    t = t.join(rare, "token")
    a, b = t.alias("a"), t.alias("b")
    return a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.id") < F.col("b.id"))).groupBy(F.col("a.id").alias("a"), F.col("b.id").alias("b")).agg(F.count("*").alias("shared"))


def related_names(rows: DataFrame, ident: str, name: str, tokens: str, most: int = 200) -> DataFrame:
    """(a, b, shared) of token_pairs whose names of 4 characters or more contain one another, or whose token sets are
    strict subsets; names compare in lower case with single spaces. Only the candidate pairs are checked."""
    rows = rows.withColumn(tokens, F.filter(F.array_distinct(tokens), lambda x: x != ""))
    side = rows.select(F.col(ident).alias("_id"), F.lower(F.trim(F.regexp_replace(name, r"\s+", " "))).alias("_name"), F.col(tokens).alias("_tokens"))
    pairs = token_pairs(rows, ident, tokens, most)
    for x in ("a", "b"):
        pairs = pairs.join(side.select(F.col("_id").alias(x), F.col("_name").alias(f"_n{x}"), F.col("_tokens").alias(f"_t{x}")), x)
    subset = lambda x, y: (F.size(F.array_except(x, y)) == 0) & (F.size(x) < F.size(y))
    na, nb, ta, tb = (F.col(c) for c in ("_na", "_nb", "_ta", "_tb"))
    ok = (F.least(F.length(na), F.length(nb)) >= 4) & (na.contains(nb) | nb.contains(na) | subset(ta, tb) | subset(tb, ta))
    return pairs.filter(ok).select("a", "b", "shared")


def board_health(events: DataFrame) -> DataFrame:
    """Events as board outcomes: counts of failures and successes and the last sight of every board."""
    e = events.selectExpr("concat('b', user_id % 40) as board", "concat('c', user_id % 12) as company", "event_type", "ts")
    return e.groupBy("board", "company").agg(F.count_if(F.expr("event_type = 'error'")).alias("failures"), F.count_if(F.expr("event_type <> 'error'")).alias("successes"), F.max("ts").alias("last_seen"))


def ancestors(edges: DataFrame, depth: int) -> DataFrame:
    """(node, ancestor) closure of (node, parent), the node itself included; depth joins at most."""
    level = edges.select("node", F.col("parent").alias("ancestor"))
    out = edges.select("node", F.col("node").alias("ancestor")).unionByName(level)
    up = edges.select(F.col("node").alias("ancestor"), F.col("parent").alias("_next"))
    for _ in range(depth - 1):
        level = level.join(up, "ancestor").select("node", F.col("_next").alias("ancestor"))
        out = out.unionByName(level)
    return out.filter("ancestor is not null").distinct()


def page(df: DataFrame, order: list[Column], limit: int, offset: int) -> DataFrame:
    """An offset page with the total of all rows, which is counted apart from the sort."""
    total = df.agg(F.count("*").alias("total"))
    return df.orderBy(*order).offset(max(0, offset)).limit(max(0, limit)).join(F.broadcast(total))


def keyset(df: DataFrame, ts: str, ident: str, before: tuple | None, limit: int) -> DataFrame:
    """Newest first after a cursor (ts, id); rows without a time come last."""
    if before:
        t, i = before
        if t is None:
            df = df.filter(F.col(ts).isNull() & (F.col(ident) < i))
        else:
            df = df.filter((F.col(ts) < F.lit(t)) | ((F.col(ts) == F.lit(t)) & (F.col(ident) < i)) | F.col(ts).isNull())
    return df.orderBy(F.col(ts).desc_nulls_last(), F.desc(ident)).limit(limit)


def placed(df: DataFrame, order: list[Column]) -> DataFrame:
    """Adds the place in a total order of a small table (one row per company)."""
    return df.withColumn("place", F.row_number().over(Window.orderBy(*order)))


def top_and_kept(df: DataFrame, order: list[Column], n: int, kept: Column) -> DataFrame:
    return df.orderBy(*order).limit(n).unionByName(df.filter(kept)).distinct()


def _seeded(ident: str, seed: int) -> Column:
    return F.sha2(F.concat(F.lit(f"{seed}|"), F.col(ident).cast("string")), 256)


def stratified(df: DataFrame, group: str, ident: str, seed: int) -> DataFrame:
    """One row per group, the first by a seeded hash: a minimum per group, combined before the shuffle."""
    return df.groupBy(group).agg(F.min(F.struct(_seeded(ident, seed).alias("h"), F.col(ident).alias("id"))).alias("m")).select(group, F.col("m.id").alias(ident))


def rarity_sample(df: DataFrame, ident: str, columns: list[str], k: int, seed: int) -> DataFrame:
    """k rows without replacement, weight = mean over columns of min(4, sqrt(largest count / own count)). Exponential
    clocks from a seeded hash: the smallest -ln(1 - u) / weight. Counts join by value; no window over all rows."""
    out, parts = df, []
    for c in columns:
        n = df.groupBy(c).agg(F.count("*").alias(f"_n_{c}"))
        most = n.agg(F.max(f"_n_{c}").alias(f"_m_{c}"))
        n = n.withColumnRenamed(c, f"_k_{c}")
        out = out.join(n, F.col(c).eqNullSafe(F.col(f"_k_{c}"))).join(F.broadcast(most))
        parts.append(F.least(F.lit(4.0), F.sqrt(F.col(f"_m_{c}") / F.col(f"_n_{c}"))))
    weight = sum(parts[1:], parts[0]) / len(parts)
    u = (F.conv(F.substring(_seeded(ident, seed), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return out.withColumn("_clock", -F.log(1 - u) / weight).orderBy("_clock", ident).limit(k).select(ident)


def candidate_limit(count: int) -> int:
    return min(MAX_CANDIDATES, max(MIN_CANDIDATES, PER_SAMPLE * count))


def listed_counts(df: DataFrame, key: str, n: int | None = None) -> DataFrame:
    """One row: 'value:count' items, largest first (ties by value)."""
    c = df.groupBy(key).agg(F.count("*").alias("n"))
    c = c.orderBy(F.desc("n"), key).limit(n) if n else c
    items = F.sort_array(F.collect_list(F.struct((-F.col("n")).alias("o"), F.col(key).alias("k"))))
    return c.agg(F.array_join(F.transform(items, lambda x: F.concat(x["k"], F.lit(":"), (-x["o"]).cast("string"))), ",").alias("items"))


def analytics(postings: DataFrame) -> DataFrame:
    """Totals of open postings and the twelve largest companies, in one row."""
    o = postings.filter("status = 'open'")
    n = lambda w: F.count_if(F.col("work") == w).alias(w)
    totals = o.agg(F.count("*").alias("total"), F.count_distinct("company_slug").alias("companies"), F.round(100.0 * F.count_if(F.col("seniority") == "mid") / F.count("*"), 1).alias("mid_pct"), n("remote"), n("hybrid"), n("onsite"), n("unknown"))
    return totals.join(F.broadcast(listed_counts(o, "company_slug", 12).withColumnRenamed("items", "top_companies")))


def market_snapshot(postings: DataFrame, since: str) -> DataFrame:
    new = F.col("first_seen") > F.lit(since).cast("timestamp")
    totals = postings.agg(F.count_if(F.expr("status = 'open'")).alias("open"), F.count_if(new).alias("new"), F.count_if((F.col("status") == "closed") & new).alias("closed"))
    by = postings.filter("status = 'open'").groupBy(F.coalesce("seniority", F.lit("unknown")).alias("k")).agg(F.count("*").alias("n"))
    text = by.agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("k", "n"))), lambda x: F.concat(x["k"], F.lit(":"), x["n"].cast("string"))), ",").alias("by_seniority"))
    return totals.join(F.broadcast(text))


def search(postings: DataFrame, query: str, fields: list[tuple[str, float]], members: dict[str, list | None] | None = None, status: str = "open", limit: int = 20, offset: int = 0) -> DataFrame:
    """Ranked text search with filters and an offset page: rank, recency and id order the rows; the total is exact."""
    ok, rank = T.search_rank(query or "", [(F.col(c), w) for c, w in fields])
    rows = filtered(postings, members or {}, status).filter(ok).withColumn("rank", rank)
    return page(rows, [F.desc("rank"), F.desc("first_seen"), F.desc("id")], limit, offset)


def above_mark(df: DataFrame, ts: str, mark: str | None) -> DataFrame:
    """Rows newer than the high-water mark; rows without a time always; all rows without a mark (full refresh)."""
    return df if mark is None else df.filter((F.col(ts) > F.lit(mark).cast("timestamp")) | F.col(ts).isNull())


#: Kinds of sections that are extracted; the share of blocks that sections must claim; titles of leaders
#: and endings of professions that do not go together.
EXTRACTED_KINDS = ("role", "requirements", "benefits", "compensation")
LEAST_COVERAGE = 0.4
LEADER = r"(?i)^(head|head of|director|vp|vice president|chief|c-level)\b"
SUBORDINATE = r"(?i)\b(specialist|assistant|associate|coordinator|analyst)$"


def section_checks(sections: Column, blocks: Column) -> Column:
    """Struct of faults of sections (kind, block_ids): ids that no block has, ids that are not ascending by one, ids
    that stand twice."""
    ids = F.flatten(F.transform(sections, lambda s: s["block_ids"]))
    broken = F.exists(sections, lambda s: F.exists(F.transform(s["block_ids"], lambda x, i: x - i), lambda x: x != s["block_ids"][0]))
    return F.struct((F.size(F.array_except(ids, blocks)) > 0).alias("unknown_block"), F.coalesce(broken, F.lit(False)).alias("not_contiguous"), (F.size(ids) != F.size(F.array_distinct(ids))).alias("repeated_block"))


def globals_checks(profession: Column, seniority: Column, locations: Column) -> Column:
    """Struct of faults of the globals: a leader with a subordinate's profession, a hash tag for a place."""
    return F.struct(F.coalesce(profession.rlike(SUBORDINATE) & seniority.rlike(LEADER), F.lit(False)).alias("rank_mismatch"), F.coalesce(F.exists(locations, lambda x: F.ltrim(x).startswith("#")), F.lit(False)).alias("hashtag_place"))


def qa_rules(sections: Column, blocks: Column, profession: Column) -> Column:
    """Array of (name, passed) over sections (kind, block_ids, extracted: named fields as a map); a posting is
    accepted if all pass. Rules of kinds that do not occur are left out."""
    claimed, n = F.aggregate(sections, F.lit(0), lambda a, s: a + F.size(s["block_ids"])), F.size(blocks)
    own = lambda k: F.filter(sections, lambda s: (s["kind"] == k) & s["extracted"].isNotNull())
    rule = lambda name, ok: F.struct(F.lit(name).alias("name"), F.coalesce(ok, F.lit(False)).alias("passed"))
    signal = lambda k: F.exists(own(k), lambda s: F.exists(F.map_values(s["extracted"]), lambda v: F.length(F.trim(v)) > 0))
    rules = [rule("split_coverage_min_40pct", (n == 0) | (claimed >= n * LEAST_COVERAGE)), rule("profession_non_empty", F.length(F.trim(profession)) > 0), rule("has_extractable_section", F.exists(sections, lambda s: s["kind"].isin(*EXTRACTED_KINDS)))]
    rules += [F.when(F.exists(sections, _of_kind(k)), rule(f"section_{k}_has_extraction", F.forall(F.filter(sections, _of_kind(k)), lambda s: s["extracted"].isNotNull()))) for k in EXTRACTED_KINDS]
    rules += [F.when(F.size(own(k)) > 0, rule(f"{k}_has_signal", signal(k))) for k in ("role", "requirements")]
    return F.filter(F.array(*rules), lambda r: r.isNotNull())


def _of_kind(kind: str):
    return lambda s: s["kind"] == kind


def verdict(rules: Column) -> Column:
    return F.when(F.forall(rules, lambda r: r["passed"]), "accepted").otherwise("rejected")


def dimension_violations(companies: DataFrame, boards: DataFrame) -> DataFrame:
    """Violations of dimension data: slugs twice, slugs of wrong form, boards without a company."""
    tag = lambda df, k: df.select(F.lit(k).alias("kind"), F.col("slug").cast("string").alias("slug"))
    twice = companies.groupBy("slug").count().filter("count > 1")
    form = companies.filter(~F.col("slug").rlike("^[a-z0-9]+(-[a-z0-9]+)*$"))
    orphans = boards.join(companies, boards["company_slug"] == companies["slug"], "left_anti").select(F.col("company_slug").alias("slug")).distinct()
    return tag(twice, "duplicate").unionByName(tag(form, "form")).unionByName(tag(orphans, "orphan"))


def retirement_class() -> Column:
    """Evidence about a board (failures, successes, days since success) as a class."""
    return F.when(F.col("successes") == 0, "never_worked").when((F.col("failures") > 5) & (F.col("quiet_days") > 20), "retire").when(F.col("failures") > 5, "watch").otherwise("healthy")


def clock_steps(minutes: int, failures: Column, most: int = 1440) -> Column:
    """Backoff in minutes: doubling from a start, with a ceiling."""
    return F.least(F.lit(float(most)), minutes * F.pow(F.lit(2.0), F.least(failures, F.lit(math.ceil(math.log2(most))))))
