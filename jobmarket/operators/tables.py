"""Table mutations as whole-table passes.

A mutation returns the new table; writing it is a write of a new version (see sources.sinks), never of the path read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in an explicit order."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter("_rank = 1").drop("_rank")


def upsert(target: DataFrame, incoming: DataFrame, keys: list[str], policy: dict[str, str], default: str = "replace") -> DataFrame:
    """Inserts or updates by key. Policies per column: replace (the incoming value), coalesce (incoming unless null),
    fill (the old value unless null), keep (the old value; incoming on insert). One full outer join."""
    columns = [c for c in target.columns if c not in keys]
    inc = incoming.select(*keys, *[F.col(c).alias(f"_in_{c}") if c in incoming.columns else F.lit(None).cast(target.schema[c].dataType).alias(f"_in_{c}") for c in columns], F.lit(True).alias("_new"))
    joined = target.withColumn("_old", F.lit(True)).join(inc, keys, "full_outer")
    out = []
    for c in columns:
        new, old = F.col(f"_in_{c}"), F.col(c)
        both = {"replace": new, "coalesce": F.coalesce(new, old), "fill": F.coalesce(old, new), "keep": old}[policy.get(c, default)]
        out.append(F.when(F.col("_new").isNull(), old).when(F.col("_old").isNull(), new).otherwise(both).alias(c))
    return joined.select(*keys, *out)


def changed(old: str, new: str, columns: list[str]) -> Column:
    """Whether any column is distinct between two aliases (null-safe)."""
    out = F.lit(False)
    for c in columns:
        out = out | ~F.col(f"{old}.{c}").eqNullSafe(F.col(f"{new}.{c}"))
    return out


def update_changed(target: DataFrame, incoming: DataFrame, key: str, columns: list[str], stamp: str, now: Column) -> DataFrame:
    """Replaces columns of matching keys and sets the stamp only where a value really changed."""
    j = target.alias("t").join(incoming.select(key, *columns).alias("i"), key, "left")
    known = incoming.select(key, F.lit(True).alias("_known"))
    j = j.join(known, key, "left")
    hit = F.coalesce(F.col("_known"), F.lit(False)) & changed("t", "i", columns)
    rest = [c for c in target.columns if c not in (key, stamp, *columns)]
    return j.select(key, *[F.col(f"t.{c}") for c in rest], *[F.when(F.col("_known"), F.col(f"i.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in columns], F.when(hit, now).otherwise(F.col(f"t.{stamp}")).alias(stamp))


def disable_absent(target: DataFrame, incoming: DataFrame, key: str, flag: str = "enabled") -> DataFrame:
    """Rows whose key is not in the incoming list get the flag false."""
    known = incoming.select(key).distinct().withColumn("_known", F.lit(True))
    return target.join(known, key, "left").withColumn(flag, F.col(flag) & F.coalesce("_known", F.lit(False))).drop("_known")


def dimension_sync(target: DataFrame, incoming: DataFrame, key: str, enums: dict[str, tuple[tuple[str, ...], str]], flag: str = "enabled") -> DataFrame:
    """U4: incoming rows are upserted and enabled, rows that are absent disabled; values outside an enum (column: allowed
    ones, default) become its default."""
    for column, (allowed, default) in enums.items():
        incoming = incoming.withColumn(column, F.when(F.col(column).isin(*allowed), F.col(column)).otherwise(default))
    return disable_absent(upsert(target, incoming.withColumn(flag, F.lit(True)), [key], {}), incoming, key, flag)


def close_stale(df: DataFrame, now: Column, days: int, seen: str = "last_seen", status: str = "status") -> DataFrame:
    return df.withColumn(status, F.when((F.col(status) == "open") & (F.col(seen) < now - F.expr(f"interval {days} days")), "closed").otherwise(F.col(status)))


def delete_older(df: DataFrame, now: Column, days: int, column: str = "first_seen") -> DataFrame:
    return df.filter(F.col(column) >= now - F.expr(f"interval {days} days"))


def newest_per_group(df: DataFrame, group: str, order: list[Column], keep: int) -> DataFrame:
    """The newest rows of each group; Spark limits ranks before the shuffle."""
    w = Window.partitionBy(group).orderBy(*order)
    return df.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= keep).drop("_rank")


def snapshot_diff(existing: DataFrame, discovered: DataFrame, url: str = "url", owner: str = "board") -> DataFrame:
    """Each discovered url: new, touched, relisted, foreign or foreign_relisted (owned by another board, open or not)."""
    e = existing.select(F.col(url), F.col(owner).alias("_owner"), F.col("active").alias("_active"))
    j = discovered.join(e, url, "left")
    kind = (
        F.when(F.col("_owner").isNull(), "new")
        .when((F.col("_owner") == F.col(owner)) & F.col("_active"), "touched")
        .when(F.col("_owner") == F.col(owner), "relisted")
        .when(F.col("_active"), "foreign")
        .otherwise("foreign_relisted")
    )
    return j.withColumn("action", kind).drop("_owner", "_active")


def durable_diff(existing: DataFrame, aliases: DataFrame, discovered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A discovery by durable identity. existing: (identity, url, board, active); aliases: (url, identity) of former
    urls; discovered: (identity, url, board, explicit).

    Returns (actions, aliases): an action per discovered row, as in snapshot_diff but by identity, with the url that the
    posting has then, or conflict where another identity owns the url, as its own or as an alias; and the alias table
    afterwards: where an explicit identity comes with a new url, the old one is appended, and an alias that becomes a
    posting's url again goes."""
    e = existing.select(F.col("identity").alias("_i"), F.col("url").alias("old_url"), F.col("board").alias("_board"), "active")
    urls = existing.select("url", F.col("identity").alias("_by")).unionByName(aliases.select("url", F.col("identity").alias("_by"))).groupBy("url").agg(F.collect_set("_by").alias("_owners"))
    d = discovered.join(e, discovered["identity"] == F.col("_i"), "left").join(urls, "url", "left")
    foreign = F.coalesce(F.exists("_owners", lambda x: x != F.col("identity")), F.lit(False))
    same = F.col("_board") == F.col("board")
    action = F.when(foreign, "conflict").when(F.col("_i").isNull(), "new").when(same & F.col("active"), "touched").when(same, "relisted").when(F.col("active"), "foreign").otherwise("foreign_relisted")
    d = d.withColumn("action", action)
    moved = d.filter(F.col("explicit") & ~F.col("action").isin("conflict", "new") & (F.col("old_url") != F.col("url"))).select(F.col("old_url").alias("url"), "identity")
    current = d.filter("action <> 'conflict'").select("url", "identity")
    after = aliases.select("url", "identity").unionByName(moved).distinct().join(current, ["url", "identity"], "left_anti")
    return d.select("identity", "url", "board", "action", "old_url"), after


def emptied(table: DataFrame, path: str) -> DataFrame:
    """U8: overwrites a table with no row, and reads it back."""
    table.limit(0).write.mode("overwrite").parquet(path)
    return table.sparkSession.read.schema(table.schema).parquet(path)


def count_missing(existing: DataFrame, seen: DataFrame, key: str, threshold: Column | int) -> DataFrame:
    """Rows of the table that a snapshot lacks: one more miss, inactive from the threshold on; seen rows start anew."""
    s = seen.select(key).distinct().withColumn("_seen", F.lit(True))
    j = existing.join(s, key, "left")
    misses = F.when(F.col("_seen"), 0).otherwise(F.col("missing") + 1)
    limit = F.lit(threshold) if isinstance(threshold, int) else threshold
    return j.withColumn("missing", misses).withColumn("active", F.when(F.col("_seen"), True).otherwise(F.col("active") & (F.col("missing") < limit))).drop("_seen")


def gone_guard(runs: DataFrame, now: DataFrame, history: int = 5, least: int = 3, drop: float = 0.30, most_missing: float = 0.50) -> DataFrame:
    """Per board whether misses may count: not when today's discoveries fall short of the median of the last runs, nor
    when too many active rows are missing. runs: (board, run, discovered); now: (board, discovered, missing, active)."""
    w = Window.partitionBy("board").orderBy(F.desc("run"))
    last = runs.withColumn("_rank", F.row_number().over(w)).filter(F.col("_rank") <= history)
    med = last.groupBy("board").agg(F.median(F.col("discovered").cast("double")).alias("usual"), F.count("*").alias("n_runs"))
    j = now.join(med, "board", "left")
    short = (F.coalesce("n_runs", F.lit(0)) >= least) & (F.col("discovered") < F.col("usual") * (1 - drop))
    many = F.coalesce(F.try_divide(F.col("missing"), F.col("active")) > most_missing, F.lit(False))
    return j.withColumn("guard", F.when(short, "short").when(many, "many_missing").otherwise("ok"))


def rolling_median(df: DataFrame, group: str, order: str, value: str, rows: int) -> DataFrame:
    """Median of the last rows of each group up to each row."""
    w = Window.partitionBy(group).orderBy(order).rowsBetween(-(rows - 1), 0)
    return df.withColumn("rolling_median", _median_of(F.collect_list(F.col(value).cast("double")).over(w)))


def _median_of(xs: Column) -> Column:
    s, n = F.array_sort(xs), F.size(xs)
    low, high = F.get(s, F.floor((n - 1) / 2).cast("int")), F.get(s, F.floor(n / 2).cast("int"))
    return (low + high) / 2


def rehomed(rows: DataFrame, incoming: DataFrame) -> DataFrame:
    """Incoming (slug, url, company) whose match by url or by slug belongs to another company; each pair once."""
    by = lambda k: incoming.alias("i").join(rows.alias("r"), F.col(f"i.{k}") == F.col(f"r.{k}")).filter(~F.col("i.company").eqNullSafe(F.col("r.company"))).select(F.col("r.slug").alias("slug"), F.col("r.company").alias("old_company"), F.col("i.company").alias("new_company"))
    return by("url").unionByName(by("slug")).distinct()


def identity_conflicts(batch: DataFrame, existing: DataFrame) -> DataFrame:
    """Violations (kind, identity): identity twice in a batch, url twice, identity or url owned by another company."""
    tag = lambda df, k: df.select(F.lit(k).alias("kind"), F.col("identity").cast("string").alias("identity"))
    twice = batch.groupBy("identity").count().filter("count > 1")
    urls = batch.groupBy("url").agg(F.min("identity").alias("identity"), F.count("*").alias("n")).filter("n > 1")
    b, e = batch.alias("b"), existing.alias("e")
    owned = b.join(e, F.col("b.identity") == F.col("e.identity")).filter("b.company <> e.company").select("b.identity")
    url_owned = b.join(e, F.col("b.url") == F.col("e.url")).filter("b.identity <> e.identity").select("b.identity")
    out = tag(twice, "duplicate_identity").unionByName(tag(urls, "duplicate_url")).unionByName(tag(owned, "cross_owner")).unionByName(tag(url_owned, "url_owned"))
    return out.distinct()


#: Parts of a key's rows, and tasks, of a join whose output is far larger than its input.
KEY_PARTS, PAIR_TASKS = 16, 192


def key_conflicts(left: DataFrame, right: DataFrame, key: str, ident: str = "id") -> DataFrame:
    """Two stores: same natural key with different id, and same id with different key.

    The pairs of a key are as many as its rows on both sides multiplied, so a key's left rows are dealt to several tasks,
    each with all its right rows; the number of tasks is fixed, as one that follows the input would be too small."""
    a, b = left.alias("a"), right.alias("b")
    dealt = left.withColumn("_part", F.pmod(F.xxhash64(ident), F.lit(KEY_PARTS)).cast("int")).repartition(PAIR_TASKS, key, "_part").alias("a")
    every = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.lit(KEY_PARTS - 1)))).repartition(PAIR_TASKS, key, "_part").alias("b")
    one = dealt.join(every, (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a._part") == F.col("b._part"))).filter(f"a.{ident} <> b.{ident}")
    two = a.join(b, F.col(f"a.{ident}") == F.col(f"b.{ident}")).filter(f"a.{key} <> b.{key}")
    pick = lambda df, k: df.select(F.lit(k).alias("kind"), F.col(f"a.{key}").alias("left_key"), F.col(f"b.{key}").alias("right_key"), F.col(f"a.{ident}").alias("left_id"), F.col(f"b.{ident}").alias("right_id"))
    return pick(one, "same_key").unionByName(pick(two, "same_id"))


def compare_snapshots(local: DataFrame, remote: DataFrame, key: str, state: str, payload: str) -> DataFrame:
    """Class of every id in either store: missing, remote_only_active, remote_only_inactive, state, payload or equal."""
    a = local.select(key, F.col(state).alias("_ls"), F.col(payload).alias("_lp"), F.lit(True).alias("_l"))
    b = remote.select(key, F.col(state).alias("_rs"), F.col(payload).alias("_rp"), F.lit(True).alias("_r"))
    j = a.join(b, key, "full_outer")
    kind = (
        F.when(F.col("_r").isNull(), "missing")
        .when(F.col("_l").isNull() & F.col("_rs"), "remote_only_active")
        .when(F.col("_l").isNull(), "remote_only_inactive")
        .when(~F.col("_ls").eqNullSafe(F.col("_rs")), "state_mismatch")
        .when(~F.col("_lp").eqNullSafe(F.col("_rp")), "payload_mismatch")
        .otherwise("equal")
    )
    return j.select(key, kind.alias("kind"))


def field_diff(old: DataFrame, new: DataFrame, key: str, column: str, raw: str) -> DataFrame:
    """Change class of one value per key: added, lost, changed, raw_only (only the raw text moved), same."""
    j = old.alias("o").join(new.alias("n"), key)
    o, n = F.col(f"o.{column}"), F.col(f"n.{column}")
    kind = F.when(o.isNull() & n.isNotNull(), "added").when(o.isNotNull() & n.isNull(), "lost").when(~o.eqNullSafe(n), "changed").when(~F.col(f"o.{raw}").eqNullSafe(F.col(f"n.{raw}")), "raw_only").otherwise("same")
    return j.select(key, kind.alias("kind"))


def compare_and_set(target: DataFrame, proposals: DataFrame, key: str, column: str) -> DataFrame:
    """Sets a column where it still has the value that the proposal saw; applied tells. proposals: (key, seen, value)."""
    j = target.join(proposals, key, "left")
    hit = F.col("value").isNotNull() & F.col(column).eqNullSafe(F.col("seen"))
    return j.withColumn("applied", hit).withColumn(column, F.when(hit, F.col("value")).otherwise(F.col(column))).drop("seen", "value")


def count_misses(misses: DataFrame, found: DataFrame) -> DataFrame:
    """Adds new counts to a table of unresolved values (taxonomy, value, n, status), only while pending."""
    new = found.groupBy("taxonomy", "value").agg(F.count("*").alias("_n"))
    j = misses.join(new, ["taxonomy", "value"], "full_outer")
    n = F.when(F.col("n").isNull(), F.col("_n")).when(F.col("status") == "pending", F.col("n") + F.coalesce("_n", F.lit(0))).otherwise(F.col("n"))
    return j.select("taxonomy", "value", n.alias("n"), F.coalesce("status", F.lit("pending")).alias("status"))


def rename_propagation(rows: DataFrame, before: DataFrame, after: DataFrame, key: str, name: str) -> DataFrame:
    """Rows that carry an old dimension name get the new one."""
    renamed = before.alias("b").join(after.alias("a"), key).filter(f"b.{name} <> a.{name}").select(F.col(f"b.{name}").alias("_old"), F.col(f"a.{name}").alias("_new"))
    return rows.join(renamed, rows[name] == F.col("_old"), "left").withColumn(name, F.coalesce("_new", name)).drop("_old", "_new")


def merge_maps(old: Column, new: Column) -> Column:
    """Shallow merge of two maps, new keys win."""
    return F.map_concat(F.map_filter(old, lambda k, _: ~F.array_contains(F.map_keys(new), k)), new)


def fingerprint(columns: list[Column]) -> Column:
    """SHA-256 over values with a separator that they do not hold; null is its own value."""
    return F.sha2(F.concat_ws("\u001f", *[F.coalesce(c.cast("string"), F.lit("\u0000")) for c in columns]), 256)


def changed_by_hash(now: DataFrame, stored: DataFrame, keys: list[str], limit: int | None = None) -> DataFrame:
    """Keys whose hash differs from the stored one, in key order; at most limit of them in a run."""
    s = stored.select(*keys, F.col("hash").alias("_stored"))
    out = now.join(s, keys, "left").filter(~F.col("hash").eqNullSafe(F.col("_stored"))).drop("_stored").orderBy(*keys)
    return out.limit(limit) if limit else out


def fill_from_canonical(local: DataFrame, source: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Nulls filled from a canonical copy; raises if ids differ or a filled value conflicts."""
    j = local.alias("l").join(source.alias("s"), key, "full_outer")
    bad = F.lit(False)
    for c in columns:
        bad = bad | (F.col(f"l.{c}").isNotNull() & F.col(f"s.{c}").isNotNull() & (F.col(f"l.{c}") != F.col(f"s.{c}")))
    value = lambda c: F.when(bad, F.raise_error(F.lit(f"conflict in {c}"))).otherwise(F.coalesce(F.col(f"l.{c}"), F.col(f"s.{c}")))
    return j.select(key, *[value(c).alias(c) for c in columns])


def collapse_publications(rows: DataFrame, identity: str, print_: str, rank: list[Column], locale: str, title: str) -> DataFrame:
    """Publications of one identity as one row: the lowest rank stays, localisations merge into a map; identities with
    several fingerprints are marked."""
    order = F.struct(*rank)
    g = rows.groupBy(identity).agg(F.count_distinct(print_).alias("n_prints"), F.min_by(title, order).alias(title), F.map_from_entries(F.array_sort(F.collect_set(F.struct(locale, title)))).alias("localisations"))
    return g.withColumn("conflict", F.col("n_prints") > 1)


def rewrite_urls(rows: DataFrame, url: str, pattern: str, replacement: str, rank: list[Column]) -> DataFrame:
    """Regex rewrite; of rows that collide on the new url, the first by rank stays."""
    return first_per_key(rows.withColumn(url, F.regexp_replace(url, pattern, replacement)), [url], rank)


def cursor_page(df: DataFrame, ts: str, ident: str, after: tuple | None, cutoff, size: int) -> DataFrame:
    """Keyset page in (ts, id) order after a cursor and before a cutoff."""
    out = df.filter(F.col(ts) < F.lit(cutoff))
    if after:
        out = out.filter((F.col(ts) > F.lit(after[0])) | ((F.col(ts) == F.lit(after[0])) & (F.col(ident) > F.lit(after[1]))))
    return out.orderBy(ts, ident).limit(size)


def ordered_digest(hashes: DataFrame) -> DataFrame:
    """(part, digest, n) of rows (part, h): SHA-256 of a part's hashes in order, one after the other; null hashes count
    as rows only. Spark sorts, the digest is fed row by row, so no part has to fit into memory."""
    def feed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, digest, n, kind = None, None, 0, None
        for batch in batches:
            done, kind = [], batch.schema.field("part").type
            for p, h in zip(batch.column("part").to_pylist(), batch.column("h").to_pylist(), strict=True):
                if digest is None or p != part:
                    if digest is not None:
                        done.append((part, digest.hexdigest(), n))
                    part, digest, n = p, hashlib.sha256(), 0
                digest.update((h or "").encode())
                n += 1
            if done:
                yield rows(done, kind)
        if digest is not None:
            yield rows([(part, digest.hexdigest(), n)], kind)

    def rows(done: list[tuple], kind: pa.DataType) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done, strict=True), (kind, pa.string(), pa.int64()), strict=True)], names=["part", "digest", "n"])

    schema = f"part {hashes.schema['part'].dataType.simpleString()}, digest string, n long"
    return hashes.select("part", "h").repartition("part").sortWithinPartitions("part", "h").mapInArrow(feed, schema)
