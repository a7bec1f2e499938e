"""Merkle manifest of a dataset by butterfly exchange: leaves, a root per source, a root over sources, and a proof a row.

1. Every row becomes a leaf digest. Rows are sorted by ranges of (source, doc_id); the place of a row in its source
   follows from its row number in its range and the counts of ranges before it. FANOUT ** HEIGHT consecutive leaves of
   a source are a block, the unit that takes part in the exchange.
2. A task hashes the leaves of a block up to the block's root.
3. Butterfly: in round r, the blocks that differ only in digit r (base FANOUT) of their number form a group, each
   standing for its aligned subtree of FANOUT ** r blocks. The group swaps roots, and all members hash the parent, so
   after the last round each block holds the source's root and the siblings on its own way up, without a downward pass.
   The last subtree of a level may have fewer blocks; its blocks then stand in for the missing ones too.
4. Roots of sources are the leaves of one more tree, built in the same way; its paths continue those of the blocks.
5. Blocks meet their upper path once more, and each leaf gets its siblings, their digest, and the root that its own
   (or a changed) leaf folds to.

A round's shuffle has one row a block, some 1/700 of the rows; sources are split into blocks, so a hot source is many
tasks. Rows are numbered by tables that are written, so a lost executor does not renumber them.

Defined results: null fields are `-`; null sources are one source, the first; null ids come first in their source; rows
that share an id are leaves each, by id and then leaf; equal rows have equal leaves, at places of their own; null ids
are never changed by the tampering; an empty table has no leaves and no root; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmarket.llm.common import keys_of, result, scratch, table, written

FANOUT = 3
#: Levels inside a block.
HEIGHT = 6
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
#: Most sources whose paths (some kilobytes each) are sent to every executor.
PATHS = 5_000

STEPS = "array<struct<before:string,after:string>>"


def field(c: Column) -> Column:
    """A value with its length in UTF-8 bytes, so that no two lists of values concatenate to the same string."""
    text = c.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(**changed: Column) -> Column:
    return F.sha2(F.concat(*[field(changed.get(c, F.col(c))) for c in FIELDS]), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """(owner, doc_id, leaf, tampered): owner is a source as a string that orders null first; tampered is the leaf after
    line ends are gone from the texts of rows whose id has an even checksum."""
    even = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 2 == 0, F.lit(False)) & F.col("text").contains("\n")
    owner = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit(""))
    own = docs.select(*[docs[f"`{c}`"] for c in FIELDS])
    return own.select(owner.alias("owner"), "doc_id", leaf().alias("leaf"), F.when(even, leaf(text=F.replace(F.col("text"), F.lit("\n"), F.lit("")))).alias("tampered"))


def numbered(rows: DataFrame, order: list[str], height: int = HEIGHT) -> DataFrame:
    """Adds block, at (place in the block) and blocks (of the owner); rows: a written table with owner and the columns of
    order, which may tie: ties are then told apart by where they stand in that table."""
    keys = ["owner", *[F.col(c).asc_nulls_first() for c in order], "tie"]
    ranges = rows.withColumn("tie", F.monotonically_increasing_id()).repartitionByRange(*keys).sortWithinPartitions(*keys)
    # The high bits of the number are the partition, the low 33 bits the row in it.
    number = F.monotonically_increasing_id()
    placed = written(ranges.drop("tie").withColumn("number", number).withColumns({"part": F.shiftright("number", 33), "row": F.col("number").bitwiseAND((1 << 33) - 1)}).drop("number"), "ranges")
    runs = placed.groupBy("owner", "part").agg(F.min("row").alias("first"), F.count("*").alias("n"))
    own = Window.partitionBy("owner").orderBy("part")
    starts = runs.select("owner", "part", (F.sum("n").over(own) - F.col("n") - F.col("first")).alias("shift"), F.sum("n").over(Window.partitionBy("owner")).alias("total"))
    size = FANOUT**height
    out = placed.join(keys_of(written(starts, "starts")), ["owner", "part"]).withColumn("place", F.col("row") + F.col("shift"))
    return out.withColumns({"block": F.expr(f"place div {size}"), "at": (F.col("place") % size).cast("int"), "blocks": F.expr(f"(total + {size - 1}) div {size}")}).drop("part", "row", "shift", "total", "place")


def parent_of(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def levels(nodes: list[str], height: int | None) -> list[list[str]]:
    """Nodes, their parents and so on: height levels up, or until one node remains."""
    out = [nodes]
    while len(out) <= height if height is not None else len(out[-1]) > 1:
        last = out[-1]
        out.append([parent_of(last[i : i + FANOUT]) for i in range(0, len(last), FANOUT)])
    return out


def steps_inside(tree: list[list[str]], at: int) -> list[tuple[str, str]]:
    """The siblings before and after a leaf's ancestor, level by level."""
    out = []
    for nodes in tree[:-1]:
        start = at - at % FANOUT
        out.append(("".join(nodes[start:at]), "".join(nodes[at + 1 : start + FANOUT])))
        at //= FANOUT
    return out


def _ordered(block: pa.Table) -> pa.Table:
    return block.sort_by("at")


def block_roots(leaves: DataFrame, height: int) -> DataFrame:
    """(owner, block, blocks, digest): the root of every block; an owner's only block ends when one node remains."""

    def root(block: pa.Table) -> pa.Table:
        block = _ordered(block)
        alone = block["blocks"][0].as_py() == 1
        digest = levels(block["leaf"].to_pylist(), None if alone else height)[-1][0]
        return block.slice(0, 1).select(["owner", "block", "blocks"]).append_column("digest", pa.array([digest]))

    return leaves.select("owner", "block", "blocks", "at", "leaf").groupBy("owner", "block").applyInArrow(root, "owner string, block long, blocks long, digest string")


def exchanged(roots: DataFrame, span: int) -> DataFrame:
    """One round: (owner, block, blocks, digest, path) with the digests of the parents, for subtrees of span blocks."""
    last = F.expr(f"(blocks - 1) div {span}")
    s = roots.withColumns({"sub": F.expr(f"block div {span}"), "residue": F.col("block") % span}).withColumn("size", F.when(F.col("sub") == last, F.col("blocks") - last * span).otherwise(F.lit(span)))
    s = s.withColumn("seat", F.explode(F.sequence(F.col("residue"), F.lit(span - 1).cast("long"), F.col("size").cast("long"))))
    member = F.when(F.col("seat") == F.col("residue"), F.struct("sub", "block", "blocks", "path"))
    group = s.groupBy("owner", F.expr(f"sub div {FANOUT}").alias("up"), "seat").agg(F.sort_array(F.collect_list(F.struct("sub", "digest"))).alias("run"), F.collect_list(member).alias("members"))
    text = lambda keep: F.array_join(F.transform(F.filter("run", keep), lambda x: x["digest"]), "")
    m = group.select("owner", "run", F.explode("members").alias("m"))
    step = F.struct(text(lambda x: x["sub"] < F.col("m.sub")).alias("before"), text(lambda x: x["sub"] > F.col("m.sub")).alias("after"))
    return m.select("owner", "m.block", "m.blocks", F.sha2(text(lambda x: F.lit(True)), 256).alias("digest"), F.concat("m.path", F.array(step)).alias("path"))


def butterfly(roots: DataFrame) -> DataFrame:
    """(owner, block, root, path): what each block knows after the last round."""
    state, span, done = written(roots.withColumn("path", F.expr(f"cast(array() as {STEPS})")), "blocks"), 1, []
    most = state.agg(F.max("blocks").alias("n")).first()["n"] or 0
    while True:
        done.append(state.filter(F.col("blocks") <= span))
        if span >= most:
            break
        state, span = written(exchanged(state.filter(F.col("blocks") > span), span), "exchanged"), span * FANOUT
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out.select("owner", "block", F.col("digest").alias("root"), "path")


def paths_of(roots: DataFrame, height: int) -> DataFrame:
    """(owner, root, steps) for the owners of a table of roots, which are the leaves of one tree, by name."""
    named = written(roots.select(F.lit("").alias("owner"), F.col("owner").alias("name"), F.col("root").alias("leaf")), "names")
    leaves = written(numbered(named, ["name"], height), "named")
    upper = butterfly(block_roots(leaves, height))

    def walk(block: pa.Table, own: pa.Table) -> pa.Table:
        block, up = _ordered(block), own["path"][0].as_py()
        tree = levels(block["leaf"].to_pylist(), None if block["blocks"][0].as_py() == 1 else height)
        steps = [[{"before": b, "after": a} for b, a in steps_inside(tree, i)] + up for i in range(len(block))]
        kind = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))
        return pa.table({"owner": block["name"], "root": pa.array([own["root"][0].as_py()] * len(block)), "steps": pa.array(steps, kind)})

    return leaves.groupBy("owner", "block").cogroup(upper.groupBy("owner", "block")).applyInArrow(walk, f"owner string, root string, steps {STEPS}")


def manifest(docs: DataFrame, height: int = HEIGHT) -> tuple[DataFrame, DataFrame]:
    """The manifest as two written tables: leaves (owner, doc_id, leaf, tampered, block, at, blocks), and blocks (owner,
    block, subroot, root, path) with all siblings from a block's root up to the root of all."""
    spark = docs.sparkSession
    with scratch(spark):
        leaves = result(numbered(written(leaves_of(docs), "leaves"), ["doc_id", "leaf"], height), "manifest-leaves")
        own = written(butterfly(block_roots(leaves, height)), "own-paths")
        top = keys_of(written(paths_of(own.filter("block = 0"), height), "top-paths"), PATHS)
        blocks = own.withColumnRenamed("root", "subroot").join(top, "owner").select("owner", "block", "subroot", "root", F.concat("path", "steps").alias("path"))
        return leaves, result(blocks, "manifest-blocks")


def proven(leaves: DataFrame, blocks: DataFrame, height: int = HEIGHT) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof, folded_root) of every leaf of a manifest; proof: all siblings, from the leaf's
    up, as one text; folded_root: what the tampered leaf, where there is one, else the leaf, and the siblings give."""

    def prove(block: pa.Table, own: pa.Table) -> pa.Table:
        block, up = _ordered(block), [(x["before"], x["after"]) for x in own["path"][0].as_py()]
        nodes = block["leaf"].to_pylist()
        tree = levels(nodes, None if block["blocks"][0].as_py() == 1 else height)
        rest = "".join(b + a for b, a in up)
        proofs, folded = [], []
        for i, changed in enumerate(block["tampered"].to_pylist()):
            steps, node = steps_inside(tree, i), changed or nodes[i]
            proofs.append("".join([b + a for b, a in steps]) + rest)
            for before, after in [*steps, *up]:
                node = hashlib.sha256((before + node + after).encode()).hexdigest()
            folded.append(node)
        same = lambda c: pa.array([own[c][0].as_py()] * len(block), pa.string())
        return pa.table({"doc_id": block["doc_id"], "leaf": block["leaf"], "subroot": same("subroot"), "root": same("root"), "proof": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})

    kind = dict(leaves.dtypes)["doc_id"]
    return leaves.groupBy("owner", "block").cogroup(blocks.groupBy("owner", "block")).applyInArrow(prove, f"doc_id {kind}, leaf string, subroot string, root string, proof string, folded_root string")


def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, roots and proof, and whether its row, after tampering, still folds to the root."""
    rows = proven(*manifest(table(spark, sf_dir, "documents")))
    return rows.select("doc_id", "leaf", "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"), "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"))


def _sql_field(c: str) -> str:
    return f"coalesce(strlen(({c})::varchar)::varchar || ':' || ({c})::varchar, '-')"


def _sql_leaf(text: str) -> str:
    return "sha256(" + " || ".join(_sql_field(text if c == "text" else c) for c in FIELDS) + ")"


_SQL_CRC = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(doc_id::varchar, ''), lambda c: ascii(c)::bigint)),
    lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""

OP11_SQL = f"""
with recursive d as (
  select row_number() over () as r, doc_id, source, {_sql_leaf("text")} as leaf,
    case when doc_id is not null and text is not null and {_SQL_CRC} % 2 = 0 then {_sql_leaf("replace(text, chr(10), '')")} end as tampered
  from documents),
p as (select *, row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by source) as n from d),
nodes as (
  select source, 0 as lvl, n, pos, leaf as digest from p
  union all
  select source, lvl + 1, (n + 2) // 3, pos // 3, sha256(string_agg(digest, '' order by pos)) from nodes where n > 1 group by source, lvl, n, pos // 3),
sub as (select source, digest as subroot, row_number() over (order by source nulls first) - 1 as pos, count(*) over () as n from nodes where n = 1),
tops as (
  select 0 as lvl, n, pos, subroot as digest from sub
  union all
  select lvl + 1, (n + 2) // 3, pos // 3, sha256(string_agg(digest, '' order by pos)) from tops where n > 1 group by lvl, n, pos // 3),
steps as (
  select p.r, x.lvl, coalesce(string_agg(x.digest, '' order by x.pos) filter (x.pos < p.pos // (3 ** x.lvl)::bigint), '') as b,
    coalesce(string_agg(x.digest, '' order by x.pos) filter (x.pos > p.pos // (3 ** x.lvl)::bigint), '') as a
  from p join nodes x on x.source is not distinct from p.source and x.n > 1 and x.pos // 3 = p.pos // (3 ** x.lvl)::bigint // 3 group by p.r, x.lvl
  union all
  select p.r, 1000 + x.lvl, coalesce(string_agg(x.digest, '' order by x.pos) filter (x.pos < s.pos // (3 ** x.lvl)::bigint), '') as b,
    coalesce(string_agg(x.digest, '' order by x.pos) filter (x.pos > s.pos // (3 ** x.lvl)::bigint), '') as a
  from p join sub s on s.source is not distinct from p.source join tops x on x.n > 1 and x.pos // 3 = s.pos // (3 ** x.lvl)::bigint // 3 group by p.r, x.lvl),
ways as (select r, list({{'b': b, 'a': a, 'cur': ''}} order by lvl) as way, string_agg(b || a, '' order by lvl) as proof from steps group by r),
f as (
  select p.doc_id, p.leaf, s.subroot, (select digest from tops where n = 1) as root, sha256(coalesce(w.proof, '')) as proof_sha256,
    list_reduce(list_concat([{{'b': '', 'a': '', 'cur': coalesce(p.tampered, p.leaf)}}], coalesce(w.way, [])), lambda x, y: {{'b': '', 'a': '', 'cur': sha256(y.b || x.cur || y.a)}}).cur as folded_root
  from p join sub s on s.source is not distinct from p.source left join ways w on w.r = p.r)
select doc_id, leaf, subroot, root, proof_sha256, folded_root, folded_root = root as verified from f
"""
