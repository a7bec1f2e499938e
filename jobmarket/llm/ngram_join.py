"""Near-duplicate documents by an exact n-gram Jaccard join: grouped prefix join.

A document is the set of its distinct word shingles; two link when their Jaccard similarity reaches THRESHOLD.

1. Statistics. One pass counts all shingles of all documents in a sketch of 2**18 cells (a table of fixed size). Cells
   well above the background hold frequent shingles; the order of shingles is by this class, then by hash, so that
   frequent shingles come last and prefixes hold rare ones.
2. Groups. Two sets that reach the threshold share a shingle among the first n - ceil(t n) + 1 of each, their prefixes.
   Documents with equal sets are collapsed to one member; members with identical prefixes and size form one group, and
   only groups post their shingles. Shingles that stand in one prefix only are dropped in the tasks that gather them.
3. Stars. Per shared shingle, the most typical group (fewest rare shingles) is the pivot; every group is compared with
   the pivot that it shares most shingles with, and every member with the one that stands for its group: as many
   comparisons as members.
4. The rest. Groups that share a prefix shingle are expanded into members; members of different components are all
   compared: filtered by size and by what is left of their sets behind the first shared shingle, then verified exactly
   on whole sets; so are members of one group that are not yet connected. Pairs inside a component are left out, since
   they cannot change it; all others are verified, so components are exact. A few rounds compare each member with one
   partner first, so that large families connect with few comparisons. Before sets are shipped, small and then larger
   profiles (tokens per cell of a hash) rule out the pairs whose intersection cannot be large enough.

Frequent shingles are salted by their class where a task gathers posting lists; pivots are minima, combined per task,
and joins on tokens leave it to Spark to split a frequent one. Components come from contracting the graph of
links, on tables, and links found later are added to the components known by then; nothing that grows with the corpus
reaches the driver.

Defined results: null, blank and empty texts have an empty set and link with nothing; rows that repeat a doc_id are one
node, linked through any of its texts; rows with a null doc_id are their own component (null) and take no part; other
columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import BROADCAST_ROWS, Rolling, result, scratch, table, text_blocks, written
from jobmarket.llm.words import shingle_sets

SHINGLE = 5
#: The threshold as a fraction.
NUMERATOR, DENOMINATOR = 3, 4
SKETCH_BITS = 18
SKETCH_SLICES = 16
#: Bits of a shingle's class in its 64-bit token; the rest is hash.
CLASS_BITS = 5
#: Rounds that compare each node with one partner before all pairs that are left are compared.
PIVOT_ROUNDS = 2
#: Posting lists of a class are split in 2**max(0, class - FIRST_SALTED) parts.
FIRST_SALTED = 8

#: Cells of the profiles that bound an intersection from above: of all documents, and of those in candidate pairs.
PROFILE, FINE = 256, 4096

SETS = "doc_id long, n int, d1 long, d2 long, p1 long, p2 long, rare int, prefix array<long>, profile binary"


def sketch(docs: DataFrame, shingle: int = SHINGLE) -> np.ndarray:
    """Occurrences of all shingles of all documents per cell. Tasks send SKETCH_SLICES rows of a fixed size each,
    which are summed in two rounds; the driver gets 2**SKETCH_BITS counts."""
    rolling, size = Rolling(), 1 << SKETCH_BITS
    schema = "slice int, part int, counts binary"

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, rows = np.zeros(size, np.int64), 0
        for batch in batches:
            rows += batch.num_rows
            for _, data, off in text_blocks(batch, "text"):
                sets = shingle_sets(data, off, rolling, shingle)
                total += np.bincount((np.concatenate(sets) & np.uint64(size - 1)).astype(np.int64), minlength=size)
        parts = np.array_split(total, SKETCH_SLICES)
        yield pa.RecordBatch.from_arrays([pa.array(range(SKETCH_SLICES), pa.int32()), pa.array([rows % 61] * SKETCH_SLICES, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["slice", "part", "counts"])

    def add(group: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x.as_py(), np.int64) for x in group.column("counts"))
        return pa.table({"slice": group.column("slice")[:1], "part": pa.array([0], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())})

    slices = docs.select("text").mapInArrow(count, schema)
    for keys in (["slice", "part"], ["slice"]):
        slices = slices.groupBy(*keys).applyInArrow(add, schema)
    rows = sorted(slices.collect(), key=lambda r: r["slice"])
    return np.concatenate([np.frombuffer(bytes(r["counts"]), np.int64) for r in rows]) if rows else np.zeros(size, np.int64)


def classes_of(counts: np.ndarray) -> np.ndarray:
    """Class of each cell: 0 in the background, else the bit length of its excess over it."""
    middle = float(np.median(counts))
    excess = counts - middle
    out = np.zeros(len(counts), np.uint8)
    over = excess > 8 * np.sqrt(middle) + 8
    out[over] = np.minimum(np.log2(excess[over]).astype(np.uint8) + 1, (1 << CLASS_BITS) - 1)
    return out


def prefix_length(n: np.ndarray | int) -> np.ndarray | int:
    return n - (NUMERATOR * n + DENOMINATOR - 1) // DENOMINATOR + 1


def _tokens(sets: list[np.ndarray], classes: np.ndarray) -> list[np.ndarray]:
    """Shingles as sorted tokens: class first, then hash."""
    top, mask = np.uint64(63 - CLASS_BITS), np.uint64(len(classes) - 1)
    return [np.sort((classes[(s & mask).astype(np.int64)].astype(np.uint64) << top) | (s >> np.uint64(CLASS_BITS + 1))).astype(np.int64) for s in sets]


def described(docs: DataFrame, classes: np.ndarray, shingle: int = SHINGLE, whole: bool = False) -> DataFrame:
    """(doc_id, n, d1, d2, p1, p2, rare, prefix, profile): set size, digests of the set and of its prefix, shingles of
    class 0, the set's first tokens (all of them if whole), and the number of its tokens per cell of a hash."""
    rolling = Rolling()

    def digests(sets: list[np.ndarray]) -> list[pa.Array]:
        with np.errstate(over="ignore"):
            u = [s.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) for s in sets]
            d1 = [int((x ^ (x >> np.uint64(29))).sum(dtype=np.uint64).astype(np.int64)) for x in u]
            d2 = [int(((x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)).sum(dtype=np.uint64).astype(np.int64)) for x in u]
        return [pa.array(d1, pa.int64()), pa.array(d2, pa.int64())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, data, off in text_blocks(batch, "text"):
                sets = _tokens(shingle_sets(data, off, rolling, shingle), classes)
                n = np.array([len(s) for s in sets], np.int32)
                rare = [int(np.searchsorted(s, 1 << (63 - CLASS_BITS))) for s in sets]
                prefixes = [s[: prefix_length(len(s))] if len(s) else s for s in sets]
                kept = sets if whole else prefixes
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(k) for k in kept])]), pa.int32()), pa.array(np.concatenate(kept)))
                cells = FINE if whole else PROFILE
                profiles = pa.array([np.minimum(np.bincount(s & (cells - 1), minlength=cells), 255).astype(np.uint8).tobytes() for s in sets], pa.binary())
                yield pa.RecordBatch.from_arrays([batch.column(0)[span], pa.array(n), *digests(sets), *digests(prefixes), pa.array(rare, pa.int32()), lists, profiles], names=["doc_id", "n", "d1", "d2", "p1", "p2", "rare", "prefix", "profile"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, SETS)


def salt(token: Column, other: Column) -> Column:
    """The part of a token's posting list that a member belongs to."""
    cls = F.shiftright(token, 63 - CLASS_BITS)
    parts = F.pow(F.lit(2.0), F.greatest(cls - FIRST_SALTED, F.lit(0))).cast("long")
    return F.pmod(F.xxhash64(other), parts).cast("int")


def postings(groups: DataFrame) -> DataFrame:
    """(token, node, n, rare, place) of the prefix tokens that more than one group (doc_id, n, rare, prefix) holds."""
    rows = groups.select(F.col("doc_id").alias("node"), "n", "rare", F.posexplode("prefix").alias("place", "token"))
    rows = rows.select("token", "node", "n", "rare", "place")
    partitions = int(groups.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come by token; of a token that may stand alone only its first row is held back."""
        last, alone = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            token = batch.column(0).to_numpy()
            same = token[1:] == token[:-1]
            keep = np.concatenate([[False], same]) | np.concatenate([same, [False]])
            # Frequent tokens are split: a group alone in its part may have company in another.
            keep |= (token >> np.int64(63 - CLASS_BITS)) > FIRST_SALTED
            if last == token[0]:
                keep[0] = True
                if alone is not None:
                    yield alone
            last, alone = token[-1], None if keep[-1] else batch.slice(batch.num_rows - 1)
            yield batch.filter(pa.array(keep))

    dealt = rows.repartition(partitions, "token", salt(F.col("token"), F.col("node"))).sortWithinPartitions("token")
    return dealt.mapInArrow(shared, "token long, node long, n int, rare int, place int")


def possible(pairs: DataFrame, profiles: DataFrame) -> DataFrame:
    """The pairs (a, b) whose profiles allow the threshold: an intersection is at most the sum over cells of the smaller
    number (cells that are full count as unbounded). profiles: (node, n, profile)."""
    left = profiles.select(F.col("node").alias("a"), F.col("n").alias("na"), F.col("profile").alias("x"))
    right = profiles.select(F.col("node").alias("b"), F.col("n").alias("nb"), F.col("profile").alias("y"))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for i in (2, 3))
            most = np.minimum(x, y).sum(axis=1, dtype=np.int64)
            n = batch.column(4).to_numpy().astype(np.int64) + batch.column(5).to_numpy()
            full = (x == 255).any(axis=1) & (y == 255).any(axis=1)
            fits = full | ((DENOMINATOR + NUMERATOR) * most >= NUMERATOR * n)
            yield batch.select([0, 1]).filter(pa.array(fits))

    both = pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y", "na", "nb")
    return both.mapInArrow(keep, "a long, b long").distinct()


def similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) whose whole sets reach the threshold; sets: (node, tokens)."""
    left, right = sets.select(F.col("node").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("node").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    inter = F.size(F.array_intersect("x", "y"))
    union = F.size("x") + F.size("y") - inter
    return both.filter(DENOMINATOR * inter.cast("long") >= NUMERATOR * union).select("a", "b").distinct()


def counted(df: DataFrame, label: str) -> tuple[DataFrame, int]:
    """As written, with the number of rows, counted as they are written."""
    count = Observation()
    return written(df.observe(count, F.count(F.lit(1)).alias("n")), label), count.get["n"]


def components(edges: DataFrame, label: str = "links", known: DataFrame | None = None) -> DataFrame:
    """(node, comp) of the nodes of edges (a, b) and of known, components found before that edges may join: comp is the
    smallest node that is reachable.

    Each round contracts the graph: a node goes to the first of itself and its neighbours in an order, then to where that
    one goes, and only edges between different nodes are left. The order is by links, most first, in every other round, so
    that a star folds at once whatever its size; ties and the rounds between go by a hash that differs from round to round,
    so that long chains fold as fast as others. Each round is two written tables, smaller than those before."""
    maps = []

    def moved(edges: DataFrame, up: DataFrame) -> DataFrame:
        """The edges between the nodes that their ends go to."""
        side = lambda c: up.select(F.col("node").alias(c), F.col("up").alias(f"_{c}"))
        both = edges.select("a", "b").join(side("a"), "a", "left").join(side("b"), "b", "left")
        return both.select(F.coalesce("_a", "a").alias("a"), F.coalesce("_b", "b").alias("b"))

    def apart_only(edges: DataFrame) -> tuple[DataFrame, int]:
        ends = edges.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
        return counted(ends, label)

    first = None if known is None else known.select("node", F.col("comp").alias("up"))
    left, n = apart_only(edges if first is None else moved(edges, first))
    while n:
        order = lambda c, links, salt=len(maps): F.struct((-links).alias("k"), F.xxhash64(F.col(c), F.lit(salt)).alias("h"), F.col(c).alias("v"))
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        own = of_b = F.lit(0).cast("long")
        if len(maps) % 2 == 0:
            both = both.join(both.groupBy(F.col("a").alias("b")).agg(F.count("*").alias("links")), "b")
            own, of_b = F.count("*"), F.col("links")
        to = both.groupBy(F.col("a").alias("node")).agg(own.alias("own"), F.min(order("b", of_b)).alias("m")).select("node", F.least(order("node", F.col("own")), "m")["v"].alias("up"))
        up = written(to.join(to.select(F.col("node").alias("up"), F.col("up").alias("top")), "up").select("node", F.col("top").alias("up")), label)
        maps.append(up)
        left, n = apart_only(moved(left, up))
    found = None
    for up in maps:
        on = up.select(F.col("node").alias("up"), F.col("up").alias("top"))
        found = up if found is None else found.join(on, "up", "left").select("node", F.coalesce("top", "up").alias("up"))
    if found is None:
        return known if known is not None else left.select(F.col("a").alias("node"), F.col("b").alias("comp"))
    if first is not None:
        # Nodes of found that no component had are new; those that gave a component its name take all of it along.
        on = found.select(F.col("node").alias("old"), F.col("up").alias("top"))
        found = first.join(on, first["up"] == on["old"], "full").select(F.coalesce("node", "old").alias("node"), F.coalesce("top", "up").alias("up"))
    least = found.groupBy("up").agg(F.min("node").alias("comp"))
    return written(found.join(least, "up").select("node", "comp"), label)


def _near_size(a: Column, b: Column) -> Column:
    return DENOMINATOR * F.least(a, b) >= NUMERATOR * F.greatest(a, b)


def star_pairs(post: DataFrame) -> DataFrame:
    """(a, b): each member with the pivot of the posting lists it shares, the one it shares most tokens with."""
    typical = F.struct((F.col("rare") / F.col("n")).alias("r"), "node", "n")
    pivot = post.groupBy("token").agg(F.min(typical).alias("p"))
    pairs = post.join(pivot, "token").filter((F.col("node") != F.col("p.node")) & _near_size(F.col("n"), F.col("p.n")))
    counted = pairs.groupBy(F.col("node").alias("a"), F.col("p.node").alias("b")).agg(F.count("*").alias("k"))
    return counted.groupBy("a").agg(F.max(F.struct("k", "b")).alias("m")).select("a", F.col("m.b").alias("b"))


def unconnected_pairs(post: DataFrame, comp: DataFrame) -> DataFrame:
    """Candidate pairs (a, b) of different components: shared prefix token, sizes near enough, and enough tokens left
    after the first shared one to reach the threshold."""
    p = post.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = p.groupBy("token").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("token")
    p = p.join(mixed, "token", "left_semi").select("token", "node", "comp", "n", "place")
    a, b = p.alias("a"), p.alias("b")
    left = F.least(F.col("a.n") - F.col("a.place"), F.col("b.n") - F.col("b.place"))
    enough = (DENOMINATOR + NUMERATOR) * left >= NUMERATOR * (F.col("a.n") + F.col("b.n"))
    # At the first token that a pair shares, its intersection is at most what is left of either set from there on; so a
    # pair that can reach the threshold passes at that token, and tokens further on need not bring it again.
    near = (F.col("a.comp") != F.col("b.comp")) & _near_size(F.col("a.n"), F.col("b.n")) & enough
    pairs = a.join(b, (F.col("a.token") == F.col("b.token")) & (F.col("a.node") < F.col("b.node")) & near)
    return pairs.select(F.col("a.node").alias("a"), F.col("b.node").alias("b")).distinct()


def unconnected_inside(inside: DataFrame, comp: DataFrame) -> DataFrame:
    """Pairs (a, b) of members of one group in different components; inside: members (a) and the one that stands for
    their group (b). Groups that are connected as a whole bring no pair."""
    m = inside.select(F.col("b").alias("g"), F.col("a").alias("node")).unionByName(inside.select(F.col("b").alias("g"), F.col("b").alias("node")).distinct())
    m = m.join(comp, "node", "left").withColumn("comp", F.coalesce("comp", "node"))
    mixed = m.groupBy("g").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi")).filter("lo <> hi").select("g")
    m = m.join(mixed, "g", "left_semi")
    x, y = m.alias("x"), m.alias("y")
    pairs = x.join(y, (F.col("x.g") == F.col("y.g")) & (F.col("x.node") < F.col("y.node")) & (F.col("x.comp") != F.col("y.comp")))
    return pairs.select(F.col("x.node").alias("a"), F.col("y.node").alias("b"))


def apart(pairs: DataFrame, comp: DataFrame) -> DataFrame:
    """The pairs of different components."""
    side = lambda c: comp.select(F.col("node").alias(c), F.col("comp").alias(f"_{c}"))
    both = pairs.join(side("a"), "a", "left").join(side("b"), "b", "left")
    return both.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    docs = docs.select("doc_id", "text")
    with scratch(docs.sparkSession):
        return result(_near_duplicates(docs, shingle), "components")


def _near_duplicates(docs: DataFrame, shingle: int) -> DataFrame:
    classes = classes_of(sketch(docs, shingle))
    d = written(described(docs, classes, shingle), "sets")
    sound = d.filter("doc_id is not null and n > 0")
    equal = ["n", "d1", "d2"]
    first = sound.groupBy(*equal).agg(F.min("doc_id").alias("b"), F.count("*").alias("copies")).filter("copies > 1")
    same = sound.select(F.col("doc_id").alias("a"), *equal).join(first, equal).select("a", "b").filter("a <> b")
    alike = ["n", "p1", "p2"]
    groups = sound.groupBy(*alike).agg(F.min(F.struct("doc_id", "rare", "prefix")).alias("m"))
    post = written(postings(groups.select("m.doc_id", "n", "m.rare", "m.prefix")), "postings")
    members = sound.groupBy(*equal).agg(F.min(F.struct("doc_id", "p1", "p2")).alias("m")).select("n", "m.*")
    several = members.groupBy(*alike).agg(F.min("doc_id").alias("b"), F.count("*").alias("size")).filter("size > 1")
    inside = written(members.join(several, alike).select(F.col("doc_id").alias("a"), "b").filter("a <> b"), "inside")
    nodes_of = lambda pairs: pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct()

    def keys_of(nodes: DataFrame) -> DataFrame:
        keys, n = counted(nodes, "nodes")
        return F.broadcast(keys) if n <= BROADCAST_ROWS else keys

    def profiles_of(nodes: DataFrame) -> DataFrame:
        own = keys_of(nodes)
        return sound.select(F.col("doc_id").alias("node"), "n", "profile").join(own, "node", "left_semi")

    def sets_of(nodes: DataFrame) -> DataFrame:
        """Whole sets and fine profiles (node, n, tokens, profile) of some documents, read again from their texts."""
        own = keys_of(nodes.select(F.col("node").alias("doc_id")))
        return written(described(docs.join(own, "doc_id", "left_semi"), classes, shingle, whole=True).filter("n > 0").select(F.col("doc_id").alias("node"), "n", F.col("prefix").alias("tokens"), "profile"), "whole")

    pairs = written(star_pairs(post).unionByName(inside), "stars")
    pairs = written(possible(pairs, profiles_of(nodes_of(pairs))), "star-candidates")
    sets = sets_of(nodes_of(pairs))
    star = written(similar(possible(pairs, sets), sets), "star-links")
    comp = components(star)
    of_members = post.unionByName(post.join(inside, F.col("node") == F.col("b")).select("token", F.col("a").alias("node"), "n", "rare", "place"))
    rest = written(unconnected_pairs(of_members, comp).unionByName(unconnected_inside(inside, comp)).distinct(), "pairs")
    rest = written(possible(rest, profiles_of(nodes_of(rest))), "candidates")
    sets = sets.unionByName(sets_of(nodes_of(rest).join(sets.select("node"), "node", "left_anti")))
    rest = written(possible(rest, sets), "candidates")
    for _ in range(PIVOT_ROUNDS):
        # Each node with one partner; what becomes connected need not be compared any more.
        some = written(rest.groupBy("a").agg(F.min("b").alias("b")), "some")
        comp = components(similar(some, sets), known=comp)
        rest = written(apart(rest.join(some, ["a", "b"], "left_anti"), comp), "candidates")
    comp = components(similar(rest, sets).unionByName(same), known=comp)
    out = d.select("doc_id", F.col("n").cast("long").alias("n_shingles")).join(comp.withColumnRenamed("node", "doc_id"), "doc_id", "left")
    return out.select("doc_id", "n_shingles", F.coalesce("comp", "doc_id").alias("component_id"))


def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its set size and component."""
    return near_duplicates(table(spark, sf_dir, "documents"))


OP6_SQL = f"""
with recursive w as (
  select doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') as ws
  from documents),
s as (
  select distinct doc_id, unnest(case when len(ws) = 0 then [] when len(ws) < {SHINGLE} then [array_to_string(ws, ' ')]
    else list_transform(range(1, len(ws) - {SHINGLE - 2}), lambda i: array_to_string(ws[i:i + {SHINGLE - 1}], ' ')) end) as g from w),
n as (select doc_id, count(*) as n from s group by doc_id),
p as (select a.doc_id as x, b.doc_id as y, count(*) as k from s a join s b on a.g = b.g and a.doc_id < b.doc_id group by 1, 2),
links as (select x, y from p join n a on a.doc_id = x join n b on b.doc_id = y where 100 * k >= 75 * (a.n + b.n - k)),
sym as (select x, y from links union all select y, x from links),
reach(doc_id, r) as (select doc_id, doc_id from documents union select reach.doc_id, sym.y from reach join sym on reach.r = sym.x)
select d.doc_id, coalesce(n.n, 0)::bigint as n_shingles, (select min(r) from reach where reach.doc_id = d.doc_id) as component_id
from documents d left join n on d.doc_id = n.doc_id
"""
