"""Exact top-k inner products by a bit-sliced index.

Components are quantised to integers. The index holds, for each block of rows, one bitmap per dimension and bit of the
(offset) component. A query adds the slices that its own bits select, by bitmap full adders, into the slices of all
scores at once; the top rows then come from the most significant slice downward, and the rows that tie at the boundary
are resolved by smallest id. Nothing is approximate.

Defined results: vectors that are null, empty, or hold a null or non-finite component take no part; vectors meet only
those of the same length; rows that repeat a vec_id are candidates each, a query id is asked once (its smallest
vector); a query never meets rows of its own id; rows with a null vec_id take no part; other columns are ignored.
Components beyond 64 bits are the nearest long; slices and sums are as wide as they need to be, so ranks are exact for
any sizes; a score beyond 64 bits is returned as the nearest long.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmarket.llm.common import result, scratch, table, written

#: Rows of an index block and queries that are searched at once.
BLOCK_ROWS = 1 << 12
QUERY_ROWS = 128
#: Blocks of op5: rows at most, and bytes of their components. Adders take whole bitmaps, so a wide block costs less a row.
WIDE_ROWS = 1 << 15
WIDE_BYTES = 1 << 24
#: Blocks that a task holds at most.
SET_BLOCKS = 16
SCALE = 1024
K = 10
QUERY_EVERY = 100
#: Bytes of a score as an ordered binary: products of longs, summed over any number of dimensions.
SCORE_BYTES = 24

INDEX_SCHEMA = "dim int, ids binary, n int, planes binary, bits array<int>, low array<long>"


def quantised(vectors: DataFrame, vector: str = "embedding", scale: int = SCALE) -> DataFrame:
    """(vec_id, q array<long>) of the vectors that take part."""
    sound = F.col("vec_id").isNotNull() & (F.size(vector) > 0) & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < float("inf"), F.lit(False)) & ~F.isnan(x))
    q = F.transform(vector, lambda x: F.floor(x.cast("double") * scale).cast("long"))
    return vectors.filter(sound).select(F.col("vec_id").cast("long").alias("vec_id"), q.alias("q"))


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, dim)


def slices_of(ids: np.ndarray, m: np.ndarray) -> dict:
    """The index row of a block: rows by id, a bitmap per dimension and bit of the component above the block's least."""
    order = np.argsort(ids, kind="stable")
    ids, m = ids[order], m[order]
    low = m.min(axis=0)
    m = m.view(np.uint64) - low.view(np.uint64)  # modulo 2**64, so exact over the whole range of longs
    bits = [int(x).bit_length() for x in m.max(axis=0)]
    words = (len(ids) + 63) // 64
    planes = []
    for d, b in enumerate(bits):
        for j in range(b):
            packed = np.zeros(words * 8, np.uint8)
            got = np.packbits(((m[:, d] >> np.uint64(j)) & np.uint64(1)).astype(np.uint8), bitorder="little")
            packed[: len(got)] = got
            planes.append(packed.tobytes())
    return {"dim": m.shape[1], "ids": ids.astype(np.int64).tobytes(), "n": len(ids), "planes": b"".join(planes), "bits": bits, "low": [int(x) for x in low]}


def build_index(vectors: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """A row per block of at most block_rows vectors of one length; no shuffle."""

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        count: dict[int, int] = {}

        def flush(dim: int) -> pa.RecordBatch:
            ids, ms = np.concatenate([x for x, _ in held[dim]]), np.concatenate([x for _, x in held[dim]])
            rows = [slices_of(ids[i : i + block_rows], ms[i : i + block_rows]) for i in range(0, len(ids), block_rows)]
            held.pop(dim), count.pop(dim)
            return pa.RecordBatch.from_pylist(rows, schema=pa.schema([("dim", pa.int32()), ("ids", pa.binary()), ("n", pa.int32()), ("planes", pa.binary()), ("bits", pa.list_(pa.int32())), ("low", pa.list_(pa.int64()))]))

        for batch in batches:
            ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
            lengths = lists.value_lengths().to_numpy(zero_copy_only=False)
            for dim in np.unique(lengths):
                own = np.flatnonzero(lengths == dim)
                dim = int(dim)
                held.setdefault(dim, []).append((ids[own], _matrix(lists.take(pa.array(own)), dim)))
                count[dim] = count.get(dim, 0) + len(own)
                if count[dim] >= block_rows:
                    yield flush(dim)
        for dim in list(held):
            yield flush(dim)

    return vectors.select("vec_id", "q").mapInArrow(build, INDEX_SCHEMA)


def signed_digits(x: int) -> list[tuple[int, int]]:
    """x as a sum of sign * 2**place with no two places in a row: a third of the places instead of half."""
    out, place = [], 0
    while x:
        if x & 1:
            sign = 2 - (x & 3)
            out.append((place, sign))
            x -= sign
        x >>= 1
        place += 1
    return out


def summed_slices(planes: np.ndarray, bits: list[int], q: list[int]) -> tuple[list[np.ndarray], int]:
    """Slices of all rows' scores (least significant first) and the constant to add to them.

    planes: (2 * slices, words), the second half complemented; a negative digit takes complements, so all addends are
    non-negative. Bitmaps of one weight are added three at a time (full adder: sum stays, carry moves up), in place."""
    at = np.concatenate([[0], np.cumsum(bits)]).tolist()
    constant, digits = 0, []
    for d, factor in enumerate(q):
        for place, sign in signed_digits(factor):
            digits.append((place, at[d] + (at[-1] if sign < 0 else 0), bits[d]))
            if sign < 0:
                constant -= ((1 << bits[d]) - 1) << place
    if not any(n for _, _, n in digits):
        return [], constant
    place, first, n = np.array(digits).T
    step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    weight, row = np.repeat(place, n) + step, np.repeat(first, n) + step
    order = np.argsort(weight, kind="stable")
    row, top, words = row[order], int(weight.max()), planes.shape[1]
    cut = np.searchsorted(weight[order], np.arange(top + 2)).tolist()
    spare = np.empty((len(row) // 3 + 1, words), np.uint64)
    out, carried, w = [], [], 0
    while w <= top or carried:
        own = row[cut[w] : cut[w + 1]] if w <= top else row[:0]
        stack, filled = np.empty((len(own) + sum(map(len, carried)), words), np.uint64), len(own)
        np.take(planes, own, axis=0, out=stack[:filled], mode="clip")  # a mode other than raise writes to out directly
        for x in carried:
            stack[filled : filled + len(x)] = x
            filled += len(x)
        carried = []
        while len(stack) > 2:
            n = len(stack) // 3
            a, b, c, odd = stack[:n], stack[n : 2 * n], stack[2 * n : 3 * n], spare[:n]
            np.bitwise_xor(a, b, out=odd)
            a &= b
            np.bitwise_and(odd, c, out=b)
            a |= b
            c ^= odd
            carried.append(a)
            stack = stack[2 * n :]
        if len(stack) == 2:
            carried.append((stack[0] & stack[1])[None])
            out.append(stack[0] ^ stack[1])
        else:
            out.append(stack[0].copy() if len(stack) else np.zeros(words, np.uint64))
        w += 1
    return out, constant


def _positions(bitmap: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.unpackbits(bitmap.view(np.uint8), bitorder="little"))


def _count(bitmap: np.ndarray) -> int:
    return int(np.bitwise_count(bitmap).sum())


def top_rows(slices: list[np.ndarray], among: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k highest scores among the rows of a bitmap; rows that tie at the boundary by lowest position."""
    sure, tied = np.zeros_like(among), among
    for s in reversed(slices):
        both = sure | (tied & s)
        n = _count(both)
        if n > k:
            tied = tied & s
        else:
            sure, tied = both, tied & ~s
            if n == k:
                tied = np.zeros_like(among)
                break
    found = _positions(sure)
    return np.concatenate([found, _positions(tied)[: k - len(found)]]) if len(found) < k else found


def search_block(ids: np.ndarray, planes: np.ndarray, bits: list[int], low: list[int], queries: list[tuple[int, list[int]]], k: int) -> list[tuple[int, int, int, bytes]]:
    """(query id, vec_id, score, ordered score) of the k best rows of a block for each query."""
    words = planes.shape[1]
    both = np.concatenate([planes, ~planes])
    least, most, zero = -(1 << 63), (1 << 63) - 1, 1 << (8 * SCORE_BYTES - 1)
    out = []
    for qid, q in queries:
        among = np.packbits(np.pad(ids != qid, (0, words * 64 - len(ids))), bitorder="little").view(np.uint64)
        slices, constant = summed_slices(both, bits, q)
        rows = top_rows(slices, among, k)
        constant += sum(a * b for a, b in zip(q, low, strict=True))
        score = [constant] * len(rows)
        for w, s in enumerate(slices):
            for i, bit in enumerate(((s[rows >> 6] >> (rows & 63).astype(np.uint64)) & np.uint64(1)).tolist()):
                score[i] += bit << w
        out += [(qid, int(ids[r]), min(max(x, least), most), (x + zero).to_bytes(SCORE_BYTES, "big")) for r, x in zip(rows.tolist(), score, strict=True)]
    return out


def _best(found: list[tuple[int, int, int, bytes]], k: int) -> list[tuple[int, int, int, bytes]]:
    return sorted(found, key=lambda x: (-int.from_bytes(x[3], "big"), x[1]))[:k]


def _answers(blocks: dict[int, list[tuple]], asked: dict[int, list[tuple[int, list[int]]]], k: int, query_rows: int) -> Iterator[tuple[int, int, int, bytes]]:
    """The k best rows of all blocks of a length for each query of that length."""
    for dim, queries in asked.items():
        for i in range(0, len(queries), query_rows):
            best: dict[int, list] = {}
            for block in blocks.get(dim, ()):
                for x in search_block(*block, queries[i : i + query_rows], k):
                    best.setdefault(x[0], []).append(x)
                best = {q: _best(x, k) if len(x) > k else x for q, x in best.items()}
            for x in best.values():
                yield from x


def dealt(index: DataFrame, queries: DataFrame, query_rows: int = QUERY_ROWS) -> DataFrame:
    """Blocks of an index and queries (vec_id, q), dealt to tasks: a task has a set of blocks, then a share of the
    queries. A block goes to as many tasks as there are shares, whatever the number of queries, and a query to one task
    a set, so no block stands beside each query. Sets have at most SET_BLOCKS blocks."""
    index = written(index.withColumn("at", F.monotonically_increasing_id()), "bsi-index")
    queries = queries.groupBy("vec_id").agg(F.min("q").alias("q"))
    blocks, parts = index.count(), int(index.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = min(SET_BLOCKS, max(1, blocks // parts))
    sets = max(1, -(-blocks // each))
    shares = max(1, min(-(-2 * parts // sets), -(-queries.count() // query_rows)))
    within = F.col("at").bitwiseAND(F.lit((1 << 33) - 1))  # its number in its partition; the partition's stands above
    block = index.withColumns({"set": F.pmod(F.shiftright("at", 33) + within, F.lit(sets)), "share": F.explode(F.sequence(F.lit(0), F.lit(shares - 1)))}).drop("at")
    asked = queries.withColumns({"dim": F.size("q"), "set": F.explode(F.sequence(F.lit(0), F.lit(sets - 1))), "share": F.pmod(F.xxhash64("vec_id"), F.lit(shares))})
    rows = block.unionByName(asked, allowMissingColumns=True).withColumn("task", (F.col("set") * shares + F.col("share")).cast("int")).drop("set", "share")
    return rows.repartitionById(sets * shares, "task").sortWithinPartitions("task", F.col("planes").isNull())


def top_k(index: DataFrame, queries: DataFrame, k: int = K, query_rows: int = QUERY_ROWS) -> DataFrame:
    """(query_id, rank, vec_id, score) of the k best rows of the index for each query (vec_id, q).

    A task holds its blocks and meets its queries as they come; at most k rows a query leave it."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, blocks = None, {}

        def answers(asked: dict) -> Iterator[pa.RecordBatch]:
            if cols := list(zip(*_answers(blocks, asked, k, query_rows), strict=True)):
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int64(), pa.binary()), strict=True)], names=["query_id", "vec_id", "score", "ordered"])

        for batch in batches:
            x, asked = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}, {}
            for row, own in enumerate(x["task"].to_pylist()):
                if own != task:
                    yield from answers(asked)
                    task, blocks, asked = own, {}, {}
                dim = x["dim"][row].as_py()
                if x["planes"][row].is_valid:
                    ids, bits = np.frombuffer(x["ids"][row].as_py(), np.int64), x["bits"][row].as_py()
                    planes = np.frombuffer(x["planes"][row].as_py(), np.uint64).reshape(sum(bits), (len(ids) + 63) // 64)
                    blocks.setdefault(dim, []).append((ids, planes, bits, x["low"][row].as_py()))
                else:
                    asked.setdefault(dim, []).append((x["vec_id"][row].as_py(), x["q"][row].as_py()))
            yield from answers(asked)

    found = dealt(index, queries, query_rows).mapInArrow(search, "query_id long, vec_id long, score long, ordered binary")
    best = Window.partitionBy("query_id").orderBy(F.desc("ordered"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 highest integer inner products of every query row (vec_id divisible by 100) with all other rows. Rows are
    dealt evenly to as many tasks as there are to be blocks, however the files are cut."""
    rows = table(spark, sf_dir, "embeddings")
    n, longest = rows.agg(F.count("*"), F.max(F.size("embedding"))).first()
    wide = max(1, min(WIDE_ROWS, WIDE_BYTES // (8 * max(longest or 1, 1))))
    vectors, asked = quantised(rows), quantised(rows.filter(F.col("vec_id") % QUERY_EVERY == 0))
    with scratch(spark):
        index = build_index(vectors.repartition(max(1, -(-n // wide))), 2 * wide)
        return result(top_k(index, asked), "top-k")


OP5_SQL = """
with v as (
  select vec_id, list_transform(embedding, lambda x: floor(x::double * 1024)::bigint) as q from embeddings
  where len(embedding) > 0 and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.vec_id as query_id, b.vec_id, list_sum(list_transform(range(1, len(a.q) + 1), lambda i: a.q[i] * b.q[i]))::bigint as score
  from v a join v b on a.vec_id % 100 = 0 and a.vec_id <> b.vec_id and len(a.q) = len(b.q)),
r as (select query_id, row_number() over (partition by query_id order by score desc, vec_id)::int as rank, vec_id, score from s)
select query_id, rank, vec_id, score from r where rank <= 10
"""
