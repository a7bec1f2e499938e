"""Substring deduplication by merging shard Burrows-Wheeler transforms.

Every byte is removed that is covered by a string of SPAN bytes which also starts anywhere else in the corpus.

1. Whole texts that repeat are recognised by digest; one of each group stands for it in the rest.
2. Candidates. Every SPAN-byte string is assigned its least GRAM-byte substring (by hash, leftmost): equal strings are
   assigned equal ones. Runs of starts with the same assignment form a segment (its text is the union of their
   strings). Only segments whose assigned substring occurs again anywhere can hold repeated strings.
3. Shards. Segments meet by assigned substring, so equal strings meet. Their texts are read as strings over BLOCK-byte
   symbols, at every byte offset; each shard of segments gets its Burrows-Wheeler transform (the symbol before each
   suffix, in suffix order up to DEPTH symbols, which is SPAN bytes).
4. Merge. The interleave of the shards' transforms starts as one shard after the other and is refined DEPTH times: in
   the interleave's order, every suffix moves to the bucket of its preceding symbol (a stable counting placement, no
   suffix is sorted again). The round in which neighbours part first is their common prefix; runs of suffixes whose
   common prefixes reach DEPTH are the repeated strings.

Texts are UTF-8 bytes. Groups stream through a task in order, so it holds one group and HELD_BYTES at most. A group of
segments under one substring that exceeds HOT is split by the segments' digests; the parts are merged each on its own,
and the windows of such groups are then also counted across the parts by digest, so nothing is lost.

Defined results: a null text is empty; texts under SPAN bytes lose nothing; rows that repeat a doc_id and text are
occurrences each (their text repeats); rows with a null doc_id take part like others; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import Rolling, binary_column, mix, null_safe_join, result, scratch, table, text_blocks, written

SPAN = 400
GRAM = 200
BLOCK = 100
DEPTH = SPAN // BLOCK
#: Segments under one substring that one task merges at most; positions that a shard's transform and a merge cover.
HOT = 1 << 15
SHARD = 1 << 17
AT_ONCE = 1 << 21
HELD_BYTES = 1 << 26

KEY = ["doc_id", "t"]


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, t, text): t tells texts of one doc_id apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))


def assigned(data: np.ndarray, off: np.ndarray, rolling: Rolling) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Segments of consecutive texts in one byte array: (row, first start, last start, hash of the assigned substring)."""
    n = len(data) - SPAN + 1
    empty = np.empty(0, np.int64)
    if n <= 0:
        return empty, empty, empty, np.empty(0, np.uint64)
    h = mix(rolling.windows(rolling.prefix(data), GRAM))
    place = np.uint64(28)
    key = (h >> place << place) | np.arange(len(h), dtype=np.uint64)
    width, m = 1, key
    wanted = SPAN - GRAM + 1
    while 2 * width <= wanted:
        m = np.minimum(m[: len(m) - width], m[width:])
        width *= 2
    m = np.minimum(m[:n], m[wanted - width : wanted - width + n])
    at = (m & ((np.uint64(1) << place) - np.uint64(1))).astype(np.int64)
    rows = np.repeat(np.arange(len(off) - 1), np.diff(off))[:n]
    valid = np.arange(n) + SPAN <= off[rows + 1]
    starts = np.flatnonzero(valid)
    if not len(starts):
        return empty, empty, empty, np.empty(0, np.uint64)
    new = np.concatenate([[True], (np.diff(starts) != 1) | (np.diff(at[starts]) != 0)])
    first = starts[new]
    last = starts[np.concatenate([np.flatnonzero(new)[1:] - 1, [len(starts) - 1]])]
    return rows[first], first, last, h[at[first]]


def fingerprints(keyed: DataFrame) -> DataFrame:
    """(doc_id, t, n, sha, d1, d2, fps): size and digests of the text, the assigned substrings, those that the text
    assigns at several places twice."""
    rolling = Rolling()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, data, off in text_blocks(batch, "text"):
                rows, _, _, h = assigned(data, off, rolling)
                at = np.searchsorted(rows, np.arange(len(off)))
                lists = []
                for r in range(len(off) - 1):
                    own, times = np.unique(h[at[r] : at[r + 1]], return_counts=True)
                    lists.append(np.concatenate([own, own[times > 1]]).astype(np.int64))
                raw = [data[off[r] : off[r + 1]].tobytes() for r in range(len(off) - 1)]
                d = np.frombuffer(b"".join(hashlib.blake2b(x, digest_size=16).digest() for x in raw), np.int64).reshape(-1, 2)
                flat = pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in lists])]), pa.int32()), pa.array(np.concatenate(lists)))
                yield pa.RecordBatch.from_arrays([batch.column(0)[span], batch.column(1)[span], pa.array(np.diff(off)), pa.array([hashlib.sha256(x).hexdigest() for x in raw]), pa.array(d[:, 0]), pa.array(d[:, 1]), flat], names=["doc_id", "t", "n", "sha", "d1", "d2", "fps"])

    return keyed.select("doc_id", "t", "text").mapInArrow(run, "doc_id long, t long, n long, sha string, d1 long, d2 long, fps array<long>")


def segments(candidates: DataFrame) -> DataFrame:
    """Segments (doc_id, t, a, b, fp, held, g1, g2, nth, body) of texts with their candidate substrings (cands: fp,
    held). body comes with the first of equal segments in a task; nth counts them up to 3."""
    rolling = Rolling()
    schema = "doc_id long, t long, a int, b int, fp long, held long, g1 long, g2 long, nth int, body binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            ids, ts = batch.column(0), batch.column(1)
            cands = batch.column(batch.schema.get_field_index("cands")).to_pylist()
            for span, data, off in text_blocks(batch, "text"):
                rows, first, last, h = assigned(data, off, rolling)
                out: list[tuple] = []
                h, at, text = h.astype(np.int64), np.searchsorted(rows, np.arange(len(off))), data.tobytes()
                for r in range(len(off) - 1):
                    held = {c["fp"]: c["held"] for c in cands[span.start + r]}
                    for i in (at[r] + np.flatnonzero(np.isin(h[at[r] : at[r + 1]], np.fromiter(held, np.int64, len(held))))).tolist():
                        a, b, fp = int(first[i]), int(last[i]), int(h[i])
                        body = text[a : b + SPAN]
                        g = hashlib.blake2b(body, digest_size=16).digest()
                        nth = seen.get(g, 0) + 1
                        if len(seen) > 1_000_000:
                            seen.clear()
                        seen[g] = min(nth, 3)
                        out.append((span.start + r, a - int(off[r]), b - int(off[r]), fp, held[fp], *np.frombuffer(g, np.int64).tolist(), min(nth, 3), body if nth == 1 else None))
                if out:
                    c = list(zip(*out, strict=True))
                    take = pa.array(c[0], pa.int64())
                    yield pa.RecordBatch.from_arrays([ids.take(take), ts.take(take), *(pa.array(x, k) for x, k in zip(c[1:], (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary()), strict=True))], names=["doc_id", "t", "a", "b", "fp", "held", "g1", "g2", "nth", "body"])

    return candidates.select("doc_id", "t", "text", "cands").mapInArrow(run, schema)


def ranks(symbols: list[np.ndarray]) -> list[np.ndarray]:
    """The symbols of several arrays as small numbers of equal order; 0 stays 0."""
    known, at = np.unique(np.concatenate([np.zeros(1, np.uint64), *symbols]), return_inverse=True)
    bounds = np.cumsum([len(s) for s in symbols])[:-1]
    return np.split(at[1:].astype(np.uint32), bounds)


def placement(keys: np.ndarray) -> np.ndarray:
    """Stable placement by numbers below 2**32, by counting: numpy's stable sort of 16-bit keys is a radix sort."""
    order = np.argsort((keys & 0xFFFF).astype(np.uint16), kind="stable")
    if keys.max(initial=0) >> 16:
        order = order[np.argsort((keys >> 16).astype(np.uint16)[order], kind="stable")]
    return order


class Shard:
    """Segments' texts over BLOCK-byte symbols and their Burrows-Wheeler transform.

    Every position of a segment (its end included) starts a suffix of symbols: the blocks at it and at each BLOCK bytes
    further. Suffixes without a whole block are ends (symbol 0, first in order). order: positions in suffix order up to
    DEPTH symbols; bwt: the symbol before each, 0 where none is."""

    def __init__(self, bodies: list[bytes], rolling: Rolling) -> None:
        size = np.array([len(b) + 1 for b in bodies], np.int64)
        data = np.frombuffer(b"\0".join(bodies) + b"\0", np.uint8)
        self.off = np.concatenate([[0], np.cumsum(size)])
        self.inside = np.arange(len(data)) - np.repeat(self.off[:-1], size)
        self.left = np.repeat(size, size) - 1 - self.inside
        symbol = np.zeros(len(data), np.uint64)
        blocks = mix(rolling.windows(rolling.prefix(data), BLOCK))
        symbol[: len(blocks)] = blocks | np.uint64(1)
        symbol[self.left < BLOCK] = 0
        order, (rank,) = np.arange(len(data)), ranks([symbol])
        for d in range((DEPTH - 1) * BLOCK, -1, -BLOCK):
            key = np.where(self.left[order] >= d, rank[np.minimum(order + d, len(data) - 1)], 0)
            order = order[placement(key)]
        self.order = order
        self.bwt = np.where(self.inside[order] >= BLOCK, symbol[np.maximum(order - BLOCK, 0)], np.uint64(0))


def refine(shards: list[Shard]) -> tuple[np.ndarray, np.ndarray]:
    """Merges transforms by iterative refinement of their interleave.

    Returns the interleave (shard of each merged suffix) and the common prefix with the suffix before it, in symbols
    (DEPTH: at least that many). Suffixes that agree on some symbols keep their places as a run while later rounds
    refine it, so a boundary stays where the first round put it. Every segment has BLOCK suffixes without a symbol
    before them and as many ends; the ends keep their places at the front."""
    z = np.repeat(np.arange(len(shards)), [len(s.bwt) for s in shards])
    ends = np.repeat(np.arange(len(shards)), [BLOCK * (len(s.off) - 1) for s in shards])
    bwt = ranks([s.bwt for s in shards])
    block = np.zeros(len(z), np.int64)
    common = np.full(len(z), DEPTH, np.int64)
    for depth in range(DEPTH):
        c = np.empty(len(z), np.uint32)
        for k in range(len(shards)):
            c[z == k] = bwt[k]
        moving = np.flatnonzero(c)
        moving = moving[placement(c[moving])]
        c, block = np.concatenate([np.zeros(len(ends), np.uint32), c[moving]]), np.concatenate([np.zeros(len(ends), np.int64), block[moving]])
        z = np.concatenate([ends, z[moving]])
        parts = np.concatenate([[True], (c[1:] != c[:-1]) | (block[1:] != block[:-1])])
        common[parts & (common == DEPTH)] = depth
        block = np.cumsum(parts)
    return z, common


def repeated_starts(bodies: list[bytes], rolling: Rolling) -> list[np.ndarray]:
    """Per segment the starts (of SPAN-byte strings) that occur in it or another of the segments again."""
    shards, part, size = [], [], 0
    bounds = [0]
    for i, b in enumerate(bodies):
        part.append(b)
        size += len(b)
        if size >= SHARD or i + 1 == len(bodies):
            shards.append(Shard(part, rolling))
            bounds.append(i + 1)
            part, size = [], 0
    starts, ids, base = [], [], 0
    intervals = merged_intervals(shards)
    for k, s in enumerate(shards):
        starts.append(np.where(s.left >= SPAN, intervals[k], -1))
        ids.append(np.repeat(np.arange(len(s.off) - 1) + base, np.diff(s.off)))
        base += len(s.off) - 1
    flat, seg, inside = np.concatenate(starts), np.concatenate(ids), np.concatenate([s.inside for s in shards])
    full = np.flatnonzero(flat >= 0)
    times = np.bincount(flat[full], minlength=1)
    hit = full[times[flat[full]] > 1]
    at = np.searchsorted(seg[hit], np.arange(len(bodies) + 1))
    return [inside[hit[at[i] : at[i + 1]]] for i in range(len(bodies))]


def merged_intervals(shards: list[Shard]) -> list[np.ndarray]:
    """Per shard and position the run of suffixes with a common prefix of DEPTH symbols that its suffix falls in."""
    z, common = refine(shards)
    interval = np.cumsum(common < DEPTH)
    out = []
    for k, s in enumerate(shards):
        mine = np.empty(len(s.order), np.int64)
        mine[s.order] = interval[z == k]
        out.append(mine)
    return out


def _runs(starts: np.ndarray) -> list[int]:
    """First and last+1 of each run of consecutive numbers."""
    starts = np.sort(starts)
    parts = np.flatnonzero(np.diff(starts) != 1) + 1
    return np.stack([starts[np.concatenate([[0], parts])], starts[np.concatenate([parts - 1, [len(starts) - 1]])] + 1], axis=1).ravel().tolist()


def merge_part(found: pa.Table, rolling: Rolling) -> Iterator[pa.RecordBatch]:
    """Repeated starts of one task's segments (fp, held, g1, g2, nth, body), group by group of substrings.

    Rows (g1, g2, runs, w1, w2): first and last+1 of each run of repeated starts, w1 and w2 null; for groups that are
    split over tasks, every window comes as a run with its digest too, to be counted across the parts."""
    fp = found.column("fp").to_numpy()
    found = found.take(pa.array(np.lexsort((found.column("g2").to_numpy(), found.column("g1").to_numpy(), fp))))
    fp, g1, g2, held = (found.column(c).to_numpy() for c in ("fp", "g1", "g2", "held"))
    new = np.concatenate([[True], (g1[1:] != g1[:-1]) | (g2[1:] != g2[:-1]) | (fp[1:] != fp[:-1])]) if len(fp) else np.empty(0, bool)
    firsts = np.flatnonzero(new)
    times = np.diff(np.concatenate([firsts, [len(fp)]]))
    bodies_col = found.column("body").combine_chunks()
    rows_with_body = np.flatnonzero(~np.asarray(bodies_col.is_null()))
    body_row = rows_with_body[np.searchsorted(rows_with_body, firsts)] if len(firsts) else firsts
    i = 0
    while i < len(firsts):
        j, size = i, 0
        while j < len(firsts) and (size < AT_ONCE or fp[firsts[j]] == fp[firsts[j - 1]]):
            size += len(bodies_col[int(body_row[j])].as_buffer())
            j += 1
        bodies = [bodies_col[int(r)].as_py() for r in body_row[i:j]]
        starts = repeated_starts(bodies, rolling)
        for k in range(i, j):
            if times[k] > 1:
                starts[k - i] = np.arange(len(bodies[k - i]) - SPAN + 1)
        split = [k for k in range(i, j) if held[firsts[k]] > HOT]
        some = [k for k in range(i, j) if len(starts[k - i])]
        null = pa.nulls(len(some), pa.int64())
        at = firsts[some] if some else firsts[:0]
        yield pa.RecordBatch.from_arrays([pa.array(g1[at]), pa.array(g2[at]), pa.array([_runs(starts[k - i]) for k in some], pa.list_(pa.int32())), null, null], names=["g1", "g2", "runs", "w1", "w2"])
        for k in split:
            body = bodies[k - i]
            d = np.frombuffer(b"".join(hashlib.blake2b(body[x : x + SPAN], digest_size=16).digest() for x in range(len(body) - SPAN + 1)), np.int64).reshape(-1, 2)
            n = len(d)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(n, g1[firsts[k]])), pa.array(np.full(n, g2[firsts[k]])), pa.array([[x, x + 1] for x in range(n)], pa.list_(pa.int32())), pa.array(d[:, 0]), pa.array(d[:, 1])], names=["g1", "g2", "runs", "w1", "w2"])
        i = j


def merged(segs: DataFrame) -> DataFrame:
    """(g1, g2, runs): the runs of repeated starts of every distinct segment that has any."""
    rolling = Rolling()
    parts = F.ceil(F.col("held") / HOT)
    rows = segs.filter("nth <= 2").withColumn("part", F.pmod(F.xxhash64("g1"), parts))
    partitions = 4 * int(segs.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) >= HELD_BYTES:
                found = pa.Table.from_batches(held)
                fp = found.column("fp").to_numpy()
                whole = int(np.searchsorted(fp, fp[-1]))  # the last group may go on
                if whole:
                    yield from merge_part(found.slice(0, whole), rolling)
                    held = found.slice(whole).to_batches()
        if held:
            yield from merge_part(pa.Table.from_batches(held), rolling)

    rows = rows.select("fp", "held", "g1", "g2", "nth", "body", "part").repartition(partitions, "fp", "part").sortWithinPartitions("fp")
    starts = written(rows.mapInArrow(run, "g1 long, g2 long, runs array<int>, w1 long, w2 long"), "runs")
    sure = starts.filter("w1 is null").select("g1", "g2", "runs")
    windows = starts.filter("w1 is not null")
    again = windows.groupBy("w1", "w2").agg(F.count("*").alias("k")).filter("k > 1").select("w1", "w2")
    across = windows.join(again, ["w1", "w2"], "left_semi").select("g1", "g2", "runs")
    return sure.unionByName(across).groupBy("g1", "g2").agg(F.flatten(F.collect_list("runs")).alias("runs"))


def _removed(texts: DataFrame) -> DataFrame:
    """(doc_id, t, n_removed, n_spans, kept_sha256, kept) of texts with the runs of their segments."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            runs = batch.column(batch.schema.get_field_index("runs")).to_pylist()
            for text, pieces in zip(binary_column(batch, "text").to_pylist(), runs, strict=True):
                edge = np.zeros(len(text) + 1, np.int64)
                for piece in pieces:
                    at = np.array(piece["runs"], np.int64) + piece["a"]
                    np.add.at(edge, at[::2], 1)
                    np.add.at(edge, at[1::2] - 1 + SPAN, -1)
                gone = np.cumsum(edge)[:-1] > 0
                kept = np.frombuffer(text, np.uint8)[~gone].tobytes()
                out.append((int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1).sum()), hashlib.sha256(kept).hexdigest(), kept))
            c = list(zip(*out, strict=True))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(c[0], pa.int64()), pa.array(c[1], pa.int64()), pa.array(c[2]), pa.array(c[3], pa.binary())], names=["doc_id", "t", "n_removed", "n_spans", "kept_sha256", "kept"])

    return texts.select("doc_id", "t", "text", "runs").mapInArrow(run, "doc_id long, t long, n_removed long, n_spans long, kept_sha256 string, kept binary")


def dedup(docs: DataFrame, keep_text: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row; kept: null where nothing is removed."""
    with scratch(docs.sparkSession):
        return result(_dedup(docs, keep_text), "dedup")


def _dedup(docs: DataFrame, keep_text: bool) -> DataFrame:
    keyed = _keyed(docs)
    f = written(fingerprints(keyed), "fingerprints")
    text_key = ["d1", "d2", "n"]
    groups = f.groupBy(*text_key).agg(F.count("*").alias("copies"), F.min(F.struct("doc_id", "t")).alias("first"))
    marked = f.join(groups, text_key)
    one = marked.filter(F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("n") >= SPAN)).groupBy("doc_id", "t").agg(F.first("fps").alias("fps"), F.max("copies").alias("copies"))
    one = written(one, "representatives")
    grams = one.select("doc_id", "t", F.explode("fps").alias("fp"))
    held = grams.groupBy("fp").agg(F.count("*").alias("held")).filter("held > 1")
    cands = grams.join(held, "fp").groupBy("doc_id", "t").agg(F.collect_set(F.struct("fp", "held")).alias("cands"))
    # Rows that repeat a doc_id and text are copies of each other; their text goes whole, whatever its segments say.
    texts = written(null_safe_join(keyed, cands, KEY), "candidates")
    segs = written(segments(texts), "segments")
    # A table of its own, so that the join shuffles both sides and Spark can split a segment that many texts hold.
    found = written(merged(segs), "found")
    runs = segs.select(*KEY, "a", "g1", "g2").join(found, ["g1", "g2"]).groupBy(*KEY).agg(F.collect_set(F.struct("a", "runs")).alias("runs"))
    cut = _removed(null_safe_join(texts, runs, KEY))
    cut = cut if keep_text else cut.drop("kept")
    cut = cut.dropDuplicates(KEY)
    every = null_safe_join(marked.select("doc_id", "t", "n", "sha", "copies"), cut, KEY, "left")
    whole = (F.col("copies") > 1) & (F.col("n") >= SPAN)
    out = every.select(
        "doc_id", F.col("n").alias("n_bytes"), F.when(whole, F.col("n")).otherwise(F.coalesce("n_removed", F.lit(0))).alias("n_removed"),
        F.when(whole, F.lit(1)).otherwise(F.coalesce("n_spans", F.lit(0))).cast("long").alias("n_spans"),
        F.when(whole, F.sha2(F.lit(""), 256)).otherwise(F.coalesce("kept_sha256", "sha")).alias("kept_sha256"),
        *([F.when(whole, F.lit(b"")).otherwise(F.col("kept")).alias("kept")] if keep_text else []),
    )
    return out


def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the bytes that repeated strings take."""
    return dedup(table(spark, sf_dir, "documents"), keep_text=False)
