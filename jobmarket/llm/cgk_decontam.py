"""Benchmark decontamination by CGK embedding, bit-sampling LSH and exact edit distance.

An item contaminates a document when a piece of the document's text is within MAX_EDITS of the item's length in edit
distance (texts with A-Z lower-cased and runs of white space as one space, in bytes).

The CGK random walk copies a string's bytes and steps on by a random bit that depends on place and byte, so strings at
a small edit distance stay in step for most places: edit distance becomes Hamming distance. Each of REPETITIONS walks
keeps SAMPLED random places of the embedding as a bucket key. Item-sized windows of the documents are embedded the
same way; a window that falls into a bucket of an item in any repetition is verified exactly (Myers' bit-vector
algorithm over the window and its surroundings). Windows are taken at every byte where an item can start: k edits leave
two of k + 2 pieces of an item whole (one of k + 1 where the item is short), moved against each other by k bytes at
most, so every place without such pieces is beyond the distance and nothing is lost before the embedding, whatever
the item's length and with or without spaces. Items longer than PART_BYTES are embedded in parts of equal length, as the
walks of long strings drift apart; the windows of a part are aligned by the pieces that stand in it, and one part that
shares a bucket is enough for the exact check of the whole item. The number of repetitions is chosen so that an item at
the largest distance is found with probability 0.9 or more (measured in the tests, up to 400 words).

The benchmark is the stated query set: it goes to the tasks in blocks of about BLOCK_BYTES, whatever its size. A block's
matches are written before the next one is collected, so the driver holds one block; each is a pass over the documents.

Defined results: null or blank texts and items match nothing; rows with a null doc_id or item_id take no part; rows
that repeat give one row per (doc_id, item_id), the best; ties go to the first place; other columns are ignored.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import mix, result, scratch, table, text_blocks, written

MAX_EDITS = 0.1
PIECE_BYTES = 9
LEAST_PAIRED = 6
FILTER_BITS = 20
REPETITIONS = 64
SAMPLED = 5
REACH = 1.6
BLOCK_BYTES = 1 << 19
WALKS_AT_ONCE = 256
#: Longest string that is embedded as one.
PART_BYTES = 200
WALK_SEED = 97

MATCHES = "doc_id long, item_id long, edits int, item_bytes int, start int"


def normal(text: bytes) -> bytes:
    return b" ".join(text.lower().split())


class Cgk:
    """REPETITIONS random walks with their sampled places, relative to the length of the string."""

    def __init__(self, repetitions: int = REPETITIONS, sampled: int = SAMPLED) -> None:
        rng = np.random.default_rng(WALK_SEED)
        self.bit_seed = rng.integers(1, 1 << 62, repetitions, dtype=np.int64).astype(np.uint64)
        self.places = np.sort(rng.random((repetitions, sampled)), axis=1)

    def keys(self, strings: list[bytes], lengths: list[int]) -> np.ndarray:
        """(repetition, string) bucket keys of strings, as windows of items of the given lengths."""
        n, reps = len(strings), len(self.bit_seed)
        size = np.array(lengths, np.int64)
        x = np.zeros((n, int(size.max()) + 1), np.uint8)
        for i, s in enumerate(strings):
            own = s[: lengths[i]]
            x[i, : len(own)] = np.frombuffer(own, np.uint8)
        # A step is a random bit, 1/2 on average: REACH times the length stays inside the string for nearly all walks.
        wanted = (self.places[:, None] * REACH * size[None, :, None]).astype(np.int64)
        at = np.zeros((reps, n), np.int64)
        rows = np.arange(n)[None]
        walk = np.empty((int(wanted.max()) + 1, reps, n), np.uint8)
        factor, step = np.array([0xBF58476D1CE4E5B9], np.uint64), np.array([0x9E3779B97F4A7C15], np.uint64)
        for j in range(len(walk)):
            walk[j] = now = x[rows, at]
            bits = mix(self.bit_seed[:, None] + np.uint64(j) * step + now.astype(np.uint64) * factor)
            at = np.minimum(at + (bits >> np.uint64(63)).astype(np.int64), x.shape[1] - 1)
        key = np.zeros((reps, n), np.uint64)
        for c in range(wanted.shape[2]):
            key = key * np.uint64(257) + walk[wanted[:, :, c], np.arange(reps)[:, None], rows] + np.uint64(1)
        return mix(key + size.astype(np.uint64)[None] * factor)


def edit_search(pattern: bytes, text: bytes) -> tuple[int, int]:
    """Least edit distance of the pattern to any piece of the text, and the first end of such a piece."""
    m = len(pattern)
    peq: dict[int, int] = defaultdict(int)
    for i, c in enumerate(pattern):
        peq[c] |= 1 << i
    full, high = (1 << m) - 1, 1 << (m - 1)
    pv, mv, score, best, end = full, 0, m, m, 0
    for j, c in enumerate(text):
        eq = peq.get(c, 0)
        xv = eq | mv
        xh = (((eq & pv) + pv) ^ pv) | eq
        ph = mv | ~(xh | pv) & full
        mh = pv & xh
        if ph & high:
            score += 1
        elif mh & high:
            score -= 1
        ph, mh = (ph << 1) & full, (mh << 1) & full
        pv = mh | ~(xv | ph) & full
        mv = ph & xv
        if score < best:
            best, end = score, j + 1
    return best, end


def pieces_of(size: int) -> tuple[int, int, int]:
    """(pieces, their bytes, how many of them stay whole) of an item: k edits touch k pieces at most, so of k + 2
    pieces two stay whole, and of k + 1 one does where k + 2 would be too short to tell anything."""
    k = int(MAX_EDITS * size)
    if size // (k + 2) >= LEAST_PAIRED:
        return k + 2, min(size // (k + 2), PIECE_BYTES), 2
    return k + 1, min(size // (k + 1), PIECE_BYTES), 1


def piece_hashes(data: np.ndarray, n: int) -> np.ndarray:
    """A hash of the n bytes (PIECE_BYTES at most) from each byte on."""
    if len(data) < n:
        return np.empty(0, np.uint64)
    full = np.concatenate([data, np.zeros(8, np.uint8)])
    h = np.ndarray(len(data) - n + 1, "<u8", full, strides=(1,)).astype(np.uint64)
    if n < 8:
        h &= np.uint64((1 << (8 * n)) - 1)
    elif n > 8:
        h = h * np.uint64(0x9E3779B97F4A7C15) + full[8 : 8 + len(h)]
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    return h


class Items:
    """A block of benchmark items: pieces to find windows by, and buckets of their embeddings."""

    def __init__(self, items: list[tuple[int, bytes]]) -> None:
        self.items = [(i, normal(t)) for i, t in items]
        self.items = [(i, t) for i, t in self.items if t]
        self.cgk = Cgk()
        self.slack = np.array([int(MAX_EDITS * len(t)) for _, t in self.items], np.int64)
        self.paired = np.array([pieces_of(len(t))[2] == 2 for _, t in self.items], bool)
        found: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
        #: (item, start, length) of all parts.
        self.parts: list[tuple[int, int, int]] = []
        for k, (_, t) in enumerate(self.items):
            many, first = -(-len(t) // PART_BYTES), len(self.parts)
            edges = [len(t) * j // many for j in range(many + 1)]
            self.parts += [(k, a, b - a) for a, b in zip(edges, edges[1:], strict=False)]
            n, size, _ = pieces_of(len(t))
            starts = np.arange(n) * (len(t) // n)
            h = piece_hashes(np.frombuffer(t, np.uint8), size)[starts]
            part = first + np.searchsorted(edges, starts, "right") - 1
            found[size] += list(zip(h.tolist(), [k] * n, starts.tolist(), part.tolist(), strict=True))
        self.part_start = np.array([s for _, s, _ in self.parts], np.int64)
        self.part_size = np.array([n for _, _, n in self.parts], np.int64)
        self.pieces: dict[int, tuple[np.ndarray, ...]] = {}
        for size, rows in found.items():
            rows.sort()
            h, first, count = np.unique(np.array([r[0] for r in rows], np.uint64), return_index=True, return_counts=True)
            known = np.zeros(1 << FILTER_BITS, bool)
            known[h >> np.uint64(64 - FILTER_BITS)] = True
            self.pieces[size] = known, h, first, count, np.array([r[1:] for r in rows], np.int64)
        self.buckets: dict[int, set[int]] = defaultdict(set)
        for some in range(0, len(self.parts), WALKS_AT_ONCE):
            strings = [self.items[k][1][s : s + n] for k, s, n in self.parts[some : some + WALKS_AT_ONCE]]
            keys = self.cgk.keys(strings, [len(t) for t in strings])
            for r in range(len(keys)):
                for p, x in enumerate(keys[r].tolist(), some):
                    self.buckets[x ^ r].add(p)

    def windows(self, norms: list[bytes]) -> list[tuple[int, int, int]]:
        """(text, start, part length) of all windows where an item's pieces stand in normal texts: one piece, or two
        different ones of the item that edits can have moved against each other by no more than its slack. A window is
        that of the part which a piece stands in."""
        if not norms or not self.items:
            return []
        data = np.frombuffer(b"".join(norms), np.uint8)
        off = np.cumsum([0] + [len(x) for x in norms])
        hits = []
        for size, (known, hashes, first, count, where) in self.pieces.items():
            h = piece_hashes(data, size)
            at = np.flatnonzero(known[h >> np.uint64(64 - FILTER_BITS)])
            h = h[at]
            i = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            same = hashes[i] == h
            at, i = at[same], i[same]
            text = np.searchsorted(off, at, "right") - 1
            inside = at + size <= off[text + 1]
            at, i, text = at[inside], i[inside], text[inside]
            n = count[i]
            each = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + np.repeat(first[i], n)
            item, start, part = where[each].T
            hits.append(np.stack([np.repeat(text, n), item, np.repeat(at - off[text], n) - start, start, part]))
        text, item, place, piece, part = np.concatenate(hits, axis=1)
        order = np.lexsort((piece, place, item, text))
        text, item, place, piece, part = text[order], item[order], place[order], piece[order], part[order]
        near = (text[1:] == text[:-1]) & (item[1:] == item[:-1]) & (piece[1:] != piece[:-1]) & (place[1:] - place[:-1] <= self.slack[item[1:]])
        keep = ~self.paired[item]
        keep[1:] |= near
        keep[:-1] |= near
        found = np.unique(np.stack([text, np.maximum(place + self.part_start[part], 0), self.part_size[part]])[:, keep], axis=1)
        return list(zip(*found.tolist(), strict=True))

    def verified(self, texts: list[tuple[int, bytes]]) -> list[tuple[int, int, int, int, int]]:
        """(doc_id, item_id, edits, item_bytes, start) of the windows that share a bucket and pass the exact check, which
        is made once for windows of an item that overlap."""
        norms = [normal(raw) for _, raw in texts]
        near: dict[tuple[int, int], set[int]] = defaultdict(set)
        best: dict[tuple[int, int], tuple[int, int]] = {}
        places = self.windows(norms)
        for part in range(0, len(places), WALKS_AT_ONCE):
            some = places[part : part + WALKS_AT_ONCE]
            keys = self.cgk.keys([norms[t][w : w + n] for t, w, n in some], [n for _, _, n in some])
            for c, (t, w, n) in enumerate(some):
                for p in {p for r, x in enumerate(keys[:, c].tolist()) for p in self.buckets.get(x ^ r, ())}:
                    k, start, size = self.parts[p]
                    if size == n:
                        near[t, k].add(w - start)
        for (t, k), starts in near.items():
            item = self.items[k][1]
            slack = int(MAX_EDITS * len(item)) + 1
            ranges: list[list[int]] = []
            for w in sorted(starts):
                a, b = max(0, w - slack), w + len(item) + slack
                if ranges and a <= ranges[-1][1]:
                    ranges[-1][1] = b
                else:
                    ranges.append([a, b])
            for a, b in ranges:
                edits, end = edit_search(item, norms[t][a:b])
                if edits <= MAX_EDITS * len(item):
                    got = (edits, max(0, a + end - len(item)))
                    best[t, k] = min(best.get((t, k), got), got)
        return [(texts[t][0], self.items[k][0], e, len(self.items[k][1]), s) for (t, k), (e, s) in best.items()]


def contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, item_id, edits, item_bytes, start) of every document and item it holds; start: byte in the normal text."""
    with scratch(docs.sparkSession):
        return result(_contaminated(docs, benchmark, block_bytes), "contaminated")


def _contaminated(docs: DataFrame, benchmark: DataFrame, block_bytes: int) -> DataFrame:
    items = benchmark.filter("item_id is not null and text is not null").select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    size = items.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    blocks = max(1, -(-2 * size // block_bytes))
    docs = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = None
    for b in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == b).collect()
        found = docs.mapInArrow(_matcher(Items(sorted((r["item_id"], r["text"].encode()) for r in rows))), MATCHES)
        if blocks > 1:
            found = written(found, "matches")
        out = found if out is None else out.unionByName(found)
    best = F.min(F.struct("edits", "start", "item_bytes")).alias("m")
    return out.groupBy("doc_id", "item_id").agg(best).select("doc_id", "item_id", "m.edits", "m.item_bytes", "m.start")


def _matcher(block: Items):
    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            for span, data, off in text_blocks(batch, "text"):
                rows = block.verified([(int(i), data[off[r] : off[r + 1]].tobytes()) for r, i in enumerate(ids[span])])
                if not rows:
                    continue
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)], names=["doc_id", "item_id", "edits", "item_bytes", "start"])

    return match


def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds an item of the benchmark, with the item and the edit distance."""
    return contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
