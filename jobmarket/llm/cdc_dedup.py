"""Substring deduplication by content-defined chunking.

A gear hash, h = (h << 1) + gear[byte], runs over the UTF-8 bytes of every whole text; a position where the chosen bits
of h are zero ends a chunk. The bits depend on the last WINDOW bytes only, so an insertion moves no cut beyond its
neighbourhood. All chunks are compared by a 128-bit digest over the whole corpus. Repeated chunks that follow each other
form a passage; passages of LEAST_PASSAGE bytes count (shorter ones are lines and phrases that recur by themselves). Of
equal chunks, the first by (doc_id, text, start) stays and the others are removed.

Defined results: a null text is empty (no chunk, nothing removed); null ids come last; rows that share a doc_id are told
apart by their texts; of rows that repeat both, one is treated as above and the others lose their whole text, while
their counts of repeats are those of the one; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from jobmarket.llm.common import binary_column, result, scratch, table, text_blocks, written

#: Shortest and longest chunk in bytes, and the number of zero bits at a cut (a cut each 2**CUT_BITS bytes).
MIN_CHUNK = 24
MAX_CHUNK = 1024
CUT_BITS = 5
#: Bytes that the highest bits of the hash depend on.
WINDOW = 32
#: Fewest bytes of repeated chunks in a row that are a passage.
LEAST_PASSAGE = 96
GEAR_SEED = 611
#: t, a hash of the text, tells texts of one doc_id apart.
KEY = ["doc_id", "t"]
#: Stands for a null id.
LAST = (1 << 63) - 1
CHUNKS = "doc_id long, t long, start int, length int, d1 long, d2 long"


def gear_table() -> np.ndarray:
    return np.random.default_rng(GEAR_SEED).integers(0, 1 << 32, 256, dtype=np.uint64).astype(np.uint32)


def gear_hash(data: np.ndarray, gear: np.ndarray) -> np.ndarray:
    """The gear hash at every position by doubling: windows of 1, 2, 4, ... 32 bytes."""
    h = gear[data]
    for shift in (1, 2, 4, 8, 16):
        if len(h) > shift:
            h = np.concatenate([h[:shift], h[shift:] + (h[:-shift] << np.uint32(shift))])
    return h


def cuts(data: np.ndarray, off: np.ndarray, gear: np.ndarray) -> list[tuple[int, int, int]]:
    """(row, start, end) of the chunks of consecutive texts that share one byte array."""
    out = []
    ends_at = np.flatnonzero(gear_hash(data, gear) >> np.uint32(32 - CUT_BITS) == 0) + 1
    first = np.searchsorted(ends_at, off)
    ends = ends_at.tolist()
    for r in range(len(off) - 1):
        a, b = int(off[r]), int(off[r + 1])
        start = a
        # A hash within WINDOW bytes of the text's start saw bytes of the text before: no cut there.
        for e in ends[first[r] : first[r + 1]]:
            while e - start > MAX_CHUNK:
                out.append((r, start, start + MAX_CHUNK))
                start += MAX_CHUNK
            if e - start >= MIN_CHUNK and e - a >= WINDOW:
                out.append((r, start, e))
                start = e
        while b - start > MAX_CHUNK:
            out.append((r, start, start + MAX_CHUNK))
            start += MAX_CHUNK
        if b > start:
            out.append((r, start, b))
    return out


def _keyed(docs: DataFrame) -> DataFrame:
    """(doc_id, own, text, t): doc_id with LAST for null, own the id as it is."""
    own = F.col("doc_id").cast("long")
    return docs.select(F.coalesce(own, F.lit(LAST)).alias("doc_id"), own.alias("own"), F.coalesce("text", F.lit("")).alias("text")).withColumn("t", F.xxhash64("text"))


def _numbered(rows: DataFrame) -> DataFrame:
    """rows, written, with n_bytes and again: whether an earlier row has the same id and text."""
    w = written(rows.withColumn("number", F.monotonically_increasing_id()), "rows")
    firsts = w.groupBy(*KEY).agg(F.min("number").alias("first"))
    return w.join(firsts, KEY).withColumn("again", F.col("number") > F.col("first")).drop("number", "first")


def _removed(rows: DataFrame, found: DataFrame) -> DataFrame:
    """Numbered rows with the columns of spans; rows that come again lose all bytes."""
    whole = F.col("again") & (F.col("n_bytes") > 0)
    span = F.array(F.struct(F.lit(0).alias("s"), F.col("n_bytes").cast("int").alias("e")))
    j = rows.join(found, KEY, "left")
    return j.withColumns({"n_removed": F.when(whole, F.col("n_bytes")).otherwise(F.col("n_removed")), "removed": F.when(whole, span).otherwise(F.col("removed"))})


def chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, t, start, length, d1, d2) of every chunk of every text; one pass, no shuffle."""
    gear = gear_table()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, t = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
            for rows, data, off in text_blocks(batch, "text"):
                found = cuts(data, off, gear)
                if not found:
                    continue
                raw = data.tobytes()
                at = np.array(found, np.int64)
                d = np.frombuffer(b"".join([hashlib.blake2b(raw[a:b], digest_size=16).digest() for _, a, b in found]), np.int64).reshape(-1, 2)
                cols = [ids[rows][at[:, 0]], t[rows][at[:, 0]], (at[:, 1] - off[at[:, 0]]).astype(np.int32), (at[:, 2] - at[:, 1]).astype(np.int32), d[:, 0], d[:, 1]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["doc_id", "t", "start", "length", "d1", "d2"])

    return _keyed(docs).select(*KEY, "text").mapInArrow(cut, CHUNKS)


def repeated_chunks(docs: DataFrame) -> DataFrame:
    """(doc_id, t, start, length, keeps) of every chunk that stands at more than one place; keeps: the first place.

    Chunks are written once; counting combines per task before the shuffle, and the join with the repeated digests
    lets Spark split a digest that holds a large share of all rows."""
    c = written(chunks(docs), "chunks")
    place = F.struct(*KEY, "start")
    seen = c.groupBy("d1", "d2", "length").agg(F.min(place).alias("first"), F.max(place).alias("last")).filter(F.col("first") != F.col("last"))
    return c.join(seen, ["d1", "d2", "length"]).select(*KEY, "start", "length", (place == F.col("first")).alias("keeps")).distinct()


def passages(repeated: DataFrame) -> DataFrame:
    """The repeated chunks that stand in passages, with end and, where they go, the number of the run that goes."""
    by_place = Window.partitionBy(*KEY).orderBy("start")
    before = F.lag(F.struct("end", "keeps")).over(by_place)
    r = repeated.withColumn("end", F.col("start") + F.col("length")).withColumn("before", before)
    apart = F.coalesce(F.col("before.end") != F.col("start"), F.lit(True))
    r = r.withColumns({"passage": F.count_if(apart).over(by_place), "gone": F.count_if(~F.col("keeps") & (apart | F.col("before.keeps"))).over(by_place)})
    r = r.withColumn("bytes", F.sum("length").over(Window.partitionBy(*KEY, "passage")))
    return r.filter(F.col("bytes") >= LEAST_PASSAGE).select(*KEY, "start", "end", "length", F.when(~F.col("keeps"), F.col("gone")).alias("gone"))


def spans(repeated: DataFrame) -> DataFrame:
    """Per text: repeated chunks and bytes, and what goes, as maximal runs (s, e). All steps share one partitioning."""
    runs = passages(repeated).groupBy(*KEY, "gone").agg(F.count("*").alias("n"), F.sum("length").alias("bytes"), F.min("start").alias("s"), F.max("end").alias("e"))
    goes = F.col("gone").isNotNull()
    return runs.groupBy(*KEY).agg(
        F.sum("n").alias("n_repeated"), F.sum("bytes").alias("repeated_bytes"), F.coalesce(F.sum(F.when(goes, F.col("bytes"))), F.lit(0)).alias("n_removed"),
        F.sort_array(F.collect_list(F.when(goes, F.struct("s", "e")))).alias("removed"),
    )


def removable(docs: DataFrame) -> DataFrame:
    """spans of the repeated chunks of docs, written; the chunks are removed."""
    with scratch(docs.sparkSession):
        return result(spans(repeated_chunks(docs)), "spans")


def with_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, t, text) and the columns of spans, for every row; rows without repeats have nulls."""
    rows = _numbered(_keyed(docs).withColumn("n_bytes", F.octet_length("text").cast("long")))
    out = _removed(rows, removable(docs))
    return out.select(F.col("own").alias("doc_id"), *[c for c in out.columns if c not in ("doc_id", "own", "again", "n_bytes")])


def dedup(docs: DataFrame) -> DataFrame:
    """(doc_id, kept): the texts with their repeated chunks taken out (as bytes: a cut can part a character)."""

    def take_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for text, removed in zip(binary_column(batch, "text").to_pylist(), batch.column(batch.schema.get_field_index("removed")).to_pylist(), strict=True):
                at, parts = 0, []
                for x in removed or []:
                    parts.append(text[at : x["s"]])
                    at = x["e"]
                kept.append(b"".join([*parts, text[at:]]))
            yield batch.append_column("kept", pa.array(kept, pa.binary())).select(["doc_id", "kept"])

    return with_spans(docs).select("doc_id", "text", "removed").mapInArrow(take_out, "doc_id long, kept binary")


def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's repeated chunks: how many, how many bytes, and the byte spans that go."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    text = F.array_join(F.transform("removed", lambda x: F.concat_ws(":", x["s"].cast("string"), x["e"].cast("string"))), ",")
    out = _removed(_numbered(_keyed(docs).select(*KEY, "own", F.octet_length("text").cast("long").alias("n_bytes"))), removable(docs))
    number = lambda c: F.coalesce(c, F.lit(0)).cast("long")
    return out.select(F.col("own").alias("doc_id"), "n_bytes", *[number(c).alias(c) for c in ("n_repeated", "repeated_bytes", "n_removed")], number(F.size("removed")).alias("n_spans"), F.coalesce(text, F.lit("")).alias("spans"))
