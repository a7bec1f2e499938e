"""Pipeline stages against what their operators and brute force say, on planted documents."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as C
from jobmarket.llm import toxicity

SF = "/root/testdata/sf0.01"


def test_stages_on_the_small_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, before = docs.columns, docs.count()
    labels, gone = spark.read.parquet(f"{SF}/labels.parquet"), {}
    for name, stage in C.STAGES:
        out = stage(spark, docs, SF).cache()
        assert set(columns) <= set(out.columns)
        if name != "mixing":
            assert out.columns == columns
            gone[name] = docs.join(out.select("doc_id"), "doc_id", "left_anti").count()
        if name == "toxicity":
            kept = out.join(labels, "doc_id")
            assert kept.filter("toxic = 0").count() >= 0.97 * labels.filter("toxic = 0").count()
            assert kept.filter("toxic = 1").count() <= 0.3 * labels.filter("toxic = 1").count()
        if name == "pii":
            assert out.filter(F.col("text").rlike(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+\.[A-Za-z]")).count() == 0
        docs = out
    assert gone["ngram_jaccard_join"] > 20 and gone["benchmark_decontamination"] > 5 and gone["pii"] == 0 and before == 1000


@pytest.mark.parametrize("extra", [False, True])
def test_stages_keep_columns_and_clean_documents(spark, tmp_path, extra):
    rng = random.Random(5)
    text = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    item = text(40)
    rows = [(i, text(60), "en", "s", 1) for i in range(60)] + [(100, None, "en", None, 1), (101, "", None, "s", None), (None, text(30), "en", "s", 1), (102, text(20) + " " + item, "en", "s", 1)]
    rows += [(200, rows[5][1] + " tail", "en", "s", 1), (5, rows[5][1], "en", "s", 1), (103, "mail a.b@c.de now " + text(20), "en", "s", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    if extra:
        docs = docs.withColumns({c: F.lit(1) for c in ("score", "copies", "comp", "bin", "_all", "size", "target")})
    d = str(tmp_path)
    spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i in range(0)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    columns = docs.columns
    for name, stage in C.STAGES:
        docs = stage(spark, docs, d).cache()
        assert set(columns) <= set(docs.columns), name
        ids = [r["doc_id"] for r in docs.select("doc_id").collect()]
        if name == "ngram_jaccard_join":
            assert 200 not in ids and 5 in ids and None in ids
        if name == "benchmark_decontamination":
            assert 102 not in ids and {0, 1, 2, 100, 101} <= set(ids)
        if name == "pii":
            assert "[EMAIL]" in docs.filter("doc_id = 103").first()["text"]
    empty = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for _, stage in C.STAGES:
        assert stage(spark, empty, d).count() == 0


def test_stages_decide_by_row_and_leave_columns_alone(spark, tmp_path):
    rng = random.Random(6)
    text = lambda n: " ".join(f"w{rng.randrange(4000)}" for _ in range(n))
    item, one, two = text(40), text(60), text(70)
    rows = [(1, one, "s"), (2, two, "s"), (7, one, "s"), (7, text(50), "s"), (None, two, "s"), (8, text(20) + " " + item, "s"), (8, text(55), "s"), (None, item + " x", "s"), (9, "mail a.b@c.de now", None), (9, "plain words only", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    names = ("score", "predicted", "row", "_text", "_all", "base", "all", "cands", "copy_no", "copies", "_key", "bin", "h", "tie", "position", "component_id", "n_shingles", "own", "first", "item_id", "node")
    docs = docs.withColumns({c: F.lit(f"my {c}") for c in names})
    d = str(tmp_path)
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    for name, stage in C.STAGES:
        docs = stage(spark, docs, d).cache()
        got = docs.collect()
        assert got and all(r[c] == f"my {c}" for r in got for c in names), name
        kept = sorted((r["doc_id"] or 0, len(r["text"].split())) for r in got)
        if name == "ngram_jaccard_join":
            # 7's other text, and 8's and 9's, are documents of their own; so is the row without an id.
            assert kept == sorted([(1, 60), (2, 70), (7, 50), (8, 60), (8, 55), (0, 41), (9, 3), (9, 3)])
        if name == "benchmark_decontamination":
            assert kept == sorted([(1, 60), (2, 70), (7, 50), (8, 55), (9, 3), (9, 3)])
        if name == "pii":
            assert sorted(r["text"] for r in got if r["doc_id"] == 9) == ["mail [EMAIL] now", "plain words only"]


def test_labels_of_the_held_out_fold_are_not_read(spark):
    labels = spark.createDataFrame([(i, 1, 1) for i in range(100)], "doc_id long, quality int, toxic int")
    used = {r["doc_id"] for r in toxicity.labelled_sample(labels).collect()}
    import zlib

    assert used == {i for i in range(100) if zlib.crc32(str(i).encode()) % 5}
