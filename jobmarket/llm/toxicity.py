"""Toxicity scores by weak supervision.

1. Voters. A fixed seed lexicon; terms (words, and stems of 4 to 7 bytes) that a bounded balanced sample of labelled
   rows shows more often in toxic texts; patterns (shouting, exclamation runs, a word repeated, address in the second
   person). Each voter votes toxic or abstains on a text, and again if it occurs once in a hundred words or more.
2. Generative label model. Each voter has a rate of voting on toxic and on clean texts; correlations that remain between
   voters given the label discount their votes, so that copies of one voter count once; a text without any vote is one
   event. The rates start from a development set, half of the sample, whose labels are observed; for all other
   texts the label is latent and expectation-maximisation estimates it along with the rates.
3. Linear classifier. Logistic regression over the voters' occurrences (presence, and rate per hundred words) is
   trained on the posterior labels, weighted to the share of toxic texts among all labels; no text's own label enters.

Labels are learnt from rows whose crc32(doc_id as text) mod 5 is not 0, at most MOST_TOXIC and MOST_CLEAN of them.
Scores use the whole text and nothing else.

Words are runs of ASCII letters and of bytes above 127, lower-cased; they are compared by 64-bit hashes.

Defined results: null and empty texts have no evidence and get the score of a text without any; rows are scored one by
one, so null and repeated ids are kept as they are; labels that repeat count once, as toxic if any is; null labels do
not count; without labelled rows the seed lexicon alone votes; columns of the table stay as they are, whatever their
names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from jobmarket.llm.common import Rolling, binary_column, mix, table, text_blocks

#: Bounds of the labelled sample and of the terms found from it.
MOST_TOXIC = 3000
MOST_CLEAN = 6000
MOST_TERMS = 400
LEAST_DOCS = 4
LEAST_RATIO = 4
#: Terms must differ by so many standard errors: some hundred thousand are looked at.
LEAST_Z = 2.0
#: One sampled text in so many has its label observed by the label model, and counts so many times there.
DEVELOPMENT = 2
OBSERVED_WEIGHT = 3.0
ROWS_AT_ONCE = 512
#: Terms that a task counts at once before it passes the counts on.
TERMS_AT_ONCE = 1 << 19
STEMS = (4, 5, 6, 7)
FOLDS = 5

#: A small seed lexicon of insults.
SEEDS = (
    "idiot", "moron", "stupid", "loser", "scum", "trash", "worthless", "pathetic", "disgusting", "clown", "dumb", "jerk", "bastard", "fool",
    "idiota", "imbecil", "estupido", "basura", "asqueroso", "payaso", "imbécile", "stupide", "ordure", "débile", "crétin", "dummkopf", "arschloch",
    "abschaum", "widerlich", "versager", "trottel",
)
#: Words of address in four languages, a pattern voter together.
ADDRESS = ("you", "your", "du", "tu", "vous", "usted")
PATTERNS = ("address", "exclaiming", "repeating", "shouting")
#: Bytes of words, and a factor per length of stem that keeps stems and words apart.
LETTER = np.zeros(256, bool)
LETTER[65:91] = LETTER[97:123] = LETTER[128:] = True
CAPITAL = np.zeros(256, bool)
CAPITAL[65:91] = True
STEM_SALT = np.array([0x9E3779B97F4A7C15], np.uint64)


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(False))


def labelled_sample(labels: DataFrame) -> DataFrame:
    """(doc_id, toxic) of at most MOST_TOXIC + MOST_CLEAN rows outside the held-out fold, by lowest hash."""
    known = labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    part = lambda which, n: known.filter(F.col("toxic") == which).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    return part(1, MOST_TOXIC).unionByName(part(0, MOST_CLEAN))


def runs_of(flags: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of true flags; a run ends where a text does (first: whether a text starts there)."""
    start = np.flatnonzero(flags & (first[:-1] | np.concatenate([[True], ~flags[:-1]])))
    end = np.flatnonzero(flags & (first[1:] | np.concatenate([~flags[1:], [True]]))) + 1
    return start, end


class Reader:
    """Words of many texts at once: rows, terms (word and stem hashes) and what the patterns see."""

    def __init__(self) -> None:
        self.rolling = Rolling()

    def words(self, lower: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, hash, start, end) of the words of texts in one byte array of lower-cased texts."""
        first = np.zeros(len(lower) + 1, bool)
        first[off] = True
        start, end = runs_of(LETTER[lower], first)
        c = self.rolling.prefix(lower)
        return np.searchsorted(off, start, "right") - 1, mix(self.rolling.spans(c, start, end)), start, end

    def stems(self, lower: np.ndarray, start: np.ndarray, end: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(which word, hash) of the k-byte stems of the words that are longer."""
        longer = np.flatnonzero(end - start > k)
        c = self.rolling.prefix(lower)
        return longer, mix(self.rolling.spans(c, start[longer], start[longer] + k) + np.uint64(k) * STEM_SALT)

    def terms(self, lower: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(row, term) of all words and stems."""
        row, word, start, end = self.words(lower, off)
        rows, terms = [row], [word]
        for k in STEMS:
            at, stem = self.stems(lower, start, end, k)
            rows.append(row[at])
            terms.append(stem)
        return np.concatenate(rows), np.concatenate(terms)

    def of(self, word: str) -> np.uint64:
        lower = np.frombuffer(word.lower().encode(), np.uint8)
        return self.words(lower, np.array([0, len(lower)]))[1][0]


def lowered(texts: pa.Array) -> pa.RecordBatch:
    """(text, lower) of texts, null as empty."""
    text = pc.fill_null(texts if pa.types.is_string(texts.type) else texts.cast(pa.string()), "")
    return pa.RecordBatch.from_arrays([text, pc.utf8_lower(text)], names=["text", "lower"])


def term_counts(texts: DataFrame) -> DataFrame:
    """(term, n_toxic, n_clean): texts with the term, each text once; texts: (text, toxic)."""
    reader = Reader()

    def tally(seen: list[np.ndarray]) -> pa.RecordBatch:
        both, at = np.unique(np.concatenate(seen), return_inverse=True)
        n = [np.bincount(x, minlength=len(both)).astype(np.int64) for x in (at[: len(seen[0])], at[len(seen[0]) :])]
        return pa.RecordBatch.from_arrays([pa.array(both.view(np.int64)), pa.array(n[1]), pa.array(n[0])], names=["term", "n_toxic", "n_clean"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: list[np.ndarray] = [np.empty(0, np.uint64)] * 2
        for batch in batches:
            toxic = batch.column(1).to_numpy(zero_copy_only=False) > 0
            for span, data, off in text_blocks(lowered(batch.column(0)), "lower"):
                rows, terms = reader.terms(data, off)
                order = np.lexsort((terms, rows))
                rows, terms = rows[order], terms[order]
                new = np.concatenate([[True], (rows[1:] != rows[:-1]) | (terms[1:] != terms[:-1])])[: len(rows)]
                rows, terms = rows[new], terms[new]
                for which in (0, 1):
                    seen[which] = np.concatenate([seen[which], terms[toxic[span][rows] == bool(which)]])
            if sum(map(len, seen)) > TERMS_AT_ONCE:
                yield tally(seen)
                seen = [np.empty(0, np.uint64)] * 2
        yield tally(seen)

    counts = texts.mapInArrow(count, "term long, n_toxic long, n_clean long")
    return counts.groupBy("term").agg(F.sum("n_toxic").alias("n_toxic"), F.sum("n_clean").alias("n_clean"))


class Voters:
    """Terms and patterns, and their occurrences in texts; voters of a lower number than len(terms) are terms."""

    def __init__(self, terms: list[int]) -> None:
        self.reader = Reader()
        self.seeds = np.array([self.reader.of(w) for w in SEEDS], np.uint64)
        self.terms = np.unique(np.concatenate([np.array(terms, np.int64).view(np.uint64), self.seeds]))
        self.address = np.sort(np.array([self.reader.of(w) for w in ADDRESS], np.uint64))
        self.n = len(self.terms) + len(PATTERNS)
        self.known = np.zeros(1 << 16, bool)
        self.known[self.terms & np.uint64(0xFFFF)] = True

    def _found(self, rows: np.ndarray, terms: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        some = np.flatnonzero(self.known[terms & np.uint64(0xFFFF)])
        at = np.minimum(np.searchsorted(self.terms, terms[some]), len(self.terms) - 1)
        hit = self.terms[at] == terms[some]
        return rows[some[hit]], at[hit]

    def occurrences(self, data: np.ndarray, off: np.ndarray, lower: np.ndarray, lower_off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(row, voter, times) of all voters that occur, sorted, and the number of words per row."""
        reader, n_rows = self.reader, len(off) - 1
        row, word, start, end = reader.words(lower, lower_off)
        found = [self._found(row, word)]
        for k in STEMS:
            at, stem = reader.stems(lower, start, end, k)
            found.append(self._found(row[at], stem))
        # Patterns: words of address, runs of "!", a word three times, runs of four words in capitals.
        patterns = [row[np.isin(word, self.address)]]
        first = np.zeros(len(data) + 1, bool)
        first[off] = True
        s, e = runs_of(data == 33, first)
        patterns.append(np.searchsorted(off, s[e - s >= 2], "right") - 1)
        thrice = (word[2:] == word[1:-1]) & (word[1:-1] == word[:-2]) & (row[2:] == row[:-2])
        patterns.append(row[2:][thrice])
        s, e = runs_of(LETTER[data], first)
        capitals = np.concatenate([[0], np.cumsum(CAPITAL[data])])
        loud, of = (e - s >= 4) & (capitals[e] - capitals[s] == e - s), np.searchsorted(off, s, "right") - 1
        edge = np.concatenate([[True], of[1:] != of[:-1], [True]]) if len(of) else np.ones(1, bool)
        s, e = runs_of(loud, edge)
        patterns.append(of[s[e - s >= 4]])
        found += [(rows, np.full(len(rows), len(self.terms) + i)) for i, rows in enumerate(patterns)]
        code, times = np.unique(np.concatenate([r * self.n + v for r, v in found]), return_counts=True)
        return code // self.n, code % self.n, times, np.bincount(row, minlength=n_rows)

    def described(self, texts: pa.Array) -> Iterator[tuple]:
        """Occurrences by runs of texts: (rows, row, voter, times, words). ROWS_AT_ONCE texts are lower-cased at a time."""
        for first in range(0, len(texts), ROWS_AT_ONCE):
            both = lowered(texts.slice(first, ROWS_AT_ONCE))
            low = binary_column(both, "lower")
            low_off = np.frombuffer(low.buffers()[1], np.int32)[low.offset : low.offset + len(low) + 1].astype(np.int64)
            low_data = np.frombuffer(low.buffers()[2], np.uint8) if low.buffers()[2] is not None else np.empty(0, np.uint8)
            for span, data, off in text_blocks(both, "text"):
                a = low_off[span.start : span.stop + 1]
                yield slice(first + span.start, first + span.stop), *self.occurrences(data, off, low_data[a[0] : a[-1]], a - a[0])


def label_model(votes: np.ndarray, label: np.ndarray, observed: np.ndarray, prior: float, rounds: int = 30) -> np.ndarray:
    """Posterior of toxic, from the votes alone, for each row of the 0/1 votes; label counts where it is observed only."""
    n = len(votes)
    some = votes.any(axis=1)
    q, weight = np.where(observed, label, 0.0), observed.astype(float)
    posterior, expected = q, lambda rows, mean=votes.mean(axis=0, dtype=float): mean[None, :]
    for _ in range(rounds):
        toxic, clean = weight * q, weight * (1 - q)
        any_toxic, any_clean = (np.clip((x * some).sum() / max(x.sum(), 1e-9), 1e-3, 1 - 1e-3) for x in (toxic, clean))
        overall = 2 * (weight @ votes) / max(weight.sum(), 1e-9) + 0.01
        a, b = (np.clip((x @ votes + overall) / (x.sum() + 2), 1e-5, 1 - 1e-5) for x in (toxic, clean))
        # What voters share beyond what is expected of them, some rows at a time.
        both = np.zeros((votes.shape[1], votes.shape[1]))
        for first in range(0, n, ROWS_AT_ONCE):
            part = slice(first, first + ROWS_AT_ONCE)
            centred = votes[part] - expected(part)
            both += centred.T @ centred
        deviation = np.sqrt(np.diag(both) / n) + 1e-6
        both /= n * np.outer(deviation, deviation)
        shared = np.maximum(np.maximum(both - 0.1, 0).sum(axis=1) + 0.1, 1)
        evidence = votes @ (np.log((a / any_toxic) / (b / any_clean)) / shared)
        z = np.log(prior / (1 - prior)) + np.where(some, np.log(any_toxic / any_clean) + evidence, np.log((1 - any_toxic) / (1 - any_clean)))
        posterior = np.clip(1 / (1 + np.exp(-np.clip(z, -30, 30))), 1e-3, 1 - 1e-3)
        new = np.where(observed, label, posterior)
        moved = np.abs(new - q).max()
        q, weight = new, np.where(observed, OBSERVED_WEIGHT, 1.0)
        expected = lambda rows, q=q, a=a, b=b: q[rows, None] * a + (1 - q)[rows, None] * b
        if moved < 1e-4:
            break
    return posterior


def logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, l2: float = 1e-4, steps: int = 400) -> tuple[np.ndarray, float]:
    """Weighted logistic regression on soft labels by accelerated gradient steps of the safe length."""
    weight, y = (weight / weight.sum()).astype(x.dtype), y.astype(x.dtype)
    rate = x.dtype.type(1 / (0.25 * (1 + float(weight @ (x**2).sum(axis=1)))))
    w, b = np.zeros(x.shape[1], x.dtype), x.dtype.type(0)
    v, vb = np.zeros(x.shape[1], x.dtype), x.dtype.type(0)
    for i in range(steps):
        k = x.dtype.type(i / (i + 3))
        ww, bb = w + k * v, b + k * vb
        g = (1 / (1 + np.exp(-np.clip(x @ ww + bb, -30, 30))) - y) * weight
        nw, nb = ww - rate * (x.T @ g + l2 * ww), bb - rate * g.sum()
        v, vb, w, b = nw - w, nb - b, nw, nb
    return w, b


class Model:
    def __init__(self, voters: Voters, weights: np.ndarray, bias: float) -> None:
        self.voters, self.weights, self.bias = voters, weights, bias

    def scores(self, part: tuple) -> np.ndarray:
        span, row, voter, times, words = part
        x = self.weights[2 * voter] + self.weights[2 * voter + 1] * rate(times, words[row])
        z = self.bias + np.bincount(row, weights=x, minlength=len(words))
        return 1 / (1 + np.exp(-np.clip(z, -40, 40)))


def rate(times: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Occurrences per hundred words, up to 5."""
    return np.minimum(5.0, 100.0 * times / np.maximum(words, 1))


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learns voters, label model and classifier from the labelled sample; what reaches the driver is bounded by it."""
    sample = labelled_sample(labels)
    texts = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", F.col("toxic").cast("int").alias("toxic"))
    known = labels.filter(~held_out(F.col("doc_id")) & F.col("toxic").isNotNull()).agg(F.avg("toxic").alias("p"), F.count("*").alias("n")).first()
    counts = term_counts(texts)
    size = {r["toxic"]: r["count"] for r in sample.groupBy("toxic").count().collect()}
    t, c = float(size.get(1, 0)) + 1, float(size.get(0, 0)) + 1
    ratio = ((F.col("n_toxic") + 0.5) / t) / ((F.col("n_clean") + 0.5) / c)
    p, q = F.col("n_toxic") / t, F.col("n_clean") / c
    z = (p - q) / F.sqrt((p * (1 - p) + 1 / t) / t + (q * (1 - q) + 1 / c) / c)
    best = counts.filter((F.col("n_toxic") >= LEAST_DOCS) & (ratio > LEAST_RATIO) & (z >= LEAST_Z)).orderBy(z.desc(), "term").limit(MOST_TERMS)
    voters = Voters([r["term"] for r in best.collect()])

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for span, row, voter, times, words in voters.described(batch.column(0)):
                ends = pa.array(np.searchsorted(row, np.arange(len(words) + 1)).astype(np.int32))
                lists = [pa.ListArray.from_arrays(ends, pa.array(x.astype(np.int32))) for x in (voter, times)]
                yield pa.RecordBatch.from_arrays([*lists, pa.array(words.astype(np.int32)), batch.column(1)[span]], names=["voter", "times", "words", "toxic"])

    rows = texts.mapInArrow(describe, "voter array<int>, times array<int>, words int, toxic int").collect()
    rows = sorted((r["words"], r["voter"], r["times"], r["toxic"]) for r in rows)
    return learn(voters, rows, float(known["p"] or 0))


def learn(voters: Voters, rows: list[tuple[int, list[int], list[int], int]], prior: float) -> Model:
    """Label model and classifier from the (words, voters, occurrences, toxic) of sampled texts; prior: share of toxic
    ones among all labels."""
    m = voters.n
    label = np.array([r[3] for r in rows], float)
    observed = np.arange(len(rows)) % DEVELOPMENT == 0
    if not len(rows) or label[observed].min() == label[observed].max():
        w = np.zeros(2 * m)
        w[2 * np.searchsorted(voters.terms, voters.seeds)] = 3.0
        return Model(voters, w, -2.0)
    votes = np.zeros((len(rows), 2 * m), np.float32)
    x = np.zeros((len(rows), 2 * m), np.float32)
    for i, (words, which, times, _) in enumerate(rows):
        j, n = np.array(which, np.int64), np.array(times, np.int64)
        x[i, 2 * j], x[i, 2 * j + 1] = 1, rate(n, np.full(len(n), words))
        votes[i, 2 * j], votes[i, 2 * j + 1] = 1, x[i, 2 * j + 1] >= 1
    posterior = label_model(votes[:, votes.sum(axis=0) >= LEAST_DOCS], label, observed, min(max(label.mean(), 1e-3), 1 - 1e-3))
    prior = min(max(prior, 1e-4), 1 - 1e-4)
    # A text counts as the posterior says, the two kinds together as among all labels.
    mass = posterior.mean()
    weight = posterior * prior / mass + (1 - posterior) * (1 - prior) / (1 - mass)
    soft = (posterior * prior / mass / weight).astype(np.float32)
    used = np.flatnonzero(x.any(axis=0))
    w = np.zeros(2 * m)
    w[used], bias = logistic(x[:, used], soft, weight, steps=2000)
    return Model(voters, w, float(bias))


def scored_rows(docs: DataFrame, model: Model) -> DataFrame:
    """(row, score, predicted): row is a struct of all columns of docs; one pass, in which only texts leave the JVM."""
    row = docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"))

    @F.arrow_udf(DoubleType())
    def score(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array(np.concatenate([np.empty(0), *(model.scores(part) for part in model.voters.described(batch))]))

    return row.withColumn("score", score("row.text")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """docs with score and predicted, in place of columns of these names."""
    return scored_rows(docs, model).select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ("score", "predicted")], "score", "predicted")


def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = fit(docs, table(spark, sf_dir, "labels"))
    doc_id = F.col("row.doc_id")
    return scored_rows(docs, model).select(doc_id.alias("doc_id"), held_out(doc_id).alias("held_out"), "score", "predicted")
