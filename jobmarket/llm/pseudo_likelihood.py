"""Language-model scores by masked pseudo-likelihood.

Each word of a text is predicted from the two words before and the two after it by a small network; the sum of these
conditional log-probabilities over all words is the text's score. Three passes over the whole corpus:

1. word counts: a table of all words (ASCII lower case, by 64-bit hash) with their counts, as long as the corpus has words;
2. training in numpy: documents are dealt by hash to shards of about SHARD_BYTES; each shard trains a copy of one initial
   network on every position of all its documents, in FOLDS folds of masked positions, and the copies are averaged by
   their number of examples (a tree of sums in Spark). Shards, their order and the sums do not depend on how the table
   is partitioned, so neither do the scores;
3. scoring of every position of every document.

The words that are frequent enough to be among HEAD go to every task; the counts of the others stay in the table and are
joined to the documents that hold them. Inputs grow with the number of words up to MOST_INPUTS; words without an input
of their own share one of several by hash.

Words are predicted by a hierarchical softmax. The frequent words, by falling count, are cut into classes of about equal
mass, the others are dealt by hash to as many classes as their mass asks for, CLASSES in all. A class of frequent words
is halved by mass LEVELS times; each half is a binary decision of its own that sees the context. So P(word | context) =
P(class | context) * P(each decision | context) * P(word | leaf), the last from the word's own count with one added; it is
one where a word has a leaf for itself.

Defined results: a null or blank text has no words and scores 0 with a null mean; rows are scored one by one, so null
and repeated ids are kept as they are; other columns are ignored; an empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import Rolling, mix, result, scratch, table, text_blocks, written
from jobmarket.llm.words import words_of

HEAD = 1 << 18
LEAST_INPUTS, MOST_INPUTS = 1 << 12, 1 << 15
WORDS_PER_INPUT = 8
COUNTED_AT_ONCE = 1 << 20
CLASSES = 64
WIDTH = 16
HIDDEN = 32
SIDE = 2
FOLDS = 7
RATE = 0.2
MINIBATCH = 1024
LEVELS = 6
NODES = (1 << LEVELS) - 1
#: Hidden units that decisions see, the first ones.
SEEN = 8
SLICES = 16
#: Text of a shard, and how many vectors are summed at once in each of the rounds.
SHARD_BYTES = 1 << 23
FAN, ROUNDS = 256, 3
SEED = 7


def type_counts(docs: DataFrame) -> DataFrame:
    """(word, n) of all words of all documents, written once; word: the hash as a long."""
    rolling = Rolling()

    def tally(words: list[np.ndarray]) -> pa.RecordBatch:
        word, n = np.unique(np.concatenate(words), return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(word.view(np.int64)), pa.array(n.astype(np.int64))], names=["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: list[np.ndarray] = []
        for batch in batches:
            for _, data, off in text_blocks(batch, "text"):
                words.append(words_of(data, off, rolling)[0])
                if sum(map(len, words)) >= COUNTED_AT_ONCE:
                    yield tally(words)
                    words = []
        if words:
            yield tally(words)

    return written(docs.select("text").mapInArrow(count, "word long, n long").groupBy("word").agg(F.sum("n").alias("n")), "words")


SLICE_SCHEMA = "slice int, part int, weight double, vector binary"


def _as_slices(vector: np.ndarray, weight: float, part: int) -> pa.RecordBatch:
    parts = np.array_split(vector.astype(np.float64), SLICES)
    return pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([part] * SLICES, pa.int32()), pa.array([weight] * SLICES, pa.float64()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["slice", "part", "weight", "vector"])


def summed(slices: DataFrame) -> tuple[np.ndarray, float]:
    """Sum of the shards' vectors and weights, in the order of their parts. SLICES rows of a fixed size reach the driver."""

    def add(group: pa.Table) -> pa.Table:
        group = group.sort_by("part")
        total = sum(np.frombuffer(x.as_py(), np.float64) for x in group.column("vector"))
        return pa.table({"slice": group.column("slice")[:1], "part": pa.array([group.column("part")[0].as_py() // FAN], pa.int32()), "weight": pa.array([float(np.sum(group.column("weight").to_numpy()))]), "vector": pa.array([total.tobytes()], pa.binary())})

    for i in range(ROUNDS):
        keys = ["slice", F.floor(F.col("part") / FAN).alias("of")] if i < ROUNDS - 1 else ["slice"]
        slices = slices.groupBy(*keys).applyInArrow(add, SLICE_SCHEMA)
    rows = sorted(slices.collect(), key=lambda r: r["slice"])
    if not rows:
        return np.zeros(0), 0.0
    return np.concatenate([np.frombuffer(bytes(r["vector"]), np.float64) for r in rows]), rows[0]["weight"]


#: The decisions on the way to each leaf (class * 2**LEVELS + number in the class), from the first, and which side it is on.
_CLS, _OWN, _LEVEL = np.arange(CLASSES << LEVELS)[:, None] >> LEVELS, np.arange(CLASSES << LEVELS)[:, None] & ((1 << LEVELS) - 1), np.arange(LEVELS)
WAY = (_CLS * NODES + (1 << _LEVEL) - 1 + (_OWN >> (LEVELS - _LEVEL))).astype(np.uint16)
RIGHT = ((_OWN >> (LEVELS - 1 - _LEVEL)) & 1).astype(np.float32)


def decisions(leaf: np.ndarray, live: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(node, right, counts) of the LEVELS decisions on the way to each leaf; those without two sides, and those of
    places without a leaf (-1), do not count."""
    at = np.maximum(leaf, 0)
    node = WAY.take(at, axis=0)
    return node, RIGHT.take(at, axis=0), live.take(node) & (leaf >= 0)[:, None]


class Types:
    """What tasks know of the words: inputs, classes and P(word | class) of the frequent ones, the rules for the others."""

    def __init__(self, words: np.ndarray, counts: np.ndarray, distinct: int, rare_mass: float) -> None:
        order = np.lexsort((words, -counts))
        smooth = counts[order] + 1.0
        total = smooth.sum() + rare_mass
        self.rare_classes = int(np.clip(round(CLASSES * rare_mass / total) if total else 1, 1, CLASSES - 1))
        own = CLASSES - self.rare_classes
        cls = np.minimum(((np.cumsum(smooth) - smooth) / max(smooth.sum(), 1.0) * own).astype(np.int32), own - 1)
        wanted = 1 << max(0, distinct // WORDS_PER_INPUT).bit_length()
        self.n_inputs = int(np.clip(wanted, LEAST_INPUTS, MOST_INPUTS))
        self.shared_from = self.n_inputs - self.n_inputs // 8
        inputs = np.arange(1, len(order) + 1, dtype=np.int32)  # 0 stands beyond a text's ends
        inputs = np.where(inputs < self.shared_from, inputs, self._shared(words[order])).astype(np.int32)
        self.class_mass = np.bincount(cls, weights=smooth, minlength=CLASSES)
        by_word = np.argsort(words[order])
        self.words, self.inputs, self.classes = words[order][by_word], inputs[by_word], cls[by_word]
        # A word's leaf is where its middle falls in its class by mass; sides without mass need no decision.
        start = np.concatenate([[0.0], np.cumsum(self.class_mass)])
        middle = np.cumsum(smooth) - smooth / 2 - start[cls]
        leaf = np.clip(middle / self.class_mass[cls] * (1 << LEVELS), 0, (1 << LEVELS) - 1).astype(np.int64)
        mass = np.bincount((cls.astype(np.int64) << LEVELS) + leaf, weights=smooth, minlength=CLASSES << LEVELS)
        self.inside = np.log(smooth / mass[(cls.astype(np.int64) << LEVELS) + leaf])[by_word].astype(np.float32)
        self.leaves = ((cls.astype(np.int64) << LEVELS) + leaf)[by_word]
        odds = []
        for level in range(LEVELS):
            sides = mass.reshape(CLASSES, 1 << level, 2, -1).sum(axis=3)
            with np.errstate(divide="ignore", invalid="ignore"):
                odds.append(np.where((sides > 0).all(axis=2), np.log(sides[:, :, 1] / sides[:, :, 0]), np.nan))
        odds = np.concatenate(odds, axis=1).ravel()
        self.live = ~np.isnan(odds)
        self.odds = np.where(self.live, odds, 0.0)

    def _shared(self, words: np.ndarray) -> np.ndarray:
        return (self.shared_from + words % (self.n_inputs - self.shared_from)).astype(np.int32)

    def look_up(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Inputs, classes, log P(word | leaf), whether a word is rare, and leaves; a rare word has no leaf, and its log
        P(word | class) lacks log(n + 1)."""
        words = hashes.view(np.int64)
        rare_class = (CLASSES - self.rare_classes + words % self.rare_classes).astype(np.int32)
        if not len(self.words):
            return self._shared(words), rare_class, -np.log(self.class_mass[rare_class]), np.ones(len(words), bool), np.full(len(words), -1)
        order = np.argsort(words)  # sought in order, neighbours are found in memory that is at hand
        at = np.empty(len(words), np.int64)
        at[order] = np.minimum(np.searchsorted(self.words, words[order]), len(self.words) - 1)
        rare = self.words[at] != words
        inputs, classes, inside = self.inputs[at], self.classes[at], self.inside[at]
        inputs[rare], classes[rare] = self._shared(words[rare]), rare_class[rare]
        inside[rare] = -np.log(self.class_mass[rare_class[rare]])
        return inputs, classes, inside, rare, np.where(rare, -1, self.leaves[at])


class Vocabulary:
    """The words of the corpus: Types for the tasks and the table of the counts of all rare words.

    What reaches the driver: the number of words by count (at most the square root of twice the corpus' words), the
    frequent words (HEAD at most), the mass of the rare classes."""

    def __init__(self, counts: DataFrame, head: int = HEAD) -> None:
        by_count = sorted(((r["n"], r["words"]) for r in counts.groupBy("n").agg(F.count("*").alias("words")).collect()), reverse=True)
        kept, least = 0, None
        for n, words in by_count:
            if kept + words > head:
                break
            kept, least = kept + words, n
        frequent = F.lit(False) if least is None else F.col("n") >= least
        top = counts.filter(frequent).toArrow()
        self.rare = counts.filter(~frequent)
        self.n_rare = sum(words for _, words in by_count) - kept
        rare_mass = float(sum((n + 1) * words for n, words in by_count if least is None or n < least))
        self.types = t = Types(top["word"].to_numpy(), top["n"].to_numpy(), kept + self.n_rare, rare_mass)
        own = CLASSES - t.rare_classes
        t.class_mass[own:] = 1.0  # room for words that the corpus lacks
        if self.n_rare:
            for r in self.rare.groupBy(F.pmod("word", F.lit(t.rare_classes)).alias("c")).agg(F.sum(F.col("n") + 1).alias("mass")).collect():
                t.class_mass[own + int(r["c"])] += r["mass"]


def shapes(n_inputs: int) -> dict[str, tuple[int, ...]]:
    return {"E": (n_inputs, WIDTH), "W": (2 * SIDE * WIDTH, HIDDEN), "b": (HIDDEN,), "U": (HIDDEN, CLASSES), "c": (CLASSES,), "V": (CLASSES * NODES, SEEN), "v": (CLASSES * NODES,)}


def initial(vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    rng, mass = np.random.default_rng(SEED), vocabulary.types.class_mass
    p = {k: (rng.standard_normal(s) * 0.3 / np.sqrt(s[0] if k in "WU" else 1)).astype(np.float32) for k, s in shapes(vocabulary.types.n_inputs).items()}
    p["b"][:] = 0
    p["c"] = np.log(np.maximum(mass, 1e-9) / mass.sum()).astype(np.float32)
    p["V"][:], p["v"] = 0, vocabulary.types.odds.astype(np.float32)
    return p


def flat(p: dict[str, np.ndarray]) -> np.ndarray:
    return np.concatenate([x.ravel() for x in p.values()])


def unflat(v: np.ndarray, n_inputs: int) -> dict[str, np.ndarray]:
    out, at = {}, 0
    for k, s in shapes(n_inputs).items():
        n = int(np.prod(s))
        out[k] = v[at : at + n].reshape(s).astype(np.float32)
        at += n
    return out


def contexts(inputs: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inputs at the places -2, -1, 1, 2 around every word; 0 beyond the text's ends."""
    n = len(inputs)
    out = np.zeros((n, 2 * SIDE), np.int32)
    for col, d in enumerate([*range(-SIDE, 0), *range(1, SIDE + 1)]):
        here, there = (slice(-d, n), slice(0, n + d)) if d < 0 else (slice(0, n - d), slice(d, n))
        if n > abs(d):
            out[here, col] = np.where(rows[here] == rows[there], inputs[there], 0)
    return out


def forward(p: dict[str, np.ndarray], context: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    x = p["E"].take(context, axis=0).reshape(len(context), -1)
    h = np.tanh(x @ p["W"] + p["b"])
    return x, h, h @ p["U"] + p["c"]


def log_probabilities(p: dict[str, np.ndarray], context: np.ndarray, target: np.ndarray, leaf: np.ndarray, live: np.ndarray) -> np.ndarray:
    """log P(class) + log P(decisions) at each place."""
    out = np.empty(len(context), np.float32)
    for i in range(0, len(context), 4096):
        _, h, z = forward(p, context[i : i + 4096])
        top = z.max(axis=1)
        lp = z[np.arange(len(z)), target[i : i + 4096]] - top - np.log(np.exp(z - top[:, None]).sum(axis=1))
        node, right, counts = decisions(leaf[i : i + 4096], live)
        a = (2 * right - 1) * (np.einsum("nlk,nk->nl", p["V"].take(node, axis=0), h[:, :SEEN]) + p["v"].take(node))
        # log(1 + exp(-a)), in a form that numpy does for many at once
        miss = np.maximum(-a, 0) + np.log(1 + np.exp(-np.abs(a)))
        out[i : i + 4096] = lp - np.where(counts, miss, 0).sum(axis=1)
    return out


def _sums(keys: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The keys and the sums of their rows; equal keys stand together."""
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(rows, first, axis=0)


class Trainer:
    """Adagrad over minibatches."""

    def __init__(self, p: dict[str, np.ndarray], live: np.ndarray) -> None:
        self.p = {k: v.copy() for k, v in p.items()}
        self.g2 = {k: np.full(v.shape, 0.01, np.float32) for k, v in p.items()}
        self.live, self.seen = live, 0

    def _move(self, k: str, g: np.ndarray, at: np.ndarray | None = None) -> None:
        p, g2 = self.p[k], self.g2[k]
        seen, own = (g2, p) if at is None else (g2.take(at, axis=0), p.take(at, axis=0))
        seen += g * g
        g = g * np.float32(RATE)
        g /= np.sqrt(seen)
        own -= g
        if at is not None:
            g2[at], p[at] = seen, own

    def step(self, context: np.ndarray, target: np.ndarray, leaf: np.ndarray) -> None:
        p, n = self.p, len(context)
        # In the order of leaves, places that pass the same decision stand together, at each level.
        order = np.argsort(leaf.astype(np.int16), kind="stable")
        context, target, leaf = context.take(order, axis=0), target[order], leaf[order]
        x, h, z = forward(p, context)
        z -= z.max(axis=1, keepdims=True)
        np.exp(z, out=z)
        z *= 1 / (np.float32(n) * z.sum(axis=1, keepdims=True))
        z[np.arange(n), target] -= np.float32(1 / n)
        dh = z @ p["U"].T
        node, right, counts = decisions(leaf, self.live)
        seen, way = h[:, :SEEN], p["V"].take(node, axis=0)
        d = 1 / (1 + np.exp(-(np.einsum("nlk,nk->nl", way, seen) + p["v"].take(node)))) - right
        d *= counts * np.float32(1 / n)
        dh[:, :SEEN] += np.einsum("nl,nlk->nk", d, way)
        g = np.empty((LEVELS, n, SEEN + 1), np.float32)
        np.multiply(d.T[:, :, None], seen, out=g[:, :, :SEEN])
        g[:, :, SEEN] = d.T
        at, g = _sums(node.T.ravel(), g.reshape(LEVELS * n, -1))
        self._move("V", g[:, :SEEN], at)
        self._move("v", g[:, SEEN], at)
        dh *= 1 - h * h
        dx = (dh @ p["W"].T).reshape(-1, WIDTH)
        for k, g in (("U", h.T @ z), ("c", z.sum(axis=0)), ("W", x.T @ dh), ("b", dh.sum(axis=0))):
            self._move(k, g)
        keys = context.ravel().astype(np.uint16)  # numpy counts keys of this size instead of comparing them
        order = np.argsort(keys, kind="stable")
        at, g = _sums(keys.take(order), dx.take(order, axis=0))
        self._move("E", g, at)
        self.seen += n


def sharded(docs: DataFrame) -> DataFrame:
    """(shard, text) with a partition per shard, in an order that depends on the rows alone."""
    size = docs.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("n")).first()["n"]
    shards = max(1, -(-size // SHARD_BYTES))
    h = F.xxhash64("doc_id", "text")
    rows = docs.select(F.pmod(h, F.lit(shards)).cast("int").alias("shard"), h.alias("h"), "text")
    return rows.repartitionById(shards, "shard").sortWithinPartitions("h", "text").select("shard", "text")


def train(docs: DataFrame, vocabulary: Vocabulary) -> dict[str, np.ndarray]:
    """The average of the shards' networks, each trained on every position of all its documents, a fold of masked positions at a time."""
    rolling, start, types = Rolling(), initial(vocabulary), vocabulary.types

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        t, shard = Trainer(start, types.live), 0
        for batch in batches:
            if batch.num_rows:
                shard = batch.column(0)[0].as_py()
            for _, data, off in text_blocks(batch, "text"):
                words, rows = words_of(data, off, rolling)
                if not len(words):
                    continue
                inputs, classes, _, _, leaves = types.look_up(words)
                context = contexts(inputs, rows)
                fold = mix(np.arange(len(words), dtype=np.uint64) + words) % np.uint64(FOLDS)
                for f in range(FOLDS):
                    chosen = np.flatnonzero(fold == f)
                    for i in range(0, len(chosen), MINIBATCH):
                        some = chosen[i : i + MINIBATCH]
                        t.step(context[some], classes[some], leaves[some])
        if t.seen:
            yield _as_slices(flat(t.p).astype(np.float64) * t.seen, float(t.seen), shard)

    total, weight = summed(sharded(docs).mapInArrow(fit, SLICE_SCHEMA))
    return unflat(total / weight, types.n_inputs) if weight else start


def score(docs: DataFrame, vocabulary: Vocabulary, p: dict[str, np.ndarray]) -> DataFrame:
    """(doc_id, n_tokens, log_likelihood, mean_log_prob) of every row."""
    rolling, types = Rolling(), vocabulary.types

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n_rows = batch.column(0), batch.num_rows
            n, total = np.zeros(n_rows, np.int64), np.zeros(n_rows)
            n_rare, rares = np.zeros(n_rows, np.int64), [np.empty(0, np.int64)]
            for span, data, off in text_blocks(batch, "text", 1 << 19):
                words, rows = words_of(data, off, rolling)
                if len(words):
                    inputs, classes, inside, rare, leaves = types.look_up(words)
                    lp = log_probabilities(p, contexts(inputs, rows), classes, leaves, types.live) + inside
                    n[span] = np.bincount(rows, minlength=len(off) - 1)
                    total[span] = np.bincount(rows, weights=lp, minlength=len(off) - 1)
                    n_rare[span] = np.bincount(rows[rare], minlength=len(off) - 1)
                    rares.append(words[rare].view(np.int64))
            ends = pa.array(np.concatenate([[0], np.cumsum(n_rare)]).astype(np.int32))
            yield pa.RecordBatch.from_arrays([ids, pa.array(n), pa.array(total), pa.ListArray.from_arrays(ends, pa.array(np.concatenate(rares)))], names=["doc_id", "n_tokens", "log_likelihood", "rare"])

    out = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_tokens long, log_likelihood double, rare array<long>")
    if vocabulary.n_rare:
        out = written(out.withColumn("row", F.monotonically_increasing_id()), "scores")
        held = out.select("row", F.explode("rare").alias("word")).join(vocabulary.rare, "word")
        more = held.groupBy("row").agg(F.sum(F.log(F.col("n") + 1.0)).alias("more"))
        out = out.drop("rare").join(more, "row", "left").withColumn("log_likelihood", F.col("log_likelihood") + F.coalesce("more", F.lit(0.0)))
    return out.select("doc_id", "n_tokens", "log_likelihood", F.expr("case when n_tokens > 0 then log_likelihood / n_tokens end").alias("mean_log_prob"))


def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pseudo-likelihood of every document under a network trained on the whole table."""
    docs = table(spark, sf_dir, "documents")
    with scratch(spark):
        vocabulary = Vocabulary(type_counts(docs))
        return result(score(docs, vocabulary, train(docs, vocabulary)), "likelihoods")
