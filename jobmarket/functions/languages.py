"""Language by character trigrams of words (C26, A36): a table of log weights, trained from labelled texts, and one pass
that scores whole texts.

Words are counted first, so that trigrams are only made of distinct words; texts then meet scores of words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from jobmarket.sources.tables import staged

#: Weights are kept in millionths, as whole numbers, so that sums do not depend on their order; counts are smoothed by ADD.
UNIT, ADD = 1_000_000, 0.5


def words(text: Column) -> Column:
    """Runs of letters, in lower case."""
    return F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(r"\p{L}+"), F.lit(0))


def trigrams(word: Column) -> Column:
    """All runs of three characters of a word with a blank on both sides."""
    w = F.concat(F.lit(" "), word, F.lit(" "))
    return F.transform(F.sequence(F.lit(1), F.length(w) - 2), lambda i: F.substring(w, i, F.lit(3)))


def each(df: DataFrame, keep: list[str | Column], items: Column, name: str) -> DataFrame:
    """A row per item. An inner explode lets Spark filter by its size first, which makes the items three times."""
    return df.select(*keep, F.explode_outer(items).alias(name)).filter(F.col(name).isNotNull())


def train(texts: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(gram, lang, weight) for every trigram and language seen: the log of its smoothed share in that language. gram is
    null once a language, with the weight of a trigram that no text has. Rows without language or words do not count."""
    counted = each(texts.filter(F.col(lang).isNotNull()), [F.col(lang).alias("lang")], words(F.col(text)), "word").groupBy("lang", "word").agg(F.count("*").alias("n"))
    grams = staged(each(counted, ["lang", "n"], trigrams(F.col("word")), "gram").groupBy("lang", "gram").agg(F.sum("n").alias("n")))
    totals = grams.groupBy("lang").agg(F.sum("n").alias("of"))
    kinds = grams.agg(F.count_distinct("gram").alias("kinds"))
    weight = lambda n: F.round(F.log((n + ADD) / (F.col("of") + ADD * (F.col("kinds") + 1))) * UNIT).cast("long").alias("weight")
    known = totals.join(F.broadcast(kinds))
    every = grams.select("gram").distinct().join(F.broadcast(known)).join(grams, ["lang", "gram"], "left")
    return every.select("gram", "lang", weight(F.coalesce("n", F.lit(0)))).unionByName(known.select(F.lit(None).cast("string").alias("gram"), "lang", weight(F.lit(0))))


#: Words whose scores are sent to every task.
SENT_WORDS = 400_000


def word_scores(texts: DataFrame, weights: DataFrame, languages: list[str], text: str = "text") -> DataFrame:
    """(word, texts, scores) of every distinct word, written: how often it stands, and its sum of weights in each of
    the languages, in their order."""
    counted = each(texts, [], words(F.col(text)), "word").groupBy("word").agg(F.count("*").alias("times"))
    unseen = weights.filter("gram is null").agg(F.map_from_entries(F.collect_list(F.struct("lang", "weight"))).alias("unseen"))
    known = weights.filter("gram is not null").groupBy("gram").agg(F.map_from_entries(F.collect_list(F.struct("lang", "weight"))).alias("of"))
    # Trigrams that no training text has weigh the same in all words, and are told by a missing partner.
    met = each(counted, ["word", "times"], trigrams(F.col("word")), "gram").join(known, "gram", "left").join(F.broadcast(unseen))
    sums = [F.sum(F.coalesce(F.element_at("of", F.lit(x)), F.element_at("unseen", F.lit(x)))) for x in languages]
    return staged(met.groupBy("word").agg(F.max("times").alias("times"), F.array(*sums).alias("scores")))


def scored(texts: DataFrame, weights: DataFrame, text: str = "text") -> DataFrame:
    """(row columns of texts, lang): the language with the highest sum of weights over all trigrams of the whole text; ties
    by name; null for texts without words. texts needs an id, the column id; rows that share one are one text.

    The scores of the SENT_WORDS most frequent words at most go to every task, which sums them as it reads the texts;
    only the other words, which are rare, are shuffled to their scores."""
    weights = staged(weights)
    languages = sorted(r["lang"] for r in weights.filter("gram is null").select("lang").collect())
    if not languages:
        return texts.select("id", F.lit(None).cast("string").alias("lang")).limit(0)
    known = word_scores(texts, weights, languages, text)
    least = 0
    if known.count() > SENT_WORDS:
        # The words by how often they stand: at most the square root of twice the corpus' words.
        kept, least = 0, None
        for r in sorted(known.groupBy("times").agg(F.count("*").alias("n")).collect(), key=lambda r: -r["times"]):
            if kept + r["n"] > SENT_WORDS:
                break
            kept, least = kept + r["n"], r["times"]
    said = each(texts, ["id"], words(F.col(text)), "word")
    sent = known.filter("false" if least is None else F.col("times") >= least).select("word", "scores")
    sums = lambda df: df.groupBy("id").agg(*[F.sum(F.col("scores")[i]).alias(f"s{i}") for i in range(len(languages))])
    found = sums(said.join(F.broadcast(sent), "word"))
    if least != 0:
        others = known.filter("true" if least is None else F.col("times") < least).select("word", "scores")
        found = found.unionByName(sums(said.join(F.broadcast(sent), "word", "left_anti").join(others.hint("shuffle_hash"), "word")))
    # Ties go to the first name, so a place counts against.
    places = [F.struct(F.sum(f"s{i}").alias("score"), F.lit(-i).alias("o"), F.lit(x).alias("lang")) for i, x in enumerate(languages)]
    return found.groupBy("id").agg(F.array_max(F.array(*places))["lang"].alias("lang"))
