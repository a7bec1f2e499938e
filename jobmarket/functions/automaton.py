"""Many literals at once: one Aho-Corasick automaton walks a text a single time, whatever the number of literals.

Automata are built once a task, from a list of bounded size (at most TERMS literals); a larger table of terms is dealt to
parts of that size by hash, and the texts are walked once for each part.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator

import ahocorasick
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import pandas_udf

#: Literals of one automaton.
TERMS = 200_000
#: Fewest words of an alias whose words may stand anywhere in a title.
WORDS_APART = 4
#: Characters that may stand before and after an alias in a title.
BEFORE, AFTER = " ,/-(", " ,:/-)"


class Literals:
    """Literals with the numbers of the rows that they stand for; hits of a text are (start, end, rows)."""

    def __init__(self, rows: list[tuple[str, int]]) -> None:
        if len(rows) > TERMS:
            raise ValueError(f"an automaton takes {TERMS} literals at most, not {len(rows)}")
        own: dict[str, list[int]] = {}
        for literal, i in rows:
            if literal:
                own.setdefault(literal, []).append(i)
        self.automaton = ahocorasick.Automaton()
        for literal, numbers in own.items():
            self.automaton.add_word(literal, (len(literal), numbers))
        if own:
            self.automaton.make_automaton()

    def hits(self, text: str) -> Iterator[tuple[int, int, list[int]]]:
        if len(self.automaton):
            for last, (size, numbers) in self.automaton.iter(text):
                yield last + 1 - size, last + 1, numbers


def _word(c: str) -> bool:
    return c.isalnum() or c == "_"


def whole_words(terms: list[tuple[str, tuple[str, ...], bool]]):
    """UDF of texts -> the slugs, in the table's order, that a literal names with no letter, digit or underscore on either
    side. terms: (slug, literals, whether case counts); null and empty texts name none."""
    loose = [(x.lower(), i) for i, (_, literals, exact) in enumerate(terms) if not exact for x in literals]
    strict = [(x, i) for i, (_, literals, exact) in enumerate(terms) if exact for x in literals]

    @pandas_udf(T.ArrayType(T.StringType()))
    def named(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        both = [(Literals(loose), True), (Literals(strict), False)]

        def one(text: str | None) -> list[str]:
            found: set[int] = set()
            for literals, low in both:
                t = (text or "").lower() if low else text or ""
                for a, b, rows in literals.hits(t):
                    if not (a and _word(t[a - 1])) and not (b < len(t) and _word(t[b])):
                        found.update(rows)
            return [terms[i][0] for i in sorted(found)]

        for batch in texts:
            yield batch.map(one)

    return named


#: Marks of gender in titles.
GENDERS = r"\((?:ne|e|euse)\)|/(?:ne|e|euse)\b|\([hfmwdx/]+\)"


def normal_title(title: str | None) -> str:
    """Lower case without accents, marks of gender and repeated white space."""
    plain = "".join(c for c in unicodedata.normalize("NFKD", title or "") if not unicodedata.combining(c))
    return " ".join(re.sub(GENDERS, "", plain.lower()).split())


def best_alias(aliases: list[tuple[str, str]]):
    """UDF of titles -> slug: an alias that is the whole title, else the longest one that stands in it between separators,
    else the alias with most words, WORDS_APART at least, that all stand somewhere. Ties: the first in the list."""
    first: dict[str, str] = {}
    for alias, slug in aliases:
        first.setdefault(normal_title(alias), slug)
    first.pop("", None)
    ordered = list(first)

    @pandas_udf(T.StringType())
    def match(titles: Iterator[pd.Series]) -> Iterator[pd.Series]:
        literals = Literals([(a, i) for i, a in enumerate(ordered)])
        apart = [(i, frozenset(re.findall(r"\w+", a))) for i, a in enumerate(ordered)]
        apart = [(i, ws) for i, ws in apart if len(ws) >= WORDS_APART]
        often: dict[str, int] = {}
        for _, ws in apart:
            for w in ws:
                often[w] = often.get(w, 0) + 1
        # An alias is looked at only where its rarest word stands.
        by_word: dict[str, list[tuple[int, frozenset[str]]]] = {}
        for i, ws in apart:
            by_word.setdefault(min(ws, key=lambda w: (often[w], w)), []).append((i, ws))

        def one(title: str | None) -> str | None:
            t = normal_title(title)
            if t in first:
                return first[t]
            best = max(((b - a, -rows[0]) for a, b, rows in literals.hits(t) if (not a or t[a - 1] in BEFORE) and (b == len(t) or t[b] in AFTER)), default=None)
            if best is None:
                words = set(re.findall(r"\w+", t))
                best = max(((len(ws), -i) for w in words & by_word.keys() for i, ws in by_word[w] if ws <= words), default=None)
            return first[ordered[-best[1]]] if best else None

        for batch in titles:
            yield batch.map(one).astype("object")

    return match


def named_in(texts: DataFrame, terms: DataFrame, text: str = "text") -> DataFrame:
    """Distinct (text, slug): which terms (slug, literal, exact) of a table of any size a text names as whole words."""
    parts = max(1, -(-terms.count() // (TERMS // 2)))
    distinct, out = texts.select(F.col(text).alias("text")).filter("text is not null").distinct(), None
    for part in range(parts):
        rows = terms.filter(F.pmod(F.xxhash64("literal"), F.lit(parts)) == part).collect()
        found = distinct.select("text", F.explode(whole_words([(r["slug"], (r["literal"],), r["exact"]) for r in rows])("text")).alias("slug"))
        out = found if out is None else out.unionByName(found)
    return out.distinct()
