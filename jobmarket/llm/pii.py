"""Personal data by candidate gradient boosting, with DataFrame functions only.

1. Generators of high recall propose spans, which may overlap: the four base patterns, bare runs of 12 to 19 digits,
   written-out e-mail addresses, phone numbers without a country code, and groups of hexadecimal digits between colons.
2. Every candidate has a check of its kind (the last label of a domain has letters only; octets; Luhn; number and first
   digits of a phone number; eight groups), and is described by format (kind, generator, groups, separators, size of
   bare numbers) and context (characters on both sides, words before it, the line around it) in a few bins each. The
   check's outcome is no feature. All candidates of all documents are counted by these bins; the table of counts has at
   most as many rows as there are combinations of bins.
3. Boosted trees of depth 3 (Newton steps of the logistic loss) are grown on the counts; the label is the check's
   outcome, so that they learn which formats and contexts hold real data. A fifth of the documents is left out and
   calibrates two thresholds per kind: the highest score that RECALL of the left-out candidates that pass their check
   reach (or twice the share of numbers that pass a check by luck, where that is lower), and the lowest from which
   PRECISION of all left-out candidates pass it.
4. The trees become one column expression. Base candidates that pass their check are always redacted. Others are when
   no base span covers them and they pass their check and reach the first threshold, or reach the second one.

Positions are code points, the end exclusive. Texts are read whole. Everything stays inside a row: no shuffle but the
counts'.

Defined results: a null or empty text has no spans; rows are treated one by one, so null and repeated ids are kept;
spans that are equal count once; a table without candidates redacts nothing; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import defaultdict

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from jobmarket.llm.common import table

KINDS = ("email", "ip", "card", "phone")
#: The base patterns. Possessive forms and the anchor (no fitting character before, or the end of the last match) find
#: the same matches as the plain forms, in linear time and without recursion.
_LOCAL = "[A-Za-z0-9._%+-]"
BASE = {
    "email": rf"(?:(?<!{_LOCAL})|\G){_LOCAL}++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?:(?<![0-9])|\G)[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_AT, _DOT = r"\x20?(?:\(at\)|\[at\]|@)\x20?", r"\x20?(?:\(dot\)|\[dot\]|\.)\x20?"
EXTRA = (
    ("card", r"(?<![0-9])[0-9]{12,19}(?![0-9])"),
    ("email", rf"(?<!{_LOCAL}){_LOCAL}++{_AT}[A-Za-z0-9-]++(?:{_DOT}[A-Za-z0-9-]++)++"),
    ("phone", r"(?<![0-9])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[.-][0-9]{4}(?![0-9])"),
    ("ip", r"(?<![0-9A-Za-z:])[0-9A-Fa-f]{1,4}(?::[0-9A-Fa-f]{1,4}){3,7}(?![0-9A-Za-z:])"),
)
#: Words before a candidate that speak for personal data, and for other numbers.
NEAR = r"(?i)(?:card|visa|konto|account|tel|phone|call|fax|mail|contact|ip|host|server|address)\W*$"
FAR = r"(?i)(?:token|key|secret|hash|order|id|isbn|version|ref)\W*$"
PRECISION = 0.97
RECALL = 0.97
#: The share of random numbers that pass a check digit.
LUCK = 0.1
ROUNDS = 24
DEPTH = 3
SHRINK = 0.3
FEATURES = ("kind", "generator", "size", "groups", "separators", "before", "after", "words", "line")

CANDIDATES = "array<struct<kind:int,s:int,e:int,m:string,left:string,right:string,base:boolean>>"


def _gate(kind: str, base: bool, text: Column) -> Column:
    if kind == "email":
        return text.contains("@") if base else text.contains("@") | text.contains("(at)") | text.contains("[at]")
    if kind == "phone" and base:
        return text.contains("+")
    if kind == "ip":
        return text.contains("." if base else ":") & text.rlike("[0-9]")
    return text.rlike("[0-9]")


def _with_parts(parts: Column):
    """A match with the texts before and after it."""
    return lambda m, j: F.struct(m.alias("m"), F.get(parts, j).alias("l"), F.get(parts, j + 1).alias("r"))


def _placing(kind: int, base: bool):
    """Adds a match, with its position, to those before it."""

    def place(acc: Column, x: Column) -> Column:
        s = acc["pos"] + F.length(x["l"])
        e = s + F.length(x["m"])
        one = F.struct(F.lit(kind).alias("kind"), s.alias("s"), e.alias("e"), x["m"].alias("m"), F.right(x["l"], F.lit(16)).alias("left"), F.left(x["r"], F.lit(1)).alias("right"), F.lit(base).alias("base"))
        return F.struct(e.alias("pos"), F.concat(acc["out"], F.array(one)).alias("out"))

    return place


def _texts(docs: DataFrame) -> DataFrame:
    """(row, text): all columns of docs in a struct, and the text without null."""
    return docs.select(F.struct(*[docs[f"`{c}`"] for c in docs.columns]).alias("row"), F.coalesce(docs["text"], F.lit("")).alias("text"))


def candidates(texts: DataFrame) -> DataFrame:
    """(row, text, cands) of texts (row, text): every generator's matches, left to right, with 16 characters of context."""
    sources = [(k, p, True) for k, p in BASE.items()] + [(k, p, False) for k, p in EXTRA]
    cols = {}
    for i, (kind, pattern, base) in enumerate(sources):
        gate = _gate(kind, base, F.col("text"))
        cols[f"p{i}"] = F.when(gate, F.split("text", pattern, -1))
        cols[f"m{i}"] = F.when(gate, F.regexp_extract_all("text", F.lit(pattern), F.lit(0)))
    texts = texts.withColumns(cols)
    none = F.expr(f"cast(array() as {CANDIDATES})")
    lists = []
    for i, (kind, _, base) in enumerate(sources):
        around = F.transform(f"m{i}", _with_parts(F.col(f"p{i}")))
        start = F.struct(F.lit(0).alias("pos"), none.alias("out"))
        lists.append(F.coalesce(F.aggregate(around, start, _placing(KINDS.index(kind), base), lambda acc: acc["out"]), none))
    return texts.select("row", "text", F.concat(*lists).alias("cands"))


def _digits(m: Column) -> Column:
    return F.regexp_replace(m, "[^0-9]", "")


def _luhn(d: Column) -> Column:
    """Whether a string of digits passes the check; null-safe for short strings."""
    each = F.transform(F.filter(F.split(F.reverse(d), ""), lambda x: x != ""), lambda x, i: F.when(i % 2 == 0, x.cast("int")).otherwise(x.cast("int") * 2 - F.when(x.cast("int") > 4, 9).otherwise(0)))
    return F.aggregate(each, F.lit(0), lambda a, x: a + x) % 10 == 0


def _octets(m: Column) -> Column:
    """Four parts of at most 255."""
    parts = F.transform(F.split(m, r"\."), lambda p: F.regexp_replace(p, "^0+(?=[0-9])", ""))
    return (F.size(parts) == 4) & F.forall(parts, lambda p: F.coalesce((F.length(p) <= 3) & (p.try_cast("int") <= 255), F.lit(False)))


def _side(c: Column) -> Column:
    return F.when(F.coalesce(c, F.lit("")).isin("", " ", "\n", "\t"), 0).when(c.rlike("[0-9]"), 3).when(c.rlike(r"\p{L}"), 2).otherwise(1)


def described(cands: str = "cands") -> Column:
    """The candidates with their binned features and ok: whether the check of their kind passes."""

    def one(c: Column) -> Column:
        d = _digits(c["m"])
        n = F.length(d)
        luhn = F.when((n >= 12) & (n <= 19), _luhn(d)).otherwise(F.lit(False))
        mail = F.regexp_replace(F.regexp_replace(c["m"], _AT, "@"), _DOT, ".").rlike(r"^[^@]*[A-Za-z][^@]*@.*\.[A-Za-z]{2,}$")
        ip = F.when(c["base"], _octets(c["m"])).otherwise(F.size(F.split(c["m"], ":")) == 8)
        phone = (n >= 9) & (n <= 15) & (c["base"] | d.rlike("^[2-9][0-9]{2}[2-9]"))
        ok = F.when(c["kind"] == 0, mail).when(c["kind"] == 1, ip).when(c["kind"] == 2, luhn).otherwise(phone)
        # A base span needs no more than the base patterns say; they have no check of addresses.
        sure = c["base"] & F.when(c["kind"] == 0, F.lit(True)).when(c["kind"] == 1, _octets(c["m"])).when(c["kind"] == 2, luhn).otherwise((n >= 9) & (n <= 15))
        spaces = c["m"].contains(" ").cast("int") + c["m"].contains("-").cast("int") + c["m"].contains("(").cast("int")
        groups = F.size(F.split(c["m"], "[^0-9A-Za-z]+"))
        return F.struct(
            c["kind"].alias("kind"), c["s"].alias("s"), c["e"].alias("e"), ok.alias("ok"), sure.alias("sure"), c["base"].cast("int").alias("generator"),
            F.when(c["kind"] != 2, 0).when(n < 12, 1).when(n < 16, 2).when(n == 16, 3).when(n <= 19, 4).otherwise(5).alias("size"),
            F.least(groups, F.lit(6)).alias("groups"), F.least(spaces, F.lit(2)).alias("separators"),
            _side(F.right(c["left"], F.lit(1))).alias("before"), _side(c["right"]).alias("after"),
            F.when(c["left"].rlike(FAR), 2).when(c["left"].rlike(NEAR), 1).otherwise(0).alias("words"), c["left"].rlike(r"[|,;\t=]\s*$").cast("int").alias("line"),
        )

    return F.transform(cands, one)


def grow(cells: list[tuple[tuple[int, ...], float, float]], rounds: int = ROUNDS) -> tuple[float, list[tuple]]:
    """Boosted trees on counts: cells are (features, candidates, right ones). Returns the first margin and the trees,
    each (feature, bound, left, right) with a leaf value or such a node on either side (left: value <= bound)."""
    total, right = sum(n for _, n, _ in cells), sum(y for _, _, y in cells)
    first = math.log((right + 1) / (total - right + 1))
    margin, trees = [first] * len(cells), []

    def split(rows: list[int], g: list[float], h: list[float], depth: int):
        G, H = sum(g[i] for i in rows), sum(h[i] for i in rows)
        leaf = -SHRINK * G / (H + 1)
        if not depth:
            return leaf
        best = (1e-6, None)
        for f in range(len(FEATURES)):
            by: dict[int, list[float]] = defaultdict(lambda: [0.0, 0.0])
            for i in rows:
                by[cells[i][0][f]][0] += g[i]
                by[cells[i][0][f]][1] += h[i]
            gl = hl = 0.0
            for v in sorted(by)[:-1]:
                gl, hl = gl + by[v][0], hl + by[v][1]
                gain = gl * gl / (hl + 1) + (G - gl) ** 2 / (H - hl + 1) - G * G / (H + 1)
                if gain > best[0]:
                    best = (gain, (f, v))
        if not best[1]:
            return leaf
        f, v = best[1]
        return (f, v, split([i for i in rows if cells[i][0][f] <= v], g, h, depth - 1), split([i for i in rows if cells[i][0][f] > v], g, h, depth - 1))

    for _ in range(rounds if cells else 0):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [n * q - y for (_, n, y), q in zip(cells, p, strict=True)]
        h = [n * q * (1 - q) for (_, n, _), q in zip(cells, p, strict=True)]
        tree = split(list(range(len(cells))), g, h, DEPTH)
        trees.append(tree)
        margin = [m + value(tree, x) for m, (x, _, _) in zip(margin, cells, strict=True)]
    return first, trees


def value(tree, x: tuple[int, ...]) -> float:
    while isinstance(tree, tuple):
        tree = tree[2] if x[tree[0]] <= tree[1] else tree[3]
    return tree


def _expression(tree, c: Column) -> Column:
    if not isinstance(tree, tuple):
        return F.lit(float(tree))
    return F.when(c[FEATURES[tree[0]]] <= tree[1], _expression(tree[2], c)).otherwise(_expression(tree[3], c))


class Model:
    """thresholds: per kind, for candidates that pass their check and for others."""

    def __init__(self, first: float, trees: list[tuple], thresholds: list[tuple[float, float]]) -> None:
        self.first, self.trees, self.thresholds = first, trees, thresholds

    def margin(self, c: Column) -> Column:
        out = F.lit(float(self.first))
        for t in self.trees:
            out = out + _expression(t, c)
        return out

    def selects(self, c: Column) -> Column:
        limit = lambda i: F.element_at(F.array(*[F.lit(float(t[i])) for t in self.thresholds]), c["kind"] + 1)
        return self.margin(c) >= F.when(c["ok"], F.least(limit(0), limit(1))).otherwise(limit(1))


def calibrated(cells: list[tuple[float, float, float]]) -> tuple[float, float]:
    """Thresholds from (margin, candidates, right ones): the highest that RECALL of the right ones reach, and the lowest
    from which PRECISION of all are right (infinite where no margin is)."""
    recalled = precise = math.inf
    n_all = y_all = 0.0
    total = sum(y for _, _, y in cells)
    cells = sorted(cells, reverse=True)
    for i, (m, n, y) in enumerate(cells):
        n_all, y_all = n_all + n, y_all + y
        if i + 1 == len(cells) or cells[i + 1][0] < m:
            if recalled == math.inf and total and y_all >= RECALL * total:
                recalled = m - 1e-9
            if y_all >= PRECISION * n_all:
                precise = m - 1e-9
    return min(recalled, math.log(2 * LUCK / (1 - 2 * LUCK))), precise


def fit(docs: DataFrame) -> Model:
    """Counts all candidates by their features, over all documents, and grows the trees on the counts."""
    texts = _texts(docs.select("text"))
    c = candidates(texts).select((F.pmod(F.xxhash64("text"), F.lit(5)) == 0).alias("out"), F.explode(described()).alias("c"))
    rows = c.groupBy("out", *[F.col(f"c.{f}").alias(f) for f in FEATURES]).agg(F.count("*").alias("n"), F.count_if("c.ok").alias("y")).collect()
    cells = sorted((r["out"], tuple(r[f] for f in FEATURES), float(r["n"]), float(r["y"])) for r in rows)
    first, trees = grow([c[1:] for c in cells if not c[0]])
    thresholds = []
    # Where nothing was left out (small tables), the counts that grew the trees set the thresholds.
    for k in range(len(KINDS)):
        own = [c for c in cells if c[1][0] == k]
        own = [c for c in own if c[0] and any(x[0] and x[3] for x in own)] or own
        thresholds.append(calibrated([(first + sum(value(t, x) for t in trees), n, y) for _, x, n, y in own]))
    return Model(first, trees, thresholds)


def detect_rows(docs: DataFrame, model: Model) -> DataFrame:
    """(row, text, base, all): row is a struct of all columns of docs; base and all are arrays of (s, kind, e), sorted;
    all holds the base spans too."""
    d = candidates(_texts(docs)).withColumn("cands", described())
    span = lambda c: F.struct(c["s"].alias("s"), c["kind"].alias("kind"), c["e"].alias("e"))
    d = d.withColumn("base", F.array_sort(F.transform(F.filter("cands", lambda c: c["sure"]), span)))
    more = F.filter("cands", lambda c: ~c["sure"] & model.selects(c) & ~F.exists("base", lambda b: (b["s"] <= c["s"]) & (b["e"] >= c["e"])))
    return d.withColumn("all", F.array_sort(F.array_distinct(F.concat("base", F.transform(more, span))))).drop("cands")


def detect(docs: DataFrame, model: Model) -> DataFrame:
    """docs with _base and _all of detect_rows, in place of columns of these names."""
    return detect_rows(docs, model).select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ("_base", "_all")], F.col("base").alias("_base"), F.col("all").alias("_all"))


def listed(spans: str) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", F.element_at(names, x["kind"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def redact(docs: DataFrame, model: Model | None = None) -> DataFrame:
    """docs with every span in the text replaced by its kind in brackets; spans that overlap become one; all other
    columns stay, whatever their names."""
    d = detect_rows(docs, model or fit(docs))
    names = F.array(*[F.lit(k.upper()) for k in KINDS])

    def cut(acc: Column, x: Column) -> Column:
        # Text up to the span, unless an earlier span covers its start.
        fresh = x["s"] >= acc["pos"]
        piece = F.concat(F.substring("text", acc["pos"] + 1, F.greatest(x["s"] - acc["pos"], F.lit(0))), F.lit("["), F.element_at(names, x["kind"] + 1), F.lit("]"))
        return F.struct(F.greatest(acc["pos"], x["e"]).alias("pos"), F.when(fresh, F.concat(acc["out"], piece)).otherwise(acc["out"]).alias("out"))

    cleaned = F.aggregate("all", F.struct(F.lit(0).alias("pos"), F.lit("").alias("out")), cut, lambda acc: F.concat(acc["out"], F.substring("text", acc["pos"] + 1, F.length("text"))))
    text = F.when(F.size("all") > 0, cleaned).otherwise(F.col("row.text"))
    return d.withColumn("text", text).select(*[F.col("text") if c == "text" else F.col(f"row.`{c}`") for c in docs.columns])


def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document: base counts, a digest of the base spans, and all spans."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = detect_rows(docs, fit(docs))
    count = lambda k: F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long")
    return d.select(F.col("row.doc_id").alias("doc_id"), *[count(i).alias(f"n_{k}") for i, k in enumerate(KINDS)], F.sha2(listed("base"), 256).alias("base_sha256"), listed("all").alias("spans"), F.size("all").cast("long").alias("n_spans"))
