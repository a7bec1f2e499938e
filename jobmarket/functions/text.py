"""Title and text attributes as columns."""

from __future__ import annotations

import csv
from functools import reduce
from importlib.resources import files

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- Fixed values: patterns of the role filter --------------------------------------------------------------------
ALLOW = (
    "software engineer", "software developer", r"\bsde\b", r"\bswe\b", r"\bback[- ]?end\b", r"\bfront[- ]?end\b", r"\bfull[- ]?stack\b",
    "staff engineer", "principal engineer", "senior engineer", "systems? engineer", "platform engineer", "infrastructure engineer",
    r"\bdevops\b", r"\bsre\b", "site reliability", "reliability engineer", "qa engineer", r"\bsdet\b", "test engineer", "automation engineer",
    "data engineer", r"\bml engineer\b", "machine learning engineer", r"\bai engineer\b", "applied scientist", "research engineer",
    "research scientist", "data scientist", "security engineer", "application security", "mobile engineer", "ios engineer", "android engineer",
    "embedded engineer", "firmware engineer", "cloud engineer", "solutions? architect", "software architect", "engineering manager",
    "technical lead", "tech lead", "developer advocate", "performance engineer", "compiler engineer", "kernel engineer", "database engineer",
    "network engineer", "blockchain engineer", "game engineer", "graphics engineer", "robotics engineer", "controls engineer",
    "machine learning", r"\bml\b", r"\bmlops\b", r"\bml ?ops\b", "ml platform", "ml infrastructure", "deep learning", r"\bnlp\b",
    "natural language processing", "computer vision", r"\bllm\b", "large language model", "generative ai", r"\bgen ?ai\b", r"\bai/ ?ml\b",
    "ml scientist", "ml researcher", "machine learning scientist", "machine learning researcher", "ai researcher", "ai scientist",
    "data scien", "decision scientist", "applied research", "quant engineer", "quantitative engineer", "quant developer",
    "quantitative developer", "quant researcher", "quantitative research", "quant analyst", "quantitative analyst", "quantitative strategist",
    "cyber ?security", "information security", r"\binfosec\b", "security analyst", "security researcher", "security architect",
    "product security", "cloud security", "offensive security", "penetration test", r"\bpen[- ]?test", "red team", "blue team",
    "detection engineer", "security operations", r"\bsoc analyst\b", "vulnerability", "threat (intel|detection|research|hunt)",
    "incident response", "cryptography engineer", "security software engineer",
)
BLOCK = (
    "sales engineer", "solutions engineer", "customer engineer", "field engineer", "support engineer", "implementation engineer",
    r"\baccount\b", "recruit", "marketing", "collections", "financial (advis|analyst|planner|consultant|controller|servic|reporting)",
    "relationship manager", r"\bbranch\b",
)
# --- Fixed values: seniority buckets of the board heuristic, in order ----------------------------------------------
SENIORITY = (
    ("intern", (r"\bintern(ship)?\b", r"\bco-?op\b", r"\bapprentice\b")),
    ("principal", (r"\bprincipal\b", r"\bdistinguished\b", r"\bfellow\b", r"\bl[78]\b", "senior staff", r"\barchitect\b")),
    ("staff", (r"\bstaff\b", r"\bl6\b")),
    ("senior", (r"\bsenior\b", r"\bsr\.?\b", " iii ", r"\bl5\b", r"\bsde\s*(3|iii)\b", r"\bswe\s*(3|iii)\b")),
    ("mid", (" ii ", "level 2", r"\bl4\b", r"\bsde\s*(2|ii)\b", r"\bswe\s*(2|ii)\b", "mid[- ]level")),
    ("junior", (r"\bjunior\b", r"\bjr\.?\b", "new grad", "early career", r"\bassociate\b", "entry[- ]level", r"\bgraduate\b", " i ", "level 1", r"\bl3\b", r"\bsde\s*(1|i)\b", r"\bswe\s*(1|i)\b")),
)
MANAGEMENT = r"\b(manager|director|head|lead|vp|chief|officer)\b"
INDIVIDUAL = r"\b(engineer|engineering|developer|programmer|sde|swe|scientist)\b"
# --- Fixed values: strict seniority rules on folded titles, in order (pattern, exception, level) --------------------
STRICT = (
    (r"^(senior|sr\.?)\s", None, "senior"), (r"^(junior|jr\.?)\s", None, "entry"), (r"^principal\s", None, "principal"), (r"^distinguished\s", None, "principal"),
    (r"^staff\s", None, "staff"), (r"^lead\s", r"^lead\s(generat|qualif)", "lead"), (r"^(tech|team)\s+lead\b", None, "lead"), (r"^head\s+of\s", None, "director"),
    (r"^(director|directeur|directrice|direktor|direttore)(\s+of\s+|[\s,]+)", None, "director"), (r"^(vice\s+president|vp)\s", None, "director"),
    (r"^(ceo|cto|cfo|coo|cio|ciso|cmo|cpo)\b", r"^(ceo|cto|cfo|coo|cio|ciso|cmo|cpo)\s+advisor", "executive"),
    (r"^(managing\s+director|geschaftsfuhrer|geschaftsfuhrerin|geschaeftsfuehrer)\b", None, "executive"),
    (r"\b(internship|intern|praktikum|praktikant|praktikantin|werkstudent|werkstudentin|working\s+student|stagiaire|stage|alternance|alternant|apprendistato|apprentice|apprenticeship|duales\s+studium|ausbildung|lehre|lehrling|trainee)\b", r"stage\s+\d", "intern"),
    (r"\b(graduate\s+program|graduate\s+scheme|new\s+grad)\b", None, "entry"),
)
BOARD_TO_REPORT = {"junior": "entry", "intern": "intern", "mid": "mid", "senior": "senior", "staff": "staff", "principal": "principal"}
# --- Fixed values: signals in descriptions; education from the lowest degree ----------------------------------------
EDUCATION = (
    ("high_school", r"\b(high school( diploma)?|ged\b|secondary school)"),
    ("bachelor", r"\b(bachelor'?s?|b\.sc\.?|bsc|b\.tech|btech|b\.e\.|undergraduate degree|ba/bs|bs/ba|b\.s\. degree|four[- ]year degree|4[- ]year degree|college degree)"),
    ("master", r"\b(master'?s|m\.sc\.?|msc|mba|m\.eng|master of)\b"),
    ("phd", r"\b(ph\.?\s?d\.?|doctorate|doctoral degree)"),
)
VISA_NO = (
    r"(not|unable to|cannot|can't|won't|will not|do not|does not|are not able to)\s+(be able to\s+)?(provide\s+|offer\s+|support\s+)?(visa\s+|immigration\s+|employment\s+)?(sponsor|sponsorship)"
    r"|sponsorship (is )?not (available|provided|offered|possible)|without (the need for )?(current or future )?(visa |employer )?sponsorship|no (visa )?sponsorship"
)
VISA_YES = (
    r"(visa|immigration|work permit) (sponsorship|support) (is )?(available|provided|offered)|(will|can|we) sponsor|sponsorship (is )?available|offer(s|ing)? visa sponsorship"
    r"|provide(s)? visa sponsorship|relocation and visa|visa support"
)
EQUITY = r"\b(stock options?|rsus?\b|restricted stock|employee stock|esop\b|equity (grant|package|compensation|award|stake|component)|(competitive|meaningful|generous|significant|startup) equity|equity in the company)"
CLEARANCE = r"\b(security clearance|ts/sci|top secret|secret clearance|active clearance|clearance (is )?required|sc clearance|dv clearance|nv1|nv2|baseline clearance)"
TITLE_DROP = (
    r"\((.*?)\)|\[(.*?)\]|\s[-–|@]\s.*$|,.*$|\b(senior|sr\.?|junior|jr\.?|staff|principal|lead|intern(ship)?|entry[- ]level|mid[- ]level|associate|graduate|new grad"
    r"|i{1,3}|iv|v|l\d|level \d|[1-5])\b|\b(f/m/d|m/f/d|m/w/d|w/m/d|h/f|f/h)\b"
)
GARBAGE = ("not logged in", "log in to career profile", "access denied", "just a moment...", "page not found", "404", "403 forbidden", "sign in", "login", "redirecting")
MOJIBAKE = (("Â£", "£"), ("Â€", "€"), ("Â¥", "¥"), ("Ã©", "é"), ("Ã¨", "è"), ("Ã¼", "ü"), ("Ã¤", "ä"), ("Ã¶", "ö"), ("ÃŸ", "ß"))
#: Frequent words of the four languages that detection knows.
STOP_WORDS = {
    "en": ("the", "and", "of", "to", "is", "that", "for", "with", "on", "this", "are", "be"),
    "de": ("der", "die", "und", "das", "von", "mit", "ist", "ein", "eine", "den", "auf", "nicht"),
    "fr": ("le", "la", "les", "des", "et", "du", "un", "une", "que", "dans", "pour", "est"),
    "es": ("el", "los", "las", "del", "que", "en", "por", "con", "una", "para", "como", "su"),
}


def any_of(patterns: tuple[str, ...]) -> str:
    """One case-insensitive alternation."""
    return "(?i)(" + "|".join(patterns) + ")"


def is_tech_role(title: Column, department: Column | None = None) -> Column:
    """Blocked patterns win over allowed ones; blank text is no role."""
    text = F.concat(F.coalesce(title, F.lit("")), F.lit("  "), F.coalesce(department, F.lit("")) if department is not None else F.lit(""))
    return ~text.rlike(any_of(BLOCK)) & text.rlike(any_of(ALLOW))


def chain(rules: list[tuple[Column, str]], otherwise: Column) -> Column:
    """First rule that holds."""
    if not rules:
        return otherwise
    return reduce(lambda w, r: w.when(r[0], r[1]), rules[1:], F.when(*rules[0])).otherwise(otherwise)


def board_seniority(title: Column) -> Column:
    """Ordered buckets on the padded title; individual engineering titles without a level count as mid."""
    t = F.concat(F.lit(" "), title, F.lit(" "))
    ic = ~title.rlike("(?i)" + MANAGEMENT) & (is_tech_role(title) | title.rlike("(?i)" + INDIVIDUAL))
    rules = [(F.coalesce(title, F.lit("")) == "", "unknown")] + [(t.rlike(any_of(ps)), b) for b, ps in SENIORITY] + [(ic, "mid")]
    return chain(rules, F.lit("unknown"))


def fold(text: Column) -> Column:
    """Lower case without accents of Latin letters, gender markers dropped."""
    t = F.translate(F.lower(text), "àáâãäåçèéêëìíîïñòóôõöùúûüýÿ", "aaaaaaceeeeiiiinooooouuuuyy")
    t = F.regexp_replace(t, r"\(?\b(m/w/d|w/m/d|f/m/d|m/f/d|h/f|f/h)\b\)?", " ")
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def strict_seniority(title: Column) -> Column:
    """Level only where a rule leaves no doubt, else null."""
    t = fold(title)
    return chain([(t.rlike(p) & ~t.rlike(x) if x else t.rlike(p), lvl) for p, x, lvl in STRICT], F.lit(None).cast("string"))


def seniority(title: Column) -> Column:
    mapped = chain([(board_seniority(title) == k, v) for k, v in BOARD_TO_REPORT.items()], F.lit("unspecified"))
    return F.coalesce(strict_seniority(title), mapped)


def education(text: Column) -> Column:
    return chain([(text.rlike("(?i)" + p), lvl) for lvl, p in EDUCATION], F.lit("none_stated"))


def visa(text: Column) -> Column:
    return F.when(text.rlike("(?i)" + VISA_NO), "not_offered").when(text.rlike("(?i)" + VISA_YES), "offered").otherwise("not_mentioned")


def equity(text: Column) -> Column:
    return text.rlike("(?i)" + EQUITY)


def clearance(text: Column) -> Column:
    return text.rlike("(?i)" + CLEARANCE)


def clean_title(title: Column) -> Column:
    """Variants of a title as one: brackets, suffixes and levels go; 60 characters in title case; null under 2."""
    t = F.regexp_replace(title, "(?i)" + TITLE_DROP, " ")
    t = F.trim(F.regexp_replace(F.regexp_replace(t, r"[^\w&+#/ ]+", " "), r"\s+", " "))
    return F.when(F.length(t) >= 2, F.initcap(F.substring(t, 1, 60)))


def plain_text(html: Column) -> Column:
    t = F.regexp_replace(F.coalesce(html, F.lit("")), "<[^>]+>", " ")
    for a, b in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&amp;", "&")):
        t = F.replace(t, F.lit(a), F.lit(b))
    return F.trim(F.regexp_replace(t, r"\s+", " "))


def is_garbage_title(title: Column) -> Column:
    return F.coalesce(F.lower(F.trim(title)).isin(*GARBAGE), F.lit(False))


def repair_mojibake(text: Column) -> Column:
    for a, b in MOJIBAKE:
        text = F.replace(text, F.lit(a), F.lit(b))
    return text


def coerced_text(value: Column) -> Column:
    """A JSON text as one text: strings trimmed, lists as their distinct parts with ', ' between them (lists inside them
    likewise), objects and other scalars as their JSON; null for null, blank and empty."""
    v = F.try_parse_json(value)
    plain = lambda x: F.trim(F.coalesce(F.try_variant_get(x, "$", "string"), F.to_json(x)))
    listed = lambda x: F.try_variant_get(x, "$", "array<variant>")
    some = lambda xs: F.array_distinct(F.filter(xs, lambda t: t.isNotNull() & (t != "") & (t != "null")))
    inner = lambda x: F.when(listed(x).isNotNull(), F.array_join(some(F.transform(listed(x), plain)), ", ")).otherwise(plain(x))
    text = F.when(listed(v).isNotNull(), F.array_join(some(F.transform(listed(v), inner)), ", ")).otherwise(plain(v))
    return F.nullif(F.nullif(text, F.lit("")), F.lit("null"))


def coerced_list(value: Column) -> Column:
    """A JSON text as a list of distinct texts: the parts of a list, or the one text; null without any."""
    v = F.try_parse_json(value)
    listed = F.try_variant_get(v, "$", "array<variant>")
    parts = F.when(listed.isNotNull(), F.transform(listed, lambda x: coerced_text(F.to_json(x)))).otherwise(F.array(coerced_text(value)))
    kept = F.array_distinct(F.filter(parts, lambda t: t.isNotNull()))
    return F.when(F.size(kept) > 0, kept)


def titles(title: Column, localised: Column) -> Column:
    """Primary title, then those of the localisations; distinct, order kept."""
    return F.array_distinct(F.filter(F.concat(F.array(title), F.coalesce(localised, F.array().cast("array<string>"))), lambda x: x.isNotNull() & (x != "")))


def locales(primary: Column, others: Column, detected: Column) -> Column:
    """The primary locale (en without one), then those of the localisations, then detected ones; distinct, order kept."""
    none = F.array().cast("array<string>")
    return F.array_distinct(F.concat(F.array(F.coalesce(F.nullif(primary, F.lit("")), F.lit("en"))), F.coalesce(others, none), F.coalesce(detected, none)))


def technologies(text: Column, patterns: list[tuple[str, str, bool]]) -> Column:
    """Slugs whose literal stands in the text with no letter, digit or (after it) + or # next to it; a cheap substring test comes first.
    patterns: (slug, literal, case_sensitive)."""
    low, found = F.lower(text), []
    for slug, literal, exact in patterns:
        escaped = "".join("\\" + c if not c.isalnum() and c != " " else c for c in literal)
        hit = (text.contains(literal) if exact else low.contains(literal.lower())) & text.rlike(("" if exact else "(?i)") + rf"(?<![A-Za-z0-9]){escaped}(?![A-Za-z0-9+#])")
        found.append(F.when(hit, slug))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def packaged(name: str) -> list[dict[str, str]]:
    """Rows of a small CSV that comes with the package; lines from # on are comments."""
    lines = (files("jobmarket") / "data" / name).read_text("utf-8").splitlines()
    return list(csv.DictReader(x for x in lines if not x.startswith("#")))


def technology_table() -> list[tuple[str, tuple[str, ...], bool]]:
    """(slug, literals, case counts) of the technologies that come with the package."""
    return [(r["slug"], tuple(x.strip() for x in r["literals"].split("|") if x.strip()), "cs" in r["flags"]) for r in packaged("technologies.csv")]


def profile_table() -> tuple[tuple[str, str, str], ...]:
    """(profile, family, pattern) of the title rules that come with the package, in order."""
    return tuple((r["profile"], r["family"], r["pattern"]) for r in packaged("profiles.csv"))


def named_technologies(text: Column, table: list[tuple[str, tuple[str, ...], bool]]) -> Column:
    """Slugs, in the table's order, of technologies that a literal names as a whole word; a literal that begins or ends with
    a sign (C++, .NET) must not stand against a letter there. Substring tests come before the regular expression."""
    low, found = F.lower(text), []
    for slug, literals, exact in table:
        side = lambda c, sign: r"\b" if c.isalnum() or c == "_" else sign
        rx = "|".join(side(x[0], r"(?<!\w)") + "".join("\\" + c if not c.isalnum() and c != " " else c for c in x) + side(x[-1], r"(?!\w)") for x in literals)
        near = reduce(lambda a, b: a | b, [low.contains(x.lower()) for x in literals])
        found.append(F.when(near & text.rlike(("" if exact else "(?i)") + rx), slug))
    return F.filter(F.array(*found), lambda x: x.isNotNull())


def stop_word_hits(text: Column) -> Column:
    """How many words of a text are stop words, language by language in the order of STOP_WORDS."""
    words = F.split(F.lower(text), r"[^\p{L}]+")
    return F.array(*[F.size(F.filter(words, _among(ws))) for ws in STOP_WORDS.values()])


def language_by_hits(given: Column, hits: list[Column], length: Column) -> Column:
    """As language, of a text of some length whose parts have these hits."""
    counts = [F.struct(reduce(lambda a, b: a + b, [h[i] for h in hits]).alias("n"), F.lit(-i).alias("o"), F.lit(lang).alias("lang")) for i, lang in enumerate(STOP_WORDS)]
    best = F.greatest(*counts)
    found = F.when((length >= 20) & (best["n"] > 0), best["lang"]).otherwise("unknown")
    return F.coalesce(F.lower(F.substring(given, 1, 2)), found)


def language(given: Column, text: Column) -> Column:
    """The given language's first two letters, else the one with most stop words in the whole text (ties in the order
    en, de, fr, es), else unknown; unknown under 20 characters."""
    return language_by_hits(given, [stop_word_hits(text)], F.length(text))


def chunks(text: Column) -> Column:
    """The whole text in pieces of 500 characters at most, cut at the last white space; longer words are cut hard."""
    return F.transform(F.regexp_extract_all(text, F.lit(r"(?s).{1,500}\z|.{1,499}\s|.{500}"), F.lit(0)), lambda x: F.regexp_replace(x, r"^\s+|\s+\z", ""))


def _among(words: tuple[str, ...]):
    return lambda x: x.isin(*words)


def employment_type(raw: Column, aliases: dict[str, str]) -> Column:
    """Alias map; blank is unspecified, the rest other."""
    key = F.lower(F.trim(raw))
    return F.when(F.coalesce(raw, F.lit("")) == "", "unspecified").otherwise(chain([(key == a, v) for a, v in aliases.items()], F.lit("other")))


def assembled_description(text: Column, parts: list[Column]) -> Column:
    """Appends sections that the text does not hold yet and that are no placeholder."""
    for p in parts:
        fresh = p.isNotNull() & (F.length(F.trim(p)) > 3) & ~F.lower(F.trim(p)).isin("n/a", "none", "tbd") & ~text.contains(p)
        text = F.when(fresh, F.concat_ws("\n\n", text, p)).otherwise(text)
    return text


def slugify(name: Column) -> Column:
    t = F.replace(F.replace(fold(name), F.lit("&"), F.lit("and")), F.lit("+"), F.lit("plus"))
    return F.regexp_replace(F.regexp_replace(t, "[^a-z0-9]+", "-"), "^-+|-+$", "")


def label_tokens(name: Column) -> Column:
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(F.trim(F.regexp_replace(name, r"\s+", " "))), "[^a-z0-9]+"), lambda x: x != "")))


def locale_prefix(locale: Column) -> Column:
    return F.get(F.split(F.lower(locale), "[-_]"), F.lit(0))


def search_rank(query: str, fields: list[tuple[Column, float]]) -> tuple[Column, Column]:
    """(matches, rank) of a web search query: terms are all wanted, OR joins alternatives, -term is unwanted, quotes
    hold phrases. Rank: per wanted term, the field's weight times its hits; a blank query matches all with rank 0."""
    import shlex

    lexer = shlex.shlex(query.replace("'", " "), posix=True)
    lexer.whitespace_split, lexer.commenters = True, ""
    groups: list[list[str]] = []
    unwanted, join = [], False
    for token in lexer:
        if token == "OR":
            join = bool(groups)
        elif token.startswith("-") and len(token) > 1:
            unwanted.append(token[1:].lower())
        elif join:
            groups[-1].append(token.lower())
            join = False
        else:
            groups.append([token.lower()])
    text = F.lower(F.concat_ws(" \u001f ", *[c for c, _ in fields]))
    word = lambda t: r"(?<![\p{L}\p{N}])" + "".join("\\" + c if not c.isalnum() and c != " " else c for c in t) + r"(?![\p{L}\p{N}])"
    ok = F.lit(True)
    for g in groups:
        ok = ok & reduce(lambda a, b: a | b, [text.rlike(word(t)) for t in g])
    for t in unwanted:
        ok = ok & ~text.rlike(word(t))
    rank = F.lit(0.0)
    for g in groups:
        for t in g:
            for c, w in fields:
                rank = rank + F.regexp_count(F.lower(F.coalesce(c, F.lit(""))), F.lit(word(t))) * w
    return F.coalesce(ok, F.lit(False)), rank
