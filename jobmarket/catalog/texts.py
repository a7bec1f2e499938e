"""Queries of text attributes over whole texts of the given tables, and their DuckDB twins."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.functions import automaton as AC
from jobmarket.functions import html_tree as HT
from jobmarket.functions import languages as LG
from jobmarket.plans import ranking as RK
from jobmarket.plans.frame import read
from jobmarket.sources import structured as SD

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


#: Aliases of an item of the benchmark: its first words, two to five; titles are the sentences of documents.
ALIASES = "select item_id, concat('b', item_id % 7) as slug, regexp_extract(lower(text), '^[^a-z]*([a-z]+([ ][a-z]+){' || (1 + item_id % 4)::int || '})', 1) as alias from benchmark"
SENTENCES = "select distinct lower(trim(unnest(string_split_regex(text, '[.\\n]')))) as title from documents"


@query("c1_taxonomy_titles", f"""with a as (select min(item_id) as ord, alias, min_by(slug, item_id) as slug from ({ALIASES}) where alias <> '' group by alias), t as (select title as given, trim(regexp_replace(strip_accents(title), '\\s+', ' ', 'g')) as title from ({SENTENCES}) where title <> ''),
e as (select title, slug from t join a on a.alias = t.title),
w as (select title, max_by(slug, length(alias) * 1000000 - ord) as slug from t join a on contains(title, alias) and regexp_matches(title, '(^|[ ,/\\-(])' || regexp_escape(alias) || '([ ,:/\\-)]|$)') where title not in (select title from e) group by title),
k as (select ord, slug, list_distinct(regexp_extract_all(alias, '[a-z0-9_]+')) as words from a where len(list_distinct(regexp_extract_all(alias, '[a-z0-9_]+'))) >= 4),
s as (select title, max_by(slug, len(words) * 1000000 - ord) as slug from (select title, regexp_extract_all(title, '[a-z0-9_]+') as has from t where title not in (select title from e union select title from w)) join k on list_has_all(has, words) group by title)
select given as title, slug from t join (select distinct * from (select title, slug from e union all select * from w union all select * from s)) using (title)""")
def taxonomy(spark, d):
    """Sentences against a taxonomy of aliases, by one automaton."""
    pick = F.expr("regexp_extract(lower(text), concat('^[^a-z]*([a-z]+([ ][a-z]+){', 1 + item_id % 4, '})'), 1)")
    rows = read(spark, d, "benchmark").select("item_id", pick.alias("alias"), F.expr("concat('b', item_id % 7)").alias("slug")).filter("alias <> ''").orderBy("item_id").limit(AC.TERMS + 1).collect()
    titles = read(spark, d, "documents").select(F.explode(F.split("text", r"[.\n]")).alias("t")).select(F.lower(F.trim("t")).alias("title")).filter("title <> ''").distinct()
    return titles.withColumn("slug", AC.best_alias([(r["alias"], r["slug"]) for r in rows])("title")).filter("slug is not null")


#: Terms of an item of the benchmark: its first three words, with and without regard to case.
TERMS = "select concat('b', item_id) as slug, regexp_extract(text, '^[A-Za-z]+ [A-Za-z]+ [A-Za-z]+', 0) as literal, item_id % 2 = 0 as strict from benchmark"


@query("c12_document_terms", f"""with t as (select * from ({TERMS}) where literal <> ''), x as materialized (select distinct text, lower(text) as low from documents where text is not null),
h as (select distinct text, slug from x join t on contains(low, lower(literal)) and regexp_matches(text, case when strict then '' else '(?i)' end || '(^|[^\\pL\\pN_])' || literal || '($|[^\\pL\\pN_])'))
select doc_id, slug from documents join h using (text)""")
def terms(spark, d):
    """A table of terms named in whole documents, by one automaton."""
    rows = read(spark, d, "benchmark").select(F.expr("concat('b', item_id)").alias("slug"), F.regexp_extract("text", "^[A-Za-z]+ [A-Za-z]+ [A-Za-z]+", 0).alias("literal"), (F.col("item_id") % 2 == 0).alias("exact")).filter("literal <> ''")
    docs = read(spark, d, "documents")
    return docs.join(AC.named_in(docs, rows), "text").select("doc_id", "slug")


#: The fold that trains: crc32 of the id modulo 5 is not 0 has no form in the twin, so the id itself is divided.
TRAINED = "doc_id % 5 <> 0"
_WORDS = "unnest(regexp_extract_all(lower(coalesce(text, '')), '\\pL+')) as word"
_GRAMS = "unnest(list_transform(range(1, length(word) + 1), lambda i: substr(' ' || word || ' ', i, 3))) as gram"
_MODEL = f"""g as (select lang, gram, sum(n) as n from (select lang, n, {_GRAMS} from (select lang, word, count(*) as n from (select lang, {_WORDS} from documents where lang is not null and {TRAINED}) group by all)) group by all),
k as (select lang, sum(n) as total, (select count(distinct gram) from g) as kinds from g group by lang),
wt as (select x.gram, k.lang, round(ln((coalesce(g.n, 0) + 0.5) / (total + 0.5 * (kinds + 1))) * 1000000)::bigint as weight from (select distinct gram from g union all select null) x cross join k left join g on g.lang = k.lang and g.gram = x.gram)"""


def _twin(source: str) -> str:
    return f"""{_MODEL}, bag as (select id, word, count(*) as n from (select id, {_WORDS} from {source}) group by all), gr as (select word, {_GRAMS} from (select distinct word from bag)),
sc as (select gr.word, k.lang, sum(coalesce(w.weight, u.weight)) as weight from gr cross join k left join wt w on w.gram = gr.gram and w.lang = k.lang join wt u on u.gram is null and u.lang = k.lang group by all),
sm as (select id, lang, sum(n * weight) as score from bag join sc using (word) group by all), best as (select id, min_by(lang, (-score, lang)) as found from sm group by id)"""


@query("c26_trigram_language", f"with {_twin('(select doc_id as id, text from documents)')} select doc_id, found, found = lang as right from documents left join best on id = doc_id")
def language(spark, d):
    """Languages of whole documents, by trigram weights trained on four fifths of them."""
    docs = read(spark, d, "documents")
    found = LG.scored(docs.selectExpr("doc_id as id", "text"), LG.train(docs.filter(TRAINED)))
    return docs.join(found.select(F.col("id").alias("doc_id"), F.col("lang").alias("found")), "doc_id", "left").select("doc_id", "found", (F.col("found") == F.col("lang")).alias("right"))


@query("a36_trigram_shares", f"with {_twin('''(select page_id || '-' || ln as id, line as text from (select page_id, unnest(string_split(html, '</p>')) as line, unnest(range(len(string_split(html, '</p>')))) as ln from pages))''')} select found as lang, count(*) as n from best group by found")
def shares(spark, d):
    """Languages of the paragraphs of all pages, by weights trained on documents."""
    parts = read(spark, d, "pages").select("page_id", F.posexplode(F.split("html", "</p>")).alias("ln", "text")).selectExpr("concat(page_id, '-', ln) as id", "text")
    return LG.scored(parts, LG.train(read(spark, d, "documents").filter(TRAINED))).groupBy("lang").agg(F.count("*").alias("n"))


SEARCH = 'the ering OR with "of the" -zu'
_STEM = lambda w: "case " + " ".join(f"when ends_with({w}, '{s}') and length({w}) >= {len(s) + 3}" + (" and not regexp_matches(" + w + ", '(ss|us|is)$')" if s == "s" else "") + f" then {w}[:-{len(s) + 1}] || '{i}'" for s, i in RK.SUFFIXES) + f" else {w} end"


@query("c46_cover_density", f"""with tok as (select doc_id as id, unnest(w) as word, unnest(range(len(w))) as pos, unnest(wt) as weight, unnest(f) as f from (
  select doc_id, list_concat(a, b) as w, list_concat(list_transform(a, lambda x: 1.0::double), list_transform(b, lambda x: 0.1::double)) as wt, list_concat(list_transform(a, lambda x: 0), list_transform(b, lambda x: 1)) as f
  from (select doc_id, regexp_extract_all(lower(coalesce(source, '')), '[\\pL\\pN]+') as a, regexp_extract_all(lower(coalesce(text, '')), '[\\pL\\pN]+') as b from documents))),
st as (select *, {_STEM('word')} as s from tok), nx as (select *, lead(s) over (partition by id, f order by pos) as s2 from st),
h as (select id, pos, weight, s = 'the' as t0, s in ('{RK.stemmed("ering")}', '{RK.stemmed("with")}') as t1, coalesce(s = '{RK.stemmed("of")}' and s2 = 'the', false) as t2, s = 'zu' as bad from nx),
o as (select id, pos, weight, t0, t1, t2, row_number() over p as nr, sum(1 / weight) over p as inv from h where t0 or t1 or t2 window p as (partition by id order by pos)),
l as (select *, max(case when t0 then pos end) over p as l0, max(case when t1 then pos end) over p as l1, max(case when t2 then pos end) over p as l2 from o window p as (partition by id order by pos)),
c as (select l.*, least(l0, l1, l2) as b from l where l0 is not null and l1 is not null and l2 is not null),
m as (select * from c qualify lag(b) over (partition by id order by pos) is null or b > lag(b) over (partition by id order by pos))
select m.id, round(sum((m.nr - x.nr + 1) / (m.inv - x.inv + 1 / x.weight) / (1 + (m.pos - b + 1) - (m.nr - x.nr + 1))), 6) as rank from m join o x on x.id = m.id and x.pos = m.b where m.id not in (select id from h where bad) group by m.id""")
def search(spark, d):
    """Documents by cover density, with alternatives, a phrase and an unwanted word."""
    found = RK.ranked(read(spark, d, "documents"), "doc_id", SEARCH, [("source", 1.0), ("text", 0.1)])
    return found.select("id", F.round("rank", 6).alias("rank"))


#: What the twin leaves of a page's text: no hidden parts, comments, tags or white space, and entities resolved; HTML
#: reads these entities without their semicolon too.
_SEEN = "regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style|noscript|head|svg|iframe)[ >].*?</(script|style|noscript|head|svg|iframe)>', '', 'g'), '(?s)<!--.*?-->', '', 'g'), '<[!/a-zA-Z][^>]*>', '', 'g')"
for _entity, _char in (("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&copy;", "\u00a9"), ("&middot;", "\u00b7"), ("&amp;", "&")):
    _SEEN = f"regexp_replace({_SEEN}, '{_entity}?', '{_char}', 'g')"


@query("c37_normal_pages", f"""select page_id, md5(regexp_replace({_SEEN}, '[\\s\u00a0]+', '', 'g')) as text_md5, len(regexp_extract_all(html, '<li[ >]'))::int as n_items, len(regexp_extract_all(html, '<h[12][ >]'))::int as n_headings, false as rejected from pages""")
def normal_pages(spark, d):
    """Pages as trees of few tags; their words in order, list items and headings, and whether too little is left."""
    p = read(spark, d, "pages").select("page_id", HT.normal_page("html").alias("n"))
    count = lambda rx: F.regexp_count("n.html", F.lit(rx)).cast("int")
    return p.select("page_id", F.md5(F.regexp_replace("n.text", "[\\s\u00a0]+", "").cast("binary")).alias("text_md5"), count("<li>").alias("n_items"), count("<h2>").alias("n_headings"), (F.col("n.coverage") < HT.LEAST_COVERAGE).alias("rejected"))


#: Pages with structured data of several shapes around a posting that is made of the page's own columns.
_JOB = """concat('{"@type":"JobPosting","title":"Job ', page_id, '","hiringOrganization":{"name":"C', page_id % 40, '"},"jobLocation":[{"address":{"addressLocality":"T', page_id % 17, '","addressCountry":"X"}},{"address":"Y', page_id % 5, '"}],"baseSalary":{"currency":"EUR","value":{"minValue":', page_id, ',"maxValue":"', page_id * 2, '"}}}')"""
_SHAPED = f"""select page_id, concat('<script type="application/ld+json">', case page_id % 6 when 0 then {_JOB} when 1 then concat('[{{"@type":"Organization"}},', {_JOB}, ']') when 2 then concat('{{"@graph":[{{"@type":"WebPage"}},[', {_JOB}, ']]}}') when 3 then concat('{{"broken JobPosting"</script><script type="application/ld+json">', {_JOB})
when 4 then concat('[[', {_JOB}, ',{{"@type":"JobPosting","title":"second"}}]]') else '{{"@type":"Organization","name":"JobPosting"}}' end, '</script>', coalesce(html, '')) as html from pages"""


@query("s10_structured_pages", "select page_id, 'Job ' || page_id as title, 'C' || page_id % 40 as company, 'T' || page_id % 17 || ', X|Y' || page_id % 5 as locations, page_id::double as pay_min, page_id * 2.0::double as pay_max from pages where page_id % 6 < 5")
def structured(spark, d):
    """Postings in objects, lists and graphs of structured data, with pay, places and company."""
    read(spark, d, "pages").createOrReplaceTempView("pages")
    found = SD.job_postings(spark.sql(_SHAPED))
    return found.select("page_id", "title", "company", F.array_join("locations", "|").alias("locations"), F.col("pay.min").alias("pay_min"), F.col("pay.max").alias("pay_max"))
