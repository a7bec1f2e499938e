"""Queries over attribute functions: titles, texts, pay, places, times, urls, keys; and over raw payloads and pages."""

from __future__ import annotations

from pyspark.sql import functions as F

from jobmarket.functions import automaton as AC
from jobmarket.functions import extract as E
from jobmarket.functions import text as T
from jobmarket.functions import values as V
from jobmarket.operators import tables as M
from jobmarket.plans import analytics as A
from jobmarket.plans.frame import read
from jobmarket.sources import payloads as S

QUERIES, SQL = {}, {}


def query(name: str, sql: str | None = None):
    def add(f):
        QUERIES[name] = f
        if sql:
            SQL[name] = sql
        return f

    return add


TITLES = (
    "Senior Software Engineer II, Payments", "Barista", "Junior Data Scientist (m/w/d)", "Staff Engineer - Platform", "Head of Engineering", "Sales Engineer", "Machine Learning Intern",
    "CTO", "Lead Generation Manager", "Lead Developer", "SDE II", "Software Engineer", "Account Executive", "Director of Product", "Werkstudent IT", "VP Finance", "Principal Architect", "Nurse",
    "Graduate Program Analyst", "Site Reliability Engineer III", "Security Analyst", "Recruiter", "Access Denied", "Data Engineer L5",
)
NOTES = (
    "Bachelor's or Master's degree required.", "We are unable to sponsor visas.", "Diversity, equity and inclusion matter.", "Stock options and visa sponsorship available.", "TS/SCI security clearance. PhD preferred.",
    "High school diploma. $150,000 - $200,000 per year.", "5+ years of experience with Python and C++. Equity package.", "3-5 years experience; no visa sponsorship; €60.000 per year.",
)
PLACES = ("San Francisco, CA", "Bengaluru, India", "Remote - US", "Berlin, Germany", "Austin, TX", "Toronto, ON", "", "London", "Pune", "U.S. only", "Indianapolis, IN", "Remote (EMEA)")
DATES = ("2024-03-05T10:00:00Z", "2024-03-05", "Tue, 05 Mar 2024 10:00:00 GMT", "2024-03-05 10:00:00", "soon", "2024-03-05T10:00:00+02:00", None)


def _q(x) -> str:
    return "null" if x is None else "'" + x.replace("'", "''") + "'"


def pick(values, key: str) -> str:
    """CASE expression that both engines read: the value at key modulo the number of values."""
    return f"case {key} % {len(values)} " + " ".join(f"when {i} then {_q(v)}" for i, v in enumerate(values)) + " end"


def spark_pick(values, key: str):
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))


def titled(spark, d):
    return read(spark, d, "orders").select("o_orderkey", spark_pick(TITLES, "o_orderkey").alias("title"), spark_pick(NOTES, "o_custkey").alias("note"), spark_pick(PLACES, "o_custkey").alias("place"), spark_pick(DATES, "o_orderkey").alias("raw_date"))


TT = f"tt as (select o_orderkey, {pick(TITLES, 'o_orderkey')} as title, {pick(NOTES, 'o_custkey')} as note, {pick(PLACES, 'o_custkey')} as place, {pick(DATES, 'o_orderkey')} as raw_date from orders)"


def rx(column: str, pattern: str) -> str:
    return f"regexp_matches({column}, {_q(pattern)})"


TECH = f"(not {rx('title', T.any_of(T.BLOCK))} and {rx('title', T.any_of(T.ALLOW))})"
BOARD = "case " + " ".join(f"when {rx(chr(39) + ' ' + chr(39) + ' || title || ' + chr(39) + ' ' + chr(39), T.any_of(ps))} then '{b}'" for b, ps in T.SENIORITY) + f" when not {rx('title', '(?i)' + T.MANAGEMENT)} and ({TECH} or {rx('title', '(?i)' + T.INDIVIDUAL)}) then 'mid' else 'unknown' end"
FOLD = "trim(regexp_replace(regexp_replace(lower(title), '\\(?\\b(m/w/d|w/m/d|f/m/d|m/f/d|h/f|f/h)\\b\\)?', ' ', 'g'), '\\s+', ' ', 'g'))"
STRICT = "case " + " ".join(f"when {rx('fold', p)}" + (f" and not {rx('fold', x)}" if x else "") + f" then '{lvl}'" for p, x, lvl in T.STRICT) + " end"


@query("f1_tech_roles", f"with {TT} select o_orderkey, title, {TECH} as tech from tt")
def tech(spark, d):
    """role filter on titles."""
    return titled(spark, d).select("o_orderkey", "title", T.is_tech_role(F.col("title")).alias("tech"))


@query("f7_garbage_titles", f"with {TT} select o_orderkey from tt where lower(trim(title)) in ('access denied', 'not logged in', '404')")
def garbage(spark, d):
    """titles of broken pages."""
    return titled(spark, d).filter(T.is_garbage_title(F.col("title"))).select("o_orderkey")


@query("c3_strict_seniority", f"with {TT} select o_orderkey, {STRICT} as level from (select *, {FOLD} as fold from tt)")
def strict(spark, d):
    """Ordered rules on folded titles."""
    return titled(spark, d).select("o_orderkey", T.strict_seniority(F.col("title")).alias("level"))


@query("c4_board_seniority", f"with {TT} select o_orderkey, {BOARD} as level from tt")
def board(spark, d):
    """C4: ordered buckets."""
    return titled(spark, d).select("o_orderkey", T.board_seniority(F.col("title")).alias("level"))


@query("c5_report_seniority", f"with {TT}, x as (select o_orderkey, {STRICT} as s, {BOARD} as b from (select *, {FOLD} as fold from tt)) select o_orderkey, coalesce(s, case b when 'junior' then 'entry' when 'unknown' then 'unspecified' else b end) as level from x")
def report_seniority(spark, d):
    """Strict rules, else the mapped heuristic."""
    return titled(spark, d).select("o_orderkey", T.seniority(F.col("title")).alias("level"))


SIGNALS = "case " + " ".join(f"when {rx('note', '(?i)' + p)} then '{lvl}'" for lvl, p in T.EDUCATION) + " else 'none_stated' end as education, case when " + rx("note", "(?i)" + T.VISA_NO) + " then 'not_offered' when " + rx("note", "(?i)" + T.VISA_YES) + " then 'offered' else 'not_mentioned' end as visa, " + rx("note", "(?i)" + T.EQUITY) + " as equity, " + rx("note", "(?i)" + T.CLEARANCE) + " as clearance"


@query("c6_description_signals", f"with {TT} select o_orderkey, {SIGNALS} from tt")
def signals(spark, d):
    """Education, visa, equity and clearance."""
    n = F.col("note")
    return titled(spark, d).select("o_orderkey", T.education(n).alias("education"), T.visa(n).alias("visa"), T.equity(n).alias("equity"), T.clearance(n).alias("clearance"))


@query("c9_clean_title")
def clean(spark, d):
    """Variants of a title as one."""
    return titled(spark, d).select("o_orderkey", T.clean_title(F.col("title")).alias("title"))


@query("c10_plain_text", "select page_id, length(trim(regexp_replace(replace(replace(replace(replace(replace(replace(regexp_replace(html, '<[^>]+>', ' ', 'g'), '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '\"'), '&#39;', ''''), '&amp;', '&'), '\\s+', ' ', 'g'))) as n from pages")
def plain(spark, d):
    """Tags stripped, entities resolved, white space collapsed."""
    return read(spark, d, "pages").select("page_id", F.length(T.plain_text(F.col("html"))).cast("long").alias("n"))


@query("c12_technologies")
def techs(spark, d):
    """Technologies named in notes."""
    return titled(spark, d).select("o_orderkey", F.array_join(T.technologies(F.col("note"), [("python", "Python", False), ("cpp", "C++", False), ("c", "C", True), ("sql", "SQL", True)]), ",").alias("technologies"))


@query("c13_experience")
def experience(spark, d):
    """Years of experience, one evaluation per distinct note."""
    t = titled(spark, d)
    known = t.select("note").distinct().withColumn("years", E.years_of_experience("note"))
    return t.join(known, "note").select("o_orderkey", "years")


@query("c14_pay_in_text")
def pay(spark, d):
    """Pay found in notes, annual."""
    t = titled(spark, d)
    known = t.select("note").distinct().withColumn("p", E.pay_in_text("note"))
    got = V.annual(F.col("p.min"), F.col("p.max"), F.col("p.currency"), F.col("p.unit"), "description")
    return t.join(known.select("note", got.alias("g")), "note").select("o_orderkey", "g.min", "g.max", "g.currency", "g.unit")


@query("c1_occupation")
def occupation(spark, d):
    """Taxonomy match of titles, one evaluation per distinct title."""
    match = AC.best_alias([("software engineer", "software-engineer"), ("data scientist", "data-scientist"), ("data engineer", "data-engineer"), ("barista", "barista"), ("nurse", "nurse"), ("recruiter", "recruiter")])
    t = titled(spark, d)
    return t.join(t.select("title").distinct().withColumn("occupation", match("title")), "title").select("o_orderkey", "occupation")


@query("c18_places")
def places(spark, d):
    """Places resolved once per distinct text."""
    resolve = E.place_resolver({"san francisco": ("US", 870_000), "berlin": ("DE", 3_600_000), "austin": ("US", 960_000), "toronto": ("CA", 2_900_000), "london": ("GB", 8_900_000), "pune": ("IN", 3_100_000)}, {"germany": "DE", "india": "IN", "us": "US"}, {"ca": "US", "tx": "US", "on": "CA", "in": "US"})
    t = titled(spark, d)
    return t.join(t.select("place").distinct().withColumn("p", resolve("place")), "place").select("o_orderkey", "p.country", "p.city", "p.region", "p.mode")


IN_RX = "\\b(" + "|".join(x.replace(".", "\\.").replace("-", "\\-").replace("(", "\\(").replace(")", "\\)") for x in V.INDIA_CITIES + V.INDIA_MARKERS) + ")\\b"
US_RX = "\\b(" + "|".join(x.replace(".", "\\.").replace("-", "\\-").replace("(", "\\(").replace(")", "\\)") for x in V.US_MARKERS + V.US_CITIES) + ")\\b"
STATE_RX = ",\\s*(" + "|".join(s.lower() for s in V.US_STATES) + ")\\b"


@query("c20_country_bucket", f"with {TT} select o_orderkey, case when place = '' then null when {rx('lower(place)', IN_RX)} then 'IN' when regexp_matches(lower(place), 'u\\.s\\.(a\\.?)?') or {rx('lower(place)', US_RX)} or {rx('lower(place)', STATE_RX)} then 'US' else 'other' end as bucket from tt")
def country(spark, d):
    """C20: IN, US, other."""
    return titled(spark, d).select("o_orderkey", V.country_bucket(F.col("place"), F.lit(None).cast("string")).alias("bucket"))


@query("c16_normalise_pay", "with x as (select o_orderkey, o_totalprice as hi, o_totalprice / 2 as lo, case o_orderkey % 4 when 0 then 'hour' when 1 then 'month' when 2 then 'year' else 'fortnight' end as unit, case when o_orderkey % 9 = 0 then 'E' else 'eur' end as cur from orders) select o_orderkey, round(lo * case unit when 'hour' then 2080 when 'month' then 12 else 1 end, 0) as pay_min, round(hi * case unit when 'hour' then 2080 when 'month' then 12 else 1 end, 0) as pay_max, upper(cur) as currency from x where unit <> 'fortnight' and cur = 'eur'")
def normalise(spark, d):
    """Bounds in order, annual, known units and three-letter currencies only."""
    x = read(spark, d, "orders").selectExpr("o_orderkey", "o_totalprice as hi", "o_totalprice / 2 as lo", "case o_orderkey % 4 when 0 then 'hour' when 1 then 'month' when 2 then 'year' else 'fortnight' end as unit", "case when o_orderkey % 9 = 0 then 'E' else 'eur' end as cur")
    s = V.annual(F.col("hi"), F.col("lo"), F.col("cur"), F.col("unit"), "structured")
    return x.select("o_orderkey", s.alias("s")).filter("s is not null").select("o_orderkey", F.round("s.min", 0).alias("pay_min"), F.round("s.max", 0).alias("pay_max"), "s.currency")


@query("c25_posted_at", f"with {TT} select o_orderkey, case when raw_date is null or raw_date = 'soon' then null when raw_date = '2024-03-05' then timestamp '2024-03-05' when raw_date like '%+02:00' then timestamp '2024-03-05 08:00:00' else timestamp '2024-03-05 10:00:00' end as posted_at from tt")
def posted(spark, d):
    """Dates of several formats."""
    return titled(spark, d).select("o_orderkey", V.posted_at(F.col("raw_date"), F.lit("2024-06-01").cast("timestamp")).alias("posted_at"))


@query("c26_language")
def language(spark, d):
    """Language by stop words."""
    return read(spark, d, "documents").select("doc_id", T.language(F.lit(None).cast("string"), F.col("text")).alias("language"))


@query("c28_keys", "with c as (select c_custkey, c_name, 'c' || c_nationkey || '|' || c_custkey as k from customer) select c_custkey, substr(sha256(k), 1, 16) as key_hex, substr(sha256(c_name), 1, 16) as content_hex from c")
def keys(spark, d):
    """Stable 64-bit keys (as hex; the functions return signed longs)."""
    c = read(spark, d, "customer").select("c_custkey", V.job_key(F.concat(F.lit("c"), "c_nationkey"), F.col("c_custkey").cast("string")).alias("k"), V.content_hash(F.col("c_name")).alias("h"))
    hexed = lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))
    return c.select("c_custkey", hexed("k").alias("key_hex"), hexed("h").alias("content_hex"))


#: CRC-32 of a text of ASCII characters, bit by bit.
CRC32 = """xor(list_reduce(list_concat([4294967295::bigint], list_transform(string_split(c_name, ''), lambda c: ascii(c)::bigint)),
  lambda c, b: list_reduce(list_concat([xor(c, b)], [0::bigint, 0, 0, 0, 0, 0, 0, 0]), lambda x, y: xor(x >> 1, 3988292384 * (x & 1)))), 4294967295)"""


@query("c29_board_hash", f"with h as (select c_custkey, {CRC32} as crc from customer) select c_custkey, crc & 2147483647 as hash, (crc % 6)::int as shard from h")
def board_hash(spark, d):
    """31-bit board hash and shard."""
    return read(spark, d, "customer").select("c_custkey", V.board_hash(F.col("c_name")).alias("hash"), V.shard(F.col("c_name"), 6).alias("shard"))


@query("c30_fingerprint", "select c_custkey, sha256(concat_ws(chr(31), c_name, c_mktsegment, c_nationkey::varchar)) as fingerprint from customer")
def fingerprint(spark, d):
    """Row fingerprint."""
    return read(spark, d, "customer").select("c_custkey", M.fingerprint([F.col("c_name"), F.col("c_mktsegment"), F.col("c_nationkey")]).alias("fingerprint"))


@query("c31_dataset_digest", "with h as (select c_nationkey as part, sha256(c_name) as h from customer) select part, sha256(string_agg(h, '' order by h)) as digest, count(*) as n from h group by 1")
def dataset_digest(spark, d):
    """Digest of every partition over its sorted row hashes."""
    h = read(spark, d, "customer").select(F.col("c_nationkey").alias("part"), F.sha2("c_name", 256).alias("h"))
    return M.ordered_digest(h)


@query("c33_normalised_url", """with p as (select page_id, url, lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:]+)', 1)) as host, regexp_replace(regexp_extract(url, '^[A-Za-z]+://[^/?#]+([^?#]*)', 1), '/+$', '') as path, regexp_extract(url, '\\?([^#]*)', 1) as q from pages),
k as (select page_id, host, path, list_sort(list_filter(string_split(q, '&'), lambda x: x <> '' and not starts_with(lower(x), 'utm_') and lower(split_part(x, '=', 1)) not in ('ref', 'source', 'gclid', 'fbclid', 'gh_src'))) as kept from p)
select page_id, 'https://' || host || case when path = '' then '/' else path end || case when len(kept) = 0 then '' else '?' || array_to_string(kept, '&') end as url from k""")
def urls(spark, d):
    """Urls in normal form."""
    return read(spark, d, "pages").select("page_id", V.normalised_url(F.col("url")).alias("url"))


@query("c34_tenant_keys", "select page_id, case page_id % 3 when 0 then lower(nullif(regexp_extract(url, '^https?://[^/]+/([^/?#]+)', 1), '')) when 1 then lower(nullif(regexp_extract(url, '^https?://([^./]+)\\.', 1), '')) else lower(nullif(regexp_extract(url, '[?&]c=([^&#]+)', 1), '')) end as tenant from pages")
def tenants(spark, d):
    """Tenants by family."""
    family = F.element_at(F.array(F.lit("path"), F.lit("subdomain"), F.lit("query")), (F.col("page_id") % 3 + 1).cast("int"))
    return read(spark, d, "pages").select("page_id", V.tenant_key(family, F.col("url")).alias("tenant"))


@query("c35_labels_and_slugs", "select p_partkey, array_to_string(list_sort(list_distinct(list_filter(regexp_split_to_array(lower(trim(p_name)), '[^a-z0-9]+'), lambda x: x <> ''))), ' ') as tokens, regexp_replace(regexp_replace(lower(p_name), '[^a-z0-9]+', '-', 'g'), '^-+|-+$', '', 'g') as slug from part")
def labels(spark, d):
    """Token sets and slugs of names."""
    return read(spark, d, "part").select("p_partkey", F.array_join(T.label_tokens(F.col("p_name")), " ").alias("tokens"), T.slugify(F.col("p_name")).alias("slug"))


@query("c39_page_blocks")
def blocks(spark, d):
    """Visible blocks of pages and text coverage."""
    p = E.with_page_blocks(read(spark, d, "pages").select("page_id", "html"))
    return p.select("page_id", F.size("blocks").alias("n_blocks"), F.round(E.coverage(T.plain_text(F.col("normal")), T.plain_text(F.col("html"))), 4).alias("coverage"))


@query("c41_experience_codes", "select o_orderkey, case when o_orderkey % 3 = 0 then -1 else cast(ceil((o_orderkey % 17) / 2.0) as int) end as low, case when o_orderkey % 3 = 0 and o_orderkey % 5 = 0 then -1 when o_orderkey % 5 = 0 then 99 else cast(floor((o_orderkey % 19) / 2.0) as int) end as high from orders")
def codes(spark, d):
    """Sentinels of open bounds."""
    low, high = V.experience_codes(F.expr("case when o_orderkey % 3 <> 0 then (o_orderkey % 17) / 2 end"), F.expr("case when o_orderkey % 5 <> 0 then (o_orderkey % 19) / 2 end"))
    return read(spark, d, "orders").select("o_orderkey", low.alias("low"), high.alias("high"))


@query("c44_iso_weeks", "select o_orderkey, strftime(o_orderdate, '%G-W%V') as week, date_trunc('week', o_orderdate)::date as first_day, date_trunc('week', o_orderdate)::date + 6 as last_day from orders")
def weeks(spark, d):
    """ISO week and its bounds."""
    first, last = V.week_bounds(F.col("o_orderdate"))
    return read(spark, d, "orders").select("o_orderkey", V.iso_week(F.col("o_orderdate")).alias("week"), first.alias("first_day"), last.alias("last_day"))


@query("c46_text_search", """with o as (select doc_id, text, source from documents), m as (select doc_id, text from o where regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])(the)([^\\p{L}\\p{N}]|$)') and regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])(with|from)([^\\p{L}\\p{N}]|$)') and not regexp_matches(lower(text), '(^|[^\\p{L}\\p{N}])(moron)([^\\p{L}\\p{N}]|$)')) select doc_id from m""")
def text_search(spark, d):
    """Terms, alternatives and exclusions over whole texts."""
    ok, _ = T.search_rank("the with OR from -moron", [(F.col("text"), 1.0)])
    return read(spark, d, "documents").filter(ok).select("doc_id")


@query("k6_ranked_search")
def ranked(spark, d):
    """A page of ranked search over titles with the exact total."""
    t = titled(spark, d).join(read(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").alias("first_seen"), F.when(F.col("o_orderstatus") == "F", "closed").otherwise("open").alias("status")), "o_orderkey").withColumnRenamed("o_orderkey", "id")
    return A.search(t, '"software engineer" OR scientist -payments', [("title", 4.0), ("note", 1.0)], limit=50).select("id", "title", "rank", "total")


@query("c47_locale_and_domain", "select page_id, split_part(split_part(url, '://', 2), '/', 1) as domain from pages")
def domains(spark, d):
    """Host part of urls."""
    return read(spark, d, "pages").select("page_id", V.domain(F.col("url")).alias("domain"))


@query("f4_posting_record", f"with {TT} select o_orderkey, title, nullif(place, '') as location, coalesce(nullif(place, ''), 'unknown') as department from tt")
def record(spark, d):
    """One record of lists and optional fields."""
    t = titled(spark, d)
    both = T.titles(F.col("title"), F.array("title"))
    return t.select("o_orderkey", F.get(both, F.lit(0)).alias("title"), F.nullif("place", F.lit("")).alias("location"), F.coalesce(F.nullif("place", F.lit("")), F.lit("unknown")).alias("department"))


@query("s5_json_column", "select event_id, cast(json_extract(props, '$.k') as bigint) as k from events")
def json_column(spark, d):
    """Fields of a JSON column by a declared mapping."""
    return S.mapped(read(spark, d, "events"), "props", {"k": {"path": "$.k", "type": "bigint"}}).select("event_id", "k")


@query("s8_payload_mapping", "select o_orderkey as id, 'https://boards.example/' || o_orderkey as url, 'T' || o_orderkey % 60 as title, 'City ' || o_custkey % 30 as location from orders where o_orderkey % 13 <> 0")
def payload(spark, d):
    """Raw payloads mapped to postings by provider; rows without a url are dropped."""
    o = read(spark, d, "orders")
    raw = o.select("o_orderkey", F.to_json(F.struct(F.col("o_orderkey").alias("id"), F.when(F.col("o_orderkey") % 13 != 0, F.concat(F.lit("https://boards.example/"), "o_orderkey")).alias("absolute_url"), F.concat(F.lit("T"), F.col("o_orderkey") % 60).alias("title"), F.struct(F.concat(F.lit("City "), F.col("o_custkey") % 30).alias("name")).alias("location"))).alias("payload"))
    return S.PROVIDERS["greenhouse"](raw, "payload").select(F.col("source_identity").cast("long").alias("id"), "url", "title", F.get("locations", F.lit(0)).alias("location"))


@query("s9_search_payload", "select l_orderkey, 'https://t.dc.example/site/job/' || l_linenumber || '_' || l_partkey as url, 'R' || l_partkey as requisition_id from lineitem")
def search_payload(spark, d):
    """Search results with nested postings."""
    li = read(spark, d, "lineitem")
    post = F.struct(F.concat(F.lit("/job/"), "l_linenumber", F.lit("_"), "l_partkey").alias("externalPath"), F.lit("x").alias("title"), F.array(F.concat(F.lit("R"), "l_partkey")).alias("bulletFields"))
    raw = li.groupBy("l_orderkey").agg(F.to_json(F.struct(F.collect_list(post).alias("jobPostings"))).alias("payload"))
    return S.search_results(raw, "payload", "https://t.dc.example", "site", keep=["l_orderkey"]).select("l_orderkey", "url", "requisition_id")


@query("s10_page_meta", "select page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title', 1), '\\s+', ' ', 'g')) as title from pages")
def page_meta(spark, d):
    """Structured data of pages, else their title."""
    return S.page_postings(read(spark, d, "pages")).select("page_id", "title")


@query("r20_dimension_checks", "with c as (select 'c-' || c_custkey % 1450 as slug from customer), b as (select 'c-' || o_custkey as company_slug from orders) select 'duplicate' as kind, slug from c group by 2 having count(*) > 1 union all select distinct 'orphan', company_slug from b where company_slug not in (select slug from c)")
def dimension_checks(spark, d):
    """Violations of dimension data."""
    c = read(spark, d, "customer").selectExpr("concat('c-', c_custkey % 1450) as slug")
    return A.dimension_violations(c, read(spark, d, "orders").selectExpr("concat('c-', o_custkey) as company_slug"))


@query("r21_retirement", "with h as (select 'b' || user_id % 40 as board, 'c' || user_id % 12 as company, count(*) filter (event_type = 'error') as failures, count(*) filter (event_type <> 'error') as successes, max(ts) as last_seen from events group by 1, 2) select board, company, case when successes = 0 then 'never_worked' when failures > 5 and date_diff('day', last_seen::date, date '2024-02-20') > 20 then 'retire' when failures > 5 then 'watch' else 'healthy' end as class from h")
def retirement(spark, d):
    """Evidence about boards as classes."""
    h = A.board_health(read(spark, d, "events")).withColumn("quiet_days", F.datediff(F.lit("2024-02-20").cast("date"), F.col("last_seen").cast("date")))
    return h.select("board", "company", A.retirement_class().alias("class"))


@query("r18_label_checks", "select doc_id, quality, toxic, toxic = 1 and quality = 1 as contradictory from labels")
def label_rules(spark, d):
    """Rules over label rows."""
    return read(spark, d, "labels").select("doc_id", "quality", "toxic", ((F.col("toxic") == 1) & (F.col("quality") == 1)).alias("contradictory"))


@query("r24_record_assembly", "select conv_id, count(*) as n_turns, string_agg(role, '>' order by turn, role, text) as roles, sum(length(text))::bigint as n_chars from conversations group by 1")
def assembly(spark, d):
    """Nested records of ordered turns."""
    turns = F.sort_array(F.collect_list(F.struct("turn", "role", "text")))
    c = read(spark, d, "conversations").groupBy("conv_id").agg(turns.alias("turns"))
    return c.select("conv_id", F.size("turns").cast("long").alias("n_turns"), F.array_join("turns.role", ">").alias("roles"), F.aggregate("turns", F.lit(0).cast("long"), lambda a, x: a + F.length(x["text"])).alias("n_chars"))


@query("r25_cdc_repair", "select o_orderkey from orders where o_orderstatus = 'O' and o_orderkey % 10 = 2 and o_orderdate < timestamp '1997-01-01'")
def cdc_repair(spark, d):
    """Active here, absent there, older than a cutoff."""
    o = read(spark, d, "orders")
    there = o.filter("o_orderkey % 10 <> 2").select("o_orderkey")
    return o.filter("o_orderstatus = 'O' and o_orderdate < timestamp '1997-01-01'").join(there, "o_orderkey", "left_anti").select("o_orderkey")


@query("s7_currency_rates", "select o_orderkey, case when o_orderkey > 0 then cast(round(7.0::double / o_orderkey, 6) as decimal(24,6)) end as to_eur from orders")
def rates(spark, d):
    """Reciprocal rates, kept to 12 decimals; shown to 6, where both engines round alike."""
    return read(spark, d, "orders").select("o_orderkey", F.round(V.to_euro(F.col("o_orderkey") / 7.0), 6).cast("decimal(24,6)").alias("to_eur"))
