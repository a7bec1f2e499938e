"""Search, list and analytics as SQL table functions with named parameters, over a view of postings.

The view has id, title, company_slug, status, seniority, work and first_seen. Calls are expanded in the caller's plan, so
parameters are constants there and reach the scan as filters."""

from __future__ import annotations

from pyspark.sql import SparkSession

FILTERS = "(p_status = 'any' or status = p_status) and (p_companies is null or size(p_companies) = 0 or array_contains(p_companies, company_slug)) and (p_seniorities is null or size(p_seniorities) = 0 or array_contains(p_seniorities, seniority)) and (p_work is null or work = p_work)"
PARAMETERS = "p_status string default 'open', p_companies array<string> default null, p_seniorities array<string> default null, p_work string default null"
PAGE = "p_limit int default 20, p_offset int default 0"


def statements(view: str) -> dict[str, str]:
    """Name -> CREATE statement. search_jobs(p_query, ...): rows whose title has all words of the query, by the number of
    hits, newest first, with the total (one row of its own, which is sent to the page's rows); list_jobs(...): newest first, with the total; job_analytics(...): totals by
    company. Pages are cut by row numbers; a negative offset counts as 0."""
    kinds = "id bigint, title string, company_slug string, seniority string, first_seen timestamp"
    words = "filter(split(lower(p_query), '[^a-z0-9]+'), w -> w <> '')"
    has = "split(lower(coalesce(title, '')), '[^a-z0-9]+')"
    cut = "where place > greatest(p_offset, 0) and place <= greatest(p_offset, 0) + p_limit"
    numbered = lambda order, rows: f"(select *, row_number() over (order by {order}) as place from ({rows})) cross join (select count(*) as total from ({rows}))"
    found = f"select id, title, company_slug, seniority, first_seen, size(filter({has}, w -> array_contains({words}, w))) as hits from {view} where {FILTERS} and forall({words}, w -> array_contains({has}, w))"
    listed = f"select id, title, company_slug, seniority, first_seen from {view} where {FILTERS}"
    return {
        "search_jobs": f"create or replace temporary function search_jobs(p_query string default '', {PARAMETERS}, {PAGE}) returns table({kinds}, hits int, place int, total bigint) return select id, title, company_slug, seniority, first_seen, hits, place, total from {numbered('hits desc, first_seen desc, id desc', found)} {cut}",
        "list_jobs": f"create or replace temporary function list_jobs({PARAMETERS}, {PAGE}) returns table({kinds}, place int, total bigint) return select id, title, company_slug, seniority, first_seen, place, total from {numbered('first_seen desc, id desc', listed)} {cut}",
        "job_analytics": f"create or replace temporary function job_analytics({PARAMETERS}) returns table(company_slug string, jobs bigint, newest timestamp, seniorities array<string>) return select company_slug, count(*), max(first_seen), sort_array(collect_set(seniority)) from {view} where {FILTERS} group by company_slug",
    }


def register(spark: SparkSession, view: str) -> None:
    """Creates the functions in the session, over a view that it has."""
    for text in statements(view).values():
        spark.sql(text)
