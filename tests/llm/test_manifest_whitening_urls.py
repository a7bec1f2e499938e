"""Merkle manifest, whitening and URL templates against brute force and edge cases."""

import hashlib
import math
import random
import re
import zlib
from collections import defaultdict
from fractions import Fraction

import numpy as np
import pytest

from jobmarket.llm import merkle, url_templates, whitening

# --- Merkle manifest --------------------------------------------------------------------------------------------------

DOCS = "doc_id long, text string, lang string, source string, n_chars long, owner string, block long, leaf string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def walk(nodes, at):
    """Siblings (before, after) of a leaf up to the root, and the root."""
    steps = []
    while len(nodes) > 1:
        s = at - at % 3
        steps.append(("".join(nodes[s:at]), "".join(nodes[at + 1 : s + 3])))
        nodes, at = [h(*nodes[i : i + 3]) for i in range(0, len(nodes), 3)], at // 3
    return steps, nodes[0]


def by_hand(rows):
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of (doc_id, source, lang, n_chars, text)."""
    trees = defaultdict(list)
    for r in rows:
        changed = r[:4] + (r[4].replace("\n", ""),) if r[0] is not None and r[4] is not None and zlib.crc32(str(r[0]).encode()) % 2 == 0 else r
        trees[r[1]].append((r[0] is not None, r[0] or 0, h(*map(field, r)), h(*map(field, changed))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    for t in trees.values():
        t.sort()
    subroots = [walk([x[2] for x in trees[s]], 0)[1] for s in names]
    out = []
    for i, s in enumerate(names):
        upper, root = walk(subroots, i)
        for at, (known, doc_id, leaf, node) in enumerate(trees[s]):
            steps = walk([x[2] for x in trees[s]], at)[0] + upper
            for before, after in steps:
                node = h(before, node, after)
            out.append((doc_id if known else None, leaf, subroots[i], root, h(*[b + a for b, a in steps]), node, node == root))
    return out


@pytest.mark.parametrize("sizes", [{"a": 1}, {"a": 2, None: 1, "": 3}, {"a": 4, "b": 28, "é": 10, "z": 9, "m": 1, None: 5}])
def test_manifest_against_brute_force(spark, sizes):
    rng = random.Random(3)
    texts = [None, "", "one\ntwo", "a\n\n", "plain", "ü😀\n", "x" * 40_000 + "\n"]
    rows = [(i * 7 + len(s or "?"), s, rng.choice(["en", None]), rng.choice([3, None]), rng.choice(texts)) for s, n in sizes.items() for i in range(n)]
    rows += [(None, "a", None, None, None), (None, "a", "en", 1, "q\nr"), *rows[:1], *rows[:1]]
    rng.shuffle(rows)
    docs = spark.createDataFrame([(i, t, lang, s, n, "own", 3, "mine") for i, s, lang, n, t in rows], DOCS).repartition(3)
    for height in (1, 2, merkle.HEIGHT):
        got = merkle.proven(*merkle.manifest(docs, height), height).collect()
        found = [(r["doc_id"], r["leaf"], r["subroot"], r["root"], h(r["proof"]), r["folded_root"], r["folded_root"] == r["root"]) for r in got]
        assert sorted(found, key=repr) == sorted(by_hand(rows), key=repr)
        if height == merkle.HEIGHT and len(sizes) == 1:
            break


def test_manifest_of_empty_tables_and_null_rows(spark):
    assert merkle.proven(*merkle.manifest(spark.createDataFrame([], DOCS))).count() == 0
    one = merkle.proven(*merkle.manifest(spark.createDataFrame([(None,) * 8], DOCS))).first()
    assert one["leaf"] == one["subroot"] == one["root"] == one["folded_root"] == h("-" * 5) and one["proof"] == ""


def test_butterfly_gives_every_block_the_same_root(spark):
    """Blocks of one owner, 1 to 31 of them, end with the root of a plain tree and with their own siblings."""
    rows = [(f"o{n}", b, n, h(str(n), str(b))) for n in (1, 2, 3, 4, 9, 10, 19, 28, 31) for b in range(n)]
    got = merkle.butterfly(spark.createDataFrame(rows, "owner string, block long, blocks long, digest string")).collect()
    assert len(got) == len(rows)
    for r in got:
        n = int(r["owner"][1:])
        steps, root = walk([h(str(n), str(b)) for b in range(n)], r["block"])
        assert r["root"] == root and [(s["before"], s["after"]) for s in r["path"]] == steps


# --- whitening --------------------------------------------------------------------------------------------------------


def scatter_of(x):
    n, s = len(x), [sum(c) for c in zip(*x, strict=True)]
    d = [[n * v - t for v, t in zip(r, s, strict=True)] for r in x]
    return d, [[sum(r[i] * r[j] for r in d) // n for j in range(len(s))] for i in range(len(s))]


def polynomial_of(m):
    """Faddeev and LeVerrier, in fractions."""
    d, c, k = len(m), [1], [[Fraction(0)] * len(m) for _ in m]
    for step in range(1, d + 1):
        k = [[sum(m[i][t] * k[t][j] for t in range(d)) + (c[-1] if i == j else 0) for j in range(d)] for i in range(d)]
        c.append(-sum(m[i][t] * k[t][i] for i in range(d) for t in range(d)) / step)
    return [int(v) for v in c]


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, 1, 0.5, [1]) for i, v in rows], "vec_id long, embedding array<float>, dim int, w double, x array<int>")


def test_characteristic_polynomial_is_exact(spark):
    rng = random.Random(8)
    for d, zero in ((1, False), (2, False), (7, False), (7, True)):
        x = [[rng.randrange(-(10**6), 10**6) if not (zero and j % 2) else 5 for j in range(d)] for _ in range(12)]
        _, m = scatter_of(x)
        assert whitening.characteristic(spark, m) == polynomial_of(m)
    assert whitening.characteristic(spark, [[2, 0, 0], [0, 2, 0], [0, 0, 5]]) == [1, -9, 24, -20]


def test_roots_count_multiples_and_close_ones():
    def poly(roots):
        c = [1]
        for r in roots:
            c = [a - r * b for a, b in zip([*c, 0], [0, *c], strict=True)]
        return c

    for roots, k in (([5, 5, 5, 2], 8), ([10**30, 10**30 - 1, 3, 3, 1], 8), ([0, 0, 7], 8), ([0, 0], 8), ([9, 8, 7, 6], 2)):
        found = [Fraction(r.at, 1 << r.scale) for r in whitening.largest_roots(poly(roots), k) for _ in range(r.count)]
        due = sorted((r for r in roots if r), reverse=True)[: max(k, len(found))]
        assert len(found) == min(k, len(due)) and all(abs(f - r) <= Fraction(r, 1 << 120) for f, r in zip(found, due, strict=False))


def test_whitening_against_numpy(spark):
    rng = np.random.default_rng(4)
    a = (rng.normal(size=(300, 10)) * np.geomspace(3, 0.01, 10)) @ np.linalg.qr(rng.normal(size=(10, 10)))[0]
    a = a.astype(np.float32)
    rows = [(i, v.tolist()) for i, v in enumerate(a)] + [(900, None), (901, [1.0, None] + [0.0] * 8), (902, [float("nan")] * 10), (903, [float("inf")] + [0.0] * 9), (904, []), (None, a[0].tolist()), (3, a[3].tolist())]
    got = whitening.whiten(vectors(spark, rows)).collect()
    x = [[math.floor(1024 * float(c)) + 100_000 for c in v] for i, v in rows if v and len(v) == 10 and all(c is not None and math.isfinite(c) for c in v)]
    ids = [i for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    assert len(got) == 8 * len(x) and {r["n"] for r in got} == {len(x)} and {r["component"] for r in got} == set(range(1, 9))
    d, _ = scatter_of(x)
    assert sorted({(repr(r["vec_id"]), r["deviation"]) for r in got}) == sorted({(repr(i), sum(v * v for v in r)) for i, r in zip(ids, d, strict=True)})
    centred = np.array([[v / len(x) for v in r] for r in d])
    e, u = np.linalg.eigh(centred.T @ centred / len(x))
    order = np.argsort(-e)[:8]
    for c, k in enumerate(order, 1):
        own = {r["vec_id"]: r for r in got if r["component"] == c}
        due = {i: w for i, w in zip(ids, centred @ u[:, k] / math.sqrt(e[k]), strict=True)}
        sign = math.copysign(1, own[7]["whitened"] * due[7])
        assert all(abs(own[i]["whitened"] - sign * w) < 1e-9 for i, w in due.items())
        assert abs(own[7]["explained"] - e[k] / e.sum()) < 1e-12
    assert max(r["identity_error"] for r in got) < 1e-9 and len({r["identity_error"] for r in got}) == 1


def test_whitening_of_equal_roots_few_rows_and_large_entries(spark):
    plus = [(i, [float(s * (j == i // 2)) for j in range(4)]) for i in range(8) for s in [1 if i % 2 else -1]]
    got = whitening.whiten(vectors(spark, plus)).collect()  # the covariance is a multiple of the identity
    assert len(got) == 32 and all(abs(r["explained"] - 0.25) < 1e-15 and r["identity_error"] < 1e-12 for r in got)
    total = defaultdict(float)
    for r in got:
        total[r["vec_id"]] += r["whitened"] ** 2
    assert all(abs(t - 4) < 1e-9 for t in total.values())
    assert whitening.whiten(vectors(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0
    assert whitening.whiten(vectors(spark, [])).count() == 0
    mixed = [(1, [0.0, 0.0, 0.0]), (2, [3.0, 0.0, 0.0]), (3, [1.0]), (4, [2.0]), (5, [1e30, 0.0, -1e30])]
    got = whitening.whiten(vectors(spark, mixed)).collect()
    assert {(r["vec_id"], r["component"]) for r in got} == {(1, 1), (1, 2), (2, 1), (2, 2), (5, 1), (5, 2), (3, 1), (4, 1)}
    assert {r["n"] for r in got if r["vec_id"] in (3, 4)} == {2} and all(r["identity_error"] < 1e-9 for r in got if r["vec_id"] in (3, 4))
    assert {r["deviation"] for r in got if r["vec_id"] == 5} == {(1 << 63) - 1}


def test_scatter_is_exact_for_wide_entries(spark):
    rng = random.Random(2)
    x = [[rng.randrange(-(1 << 62), 1 << 62) for _ in range(3)] for _ in range(40)]
    rows = spark.createDataFrame([(i, 3, v) for i, v in enumerate(x)], "vec_id long, dim int, x array<long>").repartition(3)
    n, total = whitening.sums(rows)[3]
    assert n == 40 and total == [sum(c) for c in zip(*x, strict=True)]
    means = [t // n for t in total]
    c = [[v - m for v, m in zip(r, means, strict=True)] for r in x]
    assert whitening.scatters(rows, {3: means})[3] == [[sum(r[i] * r[j] for r in c) for j in range(3)] for i in range(3)]


# --- URL templates ----------------------------------------------------------------------------------------------------

URLS = [
    None, "", "no scheme", "mailto:a@b", "http://", "://x.net", "http://X.NET/", "https://a.b.Net?x#y", "http://net/a", "http://evilnet/", "http://en.example.net/en/1", "http://example.net/en/", "http://example.net/en",
    "http://badexample.net/en/3", "http://example.com/de/4", "http://www.example.com/de", "http://www.example.com/DE/4", "http://a.org/fr/5?x=/de/", "http://a.org/fr#/fr/", "http://a.org:80/fr/5", "http://a.com/x://y.net/z", "HTTP://É.ORG/fr/é//",
    "http://a.com#/p", "http://a.com/p/../q;r?//", "http://a.com///", "http://a..org/fr/", "http://" + "s/" * 5000,
]


def parse(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    low = re.sub("[A-Z]", lambda m: chr(ord(m[0]) + 32), host)
    return low, re.match(r"[^?#]*", rest[len(host) :])[0]


def rule_of(host, path, rules):
    fit = [(len(h), len(p), v == "block", h + p, v) for h, p, v in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
    return max(fit)[3:] if fit else (None, None)


def test_rules_against_brute_force(spark):
    rules = [*url_templates.RULES, ("example.net", "/en/1", "block"), ("com", "/p", "block"), ("com", "/p", "allow"), ("a.com", "", "allow"), ("org", "/fr/5", "block")]
    pages = spark.createDataFrame([(i % 20, u, "p", "h", "v", 1) for i, u in enumerate(URLS)], "page_id long, url string, path string, host string, verdict string, n int")
    for own in (list(url_templates.RULES), rules):
        got = url_templates.judged(pages, url_templates.rules_of(spark, tuple(own))).collect()
        due = sorted(((i % 20, *parse(u), *rule_of(*parse(u), own)) for i, u in enumerate(URLS)), key=repr)
        assert sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"] if r["rule"] else None) for r in got), key=repr) == due
        assert {r["verdict"] for r in got} <= {"allow", "block"}
    assert url_templates.judged(pages.limit(0), url_templates.rules_of(spark)).count() == 0
    assert {r["verdict"] for r in url_templates.judged(pages, url_templates.rules_of(spark).limit(0)).collect()} == {"allow"}


def planted(spark):
    """One host: articles are fine, offers are blocked by rules but for some that no rule names; many rare words."""
    urls = [f"http://shop.test/de/news/{i}" for i in range(60)] + [f"http://shop.test/en/news/{i}.html" for i in range(60)]
    urls += [f"http://shop.test/{lang}/offers/{'q' if i % 4 else ''}{i}" for i in range(40) for lang in ("de", "en")]
    urls += [f"http://shop.test/tags/{w}" for w in ("".join(random.Random(i).choices("abcdef", k=6)) for i in range(80))]
    rules = [("shop.test", f"/{lang}/offers/q{i}", "block") for i in range(40) for lang in ("de", "en")] + [("shop.test", "/de/news/1", "allow")]
    return spark.createDataFrame(list(enumerate(urls)), "page_id long, url string"), rules, urls


def test_templates_merge_generalise_and_reject(spark):
    pages, rules, urls = planted(spark)
    got = {urls[r["page_id"]]: r for r in url_templates.judged(pages, url_templates.rules_of(spark, tuple(rules))).collect()}
    assert len(got) == len(set(urls))
    template = {u: r["template"] for u, r in got.items()}
    assert {t for u, t in template.items() if "/tags/" in u} == {"/tags/<word>"}
    # Offers are one template of each branch, most of which is blocked, so that the others are, too.
    open_offers = [r for u, r in got.items() if "/offers/" in u and not r["rule"]]
    assert open_offers and len({r["template"] for r in got.values() if "/offers/" in r["path"]}) <= 4
    assert all(r["verdict"] == "allow" for u, r in got.items() if "/news/" in u or "/tags/" in u)
    mixes = {r["template"]: r for r in got.values() if r["template"].endswith("<mix>")}
    assert mixes and all(r["purity"] >= url_templates.REJECT for r in mixes.values())


def test_similar_branches_merge_and_others_stay(spark):
    rows = []
    for branch, kind, n in (("de", "num:none", 100), ("en", "num:none", 90), ("fr", "num:none", 110), ("fr", "end:none", 3), ("de", "end:none", 2), ("xx", "num:none", 60), ("xx", "word:block", 55), ("9", "num:none", 5), ("", "end:none", 1)):
        rows.append(("h", "", branch, kind, n))
    got = {r["segment"]: r["name"] for r in url_templates.merged(spark.createDataFrame(rows, "host string, prefix string, segment string, cell string, n long")).collect()}
    assert got == {"de": "<like num:none*4>", "en": "<like num:none*4>", "fr": "<like num:none*4>", "xx": "xx", "9": "<num>", "": ""}
    assert url_templates.merged(spark.createDataFrame([("h", "", "only", "end:none", 9)], "host string, prefix string, segment string, cell string, n long")).first()["name"] == "only"


def test_purity_by_hand(spark):
    rows = [("h", "/a", "block", 8), ("h", "/a", "allow", 1), ("h", "/b", None, 11), ("i", "/a", None, 3)]
    got = {(r["host"], r["template"]): (r["labelled"], r["purity"]) for r in url_templates.purities(spark.createDataFrame(rows, "host string, template string, verdict string, n long")).collect()}
    prior = (8 + 0.5 * (11 + 4)) / 24
    assert got == {("h", "/a"): (9, pytest.approx((8 + 4 * prior) / 13)), ("h", "/b"): (0, pytest.approx(prior)), ("i", "/a"): (0, pytest.approx(0.5))}
    assert sum(v[1] >= url_templates.REJECT for v in got.values()) == 1


def test_native_path_has_no_python_workers(spark, tmp_path):
    pages, rules, _ = planted(spark)
    plan = url_templates.templates(url_templates.parsed(pages).groupBy("host", "path").agg({"page_id": "count"}).withColumnRenamed("count(page_id)", "n").selectExpr("host", "path", "cast(null as string) verdict", "n"))
    text = plan._jdf.queryExecution().toString()
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text
