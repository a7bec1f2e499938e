"""The ten operators against brute force, round trips and edge cases: nulls, empty and long texts, ties, repeated rows,
empty tables, extra columns with clashing names."""

import gzip
import hashlib
import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from jobmarket.llm import bsi_topk, bwt_dedup, cdc_dedup, cgk_decontam, common, mixing, ngram_join, pii, pseudo_likelihood, toxicity, warc

DOCS = "doc_id long, text string, lang string, source string, n_chars long, score double, node long, size long"


def docs_of(spark, texts, sources=None):
    """Documents with extra columns whose names the operators use themselves."""
    rows = [(i, t, "en", (sources or {}).get(i, "s"), len(t or ""), 9.0, 7, 3) for i, t in texts]
    return spark.createDataFrame(rows, DOCS)


def prose(rng, n, size=3000):
    return " ".join(f"w{rng.randrange(size)}" for _ in range(n))


def edge_texts(rng):
    long = prose(rng, 20_000)
    return [(1, None), (2, ""), (3, "  \n"), (4, "a"), (5, "x" * 50_000), (6, long), (7, long), (7, long), (8, prose(rng, 300)), (9, prose(rng, 300)), (None, prose(rng, 50))]


# --- 1 WARC -----------------------------------------------------------------------------------------------------------


def test_warc_round_trip_and_links(spark, tmp_path):
    html = "<html><head><title>A &amp; B</title></head><body><script>x</script><p>Hi&nbsp;<b>you</b></p><a href='u1'>z</a></body></html>"
    pages = spark.createDataFrame([(1, "http://a", html, "x"), (2, None, None, "x"), (2, None, None, "x"), (3, "http://é", "<p>é€😀</p>", "x")], "page_id long, url string, html string, record string")
    resp = warc.responses(pages)
    d = warc.derive(resp, "page_id").cache()
    assert d.count() == 8 and warc.derive(warc.responses(pages.limit(0))).count() == 0
    row = {r["record_type"]: r for r in d.filter("page_id = 1").collect()}
    assert row["conversion"]["block"] == "Hi you\nz"
    assert "title: A &amp; B" in row["metadata"]["block"] and "outlink: u1" in row["metadata"]["block"]
    assert row["conversion"]["refers_to"] == resp.filter("page_id = 1").first()["record_id"]
    assert row["conversion"]["source_payload_digest"] == "sha256:" + hashlib.sha256(html.encode()).hexdigest()
    warc.write_warc(d, str(tmp_path / "w"))
    back = warc.read_warc(spark, str(tmp_path / "w"))
    got = sorted((r["headers"]["WARC-Record-ID"], r["block"]) for r in back.collect())
    assert got == sorted((r["record_id"], r["block"]) for r in d.collect())
    assert all("Content-Type: text/html" in r["headers"]["WARC-Source-Header"] for r in back.collect())


def test_warc_reads_response_records_of_files(spark, tmp_path):
    body = "<html><head><title>T</title></head><body><p>Olá <b>you</b></p>\r\n\r\n<a href='u'>z</a></body></html>".encode() + b"\xff"
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html\r\nX-A: 1\r\n\r\n" + body

    def record(kind, block, *more):
        head = ["WARC/1.0", f"WARC-Type: {kind}", f"WARC-Record-ID: <urn:{kind}>", "WARC-Target-URI: http://a", "WARC-Date: 2024-01-02T03:04:05Z", *more, f"Content-Length: {len(block)}"]
        return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    parts = [record("warcinfo", b"software: x\r\n"), record("response", http), record("response", http, "WARC-Payload-Digest: sha1:ABC"), record("response", b"HTTP/1.1 204 No Content")]
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    for name in ("a.warc", "b.warc.gz"):
        resp = warc.responses_of(warc.read_warc(spark, str(tmp_path / name)))
        rows = sorted(resp.collect(), key=lambda r: r["payload_digest"])
        assert [r["payload_digest"] for r in rows] == sorted(["sha1:ABC", "sha256:" + hashlib.sha256(body).hexdigest(), "sha256:" + hashlib.sha256(b"").hexdigest()])
        d = [r for r in warc.derive(resp).collect() if r["source_payload_digest"] == "sha1:ABC"]
        assert {r["record_type"] for r in d} == {"metadata", "conversion"} and {r["refers_to"] for r in d} == {"<urn:response>"}
        assert all(r["source_headers"] == ["Content-Type: text/html", "X-A: 1"] and r["warc_date"] == "2024-01-02T03:04:05Z" for r in d)
        assert next(r["block"] for r in d if r["record_type"] == "conversion").startswith("Olá you\nz")


def test_warc_charsets_and_broken_records(spark, tmp_path):
    def record(http, body, length=None, kind="response"):
        block = http + b"\r\n\r\n" + body
        size = len(block) if length is None else length
        return f"WARC/1.0\r\nWARC-Type: {kind}\r\nWARC-Record-ID: <urn:{hashlib.md5(body).hexdigest()}>\r\nContent-Length: {size}".encode() + b"\r\n\r\n" + block + b"\r\n\r\n"

    ok = b"HTTP/1.1 200 OK\r\nContent-Type: text/html"
    bodies = {
        "header": (ok + b"; charset=ISO-8859-1", "<p>café</p>".encode("latin-1")), "page": (ok, '<meta charset="windows-1252"><p>“naïve”</p>'.encode("cp1252")), "none": (ok, "<p>größer</p>".encode()), "unknown": (ok + b"; charset=klingon", "<p>où</p>".encode()),
        "odd": (ok + b"; charset=hex", b"<p>plain</p>"), "japanese": (ok + b'; charset="Shift_JIS"', "<p>日本</p>".encode("shift_jis")),
    }
    parts = [record(*v) for v in bodies.values()]
    parts.insert(1, record(ok, b"<p>broken</p>", "x"))
    parts.insert(3, record(ok, b"<p>negative</p>", "-5"))
    (tmp_path / "a.warc").write_bytes(b"".join(parts))
    (tmp_path / "b.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts))
    (tmp_path / "c.warc.gz").write_bytes(gzip.compress(b"".join(parts)))
    (tmp_path / "d.warc.gz").write_bytes(b"".join(gzip.compress(p) for p in parts)[:-40])
    due = {"café", "“naïve”", "größer", "où", "plain", "日本", "broken", "negative"}
    for name in ("a.warc", "b.warc.gz", "c.warc.gz"):
        rows = warc.responses_of(warc.read_warc(spark, str(tmp_path / name)))
        assert {r["block"] for r in warc.derive(rows).filter("record_type = 'conversion'").collect()} == due, name
        assert {r["payload_digest"] for r in rows.collect()} >= {"sha256:" + hashlib.sha256(b).hexdigest() for _, b in bodies.values()}
    cut = warc.responses_of(warc.read_warc(spark, str(tmp_path / "d.warc.gz")))
    assert {r["block"] for r in warc.derive(cut).filter("record_type = 'conversion'").collect()} >= due - {"日本"}


def test_warc_visible_text_of_long_and_odd_pages(spark):
    def plain(html):
        t = re.sub(warc.HIDDEN, " ", html)
        t = re.sub(warc.TAG, "", re.sub(warc.BREAKING, "\n", t))
        for entity, char in warc.ENTITIES:
            t = t.replace(entity, char)
        return re.sub(r"^[ \n]+|[ \n]+$", "", re.sub(r" ?\n[ \n]*", "\n", re.sub(r"[ \t\r\f]+", " ", t)))

    rng = random.Random(2)
    odd = ["<head>", "</head >", "<script>", "</script>", "<!-- ", "-->", "<p>", "<b>", "</div>", "&amp;lt;", " ", "  ", "\t", "\n", "x", "é", "<", ">"]
    pages = [(i, "".join(rng.choice(odd) for _ in range(60))) for i in range(200)]
    pages += [(900, "<script>" + "< a " * 2_000), (901, "<p>a \t b</p>" * 20_000), (902, "<" * 2_000), (903, "")]
    got = {r[0]: r[1] for r in spark.createDataFrame(pages, "i int, html string").select("i", warc.visible_text(F.col("html"))).collect()}
    assert all(got[i] == plain(h) for i, h in pages)
    long = spark.createDataFrame([(1, "<p>x</p>" + "< a " * 500_000)], "i int, html string").select(warc.visible_text(F.col("html"))).first()[0]
    assert long == "x\n" + ("< a " * 500_000).strip()


# --- 2 personal data --------------------------------------------------------------------------------------------------

PLAIN = {"email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", "card": r"[0-9]([\x20-]?[0-9])+", "phone": r"\+[0-9][\x20().0-9-]+[0-9]"}


def luhn(d):
    return sum(int(c) if i % 2 == 0 else (2 * int(c) - 9 * (int(c) > 4)) for i, c in enumerate(reversed(d))) % 10 == 0


def base_spans(text):
    out = []
    for k, (kind, p) in enumerate(PLAIN.items()):
        for m in re.finditer(p, text or ""):
            d = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(x) > 255 for x in m.group().split(".")) or kind == "card" and not (12 <= len(d) <= 19 and luhn(d)) or kind == "phone" and not 9 <= len(d) <= 15:
                continue
            out.append((m.start(), k, m.end()))
    return sorted(out)


def test_pii_base_spans_and_edges(spark):
    rng = random.Random(3)
    alphabet = "abc@.-+_% 0123456789()é😀\n"
    texts = [(i, "".join(rng.choice(alphabet) for _ in range(rng.randrange(200)))) for i in range(300)]
    texts += [(900, "é mail a.b@c.de_d@e.fg x 1.2.3.4.5.6.7.8 300.1.1.1 +1 (443) 555-5793; 4539 1488 0343 6467"), (901, "9" * 20_000), (902, "a" * 20_000 + "@"), (903, None), (904, "")]
    docs = docs_of(spark, texts)
    model = pii.fit(docs)
    got = {r["doc_id"]: r for r in pii.detect(docs, model).collect()}
    for i, t in texts:
        assert [(x["s"], x["kind"], x["e"]) for x in got[i]["_base"]] == base_spans(t), t
        assert set(map(tuple, got[i]["_base"])) <= set(map(tuple, got[i]["_all"]))
    clean = {r["doc_id"]: r["text"] for r in pii.redact(docs, model).collect()}
    assert clean[900].startswith("é mail [EMAIL]") and "[PHONE]" in clean[900] and "[CARD]" in clean[900] and clean[903] is None
    assert pii.detect(docs.limit(0), pii.fit(docs.limit(0))).count() == 0


def test_pii_finds_a_card_beside_another_number(spark):
    rng = random.Random(8)
    cards = []
    while len(cards) < 200:
        d = "4" + "".join(str(rng.randrange(10)) for _ in range(15))
        cards.append(d)
    texts = [(i, f"pay with {c} now") for i, c in enumerate(cards)]
    good = next(c for c in cards if luhn(c))
    bad = next(c for c in cards if not luhn(c))
    joined = next(f"{bad[:-1]}{k} {good}" for k in range(10) if not luhn(bad[:-1] + str(k)))
    docs = docs_of(spark, texts + [(1000, f"pay with {joined} now")])
    r = pii.detect(docs, pii.fit(docs)).filter("doc_id = 1000").first()
    assert r["_base"] == [] and [(x["s"], x["e"]) for x in r["_all"]] == [(26, 42)]


def test_pii_adds_spans_of_each_kind_by_context(spark):
    rng = random.Random(21)
    card = next(c for c in ("4" + "".join(str(rng.randrange(10)) for _ in range(15)) for _ in range(999)) if luhn(c))
    texts = [(i, f"mail to ann{i}@mail{i}.org or call +1 415 555 {1000 + i} now, host 10.0.{i}.7 up, card {card} ok") for i in range(120)]
    texts += [(200 + i, f"order {rng.randrange(10**15, 10**16)} shipped at {i}.{i}.{999}.1 version {i}@v{i}.{i}") for i in range(120)]
    texts += [(700 + i, f"mail to eve{i} (at) site{i} (dot) com or phone 212-555-{1000 + i}, host fe80:{i}:0:0:1:2:3:4 up") for i in range(40)]
    added = {
        500: ("email", "mail to ann (at) mail (dot) org now"), 501: ("phone", "please call 415-555-2671 now"), 502: ("ip", "host fe80:0:0:0:1:2:3:4 up"),
        503: ("card", f"card 9999 {card} ok"),
    }
    # Card 9999 makes one base run of both numbers, which fails its check; the bare run inside is another candidate.
    docs = docs_of(spark, texts + [(i, t) for i, (_, t) in added.items()] + [(600, "version bob (at) 12 (dot) 34 then")])
    docs = docs.withColumns({c: F.lit("own") for c in ("row", "base", "all", "cands", "_all", "p0", "m0")})
    model = pii.fit(docs)
    got = {r["row"]["doc_id"]: r for r in pii.detect_rows(docs, model).collect()}
    for i, (kind, t) in added.items():
        assert [pii.KINDS[x["kind"]] for x in got[i]["all"]] == [kind] and got[i]["base"] == [], (i, t)
    assert got[600]["all"] == [] and all(not got[200 + i]["all"] or got[200 + i]["base"] for i in range(120))
    clean = {r["doc_id"]: r for r in pii.redact(docs, model).collect()}
    assert clean[500]["text"] == "mail to [EMAIL] now" and clean[503]["text"] == "card 9999 [CARD] ok"
    assert all(clean[500][c] == "own" for c in ("row", "base", "all", "cands", "_all", "p0", "m0")) and clean[500]["score"] == 9.0


# --- 3 repeated substrings --------------------------------------------------------------------------------------------


def brute_repeats(texts, span=400):
    seen = Counter(t[i : i + span] for t in texts for i in range(len(t) - span + 1))
    out = []
    for t in texts:
        edge = np.zeros(len(t) + 1, int)
        for i in range(len(t) - span + 1):
            if seen[t[i : i + span]] > 1:
                edge[i] += 1
                edge[i + span] -= 1
        gone = np.cumsum(edge)[:-1] > 0
        kept = bytes(np.frombuffer(t, np.uint8)[~gone])
        out.append((len(t), int(gone.sum()), int((np.diff(np.concatenate([[0], gone.astype(int)])) == 1).sum()), hashlib.sha256(kept).hexdigest()))
    return out


@pytest.mark.parametrize("hot", [1 << 15, 3])
def test_bwt_dedup_against_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(bwt_dedup, "HOT", hot)
    monkeypatch.setattr(bwt_dedup, "SHARD", 4_000)
    rng = random.Random(4)
    passage, copy = prose(rng, 110), prose(rng, 200)
    texts = [None, "", "short", "é" * 500, "abcde" * 300, copy, copy, copy[:300] + "!" + copy[300:]]
    texts += [prose(rng, rng.randrange(20, 120)) + " " + passage[rng.randrange(60) :] + " " + prose(rng, 60) for _ in range(8)]
    docs = docs_of(spark, list(enumerate(texts)))
    want = brute_repeats([(t or "").encode() for t in texts])
    got = {r["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) for r in bwt_dedup.dedup(docs).collect()}
    assert [got[i] for i in range(len(texts))] == want
    assert bwt_dedup.dedup(docs.limit(0)).count() == 0


def test_bwt_dedup_repeated_rows(spark):
    rng = random.Random(6)
    t = prose(rng, 150)
    docs = docs_of(spark, [(1, t), (1, t), (2, prose(rng, 150)), (None, prose(rng, 150))])
    got = sorted((r["doc_id"] or 0, r["n_removed"]) for r in bwt_dedup.dedup(docs).collect())
    assert got == [(0, 0), (1, len(t)), (1, len(t)), (2, 0)]


# --- 4 toxicity -------------------------------------------------------------------------------------------------------


def toxic_corpus(spark, n=400):
    rng = random.Random(9)
    bad = ["blorp", "snark", "vilefolk"]
    texts, labels = [], []
    for i in range(n):
        toxic = rng.random() < 0.3
        w = prose(rng, rng.randrange(20, 80)).split()
        if toxic:
            for _ in range(rng.randrange(1, 4)):
                w.insert(rng.randrange(len(w)), rng.choice(bad))
        texts.append((i, " ".join(w)))
        labels.append((i, 1, int(toxic)))
    return docs_of(spark, texts), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")


def test_toxicity_held_out_accuracy(spark):
    docs, labels = toxic_corpus(spark)
    model = toxicity.fit(docs, labels)
    out = toxicity.scored(docs, model).join(labels, "doc_id").withColumn("held", toxicity.held_out(F.col("doc_id"))).toPandas()
    held = out[out.held]
    assert (held.predicted == held.toxic).mean() > 0.95 and out.score.between(0, 1).all()


def test_label_model_finds_latent_labels_and_discounts_copies():
    rng = np.random.default_rng(5)
    y = (rng.random(3000) < 0.2).astype(float)
    hit, false = np.array([0.5, 0.4, 0.6, 0.3, 0.5]), np.array([0.02, 0.05, 0.03, 0.01, 0.08])
    votes = (rng.random((3000, 5)) < np.where(y[:, None] == 1, hit, false)).astype(float)
    noise = (rng.random((3000, 1)) < 0.15).astype(float)
    # A voter without knowledge that stands there ten times.
    votes = np.concatenate([votes, np.repeat(noise, 10, axis=1)], axis=1)
    observed = np.arange(3000) % 10 == 0
    wrong = np.where(observed, y, 1 - y)  # labels that are not observed must not matter
    q = toxicity.label_model(votes, wrong, observed, 0.2)
    assert (q == toxicity.label_model(votes, y, observed, 0.2)).all()
    assert ((q >= 0.5) == y)[~observed].mean() > max(1 - y.mean(), 0.85) and q[y == 1].mean() > 4 * q[y == 0].mean()
    # Votes of the ten copies move a row that has no other vote little.
    alone = q[(votes[:, :5].sum(axis=1) == 0) & (noise[:, 0] == 1)]
    assert alone.max() < 0.5


def test_toxicity_voters_against_plain_counting(spark):
    texts = ["You IDIOT!! STOP DOING THAT NOW you no no no", "", None, "idiots étranger idiota!", "x" * 100_000 + " SHUT DOWN THIS HERE THING moron moron", "a!!b! c!!! SHOUTING WORDS only"] + ["no", "no no"]
    voters = toxicity.Voters([int(toxicity.Reader().of("étranger").view(np.int64))])
    got = {}
    for span, row, voter, times, _ in voters.described(pa.array(texts, pa.string())):
        for r, v, t in zip(row.tolist(), voter.tolist(), times.tolist(), strict=True):
            got[span.start + r, v] = t
    base = len(voters.terms)
    names = {int(voters.reader.of(w)): w for w in (*toxicity.SEEDS, "étranger")}
    want = {}
    for i, t in enumerate(texts):
        words = re.findall(r"[A-Za-z\x80-\U0010ffff]+", t or "")
        for j, h in enumerate(voters.terms.tolist()):
            if n := sum(w.lower() == names[h] for w in words):
                want[i, j] = n
        low = [w.lower() for w in words]
        loud = [len(w.encode()) >= 4 and w.isascii() and w.isupper() for w in words]
        runs = len(re.findall("1{4,}", "".join("1" if x else "0" for x in loud)))
        counts = {"address": sum(w in toxicity.ADDRESS for w in low), "exclaiming": len(re.findall("!!+", t or "")), "repeating": sum(low[k] == low[k + 1] == low[k + 2] for k in range(len(low) - 2)), "shouting": runs}
        want |= {(i, base + toxicity.PATTERNS.index(k)): n for k, n in counts.items() if n}
    assert got == want


def test_toxicity_edges(spark):
    docs, labels = toxic_corpus(spark, 60)
    model = toxicity.fit(docs, labels.limit(0))
    out = toxicity.scored(docs_of(spark, [(1, None), (2, ""), (None, "you idiot"), (4, "x" * 100_000)]), model).collect()
    assert len(out) == 4 and out[0]["score"] == out[1]["score"] and out[2]["score"] > 0.5 and out[0]["lang"] == "en"
    assert toxicity.scored(docs.limit(0), model).count() == 0
    noisy = labels.unionByName(spark.createDataFrame([(1, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"))
    toxicity.fit(docs, noisy)


# --- 5 exact top-k ----------------------------------------------------------------------------------------------------


def test_topk_against_brute_force(spark):
    rng = np.random.default_rng(1)
    m = rng.normal(size=(300, 7)).round(3)
    m[50:90] = m[10]
    rows = [(i, v.tolist(), "x") for i, v in enumerate(m)] + [(1000, None, "x"), (1001, [1.0, None] + [0.0] * 5, "x"), (1002, [float("nan")] * 7, "x"), (1003, [float("inf")] * 7, "x"), (1004, [0.0] * 7, "x"), (1100, [1.0, 2.0], "x"), (1101, [2.0, 2.0], "x")]
    v = bsi_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>, rank string"))
    got = bsi_topk.top_k(bsi_topk.build_index(v, 64), v.filter("vec_id % 100 = 0"), 10)
    sound = {i: np.floor(1024 * np.array(x)).astype(int) for i, x, _ in rows if x and None not in x and np.isfinite(np.array(x, float)).all()}
    for q in [i for i in sound if i % 100 == 0]:
        best = sorted(((-int(sound[q] @ x), i) for i, x in sound.items() if i != q and len(x) == len(sound[q])))[:10]
        mine = [(r["rank"], r["vec_id"], r["score"]) for r in got.filter(F.col("query_id") == q).orderBy("rank").collect()]
        assert mine == [(k + 1, i, -s) for k, (s, i) in enumerate(best)], q
    assert bsi_topk.top_k(bsi_topk.build_index(v.limit(0)), v.limit(0)).count() == 0


def test_topk_with_values_of_any_size(spark):
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.normal(size=4) * 10.0 ** rng.integers(0, 17)]) for i in range(120)]
    rows += [(200, [1e300, -1e300, 1.0, 0.0]), (201, [1e15, 2e15, -3e15, 1e-3]), (202, [32768.0, 0.0, 0.0, 0.0])]
    v = bsi_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    whole = {i: [min(max(math.floor(1024 * y) if abs(1024 * y) < 1e30 else (2**63 if y > 0 else -(2**63)), -(2**63)), 2**63 - 1) for y in x] for i, x in rows}
    got = bsi_topk.top_k(bsi_topk.build_index(v, 64), v.filter("vec_id % 100 = 0 or vec_id > 200"), 10).collect()
    for q in (0, 100, 200, 201, 202):
        best = sorted((-sum(a * b for a, b in zip(whole[q], x, strict=True)), i) for i, x in whole.items() if i != q)[:10]
        mine = [(r["vec_id"], r["score"]) for r in sorted(got, key=lambda r: r["rank"]) if r["query_id"] == q]
        assert mine == [(i, min(max(-s, -(2**63)), 2**63 - 1)) for s, i in best], q


def test_topk_sends_no_block_with_each_group_of_queries(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(x) for x in rng.normal(size=3 if i % 7 else 2)]) for i in range(1500)]
    v = bsi_topk.quantised(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).repartition(3)
    index = bsi_topk.build_index(v, 64)
    assert "Join" not in bsi_topk.top_k(index, v)._jdf.queryExecution().optimizedPlan().toString()
    tasks: dict[int, tuple[list, list]] = {}
    for r in bsi_topk.dealt(index, v, 16).collect():
        if r["planes"] is None:
            assert len(r["q"]) == r["dim"]
            tasks.setdefault(r["task"], ([], []))[1].append(r["vec_id"])
        else:
            tasks.setdefault(r["task"], ([], []))[0].append(bytes(r["ids"]))
    met = [(b, q) for blocks, queries in tasks.values() for b in blocks for q in queries]
    assert len(met) == len(set(met)) == index.count() * 1500
    assert max(len(blocks) for blocks, _ in tasks.values()) <= bsi_topk.SET_BLOCKS
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sum(len(blocks) for blocks, _ in tasks.values()) <= index.count() + 2 * parts * bsi_topk.SET_BLOCKS < index.count() * (1500 // 16)


def test_signed_digits():
    for x in [*range(-300, 300), 2**63 - 1, -(2**63), 0x5555555555555555]:
        digits = bsi_topk.signed_digits(x)
        assert sum(sign << place for place, sign in digits) == x and all(sign in (1, -1) for _, sign in digits)
        assert all(b - a > 1 for (a, _), (b, _) in zip(digits, digits[1:], strict=False))


# --- 6 n-gram Jaccard join --------------------------------------------------------------------------------------------


def brute_components(texts):
    sets = []
    for _, t in texts:
        w = re.findall(rb"[^\x20\x09-\x0D]+", (t or "").encode().lower())
        sets.append({tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set())
    ids = [i for i, _ in texts]
    root = {i: i for i in ids}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a in range(len(ids)):
        for b in range(a):
            k = len(sets[a] & sets[b])
            if k and 100 * k >= 75 * (len(sets[a]) + len(sets[b]) - k):
                x, y = sorted((find(ids[a]), find(ids[b])))
                root[y] = x
    return {i: (len(s), find(i)) for i, s in zip(ids, sets, strict=True)}


def test_ngram_join_against_brute_force(spark):
    rng = random.Random(2)
    texts = []
    for g in range(12):
        base = prose(rng, rng.randrange(6, 150)).split()
        for _ in range(rng.randrange(1, 12)):
            w = list(base)
            for _ in range(rng.randrange(0, 4)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(50)}"
            texts.append((len(texts), " ".join(w)))
    shared = prose(rng, 40)
    texts += [(1000 + i, prose(rng, 30) + " " + shared + " " + prose(rng, 30)) for i in range(30)]
    texts += [(2000, None), (2001, " "), (2002, "one two"), (2003, "One\tTWO"), (2004, "two one"), (2005, "ß ẞ"), (2006, "É é x y z w")]
    want = brute_components(texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs_of(spark, texts)).collect()}
    assert got == want


def test_ngram_join_verifies_members_of_groups_with_equal_prefixes(spark, monkeypatch):
    # Texts that share their rare shingles and differ in frequent ones only: equal prefixes, unequal sets.
    rng, made = random.Random(3), []
    star = ngram_join.star_pairs
    monkeypatch.setattr(ngram_join, "star_pairs", lambda post: made.append(post.select("node").distinct().count()) or star(post))
    passages = [prose(rng, 12) for _ in range(6)]
    texts = [(1000 + i, " ".join(f"filler{i}x{k}" for k in range(9)) + " s1 s2 s3 s4 " + passages[i % 6]) for i in range(120)]
    for g in range(8):
        own = prose(rng, 60 if g % 2 else 80)
        texts += [(10 * g + j, own + " s1 s2 s3 s4 " + passages[j]) for j in range(6)]
    docs = docs_of(spark, texts)
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()}
    assert got == brute_components(texts) and made[0] < len(texts)


def test_components_shrink_from_round_to_round(spark, monkeypatch):
    """A chain folds without all its nodes in each round; components known before are joined by later edges."""
    rng, rows, own = random.Random(3), [0], ngram_join.written

    def counted(df, label):
        out = own(df, label)
        rows[0] += out.count()
        return out

    monkeypatch.setattr(ngram_join, "written", counted)
    chain = rng.sample(range(10_000), 600)
    edges = lambda pairs: spark.createDataFrame(pairs, "a long, b long")
    got = {r["node"]: r["comp"] for r in ngram_join.components(edges(list(zip(chain[1:], chain)))).collect()}
    assert got == dict.fromkeys(chain, min(chain)) and rows[0] < 5 * len(chain)
    known = ngram_join.components(edges([(5, 4), (5, 6), (21, 20), (31, 30)]))
    same = lambda df: {r["node"]: r["comp"] for r in df.collect()}
    assert same(ngram_join.components(edges([(6, 21), (40, 31), (2, 40), (51, 50), (5, 6)]), known=known)) == {4: 4, 5: 4, 6: 4, 20: 4, 21: 4, 30: 2, 31: 2, 40: 2, 2: 2, 50: 50, 51: 50}
    assert same(ngram_join.components(edges([]), known=known)) == same(known)
    assert same(ngram_join.components(edges([]))) == {}


def test_components_fold_a_star_at_once(spark, monkeypatch):
    """Links to one node are gone after one round, however many and wherever its number stands among theirs."""
    made, own = [], ngram_join.written
    monkeypatch.setattr(ngram_join, "written", lambda df, label: made.append(label) or own(df, label))
    pairs = [(500 + g, 1000 * g + i) for g in (1, 2, 3) for i in range(900) if 1000 * g + i != 500 + g]
    got = {r["node"]: r["comp"] for r in ngram_join.components(spark.createDataFrame(pairs, "a long, b long")).collect()}
    assert got == {n: 500 + g for g in (1, 2, 3) for n in (500 + g, *range(1000 * g, 1000 * g + 900))}
    assert len(made) == 4


def test_ngram_join_edges(spark):
    docs = docs_of(spark, edge_texts(random.Random(1)))
    got = [(r["doc_id"], r["component_id"]) for r in ngram_join.near_duplicates(docs).collect()]
    assert sorted((x for x in got if x[0]), key=str) == sorted([(1, 1), (2, 2), (3, 3), (4, 4), (5, 5), (6, 6), (7, 6), (7, 6), (8, 8), (9, 9)], key=str) and (None, None) in got
    assert ngram_join.near_duplicates(docs.limit(0)).count() == 0


# --- 7 chunk dedup ----------------------------------------------------------------------------------------------------


def test_chunks_resist_insertions_and_dedup(spark):
    rng = random.Random(7)
    passage = prose(rng, 400)
    texts = [(1, prose(rng, 50) + passage), (2, "an insertion " + prose(rng, 70) + passage + prose(rng, 30)), (3, prose(rng, 500)), (4, None), (5, ""), (3, prose(rng, 20))]
    docs = docs_of(spark, texts)
    s = {r["doc_id"]: r for r in cdc_dedup.spans(cdc_dedup.repeated_chunks(docs)).collect()}
    assert s[2]["n_removed"] > 0.7 * len(passage) and s[1]["n_removed"] == 0 and s[1]["repeated_bytes"] == s[2]["n_removed"] and 3 not in s
    kept = {r["doc_id"]: bytes(r["kept"]) for r in cdc_dedup.dedup(docs.filter("doc_id <> 3")).collect()}
    raw = dict(texts)[2].encode()
    cut = b"".join(raw[a:b] for a, b in zip([0] + [x["e"] for x in s[2]["removed"]], [x["s"] for x in s[2]["removed"]] + [len(raw)], strict=True))
    assert kept[2] == cut and kept[4] == b""


def brute_chunks(text):
    """Chunks one byte at a time: h over the last 32 bytes, a cut where its top bits are zero."""
    gear, out, start = cdc_dedup.gear_table().tolist(), [], 0
    for e in range(1, len(text) + 1):
        h = 0
        for c in text[max(0, e - 32) : e]:
            h = (h << 1) + gear[c] & 0xFFFFFFFF
        zero = h >> 32 - cdc_dedup.CUT_BITS == 0 and e >= cdc_dedup.WINDOW and e - start >= cdc_dedup.MIN_CHUNK
        if zero or e - start == cdc_dedup.MAX_CHUNK or e == len(text):
            out.append((start, e))
            start = e
    return out


def test_chunk_dedup_against_brute_force(spark):
    rng = random.Random(17)
    passage, line = prose(rng, 90), prose(rng, 9)
    texts = [(i, prose(rng, rng.randrange(60)) + passage[rng.randrange(200) :] + prose(rng, rng.randrange(60))) for i in range(12)]
    texts += [(20 + i, prose(rng, 20) + " " + line + " " + prose(rng, 20)) for i in range(6)] + [(30, passage * 3), (31, ""), (32, None), (33, "x" * 5000)]
    # One id with several texts, of which one is a copy: the others keep every byte.
    texts += [(1, texts[5][1]), (40, passage), (40, prose(rng, 80)), (40, "short")]
    rows = [(i, (t or "").encode()) for i, t in texts]
    places = {}
    for k, (_, t) in enumerate(rows):
        for a, b in brute_chunks(t):
            places.setdefault(t[a:b], []).append((k, a))
    hashes = {r["text"]: r["t"] for r in cdc_dedup._keyed(docs_of(spark, texts)).select("text", "t").distinct().collect()}
    want = []
    for k, (i, t) in enumerate(rows):
        found, passages = [(a, b) for a, b in brute_chunks(t) if len(places[t[a:b]]) > 1], []
        for a, b in found:
            if passages and passages[-1][-1][1] == a:
                passages[-1].append((a, b))
            else:
                passages.append([(a, b)])
        kept, at, n = b"", 0, 0
        for a, b in [x for p in passages if p[-1][1] - p[0][0] >= cdc_dedup.LEAST_PASSAGE for x in p]:
            first = min((rows[j][0], hashes[texts[j][1] or ""], c) for j, c in places[t[a:b]])
            n += 1
            if first != (i, hashes[texts[k][1] or ""], a):
                kept, at = kept + t[at:a], b
        want.append((i, n, kept + t[at:] if rows[k] not in rows[:k] else b""))
    docs = docs_of(spark, texts)
    got = {(r["doc_id"], r["text"]): r["n_repeated"] or 0 for r in cdc_dedup.with_spans(docs).collect()}
    assert all(got[i, texts[k][1] or ""] == n for k, (i, n, _) in enumerate(want))
    assert sorted((r["doc_id"], bytes(r["kept"])) for r in cdc_dedup.dedup(docs).collect()) == sorted((i, x) for i, _, x in want)
    assert cdc_dedup.dedup(docs.limit(0)).count() == 0


def test_chunk_dedup_keeps_rows_and_clears_exact_repeats(spark):
    rng = random.Random(5)
    a, b = prose(rng, 400), prose(rng, 300)
    docs = docs_of(spark, [(1, a), (1, a), (2, b), (None, a), (3, b), (None, None), (None, "only here"), (4, ""), (4, "")])
    kept = Counter((r["doc_id"], bytes(r["kept"])) for r in cdc_dedup.dedup(docs).collect())
    assert kept == Counter({(1, a.encode()): 1, (1, b""): 1, (2, b.encode()): 1, (None, b""): 2, (3, b""): 1, (None, b"only here"): 1, (4, b""): 2})


def test_chunks_rebuild_the_text(spark):
    texts = [(i, t) for i, t in edge_texts(random.Random(1)) if i not in (7, None)]
    got = Counter()
    for r in cdc_dedup.chunks(docs_of(spark, texts)).collect():
        assert r["length"] <= cdc_dedup.MAX_CHUNK
        got[r["doc_id"]] += r["length"]
    assert {i: got[i] for i, _ in texts} == {i: len((t or "").encode()) for i, t in texts}
    assert cdc_dedup.chunks(docs_of(spark, texts).limit(0)).count() == 0


# --- 8 decontamination ------------------------------------------------------------------------------------------------


def edited(rng, text, k):
    t = list(text)
    for _ in range(k):
        p, o = rng.randrange(len(t)), rng.random()
        if o < 0.34:
            t[p] = rng.choice("abcdefgh")
        elif o < 0.67:
            t.insert(p, rng.choice("abcdefgh"))
        else:
            del t[p]
    return "".join(t)


def test_decontamination_recall_and_precision(spark):
    rng = random.Random(11)
    items = [(i, prose(rng, rng.randrange(20, 60))) for i in range(40)]
    texts, planted = [], set()
    for i, (k, t) in enumerate(items * 3):
        texts.append((i, prose(rng, 100) + "\n" + edited(rng, t, int(0.08 * len(t)) * (i % 3) // 2) + "  " + prose(rng, 100)))
        planted.add((i, k))
    texts += [(1000 + i, prose(rng, 200)) for i in range(30)] + [(2000, None), (2001, ""), (2002, items[0][1].upper())]
    bench = spark.createDataFrame(items + [(900, None), (901, " "), (0, items[0][1])], "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]): r for r in cgk_decontam.contaminated(docs_of(spark, texts), bench).collect()}
    assert len(planted & set(got)) >= 0.9 * len(planted)
    assert not any(1000 <= d < 2002 for d, _ in got) and got[2002, 0]["edits"] == 0
    assert cgk_decontam.contaminated(docs_of(spark, texts), bench.limit(0)).count() == 0
    blocks = cgk_decontam.contaminated(docs_of(spark, texts), bench, block_bytes=2000)
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == set(got)


def test_decontamination_recall_by_length_of_items(spark):
    rng, sizes, each = random.Random(41), (6, 10, 20, 40), 60
    items = [(1000 * n + i, " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randrange(3, 9))) for _ in range(n))) for n in sizes for i in range(each)]
    # A tenth of an item's bytes is edited, at random places: the most that counts as a copy.
    texts = [(i, prose(rng, 40) + " " + edited(rng, t, len(t) // 10) + " " + prose(rng, 40)) for i, t in items]
    held = {i: cgk_decontam.edit_search(cgk_decontam.normal(t.encode()), cgk_decontam.normal(d.encode()))[0] <= 0.1 * len(t) for (i, t), (_, d) in zip(items, texts, strict=True)}
    got = {r["doc_id"] for r in cgk_decontam.contaminated(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect() if r["doc_id"] == r["item_id"]}
    for n in sizes:
        own = [i for i, _ in items if i // 1000 == n and held[i]]
        assert len(own) > 0.9 * each and sum(i in got for i in own) >= 0.9 * len(own), n


def test_decontamination_against_brute_force(spark):
    rng = random.Random(43)
    items = [(i, prose(rng, rng.randrange(4, 30), 60)) for i in range(25)]
    texts = [(i, prose(rng, 60, 60)) for i in range(20)] + [(100 + i, prose(rng, 20, 60) + " " + edited(rng, t, rng.randrange(0, len(t) // 6)) + "\n" + prose(rng, 20, 60)) for i, t in items]
    texts += [(200, None), (201, ""), (202, "x" * 30_000 + " " + items[3][1] + " " + "y" * 30_000)]
    want = {}
    for d, t in texts:
        for i, x in items:
            k = cgk_decontam.edit_search(cgk_decontam.normal(x.encode()), cgk_decontam.normal((t or "").encode()))[0]
            if k <= 0.1 * len(x):
                want[d, i] = k
    found = cgk_decontam.contaminated(docs_of(spark, texts), spark.createDataFrame(items, "item_id long, text string")).collect()
    got = {(r["doc_id"], r["item_id"]): r["edits"] for r in found}
    assert set(got) <= set(want) and len(got) >= 0.9 * len(want) and (202, 3) in got
    assert all(got[k] == want[k] for k in got)


def test_decontamination_needs_no_whole_words(spark):
    rng = random.Random(5)
    items = [(i, " ".join("".join(rng.choice("abcdefghij") for _ in range(9)) for _ in range(12))) for i in range(20)]
    items += [(20 + i, "".join(rng.choice("abcdefghij") for _ in range(90))) for i in range(20)]
    items += [(40 + i, "".join(rng.choice("abcdefghij") for _ in range(12)) + " " + "".join(rng.choice("abcdefghij") for _ in range(12))) for i in range(20)]
    texts = []
    for i, t in items:
        # One edit in every third word or so, the last tenth of the text left as it is: within a tenth of the bytes.
        places = range(4, len(t) - 4, 20 if i < 20 else 15)
        copy = "".join("z" if j in places else c for j, c in enumerate(t))
        texts.append((i, prose(rng, 60) + " " + copy + " " + prose(rng, 60)))
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {r["doc_id"] for r in cgk_decontam.contaminated(docs_of(spark, texts), bench).collect() if r["doc_id"] == r["item_id"]}
    assert all(sum(i in got for i in range(a, a + 20)) >= 17 for a in (0, 20, 40))


def test_decontamination_holds_one_block_at_a_time(spark, monkeypatch):
    rng, steps = random.Random(8), []
    bench = spark.createDataFrame([(i, prose(rng, 30)) for i in range(20)], "item_id long, text string")
    made, kept = cgk_decontam.Items, cgk_decontam.written
    monkeypatch.setattr(cgk_decontam, "Items", lambda rows: steps.append("collected") or made(rows))
    monkeypatch.setattr(cgk_decontam, "written", lambda df, label: steps.append("written") or kept(df, label))
    cgk_decontam.contaminated(docs_of(spark, [(1, prose(rng, 50))]), bench, block_bytes=4000)
    assert len(steps) >= 4 and steps == ["collected", "written"] * (len(steps) // 2)


def test_windows_are_taken_wherever_an_item_is_within_the_edits():
    rng = random.Random(6)
    for n in (5, 12, 25, 60, 150, 400):
        t = "".join(rng.choice("abcdefghij") for _ in range(n))
        block = cgk_decontam.Items([(1, t.encode())])
        for _ in range(40):
            head, copy = prose(rng, 20), edited(rng, t, n // 10)
            found = block.windows([cgk_decontam.normal((head + " " + copy + " " + prose(rng, 20)).encode())])
            assert any(abs(start - len(head) - 1) <= n // 10 for _, start, _ in found)


def test_edit_search_against_dynamic_programming():
    rng = random.Random(0)
    for _ in range(60):
        p = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 12)))
        t = bytes(rng.choice(b"abc") for _ in range(rng.randrange(0, 25)))
        row = list(range(len(p) + 1))
        best = row[-1]
        for c in t:
            new = [0]
            for i in range(1, len(p) + 1):
                new.append(min(row[i] + 1, new[-1] + 1, row[i - 1] + (p[i - 1] != c)))
            row = new
            best = min(best, row[-1])
        assert cgk_decontam.edit_search(p, t)[0] == best


# --- 9 mixing ---------------------------------------------------------------------------------------------------------


def brute_targets(sizes):
    """sizes by source; None last."""
    order = sorted([s for s in sizes if s is not None]) + ([None] if None in sizes else [])
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(order)}
    total, fixed = 1.5 * sum(sizes.values()), {}
    while True:
        free = [s for s in order if s not in fixed]
        left, w = total - sum(fixed.values()), sum(weight[s] for s in free)
        over = [s for s in free if left * weight[s] / w > 2 * sizes[s]] if free else []
        if not over:
            return fixed | {s: left * weight[s] / w for s in free}
        fixed |= {s: 2.0 * sizes[s] for s in over}


def test_mixing_targets_and_rounding(spark):
    rng = random.Random(12)
    texts = [(i, prose(rng, int(rng.paretovariate(1.1) * 5) % 3000)) for i in range(2000)]
    sources = {i: rng.choice(["a", "b", "é", "c", "c", "c", None]) for i, _ in texts}
    texts += [(5000, None), (5001, ""), (5002, " \n")]
    docs = docs_of(spark, texts, sources)
    out = mixing.mix(docs).collect()
    again = {r["doc_id"]: r["taken"] for r in mixing.mix(docs.repartition(7)).collect()}
    sizes, taken, target = Counter(), Counter(), {}
    for r in out:
        sizes[r["source"]] += r["size"]
        taken[r["source"]] += r["taken"]
        target[r["source"]] = r["target"]
        assert 0 <= r["taken"] <= 2 * r["size"] and again[r["doc_id"]] == r["taken"]
    want = brute_targets(dict(sizes))
    for s in sizes:
        assert target[s] == pytest.approx(want[s]) and abs(taken[s] - want[s]) <= max(30, 0.01 * want[s]), s
    assert len(out) == len(texts) and mixing.mix(docs.limit(0)).count() == 0


def test_mixing_rates_solve_the_dual(spark):
    rng = random.Random(13)
    texts = [(i, prose(rng, 1 + int(rng.paretovariate(1.2) * 4) % 500)) for i in range(900)] + [(5000, None)]
    docs = docs_of(spark, texts, {i: rng.choice("abbccccc") for i, _ in texts})
    rows = mixing.mix(docs).collect()
    for source in "abc":
        own = [r for r in rows if r["source"] == source and r["size"]]
        by_bin = {}
        for r in own:
            by_bin.setdefault(math.floor(math.log2(r["size"]) * mixing.BINS), []).append(r)
        if own[0]["target"] >= 2 * own[0]["source_size"] - 1e-6:
            assert all(r["copies"] == 2 for r in own)
            continue
        scale = sum(r["size"] for r in own) / len(own)
        x = {b: sum(r["size"] for r in rs) / len(rs) / scale for b, rs in by_bin.items()}
        rate = lambda t, b: min(2.0, math.exp(t * x[b]))
        low, high = -100.0 / min(x.values()), 1.0 / min(x.values())
        for _ in range(200):
            t = (low + high) / 2
            over = sum(rate(t, b) * sum(r["size"] for r in rs) for b, rs in by_bin.items()) > own[0]["target"]
            low, high = (low, t) if over else (t, high)
        for b, rs in by_bin.items():
            assert all(r["rate"] == pytest.approx(rate(t, b), rel=1e-6) and math.floor(r["rate"]) <= r["copies"] <= math.floor(r["rate"]) + 1 for r in rs)


def test_mixture_takes_repeated_rows_as_planned_and_keeps_their_columns(spark):
    rng = random.Random(4)
    same = prose(rng, 40)
    docs = docs_of(spark, [(1, same)] * 9 + [(2, prose(rng, 30)), (3, prose(rng, 35)), (4, None)] + [(10 + i, prose(rng, 50)) for i in range(20)], {1: "a", 2: "b", 3: "b"})
    docs = docs.withColumns({"copy_no": F.lit("own"), "_key": F.lit("k"), "bin": F.lit("b"), "row": F.lit("r"), "h": F.lit("h"), "tie": F.lit("t"), "copies": F.lit("c")})
    m = mixing.mixture(docs).collect()
    assert {(r["copy_no"], r["_key"], r["bin"], r["row"], r["h"], r["tie"], r["copies"], r["score"], r["size"]) for r in m} == {("own", "k", "b", "r", "h", "t", "c", 9.0, 3)}
    plan = Counter()
    for r in mixing.mix(docs).collect():
        plan[r["doc_id"]] += r["copies"]
    assert Counter(r["doc_id"] for r in m) == +plan and {r["copy_no_"] for r in m} <= {1, 2}


def test_mixture_repeats_documents(spark):
    rng = random.Random(1)
    docs = docs_of(spark, [(i, prose(rng, 20)) for i in range(50)] + [(7, "same id other text"), (None, "no id at all here")], {i: "ab"[i % 2] for i in range(50)})
    m = mixing.mixture(docs)
    assert m.filter("copy_no > 2").count() == 0 and set(docs.columns) <= set(m.columns)
    assert m.groupBy("doc_id", "text", "copy_no").count().filter("count > 1").count() == 0


# --- 10 language model ------------------------------------------------------------------------------------------------


def test_pseudo_likelihood_prefers_order(spark):
    rng = random.Random(3)
    pattern = [f"w{i}" for i in range(30)]
    texts = []
    for i in range(1500):
        k = rng.randrange(30)
        texts.append((i, " ".join(pattern[(k + j) % 30] for j in range(60))))
    shuffled = []
    for i, t in texts[:50]:
        w = t.split()
        rng.shuffle(w)
        shuffled.append((1000 + i, " ".join(w)))
    docs = docs_of(spark, texts)
    voc = pseudo_likelihood.Vocabulary(pseudo_likelihood.type_counts(docs))
    p = pseudo_likelihood.train(docs, voc)
    mean = lambda d, q: d and pseudo_likelihood.score(docs_of(spark, d), voc, q).agg(F.avg("mean_log_prob")).first()[0]
    assert mean(texts[:50], p) > mean(shuffled, p) + 0.3
    assert mean(texts[:50], p) > mean(texts[:50], pseudo_likelihood.initial(voc)) + 0.3


def test_pseudo_likelihood_counts_every_word_as_itself(spark):
    # 90,000 words, more than the cells that words were once hashed into: unseen words must not take others' counts.
    texts = [(i, " ".join(f"word{j}" for j in range(90 * i, 90 * i + 90)) + " often" * 10) for i in range(1000)]
    docs = docs_of(spark, texts)
    counts = pseudo_likelihood.type_counts(docs)
    assert counts.count() == 90_001 and counts.agg(F.sum("n"), F.max("n")).first()[:] == (100_000, 10_000)
    asked = docs_of(spark, [(1, " ".join(f"word{j}" for j in range(50))), (2, " ".join(f"junk{j}" for j in range(50))), (3, "often word1 junk1")])
    whole = pseudo_likelihood.Vocabulary(counts)
    assert whole.n_rare == 0
    means = {r["doc_id"]: r["mean_log_prob"] for r in pseudo_likelihood.score(asked, whole, pseudo_likelihood.initial(whole)).collect()}
    assert means[1] > means[2]
    # With a short head the same counts come from the join: P over all words of the corpus stays one.
    short = pseudo_likelihood.Vocabulary(counts, head=10)
    assert short.n_rare == 90_000
    t = short.types
    assert abs(t.class_mass.sum() - (190_001 + t.rare_classes)) < 1e-6
    p = pseudo_likelihood.initial(short)
    for k in ("E", "W", "U"):
        p[k][:] = 0
    got = {r["doc_id"]: r["log_likelihood"] for r in pseudo_likelihood.score(asked, short, p).collect()}
    expected = sum(math.log(n / (190_001 + t.rare_classes)) for n in (10_001, 2, 1))
    assert abs(got[3] - expected) < 1e-3
    assert abs(got[1] - got[2] - 50 * math.log(2)) < 1e-2


def test_pseudo_likelihood_trains_on_every_position(spark, monkeypatch):
    docs = docs_of(spark, [(i, " ".join(f"w{(i + j) % 50}" for j in range(40))) for i in range(50)])
    voc = pseudo_likelihood.Vocabulary(pseudo_likelihood.type_counts(docs))
    seen = []
    summed = pseudo_likelihood.summed
    monkeypatch.setattr(pseudo_likelihood, "summed", lambda s: seen.append(summed(s)) or seen[-1])
    pseudo_likelihood.train(docs, voc)
    assert seen[-1][1] == 2000


def test_pseudo_likelihood_against_a_plain_network(spark, monkeypatch):
    monkeypatch.setattr(pseudo_likelihood, "SHARD_BYTES", 3000)
    rng = random.Random(31)
    docs = docs_of(spark, [(i, prose(rng, 40, 120)) for i in range(60)])
    scores = []
    for parts in (2, 7):
        d = docs.repartition(parts)
        voc = pseudo_likelihood.Vocabulary(pseudo_likelihood.type_counts(d))
        p = pseudo_likelihood.train(d, voc)
        scores.append({r["doc_id"]: r["log_likelihood"] for r in pseudo_likelihood.score(d, voc, p).collect()})
    assert all(scores[0][i] == pytest.approx(scores[1][i], rel=1e-6) for i in scores[0])
    # By hand: a forward pass a word at a time, all words of the vocabulary at every place.
    t, text = voc.types, docs.filter("doc_id = 3").first()["text"].split()
    rolling = common.Rolling()
    hashed = lambda ws: pseudo_likelihood.words_of(np.frombuffer(" ".join(ws).encode(), np.uint8), np.array([0, len(" ".join(ws))]), rolling)[0]
    vocabulary = sorted({w for r in docs.collect() for w in r["text"].split()})
    known = dict(zip(vocabulary, zip(*t.look_up(hashed(vocabulary)), strict=True), strict=True))
    total = 0.0
    for i, w in enumerate(text):
        x = np.concatenate([p["E"][known[text[i + d]][0] if 0 <= i + d < len(text) else 0] for d in (-2, -1, 1, 2)])
        h = np.tanh(x @ p["W"] + p["b"])
        z = np.exp(h @ p["U"] + p["c"])
        chances = {}
        for v, (_, cls, inside, _, leaf) in known.items():
            chance, node = z[cls] / z.sum() * math.exp(inside), cls * pseudo_likelihood.NODES
            low, high, at = 0, 1 << pseudo_likelihood.LEVELS, 0
            while high - low > 1:
                right = (leaf & ((1 << pseudo_likelihood.LEVELS) - 1)) >= (low + high) // 2
                if t.live[node + at]:
                    s = 1 / (1 + math.exp(-(h[: pseudo_likelihood.SEEN] @ p["V"][node + at] + p["v"][node + at])))
                    chance *= s if right else 1 - s
                low, high, at = ((low + high) // 2, high, 2 * at + 2) if right else (low, (low + high) // 2, 2 * at + 1)
            chances[v] = chance
        # Classes of words that the corpus lacks hold the rest.
        assert 0.9 < sum(chances.values()) < 1.0001
        total += math.log(chances[w])
    assert total == pytest.approx(scores[1][3], rel=1e-4)


def test_pseudo_likelihood_step_follows_the_gradient():
    """The first Adagrad step of every parameter, against differences of the loss that scoring computes."""
    rng, q = np.random.default_rng(1), pseudo_likelihood
    words = np.arange(1, 301)
    t = q.Types(words, 3000 // words, 300, 0.0)
    p = {k: rng.standard_normal(s) * 0.3 for k, s in q.shapes(t.n_inputs).items()}
    context, leaf = rng.integers(0, 20, (64, 2 * q.SIDE)), np.where(np.arange(64) % 9 == 0, -1, rng.choice(t.leaves, 64))
    target = np.where(leaf < 0, q.CLASSES - 1, leaf >> q.LEVELS)
    trainer = q.Trainer({k: v.astype(np.float32) for k, v in p.items()}, t.live)
    trainer.step(context, target, leaf)
    loss = lambda: -float(np.mean(q.log_probabilities(p, context, target, leaf, t.live), dtype=np.float64))
    for k in p:
        step = p[k] - trainer.p[k]
        for at in np.argsort(-np.abs(step), axis=None)[[0, 1, 5]]:
            i = np.unravel_index(at, step.shape)
            m, own = step[i], p[k][i]
            ends = []
            for d in (1e-2, -1e-2):
                p[k][i] = own + d
                ends.append(loss())
            p[k][i] = own
            assert abs(0.1 * m / math.sqrt(q.RATE**2 - m * m) - (ends[0] - ends[1]) / 2e-2) < 1e-3, k
    assert trainer.seen == 64


def test_pseudo_likelihood_edges(spark):
    docs = docs_of(spark, edge_texts(random.Random(1)))
    voc = pseudo_likelihood.Vocabulary(pseudo_likelihood.type_counts(docs))
    out = {r["doc_id"]: r for r in pseudo_likelihood.score(docs, voc, pseudo_likelihood.train(docs, voc)).collect()}
    assert len(out) == 10 and out[1]["n_tokens"] == 0 and out[1]["log_likelihood"] == 0 and out[1]["mean_log_prob"] is None and out[6]["n_tokens"] == 20_000
    empty = docs.limit(0)
    pseudo_likelihood.train(empty, pseudo_likelihood.Vocabulary(pseudo_likelihood.type_counts(empty)))
    assert pseudo_likelihood.score(empty, voc, pseudo_likelihood.initial(voc)).count() == 0


# --- shared -----------------------------------------------------------------------------------------------------------


def test_rolling_windows():
    r = common.Rolling()
    data = np.frombuffer(b"abcabcabd", np.uint8)
    h = r.windows(r.prefix(data), 3)
    assert h[0] == h[3] and h[0] != h[6] and len(set(h.tolist())) == 4


def test_scratch_removes_what_is_no_result(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(common, "shared_dir", lambda _: str(tmp_path))
    with common.scratch(spark):
        part = common.written(spark.range(3), "part")
        with common.scratch(spark):
            inner = common.result(common.written(part.selectExpr("id + 1 as id"), "inner"), "inner-result")
        assert inner.count() == 3
        out = common.result(inner, "out")
    assert out.count() == 3 and [p.name.rpartition("-")[0] for p in tmp_path.iterdir()] == ["out"]


def test_a_cluster_needs_a_shared_folder():
    class Session:
        conf = {}
        sparkContext = type("C", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError, match="checkpoint"):
        common.shared_dir(Session)


@pytest.mark.parametrize("words", [6, 20, 60, 100, 200, 400])
def test_decontamination_finds_items_of_every_length(words):
    """Items at the largest distance, edited at random; all that brute force finds are due, 0.9 of them at least."""
    rng = random.Random(words)

    def text(n):
        return " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=rng.randrange(3, 9))) for _ in range(n)).encode()

    def edited(raw, k):
        b = bytearray(raw)
        for _ in range(k):
            i, c = rng.randrange(len(b)), rng.choice(b"abcdefghijklmnopqrstuvwxyz ")
            (b.__setitem__, lambda i, _: b.__delitem__(i), b.insert)[rng.randrange(3)](i, c)
        return bytes(b)

    items = [(i, cgk_decontam.normal(text(words))) for i in range(30)]
    docs = [(i, text(15) + b" " + edited(t, int(cgk_decontam.MAX_EDITS * len(t))) + b" " + text(15)) for i, t in items] + [(100 + i, text(words + 30)) for i in range(5)]
    due = {(i, j) for i, d in docs for j, t in items if i == j and cgk_decontam.edit_search(t, cgk_decontam.normal(d))[0] <= cgk_decontam.MAX_EDITS * len(t)}
    got = {(r[0], r[1]): r for r in cgk_decontam.Items(items).verified(docs)}
    assert len(due) >= 25 and len(due & got.keys()) >= 0.9 * len(due) and all(i < 100 for i, _ in got)
    by_id = dict(docs)
    for (i, j), r in got.items():
        assert r[2] == cgk_decontam.edit_search(dict(items)[j], cgk_decontam.normal(by_id[i]))[0]
