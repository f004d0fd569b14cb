import random
import re

import duckdb
import pytest

from georisk.llm import catalog, url_filter as uf

LOWER = str.maketrans(uf.UPPER, uf.LOWER)


def parts(url):
    if url is None or "://" not in url:
        return "", "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    path = re.match(r"[^?#]*", rest[len(host):])[0]
    query = re.match(r"\?([^#]*)", rest[len(host) + len(path):])
    return host.translate(LOWER), path, query[1] if query else ""


def canonical(url):
    host, path, query = parts(url)
    kept = sorted(x for x in query.split("&") if x and not re.match(r"(utm_[^=]*|ref|fbclid|gclid)(=|$)", x))
    return host.removeprefix("www.") + path.rstrip("/") + ("?" + "&".join(kept) if kept else "") if host else None


def brute(rows, listed, rules):
    names = {canonical(u) for u in listed} - {None}
    out = []
    for i, u in rows:
        host, path, _ = parts(u)
        fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
        best = max(fits, key=lambda r: len(r.name), default=None)
        verdict = best.verdict if best else "block" if canonical(u) in names else "allow"
        out.append((i, host, path, best and best.name, verdict))
    return sorted(out, key=str)


URLS = [None, "", "no scheme", "http://", "HTTP://WWW.Example.ORG/es/1", "http://example.org/es", "x://a.example.org/en/12?q#f",
        "http://badexample.org/en/1", "http://org", "http://org/", "http://x.com/fr/", "http://x.com?a=/fr/", "http://É.COM/de/É",
        "https://n.net/a/?utm_source=x&b=2&a=1#z", "http://n.net/a?a=1&b=2", "http://www.n.net/a/", "http://n.net/a?ref",
        "http://n.net/a?reference=1", "a://b://c/d", "http://n.net/a\n/b", "http://" + "h" * 5000 + ".net/" + "p" * 20000]


@pytest.mark.parametrize("max_blocks", [1, 4, 1 << 16])
def test_matches_brute_force_at_any_filter_size(spark, max_blocks):
    rng = random.Random(6)
    more = [f"http://h{rng.randrange(40)}.net/{rng.randrange(30)}{rng.choice(['', '/', '?x=1', '#y'])}" for _ in range(400)]
    rows = [(i, u) for i, u in enumerate(URLS + more + more[:5])] + [(None, more[0])]
    listed = rng.sample(more, 60) + URLS[:4] + ["https://n.net/a?b=2&a=1", "http://org/", "http://n.net/a\n/b"]
    d = spark.createDataFrame([(i, u, "x") for i, u in rows], "page_id long, url string, block string")
    got = uf.judge(d, spark.createDataFrame([(u,) for u in listed], "url string"), catalog.RULES, max_blocks=max_blocks,
                   keys_per_block=4)
    seen = sorted(((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()), key=str)
    assert seen == brute(rows, listed, catalog.RULES)


def test_bloom_filter_passes_all_listed_and_few_others(spark):
    listed = spark.range(2000).selectExpr("concat('h', id) AS canonical")
    others = spark.range(2000, 22000).selectExpr("concat('h', id) AS canonical")
    bloom = uf.bloom_filter(listed, 128)
    assert bloom.count() <= 128
    assert uf.possibly_listed(listed, bloom, 128).filter("possible").count() == 2000
    assert uf.possibly_listed(others, bloom, 128).filter("possible").count() < 400


def test_empty_tables_and_no_rules(spark):
    d = spark.createDataFrame([(1, "http://n.net/a")], "page_id long, url string")
    assert uf.judge(d.limit(0), d.select("url"), catalog.RULES).count() == 0
    assert [r["verdict"] for r in uf.judge(d, d.select("url").limit(0), catalog.RULES).collect()] == ["allow"]
    assert [(r["verdict"], r["rule"]) for r in uf.judge(d, d.select("url"), []).collect()] == [("block", None)]


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.01"
    con = duckdb.connect()
    for t in ("pages", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf}/{t}.parquet')")
    want = con.execute(catalog.ORACLES["op3_url_filter"]).fetchall()
    got = [tuple(r) for r in catalog.QUERIES["op3_url_filter"](spark, sf).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert {r[4] for r in got if r[3] is None} == {"allow", "block"}
