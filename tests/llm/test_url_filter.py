import random

import pytest
from pyspark.sql import functions as F

from millrace.llm import url_filter as uf
from millrace.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
RULES = {"org/": "allow", "example.org/es/": "block", "example.org/en/1": "block", "com/fr/": "allow", "com/de/": "block"}
URLS = [
    None, "", "nothing", "http://", "HTTP://Example.ORG/es/1?x#y", "https://a.example.org/en/12", "http://example.org/en/2", "http://badexample.org/es/1",
    "http://org", "http://org/", "http://x.com/fr/1", "http://x.com/fr", "http://x.com/de/#a", "http://xcom/de/", "http://com?utm_a=1", "a://b://c/d",
    "http://n.net/p?utm_source=1", "http://n.net/p", "http://n.net/q?xutm_source=1", "http://n.net/q#utm_a=1?utm_a=2", "http://É.net/p?a=1&utm_b=2", "x" * 100_000,
    "http://h.net/" + "y" * 100_000, "http://N.NET/p", "http://example.org/es/%_",
]


def brute(urls):
    out, split = [], []
    for url in urls:
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        at = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:at])
        path = rest[at:].split("?")[0].split("#")[0]
        query = (url or "").split("#")[0].partition("?")[2]
        split.append((host, path, any(p.split("=")[0][:4] == "utm_" and "=" in p for p in query.split("&"))))
    listed = {h + p for h, p, t in split if t}
    for host, path, _ in split:
        fits = []
        for rule in RULES:
            h, _, p = rule.partition("/")
            if (host == h or host.endswith("." + h)) and path.startswith("/" + p):
                fits.append(rule)
        rule = max(fits, key=len, default=None)
        out.append((host, path, rule, RULES[rule] if rule else "block" if host + path in listed else "allow"))
    return out


def pages(spark, urls):
    rows = [(i, u, "x", "y") for i, u in enumerate(urls)]
    return spark.createDataFrame(rows, "page_id long, url string, host string, key string")


def test_query(spark):
    import duckdb

    rows = sorted(tuple(r) for r in QUERIES["op9_url_filter"](spark, SF).collect())
    table = sorted(tuple(r) for r in spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "url").collect())
    assert rows == [(i, *b) for (i, _), b in zip(table, brute([u for _, u in table]), strict=True)]
    db = duckdb.connect()
    db.execute(f"CREATE VIEW pages AS SELECT * FROM '{SF}/pages.parquet'")
    assert sorted(db.execute(ORACLES["op9_url_filter"]).fetchall()) == rows


@pytest.mark.parametrize("most", [2_000_000, 0])
def test_odd_rows(spark, monkeypatch, most):
    """Also where the list is too long for filters."""
    monkeypatch.setattr(uf, "MAX_WORDS", most)
    rows = sorted(tuple(r) for r in uf.judge(pages(spark, URLS)).collect())
    assert [r[1:] for r in rows] == brute(URLS)
    twice = uf.judge(pages(spark, URLS[16:18]).unionByName(pages(spark, URLS[16:18]))).collect()
    assert len(twice) == 4
    assert uf.judge(pages(spark, URLS).limit(0)).collect() == []


def test_sql_of_odd_urls(spark):
    import duckdb

    db = duckdb.connect()
    db.execute("CREATE TABLE pages (page_id BIGINT, url VARCHAR)")
    db.executemany("INSERT INTO pages VALUES (?, ?)", [(i, u) for i, u in enumerate(URLS)])
    assert [r[1:] for r in sorted(db.execute(ORACLES["op9_url_filter"]).fetchall())] == brute(URLS)


@pytest.mark.parametrize("share", [0, 0.02, 0.5, 1])
def test_cascade_is_exact(spark, monkeypatch, share):
    """Small filters make many mistakes, so that many levels are needed."""
    monkeypatch.setattr(uf, "BITS_PER_KEY", 4)
    monkeypatch.setattr(uf, "HASHES", 2)
    rng = random.Random(1)
    keys = [(f"k{i}", rng.random() < share) for i in range(1500)]
    universe = spark.createDataFrame(keys, "key string, listed boolean")
    levels = uf.cascade(universe)
    assert len(levels) > (2 if 0 < share < 1 else -1)
    got = uf.listed(universe.select(F.col("key").alias("k")), universe, "k").collect()
    assert {(r["k"], r["__listed"]) for r in got} == set(keys)
