from __future__ import annotations

import random

from pyspark.sql import functions as F

from tickwise.llm.url_filter import RULES, build_cascade, domains, judge, judge_by_list, key_universe, listed

URLS = "page_id bigint, url string, host string, rule string"


def urls_of(spark, urls):
    return spark.createDataFrame([(i, u, "other", "other") for i, u in enumerate(urls)], URLS)


def test_cascade_is_exact_on_its_universe(spark):
    rng = random.Random(2)
    for n, share in ((3000, 0.02), (500, 0.5), (200, 0.97), (50, 1.0), (50, 0.0)):
        rows = [(f"key{i}", rng.random() < share) for i in range(n)]
        keys = spark.createDataFrame(rows, "key string, listed boolean")
        levels = build_cascade(keys)
        assert keys.where(listed(F.col("key"), levels) != F.col("listed")).count() == 0
        assert (levels == []) == (not any(x for _, x in rows))


def test_too_large_a_filter_is_refused(spark):
    keys = spark.range(1000).select(F.col("id").cast("string").alias("key"), (F.col("id") % 2 == 0).alias("listed"))
    try:
        build_cascade(keys, max_filter_bytes=16)
    except ValueError as e:
        assert "bound" in str(e)
    else:
        raise AssertionError("no error")


def brute(url, block):
    if url is None or "://" not in url:
        return "", "", None, "allow"
    rest = url.split("://", 1)[1]
    cut = min((rest.index(c) for c in "/?#" if c in rest), default=len(rest))
    host, tail = rest[:cut].translate({c: c + 32 for c in range(65, 91)}), rest[cut:]
    path = tail[: min((tail.index(c) for c in "?#" if c in tail), default=len(tail))]
    fits = [(len(h + p), h + p, v) for v, h, p in RULES if (host == h or host.endswith("." + h)) and path.startswith(p)]
    if fits:
        _, rule, verdict = max(fits)
        return host, path, rule, verdict
    names = host.split(".")
    return host, path, None, "block" if any(".".join(names[i:]) in block for i in range(len(names))) else "allow"


def test_verdicts(spark):
    urls = [
        None, "", "no scheme/", "http://", "http://net", "http://net/", "HTTP://A.NET/x", "http://a.example.net/en/1", "http://example.net/en",
        "http://xexample.net/en/", "http://example.com/de/1?x=/en/", "http://b.example.com/DE/", "http://w.org/fr/", "http://org/fr/#a",
        "http://org?/fr/", "http://bad.example.com/", "http://m.bad.example.com/fr/", "http://badder.example.com/", "a://b://c/d", "http://x.org/fr/\n",
        "http://bad.example.com/de/x", "http://Bad.Example.com", "http://ÄB.org/", "http://bad.example.com/",
    ]
    block = {"bad.example.com"}
    pages = urls_of(spark, urls)
    keys = key_universe(pages).withColumn("listed", F.col("key").isin(*block))
    rows = judge(pages, build_cascade(keys)).collect()
    assert len(rows) == len(urls)
    for r in rows:
        assert (r.host, r.path, r.rule, r.verdict) == brute(urls[r.page_id], block), urls[r.page_id]


def test_a_list_beyond_the_bound_is_judged_in_slices(spark):
    rng = random.Random(9)
    hosts = [f"h{rng.randrange(4000)}.d{rng.randrange(900)}.org" for _ in range(3000)]
    pages = urls_of(spark, [f"http://{h}/" for h in hosts] + [None, "http://x.net/"])
    universe = {".".join(h.split(".")[i:]) for h in hosts for i in range(3)}
    for share in (0.5, 0.02):
        block = {k for k in sorted(universe) if rng.random() < share and k != "org"}
        found = spark.createDataFrame([(k,) for k in sorted(block)], "key string")
        keys = key_universe(pages).join(found.withColumn("l", F.lit(True)), "key", "left").select("key", F.coalesce("l", F.lit(False)).alias("listed"))
        # several slices; a bound at which the whole list fits
        for bound in (600 if share > 0.1 else 90, 1 << 20):
            rows = judge_by_list(pages, keys, max_filter_bytes=bound).collect()
            assert len(rows) == len(hosts) + 2
            for r in rows:
                host = hosts[r.page_id] if r.page_id < len(hosts) else None
                want = "block" if host is None and r.rule or host and any(".".join(host.split(".")[i:]) in block for i in range(3)) else "allow"
                assert r.verdict == want, r
    assert judge_by_list(urls_of(spark, []), keys, max_filter_bytes=90).count() == 0


def test_no_urls(spark):
    pages = urls_of(spark, [])
    assert judge(pages, build_cascade(key_universe(pages).withColumn("listed", F.lit(True)))).count() == 0


def test_domains_of_long_hosts(spark):
    rng = random.Random(5)
    hosts = ["", ".", "a", "a.b", "..a", "x" * 253, "x" * 254, "a." + "x" * 251, "a." + "x" * 252, "ab." + "x" * 252, "." + "x" * 253]
    hosts += [".".join("ab"[: rng.randrange(3)] or "c" for _ in range(rng.randrange(100, 160))) for _ in range(200)]
    hosts.append(".".join(["label"] * 20_000))
    rows = spark.createDataFrame([(h,) for h in hosts], "host string").select("host", domains(F.col("host")).alias("d")).collect()
    for r in rows:
        labels = r.host.split(".")[-300:]
        every = [".".join(labels[i:]) for i in range(len(labels))]
        assert r.d == [d for d in every if len(d) <= 253]


def test_verdicts_of_very_long_urls(spark):
    deep = ".".join(["www"] * 50_000)
    urls = [f"http://{deep}.bad.org/", f"http://{deep}.good.org/", f"http://{deep}.example.net/en/", "http://" + "y" * 1_000_000, f"http://bad.org/{'z' * 1_000_000}"]
    pages = urls_of(spark, urls)
    keys = key_universe(pages).withColumn("listed", F.col("key") == "bad.org")
    rows = {r.page_id: r for r in judge(pages, build_cascade(keys)).collect()}
    assert [rows[i].verdict for i in range(5)] == ["block", "allow", "allow", "allow", "block"]
    assert rows[0].host == f"{deep}.bad.org" and rows[2].rule == "example.net/en/" and rows[3].host == "y" * 1_000_000
