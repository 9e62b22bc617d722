import re

from chunkwise.llm.common import ship
from chunkwise.llm.queries import URL_RULES
from chunkwise.llm.url_cascade import Cascade, host_path, judge_urls, repeated_addresses
from pyspark.sql import functions as F

URLS = ["http://Example.ORG/en/12?x=1#y", "https://a.example.org/es/", "http://org/x", "http://org",
        "no scheme", None, "", "http://", "x://y.com/de/1", "x://Y.com/DE/1", "http://com/fr/", "a://b://c/d",
        "http://notexample.org/en/1", "http://a.b?q://z", "http://h.net/p", "https://h.net/p?again",
        "http://h.net/p#more", "http://once.net/p", "http://É.net/Ü", "http://h.net/" + "long/" * 5000,
        "http://org.", "http://u@org:80/x"]


def brute(url):
    rest = url.split("://", 1)[1] if url and "://" in url else ""
    host, path = re.match(r"([^/?#]*)([^?#]*)", rest, re.S).groups()
    host = re.sub("[A-Z]", lambda m: m[0].lower(), host)
    rules = [r for r in URL_RULES if (host == r[0] or host.endswith("." + r[0])) and path.startswith(r[1])]
    return host, path, max(rules, key=lambda r: len(r[0] + r[1]), default=None)


def test_edge_urls(spark):
    pages = spark.createDataFrame([(i, u, "rule", "x") for i, u in enumerate(URLS + URLS[-8:-6])],
                                  "page_id int, url string, rule string, listed string")
    cascade = Cascade.build(*repeated_addresses(pages))
    found = {r["page_id"]: r for r in judge_urls(pages, URL_RULES, cascade).collect()}
    keys = [brute(u)[0] + brute(u)[1] for u in URLS + URLS[-8:-6]]
    for i, u in enumerate(URLS + URLS[-8:-6]):
        host, path, rule = brute(u)
        listed = bool(host) and keys.count(host + path) > 1
        assert (found[i]["host"], found[i]["path"]) == (host, path), u
        assert found[i]["rule"] == (rule[0] + rule[1] if rule else None)
        assert found[i]["verdict"] == (rule[2] if rule else "block" if listed else "allow")


def test_cascade_is_exact_with_and_without_shards(spark):
    universe = spark.range(3000).select(F.concat(F.lit("k"), "id").alias("key"))
    listed = universe.filter("crc32(key) % 3 = 0")
    for most in (4_000_000, 900):
        cascade = Cascade.build(listed, universe, max_keys=most)
        assert cascade.shards == -(-3000 // most)
        marked = cascade.mark(universe.unionByName(spark.sql("select cast(null as string) as key")),
                              F.col("key"), "hit")
        assert marked.count() == 3001
        assert marked.filter("hit <> coalesce(crc32(key) % 3 = 0, false)").count() == 0


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id bigint, url string")
    assert judge_urls(pages, URL_RULES, Cascade.build(*repeated_addresses(pages))).count() == 0


def test_no_python_on_the_main_path(spark):
    ship(spark)
    pages = spark.createDataFrame([(i, u) for i, u in enumerate(URLS)], "page_id int, url string")
    df = judge_urls(pages, URL_RULES, Cascade.build(*repeated_addresses(pages)))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas", "CartesianProduct", "NestedLoop"))
    host, path = host_path(F.lit("http://A.b/c?d"))
    assert tuple(spark.range(1).select(host, path).first()) == ("a.b", "/c")
