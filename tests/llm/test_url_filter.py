import random

import pytest
from pyspark.sql import types as T

from tallywind.llm import url_filter as U

SCHEMA = T.StructType(
    [T.StructField("page_id", T.LongType())]
    + [T.StructField(n, T.StringType()) for n in ("url", "host", "path", "key", "block", "rule")]
)


def pages(spark, urls):
    return spark.createDataFrame([(k, u, "x", "y", "z", "b", "r") for k, u in enumerate(urls)], SCHEMA)


def listed(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "url string")


RULED = [
    ("http://a.com/x", "a.com", "/x", "com/", "allow"),
    ("http://com/", "com", "/", "com/", "allow"),
    ("http://a.com", "a.com", "", None, "allow"),
    ("HTTP://Example.COM/en/1?x#y", "example.com", "/en/1", "example.com/en/", "block"),
    ("http://b.example.com/en/", "b.example.com", "/en/", "example.com/en/", "block"),
    ("http://www.example.com/en/a", "www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("http://m.www.example.com/en/a", "m.www.example.com", "/en/a", "www.example.com/en/", "allow"),
    ("http://notexample.com/en/a", "notexample.com", "/en/a", "com/", "allow"),
    ("http://example.com/EN/a", "example.com", "/EN/a", "com/", "allow"),
    ("http://x.net/es/", "x.net", "/es/", "net/es/", "block"),
    ("http://x.net/fr/1", "x.net", "/fr/1", "net/fr/", "block"),
    ("http://x.net/fr", "x.net", "/fr", None, "allow"),
    ("http://x.net?u=http://y.com/es/", "x.net", "", None, "allow"),
    ("no scheme", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("", "", "", None, "allow"),
    ("http://ÄB.net\n/es/", "Äb.net\n", "/es/", None, "allow"),
    ("x://" + "a" * 50000 + ".net/fr/", "a" * 50000 + ".net", "/fr/", "net/fr/", "block"),
]


def test_rules(spark):
    got = U.judge(pages(spark, [r[0] for r in RULED]), listed(spark, []))
    found = {r["page_id"]: (r["host"], r["path"], r["rule"], r["verdict"]) for r in got.collect()}
    assert [found[k] for k in range(len(RULED))] == [r[1:] for r in RULED]


def test_listed_urls_are_blocked_in_every_spelling(spark):
    urls = ["https://www.Site.org/a/?utm_source=x", "http://site.org/a#top", "http://site.org/a?p=1", "http://site.org/b"]
    got = U.judge(pages(spark, urls), listed(spark, ["site.org/a", "site.org/a", None]))
    assert {r["page_id"]: r["verdict"] for r in got.collect()} == {0: "block", 1: "block", 2: "allow", 3: "allow"}


@pytest.mark.parametrize("bound", [0, 2_000_000])
def test_against_an_exact_set(spark, monkeypatch, bound):
    monkeypatch.setattr(U, "BROADCAST_BLOCKS", bound)
    rng = random.Random(3)
    urls = [f"http://s{rng.randrange(400)}.org/p{rng.randrange(9)}" for _ in range(3000)] + ["http://hot.org/"] * 1500
    keys = {f"s{k}.org/p{j}" for k in range(0, 400, 3) for j in range(0, 9, 2)} | {"hot.org"}
    got = U.judge(pages(spark, urls), listed(spark, sorted(keys)))
    want = {k: u.removeprefix("http://").removesuffix("/") in keys for k, u in enumerate(urls)}
    assert {r["page_id"]: r["listed"] for r in got.collect()} == want


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    keys = spark.range(5000).selectExpr("concat('k', id) key")
    blocks = 5000 * U.BITS_PER_URL // 64
    filled = U.bloom_filter(keys, blocks)
    assert filled.count() <= blocks
    probes = spark.range(20000).selectExpr("id", "concat('k', id) key")
    block, bits = U.block_and_bits(probes["key"], blocks)
    hit = probes.select("id", block.alias("block"), bits.alias("want")).join(filled, "block").where("bits & want = want")
    ids = {r["id"] for r in hit.select("id").collect()}
    assert set(range(5000)) <= ids
    assert len(ids) - 5000 < 0.05 * 15000


def test_list_from_the_pages_and_empty_table(spark):
    found = U.tracked_urls(pages(spark, ["http://a.org/x?utm_source=f", "http://a.org/x", "http://b.org/?q=utm_", None]))
    assert [r["key"] for r in found.collect()] == ["a.org/x"]
    assert U.judge(pages(spark, []), listed(spark, ["a"])).count() == 0
