"""Bloom filter cascades and URL verdicts against plain sets and string tests."""

import random

import pytest
from cases import pairs
from pyspark.sql import functions as F

from checks.compare import _rows, connect
from gridsieve.llm import urlfilter
from gridsieve.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

URLS = [
    (1, None), (2, ""), (3, "no scheme"), (4, "http://"), (5, "http://a.net"), (6, "http://a.net/"), (7, "HTTP://X.Example.NET/en/1?u=://b"),
    (8, "http://example.net/EN/"), (9, "https://net/x"), (10, "https://internet/x"), (11, "x://y://z.net/a"), (12, "http://a.org?/fr/"),
    (13, "http://a.org/fr/#x"), (14, "http://a.org/fr"), (15, "http://EXAMPLE.COM/de/x/fr/"), (16, "http://myexample.com/de/"),
    (17, "http://a.net:80/"), (18, "http://u@a.net/"), (19, "http://..net/"), (20, "http://net./"), (21, "http://ÄÖ.net/ü"), (21, "http://ÄÖ.net/ü"),
    (22, "http://cheap-pills.example.com/"), (23, "http://www.cheap-pills.example.com/en/"), (24, "http://spam-farm.example.org/fr/x"),
    (25, "http://poker.example.net/en/1"), (26, "http://pokerface.com/"), (None, "http://sub.a.net/"), (None, None),
    (27, "http://" + "a." * 20_000 + "net/" + "x" * 50_000), (28, "http://h" + "/" * 30_000), (29, "://net/\n/"),
]


def plain_parts(url):
    rest = url.partition("://")[2] if url and "://" in url else ""
    host = rest
    for sign in "/?#":
        host = host.partition(sign)[0]
    path = rest[len(host) :].partition("?")[0].partition("#")[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), path


def fits(host, path, entry):
    return bool(entry[0]) and (host == entry[0] or host.endswith("." + entry[0])) and path.startswith(entry[1])


def plain_judge(pages, rules, listed):
    out = []
    for page_id, url in pages:
        host, path = plain_parts(url)
        fit = sorted((len(r[0] + r[1]), r[2] == "block", r[0] + r[1], r[2]) for r in rules if fits(host, path, r))
        named = sorted((len(e[0] + e[1]), e[0] + e[1]) for e in listed if fits(host, path, e))
        verdict = fit[-1][3] if fit else "block" if named else "allow"
        out.append((page_id, host, path, fit[-1][2] if fit else None, verdict, named[-1][1] if named else None))
    return sorted(out, key=lambda r: tuple((v is not None, v) for v in r))


COLUMNS = ("page_id", "host", "path", "rule", "verdict", "listed")


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2) for r in rows], "page_id long, url string, html string, host int, key int").repartition(3)


def entries(spark, rows):
    return spark.createDataFrame(rows, "host string, path string")


def test_verdicts_of_awkward_urls(spark):
    listed = [("pills.example.com", ""), ("poker.example.net", "/en/"), ("a.net", "/"), ("a.org", ""), ("", "/"), ("h", "//"), ("net", "")]
    for rules in (list(urlfilter.RULES), [("net", "/", "allow"), ("net", "/", "block"), ("a.net", "", "allow"), ("", "", "block")], []):
        found = urlfilter.judge(pages_of(spark, URLS), urlfilter.rule_table(spark, rules), entries(spark, listed))
        assert pairs(found, *COLUMNS) == plain_judge(URLS, rules, listed)
    found = urlfilter.judge(pages_of(spark, URLS), urlfilter.rule_table(spark), entries(spark, []))
    assert pairs(found, *COLUMNS) == plain_judge(URLS, urlfilter.RULES, [])
    none = urlfilter.judge(pages_of(spark, []), urlfilter.rule_table(spark), entries(spark, listed))
    assert none.count() == 0


def test_named_hosts(spark):
    found = {r["host"] for r in urlfilter.named_hosts(pages_of(spark, URLS)).collect()}
    assert found == {"cheap-pills.example.com", "www.cheap-pills.example.com", "spam-farm.example.org", "poker.example.net"}


@pytest.mark.parametrize(("members", "others"), [(0, 50), (1, 0), (1, 5000), (300, 20_000), (5000, 5000), (4000, 0)])
def test_cascades_are_exact_over_the_universe(spark, members, others):
    rng = random.Random(members)
    inside = [f"h{rng.random()}.net/{i}" for i in range(members)]
    outside = [f"h{rng.random()}.org/{i}" for i in range(others)]
    absent = [f"never{i}" for i in range(min(members, 20))]

    def frame(keys):
        return spark.createDataFrame([(k,) for k in keys], "key string").repartition(4)

    cascade = urlfilter.build(frame(inside + absent), frame(inside + outside))
    assert cascade.holds(inside).all() and not cascade.holds(outside).any()
    assert cascade.holds([]).tolist() == []
    if members and others > members:
        assert len(cascade.levels) > 1
        # the first level alone errs
        assert cascade.levels[0].holds(outside).any()
        assert cascade.bytes * 8 < 64 * 20 + 40 * members


def test_shards_do_not_change_verdicts(spark):
    rng = random.Random(3)
    hosts = [f"h{i}.{rng.choice(['net', 'org'])}" for i in range(800)]
    pages = [(i, f"http://{rng.choice(['', 'www.'])}{h}/{rng.choice(['a', 'b'])}/{i}") for i, h in enumerate(hosts)]
    listed = [(h, rng.choice(["", "/a", "/a/"])) for h in rng.sample(hosts, 200)]
    frame, table = pages_of(spark, pages), entries(spark, listed)
    expected = plain_judge(pages, urlfilter.RULES, listed)
    for limit in (100, urlfilter.FILTER_BYTES):
        found = urlfilter.judge(frame, urlfilter.rule_table(spark), table, limit)
        assert pairs(found, *COLUMNS) == expected
    lengths = urlfilter.Lengths.of(table)
    known = urlfilter.universe(spark.createDataFrame([plain_parts(u) for _, u in pages], "host string, path string"), [lengths])
    assert len(urlfilter.listing(table, lengths, known.select("key"), 100).shards) > 2


def test_query_matches_sql_and_plain(spark):
    found = QUERIES["op13_url_filter"](spark, SF)
    kinds, got = _rows(found.toArrow())
    expected_kinds, expected = _rows(connect(SF).sql(ORACLES["op13_url_filter"]).to_arrow_table())
    assert kinds == expected_kinds and got == expected
    pages = [(r["page_id"], r["url"]) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()]
    listed = [(r["host"], "") for r in urlfilter.named_hosts(spark.read.parquet(f"{SF}/pages.parquet")).collect()]
    assert listed and pairs(found, *COLUMNS) == plain_judge(pages, urlfilter.RULES, listed)
    assert found.where(F.col("rule").isNotNull()).count() > 0
