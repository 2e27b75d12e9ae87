from pyspark.sql import functions as F

from tessera.llm import url_reputation as ur


def judged(spark, urls, labels=()):
    pages = spark.createDataFrame([(i, u, "x", "y") for i, u in urls], "page_id long, url string, host string, n string")
    marks = spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int")
    return {r.page_id: r for r in ur.judge(pages, marks).collect()}


def test_urls_and_rules(spark):
    got = judged(spark, [
        (1, "http://A.NET/x?q#f"), (2, "https://m.example.net/en/7"), (3, "http://example.com/de/1"),
        (4, "http://notexample.com/de/1"), (5, "http://x.org/fr/"), (6, "http://a.net"), (7, None), (8, "no scheme"),
        (9, "http://h.com?x://y"), (10, "http://example.com#/de/"), (11, "://é.Org/fr/a/b?c"),
    ])
    exp = {
        1: ("a.net", "/x", "net/", "block"), 2: ("m.example.net", "/en/7", "example.net/en/", "allow"),
        3: ("example.com", "/de/1", "example.com/de/", "block"), 4: ("notexample.com", "/de/1", None, "allow"),
        5: ("x.org", "/fr/", "org/fr/", "allow"), 6: ("a.net", "", None, "allow"), 7: ("", "", None, "allow"),
        8: ("", "", None, "allow"), 9: ("h.com", "", None, "allow"), 10: ("example.com", "", None, "allow"),
        11: ("é.org", "/fr/a/b", "org/fr/", "allow"),
    }
    assert {k: (r.host, r.path, r.rule, r.verdict) for k, r in got.items()} == exp


def test_reputation_shrinks_and_blocks(spark):
    """A host with many bad pages is blocked, one with few is not; a host
    without labels inherits its domain's rate."""
    urls, labels, n = [], [], 0
    for host, pages, bad in (("bad.a.com", 60, 58), ("good.a.com", 60, 3), ("new.b.com", 2, 2), ("good.b.com", 80, 4)):
        for k in range(pages):
            urls.append((n, f"http://{host}/{k}"))
            labels.append((n, int(k >= bad), 0))
            n += 1
    urls.append((n, "http://unseen.a.com/"))
    got = judged(spark, urls, labels + [(None, 0, 0), (0, None, 1), (1, 0, 1)])
    verdict = {r.host: r.verdict for r in got.values()}
    assert verdict == {"bad.a.com": "block", "good.a.com": "allow", "new.b.com": "allow", "good.b.com": "allow", "unseen.a.com": "allow"}
    rate = {r.host: r.bad_rate for r in got.values()}
    assert 0.5 < rate["bad.a.com"] < 58 / 60 + 0.01 and rate["new.b.com"] < 1
    assert rate["good.a.com"] < rate["unseen.a.com"] < rate["bad.a.com"]


def test_domains_of_hosts(spark):
    exp = {
        "a.b.co.uk": ("b.co.uk", "co.uk"), "b.co.uk": ("b.co.uk", "co.uk"), "co.uk": ("co.uk", "co.uk"), "x.y.uk": ("y.uk", "uk"),
        "m.a.com": ("a.com", "com"), "com": ("com", "com"), "": ("", ""), "10.0.0.1": ("10.0.0.1", "(address)"), "a.": ("a.", ""),
    }
    hosts = spark.createDataFrame([(h,) for h in exp], "host string")
    assert {r[0]: (r[1], r[2]) for r in hosts.select("host", *ur.tree(F.col("host"))).collect()} == exp
    assert hosts.select(ur.tree(F.lit("m.a.b.c"), ("b.c",))[0]).first()[0] == "a.b.c"
    named = spark.createDataFrame([("u:p@a.com:80", "a.com"), ("a.com:", "a.com"), ("a.com", "a.com")], "host string, exp string")
    assert named.where(ur.bare(F.col("host")) == F.col("exp")).count() == 3


def test_ports_share_a_host_and_owners_of_a_suffix_do_not(spark):
    """One bad owner under co.uk does not speak for another one."""
    urls = [(k, f"http://bad.co.uk:{8000 + k % 2}/{k}") for k in range(60)] + [(100 + k, f"http://good.co.uk/{k}") for k in range(60)]
    got = judged(spark, urls, [(i, int(i >= 100), 0) for i, _ in urls])
    assert {r.n_labels for r in got.values()} == {60}
    assert {r.host: r.verdict for r in got.values()} == {"bad.co.uk:8000": "block", "bad.co.uk:8001": "block", "good.co.uk": "allow"}


def test_levels_are_stored(spark):
    pages = spark.createDataFrame([(1, "http://a.b/c")], "page_id long, url string")
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    plan = ur.judge(pages, labels)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join") == 1 and "Aggregate" not in plan


def test_empty(spark):
    pages = spark.createDataFrame([], "page_id long, url string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert ur.digest(pages, labels).count() == 0
    assert ur.digest(spark.createDataFrame([(None, "http://a/b")] * 2, "page_id long, url string"), labels).count() == 2
    assert ur.digest(pages, labels).select(F.col("verdict")).schema[0].dataType.simpleString() == "string"
