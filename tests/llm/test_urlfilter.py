import time

from coffer.llm import urlfilter

RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "bad.org", "/x/")]
SCHEMA = "page_id long, url string, html string, host string"


def judged(spark, pages, edges=None):
    rules = urlfilter.rule_table(spark, RULES)
    df = spark.createDataFrame([(i, u, h, "clash") for i, u, h in pages], SCHEMA)
    log = spark.createDataFrame(edges, "a string, b string") if edges else None
    return {r["page_id"]: r for r in urlfilter.judged(df, rules, log).collect()}


def test_parsing_and_longest_rule(spark):
    got = judged(
        spark,
        [
            (1, "http://WWW.Example.NET/en/a?q=/#f", None),
            (2, "http://example.net/de/", ""),
            (3, "http://example.net", ""),
            (4, "no scheme", ""),
            (5, None, None),
            (6, "HTTP://x.com?u=http://y.net/", ""),
            (7, "http://fakebad.org/x/", ""),
            (8, "http://a.bad.org/x/y", ""),
            (9, "http://bad.org/X/", ""),
        ],
    )
    assert [(got[i]["host"], got[i]["path"], got[i]["rule"], got[i]["verdict"]) for i in range(1, 10)] == [
        ("www.example.net", "/en/a", "example.net/en/", "allow"),
        ("example.net", "/de/", "net/", "block"),
        ("example.net", "", None, "allow"),
        ("", "", None, "allow"),
        ("", "", None, "allow"),
        ("x.com", "", None, "allow"),
        ("fakebad.org", "/x/", None, "allow"),
        ("a.bad.org", "/x/y", "bad.org/x/", "block"),
        ("bad.org", "/X/", None, "allow"),
    ]


def test_aliases_follow_links_and_allow_wins(spark):
    canonical = '<LINK href="{}" rel=canonical>'.format
    refresh = "<meta http-equiv='Refresh' content='0; url={}'>".format
    pages = [
        (1, "http://a.com/1", canonical("http://spam.net/x")),
        (2, "http://b.com/2#top", refresh("http://a.com/1")),
        (3, "http://c.com/3", canonical("/4")),
        (4, "http://c.com/4", canonical("https://example.net/en/ok")),
        (5, "http://d.com/5", canonical("http://spam.net/y") + canonical("//example.net/en/ok2")),
        (6, "http://e.com/dir/6", canonical("7")),
        (7, "http://e.com/dir/7", ""),
        (8, "http://f.com/8", ""),
        (9, "http://spam.net/y", ""),
    ]
    got = judged(spark, pages, [("http://f.com/8", "http://b.com/2"), ("http://f.com/8", None)])
    assert {i: (r["verdict"], r["reason"]) for i, r in got.items()} == {
        1: ("block", "alias"),
        2: ("block", "alias"),
        3: ("allow", "alias"),
        4: ("allow", "alias"),
        5: ("allow", "alias"),
        6: ("allow", "default"),
        7: ("allow", "default"),
        8: ("block", "alias"),
        9: ("block", "rule"),
    }


def test_repeated_rows_and_empty_table(spark):
    rules = urlfilter.rule_table(spark, RULES)
    df = spark.createDataFrame([(1, "http://a.net/", "", "")] * 3, SCHEMA)
    assert urlfilter.judged(df, rules).count() == 3
    assert urlfilter.judged(df.limit(0), rules).count() == 0


def test_contrary_rules_and_very_long_hosts(spark):
    rules = urlfilter.rule_table(spark, [("allow", "a.net", "/x/"), ("block", "a.net", "/x/"), ("block", "net", "/")])
    long = "http://" + "l." * 100_000 + "a.net/x/" + "p/" * 1000
    pages = [(None, "http://b.a.net/x/1", ""), (1, "http://a.net/y", ""), (2, long, ""), (3, "http://" + "x" * 300_000, None)]
    df = spark.createDataFrame([(i, u, h, "") for i, u, h in pages], SCHEMA)
    started = time.time()
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in urlfilter.judged(df, rules).collect()}
    assert got == {None: ("a.net/x/", "allow"), 1: ("net/", "block"), 2: ("a.net/x/", "allow"), 3: (None, "allow")}
    assert time.time() - started < 60
