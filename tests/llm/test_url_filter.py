from activitymill.llm import url_filter as u

SCHEMA = "page_id long, url string, html string, host string, rule int, score string, verdict string"


def judged(spark, urls, labelled=()):
    pages = spark.createDataFrame([(i, x, None, "h", 1, "s", "v") for i, x in enumerate(urls)], SCHEMA)
    model = u.fit(spark.createDataFrame(list(labelled), "url string, block boolean"))
    return [tuple(r)[1:5] for r in sorted(u.judge(pages, model).collect())]


def test_parts_and_rules(spark):
    got = judged(spark, [
        "http://A.Example.ORG/es/x?q#f", "https://example.org/en/1", "https://example.org/en/2", "https://notexample.com/fr/",
        "http://x.com/de/a", "http://com/fr/", "http://x.org", "http://x.org?/", "ftp://É.org/ü#a?b", "a.org/es/", None, "",
        "http://u@x.com:80/de/", "http://x.xorg/", "http://a.com/de/http://b.org/",
    ])
    assert [g[:3] for g in got] == [
        ("a.example.org", "/es/x", "example.org/es/"), ("example.org", "/en/1", "example.org/en/1"),
        ("example.org", "/en/2", "org/"), ("notexample.com", "/fr/", "com/fr/"), ("x.com", "/de/a", "com/de/"),
        ("com", "/fr/", "com/fr/"), ("x.org", "", None), ("x.org", "", None), ("É.org", "/ü", "org/"), ("", "", None),
        ("", "", None), ("", "", None), ("u@x.com:80", "/de/", None), ("x.xorg", "/", None),
        ("a.com", "/de/http://b.org/", "com/de/"),
    ]
    assert [g[3] for g in got[:6]] == ["block", "block", "allow", "allow", "block", "allow"]


def test_longest_rule_wins_and_the_longer_host_breaks_ties(spark):
    rules = (u.Rule("allow", "a.b", "/"), u.Rule("block", "b", "/xy"), u.Rule("block", "c.b", "/"), u.Rule("allow", "b", "/zz"))
    pages = spark.createDataFrame([(1, "http://a.b/xy"), (2, "http://c.b/zz")], "page_id long, url string")
    got = {r.page_id: r.rule for r in u.judge(pages, u.fit(spark.createDataFrame([], "url string, block boolean")), rules).collect()}
    assert got == {1: "a.b/", 2: "c.b/"}


def test_held_out_accuracy(spark):
    def url(k, bad):
        return f"http://{'ads' if bad else 'news'}{k * 7919 % 1000}.site{k % 13}.net/{'promo' if bad else 'article'}/{k}"

    model = u.fit(spark.createDataFrame([(url(k, k % 3 == 0), k % 3 == 0) for k in range(600)], "url string, block boolean"))
    pages = spark.createDataFrame([(k, url(k, k % 3 == 0)) for k in range(600, 900)], "page_id long, url string")
    hits = [(r.verdict == "block") == (r.page_id % 3 == 0) for r in u.judge(pages, model).collect()]
    assert sum(hits) >= 0.97 * len(hits)


def test_bound_and_order_of_the_sample_and_one_kind_only(spark):
    rows = [(f"http://a{k}.net/", k % 2 == 0) for k in range(400)] + [(None, True), ("http://b.net/", None)]
    df = spark.createDataFrame(rows, "url string, block boolean")
    one, two = (u.fit(d, max_rows=50) for d in (df, df.repartition(3)))
    assert (one.weights == two.weights).all() and one.bias == two.bias
    assert judged(spark, ["x", None], [("http://a.net/", True)] * 3) == [("", "", None, "block")] * 2
    assert judged(spark, ["x"]) == [("", "", None, "allow")]
    assert judged(spark, []) == []
