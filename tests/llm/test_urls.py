from tessella.llm import urls


def test_rules_hosts_and_paths(spark):
    cases = [
        (1, "https://A.Example.COM/en/7x?q#f", "a.example.com", "/en/7x", "example.com/en/7", "allow"),
        (2, "http://example.com/en/8", "example.com", "/en/8", "com/en/", "block"),
        (3, "http://notexample.com/en/7", "notexample.com", "/en/7", "com/en/", "block"),
        (4, "http://x.example.net/de/8", "x.example.net", "/de/8", "example.net/de/8", "block"),
        (5, "http://com/en/", "com", "/en/", "com/en/", "block"),
        (6, "http://h.org?x=/es/", "h.org", "", None, "allow"),
        (7, None, "", "", None, "allow"),
        (8, "no scheme/en/", "", "", None, "allow"),
        (11, "http://b.net/de/3", "b.net", "/de/3", "net/de/", "allow"),
        (12, "http://net/de/8", "net", "/de/8", "net/de/", "allow"),
        (13, "http://example.net/de/7", "example.net", "/de/7", "net/de/", "allow"),
        (14, "http://example.com/en/70", "example.com", "/en/70", "example.com/en/7", "allow"),
        (9, "a://b.org/es/x\ny://z#", "b.org", "/es/x\ny://z", "org/es/", "block"),
        (None, "http://É.COM/", "É.com", "/", None, "allow"),
    ]
    df = spark.createDataFrame([(c[0], c[1], "h", "n") for c in cases], "page_id long, url string, host string, n string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = sorted(map(tuple, urls.judge(df, labels).collect()), key=str)
    assert got == sorted(((c[0], *c[2:]) for c in cases), key=str)
    none = spark.createDataFrame([(None, 0, 1), (1, None, None)], "doc_id long, quality int, toxic int")
    assert sorted(map(tuple, urls.judge(df.union(df), none).collect()), key=str) == sorted(2 * got, key=str)
    assert urls.judge(df.limit(0), labels).collect() == []


def test_bad_hosts_are_blocked_and_sparse_ones_shrink(spark):
    pages, labels = [], []
    for i in range(400):
        host = ["bad.site.io", "good.site.io", "fine.other.io", "ok.third.io"][i % 4]
        pages.append((i, f"http://{host}/p{i}"))
        labels.append((i, 1, 1 if host == "bad.site.io" else 0))
    pages.append((400, "http://once.fourth.io/x"))
    labels.append((400, 1, 1))
    got = {r.host: r.verdict for r in urls.judge(spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()}
    assert got == {"bad.site.io": "block", "good.site.io": "allow", "fine.other.io": "allow", "ok.third.io": "allow", "once.fourth.io": "allow"}


def test_domains_and_suffixes(spark):
    cases = [("a.b.co.uk", "b.co.uk", "co.uk"), ("co.uk", "co.uk", "uk"), ("a.example.com", "example.com", "com"), ("com", "com", "com"), ("", "", ""), ("10.1.2.3", "10.1.2.3", ""), ("b.com.io", "b.com.io", "com.io"), ("x.com.info", "com.info", "info")]
    df = spark.createDataFrame([("u:p@" * (i % 2) + name + ":80" * (i % 3 == 0), i) for i, (name, _, _) in enumerate(cases)], "host string, i int")
    got = urls.with_parents(df.withColumn("name", urls.name_of(df.host))).orderBy("i").collect()
    assert [(r.name, r.domain, r.suffix) for r in got] == cases
