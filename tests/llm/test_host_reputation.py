from ledgerlake.llm import host_reputation as H

URLS = {
    1: ("http://A.B.org/x?y#z", "a.b.org", "/x", "org/", "allow"),
    2: ("https://www.example.org/es/1", "www.example.org", "/es/1", "example.org/es/", "block"),
    3: ("https://example.org/en/12", "example.org", "/en/12", "example.org/en/1", "block"),
    4: ("https://notexample.org/es/1", "notexample.org", "/es/1", "org/", "allow"),
    5: ("http://x.com/fr/1", "x.com", "/fr/1", "com/fr/", "allow"),
    6: ("http://x.com/de/1", "x.com", "/de/1", "com/de/", "block"),
    7: ("http://x.com/fr", "x.com", "/fr", None, "allow"),
    8: ("http://x.org", "x.org", "", None, "allow"),
    9: (None, "", "", None, "allow"),
    10: ("no scheme/org/", "", "", None, "allow"),
    11: ("http://É.COM/de/?a", "É.com", "/de/", "com/de/", "block"),
    12: ("a://b.net/c://d.org/", "b.net", "/c://d.org/", None, "allow"),
    13: ("", "", "", None, "allow"),
    14: ("http://org/", "org", "/", "org/", "allow"),
}


def judge(spark, urls, labels):
    pages = spark.createDataFrame(
        [(k, u, "x") for k, u in urls], "page_id long, url string, rule string"
    ).repartition(3)
    return H.judge(pages, spark.createDataFrame(labels, "page_id long, bad int"))


def test_rules(spark):
    got = judge(spark, [(k, v[0]) for k, v in URLS.items()], []).collect()
    assert {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in got} == {
        k: v[1:] for k, v in URLS.items()
    }


def test_bad_hosts_are_blocked_and_single_labels_are_not(spark):
    urls = [(i, f"http://h{i % 20}.good{i % 5}.net/") for i in range(400)]
    urls += [(1000 + i, "http://w.spam.net/") for i in range(60)]
    urls += [(2000, "http://new.spam.net/"), (3000, "http://once.good1.net/"), (4000, "http://q.net/")]
    labels = [(i, 0) for i in range(0, 400, 2)] + [(1000 + i, 1) for i in range(50)]
    labels += [(1000, 0), (3000, 1), (None, 1), (5, None), (77777, 1)]
    verdicts = {r.page_id: r.verdict for r in judge(spark, urls, labels).collect()}
    assert all(verdicts[i] == "allow" for i in range(400))
    assert all(verdicts[1000 + i] == "block" for i in range(60))
    assert verdicts[3000] == "allow" and verdicts[4000] == "allow"


def test_registered(spark):
    hosts = ["a.b.example.com", "example.com", "b.co.uk:80", "x.y.de", "de", ""]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = frame.select(*[c.alias(n) for n, c in zip("ds", H.registered(frame.host), strict=True)])
    assert [tuple(r) for r in got.collect()] == [
        ("b.example.com", "example.com"), ("example.com", "example.com"), ("b.co.uk", "co.uk"),
        ("y.de", "de"), ("de", "de"), ("", ""),
    ]


def test_edge_cases(spark):
    urls = [(1, "http://a.net/"), (1, "http://a.net/"), (None, "http://a.net/"),
            (2, "http://" + "a" * 100_000 + ".net/")]
    assert judge(spark, urls, [(1, 1), (1, 0), (1, 1)]).count() == 4
    assert judge(spark, [], [(1, 1)]).count() == 0


def test_main_path_runs_no_python(spark):
    plan = judge(spark, [(1, "http://a.net/")], [])._jdf.queryExecution().executedPlan().toString()
    # Local test rows come through an Arrow-free relation, so nothing Python may be left.
    assert "Python" not in plan and "Arrow" not in plan


def test_millions_of_bad_pages(spark):
    counts = spark.createDataFrame([(5_000_000, 4_500_000), (10_000_000_000, 7), (40, 3)], "n long, k long")
    (row,) = H._strength("host", counts).collect()
    assert H.STRENGTHS[0] <= row.strength <= H.STRENGTHS[1]
    units = counts.select(H._squares_in_units(counts.n, counts.k).cast("long").alias("u")).collect()
    assert [r.u for r in units] == [k * k * H.UNIT // n for n, k in
                                    [(5_000_000, 4_500_000), (10_000_000_000, 7), (40, 3)]]
