from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerflow.llm.url_filter import evaluate_urls, url_host, validity_intervals

DAY = date(2024, 1, 1)
ENTRIES = "pattern string, category string, action string, day date"
CAPTURES = "page_id bigint, url string, fetch_day date"


def day(n):
    return DAY + timedelta(days=n)


def test_intervals(spark):
    rows = [("a.org", "x", "add", day(1)), ("A.org", "x", "remove", day(5)), ("a.org", "x", "add", day(9)),
            ("b.org", "x", "add", day(2)), ("b.org", "x", "add", day(2)), ("b.org", "y", "remove", day(2)),
            ("c.org", "x", "remove", day(3)), (None, "x", "add", day(1)), ("d.org", "x", None, day(1)),
            ("d.org", "x", "add", None)]
    got = sorted(map(tuple, validity_intervals(spark.createDataFrame(rows, ENTRIES)).collect()),
                 key=lambda r: (r[0], r[2]))
    assert got == [("a.org", "x", day(1), day(5)), ("a.org", "x", day(9), None)]


def brute(captures, entries):
    out = []
    for page, url, when in captures:
        active = []
        rest = url.split("://", 1)[1] if url and "://" in url else ""
        host = rest.split("/", 1)[0].lower()
        path = [p for p in ("/" + rest.split("/", 1)[1]).split("/") if p] if "/" in rest else []
        labels = host.split(".")
        keys = {".".join(labels[i:]) for i in range(len(labels))} | {
            "/".join([host] + path[:n]) for n in range(1, min(3, len(path)) + 1)} if host else set()
        for pattern in {p for p, _, _, _ in entries}:
            past = [(d, a != "add", a, c) for p, c, a, d in entries if p == pattern and when and d <= when]
            if pattern in keys and past:
                last = max(past)
                if last[2] == "add":
                    active.append((-len(pattern), pattern, last[3], last[0]))
        best = min(active, default=(0, None, None, None))
        out.append((page, bool(active), len(active), best[1], best[2], best[3]))
    return sorted(out, key=str)


def test_as_of_join_matches_brute_force(spark):
    patterns = ["example.org", "a.example.org", "a.example.org/news", "a.example.org/news/2024", "b.net", "net"]
    entries = [(p, f"c{k}", "add" if (k + n) % 3 else "remove", day(10 * n + k)) for k, p in enumerate(patterns)
               for n in range(4)]
    urls = ["http://a.example.org/news/2024/x", "https://A.EXAMPLE.org/other", "http://example.org", "http://x.b.net/",
            "http://notexample.org/", None, "no url", "http://b.net/news"]
    captures = [(i, urls[i % len(urls)], day(i % 45)) for i in range(180)] + [(900, urls[0], None), (None, urls[0], day(30)),
                                                                            (3, urls[3], day(3))]
    df = spark.createDataFrame(captures, CAPTURES).withColumns({"host": F.lit(1), "key": F.lit(2), "pattern": F.lit("z")})
    got = evaluate_urls(df, spark.createDataFrame(entries, ENTRIES)).collect()
    assert sorted(((r.page_id, r.blocked, r.n_active, r.pattern, r.category, r.listed_since) for r in got),
                  key=str) == brute(captures, entries)


def test_empty_tables(spark):
    captures = spark.createDataFrame([(1, "http://a.org/", DAY)], CAPTURES)
    entries = spark.createDataFrame([("a.org", "x", "add", DAY)], ENTRIES)
    assert evaluate_urls(captures, entries.filter("false")).first().blocked is False
    assert evaluate_urls(captures, entries).first().blocked is True
    assert evaluate_urls(captures.filter("false"), entries).count() == 0


def test_hosts(spark):
    urls = ["http://user:pw@Host.ORG:8080/x", "https://h.org.", "ftp://h.org?q", "//h.org/", "h.org", "", None,
            "http:///x", "http://" + "a." * 60 + "org/" + "p/" * 5000]
    df = spark.createDataFrame([(u,) for u in urls], "u string")
    assert [r[0] for r in df.select(url_host(F.col("u"))).collect()] == [
        "host.org", "h.org", "h.org", None, None, None, None, None, "a." * 60 + "org"]


def test_entries_of_many_segments(spark):
    deep = "a.org/" + "/".join(f"s{k}" for k in range(9))
    captures = spark.createDataFrame([(1, f"http://{deep}/page", DAY), (2, "http://a.org/s0/s1/s2/s3", DAY),
                                      (3, "http://a.org/s0/s1/s2", DAY)], CAPTURES)
    entries = spark.createDataFrame([(p, "x", "add", DAY) for p in (deep, "a.org/s0/s1/s2/s3")], ENTRIES)
    got = {r.page_id: (r.n_active, r.pattern) for r in evaluate_urls(captures, entries).collect()}
    assert got == {1: (2, deep), 2: (1, "a.org/s0/s1/s2/s3"), 3: (0, None)}
