"""As-of evaluation against plain Python; the whole table is compared with SQL elsewhere."""

import random
from datetime import date, timedelta

from pyspark.sql import functions as F

from ledgerspark.llm import url_lists

ENTRY = "list string, domain string, action string, listed_on date"


def brute(captures, entries):
    out = []
    for page, url, day in captures:
        host = None
        if url and "://" in url:
            host = url.lower().split("://", 1)[1].split("/")[0].split("?")[0].split("#")[0].split("@")[-1].split(":")[0].rstrip(".") or None
        labels = (host or "").split(".")
        names = [".".join(labels[i:]) for i in range(max(len(labels) - 1, 1))]
        active = []
        for key in {(e[0], (e[1] or "").lower()) for e in entries if all(e) and e[2] in ("add", "remove")}:
            past = [(e[3], e[2] == "add") for e in entries if all(e) and (e[0], e[1].lower()) == key and e[2] in ("add", "remove") and day and e[3] <= day]
            if past and max(past)[1] and host and key[1] in names:
                active.append((-len(key[1]), key[0], key[1], max(past)[0]))
        best = min(active, default=(None,) * 4)
        out.append((page, url, host, day, bool(active), len(active), best[2], best[1], best[3]))
    return sorted(out, key=str)


def check(spark, captures, entries):
    got = url_lists.evaluated(spark.createDataFrame(captures, "page_id long, url string, fetched_on date").selectExpr("*", "1 AS host", "2 AS month"), spark.createDataFrame(entries, ENTRY))
    assert sorted(map(tuple, got.collect()), key=str) == brute(captures, entries)


def test_random_lists(spark):
    rng = random.Random(8)
    start = date(2023, 11, 1)
    names = ["example.com", "a.example.com", "b.a.example.com", "other.org", "localhost", "Example.COM"]
    day = lambda: start + timedelta(rng.randrange(500))
    entries = [(rng.choice("xy"), rng.choice(names), rng.choice(["add", "remove"]), day()) for _ in range(60)]
    captures = [(i, f"https://{rng.choice(names)}/p?q", day()) for i in range(300)]
    check(spark, captures, entries)


def test_odd_rows(spark):
    d = date(2024, 2, 29)
    entries = [("x", "e.com", "add", d), ("x", "e.com", "add", d), ("x", "e.com", "remove", d), (None, "e.com", "add", d), ("x", None, "add", d), ("x", "e.com", None, d), ("x", "e.com", "drop", d), ("x", "e.com", "remove", None)]
    urls = [None, "", "e.com", "http://", "http://e.com", "HTTP://user:pw@E.com.:80/x@y", "http://e.com#f", "http://n.e.com?x", "http://" + "a." * 500 + "e.com/"]
    captures = [(i, u, x) for i, u in enumerate(urls) for x in (None, d - timedelta(1), d, d + timedelta(400))] * 2 + [(None, "http://e.com", d)]
    check(spark, captures, entries)
    check(spark, captures, [])
    check(spark, [], entries)


def test_addresses_are_hosts_of_their_own(spark):
    urls = ["http://1.2.3.4/a", "http://9.8.3.4:80/", "http://[::1]:8080/x", "https://u:p@[2001:DB8::7]/", "http://a.3.4/", "http://[bad/"]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [tuple(r) for r in df.select(url_lists.host(df.url).alias("h")).select("h", url_lists.domains(F.col("h"))).collect()]
    assert got == [
        ("1.2.3.4", ["1.2.3.4"]),
        ("9.8.3.4", ["9.8.3.4"]),
        ("[::1]", ["[::1]"]),
        ("[2001:db8::7]", ["[2001:db8::7]"]),
        ("a.3.4", ["a.3.4", "3.4"]),
        (None, [None]),
    ]
