import random
from datetime import date, timedelta

from paperfield.llm.urlfilter import listed, validity

START = date(2024, 1, 1)
ENTRIES = "list string, pattern string, action string, day date"
CAPTURES = "capture_id long, url string, day date"


def day(n):
    return START + timedelta(n)


def entries(spark, rows):
    return spark.createDataFrame([(a, b, c, None if d is None else day(d)) for a, b, c, d in rows], ENTRIES).selectExpr("*", "'c' as was", "'c' as url")


def test_intervals(spark):
    rows = [("l", "A.example/", "add", 5), ("l", "a.example", "add", 7), ("l", "http://a.example", "remove", 9), ("l", "a.example", "remove", 9), ("l", "a.example", "ADD", 20), ("l", "b", "add", 3), ("l", "b", "remove", 3), ("m", "b", "remove", 1), ("m", "b", "add", 2)]
    rows += [(None, "a", "add", 1), ("l", None, "add", 1), ("l", " ", "add", 1), ("l", "a", "keep", 1), ("l", "a", None, 1), ("l", "a", "add", None)]
    got = sorted(tuple(r) for r in validity(entries(spark, rows)).collect())
    assert got == [("l", "a.example", day(5), day(9)), ("l", "a.example", day(20), None), ("m", "b", day(2), None)]


def test_captures_against_all_entries(spark):
    r = random.Random(1)
    names = ["example.com", "a.example.com", "b.a.example.com", "other.org", "a.example.com/x", "a.example.com/x/y", "com"]
    given = [(r.choice("lmn"), r.choice(names), r.choice(["add", "remove"]), r.randrange(60)) for _ in range(60)]
    urls = ["http://a.example.com/x/y/z?q#f", "https://B.a.example.com:8080/X", "http://u@other.org", "http://xexample.com/x", "ftp://a.example.com//x//y", "nothing", "", None]
    caps = [(i, r.choice(urls), None if i % 29 == 0 else day(r.randrange(70))) for i in range(300)] + [(None, urls[0], day(30))]
    intervals = [tuple(x) for x in validity(entries(spark, given)).collect()]

    def keys(url):
        if not url or "://" not in url:
            return set()
        host, _, path = url.split("://")[1].split("?")[0].split("#")[0].partition("/")
        host = host.split("@")[-1].split(":")[0].lower()
        labels, parts = host.split("."), [p for p in path.lower().split("/") if p]
        return {".".join(labels[i:]) for i in range(len(labels))} | {host + "/" + "/".join(parts[: i + 1]) for i in range(len(parts))}

    found = listed(spark.createDataFrame(caps, CAPTURES).selectExpr("*", "'c' as lists", "'c' as key"), entries(spark, given)).collect()
    assert len(found) == len(caps)
    got = {x.capture_id: (x.n_lists, x.lists, x.patterns, x.since) for x in found}
    for i, url, d in caps:
        hits = [v for v in intervals if d and v[1] in keys(url) and v[2] <= d and (v[3] is None or d < v[3])]
        lists = sorted({v[0] for v in hits})
        assert got[i] == (len(lists), lists, sorted({v[1] for v in hits}), min((v[2] for v in hits), default=None)), (i, url, d)


def test_empty_tables_and_repeated_rows(spark):
    none = entries(spark, [])
    some = entries(spark, [("l", "a.example", "add", 1)] * 3)
    caps = spark.createDataFrame([(1, "http://a.example/", day(5))] * 2 + [(2, "http://a.example/", day(0))], CAPTURES)
    assert sorted((r.capture_id, r.n_lists) for r in listed(caps, some).collect()) == [(1, 1), (2, 0)]
    assert {r.n_lists for r in listed(caps, none).collect()} == {0}
    assert listed(caps.limit(0), some).collect() == []
