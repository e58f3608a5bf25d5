"""URL expressions against fixed examples and against the Python standard library."""

import random
from pathlib import PurePosixPath
from urllib.parse import parse_qsl, unquote, urlencode, urljoin, urlparse

import pytest
from pyspark.sql import functions as F

from paperfield.functions import urls

EXAMPLES = [
    ("https://example.gov:443/a/b/#frag", "https://example.gov/a/b"),
    ("https://example.gov/getfile?id=9&utm_source=x", "https://example.gov/getfile?id=9"),
    ("https://example.gov/docs/", "https://example.gov/docs"),
    ("http://a.gov//", "http://a.gov"),
    ("http://a.gov/", "http://a.gov/"),
    ("http://a.gov", "http://a.gov/"),
    ("//a.gov/x", "https://a.gov/x"),
    ("a.gov/x", ""),
    ("mailto:x@a.gov", ""),
    ("javascript:void(0)", ""),
    ("localhost:80/x", ""),
    ("  HTTP://User:pw@A.GOV.:8080/X%7e/;p?b&&c=a b/c&UTM_Medium=1#z ", "http://a.gov:8080/X%7e?b=&c=a+b%2Fc"),
    ("http://a.gov:x/", None),
    ("http://a.gov:70000/", None),
    ("http://[::1]/", None),
    (None, ""),
    ("   ", ""),
    ("http://a.gov/?a=%zz&b=100%", "http://a.gov/?a=%25zz&b=100%25"),
    ("http://a.gov/?a=1%26b%3D2=3&*~=%01%02%03", "http://a.gov/?a=1%26b%3D2%3D3&%2A~=%01%02%03".replace("3&", "3&")),
    ("http://a.gov/?=", "http://a.gov/?="),
]


def evaluate(spark, values, expression, *more):
    frame = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, a string, b string").repartition(8)
    return [r.out for r in frame.select("i", expression.alias("out")).orderBy("i").collect()]


def expected_canonical(url):
    parts = urlparse(url.strip())
    if (parts.scheme or "https") not in ("http", "https"):
        return ""
    host = (parts.hostname or "").rstrip(".")
    if not host:
        return ""
    try:
        port = parts.port
    except ValueError:
        return None
    standard = {"http": 80}.get(parts.scheme, 443)
    authority = f"{host}:{port}" if port and port != standard else host
    path = "/" if parts.path in ("", "/") else parts.path.rstrip("/")
    kept = [kv for kv in parse_qsl(parts.query, keep_blank_values=True) if kv[0].lower() not in urls.TRACKING_KEYS]
    return f"{parts.scheme or 'https'}://{authority}{path}" + (f"?{urlencode(kept)}" if kept else "")


def random_urls(n, seed=5):
    rng = random.Random(seed)
    hosts = ["a.gov", "WWW.b.gov.", "u:p@c.gov", "d.gov:80", "d.gov:443", "e.gov:08080", "e.gov:0", "", "f.gov:", "ü.gov"]
    bits = ["a", "B", "%7E", "..", ".", "", "x;y", "é", "a b", "%2f", "*", "+", "~", "r.pdf", "%zz"]
    keys = ["a", "utm_source", "UTM_id", "b c", "é", "", "_ga", "x%26", "p%3d", "utm%5Fterm", "q"]
    vals = ["", "1", "a=b", "a%3Db", "+", "%20", "%E9", "é", "*~", "a/b", "50%", ";", "%01", "\x02", "%03a"]
    out = []
    for _ in range(n):
        url = rng.choice(["http:", "https:", "HTTPS:", "", "ftp:"]) + "//" + rng.choice(hosts)
        url += "".join("/" + rng.choice(bits) for _ in range(rng.randint(0, 5)))
        if rng.random() < 0.7:
            pairs = [
                rng.choice(keys) + ("=" + rng.choice(vals) if rng.random() < 0.8 else "") for _ in range(rng.randint(0, 5))
            ]
            url += "?" + "&".join(pairs)
        if rng.random() < 0.3:
            url += "#" + rng.choice(["x", "a/b?c", ""])
        out.append(url)
    return out


def test_canonical_examples(spark):
    got = evaluate(spark, [(u, None) for u, _ in EXAMPLES], urls.canonical_url(F.col("a")))
    assert got == [e for _, e in EXAMPLES]


def test_canonical_matches_standard_library(spark):
    cases = random_urls(4000)
    got = evaluate(spark, [(u, None) for u in cases], urls.canonical_url(F.col("a")))
    bad = [(u, g, expected_canonical(u)) for u, g in zip(cases, got) if g != expected_canonical(u)]
    assert bad == []


def test_canonical_of_canonical_matches_standard_library(spark):
    cases = random_urls(1500, seed=9)
    once = evaluate(spark, [(u, None) for u in cases], urls.canonical_url(F.col("a")))
    twice = evaluate(spark, [(u, None) for u in once], urls.canonical_url(F.col("a")))
    # "http://h//;p" style paths may lose one more slash run, as in the standard library
    again = [expected_canonical(u) if u else u for u in once]
    assert [t if o is not None else None for o, t in zip(once, twice)] == again


def random_refs(n, seed=3):
    rng = random.Random(seed)
    bits = ["a", "b", "..", ".", "", "c;d", "e.pdf", "é"]
    bases = ["https://h.gov", "https://h.gov/", "https://h.gov/a/b", "https://h.gov/a/b/", "http://h.gov/a/b;p?q=1", "https://h.gov/a//b/c?x#y"]
    out = []
    for _ in range(n):
        ref = rng.choice(["", "", "/", "//k.gov/", "http://k.gov/", "https:", "https://k.gov"])
        ref += "/".join(rng.choice(bits) for _ in range(rng.randint(0, 6)))
        ref += rng.choice(["", "", "?q", "?a=b&c", "?"]) + rng.choice(["", "", "#f", "#"])
        out.append((rng.choice(bases), ref))
    return out


def joined(case):
    return expected_canonical(urljoin(*case)) if case[1] else ""


def test_resolution_matches_standard_library(spark):
    cases = random_refs(4000)
    got = evaluate(spark, cases, urls.canonical_link(F.col("b"), F.col("a")))
    bad = [(c, g, joined(c)) for c, g in zip(cases, got) if g != joined(c)]
    assert bad == []
    plain = [c for c in cases if urlparse(c[1]).scheme == "" and not c[1].startswith("//")]
    assert evaluate(spark, plain, urls.resolve_url(F.col("a"), F.col("b"))) == [urljoin(*c) for c in plain]


def test_relative_join_and_domain(spark):
    assert evaluate(spark, [("https://dot.texas.gov/a", "/x.pdf")], urls.canonical_link(F.col("b"), F.col("a"))) == ["https://dot.texas.gov/x.pdf"]
    assert evaluate(spark, [("https://WWW.TXDOT.GOV/a", None), ("nope", None)], urls.domain_of(F.col("a"))) == ["www.txdot.gov", ""]


def test_host_helpers(spark):
    cases = [(" A.Gov. ", None), ("https://x.gov:99/y", None), (None, None)]
    assert evaluate(spark, cases, urls.policy_host(F.col("a"))) == ["a.gov", "x.gov", ""]
    assert evaluate(spark, [("a.b.c", None)], urls.host_suffixes(F.col("a"))) == [["a.b.c", "b.c", "c"]]


@pytest.mark.parametrize(
    "href,target",
    [
        ("https://r.search.yahoo.com/x?RU=https%3A%2F%2Ftea.texas.gov%2Fx.pdf", "https://tea.texas.gov/x.pdf"),
        ("https://r.search.yahoo.com/_y/RU=https%3a%2f%2fa.gov%2fb%20c/RK=2/RS=z", "https://a.gov/b c"),
        ("https://r/?u=&url=https%253A%252F%252Fa.gov", "https://a.gov"),
        ("https://r/?u=a+b", "a b"),
        ("https://plain.gov/x", "https://plain.gov/x"),
        ("", ""),
        (None, ""),
    ],
)
def test_unwrap(spark, href, target):
    assert evaluate(spark, [(href, None)], urls.unwrap_result_url(F.col("a"))) == [target]


def test_file_names(spark):
    cases = ["https://a.gov/x/My%20File+1%2Fz.pdf?q", "https://a.gov/", "https://a.gov/getfile", "https://a.gov/a/.", "https://a.gov/é%3F*.PDF", "https://a.gov/" + "n" * 300 + ".pdf"]

    def expected(url):
        name = PurePosixPath(unquote(urlparse(url).path)).name
        if not name:
            return "document.pdf"
        name = name if "." in name else name + ".pdf"
        return "".join(c if c.isalnum() or c in "._- " else "_" for c in name)[:180]

    got = evaluate(spark, [(u, None) for u in cases], urls.filename_from_url(F.col("a")))
    assert got == [expected(u) for u in cases]


def test_collision_and_paths(spark):
    cases = [("/r/a.pdf", None), ("/r/noext", None), ("/r.d/.hidden", None), ("a.tar.gz", None)]
    got = evaluate(spark, cases, urls.collision_name(F.col("a"), F.lit(2)))
    assert got == ["/r/a__2.pdf", "/r/noext__2.pdf", "/r.d/.hidden__2.pdf", "a.tar__2.gz"]
    assert evaluate(spark, [("abcdef", None)], urls.content_path("root", F.col("a"))) == ["root/ab/cd/abcdef.pdf"]
    named = urls.named_path("root", F.col("a"), F.col("b"), F.lit("https://a.gov/z"))
    assert evaluate(spark, [("New York", None), ("", "f.pdf")], named) == ["root/New_York/z.pdf", "root/unknown/f.pdf"]


def test_result_page_url(spark):
    got = evaluate(spark, [('site:a.gov "annual report"', None)], urls.result_page_url(F.col("a"), F.lit(3)))
    assert got == ["https://search.yahoo.com/search?p=site%3Aa.gov+%22annual+report%22&b=21&pz=10"]
