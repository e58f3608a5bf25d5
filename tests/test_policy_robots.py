import fnmatch
import random
from urllib.parse import quote
from urllib.robotparser import RobotFileParser

from pyspark.sql import functions as F

from paperfield.operators import policy, robots


def test_policy_examples(spark):
    rules = policy.HostRules(allowed=("*.gov", "*.state.*.us"), denied=("*.facebook.com",), extra=("www.fldoe.org",))
    cases = [
        ("tea.texas.gov", True), ("texas.gov", True), ("facebook.com", False), ("example.com", False),
        ("www.sos.state.tx.us", True), ("www.fldoe.org", True), ("x.www.fldoe.org", True), ("fldoe.org", False),
        ("", False), ("m.facebook.com", False),
    ]
    got = spark.createDataFrame(cases, "host string, e boolean").withColumn("v", rules.verdict(F.col("host"))).collect()
    assert all(r.v == r.e for r in got)


def test_patterns_match_fnmatch(spark):
    rng = random.Random(1)
    pats = ["*.gov", "a*.gov", "*.state.*.us", "x?.gov*", "[ab].*", "[!ab].*", "plain.gov", "*.b[cd].org", "a.*[", "q?"]
    hosts = [".".join(rng.choice(["a", "b", "c", "gov", "us", "state", "xy", "plain", "bc", "org", "q?"]) for _ in range(rng.randint(1, 4))) for _ in range(300)]

    def expected(host, pat):
        if "*" in pat:
            return fnmatch.fnmatchcase(host, pat) or (pat[:2] == "*." and host.endswith(pat[1:]))
        return host == pat or host.endswith("." + pat)

    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    got = frame.select("host", *[policy.matches_any(F.col("host"), [p]).alias(f"p{i}") for i, p in enumerate(pats)]).collect()
    assert all(row[f"p{i}"] == expected(row.host, p) for row in got for i, p in enumerate(pats))


def test_pattern_table_agrees_with_folded_rules(spark):
    rules = policy.HostRules(allowed=("*.gov", "*.state.*.us", "ok.org"), denied=("*.bad.gov", "worse.gov"), extra=("more.net",))
    hosts = ["a.gov", "gov", "x.bad.gov", "bad.gov", "worse.gov", "a.worse.gov", "q.state.tx.us", "ok.org", "b.ok.org", "more.net", "z.more.net", "no.com"]
    table = [("allow", p) for p in rules.allowed] + [("deny", p) for p in rules.denied] + [("extra", p) for p in rules.extra]
    frame = spark.createDataFrame([(h,) for h in hosts], "host string")
    by_table = {r.host: r.allowed for r in policy.classify_hosts(frame, spark.createDataFrame(table, "kind string, pattern string")).collect()}
    folded = {r.host: r.v for r in frame.withColumn("v", rules.verdict(F.col("host"))).collect()}
    assert by_table == folded


def test_extra_hosts_from_table(spark):
    rules = policy.HostRules(allowed=("*.gov",), denied=("*.x.com",))
    urls = spark.createDataFrame([("https://a.org/1",), ("https://s.a.org/2",), ("https://b.org",), ("https://c.gov",), ("https://q.x.com",)], "url string")
    extra = spark.createDataFrame([("a.org",), ("x.com",)], "host string")
    got = {r.url: r.allowed for r in policy.with_verdict(urls, "url", rules, extra).collect()}
    assert got == {"https://a.org/1": True, "https://s.a.org/2": True, "https://b.org": False, "https://c.gov": True, "https://q.x.com": False}


BODIES = [
    "User-agent: *\nDisallow: /",
    "",
    "Disallow: /x\nUser-agent: *\nDisallow: /a\nAllow: /a/b\n",
    "User-agent: paper\nUser-agent: other\nAllow: /a\nDisallow: /\n\nUser-agent: *\nDisallow: /",
    "User-agent: *\n\nDisallow: /a\n",
    "User-agent: *\n \nDisallow: /a # note\n# c\nAllow: /\n",
    "User-agent: *\nCrawl-delay: 3\nUser-agent: paperfield\nDisallow: /a?x=1\nDisallow:\n",
    "USER-AGENT : PAPERFIELD\r\ndisallow : /%61b\r\nDisallow: /é\r\n\r\nUser-agent: *\r\nAllow: /",
    "User-agent: *\nDisallow: *\nDisallow: /a*\n\nUser-agent: *\nDisallow: /",
    "User-agent:\nDisallow: /b;\nDisallow: /c;p#f\nSitemap: http://x\nDisallow: /d?\n",
    "nonsense\nUser-agent: *\nrequest-rate: 1/2\nFoo: bar\nDisallow: /a/b\n",
]
URLS = ["/", "", "/a", "/a/b", "/a/b/c", "/ab", "/%61b/x", "/a?x=1&y", "/é/1", "/%C3%A9", "/b;", "/b;q", "/c;p", "/c;p#f", "/d", "/d?z", "/x", "/a*", "/%2A"]


def test_robots_matches_standard_library(spark):
    table = spark.createDataFrame([(f"h{i}.gov", b) for i, b in enumerate(BODIES)], "domain string, body string")
    urls = [f"https://h{i}.gov{u}" for i in range(len(BODIES)) for u in URLS] + ["https://unknown.gov/a", "nohost"]
    frame = spark.createDataFrame([(u,) for u in urls], "url string").repartition(4)
    verdicts = robots.with_robots_verdict(frame, "url", robots.host_rules(table, "Paperfield/1.0 (+x)"))
    got = {r.url: r.robots_allowed for r in verdicts.collect()}

    def expected(url):
        if url == "nohost":
            return False
        parser = RobotFileParser()
        host = url.split("/")[2]
        parser.parse((BODIES[int(host[1:-4])] if host != "unknown.gov" else "").splitlines())
        return parser.can_fetch("Paperfield/1.0 (+x)", url)

    assert [(u, got[u]) for u in urls if got[u] != expected(u)] == []


def test_rule_table(spark, rows):
    table = spark.createDataFrame([("h.gov", "User-agent: a\nUser-agent: *\nDisallow: /x y\nAllow: /z\n")], "domain string, body string")
    assert rows(robots.rule_table(table), "group_no", "agents", "rule_no", "allow", "path") == [
        (1, ["a", "*"], 1, False, quote("/x y")),
        (1, ["a", "*"], 2, True, "/z"),
    ]


def test_cache_fill_and_replace(spark, rows):
    answers = spark.createDataFrame(
        [
            ("https://a.gov/robots.txt", 200, {"Content-Type": "text/plain"}, bytearray(b"User-agent: *\nDisallow: /"), 1),
            ("https://b.gov/robots.txt", 403, {}, bytearray(b"User-agent: *\nDisallow: /"), 1),
            ("https://a.gov/page", 200, {}, bytearray(b"x"), 2),
        ],
        "request_url string, status int, headers map<string,string>, body binary, t int",
    ).withColumn("fetched_at", F.timestamp_seconds("t")).drop("t")
    hosts = spark.createDataFrame([("a.gov",), ("b.gov",), ("c.gov",)], "host string")
    filled = robots.fill_cache(hosts, answers)
    assert rows(filled, "domain", "body", "status") == [("a.gov", "User-agent: *\nDisallow: /", 200), ("b.gov", "", 403), ("c.gov", "", 0)]
    assert rows(robots.fill_cache(hosts, answers, filled), "domain") == rows(filled, "domain")
    fresh = filled.filter("domain = 'a.gov'").withColumn("body", F.lit("")).withColumn("fetched_at", F.timestamp_seconds(F.lit(9)))
    assert rows(robots.replace_cache(filled, fresh).filter("domain = 'a.gov'"), "body") == [("",)]


def test_extra_hosts_may_be_urls(spark):
    rules = policy.HostRules(allowed=("none.invalid",), extra=("https://WWW.fldoe.org/x", " b.org. "))
    hosts = spark.createDataFrame([("https://www.fldoe.org/a",), ("https://c.b.org/",), ("https://fldoe.org/",)], "url string")
    assert {r.url: r.allowed for r in policy.with_verdict(hosts, "url", rules).collect()} == {"https://www.fldoe.org/a": True, "https://c.b.org/": True, "https://fldoe.org/": False}


def test_wildcard_patterns_without_literal_ends(spark):
    kinds = [("allow", "*.example.o?g"), ("allow", "w*w"), ("deny", "*.state.*.us"), ("allow", "*.us"), ("allow", "[ab].x*.org")]
    names = ["a.example.org", "a.example.com", "www", "x.state.tx.us", "y.tx.us", "a.xyz.org", "c.xyz.org", "b.example.o.g"]
    hosts = spark.createDataFrame([(n,) for n in names], "host string")
    found = policy.classify_hosts(hosts, spark.createDataFrame(kinds, "kind string, pattern string"))
    rules = policy.HostRules(allowed=tuple(p for k, p in kinds if k == "allow"), denied=("*.state.*.us",))
    want = {r.host: r.v for r in hosts.select("host", rules.verdict(F.col("host")).alias("v")).collect()}
    assert {r.host: r.allowed for r in found.collect()} == want
    assert [n for n in names if want[n]] == ["a.example.org", "www", "y.tx.us", "a.xyz.org", "b.example.o.g"]
