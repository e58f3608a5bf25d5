"""robots.txt rules: parsing, one rule list per host, first-match verdicts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.functions.content import decode_body
from paperfield.functions.urls import domain_of, path_encode, percent_decode, tidy
from paperfield.operators.skew import first_per_key, lookup

DEFAULT_AGENT = "paperfield/1.0"

_LINE_BREAK = r"\r\n|[\n\r\x0b\f\x1c\x1d\x1e\u0085\u2028\u2029]"
# One letter per line kind: agent, allow, disallow, other rule, blank.
_KINDS = {"user-agent": "U", "allow": "A", "disallow": "D", "crawl-delay": "R", "request-rate": "R"}


def _drop_origin(url: Column) -> Column:
    """Path, parameters, query and fragment of a URL; empty delimiters vanish."""
    text = F.regexp_replace(tidy(url), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?", "")
    return _drop_empty_delimiters(text)


def _drop_empty_delimiters(text: Column) -> Column:
    text = F.regexp_replace(text, r"(?s)^([^#]*)#$", "$1")
    text = F.regexp_replace(text, r"(?s)^([^?#]*)\?(?=#|$)", "$1")
    return F.regexp_replace(text, r"(?s)^((?:[^?#]*/)?[^?#/;]*);(?=[?#]|$)", "$1")


def _line(raw: Column) -> Column:
    """'<kind><value>' of one line, 'B' for a blank one, NULL for lines without meaning."""
    text = F.trim(F.regexp_replace(raw, r"(?s)#.*", ""))
    field = F.lower(F.trim(F.substring_index(text, ":", 1)))
    value = percent_decode(F.regexp_replace(F.regexp_replace(text, r"(?s)^[^:]*:", ""), r"(?U)\A\s+|\s+\z", ""))
    kind = F.lit(None).cast("string")
    for name, letter in _KINDS.items():
        kind = F.when(field == name, letter).otherwise(kind)
    value = F.regexp_replace(value, "\n", "%0A")
    return F.when(raw == "", "B").when(F.contains(text, F.lit(":")), F.concat(kind, value))


def _groups(body: Column) -> Column:
    """array<struct<agents, rules>> in file order.

    A group is a run of agent lines followed by a run of rule lines; rules without agents, and
    agents cut off by a blank line, fall between the matches.
    """
    lines = F.filter(F.transform(F.split(F.coalesce(body, F.lit("")), _LINE_BREAK), _line), lambda x: x.isNotNull())
    text = F.concat(F.array_join(lines, "\n"), F.lit("\n"))
    runs = F.regexp_extract_all(text, F.lit(r"(?:U[^\n]*\n)+(?:[ADR][^\n]*\n)+"), F.lit(0))

    def group(run: Column) -> Column:
        entries = F.split(F.regexp_replace(run, r"\n$", ""), "\n")
        agents = F.transform(F.filter(entries, lambda e: e.startswith("U")), lambda e: F.substring(e, 2, 1 << 30))
        rules = F.transform(
            F.filter(entries, lambda e: e.startswith("A") | e.startswith("D")),
            lambda e, i: F.struct(
                (i + 1).alias("rule_no"),
                (e.startswith("A") | (e == "D")).alias("allow"),
                path_encode(_drop_empty_delimiters(F.substring(e, 2, 1 << 30))).alias("path"),
            ),
        )
        return F.struct(agents.alias("agents"), rules.alias("rules"))

    return F.transform(runs, group)


def rule_table(robots: DataFrame) -> DataFrame:
    """All rules, one per row: (domain, group_no, agents, rule_no, allow, path)."""
    grouped = robots.select("domain", F.posexplode(_groups(F.col("body"))).alias("_no", "_group"))
    return grouped.select(
        "domain", (F.col("_no") + 1).alias("group_no"), F.col("_group.agents").alias("agents"), F.inline("_group.rules")
    )


def host_rules(robots: DataFrame, agent: str = DEFAULT_AGENT) -> DataFrame:
    """The rules that bind ``agent``, one row per host: (host, rules).

    The first group naming a substring of the product token is used alone; the first group that
    names ``*`` is the fallback.  All of it happens within the row of the host.
    """
    token = agent.split("/")[0].lower()

    def star(group: Column) -> Column:
        return F.array_contains(group["agents"], "*")

    def ours(group: Column) -> Column:
        return ~star(group) & F.exists(group["agents"], lambda a: F.contains(F.lit(token), F.lower(a)))

    grouped = robots.select("domain", _groups(F.col("body")).alias("_groups"))
    chosen = F.coalesce(
        F.try_element_at(F.filter("_groups", ours), F.lit(1)), F.try_element_at(F.filter("_groups", star), F.lit(1))
    )
    return grouped.select(F.lower("domain").alias("host"), chosen["rules"].alias("rules"))


def match_path(url: Column) -> Column:
    """The form of a URL that rule paths are compared with."""
    path = _drop_origin(percent_decode(url))
    path = F.when(path.startswith("//"), F.concat(F.lit("//"), path)).otherwise(path)
    encoded = path_encode(path)
    return F.when(encoded == "", "/").otherwise(encoded)


def with_robots_verdict(df: DataFrame, url: str, rules: DataFrame, out: str = "robots_allowed") -> DataFrame:
    """Whether the first matching rule of the host lets us fetch ``url``; no rule means yes."""
    prepared = df.withColumn("host", domain_of(F.col(url))).withColumn("_path", match_path(F.col(url)))
    joined = lookup(prepared, rules, "host")
    first = F.try_element_at(F.filter("rules", lambda r: F.col("_path").startswith(r["path"])), F.lit(1))
    verdict = (F.col("host") != "") & F.coalesce(first["allow"], F.lit(True))
    return joined.withColumn(out, verdict).select(*df.columns, out)


def fill_cache(hosts: DataFrame, responses: DataFrame, cache: DataFrame | None = None) -> DataFrame:
    """robots table (domain, body, status, fetched_at) with one row per wanted host.

    The body counts only with status 200; hosts without an answer get an empty body, which allows
    everything.  Hosts already cached keep their row.
    """
    answers = responses.filter(F.lower("request_url").rlike(r"^https?://[^/]+/robots\.txt$")).select(
        domain_of(F.col("request_url")).alias("domain"),
        F.when(F.col("status") == 200, decode_body(F.col("body"), F.col("headers")["Content-Type"])).otherwise("").alias("body"),
        "status",
        "fetched_at",
    )
    newest = first_per_key(answers, ["domain"], [F.desc("fetched_at"), F.desc("status")])
    wanted = hosts.select(F.col("host").alias("domain")).distinct()
    if cache is not None:
        wanted = wanted.join(cache.select("domain"), "domain", "left_anti")
    filled = wanted.join(newest, "domain", "left").select(
        "domain", F.coalesce("body", F.lit("")).alias("body"), F.coalesce("status", F.lit(0)).alias("status"), "fetched_at"
    )
    return filled if cache is None else cache.select(filled.columns).unionByName(filled)


def replace_cache(cache: DataFrame, fresh: DataFrame) -> DataFrame:
    """Newest row per host wins."""
    both = cache.withColumn("_new", F.lit(0)).unionByName(fresh.select(cache.columns).withColumn("_new", F.lit(1)))
    return first_per_key(both, ["domain"], [F.desc_nulls_last("fetched_at"), F.desc("_new")]).drop("_new")
