"""Which hosts may be visited: deny, extra and allow patterns."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass
from urllib.parse import urlsplit

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from paperfield.functions.urls import domain_of, host_suffixes, policy_host
from paperfield.operators.skew import lookup

# --- fixed values -----------------------------------------------------------------------------
FALLBACK_ALLOWED = ("*.gov",)
DEFAULT_ALLOWED = ("*.gov", "*.state.*.us", "*.us.gov")
DEFAULT_DENIED = (
    "*.facebook.com",
    "*.twitter.com",
    "*.x.com",
    "*.youtube.com",
    "*.instagram.com",
    "*.linkedin.com",
    "*.tiktok.com",
    "*.doubleclick.net",
    "*.google-analytics.com",
)
# ----------------------------------------------------------------------------------------------


@dataclass(frozen=True)
class HostRules:
    """Pattern lists; an empty allow list means the fallback."""

    allowed: tuple[str, ...] = DEFAULT_ALLOWED
    denied: tuple[str, ...] = DEFAULT_DENIED
    extra: tuple[str, ...] = ()

    def verdict(self, host: Column, is_extra: Column | None = None) -> Column:
        """Deny wins, then extra hosts with their subdomains, then the allow list."""
        extra = matches_any(host, [p for p in map(_literal_host, self.extra) if p])
        if is_extra is not None:
            extra = extra | F.coalesce(is_extra, F.lit(False))
        allowed = matches_any(host, self.allowed or FALLBACK_ALLOWED)
        return (host != "") & ~matches_any(host, self.denied) & (extra | allowed)


def _literal_host(value: str) -> str:
    """Host of an extra entry, which may be a URL."""
    text = value.strip().lower()
    return ((urlsplit(text).hostname or "") if "://" in text else text).rstrip(".")


def _glob(pattern: str) -> str:
    """Shell glob as a regular expression; '*' crosses dots."""
    out, i = "", 0
    while i < len(pattern):
        char = pattern[i]
        close = pattern.find("]", i + 2 + (pattern[i + 1 : i + 2] == "!")) if char == "[" else -1
        if char == "*":
            out += ".*"
        elif char == "?":
            out += "."
        elif close > 0:
            members = pattern[i + 1 : close].replace("\\", "\\\\").replace("[", "\\[").replace("&&", "&\\&")
            out += "[" + ("^" + members[1:] if members.startswith("!") else members.replace("^", "\\^")) + "]"
            i = close
        else:
            out += re.escape(char)
        i += 1
    return out


def pattern_regex(pattern: str) -> str:
    """Regular expression of one host pattern, to be matched against the whole host."""
    text = pattern.strip().lower()
    if text.startswith("*."):
        return f".*{re.escape(text[1:])}|{_glob(text)}"
    if "*" in text:
        return _glob(text)
    return rf"(?:.*\.)?{re.escape(text)}"


def matches_any(host: Column, patterns: Sequence[str]) -> Column:
    """One alternation over all patterns, so a host is scanned once."""
    if not patterns:
        return F.lit(False)
    return host.rlike(rf"(?s)\A(?:{'|'.join(pattern_regex(p) for p in patterns)})\z")


def agency_hosts(agencies: DataFrame) -> DataFrame:
    """Distinct hosts of the agencies, active or not."""
    return agencies.select(policy_host(F.col("domain")).alias("host")).filter(F.col("host") != "").distinct()


def hosts_below(hosts: DataFrame, parents: DataFrame) -> DataFrame:
    """The hosts that equal one of ``parents`` or lie below it, by an equi join on label suffixes.

    A top-level label is a suffix of a large share of all hosts, so Spark splits it.
    """
    suffixes = hosts.select("host", F.explode(host_suffixes(F.col("host"))).alias("_suffix"))
    wanted = parents.select(F.col("host").alias("_suffix")).distinct()
    return lookup(suffixes, wanted, "_suffix", "left_semi").select("host").distinct()


def with_verdict(
    df: DataFrame, url: str, rules: HostRules, extra_hosts: DataFrame | None = None, out: str = "allowed"
) -> DataFrame:
    """Add the policy verdict on the host of column ``url``.

    The pattern lists are folded into one expression.  A table of extra hosts is matched on the
    distinct hosts only and looked up again.
    """
    if extra_hosts is None:
        return df.withColumn(out, rules.verdict(domain_of(F.col(url))))
    hosted = df.withColumn("host", domain_of(F.col(url)))
    hits = hosts_below(hosted.select("host").distinct(), extra_hosts).withColumn("_extra", F.lit(True))
    joined = lookup(hosted, hits, "host")
    return joined.withColumn(out, rules.verdict(F.col("host"), F.col("_extra"))).select(*df.columns, out)


@F.pandas_udf(StringType())
def _regex_of(patterns: pd.Series) -> pd.Series:
    """Regular expressions of a column of patterns; runs over the pattern table only."""
    return patterns.map(lambda p: rf"(?s)\A(?:{pattern_regex(p)})\z", na_action="ignore")


def classify_hosts(hosts: DataFrame, patterns: DataFrame) -> DataFrame:
    """Verdict per host from a table of (kind, pattern), kind being allow, deny or extra, of any size.

    Literal patterns are matched by an equi join on label suffixes.  A pattern with inner wildcards
    meets the hosts that share its labels after the last wildcard, or else its longest whole label,
    and is then tried as an expression.  Only patterns without any whole label, such as ``w*w``,
    must be tried on every host.
    """
    text = F.lower(F.trim("pattern"))
    base = F.regexp_replace(text, r"^\*\.", "")
    table = patterns.select("kind", text.alias("text"), base.alias("base"), text.startswith("*.").alias("below_only")).distinct()
    inner = (F.contains(F.col("base"), F.lit("*")) | (F.col("below_only") & F.col("base").rlike(r"[?\[]"))) & (F.col("kind") != "extra")
    names = hosts.select("host").distinct()
    suffixes = names.select("host", F.explode(host_suffixes(F.col("host"))).alias("_suffix"))
    literal = table.filter(~inner).select("kind", F.col("base").alias("_suffix"), "below_only")
    hits = lookup(suffixes, literal, "_suffix", "inner").filter(~F.col("below_only") | (F.col("_suffix") != F.col("host")))

    tail = F.regexp_extract("text", r"\.([^*?\[\].]+(?:\.[^*?\[\].]+)*)$", 1)
    labels = F.filter(F.split("text", r"\."), lambda x: ~x.rlike(r"[*?\[\]]") & (x != ""))
    longest = F.array_max(F.transform(labels, lambda x: F.struct(F.length(x).alias("n"), x.alias("label"))))["label"]
    plain = F.when(F.contains(F.col("text"), F.lit("[")), None).otherwise(longest)  # a bracket may hold dots
    key = F.when(tail != "", F.concat(F.lit("."), tail)).otherwise(F.coalesce(plain, F.lit("")))
    wild = table.filter(inner).select("kind", _regex_of("text").alias("_regex"), key.alias("_key"))
    ends = F.transform(host_suffixes(F.col("host")), lambda s: F.concat(F.lit("."), s))
    parts = names.select("host", F.explode(F.array_distinct(F.concat(F.array(F.lit("")), ends, F.split("host", r"\.")))).alias("_key"))
    tried = lookup(parts, wild, "_key", "inner").filter(F.rlike(F.col("host"), F.col("_regex")))
    flags = hits.select("host", "kind").unionByName(tried.select("host", "kind")).groupBy("host").agg(
        *[F.bool_or(F.col("kind") == kind).alias(f"_{kind}") for kind in ("allow", "deny", "extra")]
    )
    flag = lambda kind: F.coalesce(F.col(f"_{kind}"), F.lit(False))
    return names.join(flags, "host", "left").select(
        "host", ((F.col("host") != "") & ~flag("deny") & (flag("extra") | flag("allow"))).alias("allowed")
    )
