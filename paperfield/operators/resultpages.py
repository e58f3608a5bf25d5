"""Hits of captured search-result pages.

Only the walk over the markup, which needs element ancestry, runs in Python, Arrow batch by Arrow
batch; unwrapping, exclusions and deduplication are Column expressions.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.functions.content import SNIPPET_LIMIT, TITLE_LIMIT, cut
from paperfield.functions.urls import bind, domain_of, netloc_of, unwrap_result_url
from paperfield.operators.skew import first_per_key

# --- fixed values -----------------------------------------------------------------------------
RESULT_AREA_ID = "web"
RESULT_LIST_CLASS = "searchCenterMiddle"
SEARCH_HOST = "yahoo.com"
SEARCH_PATH = "/search"
EXCLUDED_HOSTS = ("yahoo.com", "yimg.com")
# ----------------------------------------------------------------------------------------------

_VOID = frozenset("area base br col embed hr img input link meta source track wbr".split())


class _Anchors(HTMLParser):
    """Anchors with the span of text pieces of themselves and of their nearest block."""

    def __init__(self, markup: str):
        super().__init__()
        self.pieces: list[str] = []
        self.anchors: list[dict] = []
        self._open: list[dict] = []
        self._muted = 0
        self.feed(markup)
        self.close()
        self._shut(0)

    def _shut(self, depth: int) -> None:
        for node in self._open[depth:]:
            node["end"] = len(self.pieces)
        del self._open[depth:]

    def _innermost(self, *tags: str) -> int:
        return next((i for i in range(len(self._open) - 1, -1, -1) if self._open[i]["tag"] in tags), -1)

    def handle_starttag(self, tag, attrs):
        found: dict = {}
        for name, value in attrs:
            found.setdefault(name, value or "")
        if tag in ("script", "style"):
            self._muted += 1
            return
        if tag in _VOID:
            return
        if tag == "a" and (depth := self._innermost("a")) >= 0:
            self._shut(depth)
        if tag == "li" and (depth := self._innermost("li", "ol", "ul")) >= 0 and self._open[depth]["tag"] == "li":
            self._shut(depth)
        node = {"tag": tag, "start": len(self.pieces), "end": None, "id": found.get("id"), "class": found.get("class", "").split()}
        if tag == "a":
            above = self._open
            node["href"] = found.get("href")
            node["picked"] = any(n["tag"] == "h3" or (n["tag"] == "ol" and RESULT_LIST_CLASS in n["class"]) for n in above) or (
                node["href"] is not None and any(n["id"] == RESULT_AREA_ID for n in above)
            )
            block = self._innermost("div")
            block = block if block >= 0 else self._innermost("li")
            node["block"] = above[block] if block >= 0 else None
            self.anchors.append(node)
        self._open.append(node)

    def handle_endtag(self, tag):
        if tag in ("script", "style"):
            self._muted = max(0, self._muted - 1)
        elif (depth := self._innermost(tag)) >= 0:
            self._shut(depth)

    def handle_data(self, data):
        if not self._muted and data.strip():
            self.pieces.append(data.strip())

    def text(self, node: dict | None, limit: int) -> str:
        """Joined pieces of a node, at least ``limit`` characters of them."""
        out = ""
        for piece in self.pieces[node["start"] : node["end"]] if node else ():
            out = f"{out} {piece}" if out else piece
            if len(out) >= limit:
                break
        return out

    def results(self) -> list[dict]:
        picked = [a for a in self.anchors if a["picked"]]
        return picked or [a for a in self.anchors if a["href"] is not None]


def _walk(keys: list[str]) -> Callable[[Iterator[pd.DataFrame]], Iterator[pd.DataFrame]]:
    columns = [*keys, "pos", "href", "title", "snippet"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                page = _Anchors(getattr(row, "html") or "")
                key = [getattr(row, k) for k in keys]
                for pos, anchor in enumerate(page.results(), 1):
                    title, snippet = page.text(anchor, TITLE_LIMIT), page.text(anchor["block"], SNIPPET_LIMIT)
                    out.append([*key, pos, anchor["href"] or "", title, snippet])
            yield pd.DataFrame(out, columns=columns)

    return run


def is_provider_link(href: Column) -> Column:
    """The provider's own search links."""
    return F.contains(netloc_of(href), F.lit(SEARCH_HOST)) & F.contains(href, F.lit(SEARCH_PATH))


def is_result_target(url: Column) -> Column:
    """http(s) targets outside the provider's hosts."""

    def outside(target: Column) -> Column:
        excluded = domain_of(target).rlike(rf"(?:{'|'.join(h.replace('.', '[.]') for h in EXCLUDED_HOSTS)})$")
        return target.startswith("http") & ~excluded

    return bind(url, outside)


def extract_hits(pages: DataFrame) -> DataFrame:
    """Hits (provider, query, page, pos, url, title, snippet) of pages (provider, query, page, html)."""
    keys = ["provider", "query", "page"]
    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pages.select(*keys).schema.fields)
    found = pages.select(*keys, "html").mapInPandas(_walk(keys), f"{fields}, pos int, href string, title string, snippet string")
    hits = (
        found.filter(~is_provider_link(F.col("href")))
        .withColumn("url", unwrap_result_url(F.col("href")))
        .filter(is_result_target(F.col("url")))
        .select(*keys, "pos", "url", cut(F.col("title"), TITLE_LIMIT).alias("title"), cut(F.col("snippet"), SNIPPET_LIMIT).alias("snippet"))
    )
    return first_per_key(hits, [*keys, "url"], [F.col("pos")])


EXTRACTORS: dict[str, Callable[[DataFrame], DataFrame]] = {"yahoo": extract_hits}


def get_extractor(name: str | None) -> Callable[[DataFrame], DataFrame]:
    """Extractor of a provider by case-insensitive name."""
    key = (name or "yahoo").lower()
    if key not in EXTRACTORS:
        raise ValueError(f"unknown search provider: {name}")
    return EXTRACTORS[key]
