"""Links of captured HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paperfield.functions.content import unescape_entities, without_invisible
from paperfield.functions.urls import bind, canonical_links

# --- fixed values -----------------------------------------------------------------------------
SKIPPED_PREFIXES = ("javascript:", "mailto:", "tel:", "#")
FRAME_TAGS = ("embed", "iframe", "object")
# ----------------------------------------------------------------------------------------------

_ATTRIBUTES = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+"""


def _tags(html: Column, names: str) -> Column:
    return F.regexp_extract_all(html, F.lit(rf"(?is)<(?:{names})(?=[\s/>]){_ATTRIBUTES}>"), F.lit(0))


def _attribute(tag: Column, name: str) -> Column:
    """Trimmed, unescaped value of an attribute, NULL if the tag has none; the first one counts."""
    value = r"""(?:"([^"]*)"|'([^']*)'|([^\s"'>][^\s>]*))"""
    before = r"""<[a-z]+(?:[\s/]+(?!NAME\s*=)[^\s=>/]+(?:\s*=\s*(?:"[^"]*+"|'[^']*+'|[^\s"'>][^\s>]*+))?)*+""".replace("NAME", name)
    pattern = rf"(?is)^{before}[\s/]*{name}\s*=\s*{value}"
    found = F.concat(*[F.regexp_extract(tag, pattern, i) for i in (1, 2, 3)])
    return F.when(tag.rlike(pattern), F.regexp_replace(unescape_entities(found), r"(?U)\A\s+|\s+\z", ""))


def link_refs(html: Column) -> Column:
    """References in document order: all anchors first, then frame sources; duplicates kept."""
    markup = without_invisible(html)
    anchors = F.filter(
        F.transform(_tags(markup, "a"), lambda t: _attribute(t, "href")),
        lambda h: (h != "") & ~h.rlike(f"^(?:{'|'.join(SKIPPED_PREFIXES)})"),
    )
    frames = F.filter(
        F.transform(_tags(markup, "|".join(FRAME_TAGS)), lambda t: _attribute(t, "src")), lambda s: s != ""
    )
    return F.concat(anchors, frames)


def extract_links(pages: DataFrame, html: str = "html", base: str = "url", keep_pages: bool = False) -> DataFrame:
    """One row per link: the page's other columns, ``pos`` (from 1), ``ref`` and canonical ``link``.

    ``link`` is '' for references that are no http(s) URL and NULL for unreadable ones.  With
    ``keep_pages`` a page without links keeps one row, with NULL in ``pos``.
    """
    kept = [c for c in pages.columns if c != html]
    explode = F.posexplode_outer if keep_pages else F.posexplode
    found = bind(link_refs(F.col(html)), lambda refs: F.arrays_zip(refs.alias("ref"), canonical_links(refs, F.col(base)).alias("link")))
    rows = pages.select(*kept, explode(found).alias("_pos", "_link"))
    return rows.select(*kept, F.col("_link")["ref"].alias("ref"), (F.col("_pos") + 1).alias("pos"), F.col("_link")["link"].alias("link"))
