"""URL semantics as native Column expressions.

Each URL is split once by one regular expression and its parts are bound to a lambda variable, so
that an expression stays small however often it uses them.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------------------------
TRACKING_KEYS = (
    "utm_source",
    "utm_medium",
    "utm_campaign",
    "utm_term",
    "utm_content",
    "utm_id",
    "gclid",
    "fbclid",
    "mc_cid",
    "mc_eid",
    "msclkid",
    "_ga",
)
DEFAULT_FILENAME = "document.pdf"
FILENAME_LIMIT = 180
RESULT_PAGE_ENDPOINT = "https://search.yahoo.com/search"
RESULTS_PER_PAGE = 10
# ----------------------------------------------------------------------------------------------

# RFC 3986 appendix B with the scheme held to its legal alphabet.
_PARTS = r"(?s)^(?:([A-Za-z][A-Za-z0-9+.\-]*):)?(?://([^/?#]*))?([^?#]*)(?:\?([^#]*))?(?:#(.*))?$"
_UNICODE_SPACE = r"\u0085\u00a0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_EDGES = rf"^[\x00-\x20{_UNICODE_SPACE}]+|[\t-\r\x1c-\x20{_UNICODE_SPACE}]+$|[\x00\t\r\n]"
_PLAIN_PATH = r"\A/(?!/)(?!.*/\.{1,2}(?:/|\z))(?!\.{1,2}(?:/|\z))[^?#;\x00-\x20]*[^/?#;\x00-\x20]\z"
_DOT_SEGMENT = r"(?:^|/)\.\.?(?:/|$)"


def tidy(url: Column) -> Column:
    """Trim surrounding blanks, drop embedded tabs, line breaks and NULs; NULL becomes ''."""
    return F.regexp_replace(F.coalesce(url, F.lit("")), _EDGES, "")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once, however often ``body`` uses it.

    Keeps deep URL expressions small; repeated inline they outgrow the limits of generated code.
    """
    return F.element_at(F.transform(F.array(value), body), 1)


def url_parts(url: Column) -> Column:
    """array(scheme, authority, path, query, fragment); absent parts are ''."""
    return _split_tidy(tidy(url))


def _split_tidy(text: Column) -> Column:
    return F.split(F.regexp_replace(text, _PARTS, "$1\x00$2\x00$3\x00$4\x00$5"), "\x00")


def _part(tidied: Column, group: int) -> Column:
    return F.regexp_extract(tidied, _PARTS, group)


def _split_params(path: Column) -> tuple[Column, Column]:
    """Path without, and with only, the ``;params`` of its last segment."""
    return (
        F.regexp_replace(path, r"(?s);[^/]*$", ""),
        F.regexp_extract(path, r"(?s);([^/]*)$", 1),
    )


def url_path(url: Column) -> Column:
    """Path component, without the parameters of the last segment."""
    return _split_params(_part(tidy(url), 3))[0]


def url_query(url: Column) -> Column:
    """Raw query string, '' when there is none."""
    return _part(tidy(url), 4)


def percent_decode(text: Column) -> Column:
    """Decode ``%HH``; '+' stays a plus and stray percent signs stay as they are."""

    def decode(t: Column) -> Column:
        guarded = F.replace(F.regexp_replace(t, r"%(?![0-9A-Fa-f]{2})", "%25"), F.lit("+"), F.lit("%2B"))
        return F.when(F.contains(t, F.lit("%")), F.try_url_decode(guarded)).otherwise(t)

    return bind(text, decode)


def form_encode(text: Column) -> Column:
    """Percent-encode everything but letters, digits and ``_.-~``; a space becomes '+'."""
    return F.replace(F.replace(F.url_encode(text), F.lit("*"), F.lit("%2A")), F.lit("%7E"), F.lit("~"))


def path_encode(text: Column) -> Column:
    """Like :func:`form_encode`, but a space becomes ``%20`` and '/' is kept."""
    return F.replace(F.replace(form_encode(text), F.lit("+"), F.lit("%20")), F.lit("%2F"), F.lit("/"))


def _host_port(netloc: Column) -> Column:
    return F.regexp_replace(netloc, r"(?s)^.*@", "")


def _host(netloc: Column) -> Column:
    return F.regexp_replace(F.lower(F.regexp_extract(_host_port(netloc), r"^([^:]*)", 1)), r"\.+$", "")


def netloc_of(url: Column) -> Column:
    """Authority component as written."""
    return _part(tidy(url), 2)


def domain_of(url: Column) -> Column:
    """Lower-case host without trailing dots, port or user info; '' if there is none."""
    return _host(_part(tidy(url), 2))


def _tracking_pair() -> str:
    return rf"(?i)(?<![^&])(?:{'|'.join(TRACKING_KEYS)})=[^&]*(?:&|$)"


def canonical_query(query: Column, drop_tracking: bool = True) -> Column:
    """Re-encode a query string pair by pair and drop tracking pairs.

    The whole string is decoded and encoded once.  '&' and the first '=' of each pair ride through
    as control characters 1 and 2; genuine control characters 1-3 are escaped behind character 3
    first, so the round trip is injective.
    """
    text = query
    for char, tag in (("\x03", "c"), ("\x01", "a"), ("\x02", "b")):
        text = F.regexp_replace(text, f"(?:{char}|%0{ord(char)})", f"%03{tag}")
    text = F.regexp_replace(text, r"&+", "\x01")
    text = F.regexp_replace(text, "^\x01|\x01$", "")
    text = F.regexp_replace(text, "(?<![^\x01])([^=\x01]*)=", "$1\x02")
    text = F.regexp_replace(text, "(?<![^\x01])([^\x01\x02]+)(?![^\x01])", "$1\x02")
    text = F.regexp_replace(text, r"%(?![0-9A-Fa-f]{2})", "%25")
    text = form_encode(F.try_url_decode(text))
    text = F.replace(F.replace(text, F.lit("%01"), F.lit("&")), F.lit("%02"), F.lit("="))
    for tag, code in (("a", "%01"), ("b", "%02"), ("c", "%03")):
        text = F.replace(text, F.lit(f"%03{tag}"), F.lit(code))
    if drop_tracking:
        text = F.regexp_replace(F.regexp_replace(text, _tracking_pair(), ""), r"&$", "")
    return F.when(query == "", F.lit("")).otherwise(text)


def tracking_pair_count(url: Column) -> Column:
    """How many tracking pairs the query of ``url`` carries."""
    pairs = canonical_query(url_query(url), drop_tracking=False)
    return F.regexp_count(pairs, F.lit(rf"(?i)(?<![^&])(?:{'|'.join(TRACKING_KEYS)})="))


def canonical_url(url: Column) -> Column:
    """Canonical form of an http(s) URL, '' if it is none, NULL if its port or host cannot be read.

    Lower-case scheme and host, no user info, default port, fragment, path parameters, trailing
    slashes or tracking pairs; the remaining query is re-encoded in its own order.
    """
    return _canonical_tidy(tidy(url))


def _canonical_tidy(text: Column) -> Column:
    return bind(_split_tidy(text), lambda parts: bind(_normal_parts(parts), _compose))


def _normal_parts(parts: Column) -> Column:
    netloc = parts[1]
    port_text = F.regexp_extract(_host_port(netloc), r"(?s)^[^:]*:(.*)$", 1)
    return F.struct(
        F.lower(F.coalesce(F.nullif(parts[0], F.lit("")), F.lit("https"))).alias("scheme"),
        F.when(~netloc.rlike(r"[\[\]]"), _host(netloc)).alias("host"),
        (port_text == "").alias("no_port"),
        F.when(port_text.rlike(r"\A[0-9]+\z"), port_text.try_cast("long")).alias("port"),
        _split_params(parts[2])[0].alias("path"),
        canonical_query(parts[3]).alias("query"),
    )


def _compose(url: Column) -> Column:
    scheme, host, port = url["scheme"], url["host"], url["port"]
    standard = F.when(scheme == "http", 80).otherwise(443)
    suffix = F.when(url["no_port"] | port.isin(0) | (port == standard), "").otherwise(F.concat(F.lit(":"), port.cast("string")))
    path = F.when(url["path"].isin("", "/"), "/").otherwise(F.regexp_replace(url["path"], r"/+$", ""))
    tail = F.when(url["query"] == "", "").otherwise(F.concat(F.lit("?"), url["query"]))
    return (
        F.when(~scheme.isin("http", "https"), "")
        .when(host.isNull(), F.lit(None))
        .when(host == "", "")
        .when(~url["no_port"] & (port.isNull() | (port > 65535)), F.lit(None))
        .otherwise(F.concat(scheme, F.lit("://"), host, suffix, path, tail))
    )


def _without_dot_segments(path: Column) -> Column:
    return bind(path, lambda p: F.when(p.rlike(_DOT_SEGMENT), bind(F.split(p, "/"), _fold_segments)).otherwise(p))


def _fold_segments(segments: Column) -> Column:
    empty = F.array().cast("array<string>")

    def step(kept: Column, segment: Column) -> Column:
        return (
            F.when(segment == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0))))
            .when(segment == ".", kept)
            .otherwise(F.concat(kept, F.array(segment)))
        )

    def finish(kept: Column) -> Column:
        trailing = F.element_at(segments, -1).isin(".", "..")
        return F.array_join(F.when(trailing, F.concat(kept, F.array(F.lit("")))).otherwise(kept), "/")

    return F.aggregate(segments, empty, step, finish)


def resolve_url(base: Column, ref: Column) -> Column:
    """RFC 3986 reference resolution against an http(s) base, dot segments included."""
    return bind(_base(base), lambda b: bind(tidy(ref), lambda text: _resolve(b, text)))


def _base(url: Column) -> Column:
    """What resolution needs of a base URL, parsed once for all references of a page."""
    return F.struct(
        tidy(url).alias("text"),
        url_parts(url).alias("parts"),
        F.regexp_extract(F.coalesce(canonical_url(url), F.lit("")), r"^https?://[^/?#]*", 0).alias("origin"),
    )


def _resolve(base: Column, text: Column) -> Column:
    return bind(_split_tidy(text), lambda parts: _resolve_parts(base["text"], base["parts"], text, parts))


def _resolve_parts(base: Column, b: Column, text: Column, r: Column) -> Column:
    base_scheme = F.lower(b[0])
    foreign = (r[0] != "") & (F.lower(r[0]) != base_scheme)
    path, query = r[2], F.when((r[2] == "") & (r[3] == ""), b[3]).otherwise(r[3])
    plain, params = _split_params(path)
    folder = F.regexp_replace(_split_params(b[2])[0], r"[^/]*$", "")
    merged = F.when(plain.startswith("/"), plain).otherwise(
        F.regexp_replace(F.concat(F.when(folder == "", "/").otherwise(folder), plain), "/{2,}", "/")
    )
    rooted = bind(_without_dot_segments(merged), lambda p: F.when(p.startswith("/"), p).otherwise(F.concat(F.lit("/"), p)))
    final_path = F.when(path == "", b[2]).otherwise(
        F.concat(rooted, F.when(params == "", "").otherwise(F.concat(F.lit(";"), params)))
    )
    return (
        F.when(base == "", text)
        .when(text == "", base)
        .when(foreign | (r[1] != ""), F.when(r[0] == "", F.concat(base_scheme, F.lit(":"), text)).otherwise(text))
        .otherwise(
            F.concat(
                base_scheme,
                F.lit("://"),
                b[1],
                final_path,
                F.when(query == "", "").otherwise(F.concat(F.lit("?"), query)),
                F.when(r[4] == "", "").otherwise(F.concat(F.lit("#"), r[4])),
            )
        )
    )


def canonical_link(ref: Column, base: Column) -> Column:
    """A reference found on page ``base``, resolved and canonical; '' for an empty one."""
    return bind(_base(base), lambda b: _link(b, ref))


def canonical_links(refs: Column, base: Column) -> Column:
    """The same for an array of references; the base is parsed once."""
    return bind(_base(base), lambda b: F.transform(refs, lambda ref: _link(b, ref)))


def _link(base: Column, ref: Column) -> Column:
    # Most links are plain absolute paths: nothing to resolve, decode or strip.
    def follow(text: Column) -> Column:
        return (
            F.when(text == "", "")
            .when((base["origin"] != "") & text.rlike(_PLAIN_PATH), F.concat(base["origin"], text))
            .otherwise(_canonical_tidy(_resolve(base, text)))
        )

    return bind(tidy(ref), follow)


def policy_host(value: Column) -> Column:
    """Host of a URL, or the whole literal when it carries no ``://``."""
    text = F.lower(F.trim(F.coalesce(value, F.lit(""))))
    return F.when(F.contains(text, F.lit("://")), domain_of(text)).otherwise(F.regexp_replace(text, r"\.+$", ""))


def host_suffixes(host: Column) -> Column:
    """``a.b.c`` -> ``[a.b.c, b.c, c]``, so that a subdomain test becomes an equi join."""
    labels = F.split(host, r"\.")
    return F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))


def unwrap_result_url(href: Column) -> Column:
    """Target of a result-page redirect link.

    The first non-empty of the query keys RU, u, url (decoded as a form value, then once more),
    else the path part between ``/RU=`` and ``/RK=``, else the link itself.
    """

    def form_value(query: Column, key: str) -> Column:
        raw = F.regexp_extract(query, rf"(?s)(?<![^&]){key}=([^&]+)", 1)
        return F.nullif(percent_decode(percent_decode(F.replace(raw, F.lit("+"), F.lit(" ")))), F.lit(""))

    def choose(url: Column) -> Column:
        in_path = F.regexp_extract(url["path"], r"(?s)/RU=(.*?)(?:/RK=.*)?$", 1)
        return F.coalesce(
            *[form_value(url["query"], key) for key in ("RU", "u", "url")],
            F.when(F.contains(url["path"], F.lit("/RU=")), percent_decode(in_path)),
            url["text"],
        )

    text = F.coalesce(href, F.lit(""))
    return bind(F.struct(text.alias("text"), url_path(text).alias("path"), url_query(text).alias("query")), choose)


def result_page_url(query: Column, page: Column) -> Column:
    """Address of one result page of a query; no request is made."""
    offset = F.lit(1) + F.greatest(page - 1, F.lit(0)) * RESULTS_PER_PAGE
    return F.concat(
        F.lit(f"{RESULT_PAGE_ENDPOINT}?p="),
        form_encode(query),
        F.lit("&b="),
        offset.cast("string"),
        F.lit(f"&pz={RESULTS_PER_PAGE}"),
    )


def filename_from_url(url: Column, default: str = DEFAULT_FILENAME) -> Column:
    """Safe file name from the last path segment."""
    path = F.regexp_replace(percent_decode(url_path(url)), r"(?:/\.?)+$", "")
    name = F.regexp_extract(path, r"(?s)[^/]*$", 0)
    dotted = F.when(F.contains(name, F.lit(".")), name).otherwise(F.concat(name, F.lit(".pdf")))
    safe = F.substring(F.regexp_replace(dotted, r"(?s)[^\p{L}\p{N}._\- ]", "_"), 1, FILENAME_LIMIT)
    return F.when(name.isin("", "."), default).otherwise(safe)


def collision_name(path: Column, index: Column) -> Column:
    """``dir/stem.ext`` -> ``dir/stem__{index}.ext``; the extension defaults to ``.pdf``."""
    split = r"(?s)^((?:.*/)?[^/]+)(\.[^./]+)$"
    number = F.concat(F.lit("__"), index.cast("string"))
    return F.when(
        path.rlike(split), F.concat(F.regexp_extract(path, split, 1), number, F.regexp_extract(path, split, 2))
    ).otherwise(F.concat(path, number, F.lit(".pdf")))


def content_path(root: str, digest: Column) -> Column:
    """Two-level fan-out of a digest below ``root``."""
    return F.concat_ws(
        "/", F.lit(root), F.substring(digest, 1, 2), F.substring(digest, 3, 2), F.concat(digest, F.lit(".pdf"))
    )


def named_path(root: str, state: Column, filename: Column, canonical: Column) -> Column:
    """Storage path of the by-state layout: ``root/state/filename``."""
    folder = F.replace(F.coalesce(F.nullif(state, F.lit("")), F.lit("unknown")), F.lit(" "), F.lit("_"))
    name = F.coalesce(F.nullif(filename, F.lit("")), filename_from_url(canonical))
    return F.concat_ws("/", F.lit(root), folder, name)


def any_of(columns: Sequence[Column]) -> Column:
    """Disjunction of a possibly empty list."""
    out = F.lit(False)
    for column in columns:
        out = out | column
    return out
