"""Content detection, text extraction and hashing as Column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

from paperfield.functions.urls import any_of, url_path

# --- fixed values -----------------------------------------------------------------------------
PDF_MAGIC = "%PDF-"
PDF_CONTENT_TYPE = "application/pdf"
DOCUMENT_TYPES = ("msword", "officedocument", "spreadsheet", "rtf")
ARCHIVE_TYPES = ("zip", "gzip", "tar", "x-7z", "x-rar")
HEADER_BYTES = 16
CHUNK_BYTES = 1048576
TITLE_LIMIT = 300
SNIPPET_LIMIT = 400
SEARCH_ERROR_LIMIT = 400
DOWNLOAD_ERROR_LIMIT = 500
BLOCK_SCAN_LIMIT = 4000
BLOCK_STATUSES = (403, 429, 503)
BLOCK_MARKERS = (
    "not a robot",
    "unusual traffic",
    "captcha",
    "access denied",
    "temporarily blocked",
)
FATAL_STATUS = 403
FATAL_MARKERS = ("captcha", "not a robot")
# ----------------------------------------------------------------------------------------------

_ASCII_SPACE = r"[ \t\n\r\x0b\f]"
_INVISIBLE = r"(?is)<!--.*?-->|<(script|style)\b[^>]*>.*?</\1\s*>"
_TAG = r"(?s)<[A-Za-z/!?](?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>"


def latin1(body: Column, start: int, length: int) -> Column:
    """A byte range as text, one character per byte."""
    return F.decode(F.substring(body, start, length), "ISO-8859-1")


def url_looks_like_pdf(url: Column) -> Column:
    return F.lower(url_path(url)).endswith(".pdf")


def content_type_is_pdf(content_type: Column) -> Column:
    return F.coalesce(F.contains(F.lower(content_type), F.lit(PDF_CONTENT_TYPE)), F.lit(False))


def magic_is_pdf(body: Column) -> Column:
    """Leading ASCII blanks, then the PDF signature, within the first bytes of the body."""
    return F.coalesce(latin1(body, 1, HEADER_BYTES).rlike(rf"\A{_ASCII_SPACE}*{PDF_MAGIC}"), F.lit(False))


def is_pdf(url: Column, content_type: Column, body: Column) -> Column:
    return magic_is_pdf(body) | content_type_is_pdf(content_type) | url_looks_like_pdf(url)


def content_class(content_type: Column, url: Column) -> Column:
    """pdf, html, image, document, archive, binary or unknown; the first match decides."""
    kind = F.lower(F.coalesce(content_type, F.lit("")))

    def names(parts: tuple[str, ...]) -> Column:
        return any_of([F.contains(kind, F.lit(p)) for p in parts])

    return (
        F.when(F.contains(kind, F.lit(PDF_CONTENT_TYPE)) | url_looks_like_pdf(url), "pdf")
        .when(F.contains(kind, F.lit("text/html")) | kind.startswith("text/"), "html")
        .when(kind.startswith("image/"), "image")
        .when(names(DOCUMENT_TYPES), "document")
        .when(names(ARCHIVE_TYPES), "archive")
        .when(kind == "", "unknown")
        .otherwise("binary")
    )


def starts_like_html(body: Column) -> Column:
    """First chunk, leading blanks skipped, opens a doctype or an html tag."""
    opening = rf"(?i)\A{_ASCII_SPACE}*<(?:!doctype|html)"
    near = latin1(body, 1, 256)
    return F.coalesce(
        F.when(near.rlike(rf"\A{_ASCII_SPACE}*\z"), latin1(body, 1, CHUNK_BYTES).rlike(opening)).otherwise(near.rlike(opening)),
        F.lit(False),
    )


def sha256_hex(body: Column) -> Column:
    return F.sha2(body, 256)


def charset_of(content_type: Column) -> Column:
    """Charset parameter of a content type, lower-case, '' if absent."""
    return F.lower(F.regexp_extract(F.coalesce(content_type, F.lit("")), r"(?i)charset\s*=\s*[\"']?([^\s\"';]+)", 1))


def decode_body(body: Column, content_type: Column) -> Column:
    """Body as text; bytes that do not decode become U+FFFD.

    The declared charset counts; an undeclared ``text/*`` is ISO-8859-1, as HTTP clients take it,
    and everything else UTF-8.  Charsets beyond ASCII, Latin-1 and UTF-8 are read as UTF-8.
    """
    charset = charset_of(content_type)
    bare_text = (charset == "") & F.contains(F.lower(F.coalesce(content_type, F.lit(""))), F.lit("text"))
    as_latin1 = F.decode(body, "ISO-8859-1")
    return (
        F.when(bare_text | charset.isin("iso-8859-1", "latin-1", "latin1", "l1"), as_latin1)
        .when(charset.isin("us-ascii", "ascii"), F.regexp_replace(as_latin1, r"[\x80-\xff]", "�"))
        .otherwise(F.make_valid_utf8(body.cast("string")))
    )


def _code_point(number: Column) -> Column:
    legal = number.between(1, 0x10FFFF) & ~number.between(0xD800, 0xDFFF)
    return F.when(legal, F.decode(F.unhex(F.lpad(F.hex(number), 8, "0")), "UTF-32")).otherwise("�")


def unescape_entities(text: Column) -> Column:
    """Resolve numeric and HTML 4 named character references."""
    pairs = "\x02".join(f"{name}\x01{chr(code)}" for name, code in name2codepoint.items())
    named = F.str_to_map(F.lit(pairs), F.lit("\x02"), F.lit("\x01"))
    reference = r"(?s)\A&(?:#[xX]([0-9A-Fa-f]{1,8})|#([0-9]{1,9})|([A-Za-z][A-Za-z0-9]*)(?=;));?(.*)\z"

    def resolve(piece: Column) -> Column:
        hexadecimal, decimal, name = (F.regexp_extract(piece, reference, i) for i in (1, 2, 3))
        rest = F.regexp_extract(piece, reference, 4)
        char = (
            F.when(hexadecimal != "", _code_point(F.conv(hexadecimal, 16, 10).cast("long")))
            .when(decimal != "", _code_point(decimal.try_cast("long")))
            .otherwise(F.try_element_at(named, name))
        )
        return F.when(piece.rlike(reference) & char.isNotNull(), F.concat(char, rest)).otherwise(piece)

    pieces = F.transform(F.split(text, r"(?=&)"), resolve)
    return F.when(F.contains(text, F.lit("&")), F.array_join(pieces, "")).otherwise(text)


def without_invisible(html: Column) -> Column:
    """Markup without comments, scripts and style sheets."""
    return F.regexp_replace(F.coalesce(html, F.lit("")), _INVISIBLE, "<!>")


def visible_text(html: Column) -> Column:
    """Text pieces between tags, each trimmed, empty ones dropped, joined by one space."""
    pieces = F.split(without_invisible(html), _TAG)
    trimmed = F.transform(pieces, lambda p: F.regexp_replace(unescape_entities(p), r"(?U)\A\s+|\s+\z", ""))
    return F.array_join(F.filter(trimmed, lambda p: p != ""), " ")


def cut(text: Column, limit: int) -> Column:
    return F.substring(text, 1, limit)


def block_outcome(status: Column, body: Column, retry_after: Column) -> Column:
    """Struct (blocked, fatal, retry_after) of a result-page response."""
    head = F.lower(cut(F.coalesce(body, F.lit("")), BLOCK_SCAN_LIMIT))
    blocked = status.isin(*BLOCK_STATUSES) | any_of([F.contains(head, F.lit(m)) for m in BLOCK_MARKERS])
    fatal = (status == FATAL_STATUS) | any_of([F.contains(head, F.lit(m)) for m in FATAL_MARKERS])
    return F.struct(
        blocked.alias("blocked"),
        (blocked & fatal).alias("fatal"),
        F.when(blocked, search_retry_after(retry_after)).alias("retry_after"),
    )


def search_retry_after(header: Column) -> Column:
    """Any number of seconds, else NULL."""
    return F.trim(header).try_cast("double")


def crawl_retry_after(header: Column) -> Column:
    """Whole seconds only, else NULL."""
    return F.when(header.rlike(r"\A[0-9]+\z"), header.try_cast("double"))
