"""What a downloaded body is, and the text in it."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .. import fixed_values as fixed
from .texts import _col, collapse_space, contains_any


def classify_body(
    content_type: Column | str,
    body: Column | str,
    status: Column | None = None,
    content_words: Sequence[str] = fixed.CONTENT_WORDS,
) -> Column:
    """PDF, AKN, XML, HTML with or without content, or unknown; first rule that fits."""
    kind = F.lower(F.coalesce(_col(content_type), F.lit("")))
    body = _col(body)
    low = F.lower(body)
    is_xml = F.contains(kind, F.lit("xml")) | F.startswith(F.ltrim(body, F.lit("\ufeff")), F.lit("<?xml"))
    is_html = F.contains(low, F.lit("<html")) | F.contains(low, F.lit("<!doctype"))
    expr = F.when(F.contains(kind, F.lit("pdf")) | F.startswith(body, F.lit("%PDF")), "PDF")
    expr = expr.when(is_xml & F.contains(low, F.lit("akomantoso")), "AKN").when(is_xml, "XML")
    expr = expr.when(is_html & contains_any(body, content_words), "HTML con contenuto")
    expr = expr.when(is_html, "HTML vuoto/errore").otherwise("sconosciuto")
    if status is None:
        return expr
    failed = F.concat(F.lit("errore HTTP "), status.cast("string"))
    return F.when(~status.isin(200, 206), failed).otherwise(expr)


def page_title(body: Column | str) -> Column:
    """Content of the first title tag, trimmed; empty without one."""
    return F.trim(F.regexp_extract(_col(body), r"(?is)<title[^>]*>(.*?)</title>", 1))


def strip_tags(body: Column | str) -> Column:
    """Text without tags, white space collapsed."""
    return collapse_space(F.regexp_replace(_col(body), r"<[^>]+>", " "))


def anchored_block(body: Column | str, anchor: Column | str) -> Column:
    """HTML from the element named ``anchor`` up to the next named anchor or the end."""
    body = _col(body)
    anchor = F.lit(anchor) if isinstance(anchor, str) else anchor
    quoted = F.concat(F.lit(r"\Q"), anchor, F.lit(r"\E"))
    pattern = F.concat(
        F.lit(r"(?is)<a[^>]*\b(?:name|id)=[\"']"),
        quoted,
        F.lit(r"[\"'][^>]*>(.*?)(?:<a[^>]*\b(?:name|id)=[\"']|\z)"),
    )
    return F.nullif(F.call_function("regexp_extract", body, pattern, F.lit(1)), F.lit(""))


def decode_bytes(content: Column | str) -> Column:
    """Text of a file by its byte order mark; without one it is read as UTF-8."""
    content = _col(content)
    head = F.hex(F.substring(content, 1, 3))
    rest = F.length(content)
    return (
        F.when(head == "EFBBBF", F.decode(F.substr(content, F.lit(4), rest), "UTF-8"))
        .when(F.startswith(head, F.lit("FFFE")), F.decode(F.substr(content, F.lit(3), rest), "UTF-16LE"))
        .otherwise(F.decode(content, "UTF-8"))
    )
