"""Parts of URIs, URLs and URNs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .texts import _col

LEGISLATURE_URI = "http://dati.camera.it/ocd/legislatura.rdf/repubblica_"


def uri_tail(c: Column | str) -> Column:
    """Last segment, slashes at the end ignored."""
    return F.substring_index(F.rtrim(_col(c), F.lit("/")), "/", -1)


def legislature_of(uri: Column | str) -> Column:
    """``.../repubblica_19`` to 19; NULL for anything else."""
    return F.nullif(F.regexp_extract(_col(uri), r"repubblica_(\d+)", 1), F.lit("")).cast("int")


def legislature_uri(n: Column | str) -> Column:
    return F.concat(F.lit(LEGISLATURE_URI), _col(n).cast("string"))


def strip_hash(c: Column | str) -> Column:
    return F.regexp_replace(_col(c), "^#+", "")


def url_extension(c: Column | str) -> Column:
    """Lower-case text after the last dot, query cut off; ``?`` when there is no dot."""
    url = _col(c)
    after_dot = F.substring_index(url, ".", -1)
    return F.when(F.contains(url, F.lit(".")), F.lower(F.substring_index(after_dot, "?", 1))).otherwise("?")


def classify_url(c: Column | str) -> Column:
    """Kind of document link, first rule that fits."""
    url = _col(c)

    def has(part: str) -> Column:
        return F.contains(url, F.lit(part))

    return (
        F.when(has("/_dati/") & has("/stampati/pdf/"), "/_dati/legN/lavori/stampati/pdf/*.pdf")
        .when(has("/_dati/") & has("/lavori/"), "/_dati/legN/lavori/...  (non-PDF)")
        .when(has("camera.it") & F.contains(F.lower(url), F.lit(".pdf")), "camera.it/*.pdf (altro)")
        .when(has("camera.it"), "camera.it/* (non-PDF)")
        .when(url.isNotNull(), "altra origine")
    )


def is_blank_node(c: Column | str) -> Column:
    return F.startswith(_col(c), F.lit("nodeID://")) | F.startswith(_col(c), F.lit("_:"))


URN_PATTERN = (
    r"^urn:nir:senato\.repubblica:disegno\.legge(;approvato)?:(\d+)\.legislatura;([0-9A-Za-z-]+)"
)


def urn_legislature(c: Column | str) -> Column:
    return F.nullif(F.regexp_extract(_col(c), URN_PATTERN, 2), F.lit("")).cast("int")


def urn_number(c: Column | str) -> Column:
    """Bill number, which may end in letters (``813-B``)."""
    return F.nullif(F.regexp_extract(_col(c), URN_PATTERN, 3), F.lit(""))


def urn_is_approved(c: Column | str) -> Column:
    """Does the URN name the finally approved text?"""
    return F.regexp_extract(_col(c), URN_PATTERN, 1) == ";approvato"
