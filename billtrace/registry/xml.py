"""Akoma Ntoso files that Spark derives from text rows: one line of text, one paragraph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..fixed_values import AKOMA_NTOSO


def _escape(c: Column) -> Column:
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        c = F.replace(c, F.lit(char), F.lit(entity))
    return c


def _file(*parts) -> Column:
    text = F.concat(
        F.lit(f'<akomaNtoso xmlns="{AKOMA_NTOSO}">'),
        *[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts],
        F.lit("</akomaNtoso>"),
    )
    return F.encode(text, "UTF-8")


def bill_files(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, path, content: a bill with one article and a paragraph for each line."""
    key = F.col("doc_id")
    paragraphs = F.array_join(
        F.transform(
            F.split(F.col(text), "\n"),
            lambda x, i: F.concat(
                F.lit("<paragraph><num>"), (i + 1).cast("string"), F.lit("</num><content><p>"), _escape(x), F.lit("</p></content></paragraph>")
            ),
        ),
        "",
    )
    content = _file(
        '<bill><meta><identification><FRBRWork><FRBRdate date="2024-01-15"/><FRBRnumber value="',
        key,
        '"/><FRBRsubtype value="ddl"/></FRBRWork></identification><references>',
        '<TLCPerson id="p1" showAs="Rossi"/><TLCRole id="r1" showAs="Senatrice"/></references></meta>',
        '<preface><docProponent refersTo="#p1" as="#r1">x</docProponent><docProponent refersTo="#p2"> Bianchi </docProponent></preface>',
        '<body><article id="art1"><num>Art. 1.</num><heading>Il <i>titolo</i> vero ',
        key,
        "</heading>",
        paragraphs,
        "</article></body></bill>",
    )
    path = F.concat(F.lit("data/Leg19/Atto"), key, F.lit("/ddlpres/"), key, F.lit(".akn.xml"))
    return docs.select("doc_id", path.alias("path"), content.alias("content"))


def amendment_files(rows: DataFrame) -> DataFrame:
    """em_id, path, content: an amendment with two proponents and the text as one content line.

    ``rows`` has em_id, atto, data, number, p1, p2 and testo.
    """

    def person(col: str, n: int):
        return [f'<TLCPerson id="p{n}" showAs="Nome ', F.col(col), '" href="/persone/', F.col(col), '"/>']

    content = _file(
        '<amendment><meta><identification><FRBRWork><FRBRthis value="',
        F.col("em_id"),
        '"/><FRBRdate date="',
        F.date_format("data", "yyyy-MM-dd"),
        '"/><FRBRnumber value="',
        F.col("number"),
        '"/><FRBRname value="em"/></FRBRWork></identification><references><activeRef href="/bill/1" showAs="DDL 1"/>',
        *person("p1", 1),
        *person("p2", 2),
        '</references></meta><preface><p><docNumber>Emendamento n. 3.1</docNumber></p>',
        '<docProponent refersTo="#p1">a</docProponent><docProponent refersTo="#p2">b</docProponent></preface>',
        "<amendmentBody><p>",
        _escape(F.col("testo")),
        "</p><p> </p></amendmentBody></amendment>",
    )
    path = F.concat(F.lit("data/Leg19/Atto"), F.col("atto"), F.lit("/emendc/"), F.col("em_id"), F.lit(".akn.xml"))
    return rows.select("em_id", path.alias("path"), content.alias("content"))
