"""Column functions on the cases that are easy to get wrong."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from billtrace.functions import bodies, dates, texts, uris


def run(spark, expr, *values):
    names = [f"c{i}" for i in range(len(values))]
    df = spark.range(1).select(*[F.lit(v).alias(n) for v, n in zip(values, names)])
    return df.select(expr(*[F.col(n) for n in names]).alias("x")).first()["x"]


@pytest.mark.parametrize(
    "raw, want",
    [
        (None, ""),
        ("", ""),
        ("perchÃ¨  no", "perchè no"),
        ("cittÃ x", "cittàx"),
        ("Ã ", "À"),
        ("Ãˆ vero Ã‰", "È vero É"),
        ("a  \x1cb\n", "a b"),
        ("lâ\u0080\u0099atto", "l'atto"),
        ("Â«x»", "«x»"),
    ],
)
def test_fix_encoding(spark, raw, want):
    assert run(spark, lambda c: texts.fix_encoding(c.cast("string")), raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [("Art. 1.", "1"), ("Art. 2-bis", "2-bis"), ("ArtX 3..", "3."), ("x Art. 4", "x4"), ("Art", "Art"), ("5.", "5")],
)
def test_article_number(spark, raw, want):
    assert run(spark, texts.article_number, raw) == want


@pytest.mark.parametrize(
    "number, target, want",
    [
        ("3.1", "x", "3"),
        ("", "Emendamento n. 7.2", "7"),
        (None, " Emendamento n. 8 ", "8"),
        ("", "", None),
        (None, None, None),
        (".1", None, ""),
    ],
)
def test_target_article(spark, number, target, want):
    assert run(spark, lambda a, b: texts.target_article(a.cast("string"), b.cast("string")), number, target) == want


@pytest.mark.parametrize("raw, want", [(" a  b ", 4), ("", 1), ("a b", 2)])
def test_word_count(spark, raw, want):
    assert run(spark, texts.word_count, raw) == want


@pytest.mark.parametrize(
    "raw, want",
    [
        ("20130319", dt.date(2013, 3, 19)),
        ("2013-03-19", dt.date(2013, 3, 19)),
        ("20130319T10", dt.date(2013, 3, 19)),
        ("20139919", None),
        ("2013", None),
        ("", None),
    ],
)
def test_parse_date(spark, raw, want):
    assert run(spark, dates.parse_yyyymmdd, raw) == want


def test_days_are_never_negative(spark):
    days = spark.sql("select date'2020-01-10' s, date'2020-01-01' e, cast(null as date) n").select(
        dates.days_between("s", "e", "2020-02-01").alias("a"), dates.days_between("s", "n", "2020-02-01").alias("b")
    )
    assert tuple(days.first()) == (0, 22)


@pytest.mark.parametrize(
    "raw, want",
    [("http://a/b/9/", "9"), ("http://a/b/9", "9"), ("9", "9"), ("", "")],
)
def test_uri_tail(spark, raw, want):
    assert run(spark, uris.uri_tail, raw) == want


def test_urn(spark):
    urn = "urn:nir:senato.repubblica:disegno.legge;approvato:19.legislatura;813-B"
    assert run(spark, uris.urn_legislature, urn) == 19
    assert run(spark, uris.urn_number, urn) == "813-B"
    assert run(spark, uris.urn_is_approved, urn) is True


def test_names(spark):
    assert run(spark, lambda a, b: texts.full_name(a.cast("string"), b), None, "Rossi") == "Rossi"
    assert run(spark, lambda a, b: texts.full_name(a.cast("string"), b.cast("string")), None, "") is None
    assert run(spark, texts.after_first_word, "Anna Maria Rossi") == "Maria Rossi"
    assert run(spark, texts.after_first_word, "Anna") is None


def test_government_bill(spark):
    def both(natura, initiative):
        return [
            run(spark, lambda a, b, k=k: texts.is_government_bill(a.cast("string"), b, literal=k), natura, initiative)
            for k in (True, False)
        ]

    assert both("DDL", "x") == [True, False]
    assert both("conversione DL", "x") == [True, True]
    assert both(None, "Governativa") == [True, True]


def test_gulpease_without_words(spark):
    df = spark.sql("select 10 l, 2 w, 1 s union all select 0, 0, 0")
    out = df.select(texts.gulpease(F.col("l"), F.col("w"), F.col("s")).alias("g")).collect()
    assert [r.g for r in out] == [89 - 50 + 150, None]


@pytest.mark.parametrize(
    "raw, want",
    [(" Sopprimere il comma 2.", "soppressione"), ("Sostituire", "modifica"), ("Dopo il comma", "aggiunta"), ("Altro", "altro")],
)
def test_amendment_type(spark, raw, want):
    assert run(spark, texts.amendment_type, raw) == want


def test_body_classes(spark):
    def kind(content_type, body):
        return run(spark, bodies.classify_body, content_type, body)

    assert kind("application/pdf", "x") == "PDF"
    assert kind("", "﻿<?xml version='1.0'?><akomaNtoso/>") == "AKN"
    assert kind("text/html", "<html>nulla</html>") == "HTML vuoto/errore"
    assert kind("text/html", "<html>Articolo 1</html>") == "HTML con contenuto"
    assert kind("", "boh") == "sconosciuto"
    anchored = run(spark, lambda c: bodies.anchored_block(c, "b"), '<a name="a">1</a><a name="b">2</a> due <p>x</p>')
    assert anchored == "2</a> due <p>x</p>"
