"""Operators on tiny frames in the domain schema, with rows worked out by hand."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from billtrace.operators import coalitions, coverage, flatten, graph, measures, picks, shape, signatories, timeline
from billtrace.operators.intervals import asof_interval, coalition_side, valid_at
from billtrace.plans.chamber import state_history
from billtrace.plans.persons import group_labels
from billtrace.streaming import check_integrity, insert_absent


def day(n):
    return dt.date(2020, 1, 1) + dt.timedelta(days=n)


def rows(df, *cols):
    return sorted((tuple(r) for r in (df.select(*cols) if cols else df).collect()), key=repr)


# ---- intervals -------------------------------------------------------------

SPANS = "p string, pos int, a date, b date, g string"


def test_asof_cases(spark):
    spans = spark.createDataFrame(
        [
            ("x", 0, day(0), day(10), "G1"),
            ("x", 1, day(10), None, "G2"),  # shares day 10 with the first
            ("y", 0, day(5), day(6), None),  # a membership without a name stays NULL
        ],
        SPANS,
    )
    left = spark.createDataFrame(
        [(1, "x", day(10)), (2, "x", day(11)), (3, "x", None), (4, "z", day(1)), (5, "w", day(1)), (6, "y", day(5)), (7, "x", day(-1)), (8, None, day(1))],
        "id int, p string, t date",
    )
    people = spark.createDataFrame([("x",), ("y",), ("w",)], "p string")
    out = asof_interval(left, spans, "p", "t", "a", "b", [F.col("pos")], "g", people=people)
    none = "Misto / Sconosciuto"
    assert rows(out, "id", "g") == [(1, "G1"), (2, "G2"), (3, none), (4, None), (5, none), (6, None), (7, none), (8, None)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_asof_equals_brute_force_with_a_hot_key(spark, seed):
    rnd = random.Random(seed)

    def key():
        return "hot" if rnd.random() < 0.4 else f"p{rnd.randrange(6)}"

    spans = []
    for pos in range(80):
        start = rnd.randrange(300)
        end = None if rnd.random() < 0.2 else day(start + rnd.randrange(90))
        spans.append((key(), pos, day(start), end, f"G{pos}"))
    left = [(i, key() if rnd.random() < 0.9 else "nobody", day(rnd.randrange(400))) for i in range(300)]

    def first(p, t):
        hits = [g for q, _, a, b, g in spans if q == p and a <= t and (b is None or b >= t)]
        known = any(q == p for q, *_ in spans)
        return hits[0] if hits else ("none" if known else None)

    out = asof_interval(
        spark.createDataFrame(left, "id int, p string, t date").repartition(7),
        spark.createDataFrame(spans, SPANS).repartition(5),
        "p", "t", "a", "b", [F.col("pos")], "g", default="none",
    )
    assert rows(out, "id", "g") == sorted(((i, first(p, t)) for i, p, t in left), key=repr)
    pairs = valid_at(
        spark.createDataFrame(left, "id int, p string, t date"), spark.createDataFrame(spans, SPANS).drop("pos"), "p", "t", "a", "b"
    )
    brute = [(i, g) for i, p, t in left for q, _, a, b, g in spans if q == p and a <= t and (b is None or b >= t)]
    assert rows(pairs, "id", "g") == sorted(brute, key=repr)


def test_coalition_side(spark):
    left = spark.createDataFrame([(1, "A", day(3)), (2, "A", day(9)), (3, None, day(3)), (4, "B", day(3))], "id int, g string, t date")
    majorities = spark.createDataFrame([("A", day(0), day(5))], "g string, inizio date, fine date")
    out = coalition_side(left, majorities, "g", "t")
    assert rows(out, "id", "schieramento") == [(1, "maggioranza"), (2, "opposizione"), (3, None), (4, "opposizione")]


# ---- picks -----------------------------------------------------------------


def test_first_non_null_mixes_rows(spark):
    df = spark.createDataFrame([("a", 2, "late", None), ("a", 1, None, "early"), ("b", 1, None, None)], "k string, o int, x string, y string")
    assert rows(picks.first_non_null(df, ["k"], ["x", "y"], ["o"]), "k", "x", "y") == [("a", "late", "early"), ("b", None, None)]


def test_picks_do_not_depend_on_partitions(spark):
    data = [(i % 3, i % 5, f"v{i}") for i in range(60)] * 2
    df = spark.createDataFrame(data, "k int, o int, v string")
    want = rows(picks.first_per_key(df.repartition(1), ["k"], [F.col("o")]))
    for n in (3, 11):
        assert rows(picks.first_per_key(df.repartition(n), ["k"], [F.col("o")])) == want


def test_first_role_and_current_name(spark):
    s = spark.createDataFrame([("a", "p", False), ("a", "p", True), ("a", "q", False)], "act string, who string, first boolean")
    assert rows(picks.first_role_wins(s, ["act", "who"], "first")) == [("a", "p", True), ("a", "q", False)]
    d = spark.createDataFrame(
        [("g1", "old", "s", "2001", 0), ("g1", "now", "s", None, 1), ("g1", "also", "s", None, 2), ("g2", "x", "s", "2001", 0), ("g2", "y", "s", "2002", 1), ("g3", None, "s", None, 0)],
        "gruppo string, titolo string, titoloBreve string, fine string, pos int",
    )
    assert rows(group_labels(d), "gruppo", "nome") == [("g1", "now"), ("g2", "y")]


def test_multi_phase_and_history(spark):
    df = spark.createDataFrame([(1, 1), (1, 2), (2, 1)], "bill int, prog int")
    assert rows(picks.multi_phase(df, "bill", "prog")) == [(1, 1), (1, 2)]
    states = spark.createDataFrame(
        [("http://a/1", 19, "s1", "x", "20130319"), ("http://a/1", 19, "s1", "x", "20130319"), ("http://a/1", 19, "s2", "y", "20139919")],
        "atto string, legislatura int, stato string, si_label string, si_date string",
    )
    assert rows(state_history(states), "id_atto", "stato_uri", "si_date") == [("1", "s1", dt.date(2013, 3, 19)), ("1", "s2", None)]


# ---- signatories, coverage ---------------------------------------------------


def test_summaries(spark):
    s = spark.createDataFrame(
        [("a", "p", "P", True), ("a", "q", "Q", False), ("a", "q", "Q", False), ("b", "r", "R", False), ("b", None, "S", False)],
        "act string, who string, name string, first boolean",
    )
    assert rows(signatories.signatory_summary(s, "act", "who", "name", "first")) == [("a", "p", "P", 1), ("b", None, None, 1)]
    assert rows(signatories.cosigner_counts(s, "act", "who", "first")) == [("a", 2, 2), ("b", 1, 2)]


def test_procedure_dates_keep_acts_with_one_label(spark):
    s = spark.createDataFrame(
        [("a", "Da assegnare", day(2)), ("a", "Da assegnare", day(1)), ("b", "Approvato definitivamente. Legge", day(3)), ("c", "x", day(1))],
        "act string, label string, d date",
    )
    assert rows(signatories.procedure_dates(s, "act", "label", "d")) == [("a", day(1), None), ("b", None, day(3))]


def test_coverage_null_group_and_empty_whole(spark):
    df = spark.createDataFrame([(1, None, True), (1, "S", False), (1, "S", None)], "leg int, ramo string, t boolean")
    out = coverage.coverage(df, ["leg", "ramo"], {"t": F.col("t")})
    assert rows(out) == [(1, "S", 2, 0, 0.0), (1, None, 1, 1, 100.0)]
    control = spark.createDataFrame([(1, 0), (2, 10)], "leg int, n long")
    measured = spark.createDataFrame([(1, 4), (2, 12)], "leg int, m int")
    assert rows(coverage.reconcile(measured, control, "leg", "m", "n")) == [(1, 0, 4, -4, 0.0), (2, 10, 12, -2, 120.0)]


def test_overlap_parts_add_up(spark):
    df = spark.range(100).select((F.col("id") % 2 == 0).alias("a"), (F.col("id") % 3 == 0).alias("b"))
    r = coverage.overlap(df, F.col("a"), F.col("b")).first()
    assert r.n_both + r.n_solo_a + r.n_solo_b + r.n_nessuno == r.n_tot == 100


def test_upper_median(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,)], "n long")
    assert coverage.count_stats(df, "n").first().mediana == 3


def test_pivot_refuses_two_rows_in_a_cell(spark):
    df = spark.createDataFrame([("a", "x", 1), ("a", "x", 2)], "k string, v string, n int")
    with pytest.raises(Exception, match="more than one row"):
        coverage.pivot_unique(df, ["k"], "v", ["x"], "n").collect()


# ---- growth ------------------------------------------------------------------


def test_growth_and_fragmentation(spark):
    articles = spark.createDataFrame(
        [("A", "Art. 1.", "ddlpres", "uno due"), ("A", "Art. 1.", "ddlmess", "uno due tre"), ("A", "Art. 2-bis", "ddlmess", None), ("B", "1", "ddlpres", "x"), ("B", "1", "ddlcomm", "y y y")],
        "atto_id string, numero_articolo string, versione string, testo_integrale string",
    )
    assert rows(measures.growth(articles)) == [("A", "1", 2, 3, 1), ("A", "2-bis", None, None, 0), ("B", "1", 1, None, -1)]
    amendments = spark.createDataFrame([("A", "e1", "1"), ("B", "e2", "1"), ("A", "e3", "2")], "atto_id string, emendamento_id string, articolo_target string")
    proponents = spark.createDataFrame([("e1", "G"), ("e1", "G"), ("e1", None), ("e2", "H")], "emendamento_id string, proponente_gruppo string")
    assert rows(measures.fragmentation(amendments, proponents)) == [("1", 2, 2), ("2", 1, 0)]
    assert rows(measures.fragmentation(amendments, proponents, by_act=True)) == [("A", "1", 1, 1), ("A", "2", 1, 0), ("B", "1", 1, 1)]
    mixed = measures.growth_vs_fragmentation(articles, amendments, proponents)
    assert rows(mixed, "atto_id", "num_clean", "num_emendamenti") == [("A", "1", 2), ("A", "2-bis", None), ("B", "1", 2)]


# ---- coalitions ----------------------------------------------------------------


def test_coalitions_of_the_published_table(spark):
    out = coalitions.coalitions(coalitions.italian_governments(spark), coalitions.italian_groups(spark), "2026-05-21")
    table = {(r.legislatura, r.pol_party): tuple(r)[3:] for r in out.collect()}
    assert len(table) == 80
    assert table[13, "DS-U"] == (1851, 4, 1851, 1, "Prodi I;D'Alema I;D'Alema II;Amato II", 1)
    assert table[13, "Democrazia Europea"] == (964, 3, 0, 0, "D'Alema I;D'Alema II;Amato II", 1)
    assert table[13, "AN"] == (0, 0, 0, 0, "", 0)
    assert table[19, "FdI"] == (1307, 1, 1307, 1, "Meloni", 1)
    assert coalitions.unknown_groups(coalitions.italian_governments(spark), coalitions.italian_groups(spark)).count() == 0


def test_side_totals_have_a_grand_total(spark):
    c = spark.createDataFrame([(13, 1), (13, 0), (14, 1)], "legislatura int, maggioranza int")
    assert rows(coalitions.side_totals(c)) == [(13, 2, 1, 1), (14, 1, 1, 0), (None, 3, 2, 1)]


# ---- triples --------------------------------------------------------------------


def test_entity_table_fans_out_and_requires(spark):
    t = spark.createDataFrame(
        [("a", "type", "C"), ("a", "name", "A"), ("a", "tag", "1"), ("a", "tag", "2"), ("a", "tag", "2"), ("b", "type", "C"), ("c", "name", "x")],
        "s string, p string, o string",
    )
    out = graph.entity_table(t, "C", {"name": "name"}, {}, {"tag": "tag"}, "type")
    assert rows(out) == [("a", "A", "1"), ("a", "A", "2")]


# ---- nested documents --------------------------------------------------------------


def test_nest_is_whole_and_bounded(spark):
    children = spark.range(5000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"), F.col("id").alias("v")
    )
    parts = flatten.nest(children, "k", F.col("v"), F.col("v"), "vs", per_part=100)
    sizes = [r.n for r in parts.select(F.size("vs").alias("n")).collect()]
    assert sum(sizes) == 5000 and max(sizes) < 200
    assert rows(parts.select("k", F.explode("vs"))) == rows(children)


def test_votes(spark):
    v = spark.createDataFrame([("v1", ["http://x/1", "http://x/2"], [], None)], "id string, si array<string>, no array<string>, ast array<string>")
    out = flatten.explode_votes(v, "id", {"favorevole": "si", "contrario": "no", "astenuto": "ast"})
    assert rows(out) == [("v1", "favorevole", "1"), ("v1", "favorevole", "2")]


def test_amendment_counts_equal_brute_force(spark):
    rnd = random.Random(4)
    links = [(e, "hot" if rnd.random() < 0.4 else f"s{rnd.randrange(5)}") for e in range(200)]
    links += [(e, f"s{rnd.randrange(5)}") for e in range(0, 200, 7)] + links[:20]  # several subjects, repeated rows
    about = [(s, f"b{rnd.randrange(8)}") for s in ["hot", "s0", "s1", "s2", "s3", "s4"] for _ in range(3)]
    has_file = lambda e: e % 3 == 0
    got = timeline.amendment_counts(
        spark.createDataFrame([(e, s, has_file(e)) for e, s in links], "emendamento_id int, oggetto string, akn boolean"),
        spark.createDataFrame(about, "oggetto string, id_fase string"),
        "akn",
    )
    want = []
    for b in {b for _, b in about}:
        found = {e for e, s in links for t, c in about if s == t and c == b}
        want.append((b, len(found), len({e for e in found if has_file(e)})))
    assert rows(got) == sorted(want)


# ---- shape and loads --------------------------------------------------------------------


def test_replace_partitions_keeps_the_others(spark):
    old = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "leg int, v string")
    new = spark.createDataFrame([(1, "z")], "leg int, v string")
    assert rows(shape.replace_partitions(old, new, ["leg"])) == [(1, "z"), (2, "c")]


def test_insert_absent_twice_is_once(spark):
    old = spark.createDataFrame([(1, "a")], "k int, v string")
    new = spark.createDataFrame([(1, "x"), (2, "y"), (2, "w")], "k int, v string")
    once = old.union(insert_absent(old, new, ["k"]))
    assert rows(once) == [(1, "a"), (2, "w")]
    assert insert_absent(once, new, ["k"]).count() == 0


def test_integrity_reports_missing_and_null(spark):
    df = spark.createDataFrame([(1, "a"), (1, None), (2, "b")], "leg int, v string")
    expected = spark.createDataFrame([(1, 2), (2, 1), (3, 5)], "leg int, n_atteso long")
    out = check_integrity(df, ["v"], ["leg"], expected)
    assert rows(out, "leg", "n", "n_atteso") == [(1, 2, 2), (3, 0, 5)]


def test_first_role_by_aggregates_equals_the_row_pick(spark):
    values = [(a, d, f, n) for a in "ab" for d in "pqr" for f in (True, False, None) for n in (None, 2, 1)]
    rng = random.Random(5)
    for size in (1, 5, 12, 40):
        df = spark.createDataFrame([rng.choice(values) for _ in range(size)], "act string, who string, first boolean, leg int")
        want = picks.first_per_key(df, ["act", "who"], [F.col("first").desc_nulls_last()])
        got = picks.first_role_wins(df, ["act", "who"], "first")
        assert got.columns == df.columns and got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
