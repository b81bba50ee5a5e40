"""Types and layouts that are found out, trees, near-equal titles, minutes and HTML blocks."""

import random
import threading

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from billtrace.operators.bulletins import block_text, html_blocks, read_blocks
from billtrace.operators.edits import within_edits
from billtrace.operators.minutes import voted_outcomes
from billtrace.sources.discovery import list_tree, write_tree
from billtrace.sources.inference import infer_types, merged_type, read_csv, read_documents_evolving

# ---- types


def test_one_late_value_makes_only_its_column_text(spark, tmp_path):
    n = 20_000
    df = spark.range(n).select(
        F.col("id").alias("whole"),
        F.when(F.col("id") == n - 1, "12a").otherwise(F.col("id").cast("string")).alias("late"),
        F.when(F.col("id") == n - 1, "1.5").otherwise(F.col("id").cast("string")).alias("late_double"),
        F.when(F.col("id") == 7, None).otherwise((F.col("id") % 2 == 0).cast("string")).alias("flag"),
        F.when(F.col("id") == 9, "2024-02-30").otherwise("2024-02-29").alias("no_day"),
        F.when(F.col("id") == 9, "2024-02-28 10:30").otherwise("2024-02-29").alias("moment"),
        F.lit("2024-02-29").alias("day"),
        F.when(F.col("id") == 3, "9223372036854775808").otherwise("1").alias("beyond"),
        F.lit(None).cast("string").alias("nothing"),
        F.lit("007").alias("zeros"),
        F.when(F.col("id") == 5, "").otherwise("1").alias("blank"),
    )
    df.repartition(9).write.option("header", True).option("emptyValue", "").csv(str(tmp_path / "x"))
    got = read_csv(spark, str(tmp_path / "x"))
    assert dict(got.dtypes) == {
        "whole": "bigint", "late": "string", "late_double": "double", "flag": "boolean", "no_day": "string", "moment": "timestamp",
        "day": "date", "beyond": "double", "nothing": "string", "zeros": "bigint", "blank": "bigint",
    }
    assert got.agg(F.sum("whole"), F.count("flag"), F.count("blank")).first()[:] == (n * (n - 1) // 2, n - 1, n - 1)
    assert dict(read_csv(spark, str(tmp_path / "x"), {"zeros": "string"}).dtypes)["zeros"] == "string"


def test_types_of_odd_tables(spark):
    assert infer_types(spark.createDataFrame([], "a string")) == {"a": "string"}
    assert infer_types(spark.createDataFrame([(1,)], "a int")) == {}
    assert infer_types(spark.createDataFrame([(" 1", "1"), ("2", "")], "`a.b` string, `a b` string")) == {"a.b": "string", "a b": "string"}
    one_pass = spark.createDataFrame([("1", "x")], "a string, b string")
    assert infer_types(one_pass) == {"a": "bigint", "b": "string"}


def test_layouts_merge():
    t = lambda s: T._parse_datatype_string(s)
    old = t("struct<a:int,b:struct<x:string>,c:array<struct<n:bigint>>>")
    new = t("struct<b:struct<y:int,x:string>,a:double,c:array<struct<n:double,m:int>>,d:boolean>")
    assert merged_type(old, new).simpleString() == "struct<a:double,b:struct<x:string,y:int>,c:array<struct<n:double,m:int>>,d:boolean>"
    assert merged_type(t("int"), t("array<int>")) == T.StringType() and merged_type(T.NullType(), t("date")) == T.DateType()


def test_documents_of_several_layouts(spark, tmp_path):
    texts = {"a": '{\n "id": 1,\n "x": {"n": 1}\n}', "b": '{"id": 2, "x": {"n": 2.5, "più": ["é"]}}', "c": '{"id": 3,\n "x": {', "d": "", "e": '{"id": 5}'}
    for name, text in texts.items():
        (tmp_path / f"{name}.json").write_text(text, encoding="utf-8")
    got = {r.path[-6:-5]: r for r in read_documents_evolving(spark, str(tmp_path)).collect()}
    assert (got["a"].id, got["a"].x.n, got["b"].x.n, got["b"].x["più"], got["e"].x) == (1, 1.0, 2.5, ["é"], None)
    assert got["c"].id is None and got["c"]._corrotto == texts["c"] and got["a"]._corrotto is None
    declared = T._parse_datatype_string("struct<id:bigint,note:string>")
    wide = read_documents_evolving(spark, str(tmp_path), declared)
    assert wide.columns[:2] == ["id", "note"] and wide.filter("id = 2").first().x.n == 2.5


def tasks_of(spark, work):
    """What ``work`` returns, and the most tasks that a stage of it has."""
    group = f"tasks-{random.random()}"
    spark.sparkContext.setJobGroup(group, "counted")
    try:
        out = work()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    tracker = spark.sparkContext.statusTracker()
    stages = [tracker.getStageInfo(s) for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds]
    return out, max(s.numTasks for s in stages if s)


def test_layouts_are_found_in_many_tasks(spark, tmp_path):
    for i in range(64):
        (tmp_path / f"{i}.json").write_text(f'{{"id": {i},\n "f{i % 3}": {i}}}')
    got, tasks = tasks_of(spark, lambda: read_documents_evolving(spark, str(tmp_path)))
    assert tasks >= 4 and got.agg(F.sum("id"), F.count("f0"), F.count("f2")).first()[:] == (2016, 22, 21)


def test_documents_in_other_encodings(spark, tmp_path):
    for i, code in enumerate(("utf-8", "utf-8-sig", "utf-16", "utf-16-le", "utf-16-be", "utf-32", "utf-32-le", "utf-32-be")):
        (tmp_path / f"{i}.json").write_bytes(f'{{"id": {i}, "t{i}": "è"}}'.encode(code))
    (tmp_path / "none.json").write_bytes(b'{"id": 9, "other": "\xff"}')
    got = {r.id: r for r in read_documents_evolving(spark, str(tmp_path)).collect() if r._corrotto is None}
    assert len(got) == 8 and all(got[i][f"t{i}"] == "è" for i in range(8)) and "other" not in got[0]


# ---- trees


def test_a_tree_from_one_partition_is_written_by_many_tasks(spark, tmp_path):
    df = spark.range(400).select(F.concat(F.lit("a"), F.col("id") % 9, F.lit("/b"), "id", F.lit(".txt")).alias("path"), F.lit("x").alias("content"))
    n, tasks = tasks_of(spark, lambda: write_tree(df.coalesce(1), str(tmp_path)))
    assert n == 400 == list_tree(spark, str(tmp_path)).count() and tasks >= spark.sparkContext.defaultParallelism


def test_many_folders_are_few_tasks(spark, tmp_path):
    for i in range(0, 8000):
        (tmp_path / f"d{i}").mkdir()
    _, tasks = tasks_of(spark, lambda: list_tree(spark, str(tmp_path)))
    assert tasks <= 4 * spark.sparkContext.defaultParallelism


def test_ten_thousand_folders(spark, tmp_path):
    df = spark.range(10_000).select(F.concat(F.lit("Leg"), F.col("id") % 7, F.lit("/Atto"), "id", F.lit("/ddl pres/é.xml")).alias("path"), F.col("id").cast("string").alias("content"))
    assert write_tree(df.repartition(8), str(tmp_path)) == 10_000
    (tmp_path / "Leg0" / "note.txt").write_text("xx")
    (tmp_path / "_hidden").mkdir()
    (tmp_path / "_hidden" / "y.xml").write_text("z")
    got = list_tree(spark, f"file:{tmp_path}", "*.xml")
    assert got.count() == 10_000 and got.agg(F.sum("length")).first()[0] == sum(len(str(i)) for i in range(10_000))
    assert got.filter(F.col("path") == f"{tmp_path}/Leg3/Atto3/ddl pres/é.xml").count() == 1
    assert list_tree(spark, str(tmp_path), depth=1).count() == 1 and list_tree(spark, str(tmp_path / "none")).count() == 0
    assert got.filter("modified IS NULL").count() == 0


# ---- titles


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


@pytest.mark.parametrize("d,q", [(1, 2), (2, 2), (2, 3), (3, 2)])
def test_pairs_within_edits_equal_all_pairs(spark, d, q):
    rnd = random.Random(d * 10 + q)
    texts = ["", "a", "b", "ab", "ba", "abc", "abcd", "aaaa", "aaaaaa", "é", "éa", None, None, "abc", "titolo", "x" * 80]
    texts += ["".join(rnd.choices("abé", k=rnd.randrange(0, 9))) for _ in range(120)]
    base = ["disegno di legge", "norme in materia di lavoro", "conversione del decreto"]
    for _ in range(60):
        t = list(rnd.choice(base))
        for _ in range(rnd.randrange(4)):
            i = rnd.randrange(len(t))
            t[i : i + rnd.randrange(2)] = rnd.choice(["", "z", "e", "ee"])
        texts.append("".join(t))
    df = spark.createDataFrame([(t, 1, 2) for t in texts], "titolo string, no int, rows int")
    got = {(r.a, r.b): (r.distanza, r.righe_a, r.righe_b) for r in within_edits(df, "titolo", d, q).collect()}
    known = sorted({t for t in texts if t is not None})
    want = {(a, b): (distance(a, b), texts.count(a), texts.count(b)) for i, a in enumerate(known) for b in known[i + 1 :] if distance(a, b) <= d}
    assert got == want
    assert within_edits(df, "titolo", d, q).count() == len(want)
    assert within_edits(df.limit(0), "titolo", d, q).count() == 0


def test_titles_are_not_compared_pairwise(spark):
    from billtrace.registry import REGISTRY

    plan = REGISTRY["t10_title_edits"](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


# ---- minutes


@pytest.mark.parametrize(
    "text,want",
    [
        ("Gli emendamenti 3.1, 3.2 e da 4.1 a 4.5 sono respinti.", [(1, "emendamento", n, "respinto") for n in ("3.1", "3.2", "4.1", "4.2", "4.3", "4.4", "4.5")]),
        ("L'emendamento 3.1 non è approvato.", [(1, "emendamento", "3.1", "respinto")]),
        ("L’ARTICOLO 2-bis\n è stato   APPROVATO, l'articolo 3 non è stato ritirato", [(1, "articolo", "2-bis", "approvato"), (2, "articolo", "3", "non ritirato")]),
        ("I subemendamenti 0.3.1 ed 0.3.2, nonché 0.4.1 risultano preclusi", [(1, "subemendamento", n, "precluso") for n in ("0.3.1", "0.3.2", "0.4.1")]),
        ("Emendamenti dal 4.9 al 5.2 sono dichiarati inammissibili", [(1, "emendamento", n, "inammissibile") for n in ("4.9", "5.2")]),  # no count from 4.9 to 5.2
        ("Gli emendamenti da 1.5 a 1.3 sono accolti", [(1, "emendamento", n, "approvato") for n in ("1.5", "1.3")]),
        ("Gli emendamenti da 1.1 a 1.999999 sono ritirati", [(1, "emendamento", n, "ritirato") for n in ("1.1", "1.999999")]),
        ("L'emendamento 3.1 è discusso. L'articolo 5 resta. Si approva il 6.", []),
        ("L'emendamento 3.1. È approvato.", []),
        ("Gli emendamenti 3.1, 3.1 sono respinti", [(1, "emendamento", "3.1", "respinto")] * 2),
        ("", []),
        (None, []),
    ],
)
def test_clauses(spark, text, want):
    got = voted_outcomes(spark.createDataFrame([(1, text, "x")], "k int, t string, p string"), "k", "t")
    assert sorted(tuple(r)[1:] for r in got.collect()) == sorted(want)


def test_a_long_sitting(spark):
    text = "parole senza voto, 12 e 13, " * 20_000 + "L'emendamento 3.1 è ritirato."
    assert voted_outcomes(spark.createDataFrame([(1, text)], "k int, t string"), "k", "t").count() == 1


# ---- bulletins

PAGE = """<html><head><title id=t>no</title><script>var a = '<a name="fake">x</a>';</script><style>a{}</style></head><body>prima
<a class="k" title="x > y" name='uno'></a><p>Testo <b>uni</b>to &egrave; &amp; altro<!-- <a name="commento">no</a> --><br>riga
<A NAME=due href="#">Due</A><table><tr><td>x<td>y</table><img src=a alt="<b>"><div id="tre" name="quattro"/>fine &#39;
<p id="">ancora"""


def test_blocks_are_read_as_a_browser_would(spark):
    want = [("t", "title", "no"), ("uno", "a", "Testo unito è & altro riga"), ("due", "a", "Due x y"), ("quattro", "div", "fine ' ancora")]
    want[0] = ("t", "title", "no prima")  # a block lasts until the next anchor
    assert read_blocks(PAGE) == want
    df = spark.createDataFrame([(1, PAGE), (2, None), (3, ""), (4, "<a name=x>1</a><a name=x>2"), (5, "<a name='open")], "k int, html string")
    got = {r.k: [tuple(b) for b in r.b] for r in df.select("k", html_blocks("html").alias("b")).collect()}
    assert got == {1: want, 2: [], 3: [], 4: [("x", "a", "1"), ("x", "a", "2")], 5: []}
    assert [r.t for r in df.orderBy("k").select(block_text("html", "x").alias("t")).collect()] == [None, None, None, "1", None]
    assert [r.t for r in df.orderBy("k").select(block_text("html", "due").alias("t")).collect()][0] == "Due x y"


def test_a_large_page(spark):
    html = "<a id=1>" + "<p>parola &amp; " * 100_000
    assert len(read_blocks(html)[0][2]) == 100_000 * 9 - 1


def test_few_titles_are_compared_by_all_cores(spark):
    df = spark.range(120).select(F.concat(F.lit("Supplier#0000"), F.lpad(F.col("id").cast("string"), 3, "0")).alias("t")).coalesce(1)
    pairs = within_edits(df, "t", 2)
    n, tasks = tasks_of(spark, lambda: pairs.agg(F.count("*")).first()[0])
    texts = [f"Supplier#0000{i:03d}" for i in range(120)]
    assert n == sum(distance(a, b) <= 2 for i, a in enumerate(texts) for b in texts[:i]) and tasks >= spark.sparkContext.defaultParallelism


def test_titles_with_common_parts_meet_in_few_places(spark):
    """Numbers behind one word share their few pairs of digits with a large part of all others, and all of these met."""
    rnd = random.Random(7)
    numbers = rnd.sample(range(10**9), 40_000)
    numbers += [n + 1 for n in numbers[:50] if n + 1 not in numbers]
    df = spark.createDataFrame([(f"Supplier#{n:09d}",) for n in numbers], "t string")
    late = threading.Timer(100, spark.sparkContext.cancelAllJobs)
    late.start()
    try:
        got = {(r.a, r.b): r.distanza for r in within_edits(df, "t", 2).collect()}
    finally:
        late.cancel()
    assert len(got) >= 50 and all(distance(a, b) == d <= 2 for (a, b), d in got.items())
    patterns = {}
    for t in (f"Supplier#{n:09d}" for n in numbers):
        for i in range(9, 18):
            for j in range(i + 1, 18):
                patterns.setdefault((i, j, t[:i] + t[i + 1 : j] + t[j + 1 :]), []).append(t)
    near = {(min(a, b), max(a, b)) for same in patterns.values() for a in same for b in same if a != b}
    assert near <= set(got)
