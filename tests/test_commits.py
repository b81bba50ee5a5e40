"""Commits of table sets, loads that recover, and what happens when they fail half way."""

import os

import pytest
from pyspark.sql import functions as F

from billtrace.sources import versions
from billtrace.sources.versions import Conflict, commit, load_missing, manifest, partitions, read, vacuum
from billtrace.streaming.ledger import ledger, load_files, loaded, stream_into, waiting


def files_below(root):
    return {os.path.join(d, f): os.stat(os.path.join(d, f)).st_mtime_ns for d, _, names in os.walk(root) for f in names if f.endswith(".parquet")}


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


@pytest.fixture
def acts(spark):
    values = [(1, 13, "a"), (2, 13, "b"), (3, 14, "c"), (3, 14, "c"), (4, None, "d")]
    return spark.createDataFrame(values, "id long, leg int, v string")


def test_untouched_partitions_keep_their_files(spark, tmp_path, acts):
    root = str(tmp_path / "set")
    commit(spark, root, {"t": (acts, ["leg"])})
    before = {r.leg: r.path for r in partitions(spark, root, "t").collect()}
    times = files_below(root)
    commit(spark, root, {"t": (spark.createDataFrame([(9, 14, "z")], "id long, leg int, v string"), ["leg"])})
    after = {r.leg: r.path for r in partitions(spark, root, "t").collect()}
    assert set(after) == {"13", "14", None}
    assert after["13"] == before["13"] and after[None] == before[None] and after["14"] != before["14"]
    now = files_below(root)
    assert all(now[f] == t for f, t in times.items())  # nothing was touched, not even what was replaced
    assert rows(read(spark, root, "t")) == [(1, 13, "a"), (2, 13, "b"), (4, None, "d"), (9, 14, "z")]
    assert rows(read(spark, root, "t", version=1)) == rows(acts)  # a reader of the old version still has it
    assert rows(read(spark, root, "t", only=lambda v: v == ["14"])) == [(9, 14, "z")]
    gone = vacuum(spark, root)
    assert gone == [before["14"]] and versions.versions(spark, root) == [2]
    assert len(rows(read(spark, root, "t"))) == 4


def test_partition_values_that_folders_confuse(spark, tmp_path):
    values = [("", 1), (None, 2), ("a b", 3), ("a/b=c", 4), ("è%20", 5), ("null", 6), ("[x]*", 7)]
    df = spark.createDataFrame(values, "p string, n int")
    root = str(tmp_path / "set")
    commit(spark, root, {"t": (df, ["p"])})
    assert sorted((r.p or "", r.n) for r in partitions(spark, root, "t").collect()) == sorted((p or "", 1) for p, _ in values)
    commit(spark, root, {"t": (spark.createDataFrame([("", 9)], df.schema), ["p"])})
    got = {(r.p, r.n) for r in read(spark, root, "t").collect()}
    assert got == {(p, 9 if p == "" else n) for p, n in values}


def test_a_failed_write_leaves_every_table_as_it_was(spark, tmp_path, acts):
    root = str(tmp_path / "set")
    commit(spark, root, {"a": (acts, ["leg"]), "b": (acts, [])}, rebuild=True)
    breaks = acts.withColumn("v", F.when(F.col("id") > 2, F.raise_error(F.lit("broken")).cast("string")).otherwise("new"))
    with pytest.raises(Exception, match="broken"):
        commit(spark, root, {"a": (acts.limit(1), ["leg"]), "b": (breaks, [])}, rebuild=True)
    assert manifest(spark, root).version == 1
    assert rows(read(spark, root, "a")) == rows(read(spark, root, "b")) == rows(acts)

    def crash():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        commit(spark, root, {"a": (acts.limit(0), ["leg"])}, rebuild=True, before_publish=crash)
    assert set(manifest(spark, root).tables) == {"a", "b"}
    commit(spark, root, {"b": (acts.limit(0), [])}, rebuild=True)
    assert set(manifest(spark, root).tables) == {"b"} and rows(read(spark, root, "b")) == []
    assert vacuum(spark, root) and rows(read(spark, root, "b")) == []


def test_of_two_writers_one_starts_again(spark, tmp_path, acts):
    root = str(tmp_path / "set")
    commit(spark, root, {"t": (acts, [])})
    with pytest.raises(Conflict):
        commit(spark, root, {"t": (acts, [])}, append=True, before_publish=lambda: commit(spark, root, {"t": (acts.limit(1), [])}, append=True))
    assert manifest(spark, root).version == 2 and read(spark, root, "t").count() == 6


def test_columns_may_be_added_but_not_changed(spark, tmp_path, acts):
    root = str(tmp_path / "set")
    commit(spark, root, {"t": (acts, ["leg"])})
    commit(spark, root, {"t": (acts.filter("leg = 14").withColumn("more", F.lit(1)), ["leg"])})
    assert {(r.id, r.more) for r in read(spark, root, "t").collect()} == {(1, None), (2, None), (3, 1), (4, None)}
    with pytest.raises(ValueError, match="column v"):
        commit(spark, root, {"t": (acts.withColumn("v", F.lit(1)), ["leg"])})
    with pytest.raises(ValueError, match="partitioned"):
        commit(spark, root, {"t": (acts, [])})


def test_only_missing_partitions_are_loaded(spark, tmp_path, acts):
    root = str(tmp_path / "set")
    assert load_missing(spark, root, "t", acts, "leg", [13]) == [13]
    assert load_missing(spark, root, "t", acts.withColumn("v", F.lit("new")), "leg", [13, 14, None, 99]) == [14, None, 99]
    assert rows(read(spark, root, "t")) == [(1, 13, "a"), (2, 13, "b"), (3, 14, "new"), (3, 14, "new"), (4, None, "new")]
    assert load_missing(spark, root, "t", acts, "leg", [13, None]) == []
    assert load_missing(spark, root, "t", acts.withColumn("v", F.lit("forced")), "leg", [13], force=True) == [13]
    assert {(r.leg, r.v) for r in read(spark, root, "t").collect()} == {(13, "forced"), (14, "new"), (None, "new")}


def drop(folder, names, text="x"):
    folder.mkdir(exist_ok=True)
    for n in names:
        (folder / f"{n}.txt").write_text(text * 300 if n != "small" else text, encoding="utf-8")


def plain(batch):
    return batch.select("path", F.decode("content", "UTF-8").alias("t"))


def outcome(run):
    try:
        run.awaitTermination()
    except Exception as e:
        return str(e)
    return None


def test_stream_recovers_from_a_parser_that_breaks_and_from_death_after_a_commit(spark, tmp_path):
    folder, root, state = tmp_path / "in", str(tmp_path / "set"), str(tmp_path / "state")
    drop(folder, range(11))
    seen = []

    def breaks(batch):
        if seen:
            return plain(batch).withColumn("t", F.raise_error(F.lit("bad file")).cast("string"))
        return plain(batch)

    args = (spark, str(folder))
    assert "bad file" in outcome(stream_into(*args, breaks, root, "t", state, "*.txt", 3, seen.append))
    assert seen == [0] and read(spark, root, "t").count() == 3  # nothing of the second batch

    def dies(number):
        raise RuntimeError("dead")

    assert "dead" in outcome(stream_into(*args, plain, root, "t", state, "*.txt", 3, dies))
    assert read(spark, root, "t").count() == 6  # published, but the checkpoint doesn't know
    again = []
    assert outcome(stream_into(*args, plain, root, "t", state, "*.txt", 3, again.append)) is None
    assert again == [2, 3]  # batch 1 came again and was recognised
    got = read(spark, root, "t")
    assert got.count() == got.select("path").distinct().count() == 11
    assert outcome(stream_into(*args, plain, root, "t", state, "*.txt", 3, again.append)) is None
    assert again == [2, 3]


def test_ledger_parses_new_changed_and_small_outputs_once(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "set")
    drop(folder, ["a", "b", "small", "[odd] {name}*"])

    def load(parser=plain, **kw):
        return load_files(spark, str(folder), parser, root, "t", F.octet_length("t"), "*.txt", max_files=3, **kw)

    def crash():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        load(before_publish=crash)
    assert ledger(spark, root, "t").count() == 0
    assert load() == 2  # four files, three at a time
    tries = lambda: {r.path.rsplit("/", 1)[1]: r.tries for r in ledger(spark, root, "t").collect()}
    assert tries() == {"a.txt": 1, "b.txt": 1, "small.txt": 1, "[odd] {name}*.txt": 1}
    assert load(lambda b: plain(b).withColumn("t", F.repeat("t", 300))) == 1  # the small one alone, and once
    assert tries()["small.txt"] == 2 and load() == 0
    got = {r.path.rsplit("/", 1)[1]: len(r.t) for r in loaded(spark, root, "t").collect()}
    assert got == {"a.txt": 300, "b.txt": 300, "small.txt": 300, "[odd] {name}*.txt": 300}
    drop(folder, ["a"], "yy")
    drop(folder, ["c"])
    assert load() == 1
    assert tries()["a.txt"] == 1 and loaded(spark, root, "t").count() == 5
    assert {r.t[:1] for r in loaded(spark, root, "t").collect() if r.path.endswith("/a.txt")} == {"y"}
    assert read(spark, root, "t").count() == 7  # older loads stay in the table, and out of what is loaded


def test_a_file_without_output_is_tried_twice(spark, tmp_path):
    folder, root = tmp_path / "in", str(tmp_path / "set")
    drop(folder, ["a"])
    nothing = lambda b: plain(b).limit(0)
    load = lambda: load_files(spark, str(folder), nothing, root, "t", F.octet_length("t"))
    assert [load(), load(), load()] == [1, 1, 0] and loaded(spark, root, "t").count() == 0
    empty = spark.createDataFrame([], "path string, length long, modificationTime timestamp")
    assert waiting(empty, ledger(spark, root, "t")).count() == 0
