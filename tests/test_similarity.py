"""Similar texts and clusters against brute force."""

import os
import random
from urllib.parse import unquote, urlparse

import numpy as np
import pytest

from billtrace.operators import joins, parity, similarity


def runs(text, n=3):
    words = text.lower().split()
    return {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))}


def jac(a, b):
    x, y = runs(a), runs(b)
    return len(x & y) / len(x | y)


def components(nodes, edges):
    parent = {v: v for v in nodes}

    def root(v):
        while parent[v] != v:
            v = parent[v]
        return v

    for a, b in edges:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    touched = {v for e in edges for v in e}
    return {v: root(v) for v in touched}


@pytest.mark.parametrize("seed", [0, 1])
def test_components_equal_union_find(spark, seed):
    rnd = random.Random(seed)
    chain = [(i, i + 1) for i in range(100, 140)]  # long path
    star = [(0, i) for i in range(1, 40)]  # hot node
    loose = [(rnd.randrange(200, 260), rnd.randrange(200, 260)) for _ in range(40)]
    edges = [e for e in chain + star + loose if e[0] != e[1]]
    rnd.shuffle(edges)
    df = spark.createDataFrame([(b, a) if rnd.random() < 0.5 else (a, b) for a, b in edges], "a long, b long")
    got = {r.id: r.cluster for r in similarity.clusters(df).collect()}
    assert got == components(range(300), edges)


def test_no_edges(spark):
    assert similarity.clusters(spark.createDataFrame([], "a long, b long")).count() == 0


def test_few_edges_cost_few_tasks(spark, tmp_path):
    """Each table of a round was written by as many tasks as shuffles have partitions, and a round was run to see that nothing changes."""
    path, partitions = f"{tmp_path}/edges", 64
    spark.createDataFrame([(1, 2), (2, 3), (5, 4), (5, 6), (7, 8)], "a long, b long").write.parquet(path)
    flat = f"{tmp_path}/flat"
    spark.createDataFrame([(0, i) for i in range(1, 40)], "a long, b long").write.parquet(flat)
    written, plain = [], similarity.staged

    def seen(df, label, *rows):
        out = plain(df, label, *rows)
        written.append(len(out.inputFiles()))
        return out

    keys = {"spark.sql.shuffle.partitions": str(partitions), "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in keys}
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(similarity, "staged", seen)
        patch.setattr(joins, "staged", seen)
        for k, v in keys.items():
            spark.conf.set(k, v)
        try:
            got = {r.id: r.cluster for r in similarity.clusters(spark.read.parquet(path), rows=5).collect()}
            rounds = len(written)
            star = {r.id: r.cluster for r in similarity.clusters(spark.read.parquet(flat), rows=40).collect()}
        finally:
            for k, v in before.items():
                spark.conf.set(k, v)
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 4, 7: 7, 8: 7}
    assert star == {i: 0 for i in range(40)}
    assert rounds <= 9 and len(written) == rounds + 1
    assert max(written) <= spark.sparkContext.defaultParallelism


def corpus(seed):
    """Unrelated texts, a hot family of copies and near copies, and a family of its own."""
    rnd = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = {i: " ".join(rnd.choices(vocabulary, k=80)) for i in range(40)}
    hot = " ".join(rnd.choices(vocabulary, k=120))
    for i in range(40, 70):  # copies up to white space, and near copies
        words = hot.split()
        if i % 2:
            words[i % 120] = f"new{i}"
        texts[i] = ("  " if i % 3 else " ").join(words)
    for i in range(70, 76):
        texts[i] = texts[3] + f" coda{i}"
    texts[80], texts[81] = "a", "a"
    return texts


@pytest.mark.parametrize("seed", [5, 6])
def test_pairs_and_clusters(spark, seed):
    texts = corpus(seed)
    df = spark.createDataFrame(list(texts.items()), "id long, t string").repartition(5)
    pairs = similarity.similar_pairs(df, "id", "t", num=80, den=100)
    got = {(r.a, r.b): r.similarita for r in pairs.collect()}
    for (a, b), s in got.items():
        assert s == pytest.approx(jac(texts[a], texts[b]))
    assert len(got) < 2 * len(texts)  # links, not all pairs of the hot family
    brute = [(a, b) for a in texts for b in texts if a < b and jac(texts[a], texts[b]) >= 0.8]
    clusters = {r.id: r.cluster for r in similarity.clusters(pairs).collect()}
    assert clusters == components(texts, brute)


def test_chains_are_followed_and_boilerplate_ends(spark):
    """Chains whose ends are not similar stay whole; texts that share much but not enough cost few rounds."""
    rnd = random.Random(1)
    texts = {}
    for c in range(20):
        words = [f"c{c}w{i}" for i in range(60)]
        for k in range(3):
            texts[c * 10 + k] = " ".join(words)
            words[20 * k : 20 * k + 3] = [f"x{rnd.random()}" for _ in range(3)]
    common = " ".join(f"b{i}" for i in range(30))
    for i in range(120):
        texts[1000 + i] = common + " " + " ".join(f"y{i}z{j}" for j in range(30))
    df = spark.createDataFrame(list(texts.items()), "id long, t string")
    got = {r.id: r.cluster for r in similarity.similar_clusters(df, "id", "t").collect()}
    brute = [(a, b) for a in texts for b in texts if a < b and jac(texts[a], texts[b]) >= 0.8]
    assert got == components(texts, brute)


def test_distance(spark):
    df = spark.createDataFrame([("a b c d", "a b c x"), ("a", "A"), ("a b", "c")], "x string, y string")
    got = [r.similarita for r in similarity.text_distance(df, "x", "y").collect()]
    assert got == [pytest.approx(1 / 3), 1.0, 0.0]


def test_sets_of_long_texts_move_for_near_pairs_only(spark, monkeypatch):
    g = random.Random(5)
    common = " ".join(f"c{i}" for i in range(900))
    texts = [common + " " + " ".join(f"w{g.randrange(10**9)}" for _ in range(2100)) for _ in range(40)]
    texts += [t + " fine" for t in texts[:3]]
    scored, moved = similarity._scored, []
    monkeypatch.setattr(similarity, "_scored", lambda pairs, sets: moved.append(pairs.count()) or scored(pairs, sets))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.id, r.cluster) for r in similarity.similar_clusters(df, "id", "text").collect()}
    assert got == {(i, i % 40) for i in (0, 1, 2, 40, 41, 42)}
    assert 3 <= sum(moved[:-1]) <= 12  # 903 pairs share elements of their prefixes


def test_growing_sketches_leave_every_near_pair_open(spark):
    g = random.Random(6)
    sets = [sorted({g.getrandbits(64) - 2**63 for _ in range(n)}) for n in (1, 2, 63, 64, 65, 127, 128, 129, 500, 1000, 1030)]
    near = [sorted({*s[: max(1, len(s) * 9 // 10)], *(g.getrandbits(64) - 2**63 for _ in range(len(s) // 20))}) for s in sets]
    rows = [*enumerate(sets), *((100 + i, s) for i, s in enumerate(near))]
    pairs = [(i, 100 + j) for i in range(len(sets)) for j in range(len(sets))]
    share = lambda i, j: len(set(sets[i]) & set(near[j])) * 100 >= 80 * len(set(sets[i]) | set(near[j]))
    sketches = similarity._sketches(spark.createDataFrame(rows, "id long, s array<long>"))
    got = {(r.a, r.b) for r in similarity._open(spark.createDataFrame(pairs, "a long, b long"), sketches, 80, 100).collect()}
    assert {(i, j) for i, j in pairs if share(i, j - 100)} <= got and all(len(sets[a]) < 64 or share(a, b - 100) for a, b in got if 0.8 * len(near[b - 100]) <= len(sets[a]) <= len(near[b - 100]) / 0.8)


def test_sets_are_written_for_near_pairs_only(spark, monkeypatch):
    """The sets of all texts were written, and their prefixes sent with sketches."""
    g = random.Random(8)
    texts = [" ".join(f"w{g.randrange(10**6)}" for _ in range(1500)) for _ in range(200)]
    texts += [t + " fine" for t in texts[:4]]
    written, plain = [], similarity.staged

    def seen(df, label, *rows):
        out = plain(df, label, *rows)
        written.append(sum(os.path.getsize(unquote(urlparse(f).path)) for f in out.inputFiles()))
        return out

    monkeypatch.setattr(similarity, "staged", seen)
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.a, r.b) for r in similarity.similar_pairs(df, "id", "text").collect()}
    assert got == {(i, 200 + i) for i in range(4)}
    assert sum(written) < 0.4 * 8 * 1498 * len(texts)


def test_similar_sets_share_a_strong_block():
    rnd, bands = random.Random(3), parity.Bands(80, 100)
    for _ in range(400):
        n = rnd.choice([1, 2, 3, 4, 5, 6, 7, 9, 12, 20, 50, 130, 700])
        a = {rnd.getrandbits(64) for _ in range(n)}
        b, gone = set(a), rnd.randrange(0, n // 5 + 1)
        b -= set(rnd.sample(sorted(b), gone))
        while True:
            more = b | {rnd.getrandbits(64)}
            if 100 * len(a & more) < 80 * len(a | more):
                break
            b = more
        assert 100 * len(a & b) >= 80 * len(a | b)
        keys = [set(parity.strong_keys(np.array(sorted(own), np.uint64), bands).tolist()) for own in (a, b)]
        assert a == b or keys[0] & keys[1]


def test_a_common_passage_makes_few_texts_meet(spark, monkeypatch):
    """A text met all others by each element of the passage that is among the first of its own."""
    g = random.Random(9)
    common = " ".join(f"c{i}" for i in range(300))
    texts = [common + " " + " ".join(f"w{g.randrange(10**9)}" for _ in range(700)) for _ in range(100)]
    texts += [t + " fine" for t in texts[:3]]
    linked, met = similarity._linked_members, []
    monkeypatch.setattr(similarity, "_linked_members", lambda members, *rest: met.append(members.filter("id BETWEEN 3 AND 99").count()) or linked(members, *rest))
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    got = {(r.id, r.cluster) for r in similarity.similar_clusters(df, "id", "text").collect()}
    assert got == {(i, i % 100) for i in (0, 1, 2, 100, 101, 102)}
    assert sum(met) < 20 * len(texts)
