"""Vector codes, the permutation index and importance resampling against plain versions."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest

from billtrace.llm import importance, permutation_index, queries, vector_codes
from billtrace.llm.common import ready

SF = "/root/testdata/sf0.01"

# ---- vector codes


def plain_codes(rows, parts, entries, rounds, scale=4096):
    """Rounds over all entries, with Python's integers."""
    kept = [(i, [math.floor(scale * x) for x in v], label) for i, v, label in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    lengths = collections.Counter(len(v) for _, v, _ in kept)
    if not kept:
        return []
    size = max(lengths, key=lambda n: (lengths[n], n))
    kept = [r for r in kept if len(r[1]) == size]
    order = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))[:entries]
    w = size // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[cut(v, p) for _, v, _ in order] for p in range(parts)]
    near = lambda x, book: min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))
    for _ in range(rounds):
        for p in range(parts):
            members = collections.defaultdict(list)
            for _, v, _ in kept:
                members[near(cut(v, p), books[p])[1]].append(cut(v, p))
            for e, m in members.items():
                books[p][e] = [sum(c) // len(m) for c in zip(*m, strict=True)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out, errors = [], collections.Counter()
    for i, v, label in kept:
        found = [near(cut(v, p), books[p]) for p in range(parts)]
        errors[label] += sum(d for d, _ in found)
        out.append((i, "".join(f"{e:02x}" for _, e in found), sum(d for d, _ in found), label))
    return sorted([(i, code, error, errors[label], digest) for i, code, error, label in out], key=repr)


def coded(df, **kw):
    return sorted([(r.id, r.code, r.error, r.label_error, r.codebooks_sha256) for r in vector_codes.compress(df, **kw).collect()], key=repr)


VECTORS = "vec_id long, embedding array<double>, label int, x string, part int, n int"


def frame(spark, rows):
    return ready(spark).createDataFrame([(*r, "x", 1, 2) for r in rows], VECTORS)


@pytest.mark.parametrize("seed,n,size,parts,entries,rounds", [(1, 300, 8, 2, 16, 6), (2, 200, 6, 3, 8, 9), (3, 60, 4, 4, 40, 4), (4, 9, 4, 2, 16, 6), (5, 1, 2, 2, 16, 3)])
def test_codes_equal_plain_rounds(spark, seed, n, size, parts, entries, rounds):
    g = random.Random(seed)
    centres = [[g.uniform(-1, 1) for _ in range(size)] for _ in range(6)]
    rows = [(i, [c + g.gauss(0, 0.2 if i % 3 else 0.001) for c in g.choice(centres)], g.choice([None, 1, 2])) for i in range(n)]
    got = coded(frame(spark, rows).repartition(5), parts=parts, entries=entries, rounds=rounds)
    assert got == plain_codes(rows, parts, entries, rounds)


def test_codes_of_coarse_vectors_have_ties(spark):
    g = random.Random(9)
    rows = [(i, [g.choice([-0.5, 0.0, 0.5]) for _ in range(4)], 0) for i in range(400)]
    kw = dict(parts=2, entries=9, rounds=6, scale=4)
    assert coded(frame(spark, rows), **kw) == plain_codes(rows, 2, 9, 6, 4)


def test_codes_of_odd_rows(spark):
    v = [0.25, -0.5, 0.75, 1.0]
    rows = [
        (5, v, 1), (5, v, 1), (5, [0.0] * 4, None), (None, [1.0, 1.0, 1.0, 1.0], None), (1, None, 1), (2, [1.0, None, 1.0, 1.0], 1), (3, [float("nan")] * 4, 1),
        (4, [float("inf"), 0.0, 0.0, 0.0], 1), (6, [1.0, 2.0], 1), (7, [], 1), (8, [-0.00001, 0.0, 0.0, 0.0], 2),
    ]
    want = plain_codes(rows, 2, 3, 6)
    assert len(want) == 5 and coded(frame(spark, rows), parts=2, entries=3) == want
    assert coded(frame(spark, rows).limit(0)) == [] and coded(frame(spark, [(1, v, 1)]), parts=3) == []
    assert coded(frame(spark, [(1, None, 1)])) == []
    with pytest.raises(Exception, match="beyond"):
        coded(frame(spark, [(1, [1e9] * 4, 1)]), parts=2)


def test_bounds_leave_most_parts_alone(spark):
    rows = ready(spark).read.parquet(f"{SF}/embeddings.parquet").collect()
    x = np.floor(4096 * np.array([r.embedding for r in rows], "float64")).astype("int64")[:, :8]
    book, part = x[:16].copy(), vector_codes.Bounds(len(x), 4)
    part.search(np.arange(len(x)), x, book)
    looked = []
    for _ in range(6):
        moved = np.array([x[part.assigned == e].sum(axis=0) // max((part.assigned == e).sum(), 1) if (part.assigned == e).any() else book[e] for e in range(16)])
        part.moved(np.sqrt(np.square(moved - book).sum(axis=1).astype("float64")), 4)
        book = moved
        part.settle(x, book)
        d = np.square(x[:, None] - book).sum(axis=2)
        assert (part.assigned == d.argmin(axis=1)).all()  # the first of equals
        root = np.sqrt(d.astype("float64"))
        assert (part.upper >= root[np.arange(len(x)), part.assigned]).all()
        others = np.ones_like(d, bool)
        others[np.arange(len(x)), part.assigned] = False
        for z in range(4):
            at = part.near[:, z]
            assert (part.lower[:, z] <= root[np.arange(len(x)), at]).all()
            others[np.arange(len(x)), at] = False
        assert (np.where(others, root, np.inf).min(axis=1) >= part.outer).all()
        looked.append((part.depth == 5).mean())
    assert looked[-1] < 0.5


# ---- permutation index


def dot(a, b):
    """Added up from the first to the last; Python's sum() corrects its rounding."""
    out = 0.0
    for x, y in zip(a, b, strict=True):
        out += float(x) * float(y)
    return out


def plain_nearest(rows, k, every):
    kept = [(i, np.array(v, "float64")) for i, v in rows if v is not None and v and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    out = {}
    for at, (i, q) in enumerate(kept):
        if i is not None and i % every == 0:
            scored = [(-dot(q, v), j is None, j or 0, j) for other, (j, v) in enumerate(kept) if other != at]
            out.setdefault(i, []).append([(j, -s) for s, _, _, j in sorted(scored)[:k]])
    return out


def found(df, **kw):
    rows = collections.defaultdict(dict)
    for r in permutation_index.nearest(df, **kw).collect():
        rows[r.query_id].setdefault(r["rank"], []).append((r.id, r.score))
    return rows


def test_all_candidates_of_a_small_table_are_found(spark):
    g = random.Random(3)
    rows = [(i, [g.gauss(0, 1) * (1 + i % 5) for _ in range(6)], i) for i in range(90)]  # norms differ widely
    got = found(frame(spark, rows), k=7, every=10)
    want = plain_nearest([r[:2] for r in rows], 7, 10)
    assert set(got) == set(want)
    for i, [near] in want.items():
        assert [got[i][n + 1][0][0] for n in range(7)] == [j for j, _ in near]
        assert [got[i][n + 1][0][1] for n in range(7)] == [s for _, s in near]


def test_copies_ties_and_odd_vectors(spark):
    v, w = [1.0, 0.0, 0.0], [0.9, 0.1, -0.0]
    rows = [(i, v, 0) for i in range(1, 300)] + [(40, w, 0), (60, v, 0), (60, v, 0), (None, v, 0), (400, [0.0] * 3, 0), (420, None, 0), (440, [1.0, None, 0.0], 0), (460, [float("nan")] * 3, 0), (480, [5.0], 0), (500, [-1.0, 0.0, 0.0], 0)]
    df = frame(spark, rows)
    got = found(df)
    want = plain_nearest([(i, x) for i, x, _ in rows if x != [5.0]], 20, 20)
    assert set(got) == set(want) and 480 not in got and 400 not in got
    for i, answers in want.items():
        for n in range(20):
            assert sorted(got[i][n + 1]) == sorted(a[n] for a in answers), (i, n)
    assert got[500][1][0] == (40, -0.9)
    assert found(df.limit(0)) == {} and found(df.filter("vec_id = 7")) == {}
    assert found(frame(spark, [(20, v, 0)])) == {}
    few = found(frame(spark, [(20, v, 0), (None, w, 0)]))
    assert few == {20: {1: [(None, 0.9)]}}


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_recall_against_brute_force(spark, sf):
    """At least 0.9 of the true neighbours, and exact scores."""
    rows = ready(spark).read.parquet(f"/root/testdata/{sf}/embeddings.parquet").collect()
    ids, x = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], "float64")
    got = collections.defaultdict(dict)
    for r in queries.QUERIES["op13_permutation_index"](spark, f"/root/testdata/{sf}").collect():
        got[r.query_id][r["rank"]] = (r.vec_id, r.score)
    asked, hits = np.flatnonzero(ids % 20 == 0), 0
    place = {int(i): n for n, i in enumerate(ids)}
    for q in asked:
        score = x @ x[q]
        score[q] = -np.inf
        hits += len({int(ids[n]) for n in np.lexsort((ids, -score))[:20]} & {i for i, _ in got[ids[q]].values()})
        near = [got[ids[q]][n] for n in range(1, 21)]
        assert near == sorted(near, key=lambda a: (-a[1], a[0])) and ids[q] not in {i for i, _ in near}
        assert all(s == dot(x[q], x[place[i]]) for i, s in near[:3])
    assert set(got) == set(ids[asked].tolist()) and hits / 20 / len(asked) >= 0.9


def test_every_row_is_posted_and_footrule_is_a_distance():
    g = np.random.default_rng(5)
    x, pivots = g.standard_normal((700, 12)), g.standard_normal((40, 13))
    block = permutation_index.Block(x, pivots, 6.0)
    assert sum(map(len, block.posted)) == 700 * permutation_index.POSTED
    assert (np.sort(block.places, axis=0) == np.arange(40)[:, None]).all()
    lifted = permutation_index.lifted(x, 6.0)
    assert np.allclose(np.linalg.norm(lifted, axis=1), 6.0)


# ---- importance resampling


def plain_words(text):
    low = re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", low)


def plain_resample(docs, target, longest=1, buckets=10_000, least=20, percent=10, seed=2024):
    def features(text):
        w = plain_words(text)
        return [zlib.crc32(" ".join(w[i : i + n]).encode()) % buckets for n in range(1, longest + 1) for i in range(len(w) - n + 1)]

    s, t = (collections.Counter(b for text in texts for b in features(text)) for texts in ([d[1] for d in docs], target))
    ns, nt = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (ns + buckets) / ((s[b] + 1) * (nt + buckets))))
    rows = []
    for i, text in docs:
        own = features(text)
        weight = sum(map(gain, own)) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), len(plain_words(text)) >= least))
    fit = sorted((r for r in rows if r[4]), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    drawn = percent * len(fit) // 100
    ranks = {id(r): n + 1 for n, r in enumerate(fit[:drawn])}
    return sorted([(*r[:4], ranks.get(id(r))) for r in rows], key=repr)


def drawn(df, target, **kw):
    return sorted([tuple(r) for r in importance.resample(df, target, **kw).collect()], key=repr)


WORDS = [f"w{i}" for i in range(60)] + ["é", "Ünder", "x9", "漢字", "A.B", "don't"]


@pytest.mark.parametrize("seed,kw", [(1, {}), (2, {"longest": 3, "buckets": 97, "percent": 33}), (3, {"buckets": 64, "least_words": 1, "percent": 100, "seed": 7})])
def test_weights_and_ranks_equal_plain_sums(spark, seed, kw):
    g = random.Random(seed)
    docs = [(i, " ".join(g.choices(WORDS, k=g.randrange(0, 60)))) for i in range(200)] + [(900, None), (901, ""), (None, "w1 " * 30), (902, " ".join(g.choices(WORDS, k=20_000)))]
    target = [" ".join(g.choices(WORDS[:12], k=40)) for _ in range(5)] + [None, ""]
    df = ready(spark).createDataFrame([(*d, "x", 1, 1) for d in docs], "doc_id long, text string, score string, tie int, part int").repartition(6)
    names = {"least_words": "least"}
    assert drawn(df, spark.createDataFrame([(t,) for t in target], "text string"), **kw) == plain_resample(docs, target, **{names.get(k, k): v for k, v in kw.items()})


def test_ranks_over_several_ranges(spark, monkeypatch):
    monkeypatch.setattr(importance, "ROWS_PER_RANGE", 7)
    docs = [(i, "w1 w2 " * 12 if i % 2 else "w3 " * 25) for i in range(150)]
    df = ready(spark).createDataFrame(docs, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([("w1",)], "text string")
    assert drawn(df, target, percent=60) == plain_resample(docs, ["w1"], percent=60)


def test_repeated_rows_and_empty_tables(spark):
    docs = [(1, "w1 " * 20)] * 30 + [(2, "w2 " * 20)] * 10
    df = ready(spark).createDataFrame(docs, "doc_id long, text string")
    target = spark.createDataFrame([("w1",)], "text string")
    got = importance.resample(df, target, percent=50).collect()
    assert len(got) == 40 and sorted(r["rank"] for r in got if r["rank"]) == list(range(1, 21))
    plain = collections.Counter(r[:4] for r in plain_resample(docs, ["w1"], percent=50))
    assert collections.Counter(tuple(r)[:4] for r in got) == plain
    assert drawn(df.limit(0), target) == []
    assert drawn(df, target.limit(0)) and importance.resample(df, target.limit(0)).filter("rank is not null").count() == 4


def test_bit_planes_add_up_exactly():
    g = np.random.default_rng(8)
    for buckets in (1, 63, 64, 1000):
        gain = g.integers(-70_000, 70_000, buckets)
        counts = g.integers(0, 5, buckets) * g.integers(0, 1 << 40, buckets)
        assert importance.Gains(gain).total(counts) == sum(a * b for a, b in zip(gain.tolist(), counts.tolist(), strict=True))
    assert importance.Gains(np.zeros(5, "int64")).total(np.arange(5)) == 0
