"""Corpus operators against brute force."""

import base64
import collections
import hashlib
import json
import random
import re
import zlib

import numpy as np
import pytest
from helpers import lower, plain_components
from pyspark.sql import functions as F

from billtrace.llm import decontamination, exact_dedup, language_id, packing, parity_join, queries, secret_scan, sharding, suffix_dedup, tokens, toxicity
from billtrace.llm.common import ready

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def documents(spark):
    return ready(spark).read.parquet(f"{SF}/documents.parquet")


# ---- secrets


def der(tag, *parts):
    body = b"".join(parts)
    size = bytes([len(body)]) if len(body) < 128 else bytes([0x80 + (len(body).bit_length() + 7) // 8]) + len(body).to_bytes((len(body).bit_length() + 7) // 8, "big")
    return bytes([tag]) + size + body


NUMBER = der(2, b"\x01" + bytes(range(1, 64)))
RSA = der(0x30, der(2, b"\0"), *[NUMBER] * 8)
WRAPPED = der(0x30, der(2, b"\0"), der(0x30, der(6, b"\x2a\x86\x48")), der(4, RSA))


def test_secrets_are_confirmed_by_structure():
    key = base64.b64encode(RSA).decode()
    token = ".".join(base64.urlsafe_b64encode(json.dumps(p).encode()).decode().rstrip("=") for p in ({"alg": "HS256"}, {"sub": "1"})) + ".c2lnbmF0dXJl"
    pem = "-----BEGIN PRIVATE KEY-----\n" + "\n".join(re.findall(".{1,64}", base64.b64encode(WRAPPED).decode())) + "\n-----END PRIVATE KEY-----"
    assert secret_scan.is_der_key(RSA) and secret_scan.is_der_key(WRAPPED)
    assert not secret_scan.is_der_key(RSA[:-1]) and not secret_scan.is_der_key(RSA + b"\0")
    kinds = lambda t: [secret_scan.KINDS[k] for _, k, _ in secret_scan.find_secrets(t.encode())]
    assert kinds(f"a {key} b") == ["key_base64"]
    assert kinds(f"x {token} y") == ["token"] and kinds(f"x {token[3:]} y") == []
    assert "key_pem" in kinds(pem)
    upper = kinds(RSA.hex().upper())  # its runs of digits alone may be long enough to be hex as well
    assert [k for k in upper if k != "hex"] == ["key_hex"] and kinds(RSA.hex()) == ["hex", "key_hex"]
    assert kinds(base64.b64encode(bytes(range(200))).decode()) == []


def test_base_secrets_equal_plain_patterns(spark, documents):
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    texts = [r.text for r in documents.select("text").collect()]
    texts += ['é API_KEY = "abcdef" pASSwd:12345 tokentoken=abc123', "AKIA" + "Q" * 16 + " " + "ab" * 12, "ſecret=abcdefg toKen=abcdef"]
    for text in texts:
        want = [("assign", m.start(), m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
        want += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
        want += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
        data = text.encode()
        got = secret_scan._in_code_points(data, secret_scan.find_secrets(data))
        assert [(g["kind"], g["start"], g["end"]) for g in got if g["kind"] in secret_scan.BASE_KINDS] == sorted(want, key=lambda w: (w[1], secret_scan.KINDS.index(w[0])))


# ---- suffix dedup


@pytest.mark.parametrize(("length", "most_runs"), [(400, 4096), (60, 2), (25, 4096)])
def test_repeated_bytes_equal_brute_force(spark, documents, length, most_runs):
    rows = [(r.doc_id, (r.text or "").encode()) for r in documents.collect()]
    seen = collections.Counter(b[i : i + length] for _, b in rows for i in range(len(b) - length + 1))
    want = {}
    for key, b in rows:
        cover = np.zeros(len(b) + 1, int)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                cover[i] += 1
                cover[i + length] -= 1
        gone = np.cumsum(cover)[: len(b)] > 0
        want[key] = (len(b), int(gone.sum()), int((np.diff(np.append(0, gone.astype(int))) == 1).sum()), hashlib.sha256(np.frombuffer(b, np.uint8)[~gone].tobytes()).hexdigest())
    got = suffix_dedup.repeated_passages(documents, length=length, most_runs=most_runs).collect()
    assert {r.id: (r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in got} == want


def test_suffixes_are_sorted_by_their_bytes():
    rnd = random.Random(3)
    text = bytes(rnd.choices(b"ab", k=3000))
    sorter = suffix_dedup.SuffixSorter(np.frombuffer(text, np.uint8), 40)
    at = np.array(rnd.sample(range(2960), 500))
    first = np.array([0, 1, 120, 121, 300])
    got = sorter.sort(at, first)
    for a, b in zip(first, [*first[1:], 500], strict=True):
        assert [text[i : i + 40] for i in got[a:b]] == sorted(text[i : i + 40] for i in at[a:b])


# ---- packing


def test_pieces_and_sequences(spark, documents):
    path, pattern = queries.public_tokenizer()
    encoder = tokens.Encoder(path, pattern)
    odd = ["<|endoftext|> a", "  two  blanks ", "ａ　b c ", "don't'll 12³ ½", "\x00\x1c", "a\r\n b\n\n\nc "]
    for text in [*odd, *[r.text for r in documents.limit(50).collect()]]:
        assert encoder.encode(text).tolist() == encoder.exact.encode(text, add_special_tokens=False).ids
    parts = packing.pieces(documents, path, pattern)
    for per_problem, slack in ((4096, 1), (40, 4)):
        rows = packing.pack(parts, per_problem=per_problem).collect()
        sequences, by = collections.defaultdict(list), collections.defaultdict(list)
        for r in rows:
            sequences[r.sequence_id].append((r.offset, r.length))
            by[r.id].append(r)
        for places in sequences.values():
            at = 0
            for offset, length in sorted(places):
                assert offset == at
                at += length
            assert at <= 2048
        total = 0
        for d in documents.collect():
            ids = [*encoder.encode(d.text or "").tolist(), 0]
            total += len(ids)
            at = 0
            for k, r in enumerate(sorted(by[d.doc_id], key=lambda r: r.piece)):
                assert (r.piece, r.start) == (k, at) and (k == 0 or r.length == 2048)
                assert r.ids_crc32 == zlib.crc32(np.array(ids[at : at + r.length], "<u4").tobytes())
                at += r.length
            assert at == len(ids)
        assert len(sequences) <= -(-total // 2048) + slack


def test_crossover_keeps_every_piece_once():
    g = random.Random(5)
    sizes = [g.randint(1, 2047) for _ in range(400)]
    population = packing.evolve(sizes, [], 2048, g, generations=20)
    for groups in population:
        assert sorted(i for group in groups for i in group) == list(range(400))
        assert all(sum(sizes[i] for i in group) <= 2048 for group in groups)
    assert packing.worth(population[0], sizes) >= packing.worth(packing._start(sizes, 2048, None), sizes)
    child = packing.crossover(population[0], population[-1], sizes, 2048, g)
    assert sorted(i for group in child for i in group) == list(range(400))


# ---- similarity join


@pytest.mark.parametrize(("n", "num"), [(3, 90), (5, 80)])
def test_components_equal_brute_force(spark, documents, n, num):
    got = parity_join.similarity_components(documents, n=n, num=num).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == plain_components([(r.doc_id, r.text) for r in documents.collect()], n, num)


def test_chains_and_clouds(spark):
    """Chains that only neighbours link, near copies, and a cloud of texts that share blocks but no link."""
    rnd = random.Random(9)
    words = [f"v{i}" for i in range(5000)]
    rows, base = [], rnd.choices(words, k=160)
    for i in range(30):  # each a few words further
        rows.append((i, " ".join(base)))
        base[rnd.randrange(160)] = rnd.choice(words)
    for start, edits in ((100, 1), (200, 4)):
        text = rnd.choices(words, k=150)
        for i in range(60):
            own = list(text)
            for _ in range(edits):
                own[rnd.randrange(150)] = rnd.choice(words)
            rows.append((start + i, " ".join(own)))
    rnd.shuffle(rows)
    got = parity_join.similarity_components(spark.createDataFrame(rows, "doc_id long, text string"), n=3, num=90).collect()
    assert {r.id: (r.n_shingles, r.component_id) for r in got} == plain_components(rows, 3, 90)


def test_sketch_blocks_hold_the_pigeonhole(spark):
    rnd, bands = random.Random(2), parity_join.Bands(90, 100)
    for size in (12, 40, 333):
        own = [rnd.getrandbits(64) for _ in range(size)]
        other = list(own)
        for k in range(bands.difference(size, size) // 2):
            other[k] = rnd.getrandbits(64)
        a, b = (np.unique(np.array(x, np.uint64)) for x in (own, other))
        assert set(parity_join.block_keys(a, bands).tolist()) & set(parity_join.block_keys(b, bands).tolist())


# ---- decontamination


def test_index_finds_every_occurrence():
    rnd = random.Random(4)
    text = np.array(rnd.choices(range(4), k=800), np.int32)
    index = decontamination.FMIndex(text, 4)
    rows = np.zeros((50, 6), np.int32)
    lengths = np.array([rnd.randint(1, 6) for _ in range(50)])
    for i in range(50):
        rows[i, : lengths[i]] = rnd.choices((1, 2, 3), k=lengths[i])
    phrase, low, high = index.search(rows, lengths)
    found = collections.defaultdict(set)
    for p, at in zip(np.repeat(phrase, high - low), index.locate(low, high), strict=True):
        found[p].add(int(at))
    for i in range(50):
        want = {k for k in range(800 - lengths[i] + 1) if (text[k : k + lengths[i]] == rows[i, : lengths[i]]).all()}
        assert found[i] == want


@pytest.mark.parametrize("block_bytes", [16_000_000, 2_000])
def test_hits_equal_brute_force(spark, documents, block_bytes):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    benchmark = spark.read.parquet(f"{SF}/benchmark.parquet")
    windows = collections.defaultdict(set)
    for r in [*benchmark.collect()]:
        w = word.findall(lower(r.text))
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k : k + 13])].add(str(r.item_id))
    want = {}
    for d in documents.collect():
        w, hit, items = word.findall(lower(d.text)), set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if tuple(w[k : k + n]) in windows:
                    hit |= {*range(k, k + n)}
                    items |= windows[tuple(w[k : k + n])]
        want[d.doc_id] = (len(w), len(hit), sorted(items), bool(hit) and 20 * len(hit) >= len(w))
    got = decontamination.with_hits(documents, benchmark, block_bytes=block_bytes).collect()
    assert {r.doc_id: (r.hits.n_words, r.hits.n_hit, r.hits["items"], r.hits.contaminated) for r in got} == want


# ---- exact dedup


def test_cuckoo_index_inserts_deletes_and_grows():
    index, live = exact_dedup.CuckooIndex(buckets=4), {}
    rnd = random.Random(6)
    digests = [hashlib.sha256(str(i).encode()).digest() for i in range(600)]
    for step in range(5000):
        digest = rnd.choice(digests)
        if rnd.random() < 0.3 and digest in live:
            index.delete(index.find(digest))
            del live[digest]
        else:
            index.offer(digest, step, 1)
            live[digest] = step
        if step % 500 == 0:
            assert {e[0]: e[1] for e in index.entries.values()} == live
            assert all((index.find(x) is not None) == (x in live) for x in digests)


def test_flushed_index_gives_the_same_groups(spark, documents):
    a = exact_dedup.exact_duplicates(documents)
    b = exact_dedup.exact_duplicates(documents, max_entries=3)
    assert sorted(map(str, a.collect())) == sorted(map(str, b.collect()))


# ---- shards


def test_shards_are_even_and_gapless(spark):
    rnd = random.Random(8)
    rows = [(i, "same text " * 20 if i % 3 == 0 else "x" * rnd.randint(0, 400)) for i in range(6000)]
    got = sharding.shard_by_bytes(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    size, slots = collections.Counter(), collections.defaultdict(list)
    for r in got:
        size[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert len(got) == 6000 and set(size) == set(range(16))
    assert max(size.values()) - min(size.values()) < 0.02 * sum(size.values()) / 16 + 2 * 401
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


# ---- learned operators


def test_gradients():
    """Back-propagation agrees with differences."""
    net = toxicity.Network(1)
    words = toxicity.Words()
    windows = np.concatenate([toxicity.windows_of(words.of(t.split())) for t in (b"a b c d", b"e a f", b"g")])
    features, y = words.take(), np.array([1, 0, 1], np.float32)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    g = net.gradients(features, windows, y)

    def loss():
        logit = net.forward(net.gates(net.embed(features)[0]), windows)
        return float(np.mean(np.logaddexp(0, logit) - y * logit))

    for name in ("Wf", "Ub", "A", "a", "v", "cb", "Uf"):
        at = np.unravel_index(np.abs(g[name]).argmax(), g[name].shape)
        net.p[name][at] += 1e-2
        high = loss()
        net.p[name][at] -= 2e-2
        slope = (high - loss()) / 2e-2
        net.p[name][at] += 1e-2
        assert slope == pytest.approx(g[name][at], rel=0.1, abs=1e-4), name


def test_toxic_words_are_learned():
    rnd = random.Random(7)
    clean = [f"n{i}" for i in range(400)]
    texts, labels = [], []
    for i in range(400):
        words = rnd.choices(clean, k=rnd.randint(20, 300))
        if i % 2:
            for _ in range(3):
                words[rnd.randrange(len(words))] = rnd.choice(["idiotic", "vileness" + rnd.choice("abc")])
        texts.append(" ".join(words).encode())
        labels.append(i % 2)
    scorer = toxicity.Scorer(toxicity.fit(texts[:300], labels[:300]))
    predicted = scorer.scores(texts[300:]) >= toxicity.THRESHOLD
    assert (predicted == np.array(labels[300:], bool)).mean() > 0.9


def test_scores_do_not_depend_on_how_new_words_are_cut(monkeypatch):
    rnd = random.Random(3)
    texts = [" ".join(f"w{rnd.randrange(900)}" for _ in range(n)).encode() for n in (0, 1, 47, 48, 49, 500, 3000)] + [b"a" * 5000, "caff\u00e8 \u4e16\u754c".encode()]
    net = toxicity.Network(5)
    whole = toxicity.Scorer(net).scores(texts)
    monkeypatch.setattr(toxicity, "FRESH", 7)
    scorer = toxicity.Scorer(net)
    assert np.allclose(scorer.scores(texts), whole, atol=1e-6) and not scorer.words.fresh
    assert np.allclose([scorer.scores([t])[0] for t in reversed(texts)][::-1], whole, atol=1e-6)  # words known by now


def test_mixtures_choose_their_languages():
    rows = [("aa", b"tha the thi tho " * 30), ("bb", b"zuk zik zok zak " * 30)]
    model = language_id.Model.train(rows)
    got = language_id.mixtures([b"the tho tha", b"zik zok zuk", b"the zik tho zok tha zak the zik tho zok", b"123 !", b""], model)
    assert [g["lang"] for g in got][:2] == ["aa", "bb"] and [g["lang"] for g in got][3:] == ["und", "und"]
    assert len(got[2]["shares"]) == 2 and len(got[0]["shares"]) == 1


def test_held_out_languages(spark):
    df = queries.QUERIES["op10_language_id"](spark, "/root/testdata/sf0.01")
    truth = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = df.filter("held_out").join(truth, "doc_id").filter("lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) / len(rows) > 0.97


def test_sets_are_made_for_wanted_texts_only(spark, monkeypatch):
    plans, write = [], parity_join._Tables.write

    def seen(self, rows, label):
        plans.append((label, rows._jdf.queryExecution().optimizedPlan().toString()))
        return write(self, rows, label)

    monkeypatch.setattr(parity_join._Tables, "write", seen)
    texts = [" ".join(f"w{i % 20}x{k}" for k in range(100)) + f" end{i}" for i in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = parity_join.similarity_components(df, n=3, num=90).collect()
    assert {(r.id, r.component_id) for r in got} == {(i, i % 20) for i in range(60)}
    made = [plan for label, plan in plans if label == "sets"]
    assert made and all(plan.rindex("ArrowEvalPython") < plan.index("Join") for plan in made)  # above the join that picks them


def test_blocks_lie_by_key_and_are_not_shuffled_for_it(spark, monkeypatch):
    """Blocks are grouped, cut and joined by their key in every round; each exchange by it sent all of them again."""
    plans, write = {}, parity_join._Tables.blocks

    def seen(self, rows, label, **options):
        plans.setdefault(label, []).append(rows._jdf.queryExecution().executedPlan().toString())
        return write(self, rows, label, **options)

    monkeypatch.setattr(parity_join._Tables, "blocks", seen)
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        docs = spark.createDataFrame([(k, " ".join(f"w{k // 2}_{j}" for j in range(40)) + " x" * (k % 2)) for k in range(40)], "doc_id long, text string")
        out = {r.id: r.component_id for r in parity_join.similarity_components(docs, n=3, num=90).collect()}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert out == {k: k - k % 2 for k in range(40)}
    assert "Exchange" not in plans["blocks"][0] and "Exchange" not in plans["stars"][0]


def test_only_wanted_texts_are_joined_for_their_sets(spark, monkeypatch, tmp_path):
    """With more wanted ids than a broadcast takes, a join with all texts sent all of them."""
    rnd, read, write = random.Random(4), [], parity_join._Tables.write
    rows = [(i, " ".join(f"t{rnd.getrandbits(60)}" for _ in range(60))) for i in range(2000)]
    rows += [(i + 5000, rows[i][1] + " end") for i in range(20)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents")

    def seen(self, made, label):
        if label == "sets":
            tables = [spark.read.parquet(f) for f in made.inputFiles()]
            read.append(sum(t.count() for t in tables if "text" in t.columns))
        return write(self, made, label)

    monkeypatch.setattr(parity_join._Tables, "write", seen)
    out = parity_join.similarity_components(spark.read.parquet(f"{tmp_path}/documents"), n=3, num=90).collect()
    assert {r.id: r.component_id for r in out} == {i: i % 5000 for i, _ in rows}
    assert read and all(40 <= n <= 60 for n in read[:1]) and max(read) <= 60


def test_filter_of_ids_holds_for_all_of_them(spark):
    """Of other ids few pass; a filter with too little room for its ids passes more and loses none."""
    ids = spark.range(0, 40000, 2).select(F.when(F.col("id") == 0, None).otherwise(F.struct("id", F.lit(None).cast("string").alias("s"))).alias("id"))
    others = spark.range(1, 40000, 2).select(F.struct("id", F.lit(None).cast("string").alias("s")).alias("id"))
    perhaps = parity_join._perhaps(ids, "id")
    assert ids.filter(perhaps(F.col("id"))).count() == 20000
    assert others.filter(perhaps(F.col("id"))).count() < 400
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(parity_join, "MAX_FILTER_BITS", 1 << 14)
        perhaps = parity_join._perhaps(ids, "id")
        assert ids.filter(perhaps(F.col("id"))).count() == 20000
