"""Every stage of the pipeline on odd rows: NULL and repeated ids, repeated rows, clashing names, empty tables."""

import random
import tracemalloc

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from billtrace.llm import toxicity
from billtrace.llm.common import ready

SF = "/root/testdata/sf0.001"
FILTERS = corpus_pipeline.STAGES[:-1]


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choices([f"parola{i}" for i in range(400)], k=n))


NEAR = prose(1, 200)
CLOSE = NEAR.rsplit(" ", 3)[0] + " fine diversa qui"
ROWS = [(1, NEAR), (2, CLOSE), (2, prose(2, 60)), (2, prose(2, 60)), (None, CLOSE + " x"), (None, prose(3, 40)), (None, None), (3, None), (4, ""), (5, "breve"), (6, prose(4, 30_000))]


@pytest.fixture(scope="module")
def docs(spark):
    clashing = ("__gone", "__hash", "__hits", "__toxicity", "__block0", "row", "id", "node", "score", "text_", "found")
    df = ready(spark).createDataFrame(ROWS, "doc_id long, text string")
    return df.select("*", *[F.lit(i).alias(c) for i, c in enumerate(clashing)])


@pytest.mark.parametrize("name,stage", FILTERS)
def test_filters_keep_columns_and_take_empty_tables(spark, docs, name, stage):
    kept = stage(spark, docs, SF)
    assert kept.columns == docs.columns
    rows = {tuple(r) for r in docs.collect()}
    assert {tuple(r) for r in kept.collect()} <= rows
    assert stage(spark, docs.limit(0), SF).collect() == []


def test_near_copies_are_judged_row_by_row(spark, docs):
    kept = corpus_pipeline.drop_near_copies(spark, docs, SF).select("doc_id", "text").collect()
    got = [(r.doc_id, r.text) for r in kept]
    assert (1, NEAR) in got and (2, CLOSE) not in got and (None, CLOSE + " x") not in got
    assert sorted(got, key=repr) == sorted([r for r in ROWS if not (r[1] or "").startswith(CLOSE)], key=repr)  # the unrelated row of id 2 stays


def test_exact_copies_keep_the_largest_id(spark, docs):
    more = docs.union(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(9).cast("long")).withColumn("text", F.upper("text")))
    got = {(r.doc_id, r.text) for r in corpus_pipeline.drop_copies(spark, more, SF).collect()}
    assert (9, NEAR.upper()) in got and (1, NEAR) not in got
    assert {i for i, t in got if not t} == {4}  # NULL equals the empty text


def test_contaminated_documents_go_and_clean_ones_stay(spark, docs):
    item = ready(spark).read.parquet(f"{SF}/benchmark.parquet").filter("size(split(text, ' ')) > 13").first().text
    more = docs.union(docs.filter("doc_id = 1").withColumn("doc_id", F.lit(9).cast("long")).withColumn("text", F.lit(item)))
    got = {r.doc_id for r in corpus_pipeline.drop_contaminated(spark, more, SF).collect()}
    assert got == {r[0] for r in ROWS}


def test_packing_takes_every_row(spark, docs):
    pieces = corpus_pipeline.pack(spark, docs, SF).collect()
    assert sum(r.piece == 0 for r in pieces) == len(ROWS)
    assert corpus_pipeline.pack(spark, docs.limit(0), SF).collect() == []


def test_training_holds_the_ngrams_of_a_slice_of_words(monkeypatch):
    monkeypatch.setattr(toxicity, "EPOCHS", 2)
    monkeypatch.setattr(toxicity, "LEAST_STEPS", 0)
    g = random.Random(3)
    texts = [" ".join(f"{g.getrandbits(64):016x}" for _ in range(1500)).encode() for _ in range(40)]
    tracemalloc.start()
    toxicity.fit(texts, [i % 2 for i in range(40)])
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 150 << 20  # 60,000 words with 2,820,000 n-grams
    net, words = toxicity.Network(), [b"", *(w for t in texts[:10] for w in t.split())]
    whole = toxicity.Features.of(words)
    assert (net.inputs(whole) == net.embed(whole)[0]).all()
    parts = toxicity.Features.joined([toxicity.Features.of(words[i : i + 999]) for i in range(0, len(words), 999)])
    assert all((getattr(whole, n) == getattr(parts, n)).all() for n in ("words", "grams", "counts"))
