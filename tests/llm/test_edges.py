"""Every corpus operator on NULLs, empty and long texts, ties, repeated rows, empty tables and clashing names."""

import random

import pytest
from pyspark.sql import functions as F

from billtrace.llm import decontamination, exact_dedup, language_id, packing, parity_join, queries, secret_scan, sharding, suffix_dedup, toxicity, warc
from billtrace.llm.common import ready, scratch_path

WORDS = [f"w{i}x" for i in range(300)]


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choices(WORDS, k=n))


LONG = prose(1, 60_000)
ROWS = [
    (1, prose(2, 200)), (2, prose(2, 200)), (2, prose(2, 200)), (3, None), (4, ""), (5, " \n\t"), (None, prose(3, 50)), (6, LONG),
    (7, prose(2, 200).upper()), (8, "é ñ ß 漢字   x"), (None, None), (9, "one"), (10, prose(4, 30)), (10, prose(5, 30)),
]


@pytest.fixture(scope="module")
def docs(spark):
    """Odd rows, with more columns whose names the operators use themselves."""
    df = ready(spark).createDataFrame(ROWS, "doc_id long, text string")
    extra = ("id", "node", "key", "hits", "h", "size", "shard", "score", "lang", "toxic", "digest", "number", "piece", "row", "k")
    return df.select("*", *[F.lit(None).cast("string").alias(c) for c in extra])


@pytest.fixture(scope="module")
def benchmark(spark):
    return spark.createDataFrame([(1, prose(2, 20)), (2, None), (None, "a b"), (3, ""), (4, "ONE"), (4, "ONE")], "item_id long, text string")


def all_operators(spark, docs, benchmark):
    path, pattern = queries.public_tokenizer()
    yield "secrets", docs.select(secret_scan.secrets("text").alias("s"))
    yield "exact", exact_dedup.exact_duplicates(docs)
    yield "exact_drop", exact_dedup.drop_duplicates(docs)
    yield "suffix", suffix_dedup.repeated_passages(docs)
    yield "parity", parity_join.similarity_components(docs, n=3, num=90, den=100)
    yield "hits", decontamination.with_hits(docs, benchmark)
    yield "shards", sharding.shard_by_bytes(docs)
    yield "toxicity", docs.select(toxicity.scorer(spark, toxicity.train(docs))("text").alias("s"))
    yield "language", docs.select(language_id.identifier(spark, language_id.train(docs))("text").alias("g"))
    yield "packing", packing.pack(packing.pieces(docs, path, pattern))


def test_odd_rows(spark, docs, benchmark):
    got = {name: df.collect() for name, df in all_operators(spark, docs, benchmark)}
    n = len(ROWS)
    for name in ("secrets", "exact", "suffix", "parity", "hits", "shards", "toxicity", "language"):
        assert len(got[name]) == n, name
    groups = {(r.id, r.kept): r for r in got["exact"]}
    assert groups[7, True].group_size == 4 and groups[1, False].keep_id == 7
    assert groups[4, True].group_size == 3 and groups[None, False].keep_id == 4  # NULL texts equal the empty one
    assert len(got["exact_drop"]) == sum(r.kept for r in got["exact"])
    removed = {r.id: r for r in got["suffix"] if r.id is not None}
    assert removed[1].n_removed == removed[2].n_removed == len(ROWS[0][1]) and removed[7].n_removed == 0
    assert removed[3].n_bytes == removed[4].n_bytes == 0
    component = {r.id: r for r in got["parity"]}
    assert component[1].component_id == component[2].component_id == component[7].component_id == 1
    assert component[3].n_shingles == component[5].n_shingles == 0 and component[5].component_id == 5
    assert component[9].n_shingles == 1
    hits = {r.doc_id: r.hits for r in got["hits"]} if "doc_id" in docs.columns else {}
    assert hits[1].n_hit == 20 and hits[1]["items"] == ["1"] and hits[1].contaminated
    assert hits[9].n_hit == 1 and hits[9]["items"] == ["4"]
    assert hits[3].n_words == hits[4].n_words == 0 and not hits[4].contaminated
    assert sorted(r.slot for r in got["shards"] if r.shard == 0) == list(range(sum(r.shard == 0 for r in got["shards"])))
    assert {r.s for r, row in zip(got["toxicity"], ROWS, strict=True) if not (row[1] or "").strip()} == {0.0}
    assert {r.g.lang for r in got["language"]} == {"und"}  # nothing to learn from
    assert sum(r.piece == 0 for r in got["packing"]) == n


def test_empty_tables(spark, docs, benchmark):
    for name, df in all_operators(spark, docs.limit(0), benchmark.limit(0)):
        assert df.collect() == [], name
    assert decontamination.with_hits(docs, benchmark.limit(0)).filter("hits.n_hit > 0").count() == 0


def test_odd_pages(spark):
    page = "<html>\r\n\r\nWARC/1.1\r\nWARC-Type: response\r\n\r\n" + "x" * 90
    rows = [(1, "http://a.example/x y", page), (2, None, page), (2, None, page), (3, "http://b.example", None), (4, "u", ""), (None, "http://c", page), (5, "http://d/é", "ü" * 70), (5, "http://d/é", "short")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1)).withColumn("kind", F.lit(1))
    path = scratch_path(spark, "warc")
    warc.write_captures(pages, path, per_file=3)
    got = warc.assemble(warc.read_records(spark, path)).collect()
    assert len(got) == len(rows) and len({r.record_id for r in got}) == len(rows)
    by = {(r.metadata.fields.get("page-id") or None, bytes(r.response.payload or b"")): r for r in got}
    assert by["1", page.encode()].response.kind == "response"
    assert by["2", b""].response.kind == "revisit" and by["2", b""].response.refers_to == by["1", page.encode()].record_id
    assert by[None, b""].response.kind == "revisit"
    assert by["5", ("ü" * 70).encode()].response.payload_digest == by["5", ("ü" * 70).encode()].response.declared_digest
    assert all(r.request.head.startswith("GET ") for r in got)
    told = sorted([(r.page, r.kind, r.bytes, r.refers_to) for r in warc.originals(warc.assemble(warc.read_records(spark, path, payload=False))).collect()], key=repr)
    size = len(page.encode())
    assert told == sorted([("1", "response", size, None), *[("2", "revisit", size, "1")] * 2, (None, "revisit", size, "1"), ("3", "response", 0, None), ("4", "response", 0, None), ("5", "response", 140, None), ("5", "response", 5, None)], key=repr)
    # A response that repeats: its copies are responses too, and revisits name the first.
    path = scratch_path(spark, "warc")
    warc.write_captures(pages.union(pages.filter("page_id = 1")), path)
    told = [r for r in warc.originals(warc.assemble(warc.read_records(spark, path))).collect() if r.bytes == size]
    assert sorted((r.page or "", r.kind) for r in told) == [("", "revisit"), ("1", "response"), ("1", "response"), ("2", "revisit"), ("2", "revisit")]
    assert {r.refers_to for r in told if r.kind == "revisit"} == {"1"}
    empty = scratch_path(spark, "warc")
    warc.write_captures(pages.limit(0), empty)
    assert warc.assemble(warc.read_records(spark, empty)).count() == 0
