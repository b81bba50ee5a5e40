"""The registered corpus queries beside their SQL, and the pipeline stage by stage."""

import collections
import re

import pytest
from compare import compare, engine
from helpers import plain_components

import corpus_pipeline
from billtrace.llm import queries
from billtrace.llm.common import ready

SF = "/root/testdata/sf0.001"


class Query:
    def __init__(self, name):
        self.name, self.sql = name, queries.SQL.get(name)

    def __call__(self, spark, sf_dir):
        return queries.QUERIES[self.name](spark, sf_dir)


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, name):
    difference, rows = compare(Query(name), spark, engine(SF), SF)
    assert difference is None and rows > 0


def test_names():
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in queries.QUERIES) == list(range(1, 14))


def test_pipeline(spark):
    docs = ready(spark).read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {r.doc_id: r.text for r in docs.collect()}
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "exact_dedup", "ngram_jaccard_join", "decontamination", "packing"]
    after = {}
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        if name == "packing":
            break
        assert docs.columns == columns
        docs = docs.cache()
        after[name] = {r.doc_id: r.text for r in docs.collect()}
        assert after[name].items() <= kept.items()
        if name == "exact_dedup":
            largest = collections.defaultdict(list)
            for key, text in kept.items():
                largest[re.sub("[A-Z]+", lambda m: m.group().lower(), text or "")].append(key)
            assert set(after[name]) == {max(v) for v in largest.values()}
        if name == "ngram_jaccard_join":
            components = plain_components(kept.items(), 5, 80)
            assert set(after[name]) == {k for k, (_, c) in components.items() if k == c}
        kept = after[name]
    pieces = docs.collect()
    assert {r.doc_id for r in pieces} == set(kept)


def test_whole_run(spark):
    assert corpus_pipeline.run(spark, SF).count() > 0
