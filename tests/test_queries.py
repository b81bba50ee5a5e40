"""Every named query beside its SQL text, on whole tables."""

import subprocess
import sys
from pathlib import Path

import pytest
from compare import compare, engine

from billtrace.registry import REGISTRY

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return engine(SF)


@pytest.mark.parametrize("name", list(REGISTRY))
def test_query(spark, con, name):
    difference, rows = compare(REGISTRY[name], spark, con, SF)
    assert difference is None
    assert rows >= 0


def test_driver_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())


def test_every_query_has_sql():
    assert all(q.sql is not None for q in REGISTRY.values())


def test_names_are_known_without_a_session():
    code = "import __spark_entry__ as e; print(len(e.queries()))"
    root = Path(__file__).resolve().parent.parent
    assert int(subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout) > 200
