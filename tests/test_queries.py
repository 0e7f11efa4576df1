"""Every registered query against its SQL twin."""

from __future__ import annotations

import sys

import pytest

import __spark_entry__ as entry_points
import oracle_queries
from twins import compare, connect

SF_DIR = "/root/testdata/sf0.001"
OWN = sorted(entry_points._registered())


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(OWN) == set(oracle_queries.oracle_sql())


@pytest.mark.parametrize("name", OWN)
def test_query_equals_twin(spark, con, name):
    result = entry_points.queries()[name](spark, SF_DIR)
    own_columns, twin_columns, own, twin = compare(result, con, entry_points.oracle_sql()[name])
    assert own_columns == twin_columns
    assert own == twin
    assert own


def test_entry_has_rows(spark):
    assert entry_points.entry(spark).count() > 0


@pytest.mark.parametrize("missing", ["corpus_pipeline", "tallyline.llm"])
def test_the_rest_works_without_the_training_data_operators(monkeypatch, missing):
    monkeypatch.setitem(sys.modules, missing, None)
    for name in [name for name in sys.modules if name.startswith(f"{missing}.") or name == "corpus_pipeline" != missing]:
        monkeypatch.delitem(sys.modules, name)
    found = entry_points.queries()
    assert sorted(found) == OWN and sorted(entry_points.oracle_sql()) == sorted(oracle_queries.oracle_sql())


def test_other_import_errors_are_not_hidden(monkeypatch):
    def broken(*_):
        raise ModuleNotFoundError("No module named 'elsewhere'", name="elsewhere")

    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    monkeypatch.setattr("builtins.__import__", broken)
    with pytest.raises(ModuleNotFoundError, match="elsewhere"):
        entry_points._training_data()
