"""The entry point without the training-data subpackage, or with a broken one."""

import importlib
import warnings

import pytest

import __spark_entry__ as E
from tidemark.plans.queries import QUERIES


@pytest.mark.parametrize("absent", [True, False])
def test_other_queries_stay(monkeypatch, absent):
    real = importlib.import_module

    def broken(name, *a):
        if name.startswith("tidemark.llm"):
            raise ModuleNotFoundError(name, name=name) if absent else ImportError("no such name")
        return real(name, *a)

    monkeypatch.setattr(E.importlib, "import_module", broken)
    with warnings.catch_warnings(record=True) as seen:
        warnings.simplefilter("always")
        assert set(E.queries()) == set(QUERIES) and len(E.oracle_sql()) > 80
    assert bool(seen) != absent


def test_every_oracle_has_its_query():
    assert set(E.oracle_sql()) <= set(E.queries())
