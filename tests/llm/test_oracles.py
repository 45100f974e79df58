"""Queries with SQL against it on the smallest fixture; the registry's completeness."""

from __future__ import annotations

import re

import pytest

import corpus_pipeline
from tickloom.llm.queries import ORACLES, QUERIES

from ..conftest import DATA


def test_registry():
    assert sorted(int(re.match(r"op(\d+)_", k)[1]) for k in QUERIES) == list(range(1, 11))
    assert len(corpus_pipeline.STAGES) == 5 and corpus_pipeline.ORACLE_SQL is None


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, duck, same, name):
    same(QUERIES[name](spark, DATA), duck.execute(ORACLES[name]).df())
