"""Every registered query against its SQL on the same tables."""

import pytest

from __spark_entry__ import entry, queries
from check import compare, connect
from shelfline.plans.oracle import ORACLES
from shelfline.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, sf_dir, name):
    got = queries()[name](spark, sf_dir).toPandas()
    assert compare(got, duck.execute(ORACLES[name]).df()) == "ok"


def test_entry(spark):
    rows = entry(spark).collect()
    assert [r["rank"] for r in sorted(rows, key=lambda r: r["rank"])] == list(range(1, 51))


def test_letters_separate_words_of_documents(spark, sf_dir):
    plain, letters = ({r.word for r in REGISTRY[name](spark, sf_dir).collect()} for name in ("document_words", "document_words_letters"))
    # Digits are words in the first only.
    assert any(w.isdigit() for w in plain) and not any(c.isdigit() for w in letters for c in w) and len(letters & plain) > 1000
