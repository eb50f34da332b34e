"""Every registered query against its SQL on the given tables."""

from __future__ import annotations

import compare
import pytest

import __spark_entry__ as entry
from txnrisk.plans.oracles import ORACLES
from txnrisk.plans.queries import REGISTRY


@pytest.fixture(scope="module")
def con(sf):
    return compare.connect(sf)


def test_every_query_has_sql():
    assert set(REGISTRY) == set(ORACLES)
    assert set(REGISTRY) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, sf, con, name):
    assert compare.compare(spark, sf, entry.queries()[name], entry.oracle_sql()[name], con) is None


def test_trained_probabilities(spark, txn):
    from txnrisk.operators import metrics, models
    from txnrisk.plans import jobs
    from txnrisk.schemas import LABEL, VOCABULARY

    rows = jobs.feature_rows(txn)
    model, test = jobs.train_forest(rows, VOCABULARY, numTrees=10)
    scored = models.score(test, model, [LABEL])
    assert scored.where("probability < 0 OR probability > 1 OR probability IS NULL").isEmpty()
    assert metrics.roc_auc(scored, "probability", LABEL).first()["auc"] > 0.8


def test_entry_runs(spark):
    rows = entry.entry(spark)
    assert rows.count() > 0
    assert rows.columns[-2:] == ["probability", "prediction"]
