"""Every registered query against its SQL, on the smallest tables."""

import pytest
from oracle import connect, difference

import __spark_entry__ as driver
from tallyroll.catalog import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


# These fit 100 rounds, or share fits of 500 to 1900 rounds, which take minutes; test_model.py has their operators.
LONG = {"train_boosted_trees", "score", "feature_importance", "top_importance", "train_modes", "auc_by_round", "older_score"}


@pytest.mark.parametrize("name", sorted(x for x in QUERIES if x not in LONG))
def test_query(spark, con, name):
    assert difference(spark, con, name, SF) == ""


def test_entry(spark):
    df = driver.entry(spark)
    assert len(df.columns) == 3 + 5 + 52 + 1
    assert df.columns[-1] == "label"
    assert df.count() > 0
