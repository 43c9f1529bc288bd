"""Plan shape guards: shuffles, broadcasts, pruning and pushdown."""

import os
import re

import pytest

from starcast.plans import catalog as c

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="benchmark tables not present")


def physical(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_rating_matrix_has_one_hash_shuffle(spark):
    p = physical(c.QUERIES["rating_features"](spark, SF))
    shuffles = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", p)
    # the last-wins dedupe on (user, business) is the only hash shuffle;
    # both feature tables are broadcast behind their measured size
    assert len(shuffles) == 1 and "user_id" in shuffles[0] and "business_id" in shuffles[0]
    assert p.count("BroadcastHashJoin") >= 2 and "SortMergeJoin" not in p


def test_scans_are_pruned_and_filtered(spark):
    df = c.QUERIES["rating_features"](spark, SF)
    p = df._jdf.queryExecution().executedPlan().toString()
    li = re.search(r"FileScan parquet \[([^\]]*)\][^\n]*lineitem", p)
    assert li is not None
    cols = [x.split("#")[0] for x in li.group(1).split(",")]
    assert sorted(cols) == sorted(["l_orderkey", "l_partkey", "l_linenumber", "l_quantity"])
    assert "PushedFilters: [IsNotNull(l_orderkey)]" in p


def test_wide_matrix_broadcasts_dimensions(spark):
    train, _, _ = c.wide_matrices(spark, SF)
    p = physical(train)
    assert p.count("BroadcastHashJoin") >= 3 and "SortMergeJoin" not in p


def test_no_python_in_feature_plans(spark):
    for name in ("rating_features", "wide_features_long", "business_features", "hash32"):
        p = physical(c.QUERIES[name](spark, SF))
        assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p
