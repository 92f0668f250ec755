"""No join may broadcast exploded or gathered rows on the guessed size of their file."""

import os

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@pytest.mark.parametrize("name", [
    "concat_features", "fetch_sequences", "interval_join_boundary", "interval_join_exon",
    "frame_at_bp", "tx_pairs", "combined_boundary", "frame_class", "truncate_features",
    "filter_comment",
])
def test_nothing_is_broadcast_on_a_guess(spark, name):
    plan = queries()[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan
