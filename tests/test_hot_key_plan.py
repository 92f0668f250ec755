"""The rows of a hot key are salted before they move."""

import os
import re

import pytest

from __spark_entry__ import queries

SF = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


def test_rows_never_move_by_the_bare_hot_key(no_broadcast):
    plan = queries()["hot_key_join"](no_broadcast, SF)._jdf.queryExecution().executedPlan().toString()
    assert "_salt" in plan
    assert not re.search("SortMergeJoin.*LeftOuter", plan)
