"""Plans of the operators' queries: no cross joins, no window over a whole table, no Python where none is asked for."""

from __future__ import annotations

import re

import pytest

from sheafwork.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_join_and_no_global_window(spark, name):
    text = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    for line in re.findall(r"Window \[.*", text):
        assert not re.search(r"windowspecdefinition\((?=\w+#\d+L? (?:ASC|DESC))", line), line
    if name == "op4_host_graph":
        assert not re.search("Python|Pandas|Arrow", text)
