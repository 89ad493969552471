"""What no plan of a report may contain."""

import pytest

from fareflow.plans import QUERIES
from tests.conftest import SMALL, plan

# Queries of these modules only describe their result; the others also write and read back, and have
# what reads back checked.
LAZY = sorted(
    name for name, query in QUERIES.items() if query.run.__module__.endswith((".trips", ".trade"))
)
WRITING = sorted(set(QUERIES) - set(LAZY))


@pytest.mark.parametrize("name", LAZY)
def test_plan(spark, name):
    text = plan(QUERIES[name].run(spark, SMALL))
    for node in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "CollectLimit"):
        assert node not in text
    assert ("ArrowEvalPython" in text) == (name == "trip_duration_udf")
    # A scan names the columns it reads: none reads a whole wide table.
    lineitem = [line for line in text.splitlines() if "FileScan" in line and "lineitem.parquet" in line]
    for scan in lineitem:
        read = scan[scan.index("ReadSchema"):]
        assert read.count(":") - 1 < 11


@pytest.mark.parametrize("name", WRITING)
def test_plan_of_what_reads_back(spark, name):
    text = plan(QUERIES[name].run(spark, SMALL))
    for node in ("CartesianProduct", "NestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "CollectLimit"):
        assert node not in text
