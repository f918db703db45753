"""Every registered query plans without Python evaluation, nested-loop or
Cartesian joins: the work stays in JVM operators and equi-joins."""

import __spark_entry__ as E
from incidex.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas",
             "BroadcastNestedLoopJoin", "CartesianProduct")


def test_all_queries_stay_jvm_side_and_equi_joined(spark):
    bad = {}
    for name, q in QUERIES.items():
        plan = q(spark, SF)._jdf.queryExecution().executedPlan().toString()
        hits = [f for f in FORBIDDEN if f in plan]
        if hits:
            bad[name] = hits
    assert bad == {}


def test_flagship_scans_read_only_needed_columns(spark):
    import re
    plan = E.queries()["rate_index_sector"](spark, SF)._jdf.queryExecution().executedPlan().toString()
    schemas = re.findall(r"ReadSchema: struct<([^>]*)>", plan)
    assert schemas, plan
    widths = sorted(len(s.split(",")) for s in schemas)
    assert max(widths) <= 4, schemas          # orders: key, customer, status, date; customer: 1-2
