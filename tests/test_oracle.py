"""Every registered query with oracle SQL equals DuckDB's result (sf0.001)."""

import os
import re
import sys

from conftest import ROOT, SF_MID, SF_SMALL

from reviewlens.plans.catalog import QUERIES
from reviewlens.plans.oracle import ORACLE

sys.path.insert(0, os.path.join(ROOT, "tools"))


#: Need all ten folds to hold both classes, which the smallest tables do not; the last one is the whole study.
ON_MID = ["tune_lr_closed", "tune_rf_closed"]
WHOLE_STUDY = ["compare_shape"]


def compared(spark, sf, names):
    from oracle_check import compare

    return {k: v for k, v in compare(spark, sf, names).items() if not v["ok"]}


def test_all_oracle_queries_match(spark):
    assert not compared(spark, SF_SMALL, sorted(set(ORACLE) - {*ON_MID, *WHOLE_STUDY}))


def test_tuning_in_closed_form(spark):
    assert not compared(spark, SF_MID, ON_MID)


def test_no_python_in_relational_plans(spark):
    for name in sorted(set(ORACLE) - {*ON_MID, *WHOLE_STUDY, "csv_scan", "csv_scan_split"}):
        plan = QUERIES[name](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
        assert "EvalPython" not in plan and "PythonUDF" not in plan, name


def test_line_item_votes_read_two_columns(spark):
    plan = QUERIES["votes_scale"](spark, SF_SMALL)._jdf.queryExecution().executedPlan()
    scans = re.findall(r"ReadSchema: struct<([^>]*)>?", plan.toString())
    columns = sorted(c.split(":")[0] for scan in scans for c in scan.split(","))
    assert [c for c in columns if c.startswith("l_")] == ["l_linenumber", "l_orderkey"]
    assert plan.toString().count("Exchange hashpartitioning") <= 2
