"""Shape of the physical plans: no Python in the core, few shuffles in the report."""

import re

import pytest

from sfpaths import SF001
from vigil.plans import catalog

REPORT = ["daily_risk_report", "patient_risk", "risk_matrix"]


def _plan(spark, name):
    df = catalog.QUERIES[name](spark, SF001)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["parse_float", "parse_collected_at", "grammar_scalars", "lab_validate", "lab_staged", "lab_rejected",
                                  "quality_gate", *REPORT])
def test_no_python_in_core_plans(spark, name):
    if name in catalog.QUERIES:
        assert not re.search("ArrowEvalPython|BatchEvalPython|InArrow|InPandas", _plan(spark, name))


def test_report_has_at_most_six_exchanges(spark):
    plan = _plan(spark, "daily_risk_report")
    final = plan.split("== Initial Plan ==")[0]
    assert len(re.findall(r"\bExchange (?:hash|range|Single|Round)", final)) <= 6, final
    assert "CartesianProduct" not in final and "NestedLoop" not in final
