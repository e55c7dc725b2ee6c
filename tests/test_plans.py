"""Properties of the physical plans that matter at scale."""

import re

import pytest

from __spark_entry__ import queries
from logharbor.functions.tagging import accepted
from logharbor.operators.detections import detect_bruteforce, detect_exfiltration
from logharbor.plans.fixtures import firewall_lines
from logharbor.session import SLICE_ROWS_KEY
from logharbor.sources.firewall import parse_firewall_lines
from tests.conftest import SF
from tests.test_detections import AS_OF, FIREWALL, SCHEMA


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["counter_rate", "log_clusters", "sequence_attach", "revoked_tokens", "scaled_features"])
def test_no_cross_joins(spark, name):
    plan = plan_of(queries()[name](spark, SF))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_time_filter_and_columns_reach_the_scan(spark, tmp_path):
    spark.createDataFrame(FIREWALL, SCHEMA).write.parquet(str(tmp_path / "fw"))
    fw = spark.read.parquet(str(tmp_path / "fw"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    plan = plan_of(detect_bruteforce(fw, AS_OF))
    assert "GreaterThanOrEqual(TimeGenerated" in plan and "In(DestinationPort" in plan
    assert "RuleName" not in plan and "BytesTransferred" not in plan
    assert "GreaterThanOrEqual(TimeGenerated" in plan_of(detect_exfiltration(fw, AS_OF))


def test_parsing_is_one_narrow_pass_without_python(spark):
    plan = plan_of(accepted(parse_firewall_lines(firewall_lines(spark, SF), AS_OF)))
    assert "Exchange" not in plan and "Python" not in plan
    # the filter sits above the generator, so the parse below is evaluated once
    assert plan.index("Filter isnull(reason") < plan.index("Generate inline")


@pytest.mark.parametrize(
    ("name", "scans"), [("alert_episodes", 2), ("failure_streaks", 2), ("repeat_sequences", 2), ("sequence_attach", 2), ("counter_delta", 2)]
)
def test_ordered_work_has_one_plan_at_every_size(spark, name, scans):
    """The rows are read at most twice, and no plan depends on how many rows a slice has."""
    plans = []
    for least in ("2", "5"):
        spark.conf.set(SLICE_ROWS_KEY, least)
        try:
            df = queries()[name](spark, SF)
        finally:
            spark.conf.unset(SLICE_ROWS_KEY)
        plans.append(re.sub(r"#\d+L?|\b\d+\b|plan_id=\S+", "", df._jdf.queryExecution().optimizedPlan().toString()))
        df.collect()
        final = plan_of(df)
        final = final[final.index("== Final Plan ==") : final.index("== Initial Plan ==")] if "== Initial Plan ==" in final else final
        assert len(re.findall(r"FileScan|Scan ExistingRDD", final)) <= scans
    assert re.findall(r"Join|Window|Aggregate|Relation", plans[0]) == re.findall(r"Join|Window|Aggregate|Relation", plans[1])
