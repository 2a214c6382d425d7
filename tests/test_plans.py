"""Plan-shape guards: the scale properties the operators are built around."""

import pytest

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"
FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin")


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [
    "top_pages", "bounce_rate", "conversion_funnel", "high_view_low_cart", "navigation_paths",
    "device_country_time", "anomalies", "dedup_events", "file_verdicts", "route_valid",
    "error_report", "fact_top_pages", "dim_date", "report_anomalies",
])
def test_no_pairwise_joins(spark, name):
    text = plan(entry_mod.queries()[name](spark, SF))
    for op in FORBIDDEN:
        assert op not in text, f"{name} plans a {op}"


def test_dedup_limits_map_side(spark):
    text = plan(entry_mod.queries()["dedup_events"](spark, SF))
    assert text.count("WindowGroupLimit") >= 2  # partial (map side) + final


def test_group_stats_are_broadcast_not_windowed(spark):
    text = plan(entry_mod.queries()["anomalies"](spark, SF))
    assert "BroadcastHashJoin" in text
    # statistics arrive as a size-checked local relation; no aggregate window anywhere
    assert "Scan ExistingRDD" in text
    windows = [line for line in text.splitlines() if "Window [" in line]
    assert all("row_number()" in line for line in windows)


def test_funnel_is_single_pass_without_expand(spark):
    text = plan(entry_mod.queries()["conversion_funnel"](spark, SF))
    assert "Expand" not in text
    assert "partial_max" in text


def test_first_bad_rows_limited_map_side(spark):
    text = plan(entry_mod.queries()["error_report"](spark, SF))
    assert "WindowGroupLimit" in text


@pytest.mark.parametrize("name", [
    "conversion_funnel", "bounce_rate", "navigation_paths", "dim_page", "dim_date", "dedup_events",
    "fact_conversion_funnel", "report_pages_bounce",
])
def test_building_starts_no_metric_job(spark, name):
    """Queries that read no imputed column are plain lazy plans (reading a schema is one job
    at most)."""
    sc = spark.sparkContext
    group = f"build-{name}"
    sc.setJobGroup(group, group)
    entry_mod.queries()[name](spark, SF)
    jobs = sc.statusTracker().getJobIdsForGroup(group)
    sc.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) <= 1
