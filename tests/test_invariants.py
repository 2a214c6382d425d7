"""Invariants over the fixture at sf0.001 (SURVEY §5 (3))."""

from pyspark.sql import functions as F

import __spark_entry__ as entry_mod

SF = "/root/testdata/sf0.001"


def q(spark, name):
    return entry_mod.queries()[name](spark, SF)


def test_routing_partitions_every_row(spark):
    total = q(spark, "validate_common").count()
    assert q(spark, "route_valid").count() + q(spark, "route_quarantine").count() == total


def test_funnel_ratios_reproduce_counts(spark):
    r = q(spark, "conversion_funnel").first()
    pairs = [
        ("stage2_over_stage1_pct", "stage2_product_view_users", "stage1_page_view_users"),
        ("stage3_over_stage2_pct", "stage3_cart_add_users", "stage2_product_view_users"),
        ("stage4_over_stage3_pct", "stage4_checkout_users", "stage3_cart_add_users"),
    ]
    for pct, num, den in pairs:
        assert round(r[pct] * r[den] / 100) == r[num]


def test_every_anomaly_matches_its_label(spark):
    rows = q(spark, "anomalies").collect()
    assert rows
    for r in rows:
        high = abs(r.z_score) > 2
        if r.anomaly_type == "z_score_and_iqr":
            assert high and r.is_iqr_outlier
        elif r.anomaly_type == "z_score":
            assert high and not r.is_iqr_outlier
        else:
            assert r.anomaly_type == "iqr" and r.is_iqr_outlier and not high


def test_file_verdict_counts_match_fixture_doc(spark):
    v = q(spark, "file_verdicts")
    agg = v.agg(
        F.count(F.lit(1)).alias("files"),
        F.count_if(F.col("status") == "invalid").alias("invalid"),
        F.sum("invalid_rows").alias("bad_rows"),
        F.sum(F.when(F.col("status") == "invalid", F.col("total_rows"))).alias("rows_in_bad"),
    ).first()
    assert (agg.files, agg.invalid, agg.bad_rows, agg.rows_in_bad) == (142, 31, 46, 290)


def test_facts_keep_metric_rows(spark):
    assert q(spark, "fact_anomalies").count() == q(spark, "anomalies").count()
    assert q(spark, "fact_conversion_funnel").count() == 4
    ranks = [r.rank for r in q(spark, "fact_top_pages").orderBy("rank").collect()]
    assert ranks == list(range(1, len(ranks) + 1))
