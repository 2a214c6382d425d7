import pytest
from pyspark.sql import functions as F

from clickmart.operators import serving, warehouse
from clickmart.sinks.writers import load_warehouse, write_metric
from clickmart.sources.csv_events import read_metric

from .helpers import ev, events_df


def test_funnel_long_and_decimals(spark):
    wide = spark.createDataFrame(
        [(10, 5, 0, 0, 50.0, 0.0, None)],
        "stage1_page_view_users long, stage2_product_view_users long, stage3_cart_add_users long, "
        "stage4_checkout_users long, stage2_over_stage1_pct double, stage3_over_stage2_pct double, "
        "stage4_over_stage3_pct double",
    )
    fact = warehouse.build_fact("conversion_funnel", wide, "2025-06-01").orderBy("stage").collect()
    got = {r.stage: (r.user_count, None if r.conversion_rate is None else float(r.conversion_rate)) for r in fact}
    assert got == {"page_view": (10, None), "product_view": (5, 0.5), "cart_add": (0, 0.0), "checkout": (0, None)}
    assert str(fact[0].date) == "2025-06-01"


def test_decimal_overflow_becomes_null_and_scorecard_flags_it(spark):
    anomalies = spark.createDataFrame(
        [("s", "u", "home", 5000.0, 1234.5, True, "iqr"), ("s2", None, "home", 10.0, 2.5, False, "z_score")],
        "session_id string, user_id string, page_type string, time_on_page_seconds double, z_score double, "
        "is_iqr_outlier boolean, anomaly_type string",
    )
    fact = warehouse.build_fact("anomalies", anomalies, "2025-06-01")
    rows = {r.session_id: r for r in fact.collect()}
    assert rows["s"].z_score is None and float(rows["s"].time_on_page) == 5000.0
    assert warehouse.valid_records(fact).count() == 0
    card = {(r.table_name, r.rule): r for r in warehouse.dq_scorecard({"fact_anomalies": fact}).collect()}
    assert card[("fact_anomalies", 'ColumnValues "user_id" IS NOT NULL')].failed_rows == 1
    assert card[("fact_anomalies", 'ColumnValues "time_on_page" BETWEEN 0 AND 3600')].outcome == "fail"
    assert card[("fact_anomalies", 'ColumnExists "date"')].outcome == "pass"


def test_dims(spark):
    df = events_df(spark, [
        ev(1, "product_view", minute=1, product_id="P1", category="b", price=10.0),
        ev(2, "product_view", minute=2, product_id="P1", category="a", price=20.0),
        ev(3, "page_view", minute=3, page_url="/", page_type="home"),
    ])
    prod = warehouse.dim_product(df).first()
    assert (prod.product_id, prod.category, float(prod.avg_price)) == ("P1", "a", 15.0)
    days = warehouse.dim_date(df).collect()
    assert len(days) == 1 and days[0].day_of_week == 7  # 2025-06-01 is a Sunday
    card = {r.rule: r for r in warehouse.dq_scorecard({"dim_product": warehouse.dim_product(df)}).collect()}
    assert card['IsPrimaryKey "product_id"'].outcome == "pass"


def test_metric_writer_replaces_only_its_date(spark, tmp_path):
    base = str(tmp_path / "metrics")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    write_metric(df, base, "m", "2025-06-01")
    write_metric(df, base, "m", "2025-06-01")
    write_metric(df.limit(1), base, "m", "2025-06-02")
    assert read_metric(spark, base, "m", "2025-06-01").count() == 2
    assert read_metric(spark, base, "m").count() == 3


def test_empty_rerun_clears_its_date(spark, tmp_path):
    base = str(tmp_path / "metrics")
    df = spark.createDataFrame([("a", 1)], "k string, v int")
    write_metric(df, base, "m", "2025-06-01")
    write_metric(df, base, "m", "2025-06-02")
    write_metric(df.limit(0), base, "m", "2025-06-01")
    assert read_metric(spark, base, "m", "2025-06-01").count() == 0
    assert read_metric(spark, base, "m", "2025-06-02").count() == 1


def _fact(spark, day, page="/"):
    return spark.createDataFrame([(day, page, 1)], "date string, page_url string, rank int").withColumn(
        "date", F.col("date").cast("date"))


def test_warehouse_load_is_idempotent(spark, tmp_path):
    base = str(tmp_path / "dwh")
    fact = _fact(spark, "2025-06-01")
    first = load_warehouse({"fact_x": fact}, base, "2025-06-01")
    second = load_warehouse({"fact_x": fact}, base, "2025-06-01")
    assert first == second == {"fact_x": 1, "total": 1}
    load_warehouse({"fact_x": _fact(spark, "2025-06-02")}, base, "2025-06-02")
    assert spark.read.parquet(f"{base}/fact_x").count() == 2
    load_warehouse({"fact_x": fact.limit(0)}, base, "2025-06-01")
    assert [str(r.date) for r in spark.read.parquet(f"{base}/fact_x").collect()] == ["2025-06-02"]
    load_warehouse({"fact_x": fact}, base, "2025-06-01", mode="append")
    assert spark.read.parquet(f"{base}/fact_x").count() == 2


def test_dimensions_keep_earlier_keys(spark, tmp_path):
    base = str(tmp_path / "dwh")
    schema = "product_id string, category string, avg_price decimal(10,2)"

    def dims(*rows):
        return {"dim_product": spark.createDataFrame([(p, c, None) for p, c in rows], schema)}

    load_warehouse(dims(("P1", "a"), ("P2", "b")), base, "2025-06-01")
    load_warehouse(dims(("P2", "c"), ("P3", "d")), base, "2025-06-02")
    load_warehouse(dims(), base, "2025-06-03")
    rows = spark.read.parquet(f"{base}/dim_product").collect()
    assert sorted((r.product_id, r.category) for r in rows) == [("P1", "a"), ("P2", "c"), ("P3", "d")]


def test_serving_parameters_and_order(spark):
    fact = spark.createDataFrame(
        [("2025-06-01", "mobile", "Peru", 1.5, 3), ("2025-06-01", "mobile", "Chile", 2.0, 9),
         ("2025-06-01", "tablet", "Peru", 3.0, 4), ("2025-06-02", "mobile", "Peru", 1.0, 99)],
        "date string, device_type string, country string, avg_time_seconds double, session_count int",
    ).withColumn("date", F.col("date").cast("date"))
    out = serving.sessions_summary(fact, "2025-06-01", device="mobile").collect()
    assert [(r.country, r.session_count) for r in out] == [("Chile", 9), ("Peru", 3)]
    assert serving.sessions_summary(fact, "2025-06-01", country="", device="").count() == 3
    with pytest.raises(ValueError):
        serving.check_date("2025-02-30")
    with pytest.raises(ValueError):
        serving.check_date("20250601")
    with pytest.raises(ValueError):
        serving.check_limit(0)
    with pytest.raises(ValueError):
        serving.check_limit("abc")
    with pytest.raises(ValueError):
        serving.check_metric("clicks")
    assert serving.check_limit(None) == 10 and serving.check_limit("100") == 100


def test_load_scores_what_it_writes(spark, tmp_path):
    """The counts of the load's own observations equal those of a scan of the loaded tables."""
    from clickmart.sinks.writers import load_scored

    base = str(tmp_path / "dwh")
    fact = spark.createDataFrame(
        [("2025-06-01", "s", "u", 5000.0), ("2025-06-01", None, "u", 10.0), ("2025-06-01", "t", None, None)],
        "date string, session_id string, user_id string, time_on_page double",
    ).withColumn("date", F.col("date").cast("date"))
    dims = spark.createDataFrame([("/a", "home"), ("/a", "cart"), ("/b", None)], "page_url string, page_type string")
    tables = {"fact_anomalies": fact, "dim_page": dims}
    counts, card = load_scored(tables, base, "2025-06-01")
    assert counts == {"fact_anomalies": 3, "dim_page": 3, "total": 6}
    stored = {t: spark.read.parquet(f"{base}/{t}") for t in tables}
    assert sorted(map(tuple, card.collect())) == sorted(map(tuple, warehouse.dq_scorecard(stored).collect()))
    failed = {(r.table_name, r.rule): r.failed_rows for r in card.collect()}
    assert failed["fact_anomalies", 'ColumnValues "time_on_page" BETWEEN 0 AND 3600'] == 2
    assert failed["dim_page", 'IsPrimaryKey "page_url"'] == 1
    # an empty load is scored too
    counts, card = load_scored({"fact_anomalies": fact.limit(0)}, base, "2025-06-01")
    assert counts["total"] == 0 and {r.outcome for r in card.collect()} == {"pass"}
