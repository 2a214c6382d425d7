import json

import pytest
from pyspark.sql import functions as F

from clickmart.operators import serving, warehouse
from clickmart.plans.ingest import validate_files
from clickmart.plans.load import load_pending, pending
from clickmart.sinks import publish as pub
from clickmart.sinks.writers import load_table, load_warehouse, report_folder, write_error_reports, write_metric

from . import csvtree
from .helpers import ev, events_df


def _failing(spark, rows):
    """A frame whose last task fails while it is written."""
    boom = F.when(F.col("v") == 99, F.raise_error(F.lit("lost half-way"))).otherwise(F.col("v"))
    return spark.createDataFrame([*rows, ("z", 99)], "k string, v int").withColumn("v", boom.cast("int"))


@pytest.mark.parametrize("mode", ["truncate", "merge", "replace_date"])
def test_a_load_that_fails_leaves_the_table(spark, tmp_path, mode):
    path = str(tmp_path / "dwh" / "t")
    good = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    kw = {"mode": mode, "process_date": "2025-06-01", "key": "k"}
    assert load_table(good, path, **kw) == 2
    with pytest.raises(Exception, match="lost half-way"):
        load_table(_failing(spark, [("c", 3)]), path, **kw)
    rows = lambda: sorted(r["k"] for r in spark.read.parquet(path).collect())
    assert rows() == ["a", "b"]
    assert not [p for p in tmp_path.rglob("_new-*")] and not [p for p in tmp_path.rglob("_old-*")]
    assert load_table(spark.createDataFrame([("c", 3)], "k string, v int"), path, **kw) == (3 if mode == "merge" else 1)
    assert rows() == (["a", "b", "c"] if mode == "merge" else ["c"])


def test_a_switch_that_was_cut_off_is_finished(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    old = spark.createDataFrame([("a", 1)], "k string, v int")
    load_table(old, path, "truncate")
    real, calls = pub.rename_dir, []

    def cut_off(s, a, b):
        calls.append(a)
        if len(calls) == 2:  # the old folder is aside, the new one hasn't its name yet
            raise KeyboardInterrupt
        real(s, a, b)

    monkeypatch.setattr(pub, "rename_dir", cut_off)
    with pytest.raises(KeyboardInterrupt):
        pub.publish(spark, path, old.limit(0).write.parquet)
    monkeypatch.undo()
    assert spark.read.parquet(path).count() == 1
    pub.rename_dir(spark, path, pub._aside(path))  # as if the process had ended there
    pub.recover(spark, path)
    assert spark.read.parquet(path).count() == 1


def _products(spark, *prices):
    return events_df(spark, [ev(i, "product_view", minute=i % 60, product_id="P1", category="c", price=float(p))
                             for i, p in enumerate(prices)])


def _load_products(spark, base, day, events):
    load_warehouse({"dim_product": warehouse.dim_product(events)}, base, day,
                   states={"dim_product": warehouse.product_state(events)})
    return {r.product_id: float(r.avg_price) for r in spark.read.parquet(f"{base}/dim_product").collect()}


def test_average_price_is_the_mean_over_all_days(spark, tmp_path):
    base = str(tmp_path / "dwh")
    assert _load_products(spark, base, "2025-06-01", _products(spark, 10, 10, 10)) == {"P1": 10.0}
    assert _load_products(spark, base, "2025-06-02", _products(spark, 2)) == {"P1": 8.0}
    assert _load_products(spark, base, "2025-06-02", _products(spark, 2)) == {"P1": 8.0}  # loaded again
    assert _load_products(spark, base, "2025-06-01", _products(spark, 4)) == {"P1": 3.0}  # day one computed again
    assert _load_products(spark, base, "2025-06-03", _products(spark)) == {"P1": 3.0}


def _bounce(spark, *rows):
    return spark.createDataFrame(list(rows), "page_type string, total_sessions long, bounced_sessions long, bounce_rate double")


def test_ledger_loads_each_date_once(spark, tmp_path):
    base, dwh = str(tmp_path / "metrics"), str(tmp_path / "dwh")
    only = ("bounce_rate",)
    assert load_pending(spark, base, dwh, only) == {}
    write_metric(_bounce(spark, ("home", 10, 4, 40.0), ("cart", 5, 1, 20.0)), base, "bounce_rate", "2025-06-02")
    assert load_pending(spark, base, dwh, only) == {("bounce_rate", "2025-06-02"): 2}
    assert load_pending(spark, base, dwh, only) == {}
    write_metric(_bounce(spark, ("home", 7, 7, 100.0)), base, "bounce_rate", "2025-06-01")  # a late date
    assert [(r["metric"], str(r["date"])) for r in pending(spark, base, dwh, only).collect()] == [("bounce_rate", "2025-06-01")]
    assert load_pending(spark, base, dwh, only) == {("bounce_rate", "2025-06-01"): 1}
    write_metric(_bounce(spark, ("home", 8, 4, 50.0)), base, "bounce_rate", "2025-06-02")  # computed again
    assert load_pending(spark, base, dwh, only) == {("bounce_rate", "2025-06-02"): 1}
    rows = serving.stored_fact(spark, dwh, "bounce_rate").collect()
    assert sorted((str(r["date"]), r["total_sessions"]) for r in rows) == [("2025-06-01", 7), ("2025-06-02", 8)]


def test_reports_on_stored_facts_read_one_day(spark, tmp_path):
    base, dwh = str(tmp_path / "metrics"), str(tmp_path / "dwh")
    for day, n in (("2025-06-01", 3), ("2025-06-02", 9)):
        write_metric(_bounce(spark, ("home", n, 1, 100.0 / n)), base, "bounce_rate", day)
    load_pending(spark, base, dwh, ("bounce_rate",))
    report = serving.pages_top(serving.stored_fact(spark, dwh, "bounce_rate"), "bounce_rate", "2025-06-02", 5)
    assert [(r["page_type"], r["total_sessions"]) for r in report.collect()] == [("home", 9)]
    plan = report._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan and "2025-06-02" in plan


def test_an_error_report_is_found_by_its_file(spark, tmp_path):
    base = csvtree.build(tmp_path / "raw")
    path = str(tmp_path / "reports")
    for _ in range(2):  # a retry replaces it
        v = validate_files(spark, base=str(base))
        write_error_reports(v.error_reports(), path)
        bad = [r["source_file"] for r in v.verdicts.where("status != 'valid'").collect()]
        assert len(bad) == 4
        for file in bad:
            folder = report_folder(path, file)
            lines = [x for f in __import__("pathlib").Path(folder).glob("*.json") for x in f.read_text().splitlines()]
            assert [json.loads(x)["file"] for x in lines] == [file]
