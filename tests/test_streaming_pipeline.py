import duckdb
from pyspark.sql import functions as F

from clickmart.plans import pipeline
from clickmart.plans.ingest import validate_files
from clickmart.streaming.validate_stream import read_verdicts, start_validation_stream

from . import csvtree


def _key(rows):
    return sorted((r.source_file, r.status, tuple(r.failed_fields), r.invalid_rows, r.total_rows) for r in rows)


def test_stream_matches_batch_and_restart_adds_nothing(spark, tmp_path):
    base = str(csvtree.build(tmp_path / "raw"))
    out, ckpt = str(tmp_path / "verdicts"), str(tmp_path / "ckpt")
    q = start_validation_stream(spark, base, out, ckpt, max_files_per_trigger=2)
    q.awaitTermination()
    assert q.exception() is None
    streamed = read_verdicts(spark, out)
    assert streamed.select("batch_id").distinct().count() == 4  # 7 files, 2 per batch
    batch = validate_files(spark, base=base).verdicts
    assert _key(streamed.collect()) == _key(batch.collect())
    # restart from the checkpoint: no new files, nothing added
    q2 = start_validation_stream(spark, base, out, ckpt, max_files_per_trigger=2)
    q2.awaitTermination()
    assert read_verdicts(spark, out).count() == 7
    # a new file arrives: only it is validated
    csvtree.write(tmp_path / "raw", "year=2025/month=06/day=03/search.csv",
                  "user_id,session_id,query,results_count,timestamp\n"
                  f"{csvtree.U1},s1,shoes,3,2025-06-03T08:00:00\n")
    q3 = start_validation_stream(spark, base, out, ckpt, max_files_per_trigger=2)
    q3.awaitTermination()
    v = read_verdicts(spark, out)
    assert v.count() == 8
    assert v.where(F.col("source_file").endswith("day=03/search.csv")).first().status == "valid"


PV = "user_id,session_id,page_url,page_type,timestamp,time_on_page_seconds,referrer,device_type,country\n"
PRODUCT = "user_id,session_id,product_id,category,price,timestamp,time_on_page_seconds\n"


def _days(tmp_path):
    base = tmp_path / "raw"
    d1, d2 = "year=2025/month=06/day=01", "year=2025/month=06/day=02"
    u = csvtree.U1
    csvtree.write(base, f"{d1}/page_view.csv", PV + "".join(
        f"{u},s{i},/p{i},home,2025-06-01T10:0{i}:00,{10 + i},google,mobile,Peru\n" for i in range(3)))
    csvtree.write(base, f"{d1}/product_view.csv", PRODUCT
                  + f"{u},s1,P1,c,5,2025-06-01T11:00:00,3\n{u},s1,P2,c,inf,2025-06-01T11:01:00,3\n")
    csvtree.write(base, f"{d1}/product_view_late.csv", PRODUCT + f"{u},s1,P1,c,-4,2025-06-01T12:00:00,3\n")
    csvtree.write(base, f"{d2}/page_view.csv", PV + f"{u},s9,/q,cart,2025-06-02T10:00:00,7,google,tablet,Chile\n")
    csvtree.write(base, f"{d2}/product_view.csv", PRODUCT + f"{u},s9,P3,c,8,2025-06-02T11:00:00,3\n")
    return str(base)


def test_pipeline_run_is_repeatable(spark, tmp_path):
    base = _days(tmp_path)
    out, dwh = str(tmp_path / "processed"), str(tmp_path / "dwh")
    quarantine = str(tmp_path / "quarantine")
    first = pipeline.run(spark, base, out, "2025-06-01", warehouse_path=dwh, quarantine_path=quarantine)
    second = pipeline.run(spark, base, out, "2025-06-01", warehouse_path=dwh, quarantine_path=quarantine)
    assert first == second
    assert first["fact_conversion_funnel"] == 4 and first["fact_device_country_time"] == 1
    # the invalid file (price -4) shapes nothing, and lies in quarantine once
    prices = {r.product_id: r.avg_price for r in spark.read.parquet(f"{dwh}/dim_product").collect()}
    assert float(prices["P1"]) == 5.0 and prices["P2"] is None  # inf fits no decimal
    day = f"{quarantine}/date=2025-06-01"
    assert spark.read.parquet(f"{day}/rows").count() == 1
    assert spark.read.json(f"{day}/reports").count() == 1
    assert spark.read.parquet(f"{out}/top_pages").where("date = DATE'2025-06-01'").count() == 3
    # the second day adds to facts and dimensions
    pipeline.run(spark, base, out, "2025-06-02", warehouse_path=dwh)
    assert spark.read.parquet(f"{dwh}/fact_conversion_funnel").count() == 8
    assert {r.product_id for r in spark.read.parquet(f"{dwh}/dim_product").collect()} == {"P1", "P2", "P3"}
    assert spark.read.parquet(f"{dwh}/dim_date").count() == 2
    card = spark.read.parquet(f"{dwh}/dq_scorecard").where("date = DATE'2025-06-02'")
    assert card.count() > 10 and card.where("outcome = 'fail'").isEmpty()
    # a day without files clears its own output only
    assert pipeline.run(spark, base, out, "2025-06-03", warehouse_path=dwh)["fact_top_pages"] == 0
    assert spark.read.parquet(f"{out}/top_pages").select("date").distinct().count() == 2


def test_scratch_folders_go_with_the_run(spark, tmp_path):
    from clickmart.session import scratch_mark, shared_dir

    base = _days(tmp_path)
    mark = scratch_mark(spark)
    pipeline.run(spark, base, str(tmp_path / "out"), "2025-06-01")
    assert scratch_mark(spark) == mark and shared_dir(spark)


def test_replayed_batch_changes_nothing(spark, tmp_path):
    from clickmart.streaming.validate_stream import validate_batch

    base = csvtree.build(tmp_path / "raw")
    paths = sorted(str(p) for p in (tmp_path / "raw").rglob("*.csv"))
    at = {k: str(tmp_path / k) for k in ("verdicts", "quarantine", "reports", "summary")}

    def counts():
        validate_batch(spark, paths, str(base), at["verdicts"], 0, at["quarantine"], at["reports"], at["summary"])
        return [spark.read.parquet(at["verdicts"]).count(), spark.read.parquet(at["quarantine"]).count(),
                spark.read.json(at["reports"]).count(), spark.read.parquet(at["summary"]).first().processed]

    first = counts()
    assert first == counts() and first[0] == 7 and first[2] == 4 and first[3] == 7


def test_shared_folder_is_required_off_a_local_master():
    import pytest

    from clickmart.session import shared_dir

    class Context:
        master = "yarn"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            @staticmethod
            def get(key, default=None):
                return None

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        shared_dir(Session())


def test_entry_contract(spark):
    import __spark_entry__ as entry_mod

    df = entry_mod.entry(spark)
    assert df.count() > 0
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


def test_oracle_agrees_on_small_fixture(spark):
    """A few registered queries against their DuckDB SQL at sf0.001."""
    import __spark_entry__ as entry_mod

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW events AS SELECT * FROM read_parquet('{sf}/events.parquet')")
    for name in ("bounce_rate", "conversion_funnel", "anomalies", "file_verdicts", "fact_top_pages",
                 "high_view_low_cart", "csv_file_verdicts", "pipeline_facts_valid_only", "navigation_paths"):
        got = entry_mod.queries()[name](spark, sf)
        res = con.execute(entry_mod.oracle_sql()[name])
        cols = [d[0] for d in res.description]
        want = sorted(map(str, (tuple(r[cols.index(c)] for c in sorted(cols)) for r in res.fetchall())))
        have = sorted(map(str, (tuple(r[c] for c in sorted(got.columns)) for r in got.collect())))
        assert sorted(got.columns) == sorted(cols), name
        assert have == want, name


def test_quarantine_dir_is_ignored_and_summary(spark, tmp_path):
    from clickmart.streaming.validate_stream import batch_summary

    base = csvtree.build(tmp_path / "raw")
    csvtree.write(base, "quarantine/year=2025/month=06/day=01/click.csv", "user_id,session_id,timestamp\n")
    out, ckpt = str(tmp_path / "verdicts"), str(tmp_path / "ckpt")
    q = start_validation_stream(spark, str(base), out, ckpt, max_files_per_trigger=100)
    q.awaitTermination()
    v = read_verdicts(spark, out)
    assert v.count() == 7
    assert v.where(F.col("source_file").contains("/quarantine/")).count() == 0
    s = batch_summary(v).collect()
    assert len(s) == 1 and s[0].processed == 7 and s[0].valid_files == 3 and s[0].valid_records == 3


def test_quarantine_and_error_report_sinks(spark, tmp_path):
    import json

    from clickmart.sinks.writers import write_error_reports, write_quarantine

    base = csvtree.build(tmp_path / "raw")
    v = validate_files(spark, base=str(base))
    write_quarantine(v.checked, v.verdicts, str(tmp_path / "quarantine"))
    q = spark.read.parquet(str(tmp_path / "quarantine"))
    assert q.count() == v.checked.count() - 3
    assert {r.event_type for r in q.select("event_type").distinct().collect()} == {
        "page_view", "click", "product_view", None}
    write_error_reports(v.error_reports(), str(tmp_path / "reports"))
    docs = [json.loads(line) for f in (tmp_path / "reports").rglob("*.json") for line in f.read_text().splitlines()]
    assert len(docs) == 4
    click = next(d for d in docs if d["file"].endswith("click.csv"))
    assert set(click) == {"file", "timestamp_proceso", "tipo_error", "campos_fallidos",
                          "primeras_3_filas_problematicas"}
    assert click["tipo_error"] == "validation_error"
    assert len(click["primeras_3_filas_problematicas"]) == 3
