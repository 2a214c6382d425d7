from pyspark.sql import functions as F

from clickmart.plans.ingest import validate_files
from clickmart.sources.csv_events import read_raw, typed_events

from . import csvtree


def _verdicts(v):
    return {
        r.source_file.rsplit("/", 2)[-2] + "/" + r.source_file.rsplit("/", 1)[-1]: r
        for r in v.verdicts.collect()
    }


def test_read_by_header_name_and_dates(spark, tmp_path):
    base = csvtree.build(tmp_path / "raw")
    raw = read_raw(spark, base=str(base))
    cart = raw.rows.where(F.col("event_type") == "cart_event").orderBy("row_id").collect()
    assert [(r.action, r.product_id, r.session_id) for r in cart] == [("add", "P1", "s2"), ("remove", "P1", "s2")]
    assert raw.files.count() == 7
    day2 = read_raw(spark, base=str(base), dates=["2025-06-02"])
    assert day2.rows.count() == 1 and day2.files.count() == 1
    assert read_raw(spark, base=str(base), dates=["2025-07-01"]).rows is None
    typed = typed_events(raw.rows).where(F.col("event_type") == "page_view")
    assert sorted(r[0] for r in typed.select("time_on_page_seconds").collect() if r[0] is not None) == [12.0, 30.0, 40.0]


def test_file_verdicts(spark, tmp_path):
    base = csvtree.build(tmp_path / "raw")
    v = validate_files(spark, base=str(base))
    got = _verdicts(v)
    pv = got["day=01/page_view.csv"]
    assert pv.status == "invalid" and pv.failed_fields == ["time_on_page_seconds"] and pv.invalid_rows == 1
    click = got["day=01/click.csv"]
    assert click.status == "invalid"
    assert click.failed_fields == ["session_id", "timestamp", "user_id", "x_position", "y_position"]
    assert (click.invalid_rows, click.total_rows) == (4, 6)
    assert got["day=01/cart_event.csv"].status == "valid"
    prod = got["day=01/product_view.csv"]
    assert prod.status == "invalid" and prod.failed_fields == ["missing_column:price"]
    assert (prod.invalid_rows, prod.total_rows) == (2, 2)
    search = got["day=01/search.csv"]
    assert (search.status, search.total_rows, search.failed_fields) == ("valid", 0, [])
    assert got["day=01/notes.csv"].status == "unknown_event_type"
    assert got["day=02/page_view.csv"].status == "valid"
    m = v.metrics().first()
    assert (m.files_processed, m.valid_records, m.invalid_files) == (3, 3, 4)
    assert m.size_mb > 0


def test_routing_and_error_reports(spark, tmp_path):
    base = csvtree.build(tmp_path / "raw")
    v = validate_files(spark, base=str(base))
    total = v.checked.count()
    good, bad = v.valid_rows().count(), v.quarantined_rows().count()
    assert good + bad == total and good == 3
    reports = {r.file.rsplit("/", 1)[-1]: r for r in
               v.error_reports().withColumnRenamed("source_file", "file").collect()}
    click = reports["click.csv"]
    assert click.error_type == "validation_error"
    assert [r.element_id for r in click.first_invalid_rows] == ["e2", "e3", "e4"]
    assert reports["notes.csv"].error_type == "unknown_event_type"
    assert len(reports["product_view.csv"].first_invalid_rows) == 2


def test_unknown_columns_are_accepted(spark, tmp_path):
    """An unknown column, quoted cells, and a file whose lines span several splits."""
    base = tmp_path / "raw"
    day = "year=2025/month=06/day=01"
    header = "locale,user_id,session_id,page_url,page_type,timestamp,time_on_page_seconds,device_type\n"
    rows = "".join(f'"es, ""CO""",{csvtree.U1},s{i},"/a,{i}",home,2025-06-01T10:00:00,30,mobile\n' for i in range(400))
    csvtree.write(base, f"{day}/page_view.csv", header + rows)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        v = validate_files(spark, base=str(base))
        verdict = v.verdicts.first()
        assert (verdict.status, verdict.failed_fields, verdict.total_rows) == ("valid", [], 400)
        urls = {r.page_url for r in v.valid_rows().select("page_url").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert urls == {f"/a,{i}" for i in range(400)}


def test_many_headers_and_no_header(spark, tmp_path):
    base = tmp_path / "raw"
    day = "year=2025/month=06/day=01"
    for i in range(30):
        csvtree.write(base, f"{day}/search_{i}.csv",
                      f"x{i},user_id,session_id,query,timestamp\n1,{csvtree.U1},s1,q,2025-06-01T10:00:00\n")
    csvtree.write(base, f"{day}/click.csv", f"{csvtree.U1},s1,2025-06-01T10:00:00,1,2\n")
    got = _verdicts(validate_files(spark, base=str(base)))
    assert sum(r.status == "valid" for r in got.values()) == 30
    assert "missing_column:user_id" in got["day=01/click.csv"].failed_fields
    assert got["day=01/click.csv"].status == "invalid"
