import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from clickmart.plans.ingest import validate_files
from clickmart.sources import csv_records
from clickmart.sources.csv_events import read_raw

from . import csvtree
from .csvtree import U1

HEAD = "user_id,session_id,query,results_count,timestamp\n"


def search_file(rows):
    out = io.StringIO()
    w = csv.writer(out, lineterminator="\n")
    for r in rows:
        w.writerow(r)
    return HEAD + out.getvalue()


def read_back(spark, base, **kw):
    raw = read_raw(spark, base=str(base), **kw)
    rows = raw.rows.orderBy("source_file", "block_start", "row_id")
    return [(r["user_id"], r["session_id"], r["query"], r["results_count"], r["timestamp"]) for r in rows.collect()]


def test_long_quoted_cell_and_line_breaks_are_valid(spark, tmp_path):
    day = "year=2025/month=06/day=01"
    rows = [(U1, "s1", '"' * 6000, "3", "2025-06-01T10:00:00"),
            (U1, "s2", "two\n\nlines, and\n" + U1 + ",x,y,z", "4", "2025-06-01T10:01:00"),
            (U1, "s3", "plain", "5", "2025-06-01T10:02:00")]
    csvtree.write(tmp_path, f"{day}/search.csv", search_file(rows))
    csvtree.write(tmp_path, f"{day}/click.csv", "user_id,session_id,timestamp,x_position,y_position\n"
                  f"{U1},s1,2025-06-01T10:00:05,1,2\n\n{U1},s1,2025-06-01T10:00:06,1,2\n")
    assert read_back(spark, tmp_path, pattern="search.csv") == rows
    got = {r["source_file"].rsplit("/", 1)[-1]: r for r in validate_files(spark, base=str(tmp_path)).verdicts.collect()}
    assert [(got[f].status, got[f].total_rows) for f in ("search.csv", "click.csv")] == [("valid", 3), ("valid", 2)]


def test_random_cells_like_the_csv_module(spark, tmp_path):
    rnd = random.Random(4)
    for i in range(12):
        rows = [(U1, f"s{k}", "".join(rnd.choice(['"', ",", "\n", "a", "bc", " ", '""']) for _ in range(rnd.randrange(9))) + "x",
                 str(k), "2025-06-01T10:00:00") for k in range(rnd.randrange(1, 30))]
        csvtree.write(tmp_path, f"year=2025/month=06/day={i + 1:02d}/search.csv", search_file(rows))
    want = [tuple(r) for f in sorted(tmp_path.rglob("*.csv")) for r in list(csv.reader(f.open(newline="")))[1:]]
    assert read_back(spark, tmp_path) == want


def test_quotes_inside_of_plain_cells_are_literal(spark, tmp_path):
    text = HEAD + f'{U1},s1,5" wide,1,2025-06-01T10:00:00\n{U1},s2,a "b" c,2,2025-06-01T10:01:00\n'
    csvtree.write(tmp_path, "year=2025/month=06/day=01/search.csv", text)
    assert [r[2] for r in read_back(spark, tmp_path)] == ['5" wide', 'a "b" c']


def test_records_across_splits(spark, tmp_path):
    rows = [(U1, f"s{k}", "line\n" * (k % 7) + "end", str(k), "2025-06-01T10:00:00") for k in range(400)]
    csvtree.write(tmp_path, "year=2025/month=06/day=01/search.csv", search_file(rows))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        raw = read_raw(spark, base=str(tmp_path))
        assert raw.rows.select("block_start").distinct().count() > 10
        got = sorted((r["session_id"], r["query"]) for r in raw.rows.collect())
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert got == sorted((r[1], r[2]) for r in rows)


def test_a_quote_that_never_closes_costs_its_own_file_only(spark, tmp_path):
    day = "year=2025/month=06/day=01"
    bad = HEAD + f'{U1},s1,"open,1,2025-06-01T10:00:00\n' + f"{U1},s2,x,1,2025-06-01T10:00:00\n" * 5000
    csvtree.write(tmp_path, f"{day}/search.csv", bad)
    csvtree.write(tmp_path, f"{day}/cart_event.csv",
                  f"action,timestamp,product_id,session_id,user_id\nadd,2025-06-01T10:03:00,P1,s2,{U1}\n")
    got = {r["event_type"]: r for r in validate_files(spark, base=str(tmp_path)).verdicts.collect()}
    assert got["search"].status == "invalid" and got["search"].total_rows == 1
    assert got["cart_event"].status == "valid"


@pytest.mark.parametrize("line, ends", [
    ("a,b", (0, 1)), ('"a', (1, 0)), ('a"', (0, 0)), ('"a"', (0, 1)), ('a,"', (1, 0)), ('"""', (1, 0)), ('""', (0, 1)),
    ('"a""b', (1, 0)), ('x","y"', (0, 0)), ('","', (0, 1))])
def test_what_a_line_does_to_the_state(spark, line, ends):
    df = csv_records.with_moves(spark.createDataFrame([(line,)], "value string")).first()

    def plain(state):
        i, fresh = 0, state == 0
        while i < len(line):
            c = line[i]
            if state == 1:
                if c == '"' and line[i + 1:i + 2] == '"':
                    i += 1
                elif c == '"':
                    state, fresh = 0, False
            elif c == '"' and fresh:
                state = 1
            else:
                fresh = c == ","
            i += 1
        return state

    assert (df["from_out"], df["from_in"]) == (plain(0), plain(1))
    assert ends[0] == plain(0)


def test_files_without_open_quotes_are_not_shuffled(spark, tmp_path):
    lines = spark.range(100).select(F.lit("f").alias("source_file"), F.lit(0).alias("block_start"), F.col("id").alias("row_id"),
                                    F.lit('a,"b",c').alias("value"))
    plan = csv_records.records(csv_records.with_moves(lines))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
