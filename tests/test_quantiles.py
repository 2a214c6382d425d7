import math
import random

from pyspark.sql import functions as F

from clickmart import session
from clickmart.operators.quantiles import exact_percentiles


def brute(values, p):
    xs = sorted(v for v in values if v is not None)
    return xs[max(1, math.ceil(p * len(xs))) - 1] if xs else None


def test_exact_percentiles_match_brute_force(spark):
    random.seed(11)
    rows = []
    for g, n in (("a", 5000), ("b", 37), (None, 400), ("dup", 900)):
        for _ in range(n):
            v = 7.0 if g == "dup" else (None if random.random() < 0.03 else round(random.gauss(50, 20), 2))
            rows.append((g, v))
    rows.append(("nulls", None))
    df = spark.createDataFrame(rows, "g string, x double")
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for accuracy in (20, 10000):  # 20 forces wide brackets and the histogram path
        got = {r.g: [r[f"q{i}"] for i in range(len(probs))]
               for r in exact_percentiles(df, "x", ["g"], probs, accuracy=accuracy).collect()}
        for g in ("a", "b", None, "dup"):
            values = [v for k, v in rows if k == g]
            assert got[g] == [brute(values, p) for p in probs], (g, accuracy)
        assert "nulls" not in got


def test_extra_aggregates_and_empty_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("nulls", None)], "g string, x double")
    out = exact_percentiles(df, "x", ["g"], [0.5], names=["med"], extra={"mean": F.avg("x")}, keep_empty=True)
    assert {r.g: (r.med, r["mean"]) for r in out.collect()} == {"a": (1.0, 2.0), "nulls": (None, None)}


def test_many_groups_fall_back_to_shuffle_joins(spark):
    df = spark.range(3000).selectExpr("id % 1000 as g", "cast(id as double) as x")
    from clickmart.plans import joins

    whole = joins.BROADCAST_MAX_ROWS
    want = {r.g: r.q0 for r in exact_percentiles(df, "x", ["g"], [0.5]).collect()}
    assert whole >= 1000 and want == {g: float(g + 1000) for g in range(1000)}


def test_a_group_of_a_million_values_is_summed_up_by_ranges(spark):
    n, mark = 1_000_000, session.scratch_mark(spark)
    # 7 has no common factor with n, so every value from 0 to n - 1 comes up once, out of order
    df = spark.range(n).selectExpr("'g' as g", "cast(id * 7 % 1000000 as double) as x")
    got = exact_percentiles(df, "x", ["g"], [0.25, 0.5, 0.9], accuracy=20).collect()
    assert [tuple(r) for r in got] == [("g", 249_999.0, 499_999.0, 899_999.0)]
    path = session._SCRATCH[spark.sparkContext.applicationId][mark]
    ranges = [r["count"] for r in spark.read.parquet(path).groupBy("__slab").count().collect()]
    assert sum(ranges) > n / 2 and len(ranges) > 1 and max(ranges) < 0.5 * sum(ranges)
