from pyspark.sql import functions as F

from clickmart.functions.columns import blank_or_null, na_to_null, parse_number, stable, uuid_like


def test_uuid_spellings(spark):
    u = "12345678-1234-5678-1234-567812345678"
    cases = [
        (u, True), ("{" + u + "}", True), ("urn:uuid:" + u, True), (u.replace("-", ""), True),
        (u.upper(), True), ("{{" + u + "}}", True), ("urn:uuid:{" + u + "}", True), ("bad-1", False), (None, False), ("1234", False), ("g" * 32, False),
    ]
    df = spark.createDataFrame(cases, "v string, expected boolean")
    got = df.select(uuid_like("v").alias("got"), "expected").collect()
    assert all(r.got == r.expected for r in got)


def test_lenient_numbers(spark):
    df = spark.createDataFrame([("3",), ("3.0",), (" 7 ",), ("1e3",), ("inf",), ("NaN",), ("10d",), ("x",), (None,)], "v string")
    got = [r[0] for r in df.select(parse_number("v")).collect()]
    assert got[:5] == [3.0, 3.0, 7.0, 1000.0, float("inf")]
    assert got[5:] == [None, None, None, None]


def test_blank_and_na_tokens(spark):
    df = spark.createDataFrame([("  ",), ("",), ("\t",), ("a",), (None,)], "v string")
    assert [r[0] for r in df.select(blank_or_null("v")).collect()] == [True, True, True, False, True]
    df2 = spark.createDataFrame([("NA",), ("null",), ("NaN",), ("",), ("ok",)], "v string")
    assert [r[0] for r in df2.select(na_to_null("v")).collect()] == [None, None, None, None, "ok"]


def test_stable_means(spark):
    df = spark.createDataFrame([(0.1 * i,) for i in range(1, 200)], "x double")
    a = df.repartition(5).agg(stable(F.avg("x"))).first()[0]
    b = df.coalesce(1).agg(stable(F.avg("x"))).first()[0]
    assert a == b
    small = spark.createDataFrame([(0.004,), (0.004,)], "x double")
    assert small.agg(stable(F.avg("x"))).first()[0] == 0.004
    inf = spark.createDataFrame([(float("inf"),), (1.0,)], "x double")
    assert inf.agg(stable(F.avg("x"))).first()[0] == float("inf")
    assert spark.createDataFrame([(None,)], "x double").agg(stable(F.avg("x"))).first()[0] is None
