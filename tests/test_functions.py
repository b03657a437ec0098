"""Column functions: tokeniser, JVM-style split, decay, weights, normalise."""

import pytest
from pyspark.sql import functions as F

from feedrec.functions import act_weight, age_days, java_split, normalize, split_limit, tokenize_tags


def one(spark, expr, value):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v")).alias("r")).first()["r"]


@pytest.mark.parametrize("tags,expected", [
    ("a,,b", ["a", "", "b"]),
    ("a，其他", ["a"]),
    ("。,x", ["x"]),
    ("a, ", ["a"]),
    ("a,b,,", ["a", "b"]),
    ("", [""]),
    (",,", []),
    ("x|y,\\\\", ["x|y"]),
    ("其他\n", ["其他\n"]),   # a whole-token match only: the trailing newline keeps it
])
def test_tokenize_tags(spark, tags, expected):
    assert one(spark, tokenize_tags, tags) == expected


@pytest.mark.parametrize("s,expected", [
    ("a\tb\t\t", ["a", "b"]),
    ("a\t\tb", ["a", "", "b"]),
    ("", [""]),
    ("\t\t", []),
])
def test_java_split(spark, s, expected):
    assert one(spark, lambda c: java_split(c, "\t"), s) == expected


def test_split_limit(spark):
    r = one(spark, lambda c: split_limit(c, "::", 2), "1::Toy Story (1995)::Adventure|Animation")
    assert r == ["1", "Toy Story (1995)::Adventure|Animation"]


def test_bad_time_counts_as_window_length(spark):
    df = spark.createDataFrame([("x",), ("2001-07-30 00:00:00",), ("2001-07-31",)], "t string")
    out = df.select(age_days("t", "2001-08-01", 730).alias("a"),
                    age_days("t", "2001-08-01", 180, lenient=True).alias("l")).collect()
    assert [r["a"] for r in out] == [730, 2, 730]
    assert [r["l"] for r in out] == [180, 2, 1]


def test_act_weight(spark):
    df = spark.createDataFrame([("Scan",), ("Download",), ("Other",)], "a string")
    assert [r[0] for r in df.select(act_weight("a", 1.0, 5.0)).collect()] == [1.0, 5.0, 0.0]


def test_normalize_cases(spark):
    data = [("n1", "a", 3.0),
            ("n2", "a", 2.0), ("n2", "b", 2.0),
            ("n3", "a", 1.0), ("n3", "b", 2.0), ("n3", "c", 3.0),
            ("t3", "a", 5.0), ("t3", "b", 5.0), ("t3", "c", 5.0)]
    df = spark.createDataFrame(data, "k string, i string, w double")
    got = {(r.k, r.i): round(r.weight, 9) for r in normalize(df, "k", "i", "w").collect()}
    assert got[("n1", "a")] == 1.0
    assert got[("n2", "a")] == 1.0 and got[("n2", "b")] == 0.1   # tie: smaller item first
    assert got[("n3", "c")] == 1.0 and got[("n3", "b")] == 0.55 and got[("n3", "a")] == 0.1
    assert got[("t3", "a")] == got[("t3", "b")] == got[("t3", "c")] == 1.0


def test_age_does_not_depend_on_session_zone(spark):
    df = spark.createDataFrame([("2001-07-30 23:59:59",), ("2000-02-29 00:00:00",), ("bad",)], "t string")
    expr = age_days("t", "2001-08-01", 730)
    utc = [r[0] for r in df.select(expr).collect()]
    spark.conf.set("spark.sql.session.timeZone", "Asia/Shanghai")
    try:
        other = [r[0] for r in df.select(expr).collect()]
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert utc == other == [1, 519, 730]
