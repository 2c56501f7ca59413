import math

from pyspark.sql import functions as F

from daymosaic.fixed_values import INDICATORS
from daymosaic.functions.missing import clamp01, mean_skip_missing, not_listed, ratio_or_nan, sum_unless_missing
from daymosaic.operators.quality import qc_clean, quarantine_split

NAN = float("nan")


def indicators(spark, rows):
    """Rows of (id, Psi, DDS, LFMC); every other indicator is 7."""
    df = spark.createDataFrame(rows, "id int, Psi double, DDS double, LFMC double")
    return df.withColumns({v: F.lit(7.0) for v in INDICATORS if v not in ("Psi", "DDS", "LFMC")})


def cleaned(spark, rows):
    return {r["id"]: r for r in qc_clean(indicators(spark, rows)).collect()}


def test_sentinel_null_and_nan_psi_blank_the_whole_row(spark):
    rows = cleaned(spark, [(1, -40.0, 1.0, 1.0), (2, None, 1.0, 1.0), (3, NAN, 1.0, 1.0), (4, -1.0, 1.0, 1.0)])
    for i in (1, 2, 3):
        assert all(rows[i][v] is None for v in INDICATORS)
    assert rows[4]["Theta"] == 7.0 and rows[4]["Psi"] == -1.0


def test_nan_blanks_the_row_but_null_does_not(spark):
    rows = cleaned(spark, [(1, -1.0, NAN, 1.0), (2, -1.0, None, 1.0), (3, -1.0, 1.0, NAN), (4, -1.0, 1.0, None),
                           (5, -1.0, None, None)])
    assert all(rows[i][v] is None for i in (1, 3) for v in INDICATORS)
    assert rows[2]["Theta"] == 7.0 and rows[2]["DDS"] is None and rows[2]["LFMC"] == 1.0
    assert rows[4]["Theta"] == 7.0 and rows[5]["Theta"] == 7.0


def test_sentinel_row_with_nan_dds_stays_blank(spark):
    assert all(cleaned(spark, [(1, -40.0, NAN, NAN)])[1][v] is None for v in INDICATORS)


def test_absent_indicators_are_ignored_and_other_columns_kept(spark):
    df = spark.createDataFrame([(1, -40.0, 3.0, "a")], "id int, Psi double, Theta double, note string")
    assert [tuple(r) for r in qc_clean(df).collect()] == [(1, None, None, "a")]


def test_quarantine_is_complete(spark):
    df = spark.createDataFrame([(1, None), (2, "failed")], "id int, error string")
    good, bad = quarantine_split(df)
    assert [r["id"] for r in good.collect()] == [1] and [r["id"] for r in bad.collect()] == [2]


def test_clamp_keeps_missing_missing(spark):
    df = spark.createDataFrame([(1, None), (2, NAN), (3, 2.0), (4, -1.0), (5, 0.5)], "i int, x double")
    got = dict(df.select("i", clamp01(F.col("x"))).collect())
    assert got == {1: None, 2: None, 3: 1.0, 4: 0.0, 5: 0.5}


def test_ratio_of_nothing_is_nan(spark):
    row = spark.range(1).select(
        ratio_or_nan(F.lit(None).cast("double"), F.lit(None).cast("double")).alias("a"),
        ratio_or_nan(F.lit(0.0), F.lit(0.0)).alias("b"), ratio_or_nan(F.lit(3.0), F.lit(2.0)).alias("c"),
    ).first()
    assert math.isnan(row["a"]) and math.isnan(row["b"]) and row["c"] == 1.5


def test_mean_skips_null_and_nan_and_is_null_for_nothing(spark):
    df = spark.createDataFrame([(1, 1.0), (1, NAN), (1, None), (1, 3.0), (2, NAN), (2, None)], "k int, x double")
    assert dict(df.groupBy("k").agg(mean_skip_missing(F.col("x"))).collect()) == {1: 2.0, 2: None}


def test_sum_is_null_with_one_missing_value(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 2.0), (2, 1.0), (2, None), (3, 1.0), (3, NAN)], "k int, x double")
    assert dict(df.groupBy("k").agg(sum_unless_missing(F.col("x"))).collect()) == {1: 3.0, 2: None, 3: None}


def test_not_listed_keeps_null(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,)], "x string")
    assert {r["x"] for r in df.where(not_listed(F.col("x"), ["a"])).collect()} == {"b", None}
