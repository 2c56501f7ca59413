import datetime as dt

import pytest
from pyspark.sql import functions as F

from daymosaic.functions.text import (
    date_in_name, join_with_last, last_part, pad2, partition_digits, partition_uri, point_wkt, replace_first, state_path,
)
from daymosaic.operators import calendar
from daymosaic.operators.runlog import run_summary
from daymosaic.sources.readers import file_name_filter, files_of_date, union_by_name

RUN = dt.date(2001, 8, 6)


def one(spark, value, f):
    return spark.createDataFrame([(value,)], "x string").select(f(F.col("x"))).first()[0]


@pytest.mark.parametrize("text,want", [("3", "03"), ("12", "12"), ("2025", "2025"), ("", "00")])
def test_pad_never_truncates(spark, text, want):
    assert one(spark, text, pad2) == want


def test_partition_digits(spark):
    assert one(spark, "s3://bucket/year=2025/month=3/day=7/", partition_digits) == "20250307"
    assert one(spark, "/data/v=2/run=7/year=2025/month=11/day=17/part-0.parquet", partition_digits) == "20251117"
    assert one(spark, "/data/year=2025/month=3", partition_digits) is None


@pytest.mark.parametrize("text,want", [
    ("a_20250307_b", dt.date(2025, 3, 7)), ("a_b", None), ("a_99999999", None), ("x20010203y20040506", dt.date(2001, 2, 3)),
])
def test_date_in_name(spark, text, want):
    assert one(spark, text, date_in_name) == want


def test_partition_uri_is_unpadded(spark):
    df = spark.createDataFrame([(dt.date(2025, 3, 7),)], "d date")
    assert df.select(partition_uri("s3://a%b/", F.col("d"))).first()[0] == "s3://a%b/year=2025/month=3/day=7/"


@pytest.mark.parametrize("text,want", [("aXbXc", "a-bXc"), ("abc", "abc"), ("X", "-"), ("abX", "ab-")])
def test_replace_first_only(spark, text, want):
    assert one(spark, text, lambda c: replace_first(c, "X", "-")) == want


def test_replacement_is_plain_text(spark):
    assert one(spark, "a.b", lambda c: replace_first(c, ".", "$1\\")) == "a$1\\b"


def test_state_path_and_last_part(spark):
    got = one(spark, "data-raw/p_initialized.rds", lambda c: state_path(c, F.lit(dt.date(2025, 3, 6)), "out/$x"))
    assert got == "out/$x/p_20250306.rds"
    assert one(spark, got, last_part) == "p_20250306.rds"


@pytest.mark.parametrize("names,want", [([], ""), (["a"], "a"), (["a", "b"], "a and b"), (["a", "b", "c"], "a, b and c")])
def test_join_with_last(spark, names, want):
    df = spark.createDataFrame([(names,)], "n array<string>")
    assert df.select(join_with_last(F.col("n"))).first()[0] == want


def test_point_wkt(spark):
    assert spark.range(1).select(point_wkt(F.lit(1.5), F.lit(-2.0))).first()[0] == "POINT (1.5 -2.0)"


def test_window_has_381_days(spark):
    days = sorted(r["date"] for r in calendar.date_window(spark, RUN).collect())
    assert len(days) == 381 and days[0] == RUN - dt.timedelta(385) and days[-1] == RUN - dt.timedelta(5)


def test_pending_missing_and_retention(spark):
    window = calendar.date_window(spark, RUN)
    inside, outside = RUN - dt.timedelta(5), RUN - dt.timedelta(386)
    done = spark.createDataFrame([(inside,), (inside,), (outside,)], "date date")
    assert calendar.pending_dates(window, done).count() == 380
    points = spark.createDataFrame([(1,), (2,), (2,)], "province int")
    seen = spark.createDataFrame([(1, inside), (1, outside)], "province int, date date")
    lacking = calendar.missing_dates(points, seen, RUN)
    assert lacking.where("province = 1").count() == 380 and lacking.where("province = 2").count() == 381
    assert [r["date"] for r in calendar.window_retention(done, RUN).distinct().collect()] == [inside]


def test_hard_stop_on_a_missing_day(spark):
    window = spark.createDataFrame([(RUN,)], "date date")
    assert calendar.assert_dates_present(window, window).count() == 1
    other = spark.createDataFrame([(RUN - dt.timedelta(1),)], "date date")
    with pytest.raises(Exception, match="no data for"):
        calendar.assert_dates_present(window, other).collect()


def test_run_summary(spark):
    log = spark.createDataFrame([
        (1, "a", "errored"), (1, "a", "errored"), (1, "b", "errored"), (1, "c", "skipped"), (1, "d", "completed"),
        (2, "a", "completed"),
    ], "run_date int, target string, status string")
    rows = {r["run_date"]: r for r in run_summary(log).collect()}
    assert tuple(rows[1])[1:] == (1, 1, 3, "a and b", "lady_beetle")
    assert tuple(rows[2])[1:] == (0, 1, 0, "no errors", "bell")


def test_file_filters_and_union(spark):
    files = spark.createDataFrame([("p_35_x",), ("p_38_x",), ("p_3_20250307",)], "path string")
    assert [r[0] for r in file_name_filter(files).collect()] == ["p_3_20250307"]
    assert files_of_date(files, "20250307").count() == 1
    a = spark.createDataFrame([(1, 2)], "x int, y int")
    b = spark.createDataFrame([(3, 4)], "y int, z int")
    assert sorted(map(tuple, union_by_name(None, a, None, b).collect()), key=str) == [(1, 2, None), (None, 3, 4)]
