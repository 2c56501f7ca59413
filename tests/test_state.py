import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from daymosaic.operators import state as st

RUN = dt.date(2001, 8, 6)


def initial():
    return F.lit(-1).cast("long")


def expected(requests, history):
    out = {}
    for key, day in requests:
        oldest = min(day - dt.timedelta(1), RUN - dt.timedelta(387))
        fits = [(d, s) for k, d, s in history if k == key and oldest <= d <= day - dt.timedelta(1)]
        out[key, day] = max(fits) if fits else (None, -1)
    return out


@pytest.fixture(scope="module")
def data(spark):
    rng = random.Random(3)
    history = [(rng.randrange(20), RUN - dt.timedelta(rng.randrange(1, 420)), i) for i in range(400)]
    days = [RUN - dt.timedelta(n) for n in (1, 5, 100, 370, 385, 386, 387, 388, 400, 419)]
    requests = [(k, d) for k in range(22) for d in days]
    return (
        history, requests, days,
        spark.createDataFrame(history, "k long, state_date date, state long"),
        spark.createDataFrame(requests, "k long, date date"),
    )


def as_dict(df):
    return {(r["k"], r["date"]): (r["state_date"], r["state"]) for r in df.collect()}


def test_both_forms_match_the_rule(data):
    history, requests, days, h, r = data
    want = expected(requests, history)
    assert any(v[0] is None for v in want.values()) and any(v[0] for v in want.values())
    assert as_dict(st.state_asof(r, h, ["k"], days, RUN, initial(), order="state")) == want
    assert as_dict(st.state_asof_window(r, h, ["k"], RUN, initial(), order="state")) == want


def test_states_of_days_match_the_rule(spark, data):
    history, requests, days, h, _ = data
    points = spark.createDataFrame([(k, -1, "x") for k in range(22)], "k long, first long, name string")
    got = st.states_of_days(points, h, ["k"], days, RUN, "first", order="state")
    assert got.columns == ["k", "name", "date", "state_date", "state"] and as_dict(got) == expected(requests, history)


def test_order_of_input_does_not_matter(data):
    _, _, days, h, r = data
    first = as_dict(st.state_asof_window(r, h, ["k"], RUN, initial(), order="state"))
    assert as_dict(st.state_asof_window(r.repartition(7), h.orderBy(F.desc("state")), ["k"], RUN, initial(), order="state")) == first


def test_nested_state_is_carried_whole(spark):
    h = spark.createDataFrame([(1, dt.date(2001, 8, 1), (2.5, [1, 2]))], "k long, state_date date, state struct<a:double,b:array<int>>")
    r = spark.createDataFrame([(1, dt.date(2001, 8, 3)), (2, dt.date(2001, 8, 3))], "k long, date date")
    zero = F.lit(None).cast("struct<a:double,b:array<int>>")
    for df in (st.state_asof(r, h, ["k"], [dt.date(2001, 8, 3)], RUN, zero), st.state_asof_window(r, h, ["k"], RUN, zero)):
        got = {x["k"]: x["state"] for x in df.collect()}
        assert got[1]["b"] == [1, 2] and got[1]["a"] == 2.5 and got[2] is None


def test_many_rows_of_one_key_are_combined_before_the_shuffle(spark, plan, data):
    _, _, days, h, r = data
    text = plan(st.state_asof_window(r, h, ["k"], RUN, initial(), order="state"))
    below_window = text[text.index("Window"):]
    assert "partial_max_by" in below_window
    assert "partial_max_by" in plan(st.state_asof(r, h, ["k"], days, RUN, initial(), order="state"))


def test_both_forms_keep_request_columns_and_agree_on_ties(spark):
    days = [RUN - dt.timedelta(i) for i in (3, 200, 395)]
    history = spark.createDataFrame(
        [(k, d - dt.timedelta(1), k * 10 + j) for k in (1, 2) for d in days for j in range(4)], "k long, state_date date, state long")
    requests = spark.createDataFrame([(k, d, -k) for k in (1, 2, 3) for d in days], "k long, date date, init long")
    few = st.state_asof(requests, history, ["k"], days, RUN, F.col("init"))
    many = st.state_asof_window(requests, history, ["k"], RUN, F.col("init"), dates=days)
    loose = st.state_asof_window(requests, history, ["k"], RUN, F.col("init"))
    key = lambda df: sorted(map(str, df.collect()))
    assert few.columns == many.columns == ["k", "date", "init", "state_date", "state"]
    assert key(few) == key(many) == key(loose) and few.where("state = init").count() == 3


def test_history_is_pruned(spark, plan, tmp_path):
    spark.createDataFrame([(1, RUN, 1)], "k long, state_date date, state long").write.parquet(str(tmp_path / "h"))
    history = spark.read.parquet(str(tmp_path / "h"))
    days = [RUN - dt.timedelta(2)]
    requests = spark.createDataFrame([(1, days[0])], "k long, date date")
    for df in (st.state_asof(requests, history, ["k"], days, RUN, F.lit(0)),
               st.state_asof_window(requests, history, ["k"], RUN, F.lit(0), dates=days)):
        text = plan(df)
        assert "GreaterThanOrEqual(state_date" in text and "LessThan" in text


def bucket(days, capacity, start):
    s = start
    trace = []
    for d in sorted(days):
        s = min(capacity, max(0.0, s + days[d]))
        trace.append((d, s))
    return trace


def forcing(spark):
    rng = random.Random(5)
    rows = [(k, dt.date(1999, 1, 1) + dt.timedelta(rng.randrange(1500)), rng.randrange(80) / 8, rng.randrange(72) / 8)
            for k in range(6) for _ in range(200)]
    days = {}
    for k, d, gain, loss in rows:
        days.setdefault(k, {}).setdefault(d, 0.0)
        days[k][d] += gain - loss
    return days, spark.createDataFrame(rows, "k long, date date, gain double, loss double")


def test_fold_over_years_equals_stepping_day_by_day(spark):
    days, df = forcing(spark)
    for capacity, start in ((20.0, 5.0), (3.0, 3.0), (1000.0, 0.0)):
        got = {r["k"]: (r["n_days"], r["storage"]) for r in st.state_fold(
            df, ["k"], F.col("gain"), F.col("loss"), capacity, start).collect()}
        assert got == {k: (len(d), bucket(d, capacity, start)[-1][1]) for k, d in days.items()}


def test_course_over_years_equals_stepping_day_by_day(spark, plan):
    days, df = forcing(spark)
    for capacity, start in ((20.0, 5.0), (3.0, 3.0), (1000.0, 0.0)):
        course = st.state_trajectory(df, ["k"], F.col("gain"), F.col("loss"), capacity, start)
        rows = course.collect()
        for k, d in days.items():
            assert sorted((r["date"], r["storage"]) for r in rows if r["k"] == k) == bucket(d, capacity, start)
    text = plan(course)
    assert "Python" not in text and "Pandas" not in text and "Arrow" not in text and "partial_sum" in text


def test_missing_and_repeated_days_of_a_course(spark):
    day = lambda n: dt.date(2000, 12, 30) + dt.timedelta(n)
    rows = [(1, day(0), 4.0, None), (1, day(0), 1.0, 2.0), (1, day(3), None, None), (1, day(400), None, 9.0), (2, day(1), 99.0, 0.0), (None, day(0), 1.0, 0.0)]
    df = spark.createDataFrame(rows, "k long, date date, gain double, loss double")
    got = {(r["k"], r["date"]): r["storage"] for r in st.state_trajectory(df, ["k"], F.col("gain"), F.col("loss"), 10.0, 5.0).collect()}
    assert got == {(1, day(0)): 8.0, (1, day(3)): 8.0, (1, day(400)): 0.0, (2, day(1)): 10.0, (None, day(0)): 6.0}
    assert st.state_trajectory(df.limit(0), ["k"], F.col("gain"), F.col("loss"), 10.0, 5.0).count() == 0


def test_python_step_gives_the_whole_course(spark):
    days, df = forcing(spark)

    def step(s, row):
        s = min(20.0, max(0.0, s + row["g"]))
        return s, {"s": s}

    daily = df.groupBy("k", "date").agg(F.sum(F.col("gain") - F.col("loss")).alias("g"))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "50")   # keys span batches
    try:
        rows = st.fold_days_in_python(daily, ["k"], step, 5.0, "k long, date date, s double").collect()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k, d in days.items():
        assert sorted((r["date"], r["s"]) for r in rows if r["k"] == k) == bucket(d, 20.0, 5.0)
