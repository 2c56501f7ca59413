import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from daymosaic.fixed_values import EXTRA_OUTPUTS, INDICATORS
from daymosaic.operators.flatten import (
    flatten_results, plant_weighted_means, soil_profile, water_balance_columns,
)
from daymosaic.schemas import RESULTS

NAN = float("nan")
DAY = dt.date(2025, 3, 7)


def layer(i, w=0.5, theta=0.25, psi=-1.0, wp=0.125, fc=0.5):
    return {"layer": i, "W": w, "theta": theta, "psi": psi, "waterWP": wp, "waterFC": fc}


def result(i, layers, cohorts, error=None, water=None):
    water = water or dict(Rain=4.0, Snow=1.0, PET=2.0, NetRain=3.0, SoilEvaporation=0.5,
                          Transpiration=0.25, Runoff=0.5, DeepDrainage=0.125)
    return (1, i, 0.0, 0.0, DAY, {
        "WaterBalance": water, "Stand": {"LAIexpanded": 2.0},
        "Plants": [dict(zip(("LAI", "DDS", "LFMC"), c)) for c in cohorts],
        "FireHazard": {"DFMC [%]": 9.0, "SFP": 1.0, "CFP": 2.0},
    }, {"soil": layers, "control": {"soilFunctions": "SX"}}, error)


def flat(spark, rows, clean=False):
    return {r["point_id"]: r for r in flatten_results(spark.createDataFrame(rows, RESULTS), clean).collect()}


def missing(x):
    return x is None or math.isnan(x)


def expected_soil(layers):
    """The rules, layer by layer."""
    if not layers or any(missing(l["W"]) or missing(l["waterFC"]) for l in layers):
        return None, None, None
    fc = sum(l["waterFC"] for l in layers)
    if fc == 0:
        return None, None, None

    def limited(x):
        return max(0.0, min(1.0, x))

    theta = None if any(missing(l["theta"]) for l in layers) else limited(
        sum(l["theta"] * l["waterFC"] for l in layers) / fc)
    rew = None
    if not any(missing(l["waterWP"]) for l in layers):
        span = sum(l["waterFC"] - l["waterWP"] for l in layers)
        if span != 0:
            rew = 100 * limited(sum(l["W"] * l["waterFC"] - l["waterWP"] for l in layers) / span)
    return theta, rew, min(layers, key=lambda l: l["layer"])["psi"]


def expected_plants(cohorts):
    def total(values):
        return sum(v for v in values if not missing(v))

    def times(a, b):
        return None if a is None or b is None else a * b

    lai = total(c[0] for c in cohorts)
    if lai == 0:
        return NAN, NAN
    return 100 * (total(times(c[0], c[1]) for c in cohorts) / lai), total(times(c[0], c[2]) for c in cohorts) / lai


def same(a, b):
    return (a is None and b is None) or (a is not None and b is not None and (a == b or (a != a and b != b)))


@pytest.fixture(scope="module")
def cases():
    rng = random.Random(7)
    pick = lambda *v: rng.choice(v)
    made = {}
    for i in range(300):
        layers = [
            layer(k, pick(0.5, 1.0, 0.25, 2.0, *([None, NAN] if i % 5 == 0 else [])),
                  pick(0.25, 0.5, 1.0, *([None, NAN] if i % 3 == 0 else [])), -pick(0.5, 1.0, 2.0),
                  pick(0.125, 0.25, *([None] if i % 7 == 0 else [])),
                  0.0 if i % 11 == 0 else pick(0.5, 0.25, 1.0, *([None] if i % 13 == 0 else [])))
            for k in rng.sample(range(1, 9), i % 5)
        ]
        cohorts = [
            (0.0 if i % 6 == 0 else pick(1.0, 2.0, 0.5, None, NAN), pick(0.5, 0.25, None, NAN), pick(80.0, 100.0, None))
            for _ in range(i % 4)
        ]
        made[i] = (layers, cohorts)
    return made


def test_nested_layers_and_cohorts_follow_the_rules(spark, cases):
    rows = flat(spark, [result(i, *c) for i, c in cases.items()])
    for i, (layers, cohorts) in cases.items():
        got = rows[i]
        for name, want in zip(("Theta", "REW", "Psi"), expected_soil(layers)):
            assert same(got[name], want), (i, name, got[name], want)
        for name, want in zip(("DDS", "LFMC"), expected_plants(cohorts)):
            assert same(got[name], want), (i, name, got[name], want)


def test_layers_as_rows_give_the_same(spark, cases):
    rows = [(i, *[l[k] for k in ("layer", "W", "theta", "psi", "waterWP", "waterFC")])
            for i, (layers, _) in cases.items() for l in layers]
    df = spark.createDataFrame(
        rows, "id int, layer int, W double, theta double, psi double, waterWP double, waterFC double")
    got = {r["id"]: r for r in soil_profile(df, ["id"], F.col("layer")).collect()}
    for i, (layers, _) in cases.items():
        if layers:
            for name, want in zip(("Theta", "REW", "Psi"), expected_soil(layers)):
                assert same(got[i][name], want), (i, name, got[i][name], want)


def test_cohorts_as_rows_give_the_same_and_keep_observations_without_any(spark, cases):
    rows = [(i, *c) for i, (_, cohorts) in cases.items() for c in cohorts]
    cohorts = spark.createDataFrame(rows, "id int, LAI double, DDS double, LFMC double")
    got = {r["id"]: r for r in plant_weighted_means(
        cohorts, ["id"], spark.createDataFrame([(i,) for i in cases], "id int")).collect()}
    assert len(got) == len(cases)
    for i, (_, c) in cases.items():
        assert same(got[i]["DDS"], expected_plants(c)[0]) and same(got[i]["LFMC"], expected_plants(c)[1])


def test_flat_shape_and_values(spark):
    rows = flat(spark, [result(1, [layer(1)], [(1.0, 0.5, 80.0)]), result(2, [layer(1)], [], error="failed")])
    assert set(rows) == {1}
    r = rows[1].asDict()
    assert list(r) == ["province", "point_id", "x", "y", "date", *INDICATORS, *EXTRA_OUTPUTS, "year", "month", "day"]
    assert (r["Precipitation"], r["Interception"], r["AET"], r["ELW"]) == (5.0, 1.0, 1.75, 0.625)
    assert (r["LAI"], r["DFMC"], r["SFP"], r["CFP"]) == (2.0, 9.0, 1.0, 2.0)
    assert (r["year"], r["month"], r["day"]) == (2025, 3, 7)


def test_point_without_cohorts_is_wiped_by_the_cleaning(spark):
    rows = flat(spark, [result(1, [layer(1)], []), result(2, [layer(1)], [(1.0, None, 80.0)])], clean=True)
    assert all(rows[1][v] is None for v in INDICATORS) and rows[1]["Runoff"] == 0.5
    assert rows[2]["DDS"] == 0.0 and rows[2]["LFMC"] == 80.0


def test_water_columns_are_missing_with_a_missing_operand(spark):
    water = dict(Rain=None, Snow=1.0, PET=2.0, NetRain=3.0, SoilEvaporation=0.5, Transpiration=0.25, Runoff=0.5,
                 DeepDrainage=0.125)
    r = flat(spark, [result(1, [layer(1)], [(1.0, 0.5, 80.0)], water=water)])[1]
    assert r["Precipitation"] is None and r["AET"] is None and r["ELW"] == 0.625
    df = spark.createDataFrame([tuple(water.values())], ", ".join(f"{k} double" for k in water))
    assert water_balance_columns(df).first()["Interception"] is None


def test_flattening_needs_no_shuffle_and_no_python(spark, plan, cases):
    text = plan(flatten_results(spark.createDataFrame([result(1, *cases[3])], RESULTS)))
    assert "Exchange" not in text and "Python" not in text
