"""RUL / forecast edge cases with hand-computed answers."""

import datetime as dt

import pytest

from telemetra.operators import trend as TR
from telemetra.profile import SensorProfile

T0 = dt.datetime(2025, 1, 1)
P = SensorProfile(asset="a", ts="ts", sensors=("d",))


def frame(spark, series):
    rows = [(k, T0 + dt.timedelta(minutes=5 * i), v) for k, vals in series.items()
            for i, v in enumerate(vals)]
    return spark.createDataFrame(rows, "a string, ts timestamp, d double")


def test_rul_cases(spark):
    df = frame(spark, {"one": [0.2], "nulls": [None, None, 0.3], "rise": [0.1 + 0.01 * i for i in range(20)],
                       "fall": [0.5 - 0.01 * i for i in range(20)], "past": [0.8 + 0.001 * i for i in range(5)],
                       "flat": [0.4] * 10})
    out = {r["a"]: r for r in TR.estimate_rul(df, P, value_col="d", window_days=1,
                                              interval_minutes=5).collect()}
    assert out["one"]["rul_days"] is None and out["one"]["failure_probability"] == 0.0
    assert out["nulls"]["rul_days"] is None and out["nulls"]["failure_probability"] == 0.3
    # rise: current 0.29, slope 0.01/sample -> 41 samples -> 41/288 days
    assert out["rise"]["rul_days"] == round(41 / 288, 1)
    assert out["rise"]["confidence"] == "HIGH"
    assert out["fall"]["rul_days"] == 365.0
    assert out["past"]["rul_days"] == 0.0
    assert out["flat"]["rul_days"] == 365.0 and out["flat"]["r_squared"] == 1.0


def test_linear_forecast_and_bands(spark):
    df = frame(spark, {"x": [float(i) for i in range(20)]})
    fc = TR.linear_forecast(df, P, ["d"], fit_rows=12, steps=3)
    vals = sorted((r["step"], r["value"]) for r in fc.collect())
    assert [round(v, 9) for _, v in vals] == [20.0, 21.0, 22.0]
    bands = TR.forecast_bands(fc.withColumn("as_of", __import__("pyspark.sql.functions",
                                                                fromlist=["lit"]).lit(T0)),
                              "as_of", horizon_minutes=10, step_minutes=5)
    rows = sorted((r["step"], r["lower_bound"], r["upper_bound"]) for r in bands.collect())
    assert len(rows) == 2 and rows[0][1] == pytest.approx(20 * 0.97)


def test_failure_prediction_minimum_rows(spark):
    df = spark.createDataFrame([("a", T0 + dt.timedelta(minutes=i), 2.0, 500.0, 0) for i in range(5)],
                               "a string, ts timestamp, v double, t double, f int")
    r = TR.failure_prediction(df, P, "v", "t", fault_col="f").first()
    assert r["sufficient_data"] is False and r["rul_days"] is None
