"""Threshold edges of the scalar scoring rules (hand-computed answers)."""

import pytest
from pyspark.sql import functions as F

from telemetra.functions import scoring as SC


def one(spark, expr, value):
    df = spark.createDataFrame([(value,)], "v double")
    return df.select(expr(F.col("v")).alias("o")).first()["o"]


@pytest.mark.parametrize("x,want", [(519.9, 100.0), (520.0, 100.0), (559.9, 50.1), (560.0, 50.0),
                                    (589.0, 21.0), (590.0, 10.0), (None, 10.0)])
def test_temp_health(spark, x, want):
    assert one(spark, SC.temp_health, x) == want


@pytest.mark.parametrize("x,want", [(2.4, 100.0), (2.5, 100.0), (3.9, 72.0), (4.0, 70.0),
                                    (6.9, 26.5), (7.0, 10.0)])
def test_vibration_health(spark, x, want):
    assert one(spark, SC.vibration_health, x) == want


@pytest.mark.parametrize("x,want", [(95.1, 100.0), (95.0, 100.0), (85.1, 50.5), (85.0, 50.0), (84.9, 49.8),
                                    (70.0, 10.0), (None, 10.0)])
def test_efficiency_health(spark, x, want):
    assert one(spark, SC.efficiency_health, x) == want


@pytest.mark.parametrize("x,want", [(80.0, "LOW"), (79.9, "MEDIUM"), (60.0, "MEDIUM"),
                                    (40.0, "HIGH"), (39.9, "CRITICAL"), (None, "CRITICAL")])
def test_risk_level(spark, x, want):
    assert one(spark, SC.risk_level, x) == want


def test_stability_floor(spark):
    assert one(spark, SC.stability_health, 10.0) == 0.0
    assert one(spark, SC.stability_health, 2.0) == 70.0


def test_rule_severity_edges(spark):
    rows = [("threshold_high", 540.0, 540.0, 560.0, "WARNING"),
            ("threshold_high", 560.0, 540.0, 560.0, "CRITICAL"),
            ("threshold_high", 539.9, 540.0, 560.0, None),
            ("threshold_low", 2.0, 2.0, 1.5, "WARNING"),
            ("threshold_low", 1.5, 2.0, 1.5, "CRITICAL"),
            ("rate_of_change", -12.0, 10.0, 15.0, "HIGH"),
            ("rate_of_change", 15.0, 10.0, 15.0, "CRITICAL"),
            ("anomaly_score", 0.7, 0.5, 0.7, "CRITICAL")]
    df = spark.createDataFrame(rows, "t string, v double, w double, c double, want string")
    out = df.select(SC.rule_severity("t", "v", "w", "c").alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in out)


def test_recommendation_and_failure_risk(spark):
    rows = [(2.0, 0.1), (7.0, 0.1), (10.0, 0.5), (40.0, 0.1), (40.0, 0.9)]
    df = spark.createDataFrame(rows, "d double, p double")
    out = df.select(SC.recommendation("d", "p").alias("r"), SC.failure_risk("p", "d").alias("k"),
                    SC.recommendation("d", mode="endpoint").alias("e")).collect()
    assert [r["r"][:6] for r in out] == ["IMMEDI", "URGENT", "WARNIN", "NORMAL", "IMMEDI"]
    assert [r["k"] for r in out] == ["CRITICAL", "MEDIUM", "MEDIUM", "LOW", "CRITICAL"]
    assert out[4]["e"].startswith("NORMAL")


def test_baseline_health_and_anomaly(spark):
    base = {"a": (0.0, 1.0), "b": (10.0, 2.0)}
    df = spark.createDataFrame([(3.5, 10.0, 1), (0.0, 10.0, 0), (None, 15.0, 0)],
                               "a double, b double, f int")
    out = df.select(SC.baseline_health(base, fault=F.col("f")).alias("h"),
                    SC.baseline_anomaly(base).alias("s")).collect()
    assert out[0]["h"] == 45.0          # z=3.5 -> 25, fault -> 30
    assert out[1]["h"] == 100.0
    assert out[2]["h"] == 90.0          # missing a: no penalty; b z=2.5 -> 10
    assert out[0]["s"] == pytest.approx(0.35)
    assert out[2]["s"] is None


def test_failure_probability(spark):
    assert one(spark, SC.failure_probability, 0.0) == pytest.approx(0.1353352832)
    assert one(spark, SC.failure_probability, 1.0) == 1.0
