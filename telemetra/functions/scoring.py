"""Scalar scoring and classification (S1-S17, R1) as Column expressions.

All thresholds below are fixed values of the source application.
"""

from __future__ import annotations

from typing import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from telemetra.profile import ENDPOINT_ADVISORY, RECOMMENDATIONS

__all__ = [
    "temp_health", "vibration_health", "efficiency_health", "stability_health",
    "health_score", "risk_level", "baseline_z", "baseline_health", "baseline_anomaly",
    "anomaly_label", "failure_probability", "recommendation", "failure_risk",
    "rule_severity", "contributor_share", "cross_sensor_columns", "health_columns",
]


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def temp_health(x) -> Column:
    """<520 -> 100; <560 -> 100-(x-520)*1.25; <590 -> 50-(x-560); else 10."""
    x = _c(x)
    return F.round(F.when(x < 520, 100.0).when(x < 560, 100 - (x - 520) * 1.25)
                   .when(x < 590, 50 - (x - 560) * 1.0).otherwise(10.0), 1)


def vibration_health(x) -> Column:
    """S3: <2.5 -> 100; <4 -> 100-(x-2.5)*20; <7 -> 70-(x-4)*15; else 10."""
    x = _c(x)
    return F.round(F.when(x < 2.5, 100.0).when(x < 4.0, 100 - (x - 2.5) * 20)
                   .when(x < 7.0, 70 - (x - 4.0) * 15).otherwise(10.0), 1)


def efficiency_health(x) -> Column:
    """>95 -> 100; >85 -> 100-(95-x)*5; >70 -> 50-(85-x)*2; else 10 (null -> 10)."""
    x = _c(x)
    return F.round(F.when(x > 95, 100.0).when(x > 85, 100 - (95 - x) * 5)
                   .when(x > 70, 50 - (85 - x) * 2).otherwise(10.0), 1)


def stability_health(avg_anomaly_score) -> Column:
    """100 - 15 * average anomaly score, floored at 0."""
    v = F.round((100 - _c(avg_anomaly_score) * 15).cast("double"), 1)
    return F.when(v < 0, 0.0).otherwise(v)


def health_score(parts: Sequence, weights: Sequence[float] = (0.25, 0.25, 0.25, 0.25)) -> Column:
    """Weighted sum of the health parts, rounded to 1 decimal."""
    total = None
    for p, w in zip(parts, weights):
        term = _c(p) * w
        total = term if total is None else total + term
    return F.round(total, 1)


def risk_level(score) -> Column:
    """>=80 LOW, >=60 MEDIUM, >=40 HIGH, else (and null) CRITICAL."""
    s = _c(score)
    return (F.when(s >= 80, "LOW").when(s >= 60, "MEDIUM").when(s >= 40, "HIGH")
            .otherwise("CRITICAL"))


def health_columns(temp, vibration, efficiency, anomaly) -> dict[str, Column]:
    """S2-S7 as a column dict (temp/vibration/efficiency/anomaly are inputs)."""
    t, v, e, s = (temp_health(temp), vibration_health(vibration),
                  efficiency_health(efficiency), stability_health(anomaly))
    score = health_score([t, v, e, s])
    return {"temp_health": t, "vibration_health": v, "efficiency_health": e,
            "stability_health": s, "health_score": score, "risk_level": risk_level(score)}


def baseline_z(col, mean: float, std: float) -> Column:
    return F.abs((_c(col) - F.lit(mean)) / F.lit(std))


def baseline_health(baselines: Mapping[str, tuple[float, float]], fault=None) -> Column:
    """100 minus penalties (z>3: 25, >2: 10, >1.5: 3 per sensor; fault: 30), clip 0..100.

    A missing reading gives no penalty (as NaN comparisons are false).
    """
    pen = F.lit(0.0)
    for s, (m, sd) in baselines.items():
        z = baseline_z(s, m, sd)
        pen = pen + F.when(z > 3, 25).when(z > 2, 10).when(z > 1.5, 3).otherwise(0)
    if fault is not None:
        pen = pen + F.when(_c(fault) == 1, 30).otherwise(0)
    return F.least(F.greatest(100 - pen, F.lit(0.0)), F.lit(100.0))


def baseline_anomaly(baselines: Mapping[str, tuple[float, float]]) -> Column:
    """Mean absolute baseline z / 5, clipped to 0..1 (null if any is null)."""
    zs = [baseline_z(s, m, sd) for s, (m, sd) in baselines.items()]
    total = zs[0]
    for z in zs[1:]:
        total = total + z
    avg = total / max(len(zs), 1)
    # greatest/least skip nulls; a missing reading must stay missing
    return F.when(avg.isNotNull(), F.least(F.greatest(avg / 5.0, F.lit(0.0)), F.lit(1.0)))


def anomaly_label(score) -> Column:
    """>0.7 CRITICAL, >0.4 WARNING, >0.2 ELEVATED, else NORMAL."""
    s = _c(score)
    return (F.when(s > 0.7, "CRITICAL").when(s > 0.4, "WARNING").when(s > 0.2, "ELEVATED")
            .otherwise("NORMAL"))


def failure_probability(degradation) -> Column:
    """min(1, exp(3 d - 2)); null for a missing index."""
    p = F.exp(_c(degradation) * 3 - 2)
    return F.when(p.isNotNull(), F.least(F.lit(1.0), p))


def recommendation(rul_days, prob=None, mode: str = "model") -> Column:
    """Maintenance advice by days (<=3/7/14/30) or probability (>0.8/0.6/0.4/0.2).

    mode ``model`` uses both, ``endpoint`` days only (with its shorter text).
    """
    d = _c(rul_days)
    texts = list(RECOMMENDATIONS)
    if mode == "endpoint":
        texts[3] = ENDPOINT_ADVISORY
        p = F.lit(0.0)
    else:
        p = _c(prob) if prob is not None else F.lit(0.0)
    return (F.when((d <= 3) | (p > 0.8), texts[0]).when((d <= 7) | (p > 0.6), texts[1])
            .when((d <= 14) | (p > 0.4), texts[2]).when((d <= 30) | (p > 0.2), texts[3])
            .otherwise(texts[4]))


def failure_risk(prob, rul_days) -> Column:
    """p>0.8 or days<3 CRITICAL; >0.6/<7 HIGH; >0.3/<30 MEDIUM; else LOW."""
    p, d = _c(prob), _c(rul_days)
    return (F.when((p > 0.8) | (d < 3), "CRITICAL").when((p > 0.6) | (d < 7), "HIGH")
            .when((p > 0.3) | (d < 30), "MEDIUM").otherwise("LOW"))


def rule_severity(rule_type, value, warning, critical) -> Column:
    """Severity of one value under one rule, null when not violated."""
    t, v, w, c = _c(rule_type), _c(value), _c(warning), _c(critical)
    high = t.isin("threshold_high", "anomaly_score", "failure_probability")
    low = t == "threshold_low"
    rate = t == "rate_of_change"
    return (F.when(high & (v >= c), "CRITICAL").when(high & (v >= w), "WARNING")
            .when(low & (v <= c), "CRITICAL").when(low & (v <= w), "WARNING")
            .when(rate & (F.abs(v) >= c), "CRITICAL").when(rate & (F.abs(v) >= w), "HIGH"))


def contributor_share(rank_zero_based) -> Column:
    """Share by rank i: max(0.05, 1/(i+1))."""
    return F.greatest(F.lit(0.05), 1.0 / (_c(rank_zero_based) + 1))


def cross_sensor_columns(egt="exhaust_gas_temp_c", cdt="compressor_discharge_temp_c",
                         fuel="fuel_flow_kg_s", load="turbine_load_mw",
                         vibration="vibration_mm_s", rpm="rotor_speed_rpm",
                         discharge="discharge_pressure_bar", inlet="inlet_pressure_bar",
                         ambient="ambient_temp_c") -> dict[str, Column]:
    """Five cross-sensor features; a zero divisor gives null (try_divide)."""
    e, c, f, l, v, r, d, i, a = (_c(x) for x in (egt, cdt, fuel, load, vibration, rpm,
                                                 discharge, inlet, ambient))
    return {
        "temp_differential": e - c,
        "specific_fuel_consumption": F.try_divide(f, l + 0.001),
        "vibration_speed_ratio": F.try_divide(v, r / 1000 + 0.001),
        "compression_efficiency": F.try_divide(d, i * (F.try_divide(c, a) + 0.001)),
        "temp_load_ratio": F.try_divide(e, l + 0.001),
    }
