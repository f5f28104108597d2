"""Property test: O(n) sliding aggregates equal brute force on random series."""

import datetime as dt

import numpy as np
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from telemetra.operators import features as FT
from telemetra.profile import SensorProfile

T0 = dt.datetime(2025, 1, 1)
P = SensorProfile(asset="a", ts="ts", sensors=("x",), tiebreak=("k",), chunk_seconds=600,
                  block_rows=9)


def brute(vals, w):
    out = []
    for i in range(len(vals)):
        win = [v for v in vals[max(0, i - w): i + 1] if v is not None]
        if not win:
            out.append((None, None, None, None))
            continue
        arr = np.array(win)
        std = float(np.std(arr, ddof=1)) if len(arr) > 1 else None
        out.append((float(arr.mean()), std, float(arr.min()), float(arr.max())))
    return out


series = st.lists(st.one_of(st.none(), st.sampled_from([5.0, 5.0, 7.5]),
                            st.floats(-1e3, 1e3, allow_nan=False)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(vals=series, w=st.integers(1, 12))
def test_sliding_equals_brute_force(spark, vals, w):
    rows = [("A", T0 + dt.timedelta(minutes=i), i, v) for i, v in enumerate(vals)]
    df = spark.createDataFrame(rows, "a string, ts timestamp, k long, x double")
    got = {r["k"]: r for r in FT.rolling_stats(df, P, ["x"], windows=(w,), strategy="chunked",
                                              block_rows=max(9, w)).collect()}
    for i, want in enumerate(brute(vals, w)):
        r = got[i]
        have = (r[f"x_rolling_mean_{w}"], r[f"x_rolling_std_{w}"], r[f"x_rolling_min_{w}"],
                r[f"x_rolling_max_{w}"])
        for a, b in zip(have, want):
            if b is None:
                assert a is None
            else:
                assert abs(a - b) <= 1e-7 * max(1.0, abs(b)), (i, have, want)
