"""telemetra: condition-monitoring analytics for equipment telemetry on Spark.

Every public operator takes DataFrames (plus a :class:`SensorProfile` that names
the asset, time and sensor columns) and returns a DataFrame.  Nothing is
collected to the driver; ordered per-asset work runs through the skew-safe
sequence helpers in :mod:`telemetra.operators.sequence`.
"""

from telemetra.profile import SensorProfile

__all__ = ["SensorProfile"]
__version__ = "0.1.0"
