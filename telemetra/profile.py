"""Sensor profiles: which columns are the asset, the clock and the sensors.

Two sensor families exist in the source application (a 10-sensor pipeline
profile and a 9-sensor service profile); the driver's test tables are mapped
through the same class, so operators never hard-code column names.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace
from typing import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class SensorProfile:
    """Column roles for one family of readings.

    asset      -- column identifying the machine (partition key of every window)
    ts         -- event-time column
    sensors    -- ordered sensor columns
    tiebreak   -- extra order columns that make (asset, ts, tiebreak) unique
    limits     -- inclusive physical bounds per sensor (out of range -> null)
    baselines  -- (mean, std) per sensor for baseline z-scores
    fault      -- SQL expression giving 1 for a faulty row, 0 otherwise
    chunk_seconds -- time-chunk width used to number rows per asset without
                     sending a whole asset to one task (a task's window holds
                     the rows of 1/1024 of a chunk)
    block_rows -- rows per block for windowed work (halo copies bridge blocks)
    """

    asset: str
    ts: str
    sensors: tuple[str, ...]
    tiebreak: tuple[str, ...] = ()
    limits: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    baselines: Mapping[str, tuple[float, float]] = field(default_factory=dict)
    fault: str | None = None
    chunk_seconds: int = 7 * 86400
    block_rows: int = 1 << 16

    @property
    def order_cols(self) -> list[str]:
        return [self.ts, *self.tiebreak]

    def order_exprs(self, descending: bool = False) -> list[Column]:
        cols = [F.col(c) for c in self.order_cols]
        return [c.desc() for c in cols] if descending else [c.asc() for c in cols]

    def fault_col(self) -> Column:
        if self.fault is None:
            return F.lit(0)
        return F.coalesce(F.expr(self.fault).cast("int"), F.lit(0))

    def with_(self, **changes) -> "SensorProfile":
        return replace(self, **changes)


# ---------------------------------------------------------------------------
# Fixed values that must equal the source application's (do not edit).
# ---------------------------------------------------------------------------

# Pipeline sensor columns, in their declared order.
PIPELINE_SENSORS = (
    "exhaust_gas_temp_c", "compressor_discharge_temp_c", "vibration_mm_s",
    "inlet_pressure_bar", "discharge_pressure_bar", "turbine_load_mw",
    "fuel_flow_kg_s", "rotor_speed_rpm", "lube_oil_temp_c", "ambient_temp_c",
)

# Pipeline physical limits (inclusive); a value outside becomes null.
PIPELINE_LIMITS = {
    "exhaust_gas_temp_c": (100, 700),
    "compressor_discharge_temp_c": (100, 500),
    "vibration_mm_s": (0, 25),
    "inlet_pressure_bar": (0.5, 2.0),
    "discharge_pressure_bar": (5, 25),
    "turbine_load_mw": (0, 15),
    "fuel_flow_kg_s": (0, 10),
    "rotor_speed_rpm": (3000, 12000),
    "lube_oil_temp_c": (10, 100),
    "ambient_temp_c": (-20, 60),
}

# Service sensor columns and their (mean, std) baselines, warn/crit limits.
SERVICE_SENSORS = (
    "temperature_c", "rpm", "torque_nm", "vibration_mm_s", "power_output_mw",
    "fuel_flow_kg_s", "air_pressure_kpa", "exhaust_gas_temp_c", "oil_temp_c",
)
SERVICE_BASELINES = {
    "temperature_c": (901, 49),
    "rpm": (15022, 490),
    "torque_nm": (3494, 204),
    "vibration_mm_s": (1.98, 0.49),
    "power_output_mw": (99.5, 10.3),
    "fuel_flow_kg_s": (2.51, 0.32),
    "air_pressure_kpa": (150, 19.4),
    "exhaust_gas_temp_c": (499, 28.8),
    "oil_temp_c": (120, 10.0),
}
# (warn, crit, direction) -- "high" alarms above, "low" alarms below.
SERVICE_LIMITS = {
    "temperature_c": (970, 1050, "high"),
    "rpm": (15800, 16200, "high"),
    "torque_nm": (3800, 4100, "high"),
    "vibration_mm_s": (2.8, 3.2, "high"),
    "power_output_mw": (80, 72, "low"),
    "fuel_flow_kg_s": (3.0, 3.3, "high"),
    "air_pressure_kpa": (185, 200, "high"),
    "exhaust_gas_temp_c": (540, 570, "high"),
    "oil_temp_c": (135, 145, "high"),
}
# Baselines of the model-endpoint fallback scorer (slightly different).
FALLBACK_BASELINES = {
    "temperature_c": (901.6, 49.4),
    "rpm": (15022, 490),
    "torque_nm": (3494, 204),
    "vibration_mm_s": (1.98, 0.49),
    "power_output_mw": (99.5, 10.3),
    "fuel_flow_kg_s": (2.51, 0.32),
    "air_pressure_kpa": (150.3, 19.4),
    "exhaust_gas_temp_c": (498.9, 28.8),
    "oil_temp_c": (120.1, 10.0),
}
# Service readings: valid ranges for row validation.
SERVICE_BOUNDS = {
    "temperature_c": (700, 1100),
    "rpm": (13000, 17000),
    "torque_nm": (2500, 4500),
    "vibration_mm_s": (0, 5),
    "power_output_mw": (60, 140),
    "fuel_flow_kg_s": (1.5, 4.0),
    "air_pressure_kpa": (90, 220),
    "exhaust_gas_temp_c": (400, 600),
    "oil_temp_c": (80, 160),
    "fault": (0, 1),
}
# CSV headers of the service dataset -> snake_case names.
SERVICE_CSV_RENAMES = {
    "Temperature (°C)": "temperature_c",
    "RPM": "rpm",
    "Torque (Nm)": "torque_nm",
    "Vibrations (mm/s)": "vibration_mm_s",
    "Power Output (MW)": "power_output_mw",
    "Fuel Flow Rate (kg/s)": "fuel_flow_kg_s",
    "Air Pressure (kPa)": "air_pressure_kpa",
    "Exhaust Gas Temperature (°C)": "exhaust_gas_temp_c",
    "Oil Temperature (°C)": "oil_temp_c",
    "Fault": "fault",
}
# Alarm codes: description and severity.
ALARM_CODES = {
    "ALM001": ("High Exhaust Gas Temperature", "CRITICAL"),
    "ALM002": ("High Vibration Level", "WARNING"),
    "ALM003": ("Low Lube Oil Pressure", "CRITICAL"),
    "ALM004": ("Compressor Surge Detected", "CRITICAL"),
    "ALM005": ("Fuel Flow Deviation", "WARNING"),
    "ALM006": ("Bearing Temperature High", "WARNING"),
    "ALM007": ("Rotor Overspeed Warning", "CRITICAL"),
    "ALM008": ("Flame Instability", "WARNING"),
    "ALM009": ("Discharge Pressure Low", "INFO"),
    "ALM010": ("Scheduled Maintenance Due", "INFO"),
}
# Alarms derived from readings: code -> (sensor, operator, threshold).
DERIVED_ALARMS = {
    "ALM001": ("exhaust_gas_temp_c", ">", 580.0),
    "ALM002": ("vibration_mm_s", ">", 5.0),
    "ALM005": ("fuel_flow_kg_s", ">", 4.0),
    "ALM006": ("lube_oil_temp_c", ">", 65.0),
    "ALM009": ("discharge_pressure_bar", "<", 14.0),
}
# Default alert rules: id, sensor, type, warning, critical, description.
DEFAULT_RULES = (
    ("EGT_HIGH", "exhaust_gas_temp_c", "threshold_high", 540.0, 560.0,
     "Exhaust Gas Temperature exceeds safe operating range"),
    ("VIB_HIGH", "vibration_mm_s", "threshold_high", 10.0, 15.0,
     "Vibration level above acceptable limit"),
    ("BEARING_TEMP", "bearing_temp_c", "threshold_high", 110.0, 120.0,
     "Bearing temperature elevated – possible lubrication issue"),
    ("LUBE_PRESS_LOW", "lube_oil_pressure_bar", "threshold_low", 2.0, 1.5,
     "Lube oil pressure dropping below minimum"),
    ("POWER_DEGRADE", "power_output_mw", "threshold_low", 11.0, 9.0,
     "Power output below expected baseline – possible degradation"),
    ("ANOMALY", "anomaly_score", "anomaly_score", 0.5, 0.7,
     "ML anomaly model detected unusual pattern"),
    ("FAILURE_PROB", "failure_probability", "failure_probability", 0.3, 0.6,
     "Predicted failure probability exceeds safe limit"),
)
DEFAULT_COOLDOWN_MINUTES = 15
# Notification colours per severity.
SEVERITY_COLOURS = {"INFO": "0078D4", "WARNING": "FFC107", "HIGH": "FF8C00",
                    "CRITICAL": "D13438"}
# Recommendation texts (model ladder).
RECOMMENDATIONS = (
    "IMMEDIATE: Schedule emergency maintenance within 24 hours",
    "URGENT: Plan maintenance within the next 3-5 days",
    "WARNING: Schedule maintenance within 2 weeks",
    "ADVISORY: Monitor closely, plan maintenance in next scheduled window",
    "NORMAL: Continue standard monitoring schedule",
)
# The endpoint variant shortens the fourth text.
ENDPOINT_ADVISORY = "ADVISORY: Monitor closely, plan maintenance in next window"
# Degradation-index weights for the RUL estimator.
DEGRADATION_WEIGHTS = {"vibration_mm_s": 0.4, "exhaust_gas_temp_c": 0.35,
                       "efficiency_pct": 0.25}


def pipeline_profile() -> SensorProfile:
    return SensorProfile(
        asset="turbine_id", ts="timestamp", sensors=PIPELINE_SENSORS,
        limits=PIPELINE_LIMITS, fault="fault_type != 'normal'",
        chunk_seconds=86400,
    )


def service_profile() -> SensorProfile:
    return SensorProfile(
        asset="turbine_id", ts="timestamp", sensors=SERVICE_SENSORS,
        limits={k: v for k, v in SERVICE_BOUNDS.items() if k != "fault"},
        baselines=SERVICE_BASELINES, fault="fault = 1", chunk_seconds=86400,
    )
