"""Every tunable of the engine, as one immutable value."""

from __future__ import annotations

from dataclasses import dataclass, field

# State and mode codes of the telemetry.
IDLE, CHARGE, RUN, LATCH = 0, 1, 2, 3
ECO, THUNDER = 0, 1

# Signals and match features, by column name.
SIGNALS = ("rpm", "torque", "temp", "soc", "speed", "throttle", "current")
MATCH_FEATURES = ("mode_0_frac", "mode_1_frac", "mean_speed", "p90_speed", "median_torque", "p90_torque", "median_throttle", "p90_throttle", "low_speed_frac")
# Detector ids and labels of the results.
DETECTORS = {
    "d1_rpm_speed": "RPM high, Speed low (drivetrain slip)",
    "d2_throttle_speed": "Throttle high, Speed low (demand without motion)",
    "d3_throttle_current": "Throttle high, Current low (controller fault)",
    "d4_current_torque": "Current high, Torque low (motor inefficiency)",
    "d5_current_rpm_torque": "Current+RPM high, Torque low (freewheel / driveline)",
    "d6_torque_speed": "Torque high, Speed low (drag / brake-binding)",
    "d7_charge_overtaper": "SoC high, Charge current high (BMS not tapering)",
    "d8_temp_overheat": "Controller temp high, Current low (cooling fault)",
}
#: Detectors whose events mark a trip as elevated.
DANGER_DETECTORS = ("d3_throttle_current", "d4_current_torque", "d5_current_rpm_torque", "d8_temp_overheat")
VERDICTS = ("ELEVATED", "WATCH", "NORMAL")


@dataclass(frozen=True)
class Settings:
    """Thresholds (fixed values by default). Times are in units of ``unit_s`` seconds; durations in minutes of ``units_per_minute`` units. Sessions are numbered in slices of ``slice_gaps`` trip gaps, a choice that changes no result."""

    unit_s: float = 1.0
    units_per_minute: float = 60.0
    row_seconds: float = 5.0
    trip_gap: float = 900.0
    slice_gaps: int = 96
    max_sample_gap: float = 120.0
    min_minutes: float = 3.0
    min_km: float = 2.0
    max_km_per_soc: float = 2.5
    models: tuple[str, ...] | None = None
    k_max: int = 3
    contamination: float = 0.10
    seed: int = 42
    trees: int = 200
    restarts: int = 10
    min_cohort: int = 20
    min_feature_rows: int = 50
    min_drive_rows: int = 500
    min_charge_rows: int = 200
    min_session_rows: int = 4
    dwell: dict[str, int] = field(default_factory=lambda: {d: 3 if d[:2] in ("d1", "d5", "d6") else 4 for d in DETECTORS})
    peers: int = 20
    min_peers: int = 8
    z_flagged: float = 2.0
    z_unflagged: float = 2.5
    strong_with_flag: int = 2
    spirited_share: float = 0.60
    spirited_mean: float = 40.0
    spirited_p90: float = 55.0
    spirited_max_strong: int = 1
    minutes_bin: float = 5.0
    soc_bin: float = 2.0
    min_bucket: int = 5
    low_confidence: int = 10
    version: str = "v5-prod"


DEFAULT = Settings()
#: The same rules over day-spaced proxy telemetry (see sources.proxy).
PROXY = Settings(
    unit_s=86400.0,
    units_per_minute=1.0,
    trip_gap=45.0,
    slice_gaps=4,
    max_sample_gap=30.0,
    min_minutes=30.0,
    min_km=50.0,
    max_km_per_soc=30.0,
    dwell=dict.fromkeys(DETECTORS, 2),
    spirited_mean=26.0,
    spirited_p90=44.0,
    minutes_bin=30.0,
    soc_bin=10.0,
)
