"""Scoring specification as data.

Everything in the FIXED VALUES block must equal the behaviour being
reproduced (weights, thresholds, band cut points, action texts, sentinel
codes).  They are stated once here and read by the operators.
"""
from __future__ import annotations

# ---------------------------------------------------------------------------
# FIXED VALUES (must match the reference's results)
# ---------------------------------------------------------------------------

# Alert score: event text tested first (case-insensitive substring, in order)
ALERT_EVENT_SCORES = [
    ("flash flood warning", 100),
    ("flood warning", 70),
    ("flood watch", 40),
]
# ... then the severity map; anything else (or missing) scores the default
ALERT_SEVERITY_SCORES = {
    "extreme": 100,
    "severe": 80,
    "moderate": 60,
    "minor": 40,
    "unknown": 25,
}
ALERT_DEFAULT_SCORE = 25

# Station hazard: exceedance ratio bounds and rise-rate bounds (ft/h)
EXCEED_BOUNDS = (0.0, 1.0)
RISE_BOUNDS = (0.0, 0.30)
MIN_DELTA_HOURS = 1e-6

# Distance model
EARTH_RADIUS_KM = 6371.0
LAMBDA_KM = 25.0          # exp(-d / lambda) decay scale (code; the spec says 15)
OVERRIDE_KM = 12.0        # local max radius (code; the spec says "inside area")

# Earthquake intensity
EQ_MIN_DIST_KM = 1e-3
EQ_DEPTH_SCALE_KM = 70.0
EQ_RECENCY_HOURS = 168.0
# spec piecewise depth factor: depth <= 30 -> 1.0, <= 70 -> 0.7, else 0.4
EQ_SPEC_DEPTH_STEPS = [(30.0, 1.0), (70.0, 0.7)]
EQ_SPEC_DEPTH_ELSE = 0.4

# Robust score quantiles
ROBUST_LO_Q = 0.05
ROBUST_HI_Q = 0.95

# Vulnerability and resilience composites (area features)
VULNERABILITY_WEIGHTS = {"poverty": 0.35, "transport": 0.25, "housing": 0.15, "income_inv": 0.25}
RESILIENCE_WEIGHTS = {"income": 0.45, "transport_inv": 0.30, "housing_inv": 0.25}

# Census baseline risk index weights (min-max scores, missing -> 0)
CENSUS_RISK_WEIGHTS = {
    "score_population": 0.30,
    "score_poverty": 0.25,
    "score_income_vulnerability": 0.20,
    "score_transport_vulnerability": 0.15,
    "score_housing_vulnerability": 0.10,
}
# Town blend: municipio share, ZIP share
TOWN_BLEND = (0.6, 0.4)
# ACS "missing" sentinel codes
ACS_SENTINELS = [-666666666, -555555555, -333333333, -222222222, -111111111, -999999999]

# Operational indices
READINESS_WEIGHTS = {"hazard_inv": 0.45, "resilience": 0.35, "vulnerability_inv": 0.20}
RECOVERY_WEIGHTS = {"resilience": 0.50, "exposure_inv": 0.25, "vulnerability_inv": 0.25}
PHASE_WEIGHTS = {
    "PRE": {"risk": 0.45, "rr": 0.35, "rc": 0.20},
    "DURING": {"risk": 0.60, "rr": 0.30, "rc": 0.10},
    "POST": {"risk": 0.35, "rr": 0.20, "rc": 0.45},
}
DEFAULT_PHASE = "DURING"

# Confidence
FRESHNESS_HOURS = 168.0
CONFIDENCE_WEIGHTS = {"freshness": 0.35, "completeness": 0.25, "validity": 0.25, "crosscheck": 0.15}
CROSSCHECK_HIT = 85.0
CROSSCHECK_MISS = 60.0

# Bands (lower bound inclusive), checked top down; below the last -> Green
BANDS = [("Red", 85.0), ("Orange", 70.0), ("Yellow", 50.0)]
BAND_ELSE = "Green"
HARD_RED_ALERT = 95.0
HARD_RED_FLOOD = 90.0

# Recommended actions, in rule order
ACTION_RULES = [
    ("flood_hazard_muni", ">=", 80.0, "Pre-position swift-water rescue assets"),
    ("flood_hazard_muni", ">=", 80.0, "Issue targeted flood risk communications"),
    ("earthquake_hazard_score", ">=", 70.0, "Validate emergency inspection and shelter plans"),
    ("vulnerability_score", ">=", 70.0, "Prioritize outreach for transport-constrained households"),
    ("response_readiness_index", "<=", 40.0, "Increase responder and route readiness posture"),
    ("recovery_capacity_index", "<=", 40.0, "Pre-stage utility restoration support"),
]
ACTION_DEFAULT = "Maintain monitoring and readiness checks"
ACTION_SEPARATOR = " | "

# Spec-declared (not coded) weights
SPEC_STATION_WEIGHTS = {"exceedance": 0.60, "rise": 0.40}
SPEC_RISE_WINDOW_MINUTES = 60
SPEC_GAUGE_WEIGHTS = {"height": 0.5, "flow_change": 0.5}
SPEC_RISK_PHASE_WEIGHTS = {
    "PRE": {"hazard": 0.35, "exposure": 0.25, "vulnerability": 0.40},
    "DURING": {"hazard": 0.55, "exposure": 0.20, "vulnerability": 0.25},
}
SPEC_EXPOSURE_WEIGHTS = {"pop_in_zone_pct": 0.70, "critical_facilities_in_zone": 0.30}
SPEC_VULNERABILITY_WEIGHTS = {"svi_overall": 0.60, "access_constraints": 0.25, "housing_fragility": 0.15}
SPEC_ACCESS_WEIGHTS = {"no_vehicle_pct": 0.7, "single_route_fragility_pct": 0.3}
SPEC_ICS_WEIGHTS = {
    "hospitals": 0.20, "power": 0.20, "water": 0.15, "roads_bridges": 0.15,
    "telecom": 0.10, "ports": 0.08, "airports": 0.07, "emergency_facilities": 0.05,
}
SPEC_READINESS_WEIGHTS = {
    "route_reliability": 0.35, "resource_proximity": 0.35, "comms_reach": 0.20, "eoc_staffing_flag": 0.10,
}
SPEC_RECOVERY_WEIGHTS = {
    "utility_restoration_velocity": 0.45, "healthcare_access_restoration": 0.25,
    "school_reopening_pct": 0.20, "housing_habitability_proxy": 0.10,
}
SPEC_PHASE_EVENTS = {"PRE": ["Flood Watch"], "DURING": ["Flood Warning", "Flash Flood Warning"]}
SPEC_POST_ALERT_HOURS = 24.0
SPEC_CONFIDENCE_WEIGHTS = {"freshness": 0.35, "completeness": 0.25, "validity": 0.25, "crosscheck": 0.15}
SPEC_BASELINE_WINDOW_DAYS = 365
SPEC_DROPOUT_LEVELS = [0.2, 0.3, 0.4]
SPEC_SENSITIVITY_DELTAS = [-0.2, -0.1, 0.1, 0.2]

# Zone fallback ids and names
ZONE_FALLBACK_PREFIX = "PRZ"
ZONE_FALLBACK_NAME = "Puerto Rico Zone"
ZONE_FALLBACK_COUNT = 13

# Default cadence and lookbacks
LOOKBACK_HOURS = 72

# ---------------------------------------------------------------------------


# FIXED VALUES: datum and units of the water-level feed.
DATUM = "MLLW"
UNITS = "metric"
