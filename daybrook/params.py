"""Tunable thresholds. Every function takes a ``Params``; nothing reads the environment."""

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    # fixed values: feature definitions
    late_night_start_hour: int = 2
    late_night_end_hour: int = 4  # inclusive
    session_gap_seconds: int = 900
    min_user_events: int = 5
    rewatch_ratio: float = 1.0
    # fixed values: gate thresholds
    age_min: int = -1
    age_max: int = 200
    duplicate_share_warn: float = 0.30
    # fixed values: screening thresholds
    watch_quantile: float = 0.75
    hate_rate_min: float = 0.01
    late_night_min: float = 0.10
    heavy_late_night: float = 0.50


DEFAULTS = Params()
