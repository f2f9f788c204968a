"""Parameters of the screen, the zero check and the repair step."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class Params:
    """Defaults are fixed values of the task definition."""

    seasonality_threshold: float = 0.64
    trend_threshold: float = 0.75
    shifting_threshold: float = 0.24
    transition_threshold: float = 0.09
    long_term_jsd_threshold: float = 0.3
    enable_zero_check: bool = True
    zero_check_len: int = 100
    zero_ratio_threshold: float = 0.9
    zero_streak_threshold: int = 50
    near_zero_threshold: float = 0.005
    zero_std_threshold: float = 1.0
    short_window: int = 30
    long_window: int = 336
    repair_threshold: float = 7.0
    repair_window: int = 3
    repair_low_ratio: float = 0.2
    repair_positive_median_only: bool = False
    compat: bool = False  # tie and padding rules of period ranking, see TOP3
