"""Run settings: years, anchors, indicators and flags of one method run.

Everything here is a small driver-side value; tables never pass through it.
"""

from __future__ import annotations

from dataclasses import dataclass, field

RUN_KEYS = ("scenario", "scheme")


@dataclass(frozen=True)
class HierConfig:
    """HIER and FACTOR methods (two-point interpolation, interior adjustment)."""
    reference_year: int = 2000
    base_year: int = 2016
    target_year: int = 2050
    years_to_fit: tuple = (2016, 2020, 2025, 2030, 2035, 2040, 2045, 2050)
    # "2016 values are 2017 for people": relabel of the base year on output
    relabel: tuple = ((2016, 2017),)
    indicators: tuple = ("hhpop", "hh", "emp")
    # a geography without a value stops the interior adjustment (else it is only a diagnostics row)
    stop_at_missing: bool = True
    round_interpolated: bool = False
    rounding: str = "largest_remainder"       # or "draw"
    seed: int = 0


@dataclass(frozen=True)
class TargetsConfig:
    """TARGETS method (anchored interpolation, adjustment after the first year)."""
    ref_base_year: int = 2018
    base_year: int = 2020
    target_year: int = 2050
    years_to_fit: tuple = (2018, 2020, 2025, 2030, 2035, 2040, 2044, 2050)
    annual_years: tuple = field(default_factory=lambda: tuple(range(2018, 2051)))
    indicators: tuple = ("hhpop", "hh", "emp", "pop")
    round_interpolated: bool = False
    rounding: str = "largest_remainder"
    seed: int = 0

    @property
    def anchors(self) -> tuple:
        return (self.ref_base_year, self.base_year, self.target_year)
