"""Formulas on humidity, temperature and vapor pressure."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Magnus coefficients, balance band (hPa) and direction labels.
MAGNUS_BASE = 6.112
MAGNUS_A = 17.67
MAGNUS_B = 243.5
BALANCE_BAND = 0.1
INWARD, OUTWARD, BALANCED = "向内", "向外", "平衡"


def vapor_pressure(temperature: Column, relative_humidity: Column) -> Column:
    """Actual vapor pressure in hPa from degrees Celsius and percent."""
    denominator = temperature + MAGNUS_B
    exponent = (MAGNUS_A * temperature) / F.when(denominator != 0, denominator)
    return (relative_humidity / 100.0) * (MAGNUS_BASE * F.exp(exponent))


def diffusion_direction(delta: Column) -> Column:
    """Three-way class of a vapor pressure difference (outside - inside)."""
    return (
        F.when(delta > BALANCE_BAND, INWARD)
        .when(delta < -BALANCE_BAND, OUTWARD)
        .when(F.abs(delta) <= BALANCE_BAND, BALANCED)
    )


def above(col: Column, threshold: float) -> Column:
    """Threshold flag; a missing reading is not above."""
    return F.coalesce(col > F.lit(float(threshold)), F.lit(False))
