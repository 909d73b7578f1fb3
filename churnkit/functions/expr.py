"""Scalar expressions shared by the operators (all JVM-side, no UDF).

Rounding: rates, money and metrics are rounded from exact integers (counts, cents,
mills) with half-up integer arithmetic, so results do not depend on how an engine
rounds a binary double. Other doubles are rounded with ``round`` at the output.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def exact_quotient(m: Column, d: Column) -> Column:
    """m / d for an integer m that is a multiple of d, computed in DECIMAL (no float error)."""
    return (m.cast("decimal(38,0)") / d.cast("decimal(38,0)")).cast("bigint")


def ratio_half_up(num: Column, den: Column, places: int) -> Column:
    """round(num/den, places) half-up for integer num >= 0, den > 0, as DOUBLE; NULL if den = 0."""
    scale = 10 ** places
    # DECIMAL, not BIGINT: products of counts pass 2^63 at some ten million rows
    n = num.cast("decimal(38,0)") * F.lit(2 * scale) + den.cast("decimal(38,0)")
    d = (den.cast("decimal(38,0)") * F.lit(2)).cast("decimal(38,0)")
    n = n.cast("decimal(38,0)")
    q = exact_quotient(n - F.pmod(n, d), d)
    return F.when(den.cast("decimal(38,0)") == 0, F.lit(None).cast("double")) \
        .otherwise(q.cast("double") / scale)


def signed_ratio_half_up(num: Column, den: Column, places: int) -> Column:
    """Half-up (away from zero) rounding of num/den for signed integer num, den > 0."""
    mag = ratio_half_up(F.abs(num), den, places)
    return F.when(num < 0, -mag).otherwise(mag)


def mills_to_dollars(mills: Column) -> Column:
    """Amount in thousandths of a dollar -> dollars rounded half-up to cents, as DOUBLE."""
    return signed_ratio_half_up(mills, F.lit(1000), 2)


def cents(c: str | Column) -> Column:
    """A 2-decimal money amount as exact integer cents."""
    return F.round(col(c) * 100).cast("bigint")


def risk_tier(p: Column) -> Column:
    """Four tiers on the unrounded probability, strict thresholds; no tier without a probability."""
    return (F.when(p.isNull(), F.lit(None).cast("string")).when(p > 0.8, "Critical").when(p > 0.6, "High")
            .when(p > 0.4, "Moderate").otherwise("Low"))


def urgency_level(p: Column) -> Column:
    """Message urgency: critical / high / moderate (Low tier folds into moderate)."""
    return F.when(p > 0.8, "critical").when(p > 0.6, "high").otherwise("moderate")


def prediction(p: Column, threshold: float = 0.5) -> Column:
    return (p >= threshold).cast("int")


# Gauge bands of the risk score (percent), lower bound inclusive.
SCORE_BANDS = [(0, 40, "0-40"), (40, 60, "40-60"), (60, 80, "60-80"), (80, 100, "80-100")]


def score_band(p: Column) -> Column:
    pct = p * 100
    expr = None
    for lo, hi, label in SCORE_BANDS[:-1]:
        expr = F.when(pct < hi, label) if expr is None else expr.when(pct < hi, label)
    return expr.otherwise(SCORE_BANDS[-1][2])


def logistic(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))
