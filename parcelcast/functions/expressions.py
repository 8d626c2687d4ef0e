"""Scalar column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F

EARTH_RADIUS_KM = 6371.0088


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def as_double(value: Column | str) -> Column:
    return as_column(value).cast("double")


def ratio(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division; NULL where the denominator is zero."""
    return F.try_divide(as_double(numerator), as_double(denominator))


def safe_divide(numerator: Column | str, denominator: Column | str) -> Column:
    """``ratio`` that also turns infinite and NaN quotients into NULL."""
    quotient = ratio(numerator, denominator)
    return F.when(F.abs(quotient) < F.lit(float("inf")), quotient)


def pct(part: Column | str, whole: Column | str) -> Column:
    return ratio(part, whole) * F.lit(100.0)


def flag_count(condition: Column) -> Column:
    """Number of rows where ``condition`` holds; NULL counts as false."""
    return F.count(F.when(condition, F.lit(1)))


def seconds_between(later: Column | str, earlier: Column | str) -> Column:
    micros = F.unix_micros(as_column(later)) - F.unix_micros(as_column(earlier))
    return micros.cast("double") / F.lit(1e6)


def hours_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(later, earlier) / F.lit(3600.0)


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return seconds_between(later, earlier) / F.lit(86400.0)


def equal_flag(left: Column | str, right: Column | str) -> Column:
    """1 where both sides are present and equal, else 0."""
    return F.coalesce(as_column(left) == as_column(right), F.lit(False)).cast("int")


def haversine_km(lat1: Column | str, lng1: Column | str, lat2: Column | str, lng2: Column | str) -> Column:
    """Great-circle distance in kilometres."""
    phi1, phi2 = F.radians(as_double(lat1)), F.radians(as_double(lat2))
    half_dlat = (phi2 - phi1) / F.lit(2.0)
    half_dlng = (F.radians(as_double(lng2)) - F.radians(as_double(lng1))) / F.lit(2.0)
    chord = F.sin(half_dlat) * F.sin(half_dlat) + F.cos(phi1) * F.cos(phi2) * F.sin(half_dlng) * F.sin(half_dlng)
    return F.lit(2.0 * EARTH_RADIUS_KM) * F.asin(F.sqrt(chord))


def upper_closed_band(value: Column | str, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Label of the right-closed interval ``value`` falls into; NULL stays NULL."""
    if len(labels) != len(edges) + 1:
        raise ValueError("one more label than edges is needed")
    x = as_column(value)
    banded = F.when(x.isNull(), F.lit(None).cast("string"))
    for edge, label in zip(edges, labels):
        banded = banded.when(x <= F.lit(float(edge)), F.lit(label))
    return banded.otherwise(F.lit(labels[-1]))


def cycle(position: Column, period: int) -> tuple[Column, Column]:
    """Sine and cosine of a position on a cycle."""
    angle = F.lit(2.0) * F.pi() * position.cast("double") / F.lit(float(period))
    return F.sin(angle), F.cos(angle)


def month_of(ts: Column | str) -> Column:
    return F.date_format(as_column(ts), "yyyy-MM")


def present(value: Column | str) -> Column:
    """True where a number is neither NULL nor NaN."""
    x = as_double(value)
    return x.isNotNull() & ~F.isnan(x)


def nan_to_null(value: Column | str) -> Column:
    x = as_column(value)
    return F.when(~F.isnan(x), x)
