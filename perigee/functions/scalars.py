"""Scalar column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from perigee import schema as S


def parse_iso(iso: Column) -> Column:
    """ISO-8601 text to timestamp; raises on bad text when ANSI mode is on."""
    return iso.cast("timestamp")


def try_parse_iso(iso: Column) -> Column:
    """ISO-8601 text to timestamp; null on bad text."""
    return iso.try_cast("timestamp")


def epoch_seconds(t: Column) -> Column:
    """Seconds since the epoch as double, microseconds kept."""
    return F.unix_micros(t) / F.lit(1e6)


def seconds_between(later: Column, earlier: Column) -> Column:
    """Signed difference in seconds as double."""
    return (F.unix_micros(later) - F.unix_micros(earlier)) / F.lit(1e6)


def seconds_into_orbit(t: Column) -> Column:
    """Whole seconds since the epoch, ties rounded to even, modulo one nominal orbit."""
    return F.rint(epoch_seconds(t)).cast("bigint") % F.lit(S.ORBIT_SECONDS).cast("bigint")


def norm(*components: Column) -> Column:
    """Euclidean length of a vector stored as scalar columns."""
    total = components[0] * components[0]
    for c in components[1:]:
        total = total + c * c
    return F.sqrt(total)


def kelvin_to_celsius(k: Column) -> Column:
    return k - F.lit(S.KELVIN_OFFSET)


def soc_to_watt_hours(soc: Column) -> Column:
    return soc * F.lit(S.BATTERY_CAPACITY_WH)


def ground_quadrant(lat: Column, lon: Column) -> Column:
    """Quadrant of the sub-satellite point; a null coordinate falls through to 'SW'."""
    return (
        F.when((lat >= 0) & (lon >= 0), "NE")
        .when((lat >= 0) & (lon < 0), "NW")
        .when((lat < 0) & (lon >= 0), "SE")
        .otherwise("SW")
    )


def thermal_regime(net_heat_w: Column) -> Column:
    return (
        F.when(net_heat_w > 1, "warming").when(net_heat_w < -1, "cooling").otherwise("steady")
    )


def battery_band(soc: Column) -> Column:
    return F.when(soc < 0.25, "critical").when(soc < 0.50, "degraded").otherwise("nominal")


def thermal_band(temp_c: Column) -> Column:
    return (
        F.when((temp_c < -20) | (temp_c > 50), "critical")
        .when((temp_c < -10) | (temp_c > 40), "degraded")
        .otherwise("nominal")
    )


# Fixed value: the relative-start grammar, "+HH:MM:SS" or "+DDD-HH:MM:SS".
OFFSET_PATTERN = r"^\+(?:(\d+)-)?(\d+):(\d+):(\d+)$"


def offset_seconds(text: Column) -> Column:
    """Seconds in a relative-start string; null when the text does not follow the grammar."""

    def part(i: int) -> Column:
        digits = F.regexp_extract(text, OFFSET_PATTERN, i)
        return F.when(digits == "", F.lit("0")).otherwise(digits).cast("bigint")

    total = part(1) * 86400 + part(2) * 3600 + part(3) * 60 + part(4)
    return F.when(text.rlike(OFFSET_PATTERN), total)


def shift_seconds(t: Column, seconds: Column) -> Column:
    """Timestamp moved by a whole number of seconds."""
    return F.timestamp_micros(F.unix_micros(t) + seconds * F.lit(1_000_000).cast("bigint"))


def param(params: Column, name: str, default: float) -> Column:
    """Named fault parameter, or its default when the map lacks it."""
    return F.coalesce(F.try_element_at(params, F.lit(name)), F.lit(default).cast("double"))


def detector_for_fault(fault_type: Column) -> Column:
    """Name of the detector that watches for a fault type; null for an unknown type."""
    pairs = [F.lit(x) for kv in S.DETECTOR_FOR_FAULT.items() for x in kv]
    return F.try_element_at(F.create_map(*pairs), fault_type)


def hour_text(t: Column) -> Column:
    """Zero-padded hour of day, as used in partition directory names."""
    return F.date_format(t, "HH")


def as_naive(t: Column) -> Column:
    """UTC timestamp without zone, the type published at table edges."""
    return t.cast(T.TimestampNTZType())
