"""Row expressions. Everything here is a Catalyst expression; no Python runs per row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (low, high, index low, index high) of the national air-quality index.
PM25_BREAKPOINTS = [
    (0, 30, 0, 50),
    (30, 60, 51, 100),
    (60, 90, 101, 200),
    (90, 120, 201, 300),
    (120, 250, 301, 400),
    (250, 500, 401, 500),
]
PM10_BREAKPOINTS = [
    (0, 50, 0, 50),
    (50, 100, 51, 100),
    (100, 250, 101, 200),
    (250, 350, 201, 300),
    (350, 430, 301, 400),
    (430, 600, 401, 500),
]
INDEX_CEILING = 500.0
# Upper bound of each category; above the last one it is 'Severe'.
INDEX_CATEGORIES = [
    (50, "Good"),
    (100, "Satisfactory"),
    (200, "Moderate"),
    (300, "Poor"),
    (400, "Very Poor"),
]
# Feeds whose readings already are sub-indices.
SUBINDEX_SOURCES = ("cpcb", "waqi")
# Compass sectors from north, clockwise.
SECTORS = ("N", "NE", "E", "SE", "S", "SW", "W", "NW")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def missing_to_null(c: Column | str) -> Column:
    """A floating NaN means missing; keep one spelling of missing, NULL."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def payload_hash(payload: Column | str) -> Column:
    """SHA-256 of the whole text or binary payload."""
    return F.sha2(_col(payload).cast("binary"), 256)


def canonical_json(fields: Sequence[str]) -> Column:
    """JSON text with keys in name order, so equal records hash equally."""
    return F.to_json(F.struct(*[F.col(f) for f in sorted(fields)]))


def numeric(c: Column | str) -> Column:
    """Text to DOUBLE; what does not parse becomes NULL."""
    return missing_to_null(_col(c).try_cast("double"))


def parse_instant(c: Column | str) -> Column:
    """ISO text of any precision or offset to an instant; anything else becomes NULL.

    Each row is parsed on its own, so a table may mix spellings.
    """
    text = F.trim(_col(c).cast("string"))
    return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}"), text.try_cast("timestamp"))


def iso_normalise(c: Column | str) -> Column:
    """Naive UTC text to a full ISO spelling with an explicit zone."""
    text = F.replace(_col(c), F.lit(" "), F.lit("T"))
    padded = F.when(F.length(text) > 16, text).otherwise(F.concat(text, F.lit(":00")))
    return F.when(F.endswith(text, F.lit("+00:00")), text).otherwise(
        F.concat(padded, F.lit("+00:00"))
    )


def iso_utc_text(instant: Column | str) -> Column:
    """Instant to ``2024-01-01T00:00:00+00:00`` text, which no reader can re-zone."""
    return F.date_format(_col(instant), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def hour_bucket(instant: Column | str) -> Column:
    return F.date_format(F.date_trunc("hour", _col(instant)), "yyyy-MM-dd'T'HH':00:00+00:00'")


def utc_date(instant: Column | str) -> Column:
    return F.date_format(_col(instant), "yyyy-MM-dd")


def valid_time(cycle: Column | str, step: Column | str) -> Column:
    """Cycle label plus forecast hour; NULL when either does not parse."""
    label = F.regexp_replace(_col(cycle), "[zZ]", "")
    start = F.when(
        label.rlike(r"^\d{8}_\d{1,2}$"),
        F.try_to_timestamp(label, F.lit("yyyyMMdd_H")),
    )
    hours = _col(step).try_cast("int")
    return F.timestamp_seconds(F.unix_seconds(start) + hours.cast("bigint") * 3600)


def acquisition_time(day: Column | str, hhmm: Column | str, fallback: Column | str) -> Column:
    """Acquisition date and unpadded HHMM to ISO text, else ``fallback``."""
    day, hhmm = F.trim(_col(day).cast("string")), F.trim(_col(hhmm).cast("string"))
    padded = F.when(F.length(hhmm) <= 4, F.lpad(hhmm, 4, "0"))
    parsed = F.when(
        (F.length(day) == 10) & padded.rlike(r"^\d{4}$"),
        F.try_to_timestamp(F.concat(day, F.lit(" "), padded), F.lit("yyyy-MM-dd HHmm")),
    )
    return F.coalesce(iso_utc_text(parsed), _col(fallback))


def kelvin_to_celsius(c: Column | str, digits: int = 2) -> Column:
    return F.round(_col(c) - F.lit(273.15), digits)


def wind_speed(u: Column | str, v: Column | str) -> Column:
    u, v = _col(u), _col(v)
    return F.sqrt(u * u + v * v)


def circular_difference(a: Column | str, b: Column | str) -> Column:
    gap = F.abs(_col(a) - _col(b))
    return F.least(gap, F.lit(360.0) - gap)


def wind_sector(degrees: Column | str) -> Column:
    """Eight-point sector; north wraps, and what lies past either end counts as north."""
    d = _col(degrees)
    names = F.array(*[F.lit(s) for s in SECTORS])
    inner = F.element_at(names, (F.floor((d + 22.5) / 45.0) + 1).cast("int"))
    return (
        F.when(d.isNull() | F.isnan(d), "?")
        .when((d >= 337.5) | (d < 22.5), "N")
        .otherwise(inner)
    )


def sub_index(concentration: Column | str, breakpoints: Sequence[tuple]) -> Column:
    """Piecewise-linear index; at a shared end the lower segment wins."""
    c = _col(concentration)
    chain = F.when(c.isNull() | F.isnan(c) | (c < 0), F.lit(None).cast("double"))
    for low, high, index_low, index_high in breakpoints:
        slope = (index_high - index_low) / (high - low)
        chain = chain.when(
            c.between(float(low), float(high)),
            F.lit(slope) * (c - float(low)) + float(index_low),
        )
    return chain.otherwise(F.lit(INDEX_CEILING))


def is_subindex_source(source: Column | str) -> Column:
    """Missing in any spelling counts as the default feed, which holds sub-indices."""
    tag = F.lower(F.trim(F.coalesce(_col(source), F.lit(""))))
    return tag.isin(*SUBINDEX_SOURCES, "", "none", "nan")


def air_quality_index(pm25: Column | str, pm10: Column | str, source: Column | str) -> Column:
    """Overall index of a reading, on the scale its source reports."""
    return F.when(
        is_subindex_source(source), F.greatest(missing_to_null(pm25), missing_to_null(pm10))
    ).otherwise(F.greatest(sub_index(pm25, PM25_BREAKPOINTS), sub_index(pm10, PM10_BREAKPOINTS)))


def index_category(index: Column | str) -> Column:
    v = _col(index)
    chain = F.when(v.isNull() | F.isnan(v), "unknown")
    for upper, label in INDEX_CATEGORIES:
        chain = chain.when(v <= upper, label)
    return chain.otherwise("Severe")


def sign_magnitude(raw: Column | str, width: int) -> Column:
    """Big-endian sign-magnitude bytes: the top bit is the sign, the rest the size."""
    bits = F.conv(F.hex(_col(raw)), 16, 10).cast("bigint")
    top = 1 << (8 * width - 1)
    size = bits.bitwiseAND(F.lit(top - 1))
    return F.when(bits >= top, -size).otherwise(size)


def unpack_simple(
    packed: Column | str,
    reference: Column | str,
    binary_scale: Column | str,
    decimal_scale: Column | str,
) -> Column:
    """Physical value of one simple-packed integer."""
    scaled = _col(reference) + _col(packed) * F.pow(F.lit(2.0), _col(binary_scale))
    return scaled * F.pow(F.lit(10.0), -_col(decimal_scale))


def join_flags(flags: Sequence[tuple[str, Column]]) -> Column:
    """Names of the raised flags in the given order, comma separated, or ``ok``."""
    joined = F.concat_ws(",", *[F.when(raised, F.lit(name)) for name, raised in flags])
    return F.when(joined == "", F.lit("ok")).otherwise(joined)
