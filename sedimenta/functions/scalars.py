"""Scalar column functions; every one is a composition of built-in expressions."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_timestamp(as_of: Column | datetime | str | None) -> Column:
    """Load instant as a column; ``None`` means the query's start time."""
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(as_of).cast("timestamp")


def as_date(ref: Column | datetime | str | None) -> Column:
    """Reference day as a column; ``None`` means today."""
    if ref is None:
        return F.current_date()
    if isinstance(ref, Column):
        return ref
    return F.lit(ref).cast("date")


def _col(value) -> Column:
    return value if isinstance(value, Column) else F.col(value)


def safe_divide(numerator, denominator) -> Column:
    """``numerator / denominator``, 0.0 where the denominator is 0."""
    num, den = _col(numerator).cast("double"), _col(denominator).cast("double")
    return F.when(den != 0, num / den).when(den == 0, F.lit(0.0))


def success_rate(successful, total) -> Column:
    """Share of successes in percent, 0.0 for an empty total."""
    return safe_divide(successful, total) * 100


def _tenths(value: Column, bits: int) -> Column:
    """``value`` rounded to tenths, half to even on its exact binary value.

    Scaling by a power of two is exact, so the rest is integer arithmetic. The
    formatter behind ``format_string`` rounds the shortest decimal form instead
    (6.55 -> 6.6, although the double lies below 6.55).
    """
    scaled = (value * float(2**bits)).cast("long") * 10
    whole = F.shiftright(scaled, bits)
    rest = scaled - F.shiftleft(whole, bits)
    half = F.lit(2 ** (bits - 1)).cast("long")
    up = (rest > half) | ((rest == half) & (whole % 2 == 1))
    return whole + up.cast("long")


def one_decimal(value) -> Column:
    """Text of a number >= 1 with one decimal, exact for doubles."""
    v = _col(value).cast("double")
    # The larger a double is, the fewer bits of fraction it has; from 2**56 on it has none.
    tenths = F.lit(None).cast("long")
    for power in range(56, 0, -7):
        tenths = F.when(v < 2**power, _tenths(v, 59 - power)).otherwise(tenths)
    text = F.concat(
        F.call_function("div", tenths, F.lit(10)).cast("string"),
        F.lit("."),
        (tenths % 10).cast("string"),
    )
    return F.when(v < 2**56, text).otherwise(F.format_string("%.1f", v))


def format_duration(seconds) -> Column:
    """Seconds as ``500ms``, ``1.5s``, ``1.5m`` or ``1.0h``."""
    s = _col(seconds).cast("double")
    return (
        F.when(s < 1, F.concat(F.rint(s * 1000).cast("long").cast("string"), F.lit("ms")))
        .when(s < 60, F.concat(one_decimal(s), F.lit("s")))
        .when(s < 3600, F.concat(one_decimal(s / 60), F.lit("m")))
        .when(s.isNotNull(), F.concat(one_decimal(s / 3600), F.lit("h")))
    )


def base_name(path) -> Column:
    """Last segment of a path."""
    return F.element_at(F.split(_col(path), "/"), -1)


def file_stem(path) -> Column:
    """Last path segment without its final extension; dot files keep their name."""
    return F.regexp_replace(base_name(path), r"(?<=.)\.[^.]+$", "")


def file_extension(path) -> Column:
    """Final extension with its dot, or an empty string."""
    return F.regexp_extract(base_name(path), r"(?<=.)(\.[^.]+)$", 1)


def parent_path(path) -> Column:
    """Everything before the last segment."""
    return F.regexp_replace(_col(path), r"/[^/]*$", "")


def batch_id(path, timestamp=None) -> Column:
    """File stem and load second: ``orders_20240115_103045``."""
    ts = as_timestamp(timestamp)
    return F.concat_ws("_", file_stem(path), F.date_format(ts, "yyyyMMdd_HHmmss"))


def table_from_path(path, pattern: str | None = None) -> Column:
    """Table name from a path: group 1 of ``pattern`` (NULL if it does not match),
    or the parent directory's name."""
    p = _col(path)
    if pattern is not None:
        return F.when(p.rlike(pattern), F.regexp_extract(p, pattern, 1))
    parts = F.split(p, "/")
    return F.when(F.size(parts) > 1, F.element_at(parts, -2)).when(p.isNotNull(), F.lit(""))
