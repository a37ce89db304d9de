"""Scalar column functions (cleaning, casting, derived values).

All are built-in Spark expressions, so they stay inside whole-stage codegen.
They follow ANSI mode: malformed text becomes null through ``try_cast`` and a
zero divisor gives null through ``try_divide`` instead of raising.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values that must match the source data formats -----------------
# Characters removed from scraped price text before parsing ("£51.77",
# "Â£10.50" where the pound sign arrived mis-decoded).
PRICE_NOISE_CHARS = "£Â"
# Availability text carries the count as the first integer after "(",
# e.g. "In stock (22 available)".
AVAILABILITY_PATTERN = r"\((\d+)"
# Version stamp format of versioned writes: 20240131_235959.
VERSION_FORMAT = "yyyyMMdd_HHmmss"
# Whitespace removed by ``str.strip()``: Unicode White_Space plus the
# information separators \x1c-\x1f.
STRIP_PATTERN = r"^[\p{IsWhite_Space}\x1c-\x1f]+|[\p{IsWhite_Space}\x1c-\x1f]+$"
# ---------------------------------------------------------------------------

# Finite decimal text: optional sign, digits with an optional fraction (or a
# bare fraction), optional exponent.  Spark's cast is laxer (it accepts a
# trailing 'd'/'f', "nan" and "inf"), so every text parse is gated by this.
_FLOAT_TEXT = r"^[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_whitespace(c) -> Column:
    """Strip leading/trailing whitespace of any kind, as ``str.strip()`` does
    (``F.trim`` removes spaces only)."""
    return F.regexp_replace(_col(c), STRIP_PATTERN, "")


def finite(value: Column) -> Column:
    """NaN and infinities count as missing: null."""
    v = value.cast("double")
    return F.when(~F.isnan(v) & (F.abs(v) != F.lit(float("inf"))), value)


def parse_double(text) -> Column:
    """Finite decimal text (stripped) -> double; anything else, overflow included, is null."""
    t = strip_whitespace(_col(text).cast("string"))
    return finite(F.when(t.rlike(_FLOAT_TEXT), t.try_cast("double")))


def clean_price_strict(c) -> Column:
    """Price text or number -> double: drop '£'/'Â', strip, parse; null when not a finite number."""
    return parse_double(F.translate(_col(c).cast("string"), PRICE_NOISE_CHARS, ""))


def clean_price_digits(c) -> Column:
    """Keep only digits and dots, then parse; '' or unparsable (e.g. '1.2.3') -> null.

    Signs and exponents are lost by design ('-5.00' -> 5.0).
    """
    digits = F.regexp_replace(_col(c).cast("string"), r"[^0-9.]", "")
    return F.nullif(digits, F.lit("")).try_cast("double")


def clean_availability(c, default: int | None = 0) -> Column:
    """First integer after '(' in availability text; ``default`` when absent or null."""
    n = F.regexp_extract(_col(c).cast("string"), AVAILABILITY_PATTERN, 1).try_cast("int")
    return n if default is None else F.coalesce(n, F.lit(default))


def clean_reviews(c) -> Column:
    """Review count as int; null or unparsable -> 0.  '5.0' is read through double."""
    return F.coalesce(parse_double(c).try_cast("int"), F.lit(0))


def to_number(c, dtype: str = "double") -> Column:
    """``to_numeric(errors='coerce')``: text that is no finite decimal number, NaN and infinities -> null.

    Whole-number text keeps all its digits; decimal or exponent text goes
    through double and is truncated for an integer ``dtype``.
    """
    t = strip_whitespace(_col(c).cast("string"))
    exact = F.when(t.rlike(r"^[+-]?[0-9]+$"), t.try_cast(dtype))
    return F.coalesce(exact, parse_double(t).try_cast(dtype))


def safe_ratio(num, den, digits: int | None = None) -> Column:
    """num / den with a null result for a zero or null divisor (no inf, no error)."""
    r = F.try_divide(_col(num).cast("double"), _col(den).cast("double"))
    return r if digits is None else round_half_even(r, digits)


def round_half_even(c, digits: int = 2) -> Column:
    """Round like a dataframe's ``round``: scale by 10**digits, round half to
    even on the binary value, unscale.  (Spark's ``round`` rounds the decimal
    text half-up instead: 917.5 * 1.17 gives 1073.48 there, 1073.47 here.)"""
    scale = float(10 ** digits)
    return F.rint(_col(c) * F.lit(scale)) / F.lit(scale)


def round2(c) -> Column:
    return round_half_even(c, 2)


def main_currency(c) -> Column:
    """First entry of a comma separated code list, stripped ('USD, EUR' -> 'USD')."""
    return strip_whitespace(F.split(_col(c), ",").getItem(0))


def concat_year_month(year, month: str = "01") -> Column:
    """'<year>-<month>'; a null year gives null (unlike concat_ws)."""
    return F.concat(_col(year).cast("string"), F.lit("-" + month))


def processing_time(as_of=None) -> Column:
    """Processing timestamp as naive UTC wall clock (``TIMESTAMP_NTZ``): ``as_of``
    when given (reproducible; a naive value is taken as UTC), else the query's
    clock.  The value does not depend on the session time zone."""
    if as_of is None:
        epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
        return F.timestamp_add("MICROSECOND", F.unix_micros(F.current_timestamp()), epoch)
    if isinstance(as_of, Column):
        return as_of
    if isinstance(as_of, _dt.datetime):
        if as_of.tzinfo is not None:
            as_of = as_of.astimezone(_dt.timezone.utc).replace(tzinfo=None)
        as_of = as_of.strftime("%Y-%m-%d %H:%M:%S.%f")
    return F.to_timestamp_ntz(F.lit(str(as_of)))


def version_stamp(ts) -> Column:
    return F.date_format(_col(ts), VERSION_FORMAT)


def uptime_seconds(start_epoch_seconds, as_of=None) -> Column:
    """``time() - start``: seconds elapsed from a start epoch (seconds) to ``as_of`` (UTC)."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    now_us = F.timestamp_diff("MICROSECOND", epoch, processing_time(as_of))
    return now_us.cast("double") / F.lit(1e6) - _col(start_epoch_seconds).cast("double")
