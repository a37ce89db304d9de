from rivulet.functions.clean import (  # noqa: F401
    clean_availability, clean_price_digits, clean_price_strict, clean_reviews,
    concat_year_month, main_currency, processing_time, round2, round_half_even, safe_ratio,
    strip_whitespace, to_number, uptime_seconds, version_stamp,
)
