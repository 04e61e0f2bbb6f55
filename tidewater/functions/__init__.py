"""Column expressions built only from Spark built-in functions."""

from tidewater.functions.dates import (  # noqa: F401
    date_key, day_name_padded, day_of_week0, is_weekend, iso_week,
    month_name_padded, month_start, ntz,
)
from tidewater.functions.numeric import (  # noqa: F401
    idiv, micros_between, round_half_away_ratio, round_half_up_ratio,
    seconds_from_micros,
)
from tidewater.functions.text import strip_all, upper_strip  # noqa: F401
