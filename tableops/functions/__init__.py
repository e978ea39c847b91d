"""Column expressions (no jobs): dates, NULL-strict variants, codes."""

from .dates import (  # noqa: F401
    as_date, boundary_diff, date_or_monday, date_path, epoch_micros_to_date, first_day_of_week,
    iso_day_of_week, iso_year_of_week, last_day_of_week, parse_date_any, parse_event_ts, parse_month_label,
    previous_monday, unpadded_year_month, year_month,
)
from .casts import try_number  # noqa: F401
from .nulls import concat_ws_strict, greatest_strict  # noqa: F401
from .text import code, last_path_part, normalise_name, normalise_name_py  # noqa: F401
