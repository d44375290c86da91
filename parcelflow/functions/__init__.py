"""Column-level building blocks (all native Spark expressions, no Python UDFs)."""

from .nulls import (NULL_SPELLINGS, drop_sentinel_rows, is_sentinel, normalize_nulls,  # noqa: F401
                    null_if_sentinel, stringify, stringify_all)
from .timefmt import (FORMATS, TEXT_LAYOUTS, add_days, add_hours, add_minutes, add_seconds,  # noqa: F401
                      at_time_of_day, format_pattern, format_text, format_ts, iso_to_ts, millis_between, minutes_between,
                      parse_ts, parse_ts_strict5, time_of_day_seconds, to_ts)
from .bind import let  # noqa: F401,E402
