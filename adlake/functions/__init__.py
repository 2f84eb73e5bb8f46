"""Column functions: cleaning, time, flags and the Python date UDF variants."""
from adlake.functions.columns import (epoch_seconds, event_timestamp, missing_flag, numeric,
                                      ratio, reporting_date, utc_wall_clock)
from adlake.functions.dates import reporting_date_column

__all__ = ["epoch_seconds", "event_timestamp", "missing_flag", "numeric", "ratio",
           "reporting_date", "utc_wall_clock", "reporting_date_column"]
