"""Column expressions and column-name mappings. All of them stay inside the JVM."""

from millrace.functions.hashing import (
    normal_of, pick, pick_weighted, random_id, unit_of,
)
from millrace.functions.names import (
    bronze_name, clean_columns, feature_name, snake_name,
)
from millrace.functions.numbers import (
    FARE_BANDS, band, fare_band, label_to_int, lenient_double, lenient_int, matches,
)
from millrace.functions.texts import initial_caps, name_like, pseudonym, swap_url_host
from millrace.functions.times import (
    days_between, epoch_millis, formatted, parse_timestamp, weekend_flag, whole_second,
)

__all__ = [
    "FARE_BANDS", "band", "bronze_name", "clean_columns", "days_between", "epoch_millis",
    "fare_band", "feature_name", "formatted", "initial_caps", "label_to_int", "lenient_double",
    "lenient_int", "matches", "name_like", "normal_of", "parse_timestamp", "pick",
    "pick_weighted", "pseudonym", "random_id", "snake_name", "swap_url_host", "unit_of",
    "weekend_flag", "whole_second",
]
