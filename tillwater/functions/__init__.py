"""Column functions; all stay inside the JVM."""

from tillwater.functions.text import (
    any_positive,
    drop_bootstrap,
    is_blank,
    keep_keys,
    positive_sources,
    source_weight,
    tokenize,
    upper_keys,
)
from tillwater.functions.times import (
    age_years,
    date_part,
    day_key,
    day_of,
    day_range,
    event_time,
    hour_of,
    hour_part,
    local_text,
    micros,
    millis_to_text,
    millis_to_timestamp,
    now_millis,
    parse_time,
    text_to_millis,
    time_text,
    timestamp_to_millis,
)

__all__ = [
    "age_years", "any_positive", "date_part", "day_key", "day_of", "day_range",
    "drop_bootstrap", "event_time", "hour_of", "hour_part", "is_blank", "keep_keys",
    "local_text", "micros", "millis_to_text", "millis_to_timestamp", "now_millis",
    "parse_time", "positive_sources", "source_weight", "text_to_millis",
    "time_text", "timestamp_to_millis", "tokenize", "upper_keys",
]
