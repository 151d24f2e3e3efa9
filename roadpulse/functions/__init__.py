"""Column-returning helpers: every one is a built-in Spark expression."""

from .keys import stable_key
from .labels import (ALERT_CATEGORIES, CATEGORY_NAMES, category_name, delay_text,
                     location_text)
from .measures import (CONGESTED_BELOW, LEVEL_BOUNDS, level, safe_ratio)
from .payload import json_list_text
from .times import (batch_date, batch_key, batch_timestamp, batch_timestamp_ntz,
                    iso_timestamp, stamp)

__all__ = [
    "ALERT_CATEGORIES", "CATEGORY_NAMES", "CONGESTED_BELOW", "LEVEL_BOUNDS",
    "batch_date", "batch_key", "batch_timestamp", "batch_timestamp_ntz",
    "category_name", "delay_text", "iso_timestamp", "json_list_text",
    "level", "location_text", "safe_ratio", "stable_key", "stamp",
]
