"""Alert text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col

# Incident category code -> name.
CATEGORY_NAMES = {
    "0": "Unknown",
    "1": "Accident",
    "2": "Fog",
    "3": "Dangerous Conditions",
    "4": "Rain",
    "5": "Ice",
    "6": "Jam",
    "7": "Road Works",
    "8": "Road Closed",
    "9": "Lane Closed",
    "14": "Broken Down Vehicle",
}

# Alert categories (accident, road closed) and text pieces.
ALERT_CATEGORIES = ("1", "8")
MISSING_TEXT = "N/A"
ARROW = " → "
UNKNOWN_DELAY = "unknown"


def category_name(c, mapping: dict[str, str] = CATEGORY_NAMES) -> Column:
    """Name of a category code; an unknown code passes through unchanged."""
    x = as_col(c).cast("string")
    lookup = F.create_map(*[F.lit(v) for kv in mapping.items() for v in kv])
    return F.coalesce(F.try_element_at(lookup, x), x)


def location_text(a, b, missing: str = MISSING_TEXT, arrow: str = ARROW) -> Column:
    """``from → to``; null or empty ends read as ``N/A``."""
    def side(c):
        return F.coalesce(F.nullif(as_col(c), F.lit("")), F.lit(missing))
    return F.concat(side(a), F.lit(arrow), side(b))


def delay_text(c, unknown: str = UNKNOWN_DELAY) -> Column:
    """Whole seconds (truncated) + `` seconds``; null or zero is ``unknown``."""
    x = as_col(c)
    return (F.when(x.isNotNull() & (x != 0),
                   F.concat(x.cast("bigint").cast("string"), F.lit(" seconds")))
            .otherwise(F.lit(unknown)))
