"""JSON text helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._cols import as_col


def json_list_text(arr, empty_if_null: bool = True) -> Column:
    """JSON text of a string array with ``", "`` between items.

    Items are escaped by ``to_json``; the separator follows the text the
    ingest step stores, e.g. ``["A1", "E22"]`` and ``[]`` for a missing list.
    """
    a = as_col(arr)
    if empty_if_null:
        a = F.coalesce(a, F.array().cast("array<string>"))
    items = F.transform(a, lambda x: F.regexp_extract(
        F.to_json(F.array(x)), r"^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(items, ", "), F.lit("]"))
