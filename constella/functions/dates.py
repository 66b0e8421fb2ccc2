"""Calendar attributes of the date dimension."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: output column order of the date dimension
DATE_ATTRIBUTES = [
    "date_key", "date", "date_iso", "date_full", "day_of_week", "day_of_month",
    "day_of_year", "week_of_year", "month", "month_name", "quarter", "year", "is_weekend",
]


def date_grain(ts: str | Column, grain: str = "timestamp") -> Column:
    """Natural key of the date dimension: the timestamp itself (as loaded),
    or midnight of its day (``grain="day"``, which makes ``date_key`` unique)."""
    c = F.col(ts) if isinstance(ts, str) else ts
    if grain == "timestamp":
        return c
    if grain == "day":
        # via DATE: no session time zone is involved for timestamp_ntz
        return c.cast("date").cast("timestamp_ntz")
    raise ValueError(f"unknown grain {grain!r}")


def date_attributes(ts: str | Column) -> dict[str, Column]:
    """All attribute columns keyed by name, in ``DATE_ATTRIBUTES`` order.
    ``is_weekend`` follows Spark's ``dayofweek`` (1 = Sunday, 7 = Saturday);
    ``week_of_year`` is the ISO week."""
    c = F.col(ts) if isinstance(ts, str) else ts
    # fixed values: the date patterns of the dimension
    return {
        "date_key": F.date_format(c, "yyyyMMdd").cast("int"),
        "date": c,
        "date_iso": F.date_format(c, "yyyy-MM-dd"),
        "date_full": F.date_format(c, "MMMM d, yyyy"),
        "day_of_week": F.date_format(c, "EEEE"),
        "day_of_month": F.dayofmonth(c),
        "day_of_year": F.dayofyear(c),
        "week_of_year": F.weekofyear(c),
        "month": F.month(c),
        "month_name": F.date_format(c, "MMMM"),
        "quarter": F.quarter(c),
        "year": F.year(c),
        "is_weekend": F.coalesce(F.dayofweek(c).isin(1, 7), F.lit(False)),
    }
