"""Forecast value expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Rain text -> bucket; any other or missing text falls into the other bucket.  Buckets sort by amount.
RAIN_BUCKET = {
    "강수없음": "01_강수없음",
    "1.0mm 미만": "02_1mm 미만",
    "30.0~50.0mm": "04_30mm 이상 50mm 미만",
    "50.0mm 이상": "05_50mm 이상",
}
OTHER_RAIN_BUCKET = "03_1mm 이상 30mm 미만"


def rain_bucket(text: Column) -> Column:
    known = F.create_map(*[F.lit(part) for pair in RAIN_BUCKET.items() for part in pair])
    return F.coalesce(F.try_element_at(known, text), F.lit(OTHER_RAIN_BUCKET))


def is_above_zero(number: Column) -> Column:
    """Flag of a numeric value, False when it is missing."""
    return F.coalesce(number > 0, F.lit(False))


def percentage(number: Column) -> Column:
    return number / F.lit(100)
