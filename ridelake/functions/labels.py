"""Fixed label sets and the column rules built on them."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Ride types in their sort order; any other type sorts after them.
RIDE_TYPE_ORDER = {"LITE": 1, "PREMIUM": 2, "NXT": 3}
OTHER_TYPE_ORDER = 4
RIDE_TYPES = ["LITE", "PREMIUM", "NXT", "NEAR_TAXI"]
REVENUE_TYPES = ["LITE", "PREMIUM", "NXT"]
# Output prefix of each ride type's estimate columns.
ESTIMATE_PREFIX = {"LITE": "lite", "PREMIUM": "plus", "NXT": "next"}
# The premium product is reported under another name.
PREMIUM, PLUS = "PREMIUM", "PLUS"
# Regions.
CITY_MARK, CITY_REGION = "성남시", "성남"
FOLDED_REGIONS, FOLDED_INTO = ["서울_경기", "부천", "인천"], "서울"
MARKET_REGIONS = ["서울", "부산", "성남"]
# Ride and driver states.
DROPPED_OFF = "DROPPED_OFF"
UNMATCHED = "UNMATCHED"
WORKING_STATES = ["IDLE", "DISPATCHING", "RIDING"]
PICKED_UP = "PICKED_UP"
# Fixed value: value added tax divisor.
VAT_DIVISOR = 1.1
# Fixed value: surge percentage that means "no surge".
BASE_SURGE = 100
# Age buckets as (lower bound, upper bound, label).
AGE_BUCKETS = [
    (None, 20, "20대 미만"),
    (20, 29, "20대 이상 30대 미만"),
    (30, 39, "30대 이상 40대 미만"),
    (40, 49, "40대 이상 50대 미만"),
    (50, 59, "50대 이상 60대 미만"),
    (60, None, "60대 이상"),
]


def driver_type(ride_type: Column) -> Column:
    """Ride type as reported: every occurrence of the premium name is replaced."""
    return F.replace(ride_type, F.lit(PREMIUM), F.lit(PLUS))


def type_order(ride_type: Column) -> Column:
    ranked = F.lit(OTHER_TYPE_ORDER)
    for name, rank in RIDE_TYPE_ORDER.items():
        ranked = F.when(ride_type == name, rank).otherwise(ranked)
    return ranked


def mentions(text: Column, pattern: str) -> Column:
    """Partial regular-expression match; NULL text gives NULL."""
    return text.rlike(pattern)


def contains_any(text: Column, parts: Iterable[str]) -> Column:
    """``LIKE '%a%' OR LIKE '%b%'`` for literal parts."""
    parts = list(parts)
    if not parts:
        raise ValueError("give at least one part")
    found = text.contains(parts[0])
    for part in parts[1:]:
        found = found | text.contains(part)
    return found


def region_from_address(address: Column) -> Column:
    """First two characters of the first word, with one city singled out.

    An empty address gives an empty label and NULL stays NULL.
    """
    first_word = F.split_part(address, F.lit(" "), F.lit(1))
    return F.when(address.contains(CITY_MARK), CITY_REGION).otherwise(F.substring(first_word, 1, 2))


def fold_region(region: Column) -> Column:
    return F.when(region.isin(FOLDED_REGIONS), FOLDED_INTO).otherwise(region)


def without_vat(amount: Column) -> Column:
    return amount / F.lit(VAT_DIVISOR)


def age_bucket(age: Column) -> Column:
    """Bucket label; NULL and fractional ages between two buckets give NULL."""
    label = F.lit(None).cast("string")
    for low, high, name in reversed(AGE_BUCKETS):
        if low is None:
            inside = age < high
        elif high is None:
            inside = age >= low
        else:
            inside = age.between(low, high)
        label = F.when(inside, name).otherwise(label)
    return label
