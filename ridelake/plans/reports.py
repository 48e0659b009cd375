"""Small stand-alone reports: purchases, merchants, age groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ridelake.functions.labels import age_bucket, contains_any
from ridelake.operators.ranking import with_position


def _in_order(df: DataFrame, order: Sequence[str | Column], positions: bool) -> DataFrame:
    """Sorted, or numbered in that order, which writing and joining do not lose."""
    return with_position(df, order) if positions else df.orderBy(*order)


def purchases_latest_first(purchases: DataFrame, user_id: str | None = None, positions: bool = False) -> DataFrame:
    """Distinct items of each user (or of one), most recently bought first.

    The order column is part of the result; equal dates are ordered by item.
    ``positions`` adds each row's place in the whole report.
    """
    wanted = purchases if user_id is None else purchases.where(F.col("user_id") == user_id)
    latest = wanted.groupBy("user_id", "item").agg(F.max("purchase_date").alias("last_purchase_date"))
    return _in_order(latest, ["user_id", F.desc("last_purchase_date"), "item"], positions)


def merchant_purchase_counts(
    merchants: DataFrame, usages: DataFrame, name_parts: Sequence[str], positions: bool = False
) -> DataFrame:
    """Distinct paid usages of every merchant whose name has one of ``name_parts``.

    Usages are cut down to those merchants and counted before the join, so a
    merchant with very many usages does not become one task.
    """
    chosen = merchants.where(contains_any(F.col("name"), name_parts)).select("id", "name").distinct()
    counts = (
        usages.where(F.col("amount") > 0)
        .join(chosen.select(F.col("id").alias("merchant_id")), "merchant_id", "left_semi")
        .groupBy("merchant_id")
        .agg(F.count_distinct("id").alias("_paid"))
    )
    found = chosen.join(counts, F.col("id") == F.col("merchant_id"), "left").select(
        F.col("id").alias("market_id"),
        F.col("name").alias("market_name"),
        F.coalesce("_paid", F.lit(0)).alias("purchase_cnt"),
    )
    return _in_order(found, ["market_id", "market_name"], positions)


def age_bucket_messages(
    profiles: DataFrame, users: DataFrame, messages: DataFrame, positions: bool = False
) -> DataFrame:
    """Messages per gender and age bucket of trading users, busiest first.

    A missing age becomes the rounded mean age of all profiles.  The mean is a
    scalar subquery, not a window over the whole table.
    """
    known = F.count(F.when(F.col("age").isNotNull(), F.col("id")))
    mean_age = profiles.agg(F.round(F.try_divide(F.sum("age"), known)).alias("mean_age"))
    per_user = messages.groupBy(F.col("user_id").alias("_sender")).agg(F.count("id").alias("msg_cnt"))
    traders = users.where(F.col("trade_yn") == "Y").select(F.col("id").alias("_trader"))
    counted = (
        profiles.withColumn("age_pad", F.coalesce("age", mean_age.scalar()))
        .join(traders, F.col("user_id") == F.col("_trader"))
        .join(per_user, F.col("user_id") == F.col("_sender"), "left")
        .groupBy("gender", age_bucket(F.col("age_pad")).alias("age_div"))
        .agg(F.sum(F.coalesce("msg_cnt", F.lit(0))).alias("msg_cnt"))
        .where(F.col("msg_cnt") > 0)
    )
    return _in_order(counted, [F.desc("msg_cnt"), F.desc("age_div"), "gender"], positions)
