"""Weather forecasts: places -> grid cells -> pages -> one wide row per forecast."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ridelake.functions import weather
from ridelake.functions.geo import ConicGrid
from ridelake.functions.times import MARKET_ZONE, wall_from_parts
from ridelake.operators.groups import pivot_known

_PLACE = ["h3_l7", "lat", "lon", "updated_at_kr"]
ROW_KEYS = [*_PLACE, "base_at_kr", "forecast_at_kr"]


def accepted_pages(pages: DataFrame) -> DataFrame:
    """Pages whose result code is 0."""
    return pages.where(F.try_to_number("response.header.resultCode", F.lit("99")) == 0)


def rejected_pages(pages: DataFrame) -> DataFrame:
    """Code and message of the other pages, for quarantine."""
    code = F.try_to_number("response.header.resultCode", F.lit("99"))
    return pages.where(code.isNull() | (code != 0)).select(
        F.col("response.header.resultCode").alias("result_code"),
        F.col("response.header.resultMsg").alias("result_message"),
        F.col("response.body.h3_l7").alias("h3_l7"),
    )


def checked_pages(pages: DataFrame) -> DataFrame:
    """All pages, failing on the first one with another result code."""
    header = F.col("response.header")
    failure = F.concat(
        F.lit("forecast page rejected: "),
        F.coalesce(header["resultCode"], F.lit("?")),
        F.lit(" "),
        F.coalesce(header["resultMsg"], F.lit("")),
    )
    good = F.coalesce(F.try_to_number(header["resultCode"], F.lit("99")) == 0, F.lit(False))
    return pages.where(F.when(good, True).otherwise(F.raise_error(failure).cast("boolean")))


def forecast_items(pages: DataFrame) -> DataFrame:
    """One row per forecast item with the columns of its place; times are still text."""
    body = F.col("response.body")
    return pages.select(
        body["h3_l7"].alias("h3_l7"),
        body["lat"].alias("lat"),
        body["lon"].alias("lon"),
        body["updated_at_kr"].alias("updated_at_kr"),
        F.explode(body["items"]["item"]).alias("item"),
    ).select("h3_l7", "lat", "lon", "updated_at_kr", "item.*")


def widen_items(items: DataFrame) -> DataFrame:
    """Items -> one row per place and forecast time, in one aggregation.

    Values are typed before they are aggregated: a repeated category keeps its
    largest value, and the buffers are plain numbers that combine on the map
    side, where all items of one page sit together.  Times are parsed after it,
    once per row instead of once per item.
    """
    text = F.col("fcstValue")
    whole, real = text.try_cast("bigint"), text.try_cast("double")
    return pivot_known(
        items,
        [*_PLACE, "baseDate", "baseTime", "fcstDate", "fcstTime"],
        "category",
        {
            "_thunder": ("LGT", real),
            "precipitation": ("PTY", whole),
            "_rain": ("RN1", weather.rain_bucket(text)),
            "sky_condition": ("SKY", whole),
            "temperatures": ("T1H", whole),
            "_humidity": ("REH", whole),
            "wind_spped_mps": ("WSD", real),
        },
    ).select(
        *_PLACE,
        wall_from_parts(F.col("baseDate"), F.col("baseTime")).alias("base_at_kr"),
        wall_from_parts(F.col("fcstDate"), F.col("fcstTime")).alias("forecast_at_kr"),
        weather.is_above_zero(F.col("_thunder")).alias("is_thunder"),
        "precipitation",
        F.coalesce("_rain", F.lit(weather.OTHER_RAIN_BUCKET)).alias("rain"),
        "sky_condition",
        "temperatures",
        weather.percentage(F.col("_humidity")).alias("humidity_rate"),
        "wind_spped_mps",
    )


def forecast_wide(pages: DataFrame, strict: bool = False, with_day: bool = False) -> DataFrame:
    """Forecast pages -> typed rows (schema ``schemas.FORECAST``).

    Rejected pages are left out, or fail the job if ``strict``; ``strict`` also
    fails on a missing numeric category.  ``with_day`` adds ``date_kr``.
    """
    wide = widen_items(forecast_items(checked_pages(pages) if strict else accepted_pages(pages)))
    if strict:
        for name in ("precipitation", "sky_condition", "temperatures", "humidity_rate"):
            missing = F.raise_error(F.lit(f"forecast category missing: {name}"))
            wide = wide.withColumn(name, F.coalesce(name, missing.cast(wide.schema[name].dataType)))
    if with_day:
        wide = wide.withColumn("date_kr", F.to_date("forecast_at_kr"))
    return wide


def project_to_grid(
    df: DataFrame, lat: str = "lat", lon: str = "lon", x: str = "nx", y: str = "ny", grid: ConicGrid = ConicGrid()
) -> DataFrame:
    """Add the grid cell of a position."""
    gx, gy = grid.forward(F.col(lat), F.col(lon))
    return df.withColumns({x: gx, y: gy})


def grid_to_latlon(
    df: DataFrame,
    x: str = "nx",
    y: str = "ny",
    lat: str = "grid_lat",
    lon: str = "grid_lon",
    grid: ConicGrid = ConicGrid(),
) -> DataFrame:
    """Add the position of a grid cell."""
    glat, glon = grid.inverse(F.col(x), F.col(y))
    return df.withColumns({lat: glat, lon: glon})


def grid_fetch_plan(places: DataFrame, run_at_utc: dt.datetime, grid: ConicGrid = ConicGrid()) -> DataFrame:
    """One row per cell to fetch, with the number of places it serves and the run's local date and time."""
    run_at = F.convert_timezone(F.lit("UTC"), F.lit(MARKET_ZONE), F.lit(run_at_utc.isoformat(sep=" ")).cast("timestamp_ntz"))
    distinct = places.select("h3_l7", "lat", "lon").distinct()
    return (
        project_to_grid(distinct, grid=grid)
        .groupBy("nx", "ny")
        .agg(F.count(F.lit(1)).alias("place_count"))
        .select(
            F.date_format(run_at, "yyyyMMdd").alias("base_date"),
            F.date_format(run_at, "HHmm").alias("base_time"),
            "nx",
            "ny",
            "place_count",
        )
    )


def places_of_cells(places: DataFrame, cells: DataFrame, grid: ConicGrid = ConicGrid()) -> DataFrame:
    """Join fetched cells back to every place they serve."""
    return project_to_grid(places, grid=grid).join(cells, ["nx", "ny"])
