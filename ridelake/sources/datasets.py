"""Dataset records: what the desk and forecast loads need to know about a table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame

from ridelake import schemas
from ridelake.plans import desk, forecast


@dataclass(frozen=True)
class Dataset:
    """A loadable table; users add their own by filling one in.

    ``entries`` names the page column that holds the records.
    """

    name: str
    page_schema: str
    schema: str
    time_column: str
    normalise: Callable[..., DataFrame]
    entries: str
    key: str | None = None


TICKETS = Dataset("ticket", schemas.TICKET_PAGE, schemas.TICKET, "created_at", desk.ticket_normalize, "tickets", "id")
TICKET_METRICS = Dataset(
    "ticket_metric", schemas.METRIC_PAGE, schemas.METRIC, "created_at", desk.ticket_metric_normalize, "ticket_metrics", "id"
)
USERS = Dataset("user", schemas.USER_PAGE, schemas.USER, "created_at", desk.user_normalize, "users", "id")
FORECASTS = Dataset(
    "forecast", schemas.FORECAST_PAGE, schemas.FORECAST, "updated_at_kr", forecast.forecast_wide, "response"
)
