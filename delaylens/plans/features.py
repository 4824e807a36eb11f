"""The batch feature job: flights + hourly weather + hourly station reports +
holidays -> one feature row per departure."""

from __future__ import annotations

from pyspark.sql import DataFrame

from delaylens.constants import EXTRACTED_SCHEMA, FEATURE_SCHEMA
from delaylens.functions.calendar import holiday_dim, with_calendar, with_holiday, years_of
from delaylens.operators.joins import hourly_lookup_join
from delaylens.operators.rolling import fill_cold_start, trailing_windows
from delaylens.sources.files import conform, in_scope

WEATHER_VALUES = ["temperature_2m", "precipitation", "wind_speed_10m"]
REPORT_VALUES = ["visibility_mi", "ceiling_ft", "flight_category"]


def extract(
    flights: DataFrame, weather: DataFrame, reports: DataFrame, scope: list[str], holidays: DataFrame | None = None
) -> DataFrame:
    """Row-local stage: scope filter, calendar, holidays, hourly lookups. Runs
    over any part of the flights, batch or stream. A stream must bring its
    holiday calendar, as its years are not known in advance."""
    departures = flights.where(in_scope("adep", scope))
    if holidays is None:
        holidays = holiday_dim(years_of(departures, "first_seen"))
    dated = with_holiday(with_calendar(departures), holidays)
    joined = hourly_lookup_join(dated, weather, WEATHER_VALUES, lookup_hour="time")
    joined = hourly_lookup_join(joined, reports, REPORT_VALUES)
    return conform(joined, EXTRACTED_SCHEMA)


def transform(extracted: DataFrame, fill: str = "key", as_of: str | None = None) -> DataFrame:
    """Windowed stage over all extracted rows at once: a chunk alone would miss
    the flights just before it."""
    rolled = trailing_windows(extracted)
    filled = fill_cold_start(rolled, fill=fill, as_of=as_of, history=extracted)
    return conform(filled, FEATURE_SCHEMA)


def build_features(
    flights: DataFrame, weather: DataFrame, reports: DataFrame, scope: list[str], fill: str = "key"
) -> DataFrame:
    return transform(extract(flights, weather, reports, scope), fill)
