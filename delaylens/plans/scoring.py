"""Live scoring: merged airport context -> feature row -> score, band, drivers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from delaylens.functions.calendar import with_calendar, with_holiday
from delaylens.functions.text import format_value, risk_band
from delaylens.operators.explain import paths_of, with_contributions
from delaylens.operators.history import top_factors
from delaylens.operators.model import TrainedModel


def historical_rate(airport: Column, rates: dict[str, float]) -> Column:
    """Long-run delay rate, as learned with the model; an unknown airport gets the
    mean of the rates."""
    if not rates:
        return F.lit(None).cast("double")
    table = F.create_map(*[F.lit(x) for pair in rates.items() for x in pair])
    return F.coalesce(F.try_element_at(table, airport), F.lit(sum(rates.values()) / len(rates)))


def live_features(
    context: DataFrame, holidays: DataFrame, rates: dict[str, float], at: str = "at", instant_traffic: bool = False
) -> DataFrame:
    """Feature columns for merged live contexts; `at` is the time of scoring
    and typecode is null unless the context is about one aircraft.

    Traffic is the rolling count (which falls back to the instant's by itself);
    instant_traffic=True takes the instant's count for both windows."""
    typecode = F.col("typecode") if "typecode" in context.columns else F.lit(None).cast("string")
    metar = F.col("metar")
    rate = historical_rate(F.col("airport"), rates)
    rows = context.withColumns(
        {
            "adep": F.col("airport"),
            "typecode": typecode,
            **{
                c: F.col("live_traffic_count" if instant_traffic else c)
                for c in ("traffic_1h", "traffic_3h")
            },
            "visibility_mi": metar["visibility_mi"].cast("double"),
            "ceiling_ft": metar["ceiling_ft"].cast("double"),
            "flight_category": metar["flight_category"].cast("double"),
            "delay_rate_1h": rate,
            "delay_rate_3h": rate,
        }
    )
    return with_holiday(with_calendar(rows, at), holidays, "adep", at)


def score_context(rows: DataFrame, model: TrainedModel, top: int = 3) -> DataFrame:
    """Adds risk_score (4 places), risk_level and top_factors."""
    spec = model.spec
    if model.paths is None:
        model.paths = [paths_of(tree) for tree in model.booster.trees]
    explained = with_contributions(rows, model.booster, spec, model.paths, "_score")
    shown = F.array(
        *[
            format_value(
                F.lit(n),
                F.lit(None).cast("double") if n in spec.categorical else F.col(n).cast("double"),
                F.col(n).cast("string") if n in spec.categorical else None,
            )
            for n in spec.names
        ]
    )
    missing_type = F.col("typecode").isNull() if "typecode" in rows.columns else F.lit(False)
    factors = top_factors(explained, spec.names, F.col("contributions"), shown, missing_type, top)
    return explained.select(
        *rows.columns,
        F.round("_score", 4).alias("risk_score"),
        risk_band(F.col("_score")).alias("risk_level"),
        factors.alias("top_factors"),
    )
