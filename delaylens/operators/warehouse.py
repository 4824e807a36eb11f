"""Star schema: dimensions, fact load, audits, KPIs and breakdowns."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from delaylens.constants import DAY_HELPER, KPI_GOOD, KPI_WARNING, MONTH_HELPER, SEASONS, TIME_OF_DAY
from delaylens.functions.text import pick
from delaylens.operators.prefix import dense_ids
from delaylens.session import stage


def band(value: Column, bands: list[tuple[str, float | None]]) -> Column:
    """Name of the last band whose lower bound is at or below the value."""
    out = F.lit(bands[0][0])
    for name, lower in bands[1:]:
        out = F.when(value >= F.lit(lower), name).otherwise(out)
    return F.when(value.isNotNull(), out)


def map_group(value: Column, groups: dict[str, str], other: str) -> Column:
    out = F.lit(other)
    for code, group in groups.items():
        out = F.when(value == code, group).otherwise(out)
    return out


def time_id(ts: Column) -> Column:
    """Hour key YYYYMMDDHH."""
    return F.date_format(ts, "yyyyMMddHH").cast("bigint")


def time_dimension(
    df: DataFrame,
    columns: list[str],
    day_names: list[str] = DAY_HELPER,
    month_names: list[str] = MONTH_HELPER,
) -> DataFrame:
    """One row per hour between the first and last timestamp of `columns`."""
    span = df.agg(
        F.least(*[F.min(c) for c in columns], F.lit(None).cast("timestamp_ntz")).alias("lo"),
        F.greatest(*[F.max(c) for c in columns], F.lit(None).cast("timestamp_ntz")).alias("hi"),
    )
    # one row per day first, so that the hours are expanded in parallel
    days = (
        span.where("lo is not null")
        .select(F.explode(F.sequence(F.to_date("lo"), F.to_date("hi"))).alias("day"), "lo", "hi")
        .repartition("day")
    )
    hours = days.select(
        "lo", "hi", F.explode(F.transform(F.sequence(F.lit(0), F.lit(23)), lambda h: _at_hour(F.col("day"), h))).alias("ts")
    ).where("ts >= date_trunc('hour', lo) and ts <= hi")
    hour, weekday, month = F.hour("ts"), F.weekday("ts"), F.month("ts")
    return hours.select(
        time_id(F.col("ts")).alias("time_id"),
        F.year("ts").cast("bigint").alias("year"),
        F.quarter("ts").cast("bigint").alias("quarter"),
        month.cast("bigint").alias("month"),
        pick(month_names, month - 1).alias("month_name"),
        F.day("ts").cast("bigint").alias("day"),
        (weekday + 1).cast("bigint").alias("day_of_week"),
        pick(day_names, weekday).alias("day_name"),
        weekday.isin(5, 6).alias("weekend"),
        pick(SEASONS, F.floor((month % 12) / 3)).alias("season"),
        hour.cast("bigint").alias("hour"),
        band(hour, TIME_OF_DAY).alias("time_of_day"),
    )


def _at_hour(day: Column, hour: Column) -> Column:
    return (day.cast("timestamp_ntz") + F.make_dt_interval(F.lit(0), hour)).cast("timestamp_ntz")


def dimension(
    df: DataFrame, natural_key: list[str], attributes: list[str], id_name: str, staged: bool = True
) -> DataFrame:
    """Distinct natural keys with their attributes and a dense surrogate key.

    Attributes that differ between rows of one key are resolved to the largest
    combination, so that the result does not depend on row order. Numbering
    reads the keys twice, so they are staged unless the source is cheap; the
    numbered rows are staged too, for every role of a fact reads them."""
    if attributes:
        rows = df.groupBy(*natural_key).agg(F.max(F.struct(*attributes)).alias("_a")).select(*natural_key, "_a.*")
    else:
        rows = df.select(*natural_key).distinct()
    rows = stage(rows, id_name) if staged else rows
    return stage(dense_ids(rows, natural_key, id_name).select(id_name, *natural_key, *attributes), id_name)


def extend_dimension(existing: DataFrame, incoming: DataFrame, natural_key: list[str], id_name: str) -> DataFrame:
    """Keeps the ids of known keys and numbers new keys after the largest one."""
    new = incoming.join(existing.select(*natural_key), natural_key, "left_anti")
    last = existing.agg(F.coalesce(F.max(id_name), F.lit(0))).scalar()
    numbered = dense_ids(stage(new, id_name), natural_key, id_name).withColumn(id_name, F.col(id_name) + last)
    return existing.unionByName(numbered.select(*existing.columns))


def lookup_dimension(
    fact: DataFrame,
    dim: DataFrame,
    on: dict[str, str],
    dim_id: str,
    fact_id: str,
    required: bool = True,
    attributes: dict[str, str] | None = None,
) -> DataFrame:
    """Adds the surrogate key of one role. `on` maps fact columns to natural-key
    columns; required roles drop unmatched rows, others get a null key."""
    attributes = attributes or {}
    side = dim.select(
        F.col(dim_id).alias(fact_id),
        *[F.col(d).alias(f"_nk_{i}") for i, d in enumerate(on.values())],
        *[F.col(a).alias(name) for a, name in attributes.items()],
    )
    condition = reduce(lambda a, b: a & b, [F.col(f) == F.col(f"_nk_{i}") for i, f in enumerate(on)])
    joined = fact.join(side, condition, "inner" if required else "left")
    return joined.drop(*[f"_nk_{i}" for i in range(len(on))])


def audit_fact(fact: DataFrame, required: list[str], foreign_keys: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Violations per check: nulls in required columns and keys without a
    dimension row.

    The fact is scanned twice whatever the number of keys: once for the nulls,
    once to count rows per (role, key). Only distinct keys meet the
    dimensions."""
    nulls = fact.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in required]).select(
        F.inline(F.array(*[F.struct(F.lit(f"not_null:{c}").alias("check"), F.col(c).alias("n")) for c in required]))
    )
    used = (
        fact.select(
            F.inline(
                F.array(*[F.struct(F.lit(k).alias("role"), F.col(k).cast("string").alias("id")) for k in foreign_keys])
            )
        )
        .where("id is not null")
        .groupBy("role", "id")
        .agg(F.count("*").alias("n"))
    )
    known = reduce(
        DataFrame.unionByName,
        [
            dim.select(F.lit(role).alias("role"), F.col(dim_id).cast("string").alias("id"))
            for role, (dim, dim_id) in foreign_keys.items()
        ],
    )
    orphans = (
        used.join(known, ["role", "id"], "left_anti")
        .groupBy(F.concat(F.lit("foreign_key:"), F.col("role")).alias("check"))
        .agg(F.sum("n").alias("n"))
    )
    return nulls.unionByName(orphans).where("n > 0")


def kpi_columns() -> dict[str, Column]:
    """KPI ratios over columns departure_delay, arrival_delay, weather_delay,
    cancelled. Our definitions, where only names are given:

    on_time_ratio        flown with arrival delay below 15 minutes / flown
    delay_recovery_ratio late departures that made up time in the air / late departures
    weather_delay_ratio  weather minutes / minutes of positive arrival delay
    cancellation_ratio   cancelled / all
    avg_arrival_delay    mean arrival delay of flown rows
    """
    flown = ~F.col("cancelled")
    arrival, departure = F.col("arrival_delay"), F.col("departure_delay")
    late_start = flown & (departure > 0)
    positive_delay = F.when(flown & (arrival > 0), arrival)

    def share(a: Column, b: Column) -> Column:
        return F.try_divide(a.cast("double"), b)

    return {
        "on_time_ratio": share(F.count_if(flown & (arrival < 15)), F.count_if(flown)),
        "delay_recovery_ratio": share(F.count_if(late_start & (arrival < departure)), F.count_if(late_start)),
        "weather_delay_ratio": share(F.sum(F.when(flown, F.col("weather_delay"))), F.sum(positive_delay)),
        "cancellation_ratio": share(F.count_if(F.col("cancelled")), F.count("*")),
        "avg_arrival_delay": F.avg(F.when(flown, arrival)),
    }


def kpi_ratios(fact: DataFrame, keys: list[str]) -> DataFrame:
    return fact.groupBy(*keys).agg(*[c.alias(name) for name, c in kpi_columns().items()])


def kpi_status(ratio: Column) -> Column:
    return F.when(ratio >= KPI_GOOD, "good").when(ratio >= KPI_WARNING, "warning").when(ratio.isNotNull(), "critical")


def kpi_status_trend(monthly: DataFrame, keys: list[str], month: str, ratio: str) -> DataFrame:
    """Status of each month's ratio and its change against the month before in
    the data. One row per month and key by now, so the window is small."""
    previous = F.lag(ratio).over(Window.partitionBy(*keys).orderBy(month))
    return monthly.withColumns(
        {"status": kpi_status(F.col(ratio)), "trend": F.signum(F.col(ratio) - previous).cast("bigint")}
    )


def cube_ratio(fact: DataFrame, dims: list[str], measures: dict[str, Column]) -> DataFrame:
    """All combinations of the dimensions, with grouping_id telling which are
    totalled."""
    return fact.cube(*dims).agg(F.grouping_id().cast("bigint").alias("level"), *[c.alias(n) for n, c in measures.items()])


def rollup_ratio(fact: DataFrame, dims: list[str], measures: dict[str, Column]) -> DataFrame:
    return fact.rollup(*dims).agg(F.grouping_id().cast("bigint").alias("level"), *[c.alias(n) for n, c in measures.items()])


def pivot_ratio(fact: DataFrame, row: str, column: str, values: list[str], measure: Column) -> DataFrame:
    """One output column per listed value; the list makes it one pass."""
    return fact.groupBy(row).pivot(column, values).agg(measure)


def share_by_key(fact: DataFrame, key: str, measure: Column, name: str) -> DataFrame:
    """Each key's total and its share of the whole."""
    totals = fact.groupBy(key).agg(measure.alias(name))
    whole = totals.agg(F.sum(name)).scalar()
    return totals.withColumn("share", F.try_divide(F.col(name).cast("double"), whole.cast("double")))


def hourly_profile(fact: DataFrame, hour: str, delay: str) -> DataFrame:
    return fact.groupBy(hour).agg(F.count("*").alias("flights"), F.avg(delay).alias("avg_delay"))


def delay_by_cause(fact: DataFrame, keys: list[str], causes: list[str]) -> DataFrame:
    """Delay minutes by cause in long form: summed wide first, then turned."""
    wide = fact.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in causes])
    return wide.unpivot(keys, causes, "cause", "minutes")
