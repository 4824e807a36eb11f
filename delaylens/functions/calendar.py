"""Calendar columns, hour keys and public holidays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from delaylens.constants import AIRPORTS

# --- fixed values: national public holidays ---------------------------------
# (country, rule, month, day, first year, last year)
#   fixed          that date; easter: day is the offset from Easter Sunday
#   first_mon / last_mon: first / last Monday of the month
#   observed       the date moved to the next working day if it is a weekend
#   kings_day      the date, or the day before if it is a Sunday
#   lustrum        the date, in years divisible by five
HOLIDAY_RULES = [
    ("DE", "fixed", 1, 1, 1900, 2200),
    ("DE", "easter", 0, -2, 1900, 2200),
    ("DE", "easter", 0, 1, 1900, 2200),
    ("DE", "fixed", 5, 1, 1900, 2200),
    ("DE", "easter", 0, 39, 1900, 2200),
    ("DE", "easter", 0, 50, 1900, 2200),
    ("DE", "fixed", 10, 3, 1990, 2200),
    ("DE", "fixed", 10, 31, 2017, 2017),
    ("DE", "fixed", 12, 25, 1900, 2200),
    ("DE", "fixed", 12, 26, 1900, 2200),
    ("PL", "fixed", 1, 1, 1900, 2200),
    ("PL", "fixed", 1, 6, 2011, 2200),
    ("PL", "easter", 0, 0, 1900, 2200),
    ("PL", "easter", 0, 1, 1900, 2200),
    ("PL", "fixed", 5, 1, 1950, 2200),
    ("PL", "fixed", 5, 3, 1990, 2200),
    ("PL", "easter", 0, 49, 1900, 2200),
    ("PL", "easter", 0, 60, 1900, 2200),
    ("PL", "fixed", 8, 15, 1990, 2200),
    ("PL", "fixed", 11, 1, 1900, 2200),
    ("PL", "fixed", 11, 11, 1990, 2200),
    ("PL", "fixed", 11, 12, 2018, 2018),
    ("PL", "fixed", 12, 24, 2025, 2200),
    ("PL", "fixed", 12, 25, 1900, 2200),
    ("PL", "fixed", 12, 26, 1900, 2200),
    ("GB", "fixed", 1, 1, 1975, 2200),
    ("GB", "observed", 1, 1, 1975, 2200),
    ("GB", "easter", 0, -2, 1900, 2200),
    ("GB", "first_mon", 5, 0, 1978, 2019),
    ("GB", "fixed", 5, 8, 2020, 2020),
    ("GB", "first_mon", 5, 0, 2021, 2200),
    ("GB", "last_mon", 5, 0, 1971, 2001),
    ("GB", "last_mon", 5, 0, 2003, 2011),
    ("GB", "last_mon", 5, 0, 2013, 2021),
    ("GB", "last_mon", 5, 0, 2023, 2200),
    ("GB", "fixed", 6, 3, 2002, 2002),
    ("GB", "fixed", 6, 4, 2002, 2002),
    ("GB", "fixed", 4, 29, 2011, 2011),
    ("GB", "fixed", 6, 4, 2012, 2012),
    ("GB", "fixed", 6, 5, 2012, 2012),
    ("GB", "fixed", 6, 2, 2022, 2022),
    ("GB", "fixed", 6, 3, 2022, 2022),
    ("GB", "fixed", 9, 19, 2022, 2022),
    ("GB", "fixed", 5, 8, 2023, 2023),
    ("GB", "fixed", 12, 25, 1900, 2200),
    ("GB", "fixed", 12, 26, 1900, 2200),
    ("GB", "observed", 12, 25, 1975, 2200),
    ("GB", "observed", 12, 26, 1975, 2200),
    ("FR", "fixed", 1, 1, 1900, 2200),
    ("FR", "easter", 0, 1, 1900, 2200),
    ("FR", "fixed", 5, 1, 1919, 2200),
    ("FR", "fixed", 5, 8, 1982, 2200),
    ("FR", "easter", 0, 39, 1900, 2200),
    ("FR", "easter", 0, 50, 1900, 2200),
    ("FR", "fixed", 7, 14, 1900, 2200),
    ("FR", "fixed", 8, 15, 1900, 2200),
    ("FR", "fixed", 11, 1, 1900, 2200),
    ("FR", "fixed", 11, 11, 1918, 2200),
    ("FR", "fixed", 12, 25, 1900, 2200),
    ("NL", "fixed", 1, 1, 1900, 2200),
    ("NL", "easter", 0, 0, 1900, 2200),
    ("NL", "easter", 0, 1, 1900, 2200),
    ("NL", "kings_day", 4, 27, 2014, 2200),
    ("NL", "lustrum", 5, 5, 1990, 2200),
    ("NL", "easter", 0, 39, 1900, 2200),
    ("NL", "easter", 0, 49, 1900, 2200),
    ("NL", "easter", 0, 50, 1900, 2200),
    ("NL", "fixed", 12, 25, 1900, 2200),
    ("NL", "fixed", 12, 26, 1900, 2200),
]
# --- end of fixed values ----------------------------------------------------


def hour_floor(ts: Column) -> Column:
    return F.date_trunc("hour", ts).cast("timestamp_ntz")


def hour_text(ts: Column) -> Column:
    """The text form hourly sources use as their key, e.g. 2023-01-01T00:00."""
    return F.date_format(ts, "yyyy-MM-dd'T'HH:00")


def with_calendar(df: DataFrame, ts: str = "first_seen") -> DataFrame:
    day = F.weekday(ts)
    return df.withColumns(
        {
            "hour_of_day": F.hour(ts).cast("bigint"),
            "day_of_week": day.cast("bigint"),
            "month": F.month(ts).cast("bigint"),
            "is_weekend": day.isin(5, 6).cast("bigint"),
        }
    )


def easter_sunday(year: Column) -> Column:
    """Gregorian Easter by the anonymous computus, as integer column arithmetic."""

    def idiv(a: Column, b: int) -> Column:
        return F.floor(a / F.lit(b)).cast("int")

    golden = year % 19
    century, rest = idiv(year, 100), year % 100
    correction = idiv(century - idiv(century + 8, 25) + 1, 3)
    epact = (golden * 19 + century - idiv(century, 4) - correction + 15) % 30
    weekday = ((century % 4) * 2 + idiv(rest, 4) * 2 + 32 - epact - rest % 4) % 7
    late = idiv(golden + epact * 11 + weekday * 22, 451)
    serial = epact + weekday - late * 7 + 114
    return F.make_date(year, idiv(serial, 31), serial % 31 + 1)


def holiday_dim(years: DataFrame) -> DataFrame:
    """(country, date) for every year in `years(year int)`.

    Bounded by rules x years; each rule row computes its own date."""
    rows = ", ".join(f"'{c}', '{rule}', {m}, {d}, {lo}, {hi}" for c, rule, m, d, lo, hi in HOLIDAY_RULES)
    rules = F.expr(f"stack({len(HOLIDAY_RULES)}, {rows}) AS (country, rule, m, d, lo, hi)")
    y = F.col("year")
    anchor = F.make_date(y, F.greatest(F.col("m"), F.lit(1)), F.greatest(F.col("d"), F.lit(1)))
    month_start = F.make_date(y, F.greatest(F.col("m"), F.lit(1)), F.lit(1))
    # 25 and 26 December move past the weekend as a pair, hence two days
    shift = (
        F.when((F.col("m") == 12) & (F.dayofweek(anchor).isin(1, 7)), 2)
        .when(F.dayofweek(anchor) == 7, 2)
        .when(F.dayofweek(anchor) == 1, 1)
    )
    rule = F.col("rule")
    date = (
        F.when(rule == "fixed", anchor)
        .when(rule == "easter", F.date_add(easter_sunday(y), F.col("d")))
        .when(rule == "first_mon", F.next_day(F.date_sub(month_start, 1), "MON"))
        .when(rule == "last_mon", F.date_sub(F.next_day(F.last_day(month_start), "MON"), 7))
        .when(rule == "observed", F.date_add(anchor, shift))
        .when(rule == "kings_day", F.date_sub(anchor, (F.dayofweek(anchor) == 1).cast("int")))
        .when((rule == "lustrum") & (y % 5 == 0), anchor)
    )
    return (
        years.select(y.cast("int").alias("year"))
        .select(y, rules)
        .where(y.between(F.col("lo"), F.col("hi")))
        .select("country", date.alias("date"))
        .where("date is not null")
        .distinct()
    )


def years_of(df: DataFrame, ts: str) -> DataFrame:
    """Every calendar year the column spans, one row each."""
    span = df.agg(F.min(F.year(ts)).alias("lo"), F.max(F.year(ts)).alias("hi"))
    return span.where("lo is not null").select(F.explode(F.sequence("lo", "hi")).alias("year"))


def airport_country(code: Column) -> Column:
    out = F.lit(None).cast("string")
    for name, _, _, country in AIRPORTS:
        out = F.when(code == name, country).otherwise(out)
    return out


def with_holiday(df: DataFrame, holidays: DataFrame, airport: str = "adep", ts: str = "first_seen") -> DataFrame:
    """0/1 flag of the airport's national calendar; unknown airports get 0.

    The calendar has at most (rules x years) rows, so the broadcast is bounded
    by the span of the data, not by its volume."""
    flagged = df.withColumns({"_country": airport_country(F.col(airport)), "_date": F.to_date(ts)})
    calendar = F.broadcast(holidays.select(F.col("country").alias("_country"), F.col("date").alias("_date"), F.lit(1).alias("_hit")))
    return (
        flagged.join(calendar, ["_country", "_date"], "left")
        .withColumn("is_holiday", F.coalesce("_hit", F.lit(0)).cast("bigint"))
        .drop("_country", "_date", "_hit")
    )
