"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from delaylens.operators import profile
from delaylens.operators.joins import hourly_lookup_join, keep_first
from delaylens.operators.rolling import key_rates
from delaylens.plans.catalog import query
from delaylens.plans.testdata import (
    NATION_SCOPE,
    SCOPE,
    SCOPE_SQL,
    flights,

    registry_rows,
    route_facts,

    weather,
    with_cte,
)
from delaylens.sources.files import either_end, hourly_observations

_NATIONS = ", ".join(str(n) for n in NATION_SCOPE)


@query("mean_per_key", with_cte("flights", "SELECT adep, round(avg(delayed_15min), 6) AS mean_rate FROM flights GROUP BY adep"))
def mean_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return key_rates(flights(spark, sf_dir)).withColumn("mean_rate", F.round("mean_rate", 6))


@query(
    "hourly_collapse",
    with_cte(
        "flights",
        "SELECT airport, hour, round(visibility_mi, 6) AS visibility_mi, ceiling_ft, CAST(CASE WHEN visibility_mi < 1 OR ceiling_ft < 500 THEN 3 "
        "WHEN visibility_mi < 3 OR ceiling_ft < 1000 THEN 2 WHEN visibility_mi < 5 OR ceiling_ft < 3000 THEN 1 ELSE 0 END AS DOUBLE) AS flight_category "
        "FROM (SELECT adep AS airport, strftime(first_seen, '%Y-%m-%dT%H:00') AS hour, sum(CASE WHEN k % 7 <> 0 THEN k END) / "
        "count(CASE WHEN k % 7 <> 0 THEN 1 END) / 8 AS visibility_mi, min(CASE WHEN k % 3 = 0 THEN CAST(value * 40 AS DOUBLE) ELSE 12000 END) AS ceiling_ft "
        "FROM flights GROUP BY 1, 2) m",
    ),
)
def hourly_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean visibility, lowest ceiling and category per airport and hour."""
    none, k = F.lit(None), F.col("k")
    observations = flights(spark, sf_dir).select(
        F.col("adep").alias("airport"),
        F.col("first_seen").alias("valid"),
        F.when(k % 7 != 0, k / 8).alias("vsby"),
        F.when(k % 3 == 0, "OVC").otherwise("FEW").alias("skyc1"),
        (F.col("value") * 40).alias("skyl1"),
        *[none.cast("string").alias(f"skyc{i}") for i in (2, 3, 4)],
        *[none.cast("double").alias(f"skyl{i}") for i in (2, 3, 4)],
    )
    return hourly_observations(observations).withColumn("visibility_mi", F.round("visibility_mi", 6))


@query("group_sizes", with_cte("flights", "SELECT adep, count(*) AS n FROM flights GROUP BY adep"))
def group_sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.value_counts(flights(spark, sf_dir), "adep")


@query(
    "value_counts",
    with_cte(
        "flights",
        "SELECT 'share' AS kind, typecode, count(*) AS n, round(count(*) / (SELECT count(typecode) FROM flights), 6) AS share "
        "FROM flights WHERE typecode IS NOT NULL GROUP BY typecode UNION ALL "
        "SELECT 'with nulls', typecode, count(*), NULL FROM flights GROUP BY typecode",
    ),
)
def value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = flights(spark, sf_dir)
    shares = profile.value_counts(rows, "typecode", normalise=True).withColumn("share", F.round("share", 6))
    counts = profile.value_counts(rows, "typecode", dropna=False).withColumn("share", F.lit(None).cast("double"))
    columns = ["kind", "typecode", "n", "share"]
    return shares.withColumn("kind", F.lit("share")).select(columns).unionByName(
        counts.withColumn("kind", F.lit("with nulls")).select(columns)
    )


@query(
    "rate_by_key",
    with_cte("flights", "SELECT adep, round(avg(delayed_15min), 6) AS mean, count(delayed_15min) AS count FROM flights GROUP BY adep"),
)
def rate_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.rate_by_key(flights(spark, sf_dir), "adep", "delayed_15min")
    return rows.withColumn("mean", F.round("mean", 6)).orderBy(F.col("mean").desc(), "adep")


_DESCRIBED = {"value": 10.0, "k": 10.0, "delay_min": 10.0, "delayed_15min": 1.0}


@query(
    "describe",
    with_cte(
        "flights",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", count({c}) AS count, round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, "
            f"min({c})::DOUBLE AS min, quantile_cont({c}::DOUBLE, 0.25) AS p25, median({c}::DOUBLE) AS p50, "
            f"quantile_cont({c}::DOUBLE, 0.75) AS p75, max({c})::DOUBLE AS max FROM flights"
            for c in _DESCRIBED
        ),
    ),
)
def describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.summary_statistics(flights(spark, sf_dir), list(_DESCRIBED))
    return rows.withColumns({c: F.round(c, 6) for c in ("mean", "std")})


@query(
    "missing_profile",
    with_cte(
        "flights weather",
        "SELECT c AS \"column\", CAST(sum(m) AS BIGINT) AS n_missing, round(avg(m), 6) AS share_missing FROM (SELECT unnest(['typecode', "
        "'temperature_2m', 'adep']) AS c, unnest([CAST(typecode IS NULL AS INT), CAST(temperature_2m IS NULL AS INT), 0]) AS m "
        "FROM flights f LEFT JOIN weather w ON f.adep = w.airport AND strftime(first_seen, '%Y-%m-%dT%H:00') = w.time) x GROUP BY c",
    ),
)
def missing_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    joined = hourly_lookup_join(flights(spark, sf_dir), weather(spark, sf_dir), ["temperature_2m"], lookup_hour="time")
    rows = profile.missing_profile(joined, ["typecode", "temperature_2m", "adep"])
    return rows.withColumn("share_missing", F.round("share_missing", 6))


@query(
    "corr_target",
    with_cte(
        "flights",
        " UNION ALL ".join(
            f"SELECT '{c}' AS \"column\", round(corr({c}, delayed_15min), 6) AS correlation FROM flights" for c in ("value", "k", "user_id")
        ),
    ),
)
def corr_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.correlation_with_target(flights(spark, sf_dir), ["value", "k", "user_id"], "delayed_15min")
    return rows.withColumn("correlation", F.round("correlation", 6)).orderBy(F.abs("correlation").desc())


@query(
    "either_role_counts",
    with_cte(
        "flights airports",
        "SELECT airport, count(*) AS n FROM flights JOIN airports ON adep = airport OR ades = airport GROUP BY airport",
    ),
)
def either_role_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.either_role_counts(flights(spark, sf_dir), SCOPE)


@query(
    "monthly_counts",
    "SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) AS n FROM orders GROUP BY 1",
)
def monthly_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.monthly_counts(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")


@query(
    "date_span",
    "SELECT epoch_us(min(o_orderdate)) AS first_us, epoch_us(max(o_orderdate)) AS last_us FROM orders",
)
def date_span(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = profile.date_span(spark.read.parquet(f"{sf_dir}/orders.parquet"), "o_orderdate")
    return span.select(*[F.unix_micros(F.col(c).cast("timestamp")).alias(f"{c}_us") for c in ("first", "last")])


@query(
    "match_ratio",
    with_cte(
        "flights",
        "SELECT count(*) AS total, count(*) FILTER (m) AS matched, round(100.0 * count(*) FILTER (m) / count(*), 6)::DOUBLE AS percent "
        f"FROM (SELECT adep IN ({SCOPE_SQL}) OR ades IN ({SCOPE_SQL}) AS m FROM flights) f",
    ),
)
def match_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.match_ratio(flights(spark, sf_dir), either_end(SCOPE))
    return rows.withColumn("percent", F.round("percent", 6))


@query(
    "route_edges",
    with_cte(
        "flights airports",
        f"SELECT airport AS src, dst, coalesce(weight, 0) AS weight FROM airports LEFT JOIN (SELECT adep, ades AS dst, count(*) AS weight "
        f"FROM flights WHERE adep IN ({SCOPE_SQL}) AND ades IN ({SCOPE_SQL}) GROUP BY 1, 2) e ON airport = adep",
    ),
)
def route_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    return profile.route_edges(flights(spark, sf_dir), SCOPE)


@query(
    "other_end_topk",
    with_cte(
        "route_facts",
        "SELECT CASE WHEN a THEN ades ELSE adep END AS airport, count(*) AS n FROM (SELECT adep, ades, "
        f"adep IN ({_NATIONS}) AS a, ades IN ({_NATIONS}) AS b FROM route_facts) f WHERE a <> b GROUP BY 1 ORDER BY n DESC, airport LIMIT 15",
    ),
)
def other_end_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 15 busiest partners outside the scope (a top-k report)."""
    return profile.top_other_ends(route_facts(spark, sf_dir), NATION_SCOPE)


_EXPECTED = (
    "(SELECT l_orderkey, l_linenumber, adep, ades, duration_min, median(duration_min) OVER (PARTITION BY adep, ades, month) AS m "
    "FROM route_facts) f"
)


@query(
    "expected_and_label",
    with_cte(
        "route_facts",
        "SELECT l_orderkey, l_linenumber, m AS expected_duration_min, duration_min - m AS delay_min, "
        f"CAST(duration_min - m >= 15 AS BIGINT) AS delayed_15min FROM {_EXPECTED}",
    ),
)
def expected_and_label(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Median duration of the route and month, delay against it, label."""
    rows = profile.expected_and_label(route_facts(spark, sf_dir), ["adep", "ades", "month"])
    return rows.select("l_orderkey", "l_linenumber", "expected_duration_min", "delay_min", "delayed_15min")


@query(
    "histogram_clip",
    with_cte(
        "flights",
        "SELECT bin, (-30 + bin * 2.5)::DOUBLE AS lower, count(b) AS n, -30 + bin * 2.5 >= 15 AS above_cut FROM range(60) r(bin) LEFT JOIN "
        "(SELECT least(59, CAST(floor((greatest(-30, least(120, delay_min)) + 30) / 2.5::DOUBLE) AS BIGINT)) AS b FROM flights) f "
        "ON b = bin GROUP BY bin",
    ),
)
def histogram_clip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delay clipped to [-30, 120] in 60 bins, empty ones kept."""
    return profile.histogram(flights(spark, sf_dir), "delay_min", -30.0, 120.0, 60, cut=15.0)


@query(
    "pos_weight",
    with_cte(
        "flights",
        "SELECT count(*) FILTER (delayed_15min = 0) AS n_negative, count(*) FILTER (delayed_15min = 1) AS n_positive, "
        "round(count(*) FILTER (delayed_15min = 0) * 0.5::DOUBLE / count(*) FILTER (delayed_15min = 1), 6) AS positive_weight FROM flights",
    ),
)
def pos_weight(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = profile.class_balance(flights(spark, sf_dir), "delayed_15min", multiplier=0.5)
    return rows.withColumn("positive_weight", F.round("positive_weight", 6))


@query(
    "rate_with_default",
    with_cte(
        "flights",
        "SELECT airport AS adep, round(coalesce(rate, (SELECT avg(r) FROM (SELECT avg(delayed_15min) AS r FROM flights GROUP BY adep) z)), 6) "
        "AS rate FROM (SELECT DISTINCT ades AS airport FROM flights) w LEFT JOIN (SELECT adep, avg(delayed_15min) AS rate FROM flights "
        "GROUP BY adep) q ON airport = adep",
    ),
)
def rate_with_default(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean label of every destination; those never departed from get the mean
    of the rates."""
    rows = flights(spark, sf_dir)
    wanted = rows.select(F.col("ades").alias("adep")).distinct()
    return profile.rates_with_default(rows, wanted).withColumn("rate", F.round("rate", 6))


@query(
    "distinct_pairs",
    with_cte("flights", "SELECT DISTINCT adep, icao24 FROM flights"),
)
def distinct_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flights(spark, sf_dir).select("adep", "icao24").distinct()


@query(
    "dedup_first",
    with_cte(
        "registry_rows",
        "SELECT icao24, registration, p_partkey FROM (SELECT *, row_number() OVER (PARTITION BY icao24 ORDER BY p_partkey) AS rn "
        "FROM registry_rows) r WHERE rn = 1",
    ),
)
def dedup_first(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First row per id in source order."""
    return keep_first(registry_rows(spark, sf_dir).select("icao24", "registration", "p_partkey"), ["icao24"], ["p_partkey"])
