"""Small inputs with answers worked out by hand."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from delaylens.functions import geo, text, weather as wx
from delaylens.functions.calendar import easter_sunday, holiday_dim
from delaylens.operators import history, metrics, profile
from delaylens.operators.rolling import fill_cold_start, trailing_windows, trailing_windows_direct
from delaylens.sources import files


def _flights(spark, rows):
    day = dt.datetime(2024, 1, 1)
    data = [(i, key, day + dt.timedelta(minutes=m), y) for i, (key, m, y) in enumerate(rows)]
    return spark.createDataFrame(data, "id int, adep string, first_seen timestamp_ntz, delayed_15min bigint")


TIES = [("A", 0, 1), ("A", 0, 1), ("A", 30, 0), ("A", 60, 1), ("A", 60, 0), ("A", 300, 1)]


@pytest.mark.parametrize("window", [trailing_windows, trailing_windows_direct])
def test_rolling_ties(spark, window):
    rows = window(_flights(spark, TIES), windows={"1h": 3600}).orderBy("id").collect()
    assert [r["traffic_1h"] for r in rows] == [0, 0, 2, 3, 3, 0]
    assert [r["delay_rate_1h"] for r in rows] == [None, None, 1.0, pytest.approx(2 / 3), pytest.approx(2 / 3), None]


@pytest.mark.parametrize("cell", [60, 3600, 86400])
def test_rolling_is_free_of_the_cell_width(spark, cell):
    rows = trailing_windows(_flights(spark, TIES), windows={"1h": 3600}, cell_seconds=cell).orderBy("id").collect()
    assert [r["traffic_1h"] for r in rows] == [0, 0, 2, 3, 3, 0]


def test_rolling_counts_labelled_rows_only(spark):
    rows = trailing_windows(_flights(spark, [("A", 0, None), ("A", 10, 1), ("A", 20, None)]), windows={"1h": 3600})
    assert [r["traffic_1h"] for r in rows.orderBy("id").collect()] == [0, 0, 1]


def test_rolling_keeps_rows_without_key_or_time(spark):
    rows = _flights(spark, [("A", 0, 1), (None, 5, 1)])
    assert trailing_windows(rows).count() == 2


def test_cold_start_policies(spark):
    rows = _flights(spark, [("A", 0, 1), ("A", 600, 0), ("B", 0, 0), ("B", 600, 0)])
    rolled = trailing_windows(rows, windows={"1h": 3600})
    by_key = fill_cold_start(rolled, windows={"1h": 3600}, history=rows).orderBy("id").collect()
    assert [r["delay_rate_1h"] for r in by_key] == [0.5, 0.5, 0.0, 0.0]
    overall = fill_cold_start(rolled, windows={"1h": 3600}, fill="global", history=rows).collect()
    assert {r["delay_rate_1h"] for r in overall} == {0.25}
    early = fill_cold_start(rolled, windows={"1h": 3600}, as_of="2024-01-01 01:00:00", history=rows).orderBy("id").collect()
    assert [r["delay_rate_1h"] for r in early] == [1.0, 1.0, 0.0, 0.0]
    with pytest.raises(ValueError):
        fill_cold_start(rolled, fill="other")


def _one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize(
    "shown, miles",
    [("10+", 10.0), ("3", 3.0), ("1/2", 0.5), ("M1/4", 0.25), ("1 1/2", None), ("1/0", None), (None, None), ("x", None), ("1d", None), ("1/2/3", None), (" 6 ", 6.0), ("", None)],
)
def test_visibility(spark, shown, miles):
    assert _one(spark, wx.parse_visibility(F.lit(shown).cast("string"))) == miles


def test_visibility_mixed_number(spark):
    assert _one(spark, wx.parse_visibility(F.lit("1 1/2"), mixed=True)) == 1.5


@pytest.mark.parametrize(
    "vis, ceil, code",
    [(0.5, 9999, 3), (9, 499, 3), (2, 5000, 2), (9, 999, 2), (4, 9999, 1), (9, 2999, 1), (5, 3000, 0)],
)
def test_category(spark, vis, ceil, code):
    for policy in ("null", "fallthrough"):
        assert _one(spark, wx.flight_category(F.lit(float(vis)), F.lit(float(ceil)), policy)) == code


def test_category_of_missing_visibility(spark):
    none, high = F.lit(None).cast("double"), F.lit(9999.0)
    assert _one(spark, wx.flight_category(none, high, "null")) is None
    assert _one(spark, wx.flight_category(none, high, "fallthrough")) == 0


def test_ceiling(spark):
    def layers(*pairs):
        return F.array(*[F.struct(F.lit(c).alias("cover"), F.lit(b).cast("double").alias("base")) for c, b in pairs])

    assert _one(spark, wx.ceiling_from_layers(layers(("FEW", 500), ("SCT", 900)))) == 12000
    assert _one(spark, wx.ceiling_from_layers(layers(("BKN", 2500), ("OVC", 800)))) == 800
    assert _one(spark, wx.ceiling_from_layers(layers(("BKN", None)))) == 12000
    assert _one(spark, wx.ceiling_from_layers(F.lit(None).cast("array<struct<cover:string,base:double>>"))) == 12000


@pytest.mark.parametrize("score, level", [(0.2499, "low"), (0.25, "medium"), (0.3999, "medium"), (0.40, "high")])
def test_risk_band_edges(spark, score, level):
    assert _one(spark, text.risk_band(F.lit(score))) == level


def test_percent_rounding_modes(spark):
    assert _one(spark, text.percent_half_even(F.lit(0.125))) == 12
    assert _one(spark, text.percent_half_up(F.lit(0.125))) == 13


@pytest.mark.parametrize(
    "feature, value, shown",
    [
        ("hour_of_day", 23, "23:00"),
        ("day_of_week", 0, "Mon"),
        ("month", 12, "Dec"),
        ("delay_rate_1h", 0.0499, "5%"),
        ("flight_category", 3, "LIFR"),
        ("is_holiday", 1, "yes"),
        ("ceiling_ft", 12000, "unlimited"),
        ("ceiling_ft", 2500, "2500.0 ft"),
        ("traffic_1h", 7, "7 aircraft"),
        ("wind_speed_10m", 12.34, "12.3 km/h"),
        ("visibility_mi", None, "n/a"),
    ],
)
def test_format_value(spark, feature, value, shown):
    number = F.lit(None if value is None else float(value)).cast("double")
    assert _one(spark, text.format_value(F.lit(feature), number)) == shown


def test_format_rate_from_rounded_value(spark):
    assert _one(spark, text.format_value(F.lit("delay_rate_1h"), F.lit(0.0499), rates_from_rounded=True)) == "0%"


def test_easter(spark):
    known = {1961: (4, 2), 2000: (4, 23), 2008: (3, 23), 2024: (3, 31), 2025: (4, 20), 2038: (4, 25)}
    years = spark.createDataFrame([(y,) for y in known], "year int")
    rows = years.select("year", easter_sunday(F.col("year")).alias("d")).collect()
    assert {r["year"]: (r["d"].month, r["d"].day) for r in rows} == known


def test_holidays_of_2022_and_2023(spark):
    dates = holiday_dim(spark.createDataFrame([(2022,), (2023,)], "year int"))
    by_country = {}
    for r in dates.collect():
        by_country.setdefault(r["country"], set()).add(str(r["date"]))
    assert {"2022-01-03", "2022-06-02", "2022-09-19", "2022-12-27", "2023-01-02", "2023-05-08", "2023-05-29"} <= by_country["GB"]
    assert "2022-05-30" not in by_country["GB"]
    assert "2023-06-08" in by_country["PL"] and "2023-06-08" not in by_country["DE"]
    assert "2022-07-14" in by_country["FR"] and "2023-04-27" in by_country["NL"]


def test_folds():
    assert [s for s, _ in metrics.fold_windows("2025-09-01", 3, 4)] == ["2024-09-01", "2024-12-01", "2025-03-01", "2025-06-01"]


def test_quiet_airport(spark):
    counts = spark.createDataFrame([("EDDF", "1h", 7200, 4), ("EHAM", "1h", 14400, 2)], "airport string, label string, window_end bigint, n bigint")
    airports = spark.createDataFrame([("EDDF",), ("EHAM",), ("EGLL",)], "airport string")

    def run(carry):
        rows = history.current_window(counts, airports, F.lit(14100), ["1h"], carry).collect()
        return {r["airport"]: r["traffic_1h"] for r in rows}

    assert run(True) == {"EDDF": 4, "EHAM": 2, "EGLL": 0}
    assert run(False) == {"EDDF": 0, "EHAM": 2, "EGLL": 0}


def test_label_threshold_is_inclusive_by_choice(spark):
    rows = spark.createDataFrame([("r", 10.0), ("r", 10.0), ("r", 25.0)], "route string, duration_min double")
    late = profile.expected_and_label(rows, ["route"]).agg(F.sum("delayed_15min")).first()[0]
    strict = profile.expected_and_label(rows, ["route"], inclusive=False).agg(F.sum("delayed_15min")).first()[0]
    assert (late, strict) == (1, 0)


def test_registry_keeps_the_first_row(spark, tmp_path):
    header = "icao24,registration,manufacturericao,manufacturername,model,typecode,operator,operatorcallsign,operatoricao,owner"
    lines = [header, "ABC,R1,ICAO,,M,,,,OPI,Own", "abc,R2,,,,,,,,", ",R3,,,,,,,,", "def,,,Maker,,T1,Op,,,"]
    (tmp_path / "r.csv").write_text("\n".join(lines))
    rows = files.load_registry(files.read_registry(spark, str(tmp_path / "r.csv"))).orderBy("icao24").collect()
    assert [tuple(r) for r in rows] == [("abc", "R1", "ICAO", "M", None, "Own"), ("def", None, "Maker", None, "T1", "Op")]


def test_null_state_list_gives_no_rows(spark):
    rows = spark.createDataFrame([('{"time": 1, "states": null}',)], "json string")
    assert files.parse_states(rows).count() == 0


def test_numeric_visibility_in_reports(spark):
    rows = spark.createDataFrame(
        [('{"icaoId":"EDDF","visib":4,"wspd":10}',), ('{"icaoId":"XXXX","visib":"3"}',)], "json string"
    )
    (report,) = files.parse_reports(rows, ["EDDF"]).collect()
    assert (report["visibility_mi"], report["ceiling_ft"], report["flight_category_label"]) == (4.0, 12000.0, "MVFR")
    assert report["wind_speed_10m"] == pytest.approx(18.52)


def test_nearest_tie_goes_to_the_first(spark):
    sites = [("X", 0.0, 0.0), ("Y", 0.0, 2.0)]
    assert _one(spark, geo.nearest_site(F.lit(0.0), F.lit(1.0), sites)) == "X"


def test_one_class_key_has_no_auc(spark):
    rows = spark.createDataFrame([("a", 0.1, 0), ("a", 0.9, 1), ("b", 0.3, 0)], "k string, s double, y int")
    result = {r["k"]: r["auc"] for r in metrics.per_key_evaluation(rows, "k", "s", "y").collect()}
    assert result == {"a": 1.0, "b": None}
