"""Fixed values of the analysis: codes, thresholds, names and column orders."""

from __future__ import annotations

# --- fixed values -----------------------------------------------------------
# (ICAO code, latitude, longitude, ISO country); the order is the display
# order and breaks every tie.
AIRPORTS = [
    ("EDDF", 50.0379, 8.5622, "DE"),
    ("EPWA", 52.1657, 20.9671, "PL"),
    ("EGLL", 51.4700, -0.4543, "GB"),
    ("LFPG", 49.0097, 2.5479, "FR"),
    ("EHAM", 52.3086, 4.7639, "NL"),
    ("EDDM", 48.3538, 11.7861, "DE"),
    ("EPGD", 54.3776, 18.4662, "PL"),
]
AIRPORT_CODES = [a[0] for a in AIRPORTS]

TRAFFIC_WINDOWS = {"1h": 3600, "3h": 10800}  # label -> seconds
SLIDE_SECONDS = 300
SNAPSHOT_SECONDS = 90
MATCH_RADIUS_DEG = 0.5
BBOX_MARGIN_DEG = 2.0
METRES_PER_DEGREE = 111_320.0
POSITION_HISTORY = 300
PREDICTION_HISTORY = 120
TRACK_LENGTH = 15

DELAY_THRESHOLD_MIN = 15.0
UNLIMITED_CEILING_FT = 12_000.0
CEILING_COVERS = ["BKN", "OVC", "VV"]
FLIGHT_CATEGORIES = ["VFR", "MVFR", "IFR", "LIFR"]
# (code, visibility below, ceiling below), worst first
CATEGORY_LIMITS = [(3, 1.0, 500.0), (2, 3.0, 1000.0), (1, 5.0, 3000.0)]

RISK_LOW_BELOW = 0.25
RISK_MEDIUM_BELOW = 0.40

KMH_PER_KNOT = 1.852
KMH_PER_MPS = 3.6

DAY_NAMES = ["Mon", "Tue", "Wed", "Thu", "Fri", "Sat", "Sun"]
MONTH_NAMES = ["Jan", "Feb", "Mar", "Apr", "May", "Jun", "Jul", "Aug", "Sep", "Oct", "Nov", "Dec"]

# names of the warehouse's helper tables, 1..7 and 1..12
DAY_HELPER = ["Poniedziałek", "Wtorek", "Środa", "Czwartek", "Piątek", "Sobota", "Niedziela"]
MONTH_HELPER = [
    "Styczeń",
    "Luty",
    "Marzec",
    "Kwiecień",
    "Maj",
    "Czerwiec",
    "Lipiec",
    "Sierpień",
    "Wrzesień",
    "Październik",
    "Listopad",
    "Grudzień",
]

STATE_FIELDS = [
    ("icao24", "string"),
    ("callsign", "string"),
    ("origin_country", "string"),
    ("time_position", "bigint"),
    ("last_contact", "bigint"),
    ("longitude", "double"),
    ("latitude", "double"),
    ("baro_altitude", "double"),
    ("on_ground", "boolean"),
    ("velocity", "double"),
    ("true_track", "double"),
    ("vertical_rate", "double"),
    ("sensors", "string"),
    ("geo_altitude", "double"),
    ("squawk", "string"),
    ("spi", "boolean"),
    ("position_source", "bigint"),
]

REGISTRY_COLUMNS = [
    "icao24",
    "registration",
    "manufacturericao",
    "manufacturername",
    "model",
    "typecode",
    "operator",
    "operatorcallsign",
    "operatoricao",
    "owner",
]

FLIGHT_COLUMNS = [
    "icao24",
    "flt_id",
    "adep",
    "ades",
    "first_seen",
    "typecode",
    "icao_operator",
    "duration_min",
    "expected_duration_min",
    "delay_min",
    "delayed_15min",
    "route",
]

# (name, Spark type); feature rows insert the rolling columns before typecode
EXTRACTED_SCHEMA = [
    ("adep", "string"),
    ("first_seen", "timestamp_ntz"),
    ("hour_of_day", "bigint"),
    ("day_of_week", "bigint"),
    ("month", "bigint"),
    ("is_weekend", "bigint"),
    ("is_holiday", "bigint"),
    ("temperature_2m", "double"),
    ("precipitation", "double"),
    ("wind_speed_10m", "double"),
    ("visibility_mi", "double"),
    ("ceiling_ft", "double"),
    ("flight_category", "double"),
    ("typecode", "string"),
    ("delayed_15min", "bigint"),
]
ROLLING_COLUMNS = ["traffic_1h", "traffic_3h", "delay_rate_1h", "delay_rate_3h"]
FEATURE_SCHEMA = EXTRACTED_SCHEMA[:13] + [(c, "double") for c in ROLLING_COLUMNS] + EXTRACTED_SCHEMA[13:]

FEATURE_COLUMNS = [
    "adep",
    "hour_of_day",
    "day_of_week",
    "month",
    "is_weekend",
    "is_holiday",
    "temperature_2m",
    "precipitation",
    "wind_speed_10m",
    "visibility_mi",
    "ceiling_ft",
    "flight_category",
    "traffic_1h",
    "traffic_3h",
    "delay_rate_1h",
    "delay_rate_3h",
    "typecode",
]
CATEGORICAL_COLUMNS = ["adep", "typecode"]
TARGET_COLUMN = "delayed_15min"

FEATURE_LABELS = {
    "traffic_1h": "traffic in the last hour",
    "traffic_3h": "traffic in the last 3 hours",
    "wind_speed_10m": "wind speed",
    "precipitation": "precipitation",
    "temperature_2m": "temperature",
    "hour_of_day": "time of day",
    "day_of_week": "day of week",
    "month": "time of year",
    "is_weekend": "weekend/weekday",
    "is_holiday": "public holiday",
    "visibility_mi": "visibility",
    "ceiling_ft": "cloud ceiling",
    "flight_category": "flight category",
    "delay_rate_1h": "recent delay rate",
    "delay_rate_3h": "recent delay rate",
    "adep": "airport baseline",
    "typecode": "aircraft type",
}

# walk-forward search: candidate settings and protocol
TEST_CUTOFF = "2025-09-01"
N_FOLDS = 4
FOLD_MONTHS = 3
BOOST_ROUNDS = 500
EARLY_STOPPING_ROUNDS = 30
SEARCH_SPACE = [
    {"num_leaves": 31, "learning_rate": 0.05, "min_data_in_leaf": 100, "pos_weight_mult": 1.0},
    {"num_leaves": 63, "learning_rate": 0.05, "min_data_in_leaf": 100, "pos_weight_mult": 1.0},
    {"num_leaves": 15, "learning_rate": 0.05, "min_data_in_leaf": 300, "pos_weight_mult": 1.0},
    {"num_leaves": 31, "learning_rate": 0.05, "min_data_in_leaf": 100, "pos_weight_mult": 0.5},
]

# KPI status limits
KPI_GOOD = 0.90
KPI_WARNING = 0.85
# --- end of fixed values ----------------------------------------------------

# Our own choices where no definition is given (cut points, season and
# time-of-day names); each band is (name, lower bound inclusive).
DISTANCE_BANDS = [("short", None), ("medium", 800.0), ("long", 2000.0)]
TEMPERATURE_BANDS = [("freezing", None), ("cold", 0.0), ("mild", 10.0), ("warm", 20.0), ("hot", 30.0)]
HUMIDITY_BANDS = [("dry", None), ("moderate", 40.0), ("humid", 70.0)]
VISIBILITY_BANDS = [("very low", None), ("low", 1.0), ("medium", 3.0), ("high", 5.0)]
WIND_BANDS = [("calm", None), ("breeze", 10.0), ("strong", 25.0), ("storm", 40.0)]
PRESSURE_BANDS = [("low", None), ("normal", 1000.0), ("high", 1020.0)]
SKY_GROUPS = {"CLR": "clear", "FEW": "clear", "SCT": "partly", "BKN": "cloudy", "OVC": "cloudy", "VV": "obscured"}
CONDITION_GROUPS = {"RA": "rain", "DZ": "rain", "SN": "snow", "FG": "fog", "BR": "fog", "TS": "storm"}
SEASONS = ["winter", "spring", "summer", "autumn"]  # from December
TIME_OF_DAY = [("night", None), ("morning", 6), ("afternoon", 12), ("evening", 18)]
