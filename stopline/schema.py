"""Declared schemas and fixed values of the traffic-stop domain.

The raw files use dotted names (`Date.time`); inside the package every column
is snake_case and renamed once, at the source (`snake_case_columns`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# ---- Fixed values: codes accepted as a plate or licence state ----
US_STATES = [
    "AL", "AK", "AZ", "AR", "CA", "CO", "CT", "DE", "FL", "GA",
    "HI", "ID", "IL", "IN", "IA", "KS", "KY", "LA", "ME", "MD",
    "MA", "MI", "MN", "MS", "MO", "MT", "NE", "NV", "NH", "NJ",
    "NM", "NY", "NC", "ND", "OH", "OK", "OR", "PA", "RI", "SC",
    "SD", "TN", "TX", "UT", "VT", "VA", "WA", "WV", "WI", "WY",
]
OTHER_CODES = [
    "AB", "BC", "MB", "NB", "NL", "NS", "NT", "NU", "ON", "QC",
    "SK", "YT", "DC", "AS", "GU", "PR", "VI", "US", "XX",
]
HOME_REGION = ["MD", "DC", "VA"]

# Fixed values: (plate state, licence state) pairs that are typing errors
CONTRADICTORY_STATES = [("MB", "MD"), ("NB", "NJ"), ("NB", "NY"), ("PA", "NJ")]

# Vehicle types that must carry a model year
TYPES_NEEDING_YEAR = ["02 - Automobile", "03 - Station Wagon", "05 - Light Duty Truck"]

# Limits used when cleaning, and the wider ones used when scoring
LAT_CLEAN = (38.90, 39.33)
LON_CLEAN = (-77.52, -76.88)
YEAR_CLEAN = (1925, 2020)
LAT_SCORE = (38.90, 39.50)
LON_SCORE = (-77.52, -76.88)
YEAR_SCORE = (1929, 2020)

# Wording that marks a pedestrian offence
PEDESTRIAN_PHRASES = ["PEDESTRIAN FAILURE", "PEDESTRIAN CROSS", "PEDESTRIAN UNSAFELY"]

# Road names and numbers searched in the location text
HIGHWAYS = ["270", "495"]
MAJOR_ROADS = [
    "270", "495", "OLD GEORGETOWN", "187", "355", "WISCONSIN",
    "200", "29", "190", "191", "188", "410", "185", "390",
    "97", "193", "586", "193", "VEIRS MILL", "GEORGIA", "112",
    "28", "200", "27", "320", "650", "500", "UNIVERSITY",
    "CONNECTICUT", "NEW HAMPSHIRE", "RIVER RD", "BRADLEY BLVD", "WILSON LN",
    "16TH", "QUEENS CHAPEL", "RIDGE RD", "PINEY BRANCH",
]
# Entries that never match in the original pattern, because a
# line break and blanks precede them there
UNREACHED_ROADS = ["97", "28", "CONNECTICUT", "16TH"]

# Level groups used by the clustering frame
CAR_TYPES = ["02 - Automobile", "03 - Station Wagon", "05 - Light Duty Truck"]
NON_CAR_TYPES = [
    "27 - Farm Equipment", "28 - Other", "29 - Unknown", "09 - Farm Vehicle",
    "08 - Recreational Vehicle", "10 - Transit Bus", "12 - School Bus",
    "11 - Cross Country Bus", "04 - Limousine", "26 - Boat Trailer",
    "23 - Travel/Home Trailer", "25 - Utility Trailer", "21 - Tandem Trailer",
    "07 - Truck/Road Tractor", "24 - Camper", "22 - Mobile Home",
    "20 - Commercial Rig", "13 - Ambulance(Emerg)", "14 - Ambulance(Non-Emerg)",
    "17 - Police(Emerg)", "18 - Police(Non-Emerg)", "15 - Fire(Emerg)",
    "01 - Motorcycle", "19 - Moped", "06 - Heavy Duty Truck",
]
NEUTRAL_COLORS = [
    "BEIGE", "BLACK", "BROWN", "WHITE", "TAN",
    "GRAY", "SILVER", "BRONZE", "CREAM", "COPPER",
]
OTHER_COLORS = [
    "RED", "YELLOW", "ORANGE", "GOLD", "MAROON", "BLUE, LIGHT", "GREEN, LGT",
    "PINK", "PURPLE", "BLUE, DARK", "BLUE", "GREEN", "GREEN, DK", "CAMOUFLAGE",
    "CHROME", "MULTICOLOR", "N/A",
]
CLOUDED_CONDITIONS = [
    "Rain, Clear", "Partially cloudy", "Overcast", "Rain, Overcast", "Rain, Partially cloudy",
]
MERGED_RACES = ["OTHER", "NATIVE AMERICAN", "ASIAN"]

# Rare levels removed before the regressions
RARE_COLORS = ["CAMOUFLAGE", "CHROME"]
RARE_ASSETS = ["K - Aircraft Assist"]
RARE_CHARGES = [
    "10-3", "10-4", "11-8", "12-3", "13-2", "13-5", "15-1", "15-3", "16-2", "18-1",
    "22-3", "23-3", "23-4", "24-2", "24-4", "26-1", "26-2", "26-3", "27-1",
]
RARE_VEHICLES = [
    "09 - Farm Vehicle", "11 - Cross Country Bus", "13 - Ambulance(Emerg)",
    "14 - Ambulance(Non-Emerg)", "15 - Fire(Emerg)", "17 - Police(Emerg)",
    "18 - Police(Non-Emerg)", "21 - Tandem Trailer", "22 - Mobile Home",
    "23 - Travel/Home Trailer", "24 - Camper", "26 - Boat Trailer", "27 - Farm Equipment",
]

# Factors tabulated one by one against the response
RATE_FACTORS = [
    "sub_agency", "conditions", "accident", "belts", "personal_injury",
    "property_damage", "fatal", "commercial_license", "hazmat", "alcohol",
    "work_zone", "search_conducted", "contributed_to_accident", "search_disposition",
    "vehicle_type", "race", "gender", "asset_type", "highway", "major_road",
    "dl_state_group", "veh_state_group", "multi_infr",
]

# Columns left out of the models
MODEL_DROP = [
    "seq_id", "date_time", "description", "location", "latitude", "longitude",
    "maximum_temperature", "minimum_temperature", "wind_chill", "heat_index",
    "snow_depth", "wind_gust", "state", "make", "model", "charge", "article",
    "driver_city", "driver_state", "dl_state", "arrest_reason", "search_type",
    "search_reason", "search_disposition", "high_heat", "ex_cold", "geohash",
]
WEAK_FLAGS = [
    "fatal", "hazmat", "commercial_vehicle", "work_zone", "alcohol", "contributed_to_accident",
]
LASSO_SECOND_DROP = ["color", "dl_state_group", "conditions", "major_road"]
SUBSET_FEATURES = [
    "accident", "personal_injury", "property_damage", "search_conducted",
    "vehicle_type", "color", "race", "gender", "arrest", "asset_type",
    "highway", "short_charge", "veh_state_group", "multi_infr",
]

# Columns of the clustering frame
CLUSTER_COLUMNS = [
    "personal_injury", "belts", "alcohol", "conditions", "vehicle_type",
    "color", "race", "gender", "dow", "hour",
]

WEATHER_NUMBERS = [
    "maximum_temperature", "minimum_temperature", "temperature", "wind_chill",
    "heat_index", "precipitation", "snow_depth", "wind_speed", "wind_gust",
    "cloud_cover", "relative_humidity",
]
STOP_FLAGS = [
    "accident", "belts", "personal_injury", "property_damage", "fatal",
    "commercial_license", "hazmat", "commercial_vehicle", "alcohol", "work_zone",
]


def _fields(names, dtype):
    return [T.StructField(n, dtype, True) for n in names]


WEATHER_SCHEMA = T.StructType(
    _fields(["address", "date_time", "location", "resolved_address"], T.StringType())
    + _fields(WEATHER_NUMBERS, T.DoubleType())
    + _fields(["conditions"], T.StringType())
)

STOPS_RAW_SCHEMA = T.StructType(
    _fields(["x"], T.IntegerType())
    + _fields(["seq_id", "date_of_stop", "time_of_stop", "agency", "sub_agency",
               "description", "location"], T.StringType())
    + _fields(["latitude", "longitude"], T.DoubleType())
    + _fields(STOP_FLAGS, T.StringType())
    + _fields(["search_conducted", "search_disposition", "search_outcome", "search_reason",
               "search_reason_for_stop", "search_type", "search_arrest_reason",
               "state", "vehicle_type", "year", "make", "model", "color",
               "violation_type", "charge", "article", "contributed_to_accident",
               "race", "gender", "driver_city", "driver_state", "dl_state",
               "arrest_type", "geolocation"], T.StringType())
)

CLEAN_COLUMNS = (
    ["date_time", "seq_id", "sub_agency", "description", "location", "latitude", "longitude"]
    + WEATHER_NUMBERS + ["conditions"] + STOP_FLAGS
    + ["search_conducted", "search_disposition", "search_type", "search_reason",
       "state", "vehicle_type", "year", "make", "model", "color",
       "violation_type", "charge", "article", "contributed_to_accident",
       "race", "gender", "driver_city", "driver_state", "dl_state",
       "arrest", "arrest_reason", "asset_type"]
)


def extend_values(base: list, *extra) -> list:
    """A longer list of literals; the inputs stay as they are."""
    return list(base) + [v for more in extra for v in more]


STATE_CODES = extend_values(US_STATES, OTHER_CODES)


def snake_case_columns(df: DataFrame) -> DataFrame:
    """Rename `Date.time`, `DL.State`, `VehicleType` … to the package's names."""
    import re

    def snake(name: str) -> str:
        name = re.sub(r"(?<=[a-z])(?=[A-Z])", "_", name.replace(".", "_"))
        return name.lower()

    return df.toDF(*[snake(c) for c in df.columns])
