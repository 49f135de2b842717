"""Vocabularies that must equal the source data's own codes and names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# fixed values: measure codes of the hourly balancing-authority data
MEASURES = {
    "NG": "Net Generation",
    "ID": "Net Interchange",
    "DF": "Demand Forecast",
    "D": "Demand",
    "TI": "Total Interchange",
}

# fixed values: generation by fuel; stored under the prefix "NG-"
GENERATION = {
    "COL": "Generation - Coal",
    "WAT": "Generation - Hydro",
    "NG": "Generation - Natural Gas",
    "NUC": "Generation - Nuclear",
    "OIL": "Generation - Oil",
    "OTH": "Generation - Other",
    "SUN": "Generation - Solar",
    "TOT": "Generation - Total",
    "WND": "Generation - Wind",
}

# fixed values: regions outside the reporting authorities
EXTRA_REGIONS = {"CAN": "Canada (region)", "MEX": "Mexico (region)"}

# fixed values: weather measures in id order
ISD_MEASURES = ["time", "temp", "dew_temp", "pressure", "wind_dir", "wind_spd", "cloud_cov",
                "precip_1hr", "precip_6hr"]
ISD_LOADED = ["temp", "wind_spd", "precip_1hr"]
ISD_FIELDS = ["year", "month", "day", "hour"] + ISD_MEASURES[1:]
ISD_MISSING = [-999, -9999]

# fixed values: years with station files
ISD_YEARS = list(range(2015, 2024))

# fixed values: forecast file prefixes per variable, and the first day in the archive
FORECAST_PREFIX = {"temp": "YEU", "wdir": "YBU", "wspd": "YCU", "sky": "YAU"}
FORECAST_LEVEL = "Z98"
FORECAST_START = "2020-04-16"

# fixed values: state -> power region
STATE_REGION = {
    "AL": "Southeast", "AK": "AK", "AZ": "Southwest", "AR": "Midwest", "CA": "California",
    "CO": "Northwest", "CT": "Northeast", "DE": "Northeast", "FL": "Florida", "GA": "Southeast",
    "HI": "HI", "ID": "Northwest", "IL": "Midwest", "IN": "Midwest", "IA": "Midwest",
    "KS": "Central", "KY": "Mid-Atlantic", "LA": "Midwest", "ME": "Northeast", "MD": "Mid-Atlantic",
    "MA": "Northeast", "MI": "Midwest", "MN": "Midwest", "MS": "Midwest", "MO": "Midwest",
    "MT": "Northwest", "NE": "Central", "NV": "Southwest", "NH": "Northeast", "NJ": "Mid-Atlantic",
    "NM": "Southwest", "NY": "New York", "NC": "Carolinas", "ND": "Central", "OH": "Mid-Atlantic",
    "OK": "Central", "OR": "Northwest", "PA": "Mid-Atlantic", "RI": "Northeast", "SC": "Carolinas",
    "SD": "Central", "TN": "Tennessee", "TX": "Texas", "UT": "Northwest", "VT": "New England",
    "VA": "Mid-Atlantic", "WA": "Northwest", "WV": "Mid-Atlantic", "WI": "Midwest", "WY": "Northwest",
}

# fixed values: state abbreviation -> (name, people per square mile)
STATES = {
    "NJ": ("New Jersey", 438.00), "RI": ("Rhode Island", 387.35), "MA": ("Massachusetts", 312.68),
    "CT": ("Connecticut", 271.40), "MD": ("Maryland", 209.23), "NY": ("New York", 155.18),
    "DE": ("Delaware", 154.87), "FL": ("Florida", 114.43), "OH": ("Ohio", 107.05),
    "PA": ("Pennsylvania", 105.80), "IL": ("Illinois", 86.27), "CA": ("California", 83.85),
    "HI": ("Hawaii", 72.83), "VA": ("Virginia", 69.03), "MI": ("Michigan", 67.55),
    "IN": ("Indiana", 65.46), "NC": ("North Carolina", 63.80), "GA": ("Georgia", 54.59),
    "TN": ("Tennessee", 53.29), "NH": ("New Hampshire", 53.20), "SC": ("South Carolina", 51.45),
    "LA": ("Louisiana", 39.61), "KY": ("Kentucky", 39.28), "WI": ("Wisconsin", 38.13),
    "WA": ("Washington", 34.20), "AL": ("Alabama", 33.84), "MO": ("Missouri", 31.36),
    "TX": ("Texas", 30.75), "WV": ("West Virginia", 29.00), "VT": ("Vermont", 25.41),
    "MN": ("Minnesota", 23.86), "MS": ("Mississippi", 23.42), "IA": ("Iowa", 20.22),
    "AR": ("Arkansas", 19.82), "OK": ("Oklahoma", 19.40), "AZ": ("Arizona", 17.43),
    "CO": ("Colorado", 16.01), "ME": ("Maine", 15.95), "OR": ("Oregon", 13.76),
    "KS": ("Kansas", 12.69), "UT": ("Utah", 10.50), "NE": ("Nebraska", 8.60),
    "NV": ("Nevada", 7.03), "ID": ("Idaho", 6.04), "NM": ("New Mexico", 5.79),
    "SD": ("South Dakota", 3.84), "ND": ("North Dakota", 3.59), "MT": ("Montana", 2.39),
    "WY": ("Wyoming", 1.96), "AK": ("Alaska", 0.42),
}

# fixed values: three biggest cities per state; the codes CN, KA and VI are the source list's own
STATE_CITIES = {
    "AL": ["Birmingham", "Mobile", "Huntsville"], "AK": ["Anchorage", "Fairbanks", "Juneau"],
    "AZ": ["Phoenix", "Tucson", "Mesa"], "AR": ["Little Rock", "Fort Smith", "Fayetteville"],
    "CA": ["Los Angeles", "San Diego", "San Jose"], "CO": ["Denver", "Colorado Springs", "Aurora"],
    "CN": ["Bridgeport", "New Haven", "Hartford"], "DE": ["Wilmington", "Dover", "Newark"],
    "FL": ["Jacksonville", "Miami", "Tampa"], "GA": ["Atlanta", "Augusta", "Columbus"],
    "HI": ["Honolulu", "Hilo", "Kailua"], "ID": ["Boise", "Nampa", "Idaho Falls"],
    "IL": ["Chicago", "Aurora", "Rockford"], "IN": ["Indianapolis", "Fort Wayne", "Evansville"],
    "IA": ["Des Moines", "Cedar Rapids", "Davenport"], "KA": ["Wichita", "Overland Park", "Kansas City"],
    "KY": ["Louisville", "Lexington", "Owensboro"], "LA": ["New Orleans", "Shreveport", "Baton Rouge"],
    "ME": ["Portland", "Lewiston", "Bangor"], "MD": ["Baltimore", "Frederick", "Gaithersburg"],
    "MA": ["Boston", "Worcester", "Springfield"], "MI": ["Detroit", "Grand Rapids", "Warren"],
    "MN": ["Minneapolis", "Saint Paul", "Rochester"], "MS": ["Jackson", "Gulfport", "Biloxi"],
    "MO": ["Kansas City", "Saint Louis", "Springfield"], "MT": ["Billings", "Missoula", "Great Falls"],
    "NE": ["Omaha", "Lincoln", "Bellevue"], "NV": ["Las Vegas", "Reno", "Henderson"],
    "NH": ["Manchester", "Nashua", "Concord"], "NJ": ["Newark", "Jersey City", "Paterson"],
    "NM": ["Albuquerque", "Las Cruces", "Rio Rancho"], "NY": ["New York City", "Buffalo", "Rochester"],
    "NC": ["Charlotte", "Raleigh", "Greensboro"], "ND": ["Fargo", "Bismarck", "Grand Forks"],
    "OH": ["Columbus", "Cleveland", "Cincinnati"], "OK": ["Oklahoma City", "Tulsa", "Norman"],
    "OR": ["Portland", "Salem", "Eugene"], "PA": ["Philadelphia", "Pittsburgh", "Allentown"],
    "RI": ["Providence", "Warwick", "Cranston"], "SC": ["Charleston", "Columbia", "North Charleston"],
    "SD": ["Sioux Falls", "Rapid City", "Aberdeen"], "TN": ["Memphis", "Nashville", "Knoxville"],
    "TX": ["Houston", "San Antonio", "Dallas"], "UT": ["Salt Lake City", "West Valley City", "Provo"],
    "VT": ["Burlington", "South Burlington", "Rutland"], "VI": ["Virginia Beach", "Norfolk", "Chesapeake"],
    "WA": ["Seattle", "Spokane", "Tacoma"], "WV": ["Charleston", "Huntington", "Parkersburg"],
    "WI": ["Milwaukee", "Madison", "Green Bay"], "WY": ["Cheyenne", "Casper", "Laramie"],
}


def measure_names() -> dict[str, str]:
    """Abbreviation -> full name as stored in the measure dimension (fuel codes carry the NG- prefix)."""
    return MEASURES | {f"NG-{code}": name for code, name in GENERATION.items()}


def _literal(value: str | int | float) -> str:
    if isinstance(value, str):
        return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{value!r}D" if isinstance(value, float) else repr(value)


def literal_table(spark: SparkSession, rows: list[tuple], columns: list[str]) -> DataFrame:
    """A fixed table inside the plan: Spark knows its exact size, so joins with it need no hint."""
    body = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    return spark.sql(f"SELECT * FROM VALUES {body} AS t({', '.join(columns)})")


def extra_region_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, name, abbr) for i, (abbr, name) in enumerate(EXTRA_REGIONS.items(), start=1)]
    return literal_table(spark, rows, ["id", "full_name", "abbr"])


def measure_dim(spark: SparkSession) -> DataFrame:
    rows = [(i, name, abbr) for i, (abbr, name) in enumerate(measure_names().items(), start=1)]
    return literal_table(spark, rows, ["id", "full_name", "abbr"])


def isd_measure_dim(spark: SparkSession) -> DataFrame:
    return literal_table(spark, list(enumerate(ISD_MEASURES)), ["id", "measure"])


def region_dim(spark: SparkSession) -> DataFrame:
    return literal_table(spark, list(STATE_REGION.items()), ["state", "region"])


def state_dim(spark: SparkSession) -> DataFrame:
    rows = [(abbr, name, density) for abbr, (name, density) in STATES.items()]
    return literal_table(spark, rows, ["state", "state_name", "density"])


def city_dim(spark: SparkSession) -> DataFrame:
    rows = [(st, i + 1, city) for st, cities in STATE_CITIES.items() for i, city in enumerate(cities)]
    return literal_table(spark, rows, ["state", "city_rank", "city"])
