"""Fixed values.

Everything in this module is a FIXED VALUE that must equal the source
application's data for results to agree: zone table, production-type codes,
energy-type classes, unit names, weather-condition codes, dashboard lists.
They are stated plainly, in natural order, and used as small literal lookups
(map literals or tiny DataFrames) — never as per-row Python.
"""

from __future__ import annotations

# --- fixed values: bidding zones in mapper-file order -----------------------
# (country, eic_code, bzn, latitude, longitude). The raw mapper file carries a
# trailing TAB on the Polish EIC; the cleaned code is listed here.
ZONES: list[tuple[str, str, str, float, float]] = [
    ("Estonia", "10Y1001A1001A39I", "EE", 59.35, 24.80),
    ("Latvia", "10YLV-1001A00074", "LV", 56.95, 24.11),
    ("Lithuania", "10YLT-1001A0008Q", "LT", 54.66, 25.26),
    ("Poland", "10YPL-AREA-----S", "PL", 52.24, 20.97),
    ("Germany", "10Y1001A1001A82H", "DE-LU", 52.60, 13.34),
    ("Denmark", "10YDK-1--------W", "DK1", 56.00, 9.16),
    ("Denmark", "10YDK-2--------M", "DK2", 55.70, 12.42),
    ("Sweden", "10Y1001A1001A44P", "SE1", 66.41, 20.00),
    ("Sweden", "10Y1001A1001A45N", "SE2", 63.43, 16.58),
    ("Sweden", "10Y1001A1001A46L", "SE3", 59.24, 18.02),
    ("Sweden", "10Y1001A1001A47J", "SE4", 56.98, 14.42),
    ("Norway", "10YNO-1--------2", "NO1", 59.84, 10.80),
    ("Norway", "10YNO-2--------T", "NO2", 58.99, 7.49),
    ("Norway", "10YNO-3--------J", "NO3", 63.26, 10.32),
    ("Norway", "10YNO-4--------9", "NO4", 67.01, 14.55),
    ("Norway", "10Y1001A1001A48H", "NO5", 60.53, 6.00),
    ("Finland", "10YFI-1--------U", "FI", 60.36, 24.91),
]

# EIC whose zone is forced to PL by the clean layer.
POLAND_EIC = "10YPL-AREA-----S"

# --- fixed values: zone -> country (dashboard and zone dimension order) ------
BZN_TO_COUNTRY: list[tuple[str, str]] = [
    ("EE", "Estonia"), ("LV", "Latvia"), ("LT", "Lithuania"), ("FI", "Finland"),
    ("SE1", "Sweden"), ("SE2", "Sweden"), ("SE3", "Sweden"), ("SE4", "Sweden"),
    ("NO1", "Norway"), ("NO2", "Norway"), ("NO3", "Norway"), ("NO4", "Norway"),
    ("NO5", "Norway"),
    ("DK1", "Denmark"), ("DK2", "Denmark"), ("DE-LU", "Germany"), ("PL", "Poland"),
]

# Countries whose zones publish 15-minute data (zone dimension resolution).
QUARTER_HOUR_COUNTRIES = ["Poland", "Lithuania", "Germany", "Finland"]

# --- fixed values: production type code -> energy type -----------------------
PSR_TYPES: list[tuple[str, str]] = [
    ("B01", "Biomass"),
    ("B02", "Fossil Brown coal/Lignite"),
    ("B03", "Fossil Coal-derived gas"),
    ("B04", "Fossil Gas"),
    ("B05", "Fossil Hard coal"),
    ("B06", "Fossil Oil"),
    ("B07", "Fossil Oil shale"),
    ("B08", "Fossil Peat"),
    ("B09", "Geothermal"),
    ("B10", "Hydro Pumped Storage"),
    ("B11", "Hydro Run-of-river and poundage"),
    ("B12", "Hydro Water Reservoir"),
    ("B13", "Marine"),
    ("B14", "Nuclear"),
    ("B15", "Other renewable"),
    ("B16", "Solar"),
    ("B17", "Waste"),
    ("B18", "Wind Offshore"),
    ("B19", "Wind Onshore"),
    ("B20", "Other"),
    ("B25", "Energy storage"),
]

ENERGY_TYPES: list[str] = [t for _, t in PSR_TYPES]

# --- fixed values: energy type -> (class, renewable, carbon) -----------------
# Types not listed (e.g. "Energy storage") map to ("", 0, 0).
ENERGY_CLASSES: list[tuple[str, str, int, int]] = [
    ("Biomass", "green", 1, 0),
    ("Fossil Coal-derived gas", "fossil", 0, 1),
    ("Fossil Gas", "fossil", 0, 1),
    ("Fossil Oil shale", "fossil", 0, 1),
    ("Fossil Peat", "fossil", 0, 1),
    ("Hydro Run-of-river and poundage", "green", 1, 0),
    ("Other", "other", 0, 0),
    ("Other renewable", "green", 1, 0),
    ("Solar", "green", 1, 0),
    ("Waste", "other", 0, 0),
    ("Wind Onshore", "green", 1, 0),
    ("Wind Offshore", "green", 1, 0),
    ("Hydro Pumped Storage", "green", 1, 0),
    ("Fossil Brown coal/Lignite", "fossil", 0, 1),
    ("Fossil Hard coal", "fossil", 0, 1),
    ("Fossil Oil", "fossil", 0, 1),
    ("Hydro Water Reservoir", "green", 1, 0),
    ("Geothermal", "green", 1, 0),
    ("Marine", "green", 1, 0),
    ("Nuclear", "other", 0, 0),
]

# --- fixed values: dashboard green list --------------------------------------
GREEN_SOURCES: list[str] = [
    "Solar", "Biomass", "Wind Onshore", "Wind Offshore", "Geothermal",
    "Hydro Pumped Storage", "Hydro Run-of-river and poundage",
    "Hydro Water Reservoir", "Marine", "Other renewable",
]

# --- fixed values: unit -> (class, long name) --------------------------------
# Unlisted units map to ("", "").
UNITS: list[tuple[str, str, str]] = [
    ("MAW", "electricity", "Mega Active Wat"),
    ("MWH", "electricity", "megawatt-hours"),
    ("EUR", "price", "Euro"),
    ("%", "weather", "percentage"),
    ("°C", "weather", "degrees Celsius"),
    ("mm", "weather", "millimeters"),
    ("cm", "weather", "centimeters"),
    ("km", "weather", "kilometers"),
    ("kph", "weather", "kilometers per hour"),
    ("m/s", "weather", "meters per second"),
    ("mb", "weather", "millibars"),
    ("mmHg", "weather", "air pressure"),
    ("W/m²", "weather", "watts per square meter"),
    ("J/m²", "weather", "jauls per square meter"),
]

# Weather units always added to the unit dimension, in this order.
WEATHER_UNIT_LITERALS: list[str] = [
    "%", "°C", "mm", "cm", "km", "kph", "m/s", "mb", "mmHg", "W/m²", "J/m²",
]

# --- fixed values: weather condition term -> (short, long, type, numerical) ---
# Unlisted terms map to ("", "", "", 0).
CONDITIONS: list[tuple[str, str, str, str, int]] = [
    ("Partially cloudy", "pcloudy", "Partially cloudy", "clouds", 0),
    ("Overcast", "ovrcst", "Overcast", "clouds", 0),
    ("Light Snow", "lghtsnow", "Light Snow", "precipitation", 0),
    ("Rain", "rain", "Rain", "precipitation", 0),
    ("Snow", "snow", "Snow", "precipitation", 0),
    ("Snow Showers", "snowshwrs", "Snow Showers", "precipitation", 0),
    ("Mist", "Mist", "Mist", "air", 0),
    ("Light Rain And Snow", "lghtrainandsnow", "Light Rain And Snow", "precipitation", 0),
    ("Light Rain", "lghtrain", "Light Rain", "precipitation", 0),
    ("Freezing Drizzle/Freezing Rain", "frdrizrain", "Freezing Drizzle/Freezing Rain", "precipitation", 0),
    ("Sky Coverage Increasing", "skycovinc", "Sky Coverage Increasing", "air", 0),
    ("Light Freezing Rain", "lghtfrizrain", "Light Freezing Rain", "precipitation", 0),
    ("Drizzle", "drzl", "Drizzle", "precipitation", 0),
    ("Fog", "fog", "Fog", "precipitation", 0),
    ("Light Drizzle", "lghtdrzl", "Light Drizzle", "precipitation", 0),
    ("Clear", "clr", "Clear", "clouds", 0),
    ("Heavy Rain And Snow", "clr", "Heavy Rain And Snow", "precipitation", 0),
    ("Rain Showers", "rainshwrs", "Rain Showers", "precipitation", 0),
    ("Dust storm", "dststrm", "Dust storm", "air", 0),
    ("Light Freezing Drizzle/Freezing Rain", "lghtfrizdrzlandfrizrain", "Light Freezing Drizzle/Freezing Rain", "precipitation", 0),
    ("Precipitation In Vicinity", "prcptinvcn", "Precipitation In Vicinity", "precipitation", 0),
    ("Snow And Rain Showers", "snwnrainshwrs", "Snow And Rain Showers", "precipitation", 0),
    ("Ice", "ice", "Ice", "air", 0),
    ("Light Drizzle/Rain", "lghtdrizlnrain", "Light Drizzle/Rain", "air", 0),
    ("Sky Coverage Decreasing", "skycovdec", "Sky Coverage Decreasing", "air", 0),
    ("wind_direction", "wdir", "wind direction", "wind", 1),
    ("cloudcover", "cloudcvr", "cloud cover", "clouds", 1),
    ("minimum_temperature", "mint", "minimum temperature", "air", 1),
    ("precipitation", "perc", "precipitation", "precipitation", 1),
    ("solar_radiation", "soalrrad", "solar radiation", "solar", 1),
    ("dew_point", "dew", "dew point", "air", 1),
    ("relative_humidity", "rhmdty", "relative_humidity", "air", 1),
    ("temperature", "temp", "temperature", "air", 1),
    ("maximum_temperature", "maxt", "maximum temperature", "air", 1),
    ("visibility", "visibility", "visibility", "air", 1),
    ("wind_speed", "wspd", "wind speed", "air", 1),
    ("solar_energy", "solaren", "solar energy", "air", 1),
    ("sea_level_pressure", "slevprs", "sealevel pressure", "air", 1),
    ("windchill", "wndchl", "windchill", "air", 1),
    ("wgust", "wgust", "wind gust", "air", 1),
    ("snowdepth", "snowdepth", "snow depth", "precipitation", 1),
]

# Weather-table headers that are not condition terms.
CONDITION_HEADER_EXCLUDES: list[str] = [
    "datetimeStr", "date_time", "station_info", "weathertype", "conditions",
    "country", "eic_code", "BZN", "contributing_stations", "bzn",
]

# --- fixed values: weather clean-layer renames (raw name -> clean name) ------
WEATHER_RENAMES: list[tuple[str, str]] = [
    ("Country", "country"),
    ("EIC", "eic_code"),
    ("BZN", "bzn"),
    ("datetime", "date_time"),
    ("mint", "minimum_temperature"),
    ("maxt", "maximum_temperature"),
    ("temp", "temperature"),
    ("dew", "dew_point"),
    ("humidity", "relative_humidity"),
    ("wspd", "wind_speed"),
    ("wdir", "wind_direction"),
    ("precip", "precipitation"),
    ("visibility", "visibility"),
    ("solarenergy", "solar_energy"),
    ("solarradiation", "solar_radiation"),
    ("sealevelpressure", "sea_level_pressure"),
    ("stationinfo", "station_info"),
    ("stationContributions", "contributing_stations"),
    ("conditions", "conditions"),
]

# --- fixed values: dashboard weather measures (label, column, unit) ----------
WEATHER_OPTIONS: list[tuple[str, str, str]] = [
    ("Temperature", "temperature", "°C"),
    ("Relative Humidity", "relative_humidity", "%"),
    ("Wind Speed", "wind_speed", "m/s"),
    ("Precipitation", "precipitation", "mm"),
    ("Solar Radiation", "solar_radiation", "W/m²"),
    ("Air Pressure", "sea_level_pressure", "mmHg"),
]

# --- fixed values: calendar holidays of the shipped dimension -----------------
DEFAULT_HOLIDAYS: list[str] = ["2024-12-24", "2024-12-25", "2024-12-26"]

# --- fixed values: request fields per feed -----------------------------------
REQUEST_FIELDS: dict[str, dict[str, str]] = {
    "production": {"documentType": "A75", "processType": "A16", "zone_param": "in_Domain"},
    "price": {"documentType": "A44", "contract_MarketAgreement.type": "A01", "zone_param": "in_Domain"},
    "consumption": {"documentType": "A65", "processType": "A16", "zone_param": "outBiddingZone_Domain"},
}

# Longest request window of the market feeds, and the weather plan's clamp.
REQUEST_WINDOW_DAYS = 31
WEATHER_MAX_HOURS = 48


def production_column(energy_type: str) -> str:
    """Wide fact column name for an energy type (lower; space, '-', '/' -> '_')."""
    slug = energy_type.lower().replace(" ", "_").replace("-", "_").replace("/", "_")
    return f"production_quantity_{slug}"


def dashboard_column(energy_type: str) -> str:
    """Column name the dashboard looks for (only spaces replaced)."""
    return f"production_quantity_{energy_type.lower().replace(' ', '_')}"


PRODUCTION_COLUMNS: list[str] = [production_column(t) for t in ENERGY_TYPES]
