"""Adapters that present the driver's ``events`` table as the four landed feeds.

The mapping is fixed (see FIXTURES.md §3) so a second engine can rebuild the
same inputs with plain SQL:

* zone      = ``user_id % 17`` into the 17 zones in mapper order
* resolution: 15 minutes for zones 2, 3, 4, 16, else 60
* position  = 1 + floor(minute-of-day / resolution); period start = midnight
* production type from ``event_type``; ingest order = ``event_id``

Each adapter is a narrow projection over one scan: no shuffle, columns pruned
at the Parquet reader, so it scales with the events table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import PSR_TYPES, ZONES
from voltlake.functions import timefn as T
from voltlake.operators.lookup import lookup

# --- fixed values: event type -> production type code of the adapters -------
EVENT_PSR: list[tuple[str, str]] = [
    ("error", "B04"),
    ("click", "B16"),
    ("view", "B19"),
    ("signup", "B11"),
    ("purchase", "B14"),
]

# Zones (0-based mapper index) that publish 15-minute data in the adapters.
QUARTER_HOUR_ZONE_IX = [2, 3, 4, 16]

# --- fixed values: weather conditions of the adapter, by event_id % 5 --------
ADAPTER_CONDITIONS = [
    "Rain, Overcast",
    "Clear",
    "Snow, Partially cloudy",
    "Fog",
    "Heavy Rain And Snow",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "events")


def landed_points(events: DataFrame) -> DataFrame:
    """Events as market-document points: zone, resolution, period, position."""
    from voltlake.operators.lookup import sql_literal
    zix = "CAST(user_id % 17 AS INT)"
    qh = ", ".join(str(i) for i in QUARTER_HOUR_ZONE_IX)
    res = f"(CASE WHEN {zix} IN ({qh}) THEN 15 ELSE 60 END)"
    eics = "array(" + ", ".join(sql_literal(z[1]) for z in ZONES) + ")"
    return events.selectExpr(
        "event_id AS ingest_order",
        f"try_element_at({eics}, {zix} + 1) AS eic_code",
        f"CASE WHEN {res} = 15 THEN 'PT15M' ELSE 'PT60M' END AS resolution",
        f"{T.sql_day_start('ts')} AS period_start",
        f"CAST(floor({T.sql_minute_of_day('ts')} / {res}) AS INT) + 1 AS position",
        "event_type", "value", "ts",
    )


def production_data(events: DataFrame) -> DataFrame:
    """``production_data`` lake rows (plus ``ingest_order``)."""
    p = landed_points(events)
    code = lookup("event_type", EVENT_PSR)
    return p.select(
        "eic_code",
        F.col("value").alias("quantity"),
        F.lit("MAW").alias("unit"),
        lookup(code, PSR_TYPES).alias("produced_energy_type"),
        T.point_time("period_start", "resolution", "position").alias("datetime"),
        "ingest_order",
    )


def consumption_data(events: DataFrame) -> DataFrame:
    """``consumption_data`` lake rows (plus ``ingest_order``)."""
    p = landed_points(events)
    return p.select(
        "eic_code",
        F.col("value").alias("quantity"),
        F.lit("MAW").alias("unit"),
        T.point_time("period_start", "resolution", "position").alias("datetime"),
        "ingest_order",
    )


def price_data(events: DataFrame) -> DataFrame:
    """``price_data`` lake rows: purchases only, a sparse series."""
    p = landed_points(events.filter(F.col("event_type") == "purchase"))
    return p.select(
        "eic_code",
        F.col("value").alias("price"),
        F.lit("EUR").alias("currency_unit"),
        F.lit("MWH").alias("price_measure_unit"),
        T.point_time("period_start", "resolution", "position").alias("datetime"),
        "ingest_order",
    )


def weather_data(events: DataFrame) -> DataFrame:
    """Raw weather rows (API field names), one per view event at its hour."""
    from voltlake.operators.lookup import sql_literal

    def arr(vals):
        return "array(" + ", ".join(sql_literal(v) for v in vals) + ")"
    zix = "CAST(user_id % 17 AS INT) + 1"
    bzn = f"try_element_at({arr([z[2] for z in ZONES])}, {zix})"
    return events.filter(F.col("event_type") == "view").selectExpr(
        f"try_element_at({arr([z[0] for z in ZONES])}, {zix}) AS Country",
        f"try_element_at({arr([z[1] for z in ZONES])}, {zix}) AS EIC",
        f"{bzn} AS BZN",
        f"{T.sql_trunc_hour('ts')} AS datetime",
        "value - 2 AS mint", "value + 2 AS maxt", "value AS temp", "value - 5 AS dew",
        "value * 3 AS humidity", "value / 4 AS wspd", "value * 10 AS wdir", "value / 10 AS precip",
        "value + 10 AS visibility", "value / 100 AS solarenergy", "value * 5 AS solarradiation",
        "value + 1000 AS sealevelpressure",
        f"concat('st_', {bzn}) AS stationinfo",
        f"concat('{{\"', {bzn}, '\":1}}') AS stationContributions",
        f"try_element_at({arr(ADAPTER_CONDITIONS)}, CAST(event_id % 5 AS INT) + 1) AS conditions",
        "event_id AS ingest_order",
    )


def weather_cleaned(events: DataFrame) -> DataFrame:
    from voltlake.plans.clean import clean_weather
    return clean_weather(weather_data(events))


class Feeds(dict):
    """The four adapter feeds, each built on first use (a query that reads
    one feed does not plan the others)."""

    _builders = {
        "production": production_data,
        "consumption": consumption_data,
        "price": price_data,
        "weather": weather_cleaned,
    }

    def __init__(self, events: DataFrame):
        super().__init__()
        self._events = events

    def __missing__(self, key: str) -> DataFrame:
        df = self._builders[key](self._events)
        self[key] = df
        return df


def feeds(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return Feeds(read_events(spark, sf_dir))
