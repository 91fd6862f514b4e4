"""Landed documents built from feed rows (the write side of S3-S8, S11).

The driver tables carry no XML or JSON, so the documents the readers consume
are produced here from the adapter rows with ``to_xml`` / ``to_json`` — the
same shapes the feeds deliver — and can be written partitioned by feed, zone
and window (S11). Reading them back must give the adapter rows again.

Each document collects at most ``max_points`` points: documents are keyed by
(zone, day, type, ingest bucket), the bucket being ``ingest_order //
max_points``. A zone/day/type holding a third of all rows is therefore split
over many bounded documents instead of one unbounded group.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.constants import ENERGY_TYPES, ZONES, production_column
from voltlake.functions import timefn as T
from voltlake.operators.lookup import lookup
from voltlake.sources.fixtures import EVENT_PSR, landed_points

MAX_POINTS = 5000

GENERATION_NS = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"
PRICE_NS = "urn:iec62325.351:tc57wg16:451-3:publicationdocument:7:3"

_STAMP = "yyyy-MM-dd'T'HH:mm'Z'"


def _bucket(max_points: int) -> Column:
    return F.floor(F.col("ingest_order") / F.lit(max_points)).cast("long").alias("_bucket")


def _number() -> Column:
    """A document's number: the ingest order of its first point. No two documents of a feed share one, and of two
    of one zone and day the one with the earlier points has the smaller number."""
    return F.min("ingest_order").cast("long").alias("doc_seq")


def _period(points: Column) -> Column:
    return F.struct(
        F.struct(F.date_format("period_start", _STAMP).alias("start"),
                 F.date_format(F.col("period_start") + F.expr("INTERVAL 1 DAY"), _STAMP).alias("end")
                 ).alias("timeInterval"),
        F.col("resolution").alias("resolution"),
        points.alias("Point"))


def _sorted_points(value: str, tag: str) -> Column:
    """Points ordered by (position, ingest order), ingest order then dropped."""
    pts = F.array_sort(F.collect_list(F.struct("position", "ingest_order", value)))
    return F.transform(pts, lambda p: F.struct(p["position"].alias("position"), p[value].alias(tag)))


def generation_documents(events: DataFrame, max_points: int = MAX_POINTS) -> DataFrame:
    """A75 documents: one TimeSeries (zone, type) with one daily Period."""
    p = landed_points(events).withColumn("psr", lookup("event_type", EVENT_PSR))
    g = p.groupBy("eic_code", "resolution", "period_start", "psr", _bucket(max_points)) \
        .agg(_sorted_points("value", "quantity").alias("pts"), _number())
    series = F.struct(
        F.col("eic_code").alias("inBiddingZone_Domain.mRID"),
        F.lit("MAW").alias("quantity_Measure_Unit.name"),
        F.struct(F.col("psr").alias("psrType")).alias("MktPSRType"),
        _period(F.col("pts")).alias("Period"))
    doc = F.struct(F.lit(GENERATION_NS).alias("_xmlns"), series.alias("TimeSeries"))
    return g.select("eic_code", "period_start", "psr", "doc_seq", F.lit(200).alias("status"),
                    F.to_xml(doc, {"rowTag": "GL_MarketDocument"}).alias("xml"))


def price_documents(events: DataFrame, max_points: int = MAX_POINTS) -> DataFrame:
    """A44 documents: one TimeSeries per zone and day."""
    p = landed_points(events.filter(F.col("event_type") == "purchase"))
    g = p.groupBy("eic_code", "resolution", "period_start", _bucket(max_points)) \
        .agg(_sorted_points("value", "price.amount").alias("pts"), _number())
    series = F.struct(
        F.lit("EUR").alias("currency_Unit.name"),
        F.lit("MWH").alias("price_Measure_Unit.name"),
        F.col("eic_code").alias("in_Domain.mRID"),
        F.col("eic_code").alias("out_Domain.mRID"),
        _period(F.col("pts")).alias("Period"))
    doc = F.struct(F.lit(PRICE_NS).alias("_xmlns"), series.alias("TimeSeries"))
    return g.select("eic_code", "period_start", "doc_seq", F.lit(200).alias("status"),
                    F.to_xml(doc, {"rowTag": "Publication_MarketDocument"}).alias("xml"))


def load_documents(events: DataFrame, max_points: int = MAX_POINTS) -> DataFrame:
    """A65 documents: one TimeSeries per zone and day."""
    p = landed_points(events)
    g = p.groupBy("eic_code", "resolution", "period_start", _bucket(max_points)) \
        .agg(_sorted_points("value", "quantity").alias("pts"), _number())
    series = F.struct(
        F.col("eic_code").alias("outBiddingZone_Domain.mRID"),
        F.lit("MAW").alias("quantity_Measure_Unit.name"),
        _period(F.col("pts")).alias("Period"))
    doc = F.struct(F.lit(GENERATION_NS).alias("_xmlns"), series.alias("TimeSeries"))
    return g.select("eic_code", "period_start", "doc_seq", F.lit(200).alias("status"),
                    F.to_xml(doc, {"rowTag": "GL_MarketDocument"}).alias("xml"))


WEATHER_VALUE_FIELDS = ["mint", "maxt", "temp", "dew", "humidity", "wspd", "wdir", "precip",
                        "visibility", "solarenergy", "solarradiation", "sealevelpressure",
                        "stationinfo", "conditions"]


def weather_documents(weather_data: DataFrame, max_points: int = MAX_POINTS) -> DataFrame:
    """Weather JSON per zone, day and bucket: ``locations.{"lat,lon"}`` with
    ``values`` (epoch-ms ``datetime``) and ``stationContributions``."""
    latlon = lookup("BZN", [(z[2], f"{z[3]},{z[4]}") for z in ZONES])
    w = weather_data.select("BZN", F.to_date("datetime").alias("day"), _bucket(max_points),
                            latlon.alias("latlon"),
                            F.struct(T.ntz_to_epoch_millis("datetime").alias("datetime"),
                                     F.col("ingest_order"),
                                     *[F.col(c) for c in WEATHER_VALUE_FIELDS]).alias("v"))
    g = w.groupBy("BZN", "day", "_bucket", "latlon").agg(
        F.array_sort(F.collect_list("v")).alias("vals"), F.min("v.ingest_order").cast("long").alias("doc_seq"))
    vals = F.transform("vals", lambda v: F.struct(v["datetime"].alias("datetime"),
                                                  *[v[c].alias(c) for c in WEATHER_VALUE_FIELDS]))
    loc = F.struct(vals.alias("values"),
                   F.create_map(F.col("BZN"), F.lit(1)).alias("stationContributions"))
    doc = F.struct(F.create_map(F.col("latlon"), loc).alias("locations"))
    return g.select(F.col("BZN").alias("bzn"), F.date_format("day", "yyyy-MM-dd").alias("window_start"),
                    F.date_format("day", "yyyy-MM-dd").alias("window_end"), "doc_seq",
                    F.lit(200).alias("status"), F.to_json(doc).alias("body"))


def breakdown_documents(production_wide: DataFrame, consumption_keyed: DataFrame,
                        energy_types=ENERGY_TYPES) -> DataFrame:
    """Power-breakdown JSON per zone and day: ``history[]`` of
    {datetime, powerConsumptionBreakdown, powerProductionBreakdown}.
    Input is one row per (zone, datetime), so a day holds <= 96 entries."""
    bzn = lookup("eic_code", [(z[1], z[2]) for z in ZONES])
    prod_map = F.map_from_entries(F.filter(F.array(*[
        F.struct(F.lit(production_column(t)[len("production_quantity_"):]).alias("k"),
                 F.col(production_column(t)).alias("v")) for t in energy_types]),
        lambda e: e["v"].isNotNull()))
    j = production_wide.join(consumption_keyed.select("eic_code", "datetime", "consumption_quantity"),
                             ["eic_code", "datetime"], "full")
    entry = F.struct(
        F.date_format("datetime", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("datetime"),
        F.create_map(F.lit("load"), F.col("consumption_quantity")).alias("powerConsumptionBreakdown"),
        prod_map.alias("powerProductionBreakdown"))
    g = j.select(bzn.alias("zone"), F.to_date("datetime").alias("day"), entry.alias("e")) \
        .groupBy("zone", "day").agg(F.array_sort(
            F.collect_list("e"),
            lambda a, b: F.when(a["datetime"] < b["datetime"], -1)
            .when(a["datetime"] > b["datetime"], 1).otherwise(0)).alias("history"))
    return g.select("zone", "day", F.to_json(F.struct("zone", "history")).alias("body"))
