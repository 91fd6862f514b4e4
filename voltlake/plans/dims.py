"""Star-schema dimensions.

Each dimension is one set-based plan: candidates with a first-seen order key
(A11, an aggregation with map-side combine), a lookup of the fixed attributes
(map literals), insert-if-absent against the existing table (J4, left anti
join) and dense first-seen surrogate keys (A10). The per-value INSERT loop of
the reference becomes one job.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import (BZN_TO_COUNTRY, CONDITION_HEADER_EXCLUDES, CONDITIONS,
                                DEFAULT_HOLIDAYS, ENERGY_CLASSES, QUARTER_HOUR_COUNTRIES,
                                UNITS, WEATHER_UNIT_LITERALS)
from voltlake.functions import timefn as T
from voltlake.functions.textfn import split_trim
from voltlake.operators.dedupe import INGEST_ORDER
from voltlake.operators.keys import existing_count, insert_if_absent, sequential_ids
from voltlake.operators.lookup import lookup, lookup_or


def _seen(src: int, order, col: int = 0):
    return F.struct(F.lit(src).alias("src"), F.col(order).cast("long").alias("o") if isinstance(order, str)
                    else order.cast("long").alias("o"), F.lit(col).alias("c"))


def _first_seen(cands: DataFrame, value: str) -> DataFrame:
    """Distinct values with their smallest (src, order, col) key."""
    return cands.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min("_k").alias("_k"))


# --- D1 ----------------------------------------------------------------------

def build_unit_dim(consumption: DataFrame, price: DataFrame, production: DataFrame,
                   existing: DataFrame | None = None) -> DataFrame:
    """Units of load, price (currency then measure, per row) and production
    in that order, then the fixed weather units; class and long name looked
    up ('' when unknown)."""
    spark = consumption.sparkSession
    lits = spark.createDataFrame([(u, i) for i, u in enumerate(WEATHER_UNIT_LITERALS)], "u string, i long")
    cands = (
        consumption.select(F.col("unit").alias("u"), _seen(1, INGEST_ORDER).alias("_k"))
        .unionByName(price.select(F.col("currency_unit").alias("u"), _seen(2, INGEST_ORDER, 0).alias("_k")))
        .unionByName(price.select(F.col("price_measure_unit").alias("u"), _seen(2, INGEST_ORDER, 1).alias("_k")))
        .unionByName(production.select(F.col("unit").alias("u"), _seen(3, INGEST_ORDER).alias("_k")))
        .unionByName(lits.select("u", _seen(4, F.col("i")).alias("_k")))
    )
    firsts = _first_seen(cands, "u").withColumnRenamed("u", "unit_short")
    firsts = insert_if_absent(firsts, existing, "unit_short")
    dim = firsts.select(
        "unit_short", "_k",
        lookup_or("unit_short", [(u, lng) for u, _, lng in UNITS], "").alias("unit_long"),
        lookup_or("unit_short", [(u, cls) for u, cls, _ in UNITS], "").alias("unit_class"),
    )
    dim = sequential_ids(dim, ["_k"], offset=existing_count(existing))
    return dim.select("_id", "unit_short", "unit_long", "unit_class")


# --- D2 ----------------------------------------------------------------------

def condition_headers(weather_cleaned: DataFrame) -> list[str]:
    """Weather-table headers minus the non-measure ones, in column order."""
    return [c for c in weather_cleaned.columns
            if c not in CONDITION_HEADER_EXCLUDES and c != INGEST_ORDER]


def build_condition_dim(weather_cleaned: DataFrame, existing: DataFrame | None = None,
                        headers: Sequence[str] | None = None) -> DataFrame:
    """Condition terms (comma split, stripped) in first-seen order, then the
    measure headers; mapped to (short, long, type, numerical); one row per
    short code, first seen wins (T15: unmapped terms share '' and
    "Heavy Rain And Snow" shares "clr" with "Clear")."""
    spark = weather_cleaned.sparkSession
    headers = list(headers) if headers is not None else condition_headers(weather_cleaned)
    terms = weather_cleaned.select(
        INGEST_ORDER, F.posexplode(split_trim(F.col("conditions"), ",")).alias("pos", "term"))
    cands = terms.select("term", _seen(0, INGEST_ORDER, 0).alias("_k0"), "pos") \
        .select("term", F.struct(F.col("_k0.src").alias("src"), F.col("_k0.o").alias("o"),
                                 F.col("pos").alias("c")).alias("_k"))
    hdr = spark.createDataFrame([(h, i) for i, h in enumerate(headers)], "term string, i long") \
        .select("term", _seen(1, F.col("i")).alias("_k"))
    firsts = _first_seen(cands.unionByName(hdr), "term")
    mapped = firsts.select(
        "_k",
        lookup_or("term", [(t, s) for t, s, _, _, _ in CONDITIONS], "").alias("condition_short"),
        lookup_or("term", [(t, lg) for t, _, lg, _, _ in CONDITIONS], "").alias("condition_long"),
        lookup_or("term", [(t, ty) for t, _, _, ty, _ in CONDITIONS], "").alias("condition_type"),
        lookup_or("term", [(t, n) for t, _, _, _, n in CONDITIONS], 0).cast("int").alias("numerical"),
    )
    per_short = mapped.groupBy("condition_short").agg(
        F.min_by(F.struct("condition_long", "condition_type", "numerical"), F.col("_k")).alias("_r"),
        F.min("_k").alias("_k"))
    per_short = insert_if_absent(per_short, existing, "condition_short")
    dim = sequential_ids(per_short, ["_k"], offset=existing_count(existing))
    return dim.select("_id", "condition_short", F.col("_r.condition_long").alias("condition_long"),
                      F.col("_r.condition_type").alias("condition_type"),
                      F.col("_r.numerical").alias("numerical"))


# --- D3 ----------------------------------------------------------------------

def build_energy_dim(production: DataFrame, existing: DataFrame | None = None) -> DataFrame:
    """Energy types in first-seen order with (class, renewable, carbon);
    unknown codes (null type) are left out (T19)."""
    firsts = production.select(F.col("produced_energy_type").alias("energy_type_x"),
                               _seen(0, INGEST_ORDER).alias("_k"))
    firsts = _first_seen(firsts, "energy_type_x")
    firsts = insert_if_absent(firsts, existing, "energy_type_x")
    dim = firsts.select(
        "energy_type_x", "_k",
        lookup_or("energy_type_x", [(t, c) for t, c, _, _ in ENERGY_CLASSES], "").alias("energy_type_class"),
        lookup_or("energy_type_x", [(t, r) for t, _, r, _ in ENERGY_CLASSES], 0).cast("int").alias("renewable"),
        lookup_or("energy_type_x", [(t, k) for t, _, _, k in ENERGY_CLASSES], 0).cast("int").alias("carbon"),
    )
    dim = sequential_ids(dim, ["_k"], offset=existing_count(existing))
    return dim.select("_id", "energy_type_x", "energy_type_class", "renewable", "carbon")


# --- D4 ----------------------------------------------------------------------

def build_zone_dim(spark: SparkSession, existing: DataFrame | None = None) -> DataFrame:
    """The 17 zones with country, eu_member 1 (Norway too, T16), resolution
    15 for the quarter-hour countries else 60, geometry 'geom'."""
    rows = [(b, c, i) for i, (b, c) in enumerate(BZN_TO_COUNTRY)]
    z = spark.createDataFrame(rows, "bzn string, country string, _k long")
    z = insert_if_absent(z, existing, "bzn")
    z = z.select(
        "bzn", "country", F.lit(1).alias("eu_member"),
        F.when(F.col("country").isin(*QUARTER_HOUR_COUNTRIES), F.lit(15)).otherwise(F.lit(60)).alias("data_resolution"),
        F.lit("geom").alias("geometry"), "_k")
    z = sequential_ids(z, ["_k"], offset=existing_count(existing))
    return z.select("_id", "bzn", "country", "eu_member", "data_resolution", "geometry")


# --- D5 ----------------------------------------------------------------------

def calendar_bounds(spark: SparkSession, start: str, end: str) -> DataFrame:
    return spark.range(1).select(F.lit(start).cast("timestamp_ntz").alias("start"),
                                 F.lit(end).cast("timestamp_ntz").alias("end"))


def build_timestamp_dim(bounds: DataFrame, step_minutes: int = 15,
                        holidays: Sequence[str] = DEFAULT_HOLIDAYS,
                        existing: DataFrame | None = None) -> DataFrame:
    """Every ``step``-minute slot from ``start`` to ``end`` (inclusive, grid
    anchored at ``start``) with weekday name and 0/1 day-type flags.

    ``bounds`` is a one-row frame (start, end) — literal dates or aggregates
    of a table. Days are generated first, then each day's slots, and the
    surrogate key is numbered per day, so no step sorts the whole calendar.
    """
    step = F.expr(f"INTERVAL {int(step_minutes)} MINUTES")
    days = bounds.select("start", "end", F.explode(F.sequence(
        F.to_date("start"), F.to_date("end"), F.expr("INTERVAL 1 DAY"))).alias("day"))
    first = F.greatest(F.col("start"), F.col("day").cast("timestamp_ntz"))
    # first slot of the day on the grid anchored at start
    offset_min = F.timestamp_diff("MINUTE", F.col("start"), first)
    first_slot = F.col("start") + T.minutes(F.ceil(offset_min / step_minutes) * step_minutes)
    last = F.least(F.col("end"), F.col("day").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY") - F.expr("INTERVAL 1 MICROSECOND"))
    slots = days.select("day", F.explode(F.when(first_slot <= last, F.sequence(first_slot, last, step))).alias("datetime"))
    kind = T.day_type("datetime", list(holidays))
    cal = slots.select(
        "datetime",
        T.weekday_name("datetime").alias("weekday"),
        (kind == "Working Day").cast("int").alias("workingday"),
        (kind == "Weekend").cast("int").alias("weekend"),
        (kind == "Holiday").cast("int").alias("holiday"),
    )
    cal = insert_if_absent(cal, existing, "datetime")
    cal = sequential_ids(cal, ["datetime"], bucket=F.to_date("datetime"), offset=existing_count(existing))
    return cal.select("_id", "datetime", "weekday", "workingday", "weekend", "holiday")


def data_calendar_bounds(events: DataFrame, ts: str = "ts") -> DataFrame:
    """Whole days spanned by a table's timestamps: midnight of the first day
    to 23:59:59.999999 of the last."""
    agg = events.agg(F.min(F.to_date(ts)).alias("d0"), F.max(F.to_date(ts)).alias("d1"))
    return agg.select(F.col("d0").cast("timestamp_ntz").alias("start"),
                      (F.col("d1").cast("timestamp_ntz") + F.expr("INTERVAL 1 DAY")
                       - F.expr("INTERVAL 1 MICROSECOND")).alias("end"))
