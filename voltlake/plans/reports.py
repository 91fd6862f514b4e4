"""Dashboard queries over the measurements fact.

Parameters are bound as literals (no SQL text splicing); zone and time filters
are plain comparisons on stored columns so they reach the Parquet scan, and
the hour predicate is the half-open range form of ``date_trunc`` (F4).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.constants import (BZN_TO_COUNTRY, GREEN_SOURCES, WEATHER_OPTIONS,
                                dashboard_column, production_column)
from voltlake.functions import timefn as T
from voltlake.operators.lookup import lookup
from voltlake.sources.lake import like_to_regex

PRODUCTION_PREFIX = "production_quantity_"


def production_columns(df: DataFrame, pattern: str = "production_quantity_%") -> list[str]:
    """Columns matching a LIKE pattern ('_' and '%' are wildcards)."""
    rx = re.compile(like_to_regex(pattern))
    return [c for c in df.columns if rx.match(c)]


def split_green(cols: Sequence[str], parity: bool = False) -> tuple[list[str], list[str]]:
    """P10: green vs other production columns.

    Default uses the fact's own slug, so "Hydro Run-of-river and poundage"
    counts as green; ``parity=True`` uses the dashboard's space-only slug,
    under which that type never matches (T5).
    """
    slug = dashboard_column if parity else production_column
    wanted = {slug(s) for s in GREEN_SOURCES}
    green = [c for c in cols if c in wanted]
    other = [c for c in cols if c not in wanted]
    return green, other


def _plus(cols: Sequence[str]) -> Column:
    """SQL ``a + b + ...`` (null if any is null); 0 for an empty list."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols]) if cols else F.lit(0.0)


def row_sum(cols: Sequence[str]) -> Column:
    """Row-wise sum skipping nulls, 0 when no columns."""
    return reduce(lambda a, b: a + b, [F.coalesce(F.col(c), F.lit(0.0)) for c in cols]) \
        if cols else F.lit(0.0)


def _round(c: Column, decimals: int | None) -> Column:
    return F.round(c, decimals) if decimals is not None else c


def _day_filter(df: DataFrame, op: str, value) -> DataFrame:
    """On a day-partitioned fact table, restate a time predicate on the
    partition column so only the matching day folders are listed and read."""
    if "day" not in df.columns:
        return df
    d = F.to_date(F.lit(str(value)).cast("timestamp_ntz"))
    cond = {">=": F.col("day") >= d, "<=": F.col("day") <= d, "=": F.col("day") == d}[op]
    return df.filter(cond)


# --- B1 / B2 -----------------------------------------------------------------

def zone_list(fact: DataFrame) -> DataFrame:
    """B1: distinct zones, sorted."""
    return fact.select("bzn").distinct().orderBy("bzn")


def available_hours(fact: DataFrame) -> DataFrame:
    """B2: distinct hour buckets, nulls removed, ordered."""
    h = T.trunc_hour("datetime").alias("hourly_datetime")
    return fact.select(h).distinct().filter(F.col("hourly_datetime").isNotNull()).orderBy("hourly_datetime")


# --- B3 / B4 / B5 ------------------------------------------------------------

def zone_series(fact: DataFrame, bzn: str | None = None, start=None, end=None,
                order: bool = True) -> DataFrame:
    """Datetime, load, production columns, price and the six weather
    measures for one zone (all zones when ``bzn`` is None) between ``start``
    and ``end`` inclusive; rows with zero load removed (F5)."""
    prods = production_columns(fact)
    weather = [c for _, c, _ in WEATHER_OPTIONS]
    df = fact
    if bzn is not None:
        df = df.filter(F.col("bzn") == F.lit(bzn))
    if start is not None:
        df = df.filter(F.col("datetime") >= F.lit(str(start)).cast("timestamp_ntz"))
        df = _day_filter(df, ">=", start)
    if end is not None:
        df = df.filter(F.col("datetime") <= F.lit(str(end)).cast("timestamp_ntz"))
        df = _day_filter(df, "<=", end)
    keep = ([] if bzn is not None else ["bzn"]) + ["datetime", "consumption_quantity", *prods, "price", *weather]
    df = df.select(*keep).filter(F.col("consumption_quantity") > 0)
    return df.orderBy(*(["bzn"] if bzn is None else []), "datetime") if order else df


def green_series(fact: DataFrame, bzn: str | None = None, start=None, end=None,
                 parity: bool = False, decimals: int | None = None, order: bool = True) -> DataFrame:
    """B3 plus row-wise green and other production sums."""
    s = zone_series(fact, bzn, start, end, order=False)
    green, other = split_green(production_columns(s), parity)
    s = s.withColumns({
        "green_energy": _round(row_sum(green), decimals),
        "non_green_energy": _round(row_sum(other), decimals),
    })
    return s.orderBy(*(["bzn"] if bzn is None else []), "datetime") if order else s


def overlay(fact: DataFrame, bzn: str | None = None, measures: Sequence[str] | None = None) -> DataFrame:
    """The secondary-axis series in long form: (bzn, datetime, measure,
    value, unit) for price and the six weather measures (or a chosen subset)."""
    options = [("Price", "price", "EUR/MWH")] + list(WEATHER_OPTIONS)
    if measures is not None:
        options = [o for o in options if o[0] in measures or o[1] in measures]
    df = fact if bzn is None else fact.filter(F.col("bzn") == F.lit(bzn))
    long = df.select("bzn", "datetime", *[F.col(c).cast("double").alias(lbl) for lbl, c, _ in options]) \
        .unpivot(["bzn", "datetime"], [lbl for lbl, _, _ in options], "measure", "value")
    return long.withColumn("unit", lookup("measure", [(lbl, u) for lbl, _, u in options]))


# --- B6 / B7 -----------------------------------------------------------------

def green_share(fact: DataFrame, hour=None, parity: bool = False,
                decimals: int | None = None) -> DataFrame:
    """Per zone (and hour bucket) the summed green, other and total
    production and the green proportion (null when total is 0, T13).

    ``hour`` given: only that hour (F4 range predicate), as the dashboard map.
    ``hour`` None: every hour bucket, grouped by (bzn, hourly_datetime).
    """
    df = fact
    if hour is not None:
        df = _day_filter(df.filter(T.hour_range("datetime", hour)), "=", hour)
    return shares(green_sums(df, parity), decimals)


def green_sums(fact: DataFrame, parity: bool = False) -> DataFrame:
    """The sums B6 is made of, per zone and hour."""
    prods = production_columns(fact)
    green, other = split_green(prods, parity)
    return fact.groupBy("bzn", T.trunc_hour("datetime").alias("hourly_datetime")).agg(
        F.sum(_plus(green)).alias("green_energy"),
        F.sum(_plus(other)).alias("non_green_energy"),
        F.sum(_plus(prods)).alias("total_energy"),
    )


def shares(sums: DataFrame, decimals: int | None = None) -> DataFrame:
    """B6 from its sums."""
    return sums.select(
        "bzn", "hourly_datetime",
        _round(F.col("green_energy"), decimals).alias("green_energy"),
        _round(F.col("non_green_energy"), decimals).alias("non_green_energy"),
        _round(F.col("total_energy"), decimals).alias("total_energy"),
        _round(F.try_divide(F.col("green_energy"), F.col("total_energy")),
               None if decimals is None else decimals + 2).alias("green_proportion"),
    )


def bzn_country(bzn) -> Column:
    return lookup(bzn, BZN_TO_COUNTRY)


def green_share_country(fact: DataFrame, hour=None, parity: bool = False,
                        decimals: int | None = None, fanout: bool = False) -> DataFrame:
    """Green proportion per country for the map.

    Default (A14): the countries' zone proportions are averaged; every
    country of the zone list appears for every hour, 0 when it has no
    proportion (J8 + N2). ``fanout=True`` reproduces the reference code: the
    17-entry country list (with repeats) left-joined to the zone rows, one
    row per match, missing -> 0 (T4).
    """
    return country_map(green_share(fact, hour, parity), decimals, fanout)


def country_map(zone_shares: DataFrame, decimals: int | None = None, fanout: bool = False) -> DataFrame:
    """B7 from the zones' shares."""
    share = zone_shares.select("hourly_datetime", bzn_country("bzn").alias("country"), "green_proportion")
    # one row per hour with the countries' values as an array of at most one entry per zone, and from it the
    # fixed country list: the hours and their values come from one aggregation, without a self-join
    if fanout:
        names = [c for _, c in BZN_TO_COUNTRY]
        rows = share.groupBy("hourly_datetime").agg(F.collect_list(F.struct("country", "green_proportion")).alias("_vals"))
    else:
        names = list(dict.fromkeys(c for _, c in BZN_TO_COUNTRY))
        rows = share.groupBy("hourly_datetime", "country").agg(F.avg("green_proportion").alias("green_proportion")) \
            .groupBy("hourly_datetime").agg(F.collect_list(F.struct("country", "green_proportion")).alias("_vals"))
    listed = rows.select("hourly_datetime", "_vals", F.explode(F.array(*[F.lit(n) for n in names])).alias("country"))
    own = F.filter("_vals", lambda v: v["country"] == F.col("country"))
    value = F.explode_outer(F.transform(own, lambda v: v["green_proportion"]))
    out = listed.select("hourly_datetime", "country", value.alias("_p"))
    return out.select("hourly_datetime", "country",
                      _round(F.coalesce(F.col("_p"), F.lit(0.0)), None if decimals is None else decimals + 2).alias("green_proportion"))


# --- B8 ----------------------------------------------------------------------

def sampling_interval(fact: DataFrame, bzn: str | None = None, start=None, end=None) -> DataFrame:
    """Hours between a zone's first two rows of the B3 series, and
    whether the data is quarter-hourly (<= 0.25 h, as 0/1). Null with < 2 rows (T22).

    One pass: the two smallest times of every (zone, day), of which a day has
    one per slot at most, then those of the days, reduced to the zone. No
    self-join, and no task sees more of a zone than one entry per day.
    """
    s = zone_series(fact, bzn, start, end, order=False)
    if bzn is not None:
        s = s.withColumn("bzn", F.lit(bzn))
    days = s.groupBy("bzn", F.to_date("datetime").alias("_day")).agg(F.collect_set("datetime").alias("_times"))
    two = days.select("bzn", F.slice(F.array_sort("_times"), 1, 2).alias("_t"))
    # a day's second time matters only on the zone's first day, or the next day's first does
    firsts = two.groupBy("bzn").agg(F.min(F.struct(F.col("_t")[0].alias("a"), F.get("_t", F.lit(1)).alias("b"))).alias("_lead"),
                                    F.array_sort(F.collect_set(F.col("_t")[0])).alias("_starts"))
    second = F.coalesce(F.col("_lead.b"), F.get("_starts", F.lit(1)))
    out = firsts.select("bzn", F.col("_lead.a").alias("_first"), second.alias("_second"))
    hours = F.timestamp_diff("SECOND", F.col("_first"), F.col("_second")) / 3600.0
    return out.select("bzn", F.col("_first").alias("first_datetime"),
                      F.col("_second").alias("second_datetime"),
                      hours.alias("interval_hours"),
                      (hours <= 0.25).cast("int").alias("quarter_hourly"))
