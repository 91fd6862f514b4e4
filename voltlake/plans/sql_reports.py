"""Dashboard queries in Spark SQL with bound parameters (entry C).

The reference splices widget values into SQL text; here values are bound as
named parameters (``:bzn``, ``:t0``) and the fact is passed as a DataFrame
reference, so nothing user-supplied becomes SQL text. Only identifiers taken
from the table's own schema (the production columns, S26) are spliced, with
backticks.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from voltlake.constants import WEATHER_OPTIONS
from voltlake.functions.timefn import sql_trunc_hour
from voltlake.plans.reports import production_columns, split_green


def _plus(cols) -> str:
    return " + ".join(f"`{c}`" for c in cols) if cols else "0.0"


def zone_list(fact: DataFrame) -> DataFrame:
    """B1."""
    return fact.sparkSession.sql("SELECT DISTINCT bzn FROM {fact} ORDER BY bzn", fact=fact)


def available_hours(fact: DataFrame) -> DataFrame:
    """B2."""
    h = sql_trunc_hour("datetime")
    return fact.sparkSession.sql(
        f"SELECT DISTINCT {h} AS hourly_datetime FROM {{fact}} WHERE {h} IS NOT NULL "
        "ORDER BY hourly_datetime", fact=fact)


def zone_series(fact: DataFrame, bzn: str, start: str, end: str) -> DataFrame:
    """B3 with bound zone and inclusive time range."""
    cols = ", ".join(["datetime", "consumption_quantity", *[f"`{c}`" for c in production_columns(fact)],
                      "price", *[c for _, c, _ in WEATHER_OPTIONS]])
    # on the day-partitioned table the range is restated on the partition column
    day = ("AND day BETWEEN to_date(CAST(:t0 AS TIMESTAMP_NTZ)) AND to_date(CAST(:t1 AS TIMESTAMP_NTZ)) "
           if "day" in fact.columns else "")
    return fact.sparkSession.sql(
        f"SELECT {cols} FROM {{fact}} "
        "WHERE bzn = :bzn AND datetime BETWEEN CAST(:t0 AS TIMESTAMP_NTZ) AND CAST(:t1 AS TIMESTAMP_NTZ) "
        f"{day}AND consumption_quantity > 0 ORDER BY datetime",
        args={"bzn": bzn, "t0": str(start), "t1": str(end)}, fact=fact)


def green_share(fact: DataFrame, hour: str | None = None, parity: bool = False,
                decimals: int = 4) -> DataFrame:
    """Per zone and hour; with ``hour`` only that hour (range predicate)."""
    prods = production_columns(fact)
    green, other = split_green(prods, parity)
    h = sql_trunc_hour("datetime")
    where = ""
    args = {}
    if hour is not None:
        where = ("WHERE datetime >= CAST(:h AS TIMESTAMP_NTZ) "
                 "AND datetime < CAST(:h AS TIMESTAMP_NTZ) + INTERVAL 1 HOUR")
        if "day" in fact.columns:  # the day partition of that hour
            where += " AND day = to_date(CAST(:h AS TIMESTAMP_NTZ))"
        args["h"] = str(hour)
    return fact.sparkSession.sql(f"""
        SELECT bzn, hourly_datetime,
               round(g, {decimals}) AS green_energy, round(o, {decimals}) AS non_green_energy,
               round(t, {decimals}) AS total_energy, round(try_divide(g, t), {decimals + 2}) AS green_proportion
        FROM (SELECT bzn, {h} AS hourly_datetime,
                     sum({_plus(green)}) AS g, sum({_plus(other)}) AS o, sum({_plus(prods)}) AS t
              FROM {{fact}} {where}
              GROUP BY bzn, {h})""", args=args, fact=fact)
