"""Zone-free time expressions.

All helpers take and return TIMESTAMP_NTZ columns and avoid any cast through
the session time zone, so the same plan gives the same answer whatever zone
the session is set to.

Each helper accepts column names / SQL expression text (``str``) or Column
objects. With text inputs the whole expression is composed as Spark SQL and
turned into one Column with ``F.expr`` — a single call into the JVM instead
of one per sub-expression, which keeps plan construction cheap for the wide
plans built here. Column inputs take the equivalent DataFrame-function path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EPOCH_NTZ = "1970-01-01 00:00:00"


def _c(x) -> Column:
    return F.expr(x) if isinstance(x, str) else x


def _all_text(*xs) -> bool:
    return all(isinstance(x, (str, int)) for x in xs)


# --- SQL text builders ---------------------------------------------------------

def sql_day_start(ts: str) -> str:
    return f"CAST(to_date({ts}) AS TIMESTAMP_NTZ)"


def sql_minutes(n: str | int) -> str:
    return f"make_dt_interval(0, 0, CAST({n} AS INT), 0)"


def sql_minute_of_day(ts: str) -> str:
    return f"(hour({ts}) * 60 + minute({ts}))"


def sql_floor_minutes(ts: str, step: int) -> str:
    return f"({sql_day_start(ts)} + {sql_minutes(f'floor({sql_minute_of_day(ts)} / {int(step)}) * {int(step)}')})"


def sql_ceil_minutes(ts: str, step: int) -> str:
    fl = sql_floor_minutes(ts, step)
    return f"(CASE WHEN {fl} = {ts} THEN {fl} ELSE {fl} + {sql_minutes(int(step))} END)"


def sql_trunc_hour(ts: str) -> str:
    return f"({sql_day_start(ts)} + make_dt_interval(0, hour({ts}), 0, 0))"


def sql_resolution_minutes(resolution: str) -> str:
    return f"(CASE {resolution} WHEN 'PT60M' THEN 60 WHEN 'PT15M' THEN 15 END)"


def sql_point_time(start: str, resolution: str, position: str) -> str:
    return f"({start} + {sql_minutes(f'{sql_resolution_minutes(resolution)} * {position}')})"


def sql_parse_market_time(s: str) -> str:
    return f"to_timestamp_ntz(regexp_replace({s}, 'Z$', ''), 'yyyy-MM-dd''T''HH:mm')"


# --- Column API ------------------------------------------------------------------

def minutes(n) -> Column:
    """Day-time interval of ``n`` minutes (``n`` may be a column)."""
    if _all_text(n):
        return F.expr(sql_minutes(n))
    return F.make_dt_interval(F.lit(0), F.lit(0), n.cast("int"), F.lit(0))


def day_start(ts) -> Column:
    """Midnight of the timestamp's day, as TIMESTAMP_NTZ."""
    if _all_text(ts):
        return F.expr(sql_day_start(ts))
    return F.to_date(ts).cast("timestamp_ntz")


def minute_of_day(ts) -> Column:
    if _all_text(ts):
        return F.expr(sql_minute_of_day(ts))
    return F.hour(ts) * 60 + F.minute(ts)


def floor_minutes(ts, step: int) -> Column:
    """Floor to a ``step``-minute grid aligned at midnight (step divides 1440)."""
    if _all_text(ts):
        return F.expr(sql_floor_minutes(ts, step))
    slot = F.floor(minute_of_day(ts) / F.lit(step)) * step
    return day_start(ts) + minutes(slot)


def ceil_minutes(ts, step: int) -> Column:
    """Smallest grid point at or after ``ts``."""
    if _all_text(ts):
        return F.expr(sql_ceil_minutes(ts, step))
    fl = floor_minutes(ts, step)
    return F.when(fl == ts, fl).otherwise(fl + minutes(step))


def trunc_hour(ts) -> Column:
    """``date_trunc('hour', ts)`` kept as TIMESTAMP_NTZ."""
    if _all_text(ts):
        return F.expr(sql_trunc_hour(ts))
    return day_start(ts) + F.make_dt_interval(F.lit(0), F.hour(ts), F.lit(0), F.lit(0))


def hour_range(ts, hour_value) -> Column:
    """Prunable form of ``date_trunc('hour', ts) = hour`` (F4): [h, h + 1 hour)."""
    ts = _c(ts)
    h = F.lit(str(hour_value)).cast("timestamp_ntz") if not isinstance(hour_value, Column) else hour_value
    return (ts >= h) & (ts < h + F.expr("INTERVAL 1 HOUR"))


def resolution_minutes(resolution) -> Column:
    """Minutes per position for the interval codes in use (null otherwise)."""
    if _all_text(resolution):
        return F.expr(sql_resolution_minutes(resolution))
    return F.when(resolution == "PT60M", F.lit(60)).when(resolution == "PT15M", F.lit(15))


def point_time(start, resolution, position) -> Column:
    """Stamp of a 1-based interval position (end of the interval).

    PT60M adds ``position`` hours, PT15M adds 15 * ``position`` minutes, any
    other resolution gives null (T1).
    """
    if _all_text(start, resolution, position):
        return F.expr(sql_point_time(start, resolution, position))
    return _c(start) + minutes(resolution_minutes(resolution) * _c(position))


def hourly_point_time(start, position) -> Column:
    """Position always counted in hours."""
    if _all_text(start, position):
        return F.expr(f"({start} + {sql_minutes(f'60 * {position}')})")
    return _c(start) + minutes(F.lit(60) * _c(position))


def parse_market_time(s) -> Column:
    """``yyyy-MM-ddTHH:mmZ`` text to TIMESTAMP_NTZ (UTC wall time)."""
    if _all_text(s):
        return F.expr(sql_parse_market_time(s))
    return F.to_timestamp_ntz(F.regexp_replace(s, "Z$", ""), F.lit("yyyy-MM-dd'T'HH:mm"))


def epoch_millis_ntz(ms) -> Column:
    """Epoch milliseconds to a zone-less UTC wall time, µs precision."""
    secs = (_c(ms).cast("decimal(20,3)") / 1000).cast("decimal(18,6)")
    return F.lit(EPOCH_NTZ).cast("timestamp_ntz") + F.make_dt_interval(
        F.lit(0), F.lit(0), F.lit(0), secs)


def ntz_to_epoch_millis(ts) -> Column:
    """Inverse of ``epoch_millis_ntz`` (used to land weather documents)."""
    return F.timestamp_diff("MILLISECOND", F.lit(EPOCH_NTZ).cast("timestamp_ntz"), _c(ts))


def request_stamp(ts) -> Column:
    """``yyyyMMddHHmm`` request parameter text."""
    return F.date_format(_c(ts), "yyyyMMddHHmm")


def weekday_name(ts) -> Column:
    """English weekday name."""
    return F.date_format(_c(ts), "EEEE")


def day_type(ts, holidays: list[str]) -> Column:
    """Holiday > Weekend > Working Day."""
    d = F.to_date(_c(ts))
    hol = [F.lit(h).cast("date") for h in holidays]
    is_hol = d.isin(*hol) if hol else F.lit(False)
    # weekday(): 0 = Monday ... 6 = Sunday
    return (F.when(is_hol, "Holiday")
            .when(F.weekday(d) >= 5, "Weekend")
            .otherwise("Working Day"))


def clamp_start(start, end, max_hours: int) -> Column:
    """start moved up to ``end - max_hours`` when the range is longer."""
    return F.greatest(_c(start), _c(end) - F.make_dt_interval(F.lit(0), F.lit(max_hours), F.lit(0), F.lit(0)))


def previous_day_bounds(today) -> tuple[Column, Column]:
    """The UTC day before ``today`` (a DATE column or 'yyyy-MM-dd'):
    (midnight, 23:00) as TIMESTAMP_NTZ. ``today`` is an argument, not
    ``current_date()``, so reruns are deterministic."""
    d = F.date_sub(F.lit(today).cast("date") if isinstance(today, str) else today, 1)
    start = d.cast("timestamp_ntz")
    return start, start + F.expr("INTERVAL 23 HOURS")
