"""J5/W3 grid fill, W4 column fill, J6 reindex, W1/W2 and time helpers."""

import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from voltlake.functions import timefn as T
from voltlake.operators.asof import ffill_grid, forward_fill, hourly_grid, reindex
from voltlake.operators.dedupe import keep_first, pivot_first


def _asof_grid(rows):
    """Every quarter-hour slot between a zone's first and last time, with the latest row at or before it."""
    out = []
    for zone in sorted({r[0] for r in rows}):
        obs = pd.DataFrame([r[1:] for r in rows if r[0] == zone], columns=["at", "v", "w"]).sort_values("at")
        obs["at"] = obs["at"].astype("datetime64[us]")
        slots = pd.DataFrame({"slot": pd.date_range(obs["at"].min().ceil("15min"), obs["at"].max(), freq="15min").astype("datetime64[us]")})
        for r in pd.merge_asof(slots, obs, left_on="slot", right_on="at").itertuples():
            out.append((zone, r.slot.to_pydatetime(), None if pd.isna(r.v) else r.v, None if pd.isna(r.w) else r.w))
    return sorted(out)


@pytest.mark.parametrize("aligned", [True, False])
@pytest.mark.parametrize("seed", [1, 2, 3])
def test_ffill_grid_matches_pandas(spark, aligned, seed):
    rnd = random.Random(seed)
    rows = []
    for zone in ["A", "B", "C"]:
        t = dt.datetime(2024, 1, 1) + dt.timedelta(minutes=rnd.randrange(0, 600))
        if aligned:
            t = t.replace(minute=(t.minute // 15) * 15)
        for _ in range(rnd.randrange(1, 40)):
            step = rnd.choice([15, 30, 60, 60, 180, 24 * 60 + 45]) if aligned else rnd.randrange(1, 2000)
            t = t + dt.timedelta(minutes=step, seconds=0 if aligned else rnd.randrange(0, 60))
            v = None if rnd.random() < 0.2 else round(rnd.random() * 100, 2)
            rows.append((zone, t, v, rnd.random()))
    df = spark.createDataFrame(rows, "eic_code string, datetime timestamp_ntz, v double, w double")
    got = sorted(tuple(r) for r in ffill_grid(df, ["eic_code"], "datetime").collect())
    assert got == _asof_grid(rows)


def test_ffill_keeps_nulls_of_carried_row(spark):
    rows = [("Z", dt.datetime(2024, 1, 1, 0), 1.0), ("Z", dt.datetime(2024, 1, 1, 1), None),
            ("Z", dt.datetime(2024, 1, 1, 2), 3.0)]
    df = spark.createDataFrame(rows, "eic_code string, datetime timestamp_ntz, v double")
    got = {r.datetime: r.v for r in ffill_grid(df, ["eic_code"], "datetime").collect()}
    assert got[dt.datetime(2024, 1, 1, 1, 45)] is None      # null carried, not the 00:00 value
    assert got[dt.datetime(2024, 1, 1, 0, 45)] == 1.0
    assert min(got) == dt.datetime(2024, 1, 1, 0) and max(got) == dt.datetime(2024, 1, 1, 2)
    assert len(got) == 9


def test_ffill_across_empty_days(spark):
    rows = [("Z", dt.datetime(2024, 1, 1, 23, 0), 1.0), ("Z", dt.datetime(2024, 1, 4, 0, 30), 2.0)]
    df = spark.createDataFrame(rows, "eic_code string, datetime timestamp_ntz, v double")
    out = ffill_grid(df, ["eic_code"], "datetime").collect()
    assert len(out) == (24 * 4 * 2 + 4 + 2 + 1)   # 23:00 day 1 .. 00:30 day 4
    assert {r.v for r in out if r.datetime < dt.datetime(2024, 1, 4, 0, 30)} == {1.0}


def test_forward_fill_column_leading_nulls_stay(spark):
    rows = [("Z", 1, None), ("Z", 2, 5.0), ("Z", 3, None), ("Z", 4, 7.0), ("Z", 5, None)]
    df = spark.createDataFrame(rows, "k string, t int, price double")
    got = [r.price for r in forward_fill(df, ["price"], ["k"], "t").orderBy("t").collect()]
    assert got == [None, 5.0, 5.0, 7.0, 7.0]
    s = pd.Series([None, 5.0, None, 7.0, None]).ffill()
    assert got[1:] == list(s)[1:]


def test_reindex_hours(spark):
    days = spark.createDataFrame([("EE", dt.datetime(2024, 12, 5))], "eic_code string, day timestamp_ntz")
    grid = hourly_grid(days, "day", ["eic_code"])
    assert grid.count() == 24
    pts = spark.createDataFrame([("EE", dt.datetime(2024, 12, 5), dt.datetime(2024, 12, 5, 3), 1.0),
                                 ("EE", dt.datetime(2024, 12, 5), dt.datetime(2024, 12, 6, 0), 9.0)],
                                "eic_code string, day timestamp_ntz, datetime timestamp_ntz, price double")
    r = reindex(grid, pts, ["eic_code", "day", "datetime"])
    assert r.count() == 24 and r.filter("price IS NOT NULL").count() == 1


def test_point_time_and_helpers(spark):
    df = spark.range(1).select(F.lit("2024-12-05 23:07:31.5").cast("timestamp_ntz").alias("ts"))
    r = df.select(
        T.floor_minutes("ts", 15).alias("f"), T.ceil_minutes("ts", 15).alias("c"),
        T.trunc_hour("ts").alias("h"),
        T.point_time(F.lit("2024-12-05 00:00:00").cast("timestamp_ntz"), F.lit("PT15M"), F.lit(3)).alias("p15"),
        T.point_time(F.lit("2024-12-05 00:00:00").cast("timestamp_ntz"), F.lit("PT60M"), F.lit(3)).alias("p60"),
        T.point_time(F.lit("2024-12-05 00:00:00").cast("timestamp_ntz"), F.lit("PT30M"), F.lit(3)).alias("p30"),
        T.hourly_point_time(F.lit("2024-12-05 00:00:00").cast("timestamp_ntz"), F.lit(24)).alias("w2"),
        T.parse_market_time(F.lit("2024-12-05T23:00Z")).alias("pm"),
        T.epoch_millis_ntz(F.lit(1733439600000)).alias("em"),
        T.request_stamp(F.lit("2024-12-05 00:00:00").cast("timestamp_ntz")).alias("rs"),
    ).first()
    assert r.f == dt.datetime(2024, 12, 5, 23, 0) and r.c == dt.datetime(2024, 12, 5, 23, 15)
    assert r.h == dt.datetime(2024, 12, 5, 23)
    assert r.p15 == dt.datetime(2024, 12, 5, 0, 45) and r.p60 == dt.datetime(2024, 12, 5, 3)
    assert r.p30 is None
    assert r.w2 == dt.datetime(2024, 12, 6, 0)
    assert r.pm == dt.datetime(2024, 12, 5, 23) and r.em == dt.datetime(2024, 12, 5, 23)
    assert r.rs == "202412050000"


def test_session_zone_does_not_change_results(spark):
    df = spark.range(1).select(F.lit("2024-03-31 01:30:00").cast("timestamp_ntz").alias("ts"))
    q = df.select(T.trunc_hour("ts").alias("h"), T.floor_minutes("ts", 15).alias("f"))
    before = q.first()
    spark.conf.set("spark.sql.session.timeZone", "Europe/Berlin")
    try:
        assert q.first() == before
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


def test_keep_first_and_last(spark):
    rows = [("a", 1, 10.0, 3), ("a", 1, 11.0, 1), ("a", 2, 12.0, 2), ("b", 1, None, 5), ("b", 1, 1.0, 6)]
    df = spark.createDataFrame(rows, "k string, t int, q double, ingest_order long")
    first = {(r.k, r.t): r.q for r in keep_first(df, ["k", "t"]).collect()}
    assert first == {("a", 1): 11.0, ("a", 2): 12.0, ("b", 1): None}
    last = {(r.k, r.t): r.q for r in keep_first(df, ["k", "t"], keep="last").collect()}
    assert last[("a", 1)] == 10.0 and last[("b", 1)] == 1.0
    # idempotent
    once = keep_first(df, ["k", "t"], keep_order=True)
    assert sorted(map(tuple, keep_first(once, ["k", "t"]).collect())) == \
        sorted(map(tuple, keep_first(df, ["k", "t"]).collect()))


def test_pivot_first_matches_pandas(spark):
    rows = [("z", 1, "Solar", 1.0, 2), ("z", 1, "Solar", 5.0, 1), ("z", 1, "Wind", 2.0, 3),
            ("z", 2, "Wind", 4.0, 4), ("y", 1, "Other", 7.0, 5)]
    df = spark.createDataFrame(rows, "eic_code string, t int, typ string, quantity double, ingest_order long")
    got = {(r.eic_code, r.t): (r.solar, r.wind) for r in
           pivot_first(df, ["eic_code", "t"], "typ", "quantity", ["Solar", "Wind"], ["solar", "wind"]).collect()}
    pdf = pd.DataFrame(rows, columns=["eic_code", "t", "typ", "quantity", "ingest_order"]).sort_values("ingest_order")
    pdf = pdf.drop_duplicates(subset=["eic_code", "t", "typ"])
    wide = pdf.pivot(index=["eic_code", "t"], columns="typ", values="quantity")
    for (e, t), row in wide.iterrows():
        exp = tuple(None if pd.isna(row.get(c)) else row.get(c) for c in ["Solar", "Wind"])
        assert got[(e, t)] == exp
