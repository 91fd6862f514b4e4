"""Hand-written market and weather documents (FIXTURES.md §2)."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from voltlake.sources.breakdown import breakdown_frame, breakdown_range
from voltlake.sources.market_xml import parse_generation, parse_load, parse_price
from voltlake.sources.weather_json import missing_zones, parse_weather

NS_GEN = "urn:iec62325.351:tc57wg16:451-6:generationloaddocument:3:0"
NS_PUB = "urn:iec62325.351:tc57wg16:451-3:publicationdocument:7:3"


def period(start, end, res, points, tag="quantity"):
    pts = "".join(f"<Point><position>{p}</position><{tag}>{v}</{tag}></Point>" for p, v in points)
    return (f"<Period><timeInterval><start>{start}</start><end>{end}</end></timeInterval>"
            f"<resolution>{res}</resolution>{pts}</Period>")


def gen_series(zone_tag, zone, psr, periods, unit="MAW"):
    z = f'<{zone_tag} codingScheme="A01">{zone}</{zone_tag}>' if zone_tag else ""
    return (f"<TimeSeries><mRID>1</mRID>{z}<quantity_Measure_Unit.name>{unit}</quantity_Measure_Unit.name>"
            f"<MktPSRType><psrType>{psr}</psrType></MktPSRType>{''.join(periods)}</TimeSeries>")


def gen_doc(*series):
    return f'<GL_MarketDocument xmlns="{NS_GEN}"><mRID>d</mRID>{"".join(series)}</GL_MarketDocument>'


def docs_df(spark, *texts, status=None):
    rows = [(t, 200 if status is None else status) for t in texts]
    return spark.createDataFrame(rows, "xml string, status int")


def test_gen_two_series(spark):
    doc = gen_doc(
        gen_series("inBiddingZone_Domain.mRID", "10YFI-1--------U", "B16",
                   [period("2024-12-05T23:00Z", "2024-12-06T23:00Z", "PT60M", [(1, 10), (2, 11)])]),
        gen_series("outBiddingZone_Domain.mRID", "10YLT-1001A0008Q", "B19",
                   [period("2024-12-05T23:00Z", "2024-12-06T23:00Z", "PT15M", [(1, 5.5)])]))
    out = sorted(tuple(r) for r in parse_generation(docs_df(spark, doc)).drop("ingest_order").collect())
    assert out == [
        ("10YFI-1--------U", 10.0, "MAW", "Solar", dt.datetime(2024, 12, 6, 0)),
        ("10YFI-1--------U", 11.0, "MAW", "Solar", dt.datetime(2024, 12, 6, 1)),
        ("10YLT-1001A0008Q", 5.5, "MAW", "Wind Onshore", dt.datetime(2024, 12, 5, 23, 15)),
    ]


def test_gen_multi_period_default_and_parity(spark):
    doc = gen_doc(gen_series("inBiddingZone_Domain.mRID", "Z", "B01", [
        period("2024-12-05T00:00Z", "2024-12-05T02:00Z", "PT60M", [(1, 1), (2, 2)]),
        period("2024-12-06T00:00Z", "2024-12-06T01:00Z", "PT15M", [(1, 3)])]))
    d = docs_df(spark, doc)
    default = {r.quantity: r.datetime for r in parse_generation(d).collect()}
    assert default == {1.0: dt.datetime(2024, 12, 5, 1), 2.0: dt.datetime(2024, 12, 5, 2),
                       3.0: dt.datetime(2024, 12, 6, 0, 15)}
    parity = {r.quantity: r.datetime for r in parse_generation(d, first_period_only=True).collect()}
    assert parity[3.0] == dt.datetime(2024, 12, 5, 1)   # dated by the first Period (T2)


def test_gen_unknown_resolution_and_psr(spark):
    doc = gen_doc(
        gen_series("inBiddingZone_Domain.mRID", "Z", "B99",
                   [period("2024-12-05T00:00Z", "2024-12-06T00:00Z", "PT30M", [(1, 1)])]),
        gen_series("inBiddingZone_Domain.mRID", "Z", "B25",
                   [period("2024-12-05T00:00Z", "2024-12-06T00:00Z", "PT60M", [(1, 2)])]))
    rows = {r.quantity: r for r in parse_generation(docs_df(spark, doc)).collect()}
    assert rows[1.0].datetime is None and rows[1.0].produced_energy_type is None
    assert rows[2.0].produced_energy_type == "Energy storage"


def test_gen_no_zone(spark):
    doc = gen_doc(gen_series(None, None, "B01", [period("2024-12-05T00:00Z", "2024-12-06T00:00Z",
                                                         "PT60M", [(1, 1)])]))
    with pytest.raises(Exception, match="names no bidding zone"):
        parse_generation(docs_df(spark, doc)).collect()
    assert parse_generation(docs_df(spark, doc), on_missing_zone="drop").count() == 0


def test_bad_number_strict_and_permissive(spark):
    doc = gen_doc(gen_series("inBiddingZone_Domain.mRID", "Z", "B01", [
        period("2024-12-05T00:00Z", "2024-12-06T00:00Z", "PT60M", [(1, "oops")])]))
    with pytest.raises(Exception):
        parse_generation(docs_df(spark, doc)).collect()
    assert parse_generation(docs_df(spark, doc), mode="PERMISSIVE").count() == 0


def test_prefixed_namespace(spark):
    body = gen_series("inBiddingZone_Domain.mRID", "Z", "B01",
                      [period("2024-12-05T00:00Z", "2024-12-06T00:00Z", "PT60M", [(1, 4)])])
    import re
    pref = re.sub(r"<(/?)([A-Za-z_][\w.]*)", r"<\1n:\2", body)
    doc = f'<n:GL_MarketDocument xmlns:n="{NS_GEN}">{pref}</n:GL_MarketDocument>'
    assert parse_generation(docs_df(spark, doc), on_missing_zone="drop").count() == 0
    got = parse_generation(docs_df(spark, doc), ignore_namespace=True).collect()
    assert [(r.eic_code, r.quantity) for r in got] == [("Z", 4.0)]


def test_status_skip(spark):
    doc = gen_doc(gen_series("inBiddingZone_Domain.mRID", "Z", "B01", [
        period("2024-12-05T00:00Z", "2024-12-06T00:00Z", "PT60M", [(1, 1)])]))
    assert parse_generation(docs_df(spark, doc, status=503)).count() == 0


def price_doc(points, start="2024-12-05T00:00Z", res="PT60M"):
    return (f'<Publication_MarketDocument xmlns="{NS_PUB}"><TimeSeries>'
            f"<currency_Unit.name>EUR</currency_Unit.name><price_Measure_Unit.name>MWH</price_Measure_Unit.name>"
            f"<in_Domain.mRID>10Y1001A1001A39I</in_Domain.mRID><out_Domain.mRID>10Y1001A1001A39I</out_Domain.mRID>"
            f"{period(start, '2024-12-06T00:00Z', res, points, tag='price.amount')}"
            f"</TimeSeries></Publication_MarketDocument>")


def test_price_gaps_and_day_report(spark):
    from voltlake.plans.feeds import price_day_report
    d = spark.createDataFrame([(price_doc([(1, 10), (2, 11), (5, 50), (24, 99)]),
                                dt.datetime(2024, 12, 5), 0)],
                              "xml string, period_start timestamp_ntz, doc_seq long")
    rows = parse_price(d).collect()
    assert {r.datetime for r in rows} == {dt.datetime(2024, 12, 5, h) for h in (1, 2, 5)} | {dt.datetime(2024, 12, 6)}
    rep = {r.datetime.hour: r.price for r in price_day_report(d).collect()}
    assert len(rep) == 24
    assert rep[0] is None                       # leading null stays; position 24 is next day
    assert rep[1] == 10 and rep[3] == 11 and rep[4] == 11 and rep[5] == 50 and rep[23] == 50


def test_load_two_series_default_and_parity(spark):
    s1 = (f"<TimeSeries><outBiddingZone_Domain.mRID>A</outBiddingZone_Domain.mRID>"
          f"<quantity_Measure_Unit.name>MAW</quantity_Measure_Unit.name>"
          f"{period('2024-12-05T00:00Z', '2024-12-06T00:00Z', 'PT60M', [(1, 1)])}</TimeSeries>")
    s2 = (f"<TimeSeries><outBiddingZone_Domain.mRID>B</outBiddingZone_Domain.mRID>"
          f"<quantity_Measure_Unit.name>MAW</quantity_Measure_Unit.name>"
          f"{period('2024-12-07T00:00Z', '2024-12-08T00:00Z', 'PT15M', [(2, 2)])}</TimeSeries>")
    doc = gen_doc(s1, s2)
    d = docs_df(spark, doc)
    default = {r.quantity: (r.eic_code, r.datetime) for r in parse_load(d).collect()}
    assert default == {1.0: ("A", dt.datetime(2024, 12, 5, 1)), 2.0: ("B", dt.datetime(2024, 12, 7, 0, 30))}
    parity = {r.quantity: (r.eic_code, r.datetime) for r in parse_load(d, first_period_only=True).collect()}
    assert parity == {1.0: ("A", dt.datetime(2024, 12, 5, 1)), 2.0: ("A", dt.datetime(2024, 12, 5, 2))}


def weather_body(values, contrib=True):
    loc = {"values": values}
    if contrib:
        loc["stationContributions"] = {"st1": 0.5}
    return json.dumps({"locations": {"59.35,24.8": loc, "other": {"values": []}}})


def test_weather_null_column_and_contributions(spark):
    v_ok = [{"datetime": 1733356800000, "temp": 1.5, "snowdepth": 1.0, "conditions": "Clear"},
            {"datetime": 1733360400000, "temp": 2.5, "conditions": "Rain, Overcast"}]
    v_null = [{"datetime": 1733356800000, "temp": None, "conditions": "Fog"},
              {"datetime": 1733360400000, "temp": 4.0, "conditions": "Fog"}]
    docs = spark.createDataFrame([("EE", weather_body(v_ok), 0), ("PL", weather_body(v_null, False), 1)],
                                 "bzn string, body string, doc_seq long")
    rows = parse_weather(docs).collect()
    ee = [r for r in rows if r.BZN == "EE"]
    pl = [r for r in rows if r.BZN == "PL"]
    assert sorted(r.temp for r in ee) == [1.5, 2.5]
    assert all(r.temp is None for r in pl)                 # column nulled for that document only (T7)
    assert pl[0].EIC == "10YPL-AREA-----S" and pl[0].Country == "Poland"
    assert pl[0].stationContributions == "{}" and ee[0].stationContributions == '{"st1":0.5}'
    assert {r.datetime for r in ee} == {dt.datetime(2024, 12, 5, 0), dt.datetime(2024, 12, 5, 1)}
    missing = {r.bzn for r in missing_zones(docs).collect()}
    assert "EE" not in missing and "PL" not in missing and len(missing) == 15


def test_weather_extra_fields(spark):
    from voltlake.sources.weather_json import EXTRA_FIELDS, VALUE_FIELDS
    v = [{"datetime": 1733356800000, "temp": 1.0, "snowdepth": 2.0, "cloudcover": 50.0},
         {"datetime": 1733360400000, "temp": 2.0, "snowdepth": None, "cloudcover": 60.0}]
    docs = spark.createDataFrame([("EE", weather_body(v))], "bzn string, body string")
    rows = parse_weather(docs, value_fields=VALUE_FIELDS + EXTRA_FIELDS).collect()
    assert sorted(r.cloudcover for r in rows) == [50.0, 60.0]
    assert all(r.snowdepth is None for r in rows)      # a null in this document nulls the column (P8)
    assert all(r.wgust is None for r in rows)


def test_weather_bad_status_raises(spark):
    docs = spark.createDataFrame([("EE", weather_body([]), 429)], "bzn string, body string, status int")
    with pytest.raises(Exception, match="has status"):
        parse_weather(docs).collect()


def test_breakdown(spark):
    body = json.dumps({"zone": "EE", "history": [
        {"datetime": "2024-12-05T00:00:00.000Z", "powerConsumptionBreakdown": {"wind": 1.0},
         "powerProductionBreakdown": {"wind": 2.0, "solar": 3.0}},
        {"datetime": "2024-12-05T01:00:00.000Z", "powerConsumptionBreakdown": {"nuclear": 4.0},
         "powerProductionBreakdown": {"nuclear": 5.0}}]})
    docs = spark.createDataFrame([(body,)], "body string")
    prod = breakdown_frame(docs, "production", ["wind", "solar", "nuclear"])
    rows = sorted(tuple(r) for r in prod.collect())
    assert rows == [("EE", dt.datetime(2024, 12, 5, 0), 2.0, 3.0, None),
                    ("EE", dt.datetime(2024, 12, 5, 1), None, None, 5.0)]
    rng = breakdown_range(prod).first()
    assert rng.start_datetime == dt.datetime(2024, 12, 5, 0) and rng.n_entries == 2
