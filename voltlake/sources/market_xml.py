"""Market XML documents: generation (A75), day-ahead price (A44), load.

Input is a DataFrame of landed documents, one XML text per row (for example
``spark.read.text(dir, wholetext=True)`` or a landed-documents table).
Parsing is ``from_xml`` with an explicit schema (executors parse their own
documents; nothing reaches the driver), then ``TimeSeries -> Period -> Point``
are exploded and positions become timestamps with ``point_time`` (W1).

Semantics (SURVEY T1, T2, F9, S6, S10, X12):
* zone = in-domain, else out-domain (generation); a series with neither is an
  error (``on_missing_zone='error'``) or is dropped / kept with null zone;
* default: each Period is dated by its own start and resolution;
  ``first_period_only=True`` reproduces the reference's search, which dates
  every point by the series' (load: the document's) first Period;
* a bad number fails the read (``mode='FAILFAST'``, as the reference raises);
  ``mode='PERMISSIVE'`` turns the whole document into null instead;
* ``ignore_namespace=True`` reads prefixed tags (``<n:TimeSeries>``);
* with a ``status`` column, only status 200 documents are read (skip policy).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from voltlake.constants import PSR_TYPES
from voltlake.functions import timefn as T
from voltlake.operators.keys import sequential_ids
from voltlake.operators.lookup import lookup

# Document-order key of every parsed point (keep-first after a round trip).
ORDER = "ingest_order"
#: Points of one document, and documents, that an order key has room for; beyond, the read fails.
ORDER_POINTS = 1 << 20
ORDER_DOCUMENTS = 1 << 43


def document_order(seq: Column, ix: Column) -> Column:
    """One BIGINT that orders points by document and place in it: unique if ``seq`` is unique per document."""
    fits = (ix < ORDER_POINTS) & (seq >= 0) & (seq < ORDER_DOCUMENTS)
    return F.when(fits, seq * F.lit(ORDER_POINTS) + ix).otherwise(F.raise_error(F.format_string(
        "no order key for point %s of document %s", ix.cast("string"), seq.cast("string"))).cast("long"))

_PERIOD = ("timeInterval: STRUCT<start: STRING, `end`: STRING>, resolution: STRING, "
           "Point: ARRAY<STRUCT<position: INT, {point}>>")

GENERATION_SCHEMA = (
    "TimeSeries ARRAY<STRUCT<`inBiddingZone_Domain.mRID`: STRING, `outBiddingZone_Domain.mRID`: STRING, "
    "`quantity_Measure_Unit.name`: STRING, MktPSRType: STRUCT<psrType: STRING>, "
    f"Period: ARRAY<STRUCT<{_PERIOD.format(point='quantity: DOUBLE')}>>>>"
)
PRICE_SCHEMA = (
    "TimeSeries ARRAY<STRUCT<`currency_Unit.name`: STRING, `price_Measure_Unit.name`: STRING, "
    "`in_Domain.mRID`: STRING, `out_Domain.mRID`: STRING, "
    f"Period: ARRAY<STRUCT<{_PERIOD.format(point='`price.amount`: DOUBLE')}>>>>"
)
LOAD_SCHEMA = (
    "TimeSeries ARRAY<STRUCT<`outBiddingZone_Domain.mRID`: STRING, `quantity_Measure_Unit.name`: STRING, "
    f"Period: ARRAY<STRUCT<{_PERIOD.format(point='quantity: DOUBLE')}>>>>"
)


def accepted(docs: DataFrame, status_col: str = "status") -> DataFrame:
    """S10 skip policy of the market feeds: non-200 responses are left out."""
    if status_col in docs.columns:
        return docs.filter(F.col(status_col) == 200)
    return docs


def _parse(docs: DataFrame, xml_col: str, schema: str, mode: str, ignore_namespace: bool) -> DataFrame:
    opts = {"mode": mode}
    if ignore_namespace:
        opts["ignoreNamespace"] = "true"
    keep = [c for c in docs.columns if c != xml_col]
    seq = F.col("doc_seq").cast("long") if "doc_seq" in docs.columns else F.lit(0).cast("long")
    return accepted(docs).select(*keep, seq.alias("_seq"), F.from_xml(F.col(xml_col), schema, opts).alias("_doc"))


def _zone_check(zone: Column, on_missing_zone: str) -> Column:
    if on_missing_zone == "error":
        return F.when(zone.isNull(), F.raise_error(F.lit(
            "a series names no bidding zone, neither an in-domain nor an out-domain"))
        ).otherwise(zone)
    return zone


def _some(arrays: Column) -> Column:
    """Arrays of arrays as one; missing ones count as empty."""
    return F.flatten(F.filter(arrays, lambda a: a.isNotNull()))


def _points(docs: DataFrame, keep: list[str], fields, first_period_only: bool, use=None) -> DataFrame:
    """One row per Point of every document, in document order: ``keep``, the
    series' ``fields`` (name -> function of the series), ``_start``,
    ``_resolution``, ``_pt`` and the order key. One generate per document;
    ``use`` selects the series that count."""
    series = F.col("_doc.TimeSeries")
    if use is not None:
        series = F.filter(series, use)

    def of(s: Column, p: Column, first: Column) -> Column:
        dated = first if first_period_only else p
        return F.transform(p["Point"], lambda pt: F.struct(
            *[f(s).alias(n) for n, f in fields.items()], dated["timeInterval"]["start"].alias("_start"),
            dated["resolution"].alias("_resolution"), pt.alias("_pt")))

    pts = _some(F.transform(series, lambda s: _some(F.transform(s["Period"], lambda p: of(s, p, s["Period"][0])))))
    return docs.select(*keep, "_seq", F.posexplode(pts).alias("_ix", "_e")) \
        .select(*keep, "_e.*", document_order(F.col("_seq"), F.col("_ix")).alias(ORDER))


def _stamp() -> Column:
    return T.point_time(T.sql_parse_market_time("_start"), "_resolution", "_pt.position")


def parse_generation(docs: DataFrame, xml_col: str = "xml", mode: str = "FAILFAST",
                     ignore_namespace: bool = False, first_period_only: bool = False,
                     on_missing_zone: str = "error", keep: list[str] | None = None) -> DataFrame:
    """S3: ``production_data`` rows (eic_code, quantity, unit,
    produced_energy_type, datetime); unknown type codes give a null type."""
    keep = list(keep or [])
    d = _parse(docs, xml_col, GENERATION_SCHEMA, mode, ignore_namespace)

    def zone(s: Column) -> Column:
        return F.coalesce(s.getField("inBiddingZone_Domain.mRID"), s.getField("outBiddingZone_Domain.mRID"))

    pts = _points(d, keep, {
        "eic_code": lambda s: _zone_check(zone(s), on_missing_zone),
        "unit": lambda s: s.getField("quantity_Measure_Unit.name"),
        "_psr": lambda s: s["MktPSRType"]["psrType"],
    }, first_period_only, (lambda s: zone(s).isNotNull()) if on_missing_zone == "drop" else None)
    return pts.select(
        *keep, "eic_code", F.col("_pt.quantity").alias("quantity"), "unit",
        lookup("_psr", PSR_TYPES).alias("produced_energy_type"),
        _stamp().alias("datetime"), ORDER)


def parse_price(docs: DataFrame, xml_col: str = "xml", mode: str = "FAILFAST",
                ignore_namespace: bool = False, first_period_only: bool = False,
                hourly_positions: bool = False, keep: list[str] | None = None) -> DataFrame:
    """``price_data`` rows (eic_code from out-domain, price, currency_unit,
    price_measure_unit, datetime). ``hourly_positions=True`` is W2: every
    position counts one hour whatever the resolution (the daily report)."""
    keep = list(keep or [])
    d = _parse(docs, xml_col, PRICE_SCHEMA, mode, ignore_namespace)
    pts = _points(d, keep, {
        "eic_code": lambda s: s.getField("out_Domain.mRID"),
        "currency_unit": lambda s: s.getField("currency_Unit.name"),
        "price_measure_unit": lambda s: s.getField("price_Measure_Unit.name"),
    }, first_period_only)
    if hourly_positions:
        stamp = T.hourly_point_time(T.sql_parse_market_time("_start"), "_pt.position")
    else:
        stamp = _stamp()
    return pts.select(*keep, "eic_code", F.col("_pt.`price.amount`").alias("price"),
                      "currency_unit", "price_measure_unit", stamp.alias("datetime"),
                      F.col("_pt.position").alias("position"), ORDER)


def parse_load(docs: DataFrame, xml_col: str = "xml", mode: str = "FAILFAST",
               ignore_namespace: bool = False, first_period_only: bool = False,
               keep: list[str] | None = None) -> DataFrame:
    """``consumption_data`` rows (eic_code, quantity, unit, datetime).

    Default: each series keeps its own zone/unit and each Period its own
    start/resolution. ``first_period_only=True`` is the reference: zone,
    unit, resolution and start all come from the document's first series and
    first Period, and every Point of the document is dated with them (T2).
    """
    keep = list(keep or [])
    d = _parse(docs, xml_col, LOAD_SCHEMA, mode, ignore_namespace)
    if first_period_only:
        ts0 = F.col("_doc.TimeSeries")[0]
        p0 = ts0["Period"][0]
        all_points = _some(F.transform(
            F.col("_doc.TimeSeries"), lambda s: _some(F.transform(s["Period"], lambda p: p["Point"]))))
        pts = d.select(*keep, ts0.getField("outBiddingZone_Domain.mRID").alias("eic_code"),
                       ts0.getField("quantity_Measure_Unit.name").alias("unit"),
                       p0["timeInterval"]["start"].alias("_start"), p0["resolution"].alias("_resolution"),
                       "_seq", F.posexplode(all_points).alias("_ix", "_pt")) \
            .withColumn(ORDER, document_order(F.col("_seq"), F.col("_ix")))
    else:
        pts = _points(d, keep, {
            "eic_code": lambda s: s.getField("outBiddingZone_Domain.mRID"),
            "unit": lambda s: s.getField("quantity_Measure_Unit.name"),
        }, False)
    return pts.select(*keep, "eic_code", F.col("_pt.quantity").alias("quantity"), "unit",
                      _stamp().alias("datetime"), ORDER)


def read_documents(spark, path: str) -> DataFrame:
    """Landed XML files, one document per file, with the file path and
    ``doc_seq``, the file's number by arrival (modification time, then path).

    The numbers come from the files' names and times alone, a row per file."""
    files = spark.read.text(path, wholetext=True)
    own = files.select(F.col("value").alias("xml"), F.col("_metadata.file_path").alias("file_path"))
    names = files.select(F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_modification_time").alias("_at"))
    numbered = sequential_ids(names, ["_at", "file_path"], bucket=F.to_date("_at"), name="doc_seq").drop("_at")
    return own.join(numbered, "file_path").select("xml", "file_path", "doc_seq")
