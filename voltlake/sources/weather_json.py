"""Weather JSON reader.

Documents: one row per landed file with the zone and window it was fetched
for (partition columns of the landing folder or columns of a table) and the
JSON body. ``from_json`` with an explicit schema; the first location's
``values`` are flattened with ``posexplode`` (document order is kept as the
row order for keep-first), the zone attributes come from the zone table, and the per-file null-column rule (P8) is an
``exists`` over the document's own values array (a document is one row, so
the rule needs no shuffle).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voltlake.functions import timefn as T
from voltlake.functions.textfn import rstrip_tab
from voltlake.sources.market_xml import document_order
from voltlake.sources.zones import zones_frame

VALUE_FIELDS = [
    ("mint", "DOUBLE"), ("maxt", "DOUBLE"), ("temp", "DOUBLE"), ("dew", "DOUBLE"),
    ("humidity", "DOUBLE"), ("wspd", "DOUBLE"), ("wdir", "DOUBLE"), ("precip", "DOUBLE"),
    ("visibility", "DOUBLE"), ("solarenergy", "DOUBLE"), ("solarradiation", "DOUBLE"),
    ("sealevelpressure", "DOUBLE"), ("stationinfo", "STRING"), ("conditions", "STRING"),
]
# Further API fields a caller may ask for (``value_fields``), e.g. cloud cover.
EXTRA_FIELDS = [("cloudcover", "DOUBLE"), ("snowdepth", "DOUBLE"), ("wgust", "DOUBLE"),
                ("windchill", "DOUBLE"), ("heatindex", "DOUBLE"), ("snow", "DOUBLE")]


# Holds the text of a body that isn't the expected JSON.
CORRUPT = "_corrupt"


def weather_schema(fields=VALUE_FIELDS) -> str:
    return ("locations MAP<STRING, STRUCT<values: ARRAY<STRUCT<datetime: BIGINT, "
            + ", ".join(f"{n}: {t}" for n, t in fields)
            + f">>, stationContributions: STRING>>, {CORRUPT} STRING")


WEATHER_SCHEMA = weather_schema()


def require_ok(docs: DataFrame, status_col: str = "status", body_col: str = "body") -> DataFrame:
    """S10 weather policy: a non-200 response is an error, not a skip. The
    check guards the body column, so it cannot be pruned away."""
    if status_col not in docs.columns:
        return docs
    return docs.withColumn(body_col, F.when(
        F.col(status_col) != 200,
        F.raise_error(F.format_string("weather document of zone %s has status %s",
                                      F.col("bzn"), F.col(status_col).cast("string")))
    ).otherwise(F.col(body_col)))


def _read(docs: DataFrame, body_col: str, fields) -> DataFrame:
    """docs with ``_d`` (the parsed body) and ``_broken``: no JSON of the expected shape, or no location in it."""
    opts = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    d = docs.withColumn("_d", F.from_json(F.col(body_col), weather_schema(fields), opts))
    broken = F.col("_d").isNull() | F.col(f"_d.{CORRUPT}").isNotNull() | \
        (F.coalesce(F.size(F.map_values(F.col("_d.locations"))), F.lit(0)) < 1)
    return d.withColumn("_broken", broken)


def _zones(docs: DataFrame, zones: DataFrame | None) -> DataFrame:
    z = zones if zones is not None else zones_frame(docs.sparkSession)
    return z.select("bzn", F.col("country").alias("Country"), F.col("eic_raw").alias("_eic"))


def quarantine(docs: DataFrame, body_col: str = "body", zones: DataFrame | None = None) -> DataFrame:
    """The documents that ``parse_weather(on_bad='skip')`` leaves out, with the reason."""
    d = _read(docs, body_col, VALUE_FIELDS).join(_zones(docs, zones), "bzn", "left")
    reason = F.when(F.col("_broken"), "broken body").when(F.col("_eic").isNull(), "unknown zone")
    return d.withColumn("reason", reason).where("reason is not null").select(*docs.columns, "reason")


def parse_weather(docs: DataFrame, body_col: str = "body", drop_null_columns: bool = True,
                  value_fields=VALUE_FIELDS, zones: DataFrame | None = None, on_bad: str = "error") -> DataFrame:
    """``weather_data`` rows: API value fields + Country, EIC, BZN,
    stationContributions (JSON text, '{}' when absent), datetime (NTZ).

    ``docs`` needs ``bzn`` (zone the file was fetched for); an optional
    ``doc_seq``, unique per document, gives the document order of
    ``ingest_order``. ``zones`` are those of ``read_zones`` (the mapper file),
    by default the shipped ones. A broken body or a zone that isn't among them
    is an error; ``on_bad='skip'`` leaves such documents out, and
    ``quarantine`` returns them.
    ``value_fields`` lists the (name, SQL type) value fields to read; fields
    absent from a document are null (as the union of per-file frames).
    """
    d = _read(require_ok(docs, body_col=body_col), body_col, value_fields).join(_zones(docs, zones), "bzn", "left")
    if on_bad == "skip":
        d = d.where(~F.col("_broken") & F.col("_eic").isNotNull())
    else:
        what = F.when(F.col("_broken"), "broken body").when(F.col("_eic").isNull(), "unknown zone")
        d = d.withColumn("_d", F.when(what.isNull(), F.col("_d")).otherwise(F.raise_error(
            F.format_string("weather document of zone %s: %s", F.coalesce("bzn", F.lit("?")), what))))
    seq = F.col("doc_seq") if "doc_seq" in d.columns else F.lit(0)
    d = d.select("bzn", "Country", "_eic", seq.cast("long").alias("_seq"), "_d")
    loc = F.get(F.map_values(F.col("_d.locations")), F.lit(0))
    fields = [n for n, _ in value_fields]
    # P8 per document, before the explode: a field with any null in this
    # document's values is nulled for the whole document (no shuffle needed,
    # a document is one row here)
    def _has_null(field):
        return lambda v: v[field].isNull()
    complete = {n: ~F.exists(loc["values"], _has_null(n)) for n in fields} if drop_null_columns else {}
    rows = d.select("bzn", "Country", "_eic", "_seq",
                    F.coalesce(loc["stationContributions"], F.lit("{}")).alias("stationContributions"),
                    *[c.alias(f"_ok_{n}") for n, c in complete.items()],
                    F.posexplode(loc["values"]).alias("_ix", "_v"))
    value = {n: (F.when(F.col(f"_ok_{n}"), F.col(f"_v.{n}")) if n in complete else F.col(f"_v.{n}"))
             for n in fields}
    return rows.select(
        *[value[n].alias(n) for n in fields],
        "Country", rstrip_tab("_eic").alias("EIC"), F.col("bzn").alias("BZN"),
        "stationContributions",
        T.epoch_millis_ntz(F.col("_v.datetime")).alias("datetime"),
        document_order(F.col("_seq"), F.col("_ix")).alias("ingest_order"))


def missing_zones(docs: DataFrame, zones: DataFrame | None = None) -> DataFrame:
    """Zones of the mapper (``read_zones``; by default the shipped ones) with no landed weather document."""
    z = zones if zones is not None else zones_frame(docs.sparkSession)
    return z.select("country", "bzn").join(docs.select("bzn").distinct(), "bzn", "left_anti")
