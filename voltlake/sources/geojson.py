"""GeoJSON features for the map.

Features keep their name and the geometry as JSON text, joined to the
per-country map data; ``shapes`` parses polygons and multipolygons into rings
and derives what a map needs to place them. Drawing is not rebuilt.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from voltlake.constants import BZN_TO_COUNTRY

FEATURES_SCHEMA = ("type STRING, features ARRAY<STRUCT<type: STRING, id: STRING, "
                   "properties: STRUCT<name: STRING>, geometry: STRING>>")


def read_features(spark: SparkSession, path: str) -> DataFrame:
    """One row per feature: name, geometry (JSON text)."""
    j = spark.read.option("multiLine", True).schema(FEATURES_SCHEMA).json(path)
    f = j.select(F.explode("features").alias("f"))
    return f.select(F.col("f.properties.name").alias("name"), F.col("f.geometry").alias("geometry"))


def map_countries(features: DataFrame, countries: Sequence[str] | None = None) -> DataFrame:
    """features of the mapped countries only."""
    names = list(dict.fromkeys(countries or [c for _, c in BZN_TO_COUNTRY]))
    return features.filter(F.col("name").isin(*names))


def attach_features(features: DataFrame, country_data: DataFrame) -> DataFrame:
    """Features left-joined to the map data on ``name`` = ``country``."""
    j = features.join(country_data, features["name"] == country_data["country"], "left")
    return j.select("name", "geometry", *[country_data[c] for c in country_data.columns if c != "country"])


def features_of(docs: DataFrame, body_col: str = "body") -> DataFrame:
    """S27 over documents that have landed as text, one feature collection a row."""
    j = docs.select(F.from_json(body_col, FEATURES_SCHEMA).alias("j")).select(F.explode("j.features").alias("f"))
    return j.select(F.col("f.properties.name").alias("name"), F.col("f.geometry").alias("geometry"))


def _area(ring: Column) -> Column:
    """Planar area of a ring (closed or not), by its corners."""
    def term(p, i):
        q = F.coalesce(F.get(ring, i + 1), F.get(ring, F.lit(0)))
        return F.get(p, F.lit(0)) * F.get(q, F.lit(1)) - F.get(q, F.lit(0)) * F.get(p, F.lit(1))
    return F.abs(F.reduce(F.transform(ring, term), F.lit(0.0), lambda a, b: a + b)) / 2


def shapes(features: DataFrame) -> DataFrame:
    """One row per feature: number of polygons, rings and corners, whether every ring is closed (it ends where it began, with four
    positions at least), the bounding box in degrees, and the planar area without holes. Other geometries have nulls."""
    kind = F.get_json_object("geometry", "$.type")
    ring = "array<array<array<double>>>"
    one = F.array(F.from_json("geometry", f"coordinates {ring}")["coordinates"])
    many = F.from_json("geometry", f"coordinates array<{ring}>")["coordinates"]
    polygons = F.when(kind == "Polygon", one).when(kind == "MultiPolygon", many)
    rings = F.flatten("_polygons")
    closed = F.forall(rings, lambda r: (F.size(r) >= 4) & (F.get(r, F.lit(0)) == F.element_at(r, -1)))
    lon = F.transform(F.flatten(rings), lambda p: F.get(p, F.lit(0)))
    lat = F.transform(F.flatten(rings), lambda p: F.get(p, F.lit(1)))

    def inner(polygon):
        areas = F.transform(polygon, _area)
        return 2 * F.get(areas, F.lit(0)) - F.reduce(areas, F.lit(0.0), lambda a, b: a + b)  # the first ring less the others

    area = F.reduce(F.transform("_polygons", inner), F.lit(0.0), lambda a, b: a + b)
    return features.withColumn("_polygons", polygons).select(
        *features.columns, kind.alias("kind"),
        F.when(F.col("_polygons").isNotNull(), F.size("_polygons")).alias("n_polygons"),
        F.when(F.col("_polygons").isNotNull(), F.size(rings)).alias("n_rings"),
        F.when(F.col("_polygons").isNotNull(), F.size(F.flatten(rings))).alias("n_positions"),
        closed.cast("int").alias("closed"), F.array_min(lon).alias("west"), F.array_min(lat).alias("south"),
        F.array_max(lon).alias("east"), F.array_max(lat).alias("north"), area.alias("area"))
