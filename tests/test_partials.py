"""Kept sums of the dashboard, and map geometry."""

import json
import os
import uuid

from pyspark.sql import functions as F

from voltlake.plans import partials, reports
from voltlake.plans.catalogue import measurements_fact
from voltlake.sources import geojson, lake

SF = "/root/testdata/sf0.001"


def test_only_touched_days_are_rewritten(spark):
    fact, name = measurements_fact(spark, SF), f"fact_{uuid.uuid4().hex[:8]}"
    lake.write_fact(fact, name)
    kept = partials.table_of(name)
    partials.refresh(spark, name, kept)
    files = lambda: {r.f for r in spark.table(kept).select(F.col("_metadata.file_path").alias("f")).distinct().collect()}
    before = files()
    days = [r.day for r in spark.table(name).select("day").distinct().orderBy("day").limit(2).collect()]
    doubled = spark.table(name).where(F.col("day").isin(days)).withColumn("production_quantity_solar", F.col("production_quantity_solar") * 2).drop("day")
    lake.write_fact(doubled.checkpoint(), name)
    partials.refresh(spark, name, kept, days)
    assert {f for f in before if not any(f"day={d}" in f for d in days)} == {f for f in files() if not any(f"day={d}" in f for d in days)}
    now = spark.table(name)
    for got, want in ((partials.green_share(spark.table(kept), decimals=4), reports.green_share(now, decimals=4)),
                      (partials.green_share_country(spark.table(kept), decimals=4), reports.green_share_country(now, decimals=4)),
                      (partials.available_hours(spark.table(kept)), reports.available_hours(now))):
        assert got.exceptAll(want).count() == 0 and got.count() == want.count()
    hour = reports.available_hours(now).first()[0]
    one = partials.green_share(spark.table(kept), hour=hour, decimals=4)
    assert one.exceptAll(reports.green_share(now, hour=hour, decimals=4)).count() == 0 and one.count() > 0
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString()
    partials.refresh(spark, name, kept, [])


def test_shapes(spark, tmp_dir):
    square = [[0, 0], [4, 0], [4, 4], [0, 4], [0, 0]]
    hole = [[1, 1], [2, 1], [2, 2], [1, 2], [1, 1]]
    geometries = [{"type": "Polygon", "coordinates": [square, hole]}, {"type": "MultiPolygon", "coordinates": [[square], [[[10, -1.5], [11, 0], [10, 1]]]]},
                  {"type": "Point", "coordinates": [1, 2]}]
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"name": f"n{i}"}, "geometry": g} for i, g in enumerate(geometries)]}
    path = os.path.join(tmp_dir, "f.json")
    with open(path, "w") as f:
        json.dump(doc, f)
    rows = {r.name: r for r in geojson.shapes(geojson.read_features(spark, path)).collect()}
    a, b, c = (rows[f"n{i}"] for i in range(3))
    assert (a.n_polygons, a.n_rings, a.n_positions, a.closed, a.west, a.south, a.east, a.north, a.area) == (1, 2, 10, 1, 0, 0, 4, 4, 15)
    assert (b.n_polygons, b.n_rings, b.n_positions, b.closed, b.west, b.south, b.east, b.north, b.area) == (2, 2, 8, 0, 0, -1.5, 11, 4, 17.25)
    assert c.kind == "Point" and c.n_polygons is None and c.west is None
