"""Polygon layer sources (S12, re-aimed: polygon tables instead of shapefile bytes).

The layer shape used by the geo operators is
``(poly_id, nwmls, name, layer, path, rings array<array<struct<x,y>>>)``:
all rings of all parts, outer rings and holes alike (even-odd rule).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

POINT = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
RINGS = T.ArrayType(T.ArrayType(POINT))
_POLYGON_COORDS = T.ArrayType(T.ArrayType(T.ArrayType(T.DoubleType())))
_MULTI_COORDS = T.ArrayType(_POLYGON_COORDS)

_FEATURE = T.StructType([
    T.StructField("type", T.StringType()),
    T.StructField("properties", T.MapType(T.StringType(), T.StringType())),
    T.StructField("geometry", T.StructType([
        T.StructField("type", T.StringType()),
        T.StructField("coordinates", T.StringType()),   # raw JSON, parsed per type
    ])),
])


def _to_rings(polygon_coords) -> F.Column:
    return F.transform(polygon_coords, lambda ring: F.transform(
        ring, lambda p: F.struct(p[0].alias("x"), p[1].alias("y"))))


def read_geojson_lines(spark: SparkSession, path: str, id_field: str = "ID") -> DataFrame:
    """GeoJSON text sequence: one Feature per line (splittable, so a large
    layer is read by many tasks).  Polygon and MultiPolygon geometries;
    properties ID, NWMLS, Name, Layer, Path as in the reference's layer."""
    f = spark.read.schema(_FEATURE).json(path)
    gtype = F.col("geometry.type")
    coords = F.col("geometry.coordinates")
    rings = (F.when(gtype == "Polygon", _to_rings(F.from_json(coords, _POLYGON_COORDS)))
             .when(gtype == "MultiPolygon",
                   F.flatten(F.transform(F.from_json(coords, _MULTI_COORDS), _to_rings))))
    props = F.col("properties")
    return f.filter(gtype.isin("Polygon", "MultiPolygon")).select(
        props[id_field].alias("poly_id"), props["NWMLS"].alias("nwmls"),
        props["Name"].alias("name"), props["Layer"].alias("layer"),
        props["Path"].alias("path"), rings.alias("rings"))


def write_geojson_lines(polygons: DataFrame, path: str) -> None:
    """Write a polygon layer as GeoJSON lines (each ring list as one Polygon)."""
    coords = F.transform("rings", lambda r: F.transform(r, lambda p: F.array(p["x"], p["y"])))
    feat = F.struct(
        F.lit("Feature").alias("type"),
        F.create_map(F.lit("ID"), F.col("poly_id"), F.lit("NWMLS"), F.col("nwmls"),
                     F.lit("Name"), F.col("name"), F.lit("Layer"), F.col("layer"),
                     F.lit("Path"), F.col("path")).alias("properties"),
        F.struct(F.lit("Polygon").alias("type"), coords.alias("coordinates")).alias("geometry"))
    polygons.select(F.to_json(feat).alias("value")).write.mode("overwrite").text(path)
