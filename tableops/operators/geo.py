"""Geographic enrichment: point-in-polygon area tagging and geocode lookup
(S11, S12, T14, T19, T20, J5, J6).

Point-in-polygon is a grid-cell equi-join followed by an exact test:

* every polygon has a level by its size and meets at most four cells of
  that level's grid;
* every point falls into one cell of each level that the layer has;
* points and polygon boxes meet in an equi-join on (level, cell), so the
  work is a hash/sort-merge join (no nested loop, no cross join);
* a bounding-box filter, then an equi-join on (polygon, strip) with the edges
  that reach into the point's horizontal strip of the polygon, and an exact
  even-odd ray cast over them (holes and multi-part shapes included), as JVM-side
  higher-order functions.  A ray to the side crosses edges of its own strip
  only, so a point meets some ``EDGES_PER_STRIP`` edges however many the shape
  has.  A point on an edge or vertex is outside, like a geometry library's
  ``contains``.

Neither side is broadcast unless AQE sees it is small.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import mercator_x, mercator_y
from ..session import cut_lineage

# ---------------------------------------------------------------------------
# Fixed values that must equal the reference's behaviour
# ---------------------------------------------------------------------------
# The area record: MLS_NAME holds the *name* of the polygon layer's second
# field, a constant.
MLS_NAME_VALUE = "NWMLS"
AREA_FIELDS = ["ID", "RECORD_SOURCE", "MLS_NAME", "MLS_AREA_NAME", "COUNTY", "MLS_AREA_ID"]

# edges of all rings, ring i closes from its last to its first vertex
_EDGES = ("flatten(transform(rings, r -> transform(sequence(0, size(r) - 1), i -> "
          "named_struct('x1', r[i].x, 'y1', r[i].y, "
          "'x2', r[(i + 1) % size(r)].x, 'y2', r[(i + 1) % size(r)].y))))")
_CROSSINGS = ("aggregate(edges, 0, (acc, e) -> acc + IF(((e.y1 > py) <> (e.y2 > py)) AND "
              "(px < (e.x2 - e.x1) * (py - e.y1) / (e.y2 - e.y1) + e.x1), 1, 0))")
_ON_EDGE = ("exists(edges, e -> (e.x2 - e.x1) * (py - e.y1) - (e.y2 - e.y1) * (px - e.x1) = 0 "
            "AND px BETWEEN least(e.x1, e.x2) AND greatest(e.x1, e.x2) "
            "AND py BETWEEN least(e.y1, e.y2) AND greatest(e.y1, e.y2))")


def to_web_mercator(points: DataFrame, lat: str = "latitude", lon: str = "longitude") -> DataFrame:
    """Add ``px``/``py`` in EPSG:3857 metres from EPSG:4326 degrees
    (once per point, not once per polygon)."""
    return points.withColumn("px", mercator_x(lon)).withColumn("py", mercator_y(lat))


def polygon_edges(polygons: DataFrame) -> DataFrame:
    """Polygons with their edge list and bounding box (S12 layer shape:
    ``rings array<array<struct<x double, y double>>>``)."""
    pts = "flatten(rings)"
    return (polygons.withColumn("edges", F.expr(_EDGES))
            .withColumn("minx", F.expr(f"array_min(transform({pts}, p -> p.x))"))
            .withColumn("maxx", F.expr(f"array_max(transform({pts}, p -> p.x))"))
            .withColumn("miny", F.expr(f"array_min(transform({pts}, p -> p.y))"))
            .withColumn("maxy", F.expr(f"array_max(transform({pts}, p -> p.y))")))


def polygon_cells(poly: DataFrame) -> DataFrame:
    """(poly_row, level, cx, cy, bbox) of the grid cells a polygon's box meets.

    A polygon's level is the power of two at or above its larger side, and a
    cell is one level wide, so a polygon meets at most four cells, whatever
    the mix of huge and tiny shapes in the layer."""
    side = F.greatest(F.col("maxx") - F.col("minx"), F.col("maxy") - F.col("miny"))
    level = F.when(side > 0, F.ceil(F.log2(side))).otherwise(F.lit(MIN_LEVEL))
    width = F.pow(F.lit(2.0), F.col("level"))
    return (poly.withColumn("level", F.greatest(level, F.lit(MIN_LEVEL)).cast("int"))
            .withColumn("cx", F.explode(F.sequence(F.floor(F.col("minx") / width),
                                                   F.floor(F.col("maxx") / width))))
            .withColumn("cy", F.explode(F.sequence(F.floor(F.col("miny") / width),
                                                   F.floor(F.col("maxy") / width))))
            .select("poly_row", "level", "cx", "cy", "minx", "maxx", "miny", "maxy", "strips"))


def with_strips(poly: DataFrame) -> DataFrame:
    """Number of horizontal strips of equal height: about ``EDGES_PER_STRIP``
    edges each, and not thinner than the edges are high on average, so that an
    edge lies in two strips or so on average."""
    n = F.size("edges")
    heights = F.aggregate("edges", F.lit(0.0), lambda a, e: a + F.abs(e["y2"] - e["y1"]))
    most = F.least(n / F.lit(EDGES_PER_STRIP),
                   F.when(heights > 0, (F.col("maxy") - F.col("miny")) * n / heights).otherwise(1))
    return poly.withColumn("strips", F.greatest(F.lit(1), F.floor(most)).cast("int"))


def strip_of(y: Column) -> Column:
    """The strip that a height inside of the box lies in (never falls with it)."""
    height = F.col("maxy") - F.col("miny")
    at = F.when(height > 0, F.floor((y - F.col("miny")) * (F.col("strips") / height))).otherwise(0)
    return F.least(F.col("strips") - 1, at).cast("int")


def strip_edges(poly: DataFrame) -> DataFrame:
    """(poly_row, strip, edges): the edges that reach into each strip."""
    low, high = F.least("e.y1", "e.y2"), F.greatest("e.y1", "e.y2")
    return (poly.select("poly_row", "miny", "maxy", "strips", F.explode("edges").alias("e"))
            .withColumn("strip", F.explode(F.sequence(strip_of(low), strip_of(high))))
            .groupBy("poly_row", "strip").agg(F.collect_list("e").alias("edges")))


# Edges of one strip, about.
EDGES_PER_STRIP = 16
# Smallest cell width (2 ** MIN_LEVEL), for points and tiny shapes.
MIN_LEVEL = -30


def point_in_polygon(points: DataFrame, polygons: DataFrame, x: str = "px",
                     y: str = "py") -> DataFrame:
    """One row per (point, containing polygon); a point in k polygons
    gives k rows, in none gives none.  Point columns and polygon columns
    (except the shape) are both kept.

    Points meet polygons by (level, cell), once for each level that the layer
    has (a handful: sides differ by powers of two).  Only boxes travel through
    that join; the pairs whose box holds the point meet the edges of their strip,
    and what is inside then gets the polygon's columns.  A crowded cell or strip is
    a skewed join key, which adaptive execution splits."""
    poly = cut_lineage(with_strips(polygon_edges(polygons)).withColumn(
        "poly_row", F.monotonically_increasing_id()))
    cells = polygon_cells(poly)
    # at most one entry per power of two
    levels = [r["level"] for r in cells.select("level").distinct().collect()]
    level = F.explode(F.array(*[F.lit(v) for v in levels]) if levels
                      else F.array().cast("array<int>"))
    width = F.pow(F.lit(2.0), F.col("level"))
    pts = (points.withColumn("px", F.col(x)).withColumn("py", F.col(y))
           .withColumn("level", level)
           .withColumn("cx", F.floor(F.col("px") / width))
           .withColumn("cy", F.floor(F.col("py") / width)))
    cand = (pts.join(cells, ["level", "cx", "cy"]).filter(
        F.col("px").between(F.col("minx"), F.col("maxx"))
        & F.col("py").between(F.col("miny"), F.col("maxy")))
        .withColumn("strip", strip_of(F.col("py")))
        .drop("level", "cx", "cy", "minx", "maxx", "miny", "maxy", "strips"))
    inside = (F.expr(_CROSSINGS) % 2 == 1) & ~F.expr(_ON_EDGE)
    hits = cand.join(strip_edges(poly), ["poly_row", "strip"]).filter(inside).drop("edges", "strip")
    shapes = poly.drop("rings", "edges", "minx", "maxx", "miny", "maxy", "strips")
    return hits.join(shapes, "poly_row").drop("poly_row")


def area_records(matches: DataFrame) -> DataFrame:
    """The area record per (point, polygon) match."""
    return matches.select(
        F.col("id").alias("ID"), F.col("record_source").alias("RECORD_SOURCE"),
        F.lit(MLS_NAME_VALUE).alias("MLS_NAME"), F.col("name").alias("MLS_AREA_NAME"),
        F.col("layer").alias("COUNTY"), F.col("poly_id").alias("MLS_AREA_ID"))


def missing_worklist(source: DataFrame, done: DataFrame, key: str = "id") -> DataFrame:
    """Source rows still without a result (left-anti join on the key)."""
    return source.join(done.select(key).distinct(), key, "left_anti")


def normalize_address(c) -> F.Column:
    """Address key for lookups: trimmed, upper case, single spaces."""
    col = F.col(c) if isinstance(c, str) else c
    return F.upper(F.regexp_replace(F.trim(col), r"\s+", " "))


def geocode_enrich(worklist: DataFrame, responses: DataFrame) -> DataFrame:
    """J6 + T19: every worklist row ``(id, api_address, record_source)`` with
    the landed geocoding response of its address (left join on the
    normalised address, so a miss still gives a row) and the response
    object extended by ``ID`` and ``RECORD_SOURCE`` (overwriting)."""
    r = responses.select(normalize_address("address").alias("_addr"), "response")
    joined = worklist.withColumn("_addr", normalize_address("api_address")).join(r, "_addr", "left")
    hit = (F.col("response").withField("ID", F.col("id"))
           .withField("RECORD_SOURCE", F.col("record_source")))
    miss = F.struct(F.col("id").alias("ID"), F.col("record_source").alias("RECORD_SOURCE"))
    json = (F.when(F.col("response").isNull(), F.to_json(miss))
            .otherwise(F.to_json(hit, {"ignoreNullFields": "false"})))
    return joined.select("id", "record_source", json.alias("json"))
