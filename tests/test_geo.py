from tableops.operators.geo import point_in_polygon


def _poly(spark, rows):
    return spark.createDataFrame(
        rows, "poly_id string, name string, layer string, "
              "rings array<array<struct<x double, y double>>>")


def _sq(a, b):
    return [{"x": a, "y": a}, {"x": b, "y": a}, {"x": b, "y": b}, {"x": a, "y": b}, {"x": a, "y": a}]


def _hits(spark, pts, polys):
    p = spark.createDataFrame(pts, "id int, px double, py double")
    return sorted((r.id, r.poly_id) for r in point_in_polygon(p, polys).collect())


def test_square_boundary_is_outside(spark):
    polys = _poly(spark, [("A", "a", "l", [_sq(0.0, 4.0)])])
    pts = [(1, 1.0, 1.0), (2, 0.0, 1.0), (3, 4.0, 1.0), (4, 4.0, 4.0), (5, 2.0, 0.0), (6, 5.0, 1.0)]
    assert _hits(spark, pts, polys) == [(1, "A")]
    assert _hits(spark, pts, polys) == [(1, "A")]


def test_hole_and_overlap(spark):
    polys = _poly(spark, [("A", "a", "l", [_sq(0.0, 10.0), _sq(4.0, 6.0)]),
                          ("B", "b", "l", [_sq(3.0, 8.0)])])
    pts = [(1, 5.0, 5.0), (2, 1.0, 1.0), (3, 7.0, 7.0)]
    assert _hits(spark, pts, polys) == [(1, "B"), (2, "A"), (3, "A"), (3, "B")]


def test_brute_force_agreement(spark):
    import random
    rnd = random.Random(7)
    tri = [{"x": 0.0, "y": 0.0}, {"x": 9.0, "y": 1.0}, {"x": 3.0, "y": 8.0}]
    polys = _poly(spark, [("T", "t", "l", [tri])])
    pts = [(i, rnd.uniform(-1, 10), rnd.uniform(-1, 10)) for i in range(300)]

    def inside(x, y):
        c = False
        for i in range(3):
            x1, y1 = tri[i]["x"], tri[i]["y"]
            x2, y2 = tri[(i + 1) % 3]["x"], tri[(i + 1) % 3]["y"]
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                c = not c
        return c
    expect = sorted((i, "T") for i, x, y in pts if inside(x, y))
    assert _hits(spark, pts, polys) == expect


def test_one_large_and_many_small_polygons(spark):
    from pyspark.sql import functions as F

    from tableops.operators.geo import polygon_cells, polygon_edges, with_strips
    rows = [("HUGE", "h", "l", [_sq(0.0, 100_000.0)])] + [
        (f"s{i}", "s", "l", [_sq(float(10 * i), 10 * i + 5.0)]) for i in range(2000)]
    poly = with_strips(polygon_edges(_poly(spark, rows))).withColumn(
        "poly_row", F.monotonically_increasing_id())
    cells = polygon_cells(poly)
    assert cells.count() <= 4 * len(rows)
    # candidates (same level and cell) stay near the hits: the huge one and the own one
    pts = [(i, 10 * i + 1.0, 10 * i + 1.0) for i in range(2000)]
    points = spark.createDataFrame(pts, "id long, px double, py double")
    w = F.pow(F.lit(2.0), F.col("level"))
    met = points.join(cells, (F.floor(F.col("px") / w) == F.col("cx"))
                      & (F.floor(F.col("py") / w) == F.col("cy")))
    assert met.count() <= 3 * 2 * len(pts)
    assert _hits(spark, pts, _poly(spark, rows)) == sorted(
        [(i, "HUGE") for i in range(2000)] + [(i, f"s{i}") for i in range(2000)])


def test_hot_cell_points(spark):
    polys = _poly(spark, [("A", "a", "l", [_sq(0.0, 100.0)]), ("B", "b", "l", [_sq(40.0, 60.0)])])
    # a third of the points fall into one small area (one grid cell)
    pts = [(i, 50.0 + (i % 97) / 1000.0, 50.0 + (i % 89) / 1000.0) for i in range(1000)] + \
          [(1000 + i, (i * 37) % 130 - 15.0 + 0.5, (i * 53) % 130 - 15.0 + 0.5) for i in range(2000)]
    got = _hits(spark, pts, polys)

    def inside(x, y, lo, hi):
        return lo < x < hi and lo < y < hi
    expect = sorted([(i, "A") for i, x, y in pts if inside(x, y, 0.0, 100.0)]
                    + [(i, "B") for i, x, y in pts if inside(x, y, 40.0, 60.0)])
    assert got == expect


def test_geojson_multipolygon_layer(spark, tmp_dir):
    import json
    import os
    from tableops.sources.polygons import read_geojson_lines
    sq = lambda a, b: [[a, a], [b, a], [b, b], [a, b], [a, a]]
    feats = [
        {"type": "Feature", "properties": {"ID": "M", "NWMLS": "x", "Name": "multi",
                                           "Layer": "L", "Path": "p"},
         "geometry": {"type": "MultiPolygon", "coordinates": [[sq(0, 2)], [sq(5, 7), sq(5.5, 6.5)]]}},
        {"type": "Feature", "properties": {"ID": "P", "Name": "poly"},
         "geometry": {"type": "Polygon", "coordinates": [sq(1, 6)]}},
        {"type": "Feature", "properties": {"ID": "X"},
         "geometry": {"type": "Point", "coordinates": [1, 1]}},
    ]
    os.makedirs(f"{tmp_dir}/layer")
    with open(f"{tmp_dir}/layer/l.json", "w") as fh:
        fh.write("\n".join(json.dumps(f) for f in feats))
    layer = read_geojson_lines(spark, f"{tmp_dir}/layer")
    assert sorted(r.poly_id for r in layer.collect()) == ["M", "P"]
    pts = [(1, 1.0, 1.0), (2, 6.0, 6.0), (3, 5.2, 5.2), (4, 3.0, 3.0)]
    # (1, 1) is a corner of P (outside P); (6, 6) is in the hole of M and a corner of P
    assert _hits(spark, pts, layer) == [(1, "M"), (3, "M"), (3, "P"), (4, "P")]


def _even_odd(x, y, rings):
    """Inside, by all edges; None on an edge."""
    c = False
    for ring in rings:
        for i in range(len(ring)):
            (x1, y1), (x2, y2) = ring[i], ring[(i + 1) % len(ring)]
            if ((x2 - x1) * (y - y1) == (y2 - y1) * (x - x1) and min(x1, x2) <= x <= max(x1, x2)
                    and min(y1, y2) <= y <= max(y1, y2)):
                return False
            if (y1 > y) != (y2 > y) and x < (x2 - x1) * (y - y1) / (y2 - y1) + x1:
                c = not c
    return c


def test_large_shapes_meet_points_by_strips(spark):
    import math
    import random

    from pyspark.sql import functions as F

    from tableops.operators import geo
    rng = random.Random(5)
    n = 3000
    coast = [(r * math.cos(2 * math.pi * i / n), r * math.sin(2 * math.pi * i / n))
             for i in range(n) for r in [rng.uniform(8, 10)]]
    shapes = {"coast": [coast, [(-2.0, -2.0), (2.0, -2.0), (2.0, 2.0), (-2.0, 2.0)]],
              # edges as high as the shape, parts with a gap between them, no height
              "saw": [[(i / 50, 9.0 if i % 2 else -9.0) for i in range(400)] + [(8.0, -10.0), (0.0, -10.0)]],
              "parts": [[(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)],
                        [(0.0, 7.0), (1.0, 7.0), (1.0, 8.0), (0.0, 8.0)]],
              "flat": [[(0.0, 3.0), (5.0, 3.0), (2.0, 3.0)]]}
    polys = _poly(spark, [(k, k, "l", [[{"x": x, "y": y} for x, y in r] for r in rings])
                          for k, rings in shapes.items()])
    spots = [(rng.uniform(-11, 11), rng.uniform(-11, 11)) for _ in range(700)]
    spots += coast[::100] + [(0.5, 0.0), (0.5, 7.0), (0.5, 7.5), (0.5, 4.0), (1.0, 3.0), (0.02, 0.0), (0.0, 1.0)]
    pts = [(i, x, y) for i, (x, y) in enumerate(spots)]
    want = sorted((i, k) for i, x, y in pts for k, rings in shapes.items() if _even_odd(x, y, rings))
    assert _hits(spark, pts, polys) == want
    poly = geo.with_strips(geo.polygon_edges(polys)).withColumn("poly_row", F.col("poly_id"))
    size = geo.strip_edges(poly).groupBy("poly_row").agg(
        F.max(F.size("edges")).alias("most"), F.sum(F.size("edges")).alias("all"), F.count("*").alias("n"))
    got = {r.poly_row: r for r in size.collect()}
    assert got["coast"].most < 400 and got["coast"].n > 40
    assert all(got[k]["all"] <= 4 * sum(map(len, rings)) for k, rings in shapes.items())
