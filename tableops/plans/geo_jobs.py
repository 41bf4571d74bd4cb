"""R14 ``geocode_job`` and R15 ``area_tag_job``: worklist -> enrichment ->
JSON lines, each a single distributed job ending in a file write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators import geo
from ..sinks.writers import write_text_lines


def area_tag_job(points: DataFrame, done: DataFrame, polygons: DataFrame,
                 out_path: str) -> str:
    """S11 -> T14 -> J5 -> T20 -> K6 over points ``(id, record_source,
    latitude, longitude)`` not yet processed."""
    todo = geo.missing_worklist(points, done, "id")
    matches = geo.point_in_polygon(geo.to_web_mercator(todo), polygons)
    recs = geo.area_records(matches)
    recs.select(F.to_json(F.struct(*geo.AREA_FIELDS), {"ignoreNullFields": "false"})
                .alias("json")).write.mode("overwrite").text(out_path)
    return out_path


def geocode_job(addresses: DataFrame, done: DataFrame, responses: DataFrame,
                out_path: str) -> str:
    """S11 -> J6 -> T19 -> K6 over ``(id, api_address, record_source)``."""
    todo = geo.missing_worklist(addresses, done, "id")
    write_text_lines(geo.geocode_enrich(todo, responses), "json", out_path)
    return out_path
