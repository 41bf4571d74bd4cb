"""Property checks of scalar expressions against plain-Python models."""
import datetime as dt
import math

from hypothesis import given, settings
from hypothesis import strategies as st

from tableops.functions.scalars import (decimal_scale, mercator_x, mercator_y,
                                        normalize_header, normalize_header_col)

TEXT = st.text(alphabet=st.sampled_from(list("0123456789.,-eE $ab/()")), max_size=12)


def _scale_model(v):
    if v is None:
        return None
    pos = v.find(".")
    return 0 if pos < 0 else len(v) - pos - 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.one_of(st.none(), TEXT), min_size=1, max_size=40))
def test_decimal_scale_counts_characters_after_first_point(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "v string")
    got = [r[0] for r in df.select(decimal_scale("v")).collect()]
    assert got == [_scale_model(v) for v in values]


@settings(max_examples=15, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("Ab .(/)_-x")), max_size=15),
                min_size=1, max_size=30))
def test_header_rule_as_expression_equals_python_rule(spark, names):
    df = spark.createDataFrame([(n,) for n in names], "v string")
    got = [r[0] for r in df.select(normalize_header_col("v")).collect()]
    assert got == [normalize_header(n) for n in names]


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(st.floats(-179.9, 179.9), st.floats(-84.9, 84.9)),
                min_size=1, max_size=30))
def test_web_mercator_formula(spark, points):
    df = spark.createDataFrame(points, "lon double, lat double")
    got = df.select(mercator_x("lon"), mercator_y("lat")).collect()
    for (lon, lat), (x, y) in zip(points, got):
        assert math.isclose(x, 6378137.0 * math.radians(lon), rel_tol=1e-12, abs_tol=1e-6)
        assert math.isclose(y, 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(lat) / 2)),
                            rel_tol=1e-12, abs_tol=1e-6)


@settings(max_examples=10, deadline=None)
@given(st.lists(st.dates(dt.date(1980, 1, 1), dt.date(2079, 12, 31)), min_size=1, max_size=30))
def test_two_digit_years_round_trip(spark, days):
    from tableops.functions.timestamps import to_timestamp
    df = spark.createDataFrame([(d.strftime("%d-%b-%y").upper(),) for d in days], "v string")
    got = [r[0].date() for r in df.select(to_timestamp("v", "DD-MON-YY")).collect()]
    assert got == list(days)
