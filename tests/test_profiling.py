import datetime as dt
from decimal import Decimal

from tableops.functions.scalars import normalize_header
from tableops.operators.profiling import profile_columns, typed_projection


def _profile(spark, rows, cols):
    df = spark.createDataFrame(rows, ", ".join(f"{c} string" for c in cols))
    return {p.column_name: p for p in profile_columns(df)}, df


def test_number_inference_and_scale(spark):
    prof, df = _profile(spark, [("1.50", "1.5e3"), ("1,234", "7."), (".5", None), (None, None)],
                        ["a", "b"])
    assert (prof["a"].data_type, prof["a"].scale) == ("NUMBER", 2)
    assert (prof["b"].data_type, prof["b"].scale) == ("NUMBER", 3)
    out = typed_projection(df, list(prof.values())).collect()
    assert out[1]["a"] == Decimal("1234.00")


def test_scale_counts_characters(spark):
    prof, _ = _profile(spark, [("7.",)], ["a"])
    assert prof["a"].scale == 0


def test_not_a_number(spark):
    prof, _ = _profile(spark, [("$5",)], ["a"])
    assert prof["a"].data_type == "VARCHAR"
    assert prof["a"].date_mask == "NOT_A_DATE"


def test_first_matching_format_and_century_pivot(spark):
    prof, df = _profile(spark, [("01-JAN-85",), ("02-FEB-01",), ("01-JAN-79",), ("01-JAN-80",)],
                        ["d"])
    assert (prof["d"].data_type, prof["d"].date_mask) == ("DATETIME", "DD-MON-YY")
    years = [r["d"].year for r in typed_projection(df, list(prof.values())).collect()]
    assert years == [1985, 2001, 2079, 1980]


def test_other_masks_in_order(spark):
    prof, _ = _profile(spark, [("Jan 05, 2019 01:02:03 PM", "2018-", "01/02/2019 03:04 PM",
                                "2018-01-02 03:04:05")], ["a", "b", "c", "d"])
    assert prof["a"].date_mask == "Mon DD, YYYY HH:MI:SS AM"
    assert prof["b"].date_mask == "YYYY-"
    assert prof["c"].date_mask == "MM/DD/YYYY HH12:MI AM"
    assert prof["d"].date_mask == "AUTO"


def test_all_null_column_dropped(spark):
    prof, df = _profile(spark, [("1", None), ("2", None), ("3", None)], ["a", "b"])
    assert prof["b"].data_type is None
    assert typed_projection(df, list(prof.values())).columns == ["a"]


def test_header_names():
    assert normalize_header("Amt. (USD)/net") == "Amt_USD_net"


def test_round_trip_types(spark):
    prof, df = _profile(spark, [("10", "2020-01-01 10:00:00", "x")], ["n", "t", "s"])
    out = typed_projection(df, list(prof.values())).first()
    assert out["n"] == Decimal(10) and out["t"] == dt.datetime(2020, 1, 1, 10) and out["s"] == "x"


def test_tolerant_timestamp_is_exact_local_time(spark):
    from tableops.functions.timestamps import try_timestamp
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        df = spark.createDataFrame([("03/10/2024 02:30 AM",), ("bad",), (None,)], "v string")
        out = [r[0] for r in df.select(try_timestamp("v", "MM/DD/YYYY HH12:MI AM")).collect()]
        assert out == [dt.datetime(2024, 3, 10, 2, 30), None, None]
        prof, _ = _profile(spark, [("03/10/2024 02:30 AM",)], ["d"])
        assert prof["d"].date_mask == "MM/DD/YYYY HH12:MI AM"
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
