"""Conversions that report what they cannot convert."""
import decimal

from tableops.operators import metadata

COLUMNS = ("table_name string, column_name string, ordinal_position int, target_type string")


def mapped(spark, rows):
    return spark.createDataFrame(rows, COLUMNS)


def test_failing_tables_are_reported_and_others_copied(spark, tmp_dir):
    good = spark.createDataFrame([(1, "2024-01-02 03:04:05", "a"), (2, None, None)], "k int, t string, s string")
    bad = spark.createDataFrame([(i, "x" if i in (3, 5) else str(i), "soon" if i == 5 else None)
                                 for i in range(8)], "k int, n string, t string")
    spark.range(5).write.parquet(f"{tmp_dir}/gone")
    gone = spark.read.parquet(f"{tmp_dir}/gone")
    import shutil
    shutil.rmtree(f"{tmp_dir}/gone")
    frames = {"good": good, "bad": bad, "gone": gone, "unmapped": good, "short": good.drop("t")}
    plan = mapped(spark, [
        ("good", "t", 2, "DATETIME"), ("good", "k", 1, "NUMBER(38, 2)"), ("good", "s", 3, "VARCHAR"),
        ("bad", "k", 1, "VARCHAR"), ("bad", "n", 2, "NUMBER(38, 0)"), ("bad", "t", 3, "DATETIME"),
        ("gone", "id", 1, "VARCHAR"), ("short", "t", 1, "VARCHAR")])
    got = metadata.convert_tables(spark, frames, plan, f"{tmp_dir}/to", {"bad": ["k"]})
    status = {r.table_name: r for r in got.status.collect()}
    assert {n: r.status for n, r in status.items()} == {
        "good": "converted", "bad": "failed", "gone": "failed", "unmapped": "failed", "short": "failed"}
    assert (status["bad"].n_rows, status["bad"].rejected_rows, status["bad"].rejected_values) == (8, 2, 3)
    assert "cannot be converted" in status["bad"].error and status["gone"].error
    assert sorted(got.frames) == ["good"]
    rows = sorted(map(tuple, got.frames["good"].collect()))
    assert [r[0] for r in rows] == [decimal.Decimal("1.00"), decimal.Decimal("2.00")] and rows[1][1] is None
    assert sorted(map(tuple, got.rejects.collect())) == [
        ("bad", '{"k":3}', "n", "x", "NUMBER(38, 0)"), ("bad", '{"k":5}', "n", "x", "NUMBER(38, 0)"),
        ("bad", '{"k":5}', "t", "soon", "DATETIME")]
    kept = metadata.convert_tables(spark, frames, plan, keep_good_rows=True)
    assert {r.table_name: r.status for r in kept.status.collect()}["bad"] == "converted in part"
    assert sorted(r.k for r in kept.frames["bad"].collect()) == ["0", "1", "2", "4", "6", "7"]
    assert [r.key for r in kept.rejects.collect()] == [None] * 3


def test_values_beyond_the_target_and_odd_names(spark):
    df = spark.createDataFrame([(1e40, "9" * 40, float("nan")), (1.5, "1", 2.0)], "`a b` double, `c.d` string, e double")
    got = metadata.convert_tables(spark, {"t": df}, mapped(spark, [
        ("t", "a b", 1, "NUMBER(38, 0)"), ("t", "c.d", 2, "NUMBER(38, 0)"), ("t", "e", 3, "NUMBER(38, 1)")]))
    assert got.status.first().rejected_values == 3 and got.frames == {}
    empty = metadata.convert_tables(spark, {"t": df.limit(0)}, mapped(spark, [("t", "e", 1, "VARCHAR")]))
    assert empty.status.first().status == "converted" and empty.frames["t"].count() == 0
    assert empty.rejects.count() == 0
