import os

import pytest
from pyspark.sql import types as T

from tableops.plans.loader import STATUS_NO_DATA, load_file
from tableops.sources.delimited import delimiter_for, read_strict


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="latin-1") as fh:
        fh.write(text)


def test_rejects_are_skipped_and_recorded(spark, tmp_dir):
    src = f"{tmp_dir}/in/data.csv"
    _write(src, "id,a,b\n1,x,y\n2,short\n3,p,q,r\n4,m,n\n")
    res = load_file(spark, src, "T1", "CSV", f"{tmp_dir}/out")
    assert sorted(r["id"] for r in res.stage(spark).collect()) == ["1", "4"]
    rej = res.rejects(spark, "T1").collect()
    assert sorted((r["rejected_record"], int(r["line"])) for r in rej) == \
        [("2,short", 3), ("3,p,q,r", 4)]
    final = spark.read.parquet(res.table_path)
    assert final.count() == 2 and str(final.schema["id"].dataType) == "DecimalType(38,0)"


def test_headers_only_creates_no_table(spark, tmp_dir):
    src = f"{tmp_dir}/in/empty.csv"
    _write(src, "a;b\n")
    res = load_file(spark, src, "T2", "CSV_SEMICOLON_DELIMITER", f"{tmp_dir}/out")
    assert res.status == STATUS_NO_DATA and res.table_path is None


def test_header_cleanup_and_tsv(spark, tmp_dir):
    src = f"{tmp_dir}/in/t.tsv"
    _write(src, "Amt. (USD)/net\tName\n1\tx\n")
    res = load_file(spark, src, "T3", "TSV", f"{tmp_dir}/out")
    assert spark.read.parquet(res.table_path).columns == ["Amt_USD_net", "Name"]


def test_unknown_format():
    with pytest.raises(ValueError):
        delimiter_for("PIPE")


def test_strict_load_aborts(spark, tmp_dir):
    src = f"{tmp_dir}/in/bad.csv"
    _write(src, "a,b\n1,2\nx,3\n")
    schema = T.StructType([T.StructField("a", T.IntegerType()), T.StructField("b", T.IntegerType())])
    with pytest.raises(Exception):
        read_strict(spark, src, schema).collect()


def test_reject_line_numbers_with_blank_lines_and_files(spark, tmp_dir):
    _write(f"{tmp_dir}/in2/a.csv", "id,a\n\n1,x\n2,y,z\n \t\n3,w\n4\n")
    _write(f"{tmp_dir}/in2/b.csv", "id,a\n5,v,extra\n6,u\n")
    res = load_file(spark, f"{tmp_dir}/in2", "T4", "CSV", f"{tmp_dir}/out4")
    got = sorted((r["file"].rsplit("/", 1)[-1], r["rejected_record"], int(r["line"]))
                 for r in res.rejects(spark, "T4").collect())
    assert got == [("a.csv", "2,y,z", 4), ("a.csv", "4", 7), ("b.csv", "5,v,extra", 2)]


def test_reject_line_numbers_across_splits(spark, tmp_dir):
    lines = ["id,a"] + [f"{i},v{i}" if i % 7 else f"{i},bad,{i}" for i in range(1, 400)]
    lines.insert(50, "")
    _write(f"{tmp_dir}/in3/big.csv", "\n".join(lines) + "\n")
    expect = sorted((ln, i + 1) for i, ln in enumerate(lines) if ln.count(",") == 2)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    old_cost = spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "256")
    spark.conf.set("spark.sql.files.openCostInBytes", "16")
    try:
        res = load_file(spark, f"{tmp_dir}/in3", "T5", "CSV", f"{tmp_dir}/out5")
        got = sorted((r["rejected_record"], int(r["line"])) for r in res.rejects(spark, "T5").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        spark.conf.set("spark.sql.files.openCostInBytes", old_cost)
    assert got == expect


def test_register_with_source_comment(spark, tmp_dir):
    src = f"{tmp_dir}/in6/My File.csv"
    _write(src, "a,b\n1,x\n")
    load_file(spark, src, "loaded_with_comment", "CSV", f"{tmp_dir}/out6", register=True)
    t = spark.catalog.getTable("loaded_with_comment")
    assert t.description == "Source file: My File.csv"
    assert spark.table("loaded_with_comment").count() == 1
