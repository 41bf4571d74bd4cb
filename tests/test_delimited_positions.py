"""Where a record breaks a rule, line ends inside of quotes, strict reads of split files."""
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tableops.plans.loader import load_file
from tableops.sources import delimited


def write(path, text):
    with open(path, "wb") as fh:
        fh.write(text.encode("latin-1"))
    return path


def walk(record, names, sep):
    """Field starts of a record by the parser's rules, one character at a time."""
    starts, i, unclosed = [0], 0, False
    while True:
        if record[i:i + 1] == '"':
            i += 1
            while i < len(record) and (record[i] != '"' or record[i + 1:i + 2] == '"'):
                i += 1 if record[i] != '"' else 2
            if i >= len(record):
                unclosed = True
                break
            i += 1
        while i < len(record) and record[i] != sep:
            i += 1
        if i >= len(record):
            break
        i += 1
        starts.append(i)
    n = len(starts)
    if n > len(names):
        return (f"too many fields: {n} instead of {len(names)}", len(names) + 1,
                starts[len(names)] + 1, names[-1])
    if unclosed:
        return "quoted field is not closed", n, starts[-1] + 1, names[n - 1]
    if n < len(names):
        return (f"too few fields: {n} instead of {len(names)}", n + 1, len(record) + 1, names[n])
    return "line after a quoted field that is not closed", None, 1, None


@pytest.mark.parametrize("sep", [",", ";", "\t"])
def test_error_positions_match_a_walk(spark, sep):
    rng = random.Random(2)
    names = ["a", "b", "c"]
    records = ["".join(rng.choice(['"', '"', sep, "x", " ", '""', "\n", "é"]) for _ in range(
        rng.randint(0, 12))) for _ in range(400)] + ["", sep, '"', '""', '"' + "x" * 200_000, "y" * 200_000]
    df = spark.createDataFrame([(r,) for r in records], "r string").select(
        "r", delimited.record_error(F.col("r"), names, sep).alias("e"))
    for row in df.collect():
        e = row.e
        got = (e.error, e.field and int(e.field), int(e.character), e.column_name)
        assert got == walk(row.r, names, sep), row.r[:50]


def rejects(spark, folder, text, size=None, fmt="CSV"):
    write(f"{folder}/f.csv", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size or old)
    try:
        res = load_file(spark, f"{folder}/f.csv", "T", fmt, f"{folder}/out")
        return sorted((int(r.line), int(r.character), r.error.split(":")[0], r.column_name)
                      for r in res.rejects(spark, "T").collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_load_errors_have_line_character_and_column(spark, tmp_dir):
    text = 'id;na me;z\n1;x;1\n\n2;y\n3;"q;r";s;t\n \n4;ok;2\n5\n'
    want = [(4, 4, "too few fields", "z"), (5, 11, "too many fields", "z"), (8, 2, "too few fields", "na_me")]
    assert rejects(spark, tmp_dir, text, "9", "CSV_SEMICOLON_DELIMITER") == want
    # with quoted line breaks, and an end that nothing closes
    text = 'id,a,b\n1,"x\ny",2\n2,"p\nq"\n\n3,"r\ns",4,5\n6,7,8\n7,"open,1\n8,1,2\n9\n'
    want = [(4, 8, "too few fields", "b"), (7, 11, "too many fields", "b"),
            (10, 3, "quoted field is not closed", "a"),
            (11, 1, "line after a quoted field that is not closed", None), (12, 2, "too few fields", "a")]
    assert rejects(spark, tmp_dir, text, "19") == want


def good(spark, folder, text, size=None):
    write(f"{folder}/f.csv", text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size or old)
    try:
        raw = delimited.land_delimited(spark, f"{folder}/f.csv", f"{folder}/out")
        return (sorted(tuple(r) for r in delimited.good_rows(raw).collect()),
                raw.filter(f"{delimited.CORRUPT_COL} is not null").count())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_line_ends_inside_quotes_stay(spark, tmp_dir):
    for size in (None, "31"):
        for end in ("\n", "\r\n", "\r"):
            text = end.join(["id,a", '1,"x\r\ny"', "2,b", '3,"p\rq\r"', '4,"u\n\r\nv"', "", "5,c", ""])
            assert good(spark, tmp_dir, text, size) == (
                [("1", "x\r\ny"), ("2", "b"), ("3", "p\rq\r"), ("4", "u\n\r\nv"), ("5", "c")], 0)
        # line ends of all kinds outside of quotes end records
        assert good(spark, tmp_dir, 'id,a\r1,x\n2,y\r\n3,"z\n"\r4,w', size) == (
            [("1", "x"), ("2", "y"), ("3", "z\n"), ("4", "w")], 0)


SCHEMA = T.StructType([T.StructField("n", T.LongType()), T.StructField("odd name", T.StringType()),
                       T.StructField("d", T.DoubleType())])


def strict(spark, folder, text, size=None, **kw):
    with open(f"{folder}/s.csv", "w", encoding="utf-8", newline="") as fh:
        fh.write(text)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size or old)
    try:
        df = delimited.read_strict(spark, f"{folder}/s.csv", SCHEMA, **kw)
        return df.rdd.getNumPartitions(), sorted(tuple(r) for r in df.collect())
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_strict_read_of_one_file_by_many_tasks(spark, tmp_dir):
    rows = [(i, f"é {i}\r\n\"x\", y" if i % 3 else "plain", i / 4) for i in range(500)]
    lines = [",".join([str(n), '"' + s.replace('"', '""') + '"', str(d)]) for n, s, d in rows]
    text = "n,odd name,d\n" + "\n".join(lines) + "\n"
    for size in (None, "999"):
        assert strict(spark, tmp_dir, text, size)[1] == rows
    assert strict(spark, tmp_dir, "\n".join(lines), "999", header=False)[1] == rows
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "999")
    try:
        assert delimited._lines(spark, f"{tmp_dir}/s.csv", ",").rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    for bad in ("x,y,1", "1,y", "1,y,2,3", '1,"open,2'):
        for more in ("", '9,"a\nb",1\n'):
            with pytest.raises(Exception):
                strict(spark, tmp_dir, f"n,odd name,d\n{more}{bad}\n1,z,1\n", "20")
