"""Ordinary inputs that once gave wrong results."""
import datetime as dt
import decimal
import json
import os

import pytest
from pyspark.sql import functions as F

from tableops import session
from tableops.operators import api, audit, forms, relations, softdelete
from tableops.plans import transfer
from tableops.sinks.writers import write_json_lines
from tableops.streaming import form_events


def test_transfer_keeps_every_value(spark, tmp_dir):
    rows = [(1, "a\nb", 1.5, dt.datetime(2024, 1, 2, 3, 4, 5, 678901), [1.25, None], b"\x00\xff"),
            (2, "", None, None, [], b""), (3, None, float("nan"), None, None, None),
            (4, "\\N", 1e-17, None, [0.1], None), (5, "\\", -0.0, None, None, None),
            (6, ' q"uo,te" \r\n\ttail ', 3.0, None, None, None), (7, "\\\\N x", 1.0, None, None, None)]
    schema = ("id long, s string, d double, t timestamp_ntz, a array<double>, b binary")
    df = spark.createDataFrame(rows, schema).repartition(2)
    got = transfer.transfer_dataset(spark, {"t": df}, f"{tmp_dir}/exp", f"{tmp_dir}/tgt").first()
    assert got.matched and got.rows_after == len(rows)
    back = spark.read.parquet(f"{tmp_dir}/tgt/t")
    assert back.schema == df.schema
    assert sorted(map(repr, back.collect())) == sorted(map(repr, df.collect()))


def test_json_lines_keep_microseconds(spark, tmp_dir):
    at = dt.datetime(2024, 1, 2, 3, 4, 5, 678901)
    df = spark.createDataFrame([(1, at)], "id int, t timestamp_ntz")
    write_json_lines(df, f"{tmp_dir}/j")
    line = spark.read.text(f"{tmp_dir}/j").first().value
    assert json.loads(line)["t"] == "2024-01-02T03:04:05.678901"


def test_relationship_keys_of_any_numeric_type(spark):
    parents = spark.createDataFrame([(5,), (10,), (100,)], "k int")
    frames = {"p": parents,
              "d": spark.createDataFrame([(5.0,), (10.0,), (7.5,), (None,)], "k double"),
              "n": spark.createDataFrame([(decimal.Decimal("5.00"),), (decimal.Decimal("100"),)],
                                         "k decimal(38,2)"),
              "s": spark.createDataFrame([("a",)], "k string")}
    edges = [("d", "k", "p", "k"), ("n", "k", "p", "k"), ("s", "k", "s", "k")]
    got = {r.child_table: r for r in relations.check_relationships(frames, edges).collect()}
    assert got["d"].orphan_rows == 1 and got["n"].orphan_rows == 0 and got["s"].orphan_rows == 0
    alone = relations.check_relationships(frames, edges[:1]).first()
    assert alone.orphan_rows == got["d"].orphan_rows


def test_reversed_ranges_and_pages(spark):
    r = spark.createDataFrame([(dt.date(2024, 5, 1), dt.date(2024, 1, 1)),
                               (dt.date(2024, 1, 1), None)], "date_from date, date_to date")
    assert api.request_windows(r).count() == 0
    t = spark.createDataFrame([(0,), (1,), (2500,), (12_345_678,)], "n_rows long")
    pages = api.request_pages(t).groupBy("n_rows").agg(
        F.count("*").alias("n"), F.min("start_row").alias("lo"), F.max("start_row").alias("hi"),
        F.count_distinct("start_row").alias("d"))
    assert {r.n_rows: (r.n, r.lo, r.hi, r.d) for r in pages.collect()} == {
        1: (1, 0, 0, 1), 2500: (3, 0, 2000, 3), 12_345_678: (12346, 0, 12_345_000, 12346)}
    huge = spark.createDataFrame([(600_000_000_000,)], "n_rows long")
    assert api.request_pages(huge).limit(5).count() == 5


def test_cell_updates(spark):
    cells = spark.createDataFrame([(1, 1, "a", "A"), (2, 1, "b", "B")],
                                  "row_id int, column_id int, value string, display_value string")
    ups = spark.createDataFrame([(1, 1, "old", 1), (1, 1, None, 2), (3, 1, "new", 1)],
                                "row_id int, column_id int, new_value string, at int")
    got = {r.row_id: (r.value, r.display_value) for r in
           forms.apply_updates(cells, ups, "at").collect()}
    assert got == {1: (None, None), 2: ("b", "B"), 3: ("new", "new")}


def _notify(folder, name, row_ids):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as fh:
        fh.write("\n".join(json.dumps({"row_id": i, "header": "Smartsheet x",
                                       "Record Source": "Form - New Entry",
                                       "Project Name": f"P{i}"}) for i in row_ids))


def test_stream_restart(spark, tmp_dir):
    def run(ck):
        form_events.run_available(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/{ck}")

    def notified():
        return sorted(r.row_id for r in spark.read.parquet(
            f"{tmp_dir}/out/{form_events.NOTIFY_DIR}").collect())

    _notify(f"{tmp_dir}/in", "a", [1, 2])
    run("ck")
    # the batch was acted on, but its commit got lost
    for name in ("0", ".0.crc"):
        if os.path.exists(f"{tmp_dir}/ck/commits/{name}"):
            os.remove(f"{tmp_dir}/ck/commits/{name}")
    _notify(f"{tmp_dir}/in", "b", [2, 3])
    run("ck")
    assert notified() == [1, 2, 3]
    # a new checkpoint is a new stream: its batch 0 is not the old one
    _notify(f"{tmp_dir}/in", "c", [4])
    run("ck2")
    assert set(notified()) == {1, 2, 3, 4} and notified().count(4) == 1


def test_new_counts_are_taken_once(spark, tmp_dir):
    calls = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            calls.add(b.num_rows)
            yield b

    row = spark.createDataFrame(
        [(1, "t", 5, None, 5, None, "Y")], audit.RESULT_SCHEMA).coalesce(1)
    for _ in range(2):
        seen = row.mapInArrow(count, row.schema)
        audit.commit_results(f"{tmp_dir}/res", seen, 1)
    assert calls.value == 2
    flags = sorted(r.md_active_flag for r in audit.read_results(spark, f"{tmp_dir}/res").collect())
    assert flags == ["N", "Y"]


def test_table_without_delete_flag_is_reported(spark, tmp_dir):
    spark.sql("CREATE DATABASE IF NOT EXISTS sd_src")
    for name, cols in (("with_flag", "1 AS a, false AS _FIVETRAN_DELETED"), ("plain", "1 AS a")):
        spark.sql(f"DROP TABLE IF EXISTS sd_src.{name}")
        spark.sql(f"SELECT {cols}").write.option("path", f"{tmp_dir}/{name}").saveAsTable(
            f"sd_src.{name}")
    got = {r.table_name: (r.view_name, r.status) for r in softdelete.soft_delete_views(
        spark, "sd_src", "sd_rpt").collect()}
    assert got["with_flag"] == ("sd_rpt.with_flag", "created")
    assert got["plain"][0] is None and "_FIVETRAN_DELETED" in got["plain"][1]


def test_checkpoint_folder_must_be_named_on_a_cluster():
    class Context:
        master = "spark://x"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Session:
        sparkContext = Context()
        conf = {}

    with pytest.raises(RuntimeError):
        session.ensure_checkpoint_dir(Session())


def test_hidden_names_are_reported(spark, tmp_dir):
    from tableops.sources import files
    for name in ("a.txt", "_b.txt", ".c.txt"):
        with open(f"{tmp_dir}/{name}", "w") as fh:
            fh.write(name)
    assert [r.file_name for r in files.list_files(spark, tmp_dir).collect()] == ["a.txt"]
    assert files.hidden_files(spark, tmp_dir) == [".c.txt", "_b.txt"]


def test_quoted_line_breaks(spark, tmp_dir):
    from tableops.sources import delimited
    text = ('ID,NOTE\n1,"one\ntwo"\n\n2,plain\n3\n4,"say ""hi""\n\nbye"\n5,a,b\n6,"\u00e9"\n'
            + "".join(f'{i},"x\n{i}"\n' for i in range(10, 400)))
    with open(f"{tmp_dir}/f.csv", "wb") as fh:
        fh.write(text.encode("latin-1"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    for size in (old, "700"):  # also with records that cross splits
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        try:
            raw = delimited.land_delimited(spark, f"{tmp_dir}/f.csv", f"{tmp_dir}/out{size}")
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", old)
        good = {int(r.ID): r.NOTE for r in delimited.good_rows(raw).collect()}
        assert good == {1: "one\ntwo", 2: "plain", 4: 'say "hi"\n\nbye', 6: "\u00e9",
                        **{i: f"x\n{i}" for i in range(10, 400)}}
        bad = delimited.number_rejects(spark, f"{tmp_dir}/f.csv", raw)
        assert sorted((int(r.line), r._corrupt_record) for r in bad.collect()) == [
            (6, "3"), (10, "5,a,b")]


def land(spark, folder, text, size=None):
    """Good rows and (line, text) of the malformed ones, with splits of ``size`` bytes."""
    from tableops.sources import delimited
    with open(f"{folder}/f.csv", "wb") as fh:
        fh.write(text.encode("latin-1"))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", size or old)
    try:
        raw = delimited.land_delimited(spark, f"{folder}/f.csv", f"{folder}/out")
        bad = delimited.number_rejects(spark, f"{folder}/f.csv", raw).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    return (sorted((tuple(r) for r in delimited.good_rows(raw).collect()), key=str),
            sorted((int(r.line), r._corrupt_record) for r in bad))


def test_stray_quotes_open_nothing(spark, tmp_dir):
    stray = 'ID,NOTE\n1,5" pipe\n2,abc\n3,def\n'
    want = [("1", '5" pipe'), ("2", "abc"), ("3", "def")]
    assert land(spark, tmp_dir, stray) == (want, [])
    # beside a record that does hold a line break; also with splits inside it
    tail = '4,"a\nb"\n5," ""x"" "\n7,5"\n8,"e,""\nf"\n9,g\n'
    for size in (None, "9"):
        assert land(spark, tmp_dir, stray + tail, size) == (
            [*want, ("4", "a\nb"), ("5", ' "x" '), ("7", '5"'), ("8", 'e,"\nf'), ("9", "g")], [])


def test_unclosed_quote_is_rejected_by_line(spark, tmp_dir):
    for size in (None, "9"):
        assert land(spark, tmp_dir, 'ID,NOTE\n1,"a\nb"\n2,x\n3,"abc\n4,def\n\n5,5" pipe\n"",""x\n',
                    size)[0][:2] == [("1", "a\nb"), ("2", "x")]
        assert land(spark, tmp_dir, 'ID,NOTE\n1,"a\nb"\n2,x\n3,"abc\n4,def\n\n5,ghi\n', size) == (
            [("1", "a\nb"), ("2", "x")], [(5, '3,"abc'), (6, "4,def"), (8, "5,ghi")])


def test_records_end_where_the_parser_ends_them(spark, tmp_dir):
    import random
    rng = random.Random(11)
    for _ in range(4):
        lines = ["".join(rng.choice(['"', '"', ",", "x", " ", '""']) for _ in range(
            rng.randint(1, 9))) for _ in range(60)]
        # the line before the last closes what is open, and opens nothing
        text = "A,B,C\n" + "\n".join(lines) + '\nx",x\n1,2,3\n'
        good, bad = land(spark, tmp_dir, text, rng.choice([None, "40"]))
        with open(f"{tmp_dir}/f.csv", "wb") as fh:
            fh.write(text.encode())
        want = (spark.read.option("header", True).option("escape", '"').option("nullValue", "")
                .option("multiLine", True).schema("A string, B string, C string, _bad string")
                .option("columnNameOfCorruptRecord", "_bad").csv(f"{tmp_dir}/f.csv").collect())
        key = lambda r: tuple(map(str, r))
        assert sorted(good, key=key) == sorted(
            (tuple(r)[:3] for r in want if r._bad is None), key=key)
        # this reader counts lines of blanks as records
        assert len(bad) == sum(r._bad is not None and bool(r._bad.strip()) for r in want)
