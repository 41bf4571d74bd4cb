"""Steps whose tasks or driver grew with the input."""
import os

import pytest
from pyspark.sql import functions as F

from tableops.operators import filesets, forms
from tableops.sources import delimited, files


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("recursive", [False, True])
def test_tasks_list_and_read_a_folder(spark, tmp_dir, monkeypatch, recursive):
    for name in ["a.txt", "_b.txt", ".c.txt", ".a.txt.crc", "_m=1", "e._COPYING_", "sub dir/f.txt",
                 "sub dir/k/g.txt", "_no/h.txt"]:
        os.makedirs(os.path.dirname(f"{tmp_dir}/{name}"), exist_ok=True)
        with open(f"{tmp_dir}/{name}", "wb") as fh:
            fh.write(name.encode())
    open(f"{tmp_dir}/empty.txt", "wb").close()
    rows = lambda df: sorted(tuple(r) for r in df.collect())

    def found():
        return [rows(files.list_files(spark, tmp_dir, recursive)),
                rows(files.read_files(spark, tmp_dir, recursive)),
                rows(files.hidden_names(spark, tmp_dir))]

    # the driver's file index holds none of the folder's files
    assert not [f for f in files.list_files(spark, tmp_dir, recursive).inputFiles()
                if f.endswith(".txt")]
    monkeypatch.setattr(files, "NAMES_PER_BATCH", 2)
    by_tasks = found()
    monkeypatch.setattr(files, "_mounted_folder", lambda *_: None)
    assert by_tasks == found()
    assert len(by_tasks[0]) == (4 if recursive else 2)


def test_column_titles_do_not_shuffle_the_cells(spark):
    cells = spark.createDataFrame([(1, 1, "a", "A"), (2, 1, "b", "B"), (2, 2, "c", None), (3, 9, "d", "D")],
                                  "row_id long, column_id long, value string, display_value string")
    columns = spark.createDataFrame([(1, "t"), (2, "u")], "column_id long, title string")
    titled = forms.cells_with_titles(cells, columns)
    assert "BroadcastHashJoin" in _plan(titled) and "Exchange hashpartitioning" not in _plan(titled)
    assert sorted((r.row_id, r.title, r.value) for r in titled.collect()) == [
        (1, "t", "a"), (2, "t", "b"), (2, "u", "c")]


def test_archives_are_opened_a_few_at_a_time(spark):
    rows = spark.range(300).select(F.col("id").cast("string").alias("g"), F.lit("x/n.txt").alias("file_name"),
                                   F.encode(F.repeat(F.lit("x"), F.col("id").cast("int")), "UTF-8")
                                   .alias("content"))
    opened = filesets.archive_contents(filesets.zip_bundles(rows, "g"))
    assert "ArrowEvalPython" not in _plan(opened)
    assert sorted((int(r.group_id), r.n_entries, r.n_bytes) for r in opened.collect()) == [
        (i, 1, i) for i in range(300)]


def test_records_cross_pieces_of_a_split(spark, tmp_dir, monkeypatch):
    text = "a,b\n" + "".join(f'{i},"x{i}\n{i}\n\n""q"""\n \n{i},y\n' for i in range(200)) + '7,"open\nz\n'
    with open(f"{tmp_dir}/in.csv", "w", newline="") as fh:
        fh.write(text)

    def records():
        return sorted((r[delimited.LINE_COL], r._text, r._unclosed)
                      for r in delimited.quoted_records(spark, f"{tmp_dir}/in.csv", ",").collect())

    whole = records()
    assert len(whole) == 402 and whole[0][:2] == (2, '0,"x0\n0\n\n""q"""')
    for lines in (1, 3, 64):
        monkeypatch.setattr(delimited, "PIECE_LINES", lines)
        assert records() == whole
