"""One failing part must not spoil the others; types and order that the data decide."""
import datetime as dt
import json
import os
import threading

from pyspark.sql import functions as F

from tableops.operators import api, audit, paging, snapshots
from tableops.sources import files
from tableops.streaming import form_events


def test_target_that_cannot_be_read_counts_minus_one(spark, tmp_dir):
    import shutil
    spark.range(7).write.parquet(f"{tmp_dir}/gone")
    gone = spark.read.parquet(f"{tmp_dir}/gone")
    shutil.rmtree(f"{tmp_dir}/gone")
    src = {n: spark.range(3) for n in ("a", "b", "c", "d", "e")} | {"empty": spark.range(0)}
    targets = {"a": spark.range(3), "b": gone, "c": None,
               "d": lambda: spark.read.parquet(f"{tmp_dir}/never"), "empty": spark.range(1)}
    got = {r.table_name: r for r in audit.count_audit(1, src, targets).collect()}
    assert {n: r.target_count for n, r in got.items()} == {"a": 3, "b": -1, "c": -1, "d": -1, "e": -1}
    assert got["a"].target_date is not None and got["b"].target_date is None
    assert audit.count_audit(1, {"a": spark.range(1)}, {}).first().target_count == -1


def results(spark, key, names):
    rows = [(key, n, 1, None, 1, None, "Y") for n in names]
    return spark.createDataFrame(rows, audit.RESULT_SCHEMA)


def test_sources_commit_apart_and_at_once(spark, tmp_dir):
    base = f"{tmp_dir}/res"
    assert audit.read_results(spark, base).count() == 0
    audit.commit_results(base, results(spark, 1, ["a", "b"]), 1)
    before = sorted(os.listdir(f"{base}/source_key=1/data"))
    threads = [threading.Thread(target=audit.commit_results, args=(base, results(spark, k, ["x"] * k), k))
               for k in (2, 3, 2)]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    assert sorted(os.listdir(f"{base}/source_key=1/data")) == before
    got = sorted((r.source_key, r.md_active_flag) for r in audit.read_results(spark, base).collect())
    # both runs of source 2 count, and only the later one is active
    assert got == [(1, "Y"), (1, "Y"), (2, "N"), (2, "N"), (2, "Y"), (2, "Y"), (3, "Y"), (3, "Y"), (3, "Y")]
    assert audit.commit_results(base, results(spark, 3, []), 3).startswith(f"{base}/source_key=3/data/")
    assert audit.read_results(spark, base).count() == 9


def test_odd_snapshot_names_and_no_tables(spark, tmp_dir):
    names = [("zBACKUP_X_99_99_2001",), ("zBACKUP_X_08_01_2001",), ("other",), (None,)]
    plan = snapshots.retention_plan(spark.createDataFrame(names, "name string"), dt.date(2001, 8, 16))
    assert {r.name: (r.snapshot_date, r["drop"]) for r in plan.collect()} == {
        "zBACKUP_X_99_99_2001": (None, False), "zBACKUP_X_08_01_2001": (dt.date(2001, 8, 1), True),
        "other": (None, False), None: (None, False)}
    assert snapshots.snapshot_tables(spark, {}, tmp_dir, "X", dt.date(2001, 8, 16)).count() == 0


def test_file_list_has_every_name(spark, tmp_dir):
    os.makedirs(f"{tmp_dir}/in")
    for name in ("a b.txt", "_b.txt", ".c.txt"):
        with open(f"{tmp_dir}/in/{name}", "w") as fh:
            fh.write(name)
    table = files.file_list_job(spark, f"{tmp_dir}/in", "DOCS", f"{tmp_dir}/out")
    assert sorted(r.FILE_NAME for r in spark.read.parquet(table).collect()) == [
        ".c.txt", "_b.txt", "a b.txt"]


def envelope(header, items, code=2):
    return f"<E><B>{json.dumps({header: items, 'Status': {'Code': code, 'Message': 'm'}})}</B></E>"


def test_element_types_come_from_all_responses(spark):
    rows = [(1, api.PROJECTS, envelope(api.PROJECTS, [{"ID": 1, "Name": "a", "Rate": 1}])),
            (2, api.PROJECTS, envelope(api.PROJECTS, [{"ID": 2**40, "Rate": "n/a", "Odd name": True,
                                                       "In": {"x": [1, 2.5]}, "Never": None}])),
            (3, api.PROJECTS, envelope(api.PROJECTS, [{"ID": 3, "Cost": 0.25}, {"ID": 4, "Cost": 7}])),
            (4, api.PROJECTS, envelope(api.PROJECTS, [{"ID": "not read"}], 5)),
            (5, api.PROJECTS, envelope(api.PROJECTS, [], 11)), (6, api.PROJECTS, "<E>no json</E>"),
            (7, api.FORMS, envelope(api.FORMS, [])), (8, api.TASKS, None)]
    df = spark.createDataFrame(rows, "call_id long, header string, body string")
    types = api.infer_elements(df)
    assert list(types) == [api.PROJECTS]
    assert {f.name: f.dataType.simpleString() for f in types[api.PROJECTS].fields} == {
        "ID": "bigint", "Name": "string", "Rate": "string", "Odd name": "boolean", "Cost": "double",
        "In": "struct<x:array<double>>", "Never": "string"}
    data, retry, errors = api.extract_entities(df)[api.PROJECTS]
    got = {r.ID: r for r in data.collect()}
    assert sorted(got) == [1, 3, 4, 2**40]
    assert (got[1].Rate, got[2**40].Rate, got[3].Cost, got[4].Cost) == ("1", "n/a", 0.25, 7.0)
    assert got[2**40]["Odd name"] is True and got[2**40].In.x == [1.0, 2.5]
    assert [r.call_id for r in retry.collect()] == [5]
    assert sorted(r.call_id for r in errors.collect()) == [4, 6]


def test_positions_follow_the_order(spark):
    df = spark.createDataFrame([("b", 1), ("a", 2), (None, 3), ("a", 1)], "x string, y int").repartition(3)
    got = paging.with_position(df, ["x", "y"]).orderBy("position").collect()
    assert [tuple(r) for r in got] == [(None, 3, 1), ("a", 1, 2), ("a", 2, 3), ("b", 1, 4)]


def notify(folder, name, row_ids):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}.json", "w") as fh:
        fh.write("\n".join(json.dumps({"row_id": i, "header": "Smartsheet x", "event_time": f"2024-01-{i:02d}T00:00:00Z",
                                       "Record Source": "Form - New Entry", "Project Name": f"P{i}"})
                           for i in row_ids))


def test_rows_are_handled_once_without_state(spark, tmp_dir):
    def run(checkpoint, **kw):
        form_events.run_available(spark, f"{tmp_dir}/in", f"{tmp_dir}/out", f"{tmp_dir}/{checkpoint}", **kw)

    def notified():
        return sorted(r.row_id for r in spark.read.parquet(
            f"{tmp_dir}/out/{form_events.NOTIFY_DIR}").collect())

    notify(f"{tmp_dir}/in", "a", [1, 2, 2])
    run("ck")
    notify(f"{tmp_dir}/in", "b", [3, 1])
    notify(f"{tmp_dir}/in", "c", [3, 20])
    run("ck", max_files_per_trigger=1)
    # far beyond any bound on event time
    notify(f"{tmp_dir}/in", "d", [1, 28])
    run("ck")
    assert notified() == [1, 2, 3, 20, 28]
    # the stream keeps no state, and a lost commit or a new checkpoint repeats nothing
    assert not os.path.exists(f"{tmp_dir}/ck/state")
    last = max(int(n) for n in os.listdir(f"{tmp_dir}/ck/commits") if n.isdigit())
    for name in (str(last), f".{last}.crc"):
        if os.path.exists(f"{tmp_dir}/ck/commits/{name}"):
            os.remove(f"{tmp_dir}/ck/commits/{name}")
    run("ck")
    run("ck2")
    assert notified() == [1, 2, 3, 20, 28]
    # a batch that died between its status rows and its marker is done again
    batch = spark.createDataFrame([(5, "P")], "row_id long, name string")
    tags = batch.select("row_id", F.lit(1).cast("long").alias("column_id"), F.lit("Form").alias("new_value"),
                        F.lit("s").alias("stream_id"), F.lit(0).cast("long").alias("batch_id"))
    tags.write.partitionBy("stream_id", "batch_id").parquet(f"{tmp_dir}/out2/{form_events.STATUS_DIR}")
    left = form_events.not_handled(batch, f"{tmp_dir}/out2", "s", 0)
    assert left.count() == 1 and form_events.not_handled(batch, f"{tmp_dir}/out2", "s", 1).count() == 0


def test_state_with_and_without_watermark(spark, tmp_dir):
    notify(f"{tmp_dir}/in", "a", [1, 2, 2])
    notify(f"{tmp_dir}/in", "b", [2, 3])
    for name, kw in (("s", {"keep_state": True}), ("w", {"keep_state": True, "watermark": "2 days"})):
        form_events.run_available(spark, f"{tmp_dir}/in", f"{tmp_dir}/{name}", f"{tmp_dir}/ck{name}", **kw)
        got = spark.read.parquet(f"{tmp_dir}/{name}/{form_events.NOTIFY_DIR}")
        assert sorted(r.row_id for r in got.collect()) == [1, 2, 3]
        assert os.path.exists(f"{tmp_dir}/ck{name}/state")
