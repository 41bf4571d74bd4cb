import json
import os

import pytest
from pyspark.sql import functions as F

from tableops.operators import filesets, paging
from tableops.streaming import form_events


def test_global_rank_is_permutation(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5003).alias("k"))
    ranked = paging.global_rank(df, ["k"], num_partitions=7)
    rows = ranked.orderBy("k").collect()
    assert [r.ranking for r in rows] == list(range(1, 5001))


def test_chunks_bounded(spark):
    ranked = paging.global_rank(spark.range(1234).withColumnRenamed("id", "k"), ["k"])
    sizes = paging.chunk_summary(paging.with_chunks(ranked, 100)).collect()
    assert len(sizes) == 13 and max(r.n_rows for r in sizes) <= 100
    assert paging.total_chunks(spark.range(1234), 100) == 13


def test_group_files_hot_group(spark):
    pairs = spark.range(3000).select(
        F.when(F.col("id") < 1000, F.lit("HOT")).otherwise((F.col("id") % 50).cast("string"))
        .alias("invoice_id"), F.format_string("f%05d", F.col("id")).alias("file_name"))
    seq = filesets.group_files(pairs)
    hot = seq.filter("invoice_id = 'HOT'").agg(F.min("file_seq"), F.max("file_seq"),
                                                F.count("*")).first()
    assert tuple(hot) == (1, 1000, 1000)


def test_repeated_notification_handled_once(spark, tmp_dir):
    rows = [{"row_id": 1, "header": "Smartsheet x", "Record Source": "Form - New Entry",
             "Project Name": "P1"},
            {"row_id": 2, "header": "Smartsheet x", "Record Source": "Form", "Project Name": "P2"}]
    for b in ("b1", "b2"):
        os.makedirs(f"{tmp_dir}/in/{b}")
        with open(f"{tmp_dir}/in/{b}/part.json", "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows))
    form_events.run_available(spark, f"{tmp_dir}/in/b*/*.json", f"{tmp_dir}/out",
                              f"{tmp_dir}/ck", max_files_per_trigger=1)
    notes = spark.read.parquet(f"{tmp_dir}/out/{form_events.NOTIFY_DIR}").collect()
    assert [(r.row_id, r.subject) for r in notes] == [(1, "Project Opportunity: P1")]
    status = spark.read.parquet(f"{tmp_dir}/out/{form_events.STATUS_DIR}").collect()
    assert [(r.row_id, r.new_value) for r in status] == [(1, "Form")]


def test_replayed_batch_is_skipped(spark, tmp_dir):
    from tableops.operators import forms
    rows = spark.createDataFrame(
        [(1, "Form - New Entry", "P1", "change")],
        "row_id long, `Record Source` string, `Project Name` string, kind string")
    for t in forms.FORM_TITLES:
        if t not in rows.columns:
            rows = rows.withColumn(t, F.lit(None).cast("string"))
    for t in ("Value__display", "Comments__display"):
        rows = rows.withColumn(t, F.lit(None).cast("string"))
    run = form_events.process_batch(f"{tmp_dir}/out", 1)
    run(rows, 7)
    run(rows, 7)          # replay of the same batch id: nothing is sent again
    run(rows, 8)          # a new batch is processed
    form_events.process_batch(f"{tmp_dir}/out", 1, "other")(rows, 7)  # another stream's batch
    notes = spark.read.parquet(f"{tmp_dir}/out/{form_events.NOTIFY_DIR}")
    assert sorted((r.stream_id, r.batch_id) for r in notes.collect()) == [
        ("other", 7), ("stream", 7), ("stream", 8)]


def test_replication_resumes_only_the_same_source(spark, tmp_dir):
    from tableops.plans import replicate
    src = spark.range(0, 2345).select((F.col("id") * 3).alias("k"), (F.col("id") % 7).alias("v"))
    target = f"{tmp_dir}/replica"
    copy = lambda s, key=("k",), **kw: replicate.replicate_table(
        spark, s, "t", target, list(key) if key else None, batch=500, **kw)
    rows = lambda: sorted((r.k, r.v) for r in replicate.read_copy(spark, target).collect())
    first = copy(src, max_chunks=2)
    again = copy(src)
    assert (first.total_chunks, first.written_chunks) == (5, 2)
    assert (again.skipped_chunks, again.written_chunks) == (2, 3)
    assert rows() == sorted((i * 3, i % 7) for i in range(2345))
    # low keys arrive while a run is open: all rows once, none of the old chunks
    copy(src, max_chunks=3)
    more = src.unionByName(spark.range(1, 6).select((-F.col("id")).alias("k"),
                                                    F.lit(0).cast("long").alias("v")))
    changed = copy(more)
    assert changed.skipped_chunks == 0 and len(rows()) == 2350
    # a smaller source leaves nothing behind, and a full run copies again
    assert copy(src.limit(30)).written_chunks == 1 and len(rows()) == 30
    with pytest.warns(UserWarning):
        assert copy(src.limit(50), key=None).written_chunks == 1
    assert len(rows()) == 50


def test_zip_parts_split_hot_group(spark):
    files = spark.range(2500).select(
        F.when(F.col("id") < 2000, F.lit("HOT")).otherwise(F.lit("small")).alias("g"),
        F.format_string("f%05d.txt", F.col("id")).alias("file_name"),
        F.encode(F.format_string("x%d", F.col("id")), "UTF-8").alias("content"))
    z = filesets.archive_contents(filesets.zip_bundles(files, "g", files_per_archive=200))
    per = {r.group_id: r for r in z.groupBy("group_id").agg(
        F.count("*").alias("parts"), F.sum("n_entries").alias("n"),
        F.max("n_entries").alias("biggest")).collect()}
    assert per["HOT"].n == 2000 and per["HOT"].parts == 10 and per["HOT"].biggest < 300
    assert per["small"].n == 500 and per["small"].parts <= 3


def test_replicate_tables_reports_each(spark, tmp_dir):
    from tableops.plans import replicate
    frames = {"a": spark.range(1200).withColumnRenamed("id", "k"),
              "b": spark.range(30).withColumnRenamed("id", "x")}
    keys = spark.createDataFrame([("a", "k", 1), ("b", "missing_col", 1)],
                                 "table_name string, column_name string, key_ordinal int")
    out = {r.table_name: r for r in
           replicate.replicate_tables(spark, frames, keys, f"{tmp_dir}/rep", batch=500).collect()}
    assert out["a"].status == "copied" and out["a"].total_chunks == 3
    assert out["b"].status == "failed" and out["b"].error
    assert replicate.read_copy(spark, f"{tmp_dir}/rep/a").count() == 1200


def test_watermark_dedupe_and_challenges_ignored(spark, tmp_dir):
    rows1 = [{"row_id": 1, "header": "Smartsheet x", "event_time": "2024-01-01T00:00:00",
              "Record Source": "Form - New Entry", "Project Name": "P1"},
             {"row_id": 9, "header": "Smartsheet-Hook-Challenge: y",
              "event_time": "2024-01-01T00:00:00", "Record Source": "Form - New Entry",
              "Project Name": "P9"}]
    rows2 = [dict(rows1[0], event_time="2024-01-01T00:05:00"),
             {"row_id": 2, "header": "Smartsheet x", "event_time": "2024-01-01T00:06:00",
              "Record Source": "Form - New Entry", "Project Name": "P2"}]
    for b, rows in (("b1", rows1), ("b2", rows2)):
        os.makedirs(f"{tmp_dir}/in/{b}")
        with open(f"{tmp_dir}/in/{b}/part.json", "w") as fh:
            fh.write("\n".join(json.dumps(r) for r in rows))
    form_events.run_available(spark, f"{tmp_dir}/in/b*/*.json", f"{tmp_dir}/out",
                              f"{tmp_dir}/ck", max_files_per_trigger=1, watermark="1 hour")
    notes = spark.read.parquet(f"{tmp_dir}/out/{form_events.NOTIFY_DIR}").collect()
    assert sorted(r.row_id for r in notes) == [1, 2]
