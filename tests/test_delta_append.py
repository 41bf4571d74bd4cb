"""Delta refresh of a replica, and appends under a token."""
import datetime as dt
import decimal
import json
import os
import threading
import time

import pytest
from pyspark.sql import functions as F

from tableops.plans import delta
from tableops.sinks import commits


def keyed(spark, rows):
    return spark.createDataFrame(rows, "k long, v string, n double")


def rows_of(df):
    return sorted(map(repr, df.collect()))


def check(spark, source, target):
    assert rows_of(delta.read_refreshed(spark, target)) == rows_of(source)


def test_one_percent_change_copies_its_ranges_only(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    first = keyed(spark, [(i, f"v{i}", 1.0) for i in range(10, 10_010)])
    done = delta.refresh_table(first, t, ["k"], batch=100)
    assert (done.ranges, done.copied_ranges, done.copied_rows) == (100, 100, 10_000)
    check(spark, first, t)
    # nothing changed: nothing is written
    assert delta.refresh_table(first, t, ["k"], batch=100).commit is None
    changed = first.withColumn("v", F.when(F.col("k").between(5000, 5099), "new").otherwise(F.col("v")))
    done = delta.refresh_table(changed, t, ["k"], batch=100)
    assert done.copied_ranges in (1, 2) and done.copied_rows <= 200
    check(spark, changed, t)
    # inserts before the first key, deletes inside, rows appended at the end
    moved = changed.filter(~F.col("k").between(7000, 7004)).unionByName(
        keyed(spark, [(i, "low", 2.0) for i in range(-5, 3)] + [(i, "end", 2.0) for i in range(20_000, 20_450)]))
    done = delta.refresh_table(moved, t, ["k"], batch=100)
    assert done.copied_ranges <= 9 and done.copied_rows < 1000
    check(spark, moved, t)
    # the long last range was cut: a change in it copies a part of it
    end = moved.withColumn("n", F.when(F.col("k") == 20_449, 9.0).otherwise(F.col("n")))
    assert delta.refresh_table(end, t, ["k"], batch=100).copied_rows <= 150
    check(spark, end, t)
    # whole ranges without rows disappear, later inserts there find a range
    gap = end.filter(~F.col("k").between(3000, 4000))
    delta.refresh_table(gap, t, ["k"], batch=100)
    check(spark, gap, t)
    delta.refresh_table(end, t, ["k"], batch=100)
    check(spark, end, t)
    before = len(os.listdir(f"{t}/runs"))
    gone = delta.vacuum(spark, t)
    assert gone and len(os.listdir(f"{t}/runs")) == before - len(gone)
    check(spark, end, t)


def test_changed_schema_and_key_start_anew(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    a = keyed(spark, [(i, f"v{i}", 1.0) for i in range(500)])
    delta.refresh_table(a, t, ["k"], batch=100)
    b = a.withColumn("more", F.lit(None).cast("map<string,int>")).withColumn("n", F.col("n").cast("int"))
    assert delta.refresh_table(b, t, ["k"], batch=100).copied_rows == 500
    check(spark, b, t)
    assert delta.refresh_table(b, t, ["v"], batch=100).copied_rows == 500
    check(spark, b, t)


def test_interrupted_refresh_goes_on(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    a = keyed(spark, [(i, f"v{i}", 1.0) for i in range(1000)])
    done = delta.refresh_table(a, t, ["k"], batch=50, steps=4, max_steps=1)
    assert not done.complete and done.copied_ranges == 5
    with pytest.raises(FileNotFoundError):
        delta.read_refreshed(spark, t)
    done = delta.refresh_table(a, t, ["k"], batch=50)
    assert done.complete and done.copied_ranges == 15
    check(spark, a, t)
    # readers keep the last complete commit while a refresh is under way
    b = a.withColumn("n", F.lit(2.0))
    delta.refresh_table(b, t, ["k"], batch=50, steps=2, max_steps=1)
    check(spark, a, t)
    assert delta.refresh_table(b, t, ["k"], batch=50).copied_rows == 500
    check(spark, b, t)


def test_keys_of_any_type_without_key_and_empty(spark, tmp_dir):
    base = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [(f"é{i % 7}\"\\", base + dt.timedelta(microseconds=i), decimal.Decimal(i) / 100, i)
            for i in range(300)] + [(None, base, decimal.Decimal("0.01"), -1), ("z", base, None, -2)]
    df = spark.createDataFrame(rows, "s string, t timestamp_ntz, d decimal(38,2), v long")
    for i, key in enumerate((["s", "t"], ["d"], ["s"], None)):
        t = f"{tmp_dir}/t{i}"
        delta.refresh_table(df, t, key, batch=40)
        check(spark, df, t)
        more = df.unionByName(df.limit(1).withColumn("v", F.lit(1000).cast("long")))
        done = delta.refresh_table(more, t, key, batch=40)
        assert key is None or done.copied_rows < 200
        check(spark, more, t)
    t = f"{tmp_dir}/empty"
    delta.refresh_table(df.limit(0), t, ["v"])
    assert delta.read_refreshed(spark, t).count() == 0
    delta.refresh_table(df, t, ["v"], batch=40)
    check(spark, df, t)
    delta.refresh_table(df.limit(0), t, ["v"], batch=40)
    assert delta.read_refreshed(spark, t).schema == df.schema and delta.read_refreshed(spark, t).count() == 0


def test_changed_scan_is_pushed_down(spark, tmp_dir):
    src = f"{tmp_dir}/src"
    spark.range(0, 10_000).withColumnRenamed("id", "k").write.parquet(src)
    df = spark.read.parquet(src)
    ranges = [delta.Range(i, None if i == 0 else f'{{"k":{i * 100}}}', 1, "", 0, "") for i in range(100)]
    got = df.filter(delta._between(["k"], df.schema, ranges, {40, 42}))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(k,4000)" in plan and "LessThanOrEqual(k,4300)" in plan


def test_append_once_per_token(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    a, b = keyed(spark, [(1, "a", 1.0)]), keyed(spark, [(2, "b", 2.0), (2, "b", 2.0)])
    assert commits.append_table(a, t, "load 1").added
    assert not commits.append_table(a, t, "load 1").added
    assert commits.append_table(b.select("n", "v", F.col("k").cast("string").alias("k")), t, "load/2").added
    assert rows_of(commits.read_appended(spark, t)) == rows_of(a.unionByName(b))
    assert sorted(r.token for r in commits.appended_loads(spark, t).collect()) == ["load 1", "load/2"]
    with pytest.raises(ValueError):
        commits.append_table(a.drop("v"), t, "load 3")
    # a load that dies before its commit leaves no rows, and its token is free
    a.write.parquet(f"{t}/{commits.DATA}/dead")
    assert commits.read_appended(spark, t).count() == 3
    with pytest.raises(Exception):
        commits.append_table(a.withColumn("k", F.lit("no number")), t, "load 4")
    assert commits.append_table(a, t, "load 4").added
    assert commits.read_appended(spark, t).count() == 4


def test_loads_at_once_both_land(spark, tmp_dir):
    t = f"{tmp_dir}/t"
    got = []

    def load(i):
        df = keyed(spark, [(i, "x", 1.0)] * (i % 3 + 1))
        got.append(commits.append_table(df, t, f"token {i % 4}").added)

    threads = [threading.Thread(target=load, args=(i,)) for i in (0, 1, 2, 3)]
    for x in threads:
        x.start()
    for x in threads:
        x.join()
    assert got == [True] * 4
    assert commits.read_appended(spark, t).count() == 1 + 2 + 3 + 1
    load(4)
    assert got[-1] is False and commits.read_appended(spark, t).count() == 7


def test_publish_never_replaces(spark, tmp_dir):
    assert commits.publish(spark, f"{tmp_dir}/c/1", "first é")
    assert not commits.publish(spark, f"{tmp_dir}/c/1", "second")
    assert commits.read_published(spark, f"{tmp_dir}/c/1") == "first é"
    assert commits.published(spark, f"{tmp_dir}/c") == ["1"]
    assert commits.published(spark, f"{tmp_dir}/none") == []


def test_work_of_a_refresh_follows_the_number_of_ranges(spark, tmp_path, monkeypatch):
    """a set of all ranges was built for every range."""
    n = 40_000
    monkeypatch.setattr(delta, "_borders", lambda *a: [f'{{"k":{i}}}' for i in range(n)])
    monkeypatch.setattr(delta, "_copy", lambda source, target, key, schema, ranges, part: [
        delta.Range(r.range_id, r.lower, 1, "1", 1, "run") for r in ranges])
    began = time.monotonic()
    done = delta.refresh_table(spark.range(1).withColumnRenamed("id", "k"), str(tmp_path / "t"), ["k"])
    assert (done.copied_ranges, done.copied_rows) == (n, n)
    assert time.monotonic() - began < 12


def test_whole_numbers_and_texts_are_searched_by_batch(spark):
    """the search of long, int and string keys is one Arrow batch at a time."""
    for kind, borders, keys in [
            ("long", ["-5", "0", "7", str(2**62)], [None, -6, -5, 0, 1, 7, 2**62 - 1, 2**62, 2**63 - 1]),
            ("int", ["3"], [None, 2, 3, 4]),
            ("string", ['"B"', '"a"', '"\\u00e9"', '"\\ud83d\\ude00"'],
             [None, "", "A", "B", "a", "z", "é", "￮", "😀", "😁"])]:
        df = spark.createDataFrame([(k,) for k in keys], f"k {kind}")
        at = delta.position(["k"], df.schema, [f'{{"k":{b}}}' for b in borders])
        got = df.select("k", at.alias("p"))
        assert "ArrowEvalPython" in got._jdf.queryExecution().executedPlan().toString()
        known = [json.loads(b) for b in borders]
        assert {r.k: r.p for r in got.collect()} == {
            k: 0 if k is None else sum(b <= k for b in known) for k in keys}
