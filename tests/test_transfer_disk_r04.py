"""transfer_all_tables: what an export and its way back take of the disk."""
import glob
import os
import random
import string

from pyspark.sql import functions as F

from tableops.plans import transfer
from tableops.sources import delimited


def size(pattern):
    return sum(map(os.path.getsize, glob.glob(pattern)))


def test_exports_are_gzipped_and_bounded(spark, tmp_dir, monkeypatch):
    monkeypatch.setattr(transfer, "FILE_ROWS", 300)
    df = spark.range(2000, numPartitions=2).select(
        "id", (F.col("id") % 5).cast("double").alias("x"),
        F.concat(F.lit("line\n\"of\" "), F.col("id") % 9).alias("s"))
    got = transfer.transfer_dataset(spark, {"t": df}, f"{tmp_dir}/exp", f"{tmp_dir}/tgt").first()
    assert got.matched and got.rows_after == 2000
    files = glob.glob(f"{tmp_dir}/exp/t/part-*")
    assert len(files) >= 7 and all(f.endswith(".csv.gz") for f in files)
    back = spark.read.parquet(f"{tmp_dir}/tgt/t")
    assert back.exceptAll(df).count() == 0 and df.exceptAll(back).count() == 0


def test_texts_of_quoted_records_move_once(spark, tmp_dir, monkeypatch):
    rng = random.Random(3)
    rows = ['h1,h2'] + [
        f'{i},"{"".join(rng.choices(string.ascii_letters + string.digits, k=600))}\n{i}"'
        for i in range(2500)]
    path = f"{tmp_dir}/q"
    os.makedirs(path)
    with open(f"{path}/a.csv", "w", encoding="utf-8") as f:
        f.write("\n".join(rows) + "\n")
    monkeypatch.setattr(delimited, "PIECE_LINES", 64)
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    where = [f"{d}/*/shuffle_*.data" for d in manager.localDirs()]
    before = {f for w in where for f in glob.glob(w)}
    found = delimited.quoted_records(spark, path, ",", True, "UTF-8")
    found.write.parquet(f"{tmp_dir}/out")
    moved = sum(os.path.getsize(f) for w in where for f in glob.glob(w) if f not in before)
    assert moved < 1.5 * size(f"{path}/a.csv")
    got = {r._text for r in spark.read.parquet(f"{tmp_dir}/out").collect()}
    assert got == set(rows[1:])
