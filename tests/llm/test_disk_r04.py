"""What operators leave on disk: no shuffle files, no folders that nothing reads."""
import glob
import os
import random

import corpus_pipeline as cp
import pytest
from odd_rows import SCHEMA, odd_documents, sentence
from pyspark.sql import functions as F

from tableops.llm import bwt_dedup, ngram_join
from tableops.llm.components import components
from tableops.session import _CLEANUP, ensure_checkpoint_dir, land, shuffles_removed, work_dir


def shuffle_files(spark):
    manager = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()
    return {f for d in manager.localDirs() for f in glob.glob(f"{d}/*/shuffle_*.data")}


def folders(spark):
    return set(glob.glob(ensure_checkpoint_dir(spark).removeprefix("file:") + "/work/*"))


def left(spark, before):
    """Names of the work folders that came after ``before``."""
    return sorted(os.path.basename(f).rsplit("-", 1)[0] for f in folders(spark) - before)


@pytest.fixture()
def documents(spark):
    rng = random.Random(4)
    rows = odd_documents()
    rows += [(300 + i, sentence(rng, 60), "en", f"s{i % 3}", 1, 1, "n", 2, "p", 3, 4, "r")
             for i in range(20)]
    return spark.createDataFrame(rows, SCHEMA)


def test_landing_leaves_no_shuffle_files(spark):
    before = shuffle_files(spark)
    df = land(spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count(),
              work_dir(spark, "t"))
    assert sorted(r["count"] for r in df.collect())[-1] == 143
    assert shuffle_files(spark) <= before
    assert spark.conf.get(_CLEANUP, None) is None


def test_a_named_setting_stays(spark):
    spark.conf.set(_CLEANUP, "false")
    try:
        with shuffles_removed(spark), shuffles_removed(spark):
            assert spark.conf.get(_CLEANUP) == "false"
        assert spark.conf.get(_CLEANUP) == "false"
    finally:
        spark.conf.unset(_CLEANUP)


def test_near_duplicates_and_passages_leave_their_result(spark, documents):
    for run, name in ((ngram_join.near_duplicates, "grouped"), (bwt_dedup.deduplicate, "marks")):
        folders_, files = folders(spark), shuffle_files(spark)
        result = run(documents)
        assert left(spark, folders_) == [name]
        # a count or a minimum that goes to the driver may leave a little
        assert sum(map(os.path.getsize, shuffle_files(spark) - files)) < 10_000
        assert result.count() == documents.count()


def test_components_leave_their_last_round(spark):
    chain = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    before = folders(spark)
    got = components(chain)
    assert left(spark, before) == ["edges"]
    assert {r.id: r.component for r in got.collect()} == {i: 0 for i in range(41)}


def test_pipeline_leaves_its_result(spark, documents, tmp_dir):
    documents.write.parquet(f"{tmp_dir}/documents.parquet")
    before = folders(spark)
    result = cp.run(spark, tmp_dir)
    assert left(spark, before) == ["stage-packing"]
    assert result.count() > 0
