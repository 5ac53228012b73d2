import time

import pytest
from pyspark.sql import functions as F

from graphloom.llm.scratch import materialize, table

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    names = {files.apply(i).getName() for i in range(files.size())}
    return {n for n in names if n.startswith("shuffle_")}


@pytest.mark.parametrize("bucketed", [False, True])
def test_working_tables_leave_no_shuffle_files(spark, bucketed):
    before = shuffle_files(spark)
    rows = spark.range(0, 50_000, numPartitions=4).withColumn("k", F.xxhash64("id") % 9_000)
    counts = rows.groupBy("k").count()
    rows = rows.join(counts, "k")
    out = table(rows, "test-shuffles", "k", 4) if bucketed else materialize(rows, "test-shuffles")
    for _ in range(100):  # files go in the background
        if not shuffle_files(spark) - before:
            break
        time.sleep(0.1)
    assert not shuffle_files(spark) - before
    assert out.count() == 50_000 and out.agg(F.sum("count")).first() == rows.agg(F.sum("count")).first()


def test_the_session_keeps_its_setting(spark):
    was = spark.conf.get(CLEANUP, None)
    broken = spark.range(3).select(F.raise_error(F.lit("no")).cast("string").alias("x"))
    for df in (spark.range(3), broken):
        try:
            materialize(df, "test-setting")
        except Exception:
            assert df is broken
        assert spark.conf.get(CLEANUP, None) == was
    spark.conf.set(CLEANUP, "false")
    materialize(spark.range(3), "test-setting")
    assert spark.conf.get(CLEANUP) == "false"
    spark.conf.unset(CLEANUP)
