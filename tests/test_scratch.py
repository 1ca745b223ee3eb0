import os
import threading

from pyspark.sql import functions as F

from panelcast import session


def shuffle_files(spark):
    root = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString()
    return {f for d in root for at, _, names in os.walk(d) for f in names if f.startswith("shuffle_") and f.endswith(".data")}


def test_a_written_table_leaves_no_shuffle_files(spark):
    before, was = shuffle_files(spark), spark.conf.get(session._CLEANED, None)
    rows = spark.range(20_000).repartition(3).groupBy((F.col("id") % 997).alias("k")).count()
    written = session.materialize(rows, "no-shuffles")
    assert not shuffle_files(spark) - before
    assert written.agg(F.sum("count")).first()[0] == 20_000 and rows.count() == 997  # and the plan can run again
    assert spark.conf.get(session._CLEANED, None) == was


def test_the_setting_comes_back_after_the_last_thread(spark):
    was = spark.conf.get(session._CLEANED, None)
    inside, go = threading.Event(), threading.Event()

    def other():
        with session.shuffles_dropped(spark):
            inside.set()
            go.wait(20)

    t = threading.Thread(target=other)
    with session.shuffles_dropped(spark):
        t.start()
        inside.wait(20)
    assert spark.conf.get(session._CLEANED) == "true"
    go.set()
    t.join()
    assert spark.conf.get(session._CLEANED, None) == was
