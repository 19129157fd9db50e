from pyspark.sql import functions as F

from sightline.llm import common


def shuffle_files(spark):
    files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {name for k in range(files.size()) if (name := files.apply(k).getName()).startswith("shuffle_")}


def test_settle_leaves_no_shuffle_files_and_the_setting_as_it_was(spark):
    rows = spark.range(0, 20_000, 1, 4).groupBy((F.col("id") % 500).alias("k")).agg(F.count("*").alias("n"))
    before, setting = shuffle_files(spark), spark.conf.get(common.DROP_SHUFFLES, None)
    there = common.settle(rows)
    assert not shuffle_files(spark) - before
    assert spark.conf.get(common.DROP_SHUFFLES, None) == setting
    assert there.count() == rows.count() == 500 and there.agg(F.sum("n")).first()[0] == 20_000
    assert common.settle(there.join(rows, ["k", "n"])).count() == 500
