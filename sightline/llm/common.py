"""What the corpus operators share: table access, the shared working folder, normalised text."""

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Spark removes a query's shuffle files when the query ends; without it they stay until the driver collects its garbage.
DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: A run of the six ASCII white-space characters that is not already one plain space.
LOOSE_SPACE = r"[\t-\x0D][\x20\t-\x0D]*|\x20[\x20\t-\x0D]+"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder.rstrip('/')}/{name}.parquet")


def work_folder(spark: SparkSession) -> str:
    """A new name below the folder that driver and executors share; only where none is set (tests) one is made."""
    shared = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not shared:
        shared = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/corpus-{uuid.uuid4().hex}"


def settle(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it again: its lineage ends there, so a lost executor
    costs no more than a re-read.  Its shuffle files go once it is written, since nothing runs the same query again."""
    spark = df.sparkSession
    path, before = work_folder(spark), spark.conf.get(DROP_SHUFFLES, None)
    spark.conf.set(DROP_SHUFFLES, True)
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(DROP_SHUFFLES) if before is None else spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)


def one_space(text: Column) -> Column:
    """Each run of ASCII white space becomes one space; null is the empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), LOOSE_SPACE, " ")


def digest_text(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)
