"""Structured Streaming jobs: late-settling days, revision logs, idempotent operations, sliding windows."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from sightline.operators.periods import common_end
from sightline.operators.quality import is_fresh
from sightline.operators.revisions import append_plan, latest
from sightline.sources.sinks import replace_days, shared_folder


def run_available(stream: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process everything that has landed and stop."""
    query = stream.writeStream.outputMode(mode).format("parquet").option("checkpointLocation", checkpoint).trigger(availableNow=True).start(path)
    query.awaitTermination()


def landed_stream(spark: SparkSession, folder: str, file_glob: str) -> DataFrame:
    """Parquet files of a folder as a stream, with the schema of what lies there now."""
    schema = spark.read.option("pathGlobFilter", file_glob).parquet(folder).schema
    return spark.readStream.schema(schema).option("pathGlobFilter", file_glob).parquet(folder)


def settled_days(stream: DataFrame, instant: str, keys: list[str], measures: dict[str, Column], delay: str = "10 days") -> DataFrame:
    """Daily totals that appear once, when a day has had its time to settle."""
    return (stream.withWatermark(instant, delay).groupBy(F.window(instant, "1 day"), *keys).agg(*[m.alias(n) for n, m in measures.items()])
            .select(F.to_date("window.start").alias("date"), *keys, *measures))


def sliding_windows(stream: DataFrame, instant: str, keys: list[str], measures: dict[str, Column], width: str = "28 days",
                    step: str = "7 days", delay: str = "1 day") -> DataFrame:
    """Overlapping field windows, each emitted when it is complete."""
    return (stream.withWatermark(instant, delay).groupBy(F.window(instant, width, step), *keys).agg(*[m.alias(n) for n, m in measures.items()])
            .select(F.to_date("window.start").alias("first_day"), F.to_date("window.end").alias("end_day"), *keys, *measures))


def replace_pulls(stream: DataFrame, table: str, sort: list[str], checkpoint: str, lookback: int = 10) -> StreamingQuery:
    """Every landed pull replaces its own look-back range of days in a daily table; a repeated pull changes nothing.

    ``stream`` rows carry ``date``, ``pull_end`` and the table's columns.
    """
    def write(batch: DataFrame, _: int) -> None:
        newest = batch.groupBy("pull_end").agg(F.count(F.lit(1)).alias("n")).orderBy("pull_end").collect()
        for pull in newest:
            end = pull["pull_end"]
            rows = batch.where(F.col("pull_end") == F.lit(end)).drop("pull_end")
            start = rows.sparkSession.range(1).select(F.date_sub(F.lit(end), lookback).cast("string")).first()[0]
            replace_days(rows, table, start, end.isoformat(), sort)

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


#: Parts of a revision log; a key's revisions lie in one of them.
PARTS = 256


def log_part(keys: list[str]) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(PARTS)).cast("int")


def create_revision_log(rows: DataFrame, path: str, keys: list[str]) -> None:
    """A log whose files are parted by key, so that a micro-batch reads only the parts of its own keys."""
    rows.withColumn("_part", log_part(keys)).repartition("_part").write.partitionBy("_part").parquet(path)


def own_parts(log: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The parts of a log in which keys of ``batch`` lie: at most ``PARTS`` numbers go to the driver, and the scan skips the
    files of all others."""
    touched = [r[0] for r in batch.select(log_part(keys).alias("p")).distinct().collect()]
    return log.where(F.col("_part").isin(touched))


def append_revisions(stream: DataFrame, path: str, keys: list[str], checkpoint: str,
                     rejected: Callable[[DataFrame], None] | None = None) -> StreamingQuery:
    """Append the acceptable revisions of every micro-batch to a log; replays are no-ops, the rest is handed on.

    ``path`` holds the log as parquet and must exist; of one made by ``create_revision_log`` only the parts of the batch's
    keys are read, one that is not parted is read whole.  Of stored rows only key, revision and hash are read.  The decided
    batch is written once, so the rows appended and the rows handed on come from one decision.
    """
    spark = stream.sparkSession
    schema = spark.read.parquet(path).schema
    parted = "_part" in schema.fieldNames()

    def write(batch: DataFrame, batch_id: int) -> None:
        decided_path = shared_folder(spark, f"decided-{batch_id}")
        log = spark.read.schema(schema).parquet(path)
        append_plan(own_parts(log, batch, keys) if parted else log, batch, keys).write.parquet(decided_path)
        decided = spark.read.parquet(decided_path)
        fresh = decided.where("decision = 'APPEND'")
        if parted:
            fresh = fresh.withColumn("_part", log_part(keys)).repartition("_part")
        writer = fresh.select(*schema.fieldNames()).write.mode("append")
        (writer.partitionBy("_part") if parted else writer).parquet(path)
        if rejected:
            rejected(decided.where("decision NOT IN ('APPEND', 'IDEMPOTENT')"))

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def first_operations(stream: DataFrame, instant: str, keys: list[str], delay: str = "1 day") -> DataFrame:
    """The first operation of every idempotency key within the watermark."""
    return stream.withWatermark(instant, delay).dropDuplicatesWithinWatermark(keys)


def complete_until(sources: list[DataFrame], day: str) -> DataFrame:
    """Start and end of the seven days that end on the last day all sources have reached."""
    last = common_end([df.select(F.to_date(day).alias("day")) for df in sources])
    one = sources[0].sparkSession.range(1)
    return one.select(last.alias("last_day")).select(F.date_sub("last_day", 6).alias("first_day"), "last_day")


def current_view(log: DataFrame, keys: list[str], source: Column, clock: str) -> DataFrame:
    """Latest revision per key with its state at a clock day; an outdated or failed newest revision shows as such."""
    rows = latest(log, keys)
    fresh = is_fresh(source, F.col("freshness_state"), F.col("collection_status"), F.col("as_of"), F.lit(clock).cast("date"))
    failed = F.col("freshness_state").isin("FAILED", "NOT_AVAILABLE")
    return rows.withColumn("view_state", F.when(fresh, "READY").when(failed, F.col("freshness_state")).otherwise("STALE"))


def enriched_stream(stream: DataFrame, view: DataFrame, keys: list[str]) -> DataFrame:
    """Stream rows with the current state of their key (stream-static join)."""
    return stream.join(view.select(*keys, "view_state"), keys, "left")
