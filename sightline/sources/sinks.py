"""Tables written: replaced day ranges, verified appends, published models, exports.

Every write is a distributed Spark write with a single writer per table; the driver only sees day lists and counts.
"""

import datetime
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from sightline.operators.quality import multiset_difference


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder for intermediate tables below the session's checkpoint directory.

    On a cluster ``spark.checkpoint.dir`` names a shared file system; only a session without it gets a local one.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        base = tempfile.mkdtemp(prefix="spark-", dir="/tmp")
        spark.sparkContext.setCheckpointDir(base)
    return f"{base.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _days(start: str, end: str) -> list[datetime.date]:
    first, last = datetime.date.fromisoformat(start), datetime.date.fromisoformat(end)
    return [first + datetime.timedelta(days=i) for i in range((last - first).days + 1)]


def create_daily_table(rows: DataFrame, table: str, path: str, sort: list[str]) -> None:
    """A table partitioned by ``date``, rows sorted within each file so that page and query filters skip data."""
    (rows.hint("rebalance", "date").sortWithinPartitions("date", *sort)
     .write.mode("overwrite").option("path", path).partitionBy("date").saveAsTable(table))


def replace_days(rows: DataFrame, table: str, start: str, end: str, sort: list[str]) -> None:
    """Replace the days of a range by new rows, whether or not a day has any; all other days stay as they are.

    Only the partitions of the range are rewritten (dynamic overwrite); a day that lost all its rows is dropped.
    Files follow the size of a day: a large one is split over several tasks.
    """
    spark = rows.sparkSession
    inside = rows.where(F.col("date").between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    present = {r[0] for r in inside.select("date").distinct().collect()}
    columns = spark.table(table).columns
    setting = "spark.sql.sources.partitionOverwriteMode"
    held = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")
    try:
        (inside.select(*columns).hint("rebalance", "date").sortWithinPartitions("date", *sort)
         .write.mode("overwrite").insertInto(table))
    finally:
        spark.conf.set(setting, held)
    for day in _days(start, end):
        if day not in present:
            spark.sql(f"ALTER TABLE {table} DROP IF EXISTS PARTITION (date = DATE '{day.isoformat()}')")
    spark.catalog.refreshTable(table)


def within(table: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """The rows of ``table`` inside the ranges that the keys of ``batch`` span.

    The ends reach the scan as literals, so files and row groups beyond them are skipped by their statistics.
    """
    plain = [k for k, kind in batch.dtypes if k in keys and not kind.startswith(("array", "map", "struct", "binary", "variant"))]
    if not plain:
        return table
    ends = batch.agg(*[f(k).alias(f"{n}_{i}") for i, k in enumerate(plain) for n, f in (("low", F.min), ("high", F.max))]).first()
    for i, k in enumerate(plain):
        if ends[f"low_{i}"] is None:
            continue
        kind = batch.schema[k].dataType
        table = table.where(F.col(k).between(F.lit(ends[f"low_{i}"]).cast(kind), F.lit(ends[f"high_{i}"]).cast(kind)) | F.col(k).isNull())
    return table


def plan_append(stored: DataFrame, candidates: DataFrame, keys: list[str]) -> DataFrame:
    """Candidates the table does not hold yet, each key once: of several with one key the least in its other columns.

    Stored keys are first cut down to those of the batch, in which a batch that is small enough goes to the table's tasks
    and otherwise a filter made of its keys does; the table is never exchanged for keys that the batch does not have.
    """
    others = [c for c in candidates.columns if c not in keys]
    if others:
        first = candidates.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_row")).select(*keys, "_row.*").select(*candidates.columns)
    else:
        first = candidates.dropDuplicates(keys)
    present = stored.select(*keys).join(first.select(*keys), keys, "left_semi").distinct()
    return first.join(present, keys, "left_anti")


def append_if_new(candidates: DataFrame, path: str, keys: list[str]) -> dict[str, int]:
    """Append the new rows of a batch and read them back; a replayed batch appends nothing.

    The batch and the plan are written to staging tables first, so what is appended and what is compared are the same rows.
    Plan and read-back look only at the part of the table that the batch's keys span; row counts come from file footers.
    """
    spark = candidates.sparkSession
    batch_path, staging = shared_folder(spark, "batch"), shared_folder(spark, "append")
    candidates.write.parquet(batch_path)
    batch = spark.read.schema(candidates.schema).parquet(batch_path)
    try:
        stored = spark.read.schema(candidates.schema).parquet(path)
        before = stored.count()
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error):
            raise
        stored, before = spark.createDataFrame([], candidates.schema), 0
    plan_append(within(stored, batch, keys), batch, keys).write.parquet(staging)
    planned = spark.read.schema(candidates.schema).parquet(staging)
    added = planned.count()
    if added:
        planned.write.mode("append").parquet(path)
    return {"before": before, "appended": added, **verify_append(spark.read.schema(candidates.schema).parquet(path) if before + added else stored,
                                                                 planned, keys, before + added)}


def verify_append(actual: DataFrame, planned: DataFrame, keys: list[str], expected_rows: int) -> dict[str, object]:
    """Read-back check: the row count, and every planned row present exactly once with equal content."""
    rows = actual.count()
    found = within(actual, planned, keys).join(planned.select(*keys), keys, "left_semi")
    different = multiset_difference(found, planned).limit(1).count()
    if rows != expected_rows or different:
        raise ValueError("read-back differs from the append plan; do not replay it blindly")
    return {"rows": rows, "status": "PASS"}


def schema_table(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per published table and field, in order."""
    spark = next(iter(tables.values())).sparkSession
    rows = [(name, i, field.name, field.dataType.simpleString()) for name, df in tables.items() for i, field in enumerate(df.schema.fields)]
    return spark.createDataFrame(rows, "table string, position int, field string, type string")


def publish(tables: dict[str, DataFrame], folder: str, protected: dict[str, list[str]] | None = None) -> DataFrame:
    """Write the tables of a report model and the table that describes them.

    Tables owned by people (``protected``: name -> required columns) are read, checked and described, never written.
    """
    described = {}
    for name, df in tables.items():
        if name not in (protected or {}):
            df.write.mode("overwrite").parquet(f"{folder}/{name}")
            described[name] = df
    spark = next(iter(tables.values())).sparkSession
    for name, required in (protected or {}).items():
        described[name] = check_protected(spark.read.parquet(f"{folder}/{name}"), required, name)
    described_table = schema_table(described)
    described_table.write.mode("overwrite").parquet(f"{folder}/_schema")
    return described_table


def check_protected(live: DataFrame, required: list[str], name: str) -> DataFrame:
    """A table owned by people as it is, in its own column order; a missing required column stops the publication."""
    missing = sorted(set(required) - set(live.columns))
    if missing:
        raise ValueError(f"{name} lacks required columns: {missing}")
    return live


def with_missing_columns(rows: DataFrame, required: dict[str, str]) -> DataFrame:
    """Rows with every required column, absent ones appended as nulls; present ones keep place and type."""
    absent = {name: F.lit(None).cast(kind) for name, kind in required.items() if name not in rows.columns}
    return rows.withColumns(absent) if absent else rows


# --- Exports ----------------------------------------------------------------------------------------------

def tsv_lines(rows: DataFrame) -> DataFrame:
    """Rows as tab-separated text; tabs and line breaks inside a cell become spaces."""
    cells = [F.coalesce(F.regexp_replace(F.col(c).cast("string"), r"[\t\r\n]+", " "), F.lit("")) for c in rows.columns]
    return rows.select(F.concat_ws("\t", *cells).alias("line"))


def json_lines(rows: DataFrame) -> DataFrame:
    """Rows as JSON objects with their keys in order and nulls kept."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("line"))


def markdown_lines(rows: DataFrame) -> DataFrame:
    """Rows as lines of a markdown table; bars inside a cell are escaped."""
    def cell(name: str) -> Column:
        return F.coalesce(F.regexp_replace(F.regexp_replace(F.col(name).cast("string"), r"\|", r"\\|"), r"[\r\n]+", " "), F.lit("—"))
    return rows.select(F.concat(F.lit("| "), F.concat_ws(" | ", *[cell(c) for c in rows.columns]), F.lit(" |")).alias("line"))


def write_tsv(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").csv(path, sep="\t", header=True)


# --- Run log ----------------------------------------------------------------------------------------------

def log_run(spark: SparkSession, path: str, run: dict) -> dict[str, int]:
    """Append one run to the run log unless the same run is there already."""
    row = spark.createDataFrame([(run["run_id"], run["source"], int(run["rows_returned"]), run["status"], run.get("error"))],
                                "run_id string, source string, rows_returned long, status string, error string")
    hashed = row.withColumn("content_hash", F.sha2(F.concat_ws("|", *row.columns), 256))
    return append_if_new(hashed, path, ["run_id", "content_hash"])
