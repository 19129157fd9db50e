"""Landed files of the source families as typed tables."""

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from sightline import schemas
from sightline.functions import dates
from sightline.functions.numbers import finite, lenient_number
from sightline.functions.labels import densities, vital_rating
from sightline.functions.urls import search_property
from sightline.operators.quality import first_code


# --- Search and behaviour reports -------------------------------------------------------------------------

def search_rows(pages: DataFrame) -> DataFrame:
    """Flat search rows of paged responses; dimensions arrive by position, an absent metric counts as zero."""
    def key(i):
        return F.coalesce(F.get("r.keys", F.lit(i)), F.lit(""))

    def metric(name, kind="double"):
        return F.coalesce(F.col(f"r.{name}"), F.lit(0)).cast(kind).alias(name)

    return pages.select("site", "property", F.explode("rows").alias("r")).select(
        F.try_to_date(key(0), "yyyy-MM-dd").alias("date"), key(1).alias("page"), key(2).alias("query"), metric("clicks", "long"),
        metric("impressions", "long"), metric("ctr"), metric("position"), key(3).alias("country"), key(4).alias("device"), "site", "property")


def read_search(spark: SparkSession, path: str) -> DataFrame:
    return search_rows(spark.read.schema(schemas.SEARCH_PAGE).json(path))


BEHAVIOUR_DIMENSIONS = ["date", "host", "landing_page", "channel"]
BEHAVIOUR_METRICS = ["sessions", "engaged", "key_events", "revenue"]


def behaviour_rows(pages: DataFrame, dimensions=BEHAVIOUR_DIMENSIONS, metrics=BEHAVIOUR_METRICS) -> DataFrame:
    """Typed behaviour rows of paged responses with positional dimension and metric values."""
    rows = pages.select("site", "property", F.explode("rows").alias("r"))
    named = [F.coalesce(F.get("r.dimension_values", F.lit(i))["value"], F.lit("")).alias(d) for i, d in enumerate(dimensions)]
    figures = [lenient_number(F.get("r.metric_values", F.lit(i))["value"]).alias(m) for i, m in enumerate(metrics)]
    flat = rows.select("site", "property", *named, *figures)
    if "date" in dimensions:
        flat = flat.withColumn("date", F.try_to_date(dates.compact_date(F.col("date")), "yyyy-MM-dd"))
    return flat.withColumn("engagement_rate", F.try_divide("engaged", "sessions")) if {"engaged", "sessions"} <= set(metrics) else flat


def read_behaviour(spark: SparkSession, path: str) -> DataFrame:
    return behaviour_rows(spark.read.schema(schemas.BEHAVIOUR_PAGE).json(path))


def behaviour_snapshots(envelopes: DataFrame, scope: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshot candidates of daily behaviour envelopes, and the envelopes that were refused with the reason.

    ``envelopes``: the envelope struct fields with ``site, loaded_at, as_of_date, source_reference``;
    ``scope``: ``site, host, property_id, timezone``.  An envelope is refused as a whole.  When an expected
    channel is absent its rows become Partial and no zero is put in.
    """
    c = F.col
    bounds = scope.select("site", c("host").alias("_host"), c("property_id").alias("_property"), c("timezone").alias("_zone"))
    rows, meta = c("response.rows"), c("response.metadata")
    day = c("request.date_ranges")[0]["start_date"]
    channels = F.array(*[F.lit(x) for x in schemas.BEHAVIOUR_CHANNELS])

    def value(row, part, i):
        return F.get(row[part], F.lit(i))["value"]

    def outside(row):
        return ((value(row, "dimension_values", 0) != F.replace(day, F.lit("-"), F.lit(""))) | (value(row, "dimension_values", 1) != c("_host"))
                | ~F.array_contains(channels, value(row, "dimension_values", 2)))

    def bad_count(row):
        return ~value(row, "metric_values", 0).rlike(r"^\d+$") | ~value(row, "metric_values", 1).rlike(r"^\d+$")

    keys = F.transform(rows, lambda r: F.concat_ws("|", F.transform(r["dimension_values"], lambda d: d["value"])))
    names = F.transform("response.dimension_headers", lambda h: h["name"])
    metrics = F.transform("response.metric_headers", lambda h: h["name"])
    joined = envelopes.join(bounds, "site", "left")
    checked = joined.withColumn("problem", first_code(
        (c("_host").isNull() | ~c("request.property_id").eqNullSafe(c("_property")), "OUT_OF_SCOPE"),
        (~names.eqNullSafe(c("request.dimensions")) | ~metrics.eqNullSafe(c("request.metrics")), "UNEXPECTED_HEADERS"),
        (rows.isNull() | (F.size(rows) == 0) | (c("response.row_count") != F.size(rows)), "INCOMPLETE_RESPONSE"),
        (~meta["time_zone"].eqNullSafe(c("_zone")) | ~meta["data_loss_from_other_row"].eqNullSafe(F.lit(False))
         | (F.size(F.coalesce(meta["sampling_metadatas"], F.array().cast("array<string>"))) > 0) | F.coalesce(meta["subject_to_thresholding"], F.lit(False)),
         "METADATA_INCOMPLETE"),
        (F.size(F.array_distinct(keys)) != F.size(keys), "DUPLICATE_GROUP"), (F.exists(rows, outside), "ROW_OUTSIDE_SCOPE"),
        (F.exists(rows, bad_count), "INVALID_COUNT"),
        (F.exists(rows, lambda r: value(r, "metric_values", 1).try_cast("long") > value(r, "metric_values", 0).try_cast("long")), "ENGAGED_EXCEEDS_SESSIONS")))
    good = checked.where("problem IS NULL")
    seen = F.transform(rows, lambda r: value(r, "dimension_values", 2))
    complete = F.size(F.array_except(channels, seen)) == 0
    flat = good.select("site", "loaded_at", "as_of_date", "source_reference", day.alias("day"), c("_host").alias("host"), c("_property").alias("property_id"),
                       c("_zone").alias("source_timezone"), complete.alias("complete"), F.explode(rows).alias("r"))
    pairs = F.array(F.struct(F.lit("sessions").alias("metric"), value(c("r"), "metric_values", 0).cast("double").alias("value")),
                    F.struct(F.lit("engaged_sessions").alias("metric"), value(c("r"), "metric_values", 1).cast("double").alias("value")))
    channel = value(c("r"), "dimension_values", 2)
    segment = F.to_json(F.struct(channel.alias("channel"), c("host").alias("hostname"), c("site").alias("site")))
    candidates = flat.select(
        "loaded_at", F.lit("GA4").alias("source"), F.lit("Daily").alias("metric_granularity"), c("day").alias("period_start"), c("day").alias("period_end"),
        "as_of_date", F.when(c("complete"), "Ready").otherwise("Partial").alias("data_status"), F.lit("Behavior").alias("metric_group"), segment.alias("segment"),
        F.concat(F.lit("properties/"), "property_id").alias("platform_property"), "source_reference", F.lit("count").alias("unit"), "source_timezone", F.inline(pairs))
    return candidates, checked.where("problem IS NOT NULL").select("site", "source_reference", "problem")


# --- Tool transcripts -------------------------------------------------------------------------------------

def transcript_calls(results: DataFrame, body_schema: T.DataType) -> tuple[DataFrame, DataFrame]:
    """Parsed bodies of tool calls, and the calls that failed or answered with something else than JSON.

    ``results``: ``call_id, name, args, text, is_error, error``.
    """
    shaped = T.StructType([*body_schema.fields, T.StructField("_corrupt", T.StringType())])
    parsed = results.withColumn("body", F.from_json("text", shaped, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}))
    note = (F.when(F.col("error").isNotNull(), F.col("error")).when(F.col("is_error"), F.col("text"))
            .when(F.col("body").isNull() | F.col("body._corrupt").isNotNull(),
                  F.when(F.trim("text") == "", "empty response").otherwise(F.trim("text"))))
    noted = parsed.withColumn("note", note)
    return noted.where("note IS NULL").drop("note"), noted.where("note IS NOT NULL").select("call_id", "name", "args", "note")


def json_rows(documents: DataFrame, column: str, path: str, fields: dict[str, str]) -> DataFrame:
    """Rows of the array at ``path`` inside a JSON document column, with the named fields as typed columns."""
    item = T.StructType([T.StructField(name, T._parse_datatype_string(kind)) for name, kind in fields.items()])
    listed = F.from_json(F.get_json_object(column, path), T.ArrayType(item))
    others = [c for c in documents.columns if c != column]
    return documents.select(*others, F.inline(listed))


# --- Crawl files ------------------------------------------------------------------------------------------

def crawl_overview(lines: DataFrame) -> DataFrame:
    """Metric lines of sectioned crawl overviews.

    ``lines``: ``crawl_id, line_no, line``.  A line with one cell opens a section, one with two is metadata, longer
    ones are metrics.  An overview is a short file, so its lines are filled down within the file.
    """
    clean = F.regexp_replace("line", "^﻿", "")
    cells = F.from_csv(clean, "c0 string, c1 string, c2 string, c3 string, c4 string")
    width = F.when(clean == "", 0).otherwise(F.size(F.split(F.regexp_replace(clean, '"[^"]*"', "x"), ",")))
    rows = lines.select("crawl_id", "line_no", cells.alias("c"), width.alias("width")).where("c.c0 IS NOT NULL AND c.c0 <> ''")
    order = Window.partitionBy("crawl_id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    section = F.last(F.when(F.col("width") == 1, F.col("c.c0")), ignorenulls=True).over(order)
    count = F.replace(F.col("c.c1"), F.lit(","), F.lit("")).try_cast("long")
    share = F.when(F.col("c.c2").endswith("%"), F.rtrim(F.col("c.c2"), F.lit("%")).try_cast("double") / 100)
    return rows.withColumn("section", section).where("width > 2").select(
        "crawl_id", F.coalesce("section", F.lit("_summary")).alias("section"), F.col("c.c0").alias("label"), count.alias("count"), share.alias("share"),
        F.col("c.c3").alias("total"), F.col("c.c4").alias("scope")).where("count IS NOT NULL")


def crawl_meta_lines(lines: DataFrame) -> DataFrame:
    """Two-cell metadata lines of crawl overviews."""
    clean = F.regexp_replace("line", "^﻿", "")
    cells = F.from_csv(clean, "c0 string, c1 string")
    two = F.size(F.split(F.regexp_replace(clean, '"[^"]*"', "x"), ",")) == 2
    return lines.where(two).select("crawl_id", cells["c0"].alias("metric"), cells["c1"].alias("value")).where("metric <> ''")


def overview_lines(spark: SparkSession, path: str) -> DataFrame:
    """Numbered lines of overview files, one file per crawl."""
    files = spark.read.text(path, wholetext=True).select(F.input_file_name().alias("crawl_id"), "value")
    return files.select("crawl_id", F.posexplode(F.split("value", "\r?\n")).alias("line_no", "line"))


def read_issue_export(spark: SparkSession, path: str) -> DataFrame:
    """An issue export as text columns, without a byte-order mark in the first header."""
    raw = spark.read.csv(path, header=True, multiLine=True, escape='"')
    return raw.toDF(*[c.lstrip("﻿").strip().strip('"') for c in raw.columns])


# --- Web vitals -------------------------------------------------------------------------------------------

def vitals_rows(results: DataFrame) -> DataFrame:
    """One row per origin, form factor and metric: p75, rating, densities and collection period.

    ``results``: ``origin, form_factor, error, period {first, last}, metrics array<{metric, p75, histogram}>``,
    where p75 arrives as a number or as text.
    """
    flat = results.where("metrics IS NOT NULL").select("origin", "form_factor", dates.from_parts(F.col("period.first")).alias("first_day"),
                                                       dates.from_parts(F.col("period.last")).alias("last_day"), F.inline("metrics"))
    p75 = finite(F.nullif(F.col("p75").cast("string"), F.lit("")).try_cast("double"))
    return flat.withColumns({"p75": p75, "d": densities(F.col("histogram"))}).select(
        "origin", "form_factor", "metric", "p75", vital_rating(F.col("metric"), F.col("p75")).alias("rating"), "d.good", "d.needs", "d.poor", "first_day", "last_day")


def vitals_history(results: DataFrame) -> DataFrame:
    """History windows of every metric: parallel arrays of p75 values and periods zipped into rows."""
    zipped = F.arrays_zip(F.col("p75s"), F.col("last_days"))
    return results.select("origin", "form_factor", "metric", F.explode(zipped).alias("z")).select(
        "origin", "form_factor", "metric", dates.from_parts(F.col("z.last_days")).alias("last_day"),
        finite(F.nullif(F.col("z.p75s").cast("string"), F.lit("")).try_cast("double")).alias("p75")).where("last_day IS NOT NULL")


def vitals_missing(results: DataFrame) -> DataFrame:
    return results.where("metrics IS NULL").select("origin", "form_factor", F.coalesce("error", F.lit("NOT_ENOUGH_SAMPLES")).alias("reason"))


# --- Sheets -----------------------------------------------------------------------------------------------

def sheet_table(values: DataFrame, header: list[str], columns: list[str], nullable: list[str]) -> DataFrame:
    """Rows of a sheet range as named columns.

    ``values``: ``row_no, cells array<string>``.  Columns are found by header name, short rows are padded, blank
    cells are null in nullable columns only, and rows without any cell go.
    """
    problems = {"missing": sorted(set(columns) - set(header)), "unexpected": sorted(set(header) - set(columns))}
    if any(problems.values()):
        raise ValueError(f"sheet header mismatch: {problems}")
    filled = values.where(F.exists("cells", lambda c: F.coalesce(F.trim(c), F.lit("")) != ""))

    def cell(name):
        raw = F.coalesce(F.get("cells", F.lit(header.index(name))), F.lit(""))
        return (F.nullif(F.trim(raw), F.lit("")) if name in nullable else raw).alias(name)

    return filled.select("row_no", *[cell(c) for c in columns])


def monthly_block(rows: DataFrame, mapping: DataFrame) -> DataFrame:
    """Wide monthly sheet rows as long rows; a month's target stands one column left of its actual.

    ``rows``: ``source_tab, source_row, cells``; ``mapping``: ``metric, source_tab, source_row, month, column_letter``.
    """
    cells = rows.select("source_tab", "source_row", F.posexplode("cells").alias("column", "cell"))
    placed = mapping.withColumn("column", F.ascii(F.upper("column_letter")) - F.ascii(F.lit("A")))
    targets = cells.select("source_tab", "source_row", (F.col("column") + 1).alias("column"), F.col("cell").alias("target"))
    keys = ["source_tab", "source_row", "column"]
    joined = placed.join(cells.withColumnRenamed("cell", "actual"), keys, "left").join(targets, keys, "left")
    return joined.select("metric", "source_tab", "source_row", "month", F.nullif(F.trim("actual"), F.lit("")).alias("actual"),
                         F.nullif(F.trim("target"), F.lit("")).alias("target"))


def ai_channel_months(rows: DataFrame, current_month: str, as_of: str) -> DataFrame:
    """Lead rows of one AI source: serial first-of-month dates as months, the running month dropped, maturity attached."""
    month = dates.month_key(dates.serial_date(F.col("serial")))
    kept = rows.where("serial IS NOT NULL").withColumn("month", month).where(F.col("month") <= current_month)
    matures = dates.mature_on(dates.month_start(F.col("month")))
    return kept.select("month", "leads", "conversions", "rate", matures.alias("mature_on"), (matures <= F.lit(as_of).cast("date")).alias("is_mature"))


# --- Logs and configuration -------------------------------------------------------------------------------

def read_log(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """An append-only JSON-lines log; an unreadable line keeps its text in ``_corrupt`` for the integrity check."""
    return spark.read.schema(T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType())])).option(
        "columnNameOfCorruptRecord", "_corrupt").json(path)


def merged_config(template: DataFrame, existing: DataFrame, fields: list[str], key: str = "config_key") -> DataFrame:
    """Template rows in which every value already filled in stands."""
    held = existing.select(key, *[F.nullif(F.trim(F.col(f)), F.lit("")).alias(f"_{f}") for f in fields])
    joined = template.join(held, key, "left")
    return joined.withColumns({f: F.coalesce(f"_{f}", f) for f in fields}).drop(*[f"_{f}" for f in fields])


def backfilled_property(rows: DataFrame, matched: DataFrame) -> DataFrame:
    """Search rows of an older layout with site and property filled in from the page's configuration."""
    known = matched.select("page", F.col("site").alias("_site"), search_property(F.col("property"), F.col("site")).alias("_property")).dropDuplicates(["page"])
    base = rows.withColumns({c: F.lit(None).cast("string") for c in ("site", "property") if c not in rows.columns})
    joined = base.join(known, "page", "left")
    return joined.withColumns({"site": F.coalesce("site", "_site"), "property": F.coalesce("property", "_property")}).drop("_site", "_property")


