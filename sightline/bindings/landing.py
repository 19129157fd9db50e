"""Landed files, normalisers, sinks and streams over the given tables."""

from pyspark.sql import functions as F, types as T

from sightline import schemas
from sightline.bindings.core import query
from sightline.bindings.scalars import URL_SQL
from sightline.functions.text import norm_text
from sightline.operators import joins, registry
from sightline.operators.charts import rounded
from sightline.sources import landing, normalise, sinks
from sightline.streaming import jobs

C = F.col


def none():
    return F.lit(None).cast("string")
VALUE = "array<struct<value:string>>"


# --- Search and behaviour reports -------------------------------------------------------------------------

@query("A1_search_rows", """
SELECT CAST(l_shipdate AS DATE) AS date, 'p' || l_partkey AS page, CASE WHEN l_linenumber = 7 THEN '' ELSE 'q' || l_suppkey END AS query, CASE WHEN l_linenumber = 6 THEN 0 ELSE CAST(l_quantity AS BIGINT) END AS clicks,
  CAST(floor(l_extendedprice) AS BIGINT) AS impressions FROM lineitem""")
def search_rows(t):
    """Line items as landed JSON responses, one response per order, read back as flat rows."""
    line = C("l_linenumber")
    keys = F.array(F.date_format("l_shipdate", "yyyy-MM-dd"), F.concat(F.lit("p"), "l_partkey"), F.when(line != 7, F.concat(F.lit("q"), "l_suppkey")))
    row = F.struct(keys.alias("keys"), F.when(line != 6, C("l_quantity")).alias("clicks"), F.floor("l_extendedprice").cast("double").alias("impressions"))
    landed = t.lineitem.groupBy("l_orderkey").agg(F.to_json(F.struct(F.lit("s").alias("site"), F.lit("p").alias("property"), F.collect_list(row).alias("rows"))).alias("text"))
    pages = landed.select(F.from_json("text", schemas.SEARCH_PAGE).alias("p")).select("p.*")
    return landing.search_rows(pages).select("date", "page", "query", "clicks", "impressions")


@query("A2_behaviour_rows", """
SELECT CAST(ts AS DATE) AS date, event_type AS channel, user_id AS page, CASE WHEN event_id % 5 = 0 THEN 0::DOUBLE ELSE CAST(event_id AS DOUBLE) END AS sessions, round(value, 2) AS engaged FROM events""")
def behaviour_rows(t):
    def cell(c):
        return F.struct(c.cast("string").alias("value"))
    day = F.date_format("ts", "yyyyMMdd")
    dims = F.array(cell(day), cell(F.lit("h.example")), cell(C("user_id")), cell(C("event_type")))
    metrics = F.array(cell(F.when(C("event_id") % 5 == 0, "(none)").otherwise(C("event_id").cast("string"))), cell(F.round("value", 2)))
    pages = t.events.groupBy("user_id", F.to_date("ts"), F.floor(C("event_id") / 1000)).agg(F.collect_list(F.struct(dims.alias("dimension_values"), metrics.alias("metric_values"))).alias("rows")).select(
        F.lit("s").alias("site"), F.lit("p").alias("property"), "rows")
    out = landing.behaviour_rows(pages)
    return out.select("date", "channel", C("landing_page").cast("long").alias("page"), "sessions", "engaged")


def envelopes(t):
    """One daily behaviour envelope per site and day, channels from all event types; some are broken on purpose."""
    daily = t.events.select(
        (C("user_id") % 97).alias("site"), F.to_date("ts").alias("day"), F.when(C("event_type").isin("view", "signup", "purchase"), "Organic Search").otherwise("AI Assistant").alias("channel"), "value")
    groups = daily.groupBy("site", "day", "channel").agg(F.count(F.lit(1)).alias("sessions"), F.count_if(C("value") > 30).alias("engaged"))

    def cells(*parts):
        return F.array(*[F.struct(p.cast("string").alias("value")) for p in parts])

    host = F.concat(F.lit("h"), "site")
    row = F.struct(cells(F.date_format("day", "yyyyMMdd"), host, C("channel")).alias("dimension_values"), cells(C("sessions"), C("engaged")).alias("metric_values"))
    gathered = groups.groupBy("site", "day").agg(F.collect_list(row).alias("rows"))
    names = lambda *n: F.array(*[F.struct(F.lit(x).alias("name")) for x in n])
    day = F.date_format("day", "yyyy-MM-dd")
    request = F.struct(F.concat(F.lit("P"), "site").alias("property_id"), F.array(F.struct(day.alias("start_date"), day.alias("end_date"))).alias("date_ranges"),
                       F.array(*[F.lit(x) for x in ("date", "hostName", "sessionDefaultChannelGroup")]).alias("dimensions"), F.array(F.lit("sessions"), F.lit("engagedSessions")).alias("metrics"))
    meta = F.struct(F.when(F.day("day") % 7 == 0, "UTC").otherwise("Asia/Taipei").alias("time_zone"), F.lit(False).alias("data_loss_from_other_row"), F.lit(False).alias("subject_to_thresholding"), F.array().cast("array<string>").alias("sampling_metadatas"))
    response = F.struct(names("date", "hostName", "sessionDefaultChannelGroup").alias("dimension_headers"), names("sessions", "engagedSessions").alias("metric_headers"),
                        (F.size("rows") + F.when(F.day("day") % 5 == 0, 1).otherwise(0)).cast("long").alias("row_count"), meta.alias("metadata"), C("rows").alias("rows"))
    scope = groups.select("site").distinct().select("site", host.alias("host"), F.concat(F.lit("P"), "site").alias("property_id"), F.lit("Asia/Taipei").alias("timezone"))
    landed = gathered.select("site", request.alias("request"), response.alias("response"), F.lit("2024-02-01T00:00:00Z").alias("loaded_at"), day.alias("as_of_date"), F.concat_ws("/", "site", day).alias("source_reference"))
    return landed, scope


ENVELOPE_SQL = """g AS (SELECT user_id % 97 AS site, CAST(ts AS DATE) AS d, CASE WHEN event_type IN ('view', 'signup', 'purchase') THEN 'view' ELSE 'click' END AS event_type, COUNT(*) AS s, COUNT(*) FILTER (value > 30) AS e FROM events GROUP BY 1, 2, 3),
n AS (SELECT *, COUNT(*) OVER (PARTITION BY site, d) = 2 AS complete FROM g)"""


@query("A3_behaviour_snapshots", f"""
WITH {ENVELOPE_SQL} SELECT site || '/' || d AS source_reference, CASE WHEN complete THEN 'Ready' ELSE 'Partial' END AS data_status, '{{"channel":"' || CASE event_type WHEN 'view' THEN 'Organic Search' ELSE 'AI Assistant' END || '","hostname":"h' || site || '","site":' || site || '}}' AS segment,
  m.name AS metric, CAST(CASE m.name WHEN 'sessions' THEN s ELSE e END AS DOUBLE) AS value FROM n, (VALUES ('sessions'), ('engaged_sessions')) m(name) WHERE extract(day FROM d) % 5 <> 0 AND extract(day FROM d) % 7 <> 0""")
def behaviour_snapshots(t):
    return landing.behaviour_snapshots(*envelopes(t))[0].select("source_reference", "data_status", "segment", "metric", "value")


@query("A3_refused_envelopes", f"""
WITH {ENVELOPE_SQL} SELECT DISTINCT site || '/' || d AS source_reference, CASE WHEN extract(day FROM d) % 5 = 0 THEN 'INCOMPLETE_RESPONSE' ELSE 'METADATA_INCOMPLETE' END AS problem FROM n WHERE extract(day FROM d) % 5 = 0 OR extract(day FROM d) % 7 = 0""")
def refused_envelopes(t):
    return landing.behaviour_snapshots(*envelopes(t))[1].select("source_reference", "problem")


# --- Transcripts and documents ----------------------------------------------------------------------------

def calls(t):
    key = C("o_orderkey")
    text = F.when(key % 5 == 0, "Internal error: try again").when(key % 7 == 0, " ").otherwise(F.to_json(F.struct(C("o_custkey").alias("clicks"), C("o_orderstatus").alias("site"))))
    return t.orders.select(key.alias("call_id"), F.lit("search").alias("name"), F.lit("{}").alias("args"), text.alias("text"), (key % 11 == 0).alias("is_error"), none().alias("error"))


BODY = T.StructType([T.StructField("clicks", T.LongType()), T.StructField("site", T.StringType())])


@query("A4_good_calls", "SELECT o_orderkey AS call_id, o_custkey AS clicks, o_orderstatus AS site FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0")
def good_calls(t):
    return landing.transcript_calls(calls(t), BODY)[0].select("call_id", "body.clicks", "body.site")


@query("A4_bad_calls", """
SELECT o_orderkey AS call_id, CASE WHEN o_orderkey % 5 = 0 THEN 'Internal error: try again' WHEN o_orderkey % 11 = 0 AND o_orderkey % 7 = 0 THEN ' ' WHEN o_orderkey % 11 = 0 THEN '{"clicks":' || o_custkey || ',"site":"' || o_orderstatus || '"}' ELSE 'empty response' END AS note
FROM orders WHERE o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0""")
def bad_calls(t):
    return landing.transcript_calls(calls(t), BODY)[1].select("call_id", "note")


@query("A6_json_rows", "SELECT o_custkey, o_orderkey AS page, CAST(floor(o_totalprice) AS BIGINT) AS clicks FROM orders")
def json_rows(t):
    row = F.struct(C("o_orderkey").alias("page"), F.floor("o_totalprice").alias("clicks"))
    documents = t.orders.groupBy("o_custkey", F.floor(C("o_orderkey") / 100).alias("part")).agg(F.to_json(F.struct(F.struct(F.collect_list(row).alias("rows")).alias("search"))).alias("payload")).drop("part")
    return landing.json_rows(documents, "payload", "$.search.rows", {"page": "long", "clicks": "long"})


@query("A6_json_path", "SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events")
def json_path(t):
    return t.events.select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


# --- Crawl files ------------------------------------------------------------------------------------------

def overview(t):
    """Every hundred orders as a sectioned overview file, one section per order status."""
    spans = t.orders.select(F.floor(C("o_orderkey") / 100).alias("crawl_id"), "o_orderstatus", "o_orderkey", "o_totalprice")
    heads = spans.select("crawl_id", "o_orderstatus").distinct().select("crawl_id", C("o_orderstatus").alias("s"), F.lit(-1).cast("long").alias("k"), C("o_orderstatus").alias("line"))
    metric = F.concat(F.lit("Label "), "o_orderkey", F.lit(',"'), F.format_number(F.floor("o_totalprice"), 0), F.lit('",'), (C("o_orderkey") % 100).cast("string"), F.lit("%,10,URLs"))
    body = spans.select("crawl_id", C("o_orderstatus").alias("s"), C("o_orderkey").alias("k"), metric.alias("line"))
    numbered = heads.unionByName(body)
    return numbered.withColumn("line_no", F.row_number().over(landing.Window.partitionBy("crawl_id").orderBy("s", "k"))).select("crawl_id", "line_no", "line")


@query("A7_crawl_overview", """
SELECT o_orderkey // 100 AS crawl_id, o_orderstatus AS section, 'Label ' || o_orderkey AS label, CAST(floor(o_totalprice) AS BIGINT) AS count, round((o_orderkey % 100) / 100.0::DOUBLE, 6) AS share FROM orders""")
def crawl_overview(t):
    return rounded(landing.crawl_overview(overview(t)).select("crawl_id", "section", "label", "count", "share"), "share")


@query("E12_section_fill", "SELECT o_orderkey // 100 AS crawl_id, o_orderstatus AS section, COUNT(*) AS lines FROM orders GROUP BY 1, 2")
def section_fill(t):
    return landing.crawl_overview(overview(t)).groupBy("crawl_id", "section").agg(F.count(F.lit(1)).alias("lines"))


@query("A8_issue_export", "SELECT CAST(page_id AS VARCHAR) AS page_id, url FROM pages")
def issue_export(t):
    folder = sinks.shared_folder(t.spark, "export")
    t.pages.select("page_id", "url").write.csv(folder, header=True)
    return landing.read_issue_export(t.spark, folder)


# --- Web vitals and sheets --------------------------------------------------------------------------------

def vitals_results(t):
    """One record per user and event type, with metrics from its events; users with a small id have no record."""
    def part(day):
        return F.struct(F.year(day).alias("year"), F.month(day).alias("month"), F.day(day).alias("day"))
    stats = t.events.groupBy("user_id", "event_type").agg(F.max("value").alias("v"), F.min(F.to_date("ts")).alias("a"), F.max(F.to_date("ts")).alias("b"))
    metric = F.struct(F.lit("largest_contentful_paint").alias("metric"), F.round(C("v") * 40, 2).cast("string").alias("p75"), F.array(C("v") / 500, C("v") / 1000).alias("histogram"))
    layout = F.struct(F.lit("cumulative_layout_shift").alias("metric"), F.when(C("user_id") % 4 == 0, "").otherwise((F.floor("v") / 400).cast("string")).alias("p75"), F.array(C("v") / 500).alias("histogram"))
    return stats.select(C("user_id").alias("origin"), C("event_type").alias("form_factor"), none().alias("error"), F.struct(part(C("a")).alias("first"), part(C("b")).alias("last")).alias("period"),
                        F.when(C("user_id") >= 10, F.array(metric, layout)).alias("metrics"))


@query("A9_vitals_rows", """
WITH s AS (SELECT user_id, event_type, MAX(value) AS v, MIN(CAST(ts AS DATE)) AS a, MAX(CAST(ts AS DATE)) AS b FROM events GROUP BY 1, 2),
m AS (SELECT *, 'largest_contentful_paint' AS metric, round(v * 40, 2) AS p75, v / 1000 AS needs, 2500::DOUBLE AS good_to, 4000::DOUBLE AS poor_from FROM s
  UNION ALL SELECT *, 'cumulative_layout_shift', CASE WHEN user_id % 4 <> 0 THEN floor(v) / 400 END, NULL, 0.1, 0.25 FROM s)
SELECT user_id AS origin, event_type AS form_factor, metric, round(p75, 6) AS p75, CASE WHEN p75 <= good_to THEN 'GOOD' WHEN p75 <= poor_from THEN 'NEEDS_IMPROVEMENT' WHEN p75 IS NOT NULL THEN 'POOR' END AS rating,
  round(v / 500, 6) AS good, round(needs, 6) AS needs, a AS first_day, b AS last_day FROM m WHERE user_id >= 10""")
def vitals_rows(t):
    return rounded(landing.vitals_rows(vitals_results(t)).drop("poor"), "p75", "good", "needs")


@query("A9_vitals_missing", "SELECT DISTINCT user_id AS origin, event_type AS form_factor, 'NOT_ENOUGH_SAMPLES' AS reason FROM events WHERE user_id < 10")
def vitals_missing(t):
    return landing.vitals_missing(vitals_results(t))


@query("A9_vitals_history", "SELECT user_id AS origin, event_type AS form_factor, 'lcp' AS metric, CAST(ts AS DATE) AS last_day, round(value, 6) AS p75 FROM events")
def vitals_history(t):
    day = F.struct(F.year("ts").alias("year"), F.month("ts").alias("month"), F.day("ts").alias("day"))
    arrays = t.events.groupBy(C("user_id").alias("origin"), C("event_type").alias("form_factor"), F.to_date("ts"), F.floor(C("event_id") / 1000)).agg(
        F.collect_list(F.struct(C("value").cast("string").alias("v"), day.alias("d"))).alias("a"))
    shaped = arrays.select("origin", "form_factor", F.lit("lcp").alias("metric"), F.transform("a", lambda x: x["v"]).alias("p75s"), F.transform("a", lambda x: x["d"]).alias("last_days"))
    return rounded(landing.vitals_history(shaped), "p75")


@query("A11_sheet_table", """
SELECT o_orderkey AS row_no, o_orderstatus AS metric, CASE WHEN o_orderkey % 3 <> 0 THEN CAST(o_custkey AS VARCHAR) END AS value FROM orders WHERE o_orderkey % 7 <> 0""")
def sheet_table(t):
    key = C("o_orderkey")
    full = F.array(F.when(key % 3 == 0, " ").otherwise(C("o_custkey").cast("string")), C("o_orderstatus"))
    cells = F.when(key % 7 == 0, F.array(F.lit(""), F.lit(" "))).otherwise(full)
    return landing.sheet_table(t.orders.select(key.alias("row_no"), cells.alias("cells")), ["value", "metric"], ["metric", "value"], ["value"])


@query("A12_monthly_block", """
SELECT o_orderstatus AS metric, o_orderkey AS source_row, '03' AS month, CAST(o_custkey AS VARCHAR) AS actual, CASE WHEN o_orderkey % 4 <> 0 THEN CAST(o_orderkey AS VARCHAR) END AS target FROM orders""")
def monthly_block(t):
    key = C("o_orderkey")
    rows = t.orders.select(F.lit("2026").alias("source_tab"), key.alias("source_row"), F.array(F.lit("label"), F.when(key % 4 == 0, "").otherwise(key.cast("string")), C("o_custkey").cast("string")).alias("cells"))
    mapping = t.orders.select(C("o_orderstatus").alias("metric"), F.lit("2026").alias("source_tab"), key.alias("source_row"), F.lit("03").alias("month"), F.lit("C").alias("column_letter"))
    return landing.monthly_block(rows, mapping).drop("source_tab")


@query("A13_ai_channel", """
SELECT strftime(o_orderdate, '%Y-%m') AS month, COUNT(*) AS leads, last_day(MIN(o_orderdate)) + 60 AS mature_on, last_day(MIN(o_orderdate)) + 60 <= DATE '2000-06-30' AS is_mature FROM orders WHERE strftime(o_orderdate, '%Y-%m') <= '2000-05' GROUP BY 1""")
def ai_channel(t):
    months = t.orders.groupBy(F.datediff(F.trunc("o_orderdate", "month"), F.lit("1899-12-30").cast("date")).alias("serial")).agg(F.count(F.lit(1)).alias("leads"))
    rows = months.withColumns({"conversions": F.lit(None).cast("long"), "rate": F.lit(None).cast("double")})
    return landing.ai_channel_months(rows, "2000-05", "2000-06-30").select("month", "leads", "mature_on", "is_mature")


# --- Sinks ------------------------------------------------------------------------------------------------

def daily_search(t):
    return t.search_daily.groupBy(C("day").alias("date"), "page").agg(F.sum("clicks").alias("clicks"))


def by_month(rows):
    return rows.groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count(F.lit(1)).alias("rows"), F.sum("clicks").alias("clicks"))


@query("A14_replace_days", """
WITH d AS (SELECT strftime(day, '%Y-%m') AS k, page, SUM(clicks) AS c FROM search_daily GROUP BY day, page, 1),
m AS (SELECT CAST(k || '-01' AS DATE) AS date, page, SUM(c) AS c FROM d GROUP BY 1, 2)
SELECT strftime(date, '%Y-%m') AS month, COUNT(*) AS rows, CAST(SUM(c * CASE WHEN date BETWEEN DATE '1999-03-01' AND DATE '1999-06-30' THEN 2 ELSE 1 END) AS BIGINT) AS clicks FROM m WHERE date <> DATE '1999-05-01' GROUP BY 1""")
def replace_days(t):
    """Monthly facts as a partitioned table; a pull replaces four months and leaves one of them empty."""
    monthly = t.search_daily.groupBy(F.trunc("day", "month").alias("date"), "page").agg(F.sum("clicks").alias("clicks"))
    path = sinks.shared_folder(t.spark, "daily")
    table = "sightline_" + path.rsplit("-", 1)[1]
    sinks.create_daily_table(monthly, table, path, ["page"])
    pull = monthly.where("date BETWEEN DATE '1999-03-01' AND DATE '1999-06-30' AND date <> DATE '1999-05-01'").withColumn("clicks", C("clicks") * 2)
    sinks.replace_days(pull, table, "1999-03-01", "1999-06-30", ["page"])
    return by_month(t.spark.table(table))


@query("A15_append_if_new", "SELECT COUNT(*) AS rows, COUNT(DISTINCT o_orderkey) AS keys FROM orders")
def append_if_new(t):
    path = sinks.shared_folder(t.spark, "append")
    rows = t.orders.select("o_orderkey", F.md5("o_orderstatus").alias("content_hash"), "o_totalprice")
    for batch in (rows.where("o_orderkey % 2 = 0"), rows, rows):
        sinks.append_if_new(batch, path, ["o_orderkey", "content_hash"])
    return t.spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("o_orderkey").alias("keys"))


@query("A16_publish", """
SELECT 'monthly' AS "table", 0 AS position, 'month' AS field, 'string' AS type UNION ALL SELECT 'monthly', 1, 'rows', 'bigint' UNION ALL SELECT 'monthly', 2, 'clicks', 'bigint'
UNION ALL SELECT 'notes', 0, 'text', 'string' UNION ALL SELECT 'notes', 1, 'owner', 'string'""")
def publish(t):
    """Publish a model beside a table people own; the schema table describes both."""
    folder = sinks.shared_folder(t.spark, "publish")
    t.orders.select(C("o_orderstatus").alias("text"), C("o_orderpriority").alias("owner")).write.parquet(f"{folder}/notes")
    sinks.publish({"monthly": by_month(daily_search(t))}, folder, protected={"notes": ["owner"]})
    return t.spark.read.parquet(f"{folder}/_schema")


@query("A16_published_rows", """
WITH d AS (SELECT day, page, SUM(clicks) AS c FROM search_daily GROUP BY 1, 2)
SELECT strftime(day, '%Y-%m') AS month, COUNT(*) AS rows, CAST(SUM(c) AS BIGINT) AS clicks FROM d GROUP BY 1""")
def published_rows(t):
    """The rows of a published table as a reader of the folder finds them."""
    folder = sinks.shared_folder(t.spark, "publish")
    sinks.publish({"monthly": by_month(daily_search(t))}, folder)
    return t.spark.read.parquet(f"{folder}/monthly")


@query("A17_protected_table", "SELECT o_orderstatus AS text, o_orderpriority AS owner, COUNT(*) AS n FROM orders GROUP BY 1, 2")
def protected_table(t):
    folder = sinks.shared_folder(t.spark, "protected")
    t.orders.select(C("o_orderstatus").alias("text"), C("o_orderpriority").alias("owner")).write.parquet(f"{folder}/notes")
    sinks.publish({"monthly": by_month(daily_search(t)), "notes": t.orders.limit(0)}, folder, protected={"notes": ["owner"]})
    return t.spark.read.parquet(f"{folder}/notes").groupBy("text", "owner").agg(F.count(F.lit(1)).alias("n"))


@query("A18_missing_columns", "SELECT p_partkey, p_name, CAST(NULL AS VARCHAR) AS owner, CAST(NULL AS BIGINT) AS effort FROM part")
def missing_columns(t):
    return sinks.with_missing_columns(t.part.select("p_partkey", "p_name"), {"p_name": "string", "owner": "string", "effort": "long"})


@query("A19_backfilled_property", """
WITH x AS (SELECT MIN(page_id) AS seq, site FROM (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*/)', 1) AS site FROM pages) GROUP BY 2)
SELECT page_id, CASE WHEN page_id % 2 = 0 THEN 'kept' ELSE regexp_extract(url, '^([a-z]+://[^/?#]*/)', 1) END AS site FROM pages""")
def backfilled(t):
    site = F.regexp_extract("url", "^([a-z]+://[^/?#]*/)", 1)
    configs = t.pages.select("page_id", site.alias("site")).groupBy("site").agg(F.min("page_id").alias("seq")).withColumn("property", C("site"))
    old = t.pages.select("page_id", C("url").alias("page"), F.when(C("page_id") % 2 == 0, "kept").alias("site"))
    matched = joins.page_property(t.pages.select(C("url").alias("page")), "page", configs)
    return landing.backfilled_property(old, matched).select("page_id", "site")


@query("A20_merged_config", """
SELECT c_custkey AS config_key, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment ELSE 'default' END AS value, 'todo' AS status FROM customer""")
def merged_config(t):
    template = t.customer.select(C("c_custkey").alias("config_key"), F.lit("default").alias("value"), F.lit("todo").alias("status"))
    existing = t.customer.select(C("c_custkey").alias("config_key"), F.when(C("c_custkey") % 2 == 0, C("c_mktsegment")).otherwise(" ").alias("value"), none().alias("status"))
    return landing.merged_config(template, existing, ["value", "status"]).select("config_key", "value", "status")


@query("A21_run_log", "SELECT 'run-1' AS run_id, 'GSC' AS source, (SELECT COUNT(*) FROM orders) AS rows_returned, 'READY' AS status UNION ALL SELECT 'run-2', 'GA4', (SELECT COUNT(*) FROM events), 'READY'")
def run_log(t):
    path = sinks.shared_folder(t.spark, "runs")
    runs = [{"run_id": "run-1", "source": "GSC", "rows_returned": t.orders.count(), "status": "READY"}, {"run_id": "run-2", "source": "GA4", "rows_returned": t.events.count(), "status": "READY"}]
    for run in [*runs, runs[0]]:
        sinks.log_run(t.spark, path, run)
    return t.spark.read.parquet(path).select("run_id", "source", "rows_returned", "status")


@query("A23_tsv_lines", "SELECT p_partkey || chr(9) || p_name || chr(9) || p_brand AS line FROM part")
def tsv_lines(t):
    return sinks.tsv_lines(t.part.select("p_partkey", "p_name", "p_brand"))


@query("A23_tsv_files", "SELECT CAST(p_partkey AS VARCHAR) AS p_partkey, p_name, p_brand FROM part")
def tsv_files(t):
    """Written as tab-separated files and read back as text."""
    path = sinks.shared_folder(t.spark, "tsv")
    sinks.write_tsv(t.part.select("p_partkey", "p_name", "p_brand"), path)
    return t.spark.read.csv(path, sep="\t", header=True, schema="p_partkey string, p_name string, p_brand string")


@query("A23_json_lines", """SELECT '{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_size":' || p_size || '}' AS line FROM part""")
def json_lines(t):
    return sinks.json_lines(t.part.select("p_name", "p_brand", "p_size"))


@query("A23_markdown_lines", "SELECT '| ' || p_name || ' | ' || CASE WHEN p_size % 2 = 0 THEN p_brand ELSE '—' END || ' |' AS line FROM part")
def markdown_lines(t):
    return sinks.markdown_lines(t.part.select("p_name", F.when(C("p_size") % 2 == 0, C("p_brand")).alias("b")))


# --- Normalisers ------------------------------------------------------------------------------------------

@query("K17_business_actuals", """
WITH r AS (SELECT *, CASE WHEN o_orderpriority = '5-LOW' THEN 'UNSUPPORTED_METRIC' WHEN o_orderkey % 11 = 0 THEN 'INVALID_PERIOD' WHEN o_orderkey % 7 = 0 THEN 'MAPPING_DRIFT' WHEN o_orderkey % 13 = 0 THEN 'UNKNOWN_SEGMENT' WHEN o_orderkey % 5 = 0 THEN 'MALFORMED_NUMBER' END AS p,
  date_trunc('month', o_orderdate)::DATE AS m FROM orders),
f AS (SELECT o_orderpriority, m, MIN(o_orderkey) AS first FROM r WHERE p IS NULL GROUP BY 1, 2)
SELECT o_orderkey AS row_no, CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 <> 0 THEN o_custkey END AS value, CASE WHEN p IS NOT NULL OR o_orderkey <> first THEN 'REJECTED' WHEN o_orderkey % 3 = 0 THEN 'PARTIAL' ELSE 'READY' END AS candidate_status,
  CASE WHEN p IS NOT NULL THEN p WHEN o_orderkey <> first THEN 'DUPLICATE_BUSINESS_KEY' END AS problem FROM r LEFT JOIN f ON f.o_orderpriority = r.o_orderpriority AND f.m = r.m""")
def business_actuals(t):
    key, month = C("o_orderkey"), F.date_format("o_orderdate", "MM")
    months = t.orders.select(month.alias("month")).distinct()
    metrics = F.array(*[F.lit(m) for m in ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED")])
    mapping = months.select(F.explode(metrics).alias("metric"), F.lit("2026").alias("source_tab"), F.lit(7).alias("source_row"), F.chr(64 + C("month").cast("int")).alias("source_column"), "month",
                            F.lit("Leads").alias("row_label"), F.array(F.lit("TW")).alias("allowed_segments"), F.lit("raw_only").alias("formula_policy"))
    rows = t.orders.select(
        key.alias("row_no"), C("o_orderpriority").alias("metric"), F.lit(" Leads ").alias("metric_label"), F.lit("2026").alias("source_tab"), F.when(key % 7 == 0, 8).otherwise(7).alias("source_row"), F.chr(64 + month.cast("int")).alias("source_column"),
        F.when(key % 11 == 0, "soon").otherwise(F.date_format("o_orderdate", "yyyy-MM")).alias("period"), F.when(key % 5 == 0, "about 7").when(key % 3 == 0, "n/a").otherwise(F.format_number("o_custkey", 0)).alias("actual"), none().alias("target"),
        F.when(key % 13 == 0, "JP").otherwise("TW").alias("segment"), F.lit("book-1").alias("source_reference"), none().alias("formula"))
    return normalise.business_actuals(rows, mapping, "2001-12-31", "book-1").select("row_no", "value", "candidate_status", "problem")


def keyword_input(t):
    keyword = C("l_linestatus") == "O"
    name = F.when(C("l_linenumber") != 7, F.concat(F.lit("k"), "l_suppkey"))
    return t.lineitem.select(
        (C("l_orderkey") * 1000000 + C("l_linenumber") * 100000 + C("l_suppkey")).alias("seq"), F.when(keyword, "organic_keywords").otherwise("organic_competitors").alias("endpoint"), F.lit("TW").alias("country"), C("l_partkey").cast("string").alias("target"),
        F.lit("2001-12-01").cast("date").alias("date"), F.when(keyword, name).alias("keyword"), F.when(~keyword, name).alias("competitor_domain"), none().alias("competitor_url"), none().alias("best_position_url"), C("l_linenumber").alias("best_position"),
        C("l_extendedprice").alias("volume"), C("l_extendedprice").alias("volume_target"), F.lit(3).alias("keyword_difficulty"), F.lit(1).alias("sum_traffic"), F.when(C("l_tax") == 0.08, -1).otherwise(1).alias("traffic"))


KEYWORD_SQL = """k AS (SELECT CASE l_linestatus WHEN 'O' THEN 'organic_keywords' ELSE 'organic_competitors' END AS endpoint, l_partkey, CASE WHEN l_linenumber <> 7 THEN 'k' || l_suppkey END AS subject, l_orderkey * 1000000 + l_linenumber * 100000 + l_suppkey AS seq, l_tax, l_extendedprice FROM lineitem),
n AS (SELECT endpoint, l_partkey, subject, COUNT(*) - 1 AS dropped, ARG_MIN(l_tax, seq) AS tax, ARG_MIN(l_extendedprice, seq) AS volume FROM k GROUP BY 1, 2, 3),
q AS (SELECT *, CASE WHEN subject IS NULL THEN 'MISSING_SUBJECT' WHEN endpoint = 'organic_competitors' AND tax = 0.08 THEN 'NEGATIVE_NUMBER' END AS problem FROM n)"""


@query("K19_keyword_rows", f"WITH {KEYWORD_SQL} SELECT endpoint, CAST(l_partkey AS VARCHAR) AS target, subject, volume, dropped, problem FROM q")
def keyword_rows(t):
    return normalise.keyword_rows(keyword_input(t), "2001-12-31").select("endpoint", "target", "subject", "volume", "dropped", "problem")


@query("A22_ingestion_manifest", f"""
WITH {KEYWORD_SQL} SELECT endpoint, CAST(COUNT(*) + SUM(dropped) AS BIGINT) AS returned_rows, COUNT(*) FILTER (problem IS NULL) AS accepted_rows, CAST(SUM(dropped) AS BIGINT) AS duplicate_rows, COUNT(problem) AS malformed_rows, 'PARTIAL' AS status FROM q GROUP BY 1""")
def ingestion_manifest(t):
    rows = normalise.keyword_rows(keyword_input(t), "2001-12-31")
    return normalise.ingestion_manifest(normalise.keyword_metadata(rows), rows)


@query("A22_run_status", "SELECT CAST(COUNT(*) AS BIGINT) AS returned_rows, 'STALE' AS status FROM lineitem")
def run_status(t):
    rows = normalise.keyword_rows(keyword_input(t), "2002-12-31")
    return normalise.run_status(normalise.ingestion_manifest(normalise.keyword_metadata(rows), rows)).select("returned_rows", "status")


def landed_pages(t):
    """One result-page snapshot per order, its line items as results."""
    url = F.concat(F.when(C("l_suppkey") % 2 == 0, F.lit("https://WWW.d")).otherwise(F.lit("http://d")), "l_suppkey", F.lit(".example/p?utm_source=x#f"))
    result = F.struct(C("l_linenumber").alias("rank"), url.alias("url"), F.lit("t").alias("title"), F.lit("s").alias("snippet"), F.when(C("l_linenumber") % 2 == 0, "Article").otherwise("odd").alias("result_type"))
    results = t.lineitem.groupBy(C("l_orderkey").alias("snapshot_id")).agg(F.collect_list(result).alias("organic_results"))
    key = C("o_orderkey")
    return t.orders.select(key.alias("snapshot_id"), F.when(key % 13 == 0, "FAILED").otherwise("READY").alias("freshness_state"), F.when(key % 13 == 0, "FAILED").otherwise("SUCCESS").alias("collection_status")).join(results, "snapshot_id", "left")


@query("K20_result_rows", """
SELECT l_orderkey AS snapshot_id, l_linenumber AS rank, CASE WHEN l_suppkey % 2 = 0 THEN 'https://www.d' ELSE 'http://d' END || l_suppkey || '.example/p' AS normalized_url, CASE WHEN l_linenumber % 2 = 0 THEN 'article' ELSE 'unknown' END AS result_type,
  CASE WHEN l_suppkey % 4 = 1 THEN 'OWNED' WHEN l_suppkey % 4 = 3 THEN 'COMPETITOR' ELSE 'UNMAPPED_DOMAIN' END AS match_state FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def result_rows(t):
    return landed_results(t).select("snapshot_id", "rank", "normalized_url", "result_type", "match_state")


@query("K20_url_match", """
SELECT l_orderkey AS snapshot_id, l_linenumber AS rank, CASE WHEN l_suppkey % 2 = 1 THEN 'CANONICAL' ELSE 'UNMAPPED_URL' END AS url_match_state, CASE WHEN l_suppkey % 2 = 1 THEN l_suppkey END AS url_id FROM lineitem JOIN orders ON o_orderkey = l_orderkey""")
def url_match(t):
    return landed_results(t).select("snapshot_id", "rank", "url_match_state", "url_id")


@query("K20_feature_states", """
WITH f AS (SELECT o_orderkey, o_orderkey % 5 = 0 AS twice, CASE o_orderstatus WHEN 'F' THEN 'OBSERVED' WHEN 'O' THEN 'NOT_OBSERVED' END AS state, CASE WHEN o_orderkey % 11 = 0 THEN 'INVALID_FIELD' WHEN o_orderstatus = 'P' THEN 'INVALID_FEATURE_STATE' END AS problem FROM orders)
SELECT o_orderkey AS snapshot_id, problem, CASE WHEN problem IS NOT NULL THEN '' WHEN twice THEN 'ai_overview=NOT_AVAILABLE,people_also_ask=OBSERVED' ELSE 'ai_overview=NOT_AVAILABLE,block' || o_orderkey % 4 || '=OBSERVED,people_also_ask=' || state END AS features FROM f""")
def feature_states(t):
    key, status = C("o_orderkey"), C("o_orderstatus")
    asked = F.when(status == "F", "observed").when(status == "O", "Not_observed").otherwise("odd")
    other = F.when(key % 5 == 0, "PEOPLE_ALSO_ASK").when(key % 11 == 0, " ").otherwise(F.concat(F.lit("Block"), key % 4))
    blank_name = F.when(key % 11 == 0, F.lit("")).otherwise("AI_Overview")
    seen = F.create_map(F.lit(" People_Also_Ask "), asked, blank_name, F.lit("NOT_AVAILABLE"), other, F.lit("OBSERVED"))
    rows = normalise.feature_states(t.orders.select(key.alias("snapshot_id"), seen.alias("serp_features")))
    pairs = F.transform(F.map_entries("features"), lambda e: F.concat_ws("=", e["key"], e["value"]))
    return rows.select("snapshot_id", C("feature_problem").alias("problem"), F.array_join(pairs, ",").alias("features"))


def landed_results(t):
    def name(c):
        return F.concat(F.lit("d"), c, F.lit(".example"))
    owned = t.supplier.where("s_suppkey % 4 = 1").select(name("s_suppkey").alias("domain"))
    rivals = t.supplier.where("s_suppkey % 4 = 3").select(name("s_suppkey").alias("domain"), F.concat(F.lit("C"), "s_suppkey").alias("competitor_id"))
    known = t.supplier.select(F.concat(F.lit("http://d"), "s_suppkey", F.lit(".example/p")).alias("normalized_url"), C("s_suppkey").alias("url_id"))
    return normalise.result_rows(landed_pages(t).where("organic_results IS NOT NULL"), owned, rivals, known)


@query("K20_page_states", """
WITH l AS (SELECT l_orderkey AS k, COUNT(*) AS n, COUNT(DISTINCT l_linenumber) AS d FROM lineitem GROUP BY 1)
SELECT o_orderkey AS snapshot_id, CASE WHEN d < n THEN 'DUPLICATE_RANK' END AS problem, CASE WHEN o_orderkey % 13 = 0 OR n IS NULL THEN 'FAILED' ELSE 'SUCCESS' END AS collection_status,
  CASE WHEN o_orderkey % 13 = 0 OR n IS NULL THEN 'FAILED' ELSE 'READY' END AS freshness_state, CASE WHEN o_orderkey % 13 = 0 OR n IS NULL THEN 0 ELSE n END AS observed_results FROM orders LEFT JOIN l ON l.k = o_orderkey""")
def page_states(t):
    return normalise.result_page_states(landed_pages(t)).select("snapshot_id", "problem", "collection_status", "freshness_state", "observed_results")


@query("K21_sample_errors", """
SELECT o_orderkey // 50 AS sample_id, COUNT(DISTINCT o_orderkey) AS population, CASE WHEN bool_or(o_orderkey % 9 = 0) THEN 'UNMAPPED_PROMPT' END AS problem FROM orders GROUP BY 1""")
def sample_errors(t):
    samples = t.orders.groupBy(F.floor(C("o_orderkey") / 50).alias("sample_id")).agg(F.collect_list(C("o_orderkey").cast("string")).alias("prompt_ids")).withColumns({
        "sample_version": F.lit("v1"), "status": F.lit("ACTIVE"), "effective_from": F.lit("2001-01-01").cast("date"), "effective_to": F.lit(None).cast("date")})
    prompts = t.orders.where("o_orderkey % 9 <> 0").select(C("o_orderkey").cast("string").alias("prompt_id"))
    return normalise.sample_errors(samples, prompts).select("sample_id", "population", "problem")


@query("K21_prompt_observations", """
SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 'UNMAPPED' WHEN event_id % 20 = 0 THEN 'SAMPLE_SCOPE_MISMATCH' END AS problem, CASE WHEN event_type = 'view' THEN 'OBSERVED' ELSE 'UNKNOWN' END AS citation_state, CASE WHEN event_type <> 'error' THEN round(value, 6) END AS visibility_value,
  event_type = 'click' AND user_id % 2 = 1 AS unknown_domain FROM events""")
def prompt_observations(t):
    return rounded(observations_of(t).select("event_id", "problem", "citation_state", "visibility_value", "unknown_domain"), "visibility_value")


@query("K21_capabilities", """
SELECT event_id, CASE WHEN user_id % 10 = 0 THEN 'UNMAPPED' WHEN event_id % 20 = 0 THEN 'SAMPLE_SCOPE_MISMATCH' WHEN event_type = 'click' THEN 'INVALID_CAPABILITY_STATE' WHEN event_type = 'view' AND user_id % 3 = 1 THEN 'INVALID_URL_IDENTITY' END AS problem,
  CASE event_type WHEN 'click' THEN 'SEEN' WHEN 'purchase' THEN 'NOT_OBSERVED' ELSE 'UNKNOWN' END AS mention_state, CASE WHEN event_type <> 'view' THEN 'NOT_AVAILABLE' WHEN user_id % 3 = 0 THEN 'CANONICAL' ELSE 'UNMAPPED_URL' END AS citation_url_match_state FROM events""")
def capabilities(t):
    kind, user = C("event_type"), C("user_id")
    cited = F.when(user % 3 == 0, "https://own.example/").when(user % 3 == 1, "ftp://own.example/").otherwise("https://cite.example/")
    out = observations_of(t, mention_state=F.when(kind == "click", "seen").when(kind == "purchase", "not_observed"), citation_url=F.when(kind == "view", cited))
    return out.select("event_id", "problem", "mention_state", "citation_url_match_state")


@query("K21_prompt_identity", """
SELECT l_orderkey, l_linenumber, l_partkey, CASE WHEN l_partkey % 9 = 0 THEN 'UNMAPPED_PROMPT' WHEN l_linenumber = 1 THEN 'PROMPT_IDENTITY_MISMATCH' WHEN l_linenumber = 3 THEN 'PROMPT_VERSION_MISMATCH' END AS prompt_problem FROM lineitem JOIN part ON p_partkey = l_partkey""")
def prompt_identity(t):
    line = C("l_linenumber")
    asked = F.when(line == 1, F.concat("p_name", F.lit(" x"))).when(line != 2, F.concat(F.lit("  "), F.upper("p_name")))
    rows = t.lineitem.join(t.part, C("p_partkey") == C("l_partkey")).select(
        "l_orderkey", "l_linenumber", "l_partkey", C("l_partkey").alias("prompt_id"), asked.alias("prompt_text"), F.when(line == 3, "v2").when(line != 2, "v1").alias("prompt_version"))
    return normalise.prompt_identity(rows, registered_prompts(t)).select("l_orderkey", "l_linenumber", "l_partkey", "prompt_problem")


def registered_prompts(t):
    return t.part.where("p_partkey % 9 <> 0").select(C("p_partkey").alias("prompt_id"), norm_text(C("p_name")).alias("normalized_text"), F.lit("v1").alias("prompt_version"))


@query("K21_named_samples", """
SELECT p_partkey // 4 AS sample_id, COUNT(*) AS population, CASE WHEN bool_or(p_partkey % 9 = 0) THEN 'UNMAPPED_PROMPT' WHEN bool_or(p_partkey % 7 = 0) THEN 'PROMPT_IDENTITY_MISMATCH' WHEN bool_or(p_partkey % 5 = 0) THEN 'PROMPT_VERSION_MISMATCH' END AS problem FROM part GROUP BY 1""")
def named_samples(t):
    key = C("p_partkey")
    member = F.struct(key.alias("prompt_id"), F.when(key % 7 == 0, "another").when(key % 2 == 0, F.upper("p_name")).alias("prompt_text"), F.when(key % 5 == 0, "v2").alias("prompt_version"))
    samples = t.part.groupBy(F.floor(key / 4).alias("sample_id")).agg(F.collect_list(member).alias("prompt_ids")).withColumns({
        "sample_version": F.lit("v1"), "status": F.lit("ACTIVE"), "effective_from": F.lit("2001-01-01").cast("date"), "effective_to": F.lit(None).cast("date")})
    return normalise.sample_errors(samples, registered_prompts(t)).select("sample_id", "population", "problem")


def observations_of(t, **more):
    kind, user = C("event_type"), C("user_id")
    fields = {f: F.lit("x") for f in joins.SAMPLE_SCOPE}
    rows = t.events.select(
        "event_id", user.alias("prompt_id"), none().alias("topic_id"), (user % 4).alias("sample_id"), F.lit("v1").alias("sample_version"), F.when(C("event_id") % 20 == 0, 2).otherwise(1).alias("sample_revision"), *[v.alias(f) for f, v in fields.items()],
        F.when(kind == "purchase", "https://own.example/").alias("owned_url"), F.when(kind == "view", "https://cite.example/").alias("citation_url"), F.when(kind == "click", F.concat(F.lit("D"), user % 2, F.lit(".example"))).alias("competitor_domain"),
        none().alias("citation_state"), none().alias("mention_state"), C("value").alias("visibility_value"), F.when(kind == "error", "FAILED").otherwise("READY").alias("freshness_state"), F.lit("SUCCESS").alias("collection_status"),
        *[F.to_date("ts").alias(n) for n in ("period_start", "period_end", "as_of")])
    users = t.events.select(user.alias("prompt_id")).distinct()
    prompts = users.where("prompt_id % 10 <> 0").withColumn("topic_refs", F.array(F.lit("T1")))
    samples = t.events.select((user % 4).alias("sample_id")).distinct().select("sample_id", F.lit("v1").alias("sample_version"), F.lit(1).alias("revision"), *[v.alias(f) for f, v in fields.items()])
    known = users.agg(F.max(F.lit("https://own.example/")).alias("normalized_url")).withColumn("url_id", F.lit("URL_1"))
    rivals = users.agg(F.max(F.lit("d0.example")).alias("domain")).withColumn("competitor_id", F.lit("C0"))
    shaped = rows.join(t.events.select("event_id", *[v.alias(f"new_{n}") for n, v in more.items()]), "event_id").withColumns(
        {n: C(f"new_{n}") for n in more}) if more else rows
    return normalise.prompt_observations(shaped, prompts, samples, known, rivals)


@query("K22_behaviour_evidence", f"""
WITH {URL_SQL}, r AS (SELECT normalized_url, COUNT(DISTINCT page_id) AS n FROM norm WHERE page_id % 3 <> 0 AND normalized_url IS NOT NULL GROUP BY 1)
SELECT norm.page_id AS row_id, array_to_string(list_filter([CASE WHEN norm.page_id % 7 = 0 THEN 'CHANNEL_OUT_OF_SCOPE' END, CASE WHEN norm.normalized_url IS NULL THEN 'INVALID_LANDING_PAGE' END, CASE WHEN norm.normalized_url IS NOT NULL AND n IS NULL THEN 'UNRESOLVED_ENTITY' END,
  CASE WHEN n > 1 THEN 'AMBIGUOUS_ENTITY' END, CASE WHEN norm.page_id % 5 = 0 THEN 'COUNT_NOT_WHOLE' END, CASE WHEN norm.page_id % 11 = 0 THEN 'INVALID_DATE_ORDER' END], lambda e: e IS NOT NULL), ',') AS errors FROM norm LEFT JOIN r ON r.normalized_url = norm.normalized_url""")
def behaviour_evidence(t):
    key, host = C("page_id"), F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    day = F.lit("2001-12-30").cast("date")
    rows = t.pages.select(
        key.alias("row_id"), F.lit("P").alias("property_id"), host.alias("hostname"), F.when(key % 7 == 0, "Direct").otherwise("Organic Search").alias("channel"), C("url").alias("landing_page"), F.lit("sessions").alias("metric"),
        F.when(key % 5 == 0, 1.5).otherwise(2.0).alias("value"), F.lit("COMPLETE").alias("coverage"), F.lit("READY").alias("freshness_state"), F.lit("SUCCESS").alias("collection_status"), F.when(key % 11 == 0, F.date_add(day, 1)).otherwise(day).alias("period_start"),
        day.alias("period_end"), day.alias("as_of"), F.lit("2001-12-31 00:00:00").cast("timestamp").alias("retrieved_at"), F.lit("PAGE_LEVEL").alias("quality_scope"))
    scope = t.pages.select(F.lit("P").alias("property_id"), host.alias("host")).distinct()
    known = registry.make_urls(t.pages.where("page_id % 3 <> 0").select("page_id", C("url").alias("observed_url"))).where("normalized_url IS NOT NULL").select("normalized_url", C("page_id").alias("url_id"))
    return normalise.behaviour_evidence(rows, scope, known).select("row_id", F.array_join("errors", ",").alias("errors"))


# --- Streams ----------------------------------------------------------------------------------------------

def event_stream(t):
    return jobs.landed_stream(t.spark, t.folder, "events.parquet").withColumn("ts", C("ts").cast("timestamp"))


def streamed(t, frame, name):
    out, checkpoint = sinks.shared_folder(t.spark, name), sinks.shared_folder(t.spark, f"{name}-checkpoint")
    jobs.run_available(frame, out, checkpoint)
    return t.spark.read.schema(frame.schema).parquet(out)


@query("I1_settled_days", """
SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS n, CAST(SUM(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS cents FROM events GROUP BY 1, 2
HAVING CAST(ts AS DATE) + INTERVAL 1 DAY <= (SELECT MAX(ts) FROM events) - INTERVAL 10 DAY""")
def settled_days(t):
    days = jobs.settled_days(event_stream(t), "ts", ["event_type"], {"n": F.count(F.lit(1)), "cents": F.sum(F.round(C("value") * 100).cast("long"))})
    return streamed(t, days, "settled")


@query("I1_replace_pulls", """
WITH e AS (SELECT CAST(ts AS DATE) AS date, event_type, COUNT(*) AS n FROM events GROUP BY 1, 2)
SELECT date, event_type, CASE WHEN date >= DATE '2024-01-10' AND date <= DATE '2024-01-20' THEN n * 2 ELSE n END AS n FROM e""")
def replace_pulls(t):
    """A daily table and one landed pull that restates eleven of its days."""
    daily = t.events.groupBy(F.to_date("ts").alias("date"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    path, pulls = sinks.shared_folder(t.spark, "pulled"), sinks.shared_folder(t.spark, "pulls")
    table = "sightline_" + path.rsplit("-", 1)[1]
    sinks.create_daily_table(daily, table, path, ["event_type"])
    daily.where("date BETWEEN DATE '2024-01-10' AND DATE '2024-01-20'").select("date", "event_type", (C("n") * 2).alias("n"), F.lit("2024-01-20").cast("date").alias("pull_end")).write.parquet(pulls)
    stream = jobs.landed_stream(t.spark, pulls, "*.parquet")
    jobs.replace_pulls(stream, table, ["event_type"], sinks.shared_folder(t.spark, "pulls-checkpoint")).awaitTermination()
    return t.spark.table(table).select("date", "event_type", "n")


@query("I2_append_revisions", "SELECT id, CAST(revision AS BIGINT) AS revision, status FROM revision_log")
def append_revisions(t):
    """The first half of every customer's history is stored; a stream then brings all of it."""
    full = t.revision_log.select("id", C("revision").cast("long").alias("revision"), "status", F.md5(F.concat_ws("|", "status", "value")).alias("content_hash"), F.when(C("revision") > 1, C("revision") - 1).cast("long").alias("supersedes_revision"))
    half = full.groupBy("id").agg(F.ceil(F.max("revision") / 2).alias("_tip"))
    log, incoming = sinks.shared_folder(t.spark, "log"), sinks.shared_folder(t.spark, "incoming")
    jobs.create_revision_log(full.join(half, "id").where("revision <= _tip").drop("_tip"), log, ["id"])
    full.write.parquet(incoming)
    jobs.append_revisions(jobs.landed_stream(t.spark, incoming, "*.parquet"), log, ["id"], sinks.shared_folder(t.spark, "log-checkpoint")).awaitTermination()
    return t.spark.read.parquet(log).select("id", "revision", "status")


@query("I3_first_operations", "SELECT COUNT(DISTINCT user_id || event_type) AS operations FROM events")
def first_operations(t):
    firsts = jobs.first_operations(event_stream(t).select("ts", "user_id", "event_type"), "ts", ["user_id", "event_type"], "60 days")
    return streamed(t, firsts, "firsts").agg(F.count(F.lit(1)).alias("operations"))


@query("I4_sliding_windows", """
WITH w AS (SELECT event_type, CAST(time_bucket(INTERVAL 7 DAY, ts, TIMESTAMP '1970-01-01') AS DATE) AS s FROM events),
x AS (SELECT event_type, s - 7 * k AS first_day, s - 7 * k + 28 AS end_day FROM w, (VALUES (0), (1), (2), (3)) g(k))
SELECT first_day, end_day, event_type, COUNT(*) AS n FROM x GROUP BY 1, 2, 3 HAVING end_day <= (SELECT MAX(ts) FROM events) - INTERVAL 1 DAY""")
def sliding_windows(t):
    return streamed(t, jobs.sliding_windows(event_stream(t), "ts", ["event_type"], {"n": F.count(F.lit(1))}), "sliding")


@query("I5_complete_until", """
SELECT LEAST((SELECT MAX(CAST(ts AS DATE)) FROM events), (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem)) - 6 AS first_day, LEAST((SELECT MAX(CAST(ts AS DATE)) FROM events), (SELECT MAX(CAST(l_shipdate AS DATE)) FROM lineitem)) AS last_day""")
def complete_until(t):
    return jobs.complete_until([t.events.select(C("ts").alias("d")), t.lineitem.select(C("l_shipdate").alias("d"))], "d")


def state_log(t):
    return t.orders.select(C("o_custkey").alias("id"), C("o_orderkey").alias("revision"), F.to_date("o_orderdate").alias("as_of"), F.when(C("o_orderstatus") == "F", "FAILED").otherwise("READY").alias("freshness_state"), F.lit("SUCCESS").alias("collection_status"))


VIEW_SQL = """v AS (SELECT o_custkey AS id, ARG_MAX(o_orderstatus, o_orderkey) AS s, CAST(ARG_MAX(o_orderdate, o_orderkey) AS DATE) AS d FROM orders GROUP BY 1),
c AS (SELECT id, CASE WHEN s = 'F' THEN 'FAILED' WHEN DATE '2000-06-30' - d BETWEEN 0 AND 35 THEN 'READY' ELSE 'STALE' END AS view_state FROM v)"""


@query("I6_current_view", f"WITH {VIEW_SQL} SELECT * FROM c")
def current_view(t):
    return jobs.current_view(state_log(t), ["id"], F.lit("BUSINESS"), "2000-06-30").select("id", "view_state")


@query("I6_enriched_stream", f"WITH {VIEW_SQL} SELECT event_id, view_state FROM events LEFT JOIN c ON c.id = user_id")
def enriched_stream(t):
    view = jobs.current_view(state_log(t), ["id"], F.lit("BUSINESS"), "2000-06-30")
    stream = event_stream(t).select("event_id", C("user_id").alias("id"))
    return streamed(t, jobs.enriched_stream(stream, view, ["id"]).select("event_id", "view_state"), "enriched")
