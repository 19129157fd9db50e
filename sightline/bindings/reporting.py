"""Periods, aggregates, windows and chart shapes over the search, behaviour and business views."""

from pyspark.sql import functions as F

from sightline.bindings.core import query
from sightline.functions.dates import month_key
from sightline.operators import charts, facts, periods
from sightline.operators.charts import rounded

MONTH = "SUBSTR(CAST(day AS VARCHAR), 1, 7)"
SITE_MONTH = f"""SELECT site, {MONTH} AS month, COUNT(DISTINCT day) AS days, CAST(SUM(clicks) AS BIGINT) AS clicks,
    CAST(SUM(impressions) AS BIGINT) AS impressions, SUM(clicks)::DOUBLE / NULLIF(SUM(impressions), 0) AS ctr,
    SUM(position * impressions)::DOUBLE / NULLIF(SUM(impressions), 0) AS position
    FROM search_daily GROUP BY 1, 2"""


# --- Aggregates -------------------------------------------------------------------------------------------

@query("D1_site_month_totals", f"""
SELECT site, month, days, clicks, impressions, ROUND(ctr, 6) AS ctr, ROUND(position, 6) AS position
FROM ({SITE_MONTH})""")
def site_month_totals(t):
    return rounded(facts.site_month_totals(t.search_daily), "ctr", "position")


@query("D2_channel_totals", f"""
SELECT site, channel, {MONTH} AS month, CAST(SUM(sessions) AS BIGINT) AS sessions, CAST(SUM(engaged) AS BIGINT) AS engaged,
       ROUND(SUM(engaged)::DOUBLE / NULLIF(SUM(sessions), 0), 6) AS engagement_rate
FROM behaviour_daily GROUP BY 1, 2, 3""")
def channel_totals(t):
    return rounded(facts.channel_totals(t.behaviour_daily), "engagement_rate")


@query("D3_share_of_channel", f"""
WITH m AS (SELECT site, channel, {MONTH} AS month, CAST(SUM(sessions) AS BIGINT) AS sessions FROM behaviour_daily GROUP BY 1, 2, 3)
SELECT site, month, channel, sessions, CASE WHEN channel <> 'view' THEN
    ROUND(sessions::DOUBLE / MAX(CASE WHEN channel = 'view' THEN sessions END) OVER (PARTITION BY site, month), 6) END AS share_of_base
FROM m""")
def share_of_channel(t):
    return rounded(facts.share_of_channel(facts.channel_totals(t.behaviour_daily), "view"), "share_of_base")


@query("D4_visibility_by_month", f"""
SELECT entity, {MONTH} AS month, ROUND(AVG(visibility), 6) AS visibility, ROUND(AVG(sov), 6) AS sov,
       CAST(SUM(mentions) AS BIGINT) AS mentions, COUNT(DISTINCT day) AS days
FROM visibility_daily GROUP BY 1, 2""")
def visibility_by_month(t):
    return rounded(facts.visibility_by_month(t.visibility_daily), "visibility", "sov")


@query("D4_visibility_comparison", """
WITH m AS (SELECT entity,
    AVG(visibility) FILTER (day BETWEEN DATE '2024-01-01' AND DATE '2024-01-04') AS visibility_previous,
    AVG(visibility) FILTER (day BETWEEN DATE '2024-01-05' AND DATE '2024-01-09') AS visibility_current,
    AVG(sov) FILTER (day BETWEEN DATE '2024-01-01' AND DATE '2024-01-04') AS sov_previous,
    AVG(sov) FILTER (day BETWEEN DATE '2024-01-05' AND DATE '2024-01-09') AS sov_current
  FROM visibility_daily GROUP BY 1)
SELECT entity, ROUND(visibility_previous, 6) AS visibility_previous, ROUND(visibility_current, 6) AS visibility_current,
       ROUND(sov_previous, 6) AS sov_previous, ROUND(sov_current, 6) AS sov_current,
       ROUND((visibility_current - visibility_previous) * 100, 6) AS visibility_change_pp FROM m""")
def visibility_comparison(t):
    df = facts.visibility_comparison(t.visibility_daily, ("2024-01-05", "2024-01-09"), ("2024-01-01", "2024-01-04"))
    return rounded(df, *df.columns[1:])


def business(t):
    return t.business_monthly


@query("D5_attainment", """
WITH b AS (SELECT month, leads AS actual, target_leads AS target, CAST(month || '-01' AS DATE) AS d FROM business_monthly)
SELECT b.month, b.actual, b.target, ROUND(b.actual::DOUBLE / NULLIF(b.target, 0), 6) AS reach,
       ROUND(b.actual::DOUBLE / NULLIF(p.actual, 0) - 1, 6) AS mom_change, b.target - b.actual AS gap
FROM b LEFT JOIN b p ON p.d + INTERVAL 1 MONTH = b.d""")
def attainment(t):
    renamed = business(t).select("month", F.col("leads").alias("actual"), F.col("target_leads").alias("target"))
    return rounded(facts.attainment(renamed), "reach", "mom_change")


@query("D6_mature_cohorts", """
WITH b AS (SELECT *, LAST_DAY(CAST(month || '-01' AS DATE)) + 60 <= DATE '2000-06-30' AS mature FROM business_monthly),
s AS (SELECT COUNT(*) FILTER (mature) AS mature_months, COUNT(*) FILTER (NOT mature) AS open_months,
    CAST(SUM(leads) FILTER (mature) AS BIGINT) AS leads, CAST(SUM(conversions) FILTER (mature) AS BIGINT) AS conversions,
    SUM(target_leads) FILTER (mature) AS tl, SUM(target_conversions) FILTER (mature) AS tc FROM b)
SELECT mature_months, open_months, leads, conversions, ROUND(conversions::DOUBLE / leads, 6) AS rate,
       ROUND(tc::DOUBLE / tl, 6) AS target_rate, ROUND(conversions::DOUBLE / leads - tc::DOUBLE / tl, 6) AS rate_gap FROM s""")
def mature_cohorts(t):
    return rounded(facts.mature_cohorts(business(t), "2000-06-30"), "rate", "target_rate", "rate_gap")


@query("D7_headline", """
SELECT (SELECT CAST(SUM(clicks) AS BIGINT) FROM search_daily) AS clicks,
       (SELECT CAST(SUM(sessions) AS BIGINT) FROM behaviour_daily) AS sessions,
       (SELECT CAST(SUM(leads) AS BIGINT) FROM business_monthly) AS leads""")
def headline(t):
    scalars = facts.headline({
        "clicks": t.search_daily.agg(F.sum("clicks")), "sessions": t.behaviour_daily.agg(F.sum("sessions")),
        "leads": business(t).agg(F.sum("leads"))})
    return t.spark.range(1).select(*scalars.values())


VITAL_EVENTS = {"click": "largest_contentful_paint", "view": "interaction_to_next_paint",
                "purchase": "cumulative_layout_shift"}


def vitals(t):
    """One p75 per user and core vital, derived from the events of three types."""
    scale = {"click": 100, "view": 10, "purchase": 0.01}
    p75 = t.events.where(F.col("event_type").isin(list(scale))).groupBy("user_id", "event_type").agg(
        F.max(F.round(F.col("value") * 100).cast("long")).alias("cents"))
    name = F.create_map(*[F.lit(x) for pair in VITAL_EVENTS.items() for x in pair])[F.col("event_type")]
    factor = F.create_map(*[F.lit(x) for k, v in scale.items() for x in (k, float(v))])[F.col("event_type")]
    return p75.select("user_id", name.alias("metric"), (F.col("cents") / 100 * factor).alias("p75"))


VITALS_SQL = """SELECT user_id, metric, CASE WHEN p75 <= good THEN 'GOOD' WHEN p75 <= poor THEN 'NEEDS_IMPROVEMENT' ELSE 'POOR' END AS rating
FROM (SELECT user_id, c.metric, MAX(CAST(ROUND(value * 100) AS BIGINT))::DOUBLE / 100 * factor AS p75, good, poor
      FROM events JOIN (VALUES ('click', 'largest_contentful_paint', 100::DOUBLE, 2500::DOUBLE, 4000::DOUBLE),
        ('view', 'interaction_to_next_paint', 10::DOUBLE, 200::DOUBLE, 500::DOUBLE),
        ('purchase', 'cumulative_layout_shift', 0.01::DOUBLE, 0.1::DOUBLE, 0.25::DOUBLE)) c(event_type, metric, factor, good, poor)
      ON events.event_type = c.event_type GROUP BY user_id, c.metric, factor, good, poor)"""


@query("D8_vitals_assessment", f"""
SELECT user_id, COUNT(*) AS rated, CASE WHEN COUNT(*) < 3 THEN 'INSUFFICIENT'
  WHEN BOOL_AND(rating = 'GOOD') THEN 'PASS' ELSE 'FAIL' END AS assessment FROM ({VITALS_SQL}) GROUP BY 1""")
def vitals_assessment(t):
    return facts.vitals_assessment(vitals(t), ["user_id"])


@query("D9_dashboard_counters", """
SELECT COUNT(*) AS rows, COUNT(*) FILTER (o_orderstatus = 'F') AS done,
       COUNT(*) FILTER (o_orderstatus = 'O' AND o_totalprice > 100000) AS open_large,
       COUNT(*) FILTER (o_orderpriority LIKE '%HIGH%') AS high,
       ARG_MAX(o_orderstatus, o_orderkey) AS last_o_orderstatus FROM orders""")
def dashboard_counters(t):
    return facts.dashboard_counters(t.orders, {
        "done": F.col("o_orderstatus") == "F",
        "open_large": (F.col("o_orderstatus") == "O") & (F.col("o_totalprice") > 100000),
        "high": F.col("o_orderpriority").like("%HIGH%")}, latest=("o_orderstatus", "o_orderkey"))


@query("D10_import_summary", """
SELECT o_orderstatus AS status, COUNT(*) AS rows,
  COUNT(DISTINCT CASE WHEN o_totalprice < 50000 THEN o_custkey END) AS error_rows,
  COUNT(CASE WHEN o_totalprice < 50000 THEN 1 END) AS errors FROM orders GROUP BY 1""")
def import_summary(t):
    rows = t.orders.select(F.col("o_orderstatus").alias("status"), "o_custkey",
                           F.when(F.col("o_totalprice") < 50000, "TOO_SMALL").alias("code"))
    return facts.status_summary(rows, "status", "code", "o_custkey")


@query("D11_dominant_kind", """
WITH c AS (SELECT o_custkey, o_orderpriority AS kind, COUNT(*) AS n FROM orders GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY n DESC, kind) AS rn,
  SUM(n) OVER (PARTITION BY o_custkey) AS total, COUNT(*) OVER (PARTITION BY o_custkey) AS kinds FROM c)
SELECT o_custkey, CAST(total AS BIGINT) AS total, CASE WHEN kinds > 1 AND n::DOUBLE / total < 0.6 THEN 'MIXED' ELSE kind END AS dominant
FROM r WHERE rn = 1""")
def dominant_kind(t):
    return facts.dominant_kind(t.orders, ["o_custkey"], "o_orderpriority", "dominant")


@query("D12_fold_states", """
WITH s AS (SELECT o_custkey, CASE o_orderstatus WHEN 'F' THEN 'OBSERVED' WHEN 'O' THEN 'NOT_OBSERVED' ELSE 'NOT_AVAILABLE' END AS s FROM orders)
SELECT o_custkey, CASE WHEN BOOL_OR(s = 'OBSERVED') THEN 'OBSERVED' WHEN BOOL_AND(s = 'NOT_OBSERVED') THEN 'NOT_OBSERVED'
  WHEN BOOL_OR(s = 'NOT_AVAILABLE') THEN 'NOT_AVAILABLE' ELSE 'UNKNOWN' END AS mention_state FROM s GROUP BY 1""")
def fold_states(t):
    states = t.orders.select("o_custkey", F.when(F.col("o_orderstatus") == "F", "OBSERVED").when(
        F.col("o_orderstatus") == "O", "NOT_OBSERVED").otherwise("NOT_AVAILABLE").alias("state"))
    return facts.fold_states(states, ["o_custkey"], "state", "mention_state")


@query("D13_independent_families", """
SELECT l_partkey, COUNT(DISTINCT l_orderkey) AS evidence, COUNT(DISTINCT l_returnflag) AS families FROM lineitem GROUP BY 1""")
def independent_families(t):
    evidence = t.lineitem.select("l_partkey", F.col("l_orderkey").alias("evidence_id"), F.col("l_returnflag").alias("source"))
    return facts.independent_families(evidence, ["l_partkey"])


@query("D14_reference_sets", "SELECT l_partkey, l_suppkey, COUNT(*) AS mentions FROM lineitem GROUP BY 1, 2")
def reference_sets(t):
    return facts.reference_sets(t.lineitem, "l_partkey", "l_suppkey")


@query("D15_histogram", """
WITH s AS (SELECT MIN(o_totalprice) AS low, MAX(o_totalprice) AS high, COUNT(*) AS n FROM orders),
a AS (SELECT *, (high - low) / GREATEST(1, LEAST(16, CEIL(SQRT(n)))) AS raw FROM s),
b AS (SELECT *, POW(10::DOUBLE, FLOOR(LOG10(raw))) AS unit FROM a),
w AS (SELECT *, CASE WHEN raw / unit <= 1 THEN 1 WHEN raw / unit <= 2 THEN 2 WHEN raw / unit <= 5 THEN 5 ELSE 10 END * unit AS width FROM b),
f AS (SELECT width, FLOOR(low / width) * width AS first, CAST(GREATEST(1, CEIL((high - FLOOR(low / width) * width) / width)) AS BIGINT) AS bins FROM w),
c AS (SELECT LEAST(f.bins - 1, GREATEST(0, CAST(FLOOR((o_totalprice - f.first) / f.width) AS BIGINT))) AS bin, COUNT(*) AS n FROM orders, f GROUP BY 1)
SELECT g.bin, f.first + g.bin * f.width AS start, f.first + (g.bin + 1) * f.width AS "end", COALESCE(c.n, 0) AS count
FROM f, (SELECT UNNEST(RANGE(f.bins)) AS bin FROM f) g LEFT JOIN c ON c.bin = g.bin""")
def histogram(t):
    return charts.histogram(t.orders, "o_totalprice")


@query("D16_box_plots", """
SELECT l_returnflag, ROUND(MIN(l_extendedprice), 6) AS minimum, ROUND(QUANTILE_CONT(l_extendedprice, 0.25), 6) AS lower_quartile,
  ROUND(QUANTILE_CONT(l_extendedprice, 0.5), 6) AS median, ROUND(QUANTILE_CONT(l_extendedprice, 0.75), 6) AS upper_quartile,
  ROUND(MAX(l_extendedprice), 6) AS maximum,
  ROUND(QUANTILE_CONT(l_extendedprice, 0.75) - QUANTILE_CONT(l_extendedprice, 0.25), 6) AS spread
FROM lineitem GROUP BY 1""")
def box_plots(t):
    df = charts.box_plots(t.lineitem, "l_returnflag", "l_extendedprice")
    return rounded(df, *df.columns[1:])


@query("D16_summarised_boxes", """
SELECT l_shipmode_key AS part, low AS minimum, q1 AS lower_quartile, mid AS median, q3 AS upper_quartile, high AS maximum, q3 - q1 AS spread
FROM (SELECT l_suppkey AS l_shipmode_key, MIN(l_quantity) AS low, MIN(l_quantity) + 1 AS q1, MIN(l_quantity) + 2 AS mid, MAX(l_quantity) + 3 AS q3, MAX(l_quantity) + 4 AS high FROM lineitem GROUP BY 1)""")
def summarised_boxes(t):
    ready = t.lineitem.groupBy(F.col("l_suppkey").alias("part")).agg(
        F.min("l_quantity").alias("minimum"), (F.min("l_quantity") + 1).alias("lower_quartile"), (F.min("l_quantity") + 2).alias("median"),
        (F.max("l_quantity") + 3).alias("upper_quartile"), (F.max("l_quantity") + 4).alias("maximum"))
    return charts.summarised_box_plots(ready)


@query("D17_top_categories", """
WITH v AS (SELECT CAST(l_partkey AS VARCHAR) AS page, CAST(SUM(l_quantity) AS BIGINT) AS clicks FROM lineitem GROUP BY 1),
r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY CASE WHEN page = '7' THEN 0 ELSE 1 END, clicks DESC, page) AS rn FROM v)
SELECT CASE WHEN rn <= 6 THEN page ELSE 'Other' END AS page, CAST(SUM(clicks) AS BIGINT) AS clicks FROM r GROUP BY 1""")
def top_categories(t):
    pages = t.search_daily.groupBy(F.col("page").cast("string").alias("page")).agg(F.sum("clicks").alias("clicks"))
    return charts.top_categories(pages, "page", "clicks", limit=7, preserve=["7"])


@query("D18_top_series", f"""
WITH v AS (SELECT {MONTH} AS month, CAST(query AS VARCHAR) AS query, CAST(SUM(clicks) AS BIGINT) AS clicks FROM search_daily GROUP BY 1, 2),
p AS (SELECT query, ROW_NUMBER() OVER (ORDER BY MAX(clicks) DESC, query) AS rn FROM v GROUP BY 1)
SELECT month, CASE WHEN rn <= 4 THEN v.query ELSE 'Other' END AS query, CAST(SUM(clicks) AS BIGINT) AS clicks
FROM v JOIN p ON v.query = p.query GROUP BY 1, 2""")
def top_series(t):
    rows = t.search_daily.groupBy(month_key(F.col("day")).alias("month"), F.col("query").cast("string").alias("query")).agg(
        F.sum("clicks").alias("clicks"))
    return charts.top_series(rows, "month", "query", "clicks", limit=5)


@query("D19_distribution_bars", """
WITH c AS (SELECT LEAST(11, CAST(FLOOR(value / 100 * 12) AS INTEGER)) AS bucket, COUNT(*) AS n FROM events WHERE value BETWEEN 0 AND 100 GROUP BY 1)
SELECT CAST(g.b AS INTEGER) AS bucket, COALESCE(n, 0) AS count, ROUND(GREATEST(10::DOUBLE, COALESCE(n, 0)::DOUBLE / (SELECT MAX(n) FROM c) * 100), 6) AS height
FROM RANGE(12) g(b) LEFT JOIN c ON c.bucket = g.b""")
def distribution_bars(t):
    return rounded(charts.distribution_bars(t.events, "value"), "height")


def user_paths(t):
    """Every event with the two that follow it on the same day of its user, as a path of three stages."""
    order = charts.Window.partitionBy("user_id", F.to_date("ts")).orderBy("event_id")
    return t.events.select(F.col("event_type").alias("s1"), *[F.lead("event_type", i).over(order).alias(f"s{i + 1}") for i in (1, 2)], F.lit(1).cast("long").alias("amount"))


PATHS_SQL = """p AS (SELECT event_type AS s1, LEAD(event_type) OVER w AS s2, LEAD(event_type, 2) OVER w AS s3, 1 AS amount
  FROM events WINDOW w AS (PARTITION BY user_id, CAST(ts AS DATE) ORDER BY event_id))"""


@query("D20_sankey", f"""
WITH {PATHS_SQL}
SELECT source_stage, source, target_stage, target, CAST(SUM(amount) AS BIGINT) AS value FROM (
  SELECT 0 AS source_stage, s1 AS source, 1 AS target_stage, s2 AS target, amount FROM p WHERE s1 IS NOT NULL AND s2 IS NOT NULL
  UNION ALL SELECT 1, s2, 2, s3, amount FROM p WHERE s2 IS NOT NULL AND s3 IS NOT NULL) GROUP BY 1, 2, 3, 4""")
def sankey(t):
    return charts.sankey_links(user_paths(t), ["s1", "s2", "s3"], "amount")


@query("D20_sankey_nodes", f"""
WITH {PATHS_SQL}
SELECT 0 AS stage, s1 AS name FROM p WHERE s2 IS NOT NULL UNION SELECT 1, s2 FROM p WHERE s2 IS NOT NULL
UNION SELECT 2, s3 FROM p WHERE s3 IS NOT NULL""")
def sankey_nodes(t):
    return charts.sankey_nodes(charts.sankey_links(user_paths(t), ["s1", "s2", "s3"], "amount"))


@query("D21_share_of_total", """
WITH q AS (SELECT query, CAST(SUM(clicks) AS BIGINT) AS clicks FROM search_daily GROUP BY 1)
SELECT query, clicks, ROUND(clicks::DOUBLE / SUM(clicks) OVER (), 6) AS share FROM q""")
def share_of_total(t):
    return rounded(charts.share_of_total(t.search_daily.groupBy("query").agg(F.sum("clicks").alias("clicks")), "clicks"), "share")


@query("D21_stacked_share", f"""
WITH q AS (SELECT {MONTH} AS month, site, CAST(SUM(clicks) AS BIGINT) AS clicks FROM search_daily GROUP BY 1, 2)
SELECT month, site, clicks, ROUND(clicks::DOUBLE / SUM(clicks) OVER (PARTITION BY month), 6) AS share FROM q""")
def stacked_share(t):
    rows = t.search_daily.groupBy(month_key(F.col("day")).alias("month"), "site").agg(F.sum("clicks").alias("clicks"))
    return rounded(charts.share_of_total(rows, "clicks", ["month"]), "share")


@query("D22_sitemap_counts", """
SELECT o_custkey, COUNT(*) AS entries, CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) AS BIGINT) AS submitted,
  CAST(SUM(o_orderkey) AS BIGINT) AS indexed FROM orders GROUP BY 1""")
def sitemap_counts(t):
    breakdown = t.orders.groupBy("o_custkey", "o_orderpriority").agg(
        F.sum(F.floor("o_totalprice")).cast("string").alias("submitted"), F.sum("o_orderkey").cast("string").alias("indexed"),
        F.count(F.lit(1)).alias("n"))
    sitemaps = breakdown.groupBy("o_custkey").agg(
        F.sum("n").alias("entries"), F.collect_list(F.struct("submitted", "indexed")).alias("breakdown"))
    return facts.sitemap_counts(sitemaps).drop("breakdown")


@query("D23_pivot", f"""
SELECT {MONTH} AS month, CAST(SUM(clicks) FILTER (site = 'A') AS BIGINT) AS "A", CAST(SUM(clicks) FILTER (site = 'N') AS BIGINT) AS "N",
       CAST(SUM(clicks) FILTER (site = 'R') AS BIGINT) AS "R" FROM search_daily GROUP BY 1""")
def pivot(t):
    rows = t.search_daily.withColumn("month", month_key(F.col("day")))
    return charts.pivot(rows, "month", "site", ["A", "N", "R"], "clicks")


@query("D24_event_state", """
WITH e AS (SELECT user_id, CASE WHEN event_type = 'purchase' THEN 1 WHEN event_type = 'click' THEN 0 END AS c FROM events)
SELECT user_id, CAST(SUM(c) AS BIGINT) AS events, CASE WHEN COUNT(c) = 0 THEN 'NOT_AVAILABLE' WHEN SUM(c) > 0 THEN 'PRESENT' ELSE 'WEAK' END AS state
FROM e GROUP BY 1""")
def event_state(t):
    rows = t.events.select("user_id", F.when(F.col("event_type") == "purchase", 1).when(
        F.col("event_type") == "click", 0).alias("event_count"))
    return facts.event_state(rows, ["user_id"])


@query("D25_platform_overview", """
WITH p AS (SELECT day, entity, AVG(visibility) AS m FROM visibility_daily GROUP BY 1, 2)
SELECT day, ROUND(AVG(m), 6) AS overview, COUNT(m) AS platforms FROM p GROUP BY 1""")
def platform_overview(t):
    return rounded(facts.platform_overview(t.visibility_daily, "entity", "visibility", ["day"]), "overview")


@query("D26_date_coverage", "SELECT site, MIN(day) AS first_day, MAX(day) AS last_day, COUNT(DISTINCT day) AS days FROM search_daily GROUP BY 1")
def date_coverage(t):
    return facts.date_coverage(t.search_daily, "day", ["site"])


@query("D27_table_counts", """
SELECT 'orders' AS "table", COUNT(*) AS rows FROM orders UNION ALL SELECT 'events', COUNT(*) FROM events
UNION ALL SELECT 'search_daily', COUNT(*) FROM search_daily""")
def table_counts(t):
    return facts.table_counts({"orders": t.orders, "events": t.events, "search_daily": t.search_daily})


@query("D27_crawl_metadata", """
SELECT l_returnflag AS crawl_id, CAST(SUM(l_quantity) FILTER (l_linestatus = 'O') AS BIGINT) AS urls_crawled,
  CAST(SUM(l_quantity) FILTER (l_linestatus = 'F') AS BIGINT) AS urls_indexable FROM lineitem GROUP BY 1""")
def crawl_metadata(t):
    metrics = t.lineitem.groupBy(F.col("l_returnflag").alias("crawl_id"), F.col("l_linestatus").alias("metric")).agg(
        F.sum("l_quantity").cast("long").alias("value"))
    return facts.crawl_metadata(metrics, {"urls_crawled": "O", "urls_indexable": "F"})


@query("D28_annotation_values", """
SELECT CAST(o_orderdate AS DATE) AS day,
  CASE WHEN MIN(o_custkey % 2) = MAX(o_custkey % 2) THEN MIN(o_custkey % 2) END AS benchmark,
  CASE WHEN MIN(o_orderstatus) = MAX(o_orderstatus) THEN MIN(o_orderstatus) END AS event FROM orders GROUP BY 1""")
def annotation_values(t):
    rows = t.orders.select(F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 2).alias("b"), F.col("o_orderstatus").alias("e"))
    return charts.annotation_values(rows, "day", "b", "e")


@query("D29_search_rollup", f"""
SELECT COALESCE(site, 'all') AS site, COALESCE(month, 'all') AS month, CAST(SUM(clicks) AS BIGINT) AS clicks,
  CAST(SUM(impressions) AS BIGINT) AS impressions, ROUND(SUM(clicks)::DOUBLE / SUM(impressions), 6) AS ctr
FROM (SELECT *, {MONTH} AS month FROM search_daily) GROUP BY CUBE (site, month)""")
def search_rollup(t):
    return rounded(facts.search_rollup(t.search_daily), "ctr")


WATERFALL_SQL = f"""w AS (SELECT site || SUBSTR(month, 1, 4) AS site, CAST(SUBSTR(month, 6, 2) AS INTEGER) AS seq,
    CASE WHEN SUBSTR(month, 6, 2) = '01' THEN 'Opening balance' ELSE month END AS label, CAST(SUM(clicks) AS DOUBLE) AS v
  FROM (SELECT *, {MONTH} AS month FROM search_daily) GROUP BY site, month)"""


def site_waterfall(t):
    rows = t.search_daily.groupBy("site", month_key(F.col("day")).alias("month")).agg(F.sum("clicks").cast("double").alias("v")).select(
        F.concat("site", F.substring("month", 1, 4)).alias("site"), F.substring("month", 6, 2).cast("int").alias("seq"),
        F.when(F.substring("month", 6, 2) == "01", "Opening balance").otherwise(F.col("month")).alias("label"), "v")
    return charts.waterfall(rows, "site", "seq", "label", "v", derive_ending=True)


@query("E4_waterfall", f"""
WITH {WATERFALL_SQL},
b AS (SELECT *, SUM(v) OVER (PARTITION BY site ORDER BY seq) AS balance FROM w),
r AS (SELECT site, seq, label, v AS value, CASE WHEN seq = 1 THEN LEAST(0, balance) ELSE LEAST(balance - v, balance) END AS baseline,
  CASE WHEN seq = 1 THEN ABS(balance) ELSE ABS(v) END AS magnitude, CASE WHEN seq > 1 THEN v END AS change, balance,
  seq = 1 AS is_total, CASE WHEN seq = 1 THEN 'beginning' END AS total_type FROM b)
SELECT * FROM r UNION ALL
SELECT site, MAX(seq) + 1, 'Ending', MAX(balance), 0, MAX(balance), NULL, MAX(balance), TRUE, 'ending' FROM r GROUP BY site""")
def waterfall(t):
    return site_waterfall(t)


@query("D30_waterfall_domain", f"""
WITH {WATERFALL_SQL},
b AS (SELECT site, seq, SUM(v) OVER (PARTITION BY site ORDER BY seq) AS balance, v FROM w),
e AS (SELECT site, MIN(CASE WHEN seq = 1 THEN balance ELSE balance - v END) AS low, MAX(balance) AS high FROM b GROUP BY 1)
SELECT site, ROUND(low - GREATEST((high - low) * 0.12, GREATEST(ABS(low), ABS(high), 1) * 0.01), 6) AS domain_low,
  ROUND(high + GREATEST((high - low) * 0.12, GREATEST(ABS(low), ABS(high), 1) * 0.01), 6) AS domain_high FROM e""")
def waterfall_domain(t):
    return rounded(charts.waterfall_domain(site_waterfall(t), "site"), "domain_low", "domain_high")


@query("D31_group_counts", """
WITH g AS (SELECT CASE WHEN o_totalprice >= 300000 THEN 'READY' WHEN o_totalprice >= 150000 THEN 'MONITOR'
   WHEN o_totalprice >= 10000 THEN 'CONFLICT' ELSE 'DO_NOTHING' END AS g, o_totalprice > 400000 AS visible FROM orders)
SELECT k.g AS group_name, COUNT(g.g) AS total, COUNT(*) FILTER (g.visible) AS visible
FROM (VALUES ('READY'), ('MONITOR'), ('CONFLICT'), ('DO_NOTHING')) k(g) LEFT JOIN g ON g.g = k.g GROUP BY 1""")
def group_counts(t):
    price = F.col("o_totalprice")
    rows = t.orders.select(F.when(price >= 300000, "READY").when(price >= 150000, "MONITOR").when(
        price >= 10000, "CONFLICT").otherwise("DO_NOTHING").alias("group_name"), (price > 400000).alias("visible"))
    return charts.group_counts(rows, "group_name", ["READY", "MONITOR", "CONFLICT", "DO_NOTHING"], "visible")


@query("D32_state_tally", "SELECT o_orderpriority AS checkpoint, o_orderstatus AS state, COUNT(*) AS outcomes FROM orders GROUP BY 1, 2")
def state_tally(t):
    return facts.state_tally(t.orders.select(F.col("o_orderpriority").alias("checkpoint"), F.col("o_orderstatus").alias("state")),
                             "checkpoint", "state")


@query("D33_goal_ratios", """
WITH m AS (SELECT GREATEST(1, MAX(leads), MAX(target_leads), MAX(conversions))::DOUBLE * 1.08 AS s FROM business_monthly)
SELECT month, ROUND(CASE WHEN target_leads > 0 THEN LEAST(1, leads::DOUBLE / target_leads) END, 6) AS progress,
  ROUND(LEAST(1, leads / s), 6) AS value_mark, ROUND(LEAST(1, target_leads / s), 6) AS target_mark,
  ROUND(LEAST(1, conversions / s), 6) AS projection_mark FROM business_monthly, m""")
def goal_ratios(t):
    df = charts.goal_ratios(business(t), "leads", "target_leads", "conversions").select(
        "month", "progress", "value_mark", "target_mark", "projection_mark")
    return rounded(df, *df.columns[1:])


# --- Windows ----------------------------------------------------------------------------------------------

@query("E1_period_over_period", f"""
WITH m AS ({SITE_MONTH}), l AS (SELECT *, LAG(clicks) OVER (PARTITION BY site ORDER BY month) AS previous FROM m)
SELECT site, month, clicks, previous, ROUND(clicks::DOUBLE / NULLIF(previous, 0) - 1, 6) AS change,
  CAST((clicks - previous) * 100 AS DOUBLE) AS change_pp FROM l""")
def period_over_period(t):
    df = periods.period_over_period(facts.site_month_totals(t.search_daily).select("site", "month", "clicks"), "site", "month", "clicks")
    return rounded(df, "change", "change_pp")


@query("C3_last_two_months", f"""
WITH m AS ({SITE_MONTH}), r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY site ORDER BY month DESC) AS rn FROM m)
SELECT c.site, c.month AS month_current, p.month AS month_previous, c.clicks AS clicks_current, p.clicks AS clicks_previous,
  c.impressions AS impressions_current, p.impressions AS impressions_previous, ROUND(c.ctr, 6) AS ctr_current, ROUND(p.ctr, 6) AS ctr_previous,
  ROUND(c.position, 6) AS position_current, ROUND(p.position, 6) AS position_previous,
  ROUND(c.clicks::DOUBLE / p.clicks - 1, 6) AS clicks_change, ROUND(c.impressions::DOUBLE / p.impressions - 1, 6) AS impressions_change,
  ROUND((c.ctr - p.ctr) * 100, 6) AS ctr_change_pp, ROUND(c.position - p.position, 6) AS position_change
FROM r c JOIN r p ON c.site = p.site AND c.rn = 1 AND p.rn = 2""")
def last_two_months(t):
    df = facts.last_two_months(facts.site_month_totals(t.search_daily))
    return rounded(df, "ctr_current", "ctr_previous", "position_current", "position_previous", "clicks_change",
                   "impressions_change", "ctr_change_pp", "position_change")


@query("C4_channel_comparison", """
SELECT site, channel, CAST(SUM(sessions) FILTER (NOT cur) AS BIGINT) AS sessions_previous, CAST(SUM(sessions) FILTER (cur) AS BIGINT) AS sessions_current,
  ROUND(SUM(engaged) FILTER (NOT cur)::DOUBLE / SUM(sessions) FILTER (NOT cur), 6) AS engagement_previous,
  ROUND(SUM(engaged) FILTER (cur)::DOUBLE / SUM(sessions) FILTER (cur), 6) AS engagement_current,
  ROUND(SUM(sessions) FILTER (cur)::DOUBLE / SUM(sessions) FILTER (NOT cur) - 1, 6) AS sessions_change
FROM (SELECT *, day >= DATE '2024-01-05' AS cur FROM behaviour_daily WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-08') GROUP BY 1, 2""")
def channel_comparison(t):
    df = facts.channel_comparison(t.behaviour_daily, ("2024-01-05", "2024-01-08"), ("2024-01-01", "2024-01-04"))
    return rounded(df, "engagement_previous", "engagement_current", "sessions_change")


def signal_sql(source, key, period, value):
    return f"""SELECT {key}, COUNT(*) AS periods, MAX(CASE WHEN rn = 1 THEN v END) AS current, MAX(CASE WHEN rn = 2 THEN v END) AS previous,
    CASE WHEN COUNT(*) < 2 THEN 'INSUFFICIENT_HISTORY' WHEN MAX(CASE WHEN rn = 1 THEN v END) > MAX(CASE WHEN rn = 2 THEN v END) THEN 'INCREASING'
      WHEN MAX(CASE WHEN rn = 1 THEN v END) < MAX(CASE WHEN rn = 2 THEN v END) THEN 'DECLINING' ELSE 'STABLE' END AS signal
    FROM (SELECT {key}, {period} AS p, {value} AS v, ROW_NUMBER() OVER (PARTITION BY {key} ORDER BY {period} DESC) AS rn FROM {source}) GROUP BY 1"""


PAGE_MONTH = f"(SELECT page, {MONTH} AS month, CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(impressions) AS BIGINT) AS impressions FROM search_daily GROUP BY 1, 2)"


def page_months(t):
    return t.search_daily.groupBy("page", month_key(F.col("day")).alias("month")).agg(
        F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"))


@query("E2_trend_signal", signal_sql(PAGE_MONTH, "page", "month", "clicks"))
def trend_signal(t):
    return periods.trend_signal(page_months(t), ["page"], "month", "clicks")


@query("C21_trend_conflicts", f"""
WITH a AS ({signal_sql(PAGE_MONTH, "page", "month", "clicks")}), b AS ({signal_sql(PAGE_MONTH, "page", "month", "impressions")})
SELECT a.page, a.signal AS search_signal, b.signal AS session_signal,
  a.signal <> 'INSUFFICIENT_HISTORY' AND b.signal <> 'INSUFFICIENT_HISTORY' AND a.signal <> b.signal AS conflict
FROM a JOIN b ON a.page = b.page""")
def trend_conflicts(t):
    pages = page_months(t)
    return periods.trend_conflicts(periods.trend_signal(pages, ["page"], "month", "clicks"),
                                   periods.trend_signal(pages, ["page"], "month", "impressions"), "page")


@query("E3_decay", f"""
WITH r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY page ORDER BY month DESC) AS rn FROM {PAGE_MONTH}),
f AS (SELECT page, COUNT(*) AS windows, CASE WHEN COUNT(*) FILTER (rn <= 2) = 2 THEN AVG(clicks) FILTER (rn <= 2) END AS recent,
  CASE WHEN COUNT(*) FILTER (rn IN (3, 4)) = 2 THEN AVG(clicks) FILTER (rn IN (3, 4)) END AS baseline FROM r GROUP BY 1)
SELECT page, windows, recent, baseline, CASE WHEN windows < 6 THEN 'MONITOR_SHORT_HISTORY' WHEN baseline > 0 AND recent <= baseline * 0.8::DOUBLE THEN 'CONTENT_DECAY' ELSE 'NONE' END AS verdict FROM f""")
def decay(t):
    return periods.decay(page_months(t), ["page"], "month", "clicks")


def daily_funnel(t):
    """Per day, the number of users reaching the first, second and third event."""
    steps = t.events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    counts = steps.groupBy("day").agg(*[F.count_if(F.col("n") >= 20 * i).alias(f"n{i}") for i in (1, 2, 3)])
    return counts.select("day", F.inline(F.array(*[F.struct(F.lit(i).alias("seq"), F.col(f"n{i}").alias("users")) for i in (1, 2, 3)])))


@query("E5_funnel", """
WITH n AS (SELECT CAST(ts AS DATE) AS day, user_id, COUNT(*) AS n FROM events GROUP BY 1, 2),
s AS (SELECT day, g.seq, COUNT(*) FILTER (n >= 20 * g.seq) AS users FROM n, (VALUES (1), (2), (3)) g(seq) GROUP BY 1, 2),
l AS (SELECT *, LAG(users) OVER (PARTITION BY day ORDER BY seq) AS prev, FIRST_VALUE(users) OVER (PARTITION BY day ORDER BY seq) AS first FROM s)
SELECT day, seq, users, ROUND(users::DOUBLE / NULLIF(prev, 0), 6) AS conversion, ROUND(users::DOUBLE / NULLIF(prev, 0) - 1, 6) AS change,
  ROUND(users::DOUBLE / NULLIF(first, 0), 6) AS share, CAST(prev - users AS DOUBLE) AS dropoff FROM l""")
def funnel(t):
    return rounded(charts.funnel(daily_funnel(t), "day", "seq", "users"), "conversion", "change", "share", "dropoff")


@query("E6_isolated_points", """
WITH l AS (SELECT entity, day, visibility, LAG(visibility) OVER w AS a, LEAD(visibility) OVER w AS b FROM
  (SELECT entity, day, CASE WHEN EXTRACT(DAY FROM day) % 2 = 0 THEN visibility END AS visibility FROM visibility_daily)
  WINDOW w AS (PARTITION BY entity ORDER BY day))
SELECT entity, day, ROUND(visibility, 6) AS visibility FROM l WHERE visibility IS NOT NULL AND a IS NULL AND b IS NULL""")
def isolated_points(t):
    holey = t.visibility_daily.select("entity", "day", F.when(F.day("day") % 2 == 0, F.col("visibility")).alias("visibility"))
    return rounded(charts.isolated_points(holey, "entity", "day", "visibility"), "visibility")


@query("E7_percentile_ranks", """
SELECT o_orderkey, o_totalprice, CAST(FLOOR(CUME_DIST() OVER (ORDER BY o_totalprice) * 100 + 0.5) AS BIGINT) AS percentile FROM orders""")
def percentile_ranks(t):
    return charts.percentile_ranks(t.orders.select("o_orderkey", "o_totalprice"), "o_totalprice")


@query("E11_window_totals", """
WITH a AS (SELECT l_partkey AS page, CAST(MIN(l_shipdate) AS DATE) + 400 AS completed_day FROM lineitem GROUP BY 1),
w AS (SELECT page, completed_day, c.n AS checkpoint, completed_day + c.d - 27 AS period_start, completed_day + c.d AS period_end
  FROM a, (VALUES ('BASELINE', -1), ('30D', 30), ('60D', 60), ('90D', 90)) c(n, d)),
f AS (SELECT page, day, SUM(clicks) AS v FROM search_daily GROUP BY 1, 2)
SELECT w.page, completed_day, checkpoint, period_start, period_end, CAST(SUM(v) AS BIGINT) AS total, COUNT(v) AS observed_days
FROM w LEFT JOIN f ON f.page = w.page AND f.day BETWEEN period_start AND period_end GROUP BY 1, 2, 3, 4, 5""")
def window_totals(t):
    anchors = t.search_daily.groupBy("page").agg(F.date_add(F.min("day"), 400).alias("completed_day"))
    return periods.window_totals(anchors, t.search_daily, "page", "clicks")


def weekly_history(t):
    """Per entity, a history of 7-day windows of visibility ending each day, and one current window each."""
    history = t.visibility_daily.select("entity", F.col("day").alias("last_day"), F.col("visibility").alias("p75"))
    current = t.visibility_daily.groupBy("entity").agg(F.max("day").alias("last_day"), F.max_by("mentions", "day").cast("double").alias("p75"))
    return current.withColumn("first_day", F.date_sub("last_day", 2)), history


@query("C13_previous_window", """
WITH c AS (SELECT entity, MAX(day) AS last_day, ARG_MAX(mentions, day)::DOUBLE AS p75 FROM visibility_daily GROUP BY 1),
h AS (SELECT entity, day AS last_day, visibility AS p75 FROM visibility_daily WHERE visibility IS NOT NULL)
SELECT c.entity, c.last_day, c.p75, c.last_day - 2 AS first_day,
  (SELECT ROUND(ARG_MAX(h.p75, h.last_day), 6) FROM h WHERE h.entity = c.entity AND h.last_day < c.last_day - 2) AS previous_p75,
  (SELECT MAX(h.last_day) FROM h WHERE h.entity = c.entity AND h.last_day < c.last_day - 2) AS previous_end FROM c""")
def previous_window(t):
    current, history = weekly_history(t)
    return rounded(periods.previous_window(current, history, ["entity"]), "previous_p75")


@query("E13_vitals_trend", """
WITH c AS (SELECT entity, MAX(day) AS last_day, ARG_MAX(mentions, day)::DOUBLE AS p75 FROM visibility_daily GROUP BY 1),
h AS (SELECT entity, day AS last_day, ROUND(visibility, 6) AS p75 FROM visibility_daily WHERE visibility IS NOT NULL)
SELECT * FROM h UNION ALL SELECT entity, last_day, p75 FROM c WHERE NOT EXISTS (SELECT 1 FROM h WHERE h.entity = c.entity AND h.last_day = c.last_day)""")
def vitals_trend(t):
    current, history = weekly_history(t)
    return rounded(periods.vitals_trend(current, history, ["entity"]), "p75")


@query("E14_thinned_ticks", """
WITH d AS (SELECT DISTINCT CAST(o_orderdate AS DATE) AS day FROM orders),
n AS (SELECT day, ROW_NUMBER() OVER (ORDER BY day) - 1 AS i, COUNT(*) OVER () AS n FROM d)
SELECT day FROM n WHERE i % CAST(CEIL(n / 6.0) AS BIGINT) = 0""")
def thinned_ticks(t):
    return charts.thinned_ticks(t.orders.select(F.to_date("o_orderdate").alias("day")), "day", 6)


YOY = "(SELECT month, leads, CAST(month || '-01' AS DATE) AS d FROM business_monthly)"


@query("E15_year_over_year", f"""
SELECT a.month, a.leads, b.leads AS prior_year, ROUND(a.leads::DOUBLE / NULLIF(b.leads, 0) - 1, 6) AS yoy_change
FROM {YOY} a LEFT JOIN {YOY} b ON b.d + INTERVAL 12 MONTH = a.d""")
def year_over_year(t):
    return rounded(facts.year_over_year(business(t).select("month", "leads"), "leads"), "yoy_change")


@query("E15_matched_year_totals", """
WITH s AS (SELECT SUBSTR(month, 6, 2) AS m, SUM(leads) FILTER (SUBSTR(month, 1, 4) = '2001') AS c, SUM(leads) FILTER (SUBSTR(month, 1, 4) = '2000') AS p FROM business_monthly GROUP BY 1)
SELECT COUNT(*) AS months, CAST(SUM(c) AS BIGINT) AS current, CAST(SUM(p) AS BIGINT) AS previous, ROUND(SUM(c)::DOUBLE / SUM(p) - 1, 6) AS yoy_change
FROM s WHERE c IS NOT NULL AND p IS NOT NULL""")
def matched_year_totals(t):
    return rounded(facts.matched_year_totals(business(t), "leads", 2001), "yoy_change")


@query("E16_monthly_series", f"""
WITH m AS (SELECT page, month, clicks, CAST(month || '-01' AS DATE) AS d, ROW_NUMBER() OVER (PARTITION BY page ORDER BY month DESC) AS rn FROM {PAGE_MONTH}),
l AS (SELECT *, LAG(d) OVER (PARTITION BY page ORDER BY month) AS b FROM m WHERE rn <= 6)
SELECT page, month, clicks, COALESCE(b + INTERVAL 1 MONTH < d, FALSE) AS gap FROM l""")
def monthly_series(t):
    return periods.monthly_series(page_months(t).select("page", "month", "clicks"), "page")


@query("E17_sparkline", """
WITH a AS (SELECT entity, day, visibility AS v, ROW_NUMBER() OVER w - 1 AS i, COUNT(*) OVER p AS n, COUNT(visibility) OVER p AS k, MIN(visibility) OVER p AS lo,
  MAX(visibility) OVER p AS hi, SUM(CASE WHEN visibility IS NULL THEN 1 ELSE 0 END) OVER w AS g FROM visibility_daily
  WINDOW w AS (PARTITION BY entity ORDER BY day), p AS (PARTITION BY entity))
SELECT entity, day, CAST(DENSE_RANK() OVER (PARTITION BY entity ORDER BY g) AS INTEGER) AS segment, ROUND(i::DOUBLE / (n - 1), 6) AS x_position,
  ROUND((v - lo) / GREATEST(hi - lo, 2.220446049250313e-16), 6) AS y_position FROM a WHERE k >= 2 AND v IS NOT NULL""")
def sparkline(t):
    return rounded(charts.sparkline(t.visibility_daily, "entity", "day", "visibility"), "x_position", "y_position")


# --- Filters over reviewed rows ---------------------------------------------------------------------------

@query("B2_recent_window", """
SELECT site, day, CAST(SUM(clicks) AS BIGINT) AS clicks FROM search_daily WHERE day BETWEEN DATE '2001-06-20' AND DATE '2001-06-27' GROUP BY 1, 2""")
def recent_window(t):
    return periods.recent_window(t.search_daily, "2001-06-30", "search").groupBy("site", "day").agg(F.sum("clicks").alias("clicks"))


@query("B4_reviewed_rows", """
SELECT site, channel, period, CAST(clicks AS BIGINT) AS clicks FROM reviewed
WHERE site <> 'all' AND channel = 'all' AND period = (SELECT MAX(period) FROM reviewed WHERE period BETWEEN '1999-01-01' AND '1999-06-30')""")
def reviewed_rows(t):
    return periods.reviewed_rows(t.reviewed, {"site": "all", "channel": "all", "period": "1999-01-01..1999-06-30"}, breakdown=["site"])


@query("B5_section_rows", """
SELECT site, channel, period, CAST(clicks AS BIGINT) AS clicks FROM reviewed WHERE site = 'A' AND channel IN ('O') AND period = '1999-06-01'""")
def section_rows(t):
    return periods.section_rows(t.reviewed, {"site": "A", "period": "1999-01-01..1999-06-30"}, {"channel": ["O"]})


@query("B6_previous_period_rows", """
SELECT site, channel, period, CAST(clicks AS BIGINT) AS clicks FROM reviewed WHERE site = 'A' AND channel = 'all'
AND period = (SELECT MAX(period) FROM reviewed WHERE period < '1999-06-01')""")
def previous_period_rows(t):
    return periods.previous_period_rows(t.reviewed, {"site": "A", "channel": "all", "period": "1999-06-01"}, "period", "1999-06-01")


@query("B8_history", """
SELECT site, channel, period, CAST(clicks AS BIGINT) AS clicks FROM reviewed
WHERE site = 'R' AND channel = 'all' AND period BETWEEN '1999-01-01' AND '1999-06-30'""")
def report_history(t):
    return periods.period_view(t.reviewed, {"site": "R", "channel": "all", "period": "1999-01-01..1999-06-30"}, "period", "history")


@query("B8_latest", """
SELECT site, channel, period, CAST(clicks AS BIGINT) AS clicks FROM reviewed
WHERE site = 'R' AND channel = 'all' AND period = '1999-06-01'""")
def report_latest(t):
    return periods.period_view(t.reviewed, {"site": "R", "channel": "all", "period": "1999-01-01..1999-06-30"}, "period", "latest")


@query("B8_previous", """
SELECT site, channel, period, CAST(clicks AS BIGINT) AS clicks FROM reviewed
WHERE site = 'R' AND channel = 'all' AND period = '1998-12-01'""")
def report_previous(t):
    return periods.period_view(t.reviewed, {"site": "R", "channel": "all", "period": "1999-01-01"}, "period", "previous")


@query("B9_range_presets", """
WITH s AS (SELECT MIN(day) AS f, MAX(day) AS l FROM search_daily),
p AS (SELECT 'Last 7 days' AS label, l - 6 AS start, l AS "end", f, l FROM s UNION ALL SELECT 'Last 28 days', l - 27, l, f, l FROM s
  UNION ALL SELECT 'Last month', CAST(DATE_TRUNC('month', l) - INTERVAL 1 MONTH AS DATE), CAST(DATE_TRUNC('month', l) AS DATE) - 1, f, l FROM s)
SELECT label, start, "end" FROM p WHERE start >= f AND "end" <= l""")
def range_presets(t):
    return periods.range_presets(t.search_daily)


@query("B10_zoom_rows", """
SELECT site, channel, period, CAST(clicks AS BIGINT) AS clicks FROM reviewed WHERE period BETWEEN '1998-03-01' AND '1998-05-01'""")
def zoom_rows(t):
    return periods.zoom_rows(t.reviewed, "period", "1998-05-01", "1998-03-01")


@query("B21_chart_columns", "SELECT period, CAST(clicks AS BIGINT) AS clicks, site FROM reviewed")
def chart_columns(t):
    return charts.chart_columns(t.reviewed, ["period", "clicks"], ["site", "note"])


@query("B22_bar_issues", """
SELECT BOOL_OR(l_tax > l_discount) AS unordered_range, BOOL_OR(l_quantity < 0 OR l_extendedprice < 0) AS signed_values,
  BOOL_OR(l_quantity IS NULL OR l_extendedprice IS NULL) AS incomplete_segments, BOOL_OR(NOT l_discount > 0) AS goal_not_positive FROM lineitem""")
def bar_issues(t):
    return charts.bar_issues(t.lineitem, "l_tax", "l_discount", ["l_quantity", "l_extendedprice"], "l_discount")


@query("B23_filter_choices", "SELECT DISTINCT period AS choice FROM reviewed WHERE period <> 'all'")
def filter_choices(t):
    return periods.filter_choices(t.reviewed, "period")


@query("C22_heatmap", f"""
WITH c AS (SELECT {MONTH} AS month, query, CAST(SUM(clicks) AS DOUBLE) AS v FROM search_daily GROUP BY 1, 2),
s AS (SELECT MIN(v) AS low, MAX(v) AS high FROM c), m AS (SELECT CASE WHEN low > 0 AND high > low AND low / high > 0.7 THEN low ELSE LEAST(low, 0) END AS lo, GREATEST(high, 0) AS hi FROM s)
SELECT x.month, y.query, COALESCE(v, 0) AS value, v IS NULL AS missing, ROUND(CASE WHEN v IS NULL THEN 0 ELSE GREATEST(0, LEAST(1, (v - lo) / GREATEST(hi - lo, 2.220446049250313e-16))) END, 6) AS intensity
FROM (SELECT DISTINCT month FROM c) x, (SELECT DISTINCT query FROM c) y, m LEFT JOIN c ON c.month = x.month AND c.query = y.query""")
def heatmap(t):
    rows = t.search_daily.select(month_key(F.col("day")).alias("month"), "query", "clicks")
    return rounded(charts.heatmap(rows, "month", "query", "clicks"), "intensity")
