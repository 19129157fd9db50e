"""Opportunities across pages, queries and samples, over the given tables."""

from pyspark.sql import functions as F

from sightline.bindings.core import query
from sightline.bindings.crawl import LINKS
from sightline.operators import audit, graph, joins
from sightline.plans import discovery

C = F.col


# --- Internal links ---------------------------------------------------------------------------------------
# The given pages link to paths that no page has, so a page stands for the first path it links to; pages that stand for one
# path are one page, with the least of their ids.

GRAPH_SQL = f"""{LINKS},
slugs AS (SELECT page_id, MIN(href) AS slug FROM targets GROUP BY 1),
nodes AS (SELECT slug, MIN(page_id) AS page FROM slugs GROUP BY 1),
found AS (SELECT DISTINCT a.page AS source, b.page AS target, anchor FROM targets t JOIN slugs s ON s.page_id = t.page_id JOIN nodes a ON a.slug = s.slug JOIN nodes b ON b.slug = t.href WHERE a.page <> b.page),
carried AS (SELECT target, anchor, COUNT(*) AS n FROM found GROUP BY 1, 2),
weighed AS (SELECT source, f.target, MAX(CASE WHEN n > (SELECT COUNT(*) FROM nodes) * 0.5 THEN GREATEST(1000000 // n, 1) ELSE 1000000 END)::BIGINT AS weight FROM found f JOIN carried c ON c.target = f.target AND c.anchor = f.anchor GROUP BY 1, 2),
edges AS (SELECT source, target, weight, weight / SUM(weight) OVER (PARTITION BY source) AS share FROM weighed)"""
AUTHORITY_SQL = f"""{GRAPH_SQL},
pushed(turn, page, units) AS (
  SELECT 0, page, {graph.START}::BIGINT FROM nodes
  UNION ALL SELECT turn + 1, target, SUM(floor(units * ({graph.DAMPING}::DOUBLE * share)))::BIGINT FROM pushed JOIN edges ON source = page WHERE units > {graph.REST} GROUP BY turn + 1, target),
summed AS (SELECT page, SUM(units)::BIGINT AS units FROM pushed GROUP BY 1),
ranked AS (SELECT page, units / (SELECT SUM(units)::BIGINT / COUNT(*) FROM summed) AS authority FROM summed)"""


def site_graph(t):
    """Pages and links of the paths that the given pages link to."""
    found = audit.links(t.pages).select("page_id", "href", "anchor")
    slugs = found.groupBy("page_id").agg(F.min("href").alias("slug"))
    nodes = slugs.groupBy("slug").agg(F.min("page_id").alias("page"))
    sources = slugs.join(nodes, "slug").select("page_id", C("page").alias("source"))
    links = found.join(sources, "page_id").join(nodes.select(C("slug").alias("href"), C("page").alias("target")), "href").select("source", "target", "anchor")
    return nodes.select("page"), links


@query("X4_link_weights", f"WITH {GRAPH_SQL} SELECT source, target, weight, round(share, 9) AS share FROM edges")
def link_weights(t):
    pages, links = site_graph(t)
    return graph.weighted_links(links, pages).select("source", "target", "weight", F.round("share", 9).alias("share"))


@query("X4_link_authority", f"WITH RECURSIVE {AUTHORITY_SQL} SELECT page, round(authority, 6) AS authority FROM ranked")
def link_authority(t):
    pages, links = site_graph(t)
    return graph.link_authority(pages, graph.weighted_links(links, pages)).select("page", F.round("authority", 6).alias("authority"))


@query("X4_internal_links", f"""
WITH RECURSIVE {AUTHORITY_SQL},
demand AS (SELECT page, SUM(impressions) AS demand FROM search_daily GROUP BY 1),
facts AS (SELECT r.page, authority, nullif(regexp_extract(html, '<html[^>]*lang="([^"]*)"', 1), '') AS topic, r.page % 9 <> 0 AS indexable, r.page % 7 <> 3 AS intent_known, coalesce(demand, 0) AS demand
  FROM ranked r JOIN pages p ON p.page_id = r.page LEFT JOIN demand d ON d.page = r.page),
wanted AS (SELECT *, demand / authority AS need, ROW_NUMBER() OVER (PARTITION BY topic ORDER BY demand / authority DESC, page) AS place FROM facts WHERE topic IS NOT NULL AND indexable AND demand > 0 AND intent_known),
offers AS (SELECT s.page AS source, w.page AS target, s.authority AS source_authority, w.authority AS target_authority, w.need, ROW_NUMBER() OVER (PARTITION BY s.page ORDER BY w.place) AS rank
  FROM facts s JOIN wanted w ON w.topic = s.topic AND w.page <> s.page LEFT JOIN edges e ON e.source = s.page AND e.target = w.page WHERE s.indexable AND e.source IS NULL)
SELECT source, target, rank::INTEGER AS rank, round(source_authority, 6) AS source_authority, round(target_authority, 6) AS target_authority, round(need, 3) AS need FROM offers WHERE rank <= {discovery.LINKS_PER_SOURCE}""")
def internal_links(t):
    nodes, links = site_graph(t)
    demand = t.search_daily.groupBy("page").agg(F.sum("impressions").alias("demand"))
    topic = F.nullif(F.regexp_extract("html", '<html[^>]*lang="([^"]*)"', 1), F.lit(""))
    known = t.pages.select(C("page_id").alias("page"), topic.alias("topic"))
    pages = nodes.join(known, "page").join(demand, "page", "left").select(
        "page", "topic", (C("page") % 9 != 0).alias("indexable"), F.coalesce("demand", F.lit(0)).alias("demand"), (C("page") % 7 != 3).alias("intent_known"))
    out = discovery.internal_links(pages, links)
    return out.select("source", "target", "rank", F.round("source_authority", 6).alias("source_authority"), F.round("target_authority", 6).alias("target_authority"), F.round("need", 3).alias("need"))


# --- Consolidation ----------------------------------------------------------------------------------------
# Four suppliers in turn are pages that show for the same queries; a part of each one's rows is for a query of its own.

SHOWN_SQL = """shown AS (SELECT CASE WHEN l_partkey % (l_suppkey % 7 + 2) = 0 THEN 'own' || l_suppkey ELSE 'q' || (l_suppkey // 4) || '-' || (l_partkey % 5) END AS query, l_suppkey AS page,
    SUBSTR(CAST(CAST(l_shipdate AS DATE) AS VARCHAR), 1, 4) AS period, CAST(l_quantity AS BIGINT) AS clicks, CAST(FLOOR(l_extendedprice) AS BIGINT) AS impressions FROM lineitem),
monthly AS (SELECT query, period, page, SUM(clicks) AS clicks, SUM(impressions) AS impressions FROM shown GROUP BY 1, 2, 3),
led AS (SELECT query, period, page AS leader FROM monthly QUALIFY ROW_NUMBER() OVER (PARTITION BY query, period ORDER BY clicks DESC, impressions DESC, page) = 1),
turned AS (SELECT *, LAG(leader) OVER (PARTITION BY query ORDER BY period) <> leader AS turn FROM led),
turns AS (SELECT query, COUNT(DISTINCT leader) AS leaders, COUNT(*) FILTER (turn) AS switches FROM turned GROUP BY 1),
held AS (SELECT query, page, SUM(impressions) AS impressions FROM shown GROUP BY 1, 2),
shares AS (SELECT *, SUM(impressions) OVER (PARTITION BY query) AS whole, MAX(impressions) OVER (PARTITION BY query) AS most FROM held),
contest AS (SELECT s.query, page, impressions::BIGINT AS impressions, leaders, switches, most / whole <= 0.6 AS dispersed FROM shares s JOIN turns t ON t.query = s.query WHERE whole > 0 AND impressions / whole >= 0.2)"""


def shown(t):
    supp, part = C("l_suppkey"), C("l_partkey")
    text = F.when(part % (supp % 7 + 2) == 0, F.concat(F.lit("own"), supp)).otherwise(F.concat(F.lit("q"), F.floor(supp / 4), F.lit("-"), part % 5))
    return t.lineitem.select(text.alias("query"), supp.alias("page"), F.substring(F.to_date("l_shipdate").cast("string"), 1, 4).alias("period"),
                             C("l_quantity").cast("long").alias("clicks"), F.floor("l_extendedprice").alias("impressions"))


@query("X5_query_contest", f"WITH {SHOWN_SQL} SELECT * FROM contest")
def query_contest(t):
    return discovery.query_contest(shown(t))


@query("X5_consolidation", f"""
WITH RECURSIVE {SHOWN_SQL},
facts AS (SELECT s_suppkey AS page, s_suppkey % 3 AS intent, CASE WHEN s_suppkey % 11 = 0 THEN 'en' ELSE 'zh' END AS language, s_suppkey % 13 <> 0 AS movable FROM supplier),
sizes AS (SELECT page, SUM(clicks) AS clicks, SUM(impressions) AS impressions FROM shown GROUP BY 1),
pairs AS (SELECT a.page AS a, b.page AS b, SUM(LEAST(a.impressions, b.impressions)) AS shared, SUM(a.switches) AS switches FROM contest a JOIN contest b ON a.query = b.query AND a.page < b.page
  JOIN facts f ON f.page = a.page JOIN facts g ON g.page = b.page AND g.intent = f.intent AND g.language = f.language WHERE a.leaders > 1 OR a.dispersed GROUP BY 1, 2),
linked AS (SELECT a, b, shared / LEAST(x.impressions, y.impressions) AS overlap, switches FROM pairs JOIN sizes x ON x.page = a JOIN sizes y ON y.page = b WHERE shared / LEAST(x.impressions, y.impressions) >= 0.5),
sides AS (SELECT a AS page, b AS other, overlap, switches FROM linked UNION ALL SELECT b, a, overlap, switches FROM linked),
reach(page, other) AS (SELECT page, page FROM sides UNION SELECT r.page, s.other FROM reach r JOIN sides s ON s.page = r.other),
grouped AS (SELECT page, MIN(other) AS component FROM reach GROUP BY 1),
best AS (SELECT page, MAX(overlap) AS overlap, SUM(switches)::BIGINT AS switches FROM sides GROUP BY 1),
members AS (SELECT g.component, g.page, overlap, b.switches, clicks, impressions, movable FROM grouped g JOIN best b ON b.page = g.page JOIN sizes s ON s.page = g.page JOIN facts f ON f.page = g.page),
named AS (SELECT *, FIRST_VALUE(page) OVER (PARTITION BY component ORDER BY clicks DESC, impressions DESC, page) AS survivor, COUNT(*) OVER (PARTITION BY component) AS pages, bool_and(movable) OVER (PARTITION BY component) AS ready FROM members)
SELECT component, page, CASE WHEN page = survivor THEN 'SURVIVOR' ELSE 'MERGE' END AS role, survivor, pages, round(overlap, 6) AS overlap, switches, CASE WHEN ready THEN 'CONSOLIDATE' ELSE 'MONITOR' END AS action FROM named""")
def consolidation(t):
    key = C("s_suppkey")
    pages = t.supplier.select(key.alias("page"), (key % 3).alias("intent"), F.when(key % 11 == 0, "en").otherwise("zh").alias("language"), (key % 13 != 0).alias("movable"))
    return discovery.consolidation(shown(t), pages).withColumn("overlap", F.round("overlap", 6))


# --- Click-through against the cohort ---------------------------------------------------------------------

PLACED_SQL = """placed AS (SELECT l_returnflag AS site, l_partkey AS page, CAST(l_discount * 100 + 0.5 AS INTEGER) + l_linenumber AS position, CAST(FLOOR(l_extendedprice / 100) AS BIGINT) AS impressions,
    CAST(FLOOR(l_quantity * 20 / (CAST(l_discount * 100 + 0.5 AS INTEGER) + l_linenumber)) AS BIGINT) AS clicks FROM lineitem),
bins AS (SELECT site, LEAST(position, 50) AS bin, SUM(clicks) AS clicks, SUM(impressions) AS impressions FROM placed WHERE impressions > 0 GROUP BY 1, 2),
ranges AS (SELECT a.site, a.bin AS first, b.bin AS last, (SELECT SUM(clicks) / SUM(impressions) FROM bins m WHERE m.site = a.site AND m.bin BETWEEN a.bin AND b.bin) AS rate FROM bins a JOIN bins b ON a.site = b.site AND a.bin <= b.bin),
tops AS (SELECT i.site, i.bin, r.first, MAX(rate) AS top FROM bins i JOIN ranges r ON r.site = i.site AND r.first <= i.bin AND r.last >= i.bin GROUP BY 1, 2, 3),
curve AS (SELECT i.site, i.bin, i.impressions::BIGINT AS impressions, MIN(top) AS expected FROM bins i JOIN tops t ON t.site = i.site AND t.bin = i.bin GROUP BY 1, 2, 3)"""


def placed(t):
    position = F.floor(C("l_discount") * 100 + 0.5).cast("int") + C("l_linenumber")
    return t.lineitem.select(C("l_returnflag").alias("site"), C("l_partkey").alias("page"), position.alias("position"), F.floor(C("l_extendedprice") / 100).alias("impressions"),
                             F.floor(C("l_quantity") * 20 / position).alias("clicks"))


PLACED_SQL = PLACED_SQL.replace("CAST(l_discount * 100 + 0.5 AS INTEGER)", "CAST(FLOOR(l_discount * 100 + 0.5) AS INTEGER)")


@query("K2_expected_ctr", f"WITH {PLACED_SQL} SELECT site, bin, impressions, round(expected, 9) AS expected FROM curve")
def expected_ctr(t):
    return discovery.expected_ctr(placed(t), ["site"]).withColumn("expected", F.round("expected", 9))


@query("K2_below_cohort", f"""
WITH {PLACED_SQL},
windows AS (SELECT site, page, SUM(impressions) AS impressions, SUM(clicks) AS clicks, SUM(position * impressions) / SUM(impressions) AS position FROM placed GROUP BY 1, 2 HAVING SUM(impressions) > 0),
met AS (SELECT w.*, c.expected, c.impressions AS shown FROM windows w LEFT JOIN curve c ON c.site = w.site AND c.bin = LEAST(GREATEST(FLOOR(position + 0.5), 1), 50))
SELECT site, page, round(clicks / impressions, 9) AS ctr, round(CASE WHEN shown >= 1000 THEN expected END, 9) AS expected,
  CASE WHEN impressions < 500 THEN 'TOO_FEW_IMPRESSIONS' WHEN shown IS NULL OR shown < 1000 THEN 'NO_BASELINE' WHEN clicks / impressions <= expected * 0.8::DOUBLE THEN 'BELOW_EXPECTATION' ELSE 'AS_EXPECTED' END AS state FROM met""")
def below_cohort(t):
    rows = placed(t)
    windows = rows.groupBy("site", "page").agg(F.sum("impressions").alias("impressions"), F.sum("clicks").alias("clicks"), F.sum(C("position") * C("impressions")).alias("_p")).where(
        "impressions > 0").withColumn("position", C("_p") / C("impressions")).drop("_p")
    out = discovery.ctr_against_cohort(windows, ["site"], discovery.expected_ctr(rows, ["site"]))
    return out.select("site", "page", F.round("ctr", 9).alias("ctr"), F.round("expected", 9).alias("expected"), "state")


@query("K2_window_pairs", """
WITH m AS (SELECT page, SUBSTR(CAST(day AS VARCHAR), 1, 7) AS month, SUM(clicks) AS clicks FROM search_daily GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY page ORDER BY month DESC) AS rn FROM m)
SELECT page, CAST(MAX(clicks) FILTER (rn = 1) AS BIGINT) AS current, CAST(MAX(clicks) FILTER (rn = 2) AS BIGINT) AS previous FROM r GROUP BY 1""")
def window_pairs(t):
    months = t.search_daily.groupBy("page", F.substring(C("day").cast("string"), 1, 7).alias("month")).agg(F.sum("clicks").alias("clicks"))
    return joins.latest_window_pairs(months, "page", "month", "clicks")


# --- Content gap ------------------------------------------------------------------------------------------

def content_gap_inputs(t):
    key = C("p_partkey")
    intent = F.when(C("p_size") % 3 == 0, "BUY").when(C("p_size") % 3 == 1, "COMPARE")
    queries = t.part.select(key.alias("query_id"), C("p_name").alias("text"), intent.alias("intent"), F.lit("TW").alias("market"), F.when(key % 6 != 0, C("p_size") * 10 - 30).alias("volume"),
                            (key % 150).alias("impressions"), (key % 8 != 0).alias("coverage_known"), (key % 10 == 7).alias("brand_navigation"), (key % 9 != 0).alias("page_type_fits"))
    results = t.lineitem.select(C("l_partkey").alias("query_id"), F.when(C("l_suppkey") % 5 == 0, "JP").otherwise("TW").alias("market"), (C("l_linenumber") + C("l_suppkey") % 10).cast("int").alias("rank"),
                                F.concat(F.lit("d"), "l_suppkey").alias("domain"))
    rivals = t.supplier.select(F.floor(C("s_suppkey") / 2).alias("competitor_id"), F.concat(F.lit("d"), "s_suppkey").alias("domain"), F.lit("TW").alias("market"), (C("s_suppkey") % 4 != 0).alias("approved"))
    inventory = t.part.where(key % 5 == 0).select(F.concat(F.lit(" "), F.upper("p_name"), F.lit(" - "), F.upper("p_name")).alias("text"), intent.alias("intent"))
    return queries, results, rivals, inventory


CONTENT_SQL = """keyed AS (SELECT *, coalesce(CASE p_size % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'COMPARE' END, 'UNKNOWN') || '|' || array_to_string(list_sort(list_distinct(list_filter(string_split_regex(lower(trim(p_name)), '[^\\p{L}\\p{N}]+'), lambda w: w <> ''))), ' ') AS topic FROM part),
top AS (SELECT l_partkey AS query_id, COUNT(DISTINCT l_suppkey // 2) AS competitors FROM lineitem WHERE l_suppkey % 5 <> 0 AND l_suppkey % 4 <> 0 AND l_linenumber + l_suppkey % 10 BETWEEN 1 AND 10 GROUP BY 1 HAVING COUNT(DISTINCT l_suppkey // 2) >= 2),
assets AS (SELECT DISTINCT topic FROM keyed WHERE p_partkey % 5 = 0),
judged AS (SELECT p_partkey AS query_id, competitors, CASE WHEN p_partkey % 150 >= 100 THEN 'ALREADY_OBSERVED' WHEN p_partkey % 6 = 0 THEN 'DEMAND_UNKNOWN' WHEN p_size * 10 - 30 <= 0 THEN 'NO_DEMAND' WHEN p_partkey % 8 = 0 THEN 'COVERAGE_UNKNOWN'
  WHEN a.topic IS NOT NULL THEN 'ASSET_EXISTS' WHEN {incomplete} THEN 'INVENTORY_INCOMPLETE' WHEN p_partkey % 9 = 0 THEN 'PAGE_TYPE_UNCONFIRMED' END AS reason FROM keyed k JOIN top ON query_id = p_partkey LEFT JOIN assets a ON a.topic = k.topic WHERE p_partkey % 10 <> 7)
SELECT query_id, competitors, CASE reason WHEN 'ASSET_EXISTS' THEN 'UPDATE_EXISTING' WHEN 'NO_DEMAND' THEN 'DO_NOTHING' ELSE CASE WHEN reason IS NULL THEN 'CREATE_NEW' ELSE 'MONITOR' END END AS action, reason FROM judged WHERE reason IS NULL OR reason <> 'ALREADY_OBSERVED'"""


@query("X1_content_gaps", "WITH " + CONTENT_SQL.replace("{incomplete}", "FALSE"))
def content_gaps(t):
    return discovery.content_gaps(*content_gap_inputs(t), inventory_complete=True)


@query("X1_content_gaps_open_inventory", "WITH " + CONTENT_SQL.replace("{incomplete}", "TRUE"))
def content_gaps_open(t):
    return discovery.content_gaps(*content_gap_inputs(t), inventory_complete=False)


# --- Authority gap ----------------------------------------------------------------------------------------

@query("X3_authority_gaps", """
WITH n AS (SELECT l_partkey AS url, COUNT(DISTINCT l_suppkey) AS domains FROM lineitem GROUP BY 1),
k AS (SELECT p_partkey AS url, p_size AS intent_group, p_partkey % 3 = 0 AS owned, coalesce(domains, 0) AS domains FROM part LEFT JOIN n ON url = p_partkey),
q AS (SELECT intent_group, quantile_cont(domains::DOUBLE, 0.5) AS peer_domains FROM k WHERE NOT owned GROUP BY 1),
g AS (SELECT p_size AS intent_group, COUNT(DISTINCT l_suppkey) AS group_domains FROM lineitem JOIN part ON p_partkey = l_partkey GROUP BY 1),
m AS (SELECT url, k.intent_group, domains, peer_domains, group_domains, peer_domains - domains AS gap,
  CASE WHEN peer_domains IS NULL THEN 'NO_PEERS' WHEN url % 7 = 0 THEN 'TECHNICAL_FIRST' WHEN url % 5 = 0 THEN 'DEMAND' WHEN url % 4 = 0 THEN 'LINK_QUALITY_REVIEW' END AS missing
  FROM k LEFT JOIN q ON q.intent_group = k.intent_group LEFT JOIN g ON g.intent_group = k.intent_group WHERE owned)
SELECT *, CASE WHEN gap IS NULL OR gap <= 0 THEN 'DO_NOTHING' WHEN missing = 'TECHNICAL_FIRST' THEN 'TECHNICAL_FIX' ELSE CASE WHEN missing IS NOT NULL THEN 'MONITOR' ELSE 'AUTHORITY_BUILD' END END AS action FROM m""")
def authority_gaps(t):
    key = C("p_partkey")
    pages = t.part.select(key.alias("url"), C("p_size").alias("intent_group"), (key % 3 == 0).alias("owned"), (key % 7 != 0).alias("technical_ok"), (key % 5).alias("demand"), (key % 4 != 0).alias("quality_checked"))
    links = t.lineitem.select(C("l_partkey").alias("url"), F.to_date("l_shipdate").alias("day"), C("l_suppkey").alias("domain"))
    return discovery.authority_gaps(pages, links)


# --- AI-visibility gap ------------------------------------------------------------------------------------

@query("X2_visibility_gaps", """
WITH o AS (SELECT user_id % 25 AS topic, user_id % 2 AS prompt, EXTRACT(DAY FROM ts) % 3 AS run, event_type AS entity, COUNT(*) FILTER (value > 60) AS mentions,
  CASE WHEN user_id % 25 % 7 = 3 AND event_type = 'click' AND EXTRACT(DAY FROM ts) % 3 = 1 THEN NULL ELSE 40 END AS answers FROM events GROUP BY 1, 2, 3, 4, 6),
b AS (SELECT t.topic, t.entity, COUNT(*) FILTER (t.answers = m.answers) AS cells, SUM(t.mentions) FILTER (t.answers = m.answers) AS m, SUM(m.mentions) FILTER (t.answers = m.answers) AS o, SUM(t.answers) FILTER (t.answers = m.answers) AS n
  FROM o t JOIN o m ON m.entity = 'view' AND m.topic = t.topic AND m.prompt = t.prompt AND m.run = t.run WHERE t.entity <> 'view' GROUP BY 1, 2),
s AS (SELECT topic, COUNT(*) AS size FROM o WHERE entity = 'view' GROUP BY 1),
x AS (SELECT b.* FROM b JOIN s ON s.topic = b.topic AND s.size = b.cells QUALIFY ROW_NUMBER() OVER (PARTITION BY b.topic ORDER BY (m - o) / n DESC, entity) = 1),
p AS (SELECT t.topic, entity AS competitor, cells, round(o / n, 9) AS own_visibility, round(m / n, 9) AS competitor_visibility, 100 * (m - o) / n AS points FROM (SELECT DISTINCT topic FROM o) t LEFT JOIN x ON x.topic = t.topic),
d AS (SELECT *, CASE WHEN points <= 0 THEN 0 WHEN points < 5 THEN 1 WHEN points < 15 THEN 2 WHEN points < 30 THEN 3 WHEN points >= 30 THEN 4 END AS band FROM p)
SELECT topic, competitor, cells, own_visibility, competitor_visibility, round(points, 6) AS gap_points, band, CASE WHEN band IS NULL THEN 'INSUFFICIENT_EVIDENCE' WHEN band = 0 THEN 'DO_NOTHING' ELSE 'GEO_GAP' END AS state FROM d""")
def visibility_gaps(t):
    topic, run = C("user_id") % 25, F.dayofmonth("ts") % 3
    unknown = (topic % 7 == 3) & (C("event_type") == "click") & (run == 1)
    cells = t.events.groupBy(topic.alias("topic"), (C("user_id") % 2).alias("prompt_id"), run.alias("run"), C("event_type").alias("entity"), F.when(~unknown, 40).alias("answers")).agg(
        F.count_if(C("value") > 60).alias("mentions"))
    seen = cells.select("topic", "prompt_id", F.lit("v1").alias("prompt_version"), F.lit("p").alias("platform"), F.lit("TW").alias("region"), "run", "entity", "mentions", "answers")
    return discovery.visibility_gaps(seen, "view").select("topic", "competitor", "cells", F.round("own_visibility", 9).alias("own_visibility"), F.round("competitor_visibility", 9).alias("competitor_visibility"),
                                                          F.round("gap_points", 6).alias("gap_points"), "band", "state")
