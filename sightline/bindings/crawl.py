"""Crawl audit over the given web pages."""

from pyspark.sql import functions as F

from sightline.bindings.core import query
from sightline.operators import audit, joins, quality, ranking
from sightline.schemas import CRAWL_CATALOGUE


def strip_sql(value):
    return f"trim(regexp_replace(regexp_replace({value}, '(?s)<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g'))"


BODY = "html"
for _hidden in audit.HIDDEN:
    BODY = f"regexp_replace({BODY}, '{_hidden}', ' ', 'g')"
FACTS = f"""facts AS (SELECT page_id, url, {strip_sql(f"regexp_extract(html, '{audit.TITLE}', 1)")} AS title,
    list_transform(regexp_extract_all(html, '{audit.HEADING}', 1), lambda h: {strip_sql('h')}) AS headings,
    CAST(NULL AS VARCHAR) AS description, {strip_sql(BODY)} AS body FROM pages),
sized AS (SELECT *, CASE WHEN body = '' THEN 0 ELSE len(string_split(body, ' ')) END AS words, headings[1] AS heading,
    len(list_filter(headings, lambda h: h <> '')) AS h1s, regexp_extract(url, '^[^:/?#]+://[^/?#]*([^?#]*)', 1) AS path FROM facts)"""
ISSUES = """issues AS (
  SELECT page_id, 'H1' AS section, 'Missing' AS label FROM sized WHERE h1s = 0
  UNION ALL SELECT page_id, 'H1', 'Multiple' FROM sized WHERE h1s > 1
  UNION ALL SELECT page_id, 'H1', 'Over 70 Characters' FROM sized WHERE length(heading) > 70
  UNION ALL SELECT page_id, 'Page Titles', 'Missing' FROM sized WHERE title = ''
  UNION ALL SELECT page_id, 'Page Titles', 'Over 60 Characters' FROM sized WHERE length(title) > 60
  UNION ALL SELECT page_id, 'Page Titles', 'Below 30 Characters' FROM sized WHERE title <> '' AND length(title) < 30
  UNION ALL SELECT page_id, 'Page Titles', 'Same as H1' FROM sized WHERE title <> '' AND title = heading
  UNION ALL SELECT page_id, 'Meta Description', 'Missing' FROM sized
  UNION ALL SELECT page_id, 'Content', 'Low Content Pages' FROM sized WHERE words < 200
  UNION ALL SELECT page_id, 'URL', 'Multiple Slashes' FROM sized WHERE path LIKE '%//%')"""
SHARED = """shared AS (
  SELECT page_id, section, 'Duplicate' AS label FROM (
    SELECT page_id, section, COUNT(*) OVER (PARTITION BY section, v) AS n FROM (
      SELECT page_id, 'H1' AS section, heading AS v FROM sized WHERE heading <> ''
      UNION ALL SELECT page_id, 'Page Titles', title FROM sized WHERE title <> ''
      UNION ALL SELECT page_id, 'Content', body FROM sized WHERE words > 0)) WHERE n > 1)"""


@query("L0_page_facts", f"""
WITH {FACTS} SELECT page_id, title, array_to_string(headings, '|') AS headings, CAST(words AS INTEGER) AS words, sha256(body) AS content_hash FROM sized""")
def page_facts(t):
    return audit.page_facts(t.pages).select("page_id", "title", F.array_join("headings", "|").alias("headings"), "words", "content_hash")


def only(section):
    return lambda t: audit.page_issues(audit.page_facts(t.pages)).where(F.col("section").isin(section))


@query("L1_heading_issues", """
SELECT page_id, 'H1' AS section, CASE page_id % 3 WHEN 0 THEN 'Multiple' WHEN 1 THEN 'Missing' ELSE 'Over 70 Characters' END AS label FROM pages""")
def heading_issues(t):
    case, html = F.col("page_id") % 3, F.col("html")
    edited = (F.when(case == 0, F.concat(html, F.lit("<h1>More</h1>"))).when(case == 1, F.regexp_replace(html, r"(?i)<(/?)h1\b", "<$1h2"))
              .otherwise(F.regexp_replace(html, r"(?i)<h1>", "<h1>" + "long " * 16)))
    return audit.page_issues(audit.page_facts(t.pages.select("page_id", "url", edited.alias("html")))).where("section = 'H1'")


for _name, _section in (("L2_title_issues", "Page Titles"), ("L3_description_issues", "Meta Description"), ("L4_content_issues", "Content")):
    query(_name, f"WITH {FACTS}, {ISSUES} SELECT * FROM issues WHERE section = '{_section}'")(only(_section))


@query("L3_description_labels", """
WITH d AS (SELECT page_id, CASE page_id % 4 WHEN 0 THEN repeat('long words ', 20) || page_id WHEN 1 THEN 'short ' || page_id WHEN 2 THEN 'The same description, of seventy characters or more, on two pages each: ' || page_id // 8 END AS description FROM pages)
SELECT page_id, CASE WHEN description IS NULL THEN 'Missing' WHEN length(description) > 155 THEN 'Over 155 Characters' ELSE 'Below 70 Characters' END AS label FROM d WHERE description IS NULL OR length(description) > 155 OR length(description) < 70
UNION ALL SELECT page_id, 'Duplicate' FROM d WHERE description IN (SELECT description FROM d GROUP BY 1 HAVING COUNT(*) > 1)""")
def description_labels(t):
    page = F.col("page_id")
    text = (F.when(page % 4 == 0, F.concat(F.lit("long words " * 20), page)).when(page % 4 == 1, F.concat(F.lit("short "), page))
            .when(page % 4 == 2, F.concat(F.lit("The same description, of seventy characters or more, on two pages each: "), F.floor(page / 8))))
    meta = F.coalesce(F.concat(F.lit('<meta name="description" content="'), text, F.lit('">')), F.lit(""))
    facts = audit.page_facts(t.pages.select("page_id", "url", F.concat(meta, "html").alias("html")))
    return audit.page_issues(facts).unionByName(audit.shared_value_issues(facts)).where("section = 'Meta Description'").drop("section")


@query("L4_shared_values", f"WITH {FACTS}, {SHARED} SELECT * FROM shared")
def shared_values(t):
    return audit.shared_value_issues(audit.page_facts(t.pages))


def page_status(t):
    """Derived crawl status of every page URL."""
    case = F.col("page_id") % 10
    return t.pages.groupBy("url").agg(F.min("page_id").alias("page_id")).select(
        "url", F.when(case == 0, 404).when(case == 1, 301).otherwise(200).alias("http_status"), (F.col("page_id") % 4 != 0).alias("indexable"))


STATUS = """status AS (SELECT url, CASE min(page_id) % 10 WHEN 0 THEN 404 WHEN 1 THEN 301 ELSE 200 END AS http_status, min(page_id) % 4 <> 0 AS indexable FROM pages GROUP BY url)"""


@query("L5_canonical_issues", f"""
WITH {STATUS}, f AS (SELECT page_id, url, regexp_replace(url, '[?#].*$', '') AS canonical FROM pages)
SELECT page_id, 'Canonicals' AS section, 'Canonicalised' AS label FROM f WHERE canonical <> url
UNION ALL SELECT page_id, 'Canonicals', 'Non-Indexable Canonical' FROM f LEFT JOIN status s ON s.url = f.canonical
WHERE f.canonical <> f.url AND coalesce(NOT indexable OR http_status <> 200, TRUE)""")
def canonical_issues(t):
    facts = t.pages.select("page_id", "url", F.regexp_replace("url", r"[?#].*$", "").alias("canonical"))
    return audit.canonical_issues(facts, page_status(t))


LINKS = f"""anchors AS (SELECT page_id, url, unnest(regexp_extract_all(html, '(?is)<a\\b[^>]*>.*?</a>')) AS a FROM pages),
links AS (SELECT page_id, url, regexp_extract(a, '(?is)\\bhref\\s*=\\s*["'']([^"'']*)["'']', 1) AS href, {strip_sql('a')} AS anchor FROM anchors),
targets AS (SELECT *, regexp_extract(url, '^([^:/?#]+://[^/?#]*)', 1) || href AS target FROM links WHERE href <> '')"""


@query("L11_links", f"WITH {LINKS} SELECT page_id, href, anchor, target, TRUE AS internal FROM targets")
def links(t):
    return audit.links(t.pages).select("page_id", "href", "anchor", "target", "internal")


@query("L6_link_status", f"""
WITH {LINKS}, s AS (SELECT DISTINCT target, CASE length(target) % 4 WHEN 0 THEN 200 WHEN 1 THEN 301 WHEN 2 THEN 404 ELSE 503 END AS code FROM targets),
j AS (SELECT page_id, CASE WHEN page_id % 2 = 0 AND code = 301 THEN 'Internal Redirection (3xx)' WHEN page_id % 2 = 1 AND code = 404 THEN 'External Client Error (4xx)'
  WHEN page_id % 2 = 1 AND code = 503 THEN 'External Server Error (5xx)' END AS label FROM targets JOIN s USING (target))
SELECT page_id, 'Response Codes' AS section, label, COUNT(*) AS links FROM j WHERE label IS NOT NULL GROUP BY 1, 3""")
def link_status(t):
    rows = audit.links(t.pages).withColumn("internal", F.col("page_id") % 2 == 0)
    size = F.length("target") % 4
    status = rows.select("target").distinct().select(F.col("target").alias("url"), F.when(size == 0, 200).when(size == 1, 301).when(size == 2, 404).otherwise(503).alias("http_status"))
    return audit.link_status_issues(rows, status)


@query("L6_redirect_ends", """
WITH RECURSIVE s AS (SELECT page_id AS url, CASE WHEN page_id % 16 <> 0 THEN page_id - 1 WHEN page_id % 64 = 48 THEN page_id + 5 WHEN page_id % 64 = 32 THEN -1 END AS location,
  CASE WHEN page_id % 16 <> 0 OR page_id % 64 IN (48, 32) THEN 301 WHEN page_id % 64 = 16 THEN 404 ELSE 200 END AS code FROM pages),
w(url, here, hops) AS (SELECT url, location, 1 FROM s WHERE location IS NOT NULL UNION ALL SELECT w.url, s.location, hops + 1 FROM w JOIN s ON s.url = w.here AND s.location IS NOT NULL WHERE hops < 100),
e AS (SELECT url, MAX(hops) AS hops, ARG_MAX(here, hops) AS here FROM w GROUP BY 1)
SELECT CAST(e.url AS VARCHAR) AS url, CASE WHEN hops < 100 THEN hops END AS hops, CASE WHEN hops < 100 THEN CAST(here AS VARCHAR) END AS final_url, CASE WHEN hops < 100 THEN s.code END AS final_status,
  CASE WHEN hops >= 100 THEN 'LOOP' WHEN s.code IS NULL THEN 'UNKNOWN_END' WHEN s.code >= 400 THEN 'BROKEN' WHEN hops > 1 THEN 'CHAIN' ELSE 'REDIRECT' END AS state FROM e LEFT JOIN s ON s.url = here""")
def redirect_ends(t):
    """Sixteen pages in a row redirect to the one before; the first of each row is an end, an error, a loop or a page that was not crawled."""
    key = F.col("page_id")
    row, four = key % 16 != 0, key % 64
    location = F.when(row, key - 1).when(four == 48, key + 5).when(four == 32, F.lit(-1))
    status = t.pages.select(key.cast("string").alias("url"), F.when(row | four.isin(48, 32), 301).when(four == 16, 404).otherwise(200).alias("http_status"), location.cast("string").alias("location"))
    return audit.redirect_ends(status)


@query("L7_image_issues", f"""
WITH {LINKS}, n AS (SELECT page_id, COUNT(*) AS n FROM links WHERE href <> '' GROUP BY 1)
SELECT page_id, 'Images' AS section, 'Missing Alt Text' AS label FROM n WHERE page_id % 2 = 0
UNION ALL SELECT DISTINCT page_id, 'Images', 'Over 100 kB' FROM links WHERE href <> '' AND length(href) % 3 = 0""")
def image_issues(t):
    tag = F.when(F.col("page_id") % 2 == 0, '<img src="$1">').otherwise('<img src="$1" alt="x">')
    drawn = t.pages.select("page_id", F.regexp_replace("html", F.lit(r'(?is)<a\b[^>]*href="([^"]*)"[^>]*>'), tag).alias("html"))
    sources = audit.links(t.pages).select(F.col("href").alias("src")).distinct()
    return audit.image_issues(drawn, sources.select("src", F.when(F.length("src") % 3 == 0, 200000).otherwise(10).alias("bytes")))


@query("L8_hreflang_issues", """
SELECT page_id, 'Hreflang' AS section, 'Missing X-Default' AS label FROM pages WHERE page_id % 3 = 1
UNION ALL SELECT page_id, 'Hreflang', 'Missing Self Reference' FROM pages WHERE page_id % 3 = 0""")
def hreflang_issues(t):
    case = F.col("page_id") % 3
    tag = F.when(case == 0, '<link rel="alternate" hreflang="x-default" href="https://example.com/">').when(
        case == 1, F.concat(F.lit('<link rel="alternate" hreflang="fr" href="'), "url", F.lit('">'))).otherwise("")
    return audit.hreflang_issues(t.pages.select("page_id", "url", F.concat(tag, "html").alias("html")))


@query("L9_double_slash", """
SELECT page_id, regexp_replace(url, '^([a-z]+://[^/?#]*)', '\\1/') AS url, url AS canonical FROM pages WHERE regexp_extract(url, '^[a-z]+://[^/?#]*(.?)', 1) = '/'""")
def double_slash(t):
    doubled = t.pages.select("page_id", F.regexp_replace("url", r"^([a-z]+://[^/?#]*)/", "$1//").alias("url"))
    return audit.double_slash(doubled)


@query("L10_security_issues", f"""
WITH {LINKS}, n AS (SELECT DISTINCT page_id FROM links WHERE href <> '')
SELECT page_id, 'Security' AS section, 'Unsafe Cross-Origin Links' AS label FROM n WHERE page_id % 2 = 0
UNION ALL SELECT page_id, 'Security', 'Missing HSTS Header' FROM pages WHERE page_id % 3 <> 0
UNION ALL SELECT page_id, 'Security', 'Missing Content-Security-Policy Header' FROM pages WHERE page_id % 3 <> 1
UNION ALL SELECT page_id, 'Security', 'Missing Referrer-Policy Header' FROM pages""")
def security_issues(t):
    rel = F.when(F.col("page_id") % 2 == 0, '<a target="_blank" ').otherwise('<a target="_blank" rel="noopener" ')
    opened = t.pages.select("page_id", F.regexp_replace("html", F.lit(r"(?i)<a "), rel).alias("html"))
    case = F.col("page_id") % 3
    headers = t.pages.select("page_id", F.when(case == 0, F.create_map(F.lit("strict-transport-security"), F.lit("max-age=1"))).when(
        case == 1, F.create_map(F.lit("content-security-policy"), F.lit("default-src"))).otherwise(
        F.create_map(F.lit("server"), F.lit("x"))).alias("headers"))
    return audit.security_issues(opened, headers)



@query("L11_inlinks", f"""
WITH {LINKS}, f AS (SELECT page_id, MIN(target) AS url FROM targets GROUP BY 1),
p AS (SELECT target AS url, COUNT(DISTINCT page_id) AS sources, COUNT(*) AS links FROM targets WHERE target <> url GROUP BY 1)
SELECT f.page_id, f.url, coalesce(sources, 0) AS sources, coalesce(links, 0) AS links,
  CASE WHEN sources IS NULL THEN 'ORPHAN' WHEN sources = 1 THEN 'WEAK' ELSE 'LINKED' END AS state FROM f LEFT JOIN p ON p.url = f.url""")
def inlinks(t):
    """The links in the markup, towards the first page that each page links to."""
    found = audit.links(t.pages)
    return audit.inlinks(found.groupBy("page_id").agg(F.min("target").alias("url")), found)


@query("L12_anchor_mix", f"""
WITH {LINKS}, k AS (SELECT target, CASE WHEN lower(trim(anchor)) IN ('', 'more', 'here') THEN 'g' WHEN lower(anchor) LIKE '%th%' THEN 'b' ELSE 'd' END AS k FROM targets)
SELECT target, COUNT(*) AS links, round(COUNT(*) FILTER (k = 'd')::DOUBLE / COUNT(*), 6) AS descriptive_share,
  round(COUNT(*) FILTER (k = 'b')::DOUBLE / COUNT(*), 6) AS brand_share, round(COUNT(*) FILTER (k = 'g')::DOUBLE / COUNT(*), 6) AS generic_share FROM k GROUP BY 1""")
def anchor_mix(t):
    df = audit.anchor_mix(audit.links(t.pages), "th")
    return df.withColumns({c: F.round(c, 6) for c in df.columns[2:]})


CATALOGUE = ", ".join(f"('{s}', '{label}', '{level}')" for s, label, level in CRAWL_CATALOGUE)


def all_issues(t):
    facts = audit.page_facts(t.pages)
    return audit.page_issues(facts).unionByName(audit.shared_value_issues(facts))


@query("L13_issue_summary", f"""
WITH {FACTS}, {ISSUES}, {SHARED}, a AS (SELECT * FROM issues UNION ALL SELECT * FROM shared)
SELECT a.section, a.label, COUNT(DISTINCT page_id) AS count, round(COUNT(DISTINCT page_id)::DOUBLE / (SELECT COUNT(*) FROM pages), 6) AS share, severity
FROM a LEFT JOIN (VALUES {CATALOGUE}) c(section, label, severity) ON c.section = a.section AND c.label = a.label GROUP BY 1, 2, 5""")
def issue_summary(t):
    crawled = t.pages.agg(F.count(F.lit(1)).alias("n")).scalar()
    return audit.issue_summary(all_issues(t), crawled).withColumn("share", F.round("share", 6))


@query("B3_catalogue_rows", f"""
WITH {FACTS}, {ISSUES}, {SHARED}, a AS (SELECT * FROM issues UNION ALL SELECT * FROM shared)
SELECT a.section, a.label, COUNT(*) AS count, severity FROM a JOIN (VALUES {CATALOGUE}) c(section, label, severity) ON c.section = a.section AND c.label = a.label GROUP BY 1, 2, 4""")
def catalogue_rows(t):
    overview = all_issues(t).groupBy("section", "label").agg(F.count(F.lit(1)).alias("count"))
    return quality.catalogue_rows(overview)


@query("F9_by_severity", f"""
WITH {FACTS}, {ISSUES}, {SHARED}, a AS (SELECT * FROM issues UNION ALL SELECT * FROM shared)
SELECT a.section, a.label, COUNT(*) AS count, severity FROM a JOIN (VALUES {CATALOGUE}) c(section, label, severity) ON c.section = a.section AND c.label = a.label
GROUP BY 1, 2, 4 ORDER BY CASE severity WHEN 'HIGH' THEN 0 WHEN 'MEDIUM' THEN 1 ELSE 2 END, count DESC""")
def by_severity(t):
    return ranking.by_severity(catalogue_rows(t))


@query("A24_export_manifest", f"""
WITH {FACTS}, {ISSUES}, {SHARED}, a AS (SELECT * FROM issues UNION ALL SELECT * FROM shared)
SELECT section, label, COUNT(DISTINCT page_id) AS affected_count, 'exported' AS status,
  regexp_replace(lower(section || '_' || label), '[^a-z0-9]+', '_', 'g') || '.csv' AS file FROM a GROUP BY 1, 2""")
def export_manifest(t):
    return audit.export_manifest(all_issues(t))


@query("G9_sitemap_missing", f"""
WITH {STATUS} SELECT url FROM status WHERE indexable AND url NOT IN (SELECT url FROM pages WHERE page_id % 3 = 0)""")
def sitemap_missing(t):
    return audit.sitemap_missing(page_status(t), t.pages.where("page_id % 3 = 0").select("url"))


@query("C17_issue_demand", f"""
WITH {FACTS}, {ISSUES} SELECT DISTINCT page_id, page_id IN (SELECT l_partkey FROM lineitem WHERE l_returnflag = 'A') AS has_demand FROM issues WHERE section = 'Page Titles' AND label = 'Below 30 Characters'""")
def issue_demand(t):
    severe = audit.page_issues(audit.page_facts(t.pages)).where("section = 'Page Titles' AND label = 'Below 30 Characters'").select("page_id").distinct()
    demand = t.lineitem.where("l_returnflag = 'A'").select(F.col("l_partkey").alias("page_id"))
    met, unmet = joins.issue_demand(severe, demand, ["page_id"])
    return met.withColumn("has_demand", F.lit(True)).unionByName(unmet.withColumn("has_demand", F.lit(False)))
