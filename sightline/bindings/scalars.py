"""Column functions over texts, URLs, numbers and dates of the given tables."""

from pyspark.sql import functions as F

from sightline.bindings.core import query
from sightline.functions import dates, hashing, labels, numbers, text, urls
from sightline.functions.text import _PLAIN, _WIDE
from sightline.functions.urls import PARTS, PERSONAL_PARAM, TRACKING
from sightline.schemas import SOURCE_CLASS

WIDE_SQL, PLAIN_SQL = _WIDE, _PLAIN.replace("'", "''")


def fold_sql(column):
    """SQL form of the text identity, for texts whose only special case fold is the sharp s."""
    wide = f"translate({column}, '{WIDE_SQL}', '{PLAIN_SQL}')"
    return f"replace(lower(nfc_normalize(trim(regexp_replace({wide}, '\\s+', ' ', 'g')))), 'ß', 'ss')"


@query("H1_norm_text", f"""
SELECT doc_id, md5(nullif({fold_sql('text')}, '')) AS text_md5, length(nullif({fold_sql('text')}, '')) AS chars FROM documents""")
def norm_text(t):
    folded = text.norm_text(F.col("text"))
    return t.documents.select("doc_id", F.md5(folded).alias("text_md5"), F.char_length(folded).cast("long").alias("chars"))


J1_ROWS = "SELECT doc_id, md5(replace(lower(nfc_normalize(text)), 'ß', 'ss')) AS folded FROM documents WHERE regexp_matches(text, '[^\\x00-\\x7F]')"


@query("J1_compose_and_fold", J1_ROWS)
def compose_and_fold(t):
    rows = t.documents.where(F.col("text").rlike(text.NON_ASCII))
    return rows.select("doc_id", F.md5(text.compose_and_fold("text")).alias("folded"))


KEPT = f"list_filter(string_split(query, '&'), lambda x: x <> '' AND NOT regexp_matches(lower(split_part(x, '=', 1)), '{TRACKING}'))"
URL_SQL = f"""u AS (SELECT page_id, url, lower(regexp_extract(url, '{PARTS}', 1)) AS scheme, regexp_extract(url, '{PARTS}', 2) AS authority,
    regexp_extract(url, '{PARTS}', 3) AS path, regexp_extract(url, '{PARTS}', 4) AS query FROM pages),
n AS (SELECT *, array_to_string({KEPT}, '&') AS kept,
    len(list_filter({KEPT}, lambda x: regexp_matches(lower(split_part(x, '=', 1)), '{PERSONAL_PARAM}'))) > 0 AS personal FROM u),
norm AS (SELECT page_id, url, CASE WHEN NOT personal THEN scheme || '://' || lower(authority) || CASE WHEN path = '' THEN '/' ELSE path END ||
    CASE WHEN kept = '' THEN '' ELSE '?' || kept END END AS normalized_url FROM n)"""


@query("H2_norm_url", f"WITH {URL_SQL} SELECT page_id, normalized_url FROM norm")
def norm_url(t):
    return t.pages.select("page_id", urls.norm_url(F.col("url")).alias("normalized_url"))


URL_EDGES = [("http://h.example:080/a", "http://h.example/a"), ("https://h.example:99999/a", None), ("http://[2001:DB8::1]:81/x", "http://[2001:db8::1]:81/x"),
             ("http://@h.example/", "http://h.example/"), ("http://u@h.example/", None), ("http://a..b.example/", None), ("http://" + "a" * 70 + ".example/", None), ("https://h.example.:443", "https://h.example/")]


@query("H2_url_edges", "SELECT o_orderkey, " + "CASE o_orderkey % 8 " + " ".join(
    f"WHEN {k} THEN " + (f"'{want}'" if want else "NULL") for k, (_, want) in enumerate(URL_EDGES)) + " END AS url FROM orders")
def url_edges(t):
    url = F.element_at(F.array(*[F.lit(u) for u, _ in URL_EDGES]), (F.col("o_orderkey") % 8 + 1).cast("int"))
    return t.orders.select("o_orderkey", urls.norm_url(url).alias("url"))


@query("H2_url_forms", f"""
WITH {URL_SQL} SELECT page_id, CASE WHEN page_id % 7 IN (1, 2, 5) THEN NULL WHEN page_id % 7 = 6 THEN regexp_replace(normalized_url, '^([a-z]+://[^/?]*)', '\\1:8443') ELSE normalized_url END AS url FROM norm""")
def url_forms(t):
    """Every page's own URL with its host written another way: spare ports, user parts, dots."""
    scheme, host = F.regexp_extract("url", "^([a-z]+)://", 1), F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    form, end = F.col("page_id") % 7, F.lit(".")
    written = (F.when(form == 0, F.concat(host, F.when(scheme == "https", ":0443").otherwise(":080"))).when(form == 1, F.concat(F.lit("user@"), host))
               .when(form == 2, F.concat(host, F.lit(":99999"))).when(form == 3, F.concat(F.lit("@"), F.upper(host))).when(form == 4, F.concat(host, end))
               .when(form == 5, F.concat(F.lit("x.."), host)).otherwise(F.concat(host, F.lit(":8443"))))
    rest = F.regexp_replace("url", "^[a-z]+://[^/?#]*", "")
    return t.pages.select("page_id", urls.norm_url(F.concat(scheme, F.lit("://"), written, rest)).alias("url"))


@query("H3_without_tracking", f"WITH {URL_SQL} SELECT page_id, kept, personal FROM n")
def without_tracking(t):
    part = urls.url_part(F.col("url"), 4)
    return t.pages.select("page_id", urls.without_tracking(part).alias("kept"), urls.has_personal_param(part).alias("personal"))


HOST = "regexp_extract(url, '^[a-z]+://([^/?#]*)', 1)"


@query("H4_norm_domain", f"SELECT page_id, CASE WHEN page_id % 5 = 0 THEN NULL ELSE lower({HOST}) END AS domain FROM pages")
def norm_domain(t):
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    raw = F.when(F.col("page_id") % 5 == 0, F.concat(host, F.lit("/path"))).when(F.col("page_id") % 5 == 1, F.concat(F.lit(" "), F.upper(host), F.lit(". "))).otherwise(host)
    return t.pages.select("page_id", text.norm_domain(raw).alias("domain"))


@query("H5_search_property", f"""
SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'https://' || {HOST} || '/' WHEN 1 THEN 'https://' || {HOST} || '/' WHEN 2 THEN 'https://' || {HOST} || '/'
  ELSE 'sc-domain:other.example' END AS property FROM pages""")
def search_property(t):
    host = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1)
    site, case = F.concat(F.lit("https://"), host, F.lit("/")), F.col("page_id") % 4
    prop = F.when(case == 0, site).when(case == 1, F.lit(None)).when(case == 2, F.concat(F.lit("/"), host)).otherwise("other.example/")
    return t.pages.select("page_id", urls.search_property(prop, site).alias("property"))


@query("H6_landing_url", f"""
SELECT page_id, CASE WHEN page_id % 3 = 2 THEN NULL ELSE 'https://' || lower({HOST}) || '/land/' || page_id END AS landing FROM pages""")
def landing_url(t):
    host, case = F.regexp_extract("url", "^[a-z]+://([^/?#]*)", 1), F.col("page_id") % 3
    path = F.concat(F.lit("/land/"), "page_id")
    page = F.when(case == 0, path).when(case == 1, F.concat(F.lit("HTTPS://"), F.upper(host), path, F.lit("?utm_source=a#x"))).otherwise(
        F.concat(F.lit("https://elsewhere.example"), path))
    return t.pages.select("page_id", urls.landing_url(page, host).alias("landing"))


@query("H7_stable_id", """
SELECT p_partkey, 'KW_' || substr(sha256('{"brand":"' || p_brand || '","text":"' || p_name || '"}'), 1, 24) AS keyword_id FROM part""")
def stable_id(t):
    return t.part.select("p_partkey", hashing.stable_id("KW", {"text": F.col("p_name"), "brand": F.col("p_brand")}).alias("keyword_id"))


@query("H8_content_hash", """
SELECT l_orderkey, l_linenumber, sha256('["' || l_returnflag || '",' || CAST(l_quantity AS BIGINT) || ',' ||
  CASE WHEN l_extendedprice = floor(l_extendedprice) THEN CAST(CAST(l_extendedprice AS BIGINT) AS VARCHAR) ELSE CAST(l_extendedprice AS VARCHAR) END ||
  ',null]') AS content_hash FROM lineitem""")
def content_hash(t):
    rows = t.lineitem.withColumn("nothing", F.lit(None).cast("string"))
    return rows.select("l_orderkey", "l_linenumber", hashing.row_hash(
        rows, ["l_returnflag", "l_quantity", "l_extendedprice", "nothing"]).alias("content_hash"))


@query("H8_number_text", """
WITH n AS (SELECT l_orderkey, l_linenumber, CASE l_linenumber % 4 WHEN 0 THEN l_extendedprice * 1000 + 0.5 WHEN 1 THEN l_quantity / 65536 / 4096 WHEN 2 THEN l_quantity * 1e15 ELSE -l_quantity / 16384 END AS v FROM lineitem)
SELECT l_orderkey, l_linenumber, CASE WHEN v = floor(v) THEN CAST(CAST(v AS BIGINT) AS VARCHAR) ELSE CAST(v AS VARCHAR) END AS text FROM n""")
def number_text(t):
    kind, size, price = F.col("l_linenumber") % 4, F.col("l_quantity"), F.col("l_extendedprice")
    value = F.when(kind == 0, price * 1000 + 0.5).when(kind == 1, size / 65536 / 4096).when(kind == 2, size * 1e15).otherwise(-size / 16384)
    return t.lineitem.select("l_orderkey", "l_linenumber", hashing.json_number(value).alias("text"))


@query("H9_strict_parse", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 < 2 THEN CAST(o_orderdate AS DATE) END AS day,
  CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderdate + INTERVAL 2 HOUR AS TIMESTAMP) END AS instant FROM orders""")
def strict_parse(t):
    day, key = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey")
    broken = F.when(key % 4 < 2, day).when(key % 4 == 2, F.concat(F.substring(day, 1, 8), F.lit("32"))).otherwise(F.concat(day, F.lit("T00:00:00Z")))
    stamp = F.when(key % 3 == 0, F.concat(day, F.lit("T10:00:00+08:00"))).otherwise(F.concat(day, F.lit("T10:00:00")))
    return t.orders.select("o_orderkey", dates.strict_date(broken).alias("day"), dates.zoned_timestamp(stamp).cast("timestamp_ntz").alias("instant"))


@query("H10_month_bounds", """
SELECT o_orderkey, date_trunc('month', o_orderdate)::DATE AS month_start, last_day(o_orderdate) AS month_end, last_day(o_orderdate) + 60 AS mature_on FROM orders""")
def month_bounds(t):
    first = dates.month_start(F.date_format("o_orderdate", "yyyy-MM"))
    return t.orders.select("o_orderkey", first.alias("month_start"), F.last_day(first).alias("month_end"), dates.mature_on(first).alias("mature_on"))


@query("H11_table_number", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN round(o_totalprice, 2) WHEN 1 THEN -round(o_totalprice, 2) WHEN 2 THEN round(round(o_totalprice, 2) / 100, 6) END AS parsed FROM orders""")
def table_number(t):
    shown, case = F.format_number("o_totalprice", 2), F.col("o_orderkey") % 4
    cell = (F.when(case == 0, F.concat(F.lit(" $"), shown)).when(case == 1, F.concat(F.lit("−"), shown))
            .when(case == 2, F.concat(shown, F.lit(" %"))).otherwise(F.concat(shown, F.lit(" units"))))
    return t.orders.select("o_orderkey", numbers.fixed(numbers.table_number(cell)).alias("parsed"))


@query("H11_count_cell", """
SELECT o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN o_custkey END AS parsed,
  CASE o_orderkey % 4 WHEN 2 THEN 'NOT_A_COUNT' WHEN 3 THEN 'NOT_NUMERIC' END AS error FROM orders""")
def count_cell(t):
    case = F.col("o_orderkey") % 4
    cell = (F.when(case == 0, F.format_number("o_custkey", 0)).when(case == 1, "N/A")
            .when(case == 2, F.concat(F.col("o_custkey").cast("string"), F.lit(".5"))).otherwise("twelve"))
    parsed = numbers.count_cell(cell)
    return t.orders.select("o_orderkey", parsed["value"].alias("parsed"), parsed["error"].alias("error"))


@query("H12_safe_change", """
SELECT l_orderkey, l_linenumber, round(l_extendedprice / nullif(l_tax, 0) - 1, 6) AS change,
  round((l_discount - l_tax) / nullif(abs(l_tax), 0), 6) AS signed_change FROM lineitem""")
def safe_change(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.fixed(numbers.change(F.col("l_extendedprice"), F.col("l_tax"))).alias("change"),
                             numbers.fixed(numbers.signed_change(F.col("l_discount"), F.col("l_tax"))).alias("signed_change"))


@query("H13_bands", """
SELECT l_orderkey, l_linenumber, CASE WHEN v <= 0 THEN 0 WHEN v < 100 THEN 1 WHEN v < 500 THEN 2 WHEN v < 2000 THEN 3 ELSE 4 END AS demand,
  CASE WHEN i < 100 THEN NULL WHEN p BETWEEN 4 AND 15 THEN 4 WHEN p <= 3 THEN CASE WHEN c THEN 3 ELSE 0 END WHEN p <= 20 THEN 3 WHEN p <= 40 THEN 2 ELSE 1 END AS traction
FROM (SELECT l_orderkey, l_linenumber, l_extendedprice / 30 AS v, l_extendedprice / 100 AS i, l_quantity AS p, l_tax > 0 AS c FROM lineitem)""")
def bands(t):
    price = F.col("l_extendedprice")
    return t.lineitem.select("l_orderkey", "l_linenumber", labels.volume_band(price / 30).alias("demand"), labels.traction_band(
        price / 100, F.col("l_quantity"), F.when(F.col("l_tax") > 0, F.col("l_tax")), F.lit("COMPLETE_WITHIN_SCOPE")).alias("traction"))


@query("H14_half_up", "SELECT l_orderkey, l_linenumber, CAST(floor(l_quantity / 4 + 0.5) AS BIGINT) AS rounded FROM lineitem")
def half_up(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.half_up(F.col("l_quantity") / 4).alias("rounded"))


@query("H15_vital_rating", """
SELECT event_id, CASE WHEN value * 50 <= 2500 THEN 'GOOD' WHEN value * 50 <= 4000 THEN 'NEEDS_IMPROVEMENT' ELSE 'POOR' END AS rating FROM events""")
def vital_rating(t):
    return t.events.select("event_id", labels.vital_rating(F.lit("largest_contentful_paint"), F.col("value") * 50).alias("rating"))


@query("H16_page_type", """
SELECT p_partkey, CASE p_type WHEN 'ECONOMY' THEN 'informational_article' WHEN 'SMALL' THEN 'category_product' ELSE 'unknown' END AS page_type,
  CASE p_type WHEN 'ECONOMY' THEN 'INFORMATIONAL' WHEN 'SMALL' THEN 'TRANSACTIONAL' ELSE 'UNKNOWN' END AS intent FROM part""")
def page_type(t):
    kind = F.when(F.col("p_type") == "ECONOMY", "article").when(F.col("p_type") == "SMALL", "product").otherwise("other")
    return t.part.select("p_partkey", labels.page_type(kind).alias("page_type"), labels.intent(kind).alias("intent"))


@query("H17_month_label", "SELECT o_orderkey, extract(month FROM o_orderdate) || ' 月' AS label FROM orders")
def month_label(t):
    return t.orders.select("o_orderkey", labels.month_label(F.date_format("o_orderdate", "yyyy-MM")).alias("label"))


@query("H18_host_within", f"""
SELECT page_id, lower({HOST}) = 'example.com' OR lower({HOST}) LIKE '%.example.com' AS within FROM pages""")
def host_within(t):
    return t.pages.select("page_id", urls.host_within(urls.host_of(F.col("url")), F.lit("Example.com")).alias("within"))


@query("H19_temporal", """
SELECT o_orderkey, o_orderkey % 4 < 2 AS temporal, CASE WHEN o_totalprice > 250000 THEN 'positive' WHEN o_totalprice < 250000 THEN 'negative' ELSE 'neutral' END AS tone FROM orders""")
def temporal(t):
    day, key = F.date_format("o_orderdate", "yyyy-MM-dd"), F.col("o_orderkey") % 4
    value = F.when(key == 0, day).when(key == 1, F.substring(day, 1, 7)).when(key == 2, F.concat(F.substring(day, 1, 4), F.lit("-13-01"))).otherwise("soon")
    return t.orders.select("o_orderkey", labels.is_temporal(value).alias("temporal"), labels.delta_tone(F.col("o_totalprice") - 250000).alias("tone"))


@query("H20_status_tone", """
SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'neutral' WHEN '2-HIGH' THEN 'negative' WHEN '3-MEDIUM' THEN 'warning'
  WHEN '4-NOT SPECIFIED' THEN 'info' ELSE 'positive' END AS tone FROM orders""")
def status_tone(t):
    word = F.create_map(*[F.lit(x) for x in ("4-NOT SPECIFIED", "Pending", "5-LOW", "Low risk")])[F.col("o_orderpriority")]
    return t.orders.select("o_orderkey", labels.status_tone(F.coalesce(word, "o_orderpriority")).alias("tone"))


@query("H21_share_of_range", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_discount < l_tax THEN NULL WHEN l_discount = l_tax THEN CASE WHEN v = l_tax THEN 50::DOUBLE WHEN v < l_tax THEN 0 ELSE 100 END
  ELSE round(greatest(0, least(100, (v - l_tax) / (l_discount - l_tax) * 100)), 6) END AS place FROM (SELECT *, l_quantity / 500 AS v FROM lineitem)""")
def share_of_range(t):
    return t.lineitem.select("l_orderkey", "l_linenumber", numbers.fixed(numbers.share_of_range(
        F.col("l_tax"), F.col("l_discount"), F.col("l_quantity") / 500)).alias("place"))


@query("H22_single_slash", "SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*)', 1) || '/a/b?x=//y' AS canonical FROM pages")
def single_slash(t):
    doubled = F.concat(F.regexp_extract("url", "^([a-z]+://[^/?#]*)", 1), F.lit("//a///b?x=//y"))
    return t.pages.select("page_id", urls.single_slash_path(doubled).alias("canonical"))


@query("H23_features", """
SELECT p_partkey, CASE WHEN lower(p_brand) < lower(p_type) THEN lower(p_brand) || '=OBSERVED,' || lower(p_type) || '=OBSERVED'
  ELSE lower(p_type) || '=OBSERVED,' || lower(p_brand) || '=OBSERVED' END AS features FROM part""")
def features(t):
    found = labels.observed_features(F.array("p_type", "p_brand", "p_type"))
    flat = F.array_join(F.transform(F.map_entries(labels.sorted_features(found)), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    return t.part.select("p_partkey", flat.alias("features"))


@query("H24_densities", """
SELECT event_id, round(value, 6) AS good, CASE WHEN event_id % 2 = 0 THEN round(value / 2, 6) END AS needs, CAST(NULL AS DOUBLE) AS poor FROM events""")
def densities(t):
    bins = F.when(F.col("event_id") % 2 == 0, F.array("value", F.col("value") / 2)).otherwise(F.array("value"))
    found = labels.densities(bins)
    return t.events.select("event_id", *[numbers.fixed(found[n]).alias(n) for n in ("good", "needs", "poor")])


@query("H25_formats", """
SELECT c_custkey, c_custkey % 3 = 0 AS is_id, c_custkey % 3 <> 1 AS is_reference, c_custkey % 3 = 2 AS is_hash FROM customer""")
def formats(t):
    case = F.col("c_custkey") % 3
    value = F.when(case == 0, F.concat(F.lit("KW_"), "c_custkey")).when(case == 1, F.lit("bad value")).otherwise(
        F.concat(F.lit("0"), F.substring(F.sha2("c_name", 256), 2, 63)))
    return t.customer.select("c_custkey", hashing.is_identifier(value).alias("is_id"), hashing.is_reference(value).alias("is_reference"), hashing.is_hash(value).alias("is_hash"))


@query("H26_format", """
SELECT o_orderkey, format('{:,.1f}', o_custkey * 12.5) || '%' AS percent, '$' || format('{:,.0f}', o_custkey * 3.0) AS money FROM orders""")
def format_values(t):
    return t.orders.select("o_orderkey", numbers.format_percent(F.col("o_custkey") / 8).alias("percent"), numbers.format_currency(F.col("o_custkey") * 3).alias("money"))


@query("H26_compact", """
WITH v AS (SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 4 THEN NULL ELSE o_custkey * power(1000, o_orderkey % 4) END AS v FROM orders)
SELECT o_orderkey, CASE WHEN v IS NULL THEN '—' WHEN v >= 1e9 THEN format('{:,.1f}', v / 1e9) || 'B' WHEN v >= 1e6 THEN format('{:,.1f}', v / 1e6) || 'M' WHEN v >= 1e3 THEN format('{:,.1f}', v / 1e3) || 'K' ELSE format('{:,.0f}', v) END AS text FROM v""")
def compact_values(t):
    value = F.when(F.col("o_orderkey") % 5 == 4, None).otherwise(F.col("o_custkey") * F.pow(F.lit(1000.0), F.col("o_orderkey") % 4))
    return t.orders.select("o_orderkey", numbers.format_compact(value).alias("text"))


@query("H27_date_parts", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS compact, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS part FROM orders")
def date_parts(t):
    return t.orders.select("o_orderkey", dates.compact_date(F.date_format("o_orderdate", "yyyyMMdd")).alias("compact"), dates.date_part_text(F.col("o_orderdate")).alias("part"))


CLASSES = list(SOURCE_CLASS)


@query("H28_source_class", "SELECT o_orderkey, CASE o_orderkey % 9 " + " ".join(
    f"WHEN {i} THEN '{SOURCE_CLASS[s]}'" for i, s in enumerate(CLASSES)) + " END AS source_class FROM orders")
def source_class(t):
    source = F.get(F.array(*[F.lit(s) for s in CLASSES]), (F.col("o_orderkey") % 9).cast("int"))
    return t.orders.select("o_orderkey", labels.source_class(source).alias("source_class"))


@query("A13_serial_month", "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR)[1:7] AS month FROM orders")
def serial_month(t):
    serial = F.datediff("o_orderdate", F.lit("1899-12-30").cast("date"))
    return t.orders.select("o_orderkey", dates.month_key(dates.serial_date(serial)).alias("month"))
