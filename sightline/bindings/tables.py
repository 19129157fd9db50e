"""Validation, sets, ranking, revision logs, registry and joins over the given tables."""

from pyspark.sql import functions as F

from sightline import schemas
from sightline.bindings.core import query
from sightline.bindings.scalars import URL_SQL
from sightline.functions import text
from sightline.operators import joins, quality, ranking, registry, revisions
from sightline.operators.charts import rounded
from sightline.operators.graph import settled

C = F.col


def flags(df, *codes):
    """Error array as one joined text, so that both engines can compare it."""
    return df.withColumn("errors", F.array_join("errors", ","))


# --- Filters and predicates -------------------------------------------------------------------------------

@query("B1_in_scope", """
SELECT event_id, user_id % 7 AS property, event_type AS channel FROM events
WHERE event_type IN ('view', 'click') AND user_id % 7 IN (SELECT r_regionkey FROM region) AND user_id % 5 = user_id % 7""")
def in_scope(t):
    rows = t.events.withColumn("r_regionkey", C("user_id") % 5).join(t.region, "r_regionkey", "left").select(
        "event_id", (C("user_id") % 7).alias("property"), C("event_type").alias("channel"), C("r_name").alias("host"))
    scope = t.region.select(C("r_regionkey").cast("long").alias("property"), F.lower("r_name").alias("host"))
    return quality.in_scope(rows, scope, ["view", "click"]).drop("host")


@query("B11_free_text", """
SELECT p_partkey, p_name, p_brand FROM part WHERE lower(p_name) LIKE '%red%' OR lower(p_brand) LIKE '%red%' OR CAST(p_partkey AS VARCHAR) LIKE '%red%'""")
def free_text(t):
    return quality.free_text(t.part.select("p_partkey", "p_name", "p_brand"), "Red")


def snapshots(t):
    """Orders as monthly snapshot rows, some of which break a rule."""
    key, day = C("o_orderkey"), F.to_date("o_orderdate")
    last = F.last_day(day)
    return t.orders.select(
        "o_orderkey", F.lit("v1").alias("contract_version"), F.when(key % 11 == 0, "Unknown").otherwise("Excel Actual").alias("source"),
        F.lit("Monthly").alias("metric_granularity"), F.trunc(day, "month").cast("string").alias("period_start"),
        F.when(key % 7 == 0, F.date_sub(last, 1)).otherwise(last).cast("string").alias("period_end"),
        F.lit("Business").alias("metric_group"), F.lit("sql").alias("metric"), C("o_orderpriority").alias("segment"),
        F.lit("TW").alias("platform_property"), F.date_add(last, 30).cast("string").alias("as_of_date"),
        F.concat(F.date_add(last, F.when(key % 13 == 0, 10).otherwise(40)).cast("string"), F.lit("T01:00:00Z")).alias("loaded_at"),
        F.when(key % 5 == 0, "Failed").otherwise("Ready").alias("data_status"),
        F.when(key % 3 == 0, F.lit(None)).otherwise(F.floor("o_totalprice")).cast("double").alias("value"),
        F.lit(None).cast("double").alias("denominator"), F.lit(100.0).alias("target"), F.lit("count").alias("unit"),
        F.lit("Asia/Taipei").alias("source_timezone"), F.concat(F.lit("book-1/"), key.cast("string")).alias("source_reference"),
        F.when(key % 17 == 0, " ").otherwise("note").alias("revision_note"), F.lit(None).cast("string").alias("supersedes_snapshot_id"))


@query("B12_snapshot_errors", """
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 17 = 0 THEN 'EMPTY_REVISION_NOTE' END, CASE WHEN o_orderkey % 13 = 0 THEN 'AS_OF_AFTER_LOADED' END,
  CASE WHEN o_orderkey % 11 = 0 THEN 'SOURCE_NOT_AUTHORITATIVE' END, CASE WHEN o_orderkey % 7 = 0 THEN 'FULL_MONTH_COHORT' END,
  CASE WHEN o_orderkey % 5 <> 0 AND o_orderkey % 3 = 0 THEN 'READY_WITHOUT_VALUE' END, CASE WHEN o_orderkey % 5 = 0 AND o_orderkey % 3 <> 0 THEN 'FAILED_WITH_VALUE' END],
  lambda e: e IS NOT NULL), ',') AS errors FROM orders""")
def snapshot_errors(t):
    return flags(quality.snapshot_errors(snapshots(t), "v1", "book-1")).select("o_orderkey", "errors")


@query("B13_scope_errors", """
SELECT c_custkey AS query_id, array_to_string(list_filter([CASE WHEN c_nationkey % 5 = 0 THEN 'SCOPE_NOT_APPROVED' END, CASE WHEN c_nationkey % 4 = 0 THEN 'COUNTRY_SCOPE_MISMATCH' END,
  CASE WHEN c_custkey % 3 = 2 THEN 'TARGET_OUTSIDE_SCOPE' END, CASE WHEN c_custkey % 3 = 0 AND c_nationkey % 7 = 0 THEN 'TARGET_EXCLUDED' END,
  CASE WHEN c_mktsegment NOT IN (SELECT p_name FROM part) AND c_custkey % 10 = 1 THEN 'CAPABILITY_MISSING' END, CASE WHEN c_custkey % 13 = 0 THEN 'ESTIMATE_CLASSIFICATION_CONFLICT' END], lambda e: e IS NOT NULL), ',') AS errors FROM customer""")
def scope_errors(t):
    nation = C("n_nationkey")
    scope = t.nation.select(nation.alias("project"), F.when(nation % 5 == 0, "PROPOSED").otherwise("APPROVED").alias("approval_state"),
                            F.lit("ref").alias("approval_ref"), F.lit("uat").alias("environment"),
                            F.when(nation % 4 == 0, "JP").otherwise("TW").alias("country"), F.concat(F.lower("n_name"), F.lit(".com")).alias("allowed_host"))
    host = F.concat(F.lit("nation_"), C("c_nationkey").cast("string"), F.lit(".com"))
    case = C("c_custkey") % 3
    queries = t.customer.select(C("c_custkey").alias("query_id"), C("c_nationkey").alias("project"), F.lit("TW").alias("country"),
                                F.when(case == 0, host).when(case == 1, F.concat(F.lit("Blog.A."), host)).otherwise(F.concat(F.lit("x"), host)).alias("target_host"),
                                (C("c_custkey") % 13 != 0).alias("estimation_flag"))
    excluded = t.nation.where("n_nationkey % 7 = 0").select(nation.alias("project"), F.concat(F.lit("NATION_"), nation.cast("string"), F.lit(".com")).alias("excluded_host"))
    required = t.customer.where("c_custkey % 10 = 1").select(C("c_custkey").alias("query_id"), C("c_mktsegment").alias("capability"))
    return flags(quality.scope_errors(queries, scope, excluded, required, t.part.select(C("p_name").alias("capability")))).select("query_id", "errors")


@query("B14_is_fresh", """
SELECT o_orderkey, o_orderstatus = 'F' AND DATE '1999-06-30' - CAST(o_orderdate AS DATE) BETWEEN 0 AND CASE WHEN o_orderkey % 2 = 0 THEN 30 ELSE 7 END AS fresh FROM orders""")
def is_fresh(t):
    source = F.when(C("o_orderkey") % 2 == 0, "AHREFS").otherwise("GSC")
    state = F.when(C("o_orderstatus") == "F", "READY").otherwise("STALE")
    return t.orders.select("o_orderkey", quality.is_fresh(source, state, F.lit("SUCCESS"), F.to_date("o_orderdate"), F.lit("1999-06-30").cast("date")).alias("fresh"))


def evidence_rows(t):
    key, day = C("o_orderkey"), F.to_date("o_orderdate")
    source = F.when(key % 2 == 0, "GSC").otherwise("SF")
    refs = F.array(F.struct(F.lit("URL").alias("entity_type"), C("o_custkey").cast("string").alias("entity_id")),
                   F.struct(F.lit("URL").alias("entity_type"), F.when(key % 7 == 0, C("o_custkey")).otherwise(-1).cast("string").alias("entity_id")))
    return t.orders.select(
        key.cast("string").alias("evidence_id"), F.lit(1).alias("revision"), source.alias("source"),
        F.when(key % 3 == 0, "OTHER").when(key % 2 == 0, schemas.SOURCE_CLASS["GSC"]).otherwise(schemas.SOURCE_CLASS["SF"]).alias("source_class"),
        F.lit("clicks").alias("metric"), F.lit("count").alias("unit"), F.lit("ref").alias("source_reference"), F.lit("v1").alias("contract_version"),
        F.when(C("o_orderstatus") == "F", "FAILED").otherwise("READY").alias("freshness_state"), C("o_totalprice").alias("value"),
        day.alias("period_start"), F.when(key % 5 == 0, F.date_sub(day, 1)).otherwise(day).alias("period_end"), day.alias("as_of"),
        C("o_orderdate").cast("timestamp").alias("retrieved_at"), refs.alias("entity_refs"), F.lit(None).cast("string").alias("supersedes_evidence_id"))


@query("B15_evidence_errors", """
SELECT CAST(o_orderkey AS VARCHAR) AS evidence_id, array_to_string(list_filter([CASE WHEN o_orderkey % 3 = 0 THEN 'INVALID_SOURCE_SEMANTICS' END,
  CASE WHEN o_orderstatus = 'F' THEN 'INVALID_VALUE' END, CASE WHEN o_orderkey % 5 = 0 THEN 'INVALID_DATE_ORDER' END,
  CASE WHEN o_orderkey % 7 = 0 THEN 'DUPLICATE_ENTITY_REF' END], lambda e: e IS NOT NULL), ',') AS errors FROM orders""")
def evidence_errors(t):
    return flags(quality.evidence_errors(evidence_rows(t))).select("evidence_id", "errors")


@query("B16_sensitive_flags", f"""
SELECT doc_id, regexp_matches(text, '{text.SECRET_VALUES}') AS has_secret, regexp_matches(text, '{text.EMAIL}') AND NOT regexp_matches(text, '{text.HASH_OR_TIME}') AS has_email,
  regexp_matches(text, '{text.PHONE}') AND NOT regexp_matches(text, '{text.HASH_OR_TIME}') AS has_phone FROM documents""")
def sensitive_flags(t):
    return quality.sensitive_flags(t.documents, ["text"]).select("doc_id", "has_secret", "has_email", "has_phone")


@query("B16_sensitive_names", """
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'api_key' WHEN 1 THEN 'email' WHEN 2 THEN 'access_token' ELSE 'clicks' END AS name, COUNT(*) AS rows,
  CASE o_orderkey % 4 WHEN 0 THEN 'SECRET_REJECTED' WHEN 1 THEN 'PII_REJECTED' WHEN 2 THEN 'SECRET_REJECTED' END AS code FROM orders GROUP BY 1, 3""")
def sensitive_names(t):
    """The verdict on each key that landed records carry, with the number of records that carry it."""
    names = ["api_key", "email", "access_token", "clicks"]
    keys = t.orders.select(F.element_at(F.array(*[F.lit(n) for n in names]), (C("o_orderkey") % 4 + 1).cast("int")).alias("name")).groupBy("name").agg(F.count(F.lit(1)).alias("rows"))
    wide = t.orders.select(*[F.lit(0).alias(n) for n in names])
    code = F.lit(None).cast("string")
    for name, verdict in quality.sensitive_columns(wide):
        code = F.when(C("name") == name, verdict).otherwise(code)
    return keys.withColumn("code", code)


@query("B17_dropped_keys", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'clicks' ELSE 'clicks,site' END AS keys FROM orders""")
def dropped_keys(t):
    third = F.when(C("o_orderkey") % 3 == 0, "client_secret").otherwise("site")
    values = F.create_map(F.lit("clicks"), C("o_orderstatus"), F.lit("access_token"), C("o_orderpriority"), third, C("o_orderstatus"))
    return t.orders.select("o_orderkey", F.array_join(F.array_sort(F.map_keys(text.drop_sensitive_keys(values))), ",").alias("keys"))


@query("B18_normal_forms", """
SELECT p_partkey, 'INVALID_NORMALIZED_VALUE' AS code FROM part WHERE p_partkey % 5 = 0""")
def normal_forms(t):
    stored = F.when(C("p_partkey") % 5 == 0, F.concat(C("p_name"), F.lit("!"))).otherwise(F.lower("p_name"))
    rows = t.part.select("p_partkey", F.upper("p_name").alias("raw"), stored.alias("stored"))
    return registry.normal_form_errors(rows, "raw", "stored", "text").select("p_partkey", "code")


@query("B17_redacted", f"""
SELECT doc_id, md5(CASE WHEN regexp_matches(text, '{text.CREDENTIAL}') THEN '[REDACTED]' ELSE text END) AS text_md5 FROM documents""")
def redacted(t):
    return quality.redacted(t.documents, ["text"]).select("doc_id", F.md5("text").alias("text_md5"))


@query("B18_identity_conflicts", """
SELECT 'TOPIC' AS entity_type, p_name AS entity_id, COUNT(*) AS rows, CASE WHEN COUNT(DISTINCT p_brand) > 1 THEN 'CANONICAL_VALUE_CONFLICT' ELSE 'DUPLICATE_ENTITY_ID' END AS code
FROM part GROUP BY p_name HAVING COUNT(*) > 1""")
def identity_conflicts(t):
    rows = t.part.select(F.lit("TOPIC").alias("entity_type"), C("p_name").alias("entity_id"), F.sha2("p_brand", 256).alias("semantic_hash"))
    return registry.identity_conflicts(rows)


@query("B19_formula_safe", """
SELECT p_partkey, CASE WHEN p_partkey % 4 < 3 THEN '''' ELSE '' END || CASE p_partkey % 4 WHEN 0 THEN '=' WHEN 1 THEN '+' WHEN 2 THEN '@' ELSE ' ' END || p_name AS cell FROM part""")
def formula_safe(t):
    sign = F.get(F.array(*[F.lit(s) for s in "=+@ "]), (C("p_partkey") % 4).cast("int"))
    return quality.formula_safe(t.part.select("p_partkey", F.concat(sign, "p_name").alias("cell")))


@query("B20_action_gate", """
SELECT COUNT(*) AS actions, COUNT(*) FILTER (o_orderkey % 3 <> 0) AS complete, COUNT(*) FILTER (o_orderpriority = '1-URGENT') AS p1,
  COUNT(*) FILTER (o_orderpriority = '1-URGENT') <= 5 AS p1_within_limit FROM orders""")
def action_gate(t):
    actions = t.orders.select(F.when(C("o_orderpriority") == "1-URGENT", "P1").otherwise("P2").alias("priority"), C("o_orderstatus").alias("problem"),
                              F.when(C("o_orderkey") % 3 == 0, " ").otherwise("x").alias("how_to"))
    return quality.action_gate(actions, ["problem", "how_to"])


# --- Sets -------------------------------------------------------------------------------------------------

@query("G1_concatenate", "SELECT o_orderkey AS id, o_custkey AS owner, 'orders' AS origin FROM orders UNION ALL SELECT event_id, user_id, 'events' FROM events")
def concatenate(t):
    orders = t.orders.select(C("o_orderkey").alias("id"), C("o_custkey").alias("owner"), F.lit("orders").alias("origin"))
    events = t.events.select(C("user_id").alias("owner"), C("event_id").alias("id"), F.lit("events").alias("origin"))
    return orders.unionByName(events)


@query("G2_missing_members", """
SELECT user_id, array_to_string(list_filter(['error', 'purchase', 'view'], lambda x: NOT list_contains(s, x)), ',') AS missing,
  CASE WHEN len(list_filter(['error', 'purchase', 'view'], lambda x: NOT list_contains(s, x))) > 0 THEN 'Partial' ELSE 'Ready' END AS data_status
FROM (SELECT user_id, list(DISTINCT event_type) AS s FROM (SELECT (user_id * 7 + value::INTEGER) // 10 AS user_id, event_type FROM events) GROUP BY 1)""")
def missing_members(t):
    df = quality.missing_members(t.events.select(F.floor((C("user_id") * 7 + F.rint("value").cast("int")) / 10).alias("user_id"), "event_type"), "user_id", "event_type", ["view", "purchase", "error"])
    return df.withColumn("missing", F.array_join("missing", ","))


@query("G3_role_gaps", """
SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 1 THEN 'technical' ELSE '' END AS undeclared, CASE WHEN o_orderkey % 3 = 0 THEN 'demand' ELSE '' END AS contradicted FROM orders""")
def role_gaps(t):
    key = C("o_orderkey")
    rows = t.orders.select("o_orderkey", F.array(F.lit("demand"), F.lit("technical")).alias("required"),
                           F.when(key % 3 == 0, F.array(F.lit("demand"))).otherwise(F.array().cast("array<string>")).alias("missing"),
                           F.when(key % 2 == 0, F.array(F.lit("demand"), F.lit("technical"))).otherwise(F.array(F.lit("demand"))).alias("covered"))
    gaps = quality.role_gaps(rows, "required", "missing", "covered")
    return gaps.select("o_orderkey", F.array_join("undeclared", ",").alias("undeclared"), F.array_join("contradicted", ",").alias("contradicted"))


@query("G4_first_by_key", """
SELECT l_partkey, l_suppkey, ARG_MIN(l_quantity, l_orderkey * 10 + l_linenumber) AS quantity, COUNT(*) - 1 AS dropped FROM lineitem GROUP BY 1, 2""")
def first_by_key(t):
    rows = t.lineitem.select("l_partkey", "l_suppkey", C("l_quantity").alias("quantity"), (C("l_orderkey") * 10 + C("l_linenumber")).alias("seq"))
    return quality.first_by_key(rows, ["l_partkey", "l_suppkey"], "seq").drop("seq")


@query("G5_distinct_by_hash", """
SELECT DISTINCT p_brand, p_type, sha256('["' || p_brand || '","' || p_type || '"]') AS content_hash FROM part""")
def distinct_by_hash(t):
    return quality.distinct_by_hash(t.part.select("p_brand", "p_type"), ["p_brand", "p_type"])


@query("G6_schema_difference", """
SELECT l_returnflag, COUNT(*) AS rows, 'l_batch' AS missing, 'l_comment' AS unexpected FROM lineitem GROUP BY 1""")
def schema_difference(t):
    rows = t.lineitem.select(*t.lineitem.columns, F.lit("").alias("l_comment")) if "l_comment" not in t.lineitem.columns else t.lineitem
    found = quality.schema_difference(rows, [*[c for c in t.lineitem.columns if c != "l_comment"], "l_batch"])
    return rows.groupBy("l_returnflag").agg(F.count(F.lit(1)).alias("rows")).withColumns({k: F.lit(",".join(v)) for k, v in found.items()})


@query("G7_same_set", """
SELECT o_orderkey, o_orderkey % 3 <> 0 AS same FROM orders""")
def same_set(t):
    key = C("o_orderkey")
    left = F.array(F.lit("A"), F.lit("B"), F.lit("A"))
    right = F.when(key % 3 == 0, F.array(F.lit("A"))).otherwise(F.array(F.lit("B"), F.lit("A")))
    return t.orders.select("o_orderkey", quality.same_set(left, right).alias("same"))


@query("G8_multiset_difference", """
WITH a AS (SELECT l_partkey, l_suppkey, COUNT(*) AS n FROM lineitem WHERE l_returnflag <> 'N' GROUP BY 1, 2),
b AS (SELECT l_partkey, l_suppkey, COUNT(*) AS n FROM lineitem WHERE l_returnflag <> 'R' GROUP BY 1, 2)
SELECT coalesce(a.l_partkey, b.l_partkey) AS l_partkey, coalesce(a.l_suppkey, b.l_suppkey) AS l_suppkey, coalesce(a.n, 0) AS left_rows, coalesce(b.n, 0) AS right_rows
FROM a FULL JOIN b ON a.l_partkey = b.l_partkey AND a.l_suppkey = b.l_suppkey WHERE coalesce(a.n, 0) <> coalesce(b.n, 0)""")
def multiset_difference(t):
    rows = t.lineitem.select("l_partkey", "l_suppkey", "l_returnflag")
    return quality.multiset_difference(rows.where("l_returnflag <> 'N'").drop("l_returnflag"), rows.where("l_returnflag <> 'R'").drop("l_returnflag"))


# --- Ranking ----------------------------------------------------------------------------------------------

@query("F1_sorted_facts", """
SELECT day, page, query, CAST(SUM(clicks) AS BIGINT) AS clicks FROM search_daily GROUP BY 1, 2, 3 ORDER BY 1, 2, 3""")
def sorted_facts(t):
    return t.search_daily.groupBy("day", "page", "query").agg(F.sum("clicks").alias("clicks")).orderBy("day", "page", "query")


@query("F2_table_order", """
SELECT o_orderkey, round(o_totalprice, 2) AS price FROM orders WHERE o_orderkey % 5 <> 0 UNION ALL SELECT o_orderkey, round(o_totalprice, 2) FROM orders WHERE o_orderkey % 5 = 0""")
def table_order(t):
    cell = F.when(C("o_orderkey") % 5 == 0, " ").otherwise(F.concat(F.lit("$"), F.format_number("o_totalprice", 2)))
    rows = t.orders.select("o_orderkey", "o_totalprice", cell.alias("cell"))
    return rows.orderBy(*ranking.table_order("cell", descending=True), "o_orderkey").select("o_orderkey", F.round("o_totalprice", 2).alias("price"))


@query("F3_calendar_key", """
SELECT o_orderkey, CASE o_orderkey % 2 WHEN 0 THEN isodow(o_orderdate) ELSE CAST(o_orderdate AS DATE) - DATE '1970-01-01' END AS place FROM orders""")
def calendar_key(t):
    value = F.when(C("o_orderkey") % 2 == 0, F.date_format("o_orderdate", "EEEE")).otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t.orders.select("o_orderkey", ranking.calendar_key(value).cast("long").alias("place"))


@query("F4_ranked_candidates", "SELECT o_orderkey AS candidate_id, CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS score FROM orders ORDER BY 2 DESC NULLS LAST, 1 LIMIT 100")
def ranked_candidates(t):
    rows = t.orders.select(C("o_orderkey").alias("candidate_id"), F.when(C("o_orderstatus") == "O", C("o_totalprice")).alias("score"))
    return ranking.ranked_candidates(rows, 100)


@query("F5_page", "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC, o_orderkey LIMIT 25 OFFSET 50")
def page(t):
    return ranking.page(t.orders.select("o_orderkey", "o_totalprice"), [F.desc("o_totalprice"), F.asc("o_orderkey")], 3, 25)


@query("F6_top_per_key", """
WITH q AS (SELECT site, page, CAST(SUM(clicks) AS BIGINT) AS clicks FROM search_daily GROUP BY 1, 2)
SELECT site, page, clicks, CAST(ROW_NUMBER() OVER (PARTITION BY site ORDER BY clicks DESC, page) AS INTEGER) AS rank FROM q QUALIFY ROW_NUMBER() OVER (PARTITION BY site ORDER BY clicks DESC, page) <= 10""")
def top_per_key(t):
    pages = t.search_daily.groupBy("site", "page").agg(F.sum("clicks").alias("clicks"))
    return ranking.top_per_key(pages, "site", [F.desc("clicks"), F.asc("page")], 10)


def actions(t):
    """Parts as actions, with sub-scores of 1 to 5 from size, price and brand."""
    size, key = C("p_size"), C("p_partkey")
    return t.part.select(key.alias("action_id"), (size % 5 + 1).alias("business_impact"), (key % 5 + 1).alias("traffic_opportunity"),
                         ((size + key) % 5 + 1).alias("conversion_relevance"), ((size * 3 + key) % 5 + 1).alias("technical_risk"), ((key * 7 + 1) % 5 + 1).alias("effort"))


ACTIONS = """a AS (SELECT p_partkey AS action_id, (p_size % 5 + 1) + (p_partkey % 5 + 1) + ((p_size + p_partkey) % 5 + 1) + ((p_size * 3 + p_partkey) % 5 + 1) - ((p_partkey * 7 + 1) % 5 + 1) AS priority_score FROM part),
c AS (SELECT *, CASE WHEN priority_score >= 12 THEN 'P1' WHEN priority_score >= 8 THEN 'P2' ELSE 'P3' END AS priority FROM a)"""


@query("F7_additive_priority", f"WITH {ACTIONS} SELECT * FROM c")
def additive_priority(t):
    return ranking.additive_priority(actions(t)).select("action_id", "priority_score", "priority")


@query("F7_over_limit_p1", f"""
WITH {ACTIONS}, r AS (SELECT *, ROW_NUMBER() OVER (ORDER BY priority_score DESC, action_id) AS place FROM c WHERE priority = 'P1') SELECT action_id, priority_score, place FROM r WHERE place > 5""")
def over_limit_p1(t):
    return ranking.over_limit_p1(ranking.additive_priority(actions(t)), "action_id").select("action_id", "priority_score", "place")


@query("F8_action_queue", """
SELECT p_partkey AS action_id, CASE WHEN p_partkey % 3 = 0 THEN 'P1' ELSE 'P3' END AS priority, round((p_size % 5 + 1) * (p_partkey % 5 + 1) * ((p_size + p_partkey) % 5 + 1)::DOUBLE / nullif((p_partkey * 7 + 1) % 5, 0), 6) AS sort_score
FROM part ORDER BY 2, 3 DESC NULLS LAST, 1 LIMIT 5""")
def action_queue(t):
    rows = actions(t).select("action_id", F.when(C("action_id") % 3 == 0, "P1").otherwise("P3").alias("priority"), C("business_impact").alias("impact"),
                             C("traffic_opportunity").alias("opportunity"), C("conversion_relevance").alias("confidence"), (C("effort") - 1).alias("cost"))
    return rounded(ranking.action_queue(rows).select("action_id", "priority", "sort_score"), "sort_score")


@query("F10_shortlist", """
WITH r AS (SELECT o_custkey, o_orderkey, ROW_NUMBER() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rank, COUNT(*) OVER (PARTITION BY o_custkey) AS n FROM orders)
SELECT o_custkey, o_orderkey, CAST(rank AS INTEGER) AS rank, n > 10 AS truncated FROM r WHERE rank <= 10""")
def shortlist(t):
    return ranking.shortlist(t.orders.select("o_custkey", "o_orderkey", "o_totalprice"), "o_custkey", [F.desc("o_totalprice"), F.asc("o_orderkey")], 10).drop("o_totalprice")


@query("F11_by_visible_total", """
SELECT site, CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(impressions) AS BIGINT) AS impressions, CAST(SUM(clicks) + SUM(impressions) AS BIGINT) AS total FROM search_daily GROUP BY 1 ORDER BY 4 DESC""")
def by_visible_total(t):
    return ranking.by_visible_total(t.search_daily.groupBy("site").agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions")), ["clicks", "impressions"])


@query("F12_ranked_list", "SELECT page, CAST(SUM(clicks) AS BIGINT) AS clicks FROM search_daily GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 5")
def ranked_list(t):
    return ranking.ranked_list(t.search_daily.groupBy("page").agg(F.sum("clicks").alias("clicks")), [F.desc("clicks"), F.asc("page")])


@query("F13_within_budget", """
WITH r AS (SELECT o_orderkey, CAST(o_orderdate AS DATE) AS day, CAST(SUM(CAST(FLOOR(o_totalprice) AS BIGINT)) OVER (ORDER BY CAST(o_orderdate AS DATE), o_orderkey ROWS UNBOUNDED PRECEDING) AS BIGINT) AS spent FROM orders)
SELECT * FROM r WHERE spent <= 200000000""")
def within_budget(t):
    rows = t.orders.select("o_orderkey", F.to_date("o_orderdate").alias("day"), F.floor("o_totalprice").alias("cost"))
    return ranking.within_budget(rows, "day", "o_orderkey", "cost", 200000000).drop("cost")


@query("E10_rank_errors", """
SELECT l_orderkey, COUNT(*) AS results, COUNT(DISTINCT l_linenumber) = COUNT(*) AS unique_ranks FROM lineitem GROUP BY 1""")
def rank_errors(t):
    return ranking.rank_errors(t.lineitem.select("l_orderkey", C("l_linenumber").alias("rank")), "l_orderkey")


# --- Revision logs ----------------------------------------------------------------------------------------

def revision_log(t):
    """Each customer's orders as the revisions of one record; a few links are broken on purpose."""
    return t.revision_log.select(
        "id", C("revision").cast("long").alias("revision"), C("record").cast("string").alias("record_id"), "as_of", "status", "value",
        F.sha2(F.concat_ws("|", "status", C("value").cast("string")), 256).alias("content_hash"),
        F.when(C("revision") > 1, C("revision") - 1).cast("long").alias("supersedes_revision"))


@query("E8_chain_violations", """
WITH l AS (SELECT id, CASE WHEN record % 50 = 0 THEN revision + 1 ELSE revision END AS r, CAST(record AS VARCHAR) AS record, CASE WHEN record % 31 = 0 THEN as_of - 4000 ELSE as_of END AS day FROM revision_log),
s AS (SELECT id, r, COUNT(*) AS copies, MIN(record) AS first, MIN(day) AS first_day FROM l GROUP BY 1, 2),
p AS (SELECT l.*, s.copies, b.first AS prior, b.first_day AS prior_day, CASE WHEN l.record::BIGINT % 23 = 0 THEN 'other' ELSE b.first END AS named
  FROM l JOIN s ON s.id = l.id AND s.r = l.r LEFT JOIN s b ON b.id = l.id AND b.r = l.r - 1),
v AS (SELECT id, r AS revision, CASE WHEN copies > 1 THEN 'DUPLICATE_REVISION' WHEN r > 1 AND prior IS NULL THEN 'REVISION_GAP' WHEN r = 1 AND named IS NOT NULL THEN 'INVALID_SUPERSEDES'
    WHEN r > 1 AND named IS DISTINCT FROM prior THEN 'BROKEN_CHAIN' WHEN day < prior_day THEN 'AS_OF_WENT_BACK' END AS code FROM p)
SELECT * FROM v WHERE code IS NOT NULL""")
def chain_violations(t):
    log = revision_log(t).withColumn("revision", C("revision") + F.when(C("record_id").cast("long") % 50 == 0, 1).otherwise(0))
    ids = log.groupBy("id", "revision").agg(F.min("record_id").alias("_prior")).select("id", (C("revision") + 1).alias("revision"), "_prior")
    number = C("record_id").cast("long")
    linked = log.join(ids, ["id", "revision"], "left").withColumns({
        "supersedes_id": F.when(number % 23 == 0, "other").otherwise(C("_prior")), "as_of": F.when(number % 31 == 0, F.date_sub("as_of", 4000)).otherwise(C("as_of"))})
    return revisions.chain_violations(linked, ["id"], "record_id", "supersedes_id", "as_of")


@query("E9_latest", "SELECT id, CAST(MAX(revision) AS BIGINT) AS revision, ARG_MAX(status, revision) AS status, ARG_MAX(value, revision) AS value FROM revision_log GROUP BY 1")
def latest(t):
    return revisions.latest(revision_log(t), ["id"]).select("id", "revision", "status", "value")


LOG_HASH = "sha256(status || '|' || value)"


@query("C5_resolve_pins", f"""
WITH l AS (SELECT id, revision, {LOG_HASH} AS h FROM revision_log),
p AS (SELECT id, CASE WHEN id % 3 = 0 THEN revision + 100 ELSE revision END AS revision, CASE WHEN id % 3 = 1 THEN 'moved' ELSE h END AS h FROM l)
SELECT id, CAST(revision AS BIGINT) AS revision, CASE WHEN id % 3 = 0 THEN 'MISSING' WHEN id % 3 = 1 THEN 'DRIFT' ELSE 'OK' END AS pin_state FROM p""")
def resolve_pins(t):
    log = revision_log(t)
    pins = log.select("id", (C("revision") + F.when(C("id") % 3 == 0, 100).otherwise(0)).alias("revision"),
                      F.when(C("id") % 3 == 1, "moved").otherwise(C("content_hash")).alias("content_hash"))
    return revisions.resolve_pins(pins, log, ["id"]).select("id", "revision", "pin_state")


@query("K26_append_plan", """
WITH s AS (SELECT id, revision, MAX(revision) OVER (PARTITION BY id) AS top FROM revision_log),
t AS (SELECT *, top - top // 2 AS tip FROM s)
SELECT id, CAST(revision AS BIGINT) AS revision, CASE WHEN revision <= tip AND id % 5 = 0 THEN 'REVISION_CONFLICT' WHEN revision <= tip THEN 'IDEMPOTENT'
  WHEN id % 7 = 0 AND revision > tip + 1 THEN 'REVISION_GAP' WHEN id % 7 = 0 THEN 'INVALID_SUPERSEDES' ELSE 'APPEND' END AS decision FROM t""")
def append_plan(t):
    full = revision_log(t)
    tops = full.groupBy("id").agg((F.max("revision") - F.floor(F.max("revision") / 2)).alias("tip"))
    log = full.join(tops, "id").where("revision <= tip").drop("tip")
    hurt = full.withColumns({"content_hash": F.when(C("id") % 5 == 0, F.concat(F.lit("x"), "content_hash")).otherwise(C("content_hash")),
                             "supersedes_revision": F.when(C("id") % 7 == 0, F.lit(99)).otherwise(C("supersedes_revision"))})
    return revisions.append_plan(log, hurt, ["id"]).select("id", "revision", "decision")


@query("A10_log_integrity", """
SELECT id, CAST(revision AS BIGINT) AS revision, 'HASH_MISMATCH' AS code FROM revision_log WHERE record % 9 = 0""")
def log_integrity(t):
    rows = revision_log(t).select("id", "revision", "status", "value", "record_id")
    hashed = rows.withColumn("content_hash", revisions.row_hash(rows, ["id", "revision", "status", "value"]))
    tampered = hashed.withColumn("value", C("value") + F.when(C("record_id").cast("long") % 9 == 0, 1).otherwise(0))
    return revisions.log_integrity(tampered, ["id"], ["id", "revision", "status", "value"]).select("id", "revision", "code")


def kpi_history(t):
    """The first order of each month and priority is stored, all others are candidates; other sources have no history.

    Of the candidates a third repeat the stored content; of those that name a predecessor the second names the first.
    """
    keyed = settled(revisions.snapshot_hashes(snapshots(t)), "snapshots")
    by_key = joins.Window.partitionBy("logical_key")
    case = C("o_orderkey") % 3
    rows = keyed.withColumns({"place": F.row_number().over(by_key.orderBy("o_orderkey")), "nth": F.row_number().over(joins.Window.partitionBy("logical_key", case).orderBy("o_orderkey"))})
    known = C("source") == "Excel Actual"
    stored = rows.where(known & (C("place") == 1)).withColumns({"revision": F.lit(1), "snapshot_id": F.concat(F.lit("snap_"), C("o_orderkey").cast("string"))})
    tips = stored.select("logical_key", C("snapshot_id").alias("_tip"), C("content_hash").alias("_hash"), (C("o_orderkey") % 3 == 1).alias("_one"))
    batch = rows.where(~known | (C("place") > 1)).join(tips, "logical_key", "left")
    nth = C("nth") - F.when(C("_one"), 1).otherwise(0)
    first = batch.where((case == 1) & (nth == 1)).select("logical_key", revisions.snapshot_id(C("logical_key"), C("content_hash"), F.lit(2), C("_tip")).alias("_next"))
    batch = batch.join(first, "logical_key", "left").withColumns({
        "content_hash": F.when((case == 0) & known, C("_hash")).otherwise(C("content_hash")),
        "supersedes_snapshot_id": F.when((case == 1) & known, F.when(nth == 2, C("_next")).otherwise(C("_tip")))})
    return stored.drop("place", "nth"), batch.drop("_tip", "_hash", "_one", "_next", "place", "nth")


HISTORY_SQL = """k AS (SELECT o_orderkey, o_orderkey % 11 = 0 AS fresh, CASE WHEN o_orderkey % 11 = 0 THEN 'U' ELSE '' END || strftime(o_orderdate, '%Y-%m') || CASE WHEN o_orderkey % 7 = 0 THEN '*' ELSE '' END || o_orderpriority AS k FROM orders),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY o_orderkey) AS place FROM k),
b AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY k, o_orderkey % 3 ORDER BY o_orderkey) AS nth FROM r WHERE fresh OR place > 1),
d AS (SELECT o_orderkey, CASE WHEN fresh AND place = 1 THEN 'NEW' WHEN NOT fresh AND o_orderkey % 3 = 0 THEN 'SKIP' WHEN NOT fresh AND o_orderkey % 3 = 1 AND nth <= 2 THEN 'REVISE' ELSE 'REJECT_NEEDS_SUPERSEDES' END AS decision,
  CASE WHEN fresh AND place = 1 THEN 1 WHEN NOT fresh AND o_orderkey % 3 = 1 AND nth <= 2 THEN nth + 1 END AS revision FROM b)"""


@query("K15_snapshot_plan", f"WITH {HISTORY_SQL} SELECT * FROM d")
def snapshot_plan(t):
    return revisions.snapshot_plan(*kpi_history(t), ["o_orderkey"]).select("o_orderkey", "decision", "revision")


@query("K15_seal", f"WITH {HISTORY_SQL} SELECT o_orderkey, revision, TRUE AS pinned, decision = 'REVISE' AS linked FROM d WHERE revision IS NOT NULL")
def seal(t):
    """Every accepted candidate has an id of its own, made of its key, content, place and predecessor."""
    sealed = revisions.seal(revisions.snapshot_plan(*kpi_history(t), ["o_orderkey"]))
    copies = sealed.groupBy("snapshot_id").agg(F.count(F.lit(1)).alias("_copies"))
    return sealed.join(copies, "snapshot_id").select("o_orderkey", "revision", (C("snapshot_id").rlike("^snap_[0-9a-f]{64}$") & (C("_copies") == 1)).alias("pinned"), C("supersedes_snapshot_id").isNotNull().alias("linked"))


@query("K16_report_rows", """
WITH r AS (SELECT o_custkey AS k, ARG_MAX(o_orderstatus, o_orderkey) AS s, CAST(ARG_MAX(o_orderdate, o_orderkey) AS DATE) AS d, ARG_MAX(o_totalprice, o_orderkey) AS v FROM orders GROUP BY 1),
e AS (SELECT *, CASE WHEN d > DATE '2001-01-01' THEN 'FUTURE' WHEN s = 'F' THEN 'Failed' WHEN d < DATE '2001-01-01' THEN 'Stale' ELSE 'Ready' END AS effective_status, d >= last_day(d - 100) + 60 AS mature_cohort FROM r)
SELECT k AS logical_key, effective_status, mature_cohort, effective_status = 'Ready' AND mature_cohort AS formal_trend_eligible,
  CASE WHEN effective_status = 'Ready' AND mature_cohort THEN round(v / 100000, 6) END AS target_attainment FROM e""")
def report_rows(t):
    day = F.to_date("o_orderdate")
    history = t.orders.select(C("o_custkey").alias("logical_key"), C("o_orderkey").alias("revision"), day.alias("as_of_date"), F.date_sub(day, 100).alias("period_start"),
                              F.when(C("o_orderstatus") == "F", "Failed").otherwise("Ready").alias("data_status"), F.lit("sql").alias("metric"),
                              F.lit("Business").alias("metric_group"), C("o_totalprice").alias("value"), F.lit(100000.0).alias("target"))
    out = revisions.report_rows(history, "2001-01-01").select("logical_key", "effective_status", "mature_cohort", "formal_trend_eligible", "target_attainment")
    return rounded(out, "target_attainment")


@query("I3_idempotency", """
SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'IDEMPOTENCY_CONFLICT' WHEN o_orderkey % 3 = 1 THEN 'ALREADY_APPLIED' ELSE 'NEW' END AS decision FROM orders""")
def idempotency(t):
    key = C("o_orderkey")
    ops = t.orders.select("o_orderkey", F.sha2(key.cast("string"), 256).alias("idempotency_key"), F.md5("o_orderstatus").alias("semantic_hash"))
    ledger = ops.where(key % 3 != 2).select("idempotency_key", F.when(key % 3 == 0, "other").otherwise(C("semantic_hash")).alias("semantic_hash"))
    return revisions.idempotency(ops, ledger).select("o_orderkey", "decision")


# --- Registry ---------------------------------------------------------------------------------------------

@query("K18_topics", """
SELECT p_partkey, lower(p_name) AS normalized_name, 'TOPIC_' || substr(sha256('{"normalized_name":"' || lower(p_name) || '","version":"1"}'), 1, 24) AS topic_id FROM part""")
def topics(t):
    rows = t.part.select("p_partkey", F.concat(F.lit("  "), F.initcap("p_name"), F.lit(" ")).alias("topic_name"), F.lit("1").alias("version"))
    return registry.make_topics(rows).drop("topic_name", "version")


@query("K18_keywords", """
SELECT p_partkey, 'KW_' || substr(sha256('{"country_database":"TW","locale":"zh-TW","normalization_version":"unicode-nfc-width-casefold-v1","normalized_text":"' || lower(p_name) || '"}'), 1, 24) AS keyword_id FROM part""")
def keywords(t):
    rows = t.part.select("p_partkey", "p_name", F.lit("zh-TW").alias("locale"), F.lit("TW").alias("country_database"))
    return registry.make_texts(rows, "KW", "p_name", "keyword_id").select("p_partkey", "keyword_id")


@query("K18_urls", f"""
WITH {URL_SQL} SELECT page_id, 'URL_' || substr(sha256('{{"normalized_url":"' || normalized_url || '","policy":"url-sanitization.v1"}}'), 1, 24) AS url_id FROM norm""")
def registry_urls(t):
    return registry.make_urls(t.pages.select("page_id", C("url").alias("observed_url"))).select("page_id", "url_id")


@query("K18_competitors", """
SELECT s_suppkey, 'COMP_' || substr(sha256('{"domain":"shop' || s_suppkey || '.example","scope":"tw"}'), 1, 24) AS competitor_id FROM supplier""")
def competitors(t):
    rows = t.supplier.select("s_suppkey", F.concat(F.lit("Shop"), "s_suppkey", F.lit(".Example.")).alias("domain"), F.lit("tw").alias("scope"))
    return registry.make_competitors(rows).select("s_suppkey", "competitor_id")


@query("K18_registry_hash")
def registry_hash(t):
    hashed = registry.with_semantic_hash(t.part)
    return registry.registry_hash(hashed, "p_partkey")


WORD_SUMS = " || ',' || ".join(f"CAST(SUM(CAST('0x' || substr(h, {1 + 8 * i}, 8) AS BIGINT)) AS VARCHAR)" for i in range(8))


@query("K18_registry_hash_named", f"""
WITH r AS (SELECT sha256(p_partkey || '|' || sha256('{{"p_brand":"' || p_brand || '","p_name":"' || p_name || '","p_partkey":' || p_partkey || ',"p_size":' || p_size || '}}')) AS h FROM part)
SELECT COUNT(*) AS entities, sha256({WORD_SUMS}) AS registry_hash FROM r""")
def registry_hash_named(t):
    """The registry hash over the named columns of whole values, whose JSON both engines can write."""
    hashed = registry.with_semantic_hash(t.part.select("p_partkey", "p_name", "p_brand", "p_size"))
    return registry.registry_hash(hashed, "p_partkey")


@query("B18_relation_errors", """
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'INVALID_RELATION_TYPE' END, CASE WHEN o_custkey % 3 = 0 AND o_orderkey % 5 <> 0 THEN 'DANGLING_REFERENCE' END,
  CASE WHEN o_orderstatus = 'P' THEN 'UNAPPROVED_RELATION' END], lambda e: e IS NOT NULL), ',') AS errors FROM orders""")
def relation_errors(t):
    key = C("o_orderkey")
    relations = t.orders.select(
        "o_orderkey", F.concat(F.lit("REL_"), key).alias("relation_id"), F.when(key % 5 == 0, "TOPIC_HAS_WISH").otherwise("TOPIC_HAS_URL").alias("relation_type"),
        F.lit("TOPIC").alias("source_entity_type"), F.concat(F.lit("T"), "o_custkey").alias("source_entity_id"),
        F.lit("URL").alias("target_entity_type"), F.concat(F.lit("U"), "o_custkey").alias("target_entity_id"), F.lit("CURATED").alias("mapping_method"),
        F.when(C("o_orderstatus") == "P", "APPROVED").otherwise("CANDIDATE").alias("review_state"), F.lit(None).cast("string").alias("reviewed_by_id"),
        F.array(F.lit("E1")).alias("evidence_refs"), F.lit(None).cast("date").alias("valid_from"), F.lit(None).cast("date").alias("valid_to"))
    entities = t.customer.select(F.lit("TOPIC").alias("entity_type"), F.concat(F.lit("T"), "c_custkey").alias("entity_id")).unionByName(
        t.customer.where("c_custkey % 3 <> 0").select(F.lit("URL").alias("entity_type"), F.concat(F.lit("U"), "c_custkey").alias("entity_id")))
    return flags(registry.relation_errors(relations, entities)).select("o_orderkey", "errors")


@query("B18_reference_errors", """
WITH topics AS (SELECT c_custkey AS k FROM customer WHERE c_custkey % 3 <> 0), x AS (
SELECT 'TOPIC' AS entity_type, 'T' || c_custkey AS entity_id, 'business_theme_refs' AS field, 'B' || c_nationkey AS ref FROM customer WHERE c_custkey % 3 <> 0 AND c_nationkey % 4 = 0
UNION ALL SELECT 'KEYWORD', 'K' || o_orderkey, 'canonical_topic_refs', 'T' || k FROM (SELECT o_orderkey, o_custkey AS k FROM orders UNION ALL SELECT o_orderkey, o_custkey + 1 FROM orders) o WHERE k NOT IN (SELECT k FROM topics)
UNION ALL SELECT 'COMPETITOR', 'C' || s_suppkey, 'parent_competitor_ref', 'C' || s_suppkey * 2 FROM supplier WHERE s_suppkey % 2 = 0 AND s_suppkey * 2 NOT IN (SELECT s_suppkey FROM supplier))
SELECT *, 'DANGLING_REFERENCE' AS code FROM x""")
def reference_errors(t):
    def name(letter, key):
        return F.concat(F.lit(letter), key)
    topic = C("o_custkey")
    return registry.reference_errors({
        "TOPIC": t.customer.where("c_custkey % 3 <> 0").select(name("T", "c_custkey").alias("entity_id"), F.array(name("B", "c_nationkey"), F.lit(None)).alias("business_theme_refs")),
        "BUSINESS_THEME": t.nation.where("n_nationkey % 4 <> 0").select(name("B", "n_nationkey").alias("entity_id")),
        "KEYWORD": t.orders.select(name("K", "o_orderkey").alias("entity_id"), F.array(name("T", topic), name("T", topic), name("T", topic + 1)).alias("canonical_topic_refs")),
        "COMPETITOR": t.supplier.select(name("C", "s_suppkey").alias("entity_id"), F.when(C("s_suppkey") % 2 == 0, name("C", C("s_suppkey") * 2)).alias("parent_competitor_ref"))})


# --- Joins ------------------------------------------------------------------------------------------------

@query("C1_resolve_exactly_one", f"""
WITH {URL_SQL}, r AS (SELECT regexp_replace(normalized_url, '[?].*$', '') AS k, COUNT(DISTINCT page_id) AS n, MIN(page_id) AS id FROM norm WHERE normalized_url IS NOT NULL GROUP BY 1)
SELECT norm.page_id AS landing_id, CASE WHEN n IS NULL THEN 'UNRESOLVED' WHEN n > 1 THEN 'AMBIGUOUS' ELSE 'RESOLVED' END AS match_state, CASE WHEN n = 1 THEN id END AS page_id FROM norm LEFT JOIN r ON r.k = norm.normalized_url""")
def resolve_exactly_one(t):
    urls = registry.make_urls(t.pages.select("page_id", C("url").alias("observed_url"))).where("normalized_url IS NOT NULL")
    entries = urls.select("page_id", F.regexp_replace("normalized_url", r"[?].*$", "").alias("key"))
    rows = registry.make_urls(t.pages.select(C("page_id").alias("landing_id"), C("url").alias("observed_url")))
    return joins.resolve_exactly_one(rows, "normalized_url", entries, "key", "page_id").select("landing_id", "match_state", "page_id")


@query("C2_sitemap_status", """
WITH d AS (SELECT o_custkey, CAST(MAX(o_orderdate) AS DATE) AS d, COUNT(*) % 3 AS errors FROM orders GROUP BY 1)
SELECT c_custkey AS path, DATE '2001-12-31' - d AS stale_days, CASE WHEN c_custkey % 3 > 0 AND DATE '2001-12-31' - d > 180 THEN 'HISTORICAL' WHEN c_custkey % 3 > 0 THEN 'CURRENT' END AS note
FROM customer LEFT JOIN d ON d.o_custkey = c_custkey""")
def sitemap_status(t):
    listed = t.customer.select(F.lit("s").alias("site"), C("c_custkey").alias("path"), (C("c_custkey") % 3).alias("errors"), F.lit(None).cast("int").alias("warnings"))
    details = t.orders.groupBy(C("o_custkey").alias("path")).agg(F.to_date(F.max("o_orderdate")).alias("last_downloaded")).withColumn("site", F.lit("s"))
    return joins.sitemap_status(listed, details, "2001-12-31").select("path", "stale_days", "note")


def bundles(t):
    """One evaluation bundle per part; its evidence are the line items."""
    topics = t.part.select(C("p_partkey").alias("bundle_id"), F.concat(F.lit("T"), "p_partkey").alias("topic_id"))
    key = C("l_orderkey") % 4
    topic = F.concat(F.lit("T"), "l_partkey")
    evidence = t.lineitem.select(
        C("l_partkey").alias("bundle_id"), F.concat_ws("-", "l_orderkey", "l_linenumber").alias("evidence_id"),
        F.when(key == 0, topic).when(key == 3, "T-other").alias("topic_id"),
        F.when(key == 1, F.array(topic, F.lit("T-x"))).otherwise(F.array().cast("array<string>")).alias("topic_refs"))
    return topics, evidence


@query("C6_topic_evidence", """
SELECT 'T' || l_partkey AS topic_id, l_orderkey || '-' || l_linenumber AS evidence_id FROM lineitem WHERE l_orderkey % 4 <> 3 AND l_partkey IN (SELECT p_partkey FROM part)""")
def topic_evidence(t):
    return joins.topic_evidence(*bundles(t)).select("topic_id", "evidence_id")


@query("C7_url_matches", """
SELECT l_orderkey, l_linenumber, l_orderkey % 3 = 0 OR (l_orderkey % 3 = 1 AND l_suppkey % 2 = 0) AS matches FROM lineitem""")
def url_matches(t):
    case = C("l_orderkey") % 3
    urls = F.when(case == 0, F.array().cast("array<string>")).when(case == 1, F.array(F.concat(F.lit("u"), C("l_suppkey") % 2))).otherwise(F.array(F.lit("v")))
    return t.lineitem.select("l_orderkey", "l_linenumber", joins.url_matches(urls, F.lit("u0")).alias("matches"))


@query("C8_with_diagnostics", """
SELECT o_orderkey AS candidate_id, CASE WHEN o_orderkey % 2 = 0 THEN 'WEAK' ELSE 'NOT_AVAILABLE' END AS behaviour_status, CASE WHEN o_orderkey % 3 = 0 THEN 'CONFLICT' ELSE 'NOT_CHECKED' END AS serp_status,
  CASE WHEN o_orderkey % 5 = 0 THEN 'STABLE' WHEN o_orderstatus = 'F' THEN 'EMBEDDED' ELSE 'NOT_CHECKED' END AS geo_status FROM orders""")
def with_diagnostics(t):
    key = C("o_orderkey")
    candidates = t.orders.select(key.alias("candidate_id"), F.lit(1).alias("revision"), F.when(C("o_orderstatus") == "F", "EMBEDDED").alias("embedded_geo"))

    def diagnostic(n, status):
        return t.orders.where(key % n == 0).select(key.alias("candidate_id"), F.lit(1).alias("revision"), F.lit(status).alias("status"))

    return joins.with_diagnostics(candidates, diagnostic(2, "WEAK"), diagnostic(3, "CONFLICT"), diagnostic(5, "STABLE")).drop("revision", "embedded_geo")


@query("C9_domain_owner", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 4 = 0 THEN 'OWNED' WHEN l_suppkey % 4 = 1 THEN 'COMPETITOR' ELSE 'UNMAPPED_DOMAIN' END AS match_state,
  CASE WHEN l_suppkey % 4 = 1 THEN 'COMP' || l_suppkey END AS competitor_id FROM lineitem""")
def domain_owner(t):
    def name(c):
        return F.concat(F.lit("d"), c, F.lit(".example"))
    results = t.lineitem.select("l_orderkey", "l_linenumber", name("l_suppkey").alias("domain"))
    owned = t.supplier.where("s_suppkey % 4 = 0").select(name("s_suppkey").alias("domain"))
    rivals = t.supplier.where("s_suppkey % 4 = 1").select(name("s_suppkey").alias("domain"), F.concat(F.lit("COMP"), "s_suppkey").alias("competitor_id"))
    return joins.domain_owner(results, "domain", owned, rivals).drop("domain")


@query("C10_prompt_topics", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN 'UNRESOLVED_PROMPT' WHEN l_linenumber % 3 = 0 THEN 'TOPIC_NOT_IN_PROMPT' WHEN l_linenumber % 3 = 1 AND l_partkey % 2 = 0 THEN 'AMBIGUOUS_TOPIC' ELSE 'MAPPED' END AS mapping_state FROM lineitem""")
def prompt_topics(t):
    case = C("l_linenumber") % 3
    seen = t.lineitem.select("l_orderkey", "l_linenumber", C("l_partkey").alias("prompt_id"), F.when(case == 0, "T-none").when(case == 2, "T-a").alias("topic_id"))
    prompts = t.part.where("p_partkey % 5 <> 0").select(C("p_partkey").alias("prompt_id"), F.when(C("p_partkey") % 2 == 0, F.array(F.lit("T-a"), F.lit("T-b"))).otherwise(F.array(F.lit("T-a"))).alias("topic_refs"))
    return joins.prompt_topics(seen, prompts).select("l_orderkey", "l_linenumber", "mapping_state")


@query("C11_page_property", """
WITH c AS (SELECT COUNT(*) AS seq, regexp_extract(url, '^([a-z]+://[^/?#]*/[a-z]{2}/)', 1) AS site FROM pages GROUP BY 2),
x AS (SELECT MIN(page_id) AS seq, site FROM (SELECT page_id, regexp_extract(url, '^([a-z]+://[^/?#]*/[a-z]{2}/)', 1) AS site FROM pages) WHERE site <> '' AND page_id % 2 = 0 GROUP BY 2)
SELECT page_id, coalesce((SELECT ARG_MIN(x.site, x.seq) FROM x WHERE starts_with(pages.url, x.site)), (SELECT ARG_MIN(site, seq) FROM x)) AS site FROM pages""")
def page_property(t):
    site = F.regexp_extract("url", "^([a-z]+://[^/?#]*/[a-z]{2}/)", 1)
    configs = t.pages.where("page_id % 2 = 0").select("page_id", site.alias("site")).where("site <> ''").groupBy("site").agg(
        F.min("page_id").alias("seq")).withColumn("property", F.concat(F.lit("sc-domain:"), "site"))
    return joins.page_property(t.pages.select("page_id", "url"), "url", configs).select("page_id", "site")


@query("C12_linked_steps", """
SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN 'OWN' WHEN o_custkey % 2 = 0 THEN 'LINKED' ELSE 'BROKEN' END AS link_state,
  CASE WHEN o_orderkey % 4 = 0 THEN o_orderstatus WHEN o_custkey % 2 = 0 THEN 'DONE' END AS status FROM orders""")
def linked_steps(t):
    steps = t.orders.select("o_orderkey", F.when(C("o_orderkey") % 4 != 0, C("o_custkey")).alias("source_ref"), C("o_orderstatus").alias("status"))
    recommendations = t.customer.where("c_custkey % 2 = 0").select(C("c_custkey").alias("id"), F.lit("DONE").alias("status"))
    return joins.linked_steps(steps, recommendations).drop("source_ref")


@query("C14_compare_sides", """
WITH s AS (SELECT l_partkey, l_suppkey, SUM(l_quantity) FILTER (l_linestatus = 'O') AS b, SUM(l_quantity) FILTER (l_linestatus = 'F') AS f FROM lineitem GROUP BY 1, 2)
SELECT l_partkey AS track_id, l_suppkey AS metric, b AS baseline_value, f AS follow_up_value, CASE WHEN b IS NULL THEN 'MISSING_BASELINE' WHEN f IS NULL THEN 'MISSING_FOLLOW_UP' WHEN l_suppkey % 3 = 0 THEN 'SCOPE_MISMATCH'
  WHEN l_partkey % 4 = 0 AND l_suppkey % 7 = 0 THEN 'SAMPLE_REVISION_MISMATCH' WHEN l_partkey % 4 = 0 AND l_suppkey % 7 = 1 THEN 'SAMPLE_REVISION_MISSING' WHEN l_partkey % 4 = 1 AND l_suppkey % 7 = 2 THEN 'SNAPSHOT_NOT_A_PERIOD' END AS mismatch FROM s""")
def compare_sides(t):
    observed = t.lineitem.groupBy(C("l_partkey").alias("track_id"), C("l_suppkey").alias("metric"), "l_linestatus").agg(F.sum("l_quantity").alias("value"))
    sides = observed.select("track_id", "metric", F.when(C("l_linestatus") == "O", "baseline").otherwise("follow_up").alias("side"), "value",
                            F.when((C("metric") % 3 == 0) & (C("l_linestatus") == "O"), "SITE").otherwise("PAGE").alias("scope"),
                            F.element_at(F.array(F.lit("WORKDUO"), F.lit("SERP"), F.lit("GSC"), F.lit("GA4")), (C("track_id") % 4 + 1).cast("int")).alias("source"), F.lit("v1").alias("sample_version"),
                            F.when(C("metric") % 7 == 1, None).when((C("metric") % 7 == 0) & (C("l_linestatus") == "O"), 2).otherwise(1).alias("sample_revision"),
                            F.when((C("metric") % 7 == 2) & (C("l_linestatus") == "O"), "2024-01-31").otherwise("2024-02-29").alias("period_end"))
    return joins.compare_sides(sides).select("track_id", "metric", "baseline_value", "follow_up_value", "mismatch")


@query("C15_dangling", "SELECT 'CUSTOMER' AS entity_type, o_custkey AS entity_id, o_orderkey FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')")
def dangling(t):
    refs = t.orders.select(F.lit("CUSTOMER").alias("entity_type"), C("o_custkey").alias("entity_id"), "o_orderkey")
    known = t.customer.where("c_mktsegment <> 'BUILDING'").select(F.lit("CUSTOMER").alias("entity_type"), C("c_custkey").alias("entity_id"))
    return joins.dangling(refs, known)


@query("C16_preferred_copies", """
SELECT o_custkey, ARG_MIN(o_orderkey, o_orderpriority || lpad(CAST(o_orderkey AS VARCHAR), 12, '0')) AS o_orderkey FROM orders
WHERE o_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P' AND o_totalprice < 50000) GROUP BY 1""")
def preferred_copies(t):
    rows = t.orders.select("o_custkey", "o_orderkey", F.concat("o_orderpriority", F.lpad(C("o_orderkey").cast("string"), 12, "0")).alias("priority"))
    failed = t.orders.where("o_orderstatus = 'P' AND o_totalprice < 50000").select("o_custkey")
    return joins.preferred_copies(rows, ["o_custkey"], "priority", failed).drop("priority")


@query("A5_consolidated_slots", """
SELECT user_id, event_type AS slot, ARG_MIN(event_id, CASE WHEN value > 30 THEN 0 ELSE 1 END * 100000000000 + event_id) AS event_id FROM events GROUP BY 1, 2""")
def consolidated_slots(t):
    rows = t.events.select("user_id", C("event_type").alias("slot"), "event_id", (F.when(C("value") > 30, 0).otherwise(1).cast("long") * 100000000000 + C("event_id")).alias("priority"))
    return joins.preferred_copies(rows, ["user_id", "slot"], "priority", rows.where("user_id < 0")).drop("priority")


@query("C18_month_locations", """
SELECT o_orderkey, CASE WHEN o_orderpriority = '5-LOW' THEN 'UNSUPPORTED_METRIC' WHEN o_orderpriority = '4-NOT SPECIFIED' THEN 'SOURCE_NOT_CONFIRMED' WHEN o_orderkey % 3 = 0 THEN 'MAPPING_DRIFT' END AS location_problem FROM orders""")
def month_locations(t):
    months = t.orders.select(F.date_format("o_orderdate", "MM").alias("month")).distinct()
    column = F.chr(64 + C("month").cast("int"))
    mapping = months.select(F.explode(F.array(*[F.lit(x) for x in ("1-URGENT", "2-HIGH", "3-MEDIUM")])).alias("metric"), F.lit("2026").alias("source_tab"),
                            F.lit(7).alias("source_row"), column.alias("source_column"), "month").unionByName(
        months.select(F.lit("4-NOT SPECIFIED").alias("metric"), F.lit("2020").alias("source_tab"), F.lit(7).alias("source_row"), column.alias("source_column"), "month"))
    month = F.date_format("o_orderdate", "MM")
    rows = t.orders.select("o_orderkey", C("o_orderpriority").alias("metric"), F.lit("2026").alias("source_tab"), F.lit(7).alias("source_row"),
                           F.when(C("o_orderkey") % 3 == 0, "Z").otherwise(F.chr(64 + month.cast("int"))).alias("source_column"), month.alias("month"))
    return joins.month_locations(rows, mapping).select("o_orderkey", "location_problem")


@query("C19_brand_class", """
SELECT p_partkey, CASE WHEN p_name = 'red ring' THEN 'Company brand' WHEN p_name LIKE '%widget%' THEN 'Product brand' WHEN regexp_matches(p_name, '^(blue|green) ') THEN 'Pending review' ELSE 'Non-brand' END AS brand_class FROM part""")
def brand_class(t):
    terms = [("red ring", "Exact", "Company brand", "Approved"), ("widget", "Contains", "Product brand", "Approved"), ("^(blue|green) ", "Regex", "Pending review", "Approved"), ("bolt", "Contains", "Company brand", "Candidate")]
    dictionary = t.spark.createDataFrame(terms, "term string, rule string, class string, status string")
    return joins.brand_class(t.part.select("p_partkey", "p_name"), "p_name", dictionary).select("p_partkey", "brand_class")


@query("C20_lineage", """
SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'MISSING_CANDIDATE' WHEN o_orderkey % 7 = 0 THEN 'REVIEW_DRIFT' WHEN o_orderkey % 3 = 0 THEN 'MISSING_BRIDGE' ELSE 'OK' END AS lineage_state FROM orders""")
def lineage(t):
    key = C("o_orderkey")
    anchors = t.orders.select("o_orderkey", *[x for n in ("candidate", "review", "bridge") for x in (
        key.alias(f"{n}_id"), F.lit(1).alias(f"{n}_revision"), F.sha2(F.concat(F.lit(n), key), 256).alias(f"{n}_hash"))])

    def stored(n, keep, hash_of):
        return t.orders.where(keep).select(key.alias(f"{n}_id"), F.lit(1).alias("revision"), hash_of.alias("content_hash"))

    def true_hash(n):
        return F.sha2(F.concat(F.lit(n), key), 256)

    return joins.lineage(anchors, stored("candidate", key % 5 != 0, true_hash("candidate")),
                         stored("review", F.lit(True), F.when(key % 7 == 0, "x").otherwise(true_hash("review"))),
                         stored("bridge", key % 3 != 0, true_hash("bridge"))).select("o_orderkey", "lineage_state")


@query("C23_query_entities", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_partkey % 5 = 0 THEN 'UNRESOLVED_QUERY' WHEN l_linenumber = 1 THEN 'QUERY_TEXT_MISMATCH' WHEN l_linenumber = 2 THEN 'LOCALE_MISMATCH' END AS query_problem FROM lineitem""")
def query_entities(t):
    line = C("l_linenumber")
    seen = t.lineitem.select("l_orderkey", "l_linenumber", F.lit("QUERY").alias("query_type"), C("l_partkey").alias("query_id"),
                             F.when(line == 1, "other").otherwise(F.concat(F.lit("q"), "l_partkey")).alias("query_text"), F.when(line == 2, "en-US").otherwise("zh-TW").alias("locale"), F.lit("TW").alias("country"))
    entities = t.part.where("p_partkey % 5 <> 0").select(F.lit("QUERY").alias("entity_type"), C("p_partkey").alias("entity_id"), F.concat(F.lit("q"), "p_partkey").alias("normalized_text"),
                                                        F.lit("zh-TW").alias("locale"), F.lit("TW").alias("country"))
    return joins.query_entities(seen, entities).select("l_orderkey", "l_linenumber", "query_problem")


@query("C24_sample_scope", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 4 = 0 THEN 'UNKNOWN_SAMPLE' WHEN l_linenumber IN (1, 2) THEN 'COMPARABILITY_GAP' ELSE 'OK' END AS scope_state FROM lineitem""")
def sample_scope(t):
    fields = {f: F.lit(f"{f}-x") for f in joins.SAMPLE_SCOPE}
    line = C("l_linenumber")
    seen = t.lineitem.select("l_orderkey", "l_linenumber", C("l_suppkey").alias("sample_id"), F.lit("v1").alias("sample_version"), F.when(line == 1, 2).otherwise(1).alias("sample_revision"),
                             *[(F.when(line == 2, "moved").otherwise(v) if f == "platform" else v).alias(f) for f, v in fields.items()])
    samples = t.supplier.where("s_suppkey % 4 <> 0").select(C("s_suppkey").alias("sample_id"), F.lit("v1").alias("sample_version"), F.lit(1).alias("revision"), *[v.alias(f) for f, v in fields.items()])
    return joins.sample_scope(seen, samples).select("l_orderkey", "l_linenumber", "scope_state")


@query("C25_competitor_ids", """
SELECT l_orderkey, l_linenumber, CASE WHEN l_suppkey % 3 = 0 THEN 'COMP' || l_suppkey ELSE 'd' || l_suppkey END AS competitor_ref FROM lineitem""")
def competitor_ids(t):
    known = t.supplier.where("s_suppkey % 3 = 0").select(F.concat(F.lit("d"), "s_suppkey").alias("domain"), F.concat(F.lit("COMP"), "s_suppkey").alias("competitor_id"))
    rows = t.lineitem.select("l_orderkey", "l_linenumber", F.concat(F.lit("d"), "l_suppkey").alias("domain"))
    return joins.competitor_ids(rows, "domain", known).drop("domain")
