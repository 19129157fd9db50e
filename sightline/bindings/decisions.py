"""Opportunity rules, validation, diagnostics, outcomes and reviews over inputs derived from the given tables."""

from pyspark.sql import functions as F

from sightline.bindings.core import query
from sightline.operators.charts import rounded
from sightline.plans import diagnostics, outcomes, reports, review, rules, validate
from sightline.schemas import SOURCE_CLASS

C = F.col


def none():
    return F.lit(None).cast("string")


def empty():
    return F.array().cast("array<string>")


def joined(*columns):
    return {c: F.array_join(c, ",") for c in columns}


# --- Rules ------------------------------------------------------------------------------------------------

def bundles(t):
    """Every part is a topic under evaluation."""
    key = C("p_partkey")
    return t.part.select(
        key.alias("bundle_id"), F.concat(F.lit("P"), "p_size").alias("project_scope_id"), F.concat(F.lit("T"), key).alias("topic_id"), F.lit("INFORMATIONAL").alias("search_intent"),
        F.when(key % 10 == 9, "CONTENT_GAP").when(key % 10 == 8, "CONTENT_DECAY").alias("requested_type"), F.lit("2002-01-01T00:00:00Z").alias("decision_at"),
        F.lit("2001-12").alias("evaluation_period"), F.when(key % 4 == 3, empty()).otherwise(F.array(F.concat(F.lit("u"), key))).alias("existing_urls"),
        (key % 3 != 0).alias("mapping_confirmed"), (key % 5 != 0).alias("mapping_approved"), (key % 2 == 0).alias("alternatives_addressed"))


def evidence(t):
    """Every line item is one evidence record of its part."""
    order, line, source = C("l_orderkey"), C("l_linenumber"), C("l_suppkey") % 3
    seq = order * 10 + line
    gsc, sf = source == 1, source == 2
    window = F.struct(F.when(line == 1, "current").when(line == 2, "previous").alias("role"), C("l_shipdate").cast("date").alias("period_end"), C("l_quantity").alias("clicks"),
                      F.floor(C("l_extendedprice") / 20).cast("double").alias("impressions"), C("l_discount").alias("ctr"), (C("l_tax") * 10).alias("position"))
    issue = F.struct(F.when(line % 2 == 0, "TITLE").otherwise("H1").alias("type"), F.when(C("l_quantity") > 49, "HIGH").otherwise("LOW").alias("severity"))
    return t.lineitem.select(
        C("l_partkey").alias("bundle_id"), seq.alias("seq"), seq.cast("string").alias("evidence_id"), F.lit(1).alias("revision"), F.md5(seq.cast("string")).alias("content_hash"),
        F.when(source == 0, "AHREFS").when(gsc, "GSC").otherwise("SF").alias("source"), F.when(order % 7 != 0, F.concat(F.lit("T"), "l_partkey")).alias("topic_id"), empty().alias("topic_refs"),
        F.when(order % 11 == 0, F.array(F.lit("other"))).when(order % 11 < 6, F.array(F.concat(F.lit("u"), "l_partkey"))).otherwise(empty()).alias("urls"),
        F.when(order % 37 == 0, "STALE").otherwise("READY").alias("freshness_state"), F.lit("SUCCESS").alias("collection_status"), (order % 41 == 0).alias("conflict"),
        F.when((source == 0) & (line != 7), C("l_extendedprice") / 30).alias("volume"), F.when(gsc, F.floor(C("l_extendedprice") / 20)).cast("double").alias("impressions"),
        F.when(gsc, C("l_quantity")).alias("position"), F.when(gsc & (line != 3), C("l_discount")).alias("ctr"), F.lit("COMPLETE_WITHIN_SCOPE").alias("coverage"),
        F.when(line % 2 == 0, line % 5).alias("attainability_band"), F.when(sf & (line % 3 == 0), 2).alias("execution_band"),
        F.when(sf, F.array(issue)).otherwise(F.array().cast("array<struct<type:string,severity:string>>")).alias("issues"),
        F.when(gsc, F.array(window)).otherwise(F.array().cast("array<struct<role:string,period_end:date,clicks:double,impressions:double,ctr:double,position:double>>")).alias("windows"))


RULE_SQL = """
b AS (SELECT p_partkey AS bundle_id, p_size, CASE WHEN p_partkey % 10 = 9 THEN 'CONTENT_GAP' WHEN p_partkey % 10 = 8 THEN 'CONTENT_DECAY' END AS requested,
  p_partkey % 4 <> 3 AS has_url, p_partkey % 3 <> 0 AS confirmed, p_partkey % 5 <> 0 AS approved, p_partkey % 2 = 0 AS alternatives FROM part),
e AS (SELECT l.l_partkey AS bundle_id, l_orderkey * 10 + l_linenumber AS seq, CASE l_suppkey % 3 WHEN 0 THEN 'AHREFS' WHEN 1 THEN 'GSC' ELSE 'SF' END AS source,
  NOT has_url OR l_orderkey % 11 <> 0 AS on_url, l_orderkey % 37 <> 0 AS fresh, l_orderkey % 41 = 0 AS conflicting, l_suppkey % 3 = 2 AND l_quantity > 49 AS severe,
  l_suppkey % 3 = 2 AND l_linenumber % 2 = 0 AS snippet, CASE WHEN l_suppkey % 3 = 0 AND l_linenumber <> 7 THEN l_extendedprice / 30 END AS volume, floor(l_extendedprice / 20) AS impressions,
  l_quantity AS position, CASE WHEN l_linenumber <> 3 THEN l_discount END AS ctr, l_linenumber AS line, l_discount, l_tax, l_quantity, l_shipdate FROM lineitem l JOIN b ON b.bundle_id = l.l_partkey),
w AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY bundle_id ORDER BY CAST(l_shipdate AS DATE) DESC, seq DESC) AS rn FROM e WHERE on_url AND source = 'GSC'),
h AS (SELECT bundle_id, COUNT(*) AS n_windows, AVG(l_quantity) FILTER (rn <= 2) AS recent, AVG(l_quantity) FILTER (rn IN (3, 4)) AS baseline,
  ARG_MIN(impressions, seq) FILTER (line = 1) AS now_i, ARG_MIN(l_discount, seq) FILTER (line = 1) AS now_c, ARG_MIN(l_tax * 10, seq) FILTER (line = 1) AS now_p,
  ARG_MIN(l_discount, seq) FILTER (line = 2) AS old_c, ARG_MIN(l_tax * 10, seq) FILTER (line = 2) AS old_p FROM w GROUP BY 1),
a AS (SELECT bundle_id, COUNT(*) FILTER (on_url AND source = 'SF') AS n_sf, COUNT(*) FILTER (on_url AND source = 'AHREFS') AS n_ahrefs, COUNT(*) FILTER (on_url AND source = 'GSC') AS n_gsc,
  COUNT(*) FILTER (on_url AND severe) AS n_severe, COUNT(*) FILTER (on_url AND snippet) AS n_snippet, COUNT(*) FILTER (on_url AND NOT fresh) AS n_not_fresh, COUNT(*) FILTER (fresh) AS n_fresh,
  ARG_MIN(volume, seq) FILTER (on_url AND volume IS NOT NULL) AS volume, ARG_MIN(impressions, seq) FILTER (on_url AND source = 'GSC') AS s_i, ARG_MIN(position, seq) FILTER (on_url AND source = 'GSC') AS s_p,
  MIN(seq) FILTER (on_url AND source = 'GSC') AS s_seq, MIN(seq) FILTER (on_url AND source = 'GSC' AND ctr IS NOT NULL) AS c_seq,
  ARG_MIN(line % 5, seq) FILTER (line % 2 = 0) AS attainability, MIN(CASE WHEN on_url AND source = 'SF' AND line % 3 = 0 THEN 2 END) AS execution FROM e GROUP BY 1),
i AS (SELECT b.*, coalesce(n_sf, 0) AS n_sf, coalesce(n_ahrefs, 0) AS n_ahrefs, coalesce(n_gsc, 0) AS n_gsc, coalesce(n_severe, 0) AS n_severe, coalesce(n_snippet, 0) AS n_snippet,
  coalesce(n_not_fresh, 0) AS n_not_fresh, coalesce(n_fresh, 0) AS n_fresh, volume, s_i, s_p, coalesce(s_seq = c_seq, FALSE) AS s_ctr, attainability, execution, coalesce(n_windows, 0) AS n_windows,
  recent, baseline, now_i, now_c, now_p, old_c, old_p FROM b LEFT JOIN a ON a.bundle_id = b.bundle_id LEFT JOIN h ON h.bundle_id = b.bundle_id),
r AS (SELECT *, n_severe > 0 AS tech, coalesce(n_gsc > 0 AND n_snippet > 0 AND now_i >= 500 AND abs(now_p - old_p) <= 1 AND old_c > 0 AND now_c <= old_c * 0.8::DOUBLE, FALSE) AS ctr,
  n_windows > 0 AND n_windows < 6 AS short, coalesce(n_windows >= 6 AND baseline > 0 AND recent <= baseline * 0.8::DOUBLE, FALSE) AS decays, n_ahrefs > 0 AND n_gsc > 0 AND has_url AS quick FROM i),
d AS (SELECT *, CASE WHEN requested = 'CONTENT_GAP' THEN 'GAP' WHEN requested IS NULL AND tech AND n_ahrefs + n_gsc = 0 THEN 'TECH_WATCH' WHEN requested IS NULL AND tech THEN 'TECH'
  WHEN requested IS NULL AND ctr THEN 'CTR' WHEN short THEN 'DECAY_SHORT' WHEN decays THEN 'DECAY' WHEN requested IS NULL AND quick THEN 'QUICK' WHEN requested IS NOT NULL THEN 'ASKED'
  WHEN n_fresh = 0 THEN 'STALE' ELSE 'NOTHING' END AS k FROM r),
m AS (SELECT *, CASE k WHEN 'GAP' THEN 'CONTENT_GAP' WHEN 'TECH' THEN 'TECHNICAL_UNLOCK' WHEN 'CTR' THEN 'CTR_OPPORTUNITY' WHEN 'DECAY' THEN 'CONTENT_DECAY' WHEN 'DECAY_SHORT' THEN 'CONTENT_DECAY'
    WHEN 'QUICK' THEN 'QUICK_WIN' WHEN 'ASKED' THEN requested ELSE 'DO_NOTHING' END AS opportunity_type,
  CASE k WHEN 'GAP' THEN 'CREATE_NEW' WHEN 'TECH' THEN 'TECHNICAL_FIX' WHEN 'CTR' THEN 'SERP_SNIPPET_OPTIMIZE' WHEN 'DECAY' THEN 'UPDATE_EXISTING' WHEN 'QUICK' THEN 'UPDATE_EXISTING' WHEN 'NOTHING' THEN 'DO_NOTHING' ELSE 'MONITOR' END AS recommended_action,
  array_to_string(list_sort(list_filter(CASE k WHEN 'GAP' THEN ['competitor', 'inventory'] WHEN 'TECH_WATCH' THEN ['demand'] WHEN 'TECH' THEN [CASE WHEN n_not_fresh > 0 THEN 'freshness' END]
    WHEN 'DECAY_SHORT' THEN ['historical_traction'] WHEN 'QUICK' THEN ['intent', CASE WHEN volume IS NULL THEN 'demand' END, CASE WHEN n_sf = 0 THEN 'technical' END, CASE WHEN NOT (confirmed AND approved) THEN 'mapping_review' END]
    WHEN 'ASKED' THEN ['required_evidence'] WHEN 'STALE' THEN ['required_evidence'] ELSE [] END, lambda x: x IS NOT NULL)), ',') AS missing FROM d)"""


def inputs(t):
    return rules.inputs_of(bundles(t), evidence(t))


def one_rule(name, rule, condition):
    @query(name, f"WITH {RULE_SQL} SELECT bundle_id FROM r WHERE {condition}")
    def build(t):
        kind = {"K1_technical_unlock": "TECHNICAL_UNLOCK", "K2_ctr_opportunity": "CTR_OPPORTUNITY", "K3_content_decay": "CONTENT_DECAY", "K4_quick_win": "QUICK_WIN"}[name]
        return inputs(t).withColumn("r", rule()).where(C("r.opportunity_type") == kind).select("bundle_id")
    return build


one_rule("K1_technical_unlock", rules.technical_unlock, "tech AND n_ahrefs + n_gsc > 0")
one_rule("K2_ctr_opportunity", rules.ctr_opportunity, "ctr")
one_rule("K3_content_decay", rules.content_decay, "short OR decays")
one_rule("K4_quick_win", rules.quick_win, "quick")


def decided(t):
    return rules.evaluate(inputs(t))


@query("K5_content_gap", f"WITH {RULE_SQL} SELECT bundle_id, 'AHREFS_CONTENT_GAP_UNAVAILABLE,DERIVED_COMPETITIVE_GAP_POLICY_UNAPPROVED' AS policy_gaps FROM m WHERE k = 'GAP'")
def content_gap(t):
    return decided(t).where(F.size("policy_gaps") > 0).withColumns(joined("policy_gaps")).select("bundle_id", "policy_gaps")


@query("K6_decisions", f"""
WITH {RULE_SQL} SELECT bundle_id, opportunity_type, recommended_action, missing AS missing_roles,
  CASE WHEN recommended_action IN ('MONITOR', 'DO_NOTHING') THEN DATE '2002-01-29' END AS review_at FROM m""")
def decisions(t):
    return decided(t).withColumns(joined("missing_roles")).select("bundle_id", "opportunity_type", "recommended_action", "missing_roles", "review_at")


SCORE_SQL = """
s AS (SELECT *, CASE WHEN volume <= 0 THEN 0 WHEN volume < 100 THEN 1 WHEN volume < 500 THEN 2 WHEN volume < 2000 THEN 3 WHEN volume IS NOT NULL THEN 4 END AS demand,
  CASE WHEN s_i IS NULL OR s_i BETWEEN 1 AND 99 THEN NULL WHEN s_i = 0 THEN 0 WHEN s_p BETWEEN 4 AND 15 THEN 4 WHEN s_p <= 3 THEN CASE WHEN s_ctr THEN 3 ELSE 0 END WHEN s_p <= 20 THEN 3 WHEN s_p <= 40 THEN 2 ELSE 1 END AS traction FROM m WHERE k <> 'GAP'),
p AS (SELECT *, (coalesce(20 * demand, 0) + coalesce(15 * traction, 0) + coalesce(20 * attainability, 0) + coalesce(15 * execution, 0)) / 4.0 AS obs,
  30 + CASE WHEN demand IS NULL THEN 20 ELSE 0 END + CASE WHEN traction IS NULL THEN 15 ELSE 0 END + CASE WHEN attainability IS NULL THEN 20 ELSE 0 END + CASE WHEN execution IS NULL THEN 15 ELSE 0 END AS open FROM s)"""


@query("K7_score", f"""
WITH {RULE_SQL}, {SCORE_SQL} SELECT bundle_id, demand AS demand_score, traction AS traction_score, CAST(floor(obs) AS BIGINT) AS score_lower_bound, CAST(ceil(obs + open) AS BIGINT) AS score_upper_bound,
  CAST(NULL AS BIGINT) AS opportunity_score FROM p""")
def score(t):
    scored = rules.candidate_score(decided(t).where(F.size("policy_gaps") == 0))
    return scored.select("bundle_id", "demand_score", "traction_score", "score_lower_bound", "score_upper_bound", "opportunity_score")


@query("K7_full_score", """
SELECT o_orderkey, CASE o_orderkey % 3 WHEN 0 THEN CAST(floor((20 * a + 15 * b + 30 * c + 20 * a + 15 * b) / 4.0 + 0.5) AS BIGINT) WHEN 1 THEN CAST(floor((25 * a + 30 * c + 25 * a + 20 * b) / 4.0 + 0.5) AS BIGINT)
  ELSE CAST(floor((10 * a + 5 * b + 30 * c + 15 * a + 30 * b + 10 * b) / 4.0 + 0.5) AS BIGINT) END AS opportunity_score
FROM (SELECT o_orderkey, o_custkey % 5 AS a, o_orderkey % 5 AS b, (o_custkey + o_orderkey) % 5 AS c FROM orders)""")
def full_score(t):
    a, b, c = C("o_custkey") % 5, C("o_orderkey") % 5, (C("o_custkey") + C("o_orderkey")) % 5
    profile = F.when(C("o_orderkey") % 3 == 0, "existing").when(C("o_orderkey") % 3 == 1, "new").otherwise("geo")
    scored = rules.score(t.orders, profile, {"demand": a, "traction": b, "business": c, "attainability": a, "geo": b, "execution": b})
    return scored.select("o_orderkey", "opportunity_score")


SUPPORT_SQL = """
u AS (SELECT p.bundle_id, COUNT(e.seq) AS evidence_count, COUNT(DISTINCT e.source) AS families, COUNT(e.seq) FILTER (NOT fresh) AS stale, COUNT(e.seq) FILTER (conflicting) AS conflicts
  FROM p LEFT JOIN e ON e.bundle_id = p.bundle_id AND CASE k WHEN 'TECH_WATCH' THEN on_url AND source = 'SF' WHEN 'TECH' THEN on_url WHEN 'QUICK' THEN on_url WHEN 'CTR' THEN on_url AND (source = 'GSC' OR snippet)
    WHEN 'DECAY' THEN on_url AND source IN ('GSC', 'SF') WHEN 'DECAY_SHORT' THEN on_url AND source IN ('GSC', 'SF') WHEN 'STALE' THEN TRUE WHEN 'NOTHING' THEN fresh ELSE FALSE END GROUP BY 1),
v AS (SELECT p.*, evidence_count, families, stale, conflicts, conflicts = 0 AND (stale > 0 OR missing <> '' OR families < 2 OR NOT confirmed) AS weak FROM p JOIN u ON u.bundle_id = p.bundle_id)"""


@query("K8_confidence", f"""
WITH {RULE_SQL}, {SCORE_SQL}, {SUPPORT_SQL} SELECT bundle_id, evidence_count, families AS independent_family_count, CASE WHEN conflicts > 0 OR weak THEN 'LOW' WHEN alternatives AND approved THEN 'HIGH' ELSE 'MEDIUM' END AS confidence,
  CASE WHEN conflicts > 0 THEN 'CONFLICTING_EVIDENCE' WHEN weak THEN 'INSUFFICIENT_EVIDENCE' ELSE 'PASS' END AS validation_state FROM v""")
def confidence(t):
    return rules.candidates(bundles(t), evidence(t)).select("bundle_id", "evidence_count", "independent_family_count", "confidence", "validation_state")


@query("K9_candidates", f"""
WITH {RULE_SQL}, {SCORE_SQL}, {SUPPORT_SQL},
z AS (SELECT *, CASE WHEN recommended_action = 'DO_NOTHING' AND (stale > 0 OR missing <> '' OR weak) THEN 'MONITOR' ELSE recommended_action END AS final FROM v)
SELECT bundle_id, 'OPP_' || substr(sha256('{{"primary_action":"' || recommended_action || '","primary_intent":"INFORMATIONAL","project_scope_id":"P' || p_size || '","target_asset_key":"' ||
  CASE WHEN has_url THEN 'u' || bundle_id ELSE 'T' || bundle_id END || '","topic_cluster_id":"T' || bundle_id || '"}}'), 1, 24) AS candidate_id,
  final AS recommended_action, CASE WHEN families >= 2 THEN 'CANDIDATE' ELSE 'DISCOVERED' END AS status, CASE WHEN bundle_id % 2 = 0 THEN 5 ELSE 6 END::BIGINT AS revision FROM z""")
def candidates(t):
    first = rules.candidates(bundles(t), evidence(t)).select("bundle_id", "candidate_id", "input_signature")
    stored = first.select("candidate_id", F.lit(5).cast("long").alias("revision"), F.when(C("bundle_id") % 2 == 0, C("input_signature")).otherwise("older").alias("input_signature"))
    return rules.candidates(bundles(t), evidence(t), stored).select("bundle_id", "candidate_id", "recommended_action", "status", "revision")


# --- Validation -------------------------------------------------------------------------------------------

VALID_SQL = """
x AS (SELECT l_orderkey AS k, COUNT(*) AS cites, COUNT(*) FILTER (l_linenumber <> 7) AS resolved, COUNT(DISTINCT CASE WHEN l_linenumber <> 7 THEN l_suppkey % 3 END) AS families,
  coalesce(bool_or(l_linenumber <> 7 AND l_tax = 0.08), FALSE) AS stale, coalesce(bool_or(l_linenumber <> 7 AND l_tax = 0.07), FALSE) AS conflict, coalesce(bool_or(l_linenumber <> 7 AND l_suppkey % 3 = 0), FALSE) AS demand,
  coalesce(bool_or(l_linenumber <> 7 AND l_suppkey % 3 = 1), FALSE) AS traction FROM (SELECT DISTINCT l_orderkey, l_linenumber, MAX(l_tax) AS l_tax, MAX(l_suppkey) AS l_suppkey FROM lineitem GROUP BY 1, 2) GROUP BY 1)"""


def citations(t):
    once = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_tax").alias("l_tax"), F.max("l_suppkey").alias("l_suppkey"))
    name = F.concat_ws("-", "l_orderkey", "l_linenumber")
    source = C("l_suppkey") % 3
    cites = once.select(C("l_orderkey").cast("string").alias("candidate_id"), F.lit(1).alias("revision"), name.alias("evidence_id"))
    context = once.where("l_linenumber <> 7").select(
        name.alias("evidence_id"), F.when(source == 0, "AHREFS").when(source == 1, "GSC").otherwise("SF").alias("source"),
        F.when(source == 0, SOURCE_CLASS["AHREFS"]).when(source == 1, SOURCE_CLASS["GSC"]).otherwise(SOURCE_CLASS["SF"]).alias("source_class"),
        F.when(source == 0, F.array(F.lit("demand"))).when(source == 1, F.array(F.lit("traction"))).otherwise(F.array(F.lit("technical"))).alias("roles"),
        F.when(C("l_tax") == 0.08, "STALE").otherwise("FRESH").alias("freshness_state"), F.lit("READY").alias("collection_status"), F.lit("2001-12-30").cast("date").alias("as_of"), (C("l_tax") == 0.07).alias("conflict"))
    return cites, context


EXPLAINED_SQL = """
g AS (SELECT l_orderkey AS k, bool_or(l_linenumber % 4 <> 0 AND ref) AS supported, bool_or(l_linenumber % 4 <> 0 AND ref AND l_linenumber IN (5, 7)) AS astray
  FROM (SELECT *, l_linenumber <> 1 OR l_orderkey % 3 <> 0 AS ref FROM lineitem WHERE l_linenumber NOT IN (2, 6)) GROUP BY 1)"""


@query("K10_validate", f"""
WITH {VALID_SQL}, o AS (SELECT o_orderkey AS k, o_orderkey % 4 = 0 AS settled, o_orderkey % 5 = 0 AS wrong, coalesce(cites, 0) AS cites, coalesce(resolved, 0) AS resolved, coalesce(families, 0) AS families,
  coalesce(stale, FALSE) AS stale, coalesce(conflict, FALSE) AS conflict, coalesce(demand, FALSE) AS demand, coalesce(traction, FALSE) AS traction FROM orders LEFT JOIN x ON x.k = o_orderkey)
SELECT k AS candidate, array_to_string(list_filter([CASE WHEN cites > resolved THEN 'EVIDENCE_REF_MISSING' END, CASE WHEN conflict THEN 'EVIDENCE_CONFLICT' END, CASE WHEN stale AND settled THEN 'STALE_EVIDENCE_POLICY_VIOLATION' END,
  CASE WHEN resolved <> 4 THEN 'EVIDENCE_COUNT_MISMATCH' END, CASE WHEN families <> 3 THEN 'EVIDENCE_FAMILY_COUNT_MISMATCH' END, CASE WHEN NOT demand THEN 'MISSING_REQUIRED_EVIDENCE:role' END, CASE WHEN traction THEN 'EVIDENCE_STATE_CONFLICT' END,
  CASE WHEN NOT demand THEN 'MISSING_DATA_NOT_ZERO:demand' END, CASE WHEN wrong THEN 'SCORE_MISMATCH:lower' END, CASE WHEN families < 2 THEN 'MISSING_REQUIRED_EVIDENCE:families' END, CASE WHEN settled THEN 'MISSING_REQUIRED_EVIDENCE:open' END,
  CASE WHEN settled THEN 'INVALID_VALIDATION_STATE' END, CASE WHEN settled THEN 'CONFIDENCE_EVIDENCE_MISMATCH:settled' END, CASE WHEN conflict THEN 'EVIDENCE_CONFLICT:state' END], lambda e: e IS NOT NULL), ',') AS errors,
  stale AND NOT settled AS warned FROM o""")
def validated(t):
    return validated_with(t).select("candidate", F.array_join("errors", ",").alias("errors"), (F.size("warnings") > 0).alias("warned"))


@query("K10_score_evidence", f"""
WITH {EXPLAINED_SQL} SELECT o_orderkey AS candidate, array_to_string(list_filter([CASE WHEN NOT coalesce(supported, FALSE) THEN 'MISSING_SCORE_EVIDENCE:demand' END, CASE WHEN astray THEN 'EVIDENCE_REF_MISSING:demand' END], lambda e: e IS NOT NULL), ',') AS errors
FROM orders LEFT JOIN g ON g.k = o_orderkey""")
def score_evidence(t):
    """Each order's first lines explain its demand band; every fourth line says nothing, the seventh is no evidence."""
    line = C("l_linenumber")
    said = t.lineitem.where("l_linenumber <> 2").select(
        C("l_orderkey").cast("string").alias("candidate_id"), F.lit(1).alias("revision"), F.when(line == 6, "traction").otherwise("demand").alias("dimension"),
        F.when(line % 4 == 0, " ").otherwise("because").alias("rationale"),
        F.when(line == 5, F.concat_ws("-", F.lit("other"), "l_orderkey")).when((line != 1) | (C("l_orderkey") % 3 != 0), F.concat_ws("-", "l_orderkey", "l_linenumber")).alias("evidence_id"))
    out = validated_with(t, said).withColumn("errors", F.filter("errors", lambda e: e.rlike("^(MISSING_SCORE_EVIDENCE|EVIDENCE_REF_MISSING):")))
    return out.select("candidate", F.array_join("errors", ",").alias("errors"))


def validated_with(t, explanations=None):
    cites, context = citations(t)
    key, absent = C("o_orderkey"), F.lit(None).cast("int")
    proposals = t.orders.select(
        key.alias("candidate"), key.cast("string").alias("candidate_id"), F.lit(1).alias("revision"), none().cast("int").alias("supersedes_revision"), F.lit("2001-12").alias("period"), F.lit("h").alias("content_hash"), F.lit("h").alias("expected_hash"),
        F.lit("2001-12-30").alias("created_at"), F.lit("2001-12-31").alias("updated_at"), F.when(key % 4 == 0, "VALIDATED").otherwise("CANDIDATE").alias("status"), F.lit("UPDATE_EXISTING").alias("recommended_action"),
        F.array(F.lit("u")).alias("existing_urls"), F.lit("u").alias("target_url"), F.array(F.lit("demand")).alias("required_roles"), F.array(F.lit("traction")).alias("missing_roles"), F.lit(False).alias("declares_conflict"),
        F.lit(4).alias("evidence_count"), F.lit(3).alias("independent_family_count"), F.lit("existing").alias("score_profile"), F.lit(2).alias("demand_score"), *[absent.alias(f"{d}_score") for d in ("traction", "business", "attainability", "geo", "execution")],
        F.when(key % 5 == 0, 11).otherwise(10).alias("score_lower_bound"), F.lit(90).alias("score_upper_bound"), absent.alias("opportunity_score"), F.lit("LOW").alias("confidence"), F.lit("INSUFFICIENT_EVIDENCE").alias("validation_state"),
        F.lit("2002-01-28").alias("review_at"), none().alias("measurement_plan_ref"), F.lit(True).alias("mapping_confirmed"), F.lit(True).alias("alternatives_addressed"), F.lit(False).alias("business_overlay_approved"),
        F.lit(False).alias("review_authenticated"), none().alias("review_decision"), absent.alias("reviewed_revision"), none().alias("reviewed_hash"), F.lit(False).alias("scope_approved"))
    return validate.validate(proposals, cites, context, "2001-12-31", explanations)


# --- Diagnostics ------------------------------------------------------------------------------------------

def behaviour_of(t, **more):
    kind = C("event_type")
    daily = t.events.groupBy("user_id", "event_type", F.to_date("ts").alias("day")).agg(F.max("value").alias("value"))
    rows = daily.select(
        C("user_id").alias("candidate_id"), F.lit("GA4").alias("source"), F.lit(SOURCE_CLASS["GA4"]).alias("source_class"), F.lit("URL_1").alias("url_id"), F.lit("https://a.example/").alias("normalized_url"),
        F.when(kind == "error", "Direct").otherwise("Organic Search").alias("channel"), F.when(kind == "view", "sessions").when(kind == "click", "engagement_rate").when(kind == "purchase", "event_count").otherwise("users").alias("metric"),
        "value", C("day").alias("period_end"), C("day").alias("as_of"), F.lit("READY").alias("freshness_state"), F.lit("SUCCESS").alias("collection_status"), F.lit("CTA_INTERACTION").alias("event_classification"))
    targets = t.events.select(C("user_id").alias("candidate_id")).distinct().select(
        "candidate_id", F.lit("URL_1").alias("url_id"), F.lit("Organic Search").alias("expected_channel"), F.lit("PAGE_LEVEL").alias("quality_scope"), F.lit("2024-01-31").cast("date").alias("decision_day"),
        F.lit(2.0).alias("gsc_current"), F.lit(1.0).alias("gsc_previous"))
    return diagnostics.behaviour(targets.withColumns(more) if more else targets, rows)


@query("K11_behaviour", """
WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, MAX(value) AS v FROM events GROUP BY 1, 2, 3),
j AS (SELECT *, event_type = 'error' AS wrong, d BETWEEN DATE '2024-01-24' AND DATE '2024-01-31' AS fresh, CASE event_type WHEN 'view' THEN 'sessions' WHEN 'click' THEN 'engagement_rate' WHEN 'purchase' THEN 'event_count' ELSE 'users' END AS m FROM e),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, m ORDER BY d DESC) AS rn FROM j WHERE NOT wrong AND fresh),
f AS (SELECT user_id, COUNT(*) FILTER (NOT wrong) AS accepted, COUNT(*) FILTER (NOT wrong AND fresh) AS cur, coalesce(bool_or(NOT wrong AND NOT fresh), FALSE) AS stale, coalesce(bool_or(wrong), FALSE) AS wrong FROM j GROUP BY 1),
t AS (SELECT user_id, m, CASE WHEN COUNT(*) < 2 THEN 'INSUFFICIENT_HISTORY' WHEN MAX(v) FILTER (rn = 1) > MAX(v) FILTER (rn = 2) THEN 'INCREASING' WHEN MAX(v) FILTER (rn = 1) < MAX(v) FILTER (rn = 2) THEN 'DECLINING' ELSE 'STABLE' END AS s FROM n GROUP BY 1, 2)
SELECT f.user_id AS candidate_id, coalesce(a.s, 'INSUFFICIENT_HISTORY') AS traffic_signal, coalesce(b.s, 'INSUFFICIENT_HISTORY') AS engagement_signal,
  array_to_string(list_filter([CASE WHEN stale THEN 'fresh_current_ga4_evidence' END, CASE WHEN b.s IS NULL THEN 'engagement_rate' END, CASE WHEN accepted = 0 THEN 'page_level_organic_ga4_evidence' END, CASE WHEN a.s IS NULL THEN 'sessions' END].list_sort(), lambda x: x IS NOT NULL), ',') AS missing,
  CASE WHEN wrong OR a.s IN ('DECLINING', 'STABLE') THEN 'CONFLICTING_GA4_EVIDENCE' WHEN stale OR b.s IS NULL OR accepted = 0 OR a.s IS NULL OR cur = 0 THEN 'INSUFFICIENT_GA4_EVIDENCE' WHEN b.s = 'DECLINING' THEN 'QUALITY_MIXED' ELSE 'QUALITY_HEALTHY' END AS status
FROM f LEFT JOIN t a ON a.user_id = f.user_id AND a.m = 'sessions' LEFT JOIN t b ON b.user_id = f.user_id AND b.m = 'engagement_rate'""")
def behaviour(t):
    return behaviour_of(t).withColumns(joined("missing")).select("candidate_id", "traffic_signal", "engagement_signal", "missing", "status")


@query("K11_types", """
WITH e AS (SELECT user_id, event_type, CAST(ts AS DATE) AS d, MAX(value) AS v FROM events GROUP BY 1, 2, 3),
j AS (SELECT *, event_type = 'error' AS wrong, d BETWEEN DATE '2024-01-24' AND DATE '2024-01-31' AS fresh, CASE event_type WHEN 'view' THEN 'sessions' WHEN 'click' THEN 'engagement_rate' WHEN 'purchase' THEN 'event_count' ELSE 'users' END AS m FROM e),
n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY user_id, m ORDER BY d DESC) AS rn FROM j WHERE NOT wrong AND fresh),
f AS (SELECT user_id, COUNT(*) FILTER (NOT wrong) AS accepted, COUNT(*) FILTER (NOT wrong AND fresh) AS cur, coalesce(bool_or(NOT wrong AND NOT fresh), FALSE) AS stale, coalesce(bool_or(wrong), FALSE) AS wrong FROM j GROUP BY 1),
t AS (SELECT user_id, m, CASE WHEN COUNT(*) < 2 THEN 'INSUFFICIENT_HISTORY' WHEN MAX(v) FILTER (rn = 1) > MAX(v) FILTER (rn = 2) THEN 'INCREASING' WHEN MAX(v) FILTER (rn = 1) < MAX(v) FILTER (rn = 2) THEN 'DECLINING' ELSE 'STABLE' END AS s FROM n GROUP BY 1, 2),
s AS (SELECT f.user_id, f.user_id % 6 = 0 AS external, a.s AS traffic, b.s AS engagement, g.s IS NOT NULL OR EXISTS (SELECT 1 FROM n WHERE n.user_id = f.user_id AND n.m = 'event_count') AS cta,
  CASE WHEN wrong OR a.s IN ('DECLINING', 'STABLE') THEN 'CONFLICTING_GA4_EVIDENCE' WHEN stale OR b.s IS NULL OR accepted = 0 OR a.s IS NULL OR cur = 0 THEN 'INSUFFICIENT_GA4_EVIDENCE' WHEN b.s = 'DECLINING' THEN 'QUALITY_MIXED' ELSE 'QUALITY_HEALTHY' END AS status FROM f LEFT JOIN t a ON a.user_id = f.user_id AND a.m = 'sessions' LEFT JOIN t b ON b.user_id = f.user_id AND b.m = 'engagement_rate' LEFT JOIN t g ON g.user_id = f.user_id AND g.m = 'event_count'),
v AS (SELECT user_id, external, traffic, engagement, cta, CASE WHEN external THEN 'CONFLICTING_GA4_EVIDENCE' ELSE status END AS status, (SELECT SUM(v) FROM n WHERE n.user_id = s.user_id AND n.m = 'event_count') AS events FROM s)
SELECT user_id AS candidate_id, external AS unresolved, array_to_string(list_sort(list_filter([status, CASE WHEN traffic = 'DECLINING' THEN 'TRAFFIC_DECLINING' END, CASE WHEN engagement = 'DECLINING' THEN 'ENGAGEMENT_DECLINING' END,
  CASE WHEN engagement = 'STABLE' THEN 'ENGAGEMENT_STABLE' END, CASE WHEN cta AND events > 0 THEN 'CTA_SIGNAL_PRESENT' WHEN cta THEN 'CTA_SIGNAL_WEAK' END], lambda x: x IS NOT NULL)), ',') AS types FROM v""")
def behaviour_types(t):
    out = behaviour_of(t, external_figures=C("candidate_id") % 6 == 0)
    return out.select("candidate_id", F.array_contains("conflicts", "AI_ASSISTANT_ATTRIBUTION_UNRESOLVED").alias("unresolved"), F.array_join("types", ",").alias("types"))


@query("K12_result_page", """
WITH s AS (SELECT o_custkey AS c, o_orderkey AS k, o_orderkey % 10 <= 7 AS fresh, o_orderkey % 9 <> 0 AS scoped FROM orders),
l AS (SELECT c, bool_or(NOT fresh) AS stale, bool_or(fresh AND NOT scoped) AS out_scope, MAX(k) FILTER (fresh AND scoped) AS k FROM s GROUP BY 1),
y AS (SELECT l_orderkey AS k, CASE WHEN l_suppkey % 3 = 0 THEN 'informational_article' WHEN l_suppkey % 3 = 1 THEN 'category_product' ELSE 'unknown' END AS kind, l_suppkey % 10 = 0 AS owned, l_suppkey % 10 BETWEEN 1 AND 8 AS rival FROM lineitem),
g AS (SELECT k, COUNT(*) AS n, COUNT(*) FILTER (owned) AS owned, COUNT(*) FILTER (rival) AS rivals, bool_or(NOT owned AND NOT rival) AS unknown FROM y GROUP BY 1),
d AS (SELECT k, kind, COUNT(*) AS n, ROW_NUMBER() OVER (PARTITION BY k ORDER BY COUNT(*) DESC, kind) AS rn, COUNT(*) OVER (PARTITION BY k) AS kinds, SUM(COUNT(*)) OVER (PARTITION BY k) AS total FROM y GROUP BY 1, 2),
p AS (SELECT k, CASE WHEN kinds > 1 AND n / total < 0.6 THEN 'MIXED' ELSE kind END AS kind FROM d WHERE rn = 1),
v AS (SELECT c_custkey AS c, c_custkey % 7 = 0 AS unknown_query, stale, out_scope, l.k, g.n, g.owned, g.rivals, g.unknown, p.kind FROM customer LEFT JOIN l ON l.c = c_custkey LEFT JOIN g ON g.k = l.k LEFT JOIN p ON p.k = l.k),
w AS (SELECT *, list_filter([CASE WHEN n IS NOT NULL AND owned = 0 AND rivals > 0 THEN 'COMPETITOR_DOMINANCE' END, CASE WHEN n IS NULL THEN 'INSUFFICIENT_SERP_EVIDENCE' END, CASE WHEN n IS NOT NULL AND kind <> 'informational_article' THEN 'PAGE_TYPE_MISMATCH' END,
  CASE WHEN unknown_query THEN 'QUERY_NOT_APPROVED' END, CASE WHEN coalesce(out_scope, FALSE) THEN 'QUERY_SCOPE_MISMATCH' END, CASE WHEN coalesce(stale, FALSE) THEN 'STALE_SERP_EVIDENCE' END, CASE WHEN coalesce(unknown, FALSE) THEN 'UNKNOWN_COMPETITOR_DOMAIN' END], lambda e: e IS NOT NULL) AS conflicts FROM v)
SELECT c AS candidate_id, array_to_string(conflicts, ',') AS conflicts, kind AS observed_page_type, CASE WHEN unknown_query OR coalesce(out_scope, FALSE) OR (n IS NULL AND k IS NULL) THEN 'SERP_NOT_CHECKED' WHEN len(conflicts) > 0 THEN 'SERP_CONFLICT' ELSE 'SERP_VALIDATED' END AS status FROM w""")
def result_page(t):
    day = F.lit("2001-12-31").cast("date")
    key, supp = C("o_orderkey"), C("l_suppkey")
    checks = t.customer.select(C("c_custkey").alias("candidate_id"), F.lit("Q").alias("query_id"), F.when(C("c_custkey") % 7 == 0, "UNRESOLVED_QUERY").alias("query_problem"), F.lit(True).alias("target_known"), F.lit(True).alias("target_matches"),
                               F.lit("informational_article").alias("expected_page_type"), F.lit("UNKNOWN").alias("expected_intent"), day.alias("decision_day"))
    snapshots = t.orders.select(C("o_custkey").alias("candidate_id"), key.alias("seq"), key.alias("snapshot_id"), (key % 9 != 0).alias("scope_ok"), F.lit("READY").alias("freshness_state"), F.lit("SUCCESS").alias("collection_status"),
                                F.date_sub(day, (key % 10).cast("int")).alias("as_of"), F.create_map().cast("map<string,string>").alias("features"))
    results = t.lineitem.select(C("l_orderkey").alias("snapshot_id"), F.when(supp % 3 == 0, "article").when(supp % 3 == 1, "product").otherwise("other").alias("result_type"), (supp % 10 == 0).alias("owned"),
                                F.when((supp % 10).between(1, 8), supp.cast("string")).alias("competitor_id"), F.when(supp % 10 == 9, "UNMAPPED_DOMAIN").otherwise("COMPETITOR").alias("match_state"))
    return diagnostics.result_page(checks, snapshots, results).withColumns(joined("conflicts")).select("candidate_id", "conflicts", "observed_page_type", "status")


@query("K13_visibility", """
WITH o AS (SELECT user_id AS c, event_id % 50 <> 0 AS mapped, CAST(ts AS DATE) >= DATE '2024-01-24' AS fresh, event_type, value > 60 AS owned, value > 90 AS rival, user_id % 20 = 0 AND event_id % 2 = 0 AS moved FROM events),
f AS (SELECT c, COUNT(*) FILTER (mapped AND NOT moved AND fresh) AS cur, COUNT(*) FILTER (mapped AND NOT moved AND NOT fresh) AS stale, COUNT(*) FILTER (mapped AND NOT moved AND fresh AND owned) AS owned, COUNT(*) FILTER (mapped AND NOT moved AND fresh AND rival) AS rivals,
  bool_or(NOT mapped) AS lost, bool_or(mapped AND moved) AS gap, coalesce(bool_or(mapped AND NOT moved AND fresh AND event_type = 'click'), FALSE) AS seen, coalesce(bool_or(mapped AND NOT moved AND fresh AND event_type = 'error'), FALSE) AS na FROM o GROUP BY 1),
g AS (SELECT *, CASE WHEN cur = 0 AND stale = 0 THEN 'GEO_NOT_CHECKED' WHEN cur = 0 THEN 'INSUFFICIENT_GEO_EVIDENCE' WHEN owned > 0 AND rivals > 0 THEN 'GEO_STRONG' WHEN owned > 0 AND cur > 1 THEN 'GEO_STABLE' WHEN owned > 0 THEN 'GEO_STRONG' WHEN na THEN 'INSUFFICIENT_GEO_EVIDENCE' ELSE 'GEO_WEAK' END AS base FROM f)
SELECT c AS candidate_id, CASE WHEN gap THEN 'GEO_CONFLICT' ELSE base END AS status, CASE WHEN seen THEN 'OBSERVED' WHEN cur > 0 AND NOT na THEN 'NOT_OBSERVED' WHEN na THEN 'NOT_AVAILABLE' ELSE 'UNKNOWN' END AS mention_state,
  array_to_string(list_filter([CASE WHEN na THEN 'CAPABILITY_GAP' END, CASE WHEN gap THEN 'COMPARABILITY_GAP' END, CASE WHEN base IN ('GEO_WEAK', 'INSUFFICIENT_GEO_EVIDENCE') THEN 'CROSS_CHANNEL_CONFLICT' END, CASE WHEN base IN ('GEO_WEAK', 'INSUFFICIENT_GEO_EVIDENCE') THEN 'MIXED_SIGNAL' END,
    CASE WHEN stale > 0 THEN 'STALE_GEO_EVIDENCE' END, CASE WHEN lost THEN 'UNMAPPED_PROMPT' END], lambda e: e IS NOT NULL), ',') AS conflicts FROM g""")
def visibility(t):
    kind, value = C("event_type"), C("value")
    moved = (C("user_id") % 20 == 0) & (C("event_id") % 2 == 0)
    seen = t.events.select(
        C("user_id").alias("candidate_id"), F.when(C("event_id") % 50 == 0, "UNRESOLVED_PROMPT").otherwise("MAPPED").alias("mapping_state"), F.when(moved, "COMPARABILITY_GAP").otherwise("OK").alias("scope_state"), F.lit("v1").alias("sample_version"),
        F.when(kind == "click", "OBSERVED").when(kind == "error", "NOT_AVAILABLE").otherwise("NOT_OBSERVED").alias("mention_state"), F.lit("UNKNOWN").alias("citation_state"), F.when(value > 60, "URL_1").alias("owned_url_id"),
        F.when(value > 90, "COMP_1").alias("competitor_id"), F.lit(False).alias("unknown_domain"), F.lit("READY").alias("freshness_state"), F.lit("SUCCESS").alias("collection_status"), F.to_date("ts").alias("as_of"))
    targets = t.events.select(C("user_id").alias("candidate_id")).distinct().select("candidate_id", F.lit("2024-01-31").cast("date").alias("decision_day"), F.lit("SERP_VALIDATED").alias("serp_status"))
    return diagnostics.visibility(targets, seen).withColumns(joined("conflicts")).select("candidate_id", "status", "mention_state", "conflicts")


# --- Outcomes ---------------------------------------------------------------------------------------------

OUTCOME_SQL = """
s AS (SELECT l_partkey AS p, SUM(l_quantity) FILTER (l_linestatus = 'O') AS b1, SUM(l_quantity) FILTER (l_linestatus = 'F') AS f1, CAST(COUNT(*) FILTER (l_linestatus = 'O') AS DOUBLE) AS b2, CAST(COUNT(*) FILTER (l_linestatus = 'F') AS DOUBLE) AS f2,
  SUM(CAST(round(l_tax * 100) AS BIGINT)) FILTER (l_linestatus = 'O')::DOUBLE AS b3, SUM(CAST(round(l_tax * 100) AS BIGINT)) FILTER (l_linestatus = 'F')::DOUBLE AS f3 FROM lineitem GROUP BY 1),
d AS (SELECT p_partkey AS p, CASE WHEN b1 <> 0 THEN (f1 - b1) / abs(b1) END AS d1, CASE WHEN b2 <> 0 THEN (f2 - b2) / abs(b2) END AS d2, CASE WHEN b3 <> 0 THEN (f3 - b3) / abs(b3) END AS d3, b1 IS NULL OR f1 IS NULL OR b2 = 0 OR f2 = 0 AS lost FROM part LEFT JOIN s ON s.p = p_partkey)"""


def planned_metrics(t):
    tables = F.array(*[F.struct(F.lit(m).alias("metric"), F.lit(r).alias("role")) for m, r in (("clicks", "primary"), ("impressions", "support"), ("errors", "guardrail"))])
    return t.part.select(C("p_partkey").alias("track_id"), F.inline(tables), F.lit(0.1).alias("target_delta"), F.lit(0.05).alias("tolerance"), F.lit(1).alias("minimum_sample"), F.lit("RELATIVE_DELTA").alias("method"),
                         F.lit("INCREASE").alias("direction"), F.lit("MAX_INCREASE").alias("guard_direction"), F.lit(0.5).alias("max_delta"), F.lit("PAGE_LEVEL").alias("plan_scope"), none().alias("attribution_contract"))


def observed_sides(t):
    side = F.when(C("l_linestatus") == "O", "baseline").otherwise("follow_up")
    sums = t.lineitem.groupBy(C("l_partkey").alias("track_id"), side.alias("side")).agg(
        F.sum("l_quantity").alias("clicks"), F.count(F.lit(1)).cast("double").alias("impressions"), F.sum(F.round(C("l_tax") * 100).cast("long")).cast("double").alias("errors"))
    flat = sums.unpivot(["track_id", "side"], ["clicks", "impressions", "errors"], "metric", "value")
    return flat.withColumns({"source": F.lit("GSC"), "status": F.lit("COMPLETE"), "freshness_state": F.lit("READY"), "sample_size": F.lit(10), "scope": F.lit("PAGE_LEVEL")})


@query("K14_comparisons", f"""
WITH {OUTCOME_SQL} SELECT p AS track_id, 'clicks' AS metric, CASE WHEN lost THEN 'MISSING' END AS obstacle, CASE WHEN NOT lost THEN round(d1, 6) END AS delta FROM d
UNION ALL SELECT p, 'impressions', CASE WHEN lost THEN 'MISSING' END, CASE WHEN NOT lost THEN round(d2, 6) END FROM d UNION ALL SELECT p, 'errors', CASE WHEN lost THEN 'MISSING' END, CASE WHEN NOT lost THEN round(d3, 6) END FROM d""")
def compared(t):
    return rounded(outcomes.comparisons(planned_metrics(t), observed_sides(t)).select("track_id", "metric", "obstacle", "delta"), "delta")


@query("K14_outcomes", f"""
WITH {OUTCOME_SQL} SELECT p AS track_id, CASE WHEN p % 9 = 0 THEN 'OBSERVATION_ONLY' WHEN p % 9 = 1 THEN 'BLOCKED' ELSE 'EVALUATED' END AS tracking_status,
  CASE WHEN p % 9 = 1 THEN NULL WHEN p % 9 = 0 OR lost OR d1 IS NULL OR d2 IS NULL THEN 'INSUFFICIENT_DATA' WHEN d3 IS NULL OR d3 > 0.5 THEN 'LOST' WHEN abs(d1) <= 0.05 AND abs(d2) <= 0.05 THEN 'NO_CHANGE'
    WHEN d1 < 0.1 THEN 'LOST' WHEN d2 >= 0.1 THEN 'WON' ELSE 'PARTIAL_WIN' END AS outcome_state FROM d""")
def tracked(t):
    key = C("p_partkey")
    tracks = t.part.select(key.alias("track_id"), F.lit("30D").alias("checkpoint"), F.when(key % 9 == 0, "MONITORING_ONLY").otherwise("IMPLEMENTED").alias("event_type"), F.when(key % 9 == 1, "REVIEW_DRIFT").otherwise("OK").alias("lineage_state"))
    out = outcomes.outcomes(tracks, outcomes.comparisons(planned_metrics(t), observed_sides(t)))
    return out.select("track_id", "tracking_status", "outcome_state")


@query("K14_outcome_shares", f"""
WITH {OUTCOME_SQL}, z AS (SELECT CASE WHEN p % 9 = 1 THEN NULL WHEN p % 9 = 0 OR lost OR d1 IS NULL OR d2 IS NULL THEN 'INSUFFICIENT_DATA' WHEN d3 IS NULL OR d3 > 0.5 THEN 'LOST' WHEN abs(d1) <= 0.05 AND abs(d2) <= 0.05 THEN 'NO_CHANGE'
    WHEN d1 < 0.1 THEN 'LOST' WHEN d2 >= 0.1 THEN 'WON' ELSE 'PARTIAL_WIN' END AS outcome_state FROM d)
SELECT '30D' AS checkpoint, outcome_state, COUNT(*) AS outcomes, round(COUNT(*) / (SUM(COUNT(*)) OVER ()), 9) AS share FROM z GROUP BY 2""")
def outcome_shares(t):
    key = C("p_partkey")
    tracks = t.part.select(key.alias("track_id"), F.lit("30D").alias("checkpoint"), F.when(key % 9 == 0, "MONITORING_ONLY").otherwise("IMPLEMENTED").alias("event_type"), F.when(key % 9 == 1, "REVIEW_DRIFT").otherwise("OK").alias("lineage_state"))
    judged = outcomes.outcomes(tracks, outcomes.comparisons(planned_metrics(t), observed_sides(t)))
    return reports.outcome_shares(judged).withColumn("share", F.round("share", 9))


@query("K14_input_errors", """
WITH t AS (SELECT o_orderkey AS track_id, o_orderkey % 8 AS k, o_orderkey % 5 AS m FROM orders),
e AS (SELECT *, CASE WHEN k = 0 THEN 'INVALID_CHECKPOINT' WHEN m = 1 THEN 'BASELINE_EVIDENCE_HASH_MISMATCH' WHEN k IN (1, 2, 3) THEN 'INCOMPLETE_PERIOD' END AS input_error FROM t)
SELECT track_id, input_error, CASE WHEN input_error IS NULL THEN 'EVALUATED' ELSE 'BLOCKED' END AS tracking_status FROM e""")
def input_errors(t):
    """Follow-up windows a day late, a baseline a day short, one in another zone, checkpoints that are none, and pins whose evidence has moved."""
    key, done = C("o_orderkey"), F.to_date("o_orderdate")
    case = key % 8
    tracks = t.orders.select(key.alias("track_id"), F.when(case == 0, "45D").when(case == 4, "60d").otherwise("30D").alias("checkpoint"), done.alias("completed_day"), F.lit("IMPLEMENTED").alias("event_type"), F.lit("OK").alias("lineage_state"))
    zone = F.when(case == 3, "UTC").otherwise("Asia/Taipei")
    sides = F.array(F.struct(F.lit("baseline").alias("side"), F.date_sub(done, 28).alias("period_start"), F.date_sub(done, F.when(case == 2, 2).otherwise(1)).alias("period_end")),
                    F.struct(F.lit("follow_up").alias("side"), F.date_add(done, F.when(case == 4, 33).otherwise(3)).alias("period_start"), F.date_add(done, F.when(case == 4, 60).when(case == 1, 31).otherwise(30)).alias("period_end")))
    windows = t.orders.select(key.alias("track_id"), zone.alias("timezone"), F.inline(sides))
    pins = t.orders.select(key.alias("track_id"), key.alias("evidence_id"), F.lit(1).alias("revision"), F.md5(key.cast("string")).alias("content_hash"))
    log = t.orders.where(key % 5 != 2).select(key.alias("evidence_id"), F.lit(1).alias("revision"), F.when(key % 5 == 1, "moved").otherwise(F.md5(key.cast("string"))).alias("content_hash"))
    checked = outcomes.input_errors(tracks, windows, pins, log)
    compared = t.orders.select(key.alias("track_id"), F.lit("primary").alias("role"), none().alias("obstacle"), F.lit(0.2).alias("delta"), F.lit(0.05).alias("tolerance"), F.lit(True).alias("met"), F.lit(None).cast("boolean").alias("breached"), F.lit("INCREASE").alias("direction"))
    return outcomes.outcomes(checked, compared).select("track_id", "input_error", "tracking_status")


# --- Review and release -----------------------------------------------------------------------------------

def review_tables(t):
    key = C("o_orderkey")
    stored = t.orders.select(
        key.alias("candidate_id"), F.lit(1).alias("revision"), F.md5(key.cast("string")).alias("content_hash"), F.when(key % 7 != 0, 70).alias("score"), F.when(C("o_orderpriority") == "5-LOW", "LOW").otherwise("HIGH").alias("confidence"),
        F.lit("PASS").alias("validation_state"), empty().alias("missing_roles"), empty().alias("policy_gaps"), F.when(key % 11 == 0, F.array(F.lit("X"))).otherwise(empty()).alias("conflicts"), F.when(key % 13 == 0, "STALE").otherwise("READY").alias("freshness_state"),
        F.lit("SERP_VALIDATED").alias("serp_status"), F.lit("sig").alias("evidence_signature"))
    reviews = t.orders.select(
        key.alias("review_id"), F.lit(1).alias("revision"), key.alias("candidate_id"), F.lit(1).alias("candidate_revision"), F.when(key % 5 == 0, "moved").otherwise(F.md5(key.cast("string"))).alias("candidate_hash"),
        F.when(C("o_orderstatus") == "F", "REJECT").otherwise("APPROVE").alias("decision"), F.lit("UAT").alias("target_env"), F.lit("UAT_RECS").alias("destination_id"), none().alias("conflict_adjudication_ref"), F.lit("sig").alias("reviewed_signature"),
        F.lit("REASON_1").alias("reason_code"), F.when(key % 17 == 0, "bad id").otherwise("REV_1").alias("reviewer_id"), F.lit("2001-01-01").alias("created_at"), F.lit("2001-01-02").alias("decision_at"), none().alias("notes"), none().alias("preview_hash"))
    return stored, reviews


GATE_SQL = """CASE WHEN o_orderstatus = 'F' THEN 'HUMAN_APPROVAL_REQUIRED' WHEN o_orderkey % 5 = 0 THEN 'CANDIDATE_REVISION_MISMATCH' WHEN o_orderkey % 7 = 0 THEN 'MISSING_SCORE' WHEN o_orderpriority = '5-LOW' THEN 'INSUFFICIENT_CONFIDENCE'
  WHEN o_orderkey % 13 = 0 THEN 'STALE_EVIDENCE_BLOCKED' WHEN o_orderkey % 11 = 0 THEN 'CONFLICT_ADJUDICATION_REQUIRED' END"""


@query("K23_review_errors", "SELECT o_orderkey AS review_id, CASE WHEN o_orderkey % 17 = 0 THEN 'INVALID_REVIEWER' END AS problem FROM orders")
def review_errors(t):
    return review.review_errors(review_tables(t)[1]).select("review_id", "problem")


@query("K23_bridge_gates", f"SELECT o_orderkey AS review_id, {GATE_SQL} AS gate FROM orders")
def bridge_gates(t):
    stored, reviews = review_tables(t)
    return review.bridge_gates(reviews, stored).select("review_id", "gate")


@query("K23_bridge_texts", f"""
SELECT o_orderkey AS review_id, COALESCE({GATE_SQL}, CASE o_orderkey % 12 WHEN 1 THEN 'CAPABILITY_GAP_BLOCKED' WHEN 2 THEN 'INVALID_BRIDGE_REVISION' WHEN 3 THEN 'INVALID_BRIDGE_ID' WHEN 4 THEN 'INVALID_RECOMMENDATION_TEXT'
  WHEN 5 THEN 'INVALID_TEXT_PROVENANCE' WHEN 6 THEN 'MISSING_HUMAN_TEXT' END) AS gate FROM orders WHERE o_orderkey % 12 <> 1 OR o_orderkey % 13 <> 0 AND o_orderkey % 11 <> 0
UNION ALL SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' OR o_orderkey % 5 = 0 OR o_orderkey % 7 = 0 OR o_orderpriority = '5-LOW' THEN {GATE_SQL} ELSE 'CAPABILITY_GAP_BLOCKED' END FROM orders WHERE o_orderkey % 12 = 1 AND (o_orderkey % 13 = 0 OR o_orderkey % 11 = 0)""")
def bridge_texts(t):
    stored, reviews = review_tables(t)
    case, of = C("review_id") % 12, C("candidate_id") % 12
    stored = stored.withColumn("capability_gaps", F.when(of == 1, F.array(F.lit("LIVE_INTENT"))).otherwise(empty()))
    reviews = reviews.withColumns({
        "bridge_revision": F.when(case == 2, 0).when(case != 7, 1), "bridge_id": F.when(case == 3, "not opaque").when(case != 7, "BRIDGE_1"),
        "human_text": F.when(case == 4, F.repeat(F.lit("x"), 4001)).when(case == 8, "Write the answer first."), "text_provenance": F.when(case == 5, "MODEL_WRITTEN").when(case == 6, "HUMAN_AUTHORED")})
    return review.bridge_gates(reviews, stored).select("review_id", "gate")


@query("K24_review_status", f"""
SELECT o_orderkey AS candidate_id, CASE WHEN o_orderkey % 3 = 0 THEN 'NOT_REVIEWED' WHEN o_orderstatus = 'F' THEN 'REJECTED' ELSE 'APPROVED' END AS review_status,
  CASE WHEN o_orderkey % 3 = 0 THEN 'NOT_REVIEWED' WHEN {GATE_SQL} IS NULL THEN 'BRIDGE_READY' ELSE 'BLOCKED' END AS recommendation_bridge_status FROM orders""")
def review_status(t):
    stored, reviews = review_tables(t)
    held = reviews.where("candidate_id % 3 <> 0")
    return review.review_status(stored, held, review.bridge_gates(held, stored)).select("candidate_id", "review_status", "recommendation_bridge_status")


@query("K27_write_plan", """
SELECT o_orderkey, array_to_string(list_filter([CASE WHEN o_orderkey % 5 = 0 THEN 'REVISION_MISMATCH' END, CASE WHEN o_orderstatus = 'F' THEN 'WRITER_NOT_ALLOWED' END, CASE WHEN o_orderkey % 7 = 0 THEN 'STALE_EVIDENCE' END, CASE WHEN o_orderkey % 11 = 0 THEN 'IDEMPOTENCY_CONFLICT' END], lambda e: e IS NOT NULL), ',') AS errors,
  CASE WHEN o_orderkey % 5 = 0 OR o_orderstatus = 'F' OR o_orderkey % 7 = 0 OR o_orderkey % 11 = 0 THEN 'BLOCKED' WHEN o_orderkey % 3 = 0 THEN 'ALREADY_APPLIED' ELSE 'PLANNED' END AS plan_status FROM orders""")
def write_plan(t):
    key = C("o_orderkey")
    ops = t.orders.select(
        "o_orderkey", key.alias("seq"), F.md5(key.cast("string")).alias("idempotency_key"), F.lit("h").alias("semantic_hash"), F.lit("h").alias("expected_hash"), F.lit(1).alias("revision"), F.when(key % 5 == 0, 2).otherwise(1).alias("expected_revision"),
        C("o_orderstatus").alias("writer"), F.lit("UAT_SHEET").alias("target"), F.lit("GSC").alias("source"), F.when(key % 7 == 0, "STALE").otherwise("READY").alias("freshness_state"), F.lit("READY").alias("status"), F.lit("APPROVED_UAT").alias("approval_state"))
    ledger = ops.where((key % 3 == 0) | (key % 11 == 0)).select("idempotency_key", F.when(key % 11 == 0, "other").otherwise("h").alias("semantic_hash"))
    return review.write_plan(ops, ledger, ["O", "P"], ["UAT_SHEET"], ["GSC"]).select("o_orderkey", F.array_join("errors", ",").alias("errors"), "plan_status")


@query("K27_publishable", f"SELECT o_orderkey AS candidate_id, md5(CAST(o_orderkey AS VARCHAR)) AS candidate_hash FROM orders WHERE {GATE_SQL} IS NULL")
def publishable(t):
    stored, reviews = review_tables(t)
    return review.publishable(review.bridge_gates(reviews, stored)).select("candidate_id", "candidate_hash")


# --- Reports ----------------------------------------------------------------------------------------------

def preview_input(t):
    kinds = F.get(F.array(*[F.lit(k) for k in ("QUICK_WIN", "CONTENT_GAP", "CONTENT_DECAY", "GEO_GAP")]), (C("o_orderkey") % 4).cast("int"))
    return t.orders.select(C("o_orderkey").cast("string").alias("candidate_id"), F.lit(1).alias("revision"), kinds.alias("opportunity_type"), F.lit("MONITOR").alias("recommended_action"), F.when(C("o_orderstatus") == "O", C("o_totalprice")).alias("score"))


@query("K25_preview_rows", """
WITH f AS (SELECT o_orderkey FROM orders ORDER BY CASE WHEN o_orderstatus = 'O' THEN o_totalprice END DESC NULLS LAST, CAST(o_orderkey AS VARCHAR) LIMIT 20)
SELECT CAST(o_orderkey AS VARCHAR) AS candidate_id, CASE o_orderkey % 4 WHEN 0 THEN 'QUICK_WINS' WHEN 1 THEN 'CONTENT_GAPS' WHEN 2 THEN 'CONTENT_DECAY_TECHNICAL_UNLOCK' ELSE 'GEO_GAPS' END AS group_id,
  'UAT_' || substr(sha256('{"candidate_id":"' || o_orderkey || '","dataset":"D1","revision":1}'), 1, 20) AS uat_id, o_orderkey IN (SELECT o_orderkey FROM f) AS first_screen FROM orders""")
def preview_rows(t):
    return reports.preview_rows(preview_input(t), "D1").select("candidate_id", "group_id", "uat_id", "first_screen")


@query("K25_preview_groups", """
WITH f AS (SELECT o_orderkey FROM orders ORDER BY CASE WHEN o_orderstatus = 'O' THEN o_totalprice END DESC NULLS LAST, CAST(o_orderkey AS VARCHAR) LIMIT 20)
SELECT CASE o_orderkey % 4 WHEN 0 THEN 'QUICK_WINS' WHEN 1 THEN 'CONTENT_GAPS' WHEN 2 THEN 'CONTENT_DECAY_TECHNICAL_UNLOCK' ELSE 'GEO_GAPS' END AS group_id, COUNT(*) AS total, COUNT(*) FILTER (o_orderkey IN (SELECT o_orderkey FROM f)) AS visible FROM orders GROUP BY 1""")
def preview_groups(t):
    return reports.preview_groups(reports.preview_rows(preview_input(t), "D1"))


def pinned_evidence(t):
    source = F.when(C("l_suppkey") % 3 == 0, "AHREFS").when(C("l_suppkey") % 3 == 1, "GSC").otherwise("SF")
    once = t.lineitem.groupBy("l_orderkey", "l_linenumber").agg(F.max("l_suppkey").alias("l_suppkey"), F.max(F.to_date("l_shipdate")).alias("day"))
    name = F.concat_ws("-", "l_orderkey", "l_linenumber")
    stored = once.select(name.alias("evidence_id"), F.lit(1).alias("revision"), F.md5(name).alias("content_hash"), source.alias("source"), F.when(C("l_linenumber") == 1, "FAILED").otherwise("SUCCESS").alias("collection_status"),
                         F.lit("READY").alias("freshness_state"), C("day").alias("period_end"), C("day").alias("as_of"))
    pins = once.select(C("l_orderkey").alias("candidate_id"), name.alias("evidence_id"), F.lit(1).alias("revision"), F.when(C("l_linenumber") == 3, "moved").otherwise(F.md5(name)).alias("content_hash"))
    return pins, stored


@query("K25_source_layers", """
WITH o AS (SELECT l_orderkey AS k, l_linenumber AS n, MAX(l_suppkey) % 3 AS s FROM lineitem GROUP BY 1, 2),
g AS (SELECT k, s, COUNT(*) AS c, bool_or(n <> 1) AS up FROM o WHERE n <> 3 GROUP BY 1, 2),
f AS (SELECT DISTINCT k, x.name, x.s FROM o, (VALUES ('AHREFS', 0), ('GSC', 1), ('SF', 2), ('GA4', 9), ('SERP', 9), ('WORKDUO', 9), ('CRUX', 9), ('BUSINESS', 9)) x(name, s))
SELECT f.k AS candidate_id, f.name AS source, coalesce(c, 0) AS evidence, CASE WHEN up THEN 'AVAILABLE' ELSE 'NOT_AVAILABLE' END AS status, c IS NULL AS missing, f.name = 'AHREFS' AS is_estimate FROM f LEFT JOIN g ON g.k = f.k AND g.s = f.s""")
def source_layers(t):
    return reports.source_layers(*pinned_evidence(t))


@query("K25_timeline", """
SELECT l_orderkey AS candidate_id, l_orderkey || '-' || l_linenumber AS evidence_id, CASE WHEN l_linenumber = 3 THEN 'DRIFT' ELSE 'OK' END AS pin_state, CASE WHEN l_linenumber <> 3 THEN MAX(CAST(l_shipdate AS DATE)) END AS period_end,
  l_linenumber NOT IN (1, 3) AS is_current FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def timeline(t):
    return reports.evidence_timeline(*pinned_evidence(t)).select("candidate_id", "evidence_id", "pin_state", "period_end", "is_current")


@query("K28_monthly_model", """
WITH m AS (SELECT site, SUBSTR(CAST(day AS VARCHAR), 1, 7) AS month, SUM(clicks) AS c FROM search_daily GROUP BY 1, 2)
SELECT 'search_monthly' AS "table", COUNT(*) AS rows FROM m UNION ALL SELECT 'search_delta', COUNT(DISTINCT site) FROM m
UNION ALL SELECT 'search_pages', SUM(LEAST(n, 20))::BIGINT FROM (SELECT COUNT(DISTINCT page) AS n FROM search_daily GROUP BY site) UNION ALL SELECT 'search_queries', SUM(LEAST(n, 20))::BIGINT FROM (SELECT COUNT(DISTINCT query) AS n FROM search_daily GROUP BY site)
UNION ALL SELECT 'channels_monthly', COUNT(*) FROM (SELECT DISTINCT site, channel, SUBSTR(CAST(day AS VARCHAR), 1, 7) FROM behaviour_daily)
UNION ALL SELECT 'visibility_monthly', COUNT(*) FROM (SELECT DISTINCT entity, SUBSTR(CAST(day AS VARCHAR), 1, 7) FROM visibility_daily) UNION ALL SELECT 'business', COUNT(*) FROM business_monthly""")
def monthly_model(t):
    from sightline.operators.facts import table_counts
    return table_counts(reports.monthly_model(t.search_daily, t.behaviour_daily, t.visibility_daily, t.business_monthly, "view"))


def report(t):
    return reports.monthly_model(t.search_daily, t.behaviour_daily, t.visibility_daily, t.business_monthly, "view")


@query("K28_search_pages", """
SELECT * FROM (SELECT site, page, CAST(SUM(clicks) AS BIGINT) AS clicks, CAST(SUM(impressions) AS BIGINT) AS impressions, ROW_NUMBER() OVER (PARTITION BY site ORDER BY SUM(clicks) DESC, page) AS rank FROM search_daily GROUP BY site, page) WHERE rank <= 20""")
def report_pages(t):
    return report(t)["search_pages"].select("site", "page", "clicks", "impressions", "rank")


@query("K28_search_delta", """
WITH m AS (SELECT site, SUBSTR(CAST(day AS VARCHAR), 1, 7) AS month, CAST(SUM(clicks) AS BIGINT) AS clicks, SUM(clicks)::DOUBLE / SUM(impressions) AS ctr FROM search_daily GROUP BY 1, 2),
r AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY site ORDER BY month DESC) AS rn FROM m)
SELECT a.site, a.month AS month_current, b.month AS month_previous, a.clicks AS clicks_current, b.clicks AS clicks_previous, round(a.clicks::DOUBLE / b.clicks - 1, 6) AS clicks_change, round((a.ctr - b.ctr) * 100, 6) AS ctr_change_pp
FROM r a JOIN r b ON b.site = a.site AND a.rn = 1 AND b.rn = 2""")
def report_delta(t):
    return rounded(report(t)["search_delta"].select("site", "month_current", "month_previous", "clicks_current", "clicks_previous", "clicks_change", "ctr_change_pp"), "clicks_change", "ctr_change_pp")


@query("K28_channels", """
WITH m AS (SELECT site, SUBSTR(CAST(day AS VARCHAR), 1, 7) AS month, channel, CAST(SUM(sessions) AS BIGINT) AS sessions FROM behaviour_daily GROUP BY 1, 2, 3)
SELECT m.site, m.month, m.channel, m.sessions, CASE WHEN m.channel <> 'view' THEN round(m.sessions::DOUBLE / b.sessions, 6) END AS share_of_base FROM m LEFT JOIN m b ON b.site = m.site AND b.month = m.month AND b.channel = 'view'""")
def report_channels(t):
    return rounded(report(t)["channels_monthly"], "share_of_base")


@query("K28_business", """
SELECT b.month, CAST(b.leads AS BIGINT) AS actual, CAST(b.target_leads AS BIGINT) AS target, CASE WHEN b.target_leads <> 0 THEN round(b.leads::DOUBLE / b.target_leads, 6) END AS reach, CASE WHEN p.leads <> 0 THEN round(b.leads::DOUBLE / p.leads - 1, 6) END AS mom_change,
  CAST(b.target_leads - b.leads AS BIGINT) AS gap FROM business_monthly b LEFT JOIN business_monthly p ON CAST(p.month || '-01' AS DATE) + INTERVAL 1 MONTH = CAST(b.month || '-01' AS DATE)""")
def report_business(t):
    return rounded(report(t)["business"], "reach", "mom_change")


@query("K29_weekly_sessions", """
WITH s AS (SELECT CAST(SUM(sessions) FILTER (day BETWEEN DATE '2024-01-14' AND DATE '2024-01-20') AS BIGINT) AS cur, CAST(SUM(sessions) FILTER (day BETWEEN DATE '2024-01-07' AND DATE '2024-01-13') AS BIGINT) AS prev FROM behaviour_daily),
q AS (SELECT CAST(SUM(clicks) FILTER (d BETWEEN DATE '2024-01-14' AND DATE '2024-01-20') AS BIGINT) AS cur, CAST(SUM(clicks) FILTER (d BETWEEN DATE '2024-01-07' AND DATE '2024-01-13') AS BIGINT) AS prev FROM (SELECT clicks, day + 8604 AS d FROM search_daily))
SELECT s.cur AS sessions_current, s.prev AS sessions_previous, round(s.cur::DOUBLE / s.prev - 1, 6) AS sessions_change, q.cur AS clicks_current, q.prev AS clicks_previous, round(q.cur::DOUBLE / q.prev - 1, 6) AS clicks_change FROM s, q""")
def weekly_sessions(t):
    """Search days are moved to the days on which there are sessions, so that both sides of the row are filled."""
    search = t.search_daily.withColumn("day", F.date_add("day", 8604))
    out = reports.weekly_changes(search, t.behaviour_daily, "2024-01-20")
    return rounded(out.select(*[f"{c}_{n}" for c in ("sessions", "clicks") for n in ("current", "previous", "change")]), "sessions_change", "clicks_change")


@query("K29_weekly_changes", """
WITH s AS (SELECT CAST(SUM(clicks) FILTER (day BETWEEN DATE '2000-06-24' AND DATE '2000-06-30') AS BIGINT) AS cc, CAST(SUM(clicks) FILTER (day BETWEEN DATE '2000-06-17' AND DATE '2000-06-23') AS BIGINT) AS cp,
  CAST(SUM(impressions) FILTER (day BETWEEN DATE '2000-06-24' AND DATE '2000-06-30') AS BIGINT) AS ic, CAST(SUM(impressions) FILTER (day BETWEEN DATE '2000-06-17' AND DATE '2000-06-23') AS BIGINT) AS ip FROM search_daily)
SELECT cc AS clicks_current, cp AS clicks_previous, ic AS impressions_current, ip AS impressions_previous, CAST(NULL AS BIGINT) AS sessions_current, CAST(NULL AS BIGINT) AS sessions_previous,
  round(cc::DOUBLE / cp - 1, 6) AS clicks_change, round(ic::DOUBLE / ip - 1, 6) AS impressions_change, CAST(NULL AS DOUBLE) AS sessions_change FROM s""")
def weekly_changes(t):
    return rounded(reports.weekly_changes(t.search_daily, t.behaviour_daily, "2000-06-30"), "clicks_change", "impressions_change", "sessions_change")


@query("K29_data_quality", """
SELECT 'search' AS source, COUNT(*) AS rows, COUNT(DISTINCT day) AS days, CASE WHEN COUNT(*) = 0 THEN 'fail' WHEN COUNT(DISTINCT day) < 7 THEN 'warning' ELSE 'pass' END AS status FROM search_daily WHERE day BETWEEN DATE '2000-06-24' AND DATE '2000-06-30'
UNION ALL SELECT 'behaviour', COUNT(*), COUNT(DISTINCT day), CASE WHEN COUNT(*) = 0 THEN 'fail' WHEN COUNT(DISTINCT day) < 7 THEN 'warning' ELSE 'pass' END FROM behaviour_daily WHERE day BETWEEN DATE '2000-06-24' AND DATE '2000-06-30'""")
def data_quality(t):
    return reports.data_quality({"search": t.search_daily, "behaviour": t.behaviour_daily}, "day", "2000-06-24", "2000-06-30", 7)


@query("K29_weekly_actions", """
SELECT p_partkey, (p_size % 5 + 1) + (p_partkey % 5 + 1) + 1 + 1 - (p_partkey % 3 + 1) AS priority_score, p_partkey % 4 <> 0 AS complete FROM part""")
def weekly_actions(t):
    key = C("p_partkey")
    rows = t.part.select("p_partkey", (C("p_size") % 5 + 1).alias("business_impact"), (key % 5 + 1).alias("traffic_opportunity"), F.lit(1).alias("conversion_relevance"), F.lit(1).alias("technical_risk"), (key % 3 + 1).alias("effort"),
                         F.when(key % 4 == 0, " ").otherwise("x").alias("problem"), F.lit("x").alias("how_to"))
    return reports.weekly_actions(rows, ["problem", "how_to"]).select("p_partkey", "priority_score", "complete")
