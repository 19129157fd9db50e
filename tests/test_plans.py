"""Scenario tables of diagnostics, outcomes, reviews and write plans."""

import datetime

import pytest
from pyspark.sql import functions as F

from sightline.plans import diagnostics, outcomes, reports, review
from sightline.schemas import SOURCE_CLASS

DAY = datetime.date(2024, 6, 30)


def ago(days):
    return DAY - datetime.timedelta(days=days)


# --- Behaviour --------------------------------------------------------------------------------------------

ROW = ("candidate_id string, source string, source_class string, url_id string, normalized_url string, channel string, metric string, value double, period_end date, as_of date, freshness_state string, "
       "collection_status string, event_classification string")


def metric(c, name, value, back, channel="Organic Search", url="U1", normalized="https://a/", state="READY", kind=None, source_class=SOURCE_CLASS["GA4"]):
    return (c, "GA4", source_class, url, normalized, channel, name, value, ago(back), ago(back), state, "SUCCESS", kind)


def pair(c, sessions, rate, **kw):
    return [metric(c, "sessions", v, b, **kw) for v, b in zip(sessions, (5, 1))] + [metric(c, "engagement_rate", v, b, **kw) for v, b in zip(rate, (5, 1))]


BEHAVIOUR = {
    "healthy": (pair("healthy", (10, 12), (.5, .5)), "QUALITY_HEALTHY"), "sessions_down": (pair("sessions_down", (10, 8), (.5, .6)), "QUALITY_MIXED"),
    "engagement_down": (pair("engagement_down", (10, 10), (.5, .4)), "QUALITY_MIXED"), "weak": (pair("weak", (10, 8), (.5, .4)), "QUALITY_WEAK"),
    "missing": ([], "INSUFFICIENT_GA4_EVIDENCE"), "stale": (pair("stale", (10, 12), (.5, .5), state="STALE"), "INSUFFICIENT_GA4_EVIDENCE"),
    "channel": (pair("channel", (10, 12), (.5, .5), channel="Direct"), "CONFLICTING_GA4_EVIDENCE"), "other_page": (pair("other_page", (10, 12), (.5, .5), url="U2"), "CONFLICTING_GA4_EVIDENCE"),
    "site_wide": (pair("site_wide", (10, 12), (.5, .5), normalized=None), "CONFLICTING_GA4_EVIDENCE"), "one_period": ([metric("one_period", "sessions", 1, 1), metric("one_period", "engagement_rate", .5, 1)], "QUALITY_HEALTHY"),
    "event": (pair("event", (10, 12), (.5, .5)) + [metric("event", "event_count", 3, 1, kind="OTHER")], "CONFLICTING_GA4_EVIDENCE"),
    "cta": (pair("cta", (10, 12), (.5, .5)) + [metric("cta", "event_count", 0, 1, kind="CTA_INTERACTION")], "QUALITY_HEALTHY"),
    "class": (pair("class", (10, 12), (.5, .5), source_class="X"), "CONFLICTING_GA4_EVIDENCE"), "clash": (pair("clash", (10, 12), (.5, .5)) + [metric("clash", "sessions", 99, 1)], "CONFLICTING_GA4_EVIDENCE"),
    "search_up": (pair("search_up", (10, 8), (.5, .5)), "CONFLICTING_GA4_EVIDENCE"),
}


def test_behaviour(spark):
    targets = spark.createDataFrame([(c, "U1", "Organic Search", "PAGE_LEVEL", DAY, *((5.0, 1.0) if c == "search_up" else (None, None))) for c in BEHAVIOUR],
                                    "candidate_id string, url_id string, expected_channel string, quality_scope string, decision_day date, gsc_current double, gsc_previous double")
    rows = spark.createDataFrame([tuple(float(v) if isinstance(v, int) else v for v in r) for rows, _ in BEHAVIOUR.values() for r in rows], ROW)
    got = {r.candidate_id: r for r in diagnostics.behaviour(targets, rows).collect()}
    assert {c: r.status for c, r in got.items()} == {c: want for c, (_, want) in BEHAVIOUR.items()}
    assert got["cta"].cta_signal == "CTA_SIGNAL_WEAK" and got["healthy"].cta_signal == "CTA_SIGNAL_NOT_AVAILABLE"
    assert got["search_up"].conflicts == ["GSC_GA4_ACQUISITION_BEHAVIOR_CONFLICT"] and got["weak"].diagnostic_confidence == "MEDIUM"


# --- Result pages -----------------------------------------------------------------------------------------

def test_result_page(spark):
    names = ["ok", "mixed", "competitors", "unknown", "no_query", "stale", "few", "crowded", "scope", "revised"]
    checks = spark.createDataFrame([(c, None if c == "no_query" else "Q", None, True, True, "informational_article", "INFORMATIONAL", DAY) for c in names],
                                   "candidate_id string, query_id string, query_problem string, target_known boolean, target_matches boolean, expected_page_type string, expected_intent string, decision_day date")
    pages = [(c, 1, f"{c}-1", c != "scope", "READY", "SUCCESS", ago(9 if c == "stale" else 1), {"paa": "OBSERVED"} if c == "crowded" else {}) for c in names if c != "few"]
    pages.append(("revised", 2, "revised-2", True, "READY", "SUCCESS", ago(0), {}))
    snapshots = spark.createDataFrame(pages, "candidate_id string, seq int, snapshot_id string, scope_ok boolean, freshness_state string, collection_status string, as_of date, features map<string,string>")
    rows = []
    for c, _, s, *_ in pages:
        kinds = ["article", "article", "product", "forum"] if c == "mixed" else ["product"] * 3 if s == "revised-1" else ["article"] * 3
        for i, kind in enumerate(kinds):
            rows.append((s, kind, i == 0 and c != "competitors", "C1" if i == 1 else None, "UNMAPPED_DOMAIN" if c == "unknown" and i == 2 else "OK"))
    results = spark.createDataFrame(rows, "snapshot_id string, result_type string, owned boolean, competitor_id string, match_state string")
    got = {r.candidate_id: (r.status, r.conflicts) for r in diagnostics.result_page(checks, snapshots, results).collect()}
    assert got["ok"] == ("SERP_VALIDATED", []) and got["revised"] == ("SERP_VALIDATED", [])
    assert got["mixed"] == ("SERP_CONFLICT", ["PAGE_TYPE_MISMATCH"]) and got["competitors"] == ("SERP_CONFLICT", ["COMPETITOR_DOMINANCE"])
    assert got["unknown"] == ("SERP_CONFLICT", ["UNKNOWN_COMPETITOR_DOMAIN"]) and got["crowded"] == ("SERP_CONFLICT", ["SERP_FEATURE_CROWDING"])
    assert got["no_query"][0] == got["few"][0] == got["scope"][0] == got["stale"][0] == "SERP_NOT_CHECKED"


# --- AI visibility ----------------------------------------------------------------------------------------

def test_visibility(spark):
    def seen(c, mapping="MAPPED", scope="OK", version="v1", mention="NOT_OBSERVED", citation="NOT_OBSERVED", owned=None, rival=None, unknown=False, state="READY", back=1):
        return (c, mapping, scope, version, mention, citation, owned, rival, unknown, state, "SUCCESS", ago(back))
    cases = {
        "strong": ([seen("strong", owned="U", rival="C")], "GEO_STRONG"), "single": ([seen("single", owned="U")], "GEO_STRONG"), "stable": ([seen("stable", owned="U"), seen("stable")], "GEO_STABLE"),
        "weak": ([seen("weak", rival="C")], "GEO_WEAK"), "capability": ([seen("capability", citation="NOT_AVAILABLE")], "INSUFFICIENT_GEO_EVIDENCE"), "stale": ([seen("stale", back=30)], "INSUFFICIENT_GEO_EVIDENCE"),
        "none": ([], "GEO_NOT_CHECKED"), "scope": ([seen("scope", scope="COMPARABILITY_GAP")], "GEO_CONFLICT"), "versions": ([seen("versions", owned="U"), seen("versions", version="v2")], "GEO_CONFLICT"),
        "unmapped": ([seen("unmapped", mapping="UNRESOLVED_PROMPT")], "GEO_NOT_CHECKED")}
    targets = spark.createDataFrame([(c, DAY, None) for c in cases], "candidate_id string, decision_day date, serp_status string")
    rows = spark.createDataFrame([r for rs, _ in cases.values() for r in rs], "candidate_id string, mapping_state string, scope_state string, sample_version string, mention_state string, citation_state string, "
                                 "owned_url_id string, competitor_id string, unknown_domain boolean, freshness_state string, collection_status string, as_of date")
    got = {r.candidate_id: r for r in diagnostics.visibility(targets, rows).collect()}
    assert {c: r.status for c, r in got.items()} == {c: want for c, (_, want) in cases.items()}
    assert got["unmapped"].conflicts == ["UNMAPPED_PROMPT"] and got["stale"].conflicts == ["STALE_GEO_EVIDENCE"] and got["capability"].citation_state == "NOT_AVAILABLE"


# --- Outcomes ---------------------------------------------------------------------------------------------

OUTCOMES = {
    # (clicks before, after), (impressions before, after), (errors before, after), state
    "won": ((10, 12), (10, 12), (1, 1), "WON"), "partial": ((10, 12), (10, 10), (1, 1), "PARTIAL_WIN"), "lost": ((10, 8), (10, 12), (1, 1), "LOST"), "same": ((100, 101), (100, 99), (1, 1), "NO_CHANGE"),
    "guard": ((10, 12), (10, 12), (1, 3), "LOST"), "zero_base": ((0, 12), (10, 12), (1, 1), "INSUFFICIENT_DATA"), "missing": ((10, None), (10, 12), (1, 1), "INSUFFICIENT_DATA"),
    "between": ((100, 107), (100, 101), (1, 1), "LOST"),
}


def test_outcomes(spark):
    plans = [(t, m, r, 0.1, 0.05, 1, "RELATIVE_DELTA", "INCREASE", "MAX_INCREASE", 0.5, "PAGE_LEVEL", None) for t in [*OUTCOMES, "watch", "business", "conversion"]
             for m, r in (("clicks" if t != "conversion" else "sql_leads", "primary"), ("impressions", "support"), ("errors", "guardrail"))]
    plan = spark.createDataFrame(plans, "track_id string, metric string, role string, target_delta double, tolerance double, minimum_sample int, method string, direction string, guard_direction string, max_delta double, plan_scope string, attribution_contract string")
    rows = []
    for t, (clicks, shown, errors, *_) in {**OUTCOMES, "watch": OUTCOMES["won"], "business": OUTCOMES["won"], "conversion": OUTCOMES["won"]}.items():
        source = {"business": "BUSINESS", "conversion": "GA4"}.get(t, "GSC")
        for m, values in (("sql_leads" if t == "conversion" else "clicks", clicks), ("impressions", shown), ("errors", errors)):
            rows += [(t, s, m, source, None if v is None else float(v), "COMPLETE", "READY", 10, "PAGE_LEVEL") for s, v in zip(("baseline", "follow_up"), values)]
    seen = spark.createDataFrame(rows, "track_id string, side string, metric string, source string, value double, status string, freshness_state string, sample_size int, scope string")
    tracks = spark.createDataFrame([(t, "30D", "MONITORING_ONLY" if t == "watch" else "IMPLEMENTED", "OK") for t in [*OUTCOMES, "watch", "business", "conversion"]], "track_id string, checkpoint string, event_type string, lineage_state string")
    compared = outcomes.comparisons(plan, seen)
    got = {r.track_id: (r.tracking_status, r.outcome_state) for r in outcomes.outcomes(tracks, compared).collect()}
    assert {t: got[t][1] for t in OUTCOMES} == {t: v[3] for t, v in OUTCOMES.items()}
    assert got["watch"] == ("OBSERVATION_ONLY", "INSUFFICIENT_DATA") and got["business"][1] == got["conversion"][1] == "INSUFFICIENT_DATA"
    obstacles = {(r.track_id, r.role): r.obstacle for r in compared.collect()}
    assert obstacles[("business", "primary")] == "BUSINESS_ATTRIBUTION_CONTRACT_REQUIRED" and obstacles[("conversion", "primary")] == "GA4_DIAGNOSTIC_ONLY"


@pytest.mark.parametrize("direction, limit, change, breached", [("MAX_INCREASE", 0.1, 0.2, True), ("MAX_INCREASE", 0.1, -0.5, False), ("NOT_DECREASE", 0.1, -0.2, True), ("NOT_INCREASE", 0.1, 0.2, True), ("OTHER", 0.1, -0.2, True), ("MAX_INCREASE", 0.1, None, True)])
def test_guardrails(spark, direction, limit, change, breached):
    value = F.lit(change).cast("double")
    assert spark.range(1).select(outcomes.guardrail_breached(value, F.lit(direction), F.lit(limit))).first()[0] is breached


# --- Review and preview -----------------------------------------------------------------------------------

def test_newest_review_counts(spark):
    candidates = spark.createDataFrame([("c", 1, "h", 70, "HIGH", "PASS", [], [], [], "READY", "SERP_VALIDATED", "s")],
                                       "candidate_id string, revision int, content_hash string, score int, confidence string, validation_state string, missing_roles array<string>, policy_gaps array<string>, conflicts array<string>, freshness_state string, serp_status string, evidence_signature string")
    reviews = spark.createDataFrame([("r", n, "c", 1, "h", "APPROVE" if n == 1 else "REJECT", "UAT", "UAT_X", None, "s") for n in (1, 2)],
                                    "review_id string, revision int, candidate_id string, candidate_revision int, candidate_hash string, decision string, target_env string, destination_id string, conflict_adjudication_ref string, reviewed_signature string")
    gates = {r.revision: r.gate for r in review.bridge_gates(reviews, candidates).collect()}
    assert gates == {1: "SUPERSEDED_REVIEW", 2: "HUMAN_APPROVAL_REQUIRED"}
    assert review.review_status(candidates, reviews, review.bridge_gates(reviews, candidates)).first().review_status == "REJECTED"
    ready = review.bridge_gates(reviews.where("revision = 1"), candidates)
    assert ready.first().bridge_status == "BRIDGE_READY" and review.publishable(ready).count() == 1


def test_preview_caps_the_first_screen_only(spark):
    df = spark.range(300).selectExpr("cast(id as string) candidate_id", "1 revision", "'QUICK_WIN' opportunity_type", "'MONITOR' recommended_action", "if(id % 3 = 0, null, cast(id as double)) score")
    rows = reports.preview_rows(df, "D", cap=20)
    assert rows.count() == 300 and {r.candidate_id for r in rows.where("first_screen").collect()} == {str(i) for i in sorted((i for i in range(300) if i % 3), reverse=True)[:20]}
    with pytest.raises(ValueError):
        reports.preview_rows(df, "D", cap=101)


def test_a_hot_key_is_folded_in_parts(spark):
    """A third of the evidence on one bundle: the join deals it out over many tasks, and folds meet as partial results."""
    from sightline.operators.joins import SPREAD, join_spread
    rows = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN 0 ELSE id END AS bundle_id", "id AS v", "CAST(NULL AS STRING) AS nothing")
    groups = spark.range(30_000).selectExpr("id AS bundle_id", "id % 7 AS target")
    held = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = join_spread(rows, groups, "bundle_id", ["v"])
        tasks = joined.where("bundle_id = 0").selectExpr("spark_partition_id() AS p").groupBy("p").count().collect()
        folded = joined.groupBy("bundle_id").count()
        plan = folded._jdf.queryExecution().toString()
        assert joined.count() == 30_000 and folded.where("bundle_id = 0").first()["count"] == 10_000
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    assert len(tasks) >= 5 and max(r["count"] for r in tasks) <= 5000 and SPREAD > 1
    assert "partial_count" in plan and plan.index("HashAggregate") < plan.index("partial_count") < plan.index("SortMergeJoin")


def test_copies_for_a_hot_key_are_never_broadcast(spark):
    """Spark estimates a generator's output without the rows it adds, so small-looking groups must not be sent to the driver."""
    from sightline.operators.joins import join_spread
    rows, groups = spark.range(100).selectExpr("id % 9 AS bundle_id", "id AS v"), spark.range(9).selectExpr("id AS bundle_id", "id AS target")
    joined = join_spread(rows, groups, "bundle_id", ["v"])
    assert joined.count() == 100
    plan = joined._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "SortMergeJoin" in plan


@pytest.mark.parametrize("name", ["K1_technical_unlock", "K4_quick_win", "K5_content_gap", "K6_decisions", "K7_score"])
def test_rule_queries_never_broadcast_copies(spark, name):
    """The copies of a bundle grow with the parts; no query may broadcast them."""
    import __spark_entry__ as entry
    plan = entry.queries()[name](spark, entry.SMOKE_DIR)._jdf.queryExecution().sparkPlan()

    def nodes(node):
        return [node.toString().split("\n")[0]] + [x for i in range(node.children().size()) for x in nodes(node.children().apply(i))]

    joins = [x for x in nodes(plan) if "Join" in x and "_salt" in x]
    assert joins and all(x.startswith("SortMergeJoin") for x in joins)


def test_samples_snapshots_and_populations(spark):
    """Sample revisions count for AI-answer sources only; snapshots of two days are no period."""
    from sightline.operators.joins import compare_sides
    rows = [("geo", "WORKDUO", "v1", 1, 1), ("drift", "WORKDUO", "v1", 1, 2), ("unknown", "GEO", "v1", None, None), ("search", "GSC", "v1", 1, 2), ("page", "SERP", "v1", 1, 1)]
    flat = [(k, "m", side, 1.0, source, version, rev, day) for k, source, version, *revs in rows for side, rev, day in (("baseline", revs[0], "2024-01-31"), ("follow_up", revs[1], "2024-02-29"))]
    df = spark.createDataFrame(flat, "track_id string, metric string, side string, value double, source string, sample_version string, sample_revision int, period_end string")
    assert {r.track_id: r.mismatch for r in compare_sides(df).collect()} == {
        "geo": None, "drift": "SAMPLE_REVISION_MISMATCH", "unknown": "SAMPLE_REVISION_MISSING", "search": None, "page": "SNAPSHOT_NOT_A_PERIOD"}


def test_dictionaries_with_very_many_patterns(spark):
    """Patterns with a sure literal meet only texts that have it; the first that matches decides, as if each were tried."""
    import re
    from sightline.operators.joins import brand_class, required_literal
    sure = {"shop.*line": "shop", "colou?r set": "r set", "^blue+ sky$": "blue", "a{2}bcd": "bcd", "x|shopline": "", "(shop)line": "", "shop\\d": "", "ab*": "", "[ab]cdef": "", "plain words": "plain words", ".*": ""}
    found = spark.createDataFrame([(p,) for p in sure], "p string").select("p", required_literal(__import__("pyspark").sql.functions.col("p")).alias("l"))
    assert {r.p: r.l for r in found.collect()} == sure
    terms = [(f"brand{k}.*x?$", "Regex", f"class{k % 5}", "Approved") for k in range(3000)] + [("^(pre|post) ", "Regex", "grouped", "Approved"), ("brand7", "Regex", "short", "Candidate")]
    texts = [f"some brand{k} thing" for k in range(0, 4000, 37)] + ["pre word", "none", "BRAND12 end", "brand12x"]
    df = spark.createDataFrame([(x,) for x in texts], "q string")
    got = {r.q: r.brand_class for r in brand_class(df, "q", spark.createDataFrame(terms, "term string, rule string, class string, status string")).collect()}
    for x in texts:
        fits = sorted((t, c) for t, rule, c, status in terms if status == "Approved" and re.search(t, x.lower()))
        assert got[x] == (fits[0][1] if fits else "Non-brand"), x


def test_observations_of_another_source_are_no_sample(spark):
    """A row that is no observation of the monitored sample is a conflict and counts for nothing."""
    from sightline.plans import diagnostics
    from sightline.schemas import SOURCE_CLASS
    day = __import__("datetime").date(2024, 1, 31)
    schema = ("candidate_id int, mapping_state string, scope_state string, sample_version string, mention_state string, citation_state string, owned_url_id string, competitor_id string, "
              "unknown_domain boolean, freshness_state string, collection_status string, as_of date, source string, source_class string, metric string")
    good = ("MAPPED", "OK", "v1", "OBSERVED", "OBSERVED", "U", "C", False, "READY", "SUCCESS", day)
    kind = ("WORKDUO", SOURCE_CLASS["WORKDUO"], "geo_observation")
    rows = [(1, *good, *kind), (2, *good, "GSC", *kind[1:]), (3, *good, *kind), (3, *good, *kind[:2], "clicks"), (4, *good, kind[0], None, kind[2])]
    targets = spark.createDataFrame([(k, day, "SERP_VALIDATED") for k in (1, 2, 3, 4)], "candidate_id int, decision_day date, serp_status string")
    got = {r.candidate_id: (r.status, r.conflicts) for r in diagnostics.visibility(targets, spark.createDataFrame(rows, schema)).collect()}
    wrong = ["GEO_SOURCE_CLASS_MISMATCH"]
    assert got == {1: ("GEO_STRONG", []), 2: ("GEO_NOT_CHECKED", wrong), 3: ("GEO_STRONG", wrong), 4: ("GEO_NOT_CHECKED", wrong)}


def test_planning_time_of_decisions(spark):
    """Conditions inferred from joins must not carry whole records: plans of a handful of rows are made in seconds."""
    import time

    import __spark_entry__ as entry
    df = entry.queries()["K6_decisions"](spark, "/root/testdata/sf0.001")
    start = time.perf_counter()
    df._jdf.queryExecution().executedPlan()
    assert time.perf_counter() - start < 6


def test_score_bands_rest_on_evidence_of_the_candidate(spark):
    from sightline.plans import validate
    cites = spark.createDataFrame([("c", 1, e) for e in ("e1", "e1", "gone")] + [("d", 1, "e2")], "candidate_id string, revision int, evidence_id string")
    evidence = spark.createDataFrame([("e1",), ("e2",)], "evidence_id string")
    said = [("demand", "why", "e1"), ("traction", "why", "e2"), ("business", " ", "e1"), ("geo", "why", None), ("execution", "why", "gone"), ("execution", "why", "e1")]
    rows = spark.createDataFrame([("c", 1, *r) for r in said], "candidate_id string, revision int, dimension string, rationale string, evidence_id string")
    got = validate.explained(rows, cites, evidence).first()
    assert (got["_supported"], got["_astray"]) == (["demand", "traction", "execution"], ["traction", "execution"])
    bands = [f"{d}_score" for d in ("demand", "traction", "business", "attainability", "geo", "execution")]
    scored = spark.createDataFrame([("c", "existing", 1, 1, 1, None, 2, 3), ("x", "none", 1, 1, 1, 1, 1, 1)], f"candidate_id string, score_profile string, {', '.join(f'{b} int' for b in bands)}")
    joined = scored.withColumns({n: F.array(*[F.lit(d) for d in got[n]]) for n in ("_supported", "_astray")})
    from sightline.operators.quality import codes
    errors = {r.candidate_id: r.errors for r in joined.withColumn("errors", codes(*validate.explanation_rules())).collect()}
    assert errors == {"c": ["EVIDENCE_REF_MISSING:traction", "MISSING_SCORE_EVIDENCE:business", "EVIDENCE_REF_MISSING:execution"], "x": []}
