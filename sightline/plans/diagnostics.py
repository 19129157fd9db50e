"""Behaviour, result-page and AI-visibility diagnostics of candidates, all candidates at once.

Each diagnostic folds the rows of a candidate into one row of flags with partial aggregation, then decides by
expressions, so neither a candidate with very much evidence nor the number of candidates matters.
"""

from pyspark.sql import Column, DataFrame, functions as F

from sightline.functions.labels import intent, page_type
from sightline.operators.facts import dominant_kind
from sightline.operators.joins import join_spread
from sightline.operators.periods import trend_signal
from sightline.operators.quality import codes, is_fresh, optional
from sightline.schemas import SOURCE_CLASS

# Metrics a behaviour diagnostic understands, and features that crowd a result page.
BEHAVIOUR_METRICS = ["sessions", "users", "engaged_sessions", "engagement_rate", "average_engagement_time", "event_count"]
CROWDING_FEATURES = ["featured_snippet", "paa", "ai_overview", "aio"]


def any_true(condition: Column) -> Column:
    return F.coalesce(F.bool_or(F.coalesce(condition, F.lit(False))), F.lit(False))


def behaviour(targets: DataFrame, evidence: DataFrame) -> DataFrame:
    """Behaviour quality of each candidate's landing page.

    ``targets``: ``candidate_id, url_id, expected_channel, quality_scope, decision_day, gsc_current, gsc_previous``.
    ``evidence``: ``candidate_id, source, source_class, url_id, normalized_url, channel, metric, value, period_end,
    as_of, freshness_state, collection_status, event_classification``.  Targets may carry ``external_figures``: whether
    figures of other populations (assistant sessions, leads, revenue) were handed in, which are never divided by sessions.
    ``types`` holds the status and each signal that is one of the named kinds.
    """
    c = F.col
    asked = targets.select("candidate_id", c("url_id").alias("_url"), "expected_channel", "quality_scope", "decision_day")
    rows = join_spread(evidence, asked, "candidate_id", ["metric", "period_end"])
    page = c("quality_scope") == "PAGE_LEVEL"
    problem = (F.when((c("source") != "GA4") | (c("source_class") != SOURCE_CLASS["GA4"]), "GA4_SOURCE_CLASS_MISMATCH")
               .when(page & ~c("url_id").eqNullSafe(c("_url")), "GA4_URL_JOIN_MISMATCH")
               .when(~c("channel").eqNullSafe(c("expected_channel")), "WRONG_CHANNEL_SEGMENT")
               .when(page & c("normalized_url").isNull(), "SITE_WIDE_CONTEXT_ONLY")
               .when(~c("metric").isin(BEHAVIOUR_METRICS), "UNSUPPORTED_GA4_METRIC"))
    current = is_fresh(F.lit("GA4"), c("freshness_state"), c("collection_status"), c("as_of"), c("decision_day"))
    judged = rows.withColumn("problem", problem).withColumn("current", c("problem").isNull() & current)
    call = (c("metric") == "event_count") & c("current")
    classified = c("event_classification") == "CTA_INTERACTION"
    names = ["GA4_SOURCE_CLASS_MISMATCH", "GA4_URL_JOIN_MISMATCH", "WRONG_CHANNEL_SEGMENT", "SITE_WIDE_CONTEXT_ONLY", "UNSUPPORTED_GA4_METRIC"]
    folded = judged.groupBy("candidate_id").agg(
        F.count_if(c("problem").isNull()).alias("accepted"), F.count_if("current").alias("current_rows"),
        any_true(c("problem").isNull() & ~c("current")).alias("some_stale"),
        any_true(c("current") & (c("metric") == "sessions")).alias("has_sessions"), any_true(c("current") & (c("metric") == "engagement_rate")).alias("has_engagement"),
        any_true(call & ~F.coalesce(classified, F.lit(False))).alias("unmapped_event"), F.count_if(call & classified).alias("cta_rows"),
        F.sum(F.when(call & classified, c("value"))).alias("cta_events"), *[any_true(c("problem") == n).alias(n) for n in names])

    def trend(metric, name):
        chosen = judged.where(c("current") & (c("metric") == metric))
        return trend_signal(chosen, ["candidate_id"], "period_end", "value").select("candidate_id", c("signal").alias(name))

    joined = (targets.join(folded, "candidate_id", "left").join(trend("sessions", "traffic_signal"), "candidate_id", "left")
              .join(trend("engagement_rate", "engagement_signal"), "candidate_id", "left"))
    flags = ["some_stale", "has_sessions", "has_engagement", "unmapped_event", *names]
    filled = joined.withColumns({
        **{f: F.coalesce(f, F.lit(False)) for f in flags}, **{n: F.coalesce(n, F.lit(0)) for n in ("accepted", "current_rows", "cta_rows")},
        "traffic_signal": F.coalesce("traffic_signal", F.lit("INSUFFICIENT_HISTORY")),
        "engagement_signal": F.coalesce("engagement_signal", F.lit("INSUFFICIENT_HISTORY"))})
    search = F.when(c("gsc_current") > c("gsc_previous"), "INCREASING").when(c("gsc_current") < c("gsc_previous"), "DECLINING").when(
        c("gsc_current") == c("gsc_previous"), "STABLE")
    traffic, engagement = c("traffic_signal") == "DECLINING", c("engagement_signal") == "DECLINING"
    decided = filled.withColumns({
        "conflicts": F.array_sort(codes(
            *[(c(n) | ((c("quality_scope") == "SITE_WIDE_CONTEXT") & (c("accepted") > 0)) if n == "SITE_WIDE_CONTEXT_ONLY" else c(n), n) for n in names],
            (c("unmapped_event"), "CTA_EVENT_MAPPING_UNRESOLVED"),
            ((c("traffic_signal") == "CONFLICT") | (c("engagement_signal") == "CONFLICT"), "CONFLICTING_GA4_EVIDENCE"),
            (optional(targets, "external_figures", "boolean"), "AI_ASSISTANT_ATTRIBUTION_UNRESOLVED"),
            (c("traffic_signal").isin("INCREASING", "DECLINING", "STABLE") & (search != c("traffic_signal")), "GSC_GA4_ACQUISITION_BEHAVIOR_CONFLICT"))),
        "missing": F.array_sort(codes(
            (c("accepted") == 0, "page_level_organic_ga4_evidence"), (c("some_stale"), "fresh_current_ga4_evidence"),
            (~c("has_sessions"), "sessions"), (~c("has_engagement"), "engagement_rate"))),
        "cta_signal": F.when(c("cta_rows") == 0, "CTA_SIGNAL_NOT_AVAILABLE").when(c("cta_events") > 0, "CTA_SIGNAL_PRESENT").otherwise("CTA_SIGNAL_WEAK")})
    status = (F.when(F.size("conflicts") > 0, "CONFLICTING_GA4_EVIDENCE")
              .when((F.size("missing") > 0) | (c("current_rows") == 0), "INSUFFICIENT_GA4_EVIDENCE")
              .when(traffic & engagement, "QUALITY_WEAK").when(traffic | engagement, "QUALITY_MIXED").otherwise("QUALITY_HEALTHY"))
    return decided.withColumn("status", status).select(
        "candidate_id", "status", F.when(c("status").startswith("QUALITY"), "MEDIUM").otherwise("LOW").alias("diagnostic_confidence"),
        "traffic_signal", "engagement_signal", "cta_signal", "conflicts", "missing",
        F.array_sort(F.array_append(codes((traffic, "TRAFFIC_DECLINING"), (engagement, "ENGAGEMENT_DECLINING"), (c("engagement_signal") == "STABLE", "ENGAGEMENT_STABLE"),
                                          (c("cta_signal") == "CTA_SIGNAL_PRESENT", "CTA_SIGNAL_PRESENT"), (c("cta_signal") == "CTA_SIGNAL_WEAK", "CTA_SIGNAL_WEAK")), c("status"))).alias("types"))


def result_page(validations: DataFrame, snapshots: DataFrame, results: DataFrame) -> DataFrame:
    """Live result-page validation of each candidate, from its last accepted snapshot.

    ``validations``: ``candidate_id, query_id, query_problem, target_known, target_matches, expected_page_type,
    expected_intent, decision_day``; ``snapshots``: ``candidate_id, seq, snapshot_id, scope_ok, freshness_state,
    collection_status, as_of, features``; ``results``: ``snapshot_id, result_type, owned, competitor_id, match_state``.
    """
    c = F.col
    rows = join_spread(snapshots, validations.select("candidate_id", "decision_day"), "candidate_id", ["seq"])
    fresh = is_fresh(F.lit("SERP"), c("freshness_state"), c("collection_status"), c("as_of"), c("decision_day"), collections=("SUCCESS",))
    judged = rows.withColumns({"fresh": fresh, "accepted": fresh & c("scope_ok")})
    chosen = judged.groupBy("candidate_id").agg(
        any_true(~c("fresh")).alias("stale"), any_true(c("fresh") & ~c("scope_ok")).alias("out_of_scope"), F.count_if("accepted").alias("accepted"),
        F.max_by(F.struct("snapshot_id", "features"), F.when(c("accepted"), c("seq"))).alias("last"))
    kinds = results.select("snapshot_id", page_type(c("result_type")).alias("kind"), intent(c("result_type")).alias("intent"), "owned", "competitor_id", "match_state")
    totals = kinds.groupBy("snapshot_id").agg(
        F.count(F.lit(1)).alias("results"), F.count_if("owned").alias("owned"), F.count_distinct("competitor_id").alias("competitors"),
        any_true((c("match_state") == "UNMAPPED_DOMAIN") & ~c("owned")).alias("unknown_domain"))
    page = dominant_kind(kinds, ["snapshot_id"], "kind", "observed_page_type").drop("total")
    meaning = dominant_kind(kinds, ["snapshot_id"], "intent", "observed_intent").drop("total")
    seen = totals.join(page, "snapshot_id").join(meaning, "snapshot_id")
    joined = validations.join(chosen, "candidate_id", "left").withColumn("snapshot_id", c("last.snapshot_id")).join(seen, "snapshot_id", "left")
    filled = joined.withColumns({
        **{n: F.coalesce(n, F.lit(False)) for n in ("stale", "out_of_scope", "unknown_domain")}, **{n: F.coalesce(n, F.lit(0)) for n in ("accepted", "results", "owned", "competitors")},
        "observed_intent": F.coalesce("observed_intent", F.lit("UNKNOWN")), "features": F.coalesce("last.features", F.create_map().cast("map<string,string>"))})
    some = c("results") > 0
    crowded = F.exists(F.map_keys("features"), lambda k: k.isin(CROWDING_FEATURES)) & F.exists(F.map_values("features"), lambda v: v == "OBSERVED")
    decided = filled.withColumn("conflicts", F.array_sort(codes(
        (c("query_id").isNull(), "MISSING_VALIDATION_QUERY"),
        (c("query_id").isNotNull() & c("query_problem").isNotNull() & ~F.coalesce(c("query_problem").isin("LOCALE_MISMATCH", "COUNTRY_MISMATCH"), F.lit(False)), "QUERY_NOT_APPROVED"),
        (c("query_problem").isin("LOCALE_MISMATCH", "COUNTRY_MISMATCH") | c("out_of_scope"), "QUERY_SCOPE_MISMATCH"),
        (~c("target_known"), "UNRESOLVED_TARGET_URL"), (c("target_known") & ~c("target_matches"), "OWNED_ASSET_MISMATCH"), (c("stale"), "STALE_SERP_EVIDENCE"),
        (~some, "INSUFFICIENT_SERP_EVIDENCE"), (c("unknown_domain"), "UNKNOWN_COMPETITOR_DOMAIN"),
        (some & (c("owned") == 0) & (c("competitors") > 0), "COMPETITOR_DOMINANCE"),
        (some & (c("observed_page_type") != c("expected_page_type")), "PAGE_TYPE_MISMATCH"),
        (some & ~c("expected_intent").isin("UNKNOWN", "MIXED") & (c("observed_intent") != "MIXED") & (c("observed_intent") != c("expected_intent")), "INTENT_MISMATCH"),
        (some & crowded, "SERP_FEATURE_CROWDING"))))
    blocked = F.arrays_overlap("conflicts", F.array(F.lit("MISSING_VALIDATION_QUERY"), F.lit("QUERY_NOT_APPROVED"), F.lit("QUERY_SCOPE_MISMATCH")))
    status = (F.when(blocked, "SERP_NOT_CHECKED")
              .when(F.array_contains("conflicts", "INSUFFICIENT_SERP_EVIDENCE") & (c("accepted") == 0), "SERP_NOT_CHECKED")
              .when(F.size("conflicts") > 0, "SERP_CONFLICT").otherwise("SERP_VALIDATED"))
    return decided.withColumn("status", status).select(
        "candidate_id", "status", F.when(c("status") == "SERP_VALIDATED", "MEDIUM").when(c("status") == "SERP_CONFLICT", "LOW").otherwise("NOT_ASSESSABLE").alias("validation_confidence"),
        "observed_intent", "observed_page_type", F.when(c("owned") > 0, "PRESENT").when(c("accepted") > 0, "ABSENT").otherwise("NOT_AVAILABLE").alias("owned_presence"), "conflicts")


def visibility(targets: DataFrame, observations: DataFrame) -> DataFrame:
    """Fixed-sample AI-visibility diagnostic of each candidate.

    ``targets``: ``candidate_id, decision_day, serp_status``; ``observations``: ``candidate_id, mapping_state,
    scope_state, sample_version, mention_state, citation_state, owned_url_id, competitor_id, unknown_domain,
    freshness_state, collection_status, as_of``.  Observations may carry ``source``, ``source_class`` and ``metric``; one that
    is no observation of the monitored sample is a conflict and counts for nothing else.
    """
    c = F.col
    foreign = F.lit(False)
    for name, wanted in (("source", "WORKDUO"), ("source_class", SOURCE_CLASS["WORKDUO"]), ("metric", "geo_observation")):
        if name in observations.columns:
            foreign = foreign | ~c(name).eqNullSafe(F.lit(wanted))
    wrong = observations.where(foreign).select("candidate_id").distinct().withColumn("_wrong", F.lit(True))
    observations = observations.where(~foreign)
    rows = join_spread(observations, targets.select("candidate_id", "decision_day"), "candidate_id", ["as_of", "mention_state", "owned_url_id", "competitor_id"])
    usable = (c("mapping_state") == "MAPPED") & (c("scope_state") == "OK")
    fresh = is_fresh(F.lit("WORKDUO"), c("freshness_state"), c("collection_status"), c("as_of"), c("decision_day"))
    now = c("usable") & c("fresh")

    def every(condition):
        return F.coalesce(F.bool_and(F.when(now, F.coalesce(condition, F.lit(False)))), F.lit(False))

    def capability(state):
        s = c(state)
        return (F.when(any_true(now & (s == "OBSERVED")), "OBSERVED").when(every(s == "NOT_OBSERVED"), "NOT_OBSERVED")
                .when(any_true(now & (s == "NOT_AVAILABLE")), "NOT_AVAILABLE").otherwise("UNKNOWN"))

    failed = c("freshness_state").isin("FAILED", "NOT_AVAILABLE") | c("collection_status").isin("FAILED", "NOT_AVAILABLE")
    mapped = c("mapping_state") != "UNRESOLVED_PROMPT"
    folded = rows.withColumns({"usable": usable, "fresh": fresh}).groupBy("candidate_id").agg(
        F.count_if(now).alias("current_rows"), F.count_if(c("usable") & ~c("fresh")).alias("stale_rows"), F.count_if(now & c("owned_url_id").isNotNull()).alias("owned"),
        F.count_if(now & c("competitor_id").isNotNull()).alias("rivals"), any_true(failed).alias("failed"), any_true(~mapped).alias("unmapped_prompt"),
        any_true(mapped & (c("mapping_state") != "MAPPED")).alias("unmapped_topic"),
        (any_true((c("mapping_state") == "MAPPED") & (c("scope_state") != "OK"))
         | F.coalesce(F.min(F.when(mapped, c("sample_version"))) != F.max(F.when(mapped, c("sample_version"))), F.lit(False))).alias("gap"),
        any_true(now & ((c("mention_state") == "NOT_AVAILABLE") | (c("citation_state") == "NOT_AVAILABLE"))).alias("capability_gap"),
        any_true(now & c("unknown_domain")).alias("unknown_domain"), capability("mention_state").alias("mention_state"), capability("citation_state").alias("citation_state"))
    joined = targets.join(folded, "candidate_id", "left").join(wrong, "candidate_id", "left").withColumns({
        **{n: F.coalesce(n, F.lit(0)) for n in ("current_rows", "stale_rows", "owned", "rivals")},
        **{n: F.coalesce(n, F.lit(False)) for n in ("failed", "unmapped_prompt", "unmapped_topic", "gap", "capability_gap", "unknown_domain")},
        **{n: F.coalesce(n, F.lit("UNKNOWN")) for n in ("mention_state", "citation_state")}})
    base = (F.when((c("current_rows") == 0) & (c("stale_rows") == 0), "GEO_NOT_CHECKED").when(c("current_rows") == 0, "INSUFFICIENT_GEO_EVIDENCE")
            .when((c("owned") > 0) & (c("rivals") > 0), "GEO_STRONG").when((c("owned") > 0) & (c("current_rows") > 1), "GEO_STABLE").when(c("owned") > 0, "GEO_STRONG")
            .when(c("capability_gap"), "INSUFFICIENT_GEO_EVIDENCE").otherwise("GEO_WEAK"))
    crossed = (((c("serp_status") == "SERP_VALIDATED") & c("base").isin("GEO_WEAK", "INSUFFICIENT_GEO_EVIDENCE"))
               | ((c("serp_status") == "SERP_CONFLICT") & (c("base") == "GEO_STRONG")))
    return joined.withColumn("base", base).select(
        "candidate_id", F.when(c("gap"), "GEO_CONFLICT").otherwise(c("base")).alias("status"), "mention_state", "citation_state",
        F.when(c("owned") > 0, "PRESENT").when(c("current_rows") > 0, "ABSENT").otherwise("NOT_AVAILABLE").alias("owned_visibility"),
        F.array_sort(codes((c("_wrong"), "GEO_SOURCE_CLASS_MISMATCH"), (c("failed"), "PROVIDER_FAILURE"), (c("unmapped_prompt"), "UNMAPPED_PROMPT"), (c("unmapped_topic"), "UNMAPPED_TOPIC"),
                           (c("gap"), "COMPARABILITY_GAP"), (c("stale_rows") > 0, "STALE_GEO_EVIDENCE"), (c("capability_gap"), "CAPABILITY_GAP"),
                           (c("unknown_domain"), "UNKNOWN_COMPETITOR_DOMAIN"), (crossed, "CROSS_CHANNEL_CONFLICT"),
                           (crossed & (c("serp_status") == "SERP_VALIDATED"), "MIXED_SIGNAL"))).alias("conflicts"))
