"""Opportunity rules, score and confidence for all topics at once.

``bundles`` holds one row per topic under evaluation: ``bundle_id, project_scope_id, topic_id, search_intent,
requested_type, decision_at, evaluation_period, existing_urls, mapping_confirmed, mapping_approved,
alternatives_addressed``.  ``evidence`` holds one row per record: ``bundle_id, seq, evidence_id, revision,
content_hash, source, topic_id, topic_refs, urls, freshness_state, collection_status, conflict, volume,
impressions, position, ctr, coverage, attainability_band, execution_band, issues, windows``.

Evidence is brought to its bundle by one join on ``bundle_id``; every rule is then an expression over one row of
aggregates per bundle.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.functions import hashing
from sightline.functions.labels import traction_band, volume_band
from sightline.functions.numbers import half_up
from sightline.operators.joins import join_spread, url_matches
from sightline.schemas import SCORE_WEIGHTS, SOURCE_CLASS

# --- Fixed values: thresholds of the rules ----------------------------------------------------------------
CTR_IMPRESSIONS = 500
KEEP = 0.8
DECAY_WINDOWS = 6
REVIEW_DAYS = 28
SEVERE = ["CRITICAL", "HIGH"]
SNIPPET_ISSUES = ["TITLE", "META", "SNIPPET"]
POLICY_GAPS = ["AHREFS_CONTENT_GAP_UNAVAILABLE", "DERIVED_COMPETITIVE_GAP_POLICY_UNAPPROVED"]

NO_TEXT = "array<string>"


def texts(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values]).cast(NO_TEXT)


def scoped_evidence(bundles: DataFrame, evidence: DataFrame) -> DataFrame:
    """Evidence with its bundle's target and the flags every rule needs."""
    target = F.when(F.size("existing_urls") > 0, F.array_sort("existing_urls")[0])
    asked = bundles.select("bundle_id", F.col("topic_id").alias("_topic"), target.alias("target_url"))
    refs = F.coalesce("topic_refs", F.array().cast(NO_TEXT))
    topical = ((F.col("topic_id") == F.col("_topic")) | F.array_contains(refs, F.col("_topic"))
               | (F.col("topic_id").isNull() & (F.size(refs) == 0)))
    fresh = (F.upper("freshness_state") == "READY") & F.upper(F.coalesce("collection_status", F.lit("SUCCESS"))).isin("SUCCESS", "READY")
    issues = F.coalesce("issues", F.array().cast("array<struct<type:string,severity:string>>"))
    return join_spread(evidence, asked, "bundle_id", ["seq"]).withColumns({
        "on_topic": F.coalesce(topical, F.lit(False)), "on_url": url_matches(F.col("urls"), F.col("target_url")),
        "fresh": F.coalesce(fresh, F.lit(False)), "source": F.upper("source"),
        "severe": F.exists(issues, lambda i: F.upper(i["severity"]).isin(SEVERE)),
        "snippet_issue": F.exists(issues, lambda i: F.upper(i["type"]).isin(SNIPPET_ISSUES)),
        "conflicting": F.coalesce("conflict", F.lit(False)) | (F.upper("freshness_state") == "CONFLICTING")}).drop("_topic")


CELL = ["source", "on_topic", "on_url", "fresh", "conflicting", "severe", "snippet_issue"]
# Values of which a rule wants the first in evidence order; those of one group come from one record.
FIRSTS = {"volume": ["volume"], "impressions": ["impressions"], "position": ["position"],
          "search": ["impressions", "position", "ctr", "complete"], "attainability": ["attainability_band"], "execution": ["execution_band"],
          "current": ["current_impressions", "current_ctr", "current_position"], "previous": ["previous_impressions", "previous_ctr", "previous_position"]}


def evidence_cells(scoped: DataFrame) -> DataFrame:
    """Evidence of a bundle folded into its few distinct kinds of record.

    Everything the rules, the score and the signature need is a sum or a first value by ``seq`` over these cells,
    so evidence is scanned and shuffled once, combined on the map side; a bundle holding very much evidence leaves
    each partition as a few dozen rows.  All buffers are plain numbers, which keeps the aggregation hash-based.
    """
    c = F.col

    def window(role):
        return F.get(F.filter("windows", lambda w: w["role"] == role), F.lit(0))

    flat = scoped.withColumns({r: window(r) for r in ("current", "previous")}).withColumns({
        **{f"{r}_{m}": c(f"{r}.{m}") for r in ("current", "previous") for m in ("impressions", "ctr", "position")},
        "complete": F.coalesce(c("coverage") == "COMPLETE_WITHIN_SCOPE", F.lit(False))})
    usable = {"volume": c("volume").isNotNull(), "impressions": c("impressions").isNotNull(), "position": c("position").isNotNull(),
              "search": c("impressions").isNotNull() & c("position").isNotNull(), "attainability": c("attainability_band").between(0, 4),
              "execution": c("execution_band").between(0, 4), "current": c("current").isNotNull(), "previous": c("previous").isNotNull()}
    firsts = [x for name, values in FIRSTS.items() for x in (
        F.min(F.when(usable[name], c("seq"))).alias(f"{name}_seq"),
        *[F.min_by(v, F.when(usable[name], c("seq"))).alias(f"{name}__{v}") for v in values])]
    pin = ["evidence_id", "revision", "content_hash"]
    return flat.groupBy("bundle_id", *CELL).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.greatest(F.size("windows"), F.lit(0))).alias("windows"), *firsts,
        F.sum(F.xxhash64(*pin).cast("decimal(38,0)")).alias("w0"), F.sum(F.xxhash64(F.lit("pin"), *pin).cast("decimal(38,0)")).alias("w1"))


def click_history(scoped: DataFrame) -> DataFrame:
    """Mean clicks of the last two windows and of the two before them; ``row_number`` prunes to four before the shuffle."""
    rows = scoped.where("on_topic AND on_url AND source = 'GSC'").select("bundle_id", "seq", F.posexplode("windows").alias("pos", "w"))
    latest = Window.partitionBy("bundle_id").orderBy(F.desc("w.period_end"), F.desc("seq"), F.desc("pos"))
    tail = rows.withColumn("rn", F.row_number().over(latest)).where("rn <= 4")
    return tail.groupBy("bundle_id").agg(
        F.count("w.clicks").alias("known_clicks"), F.avg(F.when(F.col("rn") <= 2, F.col("w.clicks"))).alias("recent"),
        F.avg(F.when(F.col("rn") > 2, F.col("w.clicks"))).alias("baseline"))


def rule_inputs(bundles: DataFrame, cells: DataFrame, history: DataFrame) -> DataFrame:
    """One row of rule inputs per bundle."""
    c = F.col
    here = c("on_topic") & c("on_url")

    def total(condition, column="n"):
        return F.coalesce(F.sum(F.when(condition, c(column))), F.lit(0))

    def first(name, condition):
        values = FIRSTS[name]
        whole = F.min(F.when(condition & c(f"{name}_seq").isNotNull(), F.struct(f"{name}_seq", *[f"{name}__{v}" for v in values])))
        if len(values) == 1:
            return whole[f"{name}__{values[0]}"]
        return F.when(whole.isNotNull(), F.struct(*[whole[f"{name}__{v}"].alias(v.removeprefix(f"{name}_")) for v in values]))

    sf, ahrefs, gsc = (c("source") == name for name in ("SF", "AHREFS", "GSC"))
    counts = cells.groupBy("bundle_id").agg(
        total(here & sf).alias("n_sf"), total(here & ahrefs).alias("n_ahrefs"), total(here & gsc).alias("n_gsc"), total(here & sf & c("severe")).alias("n_severe"),
        total(here & sf & c("snippet_issue")).alias("n_snippet"), total(here & (sf | ahrefs | gsc) & ~c("fresh")).alias("n_not_fresh"), total(c("on_topic") & c("fresh")).alias("n_fresh"),
        total(here & gsc, "windows").alias("n_windows"), first("current", here & gsc).alias("now"), first("previous", here & gsc).alias("before"),
        first("volume", here & ahrefs).alias("volume"), first("impressions", here & gsc).alias("impressions"), first("position", here & gsc).alias("position"),
        first("volume", c("on_url") & ahrefs).alias("score_volume"), first("search", c("on_url") & gsc).alias("score_search"),
        first("attainability", F.lit(True)).alias("attainability"), first("execution", c("on_url") & sf).alias("execution"))
    joined = bundles.join(counts, "bundle_id", "left").join(history, "bundle_id", "left")
    return joined.withColumns({
        **{n: F.coalesce(n, F.lit(0)) for n in counts.columns if n.startswith("n_")},
        "target_url": F.when(F.size("existing_urls") > 0, F.array_sort("existing_urls")[0])})


def inputs_of(bundles: DataFrame, evidence: DataFrame) -> DataFrame:
    scoped = scoped_evidence(bundles, evidence)
    return rule_inputs(bundles, evidence_cells(scoped), click_history(scoped))


# --- Rules ------------------------------------------------------------------------------------------------

def decision(kind: str, action: str, rule: str, selection: str, required=(), missing: Column | None = None,
             failed=(), matched=(), review: bool = False) -> Column:
    """Outcome of a rule; ``selection`` names which evidence it rests on."""
    return F.struct(
        F.lit(kind).alias("opportunity_type"), F.lit(action).alias("recommended_action"), F.lit(rule).alias("rule_id"),
        F.lit(selection).alias("selection"), texts(*sorted(required)).alias("required_roles"),
        (texts() if missing is None else F.array_sort(F.array_compact(missing)).cast(NO_TEXT)).alias("missing_roles"),
        texts(*sorted(failed)).alias("failed"), texts(*sorted(matched)).alias("matched"), F.lit(review).alias("needs_review_date"))


def technical_unlock() -> Column:
    """A severe crawl issue on a URL whose topic is searched for; without demand it is only watched."""
    c = F.col
    watched = decision("DO_NOTHING", "MONITOR", "SEO-TECH-001", "SF", ["technical", "demand"], texts("demand"),
                       ["technical_issue_has_no_search_intersection"], review=True)
    found = decision("TECHNICAL_UNLOCK", "TECHNICAL_FIX", "SEO-TECH-001", "SF_AHREFS_GSC", ["technical", "demand"],
                     F.array(F.when(c("n_not_fresh") > 0, "freshness")), matched=["url_specific_technical_issue", "search_demand_intersection"])
    return F.when(c("n_severe") > 0, F.when(c("n_ahrefs") + c("n_gsc") == 0, watched).otherwise(found))


def ctr_opportunity() -> Column:
    """Many impressions at a steady position, a fallen click-through rate, and a title or snippet issue."""
    c = F.col
    applies = (c("n_gsc") > 0) & (c("n_snippet") > 0) & c("now").isNotNull() & c("before").isNotNull()
    figures = [c("now.impressions"), c("now.ctr"), c("before.ctr"), c("now.position"), c("before.position")]
    known = hashing.all_of([f.isNotNull() for f in figures])
    fell = (c("before.ctr") > 0) & (c("now.ctr") <= c("before.ctr") * KEEP)
    steady = F.abs(c("now.position") - c("before.position")) <= 1
    incomplete = decision("DO_NOTHING", "MONITOR", "SEO-CTR-001", "GSC_SNIPPET", ["traction", "technical"], texts("traction"),
                          ["complete_two_window_ctr_metrics"], review=True)
    found = decision("CTR_OPPORTUNITY", "SERP_SNIPPET_OPTIMIZE", "SEO-CTR-001", "GSC_SNIPPET", ["traction", "technical"],
                     matched=["high_impressions", "stable_position", "ctr_underperformance", "title_or_meta_issue"])
    return F.when(applies & ~known, incomplete).when(applies & (c("now.impressions") >= CTR_IMPRESSIONS) & steady & fell, found)


def content_decay() -> Column:
    """Clicks of the last two windows a fifth below the two before, over at least six windows."""
    c = F.col
    some = c("n_windows") > 0
    short = decision("CONTENT_DECAY", "MONITOR", "SEO-DECAY-001", "GSC_SF", ["traction"], texts("historical_traction"), ["six_complete_months"], review=True)
    gaps = decision("CONTENT_DECAY", "MONITOR", "SEO-DECAY-001", "GSC_SF", ["traction"], texts("traction"), ["complete_click_history"], review=True)
    found = decision("CONTENT_DECAY", "UPDATE_EXISTING", "SEO-DECAY-001", "GSC_SF", ["traction"], matched=["six_month_window", "two_period_deterioration"])
    fell = (c("baseline") > 0) & (c("recent") <= c("baseline") * KEEP)
    return F.when(some & (c("n_windows") < DECAY_WINDOWS), short).when(some & (c("known_clicks") < 4), gaps).when(some & fell, found)


def quick_win() -> Column:
    """An existing URL with keyword and search data; live intent is always still to be checked."""
    c = F.col
    missing = F.array(
        F.when(c("volume").isNull(), "demand"), F.when(c("impressions").isNull() | c("position").isNull(), "traction"),
        F.when(c("n_sf") == 0, "technical"), F.when(~(c("mapping_confirmed") & c("mapping_approved")), "mapping_review"), F.lit("intent"))
    found = decision("QUICK_WIN", "UPDATE_EXISTING", "SEO-QUICK-001", "SF_AHREFS_GSC", ["demand", "traction", "technical", "intent"], missing,
                     ["required_quick_win_conditions"], ["existing_asset"])
    return F.when((c("n_ahrefs") > 0) & (c("n_gsc") > 0) & (F.size("existing_urls") > 0), found)


RULES = [("TECHNICAL_UNLOCK", technical_unlock), ("CTR_OPPORTUNITY", ctr_opportunity),
         ("CONTENT_DECAY", content_decay), ("QUICK_WIN", quick_win)]


def fallback() -> Column:
    """What is left when no rule speaks: watch what was asked for, watch without current data, or do nothing."""
    c = F.col
    asked = c("requested_type").isNotNull() & ~c("requested_type").isin("DO_NOTHING", "CONTENT_GAP")
    unavailable = decision("", "MONITOR", "", "NONE", missing=texts("required_evidence"), review=True)
    unavailable = unavailable.withField("opportunity_type", c("requested_type")).withField(
        "rule_id", F.concat(F.lit("SEO-"), "requested_type", F.lit("-UNAVAILABLE")))
    stale = decision("DO_NOTHING", "MONITOR", "SEO-DO-NOTHING-001", "TOPIC", missing=texts("required_evidence"), failed=["current_evidence_available"], review=True)
    nothing = decision("DO_NOTHING", "DO_NOTHING", "SEO-DO-NOTHING-001", "TOPIC_FRESH", matched=["no_supported_opportunity_rule"], review=True)
    return F.when(asked, unavailable).when(c("n_fresh") == 0, stale).otherwise(nothing)


def content_gap() -> Column:
    """A requested content gap has no approved policy behind it and yields no candidate."""
    return decision("CONTENT_GAP", "CREATE_NEW", "SEO-GAP-001", "AHREFS", ["demand", "competitor", "inventory"], texts("competitor", "inventory"))


def evaluate(inputs: DataFrame) -> DataFrame:
    """First rule that speaks, in fixed order, per bundle."""
    wanted = F.col("requested_type")
    ruled = [F.when(wanted.isNull() | (wanted == name), rule()) for name, rule in RULES]
    chosen = F.when(wanted == "CONTENT_GAP", content_gap()).otherwise(F.coalesce(*ruled, fallback()))
    gap = F.col("opportunity_type") == "CONTENT_GAP"
    # A generator keeps the optimizer from copying the whole rule expression into every field taken from it.
    return inputs.select("*", F.inline(F.array(chosen))).withColumns({
        "policy_gaps": F.when(gap, texts(*POLICY_GAPS)).otherwise(texts()),
        "target_url": F.when(~gap, F.col("target_url")),
        "review_at": F.when(F.col("needs_review_date"), F.date_add(F.to_date("decision_at"), REVIEW_DAYS))}).drop("needs_review_date")


# --- Evidence behind a decision ---------------------------------------------------------------------------

def selected(decisions: DataFrame, rows: DataFrame) -> DataFrame:
    """The evidence, or the cells of it, that each decision rests on."""
    c = F.col
    chosen = c("selection")
    url = c("on_topic") & c("on_url")
    return rows.join(decisions.select("bundle_id", "selection"), "bundle_id").where(
        F.when(chosen == "SF", url & (c("source") == "SF"))
        .when(chosen == "SF_AHREFS_GSC", url & c("source").isin("SF", "AHREFS", "GSC"))
        .when(chosen == "GSC_SNIPPET", url & ((c("source") == "GSC") | ((c("source") == "SF") & c("snippet_issue"))))
        .when(chosen == "GSC_SF", url & c("source").isin("GSC", "SF"))
        .when(chosen == "AHREFS", c("on_topic") & (c("source") == "AHREFS"))
        .when(chosen == "TOPIC", c("on_topic")).when(chosen == "TOPIC_FRESH", c("on_topic") & c("fresh"))
        .otherwise(False))


def support(decisions: DataFrame, cells: DataFrame) -> DataFrame:
    """Counts and an order-free signature of the evidence each decision rests on."""
    c = F.col
    rows = selected(decisions, cells)
    words = [F.sum(w).cast("string") for w in ("w0", "w1")]
    return rows.groupBy("bundle_id").agg(
        F.sum("n").alias("evidence_count"),
        sum((F.max(F.when(c("source") == name, 1).otherwise(0)) for name in SOURCE_CLASS), F.lit(0)).cast("long").alias("independent_family_count"),
        F.coalesce(F.sum(F.when(~c("fresh"), c("n"))), F.lit(0)).alias("stale_count"), F.coalesce(F.sum(F.when(c("conflicting"), c("n"))), F.lit(0)).alias("conflict_count"),
        F.sha2(F.concat_ws(",", *words), 256).alias("evidence_signature"))


def source_references(decisions: DataFrame, scoped: DataFrame) -> DataFrame:
    """One pin per source family behind each decision: the last evidence id in order."""
    rows = selected(decisions, scoped)
    return rows.groupBy("bundle_id").agg(*[
        F.max(F.when(F.col("source") == s, F.col("evidence_id"))).alias(f"{s.lower()}_evidence_ref") for s in ("AHREFS", "GSC", "SF")])


# --- Score and confidence ---------------------------------------------------------------------------------

def score(rows: DataFrame, profile: Column, bands: dict[str, Column]) -> DataFrame:
    """Weighted score of the bands, or the interval it must lie in while a weighted band is missing."""
    def weight(dimension):
        choice = F.lit(0)
        for name, weights in SCORE_WEIGHTS.items():
            choice = F.when(profile == name, weights[dimension]).otherwise(choice)
        return choice

    scored = {d: F.when(weight(d) > 0, band) for d, band in bands.items()}
    observed = sum((F.coalesce(weight(d) * scored[d] / 4, F.lit(0.0)) for d in bands), F.lit(0.0))
    missing = sum((F.when((weight(d) > 0) & scored[d].isNull(), weight(d)).otherwise(0) for d in bands), F.lit(0))
    return rows.withColumns({
        "score_profile": profile, **{f"{d}_score": band.cast("int") for d, band in scored.items()}}).withColumns({
        "opportunity_score": F.when(missing == 0, half_up(observed)),
        "score_lower_bound": F.floor(observed), "score_upper_bound": F.ceil(observed + missing)})


def candidate_score(decisions: DataFrame) -> DataFrame:
    """Score of rule-engine candidates, whose business and visibility bands are never known here."""
    s = F.col("score_search")
    none = F.lit(None).cast("int")
    profile = F.when(F.col("recommended_action") == "CREATE_NEW", "new").otherwise("existing")
    return score(decisions, profile, {
        "demand": volume_band(F.col("score_volume")), "traction": traction_band(s["impressions"], s["position"], s["ctr"], F.when(s["complete"], "COMPLETE_WITHIN_SCOPE")),
        "business": none, "attainability": F.col("attainability"), "geo": none, "execution": F.col("execution")})


def confidence(rows: DataFrame) -> DataFrame:
    """Confidence and validation state from conflicts, staleness, missing roles, families and mapping review."""
    c = F.col
    weak = (c("stale_count") > 0) | (F.size("missing_roles") > 0) | (c("independent_family_count") < 2) | ~c("mapping_confirmed")
    full = c("alternatives_addressed") & c("mapping_approved")
    return rows.withColumns({
        "confidence": F.when((c("conflict_count") > 0) | weak, "LOW").when(full, "HIGH").otherwise("MEDIUM"),
        "validation_state": F.when(c("conflict_count") > 0, "CONFLICTING_EVIDENCE").when(weak, "INSUFFICIENT_EVIDENCE").otherwise("PASS")})


# --- Candidates -------------------------------------------------------------------------------------------

def candidate_id(rows: DataFrame) -> Column:
    asset = F.coalesce("target_url", F.when(F.size("existing_urls") > 0, F.array_join(F.array_sort("existing_urls"), "|")), "topic_id")
    return hashing.stable_id("OPP", {
        "project_scope_id": F.col("project_scope_id"), "topic_cluster_id": F.col("topic_id"), "primary_intent": F.coalesce("search_intent", F.lit("UNKNOWN")),
        "primary_action": F.col("recommended_action"), "target_asset_key": asset})


SEMANTIC = ["candidate_id", "revision", "topic_id", "opportunity_type", "recommended_action", "target_url", "rule_id", "missing_roles", "required_roles",
            "opportunity_score", "score_lower_bound", "score_upper_bound", "confidence", "validation_state", "evidence_count",
            "independent_family_count", "input_signature"]


def candidates(bundles: DataFrame, evidence: DataFrame, stored: DataFrame | None = None) -> DataFrame:
    """Candidate of every bundle: decision, score, confidence, pins, revision and content hash.

    ``stored`` is the candidate log.  Unchanged input keeps its revision; changed input takes the next one.
    """
    c = F.col
    scoped = scoped_evidence(bundles, evidence)
    cells = evidence_cells(scoped)
    decisions = evaluate(rule_inputs(bundles, cells, click_history(scoped)))
    backing = support(decisions, cells)
    joined = decisions.join(backing, "bundle_id", "left").withColumns({
        n: F.coalesce(n, F.lit(0).cast("long")) for n in ("evidence_count", "independent_family_count", "stale_count", "conflict_count")})
    augmented = joined.withColumn("missing_roles", F.array_sort(F.array_union(
        "missing_roles", F.when(c("stale_count") > 0, texts("freshness")).otherwise(texts()))))
    judged = confidence(candidate_score(augmented)).where(F.size("policy_gaps") == 0)
    lacking = (c("validation_state") == "INSUFFICIENT_EVIDENCE") & (F.size("missing_roles") == 0)
    completed = judged.withColumn("candidate_id", candidate_id(judged)).withColumn(
        "missing_roles", F.when(lacking, texts("required_evidence")).otherwise(c("missing_roles"))).withColumns({
        "recommended_action": F.when((c("recommended_action") == "DO_NOTHING") & (F.size("missing_roles") > 0), "MONITOR").otherwise(c("recommended_action")),
        "status": F.when(c("independent_family_count") >= 2, "CANDIDATE").otherwise("DISCOVERED"), "review_state": F.lit("NOT_SUBMITTED")})
    signed = completed.withColumn("input_signature", F.sha2(F.concat_ws(
        "|", "topic_id", "rule_id", "recommended_action", F.coalesce("target_url", F.lit("")), F.coalesce("evidence_signature", F.lit(""))), 256))
    if stored is None:
        revised = signed.withColumn("revision", F.lit(1).cast("long"))
    else:
        tips = stored.groupBy("candidate_id").agg(F.max("revision").alias("_tip"), F.max_by("input_signature", "revision").alias("_signature"))
        same = c("_signature") == c("input_signature")
        revised = signed.join(tips, "candidate_id", "left").withColumn("revision", F.coalesce(
            F.when(same, c("_tip")).otherwise(c("_tip") + 1), F.lit(1)).cast("long")).drop("_tip", "_signature")
    return revised.withColumn("supersedes_revision", F.when(c("revision") > 1, c("revision") - 1)).withColumn(
        "content_hash", hashing.row_hash(revised, SEMANTIC, as_object=True))
