"""Cross-field validation of candidates against the evidence they cite, all candidates at once.

``candidates`` carries the proposal columns; ``citations`` one row per (candidate_id, revision, evidence_id);
``evidence`` the immutable context: ``evidence_id, source, source_class, roles, freshness_state,
collection_status, as_of, conflict``; ``explanations``, where given, what each score band rests on: ``candidate_id,
revision, dimension, rationale, evidence_id``, one row per reference (a null ``evidence_id`` where a band has none).
"""

from pyspark.sql import Column, DataFrame, functions as F

from sightline.functions.hashing import is_reference
from sightline.functions.labels import lookup
from sightline.operators.quality import blank, codes
from sightline.schemas import DIMENSIONS, MAX_AGE_DAYS, SCORE_WEIGHTS, SOURCE_CLASS

# Dimension -> the evidence role behind it, and the profile of an action.
SCORE_ROLE = {"demand": "demand", "traction": "traction", "business": "business_relevance",
              "attainability": "attainability", "geo": "geo", "execution": "effort"}
ACTION_PROFILE = {"CREATE_NEW": "new", "GEO_ENHANCE": "geo"}
NEEDS_URL = ["UPDATE_EXISTING", "TECHNICAL_FIX", "INTERNAL_LINK", "SERP_SNIPPET_OPTIMIZE", "GEO_ENHANCE", "AUTHORITY_BUILD"]
EMPTY = "array<string>"


def cited(citations: DataFrame, evidence: DataFrame, decision_day: str) -> DataFrame:
    """What each candidate's citations resolve to: counts, families, covered roles, conflicts and staleness.

    Roles are folded through their short fixed list, so a candidate with very many citations stays one small row.
    """
    c = F.col
    context = evidence.select(c("evidence_id"), F.lit(True).alias("_known"), "source", "source_class", "roles", "freshness_state",
                              "collection_status", "as_of", "conflict")
    unique = citations.groupBy("candidate_id", "revision", "evidence_id").agg(F.count(F.lit(1)).alias("_copies"))
    rows = unique.join(context, "evidence_id", "left")
    known = c("_known").isNotNull()
    age = F.datediff(F.lit(decision_day).cast("date"), c("as_of"))
    fresh = F.coalesce((c("freshness_state") == "FRESH") & (c("collection_status") == "READY")
                       & age.between(0, lookup(c("source"), MAX_AGE_DAYS)), F.lit(False))
    fits = F.coalesce(lookup(c("source"), SOURCE_CLASS) == c("source_class"), F.lit(False))
    roles = sorted({*SCORE_ROLE.values(), "technical", "intent", "competitor", "inventory"})
    covered = F.array_compact(F.array(*[
        F.when(F.coalesce(F.bool_or(F.array_contains("roles", r)), F.lit(False)), r) for r in roles])).cast(EMPTY)
    families = sum((F.max(F.when(c("source") == name, 1).otherwise(0)) for name in SOURCE_CLASS), F.lit(0))
    return rows.groupBy("candidate_id", "revision").agg(
        F.coalesce(F.bool_or(c("_copies") > 1), F.lit(False)).alias("_duplicate"), F.count_if(~known).alias("_unresolved"),
        F.count_if(known).alias("_resolved"), families.alias("_families"), covered.alias("_covered"),
        F.coalesce(F.bool_or(known & F.coalesce(c("conflict"), F.lit(False))), F.lit(False)).alias("_conflict"),
        F.coalesce(F.bool_or(known & ~fresh), F.lit(False)).alias("_stale"),
        F.count_if(known & ~fits).alias("_misclassed"),
        F.coalesce(F.bool_or(~is_reference(c("evidence_id"))), F.lit(False)).alias("_unsafe"))


def explained(explanations: DataFrame, citations: DataFrame, evidence: DataFrame) -> DataFrame:
    """Dimensions of each candidate with a rationale and a reference, and with one that resolves to nothing it cites.

    References meet the citations on the evidence id as well, so a candidate with very many of both is dealt out.
    """
    c = F.col
    held = citations.select("candidate_id", "revision", "evidence_id").distinct().join(
        evidence.select("evidence_id").distinct(), "evidence_id", "left_semi").withColumn("_held", F.lit(True))
    rows = explanations.join(held, ["candidate_id", "revision", "evidence_id"], "left")
    said = ~blank("rationale")

    def dimensions(condition):
        return F.array_compact(F.array(*[F.when(F.coalesce(F.bool_or((c("dimension") == d) & condition), F.lit(False)), d) for d in DIMENSIONS])).cast(EMPTY)

    return rows.groupBy("candidate_id", "revision").agg(
        dimensions(said & c("evidence_id").isNotNull()).alias("_supported"),
        dimensions(said & c("evidence_id").isNotNull() & c("_held").isNull()).alias("_astray"))


def explanation_rules() -> list[tuple[Column, str]]:
    """An active band needs a rationale and references, each of which must be one of the candidate's own."""
    rules = []
    for d in DIMENSIONS:
        scored = (lookup(F.col("score_profile"), {p: w[d] for p, w in SCORE_WEIGHTS.items()}) > 0) & F.col(f"{d}_score").isNotNull()
        rules += [(scored & ~F.array_contains("_supported", d), f"MISSING_SCORE_EVIDENCE:{d}"),
                  (scored & F.array_contains("_astray", d), f"EVIDENCE_REF_MISSING:{d}")]
    return rules


def score_rules() -> list[tuple[Column, str]]:
    """Score rules: known profile, bands in range, inactive bands empty, bounds and score as the weights give them."""
    c = F.col
    profile = c("score_profile")
    rules = [(~profile.isin(list(SCORE_WEIGHTS)), "UNKNOWN_SCORING_PROFILE")]
    observed, missing = F.lit(0.0), F.lit(0)
    for d in DIMENSIONS:
        band = c(f"{d}_score")
        weight = lookup(profile, {p: w[d] for p, w in SCORE_WEIGHTS.items()})
        active = weight > 0
        rules += [((weight == 0) & band.isNotNull(), f"INACTIVE_SCORE_DIMENSION:{d}"),
                  (active & ~band.between(0, 4), f"SCORE_OUT_OF_RANGE:{d}"),
                  (active & band.isNotNull() & (~F.array_contains("_covered", SCORE_ROLE[d]) | F.array_contains("missing_roles", SCORE_ROLE[d])),
                   f"MISSING_DATA_NOT_ZERO:{d}")]
        observed = observed + F.coalesce(F.when(active & band.between(0, 4), weight * band / 4), F.lit(0.0))
        missing = missing + F.coalesce(F.when(active & band.isNull(), weight), F.lit(0))
    wanted = F.when(missing == 0, F.floor(observed + 0.5))
    return rules + [(c("score_lower_bound") != F.floor(observed), "SCORE_MISMATCH:lower"),
                    (c("score_upper_bound") != F.ceil(observed + missing), "SCORE_MISMATCH:upper"),
                    (~c("opportunity_score").eqNullSafe(wanted), "SCORE_MISMATCH:score")]


def validate(candidates: DataFrame, citations: DataFrame, evidence: DataFrame, decision_day: str, explanations: DataFrame | None = None) -> DataFrame:
    """Add ``errors``: every rule a candidate breaks, and ``warnings`` for stale evidence before validation.

    The rules on what score bands rest on apply where ``explanations`` are given.
    """
    c = F.col
    resolved = cited(citations, evidence, decision_day)
    joined = candidates.join(resolved, ["candidate_id", "revision"], "left").withColumns({
        **{n: F.coalesce(n, F.lit(0)) for n in ("_unresolved", "_resolved", "_families", "_misclassed")},
        **{n: F.coalesce(n, F.lit(False)) for n in ("_duplicate", "_conflict", "_stale", "_unsafe")},
        "_covered": F.coalesce("_covered", F.array().cast(EMPTY))})
    if explanations is not None:
        joined = joined.join(explained(explanations, citations, evidence), ["candidate_id", "revision"], "left").withColumns(
            {n: F.coalesce(n, F.array().cast(EMPTY)) for n in ("_supported", "_astray")})
    settled = c("status").isin("VALIDATED", "APPROVED")
    action, profile = c("recommended_action"), F.coalesce(lookup(c("recommended_action"), ACTION_PROFILE), F.lit("existing"))
    idle = action.isin("MONITOR", "DO_NOTHING")
    urls = F.size("existing_urls")
    lacking = F.size("missing_roles") > 0
    low = c("confidence").isin("LOW", "NOT_ASSESSABLE")
    open_state = c("validation_state").isin("INSUFFICIENT_EVIDENCE", "CONFLICTING_EVIDENCE")
    uncovered = F.size(F.array_except(F.array_except("required_roles", "missing_roles"), "_covered")) > 0
    rules = [
        (~F.coalesce(c("period").rlike(r"^20\d{2}-(0[1-9]|1[0-2])$"), F.lit(False)), "INVALID_PERIOD"),
        (~is_reference(c("candidate_id")) | c("_unsafe"), "INVALID_IDENTIFIER"),
        (c("content_hash") != c("expected_hash"), "CONTENT_HASH_MISMATCH"),
        (c("created_at") > c("updated_at"), "INVALID_DATE_ORDER"),
        (F.greatest(F.to_date("created_at"), F.to_date("updated_at")) > F.lit(decision_day).cast("date"), "FUTURE_TIMESTAMP"),
        (((c("revision") == 1) & c("supersedes_revision").isNotNull())
         | ((c("revision") > 1) & ~c("supersedes_revision").eqNullSafe(c("revision") - 1)), "INVALID_REVISION_CHAIN"),
        (c("_duplicate"), "DUPLICATE_EVIDENCE_REF"), (c("_unresolved") > 0, "EVIDENCE_REF_MISSING"),
        (c("_conflict") != F.coalesce(c("declares_conflict"), F.lit(False)), "EVIDENCE_CONFLICT"),
        (c("_stale") & settled, "STALE_EVIDENCE_POLICY_VIOLATION"),
        (c("evidence_count") != c("_resolved"), "EVIDENCE_COUNT_MISMATCH"),
        (c("independent_family_count") != c("_families"), "EVIDENCE_FAMILY_COUNT_MISMATCH"),
        (uncovered, "MISSING_REQUIRED_EVIDENCE:role"), (F.arrays_overlap("missing_roles", "_covered"), "EVIDENCE_STATE_CONFLICT"),
        (c("_misclassed") > 0, "SOURCE_CLASS_CONFLICT"), *score_rules(), *(explanation_rules() if explanations is not None else []),
        (~idle & (c("score_profile") != profile), "INVALID_ACTION_FOR_OPPORTUNITY:profile"),
        ((action == "CREATE_NEW") & (urls > 0), "CREATE_NEW_EXISTING_URL_CONFLICT"),
        (action.isin(NEEDS_URL) & settled & (urls == 0), "INVALID_ACTION_FOR_OPPORTUNITY:url"),
        ((action == "CONSOLIDATE") & settled & ((urls < 2) | c("target_url").isNull()), "INVALID_ACTION_FOR_OPPORTUNITY:consolidate"),
        ((action == "CONSOLIDATE") & settled & c("measurement_plan_ref").isNull(), "POLICY_GAP"),
        (idle & c("review_at").isNull(), "INVALID_ACTION_FOR_OPPORTUNITY:review_at"),
        ((action == "DO_NOTHING") & (open_state | lacking | F.coalesce(c("declares_conflict"), F.lit(False))), "INVALID_ACTION_FOR_OPPORTUNITY:hidden"),
        ((c("status") == "DISCOVERED") & (c("_families") < 1), "MISSING_REQUIRED_EVIDENCE:discovered"),
        (c("status").isin("CANDIDATE", "VALIDATED", "APPROVED") & (c("_families") < 2), "MISSING_REQUIRED_EVIDENCE:families"),
        (settled & (lacking | c("_conflict") | c("_stale")), "MISSING_REQUIRED_EVIDENCE:open"),
        (settled & (c("validation_state") != "PASS"), "INVALID_VALIDATION_STATE"),
        (settled & ~c("confidence").isin("MEDIUM", "HIGH"), "CONFIDENCE_EVIDENCE_MISMATCH:settled"),
        (c("_conflict") & (c("validation_state") != "CONFLICTING_EVIDENCE"), "EVIDENCE_CONFLICT:state"),
        (c("_conflict") & ~low, "CONFIDENCE_EVIDENCE_MISMATCH:conflict"),
        ((lacking | c("_stale")) & ~open_state, "CONFIDENCE_EVIDENCE_MISMATCH:open"),
        ((lacking | c("_stale")) & ~low & settled, "CONFIDENCE_EVIDENCE_MISMATCH:low"),
        ((c("confidence") == "HIGH") & ((c("_families") < 2) | c("_conflict") | c("_stale") | ~c("mapping_confirmed") | ~c("alternatives_addressed")),
         "CONFIDENCE_EVIDENCE_MISMATCH:high"),
        (c("business_score").isNotNull() & ~F.coalesce(c("business_overlay_approved"), F.lit(False)), "MISSING_BUSINESS_EVIDENCE"),
        ((c("status") == "APPROVED") & ~F.coalesce(c("review_authenticated"), F.lit(False)), "APPROVAL_EVIDENCE_MISSING:review"),
        ((c("status") == "APPROVED") & c("review_authenticated") & (
            (c("review_decision") != "APPROVED") | ~c("reviewed_revision").eqNullSafe(c("revision")) | ~c("reviewed_hash").eqNullSafe(c("content_hash"))),
         "INVALID_REVIEW_STATE"),
        ((c("status") == "APPROVED") & (~F.coalesce(c("scope_approved"), F.lit(False)) | c("measurement_plan_ref").isNull()), "APPROVAL_EVIDENCE_MISSING:scope"),
    ]
    return joined.withColumns({"errors": codes(*rules), "warnings": codes((c("_stale") & ~settled, "STALE_EVIDENCE_POLICY_VIOLATION"))}).drop(
        *[n for n in joined.columns if n.startswith("_")])
