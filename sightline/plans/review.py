"""Human review gates, recommendation bridges, review status and write plans over tables of records."""

from pyspark.sql import DataFrame, functions as F

from sightline.functions.hashing import REFERENCE_FORMAT, is_hash, is_reference
from sightline.operators.quality import codes, first_code, optional
from sightline.operators.revisions import idempotency

# Review decisions and the status they give.
REVIEW_STATUS = {"APPROVE": "APPROVED", "REJECT": "REJECTED", "NEEDS_MORE_EVIDENCE": "NEEDS_MORE_EVIDENCE", "DEFER": "DEFERRED",
                 "RETURN_FOR_REVIEW": "RETURNED_FOR_REVIEW"}
TARGET_ENVIRONMENTS = ["UAT", "PREVIEW"]


def review_errors(reviews: DataFrame) -> DataFrame:
    """First reason a review record is unacceptable on its own, or null."""
    c = F.col
    return reviews.withColumn("problem", first_code(
        (~F.coalesce(c("decision").isin(list(REVIEW_STATUS)), F.lit(False)), "INVALID_DECISION"),
        (~is_reference(c("reason_code")), "INVALID_REASON_CODE"), (~is_reference(c("reviewer_id")), "INVALID_REVIEWER"),
        (c("created_at") > c("decision_at"), "INVALID_DATE_ORDER"), ((c("revision") < 1) | c("revision").isNull(), "INVALID_REVIEW_REVISION"),
        (F.char_length("notes") > 4000, "INVALID_REVIEW_NOTES"), (c("preview_hash").isNotNull() & ~is_hash(c("preview_hash")), "INVALID_PREVIEW_HASH"),
        (c("conflict_adjudication_ref").isNotNull() & ~is_reference(c("conflict_adjudication_ref")), "INVALID_ADJUDICATION_REF")))


# Length of a recommendation's text, and where it may come from.
TEXT_LIMIT = 4000
PROVENANCES = ["HUMAN_AUTHORED", "DRAFT_ONLY", "NOT_PROVIDED"]


def bridge_gates(reviews: DataFrame, candidates: DataFrame) -> DataFrame:
    """First gate each review fails on its way to a recommendation; null means the bridge is ready.

    Only the newest review of a candidate counts, and it must pin the candidate's exact revision and hash.  Candidates may
    carry ``capability_gaps``; reviews may carry ``bridge_id``, ``bridge_revision``, ``human_text`` and ``text_provenance``.
    Without a bridge id or revision those of the candidate and review stand; a text without provenance counts as
    human-authored, and no text as a draft.
    """
    c = F.col
    tips = reviews.groupBy("review_id").agg(F.max("revision").alias("_tip"))
    known = candidates.select(
        "candidate_id", c("revision").alias("candidate_revision"), c("content_hash").alias("_hash"), "score", "confidence", "validation_state",
        F.size("missing_roles").alias("_missing"), F.size("policy_gaps").alias("_gaps"), F.size(optional(candidates, "capability_gaps", "array<string>")).alias("_capabilities"), F.size("conflicts").alias("_conflicts"), "freshness_state",
        "serp_status", "evidence_signature")
    joined = reviews.join(tips, "review_id").join(known, ["candidate_id", "candidate_revision"], "left")
    human = optional(reviews, "human_text", "string")
    given = F.nullif(optional(reviews, "text_provenance", "string"), F.lit(""))
    provenance = F.coalesce(given, F.when(F.coalesce(human, F.lit("")) != "", "HUMAN_AUTHORED").otherwise("DRAFT_ONLY"))
    gate = first_code(
        (c("decision") != "APPROVE", "HUMAN_APPROVAL_REQUIRED"),
        (c("_hash").isNull() | (c("_hash") != c("candidate_hash")), "CANDIDATE_REVISION_MISMATCH"),
        (c("revision") != c("_tip"), "SUPERSEDED_REVIEW"),
        (~F.upper("target_env").isin(TARGET_ENVIRONMENTS), "PRODUCTION_DESTINATION_FORBIDDEN"),
        (~F.upper("destination_id").rlike("^(UAT_|PREVIEW_)"), "DESTINATION_NOT_ALLOWLISTED"),
        (c("score").isNull(), "MISSING_SCORE"), (~F.coalesce(c("confidence").isin("MEDIUM", "HIGH"), F.lit(False)), "INSUFFICIENT_CONFIDENCE"),
        (F.coalesce("validation_state", F.lit("")) != "PASS", "VALIDATION_GATE_BLOCKED"), (c("_missing") > 0, "MISSING_REQUIRED_EVIDENCE"),
        (c("_gaps") > 0, "POLICY_GAP_BLOCKED"), (c("_capabilities") > 0, "CAPABILITY_GAP_BLOCKED"), (c("freshness_state").isin("STALE", "FAILED", "NOT_AVAILABLE"), "STALE_EVIDENCE_BLOCKED"),
        (c("serp_status") == "SERP_NOT_CHECKED", "SERP_VALIDATION_REQUIRED"),
        ((c("_conflicts") > 0) & c("conflict_adjudication_ref").isNull(), "CONFLICT_ADJUDICATION_REQUIRED"),
        (c("reviewed_signature") != c("evidence_signature"), "EVIDENCE_PIN_MISMATCH"),
        (optional(reviews, "bridge_revision", "int") < 1, "INVALID_BRIDGE_REVISION"),
        (~optional(reviews, "bridge_id", "string").rlike(REFERENCE_FORMAT), "INVALID_BRIDGE_ID"),
        (F.length(human) > TEXT_LIMIT, "INVALID_RECOMMENDATION_TEXT"), (~provenance.isin(PROVENANCES), "INVALID_TEXT_PROVENANCE"),
        ((provenance == "HUMAN_AUTHORED") & (F.coalesce(human, F.lit("")) == ""), "MISSING_HUMAN_TEXT"))
    return joined.withColumn("gate", gate).withColumn("bridge_status", F.when(c("gate").isNull(), "BRIDGE_READY").otherwise("BLOCKED")).select(
        *reviews.columns, "gate", "bridge_status")


def review_status(candidates: DataFrame, reviews: DataFrame, bridges: DataFrame) -> DataFrame:
    """Review and bridge status of every candidate revision, from its newest review."""
    c = F.col
    newest = reviews.groupBy("candidate_id", "candidate_revision").agg(F.max_by(F.struct("review_id", "revision", "decision"), c("revision")).alias("r"))
    ready = bridges.where("bridge_status = 'BRIDGE_READY'").select("candidate_id", "candidate_revision", F.lit(True).alias("_ready")).distinct()
    joined = candidates.select("candidate_id", c("revision").alias("candidate_revision")).join(
        newest, ["candidate_id", "candidate_revision"], "left").join(ready, ["candidate_id", "candidate_revision"], "left")
    named = F.create_map(*[F.lit(x) for pair in REVIEW_STATUS.items() for x in pair])
    return joined.select(
        "candidate_id", "candidate_revision", F.when(c("r").isNull(), "NOT_REVIEWED").otherwise(F.coalesce(named[c("r.decision")], F.lit("INVALID"))).alias("review_status"),
        c("r.review_id").alias("review_id"), F.when(c("_ready"), "BRIDGE_READY").when(c("r").isNotNull(), "BLOCKED").otherwise("NOT_REVIEWED").alias("recommendation_bridge_status"))


def write_plan(operations: DataFrame, ledger: DataFrame, writers: list[str], targets: list[str], sources: list[str]) -> DataFrame:
    """Every gate error of every operation, with its planned, repeated or blocked status.

    Operations of one batch under one key and hash are planned once; the first by ``seq`` leads.
    """
    c = F.col
    state = c("freshness_state")
    checked = idempotency(operations, ledger).withColumnRenamed("decision", "_seen")
    lead = operations.groupBy("idempotency_key").agg(F.min("seq").alias("_lead"))
    joined = checked.join(lead, "idempotency_key")
    errors = codes(
        (c("revision") != c("expected_revision"), "REVISION_MISMATCH"), (c("semantic_hash") != c("expected_hash"), "HASH_MISMATCH"),
        (~c("writer").isin(writers), "WRITER_NOT_ALLOWED"), (~c("target").isin(targets), "TARGET_NOT_ALLOWED"),
        (F.upper("target").startswith("PRODUCTION"), "PRODUCTION_DISABLED"), (~c("source").isin(sources) | state.isin("NOT_AVAILABLE", "MISSING"), "SOURCE_UNAVAILABLE"),
        (F.coalesce(~state.isin("READY", "NOT_AVAILABLE", "MISSING"), F.lit(True)), "STALE_EVIDENCE"),
        (~F.coalesce(c("status").isin("READY", "VALIDATED", "APPROVED_UAT"), F.lit(False)), "STATUS_NOT_ELIGIBLE"),
        (~F.coalesce(c("approval_state").isin("APPROVED_UAT", "NOT_REQUIRED_FOR_DRY_RUN"), F.lit(False)), "AUTHORIZATION_REQUIRED"),
        (c("_seen") == "IDEMPOTENCY_CONFLICT", "IDEMPOTENCY_CONFLICT"))
    status = (F.when(F.size("errors") > 0, "BLOCKED").when(c("_seen") == "ALREADY_APPLIED", "ALREADY_APPLIED")
              .when(c("seq") != c("_lead"), "IDEMPOTENT_NO_OP").otherwise("PLANNED"))
    return joined.withColumn("errors", errors).withColumn("plan_status", status).select(*operations.columns, "errors", "plan_status")


def publishable(bridges: DataFrame) -> DataFrame:
    """The record a writer may publish: its pins, text and score, nothing else."""
    return bridges.where("bridge_status = 'BRIDGE_READY'").select(
        "candidate_id", "candidate_revision", "candidate_hash", "review_id", F.col("revision").alias("review_revision"), "destination_id")


