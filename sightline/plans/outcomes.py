"""Outcome of implemented actions at 30, 60 and 90 days, all tracks at once.

A measurement plan is data: ``plans`` holds ``track_id, metric, role`` (primary, support or guardrail) with
``target_delta, tolerance, minimum_sample, method, direction, guard_direction, max_delta, plan_scope,
attribution_contract`` per metric, and ``tracks`` holds ``track_id, checkpoint, event_type, lineage_state``.
"""

from pyspark.sql import Column, DataFrame, functions as F

from sightline.operators.joins import compare_sides
from sightline.operators.periods import CHECKPOINTS, checkpoint_windows
from sightline.operators.quality import first_code, optional
from sightline.schemas import REPORTING_ZONE

# States of an observation that carry no value, and behaviour metrics that are no outcome.
UNUSABLE = ["MISSING", "FAILED", "NOT_AVAILABLE", "STALE", "NOT_COMPARABLE"]
CONVERSION_WORDS = r"(?i)conversion|lead|sql|revenue"


def delta(before: Column, after: Column, method: Column) -> Column:
    """Absolute or relative change; a relative change from zero has no value."""
    return F.when(method == "ABSOLUTE_DELTA", after - before).otherwise(F.try_divide(after - before, F.abs(before)))


def target_met(change: Column, direction: Column, target: Column, tolerance: Column) -> Column:
    return (F.when(direction == "INCREASE", change >= target).when(direction == "DECREASE", change <= -F.abs(target))
            .otherwise(F.abs(change) <= tolerance))


def guardrail_breached(change: Column, direction: Column, limit: Column) -> Column:
    """An unknown change breaches; otherwise the direction tells which side of the limit is too far."""
    return (F.when(change.isNull() | limit.isNull(), True).when(direction == "MAX_INCREASE", change > limit)
            .when(direction.isin("NOT_DECREASE", "MAX_DECREASE"), change < -F.abs(limit)).when(direction == "NOT_INCREASE", change > F.abs(limit))
            .otherwise(F.abs(change) > limit))


def comparisons(plans: DataFrame, observations: DataFrame) -> DataFrame:
    """Every planned metric of every track with its status, delta and verdict; the first obstacle decides the status.

    ``observations``: ``track_id, side, metric, source, value, status, freshness_state, sample_size, scope`` and the
    optional scope fields; plans may bind a ``plan_population``.
    """
    c = F.col
    paired = plans.join(compare_sides(observations), ["track_id", "metric"], "left")

    def either(column, values):
        return c(f"baseline_{column}").isin(values) | c(f"follow_up_{column}").isin(values)

    def small(side):
        return c(f"{side}_sample_size") < c("minimum_sample")

    population = ([(c("baseline_source_population") != c("plan_population"), "SOURCE_POPULATION_MISMATCH")]
                  if "plan_population" in plans.columns and "source_population" in observations.columns else [])
    absent = c("baseline_status").isNull() | c("follow_up_status").isNull()
    obstacle = first_code(
        (absent, "MISSING"),
        ((c("baseline_source") == "BUSINESS") & c("attribution_contract").isNull(), "BUSINESS_ATTRIBUTION_CONTRACT_REQUIRED"),
        ((c("baseline_source") == "GA4") & c("metric").rlike(CONVERSION_WORDS), "GA4_DIAGNOSTIC_ONLY"),
        (either("status", UNUSABLE) | either("freshness_state", ["STALE", "FAILED", "NOT_AVAILABLE", "MISSING"])
         | c("baseline_value").isNull() | c("follow_up_value").isNull(), "INSUFFICIENT_DATA"),
        (small("baseline") | small("follow_up"), "INSUFFICIENT_SAMPLE"), (c("mismatch").isNotNull(), "SCOPE_MISMATCH"),
        (c("baseline_scope") != c("plan_scope"), "MEASUREMENT_SCOPE_MISMATCH"), *population)
    change = F.when(c("obstacle").isNull(), delta(c("baseline_value"), c("follow_up_value"), c("method")))
    return paired.withColumn("obstacle", obstacle).withColumn("delta", change).withColumns({
        "met": F.when(c("obstacle").isNull(), target_met(c("delta"), c("direction"), c("target_delta"), c("tolerance"))),
        "breached": F.when((c("role") == "guardrail") & c("obstacle").isNull(), guardrail_breached(c("delta"), c("guard_direction"), c("max_delta")))})


def input_errors(tracks: DataFrame, windows: DataFrame, pins: DataFrame, evidence: DataFrame) -> DataFrame:
    """``tracks`` with ``input_error``: the first reason for which a track's inputs cannot be compared at all, or null.

    ``tracks``: ``track_id, checkpoint, completed_day``; ``windows``: ``track_id, side, period_start, period_end, timezone``;
    ``pins``: ``track_id, evidence_id, revision, content_hash`` of its observations; ``evidence``: the log they pin.  A pin
    that the log resolves to another hash is drift; one that it does not know is left to the other gates.  Windows must be
    the exact 28 whole days before completion and up to the checkpoint, in the reporting time zone.
    """
    c = F.col
    held = evidence.select("evidence_id", "revision", c("content_hash").alias("_stored"))
    drift = pins.join(held, ["evidence_id", "revision"]).where(c("_stored") != c("content_hash")).select("track_id").distinct().withColumn("_drift", F.lit(True))
    known = F.upper("checkpoint").isin([n for n in CHECKPOINTS if n != "BASELINE"])
    exact = checkpoint_windows(tracks.where(known).select("track_id", F.upper("checkpoint").alias("_asked"), "completed_day")).where(c("checkpoint").isin("BASELINE") | (c("checkpoint") == c("_asked")))
    due = exact.select("track_id", F.when(c("checkpoint") == "BASELINE", "baseline").otherwise("follow_up").alias("side"), c("period_start").alias("_start"), c("period_end").alias("_end"))
    met = windows.join(due, ["track_id", "side"])
    off = met.where(~c("period_start").eqNullSafe(c("_start")) | ~c("period_end").eqNullSafe(c("_end")) | (c("timezone") != REPORTING_ZONE)).select("track_id").distinct().withColumn("_off", F.lit(True))
    joined = tracks.join(drift, "track_id", "left").join(off, "track_id", "left")
    return joined.withColumn("input_error", first_code(
        (~F.coalesce(known, F.lit(False)), "INVALID_CHECKPOINT"), (c("_drift"), "BASELINE_EVIDENCE_HASH_MISMATCH"), (c("_off"), "INCOMPLETE_PERIOD"))).drop("_drift", "_off")


def outcomes(tracks: DataFrame, compared: DataFrame) -> DataFrame:
    """State of each track from its compared metrics; one with an ``input_error`` is blocked and has no state."""
    c = F.col
    missing = c("obstacle").isin("MISSING", "INSUFFICIENT_DATA", "INSUFFICIENT_SAMPLE")
    primary, support = c("role") == "primary", c("role") == "support"
    within = F.coalesce(F.abs("delta") <= c("tolerance"), F.lit(False))

    def some(condition):
        return F.coalesce(F.bool_or(F.coalesce(condition, F.lit(False))), F.lit(False))

    folded = compared.groupBy("track_id").agg(
        some(missing).alias("missing"), some(c("obstacle").isNotNull() & ~missing).alias("blocked"), some(c("breached")).alias("breached"),
        F.max(F.when(primary, c("met"))).alias("primary_met"), F.max(F.when(primary, c("direction"))).alias("direction"),
        F.max(F.when(primary, c("delta"))).alias("primary_delta"), F.count_if(support).alias("supports"), F.count_if(support & c("met")).alias("supports_met"),
        F.count_if(support & c("met").isNull()).alias("supports_unknown"), (~some((primary | support) & ~within)).alias("steady"))
    joined = tracks.join(folded, "track_id", "left")
    open_question = (F.coalesce(c("missing"), F.lit(True)) | c("blocked") | c("primary_met").isNull() | (c("supports") == 0) | (c("supports_unknown") > 0))
    state = (F.when((c("event_type") != "IMPLEMENTED") | open_question, "INSUFFICIENT_DATA").when(c("breached"), "LOST").when(c("steady"), "NO_CHANGE")
             .when(~c("primary_met") & (c("direction") != "STABLE"), "LOST").when(c("primary_met") & (c("supports_met") == c("supports")), "WON")
             .when(c("primary_met") | (c("supports_met") > 0), "PARTIAL_WIN").otherwise("NO_CHANGE"))
    sound = (c("lineage_state") == "OK") & optional(tracks, "input_error", "string").isNull()
    status = (F.when(c("event_type") == "MONITORING_ONLY", "OBSERVATION_ONLY").when(c("event_type") != "IMPLEMENTED", "NOT_ELIGIBLE")
              .when(~sound, "BLOCKED").otherwise("EVALUATED"))
    return joined.select(*tracks.columns, status.alias("tracking_status"), F.when(sound, state).alias("outcome_state"),
                         "primary_delta", "primary_met", F.coalesce("breached", F.lit(False)).alias("guardrail_breached"))
