"""Scenario bundles of the rule engine, all evaluated together."""

import pytest
from pyspark.sql import functions as F

from sightline.plans import rules

BUNDLE = ("bundle_id string, project_scope_id string, topic_id string, search_intent string, requested_type string, decision_at string, evaluation_period string, "
          "existing_urls array<string>, mapping_confirmed boolean, mapping_approved boolean, alternatives_addressed boolean")
WINDOW = "struct<role:string,period_end:date,clicks:double,impressions:double,ctr:double,position:double>"
EVIDENCE = ("bundle_id string, seq long, evidence_id string, revision int, content_hash string, source string, topic_id string, topic_refs array<string>, urls array<string>, freshness_state string, "
            "collection_status string, conflict boolean, volume double, impressions double, position double, ctr double, coverage string, attainability_band int, execution_band int, "
            f"issues array<struct<type:string,severity:string>>, windows array<{WINDOW}>")
SEQ = iter(range(1, 10_000))


def record(bundle, source, topic="T", refs=(), urls=("u",), state="READY", conflict=False, volume=None, impressions=None, position=None, ctr=None, issues=(), windows=()):
    n = next(SEQ)
    return (bundle, n, f"E{n}", 1, f"h{n}", source, topic, list(refs), list(urls), state, "SUCCESS", conflict, volume, impressions, position, ctr, "COMPLETE_WITHIN_SCOPE", None, None, list(issues), list(windows))


def window(i, clicks, role=None, impressions=1000.0, ctr=0.1, position=5.0):
    import datetime
    return (role, datetime.date(2024, i, 28), clicks, impressions, ctr, position)


def sources(b, **kw):
    return [record(b, "AHREFS", volume=600.0, **kw), record(b, "GSC", impressions=900.0, position=8.0, ctr=0.02, **kw)]


LOW = [("H1", "LOW")]
FALLING = [window(i, c) for i, c in enumerate([100.0, 100.0, 100.0, 100.0, 70.0, 60.0], 1)]
CTR = [window(1, 1.0, "current", 800.0, 0.04, 5.5), window(2, 1.0, "previous", 800.0, 0.05, 5.0)]
SCENARIOS = {
    "technical": (sources("technical") + [record("technical", "SF", issues=[("STATUS", "high")])], ("TECHNICAL_UNLOCK", "TECHNICAL_FIX", [])),
    "technical_stale": (sources("technical_stale", state="STALE") + [record("technical_stale", "SF", issues=[("STATUS", "CRITICAL")])], ("TECHNICAL_UNLOCK", "TECHNICAL_FIX", ["freshness"])),
    "technical_no_demand": ([record("technical_no_demand", "SF", issues=[("STATUS", "HIGH")])], ("DO_NOTHING", "MONITOR", ["demand"])),
    "ctr": ([record("ctr", "GSC", windows=CTR), record("ctr", "SF", issues=[("TITLE", "LOW")])], ("CTR_OPPORTUNITY", "SERP_SNIPPET_OPTIMIZE", [])),
    "ctr_incomplete": ([record("ctr_incomplete", "GSC", windows=[CTR[0], window(2, 1.0, "previous", 800.0, None)]), record("ctr_incomplete", "SF", issues=[("META", "LOW")])], ("DO_NOTHING", "MONITOR", ["traction"])),
    "decay": ([record("decay", "GSC", windows=FALLING), record("decay", "SF", issues=LOW)], ("CONTENT_DECAY", "UPDATE_EXISTING", [])),
    "decay_short": ([record("decay_short", "GSC", windows=FALLING[:5])], ("CONTENT_DECAY", "MONITOR", ["historical_traction"])),
    "decay_null": ([record("decay_null", "GSC", windows=FALLING[:5] + [window(6, None)])], ("CONTENT_DECAY", "MONITOR", ["traction"])),
    "quick": (sources("quick") + [record("quick", "SF", issues=LOW)], ("QUICK_WIN", "UPDATE_EXISTING", ["intent"])),
    "quick_zero_volume": ([record("quick_zero_volume", "AHREFS", volume=0.0), record("quick_zero_volume", "GSC")], ("QUICK_WIN", "UPDATE_EXISTING", ["intent", "technical", "traction"])),
    "other_url": (sources("other_url", urls=("elsewhere",)), ("DO_NOTHING", "DO_NOTHING", [])),
    "other_topic": (sources("other_topic", topic="X"), ("DO_NOTHING", "MONITOR", ["required_evidence"])),
    "by_reference": (sources("by_reference", topic="X", refs=("T",)), ("QUICK_WIN", "UPDATE_EXISTING", ["intent", "technical"])),
    "unscoped": (sources("unscoped", topic=None, urls=()), ("QUICK_WIN", "UPDATE_EXISTING", ["intent", "technical"])),
    "conflicting": (sources("conflicting", conflict=True), ("QUICK_WIN", "UPDATE_EXISTING", ["intent", "technical"])),
    "empty": ([], ("DO_NOTHING", "MONITOR", ["required_evidence"])),
    "asked": (sources("asked"), ("CONTENT_DECAY", "MONITOR", ["required_evidence"])),
    "gap": (sources("gap"), ("CONTENT_GAP", "CREATE_NEW", ["competitor", "inventory"])),
}
REQUESTED = {"asked": "CONTENT_DECAY", "gap": "CONTENT_GAP"}


@pytest.fixture(scope="module")
def tables(spark):
    bundles = [(b, f"P-{b}", "T", "INFORMATIONAL", REQUESTED.get(b), "2024-07-01T00:00:00Z", "2024-06", ["u"], True, True, b != "quick") for b in SCENARIOS]
    return spark.createDataFrame(bundles, BUNDLE), spark.createDataFrame([r for rows, _ in SCENARIOS.values() for r in rows], EVIDENCE)


def test_decisions(tables):
    got = {r.bundle_id: (r.opportunity_type, r.recommended_action, r.missing_roles) for r in rules.evaluate(rules.inputs_of(*tables)).collect()}
    assert got == {b: want for b, (_, want) in SCENARIOS.items()}


def test_candidates(tables):
    got = {r.bundle_id: r for r in rules.candidates(*tables).collect()}
    assert "gap" not in got
    assert (got["technical"].confidence, got["technical"].validation_state, got["technical"].status) == ("HIGH", "PASS", "CANDIDATE")
    assert (got["technical_stale"].validation_state, got["technical_stale"].missing_roles) == ("INSUFFICIENT_EVIDENCE", ["freshness"])
    assert (got["conflicting"].validation_state, got["conflicting"].confidence) == ("CONFLICTING_EVIDENCE", "LOW")
    assert (got["decay_short"].status, got["empty"].evidence_count) == ("DISCOVERED", 0)
    assert got["other_url"].recommended_action == "DO_NOTHING"
    q = got["quick"]
    assert (q.demand_score, q.traction_score, q.business_score, q.opportunity_score, q.score_lower_bound, q.score_upper_bound) == (3, 4, None, None, 30, 95)


def test_revision_moves_only_with_the_evidence(tables):
    bundles, evidence = tables
    first = rules.candidates(bundles, evidence).select("candidate_id", "revision", "input_signature")
    same = rules.candidates(bundles, evidence.repartition(5), first)
    assert {r.revision for r in same.collect()} == {1}
    moved = evidence.withColumn("content_hash", F.when(F.col("bundle_id") == "quick", "new").otherwise(F.col("content_hash")))
    assert {r.bundle_id for r in rules.candidates(bundles, moved, first).where("revision = 2 AND supersedes_revision = 1").collect()} == {"quick"}


def test_one_bundle_holding_most_evidence(spark, tables):
    bundles, _ = tables
    rows = [record("quick", "GSC", impressions=900.0, position=8.0) for _ in range(900)] + [record("quick", "AHREFS", volume=5.0)] + [record("decay", "GSC", windows=FALLING)]
    cells = rules.evidence_cells(rules.scoped_evidence(bundles, spark.createDataFrame(rows, EVIDENCE)))
    assert cells.where("bundle_id = 'quick'").count() == 2 and cells.agg(F.sum("n")).first()[0] == 902
