import datetime

import pytest
from pyspark.sql import functions as F

from sightline.operators import revisions

LOG = "id string, revision int, supersedes_revision int, content_hash string"
D = datetime.date


def decide(spark, stored, batch):
    out = revisions.append_plan(spark.createDataFrame(stored, LOG), spark.createDataFrame(batch, LOG), ["id"])
    return {(r.id, r.revision, r.content_hash): r.decision for r in out.collect()}


def test_append_cases(spark):
    stored = [("a", 1, None, "h1"), ("a", 2, 1, "h2"), ("b", 1, None, "x1")]
    got = decide(spark, stored, [
        ("a", 2, 1, "h2"), ("a", 3, 2, "h3"), ("a", 4, 3, "h4"),            # replay, then two that follow on
        ("b", 1, None, "other"),                                           # same revision, another hash
        ("c", 1, None, "c1"), ("c", 3, 2, "c3"),                           # new, then a gap
        ("d", 1, 5, "d1"), ("e", 1, None, "e1"), ("e", 2, None, "e2"), ("e", 3, 2, "e3")])
    assert got == {("a", 2, "h2"): "IDEMPOTENT", ("a", 3, "h3"): "APPEND", ("a", 4, "h4"): "APPEND", ("b", 1, "other"): "REVISION_CONFLICT",
                   ("c", 1, "c1"): "APPEND", ("c", 3, "c3"): "REVISION_GAP", ("d", 1, "d1"): "INVALID_SUPERSEDES",
                   ("e", 1, "e1"): "APPEND", ("e", 2, "e2"): "INVALID_SUPERSEDES", ("e", 3, "e3"): "REVISION_GAP"}


def test_replay_is_a_no_op(spark):
    batch = [("a", i, i - 1 or None, f"h{i}") for i in range(1, 6)]
    assert set(decide(spark, [("z", 1, None, "z")], batch).values()) == {"APPEND"}
    assert set(decide(spark, batch, batch).values()) == {"IDEMPOTENT"}


def test_two_hashes_for_one_new_revision(spark):
    assert set(decide(spark, [("z", 1, None, "z")], [("a", 1, None, "p"), ("a", 1, None, "q")]).values()) == {"REVISION_CONFLICT"}


def test_one_id_holding_a_third_of_the_log(spark):
    stored = [("hot", i, i - 1 or None, f"h{i}") for i in range(1, 400)] + [(f"k{i}", 1, None, "x") for i in range(800)]
    got = decide(spark, stored, [("hot", 400, 399, "new"), ("hot", 402, 401, "far")])
    assert got == {("hot", 400, "new"): "APPEND", ("hot", 402, "far"): "REVISION_GAP"}
    assert revisions.latest(spark.createDataFrame(stored, LOG), ["id"]).where("id = 'hot'").first().revision == 399


def test_chain_violations(spark):
    schema = "k string, revision int, rid string, prior string, as_of date"
    rows = [("ok", 1, "a1", None, D(2024, 1, 1)), ("ok", 2, "a2", "a1", D(2024, 1, 2)), ("broken", 1, "b1", None, D(2024, 1, 1)), ("broken", 2, "b2", "zz", D(2024, 1, 2)),
            ("gap", 1, "g1", None, D(2024, 1, 1)), ("gap", 3, "g3", "g1", D(2024, 1, 2)), ("back", 1, "d1", None, D(2024, 1, 5)), ("back", 2, "d2", "d1", D(2024, 1, 4)),
            ("first", 1, "f1", "f0", D(2024, 1, 1)), ("twice", 1, "t1", None, D(2024, 1, 1)), ("twice", 1, "t2", None, D(2024, 1, 1))]
    got = {(r.k, r.revision, r.code) for r in revisions.chain_violations(spark.createDataFrame(rows, schema), ["k"], "rid", "prior", "as_of").collect()}
    assert got == {("broken", 2, "BROKEN_CHAIN"), ("gap", 3, "REVISION_GAP"), ("back", 2, "AS_OF_WENT_BACK"), ("first", 1, "INVALID_SUPERSEDES"), ("twice", 1, "DUPLICATE_REVISION")}


def test_snapshot_plan(spark):
    history = spark.createDataFrame([("k", "h1", "s1", D(2024, 1, 1), 1), ("k", "h2", "s2", D(2024, 2, 1), 2)], "logical_key string, content_hash string, snapshot_id string, as_of_date date, revision int")
    rows = [("k", "h2", None, D(2024, 2, 1)), ("k", "h3", "s2", D(2024, 3, 1)), ("k", "h4", "s1", D(2024, 3, 1)), ("k", "h5", "s2", D(2024, 1, 1)), ("n", "h6", "s9", D(2024, 1, 1)), ("m", "h7", None, D(2024, 1, 1))]
    plan = revisions.snapshot_plan(history, spark.createDataFrame(rows, "logical_key string, content_hash string, supersedes_snapshot_id string, as_of_date date"))
    assert {r.content_hash: (r.decision, r.revision) for r in plan.collect()} == {
        "h2": ("SKIP", None), "h3": ("REVISE", 3), "h4": ("REJECT_NEEDS_SUPERSEDES", None), "h5": ("REJECT_OLDER_OBSERVATION", None),
        "h6": ("REJECT_UNKNOWN_PREDECESSOR", None), "h7": ("NEW", 1)}
    sealed = revisions.seal(plan).collect()
    assert {r.content_hash for r in sealed} == {"h3", "h7"} and all(r.snapshot_id.startswith("snap_") for r in sealed)


@pytest.mark.parametrize("as_of, target, want", [("2026-08-28", 10.0, (False, False, None)), ("2026-08-29", 10.0, (True, True, 0.8)), ("2026-08-29", 0.0, (True, False, None)), ("2026-08-29", None, (True, False, None))])
def test_maturity_gates_attainment(spark, as_of, target, want):
    rows = [("k", 1, as_of, "2026-06-01", "Ready", "sql", "Business", 8.0, target)]
    df = spark.createDataFrame(rows, "logical_key string, revision int, as_of_date string, period_start string, data_status string, metric string, metric_group string, value double, target double")
    r = revisions.report_rows(df, as_of).first()
    assert (r.formal_trend_eligible, r.formal_target_eligible, r.target_attainment) == want and r.value == 8.0


def test_latest_failed_does_not_fall_back(spark):
    rows = [("k", 1, "2026-08-01", "2026-01-01", "Ready", "sessions", "Business", 8.0, 1.0), ("k", 2, "2026-08-01", "2026-01-01", "Failed", "sessions", "Business", None, 1.0)]
    df = spark.createDataFrame(rows, "logical_key string, revision int, as_of_date string, period_start string, data_status string, metric string, metric_group string, value double, target double")
    r = revisions.report_rows(df, "2026-08-01").collect()
    assert len(r) == 1 and r[0].effective_status == "Failed" and not r[0].formal_trend_eligible


def test_idempotency_conflicts_inside_a_batch(spark):
    ops = spark.createDataFrame([("a", "1"), ("a", "2"), ("b", "1"), ("c", "1")], "idempotency_key string, semantic_hash string")
    ledger = spark.createDataFrame([("b", "1")], "idempotency_key string, semantic_hash string")
    got = revisions.idempotency(ops, ledger).groupBy("idempotency_key").agg(F.collect_set("decision").alias("d"))
    assert {r.idempotency_key: r.d for r in got.collect()} == {"a": ["IDEMPOTENCY_CONFLICT"], "b": ["ALREADY_APPLIED"], "c": ["NEW"]}


def test_snapshot_plan_within_one_batch(spark):
    """Repeats of a new row are one NEW and SKIPs; linked revisions of one batch are accepted in order."""
    history = spark.createDataFrame([], "logical_key string, content_hash string, snapshot_id string, as_of_date date, revision int")
    schema = "n int, logical_key string, content_hash string, supersedes_snapshot_id string, as_of_date string"
    first = revisions.snapshot_id(*(F.lit(x) for x in ("k", "h1")), F.lit(1), F.lit(None).cast("string"))
    one = spark.range(1).select(first).first()[0]
    two = spark.range(1).select(revisions.snapshot_id(F.lit("k"), F.lit("h2"), F.lit(2), F.lit(one))).first()[0]
    rows = [(1, "k", "h1", None, "2024-01-05"), (2, "k", "h1", None, "2024-01-05"), (3, "k", "h2", one, "2024-01-06"), (4, "k", "h3", two, "2024-01-07"), (5, "k", "h4", one, "2024-01-08"),
            (6, "k", "h5", None, "2024-01-08"), (7, "new", "x", "snap_0", "2024-01-05"), (8, "old", "a", None, "2024-01-05"), (9, "old", "b", None, "2024-01-05")]
    batch = spark.createDataFrame(rows, schema).withColumn("as_of_date", F.to_date("as_of_date")).repartition(3)
    plan = {r.n: (r.decision, r.revision) for r in revisions.snapshot_plan(history, batch, ["n"]).collect()}
    assert plan == {1: ("NEW", 1), 2: ("SKIP", None), 3: ("REVISE", 2), 4: ("REVISE", 3), 5: ("REJECT_NEEDS_SUPERSEDES", None), 6: ("REJECT_NEEDS_SUPERSEDES", None),
                    7: ("REJECT_UNKNOWN_PREDECESSOR", None), 8: ("NEW", 1), 9: ("REJECT_NEEDS_SUPERSEDES", None)}


def test_a_chain_of_thousands_in_one_batch(spark, monkeypatch):
    """Rounds grow with the logarithm of the chain; names of unknown predecessors and equal rows do not break it."""
    import hashlib
    import json
    calls = []
    held = revisions.settled
    monkeypatch.setattr(revisions, "settled", lambda df, *a: calls.append(1) or held(df, *a))
    rows, before = [(0, "hot", "stray", "snap_none", "2024-01-01")], None
    for k in range(1, 3001):
        rows.append((k, "hot", f"h{k}", before, "2024-01-05"))
        before = "snap_" + hashlib.sha256(json.dumps(["hot", f"h{k}", k, before], separators=(",", ":")).encode()).hexdigest()
    rows += [(3001, "hot", "h3000", None, "2024-01-06"), (7, "twin", "x", None, "2024-01-05"), (7, "twin", "x", None, "2024-01-05")]
    history = spark.createDataFrame([], "logical_key string, content_hash string, snapshot_id string, as_of_date date, revision int")
    batch = spark.createDataFrame(rows, "n int, logical_key string, content_hash string, supersedes_snapshot_id string, as_of_date string").withColumn("as_of_date", F.to_date("as_of_date")).repartition(5)
    got = revisions.snapshot_plan(history, batch, ["n"]).collect()
    assert len(got) == len(rows) and sorted((r.decision, r.revision) for r in got if r.logical_key == "twin") == [("NEW", 1), ("SKIP", None)]
    plan = {r.n: (r.decision, r.revision) for r in got if r.logical_key == "hot"}
    assert plan[0] == ("REJECT_NEEDS_SUPERSEDES", None) and plan[3001] == ("SKIP", None) and plan[1] == ("NEW", 1)
    assert all(plan[k] == ("REVISE", k) for k in range(2, 3001)) and len(calls) < 40


def test_what_an_earlier_tip_held_may_come_back(spark):
    history = spark.createDataFrame([("k", "a", "s1", D(2024, 1, 1), 1)], "logical_key string, content_hash string, snapshot_id string, as_of_date date, revision int")
    two = spark.range(1).select(revisions.snapshot_id(F.lit("k"), F.lit("b"), F.lit(2), F.lit("s1"))).first()[0]
    rows = [(1, "k", "b", "s1", D(2024, 1, 2)), (2, "k", "a", two, D(2024, 1, 3)), (3, "k", "a", None, D(2024, 1, 3)), (4, "k", "c", two, D(2024, 1, 1))]
    batch = spark.createDataFrame(rows, "n int, logical_key string, content_hash string, supersedes_snapshot_id string, as_of_date date")
    plan = {r.n: (r.decision, r.revision) for r in revisions.snapshot_plan(history, batch, ["n"]).collect()}
    assert plan == {1: ("REVISE", 2), 2: ("REVISE", 3), 3: ("SKIP", None), 4: ("REJECT_OLDER_OBSERVATION", None)}
