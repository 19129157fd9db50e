"""What travels through the exchanges of larger tables."""

from pyspark.sql import functions as F

from sightline.operators import joins, revisions
from sightline.sources import normalise


def first_join(df):
    plan = df._jdf.queryExecution().optimizedPlan()
    while plan.nodeName() != "Join":
        plan = plan.children().apply(0)
    return plan


def names(plan):
    return [x.split("#")[0] for x in plan.output().mkString(";").split(";")]


def joins_with(plan, column):
    below = sum(joins_with(plan.children().apply(i), column) for i in range(plan.children().size()))
    return below + (plan.nodeName() == "Join" and column in names(plan.children().apply(0)))


def caught(monkeypatch):
    """Every table that is written on the way."""
    frames, write = [], revisions.settled
    monkeypatch.setattr(revisions, "settled", lambda df, *more: frames.append(df) or write(df, *more))
    return frames


def test_lineage_drops_hashes(spark):
    parts = ("candidate", "review", "bridge")
    anchors = spark.range(4).select("id", *[x for n in parts for x in (
        F.col("id").alias(f"{n}_id"), F.lit(1).alias(f"{n}_revision"), F.concat(F.lit("h"), "id").alias(f"{n}_hash"))])
    stored = [spark.range(4).where(keep).select(F.col("id").alias(f"{n}_id"), F.lit(1).alias("revision"), F.concat(F.lit(h), "id").alias("content_hash"))
              for n, keep, h in (("candidate", "id <> 1", "h"), ("review", "id <> 2", "h"), ("bridge", "id <> 1", "x"))]
    out = joins.lineage(anchors, *stored).select("id", "lineage_state")
    assert not [n for n in names(first_join(out).children().apply(0)) if n in ("candidate_hash", "review_hash", "_hash")]
    assert dict(out.collect()) == {0: "BRIDGE_DRIFT", 1: "MISSING_CANDIDATE", 2: "MISSING_REVIEW", 3: "BRIDGE_DRIFT"}


def test_result_rows_by_distinct_url(spark):
    row = "array<struct<rank:int,url:string,title:string,snippet:string,result_type:string>>"
    urls = ["http://A.example/p", "http://A.example/p", "http://b.example/q", None, "ftp://c.example/"]
    pages = spark.createDataFrame([(k, [(i, u, "t", "s", "Article") for i, u in enumerate(urls)]) for k in (1, 2)], f"snapshot_id int, organic_results {row}")
    owned, rivals = spark.createDataFrame([("a.example",)], "domain string"), spark.createDataFrame([("b.example", "B")], "domain string, competitor_id string")
    known = spark.createDataFrame([("http://a.example/p", 7)], "normalized_url string, url_id int")
    out = normalise.result_rows(pages, owned, rivals, known)
    assert "regexp_extract" not in first_join(out).children().apply(0).toString()
    got = sorted(map(tuple, out.select("snapshot_id", "rank", "url", "url_id", "url_match_state", "match_state", "beyond_cap", "result_type").collect()))
    want = [(7, "CANONICAL", "OWNED"), (7, "CANONICAL", "OWNED"), (None, "UNMAPPED_URL", "COMPETITOR"), (None, "UNMAPPED_URL", "UNMAPPED_DOMAIN"), (None, "UNMAPPED_URL", "UNMAPPED_DOMAIN")]
    assert got == [(k, i, urls[i], *want[i], False, "article") for k in (1, 2) for i in range(5)]


def test_append_plan_moves_rows_twice(spark, monkeypatch):
    frames = caught(monkeypatch)
    log = spark.createDataFrame([(1, 1, "a", None, "n")], "id int, revision int, content_hash string, supersedes_revision int, note string")
    batch = spark.createDataFrame([(1, 1, "a", None, "n"), (1, 2, "b", 1, "n"), (1, 3, "c", 2, "n"), (1, 5, "e", 4, "n"), (2, 1, "a", 7, "n"), (3, 1, "a", None, "n"), (3, 1, "b", None, "n")], log.schema)
    out = revisions.append_plan(log, batch, ["id"])
    assert joins_with(frames[1]._jdf.queryExecution().optimizedPlan(), "note") == 2
    assert sorted(map(tuple, out.select("id", "content_hash", "decision").collect())) == [
        (1, "a", "IDEMPOTENT"), (1, "b", "APPEND"), (1, "c", "APPEND"), (1, "e", "REVISION_GAP"), (2, "a", "INVALID_SUPERSEDES"),
        (3, "a", "REVISION_CONFLICT"), (3, "b", "REVISION_CONFLICT")]


def test_snapshot_plan_writes_no_places(spark, monkeypatch):
    frames = caught(monkeypatch)
    schema = "logical_key string, snapshot_id string, content_hash string, as_of_date string, revision int, supersedes_snapshot_id string, n int"
    stored = spark.createDataFrame([("k", "s1", "a", "2001-01-01", 1, None, 0)], schema)
    batch = spark.createDataFrame([("k", None, "b", "2001-01-02", None, "s1", 1), ("k", None, "c", "2001-01-02", None, "s1", 2), ("k", None, "a", "2001-01-02", None, None, 3), ("m", None, "a", "2001-01-02", None, None, 4)], schema)
    out = revisions.snapshot_plan(stored, batch.drop("revision"), ["n"])
    got = sorted(map(tuple, out.select("n", "decision", "revision").collect()))
    assert got == [(1, "REVISE", 2), (2, "REJECT_NEEDS_SUPERSEDES", None), (3, "SKIP", None), (4, "NEW", 1)]
    assert not [f.columns for f in frames if "_order" in f.columns and "_parent" not in f.columns]
    assert {dict(f.dtypes)["_entry"] for f in frames if "_entry" in f.columns} == {"binary"}
