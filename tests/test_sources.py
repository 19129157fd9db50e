"""Landed files, tables written and read back, and streams that must equal their batch form."""

import datetime
import json

import pytest
from pyspark.sql import functions as F, types as T

from sightline.operators import facts, periods, quality
from sightline.sources import landing, normalise, sinks
from sightline.streaming import jobs


def test_search_file(spark, tmp_path):
    page = {"site": "s", "property": "p", "rows": [{"keys": ["2024-01-02", "/a", "q", "tw", "MOBILE"], "clicks": 3, "impressions": 10, "ctr": 0.3, "position": 2.5}, {"keys": ["2024-01-03", "/b"]}]}
    (tmp_path / "page.json").write_text(json.dumps(page))
    got = [tuple(r) for r in landing.read_search(spark, str(tmp_path)).orderBy("date").collect()]
    assert got == [(datetime.date(2024, 1, 2), "/a", "q", 3, 10, 0.3, 2.5, "tw", "MOBILE", "s", "p"), (datetime.date(2024, 1, 3), "/b", "", 0, 0, 0.0, 0.0, "", "", "s", "p")]


def test_behaviour_file(spark, tmp_path):
    row = {"dimension_values": [{"value": v} for v in ("20240102", "h", "/a", "Organic Search")], "metric_values": [{"value": v} for v in ("4", "1", "(not set)", "2.5")]}
    (tmp_path / "page.json").write_text(json.dumps({"site": "s", "property": "p", "rows": [row]}))
    r = landing.read_behaviour(spark, str(tmp_path)).first()
    assert (r.date, r.host, r.sessions, r.key_events, r.revenue, r.engagement_rate) == (datetime.date(2024, 1, 2), "h", 4.0, 0.0, 2.5, 0.25)


def test_crawl_overview_file(spark, tmp_path):
    text = '﻿Site Crawled,https://a.example/\r\nTotal URLs Crawled,"1,250",100%,"1,250",All\r\n\r\nH1\r\nMissing,"1,024",12.5%,8192,HTML\r\nMultiple,n/a,0%,1,HTML\r\nImages\r\nOver 100 kB,7,50%,14,Images\r\n'
    (tmp_path / "overview.csv").write_text(text, encoding="utf-8")
    lines = landing.overview_lines(spark, str(tmp_path))
    got = {(r.section, r.label): (r["count"], r.share, r.scope) for r in landing.crawl_overview(lines).collect()}
    assert got == {("_summary", "Total URLs Crawled"): (1250, 1.0, "All"), ("H1", "Missing"): (1024, 0.125, "HTML"), ("Images", "Over 100 kB"): (7, 0.5, "Images")}
    meta = landing.crawl_meta_lines(lines).first()
    assert (meta.metric, meta.value) == ("Site Crawled", "https://a.example/")
    kept = quality.catalogue_rows(landing.crawl_overview(lines))
    assert {(r.section, r.severity) for r in kept.collect()} == {("H1", "HIGH"), ("Images", "HIGH")}
    assert quality.exclusions(spark).count() == 6


def test_issue_export_with_byte_order_mark(spark, tmp_path):
    (tmp_path / "issue.csv").write_text('﻿"Address","Title"\n"https://a/","two\nlines"\n', encoding="utf-8")
    df = landing.read_issue_export(spark, str(tmp_path))
    assert df.columns == ["Address", "Title"] and df.first().Title == "two\nlines"


def test_log_with_a_corrupt_line(spark, tmp_path):
    from sightline.operators import revisions
    (tmp_path / "log.jsonl").write_text('{"id":"a","revision":1,"value":2.0,"content_hash":"x"}\n{"id":"b",\n')
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("revision", T.IntegerType()), T.StructField("value", T.DoubleType()), T.StructField("content_hash", T.StringType())])
    bad = revisions.log_integrity(landing.read_log(spark, str(tmp_path), schema), ["id"], ["id", "revision", "value"])
    assert {r.code for r in bad.collect()} == {"STORE_CORRUPTION", "HASH_MISMATCH"}


def test_sheet_header_must_match(spark):
    values = spark.createDataFrame([(1, ["x"])], "row_no int, cells array<string>")
    with pytest.raises(ValueError, match="missing"):
        landing.sheet_table(values, ["a"], ["a", "b"], [])


def test_business_import_cases(spark):
    mapping = spark.createDataFrame([("leads", "2026", 7, "C", "01", "Leads", ["TW"], "raw_only")], "metric string, source_tab string, source_row int, source_column string, month string, row_label string, allowed_segments array<string>, formula_policy string")
    base = dict(metric="leads", metric_label="Leads", source_tab="2026", source_row=7, source_column="c", period="2026-01", actual="1,200", target="1000", segment="TW", source_reference="book-1!C7", formula=None)
    cases = [({}, ("READY", None)), ({}, ("REJECTED", "DUPLICATE_BUSINESS_KEY")), ({"metric": "x"}, ("REJECTED", "UNSUPPORTED_METRIC")), ({"source_tab": "2025"}, ("REJECTED", "SOURCE_NOT_CONFIRMED")),
             ({"period": "2026-13"}, ("REJECTED", "INVALID_PERIOD")), ({"source_row": 8}, ("REJECTED", "MAPPING_DRIFT")), ({"metric_label": "Lead"}, ("REJECTED", "MAPPING_DRIFT")), ({"source_reference": "else"}, ("REJECTED", "SOURCE_REFERENCE_REQUIRED")),
             ({"segment": "JP"}, ("REJECTED", "UNKNOWN_SEGMENT")), ({"formula": "=A1"}, ("REJECTED", "FORMULA_VALUE_NOT_ALLOWED")), ({"actual": "many"}, ("REJECTED", "MALFORMED_NUMBER"))]
    schema = "row_no int, metric string, metric_label string, source_tab string, source_row int, source_column string, period string, actual string, target string, segment string, source_reference string, formula string"
    rows = [(i, *{**base, **change}.values()) for i, (change, _) in enumerate(cases)]
    got = {r.row_no: (r.candidate_status, r.problem) for r in normalise.business_actuals(spark.createDataFrame(rows, schema), mapping, "2026-06-30", "book-1").collect()}
    assert got == {i: want for i, (_, want) in enumerate(cases)}
    single = normalise.business_actuals(spark.createDataFrame([(0, *{**base, "actual": "n/a"}.values()), ], schema), mapping, "2026-06-30", "book-1").first()
    assert (single.candidate_status, single.value, single.target) == ("PARTIAL", None, 1000)


# --- Sinks ------------------------------------------------------------------------------------------------

def test_append_and_replay(spark, tmp_path):
    path = str(tmp_path / "t")
    one, two = spark.range(5).withColumn("h", F.lit("x")), spark.range(3, 9).withColumn("h", F.lit("x"))
    assert sinks.append_if_new(one, path, ["id", "h"])["appended"] == 5
    assert sinks.append_if_new(two, path, ["id", "h"])["appended"] == 4
    assert sinks.append_if_new(two, path, ["id", "h"])["appended"] == 0
    assert spark.read.parquet(path).count() == 9
    with pytest.raises(ValueError, match="read-back"):
        sinks.verify_append(spark.range(8).withColumn("h", F.lit("y")), one, ["id", "h"], 8)


def test_protected_table_without_a_required_column(spark, tmp_path):
    spark.range(2).write.parquet(str(tmp_path / "notes"))
    with pytest.raises(ValueError, match="owner"):
        sinks.publish({"t": spark.range(1)}, str(tmp_path), protected={"notes": ["owner"]})


def test_replace_days_keeps_the_rest(spark):
    path = sinks.shared_folder(spark, "days")
    day = datetime.date
    rows = spark.createDataFrame([(day(2024, 1, d), f"p{i}", 1) for d in range(1, 6) for i in range(3)], "date date, page string, clicks int")
    table = "days_" + path.rsplit("-", 1)[1]
    sinks.create_daily_table(rows, table, path, ["page"])
    pull = spark.createDataFrame([(day(2024, 1, 2), "new", 9), (day(2024, 1, 9), "outside", 9)], "date date, page string, clicks int")
    for _ in range(2):
        sinks.replace_days(pull, table, "2024-01-02", "2024-01-03", ["page"])
        got = {r.date.day: r.n for r in spark.table(table).groupBy("date").agg(F.sum("clicks").alias("n")).collect()}
        assert got == {1: 3, 2: 9, 4: 3, 5: 3}
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode").lower() == "static"


def test_exports(spark):
    df = spark.createDataFrame([("a\tb", None), ("x|y", 1)], "t string, n int")
    assert [r.line for r in sinks.tsv_lines(df).collect()] == ["a b\t", "x|y\t1"]
    assert [r.line for r in sinks.json_lines(df).collect()] == ['{"n":null,"t":"a\\tb"}', '{"n":1,"t":"x|y"}']
    assert [r.line for r in sinks.markdown_lines(df).collect()][1] == "| x\\|y | 1 |"


# --- Missing is not zero ----------------------------------------------------------------------------------

def test_missing_stays_null(spark):
    rows = spark.createDataFrame([("e", datetime.date(2024, 1, 1), None, 0.5, None), ("e", datetime.date(2024, 1, 2), 0.4, None, 3)], "entity string, day date, visibility double, sov double, mentions long")
    r = facts.visibility_by_month(rows).first()
    assert (r.visibility, r.sov, r.mentions, r.days) == (0.4, 0.5, 3, 2)
    search = spark.createDataFrame([("s", datetime.date(2024, 1, 1), 0, 0, 3)], "site string, day date, clicks long, impressions long, position int")
    assert tuple(facts.site_month_totals(search).first()[-2:]) == (None, None)


def test_trend_conflict_within_a_period(spark):
    rows = spark.createDataFrame([("a", "p1", 1), ("a", "p2", 2), ("a", "p2", 3), ("b", "p1", 1), ("c", "p1", 1), ("c", "p2", None)], "k string, p string, v int")
    got = {r.k: r.signal for r in periods.trend_signal(rows, ["k"], "p", "v").collect()}
    assert got == {"a": "CONFLICT", "b": "INSUFFICIENT_HISTORY", "c": "UNKNOWN"}


# --- Streams ----------------------------------------------------------------------------------------------

def test_revision_stream_in_many_files(spark):
    """Files arrive in order, one is delivered twice, one restates history: the log ends as the batch plan says."""
    log, incoming = sinks.shared_folder(spark, "log"), sinks.shared_folder(spark, "incoming")
    schema = "id string, revision long, content_hash string, supersedes_revision long"
    spark.createDataFrame([("a", 1, "h1", None)], schema).write.parquet(log)
    rejected = []
    for rows in ([("a", 2, "h2", 1)], [("a", 2, "h2", 1), ("b", 1, "b1", None)], [("a", 1, "changed", None), ("a", 4, "h4", 3)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(incoming)
        stream = jobs.landed_stream(spark, incoming, "*.parquet")
        jobs.append_revisions(stream, log, ["id"], incoming + "-checkpoint", lambda df: rejected.extend(r.decision for r in df.collect())).awaitTermination()
    assert sorted((r.id, r.revision, r.content_hash) for r in spark.read.parquet(log).collect()) == [("a", 1, "h1"), ("a", 2, "h2"), ("b", 1, "b1")]
    assert sorted(rejected) == ["REVISION_CONFLICT", "REVISION_GAP"]


def test_sliding_stream_equals_batch(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    out, checkpoint = sinks.shared_folder(spark, "w"), sinks.shared_folder(spark, "c")
    stream = jobs.landed_stream(spark, "/root/testdata/sf0.001", "events.parquet").withColumn("ts", F.col("ts").cast("timestamp"))
    jobs.run_available(jobs.sliding_windows(stream, "ts", ["event_type"], {"n": F.count(F.lit(1))}, "7 days", "1 day", "1 day"), out, checkpoint)
    batch = events.groupBy(F.window("ts", "7 days", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n")).where(
        F.col("window.end") <= F.lit(events.agg(F.max("ts")).first()[0] - datetime.timedelta(days=1))).select(F.to_date("window.start").alias("first_day"), F.to_date("window.end").alias("end_day"), "event_type", "n")
    assert quality.multiset_difference(spark.read.parquet(out), batch).count() == 0


def test_append_reads_only_the_span_of_its_keys(spark):
    path = sinks.shared_folder(spark, "span")
    for k in range(6):
        spark.range(k * 1000, k * 1000 + 1000).withColumn("h", F.lit("x")).coalesce(1).write.mode("append").parquet(path)
    batch = spark.range(2500, 2600).withColumn("h", F.lit("y"))
    near = sinks.within(spark.read.parquet(path), batch, ["id"])
    assert near.count() == 100 and "GreaterThanOrEqual(id,2500)" in near._jdf.queryExecution().executedPlan().toString()
    assert sinks.append_if_new(batch, path, ["id"])["appended"] == 0 and sinks.append_if_new(batch, path, ["id", "h"])["appended"] == 100
    assert sinks.append_if_new(batch.where("false"), path, ["id", "h"]) == {"before": 6100, "appended": 0, "rows": 6100, "status": "PASS"}


def test_of_equal_keys_the_same_row_is_appended_whatever_the_order(spark):
    rows = [(k % 7, f"v{k}", k) for k in range(70)]
    for parts in (1, 3, 8):
        path = sinks.shared_folder(spark, "choice")
        assert sinks.append_if_new(spark.createDataFrame(rows[::-1] if parts == 3 else rows, "id int, v string, n int").repartition(parts), path, ["id"])["appended"] == 7
        assert {(r.id, r.v) for r in spark.read.parquet(path).collect()} == {(k, min(v for i, v, _ in rows if i == k)) for k in range(7)}


def test_a_micro_batch_reads_only_the_parts_of_its_keys(spark):
    log, incoming = sinks.shared_folder(spark, "parted"), sinks.shared_folder(spark, "parted-in")
    schema = "id string, revision int, content_hash string, supersedes_revision int"
    stored = spark.createDataFrame([(f"k{i}", 1, f"h{i}", None) for i in range(400)], schema)
    jobs.create_revision_log(stored, log, ["id"])
    batch = spark.createDataFrame([("k7", 2, "new", 1), ("k8", 1, "h8", None)], schema)
    own = jobs.own_parts(spark.read.parquet(log), batch, ["id"])
    plan = own._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_part" in plan.replace("isnotnull(_part#", "") and own.select(F.input_file_name()).distinct().count() <= 2
    for rows in ([("k7", 3, "late", 2)], [("k7", 2, "new", 1), ("k8", 1, "h8", None), ("new", 1, "n", None)], [("k7", 3, "late", 2), ("k7", 2, "new", 1)]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(incoming)
        jobs.append_revisions(jobs.landed_stream(spark, incoming, "*.parquet"), log, ["id"], incoming + "-checkpoint").awaitTermination()
    got = spark.read.parquet(log)
    assert got.count() == 403 and sorted(r.revision for r in got.where("id = 'k7'").collect()) == [1, 2, 3]
    assert got.where("id = 'new'").count() == 1


# --- Gates of provider rows -------------------------------------------------------------------------------

def test_feature_states(spark):
    rows = spark.createDataFrame([(1, {"AI ": "observed", "b": "NOT_AVAILABLE"}), (2, {"a": "seen"}), (3, {" ": "OBSERVED"}), (4, None), (5, {}), (6, {"a": None})], "id int, serp_features map<string,string>").union(spark.sql("SELECT 7, map('A', 'OBSERVED', 'a', 'NOT_OBSERVED')"))
    got = {r.id: (r.feature_problem, r.features) for r in normalise.feature_states(rows).collect()}
    assert got == {1: (None, {"ai": "OBSERVED", "b": "NOT_AVAILABLE"}), 2: ("INVALID_FEATURE_STATE", {}), 3: ("INVALID_FIELD", {}), 4: (None, {}), 5: (None, {}),
                   6: ("INVALID_FEATURE_STATE", {}), 7: (None, {"a": "NOT_OBSERVED"})}
    listed = spark.createDataFrame([(1, ["Images", "images"]), (2, [None]), (3, None)], "id int, serp_features array<string>")
    assert {r.id: (r.feature_problem, r.features) for r in normalise.feature_states(listed).collect()} == {1: (None, {"images": "OBSERVED"}), 2: ("INVALID_FIELD", {}), 3: (None, {})}


def test_prompt_identity(spark):
    prompts = spark.createDataFrame([("P", "best shop", "1"), ("P", "best shop", "1"), ("Q", None, None)], "prompt_id string, normalized_text string, prompt_version string")
    rows = spark.createDataFrame([(1, "P", " Best  SHOP ", "1"), (2, "P", "best shops", "2"), (3, "P", None, "2"), (4, "P", None, None), (5, "X", "best shop", "1"), (6, None, None, None), (7, "Q", "a", None), (8, "P", "", None)],
                                 "id int, prompt_id string, prompt_text string, prompt_version string")
    want = {1: None, 2: "PROMPT_IDENTITY_MISMATCH", 3: "PROMPT_VERSION_MISMATCH", 4: None, 5: "UNMAPPED_PROMPT", 6: "UNMAPPED_PROMPT", 7: "PROMPT_IDENTITY_MISMATCH", 8: "PROMPT_IDENTITY_MISMATCH"}
    assert {r.id: r.prompt_problem for r in normalise.prompt_identity(rows, prompts).collect()} == want
    bare = normalise.prompt_identity(rows, prompts.select("prompt_id")).collect()
    assert {r.id for r in bare if r.prompt_problem} == {5, 6}
    assert normalise.prompt_identity(rows.where("false"), prompts).count() == 0


def test_references_between_entities(spark):
    from sightline.operators import registry
    hot = spark.range(3000).selectExpr("concat('K', id) AS entity_id", "CASE WHEN id % 1000 = 7 THEN array('T1', 'T9', 'T9') WHEN id % 1000 = 8 THEN NULL ELSE array('T1') END AS canonical_topic_refs")
    topics = spark.createDataFrame([("T1", "K5", [None, "B"]), ("T2", "K9999", []), ("T3", None, None)], "entity_id string, primary_keyword_ref string, business_theme_refs array<string>")
    got = sorted(tuple(r) for r in registry.reference_errors({"KEYWORD": hot, "TOPIC": topics}).collect())
    code = "DANGLING_REFERENCE"
    assert got == [("KEYWORD", f"K{i}", "canonical_topic_refs", "T9", code) for i in (1007, 2007, 7)] + [
        ("TOPIC", "T1", "business_theme_refs", "B", code), ("TOPIC", "T2", "primary_keyword_ref", "K9999", code)]
    with pytest.raises(ValueError, match="no reference columns"):
        registry.reference_errors({"URL": topics.select("entity_id")})
