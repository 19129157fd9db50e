"""Row validation with collected error codes, scope filters, freshness and set checks."""

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from sightline import schemas
from sightline.functions import dates, hashing, text
from sightline.functions.labels import lookup, source_class


def codes(*rules: tuple[Column, str]) -> Column:
    """Array of the codes of every rule that fires; a rule that cannot be decided does not."""
    return F.array_compact(F.array(*[F.when(condition, code) for condition, code in rules]))


def optional(df, name: str, kind: str) -> Column:
    """A column of ``df`` where it has one of that name, else null of the given kind."""
    return F.col(name) if name in df.columns else F.lit(None).cast(kind)


def first_code(*rules: tuple[Column, str]) -> Column:
    """Code of the first rule that fires, or null."""
    return F.coalesce(*[F.when(condition, code) for condition, code in rules])


def split(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows without error codes, and rows with them."""
    return rows.where(F.size("errors") == 0).drop("errors"), rows.where(F.size("errors") > 0)


def blank(column: str) -> Column:
    return F.coalesce(F.trim(F.col(column).cast("string")), F.lit("")) == ""


# --- Scope ------------------------------------------------------------------------------------------------

def in_scope(rows: DataFrame, scope: DataFrame, channels: list[str]) -> DataFrame:
    """Rows of an approved (property, host) pair and an allowed channel; hosts compare without case."""
    allowed = scope.select(F.col("property").alias("_p"), F.lower("host").alias("_h")).distinct()
    return rows.where(F.col("channel").isin(channels)).join(
        allowed, (F.col("property") == F.col("_p")) & (F.lower("host") == F.col("_h")), "left_semi")


def catalogue_rows(overview: DataFrame) -> DataFrame:
    """Non-zero findings of the reported crawl catalogue with their severity."""
    entries = F.map_from_entries(F.array(*[
        F.struct(F.lit(f"{section}|{label}"), F.lit(severity)) for section, label, severity in schemas.CRAWL_CATALOGUE]))
    severity = F.element_at(entries, F.concat_ws("|", "section", "label"))
    return overview.withColumn("severity", severity).where("severity IS NOT NULL AND count > 0")


def exclusions(spark) -> DataFrame:
    """Findings left out on purpose, with the reason."""
    return spark.createDataFrame(schemas.CRAWL_EXCLUSIONS, "finding string, reason string")


def scope_errors(queries: DataFrame, scope: DataFrame, excluded: DataFrame | None = None, required: DataFrame | None = None,
                 available: DataFrame | None = None) -> DataFrame:
    """Error codes of keyword-database queries against their project's approved scope.

    The scope holds one row per (project, allowed host).  A target fits when one of its own parent domains is
    allowed, so the suffix test is an equality join on the domains a host contains.  ``excluded`` (project,
    excluded_host) forbids targets by name; ``required`` (query_id, capability) must be ``available`` (capability).
    Where queries have an ``estimation_flag``, it must be set.
    """
    heads = scope.groupBy("project").agg(
        F.max("approval_state").alias("approval_state"), F.max("approval_ref").alias("approval_ref"),
        F.max("environment").alias("environment"), F.max("country").alias("scope_country"),
        F.count("allowed_host").alias("hosts"))
    parts = F.split(F.lower("target_host"), r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(parts)),
                          lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    allowed = scope.select("project", F.lower("allowed_host").alias("_parent")).distinct()
    within = (queries.select("query_id", "project", F.explode(parents).alias("_parent"))
              .join(allowed, ["project", "_parent"], "left_semi").select("query_id").distinct()
              .withColumn("_within", F.lit(True)))
    joined = queries.join(heads, "project", "left").join(within, "query_id", "left")
    more = []
    if excluded is not None:
        named = excluded.select("project", F.lower("excluded_host").alias("_host")).distinct().withColumn("_excluded", F.lit(True))
        joined = joined.withColumn("_host", F.lower("target_host")).join(named, ["project", "_host"], "left").drop("_host")
        more.append((F.col("_excluded").isNotNull(), "TARGET_EXCLUDED"))
    if required is not None:
        lacking = required if available is None else required.join(available.select("capability"), "capability", "left_anti")
        joined = joined.join(lacking.select("query_id").distinct().withColumn("_lacking", F.lit(True)), "query_id", "left")
        more.append((F.col("_lacking").isNotNull(), "CAPABILITY_MISSING"))
    if "estimation_flag" in queries.columns:
        more.append((~F.coalesce("estimation_flag", F.lit(False)), "ESTIMATE_CLASSIFICATION_CONFLICT"))
    return joined.withColumn("errors", codes(
        (F.coalesce("approval_state", F.lit("")) != "APPROVED", "SCOPE_NOT_APPROVED"),
        (blank("approval_ref"), "SCOPE_APPROVAL_REF_MISSING"),
        (~F.coalesce(F.col("environment").isin("preview", "uat"), F.lit(False)), "PRODUCTION_ENVIRONMENT_BLOCKED"),
        (F.col("scope_country") != F.col("country"), "COUNTRY_SCOPE_MISMATCH"),
        ((F.col("hosts") > 0) & F.col("_within").isNull(), "TARGET_OUTSIDE_SCOPE"), *more)).drop(
        "approval_state", "approval_ref", "environment", "scope_country", "hosts", "_within", "_excluded", "_lacking")


def free_text(rows: DataFrame, needle: str) -> DataFrame:
    """Rows with the text anywhere in any column, without case."""
    found = [F.coalesce(F.contains(F.lower(F.col(c).cast("string")), F.lit(needle.lower())), F.lit(False))
             for c in rows.columns]
    return rows.where(reduce(lambda a, b: a | b, found))


# --- Freshness --------------------------------------------------------------------------------------------

def is_fresh(source: Column, state: Column, collection: Column, as_of: Column, decision_day: Column,
             collections=("SUCCESS", "READY")) -> Column:
    """Ready, collected, and no older than its source allows; a future observation is not fresh."""
    age = F.datediff(decision_day, as_of)
    limit = lookup(source, schemas.MAX_AGE_DAYS)
    return F.coalesce((F.upper(state) == "READY") & F.upper(F.coalesce(collection, F.lit("SUCCESS"))).isin(*collections)
                      & (age >= 0) & (age <= limit), F.lit(False))


# --- Snapshot and evidence rows ---------------------------------------------------------------------------

# Metric -> group, unit and the source that owns it.
METRICS = {
    "sessions": ("Behavior", "count", "GA4"), "engaged_sessions": ("Behavior", "count", "GA4"),
    "non_paid_leads": ("Business", "count", "business"), "successful_conversions": ("Business", "count", "business"),
    "sql": ("Business", "count", "business"),
}
BUSINESS_SOURCES = ["Excel Actual", "Salesforce", "Salesforce / Excel Actual"]
SNAPSHOT_TEXT = [*schemas.SNAPSHOT_KEY, "loaded_at", "source_reference", "revision_note", "unit", "source_timezone"]


def snapshot_errors(rows: DataFrame, contract_version: str, workbook: str, scope: DataFrame | None = None) -> DataFrame:
    """Add ``errors``: every contract rule a snapshot row breaks.

    ``scope`` (site, host, property, timezone) bounds the behaviour segments; it is a contract table of a few rows.
    """
    c = F.col
    start, end = dates.strict_date(c("period_start")), dates.strict_date(c("period_end"))
    as_of = dates.strict_date(c("as_of_date"))
    group = lookup(c("metric"), {m: v[0] for m, v in METRICS.items()})
    unit = lookup(c("metric"), {m: v[1] for m, v in METRICS.items()})
    owner = lookup(c("metric"), {m: v[2] for m, v in METRICS.items()})
    business = owner == "business"

    def unusable(name):
        value = c(name).cast("double")
        return value.isNotNull() & (F.isnan(value) | (F.abs(value) == float("inf")) | (value < 0))

    rules = [
        (c("contract_version") != contract_version, "CONTRACT_VERSION"),
        *[(blank(f), f"EMPTY_{f.upper()}") for f in SNAPSHOT_TEXT],
        (dates.zoned_timestamp(c("loaded_at")).isNull(), "LOADED_AT_NEEDS_ZONE"),
        (start.isNull() | end.isNull() | as_of.isNull(), "INVALID_DATE"),
        (as_of > dates.reporting_day_of_text(c("loaded_at")), "AS_OF_AFTER_LOADED"),
        ((start > end) | (end > as_of), "PERIOD_ORDER"),
        (~c("metric_granularity").isin("Daily", "Monthly"), "GRANULARITY"),
        ((c("metric_granularity") == "Daily") & (start != end), "DAILY_SPANS_DAYS"),
        (~c("data_status").isin(schemas.SNAPSHOT_STATES), "DATA_STATUS"),
        (group.isNull() | (c("metric_group") != group) | (c("unit") != unit), "METRIC_CONTRACT"),
        (F.when(business, ~c("source").isin(BUSINESS_SOURCES)).otherwise(c("source") != owner), "SOURCE_NOT_AUTHORITATIVE"),
        (business & ~F.contains(c("source_reference"), F.lit(workbook)), "WORKBOOK_REFERENCE"),
        ((c("metric") == "sql") & ((c("metric_granularity") != "Monthly") | (F.day(start) != 1) | (end != F.last_day(start))),
         "FULL_MONTH_COHORT"),
        *[(unusable(f), f"{f.upper()}_NOT_NONNEGATIVE") for f in ("value", "denominator", "target")],
        (c("value") != F.floor("value"), "VALUE_NOT_WHOLE"),
        ((c("data_status") == "Ready") & c("value").isNull(), "READY_WITHOUT_VALUE"),
        ((c("data_status") == "Failed") & c("value").isNotNull(), "FAILED_WITH_VALUE"),
    ]
    if scope is not None:
        site, host = F.get_json_object("segment", "$.site"), F.get_json_object("segment", "$.hostname")
        channel = F.get_json_object("segment", "$.channel")
        canonical = hashing.json_object({"channel": hashing.json_text(channel), "hostname": hashing.json_text(host),
                                         "site": hashing.json_text(site)})
        bounds = scope.select(F.col("site").alias("_s"), F.col("host").alias("_h"), F.col("property").alias("_p"),
                              F.col("timezone").alias("_z"))
        rows = rows.join(bounds, site == F.col("_s"), "left")
        behaviour = c("source") == "GA4"
        rules += [
            (behaviour & F.coalesce(c("segment") != canonical, F.lit(True)), "SEGMENT_NOT_CANONICAL"),
            (behaviour & F.coalesce((host != c("_h")) | ~channel.isin(schemas.BEHAVIOUR_CHANNELS)
                                    | (c("platform_property") != c("_p")), F.lit(True)), "SEGMENT_OUTSIDE_SCOPE"),
            (behaviour & (c("source_timezone") != c("_z")), "SOURCE_TIMEZONE"),
        ]
    checked = rows.withColumn("errors", codes(*rules))
    return checked.drop("_s", "_h", "_p", "_z") if scope is not None else checked


def evidence_errors(rows: DataFrame) -> DataFrame:
    """Add ``errors``: every rule an evidence record breaks on its own, references aside."""
    c = F.col
    refs = F.transform("entity_refs", lambda r: F.concat_ws("|", r["entity_type"], r["entity_id"]))
    required = ["evidence_id", "source", "source_class", "metric", "unit", "source_reference", "contract_version"]
    return rows.withColumn("errors", codes(
        *[(blank(f), f"MISSING_{f.upper()}") for f in required],
        ((c("revision") < 1) | c("revision").isNull(), "INVALID_REVISION"),
        (F.coalesce(source_class(c("source")), F.lit("")) != F.coalesce(c("source_class"), F.lit("")), "INVALID_SOURCE_SEMANTICS"),
        (~c("freshness_state").isin(schemas.FRESHNESS_STATES), "INVALID_FRESHNESS_STATE"),
        (c("freshness_state").isin("FAILED", "NOT_AVAILABLE") & c("value").isNotNull(), "INVALID_VALUE"),
        (F.isnan(c("value")) | (F.abs("value") == float("inf")), "NONFINITE_NUMBER"),
        ((c("period_start") > c("period_end")) | (c("period_end") > c("as_of"))
         | (c("as_of") > F.to_date("retrieved_at")), "INVALID_DATE_ORDER"),
        (F.size(F.array_distinct(refs)) != F.size(refs), "DUPLICATE_ENTITY_REF"),
        (c("supersedes_evidence_id") != c("evidence_id"), "INVALID_SUPERSEDES")))


# --- Sensitive data ---------------------------------------------------------------------------------------

def sensitive_flags(rows: DataFrame, columns: list[str]) -> DataFrame:
    """Add flags for secrets, e-mail addresses and phone numbers in any of the text columns."""
    def anywhere(test):
        return reduce(lambda a, b: a | b, [F.coalesce(test(F.col(c)), F.lit(False)) for c in columns])
    return rows.withColumns({"has_secret": anywhere(text.has_secret), "has_email": anywhere(text.has_email),
                             "has_phone": anywhere(text.has_phone)})


def sensitive_columns(rows: DataFrame) -> list[tuple[str, str]]:
    """Column names that promise a secret or a personal datum."""
    import re
    found = []
    for name in rows.columns:
        if re.search(text.SECRET_KEYS, name):
            found.append((name, "SECRET_REJECTED"))
        elif re.search(text.PERSONAL_KEYS, name):
            found.append((name, "PII_REJECTED"))
    return found


def redacted(rows: DataFrame, columns: list[str]) -> DataFrame:
    return rows.withColumns({c: text.redact(F.col(c)) for c in columns})


def formula_safe(rows: DataFrame) -> DataFrame:
    """Guard every text cell against being read as a formula."""
    return rows.withColumns({name: text.formula_safe(F.col(name)) for name, kind in rows.dtypes if kind == "string"})


# --- Completeness, sets and schemas -----------------------------------------------------------------------

def action_gate(actions: DataFrame, fields: list[str]) -> DataFrame:
    """How many actions fill every field, how many are P1, and whether the P1 limit of five holds."""
    complete = reduce(lambda a, b: a & b, [~blank(f) for f in fields])
    top = F.count_if(F.col("priority") == "P1")
    return actions.agg(F.count(F.lit(1)).alias("actions"), F.count_if(complete).alias("complete"),
                       top.alias("p1"), (top <= 5).alias("p1_within_limit"))


def missing_members(rows: DataFrame, key: str, member: str, expected: list[str]) -> DataFrame:
    """Expected members a key lacks; any gap makes the whole key Partial.

    Only expected members are collected, so the set of a key is never longer than the list.
    """
    seen = rows.groupBy(key).agg(F.collect_set(F.when(F.col(member).isin(expected), F.col(member))).alias("_seen"))
    missing = F.array_sort(F.array_except(F.array(*[F.lit(e) for e in expected]), "_seen"))
    return seen.select(key, missing.alias("missing"), F.when(F.size(missing) > 0, "Partial").otherwise("Ready").alias("data_status"))


def role_gaps(rows: DataFrame, required: str, missing: str, covered: str) -> DataFrame:
    """Required roles neither declared missing nor covered, and roles declared missing although covered."""
    return rows.withColumns({
        "undeclared": F.array_sort(F.array_except(F.array_except(required, missing), covered)),
        "contradicted": F.array_sort(F.array_intersect(missing, covered))})


def first_by_key(rows: DataFrame, keys: list[str], seq: str) -> DataFrame:
    """First row per key by arrival, with the number of later copies dropped.

    ``min_by`` keeps one row per key on the map side already, so copies of a hot key never gather in one task.
    """
    whole = F.struct(*[F.col(c) for c in rows.columns])
    kept = rows.groupBy(*[F.col(k).alias(f"_{k}") for k in keys]).agg(
        F.min_by(whole, F.col(seq)).alias("_row"), (F.count(F.lit(1)) - 1).alias("dropped"))
    return kept.select("_row.*", "dropped")


def distinct_by_hash(rows: DataFrame, columns: list[str]) -> DataFrame:
    """One row per content hash of the named columns."""
    return rows.withColumn("content_hash", hashing.row_hash(rows, columns)).dropDuplicates(["content_hash"])


def schema_difference(rows: DataFrame, expected: list[str]) -> dict[str, list[str]]:
    return {"missing": sorted(set(expected) - set(rows.columns)), "unexpected": sorted(set(rows.columns) - set(expected))}


def same_set(left: Column, right: Column) -> Column:
    return F.array_sort(F.array_distinct(left)) == F.array_sort(F.array_distinct(right))


def multiset_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows one side holds more often than the other, with both counts; empty when the sides agree.

    Both sides meet in one aggregation, combined in every task first, so equal rows do not travel and a task holds each
    distinct row once.
    """
    columns = left.columns

    def marked(rows, mine, other):
        return rows.select(*columns, F.lit(mine).cast("long").alias("_left"), F.lit(other).cast("long").alias("_right"))

    both = marked(left, 1, 0).unionByName(marked(right, 0, 1))
    sums = both.groupBy(*columns).agg(F.sum("_left").alias("left_rows"), F.sum("_right").alias("right_rows"))
    return sums.where("left_rows <> right_rows")


def missing_from(rows: DataFrame, other: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct keys of ``rows`` that ``other`` does not hold."""
    return rows.select(*keys).distinct().join(other.select(*keys).distinct(), keys, "left_anti")


