"""Provider rows as evidence: business actuals, keyword database, result pages, AI prompts, behaviour."""

from pyspark.sql import Column, DataFrame, functions as F

from sightline import schemas
from sightline.functions import dates, hashing, labels, numbers
from sightline.functions.text import norm_domain, norm_text
from sightline.functions.urls import host_of, landing_url, norm_url
from sightline.operators import joins
from sightline.operators.quality import blank, codes, first_by_key, first_code, optional


# --- Business actuals -------------------------------------------------------------------------------------

def business_actuals(rows: DataFrame, mapping: DataFrame, as_of: str, workbook: str) -> DataFrame:
    """Status and first problem of every business source row.

    ``rows``: ``row_no, metric, metric_label, source_tab, source_row, source_column, period, actual, target,
    segment, source_reference, formula``; ``mapping`` adds ``row_label, allowed_segments, formula_policy`` per
    metric and tab and one row per month place.
    """
    c = F.col
    start = dates.month_start(c("period"))
    shaped = rows.withColumns({"period_start": start, "month": F.date_format(start, "MM"), "source_column": F.upper("source_column"),
                               "value": numbers.count_cell(c("actual")), "goal": numbers.count_cell(c("target"))})
    located = joins.month_locations(shaped, mapping.select("metric", "source_tab", "source_row", F.upper("source_column").alias("source_column"), "month"))
    policy = mapping.groupBy("metric", "source_tab").agg(
        F.max("row_label").alias("_label"), F.max("allowed_segments").alias("_segments"), F.max("formula_policy").alias("_policy"))
    joined = located.join(policy, ["metric", "source_tab"], "left")
    unplaced = c("location_problem").isin("UNSUPPORTED_METRIC", "SOURCE_NOT_CONFIRMED")
    judged = joined.withColumn("problem", first_code(
        (unplaced & (c("location_problem") == "UNSUPPORTED_METRIC"), "UNSUPPORTED_METRIC"), (unplaced, "SOURCE_NOT_CONFIRMED"),
        (start.isNull(), "INVALID_PERIOD"), (c("location_problem") == "MAPPING_DRIFT", "MAPPING_DRIFT"),
        (F.trim("metric_label") != c("_label"), "MAPPING_DRIFT"), (F.coalesce(~F.contains(c("source_reference"), F.lit(workbook)), F.lit(True)), "SOURCE_REFERENCE_REQUIRED"),
        (~F.array_contains("_segments", c("segment")), "UNKNOWN_SEGMENT"), (~blank("formula") & (c("_policy") == "raw_only"), "FORMULA_VALUE_NOT_ALLOWED"),
        (c("value.error").isNotNull() | c("goal.error").isNotNull(), "MALFORMED_NUMBER")))
    sound = judged.where("problem IS NULL").groupBy("metric", "period_start", "segment").agg(F.min("row_no").alias("_first"))
    full = judged.join(sound, ["metric", "period_start", "segment"], "left").withColumn(
        "problem", F.coalesce("problem", F.when(c("row_no") != c("_first"), "DUPLICATE_BUSINESS_KEY")))
    mature = dates.mature_on(c("period_start"))
    return full.select(
        "row_no", "metric", "segment", "period_start", c("value.value").alias("value"), c("goal.value").alias("target"),
        F.when(blank("formula"), "raw").otherwise("formula_result").alias("value_origin"), F.when(c("metric") == "sql", mature).alias("maturity_date"),
        F.when(c("metric") == "sql", mature <= F.lit(as_of).cast("date")).alias("mature_cohort"),
        F.when(c("problem").isNotNull(), "REJECTED").when(c("value.value").isNull(), "PARTIAL").otherwise("READY").alias("candidate_status"), "problem")


# --- Keyword database -------------------------------------------------------------------------------------

def keyword_rows(rows: DataFrame, decision_day: str) -> DataFrame:
    """Keyword and competitor rows in one shape, the first of each identity, malformed ones marked.

    ``rows``: ``seq, endpoint, country, target, date`` and the provider fields of either endpoint under their
    current or earlier names.
    """
    c = F.col
    has = set(rows.columns)

    def field(*names):
        return F.coalesce(*[c(n) for n in names if n in has], F.lit(None))

    keyword = c("endpoint") == "organic_keywords"
    subject = F.nullif(F.trim(F.when(keyword, field("keyword")).otherwise(field("competitor_domain", "competitor_url", "competitor"))), F.lit(""))
    url = F.when(keyword, field("best_position_url", "url")).otherwise(field("competitor_url"))
    figures = {
        "position": F.when(keyword, field("best_position").cast("double")),
        "volume": F.when(keyword, field("volume")).otherwise(field("volume_target", "volume_competitor")).cast("double"),
        "difficulty": F.when(keyword, field("keyword_difficulty", "difficulty")).otherwise(field("keyword_difficulty_target", "keyword_difficulty")).cast("double"),
        "traffic_estimate": F.when(keyword, field("sum_traffic", "traffic")).otherwise(field("traffic", "traffic_target")).cast("double")}
    age = F.datediff(F.lit(decision_day).cast("date"), c("date"))
    shaped = rows.select("seq", "endpoint", "country", "target", "date", subject.alias("subject"), url.alias("raw_url"), norm_url(url).alias("url"),
                         *[v.alias(n) for n, v in figures.items()],
                         F.when(age < 0, "UNKNOWN").when(age <= schemas.MAX_AGE_DAYS["AHREFS"], "FRESH").otherwise("STALE").alias("freshness_state"))
    unique = first_by_key(shaped, ["endpoint", "country", "target", "subject", "raw_url", "date"], "seq")
    negative = hashing.any_of([F.coalesce(c(n) < 0, F.lit(False)) for n in figures])
    malformed = first_code((c("subject").isNull(), "MISSING_SUBJECT"), (negative, "NEGATIVE_NUMBER"))
    return unique.withColumn("problem", malformed).drop("raw_url")


def keyword_metadata(normalised: DataFrame) -> DataFrame:
    """Row counts per endpoint: returned, accepted, duplicate, malformed."""
    return normalised.groupBy("endpoint").agg(
        (F.count(F.lit(1)) + F.sum("dropped")).alias("returned_rows"), F.count_if(F.col("problem").isNull()).alias("accepted_rows"),
        F.sum("dropped").alias("duplicate_rows"), F.count("problem").alias("malformed_rows"))


def ingestion_manifest(metadata: DataFrame, normalised: DataFrame) -> DataFrame:
    """Status of every endpoint: FAILED without rows, STALE with a stale one, PARTIAL after drops, else READY."""
    stale = normalised.groupBy("endpoint").agg(F.coalesce(F.bool_or((F.col("freshness_state") == "STALE") & F.col("problem").isNull()), F.lit(False)).alias("_stale"))
    c = F.col
    return metadata.join(stale, "endpoint", "left").withColumn("status", F.when(c("returned_rows") == 0, "FAILED").when(c("_stale"), "STALE").when(
        (c("duplicate_rows") > 0) | (c("malformed_rows") > 0), "PARTIAL").otherwise("READY")).drop("_stale")


def run_status(manifest: DataFrame) -> DataFrame:
    """One status for a run from its endpoints' statuses, with row totals."""
    def some(*names):
        return F.bool_or(F.col("status").isin(*names))
    return manifest.agg(
        F.sum("returned_rows").alias("returned_rows"), F.sum("accepted_rows").alias("accepted_rows"),
        F.when(some("STALE"), "STALE").when(F.bool_and(F.col("status") == "READY"), "READY").when(some("READY", "PARTIAL"), "PARTIAL")
        .when(some("NOT_AVAILABLE"), "NOT_AVAILABLE").otherwise("FAILED").alias("status"))


# --- Result pages -----------------------------------------------------------------------------------------

#: Results of a page that a reader is shown first; later ones are marked, not dropped.
FIRST_RESULTS = 30


def result_rows(snapshots: DataFrame, owned: DataFrame, competitors: DataFrame, registry: DataFrame) -> DataFrame:
    """Organic results of every snapshot as rows with page identity, owner and type; ``beyond_cap`` marks late ranks.

    ``snapshots``: ``snapshot_id, organic_results array<{rank, url, title, snippet, result_type}>``.  What depends on the URL
    alone is found once for each distinct URL, since the same pages come up on very many result pages.
    """
    flat = snapshots.select("snapshot_id", F.inline("organic_results"))
    kept = flat.withColumn("beyond_cap", F.coalesce(F.col("rank") > FIRST_RESULTS, F.lit(False)))
    known = F.lower("result_type").isin(list(labels.PAGE_TYPES))
    typed = kept.withColumn("result_type", F.when(known, F.lower("result_type")).otherwise("unknown"))
    named = flat.select(F.col("url").alias("_url")).distinct().withColumns({
        "normalized_url": norm_url(F.col("_url")), "domain": F.rtrim(host_of(F.col("_url")), F.lit("."))})
    matched = joins.resolve_exactly_one(named, "normalized_url", registry, "normalized_url", "url_id")
    pages = joins.domain_owner(matched.drop("match_state").withColumn("url_match_state", url_match("url_id")), "domain", owned, competitors)
    return typed.join(pages, F.col("url").eqNullSafe(F.col("_url"))).drop("_url")


def url_match(url_id: str) -> Column:
    """CANONICAL for a URL that is exactly one of the registry, else UNMAPPED_URL."""
    return F.when(F.col(url_id).isNotNull(), "CANONICAL").otherwise("UNMAPPED_URL")


def feature_states(snapshots: DataFrame, column: str = "serp_features") -> DataFrame:
    """Features of result pages as ``features map<string, string>`` with ``feature_problem``, the first thing wrong with them.

    ``column`` is a map of feature to state or a list of features that were seen.  Names are trimmed and in lower case,
    states in upper case; the last of several entries with one name stands.  A row with a problem keeps no features,
    one whose column is null has none.
    """
    kind = dict(snapshots.dtypes)[column]
    given = F.map_entries(column) if kind.startswith("map") else F.transform(column, lambda n: F.struct(n.alias("key"), F.lit("OBSERVED").alias("value")))
    clean = F.transform(given, lambda e: F.struct(F.lower(F.trim(e["key"])).alias("key"), F.upper(e["value"]).alias("value")))
    rows = snapshots.withColumn("_features", F.coalesce(clean, F.array().cast("array<struct<key:string,value:string>>")))
    problem = first_code(
        (F.exists("_features", lambda e: F.coalesce(e["key"] == "", F.lit(True))), "INVALID_FIELD"),
        (F.exists("_features", lambda e: ~F.coalesce(e["value"].isin(schemas.FEATURE_STATES), F.lit(False))), "INVALID_FEATURE_STATE"))
    last = F.filter("_features", lambda e, i: ~F.exists(F.slice("_features", i + 2, F.size("_features")), lambda later: later["key"] == e["key"]))
    ordered = F.map_from_entries(F.array_sort(last))
    return rows.withColumn("feature_problem", problem).withColumn(
        "features", F.when(F.col("feature_problem").isNull(), ordered).otherwise(F.create_map().cast("map<string,string>"))).drop("_features")


def result_page_states(snapshots: DataFrame) -> DataFrame:
    """Collection and freshness of every snapshot after its results were looked at, and the first problem with them."""
    c = F.col
    results = c("organic_results")
    failed = c("collection_status").isin("FAILED", "NOT_AVAILABLE") | c("freshness_state").isin("FAILED", "NOT_AVAILABLE")
    ranks = F.transform(results, lambda r: r["rank"])
    size = F.size(results)
    none = results.isNull()
    return snapshots.withColumns({
        "problem": first_code(
            (~c("freshness_state").isin(schemas.FRESHNESS_STATES), "INVALID_FRESHNESS_STATE"), (~c("collection_status").isin(schemas.COLLECTION_STATES), "INVALID_COLLECTION_STATUS"),
            (F.exists(ranks, lambda r: F.coalesce(r < 1, F.lit(True))), "INVALID_RANK"), (F.size(F.array_distinct(ranks)) != size, "DUPLICATE_RANK"),
            (F.exists(results, lambda r: norm_url_shape(r["url"])), "INVALID_RESULT_URL")),
        "beyond_cap": F.coalesce(size > FIRST_RESULTS, F.lit(False)) & ~failed,
        "collection_status": F.when(failed, c("collection_status")).when(none, "FAILED").when(
            (size == 0) & (c("collection_status") == "SUCCESS"), "PARTIAL").otherwise(c("collection_status")),
        "freshness_state": F.when(failed, c("freshness_state")).when(none, "FAILED").when((size == 0) & (c("collection_status") == "SUCCESS"), "PARTIAL").otherwise(c("freshness_state")),
        "observed_results": F.when(failed | none, 0).otherwise(size)}).drop("organic_results")


def norm_url_shape(url):
    """True where a result URL is not an http(s) URL with a host and without user info."""
    return ~F.coalesce(url.rlike(r"^(?i)https?://[^/?#@\s]+([/?#]\S*)?$"), F.lit(False))


# --- AI prompts -------------------------------------------------------------------------------------------

def prompt_identity(rows: DataFrame, prompts: DataFrame) -> DataFrame:
    """Add ``prompt_problem`` to rows with a ``prompt_id``: UNMAPPED_PROMPT, PROMPT_IDENTITY_MISMATCH or PROMPT_VERSION_MISMATCH.

    A row may name the text and version it was asked with (``prompt_text``, ``prompt_version``); what it leaves out, and
    what ``prompts`` (``prompt_id, normalized_text, prompt_version``) do not hold as a column, is not compared.
    """
    known = prompts.groupBy("prompt_id").agg(
        F.max(optional(prompts, "normalized_text", "string")).alias("_text"), F.max(optional(prompts, "prompt_version", "string").cast("string")).alias("_version"))
    joined = rows.join(known.withColumn("_known", F.lit(True)), "prompt_id", "left")
    text, version = optional(rows, "prompt_text", "string"), optional(rows, "prompt_version", "string").cast("string")
    problem = [(F.col("_known").isNull(), "UNMAPPED_PROMPT")]
    if "normalized_text" in prompts.columns:
        problem += [(text.isNotNull() & ~norm_text(text).eqNullSafe(F.col("_text")), "PROMPT_IDENTITY_MISMATCH")]
    if "prompt_version" in prompts.columns:
        problem += [(version.isNotNull() & ~version.eqNullSafe(F.col("_version")), "PROMPT_VERSION_MISMATCH")]
    return joined.withColumn("prompt_problem", first_code(*problem)).drop("_known", "_text", "_version")


def sample_errors(samples: DataFrame, prompts: DataFrame) -> DataFrame:
    """Population size of each fixed prompt sample with the first reason it cannot be used.

    ``samples``: ``sample_id, sample_version, status, prompt_ids, effective_from, effective_to``; in place of ids,
    ``prompt_ids`` may hold structs ``prompt_id, prompt_text, prompt_version``, which are compared with the prompts.
    """
    listed = samples.select("sample_id", "sample_version", F.explode("prompt_ids").alias("prompt_id"))
    if dict(listed.dtypes)["prompt_id"].startswith("struct"):
        listed = listed.select("sample_id", "sample_version", "prompt_id.*")
    found = F.col("prompt_problem")
    counted = prompt_identity(listed, prompts).groupBy("sample_id", "sample_version").agg(
        F.count_if(found == "UNMAPPED_PROMPT").alias("_unknown"), F.count_if(found == "PROMPT_IDENTITY_MISMATCH").alias("_renamed"),
        F.count_if(found == "PROMPT_VERSION_MISMATCH").alias("_reissued"), F.count_distinct("prompt_id").alias("population"))
    joined = samples.join(counted, ["sample_id", "sample_version"], "left")
    return joined.withColumn("problem", first_code(
        (~F.col("status").isin("ACTIVE", "RETIRED", "DRAFT"), "INVALID_SAMPLE_STATUS"), (F.coalesce(F.size("prompt_ids") < 1, F.lit(True)), "EMPTY_SAMPLE"),
        (F.col("_unknown") > 0, "UNMAPPED_PROMPT"), (F.col("_renamed") > 0, "PROMPT_IDENTITY_MISMATCH"), (F.col("_reissued") > 0, "PROMPT_VERSION_MISMATCH"), (F.col("population") != F.size("prompt_ids"), "DUPLICATE_PROMPT"),
        (F.col("effective_to") < F.col("effective_from"), "INVALID_DATE_ORDER"))).drop("_unknown", "_renamed", "_reissued")


def prompt_observations(rows: DataFrame, prompts: DataFrame, samples: DataFrame, registry: DataFrame, competitors: DataFrame) -> DataFrame:
    """Observations with prompt topic, sample scope, owned page, competitor and citation; failed ones keep no value.

    Where observations name the prompt's text or version, these must be the registered ones (see ``prompt_identity``).
    """
    c = F.col
    mapped = joins.sample_scope(joins.prompt_topics(prompt_identity(rows, prompts), prompts), samples)
    named = mapped.withColumns({"owned_normalized": norm_url(c("owned_url")), "citation_normalized": norm_url(c("citation_url")), "domain": norm_domain(c("competitor_domain"))})
    pages = registry.groupBy("normalized_url").agg(F.min("url_id").alias("_id"))

    def page(df, key, name):
        return df.join(pages.select(c("normalized_url").alias(key), c("_id").alias(name)), key, "left")

    rivals = competitors.groupBy("domain").agg(F.min("competitor_id").alias("competitor_id"))
    joined = page(page(named, "owned_normalized", "owned_url_id"), "citation_normalized", "citation_url_id").join(rivals, "domain", "left")
    failed = c("freshness_state").isin("FAILED", "NOT_AVAILABLE") | c("collection_status").isin("FAILED", "NOT_AVAILABLE")
    unsupported = hashing.any_of([~F.upper(n).isin(schemas.CAPABILITY_STATES) & c(n).isNotNull() for n in ("mention_state", "citation_state")])
    return joined.withColumn("_unsupported", unsupported).withColumns({
        "citation_url_match_state": F.when(c("citation_url").isNull(), "NOT_AVAILABLE").otherwise(url_match("citation_url_id")),
        "citation_state": F.when(c("citation_url").isNotNull(), "OBSERVED").otherwise(F.coalesce(F.upper("citation_state"), F.lit("UNKNOWN"))),
        "mention_state": F.coalesce(F.upper("mention_state"), F.lit("UNKNOWN")), "unknown_domain": c("domain").isNotNull() & c("competitor_id").isNull(),
        "visibility_value": F.when(~failed, c("visibility_value")),
        "problem": first_code((c("mapping_state") != "MAPPED", "UNMAPPED"), (c("scope_state") != "OK", "SAMPLE_SCOPE_MISMATCH"), (c("prompt_problem").isNotNull(), c("prompt_problem")),
                              ((c("period_start") > c("period_end")) | (c("period_end") > c("as_of")), "INVALID_DATE_ORDER"),
                              (c("_unsupported"), "INVALID_CAPABILITY_STATE"),
                              (hashing.any_of([c(u).isNotNull() & c(n).isNull() for u, n in (("citation_url", "citation_normalized"), ("owned_url", "owned_normalized"))]), "INVALID_URL_IDENTITY"))}).drop(
        "_unsupported", "prompt_problem")


# --- Behaviour --------------------------------------------------------------------------------------------

# Metric -> unit.
BEHAVIOUR_UNITS = {"sessions": "count", "users": "count", "engaged_sessions": "count", "engagement_rate": "ratio",
                   "average_engagement_time": "seconds", "event_count": "count"}


def behaviour_evidence(rows: DataFrame, scope: DataFrame, registry: DataFrame) -> DataFrame:
    """Behaviour rows as evidence with page identity and every rule they break.

    ``rows``: ``row_id, property_id, hostname, channel, landing_page, metric, value, coverage, freshness_state,
    collection_status, period_start, period_end, as_of, retrieved_at, quality_scope``; ``scope``: ``property_id, host``.
    """
    c = F.col
    approved = scope.select("property_id", F.lower("host").alias("_host")).distinct().withColumn("_approved", F.lit(True))
    joined = rows.withColumn("_host", F.lower("hostname")).join(approved, ["property_id", "_host"], "left")
    page = c("quality_scope") == "PAGE_LEVEL"
    named = joined.withColumn("normalized_url", F.when(page, landing_url(c("landing_page"), c("hostname"))))
    matched = joins.resolve_exactly_one(named, "normalized_url", registry, "normalized_url", "url_id")
    unit = labels.lookup(c("metric"), BEHAVIOUR_UNITS)
    value = c("value")
    absent = c("freshness_state").isin("FAILED", "NOT_AVAILABLE")
    return matched.withColumns({"unit": unit, "errors": codes(
        (c("_approved").isNull(), "OUT_OF_SCOPE"), (~c("channel").isin(schemas.BEHAVIOUR_CHANNELS), "CHANNEL_OUT_OF_SCOPE"),
        (page & c("normalized_url").isNull(), "INVALID_LANDING_PAGE"), (page & c("normalized_url").isNotNull() & (c("match_state") == "UNRESOLVED"), "UNRESOLVED_ENTITY"),
        (page & (c("match_state") == "AMBIGUOUS"), "AMBIGUOUS_ENTITY"), (unit.isNull(), "UNSUPPORTED_METRIC"),
        (absent & value.isNotNull(), "VALUE_WHEN_UNAVAILABLE"), (value < 0, "NEGATIVE_VALUE"), ((unit == "ratio") & (value > 1), "RATIO_ABOVE_ONE"),
        ((unit == "count") & (value != F.floor("value")), "COUNT_NOT_WHOLE"), ((c("metric") == "event_count") & (value == 0) & ~c("coverage").isin("COMPLETE_WITHIN_SCOPE", "COMPLETE"), "ZERO_WITHOUT_COVERAGE"),
        ((c("period_start") > c("period_end")) | (c("period_end") > c("as_of")) | (c("as_of") > F.to_date("retrieved_at")), "INVALID_DATE_ORDER"))}).drop("_host", "_approved")
