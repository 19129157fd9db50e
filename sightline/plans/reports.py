"""Report models: monthly tables, weekly row, opportunity preview."""

from pyspark.sql import Column, DataFrame, functions as F

from sightline.functions.hashing import json_number, json_object, json_text
from sightline.functions.labels import source_class
from sightline.functions.numbers import change, ratio
from sightline.operators import facts, ranking
from sightline.operators.charts import group_counts
from sightline.operators.revisions import resolve_pins
from sightline.schemas import SOURCE_CLASS


# --- Monthly report ---------------------------------------------------------------------------------------

def monthly_model(search: DataFrame, behaviour: DataFrame, visibility: DataFrame, business: DataFrame, base_channel: str, top: int = 20) -> dict[str, DataFrame]:
    """Every table of the monthly report, each one lazy plan over the facts.

    The monthly totals feed several tables and are small; the caller persists ``search`` only when it is cheaper
    to keep than to scan.
    """
    monthly = facts.site_month_totals(search)
    channels = facts.channel_totals(behaviour)

    def detail(column):
        totals = facts.search_totals(search, F.col("site"), F.col(column))
        return ranking.top_per_key(totals, "site", [F.desc("clicks"), F.asc(column)], top)

    renamed = business.select("month", F.col("leads").alias("actual"), F.col("target_leads").alias("target"))
    return {"search_monthly": monthly, "search_delta": facts.last_two_months(monthly), "search_pages": detail("page"), "search_queries": detail("query"),
            "channels_monthly": facts.share_of_channel(channels, base_channel), "visibility_monthly": facts.visibility_by_month(visibility),
            "business": facts.attainment(renamed)}


# --- Weekly report ----------------------------------------------------------------------------------------

def weekly_changes(search: DataFrame, behaviour: DataFrame, last_day: str) -> DataFrame:
    """Clicks, impressions and sessions of the last seven days against the seven before, one row."""
    end = F.lit(last_day).cast("date")

    def total(column, weeks_back):
        inside = F.col("day").between(F.date_sub(end, 7 * weeks_back + 6), F.date_sub(end, 7 * weeks_back))
        return F.sum(F.when(inside, F.col(column)))

    def sides(rows, *columns):
        recent = rows.where(F.col("day").between(F.date_sub(end, 13), end))
        return recent.agg(F.struct(*[total(c, w).alias(f"{c}_{n}") for c in columns for w, n in ((0, "current"), (1, "previous"))]).alias("s")).scalar()

    one = search.sparkSession.range(1).select(sides(search, "clicks", "impressions").alias("a"), sides(behaviour, "sessions").alias("b"))
    flat = one.select("a.*", "b.*")
    return flat.withColumns({f"{c}_change": change(F.col(f"{c}_current"), F.col(f"{c}_previous")) for c in ("clicks", "impressions", "sessions")})


def data_quality(sources: dict[str, DataFrame], day: str, first: str, last: str, expected_days: int) -> DataFrame:
    """Rows and days every source delivered in a period: fail without rows, warning with days missing, else pass."""
    parts = [df.where(F.col(day).between(F.lit(first).cast("date"), F.lit(last).cast("date"))).agg(
        F.lit(name).alias("source"), F.count(F.lit(1)).alias("rows"), F.count_distinct(day).alias("days")) for name, df in sources.items()]
    stacked = parts[0]
    for part in parts[1:]:
        stacked = stacked.unionByName(part)
    return stacked.withColumn("status", F.when(F.col("rows") == 0, "fail").when(F.col("days") < expected_days, "warning").otherwise("pass"))


def weekly_actions(actions: DataFrame, fields: list[str]) -> DataFrame:
    """Scored actions with whether each answers problem, impact, outcome and how-to."""
    complete = F.lit(True)
    for field in fields:
        complete = complete & (F.coalesce(F.trim(field), F.lit("")) != "")
    return ranking.additive_priority(actions).withColumn("complete", complete)


# --- Opportunity preview ----------------------------------------------------------------------------------

# Preview groups and what belongs to them.
GROUPS = ["QUICK_WINS", "CONTENT_GAPS", "CONTENT_DECAY_TECHNICAL_UNLOCK", "GEO_GAPS"]
GEO_TYPES = ["GEO", "GEO_GAP", "GEO_ENHANCE", "GEO_PROMPT_GAP", "GEO_CITATION_GAP", "GEO_ENTITY_GAP"]
CONTENT_TYPES = ["CONTENT_GAP", "SEO_NEW", "CREATE_NEW", "CONTENT_OPPORTUNITY"]
REPAIR_TYPES = ["CONTENT_DECAY", "TECHNICAL_UNLOCK", "TECHNICAL_ISSUE", "SF_TECHNICAL"]


def preview_group(kind: Column, action: Column) -> Column:
    return (F.when(kind.isin(GEO_TYPES) | action.isin("GEO_ENHANCE", "GEO_CREATE"), "GEO_GAPS")
            .when(kind.isin(CONTENT_TYPES) | (action == "CREATE_NEW"), "CONTENT_GAPS")
            .when(kind.isin(REPAIR_TYPES) | action.isin("FIX_TECHNICAL", "REFRESH_CONTENT", "REPAIR_TECHNICAL"), "CONTENT_DECAY_TECHNICAL_UNLOCK")
            .otherwise("QUICK_WINS"))


def preview_id(dataset: str, candidate: Column, revision: Column) -> Column:
    text = json_object({"dataset": json_text(F.lit(dataset)), "candidate_id": json_text(candidate), "revision": json_number(revision)})
    return F.concat(F.lit("UAT_"), F.substring(F.sha2(text, 256), 1, 20))


def preview_rows(candidates: DataFrame, dataset: str, cap: int = 20) -> DataFrame:
    """Every candidate with its group and preview identity, the first screen marked; scores are shown, not computed.

    The first screen is at most a hundred rows, found by a distributed top-k and joined back by id.
    """
    grouped = candidates.withColumns({"group_id": preview_group(F.upper("opportunity_type"), F.upper("recommended_action")),
                                      "uat_id": preview_id(dataset, F.col("candidate_id"), F.col("revision"))})
    screen = ranking.ranked_candidates(grouped.select("candidate_id", "revision", "score"), cap).select("candidate_id", "revision", F.lit(True).alias("_first"))
    return grouped.join(screen, ["candidate_id", "revision"], "left").withColumn(
        "first_screen", F.coalesce("_first", F.lit(False))).drop("_first")


def preview_groups(rows: DataFrame) -> DataFrame:
    return group_counts(rows, "group_id", GROUPS, "first_screen")


def source_layers(pins: DataFrame, evidence: DataFrame) -> DataFrame:
    """Availability of every source family behind every candidate; a family without evidence is stated as missing.

    ``pins``: ``candidate_id, evidence_id, revision, content_hash``.  A pin whose record moved counts as unavailable.
    """
    state = resolve_pins(pins, evidence, ["evidence_id"])
    detail = evidence.select("evidence_id", "revision", "source", "collection_status")
    held = state.join(detail, ["evidence_id", "revision"], "left").where("pin_state = 'OK'")
    layers = held.groupBy("candidate_id", "source").agg(
        F.count(F.lit(1)).alias("evidence"), F.bool_or(F.col("collection_status").isin("SUCCESS", "READY")).alias("_up"))
    every = pins.select("candidate_id").distinct().withColumn("source", F.explode(F.array(*[F.lit(s) for s in SOURCE_CLASS])))
    return every.join(layers, ["candidate_id", "source"], "left").select(
        "candidate_id", "source", F.coalesce("evidence", F.lit(0)).alias("evidence"),
        F.when(F.col("_up"), "AVAILABLE").otherwise("NOT_AVAILABLE").alias("status"), F.col("evidence").isNull().alias("missing"),
        (source_class(F.col("source")) == "THIRD_PARTY_ESTIMATE").alias("is_estimate"))


def evidence_timeline(pins: DataFrame, evidence: DataFrame) -> DataFrame:
    """Period and freshness of every pinned record; what does not resolve exactly is not available."""
    state = resolve_pins(pins, evidence, ["evidence_id"])
    detail = evidence.select("evidence_id", "revision", "period_end", "as_of", "freshness_state", "collection_status")
    joined = state.join(detail, ["evidence_id", "revision"], "left")
    ok = F.col("pin_state") == "OK"
    return joined.select(
        "candidate_id", "evidence_id", "revision", "pin_state", F.when(ok, F.col("period_end")).alias("period_end"), F.when(ok, F.col("as_of")).alias("as_of"),
        F.when(ok, F.coalesce("freshness_state", F.lit("NOT_AVAILABLE"))).otherwise("NOT_AVAILABLE").alias("freshness_state"),
        F.coalesce(ok & (F.col("freshness_state") == "READY") & F.col("collection_status").isin("SUCCESS", "READY"), F.lit(False)).alias("is_current"))


def outcome_shares(outcomes: DataFrame) -> DataFrame:
    """Tally and share of outcome states per checkpoint."""
    tally = facts.state_tally(outcomes, "checkpoint", "outcome_state")
    totals = tally.groupBy("checkpoint").agg(F.sum("outcomes").alias("_total"))
    return tally.join(totals, "checkpoint").withColumn("share", ratio(F.col("outcomes"), F.col("_total"))).drop("_total")
