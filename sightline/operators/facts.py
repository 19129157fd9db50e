"""Aggregates over search, behaviour, visibility and business facts.

Every aggregate is sum-over-sum and combines on the map side first, so a site holding a large share of the
rows costs no more than any other.
"""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.functions.dates import mature_on, month_key, month_start
from sightline.functions.labels import vital_rating
from sightline.functions.numbers import change, ratio
from sightline.schemas import VITALS


# --- Search facts -----------------------------------------------------------------------------------------

def search_totals(search: DataFrame, *keys: Column) -> DataFrame:
    """Clicks, impressions, click-through rate and impression-weighted position per key."""
    weighted = F.sum(F.col("position") * F.col("impressions"))
    return search.groupBy(*keys).agg(
        F.count_distinct("day").alias("days"), F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"),
        ratio(F.sum("clicks"), F.sum("impressions")).alias("ctr"),
        ratio(weighted, F.sum("impressions")).alias("position"))


def site_month_totals(search: DataFrame) -> DataFrame:
    return search_totals(search, F.col("site"), month_key(F.col("day")).alias("month"))


def search_rollup(search: DataFrame) -> DataFrame:
    """Breakdown rows by site and month together with their "all" rows (grouping sets)."""
    base = search.withColumn("month", month_key(F.col("day")))
    return (base.cube("site", "month")
            .agg(F.sum("clicks").alias("clicks"), F.sum("impressions").alias("impressions"),
                 F.grouping("site").alias("gs"), F.grouping("month").alias("gm"))
            .select(F.when(F.col("gs") == 1, "all").otherwise(F.col("site")).alias("site"),
                    F.when(F.col("gm") == 1, "all").otherwise(F.col("month")).alias("month"),
                    "clicks", "impressions", ratio(F.col("clicks"), F.col("impressions")).alias("ctr")))


def last_two_months(monthly: DataFrame) -> DataFrame:
    """Each site's latest month against the one before it; a site with a single month is left out."""
    order = Window.partitionBy("site").orderBy(F.desc("month"))
    ranked = monthly.withColumn("_rn", F.row_number().over(order)).where("_rn <= 2")

    def pick(column, rn):
        return F.max(F.when(F.col("_rn") == rn, F.col(column)))

    wide = ranked.groupBy("site").agg(
        F.count(F.lit(1)).alias("_n"),
        *[pick(c, rn).alias(f"{c}_{name}") for c in ("month", "clicks", "impressions", "ctr", "position")
          for rn, name in ((1, "current"), (2, "previous"))])
    return wide.where("_n = 2").drop("_n").withColumns({
        "clicks_change": change(F.col("clicks_current"), F.col("clicks_previous")),
        "impressions_change": change(F.col("impressions_current"), F.col("impressions_previous")),
        "ctr_change_pp": (F.col("ctr_current") - F.col("ctr_previous")) * 100,
        "position_change": F.col("position_current") - F.col("position_previous")})


# --- Behaviour facts --------------------------------------------------------------------------------------

def channel_totals(behaviour: DataFrame) -> DataFrame:
    """Site x channel x month sessions, engaged sessions and engagement rate; sites are never summed together."""
    return behaviour.groupBy("site", "channel", month_key(F.col("day")).alias("month")).agg(
        F.sum("sessions").alias("sessions"), F.sum("engaged").alias("engaged"),
        ratio(F.sum("engaged"), F.sum("sessions")).alias("engagement_rate"))


def channel_comparison(behaviour: DataFrame, current: tuple, previous: tuple) -> DataFrame:
    """Two periods side by side per site and channel; a side without rows stays null (full outer)."""
    def during(period):
        return F.col("day").between(F.lit(period[0]).cast("date"), F.lit(period[1]).cast("date"))

    def total(column, period):
        return F.sum(F.when(during(period), F.col(column)))

    either = behaviour.where(during(current) | during(previous))
    sides = either.groupBy("site", "channel").agg(
        total("sessions", previous).alias("sessions_previous"), total("sessions", current).alias("sessions_current"),
        ratio(total("engaged", previous), total("sessions", previous)).alias("engagement_previous"),
        ratio(total("engaged", current), total("sessions", current)).alias("engagement_current"))
    return sides.withColumn("sessions_change", change(F.col("sessions_current"), F.col("sessions_previous")))


def share_of_channel(monthly: DataFrame, base_channel: str) -> DataFrame:
    """Every channel's sessions against the base channel of the same site and month; absent base gives null."""
    whole = Window.partitionBy("site", "month")
    base = F.max(F.when(F.col("channel") == base_channel, F.col("sessions"))).over(whole)
    return monthly.select("site", "month", "channel", "sessions", F.when(
        F.col("channel") != base_channel, ratio(F.col("sessions"), base)).alias("share_of_base"))


def event_state(behaviour: DataFrame, keys: list[str]) -> DataFrame:
    """Event total per key with its state: PRESENT, WEAK for a real zero, NOT_AVAILABLE without observations."""
    return behaviour.groupBy(*keys).agg(
        F.sum("event_count").alias("events"), F.count("event_count").alias("observations")).select(
        *keys, "events", F.when(F.col("observations") == 0, "NOT_AVAILABLE").when(F.col("events") > 0, "PRESENT")
        .otherwise("WEAK").alias("state"))


# --- AI visibility ----------------------------------------------------------------------------------------

def visibility_by_month(visibility: DataFrame) -> DataFrame:
    """Equal-weight mean over days that have a value, mention total and day count per entity and month."""
    return visibility.groupBy("entity", month_key(F.col("day")).alias("month")).agg(
        F.avg("visibility").alias("visibility"), F.avg("sov").alias("sov"),
        F.sum(F.coalesce("mentions", F.lit(0))).alias("mentions"), F.count_distinct("day").alias("days"))


def visibility_comparison(visibility: DataFrame, current: tuple, previous: tuple) -> DataFrame:
    """Entity means of two day ranges with the change in percentage points, null unless both sides have a mean."""
    def mean(column, period):
        return F.avg(F.when(F.col("day").between(F.lit(period[0]).cast("date"), F.lit(period[1]).cast("date")), F.col(column)))

    return visibility.groupBy("entity").agg(
        mean("visibility", previous).alias("visibility_previous"), mean("visibility", current).alias("visibility_current"),
        mean("sov", previous).alias("sov_previous"), mean("sov", current).alias("sov_current")).withColumn(
        "visibility_change_pp", (F.col("visibility_current") - F.col("visibility_previous")) * 100)


def platform_overview(observations: DataFrame, platform: str, value: str, keys: list[str]) -> DataFrame:
    """Equal-weight mean of platform means; a platform without a value takes no part."""
    per_platform = observations.groupBy(*keys, platform).agg(F.avg(value).alias("_mean"))
    return per_platform.groupBy(*keys).agg(
        F.avg("_mean").alias("overview"), F.count("_mean").alias("platforms"))


# --- Business actuals -------------------------------------------------------------------------------------

def attainment(business: DataFrame) -> DataFrame:
    """Actual against target and against the month before."""
    previous = business.select(F.date_format(F.add_months(month_start(F.col("month")), 1), "yyyy-MM").alias("month"),
                               F.col("actual").alias("_previous"))
    joined = business.join(previous, "month", "left")
    return joined.select("month", "actual", "target", ratio(F.col("actual"), F.col("target")).alias("reach"),
                         change(F.col("actual"), F.col("_previous")).alias("mom_change"),
                         (F.col("target") - F.col("actual")).alias("gap"))


def mature_cohorts(business: DataFrame, as_of: str) -> DataFrame:
    """Totals over cohorts whose maturity date has passed, and how many are still open."""
    mature = mature_on(month_start(F.col("month"))) <= F.lit(as_of).cast("date")

    def total(column):
        return F.sum(F.when(mature, F.col(column)))

    rate, goal = ratio(total("conversions"), total("leads")), ratio(total("target_conversions"), total("target_leads"))
    return business.agg(
        F.count_if(mature).alias("mature_months"), F.count_if(~mature).alias("open_months"),
        total("leads").alias("leads"), total("conversions").alias("conversions"), rate.alias("rate"),
        goal.alias("target_rate"), (rate - goal).alias("rate_gap"))


def year_over_year(monthly: DataFrame, value: str) -> DataFrame:
    """Each month against the same month a year before; a month without a partner keeps a null change."""
    prior = monthly.select(F.date_format(F.add_months(month_start(F.col("month")), 12), "yyyy-MM").alias("month"),
                           F.col(value).alias("prior_year"))
    return monthly.join(prior, "month", "left").select(
        "month", value, "prior_year", change(F.col(value), F.col("prior_year")).alias("yoy_change"))


def matched_year_totals(monthly: DataFrame, value: str, year: int) -> DataFrame:
    """A year against the previous one over the months both of them have."""
    sides = monthly.select(F.substring("month", 1, 4).cast("int").alias("y"), F.substring("month", 6, 2).alias("m"), value)
    pairs = sides.where(F.col("y").isin(year, year - 1)).groupBy("m").agg(
        F.sum(F.when(F.col("y") == year, F.col(value))).alias("current"),
        F.sum(F.when(F.col("y") == year - 1, F.col(value))).alias("previous")).dropna()
    return pairs.agg(F.count(F.lit(1)).alias("months"), F.sum("current").alias("current"),
                     F.sum("previous").alias("previous"),
                     change(F.sum("current"), F.sum("previous")).alias("yoy_change"))


# --- Web vitals -------------------------------------------------------------------------------------------

def vitals_assessment(vitals: DataFrame, keys: list[str]) -> DataFrame:
    """An origin passes when every core vital is rated good; with fewer ratings it is undecided."""
    core = [metric for metric, *_, is_core in VITALS if is_core]
    rated = vitals.where(F.col("metric").isin(core)).withColumn("rating", vital_rating(F.col("metric"), F.col("p75")))
    return rated.groupBy(*keys).agg(
        F.count("rating").alias("rated"), F.coalesce(F.bool_and(F.col("rating") == "GOOD"), F.lit(False)).alias("_all")).select(
        *keys, "rated", F.when(F.col("rated") < len(core), "INSUFFICIENT").when(F.col("_all"), "PASS")
        .otherwise("FAIL").alias("assessment"))


# --- Counters ---------------------------------------------------------------------------------------------

def dashboard_counters(rows: DataFrame, conditions: dict[str, Column], latest: tuple[str, str] | None = None) -> DataFrame:
    """One row of conditional counts, plus the latest non-empty value of a column by an order column."""
    columns = [F.count_if(condition).alias(name) for name, condition in conditions.items()]
    if latest:
        value, order = latest
        columns.append(F.max_by(value, F.when(F.col(value).isNotNull(), F.col(order))).alias(f"last_{value}"))
    return rows.agg(F.count(F.lit(1)).alias("rows"), *columns)


def status_summary(rows: DataFrame, status: str, code: str, row_id: str) -> DataFrame:
    """Row count per status with the number of distinct failing rows and of error codes."""
    return rows.groupBy(status).agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_distinct(F.when(F.col(code).isNotNull(), F.col(row_id))).alias("error_rows"),
        F.count(code).alias("errors"))


def headline(metrics: dict[str, DataFrame]) -> dict[str, Column]:
    """Scalar subqueries of one-row, one-column frames, to select side by side without a cross join."""
    return {name: frame.scalar().alias(name) for name, frame in metrics.items()}


def date_coverage(rows: DataFrame, day: str, keys: list[str] = ()) -> DataFrame:
    return rows.groupBy(*keys).agg(
        F.min(day).alias("first_day"), F.max(day).alias("last_day"), F.count_distinct(day).alias("days"))


def sitemap_counts(sitemaps: DataFrame) -> DataFrame:
    """Submitted and indexed totals of a sitemap's content breakdown; an empty breakdown has no total."""
    def total(field):
        values = F.transform("breakdown", lambda b: b[field].try_cast("long"))
        return F.when(F.size("breakdown") > 0, F.aggregate(values, F.lit(0).cast("long"), lambda a, v: a + v))
    return sitemaps.withColumns({"submitted": total("submitted"), "indexed": total("indexed")})


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """Row count of every published table."""
    parts = [df.agg(F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows")) for name, df in tables.items()]
    result = parts[0]
    for part in parts[1:]:
        result = result.unionByName(part)
    return result


def crawl_metadata(metrics: DataFrame, wanted: dict[str, str]) -> DataFrame:
    """Crawl summary metrics, one row per crawl and one column per wanted metric."""
    return metrics.groupBy("crawl_id").agg(*[
        F.max(F.when(F.col("metric") == metric, F.col("value"))).alias(name) for name, metric in wanted.items()])


def independent_families(evidence: DataFrame, keys: list[str]) -> DataFrame:
    """Evidence records and distinct source families per key."""
    return evidence.groupBy(*keys).agg(
        F.count_distinct("evidence_id").alias("evidence"), F.count_distinct("source").alias("families"))


def reference_sets(rows: DataFrame, key: str, reference: str) -> DataFrame:
    """Distinct references per key, one per row, with how often each was named.

    The set stays in rows: a key that is referenced from everywhere never becomes one huge array.
    """
    return rows.where(F.col(reference).isNotNull()).groupBy(key, reference).agg(F.count(F.lit(1)).alias("mentions"))


def fold_states(observations: DataFrame, keys: list[str], state: str, name: str) -> DataFrame:
    """Any observed wins; all not-observed; any not-available; otherwise unknown."""
    s = F.col(state)
    return observations.groupBy(*keys).agg(
        F.when(F.bool_or(s == "OBSERVED"), "OBSERVED")
        .when(F.bool_and(F.coalesce(s == "NOT_OBSERVED", F.lit(False))), "NOT_OBSERVED")
        .when(F.bool_or(s == "NOT_AVAILABLE"), "NOT_AVAILABLE").otherwise("UNKNOWN").alias(name))


def dominant_kind(rows: DataFrame, keys: list[str], kind: str, name: str) -> DataFrame:
    """Most frequent kind per key, ties alphabetical; under 60 % with several kinds it is MIXED."""
    counts = rows.groupBy(*keys, kind).agg(F.count(F.lit(1)).alias("n"))
    return counts.groupBy(*keys).agg(
        F.min(F.struct((-F.col("n")).alias("n"), F.col(kind).alias("kind"))).alias("top"),
        F.sum("n").alias("total"), F.count(F.lit(1)).alias("kinds")).select(
        *keys, "total", F.when((F.col("kinds") > 1) & (-F.col("top.n") / F.col("total") < 0.6), "MIXED")
        .otherwise(F.col("top.kind")).alias(name))


def state_tally(outcomes: DataFrame, checkpoint: str, state: str) -> DataFrame:
    return outcomes.groupBy(checkpoint, state).agg(F.count(F.lit(1)).alias("outcomes"))
