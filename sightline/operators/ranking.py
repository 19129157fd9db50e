"""Sort keys, limits, priorities and budgets."""

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.functions.numbers import table_number
from sightline.operators import ordered

# Weekday names and the additive priority bounds.
WEEKDAYS = ["mon", "tue", "wed", "thu", "fri", "sat", "sun"]
P1_FROM, P2_FROM, P1_LIMIT = 12, 8, 5


def table_order(cell: str, descending: bool = False) -> list[Column]:
    """Sort keys of a display column: numbers by value, then texts; missing cells last in both directions."""
    number, raw = table_number(F.col(cell)), F.nullif(F.trim(F.col(cell)), F.lit(""))
    if descending:
        return [raw.isNull(), F.desc_nulls_last(number), F.desc_nulls_last(raw)]
    return [raw.isNull(), F.asc_nulls_last(number), F.asc_nulls_last(raw)]


def calendar_key(value: Column, order: list[str] | None = None) -> Column:
    """Sort key of a calendar category: a given order, weekdays from Monday, or the date an ISO text names."""
    if order:
        place = F.array_position(F.array(*[F.lit(v) for v in order]), value)
        return F.when(place == 0, len(order) + 1).otherwise(place)
    day = F.array_position(F.array(*[F.lit(d) for d in WEEKDAYS]), F.lower(F.substring(F.trim(value), 1, 3)))
    iso = F.try_to_date(F.when(F.length(value) == 7, F.concat(value, F.lit("-01"))).otherwise(F.substring(value, 1, 10)), "yyyy-MM-dd")
    return F.when(value.rlike(r"^\d{4}-\d{2}"), F.datediff(iso, F.lit("1970-01-01").cast("date"))).otherwise(day)


def top_per_key(rows: DataFrame, key: str, order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per key.  Spark prunes each partition to ``n`` rows per key before the shuffle."""
    window = Window.partitionBy(key).orderBy(*order)
    return rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= n)


def ranked_candidates(candidates: DataFrame, limit: int) -> DataFrame:
    """Candidates by score, missing scores last, ids breaking ties; the first screen holds 1 to 100 rows."""
    if not 1 <= limit <= 100:
        raise ValueError("limit must lie between 1 and 100")
    return candidates.orderBy(F.desc_nulls_last("score"), "candidate_id").limit(limit)


def page(rows: DataFrame, order: list[Column], number: int, size: int) -> DataFrame:
    """One page of a sorted table; the offset is answered from sorted partitions, not on the driver."""
    return rows.orderBy(*order).offset((number - 1) * size).limit(size)


def additive_priority(actions: DataFrame) -> DataFrame:
    """Sum of impact, traffic, conversion and risk minus effort, with its class and the place among P1 actions."""
    score = sum((F.col(c) for c in ("traffic_opportunity", "conversion_relevance", "technical_risk")), F.col("business_impact")) - F.col("effort")
    return actions.withColumn("priority_score", score).withColumn(
        "priority", F.when(F.col("priority_score") >= P1_FROM, "P1").when(F.col("priority_score") >= P2_FROM, "P2").otherwise("P3"))


def over_limit_p1(actions: DataFrame, action_id: str) -> DataFrame:
    """P1 actions beyond the five best, found by place so that no single task sorts every P1 action."""
    top = actions.where("priority = 'P1'")
    placed = ordered.row_numbers(top, "priority_score", action_id, "place", descending=True)
    return placed.where(F.col("place") > P1_LIMIT)


def action_queue(actions: DataFrame, limit: int = 5) -> DataFrame:
    """P0 and P1 first, then impact x opportunity x confidence / cost; a missing cost leaves the score empty."""
    score = F.try_divide((F.col("impact") * F.col("opportunity") * F.col("confidence")).cast("double"), F.col("cost").cast("double"))
    urgent = F.when(F.col("priority").isin("P0", "P1"), F.col("priority")).otherwise("P2")
    return actions.withColumn("sort_score", score).orderBy(urgent, F.desc_nulls_last("sort_score"), "action_id").limit(limit)


def by_severity(findings: DataFrame) -> DataFrame:
    """Findings from high to low severity, larger counts first."""
    order = F.when(F.col("severity") == "HIGH", 0).when(F.col("severity") == "MEDIUM", 1).otherwise(2)
    return findings.orderBy(order, F.desc("count"))


def by_visible_total(rows: DataFrame, fields: list[str], descending: bool = True) -> DataFrame:
    total = sum((F.coalesce(F.col(f), F.lit(0)) for f in fields[1:]), F.coalesce(F.col(fields[0]), F.lit(0)))
    return rows.withColumn("total", total).orderBy(F.desc("total") if descending else F.asc("total"))


def ranked_list(rows: DataFrame, order: list[Column], minimum: int = 5) -> DataFrame:
    return rows.orderBy(*order).limit(max(1, minimum))


def shortlist(rows: DataFrame, key: str, order: list[Column], cap: int = 30) -> DataFrame:
    """The first ``cap`` rows per key with a flag that tells whether more were there.

    Looking one row past the cap answers the flag, so at most ``cap + 1`` rows per key leave a partition.
    """
    window = Window.partitionBy(key).orderBy(*order)
    looked = rows.withColumn("rank", F.row_number().over(window)).where(F.col("rank") <= cap + 1)
    return looked.withColumn("truncated", F.max("rank").over(Window.partitionBy(key)) > cap).where(F.col("rank") <= cap)


def within_budget(rows: DataFrame, order: str, tie: str, cost: str, budget: float) -> DataFrame:
    """Rows in order until their running cost would pass the budget."""
    spent = ordered.running_total(rows, order, tie, F.col(cost), "spent")
    return spent.where(F.col("spent") <= budget)


def rank_errors(results: DataFrame, key: str) -> DataFrame:
    """Whether every rank of a result page is used once."""
    return results.groupBy(key).agg(
        F.count(F.lit(1)).alias("results"), (F.count_distinct("rank") == F.count(F.lit(1))).alias("unique_ranks"))
