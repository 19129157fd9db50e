"""Row shapes for charts: distributions, pivots, running balances, funnels, flows and shares.

Raw facts go through slices or pre-aggregation (see ``ordered``).  Windows over a chart's own rows are
partitioned by the chart key; such rows are one per category or day.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.functions.numbers import finite, fixed, ratio
from sightline.operators import ordered

MAX_BINS = 16


# --- Distributions ----------------------------------------------------------------------------------------

def histogram(rows: DataFrame, value: str) -> DataFrame:
    """At most about sixteen bins of a round width (1, 2, 5 or 10 times a power of ten), empty bins included."""
    known = rows.select(finite(F.col(value)).alias("v")).where("v IS NOT NULL")
    stats = known.agg(F.min("v").alias("low"), F.max("v").alias("high"), F.count(F.lit(1)).alias("n")).where("n > 0")
    target = F.greatest(F.lit(1), F.least(F.lit(MAX_BINS), F.ceil(F.sqrt("n"))))
    spread = F.when(F.col("high") > F.col("low"), F.col("high") - F.col("low")).otherwise(
        F.greatest(F.abs("high"), F.lit(1.0)))
    shape = (stats.withColumn("raw", spread / target)
             .withColumn("unit", F.pow(F.lit(10.0), F.floor(F.log10("raw"))))
             .withColumn("norm", F.col("raw") / F.col("unit"))
             .withColumn("width", F.when(F.col("norm") <= 1, 1).when(F.col("norm") <= 2, 2)
                         .when(F.col("norm") <= 5, 5).otherwise(10) * F.col("unit"))
             .withColumn("first", F.floor(F.col("low") / F.col("width")) * F.col("width"))
             .withColumn("bins", F.greatest(F.lit(1), F.ceil((F.col("high") - F.col("first")) / F.col("width")))))
    width, first, bins = (shape.select(c).scalar() for c in ("width", "first", "bins"))
    index = F.least(bins - 1, F.greatest(F.lit(0), F.floor((F.col("v") - first) / width)))
    counts = known.select(index.cast("long").alias("bin")).groupBy("bin").agg(F.count(F.lit(1)).alias("n_rows"))
    frame = shape.select("width", "first", F.explode(F.sequence(F.lit(0).cast("long"), F.col("bins").cast("long") - 1)).alias("bin"))
    return frame.join(counts, "bin", "left").select(
        "bin", (F.col("first") + F.col("bin") * F.col("width")).alias("start"),
        (F.col("first") + (F.col("bin") + 1) * F.col("width")).alias("end"),
        F.coalesce("n_rows", F.lit(0)).alias("count"))


def box_plots(rows: DataFrame, category: str, value: str) -> DataFrame:
    """Minimum, quartiles, maximum and quartile spread per category, quartiles interpolated linearly and exact."""
    marks = {"minimum": 0.0, "lower_quartile": 0.25, "median": 0.5, "upper_quartile": 0.75, "maximum": 1.0}
    known = rows.select(category, finite(F.col(value)).alias(value))
    return ordered.quantiles(known, value, marks, [category]).withColumn(
        "spread", F.col("upper_quartile") - F.col("lower_quartile"))


def summarised_box_plots(summaries: DataFrame) -> DataFrame:
    """Boxes whose five figures were reviewed already pass through with their spread."""
    return summaries.withColumn("spread", F.col("upper_quartile") - F.col("lower_quartile"))


def distribution_bars(rows: DataFrame, value: str, maximum: float = 100.0) -> DataFrame:
    """Twelve equal buckets over [0, maximum], bar heights scaled to the fullest, never below ten."""
    v = F.col(value).cast("double")
    bucket = F.least(F.lit(11), F.floor(v / maximum * 12)).cast("int")
    counts = rows.where(v.between(0, maximum)).select(bucket.alias("bucket")).groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"))
    peak = F.greatest(F.lit(1), counts.agg(F.max("n").alias("m")).scalar())
    frame = rows.sparkSession.range(12).select(F.col("id").cast("int").alias("bucket"))
    return frame.join(counts, "bucket", "left").select(
        "bucket", F.coalesce("n", F.lit(0)).alias("count"),
        F.greatest(F.lit(10.0), F.coalesce("n", F.lit(0)) / peak * 100).alias("height"))


def percentile_ranks(rows: DataFrame, value: str) -> DataFrame:
    return ordered.percentile_ranks(rows, value)


# --- Top categories ---------------------------------------------------------------------------------------

def _additive(rows: DataFrame, category: str, value: str, group: str | None = None) -> Column:
    """Scalar: every row is groupable (named, unique, not called "other", a non-negative finite number)."""
    keys = [category] if group is None else [group, category]
    name = F.trim(F.col(category))
    per_row = ((name.isNotNull()) & (name != "") & (F.lower(name) != "other")
               & finite(F.col(value)).isNotNull() & (F.col(value) >= 0))
    if group is not None:
        per_row = per_row & F.col(group).isNotNull()
    folded = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), F.bool_and(F.coalesce(per_row, F.lit(False))).alias("ok"))
    return folded.agg((F.bool_and("ok") & (F.max("n") == 1)).alias("ok")).scalar()


def _leaders(peaks: DataFrame, category: str, value: str, limit: int, preserve: list[str]) -> DataFrame:
    """The categories that keep their own row: preserved ones, then the largest, one place left for "Other"."""
    chosen = peaks.withColumn("_kept", F.when(F.col(category).isin(list(preserve)), 0).otherwise(1))
    return chosen.orderBy("_kept", F.desc(value), category).limit(limit - 1).select(F.col(category).alias("_leader"))


def top_categories(rows: DataFrame, category: str, value: str, limit: int = 7, preserve: list[str] = ()) -> DataFrame:
    """Largest categories of an additive measure and the sum of the rest as "Other".

    Rows pass through unchanged when they fit, or when the measure cannot be summed safely.
    """
    size = rows.agg(F.count(F.lit(1)).alias("n")).scalar()
    foldable = F.coalesce(_additive(rows, category, value), F.lit(False)) & (size > limit)
    if len(set(preserve)) >= limit:
        return rows.select(category, value)
    leaders = _leaders(rows, category, value, limit, preserve)
    marked = rows.join(leaders, F.col(category) == F.col("_leader"), "left")
    label = F.when(foldable & F.col("_leader").isNull(), "Other").otherwise(F.col(category))
    return marked.groupBy(label.alias(category)).agg(F.sum(value).alias(value))


def top_series(rows: DataFrame, group: str, category: str, value: str, limit: int = 7, preserve: list[str] = ()) -> DataFrame:
    """The same per group, with the leading categories ranked by their peak over all groups."""
    peaks = rows.groupBy(category).agg(F.max(value).alias(value))
    size = peaks.agg(F.count(F.lit(1)).alias("n")).scalar()
    foldable = F.coalesce(_additive(rows, category, value, group), F.lit(False)) & (size > limit)
    leaders = _leaders(peaks, category, value, limit, preserve)
    marked = rows.join(leaders, F.col(category) == F.col("_leader"), "left")
    label = F.when(foldable & F.col("_leader").isNull(), "Other").otherwise(F.col(category))
    return marked.groupBy(group, label.alias(category)).agg(F.sum(value).alias(value))


def share_of_total(rows: DataFrame, value: str, keys: list[str] = ()) -> DataFrame:
    """Each row against the total of its stack, or of the whole chart."""
    if not keys:
        return rows.withColumn("share", ratio(F.col(value), rows.agg(F.sum(value).alias("t")).scalar()))
    totals = rows.groupBy(*keys).agg(F.sum(value).alias("_total"))
    return rows.join(totals, list(keys)).withColumn("share", ratio(F.col(value), F.col("_total"))).drop("_total")


def goal_ratios(rows: DataFrame, value: str, target: str, projection: str) -> DataFrame:
    """Progress towards a positive goal, and bullet marks on a common scale a little wider than the data."""
    peak = rows.agg(F.greatest(F.lit(1.0), *[F.max(F.col(c).cast("double")) for c in (value, target, projection)]).alias("m"))
    scale = peak.scalar() * 1.08

    def mark(column):
        return F.least(F.lit(1.0), F.col(column) / scale)

    return rows.withColumns({
        "progress": F.when(F.col(target) > 0, F.least(F.lit(1.0), F.col(value) / F.col(target))),
        "value_mark": mark(value), "target_mark": mark(target), "projection_mark": mark(projection)})


# --- Pivots and grids -------------------------------------------------------------------------------------

def pivot(rows: DataFrame, x: str, series: str, values: list[str], value: str) -> DataFrame:
    """Long rows to one column per named series; a missing cell stays null."""
    return rows.groupBy(x).pivot(series, values).agg(F.sum(value))


def heatmap(rows: DataFrame, x: str, y: str, value: str, gaps: bool = False) -> DataFrame:
    """The cells of every y over the whole x axis, a missing one being null or zero, with an intensity on 0..1.

    ``x`` is a calendar axis (months, days), which each line spans from its own generator; no two tables are crossed.
    The zero-based scale gives way to the observed range when all values lie close together at the top.
    """
    cells = rows.groupBy(x, y).agg(F.sum(value).alias("value"))
    present = cells.agg(F.min("value").alias("low"), F.max("value").alias("high")).select(
        F.struct("low", "high").alias("s")).scalar()
    low, high = present["low"].cast("double"), present["high"].cast("double")
    top, bottom = F.greatest(high, F.lit(0.0)), F.least(low, F.lit(0.0))
    compressed = (low > 0) & (top > low) & (low / top > 0.7)
    minimum = F.when(compressed, low).otherwise(bottom)
    axis = cells.select(x).distinct().agg(F.collect_list(x).alias("axis")).scalar()
    grid = cells.select(y).distinct().withColumn("_axis", axis).select(F.explode("_axis").alias(x), y)
    blank = F.lit(None).cast("double") if gaps else F.lit(0.0)
    return grid.join(cells, [x, y], "left").select(
        x, y, F.coalesce(F.col("value").cast("double"), blank).alias("value"), F.col("value").isNull().alias("missing"),
        F.when(F.col("value").isNull(), 0.0).otherwise(F.greatest(F.lit(0.0), F.least(
            F.lit(1.0), (F.col("value") - minimum) / F.greatest(top - minimum, F.lit(2.220446049250313e-16))))).alias("intensity"))


# --- Running balances, funnels, flows ---------------------------------------------------------------------

BEGINNING = r"^(before|beginning|opening|starting|initial)(\s+(balance|total|value))?$"
ENDING = r"^(after|ending|closing|final)(\s+(balance|total|value))?$|^(end|net)\s+total$"


def total_kind(role: Column, category: Column, is_total: Column) -> Column:
    """Beginning, ending or subtotal row of a waterfall, told by its role or else its label."""
    role = F.lower(F.trim(F.coalesce(role, F.lit(""))))
    named = F.when(role != "", role).otherwise(F.lower(F.trim(category)))
    return (F.when(named.rlike(BEGINNING), "beginning").when(named.rlike(ENDING), "ending")
            .when(F.coalesce(is_total, F.lit(False)) | (role == "total"), "total"))


def waterfall(rows: DataFrame, key: str, seq: str, category: str, value: str, role: str | None = None,
              derive_ending: bool = False) -> DataFrame:
    """Running balance per waterfall; a total row restates the balance and the movements go on from there.

    When no row is a total and the first value plus all movements equals the last, the ends are inferred.
    ``seq`` gives the row order, which has no meaning without it.
    """
    by_key = Window.partitionBy(key)
    order = by_key.orderBy(seq)
    amount = F.coalesce(finite(F.col(value)), F.lit(0.0))
    kind = total_kind(F.col(role) if role else F.lit(None).cast("string"), F.col(category), F.lit(False))
    based = rows.select("*", kind.alias("_kind"), amount.alias("_v")).withColumns({
        "_n": F.count(F.lit(1)).over(by_key), "_pos": F.row_number().over(order),
        "_sum": F.sum("_v").over(by_key), "_peak": F.greatest(F.lit(1.0), F.max(F.abs("_v")).over(by_key)),
        "_marked": F.count("_kind").over(by_key), "_known": F.count(finite(F.col(value))).over(by_key)})
    last_value = F.last("_v").over(by_key.orderBy(seq).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    inferred = ((F.col("_n") >= 3) & (F.col("_marked") == 0) & (F.col("_known") == F.col("_n"))
                & (F.abs(F.col("_sum") - 2 * last_value) <= F.col("_peak") * 2.220446049250313e-16 * 16))
    typed = based.withColumn("total_type", F.coalesce(
        "_kind", F.when(inferred & (F.col("_pos") == 1), "beginning")
        .when(inferred & (F.col("_pos") == F.col("_n")), "ending")))
    runs = typed.withColumn("_run", F.count("total_type").over(order))
    balanced = runs.withColumn("balance", F.sum("_v").over(Window.partitionBy(key, "_run").orderBy(seq)))
    is_total = F.col("total_type").isNotNull()
    before = F.when(is_total, 0.0).otherwise(F.col("balance") - F.col("_v"))
    shaped = balanced.where("_n >= 2").select(
        key, seq, category, F.col("_v").alias("value"), F.least(before, F.col("balance")).alias("baseline"),
        F.abs(F.col("balance") - before).alias("magnitude"), F.when(~is_total, F.col("_v")).alias("change"),
        "balance", is_total.alias("is_total"), "total_type")
    if not derive_ending:
        return shaped
    ends = shaped.groupBy(key).agg(
        F.max(seq).alias("_last"), F.max_by("balance", seq).alias("balance"),
        F.bool_or(F.coalesce(F.col("total_type") == "ending", F.lit(False))).alias("_has_end"),
        F.bool_or(F.coalesce(F.col("total_type") == "beginning", F.lit(False))).alias("_has_start"))
    extra = ends.where("_has_start AND NOT _has_end").select(
        key, (F.col("_last") + 1).cast(dict(rows.dtypes)[seq]).alias(seq), F.lit("Ending").alias(category),
        F.col("balance").alias("value"), F.least(F.lit(0.0), F.col("balance")).alias("baseline"),
        F.abs("balance").alias("magnitude"), F.lit(None).cast("double").alias("change"), "balance",
        F.lit(True).alias("is_total"), F.lit("ending").alias("total_type"))
    return shaped.unionByName(extra)


def waterfall_domain(shaped: DataFrame, key: str) -> DataFrame:
    """Value axis of each waterfall with a margin of twelve per cent, or one per cent of the largest value."""
    low = F.least("balance", F.when(F.col("is_total"), F.col("balance")).otherwise(F.col("baseline")))
    high = F.greatest("balance", F.when(F.col("is_total"), F.col("balance"))
                      .otherwise(F.col("baseline") + F.col("magnitude")))
    ends = shaped.groupBy(key).agg(F.min(low).alias("low"), F.max(high).alias("high"))
    margin = F.greatest((F.col("high") - F.col("low")) * 0.12,
                        F.greatest(F.abs("low"), F.abs("high"), F.lit(1.0)) * 0.01)
    return ends.select(key, (F.col("low") - margin).alias("domain_low"), (F.col("high") + margin).alias("domain_high"))


def funnel(stages: DataFrame, key: str, seq: str, value: str) -> DataFrame:
    """Conversion, change, share of the first stage and drop-off; unusable stages break the chain."""
    order = Window.partitionBy(key).orderBy(seq)
    v = F.when(finite(F.col(value)) >= 0, finite(F.col(value)))
    based = stages.withColumn("_v", v).withColumns({"_prev": F.lag("_v").over(order), "_first": F.first("_v").over(order)})
    conversion = F.when(F.col("_prev") > 0, F.col("_v") / F.col("_prev"))
    return based.withColumns({
        "conversion": conversion, "change": conversion - 1,
        "share": F.when(F.col("_first") > 0, F.col("_v") / F.col("_first")),
        "dropoff": F.col("_prev") - F.col("_v")}).drop("_v", "_prev", "_first")


def sankey_links(rows: DataFrame, stages: list[str], value: str) -> DataFrame:
    """Flows between consecutive non-empty stages of each row, summed over positive amounts."""
    steps = F.filter(F.array(*[F.struct(F.lit(i).alias("stage"), F.col(s).cast("string").alias("name"))
                               for i, s in enumerate(stages)]),
                     lambda s: s["name"].isNotNull() & (s["name"] != ""))
    paths = rows.where(finite(F.col(value)) > 0).select(steps.alias("steps"), F.col(value).alias("amount"))
    hops = paths.where(F.size("steps") > 1).select("amount", F.explode(F.zip_with(
        F.slice("steps", 1, F.size("steps") - 1), F.slice("steps", 2, F.size("steps") - 1),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")))).alias("hop"))
    return hops.groupBy(
        F.col("hop.a.stage").alias("source_stage"), F.col("hop.a.name").alias("source"),
        F.col("hop.b.stage").alias("target_stage"), F.col("hop.b.name").alias("target")).agg(F.sum("amount").alias("value"))


def sankey_nodes(links: DataFrame) -> DataFrame:
    return links.select(F.col("source_stage").alias("stage"), F.col("source").alias("name")).union(
        links.select("target_stage", "target")).distinct()


# --- Lines ------------------------------------------------------------------------------------------------

def isolated_points(rows: DataFrame, key: str, x: str, value: str) -> DataFrame:
    """Points of a line with no neighbour on either side."""
    order = Window.partitionBy(key).orderBy(x)
    v = finite(F.col(value))
    alone = v.isNotNull() & F.lag(v).over(order).isNull() & F.lead(v).over(order).isNull()
    return rows.withColumn("_alone", alone).where("_alone").drop("_alone")


def sparkline(rows: DataFrame, key: str, x: str, value: str) -> DataFrame:
    """Points scaled to their own range and split into segments where a value is missing.

    A line with fewer than two points is not drawn.
    """
    by_key, order = Window.partitionBy(key), Window.partitionBy(key).orderBy(x)
    v = finite(F.col(value))
    shaped = rows.select(key, x, v.alias("v")).withColumns({
        "index": F.row_number().over(order) - 1, "_n": F.count(F.lit(1)).over(by_key),
        "_known": F.count("v").over(by_key), "_low": F.min("v").over(by_key), "_high": F.max("v").over(by_key),
        "_gap": F.sum(F.when(F.col("v").isNull(), 1).otherwise(0)).over(order)})
    kept = shaped.where("_known >= 2 AND v IS NOT NULL").withColumn(
        "segment", F.dense_rank().over(Window.partitionBy(key).orderBy("_gap")))
    span = F.greatest(F.col("_high") - F.col("_low"), F.lit(2.220446049250313e-16))
    return kept.select(key, x, "segment", (F.col("index") / (F.col("_n") - 1)).alias("x_position"),
                       ((F.col("v") - F.col("_low")) / span).alias("y_position"))


def thinned_ticks(rows: DataFrame, x: str, max_ticks: int = 6) -> DataFrame:
    """Every n-th distinct axis value, so that at most ``max_ticks`` remain."""
    values = rows.select(x).where(F.col(x).isNotNull()).distinct()
    size = values.agg(F.count(F.lit(1)).alias("n")).scalar()
    stride = F.when(size <= max_ticks, 1).otherwise(F.ceil(size / max_ticks))
    numbered = ordered.before_value(values, x, F.lit(1))
    return numbered.where(F.col("before") % stride == 0).select(x)


def annotation_values(rows: DataFrame, x: str, benchmark: str, event: str) -> DataFrame:
    """Benchmark and event note of each x, only where all rows agree on one value."""
    text = F.when(F.trim(F.col(event)) != "", F.trim(F.col(event)))
    same = (F.min(benchmark) == F.max(benchmark)) & (F.count(benchmark) == F.count(F.lit(1)))
    return rows.groupBy(x).agg(
        F.when(same, F.min(benchmark)).alias("benchmark"),
        F.when(F.min(text) == F.max(text), F.min(text)).alias("event"))


def bar_issues(rows: DataFrame, low: str, high: str, values: list[str], goal: str) -> DataFrame:
    """One row of flags: unordered ranges, signed values, incomplete segments, goals that are not positive."""
    def any_row(condition):
        return F.coalesce(F.bool_or(condition), F.lit(False))

    def one_of(parts):
        return reduce(lambda a, b: a | b, parts)

    return rows.agg(
        any_row(F.col(low) > F.col(high)).alias("unordered_range"),
        any_row(one_of([F.col(v) < 0 for v in values])).alias("signed_values"),
        any_row(one_of([F.col(v).isNull() for v in values])).alias("incomplete_segments"),
        any_row(F.coalesce(~(F.col(goal) > 0), F.lit(True))).alias("goal_not_positive"))


def chart_columns(rows: DataFrame, required: list[str], optional: list[str] = ()) -> DataFrame:
    """The columns a chart needs; a missing required one is an error, a missing optional one is skipped."""
    absent = [c for c in required if c not in rows.columns]
    if absent:
        raise ValueError(f"chart columns missing: {absent}")
    return rows.select(*required, *[c for c in optional if c in rows.columns and c not in required])


def rounded(rows: DataFrame, *columns: str, places: int = 6) -> DataFrame:
    return rows.withColumns({c: fixed(F.col(c).cast("double"), places) for c in columns})


def group_counts(rows: DataFrame, group: str, groups: list[str], visible: str) -> DataFrame:
    """Total and visible rows of each of a fixed set of groups; an empty group counts zero."""
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"), F.count_if(F.col(visible)).alias("_v"))
    frame = rows.sparkSession.createDataFrame([(g,) for g in groups], f"{group} string")
    return frame.join(counts, group, "left").select(
        group, F.coalesce("_n", F.lit(0)).alias("total"), F.coalesce("_v", F.lit(0)).alias("visible"))
