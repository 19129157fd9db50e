"""Reporting periods: windows, presets, reviewed-row filters, trends and period-over-period comparisons."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from sightline.functions.dates import month_start
from sightline.functions.numbers import change

# Days a source needs to settle before its figures count, and the look-back of a daily pull.
LOOKBACK_DAYS = 10
SETTLE_DAYS = {"search": 3, "behaviour": 2}
# Decay needs six windows and a fall of a fifth.
DECAY_WINDOWS = 6
DECAY_KEEP = 0.8


def recent_window(rows: DataFrame, as_of: str, source: str, day: str = "day") -> DataFrame:
    """Rows inside the daily pull window of a source, relative to an explicit day."""
    today = F.lit(as_of).cast("date")
    return rows.where(F.col(day).between(F.date_sub(today, LOOKBACK_DAYS), F.date_sub(today, SETTLE_DAYS[source])))


def common_end(day_columns: list[DataFrame]) -> Column:
    """Earliest of the latest days of several one-column frames, as a scalar subquery."""
    ends = [df.select(F.max(df.columns[0])).scalar() for df in day_columns]
    return F.least(*ends) if len(ends) > 1 else ends[0]


# --- Reviewed rows ----------------------------------------------------------------------------------------

def _is_all(field: str) -> Column:
    return F.lower(F.coalesce(F.col(field).cast("string"), F.lit(""))) == "all"


def _only_if(rows: DataFrame, guard: DataFrame, condition: Column) -> DataFrame:
    """Keep rows meeting ``condition``, but only when ``guard`` (one row) says so; otherwise keep all."""
    return rows.where(~F.coalesce(guard.scalar(), F.lit(False)) | condition)


def reviewed_rows(rows: DataFrame, filters, breakdown: list[str] = (), through: list[str] = ()) -> DataFrame:
    """Apply report filters to reviewed rows.

    ``filters`` maps a field to ``"all"``, one value, a list of values or a ``"start..end"`` range, as a dict or
    as pairs (several scopes may filter one field).  Exact filters come first.  Where a field is unfiltered, its
    "all" aggregate rows are preferred unless the field is a breakdown, in which case they are left out.  A range
    keeps only its latest endpoint unless the field is a breakdown running ``through`` the period.
    """
    pairs = list(filters.items()) if isinstance(filters, dict) else list(filters)
    pairs = [(f, "all" if isinstance(v, (list, tuple)) and not v else v) for f, v in pairs]
    ranged = [(f, v) for f, v in pairs if isinstance(v, str) and ".." in v]
    picked, latest = rows, []
    for field, value in [p for p in pairs if p not in ranged and p[1] != "all"]:
        text = F.col(field).cast("string")
        if isinstance(value, (list, tuple)):
            picked = picked.where(text.isin([str(v) for v in value]))
        elif field in through and field in breakdown:
            picked = picked.where(text <= str(value))
        else:
            picked = picked.where(text == str(value))
    for field, value in ranged:
        start, end = value.split("..")
        picked = picked.where(F.col(field).cast("string").between(start, end))
        if not (field in through and field in breakdown):
            latest.append(field)
    unfiltered = list(dict.fromkeys(f for f, v in pairs if isinstance(v, str) and v == "all"))
    for field in [f for f in unfiltered if f in breakdown]:
        mixed = picked.agg((F.bool_or(_is_all(field)) & F.bool_or(~_is_all(field))).alias("mixed"))
        picked = _only_if(picked, mixed, ~_is_all(field))
    for field in [f for f in unfiltered if f not in breakdown]:
        has_all = picked.agg(F.bool_or(_is_all(field)).alias("has_all"))
        picked = _only_if(picked, has_all, _is_all(field))
    for field in latest:
        newest = picked.agg(F.max(F.col(field).cast("string")).alias("newest")).scalar()
        picked = picked.where(F.col(field).cast("string") == newest)
    return picked


def section_rows(rows: DataFrame, page_filters: dict, section_filters: dict, breakdown: list[str] = ()) -> DataFrame:
    """Page and section filters in one pass, so no range collapses before both scopes have applied."""
    return reviewed_rows(rows, [*page_filters.items(), *section_filters.items()], breakdown)


def previous_period_rows(rows: DataFrame, filters: dict, period: str, current: str) -> DataFrame:
    """Rows of the last period before ``current`` under the other filters."""
    prior = reviewed_rows(rows, {f: "all" if f == period else v for f, v in filters.items()}).where(F.col(period) < current)
    newest = prior.agg(F.max(period).alias("p")).scalar()
    return prior.where(F.col(period) == newest)


def period_view(rows: DataFrame, filters: dict, period: str, which: str, breakdown: list[str] = ()) -> DataFrame:
    """``history``, ``latest`` or ``previous`` rows of a report block under its filters."""
    fields = list(dict.fromkeys([*breakdown, period]))
    scoped = reviewed_rows(rows, filters, fields, through=[period])
    if which == "history":
        return scoped
    newest = scoped.agg(F.max(period).alias("p")).scalar()
    if which == "latest":
        return scoped.where(F.col(period) == newest)
    open_filters = {f: ("all" if f == period else v) for f, v in filters.items()}
    before = reviewed_rows(rows, open_filters, fields).where(F.col(period) < newest)
    second = before.agg(F.max(period).alias("p")).scalar()
    return before.where(F.col(period) == second)


def filter_choices(rows: DataFrame, field: str) -> DataFrame:
    """Distinct non-empty values of a field except "all"."""
    text = F.col(field).cast("string")
    return rows.select(text.alias("choice")).where((F.trim("choice") != "") & ~_is_all("choice")).distinct()


def range_presets(rows: DataFrame, day: str = "day") -> DataFrame:
    """Last 7 days, last 28 days and last month, anchored to the latest day and kept only where data reaches."""
    spans = rows.agg(F.min(day).alias("first"), F.max(day).alias("last"))
    start_of_month = F.trunc("last", "month")
    presets = F.array(
        F.struct(F.lit("Last 7 days").alias("label"), F.date_sub("last", 6).alias("start"), F.col("last").alias("end")),
        F.struct(F.lit("Last 28 days").alias("label"), F.date_sub("last", 27).alias("start"), F.col("last").alias("end")),
        F.struct(F.lit("Last month").alias("label"), F.add_months(start_of_month, -1).alias("start"),
                 F.date_sub(start_of_month, 1).alias("end")))
    return spans.select("first", "last", F.inline(presets)).where(
        (F.col("start") >= F.col("first")) & (F.col("end") <= F.col("last"))).select("label", "start", "end")


def zoom_rows(rows: DataFrame, field: str, one: str, other: str) -> DataFrame:
    """Rows between two endpoints given in either order; nothing unless more than one row lies there."""
    low, high = sorted([one, other])
    inside = rows.where(F.col(field).cast("string").between(low, high) & F.lit(low != high))
    return inside.where(inside.agg(F.count(F.lit(1)).alias("n")).scalar() > 1)


# --- Trends -----------------------------------------------------------------------------------------------

def period_over_period(rows: DataFrame, key: str, period: str, value: str) -> DataFrame:
    """Each period beside the one before it, with relative and point change."""
    order = Window.partitionBy(key).orderBy(period)
    return rows.withColumn("previous", F.lag(value).over(order)).withColumns({
        "change": change(F.col(value), F.col("previous")),
        "change_pp": (F.col(value) - F.col("previous")) * 100})


def monthly_series(monthly: DataFrame, key: str, months: int = 6) -> DataFrame:
    """The last ``months`` rows of each key, flagged where the month before is missing; gaps are not filled."""
    recent = Window.partitionBy(key).orderBy(F.desc("month"))
    order = Window.partitionBy(key).orderBy("month")
    kept = monthly.withColumn("_rn", F.row_number().over(recent)).where(F.col("_rn") <= months).drop("_rn")
    before = F.lag(month_start(F.col("month"))).over(order)
    return kept.withColumn("gap", F.coalesce(F.add_months(before, 1) < month_start(F.col("month")), F.lit(False)))


def newest(rows: DataFrame, keys: list[str], period: str, count: int) -> DataFrame:
    """The newest rows of each key, numbered in ``rn``; tasks drop all but ``count`` of a key before they are shuffled."""
    order = Window.partitionBy(*keys).orderBy(F.desc(period))
    return rows.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= count)


def _same_keys(counts: DataFrame, latest: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key on both sides; keys may be null."""
    renamed = latest.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys])
    return counts.join(renamed, same).drop(*[f"_{k}" for k in keys])


def trend_signal(rows: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Direction of the last two periods per key.

    Two different values for one period are a conflict; one period is too little history; a missing or
    unusable value leaves the direction unknown.
    """
    per_period = rows.groupBy(*keys, period).agg(
        F.max(value).alias("value"), (F.min(value) != F.max(value)).alias("clash"))
    counts = per_period.groupBy(*keys).agg(F.count(F.lit(1)).alias("periods"), F.coalesce(F.bool_or("clash"), F.lit(False)).alias("clash"))
    latest = newest(per_period, keys, period, 2).groupBy(*keys).agg(
        F.max(F.when(F.col("rn") == 1, F.col("value"))).alias("current"),
        F.max(F.when(F.col("rn") == 2, F.col("value"))).alias("previous"))
    folded = _same_keys(counts, latest, keys)
    return folded.select(*keys, "periods", "current", "previous", F.when(F.col("clash"), "CONFLICT")
                         .when(F.col("periods") < 2, "INSUFFICIENT_HISTORY")
                         .when(F.col("current").isNull() | F.col("previous").isNull(), "UNKNOWN")
                         .when(F.col("current") > F.col("previous"), "INCREASING")
                         .when(F.col("current") < F.col("previous"), "DECLINING").otherwise("STABLE").alias("signal"))


def decay(windows: DataFrame, keys: list[str], period: str, value: str) -> DataFrame:
    """Decay verdict per key from its last four of at least six windows."""

    def mean(low, high):
        inside = F.col("rn").between(low, high)
        full = F.count(F.when(inside, F.col(value))) == high - low + 1
        return F.when(full, F.avg(F.when(inside, F.col(value))))

    counts = windows.groupBy(*keys).agg(F.count(F.lit(1)).alias("windows"))
    latest = newest(windows, keys, period, 4).groupBy(*keys).agg(mean(1, 2).alias("recent"), mean(3, 4).alias("baseline"))
    folded = _same_keys(counts, latest, keys)
    fallen = (F.col("baseline") > 0) & (F.col("recent") <= F.col("baseline") * DECAY_KEEP)
    return folded.withColumn("verdict", F.when(F.col("windows") < DECAY_WINDOWS, "MONITOR_SHORT_HISTORY")
                             .when(F.col("recent").isNull() | F.col("baseline").isNull(), "MONITOR_INCOMPLETE")
                             .when(fallen, "CONTENT_DECAY").otherwise("NONE"))


def trend_conflicts(search_trend: DataFrame, session_trend: DataFrame, key: str) -> DataFrame:
    """Keys whose search clicks and sessions tell different directions; an unknown session trend conflicts with nothing."""
    joined = search_trend.select(key, F.col("signal").alias("search_signal")).join(
        session_trend.select(key, F.col("signal").alias("session_signal")), key)
    settled = ["INCREASING", "DECLINING", "STABLE"]
    return joined.withColumn("conflict", F.col("search_signal").isin(settled) & F.col("session_signal").isin(settled)
                             & (F.col("search_signal") != F.col("session_signal")))


# --- Measurement windows ----------------------------------------------------------------------------------

CHECKPOINTS = {"BASELINE": -1, "30D": 30, "60D": 60, "90D": 90}
WINDOW_DAYS = 28


def checkpoint_windows(anchors: DataFrame, day: str = "completed_day") -> DataFrame:
    """28 whole days ending the day before completion and 30, 60 and 90 days after it."""
    table = F.array(*[F.struct(F.lit(name).alias("checkpoint"), F.lit(shift).alias("shift"))
                      for name, shift in CHECKPOINTS.items()])
    ends = anchors.select("*", F.inline(table)).withColumn("period_end", F.date_add(day, F.col("shift")))
    return ends.withColumn("period_start", F.date_sub("period_end", WINDOW_DAYS - 1)).drop("shift")


def window_totals(anchors: DataFrame, daily: DataFrame, key: str, value: str) -> DataFrame:
    """Total of ``value`` per anchor and checkpoint window.

    The interval join is an equi-join: an anchor's windows cover a known set of days, so each window is
    expanded to its 28 days and joined on (key, day) with facts already summed per day.
    """
    windows = checkpoint_windows(anchors)
    days = windows.withColumn("day", F.explode(F.sequence("period_start", "period_end")))
    per_day = daily.groupBy(key, "day").agg(F.sum(value).alias("_value"))
    labels = [*anchors.columns, "checkpoint", "period_start", "period_end"]
    return days.join(per_day, [key, "day"], "left").groupBy(*labels).agg(
        F.sum("_value").alias("total"), F.count("_value").alias("observed_days"))


def previous_window(current: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """As-of join: the value of the latest history window that ends strictly before the current one begins.

    ``current`` has one row per key; earlier windows meet it by key and fold to their maximum on the map side, so a
    key with a long history is never sorted in one task.
    """
    begins = current.select(*keys, F.col("first_day").alias("_begins"))
    past = history.where(F.col("p75").isNotNull()).select(*keys, "p75", "last_day")
    last = (past.join(begins, keys).where(F.col("last_day") < F.col("_begins")).groupBy(*keys)
            .agg(F.max(F.struct("last_day", "p75")).alias("_last")))
    return current.join(last, keys, "left").select(
        *current.columns, F.col("_last.p75").alias("previous_p75"), F.col("_last.last_day").alias("previous_end"))


def vitals_trend(current: DataFrame, history: DataFrame, keys: list[str]) -> DataFrame:
    """History points plus the current window where history does not hold its end day yet."""
    points = history.where(F.col("p75").isNotNull()).select(*keys, "last_day", "p75")
    newest = current.where(F.col("p75").isNotNull()).select(*keys, "last_day", "p75")
    return points.unionByName(newest.join(points, [*keys, "last_day"], "left_anti"))
