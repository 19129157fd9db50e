"""Exact order statistics that never pull a whole group, or a whole table, into one task.

A plain ``window`` without partitions (or over one hot key) sorts everything in a single task.  Here the
order column is cut into slices of its range, slice totals are accumulated in a small window, and only the
rows of one slice are sorted together.  Slices depend on the data alone, so a retried task sees the same ones.
"""

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

SLICES = 1024
TAIL = 1e12


def _numeric(column: Column, kind: str) -> Column:
    if kind == "date":
        return F.datediff(column, F.lit("1970-01-01").cast("date")).cast("double")
    if kind.startswith("timestamp"):
        return F.unix_micros(column.cast("timestamp")).cast("double")
    return column.cast("double")


def _sliced(df: DataFrame, keys: list[str], order: str, slices: int) -> DataFrame:
    """Add ``_slice``, the slice of ``order``'s range within its group."""
    position = _numeric(F.col(order), dict(df.dtypes)[order])
    edges = (df.groupBy(*keys) if keys else df.groupBy(F.lit(0).alias("_all"))).agg(
        F.min(position).alias("_low"), F.max(position).alias("_high"))
    if keys:
        placed = df.join(edges, keys)
        low, high = F.col("_low"), F.col("_high")
    else:
        placed = df
        low, high = edges.select("_low").scalar(), edges.select("_high").scalar()
    part = F.coalesce(F.try_divide(position - low, high - low), F.lit(0.0))
    # Half linear, half logarithmic: both rise with the value, so order is kept, and a long tail does not
    # leave nearly all values in the first slice.
    spread = (part + F.log1p(part * TAIL) / math.log1p(TAIL)) / 2
    return placed.withColumn("_slice", F.least(F.floor(spread * slices), F.lit(slices - 1)).cast("int")).drop("_low", "_high")


def before_value(df: DataFrame, order: str, amount: Column, keys: list[str] = (), descending: bool = False,
                 slices: int = SLICES) -> DataFrame:
    """One row per (keys, order value): ``here`` = its amount, ``before`` = the amount of all values ahead of it."""
    keys = list(keys)
    totals = df.groupBy(*keys, order).agg(F.sum(amount).alias("here"))
    sliced = _sliced(totals, keys, order, slices)
    direction = F.desc if descending else F.asc
    per_slice = sliced.groupBy(*keys, "_slice").agg(F.sum("here").alias("_slice_total"))
    ahead = Window.partitionBy(*keys).orderBy(direction("_slice")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = per_slice.select(*keys, "_slice", F.coalesce(F.sum("_slice_total").over(ahead), F.lit(0)).alias("_offset"))
    inside = (Window.partitionBy(*keys, "_slice").orderBy(direction(order))
              .rowsBetween(Window.unboundedPreceding, -1))
    return (sliced.join(offsets, [*keys, "_slice"])
            .withColumn("before", F.col("_offset") + F.coalesce(F.sum("here").over(inside), F.lit(0)))
            .drop("_slice", "_offset"))


def running_total(df: DataFrame, order: str, tie: str, amount: Column, name: str, keys: list[str] = (),
                  descending: bool = False, slices: int = SLICES) -> DataFrame:
    """Add ``name``: the running total of ``amount`` by ``order`` then ``tie`` (a unique number), current row included.

    A value shared by very many rows is cut again along ``tie``, so no tie group is sorted in one task.
    """
    keys = list(keys)
    measured = df.withColumn("_amount", amount)
    values = before_value(measured, order, F.col("_amount"), keys, descending, slices).drop("here")
    span = measured.agg(F.min(tie).cast("double").alias("low"), F.max(tie).cast("double").alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    part = F.coalesce(F.try_divide(F.col(tie).cast("double") - low, high - low), F.lit(0.0))
    cut = measured.withColumn("_cut", F.least(F.floor(part * slices), F.lit(slices - 1)).cast("int"))
    ahead = Window.partitionBy(*keys, order).orderBy("_cut").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (cut.groupBy(*keys, order, "_cut").agg(F.sum("_amount").alias("_cut_total"))
            .withColumn("_cut_before", F.coalesce(F.sum("_cut_total").over(ahead), F.lit(0))).drop("_cut_total"))
    offsets = cuts.join(values, [*keys, order]).select(
        *keys, order, "_cut", (F.col("before") + F.col("_cut_before")).alias("_offset"))
    inside = Window.partitionBy(*keys, order, "_cut").orderBy(tie).rowsBetween(Window.unboundedPreceding, 0)
    return (cut.join(offsets, [*keys, order, "_cut"])
            .withColumn(name, F.col("_offset") + F.sum("_amount").over(inside))
            .drop("_amount", "_cut", "_offset"))


def row_numbers(df: DataFrame, order: str, tie: str, name: str = "row_number", keys: list[str] = (),
                descending: bool = False) -> DataFrame:
    """Exact row number by ``order`` then ``tie``, without a single-task sort."""
    return running_total(df, order, tie, F.lit(1), name, keys, descending)


def quantiles(df: DataFrame, value: str, probabilities: dict[str, float], keys: list[str] = ()) -> DataFrame:
    """Linearly interpolated quantiles per group, one column per entry of ``probabilities``."""
    keys = list(keys)
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    ranked = before_value(known, value, F.lit(1), keys)
    sizes = known.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    joined = ranked.join(sizes, keys) if keys else ranked.withColumn("_n", sizes.scalar())
    last = F.col("before") + F.col("here") - 1

    def at(rank):
        return F.max(F.when(rank.between(F.col("before"), last), F.col(value).cast("double")))

    columns = []
    for name, p in probabilities.items():
        index = (F.col("_n") - 1) * F.lit(p)
        low, high = F.floor(index), F.ceil(index)
        columns += [at(low).alias(f"_lo_{name}"), at(high).alias(f"_hi_{name}"), F.max(index - low).alias(f"_w_{name}")]
    found = joined.groupBy(*keys).agg(*columns)
    return found.select(*keys, *[
        (F.col(f"_lo_{n}") + (F.col(f"_hi_{n}") - F.col(f"_lo_{n}")) * F.col(f"_w_{n}")).alias(n)
        for n in probabilities])


def percentile_ranks(df: DataFrame, value: str, name: str = "percentile") -> DataFrame:
    """Share of rows at or below each row's value, on 0..100 rounded half up; null values have no rank."""
    known = df.where(F.col(value).isNotNull())
    ranked = before_value(known, value, F.lit(1))
    size = known.agg(F.count(F.lit(1)).alias("n")).scalar()
    return df.join(ranked.select(value, F.floor((F.col("before") + F.col("here")) / size * 100 + 0.5).alias(name)),
                   value, "left")
