"""Distributed order statistics against brute force, with a third of all rows on one key and one value."""

import statistics

import numpy as np
import pytest
from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from sightline.operators import charts, ordered


def skewed(n=3000):
    rng = np.random.default_rng(7)
    rows = []
    for i in range(n):
        hot = i % 3 == 0
        rows.append((i, "hot" if hot or i % 2 else f"k{i % 5}", 5.0 if hot else round(float(rng.lognormal(3, 2)), 2), int(rng.integers(1, 9))))
    return rows


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(skewed(), "id long, key string, value double, cost long")


@pytest.mark.parametrize("slices", [4, 1024])
def test_running_total(frame, slices):
    rows = skewed()
    got = {r.id: r.spent for r in ordered.running_total(frame, "value", "id", F.col("cost"), "spent", slices=slices).collect()}
    total, want = 0, {}
    for i, _, _, cost in sorted(rows, key=lambda r: (r[2], r[0])):
        total += cost
        want[i] = total
    assert got == want


def test_row_numbers_descending_per_key(frame):
    got = {r.id: r.row_number for r in ordered.row_numbers(frame, "value", "id", keys=["key"], descending=True).collect()}
    want, seen = {}, {}
    for i, key, _, _ in sorted(skewed(), key=lambda r: (-r[2], r[0])):
        seen[key] = seen.get(key, 0) + 1
        want[i] = seen[key]
    assert got == want


def test_box_plots(frame):
    got = {r.key: r for r in charts.box_plots(frame, "key", "value").collect()}
    for key in {r[1] for r in skewed()}:
        values = [r[2] for r in skewed() if r[1] == key]
        low, mid, high = np.percentile(values, [25, 50, 75])
        assert got[key].lower_quartile == pytest.approx(low) and got[key].median == pytest.approx(mid) and got[key].upper_quartile == pytest.approx(high)
        assert (got[key].minimum, got[key].maximum) == (min(values), max(values))


@settings(max_examples=8, deadline=None)
@given(st.lists(st.one_of(st.none(), st.integers(-50, 50)), min_size=1, max_size=40), st.integers(1, 6))
def test_percentile_ranks_and_partitions(spark, items, parts):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(items)], "id long, v long").repartition(parts)
    got = {r.id: r.percentile for r in ordered.percentile_ranks(df, "v").collect()}
    known = sorted(v for v in items if v is not None)
    assert got == {i: None if v is None else int(sum(k <= v for k in known) / len(known) * 100 + 0.5) for i, v in enumerate(items)}


def test_median_of_one_value(spark):
    df = spark.createDataFrame([("a", 4.0)] * 9, "k string, v double")
    assert ordered.quantiles(df, "v", {"m": 0.5}, ["k"]).first().m == statistics.median([4.0] * 9)


def test_waterfall_inference_and_resets(spark):
    rows = [("a", 1, "Q1", 10.0), ("a", 2, "up", 5.0), ("a", 3, "down", -3.0), ("a", 4, "Q2", 12.0), ("b", 1, "Opening", 7.0), ("b", 2, "more", 1.0), ("c", 1, "alone", 1.0)]
    df = spark.createDataFrame(rows, "k string, s int, label string, v double")
    got = {(r.k, r.s): (r.balance, r.total_type, r.change) for r in charts.waterfall(df, "k", "s", "label", "v", derive_ending=True).collect()}
    assert got[("a", 1)] == (10.0, "beginning", None) and got[("a", 3)] == (12.0, None, -3.0) and got[("a", 4)] == (12.0, "ending", None)
    assert got[("b", 3)] == (8.0, "ending", None) and ("c", 1) not in got


def test_top_categories_refuses_what_it_cannot_sum(spark):
    rows = [(f"c{i}", float(i)) for i in range(10)]
    def total(extra):
        return charts.top_categories(spark.createDataFrame(rows + extra, "c string, v double"), "c", "v", limit=4, preserve=["c0"])
    assert {r.c: r.v for r in total([]).collect()} == {"c0": 0.0, "c9": 9.0, "c8": 8.0, "Other": 28.0}
    for bad in ([("x", -1.0)], [("Other", 1.0)], [("c1", 1.0)], [("", 1.0)], [("x", None)]):
        assert "Other" not in {r.c for r in total(bad).collect()} - {"Other" if bad[0][0] == "Other" else None}


def test_long_tail_is_spread_over_slices(spark):
    rng = np.random.default_rng(3)
    df = spark.createDataFrame([(i, float(v)) for i, v in enumerate(rng.lognormal(0, 4, 4000))], "id long, v double")
    sizes = [r["count"] for r in ordered._sliced(df, [], "v", 1024).groupBy("_slice").count().collect()]
    assert max(sizes) < 400
    got = [r.id for r in ordered.row_numbers(df, "v", "id").orderBy("row_number").collect()]
    assert got == [r.id for r in df.orderBy("v", "id").collect()]


def test_multiset_difference_folds_once(spark):
    """Both sides share one exchange and one pair of aggregations; a second fold would hold every distinct row again."""
    from sightline.operators.quality import multiset_difference
    left, right = spark.range(100).selectExpr("id % 10 AS k"), spark.range(90).selectExpr("CASE WHEN id < 3 THEN NULL ELSE id % 9 END AS k")
    out = multiset_difference(left, right)
    got = {r.k: (r.left_rows, r.right_rows) for r in out.collect()}
    assert got == {None: (0, 3), 0: (10, 9), 1: (10, 9), 2: (10, 9), 9: (10, 0)}
    assert out._jdf.queryExecution().sparkPlan().toString().count("HashAggregate") == 2
