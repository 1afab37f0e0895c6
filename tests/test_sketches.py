import datetime as dt
import math
import random

import pytest
from pyspark.sql import functions as F

from barloom.operators import distributions, sketches
from barloom.operators.select import price_range
from barloom.streaming.append import append_batch, read_sketches, stored_bars


def frame(spark, values, ticker="A", start=dt.date(2000, 1, 1)):
    return spark.createDataFrame([(ticker, start + dt.timedelta(days=i), v) for i, v in enumerate(values)], "ticker string, trading_date date, x double")


def brute_box(values):
    v = sorted(values)
    at = lambda p: v[max(math.ceil(p * len(v)) - 1, 0)]
    q1, q2, q3 = at(0.25), at(0.5), at(0.75)
    low, high = q1 - 1.5 * (q3 - q1), q3 + 1.5 * (q3 - q1)
    inside = [x for x in v if low <= x <= high]
    return (len(v), v[0], q1, q2, q3, v[-1], min(inside), max(inside), len(v) - len(inside))


@pytest.mark.parametrize("seed", range(6))
def test_exact_as_long_as_all_values_are_held(spark, seed):
    rng = random.Random(seed)
    values = [rng.choice([rng.gauss(0, 1), rng.gauss(0, 20), 3.0, 0.0]) for _ in range(rng.choice([1, 2, 3, 50, 1500]))]
    parts = sketches.sketches(frame(spark, values), "x")
    assert tuple(sketches.approx_box_stats(parts).first())[1:] == pytest.approx(brute_box(values), abs=0)


def test_rank_error_of_long_series(spark):
    """Sketches of many years merged: the ranks of the quantiles found are off by 1 in 250 at most."""
    rows = spark.range(400_000).select(
        F.lit("A").alias("ticker"),
        F.date_add(F.lit("1950-01-01").cast("date"), (F.col("id") % 20_000).cast("int")).alias("trading_date"),
        F.exp(F.randn(7) * 3).alias("x"),
    )
    parts = sketches.sketches(rows, "x")
    assert parts.count() == 55
    found = sketches.approx_quantiles(sketches.merge(parts), [0.01, 0.25, 0.5, 0.75, 0.99]).first()
    for p, value in zip([0.01, 0.25, 0.5, 0.75, 0.99], found[2:], strict=True):
        assert abs(rows.where(F.col("x") <= value).count() / 400_000 - p) < 0.004
    exact = distributions.quantiles(rows, "x", [0.5]).first().q0
    assert abs(rows.where(F.col("x") <= exact).count() - rows.where(F.col("x") <= found.q2).count()) < 1600


def test_missing_values_and_no_rows(spark):
    odd = frame(spark, [None, float("nan"), float("inf"), 2.0]).union(spark.createDataFrame([(None, None, 1.0), ("A", None, 1.0)], "a string, b date, c double"))
    assert tuple(sketches.approx_box_stats(sketches.sketches(odd, "x")).first())[1:] == (1, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0, 2.0, 0)
    assert sketches.approx_box_stats(sketches.sketches(odd.limit(0), "x")).count() == 0


def test_store_statistics_come_from_sketches_alone(spark, tmp_path, make_bars):
    """Two batches give two rows of sketches; the statistics read no bars and equal those of all bars."""
    store = f"{tmp_path}/store"
    rng = random.Random(1)
    for batch in range(2):
        highs = [5 + rng.random() * 10 for _ in range(40)]
        append_batch(make_bars([4.0] * 40, high=highs, start=dt.date(2020 + batch, 2, 1)), store, f"run=r/batch={batch}")
    parts = read_sketches(spark, store)
    assert parts.count() == 2
    stats = sketches.approx_box_stats(parts)
    assert not [f for f in stats.inputFiles() if "/store/" in f]
    values = [r.price_diff for r in price_range(stored_bars(spark, store)).collect()]
    assert tuple(stats.first())[1:] == pytest.approx(brute_box(values), abs=0)
