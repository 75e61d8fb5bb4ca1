import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from haulmark.functions.numeric import avg_parts, merged_avg, merged_sum, steady_avg, steady_sum
from haulmark.operators import statistics


@pytest.fixture(scope="module")
def samples():
    rng = np.random.default_rng(3)
    normal = rng.normal(60, 12, 4000).round(3)
    return {1: normal, 2: rng.uniform(0, 100, 50).round(2), 3: np.array([5.0]), 4: np.array([1.0, 2.0]),
            5: np.array([7.0] * 20), 6: -rng.uniform(0, 5, 31).round(2)}


@pytest.fixture(scope="module")
def frame(spark, samples):
    data = [(k, float(v)) for k, vs in samples.items() for v in vs] + [(1, None), (9, None)]
    return spark.createDataFrame(data, "k long, x double").repartition(5)


@pytest.mark.parametrize("fit", [100_000, 300, 5])
def test_quantiles(frame, samples, fit):
    found = statistics.exact_quantiles(frame, "k", "x", {"a": 0.0, "b": 0.25, "c": 0.5, "d": 0.9, "e": 1.0}, fit=fit, parts=16)
    out = {r.k: r[1:] for r in found.collect()}
    assert set(out) == set(samples)
    for k, values in samples.items():
        assert np.allclose(out[k], np.quantile(values, [0, 0.25, 0.5, 0.9, 1]))


def test_profile(frame, samples):
    for r in statistics.profile_stats(frame, "k", "x").collect():
        v = samples[r.k]
        assert r.readings == len(v)
        assert np.allclose([r.mean, r.std, r.min, r.max, r.median],
                           [v.mean(), v.std(), v.min(), v.max(), np.median(v)], atol=0.00501)


def test_normality(frame, samples):
    out = {r.k: r for r in statistics.normality_check(frame, "k", "x").collect()}
    for k, v in samples.items():
        away = np.abs(v - v.mean()).round(8)
        for n in (1, 2, 3):
            share = (away <= round(n * v.std(), 8)).mean() * 100
            assert abs(out[k][f"actual_{n}std"] - share) < 0.006
    assert out[1].rule_68 and out[1].rule_95 and out[1].rule_99
    assert not out[2].rule_68


def test_dispersion_counts_empty_days(spark):
    day = lambda d: dt.datetime(2024, 1, d, 12)
    data = [(1, day(1)), (1, day(1)), (1, day(4)), (2, day(2))] + [(3, day(d)) for d in (1, 2, 3, 4)]
    df = spark.createDataFrame(data, "vehicle_id long, timestamp timestamp")
    out = {r.vehicle_id: r for r in statistics.incident_dispersion(df).collect()}
    counts = {1: [2, 0, 0, 1], 2: [0, 1, 0, 0], 3: [1, 1, 1, 1]}
    for k, c in counts.items():
        assert out[k].days == 4
        assert (out[k].min, out[k].max) == (min(c), max(c))
        assert abs(out[k].mean - np.mean(c)) < 1e-3 and abs(out[k].variance - np.var(c)) < 1e-3
        assert out[k].follows_poisson == (0.8 <= np.var(c) / np.mean(c) <= 1.2)


def test_sums_do_not_depend_on_partitions(spark):
    data = [(0.1 * i, ) for i in range(3001)] + [(-2.75,), (None,)]
    df = spark.createDataFrame(data, "x double")
    sums = {df.repartition(n).agg(steady_sum(df.x)).first()[0] for n in (1, 2, 7, 13)}
    assert sums == {round(0.1 * 3000 * 3001 / 2 - 2.75, 6)}


def test_average_of_nothing_is_null(spark):
    df = spark.createDataFrame([(None,)], "x double")
    assert df.agg(steady_avg(df.x)).first()[0] is None


def test_duplicates_and_share(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("b", 3)], "s string, k int")
    assert rows(statistics.duplicate_keys(df, ["s", "k"])) == [("a", 1, 2)]
    assert rows(statistics.state_share(df, "s")) == [("a", 2, 50.0), ("b", 2, 50.0)]


@pytest.mark.parametrize("values", [[4e-7] * 1000, [1e19, 1e19], [float("inf"), 1.0], [float("nan"), 10.0], [None, 2.5], [-0.3, 1e-12, 7e5, 2e6]])
def test_sums_lose_nothing(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double")
    got = df.agg(steady_sum(df.x), steady_avg(df.x), F.sum("x"), F.avg("x")).first()
    assert got[:2] == pytest.approx(got[2:], rel=1e-12, nan_ok=True)


def test_merged_sums_lose_nothing(spark):
    values = [(1, 4e-7), (1, 1e19), (2, 0.25), (2, None), (3, -1.5)]
    df = spark.createDataFrame(values, "k int, x double")
    got = df.groupBy("k").agg(*avg_parts("x", df.x)).agg(merged_sum("x"), merged_avg("x")).first()
    assert got[:] == pytest.approx((1e19, 2.5e18), rel=1e-12)


def test_quantiles_put_nan_last(spark):
    df = spark.createDataFrame([("a", v) for v in (-5.0, 5.0, float("nan"))], "k string, v double")
    assert statistics.exact_quantiles(df, "k", "v", {"median": 0.5}).first()["median"] == 5.0


@pytest.mark.parametrize("scale", [1e-9, 1.0, 1e9])
def test_quantiles_of_any_range(spark, scale):
    """A hot key, mostly equal values, infinities and NaN, at scales that no fixed bins would suit."""
    rng = np.random.default_rng(8)
    values = {
        1: rng.uniform(0, 1, 6000) * scale,
        2: np.where(rng.uniform(0, 1, 2000) < 0.7, 0.5, rng.normal(0, 1, 2000)) * scale,
        3: np.concatenate([rng.uniform(-1, 1, 900) * scale, [np.inf] * 90, [-np.inf] * 10]),
        4: np.concatenate([rng.uniform(-1, 1, 60) * scale, [np.nan] * 60]),
    }
    data = [(k, float(v)) for k, vs in values.items() for v in vs]
    df = spark.createDataFrame(data, "k long, x double").repartition(4)
    wanted = {"a": 0.01, "b": 0.5, "c": 0.77, "d": 0.999}
    for r in statistics.exact_quantiles(df, "k", "x", wanted, fit=200).collect():
        ordered = np.sort(values[r.k])
        for name, p in wanted.items():
            at = (len(ordered) - 1) * p
            low, high = ordered[int(np.floor(at))], ordered[int(np.ceil(at))]
            expected = low if low == high else low + (high - low) * (at - np.floor(at))
            assert r[name] == expected or np.isclose(r[name], expected, rtol=1e-12, equal_nan=True), (r, name)


def test_daily_sketches_merge_into_spans(spark):
    data = [(dt.datetime(2024, 1, 1 + i % 10), i % 2, i % 3000, None if i % 7 == 0 else i / 4) for i in range(20_000)]
    df = spark.createDataFrame(data, "timestamp timestamp, k int, a long, b double")
    sketches = statistics.daily_sketches(df, ["a", "b"], ["k"])
    assert sketches.count() == 10
    for first, last in ((1, 10), (2, 4), (9, 9)):
        span = df.filter(F.dayofmonth("timestamp").between(first, last))
        exact = {r.k: r[1:] for r in span.groupBy("k").agg(F.count_distinct("a"), F.count_distinct("b")).collect()}
        found = statistics.distinct_over(sketches, ["a", "b"], ["k"], f"2024-01-{first:02}", f"2024-01-{last:02}")
        near = {r.k: r[1:] for r in found.collect()}
        assert set(near) == set(exact)
        # three standard errors
        assert all(abs(a - b) <= 3 * 1.04 / 2**7 * b for k in exact for a, b in zip(near[k], exact[k]))
