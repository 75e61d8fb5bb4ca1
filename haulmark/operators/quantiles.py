"""Exact quantiles per key without ordering a whole key in one task.

The wanted ranks of a key lie in intervals of its values. An interval with more
values than fit one task is cut at the quantiles of a sketch of it, which
combines before the shuffle, and its parts are counted; parts without a wanted
rank are dropped. A cut value is a part of its own, so many equal values end
the refinement too. The number of parts is bounded whatever the range of the
values; the sketch only says where to cut, the ranks are counted exactly.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmark.operators.joins import join_per_key, join_same
from haulmark.session import run_dir

FIT = 100_000  # values that are ordered together
PARTS = 64  # parts of an interval that is too large


def _kept(df: DataFrame) -> DataFrame:
    """A small table, written so that rounds do not repeat each other's work."""
    path = run_dir(df.sparkSession, "quantiles")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _within(values: DataFrame, intervals: DataFrame, key: str) -> DataFrame:
    """Values with the interval of their key that they lie in. A key has at most two intervals per quantile."""
    columns = [c for c in intervals.columns if c != key]
    per_key = intervals.groupBy(key).agg(F.collect_list(F.struct(*columns)).alias("_parts"))
    joined = join_per_key(values, per_key, key, F.col("v"))

    def holds(part: Column) -> Column:
        above = part["lo"].isNull() | (F.col("v") > part["lo"])
        below = part["hi"].isNull() | (F.col("v") < part["hi"])
        return F.when(part["single"], F.col("v") == part["lo"]).otherwise(above & below)

    return joined.select(key, "v", F.explode(F.filter("_parts", holds)).alias("_part")).select(key, "v", "_part.*")


def _ranks_between(start: Column, end: Column) -> Column:
    return F.filter("ranks", lambda r: (r["rank"] >= start) & (r["rank"] < end))


def _refined(values: DataFrame, large: DataFrame, key: str, parts: int) -> DataFrame:
    """The parts of large intervals that hold wanted ranks."""
    same = [key, "lo"]
    sketches = _within(values, large.select(key, "lo", "hi", "single"), key).groupBy(*same).agg(
        F.kll_sketch_agg_double("v").alias("sketch")
    )
    shares = F.array(*[F.lit(i / parts) for i in range(1, parts)])
    cuts = F.array_sort(F.array_distinct(F.kll_sketch_get_quantile_double("sketch", shares)))
    cut = _kept(join_same(large, sketches.select(*same, cuts.alias("cuts")), same))
    # even numbers lie between two cuts, odd ones are a cut itself
    below = F.size(F.filter("cuts", lambda c: c < F.col("v")))
    number = 2 * below + F.array_contains("cuts", F.col("v")).cast("int")
    counts = _within(values, cut.select(key, "lo", "hi", "single", "cuts"), key).groupBy(*same, number.alias("no")).agg(
        F.count("*").alias("n")
    )
    upto = F.sum("n").over(Window.partitionBy(*same).orderBy("no"))  # of at most 2 * parts rows
    at = F.floor(F.col("no") / 2).cast("int")
    odd = F.col("no") % 2 == 1
    return (
        join_same(counts, cut.drop("count"), same)
        .withColumn("end", F.col("start") + upto)
        .withColumn("begin", F.col("end") - F.col("n"))
        .withColumn("ranks", _ranks_between(F.col("begin"), F.col("end")))
        .filter(F.size("ranks") > 0)
        .select(
            key,
            F.when(odd, F.get("cuts", at)).when(at > 0, F.get("cuts", at - 1)).otherwise(F.col("lo")).alias("lo"),
            F.when(odd, F.get("cuts", at)).when(at < F.size("cuts"), F.get("cuts", at)).otherwise(F.col("hi")).alias("hi"),
            odd.alias("single"),
            F.col("begin").alias("start"),
            F.col("n").alias("count"),
            "ranks",
        )
    )


def _wanted(probabilities: dict[str, float]) -> Column:
    """Two ranks per quantile: the values below and above the wanted position."""
    out = []
    for name, p in probabilities.items():
        position = (F.col("n") - 1) * F.lit(p)
        for side, rank in (("low", F.floor(position)), ("high", F.ceil(position))):
            out.append(
                F.struct(
                    F.lit(name).alias("q"), F.lit(side).alias("side"), rank.cast("bigint").alias("rank"),
                    (position - F.floor(position)).alias("part"),
                )
            )
    return F.array(*out)


def exact_quantiles(
    df: DataFrame, key: str, column: str, probabilities: dict[str, float], measures: dict[str, Column] | None = None,
    fit: int = FIT, parts: int = PARTS,
) -> DataFrame:
    """Linearly interpolated quantiles per key; NaN is above every other value, as in percentile.

    measures are aggregates over the same values, which are taken in the pass that counts them.
    """
    values = df.filter(F.col(column).isNotNull()).select(key, F.col(column).cast("double").alias("v"))
    nan = F.isnan("v")
    extra = [m.alias(f"_m_{name}") for name, m in (measures or {}).items()]
    counted = values.groupBy(key).agg(F.count("*").alias("n"), F.count_if(~nan).alias("count"), *extra)
    counted = _kept(counted.withColumn("ranks", _wanted(probabilities)))
    numbers = values.filter(~nan)
    nothing = F.lit(None).cast("double")
    open_ = counted.select(
        key, nothing.alias("lo"), nothing.alias("hi"), F.lit(False).alias("single"), F.lit(0).cast("bigint").alias("start"), "count",
        _ranks_between(F.lit(0), F.col("count")).alias("ranks"),
    )
    too_large = (F.col("count") > fit) & ~F.col("single")
    refined = False
    while not open_.filter(too_large).isEmpty():
        refined = True
        smaller = _refined(numbers, open_.filter(too_large), key, parts)
        open_ = _kept(smaller.unionByName(open_.filter(~too_large)))

    # Values of an interval with their numbers, ordered interval by interval.
    found = open_.filter("single").select(key, F.explode("ranks").alias("r"), F.col("lo").alias("v"))
    rest = open_.filter(~F.col("single"))
    if refined:
        held = _within(numbers, rest.select(key, "lo", "hi", "single"), key).groupBy(key, "lo", "v")
    else:
        held = numbers.withColumn("lo", nothing).groupBy(key, "lo", "v")
    counts = join_same(held.agg(F.count("*").alias("n")), rest.drop("hi", "count"), [key, "lo"])
    end = F.col("start") + F.sum("n").over(Window.partitionBy(key, "lo").orderBy("v"))
    ordered = counts.withColumn("end", end).withColumn("r", F.explode(_ranks_between(F.col("end") - F.col("n"), F.col("end"))))
    found = found.unionByName(ordered.select(key, "r", "v"))
    above = counted.select(key, F.explode(_ranks_between(F.col("count"), F.col("n"))).alias("r"))
    found = found.unionByName(above.withColumn("v", F.lit(float("nan"))))

    def value_of(name: str) -> Column:
        side = lambda s, c: F.max(F.when((F.col("r.q") == name) & (F.col("r.side") == s), c))
        low, high, part = side("low", F.col("v")), side("high", F.col("v")), side("low", F.col("r.part"))
        return F.when(low == high, low).otherwise(low + (high - low) * part)

    out = found.groupBy(key).agg(*[value_of(name).alias(name) for name in probabilities])
    if not measures:
        return out
    kept = counted.select(key, *[F.col(f"_m_{name}").alias(name) for name in measures])
    return join_same(kept, out, [key])
