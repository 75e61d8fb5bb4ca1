"""Reading documents, writing intermediate tables, numbering rows in a global order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from haulmark.session import run_dir

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
NO_ID = -(2**63)  # missing ids sort first
MOST_BUCKETS = 16384


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(docs: DataFrame) -> DataFrame:
    """doc_id and text, a missing text as the empty one; other columns go, whatever their names."""
    return docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))


def guarded(docs: DataFrame) -> DataFrame:
    """The documents with extra columns renamed, so that none clashes with a name that an operator uses."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in COLUMNS else f"extra{i}") for i, c in enumerate(docs.columns)])


def restored(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of the documents, under their own names."""
    return rows.select(*[F.col(c if c in COLUMNS else f"extra{i}").alias(c) for i, c in enumerate(docs.columns)])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a table to the shared folder and read it: what follows survives lost executors and plans anew."""
    spark = df.sparkSession
    path = run_dir(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def hash_sample(df: DataFrame, column: str, wanted: int) -> DataFrame:
    """About `wanted` rows, chosen by a hash of the column, so the same ones each time; all rows if there are fewer."""
    rows = df.count()
    if rows <= wanted:
        return df
    return df.filter(F.pmod(F.xxhash64(column), F.lit(1 << 30)) < F.lit((1 << 30) * wanted // rows))


def literal(values: list[int], kind: str = "bigint") -> Column:
    """A constant array; small, as its length is bounded by the number of buckets."""
    body = ",".join(f"{v}L" if v > NO_ID else "-9223372036854775807L - 1L" for v in values)
    return F.expr(f"array({body})" if values else f"cast(array() as array<{kind}>)")


def order_key(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("bigint"), F.expr("-9223372036854775807L - 1L"))


def bounds(keys: DataFrame, key: Column, per_bucket: int) -> list[int]:
    """Quantiles that cut the keys into ranges of about per_bucket rows, at most MOST_BUCKETS of them."""
    rows = keys.count()
    wanted = max(1, min(MOST_BUCKETS, -(-rows // per_bucket)))
    if wanted == 1:
        return []
    shares = ",".join(str(i / wanted) for i in range(1, wanted))
    cuts = keys.select(key.alias("k")).agg(F.expr(f"approx_percentile(k, array({shares}), {20 * wanted + 1000})")).first()[0]
    return sorted(set(cuts or []))


def bucket_of(key: Column, cuts: list[int]) -> Column:
    """Number of cuts at or below the key, by binary search in a constant array."""
    if not cuts:
        return F.lit(0)
    steps = [1 << i for i in reversed(range(len(cuts).bit_length()))]
    array = literal(cuts)
    return F.aggregate(
        F.array(*[F.lit(s) for s in steps]),
        F.lit(0),
        lambda at, step: F.when(
            (at + step <= F.lit(len(cuts))) & (F.get(array, F.least(at + step, F.lit(len(cuts))) - 1) <= key), at + step
        ).otherwise(at),
    )


def numbered(df: DataFrame, order: list[str], weight: str, per_bucket: int = 100_000) -> DataFrame:
    """Add rank (gapless from 0) and start (sum of weight before the row) in the order of the columns.

    The first column is cut into ranges; each range is ordered by itself and
    lifted by the totals of the ranges before it, one row per range.
    """
    key = order_key(order[0])
    cuts = bounds(df.select(order[0]), key, per_bucket)
    rows = df.withColumn("bucket", bucket_of(key, cuts))
    by_bucket = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.sum(weight).alias("w"))
    lift = totals.select(
        F.col("bucket"),
        F.coalesce(F.sum("n").over(by_bucket), F.lit(0)).alias("rank0"),
        F.coalesce(F.sum("w").over(by_bucket), F.lit(0)).alias("start0"),
    )
    inside = Window.partitionBy("bucket").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    before = inside.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return (
        rows.withColumn("rank1", F.row_number().over(inside).cast("bigint") - 1)
        .withColumn("start1", F.sum(weight).over(before) - F.col(weight))
        .join(F.broadcast(lift), "bucket")  # one row for each of at most MOST_BUCKETS ranges
        .withColumn("rank", F.col("rank0") + F.col("rank1"))
        .withColumn("start", F.col("start0") + F.col("start1"))
        .drop("bucket", "rank0", "rank1", "start0", "start1")
    )
