"""Staged records: key, JSON payload and expiry time."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.functions.timing import at
from haulmark.sources.envelopes import extract_dimension
from haulmark.sources.versioned import VersionedTable

DIMENSION_TTL = 3600
FACT_TTL = 1800


def stage(df: DataFrame, entity: str, key_columns: list[str], as_of: str, ttl: int) -> DataFrame:
    """Records under ``staging:<entity>:<key>`` with times as ISO text in the payload."""
    text = extract_dimension(df)
    # A missing key part stays visible, so that two keys never fall together.
    keys = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in key_columns]
    return text.select(
        F.lit(entity).alias("entity"),
        F.concat_ws(":", F.lit("staging"), F.lit(entity), *keys).alias("key"),
        F.to_json(F.struct(*text.columns)).alias("payload"),
        at(as_of).alias("written_at"),
        F.timestamp_add("SECOND", F.lit(ttl), at(as_of)).alias("expires_at"),
    )


def write_staged(staged: DataFrame, path: str) -> None:
    staged.write.mode("append").partitionBy("entity").parquet(path)


def newest(staged: DataFrame) -> DataFrame:
    """The last written record of each key: staging a key again replaces it."""
    fields = [c for c in staged.columns if c not in ("entity", "key")]
    last = F.max_by(F.struct(*fields), F.struct("written_at", "expires_at", "payload"))
    return staged.groupBy("entity", "key").agg(last.alias("_row")).select("entity", "key", "_row.*").select(*staged.columns)


def get_staged(staged: DataFrame, entity: str, as_of: str, schema: str) -> DataFrame:
    """Live records of one entity, decoded."""
    live = newest(staged.filter(F.col("entity") == entity)).filter(F.col("expires_at") > at(as_of))
    return live.select("key", F.from_json("payload", schema).alias("data")).select("key", "data.*")


def staging_counts(staged: DataFrame, entities: list[str], as_of: str) -> DataFrame:
    """Live records per expected entity, 0 for those without any."""
    found = (
        newest(staged).filter(F.col("expires_at") > at(as_of)).groupBy("entity").agg(F.count("*").alias("n"))
    )
    wanted = staged.sparkSession.createDataFrame([(e,) for e in entities], "entity string")
    n = F.coalesce("n", F.lit(0))
    return wanted.join(found, "entity", "left").select("entity", n.alias("records"), (n > 0).alias("passed"))


def clear_staging(staged: DataFrame, prefixes: tuple[str, ...] = ("staging:", "cache:")) -> tuple[DataFrame, DataFrame]:
    """Records left after removing all keys with a prefix, and the number of keys removed per prefix."""
    hit = F.lit(False)
    name = F.lit(None).cast("string")
    for p in prefixes:
        hit = hit | F.col("key").startswith(p)
        name = F.when(F.col("key").startswith(p), F.lit(p)).otherwise(name)
    removed = staged.filter(hit).groupBy(name.alias("prefix")).agg(F.count_distinct("key").alias("removed"))
    return staged.filter(~hit), removed


def clear_stored(table: VersionedTable, run: str, prefixes: tuple[str, ...] = ("staging:", "cache:")) -> DataFrame:
    """Remove all keys with a prefix from a stored table at once; returns the number removed per prefix, 0 in a repeated run.

    Sessions that read the table see it before the clear or after it.
    """
    before = table.rewrite(lambda staged: clear_staging(staged, prefixes)[0], run)
    rows = table.read().limit(0) if before is None else before
    removed = clear_staging(rows, prefixes)[1]
    wanted = rows.sparkSession.createDataFrame([(p,) for p in prefixes], "prefix string")
    return wanted.join(removed, "prefix", "left").select("prefix", F.coalesce("removed", F.lit(0)).alias("removed"))


def export_json(df: DataFrame, path: str) -> None:
    """A table as JSON lines, times as ISO text."""
    extract_dimension(df).write.mode("overwrite").json(path)


def json_document(top: DataFrame, rows: int = 10_000) -> DataFrame:
    """The first rows of a result as one JSON array."""
    return top.limit(rows).agg(F.to_json(F.sort_array(F.collect_list(F.struct(*top.columns)))).alias("document"))
