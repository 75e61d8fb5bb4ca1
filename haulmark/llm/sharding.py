"""Contiguous shards of equal bytes from global prefix sums.

Rows are put in the order of their id. Totals of id ranges give each row the
number of bytes before it; the shard is where the row's middle byte falls among
equal targets. A shard differs from its target by less than the largest row.

Missing texts count as empty, missing ids come first, repeated ids and rows are
rows of their own, an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.tables import numbered, stored, texts_of

ROW_BYTES = 16


def sized(docs: DataFrame) -> DataFrame:
    text = F.col("text").cast("binary")
    return texts_of(docs).select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("bigint").alias("size"),
        F.crc32(text).alias("text_crc32"),
    )


def shards(docs: DataFrame, n_shards: int) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (place in its shard) and start (bytes before the row)."""
    rows = stored(sized(docs), "shard-sizes")
    placed = numbered(rows, ["doc_id", "text_crc32", "size"], "size")
    total = rows.agg(F.sum("size")).first()[0] or 1
    middle = F.col("start") + F.floor(F.col("size") / 2)
    shard = F.least(F.lit(n_shards - 1), F.floor(middle * n_shards / F.lit(total))).cast("int")
    placed = stored(placed.withColumn("shard", shard), "shard-places")
    first = placed.groupBy("shard").agg(F.min("rank").alias("first_rank"))  # n_shards rows
    return placed.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("rank") - F.col("first_rank")).alias("slot"), "start"
    )
