"""Keyed upserts of a stream into a versioned table of hash buckets.

Each batch adds one commit with the newest version of every field of its keys.
Every bucket is folded into one commit once in `fold_every` versions, a
different part of the buckets each time, so a batch rewrites a share of the
store instead of all of it, and a read merges at most about `fold_every`
commits of each bucket. The newest value of a field is the one of greatest
(order, value); order is event time, then offset. So the rows do not depend on
how messages are split into batches, on replays, or on where a fold was cut off.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from haulmark.sources.versioned import BUCKET, COMMIT, GRACE, Part, Version, VersionedTable

FOLD_EVERY = 16
BUCKETS = 32


def newest_versions(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Per key and field the newest non-NULL value with its order columns."""
    fields = [c for c in batch.columns if c not in keys and c not in order]
    newest = [F.max(F.when(F.col(c).isNotNull(), F.struct(*order, F.col(c).alias("value")))).alias(c) for c in fields]
    return batch.groupBy(*keys).agg(*newest)


@dataclass(frozen=True)
class KeyedStore:
    table: VersionedTable
    keys: list[str]
    buckets: int = BUCKETS
    fold_every: int = FOLD_EVERY
    grace: float = GRACE

    @staticmethod
    def at(spark: SparkSession, path: str, keys: list[str], **options) -> KeyedStore:
        return KeyedStore(VersionedTable(spark, path), keys, **options)

    def _bucketed(self, versions: DataFrame) -> DataFrame:
        number = F.pmod(F.hash(*self.keys), F.lit(self.buckets))
        return versions.withColumn(BUCKET, number).repartition(BUCKET)

    def _merged(self, rows: DataFrame) -> DataFrame:
        fields = [c for c in rows.columns if c not in (*self.keys, BUCKET, COMMIT)]
        return rows.groupBy(*self.keys).agg(*[F.max(c).alias(c) for c in fields])

    def upsert(self, batch: DataFrame, order: list[str], batch_id: int) -> None:
        """Add a batch; one that was added before, by its number, changes nothing."""
        if batch_id > self.table.current().last:
            rows = self._bucketed(newest_versions(batch, self.keys, order))
            commit = self.table.write(rows, by_bucket=True)
            part = Part(commit, f"batch-{batch_id}", tuple(range(self.buckets)))

            def step(now: Version) -> Version | None:
                if batch_id <= now.last:
                    return None
                return replace(now, schema=rows.schema.json(), parts=(*now.parts, part), last=batch_id)

            self.table.change(step)
        due = tuple(b for b in range(self.buckets) if (b + batch_id) % self.fold_every == 0)
        self.fold(due)
        if batch_id % self.fold_every == 0:
            self.table.clean(self.grace)

    def fold(self, buckets: tuple[int, ...] | None = None) -> None:
        """One commit in the place of all that hold rows of these buckets. Batches that come meanwhile stay beside it."""
        base = self.table.current()
        due = set(range(self.buckets) if buckets is None else buckets)
        old = {p for p in base.parts if due & set(p.buckets)}
        if not due or len(old) < 2:
            return
        rows = self.table.live(base).filter(F.col(BUCKET).isin(sorted(due)))
        folded = Part(self.table.write(self._bucketed(self._merged(rows)), by_bucket=True), f"fold-{base.number}", tuple(sorted(due)))

        def step(now: Version) -> Version | None:
            if not old <= set(now.parts):
                return None  # folded by another writer
            rest = (replace(p, buckets=tuple(b for b in p.buckets if b not in due)) if p in old else p for p in now.parts)
            return replace(now, parts=(folded, *(p for p in rest if p.buckets)))

        self.table.change(step)

    def read(self, like: DataFrame | None = None) -> DataFrame:
        """Current rows; before the first batch an empty table like the given one."""
        rows = self.table.live()
        if rows is None:
            if like is None:
                raise ValueError(f"nothing has been written to {self.table.root}")
            return like.sparkSession.createDataFrame([], like.schema)
        merged = self._merged(rows)
        return merged.select(*self.keys, *[F.col(f"{c}.value").alias(c) for c in merged.columns if c not in self.keys])


def upsert_batch(path: str, keys: list[str], order: list[str], **options) -> Callable[[DataFrame, int], None]:
    """Callback for foreachBatch."""

    def write(batch: DataFrame, batch_id: int) -> None:
        KeyedStore.at(batch.sparkSession, path, keys, **options).upsert(batch, order, batch_id)

    return write


def read_upserted(spark: SparkSession, path: str, keys: list[str], like: DataFrame | None = None) -> DataFrame:
    return KeyedStore.at(spark, path, keys).read(like)
