"""Quality classifier by importance resampling.

Two generative models over hashed n-grams are counted: one on the target, the
documents labelled good and not toxic, one on the raw text, all documents. The
log importance of a document is the sum over its n-grams of the log ratio of
the two. Within a document, the models count an n-gram once more for each
doubling, so that a repeated word is little evidence against others. It counts only if its two rates differ by more than
chance (SIGMAS) and by more than EFFECT, and if the labelled documents outside
the target hold it more often than those inside, so that the words of a much
copied document are no evidence either. It never counts more than 0: a document can't make up for bad passages by
more good text. Gumbel noise is added and the top k are kept. k is the number of
documents that score at least what all but LOSS of the labelled good ones do.

Only the ids of labelled documents are a sample, of about LABELLED rows at most; both
models and all scores cover every document. Counts leave a task as SLICES
arrays of fixed size and are added up slice by slice.

Missing and empty texts have no n-grams and score 0. A label that is missing
counts as not good. Ties are broken by a hash of the row, repeated rows get
equal keys, an empty table gives an empty result; without labels all is kept.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from haulmark.llm import blocks
from haulmark.llm.tables import guarded, hash_sample, numbered, restored, stored

LABELLED = 200_000
UNIGRAMS, BIGRAMS = 1 << 20, 1 << 18
BUCKETS = UNIGRAMS + BIGRAMS
SLICES = 320
BLOCK = 2 << 20  # bytes of text that a task works on at once
SIGMAS, LOSS = 2.5, 0.002
EFFECT = np.log(4)  # the target rate of an n-gram that counts is a quarter of the raw rate at most
SMOOTH = 0.5
RUN = 4
SEED = 7
MODELS = ("raw", "target", "other")  # all documents, good labelled ones, other labelled ones
SLICE_BYTES = BUCKETS // SLICES

# bytes: 0 blank, 1 part of a word, 2 mark
CLASS = np.full(256, 2, np.uint8)
CLASS[[9, 10, 11, 12, 13, 32]] = 0
CLASS[[b for b in range(256) if b >= 0x80 or chr(b).isalnum() or b == 0x5F]] = 1
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32


def ngrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of every word or run of marks, and of every pair of neighbouring words.

    The last pair of RUN equal tokens in a row goes to one bucket, whatever the token is.
    """
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    kind = CLASS[data]
    cut = np.empty(len(data), bool)
    cut[1:] = kind[1:] != kind[:-1]
    cut[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    starts = np.flatnonzero(cut)
    hashes, _, _ = blocks.token_hashes(LOWER[data], starts)
    full = kind[starts] != 0
    starts, hashes = starts[full], hashes[full]
    row = blocks.rows_of(starts, offsets)
    same_row = row[1:] == row[:-1]
    pair = blocks.mixed(hashes[:-1] * np.uint64(3) + hashes[1:])
    equal = same_row & (hashes[1:] == hashes[:-1])
    run = equal.copy()
    for back in range(1, RUN - 1):
        run[back:] &= equal[:-back]
        run[:back] = False
    word = kind[starts] == 1
    paired = run | (same_row & word[1:] & word[:-1])
    pair = np.where(run, np.uint64(0), pair)[paired]
    one = (hashes % np.uint64(UNIGRAMS)).astype(np.int64)
    two = (pair % np.uint64(BIGRAMS)).astype(np.int64) + UNIGRAMS
    return np.concatenate([row, row[1:][paired]]), np.concatenate([one, two])


def damped(rows: np.ndarray, buckets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each bucket of a row with its count, which grows by one for each doubling."""
    pairs, n = np.unique(rows * BUCKETS + buckets, return_counts=True)
    return *np.divmod(pairs, BUCKETS), 1 + np.floor(np.log2(n))


def good_label() -> Column:
    return F.coalesce((F.col("quality") == 1) & (F.col("toxic") == 0), F.lit(False))


def labelled_ids(labels: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Sorted ids of about LABELLED labelled documents: those that are good and not toxic, and the others."""
    rows = labels.filter(F.col("doc_id").isNotNull()).select(F.col("doc_id").cast("bigint").alias("doc_id"), good_label().alias("good"))
    picked = hash_sample(rows.distinct(), "doc_id", LABELLED).toArrow()
    ids, good = picked.column("doc_id").to_numpy().astype(np.int64), picked.column("good").to_numpy().astype(bool)
    return np.sort(ids[good]), np.sort(ids[~good])


def sigmas(more: np.ndarray, less: np.ndarray) -> np.ndarray:
    """Distance of two counts in standard deviations; the square root of a count has the same one for all sizes."""
    return 2 * (np.sqrt(more + 0.375) - np.sqrt(less + 0.375))


def _evidence(r: np.ndarray, t: np.ndarray, b: np.ndarray, all_r: float, all_t: float, all_b: float) -> np.ndarray:
    """Log ratios of buckets by their counts in the raw text, the target and the other labelled texts, beside the sums over all."""
    if not all_t:
        return np.zeros(len(r))
    expected = r * (all_t / all_r)
    ratio = np.log((t + SMOOTH) / all_t) - np.log((r + SMOOTH) / all_r)
    sure = (sigmas(expected, t) > SIGMAS) & (ratio < -EFFECT)
    by_chance = (t + b) * (all_b / (all_t + all_b))
    sure &= sigmas(b, by_chance) > SIGMAS
    return np.where(sure, ratio, 0)


def log_ratios(docs: DataFrame, good: np.ndarray, bad: np.ndarray) -> np.ndarray:
    """Per bucket the capped log ratio of target to raw rate; 0 without evidence. The counts stay in tasks, the ratios come to the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros((len(MODELS), BUCKETS), np.int64)
        for batch in batches:
            ids = batch.column("doc_id").to_numpy(zero_copy_only=False)
            target, other = np.isin(ids, good), np.isin(ids, bad)
            for row, _, data, offsets in blocks.blocks(batch.column("text"), BLOCK):
                rows, bucket, n = damped(*ngrams(data, offsets))
                for model, held in enumerate((np.ones(len(ids), bool), target, other)):
                    own = held[row + rows]
                    counts[model] += np.bincount(bucket[own], n[own], BUCKETS).astype(np.int64)
        if counts.any():
            parts = counts.reshape(len(MODELS), SLICES, -1)
            kind = np.uint32 if parts.max() < 2**32 else np.uint64
            packed = [[part.astype(kind).tobytes() for part in side] for side in parts]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(SLICES)), pa.array([np.dtype(kind).itemsize] * SLICES), *[pa.array(p, pa.binary()) for p in packed]],
                ["slice", "width", *MODELS],
            )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(MODELS), SLICE_BYTES), np.int64)
        for batch in batches:
            for row in batch.to_pylist():
                kind = np.uint32 if row["width"] == 4 else np.uint64
                total += np.stack([np.frombuffer(row[c], kind).astype(np.int64) for c in MODELS])
        at = key[0].as_py()
        yield pa.RecordBatch.from_arrays(
            [pa.array([at]), pa.array([at >= UNIGRAMS // SLICE_BYTES]), *[pa.array([int(t.sum())]) for t in total], *[pa.array([t.tobytes()], pa.binary()) for t in total]],
            ["slice", "paired", *[f"{m}_n" for m in MODELS], *MODELS],
        )

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    kinds, sums = (", ".join(f"{m}{end}" for m in MODELS) for end in (" binary", "_n bigint"))
    local = texts.mapInArrow(count, f"slice bigint, width bigint, {kinds}")
    summed = stored(local.groupBy("slice").applyInArrow(add, f"slice bigint, paired boolean, {sums}, {kinds}"), "importance-counts")
    wholes = {r["paired"]: [float(r[m]) for m in MODELS] for r in summed.groupBy("paired").agg(*[F.sum(f"{m}_n").alias(m) for m in MODELS]).collect()}

    def ratios(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                counts = [np.frombuffer(row[m], np.int64).astype(np.float64) for m in MODELS]
                out = _evidence(*counts, *wholes[row["paired"]]).astype(np.float32)
                if out.any():
                    yield pa.RecordBatch.from_arrays([pa.array([row["slice"]]), pa.array([out.tobytes()], pa.binary())], ["slice", "ratios"])

    out = np.zeros((SLICES, SLICE_BYTES), np.float32)
    for row in summed.select("slice", "paired", *MODELS).mapInArrow(ratios, "slice bigint, ratios binary").collect():
        out[row["slice"]] = np.frombuffer(row["ratios"], np.float32)
    return out.reshape(-1)


def gumbel() -> Column:
    """Noise from a hash of the row, so a task that runs again makes the same choice."""
    h = F.pmod(F.xxhash64("doc_id", "text", F.lit(SEED)), F.lit(1 << 52))
    return -F.log(-F.log((h + F.lit(0.5)) / F.lit(float(1 << 52))))


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents with log_weight and key (log_weight with Gumbel noise)."""
    spark = docs.sparkSession
    ratios = spark.sparkContext.broadcast(log_ratios(docs, *labelled_ids(labels)))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            weight = np.zeros(batch.num_rows)
            for row, end, data, offsets in blocks.blocks(batch.column("text"), BLOCK):
                rows, bucket = ngrams(data, offsets)
                weight[row:end] = np.bincount(rows, ratios.value[bucket], end - row)
            yield batch.append_column("log_weight", pa.array(weight))

    rows = docs.withColumn("noise", gumbel())
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    return rows.mapInArrow(score, kinds + ", log_weight double").withColumn("key", F.col("log_weight") + F.col("noise")).drop("noise")


def ranked(rows: DataFrame, labels: DataFrame) -> tuple[DataFrame, int]:
    """Stored scores with their rank by key, and k."""
    good = labels.filter(good_label()).select(F.col("doc_id").cast("bigint").alias("doc_id"))
    floor = rows.join(good.distinct(), "doc_id").agg(F.expr(f"approx_percentile(log_weight, {LOSS}, 100000)")).first()[0]
    k = rows.count() if floor is None else rows.filter(F.col("log_weight") >= floor).count()
    order = (-F.col("key") * F.lit(float(1 << 32))).cast("bigint")
    return numbered(rows.withColumn("at", order), ["at", "doc_id"], "one"), k


def classified(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, log_weight, key, rank, kept."""
    slim = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = stored(scored(slim, labels).drop("text").withColumn("one", F.lit(1)), "importance")
    found, k = ranked(rows, labels)
    return found.select("doc_id", "log_weight", "key", "rank", (F.col("rank") < k).alias("kept"))


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The kept documents, with their own columns."""
    plain = guarded(docs).withColumn("doc_id", F.col("doc_id").cast("bigint"))
    rows = stored(scored(plain, labels).withColumn("one", F.lit(1)), "importance-docs")
    found, k = ranked(rows.select("doc_id", "log_weight", "key", "one"), labels)
    last = found.filter(F.col("rank") == k - 1).select("at", "doc_id").first()
    if last is None:
        return restored(rows.limit(0), docs)
    at = (-F.col("key") * F.lit(float(1 << 32))).cast("bigint")
    tie = (at == last["at"]) & (F.coalesce(F.col("doc_id"), F.lit(-(2**62))) <= (last["doc_id"] if last["doc_id"] is not None else -(2**62)))
    return restored(rows.filter((at < last["at"]) | tie), docs)
