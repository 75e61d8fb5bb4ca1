"""Token counts from a vocabulary of pre-tokens, without token ids.

Pieces of the tokenizer never hold a blank after another character, so no merge
crosses the start of a run of blanks: a text's count is the sum over its
pre-tokens, each a run of blanks and what follows. U+2581 is the tokenizer's own
sign for a blank, so a blank after it continues the run. A blank is put before each
text, as the tokenizer does. The pieces of each distinct pre-token of the corpus
are counted once; the counts are joined to the frequencies of pre-tokens per
document and summed. The join with the HEAVY most frequent pre-tokens, a table
of bounded size, is made where the texts are read; only rare ones are shuffled.

Missing and empty texts have no tokens; missing ids stay missing; repeated rows
are counted each; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm import blocks
from haulmark.llm.tables import stored, texts_of

HEAVY = 1 << 18
HEAVY_BYTES = 64  # longer pre-tokens are never in the bounded table
SPACE = 0x20
SIGN = "\u2581".encode()


@lru_cache(maxsize=2)
def processor(path: str):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_file=path)


def pre_token_starts(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """A text's first byte, and each blank after another character than a blank or U+2581."""
    start = data == SPACE
    start[1:] &= data[:-1] != SPACE
    late = np.flatnonzero(start[3:] & (data[2:-1] == SIGN[2])) + 3
    start[late[(data[late - 2] == SIGN[1]) & (data[late - 3] == SIGN[0])]] = False
    start[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
    return np.flatnonzero(start)


def pieces(path: str, pre_tokens: list[bytes]) -> np.ndarray:
    """Pieces of each pre-token; the first blank is the one that the tokenizer adds itself."""
    found = processor(path).encode([t[1:].decode() for t in pre_tokens], num_threads=1)
    return np.array([1 if t == b" " else len(ids) for t, ids in zip(pre_tokens, found, strict=True)], np.int64)


def vocabulary(texts: DataFrame, path: str) -> DataFrame:
    """token, n (occurrences), pieces: one row for each distinct pre-token of the corpus."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks.blocks(batch.column("text")):
                starts = pre_token_starts(data, offsets)
                first, kind = blocks.distinct(data, starts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(blocks.tokens(data, starts, first), pa.binary()), pa.array(np.bincount(kind, minlength=len(first)))],
                    ["token", "n"],
                )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.append_column("pieces", pa.array(pieces(path, batch.column("token").to_pylist()), pa.int64()))

    found = texts.select("text").mapInArrow(local, "token binary, n bigint").groupBy("token").agg(F.sum("n").alias("n"))
    return found.mapInArrow(count, "token binary, n bigint, pieces bigint")


def frequencies(texts: DataFrame, heavy) -> DataFrame:
    """doc_id, h, n_bytes, token, n, base: rare pre-tokens of each document.

    base holds the pieces of the document's heavy pre-tokens and copies is 1 on
    its first row, both are 0 on others. A document without rare pre-tokens has
    one row whose token is its own hash, which no pre-token equals.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known: dict[bytes, int] = heavy.value
        for batch in batches:
            for row, end, data, offsets in blocks.blocks(batch.column("text")):
                starts = pre_token_starts(data, offsets)
                first, kind = blocks.distinct(data, starts)
                words = blocks.tokens(data, starts, first)
                cost = np.array([known.get(w, -1) for w in words], np.int64)
                doc = blocks.rows_of(starts, offsets)
                base = np.bincount(doc, np.maximum(cost, 0)[kind], end - row).astype(np.int64)
                rare = cost[kind] < 0 if len(kind) else np.zeros(0, bool)
                pair, n = np.unique(doc[rare] * max(1, len(first)) + kind[rare], return_counts=True)
                at, word = pair // max(1, len(first)), pair % max(1, len(first))
                alone = np.setdiff1d(np.arange(end - row), at)
                part = batch.slice(row, end - row)
                marks = [b"\x00" + h.to_bytes(8, "little", signed=True) for h in part.column("h").take(pa.array(alone)).to_pylist()]
                rows = np.concatenate([at, alone])
                lead = np.concatenate([np.append(True, at[1:] != at[:-1])[: len(at)], np.ones(len(alone), bool)])
                token = pa.concat_arrays([pa.array(words, pa.binary()).take(pa.array(word)), pa.array(marks, pa.binary())])
                keys = [part.column(c).take(pa.array(rows)) for c in ("doc_id", "h", "n_bytes")]
                rest = [np.concatenate([n, np.zeros(len(alone), np.int64)]), np.where(lead, base[rows], 0), lead.astype(np.int64)]
                yield pa.RecordBatch.from_arrays(
                    [*keys, token, *map(pa.array, rest)], ["doc_id", "h", "n_bytes", "token", "n", "base", "copies"]
                )

    kinds = "doc_id bigint, h bigint, n_bytes bigint, token binary, n bigint, base bigint, copies bigint"
    return texts.mapInArrow(count, kinds)


def most_frequent(vocab: DataFrame, heavy: int) -> DataFrame:
    """token, pieces of the short pre-tokens whose frequency class is in the top ones with at most `heavy` members."""
    rank = F.floor(F.log2("n") * 16).alias("class")  # about 700 classes at most
    short = vocab.filter(F.octet_length("token") <= HEAVY_BYTES).select("token", "pieces", rank)
    floor, held = None, 0
    for row in short.groupBy("class").count().orderBy(F.desc("class")).collect():
        held += row["count"]
        if held > heavy:
            break
        floor = row["class"]
    return short.filter(F.lit(False) if floor is None else F.col("class") >= floor).drop("class")


def token_counts(docs: DataFrame, model: str = "piece_bpe_32k.model", heavy: int = HEAVY) -> DataFrame:
    """doc_id, n_bytes, n_tokens."""
    spark, path = docs.sparkSession, public_tokenizers.path(model)
    texts = texts_of(docs).select(
        "doc_id", F.xxhash64("text").alias("h"), F.octet_length("text").cast("bigint").alias("n_bytes"),
        F.when(F.col("text") != "", F.concat(F.lit(" "), "text")).otherwise("").alias("text"),
    )
    vocab = stored(vocabulary(texts, path), "pre-tokens")
    top = most_frequent(vocab, heavy).toArrow()  # at most `heavy` short rows
    known = dict(zip(top.column("token").to_pylist(), top.column("pieces").to_pylist(), strict=True))
    rows = frequencies(texts, spark.sparkContext.broadcast(known))
    joined = rows.join(vocab.select("token", "pieces"), "token", "left")
    each = joined.groupBy("doc_id", "h", "n_bytes").agg(
        F.sum(F.col("base") + F.col("n") * F.coalesce("pieces", F.lit(0))).alias("n"), F.sum("copies").alias("copies")
    )
    # equal rows were counted together
    return each.select(
        "doc_id", "n_bytes", F.expr("n div copies").alias("n_tokens"),
        F.explode(F.sequence(F.lit(1).cast("bigint"), "copies")).alias("copy"),
    ).drop("copy")
