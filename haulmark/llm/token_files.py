"""Token ids in binary files: patched frame of reference, one file for each range of documents.

A file is a run of blocks, an index and a trailer, all little-endian:

  block    base u32, n u32, exceptions u32, width u8; the low `width` bits of
           id - base, packed; place u16 and id - base u32 of each exception
  index    doc_id i64 and n_tokens u32 of each document; start u64 of each block
  trailer  offset of the index u64, documents u64, blocks u64, tokens u64, magic

Every block but the last holds BLOCK_IDS ids, so the block of any token and its
place in the file are known without reading others. The width is the smallest
that holds PERCENTILE of the block's values; larger values are exceptions.

Documents are dealt into ranges of ids and sorted; files are written under a
name of the attempt and then moved, so a task that runs twice leaves one whole
file. Missing texts count as empty, missing ids come first, repeated rows are
documents of their own, an empty table makes no file.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from haulmark.llm.tables import NO_ID, stored, texts_of
from haulmark.session import run_dir

BLOCK_IDS = 4096
PERCENTILE = 99.0
MAGIC = b"PFOR1\0\0\0"
HEAD, TRAILER = struct.Struct("<IIIB"), struct.Struct("<QQQQ8s")
SPECIAL = "<|endoftext|>"
LATIN = 0x250  # below it, character classes are the same in all versions of Unicode


def pack(ids: np.ndarray) -> bytes:
    base = int(ids.min())
    values = (ids - base).astype(np.uint32)
    width = max(1, int(np.percentile(values, PERCENTILE, method="higher")).bit_length())
    odd = np.flatnonzero(values >> np.uint32(width)) if width < 32 else np.zeros(0, np.int64)
    bits = (values[:, None] >> np.arange(width, dtype=np.uint32)) & np.uint32(1)
    body = np.packbits(bits.astype(np.uint8).ravel(), bitorder="little").tobytes()
    return HEAD.pack(base, len(ids), len(odd), width) + body + odd.astype("<u2").tobytes() + values[odd].astype("<u4").tobytes()


def unpack(data: bytes, at: int = 0) -> np.ndarray:
    base, n, exceptions, width = HEAD.unpack_from(data, at)
    at += HEAD.size
    size = (n * width + 7) // 8
    bits = np.unpackbits(np.frombuffer(data, np.uint8, size, at), count=n * width, bitorder="little").reshape(n, width)
    padded = np.zeros((n, 32), np.uint8)
    padded[:, :width] = bits
    values = np.packbits(padded.ravel(), bitorder="little").view("<u4").astype(np.uint32)
    at += size
    odd = np.frombuffer(data, "<u2", exceptions, at)
    values[odd] = np.frombuffer(data, "<u4", exceptions, at + 2 * exceptions)
    return values + np.uint32(base)


class Writer:
    """Writes one file; ids are held for one block at a time."""

    def __init__(self, out):
        self.out, self.at, self.starts, self.docs, self.held, self.n = out, 0, [], [], [], 0
        self.waiting = 0  # ids in held

    def add(self, doc_id: int | None, ids: np.ndarray) -> None:
        self.docs.append((NO_ID if doc_id is None else doc_id, len(ids)))
        self.held.append(ids)
        self.n += len(ids)
        self.waiting += len(ids)
        if self.waiting >= 64 * BLOCK_IDS:
            self.flush(BLOCK_IDS)

    def flush(self, least: int) -> None:
        ids = np.concatenate(self.held) if self.held else np.zeros(0, np.uint32)
        done = 0
        while len(ids) - done >= least:
            body = pack(ids[done : done + BLOCK_IDS])
            self.starts.append(self.at)
            self.out.write(body)
            self.at += len(body)
            done += min(BLOCK_IDS, len(ids) - done)
        self.held, self.waiting = [ids[done:]], len(ids) - done

    def close(self) -> None:
        self.flush(1)
        doc_ids = np.array([d for d, _ in self.docs], "<i8")
        self.out.write(doc_ids.tobytes() + np.array([n for _, n in self.docs], "<u4").tobytes())
        self.out.write(np.array(self.starts, "<u8").tobytes())
        self.out.write(TRAILER.pack(self.at, len(self.docs), len(self.starts), self.n, MAGIC))


class Reader:
    """Reads one file: the index at once, blocks as they are asked for."""

    def __init__(self, source):
        self.source, size = source, source.size()
        self.index, docs, blocks, self.n, magic = TRAILER.unpack(self._read(size - TRAILER.size, TRAILER.size))
        if magic != MAGIC:
            raise ValueError("not a token file")
        body = self._read(self.index, 12 * docs + 8 * blocks)
        self.doc_ids = np.frombuffer(body, "<i8", docs)
        self.lengths = np.frombuffer(body, "<u4", docs, 8 * docs)
        self.starts = np.append(np.frombuffer(body, "<u8", blocks, 12 * docs), np.uint64(self.index))

    def _read(self, at: int, size: int) -> bytes:
        self.source.seek(at)
        return self.source.read(size)

    def block(self, k: int) -> np.ndarray:
        return unpack(self._read(int(self.starts[k]), int(self.starts[k + 1] - self.starts[k])))

    def tokens(self, first: int, n: int) -> Iterator[np.ndarray]:
        """Ids first to first + n, in parts."""
        while n > 0:
            ids = self.block(first // BLOCK_IDS)[first % BLOCK_IDS :][:n]
            yield ids
            first, n = first + len(ids), n - len(ids)

    def documents(self) -> Iterator[tuple[int, int, Iterator[np.ndarray]]]:
        """doc_id, number of ids, ids in parts; each block is read once."""
        k, block = -1, np.zeros(0, np.uint32)
        first = 0
        for doc_id, n in zip(self.doc_ids.tolist(), self.lengths.tolist(), strict=True):
            parts, at, left = [], first, n
            while left:
                if at // BLOCK_IDS != k:
                    k = at // BLOCK_IDS
                    block = self.block(k)
                ids = block[at % BLOCK_IDS :][:left]
                parts.append(ids)
                at, left = at + len(ids), left - len(ids)
            yield doc_id, n, iter(parts)
            first += n


@lru_cache(maxsize=2)
def encoders(path: str):
    """The library's tokenizer, and a faster one over the same vocabulary for texts in Latin letters."""
    import json

    import tiktoken
    from tokenizers import Tokenizer

    with open(path, encoding="utf-8") as f:
        vocab = json.load(f)["model"]["vocab"]
    place = {c: b for b, c in byte_letters().items()}
    ranks = {bytes(place[c] for c in piece): i for piece, i in vocab.items()}
    slow = Tokenizer.from_file(path)
    quick = tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={SPECIAL: slow.token_to_id(SPECIAL)}
    )
    return slow, quick


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in byte-level vocabularies: itself if printable, else the next from 256 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in printable]
    return {b: chr(b) for b in printable} | {b: chr(256 + i) for i, b in enumerate(rest)}


def encode(path: str, text: str) -> np.ndarray:
    slow, quick = encoders(path)
    if text and ord(max(text)) >= LATIN:
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)
    try:
        return np.array(quick.encode(text, allowed_special="all"), np.uint32)
    except ValueError:  # its regex runs out of stack in a run of a million blanks
        return np.array(slow.encode(text, add_special_tokens=False).ids, np.uint32)


def filesystem(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri)


def write(docs: DataFrame, folder: str, vocabulary: str, end_id: int, files: int) -> DataFrame:
    """Write the files; returns part, path, n_docs, n_tokens of each."""
    path = public_tokenizers.path(vocabulary)
    ordered = texts_of(docs).repartitionByRange(files, F.col("doc_id").asc_nulls_first())
    ordered = ordered.sortWithinPartitions(F.col("doc_id").asc_nulls_first(), F.xxhash64("text"))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, out, part = TaskContext.get(), None, 0
        for batch in batches:
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                if out is None:
                    part = context.partitionId()
                    store, root = filesystem(folder)
                    store.create_dir(root, recursive=True)
                    name = f"{root}/part-{part:05d}.pfor"
                    draft = f"{root}/_draft-{part:05d}-{context.taskAttemptId()}"
                    stream = store.open_output_stream(draft)
                    out = Writer(stream)
                out.add(doc_id, np.append(encode(path, text.as_py()), np.uint32(end_id)))
        if out is not None:
            out.close()
            stream.close()
            store.move(draft, name)
            yield pa.RecordBatch.from_pylist([{
                "part": part, "path": f"{folder}/part-{part:05d}.pfor", "n_docs": len(out.docs), "n_tokens": out.n
            }])

    return stored(ordered.mapInArrow(task, "part bigint, path string, n_docs bigint, n_tokens bigint"), "token-manifest")


def read(manifest: DataFrame, files: int) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of each document, from the files."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)  # one row for each file
    lifted = manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(earlier), F.lit(0)))

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                store, path = filesystem(row["path"])
                start, out = row["start"], []
                with store.open_input_file(path) as source:
                    for doc_id, n, parts in Reader(source).documents():
                        crc = 0
                        for ids in parts:
                            crc = zlib.crc32(ids.astype("<u4").tobytes(), crc)
                        out.append((None if doc_id == NO_ID else doc_id, start, n, crc))
                        start += n
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["doc_id", "start", "n_tokens", "ids_crc32"]
                )

    kinds = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"
    return lifted.repartition(files, "part").mapInArrow(task, kinds)


def round_trip(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json", end_id: int = 2, files: int | None = None) -> DataFrame:
    """Encode, write and read back."""
    spark = docs.sparkSession
    files = files or int(spark.conf.get("spark.sql.shuffle.partitions"))
    folder = run_dir(spark, "token-files")
    folder = folder if "://" in folder else "file://" + folder
    return read(write(docs, folder, vocabulary, end_id, files), files)
