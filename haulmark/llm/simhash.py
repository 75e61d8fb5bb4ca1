"""Near-duplicates by SimHash: fingerprints of word shingles, linked through vantage-point trees.

A tree over a bounded sample cuts the space of fingerprints into shards: each
node has a vantage point and a middle distance. A fingerprint lives in one leaf
and visits every earlier leaf whose region, by the triangle inequality, may hold
something within the radius. Each shard searches its own tree of all its
fingerprints for exact pairs and reports a spanning forest of them.

Only distinct fingerprints are searched, so copies cost nothing. In a dense
group the points around a vantage point are linked to it and not to each other.
Missing and empty texts have fingerprint zero. Missing ids belong to their
fingerprint's component but are never its smallest id; a component without ids
has a null id. Repeated rows stay; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm.components import roots
from haulmark.llm.tables import guarded, hash_sample, order_key, restored, stored, texts_of

WORDS, BITS, SEED = 4, 4, 42
SHARD = 1 << 14  # fingerprints that live in one shard
DEEPEST = 20  # levels of the shared tree: a million shards, for 17 billion fingerprints
PER_LEAF = 64  # sample points for each leaf of the shared tree
SAMPLE = 1 << 22  # at most
BRUTE = 128
CHUNK = 1 << 14
HELD = 1 << 21  # pairs held before they are merged into labels


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """Signed 64-bit fingerprint; a bit is set if it is set in over half of the shingles' hashes."""
    import xxhash

    parts = (text or "").encode().lower().split()
    if not parts:
        return 0
    body, ends = b" ".join(parts), np.cumsum([len(p) + 1 for p in parts])
    starts = np.append(0, ends[:-1])
    last = max(1, len(parts) - words + 1)
    stops = ends[min(words, len(parts)) - 1 :] - 1
    view, digest = memoryview(body), xxhash.xxh64_intdigest
    hashes = np.array([digest(view[a:b], SEED) for a, b in zip(starts[:last].tolist(), stops.tolist(), strict=True)], np.uint64)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), CHUNK):
        part = hashes[at : at + CHUNK].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, words: int = WORDS) -> DataFrame:
    """doc_id, h (hash of the text), fp."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("h"), pa.array(fps, pa.int64())], ["doc_id", "h", "fp"])

    return texts_of(docs).withColumn("h", F.xxhash64("text")).mapInArrow(task, "doc_id bigint, h bigint, fp bigint")


def apart(points: np.ndarray, other) -> np.ndarray:
    return np.bitwise_count(points ^ other)


def shared_tree(sample: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """Vantage points and middle distances of a full tree, in heap order from 1."""
    size = 1 << depth
    vantage, middle = np.zeros(size, np.uint64), np.full(size, 32, np.int64)
    held = {1: sample}
    for node in range(1, size):
        points = held.pop(node)
        if len(points):
            vantage[node] = points[len(points) // 2]
            d = apart(points, vantage[node])
            middle[node] = int(np.median(d))
            near = d <= middle[node]
            if near.all():
                middle[node] -= 1
                near = d <= middle[node]
            held[2 * node], held[2 * node + 1] = points[near], points[~near]
        else:
            vantage[node] = np.uint64(node * 0x9E3779B97F4A7C15 % 2**64)
            held[2 * node] = held[2 * node + 1] = points
    return vantage, middle


def placed(points: np.ndarray, vantage: np.ndarray, middle: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(leaf, index of point, lives there): each point's own leaf, and the earlier ones that it must visit."""
    size = len(vantage)
    index, node, home = np.arange(len(points)), np.ones(len(points), np.int64), np.ones(len(points), bool)
    while size > 1:
        d = apart(points[index], vantage[node]).astype(np.int64)
        m = middle[node]
        left = d <= m
        # visitors go to both sides of the ring; those at home also send a visitor to the earlier side
        to_left = (left & ~home) | (~left & (d <= m + bits))
        to_right = ~home & (d > m - bits)
        index, node, home = (
            np.concatenate([index[home], index[to_left], index[to_right]]),
            np.concatenate([(2 * node + ~left)[home], 2 * node[to_left], 2 * node[to_right] + 1]),
            np.concatenate([np.ones(home.sum(), bool), np.zeros(to_left.sum() + to_right.sum(), bool)]),
        )
        size //= 2
    return node, index, home


def search(home: np.ndarray, guests: np.ndarray, points: np.ndarray, bits: int, out: Forest | list[np.ndarray]) -> None:
    """Link home points to each other and to guests; index arrays into points, pairs are appended to out."""
    stack = [(home, guests)]
    while stack:
        home, guests = stack.pop()
        if not len(home) or len(home) + len(guests) < 2:
            continue
        if len(home) <= BRUTE:
            for at in range(0, len(guests), CHUNK):
                part = guests[at : at + CHUNK]
                g, h = np.nonzero(apart(points[part][:, None], points[home]) <= bits)
                out.append(np.stack([part[g], home[h]]))
            a, b = np.nonzero(np.triu(apart(points[home][:, None], points[home]) <= bits, 1))
            out.append(np.stack([home[a], home[b]]))
            continue
        vantage = home[len(home) // 2]
        dh, dg = apart(points[home], points[vantage]), apart(points[guests], points[vantage])
        near, near_guests = dh <= bits, dg <= bits
        if 2 * near.sum() >= len(home):
            core = np.concatenate([home[near], guests[near_guests]])
            out.append(np.stack([core, np.full(len(core), vantage)]))
            own = home[near]
            ring = np.concatenate([home[~near & (dh <= 2 * bits)], guests[~near_guests & (dg <= 2 * bits)]])
            step = max(1, (CHUNK * BRUTE) // len(own))
            for at in range(0, len(ring), step):
                part = ring[at : at + step]
                hit = apart(points[part][:, None], points[own]) <= bits
                some = hit.any(1)
                out.append(np.stack([part[some], own[hit[some].argmax(1)]]))
            stack.append((home[~near], guests))  # guests around the vantage may still link to others at home
            continue
        middle = int(np.median(dh))
        if middle >= dh.max():
            middle = int(dh.max()) - 1
        left = dh <= middle
        across = home[~left & (dh <= middle + bits)]
        stack.append((home[left], np.concatenate([guests[dg <= middle + bits], across])))
        stack.append((home[~left], guests[dg.astype(np.int64) > middle - bits]))


def forest(n: int, pairs: np.ndarray) -> np.ndarray:
    """Least index of each point's component."""
    label = np.arange(n)
    a, b = pairs
    while True:
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while True:
            jumped = new[new]
            if np.array_equal(jumped, new):
                break
            new = jumped
        if np.array_equal(new, label):
            return label
        label = new


class Forest:
    """Labels of the points of a shard; pairs are held up to a bound and then merged into the labels."""

    def __init__(self, n: int):
        self.label, self.held, self.size = np.arange(n), [], 0

    def append(self, pairs: np.ndarray) -> None:
        self.held.append(pairs)
        self.size += pairs.shape[1]
        if self.size >= HELD:
            self.merge()

    def merge(self) -> np.ndarray:
        own = np.stack([np.arange(len(self.label)), self.label])
        self.label = forest(len(self.label), np.concatenate([own, *self.held], 1))
        self.held, self.size = [], 0
        return self.label


def links(fps: DataFrame, bits: int = BITS, shard: int = SHARD) -> DataFrame:
    """a, b: links that join the same fingerprints as all pairs within the distance do. fps: distinct, column fp."""
    n = fps.count()
    depth = min(DEEPEST, max(0, (-(-n // shard) - 1).bit_length()))
    sample = hash_sample(fps.select("fp"), "fp", min(SAMPLE, PER_LEAF << depth)).toArrow().column("fp").to_numpy()
    vantage, middle = shared_tree(np.sort(sample.astype(np.int64).view(np.uint64)), depth)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fp = batch.column("fp").to_numpy(zero_copy_only=False).astype(np.int64)
            leaf, index, home = placed(fp.view(np.uint64), vantage, middle, bits)
            yield pa.RecordBatch.from_arrays([pa.array(leaf), pa.array(fp[index]), pa.array(home)], ["leaf", "fp", "home"])

    def within(frame: pd.DataFrame) -> pd.DataFrame:
        fp, home = frame["fp"].to_numpy().astype(np.int64), frame["home"].to_numpy().astype(bool)
        out = Forest(len(fp))
        search(np.flatnonzero(home), np.flatnonzero(~home), fp.view(np.uint64), bits, out)
        root = out.merge()
        linked = root != np.arange(len(fp))
        return pd.DataFrame({"a": fp[linked], "b": fp[root[linked]]})

    dealt = fps.select("fp").mapInArrow(deal, "leaf bigint, fp bigint, home boolean")
    return dealt.groupBy("leaf").applyInPandas(within, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """doc_id, h, fp, root (least fingerprint of the component), component_id (the smallest id reachable through links)."""
    found = stored(fingerprints(docs, words), "simhash")
    nodes = stored(found.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-nodes")
    root = stored(roots(links(nodes, bits)), "simhash-roots")
    named = nodes.join(root, nodes["fp"] == root["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    ids = named.groupBy("root").agg(F.min("least").alias("component_id"))
    named = named.join(ids, "root").select("fp", "root", "component_id")
    return found.join(named, "fp").select("doc_id", "h", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, words: int = WORDS, bits: int = BITS) -> DataFrame:
    """The document of smallest id of each component, with its own columns; of equal rows one."""
    found = near_duplicates(docs, words, bits)
    first = F.min(F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "h")).alias("first")
    kept = found.groupBy("root").agg(first).select(order_key("first.doc_id").alias("kept_id"), F.col("first.h").alias("kept_h"))
    rows = guarded(docs).withColumns({"kept_id": order_key(), "kept_h": F.xxhash64(F.coalesce("text", F.lit("")))})
    return restored(rows.join(kept, ["kept_id", "kept_h"]).dropDuplicates(["kept_id", "kept_h"]), docs)
