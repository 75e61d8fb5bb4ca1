import re

import numpy as np
import plain
import pytest
import xxhash
from plain import HARD

from haulmark.llm import components, simhash


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(words[i : i + 4]).encode(), 42) for i in range(max(1, len(words) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def smallest(ids, fps, bits=4):
    fps = np.array(fps, np.uint64)
    root = plain.components(len(ids), np.argwhere(np.triu(simhash.apart(fps[:, None], fps) <= bits, 1)))
    known = {}
    for i, r in zip(ids, root, strict=True):
        known[r] = min((x for x in (known.get(r), i) if x is not None), default=None)
    return [known[r] for r in root]


def check(docs, rows):
    ids, fps = [i for i, _ in rows], [fingerprint(t) for _, t in rows]
    want = sorted(zip(ids, fps, smallest(ids, fps), strict=True), key=repr)
    got = simhash.near_duplicates(docs).select("doc_id", "fp", "component_id").collect()
    assert sorted(((i, fp % 2**64, c) for i, fp, c in got), key=repr) == want


def test_documents(spark, frame):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    check(frame(rows), rows)


def test_hard_rows(frame):
    check(frame(HARD), HARD)
    assert simhash.near_duplicates(frame([])).count() == 0


def near(rng, base, n, flips):
    out = np.repeat(base, n)
    for _ in range(flips):
        out = out ^ (np.uint64(1) << rng.integers(0, 64, n).astype(np.uint64))
    return out


@pytest.mark.parametrize("flips", [2, 4, 8])
@pytest.mark.parametrize("depth", [0, 3, 6])
def test_trees_find_all_components(flips, depth):
    rng = np.random.default_rng(flips)
    parts = [rng.integers(0, 2**64, 800, dtype=np.uint64)]
    parts += [near(rng, rng.integers(0, 2**64, 1, dtype=np.uint64), 30, int(rng.integers(1, 7))) for _ in range(12)]
    parts += [near(rng, rng.integers(0, 2**64, 1, dtype=np.uint64), 900, flips)]
    points = np.unique(np.concatenate(parts))
    want = plain.components(len(points), np.argwhere(np.triu(simhash.apart(points[:, None], points) <= 4, 1)))
    vantage, middle = simhash.shared_tree(rng.permutation(points)[: 64 << depth], depth)
    leaf, index, home = simhash.placed(points, vantage, middle, 4)
    assert sorted(index[home]) == list(range(len(points)))
    links = []
    for at in np.unique(leaf):
        local, own = index[leaf == at], home[leaf == at]
        out = []
        simhash.search(np.flatnonzero(own), np.flatnonzero(~own), points[local], 4, out)
        if out:
            links += list(zip(local, local[simhash.forest(len(local), np.concatenate(out, 1))], strict=True))
    assert plain.components(len(points), links) == want


def test_pairs_are_merged_when_many_are_held(monkeypatch):
    monkeypatch.setattr(simhash, "HELD", 500)
    rng = np.random.default_rng(6)
    points = np.unique(np.concatenate([near(rng, np.uint64(rng.integers(0, 2**63)), 700, f) for f in (3, 5, 8)]))
    own = rng.random(len(points)) < 0.7
    out = simhash.Forest(len(points))
    simhash.search(np.flatnonzero(own), np.flatnonzero(~own), points, 4, out)
    assert out.size < 500
    linked = np.triu(simhash.apart(points[:, None], points) <= 4, 1) & (own[:, None] | own)
    assert out.merge().tolist() == plain.components(len(points), np.argwhere(linked))


def test_components_of_chains_and_stars(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(40)] + [(-5, 100), (300, 300), (61, 60), (7, 3)]
    got = {r["node"]: r["root"] for r in components.roots(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {i: 0 for i in range(62)} | {i: -5 for i in [-5, 100, *range(200, 240)]}
    assert components.roots(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_document_of_each_component_stays(frame):
    rows = [(3, "same words here again and again"), (1, "same words here again and again"), (1, "same words here again and again"),
            (None, "same words here again and again"), (None, "only without an id"), (9, None), (8, "")]
    kept = simhash.one_of_each(frame(rows))
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == sorted([(1, rows[0][1]), (None, rows[4][1]), (8, "")], key=repr)
