import hashlib
import random

import numpy as np
import plain
import pyarrow as pa
import pytest
from plain import HARD

from haulmark.llm import suffix_dedup


def check(docs, rows, **options):
    width = options.get("width", suffix_dedup.WIDTH)
    want = []
    for (i, t), gone in zip(rows, plain.removed([t for _, t in rows], width), strict=True):
        body = (t or "").encode()
        kept = bytes(b for p, b in enumerate(body) if p not in gone)
        spans = sum(1 for p in gone if p - 1 not in gone)
        want.append((i, len(body), len(gone), spans, hashlib.sha256(kept).hexdigest()))
    got = [tuple(r) for r in suffix_dedup.deduplicated(docs, **options).collect()]
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return sum(w[2] for w in want)


def passages(seed, n=40):
    rng = random.Random(seed)
    def word():
        return "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 5)))

    shared = [" ".join(word() for _ in range(rng.randint(3, 12))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = [rng.choice(shared) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randint(1, 9))) for _ in range(rng.randint(0, 9))]
        rows.append((i, " ".join(parts)))
    return rows + [(n, "ab " * 60), (n + 1, "a" * 90), (n + 2, rows[3][1]), (None, None), (None, "")]


@pytest.mark.parametrize("crowd", [1 << 15, 2])
@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(frame, seed, crowd):
    rows = passages(seed)
    assert check(frame(rows), rows, width=20, size=7, crowd=crowd) > 0


@pytest.mark.parametrize("piece", [1, 13, 64])
def test_pieces_give_the_same_anchors(monkeypatch, piece):
    texts = [(t or "").encode() for _, t in passages(5)]
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0, *map(len, texts)])
    whole = suffix_dedup.anchors(data, offsets, 20, 7)
    monkeypatch.setattr(suffix_dedup, "PIECE", piece)
    for a, b in zip(whole, suffix_dedup.anchors(data, offsets, 20, 7), strict=True):
        assert a.tolist() == b.tolist()
    assert len(whole[0]) > 100


def test_sorted_windows_are_compared_across_batches():
    rng = random.Random(7)
    for _ in range(50):
        windows = sorted(bytes([rng.randint(0, 9)]) for _ in range(rng.randint(0, 14)))
        rows = pa.table({"doc_id": range(len(windows)), "h": [0] * len(windows), "low": [0] * len(windows), "step": [0] * len(windows), "window": windows})
        rows = rows.cast(pa.schema([(c, pa.int64()) for c in ("doc_id", "h", "low", "step")] + [("window", pa.binary())]))
        batches, at = [], 0
        while at < len(windows):
            size = rng.randint(0, 3)
            batches.append(pa.record_batch([c.combine_chunks() for c in rows.slice(at, size).columns], rows.schema))
            at += size
        got = [i for b in suffix_dedup.repeated_windows(iter(batches)) for i in b.column("doc_id").to_pylist()]
        assert got == [i for i, w in enumerate(windows) if windows.count(w) > 1]


def test_long_text_and_many_equal_rows(frame):
    rng = random.Random(9)
    long = "".join(rng.choices("abcdefgh ", k=20_000_000))
    row = "".join(rng.choices("abcdefgh ", k=400))
    rows = [(1, long), (2, "x" + long[5_000_000:5_000_900] + "y"), *[(3, row)] * 10_000]
    got = {}
    for r in suffix_dedup.deduplicated(frame(rows)).collect():
        got.setdefault(r["doc_id"], set()).add((r["n_bytes"], r["n_removed"], r["n_spans"]))
    assert got == {1: {(20_000_000, 900, 1)}, 2: {(902, 900, 1)}, 3: {(400, 400, 1)}}


def test_production_width_on_documents(spark, frame):
    rows = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]
    assert check(frame(rows), rows) > 0


def test_hard_rows(frame):
    check(frame(HARD), HARD)
    assert suffix_dedup.deduplicated(frame([])).count() == 0


def test_suffixes_are_sorted_in_their_groups():
    rng = random.Random(3)
    body = bytes(rng.choice(b"ab") for _ in range(400))
    starts = np.array(sorted(rng.sample(range(388), 120)))
    group = np.sort(np.array([rng.randint(0, 5) for _ in starts]))
    suffixes = suffix_dedup.Suffixes(np.frombuffer(body, np.uint8), 12)
    key = [(group[i], body[starts[i] : starts[i] + 12]) for i in range(120)]
    assert [key[i] for i in suffixes.sort(starts, group)] == sorted(key)
    assert suffixes.repeated(starts, group).tolist() == [key.count(k) > 1 for k in key]
