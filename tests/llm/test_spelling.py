import random
import re
import zlib

import numpy as np
import pytest

from haulmark.llm import spelling as S


def counted(rows, every=97):
    totals = {}
    for doc_id, text in rows:
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", low):
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % every == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1 :]
            if len(run) >= 5:
                totals[run] = totals.get(run, 0) + 1
    return {w: n for w, n in totals.items() if n >= 3}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute(words):
    links = {a: [b for b in words if near(a, b)] for a in words}
    form = {}
    for a, others in links.items():
        best = min(others, key=lambda b: (-words[b], b), default=None)
        if best is not None and words[best] >= 2 * words[a]:
            form[a] = best
    out = {}
    for a, n in words.items():
        root = a
        while root in form:
            root = form[root]
        out[a] = (form.get(a), root, n, len(links[a]), words[form[a]] if a in form else None)
    return out


def found(df):
    return {r["word"]: tuple(r[c] for c in ("form", "root", "n", "n_near", "form_n")) for r in df.collect()}


def texts(rng, n, letters="abeé"):
    words = ["".join(rng.choice(letters) for _ in range(rng.choice([4, 5, 5, 6, 7]))) for _ in range(160)]
    return [(i, " ".join(rng.choice(words[: rng.choice([10, 40, 160])]) for _ in range(200)) + " ÉÀ×÷ Aß1x_y") for i in range(n)]


@pytest.mark.parametrize("shard", [8192, 16])
def test_words_equal_brute_force(frame, monkeypatch, shard):
    monkeypatch.setattr(S, "SHARD", shard)
    rows = texts(random.Random(4), 30) + [(None, "Hello hello HELLO helo hellö hellò"), (1000, None), (1001, "")]
    words = counted(rows)
    assert len(words) > 100
    assert found(S.grouped(S.word_counts(frame(rows), every=97))) == brute(words)


def test_ties_repeated_rows_and_empty_table(frame):
    rows = [(1, "graph graph graph grape grape grape " * 2 + "grapes " * 3)] * 2
    got = found(S.grouped(S.word_counts(frame(rows))))
    # both forms are twice as frequent: the least one
    assert got["grapes"] == ("grape", "grape", 6, 1, 12)
    assert got["grape"] == (None, "grape", 12, 2, None)
    assert found(S.grouped(S.word_counts(frame([])))) == {}


def test_roots_follow_whole_chains(spark):
    chain = [f"word{chr(97 + i)}" for i in range(20)]
    forms = spark.createDataFrame(list(zip(chain, chain[1:], strict=False)), "word string, form string")
    assert {r["root"] for r in S.roots(forms).collect()} == {chain[-1]}


def test_very_long_texts_and_words(frame):
    long = "x" * 300_000
    rows = [(i, ("lorem ipsum " * 400_000 if i < 2 else "") + f"{long} {long}y {long}") for i in range(4)]
    got = found(S.grouped(S.word_counts(frame(rows))))
    assert got["lorem"] == (None, "lorem", 800_000, 0, None)
    assert got[long + "y"] == (long, long, 4, 1, 8)


def test_tree_visits_every_near_word():
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abcd") for _ in range(6)) for _ in range(600)})
    shorter = sorted({w[:3] + w[4:] for w in words})
    shard = S.Shard(words, [1] * len(words))
    assert len(shard.sizes) > 20
    for others, replaced in ((words, True), (shorter, False)):
        a, b = shard.pairs(others, replaced)
        assert len(a) == len({*zip(a.tolist(), b.tolist(), strict=True)})
        assert {(others[i], words[j]) for i, j in zip(a, b, strict=True)} == {(x, y) for x in others for y in words if near(x, y)}


def test_packed_counts_bound_the_distance():
    counts = S.vectors(["aabbcé", "abcccÿ", "zzzzzz"])
    bits = np.bitwise_count(S.packed(counts)[:, None] ^ S.packed(counts)[None]).sum(axis=2)
    assert (bits <= np.abs(counts[:, None] - counts[None]).sum(axis=2)).all()


def test_parts_of_a_full_shard_find_the_same(frame, monkeypatch):
    words = S.word_counts(frame(texts(random.Random(9), 20)), every=97)
    want = found(S.grouped(words))
    original = S.placed
    monkeypatch.setattr(S, "placed", lambda words, trees, parts, visiting: original(words, trees, {(n, 0): 3 for n in range(9)}, visiting))
    assert found(S.grouped(words)) == want
