import random

import numpy as np
from plain import HARD

import corpus_pipeline
from haulmark.llm import blocks, importance, pii

SMALL = "/root/testdata/sf0.001"


def noisy(rng, good):
    words = [rng.choice(["river", "stone", "cloud", "green", "walks", "over", "under", "the", "of"]) for _ in range(60)]
    return " ".join(words) if good else " ".join(w + rng.choice(["%%%", "$$$"]) for w in words)


def test_classifier_on_held_out_labels(spark, frame):
    rng = random.Random(2)
    rows = [(i, noisy(rng, i % 4 > 0)) for i in range(1200)]
    labels = spark.createDataFrame([(i, int(i % 4 > 0), 0) for i in range(400)], "doc_id long, quality int, toxic int")
    kept = {r["doc_id"]: r["kept"] for r in importance.classified(frame(rows), labels).collect()}
    held_out = [i for i, _ in rows if i >= 400]
    assert np.mean([kept[i] == (i % 4 > 0) for i in held_out]) > 0.98


def test_classifier_on_the_tables(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    half = labels.filter("doc_id % 2 = 0")
    found = importance.classified(docs, half).join(labels.filter("doc_id % 2 = 1"), "doc_id").collect()
    clean = [r["kept"] for r in found if r["quality"] == 1 and r["toxic"] == 0]
    junk = [r["kept"] for r in found if r["quality"] == 0]
    assert np.mean(clean) > 0.95 and np.mean(junk) < 0.15


def test_rank_is_by_key_and_k_are_kept(spark, frame):
    rng = random.Random(3)
    rows = [(i, noisy(rng, i % 2)) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(100)], "doc_id long, quality int, toxic int")
    found = sorted(importance.classified(frame(rows), labels).collect(), key=lambda r: r["rank"])
    assert [r["rank"] for r in found] == list(range(100))
    keys = [r["key"] for r in found]
    assert all(a >= b - 1e-6 for a, b in zip(keys, keys[1:], strict=False))
    kept = [r["doc_id"] for r in found if r["kept"]]
    accepted = [r["doc_id"] for r in importance.accepted(frame(rows), labels).collect()]
    assert sorted(kept) == sorted(accepted)


def test_ngrams_equal_a_plain_count():
    texts = ["The the, a_b!! x", "", "a a a a a", "é-é é"]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    offsets = np.cumsum([0, *[len(t.encode()) for t in texts]])
    row, bucket = importance.ngrams(data, offsets)
    # words and marks, and pairs of words: The the , a_b !! x  -  a*5  -  é - é é
    assert np.bincount(row, minlength=4).tolist() == [6 + 1, 0, 5 + 4, 4 + 1]
    assert bucket[:2].tolist() == [bucket[0]] * 2 and bucket.max() < importance.BUCKETS
    assert (bucket[row == 2] == importance.UNIGRAMS).sum() == 2  # the pairs that end runs of four
    row, bucket, n = importance.damped(row, bucket)
    assert np.bincount(row, minlength=4).tolist() == [5 + 1, 0, 1 + 2, 2 + 1]
    assert sorted(n[row == 2].tolist()) == [2, 2, 3]  # two and two pairs, five words


def test_classifier_hard_rows(spark, frame):
    labels = spark.createDataFrame([(1, None, 1, "x"), (None, 1, 0, "x"), (4, 1, 0, "x")], "doc_id long, quality int, toxic int, text string")
    for given in (labels, labels.limit(0)):
        assert importance.classified(frame(HARD), given).count() == len(HARD)
        assert importance.accepted(frame(HARD), given).columns == frame(HARD).columns
    assert importance.classified(frame([]), labels).count() == importance.accepted(frame([]), labels).count() == 0
    assert importance.accepted(frame(HARD), labels.limit(0)).count() == len(HARD)


def test_equal_hashes_are_told_apart(monkeypatch):
    real = blocks.token_hashes
    monkeypatch.setattr(blocks, "token_hashes", lambda d, s: (real(d, s)[0] & np.uint64(1), *real(d, s)[1:]))
    data = np.frombuffer(b"aabbaaccbb", np.uint8)
    first, kind = blocks.distinct(data, np.array([0, 2, 4, 6, 8]))
    assert first.tolist() == [0, 1, 3] and kind.tolist() == [0, 1, 0, 2, 1]


def test_stages_keep_the_columns_and_the_last_encodes(spark, frame):
    names = ["doc_id", "text", "lang", "source", "n_chars"]
    docs = frame(HARD).select(names)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SMALL)
        if name != "tokens":
            assert docs.columns == names
            docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert docs.columns[0] == "doc_id"
    empty = frame([]).select(names)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SMALL).count() == 0


def test_run_equals_its_stages(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    texts = {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SMALL).collect(), docs.schema)
        texts[name] = {r["doc_id"]: r["text"] for r in docs.collect()}
    got = {r["doc_id"] for r in corpus_pipeline.run(spark, SMALL).collect()}
    assert got == set(texts["personal_data"])
    base = pii.base_spans
    assert docs.select(base(docs["text"]).alias("s")).filter("size(s) > 0").count() == 0
    assert len(texts["quality"]) > len(texts["near_duplicates"]) >= len(texts["decontamination"]) == len(texts["personal_data"])


def test_extra_columns_come_back_as_they_were(spark):
    text = ["a clean text with words", "write to a@b.co please", None]
    names = ["h", "key", "places", "clean", "d", "dh", "one", "kept_h", "leak_hash", "noise", "rank", "bucket"]
    kinds = "doc_id long, text string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    docs = spark.createDataFrame([(i, t, 1, *[f"{n}{i}" for n in names]) for i, t in enumerate(text)], kinds)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, SMALL)
        assert out.columns == docs.columns, name
        for row in out.collect():
            assert [row[n] for n in names] == [f"{n}{row['doc_id']}" for n in names], name
