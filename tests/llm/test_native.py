"""Sharding, fingerprints, decontamination."""

import hashlib
import random
import re

import numpy as np
import plain
import pytest
from plain import HARD
from pyspark.sql import functions as F

from haulmark.llm import fingerprints, queries, sharding, templates


def documents(spark):
    return [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()]


def nulls_first(i):
    return -(2**63) if i is None else i


# --- sharding ---------------------------------------------------------------------


def test_shards_are_contiguous_and_even(spark, frame):
    for rows in (documents(spark) + HARD, HARD, [(1, "x")] * 50):
        got = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shards(frame(rows), 7).collect()]
        assert sorted(got, key=repr) == sorted(plain.sharded(rows, 7), key=repr)
        bytes_in = [sum(g[1] for g in got if g[3] == s) for s in range(7)]
        assert max(bytes_in) - min(bytes_in) <= 2 * max(g[1] for g in got)
    assert sharding.shards(frame([]), 7).count() == 0


def test_ranges_of_ids_do_not_change_the_order(frame, monkeypatch):
    from haulmark.llm import tables

    rows = [(i * 37 % 501, "t" * (i % 13)) for i in range(501)]
    whole = tables.numbered
    monkeypatch.setattr(sharding, "numbered", lambda df, order, weight: whole(df, order, weight, per_bucket=20))
    got = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in sharding.shards(frame(rows), 9).collect()]
    assert sorted(got) == plain.sharded(rows, 9)


# --- fingerprints -----------------------------------------------------------------


def edited(rows):
    """Texts with their last quarter replaced, in the order of ids; ties by the hash that Spark uses are left out."""
    rows = sorted(rows, key=lambda r: nulls_first(r[0]))
    out = []
    for (i, t), (_, n) in zip(rows, rows[1:] + rows[:1], strict=True):
        t, n = t or "", n or ""
        cut = len(t) // 4
        out.append((i, len(t), hashlib.sha256((t[: len(t) - cut] + n[:cut]).encode()).hexdigest()))
    return out


def test_edits_take_the_next_document(spark, frame, monkeypatch):
    rows = documents(spark) + [(None, "first of all, without an id"), (9_999, "é😀" * 9)]
    for per_bucket in (2000, 10):
        monkeypatch.setattr(fingerprints.with_next, "__defaults__", (per_bucket,))
        got = fingerprints.document_fingerprints(frame(rows)).collect()
        assert sorted(((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got), key=repr) == sorted(edited(rows), key=repr)
    by_text = {}
    for r in got:
        by_text.setdefault(dict(rows)[r["doc_id"]], set()).add(r["fp"])
    assert all(len(fps) == 1 for fps in by_text.values())


def test_votes_equal_a_plain_count(spark, frame):
    rows = documents(spark)[:40] + [(7_000, "word " * 9000), (7_001, ""), (7_002, "one")]
    got = {r["doc_id"]: r["fp"] for r in fingerprints.fingerprints(frame(rows)).collect()}
    terms = {}
    for i, t in rows:
        words = [w for w in re.split(r"[^\w]|_", t.lower()) if w]
        terms[i] = [" ".join(words[k : k + 2]) for k in range(len(words))]
    every = sorted({x for ts in terms.values() for x in ts})
    hashed = spark.createDataFrame([(x,) for x in every], "term string").select("term", F.xxhash64("term").alias("h")).collect()
    bits = {r["term"]: (np.array([r["h"]], np.int64).view(np.uint64) >> np.arange(64, dtype=np.uint64)) & np.uint64(1) for r in hashed}
    for i, ts in terms.items():
        weight = [min(len(x), 15) for x in ts]
        votes = sum((w * bits[x].astype(np.int64) for x, w in zip(ts, weight, strict=True)), np.zeros(64, np.int64))
        assert got[i] % 2**64 == sum(1 << b for b in range(64) if 2 * votes[b] > sum(weight)), i


def test_block_tables_find_everything_within_the_radius(spark):
    rng = random.Random(4)
    fps = [rng.getrandbits(64) for _ in range(300)]
    fps += [f ^ sum(1 << b for b in rng.sample(range(64), rng.randint(0, 5))) for f in fps[:150]] + [0, 2**64 - 1]
    signed = [f - 2**64 if f >> 63 else f for f in fps]
    asked = signed[::3]
    frame = lambda values: spark.createDataFrame([(v,) for v in values], "fp long")
    got = {(r["query"], r["found"], r["bits"]) for r in fingerprints.within(frame(signed), frame(asked)).collect()}
    gap = lambda a, b: ((a ^ b) % 2**64).bit_count()
    assert got == {(a, b, gap(a, b)) for a in asked for b in signed if gap(a, b) <= 3}


def test_hard_rows(frame):
    got = fingerprints.document_fingerprints(frame(HARD)).collect()
    assert len(got) == len(HARD) and {r["doc_id"] for r in got} == {i for i, _ in HARD}
    assert fingerprints.document_fingerprints(frame([])).count() == 0


# --- decontamination --------------------------------------------------------------


ITEMS = [
    (1, "A train leaves Berlin at 9:30 and travels 120 km to Hamburg in 2.5 hours; how far is it from Berlin after 1 hour?"),
    (2, "Name the river that flows through the old town and is known for its many stone bridges."),
    (3, "Short one here"),
    (4, "Tom has 5 apples and gives 5 to Anna, then Anna has 7 apples and Tom has none left at all."),
    (5, None),
    (None, "An item that has no id but has enough words to fill more than one window of the text"),
]


def contaminated(spark, frame, rows):
    benchmark = spark.createDataFrame([(i, t, "extra") for i, t in ITEMS], "item_id long, text string, words string")
    found = templates.contaminations(frame(rows), benchmark)
    return {(r["doc_id"], r["item_id"]): r for r in found.collect()}


def test_copies_new_slots_and_inconsistent_slots(spark, frame):
    fill = "some words stand before the passage and others after it to make a longer document "
    rows = [
        (10, fill + ITEMS[0][1] + " " + fill),
        (11, fill + "A train leaves Paris at 7:15 and travels 300 miles to Lyon in 4 hours; how far is it from Paris after 2 hours? " + fill),
        (12, fill + "Tom has 8 apples and gives 8 to Lisa, then Lisa has 9 apples and Tom has none left at all. " + fill),
        (13, fill + "Tom has 8 apples and gives 3 to Lisa, then Lisa has 9 apples and Tom has none left at all. " + fill),
        (14, fill * 3), (15, "just a Short one here too"), (18, "a short one here"), (16, ITEMS[1][1].upper()), (None, ITEMS[5][1]), (17, None),
    ]
    got = contaminated(spark, frame, rows)
    assert {k: r["leaked"] for k, r in got.items()} == {
        (10, 1): True, (11, 1): True, (12, 4): True, (13, 4): False, (15, 3): True, (18, 3): True, (16, 2): True, (None, None): True,
    }
    assert got[(10, 1)]["n_changed"] == 0 and got[(11, 1)]["n_changed"] > 3


def test_names_at_the_start_of_sentences(spark, frame):
    items = [(1, "Tom has 5 apples. Tom gives 2 to Ann. How many apples does Tom have?"), (2, "Every week a man walks 3 miles. He rests. Then he goes on.")]
    rows = [
        (1, "Mia has 7 apples. Mia gives 3 to Bob. How many apples does Mia have?"),
        (2, "Now think: Mia has 7 apples. Mia gives 3 to Bob, how many apples does Mia have?"),
        (3, "mia has 7 apples. tom gives 3 to Bob. How many pears does Mia have?"),
        (4, "Mia has 7 apples. Zoe gives 3 to Bob. How many apples does Mia have?"),
        (7, "Some say: every week a man walks 4 miles. he rests. Then he goes on."),
    ]
    found = templates.contaminations(frame(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert {(r["doc_id"], r["item_id"]) for r in found if r["leaked"]} == {(1, 1), (2, 1), (7, 2)}


def test_every_alignment_is_checked(spark, frame):
    item = "Every day Tom pays 5 dollars and 5 cents for a cup of tea"
    other = item.replace("5 dollars", "3 dollars").replace("5 cents", "7 cents")
    broken = "Every day Tom pays 5 dollars and then, all of a sudden, 5 cents for a cup of tea"
    rows = [(1, f"{other}. {item}."), (2, f"{item}. {other}."), (3, f"{other}. " * 40), (4, f"{other}. " * 40 + item), (5, broken)]
    found = templates.contaminations(frame(rows), spark.createDataFrame([(1, item)], "item_id long, text string")).collect()
    assert {r["doc_id"]: r["leaked"] for r in found} == {1: True, 2: True, 3: False, 4: True}
    assert {r["doc_id"]: (r["n_changed"], r["coverage"]) for r in found if r["leaked"]} == {1: (0, 1.0), 2: (0, 1.0), 4: (0, 1.0)}


def test_decontamination_drops_documents_that_hold_an_item(spark, frame):
    benchmark = spark.createDataFrame(ITEMS, "item_id long, text string")
    docs = frame([(1, ITEMS[0][1]), (1, "clean text of the same id"), (2, ITEMS[1][1]), (2, ITEMS[1][1]), (None, None), (3, "")])
    kept = templates.decontaminated(docs, benchmark)
    assert kept.columns == docs.columns
    assert sorted(((r["doc_id"], r["text"]) for r in kept.collect()), key=repr) == [(1, "clean text of the same id"), (3, ""), (None, None)]
    assert templates.decontaminated(docs, benchmark.limit(0)).count() == 6
    assert templates.decontaminated(docs.limit(0), benchmark).count() == 0


def test_planted_passages_are_found(spark):
    """Every document that holds a whole item, as plain text, is reported; items and documents as given."""
    folder = "/root/testdata/sf0.001"
    found = {(r["doc_id"], r["item_id"]) for r in queries.op6_templates(spark, folder).filter("leaked").collect()}
    items = spark.read.parquet(f"{folder}/benchmark.parquet").collect()
    holds = {(i, b["item_id"]) for i, t in documents(spark) for b in items if b["text"] in t}
    assert holds and holds <= found


def test_items_without_plain_words_are_compared_verbatim(spark, frame):
    items = spark.createDataFrame([(1, "42"), (2, "Paris"), (3, "3 km"), (4, "1 2 3 4 5 6 7 8 9")], "item_id bigint, text string")
    docs = [(1, "There are 17 of them in Rome."), (2, "We went 5 km and saw 12 34 56 78 90 11 12 13 14 birds."), (3, "The answer is 42."),
            (4, "They met in paris, they say."), (5, "It is 3 km away."), (6, "x 1 2 3 4 5 6 7 8 9 y"), (7, "")]
    found = templates.contaminations(frame(docs), items).filter("leaked").select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found)) == [(3, 1), (4, 2), (5, 3), (6, 4)]
    kept = templates.decontaminated(frame(docs), items).select("doc_id").collect()
    assert sorted(r[0] for r in kept) == [1, 2, 7]


def test_the_word_filter_loses_no_window(spark, frame):
    """Runs of known words hold every window of the items, wherever it stands in a text."""
    item = "Tom buys seven green apples and gives nine of them to Ann every day"
    items = spark.createDataFrame([(1, item), (2, "a short one here")], "item_id bigint, text string")
    docs = [(1, item), (2, "zzz " * 50 + item), (3, item + " zzz" * 50), (4, f"zzz {item} zzz a short one here zzz"),
            (5, "zzz " * 20), (6, "Ann buys seven zzz green apples and zzz gives nine of them zzz to Tom"), (7, "one here a short")]
    found = templates.contaminations(frame(docs), items).filter("leaked").select("doc_id", "item_id").collect()
    assert sorted(map(tuple, found)) == [(1, 1), (2, 1), (3, 1), (4, 1), (4, 2)]


def test_a_very_long_text(spark, frame):
    item = "Tom buys seven green apples and gives nine of them to Ann every day"
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    docs = [(1, "some other words stand in this text. " * 300_000 + item), (2, "some other words. " * 300_000)]
    found = templates.contaminations(frame(docs), items).filter("leaked").select("doc_id").collect()
    assert [r[0] for r in found] == [1]


def generated(df):
    """The most rows that one Generate of the plan made."""
    df.collect()
    plans, made = [df._jdf.queryExecution().executedPlan()], [0]
    while plans:
        plan = plans.pop()
        if plan.nodeName() == "Generate":
            made.append(plan.metrics().get("numOutputRows").get().value())
        plans += [plan.children().apply(i) for i in range(plan.children().size())]
    return max(made)


def test_readings_that_no_item_has_make_no_rows(spark, frame):
    """Eight words that may all be names have 256 readings; only those of a window of the items become rows."""
    names = ["Tom", "Ann", "Bob", "Eve", "Kim", "Leo", "Max", "Zoe"]
    question = "They bought seven green apples and gave nine of them away every day"
    item = "we know that tom and ann and bob met eve and kim and leo and max and zoe. Tom. Ann. Bob. " + question
    items = spark.createDataFrame([(1, item)], "item_id bigint, text string")
    held = ". ".join(names * 40)
    docs = [(i, held) for i in range(20)] + [(20, f"{held}. {item}"), (21, f"{held}. Tom. Ann. Bob. {question}"), (22, f"Mia. Ida. Ugo. {question}"), (23, None)]
    found = templates.contaminations(frame(docs), items).filter("leaked").select("doc_id").collect()
    assert sorted(r[0] for r in found) == [20]
    spark.conf.set("spark.sql.adaptive.enabled", "false")  # the plan that ran, with its counts
    try:
        hits = templates.hits(frame(docs), templates.items_of(items))
        assert 0 < generated(hits) < 22 * 330  # places, not readings
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_the_window_filter_loses_no_hit(spark, frame, monkeypatch):
    items = [(1, ITEMS[0][1]), (2, ITEMS[3][1]), (3, "Tom. Ann. Bob. Eve. Kim. Leo. Max. Zoe. Tom. Who was not there?"), (4, "Short one here"), (5, "42")]
    docs = [(i, f"Yes. {t} Mia. Tom. Zoe. Ann. Bob. Eve. Kim. Leo. Max. Tom. {t.lower()}") for i, t in items] + [(9, items[2][1].replace("Tom", "Ida"))]
    items = templates.items_of(spark.createDataFrame(items, "item_id bigint, text string"))
    got = sorted(map(tuple, templates.hits(frame(docs), items).collect()))
    monkeypatch.setattr(templates, "window_filter", lambda wanted: None)
    assert got and got == sorted(map(tuple, templates.hits(frame(docs), items).collect()))


def test_importance_counts_stay_in_tasks(spark, monkeypatch):
    from pyspark.sql.classic.dataframe import DataFrame

    from haulmark.llm import importance

    docs = spark.createDataFrame([(i, "alpha beta gamma" if i % 2 else "buy now cheap") for i in range(400)], "doc_id long, text string")
    monkeypatch.setattr(DataFrame, "toArrow", lambda self: pytest.fail("counts were collected"))
    odd = np.arange(1, 400, 2)
    ratios = importance.log_ratios(docs, odd, np.arange(0, 400, 2))
    assert ratios.shape == (importance.BUCKETS,) and ratios.dtype == np.float32
    assert ratios.min() < -importance.EFFECT and ratios.max() == 0
