import hashlib
import random

import plain
from plain import HARD

from haulmark.llm import pii

PARTS = [
    "a@b.co", "a@b", "x.y@z-1.example.com.", "@", ".", "+", "-", " ", "1.2.3.4", "256.1.1.1", "001.2.03.255", "4111 1111 1111 1111",
    "4111-1111-1111-1112", "79927398713", "5500005555555559", "+1 (017) 555-7713", "+49.30.1234567890123", "12", "7", "word", "é", "😀", "\n", "_@_", "1 2 3",
]


def texts():
    rng = random.Random(5)
    fixed = ["a@b.c@d.e", "a@b.com_x@y.z", "1.2.3.4.5.6.7.8", "1" * 40, "+1+1+1234567890", "a" * 3000, "a." * 2000 + "@b.c", "9 " * 300]
    return fixed + ["".join(rng.choice(PARTS) for _ in range(rng.randint(1, 25))) for _ in range(400)]


def test_base_spans_match_the_published_patterns(frame):
    rows = list(enumerate(texts())) + [(None, None), (5000, "")]
    found = pii.spans(frame(rows)).select("doc_id", "base").collect()
    want = {i: plain.pii(t) for i, t in rows}
    assert {r["doc_id"]: [tuple(s) for s in r["base"]] for r in found} == want
    assert len(found) == len(rows)


def test_contexts_of_known_entities_find_new_identifiers(frame):
    rows = [(i, f"please write. contact mail: user{i}@site{i}.org today the value {i}00 stays") for i in range(5)]
    rows += [(10, "so then contact mail: user-at-site-77 today"), (11, "elsewhere user-at-site-77 shows up"), (12, "the value 12345 stays")]
    found = {r["doc_id"]: (r["base"], r["found"]) for r in pii.spans(frame(rows)).collect()}
    text = dict(rows)
    assert [text[10][s["start"] : s["end"]] for s in found[10][1]] == ["user-at-site-77"]
    assert [text[11][s["start"] : s["end"]] for s in found[11][1]] == ["user-at-site-77"]
    assert found[12] == ([], [])
    assert [len(found[i][0]) for i in range(5)] == [1] * 5


def planted():
    """Cues of one word, two words, a word after, a text's start; names, letters and numbers in their slots; and free text."""
    rng = random.Random(8)
    free = ["river", "stone", "walks", "over", "green", "hill", "cloud", "bridge", "market", "winter", "4711", "0815-x"]

    def some(n):
        return " ".join(rng.choice(free) for _ in range(n))

    def case(slot, cue, after=""):
        return f"{some(rng.randint(1, 9))} {cue} {slot}{after} {some(rng.randint(1, 5))}"

    def name():
        return "".join(rng.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(9))

    seeds = [case(f"{name()}@b{i}.org", "Email:") for i in range(20)] + [case(f"+1 (017) 555-{1000 + i}", "call me") for i in range(9)]
    seeds += [f"login {name()}@c.org, {some(4)}" for _ in range(9)] + [f"{some(3)} {name()}@d.org replied" for _ in range(9)]
    hidden = [case(name(), "Email:", ",") for _ in range(12)] + [case(f"123-45-{6000 + i}", "call me") for i in range(5)]
    hidden += [f"login {name().title()} {some(4)}" for _ in range(6)] + [f"{some(3)} {name()} replied" for _ in range(5)]
    clean = [some(rng.randint(5, 60)) for _ in range(60)]
    return seeds, hidden, clean


def test_contexts_of_every_kind_find_what_was_planted(frame):
    seeds, hidden, clean = planted()
    found = {r["doc_id"]: r["found"] for r in pii.spans(frame(list(enumerate(seeds + hidden + clean)))).collect()}
    assert all(len(found[len(seeds) + i]) == 1 for i in range(len(hidden)))
    assert not any(found[len(seeds) + len(hidden) + i] for i in range(len(clean)))


def test_bootstrapping_equals_a_plain_version(frame):
    seeds, hidden, clean = planted()
    again = [f"{h} {c}" for h, c in zip(hidden[::4], clean, strict=False)] + ["İx \ue000 a@b.co 1.2.3.4@x.y call me  (Anna)\n\tİx call me anna"]
    texts = seeds + hidden + clean + again + [t for _, t in HARD if t] + ["", "Email: ab", "Email: ab"]
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["found"]] for r in pii.spans(frame(list(enumerate(texts)))).collect()}
    want = plain.found_pii(texts)
    assert sum(map(len, want)) > 30
    assert found == dict(enumerate(want))


def test_what_passes_the_filter_by_mistake_changes_nothing(frame, monkeypatch):
    monkeypatch.setattr(pii, "FILTER", 1)
    monkeypatch.setattr(pii, "BLOCK", 2)
    seeds, hidden, clean = planted()
    texts = seeds + hidden + clean + ["call me  (Anna)\n\tİx call me anna", "", "anna"]
    found = {r["doc_id"]: [(s["start"], s["end"]) for s in r["found"]] for r in pii.spans(frame(list(enumerate(texts)))).collect()}
    assert found == dict(enumerate(plain.found_pii(texts)))


def test_common_words_in_trusted_slots_do_not_become_rows(frame, monkeypatch):
    rows = []

    def stored(df, name, write=pii.stored):
        out = write(df, name)
        rows.append(0 if name == "pii-scan" else out.count())
        return out

    monkeypatch.setattr(pii, "stored", stored)
    texts = [f"please contact mail: user{i}@site{i}.org today" for i in range(30)] + ["so contact mail: the-user-77 now", "so contact mail: the river"]
    texts += [f"a{i} the b{i} and the c{i} over the d{i}" for i in range(400)]
    found = {r["doc_id"]: r["found"] for r in pii.spans(frame(list(enumerate(texts)))).collect()}
    assert [i for i, places in found.items() if places] == [30]
    assert sum(rows) < 1000


def test_hard_rows(frame):
    found = pii.spans(frame(HARD)).collect()
    assert len(found) == len(HARD)
    assert pii.spans(frame([])).count() == 0


def test_redaction_replaces_spans_and_keeps_the_rest(frame):
    docs = frame([(1, "write a@b.co or +1 (017) 555-7713!"), (1, "write a@b.co or +1 (017) 555-7713!"), (2, "nothing"), (None, None)])
    found = pii.redacted(docs)
    assert found.columns == docs.columns
    got = sorted((r["doc_id"] or -1, r["text"] or "", r["n_chars"] or 0) for r in found.collect())
    clean = "write [EMAIL] or [PHONE]!"
    assert got == [(-1, "", 0), (1, clean, len(clean)), (1, clean, len(clean)), (2, "nothing", 7)]


def test_digest_is_of_the_listed_spans(spark):
    from haulmark.llm import queries

    row = queries.op10_pii(spark, "/root/testdata/sf0.001").filter("spans <> ''").first()
    assert row["base_sha256"] == hashlib.sha256(row["spans"].encode()).hexdigest()
