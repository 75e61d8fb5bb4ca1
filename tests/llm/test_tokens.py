import hashlib
import io
import random
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from plain import HARD
from tokenizers import Tokenizer

from haulmark.llm import bpe, token_counts, token_files

ODD = [
    "", "  a  b ", " ", "   ", "It's I'LL <|endoftext|>x <|startoftext|> y İstanbul ΣΑΣ 日本語 \x1c a\x85b\xa0c ½ 1234 ??!! don't",
    "a" * 3000 + "Σ", "naïve café", "▁x  ▁", "ab\n\n  cd   ef\t \ng", "<s> </s> <unk>", "\U0001f600\U0001f600 x", "\x00\x01",
]


@pytest.fixture(scope="module")
def texts(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    rows = [(r["doc_id"], r["text"]) for r in rows] + [(10_000 + i, t) for i, t in enumerate(ODD)] + HARD
    return rows


def test_counts_equal_the_library(frame, texts):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    want = sorted(((i, len((t or "").encode()), len(sp.encode(t or ""))) for i, t in texts), key=repr)
    for heavy in (token_counts.HEAVY, 50, 0):
        got = token_counts.token_counts(frame(texts), heavy=heavy).collect()
        assert sorted(map(tuple, got), key=repr) == want
    assert token_counts.token_counts(frame([])).count() == 0


def test_counts_of_texts_with_the_sign_for_blanks(frame):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    rng = random.Random(6)
    parts = ["\u2581", " ", "\n", "\u200b", "a", "the", "\u2581 ", "\u2580", "\u3000", "\t", "é", "."]
    rows = [(0, "\u2581 \n\u200ba"), (1, "\u2581"), (2, "\u2581 "), (3, " \u2581 x")]
    rows += [(4 + i, "".join(rng.choice(parts) for _ in range(rng.randint(1, 12)))) for i in range(5000)]
    for heavy in (token_counts.HEAVY, 0):
        got = {r["doc_id"]: r["n_tokens"] for r in token_counts.token_counts(frame(rows), heavy=heavy).collect()}
        assert got == {i: len(sp.encode(t)) for i, t in rows}


def test_files_round_trip(frame, texts):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    got = token_files.round_trip(frame(texts), files=3).collect()
    encoded = {t: np.array([*library.encode(t or "", add_special_tokens=False).ids, 2], "<u4") for _, t in texts}
    want = sorted(((i, len(encoded[t]), zlib.crc32(encoded[t].tobytes())) for i, t in texts), key=repr)
    assert sorted(((r["doc_id"], r["n_tokens"], r["ids_crc32"]) for r in got), key=repr) == want
    got.sort(key=lambda r: r["start"])
    assert [r["start"] for r in got] == [sum(r["n_tokens"] for r in got[:k]) for k in range(len(got))]
    order = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert order == sorted(order)
    assert token_files.round_trip(frame([]), files=3).count() == 0


def test_files_hold_texts_with_a_million_blanks(frame):
    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    rows = [(1, "ab cd\n" + " " * 1_050_000 + "x"), (2, "\n" * 1_200_000), (3, "short")]
    got = {r["doc_id"]: (r["n_tokens"], r["ids_crc32"]) for r in token_files.round_trip(frame(rows), files=2).collect()}
    for i, t in rows:
        ids = np.array([*library.encode(t, add_special_tokens=False).ids, 2], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes()))


class Source(io.BytesIO):
    def size(self):
        return len(self.getvalue())


def test_blocks_and_random_access():
    rng = np.random.default_rng(1)
    docs = [rng.integers(0, 50_257, n).astype(np.uint32) for n in (0, 1, 4095, 4096, 9000, 3)]
    docs += [np.array([0, 2**32 - 1, 7] * 3000, np.uint32), np.full(5000, 9, np.uint32)]
    out = io.BytesIO()
    writer = token_files.Writer(out)
    for i, ids in enumerate(docs):
        writer.add(None if i == 0 else i, ids)
    writer.close()
    reader = token_files.Reader(Source(out.getvalue()))
    flat = np.concatenate(docs)
    assert reader.n == len(flat)
    for first, n in ((0, 1), (4095, 2), (100, 15_000), (len(flat) - 1, 1)):
        assert np.array_equal(np.concatenate(list(reader.tokens(first, n))), flat[first : first + n])
    for (doc_id, n, parts), ids in zip(reader.documents(), docs, strict=True):
        assert n == len(ids) and np.array_equal(np.concatenate([np.zeros(0, np.uint32), *parts]), ids)
    with pytest.raises(ValueError, match="not a token file"):
        token_files.Reader(Source(out.getvalue()[:-1] + b"x"))


def test_few_exceptions_leave_the_block_narrow():
    ids = np.full(4096, 100, np.uint32)
    ids[::500] = 50_000
    assert len(token_files.pack(ids)) < 1000 and np.array_equal(token_files.unpack(token_files.pack(ids)), ids)


def test_encoding_equals_the_library(frame, texts):
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = []
    for i, t in texts:
        ids = library.encode(t or "", add_special_tokens=False).ids
        raw, back = np.array(ids, "<u4").tobytes(), library.decode(ids, skip_special_tokens=False)
        want.append((i, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256(back.encode()).hexdigest()))
    got = bpe.encode_documents(frame(texts)).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(want, key=repr)
    assert bpe.encode_documents(frame([])).count() == 0


def test_whole_output_holds_ids_and_text(frame):
    row = bpe.encode_documents(frame([(1, "Hello there <|endoftext|>")]), whole=True).first()
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    assert row["ids"] == library.encode("Hello there <|endoftext|>", add_special_tokens=False).ids
    path = public_tokenizers.path("word_bpe_49k.json")
    assert row["decoded"] == library.decode(row["ids"], skip_special_tokens=False) == bpe.decoded(path, np.array(row["ids"]))


def test_merge_order_of_ties_and_long_words():
    table = bpe.merges(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = ["a", "aa", "aaa", "aaaaaaa", "abababab", "th" * 700, "zzzzzzzzz", "hellohellohello"]
    assert table.encode([w.encode() for w in words]) == [library.encode(w, add_special_tokens=False).ids for w in words]


def test_many_short_documents_take_linear_time():
    import io

    import numpy as np

    from haulmark.llm.token_files import Writer

    began, out = time.perf_counter(), io.BytesIO()
    writer = Writer(out)
    for i in range(300_000):
        writer.add(i, np.array([2], np.uint32))
    writer.close()
    assert time.perf_counter() - began < 30
    assert writer.n == 300_000


def test_long_words(monkeypatch):
    rng = random.Random(4)
    table = bpe.merges(public_tokenizers.path("word_bpe_49k.json"))
    library = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    words = ["a" * n for n in (2, 3, 7, 4097)] + ["".join(rng.choice(c) for _ in range(n)) for c in ("ab", "theanrsi", "aé") for n in (3, 50, 9000)]
    want = [library.encode(w, add_special_tokens=False).ids for w in words]
    assert table.encode([w.encode() for w in words]) == want
    monkeypatch.setattr(bpe, "LONG", 1)
    assert table.encode([w.encode() for w in words]) == want
    table.alone[:] = True
    try:
        assert table.encode([w.encode() for w in words[:6]]) == want[:6]
    finally:
        bpe.merges.cache_clear()


def test_word_of_two_million_letters():
    rng = random.Random(5)
    word = "".join(rng.choices("etaoinshrdlu", k=2_000_000))
    table = bpe.merges(public_tokenizers.path("word_bpe_49k.json"))
    began = time.monotonic()
    ids = table.encode([word.encode()])[0]
    assert time.monotonic() - began < 60
    assert b"".join(table.names[i].removesuffix(table.end).encode() for i in ids).decode() == word
