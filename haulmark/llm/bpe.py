"""Byte-pair encoding with segment trees, for many words at once, and decoding.

The leaves of a word's tree hold the ranks of its adjacent pairs, an inner node
the least rank below it. The root tells whether a merge is left; going down to
the left child on ties finds the leftmost pair of that rank. A merge changes
three leaves and the nodes above them. Words of like length are rows of one
array, so each step runs for all of them together. In a word of more than LONG
bytes all places of the least rank that do not touch are merged in one step.

Distinct words of a block of texts are encoded once. Missing and empty texts
have no ids; missing ids stay missing; repeated rows are encoded each; an empty
table gives an empty result.
"""

from __future__ import annotations

import hashlib
import json
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import public_tokenizers
from pyspark.sql import DataFrame

from haulmark.llm import blocks
from haulmark.llm.tables import texts_of
from haulmark.llm.token_files import LATIN, byte_letters

NONE = np.int32(2**31 - 1)
ROWS = 1 << 19  # leaves of the trees held at once
LONG = 2048


class Merges:
    """Vocabulary and merge ranks of a word-level BPE whose last symbol carries an end mark."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            whole = json.load(f)
        model = whole["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in whole["added_tokens"]}
        self.names = {i: piece for piece, i in (self.vocab | self.special).items()}
        letters = byte_letters()
        self.inner = np.array([self.vocab[letters[b]] for b in range(256)], np.int32)
        self.last = np.array([self.vocab[letters[b] + self.end] for b in range(256)], np.int32)
        pairs = [(self.vocab[a] << 17 | self.vocab[b], rank, self.vocab[a + b]) for rank, (a, b) in enumerate(model["merges"])]
        pairs.sort()
        self.keys, self.ranks, made = (np.array(c) for c in zip(*pairs, strict=True))
        self.made = np.empty(len(pairs), np.int32)
        self.made[self.ranks] = made
        self.ranks = self.ranks.astype(np.int32)
        lowest = np.full(int(self.made.max()) + 1, NONE)  # least rank of a pair that holds the symbol
        for side in (self.keys >> 17, self.keys & ((1 << 17) - 1)):
            held = side < len(lowest)
            np.minimum.at(lowest, side[held], self.ranks[held])
        self.alone = lowest[self.made] < np.arange(len(self.made))  # a merge of this rank may make way for a lower one

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a.astype(np.int64) << 17 | b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], NONE)

    def encode_rows(self, symbols: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Symbols of words, one word a row; returns the rows after all merges and which places are left."""
        rows, most = symbols.shape
        leaves = 1 << max(0, (most - 2).bit_length())
        place = np.arange(most, dtype=np.int32)
        after = np.broadcast_to(place + 1, (rows, most)).copy()
        before = np.broadcast_to(place - 1, (rows, most)).copy()
        left = place < lengths[:, None]
        tree = np.full((rows, 2 * leaves), NONE, np.int32)
        if most > 1:
            pairs = self.rank(symbols[:, :-1], symbols[:, 1:])
            pairs[place[1:] >= lengths[:, None]] = NONE
            tree[:, leaves : leaves + most - 1] = pairs
        level = leaves
        while level > 1:
            np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2], out=tree[:, level // 2 : level])
            level //= 2
        busy = np.flatnonzero(tree[:, 1] != NONE)
        while len(busy):
            best, node = tree[busy, 1], np.ones(len(busy), np.int64)
            while node[0] < leaves:
                node = 2 * node
                node += tree[busy, node] != best
            i = node - leaves
            j = after[busy, i]
            k = after[busy, j]
            symbols[busy, i] = self.made[best]
            left[busy, j] = False
            after[busy, i] = k
            more = k < lengths[busy]
            ahead = busy[more]
            before[ahead, k[more]] = i[more]
            began = j < leaves  # the pair that began at j is gone
            tree[busy[began], leaves + j[began]] = NONE
            fresh = np.full(len(busy), NONE, np.int32)
            fresh[more] = self.rank(symbols[ahead, i[more]], symbols[ahead, k[more]])
            tree[busy, leaves + i] = fresh
            p = before[busy, i]
            has = p >= 0
            behind = busy[has]
            tree[behind, leaves + p[has]] = self.rank(symbols[behind, p[has]], symbols[behind, i[has]])
            row = np.concatenate([busy, busy[began], behind])
            node = np.concatenate([i, j[began], p[has]]).astype(np.int64) + leaves
            while node[0] > 1:
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
            busy = busy[tree[busy, 1] != NONE]
        return symbols, left

    def encode_long(self, symbols: np.ndarray) -> np.ndarray:
        """Symbols of one word of two or more after all merges."""
        n = len(symbols)
        leaves = 1 << (n - 2).bit_length()
        tree = np.full(2 * leaves, NONE, np.int32)
        tree[leaves : leaves + n - 1] = self.rank(symbols[:-1], symbols[1:])
        level = leaves
        while level > 1:
            np.minimum(tree[level : 2 * level : 2], tree[level + 1 : 2 * level : 2], out=tree[level // 2 : level])
            level //= 2
        after, before, left = np.arange(1, n + 1, dtype=np.int32), np.arange(-1, n - 1, dtype=np.int32), np.ones(n, bool)
        while tree[1] != NONE:
            best, node = tree[1], np.ones(1, np.int64)
            while node[0] < leaves:
                node = (2 * node[:, None] + np.arange(2)).ravel()
                node = node[tree[node] == best]
            i = node[:1] - leaves if self.alone[best] else node - leaves
            # of places that touch, every second one from the left is merged
            number = np.arange(len(i))
            first = np.append(True, after[i[:-1]] != i[1:])
            i = i[(number - np.maximum.accumulate(np.where(first, number, 0))) % 2 == 0]
            j = after[i]
            k = after[j]
            symbols[i], left[j], after[i] = self.made[best], False, k
            more = k < n
            before[k[more]] = i[more]
            fresh = np.full(len(i), NONE, np.int32)
            fresh[more] = self.rank(symbols[i[more]], symbols[k[more]])
            began = j[j < leaves]  # the pairs that began there are gone
            tree[leaves + began] = NONE
            tree[leaves + i] = fresh
            p = before[i]
            has = p >= 0
            tree[leaves + p[has]] = self.rank(symbols[p[has]], symbols[i[has]])
            node = np.sort(np.concatenate([i, began, p[has]]).astype(np.int64) + leaves)
            while node[0] > 1:
                node >>= 1
                node = node[np.append(True, node[1:] != node[:-1])]
                tree[node] = np.minimum(tree[2 * node], tree[2 * node + 1])
        return symbols[left]

    def encode(self, words: list[bytes]) -> list[list[int]]:
        """Ids of each word."""
        out: list[list[int]] = [[]] * len(words)
        sizes = np.array([len(w) for w in words], np.int64)
        for k in np.flatnonzero(sizes > LONG).tolist():
            text = np.frombuffer(words[k], np.uint8)
            out[k] = self.encode_long(np.append(self.inner[text[:-1]], self.last[text[-1]])).tolist()
        sizes[sizes > LONG] = 0
        classes = np.array([max(0, int(n) - 2).bit_length() for n in sizes])
        for c in np.unique(classes):
            members = np.flatnonzero((classes == c) & (sizes > 0))
            step = max(1, ROWS >> int(c))
            for at in range(0, len(members), step):
                part = members[at : at + step]
                lengths = sizes[part].astype(np.int32)
                most = int(lengths.max()) if len(part) else 0
                if not most:
                    continue
                text = np.zeros((len(part), most), np.uint8)
                text[np.arange(most) < lengths[:, None]] = np.frombuffer(b"".join(words[k] for k in part), np.uint8)
                symbols = self.inner[text]
                rows = np.arange(len(part))
                symbols[rows, lengths - 1] = self.last[text[rows, lengths - 1]]
                symbols, left = self.encode_rows(symbols, lengths)
                flat, ends = symbols[left].tolist(), np.cumsum(left.sum(1)).tolist()
                for k, a, b in zip(part.tolist(), [0, *ends], ends, strict=False):
                    out[k] = flat[a:b]
        return out


@lru_cache(maxsize=2)
def merges(path: str) -> Merges:
    return Merges(path)


# The tokenizer's word pattern. Below LATIN its blanks are these.
WORD = r"'s|'t|'re|'ve|'m|'ll|'d|\p{L}+|\p{N}|[^\t-\r \x85\xa0\p{L}\p{N}]+"


class Words:
    """Cuts texts into words as the tokenizer's normalizer and pre-tokenizer do."""

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.find = regex.compile(WORD).findall
        self.library = Tokenizer.from_file(path)
        self.bytes = {c: b for b, c in byte_letters().items()}
        self.special = merges(path).special
        self.marks = re.compile("(" + "|".join(map(re.escape, self.special)) + ")")

    def plain(self, text: str) -> list[bytes]:
        if text and ord(max(text)) >= LATIN:
            text = self.library.normalizer.normalize_str(text)
            return [bytes(map(self.bytes.__getitem__, w)) for w, _ in self.library.pre_tokenizer.pre_tokenize_str(text)]
        return [w.encode() for w in self.find(text.lower())]

    def of(self, text: str) -> list[bytes | int]:
        """Words as UTF-8; special strings as their ids."""
        if "<|" not in text:
            return self.plain(text)
        out: list[bytes | int] = []
        for i, part in enumerate(self.marks.split(text)):
            out += [self.special[part]] if i % 2 else self.plain(part)
        return out


@lru_cache(maxsize=2)
def cutter(path: str) -> Words:
    return Words(path)


def encoded(path: str, texts: list[str]) -> Iterator[tuple[bytes, str]]:
    """Ids as little-endian u32 and the decoded text, for each text."""
    table, cut, kinds = merges(path), cutter(path), {}
    docs = [[kinds.setdefault(w, len(kinds)) for w in cut.of(t)] for t in texts]
    plain = [w for w in kinds if isinstance(w, bytes)]
    ids = dict(zip(plain, table.encode(plain), strict=True))
    each = [ids[w] if isinstance(w, bytes) else [w] for w in kinds]
    raw = [struct.pack(f"<{len(x)}I", *x) for x in each]
    # the vocabulary file names no decoder: decoding joins the pieces by blanks
    names = [" ".join([table.names[i] for i in x]) for x in each]
    for doc in docs:
        yield b"".join([raw[k] for k in doc]), " ".join([names[k] for k in doc])


def decoded(path: str, ids: np.ndarray) -> str:
    """Text of ids, special ones included."""
    names = merges(path).names
    return " ".join([names[i] for i in ids.tolist() if i in names])


def encode_documents(docs: DataFrame, vocabulary: str = "word_bpe_49k.json", whole: bool = False) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256; with whole also ids (array) and decoded (text)."""
    path = public_tokenizers.path(vocabulary)
    kinds = "doc_id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string"
    kinds += ", ids array<int>, decoded string" if whole else ""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column("text")
            for row, end, _, _ in blocks.blocks(text):
                found = list(encoded(path, text.slice(row, end - row).to_pylist()))
                columns = [
                    batch.column("doc_id").slice(row, end - row),
                    pa.array([len(raw) // 4 for raw, _ in found], pa.int64()),
                    pa.array([hashlib.sha256(raw).hexdigest() for raw, _ in found]),
                    pa.array([hashlib.sha256(text.encode()).hexdigest() for _, text in found]),
                ]
                names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
                if whole:
                    columns.append(pa.array([np.frombuffer(raw, "<u4").astype(np.int32) for raw, _ in found], pa.list_(pa.int32())))
                    columns.append(pa.array([text for _, text in found], pa.string()))
                    names += ["ids", "decoded"]
                yield pa.RecordBatch.from_arrays(columns, names)

    return texts_of(docs).mapInArrow(task, kinds)
