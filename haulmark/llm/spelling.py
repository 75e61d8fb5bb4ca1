"""Spelling variants: words one edit apart, found in k-d trees over their letter counts.

One inserted or deleted letter moves a word's vector of letter counts by one,
one replaced letter by one up and one down, so the words near to a word lie
within an L1 distance of two. For every length a k-d tree over a bounded sample
cuts the words into shards. A word visits the shards of its own length and of
the next one whose boxes lie within that distance; inside a shard a tree of the
shard's own words is searched in the same way. What is left is compared by
packed counts and then letter by letter.

Every word is looked up. The sample only shapes the trees; a shard that turns
out larger than wanted, because many words have equal counts, is dealt out in
parts that are each visited. A shard returns one row per word with the number
of near words and the best of them, not the pairs.

Words are maximal runs of the letters A-Z, a-z and U+00C0 to U+00FF, with A-Z in
lower case. A missing text has none; a missing id reads as nothing before the
colon of the hash; repeated rows count each; an empty table gives an empty
result; other columns are ignored. Words of any length are compared as a whole.
Of equally frequent forms the least in code-point order is taken.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from haulmark.llm.blocks import column_bytes
from haulmark.llm.tables import hash_sample, stored

RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")  # over UTF-8
LONG = 4 << 20  # longer texts are cut into words step by step
HELD = 200_000  # distinct words that a task holds before it passes them on
SAMPLE = 131_072  # words that shape the shared trees
SHARD = 8192  # words wanted in a shard
LEAF = 12
AT_ONCE = 1 << 20  # candidates compared together
LETTERS = 26 + 64
ANY, SPENT = -1, -2  # a step that may still be made, a step that may not


# Words and their counts


def add_words(totals: Counter, doc_id: int | None, runs: Counter, shortest: int, every: int) -> None:
    """Add the runs of one document; where `every` divides the hash of one, a letter of it is left out."""
    start = zlib.crc32(f"{'' if doc_id is None else doc_id}:".encode())
    for run, n in runs.items():
        size = len(run)
        if size < shortest:
            continue
        if every and (h := zlib.crc32(run, start)) % every == 0:
            letters = run.decode()
            at = h % len(letters)
            run = (letters[:at] + letters[at + 1 :]).encode()
            size = len(run)
        # a letter has two bytes at most
        if size >= 2 * shortest or size - run.count(b"\xc3") >= shortest:
            totals[run] += n


def word_counts(docs: DataFrame, shortest: int = 5, least: int = 3, every: int = 0) -> DataFrame:
    """word, n of all words of at least `shortest` code points and `least` occurrences."""

    def batch_of(totals: Counter) -> pa.RecordBatch:
        words = [w.decode() for w in totals]
        columns = [pa.array(words, pa.string()), pa.array(totals.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(columns, ["word", "n"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: Counter = Counter()
        for batch in batches:
            data, offsets = column_bytes(batch.column("text"))
            for doc_id, a, b in zip(batch.column("doc_id").to_pylist(), offsets, offsets[1:], strict=False):
                text = data[a:b].tobytes().lower()  # of bytes: only A-Z
                if len(text) <= LONG:
                    runs = Counter(RUN.findall(text))
                else:
                    runs, found = Counter(), (m.group() for m in RUN.finditer(text))
                    while part := list(islice(found, HELD)):
                        runs.update(part)
                add_words(totals, doc_id, runs, shortest, every)
                if len(totals) >= HELD:
                    yield batch_of(totals)
                    totals.clear()
        yield batch_of(totals)

    texts = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    counted = texts.mapInArrow(task, "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


# Vectors and trees


def codes(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Letters of the words, which are Latin-1, end to end, and where each word starts."""
    flat = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return flat, np.concatenate([[0], np.cumsum([len(w) for w in words], dtype=np.int64)])


def vectors(words: list[str]) -> np.ndarray:
    """Letter counts, a row per word."""
    flat, starts = codes(words)
    letter = np.where(flat < 128, flat.astype(np.int64) - 97, flat.astype(np.int64) - 166)
    row = np.repeat(np.arange(len(words)), np.diff(starts))
    return np.bincount(row * LETTERS + letter, minlength=len(words) * LETTERS).reshape(-1, LETTERS).astype(np.int32)


def packed(counts: np.ndarray) -> np.ndarray:
    """Two bits a letter, 00, 01 or 11 for none, one and more; letters share the 64 places. Differing bits never exceed L1."""
    slots = counts[:, :64].copy()
    slots[:, : LETTERS - 64] += counts[:, 64:]
    bits = np.stack([slots >= 1, slots >= 2], 2).reshape(len(counts), -1)
    return np.packbits(bits, axis=1).view(np.uint64)


class Tree:
    """A k-d tree. Inner node: letter and cut, counts up to the cut go left; leaf: its number."""

    def __init__(self, points: np.ndarray, most: float, fewest: int = 1):
        """Cut until a leaf holds at most `most` points, or all of its points are equal, or a cut would leave fewer than `fewest`."""
        self.letter, self.cut, self.child, self.leaf = [], [], [], []
        self.members: list[np.ndarray] = []
        todo = [(self._node(), np.arange(len(points)))]
        while todo:
            node, index = todo.pop()
            split = self._split(points[index], fewest) if len(index) > most else None
            if split is None:
                self.leaf[node] = len(self.members)
                self.members.append(index)
                continue
            self.letter[node], self.cut[node], left = split
            self.child[node] = self._node()
            self._node()
            todo += [(self.child[node], index[left]), (self.child[node] + 1, index[~left])]
        self.letter, self.cut, self.child, self.leaf = map(np.array, (self.letter, self.cut, self.child, self.leaf))

    def _node(self) -> int:
        for column in (self.letter, self.cut, self.child, self.leaf):
            column.append(-1)
        return len(self.letter) - 1

    @staticmethod
    def _split(points: np.ndarray, fewest: int) -> tuple[int, int, np.ndarray] | None:
        """The letter of widest spread that divides the points, cut near its median."""
        for letter in np.argsort(-points.var(axis=0), kind="stable")[:8]:
            column = points[:, letter]
            cut = int(np.median(column))
            best = max((cut, cut - 1), key=lambda c: min((column <= c).sum(), (column > c).sum()))
            left = column <= best
            if min(left.sum(), (~left).sum()) >= fewest:
                return int(letter), best, left
        return None

    def home(self, points: np.ndarray) -> np.ndarray:
        """The leaf of each point."""
        node = np.zeros(len(points), np.int64)
        while len(at := np.flatnonzero(self.leaf[node] < 0)):
            here = node[at]
            node[at] = self.child[here] + (points[at, self.letter[here]] > self.cut[here])
        return self.leaf[node]

    def visits(self, points: np.ndarray, replaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """(point, leaf) for leaves that may hold words with one letter more or, if replaced, with one exchanged.

        Such a word has one count more and, if replaced, one other count less.
        up and down are the letters on which the step was made on the way down.
        """
        index, node = np.arange(len(points)), np.zeros(len(points), np.int64)
        up = np.full(len(points), ANY)
        down = np.full(len(points), ANY if replaced else SPENT)
        out: list[tuple[np.ndarray, np.ndarray]] = []
        while len(index):
            done = self.leaf[node] >= 0
            out.append((index[done], self.leaf[node[done]]))
            index, node, up, down = (c[~done] for c in (index, node, up, down))
            letter, cut = self.letter[node], self.cut[node]
            count = points[index, letter]
            most = count + ((up == letter) | ((up == ANY) & (down != letter)))
            least = count - ((down == letter) | ((down == ANY) & (up != letter)))
            most = np.where(down == letter, count - 1, most)
            least = np.where(up == letter, count + 1, least)
            to_left, to_right = least <= cut, most > cut
            # a side that the count itself lies on needs no step
            down_left = np.where((count > cut) & (down == ANY), letter, down)
            up_right = np.where((count <= cut) & (up == ANY), letter, up)
            child = self.child[node]
            index, node, up, down = (
                np.concatenate([index[to_left], index[to_right]]),
                np.concatenate([child[to_left], child[to_right] + 1]),
                np.concatenate([up[to_left], up_right[to_right]]),
                np.concatenate([down_left[to_left], down[to_right]]),
            )
        return np.concatenate([i for i, _ in out]), np.concatenate([leaf for _, leaf in out])


# Searching a shard


class Shard:
    """Words of one length in a tree of their own, and what visitors found near to them."""

    def __init__(self, words: list[str], n: list[int]):
        self.words, self.n = words, n
        counts = vectors(words)
        self.tree = Tree(counts, LEAF)
        self.bits = packed(counts)
        self.letters = codes(words)[0].reshape(len(words), -1)
        self.sizes = np.array([len(m) for m in self.tree.members])
        self.begins = np.concatenate([[0], np.cumsum(self.sizes)[:-1]])
        self.flat = np.concatenate(self.tree.members)
        self.found: dict[int, tuple[int, tuple[int, str]]] = {}

    def pairs(self, words: list[str], replaced: bool) -> tuple[np.ndarray, np.ndarray]:
        """(visitor, own word) for all pairs one edit apart. Visitors all have the shard's length, or one letter less."""
        counts = vectors(words)
        bits, letters = packed(counts), codes(words)[0].reshape(len(words), -1)
        visitor, leaf = self.tree.visits(counts, replaced)
        ends = np.cumsum(self.sizes[leaf])
        out = [np.zeros((2, 0), np.int64)]
        at = 0
        while at < len(leaf):
            upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + AT_ONCE, "right")))
            sizes = self.sizes[leaf[at:upto]]
            v = np.repeat(visitor[at:upto], sizes)
            step = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
            w = self.flat[np.repeat(self.begins[leaf[at:upto]], sizes) + step]
            close = np.bitwise_count(bits[v] ^ self.bits[w]).sum(axis=1) <= (2 if replaced else 1)
            v, w = v[close], w[close]
            width = max(1, letters.shape[1])
            for part in range(0, len(v), max(1, 64 * AT_ONCE // width)):
                few = slice(part, part + max(1, 64 * AT_ONCE // width))
                near = one_edit(letters[v[few]], self.letters[w[few]])
                out.append(np.stack([v[few][near], w[few][near]]))
            at = upto
        v, w = np.concatenate(out, axis=1)
        return v, w

    def visited(self, words: list[str], n: list[int], replaced: bool) -> list[tuple]:
        """Rows of the visitors; a word with one letter less is noted for the own words as well."""
        v, w = self.pairs(words, replaced)
        if not replaced:
            for word, at in zip(w.tolist(), v.tolist(), strict=True):
                near, best = self.found.get(word, (0, (1, "")))
                self.found[word] = near + 1, min(best, (-n[at], words[at]))
        found: dict[int, tuple[int, tuple[int, str]]] = {}
        for at, word in zip(v.tolist(), w.tolist(), strict=True):
            near, best = found.get(at, (0, (1, "")))
            found[at] = near + 1, min(best, (-self.n[word], self.words[word]))
        return [(words[at], near, -best[0], best[1]) for at, (near, best) in found.items()]

    def rows(self) -> list[tuple]:
        return [(self.words[at], near, -best[0], best[1]) for at, (near, best) in self.found.items()]


def one_edit(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether rows of b differ from rows of a by one replaced letter or, where b is longer, by one inserted."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(axis=1) == 1
    if a.shape[1] == 0:
        return np.ones(len(a), bool)
    ahead, behind = a != b[:, :-1], a != b[:, 1:]
    first = np.where(ahead.any(axis=1), ahead.argmax(axis=1), a.shape[1])
    last = np.where(behind.any(axis=1), a.shape[1] - 1 - behind[:, ::-1].argmax(axis=1), -1)
    return last < first


PLACED = "length int, cell int, part int, kind int, word string, n bigint"
POINT, SAME, SHORTER = range(3)


def shared_trees(words: DataFrame) -> dict[int, Tree]:
    """For each length with more than SHARD words, a tree whose leaves hold about SHARD of them."""
    sized = words.withColumn("length", F.length("word"))
    large = dict(sized.groupBy("length").count().filter(F.col("count") > SHARD).collect())
    if not large:
        return {}
    picked = sized.filter(F.col("length").isin(list(large))).select("word", "length")
    by_length: dict[int, list[str]] = {}
    for word, length in hash_sample(picked, "word", SAMPLE).toLocalIterator():
        by_length.setdefault(length, []).append(word)
    return {
        length: Tree(vectors(sorted(sample)), SHARD * len(sample) / large[length], fewest=4)
        for length, sample in by_length.items()
    }


def placed(words: DataFrame, trees: dict[int, Tree], parts: dict[tuple[int, int], int], visiting: bool) -> DataFrame:
    """Each word in the shard where it lives and, if visiting, in those it visits."""

    def spread(length, cells, index, kind, words, n):
        for cell, i in zip(cells.tolist(), index.tolist(), strict=True):
            several = parts.get((length, cell), 1)
            if kind == POINT:
                yield length, cell, zlib.crc32(words[i].encode()) % several, kind, words[i], n[i]
            else:
                for part in range(several):
                    yield length, cell, part, kind, words[i], n[i]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([(c, pa.int32()) for c in ("length", "cell", "part", "kind")] + [("word", pa.string()), ("n", pa.int64())])
        for batch in batches:
            by_length: dict[int, list[tuple[str, int]]] = {}
            for word, n in zip(batch.column("word").to_pylist(), batch.column("n").to_pylist(), strict=True):
                by_length.setdefault(len(word), []).append((word, n))
            rows: list[tuple] = []
            for length, members in by_length.items():
                own, n = map(list, zip(*members, strict=True))
                index, counts = np.arange(len(own)), vectors(own)
                for size, kind in ((length, POINT), (length, SAME), (length + 1, SHORTER)):
                    if kind != POINT and not visiting:
                        continue
                    tree, at, cells = trees.get(size), index, np.zeros(len(own), np.int64)
                    if tree is not None and kind == POINT:
                        cells = tree.home(counts)
                    elif tree is not None:
                        at, cells = tree.visits(counts, kind == SAME)
                    rows += spread(size, cells, at, kind, own, n)
            columns = zip(*rows, strict=True) if rows else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

    return words.select("word", "n").mapInArrow(task, PLACED)


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and kind: a shard's own words come first and are held, its visitors pass by."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("form_n", pa.int64()), ("form", pa.string())])
    now, shard, own = None, None, ([], [])
    rows: list[tuple] = []
    for batch in batches:
        keys = np.stack([batch.column(c).to_numpy() for c in ("length", "cell", "part", "kind")], 1)
        words, n = batch.column("word").to_pylist(), batch.column("n").to_pylist()
        cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
            if a == b:
                continue
            *key, kind = keys[a].tolist()
            if key != now:
                rows += shard.rows() if shard else []
                now, shard, own = key, None, ([], [])
            if kind == POINT:
                own[0].extend(words[a:b])
                own[1].extend(n[a:b])
            elif own[0]:
                shard = shard or Shard(*own)
                rows += shard.visited(words[a:b], n[a:b], kind == SAME)
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
            rows = []
    if rows := shard.rows() if shard else []:
        columns = zip(*rows, strict=True)
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def near_words(words: DataFrame) -> DataFrame:
    """word, near (number of words one edit apart), form and form_n (the most frequent of them), for words that have any."""
    trees = shared_trees(words)
    homes = placed(words, trees, {}, visiting=False) if trees else None
    full: list[Row] = (
        homes.groupBy("length", "cell").count().filter(F.col("count") > 4 * SHARD).collect() if homes is not None else []
    )
    parts = {(r["length"], r["cell"]): -(-r["count"] // SHARD) for r in full}
    shards = placed(words, trees, parts, visiting=True).repartition("length", "cell", "part")
    found = shards.sortWithinPartitions("length", "cell", "part", "kind").mapInArrow(
        _search, "word string, near bigint, form_n bigint, form string"
    )
    best = F.min(F.struct((-F.col("form_n")).alias("less"), F.col("form").alias("form")))
    return found.groupBy("word").agg(F.sum("near").alias("near"), best.alias("best")).select(
        "word", "near", F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")
    )


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where following word -> form ends. Each round follows twice as far; counts at least double on each step."""
    now = stored(forms.select("word", F.col("form").alias("root")), "forms")
    while True:
        ahead = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        further = now.join(ahead, "root", "left")
        now = stored(further.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "forms")
        if now.filter("moved").isEmpty():
            return now.select("word", "root")


def grouped(words: DataFrame, times: int = 2) -> DataFrame:
    """word, form, root, n, n_near, form_n for every word; a form is at least `times` as frequent as the word."""
    words = stored(words, "words")
    taken = F.col("form_n") >= times * F.col("n")
    found = words.join(near_words(words), "word", "left").select(
        "word", "n",
        F.coalesce("near", F.lit(0)).cast("bigint").alias("n_near"),
        F.when(taken, F.col("form")).alias("form"),
        F.when(taken, F.col("form_n")).alias("form_n"),
    )
    found = stored(found, "near-words")
    ends = roots(found.filter(F.col("form").isNotNull()))
    return found.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
