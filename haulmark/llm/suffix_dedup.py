"""Removal of byte strings that occur more than once, by sorting suffixes.

A string of WIDTH bytes counts as repeated if it starts anywhere else too. Not
every suffix of the corpus is sorted: of the ANCHOR-byte strings inside each
window of WIDTH bytes the one of least hash (the last of equals) stands for the
window, so equal windows have equal anchors in equal places. The windows of one
anchor are neighbours; together they are its context.

1. Anchors that occur once are left out (their counts are aggregated).
2. Contexts that occur twice as a whole are repeated in all their windows;
   they are named by 128 bits.
3. The others lie on the border of a repeated passage. The contexts of one
   anchor are brought together and the suffixes that start at equal places are
   sorted: prefix hashes and binary search give the common extension of two
   suffixes, mergesort orders them by it, and neighbours that agree over WIDTH
   bytes, compared byte by byte, are repeated windows. An anchor with more than
   CROWD contexts is not brought together: its windows are dealt out by hash,
   sorted by their bytes in every task, and neighbours compared.

Two filters of fixed size (FILTER_BITS) tell the tasks that read the texts which
anchors and contexts matter; what passes by mistake is sorted out later.

Texts are UTF-8 bytes; missing texts are empty; texts shorter than WIDTH lose
nothing; missing ids stay missing; equal rows are repeats of each other; an
empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from haulmark.llm import blocks
from haulmark.llm.tables import stored, texts_of

WIDTH, ANCHOR = 200, 50
CROWD = 1 << 12
FILTER_BITS, PROBES = 1 << 27, 3
PIECE = 1 << 20  # windows whose anchors are sought at once
PLACE = np.uint64((1 << 21) - 1)  # holds any place in a piece and its last window
BLOCK, SORT_BYTES = 1 << 20, 2 << 20  # bytes of text and of contexts that a task works on at once
CONTEXT = ["anchor", "context", "second"]  # a context is named by its anchor and 128 bits
_inverse: dict[int, np.ndarray] = {}


def inverse_powers(n: int) -> np.ndarray:
    size = 1 << max(6, (n - 1).bit_length())
    if size not in _inverse:
        _inverse.clear()
        step = np.full(size, pow(blocks.BASE, -1, 1 << 64), np.uint64)
        step[0] = 1
        _inverse[size] = np.multiply.accumulate(step)
    return _inverse[size][:n]


def prefix_hashes(data: np.ndarray) -> np.ndarray:
    """Sums of byte times power; a range's hash is a difference times the inverse power of its start."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * blocks.powers(len(data)), out=out[1:])
    return out


def range_hashes(prefix: np.ndarray, inverse: np.ndarray, start: np.ndarray, size) -> np.ndarray:
    return (prefix[start + size] - prefix[start]) * inverse[start]


def least_places(data: np.ndarray, width: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Place of the least string of each window, and the hashes of all strings by place."""
    prefix, inverse = prefix_hashes(data), inverse_powers(len(data) + 1)
    places = len(data) - size + 1
    hashes = blocks.mixed((prefix[size:] - prefix[:places]) * inverse[:places])
    least = (hashes & ~PLACE) | (PLACE - np.arange(places, dtype=np.uint64))
    many, reach = width - size + 1, 1
    while 2 * reach <= many:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if many > reach:
        least = np.minimum(least[: len(least) - (many - reach)], least[many - reach :])
    return (PLACE - (least & PLACE)).astype(np.int64), hashes


def anchors(data: np.ndarray, offsets: np.ndarray, width: int = WIDTH, size: int = ANCHOR) -> tuple[np.ndarray, ...]:
    """row, anchor, first and last window start, hash; places count from the start of the data.

    The data is read in pieces that overlap by a window, so memory does not grow with a text.
    """
    runs = [np.zeros((3, 0), np.int64)]
    names = [np.zeros(0, np.uint64)]
    ends = np.append(offsets[1:], len(data))
    for at in range(0, len(data) - width + 1, PIECE):
        chosen, hashes = least_places(data[at : at + PIECE + width - 1], width, size)
        start = at + np.arange(len(chosen))
        starts = np.flatnonzero(start + width <= ends[blocks.rows_of(start, offsets)])  # windows inside one text
        if len(starts):
            picked = chosen[starts]
            cut = np.flatnonzero(np.append(True, picked[1:] != picked[:-1]))
            last = starts[np.append(cut[1:], len(starts)) - 1]
            runs.append(np.stack([picked[cut], starts[cut], last]) + at)
            names.append(hashes[picked[cut]])
    (anchor, first, last), name = np.concatenate(runs, 1), np.concatenate(names)
    if len(anchor):
        cut = np.flatnonzero(np.append(True, anchor[1:] != anchor[:-1]))  # a run may go on in the next piece
        anchor, first, last, name = anchor[cut], first[cut], last[np.append(cut[1:], len(last)) - 1], name[cut]
    return blocks.rows_of(first, offsets), anchor, first, last, name


def probes(keys: np.ndarray) -> np.ndarray:
    """Bits of the filter for each key."""
    k = keys.astype(np.uint64)
    return np.stack([(blocks.mixed(k + np.uint64(i * 0x9E3779B97F4A7C15 % 2**64)) & np.uint64(FILTER_BITS - 1)) for i in range(PROBES)])


def key_filter(keys: DataFrame) -> np.ndarray:
    """Bytes with the bits of all keys set; FILTER_BITS in size, whatever the number of keys."""

    def words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bit = probes(batch.column("key").to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)).ravel()
            order = np.argsort(bit)
            word, mask = (bit[order] >> np.uint64(6)).astype(np.int64), np.uint64(1) << (bit[order] & np.uint64(63))
            at = np.flatnonzero(np.append(True, word[1:] != word[:-1])) if len(word) else np.zeros(0, np.int64)
            merged = np.bitwise_or.reduceat(mask, at) if len(word) else mask
            yield pa.RecordBatch.from_arrays([pa.array(word[at]), pa.array(merged.view(np.int64))], ["word", "mask"])

    rows = keys.mapInArrow(words, "word bigint, mask bigint").groupBy("word").agg(F.bit_or("mask").alias("mask")).toArrow()
    out = np.zeros(FILTER_BITS // 64, np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("mask").to_numpy().view(np.uint64)
    return out


def passes(held: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for bit in probes(keys):
        found &= (held[(bit >> np.uint64(6)).astype(np.int64)] >> (bit & np.uint64(63))) & np.uint64(1) == 1
    return found


def signed(values: np.ndarray) -> pa.Array:
    return pa.array(values.view(np.int64))


def occurrence_keys(doc: np.ndarray, text: np.ndarray, place: np.ndarray) -> np.ndarray:
    k = text.view(np.uint64) + doc.view(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F) + place.astype(np.uint64) * np.uint64(0x165667B19E3779F9)
    return blocks.mixed(k)


def keyed(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    ids = batch.column("doc_id").fill_null(-(2**63)).to_numpy(zero_copy_only=False).astype(np.int64)
    return ids, batch.column("h").to_numpy(zero_copy_only=False).astype(np.int64)


def merged(row: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of each row, those that touch made one; input sorted by row and low."""
    if not len(row):
        return row, low, high
    top = np.maximum.accumulate(high + row * (1 << 40)) - row * (1 << 40)
    cut = np.flatnonzero(np.append(True, (row[1:] != row[:-1]) | (low[1:] > top[:-1])))
    return row[cut], low[cut], top[np.append(cut[1:], len(row)) - 1]


def grouped(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First index of each distinct pair, each row's pair, and how often each pair occurs."""
    if not len(a):
        return (np.zeros(0, np.int64),) * 3
    order = np.lexsort((b, a))
    new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
    kind = np.empty(len(a), np.int64)
    kind[order] = np.cumsum(new) - 1
    return order[new], kind, np.bincount(kind)


def counted_anchors(texts: DataFrame, width: int, size: int) -> DataFrame:
    """anchor, n: aggregated counts of all anchors."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, data, offsets in blocks.blocks(batch.column("text"), BLOCK):
                hashes, n = np.unique(anchors(data, offsets, width, size)[4], return_counts=True)
                yield pa.RecordBatch.from_arrays([signed(hashes), pa.array(n)], ["key", "n"])

    return texts.mapInArrow(task, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))


def contexts(texts: DataFrame, repeated, width: int, size: int) -> DataFrame:
    """Contexts of repeated anchors, and ranges known to be repeated.

    Rows with n = 0 are ranges. A context that occurs several times in a block
    of texts gives ranges and one row with its count.
    """
    import xxhash

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["anchor", "context", "second", "key", "n", "doc_id", "h", "low", "high"]
        for batch in batches:
            ids, texts_h = keyed(batch)
            for row0, _, data, offsets in blocks.blocks(batch.column("text"), BLOCK):
                row, anchor, first, last, hashes = anchors(data, offsets, width, size)
                keep = passes(repeated.value, hashes)
                row, anchor, first, last, hashes = (x[keep] for x in (row, anchor, first, last, hashes))
                whole, digest = data.tobytes(), xxhash.xxh3_128_digest
                body = zip(first.tolist(), (last + width).tolist(), (anchor - first).tolist(), strict=True)
                context, second = np.frombuffer(b"".join([digest(whole[a:b], at) for a, b, at in body]), np.uint64).reshape(-1, 2).T
                doc, text, start = ids[row0 + row], texts_h[row0 + row], offsets[row]
                key = occurrence_keys(doc, text, anchor - start)
                one, kind, n = grouped(context, second)
                low, high = first - start, last - start + width
                many = np.flatnonzero(n[kind] > 1)
                r, a, b = merged(row[many], low[many], high[many])
                rows = np.concatenate([one, np.zeros(len(r), np.int64)])
                is_range = np.append(np.zeros(len(one), bool), np.ones(len(r), bool))
                where = np.concatenate([row[one], r]) + row0
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(hashes[rows]), signed(context[rows]), signed(second[rows]), signed(key[rows]),
                        pa.array(np.where(is_range, 0, np.append(n, np.zeros(len(r), np.int64)))),
                        batch.column("doc_id").take(pa.array(where)), pa.array(texts_h[where]),
                        pa.array(np.append(low[one], a)), pa.array(np.append(high[one], b)),
                    ],
                    names,
                )

    kinds = "anchor bigint, context bigint, second bigint, key bigint, n bigint, doc_id bigint, h bigint, low bigint, high bigint"
    return texts.mapInArrow(task, kinds)


def border_contexts(texts: DataFrame, wanted, width: int, size: int) -> DataFrame:
    """anchor, place (of the anchor in the context), doc_id, h, low, body: the bytes of the wanted contexts."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts_h = keyed(batch)
            for row0, _, data, offsets in blocks.blocks(batch.column("text"), BLOCK):
                row, anchor, first, last, hashes = anchors(data, offsets, width, size)
                key = occurrence_keys(ids[row0 + row], texts_h[row0 + row], anchor - offsets[row])
                keep = passes(wanted.value, key)
                row, anchor, first, last, hashes = (x[keep] for x in (row, anchor, first, last, hashes))
                whole = data.tobytes()
                body = [whole[a:b] for a, b in zip(first.tolist(), (last + width).tolist(), strict=True)]
                where = row0 + row
                yield pa.RecordBatch.from_arrays(
                    [
                        signed(hashes), pa.array(anchor - first), batch.column("doc_id").take(pa.array(where)),
                        pa.array(texts_h[where]), pa.array(first - offsets[row]), pa.array(body, pa.binary()),
                    ],
                    ["anchor", "place", "doc_id", "h", "low", "body"],
                )

    return texts.mapInArrow(task, "anchor bigint, place bigint, doc_id bigint, h bigint, low bigint, body binary")


class Suffixes:
    """Order of suffixes by their first `width` bytes."""

    def __init__(self, data: np.ndarray, width: int):
        self.data, self.width = data, width
        self.prefix, self.inverse = prefix_hashes(data), inverse_powers(len(data) + 1)

    def same(self, a: np.ndarray, b: np.ndarray, size) -> np.ndarray:
        return range_hashes(self.prefix, self.inverse, a, size) == range_hashes(self.prefix, self.inverse, b, size)

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common start of suffixes, up to width, by binary search over prefix hashes."""
        common = np.where(self.same(a, b, self.width), self.width, 0)
        open_ = np.flatnonzero(common == 0)
        x, y, found = a[open_], b[open_], np.zeros(len(open_), np.int64)
        step = 1 << (self.width - 1).bit_length() - 1
        while step:
            fits = np.flatnonzero(found + step < self.width)
            more = fits[self.same(x[fits] + found[fits], y[fits] + found[fits], step)]
            found[more] += step
            step >>= 1
        common[open_] = found
        return common

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        common = self.extension(a, b)
        at = np.minimum(common, self.width - 1)
        return (common < self.width) & (self.data[a + at] < self.data[b + at])

    def sort(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Order of the suffixes inside each group, by mergesort; input sorted by group."""
        order = np.arange(len(starts))
        if not len(starts):
            return order
        first = np.flatnonzero(np.append(True, group[1:] != group[:-1]))
        sizes = np.diff(np.append(first, len(starts)))
        base, size = np.repeat(first, sizes), np.repeat(sizes, sizes)
        run = 1
        while run < sizes.max():
            slot = np.flatnonzero(size > run)  # slots of groups that are not yet in order
            place = slot - base[slot]
            left = place // run % 2 == 0
            pair = base[slot] + place // (2 * run) * (2 * run)
            end = base[slot] + size[slot]
            low = np.where(left, np.minimum(pair + run, end), pair)
            high = np.where(left, np.minimum(pair + 2 * run, end), pair + run)
            other = low.copy()
            own = starts[order[slot]]
            busy = np.flatnonzero(low < high)
            while len(busy):
                middle = (low[busy] + high[busy]) // 2
                there = starts[order[middle]]
                right = ~left[busy]
                # an element of the left run goes before its equals in the right one
                goes_on = np.empty(len(busy), bool)
                goes_on[right] = ~self.less(own[busy][right], there[right])
                goes_on[~right] = self.less(there[~right], own[busy][~right])
                low[busy] = np.where(goes_on, middle + 1, low[busy])
                high[busy] = np.where(goes_on, high[busy], middle)
                busy = busy[low[busy] < high[busy]]
            target = pair + (place % run) + (low - other)
            moved = order.copy()
            moved[target] = order[slot]
            order = moved
            run *= 2
        return order

    def repeated(self, starts: np.ndarray, group: np.ndarray) -> np.ndarray:
        """Whether each suffix shares its first width bytes with another of its group."""
        order = self.sort(starts, group)
        a, b = order[:-1], order[1:]
        near = np.flatnonzero((group[a] == group[b]) & self.same(starts[a], starts[b], self.width)) if len(order) else order
        out, place = np.zeros(len(starts), bool), np.arange(self.width)
        for at in range(0, len(near), 1 << 14):  # equal hashes are compared byte by byte
            x, y = a[near[at : at + (1 << 14)]], b[near[at : at + (1 << 14)]]
            equal = (self.data[starts[x][:, None] + place] == self.data[starts[y][:, None] + place]).all(1)
            out[x[equal]] = out[y[equal]] = True
        return out


def repeated_ranges(bodies: list[bytes], anchor: np.ndarray, place: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last repeated window of each context, counted in windows from its start; last is -1 if there is none."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    sizes = np.array([len(b) for b in bodies], np.int64)
    at, windows = np.cumsum(sizes) - sizes, sizes - width + 1
    owner = np.repeat(np.arange(len(bodies)), windows)
    step = np.arange(len(owner)) - np.repeat(np.cumsum(windows) - windows, windows)
    starts = at[owner] + step
    # windows of one anchor can only be equal if the anchor has the same place in them
    _, kind = np.unique(anchor, return_inverse=True)
    group = kind[owner] * (2 * width) + (place[owner] - step)
    order = np.argsort(group, kind="stable")
    starts, owner, step, group = starts[order], owner[order], step[order], group[order]
    hit = Suffixes(data, width).repeated(starts, group)
    first, last = np.full(len(bodies), 1 << 40), np.full(len(bodies), -1)
    np.minimum.at(first, owner[hit], step[hit])
    np.maximum.at(last, owner[hit], step[hit])
    return first, last


def sorted_borders(rows: DataFrame, width: int) -> DataFrame:
    """doc_id, h, low, high of the repeated ranges in contexts, which are brought together by anchor."""

    def solve(table: pa.Table) -> pa.RecordBatch:
        anchor = table.column("anchor").to_numpy()
        first, last = repeated_ranges(table.column("body").to_pylist(), anchor, table.column("place").to_numpy(), width)
        low, hit = table.column("low").to_numpy(), np.flatnonzero(last >= 0)
        columns = [table.column(c).combine_chunks().take(pa.array(hit)) for c in ("doc_id", "h")]
        columns += [pa.array((low + first)[hit]), pa.array((low + last + width)[hit])]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "h", "low", "high"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.nbytes for b in held) < SORT_BYTES:
                continue
            table = pa.Table.from_batches(held)
            anchor = table.column("anchor").to_numpy()
            whole = int(np.searchsorted(anchor, anchor[-1], "left"))  # the last anchor may go on in the next batch
            if whole:
                yield solve(table.slice(0, whole))
            held = table.slice(whole).combine_chunks().to_batches()
        if held and sum(b.num_rows for b in held):
            yield solve(pa.Table.from_batches(held))

    ordered = rows.repartition("anchor").sortWithinPartitions("anchor")
    return ordered.mapInArrow(task, "doc_id bigint, h bigint, low bigint, high bigint")


def repeated_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose window is that of the row before or after; the windows are sorted."""
    carried, before = None, None  # last row of the batch before, and the last window that was seen
    for batch in batches:
        if not batch.num_rows:
            continue
        whole = pa.concat_batches([carried, batch]) if carried is not None else batch
        body = whole.column("window").to_pylist()
        again = [a == b for a, b in zip([before, *body[:-1]], body, strict=True)]
        # the last row is judged with the next batch, which shows what follows it
        hit = [x or y for x, y in zip(again[:-1], again[1:], strict=True)]
        yield whole.slice(0, len(hit)).filter(pa.array(hit, pa.bool_())).select(["doc_id", "h", "low", "step"])
        before = body[-2] if len(body) > 1 else before
        carried = whole.slice(len(hit))
    if carried is not None and carried.column("window")[0].as_py() == before:
        yield carried.select(["doc_id", "h", "low", "step"])


def crowded_borders(rows: DataFrame, width: int) -> DataFrame:
    """The same ranges for crowded anchors: every window is a row; windows whose hash occurs again are sorted by their bytes."""
    import xxhash

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                body, n = row["body"], len(row["body"]) - width + 1
                bodies = [body[i : i + width] for i in range(n)]
                marks = np.array([xxhash.xxh64_intdigest(w) for w in bodies], np.uint64)
                same = [pa.array([row[c]] * n, pa.int64()) for c in ("doc_id", "h", "low")]
                yield pa.RecordBatch.from_arrays(
                    [*same, pa.array(range(n), pa.int64()), signed(marks), pa.array(bodies, pa.binary())],
                    ["doc_id", "h", "low", "step", "mark", "window"],
                )

    each = rows.mapInArrow(windows, "doc_id bigint, h bigint, low bigint, step bigint, mark bigint, window binary")
    often = each.groupBy("mark").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("mark")
    ordered = each.join(often, "mark").repartition("mark").sortWithinPartitions("mark", "window")
    hit = ordered.select("doc_id", "h", "low", "step", "window").mapInArrow(repeated_windows, "doc_id bigint, h bigint, low bigint, step bigint")
    hit = hit.groupBy("doc_id", "h", "low").agg(F.min("step").alias("a"), F.max("step").alias("b"))
    return hit.select("doc_id", "h", (F.col("low") + F.col("a")).alias("low"), (F.col("low") + F.col("b") + width).alias("high"))


def repeats(texts: DataFrame, width: int = WIDTH, size: int = ANCHOR, crowd: int = CROWD) -> DataFrame:
    """doc_id, h, low, high: ranges that cover every byte of every repeated window. texts: doc_id, h, text."""
    send = texts.sparkSession.sparkContext.broadcast
    counts = counted_anchors(texts, width, size)
    repeated = send(key_filter(counts.filter("n > 1").select("key")))
    found = stored(contexts(texts, repeated, width, size), "contexts")
    single = found.filter("n > 0")
    per_context = single.groupBy(*CONTEXT).agg(F.sum("n").alias("total"), F.min("key").alias("key"))
    per_context = stored(per_context, "context-counts")
    per_anchor = per_context.groupBy("anchor").agg(
        F.count(F.lit(1)).alias("contexts"), F.max((F.col("total") == 1).cast("int")).alias("border")
    )
    per_anchor = per_anchor.filter("contexts > 1 AND border = 1")
    known = found.filter("n = 0").select("doc_id", "h", "low", "high")
    often = per_context.filter("total > 1").select(*CONTEXT)
    whole = single.filter("n = 1").join(often, CONTEXT).select("doc_id", "h", "low", "high")

    wanted = send(key_filter(per_context.join(per_anchor, "anchor").select("key")))
    rows = border_contexts(texts, wanted, width, size)
    crowded = stored(per_anchor.filter(F.col("contexts") > crowd).select("anchor"), "crowded-anchors")
    out = known.union(whole)
    if crowded.isEmpty():
        return out.union(sorted_borders(rows, width))
    rows = stored(rows, "border-contexts")
    out = out.union(sorted_borders(rows.join(crowded, "anchor", "left_anti"), width))
    return out.union(crowded_borders(rows.join(crowded, "anchor", "left_semi"), width))


def deduplicated(docs: DataFrame, width: int = WIDTH, size: int = ANCHOR, crowd: int = CROWD, keep_text: bool = False) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256; with keep_text also kept, the bytes that stay."""
    texts = texts_of(docs).withColumn("h", F.xxhash64("text"))
    ranges = repeats(texts, width, size, crowd)
    ranges = ranges.groupBy("doc_id", "h").agg(F.collect_set(F.struct("low", "high")).alias("ranges"))  # of one text, once for equal rows
    ranges = ranges.select(F.col("doc_id").alias("d"), F.col("h").alias("dh"), "ranges")
    same = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("h") == F.col("dh"))
    joined = texts.join(ranges, same, "left").select("doc_id", "text", "ranges")

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            lists = batch.column("ranges")
            low, high = (lists.flatten().field(i).to_numpy(zero_copy_only=False) for i in range(2))
            ends = np.cumsum(lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
            for k, text in enumerate(batch.column("text")):
                body = text.as_py().encode()
                a, b = low[ends[k - 1] if k else 0 : ends[k]], high[ends[k - 1] if k else 0 : ends[k]]
                order = np.argsort(a, kind="stable")
                _, a, b = merged(np.zeros(len(a), np.int64), a[order].astype(np.int64), b[order].astype(np.int64))
                edges = [0, *np.stack([a, b], 1).ravel().tolist(), len(body)]
                kept = b"".join([body[x:y] for x, y in zip(edges[::2], edges[1::2], strict=True)])
                out.append((len(body), len(body) - len(kept), len(a), hashlib.sha256(kept).hexdigest(), kept))
            names = ["n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"][: 5 if keep_text else 4]
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            columns = [pa.array([r[i] for r in out], kinds[i]) for i in range(len(names))]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", *names])

    kinds = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return joined.mapInArrow(task, kinds + (", kept binary" if keep_text else ""))
