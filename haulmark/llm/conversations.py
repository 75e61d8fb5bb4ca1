"""Repair of the turn structure of conversations by aligning them to an alternating grammar.

A conversation must read (s?(ua)+)? in the initials of its roles. Its rows are
aligned, by Wagner and Fischer's table, to every feasible length of the
alternating target. Ukkonen's band leaves out the diagonals that no path as
cheap as the incumbent can cross, lengths that cannot beat the incumbent are
not tried, and among equal costs the backtraced audits are compared.

Long conversations are aligned in blocks of BLOCK rows. Between blocks only the
phase counts (nothing yet, after s, after u, after a), so a block is aligned
for each phase it may start from, and a conversation is carried as four
partial repairs: cost, audit, running hash. The hash of a repaired
conversation follows its rows in order, so one task streams one conversation;
it holds a block of rows and one letter for each row seen.

Missing values of any column read as one space, but a missing turn sorts first
and does not count for gaps; a missing conv_id is one conversation. Ties of a
turn are ordered by role and text after the damage. A conversation without rows
after the damage has zeros, an empty audit and the hash of the empty string.
Roles are compared by their first character as it is, so `User` is no user. An
empty table gives an empty result; columns other than the four are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BLOCK = 8
DELETE, REROLE, INSERT, OPEN = 4, 3, 3, 3  # costs; OPEN: a truncated row that stays
EMPTY, SYSTEM, USER, ASSISTANT = range(4)  # phases of the grammar
NEXT = {EMPTY: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
NAMES = {USER: "user", ASSISTANT: "assistant"}
LETTERS = {"s": SYSTEM, "u": USER, "a": ASSISTANT}
FINAL = (EMPTY, ASSISTANT)
BLANKS = "' \\t\\n\\u000b\\f\\r'"
REMOVED = "d"  # a blank or repeated row in a pattern; truncated rows are upper case


def cleaned(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of every row, missing role and text as one space, and one copy of each row."""
    return conversations.select(
        F.col("conv_id").cast("bigint").alias("conv_id"),
        F.col("turn").cast("bigint").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")],
        F.lit(1).alias("copies"),
    )


def damaged(rows: DataFrame) -> DataFrame:
    """Cleaned rows with planted faults: a row in twenty each is dropped, emptied, cut, repeated, given to the user."""
    key = F.concat_ws(":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv_id", "turn")])
    fault = F.crc32(key.cast("binary")) % 20
    return rows.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when(fault == 1, "").when(fault == 2, F.translate("text", ".!?", "")).otherwise(F.col("text")).alias("text"),
        F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1).alias("copies"),
    )


def classes(pattern: str, entry: int) -> Iterator[tuple[int, int, str]]:
    """(lower bound of the cost, phase at the end, target) of every length, nearest to the number of rows first."""
    stay = sum(c != REMOVED for c in pattern)
    forced = DELETE * (len(pattern) - stay)
    pair = "au" if entry == USER else "ua"
    step = 0
    while True:
        for length in {stay - step, stay + step}:
            if length < 0:
                continue
            bound = forced + max(INSERT * (length - stay), DELETE * (stay - length))
            target = (pair * (length // 2 + 1))[:length]
            yield bound, LETTERS[target[-1]] if target else entry, target
            if entry == EMPTY and length and any(c in "sS" for c in pattern):
                target = "s" + target[:-1]
                yield bound, LETTERS[target[-1]], target
        step += 1


def table(pattern: str, target: str, most: int) -> tuple[int, str] | None:
    """Least cost, at most `most`, of turning the pattern into the target, and its least audit."""
    n, m = len(pattern), len(target)
    end = n - m
    # a path through diagonal i - j = d deletes and inserts its way there and back
    low = min(0, end, -((most - DELETE * end) // (DELETE + INSERT)))
    high = max(0, end, (most + INSERT * end) // (DELETE + INSERT))
    far = most + 1
    costs: list[dict[int, int]] = [{} for _ in range(n + 2)]
    costs[n][m] = 0

    def choices(i: int, j: int) -> Iterator[tuple[str, int, int, int]]:
        if i < n:
            yield "D", DELETE + costs[i + 1].get(j, far), i + 1, j
        if j < m and target[j] != "s":
            yield "I", INSERT + costs[i].get(j + 1, far), i, j + 1
        if i < n and j < m and pattern[i] != REMOVED:
            same = pattern[i].lower() == target[j]
            if same or target[j] != "s":
                cost = (0 if same else REROLE) + (OPEN if pattern[i].isupper() else 0)
                yield "K" if same else "R", cost + costs[i + 1].get(j + 1, far), i + 1, j + 1

    for i in range(n, -1, -1):
        row = costs[i]
        for j in range(min(m, i - low), max(0, i - high) - 1, -1):
            if (i, j) != (n, m):
                least = min((c for _, c, _, _ in choices(i, j)), default=far)
                if least < far:
                    row[j] = least
    if 0 not in costs[0]:
        return None
    audit, i, j = [], 0, 0
    while (i, j) != (n, m):
        letter, _, i, j = next(c for c in choices(i, j) if c[1] == costs[i][j])
        audit.append(letter)
    return costs[0][0], "".join(audit)


@lru_cache(maxsize=1 << 16)
def aligned(pattern: str, entry: int) -> dict[int, tuple[int, str]]:
    """For each phase in which the rows can end: least cost and, at that cost, the least audit."""
    best: dict[int, tuple[int, str]] = {}
    sure = {USER, ASSISTANT}
    for bound, phase, target in classes(pattern, entry):
        if sure <= best.keys() and bound > max(cost for cost, _ in best.values()) and len(target) > len(pattern):
            return best
        # all rows deleted and all symbols inserted is always possible
        most = best[phase][0] if phase in best else DELETE * len(pattern) + INSERT * len(target)
        if bound <= most and (found := table(pattern, target, most)):
            best[phase] = min(found, best.get(phase, found))
    raise AssertionError


class Audits:
    """Audits of partial repairs as chains of pieces, and how any two of them compare.

    order[p, q] is -1 or 1, or the rest of q's audit where p's is a prefix of it.
    """

    def __init__(self) -> None:
        self.chains: dict[int, tuple | None] = {EMPTY: None}
        self.order: dict[tuple[int, int], int | str] = {(EMPTY, EMPTY): ""}

    def compare(self, p: int, more: str, q: int, rest: str) -> int | str:
        """Order of p's audit + more against q's audit + rest."""
        known, flipped = self.order.get((p, q)), False
        if known is None:
            known, p, more, q, rest, flipped = self.order[q, p], q, rest, p, more, True
        if isinstance(known, str):
            rest = known + rest
            known = rest[len(more) :] if rest.startswith(more) else (-1 if more < rest else 1)
        if isinstance(known, str):
            return known if not flipped or not known else -2
        return -known if flipped else known

    def extend(self, picks: dict[int, tuple[int, str]]) -> None:
        """picks: for each new phase the old one that it continues and the piece that follows."""
        order = {}
        for a, (p, more) in picks.items():
            for b, (q, rest) in picks.items():
                found = self.compare(p, more, q, rest)
                if found != -2:
                    order[a, b] = found
        self.chains = {a: (self.chains[p], more) for a, (p, more) in picks.items()}
        self.order = order

    def text(self, phase: int) -> str:
        pieces, chain = [], self.chains[phase]
        while chain:
            chain, piece = chain
            pieces.append(piece)
        return "".join(reversed(pieces))


class Conversation:
    """Figures and partial repairs of the rows seen so far."""

    def __init__(self, conv_id: int | None):
        self.conv_id = conv_id
        self.first = self.last = None
        self.turns = self.blank = self.repeated = self.truncated = self.illegal = 0
        self.initial: str | None = None
        self.held: list[tuple[str, str, str]] = []
        self.audits = Audits()
        self.states = {EMPTY: (0, hashlib.sha256())}

    def add(self, turn: int | None, role: str, text: str, tail: str, copies: int, seen: int) -> None:
        if not copies:
            return
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        initial = role[:1]
        for copy in range(copies):
            if self.initial is not None:
                self.illegal += self.initial + initial not in ("su", "ua", "au")
            self.initial = initial
            letter = initial if initial in LETTERS else "x"
            if not tail:
                self.blank += 1
                letter = REMOVED
            elif seen or copy:
                self.repeated += 1
                letter = REMOVED
            elif tail not in ".!?":
                self.truncated += 1
                letter = letter.upper()
            self.held.append((letter, role, text))
            if len(self.held) == BLOCK:
                self.align()

    def align(self) -> None:
        pattern = "".join(letter for letter, _, _ in self.held)
        picks: dict[int, tuple[int, str]] = {}
        costs: dict[int, int] = {}
        for entry, (before, _) in self.states.items():
            for phase, (cost, audit) in aligned(pattern, entry).items():
                total = before + cost
                if phase in costs:
                    if total > costs[phase]:
                        continue
                    # two repairs of the same rows at the same cost: neither audit is a prefix of the other
                    if total == costs[phase] and self.audits.compare(entry, audit, *picks[phase]) != -1:
                        continue
                costs[phase], picks[phase] = total, (entry, audit)
        self.states = {
            phase: (costs[phase], self.repaired(self.states[entry][1].copy(), entry, audit))
            for phase, (entry, audit) in picks.items()
        }
        self.audits.extend(picks)
        self.held.clear()

    def repaired(self, digest, phase: int, audit: str):
        """The hash after the lines that the audit makes of the held rows."""
        rows = iter(self.held)
        for letter in audit:
            kind, role, text = ("", "", "") if letter == "I" else next(rows)
            if letter == "D":
                continue
            after = LETTERS[kind.lower()] if letter == "K" else NEXT[phase]
            name = role if letter == "K" else NAMES[after]
            digest.update(f"{'' if phase == EMPTY else chr(10)}{name}:{text}".encode())
            phase = after
        return digest

    def result(self) -> tuple:
        if self.held:
            self.align()
        final = [phase for phase in FINAL if phase in self.states]
        least = min(self.states[phase][0] for phase in final)
        final = [phase for phase in final if self.states[phase][0] == least]
        phase = final[0]
        if len(final) > 1 and self.audits.compare(final[1], "", final[0], "") == -1:
            phase = final[1]
        cost, digest = self.states[phase]
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        return (
            self.conv_id, gaps, self.blank, self.repeated, self.truncated, self.illegal, cost,
            self.audits.text(phase), digest.hexdigest(),
        )


RESULT = pa.schema(
    [(c, pa.int64()) for c in ("conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost")]
    + [("audit", pa.string()), ("repaired_sha256", pa.string())]
)


def batch_of(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [[] for _ in RESULT]
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, RESULT, strict=True)], schema=RESULT)


def _repair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now: Conversation | None = None
    done: list[tuple] = []
    for batch in batches:
        for conv_id, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if now is None or conv_id != now.conv_id:
                if now is not None:
                    done.append(now.result())
                now = Conversation(conv_id)
            now.add(*row)
        yield batch_of(done)
        done = []
    if now is not None:
        yield batch_of([now.result()])


def repaired(rows: DataFrame) -> DataFrame:
    """One row per conversation: faults, cost and audit of the cheapest repair, hash of the repaired text.

    rows: conv_id, turn, role, text, copies; copies says how often a row stands there, 0 keeps only its conversation.
    """
    earlier = Window.partitionBy("conv_id", "role", "text").orderBy(F.col("turn").asc_nulls_first())
    seen = F.sum("copies").over(earlier.rowsBetween(Window.unboundedPreceding, -1))
    tail = F.expr(f"right(trim(TRAILING {BLANKS} FROM text), 1)")
    ordered = (
        rows.repartition("conv_id")  # also serves the window, which groups more finely
        .select("conv_id", "turn", "role", "text", tail.alias("tail"), "copies", F.coalesce(seen, F.lit(0)).alias("seen"))
        .sortWithinPartitions(F.col("conv_id"), F.col("turn").asc_nulls_first(), "role", "text")
    )
    kinds = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
    return ordered.mapInArrow(_repair, kinds + ", audit string, repaired_sha256 string")
