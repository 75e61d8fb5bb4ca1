import hashlib
import random
import re
import zlib

import pytest

from haulmark.llm import conversations as C

WHITE = " \t\n\x0b\f\r"
KINDS = "conv_id bigint, turn bigint, role string, text string, copies int, tail string"


@pytest.fixture
def talk(spark):
    def make(rows):
        return spark.createDataFrame([(*r, 7, "x") for r in rows], KINDS)

    return make


def after_damage(rows):
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        fault = zlib.crc32(key.encode()) % 20
        text = "" if fault == 1 else re.sub("[.!?]", "", text) if fault == 2 else text
        role = "user" if fault == 4 else role
        for _ in range({0: 0, 3: 2}.get(fault, 1)):
            yield conv_id, turn, role, text


def repair(letters):
    """(cost, audit) by following all phases row by row; keeps the least pair of each."""
    ahead = {"": "u", "s": "u", "u": "a", "a": "u"}

    def with_inserts(states):
        todo = list(states)
        while todo:
            phase = todo.pop()
            cost, audit = states[phase]
            new, grown = ahead[phase], (cost + 3, audit + "I")
            if new not in states or grown < states[new]:
                states[new] = grown
                todo.append(new)
        return states

    states = with_inserts({"": (0, "")})
    for fault, initial in letters:
        new = {}
        for phase, (cost, audit) in states.items():
            options = [(phase, cost + 4, audit + "D")]
            if fault in ("", "truncated"):
                more = 3 if fault else 0
                if initial == ahead[phase] or (initial == "s" and phase == ""):
                    options.append((initial, cost + more, audit + "K"))
                if initial != ahead[phase]:
                    options.append((ahead[phase], cost + more + 3, audit + "R"))
            for phase_after, c, a in options:
                new[phase_after] = min(new.get(phase_after, (c, a)), (c, a))
        states = with_inserts(new)
    return min(states[p] for p in ("", "a") if p in states)


def brute(rows):
    out = {r[0]: None for r in rows}
    held = {}
    for r in after_damage(rows):
        held.setdefault(r[0], []).append(r)
    for conv_id in out:
        mine = sorted(held.get(conv_id, []), key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        seen, letters = set(), []
        for _, _, role, text in mine:
            bare = text.rstrip(WHITE)
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
            seen.add((role, text))
            letters.append((fault, role[:1]))
        turns = [t for _, t, _, _ in mine if t is not None]
        cost, audit = repair(letters)
        lines, phase, at = [], "", 0
        for letter in audit:
            role, text = mine[at][2:] if letter != "I" else ("", "")
            at += letter != "I"
            if letter == "D":
                continue
            if letter != "K":
                role = "assistant" if phase == "u" else "user"
            phase = role[0]
            lines.append(f"{role}:{text}")
        out[conv_id] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *[sum(f == k for f, _ in letters) for k in ("blank", "duplicate", "truncated")],
            sum(a + b not in ("su", "ua", "au") for (_, a), (_, b) in zip(letters, letters[1:], strict=False)),
            cost,
            audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        )
    return out


def found(df):
    return {r[0]: tuple(r)[1:] for r in C.repaired(C.damaged(C.cleaned(df))).collect()}


ROLES = ["user", "assistant", "user", "assistant", "user", "assistant", "system", "tool", "", None, "User"]
TEXTS = ["Yes.", "No!", "Why?", "cut off", "", " \t\n", None, "Yes. ", "a.b", "...", "é.", " "]


def test_random_conversations_equal_brute_force(talk):
    rng = random.Random(3)
    rows = []
    for conv_id in [*range(150), None]:
        usual = rng.random() < 0.5
        for turn in range(rng.choice([1, 2, 5, 9, 30, 60])):
            role = ("user", "assistant")[turn % 2] if usual else rng.choice(ROLES)
            text = f"{rng.random()}." if usual and rng.random() < 0.8 else rng.choice(TEXTS)
            rows.append((conv_id, turn if rng.random() < 0.9 else rng.choice([None, 0, 3, 1000]), role, text))
    rows += rows[:40]  # repeated rows
    rng.shuffle(rows)
    assert found(talk(rows)) == brute(rows)


def test_empty_table_and_conversation_without_rows(talk):
    assert found(talk([])) == {}
    dropped = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    nothing = hashlib.sha256(b"").hexdigest()
    assert found(talk([(dropped, 0, "user", "Hi.")])) == {dropped: (0, 0, 0, 0, 0, 0, "", nothing)}


def test_very_long_text_and_conversation(talk):
    rows = [(1, t, ("user", "assistant")[t % 2], f"{t}.") for t in range(3000)]
    rows += [(2, 0, "user", "x" * 20_000_000 + "."), (2, 1, "assistant", " " * 3_000_000)]
    assert found(talk(rows)) == brute(rows)


@pytest.mark.parametrize("block", [1, 2, 3, 64])
def test_blocks_do_not_change_the_repair(block, monkeypatch):
    monkeypatch.setattr(C, "BLOCK", block)
    rng = random.Random(block)
    for _ in range(150):
        letters = [(rng.choice(["", "", "", "blank", "truncated"]), rng.choice("suuaaa")) for _ in range(rng.randint(0, 13))]
        talk = C.Conversation(1)
        for fault, initial in letters:
            mark = "d" if fault == "blank" else initial.upper() if fault else initial
            talk.held.append((mark, {"s": "system", "u": "user", "a": "assistant"}[initial], "t"))
            if len(talk.held) == block:
                talk.align()
        assert talk.result()[6:8] == repair(letters)


def test_every_length_is_weighed():
    assert C.aligned("", C.EMPTY)[C.EMPTY] == (0, "")
    assert C.aligned("ua", C.EMPTY)[C.ASSISTANT] == (0, "KK")
    assert C.aligned("uua", C.EMPTY)[C.ASSISTANT] == (3, "KIKK")
    assert C.aligned("sa", C.EMPTY)[C.ASSISTANT] == (3, "KIK")
