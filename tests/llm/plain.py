"""Brute-force versions of the operators, for small inputs."""

import re
import zlib

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def pii(text):
    """(start, kind number, end) of the base entities."""
    def digits(m):
        return re.sub("[^0-9]", "", m.group())

    checks = (
        (EMAIL, lambda m: True),
        (IP, lambda m: all(int(p) <= 255 for p in m.group().split("."))),
        (CARD, lambda m: 12 <= len(digits(m)) <= 19 and luhn(digits(m))),
        (PHONE, lambda m: 9 <= len(digits(m)) <= 15),
    )
    return sorted((m.start(), no, m.end()) for no, (rx, ok) in enumerate(checks) for m in rx.finditer(text or "") if ok(m))


def found_pii(texts, support=3, trust=0.5, rounds=3):
    """Per text the places of identifiers that bootstrapping finds: all words and patterns in plain dictionaries."""
    edge, words = ".,;:!?()[]{}<>\"'", []
    for text in texts:
        text, at = text.replace("\ue000", " "), 0
        for start, _, end in pii(text):
            a = max(start, at)
            body = text[a:end].replace(" ", "_")
            text = text[:a] + ("\ue000" + body[1:] if start >= at else body) + text[max(a, end) :]
            at = max(at, end)
        words.append([(m.start(), m.group()) for m in re.finditer(r"[^ \t\n\x0b\f\r]+", text)])
    slots = []  # value, text number, start, end, patterns
    for no, row in enumerate(words):
        near = ["^", "^", *["\ue000" if "\ue000" in w else w.lower() for _, w in row], "$"]
        for i, (start, w) in enumerate(row):
            core, lead = w.strip(edge), len(w) - len(w.lstrip(edge))
            patterns = [(2, near[i], near[i + 1]), (1, near[i + 1]), (0, near[i + 3])]
            slots.append((core.lower(), no, start + lead, start + lead + len(core), patterns))
    totals, of_value = {}, {}
    for value, *_, patterns in slots:
        of_value[value] = of_value.get(value, 0) + 1
        for p in patterns:
            totals[p] = totals.get(p, 0) + 1
    seeds = {s[0] for s in slots if "\ue000" in s[0]}
    known = set()
    for _ in range(rounds):
        hits, values = {}, {}
        for value, *_, patterns in slots:
            if value in seeds or value in known:
                for p in patterns:
                    hits[p] = hits.get(p, 0) + 1
                    values.setdefault(p, set()).add(value)
        trusted = {p for p in hits if len(values[p]) >= support and hits[p] >= trust * totals[p]}
        inside = {}
        for value, *_, patterns in slots:
            for p in patterns:
                if p in trusted and value and "\ue000" not in value:
                    inside[value, p[0]] = inside.get((value, p[0]), 0) + 1
        known |= {v for (v, _), n in inside.items() if n >= trust * of_value[v]}
    out = [[] for _ in texts]
    for value, no, start, end, _ in slots:
        if value in known:
            out[no].append((start, end))
    return out


def sharded(rows, n):
    """(doc_id, size, crc, shard, slot) in the order of ids."""
    sized = sorted(
        ((-(2**63) if i is None else i, zlib.crc32((t or "").encode()), len((t or "").encode()) + 16) for i, t in rows)
    )
    total, at, slots, out = sum(s for _, _, s in sized), 0, {}, []
    for i, crc, size in sized:
        shard = min(n - 1, (at + size // 2) * n // total)
        slots[shard] = slots.get(shard, -1) + 1
        out.append((None if i == -(2**63) else i, size, crc, shard, slots[shard]))
        at += size
    return out


def removed(texts, width):
    """Per text the set of byte places covered by a string of the width that starts elsewhere too."""
    bodies = [(t or "").encode() for t in texts]
    seen = {}
    for d, b in enumerate(bodies):
        for p in range(len(b) - width + 1):
            seen.setdefault(b[p : p + width], []).append((d, p))
    gone = [set() for _ in bodies]
    for places in seen.values():
        if len(places) > 1:
            for d, p in places:
                gone[d].update(range(p, p + width))
    return gone


def components(n, links):
    """Smallest member reachable from each of range(n)."""
    at = list(range(n))

    def root(i):
        while at[i] != i:
            i = at[i]
        return i

    for a, b in links:
        a, b = sorted((root(a), root(b)))
        at[b] = a
    return [root(i) for i in range(n)]


HARD = [
    (None, None), (1, None), (2, ""), (3, "   \n\t "), (4, "one"), (5, "one"), (5, "one"),
    (6, "The quick brown fox jumps over the lazy dog. " * 40), (7, "The quick brown fox jumps over the lazy dog. " * 40),
    (8, "x" * 5000), (None, "no id at all, but some words in a row"), (9, "naïve café 日本語 \U0001f600 ünïcode"),
]
