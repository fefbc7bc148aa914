"""Plain readings of the contracts, one text at a time."""

from __future__ import annotations

import re
from collections import Counter

WORD = re.compile("[^\x20\x09-\x0d]+")


def base_counts(text: str | None) -> tuple[int, int, int, int, int, bool]:
    words = WORD.findall(text or "")
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    runs = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = {k for k, v in Counter(runs).items() if v > 1}
    covered = {j for i, k in enumerate(runs) if k in twice for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return (
        len(words),
        sum(map(len, words)),
        len(re.findall(r"[#*$%&|<>]", text or "")),
        len(lines) - len(set(lines)),
        len(covered),
        failed,
    )


def contamination(documents: dict, items: dict, width: int = 10) -> dict:
    """By document: n_words, n_hit and the found items."""
    word = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda text: word.findall((text or "").translate(lower))
    windows: dict[tuple, set] = {}
    for item, text in items.items():
        own = words(text)
        for i in range(max(len(own) - width + 1, 1 if own else 0)):
            windows.setdefault(tuple(own[i : i + width]), set()).add(item)
    sizes, out = {len(w) for w in windows}, {}
    for doc, text in documents.items():
        own, hit, found = words(text), set(), set()
        for size in sizes:
            for i in range(len(own) - size + 1):
                if (run := tuple(own[i : i + size])) in windows:
                    hit.update(range(i, i + size))
                    found |= windows[run]
        out[doc] = (len(own), len(hit), found)
    return out


def near_duplicates(documents: dict) -> dict:
    """By document: number of shingles and smallest id reachable by links."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets, holders = {}, {}
    for doc, text in documents.items():
        words = WORD.findall((text or "").translate(lower))
        runs = max(len(words) - 4, 1 if words else 0)
        sets[doc] = {tuple(words[i : i + 5]) for i in range(runs)}
        for run in sets[doc]:
            holders.setdefault(run, []).append(doc)
    root = {doc: doc for doc in documents}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for doc, own in sets.items():
        common = Counter(other for run in own for other in holders[run] if other > doc)
        for other, overlap in common.items():
            if 100 * overlap >= 75 * (len(own) + len(sets[other]) - overlap):
                a, b = find(doc), find(other)
                root[max(a, b)] = min(a, b)
    return {doc: (len(sets[doc]), find(doc)) for doc in documents}


def conversation(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, hash) of (turn, role, text)
    rows; scripts are plain strings, held for each state that may follow."""
    import hashlib

    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    turns = [t for t, _, _ in rows if t is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    faults, seen = [], set()
    for _, role, text in rows:
        inked = re.findall("[^\x20\x09-\x0d]", text)
        faults.append(
            "blank" if not inked else "duplicate" if (role, text) in seen
            else "truncated" if inked[-1] not in ".!?" else ""
        )
        seen.add((role, text))
    initials = [r[:1] for _, r, _ in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:], strict=False))
    # what stands so far is one of: nothing, s, ...u, ...a
    best = {"": (0, "", [])}

    def grown(state, initial):
        return {"": "su", "s": "u", "u": "a", "a": "u"}[state].find(initial) >= 0 and initial != ""

    def offer(table, state, entry):
        if state not in table or entry[:2] < table[state][:2]:
            table[state] = entry

    def with_inserts(table):
        for _ in range(4):
            for state, (cost, done, kept) in list(table.items()):
                for initial, role in (("u", "user"), ("a", "assistant")):
                    if grown(state, initial):
                        offer(table, initial, (cost + 3, done + "I", [*kept, f"{role}:"]))
        return table

    for (_, role, text), fault in zip(rows, faults, strict=True):
        after = {}
        for state, (cost, done, kept) in with_inserts(best).items():
            offer(after, state, (cost + 4, done + "D", kept))
            if fault in ("blank", "duplicate"):
                continue
            more = 3 if fault == "truncated" else 0
            if grown(state, role[:1]):
                offer(after, role[0], (cost + more, done + "K", [*kept, f"{role}:{text}"]))
            for initial, name in (("u", "user"), ("a", "assistant")):
                if grown(state, initial):
                    offer(after, initial, (cost + 3 + more, done + "R", [*kept, f"{name}:{text}"]))
        best = after
    ends = [e for state, e in with_inserts(best).items() if state in ("", "a")]
    cost, audit, kept = min(ends)
    digest = hashlib.sha256("\n".join(kept).encode()).hexdigest()
    return (gaps, *(faults.count(f) for f in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest)


def damage(rows: list[tuple]) -> list[tuple]:
    """The contract's damage of (conv_id, turn, role, text) rows; dropped rows: no turn cell."""
    import zlib

    out = []
    for conv, turn, role, text in rows:
        role, text = (" " if x is None else x for x in (role, text))
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        kind = zlib.crc32(key.encode()) % 20
        if kind == 0:
            out.append((conv,))
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def repeated_strings(texts: list, width: int = 200) -> list[tuple]:
    """By text: bytes, removed bytes, removed runs, and what is kept."""
    data = [(t or "").encode() for t in texts]
    counts = Counter(d[i : i + width] for d in data for i in range(len(d) - width + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - width + 1):
            if counts[d[i : i + width]] > 1:
                gone[i : i + width] = b"\1" * width
        kept = bytes(b for b, g in zip(d, gone, strict=True) if not g)
        runs = sum(g and not (i and gone[i - 1]) for i, g in enumerate(gone))
        out.append((len(d), sum(gone), runs, kept))
    return out
