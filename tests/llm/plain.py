"""Brute-force versions of what the operators of ticketmill.llm compute."""

from __future__ import annotations

import re
import zlib

import numpy as np
import xxhash

ODD_TEXTS = [
    None,
    "",
    " ",
    "\n\n",
    "a",
    "word",
    " lead and trail ",
    "é à ü",
    "x  y  z",
    "same line\nsame line\nsame line",
    "one two three one two three one two three",
    "日本 語",
    "<|endoftext|> <s> </s> [INST]",
    "w" * 5000,
    "long text here. " * 6000,
]


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def words(text: str | None) -> list[str]:
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def simhash(text: str | None, width: int = 4) -> int:
    own = words(lower(text))
    shingles = [" ".join(own[i : i + width]) for i in range(max(1, len(own) - width + 1))] if own else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def near_duplicates(rows: list[tuple[int | None, str | None]], bits: int = 4) -> list[tuple]:
    prints = [simhash(text) for _, text in rows]
    array, parent = np.array(prints, np.uint64), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in np.flatnonzero(np.bitwise_count(array[:i] ^ array[i]) <= bits).tolist():
            parent[root(i)] = root(j)
    groups: dict[int, list] = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    return [
        (doc, format(prints[i], "016x"), min((x for x in groups[root(i)] if x is not None), default=None))
        for i, (doc, _) in enumerate(rows)
    ]


def hits(texts: list[str | None], items: list[tuple], window: int = 10) -> list[tuple]:
    def split(text):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(text))

    out = []
    for text in texts:
        own, hit, found = split(text), set(), set()
        for name, item in items:
            there = split(item)
            for i in range(max(1, len(there) - window + 1) if there else 0):
                phrase = there[i : i + window]
                for j in range(len(own) - len(phrase) + 1):
                    if own[j : j + len(phrase)] == phrase:
                        hit |= set(range(j, j + len(phrase)))
                        found.add(name)
        out.append((len(own), len(hit), found))
    return out


def pieces(tokenizer, text: str | None, capacity: int = 1024) -> list[tuple]:
    ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
    first = len(ids) % capacity or capacity
    edges = [0, *range(first, len(ids), capacity), len(ids)]
    return [
        (k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes()))
        for k, (a, b) in enumerate(zip(edges, edges[1:]))
    ]


def repeated_words(text: str | None) -> int:
    own = words(text)
    windows = [tuple(own[i : i + 3]) for i in range(len(own) - 2)]
    covered = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(covered)


def cross_parse(text: str, known: str) -> int:
    """Phrases of the greedy parse; what isn't in known at all is a phrase of one character."""
    count, at = 0, 0
    while at < len(text):
        end = at + 1
        if text[at] in known:
            while end < len(text) and text[at : end + 1] in known:
                end += 1
        count, at = count + 1, end
    return count


def shingle_sets(texts: list[str | None], width: int) -> list[frozenset]:
    out = []
    for text in texts:
        own = words(lower(text))
        out.append(frozenset(tuple(own[i : i + width]) for i in range(max(1, len(own) - width + 1)) if own))
    return out


def jaccard_components(rows: list[tuple[int | None, str | None]], width: int, similarity: int) -> list[tuple]:
    sets, parent = shingle_sets([text for _, text in rows], width), list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= similarity * len(a | b):
                parent[root(i)] = root(j)
    groups: dict[int, list] = {}
    for i, (doc, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc)
    return [
        (doc, len(sets[i]), min((x for x in groups[root(i)] if x is not None), default=None))
        for i, (doc, _) in enumerate(rows)
    ]


SPACES = " \t\n\x0b\x0c\r"


def damaged(rows: list[tuple]) -> list[tuple]:
    """(conv, turn, role, text) of each conversation's rows after damage, in order."""
    rows = sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0))
    out = []
    for conv, turn, role, text in rows:
        way = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if way == 1:
            text = ""
        if way == 2:
            text = re.sub("[.!?]", "", text)
        if way == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if way == 0 else 2 if way == 3 else 1)
    return out


def repair(rows: list[tuple]) -> tuple:
    """(gaps, blank, duplicate, truncated, illegal, cost, audit, repaired lines) of one conversation's rows in
    order, by a search over all edits in order of cost, then of their text."""
    import heapq

    seen, faults = set(), []
    for _, _, role, text in rows:
        bare = text.rstrip(SPACES)
        fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else ""
        seen.add((role, text))
        faults.append(fault)
    turns = [r[1] for r in rows if r[1] is not None]
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    initials = [r[2][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:]))
    follow = {"": "su", "s": "u", "u": "a", "a": "u"}
    heap, done = [(0, "", 0, "", ())], set()
    while heap:
        cost, audit, i, last, said = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            break
        for r, name in (("u", "user"), ("a", "assistant")):
            if r in follow[last]:
                heapq.heappush(heap, (cost + 3, audit + "I", i, r, (*said, f"{name}:")))
                if i < len(rows) and faults[i] not in ("blank", "duplicate"):
                    more = 3 if faults[i] else 0
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, r, (*said, f"{name}:{rows[i][3]}")))
        if i < len(rows):
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, said))
            own = initials[i]
            if own and own in follow[last] and faults[i] not in ("blank", "duplicate"):
                more = 3 if faults[i] else 0
                heapq.heappush(heap, (cost + more, audit + "K", i + 1, own, (*said, f"{rows[i][2]}:{rows[i][3]}")))
    count = [faults.count(f) for f in ("blank", "duplicate", "truncated")]
    return (gaps, *count, illegal, cost, audit, "\n".join(said))
