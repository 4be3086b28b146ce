"""Plain and slow versions of the operators, for small inputs."""

from __future__ import annotations

import hashlib
import re
from collections import Counter, defaultdict

SPACE = " \t\n\x0b\x0c\r"


def ascii_lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def kept_lines(docs):
    """{doc_id: (lines, dropped, kept)} of {doc_id: text}."""
    lines = {d: (t or "").split("\n") for d, t in docs.items()}
    key = lambda line: ascii_lower(line.strip(SPACE))
    owner = {}
    for d in sorted(lines):
        for line in lines[d]:
            owner.setdefault(key(line), d)
    result = {}
    for d, own in lines.items():
        kept = [line for line in own if len(key(line)) < 10 or owner[key(line)] == d]
        result[d] = (len(own), len(own) - len(kept), "\n".join(kept))
    return result


def kept_words(docs, window=35):
    places = Counter()
    cut = [(d, words(t)) for d, t in docs]
    for _, own in cut:
        for i in range(len(own) - window + 1):
            places[tuple(own[i : i + window])] += 1
    result = []
    for d, own in cut:
        gone = set()
        for i in range(len(own) - window + 1):
            if places[tuple(own[i : i + window])] > 1:
                gone.update(range(i, i + window))
        result.append((d, len(own), len(gone), " ".join(w for i, w in enumerate(own) if i not in gone)))
    return result


def shingles(text, n):
    own = words(ascii_lower(text or ""))
    if not own:
        return frozenset()
    return frozenset(tuple(own[i : i + n]) for i in range(max(1, len(own) - n + 1)))


def components(docs, n, percent):
    """{doc_id: least doc_id that links reach}."""
    sets = {d: shingles(t, n) for d, t in docs.items()}
    links = defaultdict(set)
    for a in sets:
        for b in sets:
            common = len(sets[a] & sets[b])
            if a != b and common and 100 * common >= percent * len(sets[a] | sets[b]):
                links[a].add(b)
    result = {}
    for d in sorted(sets):
        if d in result:
            continue
        stack = [d]
        while stack:
            at = stack.pop()
            if at not in result:
                result[at] = d
                stack.extend(links[at])
    return result


def contaminated(docs, items):
    """{doc_id: (words, hit, item ids as strings, contaminated)}."""
    cut = lambda text: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    windows = defaultdict(set)
    for item, text in items:
        own = cut(text)
        n = min(13, len(own))
        for i in range(len(own) - n + 1 if own else 0):
            windows[tuple(own[i : i + n])].add(item)
    result = {}
    for d, text in docs.items():
        own, hit, found = cut(text), set(), set()
        for window, ids in windows.items():
            for i in range(len(own) - len(window) + 1):
                if tuple(own[i : i + len(window)]) == window:
                    hit.update(range(i, i + len(window)))
                    found |= ids
        names = sorted(str(i) for i in found if i is not None)
        result[d] = (len(own), len(hit), names, len(hit) > 0 and 20 * len(hit) >= len(own))
    return result
