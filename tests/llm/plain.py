"""Plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SPACED = re.compile("[^\x20\x09-\x0d]+")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def spaced(text, lower=False):
    return SPACED.findall((text or "").translate(LOWER) if lower else text or "")


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def runs(words, n):
    return [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]


def shingle_set(text):
    words = spaced(text, lower=True)
    return frozenset(runs(words, 5) if len(words) >= 5 else [tuple(words)] if words else [])


def component_ids(rows):
    """Per row number: the smallest id reachable by links of similarity 0.75."""
    sets = [shingle_set(text) for _, text in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and 100 * len(a & b) >= 75 * len(a | b):
                parent[find(i)] = find(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        known = least.get(find(i))
        least[find(i)] = doc if known is None or (doc is not None and doc < known) else known
    return [(rows[i][0], len(sets[i]), least[find(i)]) for i in range(len(rows))]


def kept_words(rows, window=13):
    """Per row: id, words, words removed and the text that stays."""
    first = {}
    last = float("inf")
    for doc, text in rows:
        for run in runs(spaced(text), window):
            first[run] = min(first.get(run, last), last if doc is None else doc)
    out = []
    for doc, text in rows:
        words = spaced(text)
        gone = set()
        for i, run in enumerate(runs(words, window)):
            if first[run] < (last if doc is None else doc):
                gone.update(range(i, i + window))
        out.append((doc, len(words), len(gone), " ".join(w for i, w in enumerate(words) if i not in gone)))
    return out


def hits(rows, items, span=13):
    windows = defaultdict(set)
    for item, text in items:
        words = alnum(text)
        for run in runs(words, min(span, len(words))) if words else ():
            windows[run].add(item)
    sizes = {len(run) for run in windows}
    out = []
    for doc, text in rows:
        words, hit, found = alnum(text), set(), set()
        for n in sizes:
            for i, run in enumerate(runs(words, n)):
                if run in windows:
                    hit.update(range(i, i + n))
                    found.update(str(x) for x in windows[run] if x is not None)
        out.append((doc, len(words), len(hit), sorted(found), bool(hit) and 20 * len(hit) >= len(words)))
    return out


def repeated_words(words, window=8):
    counts = Counter(runs(words, window))
    return len({j for i, run in enumerate(runs(words, window)) if counts[run] > 1 for j in range(i, i + window)})


def backoff(rows, order=3, factor=0.4):
    """Per row: words, sum of logarithms, and how many words were found at each order."""
    import math

    texts = [spaced(text, lower=True) for _, text in rows]

    def counted(words):
        return Counter(run for n in range(1, order + 1) for run in runs(words, n))

    total = Counter()
    for words in texts:
        total.update(counted(words))
    size = sum(map(len, texts))
    out = []
    for words in texts:
        own, score, found = counted(words), 0.0, [0] * (order + 1)
        for i in range(len(words)):
            most = min(order, i + 1)
            for n in range(most, 0, -1):
                run = tuple(words[i - n + 1 : i + 1])
                if total[run] > own[run]:
                    base = total[run[:-1]] - own[run[:-1]] if n > 1 else size - len(words)
                    score += math.log((total[run] - own[run]) / base) + (most - n) * math.log(factor)
                    found[n] += 1
                    break
            else:
                score += (most - 1) * math.log(factor) - math.log(size - len(words) + 1)
                found[0] += 1
        out.append((len(words), round(score, 6), *found))
    return out
