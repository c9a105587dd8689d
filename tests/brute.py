"""Plain Python forms of the jobs, for small fixtures."""

import re
from collections import Counter, defaultdict
from math import exp, log10


def tokens(line):
    words = (re.sub(r"^[^a-z]+|[^a-z]+$", "", w.lower()) for w in re.split(r"[ \t\n\r\f]+", line))
    return [w for w in words if w]


def distinct(words):
    return list(dict.fromkeys(words))


def bigrams(lines):
    return Counter(pair for line in lines for pair in zip(tokens(line), tokens(line)[1:]))


def pmi(lines, threshold, limit=None, multi=False):
    single, pairs = Counter(), Counter()
    for line in lines:
        words = distinct(tokens(line)[:limit])
        if not multi or len(tokens(line)) > 1:
            single.update(words)
        pairs.update((x, y) for x in words for y in words if x != y)
    return {
        (x, y): (log10(n * len(lines) / (single[x] * single[y])), n) for (x, y), n in pairs.items() if n >= threshold
    }


def ranks(nodes, edges, sources, steps, alpha=0.15):
    sources = set(sources)
    out = defaultdict(list)
    for src, dst in edges:
        out[src].append(dst)
    rank = {v: (1 / len(sources) if v in sources else 0.0) for v in nodes}
    for _ in range(steps):
        mass = defaultdict(float)
        for v in nodes:
            targets = out[v] or sorted(sources)
            for target in targets:
                mass[target] += rank[v] / len(targets)
        rank = {v: (1 - alpha) * mass[v] + (alpha / len(sources) if v in sources else 0.0) for v in nodes}
    return rank


def online(instances, delta=0.002):
    weights = {}
    for label, features in instances:
        probability = 1 / (1 + exp(-sum(weights.get(f, 0.0) for f in features)))
        for f in features:
            weights[f] = weights.get(f, 0.0) + (label - probability) * delta
    return weights


def postfix(query, words):
    stack = []
    for token in query.split():
        if token == "AND":
            right, left = stack.pop(), stack.pop()
            stack.append(left and right)
        elif token == "OR":
            right, left = stack.pop(), stack.pop()
            stack.append(left or right)
        else:
            stack.append(token in words)
    return stack.pop()
