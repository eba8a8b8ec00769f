"""Plain versions of the operators, for small inputs."""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter, defaultdict


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def least_reachable(ids, links):
    parent = {i: i for i in ids}

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {i: top(i) for i in ids}


def jaccard_components(rows, n, num, den):
    sets = {}
    for i, t in rows:
        w = words(t)
        sets[i] = {tuple(w[k : k + n]) for k in range(max(1, len(w) - n + 1))} if w else set()
    links = [(a, b) for a in sets for b in sets if a < b and sets[a] and sets[b] and den * len(sets[a] & sets[b]) >= num * len(sets[a] | sets[b])]
    return {i: len(s) for i, s in sets.items()}, least_reachable(sets, links)


def katz(rows, modulus=7, held_out=2, k=5, tail=0.1, held=None):
    """held: the ids that don't train, where it isn't their remainder that says so."""
    end, begin = 0, 1
    out_ = lambda i: i in held if held is not None else i is not None and zlib.crc32(str(i).encode()) % modulus == held_out
    docs = [(i, out_(i), words(t) + [end]) for i, t in rows]
    counts = [Counter(), Counter(), Counter()]  # of words, and of successors in a context of one and of two
    for _, held_, w in docs:
        if not held_:
            counts[0].update(w)
            counts[1].update(((v,), x) for v, x in zip([begin, *w], w))
            counts[2].update(((u, v), x) for u, v, x in zip([begin, *w], w, w[1:]))
    one = counts[0]
    total, types = sum(one.values()), len(one)

    def discounts(counted):
        n = Counter(counted.values())
        d = {r: 1 - 0.5 / r for r in range(1, k + 1)}
        if n[1]:
            a = (k + 1) * n[k + 1] / n[1]
            for r in range(1, k + 1):
                if n[r] and a < 1:
                    x = ((r + 1) * n[r + 1] / n[r] / r - a) / (1 - a)
                    if 0 < x < 1:
                        d[r] = x
        # where no count is discounted, all lose the tail
        return lambda c, of: c - tail * (min(of) > k) if c > k else d[c] * c

    discount = [discounts(c) for c in counts]
    ones = list(one.values())
    unknown = 1 - sum(discount[0](c, ones) for c in ones) / total if total else 1.0
    after = defaultdict(dict)
    for level in (1, 2):
        for (context, w), c in counts[level].items():
            after[context][w] = c

    def p(context, w):
        if not context:
            return discount[0](one[w], ones) / total if one[w] else unknown
        seen, d = after.get(context, {}), discount[len(context)]
        times = sum(seen.values())
        if not times:
            return p(context[1:], w)
        if w in seen:
            return d(seen[w], seen.values()) / times
        return p(context[1:], w) * (1 - sum(d(c, seen.values()) for c in seen.values()) / times) / (1 - sum(p(context[1:], x) for x in seen))

    cached = {}

    def conditional(context, w):
        if (context, w) not in cached:
            cached[context, w] = p(context, w)
        return cached[context, w]

    out = {}
    for i, held_, w in docs:
        logs = [math.log10(conditional((begin, *w)[max(0, j - 1) : j + 1], x)) for j, x in enumerate(w)]
        out[i] = (held_, len(w), sum(one[x] > 0 for x in w), total, sum(math.log10((one[x] + 1) / (total + types + 1)) for x in w), sum(logs))
    return out, conditional, one


def slot(number, n, key, rounds=6):
    """Where the keyed network puts a sequence: one number at a time, walking until it is below n."""
    half = 1
    while 4**half < n:
        half += 1
    x = number
    while True:
        left, right = divmod(x, 2**half)
        for k in range(rounds):
            h = (right + key + k * 0x9E3779B97F4A7C15) * 0xBF58476D1CE4E5B9 % 2**64
            h = (h ^ h >> 31) * 0x94D049BB133111EB % 2**64
            left, right = right, left ^ (h ^ h >> 29) % 2**half
        x = left * 2**half + right
        if x < n:
            return x
