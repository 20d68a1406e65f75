"""Plain versions that the operators are held against."""

from __future__ import annotations

import itertools
import math
import re
import zlib
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
FOLD = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def words(text, lower=False):
    text = text or ""
    return WORD.findall(text.translate(FOLD) if lower else text)


def last_null(i):
    return (i is None, i)


def near(docs, n, percent=80):
    """id -> (set size, component)"""
    sets = {}
    for i, t in docs:
        w = words(t, lower=True)
        sets[i] = frozenset(zip(*[w[k:] for k in range(n)])) if len(w) >= n else frozenset([tuple(w)] if w else [])
    parent = {i: i for i in sets}

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for a, b in itertools.combinations(sets, 2):
        c = len(sets[a] & sets[b])
        if c and 100 * c >= percent * (len(sets[a]) + len(sets[b]) - c):
            x, y = sorted((find(a), find(b)), key=last_null)
            parent[y] = x
    return {i: (len(s), find(i)) for i, s in sets.items()}


def repeats(docs, length):
    """(id, words, removed, kept text) in the order of ids"""
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda d: last_null(d[0])):
        w = words(t)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            x = tuple(w[k : k + length])
            if x in seen:
                gone[k : k + length] = [True] * length
            seen.add(x)
        out.append((i, len(w), sum(gone), " ".join(a for a, g in zip(w, gone) if not g)))
    return out


def luhn(digits):
    total = 0
    for k, c in enumerate(digits[::-1]):
        x = int(c)
        total += (x * 2 - 9 if x > 4 else x * 2) if k % 2 else x
    return total % 10 == 0


def private(text):
    out = [(0, *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(x) <= 255 for x in m.group().split(".")):
            out.append((1, *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        if 13 <= len(digits) <= 19 and luhn(digits):
            out.append((2, *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            out.append((3, *m.span()))
    return out


def discovered(seeds, others, allowed, rounds, support, trust, sure):
    """literal -> kind, from lists of (pattern, literal, kind) of seeds and (pattern, literal) of other tokens."""
    seeds, others = set(seeds), {e for e in others if e[0] in {p for p, *_ in seeds}}
    count = Counter((p, k) for p, _, k in seeds)
    size = Counter(p for p, _ in {(p, x) for p, x, _ in seeds} | others)
    strong = {e: n for e, n in count.items() if n >= support}
    belief = {}
    for _ in range(rounds):
        rate = {}
        for (p, k), n in strong.items():
            mass = n + sum(belief.get((x, k), 0.0) for q, x in others if q == p)
            if mass / (size[p] + 1) >= trust:
                rate[p, k] = mass / (size[p] + 1)
        doubt = defaultdict(lambda: 1.0)
        for p, x in others:
            for k in range(4):
                if (p, k) in rate:
                    doubt[x, k] *= 1 - min(rate[p, k], 0.999)
        belief = {(x, k): 1 - d for (x, k), d in doubt.items() if allowed(x, k)}
    best = {}
    for (x, k), b in sorted(belief.items(), key=lambda e: (e[1], -e[0][1])):
        if b >= sure:
            best[x] = k
    return best


def held_out(i):
    return zlib.crc32(str(i).encode()) % 7 == 2


def context_tree(docs, depth):
    """id -> (held out, tokens, known, training tokens, base score, score)"""
    counts = defaultdict(lambda: [0, 0])

    def steps(text):
        data = bytes([255] * depth) + " ".join(words(text, lower=True)).encode() + b"\xff"
        for i in range(depth, len(data)):
            node = 1
            for k in range(7, -1, -1):
                bit = (data[i] >> k) & 1
                yield [(data[i - d : i], node) for d in range(depth + 1)], bit
                node = node * 2 + bit

    vocabulary = Counter()
    for i, t in docs:
        if not held_out(i):
            vocabulary.update([*words(t, lower=True), None])
            for path, bit in steps(t):
                for n in path:
                    counts[n][bit] += 1

    def estimate(a, b):
        return math.lgamma(a + 0.5) + math.lgamma(b + 0.5) - math.lgamma(a + b + 1) - math.log(math.pi)

    below, lead = defaultdict(float), {}
    for d in range(depth, -1, -1):
        for (context, node), (a, b) in [x for x in counts.items() if len(x[0][0]) == d]:
            e, k = estimate(a, b), below[context, node]
            lead[context, node] = e - k
            w = e if d == depth else max(e, k) + math.log1p(math.exp(-abs(e - k))) - math.log(2)
            if d:
                below[context[1:], node] += w
    total, kinds, out = sum(vocabulary.values()), len(vocabulary), {}
    for i, t in docs:
        score = 0.0
        for path, bit in steps(t):
            p = None
            for n in reversed(path):
                c = counts.get(n, (0, 0))
                own = (c[bit] + 0.5) / (sum(c) + 1)
                share = 1 / (1 + math.exp(-max(-700.0, min(700.0, lead.get(n, 0.0)))))
                p = own if p is None else share * own + (1 - share) * p
            score += math.log10(p)
        w = [*words(t, lower=True), None]
        base = sum(math.log10((vocabulary[x] + 1) / (total + kinds + 1)) for x in w)
        out[i] = (held_out(i), len(w), sum(vocabulary[x] > 0 for x in w), total, base, score)
    return out


def tiles(item, text, least):
    free_a, free_b, out = [x >= 0 for x in item], [x >= 0 for x in text], []
    while True:
        best, found = 0, []
        for i in range(len(item)):
            for j in range(len(text)):
                k = 0
                while i + k < len(item) and j + k < len(text) and free_a[i + k] and free_b[j + k] and item[i + k] == text[j + k]:
                    k += 1
                if k > best:
                    best, found = k, [(i, j)]
                elif k and k == best:
                    found.append((i, j))
        if best < least:
            return out
        for i, j in found:
            if all(free_a[i : i + best]) and all(free_b[j : j + best]):
                free_a[i : i + best] = free_b[j : j + best] = [False] * best
                out.append((i, j, best))
