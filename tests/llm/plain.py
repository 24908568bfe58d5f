"""The operators in plain Python, for small tables."""

import hashlib
import math
import re
from collections import Counter

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
BENCH = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
KINDS = (("assign", r"(?i:password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 1, 6), ("access", "AKIA[A-Z0-9]+", 0, 20), ("hex", "[0-9a-f]+", 0, 24))


def rules(text):
    """The measurements of a text, and whether it passes."""
    text = text or ""
    w = WORD.findall(text)
    n = len(w)
    windows = [tuple(w[i : i + 8]) for i in range(n - 7)]
    often = Counter(windows)
    covered = {p for i, x in enumerate(windows) if often[x] > 1 for p in range(i, i + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    m = {"n_words": n, "word_chars": sum(map(len, w)), "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)), "n_repeat_words": len(covered), "n_stutter": sum(a == b for a, b in zip(w, w[1:]))}
    base = n < 20 or 100 * len(covered) > 30 * n
    more = 100 * m["n_symbols"] > 20 * n or 100 * m["n_dup_lines"] > 40 * len(lines) or 100 * m["n_stutter"] > 30 * n or not 2 * n <= m["word_chars"] <= 16 * n
    return m, base, not (base or more)


def fingerprint(text):
    w = WORD.findall((text or "").translate(LOWER))
    h = [xxhash.xxh64_intdigest(" ".join(w[i : i + 4]).encode(), 42) for i in range(max(1, len(w) - 3))] if w else []
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def components(nodes, edges):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def near_duplicates(docs):
    """Of (id, text) rows: id to (fingerprint, component)."""
    fps = [(i, fingerprint(t)) for i, t in docs]
    edges = [(a, b) for k, (a, x) in enumerate(fps) for b, y in fps[k + 1 :] if (x ^ y).bit_count() <= 4]
    c = components([i for i, _ in fps], edges)
    return {i: (f, c[i]) for i, f in fps}


def contamination(docs, items):
    """Of (id, text) rows: a list of (id, n_words, n_hit, item ids)."""
    windows = {}
    for i, t in items:
        w = BENCH.findall((t or "").translate(LOWER))
        for k in range(max(1, len(w) - 7) if w else 0):
            windows.setdefault(tuple(w[k : k + 8]), set()).add(i if i is None else str(i))
    out = []
    for i, t in docs:
        w = BENCH.findall((t or "").translate(LOWER))
        hit, found = set(), set()
        for n in {len(x) for x in windows}:
            for k in range(len(w) - n + 1):
                if (x := windows.get(tuple(w[k : k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= x
        out.append((i, len(w), len(hit), sorted(found - {None})))
    return out


def spans(text):
    return sorted((m.start(), no, kind, m.end()) for no, (kind, p, g, least) in enumerate(KINDS) for m in re.finditer(p, text or "") if len(m.group(g)) >= least)


def redacted(text, found, mark="[SECRET]"):
    marked = [False] * len(text)
    for s, _, _, e in found:
        marked[s:e] = [True] * (e - s)
    out = ""
    for i, c in enumerate(text):
        out += c if not marked[i] else mark if i == 0 or not marked[i - 1] else ""
    return out


def mixture(docs, seed=20, temperature=0.5):
    """Of (id, source, text) rows: a list of (id, replica, key), in order."""
    sizes = Counter()
    for _, s, t in docs:
        sizes[s] += len(t or "")
    weight = {s: n**temperature for s, n in sizes.items()}
    hashed = lambda *parts: int(hashlib.md5(":".join(map(str, parts)).encode()).hexdigest()[:13], 16)
    out = []
    for i, s, _ in docs:
        rate = weight[s] / sum(weight.values()) * sum(sizes.values()) / sizes[s] if sizes[s] else 0.0
        parts = max(1, math.ceil(rate / 64))
        n = 0
        for j in range(1, parts + 1):
            u, k, p = (hashed(seed, j, i) + 0.5) / 2**52, 0, math.exp(-rate / parts)
            c = p
            while c <= u and k < 1000:
                k += 1
                p *= rate / parts / k
                c += p
            n += k
        out += [(i, r, hashed(seed, "order", i, r)) for r in range(1, n + 1)]
    return sorted(out, key=lambda x: x[2])


def discounted(counts):
    """What modified Kneser-Ney takes off each count, from the counts of counts."""
    a, b, c, d = (max(1, sum(x == k for x in counts)) for k in (1, 2, 3, 4))
    y = a / (a + 2 * b)
    off = [0, *(min(max(x, 0.05), most) for x, most in ((1 - 2 * y * b / a, 0.95), (2 - 3 * y * c / b, 1.9), (3 - 4 * y * d / c, 2.8)))]
    return lambda x: off[min(x, 3)]


def suffix_tree(learn, depth=7, fewest=4, divergence=10.0):
    """Of texts: a function from (bytes before, byte) to its probability."""
    count = [{} for _ in range(depth + 1)]
    for t in learn:
        s = b"\n" * depth + normal(t)
        for i in range(depth, len(s)):
            for d in range(depth + 1):
                of = count[d].setdefault(s[i - d : i], Counter())
                of[s[i]] += 1
    after = [{} for _ in range(depth + 1)]
    after[depth] = count[depth]
    for d in range(depth):
        for h, of in count[d + 1].items():
            mine = after[d].setdefault(h[1:], Counter())
            for x in of:
                mine[x] += 1
    off = [[discounted([n for of in table[d].values() for n in of.values()]) for d in range(depth + 1)] for table in (count, after)]

    def is_state(h):
        of = count[len(h)].get(h)
        if of is None or not h:
            return of is not None
        n, low = sum(of.values()), count[len(h) - 1][h[1:]]
        m = sum(low.values())
        return n >= fewest and sum(c * math.log(c / n / (low[x] / m)) for x, c in of.items()) >= divergence

    states = {h for d in range(depth + 1) for h in count[d] if is_state(h)}

    def p(h, x, raw):
        while h not in states and h:
            h = h[1:]
        if h not in states:
            return 1 / 256
        of, take = ((count if raw else after)[len(h)][h], off[0 if raw else 1][len(h)])
        lower = p(h[1:], x, False) if h else 1 / 256
        n = sum(of.values())
        return (of[x] - take(of[x]) + sum(map(take, of.values())) * lower) / n

    return lambda before, x: p(before[-depth:], x, True)


def normal(t):
    return b" ".join((t or "").encode().lower().split()) + b"\n"


def suffix_score(p, t, depth=7):
    s = b"\n" * depth + normal(t)
    return sum(math.log10(p(s[i - depth : i], s[i])) for i in range(depth, len(s)))
