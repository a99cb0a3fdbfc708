"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import xxhash

SPACE_WORD = re.compile(rb"[^\x20\x09-\x0D]+")


def lower(text):
    return re.sub(rb"[A-Z]", lambda m: m.group().lower(), (text or "").encode())


def classes(n, links):
    """The smallest member of each one's class."""
    label = list(range(n))

    def find(x):
        while label[x] != x:
            label[x] = label[label[x]]
            x = label[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        label[max(a, b)] = min(a, b)
    return [find(i) for i in range(n)]


def fingerprint(text):
    w = SPACE_WORD.findall(lower(text))
    grams = [b" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
    h = [xxhash.xxh64(g, seed=42).intdigest() for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def simhash(docs, radius=2):
    """{id: (hex, component)} of ``[(id, text)]``."""
    docs = sorted(docs)
    prints = [fingerprint(t) for _, t in docs]
    links = [(i, j) for i in range(len(docs)) for j in range(i) if (prints[i] ^ prints[j]).bit_count() <= radius]
    return {docs[i][0]: (f"{prints[i]:016x}", docs[c][0]) for i, c in enumerate(classes(len(docs), links))}


def near_lines(docs, shingle=8, threshold=0.8):
    """``(kept, ambiguous)``: {id: line numbers that go} of ``[(id, text)]``, and the ids of documents where two
    near-duplicate lines of the first document compete."""
    place = defaultdict(list)
    for i, t in sorted(docs):
        for k, line in enumerate((t or "").split("\n")):
            if line.strip(" \t\r"):
                place[line.strip(" \t\r")].append((i, k))
    lines = list(place)
    sets = [{x[k : k + shingle] for k in range(max(1, len(x) - shingle + 1))} for x in lines]
    links = [(i, j) for i in range(len(lines)) for j in range(i) if len(sets[i] & sets[j]) >= threshold * len(sets[i] | sets[j])]
    by = defaultdict(list)
    for i, c in enumerate(classes(len(lines), links)):
        by[c].append(i)
    gone, unclear = defaultdict(set), set()
    for members in by.values():
        first = min(place[lines[i]][0][0] for i in members)
        best = [i for i in members if place[lines[i]][0][0] == first]
        unclear |= {first} if len(best) > 1 else set()
        for i in members:
            for d, k in place[lines[i]]:
                if len(best) > 1 or (d, k) != place[lines[best[0]]][0]:
                    gone[d].add(k)
    return gone, unclear


def language_model(docs, order):
    """Scores of an interpolated modified Kneser-Ney model of ``[(id, text, learn)]``."""
    tokens = [[*SPACE_WORD.findall(lower(t)), b"\n"] for _, t, _ in docs]
    grams = [Counter() for _ in range(order + 1)]
    for w, (_, _, learn) in zip(tokens, docs):
        if learn:
            w = [b"\t"] * (order - 1) + w
            grams[order].update(tuple(w[k - order + 1 : k + 1]) for k in range(order - 1, len(w)))
    for k in range(order - 1, 0, -1):
        grams[k].update(g[1:] for g in grams[k + 1])
    count = Counter(x for w, d in zip(tokens, docs) if d[2] for x in w)
    n, v = sum(count.values()), len(count)

    def discounts(c):
        a, b, c3, d = (sum(x == k for x in c.values()) for k in (1, 2, 3, 4))
        y = a / (a + 2 * b) if a and b else 0.5
        out = [1 - 2 * y * b / a if a else 0.5, 2 - 3 * y * c3 / b if b else 1.0, 3 - 4 * y * d / c3 if c3 else 1.5]
        return [0.0] + [min(max(x, 0.05), k - 0.05) for x, k in zip(out, (1, 2, 3))]

    ds = [None] + [discounts(c) for c in grams[1:]]
    total, spare = [Counter() for _ in range(order + 1)], [Counter() for _ in range(order + 1)]
    for k in range(1, order + 1):
        for g, c in grams[k].items():
            total[k][g[:-1]] += c
            spare[k][g[:-1]] += ds[k][min(c, 3)]

    def p(g):
        k = len(g)
        low = p(g[1:]) if k > 1 else 1 / (v + 1)
        if not total[k][g[:-1]]:
            return low
        c = grams[k][g]
        return (c - ds[k][min(c, 3)] + spare[k][g[:-1]] * low) / total[k][g[:-1]]

    out = {}
    for w, (i, _, _) in zip(tokens, docs):
        padded = [b"\t"] * (order - 1) + w
        score = sum(math.log10(p(tuple(padded[k - order + 1 : k + 1]))) for k in range(order - 1, len(padded)))
        base = sum(math.log10((count[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        out[i] = (len(w), sum(count[x] > 0 for x in w), n, base, score)
    return out


def warc(pages):
    """{id: (bytes, digest, type, refers)} of ``[(id, html)]``."""
    out, first = {}, {}
    for i, h in sorted(pages):
        raw = (h or "").encode()
        digest = hashlib.sha256(raw).hexdigest()
        seen = first.setdefault(raw, i) if len(raw) >= 100 else i
        out[i] = (len(raw), digest, "response" if seen == i else "revisit", None if seen == i else seen)
    return out


def learned(doc_id, mod, rest):
    return zlib.crc32(str(doc_id).encode()) % mod != rest
