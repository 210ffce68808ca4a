"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import math
import re
from collections import Counter, defaultdict

LOWER = {c: c + 32 for c in range(65, 91)}
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def spaced(text):
    return SPACED.findall((text or "").translate(LOWER))


def alnum(text):
    return ALNUM.findall((text or "").translate(LOWER))


def components(nodes, links):
    up = {n: n for n in nodes}

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingles(text):
    w = spaced(text)
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def near_duplicates(rows):
    """{id: (set size, component)} for rows (id, text) with distinct ids."""
    sets = {i: shingles(t) for i, t in rows}
    ids = sorted(sets)
    links = [(a, b) for k, a in enumerate(ids) for b in ids[k + 1:]
             if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    label = components(ids, links)
    return {i: (len(sets[i]), label[i]) for i in ids}


def units(text, span=12):
    """[(start, end, words, whether a sentence ends)]: from the token list, sentence by sentence."""
    tokens = [m for m in re.finditer(r"[ \t\n\r\f\v]*[^ \t\n\r\f\v]+[ \t\n\r\f\v]*", text)]
    words = [m.group().strip(" \t\n\r\f\v").lower() for m in tokens]
    ranks = [(-len(w.encode()), w.encode()) for w in words]
    ends = [k for k, m in enumerate(tokens) if re.search(r"([.!?][ \t\n\r\f\v]+|\n[ \t\n\r\f\v]*)\Z", m.group())]
    cuts, begin = set(ends), 0
    for stop in [*(e + 1 for e in ends), len(tokens)]:
        if stop - begin > span:
            for i in range(begin, stop - span + 1):
                least = min(ranks[i:i + span])
                cuts.add(max(k for k in range(i, i + span) if ranks[k] == least))
        begin = stop
    out, begin = [], 0
    for stop in sorted({c + 1 for c in cuts} | {len(tokens)} - {0}):
        out.append((tokens[begin].start(), tokens[stop - 1].end(), words[begin:stop], stop - 1 in ends or stop == len(tokens)))
        begin = stop
    return out


def without_repeats(rows, min_words=25):
    """[(id, text, spans)] for rows (id, text), in their order."""
    first, found = {}, {}
    for i, t in sorted((r for r in rows if r[1]), key=lambda r: r[0]):
        u = units(t, min_words // 2)
        size = lambda a, b: sum(len(x[2]) for x in u[a:b])
        parts = {(a, b) for a in range(len(u)) for b in range(a + 1, min(len(u), a + min_words) + 1) if size(a, b) >= min_words
                 and (size(a, b - 1) < min_words or u[b - 1][3] and size(a + 1, b) < min_words)}
        # The first from a unit on, the last up to the end of a sentence.
        for a, b in sorted(parts or ({(0, len(u))} if u else ())):
            content = tuple(w for x in u[a:b] for w in x[2])
            first.setdefault(content, (i, a))
            if first[content] != (i, a):
                found.setdefault(i, []).append((u[a][0], u[b - 1][1]))
    out = []
    for i, t in rows:
        gone = {p for a, b in found.get(i, []) for p in range(a, b)}
        spans = [(p, min(q for q in range(p, len(t) + 1) if q not in gone)) for p in sorted(gone) if p - 1 not in gone]
        out.append((i, "".join(c for p, c in enumerate(t) if p not in gone) if t else t, spans))
    return out


def contamination(text, items):
    """(words, hit words, sorted items) of a text; items: [(id, text)]."""
    w, hit, found = alnum(text), set(), set()
    for item, t in items:
        v = alnum(t)
        for i in range(max(1, len(v) - 12) if v else 0):
            x = v[i:i + 13]
            for k in range(len(w) - len(x) + 1):
                if w[k:k + len(x)] == x:
                    hit.update(range(k, k + len(x)))
                    found.add(str(item))
    return len(w), len(hit), sorted(found)


def unit(*parts):
    return int(hashlib.md5("|".join(map(str, parts)).encode()).hexdigest()[:13], 16) / 2 ** 52


def poisson(rate, seed, key):
    parts = max(1, math.ceil(rate / 16))
    lam, total = rate / parts, 0
    for j in range(1, parts + 1):
        u, p, k = unit(seed, key, j), math.exp(-rate / parts), 0
        c = p
        while c <= u and k < 80:
            k += 1
            p *= lam / k
            c += p
        total += k if c > u else k + 1
    return total


def mix_counts(rows, seed=11):
    """Counter of copies for rows (id, source), weighted by the roots of the sources' sizes."""
    n = Counter(s for _, s in rows)
    w = sum(math.sqrt(x) for x in n.values())
    return {i: poisson(math.sqrt(n[s]) / w * len(rows) / n[s], seed, i) for i, s in rows}


def ngram_counts(rows):
    one, two = Counter(), defaultdict(int)
    for t in rows:
        w = [*spaced(t), 0]
        one.update(w)
        for u, v in zip([0, *w], w):
            two[u, v] += 1
    return one, two
