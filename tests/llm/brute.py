"""Plain versions of the operators, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
PLAIN = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def spaced(text):
    return SPACED.findall(lower(text))


def plain(text):
    return PLAIN.findall(lower(text))


def simhash(text, k=3):
    words = spaced(text)
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components(n, links):
    parent = list(range(n))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in links:
        parent[root(a)] = root(b)
    return [root(x) for x in range(n)]


def near_components(prints, distance=3):
    return components(len(prints), [(i, j) for i in range(len(prints)) for j in range(i)
                                    if (prints[i] ^ prints[j]).bit_count() <= distance])


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]", "", text or "")


def windows(words, size=13):
    return {tuple(words[i:i + min(size, len(words))]) for i in range(max(1, len(words) - size + 1))} if words else set()


def contamination(text, items, size=13):
    """n_words, n_hit, items whose windows occur."""
    words, hit, found = plain(text), set(), set()
    for item, passage in items:
        for w in windows(plain(passage), size):
            for i in range(len(words) - len(w) + 1):
                if tuple(words[i:i + len(w)]) == w:
                    hit.update(range(i, i + len(w)))
                    found.add(str(item))
    return len(words), len(hit), sorted(found)


def phrase_places(text, phrases):
    words = plain(text)
    return len(words), sorted((i, label) for label, p in phrases for i in range(len(words))
                              if words[i:i + len(p.split())] == p.split())


def targets(sizes, weights, times):
    """Shares of all by weight, none above its size times ``times``, the excess dealt again until none is."""
    total, fixed = float(sum(sizes.values())), {}
    while True:
        left = total - sum(fixed.values())
        rest = sum(weights[s] for s in sizes if s not in fixed)
        above = [s for s in sizes if s not in fixed and left * weights[s] / rest >= times * sizes[s]]
        if not above:
            return {s: fixed.get(s, left * weights[s] / rest if rest else 0.0) for s in sizes}
        fixed.update({s: float(times * sizes[s]) for s in above})


def kneser_ney(train, texts):
    """log10 probabilities of texts under the interpolated modified bigram model, and under add-one unigrams."""
    tokens = [[*spaced(t), "\n"] for t in train]
    unigrams = Counter(w for t in tokens for w in t)
    bigrams = Counter(p for t in tokens for p in zip(["\n", *t], t))
    follows, context, kinds = Counter(w for _, w in bigrams), Counter(), defaultdict(Counter)
    for (h, _), c in bigrams.items():
        context[h] += c
        kinds[h][min(c, 3)] += 1

    def discounts(counts):
        n = [sum(1 for c in counts if c == k) for k in range(5)]
        if not (n[1] and n[2] and n[3]):
            return [0, 0.5, 1, 1.5]
        y = n[1] / (n[1] + 2 * n[2])
        return [0, *(min(max(k - (k + 1) * y * n[k + 1] / n[k], 0), k) for k in (1, 2, 3))]

    d2, d1 = discounts(bigrams.values()), discounts(follows.values())
    v, n, total = len(unigrams), sum(unigrams.values()), len(bigrams)
    spare = sum(d1[min(c, 3)] for c in follows.values()) / total if total else 1.0

    def own(w):
        return (max(follows[w] - d1[min(follows[w], 3)], 0) / total if total else 0) + spare / (v + 1)

    def both(h, w):
        if not context[h]:
            return own(w)
        c = bigrams[h, w]
        left = sum(d2[k] * kinds[h][k] for k in (1, 2, 3)) / context[h]
        return max(c - d2[min(c, 3)], 0) / context[h] + left * own(w)

    found = []
    for text in texts:
        t = [*spaced(text), "\n"]
        found.append((len(t), sum(1 for w in t if unigrams[w]), sum(math.log10((unigrams[w] + 1) / (n + v + 1)) for w in t),
                      sum(math.log10(both(h, w)) for h, w in zip(["\n", *t], t))))
    return found, (unigrams, both)


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()
