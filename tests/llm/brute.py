"""Plain restatements of the operators' contracts, for small inputs."""

import hashlib
import math
import re
from collections import Counter, defaultdict

BLANK = re.compile(r"[^\x20\x09-\x0D]+")
LETTERS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UP = {c: c + 32 for c in range(65, 91)}


def words(text):
    return BLANK.findall(text or "")


def targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    """Reshare the excess by weight until no source is above its cap."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    out, free, left = {}, list(names), share * sum(sizes.values())
    while free:
        level = left / sum(w[s] for s in free)
        over = [s for s in free if w[s] * level > most * sizes[s]]
        if not over:
            return out | {s: w[s] * level for s in free}
        for s in over:
            out[s] = most * sizes[s]
            left -= out[s]
        free = [s for s in free if s not in over]
    return out


def hits(docs, items, n=10):
    """{row number: (n_words, n_hit, item ids)}."""
    grams = defaultdict(set)
    for item, text in items:
        w = LETTERS.findall((text or "").translate(UP))
        m = min(n, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            grams[tuple(w[i:i + m])].add("null" if item is None else str(item))
    lengths = {len(g) for g in grams}
    out = []
    for _, text in docs:
        w = LETTERS.findall((text or "").translate(UP))
        hit, found = set(), set()
        for m in lengths:
            for i in range(len(w) - m + 1):
                if (g := tuple(w[i:i + m])) in grams:
                    hit |= set(range(i, i + m))
                    found |= grams[g]
        out.append((len(w), len(hit), ",".join(sorted(found))))
    return out


def shingles(text, n=3):
    w = words((text or "").translate(UP))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + n]) for i in range(max(1, len(w) - n + 1)))


def components(docs, n=3, num=90, den=100):
    """[(n_shingles, smallest reachable id)] for rows (id, text)."""
    sets = [shingles(t, n) for _, t in docs]
    root = list(range(len(docs)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            b = sets[j]
            if a and b and den * len(a & b) >= num * len(a | b):
                root[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(docs):
        r = find(i)
        least[r] = min(least.get(r, d), d)
    return [(len(s), least[find(i)]) for i, s in enumerate(sets)]


def repeated_words(docs, n=35):
    """[(n_words, n_removed, kept_sha256)]."""
    all_words = [words(t) for _, t in docs]
    seen = Counter(tuple(w[i:i + n]) for w in all_words for i in range(len(w) - n + 1))
    out = []
    for w in all_words:
        gone = set()
        for i in range(len(w) - n + 1):
            if seen[tuple(w[i:i + n])] > 1:
                gone |= set(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def repeated_bytes(docs, n=50):
    """[(n_bytes, n_removed, n_spans, kept_sha256)]."""
    data = [(t or "").encode() for _, t in docs]
    first = {}
    for (d, _), b in zip(docs, data):
        for i in range(len(b) - n + 1):
            k = b[i:i + n]
            if k not in first or d < first[k]:
                first[k] = d
    out = []
    for (d, _), b in zip(docs, data):
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if first[b[i:i + n]] < d:
                gone[i:i + n] = b"\x01" * n
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone) if not g)).hexdigest()))
    return out


def text_counts(text, window=8):
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    text = text or ""
    w = words(text)
    lines = [x for x in text.split("\n") if words(x)]
    seen = Counter(tuple(w[i:i + window]) for i in range(len(w) - window + 1))
    rep = set()
    for i in range(len(w) - window + 1):
        if seen[tuple(w[i:i + window])] > 1:
            rep |= set(range(i, i + window))
    return len(w), sum(map(len, w)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(rep)


def common_lines(docs, share=0.05, least=10):
    """{(host, normalised line)} and, per row, (words in common lines, kept)."""
    host_docs, count = Counter(h for _, _, h in docs), Counter()
    norm = [[(" ".join(words(x.translate(UP))), len(words(x))) for x in (t or "").split("\n") if words(x)] for _, t, _ in docs]
    for (_, _, h), lines in zip(docs, norm):
        count.update({(h, x) for x, _ in lines})
    common = {k for k, c in count.items() if c > least and c > host_docs[k[0]] * share}
    out = []
    for (_, t, h), lines in zip(docs, norm):
        n, _, _, _, rep = text_counts(t)
        lost = sum(k for x, k in lines if (h, x) in common)
        failed = n < 20 or rep * 100 > 30 * n
        out.append((lost, failed, not failed and not (lost and (n - lost < 20 or n - lost < 0.3 * n))))
    return common, out


def near(a, b, tolerance):
    return math.isclose(a, b, abs_tol=tolerance)
