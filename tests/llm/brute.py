"""Plain-Python versions of the training-data operators, for small inputs."""

import re
from collections import Counter, defaultdict

import numpy as np

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base_counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    seen = Counter(grams)
    hit = {i + k for i, g in enumerate(grams) if seen[g] > 1 for k in range(3)}
    return (len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
            len(lines) - len(set(lines)), len(hit))


def shingles(text, size=5):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = WORD.findall(lowered)
    if len(words) < size:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + size]) for i in range(len(words) - size + 1))


def similar_components(docs):
    """(doc_id, n_shingles, component_id) per (doc_id, text) row with unique ids."""
    sets = {d: shingles(t) for d, t in docs}
    parent = {d: d for d in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    where = defaultdict(list)
    for d, s in sets.items():
        for g in s:
            where[g].append(d)
    for d, s in sets.items():
        met = Counter(e for g in s for e in where[g] if e > d)
        for e, k in met.items():
            if 100 * k >= 80 * (len(s) + len(sets[e]) - k):
                a, b = sorted((find(d), find(e)))
                parent[b] = a
    return sorted((d, len(s), find(d)) for d, s in sets.items())


def repeated_mask(texts, window=200):
    """Per text, which of its bytes a window that starts elsewhere too covers."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + window] for b in raw for i in range(len(b) - window + 1))
    out = []
    for b in raw:
        mask = np.zeros(len(b), bool)
        for i in range(len(b) - window + 1):
            if seen[b[i:i + window]] > 1:
                mask[i:i + window] = True
        out.append(mask)
    return out


def without_repeats(texts, window=200):
    return [None if t is None else
            np.frombuffer(t.encode(), np.uint8)[~m].tobytes().decode("utf-8", "ignore")
            for t, m in zip(texts, repeated_mask(texts, window))]


def substring_distance(pattern, text):
    """Least edit distance of the pattern to any stretch of the text."""
    row = list(range(len(pattern) + 1))
    best = row[-1]
    for c in text:
        new = [0]
        for i, p in enumerate(pattern, 1):
            new.append(min(new[i - 1] + 1, row[i] + 1, row[i - 1] + (p != c)))
        row = new
        best = min(best, row[-1])
    return best
