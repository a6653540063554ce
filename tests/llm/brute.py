"""Plain Python versions of what the queries return."""

import hashlib
import re
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def prose(rng, n, words=400):
    return " ".join(f"w{rng.integers(words)}" for _ in range(n))


def words(text):
    return WORD.findall(text or "")


def shingles(text, width=5):
    w = words(text)
    return {tuple(w[i:i + width]) for i in range(len(w) - width + 1)} if len(w) >= width else {tuple(w)} if w else set()


def repeat_removal(rows, width=13):
    """{(doc_id, text): (n_words, n_removed, sha256)}; a null id counts as the least."""
    first = {}
    order = lambda i: -(2**63) if i is None else i
    for i, t in rows:
        w = words(t)
        for k in range(len(w) - width + 1):
            g = tuple(w[k:k + width])
            first[g] = min(first.get(g, order(i)), order(i))
    out = {}
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - width + 1):
            if first[tuple(w[k:k + width])] < order(i):
                gone.update(range(k, k + width))
        kept = " ".join(x for k, x in enumerate(w) if k not in gone)
        out[i, t] = (len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def quality_counts(text):
    w = words(text)
    lines = [x for x in (text or "").split("\n") if words(x)]
    windows = [tuple(w[i:i + 5]) for i in range(len(w) - 4)]
    times, covered = Counter(windows), set()
    for i, g in enumerate(windows):
        if times[g] > 1:
            covered.update(range(i, i + 5))
    return [len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered)]


def components(n, links):
    root = list(range(n))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return [find(x) for x in range(n)]
