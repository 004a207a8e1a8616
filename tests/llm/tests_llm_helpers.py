"""Brute force that several tests share."""

from collections import Counter
from itertools import combinations


def shingles(text):
    w = (text or "").encode().lower().split()
    return {b" ".join(w[i : i + 5]) for i in range(max(1, len(w) - 4))} if w else set()


def components(texts, least=0.8):
    """The least id of each text's group, linked by the Jaccard similarity of five-word shingles."""
    sets, root = {i: shingles(t) for i, t in texts.items()}, {i: i for i in texts}
    for a, b in combinations(sorted(texts), 2):
        x, y = sets[a], sets[b]
        if min(len(x), len(y)) < least * max(len(x), len(y)):
            continue
        both = len(x & y)
        if (not x and not y or both >= least * (len(x) + len(y) - both)) and root[a] != root[b]:
            low, high = sorted((root[a], root[b]))
            root = {i: low if r == high else r for i, r in root.items()}
    return root


def repeated_passages(texts, words, within=None):
    """Ids of the texts that hold a run of so many words which occurs again, of those ``within``."""
    seen = Counter()
    runs = {i: [tuple(w[k : k + words]) for k in range(len(w) - words + 1)] for i, t in texts.items() if within is None or i in within for w in [(t or "").encode().split()]}
    for own in runs.values():
        seen.update(own)
    return {i for i, own in runs.items() if any(seen[r] > 1 for r in own)}
